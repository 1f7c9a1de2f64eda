"""From raw documents to packed training sequences: four stages, each one operator of starloom.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again for the next one.
Toxic documents go, then those whose language can't be told, then all but one of each group of near copies; what is left
is tokenised and packed. All but the last stage return the documents' columns as they came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.langid import language_stage
from starloom.llm.ngram_join import near_copy_stage
from starloom.llm.packing import packing_stage
from starloom.llm.toxicity import toxic_stage
from starloom.session import materialize

STAGES = [
    ("toxicity", toxic_stage),
    ("language", language_stage),
    ("near_copies", near_copy_stage),
    ("packing", packing_stage),
]

# Trained models and packing have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
