import random

import pytest

CLASHING = ["n", "score", "hash", "row", "component", "sequence_id", "range", "_range", "piece", "label_", "node", "group", "_group", "key", "sketch", "target"]

WORDS = ("the of and to in is it was for on as with be at by this had not are but from or have an they which one you were all her she there would their we him been has when "
         "who will no more if out so up said what its about than into them can only other time new some could these two may first then do").split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + ("" if draw.random() < 0.7 else str(draw.randrange(400))) for _ in range(n))


@pytest.fixture
def sf(tmp_path, spark):
    """Writes tables with further columns whose names clash with those the operators use; returns the folder."""
    def write(**tables):
        for name, (schema, rows) in tables.items():
            taken = [c.split()[0] for c in schema.split(", ")]
            extra = [c for c in CLASHING if c not in taken]
            df = spark.createDataFrame(rows, schema)
            for c in extra:
                df = df.selectExpr("*", f"'x' AS `{c}`")
            df.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(texts):
    """(doc_id, text) pairs as rows of documents."""
    return DOCUMENTS, [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]


@pytest.fixture
def odd_texts():
    """Nulls, empty and blank texts, ties, repeated rows, one long text, odd characters."""
    long = prose(99, 30_000)
    return [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two"), (6, "one two three"), (7, prose(1, 80)), (8, prose(1, 80)), (8, prose(1, 80)),
            (9, prose(1, 80).upper()), (10, prose(2, 300)), (10, "another text under the same id"), (None, prose(1, 80)), (None, None), (11, long), (12, "é😀 中文 \x1c\x00 ｱ <|endoftext|> ▁ ß"),
            (13, "… “quoted” 'tis it's 12345 &&&"), (-5, prose(3, 40)), (14, long + " end")]
