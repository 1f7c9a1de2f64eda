"""The star's customer and order tables from wherever they are kept, and the mart that is made of them.

A reader knows its own options, refuses to be made without what it needs, and gives both tables by `read`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUSTOMERS, ORDERS = ("dim_customer", "customer_sk"), ("fact_order", "order_id")      # table and its numeric key


def _needed(**options: str) -> None:
    missing = [name for name, value in options.items() if not value]
    if missing:
        raise ValueError(f"set {', '.join(missing)}")


@dataclass(frozen=True)
class ParquetStar:
    customers: str
    orders: str

    def __post_init__(self):
        _needed(customers=self.customers, orders=self.orders)

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return spark.read.parquet(self.customers), spark.read.parquet(self.orders)


@dataclass(frozen=True)
class JdbcStar:
    """Each table is split on its numeric key into ranges, so that it is not read through one connection."""

    url: str
    schema: str = "dwh"
    ranges: int = 64
    options: dict = field(default_factory=dict)          # user, password, driver, ..

    def __post_init__(self):
        _needed(url=self.url)

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return self._table(spark, *CUSTOMERS), self._table(spark, *ORDERS)

    def _load(self, spark: SparkSession, **what) -> DataFrame:
        return spark.read.format("jdbc").options(url=self.url, fetchsize=10_000, **self.options, **what).load()

    def _table(self, spark: SparkSession, table: str, key: str) -> DataFrame:
        name = f"{self.schema}.{table}"
        rows = self._load(spark, dbtable=name)
        column = next(c for c in rows.columns if c.lower() == key)
        quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(column)
        low, high = self._load(spark, query=f"select min({quoted}) as lo, max({quoted}) as hi from {name}").first()
        if low is not None and low < high:
            rows = self._load(spark, dbtable=name, partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=self.ranges)
        return rows.toDF(*[c.lower() for c in rows.columns])


def write_mart(mart: DataFrame, path: str) -> int:
    """Rebuild the mart, its files in order of customer_sk and sorted inside; the row count is read from the files."""
    mart.repartitionByRange("customer_sk").sortWithinPartitions("customer_sk").write.mode("overwrite").parquet(path)
    return mart.sparkSession.read.parquet(path).agg(F.count(F.lit(1))).first()[0]
