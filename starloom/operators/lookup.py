"""Equi-join of a large table with a keyed one, safe under skew.

Spark broadcasts a side where its hash table, estimated from file sizes times their compression or from the rows of a
finished shuffle stage, is within spark.starloom.broadcastBytes (see session.prepare). Otherwise both sides shuffle, and adaptive execution cuts partitions that a hot key
makes large into pieces, which the left side of a left join allows. No job runs to plan the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    rows: DataFrame,
    side: DataFrame,
    on: dict[str, str],
    add: dict[str, object],
    how: str = "left",
) -> DataFrame:
    """rows with the columns in add fetched from side, which has at most one row per key.

    on maps columns of rows to key columns of side. In a left lookup a miss yields the value given in add (None
    keeps null); an inner lookup drops it.
    """
    side_keys = {f"_side_{i}": k for i, k in enumerate(on.values())}
    fetched = {f"_got_{i}": a for i, a in enumerate(add)}
    narrow = side.select(*[F.col(k).alias(n) for n, k in side_keys.items()],
                         *[F.col(a).alias(n) for n, a in fetched.items()])
    condition = None
    for row_key, side_key in zip(on, side_keys):
        same = F.col(row_key) == F.col(side_key)
        condition = same if condition is None else condition & same

    joined = rows.join(narrow, condition, how)
    kept = [c for c in rows.columns if c not in add]
    columns = []
    for name, out in fetched.items():
        default = add[out]
        found = F.col(name)
        if default is not None and how == "left":
            found = F.coalesce(found, F.lit(default).cast(narrow.schema[name].dataType))
        columns.append(found.alias(out))
    return joined.select(*kept, *columns)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """existing with the rows of incoming replacing those of the same key."""
    return existing.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming.select(*existing.columns))
