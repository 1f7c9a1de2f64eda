"""Ordered computations over data of any skew: running sums, lags, ranks and dense numbers.

A plain window puts a whole group, or for a global rank the whole table, in one task. Here the rows are
range-split on (keys, order), so that a heavy key spans several ranges, and written once. Each range is then
computed on its own, and what flows from one range to the next is a summary of at most two groups per range,
which is the proven bound behind every broadcast in this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialize

RANGE = "_range"
_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def range_layout(df: DataFrame, order: list, partitions: int | None = None) -> DataFrame:
    """df written as ranges of the order, the range number in _range; later ranges sort after earlier ones."""
    split = df.repartitionByRange(*([partitions] if partitions else []), *order)
    return materialize(split.withColumn(RANGE, F.spark_partition_id()), "ranges")


def keyed_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    running: dict[str, str] | None = None,
    totals: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    carried: dict[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """df with ordered columns per key; order must be unique within a key, ascending.

    running[out] = column: sum of the column up to and including the row;
    totals[out] = column: sum over the key;
    following[out] = column: the column's value in the key's next row, null in the last;
    carried[out] = column: the last non-null value up to and including the row.
    """
    running, totals, following, carried = running or {}, totals or {}, following or {}, carried or {}
    layout = range_layout(df, [*keys, *order], partitions)
    group = F.struct(*keys)
    position = F.struct(*order)

    ends = layout.groupBy(RANGE).agg(F.min(group).alias("_lo"), F.max(group).alias("_hi"))
    at_ends = layout.join(F.broadcast(ends), RANGE).where((group == F.col("_lo")) | (group == F.col("_hi")))
    summary = [F.count(F.lit(1)).alias("_n")]
    for column in {*running.values(), *totals.values()}:
        summary.append(F.sum(column).alias(f"_sum_{column}"))
    for column in set(following.values()):
        summary.append(F.min_by(F.struct(F.col(column).alias("v")), position).alias(f"_first_{column}"))
    for column in set(carried.values()):
        seen = F.when(F.col(column).isNotNull(), position)
        summary.append(F.max_by(F.col(column), seen).alias(f"_last_{column}"))
    edges = at_ends.groupBy(RANGE, *keys).agg(*summary)

    across = Window.partitionBy(*keys).orderBy(RANGE)
    inherited = {}
    for column in set(running.values()):
        inherited[f"_before_{column}"] = F.sum(f"_sum_{column}").over(across.rowsBetween(*_BEFORE))
    for column in set(totals.values()):
        inherited[f"_all_{column}"] = F.sum(f"_sum_{column}").over(Window.partitionBy(*keys))
    for column in set(following.values()):
        inherited[f"_next_{column}"] = F.lead(f"_first_{column}").over(across)
    for column in set(carried.values()):
        inherited[f"_prior_{column}"] = F.last(f"_last_{column}", ignorenulls=True).over(across.rowsBetween(*_BEFORE))
    carry = edges.select(F.col(RANGE).alias("_r"), *[F.col(k).alias(f"_k_{k}") for k in keys],
                         *[c.alias(n) for n, c in inherited.items()])

    same = F.col(RANGE) == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = layout.join(F.broadcast(carry), same, "left")
    local = Window.partitionBy(RANGE, *keys).orderBy(*order)
    whole = Window.partitionBy(RANGE, *keys)
    added = {}
    for out, column in running.items():
        here = F.sum(column).over(local.rowsBetween(*_SO_FAR))
        added[out] = F.coalesce(here + F.col(f"_before_{column}"), here, F.col(f"_before_{column}"))
    for out, column in totals.items():
        added[out] = F.coalesce(F.col(f"_all_{column}"), F.sum(column).over(whole))
    for out, column in following.items():
        nearest = F.coalesce(F.lead(F.struct(F.col(column).alias("v"))).over(local), F.col(f"_next_{column}"))
        added[out] = nearest["v"]
    for out, column in carried.items():
        added[out] = F.coalesce(F.last(column, ignorenulls=True).over(local.rowsBetween(*_SO_FAR)),
                                F.col(f"_prior_{column}"))
    return joined.select(*df.columns, *[c.alias(n) for n, c in added.items()])


def _offsets(layout: DataFrame) -> DataFrame:
    """Rows before each range: one row per range."""
    counts = layout.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(RANGE).rowsBetween(*_BEFORE))
    return counts.select(RANGE, F.coalesce(before, F.lit(0)).alias("_before"))


def number_rows(df: DataFrame, order: list, out: str, start: int = 0, partitions: int | None = None) -> DataFrame:
    """Dense numbers start+1, start+2, ... in the given order, which should be unique."""
    layout = range_layout(df, order, partitions)
    local = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    numbered = layout.join(F.broadcast(_offsets(layout)), RANGE)
    return numbered.select(*df.columns, (F.lit(start) + F.col("_before") + local).cast("bigint").alias(out))


def global_rank(df: DataFrame, value: str, tie_break: list[str], out: str, partitions: int | None = None) -> DataFrame:
    """SQL rank by value descending over the whole table, nulls last and equal among themselves.

    The tie-break columns only let equal values span ranges; equal values still share a rank. A value at the
    end of a range may have begun in an earlier one: its rank is the smallest that any range gives it.
    """
    layout = range_layout(df, [F.desc_nulls_last(value), *tie_break], partitions)
    offsets = _offsets(layout)
    # the first and the last value of each range: a null is the last if there is one, the first if all are null
    ends = layout.groupBy(RANGE).agg(F.max(value).alias("_hi"), F.when(F.count_if(F.col(value).isNull()) == 0, F.min(value)).alias("_lo"))
    lows = (layout.select(RANGE, value).join(F.broadcast(ends), RANGE)
            .groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(value).eqNullSafe(F.col("_lo"))).alias("_ties")))
    at_ends = offsets.join(ends, RANGE).join(lows, RANGE).select(
        F.inline(F.array(
            F.struct(F.col("_hi").alias("_value"), (F.col("_before") + 1).alias("_rank")),
            F.struct(F.col("_lo").alias("_value"), (F.col("_before") + F.col("_n") - F.col("_ties") + 1).alias("_rank")))))
    shared = at_ends.groupBy("_value").agg(F.min("_rank").alias("_shared"))
    local = F.rank().over(Window.partitionBy(RANGE).orderBy(F.desc_nulls_last(value)))
    return (layout.join(F.broadcast(offsets), RANGE)
            .join(F.broadcast(shared), F.col(value).eqNullSafe(F.col("_value")), "left")
            .select(*df.columns, F.coalesce(F.col("_shared"), F.col("_before") + local).cast("bigint").alias(out)))


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, fractions: list[float], names: list[str], partitions: int | None = None,
) -> DataFrame:
    """Exact interpolated percentiles per key, with the row count in n.

    Equal values are counted before the shuffle, so the ordered part sees each distinct value of a key once, and
    no task holds all values of a key.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    placed = keyed_scan(counted, keys, [value], running={"_upto": "_c"}, totals={"_total": "_c"}, partitions=partitions)
    picks = []
    for fraction, name in zip(fractions, names):
        rank = F.lit(fraction) * (F.col("_total") - 1)       # zero-based, fractional
        for side, target in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            hit = (F.col("_upto") - F.col("_c") <= target) & (target < F.col("_upto"))
            picks.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{name}_{side}"))
    picked = placed.groupBy(*keys).agg(F.max("_total").alias("n"), *picks)
    columns = []
    for fraction, name in zip(fractions, names):
        rank = F.lit(fraction) * (F.col("n") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        columns.append((low + (rank - F.floor(rank)) * (high - low)).alias(name))
    return picked.select(*keys, "n", *columns)
