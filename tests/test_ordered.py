"""Range-split scans, skew-safe lookups, temporal reads and trees against brute force."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import temporal, trees
from starloom.operators.lookup import lookup
from starloom.operators.ranges import exact_percentiles, global_rank, keyed_scan, number_rows
from starloom.session import materialize, materialize_all, passing_cut_points


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds more than half of the rows, one value a third; with null keys and null values."""
    rng = random.Random(7)
    rows = [(1 if rng.random() < 0.6 else rng.choice([None, 2, 3, 4]), i, rng.choice([5, 5, rng.randint(0, 9), None])) for i in range(400)]
    return spark.createDataFrame(rows, "k int, t int, v int").repartition(3).cache()


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_keyed_scan_equals_windows(spark, skewed, partitions):
    got = keyed_scan(skewed, ["k"], ["t"], running={"run": "v"}, totals={"total": "v"}, following={"nxt": "v"}, carried={"last": "v"},
                     partitions=partitions)
    w = Window.partitionBy("k").orderBy("t")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = skewed.select("*", F.sum("v").over(so_far).alias("run"), F.sum("v").over(Window.partitionBy("k")).alias("total"),
                         F.lead("v").over(w).alias("nxt"), F.last("v", ignorenulls=True).over(so_far).alias("last"))
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(got) == order(want)


@pytest.mark.parametrize("partitions", [1, 9])
def test_global_rank_and_numbers(spark, skewed, partitions):
    got = {r.t: r.rank for r in global_rank(skewed, "v", ["t"], "rank", partitions).collect()}
    greater = lambda x, v: x is not None and (v is None or x > v)
    every = skewed.collect()
    assert got == {r.t: 1 + sum(greater(o.v, r.v) for o in every) for r in every}
    values = skewed.where("v is not null")
    all_values = [r.v for r in values.collect()]
    numbered = number_rows(values, [F.col("v"), F.col("t")], "n", start=10, partitions=partitions).collect()
    assert [r.t for r in sorted(numbered, key=lambda r: r.n)] == [r.t for r in sorted(values.collect(), key=lambda r: (r.v, r.t))]
    assert sorted(r.n for r in numbered) == list(range(11, 11 + len(all_values)))


def test_exact_percentiles(spark, skewed):
    got = {r.k: (r.n, r.p50, r.p95) for r in exact_percentiles(skewed, ["k"], "v", [0.5, 0.95], ["p50", "p95"], 6).collect()}
    want = skewed.groupBy("k").agg(F.count("v").alias("n"), F.percentile("v", F.array(F.lit(0.5), F.lit(0.95))).alias("p"))
    for r in want.collect():
        assert got[r.k][0] == r.n and got[r.k][1:] == pytest.approx(tuple(r.p))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_modes_agree(spark, skewed, join_mode, how):
    side = spark.createDataFrame([(1, "one"), (2, "two"), (9, "nine")], "id int, name string")
    got = lookup(skewed, side, {"k": "id"}, {"name": "?"}, how)
    names = {1: "one", 2: "two"}
    want = [(r.k, r.t, r.v, names.get(r.k, "?")) for r in skewed.collect() if how == "left" or r.k in names]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (join_mode == "broadcast")


def stamp(n):
    return dt.datetime(2026, 1, 1) + dt.timedelta(minutes=n)


@pytest.mark.parametrize("partitions", [1, 8])
def test_intervals_and_as_of(spark, partitions):
    rng = random.Random(3)
    changes = [(1 if rng.random() < 0.7 else 2, stamp(rng.randint(0, 60)), i, f"v{i}") for i in range(60)]
    log = spark.createDataFrame(changes, "k int, at timestamp, seq int, state string")
    versions = temporal.version_intervals(log, ["k"], "at", ["seq"], partitions)
    rows = versions.collect()
    for key in (1, 2):
        mine = sorted((r for r in rows if r.k == key), key=lambda r: (r.at, r.seq))
        assert all(a.valid_to == b.valid_from for a, b in zip(mine, mine[1:])) and mine[-1].valid_to.year == 9999
    probes = spark.createDataFrame([(rng.choice([1, 2, 3]), stamp(rng.randint(-5, 70)), i) for i in range(50)], "k int, asked timestamp, id int")
    got = {r.id: r.state for r in temporal.as_of(probes, versions, "k", "asked", ["state"], ["seq"], partitions).collect()}
    for p in probes.collect():
        hits = [r.state for r in rows if r.k == p.k and r.valid_from <= p.asked < r.valid_to]
        assert got[p.id] == (hits[0] if hits else None)
    closed = versions.withColumn("valid_to", F.col("valid_from") + F.expr("interval 1 second"))
    late = spark.createDataFrame([(1, stamp(500), 1)], "k int, asked timestamp, id int")
    assert temporal.as_of(late, closed, "k", "asked", ["state"], ["seq"]).first().state is None


def test_period_reads(spark):
    versions = spark.createDataFrame([("a", stamp(0), stamp(10)), ("b", stamp(10), stamp(20)), ("c", stamp(20), stamp(30))],
                                     "s string, valid_from timestamp, valid_to timestamp")
    assert [r.s for r in temporal.between(versions, stamp(10), stamp(20)).orderBy("s").collect()] == ["b", "c"]
    assert [r.s for r in temporal.valid_at(versions, stamp(10)).collect()] == ["b"]


def test_category_tree(spark, join_mode):
    nodes = spark.createDataFrame([(1, None, "Bicycles", "b"), (2, None, "Rain & Snow", "r"), (3, 1, "Wheels", "w"),
                                   (4, 2, "Capes", "c"), (5, 3, "Spokes", "s")], "id int, parent int, name string, slug string")
    got = sorted((r.depth, r.path, r.slug) for r in trees.hierarchy(nodes, "id", "parent", "name", ["slug"]).collect())
    assert got == [(0, "Bicycles", "b"), (0, "Rain & Snow", "r"), (1, "Bicycles > Wheels", "w"), (1, "Rain & Snow > Capes", "c"), (2, "Bicycles > Wheels > Spokes", "s")]
    with pytest.raises(ValueError):
        trees.hierarchy(nodes.unionByName(nodes.where("id = 3").withColumn("parent", F.lit(5))), "id", "parent", "name")


def test_deep_trees_and_unreachable_cycles(spark):
    chain = [(0, None, "n0"), *((i, i - 1, f"n{i}") for i in range(1, 120)), (900, 901, "loop"), (901, 900, "loop")]
    got = trees.hierarchy(spark.createDataFrame(chain, "id int, parent int, name string"), "id", "parent", "name").agg(F.count("*"), F.max("depth")).first()
    assert tuple(got) == (120, 119)


def test_downstream_stops_at_cycles_and_depth(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e")], "src string, dst string")
    start = spark.createDataFrame([("a",)], "node string")
    reach = lambda depth: {r.node: r.depth for r in trees.downstream(edges, start, depth).collect()}
    assert reach(None) == reach(10) == {"b": 1, "c": 2, "d": 3, "e": 4}
    assert reach(2) == {"b": 1, "c": 2}


def test_the_shuffle_files_of_a_cut_point_go_when_it_is_written(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {name for name in disk.getAllFiles().mkString(" ").split() if "shuffle_" in name}
    before, switch = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    stored = materialize(spark.range(1000).repartition(4, "id"), "dropped")
    until = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(switch) == "false"
    assert stored.count() == 1000 and stored.groupBy("id").count().count() == 1000


def test_independent_cut_points_are_written_at_once_and_in_the_callers_folder(spark):
    frames = {f"at-once-{k}": spark.range(100 * k).repartition(2, "id") for k in range(1, 7)}
    with passing_cut_points(spark):
        stored = materialize_all(frames, at_once=3)
        assert [df.count() for df in stored.values()] == [100 * k for k in range(1, 7)] and list(stored) == list(frames)
        assert all("/passing-" in df.inputFiles()[0] for df in stored.values())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    with pytest.raises(Exception, match="broken frame"):
        materialize_all({"whole": spark.range(5), "broken": spark.range(5).select(F.raise_error(F.lit("broken frame")).cast("string").alias("x"))})
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
