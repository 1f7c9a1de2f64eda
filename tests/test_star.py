import datetime as dt
import time
import uuid
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.catalog import CATALOG, STAR_SCHEMAS
from starloom.functions import scalars as sc
from starloom.operators import dims, facts
from starloom.operators.latest import latest_per_key
from starloom.operators.lookup import lookup
from starloom.operators.scd import CUSTOMER_SCD2, Scd2Spec, close_version, scd2_merge
from starloom.plans import marts
from starloom.plans.star_load import StarStore, load_star
from starloom.session import in_passes, materialize, shared_dir
from seed import BATCH, TOTAL, seed_snapshot

OPEN = dt.datetime(9999, 12, 31)


def records(spark, entity, *rows):
    spec = CATALOG[entity]
    names = [f.name for f in spec.fields]
    data = [(*row, "insert", 1, 1, 0, i) for i, row in enumerate(rows)]
    schema = spec.to_struct_type().add("partition", "integer").add("offset", "long")
    for f in schema.fields:
        f.nullable = True
    assert all(len(r) == len(names) for r in rows)
    return spark.createDataFrame(data, schema)


def test_dim_date(spark):
    keys = spark.createDataFrame([(20260725,), (20260101,), (20260101,), (0,)], "date_key int")
    rows = [tuple(r) for r in dims.merge_dim_date(dims.empty_dimension(spark, "dim_date"), keys).orderBy("date_key").collect()]
    assert rows == [(20260101, dt.date(2026, 1, 1), 2026, 1, 1, 1, 4, 0, 1), (20260725, dt.date(2026, 7, 25), 2026, 3, 7, 25, 6, 1, 30)]


def test_dim_warehouse(spark):
    rows = records(spark, "warehouses", (7, "SEA", "Seattle", "West", "US", "America/Los_Angeles"))
    first = dims.merge_dim_warehouse(dims.empty_dimension(spark, "dim_warehouse"), rows)
    assert [tuple(r) for r in first.collect()] == [(7, 7, "SEA", "Seattle", "West", "US", "America/Los_Angeles")]
    again = dims.merge_dim_warehouse(first, rows.withColumn("name", F.lit("New")))
    assert [r.name for r in again.collect()] == ["New"]


def test_dim_carrier(spark):
    existing = spark.createDataFrame([(1, "UPS", "express")], STAR_SCHEMAS["dim_carrier"])
    ships = records(spark, "shipments", (1, 1, "UPS", "a", None, None, 1), (2, 1, "FedEx", "b", None, None, 1), (3, 1, "FedEx", "c", None, None, 1))
    got = dims.merge_dim_carrier(existing, ships)
    assert sorted(map(tuple, got.collect())) == [(1, "UPS", "express"), (2, "FedEx", "standard")]
    assert sorted(map(tuple, dims.merge_dim_carrier(got, ships).collect())) == sorted(map(tuple, got.collect()))


def customer(spark, *rows):
    return records(spark, "customers", *rows)


MIRA = (100, "C100", "Mira", "mira@x.io", "de-DE", 1, "100.00")


def existing_customer(spark, sk, **changes):
    row = {"customer_sk": sk, "customer_id": 100, "customer_code": "C100", "display_name": "Mira", "email": "mira@x.io", "preferred_locale": "de-DE",
           "status": 1, "lifetime_value_usd": Decimal("100.00"), "valid_from": dt.datetime(2026, 1, 1), "valid_to": OPEN, "is_current": 1, **changes}
    return spark.createDataFrame([tuple(row.values())], STAR_SCHEMAS["dim_customer"])


def versions(df):
    return sorted((r.customer_sk, r.customer_id, r.display_name, r.email, r.valid_from, r.valid_to, r.is_current) for r in df.collect())


def test_scd2_new_member_continues_numbering(spark, join_mode):
    existing = existing_customer(spark, 4, customer_id=1)
    got = versions(dims.merge_dim_customer(existing, customer(spark, MIRA), BATCH))
    assert got[1] == (5, 100, "Mira", "mira@x.io", BATCH, OPEN, 1) and got[0][5:] == (OPEN, 1)


def test_scd2_change_closes_and_opens(spark, join_mode):
    got = versions(dims.merge_dim_customer(existing_customer(spark, 5, email="old@x.io"), customer(spark, MIRA), BATCH))
    assert [(v[0], v[3], v[5], v[6]) for v in got] == [(5, "old@x.io", BATCH, 0), (6, "mira@x.io", OPEN, 1)]


@pytest.mark.parametrize("stored,incoming", [
    ({}, {}), ({}, {"lifetimeValueUsd": "100.0000"}), ({"customer_code": "0012"}, {"customerCode": "0012"}),
    ({"email": ""}, {"email": None}), ({"email": None}, {"email": ""}),
])
def test_scd2_equal_by_value_is_noop(spark, stored, incoming):
    existing = existing_customer(spark, 5, **stored)
    batch = customer(spark, MIRA)
    for name, value in incoming.items():
        batch = batch.withColumn(name, F.lit(value).cast("string"))
    got = dims.merge_dim_customer(existing, batch, BATCH)
    assert got.collect() == existing.select(got.columns).collect()


def test_scd2_empty_batch_and_absent_keys(spark):
    existing = existing_customer(spark, 5)
    assert versions(dims.merge_dim_customer(existing, customer(spark), BATCH)) == versions(existing)
    other = customer(spark, (7, "C7", "Bob", "b", "en", 1, "1"))
    assert [v[6] for v in versions(dims.merge_dim_customer(existing, other, BATCH))] == [1, 1]


def test_scd2_two_codes_of_one_id_leave_one_current(spark):
    batch = customer(spark, MIRA, (100, "C100b", "Mira B", "mira@x.io", "en-US", 1, "100.00"))
    got = versions(dims.merge_dim_customer(existing_customer(spark, 5), batch, BATCH))
    assert [(v[2], v[6]) for v in got] == [("Mira", 0), ("Mira B", 1)]


def test_product_category_name_and_rename(spark, join_mode):
    product = records(spark, "products", (200, "SKU-1", 3, "Widget", "9.99", 1), (201, "SKU-2", 9, "Odd", "1", 1))
    named = lambda name: records(spark, "product-categories", (3, None, name, "g", 1))
    first = materialize(dims.merge_dim_product(dims.empty_dimension(spark, "dim_product"), product, named("Gadgets"), BATCH), "p")
    assert [(r.product_sk, r.category_name) for r in first.orderBy("product_sk").collect()] == [(1, "Gadgets"), (2, "")]
    later = dims.merge_dim_product(first, product, named("Things"), dt.datetime(2026, 8, 1))
    assert [(r.product_sk, r.category_name, r.is_current) for r in later.orderBy("product_sk").collect()] == [
        (1, "Gadgets", 0), (2, "", 1), (3, "Things", 1)]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.integers(0, 4), st.sampled_from(["a", "b"]), max_size=5), min_size=1, max_size=3))
def test_scd2_properties(spark, batches):
    """One current row per key, no overlaps or gaps, dense keys, and idempotence."""
    spec = Scd2Spec("sk", "id", ("name",))
    dim = spark.createDataFrame([], "sk bigint, id bigint, name string, valid_from timestamp, valid_to timestamp, is_current int")
    for i, batch in enumerate(batches):
        rows = spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(batch.items())], "id bigint, name string, offset bigint")
        dim = materialize(scd2_merge(dim, rows, spec, dt.datetime(2026, 1, 1 + i), ["offset"]), "dim")
        again = scd2_merge(dim, rows, spec, dt.datetime(2027, 1, 1), ["offset"])
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, dim.collect()))
    rows = dim.collect()
    assert sorted(r.sk for r in rows) == list(range(1, len(rows) + 1))
    for key in {r.id for r in rows}:
        mine = sorted((r for r in rows if r.id == key), key=lambda r: r.valid_from)
        assert [r.is_current for r in mine] == [0] * (len(mine) - 1) + [1] and mine[-1].valid_to == OPEN
        assert all(a.valid_to == b.valid_from for a, b in zip(mine, mine[1:]))


def test_close_version(spark):
    got = close_version(existing_customer(spark, 5), "customer_sk", [5], BATCH).first()
    assert (got.is_current, got.valid_to) == (0, BATCH)


def millis(text):
    return int(dt.datetime.fromisoformat(text + "+00:00").timestamp() * 1000)


def test_facts(spark, join_mode):
    people = existing_customer(spark, 500)
    products = spark.createDataFrame([(600, 200, "S", 1, "", "W", Decimal("1"), BATCH, OPEN, 1)], STAR_SCHEMAS["dim_product"])
    houses = spark.createDataFrame([(700, 7, "A", "B", "C", "US", "X")], STAR_SCHEMAS["dim_warehouse"])
    orders = records(spark, "orders", (10, "O", 100, 1, 2, millis("2026-07-25T00:00:00"), 3, "50.00", "5.00", "", "55.00", "USD"),
                     (11, "P", 999, 1, 2, millis("2026-07-25T00:00:00"), 3, "1", "0", "0", "1", "USD"))
    got = [tuple(r) for r in facts.fact_order(orders, people).orderBy("order_id").collect()]
    money = lambda v: Decimal(v)
    assert got[0] == (10, 20260725, 500, 1, 2, 3, money("50.00"), money("5.00"), money("0.00"), money("55.00"), "USD", dt.datetime(2026, 7, 25))
    assert got[1][2] == 0
    lines = records(spark, "order-lines", (1, 10, 200, 7, 3, "10.00", "5.50"), (2, 77, 1, 1, 1, "2.1250", "0"), (3, 10, 200, 7, 1, "0.0150", "0"))
    got = [tuple(r) for r in facts.fact_order_line(lines, facts.order_context(orders, people), products, houses).orderBy("order_line_id").collect()]
    assert got[0] == (1, 10, 20260725, 500, 600, 700, 3, money("10.0000"), money("5.5000"), money("24.50"))
    assert got[1][2:6] == (0, 0, 0, 0) and got[1][9] == money("2.12") and got[2][9] == money("0.02")
    txn = records(spark, "transactions", (9, 10, "stripe", "r", 1, "55.00", millis("2026-07-26T00:00:00"), 2))
    assert tuple(facts.fact_transaction(txn).first()) == (9, 10, 20260726, "stripe", 1, money("55.00"), 2, dt.datetime(2026, 7, 26))
    stock = records(spark, "product-inventory", (200, 7, 40, 5, 10, 3))
    assert tuple(facts.fact_inventory_snap(stock, products, houses, BATCH).first()) == (20260725, 600, 700, 40, 5, 10, 3)


def test_scalars(spark):
    row = spark.range(1).select(
        sc.date_key(F.lit(millis("2026-07-01T10:00:00"))).alias("key"), sc.money(F.lit("")).alias("empty"),
        sc.money(F.lit(None).cast("string")).alias("none"), sc.money(F.lit("x")).alias("bad"), sc.flag(F.lit(True)).alias("flag"),
        sc.millis_to_seconds_timestamp(F.lit(1999)).alias("cut"), sc.millis_to_seconds_timestamp(F.lit(None).cast("bigint")).alias("null"),
        sc.run_uuid(F.lit("0af7651916cd43dd8448eb211c80319c")).alias("uuid"), sc.run_uuid(F.lit("run-1")).alias("same"),
        sc.entity_of_topic(F.lit("curated.order-lines.changed.v1"), "curated.").alias("entity"),
        sc.entity_of_topic(F.lit("other"), "curated.").alias("other")).first()
    assert row.key == 20260701 and row.empty == row.none == row.bad == Decimal("0.00") and row.flag == 1
    assert row.cut == dt.datetime(1970, 1, 1, 0, 0, 1) and row.null is None
    assert row.uuid == "0af76519-16cd-43dd-8448-eb211c80319c" and row.same == "run-1"
    assert (row.entity, row.other) == ("order-lines", "other")


def test_latest_per_key(spark):
    rows = spark.createDataFrame([("a", 0, 5, "new"), ("a", 0, 2, "old"), (None, 0, 1, "x"), (None, 0, 3, "y"), ("", 0, 4, "e")],
                                 "key string, partition int, offset bigint, v string")
    got = latest_per_key(rows, ["key"], first_seen="first_offset").collect()
    assert sorted((r.key or "", r.v, r.first_offset) for r in got) == [("", "e", 4), ("", "x", 1), ("", "y", 3), ("a", "new", 2)]


def test_customer_360(spark):
    dim = spark.createDataFrame([(51, 7, "Mira", "m@x.io", 1, 1), (52, 8, "Jon", "j@old.io", 1, 0), (53, 8, "Jonas", "j@x.io", 1, 1), (54, 9, "Ines", "i@x.io", 2, 1)],
                                "customer_sk bigint, customer_id bigint, display_name string, email string, status int, is_current int")
    fact = spark.createDataFrame([(1, 53, 20260311, 12.5), (2, 53, 20260309, 7.5), (3, 53, 20260401, 4.0), (4, 51, 20260301, 30.0), (5, 0, 20260302, 1.0), (6, 52, 20260302, 2.0)],
                                 "order_id bigint, customer_sk bigint, order_date_key int, total_usd double")
    got = {r.customer_sk: (r.order_count, r.total_revenue_usd, r.avg_order_value_usd, r.first_order_date_key, r.last_order_date_key) for r in marts.customer_360(dim, fact).collect()}
    assert got == {51: (1, 30.0, 30.0, 20260301, 20260301), 53: (3, 24.0, 8.0, 20260309, 20260401), 54: (0, 0.0, 0.0, None, None)}


def star_store(spark):
    return StarStore(spark, f"{shared_dir(spark)}/star-{uuid.uuid4().hex}")


def test_seed_load_counts_rerun_and_rename(spark):
    store, snapshot = star_store(spark), seed_snapshot(spark)
    report = load_star(snapshot, store, BATCH, "t")
    assert sum(report.counts.values()) == TOTAL == 41 and report.counts["product-inventory"] == 8
    assert [s[3] for s in report.stages] == ["dim_date", "dim_warehouse", "dim_carrier", "dim_customer", "dim_product", "fact_order",
                                             "fact_order_line", "fact_transaction", "fact_inventory_snap", "load"]
    expected = {"dim_date": 3, "dim_warehouse": 2, "dim_carrier": 2, "dim_customer(current)": 5, "dim_product(current)": 4, "fact_order": 3,
                "fact_order_line": 5, "fact_transaction": 3, "fact_inventory_snap": 8}
    counts = lambda: {r.table_name: r.rows for r in marts.row_counts(store.read()).collect()}
    assert counts() == expected
    load_star(snapshot, store, dt.datetime(2026, 7, 25, 13), "t")
    assert counts() == expected
    name = F.when(F.col("customerCode") == "K-11", "Mira Holt-Weil").otherwise(F.col("displayName"))
    load_star({**snapshot, "customers": snapshot["customers"].withColumn("displayName", name)}, store, dt.datetime(2026, 7, 25, 14), "t")
    mira = store["dim_customer"].read().where("customer_code = 'K-11'").orderBy("customer_sk").collect()
    assert [(r.display_name, r.is_current) for r in mira] == [("Mira Holt", 0), ("Mira Holt-Weil", 1)]
    assert mira[0].valid_to == mira[1].valid_from == dt.datetime(2026, 7, 25, 14)
    tables = store.read()
    lines = marts.order_lines_star(tables["fact_order_line"], tables["dim_customer"], tables["dim_product"], tables["dim_date"], tables["dim_warehouse"])
    got = [(r.customer, r.product, r.warehouse, r.quantity, str(r.line_total_usd)) for r in lines.orderBy("order_line_id").collect()]
    assert got[0] == ("Mira Holt-Weil", "City bicycle", "HAL", 1, "640.00") and got[3][3:] == (2, "69.70") and len(got) == 5


def test_empty_snapshot_leaves_tables_untouched(spark):
    store, snapshot = star_store(spark), seed_snapshot(spark)
    load_star(snapshot, store, BATCH, "t")
    empty = {e: df.limit(0) for e, df in snapshot.items()}
    report = load_star(empty, store, BATCH, "t")
    assert set(report.counts.values()) == {0}
    assert store["fact_order"].read().count() == 3 and store["dim_customer"].read().count() == 5


def test_failing_stage_is_reported_and_raised(spark):
    snapshot = seed_snapshot(spark)
    broken = {**snapshot, "warehouses": snapshot["warehouses"].withColumn("code", F.raise_error(F.lit("boom")).cast("string"))}
    seen = []
    with pytest.raises(Exception, match="boom"):
        load_star(broken, star_store(spark), BATCH, "t", on_error=seen.append)
    assert [e[3] for e in seen[0].errors] == ["dim_warehouse-load-failed"] and [s[3:5] for s in seen[0].stages] == [("dim_date", "ok"), ("dim_warehouse", "failed")]


def test_recoded_members_and_renumbered_orders_stay_one_row(spark):
    """A new message key of the same business id (code, slug, number) changes attributes, never the number of rows."""
    store, snapshot = star_store(spark), seed_snapshot(spark)
    again = lambda entity, **new: snapshot[entity].unionByName(snapshot[entity].withColumns({**{k: F.lit(v) for k, v in new.items()}, "offset": F.col("offset") + 1000}))
    load_star({**snapshot, "warehouses": again("warehouses", code="NEW"), "product-categories": again("product-categories", name="Things", slug="x"),
               "orders": again("orders", orderNumber="N-9")}, store, BATCH, "t")
    counts = {r.table_name: r.rows for r in marts.row_counts(store.read()).collect()}
    assert (counts["dim_warehouse"], counts["fact_order"], counts["fact_order_line"], counts["fact_inventory_snap"], counts["dim_product(current)"]) == (2, 3, 5, 8, 4)
    assert {r.code for r in store["dim_warehouse"].read().collect()} == {"NEW"}
    assert {r.category_name for r in store["dim_product"].read().collect()} == {"Things"}


def test_fact_folders_by_date(spark):
    store = star_store(spark)
    load_star(seed_snapshot(spark), store, BATCH, "t")
    one = store["fact_order"].read().where("order_date_key = 20260309")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(order_date_key" in one._jdf.queryExecution().executedPlan().toString()


def test_scd2_table_equals_the_whole_merge(spark):
    """Random batches: the same versions as scd2_merge over the whole dimension, a failed batch leaves nothing, a repeated one changes nothing."""
    import random
    import uuid

    from starloom.operators.scd import CUSTOMER_SCD2, Scd2Table, scd2_merge
    from starloom.session import shared_dir

    draw, root = random.Random(2), f"{shared_dir(spark)}/scd2-{uuid.uuid4().hex}"
    schema = STAR_SCHEMAS["dim_customer"]
    table, whole, moment = Scd2Table(spark, root, schema, CUSTOMER_SCD2, 5), spark.createDataFrame([], schema), 0
    for n in range(4):
        rows = [(k, f"C{k}", draw.choice(["Ada", "Bo", None, ""]), f"{k}@x", "en", 1, draw.choice([1.0, 2.0]), 100 * n + i) for i, k in enumerate(draw.sample(range(-3, 14), 7) + [5, 5])]
        batch = spark.createDataFrame(rows, "customer_id long, customer_code string, display_name string, email string, preferred_locale string, status int, lifetime_value_usd double, offset long")
        batch = batch.withColumn("lifetime_value_usd", F.col("lifetime_value_usd").cast(schema["lifetime_value_usd"].dataType))
        at = dt.datetime(2026, 1, 1 + n)
        whole = spark.createDataFrame(scd2_merge(whole, batch, CUSTOMER_SCD2, at, ["offset"]).select(schema.names).collect(), schema)
        if n == 2:                                                     # a merge that died after its history was written
            table._history.append(whole.limit(2).withColumn("highest", F.lit(999).cast("long")), f"{n:010d}")
        for _ in range(2):
            table.merge(batch, at, ["offset"], batch=f"run-{n}")
        assert sorted(map(str, table.read().collect())) == sorted(map(str, whole.select(schema.names).collect()))
    assert table.current().where("is_current <> 1").count() == 0 and table.last_batch() == "run-3"


def test_lookup_broadcasts_by_size_of_rows(spark, tmp_path):
    """Tables whose rows are many times their files: neither side goes through the driver, whichever the inner join may build."""
    rows = spark.range(2_000_000).select("id", F.lit("a text that is the same in every row").alias("name"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows, side = spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/rows").withColumnRenamed("name", "other")
    found = lookup(rows, side, {"id": "id"}, {"other": None}, "inner")
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()
    few = lookup(rows, side.where("id < 1000").limit(1000), {"id": "id"}, {"other": None}, "inner")
    assert "Broadcast" in few._jdf.queryExecution().sparkPlan().toString()


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString(" ").split() if "shuffle_" in name}


def test_large_facts_are_loaded_in_passes_whose_shuffles_go(spark):
    """of a large fact one part after the other is shuffled, and the files of a shuffle go with its part; the tables are those of one pass."""
    snapshot = {e: materialize(df, e) for e, df in seed_snapshot(spark).items()}
    facts_of = lambda store: {n: sorted(map(str, store[n].read().collect())) for n in ("fact_order", "fact_order_line", "fact_transaction", "fact_inventory_snap")}
    stores = [StarStore(spark, f"{shared_dir(spark)}/star-{uuid.uuid4().hex}", **how) for how in ({"day_folders": False}, {"day_folders": False}, {"months": True})]
    load_star(snapshot, stores[0], BATCH)
    spark.conf.set("spark.starloom.passBytes", "1")
    try:
        assert len(in_passes(snapshot["orders"], "orderId")) == 8
        for store in stores[1:]:
            for _ in range(2):
                load_star(snapshot, store, BATCH)
            assert facts_of(store) == facts_of(stores[0])
        assert set(stores[2]["fact_order_line"].folders().values()) == {0}
        before, until = shuffle_files(spark), time.monotonic() + 20
        stores[1]["fact_order"].replace([facts.fact_order(p, stores[0]["dim_customer"].read()) for p in in_passes(snapshot["orders"], "orderId")])
        while shuffle_files(spark) - before and time.monotonic() < until:
            time.sleep(0.2)
        assert not shuffle_files(spark) - before
    finally:
        spark.conf.unset("spark.starloom.passBytes")


def test_passes_hold_every_row_once(spark):
    rows = materialize(spark.createDataFrame([(None if i % 7 == 0 else i % 50, i) for i in range(500)], "k long, v long"), "rows")
    assert len(in_passes(rows, "k")) == 1
    spark.conf.set("spark.starloom.passBytes", "1")
    try:
        found = [{tuple(r) for r in part.collect()} for part in in_passes(rows, "k")]
    finally:
        spark.conf.unset("spark.starloom.passBytes")
    assert sum(map(len, found)) == 500 and len(set.union(*found)) == 500 and sum({None} <= {k for k, _ in part} for part in found) == 1


def test_rows_that_a_table_holds_are_not_stored_again(spark):
    """only entities that are joined or aggregated are written; an entity that is a table's rows is read where it lies."""
    from starloom.testbed.frames import curated_rows, stored_frames

    frames = {e: curated_rows(spark, "/root/testdata/sf0.001", e) for e in ("orders", "order-lines", "shipments", "products")}
    stored = stored_frames(frames)
    assert [all(f.startswith("file:///root/testdata/") for f in stored[e].inputFiles()) for e in frames] == [True, True, False, False]
    assert all(stored[e].exceptAll(df).isEmpty() and df.exceptAll(stored[e]).isEmpty() for e, df in frames.items()) and list(stored) == list(frames)
