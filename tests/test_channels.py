"""Telemetry, lineage, sources, sinks and streams."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from starloom.catalog import CATALOG, RAW_SCHEMA, STAR_SCHEMAS, STAR_TABLES
from starloom.operators import curate, lineage, telemetry
from starloom.operators.latest import latest_per_key
from starloom.operators.scd import CUSTOMER_SCD2
from starloom.plans import conform, marts
from starloom.plans.star_load import LoadLog, StarStore
from starloom.session import shared_dir
from starloom.sources.raw import curated_messages, raw_files, to_envelopes
from starloom.sources.star import JdbcStar, ParquetStar
from starloom.sources.tables import BatchTable, TelemetryTable, VersionedTable
from starloom.streaming import jobs
from seed import BATCH, ROWS, TOTAL, seed_snapshot

AT = dt.datetime(2026, 3, 9, 8, 0, 0, 500000)


@pytest.fixture
def root(spark):
    return f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"


def test_wire_names_and_roundtrip(spark):
    stage = telemetry.stage_rows(spark, [(AT, "bikes", "curation", "orders", "ok", 9, '{"k":[2]}')])
    line = json.loads(telemetry.to_wire(stage, "pipeline_events").first().value)
    assert line == {"event_ms": 1773043200500, "trace_id": "bikes", "pipeline": "curation", "stage": "orders", "status": "ok",
                    "duration_ms": 9, "payload": '{"k":[2]}'}
    errors = telemetry.error_rows(spark, [(AT, "t", "curation", "parse-failed", 'a "quote"\nline', None)])
    back = telemetry.from_wire(telemetry.to_wire(errors, "error_events"), "error_events")
    assert back.collect() == errors.collect()
    assert json.loads(telemetry.to_wire(errors, "error_events").first().value)["stack"] is None


def events(spark, n=3000):
    return spark.range(n).select(
        F.timestamp_seconds(1735689600 + F.col("id") * 7).alias("event_time"), F.lit("t").alias("trace_id"), F.lit("curation").alias("pipeline"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("stage"), F.lit("ok").alias("status"),
        (F.col("id") * 37 % 1009).alias("duration_ms"), F.lit("{}").alias("payload"))


def test_latency_states_do_not_depend_on_batches(spark):
    rows = events(spark)
    whole = telemetry.latency_states(rows)
    parts = telemetry.latency_states(rows.where("duration_ms < 200"), 1).unionByName(telemetry.latency_states(rows.where("duration_ms >= 200"), 2))
    one = {r.stage: r for r in telemetry.latency_report(whole).collect()}
    two = {r.stage: r for r in telemetry.latency_report(telemetry.merge_states(parts, ["hour", "pipeline", "stage"])).collect()}
    exact = {r.stage: r for r in telemetry.exact_latency(rows, ["stage"]).collect()}
    for stage in ("a", "b"):
        assert one[stage].events == two[stage].events == exact[stage].events
        for name in telemetry.NAMES:
            for sketch in (one, two):
                assert abs(sketch[stage][name] - exact[stage][name]) <= 0.02 * 1009


def test_recent_errors_and_append(spark, root):
    rows = telemetry.error_rows(spark, [(dt.datetime(2026, 1, d), str(d), "s", "c", "m", "") for d in range(1, 15)])
    assert [r.trace_id for r in telemetry.recent_errors(rows).collect()] == [str(d) for d in range(14, 4, -1)]
    table = TelemetryTable(spark, root, rows.schema, (), ("service", "error_code", "event_time"))
    for _ in range(2):                                      # a retried batch replaces itself
        table.append(rows, "first")
    table.append(rows.limit(1), "second")
    for stored in (spark.read.parquet(root), table.read()):
        assert stored.count() == 15 and stored.where("event_date = date'2026-01-03'").count() == 1
    assert all("event_date=2026-01-0" in f for f in table.read().where("event_date < date'2026-01-10'").inputFiles()[:1])
    assert telemetry.landed_traces(rows, ["1", "2", "x"]).first().found == 2


def test_lineage_of_both_jobs(spark):
    log = None
    for job, (inputs, outputs) in lineage.job_datasets().items():
        for kind in ("START", "COMPLETE", "FAIL"):
            event = lineage.run_events(spark, kind, job, "0af7651916cd43dd8448eb211c80319c", inputs, outputs, dt.datetime(2026, 7, 25, 12))
            log = event if log is None else log.unionByName(event)
    log = lineage.from_json_lines(lineage.to_json_lines(log)).cache()
    assert {(r.eventType, len(r.outputs)) for r in log.where("job.name = 'curation'").collect()} == {("START", 0), ("COMPLETE", 10), ("FAIL", 0)}
    first = log.first()
    assert first.run.runId == "0af76519-16cd-43dd-8448-eb211c80319c" and first.eventTime == "2026-07-25T12:00:00.000Z"
    assert lineage.edges(log).count() == 190 and lineage.datasets(log).count() == 29 and lineage.jobs(log).count() == 2
    reach = lineage.impact(log, "oltp.OltpDb.dbo.Customers").groupBy("depth").count().collect()
    assert sorted(map(tuple, reach)) == [(1, 10), (2, 9)]


def test_versioned_and_batch_tables(spark, root):
    table = VersionedTable(spark, f"{root}/v", STAR_SCHEMAS["dim_carrier"])
    assert table.read().count() == 0
    table.replace(spark.createDataFrame([(1, "a", "s")], STAR_SCHEMAS["dim_carrier"]))
    table.replace(table.read().unionByName(spark.createDataFrame([(2, "b", "s")], STAR_SCHEMAS["dim_carrier"])))
    assert table.read().count() == 2 and table.versions() == [0, 1]
    for _ in range(2):                                      # a batch is applied once
        table.replace(table.read().unionByName(spark.createDataFrame([(3, "c", "s")], STAR_SCHEMAS["dim_carrier"])), "run-7")
    assert table.read().count() == 3 and table.versions() == [0, 1, 2] and table.last_batch() == "run-7"
    log = BatchTable(spark, f"{root}/b", STAR_SCHEMAS["dim_carrier"])
    for _ in range(2):
        log.append(table.read(), "a-5")
    assert log.read().count() == 3 and log.batches() == ["a-5"] and log.read().first().batch_id == "a-5"
    log.append(table.read().limit(1), "b-5")
    assert log.read().count() == 4


def test_folder_table_rewrites_changed_days_and_forgets_old_versions(spark, root):
    """Twelve loads: only changed days are made again, a bounded number of versions stays, a reader of the last one goes on."""
    import os
    from pyspark.sql import types as T
    from starloom.sources.tables import FolderTable

    shape = T.StructType().add("id", "long").add("v", "long").add("day", "integer")
    table = FolderTable(spark, f"{root}/days", shape, ("day",))
    rows = lambda n: [(i, n if i % 5 == n % 5 else 0, None if i % 5 == 4 else i % 5) for i in range(20)]
    before = None
    for n in range(12):
        now = rows(n) if n != 6 else [r for r in rows(n) if r[2] != 2]                     # a day that vanishes and comes back
        table.replace(spark.createDataFrame(now + now[:1], shape))                         # with a repeated row
        assert sorted(table.read().collect(), key=str) == sorted(spark.createDataFrame(now + now[:1], shape).collect(), key=str)
        if before:
            assert len(before.collect()) in (17, 21)                                       # one version back
        before = table.read()
        made = table.folders()
        assert set(made) == ({"0", "1", "2", "3", None} if n != 6 else {"0", "1", "3", None})
        if n not in (0, 1, 6, 7):
            assert sum(m == n for m in made.values()) == 2                                 # the day set to n and the one set back to 0
    assert table.versions() == [9, 10, 11] and len([f for f in os.listdir(f"{root}/days") if f.startswith("write=")]) <= 7
    same = table.folders()
    table.replace(table.read())
    assert table.folders() == same and table.read().where("day = 1").count() == table.read().where("day is not null and day = 1").count() > 0
    empty = FolderTable(spark, f"{root}/none", shape, ("day",))
    assert empty.read().count() == 0 and empty.replace(spark.createDataFrame([], shape)).count() == 0
    months = FolderTable(spark, f"{root}/months", T.StructType().add("id", "long").add("key", "integer"), ("key",), months=True)
    months.replace(spark.createDataFrame([(1, 20260101), (2, 20260131), (3, 20260201), (4, None)], months.schema))
    months.replace(spark.createDataFrame([(1, 20260101), (2, 20260131), (5, 20260201), (4, None)], months.schema))
    assert months.folders() == {"202601": 0, "202602": 1, None: 0} and sorted(r.id for r in months.read().collect()) == [1, 2, 4, 5]
    plain = VersionedTable(spark, f"{root}/plain", shape)
    for n in range(6):
        plain.replace(spark.createDataFrame([(n, n, n)], shape))
    assert plain.versions() == [3, 4, 5] and plain.read().first().id == 5


def mart_tables(spark):
    dim = spark.createDataFrame([(1, 100, "Ada", "a", 1, 1), (2, 300, "Cleo", "c", 1, 1)],
                                "customer_sk bigint, customer_id bigint, display_name string, email string, status int, is_current int")
    return dim, spark.createDataFrame([(10, 1, 20260701, 100.0)], "order_id bigint, customer_sk bigint, order_date_key int, total_usd double")


def test_source_options_and_conform_job(spark, root):
    for make in (lambda: ParquetStar("", ""), lambda: ParquetStar("x", ""), lambda: JdbcStar("")):
        with pytest.raises(ValueError, match="set "):
            make()
    dim, fact = mart_tables(spark)
    dim.write.parquet(f"{root}/dim")
    fact.write.parquet(f"{root}/fact")
    options = conform.parser().parse_args(["--dim-customer-path", f"{root}/dim", "--fact-order-path", f"{root}/fact", "--output", f"{root}/mart"])
    for _ in range(2):
        assert conform.build(spark, conform.star_of(options), options.output) == 2
    assert [r.customer_sk for r in spark.read.parquet(f"{root}/mart").collect()] == [1, 2]
    assert isinstance(conform.star_of(conform.parser().parse_args(["--source", "jdbc", "--jdbc-url", "u", "--output", "o"])), JdbcStar)
    assert spark.read.parquet(f"{root}/mart").count() == 2


def test_jdbc_source(spark):
    """In-process database: dim_customer and fact_order over JDBC give the same mart."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    dim, fact = mart_tables(spark)
    options = {"url": url, "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    dim.write.format("jdbc").options(**options, dbtable="dwh.dim_customer").save()
    fact.write.format("jdbc").options(**options, dbtable="dwh.fact_order").save()
    star = JdbcStar(url, ranges=2, options={"driver": options["driver"], "user": "dwh", "password": "x"})
    got = marts.customer_360(*star.read(spark))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, marts.customer_360(dim, fact).collect()))


def raw_of(spark, entity, batch=0):
    spec = CATALOG[entity]
    rows = seed_snapshot(spark)[entity].select(*[F.col(f.name).alias(f.source) for f in spec.fields], "offset")
    return to_envelopes(rows, spec, F.col("offset") + batch * 1000, "c", 1000)


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_curation_stream_resume_replay_and_star_load(spark, root):
    store = jobs.CuratedStore(spark, f"{root}/curated")
    start = lambda checkpoint, target: drain(jobs.start_curation(
        raw_files(spark, f"{root}/raw", True, 3), target, f"{root}/{checkpoint}", jobs.drain(), "trace", BATCH))
    for spec in CATALOG:
        raw_of(spark, spec.entity).coalesce(1).write.mode("append").json(f"{root}/raw")
    start("cp", store)
    assert store.records.read().count() == TOTAL and store.errors.read().count() == 0 and store.lags.read().count() == TOTAL
    assert {r.stage for r in store.stages.read().collect()} == {*CATALOG.entities, "drain"}
    bad = spark.createDataFrame([(CATALOG["orders"].raw_topic, None, "{x", 0, 9000, None)], RAW_SCHEMA)
    raw_of(spark, "customers", 1).unionByName(bad).coalesce(1).write.mode("append").json(f"{root}/raw")
    start("cp", store)                                      # resumes: only the new file is read
    more = TOTAL + 6                                        # five customers again and the bad row
    assert {r.event_date for r in store.lags.read().collect()} == {BATCH.date()}
    assert store.records.read().count() == more and [r.error_code for r in store.errors.read().collect()] == ["parse-failed"]
    raw_of(spark, "orders", 2).coalesce(1).write.mode("append").json(f"{root}/raw")
    start("cp2", store)                                     # a fresh checkpoint replays everything, the new file included
    assert store.records.read().count() == 2 * more + 3 and store.current().count() == more + 3
    snapshots = store.snapshots()
    assert sum(df.count() for df in snapshots.values()) == TOTAL
    assert {r.offset for r in snapshots["customers"].collect()} == set(range(1000, 1005))
    assert {r.offset for r in snapshots["orders"].collect()} == set(range(2000, 2003))
    star, log, lines = StarStore(spark, f"{root}/star"), LoadLog(spark, f"{root}/log"), lineage.LineageLog(spark, f"{root}/lineage")
    ticks = spark.readStream.schema(RAW_SCHEMA).json(f"{root}/raw")
    drain(jobs.start_star_load(ticks, store, star, f"{root}/cp3", jobs.drain(), "trace", lambda b: BATCH, log, lines))
    assert star["fact_inventory_snap"].read().count() == 8
    assert log.stages.read().count() == 10 and log.errors.read().count() == 0
    assert [(r.eventType, r.job.name, len(r.outputs)) for r in lines.read().orderBy("eventTime").collect()] == [("START", "warehouse-sink", 0), ("COMPLETE", "warehouse-sink", 9)]
    messages = curated_messages(store.entity("orders"), CATALOG["orders"])
    assert json.loads(messages.orderBy("key").first().value)["totalUsd"] == "713.25"


def test_curation_runs_on_stops_and_starts_again(spark, root):
    """The continuous trigger: messages that come while the query runs, a stop, more messages, a start on the same checkpoint."""
    store, bad = jobs.CuratedStore(spark, f"{root}/curated"), spark.createDataFrame([(CATALOG["orders"].raw_topic, None, "{x", 0, 9000, None)], RAW_SCHEMA)
    raw_of(spark, "customers").coalesce(1).write.json(f"{root}/raw")
    for rows in (raw_of(spark, "orders"), raw_of(spark, "customers", 1).unionByName(bad)):
        query = jobs.start_curation(raw_files(spark, f"{root}/raw", True), store, f"{root}/cp", jobs.continuous(), "trace", BATCH)
        query.processAllAvailable()
        rows.coalesce(1).write.mode("append").json(f"{root}/raw")
        query.processAllAvailable()
        assert query.isActive
        query.stop()
        assert query.exception() is None
    assert store.records.read().count() == len(ROWS["customers"]) * 2 + len(ROWS["orders"]) + 1 and store.errors.read().count() == 1
    drained = [json.loads(r.payload) for r in store.stages.read().where("stage = 'drain'").orderBy("batch_id").collect()]
    assert drained == [{"customers": 5}, {"orders": 3}, {"customers": 5}]
    assert {(r.stage, r.payload) for r in store.stages.read().where("stage <> 'drain'").collect()} == {("customers", '{"entity":"customers","records":5}'), ("orders", '{"entity":"orders","records":3}')}


def test_latest_in_state_keeps_the_newest_over_restarts(spark, root):
    rows = spark.range(200).select((F.col("id") * 7 % 11).alias("k"), F.col("id").alias("offset"), (F.col("id") * 3).alias("v"))
    store = jobs.LatestStore(spark, f"{root}/latest", rows.schema, ["k"], ["offset"])
    for part in ("offset >= 100", "offset < 100"):                        # the second start brings older rows only
        rows.where(part).repartition(2).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        drain(jobs.start_latest_in_state(stream, store, f"{root}/cp"))
        assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, latest_per_key(rows.where("offset >= 100"), ["k"], ["offset"]).collect()))
    last = store.deltas.read([store.deltas.batches()[-1]])
    assert last.count() and last.where("offset < 100").count() == 0       # a late batch gives what the state already held


def test_latest_stream_equals_batch_for_any_split(spark, root):
    rows = spark.range(200).select((F.col("id") * 7 % 11).alias("k"), F.col("id").alias("offset"), (F.col("id") * 3).alias("v"))
    rows.repartition(6).write.parquet(f"{root}/in")
    want = sorted(map(tuple, latest_per_key(rows, ["k"], ["offset"]).collect()))
    for files in (1, 6):
        store = jobs.LatestStore(spark, f"{root}/latest{files}", rows.schema, ["k"], ["offset"])
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
        drain(jobs.start_latest(stream, store, f"{root}/cp{files}"))
        assert sorted(map(tuple, store.read().collect())) == want
        store.compact()
        assert sorted(map(tuple, store.read().collect())) == want


def test_late_rows_are_merged_not_dropped(spark, root):
    states = jobs.latency_store(spark, f"{root}/states")
    schema = events(spark, 1).schema
    for part in (events(spark, 600).where("duration_ms >= 500"), events(spark, 600).where("duration_ms < 500")):
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        drain(jobs.start_latency(stream, states, f"{root}/cp"))
    assert sum(r.events for r in telemetry.latency_report(states.read()).collect()) == 600 and states.pieces() == 2


def test_latency_states_of_parts_a_newer_run_does_not_read_stay(spark, root):
    states, rows = jobs.latency_store(spark, f"{root}/states"), events(spark, 300)
    total = lambda: sum(r.events for r in telemetry.latency_report(states.read()).collect())
    stream = lambda name: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
    rows.repartition(2).write.parquet(f"{root}/old")
    rows.limit(50).coalesce(1).write.parquet(f"{root}/other")
    for run, (source, want) in enumerate((("old", 300), ("other", 350), ("old", 350))):          # a second source, then a replay of the first
        drain(jobs.start_latency(stream(source), states, f"{root}/cp-{run}"))
        assert total() == want
    names = states.table.batches()
    newest = [b for b in names if b.startswith(names[-1].rpartition("-")[0])]
    states.table.drop(newest[1:])                                                             # as in the middle of the replay
    assert total() == 350


def offsets(spark, first, last, partition, value=1):
    """Wire lines of one topic partition; the duration tells which reading of an offset was counted."""
    rows = spark.range(first, last).select(
        F.timestamp_seconds(1735689600 + F.col("id") * 60).alias("event_time"), F.lit("t").alias("trace_id"), F.lit("curation").alias("pipeline"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("stage"), F.lit("ok").alias("status"), F.lit(value).cast("bigint").alias("duration_ms"), F.lit("{}").alias("payload"), "id")
    return rows.withColumns({"topic": F.lit("events"), "partition": F.lit(partition), "offset": F.col("id"), "source": F.lit(f"events-{partition}"), "position": F.col("id")})


def test_states_by_offset_count_every_row_once(spark, root):
    """Random replays from random offsets with compaction between: always each offset once."""
    import random
    from starloom.streaming.states import LatencyStates

    draw = random.Random(3)
    for trial in range(1):
        states, reached, run = LatencyStates(spark, f"{root}/states-{trial}"), [0, 0], 0
        for run in range(3):
            at = [0, 0] if run == 0 else [draw.randrange(r) for r in reached]          # earlier messages have expired
            for number in range(4):
                batch = None
                for part in (0, 1):
                    to = at[part] + draw.randrange(1, 9)
                    rows, at[part] = offsets(spark, at[part], to, part, run), to
                    batch = rows if batch is None else batch.unionByName(rows)
                    reached[part] = max(reached[part], to)
                for _ in range(1 + (number == 1)):                                     # a batch done again replaces itself
                    states.append(batch, f"{run}-{number:010d}")
                if draw.random() < 0.4:
                    states.compact(2)
                assert sum(r.events for r in states.read().collect()) == sum(reached)
        before = sum(r.events for r in states.read().collect())
        states.compact(2)
        assert states.compact(2) == 0 and states.pieces() <= 16 and sum(r.events for r in states.read().collect()) == before


def test_a_replay_replaces_exactly_what_it_covers(spark, root):
    from starloom.streaming.states import LatencyStates

    states = LatencyStates(spark, root)
    top = lambda: {r.hi for r in states.read().select(F.kll_sketch_get_quantile_double("sketch", F.lit(1.0)).alias("hi")).collect()}
    states.append(offsets(spark, 0, 10, 0, 1), "a-0000000000")
    states.append(offsets(spark, 10, 20, 0, 1), "a-0000000001")
    states.append(offsets(spark, 5, 15, 0, 7), "b-0000000000")                         # begins within one piece and ends within another
    assert top() == {1.0} and sum(r.events for r in states.read().collect()) == 20
    states.append(offsets(spark, 15, 25, 0, 7), "b-0000000001")                        # the second piece is covered now, the first never will be
    assert top() == {1.0, 7.0} and sum(r.events for r in states.read().collect()) == 25
    with pytest.raises(ValueError, match="together"):
        jobs.start_latency(events(spark, 1), states, f"{root}/cp", source=F.lit("x"))


def test_rows_without_a_file_need_a_position(spark, root):
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).option("numPartitions", 1).load()
    rows = ticks.select(F.col("timestamp").alias("event_time"), F.lit("p").alias("pipeline"), F.lit("s").alias("stage"), F.col("value").alias("duration_ms"), F.col("value").alias("offset"))
    states = jobs.latency_store(spark, f"{root}/states")
    bad = jobs.start_latency(rows, states, f"{root}/bad", jobs.periodic("1 second"))
    with pytest.raises(Exception, match="need source and position"):
        bad.awaitTermination(60)
    good = jobs.start_latency(rows, states, f"{root}/good", jobs.periodic("1 second"), F.lit("ticks"), F.col("offset"), compact_every=2)
    while (good.lastProgress or {"batchId": 0})["batchId"] < 4 and good.isActive:
        good.awaitTermination(1)
    good.stop()
    assert sum(r.events for r in states.read().collect()) >= 20 and good.exception() is None


def test_periodic_trigger_processes_and_stops(spark, root):
    spark.range(5).select("id").write.parquet(f"{root}/in")
    store = jobs.LatestStore(spark, f"{root}/latest", spark.range(1).schema, ["id"], ["id"])
    query = jobs.start_latest(spark.readStream.schema(spark.range(1).schema).parquet(f"{root}/in"), store, f"{root}/cp", jobs.periodic("1 second"))
    query.processAllAvailable()
    query.stop()
    assert store.read().count() == 5 and jobs.continuous() == {"processingTime": "0 seconds"}


def test_shared_folder_is_read_from_the_session():
    from types import SimpleNamespace

    session = lambda folder, master: SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=SimpleNamespace(master=master, applicationId="app"))
    assert shared_dir(session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        shared_dir(session(None, "yarn"))


def test_landed_messages_are_small_and_many(spark, tmp_path):
    """Raw messages take a fraction of their text on disk and are dealt over as many files as their number asks for."""
    from starloom.testbed.stream_queries import _land

    text = F.concat(F.lit('{"payload":{"op":"c","after":{"OrderId":'), F.col("id"), F.lit(',"Currency":"USD","TaxUsd":"0.00","ShippingUsd":"0.00"}}}'))
    rows = spark.range(0, 600_000, 1, 1).select(F.lit("t").alias("topic"), F.lit(None).cast("string").alias("key"), text.alias("value"), F.lit(0).alias("partition"),
                                                F.col("id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))
    assert _land(rows, f"{tmp_path}/raw") == 6
    assert sum(f.stat().st_size for f in (tmp_path / "raw").iterdir()) < 0.2 * rows.agg(F.sum(F.length("value"))).first()[0]
    assert raw_files(spark, f"{tmp_path}/raw").agg(F.count("value"), F.sum("offset")).first() == (600_000, 600_000 * 599_999 // 2)


def test_entity_of_two_runs_reads_its_own_columns(spark, root):
    """After a replay an entity is reduced over its own rows and columns alone, and the newest run counts, also where it quarantines."""
    store, spec = jobs.CuratedStore(spark, f"{root}/curated"), CATALOG["orders"]
    raw = raw_of(spark, "orders").unionByName(raw_of(spark, "customers"))
    worse = raw.withColumn("value", F.when((F.col("topic") == spec.raw_topic) & (F.col("offset") == raw_of(spark, "orders").agg(F.min("offset")).first()[0]), F.lit("{x")).otherwise(F.col("value")))
    for run, rows in (("1-a", raw), ("2-b", worse)):
        store.records.append(curate.classify(rows, BATCH), f"{run}-{0:010d}")
    assert store.entity("orders").count() == raw_of(spark, "orders").count() - 1 and store.entity("customers").count() == raw_of(spark, "customers").count()
    plan = store.entity("orders")._jdf.queryExecution().sparkPlan().toString()
    assert "displayName" not in plan and "totalUsd" in plan


def test_a_first_load_of_folders_is_written_once(spark, root, monkeypatch):
    """what no version precedes is neither compared nor stored before its folders are; it is read back as they hold it."""
    from pyspark.sql import types as T

    from starloom.sources import tables

    stored, materialize = [], tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, label: stored.append(set(df.columns)) or materialize(df, label))
    table = tables.FolderTable(spark, f"{root}/once", T.StructType().add("id", "long").add("key", "integer"), ("key",), months=True)
    rows = spark.createDataFrame([(1, 20260101), (2, 20260131), (3, 20260201), (4, None)], table.schema)
    assert sorted(tuple(r) for r in table.replace(rows).collect()) == [(1, 20260101), (2, 20260131), (3, 20260201), (4, None)]
    assert not any("id" in columns for columns in stored)
    table.replace(rows)
    assert table.folders() == {"202601": 0, "202602": 0, None: 0}


def test_a_version_of_several_parts_is_committed_with_its_last(spark, root):
    """readers see none of a version's parts before all are written."""
    table = VersionedTable(spark, f"{root}/parts", STAR_SCHEMAS["dim_carrier"], ("service_level",))
    rows = lambda *which: spark.createDataFrame([(n, f"c{n}", "s") for n in which], STAR_SCHEMAS["dim_carrier"])
    table.replace([rows(1), rows(2, 3), rows(4)])
    assert sorted(r.carrier_sk for r in table.read().collect()) == [1, 2, 3, 4]
    with pytest.raises(Exception, match="broken part"):
        table.replace([rows(5), rows(6).withColumn("carrier", F.raise_error(F.lit("broken part")).cast("string"))])
    assert table.versions() == [0] and sorted(r.carrier_sk for r in table.read().collect()) == [1, 2, 3, 4]
    table.replace([rows(7), rows(8)])
    assert table.versions() == [0, 1] and sorted(r.carrier_sk for r in table.read().collect()) == [7, 8]
