from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillmart.operators import mart
from tillmart.operators.envelope import to_raw
from tillmart.plans import jobs, sample, upkeep
from tillmart.plans.queries import QUERIES
from tillmart.session import fresh_dir, shared_dir
from tillmart.sources import messages, sinks
from tillmart.sources.tables import extract, jdbc_options
from tillmart.streaming import ingest, windows

AS_OF = sample.AS_OF
TOPICS = ("stores", "products", "customers", "purchases")


def columns(name):
    return {"dim_customer": ["customer_id", "full_name", "updated_at"],
            "fact_purchases": ["purchase_id", "total_amount", "raw_event_time"],
            "fact_purchase_items": ["purchase_id", "product_id", "quantity"],
            "dim_date": ["date_sk", "year_week"]}[name]


def test_stream_in_batches_equals_batch_and_survives_replay(spark, sample_dir, tmp_path):
    log = str(tmp_path / "log")
    root = str(tmp_path / "target")
    # Parquet detour keeps the JSON lines of a topic in a known split.
    for topic in ("customers", "purchases"):
        messages.publish_files(sample.envelopes(spark, sample_dir, topic).coalesce(1), log)
    jobs.ingest(messages.file_stream(spark, log, 1), root, AS_OF, TOPICS)
    layout = ingest.Layout(root)
    batches = ingest.read_raw(spark, layout, "purchases").select("batch_id").distinct().count()
    more = sample.envelopes(spark, sample_dir, "customers").withColumn(
        "event_time", F.lit("2001-12-01T00:00:00+03:00"))
    messages.publish_files(more.coalesce(1), log)
    jobs.ingest(messages.file_stream(spark, log, 1), root, AS_OF, TOPICS)  # restart

    everything = spark.read.schema(messages.ENVELOPE).json(log)
    assert batches == 1
    for name in ("dim_customer", "fact_purchases", "fact_purchase_items", "dim_date"):
        source = mart.TARGETS[name].source
        raw = to_raw(everything.where(F.col("topic") == source), source, AS_OF)
        want = mart.current(name, mart.build_target(name, raw, AS_OF, True)).select(*columns(name))
        got = ingest.read_mart(spark, layout, name, AS_OF).select(*columns(name))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), name

    before = ingest.read_raw(spark, layout, "customers").count()
    first = everything.where("topic = 'customers' and event_time not like '2001-12%'")
    replayed = ingest.read_raw(spark, layout, "customers").where(
        "event_time < timestamp '2001-11-01 00:00:00'").first().batch_id
    ingest.ingest_batch(first, replayed, layout, AS_OF, TOPICS)
    ingest.cascade_batch(spark, replayed, layout, AS_OF, TOPICS)
    assert ingest.read_raw(spark, layout, "customers").count() == before
    newest = ingest.read_mart(spark, layout, "dim_customer", AS_OF)
    assert newest.where("updated_at <> timestamp_ntz '2001-12-01 00:00:00'").count() == 0


def test_published_documents_to_features(spark, sample_dir, tmp_path):
    """Publish, ingest, compact and run the feature job; equal to the direct build."""
    from tillmart.entities import ENTITIES
    from tillmart.operators.features import customer_features
    from tillmart.sources.tables import parquet_reader

    log, root, out = (str(tmp_path / n) for n in ("log", "target", "mart"))
    for topic in TOPICS:
        messages.publish_files(sample.envelopes(spark, sample_dir, topic).coalesce(1), log)
    jobs.ingest(messages.file_stream(spark, log), root, AS_OF)
    jobs.publish_mart(spark, root, AS_OF, out)
    months = spark.read.parquet(f"{out}/fact_purchases").select("purchase_month").distinct().count()
    assert months > 12
    written = jobs.run_features(parquet_reader(spark, out), AS_OF, formats=("csv",),
                                folder=str(tmp_path / "result"), dedupe=False)
    got = spark.read.csv(written["csv"], header=True)

    raw = {t: sample.raw_table(spark, sample_dir, t) for t in ENTITIES}
    built = mart.build_mart(raw, AS_OF)
    direct = customer_features(jobs.feature_inputs(lambda n: built[n], False), AS_OF)
    want = direct.drop("customer_sk", "created_at")
    assert got.columns == want.columns
    rows = [["" if v is None else str(v) for v in r] for r in want.collect()]
    assert sorted(["" if v is None else v for v in r] for r in got.collect()) == sorted(rows)


def test_bad_messages_go_to_dead_letters(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [("customers", json.dumps({"customer_id": "a"}), "2026-01-01T00:00:00Z"),
            ("customers", "{", "2026-01-01T00:00:00Z"), ("customers", None, None),
            ("other", "{}", "2026-01-01T00:00:00Z")]
    messages.publish_files(spark.createDataFrame(rows, messages.ENVELOPE).coalesce(1), log)
    root = str(tmp_path / "target")
    moments = []

    def now(batch_id):
        moments.append(batch_id)
        return AS_OF

    jobs.ingest(messages.file_stream(spark, log), root, now, ("customers",))
    dead = ingest.read_dead_letters(spark, ingest.Layout(root)).collect()
    assert sorted(r.reject_reason for r in dead) == ["invalid json", "missing json_data", "unknown topic"]
    raw = ingest.read_raw(spark, ingest.Layout(root), "customers").collect()
    assert [(r.customer_id, r.event_time) for r in raw] == [("a", datetime(2026, 1, 1, 3))]
    assert moments == [0]


def test_reading_before_the_first_batch(spark, tmp_path):
    layout = ingest.Layout(str(tmp_path / "none"))
    assert ingest.read_raw(spark, layout, "stores").count() == 0
    assert ingest.read_mart(spark, layout, "fact_purchases", AS_OF).count() == 0


def test_hourly_counts_over_several_batches(spark, tmp_path):
    folder = str(tmp_path / "events")
    for day in (1, 2, 3):
        rows = [(f"2026-01-0{day} {h:02d}:15:00", "a") for h in (1, 1, 5)] + [("2026-01-01 01:59:59", "a")]
        spark.createDataFrame(rows, "t string, topic string").selectExpr(
            "cast(t as timestamp_ntz) as ts", "topic").coalesce(1).write.mode("append").parquet(folder)
    events = spark.readStream.schema("ts timestamp_ntz, topic string").option(
        "maxFilesPerTrigger", 1).parquet(folder)
    windows.start_hourly_counts(events, str(tmp_path / "rows"), str(tmp_path / "state"), "topic", "ts").awaitTermination()
    got = {str(r.time): r.records for r in windows.read_hourly_counts(spark, str(tmp_path / "rows")).collect()}
    assert got["2026-01-01 01:00:00"] == 5 and got["2026-01-03 05:00:00"] == 1 and len(got) == 6


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    folder = str(tmp_path / "events")
    for _ in range(2):
        spark.range(50).selectExpr("id", "timestamp_ntz '2026-01-01 00:00:00' + id * interval '1' minute as ts"
                                   ).coalesce(1).write.mode("append").parquet(folder)
    events = spark.readStream.schema("id bigint, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(folder)
    windows.start_unique(events, str(tmp_path / "rows"), str(tmp_path / "state"), "id", "ts").awaitTermination()
    stored = sinks.read_batches(spark, str(tmp_path / "rows"), events.schema)
    assert stored.count() == 50 == stored.select("id").distinct().count()


def test_newest_prefers_later_batches_on_ties(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, value in ((0, "old"), (1, "new")):
        sinks.write_batch(spark.createDataFrame([(1, 5, value)], "k int, v int, x string"), path, batch)
    schema = spark.createDataFrame([], "k int, v int, x string").schema
    assert ingest.newest(spark, path, schema, "k", "v").first().x == "new"


def test_result_sinks(spark, tmp_path, sample_dir):
    df = spark.createDataFrame([("c1", 1, 1, "2026")], "customer_id string, customer_sk int, n int, created_at string")
    spark.sql("create table result (customer_id string, customer_sk int, n int, created_at string) using parquet")
    spark.sql("insert into result values ('old', 0, 0, '')")
    written = sinks.write_results(df, "2026-03-08", folder=str(tmp_path), table="result")
    assert written["csv"].endswith("analytic_result_2026_03_08.csv")
    assert written["json"].endswith("analytic_result_2026_03_08.json")
    assert spark.read.csv(written["csv"], header=True).columns == ["customer_id", "n"]
    assert spark.read.json(written["json"]).first().customer_id == "c1"
    assert [r.customer_id for r in spark.table("result").collect()] == ["c1"]
    with pytest.raises(RuntimeError):
        sinks.replace_table(df, "missing_table")
    with pytest.raises(ValueError):
        sinks.write_results(df, "2026-03-08", ("xml",), str(tmp_path))
    exported = sinks.export_results(df, str(tmp_path / "store"), "2026-03-08")
    assert exported["csv"] == sinks.export_path(str(tmp_path / "store"), "csv", "2026-03-08")
    assert spark.read.csv(exported["csv"], header=True).count() == 1
    assert sinks.export_path("scheme://bucket/", "csv", datetime(2026, 3, 8)) == (
        "scheme://bucket/analytics/analytic_result_2026_03_08.csv")


def test_feature_job_end_to_end(spark, sample_dir, tmp_path):
    from tillmart.entities import ENTITIES

    raw = {t: sample.raw_table(spark, sample_dir, t) for t in ENTITIES}
    built = mart.build_mart(raw, AS_OF)
    twice = {n: df.unionByName(df) for n, df in built.items()}
    paths = [jobs.run_features(lambda n, t=tables: t[n], AS_OF, formats=("json",),
                               folder=str(tmp_path / label))["json"]
             for label, tables in (("once", built), ("twice", twice))]
    once, doubled = (sorted(r.asDict().items() for r in spark.read.json(p).collect()) for p in paths)
    assert len(once) > 0 and sorted(map(str, once)) == sorted(map(str, doubled))


def test_jdbc_options():
    split = jdbc_options("jdbc:x", "t", "id", 0, 100, 8, user="u")
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "id" and split["user"] == "u"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")
    assert set(extract(lambda name: name)) == {"purchases", "items", "customers", "products", "stores", "dates"}


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")
    assert fresh_dir(spark, "a").startswith(configured)


STREAMED = [n for n in QUERIES if n.startswith("stream_")]


@pytest.fixture(scope="module")
def many_files(spark, sample_dir, tmp_path_factory):
    """The sample tables, those that are streamed as eight shuffled files each."""
    folder = tmp_path_factory.mktemp("tables")
    for name in ("region", "nation", "lineitem"):
        (folder / f"{name}.parquet").symlink_to(f"{sample_dir}/{name}.parquet")
    for name in ("events", "orders", "part", "customer", "supplier"):
        table = spark.read.parquet(f"{sample_dir}/{name}.parquet")
        table.orderBy(F.xxhash64(*table.columns[:2])).repartition(8).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", STREAMED)
def test_streams_do_not_depend_on_the_file_layout(spark, sample_dir, many_files, name):
    one, many = (sorted(map(str, QUERIES[name].run(spark, d).collect())) for d in (sample_dir, many_files))
    assert one and one == many


def test_newest_version_of_a_batch_survives(spark, tmp_path):
    rows = [(k, v, f"v{v}") for k in range(50) for v in (2, 1, 3)]
    spark.createDataFrame(rows, "k int, v int, x string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, v int, x string").parquet(str(tmp_path / "in"))
    ingest.upsert_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"), ["k"], "v").awaitTermination()
    stored = ingest.newest(spark, str(tmp_path / "out"), stream.schema, "k", "v")
    assert {r.x for r in stored.collect()} == {"v3"} and stored.count() == 50
    with pytest.raises(ValueError):
        ingest.upsert_stream(stream, str(tmp_path / "o"), str(tmp_path / "s"), ["k"])


def test_later_batch_wins_ties_in_the_mart_and_constants_are_refused(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "root")
    for name in ("zoe", "anna"):
        doc = json.dumps({"customer_id": "c1", "first_name": name})
        messages.publish_files(spark.createDataFrame([("customers", doc, "2001-01-01T00:00:00+03:00")], messages.ENVELOPE).coalesce(1), log)
        jobs.ingest(messages.file_stream(spark, log, 1), root, AS_OF, ("customers",))
    layout = ingest.Layout(root)
    assert [r.first_name for r in ingest.read_mart(spark, layout, "dim_customer", AS_OF).collect()] == ["anna"]
    with pytest.raises(ValueError):
        jobs.ingest(messages.file_stream(spark, log), str(tmp_path / "run"), AS_OF, once=False)
    assert upkeep.compact_versions(spark, root, "dim_customer", AS_OF) == 2
    assert [r.first_name for r in ingest.read_versions(spark, layout, "dim_customer", AS_OF).collect()] == ["anna"]


def test_retention_can_be_repeated_after_a_failure(spark, tmp_path, monkeypatch):
    log, root = str(tmp_path / "log"), str(tmp_path / "root")
    for day in range(1, 28):
        rows = [("customers", json.dumps({"customer_id": f"c{day}"}), f"2001-0{m}-{day:02d}T00:00:00+03:00") for m in (5, 6, 7)]
        rows.append(("customers", "{", f"2001-0{1 + day % 7}-{day:02d}T00:00:00+03:00"))
        messages.publish_files(spark.createDataFrame(rows, messages.ENVELOPE).coalesce(1), log)
    jobs.ingest(messages.file_stream(spark, log, 9), root, AS_OF, ("customers",), with_mart=False)
    layout = ingest.Layout(root)
    dead = [r.event_time for r in ingest.read_dead_letters(spark, layout).collect()]
    delete, calls = upkeep.delete, []

    def failing(session, path):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("lost")
        delete(session, path)

    monkeypatch.setattr(upkeep, "delete", failing)
    with pytest.raises(OSError):
        upkeep.apply_retention(spark, root, AS_OF, 45, ("customers",))
    upkeep.apply_retention(spark, root, AS_OF, 45, ("customers",))
    kept = sorted(r.event_time for r in ingest.read_raw(spark, layout, "customers").collect())
    assert kept[0] == datetime(2001, 6, 18) and len(kept) == 10 + 27
    assert sorted(r.event_time for r in ingest.read_dead_letters(spark, layout).collect()) == sorted(t for t in dead if t >= "2001-06-18")


def test_table_sizes_are_those_of_the_files(spark, sample_dir):
    from pathlib import Path

    from tillmart.operators.monitoring import table_sizes

    sizes = table_sizes({n: spark.read.parquet(f"{sample_dir}/{n}.parquet") for n in ("events", "part")}).collect()
    for row in sizes:
        assert row.size_mb == Path(f"{sample_dir}/{row.table}.parquet").stat().st_size / 2**20


def test_exports_leave_the_result_kept_for_the_other_sinks(spark, tmp_path, monkeypatch):
    kept, write = [], sinks.write_dated

    def noted(df, *args):
        kept.append(df.storageLevel.useDisk)
        return write(df, *args)

    monkeypatch.setattr(sinks, "write_dated", noted)
    df = spark.range(3).selectExpr("id as customer_id", "id as customer_sk")
    formats = ("csv", "json", "export")
    written = sinks.write_results(df, "2026-03-08", formats, str(tmp_path), export_root=str(tmp_path / "store"))
    assert set(written) == {"csv", "json", "export_csv", "export_json"} and kept == [True] * 4
    assert not df.storageLevel.useDisk
    df.persist()
    sinks.write_results(df, "2026-03-08", ("csv",), str(tmp_path))
    assert df.storageLevel.useDisk
    df.unpersist()
