"""Upkeep that fails at any step, ingest in between, and streams of flat cost."""

from __future__ import annotations

import json
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tillmart.operators import mart
from tillmart.plans import jobs, sample, upkeep
from tillmart.sources import folders, messages, sinks
from tillmart.streaming import ingest, windows

AS_OF = sample.AS_OF


def send(spark, root, rows):
    messages.publish_files(spark.createDataFrame(rows, messages.ENVELOPE).coalesce(1), f"{root}/log")


def take(spark, root, with_mart=False):
    jobs.ingest(messages.file_stream(spark, f"{root}/log", 1), root, AS_OF, ("customers",), with_mart=with_mart)


def customer(number, day, month=6, name="ann"):
    return ("customers", json.dumps({"customer_id": f"c{number}", "first_name": name}), f"2001-{month:02d}-{day:02d}T00:00:00+03:00")


def names_of(spark, root):
    rows = ingest.read_mart(spark, ingest.Layout(root), "dim_customer", AS_OF).collect()
    return sorted((r.customer_id, r.first_name) for r in rows)


@pytest.fixture
def versions(spark, tmp_path):
    """Four batches of customers, some of them more than once."""
    root = str(tmp_path / "root")
    for batch in range(4):
        send(spark, root, [customer(10 * batch + k, 1 + batch) for k in range(10)] + [customer(0, 1 + batch, name=f"ann{batch}")])
        take(spark, root, True)
    return root


def test_replay_after_the_merge_loses_nothing(spark, versions):
    layout = ingest.Layout(versions)
    want = names_of(spark, versions)
    assert len(want) == 40 and ("c0", "ann3") in want
    assert upkeep.compact_versions(spark, versions, "dim_customer", AS_OF) == 4
    folders.delete(spark, f"{layout.checkpoint}/commits/3")
    take(spark, versions, True)
    assert folders.partition_values(spark, layout.mart("dim_customer"), "batch_id") == [3]
    assert names_of(spark, versions) == want
    send(spark, versions, [customer(0, 9, name="last"), customer(99, 9)])
    take(spark, versions, True)
    want = sorted([*[w for w in want if w[0] != "c0"], ("c0", "last"), ("c99", "ann")])
    assert names_of(spark, versions) == want
    assert upkeep.compact_versions(spark, versions, "dim_customer", AS_OF) == 1
    assert names_of(spark, versions) == want
    assert folders.partition_values(spark, layout.mart("dim_customer"), "batch_id") == []
    assert folders.partition_values(spark, layout.merged("dim_customer"), "merged_upto") == [4]
    assert upkeep.compact_versions(spark, versions, "dim_customer", AS_OF) == 0


def test_batches_that_are_not_committed_are_not_merged(spark, versions):
    layout = ingest.Layout(versions)
    folders.delete(spark, f"{layout.checkpoint}/commits/3")
    assert upkeep.compact_versions(spark, versions, "dim_customer", AS_OF) == 3
    take(spark, versions, True)
    assert len(names_of(spark, versions)) == 40


def test_merge_that_fails_anywhere_is_repeated(spark, versions, monkeypatch):
    layout = ingest.Layout(versions)
    want = names_of(spark, versions)
    real = folders.delete
    for step in range(1, 4):
        calls = []

        def failing(session, path, calls=calls, step=step):
            calls.append(path)
            if len(calls) == step:
                raise OSError("lost")
            real(session, path)

        monkeypatch.setattr(upkeep, "delete", failing)
        with pytest.raises(OSError):
            upkeep.compact_versions(spark, versions, "dim_customer", AS_OF)
        assert names_of(spark, versions) == want
    # A generation without its last file does not count.
    shutil.copytree(f"{layout.merged('dim_customer')}/merged_upto=3", f"{layout.merged('dim_customer')}/merged_upto=7",
                    ignore=shutil.ignore_patterns("_SUCCESS", "._SUCCESS.crc"))
    assert names_of(spark, versions) == want
    monkeypatch.setattr(upkeep, "delete", real)
    upkeep.compact_versions(spark, versions, "dim_customer", AS_OF)
    assert names_of(spark, versions) == want


def kept(spark, root):
    layout = ingest.Layout(root)
    rows = [(r.customer_id, r.event_time) for r in ingest.read_raw(spark, layout, "customers").collect()]
    dead = [r.event_time for r in ingest.read_dead_letters(spark, layout).collect()]
    return sorted(rows), sorted(dead)


LIMIT = datetime(2001, 6, 18)


@pytest.mark.parametrize("step", range(1, 12))
def test_retention_that_fails_anywhere_with_ingest_in_between(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "root")
    sent = []
    for batch in range(3):
        rows = [customer(100 * batch + d, d, m) for d in range(1 + batch, 28, 5) for m in (5, 6, 7)]
        rows += [("customers", "{", f"2001-0{m}-10T00:00:00+03:00") for m in (5, 7)]
        sent += rows
        send(spark, root, rows)
        take(spark, root)
    send(spark, root, only_old := [customer(900, 2)])
    take(spark, root)
    calls = []

    def failing(real):
        def call(session, *paths):
            calls.append(paths)
            if len(calls) == step:
                raise OSError("lost")
            real(session, *paths)
        return call

    monkeypatch.setattr(upkeep, "delete", failing(folders.delete))
    monkeypatch.setattr(upkeep, "move", failing(folders.move))
    try:
        upkeep.apply_retention(spark, root, AS_OF, 45, ("customers",))
        failed = False
    except OSError:
        failed = True
    monkeypatch.setattr(upkeep, "delete", folders.delete)
    monkeypatch.setattr(upkeep, "move", folders.move)
    # New messages, some in the range and some not, and a replay of the newest batches.
    send(spark, root, new := [customer(500 + d, d) for d in (3, 19, 25)] + [("customers", "{", "2001-06-01T00:00:00+03:00")])
    if step % 2:
        for batch in (2, 3):
            folders.delete(spark, f"{ingest.Layout(root).checkpoint}/commits/{batch}")
    take(spark, root)
    upkeep.apply_retention(spark, root, AS_OF, 45, ("customers",))
    rows = [(json.loads(text)["customer_id"], datetime.fromisoformat(time[:19]))
            for _, text, time in sent + only_old + new if text != "{"]
    dead = [time for _, text, time in sent + new if text == "{" and time >= "2001-06-18"]
    assert kept(spark, root) == (sorted(r for r in rows if r[1] >= LIMIT), sorted(dead))
    assert failed or step > 10
    assert not folders.exists(spark, f"{root}/_upkeep/raw-customers/intent")


def stream_of(spark, folder, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def test_repeats_are_told_from_state_not_from_history(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def more(rows):
        spark.createDataFrame(rows, "id long, v int, x string").coalesce(1).write.mode("append").parquet(folder)
        events = stream_of(spark, folder, "id long, v int, x string")
        windows.start_unique(events, out, str(tmp_path / "state"), "id", "v").awaitTermination()
        return sorted((r.batch_id, r.id, r.v, r.x) for r in sinks.read_batches(spark, out, events.schema).collect() if r.id is not None)

    assert more([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d"), (None, 1, "e"), (None, 1, "e")]) == [(0, 1, 3, "b"), (0, 2, 1, "d")]
    assert sinks.read_batches(spark, out, spark.createDataFrame([], "id long, v int, x string").schema).where("id is null").count() == 2
    folders.delete(spark, f"{out}/batch_id=0")  # history is not read
    assert more([(1, 9, "late"), (3, 1, "f"), (None, 1, "e")]) == [(1, 3, 1, "f")]
    folders.delete(spark, f"{tmp_path}/state/commits/1")  # and a replayed batch gives the same rows
    assert more([(2, 9, "late"), (3, 9, "late")]) == [(1, 3, 1, "f")]


def alert_percent(spark, path):
    return {r.table: r.duplicate_percent for r in windows.read_alerts(spark, path).collect()}


def test_alerts_from_running_totals(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def more(rows):
        spark.createDataFrame(rows, "t string, k long").coalesce(1).write.mode("append").parquet(folder)
        windows.start_alerts(stream_of(spark, folder, "t string, k long"), out, str(tmp_path / "state"), "t", "k").awaitTermination()
        return alert_percent(spark, out)

    assert more([("a", 1), ("a", 1), ("a", 1), ("b", 1), ("b", 2)]) == {"a": 66.67}
    assert more([("b", 1), ("b", 2), ("b", 2)]) == {"a": 66.67, "b": 60.0}
    folders.delete(spark, f"{tmp_path}/state/commits/1")  # a replay counts nothing twice
    assert more([("a", k) for k in range(10, 20)]) == {"b": 60.0}
    for batch in (0, 1):  # and only the batch before is read
        folders.delete(spark, f"{out}/totals/batch_id={batch}")
    assert more([("b", 1)]) == {"b": 66.67}


def test_late_rows_are_set_aside_and_none_is_lost(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "t string, ts timestamp_ntz"

    def more(*times):
        rows = spark.createDataFrame([("a", t) for t in times], "t string, s string").selectExpr("t", "cast(s as timestamp_ntz) as ts")
        rows.coalesce(1).write.mode("append").parquet(folder)
        windows.start_windows(stream_of(spark, folder, schema), out, str(tmp_path / "state"), "t", "ts", "1 hour").awaitTermination()
        closed, left = ({str(r.time): r.records for r in f(spark, out).collect()} for f in (windows.read_closed, windows.read_open))
        late = sorted(str(r.ts) for r in windows.read_late(spark, out, spark.createDataFrame([], schema).schema).collect())
        return closed, left, late

    assert more("2026-01-01 10:15:00", "2026-01-01 12:05:00") == ({}, {"2026-01-01 10:00:00": 1, "2026-01-01 12:00:00": 1}, [])
    # The mark is 11:05 now, so the hour of ten is final and takes no more.
    closed, left, late = more("2026-01-01 10:59:00", "2026-01-01 11:59:00", None)
    assert closed == {"2026-01-01 10:00:00": 1} and left == {"2026-01-01 11:00:00": 1, "2026-01-01 12:00:00": 1}
    assert late == ["2026-01-01 10:59:00", "None"]
    folders.delete(spark, f"{tmp_path}/state/commits/1")  # a replay gives the same
    assert more("2026-01-01 13:30:00")[2] == late
    closed, left, late = more("2026-01-01 12:31:00")
    assert closed == {"2026-01-01 10:00:00": 1, "2026-01-01 11:00:00": 1}
    assert left == {"2026-01-01 12:00:00": 2, "2026-01-01 13:00:00": 1}


def test_a_topic_is_read_once_for_its_targets(spark, sample_dir, tmp_path, monkeypatch):
    reads = []

    def counting(*args, **named):
        reads.append(args[1])
        return sinks.read_batch(*args, **named)

    monkeypatch.setattr(ingest, "read_batch", counting)
    plans = []

    def writing(df, path, batch_id, partitions=()):
        plans.append((path, df._jdf.queryExecution().executedPlan().toString()))
        sinks.write_batch(df, path, batch_id, partitions)

    root = str(tmp_path / "root")
    layout = ingest.Layout(root)
    ingest.ingest_batch(sample.envelopes(spark, sample_dir, "purchases"), 0, layout, AS_OF, ("purchases",))
    monkeypatch.setattr(ingest, "write_batch", writing)
    ingest.cascade_batch(spark, 0, layout, AS_OF, ("purchases",))
    assert reads == [layout.raw("purchases")] and len(plans) == 3
    assert all("InMemoryTableScan" in plan for _, plan in plans)


def test_a_batch_keeps_no_copies_of_its_messages_and_logs_are_compressed(spark, sample_dir, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(
        ingest, "write_batch",
        lambda df, *_: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    sent = sample.envelopes(spark, sample_dir, "customers")
    ingest.ingest_batch(sent, 0, ingest.Layout(str(tmp_path / "root")), AS_OF, ("customers",))
    assert len(plans) == 2 and not any("InMemoryTableScan" in plan for plan in plans)
    messages.publish_files(sent, str(tmp_path / "log"))
    assert list((tmp_path / "log").glob("*.json.gz")) and not list((tmp_path / "log").glob("part-*.json"))


def test_a_message_is_opened_once_and_rejected_ones_become_dead_letters(spark, tmp_path, monkeypatch):
    layout = ingest.Layout(str(tmp_path / "root"))
    bad = [("customers", "{", "t"), ("customers", "[1]", None), ("customers", None, "2001-06-19T00:00:00+03:00"), ("other", "{}", None)]
    sent = spark.createDataFrame([customer(k, 19) for k in (1, 2)] + bad, messages.ENVELOPE)
    plans, stop = [], [True]

    def writing(df, path, *args):
        plans.append((path, df._jdf.queryExecution().executedPlan().toString()))
        if path == layout.dead and stop:
            raise OSError("lost")
        sinks.write_batch(df, path, *args)

    monkeypatch.setattr(ingest, "write_batch", writing)
    with pytest.raises(OSError):
        ingest.ingest_batch(sent, 0, layout, AS_OF, ("customers",))
    assert kept(spark, layout.root)[0] == [("c1", datetime(2001, 6, 19)), ("c2", datetime(2001, 6, 19))]
    upkeep.apply_retention(spark, layout.root, AS_OF, 45, ("customers",))  # rows that wait have no month
    stop.clear()
    ingest.ingest_batch(sent, 0, layout, AS_OF, ("customers",))
    dead = ingest.read_dead_letters(spark, layout).collect()
    assert sorted((str(r.topic), str(r.json_data), str(r.event_time), r.reject_reason) for r in dead) == [
        ("customers", "None", "2001-06-19T00:00:00+03:00", "missing json_data"), ("customers", "[1]", "None", "not an object"),
        ("customers", "{", "t", "invalid json"), ("other", "{}", "None", "unknown topic")]
    assert sorted(r.customer_id for r in ingest.read_raw(spark, layout, "customers").collect()) == ["c1", "c2"]
    assert folders.names(spark, layout.raw("customers")) == ["event_month=200106"]
    opened = {path for path, plan in plans if "from_json" in plan}
    assert opened == {layout.raw("customers")}


def test_late_purchases_are_chosen_before_their_documents_are_made(spark, sample_dir):
    late = sample.envelopes(spark, sample_dir, "purchases", id_ends="7")
    every = sample.envelopes(spark, sample_dir, "purchases")
    want = every.where(F.get_json_object("json_data", "$.purchase_id").endswith("7"))

    def told(df):
        return sorted((len(r.json_data), sorted(r.json_data), r.event_time) for r in df.collect())

    assert told(late) == told(want) and 0 < late.count() < every.count()
    assert "get_json_object" not in plan_of(late) and "EndsWith" in plan_of(late)


def test_batches_are_packed_and_the_mart_reads_only_what_it_needs(spark, sample_dir, tmp_path, monkeypatch):
    layout = ingest.Layout(str(tmp_path / "root"))
    plans = []
    ingest.ingest_batch(sample.envelopes(spark, sample_dir, "purchases"), 0, layout, AS_OF, ("purchases",))
    assert all(p.name.endswith(".zstd.parquet") for p in (tmp_path / "root" / "raw").rglob("part-*"))
    whole = mart.build_target("fact_purchase_items", ingest.read_raw(spark, layout, "purchases"), AS_OF, True)
    monkeypatch.setattr(ingest, "write_batch", lambda df, path, *_: plans.append((path, plan_of(df), df.collect())))
    ingest.cascade_batch(spark, 0, layout, AS_OF, ("purchases",))
    assert len(plans) == 3 and not any(n in plan for _, plan, _ in plans for n in ("customer_first_name", "manufacturer_website"))
    rows = next(rows for path, _, rows in plans if path == layout.mart("fact_purchase_items"))
    assert sorted(map(str, rows)) == sorted(map(str, whole.collect())) and rows
