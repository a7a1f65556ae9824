"""Features from daily partials against the full job, the package away from its folder, one parse of a text."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tillmart.operators import features, partials
from tillmart.operators.envelope import json_path, json_paths
from tillmart.plans import sample
from tillmart.plans.queries import QUERIES

AS_OF = sample.AS_OF


def rows(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("grain", ["item", "purchase"])
def test_partials_add_up_to_the_full_job(spark, sample_dir, tmp_path, grain):
    tables = sample.mart_tables(spark, sample_dir)
    # Some purchases near as_of, so that the day windows hold something, and one without a time.
    stamp = F.expr("raw_event_time + make_dt_interval(datediff(timestamp_ntz '2001-07-30 00:00:00', raw_event_time) - cast(substr(purchase_id, 5) as int) % 20)")
    moved = F.when(F.col("purchase_id").endswith("2"), stamp).when(F.col("purchase_id") != "ord-1", F.col("raw_event_time"))
    tables["purchases"] = tables["purchases"].withColumn("raw_event_time", moved.cast("timestamp_ntz"))
    path = str(tmp_path / "partials")
    partials.refresh(tables | {"purchases": tables["purchases"].where("purchase_id not like '%4'")}, path, grain=grain)
    late = tables["purchases"].where("purchase_id like '%4'")
    partials.refresh(tables, path, partials.changed_months(late), grain)
    for as_of in (AS_OF, "2001-07-25"):
        want = features.customer_features(tables, as_of, grain)
        got = partials.features_from_partials(spark, path, tables, as_of, grain)
        assert got.schema.names == want.schema.names and rows(got) == rows(want)
    assert partials.metrics_from_partials(spark, path, tables["stores"], AS_OF, grain).where("spent_last_7d > 0").count() > 0


def test_a_refresh_leaves_other_months_and_reads_only_its_own(spark, sample_dir, tmp_path):
    tables, path = sample.mart_tables(spark, sample_dir), str(tmp_path / "partials")
    partials.refresh(tables, path)
    files = {p: p.stat().st_mtime_ns for p in Path(path).glob("*/purchase_month=*/*.parquet")}
    by_month = partials.with_purchase_month(tables["purchases"])
    by_month.write.partitionBy("purchase_month").parquet(str(tmp_path / "purchases"))
    stored = spark.read.parquet(str(tmp_path / "purchases"))
    partials.refresh(tables | {"purchases": stored}, path, [199505])
    now = {p: p.stat().st_mtime_ns for p in Path(path).glob("*/purchase_month=*/*.parquet")}
    changed = {p.parent.name for p in files.keys() ^ now.keys()} | {p.parent.name for p in files if now.get(p, files[p]) != files[p]}
    assert changed == {"purchase_month=199505"}
    assert "PartitionFilters: [isnotnull(purchase_month" in plan_of(stored.where(F.col("purchase_month").isin([199505])))
    assert rows(partials.features_from_partials(spark, path, tables, AS_OF)) == rows(features.customer_features(tables, AS_OF))


def test_the_incremental_query_stores_purchases_once_and_refreshes_read_months(spark, sample_dir, monkeypatch):
    """Their lines were counted anew for every read, and both refreshes read purchases of all months."""
    seen = []
    monkeypatch.setattr(partials, "refresh", lambda tables, path, *rest: seen.append((tables, rest)))
    monkeypatch.setattr(partials, "features_from_partials", lambda *args: args[2]["customers"])
    QUERIES["features_incremental"].run(spark, sample_dir)
    want = sample.mart_tables(spark, sample_dir)
    (first, none), (second, (months,)) = seen
    assert not none and 199505 in months and 199504 not in months
    for tables in (first, second):
        plan = plan_of(tables["purchases"].where(F.col("purchase_month").isin(months)))
        assert "PartitionFilters: [" in plan and "purchase_month" in plan
        assert "Aggregate" not in plan and "lineitem" not in plan and "lineitem" not in plan_of(tables["dates"])
    assert rows(second["purchases"].drop("purchase_month")) == rows(want["purchases"])
    assert rows(second["dates"]) == rows(want["dates"])


@pytest.mark.parametrize("grain", ["item", "purchase"])
def test_partials_of_odd_rows_add_up(spark, sample_dir, tmp_path, grain):
    """Purchases without lines, id or customer, and ids that come twice."""
    tables, path = sample.mart_tables(spark, sample_dir), str(tmp_path / "partials")
    for name, odd in (("purchases", "purchase_id like '%3'"), ("items", "purchase_id like '%5'"), ("products", "product_id like '%7'")):
        tables[name] = tables[name].unionAll(tables[name].where(odd))
    tables["items"] = tables["items"].where("purchase_id not like '%2'")
    tables["purchases"] = tables["purchases"].withColumns({
        "purchase_id": F.expr("if(purchase_id like '%9', null, purchase_id)"),
        "customer_id": F.expr("if(store_id = 'store-4', null, if(purchase_id like '%2', concat('cus-', substr(purchase_id, 5)), customer_id))"),
    })
    partials.refresh(tables, path, grain=grain)
    want = features.customer_metrics(tables, AS_OF, grain)
    got = partials.metrics_from_partials(spark, path, tables["stores"], AS_OF, grain)
    assert got.schema.names == want.schema.names and rows(got) == rows(want)
    assert want.where("unique_categories = 0 and total_purchases > 0").count() > 0


def test_paths_of_a_text_come_from_one_parse(spark):
    texts = ['{"a": {"b": [1, "x", {"c": null}]}, "d": 2.5}', "[7, [8]]", "no json", None, "{}", '{"a": {"b": {"c": "é"}}, "k.z": 1}']
    frame = spark.createDataFrame([(t,) for t in texts], "doc string")
    paths = {"first": "a.b.0", "second": "a.b.1", "deep": "a.b.2.c", "none": "z", "number": "d", "place": "1.0", "name": "a.b.c"}
    got = json_paths(frame, "doc", paths)
    one_by_one = frame.select("doc", *[json_path("doc", p).alias(n) for n, p in paths.items()])
    assert rows(got) == rows(one_by_one)
    assert plan_of(got).count("parseJson(") == 1


def test_the_package_runs_from_another_folder(tmp_path):
    """Workers find the package by the archive that the driver sends."""
    root = Path(__file__).resolve().parents[1]
    script = tmp_path / "job.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(root)!r})
from tillmart.session import build_session, ship_package
spark = build_session("ship", "local-cluster[1,1,1024]", spark__executor__memory="700m", spark__ui__enabled="false")
ship_package(spark)
def work(frames):
    import tillmart.functions.numbers
    yield from frames
    assert ".zip" in tillmart.__file__, tillmart.__file__
print("rows", spark.range(3).mapInPandas(work, "id long").count())
spark.stop()
""")
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=240)
    assert "rows 3" in done.stdout, done.stderr[-2000:]
