from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tillmart.entities import ENTITIES
from tillmart.functions.keys import key32
from tillmart.operators import mart, monitoring, quality, star
from tillmart.operators.dimensions import calendar_for
from tillmart.operators.versions import dedup_by_columns, latest_by_key
from tillmart.plans import jobs, sample

AS_OF = sample.AS_OF


@pytest.fixture(scope="module")
def raw(spark, sample_dir):
    return {t: sample.raw_table(spark, sample_dir, t) for t in ENTITIES}


@pytest.fixture(scope="module")
def built(spark, raw):
    return mart.build_mart(raw, AS_OF)


def test_foreign_keys_match_their_dimensions(built):
    """Blank address parts hash alike on both sides."""
    checks = [("fact_purchases", "dim_delivery_address", "delivery_address_sk"),
              ("dim_customer", "dim_delivery_address", "delivery_address_sk"),
              ("dim_store", "dim_store_location", "store_location_sk"),
              ("dim_product", "dim_manufacturer", "manufacturer_sk"),
              ("fact_purchases", "dim_date", "purchase_date_sk"),
              ("fact_purchase_items", "fact_purchases", "purchase_id")]
    for fact, dim, key in checks:
        other = "date_sk" if dim == "dim_date" else key
        missing = quality.orphans(built[fact], built[dim], key, other)
        if dim == "dim_date":  # replaced purchase times fall on as_of, which has no row
            missing = missing.where(F.col(key) != 20010802)
        if dim == "fact_purchases":  # lines of documents without a purchase id
            missing = missing.where(F.col(key) != "unknown")
        assert missing.count() == 0, (fact, dim)


def test_every_target_has_unique_keys_and_both_hashers_agree(raw, built):
    for name, target in mart.TARGETS.items():
        rows = built[name]
        assert rows.count() == rows.select(*target.key).distinct().count() > 0, name
    for name in ("dim_customer", "fact_purchases"):
        other = mart.current(name, mart.build_target(name, raw[mart.TARGETS[name].source], AS_OF, True, key32))
        assert other.count() == built[name].count()


def test_star_joins_keep_every_fact_row(built):
    assert star.star_purchases(built).count() == built["fact_purchases"].count()
    assert star.star_items(built).count() == built["fact_purchase_items"].count()


def test_batch_time_stamp_is_as_of(raw):
    row = mart.build_target("dim_store", raw["stores"], AS_OF).select("created_at", "updated_at").first()
    assert str(row.created_at) == str(row.updated_at) == "2001-08-02 00:00:00"


def test_registration_bound_is_optional(spark, raw):
    late = raw["customers"].withColumn("registration_date", F.lit("2050-01-01T00:00:00"))
    plain = mart.dimensions.dim_customer(late, AS_OF)
    bounded = mart.dimensions.dim_customer(late, AS_OF, past_registration=True)
    assert plain.where("registration_date is null").count() == 0
    assert bounded.where("registration_date is not null").count() == 0


def test_key_collisions(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "b", "x"), (2, "c", "x")]
    df = spark.createDataFrame(rows, "sk int, a string, b string")
    assert tuple(quality.key_collisions(df, "sk", ["a", "b"]).first()) == (3, 2, 1)


def test_holidays(spark):
    days = spark.sql("select date '2026-01-01' as d union all select date '2026-01-09'")
    holidays = spark.sql("select date '2026-01-01' as full_date union all select date '2026-01-01'")
    rows = calendar_for(days, "d", AS_OF, holidays=holidays).orderBy("date_sk").collect()
    assert [r.is_holiday for r in rows] == [1, 0]


def versions(spark):
    rows = [("a", "2026-01-01", 1), ("a", "2026-02-01", 2), ("a", "2026-02-01", 3), ("b", "2026-01-05", 9),
            ("b", None, 10), (None, "2026-01-01", 4)]
    return spark.createDataFrame(rows, "k string, v string, x int")


def test_latest_by_key(spark):
    got = sorted((str(r.k), r.x) for r in latest_by_key(versions(spark), "k", "v").collect())
    assert got == [("None", 4), ("a", 3), ("b", 9)]
    month = F.substring("v", 1, 7)
    split = latest_by_key(versions(spark), "k", "v", within=[month])
    assert sorted((str(r.k), r.x) for r in split.collect()) == [
        ("None", 4), ("a", 1), ("a", 3), ("b", 9), ("b", 10)]


def test_dedup_is_idempotent_and_order_free(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(20), rng.randrange(3), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, v int, x double")
    once = latest_by_key(df, "k", "v")
    assert sorted(latest_by_key(once, "k", "v").collect()) == sorted(once.collect())
    assert sorted(latest_by_key(df.repartition(7), "k", "v").collect()) == sorted(once.collect())
    assert sorted(latest_by_key(df.union(df), "k", "v").collect()) == sorted(once.collect())
    columns = dedup_by_columns(df, ["k", "v"])
    assert columns.count() == df.select("k", "v").distinct().count()
    assert sorted(dedup_by_columns(df.repartition(3), ["k", "v"]).collect()) == sorted(columns.collect())


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 1000).alias("v"), F.col("id").alias("x"))
    latest = latest_by_key(df, "k", "v")
    plan = plan_of(latest)
    # Bottom up: limit per map task, shuffle, final limit.
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.rindex("Partial")
    hot = latest.where("k = 0").collect()
    assert [(r.v, r.x) for r in hot] == [(999, 29999 if 29999 % 3 == 0 else hot[0].x)]
    assert hot[0].x == max(i for i in range(0, 30000, 3) if i % 1000 == 999)


def test_duplicate_stats_and_alerts(spark):
    tables = {
        "stores": (spark.createDataFrame([("a",), ("a",), ("a",), (None,)], "k string"), "k"),
        "empty": (spark.createDataFrame([], "k string"), "k"),
        "pair": (spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int"), ["a", "b"]),
    }
    stats = quality.duplicate_report(tables)
    got = [tuple(r) for r in stats.collect()]
    assert got == [("stores", 4, 1, 3, 75.0, 1), ("pair", 3, 2, 1, 33.33, 1), ("empty", 0, 0, 0, None, 0)]
    assert quality.duplicate_total(stats).first().duplicates == 4
    alerts = quality.duplicate_alerts(stats).collect()
    assert [(a.table, a.severity, a.threshold) for a in alerts] == [("stores", "critical", 49.0)]
    assert alerts[0].title == "🏪 Stores Duplicates > 50%"
    assert quality.duplicate_alerts(stats, 75.0).count() == 0


def test_analysis_and_dedup_runs(spark, tmp_path, sample_dir):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id % 4 as k", "id as v").repartition(3).write.parquet(path)
    tables = {"t": spark.read.parquet(path), "u": spark.range(3).selectExpr("id as k", "id as v")}
    rules = {"t": (("k",), "v"), "u": (("k",), "v")}
    analysis = jobs.analyze(tables, rules, only=["t"], with_files=True).first()
    assert (analysis.rows, analysis.duplicates, analysis.files, analysis.dedup_key) == (10, 6, 3, "k")
    dry = jobs.dedup_tables(spark, tables, str(tmp_path / "dry"), rules, dry_run=True)
    assert {r.table: r.duplicates_removed for r in dry.collect()} == {"t": 6, "u": 0}
    assert not (tmp_path / "dry").exists()
    out = str(tmp_path / "clean")
    done = jobs.dedup_tables(spark, tables, out, rules)
    assert jobs.dedup_summary(done).first() == (2, 13, 7, 6)
    assert sorted(spark.read.parquet(f"{out}/t").collect()) == [(0, 8), (1, 9), (2, 6), (3, 7)]
    with pytest.raises(ValueError):
        jobs.deduplicated(tables["t"], ["k"], "v", "other")


def test_monitoring(spark, tmp_path):
    rows = [("2026-01-31 23:30:00",), ("2026-02-01 00:10:00",), ("2026-02-01 00:50:00",), ("2026-03-05 01:00:00",)]
    df = spark.createDataFrame(rows, "t string").selectExpr("cast(t as timestamp_ntz) as event_time", "1 as x")
    from tillmart.sources.sinks import append_raw

    path = str(tmp_path / "raw")
    append_raw(df, path)
    stored = spark.read.parquet(path)
    hours = monitoring.rows_per_hour({"a": stored}, "2026-02-01", "2026-02-28")
    assert [(r.table, str(r.time), r.records) for r in hours.collect()] == [("a", "2026-02-01 00:00:00", 2)]
    plan = plan_of(monitoring.in_time_range(stored, "2026-02-01", "2026-02-28"))
    assert "PartitionFilters: [isnotnull(event_month" in plan
    kept = monitoring.keep_recent(stored, "2026-08-01")
    assert sorted(str(r.event_time) for r in kept.collect()) == ["2026-03-05 01:00:00"]
    fresh = monitoring.freshness({"a": stored, "none": df.where("x = 2")}, "2026-03-05 01:00:59.9")
    assert [(r.table, r.age_seconds) for r in fresh.collect()] == [("a", 59), ("none", None)]
    size = monitoring.table_sizes({"a": stored}).first()
    assert size.records == 4 and 0 < size.size_mb < 1
    assert monitoring.total_rows({"a": stored, "b": df}).first().total == 8


def test_bucketed_facts_join_without_shuffle(spark, sample_dir):
    from tillmart.operators.features import fold_lines
    from tillmart.sources.sinks import save_bucketed

    tables = sample.mart_tables(spark, sample_dir)
    save_bucketed(tables["items"], "bucketed_items", ["purchase_id"], 4)
    save_bucketed(tables["purchases"], "bucketed_purchases", ["purchase_id"], 4)
    lines = fold_lines(spark.table("bucketed_items"), tables["products"])
    joined = spark.table("bucketed_purchases").join(lines.hint("merge"), "purchase_id", "left")
    assert "Exchange hashpartitioning(purchase_id" not in plan_of(joined)
    assert joined.count() == tables["purchases"].join(
        fold_lines(tables["items"], tables["products"]), "purchase_id", "left").count()


def test_hot_product_is_split_by_aqe_when_products_are_too_big_to_broadcast(spark):
    from tillmart.operators.features import fold_lines

    items = spark.range(0, 200000, numPartitions=8).selectExpr(
        "concat('o', id) as purchase_id", "case when id % 3 = 0 then 'hot' else concat('p', id % 5000) end as product_id")
    products = spark.range(5000).selectExpr("concat('p', id) as product_id", "concat('g', id % 7) as product_group",
                                            "1 as is_organic").union(
        spark.sql("select 'hot', 'g', 0"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        folded = fold_lines(items, products)
        assert folded.agg(F.sum("_lines")).first()[0] == 200000
        folded.collect()
        assert "skew=true" in plan_of(folded)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_baskets_shuffle_columns_of_the_table_only(spark, sample_dir):
    rows = sample.raw_table(spark, sample_dir, "purchases")
    plan = plan_of(rows)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(basket_key" not in plan
    lines = spark.read.parquet(f"{sample_dir}/lineitem.parquet")
    assert rows.agg(F.sum(F.size("items"))).first()[0] == lines.count()
