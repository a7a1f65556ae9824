"""The jobs a user runs: publish, ingest, features, analyse, deduplicate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES
from tillmart.functions.moments import moment, month_key
from tillmart.operators.envelope import wrap
from tillmart.operators.features import DEFAULTS, ITEM, FeatureSettings, customer_features
from tillmart.operators.mart import FEATURES_KEY, FEATURES_VERSION, TARGETS
from tillmart.operators.pseudonymise import pseudonymise
from tillmart.operators.quality import analyze_table, duplicate_report
from tillmart.operators.versions import dedup_by_columns, latest_by_key
from tillmart.sources.messages import publish_files
from tillmart.sources.sinks import FORMATS, write_partitioned, write_results
from tillmart.sources.tables import FEATURE_INPUTS, extract
from tillmart.streaming.ingest import Layout, read_mart, start_ingest

VERSIONED = "version"
BY_COLUMNS = "columns"


def table_rules() -> dict[str, tuple[tuple[str, ...], str]]:
    """Key and version column of every mart table, the feature table included."""
    rules = {name: (t.key, t.version) for name, t in TARGETS.items()}
    rules["customer_features_mart"] = (FEATURES_KEY, FEATURES_VERSION)
    return rules


def publish(
    documents: DataFrame,
    topic: str,
    hmac_key: str,
    published_at,
    sink: Callable[[DataFrame], None] | str,
) -> DataFrame:
    """Hashes contact fields, wraps documents and hands them to a sink.

    ``sink`` is a folder for JSON lines or a function taking the envelopes.
    """
    safe = pseudonymise(documents, hmac_key, topic)
    envelopes = wrap(safe, moment(published_at), topic)
    if callable(sink):
        sink(envelopes)
    else:
        publish_files(envelopes, sink)
    return envelopes


def publish_all(
    read: Callable[[str], DataFrame],
    hmac_key: str,
    published_at,
    sink: Callable[[DataFrame], None] | str,
    topics: Sequence[str] = tuple(ENTITIES),
) -> DataFrame:
    """Publishes the chosen topics from a ``topic -> DataFrame`` reader, all in one write."""
    parts = [
        wrap(pseudonymise(read(topic), hmac_key, topic), moment(published_at), topic)
        for topic in topics
    ]
    envelopes = reduce(DataFrame.unionByName, parts)
    if callable(sink):
        sink(envelopes)
    else:
        publish_files(envelopes, sink)
    return envelopes


def mart_duplicates(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate figures of mart tables by their own keys, the feature table included."""
    rules = table_rules()
    return duplicate_report({name: (df, rules[name][0]) for name, df in tables.items()})


def ingest(
    envelopes: DataFrame,
    root: str,
    as_of,
    topics: Sequence[str] = tuple(ENTITIES),
    once: bool = True,
    with_mart: bool = True,
):
    """Runs the ingest stream into ``root``; waits for the end when ``once``."""
    query = start_ingest(envelopes, Layout(root), as_of, topics, once, with_mart)
    if once:
        query.awaitTermination()
    return query


def publish_mart(spark: SparkSession, root: str, as_of, out_dir: str) -> None:
    """Writes the current rows of all targets: the compacted form of the mart.

    Headers are partitioned by purchase month. The version store is left as it
    is; a failed run can be repeated.
    """
    layout = Layout(root)
    for name in TARGETS:
        rows = read_mart(spark, layout, name, as_of)
        path = f"{out_dir}/{name}"
        if name == "fact_purchases":
            months = rows.withColumn("purchase_month", month_key(F.col("raw_event_time")))
            write_partitioned(months, path, ["purchase_month"])
        else:
            rows.write.mode("overwrite").parquet(path)


def feature_inputs(read: Callable[[str], DataFrame], dedupe: bool = True) -> dict[str, DataFrame]:
    """Feature inputs through a reader, one row per key unless ``dedupe`` is off."""
    tables = extract(read)
    if not dedupe:
        return tables
    return {
        role: latest_by_key(df, TARGETS[FEATURE_INPUTS[role]].key,
                            TARGETS[FEATURE_INPUTS[role]].version)
        for role, df in tables.items()
    }


def run_features(
    read: Callable[[str], DataFrame],
    as_of,
    grain: str = ITEM,
    settings: FeatureSettings = DEFAULTS,
    formats: Sequence[str] = FORMATS,
    folder: str | None = None,
    table: str | None = None,
    dedupe: bool = True,
    jdbc: dict[str, str] | None = None,
    export_root: str | None = None,
) -> dict[str, str]:
    """Extract, transform and write the feature table; sink locations."""
    features = customer_features(feature_inputs(read, dedupe), as_of, grain, settings)
    return write_results(features, as_of, formats, folder, table, jdbc, export_root)


def analyze(
    tables: dict[str, DataFrame],
    rules: dict[str, tuple[Sequence[str], str]] | None = None,
    only: Sequence[str] | None = None,
    with_files: bool = False,
) -> DataFrame:
    """Rows, duplicates, key, version (and files) of the chosen tables."""
    rules = rules or table_rules()
    chosen = [n for n in tables if only is None or n in only]
    parts = [
        analyze_table(n, tables[n], *rules[n], files=tables[n] if with_files else None)
        for n in chosen
    ]
    return reduce(DataFrame.unionByName, parts)


def deduplicated(df: DataFrame, key: Sequence[str], version: str, strategy: str = VERSIONED,
                 partition_columns: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest version, or any fixed one by columns."""
    if strategy == VERSIONED:
        return latest_by_key(df, key, version)
    if strategy == BY_COLUMNS:
        return dedup_by_columns(df, [*key, *partition_columns])
    raise ValueError(f"unknown strategy {strategy!r}")


def dedup_tables(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    out_dir: str,
    rules: dict[str, tuple[Sequence[str], str]] | None = None,
    strategy: str = VERSIONED,
    only: Sequence[str] | None = None,
    dry_run: bool = False,
    partition_columns: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rewrites tables without duplicates into ``out_dir``; statistics per table.

    Sources are left alone, so a failed run can simply be repeated. A dry run
    computes the same statistics without writing.
    """
    rules = rules or table_rules()
    parts = []
    for name, df in tables.items():
        if only is not None and name not in only:
            continue
        key, version = rules[name]
        extra = (partition_columns or {}).get(name, ())
        clean = deduplicated(df, key, version, strategy, extra)
        if not dry_run:
            clean.write.mode("overwrite").parquet(f"{out_dir}/{name}")
            clean = spark.read.parquet(f"{out_dir}/{name}")
        before = df.agg(F.count(F.lit(1)).alias("rows_before")).withColumn("rows_after", F.lit(0))
        after = clean.agg(F.count(F.lit(1)).alias("rows_after")).withColumn("rows_before", F.lit(0))
        parts.append(before.unionByName(after).agg(
            F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after")
        ).select(
            F.lit(name).alias("table"),
            F.lit(strategy).alias("strategy"),
            "rows_before",
            "rows_after",
            (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed"),
        ))
    return reduce(DataFrame.unionByName, parts)


def dedup_summary(stats: DataFrame) -> DataFrame:
    """Totals over all tables of a deduplication run."""
    return stats.agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("rows_before").alias("rows_before"),
        F.sum("rows_after").alias("rows_after"),
        F.sum("duplicates_removed").alias("duplicates_removed"),
    )
