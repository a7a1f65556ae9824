"""Duplicate, orphan and alert reports over any set of tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions.numbers import percent


@dataclass(frozen=True)
class AlertRule:
    """Duplicate alert of one raw table."""

    table: str
    emoji: str

    @property
    def title(self) -> str:
        return f"{self.emoji} {self.table.capitalize()} Duplicates > 50%"


# Alert limit in percent, severity, and one rule per raw table.
ALERT_LIMIT = 49.0
ALERT_SEVERITY = "critical"
ALERT_RULES = (
    AlertRule("stores", "🏪"),
    AlertRule("products", "📦"),
    AlertRule("customers", "👥"),
    AlertRule("purchases", "🛒"),
)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_counts(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows per key, combined map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_stats(name: str, df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Records, distinct non-NULL keys, surplus rows and their percentage.

    One pass: the per-key counts give all figures, including the number of
    keys that occur more than once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    totals = key_counts(df, keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
        F.count_if(known).alias("unique_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )
    surplus = F.col("total_records") - F.col("unique_keys")
    return totals.select(
        F.lit(name).alias("table"),
        "total_records",
        "unique_keys",
        surplus.alias("duplicate_keys"),
        percent(surplus, F.col("total_records")).alias("duplicate_percent"),
        "duplicated_keys",
    )


def duplicate_report(tables: dict[str, tuple[DataFrame, str | Sequence[str]]]) -> DataFrame:
    """:func:`duplicate_stats` of many tables, worst first."""
    rows = _union([duplicate_stats(n, df, key) for n, (df, key) in tables.items()])
    return rows.orderBy(F.col("duplicate_percent").desc_nulls_last(), "table")


def duplicate_total(stats: DataFrame) -> DataFrame:
    return stats.agg(F.sum("duplicate_keys").alias("duplicates"))


def duplicated_keys(stats: DataFrame) -> DataFrame:
    """Keys with more than one row, per table, most first."""
    return stats.select("table", F.col("duplicated_keys").alias("duplicates")).orderBy(
        F.col("duplicates").desc(), "table"
    )


def duplicate_alerts(stats: DataFrame, limit: float = ALERT_LIMIT) -> DataFrame:
    """Alert rows of the tables whose duplicate percentage exceeds ``limit``."""
    title = F.create_map(*[F.lit(x) for r in ALERT_RULES for x in (r.table, r.title)])
    emoji = F.create_map(*[F.lit(x) for r in ALERT_RULES for x in (r.table, r.emoji)])
    return stats.where(F.col("duplicate_percent") > limit).select(
        "table",
        "duplicate_percent",
        F.lit(float(limit)).alias("threshold"),
        F.lit(ALERT_SEVERITY).alias("severity"),
        F.coalesce(title[F.col("table")], F.concat("table", F.lit(" duplicates"))).alias("title"),
        F.coalesce(emoji[F.col("table")], F.lit("")).alias("emoji"),
    )


def orphans(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose non-NULL key has no dimension row."""
    known = dim.select(F.col(dim_key or fact_key).alias(fact_key))
    return facts.where(F.col(fact_key).isNotNull()).join(known, fact_key, "left_anti")


def _stacked(frame: DataFrame, entries: Sequence[tuple[int, int, str]]) -> DataFrame:
    """One row per (dimension, check, key column) and row of the frame, NULL keys left out."""
    pairs = [
        F.struct(F.lit(dim).alias("dim"), F.lit(check).alias("check"), F.col(key).cast("bigint").alias("key"))
        for dim, check, key in entries
    ]
    return frame.select(F.inline(F.array(*pairs))).where(F.col("key").isNotNull())


def orphan_report(
    checks: Sequence[tuple[str, DataFrame, DataFrame, str, str]],
) -> DataFrame:
    """Orphan rows and keys per ``(name, facts, dim, fact_key, dim_key)``.

    Each frame is read once, whatever its parts: the keys it refers to and those it
    holds are stacked together. One aggregation by key, map-side first, tells which keys
    are held and how often each check uses them, so a hot key is one row a task.
    """
    held = -1
    entries: dict[int, tuple[DataFrame, list[tuple[int, int, str]]]] = {}
    dims: dict[tuple[int, str], int] = {}
    for place, (_, fact, dim, fact_key, dim_key) in enumerate(checks):
        known = (id(dim), dim_key)
        if known not in dims:
            dims[known] = len(dims)
            entries.setdefault(id(dim), (dim, []))[1].append((dims[known], held, dim_key))
        entries.setdefault(id(fact), (fact, []))[1].append((dims[known], place, fact_key))
    stacked = _union([_stacked(frame, of) for frame, of in entries.values()])
    used = [F.count_if(F.col("check") == place).alias(f"n{place}") for place in range(len(checks))]
    keys = stacked.groupBy("dim", "key").agg(F.bool_or(F.col("check") == held).alias("held"), *used)
    missing = keys.where(~F.col("held")).agg(*[
        f(F.col(f"n{place}")).alias(f"{kind}{place}")
        for place in range(len(checks))
        for kind, f in (("rows", lambda n: F.coalesce(F.sum(n), F.lit(0))), ("keys", lambda n: F.count_if(n > 0)))
    ])
    lines = [
        F.struct(F.lit(name).alias("check"), F.col(f"rows{place}").alias("orphan_rows"), F.col(f"keys{place}").alias("orphan_keys"))
        for place, (name, *_) in enumerate(checks)
    ]
    return missing.select(F.inline(F.array(*lines)))


def key_collisions(df: DataFrame, surrogate: str, natural: Sequence[str]) -> DataFrame:
    """Natural keys, surrogate keys, and surrogate keys shared by several."""
    pairs = df.select(surrogate, *natural).distinct()
    per_key = pairs.groupBy(surrogate).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("natural_keys"),
        F.count(F.lit(1)).alias("surrogate_keys"),
        F.count_if(F.col("_n") > 1).alias("colliding_keys"),
    )


def file_count(df: DataFrame) -> DataFrame:
    """Number of files behind a file-based table; reads no data columns."""
    paths = df.select(F.col("_metadata.file_path").alias("path")).distinct()
    return paths.agg(F.count(F.lit(1)).alias("files"))


def analyze_table(name: str, df: DataFrame, key: Sequence[str] | str, version: str,
                  files: DataFrame | None = None) -> DataFrame:
    """Rows, files, duplicates, key and version column of one table."""
    keys = [key] if isinstance(key, str) else list(key)
    stats = duplicate_stats(name, df, keys).select(
        "table",
        F.col("total_records").alias("rows"),
        F.col("duplicate_keys").alias("duplicates"),
        F.lit(", ".join(keys)).alias("dedup_key"),
        F.lit(version).alias("version_column"),
    )
    if files is None:
        return stats.withColumn("files", F.lit(None).cast("bigint"))
    counted = file_count(files).select(F.lit(name).alias("table"), "files")
    both = stats.unionByName(counted, allowMissingColumns=True)
    others = [c for c in both.columns if c != "table"]
    return both.groupBy("table").agg(*[F.max(c).alias(c) for c in others])
