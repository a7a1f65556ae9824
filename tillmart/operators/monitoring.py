"""Volume, freshness and store-map aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions.moments import moment, month_key
from tillmart.functions.numbers import bounded_double

_UNION = DataFrame.unionByName


def rows_per_table(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, in name order."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("table"), "records")
        for n, df in tables.items()
    ]
    return reduce(_UNION, counts).orderBy("table")


def total_rows(tables: dict[str, DataFrame]) -> DataFrame:
    return rows_per_table(tables).agg(F.sum("records").alias("total"))


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and file size in MB per file-based table; reads no data columns."""
    parts = []
    for name, df in tables.items():
        files = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("records"), F.max("_metadata.file_size").alias("bytes")
        )
        parts.append(
            files.agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes")).select(
                F.lit(name).alias("table"),
                F.coalesce("records", F.lit(0)).alias("records"),
                (F.coalesce("bytes", F.lit(0)) / F.lit(1024 * 1024)).alias("size_mb"),
            )
        )
    return reduce(_UNION, parts).orderBy("table")


def in_time_range(df: DataFrame, start=None, end=None, column: str = "event_time") -> DataFrame:
    """Rows with ``start <= column <= end``; prunes ``event_month`` partitions."""
    ts = F.col(column)
    for limit, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if limit is None:
            continue
        df = df.where(keep(ts, moment(limit)))
        if "event_month" in df.columns and column == "event_time":
            df = df.where(keep(F.col("event_month"), month_key(moment(limit))))
    return df


def rows_per_hour(tables: dict[str, DataFrame], start, end, column: str = "event_time") -> DataFrame:
    """Records per table and hour inside a closed time range."""
    parts = []
    for name, df in tables.items():
        hour = F.date_trunc("hour", F.col(column)).cast("timestamp_ntz")
        parts.append(
            in_time_range(df, start, end, column)
            .groupBy(hour.alias("time"))
            .agg(F.count(F.lit(1)).alias("records"))
            .select(F.lit(name).alias("table"), "time", "records")
        )
    return reduce(_UNION, parts).orderBy("table", "time")


def freshness(tables: dict[str, DataFrame], as_of, column: str = "event_time") -> DataFrame:
    """Last update and its age in whole seconds, per table."""
    parts = []
    for name, df in tables.items():
        parts.append(
            df.agg(F.max(column).cast("timestamp_ntz").alias("last_update")).select(
                F.lit(name).alias("table"),
                "last_update",
                F.timestamp_diff("SECOND", F.col("last_update"), moment(as_of)).alias(
                    "age_seconds"
                ),
            )
        )
    return reduce(_UNION, parts).orderBy("table")


def keep_recent(df: DataFrame, as_of, days: int = 180, column: str = "event_time") -> DataFrame:
    """Retention: rows not older than ``days`` before ``as_of``."""
    limit = moment(as_of) - F.make_dt_interval(F.lit(days))
    kept = df.where(F.col(column) >= limit)
    if "event_month" in df.columns and column == "event_time":
        kept = kept.where(F.col("event_month") >= month_key(limit))
    return kept


def store_map(stores: DataFrame) -> DataFrame:
    """Distinct raw stores with numeric coordinates, by city and name."""
    point = {
        name: bounded_double(F.col(f"location_coordinates_{name}"))
        for name in ("latitude", "longitude")
    }
    placed = stores.where(
        F.col("location_coordinates_latitude").isNotNull()
        & F.col("location_coordinates_longitude").isNotNull()
    )
    return (
        placed.select(
            "store_id",
            "store_name",
            "store_network",
            F.col("location_city").alias("city"),
            F.col("location_street").alias("street"),
            F.col("location_house").alias("house"),
            *[v.alias(k) for k, v in point.items()],
        )
        .distinct()
        .orderBy("city", "store_name")
    )


def store_counts(stores: DataFrame) -> DataFrame:
    """Distinct stores, cities, networks, online and delivery stores, one row."""

    def serving(flag: str) -> Column:
        return F.count_distinct(F.when(F.col(flag), F.col("store_id")))

    # Raw stores repeat with every delivery; the five distinct counts run on
    # the few distinct rows that are left.
    flags = ("accepts_online_orders", "delivery_available")
    rows = stores.select(
        "store_id",
        "location_city",
        "store_network",
        *[F.col(f).isin("True", "true").alias(f) for f in flags],
    ).distinct()
    return rows.agg(
        F.count_distinct("store_id").alias("stores"),
        F.count_distinct("location_city").alias("cities"),
        F.count_distinct("store_network").alias("networks"),
        serving("accepts_online_orders").alias("online_stores"),
        serving("delivery_available").alias("delivery_stores"),
    )


def stores_by(stores: DataFrame, column: str, label: str, count: str) -> DataFrame:
    """Distinct stores per value of ``column``, most first."""
    return (
        stores.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(label))
        .agg(F.count_distinct("store_id").alias(count))
        .orderBy(F.col(count).desc(), label)
    )


def stores_by_network(stores: DataFrame) -> DataFrame:
    return stores_by(stores, "store_network", "store_network", "stores")


def stores_by_city(stores: DataFrame) -> DataFrame:
    return stores_by(stores, "location_city", "city", "store_count")
