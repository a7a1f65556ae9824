"""Customer features from daily partial sums.

The full feature job reads all purchases and lines. Here, both branches of it are kept
as partial sums a day, which add up to the same result for any ``as_of``: whatever
depends on the age of a purchase depends on its day only.

Partials are stored by month, like the purchases. :func:`refresh` computes the months
it is given from their purchases alone and replaces them, so a run reads what has
changed and a repeated run gives the same. :func:`features_from_partials` reads the
partials, one row for a customer, day and store or product group.

A line takes the group of its product as of the refresh; when groups of products
change, the months that are to show it are refreshed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.moments import days_before, month_key
from tillmart.operators.features import (
    DEFAULTS,
    ITEM,
    FeatureSettings,
    aged_lines,
    aged_sums,
    fold_lines,
    from_groups,
    from_stores,
    joined_metrics,
    plain_sums,
    prepare_headers,
    with_flags,
)

MONTH = "purchase_month"
#: Purchases without a time have no month; theirs is this one.
NO_MONTH = 0


def with_purchase_month(purchases: DataFrame) -> DataFrame:
    return purchases.withColumn(MONTH, F.coalesce(month_key(F.col("raw_event_time")), F.lit(NO_MONTH)))


def changed_months(changed: DataFrame) -> list[int]:
    """Months of new or changed purchases; there are few, however many purchases."""
    months = with_purchase_month(changed.select("raw_event_time")).select(MONTH).distinct()
    return sorted(r[MONTH] for r in months.toLocalIterator())


def partial_sums(
    tables: dict[str, DataFrame], grain: str = ITEM, settings: FeatureSettings = DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """Sums a day by (customer, store), and by (customer, product group)."""
    # Age is left to the reader; any moment does here.
    headers = prepare_headers(tables["purchases"], "1970-01-01", tables["dates"]).drop("_age")
    headers = headers.withColumn("day", F.to_date("raw_event_time"))
    month = F.coalesce(month_key(F.col("day")), F.lit(NO_MONTH)).alias(MONTH)
    weighted = grain == ITEM
    count = F.coalesce("_lines", F.lit(0))
    sums = plain_sums(settings, F.greatest(count, F.lit(1)) if weighted else F.lit(1))
    sums = [v.alias(k) for k, v in sums.items()]
    by_store = headers.groupBy("customer_id", "store_id", "day").agg(
        F.count("purchase_id").alias("total_purchases"),
        F.min("raw_event_time").alias("first_purchase_date"),
        F.max("raw_event_time").alias("last_purchase_date"),
        *([] if weighted else sums),
    )
    # Ids that begin alike are slow to sort. Their hash goes first, so they are seldom compared.
    keys = ["_key", "purchase_id"]
    headers, items = (df.withColumn("_key", F.xxhash64("purchase_id")) for df in (headers, tables["items"]))
    # Lines of the chosen purchases only: Spark filters them by purchase before the fold.
    lines = items.join(headers.select(*keys).distinct(), keys, "left_semi")
    by_group = (
        headers.join(fold_lines(lines, tables["products"], keys), keys, "left")
        .groupBy("customer_id", "product_group", "day")
        .agg(F.sum(count).alias("_lines_all"), F.sum("_organic").alias("organic_purchases"), *(sums if weighted else []))
    )
    return by_store.withColumn(MONTH, month), by_group.withColumn(MONTH, month)


def refresh(
    tables: dict[str, DataFrame], path: str, months: Iterable[int] | None = None, grain: str = ITEM,
    settings: FeatureSettings = DEFAULTS,
) -> None:
    """Replaces the partials of some months, or of all, by those of their purchases.

    Purchases that carry a ``purchase_month`` partition are read for these months only.
    """
    purchases = tables["purchases"]
    if MONTH not in purchases.columns:
        purchases = with_purchase_month(purchases)
    if months is not None:
        purchases = purchases.where(F.col(MONTH).isin(list(months)))
    parts = partial_sums(tables | {"purchases": purchases.drop(MONTH)}, grain, settings)
    for name, part in zip(("stores", "groups"), parts, strict=True):
        writer = part.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
        if months is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(f"{path}/{name}")


def metrics_from_partials(
    spark: SparkSession, path: str, stores: DataFrame, as_of, grain: str = ITEM, settings: FeatureSettings = DEFAULTS
) -> DataFrame:
    """One row per customer with purchases, as the full job gives it."""
    age = days_before(as_of, F.col("day"))
    by_store = spark.read.parquet(f"{path}/stores").withColumn("_age", age)
    by_group = spark.read.parquet(f"{path}/groups").withColumn("_age", age)
    plain = list(plain_sums(settings, F.lit(1)))
    sums = {k: F.sum(k) for k in plain} | aged_sums(settings, F.col("total_spent"), F.col("row_count"))
    per_store = by_store.groupBy("customer_id", "store_id").agg(
        F.sum("total_purchases").alias("total_purchases"),
        F.min("first_purchase_date").alias("first_purchase_date"),
        F.max("last_purchase_date").alias("last_purchase_date"),
    )
    per_group = by_group.groupBy("customer_id", "product_group").agg(
        F.sum("_lines_all").alias("_lines_all"),
        F.sum("organic_purchases").alias("organic_purchases"),
        *[v.alias(k) for k, v in aged_lines(settings, F.col("_lines_all")).items() if k != "_lines_all"],
    )
    # These sums need neither store nor group, so they go to the customer in one step.
    totals = (by_group if grain == ITEM else by_store).groupBy("customer_id").agg(*[v.alias(k) for k, v in sums.items()])
    by_header = from_stores(per_store, stores, []).join(totals, "customer_id")
    return joined_metrics(by_header, from_groups(per_group, settings, []))


def features_from_partials(
    spark: SparkSession, path: str, tables: dict[str, DataFrame], as_of, grain: str = ITEM,
    settings: FeatureSettings = DEFAULTS, null_as_zero: bool = False,
) -> DataFrame:
    """The feature table; ``tables`` holds customers and stores."""
    metrics = metrics_from_partials(spark, path, tables["stores"], as_of, grain, settings)
    return with_flags(tables["customers"], metrics, as_of, settings, null_as_zero)
