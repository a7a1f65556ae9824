"""Mart tables as inputs of the feature job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Role of each feature-job input and the table that fills it.
FEATURE_INPUTS = {
    "purchases": "fact_purchases",
    "items": "fact_purchase_items",
    "customers": "dim_customer",
    "products": "dim_product",
    "stores": "dim_store",
    "dates": "dim_date",
}


def jdbc_options(
    url: str,
    table: str,
    split_column: str | None = None,
    low: str | None = None,
    high: str | None = None,
    parts: int = 64,
    **options: str,
) -> dict[str, str]:
    """Reader options; with ``split_column`` the read is split into ``parts`` ranges."""
    chosen = {"url": url, "dbtable": table, "fetchsize": "10000", **options}
    if split_column is not None:
        if low is None or high is None:
            raise ValueError("a split read needs both range ends")
        chosen.update(
            partitionColumn=split_column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(parts),
        )
    return chosen


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def extract(read: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """The six feature inputs through a ``table name -> DataFrame`` reader."""
    return {role: read(table) for role, table in FEATURE_INPUTS.items()}


def parquet_reader(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    return lambda table: spark.read.parquet(f"{root}/{table}")
