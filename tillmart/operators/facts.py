"""Fact builders from raw purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions.keys import key64
from tillmart.functions.moments import date_key, moment, moment_or
from tillmart.functions.numbers import (
    amount_or_zero,
    non_negative_double,
    quantity_or_one,
)
from tillmart.functions.text import GROUP_DROP, is_blank, tidy, truthy
from tillmart.operators.dimensions import delivery_address_parts, location_key, maker_key


def fact_purchases(purchases: DataFrame, as_of, stamp=None, hasher=key64) -> DataFrame:
    """One header per purchase document.

    A missing, broken or future purchase time becomes ``as_of``. The date key is
    taken from the same value, and so are the days of ``dim_date``.
    """
    customer_id = tidy(F.col("customer_customer_id"))
    store_id = tidy(F.col("store_store_id"))
    happened = moment_or(F.col("purchase_datetime"), as_of)
    processed = moment(as_of) if stamp is None else stamp.cast("timestamp_ntz")
    return purchases.where(~is_blank(F.col("purchase_id"))).select(
        tidy(F.col("purchase_id")).alias("purchase_id"),
        customer_id.alias("customer_id"),
        store_id.alias("store_id"),
        hasher(customer_id).alias("customer_sk"),
        hasher(store_id).alias("store_sk"),
        date_key(happened).alias("purchase_date_sk"),
        location_key("delivery_address", delivery_address_parts, hasher).alias(
            "delivery_address_sk"
        ),
        tidy(F.col("payment_method")).alias("payment_method"),
        amount_or_zero(F.col("total_amount")).alias("total_amount"),
        truthy(F.col("is_delivery")).alias("is_delivery"),
        F.coalesce(F.size("items"), F.lit(0)).alias("items_count"),
        happened.alias("raw_event_time"),
        processed.alias("processed_at"),
    )


def explode_items(purchases: DataFrame, keep: tuple[str, ...] = ("purchase_id",)) -> DataFrame:
    """One row per item with a product id; purchases without items give none.

    The product filter drops the empty row an outer explode makes of an empty
    basket. An inner explode would give the same rows, but Spark then adds a
    size test below it, which computes arrays built in the same plan twice.
    """
    return (
        purchases.select(*keep, F.explode_outer("items").alias("item"))
        .where(~is_blank(F.col("item.product_id")))
    )


def fact_purchase_items(purchases: DataFrame, as_of, stamp=None, hasher=key64) -> DataFrame:
    """One row per purchase line."""
    keep = ("purchase_id",) if stamp is None else ("purchase_id", stamp.alias("_stamp"))
    lines = explode_items(purchases, keep)
    purchase_id = tidy(F.col("purchase_id"))
    product_id = tidy(F.col("item.product_id"))
    processed = moment(as_of) if stamp is None else F.col("_stamp").cast("timestamp_ntz")
    price = amount_or_zero(F.col("item.price_per_unit"))
    nutrition = [
        non_negative_double(F.col(f"item.kbju_{n}")).alias(f"item_{n}")
        for n in ("calories", "protein", "fat", "carbohydrates")
    ]
    return lines.select(
        key64(purchase_id, product_id).alias("fact_sk"),
        purchase_id.alias("purchase_id"),
        product_id.alias("product_id"),
        hasher(product_id).alias("product_sk"),
        maker_key(F.col("item.manufacturer_inn"), hasher).alias("manufacturer_sk"),
        quantity_or_one(F.col("item.quantity")).alias("quantity"),
        tidy(F.col("item.unit")).alias("unit"),
        price.alias("price_per_unit"),
        amount_or_zero(F.col("item.total_price")).alias("total_item_price"),
        *nutrition,
        tidy(F.col("item.category"), drop=GROUP_DROP).alias("product_category"),
        processed.alias("processed_at"),
    )
