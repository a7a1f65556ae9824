"""Star lookups: facts with the attributes of their dimensions.

Dimensions hold one row per key. Small ones are broadcast by Spark within its
size threshold; beyond it the joins shuffle and AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_purchases(mart: dict[str, DataFrame]) -> DataFrame:
    """Headers with customer, store, city, calendar and delivery attributes."""
    customers = mart["dim_customer"].select("customer_sk", "full_name", "is_loyalty_member")
    locations = mart["dim_store_location"].select(
        "store_location_sk", F.col("city").alias("store_city")
    )
    stores = mart["dim_store"].select(
        "store_sk", "store_name", "store_network", "store_location_sk"
    ).join(locations, "store_location_sk", "left").drop("store_location_sk")
    days = mart["dim_date"].select(
        F.col("date_sk").alias("purchase_date_sk"), "year_week", "day_of_week", "is_weekend"
    )
    addresses = mart["dim_delivery_address"].select(
        "delivery_address_sk", F.col("city").alias("delivery_city")
    )
    return (
        mart["fact_purchases"]
        .join(customers, "customer_sk", "left")
        .join(stores, "store_sk", "left")
        .join(days, "purchase_date_sk", "left")
        .join(addresses, "delivery_address_sk", "left")
    )


def star_items(mart: dict[str, DataFrame]) -> DataFrame:
    """Lines with product and manufacturer attributes."""
    products = mart["dim_product"].select(
        "product_sk", "product_name", "product_group", "is_organic"
    )
    makers = mart["dim_manufacturer"].select(
        "manufacturer_sk", "manufacturer_name", "manufacturer_country"
    )
    return (
        mart["fact_purchase_items"]
        .join(products, "product_sk", "left")
        .join(makers, "manufacturer_sk", "left")
    )
