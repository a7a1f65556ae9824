"""The nine mart targets: which raw table feeds them, their key and version."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tillmart.functions.keys import key64
from tillmart.operators import dimensions, facts
from tillmart.operators.versions import latest_by_key


@dataclass(frozen=True)
class Target:
    name: str
    source: str
    key: tuple[str, ...]
    version: str
    build: Callable[..., DataFrame]


TARGETS = {
    t.name: t
    for t in (
        Target("dim_manufacturer", "products", ("manufacturer_sk",), "updated_at",
               dimensions.dim_manufacturer),
        Target("dim_store_location", "stores", ("store_location_sk",), "updated_at",
               dimensions.dim_store_location),
        Target("dim_delivery_address", "customers", ("delivery_address_sk",), "updated_at",
               dimensions.dim_delivery_address),
        Target("dim_product", "products", ("product_sk",), "updated_at",
               dimensions.dim_product),
        Target("dim_customer", "customers", ("customer_sk",), "updated_at",
               dimensions.dim_customer),
        Target("dim_store", "stores", ("store_sk",), "updated_at", dimensions.dim_store),
        Target("dim_date", "purchases", ("date_sk",), "updated_at", dimensions.dim_date),
        Target("fact_purchases", "purchases", ("purchase_id",), "processed_at",
               facts.fact_purchases),
        Target("fact_purchase_items", "purchases", ("purchase_id", "product_id"),
               "processed_at", facts.fact_purchase_items),
    )
}

# Raw columns, and fields of their items, that the targets of a topic read. Other topics: all but the text.
READ = {
    "purchases": (
        "event_time", "event_month", "purchase_id", "customer_customer_id", "store_store_id", "total_amount", "payment_method",
        "is_delivery", "delivery_address_country", "delivery_address_city", "delivery_address_street",
        "delivery_address_house", "delivery_address_apartment", "purchase_datetime", "items",
    ),
}
READ_ITEMS = (
    "product_id", "category", "quantity", "unit", "price_per_unit", "total_price", "kbju_calories", "kbju_protein",
    "kbju_fat", "kbju_carbohydrates", "manufacturer_inn",
)

FEATURES_KEY = ("customer_sk", "customer_id")
FEATURES_VERSION = "created_at"


def read_schema(topic: str, schema: StructType) -> StructType:
    """The part of a raw schema that the targets of a topic read."""
    fields = [f for f in schema.fields if f.name in READ.get(topic, schema.names) and f.name != "json_data"]
    return StructType([
        StructField(f.name, ArrayType(StructType([x for x in f.dataType.elementType.fields if x.name in READ_ITEMS])))
        if f.name == "items" else f for f in fields
    ])


def build_target(name: str, raw: DataFrame, as_of, by_event_time: bool = False,
                 hasher=key64) -> DataFrame:
    """All versions of one target from its raw table.

    ``by_event_time`` versions rows by the raw ``event_time``, which makes the
    outcome independent of how the raw rows were split into batches.
    """
    target = TARGETS[name]
    if name == "dim_date":
        return target.build(raw, as_of)
    stamp = F.col("event_time") if by_event_time else None
    return target.build(raw, as_of, stamp=stamp, hasher=hasher)


def current(name: str, versions: DataFrame, inserted: tuple[str, ...] = ()) -> DataFrame:
    """One row per key of a target.

    ``inserted`` names columns that tell which of two rows of equal version came
    last, and so wins.
    """
    target = TARGETS[name]
    return latest_by_key(versions, target.key, [target.version, *inserted])


def build_mart(raw: dict[str, DataFrame], as_of, hasher=key64) -> dict[str, DataFrame]:
    """All nine targets, one row per key, from the four raw tables."""
    return {
        name: current(name, build_target(name, raw[t.source], as_of, True, hasher))
        for name, t in TARGETS.items()
    }
