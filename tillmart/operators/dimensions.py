"""Dimension builders: one cleaned row per raw row, keyed and stamped.

Each builder takes an all-string raw table. ``as_of`` bounds dates and fills
``created_at``; ``stamp`` is the version written to ``updated_at`` (``as_of``
by default, the raw ``event_time`` in the incremental jobs). Follow with
``latest_by_key`` to keep one row per key. Both sides of every foreign key use
the same cleaned parts, so keys always match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions.calendar import calendar_columns
from tillmart.functions.keys import key64, key_or_null
from tillmart.functions.moments import day_until, moment, moment_or, parse_day, seconds_moment
from tillmart.functions.numbers import (
    bounded_double,
    fixed_decimal,
    non_negative_double,
    small_positive_int,
)
from tillmart.functions.text import (
    GROUP_DROP,
    LIST_DROP,
    full_name,
    is_blank,
    tidy,
    truthy,
)

EARLIEST_BIRTH = "1900-01-01"


def _audit(as_of, stamp: Column | None) -> list[Column]:
    created = moment(as_of)
    updated = created if stamp is None else stamp.cast("timestamp_ntz")
    return [created.alias("created_at"), updated.alias("updated_at")]


def _named(columns: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]


def store_location_parts(prefix: str) -> list[Column]:
    return [tidy(F.col(f"{prefix}_{p}")) for p in ("country", "city", "street", "house")]


def delivery_address_parts(prefix: str = "delivery_address") -> list[Column]:
    return [*store_location_parts(prefix), tidy(F.col(f"{prefix}_apartment"), default="")]


def location_key(prefix: str, parts, hasher) -> Column:
    """Address key, NULL while the country is missing."""
    return key_or_null(~is_blank(F.col(f"{prefix}_country")), *parts(prefix), hasher=hasher)


def maker_key(inn: Column, hasher=key64) -> Column:
    return key_or_null(~is_blank(inn), tidy(inn), hasher=hasher)


def dim_manufacturer(products: DataFrame, as_of, stamp=None, hasher=key64) -> DataFrame:
    inn = tidy(F.col("manufacturer_inn"))
    columns = {
        "manufacturer_sk": hasher(inn),
        "manufacturer_inn": inn,
        "manufacturer_name": tidy(F.col("manufacturer_name")),
        "manufacturer_country": tidy(F.col("manufacturer_country")),
        "manufacturer_website": tidy(F.col("manufacturer_website"), default=""),
    }
    return products.where(~is_blank(F.col("manufacturer_inn"))).select(
        *_named(columns), *_audit(as_of, stamp)
    )


def dim_store_location(stores: DataFrame, as_of, stamp=None, hasher=key64) -> DataFrame:
    parts = store_location_parts("location")
    columns = {
        "store_location_sk": hasher(*parts),
        **dict(zip(("country", "city", "street", "house"), parts, strict=True)),
        "postal_code": tidy(F.col("location_postal_code"), default="", lower=False),
        "latitude": bounded_double(F.col("location_coordinates_latitude"), -90, 90),
        "longitude": bounded_double(F.col("location_coordinates_longitude"), -180, 180),
    }
    return stores.select(*_named(columns), *_audit(as_of, stamp))


def dim_delivery_address(customers: DataFrame, as_of, stamp=None, hasher=key64) -> DataFrame:
    parts = delivery_address_parts()
    names = ("country", "city", "street", "house", "apartment")
    columns = {
        "delivery_address_sk": hasher(*parts),
        **dict(zip(names, parts, strict=True)),
        "postal_code": tidy(F.col("delivery_address_postal_code"), default="", lower=False),
    }
    return customers.where(~is_blank(F.col("delivery_address_country"))).select(
        *_named(columns), *_audit(as_of, stamp)
    )


def dim_product(products: DataFrame, as_of, stamp=None, hasher=key64) -> DataFrame:
    product_id = tidy(F.col("id"))
    nutrition = {
        name: non_negative_double(F.col(f"kbju_{name}"))
        for name in ("calories", "protein", "fat", "carbohydrates")
    }
    columns = {
        "product_sk": hasher(product_id),
        "product_id": product_id,
        "product_name": tidy(F.col("name")),
        "product_group": tidy(F.col("group"), drop=GROUP_DROP),
        "product_description": tidy(F.col("description"), default=""),
        **nutrition,
        "price": fixed_decimal(F.col("price"), 10, 2),
        "unit": tidy(F.col("unit")),
        "origin_country": tidy(F.col("origin_country")),
        "expiry_days": small_positive_int(F.col("expiry_days")),
        "is_organic": truthy(F.col("is_organic")),
        "barcode": tidy(F.col("barcode"), default="", lower=False),
        "manufacturer_sk": maker_key(F.col("manufacturer_inn"), hasher),
    }
    return products.select(*_named(columns), *_audit(as_of, stamp))


def dim_customer(
    customers: DataFrame, as_of, stamp=None, hasher=key64, past_registration: bool = False
) -> DataFrame:
    """``past_registration`` also drops registration times after ``as_of``."""
    customer_id = tidy(F.col("customer_id"))
    registered = seconds_moment(F.col("registration_date"))
    if past_registration:
        registered = F.when(registered <= moment(as_of), registered)
    columns = {
        "customer_sk": hasher(customer_id),
        "customer_id": customer_id,
        "first_name": tidy(F.col("first_name")),
        "last_name": tidy(F.col("last_name")),
        "full_name": full_name(F.col("first_name"), F.col("last_name")),
        "email": tidy(F.col("email")),
        "phone": tidy(F.col("phone"), default="", lower=False),
        "birth_date": day_until(F.col("birth_date"), as_of, EARLIEST_BIRTH),
        "gender": tidy(F.col("gender")),
        "registration_date": registered,
        "is_loyalty_member": truthy(F.col("is_loyalty_member")),
        "loyalty_card_number": tidy(F.col("loyalty_card_number"), default=""),
        "preferred_language": tidy(F.col("preferences_preferred_language")),
        "preferred_payment_method": tidy(F.col("preferences_preferred_payment_method")),
        "receive_promotions": truthy(F.col("preferences_receive_promotions")),
        "purchase_location_sk": location_key("purchase_location", store_location_parts, hasher),
        "delivery_address_sk": location_key("delivery_address", delivery_address_parts, hasher),
    }
    return customers.select(*_named(columns), *_audit(as_of, stamp))


def dim_store(stores: DataFrame, as_of, stamp=None, hasher=key64) -> DataFrame:
    store_id = tidy(F.col("store_id"))
    hours = {
        f"opening_hours_{d}": tidy(F.col(f"opening_hours_{d}"), default="", lower=False)
        for d in ("mon_fri", "sat", "sun")
    }
    flags = {
        name: truthy(F.col(name))
        for name in ("accepts_online_orders", "delivery_available", "warehouse_connected")
    }
    columns = {
        "store_sk": hasher(store_id),
        "store_id": store_id,
        "store_name": tidy(F.col("store_name")),
        "store_network": tidy(F.col("store_network")),
        "store_type_description": tidy(F.col("store_type_description"), default=""),
        "store_type": tidy(F.col("type")),
        "categories": tidy(F.col("categories"), default="", drop=LIST_DROP),
        "manager_name": tidy(F.col("manager_name"), default=""),
        "manager_phone": tidy(F.col("manager_phone"), default="", lower=False),
        "manager_email": tidy(F.col("manager_email"), default=""),
        **hours,
        **flags,
        "last_inventory_date": day_until(F.col("last_inventory_date"), as_of),
        "store_location_sk": location_key("location", store_location_parts, hasher),
    }
    return stores.select(*_named(columns), *_audit(as_of, stamp))


def dim_date(purchases: DataFrame, as_of, stamp=None, holidays: DataFrame | None = None,
             every_header: bool = True) -> DataFrame:
    """Calendar rows of the days that purchase headers fall on.

    A header whose purchase time is missing, broken or in the future falls on the
    day of ``as_of``. ``every_header=False`` leaves that day out unless a purchase
    names it. The distinct dates are combined map-side, so a hot day costs one row
    per task. ``holidays`` (a ``full_date`` column) sets ``is_holiday``.
    """
    text = F.col("purchase_datetime")
    if every_header:
        days = purchases.select(F.to_date(moment_or(text, as_of)).alias("day")).distinct()
    else:
        days = (
            purchases.select(parse_day(text).alias("day"))
            .where(F.col("day").isNotNull() & (F.col("day") <= F.to_date(moment(as_of))))
            .distinct()
        )
    return calendar_for(days, "day", as_of, stamp, holidays)


def calendar_for(days: DataFrame, column: str, as_of, stamp=None, holidays=None) -> DataFrame:
    """Calendar rows for a table of distinct dates."""
    rows = days.select(*_named(calendar_columns(F.col(column))), *_audit(as_of, stamp))
    if holidays is None:
        return rows
    marked = holidays.select("full_date").distinct().withColumn("_holiday", F.lit(1))
    return (
        rows.join(marked, "full_date", "left")
        .withColumn("is_holiday", F.coalesce("_holiday", F.lit(0)))
        .select(*rows.columns)
    )
