"""Customer metrics and the thirty behavioural flags.

Plan shape. Lines are folded to (purchase, product group) counts and joined
1:few to headers, so header columns are never repeated per line. Two branches
are then combined map-side on wider keys than the customer, (customer, store)
for header measures and (customer, product group) for line measures, before
the per-customer step. Distinct stores and categories fall out as row counts of
those steps, so no multi-distinct expansion is needed, and a customer, purchase
or product holding a large part of all rows is reduced before every shuffle.

``grain="item"`` weights each header by its line count, which equals
aggregating after a header-to-line join. ``grain="purchase"`` counts each
header once. Inputs hold one row per key (see ``latest_by_key``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions.moments import days_before, moment
from tillmart.functions.numbers import share

ITEM, PURCHASE = "item", "purchase"


@dataclass(frozen=True)
class FeatureSettings:
    """Every threshold of the feature job."""

    # Defaults of the day windows, limits and hours.
    week_days: int = 7
    fortnight_days: int = 14
    month_days: int = 30
    quarter_days: int = 90
    recurrent_above: int = 2
    loyal_from: int = 3
    bulk_above: float = 1000.0
    low_cost_below: float = 200.0
    payment_share: float = 0.7
    weekend_share: float = 0.6
    single_item_share: float = 0.5
    varied_from: int = 4
    family_from: int = 4
    fruit_from: int = 3
    high_spend_above: float = 2000.0
    morning_end: int = 10
    lunch_start: int = 12
    lunch_end: int = 15
    night_start: int = 20
    # Stems looked for in the lower-cased product group.
    dairy: tuple[str, ...] = ("молочн",)
    fruit: tuple[str, ...] = ("фрукт",)
    veggie: tuple[str, ...] = ("овощ",)
    meat: tuple[str, ...] = ("мясо", "рыб", "яйц")
    bakery: tuple[str, ...] = ("хлеб", "зернов")
    # Count only events not after as_of in the day windows.
    past_only: bool = False

    @property
    def windows(self) -> dict[str, int]:
        return {
            "7d": self.week_days,
            "14d": self.fortnight_days,
            "30d": self.month_days,
            "90d": self.quarter_days,
        }


DEFAULTS = FeatureSettings()


def in_category(group: Column, stems: tuple[str, ...]) -> Column:
    lowered = F.lower(group)
    return reduce(lambda a, b: a | b, [lowered.contains(s) for s in stems])


def _total(condition: Column, amount: Column | int = 1) -> Column:
    return F.sum(F.when(condition, amount).otherwise(0))


def _age_test(settings: FeatureSettings, age: Column, days: int) -> Column:
    return age.between(0, days) if settings.past_only else age <= days


def prepare_headers(purchases: DataFrame, as_of, dates: DataFrame | None = None) -> DataFrame:
    """Headers reduced to what the metrics need, with age and weekend flag.

    Without ``dates`` the weekend flag is NULL and the calendar is not read.
    """
    if dates is None:
        dated = purchases.withColumn("is_weekend", F.lit(None).cast("int"))
    else:
        weekend = dates.select(F.col("date_sk").alias("purchase_date_sk"), "is_weekend")
        dated = purchases.join(weekend, "purchase_date_sk", "left")
    return dated.select(
        "customer_id",
        "purchase_id",
        "store_id",
        "raw_event_time",
        "total_amount",
        "items_count",
        F.col("is_delivery").cast("int").alias("is_delivery"),
        "payment_method",
        F.col("is_weekend").cast("int").alias("is_weekend"),
        F.hour("raw_event_time").alias("_hour"),
        days_before(as_of, F.col("raw_event_time")).alias("_age"),
    )


def fold_lines(items: DataFrame, products: DataFrame, keys: Sequence[str] = ("purchase_id",)) -> DataFrame:
    """Lines with their product, folded to one row per (purchase, group); ``keys`` tell the purchase."""
    described = items.select(*keys, "product_id").join(
        products.select("product_id", "product_group", "is_organic"), "product_id", "left"
    )
    return described.groupBy(*keys, "product_group").agg(
        F.count(F.lit(1)).alias("_lines"),
        F.sum(F.col("is_organic").cast("int")).alias("_organic"),
    )


def plain_sums(settings: FeatureSettings, weight: Column) -> dict[str, Column]:
    """Additive header measures of any time, each header counted ``weight`` times."""
    amount, items_count = F.col("total_amount"), F.col("items_count")
    hour = F.col("_hour")
    method = F.col("payment_method")
    decimal_weight = weight.cast("decimal(18,0)")
    return {
        "row_count": F.sum(weight),
        "amount_rows": _total(amount.isNotNull(), weight),
        "total_spent": F.sum(amount * decimal_weight),
        "items_rows": _total(items_count.isNotNull(), weight),
        "items_total": F.sum(items_count * weight),
        "delivery_count": F.sum(F.col("is_delivery") * weight),
        "cash_payments": _total(method == "cash", weight),
        "card_payments": _total(method == "card", weight),
        "weekend_purchases": F.sum(F.col("is_weekend") * weight),
        "night_purchases": _total(hour >= settings.night_start, weight),
        "morning_purchases": _total(hour < settings.morning_end, weight),
        "lunch_purchases": _total(
            (hour >= settings.lunch_start) & (hour < settings.lunch_end), weight
        ),
        "single_item_purchases": _total(items_count == 1, weight),
    }


def aged_sums(settings: FeatureSettings, spent: Column, rows: Column) -> dict[str, Column]:
    """Header measures of the last days, over what was spent and how many rows there were."""
    age = F.col("_age")
    return {
        "spent_last_7d": _total(_age_test(settings, age, settings.week_days), spent),
        "purchases_last_14d": _total(_age_test(settings, age, settings.fortnight_days), rows),
        "purchases_last_30d": _total(_age_test(settings, age, settings.month_days), rows),
    }


def _header_sums(settings: FeatureSettings, weight: Column) -> dict[str, Column]:
    spent = F.col("total_amount") * weight.cast("decimal(18,0)")
    return plain_sums(settings, weight) | aged_sums(settings, spent, weight)


def aged_lines(settings: FeatureSettings, count: Column) -> dict[str, Column]:
    """Lines of the last days, for each window of days."""
    return {f"_lines_{w}": _total(_age_test(settings, F.col("_age"), d), count) for w, d in settings.windows.items()}


def _header_branch(headers: DataFrame, stores: DataFrame, settings, with_sums: bool) -> DataFrame:
    """Per customer: purchase count, first and last time, stores, locations."""
    sums = _header_sums(settings, F.lit(1)) if with_sums else {}
    per_store = headers.groupBy("customer_id", "store_id").agg(
        F.count("purchase_id").alias("total_purchases"),
        F.min("raw_event_time").alias("first_purchase_date"),
        F.max("raw_event_time").alias("last_purchase_date"),
        *[v.alias(k) for k, v in sums.items()],
    )
    return from_stores(per_store, stores, list(sums))


def from_stores(per_store: DataFrame, stores: DataFrame, sums: list[str]) -> DataFrame:
    """(customer, store) rows to one row per customer."""
    located = per_store.join(
        stores.select("store_id", "store_location_sk"), "store_id", "left"
    )
    return located.groupBy("customer_id").agg(
        F.sum("total_purchases").alias("total_purchases"),
        F.min("first_purchase_date").alias("first_purchase_date"),
        F.max("last_purchase_date").alias("last_purchase_date"),
        F.count("store_id").alias("unique_stores"),
        F.count_distinct("store_location_sk").alias("unique_locations"),
        *[F.sum(k).alias(k) for k in sums],
    )


def _line_branch(headers: DataFrame, lines: DataFrame, settings, with_sums: bool) -> DataFrame:
    """Per customer: category counts by age, organic lines, distinct groups."""
    count = F.coalesce("_lines", F.lit(0))
    sums = (
        _header_sums(settings, F.greatest(count, F.lit(1))) if with_sums else {}
    )
    aged = aged_lines(settings, count)
    per_group = (
        headers.join(lines, "purchase_id", "left")
        .groupBy("customer_id", "product_group")
        .agg(
            F.sum(count).alias("_lines_all"),
            F.sum("_organic").alias("organic_purchases"),
            *[v.alias(k) for k, v in aged.items()],
            *[v.alias(k) for k, v in sums.items()],
        )
    )
    return from_groups(per_group, settings, list(sums))


def from_groups(per_group: DataFrame, settings: FeatureSettings, sums: list[str]) -> DataFrame:
    """(customer, product group) rows to one row per customer."""
    group = F.col("product_group")
    tests = {name: in_category(group, getattr(settings, name)) for name in _CATEGORY_WINDOWS}
    categories = {
        _category_metric(name, w): _total(tests[name], F.col(f"_lines_{w}"))
        for name, windows in _CATEGORY_WINDOWS.items()
        for w in windows
    }
    return per_group.groupBy("customer_id").agg(
        F.count("product_group").alias("unique_categories"),
        F.sum("organic_purchases").alias("organic_purchases"),
        *[v.alias(k) for k, v in categories.items()],
        *[F.sum(k).alias(k) for k in sums],
    )


# Day windows in which each category is counted.
_CATEGORY_WINDOWS = {
    "dairy": ("all", "30d"),
    "fruit": ("all", "14d", "30d"),
    "veggie": ("all", "14d"),
    "meat": ("all", "7d", "90d"),
    "bakery": ("all",),
}


def _category_metric(name: str, window: str) -> str:
    return f"{name}_purchases" if window == "all" else f"{name}_purchases_{window}"


# Metric columns in output order; the category counts carry their day window.
METRICS = (
    "total_purchases", "first_purchase_date", "last_purchase_date",
    "avg_cart_amount", "total_spent", "avg_items_count", "delivery_count",
    "cash_payments", "card_payments", "weekend_purchases", "row_count",
    "night_purchases", "morning_purchases", "lunch_purchases",
    "unique_stores", "unique_locations", "unique_categories",
    "dairy_purchases", "fruit_purchases", "veggie_purchases", "meat_purchases",
    "bakery_purchases", "organic_purchases", "single_item_purchases",
    "spent_last_7d", "purchases_last_14d", "purchases_last_30d",
    "dairy_purchases_30d", "fruit_purchases_14d", "fruit_purchases_30d",
    "veggie_purchases_14d", "meat_purchases_7d", "meat_purchases_90d",
)


def customer_metrics(
    tables: dict[str, DataFrame],
    as_of,
    grain: str = ITEM,
    settings: FeatureSettings = DEFAULTS,
) -> DataFrame:
    """One row per customer with purchases; see :data:`METRICS`.

    ``tables`` holds purchases, items, products, stores and dates.
    """
    if grain not in (ITEM, PURCHASE):
        raise ValueError(f"grain must be {ITEM!r} or {PURCHASE!r}, not {grain!r}")
    plain = prepare_headers(tables["purchases"], as_of)
    dated = prepare_headers(tables["purchases"], as_of, tables["dates"])
    lines = fold_lines(tables["items"], tables["products"])
    # Header measures belong to exactly one branch; only that one needs dates.
    weighted = grain == ITEM
    by_header = _header_branch(
        plain if weighted else dated, tables["stores"], settings, not weighted
    )
    by_line = _line_branch(dated if weighted else plain, lines, settings, weighted)
    return joined_metrics(by_header, by_line)


def joined_metrics(by_header: DataFrame, by_line: DataFrame) -> DataFrame:
    """The metrics of a customer from both branches."""
    joined = by_header.join(by_line, "customer_id")
    cart = (F.col("total_spent") / F.nullif("amount_rows", F.lit(0))).cast("decimal(24,6)")
    items = F.try_divide(F.col("items_total").cast("double"), F.col("items_rows"))
    derived = {"avg_cart_amount": cart, "avg_items_count": items}
    return joined.select(
        "customer_id", *[derived.get(m, F.col(m)).alias(m) for m in METRICS]
    )


def _flags(s: FeatureSettings, as_of) -> dict[str, Column]:
    """Flag expressions over one row of metrics and customer attributes."""

    def n(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    purchases, rows = F.col("total_purchases"), F.col("row_count")
    idle = days_before(as_of, F.col("last_purchase_date"))
    weekday_rows = n("row_count") - n("weekend_purchases")
    cart = n("avg_cart_amount")
    return {
        # No coalesce: NULL for customers without purchases or registration.
        "bought_milk_last_30d": F.col("dairy_purchases_30d") > 0,
        "bought_fruits_last_14d": F.col("fruit_purchases_14d") > 0,
        "not_bought_veggies_14d": n("veggie_purchases_14d") == 0,
        "recurrent_buyer": n("purchases_last_30d") > s.recurrent_above,
        "inactive_14_30": idle.between(s.fortnight_days, s.month_days),
        "new_customer": _age_test(s, days_before(as_of, F.col("registration_date")), s.month_days),
        "delivery_user": n("delivery_count") > 0,
        "organic_preference": n("organic_purchases") > 0,
        "bulk_buyer": cart > s.bulk_above,
        "low_cost_buyer": cart < s.low_cost_below,
        "buys_bakery": n("bakery_purchases") > 0,
        "loyal_customer": (F.col("is_loyalty_member").cast("int") == 1)
        & (n("total_purchases") >= s.loyal_from),
        "multicity_buyer": n("unique_locations") > 1,
        "bought_meat_last_week": n("meat_purchases_7d") > 0,
        "night_shopper": n("night_purchases") > 0,
        "morning_shopper": n("morning_purchases") > 0,
        "prefers_cash": share(F.col("cash_payments"), purchases) >= s.payment_share,
        "prefers_card": share(F.col("card_payments"), purchases) >= s.payment_share,
        "weekend_shopper": share(F.col("weekend_purchases"), rows) >= s.weekend_share,
        "weekday_shopper": share(weekday_rows, rows) >= s.weekend_share,
        "single_item_buyer": share(F.col("single_item_purchases"), purchases)
        >= s.single_item_share,
        "varied_shopper": n("unique_categories") >= s.varied_from,
        "store_loyal": n("unique_stores") == 1,
        "switching_store": n("unique_stores") > 1,
        "family_shopper": n("avg_items_count") >= s.family_from,
        "early_bird": n("lunch_purchases") > 0,
        "no_purchases": n("total_purchases") == 0,
        "recent_high_spender": n("spent_last_7d") > s.high_spend_above,
        "fruit_lover": n("fruit_purchases_30d") >= s.fruit_from,
        "vegetarian_profile": (n("meat_purchases_90d") == 0) & (n("total_purchases") > 0),
    }


# Flag names in output order.
FLAGS = (
    "bought_milk_last_30d",
    "bought_fruits_last_14d",
    "not_bought_veggies_14d",
    "recurrent_buyer",
    "inactive_14_30",
    "new_customer",
    "delivery_user",
    "organic_preference",
    "bulk_buyer",
    "low_cost_buyer",
    "buys_bakery",
    "loyal_customer",
    "multicity_buyer",
    "bought_meat_last_week",
    "night_shopper",
    "morning_shopper",
    "prefers_cash",
    "prefers_card",
    "weekend_shopper",
    "weekday_shopper",
    "single_item_buyer",
    "varied_shopper",
    "store_loyal",
    "switching_store",
    "family_shopper",
    "early_bird",
    "no_purchases",
    "recent_high_spender",
    "fruit_lover",
    "vegetarian_profile",
)
TOTALS = ("total_purchases", "total_spent", "avg_cart_amount")


def customer_features(
    tables: dict[str, DataFrame],
    as_of,
    grain: str = ITEM,
    settings: FeatureSettings = DEFAULTS,
    null_as_zero: bool = False,
) -> DataFrame:
    """One row per customer: ids, 30 flags (0/1), 3 totals, ``created_at``.

    Customers without purchases are kept, purchases of unknown customers are
    dropped. ``null_as_zero`` replaces the NULL flags of customers for whom
    the condition cannot be evaluated.
    """
    metrics = customer_metrics(tables, as_of, grain, settings)
    return with_flags(tables["customers"], metrics, as_of, settings, null_as_zero)


def with_flags(
    customers: DataFrame, metrics: DataFrame, as_of, settings: FeatureSettings = DEFAULTS, null_as_zero: bool = False
) -> DataFrame:
    """The feature row of every customer from the metrics of those with purchases."""
    people = customers.select(
        "customer_id", "customer_sk", "registration_date", "is_loyalty_member"
    )
    rows = people.join(metrics, "customer_id", "left")
    conditions = _flags(settings, as_of)
    flags = []
    for name in FLAGS:
        value = conditions[name].cast("int")
        if null_as_zero:
            value = F.coalesce(value, F.lit(0))
        flags.append(value.alias(name))
    return rows.select(
        "customer_id", "customer_sk", *flags, *TOTALS, moment(as_of).alias("created_at")
    )


def unique_cities(purchases: DataFrame, stores: DataFrame, locations: DataFrame) -> DataFrame:
    """Distinct cities per customer, through the location dimension."""
    where = stores.select("store_id", "store_location_sk").join(
        locations.select("store_location_sk", "country", "city"), "store_location_sk"
    )
    pairs = purchases.groupBy("customer_id", "store_id").agg(F.lit(1).alias("_one"))
    cities = pairs.join(where.drop("store_location_sk"), "store_id")
    return (
        cities.select("customer_id", "country", "city")
        .distinct()
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("unique_cities"))
    )


def top_customers(features: DataFrame, limit: int = 100) -> DataFrame:
    """Highest spenders first; ties in customer order."""
    return (
        features.orderBy(F.col("total_spent").desc_nulls_last(), "customer_id")
        .limit(limit)
        .drop("customer_sk", "created_at")
    )


def feature_kpis(features: DataFrame) -> DataFrame:
    """Number cards over the feature table, one row."""
    return features.agg(
        F.count("customer_id").alias("customers"),
        F.round(F.avg("total_purchases"), 2).alias("avg_purchases"),
        F.round(F.avg("total_spent"), 2).alias("avg_spent"),
        F.round(F.avg("avg_cart_amount"), 2).alias("avg_cart"),
        F.round(F.avg("loyal_customer"), 3).alias("loyal_share"),
    )


def flag_totals(features: DataFrame) -> DataFrame:
    """Customers per flag: set, evaluated, and the share that is set."""
    sums = features.agg(
        *[F.sum(f).alias(f) for f in FLAGS], *[F.count(f).alias(f"{f}_known") for f in FLAGS]
    )
    entry = [
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("customers_set"),
                 F.col(f"{f}_known").alias("customers_known"))
        for f in FLAGS
    ]
    return sums.select(F.inline(F.array(*entry))).withColumn(
        "share", F.try_divide("customers_set", "customers_known")
    )
