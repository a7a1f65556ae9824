"""DuckDB SQL that states the expected result of each registered query.

Written as plain joins and aggregates, on purpose not in the shape the Spark
operators use. Money comes out as double, dates and times as text, on both
sides alike.
"""

from __future__ import annotations

from tillmart.entities import ENTITIES
from tillmart.operators.features import FLAGS, METRICS, FeatureSettings
from tillmart.plans import sample

AS_OF = sample.AS_OF
DAY = f"date '{AS_OF}'"
NOW = f"timestamp '{AS_OF} 00:00:00'"


def with_(ctes: dict[str, str], body: str) -> str:
    return "with " + ",\n".join(f"{n} as ({sql})" for n, sql in ctes.items()) + "\n" + body


def columns(exprs: dict[str, str]) -> str:
    return ", ".join(f'{sql} as "{name}"' for name, sql in exprs.items())


def key32(*parts: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws(chr(1), {', '.join(parts)})), 1, 8) as bigint)"


def clock(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def day_text(day: str) -> str:
    return f"strftime({day}, '%Y-%m-%d')"


# --- cleaning -----------------------------------------------------------------


def text(x: str, default: str = "unknown", lower: bool = True, drop: str | None = None) -> str:
    inner = f"regexp_replace({x}, '{drop}', '', 'g')" if drop else x
    inner = f"trim({inner}, ' ')"
    if lower:
        inner = f"lower({inner})"
    return f"case when coalesce({x}, '') = '' then '{default}' else {inner} end"


# Characters that stay in product groups and in lists.
GROUP_DROP = r"[^а-яА-ЯёЁa-zA-Z0-9\s-]"
LIST_DROP = r"[^а-яА-ЯёЁa-zA-Z0-9\s,.-]"


def flag(x: str) -> str:
    return f"case when lower(trim({x}, ' ')) in ('true', '1', 'yes') then 1 else 0 end"


def number(x: str, low: str, high: str = "1e308") -> str:
    v = f"try_cast(trim({x}, ' ') as double)"
    return (
        f"case when regexp_matches({x}, '[dDfFxX]') or {v} is null or isnan({v}) "
        f"or {v} < {low} or {v} > {high} then null else {v} end"
    )


def _decimal(x: str) -> str:
    return f"try_cast(trim({x}, ' ') as decimal(30,6))"


def money(x: str, scale: int = 2, precision: int = 12) -> str:
    """Non-negative decimal that fits, surplus digits cut."""
    v = _decimal(x)
    return (
        f"case when {v} >= 0 and {v} < {10 ** (precision - scale)} "
        f"then cast(floor({v} * {10 ** scale}) as double) / {10 ** scale} end"
    )


def amount(x: str) -> str:
    v = _decimal(x)
    return f"case when coalesce({v}, -1) < 0 then 0.0 else {money(x, 2, 18)} end"


def quantity(x: str) -> str:
    v = _decimal(x)
    return f"case when coalesce({v}, -1) < 0.001 then 1.0 else {money(x, 3, 18)} end"


def whole(x: str) -> str:
    v = f"try_cast(trim({x}, ' ') as int)"
    return (
        f"case when regexp_matches(trim({x}, ' '), '^[0-9]+$') and {v} between 1 and 65535 "
        f"then {v} end"
    )


def day(x: str) -> str:
    return (
        f"case when length(trim({x}, ' ')) = 10 and regexp_matches({x}, '-[0-9]{{2}}-') "
        f"then try_cast(trim({x}, ' ') as date) "
        f"when regexp_matches(trim({x}, ' '), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]') "
        f"and try_cast(trim({x}, ' ') as timestamp) is not null "
        f"then try_cast(substr(trim({x}, ' '), 1, 10) as date) end"
    )


def moment(x: str) -> str:
    return (
        f"case when regexp_matches(trim({x}, ' '), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"then try_cast(trim({x}, ' ') as timestamp) end"
    )


def day_until(x: str, earliest: str | None = None) -> str:
    low = f" and {day(x)} >= date '{earliest}'" if earliest else ""
    return day_text(f"case when {day(x)} <= {DAY}{low} then {day(x)} end")


def moment_or(x: str) -> str:
    return f"case when {moment(x)} <= {NOW} then {moment(x)} else {NOW} end"


def date_key(ts: str) -> str:
    return f"cast(strftime({ts}, '%Y%m%d') as int)"


# --- inputs -------------------------------------------------------------------


def raw_cte(topic: str) -> str:
    relation, key, exprs = sample.DOCUMENTS[topic]
    flat = {p.replace(".", "_"): sql for p, sql in exprs.items() if p != "items"}
    if relation == sample.BASKETS_FROM:
        relation = sample.ORDERS_FROM
    return f"select {sample.event_time(key)} as event_time, {columns(flat)} from {relation}"


RAW_ITEMS = (
    "select o_orderkey, l_linenumber, "
    + columns(sample.flat_item_exprs())
    + f", {sample._PURCHASE['purchase_id']} as purchase_id, {sample.event_time('o_orderkey')} as event_time"
    + " from orders join lineitem on o_orderkey = l_orderkey"
)
RAW = {
    **{f"raw_{t}": raw_cte(t) for t in ENTITIES},
    "raw_items": RAW_ITEMS,
}
MART = {
    **{n: f"select {columns(cols)} from {rel}" for n, (rel, cols) in sample.MART.items()},
    "stores": (
        "select concat('store-', cast(s_suppkey as string)) as store_id, "
        f"{key32('lower(r_name)', 'lower(n_name)')} as store_location_sk, "
        f"lower(r_name) as country, lower(n_name) as city from {sample.STORE_FROM}"
    ),
    "dates": (
        "select distinct purchase_date_sk, "
        "case when isodow(cast(raw_event_time as date)) >= 6 then 1 else 0 end as is_weekend "
        "from purchases"
    ),
}


def raw_ctes(*names: str) -> dict[str, str]:
    return {n: RAW[n] for n in names}


# --- features -----------------------------------------------------------------

_CATEGORY = {
    "dairy": "contains(lower(product_group), 'молочн')",
    "fruit": "contains(lower(product_group), 'фрукт')",
    "veggie": "contains(lower(product_group), 'овощ')",
    "meat": (
        "(contains(lower(product_group), 'мясо') or contains(lower(product_group), 'рыб') "
        "or contains(lower(product_group), 'яйц'))"
    ),
    "bakery": "(contains(lower(product_group), 'хлеб') or contains(lower(product_group), 'зернов'))",
}


def _n(condition: str, amount: str = "1") -> str:
    return f"sum(case when {condition} then {amount} else 0 end)"


def _cents(total: str, count: str) -> str:
    """Mean of a decimal(.,2) rounded half up to 6 digits, in integers."""
    cents = f"cast({total} * 100 as hugeint)"
    n = f"cast({count} as hugeint)"
    return (
        f"cast(({cents} * 20000 + {n}) // (2 * {n}) as double) / 1000000"
    )


def feature_ctes(grain: str, s: FeatureSettings, items_sql: str | None = None,
                 base: dict[str, str] | None = None) -> dict[str, str]:
    ctes = dict(base or MART)
    if items_sql:
        ctes["all_items"] = ctes.pop("items")
        ctes["items"] = items_sql
    ctes["lines"] = (
        "select i.purchase_id, pr.product_group, pr.is_organic from items i "
        "left join products pr on i.product_id = pr.product_id"
    )
    ctes["headers"] = (
        "select p.*, st.store_location_sk, d.is_weekend, hour(p.raw_event_time) as hr, "
        f"datediff('day', cast(p.raw_event_time as date), {DAY}) as age from purchases p "
        "left join stores st on p.store_id = st.store_id "
        "left join dates d on p.purchase_date_sk = d.purchase_date_sk"
    )
    ctes["full_rows"] = (
        "select h.*, l.product_group, l.is_organic from headers h "
        "left join lines l on h.purchase_id = l.purchase_id"
    )
    header = {
        "row_count": "count(purchase_id)",
        "amount_rows": "count(total_amount)",
        "total_spent": "sum(total_amount)",
        "items_rows": "count(items_count)",
        "items_total": "sum(items_count)",
        "delivery_count": "sum(is_delivery)",
        "cash_payments": _n("payment_method = 'cash'"),
        "card_payments": _n("payment_method = 'card'"),
        "weekend_purchases": "sum(is_weekend)",
        "night_purchases": _n(f"hr >= {s.night_start}"),
        "morning_purchases": _n(f"hr < {s.morning_end}"),
        "lunch_purchases": _n(f"hr >= {s.lunch_start} and hr < {s.lunch_end}"),
        "single_item_purchases": _n("items_count = 1"),
        "spent_last_7d": _n(f"age <= {s.week_days}", "total_amount"),
        "purchases_last_14d": _n(f"age <= {s.fortnight_days}"),
        "purchases_last_30d": _n(f"age <= {s.month_days}"),
    }
    identity = {
        "total_purchases": "count(distinct purchase_id)",
        "first_purchase_date": "min(raw_event_time)",
        "last_purchase_date": "max(raw_event_time)",
        "unique_stores": "count(distinct store_id)",
        "unique_locations": "count(distinct store_location_sk)",
    }
    line = {
        "unique_categories": "count(distinct product_group)",
        "organic_purchases": "sum(is_organic)",
        **{f"{c}_purchases": _n(p) for c, p in _CATEGORY.items()},
        "dairy_purchases_30d": _n(f"{_CATEGORY['dairy']} and age <= {s.month_days}"),
        "fruit_purchases_14d": _n(f"{_CATEGORY['fruit']} and age <= {s.fortnight_days}"),
        "fruit_purchases_30d": _n(f"{_CATEGORY['fruit']} and age <= {s.month_days}"),
        "veggie_purchases_14d": _n(f"{_CATEGORY['veggie']} and age <= {s.fortnight_days}"),
        "meat_purchases_7d": _n(f"{_CATEGORY['meat']} and age <= {s.week_days}"),
        "meat_purchases_90d": _n(f"{_CATEGORY['meat']} and age <= {s.quarter_days}"),
    }
    if grain == "item":
        ctes["metrics"] = (
            f"select customer_id, {columns({**identity, **header, **line})} "
            "from full_rows group by customer_id"
        )
    else:
        ctes["by_header"] = (
            f"select customer_id, {columns({**identity, **header})} from headers group by customer_id"
        )
        ctes["by_line"] = (
            f"select customer_id, {columns(line)} from full_rows group by customer_id"
        )
        ctes["metrics"] = "select * from by_header join by_line using (customer_id)"
    return ctes


def _metric_output() -> str:
    special = {
        "first_purchase_date": clock("first_purchase_date"),
        "last_purchase_date": clock("last_purchase_date"),
        "avg_cart_amount": _cents("total_spent", "amount_rows"),
        "avg_items_count": "cast(items_total as double) / items_rows",
        "total_spent": "cast(total_spent as double)",
        "spent_last_7d": "cast(spent_last_7d as double)",
    }
    return ", ".join(
        f"{special.get(m, f'cast({m} as bigint)')} as {m}" for m in METRICS
    )


def metrics_sql(grain: str, settings: FeatureSettings) -> str:
    return with_(feature_ctes(grain, settings),
                 f"select customer_id, {_metric_output()} from metrics")


def _share(part: str, whole: str) -> str:
    return f"cast(coalesce({part}, 0) as double) / greatest(coalesce({whole}, 1), 1)"


def _mean_over(limit: float, sign: str) -> str:
    """Mean cart compared without rounding; no purchases count as zero."""
    return (
        f"case when coalesce(amount_rows, 0) = 0 then 0 {sign} {limit} "
        f"else total_spent {sign} {int(limit)} * amount_rows end"
    )


def flag_sql(s: FeatureSettings) -> dict[str, str]:
    idle = f"datediff('day', cast(last_purchase_date as date), {DAY})"
    return {
        "bought_milk_last_30d": "dairy_purchases_30d > 0",
        "bought_fruits_last_14d": "fruit_purchases_14d > 0",
        "not_bought_veggies_14d": "coalesce(veggie_purchases_14d, 0) = 0",
        "recurrent_buyer": f"coalesce(purchases_last_30d, 0) > {s.recurrent_above}",
        "inactive_14_30": f"{idle} >= {s.fortnight_days} and {idle} <= {s.month_days}",
        "new_customer": f"datediff('day', registration_date, {DAY}) <= {s.month_days}",
        "delivery_user": "coalesce(delivery_count, 0) > 0",
        "organic_preference": "coalesce(organic_purchases, 0) > 0",
        "bulk_buyer": _mean_over(s.bulk_above, ">"),
        "low_cost_buyer": _mean_over(s.low_cost_below, "<"),
        "buys_bakery": "coalesce(bakery_purchases, 0) > 0",
        "loyal_customer": f"is_loyalty_member = 1 and coalesce(total_purchases, 0) >= {s.loyal_from}",
        "multicity_buyer": "coalesce(unique_locations, 0) > 1",
        "bought_meat_last_week": "coalesce(meat_purchases_7d, 0) > 0",
        "night_shopper": "coalesce(night_purchases, 0) > 0",
        "morning_shopper": "coalesce(morning_purchases, 0) > 0",
        "prefers_cash": f"{_share('cash_payments', 'total_purchases')} >= {s.payment_share}",
        "prefers_card": f"{_share('card_payments', 'total_purchases')} >= {s.payment_share}",
        "weekend_shopper": f"{_share('weekend_purchases', 'row_count')} >= {s.weekend_share}",
        "weekday_shopper": (
            f"{_share('row_count - weekend_purchases', 'row_count')} >= {s.weekend_share}"
        ),
        "single_item_buyer": (
            f"{_share('single_item_purchases', 'total_purchases')} >= {s.single_item_share}"
        ),
        "varied_shopper": f"coalesce(unique_categories, 0) >= {s.varied_from}",
        "store_loyal": "coalesce(unique_stores, 0) = 1",
        "switching_store": "coalesce(unique_stores, 0) > 1",
        "family_shopper": (
            f"coalesce(cast(items_total as double) / items_rows, 0) >= {s.family_from}"
        ),
        "early_bird": "coalesce(lunch_purchases, 0) > 0",
        "no_purchases": "coalesce(total_purchases, 0) = 0",
        "recent_high_spender": f"coalesce(spent_last_7d, 0) > {int(s.high_spend_above)}",
        "fruit_lover": f"coalesce(fruit_purchases_30d, 0) >= {s.fruit_from}",
        "vegetarian_profile": (
            "coalesce(meat_purchases_90d, 0) = 0 and coalesce(total_purchases, 0) > 0"
        ),
    }


def features_ctes(grain: str, s: FeatureSettings, items_sql: str | None = None,
                  zero: bool = False, base: dict[str, str] | None = None) -> dict[str, str]:
    flags = flag_sql(s)

    def one(name: str) -> str:
        value = f"cast(({flags[name]}) as int)"
        return f"coalesce({value}, 0)" if zero else value

    ctes = feature_ctes(grain, s, items_sql, base)
    ctes["features"] = (
        f"select c.customer_id, {key32('c.customer_id')} as customer_sk, "
        + ", ".join(f"{one(f)} as {f}" for f in FLAGS)
        + ", cast(total_purchases as bigint) as total_purchases, "
        "cast(total_spent as double) as total_spent, "
        f"{_cents('total_spent', 'amount_rows')} as avg_cart_amount, "
        "total_spent as exact_spent, "
        f"{clock(NOW)} as created_at "
        "from customers c left join metrics m on c.customer_id = m.customer_id"
    )
    return ctes


_FEATURE_COLUMNS = "* exclude (exact_spent)"


def features_sql(grain: str, s: FeatureSettings, items_sql: str | None = None,
                 zero: bool = False) -> str:
    return with_(features_ctes(grain, s, items_sql, zero), f"select {_FEATURE_COLUMNS} from features")


LATEST_ITEMS = (
    "select * exclude (rn) from (select *, row_number() over (partition by purchase_id, product_id "
    "order by shipped desc, line_number desc, quantity desc, total_item_price desc) as rn "
    "from all_items) where rn = 1"
)

# --- dimensions and facts -------------------------------------------------------


def _parts(prefix: str, apartment: bool = False) -> list[str]:
    parts = [text(f"{prefix}_{p}") for p in ("country", "city", "street", "house")]
    if apartment:
        parts.append(text(f"{prefix}_apartment", ""))
    return parts


def _fk(lead: str, *parts: str) -> str:
    return f"case when coalesce({lead}, '') <> '' then {key32(*parts)} end"


_LOCATION = ("country", "city", "street", "house")


def dim_exprs() -> dict[str, tuple[str, str, str, dict[str, str]]]:
    """Per target: raw relation, filter, key column, output expressions."""
    store_parts = _parts("location")
    delivery_parts = _parts("delivery_address", True)
    return {
        "dim_manufacturer": ("raw_products", "manufacturer_inn <> ''", "manufacturer_sk", {
            "manufacturer_sk": key32(text("manufacturer_inn")),
            "manufacturer_inn": text("manufacturer_inn"),
            "manufacturer_name": text("manufacturer_name"),
            "manufacturer_country": text("manufacturer_country"),
            "manufacturer_website": text("manufacturer_website", ""),
        }),
        "dim_store_location": ("raw_stores", "true", "store_location_sk", {
            "store_location_sk": key32(*store_parts),
            **dict(zip(_LOCATION, store_parts, strict=True)),
            "postal_code": text("location_postal_code", "", lower=False),
            "latitude": number("location_coordinates_latitude", "-90", "90"),
            "longitude": number("location_coordinates_longitude", "-180", "180"),
        }),
        "dim_delivery_address": ("raw_customers", "delivery_address_country <> ''",
                                 "delivery_address_sk", {
            "delivery_address_sk": key32(*delivery_parts),
            **dict(zip((*_LOCATION, "apartment"), delivery_parts, strict=True)),
            "postal_code": text("delivery_address_postal_code", "", lower=False),
        }),
        "dim_product": ("raw_products", "true", "product_sk", {
            "product_sk": key32(text("id")),
            "product_id": text("id"),
            "product_name": text("name"),
            "product_group": text('"group"', drop=GROUP_DROP),
            "product_description": text("description", ""),
            **{n: number(f"kbju_{n}", "0") for n in ("calories", "protein", "fat", "carbohydrates")},
            "price": money("price", 2, 10),
            "unit": text("unit"),
            "origin_country": text("origin_country"),
            "expiry_days": whole("expiry_days"),
            "is_organic": flag("is_organic"),
            "barcode": text("barcode", "", lower=False),
            "manufacturer_sk": _fk("manufacturer_inn", text("manufacturer_inn")),
        }),
        "dim_customer": ("raw_customers", "true", "customer_sk", {
            "customer_sk": key32(text("customer_id")),
            "customer_id": text("customer_id"),
            "first_name": text("first_name"),
            "last_name": text("last_name"),
            "full_name": (
                f"lower(concat({text('first_name', lower=False)}, ' ', "
                f"{text('last_name', lower=False)}))"
            ),
            "email": text("email"),
            "phone": text("phone", "", lower=False),
            "birth_date": day_until("birth_date", "1900-01-01"),
            "gender": text("gender"),
            "registration_date": clock(moment("substr(trim(registration_date, ' '), 1, 19)")),
            "is_loyalty_member": flag("is_loyalty_member"),
            "loyalty_card_number": text("loyalty_card_number", ""),
            "preferred_language": text("preferences_preferred_language"),
            "preferred_payment_method": text("preferences_preferred_payment_method"),
            "receive_promotions": flag("preferences_receive_promotions"),
            "purchase_location_sk": _fk("purchase_location_country", *_parts("purchase_location")),
            "delivery_address_sk": _fk("delivery_address_country", *delivery_parts),
        }),
        "dim_store": ("raw_stores", "true", "store_sk", {
            "store_sk": key32(text("store_id")),
            "store_id": text("store_id"),
            "store_name": text("store_name"),
            "store_network": text("store_network"),
            "store_type_description": text("store_type_description", ""),
            "store_type": text("type"),
            "categories": text("categories", "", drop=LIST_DROP),
            "manager_name": text("manager_name", ""),
            "manager_phone": text("manager_phone", "", lower=False),
            "manager_email": text("manager_email", ""),
            **{f"opening_hours_{d}": text(f"opening_hours_{d}", "", lower=False)
               for d in ("mon_fri", "sat", "sun")},
            **{f: flag(f) for f in ("accepts_online_orders", "delivery_available",
                                    "warehouse_connected")},
            "last_inventory_date": day_until("last_inventory_date"),
            "store_location_sk": _fk("location_country", *store_parts),
        }),
        "fact_purchases": ("raw_purchases", "purchase_id <> ''", "purchase_id", {
            "purchase_id": text("purchase_id"),
            "customer_id": text("customer_customer_id"),
            "store_id": text("store_store_id"),
            "customer_sk": key32(text("customer_customer_id")),
            "store_sk": key32(text("store_store_id")),
            "purchase_date_sk": date_key(moment_or("purchase_datetime")),
            "delivery_address_sk": _fk("delivery_address_country", *delivery_parts),
            "payment_method": text("payment_method"),
            "total_amount": amount("total_amount"),
            "is_delivery": flag("is_delivery"),
            "items_count": "items_count",
            "raw_event_time": clock(moment_or("purchase_datetime")),
        }),
        "fact_purchase_items": ("raw_items", "product_id <> ''", "purchase_id, product_id", {
            "purchase_id": text("purchase_id"),
            "product_id": text("product_id"),
            "product_sk": key32(text("product_id")),
            "manufacturer_sk": _fk("manufacturer_inn", text("manufacturer_inn")),
            "quantity": quantity("quantity"),
            "unit": text("unit"),
            "price_per_unit": amount("price_per_unit"),
            "total_item_price": amount("total_price"),
            **{f"item_{n}": number(f"kbju_{n}", "0")
               for n in ("calories", "protein", "fat", "carbohydrates")},
            "product_category": text("category", drop=GROUP_DROP),
        }),
    }


_VERSIONS = {"fact_purchases": "processed_at", "fact_purchase_items": "processed_at"}
PURCHASES_WITH_COUNT = {
    "raw_items": RAW["raw_items"],
    "raw_headers": RAW["raw_purchases"].replace(
        "select ", "select cast(coalesce(n_lines, 0) as int) as items_count, ", 1),
}


def _base(relation: str) -> dict[str, str]:
    if relation == "raw_purchases":
        return {"raw_purchases": PURCHASES_WITH_COUNT["raw_headers"]}
    return raw_ctes(relation)


def versions_ctes(name: str) -> dict[str, str]:
    relation, condition, _, exprs = dim_exprs()[name]
    ctes = _base(relation)
    version = _VERSIONS.get(name, "updated_at")
    audit = f"{clock('event_time')} as {version}"
    if version == "updated_at":
        audit = f"{clock(NOW)} as created_at, {audit}"
    ctes["versions"] = (
        f"select {columns(exprs)}, {audit} from {relation} where {condition}"
    )
    return ctes


def current_sql(name: str) -> str:
    """Newest version per key, ties broken by every other column."""
    _, _, key, exprs = dim_exprs()[name]
    version = _VERSIONS.get(name, "updated_at")
    keys = [k.strip() for k in key.split(",")]
    ties = [c for c in exprs if c not in keys]
    order = ", ".join(f"{c} desc nulls last" for c in (version, *ties))
    return with_(versions_ctes(name), (
        f"select * exclude (rn) from (select *, row_number() over (partition by {key} "
        f"order by {order}) as rn from versions) where rn = 1"
    ))


def _week(d: str) -> str:
    w1 = f"((((isodow({d}) - 1) - (dayofyear({d}) - 1)) % 7) + 7) % 7"
    return (
        f"(cast(floor((dayofyear({d}) - 1 + {w1}) / 7) as int) + "
        f"case when {w1} <= 3 then 1 else 0 end)"
    )


def calendar_sql(days: str) -> str:
    """Calendar of a relation ``days(d)`` given as SQL."""
    # Russian month and day names.
    months = "['Январь','Февраль','Март','Апрель','Май','Июнь','Июль','Август','Сентябрь','Октябрь','Ноябрь','Декабрь']"
    names = "['Понедельник','Вторник','Среда','Четверг','Пятница','Суббота','Воскресенье']"
    start = "cast(date_trunc('month', d) as date)"
    exprs = {
        "date_sk": date_key("d"),
        "full_date": day_text("d"),
        "year": "cast(year(d) as int)",
        "year_name": "'Год ' || year(d)",
        "is_leap_year": (
            "case when (year(d) % 4 = 0 and year(d) % 100 <> 0) or year(d) % 400 = 0 "
            "then 1 else 0 end"
        ),
        "quarter": "cast(quarter(d) as int)",
        "quarter_name": "'Q' || quarter(d)",
        "year_quarter": "year(d) || '-Q' || quarter(d)",
        "month": "cast(month(d) as int)",
        "month_name": f"({months})[month(d)]",
        "year_month": "strftime(d, '%Y-%m')",
        "days_in_month": "cast(day(last_day(d)) as int)",
        "week_of_year": _week("d"),
        "week_of_month": f"{_week('d')} - {_week(start)} + 1",
        "year_week": f"year(d) || '-W' || lpad(cast({_week('d')} as string), 2, '0')",
        "day_of_month": "cast(day(d) as int)",
        "day_of_year": "cast(dayofyear(d) as int)",
        "day_of_week": "cast(isodow(d) as int)",
        "day_name": f"({names})[isodow(d)]",
        "is_weekend": "case when isodow(d) >= 6 then 1 else 0 end",
        "is_holiday": "0",
        "created_at": clock(NOW),
        "updated_at": clock(NOW),
    }
    return f"select {columns(exprs)} from ({days})"
