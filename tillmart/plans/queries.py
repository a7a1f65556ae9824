"""Registered queries: a Spark callable and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructType, TimestampNTZType, TimestampType

from tillmart.entities import ENTITIES
from tillmart.functions import moments, numbers, privacy
from tillmart.functions.keys import key32
from tillmart.functions.text import GROUP_DROP, LIST_DROP, full_name, tidy, truthy
from tillmart.operators import envelope, features, mart, monitoring, partials, quality, star
from tillmart.operators.pseudonymise import pseudonymise
from tillmart.operators.versions import dedup_by_columns, latest_by_key
from tillmart.plans import jobs, oracle, sample, upkeep
from tillmart.session import fresh_dir
from tillmart.sources import documents, folders, messages, sinks
from tillmart.streaming import ingest, windows

Run = Callable[[SparkSession, str], DataFrame]
AS_OF = sample.AS_OF
NOW = oracle.NOW


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = Query(run, sql)
        return run

    return add


def portable(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and times as text: equal in both engines."""
    shown = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType | TimestampNTZType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        shown.append(value.alias(field.name))
    return df.select(*shown)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- customer features ----------------------------------------------------------

CUSTOM = replace(
    features.DEFAULTS,
    week_days=30, fortnight_days=60, month_days=120, quarter_days=365,
    bulk_above=260000.0, low_cost_below=240000.0, high_spend_above=400000.0,
    recurrent_above=1, loyal_from=8, varied_from=6, family_from=3, fruit_from=1,
    payment_share=0.5, weekend_share=0.3, single_item_share=0.2,
    morning_end=6, lunch_start=11, lunch_end=13, night_start=22,
)


def _features(spark, sf_dir, **options) -> DataFrame:
    return features.customer_features(sample.mart_tables(spark, sf_dir), AS_OF, **options)


def _register_features() -> None:
    for grain in ("item", "purchase"):
        register(f"customer_features_{grain}_grain", oracle.features_sql(grain, features.DEFAULTS))(
            lambda spark, d, g=grain: portable(_features(spark, d, grain=g))
        )
        register(f"customer_metrics_{grain}_grain", oracle.metrics_sql(grain, features.DEFAULTS))(
            lambda spark, d, g=grain: portable(
                features.customer_metrics(sample.mart_tables(spark, d), AS_OF, g)
            )
        )
    register("customer_features_custom_thresholds", oracle.features_sql("item", CUSTOM))(
        lambda spark, d: portable(_features(spark, d, settings=CUSTOM))
    )
    register("customer_features_null_as_zero",
             oracle.features_sql("item", features.DEFAULTS, zero=True))(
        lambda spark, d: portable(_features(spark, d, null_as_zero=True))
    )


_register_features()


@register("customer_features_deduplicated",
          oracle.features_sql("item", features.DEFAULTS, oracle.LATEST_ITEMS))
def _(spark, d):
    tables = sample.mart_tables(spark, d)
    tables["items"] = latest_by_key(
        tables["items"], ["purchase_id", "product_id"], "shipped",
        ["line_number", "quantity", "total_item_price"],
    )
    return portable(features.customer_features(tables, AS_OF))


@register("unique_cities", oracle.with_(oracle.MART, """
    select p.customer_id, count(distinct (s.country, s.city)) as unique_cities
    from purchases p join stores s on p.store_id = s.store_id group by p.customer_id"""))
def _(spark, d):
    t = sample.mart_tables(spark, d)
    return features.unique_cities(t["purchases"], t["stores"], t["locations"])


@register("features_top100", oracle.with_(
    oracle.features_ctes("item", features.DEFAULTS),
    "select * exclude (customer_sk, created_at, exact_spent) from features "
    "order by exact_spent desc nulls last, customer_id limit 100"))
def _(spark, d):
    return portable(features.top_customers(_features(spark, d)))


@register("feature_kpis", oracle.with_(oracle.features_ctes("item", features.DEFAULTS), """
    select count(distinct customer_id) as customers,
      cast((sum(total_purchases) * 200 + count(total_purchases))
        // (2 * count(total_purchases)) as double) / 100 as avg_purchases,
      cast((cast(sum(exact_spent) * 100 as hugeint) * 2 + count(exact_spent))
        // (2 * count(exact_spent)) as double) / 100 as avg_spent,
      cast((cast(sum(cast(avg_cart_amount as decimal(18,6))) * 1000000 as hugeint)
        + 5000 * count(avg_cart_amount)) // (10000 * count(avg_cart_amount)) as double) / 100
        as avg_cart,
      cast((sum(loyal_customer) * 2000 + count(loyal_customer))
        // (2 * count(loyal_customer)) as double) / 1000 as loyal_share
    from features"""))
def _(spark, d):
    return portable(features.feature_kpis(_features(spark, d)))


@register("feature_category_share", oracle.with_(
    oracle.features_ctes("item", features.DEFAULTS),
    " union all ".join(
        f"select '{f}' as feature, cast(sum({f}) as bigint) as customers_set, "
        f"count({f}) as customers_known, cast(sum({f}) as double) / count({f}) as share from features"
        for f in features.FLAGS)))
def _(spark, d):
    return features.flag_totals(_features(spark, d))


# --- mart targets ---------------------------------------------------------------


def _target(spark, d, name) -> DataFrame:
    raw = sample.raw_table(spark, d, mart.TARGETS[name].source)
    return mart.current(name, mart.build_target(name, raw, AS_OF, True, key32))


def _register_targets() -> None:
    for name in mart.TARGETS:
        if name == "dim_date":
            continue
        register(name, oracle.current_sql(name))(
            lambda spark, d, n=name: portable(_target(spark, d, n).drop("fact_sk"))
        )


_register_targets()

_PURCHASE_DAYS = (
    f"select distinct cast({oracle.moment_or('purchase_datetime')} as date) as d from raw_purchases"
)


@register("dim_date", oracle.with_(oracle.raw_ctes("raw_purchases"),
                                   oracle.calendar_sql(_PURCHASE_DAYS)))
def _(spark, d):
    return portable(_target(spark, d, "dim_date"))


@register("fact_sk_uniqueness", oracle.with_(oracle.versions_ctes("fact_purchase_items"), """
    select count(*) as lines, count(distinct (purchase_id, product_id)) as keys,
      count(distinct (purchase_id, product_id)) as surrogate_keys from versions"""))
def _(spark, d):
    raw = sample.raw_table(spark, d, "purchases")
    lines = mart.build_target("fact_purchase_items", raw, AS_OF)
    per_pair = lines.groupBy("fact_sk", "purchase_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    per_key = per_pair.groupBy("fact_sk").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pairs"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("keys"),
        F.count(F.lit(1)).alias("surrogate_keys"),
    )


def _mart_ctes(*names: str) -> dict[str, str]:
    """Current rows of several targets as CTEs named after them."""
    ctes = {}
    for name in names:
        if name == "dim_date":
            ctes["dim_date"] = oracle.with_(
                oracle.raw_ctes("raw_purchases"), oracle.calendar_sql(_PURCHASE_DAYS))
        else:
            ctes[name] = oracle.current_sql(name)
    return ctes


@register("star_purchase_lookup", oracle.with_(_mart_ctes(
    "fact_purchases", "dim_customer", "dim_store", "dim_store_location", "dim_date",
    "dim_delivery_address"), """
    select f.*, c.full_name, c.is_loyalty_member, s.store_name, s.store_network,
      l.city as store_city, t.year_week, t.day_of_week, t.is_weekend, a.city as delivery_city
    from fact_purchases f
    left join dim_customer c on f.customer_sk = c.customer_sk
    left join dim_store s on f.store_sk = s.store_sk
    left join dim_store_location l on s.store_location_sk = l.store_location_sk
    left join dim_date t on f.purchase_date_sk = t.date_sk
    left join dim_delivery_address a on f.delivery_address_sk = a.delivery_address_sk"""))
def _(spark, d):
    names = ("fact_purchases", "dim_customer", "dim_store", "dim_store_location", "dim_date",
             "dim_delivery_address")
    return portable(star.star_purchases({n: _target(spark, d, n) for n in names}))


@register("star_item_lookup", oracle.with_(_mart_ctes(
    "fact_purchase_items", "dim_product", "dim_manufacturer"), """
    select f.*, p.product_name, p.product_group, p.is_organic, m.manufacturer_name,
      m.manufacturer_country
    from fact_purchase_items f left join dim_product p on f.product_sk = p.product_sk
    left join dim_manufacturer m on f.manufacturer_sk = m.manufacturer_sk"""))
def _(spark, d):
    names = ("fact_purchase_items", "dim_product", "dim_manufacturer")
    return portable(star.star_items({n: _target(spark, d, n) for n in names}).drop("fact_sk"))


_BUILT = {
    **_mart_ctes("fact_purchases", "fact_purchase_items", "dim_customer", "dim_product",
                 "dim_store", "dim_date"),
    "purchases": (
        "select purchase_id, customer_id, store_id, payment_method, is_delivery, items_count, "
        "cast(total_amount as decimal(12,2)) as total_amount, purchase_date_sk, "
        "cast(raw_event_time as timestamp) as raw_event_time from fact_purchases"
    ),
    "items": "select purchase_id, product_id from fact_purchase_items",
    "products": "select product_id, product_group, is_organic from dim_product",
    "customers": (
        "select customer_id, cast(cast(registration_date as timestamp) as date) as registration_date, "
        "is_loyalty_member from dim_customer"
    ),
    "stores": "select store_id, store_location_sk from dim_store",
    "dates": "select date_sk as purchase_date_sk, is_weekend from dim_date",
}


def _register_from_raw() -> None:
    for grain in ("item", "purchase"):
        def run(spark, d, g=grain):
            """Raw documents, cleaned, keyed, deduplicated and turned into features."""
            raw = {t: sample.raw_table(spark, d, t) for t in ENTITIES}
            built = mart.build_mart(raw, AS_OF)
            tables = jobs.feature_inputs(lambda name: built[name], dedupe=False)
            rows = features.customer_features(tables, AS_OF, grain=g)
            return portable(rows.drop("customer_sk"))

        register(f"features_from_raw_{grain}_grain", oracle.with_(
            oracle.features_ctes(grain, features.DEFAULTS, base=_BUILT),
            "select * exclude (customer_sk, exact_spent) from features"))(run)


_register_from_raw()


# --- cleaning ---------------------------------------------------------------------


@register("clean_text_matrix", f"""
    select doc_id, md5({oracle.text('text')}) as defaulted, md5({oracle.text('text', '', False)}) as trimmed,
      md5({oracle.text('text', drop=GROUP_DROP)}) as group_text,
      md5({oracle.text('text', '', drop=LIST_DROP)}) as list_text,
      {oracle.text('lang')} as lang, md5(lower(concat(
      {oracle.text('source', lower=False)}, ' ', {oracle.text('text', lower=False)}))) as full_name
    from documents""")
def _(spark, d):
    text = F.col("text")

    def digest(value):
        return F.md5(value.cast("binary"))

    return table(spark, d, "documents").select(
        "doc_id",
        digest(tidy(text)).alias("defaulted"),
        digest(tidy(text, "", lower=False)).alias("trimmed"),
        digest(tidy(text, drop=GROUP_DROP)).alias("group_text"),
        digest(tidy(text, "", drop=LIST_DROP)).alias("list_text"),
        tidy(F.col("lang")).alias("lang"),
        digest(full_name(F.col("source"), text)).alias("full_name"),
    )


_LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
_NUMBER_TEXT = (
    "case when l_partkey % 41 = 0 then '12345678901.50' when l_partkey % 43 = 0 then ' 99999999999999999.5' else "
    "case l_linenumber when 1 then concat(' ', cast(cast(l_extendedprice as decimal(12,2)) as string)) "
    "when 2 then concat('-', cast(cast(l_quantity as int) as string)) when 3 then 'abc' "
    "when 4 then 'nan' when 5 then '' when 6 then concat(cast(cast(l_quantity as int) as string), 'e2') "
    "else concat(cast(l_partkey as string), '.1289') end end"
)
_INT_TEXT = (
    "case l_linenumber when 1 then '0' when 2 then '70000' when 3 then ' 12 ' when 4 then '1.5' "
    "else cast(l_partkey as string) end"
)


@register("clean_numeric_matrix", f"""
    select {', '.join(c for c in _LINE_KEY if c != 'l_shipdate')}, {oracle.clock('l_shipdate')} as l_shipdate,
      {oracle.number('x', '0')} as non_negative, {oracle.number('x', '-180', '180')} as bounded,
      {oracle.money('x')} as price, {oracle.amount('x')} as amount, {oracle.quantity('x')} as quantity,
      {oracle.whole('y')} as small_int
    from (select *, {_NUMBER_TEXT} as x, {_INT_TEXT} as y from lineitem)""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select(
        *_LINE_KEY, F.expr(_NUMBER_TEXT).alias("x"), F.expr(_INT_TEXT).alias("y")
    )
    x = F.col("x")
    return portable(rows.select(
        *_LINE_KEY,
        numbers.non_negative_double(x).alias("non_negative"),
        numbers.bounded_double(x, -180, 180).alias("bounded"),
        numbers.fixed_decimal(x, 12, 2).alias("price"),
        numbers.amount_or_zero(x).alias("amount"),
        numbers.quantity_or_one(x).alias("quantity"),
        numbers.small_positive_int(F.col("y")).alias("small_int"),
    ))


_DATE_TEXT = (
    "case o_orderkey % 9 when 0 then '' when 1 then '2026' when 2 then '2001-3-8' when 3 then '1899-12-31' "
    "when 4 then '2050-01-01' when 5 then 'abc' "
    f"when 6 then {sample._iso(sample.HAPPENED)} when 7 then '1980-05-05garbage' else cast(o_orderdate as string) end"
)
_FLAG_TEXT = (
    "case o_orderkey % 7 when 0 then '' when 1 then 'True' when 2 then ' YES' when 3 then '1' "
    "when 4 then 'no' when 5 then '   ' else 'true' end"
)


@register("clean_flag_date_matrix", f"""
    select o_orderkey, {oracle.flag('f')} as flag, {oracle.day_until('t', '1900-01-01')} as birth_date,
      {oracle.day_until('t')} as past_date, {oracle.clock(oracle.moment("substr(trim(t, ' '), 1, 19)"))} as seconds_time,
      {oracle.clock(oracle.moment_or('t'))} as time_or_now, {oracle.date_key(oracle.moment_or('t'))} as date_sk
    from (select o_orderkey, {_DATE_TEXT} as t, {_FLAG_TEXT} as f from orders)""")
def _(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.expr(_DATE_TEXT).alias("t"), F.expr(_FLAG_TEXT).alias("f")
    )
    t = F.col("t")
    return portable(rows.select(
        "o_orderkey",
        truthy(F.col("f")).alias("flag"),
        moments.day_until(t, AS_OF, "1900-01-01").alias("birth_date"),
        moments.day_until(t, AS_OF).alias("past_date"),
        moments.seconds_moment(t).alias("seconds_time"),
        moments.moment_or(t, AS_OF).alias("time_or_now"),
        moments.date_key(moments.moment_or(t, AS_OF)).alias("date_sk"),
    ))


# --- envelopes --------------------------------------------------------------------

_EVENT_JSON = (
    "case event_id % 10 when 0 then '' when 1 then concat('{\"k\": ', cast(user_id as string)) "
    "when 2 then '[1, 2]' when 3 then '{\"k\": {\"z\": 1}}' when 4 then '{}' else props end"
)
_EVENT_STAMP = (
    "case event_id % 7 when 0 then '' when 1 then 'yesterday' "
    "when 2 then concat(replace(cast(ts as string), ' ', 'T'), 'Z') "
    "when 3 then concat(cast(ts as string), '+03:00') "
    "when 4 then concat(cast(ts as string), '-05:30') else cast(ts as string) end"
)
_EVENT_CLOCK = (
    f"case event_id % 7 when 0 then {NOW} when 1 then null when 2 then ts + interval '3' hour "
    "when 4 then ts + interval '8' hour + interval '30' minute else ts end"
)
_REASON = (
    "case when event_id % 10 = 0 then 'missing json_data' when event_id % 10 = 1 then 'invalid json' "
    "when event_id % 10 = 2 then 'not an object' when event_id % 7 = 1 then 'invalid event_time' end"
)


def _event_envelopes(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id",
        F.col("event_type").alias("topic"),
        F.expr(_EVENT_JSON).alias("json_data"),
        F.expr(_EVENT_STAMP).alias("event_time"),
    )


@register("json_envelope_parse", f"""
    select event_id, event_type as topic, {oracle.clock(_EVENT_CLOCK)} as event_clock,
      case event_id % 10 when 3 then '{{"z":1}}' when 4 then ''
        else regexp_extract(props, '[0-9]+') end as k
    from events where {_REASON} is null""")
def _(spark, d):
    opened = envelope.open_envelopes(_event_envelopes(spark, d), "k STRING", AS_OF)
    return portable(envelope.accepted(opened).select(
        "event_id", "topic", "event_clock", F.coalesce("doc.k", F.lit("")).alias("k")
    ))


@register("dead_letter_split", f"""
    select event_type as topic, {_EVENT_JSON} as json_data, {_EVENT_STAMP} as event_time,
      {_REASON} as reject_reason from events where {_REASON} is not null""")
def _(spark, d):
    opened = envelope.open_envelopes(_event_envelopes(spark, d), "k STRING", AS_OF)
    return envelope.rejected(opened)


@register("event_time_shift", f"""
    select event_id, {oracle.clock(_EVENT_CLOCK)} as moscow_time from events""")
def _(spark, d):
    stamp = F.col("event_time")
    shifted = F.when(stamp == "", moments.moment(AS_OF)).otherwise(
        moments.fixed_offset_clock(stamp)
    )
    return portable(_event_envelopes(spark, d).select("event_id", shifted.alias("moscow_time")))


@register("json_path_lookup", """
    select event_id, regexp_extract(props, '[0-9]+') as k, '' as missing,
      case when event_type = 'click' then 'click' else 'other' end as first_tag,
      cast(user_id as string) as second_tag, '' as beyond
    from events""")
def _(spark, d):
    first = F.when(F.col("event_type") == "click", "click").otherwise("other")
    rows = table(spark, d, "events").select(
        "event_id", "props",
        F.to_json(F.struct(
            F.array(first, F.col("user_id").cast("string")).alias("tags")
        )).alias("doc"),
    )
    rows = envelope.json_paths(rows, "props", {"k": "k", "missing": "k.z"})
    rows = envelope.json_paths(rows, "doc", {"first_tag": "tags.0", "second_tag": "tags.1", "beyond": "tags.2"})
    return rows.drop("props", "doc")


def _flat_names(topic: str) -> list[str]:
    return [n for n in ENTITIES[topic].raw_columns if n != "items"]


def _register_raw() -> None:
    for topic in ENTITIES:
        names = ", ".join(f'"{n}"' for n in _flat_names(topic))
        sql = oracle.with_(
            oracle.raw_ctes(f"raw_{topic}"),
            f"select {oracle.clock('event_time')} as event_time, {names} from raw_{topic}",
        )
        register(f"raw_{topic}_from_envelopes", sql)(
            lambda spark, d, t=topic: portable(
                envelope.to_raw(sample.envelopes(spark, d, t), t, AS_OF)
                .select("event_time", *[f"`{n}`" for n in _flat_names(t)])
            )
        )


_register_raw()

@register("topic_id_routing", oracle.with_(
    oracle.raw_ctes(*[f"raw_{t}" for t in ENTITIES]),
    " union all ".join(
        f"select '{t}' as topic, case when {e.id_column} = '' then '?' else {e.id_column} end as entity_id from raw_{t}"
        for t, e in ENTITIES.items())))
def _(spark, d):
    parts = [
        envelope.with_entity_id(sample.raw_table(spark, d, t), t)
        .select(F.lit(t).alias("topic"), "entity_id")
        for t in ENTITIES
    ]
    return reduce(DataFrame.unionByName, parts)


def _write_documents(rows: DataFrame, folder: str) -> None:
    """One JSON file per document, from many tasks, each of which moves its own files in place.

    A local file is made without its checksum file, which would start a process of its own.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.repartition(parts)
        .write.option("maxRecordsPerFile", 1)
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .option("fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .option("fs.file.impl.disable.cache", "true")
        .json(folder)
    )


@register("document_load", oracle.with_(oracle.raw_ctes("raw_stores"), """
    select store_id, store_name, manager_name, location_city,
      location_coordinates_latitude as latitude, opening_hours_sun, accepts_online_orders from raw_stores"""))
def _(spark, d):
    """One JSON file per store document, loaded twice over into a collection."""
    root = fresh_dir(spark, "documents")
    _write_documents(sample.documents(spark, d, "stores"), f"{root}/in/stores")
    documents.load_documents(spark, f"{root}/in", f"{root}/out", False, ("stores",))
    documents.load_documents(spark, f"{root}/in", f"{root}/out", True, ("stores",))
    return documents.read_collection(spark, "parquet", path=f"{root}/out/stores").select(
        "store_id", "store_name", F.col("manager.name").alias("manager_name"),
        F.col("location.city").alias("location_city"), "location.coordinates.latitude",
        F.col("opening_hours.sun").alias("opening_hours_sun"), "accepts_online_orders",
    )


_ITEM_NAMES = list(sample.flat_item_exprs())


@register("items_explode_roundtrip", oracle.with_(
    oracle.raw_ctes("raw_items"),
    f"select purchase_id, {', '.join(_ITEM_NAMES)} from raw_items where product_id <> ''"))
def _(spark, d):
    raw = envelope.to_raw(sample.envelopes(spark, d, "purchases"), "purchases", AS_OF)
    arrays = envelope.parallel_arrays(raw.select("purchase_id", "items"))
    back = envelope.zip_arrays(arrays)
    from tillmart.operators.facts import explode_items

    return explode_items(back).select("purchase_id", *[f"item.{n}" for n in _ITEM_NAMES])


# --- privacy ----------------------------------------------------------------------


def _phone_sql(x: str) -> str:
    kept = f"regexp_replace({x}, '[^0-9+]', '', 'g')"
    return (
        f"case when starts_with({kept}, '8') or (starts_with({kept}, '7') and not contains({kept}, '+')) "
        f"then '+7' || substr({kept}, 2) when length({kept}) = 10 then '+7' || {kept} else {kept} end"
    )


def _hmac_sql(x: str) -> str:
    key = sample.HMAC_KEY.encode().ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in key).hex()
    outer = bytes(b ^ 0x5C for b in key).hex()
    return (
        f"case when coalesce({x}, '') = '' then '' else sha256(unhex('{outer}') || "
        f"unhex(sha256(unhex('{inner}') || encode({x})))) end"
    )


def _contact_sql(phone: str, email: str) -> str:
    return f"{_hmac_sql(_phone_sql(phone))} as phone, {_hmac_sql(f'lower(trim({email}))')} as email"


@register("pii_pseudonymise", oracle.with_(oracle.raw_ctes("raw_customers"), f"""
    select customer_id, first_name, {_contact_sql('phone', 'email')} from raw_customers"""))
def _(spark, d):
    safe = pseudonymise(sample.documents(spark, d, "customers"), sample.HMAC_KEY, "customers")
    return safe.select("customer_id", "first_name", "phone", "email")


@register("pii_published_purchases", oracle.with_(oracle.raw_ctes("raw_purchases"), f"""
    select customer_customer_id, purchase_datetime,
      {_contact_sql('customer_phone', 'customer_email')} from raw_purchases"""))
def _(spark, d):
    sent = []
    envelopes = jobs.publish(
        sample.documents(spark, d, "purchases"), "purchases", sample.HMAC_KEY, AS_OF, sent.append
    )
    shown = ["customer_customer_id", "purchase_datetime", "customer_phone", "customer_email"]
    raw = envelope.to_raw(envelopes, "purchases", AS_OF, shown)
    return raw.select(
        "customer_customer_id", "purchase_datetime",
        F.col("customer_phone").alias("phone"), F.col("customer_email").alias("email"),
    )


@register("pii_store_managers", oracle.with_(oracle.raw_ctes("raw_stores"), f"""
    select store_id, manager_name, {_contact_sql('manager_phone', 'manager_email')} from raw_stores"""))
def _(spark, d):
    safe = pseudonymise(sample.documents(spark, d, "stores"), sample.HMAC_KEY, "stores")
    return safe.select(
        "store_id", F.col("manager.name").alias("manager_name"), "manager.phone", "manager.email"
    )


@register("phone_normalisation", oracle.with_(oracle.raw_ctes("raw_customers"), f"""
    select customer_id, {_phone_sql('phone')} as phone, lower(trim(email)) as email
    from raw_customers"""))
def _(spark, d):
    return sample.raw_table(spark, d, "customers").select(
        "customer_id",
        privacy.normal_phone(F.col("phone")).alias("phone"),
        privacy.normal_email(F.col("email")).alias("email"),
    )


# --- versions ---------------------------------------------------------------------

_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def _latest_lines_sql(keys: tuple[str, ...], order: tuple[str, ...], extra: str = "") -> str:
    shown = ", ".join(
        f"{oracle.clock(c)} as {c}" if c == "l_shipdate" else c for c in _LINE_COLUMNS
    )
    ordering = ", ".join(f"{c} desc" for c in order)
    return (
        f"select {shown} from (select *, row_number() over (partition by {', '.join(keys)}{extra} "
        f"order by {ordering}) as rn from lineitem) where rn = 1"
    )


_LINE_ID = ("l_orderkey", "l_linenumber")
_LINE_REST = tuple(c for c in _LINE_COLUMNS if c not in (*_LINE_ID, "l_shipdate"))


@register("latest_by_key", _latest_lines_sql(_LINE_ID, ("l_shipdate", *_LINE_REST)))
def _(spark, d):
    return portable(latest_by_key(table(spark, d, "lineitem"), _LINE_ID, "l_shipdate"))


@register("latest_by_key_in_partition", _latest_lines_sql(
    _LINE_ID, ("l_shipdate", *_LINE_REST), ", year(l_shipdate), month(l_shipdate)"))
def _(spark, d):
    month = moments.month_key(F.col("l_shipdate"))
    return portable(
        latest_by_key(table(spark, d, "lineitem"), _LINE_ID, "l_shipdate", within=[month])
    )


_PAIR = ("l_orderkey", "l_partkey")


@register("dedup_by_columns", _latest_lines_sql(
    _PAIR, tuple(c for c in _LINE_COLUMNS if c not in _PAIR)))
def _(spark, d):
    return portable(dedup_by_columns(table(spark, d, "lineitem"), _PAIR))


# --- quality ----------------------------------------------------------------------

_CHECKED = {
    "stores": ("supplier", ("s_nationkey",)),
    "products": ("part", ("p_brand",)),
    "customers": ("events", ("user_id",)),
    "purchases": ("lineitem", ("l_orderkey", "l_linenumber")),
    "headers": ("orders", ("o_orderkey",)),
}


def _stats_sql(name: str, relation: str, keys: tuple[str, ...]) -> str:
    key = ", ".join(keys)
    distinct = f"({key})" if len(keys) > 1 else key
    return (
        f"select '{name}' as \"table\", count(*) as total_records, count(distinct {distinct}) as unique_keys, "
        f"count(*) - count(distinct {distinct}) as duplicate_keys, "
        f"round((count(*) - count(distinct {distinct})) * 100.0 / nullif(count(*), 0), 2)::double as duplicate_percent, "
        f"(select count(*) from (select {key} from {relation} group by {key} having count(*) > 1)) as duplicated_keys "
        f"from {relation}"
    )


_STATS_SQL = " union all ".join(_stats_sql(n, r, k) for n, (r, k) in _CHECKED.items())


def _stats(spark, d) -> DataFrame:
    return quality.duplicate_report(
        {n: (table(spark, d, r), k) for n, (r, k) in _CHECKED.items()}
    )


@register("duplicate_stats", _STATS_SQL)
def _(spark, d):
    return _stats(spark, d)


@register("duplicate_total", f"select cast(sum(duplicate_keys) as bigint) as duplicates from ({_STATS_SQL})")
def _(spark, d):
    return quality.duplicate_total(_stats(spark, d))


@register("duplicated_keys_having",
          f'select "table", duplicated_keys as duplicates from ({_STATS_SQL})')
def _(spark, d):
    return quality.duplicated_keys(_stats(spark, d))


@register("duplicate_alerts", f"""
    select "table", duplicate_percent, 49.0::double as threshold, 'critical' as severity,
      case "table" {' '.join(f"when '{x.table}' then '{x.title}'" for x in quality.ALERT_RULES)}
        else concat("table", ' duplicates') end as title,
      case "table" {' '.join(f"when '{x.table}' then '{x.emoji}'" for x in quality.ALERT_RULES)} else '' end as emoji
    from ({_STATS_SQL}) where duplicate_percent > 49""")
def _(spark, d):
    return quality.duplicate_alerts(_stats(spark, d))


_RULES = {
    "lineitem": (("l_orderkey", "l_linenumber"), "l_shipdate"),
    "events": (("user_id", "event_type"), "ts"),
    "orders": (("o_orderkey",), "o_orderdate"),
}


def _analysis_sql(name: str) -> str:
    keys, version = _RULES[name]
    distinct = f"({', '.join(keys)})" if len(keys) > 1 else keys[0]
    return (
        f"select '{name}' as \"table\", count(*) as rows, count(*) - count(distinct {distinct}) as duplicates, "
        f"'{', '.join(keys)}' as dedup_key, '{version}' as version_column, cast(1 as bigint) as files from {name}"
    )


@register("table_analysis", " union all ".join(_analysis_sql(n) for n in _RULES))
def _(spark, d):
    tables = {n: table(spark, d, n) for n in _RULES}
    return jobs.analyze(tables, _RULES, with_files=True)


def _dedup_sql(strategy: str) -> str:
    parts = []
    for name, (keys, _) in _RULES.items():
        distinct = f"({', '.join(keys)})" if len(keys) > 1 else keys[0]
        parts.append(
            f"select '{name}' as \"table\", '{strategy}' as strategy, count(*) as rows_before, "
            f"count(distinct {distinct}) as rows_after, "
            f"count(*) - count(distinct {distinct}) as duplicates_removed from {name}"
        )
    return " union all ".join(parts)


def _dedup(spark, d, **options) -> DataFrame:
    tables = {n: table(spark, d, n) for n in _RULES}
    return jobs.dedup_tables(spark, tables, fresh_dir(spark, "dedup"), _RULES, **options)


@register("dedup_report", _dedup_sql("version"))
def _(spark, d):
    stats = _dedup(spark, d)
    path = fresh_dir(spark, "report")
    sinks.write_report(stats, path)
    return spark.read.schema(stats.schema).json(path)


@register("dedup_report_by_columns", _dedup_sql("columns"))
def _(spark, d):
    return _dedup(spark, d, strategy=jobs.BY_COLUMNS)


@register("dedup_dry_run", _dedup_sql("version").split(" union all ")[0])
def _(spark, d):
    return _dedup(spark, d, only=["lineitem"], dry_run=True)


@register("dedup_summary", f"""
    select count(*) as tables, cast(sum(rows_before) as bigint) as rows_before,
      cast(sum(rows_after) as bigint) as rows_after,
      cast(sum(duplicates_removed) as bigint) as duplicates_removed from ({_dedup_sql('version')})""")
def _(spark, d):
    return jobs.dedup_summary(_dedup(spark, d, dry_run=True))


_ORPHANS = (
    ("line manufacturer", "fact_purchase_items", "dim_manufacturer", "manufacturer_sk"),
    ("line product", "fact_purchase_items", "dim_product", "product_sk"),
    ("header customer", "fact_purchases", "dim_customer", "customer_sk"),
    ("header store", "fact_purchases", "dim_store", "store_sk"),
    ("header address", "fact_purchases", "dim_delivery_address", "delivery_address_sk"),
    ("header date", "fact_purchases", "dim_date", "purchase_date_sk"),
    ("customer location", "dim_customer", "dim_store_location", "purchase_location_sk"),
    ("customer address", "dim_customer", "dim_delivery_address", "delivery_address_sk"),
    ("store location", "dim_store", "dim_store_location", "store_location_sk"),
    ("product manufacturer", "dim_product", "dim_manufacturer", "manufacturer_sk"),
)
# Dimension keys that differ from the key of the row that refers to them.
_DIM_KEY = {"purchase_date_sk": "date_sk", "purchase_location_sk": "store_location_sk"}


@register("orphan_keys", oracle.with_(
    _mart_ctes("fact_purchase_items", "fact_purchases", "dim_manufacturer", "dim_product",
               "dim_customer", "dim_store", "dim_delivery_address", "dim_date", "dim_store_location"),
    " union all ".join(
        f"select '{label}' as \"check\", count(*) as orphan_rows, count(distinct f.{key}) as orphan_keys "
        f"from {fact} f where f.{key} is not null and not exists "
        f"(select 1 from {dim} x where x.{_DIM_KEY.get(key, key)} = f.{key})"
        for label, fact, dim, key in _ORPHANS)))
def _(spark, d):
    built = {o[1]: _target(spark, d, o[1]) for o in _ORPHANS}
    for dim in {o[2] for o in _ORPHANS} - set(built):
        # A key is held whichever version holds it.
        raw = sample.raw_table(spark, d, mart.TARGETS[dim].source)
        built[dim] = mart.build_target(dim, raw, AS_OF, True, key32)
    return quality.orphan_report(
        [(label, built[fact], built[dim], key, _DIM_KEY.get(key, key)) for label, fact, dim, key in _ORPHANS]
    )


_LINE_SK = oracle.key32("cast(l_orderkey as string)", "cast(l_linenumber as string)")


@register("key_collisions", f"""
    select cast(sum(n) as bigint) as natural_keys, count(*) as surrogate_keys,
      count(*) filter (where n > 1) as colliding_keys
    from (select sk, count(distinct (l_orderkey, l_linenumber)) as n
      from (select *, {_LINE_SK} as sk from lineitem) group by sk)""")
def _(spark, d):
    keyed = table(spark, d, "lineitem").select(
        *_LINE_ID, key32(*[F.col(c).cast("string") for c in _LINE_ID]).alias("sk")
    )
    return quality.key_collisions(keyed, "sk", _LINE_ID)


# --- monitoring -------------------------------------------------------------------

_TABLES = ("customer", "events", "lineitem", "orders", "part", "supplier")


@register("rows_per_table", " union all ".join(
    f"select '{t}' as \"table\", count(*) as records from {t}" for t in _TABLES))
def _(spark, d):
    return monitoring.rows_per_table({t: table(spark, d, t) for t in _TABLES})


@register("rows_total", "select cast(sum(records) as bigint) as total from (" + " union all ".join(
    f"select count(*) as records from {t}" for t in _TABLES) + ")")
def _(spark, d):
    return monitoring.total_rows({t: table(spark, d, t) for t in _TABLES})


@register("table_sizes", " union all ".join(
    f"select '{t}' as \"table\", count(*) as records, count(*) > 0 as has_bytes from {t}" for t in _TABLES))
def _(spark, d):
    """Megabytes depend on the files, not on the rows: compared with the files in a test."""
    sizes = monitoring.table_sizes({t: table(spark, d, t) for t in _TABLES})
    return sizes.select("table", "records", (F.col("size_mb") > 0).alias("has_bytes"))


_HOUR = "date_trunc('hour', ts)"
_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
_FROM, _TO = "2024-01-05 06:30:00", "2024-01-20 18:00:00"


@register("rows_per_hour", " union all ".join(
    f"select '{t}' as \"table\", {oracle.clock(_HOUR)} as time, count(*) as records "
    f"from events where event_type = '{t}' and ts between timestamp '{_FROM}' and timestamp '{_TO}' group by 1, 2"
    for t in _EVENT_TYPES))
def _(spark, d):
    events = table(spark, d, "events")
    tables = {t: events.where(F.col("event_type") == t) for t in _EVENT_TYPES}
    return portable(monitoring.rows_per_hour(tables, _FROM, _TO, "ts"))


def _fresh(spark, d) -> DataFrame:
    tables = {
        "events": table(spark, d, "events").select(F.col("ts").alias("event_time")),
        "orders": table(spark, d, "orders").select(F.col("o_orderdate").alias("event_time")),
        "lineitem": table(spark, d, "lineitem").select(F.col("l_shipdate").alias("event_time")),
    }
    return monitoring.freshness(tables, "2024-02-01 00:00:00.5")


_FRESH_SQL = " union all ".join(
    f"select '{t}' as \"table\", {oracle.clock(f'max({c})')} as last_update, "
    f"(epoch_us(timestamp '2024-02-01 00:00:00.5') - epoch_us(max({c}))) // 1000000 as age_seconds from {t}"
    for t, c in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate")))


@register("freshness", _FRESH_SQL)
def _(spark, d):
    return portable(_fresh(spark, d))


@register("last_update", f'select "table", last_update from ({_FRESH_SQL})')
def _(spark, d):
    return portable(_fresh(spark, d)).select("table", "last_update")


@register("retention_180d", f"""
    select purchase_id, {oracle.clock('raw_event_time')} as event_time from (
      select {sample.MART['purchases'][1]['purchase_id']} as purchase_id, {sample.HAPPENED} as raw_event_time
      from orders) where raw_event_time >= {NOW} - interval '180' day""")
def _(spark, d):
    rows = table(spark, d, "orders").select(
        F.expr(sample.MART["purchases"][1]["purchase_id"]).alias("purchase_id"),
        F.expr(sample.HAPPENED).alias("event_time"),
    )
    return portable(monitoring.keep_recent(rows, AS_OF))


@register("store_map", oracle.with_(oracle.raw_ctes("raw_stores"), f"""
    select distinct store_id, store_name, store_network, location_city as city, location_street as street,
      location_house as house, {oracle.number('location_coordinates_latitude', '-1e308')} as latitude,
      {oracle.number('location_coordinates_longitude', '-1e308')} as longitude from raw_stores"""))
def _(spark, d):
    return monitoring.store_map(sample.raw_table(spark, d, "stores"))


@register("store_counts", oracle.with_(oracle.raw_ctes("raw_stores"), """
    select count(distinct store_id) as stores, count(distinct location_city) as cities,
      count(distinct store_network) as networks,
      count(distinct case when accepts_online_orders in ('True', 'true') then store_id end) as online_stores,
      count(distinct case when delivery_available in ('True', 'true') then store_id end) as delivery_stores
    from raw_stores"""))
def _(spark, d):
    return monitoring.store_counts(sample.raw_table(spark, d, "stores"))


@register("stores_by_network", oracle.with_(oracle.raw_ctes("raw_stores"), """
    select store_network, count(distinct store_id) as stores from raw_stores group by 1"""))
def _(spark, d):
    return monitoring.stores_by_network(sample.raw_table(spark, d, "stores"))


@register("stores_by_city", oracle.with_(oracle.raw_ctes("raw_stores"), """
    select location_city as city, count(distinct store_id) as store_count from raw_stores group by 1"""))
def _(spark, d):
    return monitoring.stores_by_city(sample.raw_table(spark, d, "stores"))


# --- streams ----------------------------------------------------------------------


def _drained(spark, d, topics, with_mart=True) -> ingest.Layout:
    """Ingest of some topics, read as a stream from the sample tables."""
    streams = [sample.envelopes(spark, d, t, stream=True) for t in topics]
    layout = ingest.Layout(fresh_dir(spark, "ingest"))
    jobs.ingest(reduce(DataFrame.unionByName, streams), layout.root, AS_OF, topics,
                with_mart=with_mart)
    return layout


_CUSTOMER_NAMES = _flat_names("customers")


@register("stream_raw_ingest", QUERIES["raw_customers_from_envelopes"].sql)
def _(spark, d):
    layout = _drained(spark, d, ("customers",), with_mart=False)
    raw = ingest.read_raw(spark, layout, "customers")
    return portable(raw.select("event_time", *_CUSTOMER_NAMES))


# All columns but the 64-bit keys, which only Spark computes.
_STREAMED = ("product_id", "product_name", "product_group", "product_description", "calories", "protein", "fat",
             "carbohydrates", "price", "unit", "origin_country", "expiry_days", "is_organic", "barcode",
             "created_at", "updated_at")


@register("stream_mart_upsert", oracle.with_(
    {"dim_product": oracle.current_sql("dim_product")},
    f"select {', '.join(_STREAMED)} from dim_product"))
def _(spark, d):
    layout = _drained(spark, d, ("products",))
    return portable(ingest.read_mart(spark, layout, "dim_product", AS_OF).select(*_STREAMED))


_HEADER = ("purchase_id", "customer_id", "store_id", "purchase_date_sk", "payment_method",
           "total_amount", "is_delivery", "items_count", "raw_event_time", "processed_at")


@register("stream_fact_upsert", oracle.with_(
    {"fact_purchases": oracle.current_sql("fact_purchases")},
    f"select {', '.join(_HEADER)} from fact_purchases"))
def _(spark, d):
    layout = _drained(spark, d, ("purchases", "stores"))
    return portable(ingest.read_mart(spark, layout, "fact_purchases", AS_OF).select(*_HEADER))


@register("stream_dead_letters", f"""
    select event_type as topic, {_EVENT_JSON} as json_data, {_EVENT_STAMP} as event_time,
      'unknown topic' as reject_reason from events""")
def _(spark, d):
    events = sample.table_stream(spark, d, "events").select(
        F.col("event_type").alias("topic"),
        F.expr(_EVENT_JSON).alias("json_data"),
        F.expr(_EVENT_STAMP).alias("event_time"),
    )
    layout = ingest.Layout(fresh_dir(spark, "dead"))
    jobs.ingest(events, layout.root, AS_OF, ("customers",), with_mart=False)
    return ingest.read_dead_letters(spark, layout).drop("batch_id")


@register("stream_hourly_window", f"""
    select event_type as "table", {oracle.clock("date_trunc('hour', ts)")} as time,
      count(*) as records from events group by 1, 2""")
def _(spark, d):
    root = fresh_dir(spark, "hourly")
    windows.start_hourly_counts(
        sample.table_stream(spark, d, "events"), f"{root}/rows", f"{root}/state",
        "event_type", "ts",
    ).awaitTermination()
    return portable(windows.read_hourly_counts(spark, f"{root}/rows"))


def _newest_first(spark, d) -> str:
    """Events as one file a day, the newest day written first, so that streams meet them late."""
    path = fresh_dir(spark, "late")
    events = table(spark, d, "events")
    days = F.date_format("ts", "yyyyMMdd").cast("int")
    turned = events.withColumn("turn", 99999999 - days)
    turned.repartitionByRange(16, "turn").sortWithinPartitions("turn").drop("turn").write.parquet(path)
    return path


@register("stream_late_rows", f"""
    select event_type as "table", {oracle.clock("date_trunc('hour', ts)")} as time,
      count(*) as records from events group by 1, 2""")
def _(spark, d):
    """Hourly counts of events that arrive newest first, in many batches: none is lost."""
    path, root = _newest_first(spark, d), fresh_dir(spark, "late-hours")
    events = spark.readStream.schema(table(spark, d, "events").schema).option("maxFilesPerTrigger", 4)
    windows.start_hourly_counts(
        events.parquet(path), f"{root}/rows", f"{root}/state", "event_type", "ts"
    ).awaitTermination()
    return portable(windows.read_hourly_counts(spark, f"{root}/rows"))


# Fixed values of the split: what comes first, and how long an hour stays open behind the newest row.
_SPLIT, _DELAY = "2024-01-16 00:00:00", "20 days"


@register("stream_window_late_split", f"""
    with mark as (select max(ts) - interval '{_DELAY}' as mark from events),
    told as (
      select event_type, date_trunc('hour', ts) as hour,
        ts < timestamp '{_SPLIT}' and date_trunc('hour', ts) + interval '1' hour <= mark as late from events, mark)
    select event_type as "table", {oracle.clock('hour')} as time,
      count(*) filter (not late) as on_time, count(*) filter (late) as late, count(*) as records
    from told group by 1, 2""")
def _(spark, d):
    """Newer events come first, then the older ones: hours that are final by then take no more rows."""
    path, root = fresh_dir(spark, "split"), fresh_dir(spark, "split-hours")
    events = table(spark, d, "events")
    stream = spark.readStream.schema(events.schema)
    for part in (F.col("ts") >= F.lit(_SPLIT).cast("timestamp"), F.col("ts") < F.lit(_SPLIT).cast("timestamp")):
        events.where(part).write.mode("append").parquet(path)
        windows.start_windows(
            stream.parquet(path), f"{root}/rows", f"{root}/state", "event_type", "ts", _DELAY
        ).awaitTermination()
    on_time = windows.read_closed(spark, f"{root}/rows").unionByName(windows.read_open(spark, f"{root}/rows"))
    late = windows.hourly_counts(windows.read_late(spark, f"{root}/rows", events.schema), "event_type", "ts")
    none = F.lit(0).cast("bigint")
    both = on_time.withColumn("late", none).unionByName(late.select("table", "time", none.alias("records"), F.col("records").alias("late")))
    sums = both.groupBy("table", "time").agg(F.sum("records").alias("on_time"), F.sum("late").alias("late"))
    return portable(sums.withColumn("records", F.col("on_time") + F.col("late")))


@register("stream_versions_in_one_batch", f"""
    select event_type, {oracle.clock('ts')} as ts, event_id, user_id from (
      select *, row_number() over (partition by event_type order by ts desc, event_id desc) as rn from events)
    where rn = 1""")
def _(spark, d):
    """Every event is a version of its type: the newest one stays, whatever shares its batch."""
    root = fresh_dir(spark, "versions")
    events = sample.table_stream(spark, d, "events").select("event_type", "ts", "event_id", "user_id")
    ingest.upsert_stream(
        events, f"{root}/rows", f"{root}/state", ["event_type"], ["ts", "event_id"]
    ).awaitTermination()
    return portable(ingest.newest(spark, f"{root}/rows", events.schema, "event_type", ["ts", "event_id"]))


@register("stream_dedup_watermark", f"""
    select event_id, {oracle.clock('ts')} as ts, user_id, event_type, value, props from events""")
def _(spark, d):
    root = fresh_dir(spark, "unique")
    events = sample.table_stream(spark, d, "events")
    twice = events.unionByName(sample.table_stream(spark, d, "events"))
    windows.start_unique(twice, f"{root}/rows", f"{root}/state", "event_id", "ts").awaitTermination()
    return portable(sinks.read_batches(spark, f"{root}/rows", events.schema).drop("batch_id"))


@register("stream_upsert_by_key", f"""
    select event_id, {oracle.clock('ts')} as ts, user_id, event_type, value, props from events""")
def _(spark, d):
    root = fresh_dir(spark, "upsert")
    events = sample.table_stream(spark, d, "events")
    twice = events.unionByName(sample.table_stream(spark, d, "events"))
    ingest.upsert_stream(
        twice, f"{root}/rows", f"{root}/state", ["event_id"], "ts"
    ).awaitTermination()
    return portable(ingest.newest(spark, f"{root}/rows", events.schema, "event_id", "ts"))


_ALERT_STATS = " union all ".join(
    f"select '{t}' as \"table\", round((count(*) - count(distinct user_id)) * 100.0 / nullif(count(*), 0), 2)::double "
    f"as duplicate_percent from events where event_type = '{t}'" for t in _EVENT_TYPES)


@register("stream_alerts", f"""
    select "table", duplicate_percent, 49.0::double as threshold, 'critical' as severity,
      concat("table", ' duplicates') as title, '' as emoji
    from ({_ALERT_STATS}) where duplicate_percent > 49""")
def _(spark, d):
    """Users that repeat within an event type, watched by the stream."""
    root = fresh_dir(spark, "alerts")
    windows.start_alerts(
        sample.table_stream(spark, d, "events"), root, f"{root}/state", "event_type", "user_id"
    ).awaitTermination()
    return windows.read_alerts(spark, root)


def _in_batches(spark, d, topic, batches=4, with_mart=True) -> str:
    """Ingest target of one topic that arrived in several batches."""
    root = fresh_dir(spark, "upkeep")
    sent = sample.envelopes(spark, d, topic)
    # Purchases come in many parts from their join; a shuffle of whole messages would be their size.
    messages.publish_files(sent if topic == "purchases" else sent.repartition(batches), f"{root}/log")
    files = sum(n.startswith("part-") for n in folders.data_files(spark, f"{root}/log"))
    _ingest_more(spark, root, topic, with_mart, max(1, files // batches))
    return root


def _ingest_more(spark, root, topic, with_mart=True, files=1) -> None:
    """Takes what has come into the log since, in batches of so many files."""
    jobs.ingest(messages.file_stream(spark, f"{root}/log", files), root, AS_OF, (topic,), with_mart=with_mart)


@register("compact_versions", oracle.with_(
    {"dim_product": oracle.current_sql("dim_product")},
    f"select {', '.join(_STREAMED)}, 1 as batches from dim_product"))
def _(spark, d):
    """Versions of several batches merged at rest; one generation of them is left."""
    root = _in_batches(spark, d, "products")
    upkeep.compact_versions(spark, root, "dim_product", AS_OF)
    layout = ingest.Layout(root)
    left = len(upkeep.partition_values(spark, layout.mart("dim_product"), "batch_id"))
    left += len(upkeep.partition_values(spark, layout.merged("dim_product"), "merged_upto"))
    rows = ingest.read_versions(spark, layout, "dim_product", AS_OF).select(*_STREAMED)
    return portable(rows).withColumn("batches", F.lit(left))


@register("compact_versions_replayed", oracle.with_(
    {"dim_product": oracle.current_sql("dim_product")},
    f"select {', '.join(_STREAMED)}, 2 as parts from dim_product"))
def _(spark, d):
    """The stream stops before it commits its last batch, and replays it after the merge.

    The replayed batch lies beside the generation that covers it, and no row is lost or twice.
    """
    root = _in_batches(spark, d, "products")
    layout = ingest.Layout(root)
    last = max(upkeep.partition_values(spark, layout.mart("dim_product"), "batch_id"))
    upkeep.compact_versions(spark, root, "dim_product", AS_OF)
    upkeep.delete(spark, f"{layout.checkpoint}/commits/{last}")
    _ingest_more(spark, root, "products")
    parts = len(upkeep.partition_values(spark, layout.mart("dim_product"), "batch_id"))
    parts += len(upkeep.partition_values(spark, layout.merged("dim_product"), "merged_upto"))
    rows = ingest.read_versions(spark, layout, "dim_product", AS_OF).select(*_STREAMED)
    return portable(rows).withColumn("parts", F.lit(parts))


@register("apply_retention", oracle.with_(oracle.raw_ctes("raw_purchases"), f"""
    select purchase_id, {oracle.clock('event_time')} as event_time from raw_purchases
    where event_time >= {NOW} - interval '45' day"""))
def _(spark, d):
    """Raw rows that a retention of 45 days leaves."""
    root = _in_batches(spark, d, "purchases", with_mart=False)
    upkeep.apply_retention(spark, root, AS_OF, 45, ("purchases",))
    return portable(ingest.read_raw(spark, ingest.Layout(root), "purchases").select("purchase_id", "event_time"))


@register("apply_retention_resumed", oracle.with_(oracle.raw_ctes("raw_purchases"), f"""
    select purchase_id, {oracle.clock('event_time')} as event_time, count(*) as copies from (
      select * from raw_purchases union all select * from raw_purchases where purchase_id like '%7')
    where event_time >= {NOW} - interval '45' day group by all"""))
def _(spark, d):
    """Retention fails while it swaps folders, more messages come, and the job is repeated."""
    root = _in_batches(spark, d, "purchases", with_mart=False)
    lost = []

    def failing(session, path):
        lost.extend([path] if "batch_id=" in path else [])
        if len(lost) == 2:  # one folder is swapped, the next one half
            raise OSError("lost")
        folders.delete(session, path)

    upkeep.delete = failing
    try:
        upkeep.apply_retention(spark, root, AS_OF, 45, ("purchases",))
    except OSError:
        pass
    finally:
        upkeep.delete = folders.delete
    messages.publish_files(sample.envelopes(spark, d, "purchases", id_ends="7"), f"{root}/log")
    _ingest_more(spark, root, "purchases", with_mart=False, files=1000)
    upkeep.apply_retention(spark, root, AS_OF, 45, ("purchases",))
    rows = ingest.read_raw(spark, ingest.Layout(root), "purchases")
    return portable(rows.groupBy("purchase_id", "event_time").agg(F.count("*").alias("copies")))


# Purchases from this day on, and those of one earlier month whose number ends in 7, come late.
_LATE = "raw_event_time >= '1998-03-01' or (purchase_id like '%7' and date_trunc('month', raw_event_time) = '1995-05-01')"


@register("features_incremental", oracle.features_sql("item", features.DEFAULTS))
def _(spark, d):
    """The feature table from daily partials: a first run, late purchases, and a run of the months they change.

    Purchases are stored by month first, as the mart keeps them, and the calendar beside them.
    """
    tables, path, mart_dir = sample.mart_tables(spark, d), fresh_dir(spark, "partials"), fresh_dir(spark, "mart")
    sinks.write_partitioned(partials.with_purchase_month(tables["purchases"]), f"{mart_dir}/purchases", [partials.MONTH])
    tables["purchases"] = spark.read.parquet(f"{mart_dir}/purchases")
    sample.calendar(tables["purchases"]).write.parquet(f"{mart_dir}/dates")
    tables["dates"] = spark.read.parquet(f"{mart_dir}/dates")
    late = F.coalesce(F.expr(_LATE), F.lit(False))
    partials.refresh(tables | {"purchases": tables["purchases"].where(~late)}, path)
    months = partials.changed_months(tables["purchases"].where(late))
    partials.refresh(tables, path, months)
    return portable(partials.features_from_partials(spark, path, tables, AS_OF))


def _mart_stats_sql() -> str:
    parts = []
    for name, target in mart.TARGETS.items():
        if name == "dim_date":
            rows = oracle.with_(oracle.raw_ctes("raw_purchases"), oracle.calendar_sql(_PURCHASE_DAYS))
        else:
            rows = oracle.with_(oracle.versions_ctes(name), "select * from versions")
        parts.append(_stats_sql(name, f"({rows})", target.key))
    rows = oracle.with_(oracle.features_ctes("item", features.DEFAULTS), "select * from features")
    parts.append(_stats_sql("customer_features_mart", f"({rows})", mart.FEATURES_KEY))
    return " union all ".join(parts)


@register("mart_duplicate_stats", _mart_stats_sql())
def _(spark, d):
    """Duplicate figures of the nine mart tables before merging, and of the feature table."""
    tables = {
        name: mart.build_target(name, sample.raw_table(spark, d, target.source), AS_OF, True, key32)
        for name, target in mart.TARGETS.items()
    }
    tables["customer_features_mart"] = _features(spark, d)
    return jobs.mart_duplicates(tables)


@register("publish_all_topics", oracle.with_(
    oracle.raw_ctes(*[f"raw_{t}" for t in ENTITIES]),
    " union all ".join(f"select '{t}' as topic, {e.id_column} as entity_id from raw_{t}" for t, e in ENTITIES.items())))
def _(spark, d):
    """All topics published in one call and read back from the log."""
    log = fresh_dir(spark, "topics")
    jobs.publish_all(lambda t: sample.documents(spark, d, t), sample.HMAC_KEY, AS_OF, log)
    sent = spark.read.schema(messages.ENVELOPE).json(log)
    parts = [
        envelope.to_raw(sent.where(F.col("topic") == t), t, AS_OF)
        .select(F.lit(t).alias("topic"), F.col(f"`{e.id_column}`").alias("entity_id"))
        for t, e in ENTITIES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- sinks ------------------------------------------------------------------------

_FILE_SQL = oracle.with_(
    oracle.features_ctes("item", features.DEFAULTS),
    "select * exclude (customer_sk, created_at, exact_spent) from features")


def _roundtrip(spark, d, fmt: str) -> DataFrame:
    result = _features(spark, d)
    written = sinks.write_results(result, AS_OF, (fmt,), folder=fresh_dir(spark, "result"))
    schema = StructType([f for f in result.schema.fields if f.name not in sinks.TECHNICAL])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return portable(reader.option("header", True).csv(written[fmt]))
    return portable(reader.json(written[fmt]))


@register("sink_roundtrip_csv", _FILE_SQL)
def _(spark, d):
    return _roundtrip(spark, d, "csv")


@register("sink_roundtrip_json", _FILE_SQL)
def _(spark, d):
    return _roundtrip(spark, d, "json")


_SHOWN = ("customer_id", "total_purchases", "store_loyal", "no_purchases", "fruit_lover")


@register("sink_all_formats", oracle.with_(
    oracle.features_ctes("item", features.DEFAULTS),
    " union all ".join(
        f"select '{sink}' as sink, {', '.join(_SHOWN)} from features"
        for sink in ("table", "csv", "json", "export_csv", "export_json"))))
def _(spark, d):
    """One run of the feature job into every sink that needs no server."""
    folder, location = fresh_dir(spark, "results"), fresh_dir(spark, "table")
    name = "all_" + location[-12:]
    rows = _features(spark, d)
    columns = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    spark.sql(f"create table {name} ({columns}) using parquet location '{location}'")
    written = sinks.write_results(
        rows, AS_OF, ("table", "csv", "json", "export"), folder, name, export_root=f"{folder}/store"
    )
    spark.sql(f"drop table {name}")
    schema = StructType([f for f in rows.schema.fields if f.name not in sinks.TECHNICAL])
    parts = [spark.read.parquet(location).select(F.lit("table").alias("sink"), *_SHOWN)]
    for sink, path in written.items():
        if sink != "table":
            reader = spark.read.schema(schema)
            read = reader.option("header", True).csv(path) if sink.endswith("csv") else reader.json(path)
            parts.append(read.select(F.lit(sink).alias("sink"), *_SHOWN))
    return reduce(DataFrame.unionByName, parts)


@register("sink_table_replace", oracle.with_(
    oracle.features_ctes("item", features.DEFAULTS),
    "select customer_id, customer_sk, total_purchases, total_spent, store_loyal from features"))
def _(spark, d):
    """Truncate and refill of an existing table; the second run replaces the first."""
    path = fresh_dir(spark, "mart")
    name = "features_" + path[-12:]
    spark.sql(
        f"create table {name} (customer_id string, customer_sk bigint, total_purchases bigint, "
        f"total_spent decimal(14,2), store_loyal int) using parquet location '{path}'"
    )
    rows = _features(spark, d)
    for part in (rows.where("no_purchases = 1"), rows):
        sinks.write_results(part, AS_OF, ("table",), table=name)
    spark.sql(f"drop table {name}")
    return portable(spark.read.parquet(path))


@register("raw_months", oracle.with_(oracle.raw_ctes("raw_purchases"), """
    select cast(year(event_time) * 100 + month(event_time) as int) as event_month, count(*) as records
    from raw_purchases where event_time >= timestamp '2001-03-01 00:00:00' group by 1"""))
def _(spark, d):
    path = fresh_dir(spark, "raw")
    sinks.append_raw(sample.raw_table(spark, d, "purchases"), path)
    stored = monitoring.in_time_range(spark.read.parquet(path), "2001-03-01")
    return stored.groupBy("event_month").agg(F.count(F.lit(1)).alias("records"))
