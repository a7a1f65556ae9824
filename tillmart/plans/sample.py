"""The retail model over the sample tables.

Every expression is plain SQL that Spark and DuckDB read alike, so the same
text defines the input of a query on both sides. Some values are made dirty on
purpose (blank, out of range, wrong type) to exercise the cleaning rules.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tillmart.entities import ENTITIES, leaf_paths
from tillmart.functions.keys import key32
from tillmart.operators.dimensions import calendar_for

AS_OF = "2001-08-02"
HMAC_KEY = "sample-key"

# Product group texts as they arrive, per part type: an emoji, a comma, and the stem
# of one feature category each.
GROUPS = {
    "ECONOMY": "🍞 Свежий хлеб, выпечка",
    "SMALL": "🍗 Птица, мясо, рыба",
    "MEDIUM": "🧀 Сыр, творог, всё молочное",
    "PROMO": "🍓 Сезонные фрукты, компоты",
    "STANDARD": "🥕 Наши овощи, салаты",
    "LARGE": "",
}
RAW_GROUP = "case p_type " + " ".join(
    f"when '{k}' then '{v}'" for k, v in GROUPS.items()
) + " end"
_DROPPED = "🍞🍗🧀🍓🥕,"
CLEAN_GROUP = (
    f"case when p_type = 'LARGE' then 'unknown' else "
    f"trim(lower(translate({RAW_GROUP}, '{_DROPPED}', ''))) end"
)

PAYMENT = (
    "case when substr(o_orderpriority, 1, 1) in ('1', '2') then 'cash' "
    "when substr(o_orderpriority, 1, 1) in ('3', '4') then 'card' else 'online' end"
)
HAPPENED = "o_orderdate + (o_orderkey % 24) * interval '1' hour"
# Some purchases name a customer nobody knows, and some go to a neighbour, so that
# customers 7 and 8 of every fifty have none.
BUYER = (
    "case o_custkey % 50 when 7 then concat('cus-x', cast(o_custkey as string)) "
    "when 8 then concat('cus-', cast(o_custkey + 1 as string)) "
    "else concat('cus-', cast(o_custkey as string)) end"
)
ORDERS_FROM = (
    "orders left join (select l_orderkey as counted_key, count(*) as n_lines from lineitem "
    "group by l_orderkey) on o_orderkey = counted_key"
)

# Typed mart-shaped inputs of the feature job.
MART = {
    "purchases": (ORDERS_FROM, {
        "purchase_id": "concat('ord-', cast(o_orderkey as string))",
        "customer_id": BUYER,
        "store_id": "concat('store-', cast(o_orderkey % 10 as string))",
        "total_amount": "cast(o_totalprice as decimal(12,2))",
        "payment_method": PAYMENT,
        "is_delivery": "case when o_orderstatus = 'F' then 1 else 0 end",
        "items_count": "cast(coalesce(n_lines, 0) as int)",
        "raw_event_time": HAPPENED,
        "purchase_date_sk": (
            "cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 "
            "+ day(o_orderdate) as int)"
        ),
    }),
    "items": ("lineitem", {
        "purchase_id": "concat('ord-', cast(l_orderkey as string))",
        "line_number": "l_linenumber",
        "product_id": "concat('prd-', cast(l_partkey as string))",
        "quantity": "cast(l_quantity as decimal(10,3))",
        "total_item_price": "cast(l_extendedprice as decimal(12,2))",
        "shipped": "l_shipdate",
    }),
    "products": ("part", {
        "product_id": "concat('prd-', cast(p_partkey as string))",
        "product_group": CLEAN_GROUP,
        "is_organic": "cast(p_size % 2 as int)",
    }),
    "customers": ("customer", {
        "customer_id": "concat('cus-', cast(c_custkey as string))",
        "registration_date": (
            "cast(date '1995-01-01' + cast(c_custkey * 7 % 2400 as int) as date)"
        ),
        "is_loyalty_member": "case when c_acctbal > 0 then 1 else 0 end",
    }),
}

def _iso(ts: str) -> str:
    return f"concat(replace(cast({ts} as string), ' ', 'T'), '.123456')"


def _address(k: str, prefix: str, apartment: bool) -> dict[str, str]:
    fields = {
        f"{prefix}.country": f"case when {k} % 5 = 0 then '' else concat(' Country ', cast({k} % 4 as string)) end",
        f"{prefix}.city": f"case when {k} % 7 = 0 then '' else concat('City ', cast({k} % 25 as string), ' ') end",
        f"{prefix}.street": f"case when {k} % 11 = 0 then '   ' else concat('Улица ', cast({k} % 10 as string)) end",
        f"{prefix}.house": f"cast({k} % 3 as string)",
    }
    if apartment:
        fields[f"{prefix}.apartment"] = (
            f"case when {k} % 2 = 0 then '' else concat('КВ ', cast({k} % 4 as string)) end"
        )
    fields[f"{prefix}.postal_code"] = f"concat(' ', lpad(cast({k} % 1000 as string), 6, '1'))"
    return fields


def _point(k: str, prefix: str) -> dict[str, str]:
    return {
        f"{prefix}.coordinates.latitude": (
            f"case {k} % 8 when 0 then 'abc' when 1 then '95.5' when 2 then 'NaN' when 3 then '' "
            f"else concat(' ', cast({k} % 90 as string), '.25') end"
        ),
        f"{prefix}.coordinates.longitude": (
            f"case {k} % 8 when 0 then '-180' when 1 then '180.01' when 2 then '1e2' "
            f"else concat('-', cast({k} % 180 as string), '.5') end"
        ),
    }


_CUSTOMER = {
    "customer_id": (
        "case when c_custkey % 97 = 0 then concat(' CUS-', cast(c_custkey as string), ' ') "
        "else concat('cus-', cast(c_custkey as string)) end"
    ),
    "first_name": (
        "case when c_custkey % 11 = 0 then '' when c_custkey % 13 = 0 then '   ' "
        "else concat(' ', c_name, ' ') end"
    ),
    "last_name": "case when c_custkey % 17 = 0 then '' else c_mktsegment end",
    "email": "case when c_custkey % 19 = 0 then '' else concat(' ', upper(c_name), '@X.RU ') end",
    "phone": (
        "case when c_custkey % 23 = 0 then '' "
        "when c_custkey % 4 = 0 then concat('8 (9', lpad(cast(c_custkey % 100 as string), 2, '0'), "
        "') 555-10-', lpad(cast(c_custkey % 60 as string), 2, '0')) "
        "when c_custkey % 4 = 1 then concat('7-9', lpad(cast(c_custkey as string), 9, '0')) "
        "when c_custkey % 4 = 2 then concat('9', lpad(cast(c_custkey as string), 9, '0')) "
        "else concat('+79', lpad(cast(c_custkey as string), 9, '0')) end"
    ),
    "birth_date": (
        "case when c_custkey % 29 = 0 then 'abc' when c_custkey % 31 = 0 then '1899-12-31' "
        "when c_custkey % 37 = 0 then '2050-01-01' when c_custkey % 41 = 0 then '' "
        "when c_custkey % 43 = 0 then '1980' "
        "else cast(cast(date '1950-01-01' + cast(c_custkey % 15000 as int) as date) as string) end"
    ),
    "gender": "case c_custkey % 3 when 0 then 'Male' when 1 then ' FEMALE' else '' end",
    "registration_date": (
        "case when c_custkey % 47 = 0 then 'never' else "
        "concat(cast(cast(date '1995-01-01' + cast(c_custkey * 7 % 2400 as int) as date) as string), "
        "'T', lpad(cast(c_custkey % 24 as string), 2, '0'), ':00:00.123456') end"
    ),
    "is_loyalty_member": (
        "case c_custkey % 6 when 0 then 'True' when 1 then 'true' when 2 then '1' "
        "when 3 then ' YES ' when 4 then 'no' else '' end"
    ),
    "loyalty_card_number": "case when c_acctbal > 0 then concat('CARD-', cast(c_custkey as string)) else '' end",
    **_address("c_custkey", "purchase_location", False),
    **_point("c_custkey", "purchase_location"),
    **_address("c_custkey", "delivery_address", True),
    "preferences.preferred_language": "case c_custkey % 3 when 0 then 'RU' when 1 then '' else 'en ' end",
    "preferences.preferred_payment_method": "case c_custkey % 2 when 0 then 'Card' else 'cash' end",
    "preferences.receive_promotions": "case c_custkey % 3 when 0 then 'True' when 1 then 'False' else '' end",
}

_PRODUCT = {
    "id": (
        "case when p_partkey % 89 = 0 then concat('PRD-', cast(p_partkey as string), ' ') "
        "else concat('prd-', cast(p_partkey as string)) end"
    ),
    "name": "concat(' ', upper(p_name))",
    "group": RAW_GROUP,
    "description": "case when p_partkey % 9 = 0 then '' else concat('Brand: ', p_brand) end",
    "kbju.calories": (
        "case p_partkey % 9 when 0 then 'nan' when 1 then '-5' when 2 then '1e2' when 3 then '' "
        "when 4 then '12f' else concat(cast(p_size as string), '.5') end"
    ),
    "kbju.protein": "cast(p_size as string)",
    "kbju.fat": "concat(' ', cast(p_size % 30 as string), '.25 ')",
    "kbju.carbohydrates": "case p_partkey % 4 when 0 then 'inf' when 1 then '-0.5' else '0' end",
    "price": (
        "case when p_partkey % 17 = 0 then '-1' when p_partkey % 19 = 0 then 'abc' "
        "when p_partkey % 23 = 0 then concat(cast(cast(p_retailprice as decimal(10,2)) as string), '9') "
        "else cast(cast(p_retailprice as decimal(10,2)) as string) end"
    ),
    "unit": "case p_partkey % 3 when 0 then 'ШТ' when 1 then 'кг ' else '' end",
    "origin_country": "case p_partkey % 4 when 0 then '' else concat('Страна ', cast(p_size % 7 as string)) end",
    "expiry_days": (
        "case p_partkey % 7 when 0 then '0' when 1 then '70000' when 2 then '1.5' when 3 then '' "
        "else cast(p_size * 3 as string) end"
    ),
    "is_organic": "case p_size % 2 when 1 then 'True' else 'false' end",
    "barcode": "concat(' ', lpad(cast(p_partkey as string), 13, '4'))",
    "manufacturer.name": "concat('ООО «', p_brand, '»')",
    "manufacturer.country": "case p_partkey % 6 when 0 then '' else 'Россия' end",
    "manufacturer.website": "case p_partkey % 5 when 0 then '' else 'HTTPS://maker.example' end",
    "manufacturer.inn": (
        "case when p_partkey % 13 = 0 then '' "
        "else concat('77', lpad(replace(p_brand, 'Brand#', ''), 8, '0')) end"
    ),
}

_STORE = {
    "store_id": "concat('store-', cast(s_suppkey as string))",
    "store_name": "concat(upper(s_name), ' ')",
    "store_network": "case s_suppkey % 3 when 0 then 'Большая сеть' when 1 then 'Малая сеть' else '' end",
    "store_type_description": "case s_suppkey % 2 when 0 then 'Более 200 м²' else '' end",
    "type": "case s_suppkey % 5 when 0 then '' else 'Offline' end",
    "categories": "case s_suppkey % 4 when 0 then '🍞 Хлеб, 🧀 Сыры' when 1 then 'Овощи!' else 'Мясо, Рыба' end",
    "manager.name": "concat('Manager ', cast(s_suppkey as string))",
    "manager.phone": "concat('8 9', lpad(cast(s_suppkey as string), 9, '0'))",
    "manager.email": "concat('M', cast(s_suppkey as string), '@SHOP.RU')",
    "location.country": "case s_suppkey % 9 when 0 then '' else r_name end",
    "location.city": "n_name",
    "location.street": "concat('Street ', cast(s_suppkey % 4 as string))",
    "location.house": "cast(s_suppkey % 2 as string)",
    "location.postal_code": "lpad(cast(s_suppkey as string), 6, '0')",
    **_point("s_suppkey", "location"),
    "opening_hours.mon_fri": "' 09:00-21:00'",
    "opening_hours.sat": "'10:00-20:00'",
    "opening_hours.sun": "case s_suppkey % 2 when 0 then '' else '10:00-18:00' end",
    "accepts_online_orders": "case s_suppkey % 4 when 0 then 'True' when 1 then 'true' when 2 then 'False' else '' end",
    "delivery_available": "case when s_acctbal > 0 then 'True' else 'False' end",
    "warehouse_connected": "case s_suppkey % 3 when 0 then 'yes' else 'no' end",
    "last_inventory_date": (
        "case s_suppkey % 5 when 0 then '2050-01-01' when 1 then '20010101' "
        "else cast(cast(date '2001-01-01' + cast(s_suppkey % 100 as int) as date) as string) end"
    ),
}

_SEED = "(l_orderkey + l_linenumber)"
_ITEM = {
    "product_id": f"case when {_SEED} % 29 = 0 then '' else concat(' PRD-', cast(l_partkey as string)) end",
    "name": "concat('Item ', cast(l_linenumber as string))",
    "category": f"case {_SEED} % 3 when 0 then '🧀 Сыр, молочное' when 1 then '🍗 Мясо' else '' end",
    "quantity": f"case when {_SEED} % 13 = 0 then '-1' when {_SEED} % 17 = 0 then '' when {_SEED} % 19 = 0 then 'abc' else concat(cast(cast(l_quantity as int) as string), '.5') end",
    "unit": f"case {_SEED} % 2 when 0 then 'ШТ' else '' end",
    "price_per_unit": f"case when {_SEED} % 23 = 0 then '-3' else concat(cast(cast(floor(l_extendedprice / l_quantity) as int) as string), '.99') end",
    "total_price": f"case when {_SEED} % 31 = 0 then '1e3' else concat(cast(cast(l_extendedprice as decimal(12,2)) as string), '9') end",
    "kbju.calories": f"case when {_SEED} % 7 = 0 then 'nan' else cast({_SEED} % 500 as string) end",
    "kbju.protein": f"concat(cast({_SEED} % 50 as string), '.5')",
    "kbju.fat": f"case when {_SEED} % 5 = 0 then '-1' else '3.25' end",
    "kbju.carbohydrates": "''",
    "manufacturer.name": "concat('Maker ', cast(l_suppkey as string))",
    "manufacturer.country": "'Россия'",
    "manufacturer.website": "''",
    "manufacturer.inn": f"case when {_SEED} % 11 = 0 then '' else concat('77', lpad(cast(l_suppkey % 56 as string), 8, '0')) end",
}

_PURCHASE = {
    "purchase_id": "case when o_orderkey % 211 = 0 then '' else concat('ORD-', cast(o_orderkey as string)) end",
    "customer.customer_id": BUYER,
    "customer.first_name": "concat('Name ', cast(o_custkey % 100 as string))",
    "customer.last_name": "''",
    "customer.email": "case when o_orderkey % 3 = 0 then '' else concat('C', cast(o_custkey as string), '@X.RU') end",
    "customer.phone": "case when o_orderkey % 3 = 0 then '' else concat('89', lpad(cast(o_custkey as string), 9, '0')) end",
    "customer.is_loyalty_member": "''",
    "customer.loyalty_card_number": "''",
    "store.store_id": "concat('store-', cast(o_orderkey % 10 as string))",
    "store.store_name": "concat('Store ', cast(o_orderkey % 10 as string))",
    "store.store_network": "''",
    **{k.replace("location.", "store.location."): v
       for k, v in {**_address("o_orderkey", "location", False), **_point("o_orderkey", "location")}.items()},
    "items": "",
    "total_amount": (
        "case when o_orderkey % 31 = 0 then '-5' when o_orderkey % 37 = 0 then 'abc' "
        "when o_orderkey % 41 = 0 then '' else cast(cast(o_totalprice as decimal(12,2)) as string) end"
    ),
    "payment_method": f"case when o_orderkey % 59 = 0 then '' else upper({PAYMENT}) end",
    "is_delivery": "case o_orderstatus when 'F' then 'True' when 'O' then 'false' else '' end",
    **_address("o_custkey", "delivery_address", True),
    "purchase_datetime": (
        "case when o_orderkey % 43 = 0 then '' when o_orderkey % 47 = 0 then 'soon' "
        f"when o_orderkey % 53 = 0 then '2050-01-01T00:00:00' else {_iso(HAPPENED)} end"
    ),
}

# Orders with all their lines as an array ``basket``.
BASKETS_FROM = "orders with lines"
STORE_FROM = (
    "supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"
)

# Raw documents: source relation, key column, leaf expressions by path.
DOCUMENTS = {
    "stores": (STORE_FROM, "s_suppkey", _STORE),
    "products": ("part", "p_partkey", _PRODUCT),
    "customers": ("customer", "c_custkey", _CUSTOMER),
    "purchases": (BASKETS_FROM, "o_orderkey", _PURCHASE),
}


def event_time(key: str) -> str:
    return f"timestamp '2001-01-01 00:00:00' + ({key} % 200) * interval '1' day"


def flat_item_exprs() -> dict[str, str]:
    return {path.replace(".", "_"): sql for path, sql in _ITEM.items()}


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table as a file stream, whether it is one file or a folder of parts."""
    # A pattern, because a stream takes a plain path for a folder only.
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _source(
    spark: SparkSession, sf_dir: str, relation: str, stream: bool = False, line: str = "struct(*)", keep: Column | None = None
) -> DataFrame:
    """Rows of a relation; ``line`` is what a basket holds for each line, and ``keep`` says which rows are wanted."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    first = {STORE_FROM: "supplier", ORDERS_FROM: "orders", BASKETS_FROM: "orders"}.get(relation, relation)
    rows = table_stream(spark, sf_dir, first) if stream else read(first)
    rows = rows if keep is None else rows.where(keep)
    if relation == STORE_FROM:
        return (
            rows
            .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
    if relation == ORDERS_FROM:
        counted = read("lineitem").groupBy(F.col("l_orderkey").alias("counted_key")).agg(
            F.count(F.lit(1)).alias("n_lines")
        )
        return rows.join(counted, F.col("o_orderkey") == F.col("counted_key"), "left")
    if relation == BASKETS_FROM:
        # One array per order: its size is the number of lines of one purchase. The columns
        # of the table are shuffled, not the many texts made of them. Each element is made
        # before it is collected, where Spark compiles it; the number of partitions is given,
        # because they grow after the shuffle, unseen by AQE.
        lines = read("lineitem")
        used = [c for c in lines.columns if c == "l_orderkey" or line == "struct(*)" or re.search(rf"\b{c}\b", line)]
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        lines = lines.select(*used).repartition(parts, "l_orderkey")
        if keep is not None:  # no baskets for orders that are not wanted
            wanted = rows.select(F.col("o_orderkey").alias("wanted_key")).distinct()
            lines = lines.join(wanted, F.col("l_orderkey") == F.col("wanted_key")).drop("wanted_key")
        lines = lines.select(F.col("l_orderkey").alias("basket_key"), F.expr(line).alias("line"))
        baskets = lines.groupBy("basket_key").agg(F.collect_list("line").alias("basket"))
        return rows.join(baskets, F.col("o_orderkey") == F.col("basket_key"), "left")
    return rows


def mart_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Inputs of the feature job from orders, lineitem, part, customer, supplier."""
    tables = {
        name: _source(spark, sf_dir, relation).select(
            *[F.expr(sql).alias(col) for col, sql in columns.items()]
        )
        for name, (relation, columns) in MART.items()
    }
    tables["customers"] = tables["customers"].withColumn(
        "customer_sk", key32(F.col("customer_id"))
    )
    suppliers = _source(spark, sf_dir, STORE_FROM)
    tables["stores"] = suppliers.select(
        F.concat(F.lit("store-"), F.col("s_suppkey").cast("string")).alias("store_id"),
        key32(F.lower("r_name"), F.lower("n_name")).alias("store_location_sk"),
    )
    tables["locations"] = (
        suppliers.select(
            key32(F.lower("r_name"), F.lower("n_name")).alias("store_location_sk"),
            F.lower("r_name").alias("country"),
            F.lower("n_name").alias("city"),
        ).distinct()
    )
    tables["dates"] = calendar(tables["purchases"])
    return tables


def calendar(purchases: DataFrame) -> DataFrame:
    """The days on which something was bought."""
    days = purchases.select(F.to_date("raw_event_time").alias("day")).distinct()
    return calendar_for(days, "day", AS_OF)


def _nested(schema: StructType, exprs: dict[str, str], lists, parents=(), item=None):
    fields = []
    for field in schema.fields:
        path = (*parents, field.name)
        if isinstance(field.dataType, StructType):
            value = F.struct(*_nested(field.dataType, exprs, lists, path))
        elif isinstance(field.dataType, ArrayType):
            value = _basket(field.dataType)
        else:
            value = F.expr(exprs[".".join(path)])
            if "_".join(path) in lists:
                value = F.split(value, ", ")
        fields.append(value.alias(field.name))
    return fields


def _basket(kind) -> Column:
    """The lines of a purchase, none for an order without any."""
    return F.coalesce(F.col("basket").cast(kind), F.array().cast(kind))


def _item_struct() -> str:
    tree: dict = {}
    for path, sql in _ITEM.items():
        *parents, leaf = path.split(".")
        node = tree
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = sql

    def render(node: dict) -> str:
        parts = [
            f"'{k}', {render(v) if isinstance(v, dict) else v}" for k, v in node.items()
        ]
        return f"named_struct({', '.join(parts)})"

    return render(tree)


def documents(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Nested documents of one topic, one per source row."""
    relation, _, exprs = DOCUMENTS[topic]
    entity = ENTITIES[topic]
    return _source(spark, sf_dir, relation, line=_item_struct()).select(
        *_nested(entity.schema, exprs, entity.list_fields)
    )


def envelopes(
    spark: SparkSession, sf_dir: str, topic: str, stream: bool = False, id_ends: str | None = None
) -> DataFrame:
    """Documents of one topic as envelopes with their publish time, or those whose id ends in ``id_ends``.

    The id is looked at before the documents are made.
    """
    relation, key, exprs = DOCUMENTS[topic]
    entity = ENTITIES[topic]
    clock = F.expr(event_time(key)).cast("timestamp_ntz")
    stamp = F.concat(F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+03:00"))
    keep = None if id_ends is None else F.expr(exprs[entity.id_column]).endswith(id_ends)
    return _source(spark, sf_dir, relation, stream, _item_struct(), keep).select(
        F.lit(topic).alias("topic"),
        F.to_json(F.struct(*_nested(entity.schema, exprs, entity.list_fields))).alias("json_data"),
        stamp.alias("event_time"),
    )


def raw_table(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The raw all-string table of one topic, without the JSON detour."""
    relation, key, exprs = DOCUMENTS[topic]
    columns, line = [], "struct(*)"
    flat_items = "array<struct<" + ",".join(f"{n}:string" for n in flat_item_exprs()) + ">>"
    for path, dtype in leaf_paths(ENTITIES[topic].schema):
        if isinstance(dtype, ArrayType):
            flat = ", ".join(f"'{n}', {sql}" for n, sql in flat_item_exprs().items())
            line = f"named_struct({flat})"
            columns.append(_basket(flat_items).alias("_".join(path)))
            continue
        else:
            sql = exprs[".".join(path)]
        columns.append(F.expr(sql).alias("_".join(path)))
    clock = F.expr(event_time(key)).cast("timestamp_ntz").alias("event_time")
    return _source(spark, sf_dir, relation, line=line).select(clock, *columns)
