"""Message envelopes: checking, time shift, flattening to all-string raw rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tillmart.entities import ENTITIES, Entity, leaf_paths
from tillmart.functions.moments import fixed_offset_clock, moment, month_key

_CORRUPT = "_corrupt"
#: The time of a rejected envelope, as it was received.
SENT = "_sent"


def wrap(documents: DataFrame, published_at: Column, topic: str | None = None) -> DataFrame:
    """Documents as ``(topic, json_data, event_time)`` rows.

    ``published_at`` is a wall clock at +03:00; it is rendered with its offset.
    """
    stamp = F.concat(
        F.date_format(published_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+03:00")
    )
    columns = [F.to_json(F.struct("*")).alias("json_data"), stamp.alias("event_time")]
    if topic is not None:
        columns.insert(0, F.lit(topic).alias("topic"))
    return documents.select(*columns)


def open_envelopes(envelopes: DataFrame, schema: str | StructType, received_at) -> DataFrame:
    """Adds ``doc``, ``event_clock`` and ``reject_reason`` (NULL when usable).

    A value of the wrong type loses that field only. The stricter JSON check
    runs just for rows the typed parser flagged.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    typed = StructType([*schema.fields]).add(_CORRUPT, "string")
    parsed = F.from_json("json_data", typed, {"columnNameOfCorruptRecord": _CORRUPT})
    text = F.col("json_data")
    # Surrounding white space is rare; looking past it costs a pass over the text.
    is_object = F.when(text.startswith("{") & text.endswith("}"), True).otherwise(
        text.rlike(r"^\s*\{") & text.rlike(r"\}\s*$")
    )
    has_time = F.coalesce("event_time", F.lit("")) != ""
    flagged = F.col(f"doc.{_CORRUPT}").isNotNull() | ~is_object
    reason = (
        F.when(F.coalesce("json_data", F.lit("")) == "", "missing json_data")
        .when(flagged & F.try_parse_json("json_data").isNull(), "invalid json")
        .when(~is_object, "not an object")
        .when(F.col("event_clock").isNull(), "invalid event_time")
    )
    clock = F.when(has_time, fixed_offset_clock(F.col("event_time"))).otherwise(
        moment(received_at)
    )
    # A one-element inline keeps later filters above the parse, which would
    # otherwise be copied into the filter and run twice per message.
    once = F.inline(F.array(F.struct(parsed.alias("doc"), clock.alias("event_clock"))))
    return envelopes.select("*", once).withColumn("reject_reason", reason)


def accepted(opened: DataFrame) -> DataFrame:
    return opened.where(F.col("reject_reason").isNull())


def rejected(opened: DataFrame) -> DataFrame:
    """Dead letters: the envelope as received, with the reason."""
    keep = [c for c in ("topic", "json_data", "event_time", "reject_reason") if c in opened.columns]
    return opened.where(F.col("reject_reason").isNotNull()).select(*keep)


def opened_rows(opened: DataFrame, entity: Entity) -> DataFrame:
    """Usable and rejected envelopes in one frame, so that a message is opened once.

    Usable ones are the rows of :func:`flatten` with their month. Rejected ones have a
    ``reject_reason``, the time as received in ``_sent``, and no month.
    """
    usable = F.col("reject_reason").isNull()
    return opened.select(
        "json_data", F.col("event_clock").alias("event_time"), *flat_columns(entity),
        F.when(usable, month_key(F.col("event_clock"))).alias("event_month"),
        F.when(~usable, F.col("event_time")).alias(SENT), "reject_reason",
    )


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _joined_list(value: Column) -> Column:
    members = F.array_join(F.from_json(value, "array<string>"), ", ")
    return F.coalesce(F.when(value.startswith("["), members), value, F.lit(""))


def _flat_item(item: Column, schema: StructType) -> Column:
    fields = []
    for path, _ in leaf_paths(schema):
        value = item
        for name in path:
            value = value[name]
        fields.append(_text(value).alias("_".join(path)))
    return F.struct(*fields)


def _items(doc: str, name: str, dtype: ArrayType) -> Column:
    """Array of flat items.

    One non-object element makes the typed parser drop the whole array, so
    flagged rows are read again element by element, keeping the objects.
    """
    element = dtype.elementType
    typed = F.col(f"{doc}.{name}")
    texts = F.from_json(F.get_json_object("json_data", f"$.{name}"), "array<string>")
    objects = F.filter(texts, lambda t: t.startswith("{"))
    reread = F.transform(objects, lambda t: F.from_json(t, element))
    flagged = typed.isNull() & F.col(f"{doc}.{_CORRUPT}").isNotNull()
    present = F.filter(
        F.coalesce(typed, F.when(flagged, reread), F.array().cast(dtype)),
        lambda x: x.isNotNull(),
    )
    return F.transform(present, lambda x: _flat_item(x, element))


def flat_columns(entity: Entity, doc: str = "doc") -> list[Column]:
    """One string column per document leaf; missing values are ``''``."""
    columns = []
    for path, dtype in leaf_paths(entity.schema):
        name = "_".join(path)
        quoted = ".".join(f"`{p}`" for p in (doc, *path))
        if isinstance(dtype, ArrayType):
            value = _items(doc, name, dtype)
        elif name in entity.list_fields:
            value = _joined_list(F.col(quoted))
        else:
            value = _text(F.col(quoted))
        columns.append(value.alias(name))
    return columns


def flatten(opened: DataFrame, entity: Entity) -> DataFrame:
    """Raw rows: ``json_data``, ``event_time``, the entity's string columns."""
    return opened.select(
        "json_data", F.col("event_clock").alias("event_time"), *flat_columns(entity)
    )


def to_raw(
    envelopes: DataFrame, topic: str, received_at, columns: Sequence[str] | None = None
) -> DataFrame:
    """Usable envelopes of one topic as raw rows, or only some string columns of them.

    For ``columns``, only their fields are taken out of the messages. Every message is still
    read to its end, so the same ones are usable.
    """
    entity = ENTITIES[topic]
    if columns is not None:
        entity = replace(entity, schema=_only(entity.schema, set(columns)))
        opened = accepted(open_envelopes(envelopes, entity.schema, received_at))
        return opened.select(*flat_columns(entity)).select(*columns)
    return flatten(accepted(open_envelopes(envelopes, entity.schema, received_at)), entity)


def _only(schema: StructType, columns: set[str], parents: tuple[str, ...] = ()) -> StructType:
    """The fields of a document that make the given flat columns."""
    kept = []
    for field in schema.fields:
        path = (*parents, field.name)
        if isinstance(field.dataType, StructType):
            inner = _only(field.dataType, columns, path)
            if inner.fields:
                kept.append(StructField(field.name, inner))
        elif "_".join(path) in columns:
            kept.append(field)
    return StructType(kept)


def with_entity_id(raw: DataFrame, topic: str) -> DataFrame:
    """Adds ``entity_id``, the topic's natural key, ``?`` when it is missing."""
    key = F.col(f"`{ENTITIES[topic].id_column}`")
    return raw.withColumn("entity_id", F.when(key == "", "?").otherwise(key))


def with_month(raw: DataFrame) -> DataFrame:
    """Adds ``event_month``, the partition column of raw storage."""
    return raw.withColumn("event_month", month_key(F.col("event_time")))


def json_path(column: str, path: str, default: str = "") -> Column:
    """Ad-hoc dotted path with numeric array positions, e.g. ``items.0.name``."""
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    return F.coalesce(F.get_json_object(column, f"${steps}"), F.lit(default))


def json_paths(rows: DataFrame, column: str, paths: Mapping[str, str], default: str = "") -> DataFrame:
    """Adds a column for each path of :func:`json_path`; a text is parsed once for all of them.

    The parse is a column of its own, so that Spark does not repeat it for each path.
    A text that is not JSON has no paths.
    """
    parsed = rows.withColumn("_parsed", F.try_parse_json(column))
    found = {
        name: F.coalesce(F.try_variant_get("_parsed", _variant_path(path), "string"), F.lit(default))
        for name, path in paths.items()
    }
    return parsed.withColumns(found).drop("_parsed")


def _variant_path(path: str) -> str:
    return "$" + "".join(f"[{p}]" if p.isdigit() else f'["{p}"]' for p in path.split("."))


def parallel_arrays(raw: DataFrame, column: str = "items") -> DataFrame:
    """Array of structs as parallel arrays named ``items.field``."""
    fields = raw.schema[column].dataType.elementType.fieldNames()
    others = [c for c in raw.columns if c != column]
    return raw.select(
        *others, *[F.col(f"{column}.{f}").alias(f"{column}.{f}") for f in fields]
    )


def zip_arrays(raw: DataFrame, column: str = "items") -> DataFrame:
    """Inverse of :func:`parallel_arrays`."""
    prefix = f"{column}."
    arrays = [c for c in raw.columns if c.startswith(prefix)]
    others = [f"`{c}`" for c in raw.columns if c not in arrays]
    names = [c[len(prefix):] for c in arrays]
    zipped = F.arrays_zip(*[F.col(f"`{c}`").alias(n) for c, n in zip(arrays, names, strict=True)])
    shaped = F.transform(
        zipped, lambda z: F.struct(*[z[n].alias(n) for n in names])
    )
    return raw.select(*others, shaped.alias(column))
