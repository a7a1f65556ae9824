"""Schema-driven hashing of phone and email fields at any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from tillmart.entities import ENTITIES
from tillmart.functions.privacy import hashed_email, hashed_phone, hide_pads


def _hasher_for(name: str):
    lowered = name.lower()
    if "phone" in lowered:
        return hashed_phone
    if "email" in lowered:
        return hashed_email
    return None


def _touches(dtype: DataType, name: str = "") -> bool:
    if isinstance(dtype, StringType):
        return _hasher_for(name) is not None
    if isinstance(dtype, ArrayType):
        # Plain texts in a list have no field name of their own and stay.
        return not isinstance(dtype.elementType, StringType) and _touches(dtype.elementType, name)
    if isinstance(dtype, MapType):
        # The keys name the values, and are known only in the data.
        return isinstance(dtype.valueType, StringType) or _touches(dtype.valueType, name)
    if not isinstance(dtype, StructType):
        return False
    return any(_touches(f.dataType, f.name) for f in dtype.fields)


def _by_key(key: Column, value: Column, name: str, secret: str) -> Column:
    """A map's string value, hashed as its key or the map's own name asks for."""
    if hasher := _hasher_for(name):
        return F.when(value.isNotNull(), hasher(value, secret))
    lowered = F.lower(key.cast("string"))
    return (
        F.when(value.isNull(), value)
        .when(lowered.contains("phone"), hashed_phone(value, secret))
        .when(lowered.contains("email"), hashed_email(value, secret))
        .otherwise(value)
    )


def _rewrite(value: Column, name: str, dtype: DataType, secret: str) -> Column:
    if not _touches(dtype, name):
        return value
    if isinstance(dtype, StringType):
        # NULL stays NULL so that absent fields stay absent in the document.
        return F.when(value.isNotNull(), _hasher_for(name)(value, secret))
    if isinstance(dtype, ArrayType):
        element = dtype.elementType
        return F.transform(value, lambda x: _rewrite(x, name, element, secret))
    if isinstance(dtype, MapType):
        held = dtype.valueType
        if isinstance(held, StringType):
            return F.transform_values(value, lambda k, v: _by_key(k, v, name, secret))
        return F.transform_values(value, lambda k, v: _rewrite(v, name, held, secret))
    rebuilt = F.struct(
        *[_rewrite(value[f.name], f.name, f.dataType, secret).alias(f.name) for f in dtype.fields]
    )
    return F.when(value.isNotNull(), rebuilt)


def pseudonymise(documents: DataFrame, secret: str, topic: str | None = None) -> DataFrame:
    """Replaces every string whose field name holds ``phone`` or ``email``.

    Field names are matched once on the schema; in maps the keys are matched, row
    by row. Topics without contact data pass through.
    """
    if topic is not None and not ENTITIES[topic].holds_contacts:
        return documents
    if not secret:
        raise ValueError("a non-empty HMAC key is required")
    hide_pads(documents.sparkSession)
    return documents.select(
        *[
            _rewrite(F.col(f"`{f.name}`"), f.name, f.dataType, secret).alias(f.name)
            for f in documents.schema.fields
        ]
    )
