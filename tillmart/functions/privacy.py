"""Normalisation and keyed hashing of contact data."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_BLOCK = 64
PAD = r"[0-9A-Fa-f]{128}"
_REDACTION = "spark.sql.redaction.string.regex"


def hide_pads(spark: SparkSession) -> None:
    """Makes the session redact 64-byte literals, the HMAC pads, in printed plans."""
    pattern = spark.conf.get(_REDACTION, None)
    if not pattern:
        spark.conf.set(_REDACTION, PAD)
    elif not re.search(pattern, "0A" * _BLOCK):
        spark.conf.set(_REDACTION, f"{pattern}|{PAD}")


def normal_phone(value: Column) -> Column:
    """``+7XXXXXXXXXX`` where the rules allow it, otherwise digits and plus only."""
    kept = F.regexp_replace(value, "[^0-9+]", "")
    # A leading 8, a leading 7 without any plus, or the start of ten characters. One
    # expression, because Spark would clean the text again for each branch of a choice.
    return F.regexp_replace(kept, r"^(?:8|7(?=[^+]*$)|(?=.{10}$))", "+7")


def normal_email(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, r"^\s+|\s+$", ""))


def hmac_sha256(value: Column, secret: str) -> Column:
    """Hex HMAC-SHA256; NULL and empty text give empty text."""
    key = secret.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    inner = F.lit(bytes(b ^ 0x36 for b in key))
    outer = F.lit(bytes(b ^ 0x5C for b in key))
    first = F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))
    keyed = F.sha2(F.concat(outer, first), 256)
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit("")).otherwise(keyed)


def hashed_phone(value: Column, secret: str) -> Column:
    return hmac_sha256(normal_phone(value), secret)


def hashed_email(value: Column, secret: str) -> Column:
    return hmac_sha256(normal_email(value), secret)
