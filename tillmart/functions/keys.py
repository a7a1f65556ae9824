"""Surrogate keys from cleaned natural keys.

``xxhash`` (64 bit, the default) is cheap and practically free of collisions.
``md5`` gives 32-bit keys that any engine with md5 can reproduce; expect about
n*n / 2**33 colliding pairs, so use it for small dimensions or for checking.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATOR = "\u0001"


def key64(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def key32(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws(_SEPARATOR, *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


HASHERS = {"xxhash": key64, "md5": key32}


def key_or_null(present: Column, *parts: Column, hasher=key64) -> Column:
    """Foreign key that stays NULL while the leading part is missing."""
    return F.when(present, hasher(*parts))
