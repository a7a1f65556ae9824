"""Small documents that hold every defined odd case, and plain reference helpers."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that operators use for their own results or on the way.
CLASHING = ("ids", "score", "size", "copies", "target", "shard", "slot", "range", "tie", "key", "keys", "site", "line", "node", "part", "label", "n_lines")


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randint(1, 7))) for _ in range(words))


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    shared = sentence(rng, 40)
    rows = [
        (1, shared, "en", "s1", 1), (2, shared + " end", "en", "s1", 2), (3, "", "en", "s2", 0), (4, None, None, "s2", None),
        (None, "no id here", "fr", None, 3), (None, None, None, None, None), (5, " \n\t ", "en", "s1", 4),
        (6, "é " * 30_000 + "ß", "de", "s3", 5), (7, "x" * 5_000, "en", "s3", 6), (8, "one", "en", "s2", 7),
        (9, "<|endoftext|> a  b\n\nc 'll 😀", "en", "", 8), (10, shared, "en", "s2", 9),
    ]
    rows += [rows[0], rows[2], rows[4], rows[5]]  # repeated rows
    rows += [(20 + k, sentence(rng, rng.randint(3, 60)) + "\nshared line of the site", "en", f"s{k % 4}", k) for k in range(60)]
    return rows


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def with_clashes(documents):
    from pyspark.sql import functions as F

    return documents.select("*", *[F.lit(f"kept {c}").alias(c) for c in CLASHING])
