"""Quality classifier: learned word, word-pair and character n-gram vectors, averaged per text.

See ``subword`` for the method, the bound of the learning sample and the defined cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm import subword

SETTINGS = subword.Settings(pool="mean", lower=False, word_pairs=True)
LIMIT = 0.3


def score_quality(
    documents: DataFrame, labels: DataFrame, outside: Column, settings: subword.Settings = SETTINGS, text: str = "text"
) -> DataFrame:
    """Adds ``score``, the chance of label quality = 1. Nothing is learned from label rows where ``outside`` is true."""
    model = subword.fit(documents, subword.labelled(labels, "quality", outside), settings, text)
    return subword.score(documents, model, settings, text)


def accept(scored: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The documents whose score reaches the limit, without the score."""
    return scored.filter(F.col("score") >= limit).drop("score")
