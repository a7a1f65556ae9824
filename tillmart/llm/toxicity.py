"""Toxicity: subword bags averaged over windows of words, the worst window decides.

Misspelt and inflected forms share character n-grams with the forms that were seen.
See ``subword`` for the method, the bound of the learning sample and the defined cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tillmart.llm import subword

SETTINGS = subword.Settings(pool="max", lower=True, word_pairs=False)
LIMIT = 0.5


def score_toxicity(
    documents: DataFrame, labels: DataFrame, outside: Column, settings: subword.Settings = SETTINGS, text: str = "text"
) -> DataFrame:
    """Adds ``score``, the chance of label toxic = 1. Nothing is learned from label rows where ``outside`` is true."""
    model = subword.fit(documents, subword.labelled(labels, "toxic", outside), settings, text)
    return subword.score(documents, model, settings, text)
