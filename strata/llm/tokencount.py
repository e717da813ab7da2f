"""Token counts of whole texts, by rank-synchronous array merging (``bpe``)."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F

from strata.llm.bpe import WordCounter


@lru_cache(maxsize=2)
def _counter(path: str) -> WordCounter:
    return WordCounter(path)


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of ``text`` under the vocabulary file ``path``, which
    every executor must be able to open. Null counts as the empty text."""
    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series(_counter(path).count(list(texts)), dtype="int64")
    return counted(text)
