"""Tokenising as the streaming word count does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_words(text) -> Column:
    """Split on every single space: no trimming, no case folding, empty
    tokens kept (`'a  b '` -> `a, '', b, ''`; `''` -> one empty token)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.split(col, " ", -1)
