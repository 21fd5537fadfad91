"""Running word count over text lines.

Plan: explode(split) in the scan's stage, partial count per map task, one
shuffle by word, final count.  Hot words (the empty token, stop words) are
folded to one row per map task before the shuffle, so skew in the input
does not become skew in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import split_words


def words(lines: DataFrame, text_col: str = "value") -> DataFrame:
    return lines.select(F.explode(split_words(text_col)).alias("word"))


def word_counts(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """`word string, count bigint`; batch or streaming input."""
    return words(lines, text_col).groupBy("word").count()
