"""Summaries of bounded size that can be merged: latency quantiles and heavy words.

* `latency_sketches` keeps one KLL sketch per function and hour.  Sketches of any
  hours, files or batches merge into one (`merged_sketches`), so quantiles over a
  month are read from some 700 small rows per function instead of all calls.
* `heavy_words` finds the most frequent words with one summary per task and one
  merged summary, each of `tracked` counters whatever the vocabulary holds, and
  then counts exactly the words that the summary names.  A word that makes up more
  than about `3.5 / tracked` of all words is always named.

Both are partial aggregates in the JVM: a hot function or word is one sketch per
task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.wordcount import words

KLL_K = 200         # sketch size; single-sided rank error about 1.33 % at 200
RANK_ERROR = 0.0133
TRACKED_WORDS = 20_000


def latency_sketches(logs: DataFrame, time: str = "timestamp", k: int = KLL_K) -> DataFrame:
    """function_name, hour, calls, sketch from parsed log lines; lines without a
    latency are left out, an unreadable time is the null hour."""
    hour = F.try_to_timestamp(F.col(time))
    timed = logs.select("function_name", F.date_trunc("hour", hour).alias("hour"), "latency_s")
    rows = timed.groupBy("function_name", "hour").agg(
        F.count("latency_s").alias("calls"), F.kll_sketch_agg_double("latency_s", F.lit(k)).alias("sketch"))
    return rows.where("calls > 0")


def merged_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """The sketches of each group of `by` as one, with the calls and hours it covers."""
    return sketches.groupBy(*by).agg(F.sum("calls").alias("calls"), F.count(F.lit(1)).alias("parts"),
                                     F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, **names: float) -> DataFrame:
    """`sketches` with one column for each named quantile, e.g. p50=0.5."""
    return sketches.withColumns({n: F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for n, q in names.items()})


def heavy_words(lines: DataFrame, text_col: str = "value", top: int = 100, tracked: int = TRACKED_WORDS) -> DataFrame:
    """word, count of the `top` most frequent words, equal counts by word."""
    tokens = words(lines, text_col)
    named = tokens.agg(F.call_function("approx_top_k", "word", F.lit(min(tracked // 2, 50 * top)), F.lit(tracked)).alias("k"))
    candidates = named.select(F.explode("k.item").alias("word")).distinct()
    counts = tokens.join(F.broadcast(candidates), "word").groupBy("word").count()  # at most tracked / 2 words
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(top)
