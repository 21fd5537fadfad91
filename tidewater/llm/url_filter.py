"""URL filter by a sorted digest array of rules.

A rule is a host and a path (`example.com/en/`): it fits the urls of its host
and of all subdomains whose path starts with its path; of the rules that fit a
url the longest decides.  The rules lie in a `DigestArray`: sorted 64-bit xxHash
keys in files that tasks map into memory.  A url's candidates are its host's
endings with as many labels as rules have, each with the path's beginnings of
the lengths that rule paths have; all candidates of a batch are probed by one
vectorised binary search and confirmed by the stored string.  The urls are
neither shuffled nor joined, so a host with a third of all pages does no harm.

Defined results: host and path of a url are empty if it is null or has no `://`,
and no rule fits them.  Host: from behind the first `://` up to `/`, `?`, `#` or
the end, A-Z lower-cased, a port or user name included; path: from there up to
`?`, `#` or the end.  A rule's host runs to its first `/`, A-Z lower-cased; a
rule without `/` fits every path; an empty or null rule is left out; a rule that
is given as allowed and as blocked blocks.  Rules of equal length: the longer
host decides.  Urls that no rule fits get `default`.  Repeated rows are judged
each; an empty table gives an empty table; columns named like an output are
replaced.  Long urls cost no more candidates than the rules have host depths
times path lengths.
"""

from __future__ import annotations

import string
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.digest_array import DigestArray, build

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUTS = ("host", "path", "rule", "verdict")


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class UrlRules:
    array: DigestArray
    depths: tuple[int, ...]  # numbers of labels that rule hosts have
    lengths: tuple[int, ...]  # lengths that rule paths have


def build_rules(rules: DataFrame, name: str = "url-rules") -> UrlRules:
    """`rules` (rule, verdict: `allow` or `block`) as a digest array; payload 1 blocks."""
    rule_host = _lower(F.substring_index("rule", "/", 1))
    split = rules.where("rule <> ''").select(
        rule_host.alias("h"), F.substr("rule", F.length(F.substring_index("rule", "/", 1)) + 1).alias("p"),
        (F.col("verdict") == "block").cast("long").alias("block"))
    array = build(split.select(F.concat("h", "p").alias("rule"), "block"), "rule", "block", name)
    shape = split.agg(F.collect_set(F.size(F.split("h", r"\.", -1))).alias("d"),
                      F.collect_set(F.length("p")).alias("l")).first()  # short lists of small numbers
    return UrlRules(array, tuple(sorted(shape["d"])), tuple(sorted(shape["l"])))


def rules_of(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(r, v) for v, r in rules], "rule string, verdict string")


def candidates(host: Column, path: Column, rules: UrlRules) -> Column:
    """The strings a rule that fits may have, the longest first, without repeats."""
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    depths, lengths = (F.array(*map(F.lit, x)).cast("array<int>") for x in (rules.depths, rules.lengths))
    ends = F.transform(F.filter(depths, lambda d: (host != "") & (dots >= d - 1)),
                       lambda d: F.call_function("substring_index", host, F.lit("."), -d))
    starts = F.transform(F.filter(lengths, lambda n: F.length(path) >= n), lambda n: F.left(path, n))
    both = F.flatten(F.transform(ends, lambda e: F.transform(starts, lambda s: F.struct(
        (F.length(e) + F.length(s)).alias("n"), F.length(e).alias("h"), F.concat(e, s).alias("c")))))
    return F.array_distinct(F.transform(F.sort_array(both, asc=False), lambda x: x["c"]))


def _probe(array: DigestArray):
    @F.arrow_udf("struct<rule string, block long>")
    def probe(lists: pa.Array, hashes: pa.Array) -> pa.Array:
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(lists)), sizes)
        flat = lists.flatten()
        found = array.find(hashes.flatten().to_numpy(), flat)
        hit = np.flatnonzero(found >= 0)
        rows, first = np.unique(row[hit], return_index=True)  # the first candidate is the longest
        best = np.full(len(lists), -1)
        best[rows] = hit[first]
        fits = best >= 0
        rule = flat.take(pa.array(np.where(fits, best, 0), mask=~fits)) if len(flat) else pa.nulls(len(lists))
        block = np.zeros(len(lists), np.int64)
        block[fits] = array.payloads(found[best[fits]])
        return pa.StructArray.from_arrays([rule.cast(pa.string()), pa.array(block, mask=~fits)], ["rule", "block"])

    return probe


def judge(pages: DataFrame, rules: UrlRules, url: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, the rule that decides and the verdict.  Only the
    candidates reach Python; all other columns stay beside them."""
    keep = [c for c in pages.columns if c not in OUTPUTS]
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    tried = rows.withColumn("_tried", candidates(F.col("host"), F.col("path"), rules))
    best = _probe(rules.array)(F.col("_tried"), F.transform("_tried", lambda c: F.xxhash64(c)))
    verdict = (F.when(F.col("_best.block") == 1, "block").when(F.col("_best.block") == 0, "allow")
               .otherwise(F.lit(default)))
    return tried.withColumn("_best", best).select(
        *[F.col(f"`{c}`") for c in keep], "host", "path", F.col("_best.rule").alias("rule"), verdict.alias("verdict"))


# --- fixed values: the rules of the query over `pages` -------------------------
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# --------------------------------------------------------------------------------


def url_rows(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Query form over `pages`: page_id, host, path, rule, verdict."""
    index = build_rules(rules_of(pages.sparkSession, rules))
    return judge(pages.select("page_id", "url"), index).select("page_id", *OUTPUTS)
