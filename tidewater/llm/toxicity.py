"""Toxicity scores: gradient-boosted trees over dense features, calibrated by
isotonic regression.

Features of a text (never its label, language, source or id): densities of a
lexicon, second-person words near lexicon words, capitals per letter, punctuation,
and the rate of obfuscated words, each counted in the same way at every length.  The lexicon is a short fixed list plus words and word
beginnings that the training labels single out.

Training uses at most MAX_PER_CLASS labelled doc_ids of each class (the first by a
hash of doc_id), of each of them at most ROWS_PER_ID different texts (the first by
a hash of the text), and only doc_ids whose crc32(doc_id as text) mod 5 is not 0.
Remainders 1 to 3 train the trees, remainder 4 the calibration.  Features and
scores are computed for every row.

Defined results: null text is empty text and is scored like one; rows without a
label are scored, not trained on; of several labels of one doc_id the largest
counts; a null doc_id is never held out and never trained on; with one class only
(or no labels) every score is the share of toxic labels; an empty table gives an
empty table; repeated rows get equal scores; other columns pass through.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_apply, saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values -------------------------------------------------------------
INSULTS = frozenset("idiot moron stupid dumb loser trash scum clown pathetic worthless disgusting filth "
                    "garbage ugly jerk fool".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta "
                          "vous votre tú usted ustedes vosotros".split())
LEET = str.maketrans("013457@$!", "oieastasi")
# -------------------------------------------------------------------------------

MAX_PER_CLASS = 4000
ROWS_PER_ID = 4        # different texts of one doc_id that are trained on
FOLDS = 5
PREFIXES = (4, 5, 6)   # lengths of word beginnings that may enter the lexicon
MIN_RATIO = 12.0       # how much more often a lexicon entry is in toxic rows
MAX_LEXICON = 2000
NEAR = 5               # words between a lexicon word and a second-person word
TREES, DEPTH, STEP = 12, 3, 0.3

FEATURES = ("hits", "hit_rate", "hit_kinds", "fixed_rate", "near_you", "you_rate", "capital_rate",
            "shout_rate", "exclaim_rate", "punct_rate", "obscured_rate", "unmasked_rate", "log_words")
FEATURE_SCHEMA = ", ".join(f"{f} double" for f in FEATURES)

_LETTERS = re.compile(r"[^\W\d_]+")
_EDGES = re.compile(r"^\W+|\W+$")


def core(word: str) -> str:
    return _EDGES.sub("", word).lower()


def entries(word: str) -> set[str]:
    """Lexicon entries that `word` (a core) would match: itself and its beginnings."""
    return {"=" + word} | {word[:n] for n in PREFIXES if len(word) >= n}


def features(text: str, lexicon: frozenset) -> tuple[float, ...]:
    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    hits = fixed = shout = obscured = unmasked = you = letters = capitals = 0
    found, hit_words, you_words = set(), set(), set()
    for w, c in counts.items():
        letters += c * (len(w) if w.isalpha() else sum(map(str.isalpha, w)))
        if not w.islower():  # a word in lower case holds no capital
            capitals += c * sum(map(str.isupper, w))
        k = core(w)
        if not k:
            continue
        mixed = not k.isalpha()
        if k in INSULTS or not lexicon.isdisjoint(entries(k)):
            hits += c
            found.add(k)
            hit_words.add(w)
            fixed += c * (k in INSULTS)
        elif mixed:
            obscured += c
            plain = "".join(_LETTERS.findall(k.translate(LEET)))
            unmasked += c * (plain in INSULTS)
        if k in SECOND_PERSON:
            you += c
            you_words.add(w)
        if len(w) > 1 and w.isupper():
            shout += c
    near = 0
    if hit_words and you_words:
        last_hit = last_you = -10 ** 9
        for i, w in enumerate(words):
            if w in hit_words:
                last_hit = i
                near += i - last_you <= NEAR
            if w in you_words:
                last_you = i
                near += i - last_hit <= NEAR
    chars = max(len(text), 1)
    punct = sum(text.count(p) for p in ".,;:!?'\"()-")
    return (float(hits), 100.0 * hits / n, float(len(found)), 100.0 * fixed / n, near / n * 100.0, 100.0 * you / n,
            capitals / max(letters, 1), shout / n, text.count("!") / chars, punct / chars, obscured / n,
            100.0 * unmasked / n, math.log1p(len(words)))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_labels(labels: DataFrame, most: int = MAX_PER_CLASS) -> DataFrame:
    """`doc_id, toxic, fold`: at most `most` rows of each class."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
           .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
           .withColumn("fold", remainder(F.col("doc_id"))).where("fold <> 0"))
    pick = lambda t: one.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return pick(1).unionByName(pick(0)).select("doc_id", "toxic", "fold")


def training_rows(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """`doc_id, text, toxic, fold`: different texts of the picked ids, at most
    ROWS_PER_ID of each."""
    # at most 2 * MAX_PER_CLASS rows of three numbers: safe to broadcast
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
            .select("doc_id", "text", "toxic", "fold").distinct())
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    return rows.withColumn("_nth", nth).where(F.col("_nth") <= ROWS_PER_ID).drop("_nth")


def _learn_lexicon(rows: DataFrame, positive: int, negative: int) -> frozenset:
    """Entries found in far more toxic than other training rows."""
    def emit(batch):
        toxic = batch.column("toxic").to_pylist()
        seen: Counter = Counter()
        for t, text in zip(toxic, batch.column("text").to_pylist()):
            kinds = set()
            for w in set((text or "").split()):
                k = core(w)
                if len(k) >= 3:
                    kinds |= entries(k)
            seen.update((e, t) for e in kinds)
        yield pa.RecordBatch.from_pydict({
            "entry": [e for e, _ in seen], "toxic": pa.array([t for _, t in seen], pa.int32()),
            "n": pa.array(list(seen.values()), pa.int64())})

    counts = arrow_apply(rows.select("text", "toxic"), emit, "entry string, toxic int, n long")
    by = counts.groupBy("entry").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"),
                                     F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q"))
    least = max(4, positive // 200)
    ratio = (F.col("p") / positive) / ((F.col("q") + 0.5) / max(negative, 1))
    best = (by.where((F.col("p") >= least) & (ratio >= MIN_RATIO))
            .orderBy(F.col("p").desc(), "entry").limit(MAX_LEXICON).select("entry"))
    return frozenset(r["entry"] for r in best.collect())


def with_features(df: DataFrame, text: str, lexicon: frozenset) -> DataFrame:
    """`df` without its text, with FEATURES.  One pass, no shuffle."""
    keep = [f for f in df.schema.fields if f.name != text and f.name not in FEATURES]
    shared = df.sparkSession.sparkContext.broadcast(lexicon)  # MAX_LEXICON entries at most

    def compute(batch):
        values = [features(t or "", shared.value) for t in batch.column(text).to_pylist()]
        cols = [batch.column(f.name) for f in keep]
        cols += [pa.array([v[i] for v in values], pa.float64()) for i in range(len(FEATURES))]
        yield pa.RecordBatch.from_arrays(cols, [*[f.name for f in keep], *FEATURES])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return arrow_apply(df.select(*[f.name for f in keep], text), compute,
                       ", ".join(x for x in (own, FEATURE_SCHEMA) if x))


class Model:
    """Lexicon, trees and calibration; `base` alone when there is nothing to learn."""

    def __init__(self, base: float, lexicon: frozenset = frozenset(), trees=None, curve=None):
        self.base, self.lexicon, self.trees, self.curve = base, lexicon, trees, curve

    def score(self, featured: DataFrame) -> DataFrame:
        """Adds `score` (0 to 1) to rows that have FEATURES."""
        if self.trees is None:
            return featured.withColumn("score", F.lit(float(self.base)))
        raw = _raw(self.trees, featured)
        out = self.curve.transform(raw).withColumn(
            "score", F.least(F.greatest(F.col("curved"), F.lit(0.0)), F.lit(1.0)))
        return out.select(*featured.columns, "score")


def _raw(trees, featured: DataFrame) -> DataFrame:
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="_vec").transform(featured)
    return trees.transform(vec).withColumn("_raw", vector_to_array("probability")[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the bounded, labelled sample."""
    picked = saved(training_labels(labels), "toxic-labels")
    rows = saved(training_rows(docs, picked), "toxic-sample")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    positive, negative = n.get(1, 0), n.get(0, 0)
    if not positive or not negative:
        return Model(1.0 if positive else 0.0)
    lexicon = _learn_lexicon(rows, positive, negative)
    f = saved(with_features(rows.select("text", "toxic", "fold"), "text", lexicon), "toxic-features").coalesce(2)
    f = f.withColumn("label", F.col("toxic").cast("double"))
    grow, tune = f.where("fold <> 4"), f.where("fold = 4")
    if grow.select("label").distinct().count() < 2:
        grow = f
    if tune.select("label").distinct().count() < 2:
        tune = f
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="_vec")
    trees = GBTClassifier(featuresCol="_vec", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP,
                          seed=7).fit(vec.transform(grow).select("_vec", "label"))
    curve = IsotonicRegression(featuresCol="_raw", labelCol="label", predictionCol="curved").fit(
        _raw(trees, tune).select("_raw", "label"))
    return Model(positive / (positive + negative), lexicon, trees, curve)


def toxicity_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query form over `documents` and `labels`."""
    model = fit(docs, labels)
    scored = model.score(with_features(docs.select("doc_id", "text"), "text", model.lexicon))
    held = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Filter form: documents that are not predicted toxic, with their columns."""
    names = [f"own_{i}" for i in range(len(docs.columns))]
    own = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)], F.col("text").alias("_scored_text"))
    model = fit(docs, labels)
    kept = model.score(with_features(own, "_scored_text", model.lexicon)).where("score < 0.5")
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
