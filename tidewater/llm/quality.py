"""Quality rules by distribution divergence, in column functions only.

A document's character-class histogram and its histogram over the common words
of its language are compared with the language's reference histograms by
Jensen-Shannon distance.  References are the summed counts of all documents of
that language (one row per listed language, so their size is fixed).  A rule
speaks only when the document is long enough for its histogram to mean
something, and when the reference rests on enough text.

Defined results: null text is empty text; an empty text has no words and fails
the base rule; a null or unlisted language is compared by characters only, with
the reference `other`; an empty table gives an empty table; rows are judged one
by one, so repeated rows get equal results; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved

# --- fixed values: common words by language ---------------------------------
COMMON_WORDS = {
    "en": ("the of and to in a is that for it as was with be by on not this are or from at an have "
           "which you were but they his").split(),
    "de": ("der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es "
           "an werden aus er hat dass sie nach").split(),
    "fr": ("de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il "
           "sont avec ou son aux").split(),
    "es": ("de la que el en y a los se del las un por con no una su para es al lo como más o pero sus "
           "le ha me si").split(),
}
WHITE = r"[\x20\x09-\x0D]+"
CLASSES = (  # removed from the text one after the other; what is left is "other"
    ("lower", "[a-zß-öø-ÿ]+"),
    ("space", WHITE),
    ("upper", "[A-ZÀ-ÖØ-Þ]+"),
    ("digit", "[0-9]+"),
    ("punct", r"""[.,;:!?'"()\-]+"""),
)
SYMBOLS = r"[#*$%&|<>]+"
# -----------------------------------------------------------------------------

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CHARS_JUDGED = 250      # characters a document needs for the character rule
MIN_WORDS_JUDGED = 100      # words a document needs for the common-word rule
MIN_REFERENCE_WORDS = 2000  # words a reference must rest on
MAX_CHAR_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.31
OTHER = "other"


def language(lang: Column) -> Column:
    """The listed language, or `other`."""
    return F.when(lang.isin(*COMMON_WORDS), lang).otherwise(F.lit(OTHER))


def _common_words(lang: Column) -> Column:
    out = F.array().cast("array<string>")
    for code, words in COMMON_WORDS.items():
        out = F.when(lang == code, F.array(*[F.lit(w) for w in words])).otherwise(out)
    return out


def histograms(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Adds `_words` (array), `_chars` (counts by class, "other" last), `_common`
    (counts of the language's common words, all other words last), `_symbols`,
    `_n` (words) and `_lang`."""
    out = df.withColumn("_lang", language(F.col(lang))).withColumn("_t0", F.coalesce(F.col(text), F.lit("")))
    for i, (_, pattern) in enumerate(CLASSES):
        out = out.withColumn(f"_t{i + 1}", F.regexp_replace(f"_t{i}", pattern, ""))
    last = len(CLASSES)
    counts = [F.length(f"_t{i}") - F.length(f"_t{i + 1}") for i in range(last)] + [F.length(f"_t{last}")]
    out = out.withColumns({
        "_chars": F.array(*[c.cast("double") for c in counts]),
        "_symbols": (F.length(f"_t{last}") - F.length(F.regexp_replace(f"_t{last}", SYMBOLS, ""))).cast("long"),
        "_words": F.array_remove(F.split("_t0", WHITE), ""),
        "_list": _common_words(F.col("_lang")),
    })
    everything = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    out = out.withColumn("_hits", F.filter("_words", lambda w: w.isin(*everything)))
    out = out.withColumn("_found", F.transform(
        "_list", lambda w: (F.size("_hits") - F.size(F.array_remove(F.col("_hits"), w))).cast("double")))
    out = out.withColumn("_n", F.size("_words").cast("long"))
    rest = F.col("_n") - F.aggregate("_found", F.lit(0.0), lambda a, x: a + x)
    return (out.withColumn("_common", F.concat("_found", F.array(rest)))
            .drop(*[f"_t{i}" for i in range(1, last + 1)], "_list", "_hits", "_found"))


def references(measured: DataFrame) -> DataFrame:
    """Reference counts over all documents (with the columns of `histograms`),
    one row per listed language: `ref_lang, ref_words, ref_chars, ref_common`."""
    bins = max(len(w) for w in COMMON_WORDS.values()) + 1
    total = lambda c, n: F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(n)])
    return measured.groupBy(F.col("_lang").alias("ref_lang")).agg(
        F.sum("_n").alias("ref_words"),
        total("_chars", len(CLASSES) + 1).alias("ref_chars"),
        F.filter(total("_common", bins), lambda x: x.isNotNull()).alias("ref_common"),
    )


def js_distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two count arrays of equal
    length; null when either has no mass."""
    mass = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    share = lambda a: F.transform(a, lambda x: x / mass(F.col(a)))
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(share(p), share(q), lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2)
    return F.when((mass(F.col(p)) > 0) & (mass(F.col(q)) > 0),
                  F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))))


MANY_REPEATS = 32


def with_repeat_words(df: DataFrame, words: str = "_words", out: str = "_repeat") -> DataFrame:
    """Adds how many words lie in 3-word windows found twice or more.

    Windows are 64-bit hashes; equal neighbours in sorted order are the repeated
    ones.  A few of them are looked up window by window; many are found by
    sorting (hash, position) pairs, so the cost stays n log n.  Either way the
    sorted positions then cover min(3, gap) words each."""
    n = F.size(words) - 2
    w = lambda i: F.get(words, i)
    df = df.withColumn("_h3", F.when(n > 0, F.transform(
        F.slice(words, F.lit(1), n), lambda a, i: F.xxhash64(a, w(i + 1), w(i + 2)))))
    df = df.withColumn("_s3", F.when(F.size(F.array_distinct("_h3")) < n, F.sort_array("_h3")))
    df = df.withColumn("_twice", F.array_distinct(F.filter(
        "_s3", lambda x, i: F.coalesce(x == F.get("_s3", i + 1), F.lit(False)))))
    df = df.withColumn("_pairs", F.when(F.size("_twice") > MANY_REPEATS, F.sort_array(
        F.transform("_h3", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    many = F.sort_array(F.transform(F.filter("_pairs", lambda x, k: same(x, F.get("_pairs", k + 1)) | same(
        x, F.get("_pairs", k - 1))), lambda x: x["i"]))
    few = F.transform(F.filter(
        F.transform("_h3", lambda x, i: F.struct(x.alias("h"), i.alias("i"))),
        lambda x: F.array_contains("_twice", x["h"])), lambda x: x["i"])
    df = df.withColumn("_pos", F.when(F.size("_twice") > MANY_REPEATS, many).when(F.size("_twice") > 0, few))
    m = F.size("_pos")
    gaps = F.zip_with(F.slice("_pos", F.lit(2), m - 1), F.slice("_pos", F.lit(1), m - 1),
                      lambda b, a: F.least(b - a, F.lit(3)))
    return df.withColumn(out, F.when(m > 0, F.aggregate(gaps, F.lit(3), lambda s, x: s + x))
                         .otherwise(0).cast("long")).drop("_h3", "_s3", "_twice", "_pairs", "_pos")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            "char_distance", "word_distance", "kept")


def measure(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """`docs` with the base counts and the histograms, all from its own row."""
    d = with_repeat_words(histograms(docs.drop(*MEASURES), text, lang))
    lines = F.filter(F.split("_t0", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("_lines", lines)
    return d.withColumns({
        "n_words": F.col("_n"),
        "word_chars": (F.length("_t0") - F.get("_chars", F.lit(1))).cast("long"),
        "n_symbols": F.col("_symbols"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.col("_repeat"),
    }).drop("_t0", "_words", "_lines", "_symbols", "_repeat")


def judge(measured: DataFrame, refs: DataFrame) -> DataFrame:
    """The verdict on measured documents.  `refs` has one row per listed language
    and `other` at most, so it is joined by broadcast and no document moves."""
    d = measured.join(F.broadcast(refs), F.col("_lang") == F.col("ref_lang"), "left")
    d = d.withColumns({
        "char_distance": js_distance("_chars", "ref_chars"),
        "word_distance": F.when(F.col("_lang") != OTHER, js_distance("_common", "ref_common")),
    })
    enough = F.coalesce(F.col("ref_words") >= MIN_REFERENCE_WORDS, F.lit(False))
    strange = lambda c, most, length, least: enough & (length >= least) & F.coalesce(F.col(c) > most, F.lit(False))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    d = d.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & ~strange("char_distance", MAX_CHAR_DISTANCE, F.col("word_chars"), MIN_CHARS_JUDGED)
        & ~strange("word_distance", MAX_WORD_DISTANCE, F.col("n_words"), MIN_WORDS_JUDGED))
    own = [c for c in measured.columns if c not in (*MEASURES, "_lang", "_chars", "_common", "_n")]
    return d.select(*own, *MEASURES)


def quality_rows(docs: DataFrame) -> DataFrame:
    """Query form over `documents`.  The measures (no text) are written once,
    so references and verdicts read a narrow table and the text is read once."""
    m = saved(measure(docs.select("doc_id", "text", "lang")).drop("text", "lang"), "quality")
    return judge(m, references(m)).select("doc_id", *MEASURES[:6], "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """Filter form: the documents that pass, with their own columns, unmoved.  Only
    the references are written: a second look at the texts costs less than a copy of them."""
    refs = saved(references(histograms(docs.select("text", "lang"))), "quality-references")
    plain = docs.select(*[F.col(c).alias(f"own_{i}") for i, c in enumerate(docs.columns)],
                        F.col("text").alias("_text"), F.col("lang").alias("_lang_in"))
    own = [f"own_{i}" for i in range(len(docs.columns))]
    m = measure(plain, "_text", "_lang_in").drop("_text", "_lang_in")
    # the measures as the rows of a generator: no filter on them moves below it, where
    # each of its terms would be measured anew
    m = m.select(*own, F.inline(F.array(F.struct(*[c for c in m.columns if c not in own]))))
    good = judge(m, refs).where("kept")
    return good.select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns)])
