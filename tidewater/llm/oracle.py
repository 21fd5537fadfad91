"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tidewater.llm import licenses as L
from tidewater.llm import quality as Q


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_text(w) for w in words) + "]"


def _licenses() -> str:
    known = _list(L.SENTENCES.values())
    name = "CASE s " + " ".join(f"WHEN {_text(w)} THEN {_text(i)}" for i, w in L.SENTENCES.items()) + f" ELSE '{L.UNKNOWN}' END"
    named = "[" + ", ".join(
        f"CASE WHEN regexp_matches(ids, {_text(L.rule_pattern(i))}) THEN {_text(n)} END" for n, i in L.RULES) + "]"
    counts = " AND ".join(
        f"(x <> {_text(general)} OR NOT " + (f"list_has_any(found, {_list(others)}))" if others else "len(found) > 1)")
        for general, others in L.GENERAL.items())
    return f"""
    WITH cut AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), {_text(L.END)}, chr(10), 'g') AS t FROM documents),
    plain AS (
      SELECT doc_id, list_filter(list_transform(string_split(lower(regexp_replace(regexp_replace(
        t, '[^A-Za-z0-9\\n]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g')), chr(10)), lambda s: trim(s)), lambda s: s <> '') AS sents FROM cut),
    seq AS (
      SELECT doc_id, list_filter(sents, lambda s: list_contains({known}, s)) AS found,
             ' ' || array_to_string(list_transform(sents, lambda s: {name}), ' ') || ' ' AS ids FROM plain),
    ruled AS (
      SELECT doc_id, len(found) AS n, list_filter({named}, lambda x: x IS NOT NULL) AS hits FROM seq),
    firsts AS (
      SELECT doc_id, n, list_filter(hits, lambda x, i: list_position(hits, x) = i) AS found FROM ruled),
    counted AS (
      SELECT doc_id, n, list_filter(found, lambda x: {counts}) AS hits FROM firsts)
    SELECT doc_id, n AS n_sentences, coalesce(array_to_string(hits, ','), '') AS licenses, hits[1] AS license FROM counted
    """


def quality_sql(columns: str = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept") -> str:
    """Verdict of the quality rules on `documents`; `columns` of it are returned."""
    codes = list(Q.COMMON_WORDS)
    lists = "CASE lang_ " + " ".join(f"WHEN '{c}' THEN {_list(Q.COMMON_WORDS[c])}" for c in codes) + " ELSE []::VARCHAR[] END"
    steps, prev = [], "t0"
    for i, (_, pattern) in enumerate(Q.CLASSES):
        steps.append(f"s{i + 1} AS (SELECT *, regexp_replace(t{i}, {_text(pattern)}, '', 'g') AS t{i + 1} FROM s{i})")
        prev = f"t{i + 1}"
    n = len(Q.CLASSES)
    chars = "[" + ", ".join([*[f"(length(t{i}) - length(t{i + 1}))::DOUBLE" for i in range(n)], f"length({prev})::DOUBLE"]) + "]"
    bins = max(len(w) for w in Q.COMMON_WORDS.values()) + 1
    sums = lambda c, k: "list_filter([" + ", ".join(f"sum({c}[{i + 1}])" for i in range(k)) + "], lambda x: x IS NOT NULL)"

    def js(p: str, q: str) -> str:
        a, b = f"(z[1] / list_sum({p}))", f"(z[2] / list_sum({q}))"
        m = f"(({a} + {b}) / 2)"
        term = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / {m}) ELSE 0 END"
        return (f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(list_sum(list_transform("
                f"list_zip({p}, {q}), lambda z: ({term(a)} + {term(b)}) / 2)), 0)) END")

    enough = f"coalesce(ref_words >= {Q.MIN_REFERENCE_WORDS}, false)"
    return f"""
    WITH s0 AS (SELECT *, coalesce(text, '') AS t0, coalesce(CASE WHEN lang IN ({', '.join(_text(c) for c in codes)}) THEN lang END, '{Q.OTHER}') AS lang_,
                       row_number() OVER () AS row_ FROM documents),
    {', '.join(steps)},
    w AS (SELECT *, {chars} AS chars, length({prev}) - length(regexp_replace({prev}, {_text(Q.SYMBOLS)}, '', 'g')) AS n_symbols,
                 list_filter(string_split_regex(t0, {_text(Q.WHITE)}), lambda x: x <> '') AS words, {lists} AS list_ FROM s{n}),
    f AS (SELECT *, len(words) AS n_words, list_transform(list_, lambda c: len(list_filter(words, lambda x: x = c))::DOUBLE) AS found FROM w),
    h AS (SELECT *, list_concat(found, [n_words - coalesce(list_sum(found), 0)]) AS common,
                 list_filter(string_split(t0, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM f),
    grams AS (SELECT row_, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
              FROM (SELECT row_, words, unnest(range(1, n_words - 1)) AS i FROM h WHERE n_words > 2)),
    twice AS (SELECT row_, i FROM (SELECT row_, i, count(*) OVER (PARTITION BY row_, g) AS c FROM grams) WHERE c > 1),
    rep AS (SELECT row_, count(DISTINCT p) AS n_repeat_words FROM (SELECT row_, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY row_),
    refs AS (SELECT lang_ AS ref_lang, sum(n_words) AS ref_words, {sums('chars', n + 1)} AS ref_chars, {sums('common', bins)} AS ref_common FROM h GROUP BY lang_),
    d AS (SELECT h.*, coalesce(n_repeat_words, 0) AS n_repeat_words, length(t0) - chars[2]::BIGINT AS word_chars, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                 ref_words, {js('chars', 'ref_chars')} AS char_distance,
                 CASE WHEN lang_ <> '{Q.OTHER}' THEN {js('common', 'ref_common')} END AS word_distance
          FROM h LEFT JOIN refs ON lang_ = ref_lang LEFT JOIN rep ON rep.row_ = h.row_),
    v AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM d)
    SELECT {columns} FROM (SELECT *, NOT base_failed
        AND NOT ({enough} AND word_chars >= {Q.MIN_CHARS_JUDGED} AND coalesce(char_distance > {Q.MAX_CHAR_DISTANCE}, false))
        AND NOT ({enough} AND n_words >= {Q.MIN_WORDS_JUDGED} AND coalesce(word_distance > {Q.MAX_WORD_DISTANCE}, false)) AS kept FROM v)
    """


_OP11 = r"""
    WITH piece AS (
      SELECT row_number() OVER () AS p, lang, string_split_regex(piece, '[ \t]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
    word AS (
      SELECT p, lang, w, row_number() OVER (PARTITION BY p ORDER BY i) AS i
      FROM (SELECT p, lang, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM piece) WHERE w <> ''),
    runs AS (
      SELECT lang, w AS w1, lead(w) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM word WINDOW s AS (PARTITION BY p ORDER BY i)),
    f1 AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
    f2 AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    longer AS (
      SELECT lang, w1, w2, max(f) AS f
      FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
    scored AS (
      SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r
      FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
              LEFT JOIN longer g ON g.lang = f2.lang AND g.w1 = f2.w1 AND g.w2 = f2.w2
      WHERE g.f IS NULL OR 100 * g.f < 50 * f2.f
      UNION ALL
      SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END FROM (
        SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
               (1000000::HUGEINT * t.f * t.f) // (x.f::HUGEINT * yz.f) AS s1,
               (1000000::HUGEINT * t.f * t.f) // (xy.f::HUGEINT * z.f) AS s2
        FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 z ON z.lang = t.lang AND z.w1 = t.w3
             JOIN f2 xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2
             JOIN f2 yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3)),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM scored))
    SELECT lang, rank, phrase, a, l, r, n, score
    FROM ranked JOIN (SELECT lang, count(*) AS n FROM word GROUP BY lang) USING (lang) WHERE rank <= 2000"""

_OP12 = r"""
    WITH rules(verdict, rhost, rpath) AS (VALUES
        ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
    u AS (
      SELECT row_number() OVER () AS n, page_id,
             coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path
      FROM h),
    m AS (
      SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY n)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (n)"""

_OP13 = """
    WITH own AS (
      SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    h AS (  -- CRC-32 of the decimal id, bit by bit
      SELECT c, turns, xor(list_reduce(
          [4294967295::BIGINT] || list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ord(substr(c::VARCHAR, i, 1))::BIGINT),
          lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                     lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
      FROM own),
    seq AS (
      SELECT a.c, coalesce(f.turns, [])[:a.h::INT] || a.turns[a.h::INT + 1:] AS s
      FROM h a LEFT JOIN own f ON f.c = a.c - a.c % 100),
    node AS (
      SELECT s[:d] AS k, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
             string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = d) AS ends
      FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seq) GROUP BY ALL),
    kids AS (SELECT k[:depth - 1] AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
    own_sums AS (
      SELECT n.*, coalesce(n_children, 0) AS n_children,
             CASE WHEN depth > 0 THEN (n_convs - 1) * length(n.k[depth].t) ELSE 0 END AS own
      FROM node n LEFT JOIN kids USING (k)),
    sums AS (
      SELECT k[:up] AS k, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM own_sums) GROUP BY 1)
    SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs::BIGINT AS n_convs,
           o.n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
           sha256(coalesce(o.ends, '')) AS ends_sha256
    FROM own_sums o JOIN sums USING (k) LEFT JOIN node p ON o.depth > 0 AND p.k = o.k[:o.depth - 1]"""


_WORDS = """SELECT row_number() OVER () AS r, doc_id,
             list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents"""
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# words hold no blank, so words joined by one are their sequence
_OP4 = f"""
    WITH RECURSIVE w AS ({_WORDS.format(text=_LOWERED)}),
    s AS (
      SELECT DISTINCT r, k FROM (
        SELECT r, array_to_string(ws[i:i + 4], ' ') AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
        UNION ALL SELECT r, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4)),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    shared AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.r < b.r GROUP BY ALL),
    link AS (SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (SELECT r, r AS other FROM w UNION SELECT reach.r, b FROM reach JOIN ways ON a = other),
    least AS (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN w ON w.r = other GROUP BY reach.r)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
    FROM w JOIN least USING (r) LEFT JOIN n USING (r)"""
_OP10 = f"""
    WITH w AS ({_WORDS.format(text="coalesce(text, '')")}),
    win AS (SELECT r, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
            FROM (SELECT *, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
    first AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
    gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (k) WHERE f < doc_id),
    word AS (SELECT r, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
    kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
    SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (r)"""


ORACLE: dict[str, str] = {
    "op4_ngram_jaccard_join": _OP4,
    "op5_quality_divergence": quality_sql(),
    "op9_license_sentences": _licenses(),
    "op10_phrase_automata": _OP10,
    "op11_collocation_filters": _OP11,
    "op12_url_digests": _OP12,
    "op13_prefix_trie": _OP13,
}
