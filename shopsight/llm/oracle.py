"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from shopsight.llm.quality import VOCABULARY, Limits

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format(x="coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have
         FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
         WHERE 100 * both_have >= 85 * (na.c + nb.c - both_have)),
step AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, t.b FROM reach r JOIN step t ON r.b = t.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, least.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN least ON least.a = d.doc_id
"""


def _quality() -> str:
    limits = Limits()
    vocabulary = ", ".join(f"('{w}')" for w in VOCABULARY)
    count = lambda chars: f"length(t) - length(regexp_replace(t, '[{chars}]', '', 'g'))"
    classes = {"lower": "a-z0-9", "upper": "A-Z", "white": r"\x20\x09-\x0D", "stop": ".,;:!?''\"()-", "symbol": "#*$%&|<>"}
    known = ", ".join(f"({count(c)}) AS {n}" for n, c in classes.items())
    bins = ", ".join([*(f"'{n}'" for n in classes), "'letter'", "'other'"])
    values = ", ".join([*classes, "letter", "length(t) - letter - " + " - ".join(classes)])
    term = "CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / (p + q)) ELSE 0 END"

    def distances(name: str, reference: str) -> str:
        """Distance of each document: bins that it lacks give their share."""
        both = f"{term.format(a='p')} + {term.format(a='q')}"
        return f"""
{name} AS (
  SELECT r, kind, sqrt(greatest((sum({both}) + 1 - sum(q)) / 2, 0)) AS js
  FROM (SELECT h.r, h.kind, h.c / h.total AS p, coalesce(f.share, 0) AS q
        FROM hist h LEFT JOIN {reference} f ON f.lang IS NOT DISTINCT FROM h.lang AND f.kind = h.kind AND f.bin = h.bin)
  GROUP BY ALL),
{name}_odd AS (
  SELECT DISTINCT x.r FROM {name} x JOIN base b USING (r)
  WHERE (x.kind = 'char' AND b.n_chars >= {limits.min_chars} AND x.js > {limits.max_char_distance})
     OR (x.kind = 'word' AND b.n_words >= {limits.min_histogram_words} AND x.js > {limits.max_word_distance}))"""

    def reference(name: str, source: str) -> str:
        return f"""
{name} AS (SELECT lang, kind, bin, sum(c) / sum(sum(c)) OVER (PARTITION BY lang, kind) AS share
           FROM {source} GROUP BY lang, kind, bin)"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT r, unnest(k) AS x, generate_subscripts(k, 1) AS i FROM (
  SELECT r, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS k
  FROM d WHERE len(w) >= 3)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM win) WHERE c > 1),
marked AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '{_WORD}') GROUP BY r),
base AS (SELECT d.r, doc_id, lang, length(t) AS n_chars, len(w) AS n_words,
                coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
                {count('#*$%&|<>')} AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(marked.n, 0) AS n_repeat_words
         FROM d LEFT JOIN marked USING (r) LEFT JOIN lines USING (r)),
chars AS (SELECT r, lang, t, {known}, length(regexp_replace(t, '[\\x00-\\x7F]', '', 'g')) AS letter FROM d),
vocabulary(word) AS (VALUES {vocabulary}),
counted AS (
  SELECT r, lang, 'char' AS kind, unnest([{bins}]) AS bin, unnest([{values}]) AS c FROM chars
  UNION ALL
  SELECT r, lang, 'word', coalesce(v.word, '<other>'), count(*) FROM (
    SELECT r, lang, regexp_replace({_LOWER.format(x='x')}, '[.,;:!?]{{1,3}}$', '') AS x
    FROM (SELECT r, lang, unnest(w) AS x FROM d)) u LEFT JOIN vocabulary v ON v.word = u.x
  GROUP BY ALL),
hist AS (SELECT *, sum(c) OVER (PARTITION BY r, kind) AS total FROM counted WHERE c > 0),
{reference('ref1', 'hist')},{distances('far1', 'ref1')},
usual AS (SELECT * FROM hist WHERE r NOT IN (SELECT r FROM far1_odd)),
{reference('ref2', 'usual')},{distances('far2', 'ref2')},
told AS (SELECT *, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words AS base_failed
         FROM base)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM far2_odd) AS kept
FROM told
"""

_FAILS = {
    "A": "len(w) < 50",
    "B": "100 * len(list_distinct(w)) < 65 * len(w)",
    "C": "100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t)",
    "D": "regexp_matches(t, '[#$%&*|]')",
    "E": "coalesce(doc_id > first_id, false)",
}

AUDIT = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
told AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
         FROM labels GROUP BY doc_id),
f AS (SELECT part, {" || ".join(f"CASE WHEN {c} THEN '{k}' ELSE '' END" for k, c in _FAILS.items())} AS fails,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM d JOIN firsts USING (t) LEFT JOIN told USING (doc_id)),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM x a, x b, x c, x d, x e
           WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS own,
                 substr(filter_order, 1, step - 1) AS before
          FROM orders, generate_series(1, 5) s(step)),
told_steps AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (WHERE clear AND NOT hit) AS kept, sum(n) FILTER (WHERE clear AND hit) AS removed,
         sum(n) FILTER (WHERE NOT clear AND hit) AS redundant, sum(n) FILTER (WHERE fails = own) AS unique_fails,
         sum(good) FILTER (WHERE clear AND hit) AS good_lost, sum(toxic) FILTER (WHERE clear AND hit) AS toxic_lost
  FROM (SELECT *, contains(fails, own) AS hit, translate(fails, before, '') = fails AS clear FROM cells, steps)
  GROUP BY ALL)
SELECT part, filter_order, step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}"
       for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM told_steps
"""

#: Every n-gram of every piece is counted by itself; arithmetic in HUGEINT.
PHRASES = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER.format(x="coalesce(text, '')")} AS t FROM documents),
piece AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
gram AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
         FROM w, generate_series(1, 5) s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100),
inside AS (SELECT DISTINCT s.lang, s.phrase FROM f s JOIN f g ON s.lang = g.lang AND s.k < g.k AND s.k > 1
           AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * g.f >= 100 * s.f),
cuts AS (SELECT lang, k, phrase, f AS a, c, array_to_string(x[1:c], ' ') AS head, array_to_string(x[c + 1:], ' ') AS tail
         FROM (SELECT *, string_split(phrase, ' ') AS x FROM f WHERE k > 1), generate_series(1, 4) s(c) WHERE c < k),
told AS (SELECT cuts.*, hd.f AS l, tl.f AS r, n, CAST((1000::HUGEINT * a * n) // (hd.f::HUGEINT * tl.f) AS BIGINT) AS score
         FROM cuts JOIN f hd ON hd.lang = cuts.lang AND hd.phrase = head JOIN f tl ON tl.lang = cuts.lang AND tl.phrase = tail
         JOIN total ON total.lang = cuts.lang),
lowest AS (SELECT * FROM told WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM inside)
           QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000
"""


ORACLE_SQL = {"op4_quality_rules": _quality(), "op10_jaccard_join": JACCARD, "op12_phrase_mining": PHRASES, "op13_filter_audit": AUDIT}
