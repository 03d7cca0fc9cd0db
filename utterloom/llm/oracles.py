"""DuckDB equivalents of the queries that SQL can say, worked out in another way than the queries."""

from __future__ import annotations

from utterloom.llm.quality import COMMON_WORDS, Limits

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ITEM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS l FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS l FROM benchmark),
iw AS (SELECT DISTINCT item_id, m, array_to_string(l[i:i + m - 1], ' ') AS s
       FROM (SELECT item_id, l, least(10, len(l)) AS m, unnest(range(1, greatest(2, len(l) - 8))) AS i FROM b WHERE len(l) > 0)),
dw AS (SELECT doc_id, m, i, array_to_string(l[i:i + m - 1], ' ') AS s
       FROM (SELECT doc_id, l, m, unnest(range(1, len(l) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM iw))),
h AS (SELECT doc_id, i, m, item_id FROM dw JOIN iw USING (m, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(l)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""

_LIMITS = Limits()
_LISTS = " ".join(f"WHEN '{k}' THEN {v.split()}" for k, v in COMMON_WORDS.items())
_CLASSES = {
    "upper": "[A-Z]", "digits": "[0-9]", "symbols": r"[#*$%&|<>]", "space": r"[\x20\x09-\x0D]", "beyond": r"[^\x00-\x7F]",
    "points": r"[!\x22\x27(),\-./:;?\[\]_{}~=+@`^\x5c]",
}
_COUNTS = ", ".join(f"length(t) - length(regexp_replace(t, '{p}', '', 'g')) AS {k}" for k, p in _CLASSES.items())


def _reference(name: str, where: str) -> str:
    """Summed histograms by language, as lists."""
    return f"""
{name}_c AS (SELECT lang, list(s ORDER BY k) AS ref FROM (SELECT lang, k, sum(x) AS s FROM (SELECT lang, unnest(chars) AS x, generate_subscripts(chars, 1) AS k FROM {where}) GROUP BY lang, k) GROUP BY lang),
{name}_w AS (SELECT lang, list(s ORDER BY k) AS ref FROM (SELECT lang, k, sum(x) AS s FROM (SELECT lang, unnest(common) AS x, generate_subscripts(common, 1) AS k FROM {where}) GROUP BY lang, k) GROUP BY lang),
{name} AS (SELECT f.doc_id, {_js("f.chars", "c.ref")} AS far_chars, {_js("f.common", "w.ref")} AS far_common
           FROM f LEFT JOIN {name}_c c ON c.lang IS NOT DISTINCT FROM f.lang LEFT JOIN {name}_w w ON w.lang IS NOT DISTINCT FROM f.lang)"""


def _js(p: str, q: str) -> str:
    term = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"
    x, y = f"({p}[k] / list_sum({p}))", f"({q}[k] / list_sum({q}))"
    total = f"list_sum(list_transform(range(1, len({p}) + 1), lambda k: {term(x, y)} + {term(y, x)}))"
    return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(0, {total} / 2)) ELSE 0 END"


def _off(n: str = "n_words") -> str:
    li = _LIMITS
    judged = f"(far_chars > {li.chars}::DOUBLE OR (far_chars > {li.joint_chars}::DOUBLE AND far_common > {li.joint_words}::DOUBLE))"
    return f"(({n} >= {li.min_words} AND {judged}) OR ({n} >= {li.min_words_alone} AND far_common > {li.words_alone}::DOUBLE))"


QUALITY = f"""
WITH a AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
             CASE lang {_LISTS} ELSE []::VARCHAR[] END AS known FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n
      FROM (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM a))),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM a)
       WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
c AS (SELECT *, {_COUNTS}, list_transform(known, lambda k: len(list_filter(w, lambda x: x = k))::DOUBLE) AS hits FROM a),
f AS (SELECT c.doc_id, lang, len(w)::BIGINT AS n_words, (length(t) - space)::BIGINT AS word_chars, symbols::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        (len(w) < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * len(w)) AS base_failed,
        [length(t) - upper - digits - symbols - space - beyond - points, upper, digits, space, points, symbols, beyond]::DOUBLE[] AS chars,
        CASE WHEN len(known) > 0 THEN list_append(hits, len(w) - list_sum(hits)) ELSE []::DOUBLE[] END AS common
      FROM c LEFT JOIN r ON r.doc_id = c.doc_id LEFT JOIN ln ON ln.doc_id = c.doc_id),
{_reference("first", "(SELECT * FROM f WHERE NOT base_failed)")},
near AS (SELECT f.* FROM f JOIN first USING (doc_id) WHERE NOT base_failed AND n_words >= {_LIMITS.min_words} AND NOT {_off()}),
{_reference("final", "near")}
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT {_off()} AS kept
FROM f JOIN final USING (doc_id)"""
