"""DuckDB SQL for the queries of this subpackage that SQL can express, written from their definitions."""

from __future__ import annotations

from probscope.llm import quality

WORD = r"[^\x20\x09-\x0D]+"

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM q
"""

JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
           THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id, n.n
"""


def quality_sql() -> str:
    """Measures from their definitions, exact quartiles cut to the sketch's buckets, and the verdicts."""
    share = {"symbols": "1000 * n_symbols // greatest(n_chars, 1)", "capitals": "1000 * n_capitals // greatest(n_chars, 1)",
             "repeats": "1000 * n_repeat_words // greatest(n_words, 1)",
             "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
             "stutters": "1000 * n_stutters // greatest(n_words, 1)",
             "long_words": "100 * word_chars // greatest(n_words, 1)",
             "short_words": "100 * word_chars // greatest(n_words, 1)"}
    values = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS measure, {v} AS v FROM m" for k, v in share.items())
    spread = " ".join(f"WHEN '{k}' THEN {v}" for k, v in quality.SPREAD.items())
    within = " AND ".join(
        f"({v} {'>=' if k == 'short_words' else '<='} (SELECT fence FROM f WHERE f.lang = m.lang AND f.source = m.source"
        f" AND f.measure = '{k}'))" for k, v in share.items())

    def quartiles(by: str) -> str:
        key = f"{by}, measure" if by else "measure"
        cut = "(q // (1 << greatest(length(bin(q)) - 6, 0))::BIGINT) * (1 << greatest(length(bin(q)) - 6, 0))::BIGINT"
        return (f"SELECT {key}, n, {cut.replace('q', 'a')} AS q1, {cut.replace('q', 'b')} AS q3 FROM (SELECT {key}, "
                f"count(*) AS n, quantile_disc(v, 0.25)::BIGINT AS a, quantile_disc(v, 0.75)::BIGINT AS b FROM v GROUP BY {key})")

    def blend(group: str, q: str, other: str) -> str:
        """A group's quartile, by half at LEAST documents, and the coarser group's."""
        w = f"({group}.n::DOUBLE * {group}.n::DOUBLE / ({group}.n::DOUBLE * {group}.n::DOUBLE + {quality.LEAST ** 2}::DOUBLE))"
        return f"floor({w} * {group}.{q} + (1 - {w}) * {other})"

    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
named AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS words FROM windows),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words) AS c FROM named),
covered AS (SELECT doc_id, count(DISTINCT j) AS c FROM (
              SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(text)::BIGINT AS n_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words,
         len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1]))::BIGINT AS n_stutters
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
v AS ({values}),
own AS ({quartiles("lang, source")}), by_lang AS ({quartiles("lang")}), by_all AS ({quartiles("")}),
picked AS (
  SELECT o.lang, o.source, o.measure,
         {blend("o", "q1", blend("l", "q1", "a.q1"))} AS q1, {blend("o", "q3", blend("l", "q3", "a.q3"))} AS q3
  FROM own o JOIN by_lang l ON l.lang = o.lang AND l.measure = o.measure JOIN by_all a ON a.measure = o.measure),
f AS (
  SELECT lang, source, measure, CASE WHEN measure = 'short_words' THEN q1 - s ELSE q3 + s END AS fence
  FROM (SELECT *, {quality.FENCE} * greatest(q3 - q1, CASE measure {spread} END) AS s FROM picked)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {within.replace("m.", "r.")} AS kept
FROM r
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 5
"""

#: crc32 by its table of 256 entries, a byte at a time; near words share a text with one code point left out.
SPELLING = r"""
WITH RECURSIVE entry AS (
  SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
              ORDER BY i) AS t FROM range(256) r(i)),
run AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
found AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes
          FROM run WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(1, length(bytes), 2), lambda i: ('0x' || bytes[i:i + 1])::BIGINT),
                                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM found, entry),
w AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
cut AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest
        FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
met AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, rest FROM cut SEMI JOIN w ON w.word = cut.rest
  UNION SELECT rest, word FROM cut SEMI JOIN w ON w.word = cut.rest),
best AS (
  SELECT met.word, count(*) OVER (PARTITION BY met.word) AS n_near, near, w.n AS near_n
  FROM met JOIN w ON w.word = near
  QUALIFY row_number() OVER (PARTITION BY met.word ORDER BY w.n DESC, near) = 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
         CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word),
way AS (
  SELECT word, word AS reached FROM formed
  UNION ALL SELECT way.word, form FROM way JOIN formed ON formed.word = reached WHERE form IS NOT NULL)
SELECT formed.word, formed.form, reached AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN way ON way.word = formed.word JOIN formed last ON last.word = reached AND last.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality": quality_sql(), "op3_ngram_join": JOIN, "op5_warc": WARC, "op12_hard_negatives": NEGATIVES,
            "op13_spelling_variants": SPELLING}
