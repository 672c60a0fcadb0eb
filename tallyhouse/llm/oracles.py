"""SQL for DuckDB that gives the rows of the queries SQL can express."""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"
GAPS = r"'[\x20\x09-\x0D]+'"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORD}) AS ws FROM documents
), sh AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END)) AS s
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), half AS (
  SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 90 * (nx.n + ny.n - k)
), links AS (SELECT x, y FROM half UNION ALL SELECT y, x FROM half),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.y) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON reach.x = d.doc_id GROUP BY ALL
"""

LINE_TEMPLATES = rf"""
WITH raw AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS line, unnest(ls) AS raw
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), masked AS (
  SELECT doc_id, line, trim(regexp_replace(
    regexp_replace(raw, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), {GAPS}, ' ', 'g')) AS masked
  FROM raw
), cut AS (SELECT *, string_split(masked, ' ') AS toks FROM masked WHERE masked <> ''),
lines AS (
  SELECT doc_id, line, masked, toks, len(toks) AS tokens, len(toks) || ' ' || array_to_string(toks[1:3], ' ') AS leaf,
    row_number() OVER (PARTITION BY doc_id ORDER BY line) AS nth
  FROM cut WHERE len(toks) >= 3
), leaves AS (SELECT leaf FROM lines GROUP BY leaf HAVING count(DISTINCT doc_id) > 1),
same AS (SELECT leaf, masked, toks, tokens, count(*) AS n FROM lines SEMI JOIN leaves USING (leaf) GROUP BY ALL),
toks AS (
  SELECT leaf, masked, n, generate_subscripts(toks, 1) AS place, unnest(toks) AS token FROM same
), sized AS (SELECT leaf, sum(n) AS size FROM same GROUP BY leaf),
kept AS (
  SELECT leaf, place, token FROM toks JOIN sized USING (leaf) WHERE token <> '<*>'
  GROUP BY leaf, place, token, size HAVING 2 * sum(n) > size
), named AS (
  SELECT leaf, masked, string_agg(place || ':' || token, ' ' ORDER BY place) AS template, count(*) AS constant
  FROM toks JOIN kept USING (leaf, place, token) GROUP BY leaf, masked
), matched AS (
  SELECT l.doc_id, l.line, l.leaf, l.tokens, named.template FROM lines l JOIN named USING (leaf, masked)
  WHERE 100 * constant >= 50 * l.tokens
  UNION ALL
  SELECT l.doc_id, l.line, l.leaf, l.tokens, 'line ' || l.masked FROM lines l JOIN same USING (leaf, masked)
  WHERE n >= 10 AND 100 * len(list_filter(l.toks, lambda t: t <> '<*>')) >= 50 * l.tokens
), often AS (
  SELECT leaf, template, min(doc_id) AS first FROM matched
  GROUP BY leaf, template, tokens HAVING count(DISTINCT doc_id) >= CASE WHEN tokens >= 51 THEN 2 ELSE 10 END
), near AS (
  SELECT l.*, nth - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS stretch FROM lines l SEMI JOIN leaves USING (leaf)
), offsets AS (
  SELECT *, sum(tokens) OVER (PARTITION BY doc_id, stretch ORDER BY line) AS finish FROM near
), runs AS (
  SELECT a.doc_id, a.line AS start, list(b.masked ORDER BY b.line) AS passage, list(b.line) AS run_lines
  FROM offsets a JOIN offsets b ON a.doc_id = b.doc_id AND a.stretch = b.stretch
    AND b.finish - b.tokens BETWEEN a.finish - a.tokens AND a.finish - a.tokens + 50
  GROUP BY a.doc_id, a.line HAVING sum(b.tokens) >= 51
  UNION ALL
  SELECT a.doc_id, a.line, list(b.masked ORDER BY b.line), list(b.line)
  FROM offsets a JOIN offsets b ON a.doc_id = b.doc_id AND a.stretch = b.stretch AND b.finish BETWEEN a.finish - 50 AND a.finish
  GROUP BY a.doc_id, a.line HAVING sum(b.tokens) >= 51
), again AS (
  SELECT passage, min(doc_id) AS first FROM runs GROUP BY passage HAVING count(DISTINCT doc_id) > 1
), cuts AS (
  SELECT doc_id, line FROM matched JOIN often USING (leaf, template) WHERE doc_id <> first
  UNION
  SELECT doc_id, unnest(run_lines) FROM runs JOIN again USING (passage) WHERE doc_id <> first
), left_over AS (
  SELECT doc_id, count(*) FILTER (WHERE cuts.line IS NOT NULL) AS n_dropped,
    string_agg(raw, chr(10) ORDER BY raw.line) FILTER (WHERE cuts.line IS NULL) AS kept
  FROM raw LEFT JOIN cuts USING (doc_id, line) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE length(d.text) - length(replace(d.text, chr(10), '')) + 1 END AS n_lines,
  n_dropped, CASE WHEN n_dropped = 0 THEN d.text ELSE coalesce(kept, '') END AS text
FROM documents d JOIN left_over USING (doc_id)
"""

SEEKABLE_WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

SOURCE_MIXING = f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORD})) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw, md5(coalesce(text, '')) AS tie
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(2 * sum(size) AS BIGINT) AS most,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM docs GROUP BY source
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place,
    sum(source_size) OVER () * 150 / 100.0 AS budget, sum(weight) OVER () AS weights
  FROM sources
), levels AS (
  SELECT *, (budget - coalesce(sum(most) OVER before, 0)) / (weights - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ordered WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (SELECT level FROM levels WHERE weight * level <= most ORDER BY place LIMIT 1),
goals AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR weight * level > most THEN CAST(most AS DOUBLE) ELSE weight * level END AS target
  FROM sources LEFT JOIN level ON true
), placed AS (
  SELECT d.*, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS repeats,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, source, CAST(repeats * size
  + greatest(0, least(size, CAST(floor(target) AS BIGINT) - repeats * source_size - start)) AS BIGINT) AS taken
FROM placed
"""


def _distance(shares: str, own: str) -> str:
    """Jensen-Shannon distance of two lists of probabilities."""
    term = "CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"
    both = f"{term.format(p=own, q=shares)} + {term.format(p=shares, q=own)}"
    return f"sqrt(greatest(sum({both}) / 2, 0))"


QUALITY_RULES = rf"""
WITH t AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws,
    regexp_extract_all(lower(coalesce(text, '')), {WORD}) AS low,
    regexp_replace(coalesce(text, ''), '\p{{L}}+', '', 'g') AS rest
  FROM documents
), c AS (
  SELECT doc_id, lang, t, ws, low, rest, length(t) - length(rest) AS letters,
    length(rest) - length(regexp_replace(rest, '\p{{N}}+', '', 'g')) AS numbers,
    length(rest) - length(regexp_replace(rest, {GAPS}, '', 'g')) AS space,
    length(rest) - length(regexp_replace(rest, '[.,;:!?''"()-]+', '', 'g')) AS marks,
    length(rest) - length(regexp_replace(rest, '[#*$%&|<>]+', '', 'g')) AS symbols
  FROM t
), classes AS (
  SELECT doc_id, lang, len(ws) AS n_words, unnest([0, 1, 2, 3, 4]) AS place,
    unnest([letters, numbers, space, marks, length(rest) - numbers - space - marks]) AS n
  FROM c
), class_shares AS (
  SELECT lang, place, sum(n) / nullif(sum(sum(n)) OVER (PARTITION BY lang), 0) AS q FROM classes GROUP BY lang, place
), words AS (SELECT doc_id, lang, unnest(low) AS word FROM c),
vocabulary AS (SELECT lang, word, count(*) AS n FROM words GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS ref_words FROM vocabulary GROUP BY lang),
common AS (
  SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM vocabulary
  QUALIFY place <= 16
), word_shares AS (
  SELECT c.lang, word, place, n / ref_words AS q FROM common c JOIN totals o ON c.lang IS NOT DISTINCT FROM o.lang
  UNION ALL
  SELECT c.lang, NULL, 99, (max(ref_words) - sum(n)) / max(ref_words)
  FROM common c JOIN totals o ON c.lang IS NOT DISTINCT FROM o.lang GROUP BY c.lang
), judged AS (
  SELECT c.doc_id, c.lang, len(ws) AS n_words FROM c JOIN totals o ON c.lang IS NOT DISTINCT FROM o.lang
  WHERE len(ws) >= 60 AND ref_words >= 5000
), class_distance AS (
  SELECT doc_id, {_distance('q', 'p')} AS class_distance FROM (
    SELECT x.doc_id, s.q, x.n / sum(x.n) OVER (PARTITION BY x.doc_id) AS p FROM classes x SEMI JOIN judged USING (doc_id)
    JOIN class_shares s ON s.lang IS NOT DISTINCT FROM x.lang AND s.place = x.place
  ) GROUP BY doc_id
), found AS (
  SELECT j.doc_id, s.place, count(*) AS n FROM judged j JOIN words w USING (doc_id)
  JOIN word_shares s ON s.lang IS NOT DISTINCT FROM j.lang AND s.word = w.word GROUP BY ALL
), word_distance AS (
  SELECT doc_id, {_distance('q', 'p')} AS word_distance FROM (
    SELECT j.doc_id, s.q, CASE WHEN s.place = 99
      THEN (j.n_words - sum(coalesce(f.n, 0)) OVER (PARTITION BY j.doc_id)) / j.n_words ELSE coalesce(f.n, 0) / j.n_words END AS p
    FROM judged j JOIN word_shares s ON s.lang IS NOT DISTINCT FROM j.lang LEFT JOIN found f ON f.doc_id = j.doc_id AND f.place = s.place
  ) GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS key FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM c WHERE len(ws) > 5)
), again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM again) GROUP BY doc_id
), dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM c)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), rows AS (
  SELECT c.doc_id, len(ws) AS n_words, length(t) - space AS word_chars, symbols AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
    coalesce(repeats.n, 0) AS n_repeat_words, class_distance, word_distance
  FROM c LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)
  LEFT JOIN class_distance USING (doc_id) LEFT JOIN word_distance USING (doc_id)
), base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM rows)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(class_distance > 0.27, false) AND NOT coalesce(word_distance > 0.32, false) AS kept,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM base
"""


def _k_means(k: int, width: int, scale: int, rounds: int) -> str:
    steps = [f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c, v AS m FROM kept QUALIFY c < {k}
)"""]
    distance = f"list_sum(list_transform(range(1, {width + 1}), lambda i: (v[i] - m[i]) * (v[i] - m[i])))"
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min(CAST({distance} AS BIGINT) * {k} + c) AS best FROM kept, c{r} GROUP BY rid
)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
  SELECT best % {k} AS c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT best, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM a{r}) GROUP BY ALL
), c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(moved, m) AS m FROM c{r} LEFT JOIN (
    SELECT c, list((s - (s % n + n) % n) // n ORDER BY i) AS moved FROM s{r} GROUP BY c
  ) USING (c)
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(best % {k} AS INTEGER) AS cluster, best // {k} AS distance,
  CAST(sum(best // {k}) OVER (PARTITION BY best % {k}) AS BIGINT) AS cluster_inertia, CAST(sum(best // {k}) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = best % {k}
"""


# A run of q words' period is at least 12 and 2q words long, so its first six words stand again q words on.
SQUARE_CATCHING = rf"""
WITH hashed AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda ch: CAST(ascii(ch) AS BIGINT))), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT) FOR i IN range(8)]),
      lambda x, unused: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS h
  FROM documents
), drawn AS (
  SELECT *, len(ws) AS n, h // 10 % greatest(len(ws), 1) AS a, 1 + (len(ws) - h // 10 % greatest(len(ws), 1)) // (3 + h // 10 % 8) AS p FROM hashed
), docs AS MATERIALIZED (
  SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE ws END AS ws
  FROM drawn
), grams AS MATERIALIZED (
  SELECT rid, i, hash(ws[i + 1:i + 6]) AS h, ws[i + 1:i + 6] AS gram FROM (SELECT rid, ws, unnest(range(n - 5)) AS i FROM docs)
), pairs AS (
  SELECT a.rid, a.i, b.i - a.i AS period FROM grams a JOIN grams b ON a.rid = b.rid AND a.h = b.h AND a.i < b.i AND a.gram = b.gram
), islands AS (SELECT *, i - row_number() OVER (PARTITION BY rid, period ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT rid, period, min(i) AS start, count(*) + 5 AS same FROM islands GROUP BY rid, period, island
  HAVING same >= period AND same + period >= 12
), runs AS MATERIALIZED (
  SELECT rid, start, same + period AS length, min(period) AS period FROM stretches GROUP BY ALL
), dropped AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
words AS (SELECT rid, unnest(range(n)) AS i, unnest(ws) AS word FROM docs),
collapsed AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN dropped USING (rid, i) GROUP BY rid
), listed AS (
  SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    max(struct_pack(length := length, later := -start, wider := -period)) AS top
  FROM runs GROUP BY rid
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -top.later AS start, top.length AS length, -top.wider AS period,
  1000 * top.length // -top.wider AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (rid) LEFT JOIN collapsed USING (rid)
"""

ORACLES = {
    "op1_jaccard_join": JACCARD_JOIN, "op2_line_templates": LINE_TEMPLATES, "op4_seekable_warc": SEEKABLE_WARC,
    "op9_source_mixing": SOURCE_MIXING, "op10_quality_rules": QUALITY_RULES,
    "op11_va_file": _k_means(k=40, width=64, scale=256, rounds=5), "op12_square_catching": SQUARE_CATCHING,
}
