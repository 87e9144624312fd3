"""The queries of this subpackage that SQL can express, for DuckDB."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

REACHED = """
both_ways AS (SELECT a AS u, b AS v FROM links UNION SELECT b, a FROM links),
reached(u, v) AS (
  SELECT id, id FROM ids UNION SELECT reached.u, both_ways.v FROM reached JOIN both_ways ON reached.v = both_ways.u),
component AS (SELECT u AS id, min(v) AS component_id FROM reached GROUP BY u)"""

ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": f"""WITH RECURSIVE
ids AS (SELECT vec_id AS id FROM embeddings),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id < y.vec_id
  WHERE list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) >= 0.98),
{REACHED}
SELECT id AS vec_id, (SELECT count(*) FROM both_ways WHERE u = id) AS n_links, component_id, id = component_id AS kept
FROM component""",
    "op6_minhash_near_dedup": f"""WITH RECURSIVE
ids AS (SELECT doc_id AS id FROM documents),
split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM split WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
{REACHED}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
FROM component LEFT JOIN sizes ON doc_id = id""",
    "op8_suffix_array_dedup": """WITH
bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS MATERIALIZED (
  SELECT doc_id, 1024 * c AS start, substr(h, 2048 * c + 1, 2048 + 798) AS h
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2048 + 1)) AS c FROM bytes)),
strings AS MATERIALIZED (
  SELECT doc_id, start + i AS i, md5(substr(h, 2 * i + 1, 800)) AS s
  FROM (SELECT doc_id, start, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM parts)),
repeated AS (SELECT s FROM strings GROUP BY s HAVING count(*) > 1),
starts AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM strings SEMI JOIN repeated USING (s)),
numbered AS (
  SELECT doc_id, i, sum(CASE WHEN i <= before + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM starts),
spans AS MATERIALIZED (SELECT doc_id, k, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, k),
kept AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM (
    SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, length(h) // 2, NULL FROM bytes)),
rest AS (
  SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS h
  FROM kept JOIN bytes USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, length(bytes.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(rest.h)) AS kept_sha256,
       decode(unhex(array_to_string(list_transform(
         regexp_extract_all(rest.h, '[0-7].|[CD].[89AB].|E.(?:[89AB].){2}|F.(?:[89AB].){3}|F.(?:[89AB].){1,2}|E.[89AB].|..'),
         lambda c: CASE WHEN regexp_full_match(c, '[0-7].|[CD].[89AB].|E.(?:[89AB].){2}|F.(?:[89AB].){3}') THEN c ELSE 'EFBFBD' END), ''))) AS text
FROM bytes JOIN rest USING (doc_id) LEFT JOIN removed USING (doc_id)""",
    "op11_periodic_runs": r"""WITH
ids AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
    4294967295 - list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, ignored: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS h
  FROM documents),
placed AS (SELECT doc_id, ws, h, len(ws) AS n, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM ids),
planted AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(range(0, n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END + 1])
    ELSE ws END AS ws FROM placed),
words AS MATERIALIZED (SELECT doc_id, n, unnest(range(0, n)) AS i, unnest(ws) AS w FROM planted),
matches AS (
  SELECT x.doc_id, x.i - y.i AS q, x.i FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.w = y.w AND y.i < x.i AND 4 * (x.i - y.i) <= x.n),
stretches AS (
  SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM matches) GROUP BY doc_id, q, k),
runs AS MATERIALIZED (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
lists AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS every,
    min((-length, start, period)) AS best
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
rest AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[2] AS start, -best[1] AS length, best[3] AS period,
       1000 * -best[1] // best[3] AS exponent_milli, sha256(coalesce(every, '')) AS runs_sha256,
       sha256(coalesce(rest.text, '')) AS collapsed_sha256
FROM ids LEFT JOIN lists USING (doc_id) LEFT JOIN rest USING (doc_id)""",
    "op12_source_divergence": f"""WITH
texts AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
terms AS MATERIALIZED (
  SELECT doc_id, lang, source,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM texts),
kept AS MATERIALIZED (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 10),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM texts) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS MATERIALIZED (
  SELECT lang, source, v, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM texts) JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source) USING (lang, source)),
shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2) // (total + 2 * v) AS p
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
whole AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 2) // (any_value(total) + 2 * any_value(v)) AS q
  FROM counts JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS total FROM counts GROUP BY lang) USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
every AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pairs ON pairs.lang = x.lang AND pairs.source = x.source AND pairs.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10""",
    "op13_quality_rules": """WITH
split AS (
  SELECT doc_id, source, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM split WHERE len(ws) >= 5)),
again AS (SELECT doc_id, s FROM windows GROUP BY doc_id, s HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM windows SEMI JOIN again USING (doc_id, s))
  GROUP BY doc_id),
counted AS (
  SELECT doc_id, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    list_filter(lines, lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS held, coalesce(covered.n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)),
ruled AS MATERIALIZED (
  SELECT *, len(held) - len(list_distinct(held)) AS n_dup_lines,
    n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeats, 100 * n_symbols > 10 * word_chars AS symbols,
    100 * (len(held) - len(list_distinct(held))) > 30 * len(held) AS dup FROM counted),
rules AS (
  SELECT source, rule, CAST(failed AS DOUBLE) AS x FROM ruled, LATERAL (SELECT unnest([short, repeats, symbols, dup]) AS failed, unnest([1, 2, 3, 4]) AS rule)
  WHERE source IS NOT NULL),
hosts AS MATERIALIZED (SELECT source, rule, sum(x) AS x, CAST(count(*) AS DOUBLE) AS n FROM rules GROUP BY source, rule),
sums AS (
  SELECT rule, count(*) AS k, sum(n) AS n, sum(n * n) / sum(n) AS per, sum(x) / sum(n) AS m, sum(x * x / n) AS s FROM hosts GROUP BY rule),
fitted AS (
  SELECT rule, m, CASE WHEN m * (1 - m) > 0 AND n - per - (k - 1) > 0
    THEN (s - n * m * m - m * (1 - m) * (k - 1)) / (m * (1 - m) * (n - per - (k - 1))) ELSE 0 END AS between_hosts FROM sums),
priors AS (
  SELECT rule, m, CASE WHEN between_hosts > 0 THEN least(1000.0, greatest(10.0, 1 / between_hosts - 1)) ELSE 1000.0 END AS strength FROM fitted),
failing AS (SELECT DISTINCT source FROM hosts JOIN priors USING (rule) WHERE (x + m * strength) / (n + strength) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
       NOT (short OR repeats) AND failing.source IS NULL AS kept, failing.source IS NOT NULL AS host_failed
FROM ruled LEFT JOIN failing USING (source)""",
}
