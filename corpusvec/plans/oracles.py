"""The registered queries as SQL for DuckDB, for those SQL can express."""

from __future__ import annotations

from corpusvec.plans.queries import (
    DIM,
    DUPLICATES,
    EQUAL_SHARDS,
    LINES_PER_SHARD,
    MERGES,
    RANGES,
    SMALL_MODEL,
    STRIDE,
    TOKEN_ROWS_PER_SHARD,
    TOP,
    WINDOW,
)

SPACE = r"[ \t\n\x0B\f\r]"
# Every character up to U+0020 but NUL, which SQL text cannot hold.
TRIMMED = "concat(" + ",".join(f"chr({c})" for c in range(1, 33)) + ")"

LINES = r"""
line_lists AS (
  SELECT doc_id, string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') AS parts
  FROM documents WHERE text <> ''),
lines AS (
  SELECT doc_id, i - 1 AS line_no, parts[i] AS line
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM line_lists)),
numbered AS (
  SELECT doc_id, line_no, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS line_index, line FROM lines)"""

WORDS = rf"""
word_lists AS (
  SELECT doc_id, list_filter(string_split_regex(text, '{SPACE}+'), lambda w: w <> '') AS ws FROM documents),
words AS (
  SELECT doc_id, j - 1 AS j, ws[j] AS word
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM word_lists)),
positioned AS (
  SELECT row_number() OVER (ORDER BY doc_id, j) - 1 AS pos, word FROM words)"""

LETTERS = WORDS + r""",
letters AS (
  SELECT pos, regexp_replace(word, '[^a-zA-Z]', '', 'g') AS word FROM positioned),
ordered AS (
  SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS row_index, word FROM letters WHERE word <> '')"""

DENSE = LETTERS + f""",
sharded AS (
  SELECT row_index // {TOKEN_ROWS_PER_SHARD} AS shard_id, row_index, word FROM ordered),
dense AS (
  SELECT shard_id, row_index, word,
         dense_rank() OVER (PARTITION BY shard_id ORDER BY word) - 1 AS token_index
  FROM sharded)"""

POSITION_LINES = WORDS + r""",
position_lines AS (
  SELECT CASE j % 4 WHEN 0 THEN '_' || word
                    WHEN 1 THEN 'x' || doc_id || '_' || word
                    WHEN 2 THEN ' ' || doc_id || '_' || word || ' '
                    ELSE doc_id || '_a_' || word END AS value
  FROM words)"""

LINE_WORDS = f"""WITH {LINES},
line_words AS (
  SELECT line_index, list_filter(string_split_regex(line, '{SPACE}+'), lambda w: w <> '') AS ws FROM numbered),
each AS (SELECT line_index, ws, unnest(range(1, len(ws) + 1)) AS j FROM line_words)
SELECT line_index, row_number() OVER (ORDER BY line_index, j) - 1 AS pos, ws[j] AS word FROM each"""

CLEAN = rf"trim(regexp_replace(line, '[^\w\t\n\x0B\f\r ]', '', 'g'), {TRIMMED})"

CLEAN_COUNTS = r"""
counts AS MATERIALIZED (
  SELECT word, count(*) AS frequency
  FROM (SELECT unnest(string_split_regex(
          lower(regexp_replace(text, '[^\w\t\n\x0B\f\r ]', '', 'g')), '\W+')) AS word FROM documents)
  WHERE word <> '' GROUP BY word)"""

RAW_COUNTS = r"""
counts AS MATERIALIZED (
  SELECT word, count(*) AS frequency
  FROM (SELECT unnest(string_split_regex(lower(text), '\W+')) AS word FROM documents)
  WHERE word <> '' GROUP BY word)"""

# Words here are [a-z0-9_]+, for which sub-word pieces are letters with at
# most one underscore in front, up to three digits, or underscores.
PIECES = r"""
pieces AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(word, '_?[a-z]+|[0-9]{1,3}|_+')) AS piece, frequency FROM counts),
pairs AS (
  SELECT piece[i] AS l, piece[i + 1] AS r, frequency
  FROM (SELECT piece, frequency, unnest(range(1, len(piece))) AS i FROM pieces)),
pair_counts AS (
  SELECT lower(hex(l)) AS "left", lower(hex(r)) AS "right", CAST(sum(frequency) AS BIGINT) AS frequency,
         min(l || r) AS pair
  FROM pairs GROUP BY l, r)"""

ONE_MERGE = CLEAN_COUNTS + "," + PIECES + r""",
best AS MATERIALIZED (
  SELECT pair FROM pair_counts ORDER BY frequency DESC, "left", "right" LIMIT 1)"""

# Left to right, the one merged pair or a single character.
TOKENS = """
list_transform(string_split(replace({word}, {pair}, chr(1)), ''),
               lambda t: CASE WHEN t = chr(1) THEN 256 ELSE ord(t) END)"""


def learned(merges: int) -> str:
    """Merges learned one at a time, and what they make of every piece.

    Pieces of ``ordered`` words, which keep capitals, go along without weight.
    A token is found by its merges in the order they were learned.
    """
    steps = [r"""
word_pieces AS MATERIALIZED (
  SELECT word, i, ps[i] AS piece, frequency FROM (
    SELECT word, ps, frequency, unnest(range(1, len(ps) + 1)) AS i FROM (
      SELECT word, frequency, regexp_extract_all(word, '_?[a-z]+|[0-9]{1,3}|_+') AS ps FROM counts))),
start AS (
  SELECT piece, CAST(sum(frequency) AS BIGINT) AS f FROM (
    SELECT piece, frequency FROM word_pieces UNION ALL SELECT DISTINCT word, 0 FROM ordered) GROUP BY piece),
s0 AS MATERIALIZED (
  SELECT piece, f, regexp_replace(lower(hex(piece)), '(..)', '<\1>', 'g') AS s FROM start)"""]
    for k in range(1, merges + 1):
        steps.append(f"""
b{k} AS MATERIALIZED (
  SELECT p[i] AS l, p[i + 1] AS r FROM (
    SELECT p, f, unnest(range(1, len(p))) AS i FROM (
      SELECT string_split(trim(s, '<>'), '><') AS p, f FROM s{k - 1} WHERE f > 0))
  GROUP BY l, r ORDER BY sum(f) DESC, l, r LIMIT 1),
s{k} AS MATERIALIZED (
  SELECT piece, f, replace(s, '<' || l || '><' || r || '>', '<' || l || r || '>') AS s FROM s{k - 1}, b{k})""")
    every = " UNION ALL ".join(f"SELECT {k} AS k, l || r AS t FROM b{k}" for k in range(1, merges + 1))
    steps.append(f"""
first_learned AS (SELECT t, min(k) AS k FROM ({every}) GROUP BY t),
tokens AS MATERIALIZED (
  SELECT printf('%02x', b) AS t, CAST(b AS INTEGER) AS id FROM range(0, 256) x(b)
  UNION ALL SELECT t, CAST(255 + row_number() OVER (ORDER BY k) AS INTEGER) FROM first_learned),
piece_ids AS MATERIALIZED (
  SELECT piece, list(id ORDER BY i) AS ids FROM (
    SELECT piece, p[i] AS t, i FROM (
      SELECT piece, p, unnest(range(1, len(p) + 1)) AS i FROM (
        SELECT piece, string_split(trim(s, '<>'), '><') AS p FROM s{merges}))) JOIN tokens USING (t)
  GROUP BY piece)""")
    return ",".join(steps)


SHARD_IDS = f"""
shard_ids AS (
  SELECT row_index // {TOKEN_ROWS_PER_SHARD} AS shard_id, row_index, i, ids[i] AS id
  FROM (SELECT row_index, ids, unnest(range(1, len(ids) + 1)) AS i FROM ordered JOIN piece_ids ON word = piece))"""


def token_list(tokens: str) -> str:
    return f"'[' || array_to_string({tokens}, ' ') || ']'"


def windows_sql(partial: str) -> str:
    size = WINDOW + 1
    starts = (
        f"s + {size} <= n"
        if partial == "drop"
        else f"s < n AND (s = 0 OR s - {STRIDE} + {size} < n)"
    )
    return f"""WITH {DENSE},
seqs AS (
  SELECT shard_id, list(token_index ORDER BY row_index) AS t, count(*) AS n FROM dense GROUP BY shard_id),
starts AS (
  SELECT shard_id, t, n, s FROM (SELECT shard_id, t, n, unnest(range(0, n, {STRIDE})) AS s FROM seqs)
  WHERE {starts})
SELECT shard_id, CAST(s AS INTEGER) AS start_idx,
       {token_list(f"t[s + 1 : s + {WINDOW}]")} AS context,
       CAST(t[least(s + {size}, n)] AS INTEGER) AS target
FROM starts"""


NAMED = """
named AS (
  SELECT 'w' || vec_id AS word, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""

JOINED = f"""
named AS (
  SELECT 'w' || (vec_id // {DUPLICATES}) AS word, flatten(list(CAST(embedding AS DOUBLE[]) ORDER BY vec_id)) AS v
  FROM embeddings GROUP BY ALL)"""

TOP_OF_NAMED = f"""
scored AS (
  SELECT a.word, b.word AS neighbour,
         CASE WHEN list_inner_product(a.v, a.v) = 0 OR list_inner_product(b.v, b.v) = 0 THEN 0.0
              ELSE list_cosine_similarity(a.v, b.v) END AS similarity
  FROM named a JOIN named b ON a.word <> b.word),
ranked AS (
  SELECT word, neighbour, similarity,
         row_number() OVER (PARTITION BY word ORDER BY round(similarity, 9) DESC, neighbour) AS rank
  FROM scored),
best AS (SELECT * FROM ranked WHERE rank <= {TOP})"""

TOP_SQL = f"{NAMED}, {TOP_OF_NAMED}"

def hashed_normals(name: str, seed: int, width: int) -> str:
    """``(id, i, x)``: a normal number for each token and column, from a hash of both (splitmix64)."""
    wrap = "% CAST('18446744073709551616' AS UHUGEINT)"

    def shifted(bits: int, factor: str) -> str:
        return f"SELECT id, c, (xor(x, x >> {bits}) * CAST('{factor}' AS UHUGEINT)) {wrap} AS x"

    return f"""
{name}_bits AS (
  SELECT id, c, xor(x, x >> 31) AS x FROM (
    {shifted(27, "10723151780598845931")} FROM (
      {shifted(30, "13787848793156543929")} FROM (
        SELECT id, c, (CAST(id * {2 * width} + c + {seed} AS UHUGEINT) * CAST('11400714819323198485' AS UHUGEINT)) {wrap} AS x
        FROM (SELECT DISTINCT id FROM flat), range(0, {2 * width}) r(c))))),
{name} AS MATERIALIZED (
  SELECT a.id, a.c AS i, sqrt(-2 * ln((CAST(a.x >> 11 AS DOUBLE) + 0.5) / 9007199254740992.0))
    * cos(2 * pi() * ((CAST(b.x >> 11 AS DOUBLE) + 0.5) / 9007199254740992.0)) AS x
  FROM {name}_bits a JOIN {name}_bits b ON a.id = b.id AND b.c = a.c + {width} WHERE a.c < {width})"""


# One forward pass and its gradient, summed over distinct contexts of a shard.
# Every logit is the sum over both context places of the product of vectors.
DIM_SMALL = SMALL_MODEL.dim
ONE_EPOCH = f"""WITH {LETTERS}, {ONE_MERGE},
coded AS MATERIALIZED (
  SELECT row_index // {TOKEN_ROWS_PER_SHARD} AS shard_id, row_index, {TOKENS.format(word="word", pair="pair")} AS ids FROM ordered, best),
flat AS MATERIALIZED (
  SELECT shard_id, row_number() OVER (PARTITION BY shard_id ORDER BY row_index, i) - 1 AS k, CAST(ids[i] AS BIGINT) AS id
  FROM (SELECT *, unnest(range(1, len(ids) + 1)) AS i FROM coded)),
vocab AS MATERIALIZED (SELECT DISTINCT shard_id, id FROM flat),
seen AS MATERIALIZED (
  SELECT shard_id, c0, c1, coalesce(t, c1) AS t, count(*) AS m FROM (
    SELECT shard_id, k, id AS c0, lead(id, 1) OVER w AS c1, lead(id, 2) OVER w AS t FROM flat WINDOW w AS (PARTITION BY shard_id ORDER BY k))
  WHERE k % 2 = 0 AND c1 IS NOT NULL GROUP BY ALL),
sizes AS MATERIALIZED (
  SELECT shard_id, n, sqrt(2 / (v + {DIM_SMALL})) AS scale_in, sqrt(2 / ({2 * DIM_SMALL} + v)) AS scale_out
  FROM (SELECT shard_id, sum(m) AS n FROM seen GROUP BY shard_id) JOIN (SELECT shard_id, count(*) AS v FROM vocab GROUP BY shard_id)
  USING (shard_id)),
{hashed_normals("e", SMALL_MODEL.seed, DIM_SMALL)},
{hashed_normals("o", SMALL_MODEL.seed + 1, 2 * DIM_SMALL)},
products AS MATERIALIZED (
  SELECT e.id AS c, o.i // {DIM_SMALL} AS j, o.id AS t, sum(e.x * o.x) AS s FROM e JOIN o ON o.i % {DIM_SMALL} = e.i GROUP BY ALL),
contexts AS (SELECT shard_id, c0, c1, sum(m) AS m FROM seen GROUP BY ALL),
scored AS (
  SELECT shard_id, c0, c1, vocab.id AS t, contexts.m, exp(scale_in * scale_out * (x.s + y.s)) AS w
  FROM contexts JOIN vocab USING (shard_id) JOIN sizes USING (shard_id)
  JOIN products x ON x.c = c0 AND x.j = 0 AND x.t = vocab.id JOIN products y ON y.c = c1 AND y.j = 1 AND y.t = vocab.id),
likely AS MATERIALIZED (SELECT shard_id, c0, c1, t, m, w / sum(w) OVER (PARTITION BY shard_id, c0, c1) AS p FROM scored)"""

COUNTED = f"""WITH {LETTERS}, {CLEAN_COUNTS}, {learned(MERGES)}
SELECT word, flatten(list(ids ORDER BY i)) AS token_ids, any_value(frequency) AS frequency
FROM word_pieces JOIN piece_ids USING (piece) GROUP BY word"""

COUNTED_ONE_MERGE = f"""WITH {LETTERS}, {CLEAN_COUNTS}, {learned(1)}
SELECT word, {token_list("flatten(list(ids ORDER BY i))")} AS token_list, any_value(frequency) AS frequency
FROM word_pieces JOIN piece_ids USING (piece) GROUP BY word"""

ORACLES: dict[str, str] = {
    "clean_lines": f"WITH {LINES} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, {CLEAN} AS line FROM lines",
    "word_counts": f"WITH {CLEAN_COUNTS} SELECT word, frequency FROM counts",
    "word_counts_raw": f"WITH {RAW_COUNTS} SELECT word, frequency FROM counts",
    "indexed_lines": f"WITH {LINES} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line_index, line FROM numbered",
    "positioned_words": f"WITH {WORDS} SELECT pos, word FROM positioned",
    "positioned_words_of_lines": LINE_WORDS,
    "positioned_lines": LINE_WORDS,
    "ordered_words": f"WITH {LETTERS} SELECT pos, row_index, word FROM ordered",
    "positioned_letters": f"WITH {LETTERS} SELECT pos, word FROM ordered",
    "row_index": f"WITH {LETTERS} SELECT pos, row_index FROM ordered",
    "max_position": f"WITH {WORDS} SELECT greatest(coalesce(max(pos), 0), 0) AS max_position FROM positioned",
    # Untrimmed, a leading space spoils the number.
    "max_position_of_lines": f"""WITH {POSITION_LINES}
SELECT greatest(coalesce(max(try_cast(regexp_extract(value, '^([+-]?[0-9]+)_(?s:.+)$', 1) AS BIGINT)), 0), 0)
       AS max_position FROM position_lines""",
    "position_ranges": f"""WITH {WORDS},
top AS (SELECT greatest(CAST(ceil(max(pos) / {RANGES}) AS BIGINT), 1) AS width FROM positioned)
SELECT CAST(least(pos // (SELECT width FROM top), {RANGES - 1}) AS INTEGER) AS part, count(*) AS n,
       min(pos) AS first_pos, max(pos) AS last_pos
FROM positioned GROUP BY 1""",
    "fixed_shards": f"""WITH {LINES}
SELECT line_index // {LINES_PER_SHARD} AS shard_id, line_index, {CLEAN} AS line FROM numbered""",
    "equal_shards": f"""WITH {LINES},
size AS (SELECT greatest(CAST(ceil(count(*) / {EQUAL_SHARDS}) AS BIGINT), 1) AS n FROM numbered)
SELECT line_index // (SELECT n FROM size) AS shard_id, count(*) AS n,
       min(line_index) AS first_line, max(line_index) AS last_line
FROM numbered GROUP BY 1""",
    "parse_positions": f"""WITH {POSITION_LINES},
trimmed AS (SELECT trim(value, {TRIMMED}) AS value FROM position_lines),
parsed AS (
  SELECT try_cast(regexp_extract(value, '^([+-]?[0-9]+)_(?s:.+)$', 1) AS BIGINT) AS pos,
         regexp_extract(value, '^[^_]+_((?s:.+))$', 1) AS word FROM trimmed)
SELECT pos, word, count(*) AS n FROM parsed WHERE pos IS NOT NULL GROUP BY pos, word""",
    "reject_positions": f"""WITH {POSITION_LINES}
SELECT value, count(*) AS n FROM position_lines
WHERE NOT regexp_matches(trim(value, {TRIMMED}), '^[+-]?[0-9]+_(?s:.+)$') GROUP BY value""",
    "parse_embedding_csv": """
SELECT CAST(p_partkey AS VARCHAR) AS token_id, p_name || ', ' || p_brand AS word,
       CAST(p_size AS DOUBLE) AS size, p_retailprice AS price
FROM part WHERE p_partkey % 10 NOT IN (3, 7)""",
    "reject_embedding_csv": """
SELECT p_partkey || ',' || p_name AS value, 'no numbers' AS reason FROM part WHERE p_partkey % 10 = 7
UNION ALL SELECT p_partkey || ',' || p_name || ',high', 'numbers' FROM part WHERE p_partkey % 10 = 7
UNION ALL SELECT p_partkey || ',"' || p_name || ', ' || p_brand || '",' || p_size || ',' || p_retailprice || ',high', 'numbers'
FROM part WHERE p_partkey % 10 NOT IN (3, 7)""",
    "reject_token_csv": """
SELECT 'x' || p_partkey || ',"' || p_name || '",[' || p_size || ' 7]' AS value, 'position' AS reason FROM part WHERE p_partkey % 10 = 5
UNION ALL SELECT p_partkey || ',"' || p_name || '"', 'tokens' FROM part WHERE p_partkey % 10 = 7
UNION ALL SELECT p_partkey || ',"' || p_name || '",[1 two]', 'tokens' FROM part WHERE p_partkey % 10 = 9""",
    "split_csv": f"""WITH {LINES},
segments AS (
  SELECT doc_id, line_no, string_split('7,"a, b", ' || line || ',x"y,z', '"') AS s FROM lines),
marked AS (
  SELECT doc_id, line_no, array_to_string(list_transform(s, lambda part, i:
           CASE WHEN i % 2 = 1 THEN replace(part, ',', chr(1)) ELSE part END), '') AS m FROM segments),
fields AS (SELECT doc_id, line_no, string_split(m, chr(1)) AS f FROM marked)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(i - 1 AS INTEGER) AS field_no,
       trim(f[i], {TRIMMED}) AS field
FROM (SELECT doc_id, line_no, f, unnest(range(1, len(f) + 1)) AS i FROM fields)""",
    "token_lists": f"""WITH {LINES},
lengths AS (
  SELECT doc_id, line_no, list_transform(
    list_filter(string_split_regex(line, '{SPACE}+'), lambda w: w <> ''), lambda w: length(w)) AS t FROM lines)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, {token_list("t")} AS token_list,
       CAST(len(t) AS INTEGER) AS n, CAST(list_sum(t) AS BIGINT) AS total
FROM lengths WHERE len(t) > 0""",
    "vector_text": f"""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, CAST(embedding[i] AS DOUBLE) AS x
FROM (SELECT vec_id, embedding, unnest(range(1, {DIM} + 1)) AS i FROM embeddings)""",
    "line_shards_on_disk": f"""WITH {LINES}
SELECT CAST(line_index // {LINES_PER_SHARD} AS INTEGER) AS shard_id, {CLEAN} AS value, count(*) AS n
FROM numbered GROUP BY 1, 2""",
    "numbered_shards_on_disk": f"""WITH {LINES},
size AS (SELECT greatest(CAST(ceil(count(*) / {EQUAL_SHARDS}) AS BIGINT), 1) AS n FROM numbered)
SELECT CAST(line_index // (SELECT n FROM size) AS INTEGER) AS shard_id, line_index, line FROM numbered""",
    "position_shards_on_disk": f"WITH {WORDS} SELECT pos, word FROM positioned",
    "packed_line_shards": f"""WITH {LINES}
SELECT line_index // {LINES_PER_SHARD} AS shard_id, line_index % {LINES_PER_SHARD} AS row, {CLEAN} AS line FROM numbered""",
    "packed_position_shards": f"WITH {WORDS} SELECT pos, word FROM positioned",
    "numbered_text_lines": f"WITH {LINES} SELECT line_index, line FROM numbered",
    "token_indexes": f"WITH {DENSE} SELECT DISTINCT shard_id, word, CAST(token_index AS INTEGER) AS token_index FROM dense",
    "dense_tokens": f"WITH {DENSE} SELECT shard_id, row_index, word, CAST(token_index AS INTEGER) AS token_index FROM dense",
    "tokens_of_indexes": f"WITH {DENSE} SELECT shard_id, row_index, word FROM dense",
    "token_windows": windows_sql("keep"),
    "full_token_windows": windows_sql("drop"),
    "word_slices": f"""WITH {WORDS},
kept AS (
  SELECT doc_id, j, regexp_replace(word, '[^a-zA-Z]', '', 'g') AS word FROM words
  WHERE regexp_matches(word, '[a-zA-Z]')),
placed AS (
  SELECT doc_id, word, row_number() OVER (ORDER BY doc_id, j) - 1 AS row_index FROM kept)
SELECT row_index // {TOKEN_ROWS_PER_SHARD} AS shard_id, min(row_index) AS row_index,
       CAST(count(*) AS INTEGER) AS n, string_agg(word, ' ' ORDER BY row_index) AS words
FROM placed GROUP BY doc_id, row_index // {TOKEN_ROWS_PER_SHARD}""",
    "vector_mean": f"""
SELECT label, CAST(i - 1 AS INTEGER) AS i, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS x
FROM (SELECT label, embedding, unnest(range(1, {DIM} + 1)) AS i FROM embeddings) GROUP BY label, i""",
    "vector_concat": f"""
SELECT vec_id // {DUPLICATES} AS word, CAST((vec_id % {DUPLICATES}) * {DIM} + i - 1 AS INTEGER) AS i,
       CAST(embedding[i] AS DOUBLE) AS x
FROM (SELECT vec_id, embedding, unnest(range(1, {DIM} + 1)) AS i FROM embeddings)""",
    "vector_norms": """
SELECT vec_id, round(q, 6) AS sum_of_squares, round(sqrt(q), 6) AS norm
FROM (SELECT vec_id, list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS q
      FROM embeddings)""",
    "cosine_to_mean": f"""WITH
cells AS (
  SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x
  FROM (SELECT vec_id, label, embedding, unnest(range(1, {DIM} + 1)) AS i FROM embeddings)),
means AS (SELECT label, i, avg(x) AS m FROM cells GROUP BY label, i),
sums AS (
  SELECT vec_id, sum(x * m) AS d, sum(x * x) AS a, sum(m * m) AS b
  FROM cells JOIN means USING (label, i) GROUP BY vec_id)
SELECT vec_id, round(CASE WHEN a = 0 OR b = 0 THEN 0.0 ELSE d / (sqrt(a) * sqrt(b)) END, 6) AS similarity
FROM sums""",
    "top_n_similar": f"""WITH {TOP_SQL}
SELECT word, CAST(rank AS INTEGER) AS rank, neighbour, round(similarity, 6) AS similarity FROM best""",
    "top_n_similar_concat": f"""WITH {JOINED}, {TOP_OF_NAMED}
SELECT word, CAST(rank AS INTEGER) AS rank, neighbour, round(similarity, 6) AS similarity FROM best""",
    "similar_yaml": rf"""WITH {TOP_SQL}
SELECT word || ':' || chr(10) || string_agg(
         '  - word: ' || neighbour || chr(10) || '    similarity: ' || printf('%.4f', round(similarity, 4)),
         chr(10) ORDER BY rank) AS entry
FROM best GROUP BY word""",
    "subword_pair_counts": f"""WITH {RAW_COUNTS}, {PIECES} SELECT "left", "right", frequency FROM pair_counts""",
    "first_merge": f"""WITH {ONE_MERGE}
SELECT CAST(b AS INTEGER) AS token_id, printf('%02X', b) AS token FROM range(0, 256) t(b)
UNION ALL SELECT 256, hex(pair) FROM best""",
    "counted_tokens_one_merge": COUNTED_ONE_MERGE,
    "word_count_csv_scan": COUNTED_ONE_MERGE,
    "vocabulary": f"""WITH {LETTERS}, {CLEAN_COUNTS}, {learned(MERGES)}
SELECT id AS token_id, upper(t) AS token FROM tokens""",
    "vocabulary_file_scan": f"""WITH {LETTERS}, {CLEAN_COUNTS}, {learned(MERGES)}
SELECT id AS token_id, upper(t) AS token FROM tokens""",
    "counted_tokens": COUNTED,
    "counted_tokens_by_join": COUNTED,
    "ordered_tokens": f"""WITH {LETTERS}, {CLEAN_COUNTS}, {learned(MERGES)}
SELECT pos, row_index, word, ids AS token_ids FROM ordered JOIN piece_ids ON word = piece""",
    "one_epoch_embeddings": f"""{ONE_EPOCH},
errors AS MATERIALIZED (
  SELECT shard_id, c0, c1, t, (likely.m * p - coalesce(seen.m, 0)) / n AS r
  FROM likely JOIN sizes USING (shard_id) LEFT JOIN seen USING (shard_id, c0, c1, t)),
by_token AS (
  SELECT shard_id, c, j, t, sum(r) AS r FROM (
    SELECT shard_id, c0 AS c, 0 AS j, t, r FROM errors UNION ALL SELECT shard_id, c1, 1, t, r FROM errors) GROUP BY ALL),
gradient AS (
  SELECT shard_id, c, o.i % {DIM_SMALL} AS i, sum(r * scale_out * o.x) AS g
  FROM by_token JOIN sizes USING (shard_id) JOIN o ON o.id = t AND o.i // {DIM_SMALL} = j GROUP BY ALL)
SELECT CAST(vocab.id AS INTEGER) AS token_id, CAST(e.i AS INTEGER) AS i,
       round(avg(scale_in * e.x - {SMALL_MODEL.learning_rate} * coalesce(g, 0)), 6) AS value
FROM vocab JOIN sizes USING (shard_id) JOIN e USING (id)
LEFT JOIN gradient ON gradient.shard_id = vocab.shard_id AND c = vocab.id AND gradient.i = e.i GROUP BY vocab.id, e.i""",
    "training_losses": f"""{ONE_EPOCH}
SELECT shard_id, round(-sum(seen.m * ln(p)) / any_value(n), 6) AS first_loss, TRUE AS falls
FROM seen JOIN likely USING (shard_id, c0, c1, t) JOIN sizes USING (shard_id) GROUP BY shard_id""",
    "shard_vocabularies": f"""WITH {LETTERS}, {CLEAN_COUNTS}, {learned(MERGES)}, {SHARD_IDS}
SELECT shard_id, id AS token_id, CAST(row_number() OVER (PARTITION BY shard_id ORDER BY id) - 1 AS INTEGER) AS token_index
FROM (SELECT DISTINCT shard_id, id FROM shard_ids)""",
    "training_windows": f"""WITH {LETTERS}, {CLEAN_COUNTS}, {learned(MERGES)}, {SHARD_IDS},
seqs AS (SELECT shard_id, list(id ORDER BY row_index, i) AS t, count(*) AS n FROM shard_ids GROUP BY shard_id),
starts AS (SELECT shard_id, t, n, s FROM (SELECT shard_id, t, n, unnest(range(0, n, {STRIDE})) AS s FROM seqs)
  WHERE s + {WINDOW} <= n AND (s = 0 OR s - {STRIDE} + {WINDOW + 1} < n))
SELECT shard_id, CAST(s AS INTEGER) AS start_idx, {token_list(f"t[s + 1 : s + {WINDOW}]")} AS context,
       t[least(s + {WINDOW + 1}, n)] AS target FROM starts""",
    "ordered_token_csv_scan": f"""WITH {LETTERS}, {ONE_MERGE}
SELECT pos, word, {token_list(TOKENS.format(word="word", pair="pair"))} AS token_list
FROM ordered, best""",
    "word_count_csv_order": f"WITH {CLEAN_COUNTS} SELECT row_number() OVER (ORDER BY word) - 1 AS row_no, word FROM counts",
    "embedding_csv_order": """
SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row_no, CAST(vec_id AS VARCHAR) AS token_id FROM embeddings""",
    "embedding_csv_text_order": """
SELECT row_number() OVER (ORDER BY CAST(vec_id AS VARCHAR)) - 1 AS row_no, CAST(vec_id AS VARCHAR) AS token_id
FROM embeddings""",
    "ordered_token_csv_order": f"""WITH {LETTERS}
SELECT row_index AS row_no, CAST(pos AS VARCHAR) AS pos FROM ordered""",
    "embedding_csv_scan": f"""
SELECT CAST(vec_id AS VARCHAR) AS token_id, 'w' || vec_id AS word, CAST(i - 1 AS INTEGER) AS i,
       CAST(embedding[i] AS DOUBLE) AS x
FROM (SELECT vec_id, embedding, unnest(range(1, {DIM} + 1)) AS i FROM embeddings)""",
    "subword_roundtrip": f"WITH {WORDS} SELECT DISTINCT word, word AS text FROM words",
    "token_texts": f"""WITH {ONE_MERGE},
tokens AS (
  SELECT unnest({TOKENS.format(word="word", pair="pair")}) AS token_id, pair, frequency FROM counts, best)
SELECT CAST(token_id AS INTEGER) AS token_id, CASE WHEN token_id = 256 THEN pair ELSE chr(CAST(token_id AS INTEGER)) END AS word,
       CAST(sum(frequency) AS BIGINT) AS n
FROM tokens GROUP BY token_id, pair""",
}
