"""SQL for DuckDB that gives the same rows as the queries it can express."""

from __future__ import annotations

from monsoon.llm import codes, lines, mixing, rules, topk, warc

WORD = r"[^\x20\x09-\x0D]+"


def _number(hex_digits: str) -> str:
    return f"('0x' || {hex_digits})::BIGINT"


TOPK = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {topk.SCALE})) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT vec_id, min(vector) AS vector FROM vectors WHERE vec_id % {topk.EVERY} = 0 GROUP BY 1),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
  FROM asked q JOIN vectors c ON q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {topk.K}
"""

_DIGITS = " || ".join(
    f"substr('{warc.BASE32}', 1 + ((({_number(f'substr(h, {i // 4 * 5 + 1}, 5)')}) >> {15 - 5 * (i % 4)}) & 31)::INT, 1)"
    for i in range(32)
)

WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM w
"""

_RULES = [(rule, a, b, c) for rule, (a, b, grid) in rules.RULES.items() for c in grid]
_COUNTS = "\nUNION ALL ".join(
    f"SELECT stratum, '{rule}' AS rule, {c} AS cutoff, count(*) AS n, "
    f"count(*) FILTER (WHERE {b} > 0 AND {a} / {b} > {c}) AS k FROM good GROUP BY stratum"
    for rule, a, b, c in _RULES
)
_SHARE = rules.RISK / len(rules.RULES)
_REJECTED = " OR ".join(
    f"coalesce({b} > 0 AND {a} / {b} > (SELECT min(cutoff) FROM passed p "
    f"WHERE p.stratum = m.stratum AND p.rule = '{rule}'), false)"
    for rule, (a, b, _) in rules.RULES.items()
)

RULES = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS text
  FROM documents),
split AS (
  SELECT r, regexp_extract_all(text, '{WORD}') AS words, string_split(text, chr(10)) AS lines FROM texts),
windows AS (
  SELECT r, i, array_to_string(words[i:i + {rules.SPAN - 1}], ' ') AS body
  FROM split, unnest(range(1, len(words) - {rules.SPAN} + 2)) AS t(i)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, body) AS times FROM windows),
repeated AS (
  SELECT r, count(DISTINCT i + d) AS n FROM twice, range({rules.SPAN}) AS s(d) WHERE times > 1 GROUP BY r),
m AS (
  SELECT r, doc_id, stratum, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(list_filter(lines, lambda l: regexp_matches(l, '{WORD}')))::BIGINT AS n_lines,
    (len(list_filter(lines, lambda l: regexp_matches(l, '{WORD}')))
      - len(list_distinct(list_filter(lines, lambda l: regexp_matches(l, '{WORD}')))))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM texts JOIN split USING (r) LEFT JOIN repeated USING (r)),
base AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM m),
good AS (
  SELECT * FROM base WHERE NOT base_failed AND doc_id IN (
    SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)),
counts AS ({_COUNTS}),
tails AS (
  SELECT *, (
    SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_SHARE}) + (n - i) * ln(1 - {_SHARE})))
    FROM range(k + 1) AS s(i)) AS tail
  FROM counts),
passed AS (
  SELECT * FROM tails
  WHERE k < n * {_SHARE} AND tail <= {rules.ERROR} / ({len(_RULES)} * (SELECT count(DISTINCT stratum) FROM good)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({_REJECTED}) AS kept,
  {", ".join(f"(SELECT min(cutoff) FROM passed p WHERE p.stratum = m.stratum AND p.rule = '{r}')::DOUBLE AS cut_{r}" for r in rules.RULES)}
FROM base m
"""


def _apportioned(source: str, group: str, order: str, claim: str, seats: str, out: str) -> str:
    """Sainte-Lague by listing every quotient that could win."""
    return f"""
    SELECT s.*, coalesce(won, 0) AS {out} FROM {source} s LEFT JOIN (
      SELECT {group} AS g, {order} AS o, count(*) AS won FROM (
        SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {claim} / (2 * k + 1) DESC, {order}, k) AS place
        FROM {source}, range({seats}) AS t(k))
      WHERE place <= {seats} GROUP BY ALL) w
    ON w.g = s.{group} AND w.o = s.{order}"""


_W = ", ".join(f"{w}.0" for w in mixing.WEIGHTS)

MIXING = f"""
WITH sized AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS party,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '~') || ':' || coalesce(text, '~')) AS key
  FROM documents),
sources AS (
  SELECT 1 AS one, party, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
    ([{_W}])[1 + (row_number() OVER (ORDER BY party = '', party) - 1) % {len(mixing.WEIGHTS)}]::DOUBLE AS weight
  FROM sized GROUP BY party),
levels AS (
  SELECT *, {mixing.MOST} * source_size::DOUBLE AS cap,
    (sum(source_size) OVER () * {mixing.SHARE}::DOUBLE - coalesce(sum({mixing.MOST} * source_size::DOUBLE) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (rising ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW rising AS (ORDER BY {mixing.MOST} * source_size::DOUBLE / weight, party)),
aimed AS (
  SELECT *, CASE WHEN cap / weight > level
    THEN weight * max(level) FILTER (WHERE cap / weight > level) OVER () ELSE cap END AS target,
    least({mixing.MAX_SHARDS}, ceil((source_size + n_rows * {mixing.ROW_WORDS}) / {mixing.SHARD_WORDS}))::BIGINT AS shards
  FROM levels),
summed AS (SELECT *, round(sum(target) OVER () / {mixing.BLOCK})::BIGINT AS all_blocks FROM aimed),
seated AS ({_apportioned("summed", "one", "party", "target", "all_blocks", "blocks")}),
dealt AS (
  SELECT r, doc_id, party, size, key, source_size, target, blocks,
    {_number("substr(key, 1, 8)")} % shards AS shard
  FROM sized JOIN seated USING (party)),
shards AS (
  SELECT party, shard, sum(size)::BIGINT AS words, max(blocks) AS blocks,
    greatest(1, round(sum(size) / {mixing.BLOCK}))::BIGINT AS has
  FROM dealt GROUP BY ALL HAVING sum(size) > 0),
due AS (SELECT *, least(blocks, {mixing.MOST} * sum(has) OVER (PARTITION BY party))::BIGINT AS due FROM shards),
given AS ({_apportioned("due", "party", "shard", "has", "due", "quota0")}),
runs AS (
  SELECT *, least(quota0, has * {mixing.MOST}) AS quota,
    {_number(f"substr(md5('{mixing.SEED}:' || party || ':' || shard::VARCHAR), 1, 8)")} % has AS run
  FROM given),
placed AS (
  SELECT d.*, words, quota // has AS rounds, run * words // has AS a,
    least(run + quota % has, has) * words // has AS b,
    greatest(run + quota % has - has, 0) * words // has AS c,
    sum(size) OVER (PARTITION BY d.party, d.shard ORDER BY key, doc_id, size, r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS stop
  FROM dealt d LEFT JOIN runs USING (party, shard))
SELECT doc_id, size, source_size, target::DOUBLE AS target,
  (CASE WHEN words IS NULL THEN 0 ELSE rounds * size
    + greatest(least(b, stop) - greatest(a, stop - size), 0)
    + greatest(least(c, stop) - (stop - size), 0) END)::BIGINT AS taken
FROM placed
"""

_ROLLED = "0"
for _back in reversed(range(lines.WINDOW)):
    _ROLLED = f"(({_ROLLED}) * {lines.BASE} + coalesce(lag(h, {_back}) OVER w, 0))"

LINES = f"""
WITH docs AS (
  SELECT doc_id, text, md5(coalesce(doc_id::VARCHAR, '~') || ':' || coalesce(text, '~')) AS row_key,
    row_number() OVER () AS r FROM documents),
lines AS (
  SELECT r, i, line, {_number("substr(md5(line), 1, 7)")} AS h
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)),
cut AS (
  SELECT *, ({_ROLLED} % {lines.MODULUS}) % {lines.DIVISOR} = 0
    AND count(*) OVER (PARTITION BY r) - i >= {lines.MIN_LINES} AS may FROM lines WINDOW w AS (PARTITION BY r ORDER BY i)),
flags AS (
  SELECT r, regexp_replace(string_agg(CASE WHEN may THEN '1' ELSE '0' END, '' ORDER BY i),
    '(.{{{lines.MIN_LINES - 1}}}0*)1', '\\1e', 'g') AS flags FROM cut GROUP BY r),
ended AS (SELECT cut.*, substr(flags, i, 1) = 'e' AS ends FROM cut JOIN flags USING (r)),
numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM ended),
chunks AS (
  SELECT r, chunk, min(i) AS start, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY ALL),
places AS (
  SELECT c.*, row_key, count(*) OVER (PARTITION BY body) AS times,
    dense_rank() OVER (PARTITION BY body ORDER BY doc_id IS NULL, doc_id, row_key, start) AS place
  FROM chunks c JOIN docs USING (r)
  WHERE n >= {lines.MIN_LINES} AND regexp_matches(body, '{WORD}')),
gone AS (SELECT DISTINCT row_key, start, n FROM places WHERE place > 1),
kept AS (
  SELECT r, string_agg(body, chr(10) ORDER BY c.start) FILTER (WHERE g.start IS NULL) AS body,
    count(g.start) AS n_chunks, coalesce(sum(g.n), 0) AS n_lines
  FROM chunks c JOIN docs d USING (r) LEFT JOIN gone g ON g.row_key = d.row_key AND g.start = c.start GROUP BY r)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(k.body, '') END AS text,
  coalesce(n_chunks, 0)::BIGINT AS n_chunks_removed, coalesce(n_lines, 0)::BIGINT AS n_lines_removed
FROM docs LEFT JOIN kept k USING (r)
"""


_INNER = "list_inner_product({}.part, {}.part)"
_ROUNDS = "".join(
    f"""
a{i} AS MATERIALIZED ({{assigned}}),
c{i + 1} AS MATERIALIZED (
  SELECT c.p, c.entry, coalesce(s.part, c.part) AS part FROM c{i} c LEFT JOIN (
    SELECT p, entry, list(mean ORDER BY k) AS part FROM (
      SELECT p, entry, k, floor(sum(part[k]) / count(*)) AS mean
      FROM a{i} JOIN parts USING (r, p), size, range(1, size + 1) AS s(k) GROUP BY ALL) GROUP BY ALL) s
  USING (p, entry)),""".replace("{assigned}", f"""
  SELECT x.r, x.p, min(({_INNER.format("x", "x")} - 2 * {_INNER.format("x", "c")} + {_INNER.format("c", "c")})::BIGINT
      * {codes.ENTRIES} + c.entry) % {codes.ENTRIES} AS entry
  FROM parts x JOIN c{i} c USING (p) GROUP BY ALL""")
    for i in range(codes.ROUNDS)
)

CODES = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * {codes.SCALE})) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS MATERIALIZED (SELECT max(len(v)) // {codes.POSITIONS} AS size FROM kept),
parts AS MATERIALIZED (
  SELECT r, p, v[p * size + 1:(p + 1) * size] AS part FROM kept, size, range({codes.POSITIONS}) AS s(p)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS entry, part FROM parts WHERE r <= {codes.ENTRIES}),{_ROUNDS}
final AS MATERIALIZED (
  SELECT x.r, x.p, min(({_INNER.format("x", "x")} - 2 * {_INNER.format("x", "c")} + {_INNER.format("c", "c")})::BIGINT
      * {codes.ENTRIES} + c.entry) AS best
  FROM parts x JOIN c{codes.ROUNDS} c USING (p) GROUP BY ALL),
coded AS (
  SELECT r, string_agg(printf('%02x', best % {codes.ENTRIES}), '' ORDER BY p) AS code,
    sum(best // {codes.ENTRIES})::BIGINT AS error FROM final GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(part[k]::BIGINT::VARCHAR, ',' ORDER BY p, entry, k))
   FROM c{codes.ROUNDS}, size, range(1, size + 1) AS s(k)) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


def statements() -> dict[str, str]:
    return {
        "op1_mixing": MIXING,
        "op3_line_dedup": LINES,
        "op4_warc": WARC,
        "op7_topk": TOPK,
        "op9_rules": RULES,
        "op13_codes": CODES,
    }
