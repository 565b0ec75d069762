"""SQL of the queries, for DuckDB: plain forms of the same results."""

from __future__ import annotations

from obsloom.llm.common import LOWER, UPPER
from obsloom.llm.mixing import TOPICS
from obsloom.llm import quality
from obsloom.llm.urls import ALLOW, ALPHABET, BLOCK

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"'[^\x20\x09-\x0D]+'"


def lowered(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (SELECT *, {lowered(f"trim(line, {BLANKS})")} AS key FROM lines),
heavy AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE owner IS NOT NULL AND owner <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN heavy USING (key) GROUP BY doc_id
"""


def url_filter(rules, order: int = 4, prior: float = 5.0, folds: int = 5, width: float = 0.01) -> str:
    fits = {
        rule: f"((host = '{rule.partition('/')[0]}' OR ends_with(host, '.{rule.partition('/')[0]}')) "
        f"AND starts_with(path, '/{rule.partition('/')[2]}'))"
        for _, rule in rules
    }
    longest = sorted(rules, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {fits[r]} THEN '{r}'" for _, r in longest)
    says = " ".join(f"WHEN {fits[r]} THEN '{v}'" for v, r in longest)
    pattern = r"'://([^/?#]*)([^?#]*)'"
    levels, odds = "", {"a": f"{1 / ALPHABET}", "b": f"{1 / ALPHABET}"}
    for k in range(order + 1):
        levels += "".join(
            f", sum({m}) OVER (PARTITION BY substr(gram, {order + 1 - k}, {k + 1})) AS n{m}{k}, "
            f"sum({m}) OVER (PARTITION BY substr(gram, {order + 1 - k}, {k})) AS c{m}{k}"
            for m in "ab"
        )
        odds = {m: f"((n{m}{k} + {prior} * {odds[m]}) / (c{m}{k} + {prior}))" for m in "ab"}
    return rf"""
WITH parts AS (
  SELECT page_id, {lowered(f"regexp_extract(coalesce(url, ''), {pattern}, 1)")} AS host,
    regexp_extract(coalesce(url, ''), {pattern}, 2) AS path, {lowered("coalesce(url, '')")} AS u
  FROM pages
), ruled AS (
  SELECT *, CASE {rule} END AS rule, CASE {says} END AS says, CAST('0x' || substr(md5(u), 1, 4) AS BIGINT) % {folds} AS fold FROM parts
), grams AS (
  SELECT u, says, fold, unnest(list_transform(range(1, length(u) + 2),
    lambda i: substr(repeat(chr(2), {order}) || u || chr(3), CAST(i AS BIGINT), {order + 1}))) AS gram
  FROM ruled
), counts AS (
  SELECT gram, count(*) FILTER (WHERE fold <> 0 AND says = '{ALLOW}') AS a, count(*) FILTER (WHERE fold <> 0 AND says = '{BLOCK}') AS b
  FROM grams GROUP BY gram
), levels AS (SELECT gram{levels} FROM counts),
model AS (SELECT gram, ln({odds["a"]}) - ln({odds["b"]}) AS s FROM levels),
scored AS (SELECT u, avg(s) AS score FROM grams JOIN model USING (gram) GROUP BY u),
bins AS (
  SELECT CAST(floor(round(score / {width}, 4)) AS BIGINT) AS bin, count(*) FILTER (WHERE says = '{ALLOW}') AS a,
    count(*) FILTER (WHERE says = '{BLOCK}') AS b
  FROM ruled JOIN scored USING (u) WHERE fold = 0 AND says IS NOT NULL GROUP BY 1
), edges AS (
  SELECT bin, coalesce(sum(a) OVER below, 0) AS lost, coalesce(sum(b) OVER below, 0) AS caught, sum(a) OVER () AS a, sum(b) OVER () AS b
  FROM bins WINDOW below AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), best AS (
  SELECT bin * {width} AS t FROM edges WHERE a > 0 AND b > 0 ORDER BY round(lost / a - caught / b, 9), abs(bin), bin LIMIT 1
)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN round(score, 9) >= coalesce((SELECT t FROM best), 0.0)
  THEN '{ALLOW}' ELSE '{BLOCK}' END) AS verdict, round(score, 6) + 0.0 AS score
FROM ruled JOIN scored USING (u)
"""


def _mix(power: float = 0.7, keep_share: float = 0.7, sweeps: int = 6) -> str:
    topic = " ".join(f"WHEN regexp_matches(t, '{pattern}') THEN '{name}'" for name, pattern in TOPICS)
    margins = ("source", "lang", "topic")
    shares = ", ".join(
        f"target_{m} AS (SELECT {m}, pow(tokens, {power}) / sum(pow(tokens, {power})) OVER () AS target "
        f"FROM (SELECT {m}, sum(tokens) AS tokens FROM cells GROUP BY {m}) WHERE tokens > 0)"
        for m in margins
    )
    steps, last = "", "raked_0"
    for i in range(sweeps):
        for j, m in enumerate(margins):
            now = f"raked_{i * 3 + j + 1}"
            steps += (
                f", {now} AS MATERIALIZED (SELECT source, lang, topic, tokens, CASE WHEN sum(w) OVER (PARTITION BY {m}) > 0 THEN "
                f"w * (coalesce(target, 0.0) / sum(w) OVER (PARTITION BY {m})) ELSE 0.0 END AS w FROM {last} LEFT JOIN target_{m} USING ({m}))"
            )
            last = now
    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, CASE {topic} ELSE 'general' END AS topic,
    CAST(len(regexp_extract_all(t, {WORDS})) AS BIGINT) AS n
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
), cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n) AS BIGINT) AS tokens FROM docs GROUP BY 1, 2, 3),
{shares}, raked_0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS w FROM cells){steps},
rates AS MATERIALIZED (
  SELECT source, lang, topic, tokens, CASE WHEN tokens > 0 THEN w * (SELECT sum(tokens) FROM cells) / tokens ELSE 1.0 END AS rate FROM {last}
), kinks AS (
  -- With the factor at 1 / rate of a cell, that cell and those of higher rates are kept whole.
  SELECT rate, sum(tokens) OVER up AS whole, coalesce(sum(tokens * rate) OVER down, 0) AS part
  FROM rates WHERE tokens > 0 AND rate > 0
  WINDOW up AS (ORDER BY rate DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    down AS (ORDER BY rate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), wanted AS (SELECT {keep_share} * sum(tokens) AS x, sum(tokens * rate) AS slope FROM rates WHERE tokens > 0),
below AS (
  SELECT DISTINCT rate, whole, (SELECT sum(tokens * rate) FROM rates r WHERE r.rate < kinks.rate AND r.tokens > 0) AS slope FROM kinks
), chosen AS (
  SELECT coalesce(
    (SELECT min(((SELECT x FROM wanted) - whole) / slope) FROM below
      WHERE whole + coalesce(slope, 0) / rate <= (SELECT x FROM wanted)
        AND rate = (SELECT min(rate) FROM below WHERE whole + coalesce(slope, 0) / rate <= (SELECT x FROM wanted))),
    (SELECT x / slope FROM wanted)) AS factor
)
SELECT doc_id, topic, n AS n_tokens, round(rate, 5) AS weight, round(least(1.0, rate * (SELECT factor FROM chosen)), 5) AS probability,
  CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) / 281474976710656.0 < rate * (SELECT factor FROM chosen) AS kept
FROM docs JOIN rates USING (source, lang, topic)
"""


MIX = _mix()


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _quality() -> str:
    phrases = " OR ".join(f"contains(lower(line), {_quoted(p)})" for p in quality.PHRASES)
    blank = r"'[\x20\x09-\x0D]'"
    counted = lambda of, chars: f"length({of}) - length(translate({of}, {_quoted(chars)}, ''))"
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT doc_id, unnest(regexp_extract_all(t, {WORDS})) AS w, unnest(range(len(regexp_extract_all(t, {WORDS})))) AS pos FROM docs
), threes AS (
  SELECT doc_id, pos, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), again AS (
  SELECT doc_id, pos, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS twice FROM threes
), covered AS (
  SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM again
), repeats AS (SELECT doc_id, count(*) FILTER (WHERE hit) AS n_repeat_words FROM covered GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM docs
), sized AS (
  SELECT *, len(regexp_extract_all(line, {WORDS})) AS n, length(regexp_replace(line, {blank}, '', 'g')) AS size,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS again
  FROM lines
), failed AS (
  SELECT *, n > 0 AND (again
    OR (NOT contains({_quoted(quality.TERMINAL)}, right(trim(line, {BLANKS}), 1))
      AND {quality.SENTENCE_WORDS} * ({counted("line", quality.SENTENCE_ENDS)}) < n)
    OR 4 * len(regexp_extract_all(line, {_quoted(quality.MARKS)})) > n
    OR 4 * ({counted("line", quality.SEPARATORS)}) > n
    OR (n <= {quality.PHRASE_WORDS} AND ({phrases}))) AS fails
  FROM sized
), sums AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_words, CAST(sum(size) AS BIGINT) AS word_chars,
    count(*) FILTER (WHERE n > 0 AND again) AS n_dup_lines, CAST(coalesce(sum(size) FILTER (WHERE fails), 0) AS BIGINT) AS lost_chars
  FROM failed GROUP BY doc_id
), base AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed
  FROM (SELECT sums.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM sums LEFT JOIN repeats USING (doc_id))
)
SELECT doc_id, n_words, word_chars, CAST({counted("t", quality.SYMBOLS)} AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost_chars <= {quality.MAX_LOST} * word_chars AS kept, lost_chars
FROM base JOIN docs USING (doc_id)
"""


QUALITY = _quality()


def usable(vector: str = "embedding") -> str:
    return f"{vector} IS NOT NULL AND len(list_filter({vector}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def whole(scale: int, vector: str = "embedding") -> str:
    return f"list_transform({vector}, lambda x: floor({scale} * CAST(x AS DOUBLE)))"


def centroids(k: int = 16, size: int = 64, rounds: int = 3, scale: int = 64, seed: int = 1) -> str:
    """Every distance measured, in every round."""
    sql = f"""
WITH q AS MATERIALIZED (
  SELECT vec_id, {whole(scale)} AS v FROM embeddings WHERE len(embedding) = {size} AND {usable()}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v FROM q ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}
)"""
    for r in range(rounds + 1):
        sql += f""", a{r} AS MATERIALIZED (
  SELECT vec_id, v, unnest(arg_min(struct_pack(c := c, d := d), (d, c))) FROM (
    SELECT vec_id, q.v, c, list_sum(list_transform(list_zip(q.v, k.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d FROM q, c{r} k
  ) GROUP BY vec_id, v
)"""
        if r < rounds:
            sql += f""", c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
    SELECT c, list(mean ORDER BY place) AS v FROM (
      SELECT c, place, floor(sum(x) / count(*)) AS mean FROM (SELECT c, unnest(v) AS x, unnest(range(1, {size + 1})) AS place FROM a{r}) GROUP BY c, place
    ) GROUP BY c
  ) m ON m.c = c{r}.c
)"""
    return f"""{sql}
SELECT vec_id, CAST(a{rounds}.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(k.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} k ON k.c = a{rounds}.c
"""


WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY h) AS head,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS BIGINT) + 1, 1)), 'string_agg', '') AS digest
  FROM p
)
SELECT page_id, payload_bytes, digest AS payload_digest, CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN head <> page_id THEN head END AS refers_to
FROM d
"""

HARD_NEGATIVES = f"""
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {whole(256)} AS v
  FROM embeddings WHERE label IS NOT NULL AND {usable()}
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a, r b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.other AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) <= 3
"""
