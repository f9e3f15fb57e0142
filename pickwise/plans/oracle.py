"""DuckDB SQL giving the same results as the registered queries.

The SQL is written independently of the Spark code: raw self-joins where the
Spark plan pre-aggregates, plain cross products where it blocks. Views
``lineitem orders events part embeddings`` are the driver's tables.
"""

from __future__ import annotations

RATINGS_ORDERS = """
ratings AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS user_id,
         CAST(l.l_partkey AS INTEGER) AS product_id,
         CAST(1 + l.l_quantity % 5 AS DOUBLE) AS score,
         epoch_us(o.o_orderdate) // 1000000 AS time_stamp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

RATINGS_EVENTS = """
ratings AS (
  SELECT CAST(user_id AS INTEGER) AS user_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id,
         CAST(least(5, 1 + floor(value / 20)) AS DOUBLE) AS score,
         epoch_us(ts) // 1000000 AS time_stamp
  FROM events)"""

PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS INTEGER) AS product_id,
         p_name AS product_name,
         '' AS image_url,
         p_type AS categories,
         replace(p_name, ' ', '|') || '|' || p_brand || '|' || p_type AS tags
  FROM part)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# Co-occurrence over raw rating rows, self-pairs removed, as (p1, p2, sim).
_ITEM_SIM = """
cnt AS (SELECT product_id, count(*) AS n FROM ratings GROUP BY product_id),
rc AS (SELECT r.user_id, r.product_id, c.n FROM ratings r JOIN cnt c USING (product_id)),
co AS (
  SELECT a.product_id AS p1, b.product_id AS p2, count(*) AS n12,
         any_value(a.n) AS n1, any_value(b.n) AS n2
  FROM rc a JOIN rc b ON a.user_id = b.user_id AND a.product_id <> b.product_id
  GROUP BY 1, 2),
sim AS (SELECT p1, p2, n12 / sqrt(n1 * n2) AS s FROM co)"""

SQL: dict[str, str] = {}

SQL["rate_more_products"] = _with(RATINGS_ORDERS) + """
SELECT product_id, count(product_id) AS count FROM ratings GROUP BY product_id"""

SQL["rate_more_recently_products"] = _with(RATINGS_ORDERS) + """
SELECT CAST(year(make_timestamp(time_stamp * 1000000)) * 100
            + month(make_timestamp(time_stamp * 1000000)) AS BIGINT) AS year_month,
       product_id, count(product_id) AS count
FROM ratings GROUP BY 1, 2"""

SQL["average_products"] = _with(RATINGS_ORDERS) + """
SELECT product_id, round(avg(score), 6) AS avg FROM ratings GROUP BY product_id"""

SQL["load_products"] = _with(PRODUCTS) + """
SELECT product_id, product_name, image_url, categories, tags FROM products"""

SQL["load_ratings"] = _with(RATINGS_ORDERS) + """
SELECT user_id, product_id, score, time_stamp FROM ratings"""

SQL["item_cf_recs"] = _with(RATINGS_ORDERS, _ITEM_SIM) + """,
ranked AS (
  SELECT p1, p2, s, CAST(row_number() OVER (PARTITION BY p1 ORDER BY s DESC, p2) AS INTEGER) AS rk
  FROM sim)
SELECT p1 AS product_id, p2 AS rec_product_id, round(s, 6) AS score, rk AS rank
FROM ranked WHERE rk <= 10"""

SQL["item_similarity_events"] = _with(RATINGS_EVENTS, _ITEM_SIM) + """
SELECT p1 AS product_id, p2 AS rec_product_id, round(s, 6) AS score FROM sim WHERE s > 0.6"""

SQL["cosine_pairs_dense"] = """
WITH v AS (SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT id, e, sqrt(list_inner_product(e, e)) AS nrm FROM v),
p AS (
  SELECT a.id AS item_id, b.id AS other_item_id,
         list_inner_product(a.e, b.e) / (a.nrm * b.nrm) AS s
  FROM u a JOIN u b ON a.id <> b.id
  WHERE a.nrm > 0 AND b.nrm > 0)
SELECT item_id, other_item_id, round(s, 6) AS sim FROM p WHERE s > 0.4"""

_CONTENT_EXACT = _with(PRODUCTS) + """,
terms AS (
  SELECT product_id, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term
  FROM products),
tf AS (SELECT product_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
m AS (SELECT count(*) AS m FROM products),
w AS (SELECT tf.product_id, tf.term, tf.tf * ln((m.m + 1.0) / (df.df + 1.0)) AS w
      FROM tf JOIN df USING (term) CROSS JOIN m),
nz AS (SELECT * FROM w WHERE w > 0),
nrm AS (SELECT product_id, sqrt(sum(w * w)) AS n FROM nz GROUP BY 1),
dots AS (
  SELECT a.product_id AS p1, b.product_id AS p2, sum(a.w * b.w) AS d
  FROM nz a JOIN nz b ON a.term = b.term AND a.product_id <> b.product_id
  GROUP BY 1, 2)
SELECT p1 AS product_id, p2 AS rec_product_id, round(d / (n1.n * n2.n), 6) AS score
FROM dots JOIN nrm n1 ON n1.product_id = p1 JOIN nrm n2 ON n2.product_id = p2
WHERE d / (n1.n * n2.n) > 0.6"""

SQL["content_recs_exact"] = _CONTENT_EXACT

_STREAM = """
simt AS (SELECT p1, p2, s FROM sim WHERE s > 0.6),
batch AS (SELECT * FROM ratings WHERE time_stamp >= 1706486400),
trig AS (
  SELECT user_id, product_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id
                                 ORDER BY time_stamp DESC, product_id DESC, score DESC) AS rn
    FROM batch) WHERE rn = 1),
recents AS (
  SELECT user_id, product_id, score FROM (
    SELECT r.*, row_number() OVER (PARTITION BY user_id
                                   ORDER BY time_stamp DESC, product_id DESC, score DESC) AS rn
    FROM ratings r WHERE user_id IN (SELECT user_id FROM trig)) WHERE rn <= 20),
cand AS (
  SELECT user_id, product_id, s FROM (
    SELECT t.user_id, st.p2 AS product_id, st.s,
           row_number() OVER (PARTITION BY t.user_id ORDER BY st.s DESC, st.p2) AS rn
    FROM trig t JOIN simt st ON st.p1 = t.product_id
    WHERE st.p2 <> t.product_id
      AND NOT EXISTS (SELECT 1 FROM ratings r
                      WHERE r.user_id = t.user_id AND r.product_id = st.p2
                        AND r.time_stamp < 1706486400)) WHERE rn <= 20)"""

SQL["recent_ratings"] = _with(RATINGS_EVENTS, _ITEM_SIM, _STREAM) + """
SELECT user_id, product_id, score FROM recents"""

SQL["candidate_products"] = _with(RATINGS_EVENTS, _ITEM_SIM, _STREAM) + """
SELECT user_id, product_id, round(s, 6) AS sim FROM cand"""

SQL["stream_recs_batch"] = _with(RATINGS_EVENTS, _ITEM_SIM, _STREAM) + """,
sc AS (
  SELECT c.user_id, c.product_id, avg(st.s * r.score) AS base,
         count(*) FILTER (WHERE r.score > 3) AS incr,
         count(*) FILTER (WHERE NOT (r.score > 3)) AS decr
  FROM cand c JOIN recents r ON r.user_id = c.user_id
  JOIN simt st ON st.p1 = r.product_id AND st.p2 = c.product_id
  GROUP BY 1, 2)
SELECT user_id, product_id,
       round(base + log10(greatest(1, incr)) - log10(greatest(1, decr)), 6) AS score
FROM sc"""

# One micro-batch of the streaming job equals the batch function.
SQL["stream_recs"] = SQL["stream_recs_batch"]


# ---- HashingTF buckets in SQL: Murmur3 x86_32 (seed 42) of the term's UTF-8
# bytes, non-negative mod the width. 32-bit words are BIGINT masked to 32
# bits; products go through HUGEINT. Fixed values of the hash:
# c1 = 0xcc9e2d51, c2 = 0x1b873593, body add 0xe6546b64, fmix multipliers
# 0x85ebca6b and 0xc2b2ae35, rotations 15 and 13, fmix shifts 16, 13, 16.
_M32 = 1 << 32


def _mul32(a: str, c: int) -> str:
    return f"(CAST((CAST({a} AS HUGEINT) * {c}) % {_M32} AS BIGINT))"


def _rotl32(x: str, r: int) -> str:
    return f"(((({x}) << {r}) | (({x}) >> {32 - r})) & {_M32 - 1})"


def _mix32(k: str) -> str:
    return f"({_mul32(_rotl32(_mul32(k, 0xcc9e2d51), 15), 0x1b873593)})"


def hashed_terms_sql(width: int) -> str:
    """CTEs ending in hashed(term, dim) over the distinct terms of ``terms``."""
    nib = "strpos('0123456789ABCDEF', substr(hx, {p}, 1)) - 1"
    byte = f"({nib.format(p='2 * i + 1')}) * 16 + {nib.format(p='2 * i + 2')}"
    return f"""
vocab AS (SELECT DISTINCT term, hex(encode(term)) AS hx FROM terms),
hb AS (SELECT term, length(hx) // 2 AS n,
              list_transform(range(0, length(hx) // 2), lambda i: CAST({byte} AS BIGINT)) AS b
       FROM vocab),
hk AS (SELECT term, b, n, n // 4 AS nb,
              list_transform(range(0, n // 4), lambda i: b[4 * i + 1] + b[4 * i + 2] * 256
                                                         + b[4 * i + 3] * 65536
                                                         + b[4 * i + 4] * 16777216) AS ks
       FROM hb),
hbody AS (
  SELECT term, n,
         list_reduce(list_concat([CAST(42 AS BIGINT)], list_transform(ks, lambda kk: {_mix32('kk')})),
                     lambda h, m: ({_rotl32('xor(h, m)', 13)} * 5 + {0xe6546b64}) % {_M32}) AS h,
         list_reduce(list_concat([CAST(0 AS BIGINT)],
                                 list_transform(range(0, n % 4),
                                                lambda j: b[4 * nb + j + 1] << (8 * j))),
                     lambda acc, x: acc | x) AS tk
  FROM hk),
hf AS (SELECT term, xor(xor(h, {_mix32('tk')}), n) AS h FROM hbody),
hf2 AS (SELECT term, {_mul32('xor(h, h >> 16)', 0x85ebca6b)} AS h FROM hf),
hf3 AS (SELECT term, {_mul32('xor(h, h >> 13)', 0xc2b2ae35)} AS h FROM hf2),
hs AS (SELECT term, xor(h, h >> 16) AS h FROM hf3),
hashed AS (
  SELECT term, CAST(((CASE WHEN h >= {1 << 31} THEN h - {_M32} ELSE h END) % {width} + {width})
                    % {width} AS INTEGER) AS dim
  FROM hs)"""


_CONTENT_HASHED = _with(PRODUCTS) + """,
terms AS (
  SELECT product_id, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term
  FROM products),""" + hashed_terms_sql(800) + """,
tf AS (SELECT t.product_id, h.dim, count(*) AS tf FROM terms t JOIN hashed h USING (term) GROUP BY 1, 2),
df AS (SELECT dim, count(*) AS df FROM tf GROUP BY 1),
m AS (SELECT count(*) AS m FROM products),
w AS (SELECT tf.product_id, tf.dim, tf.tf * ln((m.m + 1.0) / (df.df + 1.0)) AS w
      FROM tf JOIN df USING (dim) CROSS JOIN m),
nz AS (SELECT * FROM w WHERE w > 0),
nrm AS (SELECT product_id, sqrt(sum(w * w)) AS n FROM nz GROUP BY 1),
dots AS (
  SELECT a.product_id AS p1, b.product_id AS p2, sum(a.w * b.w) AS d
  FROM nz a JOIN nz b ON a.dim = b.dim AND a.product_id <> b.product_id
  GROUP BY 1, 2)
SELECT p1 AS product_id, p2 AS rec_product_id, round(d / (n1.n * n2.n), 6) AS score
FROM dots JOIN nrm n1 ON n1.product_id = p1 JOIN nrm n2 ON n2.product_id = p2
WHERE d / (n1.n * n2.n) > 0.6"""

SQL["content_recs"] = _CONTENT_HASHED

# Recommendation lists of a fitted model are checked by their properties: every
# user has a full list, ranked, positive, and scored by the factors' dot product.
SQL["als_user_recs_check"] = """
SELECT DISTINCT CAST(o.o_custkey AS INTEGER) AS user_id, 20 AS n_recs, true AS ranked, true AS positive, true AS scored, true AS complete
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

SQL["als_product_recs_check"] = """
SELECT DISTINCT CAST(l.l_partkey AS INTEGER) AS product_id, true AS symmetric, true AS above, true AS no_self, true AS scored, true AS complete
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

SQL["rmse_product_mean"] = _with(RATINGS_ORDERS) + """,
p AS (SELECT score, avg(score) OVER (PARTITION BY product_id) AS prediction FROM ratings)
SELECT round(sqrt(avg((score - prediction) * (score - prediction))), 6) AS rmse, count(*) AS n FROM p"""

SQL["als_tune_grid"] = """
SELECT rank, CAST(reg AS DOUBLE) AS reg, true AS finite, true AS best_first
FROM (VALUES (100), (200), (250)) r(rank), (VALUES (1.0), (0.1), (0.01), (0.001)) g(reg)"""

SQL["load_products_file"] = SQL["load_products"]
SQL["load_ratings_file"] = SQL["load_ratings"]
SQL["table_roundtrip"] = SQL["rate_more_products"]

SQL["candidate_products_bitmap"] = SQL["candidate_products"]


def _stream_batch(n: int, start: int, end: int | None) -> str:
    """CTE recs<n>: scores of one micro-batch [start, end), with all earlier ratings as history."""
    upto = "" if end is None else f" AND time_stamp < {end}"
    return f"""
batch{n} AS (SELECT * FROM ratings WHERE time_stamp >= {start}{upto}),
trig{n} AS (
  SELECT user_id, product_id FROM batch{n}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, product_id DESC, score DESC) = 1),
recents{n} AS (
  SELECT user_id, product_id, score FROM ratings
  WHERE user_id IN (SELECT user_id FROM trig{n}){upto}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, product_id DESC, score DESC) <= 20),
cand{n} AS (
  SELECT t.user_id, st.p2 AS product_id FROM trig{n} t JOIN simt st ON st.p1 = t.product_id
  WHERE st.p2 <> t.product_id
    AND NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = t.user_id AND r.product_id = st.p2
                    AND r.time_stamp < {start})
  QUALIFY row_number() OVER (PARTITION BY t.user_id ORDER BY st.s DESC, st.p2) <= 20),
recs{n} AS (
  SELECT c.user_id, c.product_id,
         round(avg(st.s * r.score) + log10(greatest(1, count(*) FILTER (WHERE r.score > 3)))
               - log10(greatest(1, count(*) FILTER (WHERE NOT (r.score > 3)))), 6) AS score
  FROM cand{n} c JOIN recents{n} r ON r.user_id = c.user_id
  JOIN simt st ON st.p1 = r.product_id AND st.p2 = c.product_id
  GROUP BY 1, 2)"""


_STARTS = (1706486400, 1706486400 + 43200, 1706486400 + 86400)
# a user's list is that of the last batch with a rating of the user, even an empty one
SQL["stream_recs_restarts"] = _with(
    RATINGS_EVENTS, _ITEM_SIM, "simt AS (SELECT p1, p2, s FROM sim WHERE s > 0.6)",
    *[_stream_batch(n, start, end) for n, (start, end) in enumerate(zip(_STARTS, (*_STARTS[1:], None)))]) + """
SELECT * FROM recs2
UNION ALL SELECT * FROM recs1 WHERE user_id NOT IN (SELECT user_id FROM trig2)
UNION ALL SELECT * FROM recs0 WHERE user_id NOT IN (SELECT user_id FROM trig1 UNION ALL SELECT user_id FROM trig2)"""

SQL["content_topk"] = _CONTENT_EXACT.replace("SELECT p1 AS product_id", "SELECT * FROM (SELECT p1 AS product_id")
SQL["content_topk"] = SQL["content_topk"].replace(
    "AS score\nFROM dots", "AS score,\n  CAST(row_number() OVER (PARTITION BY p1 ORDER BY round(d / (n1.n * n2.n), 9) DESC, p2) AS INTEGER) AS rank\nFROM dots"
) + ") WHERE rank <= 20"

SQL["item_cf_recs_dedupe"] = SQL["item_cf_recs"].replace(
    RATINGS_ORDERS, RATINGS_ORDERS.replace("ratings AS (", "every AS (") + """,
ratings AS (SELECT DISTINCT user_id, product_id FROM every)""")

SQL["cosine_pairs_sparse"] = """
WITH w AS (
  SELECT CAST(o_custkey AS INTEGER) AS u, l_partkey AS d, sum(l_quantity) AS w
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
n AS (SELECT u, sqrt(sum(w * w)) AS n FROM w GROUP BY 1),
dots AS (SELECT a.u AS u1, b.u AS u2, sum(a.w * b.w) AS dot FROM w a JOIN w b ON a.d = b.d AND a.u <> b.u GROUP BY 1, 2)
SELECT u1 AS user_id, u2 AS other_user_id, round(dot / (n1.n * n2.n), 6) AS sim
FROM dots JOIN n n1 ON n1.u = u1 JOIN n n2 ON n2.u = u2 WHERE dot / (n1.n * n2.n) > 0.1"""

_LISTS = SQL["content_recs_exact"].replace("SELECT p1 AS product_id, p2 AS rec_product_id, round(d / (n1.n * n2.n), 6) AS score", """
SELECT p1 AS product_id, p2 AS rec_product_id, round(d / (n1.n * n2.n), 6) AS score,
       CAST(row_number() OVER (PARTITION BY p1 ORDER BY round(d / (n1.n * n2.n), 9) DESC, p2) - 1 AS INTEGER) AS place""")
SQL["content_recs_nested"] = f"""
SELECT product_id, place // 50 AS part, CAST(count(*) OVER (PARTITION BY product_id, place // 50) AS INTEGER) AS n,
       place % 50 AS at, rec_product_id, score FROM ({_LISTS})"""
