"""DuckDB SQL for the queries that SQL can express; op1, op3 and op8 are tested against brute force."""

from __future__ import annotations

from pickwise.llm.licenses import PHRASES, TEMPLATES, THRESHOLD
from pickwise.llm.lines import LEAST_SITES, SITE_SHARE

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = r"[^\x20\x09-\x0D]+"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(u, v) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
), comp AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT m.vec_id, (SELECT count(*) FROM links l WHERE l.u = m.vec_id) AS n_links,
       c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN comp c ON c.u = m.vec_id
"""


def _op4() -> str:
    marks = [(" " + phrase + " ", phrase.count(" ") + 1, label) for phrase, label in PHRASES.items()]
    phrases = ", ".join(f"({list(m.split())!r}, {n}, '{label}')" for m, n, label in marks)
    templates = ", ".join(f"({i}, '{label}', {sorted(set(text.split()))!r})" for i, (label, text) in enumerate(TEMPLATES))
    return f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all({_low('text')}, '{_ALNUM}') AS words FROM documents
), phrases(p, n, label) AS (VALUES {phrases}),
hits AS (
  SELECT doc_id, label, k FROM (
    SELECT doc_id, p, n, label, words, unnest(range(0, len(words) - n + 1)) AS k
    FROM w, phrases WHERE len(words) >= n)
  WHERE words[k + 1:k + n] = p
), base AS (
  SELECT doc_id, count(*) AS n_base, min(k) AS first_word, max(k) AS last_word,
         list_sort(list(DISTINCT label)) AS base FROM hits GROUP BY doc_id
), templates(t, label, words) AS (VALUES {templates}),
blocks AS (
  SELECT doc_id, list_distinct(regexp_extract_all(l, '{_ALNUM}')) AS b
  FROM (SELECT doc_id, unnest(string_split({_low('text')}, chr(10))) AS l FROM documents)
), found AS (
  SELECT doc_id, label, len(list_intersect(b, words)) / len(words) AS c FROM blocks, templates
  WHERE len(list_intersect(b, words)) >= ceil({THRESHOLD} * len(words) - 1e-9)
), more AS (SELECT doc_id, list(DISTINCT label) AS more, max(c) AS best FROM found GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       array_to_string(coalesce(base, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END, coalesce(best, 0.0))::DOUBLE AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


def _op5() -> str:
    def escaped(c: str) -> str:
        out = f"replace({c}, '\\', '\\\\')"
        for mark in ("<|", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>"):
            out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
        return out
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), o AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       sum(length({escaped('text')})
           + CASE WHEN before IS NULL OR before <> role THEN 16 + length({escaped('role')}) ELSE 8 END
           + CASE WHEN after IS NULL OR after <> role THEN 8 ELSE 0 END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""


OP6 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_low('text')}, '{_BLANK}') AS words FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS x
  FROM w WHERE len(words) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- equal sets are one class: only its smallest id is compared
class AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY digest) AS rep
  FROM (SELECT doc_id, md5(string_agg(x, chr(10) ORDER BY x)) AS digest FROM s GROUP BY doc_id)
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
  FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id
  WHERE a.doc_id IN (SELECT rep FROM class) AND b.doc_id IN (SELECT rep FROM class)
  GROUP BY ALL
), links AS (
  SELECT u, v FROM pairs JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
  WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(u, v) AS (
  SELECT DISTINCT rep, rep FROM class
  UNION
  SELECT r.u, e.v FROM reach r JOIN edges e ON e.u = r.v
), comp AS (SELECT u, min(v) AS c FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id) AS component_id,
       d.doc_id = coalesce(c, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN class ON class.doc_id = d.doc_id
LEFT JOIN comp ON comp.u = class.rep
"""

OP7 = rf"""
WITH i AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({_low('text')}, '{_ALNUM}') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item, n, array_to_string(words[k:k + n - 1], ' ') AS x
  FROM (SELECT item, words, least(13, len(words)) AS n, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS k
        FROM i WHERE len(words) > 0)
), d AS (
  SELECT doc_id, regexp_extract_all({_low('text')}, '{_ALNUM}') AS words FROM documents
), grams AS (
  SELECT doc_id, n, k, array_to_string(words[k:k + n - 1], ' ') AS x
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS k
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)
), hits AS (SELECT g.doc_id, g.n, g.k, w.item FROM grams g JOIN windows w ON w.n = g.n AND w.x = g.x),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP9 = f"""
WITH l AS (
  SELECT doc_id, coalesce(source, chr(0)) AS site, unnest(string_split(text, chr(10))) AS line,
         unnest(range(0, len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL
), k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
boiler AS (
  SELECT key, min({{'d': doc_id, 'p': pos}}) AS first FROM k WHERE key <> ''
  GROUP BY key HAVING count(DISTINCT site) >= (
    SELECT greatest({LEAST_SITES}, ceil({SITE_SHARE} * count(DISTINCT coalesce(source, chr(0))))) FROM documents)
), cut AS (
  SELECT k.doc_id, k.pos, k.line, boiler.key IS NOT NULL AND {{'d': doc_id, 'p': pos}} <> boiler.first AS gone
  FROM k LEFT JOIN boiler USING (key)
), done AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM cut GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, done.text
FROM documents d LEFT JOIN done USING (doc_id)
"""

OP10 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), q AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper FROM p),
bits AS (
  SELECT *, array_to_string(list_transform(string_split(hex, ''),
    lambda c: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
         [instr('0123456789abcdef', c)]), '') AS b
  FROM q
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(0, 5), lambda j: substr(b, 1 + 5 * i + j, 1)::INT * (16 >> j::INT)))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM bits
"""

OP11 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 10
"""

OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_low('text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs
  FROM (SELECT doc, lang, source, unnest(words) AS term FROM d) GROUP BY ALL
), kept AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
size AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
sums AS (SELECT lang, source, sum(c.n) AS n FROM c JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(sums.n, 0) AS total, coalesce(v, 0) AS v, coalesce(size.n, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN sums USING (lang, source) LEFT JOIN size USING (lang)
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (total + v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (lang_total + v) AS q
  FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200
"""

SQL: dict[str, str] = {
    "op2_embedding_dedup": OP2,
    "op4_licenses": _op4(),
    "op5_chat": _op5(),
    "op6_minhash": OP6,
    "op7_decontamination": OP7,
    "op9_line_dedup": OP9,
    "op10_warc": OP10,
    "op11_hard_negatives": OP11,
    "op12_source_divergence": OP12,
}
