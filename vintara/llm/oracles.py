"""What the queries of this subpackage return, as DuckDB SQL, where SQL can state it."""

OP2 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t
  FROM documents),
g AS (
  SELECT t, count(*) AS group_size, first(doc_id ORDER BY n DESC, doc_id) AS keep_id FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

# The fixed alphabet of base32.
OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (SELECT payload, max(page_id) AS keep_id FROM p GROUP BY payload),
d AS (
  SELECT p.page_id, p.payload, g.keep_id, unhex(sha1(p.payload))::BIT::VARCHAR AS bits
  FROM p JOIN g USING (payload))
SELECT page_id, octet_length(payload) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(
         [substr(bits, 5 * k + j + 1, 1)::BIGINT * (16 >> j::INT) for j in range(5)])::BIGINT, 1)
         for k in range(32)], '') AS payload_digest,
       CASE WHEN page_id = keep_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep_id THEN keep_id END AS refers_to
FROM d
"""



_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _share(count: str, total: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({count} + 2) // ({total} + 2 * v))::BIGINT"


OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
o AS (
  SELECT doc, lang, source, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
l AS (
  SELECT d.lang, coalesce(any_value(v), 0) AS v, coalesce(any_value(n), 0) AS n FROM d
  LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang) USING (lang) GROUP BY d.lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (
  SELECT d.lang, d.source, coalesce(any_value(n), 0) AS n FROM d
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n, {_share("coalesce(c.n, 0)", "g.n")} AS p, {_share("total", "l.n")} AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p))::BIGINT AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 10
"""

# Lists of words as shingles; a shorter text is one.
OP13 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 2], ' ') for i in range(1, greatest(len(w) - 1, 2))]) AS g
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) LEFT JOIN n USING (doc_id)
"""


def _codebook_rounds(rounds: int) -> str:
    """Each round as two tables: nearest entries ``a<k>`` under ``b<k>``, then the entries ``b<k + 1>``."""
    out = []
    for k in range(rounds + 1):
        out.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, label, row, p, x, min_by(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT v.*, b.e, list_sum([(v.x[i] - b.c[i]) * (v.x[i] - b.c[i]) for i in range(1, len(v.x) + 1)])::BIGINT AS d
    FROM v JOIN b{k} b USING (p)) GROUP BY ALL)""")
        if k < rounds:
            out.append(f"""m{k} AS (
  SELECT p, e, list(m::BIGINT ORDER BY i) AS c FROM (
    SELECT p, e, i, (sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM a{k}, range(1, 17) AS r(i) GROUP BY ALL) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (p, e))""")
    return ",\n".join(out)


# Vectors of 64 components, as the table has them.
OP12 = f"""
WITH w AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS row,
         [floor(1024 * c::DOUBLE)::BIGINT for c in embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (SELECT vec_id, label, row, p, x[16 * p + 1:16 * p + 16] AS x FROM w, range(4) AS r(p)),
b0 AS MATERIALIZED (SELECT p, row AS e, x AS c FROM v WHERE row < 256),
{_codebook_rounds(4)},
codes AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a4 GROUP BY vec_id, label, row),
totals AS (SELECT label, sum(error)::BIGINT AS label_error FROM codes GROUP BY label),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b4)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM codes JOIN totals ON codes.label IS NOT DISTINCT FROM totals.label, books
"""

SQL = {
    "op2_exact_dedup": OP2,
    "op6_warc": OP6,
    "op11_source_divergence_audit": OP11,
    "op12_vector_code_compression": OP12,
    "op13_minhash_near_dedup": OP13,
}
