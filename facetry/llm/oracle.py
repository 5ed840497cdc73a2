"""What the registered queries should return, as DuckDB SQL, written without their code."""

ORACLE: dict[str, str] = {}

ORACLE["op1_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, body, strlen(body) AS payload_bytes, sha1(body) AS hex,
         min(page_id) OVER (PARTITION BY body) AS first
  FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d"""

ORACLE["op2_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id) q JOIN (SELECT DISTINCT vec_id, v FROM v) c ON c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""

ORACLE["op4_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([3.0, 1.0, 2.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         sum(2.0::DOUBLE * source_size) OVER upto - 2.0::DOUBLE * source_size AS spent,
         sum(w) OVER () - sum(w) OVER upto + w AS weights,
         sum(source_size) OVER () AS total
  FROM s WINDOW upto AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), l AS (
  -- the sources that end above their cap come first; the level is what is left, per weight
  SELECT max((1.5::DOUBLE * total - spent) / weights) FILTER (WHERE (1.5::DOUBLE * total - spent) / weights * w < cap) AS level FROM (
    SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k,
           min(CASE WHEN (1.5::DOUBLE * total - spent) / weights * w < cap THEN cap / w END) OVER () AS border FROM o)
  WHERE cap / w = border
), t AS (
  SELECT source, source_size, least(coalesce((SELECT level FROM l) * w, cap), cap) AS target FROM o
), k AS (
  SELECT d.*, t.source_size, t.target,
         -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)
           / ((1.0::DOUBLE + 9.0::DOUBLE * (length(translate(body, '!"#$%&''()*+,-./0123456789:;<=>?@[\]^_`{|}~', '')) + 1) / (length(body) + 1)) / 10.0::DOUBLE) AS key,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 1 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), r AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto,
         target - epochs * source_size AS rest
  FROM k
)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r"""

ORACLE["op8_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM d WINDOW same AS (PARTITION BY body)"""

ORACLE["op9_url_filter"] = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r AS (
  SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) v(rh, rp, verdict)
), m AS (
  SELECT u.*, rh || rp AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC) AS k
  FROM u LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1"""


ORACLE["op13_substrings"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d
), k AS (
  SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY md5(array_to_string(w[pos:pos + 49], ' '))) AS first FROM s
), g AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM k WHERE first < doc_id
), r AS (
  SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)"""


def _moved(k: int) -> str:
    """One round: every part to its nearest entry of ``b{k}``, every entry to the mean of its parts."""
    means = ", ".join(f"floor(sum(x[{i}])::DOUBLE / count(*))::BIGINT" for i in range(1, 5))
    return f"""{_assigned(k)}, b{k + 1} AS (
  SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{k} b
  LEFT JOIN (SELECT part, entry, [{means}] AS c FROM a{k} GROUP BY part, entry) m USING (part, entry)
)"""


def _assigned(k: int) -> str:
    distance = " + ".join(f"(x[{i}] - c[{i}]) * (x[{i}] - c[{i}])" for i in range(1, 5))
    return f"""a{k} AS (
  SELECT vec_id, part, any_value(x) AS x, min(d) AS d, arg_min(entry, (d, entry)) AS entry
  FROM (SELECT vec_id, part, x, entry, {distance} AS d FROM p JOIN b{k} USING (part)) GROUP BY vec_id, part
)"""


# parts of four components, as the table's vectors have 64
ORACLE["op12_vector_codes"] = f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT vec_id, part, v[4 * part + 1:4 * part + 4] AS x FROM v, (SELECT unnest(range(16)) AS part)
), b0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p QUALIFY entry < 64
), {_moved(0)}, {_moved(1)}, {_assigned(2)}, e AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM e JOIN v USING (vec_id)"""
