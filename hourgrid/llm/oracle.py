"""DuckDB SQL of the queries that SQL can express, written without the operators' code."""

from __future__ import annotations

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TWO = "regexp_full_match(two, '(ac|co|com|edu|go|gob|gov|govt|gr|mil|ne|net|nom|or|org|sch)[.][a-z][a-z]')"
_IP = "regexp_full_match(host, '[0-9]+([.][0-9]+){3}|\\[.*\\]')"


def _moments(name: str, children: str, level: str) -> str:
    return f"""
{name} AS (
  SELECT {level}, gs, ns, CASE WHEN c > 1 AND room > 0 AND btw > 0
         THEN least(greatest(mu * (1 - mu) / btw - 1, 2.0), 200.0) ELSE 200.0 END AS m
  FROM (SELECT *, (s2 - ns * mu * mu - (c - 1) * mu * (1 - mu)) / nullif(room, 0) AS btw
        FROM (SELECT {level}, sum(g) AS gs, sum(n) AS ns, count(*) AS c, sum(g * g / n) AS s2,
                     sum(n) - sum(n * n) / sum(n) AS room, sum(g) / sum(n) AS mu
              FROM {children} GROUP BY {level}) a) b)"""


URLS = f"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_AZ}', '{_az}'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
q AS (SELECT page_id, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS host FROM p),
o AS (SELECT doc_id AS page_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good
      FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1),
h0 AS (SELECT host, CAST(coalesce(sum(good), 0) AS DOUBLE) AS g, CAST(count(good) AS DOUBLE) AS n, string_split(host, '.') AS x
       FROM q LEFT JOIN o USING (page_id) GROUP BY host),
h1 AS (SELECT *, CASE WHEN len(x) > 1 THEN x[-2] || '.' || x[-1] ELSE host END AS two,
              CASE WHEN len(x) > 2 THEN x[-3] || '.' || x[-2] || '.' || x[-1] ELSE host END AS three FROM h0),
h AS (SELECT host, g, n, CASE WHEN {_IP} THEN host WHEN {_TWO} THEN three ELSE two END AS domain,
             CASE WHEN {_IP} THEN host WHEN {_TWO} AND two <> host THEN two ELSE x[-1] END AS suffix FROM h1),
lab AS (SELECT * FROM h WHERE n > 0),
d AS (SELECT domain, suffix, sum(g) AS g, sum(n) AS n FROM lab GROUP BY 1, 2),
s AS (SELECT 0 AS everything, suffix, sum(g) AS g, sum(n) AS n FROM d GROUP BY 2),{_moments("w", "s", "everything")},{_moments("sm", "d", "suffix")},{_moments("dm", "lab", "domain")},
top AS (SELECT h.suffix, coalesce((gs + wm * wmu) / (ns + wm), wmu) AS mu, coalesce(m, 200.0) AS m
        FROM (SELECT DISTINCT suffix FROM h) h LEFT JOIN sm USING (suffix), (SELECT m AS wm, gs / ns AS wmu FROM w) w),
mid AS (SELECT h.domain, coalesce((gs + top.m * top.mu) / (ns + top.m), top.mu) AS mu, coalesce(dm.m, top.m) AS m
        FROM (SELECT DISTINCT domain, suffix FROM h) h LEFT JOIN dm USING (domain) JOIN top USING (suffix)),
post AS (SELECT host, (g + m * mu) / (n + m) AS mean, n + m AS ab FROM h JOIN mid USING (domain)),
r AS (SELECT p.*, post.mean, post.mean + 1.645 * sqrt(post.mean * (1 - post.mean) / (ab + 1)) < 0.6 AS blocked,
  CASE WHEN (p.host = 'example.org' OR ends_with(p.host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
       WHEN (p.host = 'example.org' OR ends_with(p.host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
       WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
       WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
       WHEN (p.host = 'org' OR ends_with(p.host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p JOIN (SELECT DISTINCT host AS raw, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS site FROM p) t ON t.raw = p.host
  LEFT JOIN post ON post.host = t.site)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN blocked THEN 'block' ELSE 'allow' END AS verdict,
       round(mean, 6) AS reputation
FROM r
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
near AS (SELECT a.r AS x, b.r AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
         WHERE a.ok AND b.ok AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT x, y FROM near UNION SELECT reach.x, near.y FROM reach JOIN near ON reach.y = near.x),
comp AS (SELECT x, min(vec_id) AS least FROM reach JOIN v ON reach.y = v.r GROUP BY x),
deg AS (SELECT x, count(*) AS n FROM near GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(comp.least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(comp.least, vec_id)) AS kept
FROM v LEFT JOIN comp ON comp.x = v.r LEFT JOIN deg ON deg.x = v.r
"""

MIX = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size,
             least(3.0::DOUBLE * source_size, w * (SELECT level FROM l WHERE 3.0::DOUBLE * source_size >= level * w ORDER BY source_size / w, source NULLS LAST LIMIT 1)) AS target FROM l),
f AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) AS copy FROM d),
r AS (SELECT c.doc_id, c.size, f.source_size, f.target, f.whole,
             coalesce(sum(c.size) OVER (PARTITION BY c.source ORDER BY ('0x' || substr(md5('mix/' || coalesce(CAST(c.doc_id AS VARCHAR), 'null') || '/' || c.copy), 1, 13))::BIGINT
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM c JOIN f ON c.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, source_size, round(target, 4) AS target,
       CAST(size * (whole + CASE WHEN before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

PACKAGES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5))::INTEGER >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM g
"""
