"""DuckDB SQL of the operators that SQL can express."""

_URL_RULES = """(VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS r(verdict, r_host, r_path)"""

# A URL's own rule in plain SQL, then its class by address and by links that
# pages declare (canonical link, og:url, refresh) with absolute targets.
_OP6 = f"""
WITH RECURSIVE links AS (
  SELECT DISTINCT url AS source, unnest(list_concat(
    regexp_extract_all(html, '(?i)<link\\b[^>]*rel="canonical"[^>]*href="([^"]*://[^"]*)"', 1),
    regexp_extract_all(html, '(?i)<meta\\b[^>]*property="og:url"[^>]*content="([^"]*://[^"]*)"', 1),
    regexp_extract_all(html, '(?i)<meta\\b[^>]*http-equiv="refresh"[^>]*content="[^"]*url=([^"]*://[^"]*)"', 1))) AS target
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL
), urls AS (
  SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT source FROM links UNION SELECT target FROM links
), cut AS (
  SELECT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM urls
), parts AS (
  SELECT url, rest,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut
), own AS (
  SELECT url, host, path,
    (SELECT arg_max(r_host || r_path, length(r_host || r_path)) FROM {_URL_RULES}
     WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS rule,
    (SELECT arg_max(verdict, length(r_host || r_path)) FROM {_URL_RULES}
     WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS own,
    CASE WHEN host <> '' THEN
      regexp_replace(host, '^www\\.(.*\\.)', '\\1') ||
      regexp_replace(regexp_replace(path, '/index\\.html?$', '/'), '/+$', '') ||
      coalesce('?' || nullif(array_to_string(list_sort(list_filter(
        string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'),
        lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)='))), '&'), ''), '') END AS address
  FROM parts
), edges AS (
  SELECT a.address AS a, b.address AS b FROM links JOIN own a ON a.url = source JOIN own b ON b.url = target
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reach(a, b) AS (
  SELECT DISTINCT address, address FROM own WHERE address IS NOT NULL
  UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), inherited AS (
  SELECT reach.a AS address, min(own.own) AS verdict FROM reach JOIN own ON own.address = reach.b GROUP BY 1
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(own, inherited.verdict, 'allow') AS verdict
FROM pages LEFT JOIN own USING (url) LEFT JOIN inherited USING (address)
"""

# Every pair by brute force; components by reachability.
_OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.vec_id <> q.vec_id AND list_cosine_similarity(p.e, q.e) >= 0.95
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1
), n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""

_OP5 = r"""
WITH d AS (
  SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), q AS (
  SELECT DISTINCT item_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), ds AS (
  SELECT DISTINCT id, array_to_string(w[k:k + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS r(k)
), qs AS (
  SELECT DISTINCT id, array_to_string(w[k:k + 4], ' ') AS s FROM q, unnest(range(1, len(w) - 3)) AS r(k)
), n AS (SELECT id, count(*) AS n FROM qs GROUP BY id
), shared AS (SELECT ds.id AS doc_id, qs.id AS item_id, count(*) AS n_shared FROM ds JOIN qs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_item, n_shared, n_shared / n AS containment
FROM shared JOIN n ON n.id = item_id WHERE n_shared >= 0.8 * n
"""

# Every order applied to counts of documents by the letters they fail.
_OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY 1
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS f
  FROM d LEFT JOIN l USING (doc_id)
), counted AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM failing GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), orders AS (
  SELECT p.c || q.c || r.c || s.c || t.c AS o FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.c, q.c, r.c, s.c, t.c])) = 5
), steps AS (
  SELECT o AS filter_order, k::INTEGER AS step, o[k] AS c, CASE WHEN k > 1 THEN o[1:k - 1] ELSE '' END AS earlier FROM orders, range(1, 6) AS s(k)
), told AS (
  SELECT part, filter_order, step, c, n, g, x, f, contains(f, c) AS fails,
         earlier = '' OR NOT regexp_matches(f, '[' || CASE WHEN earlier = '' THEN '-' ELSE earlier END || ']') AS there
  FROM counted, steps
), summed AS (
  SELECT part, filter_order, step, c, coalesce(sum(n) FILTER (there AND NOT fails), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (there AND fails), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (fails AND NOT there), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (f = c), 0)::BIGINT AS unique_fails, coalesce(sum(g) FILTER (there AND fails), 0)::BIGINT AS good_lost,
    coalesce(sum(x) FILTER (there AND fails), 0)::BIGINT AS toxic_lost
  FROM told GROUP BY 1, 2, 3, 4
)
SELECT * EXCLUDE (c), (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley FROM summed
"""


def _rounds(k: int, rounds: int) -> str:
    """Lloyd's rounds as a chain of tables: all distances, all means."""
    near = """a{r} AS MATERIALIZED (
  SELECT n, any_value(vec_id) AS vec_id, any_value(e) AS e,
         min({{'d': list_dot_product(e::DOUBLE[], e::DOUBLE[]) - 2 * list_dot_product(e::DOUBLE[], c::DOUBLE[])
                    + list_dot_product(c::DOUBLE[], c::DOUBLE[]), 'k': k}}) AS m
  FROM v, c{r} GROUP BY n)"""
    moved = """c{s} AS MATERIALIZED (
  SELECT o.k, coalesce(x.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT k, list(((t - ((t % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
      SELECT m.k AS k, i, sum(e[i])::BIGINT AS t, count(*) AS n FROM a{r}, range(1, 65) AS r(i) GROUP BY ALL) GROUP BY k) x USING (k))"""
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, e AS c FROM v ORDER BY k LIMIT {k})"""]
    for r in range(rounds):
        parts += [near.format(r=r), moved.format(r=r, s=r + 1)]
    parts.append(near.format(r=rounds))
    return f"""WITH {", ".join(parts)}
SELECT vec_id, m.k::INTEGER AS cluster, m.d::BIGINT AS distance, (sum(m.d) OVER (PARTITION BY m.k))::BIGINT AS cluster_inertia,
       (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON m.k = k"""


SQL: dict[str, str] = {
    "op11_filter_audit": _OP11,
    "op13_ptolemy_clusters": _rounds(8, 10),
    "op5_decontaminate": _OP5,
    "op2_cap_neardup": _OP2,
    "op6_url_redirects": _OP6,
}
