"""SQL of the queries that SQL can express, for DuckDB."""

_GOOD = """embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0"""

OP5 = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE {_GOOD}
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(v.e) = len(q.e)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP10 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE {_GOOD} AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AND label IS NOT NULL
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reached(node, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.node
), roots AS (SELECT node, min(root) AS component_id FROM reached GROUP BY node
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON r.node = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""

# The suffixes, bounds and strengths of tokenloom/llm/hosts.py.
_LONG = "('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.jp', 'co.nz', 'com.br', 'co.in')"


def _last(host: str, n: int) -> str:
    return f"array_to_string(list_slice(string_split({host}, '.'), greatest(len(string_split({host}, '.')) - {n - 1}, 1), len(string_split({host}, '.'))), '.')"


def _strength(rows: str) -> str:
    return f"""(SELECT CASE WHEN coalesce(pairs, 0) = 0 THEN 10.0 WHEN (seen - chance) / pairs <= 0 THEN 1000.0
    ELSE least(1000.0, greatest(1.0, 1 / ((seen - chance) / pairs) - 1)) END FROM (
    SELECT sum(power(bad - n * prior, 2)) AS seen, sum(n * prior * (1 - prior)) AS chance,
      sum(n * (n - 1) * prior * (1 - prior)) AS pairs FROM {rows} WHERE n > 1))"""


OP9 = f"""
WITH split AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM split
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), counts AS (
  SELECT host, sum(bad) AS bad, count(*) AS n FROM (
    SELECT host, regexp_extract(path, '/([0-9]{{1,18}})(?:/|\\.html)?$', 1) AS shown FROM parts)
  JOIN marks ON shown <> '' AND try_cast(shown AS BIGINT) = doc_id GROUP BY host
), named AS (
  SELECT *, CASE WHEN {_last('host', 2)} IN {_LONG} THEN {_last('host', 2)} ELSE {_last('host', 1)} END AS suffix,
    CASE WHEN {_last('host', 2)} IN {_LONG} THEN {_last('host', 3)} ELSE {_last('host', 2)} END AS domain FROM counts
), s AS (
  SELECT suffix, sum(bad) AS bad, sum(n) AS n, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM counts) AS prior FROM named GROUP BY suffix
), sm AS (SELECT suffix, (bad + k * prior) / (n + k) AS mean FROM s, (SELECT {_strength('s')} AS k)
), d AS (
  SELECT domain, sum(bad) AS bad, sum(n) AS n, first(mean) AS prior FROM named JOIN sm USING (suffix) GROUP BY domain
), dm AS (SELECT domain, (bad + k * prior) / (n + k) AS mean FROM d, (SELECT {_strength('d')} AS k)
), h AS (SELECT host, bad, n, mean AS prior FROM named JOIN dm USING (domain)
), hm AS (SELECT host, n + k AS m, (bad + k * prior) / (n + k) AS mean FROM h, (SELECT {_strength('h')} AS k)
), judged AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (m + 1)) >= 0.5 AS bad_host FROM hm
), rules(rule, name, start, verdict) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), fits AS (
  SELECT p.page_id, p.host, p.path, r.rule, r.verdict FROM parts p LEFT JOIN rules r
  ON (p.host = r.name OR ends_with(p.host, '.' || r.name)) AND starts_with(p.path, r.start)
  QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST) = 1
)
SELECT page_id, f.host, path, rule, coalesce(verdict, CASE WHEN bad_host THEN 'block' ELSE 'allow' END) AS verdict
FROM fits f LEFT JOIN judged j ON j.host = f.host
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _price(count: str, total: str, kept: str) -> str:
    return f"CAST(1 + (1000000000::HUGEINT * ({count} + 2)) // ({total} + 2 * {kept}) AS HUGEINT)"


def _gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"


OP11 = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), groups AS (SELECT DISTINCT lang, source FROM d
), seen AS MATERIALIZED (SELECT no, lang, source, unnest(ts) AS term FROM d
), kept AS MATERIALIZED (SELECT lang, term, count(*) AS c FROM seen GROUP BY lang, term HAVING count(DISTINCT no) >= 10
), langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS c FROM seen JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL
), priced AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, {_price('coalesce(c.c, 0)', 'coalesce(s.n, 0)', 'l.v')} AS p, {_price('k.c', 'l.n', 'l.v')} AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum({_gap('x.p', 'y.p')}), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN priced y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY ALL
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, {_gap('p', 'q')} AS value FROM priced WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP12 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS c FROM (
    SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w)
  GROUP BY ALL
), n AS (SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS MATERIALIZED (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND c >= 10
), cuts AS (
  SELECT *, array_to_string(list_slice(ws, 1, cut), ' ') AS head, array_to_string(list_slice(ws, cut + 1, k), ' ') AS tail FROM (
    SELECT *, unnest(range(1, k)) AS cut FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, h.c AS l, t.c AS r, (1000000::HUGEINT * c.a * c.a) // (h.c::HUGEINT * t.c) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.cut) = 1
), inner_pairs AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, ws[1] || ' ' || ws[2] AS phrase, a FROM candidates WHERE k = 3 UNION ALL
    SELECT lang, ws[2] || ' ' || ws[3], a FROM candidates WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN inner_pairs i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLES = {"op5_top_k": OP5, "op9_url_filter": OP9, "op10_near_vectors": OP10, "op11_source_divergence": OP11, "op12_collocations": OP12}
