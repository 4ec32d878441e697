"""SQL for DuckDB with the rows of those queries of this subpackage that SQL can express."""

from __future__ import annotations

# A rule covers a host if the host is its own or ends in it after a dot.
OP8 = """
WITH rules(rhost, rpath, rverdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
rest AS (
    SELECT page_id,
           CASE WHEN strpos(url, '://') > 0
                THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*', 0, 's') ELSE '' END AS r
    FROM pages
),
urls AS (
    SELECT page_id,
           translate(CASE WHEN strpos(r, '/') > 0 THEN left(r, strpos(r, '/') - 1) ELSE r END,
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           CASE WHEN strpos(r, '/') > 0 THEN substr(r, strpos(r, '/')) ELSE '' END AS path
    FROM rest
),
hits AS (
    SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS k
    FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT u.page_id, u.host, u.path, h.rule, coalesce(h.rverdict, 'allow') AS verdict
FROM urls u LEFT JOIN hits h ON h.page_id = u.page_id AND h.k = 1
"""

# Each text is split on its own and every source has a row for each kept term, in no way like the operator.
OP12 = r"""
WITH d AS (
    SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
),
parts AS (
    SELECT row_number() OVER () AS doc, lang, source, regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM d
),
words AS (
    SELECT doc, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM parts
),
kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grps AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
full_cells AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
    FROM grps g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM full_cells a JOIN full_cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
rows_ AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM full_cells WHERE n > 0 AND p > q
),
ranked AS (
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM rows_
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""



def op13(rounds: int = 4) -> str:
    """Distances of all cells to all entries, and the rounds one after the other."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
    SELECT vec_id, part, min(d * 256 + entry) % 256 AS entry, min(d * 256 + entry) // 256 AS d
    FROM (
        SELECT c.vec_id, c.part, b.entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS d
        FROM cells c JOIN book{r} b ON b.part = c.part AND b.place = c.place GROUP BY ALL
    ) GROUP BY ALL
)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, b.place, coalesce((s - ((s % n) + n) % n) // n, b.x) AS x
    FROM book{r} b LEFT JOIN (
        SELECT c.part, k.entry, c.place, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS n
        FROM cells c JOIN near{r} k ON k.vec_id = c.vec_id AND k.part = c.part GROUP BY ALL
    ) m ON m.part = b.part AND m.entry = b.entry AND m.place = b.place
)""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cells AS MATERIALIZED (
    SELECT vec_id, (i - 1) // (len(v) // 4) AS part, (i - 1) % (len(v) // 4) AS place, v[i] AS x
    FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM kept)
),
book0 AS MATERIALIZED (
    SELECT c.part, f.entry, c.place, c.x
    FROM cells c JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256) f
    ON f.vec_id = c.vec_id
),{",".join(steps)},
coded AS (
    SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


ORACLE: dict[str, str] = {"op8_url_rules": OP8, "op12_divergence": OP12, "op13_vector_codes": op13()}
