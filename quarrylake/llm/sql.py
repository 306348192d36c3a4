"""The SQL that the corpus queries must agree with, where SQL can express them."""

from __future__ import annotations

from quarrylake.llm import mixing

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def mixing_sql(share: float, epochs: int, weights=mixing.WEIGHTS, seed: int = 17) -> str:
    """Water-filling level by level, then a running sum over each leaf's last epoch."""

    def weight(level: str) -> str:
        cases = "".join(f" WHEN {level} = '{k}' THEN {v}" for k, v in weights[level].items())
        return f"CASE{cases} ELSE 1 END" if cases else "1"

    ctes, above = [], None
    for depth, level in enumerate(mixing.LEVELS, 1):
        names, parents = ", ".join(mixing.LEVELS[:depth]), ", ".join(mixing.LEVELS[:depth - 1])
        by = f"PARTITION BY {parents}" if parents else ""
        budget = f"JOIN got_{above} USING ({parents})" if parents else "CROSS JOIN total"
        own = ", ".join(f"c.{n}" for n in mixing.LEVELS[:depth])
        ctes.append(f"""
kids_{level} AS (SELECT {own}, cap, {weight(level).replace(level + ' =', 'c.' + level + ' =')} AS weight, budget, cap::DOUBLE / ({weight(level).replace(level + ' =', 'c.' + level + ' =')}) AS lev
  FROM (SELECT {names}, (sum(tokens) * {epochs})::BIGINT AS cap FROM leaves GROUP BY {names}) c {budget}),
sums_{level} AS (SELECT *, sum(cap) OVER (u)::DOUBLE + lev * (sum(weight) OVER (s) - sum(weight) OVER (u))::DOUBLE <= budget::DOUBLE AS filled
  FROM kids_{level} WINDOW s AS ({by}), u AS ({by} ORDER BY lev)),
got_{level} AS (SELECT {names}, CASE WHEN filled THEN cap ELSE least(cap, floor(
    (budget - coalesce(sum(CASE WHEN filled THEN cap END) OVER (s), 0))::DOUBLE * weight::DOUBLE
    / coalesce(sum(CASE WHEN NOT filled THEN weight END) OVER (s), 0)::DOUBLE)::BIGINT) END::BIGINT AS budget
  FROM sums_{level} WINDOW s AS ({by}))""")
        above = level
    leaf = ", ".join(mixing.LEVELS)
    return f"""
WITH rows AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' WHEN regexp_matches(source, '[13579]$') THEN 'forum' ELSE 'reference' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
leaves AS (SELECT {leaf}, sum(tokens)::BIGINT AS tokens FROM rows GROUP BY {leaf}),
total AS (SELECT floor(sum(tokens)::DOUBLE * {share})::BIGINT AS budget FROM leaves),
{",".join(ctes)},
plans AS (SELECT {leaf}, tokens AS supply, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole, budget FROM leaves JOIN got_{above} USING ({leaf})),
placed AS (SELECT r.*, whole, budget - whole * supply AS rest, coalesce(doc_id, {mixing.LEAST_ID}) AS id,
  ('0x' || substr(md5('{seed}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS place FROM rows r JOIN plans USING ({leaf})),
begun AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY {leaf} ORDER BY place, id), 0) - sum(tokens) OVER (PARTITION BY {leaf}, place, id) AS begin FROM placed),
times AS (SELECT *, whole + CASE WHEN begin < rest THEN 1 ELSE 0 END AS n FROM begun)
SELECT doc_id, {leaf}, tokens AS n_tokens, unnest(range(n))::INT AS epoch FROM times WHERE n > 0
"""

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def archive_sql() -> str:
    characters = " || ".join(
        f"'{BASE32}'[((('0x' || h[{5 * g + 1}:{5 * g + 5}])::BIGINT >> {s}) & 31) + 1]" for g in range(8) for s in (15, 10, 5, 0)
    )
    return f"""
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
hashed AS (SELECT page_id, body, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first_id FROM bodies)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, {characters} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM hashed
"""


def top_k_sql(k: int, every: int) -> str:
    return f"""
WITH whole AS (SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {every} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}
"""


def license_sql(phrases, templates, containment: float) -> str:
    """Phrases by comparing slices of the word list; templates by counting their words in
    every block that starts with one of them."""
    signs = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    listed = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(templates))
    starts = [
        f"[i - 1 FOR i IN range(1, len(w) + 1) IF w[i:i + {len(p.split()) - 1}] = {p.split()!r}]" for p, _ in phrases
    ]
    columns = ", ".join(f"{s} AS at_{k}" for k, s in enumerate(starts))
    joined = " || ".join(f"at_{k}" for k in range(len(phrases)))
    base = ", ".join(f"CASE WHEN len(at_{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(phrases))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{signs}') AS w FROM documents),
templates(k, label, t) AS (VALUES {listed}),
parted AS (SELECT k, label, regexp_extract_all({LOWER.format('t')}, '{signs}') AS w FROM templates),
owned AS (SELECT k, label, list_distinct(w) AS own, len(list_distinct(w)) AS size, (3 * len(w) + 1) // 2 AS length FROM parted),
twins AS (SELECT a.k AS a, b.k AS b FROM owned a JOIN owned b ON a.k <> b.k AND len(list_intersect(a.own, b.own)) >= ceil({containment} * a.size - 1e-9)),
vocabulary AS (SELECT k, size, length, unnest(own) AS word FROM owned),
words AS (SELECT id, unnest(range(len(w))) AS i, unnest(w) AS word FROM docs),
held AS MATERIALIZED (SELECT id, i, word, k, size, length FROM words JOIN vocabulary USING (word)),
blocks AS (SELECT s.id, s.k, s.i, s.size, s.length, count(DISTINCT h.word) AS met FROM held s
  JOIN held h ON h.id = s.id AND h.k = s.k AND h.i >= s.i AND h.i < s.i + s.length GROUP BY ALL),
enough AS MATERIALIZED (SELECT id, k, i, i + length AS past, met, met::DOUBLE / size AS share FROM blocks WHERE met >= ceil({containment} * size - 1e-9)),
best AS MATERIALIZED (SELECT * FROM enough e WHERE NOT EXISTS (SELECT 1 FROM enough o JOIN twins t ON t.a = e.k AND t.b = o.k
  WHERE o.id = e.id AND o.i < e.past AND e.i < o.past AND (o.share > e.share OR (o.share = e.share AND o.met > e.met)))),
found AS (SELECT id, list(DISTINCT label) AS labels, max(share) AS share FROM best JOIN owned USING (k) GROUP BY id),
placed AS (SELECT id, doc_id, len(w)::BIGINT AS n_words, {columns} FROM docs),
based AS (SELECT id, doc_id, n_words, {joined} AS starts, [x FOR x IN list_sort([{base}]) IF x IS NOT NULL] AS base FROM placed)
SELECT doc_id, n_words, len(starts)::BIGINT AS n_base, list_min(starts)::BIGINT AS first_word, list_max(starts)::BIGINT AS last_word,
  array_to_string(base, ',') AS base_labels, array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ',') AS labels,
  coalesce(share, CASE WHEN len(starts) > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM based LEFT JOIN found USING (id)
"""


def kmeans_sql(k: int, rounds: int, seed: int, dims: int) -> str:
    """One step of common table expressions per round, every vector against every centroid."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (SELECT v.row, c.cluster, list_sum([((v.v[i] - c.v[i]) * (v.v[i] - c.v[i]))::HUGEINT FOR i IN range(1, {dims + 1})])::BIGINT AS distance FROM kept v, c{r} c),
a{r} AS MATERIALIZED (SELECT row, cluster, distance FROM d{r} QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)""")
        if r < rounds:
            steps.append(f"""
t{r} AS (SELECT cluster, i, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT cluster, unnest(range({dims})) AS i, unnest(v) AS x FROM a{r} JOIN kept USING (row)) GROUP BY ALL),
m{r} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM t{r} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (cluster))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS (SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1)::INT AS cluster, v FROM kept QUALIFY cluster < {k}),
{",".join(steps)}
SELECT vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(a.distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (row) JOIN c{rounds} c ON a.cluster = c.cluster
"""


def components_sql(size: int, percent: int, kept: bool) -> str:
    """Every pair of documents that share a shingle, then everything reachable from each document."""
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
held AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(w[i:i + {size - 1}], ' ') FOR i IN range(1, len(w) - {size - 2})] END) AS shingle FROM docs),
sized AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM met JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * common >= {percent} * (x.n + y.n - common)),
reached AS (SELECT doc_id, doc_id AS other FROM docs UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id{", doc_id = component_id AS kept" if kept else ""} FROM least LEFT JOIN sized USING (doc_id)
"""


def repeats_sql(size: int) -> str:
    """Every window with the least document that holds it, then the words under the repeated ones."""
    return f"""
WITH docs AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT doc_id, i, array_to_string(w[i:i + {size - 1}], ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM docs)),
sources AS (SELECT words, min(doc_id) AS least FROM places GROUP BY words HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {size})) AS i FROM places JOIN sources USING (words) WHERE least < doc_id),
cut AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
left_over AS (SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
  CASE WHEN gone IS NULL THEN w ELSE (SELECT coalesce(list(x ORDER BY j), []) FROM (SELECT unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j) WHERE NOT list_contains(gone, j)) END AS kept
  FROM docs LEFT JOIN cut USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM left_over
"""


def periodic_sql(times: int, least: int, every: int) -> str:
    """Equal words q apart, islands of neighbours of one q, and those that no shorter period covers."""
    bit = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    crc = f"xor(list_reduce(list_concat([4294967295], [ascii(s)::BIGINT FOR s IN string_split(doc_id::VARCHAR, '')]), lambda c, b: {bit}), 4294967295)"
    return f"""
WITH docs AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w, {crc} AS h FROM documents),
placed AS (SELECT doc_id, w, len(w) AS n, h % {every} = 0 AND len(w) > 0 AS planted, h // {every} AS g FROM docs),
cut AS (SELECT *, CASE WHEN planted THEN g % n ELSE 0 END AS a FROM placed),
shaped AS (SELECT doc_id, CASE WHEN planted THEN list_concat(w[1:a], [w[a + i % (1 + (n - a) // (3 + g % 8)) + 1] FOR i IN range(n - a)]) ELSE w END AS w FROM cut),
words AS MATERIALIZED (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word, len(w) AS n FROM shaped),
equal AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND {times} * (b.i - a.i) <= a.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
long AS (SELECT doc_id, q AS period, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest({least}, {times} * q)),
runs AS MATERIALIZED (SELECT * FROM long r WHERE NOT EXISTS (SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.period < r.period
  AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
best AS (SELECT * FROM runs r WHERE NOT EXISTS (SELECT 1 FROM runs s WHERE s.doc_id = r.doc_id AND (s.length * r.period > r.length * s.period
  OR (s.length * r.period = r.length * s.period AND (s.start, s.period) < (r.start, r.period))))),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
  sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
