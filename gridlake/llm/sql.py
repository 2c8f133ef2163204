"""DuckDB SQL for the queries of this folder that SQL can express, written apart from the operators."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), components AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""

OP4 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN w ELSE w[i:i + 2] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), classes AS (
  SELECT min(doc_id) AS c, list(doc_id) AS ids, any_value(n) AS n, any_value(gs) AS gs FROM (
    SELECT doc_id, count(*) AS n, list(g ORDER BY g) AS gs FROM shingles GROUP BY doc_id
  ) GROUP BY gs
), rows AS (
  SELECT c, n, unnest(gs) AS g FROM classes
), links AS (
  SELECT a.c AS a, b.c AS b FROM rows a JOIN rows b ON a.g = b.g AND a.c < b.c AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
  SELECT c, c FROM classes UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), components AS (
  SELECT unnest(k.ids) AS doc_id, m.component_id
  FROM classes k JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = k.c
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN components c USING (doc_id)
"""

_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP7 = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_CLASS}') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_CLASS}') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
), found AS (
  SELECT p.doc_id, p.i, p.k, v.item_id FROM places p JOIN windows v ON p.k = v.k AND p.g = v.g
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id
), which AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(x.n_items, 0) AS n_items,
       sha256(coalesce(x.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN which x USING (doc_id)
"""

OP8 = r"""
WITH pages_of AS (
  SELECT page_id, CAST(floor(page_id / 1024.0) AS BIGINT) AS file_no, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), copies AS (
  SELECT 0 AS copy, * FROM pages_of
  UNION ALL
  SELECT 1, page_id, file_no, url, CASE WHEN page_id % 64 = 0 AND html <> '' AND ascii(html) < 128
    THEN CASE WHEN html[1] = '#' THEN '%' ELSE '#' END || html[2:] ELSE html END FROM pages_of
), written AS (
  SELECT copy, page_id, file_no, concat(
    'WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10),
    'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', strlen(html),
    chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10)) AS r FROM copies
), placed AS (
  SELECT copy, page_id, file_no, strlen(r) AS record_length, sha256(r) AS record_sha256,
    row_number() OVER w - 1 AS record_no, sum(strlen(r)) OVER w - strlen(r) AS record_offset
  FROM written WINDOW w AS (PARTITION BY copy, file_no ORDER BY page_id, sha256(r) ROWS UNBOUNDED PRECEDING)
), n0 AS (
  SELECT copy, file_no, record_no AS no, record_offset AS a, record_offset + record_length AS z,
    sha256(concat_ws('|', 'leaf', CAST(record_offset AS BIGINT), record_length, record_sha256)) AS h FROM placed
), n1 AS (
  SELECT copy, file_no, no // 16 AS no, min(a) AS a, max(z) AS z,
    sha256(concat_ws('|', 'node', CAST(min(a) AS BIGINT), CAST(max(z) AS BIGINT), string_agg(h, '|' ORDER BY no))) AS h FROM n0 GROUP BY ALL
), n2 AS (
  SELECT copy, file_no, no // 16 AS no, min(a) AS a, max(z) AS z,
    sha256(concat_ws('|', 'node', CAST(min(a) AS BIGINT), CAST(max(z) AS BIGINT), string_agg(h, '|' ORDER BY no))) AS h FROM n1 GROUP BY ALL
), n3 AS (
  SELECT copy, file_no, no // 16 AS no, min(a) AS a, max(z) AS z,
    sha256(concat_ws('|', 'node', CAST(min(a) AS BIGINT), CAST(max(z) AS BIGINT), string_agg(h, '|' ORDER BY no))) AS h FROM n2 GROUP BY ALL
), height AS (
  SELECT CASE WHEN max(record_no) = 0 THEN 0 WHEN max(record_no) < 16 THEN 1 WHEN max(record_no) < 256 THEN 2 ELSE 3 END AS k FROM placed
), roots AS (
  SELECT copy, file_no, h FROM n0, height WHERE k = 0 UNION ALL SELECT copy, file_no, h FROM n1, height WHERE k = 1
  UNION ALL SELECT copy, file_no, h FROM n2, height WHERE k = 2 UNION ALL SELECT copy, file_no, h FROM n3, height WHERE k = 3
)
SELECT p.file_no, p.record_no, p.page_id, p.record_length, p.record_sha256, CAST(p.record_offset AS BIGINT) AS record_offset,
  x.h AS file_root, y.h AS replica_root, CASE WHEN p.record_sha256 = q.record_sha256 THEN 'sound' ELSE 'damaged' END AS status
FROM placed p JOIN placed q ON q.copy = 1 AND p.file_no = q.file_no AND p.record_no = q.record_no
JOIN roots x ON x.copy = 0 AND x.file_no = p.file_no JOIN roots y ON y.copy = 1 AND y.file_no = p.file_no
WHERE p.copy = 0
"""

OP10 = rf"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS line_no FROM (
    SELECT doc_id, string_split(replace(text, chr(10), chr(10) || chr(1)), chr(1)) AS l FROM documents WHERE text <> ''
  )
), cut AS (
  SELECT doc_id, line_no, unnest(u) AS unit, unnest(range(len(u))) AS i FROM (
    SELECT doc_id, line_no, string_split(regexp_replace(line, '([.!?])([\t-\r ])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS u FROM lines
  )
), pieces AS (
  SELECT doc_id, line_no, unit, sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY line_no, i ROWS UNBOUNDED PRECEDING) AS z,
    len(regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_CLASS}')) AS n
  FROM cut
), chosen AS (
  SELECT doc_id, unit, z FROM pieces WHERE n >= 6
  UNION ALL
  SELECT l.doc_id, l.line, p.z FROM lines l
  JOIN (SELECT doc_id, line_no, max(z) AS z FROM pieces GROUP BY doc_id, line_no HAVING max(n) < 6) p ON p.doc_id = l.doc_id AND p.line_no = l.line_no
), units AS (
  SELECT *, regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_CLASS}') AS w FROM chosen
), counted AS (
  SELECT doc_id, CAST(z - length(unit) + length(regexp_extract(unit, '^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*')) AS BIGINT) AS a,
    CAST(z AS BIGINT) AS z, len(w) AS n, array_to_string(w, ' ') AS g
  FROM units WHERE len(w) >= 1
), ranked AS (
  SELECT *, first_value(doc_id) OVER o AS first_doc, first_value(a) OVER o AS first_a, row_number() OVER o AS k
  FROM counted WINDOW o AS (PARTITION BY g ORDER BY doc_id, a)
)
SELECT doc_id, a AS start, z AS "end", n AS n_words, first_doc AS first_doc_id, first_a AS first_start FROM ranked WHERE k > 1
"""

OP11 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split(regexp_replace({_LOWER}, '[.,;:!?\x0A-\x0D]', chr(10), 'g'), chr(10))) AS piece FROM documents
), words AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS MATERIALIZED (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), f AS MATERIALIZED (
  SELECT lang, g, k, CAST(count(*) AS BIGINT) AS f FROM (
    SELECT lang, w[i] AS g, 1 AS k FROM places
    UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM places WHERE i < len(w)
    UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 FROM places WHERE i + 1 < len(w)
  ) GROUP BY lang, g, k
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS MATERIALIZED (
  SELECT lang, g, k, f AS a, string_split(g, ' ') AS w FROM f WHERE k >= 2 AND f >= 10
), parts AS (
  SELECT lang, g, k, a, 1 AS cut, w[1] AS head, array_to_string(w[2:], ' ') AS tail FROM candidates
  UNION ALL SELECT lang, g, k, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE k = 3
), cuts AS MATERIALIZED (
  SELECT c.lang, c.g, c.k, c.a, c.cut, l.f AS l, r.f AS r,
    CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM parts c JOIN f l ON l.lang = c.lang AND l.g = c.head AND l.k = c.cut JOIN f r ON r.lang = c.lang AND r.g = c.tail AND r.k = c.k - c.cut
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, w[1] || ' ' || w[2] AS g, a FROM candidates WHERE k = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE k = 3
), longer AS (
  SELECT lang, g, max(a) AS most FROM inside GROUP BY lang, g
)
SELECT x.lang, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, x.a DESC, x.g) AS rank, x.g AS phrase, x.a, x.l, x.r, t.n, x.score
FROM lowest x JOIN totals t ON t.lang = x.lang LEFT JOIN longer y ON y.lang = x.lang AND y.g = x.g AND x.k = 2
WHERE y.most IS NULL OR 100 * y.most < 50 * x.a
QUALIFY rank <= 2000
"""


def _op13(passes: int = 4) -> str:
    """The passes over a source's documents are one query after the other."""
    sql = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, ''))), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0 AS u
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM sized GROUP BY source
), weighted AS (
  SELECT source, source_size, CASE (no - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
), filled AS (
  SELECT *, (SELECT sum(source_size) FROM weighted) - coalesce(sum(3 * source_size) OVER w, 0) AS room,
    (SELECT sum(weight) FROM weighted) - coalesce(sum(weight) OVER w, 0) AS shares
  FROM weighted WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), price AS (
  SELECT CAST(room AS DOUBLE) AS room, CAST(shares AS DOUBLE) AS shares FROM filled
  WHERE weight * room <= 3 * source_size * shares ORDER BY room / shares DESC LIMIT 1
), wanted AS (
  SELECT source, source_size, least(CAST(weight AS DOUBLE) * (SELECT room FROM price) / (SELECT shares FROM price), CAST(3 * source_size AS DOUBLE)) AS target FROM weighted
), graded AS (
  SELECT *, length(bin(size)) + 1 AS grade FROM sized WHERE size > 0
), grades AS (
  SELECT source, grade, CAST(sum(size) AS BIGINT) AS words FROM graded GROUP BY source, grade
), steps AS (
  SELECT g.source, g.grade, g.words, t.target,
    (t.target - 3 * CAST(coalesce(sum(words) OVER (PARTITION BY g.source ORDER BY grade DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
      / CAST(sum(words * grade) OVER (PARTITION BY g.source ORDER BY grade) AS DOUBLE) AS step
  FROM grades g JOIN wanted t ON t.source IS NOT DISTINCT FROM g.source
), best AS (
  SELECT source, max(CASE WHEN step * grade <= 3 THEN step END) AS step FROM steps GROUP BY source
), plan AS (
  SELECT s.source, s.grade, s.words, s.target, CAST(floor(c) AS BIGINT) AS whole, c - CAST(floor(c) AS BIGINT) AS p
  FROM (SELECT s.*, least(coalesce(b.step * s.grade, 3.0), 3.0) AS c FROM steps s JOIN best b ON s.source IS NOT DISTINCT FROM b.source) s
), ranked AS (
  SELECT g.doc_id, g.source, g.size, g.grade, g.u, p.whole, CASE WHEN p.p > 0 THEN (g.u / (1.0 - g.u)) * ((1.0 - p.p) / p.p) END AS odds
  FROM graded g JOIN plan p ON p.source IS NOT DISTINCT FROM g.source AND p.grade = g.grade
), placed AS (
  SELECT *, odds / (1.0 + odds) AS q FROM ranked
), state0 AS (
  SELECT source, min(target) - sum(CAST(whole * words AS DOUBLE)) AS room, 0.0::DOUBLE AS at, 'inf'::DOUBLE AS most FROM plan GROUP BY source
)"""
    for k in range(passes):
        sql += f"""
, open{k} AS (
  SELECT p.source, p.q, p.size, s.room, sum(p.size) OVER (PARTITION BY p.source ORDER BY q) AS upto
  FROM placed p JOIN state{k} s ON s.source IS NOT DISTINCT FROM p.source WHERE q >= s.at AND size <= s.most
), cut{k} AS (
  SELECT o.source, min(CASE WHEN upto > room THEN q END) AS cut, max(CASE WHEN upto <= room THEN upto ELSE 0 END) AS used FROM open{k} o GROUP BY o.source
), state{k + 1} AS (
  SELECT s.source, CASE WHEN c.cut IS NULL THEN -1.0 ELSE s.room - c.used END AS room, coalesce(c.cut, 2.0) AS at,
    CASE WHEN c.cut IS NULL THEN -1.0 ELSE s.room - c.used END AS most
  FROM state{k} s LEFT JOIN cut{k} c ON c.source IS NOT DISTINCT FROM s.source
)"""
    drawn = " OR ".join(f"(p.q >= s{k}.at AND p.q < s{k + 1}.at AND p.size <= s{k}.most)" for k in range(passes))
    joins = " ".join(f"LEFT JOIN state{k} s{k} ON s{k}.source IS NOT DISTINCT FROM p.source" for k in range(passes + 1))
    return sql + f"""
, taken AS (
  SELECT p.doc_id, p.source, p.size, p.u, p.whole + CASE WHEN {drawn} THEN 1 ELSE 0 END AS copies FROM placed p {joins}
)
SELECT z.doc_id, z.size, w.source_size, w.target, CAST(coalesce(t.copies, 0) * z.size AS BIGINT) AS taken
FROM sized z JOIN wanted w ON w.source IS NOT DISTINCT FROM z.source LEFT JOIN taken t ON t.doc_id IS NOT DISTINCT FROM z.doc_id AND t.u = z.u
"""


SQL = {
    "op1_embedding_near_dedup": OP1,
    "op4_ngram_jaccard_join": OP4,
    "op7_benchmark_decontamination": OP7,
    "op8_warc_fixity": OP8,
    "op10_line_dedup": OP10,
    "op11_collocations": OP11,
    "op13_source_mix": _op13(),
}
