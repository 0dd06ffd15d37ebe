"""DuckDB SQL for the registered queries, written independently of the Spark code.

Polygon tests use the closed form of the fixture shapes (unions of rectangles), chunks
come from a recursive query, searches from plain joins over all pairs.
"""

from __future__ import annotations


def num(e: str) -> str:
    return f"regexp_replace(CAST({e} AS VARCHAR), '\\.0$', '')"


def pt(x: str, y: str) -> str:
    return f"{num(x)} || ' ' || {num(y)}"


def ring(*corners: tuple[str, str]) -> str:
    return "'(' || " + " || ',' || ".join(pt(x, y) for x, y in [*corners, corners[0]]) + " || ')'"


def box(x: float, y: float, w: float, h: float) -> str:
    return ring(*[(f"(x0 + {a})", f"(y0 + {b})")
                  for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))])


def vec(e: str) -> str:
    return f"array_to_string(list_transform({e}, lambda v: printf('%.5f', v + 0.0)), ',')"


_BENT = ring(*[(f"(x0 + {a})", f"(y0 + {b})") for a, b in (
    (0.0, 0.0), (12.0, 0.0), (12.0, 2.5), (6.0, 2.5), (6.0, 5.0), (0.0, 5.0))])


def _significant(x: str) -> str:
    """``x`` rounded to nine significant digits."""
    scale = f"pow(10, 8 - floor(log10(abs({x}))))"
    return f"CASE WHEN {x} = 0 THEN 0 ELSE round(({x}) * {scale}) / {scale} END"


_R2 = "ROUND(CAST(AVG({0}) AS DECIMAL(30,12)), 2)::DOUBLE"
_CLEAN = ("trim(regexp_replace(regexp_replace({0}, '[\\s\\x0b]+', ' ', 'g'), "
          "'[^\\x00-\\x7F]+', '', 'g'))")
_STRIP = "' ' || chr(28) || chr(29) || chr(30) || chr(31)"
_SPHERE = ("2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians({3} - {1}) / 2), 2) + "
           "cos(radians({1})) * cos(radians({3})) * pow(sin(radians({2} - {0}) / 2), 2))))")

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    # ------------------------------------------------------------ events
    "ev_raw": ((), """
        SELECT CASE WHEN event_id % 103 <> 0 THEN 'ev' || event_id END AS event_id,
               event_id AS i, epoch_us(ts) // 1000 + ver AS event_time,
               CASE WHEN event_id % 97 = 0 THEN 95e0 ELSE
                    CAST((event_id * 104729) % 2600 AS DOUBLE) / 100e0 + 24e0 + 0.005e0 END
                    AS latitude,
               CASE WHEN event_id % 101 <> 0 THEN
                    CAST((event_id * 7919) % 5900 AS DOUBLE) / 100e0 - 125e0 + 0.005e0 END
                    AS longitude,
               CASE WHEN event_id % 13 <> 0 THEN value END AS depth_km,
               2.5e0 + CAST((event_id * 31) % 50 AS DOUBLE) / 8e0 AS magnitude,
               event_type || ' near ' || user_id AS place
        FROM events, (VALUES (0), (1)) versions(ver)
        WHERE ver = 0 OR event_id % 50 = 0"""),
    "ev": (("ev_raw",), f"""
        SELECT * EXCLUDE (rn), make_timestamp(event_time * 1000) AS event_timestamp,
               'POINT(' || {pt('longitude', 'latitude')} || ')' AS location_point
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_time DESC) AS rn
              FROM ev_raw
              WHERE event_id IS NOT NULL AND latitude BETWEEN -90 AND 90
                AND longitude BETWEEN -180 AND 180)
        WHERE rn = 1"""),
    # ------------------------------------------------------------ polygons
    "nat": ((), """
        SELECT n_nationkey AS k, n_name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_fips,
               -125e0 + 12e0 * (n_nationkey % 5) AS x0, 24e0 + 5e0 * (n_nationkey // 5) AS y0
        FROM nation"""),
    "shape_parts": ((), """
        SELECT * FROM (VALUES
            (0, 0e0, 0e0, 12e0, 5e0),
            (1, 0e0, 0e0, 12e0, 2.5e0), (1, 0e0, 2.5e0, 6e0, 5e0),
            (2, 0e0, 0e0, 12e0, 1.5e0), (2, 0e0, 3.5e0, 12e0, 5e0),
            (2, 0e0, 1.5e0, 4e0, 3.5e0), (2, 8e0, 1.5e0, 12e0, 3.5e0),
            (3, 0e0, 0e0, 4e0, 5e0), (3, 8e0, 0e0, 12e0, 5e0)) t(shape, a1, b1, a2, b2)"""),
    "state_rects": (("nat", "shape_parts"), """
        SELECT state_fips, x0 + a1 AS x1, y0 + b1 AS y1, x0 + a2 AS x2, y0 + b2 AS y2
        FROM nat JOIN shape_parts ON shape = k % 4 WHERE k <> 24
        UNION ALL SELECT '98', 100e0, -50e0, 101e0, -49e0"""),
    "state_centres": (("state_rects",), """
        SELECT state_fips, SUM((x2 - x1) * (y2 - y1)) AS area,
               SUM((x2 - x1) * (y2 - y1) * (x1 + x2) / 2) / SUM((x2 - x1) * (y2 - y1)) AS cx,
               SUM((x2 - x1) * (y2 - y1) * (y1 + y2) / 2) / SUM((x2 - x1) * (y2 - y1)) AS cy
        FROM state_rects GROUP BY state_fips"""),
    "states": (("nat", "state_centres"), f"""
        SELECT s.*, ROUND(c.cy, 6) AS centroid_lat, ROUND(c.cx, 6) AS centroid_lon
        FROM (SELECT state_fips, 'S' || k AS state_code, n_name AS state_name,
                CASE WHEN k = 24 THEN NULL
                     WHEN k % 4 = 0 THEN 'POLYGON(' || {box(0.0, 0.0, 12.0, 5.0)} || ')'
                     WHEN k % 4 = 1 THEN 'POLYGON(' || {_BENT} || ')'
                     WHEN k % 4 = 2 THEN 'POLYGON(' || {box(0.0, 0.0, 12.0, 5.0)} || ',' ||
                          {box(4.0, 1.5, 4.0, 2.0)} || ')'
                     ELSE 'MULTIPOLYGON((' || {box(0.0, 0.0, 4.0, 5.0)} || '),(' ||
                          {box(8.0, 0.0, 4.0, 5.0)} || '))' END AS geometry
              FROM nat
              UNION ALL SELECT '98', 'SX', 'FAR',
                'POLYGON((100 -50,101 -50,101 -49,100 -49,100 -50))') s
        LEFT JOIN state_centres c USING (state_fips)"""),
    "county_rects": (("nat",), """
        SELECT state_fips, 'County_' || (q % 3) AS county_name,
               x0 + 6e0 * (q % 2) AS x0, y0 + 2.5e0 * (q // 2) AS y0, 6e0 AS w, 2.5e0 AS h
        FROM nat, (VALUES (0), (1), (2), (3)) quarters(q)
        UNION ALL SELECT '99', 'County_0', -120e0, 30e0, 1e0, 1e0"""),
    "counties": (("county_rects",), f"""
        SELECT state_fips, county_name, x0, y0, w, h,
               'POLYGON(' || {ring(('x0', 'y0'), ('(x0 + w)', 'y0'), ('(x0 + w)', '(y0 + h)'),
                                   ('x0', '(y0 + h)'))} || ')' AS geometry,
               ROUND(y0 + h / 2, 6) AS centroid_lat, ROUND(x0 + w / 2, 6) AS centroid_lon
        FROM county_rects"""),
    "in_state": (("ev", "state_rects"), """
        SELECT e.*, r.state_fips FROM ev e JOIN state_rects r
          ON longitude > x1 AND longitude < x2 AND latitude > y1 AND latitude < y2"""),
    "gold_state": (("states", "in_state"), f"""
        SELECT s.state_fips, s.state_code, s.state_name, s.geometry, s.centroid_lat,
               s.centroid_lon, COUNT(e.event_id) AS earthquake_count,
               {_R2.format('magnitude')} AS avg_magnitude,
               ROUND(MAX(magnitude), 2) AS max_magnitude,
               COUNT(CASE WHEN magnitude >= 5 THEN 1 END) AS significant_count
        FROM states s LEFT JOIN in_state e ON s.state_fips = e.state_fips
        GROUP BY ALL"""),
    "gold_county": (("counties", "states", "ev"), f"""
        SELECT c.state_fips, c.county_name, c.geometry, c.centroid_lat, c.centroid_lon,
               s.state_name, s.state_code, COUNT(e.event_id) AS earthquake_count,
               {_R2.format('magnitude')} AS avg_magnitude,
               ROUND(MAX(magnitude), 2) AS max_magnitude
        FROM counties c LEFT JOIN states s ON c.state_fips = s.state_fips
        LEFT JOIN ev e ON longitude > x0 AND longitude < x0 + w
                      AND latitude > y0 AND latitude < y0 + h
        GROUP BY ALL"""),
    "own_cell": (("ev", "nat"), """
        SELECT e.event_id, longitude, latitude, n.state_fips, n.k
        FROM ev e LEFT JOIN nat n ON longitude >= x0 AND longitude < x0 + 12
                                 AND latitude >= y0 AND latitude < y0 + 5"""),
    # ------------------------------------------------------------ documents
    "paper": ((), f"""
        SELECT doc_id, 'doc_' || doc_id || '.txt' AS file_name, source AS source_url,
               text AS raw_content, {_CLEAN.format('text')} AS c
        FROM documents"""),
    "clean": (("paper",), "SELECT *, length(c) AS n FROM paper WHERE length(c) > 100"),
    "cuts": (("clean",), """
        SELECT file_name, c, n, 0 AS s, 0 AS stop, 0 AS step FROM clean
        UNION ALL
        SELECT file_name, c, n, CASE WHEN e < n THEN e - 50 ELSE -1 END, e, step + 1
        FROM (SELECT file_name, c, n, s, step,
                CASE WHEN s + 500 >= n THEN s + 500
                     WHEN h > 0 THEN s + 502 - h ELSE s + 500 END AS e
              FROM (SELECT *, instr(reverse(translate(substr(c, s + 402, 100),
                                    '!?' || chr(10), '...')), '.') AS h
                    FROM cuts WHERE s >= 0))"""),
    "spans": (("cuts",), f"""
        SELECT file_name, step, trim(substr(c, start + 1, stop - start), {_STRIP}) AS chunk_text
        FROM (SELECT file_name, c, step, stop,
                CASE WHEN step = 1 THEN 0 ELSE lag(s) OVER (PARTITION BY file_name ORDER BY step)
                END AS start
              FROM cuts)
        WHERE step > 0"""),
    "chunk_pos": (("spans",), """
        SELECT file_name, chunk_text, sha256(file_name || '_' || chunk_text) AS chunk_id,
               length(chunk_text) AS chunk_length,
               row_number() OVER (PARTITION BY file_name ORDER BY step) - 1 AS chunk_position
        FROM spans WHERE chunk_text <> ''"""),
    "chunks": (("chunk_pos",), """
        SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY chunk_id, chunk_position)
                  AS chunk_sequence
        FROM chunk_pos"""),
    "idx": (("chunk_pos",), """
        SELECT chunk_id, file_name, chunk_text, chunk_length,
               MIN(chunk_position) AS chunk_position,
               regexp_extract_all(lower(chunk_text), '[a-z0-9]+') AS tokens
        FROM chunk_pos GROUP BY chunk_id, file_name, chunk_text, chunk_length"""),
    "qs": ((), """
        SELECT item_id AS query_id, text AS query,
               list_sort(list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z]+'),
                                                   lambda w: length(w) > 7))) AS keywords,
               'cat_' || (item_id % 5) AS category
        FROM benchmark"""),
    # ------------------------------------------------------------ search
    "chunk_bucket": (("idx",), """
        SELECT chunk_id, b, n / sqrt(SUM(n * n) OVER (PARTITION BY chunk_id)) AS v
        FROM (SELECT chunk_id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS b,
                     COUNT(*)::DOUBLE AS n
              FROM (SELECT chunk_id, unnest(tokens) AS t FROM idx) GROUP BY ALL)"""),
    "query_bucket": (("qs",), """
        SELECT query_id, b, n / sqrt(SUM(n * n) OVER (PARTITION BY query_id)) AS v
        FROM (SELECT query_id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS b,
                     COUNT(*)::DOUBLE AS n
              FROM (SELECT query_id, unnest(regexp_extract_all(lower(query), '[a-z0-9]+')) AS t
                    FROM qs) GROUP BY ALL)"""),
    "ann_list": (("chunk_bucket", "query_bucket"), f"""
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
        FROM (SELECT query_id, chunk_id, {_significant("SUM(q.v * c.v)")} AS score
              FROM query_bucket q JOIN chunk_bucket c USING (b) GROUP BY ALL)"""),
    "corpus": (("idx",), "SELECT COUNT(*) AS n, SUM(len(tokens)) / COUNT(*) AS avgdl FROM idx"),
    "ft_list": (("idx", "qs", "corpus"), f"""
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
        FROM (SELECT query_id, chunk_id, {_significant("s")} AS score FROM (
              SELECT query_id, chunk_id, SUM(
                ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))) AS s
              FROM (SELECT *, COUNT(*) OVER (PARTITION BY t) AS df
                    FROM (SELECT chunk_id, len(tokens) AS dl, t, COUNT(*) AS tf
                          FROM (SELECT chunk_id, tokens, unnest(tokens) AS t FROM idx)
                          GROUP BY ALL)) p
              JOIN (SELECT DISTINCT query_id,
                           unnest(regexp_extract_all(lower(query), '[a-z0-9]+')) AS t
                    FROM qs) q USING (t), corpus
              GROUP BY query_id, chunk_id))"""),
    "ft_norm": (("ft_list",), """
        SELECT query_id, chunk_id, score, rank, (score - lo) / CASE WHEN hi = lo THEN 1.0
               ELSE hi - lo END AS normalized_score
        FROM (SELECT *, MIN(score) OVER (PARTITION BY query_id) AS lo,
                     MAX(score) OVER (PARTITION BY query_id) AS hi
              FROM ft_list WHERE rank <= 10)"""),
    "hybrid_all": (("ann_list", "ft_list"), f"""
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
        FROM (SELECT query_id, chunk_id, a.score AS vector_score, f.score AS keyword_score,
                     {_significant("""coalesce(1.0::DOUBLE / (60 + a.rank), 0)
                             + coalesce(1.0::DOUBLE / (60 + f.rank), 0)""")} AS score
              FROM ann_list a FULL JOIN ft_list f USING (query_id, chunk_id))"""),
    "hybrid_list": (("hybrid_all",), "SELECT * FROM hybrid_all WHERE rank <= 10"),
    "hybrid": (("hybrid_list", "qs", "idx"), """
        SELECT h.*, len(list_filter(keywords, lambda w: contains(lower(chunk_text), w)))
                    AS keyword_matches
        FROM hybrid_list h JOIN qs USING (query_id) JOIN idx USING (chunk_id)"""),
    "results": (("ann_list", "ft_norm", "hybrid_list", "idx"), """
        SELECT query_id, method, rank, chunk_id, file_name,
               CASE WHEN length(chunk_text) > 200 THEN substr(chunk_text, 1, 200) || '...'
                    ELSE chunk_text END AS text, score
        FROM (SELECT query_id, 'ANN' AS method, rank, chunk_id, score FROM ann_list
              WHERE rank <= 10
              UNION ALL SELECT query_id, 'Full-Text', rank, chunk_id, normalized_score
              FROM ft_norm
              UNION ALL SELECT query_id, 'Hybrid', rank, chunk_id, score FROM hybrid_list)
        JOIN idx USING (chunk_id)"""),
    # ------------------------------------------------------------ vectors
    "vecs": ((), """
        SELECT vec_id, label, sha256(CAST(vec_id AS VARCHAR)) AS chunk_id,
               'vec_' || vec_id AS file_name, CAST(embedding AS DOUBLE[]) AS embedding
        FROM embeddings"""),
    "label_q": (("vecs",), """
        SELECT label AS query_id, list(m ORDER BY d) AS q
        FROM (SELECT label, d, ROUND(AVG(v), 6) AS m
              FROM (SELECT label, unnest(embedding) AS v,
                           generate_subscripts(embedding, 1) AS d FROM vecs)
              GROUP BY label, d)
        GROUP BY label"""),
    "vec_cells": (("vecs", "label_q"), """
        SELECT vec_id, arg_min(label_q.query_id, (list_distance(embedding, q), label_q.query_id)) AS cell
        FROM vecs, label_q GROUP BY vec_id"""),
    "probed": (("label_q",), """
        SELECT a.query_id, b.query_id AS cell FROM label_q a, label_q b
        QUALIFY row_number() OVER (PARTITION BY a.query_id
                                   ORDER BY list_distance(a.q, b.q), b.query_id) <= 4"""),
    "planes": ((), """
        SELECT t, d, sin(pow(t * 64 + d, 2)) AS w FROM range(8) x(t), range(1, 65) y(d)"""),
    "vec_buckets": (("vecs", "planes"), """
        SELECT vec_id, t, floor(SUM(v * w) / 0.5) AS bucket
        FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS d FROM vecs)
        JOIN planes USING (d) GROUP BY vec_id, t"""),
    "query_buckets": (("label_q", "planes"), """
        SELECT query_id, t, floor(SUM(v * w) / 0.5) AS bucket
        FROM (SELECT query_id, unnest(q) AS v, generate_subscripts(q, 1) AS d FROM label_q)
        JOIN planes USING (d) GROUP BY query_id, t"""),
    "batch": (("vecs",), """
        SELECT CASE WHEN label = 3 THEN NULL WHEN label % 2 = 0 THEN chunk_id
                    ELSE sha256(CAST(vec_id + 1000000 AS VARCHAR)) END AS chunk_id,
               file_name,
               CASE WHEN label = 7 THEN embedding[1:3]
                    WHEN label % 2 = 0 AND ver = 0
                    THEN list_transform(embedding, lambda x: -x) ELSE embedding END AS embedding,
               vec_id + ver AS position
        FROM vecs, (VALUES (0), (1)) versions(ver) WHERE ver = 0 OR label = 0"""),
    "upserted": (("vecs", "batch"), """
        WITH good AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY position)
                                   AS rn
                         FROM batch WHERE chunk_id IS NOT NULL AND len(embedding) = 64)
          WHERE rn = 1)
        SELECT chunk_id, file_name, embedding FROM vecs
        WHERE chunk_id NOT IN (SELECT chunk_id FROM good)
        UNION ALL SELECT chunk_id, file_name, embedding FROM good"""),
    # ------------------------------------------------------------ benchmark runs
    "runs": ((), """
        SELECT user_id AS query_id, 'cat_' || (user_id % 5) AS category,
               ['ANN', 'Full-Text', 'Hybrid'][event_id % 3 + 1] AS method,
               event_id AS iteration, event_type <> 'error' AS success,
               10e0 + value AS latency_ms,
               CASE WHEN event_type <> 'error'
                    THEN CAST(json_extract_string(props, '$.k') AS INT) % 11 ELSE 0 END
                    AS num_results
        FROM events"""),
    "averages": (("runs",), """
        SELECT * FROM (
          SELECT query_id, category, method,
                 AVG(latency_ms) FILTER (success) AS avg_latency_ms,
                 MIN(latency_ms) FILTER (success) AS min_latency_ms,
                 MAX(latency_ms) FILTER (success) AS max_latency_ms,
                 arg_max(num_results, iteration)::BIGINT AS num_results
          FROM runs GROUP BY ALL)
        WHERE avg_latency_ms IS NOT NULL"""),
    "overlap_rows": (("results", "qs"), """
        SELECT q.query_id, substr(query, 1, 40) || '...' AS query_label, category,
               len(list_intersect(a, f)) AS ann_ft, len(list_intersect(a, h)) AS ann_hybrid,
               len(list_intersect(f, h)) AS ft_hybrid,
               len(list_intersect(list_intersect(a, f), h)) AS all_three,
               len(a) AS ann_results, len(f) AS ft_results, len(h) AS hybrid_results
        FROM qs q JOIN (
          SELECT query_id,
                 coalesce(list(DISTINCT chunk_id) FILTER (method = 'ANN'), []) AS a,
                 coalesce(list(DISTINCT chunk_id) FILTER (method = 'Full-Text'), []) AS f,
                 coalesce(list(DISTINCT chunk_id) FILTER (method = 'Hybrid'), []) AS h
          FROM results GROUP BY query_id) USING (query_id)"""),
    # ------------------------------------------------------------ papers
    "pj": ((), """
        SELECT coalesce(CASE WHEN doc_id % 3 <> 0 THEN 'PMC' || doc_id END,
                        CASE WHEN doc_id % 2 <> 0 THEN CAST(doc_id AS VARCHAR) END,
                        'paper_' || row_number() OVER (PARTITION BY doc_id // 500
                                                       ORDER BY doc_id)) AS paper_id,
               CASE WHEN doc_id % 5 <> 0 THEN 'Paper / ' || source || ' ' || doc_id
                    ELSE 'No title' END AS title,
               CASE WHEN doc_id % 7 <> 0 THEN text ELSE '' END AS abstract,
               CASE WHEN doc_id % 4 <> 0 THEN 'Author ' || doc_id ELSE 'Unknown' END AS authors,
               CASE WHEN doc_id % 6 <> 0 THEN source ELSE 'Unknown' END AS journal,
               CASE WHEN doc_id % 8 <> 0 THEN '2024' ELSE 'Unknown' END AS pub_year,
               CASE WHEN doc_id % 9 <> 0 THEN '10.1/' || doc_id ELSE '' END AS doi,
               'query ' || (doc_id // 500) AS query,
               COUNT(*) OVER (PARTITION BY doc_id // 500) AS hit_count
        FROM documents"""),
}

_RECURSIVE = {"cuts"}


def sql(body: str, *needs: str) -> str:
    """``body`` with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body
    word = "WITH RECURSIVE" if _RECURSIVE & set(order) else "WITH"
    ctes = ",\n".join(
        f"{n}{'' if n in _RECURSIVE else ' AS MATERIALIZED' if n in _SHARED else ' AS'}"
        f"{' AS' if n in _RECURSIVE else ''} ({CTES[n][1]})" for n in order)
    return f"{word} {ctes}\n{body}"


_SHARED = {"ev", "clean", "spans", "chunk_pos", "idx", "ann_list", "ft_list", "results",
           "chunk_bucket", "vecs", "in_state"}

_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%g')"
_SIX = "ROUND({0}, 6) + 0.0"
_EVENT_COLUMNS = f"""event_id, {_STAMP.format('event_timestamp')} AS event_timestamp,
    CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date, latitude, longitude,
    depth_km, magnitude, place, location_point, location_point AS location_geography"""


def _topk(score: str, where: str = "TRUE", *needs: str) -> str:
    return sql(f"""SELECT query_id, chunk_id, ROUND(score, 6) AS score, rank
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id)
                        AS rank
              FROM (SELECT query_id, chunk_id, {_significant("s")} AS score FROM (
                    SELECT CAST(query_id AS BIGINT) AS query_id, chunk_id, {score} AS s FROM vecs, label_q WHERE {where})))
        WHERE rank <= 10""", "vecs", "label_q", *needs)


_IN_PROBED_CELL = """(query_id, (SELECT cell FROM vec_cells c WHERE c.vec_id = vecs.vec_id)) IN (
    SELECT query_id, cell FROM probed)"""
_IN_BUCKET = """(query_id, vecs.vec_id) IN (
    SELECT q.query_id, v.vec_id FROM vec_buckets v JOIN query_buckets q USING (t, bucket))"""
_COSINE = "list_cosine_similarity(embedding, q)"
_RECALL = sql(f"""
    SELECT e.query_id, ROUND(COUNT(a.chunk_id) / COUNT(*)::DOUBLE, 6) AS recall
    FROM ({_topk(_COSINE)}) e
    LEFT JOIN ({_topk(_COSINE, _IN_PROBED_CELL, "vec_cells", "probed")}) a USING (query_id, chunk_id)
    GROUP BY e.query_id""")


_LSH_RECALL = sql(f"""
    SELECT e.query_id, ROUND(COUNT(a.chunk_id) / COUNT(*)::DOUBLE, 6) AS recall
    FROM ({_topk(_COSINE)}) e
    LEFT JOIN ({_topk(_COSINE, _IN_BUCKET, "vec_buckets", "query_buckets")}) a USING (query_id, chunk_id)
    GROUP BY e.query_id""")


def _pivot(value: str, digits: int, source: str, *needs: str) -> str:
    cells = ", ".join(f"ROUND(AVG({value}) FILTER (method = '{m}'), {digits}) AS \"{m}\""
                      for m in ("ANN", "Full-Text", "Hybrid"))
    return sql(f"SELECT category, {cells} FROM {source} GROUP BY category", *needs)


def _five(source: str, value: str, measure: str) -> str:
    quantiles = ", ".join(f"ROUND(quantile_cont({value}, {p}), 5) AS {n}" for p, n in (
        (0, "lowest"), (0.25, "quartile_1"), (0.5, "median"), (0.75, "quartile_3"),
        (1, "highest")))
    return f"SELECT method, '{measure}' AS measure, {quantiles} FROM {source} GROUP BY method"


def _summary(source: str, value: str, digits: int, *needs: str) -> str:
    return sql(f"""SELECT method, ROUND(AVG({value}), {digits}) AS mean,
        ROUND(MIN({value}), {digits}) AS min, ROUND(MAX({value}), {digits}) AS max,
        ROUND(STDDEV_SAMP({value}), {digits}) AS std FROM {source} GROUP BY method""", *needs)


_RENDERED = ("'PAPER ID: ' || paper_id || chr(10) || 'TITLE: ' || title || chr(10) || "
             "'AUTHORS: ' || authors || chr(10) || 'JOURNAL: ' || journal || chr(10) || "
             "'YEAR: ' || pub_year || chr(10) || 'DOI: ' || doi || chr(10) || chr(10) || "
             "'ABSTRACT:' || chr(10) || abstract || chr(10) || chr(10) || '---' || chr(10) || "
             "'Full metadata available in JSON file.' || chr(10)")

_STATE_EDGES = [  # corners of every ring, by shape
    (0, [(0, 0), (12, 0), (12, 5), (0, 5)]),
    (1, [(0, 0), (12, 0), (12, 2.5), (6, 2.5), (6, 5), (0, 5)]),
    (2, [(0, 0), (12, 0), (12, 5), (0, 5)]),
    (2, [(4, 1.5), (8, 1.5), (8, 3.5), (4, 3.5)]),
    (3, [(0, 0), (4, 0), (4, 5), (0, 5)]),
    (3, [(8, 0), (12, 0), (12, 5), (8, 5)]),
]


def _edges() -> str:
    rows = []
    for shape, corners in _STATE_EDGES:
        for a, b in zip(corners, [*corners[1:], corners[0]]):
            rows.append(f"({shape}, {a[0]}e0, {a[1]}e0, {b[0]}e0, {b[1]}e0)")
    far = [(100, -50), (101, -50), (101, -49), (100, -49)]
    stray = ", ".join(f"('98', {a[0]}e0, {a[1]}e0, {b[0]}e0, {b[1]}e0)"
                      for a, b in zip(far, [*far[1:], far[0]]))
    return sql(f"""SELECT state_fips, x0 + a1 AS x1, y0 + b1 AS y1, x0 + a2 AS x2, y0 + b2 AS y2
        FROM nat JOIN (VALUES {", ".join(rows)}) e(shape, a1, b1, a2, b2) ON shape = k % 4
        WHERE k <> 24 UNION ALL SELECT * FROM (VALUES {stray}) f""", "nat")


def all_oracles() -> dict[str, str]:
    parts_hit = """EXISTS (SELECT 1 FROM state_rects r WHERE r.state_fips = o.state_fips
        AND longitude > x1 AND longitude < x2 AND latitude > y1 AND latitude < y2)"""
    inside = f"CASE WHEN k = 24 OR k IS NULL THEN NULL ELSE {parts_hit} END"
    oracles = {
        # -------------------------------------------------------- sources
        "src_geojson_features": sql(
            "SELECT event_id, event_time, latitude, longitude, depth_km, magnitude, place "
            "FROM ev_raw", "ev_raw"),
        "src_boundary_wkt": sql(
            "SELECT 'geojson' AS format, state_fips, state_code, state_name, geometry "
            "FROM states UNION ALL "
            "SELECT 'wkt', state_fips, state_code, state_name, geometry FROM states", "states"),
        "src_binary_files": sql(
            "SELECT file_name, octet_length(encode(raw_content)) + 1 AS size_bytes, "
            "sha256(raw_content || chr(10)) AS content_hash FROM paper", "paper"),
        "src_file_inventory": sql(
            "SELECT file_name, b AS size_bytes, ROUND(b / 1048576.0, 2) AS size_mb FROM "
            "(SELECT file_name, octet_length(encode(raw_content)) + 1 AS b FROM paper)", "paper"),
        "src_wholetext": sql("SELECT file_name, raw_content FROM paper", "paper"),
        "src_paper_json": sql("SELECT * FROM pj", "pj"),
        "paper_render_text": sql(
            f"SELECT query, paper_id, {_RENDERED} AS content FROM pj", "pj"),
        "extract_abstract": sql("SELECT query, paper_id, abstract FROM pj", "pj"),
        "extract_model_hook": sql("SELECT query, paper_id, abstract FROM pj", "pj"),
        "ingest_summary": sql("""
            SELECT query, '20240101_000000' AS timestamp, hit_count AS total_available,
                   COUNT(*) OVER (PARTITION BY query) AS papers_downloaded, paper_id,
                   CASE WHEN length(title) > 100 THEN substr(title, 1, 100) || '...'
                        ELSE title END AS title,
                   'paper_' || replace(replace(paper_id, '/', '_'), ' ', '_')
                   || '_20240101_000000.txt' AS text_file,
                   replace(text_file, '.txt', '.json') AS json_file
            FROM pj""", "pj"),
        "src_atom_xml": """
            SELECT page_id || 'v1' AS paper_id, 'Page ' || url AS title,
                   CASE WHEN page_id % 2 = 0
                        THEN 'http://papers.example/files/' || page_id || '.pdf'
                        ELSE 'http://papers.example/pdf/' || page_id || 'v1.pdf' END AS pdf_url
            FROM pages""",
        "scalar_safe_name": """
            SELECT page_id, replace(replace(url, '/', '_'), ' ', '_') AS safe_id,
                   substr(replace(trim(regexp_replace(url, '[^\\p{L}\\p{N} _-]', '', 'g')),
                                  ' ', '_'), 1, 50) AS safe_title
            FROM pages""",
        "ingest_time_filter": sql("""
            SELECT event_id, event_time, magnitude FROM ev_raw
            WHERE event_time BETWEEN epoch_ms(TIMESTAMP '2024-01-15') AND
                  epoch_ms(TIMESTAMP '2024-01-25') AND magnitude >= 4""", "ev_raw"),
        "json_path_elements": """
            SELECT doc_id, '2.0' AS version, position, type,
                   CASE WHEN position = 0 THEN source ELSE text END AS content
            FROM documents, (VALUES (0::BIGINT, 'title'), (1::BIGINT, 'text')) e(position, type)""",
        # -------------------------------------------------------- sinks
        "sink_roundtrip": sql(
            "SELECT event_id, event_time, latitude, longitude, depth_km, magnitude, place "
            "FROM ev_raw", "ev_raw"),
        "sink_partitioned_events": sql("""
            SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date,
                   COUNT(*) AS n, SUM(magnitude) AS total FROM ev GROUP BY 1""", "ev"),
        "sink_save_table": sql("""
            SELECT state_fips, earthquake_count, avg_magnitude FROM gold_state""", "gold_state"),
        "iso_stamps": sql("""
            SELECT event_id, CASE WHEN microsecond(event_timestamp) % 1000000 = 0
                     THEN strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S')
                     ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') END AS iso,
                   strftime(event_timestamp, '%Y%m%d_%H%M%S') AS stamp FROM ev""", "ev"),
        "embed_model_hook": sql("""
            SELECT file_name, CASE WHEN ok THEN length(c) ELSE 0 END::DOUBLE AS a,
                   CASE WHEN ok THEN length(c) - length(replace(c, ' ', '')) ELSE 0 END::DOUBLE AS b,
                   CASE WHEN ok THEN length(c) - length(replace(c, ',', '')) ELSE 0 END::DOUBLE AS c,
                   ok AS embedding_ok
            FROM (SELECT *, NOT regexp_matches(c, '[0-9]') AS ok FROM clean)""", "clean"),
        "search_columns": sql("""
            SELECT query_id, chunk_id, rank, file_name
            FROM ft_list JOIN idx USING (chunk_id) WHERE rank <= 10""", "ft_list", "idx"),
        "sql_functions": sql(f"""
            SELECT o.event_id, {inside} AS contained,
                   ROUND(sqrt(pow(longitude - cx, 2) + pow(latitude - cy, 2)), 6) AS distance
            FROM own_cell o LEFT JOIN state_centres c ON o.state_fips = c.state_fips""",
            "own_cell", "state_rects", "state_centres"),
        "index_failed_keys": sql(
            "SELECT chunk_id FROM batch WHERE chunk_id IS NULL OR len(embedding) <> 64", "batch"),
        "sink_merge_schema": sql("""
            SELECT state_fips, state_name, NULL::VARCHAR AS geometry, 1::BIGINT AS version
            FROM states
            UNION ALL SELECT state_fips, state_name, geometry, 2 FROM states""", "states"),
        "change_feed_diff": sql("""
            SELECT coalesce(a.chunk_id, b.chunk_id) AS chunk_id,
                   CASE WHEN a.chunk_id IS NULL THEN 'insert'
                        WHEN b.chunk_id IS NULL THEN 'delete' ELSE 'update' END AS change_type
            FROM vecs a FULL JOIN (
                SELECT * FROM upserted
                WHERE chunk_id NOT IN (SELECT chunk_id FROM vecs WHERE label = 1)) b
              ON a.chunk_id = b.chunk_id
            WHERE a.chunk_id IS NULL OR b.chunk_id IS NULL OR a.embedding <> b.embedding""",
            "vecs", "upserted"),
        "change_feed_log": sql("""
            SELECT coalesce(a.chunk_id, b.chunk_id) AS chunk_id,
                   CASE WHEN a.chunk_id IS NULL THEN 'insert'
                        WHEN b.chunk_id IS NULL THEN 'delete' ELSE 'update' END AS change_type
            FROM vecs a FULL JOIN (
                SELECT * FROM upserted
                WHERE chunk_id NOT IN (SELECT chunk_id FROM vecs WHERE label = 1)) b
              ON a.chunk_id = b.chunk_id
            WHERE a.chunk_id IS NULL OR b.chunk_id IS NULL OR a.embedding <> b.embedding""",
            "vecs", "upserted"),
        # -------------------------------------------------------- silver and gold
        "silver_events": sql(f"SELECT {_EVENT_COLUMNS} FROM ev", "ev"),
        "silver_states": sql("SELECT * FROM states", "states"),
        "silver_counties": sql(
            "SELECT state_fips, county_name, geometry, centroid_lat, centroid_lon "
            "FROM counties", "counties"),
        "spatial_left_join_state": sql("""
            SELECT s.state_fips, s.state_name, e.event_id
            FROM states s LEFT JOIN in_state e ON s.state_fips = e.state_fips""",
            "states", "in_state"),
        "spatial_inner_join_state": sql("""
            SELECT s.state_name, COUNT(*) AS earthquake_count
            FROM states s JOIN in_state e ON s.state_fips = e.state_fips
            GROUP BY s.state_name""", "states", "in_state"),
        "county_state_lookup": sql("""
            SELECT c.state_fips, county_name, c.geometry, c.centroid_lat, c.centroid_lon,
                   state_name, state_code
            FROM counties c LEFT JOIN states s ON c.state_fips = s.state_fips""",
            "counties", "states"),
        "gold_by_state": sql("SELECT * FROM gold_state", "gold_state"),
        "gold_by_county": sql("SELECT * FROM gold_county", "gold_county"),
        "spatial_within_distance": sql(f"""
            SELECT event_id, state_fips, ROUND(d, 3) AS distance_m
            FROM (SELECT event_id, state_fips,
                         {_SPHERE.format('longitude', 'latitude', 'cx', 'cy')} AS d
                  FROM ev, state_centres) WHERE d <= 150000""", "ev", "state_centres"),
        # -------------------------------------------------------- dashboards
        "top10_states": sql(f"""
            SELECT s.state_name, COUNT(e.event_id) AS earthquake_count,
                   {_R2.format('magnitude')} AS avg_magnitude,
                   ROUND(MAX(magnitude), 2) AS max_magnitude
            FROM states s LEFT JOIN in_state e ON s.state_fips = e.state_fips
            GROUP BY s.state_name ORDER BY earthquake_count DESC, s.state_name LIMIT 10""",
            "states", "in_state"),
        "top15_states": sql("""
            SELECT state_fips, state_name, earthquake_count FROM gold_state
            WHERE earthquake_count > 0 ORDER BY earthquake_count DESC, state_fips LIMIT 15""",
            "gold_state"),
        "recent_events": sql(f"""
            SELECT event_id, {_STAMP.format('event_timestamp')} AS event_timestamp, magnitude,
                   place
            FROM ev ORDER BY ev.event_timestamp DESC, event_id LIMIT 10""", "ev"),
        "daily_series": sql(f"""
            SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date,
                   COUNT(*) AS earthquake_count, {_R2.format('magnitude')} AS avg_magnitude,
                   ROUND(MAX(magnitude), 2) AS max_magnitude FROM ev GROUP BY 1""", "ev"),
        "magnitude_histogram": sql("""
            SELECT bin, ROUND(lo + (bin - 1) * (hi - lo) / 40, 6) AS bin_start,
                   ROUND(lo + bin * (hi - lo) / 40, 6) AS bin_end, COUNT(*) AS event_count
            FROM (SELECT lo, hi, least(40, CAST(floor((magnitude - lo) / (hi - lo) * 40)
                         AS BIGINT) + 1) AS bin
                  FROM ev, (SELECT MIN(magnitude) AS lo, MAX(magnitude) AS hi FROM ev))
            GROUP BY bin, lo, hi""", "ev"),
        "kpi_overview": sql(f"""
            SELECT COUNT(*) AS total_events, {_R2.format('magnitude')} AS avg_magnitude,
                   (SELECT event_id FROM ev ORDER BY magnitude DESC, event_id DESC LIMIT 1)
                     AS largest_event_id,
                   MAX(magnitude) AS largest_magnitude,
                   (SELECT place FROM ev ORDER BY magnitude DESC, event_id DESC LIMIT 1)
                     AS largest_place
            FROM ev""", "ev"),
        "viz_point_map": sql(f"""
            SELECT latitude, longitude, magnitude, place, depth_km,
                   {_STAMP.format('event_timestamp')} AS event_timestamp
            FROM ev WHERE magnitude >= 3""", "ev"),
        "viz_state_choropleth": sql(
            "SELECT * FROM gold_state WHERE earthquake_count > 0", "gold_state"),
        "viz_county_choropleth": sql(
            "SELECT * FROM gold_county WHERE earthquake_count > 0", "gold_county"),
        "stage_row_counts": sql("""
            SELECT 'bronze_events' AS stage, COUNT(*) AS row_count FROM ev_raw
            UNION ALL SELECT 'silver_events', COUNT(*) FROM ev
            UNION ALL SELECT 'silver_states', COUNT(*) FROM states
            UNION ALL SELECT 'silver_counties', COUNT(*) FROM counties
            UNION ALL SELECT 'silver_chunks', COUNT(*) FROM chunk_pos""",
            "ev_raw", "ev", "states", "counties", "chunk_pos"),
        "sample_rows": sql("""
            SELECT event_id, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date,
                   location_point, 'struct<x:double,y:double>' AS point_type
            FROM ev ORDER BY event_id LIMIT 5""", "ev"),
        # -------------------------------------------------------- geometry
        "geo_point_wkt": sql(f"""
            SELECT event_id, event_time,
                   'POINT(' || {pt('longitude', 'latitude')} || ')' AS wkt FROM ev_raw""",
            "ev_raw"),
        "geo_geography_point": sql("""
            SELECT event_id, event_time,
                   CASE WHEN latitude <= 90 AND longitude IS NOT NULL THEN longitude END AS lon,
                   CASE WHEN latitude <= 90 AND longitude IS NOT NULL THEN latitude END AS lat
            FROM ev_raw""", "ev_raw"),
        "geo_wkt_edges": _edges(),
        "geo_try_parse": sql("""
            SELECT state_fips, geometry IS NOT NULL AS valid,
                   CASE WHEN geometry IS NULL THEN NULL
                        WHEN state_fips = '98' THEN 1
                        ELSE CASE WHEN CAST(state_fips AS INT) % 4 >= 2 THEN 2 ELSE 1 END
                   END::BIGINT AS rings
            FROM states""", "states"),
        "geo_polygon_normalize": sql("""
            SELECT state_fips, geometry FROM states
            UNION ALL SELECT state_fips, geometry FROM counties""", "states", "counties"),
        "geo_contains": sql(f"SELECT event_id, state_fips, {inside} AS contained "
                            "FROM own_cell o", "own_cell", "state_rects"),
        "geo_within": sql(f"SELECT event_id, state_fips, {inside} AS is_within "
                          "FROM own_cell o", "own_cell", "state_rects"),
        "geo_intersects": sql("""
            SELECT DISTINCT r.state_fips, c.state_fips AS county_fips, c.county_name,
                   c.geometry AS county_geometry
            FROM counties c JOIN state_rects r
              ON c.x0 <= r.x2 AND r.x1 <= c.x0 + c.w AND c.y0 <= r.y2 AND r.y1 <= c.y0 + c.h""",
            "counties", "state_rects"),
        "geo_distance_planar": sql("""
            SELECT event_id, ROUND(sqrt(pow(longitude - cx, 2) + pow(latitude - cy, 2)), 6)
                   AS distance
            FROM own_cell o LEFT JOIN state_centres c ON o.state_fips = c.state_fips""",
            "own_cell", "state_centres"),
        "geo_distance_polygon": sql("""
            SELECT event_id, ROUND(MIN(CASE WHEN x1 IS NOT NULL THEN
                sqrt(pow(greatest(x1 - longitude, 0, longitude - x2), 2)
                     + pow(greatest(y1 - latitude, 0, latitude - y2), 2)) END), 6) AS distance
            FROM own_cell LEFT JOIN state_rects USING (state_fips) WHERE state_fips IS NOT NULL
            GROUP BY event_id""", "own_cell", "state_rects"),
        "nearest_states": sql("""
            SELECT event_id, state_fips, ROUND(d, 6) AS distance, rank FROM (
                SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d, state_fips) AS rank FROM (
                    SELECT event_id, state_fips, ROUND(MIN(sqrt(pow(greatest(x1 - longitude, 0, longitude - x2), 2)
                        + pow(greatest(y1 - latitude, 0, latitude - y2), 2))), 9) AS d
                    FROM ev, state_rects GROUP BY event_id, state_fips))
            WHERE rank <= 3""", "ev", "state_rects"),
        "geo_distance_sphere": sql(f"""
            SELECT event_id, ROUND({_SPHERE.format('longitude', 'latitude', 'cx', 'cy')}, 3)
                   AS distance_m
            FROM own_cell o LEFT JOIN state_centres c ON o.state_fips = c.state_fips""",
            "own_cell", "state_centres"),
        "geo_centroid": sql(
            "SELECT state_fips, centroid_lon AS x, centroid_lat AS y FROM states", "states"),
        "geo_area": sql("""
            SELECT s.state_fips, ROUND(area, 6) AS area
            FROM states s LEFT JOIN state_centres c ON s.state_fips = c.state_fips""",
            "states", "state_centres"),
        "geo_buffer_ngon": sql("""
            SELECT event_id, corner::BIGINT AS corner,
                   ROUND(longitude + 0.25 * cos((corner % 8) * pi() / 4), 4) AS x,
                   ROUND(latitude + 0.25 * sin((corner % 8) * pi() / 4), 4) AS y
            FROM ev, range(9) c(corner)""", "ev"),
        "geo_wkb_roundtrip": sql("""
            SELECT event_id AS id, 21::BIGINT AS wkb_bytes, location_point AS wkt FROM ev
            UNION ALL SELECT state_fips, CASE
                WHEN geometry IS NULL THEN NULL
                WHEN state_fips = '98' THEN 9 + 84
                WHEN CAST(state_fips AS INT) % 4 = 0 THEN 9 + 84
                WHEN CAST(state_fips AS INT) % 4 = 1 THEN 9 + 116
                WHEN CAST(state_fips AS INT) % 4 = 2 THEN 9 + 2 * 84
                ELSE 9 + 2 * (9 + 84) END, geometry FROM states""", "ev", "states"),
        # -------------------------------------------------------- text
        "bronze_papers": sql("""
            SELECT file_name, 'papers/' || file_name AS file_path, raw_content,
                   '2024-01-01 00:00:00.000' AS ingestion_timestamp, source_url FROM paper""",
            "paper"),
        "silver_clean": sql("""
            SELECT file_name, source_url, '2024-01-01 00:00:00.000' AS ingestion_timestamp,
                   c AS cleaned_content FROM clean""", "clean"),
        "silver_chunks": sql("""
            SELECT file_name, source_url, '2024-01-01 00:00:00.000' AS ingestion_timestamp,
                   c AS cleaned_content, chunk_text, chunk_id, chunk_length, chunk_sequence,
                   chunk_position
            FROM chunks JOIN clean USING (file_name)""", "chunks", "clean"),
        "chunk_stats": sql("""
            SELECT COUNT(*) AS total_chunks, ROUND(AVG(chunk_length), 6) AS avg_chunk_length
            FROM chunk_pos""", "chunk_pos"),
        # -------------------------------------------------------- vectors
        "embed_hashing": sql(f"""
            SELECT file_name, total > 0 AS embedding_ok,
                   {vec("list_transform(counts, lambda c: CASE WHEN total > 0 "
                        "THEN c / sqrt(total) ELSE 0 END)")} AS embedding
            FROM (SELECT file_name, list(n ORDER BY b) AS counts, SUM(n * n) AS total
                  FROM (SELECT p.file_name, d.b, coalesce(n, 0)::DOUBLE AS n
                        FROM paper p CROSS JOIN range(64) d(b)
                        LEFT JOIN (SELECT file_name,
                                          ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS b,
                                          COUNT(*) AS n
                                   FROM (SELECT file_name, unnest(regexp_extract_all(
                                             lower(raw_content), '[a-z0-9]+')) AS t FROM paper)
                                   GROUP BY ALL) x
                          ON x.file_name = p.file_name AND x.b = d.b)
                  GROUP BY file_name)""", "paper"),
        "silver_embeddings": sql(f"""
            SELECT c.chunk_id, c.file_name, p.source_url, c.chunk_text, c.chunk_sequence,
                   c.chunk_length, e.embedding, '2024-01-01 00:00:00.000' AS embedding_timestamp
            FROM chunks c JOIN paper p USING (file_name) JOIN (
              SELECT chunk_id, {vec('list(v ORDER BY b)')} AS embedding
              FROM (SELECT i.chunk_id, d.b, coalesce(v, 0) AS v
                    FROM idx i CROSS JOIN range(64) d(b) LEFT JOIN chunk_bucket cb
                      ON cb.chunk_id = i.chunk_id AND cb.b = d.b)
              GROUP BY chunk_id) e ON e.chunk_id = c.chunk_id""",
            "chunks", "paper", "idx", "chunk_bucket"),
        "index_build": sql("""
            SELECT chunk_id, file_name, chunk_position, chunk_length,
                   len(tokens) AS token_count FROM idx""", "idx"),
        "index_describe": sql("""
            SELECT field, type, (SELECT COUNT(*) FROM chunk_pos) AS row_count,
                   64::BIGINT AS min_dimension, 64::BIGINT AS max_dimension
            FROM (VALUES ('chunk_id', 'string'), ('file_name', 'string'),
                         ('source_url', 'string'), ('chunk_text', 'string'),
                         ('chunk_sequence', 'int'), ('chunk_length', 'int'),
                         ('embedding', 'array<double>'), ('embedding_timestamp', 'timestamp'))
                 f(field, type)""", "chunk_pos"),
        "index_upsert": sql(f"""
            SELECT chunk_id, file_name, {vec('embedding')} AS embedding FROM upserted""",
            "upserted"),
        "index_after_merge": sql(f"""
            SELECT chunk_id, file_name, {vec('embedding')} AS embedding FROM upserted
            WHERE chunk_id NOT IN (SELECT chunk_id FROM vecs WHERE label = 1)""", "vecs", "upserted"),
        "index_upsert_stamps": sql("""
            SELECT chunk_id, CASE WHEN chunk_id IN (SELECT chunk_id FROM batch WHERE len(embedding) = 64)
                                  THEN '2024-01-01T00:00:00' END AS updated_at
            FROM upserted""", "upserted", "batch"),
        "index_upsert_report": sql("""
            SELECT CASE WHEN bad > 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
                   good AS success_row_count, bad AS failed_row_count
            FROM (SELECT COUNT(*) FILTER (chunk_id IS NOT NULL AND len(embedding) = 64) AS good,
                         COUNT(*) FILTER (chunk_id IS NULL OR len(embedding) <> 64) AS bad
                  FROM batch)""", "batch"),
        "vector_topk_exact": _topk("list_cosine_similarity(embedding, q)"),
        "vector_topk_dot": _topk("list_inner_product(embedding, q)"),
        "vector_topk_l2": _topk("1 / (1 + pow(list_distance(embedding, q), 2))"),
        "vector_topk_l2_far": _topk("1 / (1 + 1e10 * pow(list_distance(embedding, q), 2))"),
        "vector_topk_ivf": _topk(_COSINE, _IN_PROBED_CELL, "vec_cells", "probed"),
        "vector_topk_ivf_all_cells": _topk(_COSINE),
        "vector_topk_lsh": _topk(_COSINE, _IN_BUCKET, "vec_buckets", "query_buckets"),
        "ann_recall": _RECALL,
        "lsh_recall": _LSH_RECALL,
        # -------------------------------------------------------- search
        "query_set": sql("SELECT query_id, query, array_to_string(keywords, '|') AS keywords, "
                         "category FROM qs", "qs"),
        "search_ann": sql("""
            SELECT query_id, chunk_id, ROUND(score, 6) AS score, rank, file_name, chunk_text
            FROM ann_list JOIN idx USING (chunk_id) WHERE rank <= 10""", "ann_list", "idx"),
        "fulltext_bm25": sql("""
            SELECT query_id, chunk_id, ROUND(score, 6) AS score, rank FROM ft_list
            WHERE rank <= 10""", "ft_list"),
        "fulltext_postings": sql("""
            SELECT query_id, chunk_id, ROUND(score, 6) AS score, rank FROM ft_list
            WHERE rank <= 10""", "ft_list"),
        "fulltext_normalized": sql("""
            SELECT query_id, chunk_id, ROUND(score, 6) AS score, rank,
                   ROUND(normalized_score, 6) AS normalized_score FROM ft_norm""", "ft_norm"),
        "fulltext_with_vector": sql("""
            SELECT query_id, chunk_id, ROUND(score, 6) AS score, rank,
                   ROUND(normalized_score, 6) AS normalized_score FROM ft_norm""", "ft_norm"),
        "hybrid_rrf": sql("""
            SELECT query_id, chunk_id, ROUND(score, 6) AS score,
                   ROUND(vector_score, 6) AS vector_score,
                   ROUND(keyword_score, 6) AS keyword_score, rank, keyword_matches
            FROM hybrid""", "hybrid"),
        "hybrid_rrf_deep": sql("""
            SELECT query_id, chunk_id, ROUND(score, 6) AS score, rank
            FROM hybrid_all WHERE rank <= 500""", "hybrid_all"),
        "search_all_methods": sql(
            "SELECT * REPLACE (ROUND(score, 6) AS score) FROM results", "results"),
        # -------------------------------------------------------- benchmark analysis
        "bench_latency_per_query": sql("""
            SELECT * REPLACE (ROUND(avg_latency_ms, 6) AS avg_latency_ms,
                              ROUND(min_latency_ms, 6) AS min_latency_ms,
                              ROUND(max_latency_ms, 6) AS max_latency_ms)
            FROM averages""", "averages"),
        "bench_latency_summary": _summary("averages", "avg_latency_ms", 6, "averages"),
        "bench_score_summary": _summary("results", "score", 5, "results"),
        "bench_latency_pivot": _pivot("avg_latency_ms", 6, "averages", "averages"),
        "bench_score_pivot": _pivot("score", 5, "results JOIN qs USING (query_id)",
                                    "results", "qs"),
        "bench_box_stats": sql(
            _five("averages", "avg_latency_ms", "latency") + " UNION ALL "
            + _five("results", "score", "score"), "averages", "results"),
        "bench_report": sql("""
            SELECT method, ROUND(COUNT(DISTINCT query_id) * 100.0::DOUBLE
                     / (SELECT COUNT(DISTINCT query_id) FROM runs), 6) AS success_rate,
                   ROUND(AVG(avg_latency_ms), 6) AS avg_latency,
                   ROUND(MIN(avg_latency_ms), 6) AS min_latency,
                   ROUND(MAX(avg_latency_ms), 6) AS max_latency,
                   ROUND(AVG(num_results), 6) AS avg_results
            FROM averages GROUP BY method""", "averages", "runs"),
        "bench_overlap": sql("SELECT * FROM overlap_rows", "overlap_rows"),
        "bench_overlap_mean": sql("SELECT " + ", ".join(
            f"ROUND(AVG({c}), 6) AS {c}" for c in (
                "ann_ft", "ann_hybrid", "ft_hybrid", "all_three", "ann_results", "ft_results",
                "hybrid_results")) + " FROM overlap_rows", "overlap_rows"),
        "bench_keyword_hit_rate": sql("""
            SELECT method, COUNT(*) AS returned, COUNT(*) FILTER (hit) AS hits,
                   ROUND(AVG(hit::INT), 6) AS hit_rate
            FROM (SELECT method, len(list_filter(keywords,
                           lambda w: contains(lower(chunk_text), w))) > 0 AS hit
                  FROM results JOIN qs USING (query_id)
                  JOIN (SELECT chunk_id, chunk_text FROM idx) USING (chunk_id))
            GROUP BY method""", "results", "qs", "idx"),
        "bench_side_by_side": sql("""
            SELECT r.query_id, r.method, r.chunk_id, r.rank, r.file_name, r.text,
                   ROUND(r.score, 6) AS score, ROUND(vector_score, 6) AS vector_score,
                   ROUND(keyword_score, 6) AS keyword_score, keyword_matches
            FROM results r LEFT JOIN hybrid h
              ON r.method = 'Hybrid' AND r.query_id = h.query_id AND r.chunk_id = h.chunk_id
            WHERE r.rank <= 3""", "results", "hybrid"),
        "bench_results_json": sql("""
            SELECT query_id, method, category, COUNT(*) AS num_results,
                   string_agg(chunk_id, '|' ORDER BY rank) AS chunk_ids
            FROM results JOIN qs USING (query_id) GROUP BY ALL""", "results", "qs"),
        # -------------------------------------------------------- streaming twins
        "stream_events_by_state_day": sql("""
            SELECT state_fips, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_day,
                   COUNT(*) AS event_count, MAX(magnitude) AS max_magnitude
            FROM in_state GROUP BY ALL""", "in_state"),
        "stream_dedupe": sql("SELECT event_id, longitude, latitude, magnitude FROM ev", "ev"),
        "stream_index_upsert": sql("""
            SELECT chunk_id, file_name, chunk_position, chunk_length FROM idx""", "idx"),
    }
    return {name: text.strip() for name, text in oracles.items()}
