"""DuckDB SQL oracle for the registered queries.

Written independently of the Spark code: fixture tables are re-derived from the pre-registered views
(documents, nation, region, pages, conversations), consolidation is a sequential recursive CTE, the k-means optimum
a layered CTE over all split points, point in polygon a plain crossing count over every edge.
"""

from __future__ import annotations


def h(x: str, o: int, n: int) -> str:
    return f"(('0x'||substr(md5({x}),{o},7))::BIGINT % {n})"


RAD = "0.017453292519943295"

# ---------------------------------------------------------------- fixture tables (shared)

FIXTURES = f"""
cand AS (SELECT DISTINCT doc_id, lang, w FROM (
    SELECT doc_id, lang, unnest(regexp_extract_all(text, '\\p{{Lu}}\\p{{Ll}}{{3,}}')) AS w FROM documents)),
doc_toks AS (SELECT doc_id, lang, regexp_extract_all(text, '\\p{{L}}+') AS t FROM documents),
pairs AS (SELECT DISTINCT doc_id, lang, w FROM (
    SELECT doc_id, lang, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS w FROM doc_toks)
    WHERE regexp_full_match(w, '\\p{{Lu}}\\p{{Ll}}{{3,}} \\p{{Lu}}\\p{{Ll}}{{3,}}')),
two1 AS (SELECT w FROM cand GROUP BY w HAVING count(DISTINCT doc_id) >= 2),
two2 AS (SELECT w FROM pairs GROUP BY w HAVING count(DISTINCT doc_id) >= 2),
lex0 AS (
    SELECT lang, w AS surface, 1 AS n_tokens FROM cand WHERE w IN (SELECT w FROM two1)
    UNION
    SELECT lang, w AS surface, 2 AS n_tokens FROM pairs WHERE w IN (SELECT w FROM two2)),
lexicon AS (SELECT lang, surface,
    CASE {h('surface', 12, 20)}
      WHEN 0 THEN ' ' || surface || '  '
      WHEN 1 THEN substr(surface, 1, 2) || '_' || substr(surface, 3)
      WHEN 2 THEN surface || chr(10) || 'Nord'
      WHEN 3 THEN substr(surface, 1, 1)
      WHEN 4 THEN surface || '   Sud'
      WHEN 5 THEN '{{' || surface || '}}'
      WHEN 6 THEN chr(9) || surface
      ELSE surface END AS lemma,
    CASE WHEN {h('surface', 10, 10)} = 0 THEN 'PER' WHEN {h('surface', 14, 2)} = 0 THEN 'LOC' ELSE 'GPE' END AS entity_type,
    n_tokens
    FROM lex0),
lexicon_multi AS (SELECT DISTINCT lang, surface, lemma, entity_type, n_tokens FROM (
    SELECT lang, surface, lemma, entity_type, n_tokens FROM lexicon
    UNION ALL
    SELECT unnest(['de', 'en', 'es', 'fr']) AS lang, surface, lemma, entity_type, n_tokens
    FROM (SELECT DISTINCT surface, lemma, entity_type, n_tokens FROM lexicon WHERE {h('surface', 5, 3)} = 0))),
place_names AS (SELECT w FROM two1 UNION SELECT w FROM two2),
gaz_base AS (SELECT w AS query,
    CASE WHEN {h('w', 22, 2)} = 0 THEN CAST({h('w', 1, 12)} * 10 - 60 AS DOUBLE) + 0.37e0
         ELSE CAST({h('w', 1, 120000)} AS DOUBLE) / 1000e0 - 60e0 END AS lat,
    CASE WHEN {h('w', 22, 2)} = 0 THEN CAST({h('w', 8, 34)} * 10 - 170 AS DOUBLE) + 0.41e0
         ELSE CAST({h('w', 8, 340000)} AS DOUBLE) / 1000e0 - 170e0 END AS lon,
    substr(md5(w), 1, 8) AS place_id,
    CASE {h('w', 3, 3)} WHEN 0 THEN 'node' WHEN 1 THEN 'way' ELSE 'relation' END AS osm_type,
    CAST({h('w', 5, 100000000)} AS VARCHAR) AS osm_id,
    CAST({h('w', 7, 30)} AS INTEGER) AS place_rank,
    CASE {h('w', 15, 8)} WHEN 0 THEN 'shop' WHEN 1 THEN 'tourism' WHEN 2 THEN 'highway' WHEN 3 THEN 'waterway'
         WHEN 4 THEN 'boundary' WHEN 5 THEN 'natural' ELSE 'place' END AS class,
    CASE {h('w', 18, 4)} WHEN 0 THEN 'fuel' WHEN 1 THEN 'city' WHEN 2 THEN 'river' ELSE 'village' END AS type,
    CASE WHEN {h('w', 2, 50)} = 0 THEN NULL ELSE CAST({h('w', 11, 1000)} AS DOUBLE) / 1000e0 END AS importance
    FROM place_names WHERE {h('w', 25, 10)} < 9),
gaz_rows AS (
    SELECT * FROM gaz_base
    UNION ALL
    SELECT query, lat + 1e0, lon + 1e0, substr(md5(query || '/2'), 1, 8), osm_type, osm_id, place_rank, class, type,
           importance / 2e0
    FROM gaz_base WHERE {h('query', 6, 20)} = 0),
gazetteer AS (SELECT query, lat, lon, lat - 0.05e0 AS lat_min, lat + 0.05e0 AS lat_max, lon - 0.05e0 AS lon_min,
    lon + 0.05e0 AS lon_max, place_id, osm_type, osm_id, place_rank, query || ', ' || class AS display_name, class, type,
    importance, CAST(NULL AS VARCHAR) AS icon FROM gaz_rows),
start_cache AS (SELECT * FROM gazetteer WHERE {h('query', 4, 2)} = 0),
blacklist AS (SELECT DISTINCT query AS location, 0e0 AS lat, 0e0 AS lon FROM gazetteer WHERE {h('query', 9, 15)} = 0),
profile AS (SELECT unnest(string_split(words, ' ')) AS word, lang FROM (VALUES
    ('en', 'the of and to a in is that it for was on with be by as this are at from'),
    ('de', 'der die und in den von zu das mit sich auf des für ist nicht dem im ein eine als'),
    ('fr', 'de la le et les des en un du une que pour est qui par dans sur au avec pas'),
    ('es', 'de la que el en y los se del las por un no con su una es para al lo')) v(lang, words)),
hexagon AS (SELECT * FROM (VALUES (0, 0, 0), (1, 50, 3), (2, 66, 12), (3, 40, 23), (4, 12, 20), (5, 3, 11), (6, 0, 0)) v(k, dx, dy)),
poly AS (SELECT n.n_nationkey AS poly_id, n.n_name AS country, r.r_name AS continent,
    CAST((n.n_nationkey % 5) * 68 - 170 AS DOUBLE) AS ox, CAST((n.n_nationkey // 5) * 24 - 60 AS DOUBLE) AS oy
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
edges AS (SELECT a.poly_id, a.ox + h1.dx AS x1, a.oy + h1.dy AS y1, a.ox + h2.dx AS x2, a.oy + h2.dy AS y2
    FROM poly a JOIN hexagon h1 ON true JOIN hexagon h2 ON h2.k = h1.k + 1),
report_docs AS (SELECT doc_id, lang, text || chr(10) || CASE doc_id % 5
      WHEN 0 THEN 'Note: ' || (doc_id % 6) || ' Vertrag 0' || (doc_id % 9 + 1) || '.12.2019 ' || (doc_id % 90 + 10) || ',5 Mio. EUR'
      WHEN 1 THEN 'rating ' || (doc_id % 6) || ' Vertrag 0' || (doc_id % 9 + 1) || '.12.2019 ' || 'EUR ' || (doc_id % 90 + 10) || ',5 Mio.'
      WHEN 2 THEN 'Stufe 3' || ' Vertrag 0' || (doc_id % 9 + 1) || '.12.2019 ' || 'Betrag DM 3,5 Mio.'
      WHEN 3 THEN 'Grade: 2 am ' || (doc_id % 28 + 1) || '.1.2020'
      ELSE 'ohne Angaben' END AS text FROM documents),
bilingual_docs AS (SELECT a.doc_id, a.lang, a.text || coalesce(chr(10) || b.text, '') AS text
    FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1),
conv_docs AS (SELECT ((conv_id + turn) * (conv_id + turn + 1)) // 2 + turn AS doc_id, 'conv_' || conv_id || '_' || turn AS file_name, text FROM conversations)
"""


def pipeline(p: str, src: str, lex: str = "lexicon", threshold: str = "0.3e0", rules: str = "default", file_name: str = "NULL") -> str:
    """CTEs of the whole workflow over the document relation ``src``; every name is prefixed with ``p``."""
    if rules == "default":
        removed = (
            "class IN ('shop', 'tourism', 'highway', 'amenity', 'landuse', 'office') OR (class = 'waterway' AND type = 'fuel')"
        )
    else:
        removed = "type = 'river' OR (class = 'place' AND type = 'city')"
    return f"""
{p}words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM {src}),
{p}hits AS (SELECT w.doc_id, pr.lang AS code, count(*) AS n FROM {p}words w JOIN profile pr ON pr.word = w.word GROUP BY ALL),
{p}doc_language AS (SELECT doc_id, code, n / sum(n) OVER (PARTITION BY doc_id) AS proportion FROM {p}hits),
{p}doc_language_ranked AS (SELECT doc_id, code, proportion,
    CAST(row_number() OVER (PARTITION BY doc_id ORDER BY proportion DESC, code) AS INTEGER) AS rank FROM {p}doc_language),
{p}rel AS (SELECT doc_id, code,
    CAST(row_number() OVER (PARTITION BY doc_id ORDER BY proportion DESC, code) AS INTEGER) AS model_rank
    FROM {p}doc_language WHERE proportion >= {threshold} AND code IN (SELECT lang FROM {lex})),
{p}langs AS (SELECT * FROM {p}rel UNION ALL
    SELECT doc_id, 'de' AS code, 1 AS model_rank FROM {src} WHERE doc_id NOT IN (SELECT doc_id FROM {p}rel)),
{p}toks AS (SELECT doc_id, regexp_extract_all(text, '\\p{{L}}+') AS t FROM {src}),
{p}grams AS (SELECT doc_id, g.pos AS pos, g.len AS len, g.gram AS gram FROM (
    SELECT doc_id, unnest(list_concat(
        list_transform(range(0, len(t)), lambda i: {{'pos': i, 'len': 1, 'gram': t[i + 1]}}),
        list_transform(range(0, len(t) - 1), lambda i: {{'pos': i, 'len': 2, 'gram': t[i + 1] || ' ' || t[i + 2]}})
    )) AS g FROM {p}toks)),
{p}cands AS (SELECT g.doc_id, l.model_rank, CAST(g.pos AS INTEGER) AS pos, CAST(g.len AS INTEGER) AS len, g.gram AS token,
    x.lemma, x.entity_type
    FROM {p}grams g JOIN {lex} x ON x.surface = g.gram AND x.n_tokens = g.len
    JOIN {p}langs l ON l.doc_id = g.doc_id AND l.code = x.lang),
{p}best AS (SELECT * FROM {p}cands
    QUALIFY row_number() OVER (PARTITION BY doc_id, model_rank, pos ORDER BY len DESC, lemma, entity_type) = 1),
{p}ordered AS (SELECT doc_id, model_rank, pos, len,
    row_number() OVER (PARTITION BY doc_id, model_rank ORDER BY pos) AS i FROM {p}best),
{p}greedy AS (WITH RECURSIVE r(doc_id, model_rank, i, pos, kept, last_end) AS (
        SELECT doc_id, model_rank, i, pos, true, pos + len FROM {p}ordered WHERE i = 1
        UNION ALL
        SELECT o.doc_id, o.model_rank, o.i, o.pos, o.pos >= r.last_end,
               CASE WHEN o.pos >= r.last_end THEN o.pos + o.len ELSE r.last_end END
        FROM r JOIN {p}ordered o ON o.doc_id = r.doc_id AND o.model_rank = r.model_rank AND o.i = r.i + 1)
    SELECT doc_id, model_rank, pos FROM r WHERE kept),
{p}consolidated AS (SELECT b.* FROM {p}best b JOIN {p}greedy g USING (doc_id, model_rank, pos)),
{p}tagged AS (SELECT * FROM {p}consolidated WHERE entity_type IN ('LOC', 'GPE')),
{p}combined AS (SELECT * FROM {p}tagged QUALIFY model_rank = min(model_rank) OVER (PARTITION BY doc_id, token)),
{p}cleaned AS (SELECT doc_id, model_rank, pos, replace(token, chr(10), ' ') AS token,
    regexp_replace(regexp_replace(replace(replace(lemma, chr(10), ' '), '_', ' '), '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g'),
                   ' +', ' ', 'g') AS lemma,
    entity_type FROM {p}combined),
{p}mentions AS (SELECT * FROM {p}cleaned WHERE length(lemma) > 1),
{p}doc_location AS (SELECT doc_id, lemma AS location, count(*) AS frequency FROM {p}mentions GROUP BY ALL),
{p}names AS (SELECT doc_id, replace(replace(location, '{{', ''), '}}', '') AS location, CAST(sum(frequency) AS BIGINT) AS frequency
    FROM {p}doc_location WHERE length(replace(replace(location, '{{', ''), '}}', '')) > 0 GROUP BY ALL),
{p}misses AS (SELECT DISTINCT location AS query FROM {p}names WHERE location NOT IN (SELECT query FROM start_cache)),
{p}hits_cache AS (SELECT * FROM start_cache WHERE query IN (SELECT location FROM {p}names)),
{p}resolved AS (SELECT * FROM gazetteer WHERE query IN (SELECT query FROM {p}misses)
    QUALIFY row_number() OVER (PARTITION BY query ORDER BY importance DESC NULLS LAST, place_id) = 1),
{p}new_cache AS (SELECT * FROM (SELECT DISTINCT * FROM (SELECT * FROM start_cache UNION ALL SELECT * FROM {p}resolved))
    QUALIFY row_number() OVER (PARTITION BY query ORDER BY importance DESC NULLS LAST, place_id) = 1),
{p}doc_geo AS (SELECT n.doc_id, c.query, n.frequency, c.lat, c.lon, c.class, c.type, c.importance
    FROM {p}names n JOIN {p}new_cache c ON c.query = n.location),
{p}unresolved AS (SELECT doc_id, location, frequency FROM {p}names WHERE location NOT IN (SELECT query FROM {p}new_cache)),
{p}filtered AS (SELECT * FROM {p}doc_geo WHERE NOT coalesce({removed}, false)),
{p}cd AS (SELECT *, round({2 * 6378.137}e0 * asin(least(1e0, sqrt(
        pow(sin((c_lat - lat) * {RAD} / 2), 2) + cos(lat * {RAD}) * cos(c_lat * {RAD}) * pow(sin((c_lon - lon) * {RAD} / 2), 2)))), 6)
        AS distance_km
    FROM (SELECT *,
        CAST(sum(CAST(lat AS DECIMAL(20, 9)) * CAST(frequency AS DECIMAL(12, 0))) OVER w AS DOUBLE)
            / CAST(sum(frequency) OVER w AS DOUBLE) AS c_lat,
        CAST(sum(CAST(lon AS DECIMAL(20, 9)) * CAST(frequency AS DECIMAL(12, 0))) OVER w AS DOUBLE)
            / CAST(sum(frequency) OVER w AS DOUBLE) AS c_lon
          FROM {p}filtered WINDOW w AS (PARTITION BY doc_id))),
{p}dd AS (SELECT doc_id, distance_km AS d, count(*) AS m FROM {p}cd GROUP BY ALL),
{p}dstat AS (SELECT doc_id, sum(m) AS n_rows, count(*) AS n_distinct, sum(m * d) / sum(m) AS mean FROM {p}dd GROUP BY doc_id),
{p}pts AS (SELECT dd.doc_id, row_number() OVER (PARTITION BY dd.doc_id ORDER BY d) AS i, d, m, d - s.mean AS x
    FROM {p}dd dd JOIN {p}dstat s USING (doc_id)),
{p}pre AS (SELECT doc_id, i, sum(m) OVER w AS mm, sum(m * x) OVER w AS ss FROM {p}pts
        WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    UNION ALL SELECT doc_id, 0, 0, 0e0 FROM {p}dstat),
{p}seg AS (SELECT a.doc_id, a.i AS a, b.i AS b, (b.ss - a.ss) * (b.ss - a.ss) / (b.mm - a.mm) AS score
    FROM {p}pre a JOIN {p}pre b ON a.doc_id = b.doc_id AND a.i < b.i
    WHERE a.doc_id IN (SELECT doc_id FROM {p}dstat WHERE n_distinct > 2)),
{p}b1 AS (SELECT doc_id, b, score AS v FROM {p}seg WHERE a = 0),
{p}b2 AS (SELECT s.doc_id, s.b, p.v + s.score AS v, s.a FROM {p}b1 p JOIN {p}seg s ON s.doc_id = p.doc_id AND s.a = p.b
    QUALIFY row_number() OVER (PARTITION BY s.doc_id, s.b ORDER BY p.v + s.score DESC, s.a) = 1),
{p}b3 AS (SELECT s.doc_id, s.b, p.v + s.score AS v, s.a FROM {p}b2 p JOIN {p}seg s ON s.doc_id = p.doc_id AND s.a = p.b
    QUALIFY row_number() OVER (PARTITION BY s.doc_id, s.b ORDER BY p.v + s.score DESC, s.a) = 1),
{p}b4 AS (SELECT s.doc_id, s.b, p.v + s.score AS v, s.a FROM {p}b3 p JOIN {p}seg s ON s.doc_id = p.doc_id AND s.a = p.b
    QUALIFY row_number() OVER (PARTITION BY s.doc_id, s.b ORDER BY p.v + s.score DESC, s.a) = 1),
{p}b5 AS (SELECT s.doc_id, s.b, p.v + s.score AS v, s.a FROM {p}b4 p JOIN {p}seg s ON s.doc_id = p.doc_id AND s.a = p.b
    QUALIFY row_number() OVER (PARTITION BY s.doc_id, s.b ORDER BY p.v + s.score DESC, s.a) = 1),
{p}kchoice AS (SELECT st.doc_id, st.n_rows, st.n_distinct, least(5, st.n_rows - 1, st.n_distinct) AS kmax,
    c2.v - t.tot AS B2, c3.v - t.tot AS B3, c4.v - t.tot AS B4, c5.v - t.tot AS B5,
    c2.a AS a2, c3.a AS a3, c4.a AS a4, c5.a AS a5
    FROM {p}dstat st
    JOIN (SELECT doc_id, ss * ss / mm AS tot FROM {p}pre p WHERE i = (SELECT n_distinct FROM {p}dstat d WHERE d.doc_id = p.doc_id)) t USING (doc_id)
    LEFT JOIN {p}b2 c2 ON c2.doc_id = st.doc_id AND c2.b = st.n_distinct
    LEFT JOIN {p}b3 c3 ON c3.doc_id = st.doc_id AND c3.b = st.n_distinct
    LEFT JOIN {p}b4 c4 ON c4.doc_id = st.doc_id AND c4.b = st.n_distinct
    LEFT JOIN {p}b5 c5 ON c5.doc_id = st.doc_id AND c5.b = st.n_distinct
    WHERE st.n_distinct > 2),
{p}kpick AS (SELECT *, CASE
      WHEN n_rows <= 3 OR kmax < 3 OR B3 < 1.15e0 * B2 THEN 2
      WHEN kmax < 4 OR B4 < 1.15e0 * B3 THEN 3
      WHEN kmax < 5 OR B5 < 1.15e0 * B4 THEN 4
      ELSE 5 END AS k FROM {p}kchoice),
{p}cutidx AS (SELECT kp.doc_id, CASE kp.k
      WHEN 2 THEN kp.a2
      WHEN 3 THEN (SELECT a FROM {p}b2 x WHERE x.doc_id = kp.doc_id AND x.b = kp.a3)
      WHEN 4 THEN (SELECT x2.a FROM {p}b3 x3 JOIN {p}b2 x2 ON x2.doc_id = x3.doc_id AND x2.b = x3.a
                   WHERE x3.doc_id = kp.doc_id AND x3.b = kp.a4)
      ELSE (SELECT x2.a FROM {p}b4 x4 JOIN {p}b3 x3 ON x3.doc_id = x4.doc_id AND x3.b = x4.a
                   JOIN {p}b2 x2 ON x2.doc_id = x3.doc_id AND x2.b = x3.a WHERE x4.doc_id = kp.doc_id AND x4.b = kp.a5)
      END AS ci FROM {p}kpick kp),
{p}cut AS (SELECT c.doc_id, pt.d AS cut FROM {p}cutidx c JOIN {p}pts pt ON pt.doc_id = c.doc_id AND pt.i = c.ci),
{p}conf AS (SELECT cd.*, CASE WHEN ct.cut IS NULL OR cd.distance_km <= ct.cut THEN 1e0 ELSE 0e0 END AS confidence
    FROM {p}cd cd LEFT JOIN {p}cut ct USING (doc_id)),
{p}bl AS (SELECT * FROM {p}conf WHERE query NOT IN (SELECT location FROM blacklist)),
{p}ppts AS (SELECT DISTINCT lat, lon FROM {p}bl),
{p}located AS (SELECT q.lat, q.lon, pl.country, pl.continent FROM {p}ppts q
    LEFT JOIN (SELECT lat, lon, min(poly_id) AS poly_id FROM (
        SELECT q.lat, q.lon, e.poly_id FROM {p}ppts q JOIN edges e ON true GROUP BY q.lat, q.lon, e.poly_id
        HAVING sum(CASE WHEN ((e.y1 > q.lat) <> (e.y2 > q.lat))
                         AND q.lon < (e.x2 - e.x1) * (q.lat - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END) % 2 = 1)
        GROUP BY lat, lon) w ON w.lat = q.lat AND w.lon = q.lon
    LEFT JOIN poly pl ON pl.poly_id = w.poly_id),
{p}enriched AS (SELECT b.doc_id, b.query, b.frequency, b.lat, b.lon, b.class, b.type, b.importance, b.confidence,
    l.country, l.continent, {file_name} AS file_name
    FROM {p}bl b LEFT JOIN {p}located l ON l.lat = b.lat AND l.lon = b.lon {'LEFT JOIN ' + src + ' fsrc ON fsrc.doc_id = b.doc_id' if file_name != 'NULL' else ''}),
{p}ledger AS (SELECT coalesce(file_name, CAST(doc_id AS VARCHAR)) AS id, query AS location, frequency, lat, lon, class, type,
    importance, country, continent, confidence, doc_id FROM {p}enriched)"""


WHITELIST_COLS = "id, location, frequency, lat, lon, class, type, round(importance, 6) AS importance, country, continent, round(confidence, 6) AS confidence"


def by_name(ledger: str) -> str:
    return f"""
SELECT m.id, m.location, m.frequency, m.lat, m.lon, m.class, m.type, round(m.importance, 6) AS importance, m.country,
       m.continent, round(c.confidence, 6) AS confidence
FROM (SELECT id, location, CAST(sum(frequency) AS BIGINT) AS frequency,
        first(lat ORDER BY seq, doc_id, location) AS lat, first(lon ORDER BY seq, doc_id, location) AS lon,
        first(class ORDER BY seq, doc_id, location) AS class, first(type ORDER BY seq, doc_id, location) AS type,
        CASE WHEN count(importance) = count(*) THEN avg(importance) END AS importance,
        first(country ORDER BY seq, doc_id, location) AS country, first(continent ORDER BY seq, doc_id, location) AS continent
      FROM {ledger} WHERE id IS NOT NULL AND location IS NOT NULL GROUP BY id, location) m
JOIN (SELECT location, CASE WHEN count(confidence) = count(*) THEN avg(confidence) END AS confidence
      FROM {ledger} WHERE id IS NOT NULL AND location IS NOT NULL GROUP BY location) c USING (location)"""


def by_coords(ledger: str) -> str:
    return f"""
SELECT m.id, md.location, m.frequency, m.lat, m.lon, m.class, m.type, round(m.importance, 6) AS importance, m.country,
       m.continent, round(c.confidence, 6) AS confidence
FROM (SELECT id, lat, lon, CAST(sum(frequency) AS BIGINT) AS frequency,
        first(class ORDER BY seq, doc_id, location) AS class, first(type ORDER BY seq, doc_id, location) AS type,
        first(importance ORDER BY seq, doc_id, location) AS importance,
        first(country ORDER BY seq, doc_id, location) AS country, first(continent ORDER BY seq, doc_id, location) AS continent
      FROM {ledger} GROUP BY id, lat, lon) m
JOIN (SELECT id, lat, lon, location FROM (SELECT id, lat, lon, location, count(*) AS c FROM {ledger} GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY id, lat, lon ORDER BY c DESC, location) = 1) md
  ON md.id = m.id AND md.lat = m.lat AND md.lon = m.lon
JOIN (SELECT lat, lon, CASE WHEN count(confidence) = count(*) THEN avg(confidence) END AS confidence
      FROM {ledger} GROUP BY lat, lon) c ON c.lat = m.lat AND c.lon = m.lon"""


CUSTOM = {
    "ip_address": [r"\d{1,3}(\.\d{1,3}){3}"],
    "card_number": [r"\d{16}"],
    "api_token": [r'token = "[0-9a-f]+"'],
}
# the reference workflow's metadata patterns (same fixed values as the library)
GRADE = [r"Note[\:]?[ ]?\d", r"rating[\:]?[ ]?\d", r"Grade[\:]?[ ]?\d", r"note[\:]?[ ]?\d", r"Stufe[\:]?[ ]?\d"]
FUNDING = [r"[0-9,\.]{2,15}[ ]?Mio. E[ ]?U[ ]?R", r"E[ ]?U[ ]?R [0-9,\.]{2,4}[ ]?Mio.", r" D[ ]?M[ ]? [0-9,\.]{2,4}[ ]?Mio."]
DATE = [r"[\d]{1,2}\.[\d]{1,2}\.[\d]{4}"]


def first_match(text: str, patterns: list[str]) -> str:
    parts = ", ".join("nullif(regexp_extract(" + text + ", '" + p.replace("'", "''") + "'), '')" for p in patterns)
    return f"coalesce({parts})"


def meta(src: str, fields: dict[str, list[str]]) -> str:
    cols = ", ".join(f"{first_match('text', ps)} AS {name}" for name, ps in fields.items())
    return f"SELECT doc_id, {cols} FROM {src}"


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def build() -> dict[str, str]:
    main = FIXTURES + "," + pipeline("", "documents")
    hi = FIXTURES + "," + pipeline("", "documents", threshold="0.5e0")
    cust = FIXTURES + "," + pipeline("", "documents", rules="custom")
    filed = FIXTURES + "," + pipeline("", "documents", file_name="fsrc.source || '/report ' || fsrc.doc_id || '.txt'")
    bil = FIXTURES + "," + pipeline("", "bilingual_docs", lex="lexicon_multi")
    appended = (
        FIXTURES + "," + pipeline("", "documents") + "," + pipeline("c_", "conv_docs", file_name="fsrc.file_name")
        + ",\nall_ledger AS (SELECT *, 0 AS seq FROM c_ledger UNION ALL SELECT *, 1 AS seq FROM ledger)"
    )
    led = "(SELECT *, 0 AS seq FROM ledger)"
    geo8 = "doc_id, query, frequency, lat, lon, class, type, importance"
    q = {
        "language_proportions": _q(main, "SELECT doc_id, code, round(proportion, 6) AS proportion, rank FROM doc_language_ranked"),
        "relevant_languages": _q(main, "SELECT doc_id, code, model_rank FROM langs"),
        "language_default": _q(hi, "SELECT doc_id, code, model_rank FROM langs"),
        "consolidated_entities": _q(main, "SELECT doc_id, model_rank, pos, len, token, lemma, entity_type FROM consolidated"),
        "combined_models": _q(bil, "SELECT doc_id, model_rank, pos, len, token, lemma, entity_type FROM combined"),
        "clean_names": _q(main, "SELECT doc_id, model_rank, pos, token, lemma, entity_type FROM mentions"),
        "name_frequencies": _q(main, "SELECT doc_id, location, frequency FROM doc_location"),
        "top_names_per_doc": _q(main, """SELECT doc_id, location, frequency,
            CAST(row_number() OVER (PARTITION BY doc_id ORDER BY frequency DESC, location) AS INTEGER) AS rank
            FROM doc_location QUALIFY rank <= 3"""),
        "cache_hits": _q(main, "SELECT * FROM hits_cache"),
        "cache_misses": _q(main, "SELECT query FROM misses"),
        "resolved_names": _q(main, "SELECT * FROM resolved"),
        "updated_cache": _q(main, "SELECT * FROM new_cache"),
        "given_language": "SELECT doc_id, lang AS code, 1 AS model_rank FROM documents",
        "coordinates_of_document": _q(main, f"SELECT {geo8} FROM doc_geo WHERE doc_id = 7"),
        "languages_of_document": _q(main, "SELECT doc_id, code, round(proportion, 6) AS proportion, rank FROM doc_language_ranked WHERE doc_id = 7"),
        "metadata_of_document": "SELECT * FROM (" + _q(FIXTURES, meta("report_docs", {"grade": GRADE, "funding_volume": FUNDING, "date": DATE})) + ") WHERE doc_id = 7",
        "doc_coordinates": _q(main, f"SELECT {geo8} FROM doc_geo"),
        "unresolved_names": _q(main, "SELECT doc_id, location, frequency FROM unresolved"),
        "class_type_filter": _q(main, f"SELECT {geo8} FROM filtered"),
        "class_type_filter_custom": _q(cust, f"SELECT {geo8} FROM filtered"),
        "centroid_distance": _q(main, f"SELECT {geo8}, round(c_lat, 6) AS c_lat, round(c_lon, 6) AS c_lon, distance_km FROM cd"),
        "confidence": _q(main, f"SELECT {geo8}, distance_km, confidence FROM conf"),
        "blacklist_filter": _q(main, f"SELECT {geo8}, confidence FROM bl"),
        "blacklist_report": _q(main, """SELECT d.doc_id, coalesce(r.n, 0) AS n_removed, r.removed FROM documents d
            LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(query, ', ' ORDER BY query) AS removed FROM conf
                       WHERE query IN (SELECT location FROM blacklist) GROUP BY doc_id) r USING (doc_id)"""),
        "point_country": _q(
            FIXTURES + """,
            gpts AS (SELECT DISTINCT lat, lon FROM gazetteer),
            ginside AS (SELECT lat, lon, min(poly_id) AS poly_id FROM (
                SELECT q.lat, q.lon, e.poly_id FROM gpts q JOIN edges e ON true GROUP BY q.lat, q.lon, e.poly_id
                HAVING sum(CASE WHEN ((e.y1 > q.lat) <> (e.y2 > q.lat))
                                 AND q.lon < (e.x2 - e.x1) * (q.lat - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END) % 2 = 1)
                GROUP BY lat, lon)""",
            """SELECT g.lat, g.lon, p.country, p.continent FROM gpts g LEFT JOIN ginside i ON i.lat = g.lat AND i.lon = g.lon
            LEFT JOIN poly p ON p.poly_id = i.poly_id"""),
        "enriched_locations": _q(filed, f"SELECT {geo8}, confidence, country, continent, file_name FROM enriched"),
        "whitelist_full": _q(main, f"SELECT {WHITELIST_COLS} FROM ledger"),
        "whitelist_by_name": _q(main, by_name(led)),
        "whitelist_by_coords": _q(main, by_coords(led)),
        "whitelist_head": _q(main, f"SELECT * FROM ({by_name(led)}) ORDER BY id, location, lat, lon LIMIT 6"),
        "whitelist_appended": _q(appended, by_name("all_ledger")),
        "metadata_reference_patterns": _q(FIXTURES, meta("report_docs", {"grade": GRADE, "funding_volume": FUNDING, "date": DATE})),
        "metadata_custom_patterns": _q(FIXTURES, meta("documents", CUSTOM)),
        "metadata_raw_text": _q(FIXTURES, meta("documents", {"grade": GRADE, "funding_volume": FUNDING, "date": DATE})),
        "text_preview": "SELECT doc_id, substring(text, 1, 1000) AS preview FROM documents",
        "all_grades": _q(FIXTURES, meta("report_docs", {"grade": GRADE})),
        "file_ids": "SELECT page_id AS doc_id, string_split(url, '/')[-1] AS file_name FROM pages",
    }
    return q


ORACLE_SQL = build()
