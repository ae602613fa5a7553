"""SQL text that recomputes the registered queries on the source tables."""

from __future__ import annotations

from lotweave.plans import oracle_base as b
from lotweave.plans.derived import NODATA, PIXEL, RASTER_SIZE, SCENE, SCENE_PIXELS, STRIP, X0, Y0

ORACLES: dict[str, str] = {}


def add(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = (b.with_ctes(*ctes) if ctes else "") + body.strip()


CLEAN = (b.MEASURED, b.OREGON_CLEAN)
UNIQUE = (*CLEAN, b.OREGON_UNIQUE)

# ---- keys, labels and exclusion rules -----------------------------------------------------------

add(
    "key_normalise",
    "SELECT id, coalesce(nullif(trim(orig_key), ''), county_fips || '_' || geohash11) AS maptaxlot FROM fx_hash",
    b.PARCELS,
    b.box_geohash_cte("fx_parcels", "fx_hash"),
)

add(
    "state_normalise",
    """
SELECT c_custkey,
  CASE c_custkey % 6 WHEN 0 THEN 'oregon' WHEN 1 THEN 'oregon' WHEN 2 THEN 'washington' WHEN 3 THEN 'washington'
       WHEN 4 THEN 'ca' ELSE 'idaho' END AS state_name,
  CASE c_custkey % 6 WHEN 0 THEN 'or' WHEN 1 THEN 'or' WHEN 2 THEN 'wa' WHEN 3 THEN 'wa' WHEN 4 THEN 'ca' ELSE 'idaho' END AS state_abbr
FROM customer""",
)

add(
    "fpd_label",
    """SELECT p_partkey, left(replace(p_brand || ' COUNTY ' || p_type || ' COUNTY fire district', 'COUNTY', ''), 25) AS odf_fpd FROM part""",
)

add("parcel_exclude_or", "SELECT id, trim(orig_key) AS key FROM fx_measured JOIN or_excluded USING (id)", b.MEASURED, b.OREGON_EXCLUDED)
add("parcel_exclude_wa", "SELECT id, trim(orig_key) AS key FROM fx_measured JOIN wa_excluded USING (id)", b.MEASURED, b.WASHINGTON_EXCLUDED)
add(
    "thinness_filter",
    "SELECT id FROM fx_measured WHERE NOT coalesce(4 * area_sqm / nullif(perimeter ** 2, 0) < 0.03, false)",
    b.MEASURED,
)
add(
    "key_suffix_wa",
    f"""
SELECT id, CASE WHEN regexp_matches(maptaxlot, '{b.WASHINGTON_WORDS}', 'i') OR trim(maptaxlot) = '0'
  THEN maptaxlot || '_' || upper(centre11) ELSE maptaxlot END AS maptaxlot FROM wa_hash""",
    b.MEASURED,
    b.WASHINGTON_EXCLUDED,
    """wa_clean AS (SELECT m.*, coalesce(nullif(trim(orig_key), ''), county_fips || '_' || geohash11) AS maptaxlot
  FROM fx_measured m WHERE NOT EXISTS (SELECT 1 FROM wa_excluded e WHERE e.id = m.id))""",
    b.centroid_geohash_cte("wa_clean", "wa_hash", "centre11"),
)

# ---- uniqueness and de-duplication --------------------------------------------------------------

add("unique_keys", "SELECT id, maptaxlot FROM or_unique", *UNIQUE)
add(
    "duplicate_keys",
    "SELECT id, maptaxlot FROM or_clean WHERE maptaxlot IN (SELECT maptaxlot FROM or_clean GROUP BY maptaxlot HAVING count(*) > 1)",
    *CLEAN,
)
add("geohash_dedupe", "SELECT id, maptaxlot, geohash11 FROM or_single", *UNIQUE)
add(
    "conflict_suffix",
    """
SELECT id, final_key AS maptaxlot FROM (
  SELECT *, row_number() OVER (PARTITION BY final_key ORDER BY round(area_sqm, 1) DESC, geohash11, id) AS rn FROM (
    SELECT *, CASE WHEN count(*) OVER (PARTITION BY maptaxlot) > 1 THEN maptaxlot || '_' || upper(centre6) ELSE maptaxlot END AS final_key
    FROM or_hash)) WHERE rn = 1""",
    *CLEAN,
    b.centroid_geohash_cte("or_clean", "or_hash", "centre6", 6),
)
add(
    "first_per_group",
    """
SELECT key, id, county FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY area DESC NULLS FIRST, id) AS rn FROM (
    SELECT trim(orig_key) AS key, county, id, CASE WHEN id % 19 <> 0 THEN (x1 - x0) * (y1 - y0) END AS area FROM fx_parcels))
WHERE rn = 1 AND key IS NOT NULL""",
    b.PARCELS,
)

SNAPSHOTS = (
    b.PARCELS,
    """
fx_keyed AS (SELECT p.*, trim(orig_key) AS map_taxlot, o_orderstatus AS status,
  count(*) OVER (PARTITION BY trim(orig_key)) AS n FROM fx_parcels p JOIN orders ON o_orderkey = id),
fx_once AS (SELECT * FROM fx_keyed WHERE n = 1 AND map_taxlot <> ''),
fx_old AS (
  SELECT CASE WHEN status = 'P' THEN 'OLD' || id ELSE map_taxlot END AS map_taxlot,
    CASE WHEN id % 13 = 0 THEN 'stale' || id ELSE 'g' || id END AS map_id,
    CAST(CASE WHEN id % 17 = 0 THEN NULL WHEN id % 7 = 0 THEN id % 900 + 1 ELSE id % 900 END AS DOUBLE) AS min_elevation,
    CAST(id % 900 + id % 211 AS DOUBLE) AS max_elevation, 'zone' || (id % 5) AS orzdesc, 'S' || (id % 36) AS legal_label,
    'old' AS county FROM fx_once),
fx_new AS (
  SELECT map_taxlot, 'g' || id AS map_id, CAST(id % 900 AS DOUBLE) AS min_elevation,
    CAST(id % 900 + id % 211 AS DOUBLE) AS max_elevation, 'zone' || (id % 6) AS orzdesc, 'S' || (id % 36) AS legal_label,
    county FROM fx_once)""",
)

add(
    "insert_ignore",
    """
SELECT id, map_taxlot FROM (
  SELECT id, nullif(trim(orig_key), '') AS map_taxlot,
    row_number() OVER (PARTITION BY nullif(trim(orig_key), '') ORDER BY id) AS rn FROM fx_parcels) i
WHERE map_taxlot IS NULL OR (rn = 1 AND NOT EXISTS (SELECT 1 FROM fx_old o WHERE o.map_taxlot = i.map_taxlot))""",
    *SNAPSHOTS,
)

# ---- measures -----------------------------------------------------------------------------------

add(
    "geohash",
    "SELECT id, box11, centre11, centre6 FROM h3",
    b.PARCELS,
    b.box_geohash_cte("fx_parcels", "h1", "box11"),
    b.centroid_geohash_cte("h1", "h2", "centre11"),
    b.centroid_geohash_cte("h2", "h3", "centre6", 6),
)
add("reproject_measure", "SELECT id, round(area_sqm, 1) AS area_sqm, round(perimeter, 3) AS perimeter FROM fx_measured", b.MEASURED)
add(
    "centroid",
    """SELECT id, (x0 + x1) / 2.0 AS mid_x, (y0 + y1) / 2.0 AS mid_y, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area,
  CAST(2 * (x1 - x0 + y1 - y0) AS DOUBLE) AS perimeter FROM fx_parcels""",
    b.PARCELS,
)
add(
    "population_point",
    """SELECT 'city' AS classification, 'OR' AS state, population, CAST(placefips AS INTEGER) AS place_fips,
  population / 4.0 AS density_sqmi, CAST(2.25 AS DOUBLE) AS area_sqmi, CAST(pid % 7 AS INTEGER) AS population_class,
  (x0 + x1) / 2.0 AS x, (y0 + y1) / 2.0 AS y FROM fx_place""",
    b.PLACE,
)

# ---- spatial joins ------------------------------------------------------------------------------

MEET = "p.x0 <= f.x1 AND f.x0 <= p.x1 AND p.y0 <= f.y1 AND f.y0 <= p.y1"
INSIDE = "(p.x0 + p.x1) / 2.0 BETWEEN f.x0 AND f.x1 AND (p.y0 + p.y1) / 2.0 BETWEEN f.y0 AND f.y1"
OVERLAP = "(least(p.x1, f.x1) - greatest(p.x0, f.x0)) * (least(p.y1, f.y1) - greatest(p.y0, f.y0))"


def dominant(layer: int, source: str = "fx_parcels") -> str:
    return f"""SELECT * FROM (
  SELECT p.id, f.fid, f.label, f.kind, CAST({OVERLAP} AS DOUBLE) AS overlap_area,
    row_number() OVER (PARTITION BY p.id ORDER BY {OVERLAP} DESC, f.fid) AS rn
  FROM {source} p JOIN fx_layer f ON f.layer_no = {layer} AND {MEET}) WHERE rn = 1"""


add("spatial_join", f"SELECT p.id, f.fid FROM fx_parcels p JOIN fx_layer f ON {MEET}", b.PARCELS, b.LAYER)
add("dominant_huc", f"SELECT id, fid, label, overlap_area FROM ({dominant(0)})", b.PARCELS, b.LAYER)
add("dominant_zone", f"SELECT id, fid, kind, overlap_area FROM ({dominant(4)})", b.PARCELS, b.LAYER)


def rects(source: str, key: str, target: str) -> str:
    """CTEs: the shapes of ``source`` as rectangles that do not overlap."""
    kinds = {0: [(0, 0, 4, 4)], 1: [(0, 0, 4, 2), (0, 2, 2, 4)], 2: [(0, 0, 4, 1), (0, 3, 4, 4), (0, 1, 1, 3), (3, 1, 4, 3)], 3: [(0, 0, 1, 4), (3, 0, 4, 4)]}
    values = ", ".join(f"({k}, {a}, {b}, {c}, {d})" for k, blocks in kinds.items() for a, b, c, d in blocks)
    return (
        f"{target} AS (SELECT s.* EXCLUDE (x0, y0, x1, y1), x0 + (x1 - x0) * a / 4.0 AS x0, y0 + (y1 - y0) * b / 4.0 AS y0, "
        f"x0 + (x1 - x0) * c / 4.0 AS x1, y0 + (y1 - y0) * d / 4.0 AS y1 "
        f"FROM {source} s JOIN (VALUES {values}) k(kind, a, b, c, d) ON s.{key} % 4 = k.kind)"
    )


SHAPES = (b.PARCELS, b.LAYER, rects("fx_parcels", "id", "pr"), rects("fx_layer", "fid", "fr"))
add(
    "measure_shapes",
    """SELECT r.id, CAST(sum((r.x1 - r.x0) * (r.y1 - r.y0)) AS DOUBLE) AS area,
  CAST(any_value(CASE r.id % 4 WHEN 2 THEN 3 * (p.x1 - p.x0 + p.y1 - p.y0) WHEN 3 THEN (p.x1 - p.x0) + 4 * (p.y1 - p.y0)
    ELSE 2 * (p.x1 - p.x0 + p.y1 - p.y0) END) AS DOUBLE) AS perimeter,
  round(CAST(sum((r.x1 - r.x0) * (r.y1 - r.y0) * (r.x0 + r.x1)) / sum((r.x1 - r.x0) * (r.y1 - r.y0)) / 2 AS DOUBLE), 3) AS mid_x,
  round(CAST(sum((r.x1 - r.x0) * (r.y1 - r.y0) * (r.y0 + r.y1)) / sum((r.x1 - r.x0) * (r.y1 - r.y0)) / 2 AS DOUBLE), 3) AS mid_y
FROM pr r JOIN fx_parcels p USING (id) GROUP BY r.id""",
    *SHAPES,
)
add("spatial_join_shapes", f"SELECT DISTINCT p.id, f.fid FROM pr p JOIN fr f ON f.layer_no = 0 AND {MEET}", *SHAPES)
add(
    "dominant_shapes",
    f"""SELECT id, fid, label, round(CAST(area AS DOUBLE), 2) AS overlap_area FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY area DESC, fid) AS rn FROM (
    SELECT p.id, f.fid, f.label, sum({OVERLAP}) AS area FROM pr p JOIN fr f ON f.layer_no = 0 AND {MEET} GROUP BY ALL) WHERE area > 0) WHERE rn = 1""",
    *SHAPES,
)
add("points_in_shapes", f"SELECT DISTINCT p.id, f.fid FROM fx_parcels p JOIN fr f ON f.layer_no = 0 AND {INSIDE}", *SHAPES)
add(
    "overlay_shapes",
    f"""SELECT a, b, round(CAST(area AS DOUBLE), 2) AS area FROM (
  SELECT p.fid AS a, f.fid AS b, sum({OVERLAP}) AS area FROM fr p JOIN fr f ON p.layer_no = 0 AND f.layer_no = 1 AND {MEET} GROUP BY ALL) WHERE area > 0""",
    *SHAPES,
)
HARM = "CASE WHEN fid // 5 % 11 = 3 THEN 'ring that is not closed' WHEN fid // 5 % 13 = 5 THEN 'coordinate that is not a number' END"
add(
    "overlay_quarantine",
    f"""SELECT a, b, round(CAST(area AS DOUBLE), 2) AS area, CAST(NULL AS VARCHAR) AS reason FROM (
  SELECT p.fid AS a, f.fid AS b, sum({OVERLAP}) AS area FROM (SELECT * FROM fr WHERE layer_no = 0 AND {HARM} IS NULL) p
  JOIN (SELECT * FROM fr WHERE layer_no = 1 AND {HARM} IS NULL) f ON {MEET} GROUP BY ALL) WHERE area > 0
UNION ALL SELECT CASE layer_no WHEN 0 THEN fid END, CASE layer_no WHEN 1 THEN fid END, NULL, {HARM}
FROM fx_layer WHERE layer_no < 2 AND {HARM} IS NOT NULL""",
    *SHAPES,
)
add(
    "ingest_status",
    """SELECT layer, status, count(*) AS pages FROM (
  SELECT layer, CASE WHEN event_id IS NULL THEN 'missing' WHEN event_type = 'error' THEN 'failed' WHEN event_id % 5 = 0 THEN 'short'
    ELSE 'ok' END AS status
  FROM (SELECT layer, unnest(range(last + 2)) AS k FROM (
    SELECT 'layer' || (user_id % 7) AS layer, max(event_id) AS last FROM events GROUP BY 1))
  LEFT JOIN (SELECT 'layer' || (user_id % 7) AS layer, event_id AS k, event_id, event_type FROM events) USING (layer, k))
WHERE status <> 'ok' GROUP BY 1, 2""",
)
add(
    "coa_by_huc",
    f"""SELECT lpad(CAST(f.fid AS VARCHAR), 12, '0') AS huc12, CAST(p.fid AS VARCHAR) AS coa_id, p.label AS coa_name,
  p.kind AS ecoregion, 'p/' || p.fid AS profile_link, CAST((f.x1 - f.x0) * (f.y1 - f.y0) AS DOUBLE) AS huc_area
FROM fx_layer p JOIN fx_layer f ON p.layer_no = 2 AND f.layer_no = 0 AND {MEET}""",
    b.LAYER,
)
add(
    "urban_exclusion",
    f"""SELECT id, min_elev, max_elev FROM fx_elev e WHERE NOT EXISTS (
  SELECT 1 FROM fx_parcels p JOIN fx_place f ON {MEET}
  WHERE p.id = e.id AND ((p.x1 - p.x0) * (p.y1 - p.y0) < 2024 OR e.forest_pix / nullif(CAST(e.total_pix AS DOUBLE), 0) < 0.20))""",
    b.PARCELS,
    b.PLACE,
    b.ELEVATION,
)
add(
    "county_map",
    f"""SELECT DISTINCT p.county, f.county_fipscode, f.county_name FROM fx_parcels p
JOIN (SELECT county, min(id) AS id FROM fx_parcels GROUP BY county) r ON r.id = p.id JOIN fx_county f ON {INSIDE}""",
    b.PARCELS,
    b.COUNTY,
)
add("parcel_county", f"SELECT p.id, f.county_fipscode FROM fx_parcels p JOIN fx_county f ON {INSIDE}", b.PARCELS, b.COUNTY)
add(
    "plss_overlay",
    f"""SELECT 'S' || p.fid || ' (T' || f.fid || ')' AS legal_desc, CAST({OVERLAP} AS DOUBLE) AS area, CAST(1 AS INTEGER) AS parts,
  CAST(greatest(p.x0, f.x0) AS DOUBLE) AS minx, CAST(greatest(p.y0, f.y0) AS DOUBLE) AS miny,
  CAST(least(p.x1, f.x1) AS DOUBLE) AS maxx, CAST(least(p.y1, f.y1) AS DOUBLE) AS maxy
FROM fx_layer p JOIN fx_layer f ON p.layer_no = 0 AND f.layer_no = 1 AND {MEET} WHERE {OVERLAP} > 0""",
    b.LAYER,
)
add(
    "plss_wa_post",
    "SELECT id, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area FROM fx_parcels WHERE (x1 - x0) * (y1 - y0) < 10000000",
    b.PARCELS,
)

# ---- enrichment and application table -----------------------------------------------------------

add("landuse_lookup", "SELECT 10 + p_partkey % 14 AS landuse_cd, min(p_type) AS descr FROM part GROUP BY 1")

CANDIDATE = """CAST(e.min_elev AS DOUBLE) AS min_elevation, CAST(e.max_elev AS DOUBLE) AS max_elevation"""
add(
    "taxlot_enrich",
    f"""
SELECT fpd.label AS odf_fpd, sfd.kind AS agency, coalesce(zn.kind, 'Not Defined') AS orzdesc, CAST(huc.fid AS VARCHAR) AS huc12,
  huc.label AS name, {CANDIDATE}, 'S' || plss.fid AS legal_label, t.county, 'ORMAP' AS source, 'g' || t.id AS map_id,
  CAST(t.id AS VARCHAR) AS map_taxlot
FROM fx_parcels t JOIN fx_elev e ON e.id = t.id
LEFT JOIN ({dominant(0)}) huc ON huc.id = t.id LEFT JOIN ({dominant(1)}) plss ON plss.id = t.id
LEFT JOIN ({dominant(2)}) fpd ON fpd.id = t.id LEFT JOIN ({dominant(3)}) sfd ON sfd.id = t.id
LEFT JOIN ({dominant(4)}) zn ON zn.id = t.id""",
    b.PARCELS,
    b.LAYER,
    b.ELEVATION,
)
add(
    "taxlot_enrich_wa",
    f"""
SELECT left(replace(fpd.label || ' COUNTY district of ' || fpd.kind, 'COUNTY', ''), 25) AS odf_fpd, CAST(NULL AS VARCHAR) AS agency,
  coalesce(lu.descr, 'Not Defined') AS orzdesc, CAST(huc.fid AS VARCHAR) AS huc12, huc.label AS name, {CANDIDATE},
  'S' || plss.fid AS legal_label, t.county, 'WaTech and Washington State Counties' AS source, 'g' || t.id AS map_id,
  CAST(t.id AS VARCHAR) AS map_taxlot
FROM fx_parcels t JOIN fx_elev e ON e.id = t.id
LEFT JOIN (SELECT 10 + p_partkey % 14 AS landuse_cd, min(p_type) AS descr FROM part GROUP BY 1) lu ON lu.landuse_cd = t.landuse_cd
LEFT JOIN ({dominant(0)}) huc ON huc.id = t.id LEFT JOIN ({dominant(1)}) plss ON plss.id = t.id
LEFT JOIN ({dominant(2)}) fpd ON fpd.id = t.id""",
    b.PARCELS,
    b.LAYER,
    b.ELEVATION,
)
add(
    "change_detect",
    """SELECT n.map_taxlot, n.map_id, n.min_elevation, n.max_elevation FROM fx_new n LEFT JOIN fx_old o USING (map_taxlot)
WHERE o.map_id IS DISTINCT FROM n.map_id OR o.min_elevation IS DISTINCT FROM n.min_elevation
   OR o.max_elevation IS DISTINCT FROM n.max_elevation""",
    *SNAPSHOTS,
)
_CHANGED = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in ("map_id", "orzdesc", "min_elevation", "max_elevation", "legal_label"))
_UPDATED = ", ".join(
    f"CASE WHEN o.map_taxlot IS NULL OR (n.map_taxlot IS NOT NULL AND ({_CHANGED})) THEN n.{c} ELSE o.{c} END AS {c}"
    for c in ("map_id", "min_elevation", "max_elevation", "orzdesc", "legal_label")
)
add(
    "upsert_taxlot",
    f"""SELECT coalesce(o.map_taxlot, n.map_taxlot) AS map_taxlot, {_UPDATED},
  CASE WHEN o.map_taxlot IS NULL THEN n.county ELSE o.county END AS county
FROM fx_old o FULL OUTER JOIN fx_new n ON o.map_taxlot = n.map_taxlot""",
    *SNAPSHOTS,
)
add("delete_vanished", "SELECT map_taxlot, map_id FROM fx_old WHERE map_taxlot IN (SELECT map_taxlot FROM fx_new)", *SNAPSHOTS)
add(
    "upsert_zonal",
    """SELECT map_taxlot, map_id, min_elevation, max_elevation FROM fx_new UNION ALL
SELECT map_taxlot, map_id, min_elevation, max_elevation FROM fx_old WHERE map_taxlot NOT IN (SELECT map_taxlot FROM fx_new)""",
    *SNAPSHOTS,
)

# ---- county consolidation -----------------------------------------------------------------------

add(
    "county_union",
    """
SELECT county, maptaxlot, CASE WHEN county = 'Linn' THEN '020' END AS county_fips, CAST(x0 AS DOUBLE) AS minx, CAST(y0 AS DOUBLE) AS miny,
  CAST(x1 AS DOUBLE) AS maxx, CAST(y1 AS DOUBLE) AS maxy
FROM (
  SELECT 'Baker' AS county, CAST(id % 1000003 AS VARCHAR) AS maptaxlot, x0, y0, x1, y1 FROM src WHERE nk < 20 AND nk % 5 = 0
  UNION SELECT 'Jackson', rpad(CAST(id % 1000003 AS VARCHAR), 8, '0') || CASE WHEN id % 100003 > 99999 THEN '#####'
    ELSE lpad(CAST(id % 100003 AS VARCHAR), 5, '0') END, x0, y0, x1, y1 FROM src WHERE nk < 20 AND nk % 5 = 1
  UNION SELECT 'Klamath', substr('OR' || lpad(CAST(id AS VARCHAR), 16, '0') || 'X', 3, 16), x0, y0, x1, y1 FROM src WHERE nk < 20 AND nk % 5 = 2
  UNION SELECT 'Morrow', rpad(CAST(id % 1000003 AS VARCHAR), 10, '0') || lpad(CAST(id % 100003 AS VARCHAR), 5, '0'), x0, y0, x1, y1
    FROM src WHERE nk < 20 AND nk % 5 = 3
  UNION SELECT 'Clatsop', CAST(id % 1000003 AS VARCHAR), x0, y0, x1, y1 FROM src WHERE nk < 20 AND nk % 5 = 4
  UNION SELECT 'Linn', CAST(id % 1000003 AS VARCHAR), x0, y0, x1, y1 FROM src WHERE nk >= 20)""",
    b.PARCELS,
    "src AS (SELECT *, CAST(county_fips AS INTEGER) AS nk FROM fx_parcels)",
)

# ---- clustering, dissolve, repair ---------------------------------------------------------------

CLUSTERS = (
    *CLEAN,
    """
dup AS (SELECT * FROM or_clean WHERE maptaxlot IN (SELECT maptaxlot FROM or_clean GROUP BY maptaxlot HAVING count(*) > 1)),
links AS (
  SELECT p.id AS a, f.id AS z FROM dup p JOIN dup f ON p.maptaxlot = f.maptaxlot
    AND greatest(0, p.x0 - f.x1, f.x0 - p.x1) ** 2 + greatest(0, p.y0 - f.y1, f.y0 - p.y1) ** 2 <= 250000),
reach(a, z) AS (SELECT id, id FROM dup UNION SELECT r.a, l.z FROM reach r JOIN links l ON r.z = l.a),
clustered AS (SELECT dup.*, r.cid FROM dup JOIN (SELECT a, min(z) AS cid FROM reach GROUP BY a) r ON r.a = dup.id)""",
)


def union_cells(source: str, group: str, name: str) -> str:
    """Covered grid cells of each group's rectangles, cut at every distinct coordinate."""
    match = " AND ".join(f"r.{g} IS NOT DISTINCT FROM c.{g}" for g in group.split(", "))
    return f"""
{name}_x AS (SELECT *, lead(v) OVER (PARTITION BY {group} ORDER BY v) AS w FROM (
  SELECT {group}, x0 AS v FROM {source} UNION SELECT {group}, x1 FROM {source})),
{name}_y AS (SELECT *, lead(v) OVER (PARTITION BY {group} ORDER BY v) AS w FROM (
  SELECT {group}, y0 AS v FROM {source} UNION SELECT {group}, y1 FROM {source})),
{name}_g AS (SELECT c.*, r.v AS yv, r.w AS yw FROM {name}_x c JOIN {name}_y r ON {match} WHERE c.w IS NOT NULL AND r.w IS NOT NULL),
{name} AS (SELECT c.* FROM {name}_g c WHERE EXISTS (
  SELECT 1 FROM {source} r WHERE {match} AND r.x0 <= c.v AND r.x1 >= c.w AND r.y0 <= c.yv AND r.y1 >= c.yw))"""


ROUND1 = union_cells("clustered", "county, maptaxlot, cid", "cells1") + """,
round1 AS (SELECT county, maptaxlot, cid, CAST(sum((w - v) * (yw - yv)) AS DOUBLE) AS area FROM cells1 GROUP BY ALL)"""

ROUND2 = (
    union_cells("clustered", "maptaxlot, cid", "cells2")
    + """,
areas2 AS (SELECT maptaxlot, cid, CAST(sum((w - v) * (yw - yv)) AS DOUBLE) AS area,
    sum((w - v) * (yw - yv) * (v + w) / 2.0) / sum((w - v) * (yw - yv)) AS mid_x,
    sum((w - v) * (yw - yv) * (yv + yw) / 2.0) / sum((w - v) * (yw - yv)) AS mid_y FROM cells2 GROUP BY ALL),
lead1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY maptaxlot, cid ORDER BY area DESC, county) AS rn FROM round1) WHERE rn = 1),
boxes2 AS (SELECT maptaxlot, cid, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM clustered GROUP BY ALL),
plain2 AS (SELECT a.maptaxlot, a.cid, l.county, a.area, a.mid_x, a.mid_y, x.x0, x.y0, x.x1, x.y1
  FROM areas2 a JOIN lead1 l USING (maptaxlot, cid) JOIN boxes2 x USING (maptaxlot, cid)),
"""
    + b.box_geohash_cte("plain2", "round2")
)

add("dbscan_clusters", "SELECT id, maptaxlot, cid FROM clustered", *CLUSTERS)
add("dissolve_round1", "SELECT county, maptaxlot, cid, area FROM round1", *CLUSTERS, ROUND1)
add("dissolve_round2", "SELECT maptaxlot, cid, county, area, geohash11 FROM round2", *CLUSTERS, ROUND1, ROUND2)
add(
    "geometry_repair",
    """SELECT id, landuse_cd IS NULL AS repaired, CAST(CASE WHEN landuse_cd IS NULL THEN 2 ELSE 1 END AS INTEGER) AS parts,
  round((x1 - x0) * (y1 - y0) / CASE WHEN landuse_cd IS NULL THEN 2.0 ELSE 1.0 END, 3) AS area FROM fx_parcels""",
    b.PARCELS,
)

FINISHED = (
    *CLUSTERS,
    b.OREGON_UNIQUE,
    ROUND1,
    ROUND2,
    b.geohash_cte("round2", "named2", "centre11", b.longitude("mid_x"), b.latitude("mid_y"), 11),
    """
renamed AS (SELECT county, CASE WHEN count(*) OVER (PARTITION BY maptaxlot) > 1 THEN maptaxlot || '_' || upper(centre11)
    ELSE maptaxlot END AS maptaxlot, area, geohash11, cid FROM named2),
pool AS (
  SELECT county, maptaxlot, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area, geohash11, 0 AS pri, id AS cid FROM or_wide
  UNION ALL SELECT county, maptaxlot, area, geohash11, 1, cid FROM renamed),
finished AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY maptaxlot ORDER BY pri, area DESC, geohash11, cid) AS rn FROM pool) WHERE rn = 1)""",
)
add("clean_taxlots", "SELECT county, maptaxlot, geohash11, round(area, 3) AS planar_area, true AS has_outline FROM finished", *FINISHED)


def _washington(*parts: str) -> tuple[str, ...]:
    """The Oregon steps over Washington's cleaned parcels, with the land use carried along."""
    text = "\n,,\n".join(parts).replace("or_clean", "wa_keyed").replace("county, maptaxlot, cid", "county, landuse_cd, maptaxlot, cid")
    text = text.replace("ORDER BY area DESC, county)", "ORDER BY area DESC, county, landuse_cd NULLS FIRST)")
    text = text.replace("l.county, a.area", "l.county, l.landuse_cd, a.area").replace("SELECT county, CASE", "SELECT county, landuse_cd, CASE")
    text = text.replace("SELECT county, maptaxlot, CAST((x1", "SELECT county, landuse_cd, maptaxlot, CAST((x1")
    text = text.replace("SELECT county, maptaxlot, area, geohash11, 1", "SELECT county, landuse_cd, maptaxlot, area, geohash11, 1")
    return tuple(text.split("\n,,\n"))


add(
    "clean_taxlots_wa",
    "SELECT county, maptaxlot, landuse_cd, geohash11, round(area, 3) AS planar_area FROM finished",
    b.MEASURED,
    b.WASHINGTON_EXCLUDED,
    """wa_clean AS (SELECT m.*, coalesce(nullif(trim(orig_key), ''), county_fips || '_' || geohash11) AS maptaxlot
  FROM fx_measured m WHERE NOT EXISTS (SELECT 1 FROM wa_excluded e WHERE e.id = m.id))""",
    b.centroid_geohash_cte("wa_clean", "wa_hash", "centre11"),
    f"""wa_keyed AS (SELECT * EXCLUDE (maptaxlot, centre11), CASE WHEN regexp_matches(maptaxlot, '{b.WASHINGTON_WORDS}', 'i') OR trim(maptaxlot) = '0'
  THEN maptaxlot || '_' || upper(centre11) ELSE maptaxlot END AS maptaxlot FROM wa_hash)""",
    *_washington(
        CLUSTERS[-1],
        b.OREGON_UNIQUE,
        union_cells("clustered", "county, maptaxlot, cid", "cells1"),
        "round1 AS (SELECT county, maptaxlot, cid, CAST(sum((w - v) * (yw - yv)) AS DOUBLE) AS area FROM cells1 GROUP BY ALL)",
        ROUND2,
        b.geohash_cte("round2", "named2", "centre11", b.longitude("mid_x"), b.latitude("mid_y"), 6),
        FINISHED[-1],
    ),
)
add(
    "dissolve_near_copies",
    "SELECT id, round(CAST((x1 - x0) * (y1 - y0) AS DOUBLE), 1) AS area, true AS close FROM fx_parcels",
    b.PARCELS,
)
add("repaired_geohash", "SELECT id, geohash11 FROM fx_spike_hash", b.PARCELS, b.box_geohash_cte("fx_parcels", "fx_spike_hash"))
add(
    "dedupe_report",
    """
SELECT 'Total unprocessed taxlots' AS report, count(*) AS count FROM fx_parcels
UNION ALL SELECT 'Cleaned taxlots', count(*) FROM or_clean
UNION ALL SELECT 'Unique taxlots', count(*) FROM or_wide
UNION ALL SELECT 'Duplicated taxlots', count(DISTINCT maptaxlot) FROM dup
UNION ALL SELECT 'Deduplicated by clustering multipart taxlots', count(*) FROM round2
UNION ALL SELECT 'Deduplicated with geohash suffix', count(*) FROM finished WHERE contains(maptaxlot, '_')
UNION ALL SELECT 'Final taxlot count', count(*) FROM finished
UNION ALL SELECT 'Remaining duplicated geohash11 values', count(*) FROM (
  SELECT row_number() OVER (PARTITION BY geohash11 ORDER BY geohash11) AS rn FROM finished) WHERE rn > 1
UNION ALL SELECT 'Remaining duplicated maptaxlot values', count(*) FROM (
  SELECT row_number() OVER (PARTITION BY maptaxlot ORDER BY maptaxlot) AS rn FROM finished) WHERE rn > 1""",
    *FINISHED,
)

# ---- soil ---------------------------------------------------------------------------------------

SOIL_POLYGONS = (
    b.LAYER,
    """
fx_mupolygon AS (
  SELECT fid AS mukey, CASE WHEN fid % 2 = 0 THEN 'OR' ELSE 'WA' END || lpad(CAST(fid % 36 AS VARCHAR), 3, '0') AS areasymbol,
    'M' || (fid % 100) AS musym, CAST(1 + fid % 4 AS INTEGER) AS spatialversion,
    x0 + c * 5000 AS x0, y0 + c * 3000 AS y0, x1 + c * 5000 AS x1, y1 + c * 3000 AS y1
  FROM fx_layer, (VALUES (0), (1)) AS copies(c) WHERE c = 0 OR fid % 3 = 0)""",
)
add("soil_mukeys", "SELECT DISTINCT areasymbol, mukey FROM fx_mupolygon WHERE areasymbol LIKE 'OR%'", *SOIL_POLYGONS)
add("soil_response", "SELECT DISTINCT areasymbol, CAST(mukey AS VARCHAR) AS mukey FROM fx_mupolygon", *SOIL_POLYGONS)
add(
    "soil_geom",
    """SELECT DISTINCT p.mukey, areasymbol, musym, spatialversion, CAST(x0 AS DOUBLE) AS minx, CAST(y0 AS DOUBLE) AS miny
FROM fx_mupolygon p JOIN part ON p_partkey = p.mukey""",
    *SOIL_POLYGONS,
)
SOIL_DATA = """
component AS (SELECT l_partkey AS mukey, l_partkey * 100000 + l_suppkey AS cokey, CAST(max(l_quantity) AS INTEGER) AS comppct_r
  FROM lineitem GROUP BY l_partkey, l_suppkey),
coforprod AS (SELECT l_partkey * 100000 + l_suppkey AS cokey,
    CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE l_linestatus || '-' || (l_orderkey % 9) END AS plantcomname,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_orderkey % 120 END AS siteindex_r FROM lineitem WHERE l_returnflag IN ('R', 'A')),
corestrictions AS (SELECT l_partkey * 100000 + l_suppkey AS cokey, l_suppkey % 80 AS resdept_l, l_suppkey % 80 + l_linenumber AS resdept_h
  FROM lineitem WHERE l_returnflag = 'N'),
labelled AS (SELECT mukey, plantcomname || ' - ' || siteindex_r || ' ft' AS si_label,
    row_number() OVER (PARTITION BY mukey ORDER BY comppct_r DESC NULLS LAST, cokey, plantcomname NULLS LAST, siteindex_r) AS rn
  FROM coforprod JOIN component USING (cokey) WHERE siteindex_r IS NOT NULL),
restricted AS (SELECT mukey, sum(resdept_l * (comppct_r / 100.0)) AS l, sum(resdept_h * (comppct_r / 100.0)) AS h
  FROM corestrictions JOIN component USING (cokey) GROUP BY mukey),
soil_data AS (
  SELECT DISTINCT p_partkey AS mukey, p_name AS muname,
    CASE WHEN p_size % 6 = 0 THEN 'No Data Available' ELSE p_type END AS drclassdcd, p_brand AS forpehrtdcp,
    coalesce(si_label, 'None') AS si_label, coalesce(CAST(l AS DECIMAL(6, 2)), 0) AS avg_rs_l, coalesce(CAST(h AS DECIMAL(6, 2)), 0) AS avg_rs_h
  FROM part LEFT JOIN (SELECT * FROM labelled WHERE rn = 1) s ON s.mukey = p_partkey LEFT JOIN restricted r ON r.mukey = p_partkey)"""
add("soil_rollup", "SELECT * FROM soil_data", SOIL_DATA)
add(
    "soil_app",
    f"""SELECT s.mukey, areasymbol AS areasym, CAST(spatialversion AS DOUBLE) AS spatial, musym,
  round(({b.ALBERS_PERIMETER}) * 3.28084, 2) AS shp_lng, round(({b.ALBERS_AREA}) / 4046.86, 3) AS shap_ar, si_label, muname,
  drclassdcd AS drclssd, forpehrtdcp AS frphrtd, avg_rs_l, avg_rs_h
FROM soil_data s LEFT JOIN mu_corners g ON g.mukey = s.mukey""",
    *SOIL_POLYGONS,
    b.albers_corners("fx_mupolygon", "mu_corners"),
    SOIL_DATA,
)

# ---- rasters ------------------------------------------------------------------------------------

add(
    "zonal_todo",
    """SELECT CAST(p.id AS VARCHAR) AS maptaxlot, CAST(p.id % 7 AS VARCHAR) AS geohash11, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area_sqm
FROM fx_parcels p WHERE (x1 - x0) * (y1 - y0) > 2023 AND NOT EXISTS (SELECT 1 FROM fx_elev e WHERE e.id = p.id AND e.total_pix % 7 = p.id % 7)""",
    b.PARCELS,
    b.ELEVATION,
)
PIXELS = f"""
px AS (
  SELECT id, i, j FROM (
    SELECT id, i, unnest(range(CAST(ceil((y0 - {Y0}) / {PIXEL}.0 - 0.5) AS BIGINT), CAST(ceil((y1 - {Y0}) / {PIXEL}.0 - 0.5) AS BIGINT))) AS j FROM (
      SELECT *, unnest(range(CAST(ceil((x0 - ({X0})) / {PIXEL}.0 - 0.5) AS BIGINT), CAST(ceil((x1 - ({X0})) / {PIXEL}.0 - 0.5) AS BIGINT))) AS i
      FROM fx_parcels))
  WHERE i < {RASTER_SIZE} AND j < {RASTER_SIZE} AND i >= 0 AND j >= 0)"""
add(
    "zonal_stats",
    """SELECT id, coalesce(CAST(min(CASE WHEN (i + j) % 97 <> 0 THEN (31 * i + 17 * j) % 3000 - 5 END) AS INTEGER), 0) AS min_elev,
  coalesce(CAST(max(CASE WHEN (i + j) % 97 <> 0 THEN (31 * i + 17 * j) % 3000 - 5 END) AS INTEGER), 0) AS max_elev,
  count(*) FILTER (WHERE (7 * i + 13 * j) % 9 = 1) AS forest_pix, count(*) AS total_pix FROM px GROUP BY id""",
    b.PARCELS,
    PIXELS,
)
add(
    "zonal_histogram",
    "SELECT id, CAST((7 * i + 13 * j) % 9 AS INTEGER) AS cls, count(*) AS pixels FROM px GROUP BY 1, 2",
    b.PARCELS,
    PIXELS,
)
add(
    "zonal_custom",
    """
SELECT id, quantile_cont(v, 0.5) AS median_elev, quantile_cont(v, 0.9) AS upper_elev, CAST(count(DISTINCT c) AS INTEGER) AS variety,
  CAST(any_value(m) AS INTEGER) AS majority
FROM (SELECT id, CASE WHEN (i + j) % 97 <> 0 THEN CAST((31 * i + 17 * j) % 3000 - 5 AS DOUBLE) END AS v, (7 * i + 13 * j) % 9 AS c FROM px)
JOIN (SELECT id, arg_max(c, n * 100 - c) AS m FROM (SELECT id, (7 * i + 13 * j) % 9 AS c, count(*) AS n FROM px GROUP BY 1, 2) GROUP BY id) USING (id)
GROUP BY id""",
    b.PARCELS,
    PIXELS,
)
add(
    "raster_mosaic",
    f"""
SELECT tr AS row_no, CAST(floor(tc / {STRIP}) AS BIGINT) AS strip_no, count(h) AS heights,
  CAST(coalesce(sum(CAST(floor(h * 1000) AS BIGINT) * (tc % {STRIP} % 7 + 1)), 0) AS BIGINT) AS height_sum, count(v) AS covers,
  CAST(coalesce(sum(v * (tc % {STRIP} % 5 + 1)), 0) AS BIGINT) AS cover_sum
FROM (
  SELECT tr, tc, arg_min(h, pr::BIGINT * 1000000000 + k) FILTER (WHERE h IS NOT NULL) AS h,
    arg_min(v, pr::BIGINT * 1000000000 + k) FILTER (WHERE v IS NOT NULL) AS v
  FROM (SELECT k, pr, tr, tc, coalesce(m, near.h) AS h, near.v FROM scene_mean FULL JOIN scene_near near USING (k, pr, tr, tc)) GROUP BY tr, tc)
WHERE h IS NOT NULL OR v IS NOT NULL GROUP BY 1, 2""",
    f"""
scene AS (
  SELECT p_partkey AS k, p_size % 5 AS pr, [{", ".join(f"{p}::DOUBLE" for p in SCENE_PIXELS)}][p_partkey % 4 + 1] AS p,
    {X0} + (p_partkey % 40) * 90 + (p_partkey * 13 % 7) * 2.5::DOUBLE AS x0,
    {Y0} + (p_partkey // 40) * 90 + (p_partkey * 5 % 9) * 2.5::DOUBLE AS y0 FROM part)""",
    f"""
scene_px AS (
  SELECT k, pr, p, x0, y0, r, c, CASE WHEN (c + r + k) % 11 <> 0 THEN (31 * c + 17 * r + 3 * k) % 3000 - 5 END AS h,
    CASE WHEN (c * r + k) % 7 <> 0 THEN (7 * c + 13 * r + k) % 9 END AS v
  FROM scene, range({SCENE}) a(r), range({SCENE}) b(c) WHERE (r + k) % 13 <> 0)""",
    f"""
scene_mean AS (
  SELECT k, pr, CAST(floor((y0 + (r + 0.5::DOUBLE) * p - {Y0}) / {PIXEL}) AS BIGINT) AS tr,
    CAST(floor((x0 + (c + 0.5::DOUBLE) * p - ({X0})) / {PIXEL}) AS BIGINT) AS tc, CAST(sum(h) AS DOUBLE) / count(h) AS m
  FROM scene_px WHERE h IS NOT NULL GROUP BY ALL)""",
    f"""
scene_near AS (
  SELECT k, pr, tr, tc, h, v FROM (
    SELECT k, tr, tc, CAST(floor(({Y0} + (tr + 0.5::DOUBLE) * {PIXEL} - y0) / p) AS BIGINT) AS r,
      CAST(floor(({X0} + (tc + 0.5::DOUBLE) * {PIXEL} - x0) / p) AS BIGINT) AS c FROM (
      SELECT *, unnest(range(CAST(floor((x0 - ({X0})) / {PIXEL}) AS BIGINT) - 1, CAST((x0 + {SCENE} * p - ({X0})) / {PIXEL} AS BIGINT) + 2)) AS tc
      FROM (SELECT *, unnest(range(CAST(floor((y0 - {Y0}) / {PIXEL}) AS BIGINT) - 1, CAST((y0 + {SCENE} * p - {Y0}) / {PIXEL} AS BIGINT) + 2)) AS tr
        FROM scene)))
  JOIN scene_px USING (k, r, c))""",
)
assert NODATA == -9999.0

add(
    "extent_tiles",
    """
SELECT tx, ty, round(minx + tx * 20480, 1) AS x0, round(miny + ty * 20480, 1) AS y0, round(minx + (tx + 1) * 20480, 1) AS x1,
  round(miny + (ty + 1) * 20480, 1) AS y1
FROM (SELECT *, unnest(range(greatest(CAST(ceil((maxy - miny) / 20480) AS BIGINT), 1))) AS ty FROM (
  SELECT *, unnest(range(greatest(CAST(ceil((maxx - minx) / 20480) AS BIGINT), 1))) AS tx FROM (
    SELECT min(least(pax, pbx, pcx, pdx)) AS minx, min(least(pay, pby, pcy, pdy)) AS miny, max(greatest(pax, pbx, pcx, pdx)) AS maxx,
      max(greatest(pay, pby, pcy, pdy)) AS maxy FROM corners)))""",
    b.COUNTY,
    b.PLACE,
    "shapes AS (SELECT x0, y0, x1, y1 FROM fx_county UNION SELECT x0, y0, x1, y1 FROM fx_place)",
    b.albers_corners("shapes", "corners"),
)

# ---- ingestion ----------------------------------------------------------------------------------

ENTRIES = """
entries AS (
  SELECT lower(r_name) AS state, lower(n_name) AS layer, n_nationkey % 4 <> 0 AS fetched, 100 * (1 + n_nationkey % 5) AS max_records,
    CASE n_nationkey % 3 WHEN 0 THEN ['NAME'] WHEN 1 THEN ['NAME', 'CODE'] ELSE ['NAME', 'CODE', 'RATE'] END AS names,
    CASE n_nationkey % 3 WHEN 0 THEN ['VARCHAR(25)'] WHEN 1 THEN ['VARCHAR(25)', 'INTEGER'] ELSE ['VARCHAR(25)', 'INTEGER', 'DECIMAL(6,2)'] END AS types
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
add(
    "paged_scan_plan",
    """
SELECT layer, page_no, page_no * max_records AS offset, least(max_records, total - page_no * max_records) AS records FROM (
  SELECT *, unnest(range(CAST(ceil(total / CAST(max_records AS DOUBLE)) AS BIGINT))) AS page_no FROM (
    SELECT e.layer, CAST(max_records AS BIGINT) AS max_records, count(*) AS total FROM entries e
    JOIN (SELECT lower(n_name) AS layer FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) o
      USING (layer) GROUP BY ALL))""",
    ENTRIES,
)
add("source_filter", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 20")
add(
    "page_ledger",
    """
SELECT 'layer' || (user_id % 7) AS layer, count(*) AS total_batches,
  count(*) FILTER (WHERE event_type <> 'error' OR (event_id * 100) % 300 <> 0) AS successful_batches,
  count(*) FILTER (WHERE event_type = 'error' AND (event_id * 100) % 300 = 0) AS failed_batches,
  max(1 + user_id % 5 + CASE WHEN event_type = 'error' THEN 5 ELSE 0 END) AS most_attempts
FROM events GROUP BY 1""",
)
STORED = """
stored AS (
  SELECT *, place // 2500 * 2500 AS page FROM (
    SELECT p.*, lower(r_name) AS layer, row_number() OVER (PARTITION BY r_name ORDER BY p.id) - 1 AS place
    FROM fx_parcels p JOIN nation ON county = n_name JOIN region ON n_regionkey = r_regionkey))"""
add(
    "paged_source",
    """
SELECT layer, page AS "offset", place - page AS "position", 'ok' AS status, id AS "NUMBER", 'a "b]" \\ {' || county AS "NAME",
  CASE WHEN id % 41 <> 0 THEN CAST((x1 - x0) * (y1 - y0) AS DOUBLE) END AS area
FROM stored WHERE layer <> 'asia' OR page <> 0
UNION ALL SELECT 'asia', 0, NULL, 'failed', NULL, NULL, NULL""",
    b.PARCELS,
    STORED,
)
add(
    "page_replay",
    """
SELECT page, count(*) FILTER (WHERE id % 41 <> 0) AS rows, sum(id) FILTER (WHERE id % 41 <> 0) AS ids,
  min(place) FILTER (WHERE id % 41 <> 0) AS first_id, count(*) FILTER (WHERE id % 41 = 0) AS quarantined, CAST(NULL AS VARCHAR) AS status
FROM stored WHERE layer = 'asia' AND (page % 10000 <> 0 OR page % 20000 = 0) GROUP BY page
UNION ALL SELECT DISTINCT page, NULL, NULL, NULL, NULL, 'failed' FROM stored WHERE layer = 'asia' AND page % 20000 = 10000""",
    b.PARCELS,
    STORED,
)
add("layer_catalog", "SELECT layer FROM entries WHERE fetched UNION SELECT 'soil' UNION SELECT 'elevation'", ENTRIES)
add(
    "state_catalog",
    "SELECT state, string_agg(layer, ',' ORDER BY layer) AS layers, count(*) AS n_layers FROM entries GROUP BY state",
    ENTRIES,
)
add(
    "declared_schema",
    """SELECT state, layer, CAST(k - 1 AS INTEGER) AS position, names[k] AS name, types[k] AS sql_type, false AS mismatch
FROM (SELECT *, unnest(range(1, len(names) + 1)) AS k FROM entries)""",
    ENTRIES,
)
add(
    "probe_summary",
    """SELECT CASE WHEN user_id % 2 = 0 THEN 'oregon' ELSE 'washington' END AS state, count(*) AS total,
  count(*) FILTER (WHERE event_type <> 'error') AS successful, count(*) FILTER (WHERE event_type = 'error') AS failed,
  round(100.0 * count(*) FILTER (WHERE event_type <> 'error') / count(*), 2) AS success_rate FROM events GROUP BY 1""",
)
add(
    "geojson_rows",
    """SELECT id AS "ID", county AS "NAME", CAST(NULL AS INTEGER) AS "CODE", CAST(3857 AS INTEGER) AS srid,
  CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area FROM fx_parcels WHERE landuse_cd IS NOT NULL AND landuse_cd <> 13""",
    b.PARCELS,
)
add(
    "geometry_quarantine",
    """SELECT id AS "ID", CASE WHEN landuse_cd IS NULL THEN 'missing geometry' ELSE 'unreadable geometry' END AS reason
FROM fx_parcels WHERE landuse_cd IS NULL OR landuse_cd = 13""",
    b.PARCELS,
)
add(
    "vector_split",
    """SELECT id AS NUMBER, 'a "b]" \\ {[}' || county AS NAME, CASE WHEN id % 41 <> 0 THEN 3857 END AS srid,
  CASE WHEN id % 41 <> 0 THEN CAST((x1 - x0) * (y1 - y0) AS DOUBLE) END AS area,
  CASE WHEN id % 41 = 0 THEN 'missing geometry' END AS reason
FROM fx_parcels""",
    b.PARCELS,
)
add(
    "vector_import",
    """SELECT id, CAST(2913 AS INTEGER) AS srid, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1,
  CAST(y1 AS DOUBLE) AS y1 FROM fx_parcels""",
    b.PARCELS,
)
add(
    "metadata_catalog",
    """SELECT 'part_' || p_partkey || '_x' AS layer, 'https://example.org/rest/Part-' || p_partkey || '_x/?f=json' AS url,
  CAST(3857 AS INTEGER) AS epsg, 'OBJECTID,Brand,Price' AS outfields, 'BIGINT,VARCHAR(' || p_size || '),FLOAT' AS dtypes,
  CAST(CASE WHEN p_size % 3 <> 0 THEN least(p_size * 300, 10000) ELSE 2000 END AS INTEGER) AS max_records FROM part""",
)

# ---- contracts and export -----------------------------------------------------------------------

add(
    "contract_check",
    """
SELECT 'not null' AS rule, 'key' AS "column", count(*) FILTER (WHERE orig_key IS NULL) AS violations FROM fx_parcels
UNION ALL SELECT 'not null', 'landuse_cd', count(*) FILTER (WHERE landuse_cd IS NULL) FROM fx_parcels
UNION ALL SELECT 'length 7', 'key', count(*) FILTER (WHERE length(trim(orig_key)) > 7) FROM fx_parcels
UNION ALL SELECT 'length 6', 'county', count(*) FILTER (WHERE length(county) > 6) FROM fx_parcels
UNION ALL SELECT 'polygonal', 'geom', count(*) FILTER (WHERE id % 10 < 2) FROM fx_parcels
UNION ALL SELECT 'unique', 'key', count(trim(orig_key)) - count(DISTINCT trim(orig_key)) FROM fx_parcels""",
    b.PARCELS,
)
_PROFILED = {
    "id": "bigint", "county": "string", "county_fips": "string", "orig_key": "string", "landuse_cd": "bigint",
    "x0": "bigint", "y0": "bigint", "x1": "bigint", "y1": "bigint",
}
add(
    "export_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, '{kind}' AS type, true AS nullable, true AS same FROM fx_parcels"
        for c, kind in _PROFILED.items()
    ),
    b.PARCELS,
)
