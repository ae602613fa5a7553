"""SQL text of the derived tables, written independently of the DataFrame code."""

from __future__ import annotations

from lotweave.functions import crs
from lotweave.plans.derived import X0, Y0

PARCELS = f"""
fx_base AS (
  SELECT o_orderkey AS id, o_custkey AS ck, n_name AS county, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS county_fips,
         o_orderkey % 53 AS m, o_orderkey % 23 AS s, o_orderkey % 300 AS gr, (o_orderkey // 300) % 5 AS q
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
fx_sized AS (
  SELECT *, NOT (m BETWEEN 6 AND 15) AS plain,
    CASE WHEN m = 0 THEN NULL WHEN m = 1 THEN '  ' WHEN m = 2 THEN '0' WHEN m = 3 THEN 'Road ' || (id % 7)
         WHEN m = 4 THEN 'rr-' || (id % 11) WHEN m = 5 THEN 'DNR ' || (id % 9)
         WHEN m BETWEEN 6 AND 14 THEN 'DUP' || lpad(CAST(gr AS VARCHAR), 3, '0')
         WHEN m = 15 THEN 'x' || id ELSE ' ' || lpad(CAST(id AS VARCHAR), 8, '0') || ' ' END AS orig_key,
    CASE WHEN id % 4 = 0 THEN NULL ELSE 10 + id % 12 END AS landuse_cd,
    CASE WHEN m BETWEEN 6 AND 14 THEN {X0} + (gr % 20) * 1500 + q * (CASE WHEN gr % 2 = 0 THEN 300 ELSE 3000 END)
         WHEN m = 15 THEN {X0} + ((id // 106) * 7919 % 4001) * 10 ELSE {X0} + (id * 7919 % 4001) * 10 END AS x0,
    CASE WHEN m BETWEEN 6 AND 14 THEN {Y0} + (gr // 20) * 2500
         WHEN m = 15 THEN {Y0} + ((id // 106) * 104729 % 3989) * 10 ELSE {Y0} + (id * 104729 % 3989) * 10 END AS y0
  FROM fx_base),
fx_parcels AS (
  SELECT id, county, county_fips, orig_key, landuse_cd, x0, y0,
    x0 + CASE WHEN plain AND id % 97 = 1 THEN 4000 WHEN plain AND s IN (0, 1) THEN 2000 WHEN m = 15 THEN 100
              ELSE 20 + (ck % 40) * 10 END AS x1,
    y0 + CASE WHEN plain AND id % 97 = 1 THEN 4000 WHEN plain AND s = 0 THEN 4 WHEN plain AND s = 1 THEN 54
              WHEN m = 15 THEN 100 ELSE 20 + (id % 37) * 10 END AS y1
  FROM fx_sized)"""

LAYER = f"""
fx_layer AS (
  SELECT *, x0 + 2000 + (fid % 7) * 90 AS x1, y0 + 2000 + (fid % 11) * 70 AS y1 FROM (
    SELECT p_partkey AS fid, p_partkey % 5 AS layer_no, p_brand AS label, p_type AS kind,
      {X0} + ((p_partkey // 5) % 20) * 2000 + (p_partkey * 37 % 11) * 30 + (p_partkey // 2000) * 130 AS x0,
      {Y0} + ((p_partkey // 100) % 20) * 2000 + (p_partkey * 53 % 13) * 20 + (p_partkey // 2000) * 170 AS y0
    FROM part))"""

PLACE = f"""
fx_place AS (
  SELECT *, x0 + 1500 AS x1, y0 + 1500 AS y1 FROM (
    SELECT s_suppkey AS pid, {X0} + (s_suppkey * 7919 % 397) * 100 AS x0, {Y0} + (s_suppkey * 104729 % 389) * 100 AS y0,
      CAST(floor(s_acctbal) AS BIGINT) AS population, lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS placefips,
      s_name AS name FROM supplier))"""

COUNTY = f"""
fx_county AS (
  SELECT *, x0 + 9200 AS x1, y0 + 9200 AS y1 FROM (
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS county_fipscode, n_name AS county_name,
      {X0} + (n_nationkey % 5) * 9200 AS x0, {Y0} + (n_nationkey // 5) * 9200 AS y0 FROM nation))"""

ELEVATION = """
fx_elev AS (
  SELECT o_orderkey AS id, o_orderkey % 900 AS min_elev, o_orderkey % 900 + o_orderkey % 211 AS max_elev,
    o_orderkey % 29 AS total_pix, least((o_orderkey % 29) * (o_orderkey % 11) // 10, o_orderkey % 29) AS forest_pix
  FROM orders)"""

_K = crs.albers_constants()


def _albers_corner(x: str, y: str, name: str) -> str:
    """Albers coordinates of one Mercator corner."""
    lon = f"(({x}) / {crs.MERCATOR_RADIUS!r})"
    s = f"sin(2 * atan(exp(({y}) / {crs.MERCATOR_RADIUS!r})) - pi() / 2)"
    q = (
        f"((1 - {crs.E2!r}) * ({s} / (1 - {crs.E2!r} * {s} * {s})"
        f" - ln((1 - {crs.ECC!r} * {s}) / (1 + {crs.ECC!r} * {s})) / (2 * {crs.ECC!r})))"
    )
    rho = f"({crs.SEMI_MAJOR!r} * sqrt({_K['c']!r} - {_K['n']!r} * {q}) / {_K['n']!r})"
    theta = f"({_K['n']!r} * ({lon} + radians(96.0)))"
    return f"{rho} * sin({theta}) AS {name}x, {_K['rho0']!r} - {rho} * cos({theta}) AS {name}y"


def albers_corners(source: str, target: str) -> str:
    """CTE adding the four projected corners (a lower left, then counter-clockwise)."""
    corners = ", ".join(
        _albers_corner(x, y, n) for n, x, y in (("pa", "x0", "y0"), ("pb", "x1", "y0"), ("pc", "x1", "y1"), ("pd", "x0", "y1"))
    )
    return f"{target} AS (SELECT *, {corners} FROM {source})"


ALBERS_AREA = (
    "abs((pbx - pax) * (pcy - pay) - (pcx - pax) * (pby - pay) + (pcx - pax) * (pdy - pay) - (pdx - pax) * (pcy - pay)) / 2"
)
ALBERS_PERIMETER = (
    "sqrt((pbx - pax) ** 2 + (pby - pay) ** 2) + sqrt((pcx - pbx) ** 2 + (pcy - pby) ** 2)"
    " + sqrt((pdx - pcx) ** 2 + (pdy - pcy) ** 2) + sqrt((pax - pdx) ** 2 + (pay - pdy) ** 2)"
)


def latitude(y: str) -> str:
    return f"((2 * atan(exp(({y}) / {crs.MERCATOR_RADIUS!r})) - pi() / 2) * (180 / pi()))"


def longitude(x: str) -> str:
    return f"(({x}) / {crs.MERCATOR_RADIUS!r} * (180 / pi()))"


def geohash(lon: str, lat: str, length: int) -> str:
    """Characters from explicit bit picks out of the two quantised coordinates."""
    lon_bits, lat_bits = (5 * length + 1) // 2, 5 * length // 2
    qx = f"CAST(floor(({lon} + 180) / 360 * {1 << lon_bits}) AS BIGINT)"
    qy = f"CAST(floor(({lat} + 90) / 180 * {1 << lat_bits}) AS BIGINT)"
    chars = []
    for i in range(length):
        terms = []
        for j in range(5):
            k = 5 * i + j
            value, top = ("qx", lon_bits) if k % 2 == 0 else ("qy", lat_bits)
            terms.append(f"((({value} >> {top - 1 - k // 2}) & 1) << {4 - j})")
        chars.append("substr('0123456789bcdefghjkmnpqrstuvwxyz', 1 + " + " + ".join(terms) + ", 1)")
    return f"(SELECT {' || '.join(chars)} FROM (SELECT {qx} AS qx, {qy} AS qy))"


def geohash_cte(source: str, target: str, column: str, lon: str, lat: str, length: int) -> str:
    """CTE form of :func:`geohash`: quantise in one step, write characters in the next."""
    lon_bits, lat_bits = (5 * length + 1) // 2, 5 * length // 2
    body = geohash("0", "0", length)
    chars = body[len("(SELECT ") : body.index(" FROM (SELECT ")]
    return (
        f"{target} AS (SELECT * EXCLUDE (qx, qy), {chars} AS {column} FROM (SELECT *, "
        f"CAST(floor(({lon} + 180) / 360 * {1 << lon_bits}) AS BIGINT) AS qx, "
        f"CAST(floor(({lat} + 90) / 180 * {1 << lat_bits}) AS BIGINT) AS qy FROM {source}))"
    )


def box_geohash_cte(source: str, target: str, column: str = "geohash11", length: int = 11) -> str:
    lon = f"({longitude('x0')} + {longitude('x1')}) / 2"
    lat = f"({latitude('y0')} + {latitude('y1')}) / 2"
    return geohash_cte(source, target, column, lon, lat, length)


def centroid_geohash_cte(source: str, target: str, column: str, length: int = 11) -> str:
    return geohash_cte(
        source, target, column, longitude("(x0 + x1) / 2.0"), latitude("(y0 + y1) / 2.0"), length
    )


# Raw parcels with projected measures and the bounding-box geohash.
MEASURED = ",\n".join(
    [
        PARCELS,
        albers_corners("fx_parcels", "fx_corners"),
        f"fx_areas AS (SELECT * EXCLUDE (pax, pay, pbx, pby, pcx, pcy, pdx, pdy), {ALBERS_AREA} AS area_sqm, {ALBERS_PERIMETER} AS perimeter FROM fx_corners)",
        box_geohash_cte("fx_areas", "fx_measured"),
    ]
)

OREGON_WORDS = "(ROAD|WATER|RAIL|NONTL|CANAL|RIVER|GAP|RR|WTR|STR|R/R)"
WASHINGTON_WORDS = "(ALLOTTED|ONF|TRIBAL|DNR|BLM|STATE|WNF|ONP|IS|RES)"

OREGON_EXCLUDED = f"""
or_excluded AS (
  SELECT id FROM fx_measured
  WHERE regexp_matches(orig_key, '{OREGON_WORDS}', 'i')
     OR ((nullif(trim(orig_key), '') IS NULL OR trim(orig_key) = '0')
         AND 4 * area_sqm / nullif(perimeter ** 2, 0) < 0.02))"""

OREGON_CLEAN = OREGON_EXCLUDED + """,
or_clean AS (
  SELECT id, county, coalesce(nullif(trim(orig_key), ''), county_fips || '_' || geohash11) AS maptaxlot,
    area_sqm, perimeter, geohash11, x0, y0, x1, y1
  FROM fx_measured m WHERE NOT EXISTS (SELECT 1 FROM or_excluded e WHERE e.id = m.id))"""

OREGON_UNIQUE = """
or_unique AS (
  SELECT c.* FROM or_clean c JOIN (SELECT maptaxlot FROM or_clean GROUP BY maptaxlot HAVING count(*) = 1) u USING (maptaxlot)),
or_dups AS (
  SELECT DISTINCT maptaxlot FROM (
    SELECT maptaxlot, row_number() OVER (PARTITION BY geohash11 ORDER BY maptaxlot) AS rn FROM or_unique) WHERE rn > 1),
or_single AS (SELECT * FROM or_unique WHERE maptaxlot NOT IN (SELECT maptaxlot FROM or_dups)),
or_wide AS (SELECT * FROM or_single WHERE NOT coalesce(4 * area_sqm / nullif(perimeter ** 2, 0) < 0.03, false))"""

WASHINGTON_EXCLUDED = f"""
wa_excluded AS (
  SELECT id FROM fx_measured
  WHERE ((nullif(trim(orig_key), '') IS NULL OR trim(orig_key) = '0'
          OR (TRY_CAST(trim(orig_key) AS DECIMAL(38, 10)) IS NULL
              AND NOT regexp_matches(orig_key, '{WASHINGTON_WORDS}', 'i') AND landuse_cd IS NULL))
    AND (4 * area_sqm / nullif(perimeter ** 2, 0) < 0.02 OR area_sqm > 10000000)))"""


def with_ctes(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(p.strip() for p in parts) + "\n"
