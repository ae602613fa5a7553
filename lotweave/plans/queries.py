"""Registered queries: every operator run over the whole derived tables."""

from __future__ import annotations

import uuid

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotweave import api
from lotweave.functions import geometry as g
from lotweave.functions import text
from lotweave.functions.crs import reproject, reproject_point
from lotweave.functions.geohash import geohash_box, geohash_degrees
from lotweave.functions.reuse import with_computed
from lotweave.operators import cleaning as c
from lotweave.operators import maintenance as m
from lotweave.operators import soil, zonal
from lotweave.operators.cluster import cluster_within
from lotweave.operators.dissolve import dissolve, repair
from lotweave.operators.mosaic import mosaic
from lotweave.operators.overlap import largest_overlap, overlay_or_quarantine, overlay_pairs
from lotweave.operators.reducers import Quantiles
from lotweave.operators.spatial_join import points_in_polygons, spatial_pairs
from lotweave.plans import counties as cty
from lotweave.plans import derived as d
from lotweave.plans import layers as lay
from lotweave.plans import taxlots as tx
from lotweave.session import durable, ensure_checkpoint_dir
from lotweave.sources.split import read_geojson_split
from lotweave.sources import catalog, export, features, paged, pages
from lotweave.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
GRID = zonal.Grid(d.X0, d.Y0, d.PIXEL, d.STRIP, d.NODATA)


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---- keys, labels and exclusion rules -----------------------------------------------------------


def _oregon_raw(spark, sf):
    return d.parcels(spark, sf).withColumnRenamed("orig_key", "maptaxlot")


def _washington_raw(spark, sf):
    return d.parcels(spark, sf).select(
        "id", F.col("county").alias("county_nm"), F.col("county_fips").cast("int").alias("fips_nr"),
        F.col("orig_key").alias("orig_parcel_id"), "landuse_cd", "x0", "y0", "x1", "y1", "geom",
    )


def _oregon_clean(spark, sf):
    return c.consolidate_parcels(_oregon_raw(spark, sf), c.OREGON)


@query
def key_normalise(spark, sf):
    rows = d.parcels(spark, sf).withColumn("geohash11", geohash_box(F.col("geom")))
    key = F.coalesce(text.clean_key(F.col("orig_key")), text.fallback_key(F.col("county_fips"), F.col("geohash11")))
    return rows.select("id", key.alias("maptaxlot"))


@query
def state_normalise(spark, sf):
    given = F.element_at(
        F.array(*[F.lit(s) for s in ("Oregon", "OR", "wa", "WASHINGTON", "CA", "Idaho")]),
        (F.col("c_custkey") % 6 + 1).cast("int"),
    )
    rows = d.table(spark, sf, "customer").select("c_custkey", given.alias("given"))
    return rows.select(
        "c_custkey",
        text.normalise_state(F.col("given"), "name").alias("state_name"),
        text.normalise_state(F.col("given"), "abbr").alias("state_abbr"),
    )


@query
def fpd_label(spark, sf):
    described = d.table(spark, sf, "part").select(
        "p_partkey", F.concat(F.col("p_brand"), F.lit(" COUNTY "), F.col("p_type"), F.lit(" COUNTY fire district")).alias("descr")
    )
    return described.select("p_partkey", text.district_label(F.col("descr")).alias("odf_fpd"))


@query
def parcel_exclude_or(spark, sf):
    rows = c.measured(_oregon_raw(spark, sf))
    return rows.where(c.exclusion(c.OREGON)).select("id", F.trim("maptaxlot").alias("key"))


@query
def parcel_exclude_wa(spark, sf):
    rows = c.measured(_washington_raw(spark, sf))
    return rows.where(c.exclusion(c.WASHINGTON)).select("id", F.trim("orig_parcel_id").alias("key"))


@query
def thinness_filter(spark, sf):
    return c.drop_thin(c.measured(d.parcels(spark, sf))).select("id")


@query
def key_suffix_wa(spark, sf):
    cleaned = c.finish_keys(c.consolidate_parcels(_washington_raw(spark, sf), c.WASHINGTON), c.WASHINGTON)
    return cleaned.select("id", "maptaxlot")


# ---- uniqueness and de-duplication --------------------------------------------------------------


@query
def unique_keys(spark, sf):
    return c.unique_rows(_oregon_clean(spark, sf)).select("id", "maptaxlot")


@query
def duplicate_keys(spark, sf):
    cleaned = durable(_oregon_clean(spark, sf).select("id", "maptaxlot"))  # read by both sides of a join
    return c.duplicate_keys(cleaned).select("id", "maptaxlot")


@query
def geohash_dedupe(spark, sf):
    return c.drop_repeated_geohash(c.unique_rows(_oregon_clean(spark, sf), ["geohash11"]))


@query
def conflict_suffix(spark, sf):
    """Every cleaned row as its own cluster: conflicts renamed, then one row per key."""
    spot = g.centroid(F.col("geom")).alias("spot")
    cleaned = durable(_oregon_clean(spark, sf).select("id", "maptaxlot", "area_sqm", "geohash11", spot))  # read four times
    named = c.suffix_conflicts(cleaned, 6, spot=F.col("spot"))
    order = [-F.round("area_sqm", 1), F.col("geohash11")]
    return c.first_per_key(named, "maptaxlot", order, "id").select("id", "maptaxlot")


@query
def first_per_group(spark, sf):
    """County of the largest piece per key, NULL areas first as the source engine sorts them."""
    rows = d.parcels(spark, sf).select(
        F.trim("orig_key").alias("key"), "county",
        F.when(F.col("id") % 19 != 0, g.area(F.col("geom"))).alias("area"), "id",
    )
    lead = F.struct(F.col("area").isNotNull().alias("known"), (-F.col("area")).alias("rank"), F.col("id").alias("id"), "county")
    return rows.where("key IS NOT NULL").groupBy("key").agg(F.min(lead).alias("lead")).select("key", "lead.id", "lead.county")


@query
def insert_ignore(spark, sf):
    incoming = d.parcels(spark, sf).select("id", F.nullif(F.trim("orig_key"), F.lit("")).alias("map_taxlot"))
    return c.insert_ignore(d.old_taxlots(spark, sf), incoming, "map_taxlot", [F.col("map_taxlot")], "id")


# ---- measures -----------------------------------------------------------------------------------


@query
def geohash(spark, sf):
    centre = reproject_point(g.centroid(F.col("geom")), 3857, 4326)
    rows = with_computed(d.parcels(spark, sf), {"_spot": centre})
    lon, lat = F.col("_spot.x"), F.col("_spot.y")
    return rows.select(
        "id", geohash_box(F.col("geom"), 11).alias("box11"), geohash_degrees(lon, lat, 11).alias("centre11"),
        geohash_degrees(lon, lat, 6).alias("centre6"),
    )


@query
def reproject_measure(spark, sf):
    rows = c.measured(d.parcels(spark, sf))
    return rows.select("id", F.round("area_sqm", 1).alias("area_sqm"), F.round("perimeter", 3).alias("perimeter"))


@query
def centroid(spark, sf):
    rows = d.parcels(spark, sf).withColumn("mid", g.centroid(F.col("geom")))
    return rows.select(
        "id", F.col("mid.x").alias("mid_x"), F.col("mid.y").alias("mid_y"),
        g.area(F.col("geom")).alias("area"), g.perimeter(F.col("geom")).alias("perimeter"),
    )


@query
def population_point(spark, sf):
    places = d.places(spark, sf).select(
        F.lit("city").alias("class"), F.lit("OR").alias("st"), "population", "placefips",
        (F.col("population") / 4).alias("pop_sqmi"), F.lit(2.25).cast("double").alias("sqmi"),
        (F.col("pid") % 7).cast("int").alias("pop_class"), "geom",
    )
    points = lay.population_points(places)
    return points.select(*points.columns[:-1], F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))


# ---- spatial joins ------------------------------------------------------------------------------


@query
def spatial_join(spark, sf):
    return spatial_pairs(d.parcels(spark, sf), d.layer(spark, sf), ["id"], ["fid"])


@query
def dominant_huc(spark, sf):
    return largest_overlap(d.parcels(spark, sf), d.layer(spark, sf, 0), "id", "fid", ["label"])


@query
def dominant_zone(spark, sf):
    return largest_overlap(d.parcels(spark, sf), d.layer(spark, sf, 4), "id", "fid", ["kind"])


def _parcel_shapes(spark, sf):
    return d.shaped(d.parcels(spark, sf).select("id", "geom"), "id")


def _layer_shapes(spark, sf, number):
    return d.shaped(d.layer(spark, sf, number), "fid")


@query
def measure_shapes(spark, sf):
    """L-shapes, frames and two-part shapes: area, perimeter, centroid."""
    rows = _parcel_shapes(spark, sf).withColumn("mid", g.centroid(F.col("geom")))
    return rows.select(
        "id", g.area(F.col("geom")).alias("area"), g.perimeter(F.col("geom")).alias("perimeter"),
        F.round("mid.x", 3).alias("mid_x"), F.round("mid.y", 3).alias("mid_y"),
    )


@query
def spatial_join_shapes(spark, sf):
    return spatial_pairs(_parcel_shapes(spark, sf), _layer_shapes(spark, sf, 0), ["id"], ["fid"])


@query
def dominant_shapes(spark, sf):
    best = largest_overlap(_parcel_shapes(spark, sf), _layer_shapes(spark, sf, 0), "id", "fid", ["label"])
    return best.where("overlap_area > 0").select("id", "fid", "label", F.round("overlap_area", 2).alias("overlap_area"))


@query
def points_in_shapes(spark, sf):
    spots = d.parcels(spark, sf).select("id", g.centroid(F.col("geom")).alias("spot"))
    return points_in_polygons(spots, _layer_shapes(spark, sf, 0), "spot", ["id"], ["fid"])


@query
def overlay_shapes(spark, sf):
    """Intersections of two layers of general shapes, by the overlay kernel."""
    first = _layer_shapes(spark, sf, 0).select(F.col("fid").alias("a"), "geom")
    rows = overlay_pairs(first, _layer_shapes(spark, sf, 1).select(F.col("fid").alias("b"), "geom"), ["a"], ["b"])
    return rows.select("a", "b", F.round(g.area(F.col("geom")), 2).alias("area"))


@query
def coa_by_huc(spark, sf):
    coa = d.layer(spark, sf, 2).select(
        F.col("fid").cast("string").alias("coaid"), F.col("label").alias("coaname"), F.col("kind").alias("centroidec"),
        F.concat(F.lit("p/"), F.col("fid").cast("string")).alias("profilelin"), "geom",
    )
    huc = d.layer(spark, sf, 0).select(F.lpad(F.col("fid").cast("string"), 12, "0").alias("huc12"), "geom")
    rows = lay.conservation_areas(coa, huc)
    return rows.select("huc12", "coa_id", "coa_name", "ecoregion", "profile_link", g.area(F.col("geometry")).alias("huc_area"))


@query
def urban_exclusion(spark, sf):
    rows = d.parcels(spark, sf).select("id", g.area(F.col("geom")).alias("area_sqm"), "geom")
    return tx.outside_urban(rows, d.elevation(spark, sf), d.places(spark, sf), "id").select("id", "min_elev", "max_elev")


@query
def county_map(spark, sf):
    old = d.parcels(spark, sf).select("id", "county", "geom")
    return cty.county_mapping(old, d.counties(spark, sf)).select("county", "county_fipscode", "county_name").orderBy("county_fipscode")


@query
def parcel_county(spark, sf):
    spots = d.parcels(spark, sf).select("id", g.centroid(F.col("geom")).alias("spot"))
    return points_in_polygons(spots, d.counties(spark, sf), "spot", ["id"], ["county_fipscode"])


@query
def plss_overlay(spark, sf):
    first = d.layer(spark, sf, 0).select(F.col("fid").cast("string").alias("frstdivno"), "geom")
    town = d.layer(spark, sf, 1).select(F.concat(F.lit("T"), F.col("fid").cast("string")).alias("twnshplab"), "geom")
    rows = lay.legal_sections(first, town).withColumn("box", g.bbox(F.col("geom")))
    return rows.select(
        "legal_desc", g.area(F.col("geom")).alias("area"), F.size("geom").alias("parts"),
        "box.minx", "box.miny", "box.maxx", "box.maxy",
    )


@query
def plss_wa_post(spark, sf):
    return lay.drop_large(d.parcels(spark, sf).select("id", "geom")).select("id", g.area(F.col("geom")).alias("area"))


# ---- enrichment and application table -----------------------------------------------------------


@query
def landuse_lookup(spark, sf):
    return tx.landuse_lookup(d.landuse(spark, sf))


def _oregon_layers(spark, sf):
    fid = F.col("fid").cast("string")
    return {
        "huc": (d.layer(spark, sf, 0).select("fid", fid.alias("huc12"), F.col("label").alias("name"), "geom"), "fid", ["huc12", "name"]),
        "plss": (d.layer(spark, sf, 1).select("fid", F.concat(F.lit("S"), fid).alias("legal_desc"), "geom"), "fid", ["legal_desc"]),
        "fpd": (d.layer(spark, sf, 2).select("fid", F.col("label").alias("odf_fpd"), "geom"), "fid", ["odf_fpd"]),
        "sfd": (d.layer(spark, sf, 3).select("fid", F.col("kind").alias("agency_name"), "geom"), "fid", ["agency_name"]),
        "zoning": (d.layer(spark, sf, 4).select("fid", F.col("kind").alias("orzdesc"), "geom"), "fid", ["orzdesc"]),
    }


def _candidates(spark, sf):
    stats = d.elevation(spark, sf).select("id", "min_elev", "max_elev")
    keyed = d.parcels(spark, sf).join(stats, "id")
    return keyed.select(
        "id", "county", F.col("id").cast("string").alias("maptaxlot"), "landuse_cd",
        F.concat(F.lit("g"), F.col("id").cast("string")).alias("geohash11"), "min_elev", "max_elev", "geom",
    )


@query
def taxlot_enrich(spark, sf):
    return tx.application_rows(_candidates(spark, sf), _oregon_layers(spark, sf), c.OREGON).drop("geometry")


@query
def taxlot_enrich_wa(spark, sf):
    base = _oregon_layers(spark, sf)
    legal = d.layer(spark, sf, 1).select("fid", F.concat(F.lit("S"), F.col("fid").cast("string")).alias("legal_desc_nm"), "geom")
    fpd = d.layer(spark, sf, 2).select("fid", F.concat(F.col("label"), F.lit(" COUNTY district of "), F.col("kind")).alias("fpd_desc"), "geom")
    layers = {"huc": base["huc"], "plss": (legal, "fid", ["legal_desc_nm"]), "fpd": (fpd, "fid", ["fpd_desc"])}
    rows = tx.application_rows(_candidates(spark, sf), layers, c.WASHINGTON, landuse=d.landuse(spark, sf))
    return rows.drop("geometry")


@query
def change_detect(spark, sf):
    return m.changed_rows(
        d.old_taxlots(spark, sf), d.new_taxlots(spark, sf), "map_taxlot", ["map_id", "min_elevation", "max_elevation"]
    ).select("map_taxlot", "map_id", "min_elevation", "max_elevation")


@query
def upsert_taxlot(spark, sf):
    return m.upsert(d.old_taxlots(spark, sf), d.new_taxlots(spark, sf), "map_taxlot")


@query
def delete_vanished(spark, sf):
    new = d.new_taxlots(spark, sf)
    return m.drop_vanished(d.old_taxlots(spark, sf), new, "map_taxlot", "map_taxlot").select("map_taxlot", "map_id")


@query
def upsert_zonal(spark, sf):
    columns = ["map_taxlot", "map_id", "min_elevation", "max_elevation"]
    return m.replace_by_key(d.old_taxlots(spark, sf).select(columns), d.new_taxlots(spark, sf).select(columns), "map_taxlot")


# ---- county consolidation -----------------------------------------------------------------------


@query
def county_union(spark, sf):
    """Five source layouts and a legacy branch, delivered with exact repeats."""
    rows = d.county_sources(spark, sf)
    style = F.col("nk") % 5

    def only(k):
        return rows.where((style == k) & (F.col("nk") < 20))

    sources = {
        "Baker": only(0).withColumnRenamed("map_text", "maptaxlot"),
        "Jackson": only(1).select(F.col("map_text").alias("mapnum"), F.col("lot_no").alias("taxlot"), "geom"),
        "Klamath": only(2).select(F.col("long_key").alias("maptaxlot_"), "geom"),
        "Morrow": only(3).select(F.col("map_text").alias("mapnumber"), F.col("lot_no").cast("string").alias("taxlot"), "geom"),
        "Clatsop": only(4).withColumnRenamed("map_text", "taxmapkey"),
    }
    old = rows.select(F.col("nk").alias("county"), F.col("map_text").alias("maptaxlot"), "geom", "id")
    names = d.counties(spark, sf).select(
        F.col("county_fipscode").cast("int").alias("county"), "county_fipscode",
        F.when(F.col("county_fipscode") >= "020", "Linn").otherwise(F.col("county_name")).alias("county_name"),
    )
    result = cty.consolidate(sources, old, names)
    box = g.bbox(F.col("geom"))
    return result.select(
        "county", "maptaxlot", "county_fips", box["minx"].alias("minx"), box["miny"].alias("miny"),
        box["maxx"].alias("maxx"), box["maxy"].alias("maxy"),
    )


# ---- clustering, dissolve, repair ---------------------------------------------------------------


def _clusters(spark, sf):
    """Planar distances, so that the result has a closed form."""
    cleaned = durable(_oregon_clean(spark, sf))
    return cluster_within(c.duplicate_keys(cleaned), distance_srid=3857)


@query
def dbscan_clusters(spark, sf):
    return _clusters(spark, sf).select("id", "maptaxlot", "cid")


@query
def dissolve_round1(spark, sf):
    group = ["county", "maptaxlot", "cid"]
    pieces = dissolve(_clusters(spark, sf), group)
    return pieces.groupBy(*group).agg(F.sum(g.area(F.col("geom"))).alias("area"))


@query
def dissolve_round2(spark, sf):
    merged, _ = tx.merge_clusters(_clusters(spark, sf), area_srid=3857)
    return merged.select("maptaxlot", "cid", "county", F.col("area_sqm").alias("area"), "geohash11")


@query
def geometry_repair(spark, sf):
    """Parcels redrawn as bow-ties wherever the landuse code is missing."""
    def spot(x, y):
        return g.point(F.col(x), F.col(y))

    bow = F.array(F.array(F.array(spot("x0", "y0"), spot("x1", "y1"), spot("x1", "y0"), spot("x0", "y1"), spot("x0", "y0"))))
    rows = d.parcels(spark, sf).select("id", F.when(F.col("landuse_cd").isNull(), bow).otherwise(F.col("geom")).alias("geom"))
    fixed = repair(rows)
    return fixed.select("id", "repaired", F.size("geom").alias("parts"), F.round(g.area(F.col("geom")), 3).alias("area"))


@query
def dedupe_report(spark, sf):
    return tx.clean_parcels(_oregon_raw(spark, sf), c.OREGON, distance_srid=3857).report()


@query
def clean_taxlots(spark, sf):
    """The finished parcel table of the cleaning run."""
    final = tx.clean_parcels(_oregon_raw(spark, sf), c.OREGON, distance_srid=3857, merge_srid=3857).final
    return final.select(
        "county", "maptaxlot", "geohash11", F.round(g.area(F.col("geom")), 3).alias("planar_area"), (F.size("geom") > 0).alias("has_outline")
    )


@query
def dissolve_near_copies(spark, sf):
    """Six copies of each parcel that differ by up to a millimetre, united: the parcel's own area."""
    rows = d.parcels(spark, sf).select("id", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("k"), "geom")
    off = lambda v, salt: v + F.pow(F.lit(10.0), -(3 + F.col("k") % 4)) * (F.pmod(F.xxhash64(v, F.col("k"), F.lit(salt)), F.lit(2001)) / 1000 - 1)
    moved = F.transform("geom", lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: g.point(off(p["x"], 1), off(p["y"], 2)))))
    pieces = dissolve(rows.select("id", moved.alias("geom")), ["id"])
    whole = pieces.groupBy("id").agg(F.sum(g.area(F.col("geom"))).alias("area"))
    own = d.parcels(spark, sf).select("id", g.area(F.col("geom")).alias("one"), g.perimeter(F.col("geom")).alias("edge"))
    # each edge lies within two millimetres of its place
    close = F.abs(F.col("area") - F.col("one")) <= 0.002 * F.col("edge") + 0.001
    return own.join(whole, "id", "left").select("id", F.round("one", 1).alias("area"), F.coalesce(close, F.lit(False)).alias("close"))


@query
def repaired_geohash(spark, sf):
    """Parcels with a spike along one side: the geohash that is stored is that of the repaired outline."""
    spot = lambda x, y: g.point(x, F.col(y))
    x0, x1 = F.col("x0"), F.col("x1")
    far = F.when(F.col("landuse_cd").isNull(), x1 + 400.0).otherwise(x1)
    ring = F.array(spot(x0, "y0"), spot(far, "y0"), spot(x1, "y0"), spot(x1, "y1"), spot(x0, "y1"), spot(x0, "y0"))
    rows = d.parcels(spark, sf).select("id", F.array(F.array(ring)).alias("geom")).withColumn("geohash11", geohash_box(F.col("geom")))
    return c.current_geohash(repair(rows)).select("id", "geohash11")


@query
def clean_taxlots_wa(spark, sf):
    """Washington rules end to end, with planar distances so that the result has a closed form."""
    final = tx.clean_parcels(_washington_raw(spark, sf), c.WASHINGTON, distance_srid=3857, merge_srid=3857).final
    return final.select("county", "maptaxlot", "landuse_cd", "geohash11", F.round(g.area(F.col("geom")), 3).alias("planar_area"))


# ---- soil ---------------------------------------------------------------------------------------


@query
def soil_mukeys(spark, sf):
    return soil.state_map_units(d.soil_mupolygon(spark, sf), "OR")


@query
def soil_response(spark, sf):
    """Positional rows decoded from response documents, one document per map unit."""
    body = F.to_json(F.struct(F.array(F.array("areasymbol", F.col("mukey").cast("string"))).alias("Table")))
    documents = d.soil_mupolygon(spark, sf).select(body.alias("body"))
    return soil.decode_positional(documents, "body", ["areasymbol", "mukey"]).distinct()


def _soil_data(spark, sf):
    return soil.soil_rollup(
        d.soil_muaggatt(spark, sf), d.soil_component(spark, sf), d.soil_coforprod(spark, sf), d.soil_corestrictions(spark, sf)
    )


@query
def soil_rollup(spark, sf):
    return _soil_data(spark, sf)


def _soil_geom(spark, sf):
    polygons = d.soil_mupolygon(spark, sf)
    return soil.soil_polygons(d.soil_muaggatt(spark, sf), polygons, polygons)


@query
def soil_geom(spark, sf):
    box = g.bbox(F.col("geom"))
    return _soil_geom(spark, sf).select("mukey", "areasymbol", "musym", "spatialversion", box["minx"].alias("minx"), box["miny"].alias("miny"))


@query
def soil_app(spark, sf):
    rows = soil.soil_application(_soil_data(spark, sf), _soil_geom(spark, sf))
    return rows.select(
        "mukey", "areasym", "spatial", "musym", F.round("shp_lng", 2).alias("shp_lng"), F.round("shap_ar", 3).alias("shap_ar"),
        "si_label", "muname", "drclssd", "frphrtd", "avg_rs_l", "avg_rs_h",
    )


# ---- rasters ------------------------------------------------------------------------------------


def _zonal_parcels(spark, sf):
    return d.parcels(spark, sf).select("id", "geom")


@query
def zonal_todo(spark, sf):
    rows = d.parcels(spark, sf).select(
        F.col("id").cast("string").alias("maptaxlot"), (F.col("id") % 7).cast("string").alias("geohash11"), g.area(F.col("geom")).alias("area_sqm")
    )
    done = d.elevation(spark, sf).select(
        F.col("id").cast("string").alias("maptaxlot"), (F.col("total_pix") % 7).cast("string").alias("geohash11")
    )
    return m.pending_zonal(rows, done, 2023.0).select("maptaxlot", "geohash11", "area_sqm")


@query
def zonal_stats(spark, sf):
    return zonal.parcel_statistics(_zonal_parcels(spark, sf), d.raster(spark), GRID, ["id"])


@query
def zonal_histogram(spark, sf):
    return zonal.class_histogram(_zonal_parcels(spark, sf), d.raster(spark), GRID, ["id"])


@query
def zonal_custom(spark, sf):
    """A reducer of the caller's: median and upper decile of elevation, variety and majority of classes."""
    wanted = Quantiles({"median_elev": 0.5, "upper_elev": 0.9})
    return zonal.reduce_zones(_zonal_parcels(spark, sf), d.raster(spark), GRID, ["id"], wanted)


@query
def raster_mosaic(spark, sf):
    """A raster for every part on one grid: what each strip holds, as numbers that tell its pixels and their places."""
    strips = mosaic(*d.scenes(spark, sf), GRID)

    def told(name: str, scale: int, turn: int) -> tuple:
        valid = F.filter(F.transform(name, lambda v, j: F.struct(v.alias("v"), j.alias("j"))), lambda p: p["v"] != d.NODATA)
        weighed = F.transform(valid, lambda p: F.floor(p["v"] * scale) * (p["j"] % turn + 1))
        return F.size(valid).cast("long"), F.aggregate(weighed, F.lit(0).cast("long"), lambda a, v: a + v)

    (heights, height_sum), (covers, cover_sum) = told("elevation", 1000, 7), told("cover", 1, 5)
    return strips.select(
        "row_no", "strip_no", heights.alias("heights"), height_sum.alias("height_sum"), covers.alias("covers"), cover_sum.alias("cover_sum")
    )


@query
def extent_tiles(spark, sf):
    shapes = d.counties(spark, sf).select("geom").union(d.places(spark, sf).select("geom")).distinct()
    boxes = shapes.select(g.bbox(reproject(F.col("geom"), 3857, 5070)).alias("b")).select("b.*")
    tiles = zonal.extent_tiles(boxes)
    return tiles.select("tx", "ty", *[F.round(n, 1).alias(n) for n in ("x0", "y0", "x1", "y1")])


# ---- ingestion ----------------------------------------------------------------------------------


@query
def paged_scan_plan(spark, sf):
    """Page plan per customer segment and nation, sized by its number of orders."""
    counts = (
        d.parcels(spark, sf).groupBy(F.lower("county").alias("layer")).agg(F.count("*").alias("total"))
        .join(d.layer_entries(spark, sf).select("layer", "max_records"), "layer")
    )
    return pages.page_plan(counts).select("layer", "page_no", "offset", "records")


@query
def source_filter(spark, sf):
    """A declared `where` on the fields of a stored layer."""
    rows = catalog.filtered(d.table(spark, sf, "events"), "event_type = 'purchase' AND value > 20")
    return rows.select("event_id", "user_id", "value")


@query
def overlay_quarantine(spark, sf):
    """Two layers in which some outlines are open and some corners are no numbers: what could be overlaid, and the reasons of the rest."""

    def harmed(number, name):
        open_ = F.transform("geom", lambda part: F.transform(part, lambda ring: F.slice(ring, F.lit(1), F.size(ring) - 1)))
        lost = g.map_vertices(F.col("geom"), lambda v: g.point(F.when(v["x"] == F.col("_b.maxx"), F.lit(float("nan"))).otherwise(v["x"]), v["y"]))
        rows = _layer_shapes(spark, sf, number).withColumn("_b", g.bbox(F.col("geom")))
        geom = F.when(F.expr("fid div 5 % 11 = 3"), open_).when(F.expr("fid div 5 % 13 = 5"), lost).otherwise(F.col("geom"))
        return rows.select(F.col("fid").alias(name), geom.alias("geom"))

    rows, bad = overlay_or_quarantine(harmed(0, "a"), harmed(1, "b"), ["a"], ["b"])
    fine = rows.select("a", "b", F.round(g.area(F.col("geom")), 2).alias("area"), F.col("remark").alias("reason"))
    return fine.unionByName(bad, allowMissingColumns=True)


@query
def ingest_status(spark, sf):
    """Planned pages against stored ones: what is missing, failed or short, per layer."""
    log = d.page_log(spark, sf)
    held = F.when(F.col("offset") % 500 == 0, 99).otherwise(100)
    body = F.concat(F.lit('{"features":['), F.array_join(F.array_repeat(F.lit("1"), held), ","), F.lit("]}"))
    totals = log.groupBy("layer").agg((F.max("offset") + 200).alias("total")).withColumn("max_records", F.lit(100))
    gaps = pages.page_gaps(log.withColumn("body", body), totals)
    return gaps.groupBy("layer", "status").agg(F.count("*").alias("pages"))


@query
def page_ledger(spark, sf):
    log = d.page_log(spark, sf)
    retried = pages.failed_ledger(log).select(
        "layer", "offset", F.when(F.col("offset") % 300 == 0, "failed").otherwise("ok").alias("status"),
        (F.col("attempts") + 5).alias("attempts"),
    )
    return pages.ledger_summary(pages.replay(log, pages.failed_ledger(log), retried))


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def paged_source(spark, sf):
    """All stored pages through the paged source, features typed and shapes read; one page holds an error."""
    root = _scratch(spark, "pages")
    d.stored_pages(spark, sf, root, "layer = 'asia' AND offset = 0")
    scanned = paged.scan(spark, root, max_records=d.PAGE)
    typed = features.typed_features(scanned, "feature", catalog.declared_schema("NUMBER,NAME", "BIGINT,VARCHAR(40)"), True, ("layer", "offset", "position", "status"))
    shape = features.geometry_from_geojson(F.col("geometry"))
    return typed.select("layer", "offset", "position", "status", "NUMBER", "NAME", g.area(shape).alias("area"))


@query
def page_replay(spark, sf):
    """A layer ingested with failed pages, replayed from a later fetch of which a part fails again."""
    ws = Workspace(spark, _scratch(spark, "replay"))
    first, second = _scratch(spark, "pages"), _scratch(spark, "pages")
    d.stored_pages(spark, sf, first, "offset % 10000 = 0")
    d.stored_pages(spark, sf, second, "offset % 20000 <> 0")
    entry = dict(
        state="oregon", layer="asia", description="Parcels", epsg=3857, outfields="NUMBER", dtypes="BIGINT", fetch=True, geom=True, max_records=d.PAGE
    )
    entries = catalog.catalog_from_rows(spark, [entry])
    api.ingest(ws, "oregon", entries, first, ["asia"])
    api.replay(ws, "oregon", entries, second)
    page = F.col("_page").cast("long").alias("page")
    pages_ = ws.staging("oregon", "asia").groupBy(page).agg(F.count("*").alias("rows"), F.sum("NUMBER").alias("ids"), F.min("id").alias("first_id"))
    bad = ws.staging("oregon", "asia_quarantine").groupBy(page).agg(F.count("*").alias("quarantined"))
    ledger = ws.staging("oregon", "asia_ledger").select(F.col("offset").alias("page"), "status")
    return pages_.join(bad, "page", "full_outer").join(ledger, "page", "full_outer")


@query
def layer_catalog(spark, sf):
    return catalog.available_layers(catalog.fetchable(d.layer_entries(spark, sf)))


@query
def state_catalog(spark, sf):
    rows = catalog.list_states(d.layer_entries(spark, sf))
    return rows.select("state", F.array_join("layers", ",").alias("layers"), F.col("n_layers"))


@query
def declared_schema(spark, sf):
    rows = catalog.declared_columns(d.layer_entries(spark, sf))
    return rows.select("state", "layer", F.col("position").cast("int").alias("position"), "name", "sql_type", "mismatch")


@query
def probe_summary(spark, sf):
    return catalog.probe_summary(d.probe_log(spark, sf), "state")


def _feature_pages(spark, sf):
    """GeoJSON documents, one feature each; the geometry is missing or broken for some shapes."""
    ring = F.concat_ws(
        ",", *[F.concat(F.lit("["), F.col(x), F.lit(","), F.col(y), F.lit("]"))
               for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))]
    )
    shape = F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}"))
    geometry = F.when(F.col("landuse_cd").isNull(), "null").when(F.col("landuse_cd") == 13, '{"type":"Polygon"}').otherwise(shape)
    properties = F.to_json(F.struct(F.col("id").alias("ID"), F.col("county").alias("NAME"), F.col("landuse_cd").alias("code")))
    body = F.concat(F.lit('{"features":[{"properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}]}"))
    return d.parcels(spark, sf).select(body.alias("body"))


_FEATURE_SCHEMA = catalog.declared_schema("ID,NAME,CODE", "BIGINT,VARCHAR(25),INTEGER")


@query
def geojson_rows(spark, sf):
    """Property names are case-sensitive, so the lower-case code comes back empty."""
    loaded, _ = features.with_geometry(features.feature_rows(_feature_pages(spark, sf), "body", _FEATURE_SCHEMA), "geometry")
    return loaded.select("ID", "NAME", "CODE", "srid", g.area(F.col("geom")).alias("area"))


@query
def geometry_quarantine(spark, sf):
    _, bad = features.with_geometry(features.feature_rows(_feature_pages(spark, sf), "body", _FEATURE_SCHEMA), "geometry")
    return bad.select("ID", "reason")


@query
def vector_import(spark, sf):
    """WKT written, parsed and moved to the Oregon foot grid and back."""
    rows = d.parcels(spark, sf).select("id", features.geometry_to_wkt(F.col("geom")).alias("wkt"))
    loaded, _ = features.with_geometry(rows, "wkt", "wkt", 3857, 2913)
    back = loaded.withColumn("back", g.bbox(reproject(F.col("geom"), 2913, 3857)))
    return back.select(
        "id", "srid", F.round("back.minx", 3).alias("x0"), F.round("back.miny", 3).alias("y0"),
        F.round("back.maxx", 3).alias("x1"), F.round("back.maxy", 3).alias("y1"),
    )


@query
def vector_split(spark, sf):
    """One document with all parcels, read by byte ranges; its reference system stands behind the features."""
    path = f"{ensure_checkpoint_dir(spark)}/document-{uuid.uuid4().hex}"
    d.one_document(spark, sf, path)
    loaded, bad = read_geojson_split(spark, path, catalog.declared_schema("NUMBER,NAME", "BIGINT,VARCHAR(40)"))
    fine = loaded.select("NUMBER", "NAME", "srid", g.area(F.col("geom")).alias("area"), F.lit(None).cast("string").alias("reason"))
    return fine.unionByName(bad.select("NUMBER", "NAME", "reason"), allowMissingColumns=True)


@query
def metadata_catalog(spark, sf):
    field = F.array(
        F.struct(F.lit("OBJECTID").alias("name"), F.lit("esriFieldTypeOID").alias("type"), F.lit(None).cast("int").alias("length")),
        F.struct(F.lit("Brand").alias("name"), F.lit("esriFieldTypeString").alias("type"), F.col("p_size").alias("length")),
        F.struct(F.lit("Price").alias("name"), F.lit("esriFieldTypeDouble").alias("type"), F.lit(None).cast("int").alias("length")),
    )
    count = F.when(F.col("p_size") % 3 != 0, F.col("p_size") * 300).cast("int")
    body = F.to_json(F.struct(field.alias("fields"), F.struct(F.lit(3857).alias("wkid")).alias("spatialReference"), count.alias("maxRecordCount")))
    url = F.concat(F.lit("https://example.org/rest/Part-"), F.col("p_partkey").cast("string"), F.lit("_x/?f=json"))
    documents = d.table(spark, sf, "part").select(url.alias("url"), body.alias("body"))
    return catalog.entries_from_metadata(documents)


# ---- contracts and export -----------------------------------------------------------------------


@query
def contract_check(spark, sf):
    """Violations of every rule; some outlines are empty and some are lines."""
    line = F.transform("geom", lambda part: F.transform(part, lambda ring: F.slice(ring, 1, 2)))
    geom = F.when(F.col("id") % 10 == 0, F.slice("geom", 1, 0)).when(F.col("id") % 10 == 1, line).otherwise(F.col("geom"))
    rows = d.parcels(spark, sf).select(F.trim("orig_key").alias("key"), "county", "landuse_cd", geom.alias("geom"))
    contract = export.Contract(
        required=("key", "landuse_cd"), unique=("key",), lengths={"key": 7, "county": 6}, polygonal=("geom",)
    )
    return export.violations(rows, contract)


@query
def export_profile(spark, sf):
    """Columns of an export, and whether what is read back has the same content."""
    rows = d.parcels(spark, sf).drop("geom").withColumn("surrogate", F.col("id") + 1)
    path = f"{ensure_checkpoint_dir(spark)}/export-{uuid.uuid4().hex}"
    export.export_table(rows, path, "surrogate")
    back = spark.read.parquet(path)
    wrong = export.verify_export(rows, back, "surrogate").select("name", F.lit(False).alias("same"))
    shape = export.schema_profile(back).select("name", "type", "nullable")
    profile = export.content_profile(back).join(shape, "name").join(wrong, "name", "left")
    return profile.select("name", "rows", "nulls", "type", "nullable", F.coalesce("same", F.lit(True)).alias("same"))
