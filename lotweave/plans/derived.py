"""Parcel-like tables derived from the star-schema test tables.

The test tables hold no geometry. Keys are turned into integer rectangles by
plain arithmetic, so every spatial result has a closed form that can be checked
in SQL, and the volume grows with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotweave.functions import geometry as g

X0, Y0 = -13700000, 5300000
PIXEL, RASTER_SIZE, STRIP = 10, 4500, 250
NODATA = -9999.0
SCENE, SCENE_PIXELS = 24, (5.0, 10.0, 20.0, 7.5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task that works on geometry.
TASK_ROWS = 1 << 17


def spread(df: DataFrame, key: str, rows: int = 0) -> DataFrame:
    """Narrow rows over all cores before geometry makes them expensive; of ``rows`` no task gets more than about ``TASK_ROWS``."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), key)


def _with_geom(df: DataFrame) -> DataFrame:
    return df.withColumn("geom", g.rectangle(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw parcel per order: untidy keys, strips, large blocks, clusters of copies."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "o_orderkey AS id", "o_custkey AS ck", "n_name AS county",
            "lpad(cast(n_nationkey AS string), 3, '0') AS county_fips",
            "o_orderkey % 53 AS m", "o_orderkey % 23 AS s", "o_orderkey % 300 AS gr",
            "(o_orderkey div 300) % 5 AS q",
        )
    )
    plain = "m NOT BETWEEN 6 AND 15"
    sized = base.selectExpr(
        "id", "county", "county_fips",
        """CASE WHEN m = 0 THEN NULL WHEN m = 1 THEN '  ' WHEN m = 2 THEN '0'
                WHEN m = 3 THEN 'Road ' || cast(id % 7 AS string) WHEN m = 4 THEN 'rr-' || cast(id % 11 AS string)
                WHEN m = 5 THEN 'DNR ' || cast(id % 9 AS string)
                WHEN m BETWEEN 6 AND 14 THEN 'DUP' || lpad(cast(gr AS string), 3, '0')
                WHEN m = 15 THEN 'x' || cast(id AS string)
                ELSE ' ' || lpad(cast(id AS string), 8, '0') || ' ' END AS orig_key""",
        "CASE WHEN id % 4 = 0 THEN NULL ELSE 10 + id % 12 END AS landuse_cd",
        f"""CASE WHEN m BETWEEN 6 AND 14 THEN {X0} + (gr % 20) * 1500 + q * IF(gr % 2 = 0, 300, 3000)
                 WHEN m = 15 THEN {X0} + ((id div 106) * 7919 % 4001) * 10
                 ELSE {X0} + (id * 7919 % 4001) * 10 END AS x0""",
        f"""CASE WHEN m BETWEEN 6 AND 14 THEN {Y0} + (gr div 20) * 2500
                 WHEN m = 15 THEN {Y0} + ((id div 106) * 104729 % 3989) * 10
                 ELSE {Y0} + (id * 104729 % 3989) * 10 END AS y0""",
        f"""CASE WHEN {plain} AND id % 97 = 1 THEN 4000 WHEN {plain} AND s IN (0, 1) THEN 2000
                 WHEN m = 15 THEN 100 ELSE 20 + (ck % 40) * 10 END AS w""",
        f"""CASE WHEN {plain} AND id % 97 = 1 THEN 4000 WHEN {plain} AND s = 0 THEN 4
                 WHEN {plain} AND s = 1 THEN 54 WHEN m = 15 THEN 100 ELSE 20 + (id % 37) * 10 END AS h""",
    )
    return _with_geom(
        spread(sized, "id", base.count()).selectExpr(
            "id", "county", "county_fips", "orig_key", "landuse_cd", "x0", "y0", "x0 + w AS x1", "y0 + h AS y1"
        )
    )


def layer(spark: SparkSession, sf_dir: str, layer_no: int | None = None) -> DataFrame:
    """Overlapping district rectangles, one of five layers per part."""
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS fid", "p_partkey % 5 AS layer_no", "p_brand AS label", "p_type AS kind",
        f"""{X0} + ((p_partkey div 5) % 20) * 2000 + (p_partkey * 37 % 11) * 30 + (p_partkey div 2000) * 130 AS x0""",
        f"""{Y0} + ((p_partkey div 100) % 20) * 2000 + (p_partkey * 53 % 13) * 20 + (p_partkey div 2000) * 170 AS y0""",
    ).selectExpr("*", "x0 + 2000 + (fid % 7) * 90 AS x1", "y0 + 2000 + (fid % 11) * 70 AS y1")
    if layer_no is not None:
        rows = rows.where(F.col("layer_no") == layer_no)
    return _with_geom(rows)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Populated places, one per supplier."""
    return _with_geom(
        table(spark, sf_dir, "supplier").selectExpr(
            "s_suppkey AS pid", f"{X0} + (s_suppkey * 7919 % 397) * 100 AS x0",
            f"{Y0} + (s_suppkey * 104729 % 389) * 100 AS y0", "cast(floor(s_acctbal) AS bigint) AS population",
            "lpad(cast(s_suppkey AS string), 5, '0') AS placefips", "s_name AS name",
        ).selectExpr("*", "x0 + 1500 AS x1", "y0 + 1500 AS y1")
    )


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_geom(
        table(spark, sf_dir, "nation").selectExpr(
            "lpad(cast(n_nationkey AS string), 3, '0') AS county_fipscode", "n_name AS county_name",
            f"{X0} + (n_nationkey % 5) * 9200 AS x0", f"{Y0} + (n_nationkey div 5) * 9200 AS y0",
        ).selectExpr("*", "x0 + 9200 AS x1", "y0 + 9200 AS y1")
    )


def landuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("10 + p_partkey % 14 AS landuse_cd", "p_type AS descr")


def elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zonal results of an earlier run, one row per raw parcel."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderkey % 900 AS min_elev", "o_orderkey % 900 + o_orderkey % 211 AS max_elev",
        "o_orderkey % 29 AS total_pix", "least((o_orderkey % 29) * (o_orderkey % 11) div 10, o_orderkey % 29) AS forest_pix",
    )


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels whose trimmed key occurs once, with their order status."""
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    raw = parcels(spark, sf_dir).select("id", "county", F.trim("orig_key").alias("map_taxlot"))
    return unique_raw_keys(raw).join(status, "id")


def old_taxlots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous application snapshot: stale values, and a retired key wherever the order is pending."""
    return snapshot_rows(spark, sf_dir).selectExpr(
        "IF(status = 'P', 'OLD' || cast(id AS string), map_taxlot) AS map_taxlot",
        "IF(id % 13 = 0, 'stale' || cast(id AS string), 'g' || cast(id AS string)) AS map_id",
        "cast(CASE WHEN id % 17 = 0 THEN NULL WHEN id % 7 = 0 THEN id % 900 + 1 ELSE id % 900 END AS double) AS min_elevation",
        "cast(id % 900 + id % 211 AS double) AS max_elevation",
        "'zone' || cast(id % 5 AS string) AS orzdesc", "'S' || cast(id % 36 AS string) AS legal_label",
        "'old' AS county",
    )


def new_taxlots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh rows for the current keys."""
    return snapshot_rows(spark, sf_dir).selectExpr(
        "map_taxlot", "'g' || cast(id AS string) AS map_id", "cast(id % 900 AS double) AS min_elevation",
        "cast(id % 900 + id % 211 AS double) AS max_elevation", "'zone' || cast(id % 6 AS string) AS orzdesc",
        "'S' || cast(id % 36 AS string) AS legal_label", "county",
    )


def unique_raw_keys(raw: DataFrame) -> DataFrame:
    once = raw.where("map_taxlot <> ''").groupBy("map_taxlot").agg(F.count("*").alias("n")).where("n = 1")
    return raw.join(once.select("map_taxlot"), "map_taxlot", "left_semi")


def raster(spark: SparkSession) -> DataFrame:
    """Elevation and land-cover bands as pixel strips: one row per band, scan line and strip."""
    strips = spark.range(RASTER_SIZE * (RASTER_SIZE // STRIP)).selectExpr(
        f"id div {RASTER_SIZE // STRIP} AS row_no", f"id % {RASTER_SIZE // STRIP} AS strip_no"
    )
    columns = F.sequence(F.col("strip_no") * STRIP, F.col("strip_no") * STRIP + STRIP - 1)
    j = F.col("row_no")
    elevation_px = F.transform(
        columns, lambda i: F.when((i + j) % 97 == 0, F.lit(NODATA)).otherwise(((31 * i + 17 * j) % 3000 - 5).cast("double"))
    )
    class_px = F.transform(columns, lambda i: ((7 * i + 13 * j) % 9).cast("double"))
    return strips.select(
        "row_no", "strip_no", elevation_px.cast("array<float>").alias("elevation"), class_px.cast("array<float>").alias("cover")
    )


def scenes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(strips, sources): a small raster for every part, of four resolutions, overlapping, with holes and without some lines."""
    k = F.col("p_partkey").cast("int")
    pixel = F.element_at(F.array(*map(F.lit, SCENE_PIXELS)), F.pmod(k, F.lit(4)) + 1)
    sources = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey").select(
        k.alias("source"), (F.col("p_size") % 5).cast("int").alias("priority"),
        (X0 + (k % 40) * 90 + (k * 13 % 7) * 2.5).alias("x0"), (Y0 + F.floor(k / 40) * 90 + (k * 5 % 9) * 2.5).alias("y0"),
        pixel.alias("pixel"), F.lit(SCENE // 3).alias("strip"), F.lit(NODATA).alias("nodata"),
    )
    lines = sources.select("source", F.explode(F.sequence(F.lit(0), F.lit(SCENE - 1))).alias("row_no")).where("(row_no + source) % 13 <> 0")
    strips = lines.withColumn("strip_no", F.explode(F.array(*map(F.lit, range(3)))))
    columns, k, r = F.sequence(F.col("strip_no") * (SCENE // 3), (F.col("strip_no") + 1) * (SCENE // 3) - 1), F.col("source"), F.col("row_no")
    missing = F.lit(NODATA)
    height = F.transform(columns, lambda c: F.when((c + r + k) % 11 == 0, missing).otherwise((31 * c + 17 * r + 3 * k) % 3000 - 5))
    cover = F.transform(columns, lambda c: F.when((c * r + k) % 7 == 0, missing).otherwise((7 * c + 13 * r + k) % 9))
    return strips.select(
        "source", r.cast("long").alias("row_no"), F.col("strip_no").cast("long").alias("strip_no"),
        height.cast("array<float>").alias("elevation"), cover.cast("array<float>").alias("cover"),
    ), sources


# ---- soil ---------------------------------------------------------------------------------------


def soil_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.max("l_quantity").cast("int").alias("comppct_r"))
        .selectExpr("l_partkey AS mukey", "l_partkey * 100000 + l_suppkey AS cokey", "comppct_r")
    )


def soil_coforprod(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_returnflag IN ('R', 'A')").selectExpr(
        "l_partkey * 100000 + l_suppkey AS cokey",
        "CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE l_linestatus || '-' || cast(l_orderkey % 9 AS string) END AS plantcomname",
        "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_orderkey % 120 END AS siteindex_r",
    )


def soil_corestrictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'N'").selectExpr(
        "l_partkey * 100000 + l_suppkey AS cokey", "l_suppkey % 80 AS resdept_l",
        "l_suppkey % 80 + l_linenumber AS resdept_h",
    )


def soil_muaggatt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS mukey", "p_name AS muname", "CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_type END AS drclassdcd",
        "p_brand AS forpehrtdcp",
    )


def soil_mupolygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polygons per third map unit, one for the others."""
    base = layer(spark, sf_dir).selectExpr(
        "fid AS mukey",
        "IF(fid % 2 = 0, 'OR', 'WA') || lpad(cast(fid % 36 AS string), 3, '0') AS areasymbol",
        "'M' || cast(fid % 100 AS string) AS musym", "cast(1 + fid % 4 AS int) AS spatialversion",
        "x0", "y0", "x1", "y1",
    )
    copies = base.select("*", F.explode(F.sequence(F.lit(0), F.when(F.col("mukey") % 3 == 0, 1).otherwise(0))).alias("c"))
    return _with_geom(
        copies.selectExpr(
            "mukey", "areasymbol", "musym", "spatialversion",
            "x0 + c * 5000 AS x0", "y0 + c * 3000 AS y0", "x1 + c * 5000 AS x1", "y1 + c * 3000 AS y1",
        )
    )


# ---- county sources and service metadata --------------------------------------------------------


def county_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw county rows; every fifth order is delivered twice."""
    rows = parcels(spark, sf_dir).selectExpr(
        "id", "cast(county_fips AS int) AS nk", "county", "' ' || cast(id % 1000003 AS string) || ' ' AS map_text",
        "id % 100003 AS lot_no", "'OR' || lpad(cast(id AS string), 16, '0') || 'X' AS long_key",
        "x0", "y0", "x1", "y1", "geom",
    )
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("id") % 5 == 0, 1).otherwise(0)))
    return rows.select("*", copies.alias("copy")).drop("copy")


def layer_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer catalog: one row per (state, layer)."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "lower(r_name) AS state", "lower(n_name) AS layer", "'Layer ' || n_name AS description",
        "n_nationkey % 4 <> 0 AS fetch", "100 * (1 + n_nationkey % 5) AS max_records",
        "n_nationkey % 2 = 0 AS geom",
        "CASE n_nationkey % 3 WHEN 0 THEN 'NAME' WHEN 1 THEN 'NAME, CODE' ELSE 'NAME,CODE,RATE' END AS outfields",
        "CASE n_nationkey % 3 WHEN 0 THEN 'VARCHAR(25)' WHEN 1 THEN 'VARCHAR(25),INTEGER' "
        "ELSE 'VARCHAR(25), INTEGER,DECIMAL(6,2)' END AS dtypes",
        "3857 AS epsg",
    )


def shaped(rows: DataFrame, key: str) -> DataFrame:
    """Rectangles redrawn by key: as they are, L-shapes, frames around a hole, and two parts."""
    box = g.bbox(F.col("geom"))

    def x(k):
        return F.col("_b.minx") + (F.col("_b.maxx") - F.col("_b.minx")) * (k / 4)

    def y(k):
        return F.col("_b.miny") + (F.col("_b.maxy") - F.col("_b.miny")) * (k / 4)

    def ring(*corners):
        return F.array(*[g.point(x(a), y(b)) for a, b in (*corners, corners[0])])

    def block(a, b, c, d):
        return ring((a, b), (c, b), (c, d), (a, d))

    bent = F.array(F.array(ring((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4))))
    frame = F.array(F.array(block(0, 0, 4, 4), ring((1, 1), (1, 3), (3, 3), (3, 1))))
    parts = F.array(F.array(block(0, 0, 1, 4)), F.array(block(3, 0, 4, 4)))
    kind = F.col(key) % 4
    geom = F.when(kind == 1, bent).when(kind == 2, frame).when(kind == 3, parts).otherwise(F.col("geom"))
    return rows.withColumn("_b", box).withColumn("geom", geom).drop("_b")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page attempt per event."""
    return table(spark, sf_dir, "events").selectExpr(
        "'layer' || cast(user_id % 7 AS string) AS layer", "event_id * 100 AS offset",
        "IF(event_type = 'error', 'failed', 'ok') AS status", "1 + user_id % 5 AS attempts",
    )


def probe_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "IF(user_id % 2 = 0, 'oregon', 'washington') AS state", "'layer' || cast(user_id % 7 AS string) AS layer",
        "event_type <> 'error' AS success", "value AS response_time",
    )


#: Records of a stored page, and ids that are numbered in one group.
PAGE = 2500
IDS = 1 << 16


def numbered(rows: DataFrame, by: str, key: str, width: int = IDS) -> DataFrame:
    """Add ``place``, the rank of ``key`` within ``by`` from 0: a rank among keys of like size, and the number of the smaller ones.

    No task sorts more than the rows of ``width`` successive keys.
    """
    ranged = rows.withColumn("_range", F.expr(f"{key} div {width}"))
    sizes = ranged.groupBy(by, "_range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(by).orderBy("_range")) - F.col("n")  # a row a range
    starts = sizes.select(F.col(by).alias("_by"), F.col("_range").alias("_at"), before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy(by, "_range").orderBy(key)) - 1
    found = F.col(by).eqNullSafe(F.col("_by")) & F.col("_range").eqNullSafe(F.col("_at"))
    ranked = ranged.withColumn("_rank", rank).join(starts, found)
    return ranked.withColumn("place", F.col("_before") + F.col("_rank")).select(*rows.columns, "place")


def stored_pages(spark: SparkSession, sf_dir: str, root: str, failed: str = "false") -> None:
    """The parcels of every region as page documents; pages that meet ``failed`` hold an error instead."""
    names = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = parcels(spark, sf_dir).join(names.select(F.col("n_name").alias("county"), F.lower("r_name").alias("layer")), "county")
    ring = "[[" + ",".join(["[%d,%d]"] * 5) + "]]"
    corners = [F.col(c) for pair in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")) for c in pair]
    shape = F.format_string('{"type":"Polygon","coordinates":' + ring + "}", *corners)
    geometry = F.when(F.col("id") % 41 == 0, "null").otherwise(shape)
    properties = F.to_json(F.struct(F.col("id").alias("NUMBER"), F.concat(F.lit('a "b]" \\ {'), "county").alias("NAME")))
    feature = F.format_string('{"type":"Feature","properties":%s,"geometry":%s}', properties, geometry)
    placed = numbered(rows.select("layer", "id", feature.alias("feature")), "layer", "id")
    placed = placed.select("layer", "place", "feature").withColumn("offset", F.expr(f"place div {PAGE} * {PAGE}"))
    pages = placed.groupBy("layer", "offset").agg(F.array_sort(F.collect_list(F.struct("place", "feature"))).alias("held"))
    body = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.col("held.feature"), ","), F.lit("]}"))
    value = F.when(F.expr(failed), '{"error":{"code":500}}').otherwise(body)
    pages.select("layer", "offset", value.alias("value")).write.partitionBy("layer", "offset").text(root)


def one_document(spark: SparkSession, sf_dir: str, path: str) -> None:
    """All parcels as one FeatureCollection in one file, a line a feature; other members stand before and after."""
    ring = "[[" + ",".join(["[%d,%d]"] * 5) + "]]"
    corners = [F.col(c) for pair in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")) for c in pair]
    shape = F.format_string('{"type":"Polygon","coordinates":' + ring + "}", *corners)
    geometry = F.when(F.col("id") % 41 == 0, "null").otherwise(shape)
    properties = F.to_json(F.struct(F.col("id").alias("NUMBER"), F.concat(F.lit('a "b]" \\ {[}'), "county").alias("NAME")))
    rows = parcels(spark, sf_dir)
    first = F.col("id") == rows.agg(F.min("id")).first()[0]
    comma = F.when(first, "").otherwise(",")
    feature = F.concat(comma, F.format_string('{"type":"Feature","properties":%s,"geometry":%s}', properties, geometry))
    head = '{"type":"FeatureCollection","links":[{"features":[{"a":1}]}],"features":['
    tail = '],"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::3857"}},"more":[{"properties":{}}]}'
    lines = rows.select("id", feature.alias("value"))
    edge = spark.createDataFrame([(-1, head), (2**62, tail)], "id long, value string")
    # by a shuffle, so that only the writing is left to one task
    lines.unionByName(edge).repartition(1).sortWithinPartitions("id").select("value").write.text(path)
