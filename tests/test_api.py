import json

import pytest
from pyspark.sql import functions as F

from lotweave import api
from lotweave.functions import geometry as g
from lotweave.functions.crs import reproject
from lotweave.operators import zonal
from lotweave.sources import catalog, export
from lotweave.workspace import Workspace
from tests.shapes import as_geom, square

GEOM = "geom array<array<array<struct<x:double,y:double>>>>"
LAYERS = [
    dict(state="oregon", layer="fpd", description="Districts", epsg=3857, outfields="ODF_FPD", dtypes="VARCHAR(25)", fetch=True, geom=True, max_records=2),
    dict(state="oregon", layer="plss1", outfields="A", dtypes="INTEGER", fetch=True, geom=True),
    dict(state="oregon", layer="plss2", outfields="A", dtypes="INTEGER", geom=True),
    dict(state="oregon", layer="taxlots", fetch=False, geom=True),
    dict(state="washington", layer="landuse", outfields="LANDUSE_CD,DESCR", dtypes="INTEGER,VARCHAR(72)", geom=False),
]


@pytest.fixture
def ws(spark, tmp_path):
    return Workspace(spark, str(tmp_path / "ws"))


@pytest.fixture
def entries(spark):
    return catalog.catalog_from_rows(spark, LAYERS)


class Recorder:
    def __init__(self, fail=()):
        self.calls, self.fail = [], fail

    def __call__(self, ws, state, entry, page_root, overwrite):
        self.calls.append((state, entry["layer"], overwrite))
        if entry["layer"] in self.fail:
            raise RuntimeError("unreachable")


def test_all_layers_of_a_state(ws, entries):
    load = Recorder()
    status = api.ingest(ws, "oregon", entries, "", load=load)
    assert status == {"fpd": "ok", "plss1": "ok", "plss2": "ok", "taxlots": "skipped"}
    assert load.calls == [("oregon", n, False) for n in ("fpd", "plss1", "plss2")]


@pytest.mark.parametrize("names", [["fpd"], ["fpd", "plss1"], ["plss2"]])
def test_named_layers(ws, entries, names):
    load = Recorder()
    api.ingest(ws, "OR", entries, "", names, overwrite=True, load=load)
    assert load.calls == [("oregon", n, True) for n in names]


def test_soil_and_elevation_have_their_own_loaders(ws, entries):
    seen = []
    loaders = {n: lambda w, s, n=n: seen.append((n, s)) for n in ("soil", "elevation")}
    assert api.ingest(ws, "CA", entries, "", ["soil"], loaders=loaders) == {"soil": "ok"}
    load = Recorder()
    api.ingest(ws, "OR", entries, "", ["elevation", "fpd", "soil"], loaders=loaders, load=load)
    assert seen == [("soil", "ca"), ("soil", "or"), ("elevation", "oregon")] and len(load.calls) == 1


def test_failures(ws, entries):
    assert api.ingest(ws, "oregon", entries, "", load=Recorder(["plss1"]))["plss1"].startswith("failed")
    with pytest.raises(RuntimeError):
        api.ingest(ws, "oregon", entries, "", ["plss1"], load=Recorder(["plss1"]))
    with pytest.raises(ValueError):
        api.ingest(ws, "idaho", entries, "")
    assert api.ingest(ws, "oregon", entries, "", ["nothing"]) == {"nothing": "unknown"}


@pytest.mark.parametrize("table, state", [("parcels", "oregon"), ("coa", "WA"), ("taxlots", "idaho")])
def test_unknown_tables_raise(ws, table, state):
    with pytest.raises(ValueError):
        api.build(ws, table, state)


@pytest.mark.parametrize("table", api.TABLES)
def test_build_routes_by_table_and_state(ws, monkeypatch, table):
    calls = []
    monkeypatch.setitem(api.BUILDERS, (table, "oregon"), lambda w, s: calls.append((table, s)))
    api.build(ws, table, "OR")
    assert calls == [(table, "oregon")]


def test_pages_to_staging(spark, ws, entries, tmp_path):
    folder = tmp_path / "pages" / "layer=fpd"
    folder.mkdir(parents=True)

    def feature(name, geometry):
        return {"properties": {"ODF_FPD": name, "extra": 1}, "geometry": geometry}

    ring = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    page = {"features": [feature("a", {"type": "Polygon", "coordinates": [ring]}), feature("b", None), feature(None, {"type": "MultiPolygon", "coordinates": [[ring]]})]}
    (folder / "0.json").write_text(json.dumps(page))
    (folder / "2.json").write_text(json.dumps({"error": {"code": 500}}))
    (folder / "4.json").write_text("")
    assert api.ingest(ws, "OR", entries, str(tmp_path / "pages"), ["fpd"]) == {"fpd": "incomplete: 2 pages"}  # an error document and an empty page
    assert ws.staging("oregon", "fpd_quarantine").count() == 1
    rows = ws.staging("oregon", "fpd").select("ODF_FPD", "srid", F.size("geom").alias("parts")).collect()
    assert sorted((str(r.ODF_FPD), r.srid, r.parts) for r in rows) == [("None", 3857, 1), ("a", 3857, 1)]
    with pytest.raises(Exception, match="(?i)exist"):
        api.ingest(ws, "OR", entries, str(tmp_path / "pages"), ["fpd"])
    (folder / "count.json").write_text(json.dumps({"count": 8}))
    (folder / "2.json").write_text(json.dumps({"features": [feature("c", None)]}))
    assert api.ingest(ws, "OR", entries, str(tmp_path / "pages"), ["fpd"], overwrite=True) == {"fpd": "incomplete: 3 pages"}
    ledger = {r.offset: r.status for r in ws.staging("oregon", "fpd_ledger").collect()}
    assert ledger == {2: "short", 4: "failed", 6: "missing"}  # the empty page is there, and empty


def test_filter_on_undeclared_fields_and_ids(spark, ws, tmp_path):
    """The parcel layer's own filter names a field that is not kept."""
    entry = dict(
        state="washington", layer="taxlots", epsg=3857, fetch=True, geom=True, max_records=3, where="ABS(Shape__Area) < 1000000000 AND NOT COUNTY_NM LIKE 'or%'",
        outfields="OBJECTID,FIPS_NR,ORIG_PARCEL_ID,LANDUSE_CD,COUNTY_NM,FILE_DATE", dtypes="BIGINT,INTEGER,VARCHAR(20),SMALLINT,VARCHAR(12),BIGINT",
    )
    entries = catalog.catalog_from_rows(spark, [entry])
    folder = tmp_path / "p" / "layer=taxlots"
    folder.mkdir(parents=True)
    areas = [5, -2000000000, 7, 3000000000, 9]
    for offset in (0, 3):
        page = [
            {"properties": {"OBJECTID": i, "FIPS_NR": 1, "ORIG_PARCEL_ID": f"k{i}", "COUNTY_NM": "x", "Shape__Area": a}, "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 0]]]}}
            for i, a in list(enumerate(areas))[offset : offset + 3]
        ]
        (folder / f"{offset}.json").write_text(json.dumps({"features": page}))
    (folder / "count.json").write_text('{"count": 5}')
    assert api.ingest(ws, "WA", entries, str(tmp_path / "p"), ["taxlots"]) == {"taxlots": "ok"}
    rows = ws.staging("washington", "taxlots")
    assert "Shape__Area" not in rows.columns and sorted((r.id, r.OBJECTID) for r in rows.collect()) == [(0, 0), (2, 2), (4, 4)]
    assert api.clean(ws, "WA").count() == 9


def test_oregon_sections_are_composed(spark, ws, tmp_path):
    entries = catalog.catalog_from_rows(
        spark,
        [
            dict(state="oregon", layer="plss1", epsg=3857, outfields="FRSTDIVNO", dtypes="VARCHAR(10)", fetch=True, geom=True, max_records=5),
            dict(state="oregon", layer="plss2", epsg=3857, outfields="TWNSHPLAB", dtypes="VARCHAR(20)", fetch=True, geom=True, max_records=5),
        ],
    )
    for layer, name, value, size in (("plss1", "FRSTDIVNO", "7", 2), ("plss2", "TWNSHPLAB", "T1N R2W", 9)):
        folder = tmp_path / "p" / f"layer={layer}"
        folder.mkdir(parents=True)
        ring = [[0, 0], [size, 0], [size, size], [0, size], [0, 0]]
        page = {"features": [{"properties": {name: value}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}
        (folder / "0.json").write_text(json.dumps(page))
    assert api.ingest(ws, "OR", entries, str(tmp_path / "p")) == {"plss1": "ok", "plss2": "ok"}
    row = ws.staging("oregon", "plss").select("legal_desc", g.area(F.col("geom")).alias("area")).first()
    assert "7" in row.legal_desc and row.area == 4


def test_contract_keeps_broken_snapshots_out(spark, ws):
    rule = export.Contract(required=("k",), unique=("k",))
    ws.write_app_table(spark.createDataFrame([("a",)], "k string"), "t", ["k"], rule)
    with pytest.raises(ValueError, match="unique k: 1 rows"):
        ws.write_app_table(spark.createDataFrame([("a",), ("a",)], "k string"), "t", ["k"], rule)
    assert ws.app_table("t").count() == 1


def test_soil_staging(spark, ws):
    area = as_geom(square(0, 0, 10))
    tables = {
        "muaggatt": spark.createDataFrame([("1", "name", None, None)], "mukey string, muname string, drclassdcd string, forpehrtdcp string"),
        "component": spark.createDataFrame([("1", "c1", 50)], "mukey string, cokey string, comppct_r int"),
        "coforprod": spark.createDataFrame([("c1", "Fir", 90)], "cokey string, plantcomname string, siteindex_r int"),
        "corestrictions": spark.createDataFrame([("c1", 10, 20)], "cokey string, resdept_l int, resdept_h int"),
        "mupolygon": spark.createDataFrame([("1", "OR01", "1", "A", area), ("2", "WA01", "1", "B", area)], f"mukey string, areasymbol string, spatialversion string, musym string, {GEOM}"),
    }
    api.stage_soil(ws, "OR", tables)
    assert ws.staging("oregon", "soil_data").first().si_label == "Fir - 90 ft"
    api.build(ws, "soil", "OR")
    assert ws.app_table("oregon_app_soiltype").count() == 1


def test_import_vector(spark, ws, tmp_path):
    ring = [[-123.0, 45.0], [-122.9, 45.0], [-122.9, 45.1], [-123.0, 45.1], [-123.0, 45.0]]
    document = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": i}, "geometry": {"type": "Polygon", "coordinates": [ring]} if i else None} for i in range(3)]}
    (tmp_path / "c.geojson").write_text(json.dumps(document))
    bad = api.import_vector(ws, str(tmp_path / "c.geojson"), "oregon", "c", catalog.declared_schema("n", "INTEGER"), t_srid=3857)
    assert [(r.n, r.reason) for r in bad.collect()] == [(0, "missing geometry")]
    row = ws.staging("oregon", "c").select("srid", F.col("geom")[0][0][0]["x"].alias("x")).first()
    assert row.srid == 3857 and row.x == pytest.approx(-13692297.37, abs=0.01)
    api.import_vector(ws, str(tmp_path / "c.geojson"), "oregon", "inferred")
    assert ws.staging("oregon", "inferred").schema["n"].dataType.simpleString() == "int"


def _stage(ws, spark, layer, rows, schema, state="oregon"):
    ws.write_staging(spark.createDataFrame(rows, schema), state, layer)


def test_clean_build_and_refresh(spark, ws):
    """Raw parcels to the application table, then a refresh after a change."""
    x, y = -13700000, 5300000

    def parcel(i, key, dx, size=100):
        return (i, "A", "001", key, as_geom(square(x + dx, y, size)))

    raw = [parcel(1, "p1", 0), parcel(2, " p2 ", 1000), parcel(3, "dup", 2000), parcel(4, "dup", 2050), parcel(5, "ROAD", 3000), parcel(6, "dup", 9000), parcel(7, None, 5000)]
    _stage(ws, spark, "taxlots", raw, f"id long, county string, county_fips string, maptaxlot string, {GEOM}")
    report = {r.report: r["count"] for r in api.clean(ws, "OR").collect()}
    assert report["Total unprocessed taxlots"] == 7 and report["Cleaned taxlots"] == 6
    assert report["Deduplicated by clustering multipart taxlots"] == 2 and report["Final taxlot count"] == 5
    keys = sorted(r.maptaxlot for r in ws.staging("oregon", "taxlots_post").collect())
    assert [k.split("_")[0] for k in keys] == ["001", "dup", "dup", "p1", "p2"]

    stats = ws.staging("oregon", "taxlots_post").select("maptaxlot", "geohash11", F.lit(5).alias("min_elev"), F.lit(9).alias("max_elev"), F.lit(10).alias("forest_pix"), F.lit(20).alias("total_pix"))
    ws.write_staging(stats, "oregon", "elevation")
    area = as_geom(square(x - 500, y - 500, 20000))
    _stage(ws, spark, "ppa", [("city", "OR", 5, "00012", 1.0, 2.0, 3, as_geom(square(x - 900, y - 900, 10)))], f"CLASS string, ST string, POPULATION int, PLACEFIPS string, POP_SQMI double, SQMI double, POP_CLASS int, {GEOM}")
    _stage(ws, spark, "huc", [("170900", "Creek", area)], f"huc12 string, name string, {GEOM}")
    _stage(ws, spark, "plss", [("S1 (T1)", area)], f"legal_desc string, {GEOM}")
    for layer, column in (("fpd", "ODF_FPD"), ("sfd", "Agency_Name"), ("zoning", "orZDesc")):
        _stage(ws, spark, layer, [(layer.upper(), area)], f"{column} string, {GEOM}")
    api.build(ws, "taxlots", "OR")
    first = ws.app_table("oregon_app_taxlot")
    assert first.count() == 5
    row = first.where("map_taxlot = 'p1'").first()
    assert (row.odf_fpd, row.agency, row.orzdesc, row.huc12, row.name, row.legal_label, row.source) == ("FPD", "SFD", "ZONING", "170900", "Creek", "S1 (T1)", "ORMAP")
    assert {r.violations for r in export.violations(first, export.CONTRACTS["oregon_app_taxlot"]).collect()} == {0}

    changed = ws.staging("oregon", "taxlots_post").where("maptaxlot <> 'p2'").persist()
    changed.count()
    moved = Workspace(spark, ws.root + "2")
    moved.write_staging(changed, "oregon", "taxlots_post")
    moved.write_staging(ws.staging("oregon", "taxlots_post_pieces"), "oregon", "taxlots_post_pieces")
    moved.write_staging(stats.where("maptaxlot <> 'p2'").withColumn("min_elev", F.lit(1)), "oregon", "elevation")
    for layer in ("ppa", "huc", "plss", "fpd", "sfd", "zoning"):
        moved.write_staging(ws.staging("oregon", layer), "oregon", layer)
    moved.write_app_table(first, "oregon_app_taxlot", ["map_taxlot"])
    api.build(moved, "taxlots", "oregon")
    second = moved.app_table("oregon_app_taxlot")
    assert second.count() == 4 and {r.min_elevation for r in second.collect()} == {1.0}
    assert first.join(second, "id").count() == 4
    spot = changed.select(g.bbox(reproject(F.col("geom"), 3857, 5070)).alias("b")).agg(F.min("b.minx"), F.min("b.miny"), F.max("b.maxx"), F.max("b.maxy")).first()
    grid = zonal.Grid(spot[0], spot[1], 10.0, 50, -9999.0)
    ones = F.array_repeat(F.lit(1.0).cast("float"), 50)
    strips = spark.range(int((spot[3] - spot[1]) / 10 + 1)).select(F.col("id").alias("row_no"), F.explode(F.sequence(F.lit(0), F.lit(int((spot[2] - spot[0]) / 500 + 1)))).alias("strip_no"), ones.alias("elevation"), ones.alias("cover"))
    zones = api.update_elevation(ws, "OR", strips, grid)
    assert zones.count() == 5 and zones.where("forest_pix <> total_pix OR min_elev <> 1").isEmpty()
    assert api.update_elevation(ws, "OR", strips, grid, zones).count() == 5
    fresh = Workspace(spark, ws.root + "3")
    for layer in ("taxlots_post", "taxlots_post_pieces"):
        fresh.write_staging(ws.staging("oregon", layer), "oregon", layer)
    assert api.refresh_elevation(fresh, "OR", strips, grid) == {"processed": 5, "failed": 0}
    assert fresh.staging("oregon", "elevation").count() == 5
    assert api.refresh_elevation(fresh, "OR", strips, grid) == {"processed": 0, "failed": 0}
    api.export_application(ws, "oregon_app_taxlot", ws.root + "-export")
    with pytest.raises(ValueError, match="never built"):
        api.export_application(ws, "oregon_app_coa", ws.root + "-export2")
    api.build(ws, "populationpoint", "OR")
    assert ws.app_table("oregon_app_populationpoint").first().place_fips == 12


def test_export_and_verification(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 == 0, "x").alias("t"))
    export.export_table(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == ["k", "t"] and export.verify_export(df, back).isEmpty()
    assert [r.name for r in export.verify_export(df, back.withColumn("t", F.lit("y"))).collect()] == ["t"]
    assert [(r.name, r.type) for r in export.schema_profile(back).collect()] == [("k", "bigint"), ("t", "string")]


def test_declared_types():
    schema = catalog.declared_schema("A,B,C", "VARCHAR(7), DECIMAL(6,2),SMALLINT")
    assert schema.simpleString() == "struct<A:string,B:decimal(6,2),C:smallint>" and schema["A"].metadata == {"length": 7}
    with pytest.raises(ValueError):
        catalog.declared_schema("A,B", "INTEGER")


def test_url_list(spark, tmp_path):
    (tmp_path / "u.txt").write_text("# list\n\n https://a.org/x/My-Layer/ \nhttps://b.org/Two Words?f=1\n")
    urls = catalog.read_urls(spark, str(tmp_path / "u.txt"))
    assert [r[0] for r in urls.select(catalog.endpoint_name(F.col("url"))).collect()] == ["my_layer", "two_words"]
