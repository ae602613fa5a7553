"""Entry points: ingest layers, build application tables, import files, consolidate, clean."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotweave.functions.crs import reproject
from lotweave.functions.text import normalise_state_name
from lotweave.operators import cleaning as c
from lotweave.operators import soil, zonal
from lotweave.operators.dissolve import subdivide
from lotweave.operators.maintenance import pending_zonal, replace_by_key
from lotweave.operators.spatial_join import DEFAULT_CELL
from lotweave.plans import counties, layers, taxlots
from lotweave.session import durable
from lotweave.sources import catalog, features, paged, pages, vector
from lotweave.sources import split as vector_split
from lotweave.sources.export import CONTRACTS, apply_defaults, export_table, verify_export
from lotweave.workspace import Workspace

Loader = Callable[[Workspace, str], None]
TABLES = ("taxlots", "coa", "soil", "populationpoint")
ZONAL_MIN_AREA = 2023.0


def _page_rows(ws: Workspace, entry: Mapping, scanned: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows, quarantined) of the good pages of a scan.

    Rows carry ``_page`` and, unless the layer declares a field of that name, ``id``, the feature's place in the layer.
    """
    schema = catalog.declared_schema(entry["outfields"] or "", entry["dtypes"] or "")
    extra = catalog.filter_fields(entry["where"], schema.names)
    good = scanned.where("status = 'ok' AND position IS NOT NULL")
    own = [] if "id" in (n.lower() for n in schema.names) else ["id"]
    placed = good.select("feature", F.col("offset").alias("_page"), (F.col("offset") + F.col("position")).alias("id"))
    rows = features.typed_features(placed, "feature", schema, bool(entry["geom"]), ("_page", *own), extra)
    rows = catalog.filtered(rows, entry["where"]).drop(*extra)
    if not entry["geom"]:
        return rows, None
    return features.with_geometry(rows, "geometry", "geojson", entry["epsg"] or 4326)


def _gaps(ws: Workspace, entry: Mapping, page_root: str, scanned: DataFrame) -> DataFrame:
    totals = pages.read_totals(ws.spark, page_root).where(F.col("layer") == entry["layer"])
    totals = totals.withColumn("max_records", F.lit(entry.get("max_records")).cast("long"))
    return durable(pages.page_gaps(paged.page_summary(scanned), totals))


def _compose(ws: Workspace, state: str, layer: str, mode: str) -> None:
    for name, needed, compose in layers.COMPOSED.get((state, layer), ()):
        if all(ws.has_staging(state, n) for n in needed):
            ws.write_staging(compose(*[_lower(ws.staging(state, n)) for n in needed]), state, name, mode)


def load_layer(ws: Workspace, state: str, entry: Mapping, page_root: str, overwrite: bool = False) -> int:
    """Stored pages of one catalog entry into its staging table; returns how many pages are incomplete.

    What arrived is staged, in one folder a page. Pages that are missing, failed or short go to the
    staging table ``<layer>_ledger`` and unreadable features to ``<layer>_quarantine``. A layer whose step after loading
    looks at all rows is also kept as it came, in ``<layer>_pages``.
    """
    layer, mode = entry["layer"], "overwrite" if overwrite else "error"
    scanned = paged.scan(ws.spark, page_root, F.col("layer") == layer, entry.get("max_records"))
    gaps = _gaps(ws, entry, page_root, scanned)
    rows, bad = _page_rows(ws, entry, scanned)
    if bad is not None:
        ws.write_pages(bad, state, f"{layer}_quarantine", mode)
    hook = layers.hook_of(state, layer)
    if hook.by_row:
        ws.write_pages(hook.run(rows), state, layer, mode)
    else:
        ws.write_pages(rows, state, f"{layer}_pages", mode)
        ws.write_staging(hook.run(ws.staging(state, f"{layer}_pages").drop("_page")), state, layer, mode)
    ws.write_staging(gaps, state, f"{layer}_ledger", mode)
    _compose(ws, state, layer, mode)
    return gaps.count()


def replay_layer(ws: Workspace, state: str, entry: Mapping, page_root: str) -> int:
    """Read the pages of a layer's ledger again and put them in their places; returns how many are still incomplete.

    Only the ledger's pages are opened and only their folders written. Pages that are still missing or failed stay
    in the ledger, and what was staged of them before stays staged.
    """
    layer = entry["layer"]
    ledger = durable(ws.staging(state, f"{layer}_ledger"))
    due = [r.offset for r in ledger.select("offset").distinct().collect()]  # pages that failed, not rows
    if not due:
        return 0

    def scanned(offsets: list[int]) -> DataFrame:
        return paged.scan(ws.spark, page_root, (F.col("layer") == layer) & F.col("offset").isin(offsets), entry.get("max_records"))

    summary = durable(paged.page_summary(scanned(due)))
    arrived = [r.offset for r in summary.where("status = 'ok'").select("offset").collect()]
    if arrived:
        rows, bad = _page_rows(ws, entry, scanned(arrived))
        if bad is not None:
            ws.replace_pages(bad, state, f"{layer}_quarantine", arrived)
        hook = layers.hook_of(state, layer)
        if hook.by_row:
            ws.replace_pages(hook.run(rows), state, layer, arrived)
        else:
            ws.replace_pages(rows, state, f"{layer}_pages", arrived)
            ws.write_staging(hook.run(ws.staging(state, f"{layer}_pages").drop("_page")), state, layer, "overwrite")
        _compose(ws, state, layer, "overwrite")
    planned = ledger.select("layer", "offset", "records")
    again = planned.join(summary.drop("layer"), "offset", "left")
    short = (F.col("status") == "ok") & (F.col("features") < F.col("records"))
    status = F.when(F.col("status").isNull(), "missing").when(short, "short").otherwise(F.col("status"))
    left = durable(again.select("layer", "offset", "records", status.alias("status")).where("status <> 'ok'"))
    ws.write_staging(left, state, f"{layer}_ledger", "overwrite")
    return left.count()


def replay(ws: Workspace, state: str, entries: DataFrame, page_root: str, names: Sequence[str] | None = None) -> dict[str, str]:
    """Complete layers whose ledger names pages; a status per layer: ok or incomplete."""
    full = normalise_state_name(state)
    known = {row["layer"]: row.asDict() for row in entries.where(F.lower("state") == full).collect()}
    status = {}
    for name in names or sorted(known):
        if name not in known:
            status[name] = "unknown"
        elif ws.has_staging(full, f"{name}_ledger"):
            short = replay_layer(ws, full, known[name], page_root)
            status[name] = f"incomplete: {short} pages" if short else "ok"
    return status


def ingest(
    ws: Workspace,
    state: str,
    entries: DataFrame,
    page_root: str,
    names: Sequence[str] | None = None,
    overwrite: bool = False,
    loaders: Mapping[str, Loader] | None = None,
    load: Callable = load_layer,
) -> dict[str, str]:
    """Refresh layers of a state and report a status per layer: ok, incomplete, skipped, unknown or failed.

    Named layers stop at the first failure; without names every fetchable layer
    runs and failures are noted. ``soil`` and ``elevation`` have loaders of
    their own, called with the abbreviation and the full name.
    """
    full = normalise_state_name(state)
    special = dict(loaders or {})
    status: dict[str, str] = {}
    wanted = list(names or [])
    for name in ("soil", "elevation"):
        if name in wanted:
            if name not in special:
                raise ValueError(f"no loader given for {name}")
            special[name](ws, normalise_state_name(state, "abbr") if name == "soil" else full)
            status[name] = "ok"
            wanted.remove(name)
    if names and not wanted:
        return status

    # a catalog is configuration: tens of rows per state
    known = {row["layer"]: row.asDict() for row in entries.where(F.lower("state") == full).collect()}
    if not known:
        raise ValueError(f"state {full!r} is not in the catalog")
    for name in wanted or sorted(known):
        entry = known.get(name)
        if entry is None:
            status[name] = "unknown"
        elif entry["fetch"] is False:
            status[name] = "skipped"
        else:
            try:
                short = load(ws, full, entry, page_root, overwrite)
                status[name] = f"incomplete: {short} pages" if short else "ok"
            except Exception as problem:
                if names:
                    raise
                status[name] = f"failed: {problem}"
    return status


def _layers(ws: Workspace, state: str) -> dict:
    def layer(name: str, *fields: str):
        df = ws.staging(state, name)
        renamed = df.select(*[F.col(f).alias(f.lower()) for f in fields], "geom")
        lowered = [f.lower() for f in fields]
        tagged = renamed.withColumn("fid", F.xxhash64(*lowered, "geom"))
        return subdivide(tagged, ["fid", *lowered], DEFAULT_CELL), "fid", lowered

    if state == "washington":
        return {
            "huc": layer("huc", "huc12", "name"),
            "plss": layer("plss", "LEGAL_DESC_NM"),
            "fpd": layer("fpd", "FPD_DESC"),
        }
    return {
        "huc": layer("huc", "huc12", "name"),
        "plss": layer("plss", "legal_desc"),
        "fpd": layer("fpd", "ODF_FPD"),
        "sfd": layer("sfd", "Agency_Name"),
        "zoning": layer("zoning", "orZDesc"),
    }


def parcel_shapes(ws: Workspace, state: str) -> DataFrame:
    """Outlines of the cleaned parcels for spatial joins; those that were united in pieces come piece by piece."""
    pieces = ws.staging(state, "taxlots_post_pieces").select("maptaxlot", "geom")
    whole = ws.staging(state, "taxlots_post").where(F.col("geom").isNotNull()).select("maptaxlot", "geom")
    return whole.join(pieces.select("maptaxlot").distinct(), "maptaxlot", "left_anti").unionByName(pieces)


APP_TAXLOT = (
    "odf_fpd string, agency string, orzdesc string, huc12 string, name string, min_elevation double, "
    "max_elevation double, legal_label string, county string, source string, map_id string, map_taxlot string, "
    "geometry array<array<array<struct<x:double,y:double>>>>"
)


def _build_taxlots(ws: Workspace, state: str) -> str:
    rules = c.RULES[state]
    table = f"{state}_app_taxlot"
    current = ws.app_table(table)
    app = current.drop("id") if current is not None else ws.spark.createDataFrame([], APP_TAXLOT)
    parcels = ws.staging(state, "taxlots_post")
    landuse = ws.staging(state, "landuse").select(F.col("LANDUSE_CD").alias("landuse_cd"), F.col("DESCR").alias("descr")) if state == "washington" else None
    fresh = taxlots.refresh_application(
        app, parcels, ws.staging(state, "elevation"), ws.staging(state, "ppa"), _layers(ws, state), rules, landuse,
        shapes=parcel_shapes(ws, state),
    )
    return ws.write_app_table(fresh, table, ["map_taxlot"], CONTRACTS[table])


def _lower(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(name).alias(name.lower()) for name in df.columns])


def _build_coa(ws: Workspace, state: str) -> str:
    rows = layers.conservation_areas(_lower(ws.staging(state, "coa")), _lower(ws.staging(state, "huc")))
    return ws.write_app_table(rows, f"{state}_app_coa", ["huc12", "coa_id"], CONTRACTS[f"{state}_app_coa"])


def _build_soil(ws: Workspace, state: str) -> str:
    rows = soil.soil_application(ws.staging(state, "soil_data"), ws.staging(state, "soil_geom"))
    return ws.write_app_table(rows, f"{state}_app_soiltype", ["mukey", "areasym", "musym", "geometry"], CONTRACTS["oregon_app_soiltype"])


def _build_populationpoint(ws: Workspace, state: str) -> str:
    contract = CONTRACTS["app_populationpoint"]
    rows = apply_defaults(layers.population_points(_lower(ws.staging(state, "ppa"))), contract)
    return ws.write_app_table(rows, f"{state}_app_populationpoint", ["place_fips", "geometry"], contract)


BUILDERS: dict[tuple[str, str], Callable[[Workspace, str], str]] = {
    (table, state): builder
    for state in ("oregon", "washington")
    for table, builder in (("taxlots", _build_taxlots), ("soil", _build_soil), ("populationpoint", _build_populationpoint))
}
BUILDERS["coa", "oregon"] = _build_coa


def build(ws: Workspace, table: str, state: str) -> str:
    """Build one application table and return the path of its new snapshot."""
    if table not in TABLES:
        raise ValueError(f"unknown table {table!r}; choose from {', '.join(TABLES)}")
    full = normalise_state_name(state)
    if (table, full) not in BUILDERS:
        raise ValueError(f"table {table!r} is not defined for {full!r}")
    return BUILDERS[table, full](ws, full)


def import_vector(
    ws: Workspace,
    path: str,
    state: str,
    table: str,
    schema: T.StructType | None = None,
    srid: int | None = None,
    t_srid: int | None = None,
    mode: str = "error",
    split: bool = False,
) -> DataFrame:
    """Load GeoJSON (or a delimited file with a ``wkt`` column) into staging; returns quarantined rows.

    GeoJSON without a ``schema`` is read once more to infer one. ``split`` reads a document by many tasks, cut at
    feature borders; it is needed for documents that don't fit into a row.
    """
    delimited = path.lower().endswith((".csv", ".txt"))
    if schema is None:
        if delimited:
            raise ValueError("a delimited file needs a schema")
        documents = vector_split.feature_documents(ws.spark, path) if split else None
        schema = vector.geojson_schema(ws.spark, path, documents)
    if delimited:
        loaded, bad = vector.read_wkt_csv(ws.spark, path, schema, srid=srid or 4326, target=t_srid)
    else:
        read = vector_split.read_geojson_split if split else vector.read_geojson
        loaded, bad = read(ws.spark, path, schema, srid, t_srid)
    ws.write_staging(loaded, state, table, mode)
    return bad


def consolidate(ws: Workspace, state: str, names: Sequence[str], overwrite: bool = False) -> None:
    """County layers and the legacy layer into the raw parcel table."""
    keys = counties.county_keys()
    sources = {name: _lower(ws.staging(state, keys[name][0])) for name in names}
    old, boundaries = _lower(ws.staging(state, "taxlots_old")), _lower(ws.staging(state, "cty"))
    mapping = counties.county_mapping(
        old, boundaries.select(F.col("county_fipscode"), F.col("county_name"), "geom")
    )
    rows = counties.consolidate(sources, old, mapping)
    ws.write_staging(rows, state, "taxlots", "overwrite" if overwrite else "error")


def clean(ws: Workspace, state: str, overwrite: bool = False) -> DataFrame:
    """Raw parcels to the cleaned table; returns the run's report."""
    full = normalise_state_name(state)
    run = taxlots.clean_parcels(_lower(ws.staging(full, "taxlots")), c.RULES[full])
    mode = "overwrite" if overwrite else "error"
    ws.write_staging(run.final.drop("source_key", "cid"), full, "taxlots_post", mode)
    ws.write_staging(run.pieces, full, "taxlots_post_pieces", mode)
    return run.report()


def update_elevation(
    ws: Workspace, state: str, raster: DataFrame, grid: zonal.Grid, done: DataFrame | None = None, grid_srid: int = 5070
) -> DataFrame:
    """Zonal rows after computing only new or changed parcels; ``done`` is the earlier result.

    Parcels are moved to the raster's reference system first.
    """
    full = normalise_state_name(state)
    parcels = ws.staging(full, "taxlots_post").select("maptaxlot", "geohash11", "area_sqm", "geom")
    todo = pending_zonal(parcels, done, ZONAL_MIN_AREA) if done is not None else parcels.where(F.col("area_sqm") > ZONAL_MIN_AREA)
    todo = todo.drop("geom").join(parcel_shapes(ws, full), "maptaxlot")
    todo = todo.withColumn("geom", reproject(F.col("geom"), 3857, grid_srid))
    fresh = zonal.parcel_statistics(todo, raster, grid, ["maptaxlot", "geohash11", "area_sqm"])
    return replace_by_key(done, fresh, "maptaxlot") if done is not None else fresh


def refresh_elevation(ws: Workspace, state: str, raster: DataFrame, grid: zonal.Grid, grid_srid: int = 5070) -> dict[str, int]:
    """Bring the staging table ``elevation`` up to date; returns the run's totals.

    ``processed`` parcels have a new row, ``failed`` ones were due and meet no pixel.
    """
    full = normalise_state_name(state)
    parcels = ws.staging(full, "taxlots_post").select("maptaxlot", "geohash11", "area_sqm")
    done = durable(ws.staging(full, "elevation")) if ws.has_staging(full, "elevation") else None
    due = pending_zonal(parcels, done, ZONAL_MIN_AREA) if done is not None else parcels.where(F.col("area_sqm") > ZONAL_MIN_AREA)
    due = durable(due.select("maptaxlot", "geohash11"))
    rows = durable(update_elevation(ws, full, raster, grid, done, grid_srid))
    processed = due.join(rows, ["maptaxlot", "geohash11"], "left_semi").count()
    ws.write_staging(rows, full, "elevation", "overwrite")
    return {"processed": processed, "failed": due.count() - processed}


def stage_soil(ws: Workspace, state: str, tables: Mapping[str, DataFrame], overwrite: bool = False) -> None:
    """Soil survey tables (muaggatt, component, coforprod, corestrictions, mupolygon) into the staging the soil table is built from."""
    full, mode = normalise_state_name(state), "overwrite" if overwrite else "error"
    polygons = tables["mupolygon"]
    units = soil.state_map_units(polygons, normalise_state_name(state, "abbr").upper())
    data = soil.soil_rollup(*[tables[n] for n in ("muaggatt", "component", "coforprod", "corestrictions")], units)
    own = polygons.join(units, ["areasymbol", "mukey"], "left_semi")
    ws.write_staging(data, full, "soil_data", mode)
    ws.write_staging(soil.soil_polygons(tables["muaggatt"], own, own), full, "soil_geom", mode)


def export_application(ws: Workspace, table: str, path: str, mode: str = "error") -> None:
    """Write the current snapshot of an application table to ``path`` without its surrogate id, and compare what was written."""
    current = ws.app_table(table)
    if current is None:
        raise ValueError(f"{table!r} was never built")
    export_table(current, path, mode=mode)
    wrong = [r.name for r in verify_export(current, ws.spark.read.parquet(path)).select("name").collect()]
    if wrong:
        raise ValueError(f"{table}: the export differs in {', '.join(sorted(wrong))}")
