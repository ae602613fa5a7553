"""County consolidation: many source layouts into one parcel table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotweave.functions import geometry as g
from lotweave.functions.crs import reproject
from lotweave.operators.spatial_join import points_in_polygons


def five_digits(number: Column) -> Column:
    """Number in five digits with leading zeros, or '#####' when it does not fit."""
    return F.trim(F.to_char(number.cast("bigint"), F.lit("00000")))


def trimmed(column: str) -> Column:
    return F.trim(F.col(column))


def map_and_lot(map_text: str, lot_no: str) -> Column:
    """Map text filled to eight characters, then the five-digit lot; NULL pieces are skipped."""
    return F.concat_ws("", F.rpad(trimmed(map_text), 8, "0"), five_digits(F.col(lot_no)))


def number_and_lot(map_text: str, lot: str) -> Column:
    """Map number filled to ten characters, then the lot padded to five."""
    return F.concat_ws("", F.rpad(trimmed(map_text), 10, "0"), F.trim(F.lpad(F.col(lot), 5, "0")))


def county_keys() -> dict[str, tuple[str, Column]]:
    """County name -> (staging layer, key expression)."""
    # Source column of the parcel key and the counties that use it.
    plain = {
        "maptaxlot": [
            "Baker", "Benton", "Clackamas", "Crook", "Douglas", "Harney", "Hood River", "Lake", "Lane", "Lincoln",
            "Multnomah", "Polk", "Tillamook", "Union", "Wallowa", "Wasco", "Wheeler", "Yamhill",
        ],
        "taxmapkey": ["Clatsop"],
        "map_tax": ["Columbia", "Umatilla"],
        "tlid": ["Coos"],
        "currytaxlots_maptaxlot": ["Curry"],
        "taxlot": ["Deschutes", "Marion"],
        "mapnum": ["Josephine"],
        "tlno": ["Washington"],
    }
    keys = {
        county: (f"taxlots_{county.lower().replace(' ', '')}", trimmed(column))
        for column, names in plain.items()
        for county in names
    }
    keys["Jackson"] = ("taxlots_jackson", map_and_lot("mapnum", "taxlot"))
    keys["Morrow"] = ("taxlots_morrow", number_and_lot("mapnumber", "taxlot"))
    keys["Klamath"] = ("taxlots_klamath", F.substring(F.col("maptaxlot_"), 3, 16))
    return keys


# Counties that only exist in the older statewide layer.
LEGACY_COUNTIES = ("Linn", "Malheur", "Jefferson", "Gilliam", "Sherman", "Grant")


def standard_rows(source: DataFrame, county: Column, key: Column, srid: int = 3857) -> DataFrame:
    return source.select(
        county.alias("county"),
        key.alias("maptaxlot"),
        g.area(reproject(F.col("geom"), srid, 5070)).alias("area_sqm"),
        "geom",
    )


def county_mapping(old: DataFrame, counties: DataFrame, code: str = "county", row_id: str = "id") -> DataFrame:
    """Legacy county code -> county, through the centroid of one parcel per code.

    The representative is chosen from two narrow columns; its geometry is read
    back only for the chosen rows.
    """
    chosen = old.groupBy(code).agg(F.min(row_id).alias(row_id))
    spots = old.join(chosen.select(row_id), row_id, "left_semi").select(code, g.centroid(F.col("geom")).alias("spot"))
    found = points_in_polygons(spots, counties, "spot", [code], ["county_fipscode", "county_name"])
    return found.select(code, "county_fipscode", "county_name").distinct()


def with_ids(df: DataFrame, order: list[str]) -> DataFrame:
    """Stable surrogate id: hash of the natural columns, independent of partitioning."""
    return df.withColumn("id", F.xxhash64(*order))


def consolidate(
    sources: Mapping[str, DataFrame],
    old: DataFrame | None = None,
    mapping: DataFrame | None = None,
    legacy: tuple[str, ...] = LEGACY_COUNTIES,
    srid: int = 3857,
) -> DataFrame:
    """Distinct union of the county layers and the legacy counties.

    Only counties with a source take part. Equal rows (geometry included)
    appear once.
    """
    keys = county_keys()
    unknown = set(sources) - set(keys)
    if unknown:
        raise ValueError(f"no layout known for counties: {sorted(unknown)}")
    branches = [standard_rows(df, F.lit(name), keys[name][1], srid) for name, df in sources.items()]
    if old is not None:
        names = mapping.where(F.col("county_name").isin(*legacy)).select(F.col("county").alias("code"), "county_name")
        rows = old.join(names, F.col("county") == F.col("code"))
        branches.append(standard_rows(rows.drop("county"), F.col("county_name"), trimmed("maptaxlot"), srid))
    union = branches[0]
    for branch in branches[1:]:
        union = union.unionByName(branch)
    rows = union.distinct()
    if mapping is not None:
        codes = mapping.groupBy(F.col("county_name").alias("county")).agg(F.min("county_fipscode").alias("county_fips"))
        rows = rows.join(codes, "county", "left")
    return with_ids(rows, ["county", "maptaxlot", "geom"])
