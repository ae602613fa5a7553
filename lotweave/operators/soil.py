"""Soil map units: component roll-up and application table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotweave.functions import geometry as g
from lotweave.functions.crs import reproject

# Unit conversions of the application table.
FEET_PER_METRE = 3.28084
SQUARE_METRES_PER_ACRE = 4046.86


def state_map_units(mupolygon: DataFrame, state: str) -> DataFrame:
    """Distinct (areasymbol, mukey) of one state."""
    return mupolygon.where(F.col("areasymbol").startswith(state)).select("areasymbol", "mukey").distinct()


def decode_positional(responses: DataFrame, body: str, columns: list[str]) -> DataFrame:
    """Rows of ``{"Table": [[..], ..]}`` documents as named text columns; empty replies give none."""
    rows = responses.select(F.explode(F.from_json(F.col(body), "Table array<array<string>>")["Table"]).alias("r"))
    return rows.select(*[F.get("r", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def forest_label(component: DataFrame, coforprod: DataFrame) -> DataFrame:
    """Species and site index of the leading component per map unit.

    Lowest ``(-percent, cokey, species, index)`` wins through a partial minimum,
    so a map unit with many components is never gathered in one place. Missing
    percentages rank last.
    """
    rated = coforprod.where(F.col("siteindex_r").isNotNull()).join(component, "cokey")
    label = F.concat("plantcomname", F.lit(" - "), F.col("siteindex_r").cast("string"), F.lit(" ft"))
    rank = F.struct(
        F.col("comppct_r").isNull().alias("no_pct"),
        (-F.col("comppct_r")).alias("pct"),
        F.col("cokey").alias("cokey"),
        F.col("plantcomname").isNull().alias("no_name"),
        F.col("plantcomname").alias("name"),
        F.col("siteindex_r").alias("site"),
        label.alias("label"),
    )
    return rated.groupBy("mukey").agg(F.min(rank)["label"].alias("si_label"))


def restriction_depths(component: DataFrame, corestrictions: DataFrame) -> DataFrame:
    """Percentage-weighted sums of the restrictive-layer depths (not normalised)."""
    share = F.col("comppct_r") / 100.0
    return (
        corestrictions.join(component, "cokey")
        .groupBy("mukey")
        .agg(F.sum(F.col("resdept_l") * share).alias("l"), F.sum(F.col("resdept_h") * share).alias("h"))
        .select(
            "mukey", F.col("l").cast("decimal(6,2)").alias("avg_rs_l"), F.col("h").cast("decimal(6,2)").alias("avg_rs_h")
        )
    )


def soil_rollup(
    muaggatt: DataFrame,
    component: DataFrame,
    coforprod: DataFrame,
    corestrictions: DataFrame,
    mukeys: DataFrame | None = None,
) -> DataFrame:
    """One attribute row per map unit; ``mukeys`` limits the run to some units by a semi join."""
    if mukeys is not None:
        wanted = mukeys.select("mukey").distinct()
        muaggatt = muaggatt.join(wanted, "mukey", "left_semi")
        component = component.join(wanted, "mukey", "left_semi")
    zero = F.lit(0).cast("decimal(6,2)")
    return (
        muaggatt.join(forest_label(component, coforprod), "mukey", "left")
        .join(restriction_depths(component, corestrictions), "mukey", "left")
        .select(
            "mukey",
            "muname",
            F.coalesce("drclassdcd", F.lit("No Data Available")).alias("drclassdcd"),
            "forpehrtdcp",
            F.coalesce("si_label", F.lit("None")).alias("si_label"),
            F.coalesce("avg_rs_l", zero).alias("avg_rs_l"),
            F.coalesce("avg_rs_h", zero).alias("avg_rs_h"),
        )
        .distinct()
    )


def soil_polygons(mapunit: DataFrame, headers: DataFrame, polygons: DataFrame) -> DataFrame:
    """Every polygon of a map unit with each distinct header of that unit."""
    header = headers.select("mukey", "spatialversion", "musym", "areasymbol").distinct()
    return (
        mapunit.select("mukey")
        .distinct()
        .join(header, "mukey")
        .join(polygons.select("mukey", "geom"), "mukey")
        .select("mukey", "areasymbol", "musym", "spatialversion", "geom")
        .distinct()
    )


def soil_application(soil_data: DataFrame, soil_geom: DataFrame, srid: int = 3857) -> DataFrame:
    """Attributes with their polygons; length in feet and area in acres."""
    flat = soil_geom.withColumn("_flat", reproject(F.col("geom"), srid, 5070))
    sized = flat.select(
        "mukey",
        F.col("areasymbol").alias("areasym"),
        F.col("spatialversion").cast("double").alias("spatial"),
        "musym",
        (g.perimeter(F.col("_flat")) * FEET_PER_METRE).alias("shp_lng"),
        (g.area(F.col("_flat")) / SQUARE_METRES_PER_ACRE).alias("shap_ar"),
        "geom",
    )
    return soil_data.join(sized, "mukey", "left").select(
        "mukey", "areasym", "spatial", "musym", "shp_lng", "shap_ar", "si_label", "muname",
        F.col("drclassdcd").alias("drclssd"), F.col("forpehrtdcp").alias("frphrtd"),
        "avg_rs_l", "avg_rs_h", F.col("geom").alias("geometry"),
    )
