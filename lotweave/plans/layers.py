"""Smaller application tables and layer post-processing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotweave.functions import geometry as g
from lotweave.functions import text
from lotweave.functions.text import normalise_state_name
from lotweave.operators.dissolve import repair
from lotweave.operators.overlap import overlay_pairs
from lotweave.operators.spatial_join import spatial_pairs

LARGE_PLSS = 10_000_000.0  # square Mercator metres


def population_points(places: DataFrame) -> DataFrame:
    """Populated places as centroids with the application table's columns."""
    return places.select(
        F.col("class").alias("classification"),
        F.col("st").alias("state"),
        "population",
        F.col("placefips").cast("int").alias("place_fips"),
        F.col("pop_sqmi").alias("density_sqmi"),
        F.col("sqmi").alias("area_sqmi"),
        F.col("pop_class").alias("population_class"),
        g.centroid(F.col("geom")).alias("geometry"),
    )


def conservation_areas(coa: DataFrame, huc: DataFrame) -> DataFrame:
    """One row per intersecting conservation area and watershed, with the watershed's geometry.

    Pairs are found on ids; the watershed geometry joins afterwards, once per
    result row.
    """
    areas = coa.select("coaid", "coaname", "centroidec", "profilelin", "geom")
    pairs = spatial_pairs(
        areas, huc.select(F.col("huc12"), "geom"), ["coaid", "coaname", "centroidec", "profilelin"], ["huc12"]
    )
    shapes = huc.select("huc12", F.col("geom").alias("geometry"))
    return pairs.join(shapes, "huc12").select(
        "huc12",
        F.col("coaid").alias("coa_id"),
        F.col("coaname").alias("coa_name"),
        F.col("centroidec").alias("ecoregion"),
        F.col("profilelin").alias("profile_link"),
        "geometry",
    )


def legal_sections(first_division: DataFrame, townships: DataFrame) -> DataFrame:
    """Section × township overlay with its legal description."""
    cut = overlay_pairs(first_division, townships, ["frstdivno"], ["twnshplab"])
    labelled = cut.select(text.legal_description(F.col("frstdivno"), F.col("twnshplab")).alias("legal_desc"), "geom")
    return repair(labelled).drop("repaired")


def drop_large(plss: DataFrame, limit: float = LARGE_PLSS) -> DataFrame:
    """Repaired layer without polygons of ``limit`` or more; unmeasurable ones stay."""
    fixed = repair(plss).drop("repaired")
    return fixed.where(~F.coalesce(g.area(F.col("geom")) >= limit, F.lit(False)))


Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Hook:
    """A layer's step after loading; ``by_row`` if every row's result depends on that row alone."""

    run: Step
    by_row: bool = True


def _repaired(df: DataFrame) -> DataFrame:
    return repair(df).drop("repaired")


POST_PROCESSING: dict[tuple[str, str], Hook] = {
    ("oregon", "fpd"): Hook(_repaired),
    ("oregon", "sfd"): Hook(_repaired),
    ("oregon", "zoning"): Hook(_repaired),
    ("washington", "plss"): Hook(drop_large),
}


def register_hook(state: str, layer: str, run: Step | None, by_row: bool = True) -> None:
    """Set a layer's step after loading, or with None take it away.

    A step that looks at other rows too (``by_row=False``) runs over the whole layer
    whenever a page of it is replayed.
    """
    key = (normalise_state_name(state), layer)
    if run is None:
        POST_PROCESSING.pop(key, None)
    else:
        POST_PROCESSING[key] = Hook(run, by_row)


# Layers that are made of others once these are staged: name, inputs in order, and how.
COMPOSED = {("oregon", "plss2"): (("plss", ("plss1", "plss2"), legal_sections),)}


def hook_of(state: str, layer: str) -> Hook:
    return POST_PROCESSING.get((state, layer), Hook(lambda df: df))


def post_process(state: str, layer: str, df: DataFrame) -> DataFrame:
    """Run the layer's registered post-processing, if any."""
    return df.transform(hook_of(state, layer).run)
