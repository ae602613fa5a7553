"""Parcel cleaning: exclusion rules, key assignment, geohash de-duplication.

Keys such as '0' can hold a large share of all rows. Counts are therefore taken
with map-side partial aggregation and joined back, never with a window that
would gather a whole key in one task; adaptive execution splits the hot side of
the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotweave.functions import geometry as g
from lotweave.functions import text
from lotweave.functions.crs import reproject, reproject_point
from lotweave.functions.geohash import geohash_box, geohash_centroid, geohash_degrees
from lotweave.functions.reuse import built_once, with_computed


@dataclass(frozen=True)
class ParcelRules:
    """Per-state settings of the cleaning job."""

    state: str
    key: str
    county: str
    fips: str
    carried: tuple[str, ...] = ()
    conflict_suffix_length: int = 11


OREGON = ParcelRules("oregon", "maptaxlot", "county", "county_fips")
WASHINGTON = ParcelRules(
    "washington", "orig_parcel_id", "county_nm", "fips_nr", carried=("landuse_cd",), conflict_suffix_length=6
)
RULES = {"oregon": OREGON, "washington": WASHINGTON}

STRIP_LIMIT = 0.02  # thinner than this is a strip when the key is empty
UNIQUE_STRIP_LIMIT = 0.03  # stricter limit for parcels with a key of their own
LARGE_PARCEL = 10_000_000.0  # square metres


@built_once
def _measures(srid: int, area_srid: int, length: int) -> tuple[Column, ...]:
    sizes = g.let(
        reproject(F.col("geom"), srid, area_srid),
        lambda flat: F.struct(g.area(flat).alias("area_sqm"), g.perimeter(flat).alias("perimeter")),
    )
    return sizes, geohash_box(F.col("geom"), length, srid)


def measured(df: DataFrame, srid: int = 3857, area_srid: int = 5070, geohash_length: int = 11) -> DataFrame:
    """Add ``area_sqm``, ``perimeter`` and ``geohash11`` in one pass over the vertices."""
    sizes, geohash = _measures(srid, area_srid, geohash_length)
    added = with_computed(df, {"_size": sizes, "geohash11": geohash})
    return added.select(*df.columns, "_size.area_sqm", "_size.perimeter", "geohash11")


def oregon_excluded(key: Column, area: Column, perimeter: Column) -> Column:
    """Non-parcel word in the key, or an empty key on a strip."""
    strip = text.blank_or_zero(key) & (text.thinness(area, perimeter) < STRIP_LIMIT)
    return text.has_word(key, text.OREGON_NON_PARCEL_WORDS) | strip


def washington_excluded(key: Column, landuse: Column, area: Column, perimeter: Column) -> Column:
    """Empty or unrecognised key on a strip or an outsized polygon."""
    unknown = (
        ~text.is_numeric_text(key) & ~text.has_word(key, text.WASHINGTON_GENERIC_WORDS) & landuse.isNull()
    )
    shape = (text.thinness(area, perimeter) < STRIP_LIMIT) | (area > LARGE_PARCEL)
    return (text.blank_or_zero(key) | unknown) & shape


def exclusion(rules: ParcelRules) -> Column:
    area, perimeter, key = F.col("area_sqm"), F.col("perimeter"), F.col(rules.key)
    rule = (
        oregon_excluded(key, area, perimeter)
        if rules.state == "oregon"
        else washington_excluded(key, F.col("landuse_cd"), area, perimeter)
    )
    return F.coalesce(rule, F.lit(False))


def washington_key_suffix(key: Column, geom: Column, srid: int = 3857) -> Column:
    """Generic keys become unique per place: key, underscore, upper-case centroid geohash."""
    generic = text.has_word(key, text.WASHINGTON_GENERIC_WORDS) | (F.trim(key) == "0")
    return F.when(generic, F.concat(key, F.lit("_"), F.upper(geohash_centroid(geom, 11, srid)))).otherwise(key)


def consolidate_parcels(raw: DataFrame, rules: ParcelRules, srid: int = 3857, area_srid: int = 5070) -> DataFrame:
    """Drop non-parcels and give every row a key.

    Measures come from the geometry as delivered; repair happens afterwards and
    changes the stored geohash only (:func:`current_geohash`).
    """
    kept = measured(raw, srid, area_srid).where(~exclusion(rules))
    fallback = text.fallback_key(text.pad_code(F.col(rules.fips)), F.col("geohash11"))
    return kept.select(
        "id",
        F.col(rules.county).alias("county"),
        F.coalesce(text.clean_key(F.col(rules.key)), fallback).alias("maptaxlot"),
        *rules.carried,
        "area_sqm",
        "perimeter",
        "geohash11",
        "geom",
    )


def current_geohash(repaired: DataFrame, srid: int = 3857) -> DataFrame:
    """Bounding-box geohash of the stored outline: a repair may have changed it."""
    return repaired.withColumn(
        "geohash11", F.when(F.col("repaired"), geohash_box(F.col("geom"), 11, srid)).otherwise(F.col("geohash11"))
    )


def finish_keys(consolidated: DataFrame, rules: ParcelRules, srid: int = 3857) -> DataFrame:
    """State-specific key change that runs after repair and before de-duplication."""
    if rules.state != "washington":
        return consolidated
    return consolidated.withColumn("maptaxlot", washington_key_suffix(F.col("maptaxlot"), F.col("geom"), srid))


def key_counts(df: DataFrame, key: str = "maptaxlot") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("key_rows"))


def unique_rows(df: DataFrame, carried: Sequence[str] = (), key: str = "maptaxlot", row_id: str = "id") -> DataFrame:
    """Id, key and carried narrow columns of rows whose key occurs once, in one pass.

    A key with many rows shrinks to one partial row per input partition, so no
    join and no window is needed.
    """
    lone = F.min(F.struct(row_id, *carried)).alias("lone")
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), lone)
    return sizes.where("n = 1").select("lone.*", key)


def duplicate_keys(df: DataFrame, key: str = "maptaxlot") -> DataFrame:
    """Rows whose key occurs more than once."""
    return df.join(key_counts(df, key).where("key_rows > 1").select(key), key, "left_semi")


def drop_repeated_geohash(
    unique: DataFrame, key: str = "maptaxlot", geohash: str = "geohash11", row_id: str = "id"
) -> DataFrame:
    """Id, key and geohash of the lowest key per geohash (missing geohashes form one group).

    Takes and returns narrow rows: two aggregations with partial combination
    find the survivors, and no geometry takes part.
    """
    lowest = unique.groupBy(geohash).agg(F.min(F.struct(key, row_id)).alias("kept"))
    return lowest.select(f"kept.{row_id}", f"kept.{key}", geohash)


def unique_parcels(cleaned: DataFrame) -> DataFrame:
    """Whole rows with a key of their own, one per geohash."""
    kept = drop_repeated_geohash(unique_rows(cleaned, ["geohash11"]))
    return cleaned.join(kept.select("id", "maptaxlot"), ["id", "maptaxlot"], "left_semi")


def drop_thin(df: DataFrame, limit: float = UNIQUE_STRIP_LIMIT) -> DataFrame:
    """Remove strips; a shape without a measurable perimeter stays."""
    return df.where(~F.coalesce(text.thinness(F.col("area_sqm"), F.col("perimeter")) < limit, F.lit(False)))


def suffix_conflicts(
    merged: DataFrame, length: int, srid: int = 3857, key: str = "maptaxlot", into: str | None = None, spot: Column | None = None
) -> DataFrame:
    """Rows whose key is not theirs alone get a geohash appended, of their centroid or of ``spot``.

    The new key replaces ``key``, or stands beside it in ``into``.
    """
    if spot is None:
        place = geohash_centroid(F.col("geom"), length, srid)
    else:
        there = reproject_point(spot, srid, 4326)
        place = geohash_degrees(there["x"], there["y"], length)
    renamed = F.when(F.col("key_rows") > 1, F.concat(F.col(key), F.lit("_"), F.upper(place))).otherwise(F.col(key))
    return merged.join(key_counts(merged, key), key, "left").withColumn(into or key, renamed).drop("key_rows")


def first_per_key(df: DataFrame, key: str, order: list[Column], row_id: str) -> DataFrame:
    """Insert-or-ignore: one row per key, chosen by ``order`` and then by row id.

    The chosen row is found again by key and id, so ids need be unique within a key only.
    """
    ranks = [c.alias(f"o{i}") for i, c in enumerate(order)]
    best = df.groupBy(key).agg(F.min(F.struct(*ranks, F.col(row_id).alias("pick"))).alias("best"))
    chosen = best.select(F.col(key).alias("_key"), F.col("best.pick").alias("_pick"))
    same = (F.col(row_id) == F.col("_pick")) & F.col(key).eqNullSafe(F.col("_key"))
    return df.join(chosen, same, "left_semi")


def insert_ignore(target: DataFrame, incoming: DataFrame, key: str, order: list[Column], row_id: str) -> DataFrame:
    """Rows of ``incoming`` that a key-unique append to ``target`` would accept."""
    fresh = incoming.join(target.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    keyed = first_per_key(fresh.where(F.col(key).isNotNull()), key, order, row_id)
    return keyed.unionByName(fresh.where(F.col(key).isNull()))


def surplus_rows(df: DataFrame, column: str) -> DataFrame:
    """Number of rows beyond the first per value, counting NULL as one value."""
    sizes = df.groupBy(column).agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("count"))


def cleaning_report(
    raw: DataFrame, cleaned: DataFrame, unique: DataFrame, duplicated: DataFrame, merged: DataFrame, final: DataFrame
) -> DataFrame:
    """Nine counts that describe a cleaning run."""

    def line(name: str, counted: DataFrame) -> DataFrame:
        return counted.select(F.lit(name).alias("report"), F.col("count").cast("long").alias("count"))

    rows = F.count("*").alias("count")
    lines = [
        line("Total unprocessed taxlots", raw.agg(rows)),
        line("Cleaned taxlots", cleaned.agg(rows)),
        line("Unique taxlots", unique.agg(rows)),
        line("Duplicated taxlots", duplicated.agg(F.count_distinct("maptaxlot").alias("count"))),
        line("Deduplicated by clustering multipart taxlots", merged.agg(rows)),
        line("Deduplicated with geohash suffix", final.where(F.col("maptaxlot").contains("_")).agg(rows)),
        line("Final taxlot count", final.agg(rows)),
        line("Remaining duplicated geohash11 values", surplus_rows(final, "geohash11")),
        line("Remaining duplicated maptaxlot values", surplus_rows(final, "maptaxlot")),
    ]
    report = lines[0]
    for extra in lines[1:]:
        report = report.unionByName(extra)
    return report
