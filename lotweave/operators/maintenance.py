"""Snapshot maintenance: change detection, conditional upsert, removal of vanished rows.

Tables are files, so a change produces the next snapshot instead of an in-place
update. Every step is an equi join on the natural key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REFRESHED = ("map_id", "orzdesc", "min_elevation", "max_elevation", "legal_label")


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """NULL-safe "at least one value changed"."""
    changed = F.lit(False)
    for before, after in pairs:
        changed = changed | ~before.eqNullSafe(after)
    return changed


def changed_rows(current: DataFrame, fresh: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """Fresh rows that are new or differ from the current table in ``compare``."""
    known = current.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in compare])
    differs = any_differs([(F.col(f"_old_{c}"), F.col(c)) for c in compare])
    return fresh.join(known, key, "left").where(differs).select(*fresh.columns)


def upsert(
    current: DataFrame,
    fresh: DataFrame,
    key: str,
    refreshed: Sequence[str] = REFRESHED,
    refresh_all: bool = False,
) -> DataFrame:
    """Next snapshot: new keys are added; known keys take the refreshed columns when one differs.

    Other columns of a known key keep their stored value unless ``refresh_all``.
    Rows without a key never conflict, so both sides keep theirs.
    """
    columns = current.columns
    old = current.select(F.struct(*columns).alias("o"), F.col(key).alias("_ko"))
    new = fresh.select(F.struct(*columns).alias("n"), F.col(key).alias("_kn"))
    joined = old.join(new, F.col("_ko") == F.col("_kn"), "full_outer")
    changed = any_differs([(F.col(f"o.{c}"), F.col(f"n.{c}")) for c in refreshed])
    only_new, only_old = F.col("o").isNull(), F.col("n").isNull()
    replaced = set(columns if refresh_all else refreshed)

    def value(c: str) -> Column:
        old_value, new_value = F.col(f"o.{c}"), F.col(f"n.{c}")
        update = F.when(changed, new_value).otherwise(old_value) if c in replaced else old_value
        return F.when(only_new, new_value).when(only_old, old_value).otherwise(update).alias(c)

    return joined.select(*[value(c) for c in columns])


def replace_by_key(current: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Unconditional upsert: fresh rows win, other current rows stay."""
    stay = current.join(fresh.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return stay.select(*current.columns).unionByName(fresh.select(*current.columns))


def drop_vanished(app: DataFrame, source: DataFrame, app_key: str, source_key: str) -> DataFrame:
    """Application rows whose key is still present in the source; rows without a key stay."""
    present = source.select(F.col(source_key).alias(app_key)).where(F.col(app_key).isNotNull())
    keyed = app.where(F.col(app_key).isNotNull()).join(present, app_key, "left_semi")
    return keyed.select(*app.columns).unionByName(app.where(F.col(app_key).isNull()))


def pending_zonal(parcels: DataFrame, done: DataFrame, min_area: float) -> DataFrame:
    """Parcels above the area gate without a result for the same key and geohash."""
    finished = done.select("maptaxlot", "geohash11").distinct()
    return parcels.where(F.col("area_sqm") > min_area).join(finished, ["maptaxlot", "geohash11"], "left_anti")
