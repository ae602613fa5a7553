"""Table export, its verification profile, and data contracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def export_table(df: DataFrame, path: str, surrogate: str = "id", mode: str = "error") -> None:
    """Write a table without its surrogate id as compressed Parquet."""
    df.drop(surrogate).write.mode(mode).option("compression", "zstd").parquet(path)


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, declared length, nullability."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.metadata.get("length"), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, length int, nullable boolean")


def content_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count plus, per column, NULLs and an order-independent content hash, in one pass."""
    names = list(columns or df.columns)
    measures = [F.count("*").alias("rows")]
    for name in names:
        value = F.col(name)
        measures.append(F.count_if(value.isNull()).alias(f"{name}_nulls"))
        measures.append(F.sum(F.xxhash64(value).cast("decimal(38,0)")).alias(f"{name}_hash"))
    wide = df.agg(*measures)
    rows = F.array(
        *[F.struct(F.lit(n).alias("name"), F.col(f"{n}_nulls").alias("nulls"), F.col(f"{n}_hash").alias("hash")) for n in names]
    )
    return wide.select("rows", F.explode(rows).alias("c")).select("c.name", "rows", "c.nulls", "c.hash")


def verify_export(source: DataFrame, exported: DataFrame, surrogate: str = "id") -> DataFrame:
    """Columns whose rows, NULLs or content hash differ between source and export."""
    before = content_profile(source.drop(surrogate))
    after = content_profile(exported).select("name", *[F.col(c).alias(f"{c}_after") for c in ("rows", "nulls", "hash")])
    joined = before.join(after, "name", "full_outer")
    same = F.lit(True)
    for c in ("rows", "nulls", "hash"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_after"))
    return joined.where(~same)


@dataclass(frozen=True)
class Contract:
    """Column rules of an application table."""

    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    polygonal: tuple[str, ...] = ()


# Column rules of the application tables.
_TAXLOT_LENGTHS = {
    "odf_fpd": 25, "agency": 100, "orzdesc": 255, "huc12": 12, "name": 120, "legal_label": 255, "county": 255,
    "source": 255, "map_id": 255, "map_taxlot": 255,
}
CONTRACTS = {
    "oregon_app_taxlot": Contract(unique=("map_taxlot",), lengths=_TAXLOT_LENGTHS, polygonal=("geometry",)),
    "washington_app_taxlot": Contract(unique=("map_taxlot", "map_id"), lengths=_TAXLOT_LENGTHS, polygonal=("geometry",)),
    "app_populationpoint": Contract(
        required=("classification", "state", "population", "place_fips"),
        lengths={"classification": 100, "state": 30},
        defaults={"classification": "city", "state": "OR"},
    ),
    "oregon_app_coa": Contract(
        required=("huc12",),
        lengths={"huc12": 24, "coa_name": 255, "coa_id": 6, "ecoregion": 255, "profile_link": 255},
        polygonal=("geometry",),
    ),
    "oregon_app_soiltype": Contract(
        lengths={"mukey": 100, "areasym": 100, "musym": 100, "si_label": 255, "muname": 255, "drclssd": 100, "frphrtd": 100},
        polygonal=("geometry",),
    ),
}


def apply_defaults(df: DataFrame, contract: Contract) -> DataFrame:
    for name, value in contract.defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return df


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``rule, column, violations`` for every rule; all row rules share one pass."""
    checks: dict[tuple[str, str], Column] = {}
    for c in contract.required:
        checks["not null", c] = F.count_if(F.col(c).isNull())
    for c, limit in contract.lengths.items():
        checks[f"length {limit}", c] = F.count_if(F.length(c) > limit)
    for c in contract.polygonal:
        short = F.exists(F.flatten(c), lambda ring: F.size(ring) < 4)
        checks["polygonal", c] = F.count_if((F.size(c) == 0) | short)
    parts = []
    if checks:
        names = {f"m{i}": pair for i, pair in enumerate(checks)}
        wide = df.agg(*[checks[pair].alias(m) for m, pair in names.items()])
        cells = [
            F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"), F.col(m).alias("violations"))
            for m, (rule, c) in names.items()
        ]
        parts.append(wide.select(F.explode(F.array(*cells)).alias("v")).select("v.*"))
    for c in contract.unique:
        sizes = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        surplus = sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
        parts.append(surplus.select(F.lit("unique").alias("rule"), F.lit(c).alias("column"), "violations"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
