"""Vector files to typed tables with a geometry column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotweave.functions.crs import reproject
from lotweave.sources.catalog import declared_schema
from lotweave.sources.features import feature_rows, with_geometry

_CRS = "crs struct<properties:struct<name:string>>"


def detect_srid(documents: DataFrame, body: str = "value") -> DataFrame:
    """SRID named in each GeoJSON document; 4326 when it names none."""
    name = F.from_json(F.col(body), _CRS)["crs"]["properties"]["name"]
    code = F.nullif(F.regexp_extract(F.coalesce(name, F.lit("")), r"(\d+)$", 1), F.lit(""))
    return documents.withColumn("srid", F.coalesce(code.cast("int"), F.lit(4326)))


def read_geojson(
    spark: SparkSession, path: str, schema: T.StructType, srid: int | None = None, target: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """GeoJSON documents as (loaded, quarantined) rows.

    Without ``srid`` each document's own reference system counts; the distinct
    ones present decide which transforms the plan holds.
    """
    documents = spark.read.text(path, wholetext=True)
    if srid is not None:
        loaded, bad = with_geometry(feature_rows(documents, "value", schema), "geometry", "geojson", srid, target)
        return loaded, bad
    tagged = detect_srid(documents)
    rows = feature_rows(tagged, "value", schema, keep=("srid",))
    loaded, bad = with_geometry(rows.withColumnRenamed("srid", "file_srid"), "geometry", "geojson")
    if target is None:
        return loaded.withColumn("srid", F.col("file_srid")).drop("file_srid"), bad
    present = [r[0] for r in tagged.select("srid").distinct().collect()]
    moved = F.lit(None).cast(loaded.schema["geom"].dataType)
    for code in present:
        moved = F.when(F.col("file_srid") == code, reproject(F.col("geom"), code, target)).otherwise(moved)
    return loaded.withColumn("geom", moved).withColumn("srid", F.lit(target)).drop("file_srid"), bad


def read_wkt_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    geometry: str = "wkt",
    srid: int = 3857,
    target: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Delimited files with a WKT column as (loaded, quarantined) rows."""
    full = T.StructType([*schema.fields, T.StructField(geometry, T.StringType())])
    rows = spark.read.option("header", True).schema(full).csv(path)
    return with_geometry(rows, geometry, "wkt", srid, target)


def infer_geojson_schema(documents: DataFrame, body: str = "value") -> DataFrame:
    """Property names with the narrowest SQL type that holds every value."""
    features = documents.select(F.explode(F.from_json(F.col(body), "features array<struct<properties:map<string,string>>>")["features"]).alias("f"))
    pairs = features.select(F.explode("f.properties").alias("name", "value")).where(F.col("value").isNotNull())
    v = F.col("value")
    return (
        pairs.groupBy("name")
        .agg(
            F.bool_and(v.rlike(r"^[+-]?\d{1,18}$")).alias("whole"),
            F.bool_and(v.rlike(r"^[+-]?\d+(\.\d+)?([eE][+-]?\d+)?$")).alias("number"),
            F.bool_and(v.rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("day"),
            F.bool_and(v.rlike(r"^\d{4}-\d{2}-\d{2}T")).alias("moment"),
            F.max(F.abs(v.try_cast("decimal(38,10)"))).alias("peak"),
        )
        .select(
            "name",
            F.when(F.col("whole") & (F.col("peak") < 2**31), "INTEGER")
            .when(F.col("whole"), "BIGINT")
            .when(F.col("number"), "DOUBLE PRECISION")
            .when(F.col("day"), "DATE")
            .when(F.col("moment"), "TIMESTAMP")
            .otherwise("VARCHAR")
            .alias("sql_type"),
        )
    )


def geojson_schema(spark: SparkSession, path: str, documents: DataFrame | None = None) -> T.StructType:
    """Inferred schema of GeoJSON documents (those at ``path`` unless given), fields in order of name."""
    texts = spark.read.text(path, wholetext=True) if documents is None else documents
    found = infer_geojson_schema(texts).orderBy("name").collect()  # a row a field
    return declared_schema(",".join(r.name for r in found), ",".join(r.sql_type for r in found))
