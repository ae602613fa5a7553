"""Paged layers: page plan, stored page files, failure ledger and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotweave.sources.catalog import DEFAULT_PAGE


def page_plan(layers: DataFrame, total: str = "total", page: str = "max_records") -> DataFrame:
    """One row per page of every layer: offset and number of records to ask for."""
    size = F.coalesce(F.col(page), F.lit(DEFAULT_PAGE)).cast("long")
    numbered = layers.withColumn("_size", size).where(F.col(total) > 0)
    pages = numbered.withColumn("page_no", F.explode(F.sequence(F.lit(0), F.ceil(F.col(total) / F.col("_size")) - 1)))
    offset = (F.col("page_no") * F.col("_size")).alias("offset")
    return pages.select(*layers.columns, "page_no", offset, F.least(F.col("_size"), F.col(total) - F.col("page_no") * F.col("_size")).alias("records"))


def page_status(body: Column) -> Column:
    """'ok' for a page with features, 'failed' for an error document, an empty body or other text."""
    has_error = F.get_json_object(body, "$.error").isNotNull()
    has_features = F.get_json_object(body, "$.features").isNotNull()
    return F.when(body.isNull() | (F.trim(body) == ""), "failed").when(has_error, "failed").when(has_features, "ok").otherwise("failed")


def failed_ledger(pages: DataFrame) -> DataFrame:
    """Pages to ask for again."""
    return pages.where(F.col("status") == "failed").select("layer", "offset", "attempts")


def replay(pages: DataFrame, ledger: DataFrame, retried: DataFrame) -> DataFrame:
    """Page table after a retry: a ledger page takes its retried result, others stay."""
    keys = ["layer", "offset"]
    again = retried.join(ledger.select(*keys), keys, "left_semi")
    return pages.join(again.select(*keys), keys, "left_anti").unionByName(again.select(*pages.columns))


def ledger_summary(pages: DataFrame) -> DataFrame:
    """Batches, successes and persistent failures per layer."""
    good = F.count_if(F.col("status") == "ok")
    return pages.groupBy("layer").agg(
        F.count("*").alias("total_batches"),
        good.alias("successful_batches"),
        (F.count("*") - good).alias("failed_batches"),
        F.max("attempts").alias("most_attempts"),
    )


def _stored_files(spark: SparkSession, root: str) -> DataFrame:
    """(layer, path, value) of the stored files; Spark's readers leave empty files out."""
    raw = spark.read.option("basePath", root).text(f"{root}/layer=*", wholetext=True)
    return raw.select("layer", F.col("_metadata.file_path").alias("path"), "value")


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """Stored pages ``<root>/layer=<name>/<offset>.json`` (or files in ``offset=<offset>/``) with their status.

    Whole files become rows through the built-in reader, so any file system
    works, files spread over tasks, and a filter on ``layer`` prunes folders.
    """
    offset = F.regexp_extract("path", r"/(?:offset=)?(\d+)(?:\.json|/[^/]*)$", 1)
    return _stored_files(spark, root).where(offset != "").select(
        "layer", offset.cast("long").alias("offset"), page_status(F.col("value")).alias("status"), F.col("value").alias("body")
    )


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    """(layer, total): the service's own count, stored as ``<root>/layer=<name>/count.json``."""
    total = F.get_json_object("value", "$.count").cast("long")
    return _stored_files(spark, root).where("path LIKE '%/count.json'").select("layer", total.alias("total"))


def page_gaps(stored: DataFrame, totals: DataFrame) -> DataFrame:
    """(layer, offset, records, status): planned or stored pages that are missing, failed or short of features.

    ``stored`` has layer, offset, status and ``features``, their number, or the
    page's ``body``. ``totals`` has layer, total and max_records; a layer without
    a total is judged by its stored pages alone.
    """
    if "features" not in stored.columns:
        stored = stored.withColumn("features", F.coalesce(F.json_array_length(F.get_json_object("body", "$.features")), F.lit(0)))
    held = stored.select("layer", "offset", "status", "features")
    plan = page_plan(totals.where(F.col("total").isNotNull())).select("layer", "offset", "records")
    joined = plan.join(held, ["layer", "offset"], "full_outer")
    short = (F.col("status") == "ok") & (F.col("features") < F.col("records"))
    status = F.when(F.col("status").isNull(), "missing").when(short, "short").otherwise(F.col("status"))
    return joined.select("layer", "offset", "records", status.alias("status")).where("status <> 'ok'")
