"""Spatial joins as grid-cell equi joins.

Both sides are spread over the grid cells their bounding boxes cover and joined
on the cell. A pair that shares several cells is kept only in the cell holding
the lower-left corner of the shared box, so no shuffle is spent on removing
repeats. Rectangles travel as four numbers; other shapes carry their vertices
and are compared by one sweep over the edges of a whole Arrow batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotweave.functions import geometry as g
from lotweave.functions import sweep
from lotweave.functions.reuse import built_once, with_computed
from lotweave.session import ship_package

DEFAULT_CELL = 2500.0


@built_once
def _box_of(geom: str) -> Column:
    return g.bbox(F.col(geom))


@built_once
def _shape_unless_rectangle(geom: str) -> Column:
    return F.when(~g.is_rectangle(F.col(geom)), F.col(geom))


def with_box(df: DataFrame, side: str, keep: Sequence[str], geom: str = "geom") -> DataFrame:
    """Kept columns, bounding box and - for anything but a rectangle - the shape."""
    columns = {f"{side}_box": _box_of(geom), f"{side}_shape": _shape_unless_rectangle(geom)}
    return with_computed(df.select(*dict.fromkeys([*keep, geom])), columns).select(*keep, *columns)


def cover_cells(df: DataFrame, box: str, cell: float) -> DataFrame:
    """One row per grid cell the box touches (columns ``cx``, ``cy``)."""

    def cells(low: str, high: str) -> Column:
        first = F.floor(F.col(f"{box}.{low}") / cell)
        last = F.floor(F.col(f"{box}.{high}") / cell)
        return F.explode(F.sequence(first, last))

    return df.withColumn("cx", cells("minx", "maxx")).withColumn("cy", cells("miny", "maxy"))


def _boxes_meet() -> Column:
    return (
        (F.col("l_box.minx") <= F.col("r_box.maxx"))
        & (F.col("r_box.minx") <= F.col("l_box.maxx"))
        & (F.col("l_box.miny") <= F.col("r_box.maxy"))
        & (F.col("r_box.miny") <= F.col("l_box.maxy"))
    )


def _first_shared_cell(cell: float) -> Column:
    return (F.col("cx") == F.floor(F.greatest("l_box.minx", "r_box.minx") / cell)) & (
        F.col("cy") == F.floor(F.greatest("l_box.miny", "r_box.miny") / cell)
    )


def _shape(side: str) -> Column:
    box = F.col(f"{side}_box")
    return F.coalesce(
        F.col(f"{side}_shape"), g.rectangle(box["minx"], box["miny"], box["maxx"], box["maxy"])
    )


def in_cells(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join of two sides on their cells, by as many tasks as the session has for shuffles.

    Spark knows the bytes of both sides, not the pairs that come of them: left alone, it would send the
    derived rows to every task or put all cells into a few.
    """
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return left.repartition(tasks, "cx", "cy").join(right.repartition(tasks, "cx", "cy").hint("merge"), ["cx", "cy"])


def met_pairs(lefts: DataFrame, rights: DataFrame, cell: float) -> tuple[DataFrame, DataFrame]:
    """Pairs whose boxes meet, each once: (of two rectangles, all others), so only the others need go through Python."""

    def kinds(df: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
        shape = F.col(f"{side}_shape")
        return df.where(shape.isNull()).drop(shape), df.where(shape.isNotNull())

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        return in_cells(left, right).where(_boxes_meet() & _first_shared_cell(cell)).drop("cx", "cy")

    plain_l, drawn_l = kinds(lefts, "l")
    plain_r, drawn_r = kinds(rights, "r")
    others = met(drawn_l, drawn_r)
    for part in (met(plain_l, drawn_r), met(drawn_l, plain_r)):
        others = others.unionByName(part, allowMissingColumns=True)
    return met(plain_l, plain_r), others


@F.arrow_udf(returnType=T.DoubleType())
def _swept(pairs: pa.Array) -> pa.Array:
    return sweep.overlaps_of(pairs)


def shared_box_area() -> Column:
    """Overlap of the current pair of rectangles, 0 where they only touch."""
    width = F.least("l_box.maxx", "r_box.maxx") - F.greatest("l_box.minx", "r_box.minx")
    return width * (F.least("l_box.maxy", "r_box.maxy") - F.greatest("l_box.miny", "r_box.miny"))


def shared_area() -> Column:
    """Overlap of the current pair of shapes, 0 where the two only touch and NULL where they are apart.

    Pairs are swept in Arrow batches. Both shapes of a pair travel in one
    column, because Spark measures every list column after each row. The sweep counts as not
    deterministic so that no filter copies it.
    """
    return _swept.asNondeterministic()(F.array(_shape("l"), _shape("r")))


def spatial_pairs(
    left: DataFrame,
    right: DataFrame,
    left_keep: Sequence[str],
    right_keep: Sequence[str],
    cell: float = DEFAULT_CELL,
    overlap: str | None = None,
    geom: str = "geom",
) -> DataFrame:
    """Pairs of intersecting features; a shared boundary point counts.

    ``overlap`` names a column for the shared area. Kept columns of the two
    sides must have different names.
    """
    clash = set(left_keep) & set(right_keep)
    if clash:
        raise ValueError(f"columns kept on both sides: {sorted(clash)}")
    lefts = cover_cells(with_box(left, "l", left_keep, geom), "l_box", cell)
    rights = cover_cells(with_box(right, "r", right_keep, geom), "r_box", cell)
    ship_package(left.sparkSession)
    plain, others = met_pairs(lefts, rights, cell)
    shared = overlap or "_shared"
    pairs = plain.select(*left_keep, *right_keep, shared_box_area().alias(shared)).unionByName(
        others.select(*left_keep, *right_keep, shared_area().alias(shared))
    )
    pairs = pairs.where(F.col(shared).isNotNull())
    return pairs if overlap else pairs.drop(shared)


@built_once
def _point_inside() -> Column:
    return F.col("r_shape").isNull() | g.contains_point(F.col("r_shape"), F.col("l_x"), F.col("l_y"))


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    point_col: str,
    point_keep: Sequence[str],
    polygon_keep: Sequence[str],
    cell: float = DEFAULT_CELL,
) -> DataFrame:
    """Pairs (point, polygon) with the point inside or on the border."""
    px, py = F.col(point_col)["x"], F.col(point_col)["y"]
    spots = points.select(
        *point_keep,
        px.alias("l_x"),
        py.alias("l_y"),
        F.floor(px / cell).alias("cx"),
        F.floor(py / cell).alias("cy"),
    )
    areas = cover_cells(with_box(polygons, "r", polygon_keep), "r_box", cell)
    return (
        in_cells(spots, areas)
        .where(
            F.col("l_x").between(F.col("r_box.minx"), F.col("r_box.maxx"))
            & F.col("l_y").between(F.col("r_box.miny"), F.col("r_box.maxy"))
        )
        .where(_point_inside())
        .select(*point_keep, *polygon_keep)
    )
