"""Keep unresolved Column trees, and evaluate costly columns once per row.

The exact geometry tests have thousands of nodes. Building one from Python
takes longer than planning it, and the tree depends only on column names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def built_once(fn: Callable) -> Callable:
    """Cache the Columns of a builder whose arguments are names and numbers."""
    kept: dict[tuple, object] = {}

    @functools.wraps(fn)
    def build(*args):
        context = SparkContext._active_spark_context
        where = (context.applicationId if context else None, *args)
        if where not in kept:
            kept[where] = fn(*args)
        return kept[where]

    return build


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    A plain projection is copied into every filter above it, and those filters
    move down to the scan, so costly geometry would run several times. A one-row
    generator stays where it is.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
