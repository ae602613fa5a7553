"""Paged layers as a data source: one input partition a page, page filters answered from the file names.

A page is ``<path>/layer=<name>/<offset>.json`` or, as Spark writes it, a file in
``<path>/layer=<name>/offset=<offset>/``. Conditions on ``layer`` and ``offset`` skip folders and files before
any is opened. A page of more than ``split`` records is read by several tasks. Features are cut out of the page as they
stand, by bracket depth outside strings, so numbers keep their digits and properties their order.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from lotweave.session import ship_package
from lotweave.sources.catalog import DEFAULT_PAGE
from lotweave.sources.pages import read_pages

FIELDS = "layer string, offset long, position long, status string, feature string"
#: Stores that tasks open by themselves; others are read through Spark's own file reader.
SCHEMES = {"": None, "file": None, "s3": "s3", "s3a": "s3", "gs": "gs", "hdfs": "hdfs"}

_TESTS = {
    EqualTo: lambda a, b: a == b,
    EqualNullSafe: lambda a, b: a == b,
    In: lambda a, b: a in b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    IsNotNull: lambda a, b: True,
}


# ---- documents ----------------------------------------------------------------------------------


def depths(data: bytes, in_string: bool = False, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(outside, depth) of every byte of a JSON text: whether it is outside strings, and the brackets open after it."""
    text = np.frombuffer(data, dtype=np.uint8)
    quotes = np.flatnonzero(text == 0x22)
    slashes = text == 0x5C
    if slashes.any() and len(quotes):
        # a quote after an odd run of backslashes is part of the string
        plain = np.concatenate(([-1], np.flatnonzero(~slashes)))
        before = plain[np.searchsorted(plain, quotes) - 1]
        quotes = quotes[(quotes - before) % 2 == 1]
    turns = np.zeros(len(text), dtype=np.int8)
    turns[quotes] = 1
    inside = (np.cumsum(turns, dtype=np.int64) + in_string) % 2 == 1
    outside = ~inside & (turns == 0)
    step = np.zeros(len(text), dtype=np.int64)
    step[outside & ((text == 0x7B) | (text == 0x5B))] = 1
    step[outside & ((text == 0x7D) | (text == 0x5D))] = -1
    return outside, depth + np.cumsum(step)


def feature_spans(data: bytes) -> list[tuple[int, int]] | None:
    """Start and end of every feature of a document; None for an error, a broken or another document."""
    if not data.strip():
        return None
    outside, depth = depths(data)
    if depth[-1] != 0 or depth.min() < 0:
        return None
    keys = {m[1]: m for m in re.finditer(rb'"(error|features)"\s*:\s*', data) if depth[m.start()] == 1}
    found = keys.get(b"features")
    value = data[keys[b"error"].end() :][:4] if b"error" in keys else b"null"
    if found is None or value != b"null" or data[found.end() : found.end() + 1] != b"[":
        return None
    text = np.frombuffer(data, dtype=np.uint8)
    first = found.end()
    ends = np.flatnonzero(outside[first:] & (text[first:] == 0x5D) & (depth[first:] == 1))
    last = first + int(ends[0])
    own = slice(first, last)
    starts = first + np.flatnonzero(outside[own] & (text[own] == 0x7B) & (depth[own] == 3))
    stops = first + np.flatnonzero(outside[own] & (text[own] == 0x7D) & (depth[own] == 2)) + 1
    return list(zip(starts.tolist(), stops.tolist()))


# ---- the source ---------------------------------------------------------------------------------


@dataclass
class Page(InputPartition):
    """Features ``first`` up to ``last`` of one stored page; without ``last`` all that follow."""

    path: str
    layer: str
    offset: int
    first: int
    last: int | None


def open_store(path: str):
    """(file system, path in it) of a folder."""
    from pyarrow import fs

    parts = urlsplit(path)
    scheme = SCHEMES[parts.scheme]
    if scheme is None:
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else path
    return fs.FileSystem.from_uri(path.replace(f"{parts.scheme}://", f"{scheme}://", 1))


class PagedLayers(DataSource):
    """Options: ``path``; ``max_records``, the largest page; ``split``, the most records a task reads of a page."""

    @classmethod
    def name(cls) -> str:
        return "paged_layers"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


class PageReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.split = int(options.get("split", DEFAULT_PAGE))
        self.parts = max(1, -(-int(options.get("max_records", DEFAULT_PAGE)) // self.split))
        self.tests: list[tuple[str, type[Filter], object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.tests = []
        for f in filters:
            if type(f) in _TESTS and f.attribute in (("layer",), ("offset",)):
                self.tests.append((f.attribute[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, column: str, value: object) -> bool:
        return all(_TESTS[kind](value, operand) for name, kind, operand in self.tests if name == column)

    def partitions(self) -> list[Page]:
        from pyarrow import fs

        store, root = open_store(self.path)

        def children(path: str):
            return store.get_file_info(fs.FileSelector(path, allow_not_found=True))

        out = []
        for folder in children(root):
            name = unquote(folder.base_name.removeprefix("layer="))
            if not folder.base_name.startswith("layer=") or not self.wanted("layer", name):
                continue
            for entry in children(folder.path):
                found = re.fullmatch(r"(?:offset=)?(\d+)(?:\.json)?", entry.base_name)
                if not found or not self.wanted("offset", int(found[1])):
                    continue
                files = [entry] if entry.is_file else [x for x in children(entry.path) if x.is_file and x.base_name[0] not in "._"]
                for file in files:
                    for k in range(self.parts):
                        last = None if k + 1 == self.parts else (k + 1) * self.split
                        out.append(Page(file.path, name, int(found[1]), k * self.split, last))
        return out

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.path)
        with store.open_input_stream(partition.path) as file:
            data = file.read()
        spans = feature_spans(data)
        own = (spans or [])[partition.first : partition.last]
        if not own and (spans or partition.first):
            return
        n = max(len(own), 1)  # a page without features is one row without a position
        for at in range(0, n, self.split):
            some = own[at : at + self.split]
            m = max(len(some), 1)
            place = [partition.first + at + i for i in range(len(some))] or [None]
            texts = [data[s:e].decode(errors="replace") for s, e in some] or [None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([partition.layer] * m), pa.array([partition.offset] * m, pa.int64()), pa.array(place, pa.int64()),
                    pa.array(["failed" if spans is None else "ok"] * m), pa.array(texts, pa.string()),
                ],
                ["layer", "offset", "position", "status", "feature"],
            )


def scan(
    spark: SparkSession, root: str, where: Column | str | None = None, max_records: int | None = None, split: int = DEFAULT_PAGE
) -> DataFrame:
    """(layer, offset, position, status, feature): a row for each stored feature, and one for a page that has none.

    Conditions on layer and offset in ``where`` decide which pages are opened. Spark keeps pushed filters with the
    loaded source, so two filters over one load would mix; every scan loads its own, and columns pass a one-row
    generator that later filters do not cross. Tasks open the pages by themselves. A store that
    only Spark can read comes through its file reader, which prunes by layer but not by offset and leaves empty
    files out (their pages then count as missing).
    """
    if urlsplit(root).scheme not in SCHEMES:
        stored = _scan_by_spark(spark, root)
        return stored if where is None else stored.where(where)
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedLayers)
    options = {"path": root, "split": split, "max_records": max_records or DEFAULT_PAGE}
    loaded = spark.read.format("paged_layers").options(**options).load()
    if where is None:
        where = F.col("offset").isNotNull()
    return loaded.where(where).select(F.inline(F.array(F.struct(*loaded.columns))))


def _scan_by_spark(spark: SparkSession, root: str) -> DataFrame:
    stored = read_pages(spark, root)
    held = F.from_json("body", "features array<string>")["features"]
    features = F.when(F.col("status") == "ok", held)
    return stored.select("layer", "offset", "status", F.posexplode_outer(features).alias("position", "feature")).select(
        "layer", "offset", F.col("position").cast("long").alias("position"), "status", "feature"
    )


def page_summary(scanned: DataFrame) -> DataFrame:
    """(layer, offset, status, features) of every stored page."""
    return scanned.groupBy("layer", "offset").agg(F.min("status").alias("status"), F.count("position").alias("features"))
