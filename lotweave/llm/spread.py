"""Keyed records as compressed blocks, dealt by key range, and other helpers of the operators.

Operators that compare billions of small keys do not make a Spark row of each. A task packs
its records into one block for each range of the 64-bit key; Spark shuffles the blocks by range
and a task sorts the records of its ranges with numpy. Ranges are as many as keep one at about
``RANGE`` records, so memory does not grow with the input.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotweave.llm import textkit as tk
from lotweave.session import durable

RANGE = 1 << 18
FLUSH = 1 << 18
BLOCKS = "range long, records long, block binary"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that run inside, so that long texts do not pile up."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files and checkpoints that no DataFrame refers to any more: Spark deletes them once the driver has noticed."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as make it differ from the columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ranges_for(records: float) -> int:
    return max(1, int(-(-records // RANGE)))


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges of equal width over the upper 32 bits of the key."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def pack(keys: np.ndarray, columns: list[np.ndarray], ranges: int) -> Iterator[pa.RecordBatch]:
    """One block a range: ``columns`` (one of them may hold the keys) in their given order."""
    where = range_of(keys, ranges)
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.diff(where[order])) + 1
    for own in np.split(order, cuts) if len(order) else ():
        parts = []
        for c in columns:
            v = c[own]
            if v.dtype.kind == "V":  # text compresses as it stands
                parts.append(v.tobytes())
                continue
            if v.dtype == np.int64:  # numbers that grow: differences compress
                v = np.diff(v, prepend=np.int64(0))
            parts.append(np.ascontiguousarray(v).view(np.uint8).reshape(len(own), -1).T.tobytes())
        raw = b"".join(parts)
        block = len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(where[own[0]])]), pa.array([len(own)]), pa.array([block], pa.binary())], ["range", "records", "block"]
        )


def unpack(group: pa.Table, dtypes: list[np.dtype]) -> list[np.ndarray]:
    """The records of all blocks of a range, column by column."""
    out: list[list[np.ndarray]] = [[] for _ in dtypes]
    for n, block in zip(group.column("records").to_pylist(), group.column("block")):
        held = block.as_py()
        raw = np.frombuffer(pa.decompress(held[8:], decompressed_size=int.from_bytes(held[:8], "little"), codec="zstd"), dtype=np.uint8)
        at = 0
        for k, dtype in enumerate(dtypes):
            dtype = np.dtype(dtype)
            size = n * dtype.itemsize
            if dtype.kind == "V":
                out[k].append(raw[at : at + size].view(dtype))
                at += size
                continue
            v = np.ascontiguousarray(raw[at : at + size].reshape(dtype.itemsize, n).T).view(dtype).ravel()
            out[k].append(np.cumsum(v) if dtype == np.int64 else v)
            at += size
    return [np.concatenate(parts) for parts in out]


def by_range(blocks: DataFrame, run: Callable[[pa.Table], Iterator[pa.RecordBatch] | pa.Table], schema: str) -> DataFrame:
    """Apply ``run`` to the table of blocks of every range."""
    return blocks.groupBy("range").applyInArrow(run, schema)


def slot_bitmap(keys: DataFrame, column: str, bits: int) -> tk.Slots:
    """Fixed-size bitmap of the hashes in ``column``: at most ``2**bits / 32`` words reach the driver."""
    words = (
        keys.select(F.shiftrightunsigned(column, 64 - bits).alias("place"))
        .selectExpr("cast(shiftright(place, 5) AS int) AS w", "shiftleft(1L, cast(pmod(place, 32) AS int)) AS b")
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toPandas()
    )
    out = tk.Slots(bits)
    out.words.view("<u4")[words.w.to_numpy(np.int64)] = words.b.to_numpy(np.int64).astype(np.uint32)
    return out


def only_listed(spark: SparkSession, docs: DataFrame, key: str, text: str, listed: DataFrame, bits: int = 24, also: str | None = None) -> DataFrame:
    """(key, text) of the documents that ``listed`` (a column ``key``) names, and few others; ``also`` is a long carried along.

    A bitmap of fixed size passes every listed document, so the texts of the rest are not
    shuffled; joins that follow settle what else came through.
    """
    sent = spark.sparkContext.broadcast(slot_bitmap(listed.select(F.xxhash64(key).alias("h")), "h", bits))
    carried = [key, text, *([also] if also else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = sent.value.holds(batch.column(len(carried)).to_numpy().view(np.uint64))
            yield batch.select(range(len(carried))).filter(pa.array(hit))

    kind = docs.schema[key].dataType.simpleString()
    fields = f"`{key}` {kind}, `{text}` string" + (f", `{also}` long" if also else "")
    return docs.select(*carried, F.xxhash64(key).alias("h")).mapInArrow(run, fields)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node: the smallest node that links (a, b) reach.

    Each round hangs all neighbours under the smallest one, in turn the larger and the smaller
    (Kiveris et al., 2014), after a number of rounds that is a logarithm of the chains' length.
    """
    edges = durable(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(hung.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        before, state = state, _state(edges)
        release(links.sparkSession)
        if state == before:
            break
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())


def merged_components(known: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links (a, b): only the components they tie together are worked on."""
    a = known.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = known.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    mapped = links.join(a, "a", "left").join(b, "b", "left")
    tied = durable(mapped.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b"))
    if tied.isEmpty():
        return known
    above = durable(components(tied))
    moved = known.join(above.toDF("component", "_new"), "component", "left").select("node", F.coalesce("_new", "component").alias("component"))
    return moved.unionByName(above.join(known.select("node"), "node", "left_anti"))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes, equal for equal sets."""
    mark: Column = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(mark, 20)), F.bit_xor(mark)).first())
