"""Mixture-controlled packing of token streams into sequences of a fixed size.

Each source is a queue of its documents' tokens. Every window serves the queues in turn and
grants each its target share plus the deficit that rounding left it in earlier windows. With
rates ``a_1, a_2, ...`` (tokens a window) the deficit counters have a closed form: after ``w``
windows the first ``s`` queues have had ``floor(w * (a_1 + ... + a_s))`` tokens together. So a
document's pieces follow from its place in its queue, in any task, with no window waiting for
another, and deficits carry across windows and partitions by construction. All windows hold
the same number of tokens, or one less, so fewer than one pad a window is added.

Queues with less than one token a window share one queue; the others are at most ``size``, so
the table of queues is bounded. A document's place is what earlier tasks hold of its queue, a
sum over a small table of (task, source), and a running count inside its task. Token ids are
written down once (two bytes each) where every executor can read them.

Defined cases: null text is empty and gives the end token alone; null sources form a source of
their own; repeated rows are packed each; an empty table gives no piece; further columns
are not carried.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotweave.session import durable, ship_package

SIZE = 2048
END_ID = 1
SPECIAL = "<|endoftext|>"


@functools.cache
def _tokenizers(vocabulary: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


@functools.cache
def _ranks(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def encode(text: str, vocabulary: str, ranks: str | None = None, pattern: str | None = None) -> np.ndarray:
    """Ids of ``text`` by the vocabulary file, with no special tokens added.

    With ``ranks``, the same vocabulary as a rank file gives the same ids in a quarter of
    the time; a text that spells a special token is left to the vocabulary file.
    """
    if ranks and SPECIAL not in text:
        return np.array(_ranks(ranks, pattern).encode_ordinary(text), dtype=np.uint32)
    return np.array(_tokenizers(vocabulary).encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def tokenize(docs: DataFrame, vocabulary: str, ranks: str | None, pattern: str | None, key: str = "doc_id") -> DataFrame:
    """(key, source, task, before, n, ids): ids as bytes, with the tokens its task holds of the source before."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        so_far: dict[str, int] = {}
        for batch in batches:
            names, texts = batch.column(1).to_pylist(), batch.column(2)
            for first in range(0, len(batch), 256):
                before, counts, blobs = [], [], []
                for name, text in zip(names[first : first + 256], texts[first : first + 256]):
                    ids = encode(text.as_py() or "", vocabulary, ranks, pattern)
                    ids = np.append(ids, np.uint32(END_ID))
                    before.append(so_far.get(name, 0))
                    so_far[name] = before[-1] + len(ids)
                    counts.append(len(ids))
                    blobs.append(ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\0" + ids.astype("<u4").tobytes())
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n), pa.array(names[first : first + n], pa.string()),
                        pa.array(np.full(n, task, np.int64)), pa.array(before, pa.int64()), pa.array(counts, pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    [key, "source", "task", "before", "n", "ids"],
                )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), "text")
    return rows.mapInArrow(run, f"`{key}` {kind}, source string, task long, before long, n long, ids binary")


def read_ids(blob: bytes) -> np.ndarray:
    if len(blob) % 2:
        return np.frombuffer(blob, dtype="<u4", offset=1)
    return np.frombuffer(blob, dtype="<u2").astype(np.uint32)


def cut(position: int, length: int, low: int, high: int, windows: int) -> list[tuple[int, int, int]]:
    """(window, offset in window, tokens) of a stretch of the queue between the cumulated totals ``low`` and ``high``."""
    out = []
    mine = high - low
    w = min(windows - 1, position * windows // mine)

    def granted(k: int) -> int:
        return high * k // windows - low * k // windows

    while w > 0 and granted(w) > position:
        w -= 1
    while granted(w + 1) <= position:
        w += 1
    while length:
        had, upto = granted(w), granted(w + 1)
        take = min(length, upto - position)
        if take > 0:
            ahead = low * (w + 1) // windows - low * w // windows
            out.append((w, ahead + position - had, take))
            position += take
            length -= take
        w += 1
    return out


def place(tokens: DataFrame, size: int = SIZE) -> DataFrame:
    """Add ``at``, the document's place in its queue, and the queue's totals ``low`` and ``high``; and the windows."""
    parts = durable(tokens.groupBy("task", "source").agg(F.sum("n").alias("n")))
    total = parts.agg(F.sum("n")).first()[0] or 0
    windows = max(1, -(-total // size))
    own = parts.groupBy("source").agg(F.sum("n").alias("total")).where(F.col("total") >= windows)
    queues = sorted((r.source, r.total) for r in own.collect())  # at most ``size`` of them
    small = total - sum(n for _, n in queues)
    if queues and 0 < small < windows:  # too little for a queue: it joins the last one
        queues, small = queues[:-1], small + queues[-1][1]
    rows, low = [], 0
    for name, n in queues:
        rows.append((name, low, low + n))
        low += n
    spark = tokens.sparkSession
    named = spark.createDataFrame(rows, "source string, low long, high long")
    parts = parts.join(F.broadcast(named), "source", "left")
    shared = parts.where("low IS NULL")
    by_task = shared.groupBy("task").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    first = by_task.select("task", F.coalesce(upto, F.lit(0)).alias("first"))
    within = F.sum("n").over(Window.partitionBy("task").orderBy("source").rowsBetween(Window.unboundedPreceding, -1))
    shared = shared.join(first, "task").select(
        "task", "source", (F.col("first") + F.coalesce(within, F.lit(0))).alias("base"),
        F.lit(low).cast("long").alias("low"), F.lit(low + small).cast("long").alias("high"),
    )
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    large = parts.where("low IS NOT NULL").select("task", "source", F.coalesce(earlier, F.lit(0)).alias("base"), "low", "high")
    bases = durable(large.unionByName(shared))
    placed = tokens.join(bases, ["task", "source"]).withColumn("at", F.col("base") + F.col("before"))
    return placed.withColumn("windows", F.lit(windows).cast("long"))


def pack(
    docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None, size: int = SIZE, key: str = "doc_id"
) -> DataFrame:
    """One row for each piece: where it lies in its document and in its sequence, its source and its ids."""
    ship_package(docs.sparkSession)
    tokens = durable(tokenize(docs, vocabulary, ranks, pattern, key))
    placed = place(tokens, size)
    names = [key, "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    step = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, low, high, windows = (batch.column(i).to_pylist() for i in range(3, 7))
            docs_, sources, blobs = batch.column(0), batch.column(1), batch.column(2)
            keep: list[int] = []
            rows: list[tuple[int, int, int, int, int, int]] = []
            for i in range(len(batch)):
                ids = read_ids(blobs[i].as_py())
                start = 0
                for w, offset, length in cut(at[i], len(ids), low[i], high[i], windows[i]):
                    keep.append(i)
                    rows.append((start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids), w, offset))
                    start += length
                if len(rows) >= step or i + 1 == len(batch):
                    numbers = np.array(rows, dtype=np.int64).reshape(-1, 6).T
                    yield pa.RecordBatch.from_arrays([docs_.take(pa.array(keep, pa.int64())), sources.take(pa.array(keep, pa.int64())), *map(pa.array, numbers)], names)
                    keep, rows = [], []

    kind = docs.schema[key].dataType.simpleString()
    fields = f"`{key}` {kind}, source string, " + ", ".join(f"{n} long" for n in names[2:])
    return placed.select(key, "source", "ids", "at", "low", "high", "windows").mapInArrow(run, fields)
