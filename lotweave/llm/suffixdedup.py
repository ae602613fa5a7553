"""Suffix-array dedup: bytes that a long string of an earlier document covers are removed.

Prefix doubling ranks positions by ever longer prefixes and goes on only where ranks are not
unique. Here it runs over a sparse set of positions that every document chooses alike: the
smallest hash of ``SEED``-byte strings in each window of ``length`` bytes (a minimizer). Every
string of ``length`` bytes holds the anchor of its window, so two equal strings share an anchor at
the same place.

1. Rank by ``SEED`` bytes: anchors are dealt by the seed's hash, sorted, and drop out if no other
   document has the seed.
2. Rank by ``2 * length - SEED`` bytes, the anchor's surroundings: pairs (seed, surroundings) are
   reranked. Where an earlier document has the same pair, every string through this anchor repeats
   and it is settled; one anchor for each pair goes on if its seed has other surroundings too.
3. Rank by the strings of ``length`` bytes through those anchors, at each of their
   ``length - SEED + 1`` offsets: covered are those that an earlier document has, too.

A task settles what repeats among its own rows first, so a passage that very many documents share
crosses the shuffle once for each task. Seeds with more than ``HOT`` different surroundings
in a task or range are dealt by their strings, not by the seed: the smallest document of each string in a task is
found there and asks for the others, which are settled by it. Ranks are 64-bit hashes.

Defined cases: null text is empty; texts shorter than ``length`` lose nothing; of rows with one
id, none is smaller than the other, so they do not cover each other, but all of them are compared with the
rows of other ids; null ids are neither compared nor changed; an empty table gives no rows; further columns are
not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotweave.llm import spread
from lotweave.llm import textkit as tk
from lotweave.session import durable, ship_package

SEED = 24
HOT = 1024
PART = 1 << 17
FLUSH = 1 << 17
SETTLED, ASK, ASK_HOT = 0, 1, 2
_PRIME = np.uint64(0xA24BAED4963EE407)


def _windows_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest of every ``width`` consecutive values of 32 bits."""
    best = (values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors(piece: tk.Slice, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position in the row, seed hash, hash of the surroundings) of every anchor, part by part."""
    data, offsets = piece.data, piece.offsets
    width = length - SEED + 1
    reach = length - SEED
    last = -1
    for base in range(0, len(data), PART):
        low = max(0, base - reach)
        high = min(len(data), base + PART + 2 * length)
        part = data[low:high]
        if len(part) < length:
            continue
        sums = tk.prefix_sums(part)
        starts = np.arange(base - low, len(part) - SEED + 1)
        if len(starts) < width:
            continue
        seeds = tk.span_hashes(sums, starts, starts + SEED)
        best = _windows_minima(seeds >> np.uint64(32), width)[:PART]  # one for each string of this part
        first = base + np.arange(len(best))
        row = np.searchsorted(offsets, first, side="right") - 1
        inside = first + length <= offsets[row + 1]
        place, row = best[inside], row[inside]
        if not len(place):
            continue
        new = np.ones(len(place), dtype=bool)
        new[1:] = place[1:] != place[:-1]
        new[0] = base + place[0] != last  # parts overlap
        place, row = place[new], row[new]
        if not len(place):
            continue
        at = base + place
        last = at[-1]
        left = np.maximum(offsets[row], at - reach)
        right = np.minimum(offsets[row + 1], at + length)
        around = tk.span_hashes(sums, left - low, right - low)
        around = tk.mix(around + (at - left).astype(np.uint64) * _PRIME + (right - at).astype(np.uint64))
        yield row, at - offsets[row], seeds[place], around


def _smallest(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, where each key begins, and the smallest document of each key, spread over its entries."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    least = np.minimum.reduceat(doc[order], begins)
    return order, begins, np.repeat(least, np.diff(np.append(begins, len(keys))))


def _settle(seed: np.ndarray, around: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which anchors an earlier document repeats with all their surroundings."""
    order, _, least = _smallest(tk.mix(seed * _PRIME ^ around), doc)
    out = np.empty(len(doc), dtype=bool)
    out[order] = doc[order] > least
    return out


def _seed_blocks(length: int, ranges: int):
    """Blocks of (seed, surroundings, document, its row, position, state), dealt by seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            ids, nth = batch.column(0).to_numpy(), batch.column(2).to_numpy().astype(np.uint32)
            for piece in tk.slices(batch.column(1)):
                for row, position, seed, around in anchors(piece, length):
                    held.append((seed, around, ids[piece.first + row], nth[piece.first + row], position))
                    count += len(row)
                if count > FLUSH:
                    yield from _flush_seeds(held, ranges)
                    held, count = [], 0
        if count:
            yield from _flush_seeds(held, ranges)

    return run


def _flush_seeds(held: list[tuple[np.ndarray, ...]], ranges: int) -> Iterator[pa.RecordBatch]:
    seed, around, doc, nth, position = (np.concatenate(c) for c in zip(*held))
    state = np.where(_settle(seed, around, doc), SETTLED, ASK).astype(np.uint8)
    # a seed with very many surroundings here is dealt by its strings; one entry still tells the others
    asking = np.flatnonzero(state == ASK)
    order = asking[np.argsort(seed[asking], kind="stable")]
    begins = np.flatnonzero(np.concatenate(([True], seed[order][1:] != seed[order][:-1]))) if len(order) else order
    sizes = np.diff(np.append(begins, len(order)))
    hot = np.repeat(sizes > HOT, sizes)
    state[order[hot]] = ASK_HOT
    low = (seed & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    yield from spread.pack(seed, [low, around, doc, nth, position.astype(np.int64), state], ranges)


def _rank_seeds(group: pa.Table) -> pa.Table:
    """(document, row, mark): 4 * position + state of every anchor that is settled or must be asked."""
    low, around, doc, nth, position, state = spread.unpack(group, [np.uint32, np.uint64, np.int64, np.uint32, np.int64, np.uint8])
    settled = state == SETTLED
    out = [(doc[settled], nth[settled], position[settled], np.full(int(settled.sum()), SETTLED))]
    low, around, doc, nth, position, state = (c[~settled] for c in (low, around, doc, nth, position, state))
    if len(low):
        order, begins, least = _smallest(low, doc)
        low, around, doc, nth, position, state = (c[order] for c in (low, around, doc, nth, position, state))
        sizes = np.diff(np.append(begins, len(low)))
        shared = np.repeat(np.maximum.reduceat(doc, begins), sizes) > least
        hot = np.repeat(np.maximum.reduceat(state, begins) == ASK_HOT, sizes) | np.repeat(sizes > 4 * HOT, sizes)
        low, around, doc, nth, position, hot = (c[shared] for c in (low, around, doc, nth, position, hot))
    if len(low):
        covered = _settle(low.astype(np.uint64), around, doc)
        out.append((doc[covered], nth[covered], position[covered], np.full(int(covered.sum()), SETTLED)))
        low, around, doc, nth, position, hot = (c[~covered] for c in (low, around, doc, nth, position, hot))
        order = np.argsort(low, kind="stable")
        low, around, doc, nth, position, hot = (c[order] for c in (low, around, doc, nth, position, hot))
        begins = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        several = np.minimum.reduceat(around, begins) != np.maximum.reduceat(around, begins)
        ask = np.repeat(several, np.diff(np.append(begins, len(low))))
        out.append((doc[ask], nth[ask], position[ask], np.where(hot[ask], ASK_HOT, ASK)))
    doc, nth, position, state = (np.concatenate(c) for c in zip(*out))
    return _marks(doc, nth, position * 4 + state)


MARKS = "doc long, nth long, mark long"


def _marks(doc: np.ndarray, nth: np.ndarray, mark: np.ndarray) -> pa.Table:
    return pa.table({"doc": pa.array(doc), "nth": pa.array(nth.astype(np.int64)), "mark": pa.array(mark)})


def _marked_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place in the batch, bytes, marks) of a batch of (document, text, marks, ...)."""
    lists = batch.column(2)
    ends, values = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    for piece in tk.slices(batch.column(1)):
        for r in range(piece.rows):
            i = piece.first + r
            yield i, piece.data[piece.offsets[r] : piece.offsets[r + 1]], values[ends[i] - ends[0] : ends[i + 1] - ends[0]]


def _surroundings(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes around anchors, the anchor always in the same column, and how many are real on each side."""
    reach = length - SEED
    padded = np.concatenate((np.zeros(reach, np.uint8), data, np.zeros(length, np.uint8)))
    around = padded[at[:, None] + np.arange(reach + length)]
    left = np.minimum(at, reach).astype(np.uint8)
    right = np.minimum(len(data) - at, length).astype(np.uint8)
    return around, left, right


def _string_ranks(around: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the string at each offset before the anchor, and whether it lies in the document."""
    reach = length - SEED
    offset = np.arange(reach + 1)
    sums = np.zeros((len(around), reach + length + 1), dtype=np.uint64)
    np.cumsum(tk.BYTES[around] * tk.power(reach + length), axis=1, out=sums[:, 1:])
    ranks = (sums[:, reach + length - offset] - sums[:, reach - offset]) * tk.power(reach + length, down=True)[reach - offset]
    real = (offset <= left[:, None]) & (length - offset <= right[:, None])
    return tk.mix(ranks), real


def _ask_blocks(length: int, ranges: int):
    """Blocks of (seed, document, its row, position, bytes on both sides, surroundings), dealt by seed."""
    shape = f"V{2 * length - SEED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            docs, nths = batch.column(0).to_numpy(), batch.column(3).to_numpy().astype(np.uint32)
            for i, data, marks in _marked_rows(batch):
                at = np.sort(marks[marks % 4 == ASK] // 4)
                if not len(at):
                    continue
                around, left, right = _surroundings(data, at, length)
                sums = tk.prefix_sums(np.ascontiguousarray(around[:, length - SEED : length]).ravel())
                spots = np.arange(len(at)) * SEED
                seeds = tk.span_hashes(sums, spots, spots + SEED)
                held.append((seeds, np.full(len(at), docs[i]), np.full(len(at), nths[i]), at, left, right, np.ascontiguousarray(around).view(shape).ravel()))
                count += len(at)
                if count > spread.FLUSH // 8:
                    yield from _flush_asks(held, ranges)
                    held, count = [], 0
        if count:
            yield from _flush_asks(held, ranges)

    return run


def _flush_asks(held: list[tuple[np.ndarray, ...]], ranges: int) -> Iterator[pa.RecordBatch]:
    seed, doc, nth, at, left, right, around = (np.concatenate(c) for c in zip(*held))
    low = (seed & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    yield from spread.pack(seed, [low, doc.astype(np.int64), nth, at.astype(np.int64), left, right, around], ranges)


def _rank_strings(length: int):
    """(document, row, mark): position and the offsets whose strings an earlier document has, as bits."""
    reach = length - SEED
    width = reach + length

    def run(group: pa.Table) -> pa.Table:
        kinds = [np.uint32, np.int64, np.uint32, np.int64, np.uint8, np.uint8, np.dtype(f"V{width}")]
        low, doc, nth, at, left, right, around = spread.unpack(group, kinds)
        order = np.argsort(low, kind="stable")
        low, doc, nth, at, left, right, around = (c[order] for c in (low, doc, nth, at, left, right, around))
        bits = np.zeros(len(low), dtype=np.int64)
        begins = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        a = 0
        while a < len(low):  # whole seeds, about 64,000 anchors at a time
            b = int(np.searchsorted(begins, a + (1 << 16)))
            b = int(begins[b]) if b < len(begins) else len(low)
            own = slice(a, b)
            ranks, real = _string_ranks(around[own].view(np.uint8).reshape(b - a, width), left[own], right[own], length)
            for offset in range(reach + 1):
                some = np.flatnonzero(real[:, offset])
                if len(some):
                    order, _, least = _smallest(tk.mix(ranks[some, offset] ^ low[own][some].astype(np.uint64) * _PRIME), doc[own][some])
                    hit = order[doc[own][some][order] > least]
                    bits[a + some[hit]] |= 1 << offset
            a = b
        hit = bits > 0
        return _marks(doc[hit], nth[hit], (at[hit] << (reach + 2)) | bits[hit])

    return run


def _hot_blocks(length: int, ranges: int):
    """Blocks of (rank, document, its row, start) of every string through a hot anchor, dealt by rank.

    Of the documents of a task that share a string the smallest asks; the others are settled, and dealt apart
    by document in as many ranges again.
    """

    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        rank, doc, nth, start = (np.concatenate(c) for c in zip(*held))
        order, _, least = _smallest(rank, doc)
        settled = np.empty(len(doc), dtype=bool)
        settled[order] = doc[order] > least
        for own, keys, shift in ((~settled, rank, 0), (settled, tk.mix(doc.view(np.uint64)), ranges)):
            for batch in spread.pack(keys[own], [rank[own], doc[own], nth[own], start[own]], ranges):
                yield batch.set_column(0, "range", pa.array(batch.column(0).to_numpy() + shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            docs, nths = batch.column(0).to_numpy(), batch.column(3).to_numpy().astype(np.uint32)
            for i, data, marks in _marked_rows(batch):
                every = np.sort(marks[marks % 4 == ASK_HOT] // 4)
                for a in range(0, len(every), 4096):
                    at = every[a : a + 4096]
                    ranks, real = _string_ranks(*_surroundings(data, at, length), length)
                    start, first = np.unique((at[:, None] - np.arange(length - SEED + 1))[real], return_index=True)
                    held.append((ranks[real][first], np.full(len(start), docs[i]), np.full(len(start), nths[i]), start.astype(np.int64)))
                    count += len(start)
                    if count > spread.FLUSH:
                        yield from flush(held)
                        held, count = [], 0
        if count:
            yield from flush(held)

    return run


def _rank_hot(length: int, ranges: int):
    """(document, row, mark) of the strings that an earlier document has, too."""

    def run(group: pa.Table) -> pa.Table:
        rank, doc, nth, start = spread.unpack(group, [np.uint64, np.int64, np.uint32, np.int64])
        if group.column("range")[0].as_py() < ranges and len(rank):
            order, _, least = _smallest(rank, doc)
            hit = order[doc[order] > least]
            doc, nth, start = doc[hit], nth[hit], start[hit]
        return _marks(doc, nth, (start << (length - SEED + 2)) + 1)

    return run


def _covered(n: int, marks: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` bytes the marks cover."""
    reach = length - SEED
    at, bits = marks >> (reach + 2), marks & ((1 << (reach + 2)) - 1)
    edge = np.zeros(n + 1, dtype=np.int32)
    whole = at[bits >> (reach + 1) == 1]
    np.add.at(edge, np.maximum(whole - reach, 0), 1)
    np.add.at(edge, np.minimum(whole, n - length) + length, -1)
    for offset in range(reach + 1):
        start = at[(bits >> offset) & 1 == 1] - offset
        np.add.at(edge, start, 1)
        np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _apply(length: int, with_text: bool):
    names = ["doc", "h", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            for _, data, marks in _marked_rows(batch.select([0, 1, 2])):
                gone = _covered(len(data), marks, length) if len(marks) else np.zeros(len(data), dtype=bool)
                kept = data[~gone].tobytes()
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rows.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
                texts.append(kept)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))] if rows else []
            if rows:
                extra = [pa.array(texts, pa.binary())] if with_text else []
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), *columns, *extra], names)

    return run


def marks(docs: DataFrame, key: str, length: int) -> DataFrame:
    """(doc, nth, marks): what is covered in each row that loses something; rows are named by ``key`` and ``nth``."""
    total = spread.text_bytes(docs)
    density = 2 / (length - SEED + 2)
    blocks = docs.select(key, "text", "nth").mapInArrow(_seed_blocks(length, spread.ranges_for(2 * total * density)), spread.BLOCKS)
    ranked = durable(spread.by_range(blocks, _rank_seeds, MARKS))
    reach = length - SEED
    whole = 1 << (reach + 1)
    settled = ranked.where(f"mark % 4 = {SETTLED}").selectExpr("doc", "nth", f"shiftleft(shiftright(mark, 2), {reach + 2}) + {whole} AS mark")

    asked = ranked.where(f"mark % 4 <> {SETTLED}").groupBy("doc", "nth").agg(F.collect_list("mark").alias("marks"))
    few = spread.only_listed(docs.sparkSession, docs.withColumnRenamed(key, "doc"), "doc", "text", asked.select("doc"), also="nth")
    joined = few.join(asked, ["doc", "nth"]).select("doc", "text", "marks", "nth")
    asks, hot = ranked.agg(F.count(F.when(F.col("mark") % 4 == ASK, 1)), F.count(F.when(F.col("mark") % 4 == ASK_HOT, 1))).first()
    blocks = joined.mapInArrow(_ask_blocks(length, spread.ranges_for(asks * 8)), spread.BLOCKS)
    out = settled.unionByName(spread.by_range(blocks, _rank_strings(length), MARKS))
    if hot:
        ranges = spread.ranges_for(hot * (reach + 1))
        strings = joined.where(f"exists(marks, x -> x % 4 = {ASK_HOT})").mapInArrow(_hot_blocks(length, ranges), spread.BLOCKS)
        out = out.unionByName(spread.by_range(strings, _rank_hot(length, ranges), MARKS))
    return out.groupBy("doc", "nth").agg(F.collect_list("mark").alias("marks"))


def dedup(docs: DataFrame, length: int = 50, key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) for every row; ``with_text`` adds the bytes that stay, ``kept``.

    ``key`` is a long; ``length`` is at least 32 and below 58.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.where(F.col(key).isNotNull())
    twice = durable(known.groupBy(key).count().where("count > 1").select(key))
    repeated = not twice.isEmpty()
    single = known.withColumn("nth", F.lit(0).cast("long"))
    if repeated:  # rows of one id that differ are numbered
        texts = known.join(twice, key, "left_semi").distinct()
        nth = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("text"), "text")).cast("long")
        single = single.join(twice, key, "left_anti").unionByName(durable(texts.withColumn("nth", nth)))
    with spread.batches_of(spark, 400):
        found = durable(marks(single, key, length))
    fields = "doc long, h long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    listed = spark.sparkContext.broadcast(spread.slot_bitmap(found.select(F.xxhash64("doc").alias("h")), "h", 24))

    def split(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(listed.value.holds(batch.column(3).to_numpy().view(np.uint64)) == wanted))

        return run

    hashed = single.select(F.col(key).alias("doc"), "text", "nth", F.xxhash64(key).alias("h"))
    kind = "doc long, text string, nth long, h long"
    changed = hashed.mapInArrow(split(True), kind).join(found, ["doc", "nth"], "left")
    none = F.array().cast("array<long>")
    changed = changed.select("doc", "text", F.coalesce("marks", none).alias("marks"), F.xxhash64("text").alias("h"))
    done = changed.mapInArrow(_apply(length, with_text), fields).withColumnRenamed("doc", key)
    judged = done.unionByName(_unchanged(hashed.mapInArrow(split(False), kind).withColumnRenamed("doc", key), key, with_text))
    if repeated:
        every = known.select(key, F.xxhash64("text").alias("h"))
        judged = every.join(judged, [key, "h"])
    return judged.unionByName(_unchanged(rows.where(F.col(key).isNull()), key, with_text)).drop("h")


def _unchanged(rows: DataFrame, key: str, with_text: bool) -> DataFrame:
    zero = F.lit(0).cast("long")
    raw = F.col("text").cast("binary")
    out = [key, F.xxhash64("text").alias("h"), F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans")]
    return rows.select(*out, F.sha2(raw, 256).alias("kept_sha256"), *([raw.alias("kept")] if with_text else []))
