"""Near-duplicate lines by a segment-partition edit join (Li, Deng, Wang and Feng, Pass-Join, 2011).

A line (between ``\\n``) is dropped if an earlier line (by document id, then line number) is equal to it, or
within ``threshold`` byte edits; so of a chain the earliest line stays. Equal lines count whatever their length if they hold a
word; edits count between lines of at least ``min_bytes`` UTF-8 bytes, of which two edits are a twentieth ("Chapter 1" and
"Chapter 2" are different lines).

Equal lines are found by hash, as counts and minima that add up before the shuffle; minima of very common lines go to
the lines, not these to them. For the others, a line is cut into ``threshold + 1`` segments, of which at most ``threshold`` can be hit
by the edits. It is filed under its length and each segment, and looks up the substrings
of lines no longer than itself at the places where the alignment leaves them. Files and
look-ups travel as blocks by key range; a task sends a copy only if it sent no earlier one. Where both meet, byte
frequencies bound the distance from below. Pairs that remain have their lines fetched and the
distance computed in a band of bits.

Defined cases: null text has no lines; lines without a word stay; a line that repeats inside
one document is dropped there too; rows with the same id are told apart by nothing and share
their decisions; null ids are left alone; further columns are kept by ``without_repeats``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotweave.llm import spread
from lotweave.llm import textkit as tk
from lotweave.session import durable, ship_package

BUCKETS = 8
#: A line that occurs more often is very common; so many such lines are broadcast at most.
COMMON, COMMON_LINES = 1024, 1 << 16
_FILED, _PROBE = 0, 1


def line_spans(piece: tk.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number in the row, start and end of every line."""
    data, offsets = piece.data, piece.offsets
    breaks = np.flatnonzero(data == 10)
    heads = offsets[:-1]
    row_of_break = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.concatenate((heads, breaks + 1))
    row = np.concatenate((np.arange(piece.rows), row_of_break))
    order = np.lexsort((starts, row))
    starts, row = starts[order], row[order]
    ends = np.empty_like(starts)
    ends[:-1] = np.where(row[1:] == row[:-1], starts[1:] - 1, offsets[1:][row[:-1]])
    if len(ends):
        ends[-1] = offsets[-1]
    first = np.searchsorted(row, np.arange(piece.rows))
    return row, np.arange(len(row)) - first[row], starts, ends


def segment_cuts(length: np.ndarray, parts: int) -> np.ndarray:
    """Borders of the segments, the longer ones last."""
    base, extra = length // parts, length % parts
    k = np.arange(parts + 1)
    return base[:, None] * k + np.maximum(k - (parts - extra[:, None]), 0)


def keyed_spans(length: np.ndarray, threshold: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(role, which lines, filed length, segment, start, end) of everything that is filed and looked up.

    A probe for filed length ``l`` starts within ``i`` of segment ``i`` and within ``threshold - i``
    of it counted from the right, less what the difference of the lengths already takes.
    """
    parts = threshold + 1
    every = np.arange(len(length))
    cuts = segment_cuts(length, parts)
    for i in range(parts):
        yield _FILED, every, length, np.full(len(length), i), cuts[:, i], cuts[:, i + 1]
    for less in range(threshold + 1):
        filed = length - less
        borders = segment_cuts(filed, parts)
        for i in range(parts):
            start, size = borders[:, i], borders[:, i + 1] - borders[:, i]
            low = max(-i, less - (threshold - i))
            high = min(i, less + (threshold - i))
            for shift in range(low, high + 1):
                at = start + shift
                fits = np.flatnonzero((at >= 0) & (at + size <= length) & (filed > 0))
                yield _PROBE, fits, filed[fits], np.full(len(fits), i), at[fits], (at + size)[fits]


def _lines() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(document, line, hash) of every line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tk.slices(batch.column(1)):
                row, number, starts, ends = line_spans(piece)
                long_ = np.flatnonzero(ends > starts)
                solid = ~tk.BLANK[piece.data[starts[long_]]]
                for k in np.flatnonzero(~solid):  # begins with a blank: is there more?
                    solid[k] = not tk.BLANK[piece.data[starts[long_[k]] : ends[long_[k]]]].all()
                long_ = long_[solid]
                hashes = tk.word_hashes(piece.data, starts[long_], ends[long_])
                ids = batch.column(0).slice(piece.first, piece.rows).take(pa.array(row[long_]))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(number[long_].astype(np.int64)), pa.array(tk.signed(hashes))], ["doc", "line", "hash"]
                )

    return run


def _files(min_bytes: int, threshold: int, ranges: int):
    """Blocks of (key, role, line hash, document, line, frequencies).

    Rows come in any order: a copy goes out unless an earlier line with the same bytes went before it,
    so the earliest copy always does, and ``_meet`` keeps only that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, tuple[int, int]] = {}  # place of the earliest copy that went out
        held: list[list[np.ndarray]] = []
        count = 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for piece in tk.slices(batch.column(1)):
                row, number, starts, ends = line_spans(piece)
                long_ = np.flatnonzero(ends - starts >= min_bytes)
                whole = tk.word_hashes(piece.data, starts[long_], ends[long_])
                doc = ids[piece.first + row[long_]].astype(np.int64)
                order = np.lexsort((number[long_], doc, whole))
                order = order[np.concatenate(([True], np.diff(whole[order]) != 0))[: len(order)]]
                keep = []
                for k, h, *place in zip(order.tolist(), whole[order].tolist(), doc[order].tolist(), number[long_[order]].tolist()):
                    if h not in sent or tuple(place) < sent[h]:
                        sent[h] = tuple(place)
                        keep.append(k)
                if len(sent) > spread.FLUSH:
                    sent.clear()
                keep = np.sort(np.array(keep, dtype=np.int64))
                if not len(keep):
                    continue
                long_, whole = long_[keep], whole[keep]
                row, number, starts, ends = row[long_], number[long_], starts[long_], ends[long_]
                often = _frequencies(piece.data, starts, ends)
                for role, which, filed, segment, a, b in keyed_spans(ends - starts, threshold):
                    h = tk.word_hashes(piece.data, starts[which] + a, starts[which] + b)
                    keys = tk.mix(h + filed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + segment.astype(np.uint64))
                    held.append(
                        [
                            keys, np.full(len(keys), role, np.uint8), (whole[which] >> np.uint64(32)).astype(np.uint32),
                            ids[piece.first + row[which]].astype(np.int64), number[which].astype(np.int64), often[which],
                        ]
                    )
                    count += len(keys)
                if count > spread.FLUSH:
                    yield from _packed(held, ranges)
                    held, count = [], 0
        if count:
            yield from _packed(held, ranges)

    return run


def _packed(held: list[list[np.ndarray]], ranges: int) -> Iterator[pa.RecordBatch]:
    keys, role, whole, doc, line, often = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((line, doc))
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    yield from spread.pack(keys[order], [c[order] for c in (low, role, whole, doc, line, often)], ranges)


def _frequencies(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Eight counts of bytes (mod 256) for each span, as one 64-bit number."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for bucket in range(BUCKETS):
        upto = np.concatenate(([0], np.cumsum((data & (BUCKETS - 1)) == bucket)))
        out |= ((upto[ends] - upto[starts]) & 255).astype(np.uint64) << np.uint64(8 * bucket)
    return out


def frequency_gap(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of the differences of the counts; one edit changes it by two at most."""
    gap = np.zeros(np.broadcast(x, y).shape, dtype=np.int64)
    for bucket in range(BUCKETS):
        shift = np.uint64(8 * bucket)
        d = (((x >> shift) & np.uint64(255)).astype(np.int64) - ((y >> shift) & np.uint64(255)).astype(np.int64)) & 255
        gap += np.minimum(d, 256 - d)
    return gap


def _meet(threshold: int, block: int = 1024):
    """Pairs (earlier line, later line) of a range whose segment matches and whose frequencies allow it."""

    def run(group: pa.Table) -> pa.Table:
        kinds = [np.uint32, np.uint8, np.uint32, np.int64, np.int64, np.uint64]
        low, role, whole, doc, line, often = spread.unpack(group, kinds)
        order = np.lexsort((line, doc, whole, role, low))
        low, role, whole, doc, line, often = (c[order] for c in (low, role, whole, doc, line, often))
        first = np.ones(len(low), dtype=bool)  # of equal lines the earliest
        first[1:] = (low[1:] != low[:-1]) | (role[1:] != role[:-1]) | (whole[1:] != whole[:-1])
        low, role, whole, doc, line, often = (c[first] for c in (low, role, whole, doc, line, often))
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(low)) + 1, [len(low)]))
        found: list[np.ndarray] = []
        for g in np.flatnonzero(np.diff(cuts) > 2):
            a, b = cuts[g], cuts[g + 1]
            middle = a + int(np.searchsorted(role[a:b], _PROBE))
            for i in range(a, middle, block):
                for j in range(middle, b, block):
                    x, y = slice(i, min(i + block, middle)), slice(j, min(j + block, b))
                    near = (whole[x][:, None] != whole[y]) & (frequency_gap(often[x][:, None], often[y]) <= 2 * threshold)
                    p, q = np.nonzero(near)
                    if len(p):
                        found.append(np.column_stack((doc[x][p], line[x][p], doc[y][q], line[y][q])))
        pairs = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
        swap = (pairs[:, 0] > pairs[:, 2]) | ((pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] > pairs[:, 3]))
        pairs[swap] = pairs[swap][:, [2, 3, 0, 1]]
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
        return pa.table({n: pa.array(np.ascontiguousarray(pairs[:, k])) for k, n in enumerate(("a_doc", "a_line", "b_doc", "b_line"))})

    return run


def banded_distance(pattern: list[bytes], text: list[bytes], threshold: int) -> np.ndarray:
    """Edit distance of each pair if at most ``threshold``, else ``threshold + 1``; patterns are that long at least.

    Hyyrö's bit-parallel column (2003) over the ``2 * threshold + 1`` cells beside the diagonal,
    for all pairs at once: bit ``k`` of column ``j`` is byte ``j - threshold + k``
    of the pattern. The distance is
    followed down the diagonal and then along the last row.
    """
    t = threshold
    n, m = np.array([len(x) for x in pattern]), np.array([len(x) for x in text])
    pairs = len(pattern)
    width = 2 * t + 1
    longest = int(max(n.max(initial=0), m.max(initial=0)))
    grid = np.full((2, pairs, longest + width + 1), -1, dtype=np.int16)
    grid[1] = -2
    for k, (x, y) in enumerate(zip(pattern, text)):
        grid[0, k, t : t + len(x)] = np.frombuffer(x, dtype=np.uint8)
        grid[1, k, : len(y)] = np.frombuffer(y, dtype=np.uint8)
    one = np.uint64(1)
    full = np.uint64((1 << width) - 1)
    # column 0 rises by one a row from the first row on, which is bit t
    vp = np.full(pairs, ((1 << (t + 1)) - 1) << t, dtype=np.uint64)
    vn = np.zeros(pairs, dtype=np.uint64)
    score = np.full(pairs, t, dtype=np.int64)  # of cell (j + t, j), the lowest of the band
    bottom = np.uint64(2 * t)
    for j in range(longest):
        live = j < m
        match = np.zeros(pairs, dtype=np.uint64)
        for k in range(width):
            match |= (grid[0, :, j + k] == grid[1, :, j]).astype(np.uint64) << np.uint64(k)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        down = (n - 1 - j) >= t  # the lowest cell is still inside the pattern
        diagonal = ((d0 >> bottom) & one).astype(np.int64)
        # beyond, the last row climbs through the band
        row = np.clip(n - 1 - j + t, 0, 2 * t).astype(np.uint64)
        across = ((hp >> row) & one).astype(np.int64) - ((hn >> row) & one).astype(np.int64)
        score = np.where(live, np.where(down, score + 1 - diagonal, score + across), score)
        x = d0 >> one
        vp = np.where(live, (hn | ~(x | hp)) & full, vp)
        vn = np.where(live, x & hp, vn)
    return np.where(np.abs(n - m) > t, t + 1, np.minimum(score, t + 1))


def _wanted_lines(docs: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """(doc, line, bytes) of the lines that ``named`` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2).to_pylist()
            for piece in tk.slices(batch.column(1)):
                row, _, starts, ends = line_spans(piece)
                first = np.searchsorted(row, np.arange(piece.rows))
                doc, line, held = [], [], []
                raw = piece.data.tobytes()
                for r in range(piece.rows):
                    for number in lists[piece.first + r]:
                        at = first[r] + number
                        if at < len(row) and row[at] == r:
                            doc.append(piece.first + r), line.append(number), held.append(raw[starts[at] : ends[at]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(line, pa.int64()), pa.array(held, pa.binary())], ["doc", "line", "held"]
                )

    by_doc = named.groupBy("doc").agg(F.collect_set("line").alias("lines"))
    few = spread.only_listed(docs.sparkSession, docs, key, "text", by_doc.select(F.col("doc").alias(key)))
    return few.join(by_doc.withColumnRenamed("doc", key), key).select(key, "text", "lines").mapInArrow(run, "doc long, line long, held binary")


def _near(docs: DataFrame, key: str, min_bytes: int, threshold: int, total: int) -> DataFrame:
    """(a_doc, a_line, b_doc, b_line, distance): different lines within the threshold, the earlier one first."""
    keys = total / min_bytes * (threshold + 1 + (threshold + 1) ** 2)
    blocks = docs.where(F.col(key).isNotNull()).select(key, "text").mapInArrow(_files(min_bytes, threshold, spread.ranges_for(keys / 4)), spread.BLOCKS)
    pairs = durable(spread.by_range(blocks, _meet(threshold), "a_doc long, a_line long, b_doc long, b_line long").distinct())
    ends = pairs.select(F.inline(F.expr("array(struct(a_doc AS doc, a_line AS line), struct(b_doc AS doc, b_line AS line))"))).distinct()
    lines = durable(_wanted_lines(docs, ends, key))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 1024):
                part = batch.slice(first, 1024)
                a, b = part.column(4).to_pylist(), part.column(5).to_pylist()
                distance = pa.array(banded_distance(a, b, threshold).astype(np.int64))
                out = pa.RecordBatch.from_arrays([*part.columns[:4], distance], ["a_doc", "a_line", "b_doc", "b_line", "distance"])
                yield out.filter(pa.array(distance.to_numpy() <= threshold))

    a = lines.select(F.col("doc").alias("a_doc"), F.col("line").alias("a_line"), F.col("held").alias("a"))
    b = lines.select(F.col("doc").alias("b_doc"), F.col("line").alias("b_line"), F.col("held").alias("b"))
    both = pairs.join(a, ["a_doc", "a_line"]).join(b, ["b_doc", "b_line"]).select("a_doc", "a_line", "b_doc", "b_line", "a", "b")
    return both.mapInArrow(measure, "a_doc long, a_line long, b_doc long, b_line long, distance long")


def repeats(docs: DataFrame, threshold: int = 2, min_bytes: int = 40, key: str = "doc_id") -> DataFrame:
    """(key, line, first_doc, first_line, distance): every line that is dropped and the earliest line it repeats.

    Line numbers start from 0. ``key`` is a long.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias(key), "text")
    total = spread.text_bytes(docs)
    lines = docs.where(F.col(key).isNotNull()).mapInArrow(_lines(), "doc long, line long, hash long")
    first = lines.groupBy("hash").agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = durable(first)
    common = first.where(F.col("n") > COMMON).select("hash", F.col("first").alias("common"))  # at most a row for each ``COMMON`` lines
    if common.count() <= COMMON_LINES:
        lines = lines.join(F.broadcast(common), "hash", "left")
    else:
        lines = lines.withColumn("common", F.lit(None).cast(first.schema["first"].dataType))
    # a very common line has its first one by now and is dealt by its own place
    own = F.when(F.col("common").isNull(), F.col("hash")).otherwise(F.xxhash64("doc", "line"))
    rest = first.select(F.col("hash").alias("deal"), "hash", "first")
    again = lines.withColumn("deal", own).join(rest, ["deal", "hash"], "left").withColumn("first", F.coalesce("common", "first"))
    again = again.where("first IS NOT NULL AND struct(doc, line) <> first")
    equal = again.select("doc", "line", F.col("first.doc").alias("first_doc"), F.col("first.line").alias("first_line"), F.lit(0).cast("long").alias("distance"))
    near = _near(docs, key, min_bytes, threshold, total)
    least = near.groupBy("b_doc", "b_line").agg(F.min(F.struct("a_doc", "a_line", "distance")).alias("x"))
    close = least.select(F.col("b_doc").alias("doc"), F.col("b_line").alias("line"), "x.a_doc", "x.a_line", "x.distance")
    both = equal.unionByName(close.toDF("doc", "line", "first_doc", "first_line", "distance"))
    # an equal copy of a line that is dropped itself has one row, of the equal line
    return both.groupBy(F.col("doc").alias(key), "line").agg(F.min(F.struct("distance", "first_doc", "first_line")).alias("x")).select(
        key, "line", "x.first_doc", "x.first_line", "x.distance"
    )


def without_repeats(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Documents without the lines that repeat earlier ones; ``n_chars`` follows, other columns stay.

    A document that had words and has none left is dropped.
    """
    lines = spread.free_name(docs, "lines")
    dropped = repeats(docs, key=key, **options).groupBy(key).agg(F.collect_set("line").alias(lines))
    split = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    left = F.filter(split, lambda x, i: ~F.array_contains(lines, i.cast("long")))
    out = docs.join(dropped, key, "left").withColumn("text", F.when(F.col(lines).isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(lines).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    emptied = F.col(lines).isNotNull() & ~F.coalesce(F.col("text").rlike("[^ \\t-\\r]"), F.lit(False))
    return out.where(~emptied).select(*docs.columns)
