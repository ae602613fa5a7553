"""N-gram Jaccard join: all pairs of documents whose word shingles overlap enough, as components.

1. Documents with the same shingle set form one class (128-bit fingerprints); only its smallest
   id goes on, so a group of copies of any size costs one row.
2. Size-banded tiles. Sets that link lie in the same or in neighbouring size bands, and differ in
   at most ``D`` shingles, a bound that follows from the band. With the shingles dealt into more
   than ``D`` parts by hash, two such sets agree on whole parts, so documents that agree on a part
   form a tile and no link is lost. Agreement on a part is rare otherwise, whatever is common
   in the corpus.
3. First, documents with an equal minimum hash meet the one with the smallest id; what
   links becomes a component. Then tiles are compared, but only pairs in different components:
   others change nothing. A first pass takes each document's likeliest earlier partner, a second one
   all pairs that still lie in different components. Tiles of more than ``TILE`` documents are cut
   into blocks.
4. A pair's hashed bitmaps bound its overlap from above: a bit set in one and not in the other
   is a shingle that only one has. Tiles are compared by bit counts inside a task; only pairs that
   may still link leave it, have their texts joined and their sorted shingle arrays intersected.

Defined cases: null or empty text has no shingles and links with nothing; a text of fewer words
than a shingle is one shingle; rows with the same id are one node; null ids are left alone;
an empty table gives no rows; further columns are not carried.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotweave.llm import spread
from lotweave.llm import textkit as tk
from lotweave.session import durable, ship_package

HASHES = 4
SPARE = 2
TILE = 1024
#: A class of more documents is large; so many large ones are broadcast at most.
LARGE, LARGE_CLASSES = 1024, 1 << 16
_SEEDS = tk.mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(piece: tk.Slice, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = tk.LOWER[piece.data]
    starts, ends, bounds = tk.word_spans(data, piece.offsets)
    words = tk.word_hashes(data, starts, ends)
    every = tk.window_hashes(words, size)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        else:
            yield tk.window_hashes(words[a:b], b - a) if b > a else every[:0]


def least_overlap(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection that links two sets whose sizes add up to ``sizes``."""
    return -(-percent * sizes // (100 + percent))


def band(n: int, percent: int) -> int:
    return math.floor(math.log(max(n, 1)) / -math.log(percent / 100) + 1e-9)


@functools.cache
def parts_of(level: int, percent: int) -> int:
    """Parts for pairs whose smaller set is of band ``level``: ``SPARE`` more than it takes to agree on one; 0 if only equal sets link."""
    grow = 100 / percent
    most = math.floor(grow ** (level + 1)) + math.floor(grow ** (level + 2))
    differ = most * (100 - percent) // (100 + percent)
    return differ + 1 + SPARE if differ else 0


def part_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the parts of a set, for pairs with its own band and with the one below.

    Empty parts say nothing. Pairs agree on more than ``SPARE`` parts, so a set with no more empty
    ones than that can do without them; another gives keys for them, too.
    """
    out = []
    own = band(len(shingles), percent)
    mixed = tk.mix(shingles ^ _SEEDS[1])
    for level in (own, own - 1):
        parts = parts_of(level, percent) if level >= 0 else 0
        if not parts:
            continue
        part = (mixed >> np.uint64(32)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        begins = np.flatnonzero(np.concatenate(([True], np.diff(part[order]) > 0)))
        sums = np.add.reduceat(mixed[order], begins)
        full = part[order][begins]
        salt = np.uint64(level) * np.uint64(0xA24BAED4963EE407)
        out.append(tk.mix(sums + full * np.uint64(0x9E3779B97F4A7C15) + salt))
        if parts - len(full) > SPARE:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), full)
            out.append(tk.mix(empty * np.uint64(0x9E3779B97F4A7C15) + salt))
    return np.concatenate(out) if out else shingles[:0]


def bitmap(shingles: np.ndarray) -> bytes:
    """Bitmap of two to four bits a shingle."""
    width = 1 << max(6, math.ceil(math.log2(2 * len(shingles))))
    bits = np.zeros(width, dtype=np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(na: int, nb: int, a: bytes, b: bytes, percent: int) -> bool:
    """Whether the bitmaps leave room for the overlap that the sizes ask for."""
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    most = min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))
    return most >= int(least_overlap(np.int64(na + nb), percent))


def _features(docs: DataFrame, key: str, size: int) -> DataFrame:
    names = [key, "n", "f1", "f2", "minima", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tk.slices(batch.column(1)):
                n, f1, f2, minima, maps = ([] for _ in range(5))
                for own in shingle_sets(piece, size):
                    n.append(len(own))
                    f1.append(tk.mix(own).sum(dtype=np.uint64)), f2.append(tk.mix(own ^ _SEEDS[0]).sum(dtype=np.uint64))
                    if len(own):
                        minima.append(tk.mix(own[None, :] ^ _SEEDS[:, None]).min(axis=1))
                        maps.append(bitmap(own))
                    else:
                        minima.append(own), maps.append(b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, piece.rows), pa.array(n, pa.int64()),
                        pa.array(tk.signed(np.array(f1, np.uint64))), pa.array(tk.signed(np.array(f2, np.uint64))),
                        _lists(minima), pa.array(maps, pa.binary()),
                    ],
                    names,
                )

    kind = docs.schema[key].dataType.simpleString()
    fields = f"`{key}` {kind}, n long, f1 long, f2 long, minima array<long>, bits binary"
    return docs.select(key, "text").mapInArrow(run, fields)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(tk.signed(np.concatenate(parts).astype(np.uint64))))


def _bounded(reps: DataFrame, pairs: DataFrame, key: str, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps allow."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, xa, xb = (batch.column(i).to_pylist() for i in range(2, 6))
            hit = [may_link(*row, percent) for row in zip(na, nb, xa, xb)]
            yield batch.select([0, 1]).filter(pa.array(hit, pa.bool_()))

    slim = reps.select(key, "n", "bits")
    left = slim.select(F.col(key).alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    right = slim.select(F.col(key).alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
    close = pairs.join(left, "a").join(right, "b").where(f"100 * na >= {percent} * nb AND 100 * nb >= {percent} * na")
    return close.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(bound, "a long, b long")


def _linked(docs: DataFrame, close: DataFrame, key: str, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets link, by their texts."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 64):
                part = batch.slice(first, 64)
                sides = [[s for piece in tk.slices(part.column(i)) for s in shingle_sets(piece, size)] for i in (2, 3)]
                common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)])
                sizes = np.array([len(x) + len(y) for x, y in zip(*sides)])
                yield part.select([0, 1]).filter(pa.array(common >= np.maximum(least_overlap(sizes, percent), 1)))

    close = durable(close)
    named = close.select(F.explode(F.array("a", "b")).alias(key))
    texts = spread.only_listed(docs.sparkSession, docs, key, "text", named)
    with_a = close.join(texts.select(F.col(key).alias("a"), F.col("text").alias("ta")), "a")
    both = with_a.join(texts.select(F.col(key).alias("b"), F.col("text").alias("tb")), "b")
    return durable(both.select("a", "b", "ta", "tb").mapInArrow(exact, "a long, b long").distinct())


def _part_blocks(size: int, percent: int, ranges: int):
    """Blocks of (part key, document, component) of (document, component, text) batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            doc, comp = (batch.column(i).to_numpy() for i in range(2))
            for piece in tk.slices(batch.column(2)):
                for i, own in enumerate(shingle_sets(piece, size), piece.first):
                    keys = part_keys(own, percent)
                    held.append((keys, np.full(len(keys), doc[i]), np.full(len(keys), comp[i])))
                    count += len(keys)
                    if count > spread.FLUSH:
                        yield from _flush_parts(held, ranges)
                        held, count = [], 0
        if count:
            yield from _flush_parts(held, ranges)

    return run


def _flush_parts(held: list[tuple[np.ndarray, ...]], ranges: int) -> Iterator[pa.RecordBatch]:
    keys, doc, comp = (np.concatenate(c) for c in zip(*held))
    yield from spread.pack(keys, [(keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), doc, comp], ranges)


def _tile_members(group: pa.Table) -> pa.Table:
    """(tile, members, place, document, component) of every tile that spans components."""
    low, doc, comp = spread.unpack(group, [np.uint32, np.int64, np.int64])
    order = np.lexsort((doc, low))
    low, doc, comp = low[order], doc[order], comp[order]
    begins = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1]))) if len(low) else np.zeros(0, np.int64)
    if not len(begins):
        begins, sizes, spans = begins, begins, np.zeros(0, bool)
    else:
        sizes = np.diff(np.append(begins, len(low)))
        spans = np.minimum.reduceat(comp, begins) != np.maximum.reduceat(comp, begins)
    keep = np.repeat(spans, sizes)
    place = np.arange(len(low)) - np.repeat(begins, sizes)
    tile = np.int64(group.column("range")[0].as_py()) << np.int64(32) | low.astype(np.int64)
    columns = (tile, np.repeat(sizes, sizes), place, doc, comp)
    return pa.table({n: pa.array(c[keep].astype(np.int64)) for n, c in zip(("tile", "members", "place", "doc", "comp"), columns)})


def _folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of one width, the smallest among them."""
    width = min(map(len, maps)) // 8
    return np.stack([np.bitwise_or.reduce(np.frombuffer(m, dtype=np.uint64).reshape(-1, width), axis=0) for m in maps])


def _compare(percent: int, forest: bool, step: int = 128):
    """Pairs of a bucket's tiles whose sizes and bitmaps allow a link, in different components.

    With ``forest``, each document has only the earlier one that it most likely links with.
    """

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        tile, left, right, doc, comp, n = (group.column(c).to_numpy() for c in ("tile", "left", "right", "doc", "comp", "n"))
        block, maps = group.column("block").to_numpy(), group.column("bits").to_pylist()
        order = np.lexsort((doc, block, right, left, tile))
        edge = [c[order] for c in (tile, left, right)]
        new = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in edge], axis=0))) if len(order) else np.zeros(0, bool)
        begins = np.append(np.flatnonzero(new), len(order))
        found: list[np.ndarray] = []
        for a, b in zip(begins[:-1], begins[1:]):
            own = order[a:b]
            bits = _folded([maps[i] for i in own])
            across = left[own[0]] != right[own[0]]
            first = np.flatnonzero(block[own] == left[own[0]]) if across else np.arange(len(own))
            second = np.flatnonzero(block[own] == right[own[0]]) if across else first
            for i in range(0, len(first), step):
                x = first[i : i + step]
                for j in range(0 if across else i, len(second), step):
                    y = second[j : j + step]
                    nx, ny = n[own[x]][:, None], n[own[y]][None, :]
                    ok = (comp[own[x]][:, None] != comp[own[y]]) & (100 * nx >= percent * ny) & (100 * ny >= percent * nx)
                    if not across:
                        ok &= x[:, None] < y
                    p, q = np.nonzero(ok)
                    if not len(p):
                        continue
                    u, v = bits[x[p]], bits[y[q]]
                    nu, nv = n[own[x[p]]], n[own[y[q]]]
                    most = np.minimum(nu - np.bitwise_count(u & ~v).sum(axis=1), nv - np.bitwise_count(v & ~u).sum(axis=1))
                    need = least_overlap(nu + nv, percent)
                    hit = np.flatnonzero(most >= need)
                    if forest and len(hit):
                        ranked = hit[np.lexsort((-(most - need)[hit] * 1000 // need[hit], q[hit]))]
                        hit = ranked[np.concatenate(([True], q[ranked][1:] != q[ranked][:-1]))]
                    found.append(np.stack((doc[own[x[p[hit]]]], doc[own[y[q[hit]]]]), axis=1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        return pa.table({"a": pa.array(np.ascontiguousarray(pairs[:, 0])), "b": pa.array(np.ascontiguousarray(pairs[:, 1]))})

    return run


def _tile_pairs(members: DataFrame, slim: DataFrame, percent: int, forest: bool) -> DataFrame:
    """(a, b): pairs of the tiles' documents, compared by bitmaps in buckets of tiles and tile blocks."""
    members = durable(members)
    cuts = F.ceil(F.col("members") / TILE)
    other = F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1)).alias("other")
    dealt = members.withColumn("block", F.pmod("place", cuts)).select("*", other)
    dealt = dealt.select("tile", "doc", "comp", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    buckets = max(1, members.count() // 40_000)
    bucket = F.pmod(F.xxhash64("tile", "left", "right"), F.lit(buckets)).alias("bucket")
    held = dealt.join(slim, "doc").select("*", bucket)
    return held.groupBy("bucket").applyInArrow(_compare(percent, forest), "a long, b long").distinct()


def join(docs: DataFrame, size: int = 3, percent: int = 90, key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id) for every row of ``docs``; ``key`` is a long."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias(key), "text")
    features = durable(_features(docs, key, size))
    same = ["n", "f1", "f2"]
    classes = durable(features.where("n > 0").groupBy(*same).agg(F.min(key).alias("rep"), F.count("*").alias("members")))
    leads = classes.where("rep IS NOT NULL").select(F.col("rep").alias(key), *same)
    spread.release(docs.sparkSession)
    reps = features.join(leads, [key, *same], "left_semi").dropDuplicates([key, *same])

    tiles = durable(reps.select(key, F.posexplode("minima").alias("k", "m")))
    hub = tiles.groupBy("k", "m").agg(F.min(key).alias("hub"), F.max(key).alias("last")).where("hub < last").drop("last")
    stars = tiles.join(hub, ["k", "m"]).where(f"{key} <> hub").select(F.col("hub").alias("a"), F.col(key).alias("b")).distinct()
    first = _linked(docs, _bounded(reps, stars, key, percent), key, size, percent)
    grouped = spread.components(first)

    spread.release(docs.sparkSession)
    named = leads.select(key).distinct().join(grouped.withColumnRenamed("node", key), key, "left")
    named = named.select(key, F.coalesce("component", key).alias("comp"))
    source = docs.join(named, key).select(key, "comp", "text")
    share = 2 * (100 / percent) ** 2 * (100 - percent) / (100 + percent)  # keys for each shingle, nearly
    records = (leads.agg(F.sum("n")).first()[0] or 0) * share
    blocks = source.mapInArrow(_part_blocks(size, percent, spread.ranges_for(records)), spread.BLOCKS)
    members = durable(spread.by_range(blocks, _tile_members, "tile long, members long, place long, doc long, comp long"))
    spread.release(docs.sparkSession)
    slim = reps.select(F.col(key).alias("doc"), "n", "bits")
    # the likeliest link of each document first: what they tie together needs no other pair
    likely = _linked(docs, _tile_pairs(members, slim, percent, forest=True), key, size, percent)
    grouped = durable(spread.merged_components(grouped, likely))
    spread.release(docs.sparkSession)
    members = members.join(grouped.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("component", "comp")).drop("component")
    spans = members.groupBy("tile").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("tile")
    others = _tile_pairs(members.join(spans, "tile", "left_semi"), slim, percent, forest=False)
    second = _linked(docs, others, key, size, percent)
    merged = spread.merged_components(grouped, second).withColumnRenamed("node", "rep")
    spread.release(docs.sparkSession)
    groups = durable(classes.join(merged, "rep", "left"))
    large = groups.where(F.col("members") > LARGE)  # at most a row for each ``LARGE`` documents
    placed = features.select(key, *same)
    if large.count() <= LARGE_CLASSES:
        # documents of large classes find theirs without a shuffle and are dealt by their own ids after that
        held = F.broadcast(large.select(*same, F.coalesce("component", "rep").alias("large")))
        placed = placed.join(held, same, "left")
    else:
        placed = placed.withColumn("large", F.lit(None).cast("long"))
    own = F.when(F.col("large").isNull(), F.col("f1")).otherwise(F.xxhash64(key))
    other = groups.select("n", F.col("f1").alias("deal"), "f1", "f2", F.coalesce("component", "rep").alias("small"))
    placed = placed.withColumn("deal", own).join(other, ["n", "deal", "f1", "f2"], "left")
    return placed.select(key, F.col("n").alias("n_shingles"), F.coalesce("large", "small", key).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The document with the smallest id of every component, and rows with a null id; columns as they came."""
    groups = join(docs, key=key, **options).groupBy(key).agg(F.min("component_id").alias("component_id"))
    stay = groups.where(F.col("component_id") == F.col(key)).select(key)
    return docs.join(stay, key, "left_semi").unionByName(docs.where(F.col(key).isNull())).select(*docs.columns)
