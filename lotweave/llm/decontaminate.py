"""Benchmark decontamination by canonical templates.

Both sides are cut into words, freed of punctuation at their ends and lower-cased (ASCII and
Latin-1). Numbers, names (one capital at the front, inside a sentence) and units (behind a number) become typed placeholders, so a
question with other numbers or names keeps its template. Windows of ``WINDOW`` template words
are hashed and joined. A window counts only if half of it or more is literal.

Matched windows at the same distance between document and item form an alignment. It is
consistent if each value behind the item's placeholders always meets the same value of the
document; windows of inconsistent alignments are not counted. A document is contaminated by
an item if it holds at least ``share`` of the item's windows.

Documents meet the benchmark first in a bitmap of fixed size, which misses nothing; only windows
that pass are joined with the benchmark's, so the join sees what may match, and a benchmark
of any size works. An item of 3 to 7 words is one window of its own length.

Defined cases: null or empty texts match nothing; items of fewer than 3 words, or mostly of
placeholders, are never found; repeated items are reported each; rows with a repeated document
id are judged together; an empty benchmark or table gives no rows; further columns are not
carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotweave.llm import textkit as tk
from lotweave.llm.spread import slot_bitmap
from lotweave.session import durable, ship_package

WINDOW = 8
BITS = 24
#: Units of measurement, in lower case (fixed values).
UNITS = (
    "%", "$", "€", "a", "b", "c", "cm", "day", "days", "degree", "degrees", "dollar", "dollars", "euro", "euros", "f",
    "feet", "foot", "ft", "g", "gb", "gram", "grams", "h", "hour", "hours", "hz", "inch", "inches", "j", "kb", "kg",
    "kilogram", "kilograms", "kilometer", "kilometers", "km", "kmh", "kw", "kwh", "l", "lb", "lbs", "liter", "liters",
    "m", "mb", "meter", "meters", "mg", "mile", "miles", "min", "minute", "minutes", "ml", "mm", "month", "months", "mph",
    "ms", "mw", "ounce", "ounces", "oz", "percent", "pound", "pounds", "s", "second", "seconds", "tb", "ton", "tons", "v",
    "w", "week", "weeks", "yard", "yards", "year", "years",
)
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0xA11CE0001, 0xA11CE0002, 0xA11CE0003))


def _hash_texts(texts: tuple[str, ...]) -> np.ndarray:
    piece = next(tk.slices(pa.array(texts)))
    starts, ends, _ = tk.word_spans(piece.data, piece.offsets)
    return np.sort(tk.word_hashes(piece.data, starts, ends))


_UNIT_HASHES = _hash_texts(UNITS)
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".!?:"]] = True


def templates(piece: tk.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template word and value of every word, and the words before each row; a literal's value is 0."""
    data = piece.data
    starts, ends, bounds = tk.word_spans(data, piece.offsets)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, bounds
    first = np.zeros(len(starts), dtype=bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    broken = np.concatenate(([0], np.cumsum(data == 10)))
    opens = first.copy()
    opens[1:] |= _STOPS[data[ends[:-1] - 1]] | (broken[starts[1:]] > broken[ends[:-1]])
    low, high = tk.strip_edges(data, starts, ends)
    alive = low < high
    upto = np.concatenate(([0], np.cumsum(alive)))
    starts, ends, opens, bounds = low[alive], high[alive], opens[alive], upto[bounds]
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, bounds
    small = tk.lower(data)
    words = tk.word_hashes(small, starts, ends)
    number = (data[starts] >= 48) & (data[starts] <= 57)
    changed = np.concatenate(([0], np.cumsum(small != data)))
    inner = starts + np.where(data[starts] >= 0xC0, 2, 1)  # behind the first letter
    inner = np.minimum(inner, ends)
    capital = (changed[inner] > changed[starts]) & (changed[ends] == changed[inner]) & (ends > inner)
    after_number = np.concatenate(([False], number[:-1]))
    place = np.minimum(np.searchsorted(_UNIT_HASHES, words), len(_UNIT_HASHES) - 1)
    unit = after_number & (_UNIT_HASHES[place] == words) & ~number
    name = capital & ~opens & ~unit
    template = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, words)))
    return template, np.where(number | unit | name, words, np.uint64(0)), bounds


def windows(piece: tk.Slice, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position in row, hash, values of the window's words) of the windows that are literal enough."""
    template, value, bounds = templates(piece)
    inside = tk.row_windows(bounds, size)
    if not inside.any():
        return
    literal = np.concatenate(([0], np.cumsum(value == 0)))
    n = len(inside)
    at = np.flatnonzero(inside & (2 * (literal[size : size + n] - literal[:n]) >= size))
    row = np.searchsorted(bounds, at, side="right") - 1
    yield row, at - bounds[row], tk.window_hashes(template, size)[at], value[at[:, None] + np.arange(size)]


def _rows(key: str, sizes: list[int], kept=None, whole: bool = False):
    """Windows of (key, text) batches; ``kept`` filters by hash, ``whole`` keeps rows of exactly a short size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tk.slices(batch.column(1)):
                ids = batch.column(0).slice(piece.first, piece.rows)
                length = np.diff(templates(piece)[2]) if whole else None
                for size in sizes:
                    for row, position, key_hash, values in windows(piece, size):
                        hit = np.ones(len(row), bool) if kept is None else kept.value.holds(key_hash)
                        if whole and size < WINDOW:
                            hit &= length[row] == size
                        at = np.flatnonzero(hit)
                        flat = pa.array(tk.signed(np.ascontiguousarray(values[at])).ravel())
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * size), flat)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(row[at])), pa.array(position[at].astype(np.int64)), pa.array(tk.signed(key_hash[at])), lists],
                            [key, "position", "hash", "values"],
                        )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.5, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """(key, item, matched, item_windows, coverage): every document with every item it contains."""
    spark = docs.sparkSession
    ship_package(spark)
    key_kind = docs.schema[key].dataType.simpleString()
    fields = "position long, hash long, values array<long>"
    named = benchmark.select(F.col(item).alias("item"), F.xxhash64("text").alias("variant"), "text")
    once = named.select("variant", "text").dropDuplicates(["variant"])
    probes = durable(once.mapInArrow(_rows("variant", list(range(3, WINDOW + 1)), whole=True), f"variant long, {fields}"))
    sizes = [r.n for r in probes.select(F.size("values").alias("n")).distinct().collect()]
    kept = spark.sparkContext.broadcast(slot_bitmap(probes, "hash", BITS))
    found = docs.select(key, "text").mapInArrow(_rows(key, sorted(sizes), kept), f"`{key}` {key_kind}, {fields}")

    col = F.col
    pairs = found.alias("d").join(probes.alias("b"), "hash").select(
        col(f"d.{key}"), col("b.variant"), col("b.position").alias("spot"), (col("d.position") - col("b.position")).alias("shift"),
        F.filter(F.arrays_zip(col("b.values").alias("theirs"), col("d.values").alias("ours")), lambda v: v["theirs"] != 0).alias("filled"),
    )
    # one value of the item against two of the document, within an alignment
    alignment = [key, "variant", "shift"]
    facing = pairs.where(F.size("filled") > 0).select(*alignment, F.inline("filled"))
    extremes = facing.groupBy(*alignment, "theirs").agg(F.min("ours").alias("low"), F.max("ours").alias("high"))
    torn = extremes.where("low <> high").select(*alignment).distinct()
    sound = pairs.join(torn, alignment, "left_anti")
    matched = sound.groupBy(key, "variant").agg(F.countDistinct("spot").alias("matched"))
    totals = probes.groupBy("variant").agg(F.countDistinct("position").alias("item_windows"))
    judged = matched.join(totals, "variant").where(col("matched") >= share * col("item_windows"))
    judged = judged.withColumn("coverage", F.round(col("matched") / col("item_windows"), 4))
    by_item = judged.join(named.select("item", "variant").distinct(), "variant").groupBy(key, col("item").alias(item))
    return by_item.agg(F.max(F.struct("coverage", "matched", "item_windows")).alias("x")).select(
        key, item, "x.matched", "x.item_windows", "x.coverage"
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Documents that no item contaminates, with their columns."""
    return docs.join(contaminated(docs, benchmark, key=key, **options).select(key).distinct(), key, "left_anti").select(*docs.columns)
