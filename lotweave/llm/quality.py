"""Document quality: counting rules and the perplexity of a modified Kneser-Ney model.

The model is a trigram model per language (Chen and Goodman, 1999). Each character follows the two whole characters before
it, whatever its script. Characters are spelled in ``SYMBOLS`` symbols, so that rare ones share what is known of their block:
those of ``PLAIN`` are a symbol each, others in ``BLOCKS`` two (their block of 64, their place in it), all others four (their
block of 2**18, their place in three steps). A symbol's history is the two characters and what is spelled of its own; it backs off to the symbol
before and then to the symbol alone. No two histories or characters are taken together. Every
language that occurs has a model and a band of its own, rows without one share theirs. Counts
come from every row of the input; a task adds up its own first, so the shuffle holds at most
one row for a trigram, language and task (a task that meets more than ``HELD`` languages or ``ENTRIES`` trigrams
sends what it has and goes on). Models hold the trigrams that occur, 16 bytes each and 16 a history, on the driver and in every worker:
they grow with the variety of the text, not with its length. Trigrams and histories are found by open addressing.

A document's perplexity is compared with its language's band: the median of log-perplexity
less or plus ``width`` times a robust spread. Median and spread are exact over a histogram
of the whole input, in steps of 1/1000.

Defined cases: null text counts as empty; an empty text has perplexity NULL and fails the
base rule; null is a language of its own; repeated rows and
ids are judged row by row; further columns are kept unless their names clash with the
measures, which replace them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotweave.llm import textkit as tk
from lotweave.session import ship_package

HELD = 64  # languages a task counts at a time
ENTRIES = 1 << 20  # trigrams a task holds for them
CHUNK = 1 << 20  # characters spelled at a time
SYMBOLS = 64
POINTS = 0x110000
CLASSES = 1 << 21  # no less than there are characters: the floor of all probabilities, and cubed the bound of codes
PLAIN = " abcdefghijklmnopqrstuvwxyz0123456789#*$%&|<>"
BLOCKS = (0, 1, 2, 3, 4, 5, 14, 15, 16, 17, 23, 24, 25, 128)  # of 64: ASCII, Latin, Greek, Cyrillic, Hebrew, Arabic, punctuation
PAIRS = len(PLAIN)
LONG = PAIRS + len(BLOCKS)
STEP = 1000
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_BLANKS = " \t\n\r\x0b\x0c"


def _first_symbols() -> np.ndarray:
    """First symbol of each character's spelling: itself below ``PAIRS``, one more to come below ``LONG``, else three."""
    first = (LONG + (np.arange(0x110000) >> 18)).astype(np.uint8)
    for i, block in enumerate(BLOCKS):
        first[block << 6 : block + 1 << 6] = PAIRS + i
    first[[ord(c) for c in PLAIN]] = np.arange(PAIRS)
    return first


_FIRST: list[np.ndarray] = []
LEFT = 2 + (SYMBOLS - LONG) * (SYMBOLS + 1)  # at least as many beginnings of a character's spelling, without their last symbol


def _spelled(before: np.ndarray, last: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all symbols of characters that follow ``before`` and ``last``, and symbols a character.

    A code has the history in its upper bits (both characters, and what is spelled of this one without its last symbol), then
    six bits for the symbol before and six for the symbol.
    """
    if not _FIRST:
        _FIRST.append(_first_symbols())
    lead, first = _FIRST[0][last].astype(np.int64), _FIRST[0][points].astype(np.int64)
    more, long = np.flatnonzero(first >= PAIRS), np.flatnonzero(first >= LONG)
    size = np.ones(len(points), dtype=np.int64)
    size[more] = 2
    size[long] = 4
    at = np.cumsum(size) - size
    history = (before.astype(np.int64) * POINTS + last) * LEFT
    codes = np.empty(int(size.sum()), dtype=np.int64)
    codes[at] = history << 12 | np.where(lead < PAIRS, lead, last & 63) << 6 | first
    own = points.astype(np.int64)
    codes[at[more] + 1] = history[more] + 1 << 12 | first[more] << 6 | own[more] & 63
    at, history, block, own = at[long], history[long], first[long] - LONG, own[long]
    two, three = own >> 12 & 63, own >> 6 & 63
    codes[at + 1] = history + 1 << 12 | first[long] << 6 | two
    codes[at + 2] = history + 2 + block * (SYMBOLS + 1) << 12 | two << 6 | three
    codes[at + 3] = history + 3 + block * (SYMBOLS + 1) + two << 12 | three << 6 | own & 63
    return codes, size


def codes_of(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, text of each) of texts with blanks around them, some characters at a time; an empty text has none."""
    held = [(i, t) for i, t in enumerate(texts) if t]
    sizes = np.array([len(t) + 3 for _, t in held], dtype=np.int64)
    if not len(sizes):
        return
    points = np.frombuffer("".join(f"  {t} " for _, t in held).encode("utf-32-le"), dtype=np.int32)
    starts = np.cumsum(sizes) - sizes
    pads = np.zeros(len(points), dtype=bool)
    pads[starts] = pads[starts + 1] = True
    for begin in range(2, len(points), CHUNK):
        at = begin + np.flatnonzero(~pads[begin : begin + CHUNK])
        codes, size = _spelled(points[at - 2], points[at - 1], points[at])
        number = np.array([i for i, _ in held])[np.searchsorted(starts, at, side="right") - 1]
        yield codes, np.repeat(number, size)


def trigram_codes(text: str) -> np.ndarray:
    """Trigrams of the spelled text, with blanks around it; none for an empty text."""
    return np.concatenate([np.zeros(0, np.int64), *(codes for codes, _ in codes_of([text]))])


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(lang, code, n) over the whole input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for piece in tk.slices(batch.column(1)):
                texts = batch.column(1).slice(piece.first, piece.rows).to_pylist()
                for lang, rows in _by_language(langs[piece.first : piece.first + piece.rows]):
                    for codes, _ in codes_of([texts[i] for i in rows]):
                        found = np.unique(codes, return_counts=True)
                        totals[lang] = _added_up(totals[lang], found) if lang in totals else found
                if len(totals) > HELD or sum(len(codes) for codes, _ in totals.values()) > ENTRIES:
                    yield from _counted(totals)
                    totals.clear()
        yield from _counted(totals)

    parts = docs.select("lang", "text").mapInArrow(count, "lang string, code long, n long")
    return parts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _by_language(langs: list[str | None]) -> Iterator[tuple[str | None, list[int]]]:
    rows: dict[str | None, list[int]] = {}
    for i, lang in enumerate(langs):
        rows.setdefault(lang, []).append(i)
    yield from rows.items()


def _added_up(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two lists of different codes in order with their counts."""
    codes, n = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.add.reduceat(n, first)


def _counted(totals: dict[str | None, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for lang, (codes, n) in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n.astype(np.int64))], ["lang", "code", "n"]
        )


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and above, from the counts of counts."""
    n = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    raw = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else (k + 1) / 2 for k in range(3)]
    return np.array([0.0, *(min(max(d, 0.1), k + 0.9) for k, d in enumerate(raw))])


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Log-probabilities of the trigrams that occur, and what others fall back on."""
    v = SYMBOLS

    def level(table: np.ndarray, lower: np.ndarray) -> np.ndarray:
        d = discounts(table[table > 0])
        cut = d[np.minimum(table, 3).astype(np.int64)]
        total = table.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            spare = np.where(total > 0, cut.sum(axis=1, keepdims=True) / total, 1.0)
            own = np.where(total > 0, np.maximum(table - cut, 0) / total, 0.0)
        return own + spare * lower

    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    pairs = np.bincount(codes & v * v - 1, minlength=v * v).reshape(v, v).astype(float)
    single = (pairs > 0).sum(axis=0).astype(float)
    low = level(pairs, level(single.reshape(1, v), np.full((1, v), 1.0 / CLASSES))).ravel()
    past = codes >> 6
    first = np.flatnonzero(np.concatenate((np.ones(min(len(codes), 1), bool), past[1:] != past[:-1])))
    size = np.diff(np.append(first, len(codes)))
    cut = discounts(counts)[np.minimum(counts, 3)]
    total = np.add.reduceat(counts, first) if len(first) else counts
    spare = (np.add.reduceat(cut, first) if len(first) else cut) / total
    own = np.maximum(counts - cut, 0) / np.repeat(total, size) + np.repeat(spare, size) * low[codes & v * v - 1]
    return {"codes": codes, "logp": np.log(own), "past": past[first], "spare": np.log(spare), "low": np.log(low)}


def fit(docs: DataFrame) -> dict[str | None, dict[str, np.ndarray]]:
    """One model for each language with text; the different trigrams of each reach the driver."""
    counted = count_trigrams(docs).toPandas()
    models = {}
    for lang, own in counted.groupby("lang", dropna=False, sort=True):
        models[lang if isinstance(lang, str) else None] = kneser_ney(own.code.to_numpy(np.int64), own.n.to_numpy(np.int64))
    return models


class Directory:
    """Log-probability of codes: of those that occurred, and by the symbol before for others."""

    def __init__(self, model: dict[str, np.ndarray]):
        self.model = model
        self.codes, self.past = tk.Places(model["codes"]), tk.Places(model["past"])

    def look_up(self, codes: np.ndarray) -> np.ndarray:
        place = self.codes.find(codes)
        out = self.model["logp"][place]
        other = np.flatnonzero(place < 0)
        past = self.past.find(codes[other] >> 6)
        out[other] = np.where(past < 0, 0.0, self.model["spare"][past]) + self.model["low"][codes[other] & SYMBOLS * SYMBOLS - 1]
        return out


def base_measures(piece: tk.Slice, texts: list[str | None]) -> list[np.ndarray]:
    """The five counts of each row of a slice."""
    data, offsets = piece.data, piece.offsets
    starts, ends, bounds = tk.word_spans(data, offsets)
    n_words = np.diff(bounds)
    points = tk.per_row(~tk.BLANK[data] & ((data & 0xC0) != 0x80), offsets)
    symbols = tk.per_row(_SYMBOLS[data], offsets)
    lines = np.zeros(piece.rows, dtype=np.int64)
    for i, text in enumerate(texts):
        if text and "\n" in text:
            worded = [x for x in text.split("\n") if x.strip(_BLANKS)]
            lines[i] = len(worded) - len(set(worded))
    repeat = np.zeros(len(starts) + 1, dtype=bool)
    inside = tk.row_windows(bounds, 3)
    if inside.any():
        own = np.repeat(np.arange(piece.rows, dtype=np.uint64), n_words)
        keys = tk.window_hashes(tk.word_hashes(data, starts, ends), 3)[inside]
        at = np.flatnonzero(inside)
        keys = tk.mix(keys + own[at] * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
        hit = at[order[twice]]
        for k in range(3):
            repeat[hit + k] = True
    return [n_words, points, symbols, lines, tk.per_row(repeat[:-1], bounds)]


_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def measure(docs: DataFrame, models: dict[str | None, dict[str, np.ndarray]]) -> DataFrame:
    """Add the base counts, the model's number (NULL where its language has no text) and the log-perplexity per symbol."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(models)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "model", "log_perplexity"]
    docs = docs.drop(*added)
    names = docs.columns
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: i for i, lang in enumerate(sent.value)}
        directories: dict[str | None, Directory] = {}

        def losses(lang: str | None, texts: list[str | None]) -> list[float | None]:
            if lang in number and lang not in directories:
                if len(directories) >= HELD:
                    directories.clear()
                directories[lang] = Directory(sent.value[lang])
            total, symbols = np.zeros(len(texts)), np.zeros(len(texts))
            for codes, text in codes_of(texts):
                total -= np.bincount(text, directories[lang].look_up(codes), len(texts))
                symbols += np.bincount(text, minlength=len(texts))
            return [t / n if n else None for t, n in zip(total.tolist(), symbols.tolist())]

        for batch in batches:
            langs = batch.column(names.index("lang")).to_pylist()
            column = batch.column(names.index("text"))
            for piece in tk.slices(column):
                texts = column.slice(piece.first, piece.rows).to_pylist()
                counts = base_measures(piece, texts)
                own = langs[piece.first : piece.first + piece.rows]
                model = [number.get(lang) for lang in own]
                loss: list[float | None] = [None] * len(own)
                for lang, rows_of in _by_language(own):
                    for i, value in zip(rows_of, losses(lang, [texts[i] for i in rows_of])):
                        loss[i] = value
                rows = batch.slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, *(pa.array(np.asarray(c, np.int64)) for c in counts), pa.array(model, pa.int32()), pa.array(loss, pa.float64())],
                    [*names, *added],
                )

    return docs.mapInArrow(score, f"{shape}, {MEASURES}, model int, log_perplexity double")


def bands(measured: DataFrame, width: float, floor: float) -> dict[int, tuple[float, float]]:
    """Lower and upper log-perplexity of each model, from an exact histogram of bounded size."""
    top = int(20 * STEP)
    bins = (
        measured.where("n_words >= 50")
        .select("model", F.least(F.floor(F.col("log_perplexity") * STEP), F.lit(top)).alias("bin"))
        .groupBy("model", "bin")
        .count()
        .toPandas()
    )
    out = {}
    for model, own in bins.groupby("model"):
        middle = _weighted_median(own.bin.to_numpy(float), own["count"].to_numpy())
        spread = _weighted_median(np.abs(own.bin.to_numpy(float) - middle), own["count"].to_numpy())
        reach = max(width * 1.4826 * spread / STEP, floor)
        out[int(model)] = ((middle + 0.5) / STEP - reach, (middle + 0.5) / STEP + reach)
    return out


def _weighted_median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values)
    upto = np.cumsum(weights[order])
    return float(values[order][np.searchsorted(upto, (upto[-1] + 1) // 2)])


def _by_model(values: dict[int, float]) -> Column:
    if not values:
        return F.lit(None).cast("double")
    table = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*map(F.lit, values.values())))
    return F.element_at(table, F.col("model"))


def judge(
    docs: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    width: float = 8.0,
    floor: float = 0.35,
) -> DataFrame:
    """Add the measures, the language's band, ``base_failed`` and ``kept``."""
    ship_package(docs.sparkSession)
    measured = measure(docs.drop("low", "high", "base_failed", "kept"), fit(docs))
    limits = bands(measured.select("n_words", "model", "log_perplexity"), width, floor)
    low, high = (_by_model({model: band[k] for model, band in limits.items()}) for k in (0, 1))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    judged = measured.withColumns({"low": low, "high": high, "base_failed": failed})
    fits = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & fits)


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """Rows that pass, with the columns they came with, whatever their names."""
    others = [c for c in docs.columns if c not in ("lang", "text")]
    judged = judge(docs.select("lang", "text", F.struct(*others).alias("_others")), **options).where("kept")
    return judged.select(*[F.col(f"_others.`{c}`").alias(c) if c in others else F.col(c) for c in docs.columns])
