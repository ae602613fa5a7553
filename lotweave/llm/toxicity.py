"""Toxicity by class-conditional Kneser-Ney models of word spellings.

A word is spelt from its start: each step goes from a prefix to the next longer one and at last to
the word's end; after ``DEPTH`` characters one step takes all the rest of the word. Both classes discount their own counts and give
the mass to one shared backoff, the step's share in the pooled counts, so that a spelling seen
once or never in a class says nothing, while a frequent stem counts in every compound of it. Steps whose toxic count lies
within ``SURE`` standard deviations of its expectation, or whose log-ratio is below ``TELLING``,
are left out: over a long text they only add up to its subject or language. A document's log-likelihood ratio is the sum over the steps of its different words; the score is a logistic function of
the ratio divided by their number and by its square root.

Fitting uses every labelled row outside the held-out third, and everything else covers all rows. Each task adds up its own
steps before the shuffle. The logistic part sees ratios from models fitted on the other half of the labelled rows; its sums are
taken by Spark, a job a step of Newton's method. All steps with evidence are broadcast, 20 bytes each: they grow with
the vocabulary, not with the rows.

Defined cases: null or empty text has ratio 0 and the score of the intercept; repeated label
rows count once, toxic if any says so; null labels are no labels; with one class missing, every
score is that of the prior; rows with a null id are scored and not held out; further columns
of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotweave.llm import textkit as tk
from lotweave.session import durable, ship_package

DEPTH = 10
HELD = 1 << 20  # steps that a task adds up before it hands them on
LABELS = 1 << 22  # labelled rows that are sent to the texts; more are met by a shuffle
DISCOUNT = 0.75
SURE = 4.0
TELLING = 0.7


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def spelling_steps(piece: tk.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(prefix hash, hash of the prefix before, row) of every step, and the different words of each row.

    A word counts once a row, so repeated lines add nothing. Letters A-Z are lower-cased and ASCII punctuation at a word's ends does not belong to it.
    """
    data, offsets = tk.LOWER[piece.data], piece.offsets
    starts, ends, bounds = tk.word_spans(data, offsets)
    row = np.repeat(np.arange(piece.rows), np.diff(bounds))
    starts, ends = tk.strip_edges(data, starts, ends)
    alive = starts < ends
    starts, ends, row = starts[alive], ends[alive], row[alive]
    spelt = tk.mix(tk.word_hashes(data, starts, ends) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    once = np.sort(np.unique(spelt, return_index=True)[1])
    starts, ends, row = starts[once], ends[once], row[once]
    words = np.bincount(row, minlength=piece.rows)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, np.zeros(0, np.int64), words
    lead = np.concatenate(((data & 0xC0) != 0x80, [True]))
    jump = np.flatnonzero(lead)  # where characters begin
    nth = np.cumsum(lead) - 1
    out, before, rows = [], [], []
    origin = 0
    while origin < len(starts):
        base = starts[origin]
        upto = max(origin + 1, int(np.searchsorted(ends, base + tk.PIECE, side="right")))
        sums = tk.prefix_sums(data[base : ends[upto - 1]])
        s, e, r = starts[origin:upto], ends[origin:upto], row[origin:upto]
        last = np.full(len(s), 0x5EED, dtype=np.uint64)
        for k in range(1, DEPTH + 1):
            cut = jump[np.minimum(nth[s] + k, len(jump) - 1)]
            on = (nth[s] + k < len(jump)) & (cut <= e)
            s, e, r, last, cut = s[on], e[on], r[on], last[on], cut[on]
            if not len(s):
                break
            here = tk.span_hashes(sums, s - base, cut - base)
            out.append(here), before.append(last), rows.append(r)
            done = cut == e
            out.append(here[done] ^ np.uint64(0xE0D)), before.append(here[done]), rows.append(r[done])
            last = here
        if len(s):  # longer words: from the prefix to the whole word
            long = cut < e
            whole = tk.span_hashes(sums, s[long] - base, e[long] - base)
            out.append(whole ^ np.uint64(0xE0D)), before.append(last[long]), rows.append(r[long])
        origin = upto
    return np.concatenate(out), np.concatenate(before), np.concatenate(rows), words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        toxic, fold = (batch.column(i).to_numpy() for i in (1, 2))
        for piece in tk.slices(batch.column(0)):
            step, before, row, _ = spelling_steps(piece)
            kind = 2 * fold[row + piece.first] + toxic[row + piece.first]
            held.append(_added_up(step, before, (kind == np.arange(4)[:, None]).astype(np.int32)))
            size += len(held[-1][0])
            if size > HELD:
                held = [_added_up(*(np.concatenate(part, axis=-1) for part in zip(*held)))]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield _counted(*held.pop())
                    size = 0
    if held:
        yield _counted(*_added_up(*(np.concatenate(part, axis=-1) for part in zip(*held))))


def _added_up(step: np.ndarray, before: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different steps, their prefixes and the sums of their counts ``(4, n)``."""
    if not len(step):
        return step, before, counts
    order = np.argsort(step)
    ranked = step[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    return ranked[first], before[order[first]], np.add.reduceat(counts[:, order], first, axis=1, dtype=np.int32)


def _counted(step: np.ndarray, before: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(before)  # siblings side by side compress better
    columns = [pa.array(tk.signed(step[order])), pa.array(tk.signed(before[order])), *map(pa.array, counts[:, order])]
    return pa.RecordBatch.from_arrays(columns, ["step", "before", "o0", "t0", "o1", "t1"])


def fit_spellings(train: DataFrame) -> DataFrame:
    """(step, all, half0, half1): the evidence of each step from all rows, and from each half.

    ``train`` has text, toxic (0/1) and fold (0/1).
    """
    kinds = ["o0", "t0", "o1", "t1"]
    parts = train.select("text", "toxic", "fold").mapInArrow(
        _count, "step long, before long, " + ", ".join(f"{k} int" for k in kinds)
    )
    steps = parts.groupBy("step", "before").agg(*(F.sum(k).alias(k) for k in kinds))
    types = [F.count(F.when(F.col(k) > 0, 1)).alias(f"n_{k}") for k in kinds]
    types += [F.count(F.when(F.col(f"{c}0") + F.col(f"{c}1") > 0, 1)).alias(f"n_{c}") for c in "ot"]
    parents = steps.groupBy("before").agg(*types, *(F.sum(k).alias(f"c_{k}") for k in kinds))
    # one or two occurrences never lie SURE deviations from what is expected of them
    joined = steps.where("o0 + t0 + o1 + t1 > 2").join(parents, "before")
    col = F.col

    def evidence(names: dict[str, list[str]], types: dict[str, str]) -> Column:
        own = {c: sum((col(k) for k in ks), F.lit(0)) for c, ks in names.items()}
        total = {c: sum((col(f"c_{k}") for k in ks), F.lit(0)) for c, ks in names.items()}
        shared = (own["t"] + own["o"] + 1e-9) / (total["t"] + total["o"] + 1e-9)

        def p(c: str) -> Column:
            spare = F.when(total[c] > 0, DISCOUNT * col(types[c]) / total[c]).otherwise(1.0)
            held = F.when(total[c] > 0, F.greatest(own[c] - DISCOUNT, F.lit(0.0)) / total[c]).otherwise(0.0)
            return held + spare * shared

        ratio = F.log(p("t")) - F.log(p("o"))
        expected = shared * total["t"]
        sure = F.abs(own["t"] - expected) >= SURE * F.sqrt(expected + 0.25)
        return F.when(sure & (F.abs(ratio) >= TELLING), ratio).otherwise(0.0)

    every = {"t": ["t0", "t1"], "o": ["o0", "o1"]}
    return joined.select(
        "step",
        evidence(every, {"t": "n_t", "o": "n_o"}).alias("all"),
        evidence({"t": ["t0"], "o": ["o0"]}, {"t": "n_t0", "o": "n_o0"}).alias("half0"),
        evidence({"t": ["t1"], "o": ["o1"]}, {"t": "n_t1", "o": "n_o1"}).alias("half1"),
    )


def ratios(piece: tk.Slice, places: tk.Places, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratio of each row by each table ``(tables, steps)``, and its words."""
    step, _, row, words = spelling_steps(piece)
    place = places.find(step)
    hit = np.flatnonzero(place >= 0)
    out = [np.bincount(row[hit], weights=t[place[hit]], minlength=piece.rows) for t in tables]
    return np.array(out, dtype=np.float64), words


def _features(ratio: Column, words: Column) -> list[Column]:
    n = F.greatest(words, F.lit(1))
    return [F.lit(1.0), ratio / n, ratio / F.sqrt(n)]


def _probability(x: list[Column], weights: np.ndarray) -> Column:
    z = sum((float(w) * c for w, c in zip(weights, x)), F.lit(0.0))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def fit_logistic(seen: DataFrame, x: list[Column], penalty: float = 1e-3) -> np.ndarray:
    """Weights of the columns ``x`` for ``toxic`` by Newton's method; the first, of a constant, is not penalised.

    With one class missing it is the prior alone.
    """
    rows, toxic, *spread = seen.agg(
        F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0)), *[F.coalesce(F.stddev_pop(c), F.lit(0.0)) for c in x[1:]]
    ).first()
    if not 0 < toxic < rows:
        prior = (toxic + 0.5) / (rows + 1)
        return np.array([np.log(prior / (1 - prior)), *[0.0] * (len(x) - 1)])
    scale = np.array([1.0, *(max(s, 1e-12) for s in spread)])
    z = [c / float(s) for c, s in zip(x, scale)]
    w = np.zeros(len(x))
    ridge = np.diag([0.0] + [penalty * rows] * (len(x) - 1)) + 1e-9 * np.eye(len(x))
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    for _ in range(50):
        told = seen.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], "toxic", _probability(z, w).alias("p"))
        slopes = [F.sum((F.col("toxic") - F.col("p")) * F.col(f"z{i}")) for i in range(len(x))]
        bends = [F.sum(F.col(f"z{i}") * F.col(f"z{j}") * F.col("p") * (1 - F.col("p"))) for i, j in pairs]
        sums = told.agg(*slopes, *bends).first()
        bend = np.zeros((len(x), len(x)))
        for (i, j), value in zip(pairs, sums[len(x) :]):
            bend[i, j] = bend[j, i] = value
        move = np.linalg.solve(bend + ridge, np.array(sums[: len(x)]) - ridge @ w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w / scale


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", threshold: float = 0.7) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
        .groupBy(key)
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("fold", F.pmod(F.xxhash64(key), F.lit(2)).cast("int"))
    )
    # without the third that is never learnt from, should the texts be shuffled to their labels
    few = chosen.count() <= LABELS
    train = docs.select(key, "text").where(F.col(key).isNotNull() & ~held_out(F.col(key))).join(F.broadcast(chosen) if few else chosen, key)
    weight = F.greatest(F.abs("all"), F.abs("half0"), F.abs("half1"))
    kept = fit_spellings(train).where(weight > 0).toPandas()
    sent = spark.sparkContext.broadcast((kept.step.to_numpy(np.int64), kept[["all", "half0", "half1"]].to_numpy(np.float32).T.copy()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, tables = sent.value
        places = tk.Places(steps)
        for batch in batches:
            for piece in tk.slices(batch.column(1)):
                found, words = ratios(piece, places, tables)
                own = batch.column(0).slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_arrays([own, *map(pa.array, found), pa.array(words)], [key, *names])

    names = ["all", "half0", "half1", "words"]
    kind = docs.schema[key].dataType.simpleString()
    measured = docs.select(key, "text").mapInArrow(measure, f"`{key}` {kind}, all double, half0 double, half1 double, words long")
    measured = durable(measured)
    other = F.when(F.col("fold") == 0, F.col("half1")).otherwise(F.col("half0"))
    seen = durable(measured.join(chosen, key).select("toxic", other.alias("ratio"), "words"))
    weights = fit_logistic(seen, _features(F.col("ratio"), F.col("words")))
    scored = measured.select(key, _probability(_features(F.col("all"), F.col("words")), weights).alias("score"))
    return scored.select(
        key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
