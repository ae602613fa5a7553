"""Cross-entropy difference of two matched n-gram models (Moore and Lewis, 2010).

The target model is counted on the documents that ``target`` marks, the background model on
all documents. Both share one vocabulary and the same smoothing, so their per-token losses
can be subtracted. A document is scored by the others: its own counts (those of all rows of its key) are
taken out of both models first, so its difference does not tell whether it was on the list.

The models are matched in size without sampling. With ``f`` the target's tokens over the background's, a pair
that the background holds ``c`` times would be met in a share ``f`` of it with probability ``1 - (1 - f)**c``;
its share counts by that much, and unigram counts are multiplied by ``f``. All documents are still counted. Words and word pairs are told apart by 64-bit hashes and counted exactly:
the tables grow with the corpus and are never in one place.

Documents are dealt, compressed, into chunks of about ``CHUNK`` bytes by their key. A chunk sends each of
its different n-grams once, with its own counts, as blocks by key range. A range adds up the
counts of all chunks and answers every block in its order; a chunk then scores its documents
with the answers. A common n-gram is thus one record a chunk, however often it occurs.

Words that no other document holds leave the vocabulary for one symbol of the rest: both models give them
the rate at which their own documents use words that occur once in the corpus, shared by those words.

A bigram's probability is interpolated: ``MIX`` times its share among the pairs of its first
word and the rest from smoothed unigrams, whose vocabulary has as many entries as there are
different words, ``2**UNI`` at least. A text begins with a start mark.

Defined cases: null or empty text has no tokens and NULL losses; rows without a key are documents of their own; a document that several
label rows name is a target if any says so; without targets both models are the background;
repeated rows count as often as they occur; further columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from lotweave.llm import spread
from lotweave.llm import textkit as tk
from lotweave.session import durable, ship_package

UNI = 16
MIX, SMOOTH = 0.7, 0.5
CHUNK = 8 << 20
RECORDS = 1 << 21  # of a range
_START = np.uint64(0x57A27)
_TOTALS = ["words", "target", "background", "target_once", "background_once"]
_ASKED = [np.int64, np.uint8, *[np.uint32] * 4]  # keys in order: their differences are packed


def slots(piece: tk.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key of each token, of the token before it, of the pair, and the tokens before each row."""
    data = tk.LOWER[piece.data]
    starts, ends, bounds = tk.word_spans(data, piece.offsets)
    words = tk.word_hashes(data, starts, ends)
    before = np.empty_like(words)
    if len(words):
        before[1:] = words[:-1]
        before[bounds[:-1][np.diff(bounds) > 0]] = _START
    pair = tk.mix(before * np.uint64(0xA24BAED4963EE407) + words)
    return words, before, pair, bounds


def _dealt(docs: DataFrame) -> DataFrame:
    """(chunk, rows): the rows of each batch that fall to a chunk, as compressed Arrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))
        for batch in batches:
            chunk = batch.column(0).to_numpy()
            order = np.argsort(chunk, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1) if len(order) else ():
                sink = pa.BufferOutputStream()
                rows = batch.select([1, 2]).take(pa.array(own))
                with pa.ipc.new_stream(sink, rows.schema, options=options) as stream:
                    stream.write_batch(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk[own[0]]], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"]
                )

    return docs.mapInArrow(run, "chunk long, rows binary")


def _rows(group: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in group.column("rows")])


def _grams(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each row, the different keys in order, and the place of every token, token before and pair among them."""
    pieces = [slots(piece) for piece in tk.slices(texts)]
    sizes = np.concatenate([np.diff(p[3]) for p in pieces])
    keys, place = np.unique(np.concatenate([p[k] for k in range(3) for p in pieces]), return_inverse=True)
    return sizes, keys, place.reshape(3, -1)


def count(docs: DataFrame, marked: DataFrame, key: str, ranges: int) -> DataFrame:
    """(chunk, range, records, block, and ``_TOTALS``): the summed counts of each chunk's n-grams, in its order.

    Counts are those of a token or pair in the target and in all, and those of a word as the first of a pair. The totals, over all rows, are the number of different words, of tokens in the two models, and of those whose word occurs once.
    """

    def ask(group: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        if len(group):
            rows = _rows(group)
            wanted = pc.is_in(rows.column(key), value_set=marks.column(key).combine_chunks()).to_numpy()
            sizes, keys, place = _grams(rows.column("text"))
            inside = np.repeat(wanted, sizes)
            token, first, pair = ([np.bincount(p[k], minlength=len(keys)) for k in (inside, slice(None))] for p in place)
            counts = [c.astype(np.uint32) for c in (token[0] + pair[0], token[1] + pair[1], *first)]
            kind = np.zeros(len(keys), dtype=np.uint8)
            kind[place[0]] = 1
            chunk = group.column("chunk")[0].as_py()
            for block in spread.pack(keys, [tk.signed(keys), kind, *counts], ranges):
                out.append(pa.RecordBatch.from_arrays([pa.array([chunk]), *block.columns], ["chunk", *block.schema.names]))
        return pa.Table.from_batches(out, asked)

    def answer(group: pa.Table) -> pa.Table:
        keys, kind, *counts = spread.unpack(group, _ASKED)
        different, place = np.unique(keys, return_inverse=True)
        word = np.zeros(len(different), dtype=bool)
        word[place[kind == 1]] = True
        sums = [np.bincount(place, weights=c).astype(np.uint64) for c in counts]
        once = word & (sums[1] == 1)
        totals = [int(word.sum()), *(int(s[k].sum()) for k in (word, once) for s in sums[:2])]
        cuts = np.concatenate(([0], np.cumsum(group.column("records").to_numpy())))
        out = []
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            own = place[a:b]
            (block,) = spread.pack(np.zeros(len(own), np.uint64), [s[own] for s in sums], 1)
            out.append(block.column(2)[0].as_py())
        first = lambda v: pa.array([v, *[0] * (len(out) - 1)], pa.int64())
        return pa.table(
            [*(group.column(n) for n in ("chunk", "range", "records")), pa.array(out, pa.binary()), *map(first, totals)],
            ["chunk", "range", "records", "block", *_TOTALS],
        )

    asked = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("records", pa.int64()), ("block", pa.binary())])
    blocks = docs.groupBy("chunk").cogroup(marked.groupBy("chunk")).applyInArrow(ask, f"chunk long, {spread.BLOCKS}")
    return spread.by_range(blocks, answer, f"chunk long, {spread.BLOCKS}, " + ", ".join(f"{n} long" for n in _TOTALS))


def losses(token: np.ndarray, first: np.ndarray, pair: np.ndarray, total: np.ndarray, words: int, part: np.ndarray) -> np.ndarray:
    """Loss of every token by a model of ``total`` tokens, seen as a share ``part`` of it; ``token`` is smoothed."""
    share = np.minimum(pair / np.maximum(first, 1.0), 1.0) * (1 - (1 - part) ** pair)
    return -np.log(MIX * share + (1 - MIX) * token / (part * total + SMOOTH * max(words, 1 << UNI)))


def _documents(keys: pa.ChunkedArray) -> np.ndarray:
    """Number of the document of each row."""
    code = keys.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    alone = np.isnan(code) if code.dtype.kind == "f" else np.zeros(len(code), dtype=bool)
    return np.where(alone, len(code) + np.arange(len(code)), np.nan_to_num(code)).astype(np.int64)


def _within(document: np.ndarray, place: np.ndarray, keys: int) -> np.ndarray:
    """How often the n-gram of each token occurs in the token's document."""
    _, back, counts = np.unique(document * max(keys, 1) + place, return_inverse=True, return_counts=True)
    return counts[back].astype(np.float64)


def score(docs: DataFrame, target: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, target_loss, background_loss, difference) for every row; ``target`` lists the keys of target documents."""
    ship_package(docs.sparkSession)
    total = spread.text_bytes(docs)
    chunks = total // CHUNK + 1
    # rows of one key share a chunk, where the marks meet them; rows without a key are dealt by text
    deal = lambda *of: F.pmod(F.xxhash64(*of), F.lit(chunks)).alias("chunk")
    dealt = _dealt(docs.select(deal(F.col(key), F.when(F.col(key).isNull(), F.col("text"))), key, "text"))
    marked = target.select(F.col(key).cast(docs.schema[key].dataType).alias(key)).dropna().distinct().select(deal(F.col(key)), key)
    # a text of random words has a different n-gram every six bytes
    counted = durable(count(dealt, marked, key, max(1, -(-total // (6 * RECORDS)))))
    words, *tokens = (v or 0 for v in counted.agg(*map(F.sum, _TOTALS)).first())

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(group):  # marks without documents
            return to_arrow_schema(schema).empty_table()
        rows = _rows(group)
        sizes, keys, place = _grams(rows.column("text"))
        marks = answers.column("_marked").combine_chunks().drop_null()
        listed = pc.is_in(rows.column(key), value_set=marks).to_numpy() if len(marks) else np.zeros(len(sizes), dtype=bool)
        answers = answers.filter(pc.is_valid(answers.column("records"))).sort_by("range")
        counts = spread.unpack(answers, [np.uint64] * 4) if len(answers) else [np.zeros(0, np.uint64)] * 4
        if len(counts[0]) != len(keys):
            raise ValueError(f"{len(counts[0])} answers for {len(keys)} n-grams")
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        document = _documents(rows.column(key))
        spot = np.repeat(document, sizes)
        within = [_within(spot, p, len(keys)) for p in place]
        own = np.bincount(document, weights=sizes)[document] if len(sizes) else np.zeros(0)
        rest = [tokens[0] - own * listed, tokens[1] - own]  # of each row's models
        part = rest[0] / np.maximum(rest[1], 1) if tokens[0] else np.ones(len(sizes))
        everywhere = counts[1][place[0]].astype(np.float64)
        alone = everywhere == within[0]
        own_once = np.bincount(document, weights=tk.per_row(everywhere == 1, offsets))[document] if len(sizes) else np.zeros(0)
        once = [tokens[2] - own_once * listed, tokens[3] - own_once]
        mean = []
        for which in (0, 1) if tokens[0] else (1, 1):
            mine = np.repeat(listed, sizes) if which == 0 else 1
            held, first = (counts[k].astype(np.float64) for k in (which, which + 2))
            token, lead, pair = (table[p] - mine * w for table, p, w in zip((held, first, held), place, within))
            seen_as = np.repeat(part, sizes) if which else 1.0
            rate = part if which else (once[0] + SMOOTH) / (once[1] + SMOOTH / np.maximum(part, 1e-9))
            token = np.where(alone, np.repeat(np.maximum(rate, 1e-9), sizes), seen_as * token + SMOOTH)
            sums = tk.per_row(losses(token, lead, pair, np.repeat(rest[which], sizes), words, seen_as), offsets)
            mean.append(sums / np.maximum(sizes, 1))
        none = sizes == 0
        return pa.table(
            [rows.column(key), pa.array(sizes.astype(np.int64)), *(pa.array(m, mask=none) for m in (*mean, mean[0] - mean[1]))], names
        )

    names = [key, "n_tokens", "target_loss", "background_loss", "difference"]
    schema = StructType([StructField(key, docs.schema[key].dataType), StructField("n_tokens", LongType()), *(StructField(n, DoubleType()) for n in names[2:])])
    told = counted.unionByName(marked.select("chunk", F.col(key).alias("_marked")), allowMissingColumns=True)
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)
