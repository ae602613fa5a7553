"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenisations of a text tile the same bytes. In each slice of texts:

1. Token-byte incidence matrices A and B in hand-built CSR. Gustavson row products A·Bᵀ give the
   overlap links: the entry (i, j) is the number of bytes that tokens i and j share.
2. Where the last B token of one row is not the first of the next, tokens of both sides end at
   one byte: there the chain of overlaps is cut into groups.
3. Group-incidence matrices, one row for each id of a document on the A side and one for each
   group on the B side, entries being occurrences. Their row products give the shared-group links of
   every id pair of a document, multiplicities included, without making a row of each occurrence pair.

A pair's count is the number of documents that hold it. A task numbers the distinct pairs of each
chunk of about ``CHUNK`` bytes of text and writes, for every document, its row of the (document, pair)
matrix and, once for each chunk, the chunk's pairs and how many of its documents hold them. So counting
shuffles one row for each pair and chunk; the counts come back to the chunk and are multiplied
into its documents there. Nothing is broadcast, and no group holds more than a chunk.

Defined cases: a null or empty text, or one whose tokens do not spell it, has no tokens and zeros;
every row is a document, repeated ids and rows included; null ids are carried; an empty table
gives no rows; further columns are not carried.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotweave.llm import spread
from lotweave.llm import textkit as tk
from lotweave.session import ensure_checkpoint_dir, ship_package

CHUNK = 4 << 20
EXPAND = 1 << 21


@dataclass
class Csr:
    """Sparse rows: row ``i`` holds ``data`` at columns ``indices``, both from ``indptr[i]`` to ``indptr[i + 1]``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def row_products(left: Csr, right: Csr) -> Csr:
    """``left @ right`` by Gustavson's rows: each entry of a left row adds a multiple of a right row.

    Rows are taken in runs of about ``EXPAND`` products, so memory follows the result.
    """
    begins = right.indptr[left.indices]
    sizes = right.indptr[left.indices + 1] - begins
    upto = np.concatenate(([0], np.cumsum(sizes)))[left.indptr]
    parts = []
    first = 0
    while first < len(upto) - 1:
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + EXPAND, side="right")) - 1)
        own = slice(left.indptr[first], left.indptr[last])
        n = sizes[own]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(begins[own], n) + within
        row = np.repeat(np.arange(first, last), upto[first + 1 : last + 1] - upto[first:last])
        value = np.repeat(left.data[own], n) * right.data[at]
        key = row * right.columns + right.indices[at]
        if np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        if len(key):
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            parts.append((key[new], np.add.reduceat(value, new)))
        first = last
    key, value = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    row, column = np.divmod(key, right.columns) if right.columns else (key, key)
    return Csr(np.searchsorted(row, np.arange(len(left.indptr))), column, value, right.columns)


def token_bytes(lengths: np.ndarray) -> Csr:
    """Incidence of tokens and the bytes they tile."""
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate(([0], ends)), np.arange(n), np.ones(n, np.int64), n)


def bytes_token(lengths: np.ndarray) -> Csr:
    """The transpose of ``token_bytes``: each byte lies in one token."""
    at = np.repeat(np.arange(len(lengths)), lengths)
    return Csr(np.arange(len(at) + 1), at, np.ones(len(at), np.int64), len(lengths))


def incidence(rows: np.ndarray, columns: np.ndarray, n_rows: int, n_columns: int) -> Csr:
    """How often each (row, column) occurs."""
    key, n = np.unique(rows * max(n_columns, 1) + columns, return_counts=True)
    row, column = np.divmod(key, max(n_columns, 1))
    return Csr(np.searchsorted(row, np.arange(n_rows + 1)), column, n.astype(np.int64), n_columns)


def groups_of(overlaps: Csr) -> tuple[np.ndarray, np.ndarray]:
    """Group of every A token and of every B token, numbered along the bytes."""
    last = overlaps.indices[overlaps.indptr[1:] - 1]
    first = overlaps.indices[overlaps.indptr[:-1]]
    of_a = np.concatenate(([0], np.cumsum(last[:-1] != first[1:]))) if len(last) else np.zeros(0, np.int64)
    of_b = np.empty(overlaps.columns, dtype=np.int64)
    of_b[overlaps.indices] = of_a[overlaps.row_of()]
    return of_a, of_b


@dataclass(frozen=True)
class Files:
    """Vocabularies: A as vocabulary file, as rank file and its splitting pattern; B as a piece model."""

    vocabulary: str
    ranks: str
    pattern: str
    pieces: str


class Pair:
    """Both tokenizers, and the bytes of every id.

    The rank file holds A's vocabulary and gives the ids of the vocabulary file in a quarter of the time; special
    tokens are plain text to it.
    """

    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken

        with open(files.ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("byte_bpe", pat_str=files.pattern, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        a_bytes = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            a_bytes[rank] = token
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in names
        ]
        self.a_length = np.array([len(t) for t in a_bytes])
        self.b_length = np.array([len(t) for t in self.b_bytes])
        # decimal ids with each separator: inside a side, after the A side, after the group
        self.a_shown = [f"{i}{s}".encode() for i in range(len(a_bytes)) for s in ",|"]
        self.b_shown = [f"{i}{s}".encode() for i in range(len(names)) for s in ",;"]

    def encode(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where either side does not spell a blank and the text."""
        a_ids, b_ids = [], []
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            a = self.a.encode_ordinary(" " + text) if text else []
            whole = (" " + text).encode() if text else b""
            if not text or self.a.decode_bytes(a) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
                a, b = [], []
            a_ids.append(a)
            b_ids.append(b)
        return a_ids, b_ids


@functools.cache
def tokenizers(files: Files) -> Pair:
    return Pair(files)


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and where each document begins."""
    at = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64)))
    return np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int64, count=int(at[-1])), at


def shown(pair: Pair, a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2`` for every document; ``ends``: tokens of both sides up to each document's end."""
    n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
    a_upto, b_upto = np.cumsum(np.bincount(a_group, minlength=n_groups)), np.cumsum(np.bincount(b_group, minlength=n_groups))
    out = np.empty(len(a) + len(b), dtype=object)
    last = np.zeros(len(a), dtype=np.int64)
    last[a_upto - 1] = 1
    out[np.arange(len(a)) + np.concatenate(([0], b_upto))[a_group]] = np.array(pair.a_shown, dtype=object)[2 * a + last]
    last = np.zeros(len(b), dtype=np.int64)
    last[b_upto - 1] = 1
    out[np.arange(len(b)) + a_upto[b_group]] = np.array(pair.b_shown, dtype=object)[2 * b + last]
    return [b"".join(out[s:e])[:-1] for s, e in zip(ends[:-1], ends[1:])]


@dataclass
class Aligned:
    """A slice of texts: figures of each document, and its row of the (document, pair) matrix."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def align_texts(pair: Pair, texts: list[str | None]) -> Aligned:
    a_lists, b_lists = pair.encode(texts)
    (a, a_at), (b, b_at) = flat(a_lists), flat(b_lists)
    docs, vocabulary = len(texts), len(pair.b_length)
    overlaps = row_products(token_bytes(pair.a_length[a]), bytes_token(pair.b_length[b]))
    a_group, b_group = groups_of(overlaps)
    n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
    a_doc = np.repeat(np.arange(docs), np.diff(a_at))
    # rows: the ids of a document on the A side
    rows, row = np.unique(a_doc * len(pair.a_length) + a, return_inverse=True)
    left = incidence(row, a_group, len(rows), n_groups)
    right = incidence(b_group, b, n_groups, vocabulary)
    links = row_products(left, right)
    doc, a_id = np.divmod(rows[links.row_of()], len(pair.a_length))
    first = np.concatenate((a_group, [n_groups]))[a_at]
    return Aligned(
        np.diff(a_at), np.diff(b_at), np.diff(first), np.diff(overlaps.indptr[a_at]),
        np.bincount(doc, links.data, docs).astype(np.int64),
        shown(pair, a, a_group, b, b_group, a_at + b_at),
        doc, a_id * vocabulary + links.indices, links.data,
    )


FIGURES = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links"]
DOCUMENT = ", ".join(f"{n} long" for n in FIGURES) + ", groups_sha256 string"


def _pack(positions: np.ndarray, times: np.ndarray) -> bytes:
    raw = np.concatenate((np.diff(positions, prepend=0), times)).astype("<u4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    both = np.frombuffer(raw, dtype="<u4").reshape(2, -1).astype(np.int64)
    return np.cumsum(both[0]), both[1]


def _chunk_rows(ids: list[pa.Array], done: list[Aligned], chunk: int, with_groups: bool, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk; the first carries the chunk's pairs and in how many documents each is."""
    every, place, holders = np.unique(np.concatenate([x.pair for x in done]), return_inverse=True, return_counts=True)
    at = 0
    for k, (own, x) in enumerate(zip(ids, done)):
        n = len(own)
        cuts = np.searchsorted(x.doc, np.arange(n + 1))
        mine = place[at : at + len(x.pair)]
        at += len(x.pair)
        blobs = [_pack(mine[s:e], x.times[s:e]) for s, e in zip(cuts[:-1], cuts[1:])]
        digests = [hashlib.sha256(g).hexdigest() if g else "" for g in x.groups]
        head = [every, holders] if k == 0 else [None, None]
        carried = [pa.array([h, *[None] * (n - 1)], pa.list_(kind)) for h, kind in zip(head, (pa.int64(), pa.int32()))]
        extra = [pa.array([g.decode() for g in x.groups], pa.string())] if with_groups else []
        figures = [pa.array(getattr(x, f)) for f in FIGURES]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, chunk)), own, *figures, pa.array(digests, pa.string()), pa.array(blobs, pa.binary()), *carried, *extra], names
        )


def _align(files: Files, with_groups: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(files)
        chunk = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        done: list[Aligned] = []
        size = 0
        for batch in batches:
            texts = batch.column(1)
            for piece in tk.slices(texts):
                ids.append(batch.column(0).slice(piece.first, piece.rows))
                done.append(align_texts(pair, texts.slice(piece.first, piece.rows).to_pylist()))
                size += len(piece.data)
                if size > CHUNK:
                    yield from _chunk_rows(ids, done, chunk, with_groups, names)
                    ids, done, size, chunk = [], [], 0, chunk + 1
        if done:
            yield from _chunk_rows(ids, done, chunk, with_groups, names)

    return run


def aligned(docs: DataFrame, files: Files, key: str = "doc_id", with_groups: bool = False) -> DataFrame:
    """One row for each document, in chunks: its figures and its row of the (document, pair) matrix; written once."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[key].dataType.simpleString()
    names = ["chunk", key, *FIGURES, "groups_sha256", "row", "pairs", "holders"] + ["groups"] * with_groups
    fields = f"chunk long, `{key}` {kind}, {DOCUMENT}, row binary, pairs array<long>, holders array<int>" + ", groups string" * with_groups
    folder = f"{ensure_checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    with spread.batches_of(spark, 400):
        docs.select(key, F.col("text").cast("string").alias("text")).mapInArrow(_align(files, with_groups, names), fields).write.parquet(folder)
    return spark.read.parquet(folder)


def chunk_pairs(table: DataFrame) -> DataFrame:
    """(chunk, position, pair, holders) of every pair of a chunk."""
    every = table.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "holders")).alias("position", "x"))
    return every.select("chunk", "position", F.col("x.pairs").alias("pair"), F.col("x.holders").alias("holders"))


def pair_counts(table: DataFrame, vocabulary: int) -> DataFrame:
    """(pair, count, best): the documents that hold the pair, and whether no other pair of its A id is in more."""
    counts = chunk_pairs(table).groupBy("pair").agg(F.sum("holders").alias("count"))
    own = counts.withColumn("a_id", F.expr(f"pair div {vocabulary}"))
    most = own.groupBy("a_id").agg(F.max("count").alias("most"))
    return own.join(most, "a_id").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def token_map(docs: DataFrame, files: Files, key: str = "doc_id") -> DataFrame:
    """(a_id, b_id, count, best) of every id pair that any document links."""
    size = len(tokenizers(files).b_length)
    found = pair_counts(aligned(docs, files, key), size)
    return found.select(F.expr(f"pair div {size}").alias("a_id"), (F.col("pair") % size).alias("b_id"), "count", "best")


def align(docs: DataFrame, files: Files, key: str = "doc_id", with_groups: bool = False) -> DataFrame:
    """Figures of every document; ``with_groups`` adds the groups themselves, ``a1,a2|b1;a3|b2,b3``."""
    table = aligned(docs, files, key, with_groups)
    counts = pair_counts(table, len(tokenizers(files).b_length))
    answers = chunk_pairs(table).join(counts, "pair").select(F.col("chunk").alias("of"), "position", "count", "best")
    kept = [key, *FIGURES, "groups_sha256"] + ["groups"] * with_groups
    kind = docs.schema[key].dataType.simpleString()

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        count, best = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        at = found.column("position").to_numpy()
        count[at] = found.column("count").to_numpy()
        best[at] = found.column("best").to_numpy().astype(np.int64)
        n_best, total = [], []
        for blob in own.column("row"):
            positions, times = _unpack(blob.as_py())
            n_best.append(int(best[positions] @ times))
            total.append(int(count[positions] @ times))
        return own.select(kept).append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))

    rows = table.select("chunk", *kept, "row").groupBy("chunk")
    fields = f"`{key}` {kind}, {DOCUMENT}" + ", groups string" * with_groups + ", n_best long, count_sum long"
    return rows.cogroup(answers.groupBy("of")).applyInArrow(run, fields)
