"""Alignment against a brute-force version that compares byte ranges pair by pair."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from lotweave.llm import alignment
from lotweave.llm.queries import both_vocabularies, op11_token_alignment
from tests.llm.conftest import SF


def brute(texts):
    """(n_a, n_b, n_groups, n_links, groups, links) of each text by the vocabulary files, and the figures over all."""
    import re

    import sentencepiece
    from tokenizers import Tokenizer

    files = both_vocabularies()
    a_side = Tokenizer.from_file(files.vocabulary)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}

    def piece(i):
        name = b_side.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", name) else name.replace("▁", " ").encode()

    out = []
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [piece(i) for i in b]
        if text and not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        common = sorted(set(a_end) & set(b_end))
        groups, links, low = [], [], 0
        for high in common:
            a_own = [i for i, e in zip(a, a_end) if low < e <= high]
            b_own = [i for i, e in zip(b, b_end) if low < e <= high]
            groups.append(",".join(map(str, a_own)) + "|" + ",".join(map(str, b_own)))
            links += [(x, y) for x in a_own for y in b_own]
            low = high
        out.append((len(a), len(b), len(groups), len(links), ";".join(groups), links))
    counts = Counter(p for row in out for p in set(row[-1]))
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    shown = []
    for *figures, groups, links in out:
        best = sum(counts[p] == most[p[0]] for p in links)
        shown.append((*figures, best, sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    return shown


def figures(row):
    return (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups_sha256)


def test_alignment_query(spark, documents):
    texts = [d for d in documents if len(d[1] or "") < 6000]
    frame = spark.createDataFrame([(d[0], d[1]) for d in texts], "doc_id long, text string").repartition(4)
    found = {r.doc_id: figures(r) for r in alignment.align(frame, both_vocabularies()).collect()}
    assert found == {d[0]: want for d, want in zip(texts, brute([d[1] for d in texts]))}
    assert op11_token_alignment(spark, SF).count() == len(documents)


def test_alignment_edges(spark, odd, none):
    texts = [r.text for r in odd.collect()] + ["a▁b", "<s> <|endoftext|> </s>", "don't 1234.5 ☃ é   x", "İstanbul ﬀ 你好", "a  b \n\n", " a"]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, chunk int, row string")
    rows = alignment.align(frame, both_vocabularies(), with_groups=True).collect()
    short = {i for i, t in enumerate(texts) if len(t or "") < 100_000}
    want = brute([t if i in short else "" for i, t in enumerate(texts)])
    assert len(rows) == len(texts)
    for r in rows:
        if not texts[r.doc_id] or r.doc_id == texts.index("a▁b"):
            assert figures(r) == (0, 0, 0, 0, 0, 0, "") and r.groups == ""
        elif r.doc_id in short:
            # the long texts add to counts, not to what a text holds
            assert figures(r)[:4] == want[r.doc_id][:4] and r.groups_sha256 == want[r.doc_id][-1]
            assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256
    assert alignment.align(odd, both_vocabularies()).count() == odd.count()
    assert alignment.align(none, both_vocabularies()).count() == 0


def test_token_map(spark):
    frame = spark.createDataFrame([(1, "the cat"), (2, "the dog"), (3, "the dog the dog")], "doc_id long, text string").repartition(3)
    rows = alignment.token_map(frame, both_vocabularies()).collect()
    assert sorted(r["count"] for r in rows)[-1] == 3 and all(r.best for r in rows if r["count"] == 3)


@pytest.mark.parametrize("seed", range(5))
def test_row_products(seed, monkeypatch):
    monkeypatch.setattr(alignment, "EXPAND", 7)
    rng = np.random.default_rng(seed)
    left, right = (rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in ((9, 6), (6, 8)))

    def csr(m):
        row, column = np.nonzero(m)
        return alignment.Csr(np.searchsorted(row, np.arange(len(m) + 1)), column, m[row, column], m.shape[1])

    got = alignment.row_products(csr(left), csr(right))
    dense = np.zeros((9, 8), dtype=np.int64)
    dense[got.row_of(), got.indices] = got.data
    assert (dense == left @ right).all()
