"""Source mixing: targets by exact fractions, totals, limits, expectations and reruns."""

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from lotweave.llm import mixing
from lotweave.llm.queries import op12_source_mix
from tests.llm.brute import words
from tests.llm.conftest import SF


def exact_targets(sizes, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, out, open_ = Fraction(3, 2) * sum(sizes.values()), {}, set(order)
    while open_:
        unit = (budget - sum(out.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        out |= {s: Fraction(2 * sizes[s]) for s in over}
        open_ -= over
    return out


def check(rows, near):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = exact_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12, abs=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(largest[s] * near, 1)


def test_mix_query(spark, documents):
    rows = op12_source_mix(spark, SF).collect()
    assert sorted((r.doc_id, r.size) for r in rows) == sorted((d[0], len(words(d[1]))) for d in documents)
    check(rows, 0.5001)
    again = op12_source_mix(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_tree(spark, documents, monkeypatch):
    """Several levels, a hot source, and the same result however the rows are dealt."""
    monkeypatch.setattr(mixing, "GROUP", 16)
    rows = [(i, "w " * (1 + i * 7919 % 200), "hot" if i % 3 else f"s{i % 30}") for i in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(frame.repartition(7)).collect()
    check(found, 0.5001)
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(frame.repartition(3, "text")).collect()))


def test_mix_edges(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    check(rows, 0.5001)
    assert mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a"), (2, " ", "a")], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


def test_many_sources_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES", 3)
    rows = [(i, "a b c d e " * (1 + i % 9), f"s{i % 50:02}" if i % 50 else None) for i in range(1000)]
    check(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect(), 0.5001)


def test_settle_keeps_totals_and_expectations():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 500, 40)
    share = rng.random(40)
    seen = np.zeros(40)
    for _ in range(4000):
        got, open_ = mixing.settle(share, size, rng.random(40))
        settled = np.delete(got, open_) if open_ >= 0 else got
        assert set(settled) <= {0.0, 1.0} and got @ size == pytest.approx(share @ size, rel=1e-9)
        seen += got
    assert np.max(np.abs(seen / 4000 - share)) < 0.04
