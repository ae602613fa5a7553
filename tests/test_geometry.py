import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotweave.functions import crs
from lotweave.functions import geometry as g
from lotweave.functions import overlay as ov
from lotweave.functions.geohash import geohash_degrees
from lotweave.operators.dissolve import is_valid, repair
from tests.shapes import as_geom, convex_clip_area, frame, square, triangle

HOLED = [[[(0, 0), (6, 0), (6, 6), (0, 6), (0, 0)], [(2, 2), (2, 4), (4, 4), (4, 2), (2, 2)]]]
L_SHAPE = [[[(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4), (0, 0)]]]
TWO_PARTS = square(0, 0)[:1] + square(5, 5, 2)[:1]
BOW_TIE = [[[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]]


def one(spark, parts, column):
    return frame(spark, [(1, as_geom(parts))]).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("parts, area, perimeter", [(HOLED, 32, 32), (L_SHAPE, 7, 16), (TWO_PARTS, 5, 12)])
def test_measures(spark, parts, area, perimeter):
    assert one(spark, parts, g.area(F.col("geom"))) == area
    assert one(spark, parts, g.perimeter(F.col("geom"))) == perimeter


def test_centroid_with_hole_and_parts(spark):
    assert tuple(one(spark, HOLED, g.centroid(F.col("geom")))) == (3.0, 3.0)
    x, y = one(spark, TWO_PARTS, g.centroid(F.col("geom")))
    assert (x, y) == pytest.approx((4.9, 4.9))


def test_point_location_counts_borders(spark):
    def inside(x, y):
        return one(spark, HOLED, g.contains_point(F.col("geom"), F.lit(float(x)), F.lit(float(y))))

    assert inside(1, 1) and inside(6, 3) and inside(2, 3)
    assert not inside(3, 3) and not inside(7, 7)


def test_rectangle_detection(spark):
    assert one(spark, square(1, 2, 3, 4), g.is_rectangle(F.col("geom")))
    for other in (L_SHAPE, HOLED, TWO_PARTS, BOW_TIE):
        assert not one(spark, other, g.is_rectangle(F.col("geom")))
    assert one(spark, [], g.bbox(F.col("geom"))) is None


def test_overlap_and_intersection_against_clipping(spark):
    rng = random.Random(7)
    rows = [(i, as_geom(triangle(rng, 20)), as_geom(triangle(rng, 20))) for i in range(150)]
    kind = "array<array<array<struct<x:double,y:double>>>>"
    df = spark.createDataFrame(rows, f"id long, a {kind}, b {kind}")
    found = df.select("id", g.overlap_area(F.col("a"), F.col("b")), g.intersects(F.col("a"), F.col("b"))).collect()
    for (i, a, b), (_, area, meets) in zip(rows, sorted(found)):
        expected = convex_clip_area(a, b)
        assert area == pytest.approx(expected, abs=1e-6), i
        assert meets or expected == 0


def test_concave_overlap(spark):
    kind = "array<array<array<struct<x:double,y:double>>>>"
    rows = [(as_geom(L_SHAPE), as_geom(square(0, 0, 2))), (as_geom(HOLED), as_geom(square(1, 1, 2))), (as_geom(HOLED), as_geom(square(2, 2, 2)))]
    df = spark.createDataFrame(rows, f"a {kind}, b {kind}")
    got = [tuple(r) for r in df.select(g.overlap_area(F.col("a"), F.col("b")), g.intersects(F.col("a"), F.col("b"))).collect()]
    assert got == [(3.0, True), (3.0, True), (0.0, True)]


def test_clip_keeps_area(spark):
    box = [F.lit(float(v)) for v in (1, 1, 5, 5)]
    assert one(spark, HOLED, g.area(g.clip_to_box(F.col("geom"), *box))) == 12
    assert one(spark, L_SHAPE, g.area(g.clip_to_box(F.col("geom"), *[F.lit(float(v)) for v in (0, 0, 2, 4)]))) == 5


def test_transforms_round_trip(spark):
    spots = spark.createDataFrame([(-123.1, 45.2), (-120.5, 44.0), (-117.2, 48.9)], "x double, y double")
    for srid in (3857, 5070, 2269, 2913):
        there = crs.reproject_point(g.point(F.col("x"), F.col("y")), 4326, srid)
        back = spots.select("x", "y", crs.reproject_point(there, srid, 4326).alias("b")).collect()
        for row in back:
            assert row.b.x == pytest.approx(row.x, abs=1e-8) and row.b.y == pytest.approx(row.y, abs=1e-7)
    with pytest.raises(ValueError):
        crs.reproject(F.col("g"), 3857, 1)


def test_projection_origins(spark):
    albers = crs.reproject_point(g.point(F.lit(-96.0), F.lit(23.0)), 4326, 5070)
    feet = crs.reproject_point(g.point(F.lit(-120.5), F.lit(43 + 2 / 3)), 4326, 2913)
    row = spark.range(1).select(albers.alias("a"), feet.alias("f")).first()
    assert (row.a.x, row.a.y) == pytest.approx((0, 0), abs=1e-6)
    assert (row.f.x, row.f.y) == pytest.approx((2500000 / 0.3048, 0), abs=1e-6)


@pytest.mark.parametrize("lon, lat, code", [(-5.6, 42.6, "ezs42"), (10.40744, 57.64911, "u4pruydqqvj"), (0.0, 0.0, "s0000")])
def test_geohash_vectors(spark, lon, lat, code):
    got = spark.range(1).select(geohash_degrees(F.lit(lon), F.lit(lat), len(code)).alias("h")).first()["h"]
    assert got == code


def _edges(parts):
    ring = np.array(parts[0][0], dtype=float)
    return np.concatenate([ring[:-1], ring[1:]], axis=1)


def _area(polygons):
    total = 0.0
    for part in polygons:
        for flat in part:
            p = np.array(flat).reshape(-1, 2) - np.array(flat[:2])
            total += np.sum(p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]) / 2
    return total


def test_overlay_inclusion_exclusion():
    rng = random.Random(3)
    for _ in range(100):
        a, b = _edges(triangle(rng, 20)), _edges(triangle(rng, 20))
        union = _area(ov.overlay([np.concatenate([a, b])], ov.union_rule))
        both = _area(ov.overlay([a, b], ov.both_rule))
        alone = _area(ov.overlay([a], ov.union_rule)) + _area(ov.overlay([b], ov.union_rule))
        assert union + both == pytest.approx(alone, abs=1e-4)


def test_overlay_shapes():
    ring = np.concatenate([_edges(square(0, 0, 6, 1)), _edges(square(0, 5, 6, 1)), _edges(square(0, 0, 1, 6)), _edges(square(5, 0, 1, 6))])
    holed = ov.overlay([ring], ov.union_rule)
    assert len(holed) == 1 and len(holed[0]) == 2 and _area(holed) == 20
    corner = ov.overlay([np.concatenate([_edges(square(0, 0, 2)), _edges(square(2, 2, 2))])], ov.union_rule)
    assert len(corner) == 2
    edge = ov.overlay([np.concatenate([_edges(square(0, 0, 2)), _edges(square(2, 0, 2))])], ov.union_rule)
    assert len(edge) == 1 and len(edge[0][0]) == 10


def test_repair_is_selective_and_idempotent(spark):
    rows = [(1, as_geom(BOW_TIE)), (2, as_geom(HOLED)), (3, as_geom(square(0, 0))), (4, None), (5, [[[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0)]]])]
    fixed = repair(frame(spark, rows)).persist()
    got = {r.id: (r.repaired, r.area) for r in fixed.select("id", "repaired", g.area(F.col("geom")).alias("area")).collect()}
    assert got == {1: (True, 2.0), 2: (False, 32.0), 3: (False, 1.0), 4: (False, None), 5: (True, 2.0)}
    assert fixed.where(~is_valid(F.col("geom"))).isEmpty()


def _circle(corners, radius=100.0):
    turn = np.arange(corners) * 2 * np.pi / corners
    return np.stack([1000 + radius * np.cos(turn), 2000 + radius * np.sin(turn)], axis=1)


def _ring_edges(ring):
    return np.concatenate([ring, np.roll(ring, -1, axis=0)], axis=1)


@pytest.mark.parametrize("jitter", [1e-6, 1e-5, 1e-4, 1e-3, 1e-2])
@pytest.mark.parametrize("copies", [2, 5, 10, 50])
def test_union_of_near_copies_loses_nothing(copies, jitter):
    rng = np.random.default_rng(copies)
    shapes = [_ring_edges(_circle(60) + rng.normal(0, jitter, (60, 2))) for _ in range(copies)]
    largest = max(_area(ov.overlay([s], ov.union_rule)) for s in shapes)
    united = _area(ov.union_of(shapes))
    assert largest - 1e-3 <= united <= _area([[(_circle(60, 100 + 6 * jitter)[[*range(60), 0]]).ravel().tolist()]]) + 1e-3


def test_large_outline_is_quick():
    import time

    start = time.perf_counter()
    assert _area(ov.overlay([_ring_edges(_circle(8000, 1000.0))], ov.union_rule)) == pytest.approx(np.pi * 1e6, rel=1e-5)
    assert time.perf_counter() - start < 1


def test_open_boundary_is_an_error():
    with pytest.raises(ov.OpenBoundary):
        ov._walk(np.array([[0.0, 0.0, 1.0, 0.0], [1.0, 0.0, 1.0, 1.0]]))


def test_crossing_between_rings_and_long_rings(spark):
    crossing = [[HOLED[0][0], [(2, 2), (2, 9), (4, 9), (4, 2), (2, 2)]]]
    touching = [[HOLED[0][0], [(0, 2), (2, 4), (4, 2), (0, 2)]]]
    ring = [tuple(p) for p in _circle(3000).tolist()]
    bent = [*ring[:1500], (1000.0, 2500.0), (1000.0, 1500.0), *ring[1500:]]
    rows = [(1, as_geom(crossing)), (2, as_geom(touching)), (3, as_geom(HOLED)), (4, as_geom([[[*ring, ring[0]]]])), (5, as_geom([[[*bent, bent[0]]]])), (6, as_geom(BOW_TIE))]
    got = {r.id: r.v for r in frame(spark, rows).select("id", g.self_crosses(F.col("geom")).alias("v")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: True, 6: True}


def test_rows_that_cannot_be_overlaid_say_why():
    from lotweave.operators.dissolve import _overlaid_or_fault

    ring = _edges(square(0, 0, 4))
    lost = ring.copy()
    lost[0, 0] = np.nan
    inner = _edges(square(1, 1))
    fine, remark = _overlaid_or_fault([[ring], [inner]], "both_rule")
    assert _area(fine) == pytest.approx(1) and remark is None
    assert _overlaid_or_fault([[ring[:-1]], [inner]], "both_rule") == (None, ov.NOT_CLOSED)
    assert _overlaid_or_fault([[inner], [lost]], "both_rule") == (None, ov.NO_NUMBER)
    assert _overlaid_or_fault([[], [inner]], "both_rule") == ([], None)


def test_a_kernel_that_gives_up_costs_one_row(monkeypatch):
    from lotweave.operators.dissolve import _overlaid_or_fault

    tried = []

    def walk(segs):
        tried.append(len(segs))
        if len(tried) <= stubborn:
            raise ov.OpenBoundary("a boundary of 4 segments does not close")
        return kept(segs)

    kept = ov._walk
    monkeypatch.setattr(ov, "_walk", walk)
    layers = [[_edges(square(0, 0, 4))], [_edges(square(1, 1))]]
    stubborn = 1
    fine, remark = _overlaid_or_fault(layers, "both_rule")
    assert _area(fine) == pytest.approx(1) and remark == "rounded to a grid 16 times coarser"
    tried.clear()
    stubborn = len(ov.COARSER)
    assert _overlaid_or_fault(layers, "both_rule") == (None, "a boundary of 4 segments does not close")


def test_unusable(spark):
    nan, inf = float("nan"), float("inf")
    cases = [
        (HOLED, None), ([], None), ([[HOLED[0][0][:-1]]], ov.NOT_CLOSED), ([[HOLED[0][0], HOLED[0][1][:-1]]], ov.NOT_CLOSED),
        ([[[(0, 0), (nan, 1), (1, 1), (0, 0)]]], ov.NO_NUMBER), ([[[(0, 0), (0, inf), (1, 1), (0, 0)]]], ov.NO_NUMBER),
    ]
    rows = frame(spark, [(i, as_geom(s)) for i, (s, _) in enumerate(cases)] + [(len(cases), None)])
    got = [r.v for r in rows.orderBy("id").select(g.unusable(F.col("geom")).alias("v")).collect()]
    assert got == [reason for _, reason in cases] + [None]


def test_shapes_along_the_axes_are_overlaid_together(monkeypatch):
    """The same outlines as by the kernel, without a call of it a row: frames, parts that meet in a point, copies, holes, open rings."""
    import numpy as np

    from lotweave.functions import overlay as ov
    from lotweave.functions import rectilinear

    random = np.random.default_rng(7)

    def ring(*corners):
        return np.array([[*a, *b] for a, b in zip(corners, [*corners[1:], corners[0]])], dtype=float)

    def box(x0, y0, x1, y1):
        return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))

    def shape():
        x, y = random.integers(0, 6, 2) * 1.5
        w, h = random.integers(1, 5, 2) * 0.75
        frame = [box(x, y, x + 4 * w, y + 4 * h), box(x + w, y + h, x + 3 * w, y + 3 * h)[::-1][:, [2, 3, 0, 1]]]
        corners = [box(x, y, x + w, y + h), box(x + w, y + h, x + 2 * w, y + 2 * h)]
        bent = [ring((x, y), (x + 4 * w, y), (x + 4 * w, y + 2 * h), (x + 2 * w, y + 2 * h), (x + 2 * w, y + 4 * h), (x, y + 4 * h))]
        return np.concatenate([frame, corners, bent][random.integers(3)])

    for rule, layers in ((ov.both_rule, 2), (ov.union_rule, 1), (ov.even_odd_rule, 1)):
        rows = [[np.concatenate([shape() for _ in range(1 + i % 3)]) for _ in range(layers)] for i in range(150)]
        rows.append([box(0, 0, 1, 1)[:3]] * layers)  # not closed
        rows.append([ring((0, 0), (2, 0), (1, 1))] * layers)  # not along the axes
        segs = np.concatenate([s for row in rows for s in row])
        place = np.repeat(np.arange(len(rows)), [sum(map(len, row)) for row in rows])
        layer = np.concatenate([np.full(len(s), k) for row in rows for k, s in enumerate(row)])
        want = [ov.overlay(row, rule) for row in rows[:150]]
        with monkeypatch.context() as patch:
            patch.setattr(ov, "_overlay", None)
            got = rectilinear.overlays(segs, place, layer, len(rows), layers, rule)
        assert [got[i] for i in range(150)] == want and set(got) == set(range(150))
