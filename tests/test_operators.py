import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotweave.functions import geometry as g
from lotweave.functions import text
from lotweave.operators import cleaning as c
from lotweave.operators import reducers, zonal
from lotweave.operators.cluster import cluster_within, components_across_cluster
from lotweave.operators.dissolve import cell_pieces, dissolve, subdivide
from lotweave.operators.overlap import largest_overlap, overlay_pairs
from lotweave.operators.reducers import Reducer
from lotweave.operators.spatial_join import cover_cells, met_pairs, points_in_polygons, spatial_pairs, with_box
from lotweave.operators.zonal import Grid, class_histogram, parcel_statistics
from tests.shapes import as_geom, components, convex_clip_area, convex_distance, frame, square, triangle

KIND = "array<array<array<struct<x:double,y:double>>>>"


def mixed(rng, count, spread):
    """Squares and triangles."""
    return [square(rng.randrange(spread), rng.randrange(spread), rng.randrange(1, 20)) if i % 2 else triangle(rng, spread) for i in range(count)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spatial_pairs_match_brute_force(spark):
    rng = random.Random(11)
    left, right = mixed(rng, 60, 100), mixed(rng, 60, 100)
    a = frame(spark, [(i, as_geom(s)) for i, s in enumerate(left)])
    b = frame(spark, [(i, as_geom(s)) for i, s in enumerate(right)], f"fid long, geom {KIND}")
    pairs = spatial_pairs(a, b, ["id"], ["fid"], cell=15.0, overlap="shared")
    got = {(r.id, r.fid): r.shared for r in pairs.collect()}
    expected = {(i, j): convex_clip_area(p, q) for i, p in enumerate(left) for j, q in enumerate(right) if convex_distance(p, q) == 0}
    assert set(got) == set(expected) and pairs.count() == len(expected)
    for key, area in expected.items():
        assert got[key] == pytest.approx(area, abs=1e-6)
    cut = overlay_pairs(a, b, ["id"], ["fid"], cell=15.0).select("id", "fid", g.area(F.col("geom")).alias("area"))
    areas = {(r.id, r.fid): r.area for r in cut.collect()}
    for key, area in expected.items():
        assert areas.get(key, 0.0) == pytest.approx(area, abs=1e-3)


def test_subdivided_features_give_the_same_overlaps(spark):
    rng = random.Random(21)
    comb = [[[(0, 0), (60, 0), (60, 40), (50, 40), (50, 5), (35, 5), (35, 40), (25, 40), (25, 5), (10, 5), (10, 40), (0, 40), (0, 0)]]]
    parcels = frame(spark, [(i, as_geom(triangle(rng, 50))) for i in range(60)])
    features = frame(spark, [(1, as_geom(comb)), (2, as_geom(square(5, 5, 30)))], f"fid long, geom {KIND}")
    plain = largest_overlap(parcels, features, "id", "fid", [], cell=10.0)
    cut = subdivide(features, ["fid"], 7.0, max_vertices=6)
    pieces = largest_overlap(parcels, cut, "id", "fid", [], cell=10.0, in_pieces=True)
    a, b = ({r.id: r for r in df.collect()} for df in (plain, pieces))
    assert cut.where("fid = 1").count() > 20 and set(a) == set(b)
    for k in a:
        assert a[k].fid == b[k].fid and a[k].overlap_area == pytest.approx(b[k].overlap_area, abs=1e-3)


def test_spatial_plan_is_an_equi_join(spark):
    rows = [(i, as_geom(square(i, i))) for i in range(5)]
    df = frame(spark, rows)
    plan = plan_of(largest_overlap(df, df.withColumnRenamed("id", "fid"), "id", "fid", []))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("small_key_links", [20_000, 0])
def test_clusters_match_brute_force(spark, small_key_links):
    rng = random.Random(5)
    shapes = mixed(rng, 120, 600)
    keys = ["hot" if i % 3 else f"k{i % 4}" for i in range(len(shapes))]
    df = spark.createDataFrame([(i, keys[i], as_geom(s)) for i, s in enumerate(shapes)], f"id long, maptaxlot string, geom {KIND}")
    got = {r.id: r.cid for r in cluster_within(df, eps=30.0, srid=3857, distance_srid=3857, small_key_links=small_key_links).collect()}
    linked = [
        (i, j) for i in range(len(shapes)) for j in range(i) if keys[i] == keys[j] and convex_distance(shapes[i], shapes[j]) <= 30.0
    ]
    assert [got[i] for i in range(len(shapes))] == components(len(shapes), linked)


def test_stacked_copies_are_one_cluster(spark):
    pile = [(i, "0", as_geom(square(5, 5, 2))) for i in range(500)]
    far = [(1000, "0", as_geom(square(5000, 5, 2))), (1001, None, as_geom(square(5, 5, 2))), (1002, "0", None)]
    df = spark.createDataFrame(pile + far, f"id long, maptaxlot string, geom {KIND}")
    got = {r.id: r.cid for r in cluster_within(df, distance_srid=3857).collect()}
    assert {got[i] for i in range(500)} == {0} and got[1000] == 1000 and got[1002] is None


def test_components_across_cluster(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 200 + i) for i in range(50)]
    loose = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(40)]
    links = [p for p in chain + star + loose if p[0] != p[1]]
    got = {r.rep: r.cid for r in components_across_cluster(spark.createDataFrame(links, "a long, b long")).collect()}
    want = components(401, links)
    assert got == {n: want[n] for p in links for n in p}


def test_dissolve_paths_agree(spark):
    rng = random.Random(9)
    shapes = mixed(rng, 90, 60)
    rows = [("a" if i % 2 else None, as_geom(s)) for i, s in enumerate(shapes)] + [("a", as_geom(shapes[1]))] * 5
    df = spark.createDataFrame(rows, f"k string, geom {KIND}")

    def areas(**limits):
        pieces = dissolve(df, ["k"], cell=13.0, **limits)
        total = pieces.groupBy("k").agg(F.sum(g.area(F.col("geom"))).alias("area"), F.count("*").alias("n"), F.max("pieces").alias("p"))
        return {r.k: (r.area, r.n, r.p) for r in total.collect()}

    direct, joined, split = areas(), areas(direct_segments=1), areas(direct_segments=1, row_segments=1)
    for k in ("a", None):
        assert joined[k][0] == pytest.approx(direct[k][0], abs=1e-2)
        assert split[k][0] == pytest.approx(direct[k][0], abs=1e-2)
        assert direct[k][1:] == (1, 1) and joined[k][1] == 1 and split[k][1] == split[k][2] > 1


def test_pile_in_one_cell_is_united_in_rounds(spark):
    rows = [("a", as_geom(square(i % 50, i // 50, 3))) for i in range(1500)]
    pieces = cell_pieces(spark.createDataFrame(rows, f"k string, geom {KIND}"), ["k"], cell=1000.0)
    assert [(r.k, r.area) for r in pieces.select("k", g.area(F.col("geom")).alias("area")).collect()] == [("a", 52 * 32.0)]


def test_zonal_on_general_shapes(spark):
    grid = Grid(0.0, 0.0, 1.0, 7, -9999.0)
    size = 30
    strips = []
    for j in range(size):
        for s in range(5):
            cols = range(s * 7, s * 7 + 7)
            strips.append((j, s, [-9999.0 if i % 11 == 0 else float(i * j % 17 - 3) + 0.5 for i in cols], [float("nan") if i % 13 == 0 else float((i + j) % 3) for i in cols]))
    raster = spark.createDataFrame(strips, "row_no long, strip_no long, elevation array<float>, cover array<float>")
    rng = random.Random(4)
    shapes = [triangle(rng, 10, 15) for _ in range(25)] + [square(2, 3, 9), square(100, 100, 5)]
    df = frame(spark, [(i, as_geom(s)) for i, s in enumerate(shapes)])
    got = {r.id: tuple(r)[1:] for r in parcel_statistics(df, raster, grid, ["id"]).collect()}
    hist = {(r.id, r.cls): r.pixels for r in class_histogram(df, raster, grid, ["id"]).collect()}

    def inside(shape, x, y):
        ring, odd = shape[0][0], False
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay <= y) != (by <= y) and ax + (y - ay) * (bx - ax) / (by - ay) > x:
                odd = not odd
        return odd

    for k, shape in enumerate(shapes):
        cells = [(i, j) for i in range(size) for j in range(size) if inside(shape, i + 0.5, j + 0.5)]
        if not cells:
            assert k not in got
            continue
        heights = [i * j % 17 - 2.5 for i, j in cells if i % 11]
        classes = [(i + j) % 3 for i, j in cells if i % 13]
        want = (int(min(heights)) if heights else 0, int(max(heights)) if heights else 0, classes.count(1), len(classes))
        assert got[k] == want
        for cls in range(3):
            assert hist.get((k, cls), 0) == classes.count(cls)


RULES = [
    (None, True, False, None), ("", True, False, None), ("  ", True, False, None), ("0", True, True, None), (" 0 ", True, True, None),
    ("Railroad", False, False, "Railroad"), ("00012", False, True, "00012"), ("1e5", False, True, "1e5"), ("12A", False, False, "12A"),
    ("NaN", False, True, "NaN"), (" dnr land ", False, False, "dnr land"), ("0x1F", False, True, "0x1F"), ("1_000", False, True, "1_000"),
    ("-.5", False, True, "-.5"), ("1..2", False, False, "1..2"),
]


def test_key_rules(spark):
    df = spark.createDataFrame([(i, k) for i, (k, *_ ) in enumerate(RULES)], "i int, k string")
    k = F.col("k")
    rows = df.select("i", text.blank_or_zero(k), F.coalesce(text.is_numeric_text(k), F.lit(False)), text.clean_key(k)).collect()
    for (_, blank, numeric, key), (_, b, n, c_) in zip(RULES, sorted(rows)):
        expected_key = "0" if key is None and blank and numeric else key
        assert (bool(b), n) == (blank, numeric) and c_ == expected_key


@pytest.mark.parametrize("key, hit", [("ROAD 1", True), ("xrrx", True), ("12 r/r", True), ("strip", True), ("1N2W", False), (None, None)])
def test_oregon_words(spark, key, hit):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(text.has_word(F.col("k"), text.OREGON_NON_PARCEL_WORDS)).first()[0] is hit


def test_thinness_without_perimeter_is_kept(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 4.0), (3, 1.0, 100.0), (4, None, None)], "id int, area_sqm double, perimeter double")
    assert sorted(r.id for r in c.drop_thin(df).collect()) == [1, 2, 4]


def test_codes_are_never_cut(spark):
    df = spark.createDataFrame([("7",), ("1234",), (None,)], "c string")
    assert [r[0] for r in df.select(text.pad_code(F.col("c"))).collect()] == ["007", "1234", None]


class Spread(Reducer):
    """A caller's own reducer: the span of elevations and the pixels whose class is missing."""

    state = {"low": "float", "high": "float", "blank": "long"}
    result = {"span": "double", "blank": "long"}

    def partial(self, tile):
        known = np.where(np.isnan(tile.elevation), np.inf, tile.elevation)
        low = tile.by_zone(np.minimum, tile.extremes(known, np.minimum), np.inf)
        high = -tile.by_zone(np.minimum, tile.extremes(np.where(np.isinf(known), np.inf, -known), np.minimum), np.inf)
        return np.arange(tile.zones), {"low": low, "high": high, "blank": tile.by_zone(np.add, tile.counts(tile.cover == reducers.MISSING), 0)}

    def merge(self, zone, state):
        zones, at = np.unique(zone, return_inverse=True)
        out = {"low": np.full(len(zones), np.inf), "high": np.full(len(zones), -np.inf), "blank": np.zeros(len(zones), np.int64)}
        for name, pick in (("low", np.minimum), ("high", np.maximum), ("blank", np.add)):
            pick.at(out[name], at, state[name])
        return zones, out

    def finish(self, zone, state):
        return zone, {"span": (state["high"] - state["low"]).astype(float), "blank": state["blank"]}


@pytest.fixture
def pixels(spark):
    rng = np.random.default_rng(6)
    size, strip = 150, 25
    heights = rng.integers(-40, 40, (size, size)) / 2
    heights[rng.random((size, size)) < 0.1] = -9999.0
    classes = np.where(rng.random((size, size)) < 0.1, np.nan, rng.integers(0, 5, (size, size)))
    strips = [(j, s, heights[j, s * strip : s * strip + strip].tolist(), classes[j, s * strip : s * strip + strip].tolist()) for j in range(size) for s in range(6) if (j, s) != (9, 1)]
    heights[9, 25:50], classes[9, 25:50] = -9999.0, np.nan
    table = spark.createDataFrame(strips, "row_no long, strip_no long, elevation array<float>, cover array<float>").repartition(5)
    return Grid(0.0, 0.0, 1.0, strip, -9999.0), table, heights, classes


@pytest.mark.parametrize("stacked", [False, True])
def test_reducers_against_pixels(spark, pixels, monkeypatch, stacked):
    """Boxes over tile borders, parcels in pieces and null keys; with small limits tiles are dealt over tasks."""
    if stacked:
        monkeypatch.setattr(zonal, "TILE_RUNS", 50)
        monkeypatch.setattr(zonal, "MERGE", 100)
    grid, table, heights, classes = pixels
    rng = random.Random(2)
    boxes = [(rng.randrange(0, 140), rng.randrange(0, 140), rng.randrange(1, 90), rng.randrange(1, 90), rng.randrange(20)) for _ in range(60)]
    rows = [(k if k else None, f"c{k % 3}", as_geom([[[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]])) for x, y, w, h, k in boxes]
    df = spark.createDataFrame(rows, f"k long, c string, geom {KIND}").repartition(4)
    want = {}
    for x, y, w, h, k in boxes:
        own = want.setdefault((k if k else None, f"c{k % 3}"), ([], []))
        box = np.s_[y : min(y + h, 150), x : min(x + w, 150)]
        there = np.ones_like(heights, dtype=bool)
        there[9, 25:50] = False  # a strip that the raster lacks
        own[0].extend(heights[box][there[box]])
        own[1].extend(classes[box][there[box]])
    quantiles = zonal.reduce_zones(df, table, grid, ["k", "c"], reducers.Quantiles({"low": 0.1, "median": 0.5})).collect()
    spans = {(r.k, r.c): (r.span, r.blank) for r in zonal.reduce_zones(df, table, grid, ["k", "c"], Spread()).collect()}
    stats = {(r.k, r.c): tuple(r)[2:] for r in parcel_statistics(df, table, grid, ["k", "c"]).collect()}
    assert {(r.k, r.c) for r in quantiles} == set(want) == set(spans) == set(stats)
    for r in quantiles:
        high, cls = (np.array(v) for v in want[r.k, r.c])
        high, known = high[high != -9999.0], cls[~np.isnan(cls)]
        assert (r.low, r.median) == pytest.approx(np.quantile(high, [0.1, 0.5]))
        values, counts = np.unique(known, return_counts=True)
        assert (r.variety, r.majority) == (len(values), values[np.argmax(counts)])
        assert spans[r.k, r.c] == (high.max() - high.min(), np.isnan(cls).sum())
        assert stats[r.k, r.c] == (int(high.min()), int(high.max()), int((known == 1).sum()), len(known))


def test_reducers_of_nothing(spark, pixels):
    grid, table, *_ = pixels
    far = spark.createDataFrame([(1, as_geom(square(9000, 9000, 5)))], f"k long, geom {KIND}")
    for reducer in (reducers.Statistics(), reducers.Histogram(), reducers.Quantiles({"m": 0.5})):
        assert zonal.reduce_zones(far, table, grid, ["k"], reducer).count() == 0
        assert zonal.reduce_zones(far.where("false"), table, grid, ["k"], reducer).count() == 0


def test_zones_in_one_window_send_no_states(spark, pixels, monkeypatch):
    """A rectangle is one block whatever its height, and only zones that leave their window make states."""
    monkeypatch.setattr(zonal, "TILE_LINES", 25)  # tiles of 25 lines and one strip
    grid, table, heights, _ = pixels
    boxes = {1: (3, 4, 40, 44), 2: (10, 20, 30, 25), 3: (5, 5, 100, 9), None: (60, 60, 2, 2)}
    rows = [(k, as_geom([[[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]])) for k, (x, y, w, h) in boxes.items()]
    # one key in two far places; a shape of runs over a strip that the raster lacks
    rows += [(4, as_geom(square(0, 0, 5))), (4, as_geom(square(120, 130, 5))), (5, as_geom([[[(20, 0), (60, 0), (20, 40), (20, 0)]]]))]
    df = spark.createDataFrame(rows, f"k long, geom {KIND}")
    placed = zonal.pixel_blocks(zonal.pixel_boxes(df, grid, ["k"]), grid, ["k"])
    assert {r.k: r["count"] for r in placed.groupBy("k").count().collect()} == {1: 1, 2: 1, 3: 1, None: 1, 4: 2, 5: 39}

    got = {r.k: r for r in zonal.reduce_zones(df, table, grid, ["k"], reducers.Quantiles({"m": 0.5})).collect()}
    stats = {r.k: r for r in parcel_statistics(df, table, grid, ["k"]).collect()}
    there = heights.copy()
    there[9, 25:50] = -9999.0
    for k, (x, y, w, h) in boxes.items():
        own = there[y : min(y + h, 150), x : min(x + w, 150)]
        own = own[own != -9999.0]
        assert got[k].m == np.quantile(own, 0.5) and (stats[k].min_elev, stats[k].max_elev) == (int(own.min()), int(own.max()))
    both = np.concatenate([there[:5, :5].ravel(), there[130:135, 120:125].ravel()])
    assert got[4].m == np.quantile(both[both != -9999.0], 0.5)
    slope = np.concatenate([there[j, 20 : 59 - j] for j in range(39)])
    assert got[5].m == pytest.approx(np.quantile(slope[slope != -9999.0], 0.5))


def test_joins_on_cells_are_dealt_over_tasks(spark):
    """Small derived sides make many pairs: they are not broadcast, and pairs of rectangles stay out of Python."""
    a = frame(spark, [(i, as_geom(square(7 * i, 0, 10))) for i in range(6)])
    b = frame(spark, [(1, as_geom(square(0, 0, 30))), (2, as_geom([[[(0, 0), (40, 0), (0, 40), (0, 0)]]]))], f"fid long, geom {KIND}")
    spots = a.select("id", g.centroid(F.col("geom")).alias("spot"))
    for joined in (spatial_pairs(a, b, ["id"], ["fid"]), overlay_pairs(a, b, ["id"], ["fid"]), points_in_polygons(spots, b, "spot", ["id"], ["fid"])):
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "REPARTITION_BY_NUM" in plan
    sides = [cover_cells(with_box(df, s, [k]), f"{s}_box", 15.0) for df, s, k in ((a, "l", "id"), (b, "r", "fid"))]
    plain, others = met_pairs(*sides, 15.0)
    assert "Python" not in plan_of(plain)
    assert {r.fid for r in plain.collect()} == {1} and {r.fid for r in others.collect()} == {2}


def test_rectangles_are_valid_without_a_look_at_their_edges(spark):
    from lotweave.operators.dissolve import is_valid

    rows = frame(spark, [(1, as_geom(square(0, 0, 5))), (2, as_geom([[[(0, 0), (5, 5), (5, 0), (0, 5), (0, 0)]]])), (3, as_geom([[[(0, 0), (5, 0), (5, 0), (0, 0), (0, 0)]]])), (4, None)])
    assert {r.id: r.ok for r in rows.select("id", is_valid(F.col("geom")).alias("ok")).collect()} == {1: True, 2: False, 3: False, 4: True}
    assert "THEN true" in str(is_valid(F.col("geom"))) and str(is_valid(F.col("geom"))).index("CASE WHEN") < 12


def test_inner_rectangles_do_not_reach_the_overlay(monkeypatch):
    from lotweave.functions import overlay as ov

    def box(x, y, w, h, turned=False):
        xy = np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)], dtype=float)
        xy = xy[::-1] if turned else xy
        return np.concatenate([xy, np.roll(xy, -1, axis=0)], axis=1)

    rng = random.Random(3)
    boxes = [(rng.randrange(9), rng.randrange(9), rng.randrange(1, 30), rng.randrange(1, 30)) for _ in range(60)]
    cells = {(x + i, y + j) for x, y, w, h in boxes for i in range(w) for j in range(h)}
    sizes = []
    real = ov.overlay
    monkeypatch.setattr(ov, "overlay", lambda layers, rule: sizes.append(sum(map(len, layers))) or real(layers, rule))
    rings = [np.array(r).reshape(-1, 2) for part in ov.union_of([box(*b) for b in boxes]) for r in part]
    assert sum(ov._signed_area(r[:-1]) for r in rings) == len(cells) and max(sizes) < 4 * len(boxes) / 2
    # the same box drawn from another corner, and a hole, which is no rectangle of its own
    again = np.roll(box(0, 0, 5, 5), 1, axis=0)
    assert len(ov._outer([box(0, 0, 5, 5), again])) == 1 and len(ov._outer([box(0, 0, 5, 5), box(1, 1, 2, 2, True)])) == 2


def test_rectangles_of_many_rows_are_united_together(monkeypatch):
    """Near copies, steps, frames around a hole and boxes that meet in a point: the outlines that the kernel makes row by row."""
    import pyarrow as pa
    from lotweave.functions import overlay as ov
    from lotweave.operators import dissolve as ds

    rng = random.Random(5)

    def box(x0, y0, x1, y1):
        xy = np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)], dtype=float)
        return np.concatenate([xy, np.roll(xy, -1, axis=0)], axis=1)

    def near():
        x, y = rng.randrange(-13700000, -13600000), rng.randrange(5300000, 5400000)
        jolt = lambda v, k: v + 10.0 ** -(3 + k % 4) * rng.uniform(-1, 1)
        return [box(jolt(x, k), jolt(y, k), jolt(x + 50, k), jolt(y + 90, k)) for k in range(6)]

    def loose():
        spots = [(rng.randrange(6), rng.randrange(6)) for _ in range(rng.randrange(18))]
        return [box(x, y, x + rng.randrange(1, 5), y + rng.randrange(1, 5)) for x, y in spots]

    rows = [near() for _ in range(80)] + [loose() for _ in range(200)]
    rows += [[box(0, 0, 1e-8, 1)], [box(0, 0, 1, 1), box(1, 1, 2, 2)], [box(0, 0, 1, 1), np.array([[0, 0, 3, 0], [3, 0, 0, 3], [0, 3, 0, 0]], float)]]
    want = [ov.union_of(row) for row in rows]
    calls = []
    real = ov.union_of
    monkeypatch.setattr(ov, "union_of", lambda shapes: calls.append(len(shapes)) or real(shapes))
    column = pa.array([[s.ravel().tolist() for s in row] for row in rows], pa.list_(pa.list_(pa.float64())))
    assert ds._united(column).to_pylist() == want
    assert ds._united(column.slice(40, 100)).to_pylist() == want[40:140]
    calls.clear()
    assert ds._united(column.slice(0, 80)).to_pylist() == want[:80] and not calls


def test_no_task_ranks_a_whole_layer(spark):
    """Ranks by groups of successive keys: null keys and layers, repeated keys, keys below zero."""
    from lotweave.plans import derived as d

    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-40, 200)])) for _ in range(600)]
    df = spark.createDataFrame(rows, "layer string, id long").repartition(7)
    got = d.numbered(df, "layer", "id", 16)
    (ranked,) = [line for line in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [row_number()" in line]
    assert "_range" in ranked.split("windowspecdefinition(")[1].split(" ASC")[0]
    for layer in ("a", "b", None):
        ids = sorted((r.place, r.id) for r in got.collect() if r.layer == layer)
        assert [p for p, _ in ids] == list(range(sum(x == layer for x, _ in rows)))
        assert [i for _, i in ids] == sorted((i for x, i in rows if x == layer), key=lambda i: (i is not None, i or 0))


def test_geometry_tasks_grow_in_number(spark):
    """Tasks over parcels hold a bounded number of rows, whatever the cores."""
    from lotweave.plans import derived as d

    rows = spark.range(10)
    assert d.spread(rows, "id", 100 * d.TASK_ROWS).rdd.getNumPartitions() == 100
    assert d.spread(rows, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_geometry_tasks_are_bounded_where_customers_repeat(spark, tmp_path, monkeypatch):
    """Each order is a parcel for every row of its customer: tasks are dealt by parcels, not by orders."""
    from lotweave.plans import derived as d

    tables = {
        "orders": spark.range(1, 101).selectExpr("id AS o_orderkey", "id % 2 AS o_custkey"),
        "customer": spark.range(100).selectExpr("id % 2 AS c_custkey", "1L AS c_nationkey"),
        "nation": spark.range(3).selectExpr("id AS n_nationkey", "'n' AS n_name"),
    }
    for name, rows in tables.items():
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(d, "TASK_ROWS", 100)
    got = d.parcels(spark, str(tmp_path))
    assert got.count() == 5000 and got.rdd.getNumPartitions() == 50


def test_cleaned_rows_are_read_from_one_checkpoint(spark):
    from lotweave.plans.queries import REGISTRY

    for name in ("duplicate_keys", "conflict_suffix"):
        plan = REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" not in plan and "LogicalRDD" in plan


def test_geometry_text_is_read_once_a_row(spark):
    from lotweave.sources import features

    rows = spark.createDataFrame([(1, "POLYGON((0 0,4 0,4 4,0 0))"), (2, " srid=3857;multipolygon (((0 0, 1e1 0, 5 5, 0 0)))"), (3, "POINT(1 1)"), (4, None)], "id int, wkt string")
    loaded, bad = features.with_geometry(rows, "wkt", "wkt", 3857, 2913)
    plan = loaded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("upper(") == 1
    flat, _ = features.with_geometry(rows, "wkt", "wkt")
    assert {r.id: r.a for r in flat.select("id", g.area(F.col("geom")).alias("a")).collect()} == {1: 8.0, 2: 25.0}
    assert {(r.id, r.reason) for r in bad.collect()} == {(3, "unreadable geometry"), (4, "missing geometry")}


def test_scattered_outlines_are_cut_where_they_lie(spark, monkeypatch):
    """An outline of two parts far apart is cut in the cells of its parts, not in all between them."""
    from lotweave.functions import geometry as geo
    from lotweave.operators import dissolve as dz

    parts = F.concat(geo.rectangle(F.lit(10.0), F.lit(10.0), F.lit(30.0), F.lit(20.0)), geo.rectangle(F.lit(90010.0), F.lit(70010.0), F.lit(90020.0), F.lit(70040.0)))
    rows = spark.range(3).select(F.lit(1).alias("k"), parts.alias("geom"))
    covered, real = [], dz.cover_cells
    monkeypatch.setattr(dz, "cover_cells", lambda *given: covered.append(real(*given)) or covered[-1])
    pieces = dz.cell_pieces(rows, ["k"]).select("cx", "cy", geo.area(F.col("geom")).alias("area")).collect()
    assert covered[0].count() == 6
    assert sorted((r.cx, r.cy, r.area) for r in pieces) == [(0, 0, 200.0), (45, 35, 300.0)]
