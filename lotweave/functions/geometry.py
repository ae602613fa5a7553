"""Planar geometry as Column expressions.

A geometry is ``array<array<array<struct<x,y>>>>``: polygons, their rings (the
first one is the shell) and closed vertex lists. Everything here stays on the
JVM side and is evaluated row by row inside the plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotweave.functions.overlay import NO_NUMBER, NOT_CLOSED

GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a bound variable."""
    return F.transform(F.array(value), fn)[0]


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Counter-clockwise single-ring rectangle."""
    ring = F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))
    return F.array(F.array(ring))


def rings(geom: Column) -> Column:
    return F.flatten(geom)


def vertices(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def map_vertices(geom: Column, fn) -> Column:
    """Apply ``fn(vertex) -> vertex`` to every vertex."""
    return F.transform(geom, lambda part: F.transform(part, lambda ring: F.transform(ring, fn)))


def _ring_edges(ring: Column) -> Column:
    steps = F.size(ring) - 1
    return F.zip_with(
        F.slice(ring, F.lit(1), steps),
        F.slice(ring, F.lit(2), steps),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def edges(geom: Column) -> Column:
    """All directed boundary segments ``struct<x1,y1,x2,y2>``."""
    usable = F.filter(rings(geom), lambda ring: F.size(ring) >= 2)
    return F.flatten(F.transform(usable, _ring_edges))


def _along(ring: Column, start: dict[str, Column], step) -> Column:
    """Fold ``step(held, x1, y1, x2, y2)`` over the sides of a ring in one pass; the struct of what is held, and the last vertex."""

    def held(v: Column, values: dict[str, Column]) -> Column:
        return F.struct(v["x"].alias("x"), v["y"].alias("y"), *[value.alias(name) for name, value in values.items()])

    return F.aggregate(
        F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
        held(F.get(ring, F.lit(0)), start),
        lambda acc, v: held(v, step(acc, acc["x"], acc["y"], v["x"], v["y"])),
    )


def sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def ring_signed_area(ring: Column) -> Column:
    """Shoelace sum taken from the first vertex, which keeps it exact far from the origin."""

    def shoelace(r):
        ox, oy = r[0]["x"], r[0]["y"]
        crosses = _along(
            r, {"a": F.lit(0.0)}, lambda acc, x1, y1, x2, y2: {"a": acc["a"] + ((x1 - ox) * (y2 - oy) - (x2 - ox) * (y1 - oy))}
        )
        return F.when(F.size(r) >= 4, crosses["a"] / 2).otherwise(F.lit(0.0))

    return let(ring, shoelace)


def _part_area(part: Column) -> Column:
    """Shell area minus hole areas, whatever the ring orientation."""
    return let(
        F.transform(part, lambda ring: F.abs(ring_signed_area(ring))),
        lambda sizes: F.when(F.size(sizes) > 0, 2 * sizes[0] - sum_of(sizes)).otherwise(F.lit(0.0)),
    )


def area(geom: Column) -> Column:
    return sum_of(F.transform(geom, _part_area))


def perimeter(geom: Column) -> Column:
    def on(total: Column, ring: Column) -> Column:
        return _along(ring, {"total": total}, lambda acc, x1, y1, x2, y2: {"total": acc["total"] + F.hypot(x2 - x1, y2 - y1)})["total"]

    return F.aggregate(F.filter(rings(geom), lambda ring: F.size(ring) >= 2), F.lit(0.0), on)


def bbox(geom: Column) -> Column:
    """``struct<minx,miny,maxx,maxy>``; NULL for an empty geometry."""

    def span(points):
        xs = F.transform(points, lambda v: v["x"])
        ys = F.transform(points, lambda v: v["y"])
        box = F.struct(
            F.array_min(xs).alias("minx"),
            F.array_min(ys).alias("miny"),
            F.array_max(xs).alias("maxx"),
            F.array_max(ys).alias("maxy"),
        )
        return F.when(F.size(points) > 0, box)

    return let(vertices(geom), span)


def centroid(geom: Column) -> Column:
    """Area-weighted centre over shells minus holes, as ``struct<x,y>``.

    Ring moments are taken from the geometry's first vertex. Holes count
    negative through the sign that turns every ring into its absolute area.
    """
    return let(geom, _centroid)


def _centroid(geom: Column) -> Column:
    points = vertices(geom)
    return F.when(F.size(points) > 0, let(F.get(points, F.lit(0)), lambda origin: _centre_from(geom, origin)))


def _centre_from(geom: Column, origin: Column) -> Column:
    ox, oy = origin["x"], origin["y"]

    def moments(ring: Column, weight: Column) -> Column:
        def add(acc, x1, y1, x2, y2):
            c = (x1 - ox) * (y2 - oy) - (x2 - ox) * (y1 - oy)
            return {"a": acc["a"] + c, "mx": acc["mx"] + c * (x1 + x2 - 2 * ox), "my": acc["my"] + c * (y1 + y2 - 2 * oy)}

        total = _along(ring, {"a": F.lit(0.0), "mx": F.lit(0.0), "my": F.lit(0.0)}, add)
        return let(
            total,
            lambda t: F.struct(
                (weight * F.abs(t["a"])).alias("a"),
                (weight * F.signum(t["a"]) * t["mx"]).alias("mx"),
                (weight * F.signum(t["a"]) * t["my"]).alias("my"),
            ),
        )

    per_ring = F.flatten(
        F.transform(
            geom,
            lambda part: F.transform(
                part, lambda ring, i: moments(ring, F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)))
            ),
        )
    )
    return F.aggregate(
        per_ring,
        F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my")),
        lambda acc, t: F.struct(
            (acc["a"] + t["a"]).alias("a"), (acc["mx"] + t["mx"]).alias("mx"), (acc["my"] + t["my"]).alias("my")
        ),
        lambda acc: F.struct(
            (ox + F.try_divide(acc["mx"], 3 * acc["a"])).alias("x"),
            (oy + F.try_divide(acc["my"], 3 * acc["a"])).alias("y"),
        ),
    )


def is_rectangle(geom: Column) -> Column:
    """True for one axis-parallel closed four-corner ring with positive area."""

    def aligned(a, b, c, d) -> Column:
        return (
            (a["y"] == b["y"]) & (b["x"] == c["x"]) & (c["y"] == d["y"]) & (d["x"] == a["x"])
            & (a["x"] != b["x"]) & (b["y"] != c["y"])
        )

    def check(all_rings):
        r = all_rings[0]
        corners = [r[i] for i in (0, 1, 2, 3, 0)]
        shape = F.when(
            F.size(all_rings) == 1,
            F.when(F.size(r) == 5, (r[4] == r[0]) & (aligned(*corners[:4]) | aligned(*corners[1:]))),
        )
        return F.coalesce(shape, F.lit(False))

    return F.coalesce(let(rings(geom), check), F.lit(False))


def closed_and_sized(geom: Column) -> Column:
    """Cheap validity: every ring is closed, has four or more vertices and encloses something."""
    return F.forall(
        rings(geom),
        lambda ring: (F.size(ring) >= 4)
        & (ring[0] == F.element_at(ring, -1))
        & (ring_signed_area(ring) != 0.0),
    )


def unusable(geom: Column) -> Column:
    """Why a geometry can't take part in an overlay, NULL if it can: the remarks of the overlay kernel."""

    def odd(v):
        return F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True))

    numbers = F.exists(vertices(geom), lambda v: odd(v["x"]) | odd(v["y"]))
    ring_open = F.exists(rings(geom), lambda ring: (F.size(ring) > 0) & (ring[0] != F.element_at(ring, -1)))
    return F.when(numbers, NO_NUMBER).when(ring_open, NOT_CLOSED)


def segments_cross(e: Column, f: Column) -> Column:
    """True when two segments cross at a point inside both."""

    def side(s, x, y):
        return F.signum((s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"]))

    across_e = side(e, f["x1"], f["y1"]) * side(e, f["x2"], f["y2"]) < 0
    return across_e & (side(f, e["x1"], e["y1"]) * side(f, e["x2"], e["y2"]) < 0)


CROSSING_BLOCK = 64  # edges compared as one block, in order of x


def self_crosses(geom: Column) -> Column:
    """True when segments of one ring that are not neighbours meet, or segments of two rings cross.

    Edges are sorted by x and compared in blocks, and only blocks whose ranges
    of x overlap, so a long outline costs little more than its length.
    """

    def numbered(ring, r):
        edge = lambda e, i: F.struct(
            F.least(e["x1"], e["x2"]).alias("lo"), F.greatest(e["x1"], e["x2"]).alias("hi"),
            r.alias("r"), i.alias("i"), (F.size(ring) - 1).alias("n"), e.alias("e"),
        )
        return F.transform(_ring_edges(ring), edge)

    def in_blocks(items):
        steps = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CROSSING_BLOCK).cast("int"))
        parts = F.transform(steps, lambda k: F.slice(items, k * CROSSING_BLOCK + 1, CROSSING_BLOCK))
        return F.transform(
            parts,
            lambda part, k: F.struct(
                k.alias("k"), part[0]["lo"].alias("lo"), F.array_max(F.transform(part, lambda p: p["hi"])).alias("hi"), part.alias("items")
            ),
        )

    def clash(p, q):
        apart = F.abs(p["i"] - q["i"])
        own = (p["r"] == q["r"]) & (apart > 1) & (apart < p["n"] - 1) & segments_meet(p["e"], q["e"])
        return (p["lo"] <= q["hi"]) & (q["lo"] <= p["hi"]) & (own | ((p["r"] != q["r"]) & segments_cross(p["e"], q["e"])))

    def crossed(blocks):
        return F.exists(
            blocks,
            lambda a: F.exists(
                blocks,
                lambda b: (b["k"] >= a["k"])
                & (b["lo"] <= a["hi"])
                & F.exists(a["items"], lambda p: F.exists(b["items"], lambda q: clash(p, q))),
            ),
        )

    long_enough = F.filter(rings(geom), lambda ring: F.size(ring) >= 4)
    edges_ = F.flatten(F.transform(long_enough, numbered))
    some = F.coalesce(F.size(long_enough) > 0, F.lit(False))
    return F.when(geom.isNull(), F.lit(None)).when(some, let(F.array_sort(edges_), lambda items: let(in_blocks(items), crossed))).otherwise(False)


def segments_meet(e: Column, f: Column) -> Column:
    """Closed segments share a point (crossing, touching or overlapping)."""

    def side(s, x, y):
        return (s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"])

    boxes = (
        (F.least(e["x1"], e["x2"]) <= F.greatest(f["x1"], f["x2"]))
        & (F.least(f["x1"], f["x2"]) <= F.greatest(e["x1"], e["x2"]))
        & (F.least(e["y1"], e["y2"]) <= F.greatest(f["y1"], f["y2"]))
        & (F.least(f["y1"], f["y2"]) <= F.greatest(e["y1"], e["y2"]))
    )
    straddle_f = F.signum(side(e, f["x1"], f["y1"])) * F.signum(side(e, f["x2"], f["y2"])) <= 0
    straddle_e = F.signum(side(f, e["x1"], e["y1"])) * F.signum(side(f, e["x2"], e["y2"])) <= 0
    return boxes & straddle_f & straddle_e


def crossing_count(edge_list: Column, x: Column, y: Column) -> Column:
    """Number of segments crossed by the ray from (x, y) towards larger x."""
    return F.size(
        F.filter(
            edge_list,
            lambda e: ((e["y1"] <= y) != (e["y2"] <= y))
            & (e["x1"] + (y - e["y1"]) * F.try_divide(e["x2"] - e["x1"], e["y2"] - e["y1"]) > x),
        )
    )


def contains_point(geom: Column, x: Column, y: Column) -> Column:
    """Point inside or on the boundary of the geometry (even-odd over all rings)."""

    def test(given):
        segs, x, y = given["segs"], given["x"], given["y"]
        on_edge = F.exists(
            segs,
            lambda e: ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"]))
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])),
        )
        return on_edge | (crossing_count(segs, x, y) % 2 == 1)

    return let(F.struct(edges(geom).alias("segs"), x.alias("x"), y.alias("y")), test)


def _edges_near(geom: Column, box: Column) -> Column:
    return let(
        box,
        lambda b: F.filter(
            edges(geom),
            lambda e: (F.greatest(e["x1"], e["x2"]) >= b["minx"])
            & (F.least(e["x1"], e["x2"]) <= b["maxx"])
            & (F.greatest(e["y1"], e["y2"]) >= b["miny"])
            & (F.least(e["y1"], e["y2"]) <= b["maxy"]),
        ),
    )


def intersects(a: Column, b: Column) -> Column:
    """Exact polygon/polygon test; a shared boundary point counts."""

    def test(pair):
        p, q = pair["p"], pair["q"]
        crossing = let(
            F.struct(_edges_near(p, bbox(q)).alias("p"), _edges_near(q, bbox(p)).alias("q")),
            lambda near: F.exists(near["p"], lambda e: F.exists(near["q"], lambda f: segments_meet(e, f))),
        )
        p_in_q = F.exists(p, lambda part: contains_point(q, part[0][0]["x"], part[0][0]["y"]))
        q_in_p = F.exists(q, lambda part: contains_point(p, part[0][0]["x"], part[0][0]["y"]))
        return F.coalesce(crossing | p_in_q | q_in_p, F.lit(False))

    return let(F.struct(a.alias("p"), b.alias("q")), test)


def oriented(geom: Column) -> Column:
    """Shells counter-clockwise, holes clockwise."""
    return F.transform(
        geom,
        lambda part: F.transform(
            part,
            lambda ring, i: F.when((ring_signed_area(ring) < 0) == (i == 0), F.reverse(ring)).otherwise(ring),
        ),
    )


def overlap_area(a: Column, b: Column) -> Column:
    """Area of the intersection of two valid geometries.

    Each boundary segment carries the signed trapezoid between itself and a
    common base line; the indicator of a polygon is the sum of its trapezoids,
    so the shared area is the sum over segment pairs of the area below both.
    No clipping is needed, and holes, parts and concave shapes are covered.
    """

    def window(boxes):
        p, q = boxes["p"], boxes["q"]
        return F.struct(
            F.least(p["miny"], q["miny"]).alias("base"),
            F.greatest(p["minx"], q["minx"]).alias("left"),
            F.least(p["maxx"], q["maxx"]).alias("right"),
        )

    def spans(geom: Column, w: Column) -> Column:
        """Left-to-right segments inside the shared x range, signed by direction."""
        return F.transform(
            F.filter(
                edges(oriented(geom)),
                lambda e: (e["x1"] != e["x2"])
                & (F.greatest(e["x1"], e["x2"]) > w["left"])
                & (F.least(e["x1"], e["x2"]) < w["right"]),
            ),
            lambda e: F.struct(
                F.signum(e["x1"] - e["x2"]).alias("s"),
                F.least(e["x1"], e["x2"]).alias("xa"),
                (F.when(e["x1"] < e["x2"], e["y1"]).otherwise(e["y2"]) - w["base"]).alias("ya"),
                F.greatest(e["x1"], e["x2"]).alias("xb"),
                (F.when(e["x1"] < e["x2"], e["y2"]).otherwise(e["y1"]) - w["base"]).alias("yb"),
            ),
        )

    def height(s: Column, x: Column) -> Column:
        return s["ya"] + (x - s["xa"]) * (s["yb"] - s["ya"]) / (s["xb"] - s["xa"])

    def mean_height(h: Column) -> Column:
        d_lo, d_hi = h["e_lo"] - h["f_lo"], h["e_hi"] - h["f_hi"]
        low_lo, low_hi = F.least(h["e_lo"], h["f_lo"]), F.least(h["e_hi"], h["f_hi"])
        t = F.try_divide(d_lo, d_lo - d_hi)
        mid = h["e_lo"] + t * (h["e_hi"] - h["e_lo"])
        bent = ((low_lo + mid) * t + (mid + low_hi) * (1 - t)) / 2
        return F.when(d_lo * d_hi < 0, bent).otherwise((low_lo + low_hi) / 2)

    def below_both(e: Column, f: Column) -> Column:
        lo, hi = F.greatest(e["xa"], f["xa"]), F.least(e["xb"], f["xb"])
        heights = F.struct(
            height(e, lo).alias("e_lo"),
            height(e, hi).alias("e_hi"),
            height(f, lo).alias("f_lo"),
            height(f, hi).alias("f_hi"),
        )
        return F.when(hi > lo, e["s"] * f["s"] * (hi - lo) * let(heights, mean_height)).otherwise(F.lit(0.0))

    def total(sides):
        return F.aggregate(
            sides["a"],
            F.lit(0.0),
            lambda acc, e: acc + F.aggregate(sides["b"], F.lit(0.0), lambda part, f: part + below_both(e, f)),
        )

    def measure(pair):
        p, q = pair["p"], pair["q"]
        frame = let(F.struct(bbox(p).alias("p"), bbox(q).alias("q")), window)
        sides = let(frame, lambda w: F.struct(spans(p, w).alias("a"), spans(q, w).alias("b")))
        return F.greatest(let(sides, total), F.lit(0.0))

    return let(F.struct(a.alias("p"), b.alias("q")), measure)


def _clip_ring(ring: Column, axis: str, limit: Column, keep_less: bool) -> Column:
    """Keep the half plane on one side of an axis-parallel line."""
    other = "y" if axis == "x" else "x"

    def inside(v):
        return (v[axis] <= limit) if keep_less else (v[axis] >= limit)

    def crossing(p, q):
        share = F.try_divide(limit - p[axis], q[axis] - p[axis])
        along = p[other] + share * (q[other] - p[other])
        return point(limit, along) if axis == "x" else point(along, limit)

    def walk(r):
        steps = F.size(r) - 1
        return F.flatten(
            F.zip_with(
                F.slice(r, F.lit(1), steps),
                F.slice(r, F.lit(2), steps),
                lambda p, q: F.when(inside(p) & inside(q), F.array(q))
                .when(inside(p), F.array(crossing(p, q)))
                .when(inside(q), F.array(crossing(p, q), q))
                .otherwise(F.array().cast("array<struct<x:double,y:double>>")),
            )
        )

    def close(walked):
        return F.when(F.size(walked) > 0, F.concat(F.array(F.element_at(walked, -1)), walked)).otherwise(walked)

    return let(ring, lambda r: F.when(F.size(r) > 1, let(walk(r), close)).otherwise(r))


def clip_to_box(geom: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Part of every ring inside an axis-parallel box.

    A concave ring may come back with coincident there-and-back segments on the
    box border. They enclose nothing: area, overlap and union cancel them.
    """

    def clip_all(given):
        box = given["box"]

        def clip(ring):
            for axis, limit, less in (("x", "maxx", True), ("x", "minx", False), ("y", "maxy", True), ("y", "miny", False)):
                ring = _clip_ring(ring, axis, box[limit], less)
            return ring

        clipped = F.transform(
            given["geom"], lambda part: F.filter(F.transform(part, clip), lambda ring: F.size(ring) >= 4)
        )
        return F.filter(clipped, lambda part: F.size(part) > 0)

    box = F.struct(minx.alias("minx"), miny.alias("miny"), maxx.alias("maxx"), maxy.alias("maxy"))
    return let(F.struct(geom.alias("geom"), box.alias("box")), clip_all)
