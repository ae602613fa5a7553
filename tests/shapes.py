"""Small reference implementations on plain coordinate lists."""

import math


def square(x, y, size=1.0, height=None):
    h = size if height is None else height
    return [[[(x, y), (x + size, y), (x + size, y + h), (x, y + h), (x, y)]]]


def frame(df_spark, rows, columns="id long, geom array<array<array<struct<x:double,y:double>>>>"):
    return df_spark.createDataFrame(rows, columns)


def as_geom(parts):
    return [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts]


def triangle(rng, spread=100.0, size=20.0):
    x, y = rng.random() * spread, rng.random() * spread
    pts = [(x + rng.random() * size, y + rng.random() * size) for _ in range(3)]
    (ax, ay), (bx, by), (cx, cy) = pts
    if (bx - ax) * (cy - ay) - (cx - ax) * (by - ay) < 0:
        pts.reverse()
    return [[[*pts, pts[0]]]]


def convex_clip_area(a, b):
    """Sutherland-Hodgman area of two convex rings."""
    out = list(a[0][0][:-1])
    ring = b[0][0]
    for (px, py), (qx, qy) in zip(ring, ring[1:]):
        source, out = out, []
        for i, (x, y) in enumerate(source):
            lx, ly = source[i - 1]
            d0 = (qx - px) * (ly - py) - (qy - py) * (lx - px)
            d1 = (qx - px) * (y - py) - (qy - py) * (x - px)
            if (d0 >= 0) != (d1 >= 0):
                t = d0 / (d0 - d1)
                out.append((lx + t * (x - lx), ly + t * (y - ly)))
            if d1 >= 0:
                out.append((x, y))
        if not out:
            return 0.0
    return abs(sum(out[i - 1][0] * y - x * out[i - 1][1] for i, (x, y) in enumerate(out))) / 2


def _to_segment(p, a, b):
    (x, y), (ax, ay), (bx, by) = p, a, b
    l2 = (bx - ax) ** 2 + (by - ay) ** 2
    t = 0 if l2 == 0 else max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / l2))
    return math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))


def convex_distance(a, b):
    if convex_clip_area(a, b) > 0:
        return 0.0
    ra, rb = a[0][0], b[0][0]
    one = min(_to_segment(p, s, e) for p in ra for s, e in zip(rb, rb[1:]))
    return min(one, min(_to_segment(p, s, e) for p in rb for s, e in zip(ra, ra[1:])))


def components(count, linked):
    label = list(range(count))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in linked:
        a, b = root(i), root(j)
        label[max(a, b)] = min(a, b)
    return [root(i) for i in range(count)]
