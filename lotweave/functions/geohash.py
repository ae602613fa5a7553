"""Geohash of points and of bounding-box centres as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotweave.functions.crs import reproject, reproject_point
from lotweave.functions.geometry import bbox, centroid, let, point

# The geohash alphabet and the base-32 digits it replaces.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _spread_step(shift: int, mask: int):
    return lambda b: b.bitwiseOR(F.shiftleft(b, shift)).bitwiseAND(F.lit(mask))


def _spread(v: Column) -> Column:
    """Put bit j of a value below 2**32 at position 2j."""
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        v = let(v, _spread_step(shift, mask))
    return v


def geohash_point(spot: Column, length: int) -> Column:
    """Geohash of a longitude/latitude point: quantise, interleave, write in base 32."""
    bits = 5 * length
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2

    def cell(value, low, span, n):
        top = F.lit((1 << n) - 1)
        return F.least(F.greatest(F.floor((value - low) / span * float(1 << n)), F.lit(0)), top).cast("long")

    def digits(spot):
        x = _spread(cell(spot["x"], -180.0, 360.0, lon_bits))
        y = _spread(cell(spot["y"], -90.0, 180.0, lat_bits))
        mixed = x.bitwiseOR(F.shiftleft(y, 1)) if bits % 2 else y.bitwiseOR(F.shiftleft(x, 1))
        return F.lpad(F.conv(mixed.cast("string"), 10, 32), length, "0")

    return F.translate(let(spot, digits), DIGITS, ALPHABET)


def geohash_degrees(lon: Column, lat: Column, length: int) -> Column:
    return geohash_point(point(lon, lat), length)


def geohash_box(geom: Column, length: int = 11, srid: int = 3857) -> Column:
    """Geohash of the centre of the geometry's longitude/latitude bounding box."""
    # each axis of these two is moved by itself and keeps its order, so the corners of the box do for all vertices
    axes_alone = srid in (3857, 4326)

    def corner(box, x, y):
        spot = point(box[x], box[y])
        return reproject_point(spot, srid, 4326) if axes_alone else spot

    def centre(box):
        return let(
            F.struct(corner(box, "minx", "miny").alias("low"), corner(box, "maxx", "maxy").alias("high")),
            lambda c: point((c["low"]["x"] + c["high"]["x"]) / 2, (c["low"]["y"] + c["high"]["y"]) / 2),
        )

    middle = let(bbox(geom if axes_alone else reproject(geom, srid, 4326)), centre)
    return geohash_point(middle, length)


def geohash_centroid(geom: Column, length: int = 11, srid: int = 3857) -> Column:
    """Geohash of the planar centroid."""
    return geohash_point(reproject_point(centroid(geom), srid, 4326), length)
