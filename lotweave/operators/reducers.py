"""What is computed from the pixels of a zone: reducers in three steps, and the raster tile they see.

A ``Tile`` is a window of the raster with the pixel blocks of the zones in it. Prefix counts and sparse tables of
minima and maxima are made once a tile; then a block costs four look-ups whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np

MISSING = -(1 << 31)
PIECE = 1 << 20
KEPT = 16  # classes whose prefix counts tiles of the same pixels share
FOREST_CLASS = 1

#: Zone numbers, one for each row of state, and the state's columns.
States = tuple[np.ndarray, Mapping[str, np.ndarray]]


class Tile:
    """``elevation`` (NaN: missing) and ``cover`` (``MISSING``) by line and column.

    Block ``i`` of ``zone[i]`` is ``length[i]`` pixels from ``first[i]`` in ``height[i]`` lines from ``line[i]``. Tiles
    of the same pixels hand each other what depends on these alone in ``shared``.
    """

    def __init__(
        self, elevation: np.ndarray, cover: np.ndarray, zone: np.ndarray, line: np.ndarray, first: np.ndarray, length: np.ndarray,
        height: np.ndarray | None = None, shared: dict | None = None,
    ):
        self.elevation, self.cover = elevation, cover
        self.zone, self.line, self.first, self.length = zone, line, first, length
        self.height = np.ones_like(length) if height is None else height
        self.zones = int(zone.max()) + 1 if len(zone) else 0
        self.shared = {} if shared is None else shared

    def counts(self, mask: np.ndarray) -> np.ndarray:
        """Pixels of each block that ``mask`` holds, by prefix counts."""
        return self._counted(_prefix(mask))

    def _counted(self, upto: np.ndarray) -> np.ndarray:
        top, bottom, left, right = self.line, self.line + self.height, self.first, self.first + self.length
        return upto[bottom, right] - upto[top, right] - upto[bottom, left] + upto[top, left]

    def extremes(self, values: np.ndarray, pick: np.ufunc) -> np.ndarray:
        """``np.minimum`` or ``np.maximum`` over each block, by sparse tables of as many lines and columns as powers of two."""
        tall, wide = (np.log2(np.maximum(n, 1)).astype(np.int64) for n in (self.height, self.length))
        out = np.empty(len(self.line), dtype=values.dtype)
        rows = values
        for k in range(int(tall.max(initial=-1)) + 1):
            level = np.flatnonzero(tall == k)
            table = rows
            for m in range(int(wide[level].max(initial=-1)) + 1):
                own = level[wide[level] == m]
                if len(own):
                    top, left = self.line[own], self.first[own]
                    bottom, right = top + self.height[own] - (1 << k), left + self.length[own] - (1 << m)
                    out[own] = pick(pick(table[top, left], table[top, right]), pick(table[bottom, left], table[bottom, right]))
                table = np.concatenate([pick(table[:, : -(1 << m)], table[:, 1 << m :]), table[:, -(1 << m) :]], axis=1)
            rows = np.concatenate([pick(rows[: -(1 << k)], rows[1 << k :]), rows[-(1 << k) :]])
        return out

    def by_zone(self, pick: np.ufunc, values: np.ndarray, start: float) -> np.ndarray:
        """Reduce the values of the blocks to one for each zone."""
        out = np.full(self.zones, start, dtype=values.dtype)
        pick.at(out, self.zone, values)
        return out

    @property
    def classes(self) -> np.ndarray:
        if "classes" not in self.shared:
            found = np.unique(self.cover)
            self.shared["classes"] = found[found != MISSING]
        return self.shared["classes"]

    def class_counts(self) -> States:
        """(zone, class, pixels) of every class that occurs in a zone."""
        zones, classes, pixels = [], [], []
        kept = self.shared if len(self.classes) <= KEPT else {}
        for c in self.classes:
            upto = kept[int(c)] if int(c) in kept else kept.setdefault(int(c), _prefix(self.cover == c))
            total = self.by_zone(np.add, self._counted(upto), 0)
            if kept is not self.shared:
                kept.clear()
            some = np.flatnonzero(total)
            zones.append(some)
            classes.append(np.full(len(some), c))
            pixels.append(total[some])
        if not zones:
            return np.zeros(0, np.int64), {"cls": np.zeros(0, np.int64), "pixels": np.zeros(0, np.int64)}
        return np.concatenate(zones), {"cls": np.concatenate(classes).astype(np.int64), "pixels": np.concatenate(pixels)}

    def pixels(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(zone, elevation, cover) of the pixels of whole runs, about ``PIECE`` pixels at a time."""
        own = np.repeat(np.arange(len(self.line)), self.height)
        row = self.line[own] + np.arange(len(own)) - np.repeat(np.cumsum(self.height) - self.height, self.height)
        width = self.elevation.shape[1]
        spot, length, zone = row * width + self.first[own], self.length[own], self.zone[own]
        elevation, cover = self.elevation.ravel(), self.cover.ravel()
        upto = np.cumsum(length)
        a = 0
        while a < len(upto):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PIECE, side="right")))
            n = length[a:b]
            at = np.repeat(spot[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield np.repeat(zone[a:b], n), elevation[at], cover[at]
            a = b


def _prefix(mask: np.ndarray) -> np.ndarray:
    """Pixels that ``mask`` holds above and left of each corner."""
    upto = np.zeros((mask.shape[0] + 1, mask.shape[1] + 1), dtype=np.int64)
    np.cumsum(mask, axis=1, out=upto[1:, 1:])
    np.cumsum(upto[1:], axis=0, out=upto[1:])
    return upto


def summed(zone: np.ndarray, by: np.ndarray, values: np.ndarray) -> States:
    """Add up ``values`` by zone and ``by``, in order of both."""
    order = np.lexsort((by, zone))
    zone, by, values = zone[order], by[order], values[order]
    if not len(zone):
        return zone, {"by": by, "values": values}
    new = np.flatnonzero(np.concatenate(([True], (zone[1:] != zone[:-1]) | (by[1:] != by[:-1]))))
    return zone[new], {"by": by[new], "values": np.add.reduceat(values, new)}


class Reducer:
    """A user aggregate over the pixels of a zone.

    ``partial`` makes state rows from a tile, any number for a zone; ``merge`` shrinks the state rows of any zones and may
    run any number of times, first where they arise; ``finish`` makes the result rows of zones whose state is whole.
    ``state`` and ``result`` name the columns and their types. Zones come to ``partial`` whole and together up to
    ``pixels_at_once`` pixels, which bounds states that grow with pixels; None where they do not.
    """

    state: Mapping[str, str]
    result: Mapping[str, str]
    pixels_at_once: int | None = 1 << 24

    def partial(self, tile: Tile) -> States:
        raise NotImplementedError

    def merge(self, zone: np.ndarray, state: Mapping[str, np.ndarray]) -> States:
        raise NotImplementedError

    def finish(self, zone: np.ndarray, state: Mapping[str, np.ndarray]) -> States:
        raise NotImplementedError


class Statistics(Reducer):
    """Lowest and highest elevation cut to whole numbers (0 if there is none), pixels of class 1, pixels with any class."""

    state = {"lo": "float", "hi": "float", "forest": "long", "total": "long"}
    result = {"min_elev": "int", "max_elev": "int", "forest_pix": "long", "total_pix": "long"}
    pixels_at_once = None

    def partial(self, tile: Tile) -> States:
        missing = np.isnan(tile.elevation)
        low = tile.extremes(np.where(missing, np.float32(np.inf), tile.elevation), np.minimum)
        high = tile.extremes(np.where(missing, np.float32(-np.inf), tile.elevation), np.maximum)
        return np.arange(tile.zones), {
            "lo": tile.by_zone(np.minimum, low, np.inf),
            "hi": tile.by_zone(np.maximum, high, -np.inf),
            "forest": tile.by_zone(np.add, tile.counts(tile.cover == FOREST_CLASS), 0),
            "total": tile.by_zone(np.add, tile.counts(tile.cover != MISSING), 0),
        }

    def merge(self, zone: np.ndarray, state: Mapping[str, np.ndarray]) -> States:
        order = np.argsort(zone, kind="stable")
        zone = zone[order]
        new = np.flatnonzero(np.concatenate(([True], zone[1:] != zone[:-1])))
        picks = {"lo": np.minimum, "hi": np.maximum, "forest": np.add, "total": np.add}
        return zone[new], {name: pick.reduceat(state[name][order], new) for name, pick in picks.items()}

    def finish(self, zone: np.ndarray, state: Mapping[str, np.ndarray]) -> States:
        def whole(values: np.ndarray) -> np.ndarray:
            return np.where(np.isfinite(values), values, 0).astype(np.int32)

        return zone, {
            "min_elev": whole(state["lo"]), "max_elev": whole(state["hi"]), "forest_pix": state["forest"], "total_pix": state["total"]
        }


class Histogram(Reducer):
    """Pixels of every class that occurs; missing pixels have none."""

    state = {"cls": "long", "pixels": "long"}
    result = {"cls": "int", "pixels": "long"}
    pixels_at_once = None

    def partial(self, tile: Tile) -> States:
        return tile.class_counts()

    def merge(self, zone: np.ndarray, state: Mapping[str, np.ndarray]) -> States:
        zone, out = summed(zone, state["cls"], state["pixels"])
        return zone, {"cls": out["by"], "pixels": out["values"]}

    def finish(self, zone: np.ndarray, state: Mapping[str, np.ndarray]) -> States:
        return zone, {"cls": state["cls"].astype(np.int32), "pixels": state["pixels"]}


CELL = np.dtype([("value", "<f4"), ("count", "<u4")])


def sort_keys(zone: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Integers in the order of (zone, value as a float)."""
    bits = np.ascontiguousarray(values, dtype=np.float32).view(np.int32).astype(np.int64)
    return (zone.astype(np.int64) << 32) + np.where(bits < 0, -(bits & 0x7FFFFFFF), bits)


def packed(zone: np.ndarray, values: np.ndarray, counts: np.ndarray) -> States:
    """One row for each zone, its values and their counts as bytes; rows come grouped by zone."""
    begins = np.flatnonzero(np.concatenate(([True], zone[1:] != zone[:-1]))) if len(zone) else zone
    cells = np.empty(len(zone), dtype=CELL)
    cells["value"], cells["count"] = values, counts
    out = np.empty(len(begins), dtype=object)
    out[:] = [cells[s:e].tobytes() for s, e in zip(begins, [*begins[1:], len(cells)])]
    return zone[begins], {"cells": out}


def unpacked(zone: np.ndarray, blobs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(zone, value, count) of every cell."""
    cells = np.frombuffer(b"".join(blobs), dtype=CELL)
    sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // CELL.itemsize
    return np.repeat(zone, sizes), cells["value"].astype(np.float64), cells["count"].astype(np.int64)


class Quantiles(Reducer):
    """Exact quantiles of elevation, number of classes and commonest class (the lowest of equally common ones).

    The state counts elevations and classes, so it grows with the values that differ, not with pixels: one row for
    each zone and band, 8 bytes a value.
    """

    state = {"band": "int", "cells": "binary"}
    pixels_at_once = 1 << 22

    def __init__(self, quantiles: Mapping[str, float]):
        self.quantiles = dict(quantiles)
        self.result = {**dict.fromkeys(self.quantiles, "double"), "variety": "int", "majority": "int"}

    def partial(self, tile: Tile) -> States:
        zone, counted = tile.class_counts()
        order = np.argsort(zone, kind="stable")
        parts = [(1, *packed(zone[order], counted["cls"][order], counted["pixels"][order]))]
        for zone, elevation, _ in tile.pixels():
            known = ~np.isnan(elevation)
            key = np.sort(sort_keys(zone[known], elevation[known]))
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else key
            bits = (key[new] + (1 << 31)) % (1 << 32) - (1 << 31)
            value = np.where(bits < 0, (-bits) | 0x80000000, bits).astype(np.uint32).view(np.float32)
            parts.append((0, *packed((key[new] - bits) >> 32, value, np.diff(np.append(new, len(key))))))
        zones, cells = np.concatenate([p[1] for p in parts]), np.concatenate([p[2]["cells"] for p in parts])
        return zones, {"band": np.repeat(np.array([p[0] for p in parts], np.int32), [len(p[1]) for p in parts]), "cells": cells}

    def merge(self, zone: np.ndarray, state: Mapping[str, np.ndarray]) -> States:
        """Bytes of one zone and band become one row; equal values add up when the zone is whole."""
        order = np.lexsort((state["band"], zone))
        zone, band, cells = zone[order], state["band"][order], state["cells"][order]
        begins = np.flatnonzero(np.concatenate(([True], (zone[1:] != zone[:-1]) | (band[1:] != band[:-1]))))
        out = np.empty(len(begins), dtype=object)
        out[:] = [b"".join(cells[s:e]) for s, e in zip(begins, [*begins[1:], len(cells)])]
        return zone[begins], {"band": band[begins], "cells": out}

    def finish(self, zone: np.ndarray, state: Mapping[str, np.ndarray]) -> States:
        zones = np.unique(zone)
        out = {name: np.full(len(zones), np.nan) for name in self.quantiles}
        heights = state["band"] == 0
        at, value, count = unpacked(np.searchsorted(zones, zone[heights]), state["cells"][heights])
        order = np.argsort(sort_keys(at, value), kind="stable")  # cells come in sorted pieces
        at, value, count = at[order], value[order], count[order]
        if len(at):
            upto = np.cumsum(count)
            begins = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            before = np.concatenate(([0], upto))[begins]
            total = np.append(upto[begins[1:] - 1], upto[-1]) - before
            for name, q in self.quantiles.items():
                rank = q * (total - 1)
                low = value[np.searchsorted(upto, before + np.floor(rank) + 1)]
                high = value[np.searchsorted(upto, before + np.ceil(rank) + 1)]
                out[name][at[begins]] = low + (high - low) * (rank - np.floor(rank))
        at, cls, pixels = unpacked(np.searchsorted(zones, zone[~heights]), state["cells"][~heights])
        at, counted = summed(at, cls, pixels)
        cls, pixels = counted["by"], counted["values"]
        order = np.lexsort((cls, -pixels, at))
        first = order[np.flatnonzero(np.concatenate(([True], at[order][1:] != at[order][:-1])))] if len(order) else order
        majority = np.full(len(zones), np.nan)
        majority[at[first]] = cls[first]
        return zones, {**out, "variety": np.bincount(at, minlength=len(zones)).astype(np.int32), "majority": majority}
