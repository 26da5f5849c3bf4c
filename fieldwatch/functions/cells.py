"""Points as cells of a space-filling (Z-order) curve, and boxes as ranges of cells.

A cell is the position of a square of a ``2 ** BITS`` x ``2 ** BITS`` grid over all
longitudes and latitudes along the curve, so near points mostly have near numbers, and
a box is covered by a few ranges of numbers. Stored in order of cell, a table's files
and row groups hold short ranges, and comparisons with constants reach their
statistics.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _step(value: Column, low: float, span: float) -> Column:
    """The number of the grid's column or row; what lies outside counts to the edge."""
    at = F.floor((value.cast("double") - F.lit(low)) / F.lit(span) * F.lit(1 << BITS))
    return F.least(F.greatest(at, F.lit(0)), F.lit((1 << BITS) - 1)).cast("long")


def _spread(value: Column) -> Column:
    """The bits of a number, a zero before each."""
    for shift, mask in _SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return value


def cell_of(lat: Column, lon: Column) -> Column:
    """The cell of a point (long; null without one)."""
    x, y = _step(lon, -180.0, 360.0), _step(lat, -90.0, 180.0)
    return F.when(lat.isNotNull() & lon.isNotNull(), _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1)))


def _grid(value: float, low: float, span: float) -> int:
    # the same operations as in _step, so the box's corners fall where its points do
    return min(max(math.floor((value - low) / span * (1 << BITS)), 0), (1 << BITS) - 1)


def cover(bbox: dict, most: int = 16) -> list[tuple[int, int]]:
    """At most ``most`` ranges (first, last) of cells that hold every point of the box,
    found by halving: squares inside the box stay whole, those across its edge are cut
    while there are ranges left."""
    x0, x1 = (_grid(bbox[k], -180.0, 360.0) for k in ("min_lon", "max_lon"))
    y0, y1 = (_grid(bbox[k], -90.0, 180.0) for k in ("min_lat", "max_lat"))
    if x0 > x1 or y0 > y1:
        return []
    squares = [(0, 0, 0, BITS)]  # first cell, column, row, halvings left

    def inside(sq):
        _, x, y, k = sq
        return x0 <= x and x + (1 << k) - 1 <= x1 and y0 <= y and y + (1 << k) - 1 <= y1

    while True:
        cut = [sq for sq in squares if sq[3] and not inside(sq)]
        if not cut:
            break
        nxt = [sq for sq in squares if sq not in cut]
        for first, x, y, k in cut:
            half = 1 << (k - 1)
            for q, (dx, dy) in enumerate(((0, 0), (half, 0), (0, half), (half, half))):
                if x + dx <= x1 and x + dx + half > x0 and y + dy <= y1 and y + dy + half > y0:
                    nxt.append((first + q * half * half, x + dx, y + dy, k - 1))
        ranges = _joined(nxt)
        if len(ranges) > most:
            break
        squares = nxt
    return _joined(squares)


def _joined(squares) -> list[tuple[int, int]]:
    out = []
    for first, _, _, k in sorted(squares):
        last = first + (1 << 2 * k) - 1
        if out and out[-1][1] + 1 == first:
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return out


def in_cover(cell: Column, ranges: list[tuple[int, int]]) -> Column:
    """Does the cell lie in one of the ranges? (comparisons with constants only)"""
    hit = F.lit(False)
    for k, (first, last) in enumerate(ranges):
        own = (cell == first) if first == last else (cell >= first) & (cell <= last)
        hit = own if k == 0 else hit | own
    return hit
