"""Column expressions over boxes.

A box is anything with ``x1, y1, x2, y2`` fields: a struct column, a lambda
variable over structs, or the four columns of a table (``cols()``).  Three pixel
conventions occur in annotation data, so every overlap function names the one it
uses: ``inclusive`` boxes own their last pixel (width ``x2 - x1 + 1``);
continuous ones do not.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    x1: Column
    y1: Column
    x2: Column
    y2: Column


def cols(prefix: str = "", suffix: str = "") -> Box:
    """The box held by four columns of a table."""
    return Box(*[F.col(f"{prefix}{c}{suffix}") for c in ("x1", "y1", "x2", "y2")])


def of(struct: Column | str) -> Box:
    """The box held by a struct column or lambda variable."""
    s = F.col(struct) if isinstance(struct, str) else struct
    return Box(s["x1"], s["y1"], s["x2"], s["y2"])


def struct(b: Box) -> Column:
    return F.struct(b.x1.alias("x1"), b.y1.alias("y1"), b.x2.alias("x2"), b.y2.alias("y2"))


def _unit(inclusive: bool) -> float:
    return 1.0 if inclusive else 0.0


def area(b: Box, inclusive: bool = False) -> Column:
    u = _unit(inclusive)
    return (b.x2 - b.x1 + u) * (b.y2 - b.y1 + u) if inclusive else (b.x2 - b.x1) * (b.y2 - b.y1)


def intersection(a: Box, b: Box, inclusive: bool = False) -> Column:
    u = _unit(inclusive)
    w = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)
    h = F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    if inclusive:
        w, h = w + u, h + u
    zero = F.lit(0.0)
    return F.greatest(zero, w) * F.greatest(zero, h)


def iou(a: Box, b: Box, inclusive: bool = False, floor: float | None = None,
        plus: float | None = None) -> Column:
    """Intersection over union.

    ``floor``: smallest allowed union (guards empty boxes); ``plus``: a constant
    added to the union; with neither, an empty union gives 0.
    """
    inter = intersection(a, b, inclusive)
    union = area(a, inclusive) + area(b, inclusive) - inter
    if floor is not None:
        return inter / F.greatest(union, F.lit(floor))
    if plus is not None:
        return inter / (union + F.lit(plus))
    if inclusive:
        return inter / union
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def iou_at_least(a: Box, b: Box, t: float, inclusive: bool = False, strict: bool = False) -> Column:
    """``iou(a, b) >= t`` (or ``>`` with ``strict``)."""
    inter = intersection(a, b, inclusive)
    union = area(a, inclusive) + area(b, inclusive) - inter
    value = F.try_divide(inter, union)
    hit = value > t if strict else value >= t
    return F.coalesce(hit, F.lit(False))


def dice(a: Box, b: Box, inclusive: bool = True) -> Column:
    total = area(a, inclusive) + area(b, inclusive)
    return F.coalesce(F.try_divide(2.0 * intersection(a, b, inclusive), total), F.lit(0.0))


def dice_implied(iou_t: float, dice_t: float) -> bool:
    """Dice is 2*iou/(1+iou): an IoU threshold may make the Dice test redundant."""
    return 2 * iou_t / (1 + iou_t) >= dice_t


def ioa(a: Box, b: Box, inclusive: bool = False) -> Column:
    """Share of ``b`` that ``a`` covers."""
    return F.coalesce(F.try_divide(intersection(a, b, inclusive), area(b, inclusive)), F.lit(0.0))


def center(b: Box) -> tuple[Column, Column]:
    return (b.x1 + b.x2) / 2, (b.y1 + b.y2) / 2


def center_distance(a: Box, b: Box) -> Column:
    (ax, ay), (bx, by) = center(a), center(b)
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def inside(a: Box, b: Box) -> Column:
    """``a`` lies within ``b`` (edges may touch)."""
    return (a.x1 >= b.x1) & (a.y1 >= b.y1) & (a.x2 <= b.x2) & (a.y2 <= b.y2)


def inside_image(b: Box, width, height, tolerance: float = 0.0) -> Column:
    return ((b.x1 >= -tolerance) & (b.y1 >= -tolerance)
            & (b.x2 < width + F.lit(tolerance)) & (b.y2 < height + F.lit(tolerance)))


def clip(b: Box, width, height) -> Box:
    zero = F.lit(0.0)

    def fit(v, top):
        return F.least(F.greatest(v, zero), top)

    return Box(fit(b.x1, width), fit(b.y1, height), fit(b.x2, width), fit(b.y2, height))


def nonempty(b: Box, threshold: float = 0.0) -> Column:
    return (b.x2 - b.x1 > threshold) & (b.y2 - b.y1 > threshold)


def scale(b: Box, sx, sy) -> Box:
    return Box(b.x1 * sx, b.y1 * sy, b.x2 * sx, b.y2 * sy)


def shift(b: Box, dx, dy) -> Box:
    return Box(b.x1 + dx, b.y1 + dy, b.x2 + dx, b.y2 + dy)


def from_xywh(x, y, w, h) -> Box:
    return Box(x, y, x + w, y + h)


def to_xywh(b: Box) -> tuple[Column, Column, Column, Column]:
    return b.x1, b.y1, b.x2 - b.x1, b.y2 - b.y1


def from_cxcywh(cx, cy, w, h, width=1.0, height=1.0) -> Box:
    """Center form, normalised by image size, to corners in pixels."""
    return Box((cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height)


def from_rotated(cx, cy, w, h, degrees) -> Box:
    """Smallest upright box around a rotated one."""
    t = F.radians(degrees)
    c, s = F.abs(F.cos(t)), F.abs(F.sin(t))
    bw, bh = c * w + s * h, c * h + s * w
    return Box(cx - bw / 2, cy - bh / 2, cx + bw / 2, cy + bh / 2)


def point_edge_distances(px, py, b: Box) -> tuple[Column, Column, Column, Column]:
    """Signed distances of a point to the left, top, right and bottom edges."""
    return px - b.x1, py - b.y1, b.x2 - px, b.y2 - py


# Grid cells.  Each function gives an array of cell numbers so that two boxes for which
# the named relation holds share at least one of them.

def iou_cells(b: Box, t: float, pad: float = 0.0) -> Column:
    """Cells for boxes with IoU of at least ``t``.

    Such boxes have widths and heights within a factor ``t`` of each other and their corners lie closer than
    ``1 - t`` of the larger side.  So sizes are put in steps of that factor, corners on a grid as fine as
    the step allows, and a box names its own and the next step and cell in each direction: 16 cells,
    whatever its size.  ``pad``: half a pixel for inclusive boxes."""
    base = (1.0 / t) * (1 + 1e-6)
    near = max(1.0 - t, 1e-3) * (1 + 1e-6)

    def axis(lo, hi):
        side = F.greatest(hi - lo + 2 * pad, F.lit(1e-6))
        step = F.floor(F.log(side) / math.log(base)).cast("int")
        out = []
        for s in (0, 1):
            grid = F.pow(F.lit(base), step + s + 1) * near
            at = F.floor(lo / grid)
            out += [(step + s, at), (step + s, at + 1)]
        return out

    return F.array(*[F.xxhash64(sx, i, sy, j) for sx, i in axis(b.x1, b.x2) for sy, j in axis(b.y1, b.y2)])


def touch_cells(b: Box, tile: float = 64.0, pad: float = 1.0) -> Column:
    """Cells for boxes that intersect: all tiles a box touches on one fixed grid."""

    def span(lo, hi):
        return F.sequence(F.floor((lo - pad) / tile).cast("long"),
                          F.greatest(F.floor((lo - pad) / tile), F.floor((hi + pad) / tile)).cast("long"))

    return F.flatten(F.transform(span(b.x1, b.x2), lambda i: F.transform(
        span(b.y1, b.y2), lambda j: F.xxhash64(i, j))))


def near_cells(b: Box, distance: float) -> Column:
    """Cells for boxes whose centers are closer than ``distance``."""
    cx, cy = center(b)
    i, j = F.floor(cx / distance), F.floor(cy / distance)
    return F.array(*[F.xxhash64(i + di, j + dj) for di in (0, 1) for dj in (0, 1)])
