"""Joins on box overlap: pairs, first match and best match within an image."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import boxes as B

PAIR_LIMIT = 500   # boxes of one image beyond which pairs are found through grid cells


BOX = ["x1", "y1", "x2", "y2"]


def overlap_pairs(a: DataFrame, b: DataFrame, iou: float, *, keys: list[str] = ["image_id"],
                  inclusive: bool = True, strict: bool = False, dice: float = 0.0, plus: float | None = None,
                  hot: bool | None = None, extra: Column | None = None) -> DataFrame:
    """Pairs of boxes of one image whose overlap reaches the thresholds.

    Result: ``keys``, structs ``l`` and ``r`` with all other columns of each side, and ``iou``.
    Images with few boxes join on ``keys``; boxes of the others are spread over grid cells, so
    that one crowded image is joined by many tasks and far-apart boxes never meet; a pair
    sharing several cells is kept once, in the first cell both have.  ``hot`` puts all images on one of the two
    plans; by default each goes by its own count.  ``plus`` is added to the union."""
    if hot is None:
        crowded = scale.crowds(keys, PAIR_LIMIT, a, b)
        if crowded is not None:
            near, far = (overlap_pairs(x, y, iou, keys=keys, inclusive=inclusive, strict=strict, dice=dice, plus=plus, hot=h, extra=extra)
                         for x, y, h in zip(scale.apart(a, keys, crowded), scale.apart(b, keys, crowded), (False, True), strict=True))
            return near.unionByName(far)
    left = a.select(*keys, F.struct(*[c for c in a.columns if c not in keys]).alias("l"))
    right = b.select(*keys, F.struct(*[c for c in b.columns if c not in keys]).alias("r"))
    on = list(keys)
    if hot:
        pad = 0.5 if inclusive else 0.0

        def spread(df, s):
            cells = df.withColumn(f"_{s}", B.iou_cells(B.of(s), iou, pad))
            return cells.withColumn("_cell", F.explode(f"_{s}"))

        left, right = spread(left, "l"), spread(right, "r")
        on.append("_cell")
    lb, rb = B.of("l"), B.of("r")
    value = B.iou(lb, rb, inclusive, plus=plus)
    if plus is not None:
        cond = (value > iou) if strict else (value >= iou)
    else:
        cond = B.iou_at_least(lb, rb, iou, inclusive, strict)
    if dice and not (B.dice_implied(iou, dice) and not strict):
        d = B.dice(lb, rb, inclusive)
        cond = cond & ((d > dice) if strict else (d >= dice))
    pairs = left.join(right, on).where(cond)
    if extra is not None:
        pairs = pairs.where(extra)
    if hot:
        pairs = pairs.where(F.col("_cell") == F.array_min(F.array_intersect("_l", "_r")))
    return pairs.select(*keys, "l", "r", value.alias("iou"))


def _match(a: DataFrame, b: DataFrame, iou: float, a_id: list[str], b_order: list[str], value: Column, by_overlap: bool,
           keys: list[str], hot: bool | None, **pair) -> DataFrame:
    if hot is None:
        crowded = scale.crowds(keys, PAIR_LIMIT, a, b)
        if crowded is not None:
            near, far = (_match(x, y, iou, a_id, b_order, value, by_overlap, keys, h, **pair)
                         for x, y, h in zip(scale.apart(a, keys, crowded), scale.apart(b, keys, crowded), (False, True), strict=True))
            return near.unionByName(far)
        hot = False
    best = lambda c: F.struct(*([-F.col("iou")] if by_overlap else []), *[F.col(c)[o] for o in b_order])
    if not hot:
        pairs = overlap_pairs(a, b, iou, keys=keys, hot=False, **pair)
        return pairs.groupBy(*keys, *[F.col("l")[c].alias(c) for c in a_id]).agg(
            F.max("iou").alias("iou"), F.min_by(value, best("r")).alias("match"))
    # Copies on the left share their match and of copies on the right the first always wins, so
    # only distinct boxes are paired, however many copies a crowded image holds.
    rest = [c for c in b.columns if c not in keys and c not in BOX]
    first = b.groupBy(*keys, *BOX).agg(F.min_by(F.struct(*rest), F.struct(*b_order)).alias("_f")).select(*keys, *BOX, "_f.*")
    pairs = overlap_pairs(a.select(*keys, *BOX).distinct(), first, iou, keys=keys, hot=True, **pair)
    found = pairs.groupBy(*keys, *[F.col("l")[c].alias(c) for c in BOX]).agg(
        F.max("iou").alias("iou"), F.min_by(value, best("r")).alias("match"))
    return a.select(*keys, *a_id, *BOX).join(found, [*keys, *BOX]).select(*keys, *a_id, "iou", "match")


def first_match(a: DataFrame, b: DataFrame, iou: float, a_id: list[str], b_order: list[str], value: Column,
                *, keys: list[str] = ["image_id"], inclusive: bool = True, strict: bool = True,
                hot: bool | None = None) -> DataFrame:
    """For each row of ``a`` the first row of ``b`` (by ``b_order``) that overlaps enough:
    ``keys``, ``a_id`` and ``value`` (an expression over ``r``) as ``match``."""
    return _match(a, b, iou, a_id, b_order, value, False, keys, hot, inclusive=inclusive, strict=strict).drop("iou")


def best_match(a: DataFrame, b: DataFrame, iou: float, a_id: list[str], b_order: list[str], value: Column,
               *, keys: list[str] = ["image_id"], inclusive: bool = True, strict: bool = False,
               dice: float = 0.0, plus: float | None = None, hot: bool | None = None) -> DataFrame:
    """For each row of ``a`` the row of ``b`` of highest IoU, earliest by ``b_order`` on ties,
    among those that overlap enough: ``keys``, ``a_id``, ``iou`` and ``value`` as ``match``."""
    return _match(a, b, iou, a_id, b_order, value, True, keys, hot, inclusive=inclusive, strict=strict, dice=dice, plus=plus)
