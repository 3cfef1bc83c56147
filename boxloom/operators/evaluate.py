"""Scoring predictions against ground truth.

Detections have ``image_id, label, det, score, x1..y2`` with ``det`` unique in an image; ground truth has
``image_id, label, gt, x1..y2`` with ``gt`` unique in an image.  A detection's best ground truth
does not depend on other detections, so matching is joins and aggregates; no image is
walked row by row and nothing is gathered.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import boxes as B
from boxloom.operators import curve
from boxloom.operators.greedy import leaders
from boxloom.operators.overlap import PAIR_LIMIT, best_match, overlap_pairs
from boxloom.operators.sampling import top_per_image

BOX = ["x1", "y1", "x2", "y2"]
# Overlap thresholds, area ranges of the common and of the fine-grained protocol
THRESHOLDS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]
AREAS = {"all": (0, 1e10), "small": (0, 32 ** 2), "medium": (32 ** 2, 96 ** 2), "large": (96 ** 2, 1e10)}
SIDES = [0, 8, 16, 24, 32, 48, 64, 80, 96, 128, 160, 192, 256]      # of the fine-grained ranges, each up to the next; the last is open
MORE_AREAS = {f"{a}-{b}": (a ** 2, b ** 2) for a, b in zip(SIDES, SIDES[1:], strict=False)} | {f"{SIDES[-1]}-": (SIDES[-1] ** 2, 1e10)}
FOLD_PAIRS = 100_000     # candidate pairs of one image and class that are walked in one go


def crowded(pred: DataFrame, gt: DataFrame) -> bool:
    """Whether some image has too many boxes for the plain per-image plans."""
    return any(scale.has_oversized(df, ["image_id"], PAIR_LIMIT) for df in (pred, gt))


def best_dets(pred: DataFrame, max_dets: int | None, keys: list[str]) -> DataFrame:
    """The best ``max_dets`` detections of each group; None: every detection."""
    return pred if max_dets is None else top_per_image(pred, max_dets, [F.col("score").desc(), F.col("det")], keys)


def match_detections(pred: DataFrame, gt: DataFrame, thresholds: list[float] = [0.5], hot: bool | None = None) -> DataFrame:
    """Right and wrong detections of each class at each threshold (arrays ``tp``, ``fp``).

    A detection looks at the ground truth of its class it overlaps most (inclusive pixels).  Above the
    threshold the first detection of a ground truth, by score, is right and later ones wrong; matches to
    ``difficult`` ground truth do not count; all others are wrong."""
    hot = crowded(pred, gt) if hot is None else hot
    hard = F.coalesce(F.col("r.difficult"), F.lit(False)) if "difficult" in gt.columns else F.lit(False)
    gcols = ["image_id", "label", "gt", *BOX] + (["difficult"] if "difficult" in gt.columns else [])
    keys = ["image_id", "label"]
    best = best_match(pred.select(*keys, "det", "score", *BOX), gt.select(*gcols), min(thresholds), ["det", "score"], ["gt"],
                      F.struct(F.col("r.gt").alias("gt"), hard.alias("hard")), keys=keys, strict=True, hot=hot
                      ).withColumnRenamed("match", "m")
    steps = F.array(*[F.lit(t) for t in thresholds])
    reached = F.size(F.filter(steps, lambda t: F.col("iou") > t))
    best = best.withColumn("_n", reached)
    first = (best.where(~F.col("m.hard")).withColumn("_t", F.explode(F.expr("sequence(1, _n)")))
             .groupBy(*keys, F.col("m.gt"), "_t").agg(F.min_by("det", F.struct(-F.col("score"), "det")).alias("det"))
             .groupBy(*keys, "det").agg(F.collect_set("_t").alias("_won")))
    best = best.select(*keys, "det", "_n", F.col("m.hard").alias("_hard"))
    out = pred.select("image_id", "label", "det", "score").join(best, [*keys, "det"], "left").join(first, [*keys, "det"], "left")
    won = lambda i: F.coalesce(F.array_contains("_won", i), F.lit(False))
    skip = lambda i: F.coalesce(F.col("_hard") & (F.col("_n") >= i), F.lit(False))
    n = len(thresholds)
    return out.select("image_id", "label", "det", "score",
                      F.array(*[won(i) for i in range(1, n + 1)]).alias("tp"),
                      F.array(*[~won(i) & ~skip(i) for i in range(1, n + 1)]).alias("fp"))


def positives(gt: DataFrame, keys: list[str] = ["label"]) -> DataFrame:
    """Ground truth per class that a detector should find."""
    real = gt.where(~F.coalesce("difficult", F.lit(False))) if "difficult" in gt.columns else gt
    return real.groupBy(*keys).agg(F.count("*").alias("npos"))


def pr_points(matches: DataFrame, npos: DataFrame, n: int, keys: list[str] = ["label"], hot: bool | None = None) -> DataFrame:
    """Precision and recall at each right detection, per class and threshold index ``t`` (from 0).

    One ordered pass serves all thresholds.  Wrong detections never raise precision at
    the same recall, so points at right ones are all that any average precision needs."""
    sums = {}
    for i in range(n):
        sums[f"_tp{i}"] = F.col("tp")[i].cast("long")
        sums[f"_fp{i}"] = F.col("fp")[i].cast("long")
    cum = scale.running(matches, keys, [F.col("score").desc(), F.col("image_id"), F.col("det")], sums=sums, hot=hot)
    point = F.array(*[F.when(F.col("tp")[i], F.struct(F.lit(i).alias("t"), F.col(f"_tp{i}").alias("tp"),
                                                      F.col(f"_fp{i}").alias("fp"))) for i in range(n)])
    flat = cum.select(*keys, F.explode(F.filter(point, lambda s: s.isNotNull())).alias("s")).select(*keys, "s.*")
    return flat.join(npos, keys).select(
        *keys, "t", "tp", "npos", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.col("npos")).alias("recall"))


def average_precision(points: DataFrame, npos: DataFrame, n: int, method: str = "area", keys: list[str] = ["label"],
                      hot: bool | None = None) -> DataFrame:
    """AP per class and threshold index, 0 where nothing was right.

    ``area``: under the precision envelope; ``eleven``/``hundred``: mean of the best precision at or beyond
    11 or 101 evenly spaced recalls."""
    if method == "area":
        env = scale.running(points, [*keys, "t"], [F.col("tp").desc()], maxima={"_e": F.col("precision")}, hot=hot)
        ap = env.groupBy(*keys, "t").agg((F.sum("_e") / F.max("npos")).alias("ap"))
    else:
        steps = 10 if method == "eleven" else 100
        at = (lambda k: k * 0.1) if method == "eleven" else (lambda k: k * 0.01)
        low = F.floor(F.col("recall") * steps).cast("int")
        k = F.when((low < steps) & (F.col("recall") >= at(low + 1)), low + 1).when(F.col("recall") < at(low), low - 1).otherwise(low)
        # best precision per recall step first: at most 101 rows per class stay
        per = points.select(*keys, "t", k.alias("k"), "precision").groupBy(*keys, "t", "k").agg(F.max("precision").alias("p"))
        ap = _mean_of_steps(per, steps, keys)
    return _with_all_states(ap, npos, n, keys)


def _mean_of_steps(per: DataFrame, steps: int, keys: list[str]) -> DataFrame:
    """``keys, t, ap`` from the best precision ``p`` of each recall step ``k`` that has one."""
    tail = F.max("p").over(Window.partitionBy(*keys, "t").orderBy(F.col("k").desc()))
    prev = F.lag("k", 1, -1).over(Window.partitionBy(*keys, "t").orderBy("k"))
    return per.select(*keys, "t", (tail * (F.col("k") - prev)).alias("s")).groupBy(*keys, "t").agg((F.sum("s") / (steps + 1)).alias("ap"))


def _with_all_states(ap: DataFrame, npos: DataFrame, n: int, keys: list[str]) -> DataFrame:
    grid = npos.select(*keys).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return grid.join(ap, [*keys, "t"], "left").withColumn("ap", F.coalesce("ap", F.lit(0.0)))


def voc_ap(pred: DataFrame, gt: DataFrame, thresholds: list[float] = [0.5], method: str = "area",
           hot: bool | None = None) -> DataFrame:
    """AP per class and threshold: ``label, threshold, ap``."""
    npos = positives(gt)
    n = len(thresholds)
    wide = scale.has_oversized(pred, ["label"], scale.WINDOW_LIMIT) if hot is None else hot
    ap = average_precision(pr_points(match_detections(pred, gt, thresholds, hot), npos, n, hot=wide), npos, n, method, hot=wide)
    return ap.select("label", F.array(*[F.lit(t) for t in thresholds])[F.col("t")].alias("threshold"), "ap")


def voc_map(pred: DataFrame, gt: DataFrame, method: str = "area", hot: bool | None = None) -> DataFrame:
    """AP over ten thresholds, AP50 and AP75, averaged over classes, in percent."""
    ap = voc_ap(pred, gt, THRESHOLDS, method, hot)
    pick = lambda t: F.avg(F.when(F.col("threshold") == t, F.col("ap"))) * 100
    return ap.agg((F.avg("ap") * 100).alias("ap"), pick(0.5).alias("ap50"), pick(0.75).alias("ap75"))


def simple_matches(pred: DataFrame, gt: DataFrame, iou: float = 0.5, hot: bool | None = None) -> DataFrame:
    """Right and wrong detections where each looks at the ground truth of *any* class it overlaps most.

    It is right if that one has its label, at ``iou`` or more (continuous pixels), and no better-scored
    detection took it."""
    hot = crowded(pred, gt) if hot is None else hot
    best = best_match(pred.select("image_id", "label", "det", "score", *BOX), gt.select("image_id", "label", "gt", *BOX), iou,
                      ["det", "score", "label"], ["gt"], F.struct(F.col("r.gt").alias("gt"), F.col("r.label").alias("label")),
                      inclusive=False, plus=1e-6, hot=hot).withColumnRenamed("match", "m")
    first = (best.where(F.col("m.label") == F.col("label")).groupBy("image_id", F.col("m.gt"))
             .agg(F.min_by("det", F.struct(-F.col("score"), "det")).alias("det")).select("image_id", "det", F.lit(True).alias("_w")))
    out = pred.select("image_id", "label", "det", "score").join(first, ["image_id", "det"], "left")
    right = F.coalesce("_w", F.lit(False))
    return out.select("image_id", "label", "det", "score", F.array(right).alias("tp"), F.array(~right).alias("fp"))


def simple_map(pred: DataFrame, gt: DataFrame, iou: float = 0.5, confidence: float = 0.0,
               hot: bool | None = None) -> DataFrame:
    """Per class, and overall (null ``label``): tp, fp, fn, precision, recall, F1 and 11-point AP; the
    overall AP is the mean over classes that have ground truth."""
    kept = pred.where(F.col("score") >= confidence)
    matches = simple_matches(kept, gt, iou, hot)
    npos = positives(gt)
    wide = scale.has_oversized(kept, ["label"], scale.WINDOW_LIMIT) if hot is None else hot
    ap = average_precision(pr_points(matches, npos, 1, hot=wide), npos, 1, "eleven").select("label", "ap")
    counts = matches.groupBy("label").agg(F.count_if(F.col("tp")[0]).alias("tp"), F.count_if(F.col("fp")[0]).alias("fp"))
    full = counts.join(npos, "label", "full").join(ap, "label", "left").select(
        "label", F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("fp", F.lit(0)).alias("fp"),
        F.coalesce("npos", F.lit(0)).alias("total_gt"), F.col("ap"))
    rolled = full.rollup("label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("total_gt").alias("total_gt"),
                                      F.coalesce(F.avg("ap"), F.lit(0.0)).alias("ap"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    p, r = zero(F.try_divide("tp", F.col("tp") + F.col("fp"))), zero(F.try_divide("tp", "total_gt"))
    return (rolled.withColumn("fn", F.col("total_gt") - F.col("tp")).withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))))


def proposal_recall(proposals: DataFrame, gt: DataFrame, limit: int = 100, areas: dict = AREAS,
                    thresholds: list[float] = THRESHOLDS, skip_empty: bool = False, hot: bool | None = None) -> DataFrame:
    """Average recall of the best ``limit`` proposals per image, by size of the ground truth.

    Proposals and ground truth are paired one to one, largest overlap first (continuous pixels).
    ``skip_empty`` leaves out the ground truth of images without any proposal."""
    hot = crowded(proposals, gt) if hot is None else hot
    top = top_per_image(proposals, limit, [F.col("score").desc(), F.col("det")])
    if skip_empty:
        gt = gt.join(top.select("image_id"), "image_id", "left_semi")
    size = F.coalesce(F.col("area"), B.area(B.cols())) if "area" in gt.columns else B.area(B.cols())
    ranges = F.array(*[F.struct(F.lit(k).alias("area_range"), F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi"))
                       for k, (a, b) in areas.items()])
    inside = F.transform(F.filter(ranges, lambda s: (size >= s["lo"]) & (size <= s["hi"])), lambda s: s["area_range"])
    sized = gt.select("image_id", "gt", *BOX, inside.alias("ranges"))
    pairs = overlap_pairs(top.select("image_id", "det", *BOX), sized, min(thresholds), inclusive=False, hot=hot)
    flat = pairs.select("image_id", F.explode("r.ranges").alias("area_range"), F.col("l.det").alias("det"),
                        F.col("r.gt").alias("gt"), "iou")
    taken = leaders(flat, ["image_id", "area_range"], [("iou", True), ("gt", False), ("det", False)], ["det", "gt"],
                    lambda k, m: (k["det"] == m["det"]) | (k["gt"] == m["gt"]),
                    F.array(F.concat(F.lit("d"), "det"), F.concat(F.lit("g"), "gt")), ["det", "gt"], hot=hot or None)      # pairs are more than boxes: counted
    npos = sized.select(F.explode("ranges").alias("area_range")).groupBy("area_range").agg(F.count("*").alias("npos"))
    found = taken.groupBy("area_range").agg(F.sum(F.size(F.filter(
        F.array(*[F.lit(t) for t in thresholds]), lambda t: F.col("iou") >= t))).alias("hits"))
    return npos.join(found, "area_range", "left").select(
        "area_range", F.lit(limit).alias("limit"), "npos",
        (F.coalesce("hits", F.lit(0)) / (F.col("npos") * len(thresholds))).alias("recall"))


def coco_matches(pred: DataFrame, gt: DataFrame, thresholds: list[float] = THRESHOLDS, areas: dict = AREAS,
                 max_dets: int | None = 100, hot: bool | None = None) -> DataFrame:
    """Right and wrong detections by the common evaluation protocol, per area range; of an image and class the best ``max_dets``
    detections take part, or, with None, all.

    Within an image and class, detections by score each take the free ground truth they overlap
    most; ground truth that is a crowd or outside the area range is taken only if no other fits, and makes the
    detection not count; a crowd is never used up.  Unmatched detections outside the range do not count.

    Choosing in turn equals walking all candidate pairs in order of (detection, preference) and accepting those whose two
    ends are free.  One walk does so for all thresholds and area ranges: each has a bit (``_walked``).  Pairs are counted
    first; an image and class with very many of them is settled in rounds over many tasks instead (``_settled``)."""
    found = _states(pred, gt, thresholds, areas, max_dets, hot)
    rng = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi")) for k, (a, b) in areas.items()])
    out = found.select("*", F.posexplode(rng).alias("_at", "a"))
    bit = lambda c: F.coalesce(F.get(c, F.col("_at")), F.lit(0).cast("long"))
    out = out.select("image_id", "label", "det", "score", F.col("a.name").alias("area_range"), bit("won").alias("_w"), bit("skipped").alias("_i"),
                     ((F.col("size") < F.col("a.lo")) | (F.col("size") > F.col("a.hi"))).alias("_out"))
    has = lambda c, t: F.col(c).bitwiseAND(F.lit(1 << t)) != 0
    n = range(len(thresholds))
    return out.select("image_id", "label", "det", "score", "area_range", F.array(*[has("_w", t) for t in n]).alias("tp"),
                      F.array(*[~has("_w", t) & ~has("_i", t) & ~F.col("_out") for t in n]).alias("fp"))


def _states(pred: DataFrame, gt: DataFrame, thresholds: list[float], areas: dict, max_dets: int | None, hot: bool | None) -> DataFrame:
    """Each detection once: ``image_id, label, det, score, size, won, skipped``, the last two as in ``_walked``, null where it takes nothing."""
    keys = ["image_id", "label"]
    wide = crowded(pred, gt) if hot is None else hot
    crowd = F.coalesce("iscrowd", F.lit(0)) == 1 if "iscrowd" in gt.columns else F.lit(False)
    size = F.col("area").cast("double") if "area" in gt.columns else B.area(B.cols())
    g = gt.select(*keys, "gt", *BOX, crowd.alias("crowd"), size.alias("area"))
    d = best_dets(pred, max_dets, keys).select(*keys, "det", "score", *BOX)
    low = min(thresholds)
    plain = overlap_pairs(d, g.where(~F.col("crowd")), low, keys=keys, inclusive=False, hot=wide)
    crowds = g.where("crowd")
    covered = (d.select(*keys, F.struct("det", "score", *BOX).alias("l"))
               .join(crowds.select(*keys, F.struct("gt", *BOX, "crowd", "area").alias("r")), keys)
               .withColumn("iou", B.ioa(B.of("r"), B.of("l"))).where(F.col("iou") >= low))
    steps = F.array(*[F.lit(t) for t in thresholds])
    level = F.size(F.filter(steps, lambda t: F.col("iou") >= F.least(t, F.lit(1 - 1e-10))))
    pairs = plain.unionByName(covered).select(*keys, F.col("l.det").alias("det"), F.col("l.score").alias("score"), F.col("r.gt").alias("gt"),
                                              F.col("r.crowd").alias("crowd"), F.col("r.area").alias("area"), "iou", level.alias("level")).where("level > 0")
    if hot is None:
        pairs = scale.checkpointed(pairs)
        many = scale.crowds(keys, FOLD_PAIRS, pairs)
        if many is None:
            won = _walked(pairs, keys, len(thresholds), areas)
        else:
            few, most = scale.apart(pairs, keys, many)
            won = _walked(few, keys, len(thresholds), areas).unionByName(_settled(most, keys, areas))
    else:
        won = _settled(pairs, keys, areas) if hot else _walked(pairs, keys, len(thresholds), areas)
    return d.join(won, [*keys, "det"], "left").select(*keys, "det", "score", B.area(B.cols()).alias("size"), "won", "skipped")


def _walked(pairs: DataFrame, keys: list[str], steps: int, areas: dict) -> DataFrame:
    """``keys, det, won, skipped``: per area range the thresholds (as bits) at which a detection takes counting ground truth, and
    other ground truth.

    Pairs come sorted by detection and overlap, one image and class after another, as a stream of batches.  All (area range,
    threshold) states are bits of one number: ``used`` holds those in which a ground truth is taken."""
    ranges = list(areas.values())
    full = (1 << steps) - 1
    rows = [sum(((1 << n) - 1) << i * steps for i in range(len(ranges))) for n in range(steps + 1)]     # states up to each level
    every = rows[steps]

    def run(batches):
        inside, used, own, key, det = {}, {}, [], None, None
        out = [[] for _ in range(len(keys) + 3)]

        def settle():
            done = won = 0
            for level, gt, counts, crowd in own:                       # ground truth that counts first
                free = rows[level] & counts & ~done & ~used.get(gt, 0)
                if free:
                    done |= free
                    won |= free
                    used[gt] = used.get(gt, 0) | free
            skipped = 0
            for level, gt, counts, crowd in own:
                free = rows[level] & every & ~counts & ~done & ~(0 if crowd else used.get(gt, 0))
                if free:
                    done |= free
                    skipped |= free
                    if not crowd:
                        used[gt] = used.get(gt, 0) | free
            if done:
                masks = [[m >> i * steps & full for i in range(len(ranges))] for m in (won, skipped)]
                for col, v in zip(out, (*key, det, *masks), strict=True):
                    col.append(v)
            own.clear()

        for b in batches:
            names, kinds = b.schema.names, b.schema.types
            for *k, d, level, gt, crowd, area in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if k != key or d != det:
                    settle()
                    if k != key:
                        used.clear()
                    key, det = k, d
                if (crowd, area) not in inside:
                    if len(inside) > 100_000:
                        inside.clear()
                    inside[crowd, area] = sum(full << i * steps for i, (lo, hi) in enumerate(ranges) if not crowd and lo <= area <= hi)
                own.append((level, gt, inside[crowd, area], crowd))
            bits = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [*kinds[:len(keys) + 1], bits, bits], strict=True)], [*names[:len(keys) + 1], "won", "skipped"])
            for col in out:
                col.clear()
        settle()
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [*kinds[:len(keys) + 1], bits, bits], strict=True)], [*names[:len(keys) + 1], "won", "skipped"])

    # by a column of their own: pairs may be a union that only says that it lies by ``keys``, and the layout would then be left out
    laid = scale.laid_out(pairs.withColumn("_at", F.xxhash64(*keys)), "_at").sortWithinPartitions(*keys, F.col("score").desc(), "det", F.col("iou").desc(), F.col("gt").desc())
    kinds = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in [*keys, "det"])
    return laid.select(*keys, "det", "level", "gt", "crowd", "area").mapInArrow(run, f"{kinds}, won array<long>, skipped array<long>")


def _settled(pairs: DataFrame, keys: list[str], areas: dict) -> DataFrame:
    """The same, each state by itself as greedy choice that needs no one task to hold an image and class."""
    rng = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi")) for i, (a, b) in enumerate(areas.values())])
    flat = pairs.withColumn("a", F.explode(rng)).withColumn("t", F.explode(F.sequence(F.lit(1), "level"))).select(
        *keys, F.col("a.i").alias("a"), "t", "det", "score", "gt", "crowd", "iou",
        (F.col("crowd") | (F.col("area") < F.col("a.lo")) | (F.col("area") > F.col("a.hi"))).cast("int").alias("ig"))
    taken = leaders(flat, [*keys, "a", "t"],
                    [("score", True), ("det", False), ("ig", False), ("iou", True), ("gt", True)], ["det", "gt", "crowd"],
                    lambda k, m: (k["det"] == m["det"]) | ((k["gt"] == m["gt"]) & ~k["crowd"]),
                    F.array(F.concat(F.lit("d"), "det"), F.concat(F.lit("g"), "gt")), ["det", "gt"], hot=True)
    bits = lambda i, ig: F.coalesce(F.sum(F.when((F.col("a") == i) & (F.col("ig") == ig), F.expr("shiftleft(1L, t - 1)"))), F.lit(0).cast("long"))
    n = range(len(areas))
    return taken.groupBy(*keys, "det").agg(F.array(*[bits(i, 0) for i in n]).alias("won"), F.array(*[bits(i, 1) for i in n]).alias("skipped"))


def _countable(gt: DataFrame, areas: dict) -> DataFrame:
    size = F.col("area").cast("double") if "area" in gt.columns else B.area(B.cols())
    real = gt.where(F.coalesce("iscrowd", F.lit(0)) == 0) if "iscrowd" in gt.columns else gt
    rng = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi"))
                    for k, (a, b) in areas.items()])
    return (real.withColumn("_s", size).withColumn("a", F.explode(rng)).where("_s >= a.lo and _s <= a.hi")
            .groupBy("label", F.col("a.name").alias("area_range")).agg(F.count("*").alias("npos")))


def coco_class_ap(pred: DataFrame, gt: DataFrame, thresholds: list[float] = THRESHOLDS, areas: dict = AREAS,
                  max_dets: int | None = 100, matches: DataFrame | None = None, hot: bool | None = None) -> DataFrame:
    """``label, area_range, threshold, ap`` with 101-point precision; pairs without ground truth are absent."""
    keys = ["label", "area_range"]
    npos = _countable(gt, areas)
    n = len(thresholds)
    if matches is None:
        # a row a detection for all ranges and thresholds: a row for each of them would be sorted and stored many times over
        bits = curve.packed(_states(pred, gt, thresholds, areas, max_dets, hot), areas, n)
        ap = _with_all_states(_mean_of_steps(curve.best_precision(bits, npos, areas, n), curve.STEPS, keys), npos, n, keys)
    else:
        wide = scale.has_oversized(pred, ["label"], scale.WINDOW_LIMIT) if hot is None else hot
        ap = average_precision(pr_points(matches, npos, n, keys, wide), npos, n, "hundred", keys, wide)
    return ap.select(*keys, F.array(*[F.lit(t) for t in thresholds])[F.col("t")].alias("threshold"), "ap")


def coco_ap(class_ap: DataFrame, areas: dict | None = None) -> DataFrame:
    """AP, AP50, AP75 and AP by size, in percent, from ``coco_class_ap``: one row per metric.  With ``areas``, each of those has
    its row; one without ground truth has no value."""
    everywhere = class_ap.where(F.col("area_range") == "all")
    over_all = everywhere.agg((F.avg("ap") * 100).alias("AP"),
                              (F.avg(F.when(F.col("threshold") == 0.5, F.col("ap"))) * 100).alias("AP50"),
                              (F.avg(F.when(F.col("threshold") == 0.75, F.col("ap"))) * 100).alias("AP75"))
    named = over_all.unpivot([], ["AP", "AP50", "AP75"], "metric", "value")
    sized = class_ap.where(F.col("area_range") != "all").groupBy(F.concat(F.lit("AP-"), "area_range").alias("metric")).agg(
        (F.avg("ap") * 100).alias("value"))
    if areas is not None:
        names = class_ap.sparkSession.createDataFrame([(f"AP-{k}",) for k in areas if k != "all"], "metric string")
        sized = names.join(sized, "metric", "left")
    return named.unionByName(sized)


def lvis_ap(pred: DataFrame, gt: DataFrame, frequency: DataFrame, negative: DataFrame, not_exhaustive: DataFrame,
            max_dets: int | None = 300, thresholds: list[float] = THRESHOLDS, hot: bool | None = None) -> DataFrame:
    """AP over all, rare, common and frequent classes for sparsely annotated images.

    A detection counts only if its class is annotated in, or known to be absent from (``negative``), its
    image; where a class is ``not_exhaustive``, unmatched detections of it do not count.  Of an image the best ``max_dets``
    detections take part, or, with None, all.
    ``frequency(label, frequency)`` with r, c or f comes with the category list."""
    checked = gt.select("image_id", "label").unionByName(negative.select("image_id", "label")).distinct()
    top = best_dets(pred, max_dets, ["image_id"]).join(checked, ["image_id", "label"], "left_semi")
    areas = {"all": AREAS["all"]}
    found = coco_matches(top, gt, thresholds, areas, max_dets, hot)
    loose = not_exhaustive.select("image_id", "label").distinct().withColumn("_l", F.lit(True))
    found = found.join(loose, ["image_id", "label"], "left").withColumn(
        "fp", F.transform("fp", lambda v: v & F.col("_l").isNull())).drop("_l")
    ap = coco_class_ap(pred, gt, thresholds, areas, max_dets, found, hot).join(scale.maybe_broadcast(frequency), "label", "left")
    mean = lambda f: (F.avg(F.when(F.col("frequency") == f, F.col("ap"))) * 100)
    return ap.agg((F.avg("ap") * 100).alias("ap"), mean("r").alias("ap_rare"), mean("c").alias("ap_common"),
                  mean("f").alias("ap_frequent"))


def segment_overlaps(pixels: DataFrame) -> DataFrame:
    """Pixels shared by each predicted and true segment: ``pixels(image_id, pred_seg, gt_seg)``."""
    return pixels.groupBy("image_id", "pred_seg", "gt_seg").agg(F.count("*").alias("n"))


def panoptic_quality(pixels: DataFrame, divisor: int = 1000, things: list[int] | None = None) -> DataFrame:
    """PQ, SQ and RQ per class and for all, things and stuff, in percent.

    A segment id is class times ``divisor`` plus instance; negative ids are unlabelled.  Segments match when
    of one class with IoU above one half, which at most one pair can have.  Unlabelled true pixels do not
    count against a prediction, and a prediction mostly on them is no error."""
    inter = segment_overlaps(pixels)
    pa = inter.where("pred_seg >= 0").groupBy("image_id", "pred_seg").agg(
        F.sum("n").alias("pa"), F.sum(F.when(F.col("gt_seg") < 0, F.col("n")).otherwise(0)).alias("void"))
    ga = inter.where("gt_seg >= 0").groupBy("image_id", "gt_seg").agg(F.sum("n").alias("ga"))
    cat = lambda c: F.floor(F.col(c) / divisor).cast("int")
    hits = (inter.where("pred_seg >= 0 and gt_seg >= 0").where(cat("pred_seg") == cat("gt_seg"))
            .join(pa, ["image_id", "pred_seg"]).join(ga, ["image_id", "gt_seg"])
            .withColumn("iou", F.col("n") / (F.col("pa") + F.col("ga") - F.col("n") - F.col("void"))).where("iou > 0.5"))
    tp = hits.groupBy(cat("gt_seg").alias("class")).agg(F.count("*").alias("tp"), F.sum("iou").alias("iou"))
    fp = (pa.where("void * 2 <= pa").join(hits.select("image_id", "pred_seg"), ["image_id", "pred_seg"], "left_anti")
          .groupBy(cat("pred_seg").alias("class")).agg(F.count("*").alias("fp")))
    fn = ga.join(hits.select("image_id", "gt_seg"), ["image_id", "gt_seg"], "left_anti").groupBy(
        cat("gt_seg").alias("class")).agg(F.count("*").alias("fn"))
    zero = F.lit(0)
    per = tp.join(fp, "class", "full").join(fn, "class", "full").select(
        "class", F.coalesce("tp", zero).alias("tp"), F.coalesce("fp", zero).alias("fp"), F.coalesce("fn", zero).alias("fn"),
        F.coalesce("iou", F.lit(0.0)).alias("iou"))
    base = F.col("tp") + F.col("fp") / 2 + F.col("fn") / 2
    per = per.select(F.col("class"), (100 * F.col("iou") / base).alias("pq"),
                     F.coalesce(F.try_divide(100 * F.col("iou"), F.col("tp")), F.lit(0.0)).alias("sq"), (100 * F.col("tp") / base).alias("rq"))
    group = F.array(F.lit("all"), F.when(F.col("class").isin(things or []), "things").otherwise("stuff"))
    means = per.withColumn("part", F.explode(group)).groupBy("part").agg(*[F.avg(c).alias(c) for c in ("pq", "sq", "rq")])
    return per.select(F.concat(F.lit("class-"), F.col("class").cast("string")).alias("part"), "pq", "sq", "rq").unionByName(means)


def boundary(labels: DataFrame, column: str, distance: int, height: int, width: int) -> DataFrame:
    """``column`` minus its smallest value within ``distance`` pixels (0 outside the image): what
    remains are the boundaries of regions.  Rows first, then columns: two narrow windows."""
    key = ["image_id"]
    across = F.min(column).over(Window.partitionBy(*key, "y").orderBy("x").rangeBetween(-distance, distance))
    down = F.min("_m").over(Window.partitionBy(*key, "x").orderBy("y").rangeBetween(-distance, distance))
    edge = (F.col("x") < distance) | (F.col("y") < distance) | (F.col("x") >= width - distance) | (F.col("y") >= height - distance)
    low = labels.withColumn("_m", across).withColumn("_m", down)
    return low.withColumn(f"{column}_boundary", F.col(column) - F.when(edge, 0).otherwise(F.col("_m"))).drop("_m")


def boundary_iou(pixels: DataFrame, n_classes: int, distance: int, height: int, width: int) -> DataFrame:
    """IoU per class counted on boundaries only, in percent."""
    from boxloom.operators.reports import class_scores

    both = boundary(boundary(pixels, "pred", distance, height, width), "gt", distance, height, width)
    conf = both.groupBy(F.col("pred_boundary").alias("pred"), F.col("gt_boundary").alias("gt")).agg(F.count("*").alias("n"))
    return class_scores(conf, n_classes).select("class", F.col("iou").alias("boundary_iou"))


def verify_metrics(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Each expected metric with whether it was met: ``expected(task, metric, expected, tolerance)``,
    ``actual(task, metric, value)``.  Missing and non-finite values fail."""
    v = F.col("value")
    ok = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")) & (F.abs(v - F.col("expected")) < F.col("tolerance"))
    return expected.join(actual, ["task", "metric"], "left").withColumn("ok", F.coalesce(ok, F.lit(False)))


def flatten_metrics(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """A map of maps of numbers as rows ``keys, name, value`` with names joined by ``/``."""
    outer = df.select(*keys, F.explode(column).alias("_a", "_m"))
    return outer.select(*keys, "_a", F.explode("_m").alias("_b", "value")).select(
        *keys, F.concat_ws("/", "_a", "_b").alias("name"), "value")
