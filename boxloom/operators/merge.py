"""Bringing the outputs of separate models together, image by image."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import boxes as B
from boxloom.functions import text as T
from boxloom.operators.overlap import best_match
from boxloom.scale import maybe_broadcast

BOX = ["x1", "y1", "x2", "y2"]


def merge_models(tables: dict[str, DataFrame]) -> DataFrame:
    """One long table of all detectors' boxes with a ``model`` column: a union, so no
    image is lost for lack of one model's output and nothing is shuffled."""
    return reduce(DataFrame.unionByName, [df.withColumn("model", F.lit(m)) for m, df in tables.items()])


def nested_predictions(df: DataFrame, part: int = 10_000) -> DataFrame:
    """Nested form: per image a map from model to its boxes in order.  Models with more than ``part`` boxes in
    an image continue in further rows, numbered by ``part``."""
    sliced = df.withColumn("part", F.floor(F.col("seq") / part).cast("int"))
    per = sliced.groupBy("image_id", "part", "model").agg(F.sort_array(F.collect_list(F.struct("seq", *BOX, "score", "label"))).alias("p"))
    return per.groupBy("image_id", "part").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("model", "p")))).alias("predictions"))


def merge_captions(captions: DataFrame, phrases: DataFrame) -> DataFrame:
    """Captions and the number of phrase boxes of every image that has either."""
    one = lambda s: F.max(F.when(F.col("source") == s, F.col("caption"))).alias(s)
    caps = captions.groupBy("image_id").agg(one("blip2"), one("llava"))
    n = phrases.groupBy("image_id").agg(F.count("*").alias("phrases"))
    return caps.join(n, "image_id", "full").withColumn("phrases", F.coalesce("phrases", F.lit(0)))


def tag_vocabulary(images: DataFrame, first: DataFrame, second: DataFrame, extra: tuple[str, ...] = ("trees",)) -> DataFrame:
    """Per image the distinct tags of two taggers, in order, and the ``extra`` ones at the end.
    Tag tables hold one row per image: ``(image_id, tags)``."""
    none = F.array().cast("array<string>")
    joined = (images.select("image_id").join(first.select("image_id", F.col("tags").alias("_a")), "image_id", "left")
              .join(second.select("image_id", F.col("tags").alias("_b")), "image_id", "left"))
    both = F.array_distinct(F.concat(F.coalesce("_a", none), F.coalesce("_b", none)))
    return joined.select("image_id", F.concat(both, F.array(*[F.lit(e) for e in extra])).alias("vocabulary"))


def choose_labels(objects: DataFrame, assigned: DataFrame) -> DataFrame:
    """Give each object one label: the assigned one, else its first; person words are generalised.
    Floating objects get none.  ``assigned(image_id, id, label)``."""
    joined = objects.join(assigned.select("image_id", "id", F.col("label").alias("_l")), ["image_id", "id"], "left")
    pick = T.person_word(F.coalesce("_l", F.try_element_at("labels", F.lit(1))))
    return joined.withColumn("label", F.when(F.col("kind") == "object", pick)).drop("_l")


def describe_classes(images: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Add the long description of each image's class as ``additional_context`` (null if unknown)."""
    dim = scale.maybe_broadcast(descriptions.select("class_name", F.col("description").alias("additional_context")))
    return images.join(dim, "class_name", "left")


def undescribed_classes(images: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Classes without description and how many images each has."""
    return images.join(descriptions.select("class_name"), "class_name", "left_anti").groupBy("class_name").agg(
        F.count("*").alias("images"))


def join_proposals(images: DataFrame, proposals: DataFrame, hot: bool | None = None) -> DataFrame:
    """Each image's proposals ranked by score.  Ids are compared as text, as both kinds occur."""
    ids = images.select(F.col("image_id").cast("string").alias("_id"), "image_id")
    joined = proposals.withColumn("_id", F.col("image_id").cast("string")).drop("image_id").join(ids, "_id").drop("_id")
    return scale.running(joined, ["image_id"], [F.col("score").desc(), F.col("priority"), F.col("seq")],
                         number="rank", hot=hot)


def merge_panoptic(detection: DataFrame, semantic: DataFrame, key: str = "file_name") -> DataFrame:
    """Detection and semantic records of the same file; where both have a column the semantic one wins."""
    both = [c for c in detection.columns if c in semantic.columns and c != key]
    left = detection.select(*[F.col(c).alias(f"_d_{c}") if c in both else F.col(c) for c in detection.columns])
    joined = left.join(semantic, key)
    return joined.select(key, *[F.coalesce(c, f"_d_{c}").alias(c) for c in both],
                         *[c for c in left.columns if c != key and not c.startswith("_d_")],
                         *[c for c in semantic.columns if c != key and c not in both])


def add_masks(objects: DataFrame, sources: dict[str, DataFrame], iou: float = 0.65, dice: float = 0.75,
              hot: bool | None = None) -> DataFrame:
    """Give each object the mask whose box fits best, from the first source that has a fitting one.

    ``sources``: name to ``(image_id, seq, box, segmentation)``, in order of preference.  A mask fits
    at IoU and Dice at least the thresholds (inclusive pixels); of equal fits the first counts.  The
    mask's box replaces the object's and ``segmentation_source`` names its source."""
    picked = None
    for rank, (name, masks) in enumerate(sources.items()):
        value = F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("source"), *[F.col("r")[c].alias(c) for c in BOX],
                         F.col("r")["segmentation"].alias("segmentation"))
        best = best_match(objects.select("image_id", "id", *BOX), masks.select("image_id", "seq", *BOX, "segmentation"),
                          iou, ["id"], ["seq"], value, dice=dice, hot=hot).select("image_id", "id", "match")
        picked = best if picked is None else picked.unionByName(best)
    first = picked.groupBy("image_id", "id").agg(F.min_by("match", "match.rank").alias("m"))
    out = objects.join(first, ["image_id", "id"], "left")
    return out.select(*[c for c in objects.columns if c not in BOX],
                      *[F.coalesce(F.col("m")[c], F.col(c)).alias(c) for c in BOX],
                      F.col("m.segmentation").alias("segmentation"), F.col("m.source").alias("segmentation_source"))


def without_masks(objects: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Objects that still lack a mask; ``only`` keeps those in an id table (say, of grounded ids)."""
    out = objects.where(F.col("kind").isin("object", "floating") & F.col("segmentation").isNull())
    return out if only is None else out.join(only, ["image_id", "id"], "left_semi")


def update_masks(objects: DataFrame, found: DataFrame, source: str = "HQ_SAM") -> DataFrame:
    """Fill in masks found later: ``found(image_id, id, segmentation)``."""
    joined = objects.join(found.select("image_id", "id", F.col("segmentation").alias("_s")), ["image_id", "id"], "left")
    use = F.col("segmentation").isNull() & F.col("_s").isNotNull()
    return (joined.withColumn("segmentation_source", F.when(use, source).otherwise(F.col("segmentation_source")))
            .withColumn("segmentation", F.coalesce("segmentation", "_s")).drop("_s"))


def grounded_ids(short: DataFrame, dense: DataFrame) -> DataFrame:
    """Distinct object ids that any caption mentions."""
    return (short.select("image_id", "id").unionByName(
        dense.select("image_id", F.explode("object_ids").alias("id"))).distinct())


def depth_cells(depth: DataFrame, cell: int = 32, bins: int = 32) -> tuple[DataFrame, DataFrame]:
    """A depth map in two levels, from its non-zero pixels.

    The pixels, as (image_id, x, y, value, tx, ty, bin): ``bin`` numbers value ranges of the image that hold about equally many
    pixels.  And one row per tile and bin that has some: (image_id, tx, ty, bin, n, vals), vals with each value and how often it occurs.
    """
    some = depth.where("value <> 0")
    cuts = some.groupBy("image_id").agg(F.percentile_approx("value", [i / bins for i in range(1, bins)], 1000).alias("_cuts"))
    pixels = some.join(maybe_broadcast(cuts), "image_id").select(
        "image_id", "x", "y", "value", F.expr(f"cast(x div {cell} as bigint)").alias("tx"), F.expr(f"cast(y div {cell} as bigint)").alias("ty"),
        F.size(F.filter("_cuts", lambda c: c < F.col("value"))).alias("bin"))
    tile = ["image_id", "tx", "ty", "bin"]
    cells = pixels.groupBy(*tile, "value").agg(F.count("*").alias("n")).groupBy(*tile).agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("value", "n")).alias("vals"))
    return pixels, cells


def summed_tiles(cells: DataFrame, bins: int = 32) -> DataFrame:
    """(image_id, tx, ty, sums): for every tile up to the image's last, how many pixels of each bin lie in the tiles up to it in
    both directions."""
    at = ["image_id", "tx", "ty"]
    held = cells.groupBy(*at).agg(*[F.sum(F.when(F.col("bin") == i, F.col("n"))).alias(f"_{i}") for i in range(bins)])
    grid = held.groupBy("image_id").agg(F.max("tx").alias("mx"), F.max("ty").alias("my"))
    grid = grid.select("image_id", "my", F.explode(F.sequence(F.lit(0), "mx")).alias("tx")).select("image_id", "tx", F.explode(F.sequence(F.lit(0), "my")).alias("ty"))
    for here, along in (("ty", "tx"), ("tx", "ty")):
        w = Window.partitionBy("image_id", here).orderBy(along).rowsBetween(Window.unboundedPreceding, 0)
        held = (grid.join(held, at, "left") if here == "ty" else held).select(
            *at, *[F.coalesce(F.sum(f"_{i}").over(w), F.lit(0)).alias(f"_{i}") for i in range(bins)])
    return held.select(*at, F.array(*[f"_{i}" for i in range(bins)]).alias("sums"))


PIXELS = 2_000   # pixels (and boxes) of one image that are compared one by one


def median_depth(objects: DataFrame, depth: DataFrame, width: int | None = None, height: int | None = None,
                 cell: int = 32, bins: int = 32, hot: bool | None = None, few: int = PIXELS) -> DataFrame:
    """Median of the non-zero depth values in each box, to two decimals (null where there are none).

    Box corners are cut to integers and to the depth map; the box is half open.  ``depth(image_id, x, y,
    value)``; the map's size is given, or the largest pixel of each image tells it.

    The pixels of images with up to ``few``, which is counted, travel as one array to their boxes (``_read``); other images, and those with
    more boxes, go by tiles (``_tiled``).  ``hot`` False says that no image holds many boxes; True puts all images on tiles."""
    return _by_pixels(objects, depth, hot, few, width, height,
                      lambda o, d: _read(o, d, F.lit(True), width, height).select(*o.columns, F.explode_outer("_found").alias("_v")).select(
                          *o.columns, F.col("_v.depth").alias("depth")),
                      lambda o, d: _tiled(o, d, width, height, cell, bins))


def _by_pixels(objects: DataFrame, depth: DataFrame, hot: bool | None, few: int, width: int | None, height: int | None, read, tiled) -> DataFrame:
    """``read`` for the images with few pixels and boxes, ``tiled`` for the others."""
    objects = objects.select("image_id", "id", *[c for c in objects.columns if c not in ("image_id", "id")])
    if hot:
        return tiled(objects, depth)
    seen = depth.where("value <> 0")
    if width is not None and height is not None:
        seen = seen.where((F.col("x") < width) & (F.col("y") < height))
    crowded = scale.crowds(["image_id"], few, seen.select("image_id"), *([objects.select("image_id")] if hot is None else []))
    if crowded is None:
        return read(objects, depth)
    (near, far), (small, large) = (scale.apart(df, ["image_id"], crowded.where("image_id is not null")) for df in (objects, depth))
    return read(near, small).unionByName(tiled(far, large))


def _cut() -> dict:
    """Corners of a box in whole pixels of its map of ``_w`` by ``_h``."""
    zero = F.lit(0)
    return {"a": F.greatest(zero, F.col("x1").cast("int")), "b": F.greatest(zero, F.col("y1").cast("int")),
            "c": F.least("_w", F.col("x2").cast("int")), "d": F.least("_h", F.col("y2").cast("int"))}


def _read(objects: DataFrame, depth: DataFrame, wanted, width: int | None, height: int | None) -> DataFrame:
    """Adds ``_found``, the depths (as structs) of the ``wanted`` rows of the same image and id, and ``_asked``, how many such rows there are.

    An image's pixels are one array in order of value; what a box holds of it is in that order too, so its middle is the median.
    Rows stay in the layout by image and are made once."""
    if width is None or height is None:
        w, h = F.max("x") + 1, F.max("y") + 1
    else:
        w, h = F.lit(width), F.lit(height)
        depth = depth.where((F.col("x") < width) & (F.col("y") < height))
    maps = depth.groupBy("image_id").agg(w.alias("_w"), h.alias("_h"), F.sort_array(F.collect_list(
        F.when(F.col("value") != 0, F.struct("value", "x", "y")))).alias("_px"))
    want = wanted & F.col("image_id").isNotNull() & F.col("id").isNotNull()
    some = want & (F.size("_px") > 0)
    sized = objects.join(maps, "image_id", "left").select(
        *objects.columns, want.alias("_want"), "_px", *[F.when(some, c).alias(f"_{n}") for n, c in _cut().items()])
    inside = F.filter("_px", lambda p: (p["x"] >= F.col("_a")) & (p["x"] < F.col("_c")) & (p["y"] >= F.col("_b")) & (p["y"] < F.col("_d")))
    held = F.transform(inside, lambda p: p["value"])
    held = sized.select(*objects.columns, "_want", F.when((F.col("_c") > F.col("_a")) & (F.col("_d") > F.col("_b")), held).alias("_in"))
    at = lambda rank: F.get("_in", F.expr(f"cast({rank} as int)"))
    own = held.select(*objects.columns, "_want", F.when(F.size("_in") > 0, F.struct(
        _rounded(at("(size(_in) - 1) div 2"), at("size(_in) div 2")).alias("depth"))).alias("_own"))
    same = Window.partitionBy("image_id", "id")
    return own.withColumns({"_found": F.collect_list("_own").over(same), "_asked": F.count(F.when(F.col("_want"), 1)).over(same)}).drop("_own", "_want")


def _rounded(low, high):
    """The mean of two values to two decimals, through a decimal, so that noise in the last bits of the mean does not decide."""
    return F.round((low * 0.5 + high * 0.5).cast("decimal(24,6)"), 2).cast("double")


def _tiled(objects: DataFrame, depth: DataFrame, width: int | None, height: int | None, cell: int, bins: int) -> DataFrame:
    """Medians in two levels: how many pixels of each bin a box holds says in which bins its middle values lie; only those bins are looked into.
    Tiles inside a box count by four corners of the summed tiles, and their values come by tile and bin; only the rim of a box
    meets pixels.  So a box over a whole image costs its tiles, not its pixels.
    """
    if width is None or height is None:
        size = depth.groupBy("image_id").agg((F.max("x") + 1).alias("_w"), (F.max("y") + 1).alias("_h"))
        sized = objects.join(size, "image_id")
    else:
        sized = objects.withColumn("_w", F.lit(width)).withColumn("_h", F.lit(height))
        depth = depth.where((F.col("x") < width) & (F.col("y") < height))
    cut = sized.select("image_id", "id", *[c.alias(n) for n, c in _cut().items()], "_w", "_h").where("c > a and d > b")
    box = ["image_id", *"abcd"]
    # boxes with the same pixels share a median; it is taken once.  Tiles l to r, t to u lie inside; the map's edge cuts none of them off.
    inner = [F.expr(f"cast((a + {cell - 1}) div {cell} as bigint) as l"), F.expr(f"cast((b + {cell - 1}) div {cell} as bigint) as t"),
             F.expr(f"cast(if(c >= _w, (c - 1) div {cell}, c div {cell} - 1) as bigint) as r"),
             F.expr(f"cast(if(d >= _h, (d - 1) div {cell}, d div {cell} - 1) as bigint) as u")]
    boxes = scale.checkpointed(cut.select(*box, *inner).distinct())
    pixels, cells = depth_cells(depth, cell, bins)
    cells = scale.checkpointed(cells)
    rim = scale.checkpointed(_rim(boxes, pixels, cell))

    corners = F.array(*[F.struct((F.col(x) - dx).alias("tx"), (F.col(y) - dy).alias("ty"), F.lit(s).alias("s"))
                        for x, dx, y, dy, s in (("r", 0, "u", 0, 1), ("l", 1, "u", 0, -1), ("r", 0, "t", 1, -1), ("l", 1, "t", 1, 1))])
    last = cells.groupBy("image_id").agg(F.max("tx").alias("_mx"), F.max("ty").alias("_my"))
    sums = boxes.where("l <= r and t <= u").join(last, "image_id").select(*box, "_mx", "_my", F.explode(corners).alias("k")).where("k.tx >= 0 and k.ty >= 0").select(
        *box, F.least("k.tx", "_mx").alias("tx"), F.least("k.ty", "_my").alias("ty"), "k.s").join(summed_tiles(cells, bins), ["image_id", "tx", "ty"])
    sums = sums.select(*box, F.posexplode(F.transform("sums", lambda n: n * F.col("s"))).alias("bin", "n"))
    held = sums.union(rim.select(*box, "bin", "n")).groupBy(*box, "bin").agg(F.sum("n").alias("n")).where("n > 0")

    order = Window.partitionBy(*box).orderBy("bin")
    upto, every = F.sum("n").over(order), F.sum("n").over(Window.partitionBy(*box))
    middle = held.select(*box, "bin", (upto - F.col("n")).alias("low"), upto.alias("high"), every.alias("all")).where(
        "(all - 1) div 2 between low and high - 1 or all div 2 between low and high - 1")
    middle = scale.checkpointed(middle.select(*box, "bin", "low", "all"))                       # one or two bins a box

    tiles = boxes.where("l <= r and t <= u").join(middle.select(*box, "bin"), box).select(
        *box, "bin", "l", "r", F.explode(F.sequence("t", "u")).alias("ty")).select(*box, "bin", "ty", F.explode(F.sequence("l", "r")).alias("tx"))
    found = tiles.join(cells.drop("n"), ["image_id", "tx", "ty", "bin"]).select(*box, "bin", F.explode("vals").alias("v")).select(*box, "bin", "v.value", "v.n")
    found = found.union(rim.join(middle.select(*box, "bin"), [*box, "bin"]).select(*box, "bin", "value", "n"))
    found = found.groupBy(*box, "bin", "value").agg(F.sum("n").alias("n")).join(middle, [*box, "bin"])
    end = F.col("low") + F.sum("n").over(Window.partitionBy(*box, "bin").orderBy("value"))
    found = found.select(*box, "value", "all", (end - F.col("n")).alias("from"), end.alias("to"))
    at = lambda rank: F.max(F.when(F.expr(f"{rank} >= from and {rank} < to"), F.col("value")))
    med = found.groupBy(*box).agg(_rounded(at("(all - 1) div 2"), at("all div 2")).alias("depth"))
    per = cut.select("image_id", "id", *"abcd").join(med, box).select("image_id", "id", "depth")
    return objects.join(per, ["image_id", "id"], "left")


def _rim(boxes: DataFrame, pixels: DataFrame, cell: int) -> DataFrame:
    """(box, bin, value, n) of the pixels in boxes but not in the tiles inside them."""
    box = ["image_id", *"abcd"]
    tiles = boxes.withColumn("tx", F.explode(F.expr(f"sequence(cast(a div {cell} as bigint), cast((c - 1) div {cell} as bigint))")))
    whole = F.expr(f"sequence(cast(b div {cell} as bigint), cast((d - 1) div {cell} as bigint))")
    tiles = tiles.withColumn("ty", F.explode(F.when(F.col("tx").between(F.col("l"), F.col("r")), F.filter(whole, lambda y: ~y.between(F.col("t"), F.col("u")))).otherwise(whole)))
    hits = tiles.select(*box, "tx", "ty").join(pixels, ["image_id", "tx", "ty"]).where("x >= a and x < c and y >= b and y < d")
    return hits.groupBy(*box, "bin", "value").agg(F.count("*").alias("n"))


def add_depth(objects: DataFrame, depth: DataFrame, width: int | None = None, height: int | None = None,
              cell: int = 32, bins: int = 32, hot: bool | None = None, few: int = PIXELS) -> DataFrame:
    """Depth for objects; images without objects get it for their floating objects instead.  ``hot`` and ``few`` as in ``median_depth``."""
    def read(objects, depth):
        is_object = F.col("kind") == "object"
        if hot is False:
            known = objects.withColumn("_have", F.max(is_object).over(Window.partitionBy("image_id")))
        else:
            have = objects.where(is_object).select("image_id").distinct()
            known = objects.join(have.withColumn("_have", F.lit(True)), "image_id", "left").select(*objects.columns, F.coalesce("_have", F.lit(False)).alias("_have"))
        wanted = F.coalesce(is_object | ((F.col("kind") == "floating") & ~F.col("_have")), F.lit(False))
        found = _read(known, depth, wanted, width, height)
        # objects that share an id each get what all of them have found, as many times as it was asked for
        none = F.array(F.struct(F.lit(None).cast("double").alias("depth")))
        each = F.flatten(F.array_repeat(F.when(F.size("_found") > 0, F.col("_found")).otherwise(none), F.col("_asked").cast("int")))
        return found.select(*objects.columns, F.explode_outer(F.when(F.col("_asked") == 1, F.col("_found")).otherwise(each)).alias("_v")).select(
            *objects.columns, F.col("_v.depth").alias("depth"))

    def tiled(objects, depth):
        have = objects.where(F.col("kind") == "object").select("image_id").distinct()
        floats = objects.where(F.col("kind") == "floating").join(have, "image_id", "left_anti")
        targets = objects.where(F.col("kind") == "object").unionByName(floats).select("image_id", "id", *BOX)
        found = _tiled(targets, depth, width, height, cell, bins).select("image_id", "id", "depth")
        return objects.join(found, ["image_id", "id"], "left")

    return _by_pixels(objects, depth, hot, few, width, height, read, tiled)
