"""Row filters on boxes, annotations and images."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import boxes as B

BOX = ["x1", "y1", "x2", "y2"]


def drop_masks(df: DataFrame) -> DataFrame:
    """Leave mask columns behind; with a columnar source they are never read."""
    return df.drop("sam_mask", "segmentation")


def score_floor(df: DataFrame, floor: float = 0.1) -> DataFrame:
    return df.where(F.col("score") >= floor)


def valid_bbox(df: DataFrame, bbox: str = "bbox") -> DataFrame:
    """Keep boxes with four known coordinates."""
    return df.where((F.size(bbox) == 4) & ~F.exists(bbox, lambda v: v.isNull()))


def min_area_ratio(df: DataFrame, images: DataFrame, ratio: float = 0.02) -> DataFrame:
    """Boxes covering at least ``ratio`` of their image."""
    sizes = images.select("image_id", "width", "height")
    return (df.join(sizes, "image_id").where(B.area(B.cols()) / (F.col("width") * F.col("height")) >= ratio)
            .drop("width", "height"))


def proposal_area(masks: DataFrame, images: DataFrame, percent: float = 1.0) -> DataFrame:
    """Proposals (x, y, w, h) covering more than ``percent`` of their image.  Without a known image
    size the size of the image's first mask counts; without either all stay."""
    sizes = images.select("image_id", "width", "height")
    first = masks.where(F.col("mask_w").isNotNull()).groupBy("image_id").agg(
        F.min_by(F.struct("mask_w", "mask_h"), "seq").alias("_m"))
    joined = masks.join(sizes, "image_id", "left").join(first, "image_id", "left")
    area = F.coalesce(F.col("width") * F.col("height"), F.col("_m.mask_w") * F.col("_m.mask_h"))
    keep = area.isNull() | (F.col("w") * F.col("h") / area * 100 > percent)
    return joined.where(keep).drop("width", "height", "_m")


def clip_boxes(df: DataFrame, images: DataFrame) -> DataFrame:
    """Cut boxes to their image and drop those left empty."""
    sized = df.join(images.select("image_id", "width", "height"), "image_id")
    cut = B.clip(B.cols(), F.col("width").cast("double"), F.col("height").cast("double"))
    out = sized.select(*[c for c in df.columns if c not in BOX],
                       *[getattr(cut, c).alias(c) for c in BOX])
    return out.where(B.nonempty(B.cols()))


def inside_image(df: DataFrame, images: DataFrame, tolerance: float = 0.0) -> DataFrame:
    sized = df.join(images.select("image_id", "width", "height"), "image_id")
    return sized.where(B.inside_image(B.cols(), F.col("width"), F.col("height"), tolerance)).drop("width", "height")


def with_real_annotations(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Images with at least one annotation that is not a crowd."""
    real = annotations.where(F.coalesce("iscrowd", F.lit(0)) == 0).select("image_id")
    return images.join(real, "image_id", "left_semi")


def visible_keypoints(keypoints):
    """Number of visible points in a flat x, y, v list."""
    return F.size(F.filter(keypoints, lambda v, i: (i % 3 == 2) & (v > 0)))


def with_keypoints(images: DataFrame, annotations: DataFrame, at_least: int) -> DataFrame:
    """Images whose annotations show at least so many keypoints in total."""
    n = (annotations.groupBy("image_id").agg(F.sum(F.coalesce(visible_keypoints("keypoints"), F.lit(0))).alias("_n"))
         .where(F.col("_n") >= at_least).select("image_id"))
    return images.join(n, "image_id", "left_semi")


def confident(df: DataFrame, threshold: float) -> DataFrame:
    return df.where(F.col("score") >= threshold)
