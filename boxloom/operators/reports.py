"""Counts and statistics over runs, masks and annotations."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom import scale


def tally_status(runs: DataFrame, by: str = "dataset") -> DataFrame:
    """Runs per status, one row per group."""
    n = lambda s: F.count(F.when(F.col("status") == s, 1)).alias(s)
    return runs.groupBy(by).agg(n("success"), n("skipped"), n("no_predictions"), n("error"))


def class_histogram(annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """Instances per category that are no crowds, categories without any, and a total row."""
    per = (annotations.where(F.coalesce("iscrowd", F.lit(0)) == 0).groupBy("category_id").agg(F.count("*").alias("n")))
    full = categories.select("category_id", "name").join(per, "category_id", "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))
    return full.rollup("name").agg(F.sum("n").alias("instances"))


def categories_out_of_range(annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """Annotations whose category does not exist, counted by category."""
    return annotations.join(categories, "category_id", "left_anti").groupBy("category_id").agg(F.count("*").alias("n"))


def mask_statistics(masks: DataFrame, images: DataFrame) -> DataFrame:
    """Number of pairs, masks and classes, masks per image, spread of area and of image size."""
    per_image = masks.groupBy("image_id").agg(
        F.count("*").alias("n"), F.sum("area").alias("s"), F.min("area").alias("lo"), F.max("area").alias("hi"))
    sized = images.join(per_image, "image_id")
    whole = sized.agg(
        F.count("*").alias("pairs"), F.sum("n").alias("masks"), F.count_distinct("class_name").alias("classes"),
        F.min("lo").alias("area_min"), F.max("hi").alias("area_max"), (F.sum("s") / F.sum("n")).alias("area_mean"),
        F.min("width").alias("width_min"), F.max("width").alias("width_max"), F.avg("width").alias("width_mean"),
        F.min("height").alias("height_min"), F.max("height").alias("height_max"), F.avg("height").alias("height_mean"))
    # a median over values and their counts: one row per distinct area leaves each task
    median = (masks.join(images.select("image_id"), "image_id", "left_semi").groupBy("area").count()
              .agg(F.percentile("area", F.lit(0.5), F.col("count")).alias("area_median")))
    one = F.lit(1)
    both = whole.withColumn("_k", one).join(F.broadcast(median.withColumn("_k", one)), "_k").drop("_k")   # one row each
    return both.withColumn("masks_per_image", F.col("masks") / F.col("pairs"))


def run_throughput(runs: DataFrame) -> DataFrame:
    """Images, success, rates and shares per dataset and worker, with rows for each margin.

    ``runs(dataset, worker, image_id, success, seconds)``; shares are of all images."""
    per = runs.groupBy("dataset", "worker").agg(
        F.count("*").alias("images"), F.count(F.when(F.col("success"), 1)).alias("done"), F.sum("seconds").alias("seconds"),
        F.sum(1 / F.col("seconds")).alias("_r"), F.min(1 / F.col("seconds")).alias("_lo"),
        F.max(1 / F.col("seconds")).alias("_hi"))
    cubed = per.cube("dataset", "worker").agg(
        F.sum("images").alias("images"), F.sum("done").alias("done"), F.sum("seconds").alias("seconds"),
        (F.sum("_r") / F.sum("images")).alias("mean_rate"), F.min("_lo").alias("min_rate"), F.max("_hi").alias("max_rate"))
    total = per.agg(F.sum("images").alias("_all")).withColumn("_k", F.lit(1))
    return (cubed.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k").drop("_k")   # one row
            .withColumn("share", F.col("images") / F.col("_all"))
            .withColumn("images_per_second", F.col("images") / F.col("seconds")).drop("_all"))


def first_failures(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.where(~F.col("success")).orderBy("dataset", "image_id").limit(n)


def label_votes(labels: DataFrame) -> DataFrame:
    """Votes per object and label, and the label with most votes (alphabetical on ties).
    ``labels(image_id, id, label)`` repeats a label once per vote."""
    n = labels.groupBy("image_id", "id", "label").agg(F.count("*").alias("votes"))
    top = n.groupBy("image_id", "id").agg(F.min_by("label", F.struct(-F.col("votes"), "label")).alias("winner"))
    return n.join(top, ["image_id", "id"])


def confusion_matrix(pixels: DataFrame, n_classes: int, ignore: int = 255) -> DataFrame:
    """Counts per (predicted, true) label; the ignored true label becomes class ``n_classes``."""
    gt = F.when(F.col("gt") == ignore, n_classes).otherwise(F.col("gt"))
    return pixels.select("pred", gt.alias("gt")).groupBy("pred", "gt").agg(F.count("*").alias("n"))


def class_scores(confusion: DataFrame, n_classes: int) -> DataFrame:
    """IoU and accuracy per class from a confusion matrix, in percent; null without true pixels."""
    known = confusion.where((F.col("pred") < n_classes) & (F.col("gt") < n_classes))
    flat = known.select(F.explode(F.array(
        F.struct(F.col("gt").alias("c"), F.col("n").alias("gt_n"), F.lit(0).cast("long").alias("pred_n"),
                 F.when(F.col("pred") == F.col("gt"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("pred").alias("c"), F.lit(0).cast("long").alias("gt_n"), F.col("n").alias("pred_n"),
                 F.lit(0).cast("long").alias("tp")))).alias("s")).select("s.*")
    per = flat.groupBy(F.col("c").alias("class")).agg(F.sum("tp").alias("tp"), F.sum("gt_n").alias("gt_n"),
                                                      F.sum("pred_n").alias("pred_n"))
    union = F.col("gt_n") + F.col("pred_n") - F.col("tp")
    has = F.col("gt_n") > 0
    return per.select("class", "tp", "gt_n", "pred_n", F.when(has, F.col("tp") * 100.0 / union).alias("iou"),
                      F.when(has, F.col("tp") * 100.0 / F.col("gt_n")).alias("acc"))


def segmentation_metrics(scores: DataFrame) -> DataFrame:
    """mIoU, frequency-weighted IoU, mean and overall pixel accuracy, in percent."""
    return scores.agg(F.avg("iou").alias("miou"), (F.sum(F.col("iou") * F.col("gt_n")) / F.sum("gt_n")).alias("fwiou"),
                      F.avg("acc").alias("macc"), (F.sum("tp") * 100.0 / F.sum("gt_n")).alias("pacc"))
