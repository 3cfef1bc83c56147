"""Repeat factors, subsets, shards and batches of images."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import scale


def hash01(*cols, seed: int = 0) -> Column:
    """A number in [0, 1) fixed by the values and the seed."""
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def category_frequency(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """Share of images that show each category."""
    per = annotations.select("image_id", "category_id").distinct().groupBy("category_id").agg(F.count("*").alias("images"))
    total = images.agg(F.count("*").alias("_n")).withColumn("_k", F.lit(1))
    return (per.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k")   # one row
            .select("category_id", "images", (F.col("images") / F.col("_n")).alias("frequency")))


def repeat_factors(annotations: DataFrame, images: DataFrame, threshold: float) -> DataFrame:
    """How often an image should be seen: the largest ``sqrt(threshold / frequency)`` of its
    categories, at least 1."""
    freq = category_frequency(annotations, images).select(
        "category_id", F.greatest(F.lit(1.0), F.sqrt(threshold / F.col("frequency"))).alias("r"))
    per = (annotations.select("image_id", "category_id").distinct().join(scale.maybe_broadcast(freq), "category_id")
           .groupBy("image_id").agg(F.max("r").alias("repeat_factor")))
    return images.select("image_id").join(per, "image_id", "left").withColumn(
        "repeat_factor", F.coalesce("repeat_factor", F.lit(1.0)))


def repeat_sample(factors: DataFrame, seed: int = 0) -> DataFrame:
    """Each image as many times as its factor says; the fraction decides by hash about one more."""
    whole = F.floor("repeat_factor").cast("int")
    extra = (hash01("image_id", seed=seed) < F.col("repeat_factor") - whole).cast("int")
    return factors.withColumn("copy", F.explode(F.sequence(F.lit(1), whole + extra)))


def random_subset(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows chosen by hash of the key, numbered in hash order by a range-partitioned sort, so that a choice
    of any size is never brought to one place."""
    order = [F.xxhash64(key, F.lit(seed)), F.col(key)]
    return scale.running(df, [], order, number="_i").where(F.col("_i") <= k).drop("_i")


def subset_corpus(images: DataFrame, annotations: DataFrame, ratio: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """A share of the images (at least one), chosen by hash, with all their annotations."""
    n = max(1, int(images.count() * ratio))
    some = random_subset(images, "image_id", n, seed)
    return some, annotations.join(some.select("image_id"), "image_id", "left_semi")


def shards(df: DataFrame, order: list, n: int) -> DataFrame:
    """Contiguous shards of a global order; sizes differ by one at most, larger ones first.

    Row numbers come from a range-partitioned sort, so no task sees all rows."""
    numbered = scale.running(df, [], order, number="_i")
    total = df.agg(F.count("*").alias("_n")).withColumn("_k", F.lit(1))
    joined = numbered.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k")   # one row
    i, size, left = F.col("_i") - 1, F.floor(F.col("_n") / n), F.col("_n") % n
    head = left * (size + 1)
    shard = F.when(i < head, F.floor(i / (size + 1))).otherwise(left + F.floor(F.try_divide(i - head, size)))
    return joined.withColumn("shard", shard.cast("int")).drop("_i", "_n", "_k")


def aspect_batches(images: DataFrame, size: int, order: list | None = None) -> DataFrame:
    """Batches of ``size`` images that are all wider than high, or all not; the last, partial
    batch of each kind is left out."""
    kind = images.withColumn("wide", (F.col("width") > F.col("height")).cast("int"))
    numbered = scale.running(kind, ["wide"], order or [F.col("image_id")], number="_i")
    full = numbered.groupBy("wide").agg((F.floor(F.max("_i") / size) * size).alias("_full"))
    return (numbered.join(F.broadcast(full), "wide")   # two rows
            .where(F.col("_i") <= F.col("_full"))
            .withColumn("batch", F.floor((F.col("_i") - 1) / size).cast("int")).drop("_i", "_full"))


def top_per_image(df: DataFrame, k: int, order: list, keys: list[str] = ["image_id"], hot: bool | None = None) -> DataFrame:
    """The first ``k`` rows of each image.  Tasks keep ``k`` rows of a group before the shuffle."""
    from pyspark.sql import Window

    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") <= k).drop("_rn")
