"""Finding images and outputs on storage, and what still needs work."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import text as T

# File types taken as images
EXTENSIONS = ["jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp"]


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, modified, size`` of all files below a folder; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
            .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size")))


def discover_images(files: DataFrame, root: str, ignore: list[str] = [], extensions: list[str] = EXTENSIONS) -> DataFrame:
    """Images of every dataset folder below ``root``.

    A dataset with an ``images`` folder is a detection set and only that folder counts; one with other
    folders has one folder per class; otherwise its files are its images."""
    base = root.rstrip("/").split("/")[-1]
    rel = F.regexp_replace("path", f"^.*?/{base}/", "")
    parts = F.split(rel, "/")
    rows = files.select("*", parts.alias("_p")).where(F.size("_p") >= 2)
    rows = rows.select("path", "size", "modified", F.col("_p")[0].alias("dataset"), F.element_at("_p", -1).alias("file_name"),
                       F.when(F.size("_p") > 2, F.col("_p")[1]).alias("folder"), F.size("_p").alias("_n"))
    rows = rows.where(F.lower(F.regexp_extract("file_name", r"\.([^.]+)$", 1)).isin(extensions))
    rows = rows.where(~F.coalesce(F.col("dataset").isin(ignore), F.lit(False)) & ~F.coalesce(F.col("folder").isin(ignore), F.lit(False)))
    layout = rows.groupBy("dataset").agg(F.max((F.col("folder") == "images").cast("int")).alias("_i"),
                                         F.max(F.col("folder").isNotNull().cast("int")).alias("_c"))
    kind = F.when(F.col("_i") == 1, "detection").when(F.col("_c") == 1, "classification").otherwise("flat")
    out = rows.join(scale.maybe_broadcast(layout.select("dataset", kind.alias("layout"))), "dataset")
    keep = (F.when(F.col("layout") == "detection", F.col("folder") == "images")
            .when(F.col("layout") == "classification", F.col("folder").isNotNull() & (F.col("_n") == 3)).otherwise(True))
    return out.where(keep).select(
        "dataset", "layout", F.when(F.col("layout") == "classification", F.col("folder")).alias("class_name"),
        T.stem(F.col("file_name")).alias("image_id"), "file_name", "path", "size", "modified")


def pending(images: DataFrame, outputs: DataFrame, kinds: list[str], valid: Column | None = None,
            keys: list[str] = ["image_id"]) -> DataFrame:
    """Images that lack at least one (valid) output of the wanted kinds.  ``outputs(keys, kind)``."""
    good = outputs.where(F.col("kind").isin(kinds))
    if valid is not None:
        good = good.where(valid)
    done = good.groupBy(*keys).agg(F.count_distinct("kind").alias("_n")).where(F.col("_n") == len(kinds)).select(*keys)
    return images.join(done, keys, "left_anti")


def completion_report(images: DataFrame, todo: DataFrame, by: str = "class_name", keys: list[str] = ["image_id"]) -> DataFrame:
    """Images in all, complete and missing per class, and the complete share in percent."""
    marked = images.join(todo.select(*keys).distinct().withColumn("_t", F.lit(1)), keys, "left")
    return marked.groupBy(by).agg(F.count("*").alias("total"), F.count("_t").alias("missing")).select(
        by, "total", (F.col("total") - F.col("missing")).alias("complete"), "missing",
        F.round(100.0 * (F.col("total") - F.col("missing")) / F.col("total"), 1).alias("percent"))


def most_missing(report: DataFrame, n: int = 10, by: str = "class_name") -> DataFrame:
    return report.where("missing > 0").orderBy(F.col("missing").desc(), by).limit(n)


def finished_datasets(report: DataFrame, completions: DataFrame | None = None) -> DataFrame:
    """Datasets without missing images that are not yet in the completion log."""
    done = report.where("missing = 0")
    return done if completions is None else done.join(completions.select("dataset"), "dataset", "left_anti")


COMPLETION = ("dataset string, total bigint, processed bigint, failed bigint, masks bigint, seconds double, per_second double, finished_at timestamp, "
              "batch bigint")


def completion_rows(report: DataFrame, runs: DataFrame, completions: DataFrame | None = None) -> DataFrame:
    """What the completion log says of each newly finished dataset: ``runs(dataset, ts, success, masks, seconds)`` has a row for
    each image worked on."""
    stats = runs.groupBy("dataset").agg(
        F.count_if("success").alias("processed"), F.count_if(~F.col("success")).alias("failed"), F.coalesce(F.sum("masks"), F.lit(0)).cast("bigint").alias("masks"),
        F.coalesce(F.sum(F.col("seconds").cast("double")), F.lit(0.0)).alias("seconds"), F.max("ts").alias("finished_at"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return finished_datasets(report, completions).join(stats, "dataset", "left").select(
        "dataset", F.col("total").cast("bigint").alias("total"), none("processed"), none("failed"), none("masks"), "seconds",
        F.try_divide(F.col("processed").cast("double"), "seconds").alias("per_second"), "finished_at")


def log_completions(report: DataFrame, runs: DataFrame, path: str, batch: int) -> None:
    """Append the datasets that are finished and not in the log yet, under the batch's number.

    A batch repeated after a failure writes its own rows again and nothing else, so a dataset is in the log once."""
    spark = report.sparkSession
    none = spark.createDataFrame([], COMPLETION)
    none.limit(0).write.mode("append").partitionBy("batch").parquet(path)          # the folder has to be there to be read
    earlier = spark.read.schema(COMPLETION).parquet(path).where(F.col("batch") != batch)
    rows = scale.checkpointed(completion_rows(report, runs, earlier)).withColumn("batch", F.lit(batch).cast("bigint"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def dataset_filter(df: DataFrame, part: str, outputs: DataFrame | None = None) -> DataFrame:
    """Rows whose dataset name contains ``part``, and which also occur among the outputs, if given."""
    some = df.where(F.contains("dataset", F.lit(part)))
    return some if outputs is None else some.join(outputs.select("dataset"), "dataset", "left_semi")


def pair_by_stem(images: DataFrame, records: DataFrame, by_class: bool = True) -> DataFrame:
    """Images and records of the same name without extension, and of the same class if wanted."""
    keys = (["class_name"] if by_class else []) + ["stem"]
    left = images.withColumn("stem", T.stem(F.col("file_name")))
    right = records.withColumn("stem", T.stem(F.col("file_name"))).select(*keys, F.col("file_name").alias("record_name"))
    return left.join(right, keys)


def original_stem(name: Column) -> Column:
    """The image name inside an output name such as ``a.jpg_min_-1.5_max_2.5.jpg``."""
    ranged = F.contains(name, F.lit("_min_")) & F.contains(name, F.lit("_max_"))
    return T.stem(F.when(ranged, F.substring_index(name, "_min_", 1)).otherwise(name))


def dedup_outputs(files: DataFrame, keep: str = "newest") -> DataFrame:
    """Which of several outputs for one image to keep: ``newest``, ``oldest`` or ``largest``.

    ``files(folder, file_name, modified, size)``.  Adds ``stem``, ``copies`` and ``keep``; nothing is deleted."""
    order = {"newest": F.struct(-F.unix_micros(F.col("modified").cast("timestamp")), "file_name"), "oldest": F.struct(F.unix_micros(F.col("modified").cast("timestamp")), "file_name"),
             "largest": F.struct(-F.col("size"), "file_name")}[keep]
    named = files.withColumn("stem", original_stem(F.col("file_name")))
    best = named.groupBy("folder", "stem").agg(F.min_by("file_name", order).alias("_best"), F.count("*").alias("copies"))
    return named.join(best, ["folder", "stem"]).withColumn("keep", F.col("file_name") == F.col("_best")).drop("_best")


def duplicate_report(plan: DataFrame) -> DataFrame:
    """Duplicated images, files to remove and bytes they hold, per folder."""
    gone = ~F.col("keep")
    return plan.where("copies > 1").groupBy("folder").agg(
        F.count_distinct("stem").alias("duplicated"), F.count_if(gone).alias("removable"),
        F.sum(F.when(gone, F.col("size")).otherwise(0)).alias("bytes"))
