"""Annotating new images as they arrive, and watching the rate of work."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_rate(runs: DataFrame, window: str = "1 minute", lateness: str | None = "5 minutes") -> DataFrame:
    """Images, failures and images per second in each time window, per dataset.  Works on a stream of run
    events (``ts, dataset, success``) and on a table of them."""
    rows = runs.withWatermark("ts", lateness) if lateness and runs.isStreaming else runs
    per = rows.groupBy(F.window("ts", window).alias("w"), "dataset").agg(
        F.count("*").alias("images"), F.count_if(~F.col("success")).alias("failures"))
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return per.select(F.col("w.start").alias("window_start"), "dataset", "images", "failures",
                      (F.col("images") / seconds).alias("per_second"))


def remaining_time(done: DataFrame, totals: DataFrame) -> DataFrame:
    """Images left per dataset and the seconds they will take at the mean rate so far.
    ``done(ts, dataset)``, ``totals(dataset, total)``."""
    per = done.groupBy("dataset").agg(F.count("*").alias("done"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    seconds = F.unix_timestamp("b") - F.unix_timestamp("a")
    rate = F.try_divide(F.col("done").cast("double"), seconds)
    left = F.greatest(F.col("total") - F.coalesce("done", F.lit(0)), F.lit(0))
    return totals.join(per, "dataset", "left").select(
        "dataset", "total", F.coalesce("done", F.lit(0)).alias("done"), left.alias("left"), rate.alias("per_second"),
        F.try_divide(left.cast("double"), rate).alias("seconds_left"))


def annotate_stream(new: DataFrame, annotate: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                    every: str | None = None):
    """Annotate each batch of new prediction rows and append the result; the checkpoint takes the place of
    looking for files that already exist.  A batch number marks its rows, so a batch repeated after a
    failure replaces its earlier try.  All rows of an image must arrive in one batch (the models' outputs are
    released together).  ``every``: time between batches; None works off what is there and stops."""

    def work(batch: DataFrame, number: int) -> None:
        annotate(batch).withColumn("batch", F.lit(int(number))).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    when = {"processingTime": every} if every else {"availableNow": True}
    return new.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**when).start()
