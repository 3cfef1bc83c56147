"""Holding images back until every model has been over them, then annotating each once.

Models work through images at their own pace.  Each writes its rows, then a notice ``(image_id, model, ts)``, also where it
found nothing.  A state per image holds which models are through; the image is released when all are, or when the event time
has moved on by ``wait`` since its first notice.  The state is a few words per image, many images to a bucket: rows stay where they
were written and are read when their image is released.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

RELEASED = "image_id bigint, models array<string>, complete boolean"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


BUCKETS = 2048     # states: images share one by hash, so that a batch costs calls per state and not per image
STATE = "ids array<bigint>, models array<array<string>>, due array<bigint>, gone array<boolean>"


def _barrier(models: list[str], wait: int) -> Callable:
    """Keeps, of the images of one bucket, which models are through, until when each is held back or remembered, and whether it has
    been released.

    The state comes and goes with the rows of a batch, so an image costs no calls of its own."""
    required = frozenset(models)

    def work(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = {image: (names, due, gone) for image, names, due, gone in zip(*state.get, strict=True)} if state.exists else {}
        told = {}                                       # of each image in the batch the models, and the first notice
        if not state.hasTimedOut:
            for part in parts:
                at = part["ts"].to_numpy("datetime64[ns]").astype("int64") // 1_000_000
                for image, model, ts in zip(part["image_id"].tolist(), part["model"].tolist(), at.tolist(), strict=True):
                    if image in told:
                        told[image][0].add(model)
                        told[image][1] = min(told[image][1], ts)
                    else:
                        told[image] = [{model}, ts]
        out = []
        for image in [*told, *[i for i, (_, due, _) in held.items() if due < now and i not in told]]:
            names, due, gone = held.get(image, ([], None, False))
            if image in told and not gone:              # else a repeated or late notice of an image that has left
                seen, first = told[image]
                names, due = sorted(seen.union(names)), max(first, now) + wait if due is None else due
            over = due <= now
            if not gone and (over or required <= set(names)):
                out.append((image, names, required <= set(names)))
                names, gone = [], True
                due, over = (now + wait, False) if over else (due, False)
            if gone and over:       # long enough ago: notices this late are dropped by the watermark
                held.pop(image, None)
            else:
                held[image] = (names, due, gone)
        if out:
            yield pd.DataFrame(out, columns=["image_id", "models", "complete"])
        if held:
            state.update((list(held), *map(list, zip(*held.values(), strict=True))))
            state.setTimeoutTimestamp(max(min(due for _, due, _ in held.values()), now + 1))
        elif state.exists:
            state.remove()

    return work


@contextmanager
def _rocks(spark: SparkSession):
    """The state of all images outgrows memory, so it is kept in the RocksDB store; queries started meanwhile keep it."""
    was = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, was)


def released(notices: DataFrame, models: list[str], wait: float = 3600.0, lateness: str = "10 minutes") -> DataFrame:
    """``(image_id, models, complete)`` of a stream of notices, one row per image: when all ``models`` are through, or, not
    complete, when ``wait`` seconds of event time have passed since its first notice.

    Notices may repeat; those without image, model or time are dropped, as are those later than the watermark allows.
    Models beyond the required ones are named where they came in time.
    """
    kept = notices.select(F.col("image_id").cast("bigint").alias("image_id"), "model", "ts").where("image_id is not null and model is not null and ts is not null")
    kept = kept.withColumn("bucket", F.pmod(F.xxhash64("image_id"), F.lit(BUCKETS)))
    return kept.withWatermark("ts", lateness).groupBy("bucket").applyInPandasWithState(
        _barrier(models, int(wait * 1000)), RELEASED, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def annotate_released(notices: DataFrame, models: list[str], load: Callable[[DataFrame], DataFrame], annotate: Callable[[DataFrame], DataFrame],
                      path: str, checkpoint: str, wait: float = 3600.0, lateness: str = "10 minutes", every: str | None = None):
    """Annotate images as they are released, each exactly once, and append the result under ``path``.

    ``load(ids)`` gives all rows of the images in ``ids(image_id)``.  Which images are in a batch is decided by the
    state, which the checkpoint holds: a batch repeated after a failure has the same images and replaces its earlier try.
    ``every``: time between batches; None works off what is there and stops.
    """
    def work(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            done = annotate(load(batch.select("image_id"))).join(batch.select("image_id", "complete"), "image_id")
            done.withColumn("batch", F.lit(int(number))).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        finally:
            batch.unpersist()

    when = {"processingTime": every} if every else {"availableNow": True}
    with _rocks(notices.sparkSession):
        out = released(notices, models, wait, lateness)
        return out.writeStream.foreachBatch(work).outputMode("append").option("checkpointLocation", checkpoint).trigger(**when).start()
