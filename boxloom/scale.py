"""Helpers for data too large, or too uneven, for the plain plan.

``oversized`` asks whether any group outgrows a limit; operators use it to choose
between a per-group plan and one that splits groups.  ``running`` computes
window sums and row numbers over groups of any size.
"""
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GROUP_LIMIT = 2_000          # rows of one group that an array fold may hold
WINDOW_LIMIT = 5_000_000     # rows of one group that one sorted window may hold
BROADCAST_ROWS = 200_000     # rows, and bytes as text, that a side may have to be broadcast
BROADCAST_BYTES = 64 << 20


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, cutting its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share; one of our own only where none is set and all run on this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="boxloom-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def oversized(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Keys of the groups with more than ``limit`` rows (counted with map-side combine)."""
    return df.groupBy(*keys).count().where(F.col("count") > limit).select(*keys)


def has_oversized(df: DataFrame, keys: list[str], limit: int) -> bool:
    return not oversized(df, keys, limit).isEmpty()


def crowds(keys: list[str], limit: int, *tables: DataFrame) -> DataFrame | None:
    """Keys of the groups with more than ``limit`` rows in any of the tables, stored; None when there are none."""
    found = oversized(tables[0], keys, limit)
    for df in tables[1:]:
        found = found.union(oversized(df, keys, limit))
    found = checkpointed(found.distinct())
    return None if found.isEmpty() else found


def apart(df: DataFrame, keys: list[str], crowded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the groups that are not in ``crowded``, and rows of those that are."""
    side = maybe_broadcast(crowded)
    rest, many = (df.join(side, keys, how).select(*df.columns) for how in ("left_anti", "left_semi"))
    return rest, many


def laid_out(df: DataFrame, *keys: str) -> DataFrame:
    """Rows laid out by ``keys`` over as many tasks as the session has partitions or cores.

    The number is given, as the adaptive plan would otherwise choose it by the bytes shuffled: these rows are few bytes, but all
    steps by image follow in the same tasks, and some make thousands of rows of one."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def by_image(df: DataFrame, crowded: bool, key: str = "image_id") -> DataFrame:
    """Rows laid out by image once, so that the per-image steps that follow need no further shuffle;
    crowded images are left where they are."""
    return df if crowded else laid_out(df, key)


def by_number(df: DataFrame, known: DataFrame, image: str = "image_id", number: str = "id") -> DataFrame:
    """Left join on ``image`` and ``number`` of tables in which no image holds many rows.

    A join on both columns would lay both sides out anew by both; with the number as a range of one, rows stay in the
    layout by image that they have, and only the few rows of one image are compared."""
    other = known.withColumnsRenamed({image: "_image", number: "_number"})
    same = (F.col(image) == F.col("_image")) & F.col(number).between(F.col("_number"), F.col("_number"))
    return df.join(other, same, "left").drop("_image", "_number")


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most ``limit`` rows of at most ``size`` bytes in all; no more than
    ``limit`` + 1 rows are looked at."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    seen = df.select(width.alias("w")).limit(limit + 1).agg(F.count("*").alias("n"), F.sum("w").alias("w")).first()
    return seen["n"] <= limit and (seen["w"] or 0) <= size


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it is proven small; otherwise left to the optimizer."""
    return F.broadcast(df) if small_enough(df, limit) else df


def running(df: DataFrame, keys: list[str], order: list, sums: dict | None = None,
            number: str | None = None, maxima: dict | None = None, limit: int = WINDOW_LIMIT,
            hot: bool | None = None) -> DataFrame:
    """Running sums and maxima (``{new column: expression}``) and a row number over each group.

    Groups up to ``limit`` rows use one window.  If any is larger, or there are no
    ``keys``, rows are range partitioned by (keys, order), so one group spreads over many tasks;
    each task works on its own run, and run totals (one row per task and group) give what
    came before.
    """
    folds = {n: (F.sum, e) for n, e in (sums or {}).items()}
    folds |= {n: (F.max, e) for n, e in (maxima or {}).items()}
    if number:
        folds[number] = (F.sum, F.lit(1).cast("long"))
    if not keys:
        wide = df.withColumn("_all", F.lit(1))
        return running(wide, ["_all"], order, sums, number, maxima, limit, True).drop("_all")
    if hot is None:
        hot = has_oversized(df, keys, limit)
    if not hot:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[f(e).over(w).alias(n) for n, (f, e) in folds.items()])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = (df.select("*", *[e.alias(f"_v_{n}") for n, (_, e) in folds.items()])
            .repartitionByRange(parts, *[F.col(k) for k in keys], *order)
            .withColumn("_run", F.spark_partition_id()))
    laid = checkpointed(laid)
    totals = laid.groupBy(*keys, "_run").agg(*[f(f"_v_{n}").alias(f"_t_{n}") for n, (f, _) in folds.items()])
    before = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(*keys, "_run", *[f(f"_t_{n}").over(before).alias(f"_o_{n}") for n, (f, _) in folds.items()])
    own = Window.partitionBy(*keys, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = laid.select("*", *[f(f"_v_{n}").over(own).alias(f"_s_{n}") for n, (f, _) in folds.items()])

    def total(n, f):
        mine, past = F.col(f"_s_{n}"), F.col(f"_o_{n}")
        return F.greatest(mine, past) if f is F.max else mine + F.coalesce(past, F.lit(0))

    return local.join(earlier, [*keys, "_run"]).select(
        *df.columns, *[total(n, f).alias(n) for n, (f, _) in folds.items()])
