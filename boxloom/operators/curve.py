"""Precision and recall of many states, such as all area ranges and thresholds, in one pass over the detections.

A detection is one row, whose bits say in which states it is right and in which wrong.  Rows are sorted once for all states, by a range
partition that spreads a class over many tasks, and written as compressed blocks of bits.  Each task's run of a class goes on from
the counts of the runs before it: one row of counts for each end of a task's range.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom import scale

BLOCK = 4096      # detections of a block
STEPS = 100       # recalls at which precision is looked at, besides 0


def _word(steps: int) -> np.dtype:
    """The smallest whole number that has a bit for every threshold."""
    return np.dtype(next(f"<u{n}" for n in (1, 2, 4, 8) if steps <= 8 * n))


def packed(found: DataFrame, areas: dict, steps: int) -> DataFrame:
    """``label, image_id, det, score, bits``: of each area range the thresholds at which a detection is right, then those at which it is
    wrong, from ``won``, ``skipped`` (thresholds as bits by area range, or null) and ``size``."""
    kind, n, full = _word(steps), len(areas), np.uint64((1 << steps) - 1)
    low, high = np.array(list(areas.values()), np.float64).T

    def run(batches):
        for b in batches:
            won, skipped = (np.zeros((b.num_rows, n), np.uint64) for _ in range(2))
            for name, mask in (("won", won), ("skipped", skipped)):
                col = b.column(name)
                mask[col.is_valid().to_numpy(zero_copy_only=False)] = col.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.uint64).reshape(-1, n)
            size = b.column("size").to_numpy(zero_copy_only=False).astype(np.float64)[:, None]
            wrong = np.where((size >= low) & (size <= high), ~(won | skipped) & full, np.uint64(0))
            bits = np.concatenate([won, wrong], axis=1).astype(kind)
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * (2 * n * kind.itemsize)
            column = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(bits.tobytes())])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keys], column], [*keys, "bits"])

    keys = ["label", "image_id", "det", "score"]
    kinds = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in keys)
    return found.select(*keys, "size", "won", "skipped").mapInArrow(run, f"{kinds}, bits binary")


def _blocks(bits: DataFrame, ranges: int, steps: int) -> DataFrame:
    """``run, seq, label, data, total``: the bits of one class after another in order of score, and after a class's last block in
    a run its counts in every state."""
    kind = _word(steps)
    order = [F.col("label"), F.col("score").desc(), F.col("image_id"), F.col("det")]
    parts = max(int(bits.sparkSession.conf.get("spark.sql.shuffle.partitions")), bits.sparkSession.sparkContext.defaultParallelism)
    laid = bits.where(F.col("label").isNotNull()).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("label", "bits")
    schema = f"run int, seq long, label {bits.schema['label'].dataType.simpleString()}, data binary, total binary"

    def run(batches):
        me, seq, label, total = TaskContext.get().partitionId(), 0, None, None
        for b in batches:
            labels, raw = b.column(0).to_pylist(), np.frombuffer(b"".join(b.column(1).to_pylist()), kind).reshape(-1, 2 * ranges)
            first = [i for i in range(len(labels)) if i == 0 or labels[i] != labels[i - 1]] + [len(labels)]
            rows = []
            for i, j in zip(first, first[1:], strict=False):
                if labels[i] != label:
                    if total is not None:
                        rows.append((label, None, total.tobytes()))
                    label, total = labels[i], np.zeros((2 * ranges, steps), np.int64)
                for k in range(i, j, BLOCK):
                    some = raw[k:min(k + BLOCK, j)]
                    total += np.stack([((some >> kind.type(t)) & kind.type(1)).sum(0, dtype=np.int64) for t in range(steps)], axis=1)
                    rows.append((label, zlib.compress(some.tobytes(), 1), None))
            yield batch(me, seq, rows, b.schema.field(0).type)
            seq += len(rows)
            kept = b.schema.field(0).type
        if total is not None:
            yield batch(me, seq, [(label, None, total.tobytes())], kept)

    def batch(me, seq, rows, of):
        return pa.RecordBatch.from_arrays([pa.array([me] * len(rows), pa.int32()), pa.array(range(seq, seq + len(rows)), pa.int64()), pa.array([r[0] for r in rows], of),
                                           *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]], ["run", "seq", "label", "data", "total"])

    return laid.mapInArrow(run, schema)


def best_precision(bits: DataFrame, npos: DataFrame, areas: dict, steps: int) -> DataFrame:
    """``label, area_range, t, k, p``: the best precision at right detections whose recall reaches step ``k`` and not the next.

    ``bits`` as from ``packed``; ``npos(label, area_range, npos)``, classes and ranges without which are left out."""
    n, kind = len(areas), _word(steps)
    stored = scale.checkpointed(_blocks(bits, n, steps))
    ends = stored.where(F.col("total").isNotNull()).select("label", "run", "total")
    several = ends.groupBy("label").count().where("count > 1").select("label")
    before, seen = {}, {}
    for r in ends.join(several, "label").orderBy("run").collect():         # classes on both sides of a range's end: two rows a task at most
        before[r.label, r.run] = seen.get(r.label, 0)
        seen[r.label] = before[r.label, r.run] + np.frombuffer(r.total, np.int64).reshape(2, n * steps)
    wide = npos.groupBy("label").agg(F.array(*[F.coalesce(F.max(F.when(F.col("area_range") == k, F.col("npos"))), F.lit(0)) for k in areas]).alias("npos"))
    met = stored.where(F.col("data").isNotNull()).join(scale.maybe_broadcast(wide), "label").select("run", "seq", "label", "data", "npos")
    schema = f"label {bits.schema['label'].dataType.simpleString()}, s int, k long, p double"

    def run(batches):
        key, at = None, 0
        for b in batches:
            for number, label, data, npos in zip(*[b.column(c).to_pylist() for c in ("run", "label", "data", "npos")], strict=True):
                if (label, number) != key:
                    key, at = (label, number), before.get((label, number), 0)
                words = np.frombuffer(zlib.decompress(data), kind).reshape(-1, 2 * n, 1)
                flags = ((words >> np.arange(steps, dtype=kind)) & kind.type(1)).reshape(len(words), 2, n * steps)
                counts = flags.cumsum(0, dtype=np.int64) + at
                at = counts[-1]
                total = np.repeat(np.array(npos, np.int64), steps)
                row, s = np.nonzero(flags[:, 0] * (total > 0))
                if not len(row):
                    continue
                tp, fp = counts[row, 0, s], counts[row, 1, s]
                recall = tp / total[s]
                low = np.floor(recall * STEPS).astype(np.int64)
                k = np.where((low < STEPS) & (recall >= (low + 1) * 0.01), low + 1, np.where(recall < low * 0.01, low - 1, low))
                code, place = np.unique(s * (k.max() + 2) + k + 1, return_inverse=True)
                best = np.zeros(len(code))
                np.maximum.at(best, place, tp / (tp + fp))
                s, k = np.divmod(code, k.max() + 2)
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(code), b.schema.field("label").type), pa.array(s.astype(np.int32)),
                                                  pa.array(k - 1), pa.array(best)], ["label", "s", "k", "p"])

    points = scale.laid_out(met, "run", "label").sortWithinPartitions("run", "label", "seq").mapInArrow(run, schema)
    name = F.array(*[F.lit(k) for k in areas])[F.expr(f"s div {steps}").cast("int")]
    return points.select("label", name.alias("area_range"), (F.col("s") % steps).alias("t"), "k", "p").groupBy("label", "area_range", "t", "k").agg(F.max("p").alias("p"))
