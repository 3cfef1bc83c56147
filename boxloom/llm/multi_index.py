"""Embedding near-dedup with an inverted multi-index.

Vectors are scaled to length one and cut in two halves; each half has its own codebook, and the pairs of codes form
a grid of cells.  A vector lies in the cell of its nearest codes and visits the cells nearest to it, in the order of
the multi-sequence traversal, as many as a calibration on pairs at the threshold asks for.  Visitors and members of a
cell meet in blocks of bounded size and are compared exactly, in double precision.

The codebooks and the number of visits come from a bounded sample; every vector is indexed, and every one searches.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import components, stored
from boxloom.scale import maybe_broadcast

SAMPLE = 20_000        # vectors that the codebooks are fitted on at most
SAMPLE_BYTES = 32 << 20
PER_CELL = 128         # vectors per cell of the grid, on average
TARGET = 0.98          # share of pairs at the threshold that visits must find
MEMBERS, VISITORS = 2048, 4096       # rows of a cell's block


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision."""
    rows = np.asarray(rows, np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def codebook(rows: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    """Centres of ``k`` groups of rows, by repeated means."""
    k = min(k, len(rows))
    centres = rows[rng.choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds if rows.shape[1] else 0):
        near = distances(rows, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        n = np.bincount(near, minlength=k)[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(1)


class Grid:
    """Two codebooks, and how many cells a vector visits."""

    def __init__(self, sample: np.ndarray, count: int, cosine: float, per_cell: int = PER_CELL, target: float = TARGET):
        rng = np.random.default_rng(7)
        k = max(1, int(np.ceil(np.sqrt(count / per_cell))))
        self.half = sample.shape[1] // 2
        self.books = [codebook(sample[:, :self.half], k, rng), codebook(sample[:, self.half:], k, rng)]
        self.visits = self.calibrate(sample[rng.permutation(len(sample))[:1000]], cosine, target, rng)

    def parts(self, rows: np.ndarray) -> list[np.ndarray]:
        return [distances(rows[:, :self.half], self.books[0]), distances(rows[:, self.half:], self.books[1])]

    def rank(self, parts, cells) -> np.ndarray:
        """How many cells are nearer to each row than the cell given for it."""
        d1, d2 = parts
        width = d2.shape[1]
        rows = np.arange(len(d1))
        limit = d1[rows, cells // width] + d2[rows, cells % width]
        return np.array([np.searchsorted(np.sort(b), x - a, "left").sum() for a, b, x in zip(d1, d2, limit, strict=True)])

    def calibrate(self, rows: np.ndarray, cosine: float, target: float, rng) -> int:
        """Visits that find ``target`` of random pairs at the threshold from one side or the other."""
        aside = rng.normal(size=rows.shape)
        aside -= (aside * rows).sum(1, keepdims=True) * rows
        norm = np.sqrt((aside * aside).sum(1, keepdims=True))
        other = cosine * rows + np.sqrt(1 - cosine * cosine) * np.where(norm > 0, aside / np.maximum(norm, 1e-300), 0)
        mine, theirs = self.parts(rows), self.parts(other)
        deep = np.minimum(self.rank(mine, self.own(theirs)), self.rank(theirs, self.own(mine)))
        cells = len(self.books[0]) * len(self.books[1])
        return int(min(cells, np.quantile(deep, target, method="higher") + 1))

    def own(self, parts) -> np.ndarray:
        return parts[0].argmin(1) * parts[1].shape[1] + parts[1].argmin(1)

    def visited(self, parts) -> np.ndarray:
        """The nearest ``visits`` cells of each row.  A cell at ranks (i, j) of the two halves has (i + 1)(j + 1) - 1
        others before it, so only ranks with a product up to ``visits`` can be among them."""
        t = self.visits
        order = [p.argsort(1, kind="stable") for p in parts]
        i, j = np.array([(i, j) for i in range(min(t, parts[0].shape[1])) for j in range(min(t // (i + 1), parts[1].shape[1]))]).T
        sums = np.take_along_axis(parts[0], order[0], 1)[:, i] + np.take_along_axis(parts[1], order[1], 1)[:, j]
        best = sums.argsort(1, kind="stable")[:, :t]
        return np.take_along_axis(order[0], i[best], 1) * parts[1].shape[1] + np.take_along_axis(order[1], j[best], 1)


def usable(vector):
    """Whether a vector can link: not null or empty, all components finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def indexed(vectors: DataFrame, grid: Grid) -> DataFrame:
    """(id, copies, vector, own, cells): every vector with its cell and the cells it visits."""
    sent = vectors.sparkSession.sparkContext.broadcast(grid)

    def run(batches):
        for b in batches:
            rows = unit(np.array(b.column(2).to_pylist(), np.float64))
            parts = sent.value.parts(rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in rows], pa.binary()),
                                              pa.array(sent.value.own(parts), pa.int64()), pa.array(list(sent.value.visited(parts).astype(np.int64)), pa.list_(pa.int64()))],
                                             ["id", "copies", "vector", "own", "cells"])

    return vectors.select("id", "copies", "v").mapInArrow(run, "id long, copies long, vector binary, own long, cells array<long>")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component, for links a[i] - b[i] among n nodes in order."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def compared(index: DataFrame, cosine: float) -> DataFrame:
    """(id, n, root) for every vector linked within a block: how many copies of others it links with there, and
    the smallest vector that the block's links connect it to.

    A pair is counted once: where the one with the smaller id visits the other's cell, or, if it does not, where
    the other visits its.  Cells with more members or visitors than a block holds are dealt over several
    blocks, and every block of visitors meets every block of members.
    """
    visits = index.select("id", "own", "vector", "copies", F.explode("cells").alias("cell"))
    members = index.groupBy(F.col("own").alias("cell")).agg(F.count("*").alias("m"))
    sizes = members.join(visits.groupBy("cell").agg(F.count("*").alias("v")), "cell")
    sizes = sizes.select("cell", F.ceil(F.col("m") / MEMBERS).cast("int").alias("mb"), F.ceil(F.col("v") / VISITORS).cast("int").alias("vb"))
    sizes = maybe_broadcast(stored(sizes))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = index.withColumnRenamed("own", "cell").join(sizes, "cell").select("cell", part("mb").alias("x"), each("vb").alias("y"), "id", "vector", "copies", "cells")
    theirs = visits.join(sizes, "cell").select("cell", each("mb").alias("x"), part("vb").alias("y"), *[F.col(c).alias(f"v_{c}") for c in ("id", "vector", "copies", "own")])

    def meet(members: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(visitors):
            return pd.DataFrame({"id": [], "n": [], "root": []}).astype("int64")
        m = np.frombuffer(b"".join(members["vector"]), np.float64).reshape(len(members), -1)
        v = np.frombuffer(b"".join(visitors["v_vector"]), np.float64).reshape(len(visitors), -1)
        mi, vi = members["id"].to_numpy(), visitors["v_id"].to_numpy()
        mc, vc = members["copies"].to_numpy(), visitors["v_copies"].to_numpy()
        own, back = np.unique(visitors["v_own"].to_numpy(), return_inverse=True)
        seen = np.array([np.isin(own, c) for c in members["cells"]])             # does the member visit the visitor's cell?
        hit = (v @ m.T >= cosine) & ((vi[:, None] < mi) | ~seen[:, back].T) & (vi[:, None] != mi)
        a, b = np.nonzero(hit)
        ids, at = np.unique(np.concatenate([vi[a], mi[b]]), return_inverse=True)
        x, y = at[:len(a)], at[len(a):]
        n = np.bincount(x, mc[b], len(ids)) + np.bincount(y, vc[a], len(ids))
        return pd.DataFrame({"id": ids, "n": n.astype(np.int64), "root": ids[forest(x, y, len(ids))]})

    keys = ["cell", "x", "y"]
    return mine.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInPandas(meet, "id long, n long, root long")


def fitted(vectors: DataFrame, count: int, width: int, cosine: float) -> Grid:
    """The grid for ``count`` vectors of ``width`` components, from the sample with the lowest hashes."""
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * width)))
    rows = vectors.select("v").orderBy(F.xxhash64("id"), "id").limit(most).toArrow()["v"].to_pylist()
    return Grid(unit(np.array(rows, np.float64)), count, cosine)


def near_duplicates(embeddings: DataFrame, cosine: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``embeddings``.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
    different widths don't either.  Equal vectors are one to the index and link with each other; rows that repeat a
    vec_id count as rows.  ``n_links`` counts other rows linked directly, component_id is the smallest vec_id reachable.
    Rows with a null key are left out; other columns play no part.
    """
    rows = embeddings.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(usable(F.col("v")), F.transform("v", lambda x: x + F.lit(0.0))))
    good = rows.where("v is not null")
    vectors = stored(good.groupBy("v").agg(F.min("k").alias("id"), F.count("*").alias("copies")))
    widths = vectors.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy("w").toLocalIterator()
    found = None
    for width in list(widths):
        own = vectors.where(F.size("v") == width["w"])
        part = compared(stored(indexed(own, fitted(own, width["n"], width["w"], cosine))), cosine)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select(F.col("k").cast(embeddings.schema[key].dataType).alias(key), F.lit(0).cast("long").alias("n_links"), F.col("k").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found)
    linked = found.groupBy("id").agg(F.sum("n").alias("n"))
    comp = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = vectors.join(linked, "id", "left").join(comp, "id", "left").select(
        "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    out = rows.join(named, "v", "left").select(F.col("k"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "k").alias("component_id"))
    return out.select(F.col("k").cast(embeddings.schema[key].dataType).alias(key), "n_links", "component_id", (F.col("k") == F.col("component_id")).alias("kept"))
