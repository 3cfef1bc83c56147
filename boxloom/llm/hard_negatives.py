"""Hard negatives from a multiway hyperplane tree (GNAT) over vectors of integers.

Each node of the tree has a few split points far from one another; a vector goes to the nearest, so the children are
bounded by hyperplanes.  For every child the node keeps the range of distances from each of its siblings' split
points to the child's vectors, and of the vectors' lengths.  A window of inner products with an anchor is, for vectors of lengths in
a range, an annulus of distances around the anchor; a child whose ranges show that none of its vectors lies in the
annulus is not entered.  The leaves that are left are searched exactly.

Split points come from a bounded sample; every vector is indexed, and the ranges are taken over all of them.  Anchors
meet the vectors of a leaf in blocks of bounded size, however large the leaf.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm.common import slices, stored
from boxloom.scale import maybe_broadcast

SAMPLE = 16_384                      # vectors that split points are chosen from at most
SAMPLE_BYTES = 32 << 20
WAYS = 8                             # split points of a node
LEAF = 512                           # vectors that a leaf should have at most, as far as the sample goes
MEMBERS, VISITORS = 2048, 1024       # rows of a leaf's block
ENTERED = 1 << 16                    # anchors times split points that are looked at in one go
FAR = (1 << 63) - 1


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(1)[:, None] - 2 * rows @ points.T + (points * points).sum(1)
    return np.sqrt(np.maximum(square, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; those beyond a long are the largest or smallest long."""
    size = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if size < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape)
    return np.array([[max(-FAR, min(FAR, v)) for v in r] for r in (whole(a) @ whole(b).T).tolist()], np.int64).reshape(len(a), len(b))


class Tree:
    """Split points of all nodes.  A slot is one split point with its child; leaves are slots without a node below."""

    def __init__(self, sample: np.ndarray, count: int, ways: int = WAYS, leaf: int = LEAF):
        rng = np.random.default_rng(11)
        self.points, self.up, self.below, self.nodes = [], [], [], []
        share = count / max(1, len(sample))
        self.split(sample, -1, ways, max(ways, int(leaf / share)), rng)
        self.points = np.array(self.points).reshape(len(self.points), sample.shape[1])

    def split(self, rows: np.ndarray, up: int, ways: int, leaf: int, rng) -> int:
        """A node over ``rows``; its number."""
        pool = np.unique(rows[rng.choice(len(rows), min(len(rows), 3 * ways), replace=False)], axis=0)
        chosen = [int(rng.integers(len(pool)))]
        near = distances(pool, pool[chosen])[:, 0]
        while len(chosen) < min(ways, len(pool)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, distances(pool, pool[chosen[-1:]])[:, 0])
        number, first = len(self.nodes), len(self.points)
        slots = np.arange(first, first + len(chosen))
        self.nodes.append(slots)
        self.points += list(pool[chosen])
        self.up += [up] * len(chosen)
        self.below += [-1] * len(chosen)
        to = distances(rows, pool[chosen]).argmin(1)
        for i, slot in enumerate(slots):
            own = rows[to == i]
            if len(chosen) > 1 and len(own) > leaf and len(own) < len(rows) and (own != own[0]).any():
                self.below[slot] = self.split(own, int(slot), ways, leaf, rng)
        return number

    def walk(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For every node that some rows reach: its slots, those rows, their distances to its points, and which is nearest."""
        todo = [(0, np.arange(len(rows)))]
        while todo:
            number, at = todo.pop()
            slots = self.nodes[number]
            d = distances(rows[at], self.points[slots])
            to = d.argmin(1)
            yield slots, at, d, to
            todo += [(self.below[s], at[to == i]) for i, s in enumerate(slots) if self.below[s] >= 0 and (to == i).any()]

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        for slots, at, _, to in self.walk(rows):
            out[at] = slots[to]
        return out

    def ranges(self, rows: np.ndarray) -> dict[tuple[int, int], tuple[float, float]]:
        """Of each child: the range of its rows' distances to each sibling's point, and, at -1, of their squared lengths."""
        out, square = {}, (rows * rows).sum(1)
        for slots, at, d, to in self.walk(rows):
            for j, slot in enumerate(slots):
                mine = to == j
                if mine.any():
                    own = square[at[mine]]
                    out[int(slot), -1] = own.min(), own.max()
                    for i, (low, high) in enumerate(zip(d[mine].min(0), d[mine].max(0), strict=True)):
                        out[int(slot), i] = low, high
        return out


class Bounds:
    """A tree with the ranges over all vectors."""

    def __init__(self, tree: Tree, rows: list):
        self.tree = tree
        n, most = len(tree.points), max(len(s) for s in tree.nodes)
        self.low, self.high = np.full((n, most), np.inf), np.full((n, most), -np.inf)
        self.length = np.tile([np.inf, -np.inf], (n, 1))
        for r in rows:
            if r["i"] < 0:
                self.length[r["slot"]] = r["low"], r["high"]
            else:
                self.low[r["slot"], r["i"]], self.high[r["slot"], r["i"]] = r["low"], r["high"]

    def entered(self, anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """Which leaves (as slots) may hold a vector whose product with the anchor lies in one of its windows.
        ``lows`` and ``highs``: a row of windows for each anchor; a window with low > high is none."""
        tree, square = self.tree, (anchors * anchors).sum(1)[:, None]
        alive = np.zeros((len(anchors), len(tree.points)), bool)
        for slots in tree.nodes:
            d = distances(anchors, tree.points[slots])[:, None, :]
            low, high = self.low[slots, :len(slots)], self.high[slots, :len(slots)]
            near = np.maximum(np.maximum(d - high, low - d), 0).max(2)
            far = (d + high).min(2)
            least, most = self.length[slots].T
            slack = 1e-6 * (1 + square + np.where(np.isfinite(most), most, 0))
            some = np.zeros(near.shape, bool)
            for w in range(lows.shape[1]):
                a, b = lows[:, w, None], highs[:, w, None]
                some |= (a <= b) & (far * far + slack >= square + least - 2 * b) & (near * near - slack <= square + most - 2 * a)
            up = tree.up[slots[0]]
            alive[:, slots] = some & np.isfinite(least) & (alive[:, [up]] if up >= 0 else True)
        return alive & (np.array(tree.below) < 0)


def matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), width)


def prepared(embeddings: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, v) of the rows that take part, once per id, with the label as it counts and whole components."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(fine)
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*")
    return rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def scaled(rows: list, width: int) -> np.ndarray:
    return np.floor(256 * np.array(rows, np.float64).reshape(len(rows), width))


def indexed(rows: DataFrame, tree, width: int) -> DataFrame:
    def run(batches):
        for b in batches:
            v = scaled(b.column(2).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in v], pa.binary()), pa.array(tree.value.leaves(v))],
                                             ["id", "label", "vector", "leaf"])

    return rows.mapInArrow(run, "id long, label long, vector binary, leaf long")


def measured(index: DataFrame, tree, width: int) -> list:
    """The ranges over all rows: each task's own, then the least and greatest of all tasks'."""
    def run(batches):
        total = {}
        for b in batches:
            for k, (low, high) in tree.value.ranges(matrix(b.column(0).to_pylist(), width)).items():
                was = total.get(k, (low, high))
                total[k] = min(was[0], low), max(was[1], high)
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)] + [pa.array([total[k][i] for k in keys], pa.float64()) for i in (0, 1)],
                                         ["slot", "i", "low", "high"])

    parts = index.select("vector").mapInArrow(run, "slot int, i int, low double, high double")
    return parts.groupBy("slot", "i").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()      # a few per split point of the bounded tree


def first_rows(score: np.ndarray, able: np.ndarray, lows: np.ndarray, highs: np.ndarray, top: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """For each window, the places (row, column) of the ``top`` highest scores of each row in it; of equal ones the first columns."""
    n = score.shape[1]
    size = 1 << n.bit_length()
    if np.abs(score).max() >= (1 << 62) // size:
        rank = np.unique(score, return_inverse=True)[1].reshape(score.shape)
    else:
        rank = score
    key = rank * size + np.arange(n)[::-1]
    for w in range(lows.shape[1]):
        mine = np.where(able & (score >= lows[:, w, None]) & (score <= highs[:, w, None]), key, -FAR)
        at = np.argpartition(mine, n - top, axis=1)[:, n - top:] if top < n else np.tile(np.arange(n), (len(mine), 1))
        row, place = np.nonzero(np.take_along_axis(mine, at, 1) > -FAR)
        yield row, w, at[row, place]


WINDOWS = "id long, label long, vector binary, lows array<long>, highs array<long>"


def visits(anchors: DataFrame, bounds, width: int, first: bool = False) -> DataFrame:
    """Anchors with their windows, once for each leaf to search.  ``first``: only the leaf of each window whose split
    point's product with the anchor lies nearest to the window's upper end.

    An anchor may enter most leaves and comes out once for each, so few anchors are taken at a time."""
    def run(batches):
        own = bounds.value
        for b in slices(batches, max(1, ENTERED // len(own.tree.points))):
            if not b.num_rows:
                continue
            v = matrix(b.column(2).to_pylist(), width)
            lows, highs = (np.array(b.column(i).to_pylist(), np.float64).reshape(len(v), -1) for i in (3, 4))
            alive = own.entered(v, lows, highs)
            if first:
                score = v @ own.tree.points.T
                some = np.zeros_like(alive)
                for w in range(lows.shape[1]):
                    off = np.where(alive, np.abs(score - np.minimum(highs[:, w], score.max(1))[:, None]), np.inf)
                    at = off.argmin(1)
                    some[np.arange(len(v)), at] |= np.isfinite(off[np.arange(len(v)), at]) & (lows[:, w] <= highs[:, w])
                alive = some
            row, leaf = np.nonzero(alive)
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(row)).columns, pa.array(leaf.astype(np.int64))], [*b.schema.names, "leaf"])

    return anchors.select("id", "label", "vector", "lows", "highs").mapInArrow(run, WINDOWS + ", leaf long")


def met(index: DataFrame, seen: DataFrame, width: int, top: int, same: bool) -> DataFrame:
    """(anchor, w, score, id): the first ``top`` rows of each window of each anchor among the leaves it visits.

    Leaves with many vectors or visitors are dealt over several blocks, and every block of visitors meets every block of
    vectors; each meeting keeps its own first rows, and the first of those are taken."""
    sizes = index.groupBy("leaf").agg(F.count("*").alias("m")).join(seen.groupBy("leaf").agg(F.count("*").alias("v")), "leaf")
    sizes = sizes.select("leaf", F.ceil(F.col("m") / MEMBERS).cast("int").alias("mb"), F.ceil(F.col("v") / VISITORS).cast("int").alias("vb"))
    sizes = maybe_broadcast(stored(sizes))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = index.join(sizes, "leaf").select("leaf", part("mb").alias("x"), each("vb").alias("y"), "id", "label", "vector")
    theirs = seen.join(sizes, "leaf").select("leaf", each("mb").alias("x"), part("vb").alias("y"), *[F.col(c).alias(f"a_{c}") for c in ("id", "label", "vector", "lows", "highs")])

    def meet(members: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = [[np.zeros(0, np.int64)] for _ in range(4)]
        if len(members) and len(anchors):
            members = members.sort_values("id")
            ids, asking = members["id"].to_numpy(), anchors["a_id"].to_numpy()
            score = products(matrix(anchors["a_vector"], width), matrix(members["vector"], width))
            able = ((anchors["a_label"].to_numpy()[:, None] == members["label"].to_numpy()) == same) & (asking[:, None] != ids)
            lows, highs = (np.array(anchors[c].tolist(), np.int64).reshape(len(anchors), -1) for c in ("a_lows", "a_highs"))
            for a, w, m in first_rows(score, able, lows, highs, top):
                for col, v in zip(out, (asking[a], np.full(len(a), w), score[a, m], ids[m]), strict=True):
                    col.append(v)
        return pd.DataFrame(dict(zip(("anchor", "w", "score", "id"), map(np.concatenate, out), strict=True)))

    keys = ["leaf", "x", "y"]
    found = mine.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInPandas(meet, "anchor long, w long, score long, id long")
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def kth(found: DataFrame, top: int, anchors: DataFrame) -> DataFrame:
    """``anchors`` with each window's lower end raised to the score of its ``top``-th row found so far."""
    best = found.where(F.col("rank") == top).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("best"))
    raised = F.expr("transform(lows, (x, i) -> greatest(x, coalesce(best[cast(i as bigint)], x)))")
    return anchors.join(best.withColumnRenamed("anchor", "id"), "id", "left").select("id", "label", "vector", raised.alias("lows"), "highs")


def searched(index: DataFrame, anchors: DataFrame, bounds, width: int, top: int, same: bool) -> DataFrame:
    """The first ``top`` rows of every window: a look at the likeliest leaf raises the lower ends, then all leaves that the
    narrowed annuli meet are searched."""
    anchors = stored(anchors)
    look = stored(met(index, stored(visits(anchors, bounds, width, first=True)), width, top, same))
    return stored(met(index, stored(visits(kth(look, top, anchors), bounds, width)), width, top, same))


def of_width(rows: DataFrame, count: int, width: int, every: int, positives: int, negatives: int, share: tuple[int, int]) -> DataFrame:
    sc = rows.sparkSession.sparkContext
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * max(1, width))))
    sample = rows.select("v").orderBy(F.xxhash64("id"), "id").limit(most).toArrow()["v"].to_pylist()
    tree = sc.broadcast(Tree(scaled(sample, width), count))
    index = stored(indexed(rows, tree, width))
    bounds = sc.broadcast(Bounds(tree.value, measured(index, tree, width)))
    anchors = index.where(F.col("id") % every == 0).select("id", "label", "vector", F.array(F.lit(-FAR)).alias("lows"), F.array(F.lit(FAR)).alias("highs"))
    good = searched(index, anchors, bounds, width, positives, True)

    def window(batches):
        for b in batches:
            scores = b.column(3).to_pylist()
            lows = [[-(-s * share[0] // 100) for s in r] + [1] * (positives - len(r)) for r in scores]      # anchors with fewer positives get empty windows
            highs = [[s * share[1] // 100 for s in r] + [0] * (positives - len(r)) for r in scores]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(lows, pa.list_(pa.int64())), pa.array(highs, pa.list_(pa.int64()))], ["id", "label", "vector", "lows", "highs"])

    scores = good.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda r: r["score"]).alias("scores"))
    asked = index.select("id", "label", "vector").join(scores.withColumnRenamed("anchor", "id"), "id").mapInArrow(window, WINDOWS)
    bad = searched(index, asked, bounds, width, negatives, False)
    bounds.unpersist()
    tree.unpersist()
    good = good.select(F.col("anchor").alias("anchor_id"), (F.col("rank") - 1).cast("long").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    bad = bad.select(F.col("anchor").alias("anchor_id"), "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return bad.join(good, ["anchor_id", "w"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 50,
         positives: int = 5, negatives: int = 3, share: tuple[int, int] = (50, 95)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``every`` divides.  Scores are inner products of floor(256 * component), higher first, ties
    by smaller id.  An anchor's positives are its first rows of the same label; each is followed by the first rows of
    other labels whose score lies between the two shares (per cent) of the positive's.
    Rows with a null id, label or vector, or with a null or non-finite component take no part; rows that repeat an id count once, as the one
    with the smallest label, then vector.  Vectors of different widths have no score with each other; empty vectors all score 0.
    Scores beyond a long are the largest or smallest long.  Other columns play no part, an empty table gives an empty result.
    """
    rows = stored(prepared(embeddings, key, vector, label))
    widths = rows.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy("w").collect()
    found = None
    for r in widths:
        one = of_width(rows.where(F.size("v") == r["w"]), r["n"], r["w"], every, positives, negatives, share)
        found = one if found is None else found.union(one)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return found
