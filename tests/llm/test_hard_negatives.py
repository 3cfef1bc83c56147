"""Hard negatives against comparing all rows with all; the tree's bounds against its rows."""
import math
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("boxloom.llm")
from boxloom.llm import hard_negatives  # noqa: E402


def brute(rows):
    one = {}
    for k, v, label in sorted((r for r in rows if None not in r[:3]), key=lambda r: (r[0], r[2], r[1])):
        if all(x is not None and math.isfinite(x) for x in v):
            one.setdefault(k, ([math.floor(256 * x) for x in v], (label + 1) % 10 if k % 7 == 0 else label))
    out = set()
    for a, (v, label) in one.items():
        if a % 50:
            continue
        score = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), k, l) for k, (w, l) in one.items() if k != a and len(w) == len(v))
        for p, k, _ in [s for s in score if s[2] == label][:5]:
            fits = [(s, n) for s, n, l in score if l != label and 50 * -p <= 100 * -s <= 95 * -p]
            out |= {(a, k, i + 1, n, -p, -s) for i, (s, n) in enumerate(fits[:3])}
    return out


def vectors(n, width, seed, spread=0.3):
    r = np.random.default_rng(seed)
    base = r.normal(size=(12, width))
    rows = [(i, [float(np.float32(x)) for x in base[i % 12] * 0.6 + r.normal(size=width) * spread], int(r.integers(0, 4))) for i in range(n)]
    rows += [(n + i, rows[3][1], i % 4) for i in range(n // 3)]          # a third are copies
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int, rank int, leaf string, id long"


@pytest.mark.parametrize("leaf,block", [(512, 2048), (20, 16)])
def test_against_all_pairs(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(hard_negatives.Tree.__init__, "__defaults__", (4, leaf))
    monkeypatch.setattr(hard_negatives, "MEMBERS", block)
    monkeypatch.setattr(hard_negatives, "VISITORS", block // 4)
    rows = vectors(900, 12, 3) + [(2000, None, 1), (2001, [0.1] * 12, None), (2050, [0.1, None] * 6, 1), (2100, [float("nan")] * 12, 2), (2150, [0.0] * 12, 3),
                                  (2200, [1.0, 2.0], 1), (2201, [0.9, 1.0], 2), (2202, [1.0, 1.8], 1), (2250, [], 1), (2251, [], 2), (2252, [], 1),
                                  (None, [0.1] * 12, 1), (50, [0.2] * 12, 1), (50, [0.2] * 12, 1), (-100, [0.3] * 12, -1)]
    df = spark.createDataFrame([(*r, 7, "x", 8) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in hard_negatives.mine(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert {2200, 2250, 50} <= {g[0] for g in got}


def test_large_components(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(size=3) * 2.0 ** 18], i % 3) for i in range(0, 120)]
    df = spark.createDataFrame([(*x, 7, "x", 8) for x in rows], SCHEMA)
    assert {tuple(x) for x in hard_negatives.mine(df).collect()} == brute(rows)
    big = hard_negatives.products(np.array([[2.0 ** 60, 1.0]]), np.array([[2.0 ** 40, 3.0], [5.0, 7.0]]))
    assert big.tolist() == [[hard_negatives.FAR, 5 * 2 ** 60 + 7]]


def test_empty(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bounds_leave_out_no_row_and_do_leave_out_leaves():
    rows = hard_negatives.scaled([v for _, v, _ in vectors(1500, 8, 5, 0.08)], 8)
    tree = hard_negatives.Tree(rows, len(rows), 4, 60)
    found = [dict(slot=s, i=i, low=a, high=b) for (s, i), (a, b) in tree.ranges(rows).items()]
    bounds, leaf = hard_negatives.Bounds(tree, found), tree.leaves(rows)
    anchors = rows[::40]
    score = anchors @ rows.T
    highs = np.quantile(score, [0.99, 1.0], axis=1).T
    lows = np.quantile(score, [0.97, 0.995], axis=1).T
    entered = bounds.entered(anchors, lows, highs)
    for a in range(len(anchors)):
        hit = ((score[a][:, None] >= lows[a]) & (score[a][:, None] <= highs[a])).any(1)
        assert entered[a, np.unique(leaf[hit])].all()
    assert entered.sum() < 0.5 * entered.shape[0] * len(np.unique(leaf))


def test_few_anchors_at_a_time(monkeypatch):
    """Anchors that enter every leaf come out in batches of bounded size, the same ones as all at once."""
    monkeypatch.setattr(hard_negatives, "ENTERED", 600, raising=False)
    rows = hard_negatives.scaled([v for _, v, _ in vectors(300, 6, 5)], 6)
    tree = hard_negatives.Tree(rows, len(rows), 4, 20)
    bounds = hard_negatives.Bounds(tree, [{"slot": s, "i": i, "low": low, "high": high} for (s, i), (low, high) in tree.ranges(rows).items()])
    frame = SimpleNamespace(select=lambda *_: frame, mapInArrow=lambda run, _: run)
    wide = pa.array([[hard_negatives.FAR]] * len(rows), pa.list_(pa.int64()))
    low = pa.array([[-hard_negatives.FAR]] * len(rows), pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([1] * len(rows)), pa.array([r.tobytes() for r in rows]), low, wide],
                                       ["id", "label", "vector", "lows", "highs"])
    for first in (False, True):
        out = list(hard_negatives.visits(frame, SimpleNamespace(value=bounds), 6, first)(iter([batch])))
        got = [x for b in out for x in zip(b["id"].to_pylist(), b["leaf"].to_pylist(), strict=True)]
        assert max(b.num_rows for b in out) <= 600 < len(tree.points) * len(rows)
        leaves = {int(x) for x in np.flatnonzero(np.array(tree.below) < 0)}
        assert len(set(got)) == len(got) and {i for i, _ in got} == set(range(len(rows))) and (first or {leaf for _, leaf in got} <= leaves and len(got) > 600)
