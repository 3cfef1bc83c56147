"""Matching and metrics against loops that walk detections in order."""
import random
from types import SimpleNamespace

import numpy as np
import pytest
from helpers import area, groups, inter, iou

from boxloom.operators import evaluate as E
from boxloom.operators import curve, reports, sampling
from boxloom.plans.queries import evaluation as queries

PRED = "image_id long, label string, det int, score double, x1 double, y1 double, x2 double, y2 double"
GT = "image_id long, label string, gt int, x1 double, y1 double, x2 double, y2 double, difficult boolean, iscrowd int"


def make(seed):
    r = random.Random(seed)
    pred, gt = [], []
    for image in range(6):
        boxes = []
        for g in range(r.randrange(1, 7)):
            x, y = r.randrange(60), r.randrange(60)
            b = (float(x), float(y), float(x + r.choice([20, 45, 90])), float(y + r.choice([20, 45, 90])))
            boxes.append(b)
            gt.append((image, f"c{r.randrange(2)}", g, *b, r.random() < 0.15, int(r.random() < 0.15)))
        for d in range(r.randrange(0, 14)):
            b = r.choice(boxes)
            j = lambda v: v + r.randrange(-4, 5)
            pred.append((image, f"c{r.randrange(2)}", d, r.randrange(1, 40) / 40, j(b[0]), j(b[1]), j(b[2]), j(b[3])))
    return pred, gt


def ap_area(tp, fp, npos):
    tp, fp = np.cumsum(tp), np.cumsum(fp)
    rec, prec = tp / npos, tp / np.maximum(tp + fp, 1e-12)
    mrec, mpre = np.r_[0, rec, 1], np.r_[0, prec, 0]
    for i in range(len(mpre) - 1, 0, -1):
        mpre[i - 1] = max(mpre[i - 1], mpre[i])
    i = np.where(mrec[1:] != mrec[:-1])[0]
    return float(np.sum((mrec[i + 1] - mrec[i]) * mpre[i + 1]))


def ap_points(tp, fp, npos, grid):
    tp, fp = np.cumsum(tp), np.cumsum(fp)
    rec, prec = tp / npos, tp / np.maximum(tp + fp, 1e-12)
    return float(np.mean([prec[rec >= g].max() if (rec >= g).any() else 0.0 for g in grid]))


@pytest.mark.parametrize("hot", [None, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_voc(spark, seed, hot):
    pred, gt = make(seed)
    p, g = spark.createDataFrame(pred, PRED), spark.createDataFrame(gt, GT).drop("iscrowd")
    for method in ("area", "eleven"):
        got = {(r.label, r.threshold): r.ap for r in E.voc_ap(p, g, [0.5, 0.75], method, hot).collect()}
        for c in ("c0", "c1"):
            mine = {k: v for k, v in groups([x for x in gt if x[1] == c], lambda x: x[0]).items()}
            npos = sum(not x[7] for v in mine.values() for x in v)
            for t in (0.5, 0.75):
                used, tp, fp = set(), [], []
                for d in sorted((x for x in pred if x[1] == c), key=lambda x: (-x[3], x[0], x[2])):
                    best = max(mine.get(d[0], []), key=lambda x: (iou(d[4:8], x[3:7], 1), -x[2]), default=None)
                    hit = best is not None and iou(d[4:8], best[3:7], 1) > t
                    if hit and best[7]:
                        tp.append(0), fp.append(0)
                        continue
                    ok = hit and best[:3] not in used
                    if ok:
                        used.add(best[:3])
                    tp.append(int(ok)), fp.append(int(not ok))
                want = ap_area(tp, fp, npos) if method == "area" else ap_points(tp, fp, npos, np.arange(0, 1.1, 0.1))
                assert got[(c, t)] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("hot", [None, True])
def test_simple_map(spark, hot):
    pred, gt = make(3)
    p, g = spark.createDataFrame(pred, PRED), spark.createDataFrame(gt, GT).drop("iscrowd", "difficult")
    stats = {c: [0, 0, 0] for c in ("c0", "c1")}
    for image in range(6):
        mine = [x for x in gt if x[0] == image]
        used = set()
        for d in sorted((x for x in pred if x[0] == image), key=lambda x: (-x[3], x[2])):
            v = [inter(d[4:8], x[3:7]) / (area(d[4:8]) + area(x[3:7]) - inter(d[4:8], x[3:7]) + 1e-6) for x in mine]
            i = int(np.argmax(v))
            ok = v[i] >= 0.5 and mine[i][1] == d[1] and i not in used
            if ok:
                used.add(i)
            stats[d[1]][0 if ok else 1] += 1
        for i, x in enumerate(mine):
            stats[x[1]][2] += i not in used
    got = {r.label: (r.tp, r.fp, r.fn) for r in E.simple_map(p, g, 0.5, hot=hot).collect()}
    assert got == {**{c: tuple(v) for c, v in stats.items()}, None: tuple(sum(v[i] for v in stats.values()) for i in range(3))}


def test_coco_plans_agree(spark, monkeypatch):
    """Walked, settled in rounds, and each for some images and classes; all fine-grained ranges and thresholds."""
    pred, gt = make(7)
    p, g = spark.createDataFrame(pred, PRED), spark.createDataFrame(gt, GT).drop("difficult")
    areas = E.AREAS | E.MORE_AREAS
    assert len(areas) == 17 and areas["0-8"] == (0, 64) and areas["256-"] == (65536, 1e10)
    monkeypatch.setattr(E, "FOLD_PAIRS", 4)
    walked, settled, mixed = (sorted(map(str, E.coco_matches(p, g, areas=areas, hot=hot).collect())) for hot in (False, True, None))
    assert walked == settled == mixed and any("tp=[True, True" in r for r in walked)
    assert E.coco_ap(E.coco_class_ap(p, g, areas=areas, hot=False), areas).count() == 19


@pytest.mark.parametrize("hot", [None, True])
@pytest.mark.parametrize("seed", [1, 4])
def test_coco(spark, seed, hot):
    """The published protocol, detection by detection."""
    pred, gt = make(seed)
    p, g = spark.createDataFrame(pred, PRED), spark.createDataFrame(gt, GT).drop("difficult")
    areas = {"all": (0, 1e10), "small": (0, 1600.0), "large": (1600.0, 1e10)}
    got = {(r.label, r.area_range, r.threshold): r.ap for r in E.coco_class_ap(p, g, [0.5, 0.75], areas, 6, hot=hot).collect()}
    seen = set()
    for c in ("c0", "c1"):
        for name, (lo, hi) in areas.items():
            for t in (0.5, 0.75):
                rows, npos = [], 0
                for image in range(6):
                    gs = [x for x in gt if x[0] == image and x[1] == c]
                    ig = [bool(x[8]) or not lo <= area(x[3:7]) <= hi for x in gs]
                    npos += ig.count(False)
                    order = sorted(range(len(gs)), key=lambda i: (ig[i], i))
                    matched = set()
                    ds = sorted((x for x in pred if x[0] == image and x[1] == c), key=lambda x: (-x[3], x[2]))[:6]
                    for d in ds:
                        best, m = min(t, 1 - 1e-10), None
                        for i in order:
                            if i in matched and not gs[i][8]:
                                continue
                            if m is not None and not ig[m] and ig[i]:
                                break
                            v = inter(d[4:8], gs[i][3:7]) / area(d[4:8]) if gs[i][8] else iou(d[4:8], gs[i][3:7])
                            if v < best:
                                continue
                            best, m = v, i
                        if m is not None:
                            matched.add(m)
                            rows.append((d, not ig[m], False))
                        else:
                            rows.append((d, False, lo <= area(d[4:8]) <= hi))
                if not npos:
                    continue
                rows.sort(key=lambda r: (-r[0][3], r[0][0], r[0][2]))
                want = ap_points([int(r[1]) for r in rows], [int(r[2]) for r in rows], npos, np.linspace(0, 1, 101)) if rows else 0.0
                seen.add((c, name, t))
                assert got[(c, name, t)] == pytest.approx(want, abs=1e-9), (c, name, t)
    assert set(got) == seen


@pytest.mark.parametrize("hot", [None, True])
def test_proposal_recall(spark, hot):
    pred, gt = make(5)
    p, g = spark.createDataFrame(pred, PRED), spark.createDataFrame(gt, GT).drop("difficult", "iscrowd")
    areas = {"all": (0, 1e10), "small": (0, 1600.0)}
    steps = E.THRESHOLDS
    for skip in (False, True):
        got = {r.area_range: (r.npos, r.recall) for r in E.proposal_recall(p, g, 5, areas, skip_empty=skip, hot=hot).collect()}
        for name, (lo, hi) in areas.items():
            found, npos = [], 0
            for image in range(6):
                top = sorted((x for x in pred if x[0] == image), key=lambda x: (-x[3], x[2]))[:5]
                gs = [x for x in gt if x[0] == image and lo <= area(x[3:7]) <= hi]
                if skip and not top:
                    continue
                npos += len(gs)
                left, free = list(top), list(gs)
                while left and free:
                    v, _, _, b, d = max((iou(d[4:8], b[3:7]), -b[2], -d[2], b, d) for d in left for b in free)
                    found.append(v)
                    left.remove(d), free.remove(b)
            assert got[name][0] == npos
            assert got[name][1] == pytest.approx(sum(v >= t for v in found for t in steps) / (npos * len(steps)))


def test_lvis_rules(spark):
    pred = [(0, "a", 0, 0.9, 0.0, 0.0, 10.0, 10.0), (0, "b", 1, 0.8, 0.0, 0.0, 10.0, 10.0), (0, "c", 2, 0.7, 50.0, 50.0, 60.0, 60.0),
            (0, "a", 3, 0.95, 70.0, 70.0, 80.0, 80.0)]
    gt = [(0, "a", 0, 0.0, 0.0, 10.0, 10.0), (1, "b", 0, 0.0, 0.0, 10.0, 10.0)]
    s = "image_id long, label string, gt int, x1 double, y1 double, x2 double, y2 double"
    freq = spark.createDataFrame([("a", "f"), ("b", "r"), ("c", "c")], "label string, frequency string")
    none = spark.createDataFrame([], "image_id long, label string")
    p, g = spark.createDataFrame(pred, PRED), spark.createDataFrame(gt, s)
    strict = E.lvis_ap(p, g, freq, none, none).first()
    # the better-scored miss halves precision of class a; class b was never checked in image 0, so its box is ignored
    assert strict.ap_frequent == pytest.approx(50.0) and strict.ap_rare == 0.0 and strict.ap_common is None
    loose = E.lvis_ap(p, g, freq, none, spark.createDataFrame([(0, "a")], "image_id long, label string")).first()
    assert loose.ap_frequent == pytest.approx(100.0)


def test_repeat_factors(spark):
    images = spark.range(3).withColumnRenamed("id", "image_id")
    anns = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "image_id long, category_id int")
    got = {r.image_id: r.repeat_factor for r in sampling.repeat_factors(anns, images, 0.5).collect()}
    assert got[0] == pytest.approx(1.5 ** 0.5) and got[1] == 1.0 and got[2] == 1.0


def test_panoptic_perfect_and_void(spark):
    px = [(0, s, s) for s in (1000, 1001, 2000) for _ in range(10)] + [(0, 3000, -1)] * 5
    q = {r.part: (r.pq, r.sq, r.rq) for r in E.panoptic_quality(spark.createDataFrame(px, "image_id long, pred_seg int, gt_seg int"), things=[1]).collect()}
    assert q["all"] == (100.0, 100.0, 100.0) and "class-3" not in q


def test_segmentation_without_truth(spark):
    px = spark.createDataFrame([(0, 0)] * 3 + [(1, 0)] + [(1, 255)], "pred int, gt int")
    s = {r["class"]: (r.iou, r.acc) for r in reports.class_scores(reports.confusion_matrix(px, 2), 2).collect()}
    assert s == {0: (75.0, 75.0), 1: (None, None)}


def test_verify_metrics(spark):
    want = spark.createDataFrame([("a", "m", 1.0, 0.1), ("a", "n", 1.0, 0.1), ("b", "m", 1.0, 0.1)], "task string, metric string, expected double, tolerance double")
    have = spark.createDataFrame([("a", "m", 1.05), ("a", "n", float("nan"))], "task string, metric string, value double")
    assert {(r.task, r.metric): r.ok for r in E.verify_metrics(want, have).collect()} == {("a", "m"): True, ("a", "n"): False, ("b", "m"): False}


DETECTIONS = "image_id long, label string, priority int, seq int, score double, x1 double, y1 double, x2 double, y2 double"


def test_coco_ap_takes_every_detection_and_threshold(spark):
    """Seven true boxes of a class in an image, each found with an overlap of 0.82: right at seven of the ten thresholds."""
    rows = [(0, "a", p, k, 0.9 - k / 100, 200.0 * k, 0.0, 200.0 * k + 100, 100.0 if p == 1 else 82.0) for k in range(1, 8) for p in (1, 2)]
    t = SimpleNamespace(detections=spark.createDataFrame(rows, DETECTIONS))
    got = {r.metric: r.value for r in queries.coco_ap(t).collect()}
    assert got["AP"] == pytest.approx(70.0) and got["AP50"] == got["AP75"] == pytest.approx(100.0)


def test_lvis_ap_takes_every_detection(spark):
    """Thirty true boxes in an image, each found: all count, not the best twenty."""
    rows = [(0, "person", p, k, 0.9 - k / 100, 200.0 * k, 0.0, 200.0 * k + 100, 100.0) for k in range(1, 31) for p in (1, 3)]
    got = queries.lvis_ap(SimpleNamespace(detections=spark.createDataFrame(rows, DETECTIONS))).first()
    assert got.ap == pytest.approx(100.0) and got.ap_frequent == pytest.approx(100.0)


def test_states_are_counted_without_a_row_for_each(spark, monkeypatch):
    """One row a detection for all seventeen ranges and ten thresholds, in small blocks and runs of a class over several tasks: the
    same as by a row for each range."""
    pred, gt = make(11)
    pred += [(i + 6 * k, *rest) for i, *rest in pred for k in range(1, 5)] + [(0, None, 99, 0.5, 0.0, 0.0, 9.0, 9.0), (0, "c0", 98, None, 0.0, 0.0, 9.0, None)]
    gt += [(i + 6 * k, *rest) for i, *rest in gt for k in range(1, 5)] + [(0, None, 99, 0.0, 0.0, 9.0, 9.0, False, 0), (0, "none", 98, 0.0, 0.0, 9.0, 9.0, False, 0)]
    p, g = spark.createDataFrame(pred, PRED), spark.createDataFrame(gt, GT).drop("difficult")
    areas = E.AREAS | E.MORE_AREAS
    by_row = E.coco_class_ap(p, g, areas=areas, matches=E.coco_matches(p, g, areas=areas, hot=False), hot=True)
    want = {(r.label, r.area_range, r.threshold): r.ap for r in by_row.collect()}
    monkeypatch.setattr(curve, "BLOCK", 3)
    monkeypatch.setattr(E.scale, "running", None)          # windows over a row for each range
    got = {(r.label, r.area_range, r.threshold): r.ap for r in E.coco_class_ap(p, g, areas=areas, hot=False).collect()}
    assert got == pytest.approx(want, abs=1e-12) and any(0 < v < 1 for v in got.values()) and (None, "all", 0.5) in got
