"""Scoring, sampling, label assignment and segmentation metrics."""
from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.operators import assign, evaluate, reports, sampling
from boxloom.plans.queries import sqltext as S
from boxloom.plans.registry import query

D, DI = ("detections",), ("detections", "images")
BOX = ["x1", "y1", "x2", "y2"]


def truth(t):
    """Boxes of the first model as ground truth, every ninth one difficult."""
    return t.detections.where("priority = 1").select("image_id", "label", F.col("seq").alias("gt"), *BOX, (F.col("seq") % 9 == 0).alias("difficult"))


def found(t):
    """Boxes of the other models as detections."""
    return t.detections.where("priority > 1").select("image_id", "label", (F.col("priority") * 1000 + F.col("seq")).alias("det"), "score", *BOX)


_GT = """gt as (select image_id, label, seq as gt, x1, y1, x2, y2, seq % 9 = 0 as difficult from detections where priority = 1),
  pr as (select image_id, label, priority * 1000 + seq as det, score, x1, y1, x2, y2 from detections where priority > 1)"""
_VOC = f"""{_GT}, c as (select p.image_id, p.label, p.det, p.score, g.gt, g.difficult, {S.iou('p', 'g', 1)} as v from pr p join gt g using (image_id, label)),
  b as (select * from (select *, row_number() over (partition by image_id, label, det order by v desc, gt) as rn from c) where rn = 1),
  th(t) as (values (0.5), (0.75)),
  h as (select b.*, t, row_number() over (partition by image_id, label, gt, t order by score desc, det) as k from b, th where v > t and not difficult),
  m as (select p.image_id, p.label, p.det, p.score, th.t, coalesce(h.k = 1, false) as tp,
      not coalesce(h.k = 1, false) and not coalesce(b.difficult and b.v > th.t, false) as fp
    from pr p cross join th left join b on b.image_id = p.image_id and b.label = p.label and b.det = p.det
    left join h on h.image_id = p.image_id and h.label = p.label and h.det = p.det and h.t = th.t)"""


@query("match_detections", f"""with {_VOC} select image_id, label, det, bool_or(tp and t = 0.5) as tp50, bool_or(fp and t = 0.5) as fp50,
   bool_or(tp and t = 0.75) as tp75, bool_or(fp and t = 0.75) as fp75 from m group by 1, 2, 3""", D)
def match_detections(t):
    m = evaluate.match_detections(found(t), truth(t), [0.5, 0.75])
    return m.select("image_id", "label", "det", F.col("tp")[0].alias("tp50"), F.col("fp")[0].alias("fp50"),
                    F.col("tp")[1].alias("tp75"), F.col("fp")[1].alias("fp75"))


_PR = """np as (select label, count(*) as npos from gt where not difficult group by 1),
  cum as (select label, t, tp, sum(tp::int) over w as ctp, sum(fp::int) over w as cfp from m
    window w as (partition by label, t order by score desc, image_id, det rows unbounded preceding)),
  pts as (select cum.label, t, ctp, ctp * 1.0::double / (ctp + cfp) as prec, ctp * 1.0::double / npos as rec, npos from cum join np using (label) where tp)"""


@query("voc_ap_area", f"""with {_VOC}, {_PR}, env as (select label, t, npos, max(prec) over (partition by label, t order by ctp desc rows unbounded preceding) as e from pts),
  ap as (select label, t, sum(e) / max(npos) as ap from env group by 1, 2)
  select np.label, cast(th.t as double) as threshold, round(coalesce(ap, 0), 6) as ap from np cross join th left join ap on ap.label = np.label and ap.t = th.t""", D)
def voc_ap_area(t):
    return evaluate.voc_ap(found(t), truth(t), [0.5, 0.75]).select("label", "threshold", F.round("ap", 6).alias("ap"))


_NPT = """rp(r) as (select i * {step}::double from (select unnest(range(0, {n})) as i)),
  bst as (select label, t, r, max(prec) as p from pts join rp on rec >= r group by 1, 2, 3),
  ap as (select label, t, sum(p) / {n} as ap from bst group by 1, 2)"""


@query("voc_ap_eleven", f"""with {_VOC}, {_PR}, {_NPT.format(step=0.1, n=11)}
  select np.label, cast(th.t as double) as threshold, round(coalesce(ap, 0), 6) as ap from np cross join th left join ap on ap.label = np.label and ap.t = th.t""", D)
def voc_ap_eleven(t):
    return evaluate.voc_ap(found(t), truth(t), [0.5, 0.75], "eleven").select("label", "threshold", F.round("ap", 6).alias("ap"))


_TEN = "(values (0.5), (0.55), (0.6), (0.65), (0.7), (0.75), (0.8), (0.85), (0.9), (0.95))"


@query("voc_map", f"""with {_VOC.replace('(values (0.5), (0.75))', _TEN)}, {_PR},
  env as (select label, t, npos, max(prec) over (partition by label, t order by ctp desc rows unbounded preceding) as e from pts),
  ap as (select label, t, sum(e) / max(npos) as ap from env group by 1, 2),
  fl as (select np.label, th.t, coalesce(ap, 0) as ap from np cross join th left join ap on ap.label = np.label and ap.t = th.t)
  select round(avg(ap) * 100, 5) as ap, round(avg(ap) filter (t = 0.5) * 100, 5) as ap50, round(avg(ap) filter (t = 0.75) * 100, 5) as ap75 from fl""", D)
def voc_map(t):
    m = evaluate.voc_map(found(t), truth(t))
    return m.select(*[F.round(c, 5).alias(c) for c in ("ap", "ap50", "ap75")])


@query("simple_map", f"""with {_GT}, kept as (select * from pr where score >= 0.2),
  c as (select p.image_id, p.label, p.det, p.score, g.gt, g.label as glabel, {S.inter('p', 'g')} / ({S.union('p', 'g')} + 1e-6) as v from kept p join gt g using (image_id)),
  b as (select * from (select *, row_number() over (partition by image_id, det order by v desc, gt) as rn from c) where rn = 1 and v >= 0.5),
  w as (select *, row_number() over (partition by image_id, gt order by score desc, det) as k from b where glabel = label),
  m as (select p.image_id, p.label, p.det, p.score, coalesce(w.k = 1, false) as tp from kept p left join w using (image_id, det)),
  np as (select label, count(*) as npos from gt where not difficult group by 1),
  cum as (select label, tp, sum(tp::int) over w as ctp, count(*) over w as n from m window w as (partition by label order by score desc, image_id, det rows unbounded preceding)),
  pts as (select cum.label, 0 as t, ctp, ctp * 1.0::double / n as prec, ctp * 1.0::double / npos as rec from cum join np using (label) where tp),
  {_NPT.format(step=0.1, n=11)},
  pc as (select np.label, count(*) filter (tp) as tp, count(*) filter (not tp) as fp, max(npos) as total_gt, coalesce(max(ap), 0) as ap
    from np left join m on m.label = np.label left join ap on ap.label = np.label group by 1),
  al as (select label, tp, fp, total_gt, ap from pc union all select null, sum(tp), sum(fp), sum(total_gt), avg(ap) from pc)
  select label, cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(total_gt - tp as bigint) as fn, round(tp * 1.0::double / (tp + fp), 6) as precision,
    round(tp * 1.0::double / total_gt, 6) as recall, round(2 * tp * 1.0::double / (tp + fp + total_gt), 6) as f1, round(ap, 6) as ap from al""", D)
def simple_map(t):
    r = evaluate.simple_map(found(t), truth(t), 0.5, 0.2)
    return r.select("label", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "ap")])


@query("per_image_cap", """select image_id, priority, seq from (select *, row_number() over (partition by image_id order by score desc, priority, seq) as rn
  from detections) where rn <= 10""", D)
def per_image_cap(t):
    return sampling.top_per_image(t.detections, 10, [F.col("score").desc(), F.col("priority"), F.col("seq")]).select("image_id", "priority", "seq")


def _ranges(t):
    return _THREE


_GREEDY = f"""{_GT}, top as (select * from (select *, row_number() over (partition by image_id order by score desc, det) as rn from pr) where rn <= 15),
  rg(area_range, lo, hi) as (values ('all', 0.0, 1e10), ('small', 0.0, 1700.0), ('large', 1700.0, 1e10)),
  sg as (select gt.*, area_range from gt, rg where (x2 - x1) * (y2 - y1) between lo and hi),
  pp as (select g.image_id, g.area_range, g.gt, p.det, {S.iou('p', 'g')} as v from top p join sg g using (image_id) where {S.iou('p', 'g')} >= 0.5),
  gl as ({S.leaders('pp', 'image_id, area_range', 'v desc, gt, det', 'v := v, g := gt, d := det', 'v double, g integer, d integer', 'k.g = d.g or k.d = d.d')}),
  tk as (select area_range, u.v as v from (select area_range, unnest(lead) as u from gl)),
  hit as (select area_range, sum(len(list_filter([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95], lambda t: v >= t::double))) as hits from tk group by 1),
  np as (select area_range, count(*) as npos from sg group by 1)"""


@query("proposal_recall", f"with {_GREEDY} select area_range, npos, round(coalesce(hits, 0) / (npos * 10.0::double), 6) as recall from np left join hit using (area_range)", D)
def proposal_recall(t):
    r = evaluate.proposal_recall(found(t), truth(t).drop("difficult"), 15, _ranges(t))
    return r.select("area_range", "npos", F.round("recall", 6).alias("recall"))


def crowd_truth(t):
    return t.detections.where("priority = 1").select("image_id", "label", F.col("seq").alias("gt"), *BOX, (F.col("seq") % 8 == 0).cast("int").alias("iscrowd"))


def _coco_sql(areas: dict, thresholds: list, per_class: int | None = 5, crowds: bool = True, extra: str = "", top: str | None = None) -> str:
    """The protocol in SQL: ground truth, ranked detections, candidate pairs, greedy choice, matches ``m``."""
    crowd = "seq % 8 = 0" if crowds else "false"
    ranked = f"select * from (select *, row_number() over (partition by image_id, label order by score desc, det) as rn from pr) where rn <= {per_class}"
    top = top or ("select * from pr" if per_class is None else ranked)
    ranges = ", ".join(f"('{k}', {float(a)}::double, {float(b)}::double)" for k, (a, b) in areas.items())
    steps = ", ".join(f"({t}::double)" for t in thresholds)
    overlap = f"case when crowd then {S.inter('p', 'g')} / {S.area('p')} else {S.iou('p', 'g')} end"
    return f"""gt as (select image_id, label, seq as gt, x1, y1, x2, y2, {crowd} as crowd, (x2 - x1) * (y2 - y1) as area from detections where priority = 1),
  pr as (select image_id, label, priority * 1000 + seq as det, score, x1, y1, x2, y2 from detections where priority > 1){extra},
  top as ({top}), rg(area_range, lo, hi) as (values {ranges}), th(t) as (values {steps}),
  cp as (select p.image_id, p.label, p.det, p.score, g.gt, g.crowd, area_range, t, case when crowd or area < lo or area > hi then 1 else 0 end as ig, {overlap} as v
    from top p join gt g using (image_id, label) cross join rg cross join th where {overlap} >= t),
  cl as ({S.leaders('cp', 'image_id, label, area_range, t', 'score desc, det, ig, v desc, gt desc', 'd := det, g := gt, c := crowd, ig := ig',
                    'd integer, g integer, c boolean, ig integer', 'k.d = d.d or (k.g = d.g and not k.c)')}),
  tk as (select image_id, label, area_range, t, u.d as det, u.ig as ig from (select image_id, label, area_range, t, unnest(lead) as u from cl)),
  m as (select p.image_id, p.label, p.det, p.score, rg.area_range, th.t, coalesce(ig = 0, false) as tp,
     ig is null and not ((x2 - x1) * (y2 - y1) < lo or (x2 - x1) * (y2 - y1) > hi) as fp
    from top p cross join rg cross join th left join tk on tk.image_id = p.image_id and tk.label = p.label and tk.det = p.det and tk.area_range = rg.area_range and tk.t = th.t)"""


_CAP = """np as (select label, area_range, count(*) as npos from gt, rg where not crowd and area between lo and hi group by 1, 2),
  cum as (select label, area_range, t, tp, sum(tp::int) over w as ctp, sum(fp::int) over w as cfp from {m}
    window w as (partition by label, area_range, t order by score desc, image_id, det rows unbounded preceding)),
  pts as (select cum.label, area_range, t, ctp * 1.0::double / (ctp + cfp) as prec, ctp * 1.0::double / npos as rec from cum join np using (label, area_range) where tp),
  rp(r) as (select i * 0.01::double from (select unnest(range(0, 101)) as i)),
  bst as (select label, area_range, t, r, max(prec) as p from pts join rp on rec >= r group by 1, 2, 3, 4),
  ap as (select label, area_range, t, sum(p) / 101 as ap from bst group by 1, 2, 3),
  cap as (select np.label, np.area_range, cast(th.t as double) as threshold, coalesce(ap, 0) as ap from np cross join th
    left join ap on ap.label = np.label and ap.area_range = np.area_range and ap.t = th.t)"""
_THREE = {"all": (0, 1e10), "small": (0, 1700.0), "large": (1700.0, 1e10)}
_COCO = _coco_sql(_THREE, [0.5, 0.75])
_COCOAP = f"{_COCO}, {_CAP.format(m='m')}"
_METRICS = """select 'AP' as metric, round(avg(ap) * 100, 5) as value from cap where area_range = 'all' union all
  select 'AP50', round(avg(ap) * 100, 5) from cap where area_range = 'all' and threshold = 0.5 union all
  select 'AP75', round(avg(ap) * 100, 5) from cap where area_range = 'all' and threshold = 0.75 union all
  select 'AP-' || area_range, round(avg(ap) * 100, 5) from cap where area_range <> 'all' group by 1"""


@query("coco_matches", f"""with {_COCO} select image_id, label, det, area_range, bool_or(tp and t = 0.5) as tp50, bool_or(fp and t = 0.5) as fp50,
  bool_or(tp and t = 0.75) as tp75, bool_or(fp and t = 0.75) as fp75 from m group by 1, 2, 3, 4""", D)
def coco_matches(t):
    m = evaluate.coco_matches(found(t), crowd_truth(t), [0.5, 0.75], _ranges(t), 5)
    return m.select("image_id", "label", "det", "area_range", F.col("tp")[0].alias("tp50"), F.col("fp")[0].alias("fp50"),
                    F.col("tp")[1].alias("tp75"), F.col("fp")[1].alias("fp75"))


@query("coco_class_ap", f"with {_COCOAP} select label, area_range, threshold, round(ap, 6) as ap from cap", D)
def coco_class_ap(t):
    return evaluate.coco_class_ap(found(t), crowd_truth(t), [0.5, 0.75], _ranges(t), 5).select("label", "area_range", "threshold", F.round("ap", 6).alias("ap"))


@query("coco_ap", f"with {_coco_sql(_THREE, evaluate.THRESHOLDS, None)}, {_CAP.format(m='m')} {_METRICS}", D)
def coco_ap(t):
    """All ten thresholds over every detection."""
    ap = evaluate.coco_class_ap(found(t), crowd_truth(t), areas=_ranges(t), max_dets=None)
    return evaluate.coco_ap(ap).select("metric", F.round("value", 5).alias("value"))


@query("coco_ap_fine_areas", f"with {_coco_sql({**evaluate.AREAS, **evaluate.MORE_AREAS}, evaluate.THRESHOLDS, 100)}, {_CAP.format(m='m')} {_METRICS.replace("from cap where area_range <> 'all'", "from rg left join cap using (area_range) where area_range <> 'all'")}", D)
def coco_ap_fine_areas(t):
    """The nineteen metrics of the protocol with extra size ranges."""
    areas = {**evaluate.AREAS, **evaluate.MORE_AREAS}
    ap = evaluate.coco_class_ap(found(t), crowd_truth(t), areas=areas)
    return evaluate.coco_ap(ap, areas).select("metric", F.round("value", 5).alias("value"))


_LVIS = _coco_sql({"all": (0, 1e10)}, evaluate.THRESHOLDS, crowds=False, top="select p.* from pr p join checked using (image_id, label)", extra=""",
  checked as (select image_id, label from gt union select image_id, label from detections where priority = 2 and seq = 1),
  loose as (select distinct image_id, label from detections where priority = 1 and seq % 5 = 0)""")


@query("lvis_ap", f"""with {_LVIS}, ml as (select m.* replace (fp and lo.label is null as fp) from m left join loose lo on lo.image_id = m.image_id and lo.label = m.label),
  {_CAP.format(m='ml')}, f as (select *, case when label = 'person' then 'f' when label < 'class_3' then 'c' else 'r' end as freq from cap)
  select round(avg(ap) * 100, 5) as ap, round(avg(ap) filter (freq = 'r') * 100, 5) as ap_rare, round(avg(ap) filter (freq = 'c') * 100, 5) as ap_common,
    round(avg(ap) filter (freq = 'f') * 100, 5) as ap_frequent from f""", D)
def lvis_ap(t):
    d = t.detections
    gt = crowd_truth(t).drop("iscrowd")
    freq = d.groupBy("label").agg(F.count("*").alias("n")).select("label", F.when(F.col("label") == "person", "f").when(
        F.col("label") < "class_3", "c").otherwise("r").alias("frequency"))
    negative = d.where("priority = 2 and seq = 1").select("image_id", "label")
    loose = d.where("priority = 1 and seq % 5 = 0").select("image_id", "label")
    r = evaluate.lvis_ap(found(t), gt, freq, negative, loose, max_dets=None)
    return r.select(*[F.round(c, 5).alias(c) for c in r.columns])


# ---- segmentation ----------------------------------------------------------------------------------------

def pixel_labels(t):
    """Events as pixels: true and predicted class from their numbers (255 is to be ignored)."""
    e = t.events
    return e.select("event_id", F.when(F.col("event_id") % 50 == 0, 255).otherwise((F.col("user_id") % 5).cast("int")).alias("gt"),
                    F.when(F.col("value") > 20, F.col("user_id") % 5).otherwise(F.col("event_id") % 5).cast("int").alias("pred"))


_PX = """px as (select cast(case when event_id % 50 = 0 then 5 else user_id % 5 end as int) as gt,
  cast(case when value > 20 then user_id % 5 else event_id % 5 end as int) as pred from events), cm as (select pred, gt, count(*) as n from px group by 1, 2)"""
_CLS = """k as (select * from cm where gt < 5), tp as (select gt as c, n from k where gt = pred), g as (select gt as c, sum(n) as n from k group by 1),
  p as (select pred as c, sum(n) as n from k group by 1),
  sc as (select c, coalesce(tp.n, 0) as tp, coalesce(g.n, 0) as gt_n, coalesce(p.n, 0) as pred_n from g full join p using (c) left join tp using (c)),
  cs as (select *, case when gt_n > 0 then tp * 100.0::double / (gt_n + pred_n - tp) end as iou, case when gt_n > 0 then tp * 100.0::double / gt_n end as acc from sc)"""


@query("confusion_matrix", f"with {_PX} select pred, gt, n from cm")
def confusion_matrix(t):
    return reports.confusion_matrix(pixel_labels(t), 5)


@query("class_scores", f"with {_PX}, {_CLS} select c as class, cast(tp as bigint) as tp, cast(gt_n as bigint) as gt_n, cast(pred_n as bigint) as pred_n, round(iou, 6) as iou, round(acc, 6) as acc from cs")
def class_scores(t):
    s = reports.class_scores(reports.confusion_matrix(pixel_labels(t), 5), 5)
    return s.select("class", "tp", "gt_n", "pred_n", F.round("iou", 6).alias("iou"), F.round("acc", 6).alias("acc"))


@query("segmentation_metrics", f"""with {_PX}, {_CLS} select round(avg(iou), 6) as miou, round(sum(iou * gt_n) / sum(gt_n), 6) as fwiou, round(avg(acc), 6) as macc,
  round(sum(tp) * 100.0::double / sum(gt_n), 6) as pacc from cs""")
def segmentation_metrics(t):
    m = reports.segmentation_metrics(reports.class_scores(reports.confusion_matrix(pixel_labels(t), 5), 5))
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


def raster(t):
    """One 64 by 64 image per user group: every pixel gets a true and a predicted class from the events."""
    e = t.events.where("event_id < 4096 or event_id >= 4096")
    base = e.select((F.col("event_id") % 64).cast("int").alias("x"), (F.expr("event_id div 64") % 64).cast("int").alias("y"),
                    F.expr("event_id div 4096").alias("image_id"), (F.expr("(event_id % 64) div 16")).cast("int").alias("gt"),
                    F.when(F.col("value") > 5, F.expr("(event_id % 64) div 16")).otherwise(3).cast("int").alias("pred"))
    return base


_RS = """rs as (select cast(event_id % 64 as int) as x, cast((event_id // 64) % 64 as int) as y, event_id // 4096 as image_id, cast((event_id % 64) // 16 as int) as gt,
  cast(case when value > 5 then (event_id % 64) // 16 else 3 end as int) as pred from events)"""


@query("boundary_iou", f"""with {_RS}, bd as (select a.image_id, a.x, a.y, max(a.gt) - case when a.x < 1 or a.y < 1 or a.x >= 63 or a.y >= 63 then 0 else min(b.gt) end as gt,
    max(a.pred) - case when a.x < 1 or a.y < 1 or a.x >= 63 or a.y >= 63 then 0 else min(b.pred) end as pred
    from rs a join rs b on a.image_id = b.image_id and b.x between a.x - 1 and a.x + 1 and b.y between a.y - 1 and a.y + 1 group by 1, 2, 3),
  cm as (select pred, gt, count(*) as n from bd group by 1, 2), {_CLS.replace('gt < 5', 'gt < 4')}
  select c as class, round(iou, 6) as boundary_iou from cs""")
def boundary_iou(t):
    r = evaluate.boundary_iou(raster(t), 4, 1, 64, 64)
    return r.select("class", F.round("boundary_iou", 6).alias("boundary_iou"))


def segments(t):
    """Segment ids per pixel: class times 1000 plus instance; some true pixels unlabelled."""
    e = t.events
    gt = F.when(F.col("event_id") % 40 == 0, -1).otherwise((F.col("user_id") % 3) * 1000 + F.expr("event_id div 500") % 4)
    pred = F.when(F.col("value") > 8, (F.col("user_id") % 3) * 1000 + F.expr("event_id div 500") % 4).otherwise((F.col("event_id") % 3) * 1000)
    return e.select(F.expr("event_id div 2000").alias("image_id"), gt.cast("int").alias("gt_seg"), pred.cast("int").alias("pred_seg"))


@query("panoptic_quality", """with sg as (select event_id // 2000 as image_id, cast(case when event_id % 40 = 0 then -1 else (user_id % 3) * 1000 + (event_id // 500) % 4 end as int) as gt_seg,
   cast(case when value > 8 then (user_id % 3) * 1000 + (event_id // 500) % 4 else (event_id % 3) * 1000 end as int) as pred_seg from events),
  it as (select image_id, gt_seg, pred_seg, count(*) as n from sg group by 1, 2, 3),
  pa as (select image_id, pred_seg, sum(n) as pa, sum(case when gt_seg < 0 then n else 0 end) as void from it group by 1, 2),
  ga as (select image_id, gt_seg, sum(n) as ga from it where gt_seg >= 0 group by 1, 2),
  ht as (select *, n::double / (pa + ga - n - void) as iou from it join pa using (image_id, pred_seg) join ga using (image_id, gt_seg)
    where gt_seg // 1000 = pred_seg // 1000 and n::double / (pa + ga - n - void) > 0.5),
  tp as (select gt_seg // 1000 as class, count(*) as tp, sum(iou) as iou from ht group by 1),
  fp as (select pred_seg // 1000 as class, count(*) as fp from pa where void * 2 <= pa and (image_id, pred_seg) not in (select image_id, pred_seg from ht) group by 1),
  fn as (select gt_seg // 1000 as class, count(*) as fn from ga where (image_id, gt_seg) not in (select image_id, gt_seg from ht) group by 1),
  al as (select class, coalesce(tp, 0) as tp, coalesce(fp, 0) as fp, coalesce(fn, 0) as fn, coalesce(iou, 0) as iou from tp full join fp using (class) full join fn using (class)),
  pc as (select class, 100 * iou / (tp + fp / 2 + fn / 2) as pq, case when tp = 0 then 0 else 100 * iou / tp end as sq, 100 * tp / (tp + fp / 2 + fn / 2) as rq from al)
  select 'class-' || class as part, round(pq, 6) as pq, round(sq, 6) as sq, round(rq, 6) as rq from pc union all
  select 'all', round(avg(pq), 6), round(avg(sq), 6), round(avg(rq), 6) from pc union all
  select case when class in (0, 1) then 'things' else 'stuff' end, round(avg(pq), 6), round(avg(sq), 6), round(avg(rq), 6) from pc group by 1""")
def panoptic_quality(t):
    q = evaluate.panoptic_quality(segments(t), things=[0, 1])
    return q.select("part", *[F.round(c, 6).alias(c) for c in ("pq", "sq", "rq")])


@query("verify_metrics", """select dataset as task, 'count' as metric, cast(n as double) as value, case when dataset = 'Brand#1' then false else n between 51 and 109 end as ok from
  (select dataset, case when dataset = 'Brand#1' then null else count(*) end as n from images group by 1)""", ("images",))
def verify_metrics(t):
    n = t.images.groupBy(F.col("dataset").alias("task")).agg(F.count("*").cast("double").alias("value")).withColumn("metric", F.lit("count"))
    want = n.select("task", "metric", F.lit(80.0).alias("expected"), F.lit(30.0).alias("tolerance"))
    return evaluate.verify_metrics(want, n.where("task <> 'Brand#1'")).select("task", "metric", "value", "ok")


@query("flatten_metrics", "select dataset as task, class_name || '/' || 'n' as name, cast(count(*) as double) as value from images group by dataset, class_name", ("images",))
def flatten_metrics(t):
    per = t.images.groupBy("dataset", "class_name").agg(F.count("*").cast("double").alias("n"))
    nested = per.groupBy(F.col("dataset").alias("task")).agg(F.map_from_entries(F.collect_list(F.struct("class_name", F.create_map(F.lit("n"), "n")))).alias("m"))
    return evaluate.flatten_metrics(nested, "m", ["task"])


# ---- sampling ------------------------------------------------------------------------------------------------

def annotations(t):
    """Every detection of the first model as an annotation of its label."""
    return t.detections.where("priority = 1").select("image_id", F.col("label").alias("category_id"), "seq")


_FREQ = """an as (select image_id, label as category_id from detections where priority = 1), n as (select count(*) as n from images),
  fq as (select category_id, count(distinct image_id) as images, count(distinct image_id)::double / max(n) as f from an, n group by 1),
  rf as (select i.image_id, coalesce(max(greatest(1.0::double, sqrt(0.7::double / f))), 1.0::double) as r from images i left join an using (image_id) left join fq using (category_id) group by 1)"""


@query("category_frequency", f"with {_FREQ} select category_id, images, round(f, 8) as frequency from fq", DI)
def category_frequency(t):
    return sampling.category_frequency(annotations(t), t.images).select("category_id", "images", F.round("frequency", 8).alias("frequency"))


@query("repeat_factors", f"with {_FREQ} select image_id, round(r, 6) as repeat_factor from rf", DI)
def repeat_factors(t):
    return sampling.repeat_factors(annotations(t), t.images, 0.7).select("image_id", F.round("repeat_factor", 6).alias("repeat_factor"))


@query("repeat_sample", f"with {_FREQ} select image_id, cast(floor(r) as int) as least from rf", DI)
def repeat_sample(t):
    """Copies per image: the whole part of the factor, or one more."""
    f = sampling.repeat_factors(annotations(t), t.images, 0.7)
    n = sampling.repeat_sample(f).groupBy("image_id").agg(F.count("*").alias("n"), F.max("repeat_factor").alias("r"))
    return n.where((F.col("n") == F.floor("r")) | (F.col("n") == F.floor("r") + 1)).select("image_id", F.floor("r").cast("int").alias("least"))


@query("random_subset")
def random_subset(t):
    return sampling.random_subset(t.images, "image_id", 100, seed=7).select("image_id", "file_name")


@query("random_subset_counts", "select least(100, count(*)) as rows, least(100, count(*)) as known, count(*) as kept from images", ("images",))
def random_subset_counts(t):
    """A subset has the wanted size, holds known images only, and all rows are a subset of themselves."""
    some = sampling.random_subset(t.images, "image_id", 100, seed=7)
    sizes = some.join(t.images.select("image_id"), "image_id", "left_semi").agg(F.count("*").alias("rows"), F.count_distinct("image_id").alias("known"))
    whole = sampling.random_subset(t.images, "image_id", t.images.count(), seed=1).agg(F.count_distinct("image_id").alias("kept"))
    return sizes.withColumn("_k", F.lit(1)).join(whole.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("shards", "select image_id, cast(ntile(7) over (order by image_id) - 1 as int) as shard from images", ("images",))
def shards(t):
    return sampling.shards(t.images, [F.col("image_id")], 7).select("image_id", "shard")


@query("aspect_batches", """with n as (select image_id, case when width > height then 1 else 0 end as wide, row_number() over (partition by width > height order by image_id) - 1 as i,
   count(*) over (partition by width > height) as c from images) select image_id, wide, cast(i // 16 as int) as batch from n where i < (c // 16) * 16""", ("images",))
def aspect_batches(t):
    return sampling.aspect_batches(t.images, 16).select("image_id", "wide", "batch")


# ---- label assignment --------------------------------------------------------------------------------------------

def words(t):
    """Mean vector of each label, by position."""
    e = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    m = e.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return m.groupBy(F.concat(F.lit("w"), F.col("label").cast("string")).alias("label")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("vector"))


_WV = """e as (select vec_id, label, unnest(embedding)::double as v, unnest(range(0, len(embedding))) as i from embeddings),
  w as (select 'w' || label as label, list(v order by i) as vector from (select label, i, avg(v) as v from e group by 1, 2) group by label),
  c as (select vec_id, cast(embedding as double[]) as vector from embeddings)"""


@query("assign_label", f"""with {_WV}, cand as (select vec_id, p, 'w' || ((vec_id + p * 3) % 10) as label from c, (select unnest([0, 1, 2]) as p)),
  s as (select cand.*, list_cosine_similarity(c.vector, w.vector) as cos from cand join c using (vec_id) join w using (label)),
  r as (select *, row_number() over (partition by vec_id order by cos desc, p) as rn, exp(100 * (max(cos) over (partition by vec_id) - 1)) / sum(exp(100 * (cos - 1))) over (partition by vec_id) as pr from s)
  select vec_id as image_id, label, round(pr, 5) as probability from r where rn = 1""")
def assign_label(t):
    e = t.embeddings
    pick = lambda p: F.concat(F.lit("w"), ((F.col("vec_id") + p * 3) % 10).cast("string"))
    objs = e.select(F.col("vec_id").alias("image_id"), F.lit(0).alias("id"), F.array(pick(0), pick(1), pick(2)).alias("labels"))
    crops = e.select(F.col("vec_id").alias("image_id"), F.lit(0).alias("id"), F.col("embedding").alias("vector"))
    return assign.assign_label(objs, crops, words(t)).select("image_id", "label", F.round("probability", 5).alias("probability"))


@query("zero_shot_topk", f"""with {_WV}, s as (select vec_id, w.label, list_cosine_similarity(c.vector, w.vector) as cos from c, w),
  r as (select *, row_number() over (partition by vec_id order by cos desc, label) as rn, exp(100 * (cos - 1)) / sum(exp(100 * (cos - 1))) over (partition by vec_id) as pr from s)
  select vec_id as crop_id, cast(rn as int) as rank, label, round(pr, 5) as probability from r where rn <= 3""")
def zero_shot_topk(t):
    crops = t.embeddings.select(F.col("vec_id").alias("crop_id"), F.col("embedding").alias("vector"))
    return assign.zero_shot_topk(crops, words(t), 3).select("crop_id", "rank", "label", F.round("probability", 5).alias("probability"))


@query("phrase_cosine", f"""with {_WV} select c.vec_id, round(list_cosine_similarity(c.vector, w.vector), 6) as cosine from c join embeddings e using (vec_id) join w on w.label = 'w' || e.label""")
def phrase_cosine(t):
    e = t.embeddings.withColumn("label", F.concat(F.lit("w"), F.col("label").cast("string")))
    return e.join(words(t), "label").select("vec_id", F.round(assign.cosine(F.col("embedding"), F.col("vector")), 6).alias("cosine"))


@query("top_class", """with s as (select vec_id, list_max(embedding) as m, list_position(embedding, list_max(embedding)) as p from embeddings)
  select vec_id, 'c' || (p - 1) as label, cast(round(cast(m::double as decimal(18, 8)), 2) as double) as score from s where m > 0.1""")
def top_class(t):
    e = t.embeddings.select("vec_id", F.transform("embedding", lambda v: v).alias("scores"))
    return assign.label_proposals(e, [f"c{i}" for i in range(64)]).select("vec_id", "label", F.col("score").cast("double").alias("score"))
