"""Box geometry, filters, suppression, voting, overlap joins and masks."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import boxes as B
from boxloom.operators import dedup, filters, masks, merge, overlap, vote
from boxloom.plans.queries import sqltext as S
from boxloom.plans.registry import query
from boxloom.streaming import release

D, DI = ("detections",), ("detections", "images")
KEY = ["image_id", "model", "seq"]
text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")


# ---- suppression -------------------------------------------------------------------------

def _nms_sql(keys, order, fields, types, related, where="true", ties="s"):
    return f"""with l as ({S.leaders(f'(select * from detections where {where})', keys, order, fields, types, related)})
select {keys}, cast(u.p as int) as priority, cast(u.s as int) as seq, u.score as score from (select {keys}, unnest(lead) as u from l)"""


_F = f"p := priority, s := seq, score := score, label := label, {S.BOX}"
_T = f"p integer, s integer, score double, label varchar, {S.BOXTYPE}"


@query("nms", _nms_sql("image_id, model", "score desc, seq", _F, _T,
                       f"{S.inter('k', 'd')} / greatest({S.union('k', 'd')}, 1e-5) > 0.9", "score >= 0.1"), D)
def nms(t):
    return dedup.nms(t.detections).select("image_id", "model", "priority", "seq", "score")


@query("class_nms", _nms_sql("image_id, label", "score desc, priority, seq", _F.replace("label := label, ", ""),
                             _T.replace("label varchar, ", ""),
                             f"{S.inter('k', 'd')} / greatest({S.union('k', 'd')}, 1e-5) > 0.5"), D)
def class_nms(t):
    return dedup.class_nms(t.detections).select("image_id", "label", "priority", "seq", "score")


@query("lower_edge_nms", _nms_sql("image_id, model", "y2 desc, seq desc", _F, _T,
                                  f"k.label = d.label and {S.inter('k', 'd', 1)} / {S.area('d', 1)} > 0.9"), D)
def lower_edge_nms(t):
    return dedup.lower_edge_nms(t.detections).select("image_id", "model", "priority", "seq", "score")


@query("first_come_nms", _nms_sql("image_id, model", "seq", _F, _T,
                                  f"k.label = d.label and {S.iou('k', 'd')} > 0.9"), D)
def first_come_nms(t):
    return dedup.first_come_nms(t.detections).select("image_id", "model", "priority", "seq", "score")


# ---- voting ------------------------------------------------------------------------------

_AGREE = f"k.p < d.p and {S.iou('k', 'd', 1)} >= 0.65"
OWNERS = f"""vl as ({S.leaders('detections', 'image_id', 'priority, seq', _F + ', model := model', _T + ', model varchar', _AGREE)}),
owners as (select image_id, d.p as priority, d.s as seq, d.model as model, d.label as label, d.score as score,
   d.x1 as x1, d.y1 as y1, d.x2 as x2, d.y2 as y2,
   coalesce(list_filter(lead, lambda k: {_AGREE})[1].p, d.p) as seed_priority,
   coalesce(list_filter(lead, lambda k: {_AGREE})[1].s, d.s) as seed_seq
  from (select image_id, lead, unnest(m) as d from vl))"""
VOTED = OWNERS + """,
seeds as (select image_id, seed_priority, seed_seq, count(*) as votes,
   max(case when seed_priority = priority and seed_seq = seq then label end) as label,
   max(case when seed_priority = priority and seed_seq = seq then model end) as model,
   max(case when seed_priority = priority and seed_seq = seq then score end) as score,
   max(case when seed_priority = priority and seed_seq = seq then x1 end) as x1,
   max(case when seed_priority = priority and seed_seq = seq then y1 end) as y1,
   max(case when seed_priority = priority and seed_seq = seq then x2 end) as x2,
   max(case when seed_priority = priority and seed_seq = seq then y2 end) as y2,
   list_sort(list(distinct label) filter (model <> 'grit')) as labels,
   list_sort(list(distinct label) filter (model = 'grit')) as attributes
  from owners group by 1, 2, 3),
voted as (select *, case when votes > 1 then 'object' when model = 'grit' then 'attribute'
   when label = 'person' and model in ('eva-02-01', 'co_detr', 'eva-02-02') then
     case when score > (case model when 'co_detr' then 0.5 else 0.75 end) then 'object'
          when score > (case model when 'co_detr' then 0.2 else 0.6 end) then 'floating' end
   when label <> 'person' then 'floating' end as kind from seeds),
numbered as (select *, cast(row_number() over (partition by image_id order by case kind when 'object' then 0 else 1 end,
   seed_priority, seed_seq) - 1 as int) as id from voted where kind in ('object', 'floating'))"""


@query("vote_owners", f"with {OWNERS} select image_id, priority, seq, cast(seed_priority as int) as seed_priority, "
       "cast(seed_seq as int) as seed_seq from owners", D)
def vote_owners(t):
    return vote.owners(t.detections).select("image_id", "priority", "seq", "seed_priority", "seed_seq")


@query("vote", f"""with {VOTED} select image_id, kind, cast(seed_priority as int) as seed_priority,
  cast(seed_seq as int) as seed_seq, score, votes, coalesce(array_to_string(labels, ','), '') as labels,
  coalesce(array_to_string(attributes, ','), '') as attributes from voted where kind is not null""", D)
def vote_query(t):
    return vote.vote(t.detections).select(
        "image_id", "kind", "seed_priority", "seed_seq", "score", "votes", F.array_join("labels", ",").alias("labels"),
        F.coalesce(F.array_join("attributes", ","), F.lit("")).alias("attributes"))


def crowded(t) -> bool | None:
    """False when no image holds many boxes, so that steps with no more rows than ``t.detections`` need no count;
    else None, which leaves every step to its own."""
    return None if t.crowded else False


def level1(t):
    """Objects and floating objects with ids, from all detections."""
    hot = crowded(t)
    return vote.assign_ids(vote.vote(t.detections, hot=hot), hot=hot)


@query("assign_ids", f"""with {VOTED} select image_id, kind, id, cast(seed_priority as int) as seed_priority,
  cast(seed_seq as int) as seed_seq from numbered""", D)
def assign_ids(t):
    return level1(t).where("id is not null").select("image_id", "kind", "id", "seed_priority", "seed_seq")


# The same chain as the entry query: suppression, thresholds, voting
THRESH = """case when label = 'person' and model in ('eva-02-01', 'co_detr', 'eva-02-02') then 0.2
  else case model when 'eva-02-01' then 0.6 when 'co_detr' then 0.2 when 'eva-02-02' then 0.6 when 'ov_sam' then 0.3
  when 'owl_vit' then 0.1 when 'pomp' then 0.3 when 'grit' then 0.3 else 0 end end"""


@query("model_threshold", f"select image_id, model, seq, score from detections where score > {THRESH}", D)
def model_threshold(t):
    return vote.model_threshold(t.detections).select(*KEY, "score")


@query("registered_model_threshold", f"""select image_id, model, seq, score from detections
  where score > case when model = 'pomp' then 0.45 else {THRESH} end""", D)
def registered_model_threshold(t):
    from boxloom.operators.models import model_table, register_model

    models = register_model(model_table(t.spark), "pomp", 6, threshold=0.45)
    return vote.model_threshold(t.detections, models).select(*KEY, "score")


_AGREED = f"""with n as ({S.leaders('(select * from detections where score >= 0.1)', 'image_id, model',
    'score desc, seq', _F.replace('p := priority, ', 'p := priority, '), _T, f"{S.inter('k', 'd')} / greatest({S.union('k', 'd')}, 1e-5) > 0.9")}),
  kept as (select image_id, model, u.p as priority, u.s as seq, u.score as score, u.label as label, u.x1 as x1, u.y1 as y1,
    u.x2 as x2, u.y2 as y2 from (select image_id, model, unnest(lead) as u from n)),
  passed as (select * from kept where score > {THRESH}),
  {VOTED.replace('from detections group', 'from passed group')}
  select image_id, id, score, votes, coalesce(array_to_string(labels, ','), '') as labels from numbered where kind = 'object'"""


def agreed(detections, hot):
    kept = vote.model_threshold(dedup.nms(detections, hot=hot))
    ids = vote.assign_ids(vote.vote(kept, hot=hot), hot=hot)
    return ids.where("kind = 'object'").select("image_id", "id", "score", "votes", F.array_join("labels", ",").alias("labels"))


@query("agreed_objects", _AGREED, D)
def agreed_objects(t):
    """Objects that survive suppression, thresholds and voting."""
    hot = crowded(t)
    return agreed(t.detections, hot)       # laid out by image where ``hot`` is False


def agreed_of_batch(rows):
    """``agreed`` of stored rows, counted once and laid out by image once."""
    many = scale.has_oversized(rows, ["image_id"], overlap.PAIR_LIMIT)
    return agreed(scale.by_image(rows, many), None if many else False)


@query("incremental_annotation", _AGREED, D)
def incremental_annotation(t):
    """The same, image by image as the models' notices come in three parts, each worked off by a query that starts where the one before
    it ended."""
    folder = f"{scale.shared_folder(t.spark)}/incremental-{uuid.uuid4().hex}"
    models = {r.model: r.priority for r in t.detections.select("model", "priority").distinct().collect()}       # seven names
    images = t.detections.select("image_id").distinct()
    kinds = agreed(t.detections.limit(0), False).schema
    for part in range(3):
        t.detections.where(F.col("priority") % 3 == part).write.mode("append").parquet(f"{folder}/rows")
        through = F.explode(F.array(*[F.lit(m) for m, p in sorted(models.items()) if p % 3 == part]))
        notes = images.select("image_id", through.alias("model")).withColumn("ts", F.lit(f"2024-01-01 0{part}:00:00").cast("timestamp"))
        notes.write.mode("append").parquet(f"{folder}/notices")
        query = release.annotate_released(t.spark.readStream.schema(notes.schema).parquet(f"{folder}/notices"), list(models),
                                          lambda ids: t.spark.read.parquet(f"{folder}/rows").join(ids, "image_id"),
                                          agreed_of_batch, f"{folder}/out", f"{folder}/checkpoint", wait=86400.0)
        query.awaitTermination()
    return t.spark.read.schema(kinds).parquet(f"{folder}/out").select(*kinds.names)


@query("tag_attributes", """select doc_id as image_id, 'attribute' as kind, coalesce(lang, '') as label, cast(n_chars % 10 as double) / 10 as score
  from documents where cast(n_chars % 10 as double) / 10 > 0.3""")
def tag_attributes(t):
    tags = t.documents.select(F.col("doc_id").alias("image_id"), F.lit("ram").alias("model"), F.lit(0).alias("pos"),
                              F.col("lang").alias("tag"), ((F.col("n_chars") % 10).cast("double") / 10).alias("score"))
    none = vote.vote(t.detections).limit(0)
    return vote.add_tags(none, tags).select("image_id", "kind", F.coalesce(F.col("labels")[0], F.lit("")).alias("label"), "score")


_JOINS = f"d.p > 1 and {S.iou('k', 'd', 1)} > 0.65"
_GCLEAN = f"""gc as ({S.leaders('(select * from detections where priority >= 6)', 'image_id, priority', 'y2 desc, seq desc',
    f's := seq, label := label, {S.BOX}', f's integer, label varchar, {S.BOXTYPE}',
    f"k.label = d.label and {S.inter('k', 'd', 1)} / {S.area('d', 1)} > 0.9")}),
  clean as (select image_id, priority - 5 as priority, u.s as seq, u.label as label, u.x1 as x1, u.y1 as y1, u.x2 as x2, u.y2 as y2
    from (select image_id, priority, unnest(lead) as u from gc)),
  gl as ({S.leaders('clean', 'image_id', 'priority, seq', f'p := priority, s := seq, label := label, {S.BOX}',
                    f'p integer, s integer, label varchar, {S.BOXTYPE}', _JOINS)}),
  gr as (select image_id, d.label as label, coalesce(list_filter(lead, lambda k: (k.p < d.p or (k.p = d.p and k.s < d.s)) and {_JOINS})[1].p, d.p) as priority,
    coalesce(list_filter(lead, lambda k: (k.p < d.p or (k.p = d.p and k.s < d.s)) and {_JOINS})[1].s, d.s) as seq
    from (select image_id, lead, unnest(m) as d from gl))"""


@query("merge_grounders", f"""with {_GCLEAN} select image_id, cast(priority as int) as priority, cast(seq as int) as seq, label,
  cast(count(*) as bigint) as votes from gr group by 1, 2, 3, 4""", D)
def merge_grounders(t):
    two = t.detections.where("priority >= 6").withColumn("priority", F.col("priority") - 5)
    return vote.merge_grounders(two).select("image_id", "priority", "seq", F.explode("labels").alias("l")).select(
        "image_id", "priority", "seq", F.col("l.label").alias("label"), F.col("l.votes").alias("votes"))


# ---- filters -----------------------------------------------------------------------------

@query("score_floor", "select image_id, model, seq, score from detections where score >= 0.1", D)
def score_floor(t):
    return filters.score_floor(t.detections).select(*KEY, "score")


@query("confidence_filter", "select image_id, model, seq, score from detections where score >= 0.5", D)
def confidence_filter(t):
    return filters.confident(t.detections, 0.5).select(*KEY, "score")


@query("drop_masks", "select image_id, model, seq, score, label from detections", D)
def drop_masks(t):
    masked = t.detections.withColumn("sam_mask", F.struct(F.array(F.lit(0).cast("long")).alias("counts")))
    return filters.drop_masks(masked).select(*KEY, "score", "label")


@query("valid_bbox", "select image_id, model, seq from detections where seq % 3 <> 0 and seq % 5 <> 0", D)
def valid_bbox(t):
    x4 = F.array("x1", "y1", "x2", "y2")
    bbox = F.when(F.col("seq") % 3 == 0, F.array("x1", "y1")).when(F.col("seq") % 5 == 0, F.lit(None)).otherwise(x4)
    return filters.valid_bbox(t.detections.withColumn("bbox", bbox)).select(*KEY)


@query("min_area_ratio", """select image_id, model, seq from detections join images using (image_id)
  where (x2 - x1) * (y2 - y1) / (width * height) >= 0.4""", DI)
def min_area_ratio(t):
    return filters.min_area_ratio(t.detections, t.images, 0.4).select(*KEY)


@query("proposal_area", """select image_id, seq from (select d.*, i.width, i.height from detections d left join
    (select * from images where image_id % 5 <> 0) i using (image_id) where priority = 4)
  where width is null or (x2 - x1) * (y2 - y1) / (width * height) * 100 > 40""", DI)
def proposal_area(t):
    proposals = _proposals(t).select("image_id", "seq", "w", "h", F.lit(None).cast("int").alias("mask_w"),
                                     F.lit(None).cast("int").alias("mask_h"))
    return filters.proposal_area(proposals, t.images.where("image_id % 5 <> 0"), 40.0).select("image_id", "seq")


@query("clip_boxes", """select image_id, model, seq, least(greatest(x1, 0), width) as x1, least(greatest(y1, 0), height) as y1,
    least(greatest(x2, 0), width) as x2, least(greatest(y2, 0), height) as y2 from detections join images using (image_id)
  where least(x2, width) > least(x1, width) and least(y2, height) > least(y1, height)""", DI)
def clip_boxes(t):
    return filters.clip_boxes(t.detections, t.images).select(*KEY, "x1", "y1", "x2", "y2")


@query("inside_image", """select image_id, model, seq from detections join images using (image_id)
  where x1 >= -2 and y1 >= -2 and x2 < width + 2 and y2 < height + 2""", DI)
def inside_image(t):
    return filters.inside_image(t.detections, t.images, 2.0).select(*KEY)


@query("filter_only_crowd", """select image_id, file_name from images where image_id in
  (select image_id from detections where seq % 2 = 1 and score > 0.6)""", DI)
def filter_only_crowd(t):
    anns = t.detections.select("image_id", F.when((F.col("seq") % 2 == 1) & (F.col("score") > 0.6), 0).otherwise(1).alias("iscrowd"))
    return filters.with_real_annotations(t.images, anns).select("image_id", "file_name")


@query("filter_few_keypoints", """select image_id, file_name from images where image_id in (select image_id from detections
  group by image_id having sum(case when score > 0.5 then 1 else 0 end + case when seq % 2 = 0 then 1 else 0 end) >= 25)""", DI)
def filter_few_keypoints(t):
    seen = lambda c: F.when(c, 2.0).otherwise(0.0)
    points = F.array("x1", "y1", seen(F.col("score") > 0.5), "x2", "y2", seen(F.col("seq") % 2 == 0))
    anns = t.detections.withColumn("keypoints", points)
    return filters.with_keypoints(t.images, anns, 25).select("image_id", "file_name")


# ---- geometry ------------------------------------------------------------------------------

def _pairs(t):
    a = t.detections.where("seq = 1 and priority = 1").select("image_id", *[F.col(c).alias(f"a_{c}") for c in ("x1", "y1", "x2", "y2")])
    b = t.detections.where("seq = 1 and priority > 1").select("image_id", "model", "x1", "y1", "x2", "y2")
    return b.join(a, "image_id")


_PAIR = ("(select * from detections where seq = 1 and priority > 1) b join "
         "(select * from detections where seq = 1 and priority = 1) a using (image_id)")


@query("iou_conventions", f"""select image_id, b.model as model, round({S.iou('a', 'b', 1)}, 6) as inclusive,
  round({S.inter('a', 'b')} / greatest({S.union('a', 'b')}, 1e-5), 6) as floored, round({S.iou('a', 'b')}, 6) as plain,
  round({S.inter('a', 'b')} / ({S.union('a', 'b')} + 1e-6), 6) as plus,
  round(2 * {S.inter('a', 'b', 1)} / ({S.area('a', 1)} + {S.area('b', 1)}), 6) as dice,
  round({S.inter('a', 'b', 1)} / {S.area('b', 1)}, 6) as covered, {S.inter('a', 'b')} as intersection from {_PAIR}""", D)
def iou_conventions(t):
    a, b = B.cols("a_"), B.cols()
    return _pairs(t).select(
        "image_id", "model", F.round(B.iou(a, b, inclusive=True), 6).alias("inclusive"), F.round(B.iou(a, b, floor=1e-5), 6).alias("floored"),
        F.round(B.iou(a, b), 6).alias("plain"), F.round(B.iou(a, b, plus=1e-6), 6).alias("plus"), F.round(B.dice(a, b), 6).alias("dice"),
        F.round(B.ioa(a, b, inclusive=True), 6).alias("covered"), B.intersection(a, b).alias("intersection"))


@query("box_measures", """select image_id, model, seq, (x2 - x1) * (y2 - y1) as area, (x1 + x2) / 2 as cx, (y1 + y2) / 2 as cy,
  x2 - x1 as w, y2 - y1 as h, x1 * 2 as sx1, y2 * 0.5 as sy2, x1 + 3 as mx1, (x1 >= 8 and y1 >= 8 and x2 <= 80 and y2 <= 80) as contained,
  30 - x1 as dl, 20 - y1 as dt, x2 - 30 as dr, y2 - 20 as db from detections""", D)
def box_measures(t):
    b = B.cols()
    cx, cy = B.center(b)
    _, _, w, h = B.to_xywh(b)
    s, m = B.scale(b, 2.0, 0.5), B.shift(b, 3.0, 0.0)
    frame = B.Box(F.lit(8.0), F.lit(8.0), F.lit(80.0), F.lit(80.0))
    dl, dt, dr, db = B.point_edge_distances(F.lit(30.0), F.lit(20.0), b)
    return t.detections.select(*KEY, B.area(b).alias("area"), cx.alias("cx"), cy.alias("cy"), w.alias("w"), h.alias("h"),
                               s.x1.alias("sx1"), s.y2.alias("sy2"), m.x1.alias("mx1"), B.inside(b, frame).alias("contained"),
                               dl.alias("dl"), dt.alias("dt"), dr.alias("dr"), db.alias("db"))


@query("box_conversions", """select image_id, model, seq, x1 + y1 as a2, round((score - 0.5) * width, 5) as cx1,
  round((0.5 + score / 2) * height, 5) as cy2,
  round(x1 - (abs(cos(radians(seq * 15))) * x2 + abs(sin(radians(seq * 15))) * y2) / 2, 5) as rx1,
  round(y1 + (abs(cos(radians(seq * 15))) * y2 + abs(sin(radians(seq * 15))) * x2) / 2, 5) as ry2
  from detections join images using (image_id)""", DI)
def box_conversions(t):
    c = F.col
    a = B.from_xywh(c("x1"), c("y1"), c("y1"), c("x1"))
    n = B.from_cxcywh(c("score"), F.lit(0.5), F.lit(1.0), c("score"), c("width"), c("height"))
    r = B.from_rotated(c("x1"), c("y1"), c("x2"), c("y2"), c("seq") * 15)
    return t.detections.join(t.images, "image_id").select(
        *KEY, a.x2.alias("a2"), F.round(n.x1, 5).alias("cx1"), F.round(n.y2, 5).alias("cy2"),
        F.round(r.x1, 5).alias("rx1"), F.round(r.y2, 5).alias("ry2"))


@query("processing_scale", """select image_id, case when cast(width * 40 as bigint) * (height * 40) > 12000000 then 1536
   when cast(width * 40 as bigint) * (height * 40) > 6000000 then 2048 else 2560 end as side from images""", ("images",))
def processing_scale(t):
    return t.images.select("image_id", masks.processing_size(F.col("width") * 40, F.col("height") * 40).alias("side"))


# ---- overlap joins -------------------------------------------------------------------------

@query("overlap_join", f"""select image_id, a.model as left_model, a.seq as left_seq, b.model as right_model, b.seq as right_seq,
  round({S.iou('a', 'b', 1)}, 6) as iou from detections a join detections b using (image_id)
  where a.priority = 1 and b.priority > 1 and {S.iou('a', 'b', 1)} >= 0.65""", D)
def overlap_join(t):
    d = t.detections.select("image_id", "model", "priority", "seq", "x1", "y1", "x2", "y2")
    p = overlap.overlap_pairs(d.where("priority = 1"), d.where("priority > 1"), 0.65, dice=0.75)
    return p.select("image_id", F.col("l.model").alias("left_model"), F.col("l.seq").alias("left_seq"),
                    F.col("r.model").alias("right_model"), F.col("r.seq").alias("right_seq"), F.round("iou", 6).alias("iou"))


@query("iou_pairs", f"""select image_id, a.priority as p1, a.seq as s1, b.priority as p2, b.seq as s2, round({S.iou('a', 'b', 1)}, 6) as iou,
  round(2 * {S.inter('a', 'b', 1)} / ({S.area('a', 1)} + {S.area('b', 1)}), 6) as dice from detections a join detections b using (image_id)
  where (a.priority < b.priority or (a.priority = b.priority and a.seq < b.seq)) and {S.iou('a', 'b', 1)} >= 0.5""", D)
def iou_pairs(t):
    """Overlapping pairs of an image (the non-trivial part of its overlap matrix)."""
    d = t.detections.select("image_id", "priority", "seq", "x1", "y1", "x2", "y2")
    before = (F.struct("l.priority", "l.seq") < F.struct("r.priority", "r.seq"))
    p = overlap.overlap_pairs(d, d, 0.5, extra=before)
    return p.select("image_id", F.col("l.priority").alias("p1"), F.col("l.seq").alias("s1"), F.col("r.priority").alias("p2"),
                    F.col("r.seq").alias("s2"), F.round("iou", 6).alias("iou"), F.round(B.dice(B.of("l"), B.of("r")), 6).alias("dice"))


@query("add_masks", f"""with objs as (select * from detections where priority = 1), fits as (
   select o.image_id, o.seq, case m.priority when 4 then 0 else 1 end as rank, m.priority as mp, m.seq as mseq, m.x1, m.y1, m.x2, m.y2,
     {S.iou('o', 'm', 1)} as v from objs o join detections m on o.image_id = m.image_id and m.priority in (3, 4)
   where {S.iou('o', 'm', 1)} >= 0.65),
  best as (select *, row_number() over (partition by image_id, seq order by rank, v desc, mseq) as rn from fits)
 select o.image_id, o.seq as id, coalesce(b.x1, o.x1) as x1, coalesce(b.y1, o.y1) as y1, coalesce(b.x2, o.x2) as x2,
   coalesce(b.y2, o.y2) as y2, case b.rank when 0 then 'SAM' when 1 then 'EVA' end as segmentation_source, cast(b.mseq as int) as segmentation
 from objs o left join best b on o.image_id = b.image_id and o.seq = b.seq and b.rn = 1""", D)
def add_masks(t):
    cols = ["image_id", "seq", "x1", "y1", "x2", "y2"]
    d = t.detections
    objs = d.where("priority = 1").select("image_id", F.col("seq").alias("id"), "x1", "y1", "x2", "y2")
    src = lambda p: d.where(f"priority = {p}").select(*cols, F.col("seq").alias("segmentation"))
    return merge.add_masks(objs, {"SAM": src(4), "EVA": src(3)})


@query("remaining_masks", """select image_id, seq as id, case when seq % 3 = 0 then 'HQ_SAM' when score > 0.5 then 'SAM' end as segmentation_source,
   (seq % 3 = 0 or score > 0.5) as has_mask from detections where priority = 1""", D)
def remaining_masks(t):
    objs = t.detections.where("priority = 1").select(
        "image_id", F.lit("object").alias("kind"), F.col("seq").alias("id"), F.when(F.col("score") > 0.5, F.col("seq")).alias("segmentation"),
        F.when((F.col("score") > 0.5) & (F.col("seq") % 3 != 0), "SAM").alias("segmentation_source"))
    objs = objs.withColumn("segmentation", F.when(F.col("id") % 3 != 0, F.col("segmentation")))
    lack = merge.without_masks(objs)
    found = lack.where("id % 3 = 0").select("image_id", "id", F.col("id").alias("segmentation"))
    out = merge.update_masks(objs, found)
    return out.select("image_id", "id", "segmentation_source", F.col("segmentation").isNotNull().alias("has_mask"))


# ---- run-length masks ------------------------------------------------------------------------

H = 120   # height of the frame that proposal masks are drawn in


def _proposals(t):
    """Boxes of the mask model as proposals in x, y, w, h with a filled mask."""
    x, y = F.col("x1").cast("int"), F.col("y1").cast("int")
    w, h = (F.col("x2") - F.col("x1")).cast("int"), (F.col("y2") - F.col("y1")).cast("int")
    rest = F.flatten(F.array_repeat(F.array((F.lit(H) - h).cast("long"), h.cast("long")), w - 1))
    tail = F.lit(H * 120) - (x + w - 1) * H - y - h
    counts = F.concat(F.array((x * H + y).cast("long"), h.cast("long")), rest, F.array(tail.cast("long")))
    return t.detections.where("priority = 4").select(
        "image_id", "seq", x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"), "score",
        F.struct(F.lit(H).alias("h"), F.lit(120).alias("w"), counts.alias("counts")).alias("segmentation"))


_M = "from detections where priority = 4"


@query("rle_area", f"select image_id, seq, cast((x2 - x1) * (y2 - y1) as bigint) as area {_M}", D)
def rle_area(t):
    return _proposals(t).select("image_id", "seq", masks.rle_area("segmentation.counts").alias("area"))


@query("rle_boxes", f"""select image_id, seq, cast(x1 as bigint) as x1, cast(y1 as bigint) as y1, cast(x2 - 1 as bigint) as x2,
  cast(y2 - 1 as bigint) as y2 {_M}""", D)
def rle_boxes(t):
    return masks.mask_boxes(_proposals(t), ["image_id", "seq"])


@query("rle_runs", f"select image_id, seq, cast(x2 - x1 as bigint) as runs, cast(y2 - y1 as bigint) as longest {_M}", D)
def rle_runs(t):
    return masks.runs(_proposals(t), ["image_id", "seq"]).groupBy("image_id", "seq").agg(
        F.count("*").alias("runs"), F.max("length").alias("longest"))


@query("rle_encode", """with px as (select distinct user_id as image_id, event_id % 64 as x, cast(floor(event_id / 64) as bigint) % 64 as y from events),
  p as (select image_id, x * 64 + y as p from px), g as (select *, p - row_number() over (partition by image_id order by p) as g from p),
  isl as (select image_id, min(p) as s, count(*) as n from g group by image_id, g.g),
  gap as (select *, s - coalesce(lag(s + n) over (partition by image_id order by s), 0) as gap from isl)
  select image_id, string_agg(gap || ',' || n, ',' order by s) || case when max(s + n) < 4096 then ',' || (4096 - max(s + n)) else '' end as counts
  from gap group by image_id""")
def rle_encode(t):
    px = t.events.select(F.col("user_id").alias("image_id"), F.lit(64).alias("h"), F.lit(64).alias("w"), (F.col("event_id") % 64).alias("x"),
                         (F.expr("event_id div 64") % 64).alias("y"))
    return masks.encode(px, ["image_id"]).select("image_id", text("segmentation.counts").alias("counts"))


@query("rle_round_trip", f"select image_id, seq, cast((x2 - x1) * (y2 - y1) as bigint) as pixels {_M}", D)
def rle_round_trip(t):
    """Masks decoded to pixels and encoded again keep their area."""
    p = masks.pixels(masks.runs(_proposals(t), ["image_id", "seq"]), packed=True)
    again = masks.encode(p, ["image_id", "seq"])
    return again.select("image_id", "seq", masks.rle_area("segmentation.counts").alias("pixels"))


@query("mask_iou", f"""select image_id, a.seq as seq_a, b.seq as seq_b, round({S.iou('a', 'b')}, 6) as iou,
  round(2 * {S.inter('a', 'b')} / ({S.area('a')} + {S.area('b')}), 6) as dice
  from (select * {_M}) a join (select * {_M}) b using (image_id) where a.seq < b.seq and {S.iou('a', 'b')} >= 0.5""", D)
def mask_iou(t):
    p = _proposals(t)
    box = B.from_xywh(*[F.col(c).cast("double") for c in "xywh"])
    boxes = p.select("image_id", "seq", *[getattr(box, c).alias(c) for c in ("x1", "y1", "x2", "y2")])
    pairs = overlap.overlap_pairs(boxes, boxes, 0.5, inclusive=False, extra=F.col("l.seq") < F.col("r.seq")).select(
        F.col("image_id").alias("image_id_a"), F.col("l.seq").alias("seq_a"), F.col("image_id").alias("image_id_b"), F.col("r.seq").alias("seq_b"))
    return masks.mask_overlap(pairs, p, ["image_id", "seq"]).select(
        F.col("image_id_a").alias("image_id"), "seq_a", "seq_b", F.round("iou", 6).alias("iou"), F.round("dice", 6).alias("dice"))


@query("stability_score", """select user_id as image_id, round(case when sum(case when value - 10 > -1 then 1 else 0 end) = 0 then null
  else cast(sum(case when value - 10 > 1 then 1 else 0 end) as double) / sum(case when value - 10 > -1 then 1 else 0 end) end, 6) as stability
  from events group by 1""")
def stability_score(t):
    logits = t.events.select(F.col("user_id").alias("image_id"), (F.col("value") - 10).alias("logit"))
    return masks.stability(logits, ["image_id"]).select("image_id", F.round("stability", 6).alias("stability"))


@query("crop_boxes", """with l as (select image_id, width, height, layer, cast(power(2, layer) as int) as n,
   case when layer = 0 then 0 else cast(floor(0.25 * least(width, height) * (2.0 / power(2, layer))) as int) end as o
   from images, (select unnest([0, 1, 2]) as layer)),
 s as (select *, cast(ceil((o * (n - 1) + width) / n) as int) as cw, cast(ceil((o * (n - 1) + height) / n) as int) as ch from l),
 g as (select s.*, i, j from s, (select unnest([0, 1, 2, 3]) as i), (select unnest([0, 1, 2, 3]) as j) where i < n and j < n)
 select image_id, layer, i, j, (cw - o) * i as x1, (ch - o) * j as y1, least((cw - o) * i + cw, width) as x2,
   least((ch - o) * j + ch, height) as y2 from g""", ("images",))
def crop_boxes(t):
    return masks.crop_boxes(t.images, 2, 0.25)


@query("near_crop_edge", """select image_id, model, seq, x1 + 10 as ux1, (abs(x1 + 10 - 10) <= 5 and not abs(x1 + 10) <= 5)
   or (abs(y1 - 0) <= 5 and not abs(y1) <= 5) or (abs(x2 + 10 - 70) <= 5 and not abs(x2 + 10 - width) <= 5)
   or (abs(y2 - 60) <= 5 and not abs(y2 - height) <= 5) as near from detections join images using (image_id)""", DI)
def near_crop_edge(t):
    crop = {"crop_x1": 10.0, "crop_y1": 0.0, "crop_x2": 70.0, "crop_y2": 60.0}
    d = t.detections.join(t.images, "image_id")
    for k, v in crop.items():
        d = d.withColumn(k, F.lit(v))
    u = masks.uncrop(d)
    return u.select(*KEY, F.col("x1").alias("ux1"), masks.near_crop_edge(u, 5.0).alias("near"))


@query("point_grid", """select image_id, round((x + 0.5) / 4 * width, 4) as px, round((y + 0.5) / 4 * height, 4) as py
  from images, (select unnest([0, 1, 2, 3]) as x), (select unnest([0, 1, 2, 3]) as y)""", ("images",))
def point_grid(t):
    return t.images.select("image_id", "width", "height", F.explode(masks.point_grid(4)).alias("p")).select(
        "image_id", F.round(F.col("p.x") * F.col("width"), 4).alias("px"), F.round(F.col("p.y") * F.col("height"), 4).alias("py"))


@query("polygon_area", "select image_id, model, seq, (x2 - x1) * (y2 - y1) / 2 as area, (seq % 2 = 0) as valid from detections", D)
def polygon_area(t):
    xs, ys = F.array("x1", "x2", "x2"), F.array("y1", "y1", "y2")
    flat = F.when(F.col("seq") % 2 == 0, F.array("x1", "y1", "x2", "y1", "x2", "y2")).otherwise(F.array("x1", "y1", "x2", "y2"))
    return t.detections.select(*KEY, masks.polygon_area(xs, ys).alias("area"), masks.polygon_valid(flat).alias("valid"))
