"""Finding work, reading model outputs, depth maps, documents and tracking."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boxloom import scale
from boxloom.plans.queries import sqltext as S
from boxloom.plans.queries.objects import plain_objects
from boxloom.plans.registry import query
from boxloom.sources import discover, predictions
from boxloom.streaming import progress, track

I, D, DI = ("images",), ("detections",), ("detections", "images")
BOX = ["x1", "y1", "x2", "y2"]


def files(t):
    """Images as a file listing in the three folder layouts."""
    n = F.col("image_id") % 3
    ds = F.concat(F.element_at(F.array(F.lit("det"), F.lit("cls"), F.lit("flat")), (n + 1).cast("int")), F.substring("dataset", 7, 2))
    folder = F.when(n == 0, F.lit("images/")).when(n == 1, F.concat(F.lower("class_name"), F.lit("/"))).otherwise("")
    junk = F.explode(F.array(F.col("file_name"), F.concat(F.col("image_id").cast("string"), F.lit(".txt"))))
    return t.images.withColumn("f", junk).select(
        F.concat(F.lit("file:/data/root/"), ds, F.lit("/"), folder, "f").alias("path"), F.lit(None).cast("timestamp").alias("modified"),
        F.col("width").cast("long").alias("size"))


_DISC = """disc as (select image_id, ['det', 'cls', 'flat'][image_id % 3 + 1] || substring(dataset, 7, 2) as dataset, ['detection', 'classification', 'flat'][image_id % 3 + 1] as layout,
   case when image_id % 3 = 1 then lower(class_name) end as class_name, file_name from images)"""


@query("discover_images", f"with {_DISC} select dataset, layout, class_name, cast(image_id as varchar) as image_id, file_name from disc where dataset <> 'det3' and coalesce(class_name, '') <> 'promo'", I)
def discover_images(t):
    found = discover.discover_images(files(t), "/data/root", ignore=["det3", "promo"])
    return found.select("dataset", "layout", "class_name", "image_id", "file_name")


def outputs(t):
    """Outputs of three kinds that exist for part of the images; some are unreadable."""
    n = F.col("image_id") % 7
    kinds = F.array(F.lit("tags"), F.when(n < 5, "boxes"), F.when(n % 2 == 0, "scene"))
    rows = t.images.select("image_id", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("kind"))
    return rows.withColumn("text", F.when(F.col("image_id") % 20 == 0, "{broken").otherwise('{"a":1}'))


_TODO = "todo as (select * from images where not (image_id % 7 < 5 and image_id % 7 % 2 = 0 and image_id % 20 <> 0))"


@query("pending", f"with {_TODO} select image_id, file_name from todo", I)
def pending(t):
    ok = F.try_parse_json("text").isNotNull()
    return discover.pending(t.images, outputs(t), ["tags", "boxes", "scene"], ok).select("image_id", "file_name")


_REPORT = f"""{_TODO}, rep as (select class_name, count(*) as total, count(*) - count(b.image_id) as complete, count(b.image_id) as missing from images left join
   (select image_id from todo) b using (image_id) group by 1)"""


@query("completion_report", f"with {_REPORT} select class_name, total, complete, missing, round(100.0::double * complete / total, 1) as percent from rep", I)
def completion_report(t):
    todo = discover.pending(t.images, outputs(t), ["tags", "boxes", "scene"], F.try_parse_json("text").isNotNull())
    return discover.completion_report(t.images, todo)


@query("most_missing", f"with {_REPORT} select class_name, missing from rep order by missing desc, class_name limit 3", I)
def most_missing(t):
    todo = discover.pending(t.images, outputs(t), ["tags", "boxes", "scene"], F.try_parse_json("text").isNotNull())
    return discover.most_missing(discover.completion_report(t.images, todo), 3).select("class_name", "missing")


@query("finished_datasets", """with m as (select dataset, count(*) as total, count(*) filter (width = 70) as missing from images group by 1)
   select dataset, total from m where missing = 0 and dataset <> 'Brand#32'""", I)
def finished_datasets(t):
    report = discover.completion_report(t.images, t.images.where("width = 70"), by="dataset")
    log = t.images.where("dataset = 'Brand#32'").select("dataset").distinct()
    return discover.finished_datasets(report, log).select("dataset", "total")


@query("completion_rows", """with m as (select dataset, count(*) as total, count(*) filter (width = 70 and dataset like '%1') as missing, count(*) filter (image_id % 20 <> 0) as processed,
    count(*) filter (image_id % 20 = 0) as failed, cast(sum(image_id % 3) as bigint) as masks, sum(width / 8.0::double) as seconds, max(image_id) as last from images group by 1)
   select dataset, total, processed, failed, masks, seconds, round(processed / seconds, 9) as per_second, last as finished_at from m where missing = 0""", I)
def completion_rows(t):
    """The log after three runs: the second repeats the first, the third finds more datasets finished."""
    ts = F.timestamp_seconds(F.col("image_id"))
    runs = t.images.select("dataset", ts.alias("ts"), (F.col("image_id") % 20 != 0).alias("success"), (F.col("image_id") % 3).alias("masks"), (F.col("width") / 8.0).alias("seconds"))
    path = f"{scale.shared_folder(t.spark)}/completions-{uuid.uuid4().hex}"
    for batch, open_ in ((0, "width = 70"), (0, "width = 70"), (1, "width = 70 and dataset like '%1'")):
        discover.log_completions(discover.completion_report(t.images, t.images.where(open_), by="dataset"), runs, path, batch)
    log = t.spark.read.schema(discover.COMPLETION).parquet(path)
    return log.select("dataset", "total", "processed", "failed", "masks", "seconds", F.round("per_second", 9).alias("per_second"), F.unix_timestamp("finished_at").alias("finished_at"))


@query("dataset_filter", "select image_id, dataset from images where contains(dataset, '#1') and dataset in (select dataset from images where width = 80)", I)
def dataset_filter(t):
    return discover.dataset_filter(t.images, "#1", t.images.where("width = 80")).select("image_id", "dataset")


@query("pair_by_stem", "select image_id, class_name, image_id || '.json' as record_name from images where image_id % 4 <> 0", I)
def pair_by_stem(t):
    records = t.images.where("image_id % 4 <> 0").select("class_name", F.concat(F.col("image_id").cast("string"), F.lit(".json")).alias("file_name"))
    return discover.pair_by_stem(t.images, records).select("image_id", "class_name", "record_name")


def unique_files(t):
    """Orders as depth files of images, several for most."""
    f = t.orders.select(F.col("o_orderstatus").alias("folder"), F.concat(
        F.col("o_custkey").cast("string"), F.lit(".png_min_-1.5_max_"), (F.col("o_orderkey") % 90).cast("string"), F.lit(".25.jpg")).alias("file_name"),
        "o_orderdate", F.round("o_totalprice").cast("long").alias("p"))
    return f.groupBy("folder", "file_name").agg(F.max("o_orderdate").alias("modified"), F.max("p").alias("size"))


_UF = """uf as (select o_orderstatus as folder, o_custkey || '.png_min_-1.5_max_' || (o_orderkey % 90) || '.25.jpg' as file_name, cast(min(o_custkey) as varchar) as stem,
   max(o_orderdate) as modified, max(cast(round(o_totalprice) as bigint)) as size from orders group by 1, 2)"""


def _dedup(keep, order):
    @query(f"dedup_outputs_{keep}", f"""with {_UF}, r as (select *, row_number() over (partition by folder, stem order by {order}, file_name) as rn, count(*) over (partition by folder, stem) as copies from uf)
      select folder, file_name, stem, copies, rn = 1 as keep from r""")
    def run(t):
        return discover.dedup_outputs(unique_files(t), keep).select("folder", "file_name", "stem", "copies", "keep")


_dedup("newest", "modified desc")
_dedup("oldest", "modified")
_dedup("largest", "size desc")


@query("duplicate_report", f"""with {_UF}, r as (select *, row_number() over (partition by folder, stem order by modified desc, file_name) as rn, count(*) over (partition by folder, stem) as copies from uf)
   select folder, count(distinct stem) as duplicated, count(*) filter (rn > 1) as removable, cast(sum(case when rn > 1 then size else 0 end) as bigint) as bytes from r where copies > 1 group by 1""")
def duplicate_report(t):
    return discover.duplicate_report(discover.dedup_outputs(unique_files(t)))


# ---- model outputs ---------------------------------------------------------------------------------------

def documents(t):
    """Per image and model one JSON document, in the accepted shapes in turn; one in 17 is cut off."""
    box = F.array("x1", "y1", "x2", "y2")
    one = t.detections.select("image_id", "model", "seq", F.struct(
        box.alias("bbox"), "score", F.when(F.col("model") != "grit", F.col("label")).alias("label"),
        F.when(F.col("model") == "grit", F.col("label")).alias("description"), F.array(F.lit(1), F.lit(2)).alias("sam_mask")).alias("d"))
    per = one.groupBy("image_id", "model").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "d"))), lambda s: s["d"]).alias("l"))
    image = F.concat(F.col("image_id").cast("string"), F.lit(".jpg"))
    shape = F.col("image_id") % 4
    text = (F.when(shape == 0, F.to_json("l")).when(shape == 1, F.to_json(F.create_map(image, F.create_map("model", "l"))))
            .when(shape == 2, F.to_json(F.create_map(image, "l"))).otherwise(F.to_json(F.create_map("model", "l"))))
    cut = F.when(F.col("image_id") % 17 == 0, F.expr("left(x, length(x) - 3)")).otherwise(F.col("x"))
    return per.withColumn("x", text).select("image_id", "model", cut.alias("text"))


_READ = "from detections where image_id % 17 <> 0"


@query("read_predictions", f"select image_id, model, row_number() over (partition by image_id, model order by seq) - 1 as seq, x1, y2, score, label {_READ}", D)
def read_predictions(t):
    d = predictions.detections(predictions.payload(documents(t)))
    return d.select("image_id", "model", F.col("seq").cast("long").alias("seq"), "x1", "y2", "score", "label")


@query("unreadable_predictions", "select distinct image_id, model from detections where image_id % 17 = 0", D)
def unreadable_predictions(t):
    return predictions.unreadable(predictions.payload(documents(t)))


@query("default_predictions", """with m(model, kind, empty) as (values ('eva-02-01', 'detector', '[]'), ('ram', 'tagger', '{"tags":[],"scores":[]}'), ('landmark', 'scene', '{"category":"","fine_category":""}')),
   g as (select image_id, model, empty from images, m), have as (select distinct image_id, model from detections where priority = 1 and image_id % 17 <> 0)
   select image_id, model, case when h.model is null then empty else 'given' end as body, h.model is null as defaulted from g left join have h using (image_id, model)""", DI)
def default_predictions(t):
    models = t.spark.createDataFrame([("eva-02-01", "detector"), ("ram", "tagger"), ("landmark", "scene")], "model string, kind string")
    out = predictions.with_defaults(t.images, models, predictions.payload(documents(t)))
    return out.select("image_id", "model", F.when(F.col("defaulted"), F.col("body")).otherwise("given").alias("body"), "defaulted")


@query("read_tags", """select doc_id as image_id, 'ram' as model, cast(p as int) as pos, case p when 0 then lang else source end as tag, 0.5::double + p * 0.25 as score
   from documents, (select unnest([0, 1]) as p)""")
def read_tags(t):
    doc = F.to_json(F.create_map(F.concat(F.col("doc_id").cast("string"), F.lit(".jpg")), F.create_map(F.lit("ram"), F.struct(
        F.array("lang", "source").alias("tags"), F.array(F.lit(0.5), F.lit(0.75)).alias("scores")))))
    return predictions.tags(predictions.payload(t.documents.select(F.col("doc_id").alias("image_id"), F.lit("ram").alias("model"), doc.alias("text"))))


@query("read_scenes", """select doc_id as image_id, case when doc_id % 3 = 0 then source end as category from documents""")
def read_scenes(t):
    image = F.concat(F.col("doc_id").cast("string"), F.lit(".jpg"))
    n = F.col("doc_id") % 3
    good = F.to_json(F.create_map(image, F.create_map(F.lit("landmark"), F.struct(F.col("source").alias("category"), F.lit("x").alias("fine_category")))))
    text = F.when(n == 0, good).when(n == 1, F.to_json(F.create_map(image, F.create_map(F.lit("landmark"), F.lit(""))))).otherwise(
        F.to_json(F.create_map(image, F.create_map(F.lit("landmark"), F.array(F.lit("a"))))))
    s = predictions.scenes(predictions.payload(t.documents.select(F.col("doc_id").alias("image_id"), F.lit("landmark").alias("model"), text.alias("text"))))
    return s.select("image_id", "landmark.category")


@query("read_captions", "select doc_id as image_id, 'llava' as source, text as caption from documents")
def read_captions(t):
    image = F.concat(F.col("doc_id").cast("string"), F.lit(".jpg"))
    plain, nested = F.create_map(F.lit("llava"), "text"), F.create_map(F.lit("llava"), F.create_map(F.lit("llava"), "text"))
    text = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.create_map(image, plain))).otherwise(F.to_json(F.create_map(image, nested)))
    return predictions.captions(predictions.payload(t.documents.select(F.col("doc_id").alias("image_id"), F.lit("llava").alias("model"), text.alias("text"))))


# ---- depth ------------------------------------------------------------------------------------------------

@query("depth_range", f"with {_UF} select folder, file_name, stem, -1.5::double as low, cast(regexp_extract(file_name, '_max_(.*).jpg', 1) as double) as high from uf")
def depth_range(t):
    stem, low, high = predictions.depth_range(F.col("file_name"))
    return unique_files(t).select("folder", "file_name", stem.alias("stem"), low.alias("low"), high.alias("high"))


@query("quantise_depth", """with r as (select image_id, min(value) as lo, max(value) as hi from depth group by 1)
   select image_id, x, y, case when hi = lo then 0 else cast(floor((value - lo) / (hi - lo) * 255) as int) end as level, lo, hi from depth join r using (image_id)""", ("depth",))
def quantise_depth(t):
    return predictions.quantise_depth(t.depth)


@query("dequantise_depth", """with r as (select image_id, min(value) as lo, max(value) as hi from depth group by 1),
   q as (select image_id, x, y, case when hi = lo then 0 else cast(floor((value - lo) / (hi - lo) * 255) as int) end as level, lo, hi from depth join r using (image_id))
   select image_id, x, y, round(level / 255.0::double * (hi - lo) + lo, 6) as value from q""", ("depth",))
def dequantise_depth(t):
    q = predictions.quantise_depth(t.depth)
    return q.select("image_id", "x", "y", F.round(predictions.dequantise(F.col("level"), F.col("lo"), F.col("hi")), 6).alias("value"))


@query("annotation_documents", """with o as (select image_id, priority, seq - 1 + (priority - 1) * 1000 as id from detections),
   p as (select image_id, cast(id // 50 as int) as part, count(*) filter (priority % 2 = 1) as objects, count(*) filter (priority % 2 = 0) as floating from o group by 1, 2)
   select image_id, coalesce(part, 0) as part, coalesce(objects, 0) as objects, coalesce(floating, 0) as floating from images left join p using (image_id)""", DI)
def annotation_documents(t):
    docs = predictions.documents(t.images, plain_objects(t), part=50)
    n = lambda c: F.coalesce(F.when(F.size(c) >= 0, F.size(c)), F.lit(0)).cast("long")
    return docs.select("image_id", "part", n("objects").alias("objects"), n("floating_objects").alias("floating"))


# ---- tracking and progress ----------------------------------------------------------------------------------

def video_boxes(t):
    """Events as boxes in frames: 20 videos, 25 boxes in each frame."""
    e = F.col("event_id")
    box = [((F.col("user_id") % 9) * 30 + e % 3).cast("double"), ((e % 25) * 4).cast("double")]
    return t.events.select((e % 20).alias("video_id"), F.expr("cast(event_id div 500 as int)").alias("frame"),
                           F.expr("cast((event_id % 500) div 20 as int)").alias("idx"), box[0].alias("x1"), box[1].alias("y1"),
                           (box[0] + 40).alias("x2"), (box[1] + 40).alias("y2"))


_VB = """vb as (select event_id % 20 as video_id, cast(event_id // 500 as int) as frame, cast((event_id % 500) // 20 as int) as idx, cast((user_id % 9) * 30 + event_id % 3 as double) as x1,
   cast((event_id % 25) * 4 as double) as y1, cast((user_id % 9) * 30 + event_id % 3 + 40 as double) as x2, cast((event_id % 25) * 4 + 40 as double) as y2 from events)"""
_LINKS = f"""{_VB}, vp as (select n.video_id, n.frame, n.idx, p.idx as prev, {S.iou('n', 'p')} as v from vb n join vb p on n.video_id = p.video_id and n.frame = p.frame + 1
   where {S.iou('n', 'p')} >= 0.5),
  vl as ({S.leaders('vp', 'video_id, frame', '{order}idx, prev', 'i := idx, p := prev', 'i integer, p integer', 'k.i = d.i or k.p = d.p')}),
  lk as (select video_id, frame, u.i as idx, u.p as prev from (select video_id, frame, unnest(lead) as u from vl))"""


@query("track_links", f"with {_LINKS.format(order='')} select video_id, cast(frame + 1 as bigint) as f, idx, prev from lk")
def track_links(t):
    return track.frame_links(video_boxes(t))


@query("track_links_best_first", f"with {_LINKS.format(order='v desc, ')} select video_id, cast(frame + 1 as bigint) as f, idx, prev from lk")
def track_links_best_first(t):
    return track.frame_links(video_boxes(t), best_first=True)


@query("track_iou", f"""with recursive {_LINKS.format(order='')},
  ch as (select vb.video_id, vb.frame, vb.idx, vb.frame as hf, vb.idx as hi from vb left join lk using (video_id, frame, idx) where prev is null
    union all select lk.video_id, lk.frame, lk.idx, ch.hf, ch.hi from ch join lk on lk.video_id = ch.video_id and lk.frame = ch.frame + 1 and lk.prev = ch.idx),
  hd as (select video_id, hf, hi, row_number() over (partition by video_id order by hf, hi) - 1 as track_id from (select distinct video_id, hf, hi from ch))
  select video_id, frame, idx, track_id, cast(frame - hf + 1 as bigint) as period from ch join hd using (video_id, hf, hi)""")
def track_iou(t):
    return track.track_frames(video_boxes(t)).select("video_id", "frame", "idx", "track_id", "period")


_MEMORY = f"""{_VB}, df as (select video_id, frame, row_number() over (partition by video_id order by frame) as f from (select distinct video_id, frame from vb)),
  fb as (select vb.*, f, f * 100000 + idx as node from vb join df using (video_id, frame)),
  vp as (select n.video_id, n.f, n.idx as i, n.f - p.f as lag, p.idx as j, n.node as a, p.node as b from fb n join fb p on n.video_id = p.video_id and n.f - p.f between 1 and 4
   where {S.iou('n', 'p')} >= 0.5 and (n.f - p.f = 1 or ((p.x2 - p.x1) / 400 >= 0.02 and (p.y2 - p.y1) / 300 >= 0.02))),
  tk as (select video_id, list_reduce(list(struct_pack(a := a, b := b, lag := lag) order by f, i, lag, j), lambda won, d: case
     when len(list_filter(won, lambda k: k.a = d.a or k.b = d.b)) > 0 then won
     when d.lag > 1 and len(list_filter(won, lambda k: k.a = d.b)) = 0 then won else list_append(won, d) end, cast([] as struct(a bigint, b bigint, lag bigint)[])) as won
   from vp group by 1),
  lk as (select video_id, u.a as a, u.b as b from (select video_id, unnest(won) as u from tk))"""


@query("track_with_memory", f"""with recursive {_MEMORY},
  ch as (select fb.video_id, node, node as head, cast(1 as bigint) as period from fb left join lk on lk.video_id = fb.video_id and lk.a = fb.node where lk.a is null
    union all select lk.video_id, lk.a, ch.head, ch.period + 1 from ch join lk on lk.video_id = ch.video_id and lk.b = ch.node),
  hd as (select video_id, head, row_number() over (partition by video_id order by head) - 1 as track_id from (select distinct video_id, head from ch))
  select video_id, frame, idx, track_id, period from ch join hd using (video_id, head) join fb using (video_id, node)""")
def track_with_memory(t):
    """Objects may be lost for up to three frames."""
    return track.track_with_memory(video_boxes(t), max_lost=3, width=400, height=300).select("video_id", "frame", "idx", "track_id", "period")


@query("run_rate", """select cast(epoch(date_trunc('hour', ts)) as bigint) as window_start, event_type as dataset, count(*) as images, count(*) filter (value <= 5) as failures,
   round(count(*) / 3600.0::double, 8) as per_second from events group by 1, 2""")
def run_rate(t):
    r = progress.run_rate(t.events.select("ts", F.col("event_type").alias("dataset"), (F.col("value") > 5).alias("success")), "1 hour", None)
    return r.select(F.unix_timestamp("window_start").alias("window_start"), "dataset", "images", "failures", F.round("per_second", 8).alias("per_second"))


@query("remaining_time", """with d as (select event_type as dataset, count(*) as done, max(epoch(date_trunc('second', ts)))::bigint - min(epoch(date_trunc('second', ts)))::bigint as s from events where value > 5 group by 1),
   tt as (select event_type as dataset, count(*) as total from events group by 1)
   select dataset, total, done, total - done as "left", round(done::double / s, 9) as per_second, round((total - done) / (done::double / s), 4) as seconds_left from tt join d using (dataset)""")
def remaining_time(t):
    e = t.events.withColumnRenamed("event_type", "dataset")
    r = progress.remaining_time(e.where("value > 5"), e.groupBy("dataset").agg(F.count("*").alias("total")))
    return r.select("dataset", "total", "done", "left", F.round("per_second", 9).alias("per_second"), F.round("seconds_left", 4).alias("seconds_left"))
