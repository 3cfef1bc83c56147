"""Annotation formats, statistics and subsets of corpora."""
from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.operators import reports, sampling
from boxloom.plans.registry import query
from boxloom.sources import corpora as C

D, DI = ("detections",), ("detections", "images")
BOX = ["x1", "y1", "x2", "y2"]


def annotations(t):
    d = t.detections.where("priority = 1")
    label = F.substring("label", -1, 1)
    cat = F.when(F.col("label") == "person", 90).otherwise(label.cast("int") * 10)
    return d.select("image_id", "seq", cat.alias("category_id"), *BOX, (F.col("seq") % 10 == 0).cast("int").alias("iscrowd"))


def categories(t):
    return annotations(t).select("category_id").distinct().withColumn("name", F.concat(F.lit("cat"), F.col("category_id").cast("string")))


_AN = """an as (select image_id, seq, case when label = 'person' then 90 else cast(right(label, 1) as int) * 10 end as category_id, x1, y1, x2, y2,
   case when seq % 10 = 0 then 1 else 0 end as iscrowd from detections where priority = 1)"""


def coco_documents(t):
    """One exchange document per image, with polygons of two, three or four points."""
    x, y, r, b = (F.col(c) for c in BOX)
    polygon = F.when(F.col("seq") % 3 == 0, F.array(F.array(x, y, r, b))).when(
        F.col("seq") % 3 == 1, F.array(F.array(x, y, r, y, r, b), F.array(x, y))).otherwise(F.array(F.array(x, y, r, y, r, b, x, b)))
    one = annotations(t).select("image_id", F.struct(
        (F.col("image_id") * 100 + F.col("seq")).alias("id"), "image_id", "category_id", F.array(x, y, r - x, b - y).alias("bbox"),
        ((r - x) * (b - y)).alias("area"), "iscrowd", polygon.alias("segmentation"), F.array(x, y, F.lit(2.0)).alias("keypoints")).alias("a"))
    per = one.groupBy("image_id").agg(F.collect_list("a").alias("annotations"))
    image = F.array(F.struct(F.col("image_id").alias("id"), "file_name", "width", "height",
                             F.concat(F.lit("http://host/train/a/"), "file_name").alias("coco_url"),
                             F.array(F.lit(11)).alias("neg_category_ids"), F.array(F.lit(21), F.lit(31)).alias("not_exhaustive_category_ids")))
    cats = F.transform("annotations", lambda a: F.struct(a["category_id"].alias("id"), F.concat(F.lit("cat"), a["category_id"].cast("string")).alias("name"),
                                                         F.lit("f").alias("frequency")))
    doc = F.to_json(F.struct(image.alias("images"), "annotations", F.array_distinct(cats).alias("categories")))
    return t.images.join(per, "image_id").select(doc.alias("text"))


@query("read_coco", f"""with {_AN} select image_id * 100 + seq as ann_id, image_id, cast(dense_rank() over (order by category_id) - 1 as int) as class_index,
   x1, y1, x2, y2, case when seq % 3 = 0 then 0 else 1 end as polygons, x1 + 0.5::double as kx from an where seq % 3 <> 0""", D)
def read_coco(t):
    parts = C.parse_coco(C.from_text(coco_documents(t)))
    return parts["annotations"].select("ann_id", "image_id", "class_index", *BOX, F.size("polygons").alias("polygons"), F.col("keypoints")[0].alias("kx"))


@query("read_lvis", """select image_id, 'a/' || file_name as file_name, 10 as absent, 2 as loose from images where image_id in
   (select image_id from detections where priority = 1)""", DI)
def read_lvis(t):
    docs = C.from_text(coco_documents(t).withColumn("text", F.regexp_replace("text", r'"file_name":"[^"]*",', "")))
    parts = C.parse_lvis(docs)
    absent = parts["negative"].groupBy("image_id").agg(F.max("class_index").alias("absent"))
    loose = parts["not_exhaustive"].groupBy("image_id").agg(F.count("*").cast("int").alias("loose"))
    return parts["images"].join(absent, "image_id").join(loose, "image_id").select("image_id", "file_name", "absent", "loose")


@query("coco_annotations", f"""with {_AN} select row_number() over (order by image_id, seq) as id, image_id, category_id, x1 as x, y1 as y, x2 - x1 as w, y2 - y1 as h,
   (x2 - x1) * (y2 - y1) as area, iscrowd from an""", D)
def coco_annotations(t):
    return C.coco_annotations(annotations(t))


@query("repeated_ids", """with i as (select image_id * 10 + seq as ann_id from detections where priority = 1) select ann_id, count(*) as n from i group by 1 having count(*) > 1""", D)
def repeated_ids(t):
    return C.repeated_ids(t.detections.where("priority = 1").select((F.col("image_id") * 10 + F.col("seq")).alias("ann_id")))


@query("coco_results", "select image_id, seq, x1 as x, y2 - y1 as h, score from detections", D)
def coco_results(t):
    r = C.coco_results(t.detections.withColumn("category_id", F.col("seq")))
    return r.select("image_id", F.col("category_id").alias("seq"), F.col("bbox")[0].alias("x"), F.col("bbox")[3].alias("h"), "score")


@query("read_voc", """select cast(image_id as varchar) as image_id, label, x1 - 1 as x1, y1 - 1 as y1, x2, y2, seq % 4 = 0 as difficult
  from detections where priority = 2""", D)
def read_voc(t):
    d = t.detections.where("priority = 2")
    obj = F.format_string("<object><name>%s</name><difficult>%d</difficult><bndbox><xmin>%s</xmin><ymin>%s</ymin><xmax>%s</xmax><ymax>%s</ymax></bndbox></object>",
                          "label", F.when(F.col("seq") % 4 == 0, 1).otherwise(0), *[F.col(c).cast("string") for c in BOX])
    docs = d.groupBy("image_id").agg(F.array_join(F.collect_list(obj), "").alias("o")).select(F.concat(
        F.lit("<annotation><filename>"), F.col("image_id").cast("string"), F.lit(".jpg</filename>"), "o", F.lit("</annotation>")).alias("text"))
    return C.parse_voc(docs).drop("gt")


@query("read_yolo", """select image_id, priority * 10000 + seq as line_no, seq % 7 as class_index, round((score - 0.25) * width, 5) as x1, round((0.5 - score / 2) * height, 5) as y1
  from detections join images using (image_id) where seq % 5 <> 0""", DI)
def read_yolo(t):
    d = t.detections.withColumn("line", F.col("priority") * 10000 + F.col("seq"))
    line = F.concat_ws(" ", (F.col("seq") % 7).cast("string"), F.col("score").cast("string"), F.lit("0.5"), F.lit("0.5"),
                       F.when(F.col("seq") % 5 != 0, F.col("score").cast("string")))
    boxes = C.parse_yolo(d.select("image_id", F.col("line").alias("line_no"), line.alias("line")), t.images)
    return boxes.select("image_id", "line_no", "class_index", F.round("x1", 5).alias("x1"), F.round("y1", 5).alias("y1"))


@query("class_names", "select p_brand as name, cast(dense_rank() over (order by p_brand) - 1 as int) as class_index, count(*) as parts from part group by 1")
def class_names(t):
    names = C.numbered_names(t.part.select(F.col("p_brand").alias("name")))
    return t.part.join(names, F.col("p_brand") == F.col("name")).groupBy("name", "class_index").agg(F.count("*").alias("parts"))


@query("concat_corpora", f"with {_AN} select image_id, seq, category_id from an where image_id % 2 = 0 union all select image_id, seq, category_id from an where image_id % 2 = 1", D)
def concat_corpora(t):
    a, c = annotations(t), categories(t)
    return C.concat_corpora([(a.where("image_id % 2 = 0"), c), (a.where("image_id % 2 = 1"), c)]).select("image_id", "seq", "category_id")


@query("subset_corpus")
def subset_corpus(t):
    """A tenth of the images with all their annotations."""
    _, anns = sampling.subset_corpus(t.images, annotations(t), 0.1, seed=3)
    return anns.select("image_id", "seq", "category_id")


@query("subset_corpus_counts", f"""with {_AN}, n as (select greatest(1, cast(floor(count(*) * 0.25) as bigint)) as k, count(*) as n from images)
  select k as images, cast(0 as bigint) as incomplete from n""", DI)
def subset_corpus_counts(t):
    """A quarter of the images; each keeps either all or none of its annotations."""
    images, anns = sampling.subset_corpus(t.images, annotations(t), 0.25, seed=3)
    per = lambda df, c: df.groupBy("image_id").agg(F.count("*").alias(c))
    cut = per(annotations(t), "a").join(per(anns, "b"), "image_id").where("a <> b").agg(F.count("*").alias("incomplete"))
    return images.agg(F.count("*").alias("images")).withColumn("_k", F.lit(1)).join(cut.withColumn("_k", F.lit(1)), "_k").drop("_k")


# ---- statistics --------------------------------------------------------------------------------------

@query("class_histogram", f"""with {_AN}, c as (select distinct 'cat' || category_id as name, category_id from an),
   n as (select name, count(a.category_id) as n from c left join (select * from an where iscrowd = 0) a using (category_id) group by 1)
   select name, n as instances from n union all select null, cast(sum(n) as bigint) from n""", D)
def class_histogram(t):
    return reports.class_histogram(annotations(t), categories(t))


@query("categories_out_of_range", f"with {_AN} select category_id, count(*) as n from an where category_id in (0, 10) group by 1", D)
def categories_out_of_range(t):
    return reports.categories_out_of_range(annotations(t), categories(t).where("category_id > 10"))


@query("label_votes", """with v as (select image_id, seq as id, label, count(*) as votes from detections group by 1, 2, 3),
   w as (select image_id, id, label as winner from (select *, row_number() over (partition by image_id, id order by votes desc, label) as rn from v) where rn = 1)
   select * from v join w using (image_id, id)""", D)
def label_votes(t):
    return reports.label_votes(t.detections.select("image_id", F.col("seq").alias("id"), "label"))


@query("mask_statistics", """with m as (select image_id, cast((x2 - x1) * (y2 - y1) as bigint) as area from detections where priority = 4), s as (select * from m join images using (image_id)),
   i as (select distinct image_id, width, height, class_name from s)
   select (select count(*) from i) as pairs, count(*) as masks, count(distinct class_name) as classes, min(area) as area_min, max(area) as area_max,
     round(avg(area), 6) as area_mean, cast(median(area) as double) as area_median, min(width) as width_min, max(width) as width_max, (select round(avg(width), 6) from i) as width_mean,
     round(count(*)::double / (select count(*) from i), 6) as masks_per_image from s""", DI)
def mask_statistics(t):
    m = t.detections.where("priority = 4").select("image_id", ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).cast("long").alias("area"))
    s = reports.mask_statistics(m, t.images)
    return s.select("pairs", "masks", "classes", "area_min", "area_max", F.round("area_mean", 6).alias("area_mean"), "area_median", "width_min",
                    "width_max", F.round("width_mean", 6).alias("width_mean"), F.round("masks_per_image", 6).alias("masks_per_image"))


def runs(t):
    """Orders as processing runs: priority as worker, status as outcome."""
    return t.orders.select(F.concat(F.lit("ds"), (F.col("o_custkey") % 5).cast("string")).alias("dataset"), F.substring("o_orderpriority", 1, 1).alias("worker"),
                           F.col("o_orderkey").alias("image_id"), (F.col("o_orderstatus") != "P").alias("success"),
                           (F.col("o_orderkey") % 9 + 1).cast("double").alias("seconds"), F.col("o_orderstatus").alias("s"))


_RUNS = """r as (select 'ds' || (o_custkey % 5) as dataset, substring(o_orderpriority, 1, 1) as worker, o_orderkey as image_id, o_orderstatus <> 'P' as success,
   cast(o_orderkey % 9 + 1 as double) as seconds, o_orderstatus as s from orders)"""


@query("tally_status", f"""with {_RUNS} select dataset, count(*) filter (s = 'F') as success, count(*) filter (s = 'O') as skipped, cast(0 as bigint) as no_predictions,
   count(*) filter (s = 'P') as error from r group by 1""")
def tally_status(t):
    status = F.when(F.col("s") == "F", "success").when(F.col("s") == "O", "skipped").otherwise("error")
    return reports.tally_status(runs(t).withColumn("status", status))


@query("run_throughput", f"""with {_RUNS} select dataset, worker, count(*) as images, count(*) filter (success) as done, sum(seconds) as seconds, round(avg(1 / seconds), 8) as mean_rate,
   min(1 / seconds) as min_rate, max(1 / seconds) as max_rate, round(count(*)::double / (select count(*) from r), 8) as share,
   round(count(*) / sum(seconds), 8) as images_per_second from r group by cube (dataset, worker)""")
def run_throughput(t):
    r = reports.run_throughput(runs(t))
    return r.select("dataset", "worker", "images", "done", "seconds", F.round("mean_rate", 8).alias("mean_rate"), "min_rate", "max_rate",
                    F.round("share", 8).alias("share"), F.round("images_per_second", 8).alias("images_per_second"))


@query("first_failures", f"with {_RUNS} select dataset, image_id, worker from r where not success order by dataset, image_id limit 10")
def first_failures(t):
    return reports.first_failures(runs(t)).select("dataset", "image_id", "worker")
