"""From level-1 objects to finished annotations: phrases, labels, depth, scene, grounding."""
from __future__ import annotations

from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import text as T
from boxloom.operators import affordances, ground, merge, relate, scene, vote
from boxloom.plans.queries import sqltext as S
from boxloom.plans.queries.boxes import crowded
from boxloom.plans.registry import query

D, DI = ("detections",), ("detections", "images")
BOX = ["x1", "y1", "x2", "y2"]
csv = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")


def plain_objects(t):
    """A cheap stand-in for level-1 output: the boxes of all models, by turns as objects and floating objects."""
    d = t.detections
    return d.select("image_id", F.when(F.col("priority") % 2 == 1, "object").otherwise("floating").alias("kind"),
                    (F.col("seq") - 1 + (F.col("priority") - 1) * 1000).cast("int").alias("id"), *BOX,
                    F.when(F.col("seq") % 3 == 0, F.array("label", F.concat(F.col("label"), F.lit("s")))).otherwise(
                        F.array("label")).alias("labels"),
                    F.when(F.col("seq") % 2 == 0, F.array(F.concat(F.lit("small: "), F.col("label")))).alias("attributes"), "score")


# the same in SQL; labels and attributes as lists
OBJ = """objs as (select image_id, case priority % 2 when 1 then 'object' else 'floating' end as kind,
  cast(seq - 1 + (priority - 1) * 1000 as int) as id, x1, y1, x2, y2, label as base,
  case when seq % 3 = 0 then [label, label || 's'] else [label] end as labels,
  case when seq % 2 = 0 then ['small: ' || label] end as attributes, score from detections)"""


def phrase_boxes(t):
    """Boxes of the describing model as phrase boxes."""
    d = t.detections.where("priority = 7")
    return d.select("image_id", "seq", F.concat(F.lit("The  "), F.col("label")).alias("phrase"), F.col("label").alias("noun"), *BOX)


def related(t):
    return relate.relate(plain_objects(t), phrase_boxes(t), hot=crowded(t))


def promoted(t):
    hot = crowded(t)
    return relate.promote(*relate.relate(plain_objects(t), phrase_boxes(t), hot=hot), hot=hot)


# ---- phrases and objects --------------------------------------------------------------------

_M = f"{S.iou('o', 'p', 1)} > 0.75"
RELATE = f"""{OBJ}, ph as (select *, 'the ' || label as phrase from detections where priority = 7),
ho as (select p.image_id, p.seq, min(o.id) as object_id from ph p join objs o on o.image_id = p.image_id and o.kind = 'object' and {_M} group by 1, 2),
hf as (select p.image_id, p.seq, min(o.id) as float_id from ph p join objs o on o.image_id = p.image_id and o.kind = 'floating' and {_M} group by 1, 2),
st as (select p.*, object_id, float_id from ph p left join ho using (image_id, seq) left join hf using (image_id, seq)),
free as (select * from st where object_id is null and float_id is null),
fl as ({S.leaders('free', 'image_id', 'seq', f's := seq, {S.BOX}', f's integer, {S.BOXTYPE}', f"{S.iou('k', 'd', 1)} > 0.75")}),
fo as (select image_id, u.s as seq, u.x1 as x1, u.y1 as y1, u.x2 as x2, u.y2 as y2 from (select image_id, unnest(lead) as u from fl)),
sz as (select image_id, count(*) as n from objs group by 1),
nw as (select fo.*, cast(coalesce(n, 0) + row_number() over (partition by image_id order by seq) as int) as id from fo left join sz using (image_id)),
hn as (select p.image_id, p.seq, min(o.id) as new_id from st p join nw o on o.image_id = p.image_id and o.seq <= p.seq and {_M}
   where p.float_id is null group by 1, 2),
fin as (select st.*, coalesce(float_id, nw.id, new_id) as fid, nw.id as own from st left join hn using (image_id, seq)
   left join nw using (image_id, seq)),
links as (select image_id, seq, 0 as part, phrase, label, object_id as id, 'object' as kind, false as founds from fin where object_id is not null
  union all select image_id, seq, 1, phrase, label, fid, 'floating', own is not null from fin where fid is not null)"""


@query("relate_links", f"with {RELATE} select image_id, cast(seq as int) as seq, part, phrase, cast(id as int) as id, kind from links", D)
def relate_links(t):
    return related(t)[1]


_RELATED = RELATE + """,
gain as (select image_id, id, list(label order by seq) as extra from links where kind = 'floating' and not founds group by 1, 2),
robj as (select o.image_id, o.kind, o.id, case when g.extra is null or o.kind = 'object' then o.labels else list_concat(o.labels, g.extra) end as labels
    from objs o left join gain g using (image_id, id)
  union all select nw.image_id, 'floating', nw.id, case when g.extra is null then ['the ' || d.label] else list_concat(['the ' || d.label], g.extra) end
    from nw join detections d on d.image_id = nw.image_id and d.seq = nw.seq and d.priority = 7 left join gain g on g.image_id = nw.image_id and g.id = nw.id)"""


@query("relate_objects", f"with {_RELATED} select image_id, kind, id, len(labels) as n, array_to_string(list_sort(labels), ',') as labels from robj", D)
def relate_objects(t):
    objs = related(t)[0]
    return objs.select("image_id", "kind", "id", F.size("labels").cast("long").alias("n"), F.array_join(F.array_sort("labels"), ",").alias("labels"))


_PROMOTED = _RELATED + """,
pro as (select *, cast(row_number() over (partition by image_id order by case when kind = 'object' then 0 when len(labels) > 1 then 1 else 2 end, id) - 1 as int) as new_id,
  case when kind = 'object' or len(labels) > 1 then 'object' else 'floating' end as new_kind from robj),
plinks as (select l.image_id, l.seq, l.part, l.phrase, p.new_id as id, p.new_kind as kind from links l join pro p using (image_id, id))"""


@query("promote_objects", f"with {_PROMOTED} select image_id, id as old_id, new_id as id, new_kind as kind from pro", D)
def promote_objects(t):
    objs, _ = promoted(t)
    return objs.select("image_id", "old_id", "id", "kind")


@query("grounding", f"""with {_PROMOTED} select image_id, phrase, array_to_string(list(id order by seq, part), ',') as object_ids
  from plinks group by 1, 2""", D)
def grounding(t):
    _, links = promoted(t)
    return relate.grounding(links).select("image_id", "phrase", csv("object_ids").alias("object_ids"))


@query("relationships", f"""with {_PROMOTED}, r as (select image_id, coalesce(array_to_string(list_sort(list(distinct id) filter (kind = 'object')), ','), '') as object_ids,
    coalesce(array_to_string(list_sort(list(distinct id) filter (kind = 'floating')), ','), '') as floating_object_ids,
    count(distinct phrase) as phrases from plinks group by 1)
  select image_id, coalesce(object_ids, '') as object_ids, coalesce(floating_object_ids, '') as floating_object_ids, coalesce(phrases, 0) as phrases
  from images left join r using (image_id)""", DI)
def relationships(t):
    _, links = promoted(t)
    r = relate.relationships(t.images, links)
    return r.select("image_id", csv("object_ids").alias("object_ids"), csv("floating_object_ids").alias("floating_object_ids"),
                    F.size("grounding").cast("long").alias("phrases"))


@query("insert_attribute", f"""with {OBJ} select image_id, kind, id, case when id % 4 = 0 then 'found ' || id || coalesce('|' || attributes[1], '')
  else coalesce(attributes[1], '') end as attributes from objs""", D)
def insert_attribute(t):
    o = plain_objects(t)
    found = o.where("id % 4 = 0").select("image_id", "id", F.concat(F.lit("found "), F.col("id").cast("string")).alias("attribute"))
    return relate.insert_attribute(o, found).select("image_id", "kind", "id", F.coalesce(F.array_join("attributes", "|"), F.lit("")).alias("attributes"))


@query("promote_big_boxes", f"""with {OBJ}, tiny as (select image_id, width * 0.7 as width, height * 0.7 as height from images),
  mx as (select image_id, max((x2 - x1) * (y2 - y1)) as m from objs where kind = 'object' group by 1),
  cand as (select o.* from objs o join tiny using (image_id) left join mx using (image_id) where kind = 'floating'
    and (x2 - x1) * (y2 - y1) > 0.5 * width * height and (x2 - x1) * (y2 - y1) > coalesce(m, 0)),
  cl as (select image_id, id, score, unnest(labels) as label from cand),
  best as (select *, row_number() over (partition by image_id, label order by score desc, id) as rn from cl),
  known as (select image_id, label, max(score) as k from (select image_id, score, unnest(labels) as label from objs where kind = 'object') group by 1, 2),
  win as (select b.image_id, b.id, bool_or(k is null or b.score > k) as up from best b left join known using (image_id, label) where rn = 1 group by 1, 2)
  select image_id, id, case when kind = 'floating' and up then 'object' else kind end as kind from objs left join win using (image_id, id)
  where kind <> 'floating' or up is null or up""", DI)
def promote_big_boxes(t):
    small = t.images.select("image_id", (F.col("width") * 0.7).alias("width"), (F.col("height") * 0.7).alias("height"))
    return relate.promote_big_boxes(plain_objects(t), small).select("image_id", "id", "kind")


@query("attach_captions", """select image_id, '' as first, coalesce(c.caption, '') as second from images left join captions c using (image_id)""",
       ("images", "captions"))
def attach_captions(t):
    return relate.attach_captions(t.images, t.captions).select("image_id", F.col("captions")[0].alias("first"), F.col("captions")[1].alias("second"))


# ---- joins -----------------------------------------------------------------------------------

@query("merge_models", """select image_id, count(*) as boxes, count(distinct model) as models, min(model) as first from detections group by 1""", D)
def merge_models(t):
    d = t.detections
    names = ["eva-02-01", "co_detr", "eva-02-02", "ov_sam", "owl_vit", "pomp", "grit"]
    long = merge.merge_models({m: d.where(F.col("model") == m).drop("model") for m in names})
    return long.groupBy("image_id").agg(F.count("*").alias("boxes"), F.count_distinct("model").alias("models"), F.min("model").alias("first"))


@query("nested_predictions", """select image_id, string_agg(model || '=' || n, ',' order by model) as counts from
  (select image_id, model, count(*) as n from detections group by 1, 2) group by 1""", D)
def nested_predictions(t):
    p = merge.nested_predictions(t.detections)
    counts = F.transform(F.map_entries("predictions"), lambda e: F.concat(e["key"], F.lit("="), F.size(e["value"]).cast("string")))
    return p.select("image_id", F.array_join(F.array_sort(counts), ",").alias("counts"))


@query("merge_captions", """with p as (select image_id, count(*) as phrases from detections where priority = 7 group by 1)
  select image_id, c.caption as llava, cast(null as varchar) as blip2, coalesce(phrases, 0) as phrases from captions c full join p using (image_id)""",
       ("detections", "captions"))
def merge_captions(t):
    return merge.merge_captions(t.captions, phrase_boxes(t))


@query("tag_vocabulary", """select image_id, array_to_string(list_concat(case when a.t is null then [] else [a.t] end,
    case when b.t is null or b.t = a.t then [] else [b.t] end, ['trees']), ',') as vocabulary from images
  left join (select doc_id as image_id, lang as t from documents) a using (image_id)
  left join (select doc_id as image_id, case when n_chars % 2 = 0 then lang else source end as t from documents where doc_id % 3 = 0) b using (image_id)""",
       ("images",))
def tag_vocabulary(t):
    docs = t.documents.withColumnRenamed("doc_id", "image_id")
    a = docs.where("lang is not null").select("image_id", F.array("lang").alias("tags"))
    b = docs.where("image_id % 3 = 0").select("image_id", F.when(F.col("n_chars") % 2 == 0, F.col("lang")).otherwise(F.col("source")).alias("t")).where(
        "t is not null").select("image_id", F.array("t").alias("tags"))
    return merge.tag_vocabulary(t.images, a, b).select("image_id", F.array_join("vocabulary", ",").alias("vocabulary"))


_WORDS = ", ".join(f"('{k}', '{v}')" for k, v in T.PERSON_WORDS.items())


@query("choose_labels", f"""with {OBJ}, w(word, general) as (values {_WORDS}),
  raw as (select image_id, id, kind, case when kind = 'object' then case when id % 5 = 0 then 'Woman' when id % 7 = 0 then 'kids' else labels[1] end end as l from objs)
  select image_id, id, coalesce(general, l) as label from raw left join w on lower(l) = word""", D)
def choose_labels(t):
    o = plain_objects(t)
    given = o.where("id % 5 = 0 or id % 7 = 0").select("image_id", "id", F.when(F.col("id") % 5 == 0, "Woman").otherwise("kids").alias("label"))
    return merge.choose_labels(o, given).select("image_id", "id", "label")


@query("normalise_person", """select image_id, id, case when lower(w) in ('man', 'woman', 'men', 'women') then 'person' else w end as label from
  (select image_id, seq as id, case when seq % 4 = 0 then 'Man' when seq % 5 = 0 then 'women' else label end as w from detections where priority = 1)""", D)
def normalise_person(t):
    w = F.when(F.col("seq") % 4 == 0, "Man").when(F.col("seq") % 5 == 0, "women").otherwise(F.col("label"))
    return t.detections.where("priority = 1").select("image_id", F.col("seq").alias("id"), T.normalise_person(w).alias("label"))


@query("describe_classes", """select image_id, class_name, case when class_name in ('SMALL', 'LARGE') then null else d.about end as additional_context
  from images left join (select p_type as class_name, 'about ' || lower(p_type) || ' ' || count(*) as about from part group by p_type) d using (class_name)""",
       ("images",))
def describe_classes(t):
    about = t.part.groupBy(F.col("p_type").alias("class_name")).agg(F.count("*").alias("n")).select(
        "class_name", F.concat(F.lit("about "), F.lower("class_name"), F.lit(" "), F.col("n").cast("string")).alias("description"))
    about = about.where(~F.col("class_name").isin("SMALL", "LARGE"))
    return merge.describe_classes(t.images, about).select("image_id", "class_name", "additional_context")


@query("undescribed_classes", "select class_name, count(*) as images from images where class_name not in ('ECONOMY', 'PROMO') group by 1", ("images",))
def undescribed_classes(t):
    some = t.part.where("p_type in ('ECONOMY', 'PROMO')").select(F.col("p_type").alias("class_name"), F.col("p_type").alias("description")).distinct()
    return merge.undescribed_classes(t.images, some)


@query("join_proposals", """select image_id, priority, seq, row_number() over (partition by image_id order by score desc, priority, seq) as rank
  from detections where image_id in (select image_id from images where width > 80)""", DI)
def join_proposals(t):
    return merge.join_proposals(t.images.where("width > 80"), t.detections).select("image_id", "priority", "seq", "rank")


@query("merge_panoptic", """select file_name, coalesce(case when image_id % 2 = 0 then height + 1 end, height) as height, width, image_id
  from images where image_id % 3 <> 0""", ("images",))
def merge_panoptic(t):
    left = t.images.select("file_name", "height", "image_id")
    right = t.images.where("image_id % 3 <> 0").select("file_name", "width", F.when(F.col("image_id") % 2 == 0, F.col("height") + 1).alias("height"))
    return merge.merge_panoptic(left, right)


@query("grounded_ids", """select distinct image_id, id from (select image_id, seq as id from detections where priority = 1 union all
  select image_id, priority from detections where priority > 4)""", D)
def grounded_ids(t):
    d = t.detections
    return merge.grounded_ids(d.where("priority = 1").select("image_id", F.col("seq").alias("id")),
                              d.where("priority > 4").select("image_id", F.array("priority").alias("object_ids")))


# ---- affordances --------------------------------------------------------------------------------

_NAMES = ["cup", "bowl", "stool", "violin", "suitcase", "umbrella"]
_AFF = ", ".join(f"('{lab}', '{c}')" for c, _, labs in affordances.CATEGORIES for lab in labs)


@query("affordances", f"""with {OBJ}, a(label, category) as (values {_AFF}), n as (select image_id, id, list_extract({_NAMES}, cast(id % 7 + 1 as int)) as label from objs)
  select image_id, category, array_to_string(list_sort(list(distinct id)), ',') as object_ids, array_to_string(list_sort(list(distinct label)), ',') as labels
  from n join a using (label) group by 1, 2""", D)
def affordances_query(t):
    names = F.array(*[F.lit(n) for n in _NAMES])
    o = plain_objects(t).withColumn("labels", F.array(F.coalesce(F.get(names, F.col("id") % 7), F.lit("none"))))
    found = affordances.affordances(o, affordances.dictionary(t.spark))
    return found.select("image_id", "category", csv("object_ids").alias("object_ids"), F.array_join("labels", ",").alias("labels"))


# ---- depth and scene ------------------------------------------------------------------------------

_DEPTH = f"""{OBJ}, sz as (select image_id, max(x) + 1 as w, max(y) + 1 as h from depth group by 1),
  cut as (select image_id, id, kind, greatest(0, cast(trunc(x1) as int)) as a, greatest(0, cast(trunc(y1) as int)) as b,
    least(w, cast(trunc(x2) as int)) as c, least(h, cast(trunc(y2) as int)) as d from objs join sz using (image_id)),
  med as (select image_id, id, cast(round(cast(median(value) as decimal(18, 6)), 2) as double) as depth from cut join depth using (image_id)
    where value <> 0 and x >= a and x < c and y >= b and y < d group by 1, 2)"""


@query("median_depth", f"with {_DEPTH} select image_id, id, depth from objs left join med using (image_id, id)", ("detections", "depth"))
def median_depth(t):
    return merge.median_depth(plain_objects(t).select("image_id", "id", *BOX), t.depth, hot=crowded(t)).select("image_id", "id", "depth")


@query("add_depth", f"""with {_DEPTH}
  select image_id, id, kind, case when kind = 'object' or image_id not in (select image_id from objs where kind = 'object') then depth end as depth
  from objs left join med using (image_id, id)""", ("detections", "depth"))
def add_depth(t):
    return merge.add_depth(plain_objects(t), t.depth, hot=crowded(t)).select("image_id", "id", "kind", "depth")


def deep_objects(t):
    """Objects with a depth made from their score, so that every image has a scene."""
    return plain_objects(t).withColumn("depth", F.when(F.col("id") % 6 != 0, F.col("score") * 10 + F.col("id") % 5))


DEEP = f"""{OBJ}, dob as (select *, case when id % 6 <> 0 then score * 10 + id % 5 end as depth from objs)"""
LAYER = DEEP + """, sobj as (select * from dob where kind = 'object' or image_id not in (select image_id from dob where kind = 'object')),
  rng as (select image_id, min(depth) as lo, max(depth) as hi from sobj group by 1),
  near as (select sobj.*, case when hi = lo then 0.5 else 1 - (depth - lo) / (hi - lo) end as nearness from sobj join rng using (image_id) where depth is not null),
  lay as (select *, case when nearness < 0.1 then 0 when nearness < 0.6 then 1 when nearness < 0.85 then 2 else 3 end as layer from near)"""
_NEAR = "sqrt(((k.x1 + k.x2) / 2 - (d.x1 + d.x2) / 2) ** 2 + ((k.y1 + k.y2) / 2 - (d.y1 + d.y2) / 2) ** 2) < 10"
GROUPED = f"""{LAYER}, pl as ({S.leaders('lay', 'image_id, layer', 'id', f'i := id, {S.BOX}', f'i integer, {S.BOXTYPE}', _NEAR)}),
  mem as (select image_id, layer, d.i as id, coalesce(list_filter(lead, lambda k: k.i < d.i and {_NEAR})[1].i, d.i) as head_id
    from (select image_id, layer, lead, unnest(m) as d from pl)),
  hd as (select image_id, layer, head_id, cast(row_number() over (partition by image_id order by layer, head_id) - 1 as int) as group_id
    from (select distinct image_id, layer, head_id from mem)),
  grp as (select mem.*, group_id from mem join hd using (image_id, layer, head_id))"""


def layered(t, hot=None):
    return scene.depth_layers(scene.scene_objects(deep_objects(t), 100, hot), hot)


def grouped(t):
    hot = crowded(t)
    return scene.proximity_groups(layered(t, hot), 10.0, hot=hot)


@query("sample_objects", f"""with {OBJ}, n as (select image_id, count(*) as n from objs group by 1),
  r as (select *, row_number() over (partition by image_id order by case when attributes is null then 1 else 0 end, id) as rn from objs)
  select image_id, id from r join n using (image_id) where n <= 6 or rn <= 6 or attributes is not null""", D)
def sample_objects(t):
    return scene.sample_objects(plain_objects(t), 6, crowded(t)).select("image_id", "id")


@query("depth_layers", f"with {LAYER} select image_id, id, layer, round(nearness, 6) as nearness from lay", D)
def depth_layers(t):
    return layered(t, crowded(t)).select("image_id", "id", "layer", F.round("nearness", 6).alias("nearness"))


@query("proximity_groups", f"with {GROUPED} select image_id, id, layer, head_id, group_id from grp", D)
def proximity_groups(t):
    return grouped(t).select("image_id", "id", "layer", "head_id", "group_id")


def phrase_grounding(t):
    """Relationship phrases over the plain objects, one per label, by the ids they name."""
    o = plain_objects(t)
    return o.groupBy("image_id", F.element_at("labels", 1).alias("phrase")).agg(
        F.struct(F.min("id").alias("seq"), F.lit(0).alias("part")).alias("pos"), F.array_sort(F.collect_list("id")).alias("object_ids")
    ).withColumn("part", F.lit(0))


_GR = "gr as (select image_id, labels[1] as phrase, min(id) as pos, list(id order by id) as object_ids from objs group by 1, 2)"


@query("relationship_groups", f"""with {GROUPED}, {_GR}, f as (select image_id, phrase, unnest(object_ids) as id from gr)
  select image_id, phrase, string_agg(coalesce(group_id, -1), ',' order by id) as group_ids from f left join grp using (image_id, id) group by 1, 2""", D)
def relationship_groups(t):
    g = grouped(t)
    return scene.relationship_groups(phrase_grounding(t), g, crowded(t)).select("image_id", "phrase", csv("group_ids").alias("group_ids"))


@query("scene_text", f"""with {GROUPED}, {_GR}, f as (select image_id, phrase, pos, unnest(object_ids) as id from gr),
  rl as (select image_id, pos, phrase, coalesce(string_agg(group_id, ', ' order by id) filter (group_id is not null), '') as g
    from f left join grp using (image_id, id) group by 1, 2, 3),
  rels as (select image_id, string_agg(phrase || ', Group Ids: (' || g || ')' || chr(10), '' order by pos) as rels from rl group by 1),
  it as (select image_id, layer, group_id, string_agg(labels[1] || case when attributes is null then '' else '/' || trim(split_part(attributes[1], ':', 2)) end,
     ', ' order by case when id = head_id then 0 else 1 end, id) as t from grp join objs using (image_id, id) group by 1, 2, 3),
  ly as (select image_id, layer, string_agg('Group ' || group_id || ': ' || t || chr(10), '' order by group_id) as t from it group by 1, 2),
  gph as (select image_id, string_agg(['Immediate Foreground', 'Foreground', 'Midground', 'Background'][layer + 1] || ':' || chr(10) || t, '' order by layer) as graph
    from ly group by 1)
  select image_id, case when graph is null then 'No valid objects found in the scene.' || chr(10) || chr(10) || 'Short Captions:' || chr(10) || chr(10) || dataset || chr(10)
      || chr(10) || 'Landmarks:' || chr(10) || 'Outdoor scene, ' || class_name || chr(10)
    else replace(graph || chr(10) || 'Short Captions:' || chr(10) || chr(10) || dataset || chr(10) || chr(10) || 'Relationships:' || chr(10) || coalesce(rels, '')
      || chr(10) || 'Landmarks:' || chr(10) || 'Outdoor scene, ' || class_name || chr(10), '_', ' ') end as scene_text
  from images left join gph using (image_id) left join rels using (image_id)""", DI)
def scene_text(t):
    # stored, as the groups and the phrases both need them
    g = scale.checkpointed(grouped(t).select("image_id", "id", "layer", "layer_name", "head_id", "group_id", "labels", "attributes"))
    r = scene.relationship_groups(phrase_grounding(t), g, crowded(t))
    return scene.scene_text(with_landmark(t), g, r)


def with_landmark(t):
    return t.images.select("image_id", "dataset", F.array(F.lit(""), "dataset").alias("captions"),
                           F.struct(F.lit("Outdoor scene").alias("category"), F.col("class_name").alias("fine_category")).alias("landmark"))


@query("scene_struct", f"""with {DEEP}, {_GR}, oo as (select image_id, count(*) as n, string_agg('obj_' || id, ',' order by id) as names from dob where kind = 'object' group by 1),
  rr as (select image_id, count(distinct phrase) as r from (select image_id, phrase, unnest(object_ids) as id from gr) join dob using (image_id, id) where kind = 'object' group by 1)
  select image_id, coalesce(n, 0) as objects, coalesce(names, '') as names, coalesce(r, 0) as relationships from images left join oo using (image_id) left join rr using (image_id)""", DI)
def scene_struct(t):
    s = scene.scene_struct(with_landmark(t), deep_objects(t), phrase_grounding(t))
    names = F.transform("objects_and_attributes", lambda j: F.get_json_object(j, "$.object"))
    return s.select("image_id", F.size("objects_and_attributes").cast("long").alias("objects"), F.array_join(names, ",").alias("names"),
                    F.size("relationships").cast("long").alias("relationships"))


@query("object_list_text", f"""with {OBJ}, so as (select * from objs where kind = 'object' or image_id not in (select image_id from objs where kind = 'object')),
  n as (select image_id, count(*) as n from so group by 1),
  r as (select *, row_number() over (partition by image_id order by case when attributes is null then 1 else 0 end, id) as rn from so),
  kept as (select * from r join n using (image_id) where n <= 4 or rn <= 4 or attributes is not null),
  tx as (select image_id, string_agg(labels[1] || case when attributes is null then '' else '/' || trim(split_part(attributes[1], ':', 2)) end || chr(10), ''
    order by case when n > 4 and attributes is null then 1 else 0 end, id) as t from kept group by 1)
  select image_id, replace('Objects:' || chr(10) || coalesce(t, '') || chr(10) || 'Landmarks:' || chr(10) || 'Outdoor scene, ' || class_name || chr(10), '_', ' ') as context_text
  from images left join tx using (image_id)""", DI)
def object_list_text(t):
    return scene.object_list_text(with_landmark(t), plain_objects(t), 4, crowded(t))


# ---- grounding ---------------------------------------------------------------------------------------

def spoken_captions(t):
    """Two captions per image that mention some of its labels (made from the tables)."""
    o = plain_objects(t).where("kind = 'object'")
    said = o.groupBy("image_id").agg(F.min(F.element_at("labels", 1)).alias("a"), F.max(F.element_at("labels", 1)).alias("b"))
    caps = F.array(F.concat(F.lit(" A "), "a", F.lit(" near a "), "b", F.lit(" ")), F.concat(F.lit("Only "), "b"))
    return said.select("image_id", F.posexplode(caps).alias("caption_pos", "caption"))


_CAPS = """sd as (select image_id, min(labels[1]) as a, max(labels[1]) as b from objs where kind = 'object' group by 1),
  caps as (select image_id, 0 as caption_pos, 'A ' || a || ' near a ' || b as caption from sd union all select image_id, 1, 'Only ' || b from sd)"""


@query("ground_short", f"""with {OBJ}, {_GR}, {_CAPS} select c.image_id, caption_pos, phrase, instr(caption, phrase) - 1 as start,
    instr(caption, phrase) - 1 + length(phrase) as "end", list_min(object_ids) as id, o.x1, o.y2
  from caps c join gr using (image_id) left join objs o on o.image_id = c.image_id and o.id = object_ids[1] where contains(caption, phrase)""", D)
def ground_short(t):
    g = ground.ground_short(spoken_captions(t), phrase_grounding(t), plain_objects(t))
    return g.select("image_id", "caption_pos", "phrase", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "id", "x1", "y2")


def said_labels(t):
    """The two labels of an image that its captions speak of."""
    return plain_objects(t).groupBy("image_id").agg(F.min(F.element_at("labels", 1)).alias("a"), F.max(F.element_at("labels", 1)).alias("b"))


def dense_captions_of(t, said=None):
    """One long caption per image with exact, similar and noun mentions."""
    said = said_labels(t) if said is None else said
    return said.select("image_id", F.concat(F.lit("There is a Class_1 near the old "), "a", F.lit(", and some bright "), "b",
                                            F.lit("s with a big person. The wet class_3 is old.")).alias("caption"))


_DENSE = f"""{OBJ}, {_GR}, sd as (select image_id, min(labels[1]) as a, max(labels[1]) as b from objs group by 1),
  cap as (select image_id, lower('There is a Class_1 near the old ' || a || ', and some bright ' || b || 's with a big person. The wet class_3 is old.') as c from sd),
  st as (select o.image_id, id, trim(split_part(attributes[1], ':', 2)) as phrase from objs o join cap using (image_id)
    where attributes is not null and contains(c, trim(split_part(attributes[1], ':', 2)))),
  ex as (select image_id, 1 as step, id as a, phrase, cast(id as varchar) as object_ids from st union all
    select gr.image_id, 2, pos, phrase, array_to_string(object_ids, ',') from gr join cap using (image_id) where contains(c, phrase)
      and (gr.image_id, phrase) not in (select image_id, phrase from st))"""


@query("ground_dense_exact", f"with {_DENSE} select image_id, step, phrase, object_ids from ex", D)
def ground_dense_exact(t):
    e = ground.dense_exact(dense_captions_of(t), plain_objects(t), phrase_grounding(t))
    return e.select("image_id", "step", "phrase", csv("object_ids").alias("object_ids"))


_FUZZY = f"""{_DENSE}, ph as (select image_id, cast(p as int) as pos, case p when 0 then 'bright old ' || a when 1 then 'small ' || b || ' one' when 2 then 'person here' else 'wet class_3' end as phrase
    from sd, (select unnest([0, 1, 2, 3]) as p)),
  known as (select image_id, id, max(text) as text, min(rk) as rk from (
     select o.image_id, o.id, coalesce(g.phrase, trim(split_part(attributes[1], ':', 2))) as text, case when attributes is not null then o.id else 1000000 + g.pos end as rk
     from objs o left join (select image_id, object_ids[1] as id, phrase, pos from gr where (image_id, phrase) not in (select image_id, phrase from ph)) g using (image_id, id)
     where attributes is not null or g.phrase is not null) group by 1, 2),
  ask as (select * from ph where (image_id, phrase) not in (select image_id, phrase from ex)),
  sc as (select ask.image_id, pos, phrase, known.id, rk, text, case when length(phrase) < length(text) then phrase else text end as sh, case when length(phrase) < length(text) then text else phrase end as lo
     from ask join known using (image_id)),
  wd as (select *, list_transform(list_filter(regexp_extract_all(lower(sh), '[a-z0-9_]+'), lambda w: not list_contains({list(T.STOPWORDS)}, w)),
     lambda w: case when length(w) > 3 and ends_with(w, 's') and not ends_with(w, 'ss') then left(w, length(w) - 1) else w end) as w from sc),
  sm as (select *, case when contains(phrase, text) or contains(text, phrase) then 1.0::double when len(w) = 0 then 0.0::double
     else len(list_filter(w, lambda x: contains(lo, x)))::double / len(w) end as s from wd)"""


@query("ground_dense_fuzzy", f"""with {_FUZZY} select image_id, phrase, id from (select *, row_number() over (partition by image_id, phrase order by s desc, rk) as rn from sm where s >= 0.75) where rn = 1""", D)
def ground_dense_fuzzy(t):
    o, g, said = plain_objects(t), scale.checkpointed(phrase_grounding(t)), scale.checkpointed(said_labels(t))
    asked = F.array(F.concat(F.lit("bright old "), "a"), F.concat(F.lit("small "), "b", F.lit(" one")), F.lit("person here"), F.lit("wet class_3"))
    phrases = said.select("image_id", F.posexplode(asked).alias("pos", "phrase")).withColumn("noun", F.lit(""))
    found = ground.dense_fuzzy(phrases, o, g, ground.dense_exact(dense_captions_of(t, said), o, g), crowded(t))
    return found.select("image_id", "phrase", F.col("object_ids")[0].alias("id"))


@query("ground_dense")
def ground_dense(t):
    g = ground.ground_dense(dense_captions_of(t), plain_objects(t), phrase_grounding(t))
    return g.select("image_id", "step", "phrase", "start", "end", csv("object_ids").alias("object_ids"))


@query("ground_dense_noun", f"""with {OBJ}, ph(pos, noun, phrase) as (values (0, 'class_1', 'old class_1'), (1, 'persons', 'many persons'), (2, 'class_4', 'wet class_4')),
  nm as (select distinct image_id, id, x1, y1, x2, y2, unnest(labels) as label from objs where kind = 'object'),
  im as (select distinct image_id from objs), ht as (select distinct im.image_id, noun, phrase, nm.id, x1, y1, x2, y2 from im, ph join nm on true
    where nm.image_id = im.image_id and (label = noun or label = noun || 's' or label || 's' = noun)),
  ag as (select image_id, noun, phrase, count(*) as n, min(id) as lo, max(id) as hi from ht group by 1, 2, 3),
  bx as (select ag.*, a.x1 >= b.x1 and a.y1 >= b.y1 and a.x2 <= b.x2 and a.y2 <= b.y2 as lo_in, b.x1 >= a.x1 and b.y1 >= a.y1 and b.x2 <= a.x2 and b.y2 <= a.y2 as hi_in
    from ag join objs a on a.image_id = ag.image_id and a.id = lo join objs b on b.image_id = ag.image_id and b.id = hi)
  select image_id, phrase, case when n = 1 then lo when lo_in then hi else lo end as id from bx where n = 1 or (n = 2 and (lo_in or hi_in))""", D)
def ground_dense_noun(t):
    o = plain_objects(t)
    asked = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("noun"), F.lit(p).alias("phrase")) for i, (n, p) in enumerate(
        [("class_1", "old class_1"), ("persons", "many persons"), ("class_4", "wet class_4")])])
    phrases = o.select("image_id").distinct().select("image_id", F.explode(asked).alias("p")).select("image_id", "p.*")
    none = o.select("image_id", F.lit("").alias("phrase")).limit(0)
    return ground.dense_noun(phrases, o, none).select("image_id", "phrase", F.col("object_ids")[0].alias("id"))


@query("filter_groundings", f"""with g as (select image_id, label || case when priority > 3 then ' ' || model else '' end as phrase,
     cast(seq % 2 as varchar) as k, priority as step, seq as a from detections),
  f as (select image_id, phrase, arg_min(k, (step, a, k)) as k, min(step * 100000 + a) as pos from g group by 1, 2),
  l as ({S.leaders('f', 'image_id', 'length(phrase) desc, pos', 'phrase := phrase, k := k', 'phrase varchar, k varchar', 'k.k = d.k and contains(k.phrase, d.phrase)')})
  select image_id, u.phrase as phrase, u.k as object_ids from (select image_id, unnest(lead) as u from l)""", D)
def filter_groundings(t):
    d = t.detections
    phrase = F.concat("label", F.when(F.col("priority") > 3, F.concat(F.lit(" "), "model")).otherwise(""))
    found = d.select("image_id", F.col("priority").alias("step"), F.struct(F.col("seq").alias("a"), F.lit(0).alias("b")).alias("pos"),
                     phrase.alias("phrase"), F.array(F.col("seq") % 2).alias("object_ids"))
    return ground.filter_groundings(found, crowded(t)).select("image_id", "phrase", csv("object_ids").alias("object_ids"))


# ---- the whole chain -------------------------------------------------------------------------------------

@query("build_annotations")
def build_annotations(t):
    """Finished annotation documents of all images, summed up per document."""
    from boxloom.plans import annotate

    d = t.detections
    first = annotate.level1(d.where("model <> 'grit'"))
    phrases = phrase_boxes(t)
    second = annotate.level2(first, t.images, phrases, depth=t.depth)
    landmarks = with_landmark(t).select("image_id", "landmark")
    masks = {"SAM": d.where("priority = 4").select("image_id", "seq", *BOX, F.col("seq").alias("segmentation")),
             "EVA": d.where("priority = 1").select("image_id", "seq", *BOX, F.col("seq").alias("segmentation"))}
    # the scene texts stand in for the dense captions a model would write from them, which are a stored table
    dense = scale.checkpointed(annotate.scene_texts(second, t.images, t.captions, landmarks).withColumnRenamed("scene_text", "caption"))
    about = t.part.select(F.col("p_type").alias("class_name"), F.concat(F.lit("about "), "p_type").alias("description")).distinct()
    docs = annotate.finish(first, second, t.images, t.captions, landmarks, dense, masks, about)
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    return docs.select("image_id", "part", n("objects").alias("objects"), n("floating_objects").alias("floating"), n("short_captions").alias("captions"),
                       n("dense_caption.details").alias("grounded"), n("relationships.grounding").alias("phrases"), "additional_context")
