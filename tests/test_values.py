"""Known values: boxes, masks, phrases, grounding, scene text."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import boxes as B
from boxloom.functions import text as T
from boxloom.operators import ground, masks, scene
from boxloom.operators.models import with_scorer


def one(spark, **cols):
    return spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first()


def lit_box(*v):
    return B.Box(*[F.lit(float(x)) for x in v])


def test_pairwise_values(spark):
    whole = lit_box(0, 0, 1, 1)
    others = [(0, 0, 1, 1), (0, 0, .5, 1), (0, 0, 1, .5), (0, 0, .5, .5), (.5, .5, 1, 1), (.5, .5, 1.5, 1.5)]
    r = one(spark, iou=F.array(*[B.iou(whole, lit_box(*o)) for o in others]), ioa=F.array(*[B.ioa(whole, lit_box(*o)) for o in others]))
    assert r.iou == pytest.approx([1, .5, .5, .25, .25, .25 / 1.75]) and r.ioa == pytest.approx([1, 1, 1, 1, 1, .25])


def test_empty_boxes(spark):
    e = lit_box(5, 5, 5, 5)
    r = one(spark, plain=B.iou(e, e), floor=B.iou(e, e, floor=1e-5), incl=B.iou(e, e, inclusive=True), over=B.iou_at_least(e, e, 0.1))
    assert (r.plain, r.floor, r.incl, r.over) == (0.0, 0.0, 1.0, False)


def test_rotated(spark):
    b = B.from_rotated(F.lit(50.0), F.lit(30.0), F.lit(20.0), F.lit(10.0), F.lit(90.0))
    r = one(spark, v=F.array(b.x1, b.y1, b.x2, b.y2))
    assert r.v == pytest.approx([45, 20, 55, 40])


def test_dice_follows_iou():
    assert B.dice_implied(0.65, 0.75) and not B.dice_implied(0.5, 0.75)


def donut():
    y, x = np.mgrid[:100, :100]
    d = np.hypot(x - 50, y - 50)
    return (d > 10) & (d < 20)


def test_donut(spark):
    m = donut()
    ys, xs = np.nonzero(m)
    px = spark.createDataFrame([(1, 100, 100, int(x), int(y)) for x, y in zip(xs, ys)], "id int, h int, w int, x int, y int")
    for row_major, flat in ((False, m.T.ravel()), (True, m.ravel())):
        change = np.flatnonzero(np.diff(flat.astype(int))) + 1
        want = np.diff(np.r_[0, change, flat.size]).tolist()
        assert masks.encode(px.union(px), ["id"], row_major).first().segmentation.counts == want
    enc = masks.encode(px, ["id"])
    assert enc.select(masks.rle_area("segmentation.counts")).first()[0] == int(m.sum())
    assert masks.pixels(masks.runs(enc, ["id"])).select("x", "y").exceptAll(px.select(F.col("x").cast("long"), F.col("y").cast("long"))).isEmpty()
    assert tuple(masks.mask_boxes(enc, ["id"]).first()) == (1, xs.min(), ys.min(), xs.max(), ys.max())


def test_mask_edges(spark):
    s = "id int, segmentation struct<h:int,w:int,counts:array<bigint>>"
    df = spark.createDataFrame([(1, (4, 3, [0, 5, 7])), (2, (4, 3, [12])), (3, (4, 3, [3, 2, 7]))], s)
    assert {tuple(r) for r in masks.mask_boxes(df, ["id"]).collect()} == {(1, 0, 0, 1, 3), (2, 0, 0, 0, 0), (3, 0, 0, 1, 3)}
    px = masks.pixels(masks.runs(df, ["id"]))
    again = {r.id: r.segmentation.counts for r in masks.encode(px, ["id"]).collect()}
    assert again == {1: [0, 5, 7], 3: [3, 2, 7]}
    o = masks.mask_overlap(spark.createDataFrame([(1, 3)], "id_a int, id_b int"), df, ["id"], block=2).first()
    assert o.iou == pytest.approx(2 / 5) and o.dice == pytest.approx(4 / 7)


def test_runs_of_long_masks(spark):
    """Runs start where the counts before them add up to, over many slices; zero counts make no run."""
    import random

    r = random.Random(8)
    data = [(k, (1, 10**9, [r.choice([0, 1, 2, 7, 10**6]) for _ in range(n)])) for k, n in enumerate((0, 1, 2, 63, 64, 65, 128, 129, 1000))]
    df = spark.createDataFrame(data, "id int, segmentation struct<h:int,w:int,counts:array<bigint>>")
    want = {(k, sum(c[:i]), c[i]) for k, (_, _, c) in data for i in range(1, len(c), 2) if c[i]}
    got = masks.runs(df, ["id"])
    assert {(x.id, x.start, x.length) for x in got.collect()} == want
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_phrases(spark):
    vocab = F.array(*[F.lit(w) for w in ("green", "house")])
    r = one(spark, glued=T.join_split_words(F.lit("gre en ho use roof"), vocab), norm=T.normalise_phrase(F.lit("  The  RED\tCar ")),
            cut=T.strip_prefix(F.lit("a: b: C ")), low=T.strip_prefix(F.lit("a: b: C "), lower=True), plain=T.strip_prefix(F.lit(" No Colon "), lower=True),
            span=T.find_span(F.lit("Red car "), F.lit("  a red CAR here")), none=T.find_span(F.lit("x"), F.lit("abc")),
            plural=F.array(T.plural_match(F.lit("cats"), F.lit("cat")), T.plural_match(F.lit("cat"), F.lit("cats")), T.plural_match(F.lit("cat"), F.lit("cat"))),
            run=F.array(T.contains_run(F.array(F.lit("a"), F.lit("bc"), F.lit("d")), F.array(F.lit("bc"), F.lit("d"))),
                        T.contains_run(F.array(F.lit("a"), F.lit("bc")), F.array(F.lit("b")))),
            person=T.person_word(F.lit("Ladies")), punct=T.strip_punctuation(F.lit("it's: a, b. (c)!")))
    assert r.glued == "green house roof" and r.norm == "the red car" and (r.cut, r.low, r.plain) == ("b  C", "b  c", " No Colon ")
    assert r.span == [2, 9] and r.none is None and r.plural == [True, True, False] and r.run == [True, False]
    assert r.person == "persons" and r.punct == "its a, b. c"


def test_unicode(spark):
    r = one(spark, v=T.clean_unicode(F.lit("ﬁne ① a\\\\b")), p=T.clean_unicode(F.lit("a\\\\b")))
    assert r.v == "fine 1 a\\b" and r.p == "a\\b"


def test_best_phrase(spark):
    c = F.lit("a red car, and more")
    arr = lambda *w: F.array(*[F.lit(x) for x in w])
    r = one(spark, same=T.best_phrase(arr("x", "x"), c), found=T.best_phrase(arr("blue car", "red car"), c), like=T.best_phrase(arr("zzz", "a red cat, and mor"), c))
    assert (r.same, r.found, r.like) == ("x", "red car", "a red cat, and mor")


def test_similarity(spark):
    s = lambda a, b: T.phrase_similarity(F.lit(a), F.lit(b))
    r = one(spark, a=s("red car", "a red car here"), b=s("the old cars", "an old house by car"), c=s("old tree", "new big house"), d=s("the of", "a bird in a nest"))
    assert (r.a, r.b, r.c, r.d) == (1.0, 1.0, 0.0, 0.0)


def test_candidate_phrases(spark):
    text = "The old red car is in a big field, with a dog. Old red car and the red car; a big field."
    r = one(spark, p=T.candidate_phrases(F.lit(text)), n=T.single_nouns(F.lit(text)))
    assert [(x.noun, x.phrase) for x in r.p] == [("car", "old red car"), ("field", "big field")] and r.n == ["dog"]


def test_responses(spark):
    rows = [("TAGS: ['Corn Field', \"leaf\", leaf, s!oil]\nCAPTION: \"A field of corn. It is green.\"",), ("Tags : [a, b, c]\nno mark here",), ("nothing",),
            ("CAPTION: first line\nTAGS: [x, y, z]",), ("[a, b] CAPTION: after list\nmore",)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "response string").select(T.parse_tags(F.col("response")), T.parse_caption(F.col("response"))).collect()]
    assert got[0] == (["corn_field", "leaf", "soil"], "A field of corn. It is green.")
    assert got[1] == (["a", "b", "c"], "no mark here") and got[2] == ([], "")
    assert got[3] == (["x", "y", "z"], "first line") and got[4] == (["a", "b"], "after list\nmore")
    rows = [("CAPTION: foo [a,b,c]",), ("CAPTION: only words",), ("TAGS: [a, b, c] blah\nCAPTION: foo bar",)]
    got = [r[0] for r in spark.createDataFrame(rows, "response string").select(T.parse_caption(F.col("response"))).collect()]
    assert got == ["", "", "blah\nCAPTION: foo bar"]


OBJ = "image_id long, kind string, id int, x1 double, y1 double, x2 double, y2 double, labels array<string>, attributes array<string>, depth double"
GR = "image_id long, pos struct<seq:int,part:int>, phrase string, object_ids array<int>, part int"


def test_dense_grounding_steps(spark):
    objs = spark.createDataFrame([
        (0, "object", 0, 0.0, 0.0, 9.0, 9.0, ["car"], ["description: Shiny Red Car"], 1.0),
        (0, "object", 1, 0.0, 0.0, 5.0, 5.0, ["tree"], None, 1.0), (0, "object", 2, 1.0, 1.0, 4.0, 4.0, ["trees"], None, 1.0),
        (0, "object", 3, 0.0, 0.0, 5.0, 5.0, ["dog"], None, 1.0), (0, "object", 4, 9.0, 9.0, 12.0, 12.0, ["dog"], None, 1.0),
        (0, "floating", 5, 0.0, 0.0, 1.0, 1.0, ["bird"], ["tiny grey bird on wire"], 1.0)], OBJ)
    grounding = spark.createDataFrame([(0, (0, 0), "the road", [3, 4], 0), (0, (1, 0), "an old man", [1], 0)], GR)
    caption = spark.createDataFrame([(0, "A shiny red car on the road. Some tall trees and two brown dogs. One grey tiny bird is there.")], "image_id long, caption string")
    got = {r.phrase: r for r in ground.ground_dense(caption, objs, grounding).collect()}
    assert {p: (r.step, r.object_ids) for p, r in got.items()} == {
        "shiny red car": (1, [0]), "the road": (2, [3, 4]), "one grey tiny bird": (3, [5]), "some tall trees": (4, [1])} or \
        {p: (r.step, r.object_ids) for p, r in got.items()} == {
        "shiny red car": (1, [0]), "the road": (2, [3, 4]), "one grey tiny bird": (3, [5]), "tall trees": (4, [1])}
    text = caption.first().caption.lower()
    for p, r in got.items():
        assert text[r.start:r.end] == p
    nested = ground.dense_captions(caption, ground.ground_dense(caption, objs, grounding), objs).first().dense_caption
    assert nested.details[0].phrase == "one grey tiny bird" and nested.details[0].ids == [5]


def test_filter_groundings_both_plans(spark):
    rows = [(0, 1, (i, 0), p, o) for i, (p, o) in enumerate([
        ("red car", [1]), ("car", [1]), ("car", [2]), ("big red car", [1]), ("ar", [2]), ("blue car", [2]), ("a", [3])])]
    df = spark.createDataFrame(rows, "image_id long, step int, pos struct<a:int,b:int>, phrase string, object_ids array<int>")
    for plan in ({"hot": False}, {"hot": True}):
        got = {r.phrase: r.object_ids for r in ground.filter_groundings(df, **plan).collect()}
        assert got == {"big red car": [1], "blue car": [2], "a": [3]}


def test_phrases_inside_others(spark, monkeypatch):
    """Groups of any size, by comparing in place and by anchors, against all pairs."""
    import random

    r = random.Random(2)
    rows = [(g, k) for g, n in ((0, 400), (1, 30), (2, 1)) for k in sorted({" ".join(r.choices(["a", "bb", "the small", "é", "car"], k=r.randrange(1, 9))) for _ in range(n)} | {""})]
    df = spark.createDataFrame(rows, "g int, phrase string")
    want = {(g, m) for g, m in rows if not any(g == h and m != k and m in k for h, k in rows)}
    monkeypatch.setattr(scale, "GROUP_LIMIT", 50)
    for hot in (False, True, None):
        assert {tuple(x) for x in ground._not_inside(df, ["g"], "phrase", hot).collect()} == want


def test_many_phrases_of_the_same_objects(spark):
    """50,000 phrases with equal objects spread over tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    n = 50_000
    df = spark.range(n).select(F.lit(0).cast("long").alias("image_id"), F.lit(1).alias("step"), F.struct(F.col("id").cast("int").alias("a"), F.lit(0).alias("b")).alias("pos"),
                               F.concat(F.lit("the small thing "), F.when(F.col("id") % 5 == 0, F.format_string("%07d", F.col("id") + 1)).otherwise(F.format_string("%07d in a box", "id"))).alias("phrase"),
                               F.array(F.lit(7)).alias("object_ids"))
    out = ground.filter_groundings(df)
    # every fifth phrase is the start of the one after it
    try:
        assert out.count() == n - n // 5
        assert out.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_scene_text(spark):
    objs = spark.createDataFrame([
        (0, "object", 0, 0.0, 0.0, 10.0, 10.0, ["big_tree"], None, 10.0), (0, "object", 1, 5.0, 5.0, 15.0, 15.0, ["car"], ["x: red_one"], 9.9),
        (0, "object", 2, 900.0, 0.0, 910.0, 10.0, ["house"], None, 0.0), (0, "floating", 3, 0.0, 0.0, 1.0, 1.0, ["no"], None, 5.0)], OBJ)
    grounding = spark.createDataFrame([(0, (0, 0), "the car", [1, 3], 0), (0, (1, 0), "a house", [2], 0)], GR)
    images = spark.createDataFrame([(0, ["", "A cap."], ("Out", "Field")), (1, ["", "None here."], None)],
                                   "image_id long, captions array<string>, landmark struct<category:string,fine_category:string>")
    groups = scene.proximity_groups(scene.depth_layers(scene.scene_objects(objs, 100)))
    text = {r.image_id: r.scene_text for r in scene.scene_text(images, groups, scene.relationship_groups(grounding, groups)).collect()}
    assert text[0] == ("Immediate Foreground:\nGroup 0: big tree, car/red one\nBackground:\nGroup 1: house\n\nShort Captions:\n\nA cap.\n\nRelationships:\n"
                       "the car, Group Ids: (0)\na house, Group Ids: (1)\n\nLandmarks:\nOut, Field\n")
    assert text[1] == "No valid objects found in the scene.\n\nShort Captions:\n\nNone here.\n"


def test_scorer_hook(spark):
    df = with_scorer(spark.range(5), lambda f: f.assign(score=f.id * 2.0), "id long, score double")
    assert [r.score for r in df.orderBy("id").collect()] == [0.0, 2.0, 4.0, 6.0, 8.0]


def test_fuzzy_on_shared_pieces(spark, monkeypatch):
    """The plan for crowded images finds the same objects, also where only some images, or one side, are crowded."""
    words = ["red", "old", "car", "cars", "tree", "of", "the", "in", "a", "big", "field", "x"]
    import random

    r = random.Random(4)
    say = lambda: " ".join(r.choice(words) for _ in range(r.randrange(1, 5)))
    objs = spark.createDataFrame([(0, "object", i, 0.0, 0.0, 1.0, 1.0, ["l"], [say()], 1.0) for i in range(40)], OBJ)
    phrases = spark.createDataFrame([(0, i, "n", say()) for i in range(60)], "image_id long, pos int, noun string, phrase string")
    none = spark.createDataFrame([], "image_id long, phrase string")
    grounding = spark.createDataFrame([(0, (i, 0), say(), [i], 0) for i in range(5)], GR)
    a, b = (sorted(map(str, ground.dense_fuzzy(phrases, objs, grounding, none, hot).collect())) for hot in (False, True))
    assert a == b and len(a) > 10
    # many phrases, few known texts in image 0 and the reverse of that in image 1, next to a small image
    more = [(i, x.pos, x.noun, x.phrase) for i, n in ((1, 3), (2, 3)) for x in phrases.collect()[:n]]
    phrases = phrases.union(spark.createDataFrame(more, phrases.schema))
    objs = objs.where("id < 5").union(objs.withColumn("image_id", F.lit(1).cast("long"))).union(objs.where("id < 5").withColumn("image_id", F.lit(2).cast("long")))
    monkeypatch.setattr(scale, "GROUP_LIMIT", 15)
    a, b = (sorted(map(str, ground.dense_fuzzy(phrases, objs, grounding, none, hot).collect())) for hot in (False, None))
    assert a == b and len(a) > 10


def test_fuzzy_pairs_of_a_crowded_image(spark):
    """Phrases and texts meet on their rarest words: every similar pair, each once, and few others."""
    import random

    r = random.Random(6)
    words = ["the", "of", "in", "x", "cars", "Class", "classes", "tree", "é", "bus", "!", "--", "a" * 40, "a" * 40 + "b"] + [f"w{i}" for i in range(300)]
    say = lambda: "".join(w + r.choice([" ", " ", "-", ""]) for w in r.choices(words, [3] * 14 + [1] * 300, k=r.randrange(1, 6))).strip() or "x"
    asked, texts = sorted({say() for _ in range(400)}), sorted({say() for _ in range(400)} | {"!", "the", "of the"})
    ask = spark.createDataFrame([(0, p) for p in asked], "image_id long, phrase string").withColumn("_wp", T.content_words(F.col("phrase")))
    known = spark.createDataFrame([(0, t) for t in texts], "image_id long, text string").withColumn("_wt", T.content_words(F.col("text")))
    value = T.phrase_similarity(F.col("phrase"), F.col("text"))
    want = {(x.phrase, x.text) for x in ground._meet(ask, known, False).where(value >= ground.FUZZY).collect()}
    met = [(x.phrase, x.text) for x in ground._meet(ask, known, True).select("phrase", "text").collect()]
    assert len(met) == len(set(met)) < len(asked) * len(texts) / 4
    assert want <= set(met) and len(want) > 300


def test_packed_pixels(spark):
    """Sixty pixels to a row: as many rows as words that a run touches, and the same run lengths as from a row a pixel."""
    r = np.random.default_rng(3)
    counts = lambda: [int(c) for c in r.choice([0, 1, 7, 59, 60, 61, 300], 41)]
    df = spark.createDataFrame([(k, (50, 400, c[:-1] + [20_000 - sum(c[:-1])])) for k in range(6) if sum((c := counts())[:-1]) < 20_000],
                               "id int, segmentation struct<h:int,w:int,counts:array<bigint>>")
    runs = masks.runs(df, ["id"])
    packed = masks.pixels(runs, packed=True)
    want = {x.id: x.segmentation for x in masks.encode(masks.pixels(runs), ["id"]).collect()}
    assert len(want) > 2 and {x.id: x.segmentation for x in masks.encode(packed, ["id"]).collect()} == want
    assert packed.count() == sum((x.start + x.length - 1) // 60 - x.start // 60 + 1 for x in runs.collect())
    assert packed.agg(F.sum(F.bit_count("bits"))).first()[0] == masks.pixels(runs).count()
    with pytest.raises(ValueError, match="column by column"):
        masks.encode(packed, ["id"], row_major=True)


def test_counts_are_made_once(spark):
    """Counts that an expression makes are made once a mask, not again for every slice of them."""
    made = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: i.cast("long"))
    df = spark.range(1).select("id", (F.col("id") + 90).alias("n")).select("id", F.struct(F.lit(4095).alias("h"), F.lit(1).alias("w"), made.alias("counts")).alias("segmentation"))
    runs = masks.runs(df, ["id"])
    assert [(r.start, r.length) for r in runs.orderBy("start").collect()] == [(i * (i - 1) // 2, i) for i in range(2, 91, 2)]
    assert runs._jdf.queryExecution().optimizedPlan().toString().count("sequence(1, ") == 1
