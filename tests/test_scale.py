"""Window helpers over groups of any size."""
import random

from pyspark.sql import functions as F

from boxloom import scale
from boxloom.operators import overlap, sampling
from helpers import SCHEMA, box, groups, iou, random_boxes


def test_running_matches_plain_window(spark):
    r = random.Random(3)
    rows = [(r.choice([1, 1, 1, 2, 3]), r.random(), i, r.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, s double, i int, v int")
    args = dict(keys=["k"], order=[F.col("s").desc(), F.col("i")], sums={"c": F.col("v")}, maxima={"m": F.col("v")}, number="n")
    a = sorted(map(tuple, scale.running(df, hot=False, **args).collect()))
    b = sorted(map(tuple, scale.running(df, hot=True, **args).collect()))
    assert a == b
    for k, g in groups(rows, lambda x: x[0]).items():
        total = 0
        for n, row in enumerate(sorted(g, key=lambda x: (-x[1], x[2])), 1):
            total += row[3]
            assert (row[0], row[1], row[2], row[3], total, max(x[3] for x in sorted(g, key=lambda x: (-x[1], x[2]))[:n]), n) in set(a)


def test_global_order(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("id"))
    rows = sorted((r.id, r.n) for r in scale.running(df, [], [F.col("id")], number="n").collect())
    assert rows == [(i, i + 1) for i in range(100)]


def test_shard_sizes(spark):
    for n, k in ((0, 5), (16, 2), (2, 3), (42, 4)):
        got = {r.shard: r["count"] for r in sampling.shards(spark.range(n), [F.col("id")], k).groupBy("shard").count().collect()}
        want = {s: n // k + (s < n % k) for s in range(k)}
        assert got == {s: c for s, c in want.items() if c}


def test_overlap_pairs_on_cells(spark):
    rows = random_boxes(11, images=2, per_image=50)
    df = spark.createDataFrame(rows, SCHEMA).select("image_id", "priority", "seq", "x1", "y1", "x2", "y2")
    for t, inclusive in ((0.5, True), (0.3, True), (0.65, False)):
        want = sorted((a[0], a[2], a[3], b[2], b[3]) for g in groups(rows, lambda r: r[0]).values() for a in g for b in g
                      if iou(box(a), box(b), int(inclusive)) >= t)
        for hot in (False, True):
            p = overlap.overlap_pairs(df, df, t, inclusive=inclusive, hot=hot)
            assert sorted((r.image_id, r.l.priority, r.l.seq, r.r.priority, r.r.seq) for r in p.collect()) == want


def test_crowded_images_part_from_the_others(spark, monkeypatch):
    """One crowded image takes the plan of cells, the others keep theirs, and all rows are as on one plan."""
    monkeypatch.setattr(overlap, "PAIR_LIMIT", 30)
    rows = random_boxes(17, images=3, per_image=50)
    df = spark.createDataFrame(rows, SCHEMA).select("image_id", "priority", "seq", "x1", "y1", "x2", "y2")
    df = df.where("image_id = 1 or seq = 1").withColumn("o", F.col("priority") * 100 + F.col("seq"))
    many = scale.crowds(["image_id"], 30, df, df.limit(0))
    assert [r.image_id for r in many.collect()] == [1] and scale.crowds(["image_id"], 1000, df) is None
    rest, big = scale.apart(df, ["image_id"], many)
    assert rest.columns == df.columns and rest.where("image_id = 1").isEmpty() and big.where("image_id <> 1").isEmpty()
    assert rest.count() + big.count() == df.count() and not rest.isEmpty()
    plain, each = (sorted(map(str, overlap.overlap_pairs(df, df, 0.5, hot=hot).collect())) for hot in (False, None))
    assert plain == each and plain
    for f in (overlap.first_match, overlap.best_match):
        plain, each = (sorted(map(str, f(df, df, 0.4, ["priority", "seq"], ["o"], F.col("r")["o"], hot=hot).collect())) for hot in (False, None))
        assert plain == each and plain


def test_subset_of_any_size(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    for n in (1, 50, 300):
        want = {r.k for r in df.orderBy(F.xxhash64("k", F.lit(2)), "k").limit(n).collect()}
        assert {r.k for r in sampling.random_subset(df, "k", n, seed=2).collect()} == want and len(want) == min(n, 200)


def test_small_enough(spark):
    assert not scale.small_enough(spark.range(10).withColumn("t", F.repeat(F.lit("x"), 100)), 10, size=1_000)
    assert scale.small_enough(spark.range(10), 10) and not scale.small_enough(spark.range(11), 10)


def test_matches_of_copies(spark):
    """First and best match over distinct boxes equal the plain join, copies included."""
    rows = random_boxes(12, images=2, per_image=40)
    df = spark.createDataFrame(rows, SCHEMA).select("image_id", "priority", "seq", "x1", "y1", "x2", "y2")
    a, b = df.where("priority <= 3"), df.where("priority > 3")
    b = b.withColumn("o", F.col("priority") * 100 + F.col("seq"))
    for f in (overlap.first_match, overlap.best_match):
        x, y = (sorted(map(str, f(a, b, 0.4, ["priority", "seq"], ["o"], F.col("r")["o"], hot=hot).collect())) for hot in (False, True))
        assert x == y and x


def test_class_list_in_passes(spark):
    import random

    from boxloom.operators import assign

    r = random.Random(1)
    vec = lambda: [r.uniform(-1, 1) for _ in range(6)]
    crops = spark.createDataFrame([(i, vec()) for i in range(20)], "crop_id int, vector array<double>")
    classes = spark.createDataFrame([(f"c{i}", vec()) for i in range(50)], "label string, vector array<double>")
    one = assign.zero_shot_topk(crops, classes, 3).orderBy("crop_id", "rank").collect()
    many = assign.zero_shot_topk(crops, classes, 3, block=7, size=1 << 10).orderBy("crop_id", "rank").collect()
    assert [(x.crop_id, x.rank, x.label) for x in one] == [(x.crop_id, x.rank, x.label) for x in many]
    assert all(abs(x.probability - y.probability) < 1e-9 for x, y in zip(one, many))


def test_related_boxes_share_a_cell(spark):
    """Pairs at the very edge of the threshold, where sizes and offsets differ most."""
    from boxloom.functions import boxes as B

    rows = []
    for t in (0.3, 0.5, 0.65, 0.75, 0.9):
        for s in (1.0, 10.0, 64.0, 1000.0, 7.3):
            for x in (0.0, 63.9, -12.0, 1e5):
                rows += [(t, x, x, x + s, x + s, x, x, x + s * t, x + s), (t, x, x, x + s, x + s, x + s * (1 - t), x, x + s, x + s),
                         (t, x, x, x + s, x + s, x, x + s * (1 - t), x + s, x + s), (t, x, x, x + s, x + s, x, x, x + s / t, x + s)]
    names = ["a_x1", "a_y1", "a_x2", "a_y2", "b_x1", "b_y1", "b_x2", "b_y2"]
    df = spark.createDataFrame(rows, "t double, " + ", ".join(f"{n} double" for n in names))
    for t in (0.3, 0.5, 0.65, 0.75, 0.9):
        lost = df.where(F.col("t") == t).where(~F.arrays_overlap(B.iou_cells(B.cols("a_"), t), B.iou_cells(B.cols("b_"), t)))
        assert lost.count() == 0
