"""Images held back until every model is through, over several batches and a restart."""
import datetime as dt

from helpers import SCHEMA, random_boxes
from pyspark.sql import functions as F

from boxloom.operators import dedup, vote
from boxloom.streaming import release

T0 = dt.datetime(2024, 1, 1)
NOTICE = "image_id long, model string, ts timestamp"


def run(spark, tmp_path, drops, models, **options):
    """Write each drop, then work it off with a query of its own; what came out after each."""
    rows, notices, out = (str(tmp_path / n) for n in ("rows", "notices", "out"))
    seen = []
    for boxes, notes in drops:
        spark.createDataFrame(boxes, SCHEMA).write.mode("append").parquet(rows)
        spark.createDataFrame(notes, NOTICE).coalesce(1).write.mode("append").parquet(notices)
        q = release.annotate_released(spark.readStream.schema(NOTICE).parquet(notices), models, lambda ids: spark.read.parquet(rows).join(ids, "image_id"),
                                      lambda df: vote.assign_ids(vote.vote(dedup.nms(df))), out, str(tmp_path / "checkpoint"), **options)
        q.awaitTermination(180)
        assert q.exception() is None
        seen.append(spark.read.schema("image_id long, id long, kind string, complete boolean, batch int, seed_priority int, seed_seq int").parquet(out).collect())
    return seen


def test_three_batches_and_restarts(spark, tmp_path):
    rows = random_boxes(8, images=4, per_image=20)
    at = [c.split()[0] for c in SCHEMA.split(", ")]
    image, model = at.index("image_id"), at.index("model")
    models = sorted({r[model] for r in rows})
    assert len(models) >= 3
    images = sorted({r[image] for r in rows})
    third = {m: i % 3 for i, m in enumerate(models)}
    drops = []
    for d in range(3):
        late = lambda i, m: (third[m] + (i == images[0])) % 3                       # one image's models come in another order
        boxes = [r for r in rows if late(r[image], r[model]) == d]
        notes = [(i, m, T0 + dt.timedelta(seconds=60 * d + i)) for i in images for m in models if late(i, m) == d and not (i == images[-1] and m == models[-1])]
        drops.append((boxes, notes + notes[:2] + [(None, "m", T0), (images[0], None, T0)]))
    before, middle, after = run(spark, tmp_path, drops, models)
    assert before == [] and middle == []
    whole = [i for i in images[:-1]]                                                # one model never finishes the last image
    want = vote.assign_ids(vote.vote(dedup.nms(spark.createDataFrame(rows, SCHEMA).where(F.col("image_id").isin(whole)))))
    got = sorted((r.image_id, r.kind, r.id, r.seed_priority, r.seed_seq) for r in after)
    assert got == sorted(map(tuple, want.select("image_id", "kind", "id", "seed_priority", "seed_seq").collect()))
    assert all(r.complete for r in after)


def test_images_that_wait_too_long(spark, tmp_path):
    rows = random_boxes(8, images=3, per_image=6)
    at = [c.split()[0] for c in SCHEMA.split(", ")]
    image = at.index("image_id")
    a, b, c = sorted({r[image] for r in rows})
    hour = lambda h: T0 + dt.timedelta(hours=h)
    drops = [(rows, [(a, "m", hour(0)), (b, "m", hour(0)), (b, "n", hour(0))]), ([rows[0]], [(c, "m", hour(5))]), ([rows[0]], [(a, "n", hour(5)), (c, "n", hour(5))])]
    first, second, third = run(spark, tmp_path, drops, ["m", "n"], wait=3600.0, lateness="1 minute")
    assert {r.image_id for r in first} == {b}
    assert {(r.image_id, r.complete) for r in second} == {(b, True), (a, False)}
    assert {(r.image_id, r.complete) for r in third} == {(b, True), (a, False), (c, True)}
    assert len({(r.image_id, r.batch) for r in third}) == 3                           # none twice


def test_a_batch_costs_calls_per_bucket(spark, tmp_path, monkeypatch):
    """Images share states: six hundred of them need no more states than there are buckets, and each leaves once, by its own notices."""
    monkeypatch.setattr(release, "BUCKETS", 3)
    notices, out = str(tmp_path / "notices"), []
    drops = [[(i, "m", T0 + dt.timedelta(seconds=i)) for i in range(600)], [(i, "n", T0 + dt.timedelta(minutes=20)) for i in range(0, 600, 2)] + [(1, "m", T0)],
             [(2, "n", T0 + dt.timedelta(hours=9)), (601, "m", T0 + dt.timedelta(hours=9))], [(601, "n", T0 + dt.timedelta(hours=9))]]
    for drop in drops:
        spark.createDataFrame(drop, NOTICE).coalesce(1).write.mode("append").parquet(notices)
        with release._rocks(spark):
            q = (release.released(spark.readStream.schema(NOTICE).parquet(notices), ["m", "n"]).writeStream.foreachBatch(lambda b, _: out.extend(map(tuple, b.collect())))
                 .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
            q.awaitTermination(180)
        assert q.exception() is None
        states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        assert states and max(states) <= 3
    assert sorted((i, complete) for i, _, complete in out) == sorted([(i, i % 2 == 0) for i in range(600)] + [(601, True)])
