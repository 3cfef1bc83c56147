"""Following objects through the frames of a video by box overlap."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import boxes as B
from boxloom.operators.greedy import leaders
from boxloom.operators.overlap import PAIR_LIMIT, overlap_pairs

BOX = ["x1", "y1", "x2", "y2"]


def frame_links(df: DataFrame, iou: float = 0.5, best_first: bool = False, hot: bool | None = None) -> DataFrame:
    """Which box of the frame before each box continues: ``video_id, f, idx, prev``.

    ``f`` numbers the frames that occur.  Boxes pair one to one where they overlap enough, in order of
    (idx, prev) or, with ``best_first``, largest overlap first."""
    hot = _crowded(df) if hot is None else hot
    dense = _dense_frames(df, hot)
    return _links(df.join(dense, ["video_id", "frame"]), iou, best_first, hot)


def _crowded(df: DataFrame) -> bool:
    """A frame with very many boxes, or a video too long for one window."""
    return (scale.has_oversized(df, ["video_id", "frame"], PAIR_LIMIT)
            or scale.has_oversized(df, ["video_id"], scale.WINDOW_LIMIT))


def _dense_frames(df: DataFrame, hot: bool) -> DataFrame:
    return scale.running(df.select("video_id", "frame").distinct(), ["video_id"], [F.col("frame")], number="f", hot=hot)


def _links(at: DataFrame, iou: float, best_first: bool, hot: bool | None) -> DataFrame:
    now = at.select("video_id", "f", "idx", *BOX)
    before = at.select("video_id", (F.col("f") + 1).alias("f"), "idx", *BOX)
    pairs = overlap_pairs(now, before, iou, keys=["video_id", "f"], inclusive=False, hot=hot).select(
        "video_id", "f", F.col("l.idx").alias("idx"), F.col("r.idx").alias("prev"), "iou")
    first = [("iou", True)] if best_first else []
    return leaders(pairs, ["video_id", "f"], [*first, ("idx", False), ("prev", False)], ["idx", "prev"],
                   lambda k, m: (k["idx"] == m["idx"]) | (k["prev"] == m["prev"]),
                   F.array(F.concat(F.lit("n"), "idx"), F.concat(F.lit("p"), "prev")), ["idx", "prev"],
                   hot=hot or None).select("video_id", "f", "idx", "prev")      # pairs are more than boxes: counted


def track_frames(df: DataFrame, iou: float = 0.5, best_first: bool = False, hot: bool | None = None) -> DataFrame:
    """Ids for boxes ``(video_id, frame, idx, box)`` when lost objects are not remembered.

    Then a frame depends on the one before it only: boxes of neighbouring frames are paired one to one
    for all frames at once (``frame_links``); the pairs form chains, and each chain is one object.
    Its head is found by doubling steps, so a long video takes few rounds and is never
    held by one task.  Ids count heads in (frame, idx) order; frames are numbered without gaps by the
    frames that occur."""
    hot = _crowded(df) if hot is None else hot
    at = df.join(_dense_frames(df, hot), ["video_id", "frame"])
    links = _links(at, iou, best_first, hot)
    node = lambda f, i: F.struct(f.alias("f"), i.alias("idx"))
    state = at.join(links, ["video_id", "f", "idx"], "left").select(
        "video_id", node(F.col("f"), F.col("idx")).alias("me"),
        F.when(F.col("prev").isNotNull(), node(F.col("f") - 1, F.col("prev"))).otherwise(node(F.col("f"), F.col("idx"))).alias("up"))
    state = scale.checkpointed(state)
    while True:
        jump = state.select("video_id", F.col("me").alias("up"), F.col("up").alias("_far"))
        ahead = scale.checkpointed(state.join(jump, ["video_id", "up"]).select("video_id", "me", "up", "_far"))
        moved = ahead.where(F.col("up") != F.col("_far")).isEmpty()
        state = ahead.select("video_id", "me", F.col("_far").alias("up"))
        if moved:
            break
    heads = state.where(F.col("me") == F.col("up")).select("video_id", F.col("me").alias("up"))
    ids = scale.running(heads, ["video_id"], [F.col("up.f"), F.col("up.idx")], number="_n", hot=hot)
    named = state.join(ids, ["video_id", "up"]).select(
        "video_id", F.col("me.f").alias("f"), F.col("me.idx").alias("idx"), (F.col("_n") - 1).alias("track_id"),
        (F.col("me.f") - F.col("up.f") + 1).alias("period"))
    return at.join(named, ["video_id", "f", "idx"]).drop("f")


# ---- with memory of lost objects ---------------------------------------------------------

class _Tracker:
    """Objects seen last in one video; ``step`` takes the boxes of the next frame."""

    def __init__(self, state=None):
        # per remembered object: box, id, frames seen, frames lost
        self.count, self.boxes, self.ids, self.period, self.lost, self.frame = state or (0, [], [], [], [], None)

    def state(self):
        return (self.count, self.boxes, self.ids, self.period, self.lost, self.frame)

    def step(self, boxes: np.ndarray, opts: dict) -> tuple[list, list]:
        n, m = len(boxes), len(self.boxes)
        ids, period = [None] * n, [1] * n
        used = set()
        if n and m:
            prev = np.asarray(self.boxes, dtype=float)
            w = np.minimum(boxes[:, None, 2], prev[None, :, 2]) - np.maximum(boxes[:, None, 0], prev[None, :, 0])
            h = np.minimum(boxes[:, None, 3], prev[None, :, 3]) - np.maximum(boxes[:, None, 1], prev[None, :, 1])
            inter = np.clip(w, 0, None) * np.clip(h, 0, None)
            size = lambda b: (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
            union = size(boxes)[:, None] + size(prev)[None, :] - inter
            iou = np.divide(inter, union, out=np.zeros_like(inter), where=union > 0)
            i, j = np.nonzero(iou >= opts["iou"])
            order = np.lexsort((j, i, -iou[i, j])) if opts["best_first"] else range(len(i))
            for k in order:
                a, b = i[k], j[k]
                if ids[a] is None and b not in used:
                    ids[a], period[a] = self.ids[b], self.period[b] + 1
                    used.add(b)
        for a in range(n):
            if ids[a] is None:
                ids[a] = self.count
                self.count += 1
        keep = [b for b in range(m) if b not in used and self.lost[b] < opts["max_lost"] and self.period[b] > opts["min_period"]
                and (self.boxes[b][2] - self.boxes[b][0]) / opts["width"] >= opts["min_size"]
                and (self.boxes[b][3] - self.boxes[b][1]) / opts["height"] >= opts["min_size"]]
        self.lost = [0] * n + [self.lost[b] + 1 for b in keep]
        self.boxes = [list(map(float, b)) for b in boxes] + [self.boxes[b] for b in keep]
        self.ids, self.period = ids + [self.ids[b] for b in keep], period + [self.period[b] for b in keep]
        return ids, period


def _run(tracker: _Tracker, pdf: pd.DataFrame, opts: dict) -> pd.DataFrame:
    """Feed rows sorted by frame to a tracker; frames not after the last one seen are dropped as late."""
    if tracker.frame is not None:
        pdf = pdf[pdf["frame"] > tracker.frame]
    parts = []
    for frame, rows in pdf.groupby("frame", sort=True):
        ids, period = tracker.step(rows[BOX].to_numpy(dtype=float), opts)
        parts.append(rows.assign(track_id=ids, period=period))
        tracker.frame = int(frame)
    return pd.concat(parts) if parts else pdf.assign(track_id=[], period=[])


def _options(iou, max_lost, min_period, min_size, width, height, best_first):
    return dict(iou=iou, best_first=best_first, max_lost=max_lost, min_period=min_period, min_size=min_size, width=width, height=height)


OUTPUT = "video_id bigint, frame int, idx int, x1 double, y1 double, x2 double, y2 double, track_id bigint, period bigint"
STATE = "count bigint, boxes array<array<double>>, ids array<bigint>, period array<bigint>, lost array<bigint>, frame bigint"
INPUT = ["video_id", "frame", "idx", *BOX]


def track_with_memory(df: DataFrame, max_lost: int, iou: float = 0.5, min_period: int = 1, min_size: float = 0.02,
                      width: float = 1920, height: float = 1080, best_first: bool = False, hot: bool | None = None) -> DataFrame:
    """Ids when an object may be lost for up to ``max_lost`` frames and return.

    A box may continue any box of the frame before or, where that was part of an object seen in more than ``min_period`` frames
    and is not too small, of the frames that the memory reaches back to.  All such pairs are found by one join per frame
    distance, for all frames at once, and then settled in rounds (``_continued``); chains of settled pairs are objects.
    A video spreads over all tasks."""
    hot = _crowded(df) if hot is None else hot
    at = scale.checkpointed(df.select(*INPUT).join(_dense_frames(df, hot), ["video_id", "frame"]))
    pairs = _possible(at, max_lost, iou, min_size, width, height, best_first, hot)
    return _numbered(at, _continued(pairs, min_period), hot)


def _node(f, i):
    return F.struct(f.alias("f"), i.alias("idx"))


def _possible(at: DataFrame, max_lost: int, iou: float, min_size: float, width: float, height: float, best_first: bool, hot: bool) -> DataFrame:
    """``video_id, a, b, lag, key``: box ``a`` could continue box ``b``, ``lag`` frames before; ``key`` is the order in which a frame
    by frame walk would come to the pair."""
    large = ((F.col("x2") - F.col("x1")) / width >= min_size) & ((F.col("y2") - F.col("y1")) / height >= min_size)
    found = None
    for lag in range(1, max_lost + 2):
        before = (at if lag == 1 else at.where(large)).select("video_id", (F.col("f") + lag).alias("f"), "idx", *BOX)
        one = overlap_pairs(at.select("video_id", "f", "idx", *BOX), before, iou, keys=["video_id", "f"], inclusive=False, hot=hot)
        first = [(-F.col("iou")).alias("best")] if best_first else []
        one = one.select("video_id", _node(F.col("f"), F.col("l.idx")).alias("a"), _node(F.col("f") - lag, F.col("r.idx")).alias("b"), F.lit(lag).alias("lag"),
                         F.struct("f", *first, F.col("l.idx").alias("i"), F.lit(lag).alias("lag"), F.col("r.idx").alias("j")).alias("key"))
        found = one if found is None else found.unionByName(one)
    return found


def _continued(pairs: DataFrame, min_period: int) -> DataFrame:
    """The pairs (``video_id, a, b``) that a walk in order of ``key`` takes: neither box taken before on its side, and, over a gap,
    ``b`` the end of a chain of more than ``min_period`` boxes.

    A round takes, everywhere in all videos at once, the pairs that come first for both of their boxes, and drops those
    that share a box with them.  A pair over a gap waits until the chain before ``b`` is settled; that chain has earlier pairs only, so
    the earliest pair of a video never waits.  Frames far apart do not wait for one another, so rounds are few.
    """
    side = lambda df, c: df.select("video_id", F.col(c).alias("n")).distinct()
    semi = lambda df, c, nodes, how: df.join(nodes.withColumnRenamed("n", c), ["video_id", c], how).select(*df.columns)
    left, won = scale.checkpointed(pairs), None
    while not left.isEmpty():
        # ends of chains long enough, and boxes whose chain may yet become so
        pending = ahead = side(left, "a")
        long = None if won is None else side(won, "a")
        for _ in range(min_period - 1):
            pending = ahead if won is None else ahead.union(side(semi(won, "b", pending, "left_semi"), "a")).distinct()
            long = None if won is None else side(semi(won, "b", long, "left_semi"), "a")
        if min_period < 1:
            ready = left.withColumn("ready", F.lit(1))
        else:
            marks = pending.withColumn("m", F.lit(0))
            marks = marks if long is None else marks.union(long.withColumn("m", F.lit(1)))
            marks = marks.groupBy("video_id", "n").agg(F.max("m").alias("m")).withColumnRenamed("n", "b")
            state = F.when(F.col("lag") == 1, 1).otherwise(F.coalesce("m", F.lit(-1)))        # can be taken, has to wait, never
            ready = left.join(marks, ["video_id", "b"], "left").select(*left.columns, state.alias("ready")).where("ready >= 0")
        for c in "ab":
            ready = ready.withColumn(f"first_{c}", F.min("key").over(Window.partitionBy("video_id", c)))
        ready = scale.checkpointed(ready)
        taken = ready.where("ready = 1 and key = first_a and key = first_b").select("video_id", "a", "b")
        won = taken if won is None else won.union(taken)
        left = ready.select(*pairs.columns)
        for c in "ab":
            left = semi(left, c, side(taken, c), "left_anti")
        left = scale.checkpointed(left)
    return pairs.select("video_id", "a", "b").limit(0) if won is None else won


def _numbered(at: DataFrame, links: DataFrame, hot: bool) -> DataFrame:
    """Boxes with ``track_id``, counting first boxes in (frame, idx) order, and ``period``, how many boxes of the object there are up to
    this one.  First boxes are found by doubling steps along the links."""
    me = at.select("video_id", _node(F.col("f"), F.col("idx")).alias("a"))
    state = me.join(links, ["video_id", "a"], "left").select(
        "video_id", F.col("a").alias("me"), F.coalesce("b", "a").alias("up"), F.col("b").isNotNull().cast("long").alias("steps"))
    state = scale.checkpointed(state)
    while True:
        jump = state.select("video_id", F.col("me").alias("up"), F.col("up").alias("far"), F.col("steps").alias("more"))
        ahead = scale.checkpointed(state.join(jump, ["video_id", "up"]).select("video_id", "me", "up", "far", (F.col("steps") + F.col("more")).alias("steps")))
        settled = ahead.where("up <> far").isEmpty()
        state = ahead.select("video_id", "me", F.col("far").alias("up"), "steps")
        if settled:
            break
    ids = scale.running(state.where("me = up").select("video_id", "up"), ["video_id"], [F.col("up.f"), F.col("up.idx")], number="_n", hot=hot)
    named = state.join(ids, ["video_id", "up"]).select("video_id", F.col("me.f").alias("f"), F.col("me.idx").alias("idx"),
                                                     (F.col("_n") - 1).alias("track_id"), (F.col("steps") + 1).alias("period"))
    return at.join(named, ["video_id", "f", "idx"]).select(*INPUT, "track_id", "period")


def track_stream(stream: DataFrame, max_lost: int = 0, iou: float = 0.5, min_period: int = 1, min_size: float = 0.02,
                 width: float = 1920, height: float = 1080, best_first: bool = False, lateness: str = "1 minute") -> DataFrame:
    """The same on a stream keyed by video.  State per video is the objects last seen.  Frames at or before
    the last processed one are late and dropped.  With a ``ts`` column, a watermark lets the
    state of videos end that stay silent past it."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    opts = _options(iou, max_lost, min_period, min_size, width, height, best_first)
    timed = "ts" in stream.columns

    def follow(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        got = state.getOption if state.exists else None
        tracker = _Tracker(tuple(_plain(v) for v in got) if got else None)
        rows = pd.concat(list(frames)).sort_values(["frame", "idx"])
        if timed:
            latest = int(rows["ts"].max().timestamp() * 1000)
            watermark = state.getCurrentWatermarkMs()
            if latest > watermark:
                state.setTimeoutTimestamp(latest)
            rows = rows.drop(columns="ts")
        out = _run(tracker, rows, opts)
        state.update(tracker.state())
        yield out[[*INPUT, "track_id", "period"]]

    rows = stream.select(*INPUT, *(["ts"] if timed else []))
    if timed:
        rows = rows.withWatermark("ts", lateness)
    mode = GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.NoTimeout
    return rows.groupBy("video_id").applyInPandasWithState(follow, OUTPUT, STATE, "append", mode)


def _plain(v):
    """State values as plain lists and numbers."""
    if isinstance(v, (list, tuple, np.ndarray)):
        return [_plain(x) for x in v]
    return v
