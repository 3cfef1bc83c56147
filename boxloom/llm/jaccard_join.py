"""Jaccard join of word n-gram sets by prefix lists, with two ways of skipping work: blocks of a list, and answers.

Sets that are equal are one set from the start.  Shingles are ordered, rare ones first, by a counting sketch of
fixed size over all texts; any order gives exact results.  The first few shingles of a set (its prefix) go into
inverted lists, where two sets that reach the threshold must meet.

* Index skipping: a list is split into blocks by set size, and only neighbouring blocks meet; within them, entries
  whose positions in the two prefixes leave too few shingles are passed over.
* Answer skipping: in every list the set with the largest share of common shingles leads.  A set is first compared
  with the leader it meets most often.  The counts of that comparison bound, and often settle, the set's overlap with
  every other set of the leader, without looking at either; and sets already in one component need no comparison.

What remains is compared shingle by shingle.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm.common import components, grams, lowered_hashes, only, slices, small_batches, stored, without
from boxloom.scale import maybe_broadcast

SIZE = 4               # words of a shingle
SHARE = 85             # Jaccard similarity, in hundredths
BUCKETS = 1 << 18      # counters of the sketch
DEVIATIONS = 6         # how far above its peers a counter must stand to mark its shingles as frequent


def shingle_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Distinct shingles of each text as sorted 63-bit hashes; one of all words if there are fewer than ``size``."""
    h, n = lowered_hashes(texts)
    return [np.unique(grams(x, size) >> np.uint64(1)).astype(np.int64) for x in np.split(h, np.cumsum(n)[:-1])]


def texts_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))


def common_levels(texts: DataFrame, size: int = SIZE, buckets: int = BUCKETS) -> np.ndarray:
    """For every counter of the sketch, 0 where it counts like most, else how many doublings it stands above them.
    The counters are fixed in number, summed over all texts, and all that reaches the driver."""
    def count(batches):
        seen = np.zeros(buckets, np.int64)
        for b in slices(batches):
            for s in shingle_sets(b.column(0).to_pylist(), size):
                np.add.at(seen, s & (buckets - 1), 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at])], ["b", "n"])

    got = texts.select("t").mapInArrow(count, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets)
    total[got["b"].to_numpy()] = got["n"].to_numpy()
    middle = np.median(total)
    above = (total - middle) / (DEVIATIONS * np.sqrt(middle + 1))
    return np.where(above > 1, 1 + np.log2(np.maximum(above, 1)), 0).astype(np.int8)


def prefix_length(n: int, share: int = SHARE) -> int:
    return n - -(-share * n // 100) + 1 if n else 0


def heads(texts: DataFrame, levels: np.ndarray, size: int = SIZE, share: int = SHARE) -> DataFrame:
    """(id, n: set size, cid: hash of the whole set, n0: rare shingles of the set, top: level of the prefix's last
    shingle, t: the prefix in order)."""
    sent = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        level = sent.value
        for b in slices(batches):
            out = [[], [], [], [], []]
            for s in shingle_sets(b.column(1).to_pylist(), size):
                lv = level[s & (len(level) - 1)]
                p = prefix_length(len(s), share)
                low = int((lv == 0).sum())
                first = s[lv == 0][:p] if low >= p else s[np.lexsort((s, lv))][:p]
                top = int(level[first[-1] & (len(level) - 1)]) if p else 0
                for col, v in zip(out, (len(s), xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) if p else None, low, top, first.tolist()), strict=True):
                    col.append(v)
            types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(out, types, strict=True)]], ["id", "n", "cid", "n0", "top", "t"])

    return texts.select("id", "t").mapInArrow(run, "id long, n int, cid long, n0 int, top int, t array<long>")


def lists(classes: DataFrame) -> DataFrame:
    """Entries of the inverted lists with at least two sets: (t, id, n, pos, rare, leader).

    Lists of rare shingles are short by the sketch, so one window finds their leaders; those of frequent ones may
    hold any share of the sets and get theirs from a sum with map-side combine.
    """
    e = classes.select("id", "n", (F.col("n0") / F.col("n")).alias("odd"), "n0", F.posexplode("t").alias("pos", "t"))
    rank = F.struct("odd", "id")
    w = Window.partitionBy("t")
    rare = (e.where("pos < n0").select("t", "id", "n", "pos", F.count("*").over(w).alias("c"), F.min(rank).over(w)["id"].alias("leader"))
            .where("c > 1").drop("c").withColumn("rare", F.lit(True)))
    often = e.where("pos >= n0")
    led = often.groupBy("t").agg(F.count("*").alias("c"), F.min(rank)["id"].alias("leader")).where("c > 1").drop("c")
    return rare.unionByName(often.select("t", "id", "n", "pos").join(led, "t").withColumn("rare", F.lit(False)))


def overlaps(pairs: DataFrame, texts: DataFrame, size: int = SIZE) -> DataFrame:
    """``pairs`` (a, b, ...) with ``o``, the number of common shingles, counted on the sets themselves.  A set
    travels once for every pair it is the ``b`` of, and once more for all it is the ``a`` of."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()

    def run(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1).to_pylist(), size)], pa.binary())], ["id", "s"])

    sets = stored(only(texts, stored(ids), "id").dropDuplicates(["id"]).mapInArrow(run, "id long, s binary"))
    theirs = sets.select(F.col("id").alias("b"), F.col("s").alias("sb")).join(maybe_broadcast(pairs), "b")
    mine = only(sets, stored(pairs.select(F.col("a").alias("id")).distinct()), "id").select(F.col("id").alias("a"), F.col("s").alias("sa"))
    both = theirs.join(mine, "a")

    names = pairs.columns
    m = len(names)

    def count(batches):
        for b in slices(batches):
            got = [len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True))
                   for x, y in zip(b.column(m).to_pylist(), b.column(m + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:m], pa.array(got, pa.int32())], [*names, "o"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)
    return both.select(*pairs.columns, "sa", "sb").mapInArrow(count, f"{kinds}, o int")


def needed(share: int, a: str, b: str):
    """Smallest overlap of two sets of sizes ``a`` and ``b`` that reaches the threshold."""
    return F.ceil((F.col(a) + F.col(b)) * share / F.lit(100.0 + share) - 1e-9)


def standing(classes: DataFrame, found: DataFrame, star: DataFrame, member: DataFrame) -> DataFrame:
    """What the first comparisons say of every listed set: (id, c: component so far, p: leader it was compared with, o:
    shingles in common, x: how many of its others it can share with another set of that leader, or null).

    A rare shingle that two sets share stands in a list of both, if the prefixes of both hold all their rare ones.
    So of the shingles outside the leader only the listed rare ones and the frequent ones can be shared.
    """
    own = star.select(F.col("b").alias("id"), F.col("a").alias("p"), "o")
    lead = star.select(F.col("a").alias("id")).distinct().join(own.select("id"), "id", "left_anti")
    known = own.union(lead.join(classes.select("id", "n"), "id").select("id", F.col("id").alias("p"), "n"))
    known = known.join(classes.select(F.col("id").alias("p"), F.col("n0").alias("n0p")), "p")
    listed = found.groupBy("id").agg(F.count(F.when(F.col("rare"), 1)).alias("u"))
    about = listed.join(classes.select("id", "n", "n0", F.size("t").alias("k")), "id").join(known, "id", "left").join(member, "id", "left")
    frequent = F.greatest(F.lit(0), F.col("n") - F.col("n0") - F.col("o") + F.least("n0", "n0p"))
    x = F.when(F.col("n0") <= F.col("k"), F.least(F.col("n") - F.col("o"), F.col("u") + frequent))
    return about.select("id", "p", "o", x.alias("x"), F.coalesce("component_id", "id").alias("c"))


def links(classes: DataFrame, texts: DataFrame, size: int = SIZE, share: int = SHARE) -> DataFrame:
    """Edges (a, b) that connect exactly the components of the similarity graph over distinct sets."""
    found = stored(lists(classes))
    close = f"100 * least(na, nb) >= {share} * greatest(na, nb)"
    met = (found.where("id <> leader").groupBy(F.col("leader").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("c"), F.first("n").alias("nb")))
    sizes = classes.select(F.col("id").alias("a"), F.col("n").alias("na"))
    best = Window.partitionBy("b").orderBy(F.desc("c"), "a")
    star = (met.join(sizes, "a").where(close).withColumn("_r", F.row_number().over(best)).where("_r = 1").select("a", "b", "na", "nb"))
    star = stored(overlaps(stored(star), texts, size))
    sure = star.where(F.col("o") >= needed(share, "na", "nb")).select("a", "b")
    member = maybe_broadcast(stored(components(sure)))
    leading = maybe_broadcast(stored(member.select(F.col("id").alias("leader"), F.col("component_id").alias("lc"))))
    e = (found.join(standing(classes, found, star, member), "id").join(leading, "leader", "left")
         .select("t", "id", "n", "pos", "p", "o", "x", "c", F.coalesce("lc", "leader").alias("lc"),
                 F.floor(F.log("n") / F.log(F.lit(100 / share))).cast("int").alias("block")))
    side = lambda k: [F.col(c).alias(f"{c}{k}") for c in ("n", "pos", "p", "o", "x", "c")]
    rest = e.where("c <> lc").select("t", F.col("id").alias("b"), *side("b"), F.explode(F.array(*[F.col("block") + k for k in (-1, 0, 1)])).alias("block"))
    every = e.select("t", "block", F.col("id").alias("a"), *side("a"), "lc")
    room = F.least("posa", "posb") + F.least(F.col("na") - F.col("posa"), F.col("nb") - F.col("posb"))
    met = F.expr("(pa <=> b) or (pb <=> a)")                         # compared already
    beyond = F.when(F.col("xa").isNotNull() & F.col("xb").isNotNull(), F.least("xa", "xb")).otherwise(F.least(F.col("na") - F.col("oa"), F.col("nb") - F.col("ob")))
    hopeless = F.coalesce((F.col("pa") == F.col("pb")) & (F.least("oa", "ob") + beyond < needed(share, "na", "nb")), F.lit(False))
    pair = rest.join(every, ["t", "block"]).where("ca <> cb and (ca = lc or a < b)").where(close).where(room >= needed(share, "na", "nb")).where(~met & ~hopeless)
    left = {x: F.floor(F.col(f"n{x}") * share / F.lit(100.0) + (1 - 1e-9)) - 1 for x in "ab"}     # shingles after the prefix
    pair = pair.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.count("*").alias("hits"), F.max(F.greatest("na", "nb")).alias("hi"), F.max(F.col("na") + F.col("nb")).alias("both"))
    pair = pair.where(F.col("hits") + F.ceil(F.col("hi") * share / F.lit(100.0)) - 1 >= F.ceil(F.col("both") * share / F.lit(100.0 + share) - 1e-9)).select("a", "b", "hits")
    about = classes.select("id", "n", "top", F.element_at("t", -1).alias("end"))
    for x in "ab":
        pair = pair.join(about.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("top").alias(f"top{x}"), F.col("end").alias(f"end{x}")), x)
    after = F.when(F.struct("topa", "enda") <= F.struct("topb", "endb"), left["a"]).otherwise(left["b"])
    pair = pair.where(F.col("hits") + after >= needed(share, "na", "nb")).select("a", "b", "na", "nb")
    answers = star.select(F.col("b").alias("id"), F.col("a").alias("p"), "o", F.col("na").alias("np"))
    answers = answers.union(star.select(F.col("a").alias("id"), F.col("a").alias("p"), F.col("na").alias("o"), F.col("na").alias("np")).distinct())
    for x in "ab":
        pair = pair.join(answers.groupBy(F.col("id").alias(x)).agg(F.collect_list(F.struct("p", "o", "np")).alias(f"ans{x}")), x, "left")
    same = F.flatten(F.transform(F.coalesce("ansa", F.array().cast("array<struct<p:bigint,o:int,np:int>>")), lambda x: F.transform(
        F.filter(F.coalesce("ansb", F.array().cast("array<struct<p:bigint,o:int,np:int>>")), lambda y: y["p"] == x["p"]), lambda y: F.struct(
            (F.least(x["o"], y["o"]) + F.least(F.col("na") - x["o"], F.col("nb") - y["o"])).alias("most"), (x["o"] + y["o"] - x["np"]).alias("least")))))
    pair = pair.select("a", "b", "na", "nb", needed(share, "na", "nb").alias("need"), same.alias("known"))
    pair = stored(pair.where(~F.exists("known", lambda k: k["most"] < F.col("need"))).select(
        "a", "b", "na", "nb", "need", F.exists("known", lambda k: k["least"] >= F.col("need")).alias("settled")))
    checked = overlaps(pair.where("not settled").select("a", "b", "need"), texts, size).where("o >= need")
    return sure.union(pair.where("settled").select("a", "b")).union(checked.select("a", "b"))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, share: int = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Words are runs between white space, A-Z lower-cased; a set holds the distinct runs of ``size`` words, or all
    words as one where there are fewer.  Two texts link when 100 * common >= share * union; component_id is the
    smallest doc_id reachable by links.  Null and empty texts have no shingles and only themselves; rows that repeat
    a doc_id each count with their own set; rows with a null key are left out; other columns play no part.
    """
    texts = texts_of(docs, key, text)
    with small_batches(docs.sparkSession):
        head = stored(heads(texts, common_levels(texts, size), size, share))
        classes = stored(head.where("n > 0").groupBy("cid").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("n0").alias("n0"), F.first("top").alias("top"), F.first("t").alias("t")))
        found = components(links(classes, texts, size, share))
    named = classes.select("cid", F.col("id").alias("rep")).join(found.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("cid", F.coalesce("component_id", "rep").alias("component_id"))
    return head.select("id", "n", "cid").join(named, "cid", "left").select(
        F.col("id").cast(docs.schema[key].dataType).alias(key), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` without those that follow another of their component; rows with a null key stay.  Of rows that repeat
    a doc_id and are in one component, the one whose text has the smallest hash stays."""
    out = join(docs, key, text, **options)
    twice = stored(out.groupBy(key, "component_id").agg(F.count("*").alias("n")).where("n > 1").select(key).distinct())
    left = without(docs, stored(out.where(F.col(key) != F.col("component_id")).select(key).distinct()), key)
    if twice.isEmpty():
        return left
    again = only(left, twice, key)
    ranked = Window.partitionBy(key).orderBy(F.xxhash64(text), text)
    rank = "rank_" + "".join(docs.columns)
    return without(left, twice, key).union(again.withColumn(rank, F.row_number().over(ranked)).where(F.col(rank) == 1).drop(rank))
