"""Line dedup: winnowed line hashes find repeated runs of lines, which are deleted wherever they come again.

A window reaches from a line onwards until its lines hold ``min_words`` words; another reaches from a line backwards.  The
smallest line hash in a window is its fingerprint (of equal ones the last): neighbouring windows mostly share it, and
any run of lines that holds ``min_words`` words and stands elsewhere too gives the same fingerprints there.
Fingerprints are counted over all texts; windows whose fingerprint has one place only are out.  The places of the rest are joined on
the window's content: a match at a fingerprint extends forwards as far as windows that start in the run reach, and
backwards as far as those that end in it do.  A repeated run of any length is exactly the union of the windows in it,
wherever it stands earlier: each window looks for its own earliest place, so no text that shares only a part hides another.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import once, stored
from boxloom.scale import maybe_broadcast

MIN_WORDS = 20


def line_words(line: Column) -> Column:
    """Number of words of a line, by its single spaces."""
    t = F.trim(line)
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1)


def hashed_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_k, a): for every place (key and hash of the text) its lines that have words, as (i: number of the line, h: hash, n: words)."""
    place = F.struct(F.col(key).alias("k"), F.xxhash64(text).alias("t"))
    lines = docs.where(F.col(key).isNotNull() & (F.length(text) > 0)).select(place.alias("_k"), once(F.split(text, "\n")).alias("_l"))
    a = F.transform("_l", lambda x, i: F.struct(i.alias("i"), F.xxhash64(F.trim(x)).alias("h"), line_words(x).alias("n")))
    return lines.select("_k", F.filter(a, lambda x: x["n"] > 0).alias("a"))


def each_place(lines: DataFrame) -> DataFrame:
    """``lines`` with one row per place: rows that repeat both key and text are one."""
    twice = maybe_broadcast(stored(lines.groupBy("_k").count().where("count > 1").select("_k")))
    if twice.isEmpty():
        return lines
    return stored(lines.join(twice, "_k", "left_anti").union(lines.join(twice, "_k", "left_semi").dropDuplicates(["_k"])))


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """One row per window: (_k, p: place of its first line in ``a``, c: lines, f: fingerprint, at: its place, content)."""
    def reach(near):
        """Lines of ``near`` until they hold enough words, their words, and the words of the last."""
        start = F.struct(F.lit(0).alias("t"), F.lit(0).alias("c"), F.lit(0).alias("n"))
        return F.aggregate(near, start, lambda acc, y: F.when(acc["t"] >= min_words, acc).otherwise(
            F.struct((acc["t"] + y["n"]).alias("t"), (acc["c"] + 1).alias("c"), y["n"].alias("n"))))

    def onwards(x, p):                                       # every line has a word, so ``min_words`` lines are enough
        full = reach(F.slice("a", p + 1, F.lit(min_words)))
        return F.when(full["t"] >= min_words, F.struct(p.alias("p"), full["c"].alias("c")))

    def backwards(x, p):                                     # those that also reach onwards just as far are there already
        start = F.greatest(p + 2 - min_words, F.lit(1))
        near = F.slice("a", start, p + 2 - start)
        full = reach(F.reverse(near))
        words = F.aggregate(F.slice("a", p + 2 - full["c"], full["c"] - 1), F.lit(0), lambda acc, y: acc + y["n"])
        return F.when((full["t"] >= min_words) & (words >= min_words), F.struct((p + 1 - full["c"]).alias("p"), full["c"].alias("c")))

    both = F.concat(F.array_compact(F.transform("a", onwards)), F.array_compact(F.transform("a", backwards)))
    found = lines.select("_k", "a", F.explode(both).alias("w"))
    hashes = F.transform(F.slice("a", F.col("w.p") + 1, F.col("w.c")), lambda y: y["h"])
    found = found.select("_k", "w.p", "w.c", once(hashes).alias("hs"))
    low = F.array_min("hs")
    return found.select("_k", "p", "c", low.alias("f"), (F.col("p") + F.col("c") - F.array_position(F.reverse("hs"), low)).cast("int").alias("at"),
                        F.xxhash64("hs").alias("content"))


def repeated(lines: DataFrame, min_words: int) -> DataFrame:
    """Windows that stand earlier too: (_k, p, last)."""
    found = windows(lines, min_words)
    place = F.struct("_k", "at")
    # Both sums are stored: a join right above its own aggregate could not be split where one fingerprint is very common.
    again = stored(found.groupBy("f").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("f"))
    known = found.join(maybe_broadcast(again), "f", "left_semi")
    first = known.groupBy("content").agg(F.min(F.struct("_k", "p")).alias("o"), F.max(F.struct("_k", "p")).alias("z")).where("o <> z").drop("z")
    first = maybe_broadcast(stored(first))
    return known.join(first, "content").where(F.struct("_k", "p") > F.col("o")).select("_k", "p", (F.col("p") + F.col("c") - 1).alias("last"))


def gone_lines(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """(_k, gone): of every place that loses some, the numbers of its lines that go."""
    lines = each_place(stored(hashed_lines(docs, key, text)))
    runs = repeated(lines, min_words).groupBy("_k").agg(F.collect_list(F.struct("p", "last")).alias("runs"))
    places = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["p"], r["last"]))))
    return runs.join(lines, "_k").select("_k", F.array_sort(F.transform(places, lambda p: F.get("a", p)["i"])).alias("gone"))


def deleted_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, gone): numbers of the lines, from 0, that belong to a run of at least ``min_words`` words that stands
    earlier, in this text or another; texts that lose nothing are absent.  Earlier is by doc_id, then by the hash of the text (where texts
    share a doc_id, each has a row), then by place."""
    return gone_lines(docs, key, text, min_words).select(F.col("_k.k").alias(key), "gone")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, lines: str = "n_lines", deleted: str = "n_deleted") -> DataFrame:
    """``docs`` with repeated runs deleted from ``text``, one row per row; the columns ``lines`` and ``deleted`` (lines before, lines
    gone) come last and take the place of others of those names.

    The first place of a run, by doc_id and then line, keeps it; the same holds within one text.  White space
    at a line's ends plays no part in comparisons; lines without words belong to no run and stay.  Null and empty
    texts stay as they are with 0 lines; so do rows with a null key.  Rows that repeat a doc_id with another text are places
    of their own, by the hash of the text; rows that repeat both are one place and are cut alike.  Other columns pass through.
    """
    was, at, cut = (f"{name}_{''.join(docs.columns)}" for name in ("key", "hash", "gone"))       # names that no column has
    gone = stored(gone_lines(docs, key, text, min_words)).select(F.col("_k.k").alias(was), F.col("_k.t").alias(at), F.col("gone").alias(cut))
    d = docs.join(maybe_broadcast(gone), (F.col(key) == F.col(was)) & (F.xxhash64(text) == F.col(at)), "left")
    split = F.split(F.col(text), "\n")
    n = F.when(F.length(text) > 0, F.size(split)).otherwise(0)
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(cut))
    new = F.when(F.col(cut).isNull(), F.col(text)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n"))
    return d.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns if c not in (lines, deleted)], n.cast("long").alias(lines),
                    F.when(F.col(cut).isNull(), 0).otherwise(F.size(cut)).cast("long").alias(deleted))


def counted(deduped: DataFrame, text: str = "text", count: str = "n_chars", deleted: str = "n_deleted") -> Column:
    """The column that holds a text's length, brought up to date where lines went."""
    return F.when(F.col(deleted) > 0, F.length(text).cast(deduped.schema[count].dataType)).otherwise(F.col(count))
