"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment of shingles.

The sets searched for are test items; a text holds an item when it has at least 0.8 of the item's shingles of five
words.  Items are partitioned by size.  An item of q shingles is signed by its smallest hashes, as many as are
needed that a text with 0.8 of the shingles cannot miss all of them (q - ceil(0.8 q) + 1, fixed per partition by
its largest size), so the length of the text plays no part and nothing is missed.  Texts are hashed once and met
with the signatures; what shares one is verified on the words themselves.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm.common import once, only, stored, without
from boxloom.scale import maybe_broadcast

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = 5
SHARE = 80             # in hundredths


def words_of(text: Column) -> Column:
    """Words of a text in lower case: runs of digits, letters and non-ASCII characters."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def shingled(words: DataFrame, make, size: int) -> DataFrame:
    """``words`` (columns and w: array of words) with one row for every run of ``size`` words, ``make`` of it in
    place of w; none where there are fewer.  Explode and projection stay in one generated loop."""
    rest = [c for c in words.columns if c != "w"]
    at = words.where(F.size("w") >= size).select(*words.columns, F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("_i"))
    return at.select(*rest, make(*[F.get("w", F.col("_i") + j) for j in range(size)]))


def as_text(*words: Column) -> Column:
    return F.concat_ws(" ", *words).alias("shingle")


def item_shingles(items: DataFrame, key: str = "item_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """Distinct shingles of every item: (item, shingle, h, q).  Items with fewer words than a shingle hold none."""
    w = items.where(F.col(key).isNotNull()).select(F.col(key).alias("item"), once(words_of(F.col(text))).alias("w"))
    s = shingled(w, as_text, size).distinct()
    return s.select("*", F.xxhash64(*[F.get(F.split("shingle", " "), F.lit(j)) for j in range(size)]).alias("h"),
                    F.count("*").over(Window.partitionBy("item")).alias("q"))


def signatures(shingles: DataFrame, share: int = SHARE) -> DataFrame:
    """The smallest hashes of every item: (h, item, q).  A partition holds sizes from one power of two to the next;
    its largest size sets how many hashes each of its items gives, never fewer than the item itself needs."""
    top = F.pow(F.lit(2.0), F.floor(F.log2("q")) + 1) - 1
    needed = F.floor(top - F.ceil(top * share / 100) + 1)
    rank = F.row_number().over(Window.partitionBy("item").orderBy("h", "shingle"))
    return shingles.select("h", "item", "q", rank.alias("r"), needed.alias("k")).where("r <= k").select("h", "item", "q")


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
         item_text: str = "text", size: int = WORDS, share: int = SHARE) -> DataFrame:
    """Items held by texts: (doc_id, item_id, n_item, n_shared, containment), one row per pair with
    100 * n_shared >= share * n_item.

    Null and empty texts, texts and items with fewer than five words, and empty tables give no rows.  Rows that
    repeat a doc_id count as one text with the shingles of all; items that repeat an item_id likewise.  Other
    columns are ignored.  Item tables are broadcast only when they are proven small.
    """
    shingles = item_shingles(items, item_key, item_text, size)
    shingles = stored(shingles)
    signed = maybe_broadcast(signatures(shingles, share))
    w = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), once(words_of(F.col(text))).alias("w"))
    met = shingled(w, lambda *x: F.xxhash64(*x).alias("h"), size)
    candidates = stored(met.join(signed, "h").select("_k", "item").distinct())
    texts = only(w, candidates.select("_k").distinct(), "_k")
    held = shingled(texts, as_text, size)
    known = maybe_broadcast(shingles.select("shingle", "item", "q"))
    shared = held.join(known, "shingle").groupBy("_k", "item", "q").agg(F.count_distinct("shingle").alias("n"))
    return (shared.where(F.col("n") * 100 >= F.col("q") * share)
            .select(F.col("_k").alias(key), F.col("item").alias(item_key), F.col("q").cast("long").alias("n_item"),
                    F.col("n").cast("long").alias("n_shared"), (F.col("n") / F.col("q")).alias("containment")))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that hold no item; rows with a null key stay."""
    return without(docs, stored(find(docs, items, key, text, **options).select(key).distinct()), key)
