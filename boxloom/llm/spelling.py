"""Spelling variants: words one edit apart, found with asymmetric q-chunks.

Of two words one edit apart, the longer is cut into two disjoint chunks; the edit leaves one of them whole.  The other
word gives its positional grams: those as long as a chunk of a word of its own length, or of one character more, that
stand where such a chunk can stand, which is shifted by no more than one.  Chunks and grams meet in an equality join;
what meets is verified.

A chunk that very many words share is not paired out: its words agree on the chunk, so the edit lies in the
rest of the word, which is cut into two chunks in turn, and the words meet on both.  That goes on until a chunk's words are
few or the rest is one character, when all that meet differ in that character alone.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import LOWER, UPPER, stored
from boxloom.scale import maybe_broadcast

LONG_ENOUGH = 5        # code points of a word at least
OFTEN_ENOUGH = 3       # occurrences of a word at least
ONE_IN = 97            # runs whose checksum this divides lose a code point
TIMES = 2              # a word's form occurs at least so many times as often
MEET = 1 << 14         # pairs that a chunk's words may make before the rest of the words is cut again
KEPT = 300_000         # words that a task counts before it passes its counts on
RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = str.maketrans(UPPER, LOWER)


def word_of(run: str, doc_id: str, one_in: int = ONE_IN) -> str:
    """A lower-cased run as the word it counts for."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % one_in:
        return run
    cut = h % len(run)
    return run[:cut] + run[cut + 1:]


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LONG_ENOUGH, often: int = OFTEN_ENOUGH, one_in: int = ONE_IN) -> DataFrame:
    """(word, n) over all whole texts.  Every task adds up its own counts before they are shuffled."""
    def run(batches):
        total = Counter()

        def flush():
            words, n = list(total), list(total.values())
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for r, n in Counter(x for x in RUN.findall(t.translate(SMALL)) if len(x) >= least).items():
                    word = word_of(r, k, one_in)
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= KEPT:
                    yield flush()
        yield flush()

    rows = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def part(c, start, stop):
    return F.substring(c, start + 1, stop - start)


def chunks(x: DataFrame) -> DataFrame:
    """The words of ``x``, whose edit lies in [a, b), with each of the two chunks of it kept and the edit in the other."""
    m = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    left = F.struct(F.xxhash64("k", F.lit(0), part("w", F.col("a"), m)).alias("k"), m.alias("a"), F.col("b"))
    right = F.struct(F.xxhash64("k", F.lit(1), part("w", m, F.col("b"))).alias("k"), F.col("a"), m.alias("b"))
    return x.select("w", "n", F.explode(F.array(left, right)).alias("s")).select("w", "n", "s.*")


def grams(y: DataFrame) -> DataFrame:
    """The words of ``y`` with the grams that stand where the chunks of ``chunks`` stand; ``d`` is how much longer the word
    is than the one with the chunks (0 or -1), and the shift of what lies behind the edit."""
    m = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    left = F.struct(F.xxhash64("k", F.lit(0), part("w", F.col("a"), m)).alias("k"), m.alias("a"), F.col("b"))
    right = F.struct(F.xxhash64("k", F.lit(1), part("w", m + F.col("d"), F.col("b") + F.col("d"))).alias("k"), F.col("a"), m.alias("b"))
    return y.select("w", "n", "d", F.explode(F.array(left, right)).alias("s")).select("w", "n", "d", "s.*")


def near_pairs(words: DataFrame, meet: int = MEET) -> DataFrame:
    """(w, n, v, m): every pair of the distinct words that are exactly one edit apart, once, with their counts."""
    size = F.length("w")
    both = words.select(F.col("word").alias("w"), "n")
    x = chunks(both.select("w", "n", F.xxhash64(size).alias("k"), F.lit(0).alias("a"), size.alias("b")))
    lengths = F.explode(F.array(F.lit(0), F.lit(-1)))
    y = grams(both.select("w", "n", lengths.alias("d")).select("w", "n", "d", F.xxhash64(size - F.col("d")).alias("k"), F.lit(0).alias("a"), (size - F.col("d")).alias("b")))
    found = None
    while True:
        x, y = stored(x), stored(y)
        sizes = x.select("k", F.lit(1).alias("cx"), F.lit(0).alias("cy"), (F.col("b") - F.col("a")).alias("r")).union(
            y.select("k", F.lit(0), F.lit(1), F.lit(0))).groupBy("k").agg(F.sum("cx").alias("cx"), F.sum("cy").alias("cy"), F.max("r").alias("r"))
        hot = stored(sizes.where((F.col("cx") * F.col("cy") > meet) & (F.col("r") > 1)).select("k"))
        last = hot.isEmpty()
        side = maybe_broadcast(hot)
        cool, calm = (x, y) if last else (x.join(side, "k", "left_anti"), y.join(side, "k", "left_anti"))
        one = cool.select("k", "w", "n").join(calm.select("k", "d", F.col("w").alias("v"), F.col("n").alias("m")), "k")
        one = one.where(((F.col("d") < 0) | (F.col("w") < F.col("v"))) & (F.length("v") == F.length("w") + F.col("d")))
        one = one.where(F.levenshtein("w", "v", 1) == 1).select("w", "n", "v", "m")
        found = one if found is None else found.union(one)
        if last:
            return found.dropDuplicates(["w", "v"])
        x, y = chunks(x.join(side, "k", "left_semi")), grams(y.join(side, "k", "left_semi"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following (word, form) ends.  A form is more frequent than its word by a factor, so chains are
    short and have no rings; each round doubles the steps taken."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = stored(at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LONG_ENOUGH, often: int = OFTEN_ENOUGH,
          one_in: int = ONE_IN, times: int = TIMES, meet: int = MEET) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word.

    ``form`` is the near word that occurs most (the smallest in code-point order of those), if at least ``times`` as often as
    the word; ``root`` is where forms lead to, the word itself where it has none.  Null and empty texts have no words, a
    null doc_id counts as an empty one in the checksum, repeated rows count as rows, runs of any length are words, other
    columns play no part; an empty table gives an empty result.
    """
    words = stored(counted(docs, key, text, least, often, one_in))
    pairs = stored(near_pairs(words, meet))
    sides = F.explode(F.array(F.struct(F.col("w").alias("word"), F.col("v").alias("o"), F.col("m").alias("c")), F.struct(F.col("v").alias("word"), F.col("w").alias("o"), F.col("n").alias("c"))))
    near = pairs.select(sides.alias("s")).select("s.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("c")).alias("c"), "o")).alias("best"))
    fits = -F.col("best.c") >= times * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", F.when(fits, F.col("best.o")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, -F.col("best.c")).alias("form_n"))
    out = stored(out)
    led = roots(out.where("form is not null"))
    return out.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
