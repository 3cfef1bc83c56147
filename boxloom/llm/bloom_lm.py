"""Language-model scoring from a log-frequency Bloom filter.

Words and pairs of neighbouring words are counted over all training texts.  A count c is kept as its level
1 + floor(log2 c): the filter holds (n-gram, 1), ..., (n-gram, level), so probing level after level until one is
missing gives the count back, rounded, and never too small.  The filter is made in segments, each by the task that
merged the counts of its n-grams, and is as large as its entries need.  As many segments as may travel at once are
broadcast to the workers, where smoothed probabilities come from repeated probes; where there are more, the texts are
read once for each such group of segments, and what the groups add to a text's score is summed.

The model knows every word.  Frequent words have short ids, and their exact counts travel with the filter; any other
word goes by its hash.  The plain unigram score beside it is exact for every word: counts of the words that are not
frequent are joined.
"""
from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import WordHashes as WordHashes
from boxloom.llm.common import lowered_hashes, mix, stored

KNOWN = 65_000         # frequent words; ids stay below 2 ** 16 with the two classes below
ALONE = 65_535         # stands before a word that is counted by itself
PROBES = 3             # bits per level
MOST_BITS = 1 << 28    # of the filter that are broadcast at once, 32 MB; a larger filter goes in several passes
PER_SEGMENT = 4_000_000      # training tokens for each segment of the filter
PRIOR = 20.0           # weight of the word's own probability against what follows the word before
CHUNK = 4 << 20        # bytes of text that are worked on at once
TAIL = np.uint64(1 << 63)      # set in the ids of words that are not frequent


def in_training(key):
    return (F.crc32(F.col(key).cast("string")) % 7) != 2


def chunks(texts: list[bytes], limit: int = CHUNK):
    """Runs of texts of about ``limit`` bytes, as (first, last + 1)."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Sums:
    """Counts by key; hands out what it holds when that grows too large."""

    def __init__(self, most: int = 1_000_000):
        self.most, self.parts, self.size = most, [], 0

    def add(self, keys: np.ndarray, n: np.ndarray):
        self.parts.append((keys, n))
        self.size += len(keys)
        if self.size > self.most:
            merged = self.take()
            if len(merged[0]) > self.most // 2:
                yield merged
            else:
                self.parts, self.size = [merged], len(merged[0])

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, back = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        n = np.bincount(back, np.concatenate([n for _, n in self.parts])).astype(np.int64)
        self.parts, self.size = [], 0
        return keys, n


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, n): how often each word stands in ``texts`` (t: binary)."""
    def run(batches):
        sums = Sums()
        out = lambda x: pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1])], ["h", "n"])
        for b in batches:
            rows = b.column(0).to_pylist()
            for i, j in chunks(rows):
                keys, n = np.unique(lowered_hashes(rows[i:j])[0], return_counts=True)
                yield from map(out, sums.add(keys, n))
        if sums.parts:
            yield out(sums.take())

    return texts.select("t").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """What scoring needs: the frequent words' hashes in order with their counts, totals, and segments of the filter."""

    words: np.ndarray
    counts: np.ndarray
    ends: int
    tokens: int
    types: int
    bits: np.ndarray
    starts: np.ndarray       # first bit of each segment in ``bits``
    sizes: np.ndarray        # bits of each segment
    held: np.ndarray         # whether ``bits`` has the segment

    @property
    def other(self) -> int:
        return len(self.words)

    @property
    def end(self) -> int:
        return len(self.words) + 1

    def ids(self, h: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, h)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == h, at, self.other) if len(self.words) else np.zeros(len(h), np.int64)

    def codes(self, h: np.ndarray) -> np.ndarray:
        """Ids of all words: short ones of the frequent, hashes of the others."""
        at = self.ids(h)
        return np.where(at == self.other, h | TAIL, at.astype(np.uint64))

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Levels of distinct n-gram keys of segments that are held, by probing until one is missing."""
        out = np.zeros(len(keys), np.int64)
        live = np.arange(len(keys))
        for level in range(1, 64):
            part, at = slots(keys[live], level, self.sizes)
            here = np.ones(len(live), bool)
            for a in at:
                bit = self.starts[part] + a
                here &= (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            live = live[here & (self.sizes[part] > 0)]
            if not len(live):
                break
            out[live] = level
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Counts as the filter has them: the middle of the level's range, 0 for none."""
        distinct, back = np.unique(keys, return_inverse=True)
        q = self.level(distinct)
        return np.where(q > 0, 0.75 * 2.0 ** q - 0.5, 0.0)[back]

    def log10(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """What the segments that are held add to the log10 probability of each id after the one before it.

        A probability is (pair + PRIOR * own) / (context + PRIOR).  The pair of a word that is not frequent lies in
        the segment of its own count; where the word before is not frequent, the divisor is of that word's segment.
        """
        out = np.zeros(len(ids))
        exact = np.append(self.counts, [0, self.ends]).astype(float)
        key, alone = pair_keys(before, ids), np.uint64(ALONE)
        at = np.flatnonzero(self.held[segment_of(key, len(self.sizes))])
        key, word, ahead = key[at], ids[at], before[at]
        pair = self.count(key)
        own, rare = exact[np.where(word < TAIL, word, self.other).astype(np.int64)], word >= TAIL
        own[rare] = self.count(pair_keys(alone, word[rare]))
        value = np.log10(pair + PRIOR * (own + 1) / (self.tokens + self.types + 1))
        common = ahead < TAIL
        value[common] -= np.log10(np.maximum(exact[ahead[common].astype(np.int64)], pair[common]) + PRIOR)
        out[at] = value
        at = np.flatnonzero(before >= TAIL)
        key = pair_keys(alone, before[at])
        mine = self.held[segment_of(key, len(self.sizes))]
        out[at[mine]] -= np.log10(self.count(key[mine]) + PRIOR)
        return out


def pair_keys(before, ids: np.ndarray) -> np.ndarray:
    """Key of each id after the one before it.  Short ids are put together; the key of a word that is not frequent
    begins with bits of its own hash, and so do all keys of that word."""
    before = np.broadcast_to(np.asarray(before, np.uint64), ids.shape)
    out = before << np.uint64(16) | ids
    tail = ids >= TAIL
    far = np.flatnonzero(tail | (before >= TAIL))
    x = mix(mix(before[far]) + ids[far] * np.uint64(3))
    own = ids[far] >> np.uint64(43) << np.uint64(43) | x >> np.uint64(21)      # bit 63 is set in the id
    out[far] = np.where(tail[far], own, np.uint64(1 << 62) | x >> np.uint64(2))
    return out


def segment_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Segment of each key; all keys of a word that is not frequent share one."""
    return (mix(np.where(keys >= TAIL, keys >> np.uint64(43), keys) + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def slots(keys: np.ndarray, level: int, sizes: np.ndarray):
    """Segment of each key, and its bits for a level within the segment."""
    h = mix(keys + np.uint64(1))
    part = segment_of(keys, len(sizes))
    room = np.maximum(sizes[part], 1).astype(np.uint64)
    x = mix(h ^ np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    y = mix(x) | np.uint64(1)
    return part, [((x + np.uint64(i) * y) % room).astype(np.int64) for i in range(PROBES)]


def segments(texts: DataFrame, known: int = KNOWN) -> tuple[Model, DataFrame, DataFrame]:
    """The model learned from ``texts`` (t: binary) without its filter, the exact counts of all words (h, n), and the
    filter's segments (part, bits).  To the driver come the frequent words (at most ``known``), three sums, and the
    segments' sizes."""
    spark = texts.sparkSession
    counts = stored(word_counts(texts))
    ends = texts.count()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = counts.orderBy(F.desc("n"), "h").limit(known).toArrow()
    words, n = head["h"].to_numpy().view(np.uint64), head["n"].to_numpy()
    order = np.argsort(words)
    model = Model(words[order], n[order], ends, int(total[0]) + ends, int(total[1]) + (ends > 0), np.zeros(1, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64),
                  np.ones(1, bool))
    parts = max(1, -(-model.tokens // PER_SEGMENT))
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        sums, m = Sums(), sent.value

        def out(x):
            keys, n = x
            part = segment_of(keys, parts)
            sort = np.lexsort((keys, part))
            keys, n, part = keys[sort], n[sort], part[sort]
            cut = np.searchsorted(part, np.arange(parts + 1))
            full = [p for p in range(parts) if cut[p] < cut[p + 1]]
            own = [keys[cut[p]:cut[p + 1]] for p in full]
            near = [np.searchsorted(k, np.uint64(1 << 32)) for k in own]
            steps = [np.diff(k[:c], prepend=np.uint64(0)).astype(np.uint32).tobytes() for k, c in zip(own, near, strict=True)]
            far = [k[c:].tobytes() for k, c in zip(own, near, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(steps, pa.binary()), pa.array(far, pa.binary()), pa.array(
                [n[cut[p]:cut[p + 1]].astype(np.uint32).tobytes() for p in full], pa.binary())], ["part", "steps", "far", "n"])

        for b in batches:
            rows = b.column(0).to_pylist()
            for i, j in chunks(rows):
                ids, before = laid_out(m, *lowered_hashes(rows[i:j]))
                keys, n = np.unique(np.concatenate([pair_keys(before, ids), pair_keys(ALONE, ids)]), return_counts=True)
                yield from map(out, sums.add(keys, n))
        if sums.parts:
            yield out(sums.take())

    def segment(table: pa.Table) -> pa.Table:
        keys = np.concatenate([k for x, y in zip(table["steps"].to_pylist(), table["far"].to_pylist(), strict=True) for k in (
            np.cumsum(np.frombuffer(x, np.uint32), dtype=np.uint64), np.frombuffer(y, np.uint64))])
        n = np.concatenate([np.frombuffer(x, np.uint32) for x in table["n"].to_pylist()])
        keys, back = np.unique(keys, return_inverse=True)
        q = 1 + np.floor(np.log2(np.bincount(back, n))).astype(np.int64)
        size = int(np.ceil(q.sum() * PROBES / np.log(2))) + 7 & ~7
        sizes = np.full(parts, size, np.int64)
        bits = np.zeros(size >> 3, np.uint8)
        for level in range(1, int(q.max()) + 1):
            for a in slots(keys[q >= level], level, sizes)[1]:
                np.bitwise_or.at(bits, a >> 3, (1 << (a & 7)).astype(np.uint8))
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    made = stored(texts.select("t").mapInArrow(run, "part int, steps binary, far binary, n binary").groupBy("part").applyInArrow(segment, "part int, bits binary"))
    model.sizes, model.held = np.zeros(parts, np.int64), np.zeros(parts, bool)
    for part, size in made.select("part", F.length("bits").cast("long") * 8).collect():
        model.sizes[part] = size
    return model, counts, made


def passes(sizes: np.ndarray, most_bits: int) -> list[np.ndarray]:
    """Segments that are broadcast together: runs of at most ``most_bits``, or one segment."""
    out, bits = [[]], 0
    for part, size in enumerate(sizes.tolist()):
        if out[-1] and bits + size > most_bits:
            out.append([])
            bits = 0
        out[-1].append(part)
        bits += size
    return [np.array(x) for x in out]


def holding(model: Model, made: DataFrame, parts: np.ndarray) -> Model:
    """``model`` with some of the segments ``made``."""
    table = made.where(F.col("part").between(int(parts[0]), int(parts[-1]))).toArrow()
    got = dict(zip(table["part"].to_pylist(), table["bits"].to_pylist(), strict=True))
    starts, held = np.zeros(len(model.sizes), np.int64), np.zeros(len(model.sizes), bool)
    held[parts], starts[parts] = True, np.cumsum(model.sizes[parts]) - model.sizes[parts]
    return replace(model, bits=np.frombuffer(b"".join(got.get(p, b"") for p in parts.tolist()) or b"\0", np.uint8), starts=starts, held=held)


def train(texts: DataFrame, known: int = KNOWN) -> tuple[Model, DataFrame]:
    """The model learned from ``texts`` (t: binary) with its whole filter, and the exact counts of all words (h, n)."""
    model, counts, made = segments(texts, known)
    return holding(model, made, np.arange(len(model.sizes))), counts


def laid_out(model: Model, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts with an end after each, and the id before each (an end before the first)."""
    ids = np.full(len(h) + len(n), model.end, np.uint64)
    last = np.cumsum(n + 1) - 1
    inner = np.ones(len(ids), bool)
    inner[last] = False
    ids[inner] = model.codes(h)
    return ids, np.concatenate([[np.uint64(model.end)], ids[:-1]]).astype(np.uint64)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (key, row, n_tokens, n_head, head: sum of log10(count + 1) over frequent words and
    ends, score: what the model's segments add, digest of the text, tail: other words' hashes, times)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        m = sent.value
        weight = np.append(np.log10(m.counts + 1.0), [0.0, np.log10(m.ends + 1.0)])
        counted = np.append(np.ones(len(m.counts)), [0.0, float(m.ends > 0)])
        for b in batches:
            rows = b.column(1).to_pylist()
            for i, j in chunks(rows):
                h, n = lowered_hashes(rows[i:j])
                ids, before = laid_out(m, h, n)
                first = np.cumsum(n + 1) - (n + 1)
                total = lambda x: np.add.reduceat(x, first)
                at = np.where(ids < TAIL, ids, m.other).astype(np.int64)
                rare = np.split(np.where(m.ids(h) == m.other, h, 0), np.cumsum(n)[:-1])
                tails = [np.unique(r[r > 0], return_counts=True) for r in rare]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, j - i), pa.array(n + 1), pa.array(total(counted[at]).astype(np.int64)), pa.array(total(weight[at])),
                    pa.array(total(m.log10(ids, before))), pa.array([xxhash.xxh3_128_digest(t) for t in rows[i:j]], pa.binary()), pa.array([t[0].view(np.int64) for t in tails], pa.list_(pa.int64())),
                    pa.array([t[1].astype(np.int32) for t in tails], pa.list_(pa.int32()))], ["k", "n_tokens", "n_head", "head", "score", "digest", "tail", "times"])

    t = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    out = t.mapInArrow(run, f"k {kind}, n_tokens long, n_head long, head double, score double, digest binary, tail array<long>, times array<int>")
    return stored(out.withColumn("row", F.monotonically_increasing_id()))


def added(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(digest, score): what the segments of a further pass add to each text; equal texts come once."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for b in batches:
            rows = b.column(0).to_pylist()
            for i, j in chunks(rows):
                h, n = lowered_hashes(rows[i:j])
                ids, before = laid_out(m, h, n)
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(t) for t in rows[i:j]], pa.binary()), pa.array(
                    np.add.reduceat(m.log10(ids, before), np.cumsum(n + 1) - (n + 1)))], ["digest", "score"])

    t = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    return stored(t.mapInArrow(run, "digest binary, score double").groupBy("digest").agg(F.max("score").alias("score")))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", known: int = KNOWN, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Words are runs between white space, A-Z lower-cased, and an end closes every text; rows whose crc32(doc_id)
    leaves 2 modulo 7 are not learned from.  ``base_score`` is the exact add-one unigram score, ``score`` the
    filter's.  Null and empty texts are an end alone; rows that repeat count as rows; a null doc_id is held out.
    Without training rows every count is 0.  Other columns play no part.
    """
    learned = docs.where(in_training(key)).select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    model, counts, made = segments(learned, known)
    first, *rest = passes(model.sizes, most_bits)
    rows = scored(docs, holding(model, made, first), key, text)
    if rest:
        more = [added(docs, holding(model, made, parts), text) for parts in rest]
        sums = reduce(DataFrame.union, more).groupBy("digest").agg(F.sum("score").alias("_more"))
        rows = stored(rows.join(sums, "digest").withColumn("score", F.col("score") + F.col("_more")).drop("_more"))
    rows = rows.drop("digest")
    tail = rows.select("row", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("row", F.col("x.tail").alias("h"), F.col("x.times").alias("k"))
    met = tail.join(counts, "h").groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("k").alias("n_tail"))
    total = float(np.log10(model.tokens + model.types + 1.0))
    return rows.drop("tail", "times").join(met, "row", "left").select(
        F.col("k").alias(key), F.coalesce(~in_training("k"), F.lit(True)).alias("held_out"), "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("head") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * total).alias("base_score"), "score")
