"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

A text's features are five families of hashed n-grams over its white-space words: the words, pairs of words, the
shapes of words (which kinds of characters follow each other), pairs of shapes, and triples that say which words
repeat an earlier one.  Every family is a distribution (counts over the family's total), so length plays no part.
Training reads a bounded sample of labelled texts in one task; scoring is a sparse dot product wherever the texts lie.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import WordHashes, mix, slices

BITS = 18              # slots of the model: 2 ** BITS
SAMPLE = 6_000         # labelled texts that training reads at most, the lowest by hash of their id
MASK = (1 << 64) - 1
KINDS = bytes.maketrans(bytes(range(256)), bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)))
RUNS = re.compile(rb"(.)\1+", re.S)


class Shaped(WordHashes):
    """48 bits of a word's hash, 16 bits of its shape's hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        shape = RUNS.sub(rb"\1", word.translate(KINDS))
        value = self[word] = (xxhash.xxh64_intdigest(word) & ~0xFFFF) | (xxhash.xxh64_intdigest(shape) & 0xFFFF)
        return value


def features(text: bytes, hashes: Shaped) -> list[np.ndarray]:
    """Slots of each family of n-grams, with repeats; empty arrays where a text is too short for a family."""
    both = hashes.of(text.split())
    n = len(both)
    word, shape = both >> np.uint64(16), both & np.uint64(0xFFFF)
    one = np.uint64(0x9E3779B97F4A7C15)
    same1 = np.zeros(n, np.uint64)
    same2 = np.zeros(n, np.uint64)
    same1[1:] = word[1:] == word[:-1]
    same2[2:] = word[2:] == word[:-2]
    parts = [word, word[1:] + word[:-1] * one, shape, shape[1:] + shape[:-1] * one, (same1 + np.uint64(2) * same2)[2:]]
    return [(mix(p + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & MASK)) >> np.uint64(64 - BITS)).astype(np.int64) for k, p in enumerate(parts)]


def margin(weights: np.ndarray, bias: float, slots: list[np.ndarray]) -> float:
    return bias + sum(float(weights[s].mean()) for s in slots if len(s))


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-min(max(x, -60.0), 60.0))))


def train(rows: list[tuple[bytes, int]], epochs: int = 2, alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3) -> np.ndarray:
    """Weights, bias last, after ``epochs`` passes of follow-the-regularised-leader over (text, label)."""
    z, n, w = (np.zeros((1 << BITS) + 1) for _ in range(3))
    hashes = Shaped()
    for _ in range(epochs):
        for text, label in rows:
            slots = features(text, hashes)
            g = sigmoid(margin(w[:-1], w[-1], slots)) - label
            full = [s for s in slots if len(s)]
            at = np.concatenate([*full, [1 << BITS]])
            part = np.concatenate([*[np.full(len(s), 1.0 / len(s)) for s in full], [1.0]])
            at, back = np.unique(at, return_inverse=True)
            grad = g * np.bincount(back, weights=part)
            step = (np.sqrt(n[at] + grad * grad) - np.sqrt(n[at])) / alpha
            z[at] += grad - step * w[at]
            n[at] += grad * grad
            w[at] = np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from at most ``sample`` of the labelled rows, the same rows whatever the partitioning.

    ``labels`` (key, label 0 or 1) are thinned to the lowest hashes of their key before any text is read; nulls and
    other values are no labels.  Without labels the weights are all 0 (every score is 0.5).  What reaches the driver
    is the sample's ids and the weights.
    """
    chosen = (labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y")).where("_k is not null and _y in (0, 1)")
              .withColumn("_o", F.xxhash64("_k")).orderBy("_o", "_k", "_y").limit(sample))
    texts = docs.select(F.col(key).alias("_k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_t"))
    rows = texts.join(F.broadcast(chosen), "_k").repartition(1).sortWithinPartitions("_o", "_k", "_y", "_t")

    def one(batches):
        seen = [x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({"w": [train(seen).astype(np.float32).tobytes()]})

    found = rows.select("_t", "_y").mapInArrow(one, "w binary").collect()
    return np.frombuffer(bytes(found[0]["w"]), np.float32) if found else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(key, score, predicted) for every row; ``predicted`` is 1 where the score reaches ``threshold``.

    Null and empty texts have the bias alone.  Other columns play no part.
    """
    sent = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))
    kind = docs.schema[key].dataType

    def scored(batches):
        w = sent.value.astype(np.float64)
        hashes = Shaped()
        for b in slices(batches):
            got = [sigmoid(margin(w[:-1], w[-1], features(t, hashes))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], ["k", "score"])

    out = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")).mapInArrow(
        scored, f"k {kind.simpleString()}, score double")
    return out.select(F.col("k").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Rows of ``docs``, whole, whose score reaches ``threshold``; scored in place, without a join."""
    sent = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))
    at = docs.columns.index(text)

    def kept(batches):
        w = sent.value.astype(np.float64)
        hashes = Shaped()
        for b in slices(batches):
            good = [sigmoid(margin(w[:-1], w[-1], features((t or "").encode(), hashes))) >= threshold for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def held_out(key) -> "F.Column":
    """Whether a row belongs to the quarter that is never learned from."""
    return (F.crc32(F.col(key).cast("string")) % 4) == 2
