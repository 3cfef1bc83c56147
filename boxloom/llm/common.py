"""What several operators of this folder share: stored tables, word hashes, connected components."""
from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.scale import maybe_broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set and all run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"boxloom-llm-{os.getpid()}")
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read again: later steps neither repeat its work
    nor depend on executors that made it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000):
    """Arrow batches of at most ``rows`` rows for what runs inside: whole texts, or sets of them, in the default 10,000 rows take
    hundreds of MB of a worker and of its executor."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batches, rows: int = 500):
    """Parts of at most ``rows`` rows of each batch, so that few texts become Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids`` (one column); null keys stay."""
    return df.join(maybe_broadcast(ids), key, "left_anti").select(*df.columns)


def only(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (one column)."""
    return df.join(maybe_broadcast(ids), key, "left_semi").select(*df.columns)


def ascii_lower(c):
    """``c`` with A-Z, and nothing else, in lower case."""
    return F.translate(c, UPPER, LOWER)


def once(c):
    """``c`` as a generated column of one row: later expressions that use it several times don't repeat its work."""
    return F.explode(F.array(c))


class WordHashes(dict):
    """64-bit hash of each word (bytes); forgets what it has kept when it holds too many."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
SMALL = np.frombuffer(bytes(range(256)).lower(), np.uint8)
PRIMES = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
BLOCK = 1 << 18        # bytes of text whose words are hashed at once


def turned(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def lowered_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """xxh64 of each white-space word, A-Z lower-cased, of all texts one after another, and how many words each text has.

    The same values as ``WordHashes`` gives, for all words of a block of texts at once: nothing is kept, and words met
    once cost no more than others.  Words of 32 bytes and more take the library's way."""
    out, found, start, size = [], [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK or i + 1 == len(texts):
            h, n = _block_hashes(texts[start:i + 1])
            out.append(h)
            found.append(n)
            start, size = i + 1, 0
    return (np.concatenate(out), np.concatenate(found)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _block_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    p1, p2, p3, p4, p5 = PRIMES
    raw = SMALL[np.frombuffer(b" ".join([*texts, b" " * 8]), np.uint8)]
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))       # the eight bytes, and the four, from each place on
    four = np.ndarray(len(raw) - 7, "<u4", raw, strides=(1,))
    edges = np.flatnonzero(np.diff(~SPACE[raw], prepend=False))
    first, last = edges[::2], edges[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    n = np.diff(np.searchsorted(first, ends), prepend=0)
    length = last - first
    h, at, left = p5 + length.astype(np.uint64), first.copy(), length.copy()
    some = np.flatnonzero((length >= 8) & (length < 32))
    while len(some):
        h[some] = turned(h[some] ^ turned(eight[at[some]] * p2, 31) * p1, 27) * p1 + p4
        at[some] += 8
        left[some] -= 8
        some = some[left[some] >= 8]
    some = np.flatnonzero((left >= 4) & (length < 32))
    h[some] = turned(h[some] ^ four[at[some]].astype(np.uint64) * p1, 23) * p2 + p3
    at[some] += 4
    left[some] -= 4
    some = np.flatnonzero((left > 0) & (length < 32))
    while len(some):
        h[some] = turned(h[some] ^ raw[at[some]].astype(np.uint64) * p5, 11) * p1
        at[some] += 1
        left[some] -= 1
        some = some[left[some] > 0]
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    h ^= h >> np.uint64(32)
    for k in np.flatnonzero(length >= 32).tolist():
        h[k] = xxhash.xxh64_intdigest(raw[first[k]:last[k]].tobytes())
    return h, n


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes (of all of them when there are fewer, nothing of nothing)."""
    n = min(n, len(h))
    if not n:
        return h
    out = mix(h[:len(h) - n + 1])
    for j in range(1, n):
        out = mix(out + h[j:len(h) - n + 1 + j] * np.uint64(2 * j + 1))
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges``: rows (id, component_id), component_id the smallest id.

    Alternates two star steps, each a minimum per node (map-side combine) and a join, until every node hangs on
    the smallest of its component.  Nodes without edges do not appear.  A hub's edges meet in a join that the
    adaptive plan splits.  Each round is written to the shared folder.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = stored(e)
    seen = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
