"""Best-fit packing planned on the histogram of lengths.

Texts become pieces of at most ``room`` tokens.  How many pieces there are of each length is all the planner reads:
it places lengths, longest first, each into the fullest sequence that still has room, but handles all sequences
of equal content as one batch, so the plan has a few rows per length however many pieces there are.  Pieces then
take planned slots by joining on their rank within their length.
"""
from __future__ import annotations

import base64
import zlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm.common import slices, small_batches, stored

ROOM = 1024
END = 2                # id after every text
SPECIAL = "<|endoftext|>"
RANKS = "byte_bpe_50k.tiktoken"      # the vocabulary of byte_bpe_50k.json as ranks: the same ids, several times faster
SALTS = 64             # parts that the pieces of one length are ranked in


@lru_cache(maxsize=2)
def encoder(ranks: str = RANKS) -> tiktoken.Encoding:
    """The encoder of a vocabulary, built once by each worker."""
    with open(public_tokenizers.path(ranks), "rb") as f:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={SPECIAL: 50256})


def cut(n: int, room: int = ROOM) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: only texts over ``room`` are cut; the first piece takes the rest."""
    first = n if n <= room else n % room or room
    return [(0, first)] + [(s, room) for s in range(first, n, room)]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", room: int = ROOM, ranks: str = RANKS, tokens: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), with the ids themselves when ``tokens``.  A null text has no
    tokens but the end."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * tokens

    def run(batches):
        enc = encoder(ranks)
        tail = np.array([END], np.uint32)
        for b in slices(batches):
            out = [[] for _ in range(5 + tokens)]
            keys = b.column(0).to_pylist()
            for k, t in zip(keys, b.column(1).to_pylist(), strict=True):
                ids = np.concatenate([enc.encode_to_numpy(t, allowed_special="all").astype(np.uint32), tail])
                for i, (s, n) in enumerate(cut(len(ids), room)):
                    raw = ids[s:s + n].tobytes()
                    for col, v in zip(out, (k, i, s, n, zlib.crc32(raw), raw)):      # the ids themselves only where asked for
                        col.append(v)
            types = [b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:5 + tokens]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], [key, "piece", "start", "length", "ids_crc32", "ids"][:5 + tokens])

    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t")).mapInArrow(run, schema)


def plan(histogram: dict[int, int], room: int = ROOM) -> list[tuple[int, int, int, int, int, int]]:
    """Slots: (length, first rank, pieces, first sequence, pieces per sequence, offset).

    Piece r of a slot, counted from its first rank, goes to sequence first + r // per, at offset + (r % per) * length.
    Open sequences are kept as batches (first sequence, how many) by the room they have left; a length takes the
    batch with the least room that still fits, whole or in part, which is best-fit decreasing over all pieces.
    """
    slots, batches, left, following = [], {}, [], 0      # left: rooms that some batch has, in order

    def put(rest, first, count):
        if not rest:
            return
        if rest not in batches:
            batches[rest] = []
            left.insert(bisect_left(left, rest), rest)
        batches[rest].append((first, count))

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            at = bisect_left(left, length)
            if at < len(left):
                rest = left[at]
                first, count = batches[rest].pop()
                if not batches[rest]:
                    del batches[rest], left[at]
                per = min(rest // length, -(-todo // count))       # one after another into the same sequence: it stays the fullest
                per = per if todo >= per * count else 1 if todo < count else todo // count
                n = min(todo, per * count)
                used = n // per
                if used < count:
                    put(rest, first + used, count - used)
            else:
                rest, first = room, following
                per = min(room // length, todo)
                used = todo // per
                n = used * per
                following += used
            slots.append((length, rank, n, first, per, room - rest))
            put(rest - per * length, first, used)
            rank += n
            todo -= n
    return slots


def ranked(df: DataFrame, by: str, order: list[str], salts: int = SALTS) -> DataFrame:
    """``df`` with ``rank``, from 0 within each ``by``.  Rows of one ``by`` are dealt over ``salts`` parts by hash,
    ranked in each, and shifted by the counts of the parts before; equal rows take ranks in any order."""
    d = df.withColumn("_s", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    before = d.groupBy(by, "_s").agg(F.count("*").alias("_n")).select(by, "_s", F.coalesce(F.sum("_n").over(
        Window.partitionBy(by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy(by, "_s").orderBy(*order)) - 1)
    return d.join(before, [by, "_s"]).withColumn("rank", F.col("_r") + F.col("_o")).drop("_s", "_r", "_o")


def pack(cut_pieces: DataFrame, key: str = "doc_id", room: int = ROOM) -> DataFrame:
    """Every piece with its place: adds sequence_id and offset.

    The histogram (at most ``room`` rows) is all that reaches the driver, and the plan, a few rows per length,
    all that is broadcast.  Where the plan's slots outnumber a length's pieces nothing is dropped.  Pieces are
    read again from the shared folder; an empty table gives no rows.
    """
    spark = cut_pieces.sparkSession
    with small_batches(spark):
        p = stored(cut_pieces)
    counts = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(plan(counts, room), "length long, _from long, _n long, _first long, _per long, _at long")
    r = ranked(p, "length", [key, "piece", "ids_crc32"])
    hit = r.join(F.broadcast(slots), "length").where("rank >= _from and rank < _from + _n")
    k = F.col("rank") - F.col("_from")
    return hit.select(*[p[c] for c in p.columns], (F.col("_first") + F.floor(k / F.col("_per"))).cast("long").alias("sequence_id"),
                      (F.col("_at") + (k % F.col("_per")) * F.col("length")).cast("long").alias("offset"))
