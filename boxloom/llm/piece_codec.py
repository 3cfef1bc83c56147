"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the longest entries of the model's compiled character map; next to every byte written stands
the byte it came from.  Pairs of neighbouring symbols then merge, best score first, into pieces; characters without a
piece fall back to bytes.  The ends of pieces in the normalised text, looked up in that alignment, are spans of the
original text, and spans of one text lie end to end from its first byte to its last.

No piece holds a space mark behind another character, so merges never cross the start of a word.  The distinct words of
a few megabytes of text are merged side by side: each round makes the best merge of every word that has one left.
"""
from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
MARK = "▁"                       # stands for a space
CHUNK = 4_000_000                # characters of text that are encoded at once
LONG = 64                        # longer words are merged by themselves
BASE = 1 << 21                   # above all code points and symbols
NORMAL, UNKNOWN, CONTROL, OWN, UNUSED, BYTE = range(1, 7)      # kinds of pieces
BPE = 2


def fields(raw: bytes):
    """(number, value) of each field of a serialised message: integers, four-byte values and byte strings."""
    def varint(at):
        value = shift = 0
        while True:
            b = raw[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(raw):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = raw[at:at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = raw[at:at + size], at + size
        yield tag >> 3, value


class CharMap:
    """The compiled character map: a double array of byte transitions, whose leaves point at replacements."""

    def __init__(self, raw: bytes):
        size = struct.unpack_from("<I", raw)[0] if raw else 0
        self.units = np.frombuffer(raw, "<u4", size // 4, 4).tolist() if raw else []
        self.texts = raw[4 + size:]

    @staticmethod
    def jump(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[str, int] | None:
        """Replacement and length of the longest entry that ``text`` has at ``at``."""
        if not self.units:
            return None
        node, found = self.jump(self.units[0]), None
        for i in range(at, len(text)):
            node ^= text[i]
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self.jump(unit)
            if unit >> 8 & 1:
                found = self.units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        return self.texts[found[0]:self.texts.index(b"\0", found[0])].decode(), found[1]


class Normaliser:
    """Text to the form that pieces are looked for in, with the original byte of every byte of it."""

    def __init__(self, raw: bytes):
        spec = {2: b"", 3: 1, 4: 1, 5: 1} | dict(fields(raw))
        self.map, self.prefix, self.squeeze, self.escape = CharMap(spec[2]), spec[3], spec[4], spec[5]
        self.space = MARK if self.escape else " "

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        raw = text.encode()
        if not raw:
            return "", np.zeros(1, np.int64)
        if self.map.units or self.squeeze:
            return self.by_entries(raw)
        lead = self.space if self.prefix else ""
        wide = len(self.space.encode())
        counts = np.where(np.frombuffer(raw, np.uint8) == 32, wide, 1)
        back = np.concatenate([np.zeros(len(lead.encode()), np.int64), np.repeat(np.arange(len(raw)), counts), [len(raw)]])
        return lead + text.replace(" ", self.space), back

    def units(self, raw: bytes):
        """(where, length, replacement): entries of the map, and characters that no entry starts with."""
        at = 0
        while at < len(raw):
            found = self.map.longest(raw, at)
            if found is None:
                first = raw[at]
                size = 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4
                found = raw[at:at + size].decode(), size
            yield at, found[1], found[0]
            at += found[1]

    def by_entries(self, raw: bytes) -> tuple[str, np.ndarray]:
        units = list(self.units(raw))
        start = 0
        while self.squeeze and start < len(units) and units[start][2] == " ":
            start += 1
        out, back = [], []

        def put(text, where):
            text = text.replace(" ", self.space)
            out.append(text)
            back.extend([where] * len(text.encode()))

        if start == len(units):
            return "", np.zeros(1, np.int64)
        if self.prefix:
            put(" ", units[start][0])
        blank = bool(self.squeeze)
        for at, _, text in units[start:]:
            text = text.lstrip(" ") if blank else text
            if text:
                put(text, at)
                blank = bool(self.squeeze) and text.endswith(" ")
        norm, end = "".join(out), len(raw)
        wide = len(self.space.encode())
        while self.squeeze and norm.endswith(self.space):
            norm = norm[:-1]
            end = back[-wide]
            del back[-wide:]
        return norm, np.array([*back, end])


def one_for_each(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("boxloom-each-byte", one_for_each)


def words_of(pieces, mark: str) -> str:
    """An expression for parts of a text that no piece reaches across: from one run of marks to the next, and letters apart
    from a character behind them that follows a letter in no piece."""
    if any(mark in p.lstrip(mark) for p in pieces):
        return "(?s).+"
    letter = re.compile(r"[^\W\d_]")
    behind = {p[i] for p in pieces for i in range(1, len(p)) if letter.match(p[i - 1])}
    apart = "".join(re.escape(c) for c in sorted({c for p in pieces for c in p} | {"\n"}) if not letter.match(c) and c not in behind)
    return f"{mark}*[^\\W\\d_]+(?=[{apart}])|{mark}+[^{mark}]*|[^{mark}]+" if apart else f"{mark}+[^{mark}]*|[^{mark}]+"


class Numbers(dict):
    """Words by the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, raw: bytes):
        pieces, trainer, norm = [], {}, b""
        for number, value in fields(raw):
            if number == 1:
                pieces.append({3: NORMAL} | dict(fields(value)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                norm = value
        kinds = {p[3] for p in pieces}
        if trainer.get(3, 1) != BPE or kinds & {OWN, UNUSED} or trainer.get(24):
            raise ValueError("only models of merged pairs, without symbols of their own, are read")
        self.normalise = Normaliser(norm)
        names = [p[1].decode() for p in pieces]
        score = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        self.ids = {n: i for i, (n, p) in enumerate(zip(names, pieces, strict=True)) if p[3] == NORMAL}
        self.score = {n: -score[i] for n, i in self.ids.items()}
        self.unknown = next(i for i, p in enumerate(pieces) if p[3] == UNKNOWN)
        self.end = next((i for i, (n, p) in enumerate(zip(names, pieces, strict=True)) if p[3] == CONTROL and n == "</s>"), None)
        self.bytes = {int(n[3:5], 16): i for i, (n, p) in enumerate(zip(names, pieces, strict=True)) if p[3] == BYTE}
        mark = self.normalise.space
        self.word = re.compile(words_of(self.ids, mark))
        surface = trainer.get(44, " ⁇ ".encode())
        self.surface = [surface if p[3] == UNKNOWN else b"" if p[3] == CONTROL else bytes([int(n[3:5], 16)]) if p[3] == BYTE
                        else n.replace(MARK, " ").encode() for n, p in zip(names, pieces, strict=True)]
        self.kind = [p[3] for p in pieces]
        self.control = np.array([k == CONTROL for k in self.kind])
        self.control = np.array([k == CONTROL for k in self.kind])
        self.spelled = [str(i) for i in range(len(names))]
        self.tables()

    def tables(self) -> None:
        """Symbols are the pieces and the characters in them, by number; other characters are their code point plus the number
        of symbols.  Every way to make a piece of two symbols is a pair, with the piece's place by score and its symbol."""
        names = list(self.ids) + sorted({c for n in self.ids for c in n} - set(self.ids))
        symbol = {n: i for i, n in enumerate(names)}
        place = {s: i for i, s in enumerate(sorted(set(self.score.values())))}
        pairs = sorted((symbol[n[:i]] * BASE + symbol[n[i:]], place[self.score[n]], symbol[n])
                       for n in self.ids for i in range(1, len(n)) if n[:i] in symbol and n[i:] in symbol)
        self.pairs, self.places, self.made = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
        self.never = len(place)
        self.symbol = {n: i for n, i in symbol.items() if len(n) == 1}
        self.of_point = np.arange(0x110000, dtype=np.int64) + len(names)
        self.of_point[[ord(c) for c in self.symbol]] = list(self.symbol.values())
        self.piece = np.array([self.ids.get(n, -1) for n in names], np.int64)
        self.point = np.array([ord(n) if len(n) == 1 else 0 for n in names], np.int64)
        self.size = np.array([len(n.encode()) for n in names], np.int64)
        self.byte = np.array([self.bytes.get(b, self.unknown) for b in range(256)], np.int64)

    def order(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place by score of the piece that each pair of symbols makes, and that piece's symbol."""
        key = left * BASE + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.places[at], self.never), self.made[at]

    def merged_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after all merges, one word after another, and how many each word has."""
        symbols = self.of_point[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        done = []
        joined = word[1:] == word[:-1]
        place, made = np.full(len(word), self.never), np.zeros(len(word), np.int64)
        at = np.flatnonzero(joined)
        place[at], made[at] = self.order(symbols[at], symbols[at + 1])
        while len(word):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(place, first)
            sizes = np.diff(np.append(first, len(word)))
            best, open_ = np.repeat(best, sizes), np.repeat(best < self.never, sizes)
            if not open_.all():
                done.append((word[~open_], symbols[~open_]))
                word, symbols, place, made, best = word[open_], symbols[open_], place[open_], made[open_], best[open_]
                if not len(word):
                    break
            at = np.flatnonzero(place == best)
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]            # the leftmost of each word
            symbols[at] = made[at]
            keep = np.ones(len(word), bool)
            keep[at + 1] = False
            word, symbols, place, made = word[keep], symbols[keep], place[keep], made[keep]
            at = at - np.arange(len(at))
            for left in (at, at[at > 0] - 1):
                pair = (left + 1 < len(word)) & (word[left] == word[np.minimum(left + 1, len(word) - 1)])
                place[left] = self.never
                left = left[pair]
                place[left], made[left] = self.order(symbols[left], symbols[left + 1])
        if not done:
            return symbols, np.zeros(len(words), np.int64)
        word, symbols = (np.concatenate(c) for c in zip(*done, strict=True))
        turn = np.argsort(word, kind="stable")
        return symbols[turn], np.bincount(word, minlength=len(words))

    def merged(self, word: str) -> list[str]:
        """Symbols of a word after all merges; of equal scores the leftmost pair goes first."""
        parts, score = list(word), self.score
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        todo = [(score[p], i, p) for i, p in enumerate(a + b for a, b in zip(parts, parts[1:], strict=False)) if p in score]
        heapify(todo)
        while todo:
            _, i, p = heappop(todo)
            j = after[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != p:
                continue                       # one side has merged since
            parts[i], parts[j] = p, ""
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (q := p + parts[k]) in score:
                    heappush(todo, (score[q], i, q))
            h = before[i]
            if h >= 0 and (q := parts[h] + p) in score:
                heappush(todo, (score[q], h, q))
        return [p for p in parts if p]

    def encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and lengths in bytes of the pieces of all words, and where each word's begin (and the last's end)."""
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        symbols, count = self.merged_all([w if len(w) <= LONG else "" for w in words])
        if long:
            names = {n: i for i, n in enumerate(self.ids)} | self.symbol
            parts = {i: np.array([names.get(p, len(self.piece) + ord(p[0])) for p in self.merged(words[i])], np.int64) for i in long}
            ends = count.cumsum()
            symbols = np.insert(symbols, np.repeat([ends[i] for i in long], [len(parts[i]) for i in long]), np.concatenate([parts[i] for i in long]))
            count[long] = [len(parts[i]) for i in long]
        known = symbols < len(self.piece)
        inner = np.where(known, symbols, 0)
        ids, sizes = np.where(known, self.piece[inner], -1), np.where(known, self.size[inner], 0)
        odd = np.flatnonzero(ids < 0)
        repeat = np.ones(len(ids), np.int64)
        if len(odd):
            point = np.where(known[odd], self.point[inner[odd]], symbols[odd] - len(self.piece))
            wide = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
            sizes[odd] = wide
            if self.bytes:                           # one id a byte; the last one's piece takes the character's span
                repeat[odd] = wide
                rest = np.repeat(wide.cumsum(), wide) - np.arange(wide.sum()) - 1
                point, wide = np.repeat(point, wide), np.repeat(wide, wide)
                low = np.where(rest == wide - 1, np.array([0, 0, 0xC0, 0xE0, 0xF0])[wide] | point >> 6 * rest, 0x80 | point >> 6 * rest & 0x3F)
                odd = np.repeat(ids < 0, repeat)
                ids, sizes = np.repeat(ids, repeat), np.repeat(sizes, repeat)
                ids[odd] = self.byte[low]
                sizes[np.flatnonzero(odd)[rest > 0]] = 0
            else:
                ids[odd] = self.unknown
        made = np.concatenate([[0], repeat.cumsum()])[np.concatenate([[0], count.cumsum()])]
        return ids, sizes, made

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its ids, and the first and last (exclusive) original byte of each piece, without an end id."""
        norms = [self.normalise(t) for t in texts]
        index, places = Numbers(), []
        for norm, _ in norms:
            found = self.word.findall(norm)
            places.append(np.fromiter(map(index.__getitem__, found), np.int64, len(found)))
        every, wide, begin = self.encoded_words(list(index)) if index else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))
        for at, (_, back) in zip(places, norms, strict=True):
            count = begin[at + 1] - begin[at]
            where = np.repeat(begin[at] - count.cumsum() + count, count) + np.arange(count.sum())
            ids, ends = every[where], wide[where].cumsum()
            if not self.bytes and (again := (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)).any():
                ids, ends = ids[np.concatenate([[True], ~again])], ends[np.concatenate([~again, [True]])]      # unknowns in a row are one
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            yield ids, back[starts], back[ends]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return next(self.encode_all([text]))

    def chunks(self, texts: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        """Each text with what ``encode`` gives, a bounded number of characters at a time."""
        some, size = [], 0
        for i, t in enumerate(texts):
            some.append(t)
            size += len(t)
            if size >= CHUNK or i + 1 == len(texts):
                yield from ((own, *found) for own, found in zip(some, self.encode_all(some), strict=True))
                some, size = [], 0

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks are spaces, the one put before the text goes, runs of byte pieces are read together."""
        raw, drop = list(map(self.surface.__getitem__, ids)), 0
        cuts = np.flatnonzero(self.control[ids]) if len(ids) else []        # bytes before and after a control id are not read as one character
        runs = [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)], strict=True)]
        if self.normalise.prefix or self.normalise.squeeze:
            for i in ids:
                if self.kind[i] == CONTROL:
                    continue
                if self.kind[i] == NORMAL and self.surface[i].startswith(b" "):
                    drop = 1
                break
        return "".join([b"".join(r).decode("utf-8", "boxloom-each-byte") for r in runs])[drop:]


@lru_cache(maxsize=2)
def codec(model: str = MODEL) -> Codec:
    """The codec of a model, read once by each worker."""
    with open(public_tokenizers.path(model), "rb") as f:
        return Codec(f.read())


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, end: bool = True) -> DataFrame:
    """(doc_id, ids, starts, ends): the ids of every text and the original bytes that each stands for, one row per row.

    A null text is empty; with ``end`` an end id follows every text, its span empty.  Null, repeated and non-numeric
    keys stay as they are, texts of any length are encoded whole, other columns play no part, and an empty table gives an
    empty result.
    """
    def run(batches):
        own = codec(model)
        for b in batches:
            out = [[], [], []]
            for t, ids, starts, ends in own.chunks(b.column(1).to_pylist()):
                if end:
                    last = len(t.encode())
                    ids, starts, ends = np.append(ids, own.end), np.append(starts, last), np.append(ends, last)
                for col, v in zip(out, (ids.astype(np.int32), starts, ends), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out[0], pa.list_(pa.int32())), *[pa.array(c, pa.list_(pa.int64())) for c in out[1:]]],
                                             [key, "ids", "starts", "ends"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    return rows.mapInArrow(run, f"{key} {kind}, ids array<int>, starts array<long>, ends array<long>")


def decode(rows: DataFrame, key: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """(doc_id, text): the text of every row's ids, null where there are none or one is no id of the model."""
    def run(batches):
        own = codec(model)
        for b in batches:
            texts = [None if v is None or any(i is None or not 0 <= i < len(own.kind) for i in v) else own.decode(v) for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [key, "text"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key), F.col(ids).cast("array<int>").alias("_i")).mapInArrow(run, f"{key} {kind}, text string")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_whole): ``encode`` with an end id, then ``decode`` of its ids,
    each text's results reduced to digests where they arise.

    ``spans_whole`` says whether the spans lie end to end over all bytes of the text.  Odd input as in ``encode``.
    """
    def run(batches):
        own = codec(model)
        for b in batches:
            n, first, second, whole = [], [], [], []
            for t, ids, starts, ends in own.chunks(b.column(1).to_pylist()):
                ids = [*ids.tolist(), own.end]
                n.append(len(ids))
                first.append(hashlib.sha256(" ".join(map(own.spelled.__getitem__, ids)).encode()).hexdigest())
                second.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
                last = len(t.encode())
                whole.append(not last if not len(ends) else bool(starts[0] == 0 and ends[-1] == last and (starts[1:] == ends[:-1]).all()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(first), pa.array(second), pa.array(whole)],
                                             [key, "n_tokens", "ids_sha256", "decoded_sha256", "spans_whole"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    return rows.mapInArrow(run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_whole boolean")
