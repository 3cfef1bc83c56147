"""Main text of web pages: markup tells the article from what surrounds it, and a suffix array per host finds what
the host's pages repeat.

A page's blocks outside menus, notices, forms and the like become a stream of words.  The streams of a host's distinct
pages, one after another, are ordered by their suffixes by prefix doubling, up to a depth of eight words; suffixes that
agree that far are neighbours, an interval of the array, and its distinct pages are counted.  Ordering deeper would
change nothing: a word lies in a repeated substring of eight words or more exactly if it lies in one of eight.  Blocks
shorter than that are suffixes as a whole.  Words covered by intervals that enough distinct pages share are boilerplate
and go; unique runs stay.

A host of any size is ordered in parts of bounded numbers of words.  A substring on a share of the host's pages is on
that share of the pages of one part at least, so each part names its candidates, and those alone are counted
over all of the host's pages.
"""
from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import WordHashes, grams, stored
from boxloom.llm.link_trust import host_of
from boxloom.scale import maybe_broadcast

DEPTH = 8              # words that suffixes are ordered by
PART = 1 << 18         # words that one part of a host's array should hold
# Shares of a host's pages, and numbers of pages, that make a substring boilerplate: inside the article, and elsewhere.
INSIDE, ELSEWHERE = (0.8, 10), (0.1, 3)

TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][\w:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|(/?)([a-zA-Z][\w:-]*)([^>]*)(?:>|\Z))""", re.S)
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "canvas", "xmp"}
IMPLIED = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}      # a second one ends the first
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "datalist", "audio", "video", "head"}
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
            "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr tbody table figure figcaption caption math svg object b i em strong span code sub sup q cite".split())
NAMES = ("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert "
         "newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs share sharing social related "
         "recommended recommendations comment comments reply replies respond disqus footer masthead popup modal overlay login widget widgets "
         "toolbar pagination pager skip copyright").split()
NAMED = re.compile(r"(?:^|[\s_-])(?:" + "|".join(NAMES) + r")(?=$|[\s_-])", re.I)
TOP = re.compile(r"(?:^|[\s_-])(?:header|topbar|site-title)(?=$|[\s_-])", re.I)
COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|reply|replies|respond|disqus|related|recommended|promo|teaser)(?=$|[\s_-])", re.I)
ATTRIBUTE = re.compile(r"""([\w:-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"}


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(raw)} if raw.strip() else {}


def kind_of(tag: str, raw: str, inside: bool) -> str | None:
    """What an element opens: ``main``, ``noise``, or nothing of note."""
    a = attributes(raw)
    names = f"{a.get('class', '')} {a.get('id', '')}"
    role = a.get("role", "").lower()
    if tag == "article":
        return "noise" if COMMENT.search(names) else "main"
    if tag == "main" or role == "main" or a.get("itemprop") == "articleBody":
        return "main"
    if tag in ("html", "body"):
        return None
    if tag in ASIDE or role in ROLES or "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
        return "noise"
    if (tag == "header" or TOP.search(names)) and not inside:
        return "noise"
    if inside and tag in PROSE:                # of a paragraph of the article only a whole name tells, not a word of a longer one
        return "noise" if any(n.lower() in NAMES for n in names.split()) else None
    return "noise" if names.strip() and NAMED.search(names) else None


def blocks(page: str) -> list[tuple[str, bool]]:
    """Blocks of a page in order as (text, whether inside the article), without what the markup sets apart.

    White space in a block is one space, character references are decoded.  Where there is an article (or a main
    part) only its blocks come; else all blocks do that are not mostly links.
    """
    out, text, linked, stack, anchor, at, article = [], [], [], [], 0, 0, False

    def add(raw):
        if raw and not (stack and stack[-1][1] == "noise"):
            text.append(raw)
            if anchor:
                linked.append(raw)

    def close():
        if text:
            words = " ".join(entities.unescape("".join(text)).split())
            if words:
                links = " ".join(entities.unescape("".join(linked)).split())
                mains = [s[0] for s in stack if s[1] == "main"]
                out.append((words, "article" if "article" in mains else mains and "main", 2 * len(links) > len(words)))
            text.clear()
            linked.clear()

    low = None
    while True:
        m = TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        end, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            close()
        elif tag == "br":
            add(" ")
        if end:
            if tag == "a":
                anchor = max(0, anchor - 1)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close()
                    del stack[i:]
                    break
            continue
        if tag in RAW:
            if not raw.rstrip().endswith("/"):
                low = page.lower() if low is None else low
                stop = low.find("</" + tag, at) if len(low) == len(page) else next((x.start() for x in re.compile("</" + tag, re.I).finditer(page, at)), -1)
                at = len(page) if stop < 0 else stop
            continue
        if tag in VOID or raw.rstrip().endswith("/") and tag not in BLOCK:
            continue
        if tag == "a":
            anchor += 1
        if stack and (stack[-1][0] == tag and tag in IMPLIED or stack[-1][0] == "p" and tag in BLOCK):
            stack.pop()
        if stack and stack[-1][1] == "noise":
            kind = "main" if stack[-1][0] == "form" and kind_of(tag, raw, False) == "main" else None
        else:
            kind = kind_of(tag, raw, bool(stack))
        if kind:
            close()
            stack.append((tag, kind))
            article = article or (kind == "main" and tag == "article")
        elif any(s[0] == tag for s in stack):      # its end must not be taken for the end of what is open around it
            stack.append((tag, stack[-1][1]))
    close()
    if article:
        return [(t, True) for t, where, _ in out if where == "article"] or [(t, True) for t, where, _ in out if where]
    if any(where for _, where, _ in out):
        return [(t, True) for t, where, _ in out if where]
    return [(t, False) for t, _, links in out if not links]


def suffixes(block: bytes, n: int, keys: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes of a block of ``n`` words: their places, their keys (of ``DEPTH`` words; of the whole of a short
    block), and how many words a key covers.  ``keys`` are those of all its runs of ``DEPTH`` words."""
    side = np.uint64(0x5851F42D4C957F2D if inside else 0x14057B7EF767814F)
    if n < DEPTH:
        return np.zeros(1, np.int64), np.array([xxhash.xxh64_intdigest(block)], np.uint64) ^ side, n
    return np.arange(len(keys)), keys ^ side, DEPTH


def packed(found: list[tuple[str, bool]]) -> bytes:
    """Blocks as one compressed line each, led by whether they are inside the article."""
    return zstandard.compress("\n".join(("1" if side else "0") + t for t, side in found).encode(), 3)


def unpacked(raw: bytes) -> list[tuple[str, bool]]:
    return [(line[1:], line[0] == "1") for line in zstandard.decompress(raw).decode().split("\n") if line]


def streams(pages: DataFrame) -> DataFrame:
    """(k, u, h, content, words, blocks): of every page its blocks, a hash of them and how many words they have."""
    def run(batches):
        for b in batches:
            content, words, out = [], [], []
            for page in b.column(3).to_pylist():
                found = blocks(page)
                stream = xxhash.xxh64()
                for text, side in found:
                    stream.update(text.encode() + (b"\n1" if side else b"\n0"))
                content.append(stream.intdigest())
                words.append(sum(t.count(" ") + 1 for t, _ in found))
                out.append(packed(found))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.array(content, np.uint64).view(np.int64)), pa.array(words, pa.int64()), pa.array(out, pa.binary())],
                                             ["k", "u", "h", "content", "words", "blocks"])

    kind = pages.schema["k"].dataType.simpleString()
    return pages.select("k", "u", "h", "html").mapInArrow(run, f"k {kind}, u string, h long, content long, words long, blocks binary")


def distinct_pages(every: DataFrame) -> DataFrame:
    """One row per host and content, so that copies of a page are no further pages; only hosts with pages enough to
    repeat something."""
    own = every.where("h is not null and words > 0")
    copies = own.groupBy("h", "content").agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first <> last").drop("last")
    return own.join(maybe_broadcast(stored(copies)), ["h", "content"], "left").where("first is null or row = first").drop("first")


def order(ids: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes at all places by their first ``DEPTH`` words, by prefix doubling; ``left`` counts the words from a
    place to the end of its block, which no suffix crosses.  Equal ranks are neighbours in the suffix array."""
    rank, wide = np.unique(ids, return_inverse=True)[1] + 1, 1
    while wide < DEPTH:
        after = np.zeros_like(rank)
        after[:-wide] = np.where(left[:-wide] > wide, rank[wide:], 0)
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1] + 1
        wide *= 2
    return rank


def repeated(contents: list[list[tuple[str, bool]]], shares: tuple[float, float], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the suffixes that a share of the given pages have, whether they are inside the article, and on how many pages
    they stand."""
    raws = [(i, t.encode(), side) for i, page in enumerate(contents) for t, side in page]
    words = [r.split(b" ") for _, r, _ in raws]
    sizes = np.array([len(w) for w in words], np.int64)
    stops = sizes.cumsum()
    ids = hashes.of([w for own in words for w in own])
    left = np.repeat(stops, sizes) - np.arange(len(ids))
    starts = np.repeat(stops - sizes, sizes) == np.arange(len(ids))
    page, side = (np.repeat(np.array(c, np.int64), sizes) for c in ([i for i, _, _ in raws], [s for _, _, s in raws]))
    # a short block counts as a whole; places too near the end of a longer block start no suffix
    use = np.flatnonzero((left >= DEPTH) | starts)
    rank = order(ids, left)[use]
    interval = (rank * 2 + (left[use] < DEPTH)) * 2 + side[use]
    seen = np.unique(interval * len(contents) + page[use], return_index=True)
    name, first, n = np.unique(seen[0] // len(contents), return_index=True, return_counts=True)
    inside = name % 2 == 1
    enough = n >= np.where(inside, shares[1], shares[0]) * len(contents) - 1e-9
    at = use[seen[1][first[enough]]]
    block = np.searchsorted(stops, at, "right")
    keys = np.zeros(len(at), np.uint64)
    for j, (place, own) in enumerate(zip(at, block, strict=True)):
        start = stops[own] - sizes[own]
        found = words[own][place - start:place - start + DEPTH]
        _, key, _ = suffixes(b" ".join(found), len(found), grams(hashes.of(found), DEPTH), raws[own][2])
        keys[j] = key[0]
    return keys.view(np.int64), inside[enough], n[enough]


def boilerplate(every: DataFrame) -> DataFrame:
    """(h, keys): suffixes that enough distinct pages of the host share.  No host has more of them than a few
    times those of its average page, as each stands in a tenth of its pages or more."""
    distinct = distinct_pages(every).select("h", "content", "words", "blocks")
    hosts = distinct.groupBy("h").agg(F.count("*").alias("pages"), F.ceil(F.sum("words") / PART).alias("parts")).where(f"pages >= {min(INSIDE[1], ELSEWHERE[1])}")
    hosts = maybe_broadcast(stored(hosts))

    def ordered(key, group):
        hashes = WordHashes()
        keys, inside, n = repeated([unpacked(r) for r in group["blocks"].to_pylist()], (ELSEWHERE[0], INSIDE[0]), hashes)
        return pa.table({"h": pa.array([key[0].as_py()] * len(keys), pa.int64()), "key": pa.array(keys), "inside": pa.array(inside), "n": pa.array(n, pa.int64())})

    laid = distinct.join(hosts, "h").select("h", F.pmod(F.xxhash64("content"), F.col("parts")).alias("part"), "blocks")
    found = stored(laid.groupBy("h", "part").applyInArrow(ordered, "h long, key long, inside boolean, n long").join(hosts, "h"))
    sure, asked = found.where("parts = 1"), found.where("parts > 1").select("h", "key", "inside", "pages").distinct()
    lists = stored(asked.groupBy("h").agg(F.array_sort(F.collect_list("key")).alias("keys")))

    def counted(batches):
        hashes, total = WordHashes(), {}
        for b in batches:
            for host, raw, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                known = known.values.to_numpy()
                own = [suffixes(t.encode(), t.count(" ") + 1, grams(hashes.of(t.encode().split(b" ")), DEPTH), side)[1] for t, side in unpacked(raw)]
                for k in np.intersect1d(np.concatenate(own).view(np.int64), known).tolist():
                    total[host, k] = total.get((host, k), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in total], pa.int64()) for i in (0, 1)] + [pa.array(list(total.values()), pa.int64())], ["h", "key", "n"])

    sums = distinct.join(maybe_broadcast(lists), "h").select("h", "blocks", "keys").mapInArrow(counted, "h long, key long, n long").groupBy("h", "key").agg(F.sum("n").alias("n"))
    every_n = sure.select("h", "key", "inside", "n", "pages").union(asked.join(sums, ["h", "key"]).select("h", "key", "inside", "n", "pages"))
    least = F.when(F.col("inside"), F.greatest(F.lit(INSIDE[1]), F.col("pages") * INSIDE[0])).otherwise(F.greatest(F.lit(ELSEWHERE[1]), F.col("pages") * ELSEWHERE[0]))
    return every_n.where(F.col("n") >= least).groupBy("h").agg(F.array_sort(F.collect_list("key")).alias("keys"))


def unique_runs(text: str, inside: bool, known: np.ndarray, hashes: WordHashes) -> str:
    """A block without the words that ``known`` suffixes, in order, cover."""
    words = text.encode().split(b" ")
    at, keys, wide = suffixes(text.encode(), len(words), grams(hashes.of(words), DEPTH), inside)
    keys = keys.view(np.int64)
    hit = at[known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys]
    if not len(hit):
        return text
    edges = np.bincount(hit, minlength=len(words) + 1) - np.bincount(hit + wide, minlength=len(words) + 1)
    return b" ".join(w for w, c in zip(words, np.cumsum(edges)[:-1], strict=True) if not c).decode()


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``: blocks of the main text joined by two line ends.

    Null and empty html, and pages without text, give an empty text.  A null url, or one without a host, has no host's
    array: such pages go by their markup alone.  Rows that repeat are extracted alike; pages of a host with the same main
    text count as one page.  Broken and
    cut-off markup is read as far as it goes.  Other columns play no part.
    """
    host = host_of(F.col(url))
    p = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.when(host != "", F.xxhash64(host)).alias("h"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    every = stored(streams(p).withColumn("row", F.monotonically_increasing_id()))
    known = stored(boilerplate(every))
    met = every.join(maybe_broadcast(known), "h", "left")
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            out, lists = [], b.column(3)
            for i, raw in enumerate(b.column(2).to_pylist()):
                found = unpacked(raw)
                if lists[i].is_valid:
                    keys = lists[i].values.to_numpy()
                    found = [(unique_runs(t, side, keys, hashes), side) for t, side in found]
                out.append("\n\n".join(t for t, _ in found if t))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], [key, url, "text", "n_chars"])

    return met.select("k", "u", "blocks", "keys").mapInArrow(run, f"{key} {kind}, {url} string, text string, n_chars long")
