"""The operators for training text against plain loops and round trips, on small tables."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

pytest.importorskip("boxloom.llm")
from boxloom.llm import (  # noqa: E402
    bloom_lm,
    contamination,
    jaccard_join,
    license_rules,
    line_runs,
    link_trust,
    multi_index,
    packing,
    page_text,
    quality,
)
from boxloom.llm.common import components  # noqa: E402

TEXT = "doc_id long, text string, score string, id string"


def frame(spark, rows, schema=TEXT):
    """Rows with extra columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(3)


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(5)
    pairs = [(i, i + 1) for i in range(30)] + [(100, r.randrange(101, 160)) for _ in range(50)] + [(7, 7)]
    got = {x.id: x.component_id for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(pairs, {n for p in pairs for n in p})
    assert got == want


def test_link_trust(spark):
    rows = [(1, "http://A.org/en/1", '<a href="http://b.org/x">'), (2, "http://b.org/q?u=1", "<a href=//bad.net/es/1>"), (3, "https://bad.net/es/1", ""),
            (4, None, None), (5, "x.com", None), (6, "https://q.com/1#t", '<A HREF="https://a.org/">'), (7, "http://www.example.com/en/2", None),
            (8, "http://x.example.com/en/2", ""), (9, "http://com/", None), (9, "http://com/", None)]
    got = {r.page_id: r for r in link_trust.judge(frame(spark, rows, "page_id long, url string, html string, trust string, kind string")).collect()}
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()} == {
        1: ("a.org", "/en/1", None, "allow"), 2: ("b.org", "/q", None, "block"), 3: ("bad.net", "/es/1", "net/es/", "block"), 4: ("", "", None, "allow"),
        5: ("", "", None, "allow"), 6: ("q.com", "/1", "com/", "allow"), 7: ("www.example.com", "/en/2", "www.example.com/en/", "allow"),
        8: ("x.example.com", "/en/2", "example.com/en/", "block"), 9: ("com", "/", "com/", "allow")}
    # trust: q.com -> a.org -> b.org -> bad.net; distrust the other way
    seed, d = 0.15, 0.85
    assert [got[k].trust for k in (6, 1, 2, 3)] == pytest.approx([seed * d ** i for i in range(4)], abs=1e-9)
    assert [got[k].distrust for k in (3, 2, 1, 6)] == pytest.approx([seed * d ** i for i in range(4)], abs=1e-9)


def test_multi_index(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(6, 16))
    rows = [(i, [float(x) for x in base[i % 6] + r.normal(size=16) * (0.05 if i % 5 else 3)]) for i in range(200)]
    rows += [(300, rows[3][1]), (301, rows[3][1]), (302, [0.0] * 16), (303, None), (304, [float("nan")] * 16), (305, []), (306, [1.0, 2.0]), (307, [None, 1.0])]
    df = spark.createDataFrame([(*x, "n") for x in rows], "vec_id long, embedding array<float>, n string").repartition(3)
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in multi_index.near_duplicates(df).collect()}
    good = [(k, np.array(v, np.float32).astype(float)) for k, v in rows if v and len(v) == 16 and np.isfinite(v).all() and any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.9
    pairs = [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(near), strict=True) if a != b]
    links = Counter(a for a, _ in pairs)
    want = roots(pairs, [k for k, _ in rows])
    assert sum(x[0] for x in got.values()) >= 0.9 * len(pairs)
    assert all(got[k][0] <= links[k] and got[k][2] == (got[k][1] == k) for k, _ in rows)
    assert sum(got[k][1] == want[k] for k, _ in rows) >= 0.9 * len(rows)
    assert multi_index.near_duplicates(df.limit(0)).count() == 0


def jaccard_corpus(seed):
    r = random.Random(seed)
    words = [f"W{i}" for i in range(300)]
    base = [[r.choice(words) for _ in range(r.randint(20, 90))] for _ in range(5)]
    shared, out = [r.choice(words) for _ in range(30)], []
    for i in range(240):
        if r.random() < 0.6:
            w = list(base[min(r.randrange(9), 4)])
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                w[r.randrange(len(w))] = r.choice(words)
        else:
            w = [r.choice(words) for _ in range(r.randint(0, 40))]
            w = w[:10] + shared + w[10:] if r.random() < 0.5 else w[:4]
        out.append((i * 3, " ".join(w)))
    return [*out, (9001, None), (9002, ""), (9003, " \n"), (9004, "one two"), (9005, "ONE\ttwo")]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, seed):
    rows = jaccard_corpus(seed)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.join(frame(spark, rows)).collect()}
    sets = {}
    for k, t in rows:
        w = (t or "").lower().split()
        n = min(4, len(w))
        sets[k] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(pairs, sets)
    assert got == {k: (len(sets[k]), want[k]) for k in sets}


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.join(frame(spark, [(1, "")]).limit(0)).count() == 0
    assert [tuple(x) for x in jaccard_join.join(frame(spark, [(1, None)])).collect()] == [(1, 0, 1)]


def deleted(rows, least):
    """Every run of lines of at least ``least`` words that stands at an earlier place, whatever else stands there."""
    place = lambda r: (r[0], xxhash.xxh64_intdigest(r[1], 42) - (1 << 64) * (xxhash.xxh64_intdigest(r[1], 42) >> 63), r[1])
    lines = {(k, t): [x for x in ((i, s.strip(" "), len(s.strip(" ").split(" ")) if s.strip(" ") else 0) for i, s in enumerate(t.split("\n"))) if x[2]]
             for k, t in sorted((r for r in rows if r[0] is not None and r[1]), key=place)}
    seen, gone = set(), {k: set() for k in lines}
    for k, a in lines.items():
        for p in range(len(a)):
            for q in range(p, len(a)):
                if sum(x[2] for x in a[p:q + 1]) >= least:
                    run = tuple(x[1] for x in a[p:q + 1])
                    if run in seen:
                        gone[k].update(x[0] for x in a[p:q + 1])
                    seen.add(run)
    return {k: sorted(v) for k, v in gone.items() if v}


def test_line_runs(spark):
    r = random.Random(4)
    lines = [" ".join(r.choice("abcdef") for _ in range(r.randint(0, 9))) for _ in range(12)]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 14)))) for i in range(100)] + [(1000, None), (1001, "")]
    df = frame(spark, rows)
    want = deleted(rows, 12)
    got = {x.doc_id: x for x in line_runs.dedup_lines(df, min_words=12).collect()}
    assert len(got) == len(rows)
    for k, t in rows:
        gone = want.get((k, t), [])
        assert got[k].n_deleted == len(gone)
        assert got[k].text == (t if not gone else "\n".join(s for i, s in enumerate(t.split("\n")) if i not in gone))
    assert line_runs.dedup_lines(df.limit(0)).count() == 0


def test_line_runs_keep_the_first_passage(spark):
    passage = " ".join(f"w{i}" for i in range(55))
    got = {x.doc_id: x.text for x in line_runs.dedup_lines(frame(spark, [(1, f"a b\n{passage}\nc"), (2, f"d\n{passage}\ne"), (3, "a b\nc")])).collect()}
    assert got == {1: f"a b\n{passage}\nc", 2: "d\ne", 3: "a b\nc"}


def test_license_rules(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, "Licensed under CC BY-NC 4.0. cc by cc by"), (3, None), (4, ""),
            (5, "Released under the MIT license."), (6, "ALL rights\n reserved"), (7, "accby all rights unreserved permit"), (8, "x " * 3000 + "Apache License 2.0"),
            (9, "SPDX-License-Identifier: Apache-2.0")]
    got = {x.doc_id: x for x in license_rules.scan(frame(spark, rows)).collect()}
    assert {k: (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels) for k, x in got.items()} == {
        1: (12, 1, 7, 7, "gpl", "gpl,gpl-3.0"), 2: (11, 3, 2, 9, "cc-by", "cc-by,cc-by-nc-4.0"), 3: (0, 0, None, None, "", ""), 4: (0, 0, None, None, "", ""),
        5: (5, 0, None, None, "", "mit"), 6: (3, 1, 0, 0, "reserved", "reserved"), 7: (5, 0, None, None, "", ""), 8: (3004, 0, None, None, "", "apache-2.0"),
        9: (6, 0, None, None, "", "apache-2.0")}
    assert got[1].spans == [("gpl-3.0", 3, 11)] and got[3].score == 0 and 0 < got[5].score <= 1
    assert license_rules.scan(frame(spark, rows).limit(0)).count() == 0


def test_every_rule_is_an_expression_with_its_keyword():
    import re
    found = license_rules.rules()
    assert len(found) > 300 and all(re.compile(r[2]) and r[1] for r in found)


def test_packing_plan_is_best_fit_decreasing():
    r = random.Random(1)
    for room in (10, 50, 1024):
        for _ in range(20):
            counts = {r.randint(1, room): r.choice([1, 2, 3, 10, 500]) for _ in range(r.randint(1, 25))}
            rows, taken = {}, Counter()
            for length, rank, n, first, per, offset in packing.plan(counts, room):
                assert rank == taken[length]
                taken[length] += n
                for i in range(n):
                    rows.setdefault(first + i // per, []).append((offset + i % per * length, length))
            assert taken == Counter(counts)
            for v in rows.values():
                end = 0
                for at, length in sorted(v):
                    assert at == end
                    end += length
                assert end <= room
            left = []
            for length in sorted(counts, reverse=True):
                for _ in range(counts[length]):
                    fit = [x for x in left if x >= length]
                    if fit:
                        left.remove(min(fit))
                    left.append((min(fit) if fit else room) - length)
            assert len(rows) == len(left)


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["the", "Über", "x<|endoftext|>y", "1234", "  "]) for _ in range(r.choice([0, 3, 3, 200, 2500])))) for i in range(60)] + [(99, None)]
    got = packing.pack(packing.pieces(frame(spark, rows))).collect()
    by = {}
    for x in got:
        by.setdefault(x.doc_id, []).append(x)
    for k, t in rows:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted(by[k], key=lambda x: x.piece)
        assert [(x.start, x.length) for x in own] == packing.cut(len(ids))
        assert [x.ids_crc32 for x in own] == [zlib.crc32(np.array(ids[x.start:x.start + x.length], "<u4").tobytes()) for x in own]
    rows = {}
    for x in got:
        rows.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for v in rows.values():
        assert [a for a, _ in sorted(v)] == [sum(n for _, n in sorted(v)[:i]) for i in range(len(v))] and sum(n for _, n in v) <= 1024
    assert packing.pack(packing.pieces(frame(spark, [(1, "")]).limit(0))).count() == 0


def test_page_text(spark):
    rows = [(1, "http://a.org/1", '<html><body class="has-sidebar"><header><h1>Site</h1></header><nav>menu</nav><article><h1>T &amp; x</h1><p>a <b>b<br>c</p>'
             '<p>d</p><aside>side</aside><div class="ad">ad</div><section id="comments"><article class="comment">nice</article></section>'
             '<p>e&nbsp;f <script>var t="</p>";</script>g</p></article><footer>f</footer></body></html>'),
            (2, None, "<form><article><p>x</p></article></form><p>y"), (3, "http://a.org/3", None), (4, "nohost", ""), (5, "http://b.org", '<p title="a>b">x<p cla')]
    rows += [(10 + i, f"http://c.org/{i}", f"<div>buy our excellent things today</div><div>story number {i} tells of {i * 7} apples</div>") for i in range(12)]
    got = {x.page_id: x for x in page_text.extract(frame(spark, rows, "page_id long, url string, html string, text string, h string")).collect()}
    assert {k: got[k].text for k in range(1, 6)} == {1: "T & x\n\na b c\n\nd\n\ne f g", 2: "x", 3: "", 4: "", 5: "x"}
    assert all(got[10 + i].text == f"story number {i} tells of {i * 7} apples" for i in range(12))
    assert all(x.n_chars == len(x.text) for x in got.values())


def test_quality_on_held_out_rows(spark):
    r = random.Random(3)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "erat", "nunc"]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(words) + str(r.randrange(50)) for _ in range(r.randint(20, 80))]
        bad = i % 4 == 0
        rows.append((i, " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w) + "."))
        labels.append((i, 0 if bad else 1))
    rows += [(900, None), (901, ""), (902, "a" * 200_000)]
    df = frame(spark, rows)
    lab = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    weights = quality.fit(df, lab.where(~quality.held_out("doc_id")))
    got = {x.doc_id: x for x in quality.score(df, weights).collect()}
    out = [(k, y) for k, y in labels if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum(got[k].predicted == y for k, y in out) >= 0.95 * len(out) and len(got) == len(rows)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) for x in got.values())
    assert {x.doc_id for x in quality.keep_good(df, weights).collect()} == {k for k, x in got.items() if x.predicted}
    assert quality.score(df, quality.fit(df, lab.limit(0))).first()["score"] == 0.5


def test_contamination(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([3, 5, 14, 30, 59])))) for i in range(30)] + [(90, None), (91, "")]
    rows = []
    for i in range(150):
        w = [r.choice(words) for _ in range(r.choice([0, 4, 50, 900]))]
        if i % 3 == 0:
            t = r.choice(items)[1] or ""
            t = t.split()
            if t and r.random() < 0.5:
                t[r.randrange(len(t))] = "zz"
            w[len(w) // 2:len(w) // 2] = t
        rows.append((i, " , ".join(w).upper()))
    rows += [(900, None)]
    shingles = lambda t: {tuple(w[i:i + 5]) for w in [[x for x in (t or "").lower().replace(",", " ").split()]] for i in range(len(w) - 4)}
    docs, sets = {k: shingles(t) for k, t in rows}, {k: shingles(t) for k, t in items}
    want = {(d, i): (len(sets[i]), len(sets[i] & docs[d])) for d in docs for i in sets if sets[i] and 100 * len(sets[i] & docs[d]) >= 80 * len(sets[i])}
    df, it = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): (x.n_item, x.n_shared) for x in contamination.find(df, it).collect()}
    assert want and got == want
    assert {x.doc_id for x in contamination.clean(df, it).collect()} == {k for k, _ in rows} - {k for k, _ in want}
    assert contamination.find(df, it.limit(0)).count() == 0


@pytest.mark.parametrize("known", [bloom_lm.KNOWN, 20])
def test_bloom_lm(spark, known):
    r = random.Random(8)
    words = [f"W{int(r.paretovariate(0.8))}" for _ in range(4000)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(120)] + [(900, None), (901, "")]
    counts, total, ends = Counter(), 0, 0
    for k, t in rows:
        if zlib.crc32(str(k).encode()) % 7 != 2:
            w = (t or "").lower().split()
            counts.update(w)
            ends += 1
            total += len(w) + 1
    types = len(counts) + 1
    got = {x.doc_id: x for x in bloom_lm.score(frame(spark, rows), known=known).collect()}
    for k, t in rows:
        c = [*[counts[x] for x in (t or "").lower().split()], ends]
        x = got[k]
        assert (x.n_tokens, x.n_known, x.train_tokens, x.held_out) == (len(c), sum(n > 0 for n in c), total, zlib.crc32(str(k).encode()) % 7 == 2)
        assert x.base_score == pytest.approx(sum(math.log10((n + 1) / (total + types + 1)) for n in c))
        assert x.score < 0
    seen = [x for x in got.values() if not x.held_out]
    assert sum(x.score for x in seen) > sum(x.base_score for x in seen)


def test_bloom_filter_never_counts_too_little(spark):
    rows = [(i, "a b " * (i + 1)) for i in range(20)]
    model, _ = bloom_lm.train(spark.createDataFrame(rows, "id long, text string").selectExpr("cast(text as binary) t"))
    a, b = (model.ids(bloom_lm.WordHashes().of([w]))[0] for w in (b"a", b"b"))
    n = sum(i + 1 for i in range(20))
    key = np.array([int(a) << 16 | int(b), bloom_lm.ALONE << 16 | int(a)], np.uint64)
    assert (model.level(key) >= 1 + math.floor(math.log2(n))).all()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(9)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "erat", "nunc"]
    make = lambda n: " ".join(r.choice(words) + str(r.randrange(200)) for _ in range(n))
    clean = {i: make(60) for i in range(120)}
    item, passage = make(30), make(55)
    near = clean[0].split()
    near[5] = "other1"
    texts = clean | {200: clean[1], 201: " ".join(near), 202: make(40) + " " + item + " " + make(20), 203: make(60) + "\n" + passage, 204: make(60) + "\n" + passage}
    texts |= {300 + i: " ".join(w.upper() + "!!" for w in make(50).split()) for i in range(40)} | {400: None, 401: ""}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 300), 0) for k in texts if k < 400], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = docs.cache()
        kept[name] = {x.doc_id for x in docs.select("doc_id").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert not [k for k in kept[names[0]] if 300 <= k < 400] and set(clean) <= kept[names[0]]
    assert kept[names[0]] - kept[names[1]] == {200}
    assert kept[names[1]] - kept[names[2]] == {201}
    assert kept[names[2]] - kept[names[3]] == {202}
    assert kept[names[4]] == kept[names[3]] >= set(clean)


def test_bloom_lm_in_passes_with_every_word(spark, monkeypatch):
    r = random.Random(12)
    chain = {i: [(i * 7 + 3) % 400, (i * 11 + 5) % 400] for i in range(400)}
    rows = []
    for k in range(150):
        w = [r.randrange(400)]
        while len(w) < 40:
            w.append(r.choice(chain[w[-1]]))
        rows.append((k, " ".join(f"w{x}" for x in w)))
    rows += [(900 + i, " ".join(f"new{i}x{j}" for j in range(40))) for i in range(20)] + [(950, rows[0][1])]
    df = frame(spark, rows)
    monkeypatch.setattr(bloom_lm, "PER_SEGMENT", 500)
    whole, parted, few = ({x.doc_id: x for x in bloom_lm.score(df, **o).collect()} for o in ({}, {"most_bits": 4096, "known": 30}, {"known": 30}))
    assert len(parted) == len(rows)
    for k in whole:
        assert parted[k].score == pytest.approx(few[k].score)      # the filter is as good in many passes
        assert parted[k].base_score == pytest.approx(whole[k].base_score)
        assert abs(few[k].score - whole[k].score) < 0.2 * whole[k].n_tokens      # words that are not frequent are known as well
    assert parted[0].score == parted[950].score


def test_license_rules_need_no_other_word(spark):
    texts = {"GPLv3": "gpl-3.0", "GPL-2.0": "gpl-2.0", "LGPL 2.1": "lgpl-2.1", "MPL 2.0": "mpl-2.0", "EPL 1.0": "epl-1.0", "Apache-2.0": None, "MS-PL": "ms-pl", "WTFPL": "wtfpl",
             "Neither the name of Acme nor the names of its contributors": "bsd-3-clause", "it is in the public\ndomain": "public-domain", "Public-Domain": "public-domain",
             "Creative\nCommons": "creative-commons", "any later\nversion": "gpl-or-later", "This program is free\nsoftware: you can redistribute it": "gpl",
             "unauthorised copying": "proprietary"}
    got = {x.doc_id: x.labels for x in license_rules.scan(frame(spark, list(enumerate(texts)))).collect()}
    import re
    for i, (t, label) in enumerate(texts.items()):
        norm = f" {' '.join(re.findall('[0-9a-z]+', t.lower()))} "
        want = {r[0] for r in license_rules.rules() if re.search(f"(?<= )(?:{r[2]})(?= )", norm)}
        assert set(filter(None, got[i].split(","))) <= want and bool(got[i]) == bool(want), t      # the rules decide, without keywords
        assert label is None or label in got[i].split(","), t


def test_line_runs_extend_every_window(spark):
    line = lambda name, n=10: " ".join(f"{name}{i}" for i in range(n))
    l0, l1, w1, w2, tail = line("l"), line("m"), line("v"), line("w"), line("t", 5)
    long = [f"z{i}" for i in range(70)]
    rows = [(1, [w1, w2, line("x")]), (10, [l0, l1, w1, w2, tail]), (20, [l0, l1, w1, w2, tail, line("o")]),
            *((30 + i, long[i:i + 20] + [f"q{i}"]) for i in range(1, 51)), (100, [line("h", 20), *long]), (101, [line("h", 20), *long, "end"])]
    rows = [(k, "\n".join(t)) for k, t in rows]
    got = {x.doc_id: x.gone for x in line_runs.deleted_lines(frame(spark, rows)).collect()}
    assert got[20] == [0, 1, 2, 3, 4] and got[101] == list(range(71))
    assert got == {k: v for (k, _), v in deleted(rows, 20).items()}


def test_line_runs_repeated_rows_and_names(spark):
    line = lambda x, n=10: " ".join(f"{x}{i}" for i in range(n))
    a, b, t = line("a"), line("b"), line("t", 5)
    rows = [(1, [a, b, line("x")]), (5, [a, b, t]), (9, [a, b, t, line("o")]), (2, [line("h"), a, b]), (2, [line("h"), a, b]), (2, [a, b, line("k", 30)]),
            (7, [line("k", 30), "", "  ", line("z")]), (None, [a, b]), (12, [f"w{i} w w w" for i in range(4000)]), (13, [f"w{i} w w w" for i in range(4000)])]
    rows = [(k, "\n".join(x)) for k, x in rows] + [(20, None), (21, ""), (20, None)]
    df = spark.createDataFrame([(*r, 1, "g", 5, 6) for r in rows], "doc_id long, text string, _gone int, gone string, n_lines int, _k int").repartition(3)
    out = line_runs.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "_gone", "gone", "_k", "n_lines", "n_deleted"]
    got = sorted(((x.doc_id or 0), x.text or "", x.n_deleted) for x in out.collect())
    small = [r for r in rows if r[0] not in (12, 13)]
    want = deleted(small, 20) | {(13, rows[9][1]): list(range(4000))}
    cut = lambda k, x: "\n".join(s for i, s in enumerate((x or "").split("\n")) if i not in set(want.get((k, x), [])))
    assert got == sorted((k or 0, cut(k, x), len(want.get((k, x), []))) for k, x in rows)
    assert (9, line("o"), 3) in got and len(got) == len(rows)


def test_pipeline_stages_on_repeated_ids(spark):
    import corpus_pipeline

    word = lambda x, n: " ".join(f"{x}{i}" for i in range(n))
    a = word("a", 40)
    rows = [(1, f"{a}\n{word('b', 30)}"), (2, f"{word('c', 50)}\n{a}\nend of two"), (2, f"{word('c', 50)}\n{a}\nend of two"), (3, None), (4, "")]
    docs = spark.createDataFrame([(k, t, None if t is None else len(t), "s") for k, t in rows], "doc_id long, text string, n_chars long, n_deleted string")
    out = corpus_pipeline.fresh_lines(spark, docs, "")
    assert out.columns == docs.columns
    left = f"{word('c', 50)}\nend of two"
    assert sorted((x.doc_id, x.text, x.n_chars, x.n_deleted) for x in out.where("doc_id < 3").collect()) == [(1, rows[0][1], len(rows[0][1]), "s"), *[(2, left, len(left), "s")] * 2]
    assert out.count() == 5
    one = corpus_pipeline.one_of_each_group(spark, out, "")
    assert sorted(x.doc_id for x in one.collect()) == [1, 2, 3, 4]


def test_page_text_whole_repeated_runs(spark):
    r = random.Random(3)
    words = lambda n: " ".join(f"u{r.randrange(10 ** 9)}" for _ in range(n))
    notices = {f"h{n}.org": words(n) for n in (8, 12, 15, 22, 40, 61)}
    rows, want = [], {}
    for host, notice in notices.items():
        for j in range(8):
            a, b = words(20 + j), words(25)
            rows.append((len(rows), f"http://{host}/{j}", f"<div>{a} {notice} {b}</div>"))
            want[len(rows) - 1] = f"{a} {b}"
    got = {x.page_id: x.text for x in page_text.extract(frame(spark, rows, "page_id long, url string, html string, text string, h string")).collect()}
    assert got == want


def test_page_text_keeps_copies_of_a_page(spark):
    story = " ".join(f"s{i}" for i in range(30))
    rows = [(i, "http://a.org/x", f"<div>{story}</div>") for i in range(3)] + [(10 + i, f"http://b.org/{i}", f"<article><p>{story}</p></article>") for i in range(12)]
    rows += [(30 + i, f"http://b.org/o{i}", f"<article><p>other {i} {i * 3}</p></article>") for i in range(2)]
    rows += [(40 + i, f"http://c.org/{i}", f"<div>{story}</div><div>news {i // 2}</div>") for i in range(6)]       # three pages, each twice
    got = {x.page_id: x.text for x in page_text.extract(frame(spark, rows, "page_id long, url string, html string, text string, h string")).collect()}
    assert all(got[k] == story for k in [0, 1, 2, *range(10, 22)]) and got[31] == "other 1 3"
    assert [got[40 + i] for i in range(6)] == [f"news {i // 2}" for i in range(6)]


def test_words_hashed_at_once_have_the_library_s_hashes():
    import numpy as np

    from boxloom.llm.common import WordHashes, lowered_hashes

    rng = np.random.default_rng(3)
    texts = [b"", b" \t", b"One ONE\x0btwo\x0c", "Ärger ÄRGER".encode()] + [b"A" * k + b" b\n" for k in range(70)]
    texts += [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in rng.integers(0, 300, 200)]
    h, n = lowered_hashes(texts)
    want = [WordHashes().of(t.lower().split()) for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert h.tolist() == np.concatenate(want).tolist()
    assert [x.tolist() for x in lowered_hashes([])] == [[], []]


def test_jaccard_and_packing_read_texts_in_small_batches(spark):
    from boxloom.llm import jaccard_join, packing, quality
    from boxloom.llm.common import slices, small_batches

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark, 300):
        assert spark.conf.get(name) == "300"
        sizes = spark.range(2_000, numPartitions=1).mapInArrow(lambda bs: (b.slice(0, 1).set_column(0, "id", b.column(0).slice(0, 1)) for b in bs), "id long").count()
        assert sizes == 7
    assert spark.conf.get(name) == before
    import pyarrow as pa
    parts = list(slices([pa.RecordBatch.from_pydict({"a": list(range(1_201))})]))
    assert [p.num_rows for p in parts] == [500, 500, 201] and [x for p in parts for x in p.column(0).to_pylist()] == list(range(1_201))
    docs = spark.createDataFrame([(i, f"word{i // 2} and some other words {i // 2} of a text") for i in range(1_300)], "doc_id long, text string")
    out = jaccard_join.join(docs.coalesce(1))
    assert out.where("component_id <> doc_id - doc_id % 2").count() == 0 and out.count() == 1_300
    assert packing.pack(packing.pieces(docs)).count() == 1_300
    assert quality.keep_good(docs.coalesce(1), [0.0] * (1 << quality.BITS) + [5.0]).count() == 1_300
    assert spark.conf.get(name) == before
