"""Spelling variants against comparing all words with all."""
import random
import zlib
from collections import Counter

import pytest

pytest.importorskip("boxloom.llm")
from boxloom.llm import spelling  # noqa: E402


def edits(a, b):
    """Whether one insertion, deletion or replacement turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute(rows):
    n = Counter()
    for k, t in rows:
        run = ""
        for c in (t or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
                w = run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]
                if len(w) >= 5:
                    n[w] += 1
            run = ""
    n = {w: c for w, c in n.items() if c >= 3}
    out = {}
    for w, c in n.items():
        near = sorted((-n[v], v) for v in n if edits(w, v))
        form = near[0][1] if near and -near[0][0] >= 2 * c else None
        out[w] = [form, w, c, len(near), form and n[form]]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def documents(seed, alphabet, width):
    r = random.Random(seed)
    words = ["".join(r.choice(alphabet) for _ in range(r.randrange(4, width))) for _ in range(60)]
    for w in words[:40]:
        for _ in range(6):
            i = r.randrange(len(w) + 1)
            words.append(w[:i] + r.choice(["", r.choice(alphabet), r.choice(alphabet) + w[i:i + 1]]) + w[i + 1:])
    return [(i % 50, r.choice([" ", "-", "1"]).join(r.choices(words, [1 / (j % 37 + 1) for j in range(len(words))], k=60))) for i in range(120)]


@pytest.mark.parametrize("meet", [1 << 14, 3])
def test_against_all_pairs(spark, meet):
    rows = documents(1, "abé", 9) + documents(2, "abcdeXYZ×ß", 14)
    rows += [(None, None), (7, ""), (None, "Hello hello hellos " * 4), (9, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999 + "y " + "x" * 2999 + "y " + "x" * 2999 + "y ")]
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group(df, meet=meet).collect()}
    want = brute(rows)
    assert got == want
    assert any(v[1] not in (w, v[0]) for w, v in want.items())       # some chain has two steps
    assert max(v[3] for v in want.values()) > 5


def test_empty_and_text_keys(spark):
    df = spark.createDataFrame([("a", "green green green greens greens greens gren")], "doc_id string, text string")
    assert {r.word: (r.form, r.n, r.n_near) for r in spelling.group(df).collect()} == {"green": (None, 3, 1), "greens": (None, 3, 1)}
    assert spelling.group(df.limit(0)).count() == 0
