"""Main text of pages against a search of all repeated substrings of every length."""
import random

import pytest

pytest.importorskip("boxloom.llm")
from boxloom.llm import page_text  # noqa: E402

SCHEMA = "page_id long, url string, html string, text string, h string, content long, row long, keys string"


def frame(spark, rows):
    """Rows with extra columns whose names clash with those of steps."""
    return spark.createDataFrame([(*r, "x", "y", 1, 2, "z") for r in rows], SCHEMA).repartition(3)


def made(spark, rows):
    return {x.page_id: x.text for x in page_text.extract(frame(spark, rows)).collect()}


def brute(pages):
    """``pages``: of one host, lists of (block, inside).  Every substring of at least eight words, and every whole block
    that is shorter, is looked for on all distinct pages; what enough of them have is covered."""
    distinct = {tuple(p) for p in pages}
    least = {True: max(10, 0.8 * len(distinct)), False: max(3, 0.1 * len(distinct))}
    on = {}
    for number, page in enumerate(distinct):
        for block, side in page:
            w = block.split(" ")
            whole = [(0, len(w))] if len(w) < 8 else [(i, j) for i in range(len(w)) for j in range(i + 8, len(w) + 1)]
            for i, j in whole:
                on.setdefault((side, len(w) < 8, tuple(w[i:j])), set()).add(number)
    out = []
    for page in pages:
        left = []
        for block, side in page:
            w, gone = block.split(" "), set()
            for i, j in [(0, len(w))] if len(w) < 8 else [(i, j) for i in range(len(w)) for j in range(i + 8, len(w) + 1)]:
                if len(on[side, len(w) < 8, tuple(w[i:j])]) >= least[side]:
                    gone |= set(range(i, j))
            left.append(" ".join(x for k, x in enumerate(w) if k not in gone))
        out.append("\n\n".join(t for t in left if t))
    return out


@pytest.mark.parametrize("part", [1 << 18, 150])
def test_against_all_substrings(spark, monkeypatch, part):
    monkeypatch.setattr(page_text, "PART", part)
    r = random.Random(8)
    rows, want = [], {}
    for host, size in (("a.org", 40), ("b.org", 14), ("c.org", 2), ("d.org", 9)):
        common = [[f"{host[0]}{r.randrange(5)}" for _ in range(r.choice([2, 5, 7, 9, 14, 30]))] for _ in range(6)]
        pages = []
        for _ in range(size):
            page = []
            for _ in range(r.randrange(1, 4)):
                w = [f"u{r.randrange(10 ** 6)}" for _ in range(r.randrange(3))]
                for _ in range(r.randrange(1, 3)):
                    w += r.choices(common, [9, 5, 5, 3, 3, 1])[0] + [f"u{r.randrange(10 ** 6)}" for _ in range(r.randrange(4))]
                page.append(" ".join(w))
            pages.append(page)
        pages += pages[:5]                                       # copies are no further pages
        for inside in (False, True):
            own = "in" if inside else "out"
            found = [[(b, inside) for b in p] for p in pages]
            for page, text in zip(found, brute(found), strict=True):
                body = "".join(f"<p>{b}</p>" for b, _ in page)
                rows.append((len(rows), f"http://{own}.{host}/{len(rows)}", f"<article>{body}</article>" if inside else body))
                want[len(rows) - 1] = text
    assert made(spark, rows) == want
    assert len({v for v in want.values()}) > 40


def test_paragraphs_of_the_article_stay(spark):
    rows = [(1, "http://a.org/1", '<article><p class="notice-period">Two weeks.</p><h2 class="related-work">Others</h2><p class="work related">gone</p><p>see '
             '<math><mi>x</mi><mo>+</mo><mn>1</mn></math> and <svg><title>t</title><text>drawn</text></svg></p><div class="cookie-banner">gone</div>'
             '<object><p>shown</p></object></article><p class="notice-period">gone</p>')]
    assert made(spark, rows) == {1: "Two weeks.\n\nOthers\n\nsee x+1 and drawn\n\nshown"}


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = [(None, "http://a.org/1", "<p>one"), (2, None, "<p>two"), (3, "x", None), (4, "http://a.org/4", ""), (5, "http://a.org/5", f"<article>{long}"),
            (6, "http://a.org/6", "<p>same<p>twice"), (6, "http://a.org/6", "<p>same<p>twice"), (7, "http://a.org/7", "<" * 50_000 + "a" + "<b " * 20_000)]
    df = page_text.extract(frame(spark, rows))
    got = sorted((x.page_id or 0, x.text, x.n_chars) for x in df.collect())
    assert [g[:2] for g in got[:-1]] == [(0, "one"), (2, "two"), (3, ""), (4, ""), (5, long), (6, "same\n\ntwice"), (6, "same\n\ntwice")]
    assert all(n == len(t) for _, t, n in got)
    assert page_text.extract(frame(spark, rows).limit(0)).count() == 0
