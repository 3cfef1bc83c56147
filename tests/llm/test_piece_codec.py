"""Encoding against the library that the model comes from, spans, and round trips."""
import hashlib
import random

import pytest

pytest.importorskip("boxloom.llm")
import public_tokenizers  # noqa: E402
import sentencepiece  # noqa: E402

from boxloom.llm import piece_codec  # noqa: E402

ODD = ["", " ", "  ", "\n", "▁", "▁▁a ▁", "a▁b", "<s>x</s><unk><0x0A>", "日本語のテキスト" * 500, "👩‍👩‍👧 ﷽", "\x00a", "    indented\n\t\tx  ", "a" * 5000,
       " ⁇ ", "�", "Ａｂｃ ﬁ ½ 각", "  x  y ﷽ ", "①②  ㌔", "word " * 20000]


def texts():
    r = random.Random(1)
    return ODD + ["".join(r.choice(" \n▁ab日é🙂the") for _ in range(r.randrange(60))) for _ in range(500)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_codec.MODEL))


def test_ids_and_spans(library):
    own = piece_codec.codec()
    for t in texts():
        ids, starts, ends = own.encode(t)
        want = library.encode(t, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in want]
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [(p.begin, p.end) for p in want]


def test_decode_of_any_ids(library):
    own, r = piece_codec.codec(), random.Random(2)
    for _ in range(2000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), 259, 0, 1, 2]) for _ in range(r.randrange(9))]
        assert own.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_map(rule):
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    own = piece_codec.Normaliser(next(v for k, v in piece_codec.fields(made.serialized_model_proto()) if k == 3))
    assert own.map.units
    for t in texts():
        want, places = made.normalize(t, with_offsets=True)
        got, back = own(t)
        assert got == want
        chars = [len(got[:i].encode()) for i in range(len(got) + 1)]
        assert [int(back[c]) for c in chars] == [len(t[:p].encode()) for p in places]


def test_tables(spark, library):
    rows = [(1, "a b"), (1, "a b"), (None, "x\ny"), (3, None), (4, "日本 " * 30000), (5, "")]
    df = spark.createDataFrame([(*r, "n", 7) for r in rows], "doc_id long, text string, ids string, n_tokens int").repartition(3)
    got = sorted(((r.doc_id or 0), r.n_tokens, r.ids_sha256, r.decoded_sha256, r.spans_whole) for r in piece_codec.digests(df).collect())
    want = []
    for k, t in rows:
        ids = library.encode(t or "") + [2]
        want.append((k or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), True))
    assert got == sorted(want)
    coded = piece_codec.encode(df)
    back = sorted((r.doc_id or 0, r.text) for r in piece_codec.decode(coded).collect())
    assert back == sorted((k or 0, t or "") for k, t in rows)
    spans = {r.doc_id: r for r in coded.collect()}
    assert spans[3].ids == [2] and spans[3].starts == spans[3].ends == [0]
    assert spans[1].starts == [0, 1, 3] and spans[1].ends == [1, 3, 3]
    assert piece_codec.digests(df.limit(0)).count() == piece_codec.encode(df.limit(0)).count() == 0
    odd = spark.createDataFrame([("k", [5, None]), ("l", None), ("m", [40000]), ("n", [])], "doc_id string, ids array<int>")
    assert {r.doc_id: r.text for r in piece_codec.decode(odd).collect()} == {"k": None, "l": None, "m": None, "n": ""}
