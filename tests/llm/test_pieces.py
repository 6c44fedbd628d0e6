import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import piece_merges
from riskframe.llm.common import table

ODD = ["", " ", "  a", "a\nb\tc", "a\x00b", "é́ ﬁ ½ ｆ", "▁x", "x▁ ▁", "hello <s> </s> <0x0A> <unk>", "a\r\nb", "😀🦄ｆ" * 7, "aaaa" * 50, " " * 1000, "ab" * 300,
       "▁" * 37 + "x", " " * 17 + "a " * 9 + " " * 5, "x" * 5000, "漢字かな交じり文" * 20, "=" * 999, "-" * 77 + "=" * 13]


@pytest.fixture(scope="module")
def pieces():
    return piece_merges.PieceModel(piece_merges.MODEL)


def _whole(pieces, texts):
    ids = [pieces.sp.encode(t, add_bos=True, add_eos=True) for t in texts]
    return ids, [pieces.sp.decode(i) for i in ids]


def _ours(pieces, texts):
    ids, decoded = [], []
    for flat, counts in pieces.encode(texts):
        ids += [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
        decoded += pieces.decode(flat, counts)
    return ids, decoded


@pytest.mark.parametrize("alphabet", ["ab  \n.,-=xX01é漢😀thein", "aehinorst", "  ▁t", "of théorie "])
def test_random_texts_equal_the_library(pieces, alphabet):
    rnd = random.Random(alphabet)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(250))) for _ in range(600)]
    assert _ours(pieces, texts) == _whole(pieces, texts)


def test_texts_made_of_pieces_equal_the_library(pieces):
    rnd = random.Random(5)
    texts = ["".join(pieces.sp.id_to_piece(rnd.randrange(259, pieces.size)) for _ in range(rnd.randrange(60))) for _ in range(1500)]
    assert _ours(pieces, texts) == _whole(pieces, texts)


def test_odd_and_long_texts_equal_the_library(pieces):
    rnd = random.Random(6)
    texts = [*ODD, "the" * 40_000, "".join(rnd.choice("ABCDEFabcdef0123456789+/") for _ in range(100_000))]
    assert _ours(pieces, texts) == _whole(pieces, texts)
    assert _ours(pieces, [""]) == _whole(pieces, [""]) and list(pieces.encode([])) == []


def test_kept_words_change_nothing(pieces, monkeypatch):
    rnd = random.Random(7)
    texts = [" ".join("".join(rnd.choice("aeinrst") for _ in range(rnd.randrange(1, 9))) for _ in range(200)) for _ in range(30)]
    want = _whole(pieces, texts)
    monkeypatch.setattr(piece_merges, "_KEPT_WORDS", 300)
    assert [_ours(pieces, texts[i: i + 3]) for i in range(0, 30, 3)] == [(want[0][i: i + 3], want[1][i: i + 3]) for i in range(0, 30, 3)]


def test_merges_equal_one_pair_at_a_time(pieces):
    """Brute force over the same symbols: the best pair, leftmost, again and again."""
    rnd = random.Random(8)
    for _ in range(150):
        word = "".join(rnd.choice(" theinrs") for _ in range(rnd.randrange(1, 25)))
        symbols = pieces.of_char[[ord(c) for c in word]]
        got, first = pieces.merge(symbols, np.zeros(len(symbols), np.int64))
        left = symbols.tolist()
        while len(left) > 1:
            rank, into = pieces._pairs(np.array(left[:-1]), np.array(left[1:]))
            i = int(rank.argmin())
            if rank[i] == piece_merges._NONE:
                break
            left[i: i + 2] = [int(into[i])]
        assert got.tolist() == left and first[0] == 0


def test_ids_that_are_no_text_decode_as_in_the_library(pieces):
    runs = [[1, 3 + 0xC3, 2], [3 + 0xE2, 3 + 0x96, 450], [0, 28705, 28705], [2, 1], [28705], [1, 28705, 28705, 2]]
    ids, counts = np.concatenate([np.array(r) for r in runs]), np.array([len(r) for r in runs])
    assert pieces.decode(ids, counts) == [pieces.sp.decode(r) for r in runs]


def test_query_equals_the_library(spark, pieces):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    src = {r.doc_id: r.text for r in docs.collect()}
    for r in piece_merges.digests(docs).collect():
        (ids,), (text,) = _whole(pieces, [src.pop(r.doc_id)])
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want
    assert not src


def test_encode_then_decode(spark, pieces):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id int, text string")
    both = {r.doc_id: r.decoded for r in piece_merges.decode(piece_merges.encode(docs)).collect()}
    assert [both[i] for i in range(len(ODD))] == _whole(pieces, ODD)[1]


def test_pieces_awkward(awkward, no_docs):
    rows = piece_merges.digests(awkward.withColumn("ids", F.lit(3))).collect()
    assert len(rows) == 11 and {r.doc_id: r.n_tokens for r in rows}[1] == 2 and {r.doc_id: r.n_tokens for r in rows}[3] > 2
    assert sum(r.doc_id == 6 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 2
    assert {r.doc_id: r.decoded_sha256 for r in rows}[1] == hashlib.sha256(b"").hexdigest()
    assert piece_merges.digests(no_docs).count() == 0
    assert piece_merges.decode(piece_merges.encode(no_docs).selectExpr("doc_id", "cast(null as binary) as ids")).count() == 0
