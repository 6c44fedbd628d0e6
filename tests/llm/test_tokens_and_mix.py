import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import apportion, token_blocks
from riskframe.llm.common import table, with_row_ids


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 2**32 - 1])
def test_pfor_round_trip(n, high):
    ids = np.random.default_rng(n + high).integers(0, high, n)
    lengths = np.array([n] if n else [], np.int64)
    payload = token_blocks.pack_segment(ids, lengths)
    got, got_lengths = token_blocks.unpack_segment(payload)
    assert (got == ids).all() and (got_lengths == lengths).all()
    if n > 1000:
        assert (token_blocks.unpack_blocks(payload, 3, 7) == ids[3 * 128: 7 * 128]).all()


def test_outliers_are_exceptions():
    ids = np.full(1280, 7)
    ids[::100] = 40_000
    payload = token_blocks.pack_segment(ids, np.array([1280]))
    assert len(payload) < 600 and (token_blocks.unpack_segment(payload)[0] == ids).all()


def _whole(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_tokens_equal_whole_text_encoding(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = token_blocks.token_blocks(docs, segment_tokens=4096).orderBy("doc_id").collect()
    src = docs.orderBy("doc_id").collect()
    start = 0
    for r, d, ids in zip(got, src, _whole([d.text for d in src]), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_odd_spacing_and_special_strings(spark):
    texts = ["  a  b ", "it's   I'm", "x y z", "<|endoftext|> <|startoftext|>a", "hello <|endoftext|> world", "x<|endoftext|>\n<|endoftext|><|startoftext|>Y.", "<|EndOfText|> <|endoftext |>", "é ́x", "a\tb\nc\r\nd", "1234 56", "don' t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_blocks.token_blocks(docs).collect()}
    want = {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(_whole(texts))}
    assert got == want


def test_tokens_awkward(awkward, no_docs):
    got = token_blocks.token_blocks(awkward).orderBy("start").collect()
    assert len(got) == 11 and [r.doc_id for r in got][:2] == [None, None]
    assert {r.doc_id: r.n_tokens for r in got}[1] == 1 and {r.doc_id: r.n_tokens for r in got}[2] == 1
    assert token_blocks.token_blocks(no_docs).count() == 0


def _fill(sizes, cycle=3, cap=3):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    size = np.array([sizes[n] for n in names], float)
    weight = np.arange(len(names)) % cycle + 1
    fixed = np.zeros(len(names), bool)
    while True:
        level = (size.sum() - cap * size[fixed].sum()) / max(1, weight[~fixed].sum())
        target = np.where(fixed, cap * size, level * weight)
        over = (target > cap * size + 1e-9) & ~fixed
        if not over.any():
            return dict(zip(names, target))
        fixed |= over


def test_targets_refill_capped_shares(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, "d": 5000, None: 7, "Z": 0}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in apportion.source_targets(rows).collect()}
    want = _fill(sizes)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_quotas_are_sainte_lague(spark):
    targets = spark.createDataFrame([(1, 53.0), (2, 24.0), (3, 23.0), (4, 0.0)], "pos int, target double")
    got = {}
    for r in apportion.shard_quotas(targets, shards=2, blocks_per_shard=10).collect():
        got.setdefault(r["shard"], {})[r.pos] = r.quota
    seats = sorted(((t / (2 * k + 1), p) for p, t in ((1, 53.0), (2, 24.0), (3, 23.0)) for k in range(30)), key=lambda x: (-x[0], x[1]))
    for shard in (0, 1):
        part = [p for _, p in seats[shard * 10: shard * 10 + 10]]
        assert got[shard] == {p: part.count(p) for p in set(part)} and sum(got[shard].values()) == 10


@pytest.mark.parametrize("large, small, shards, blocks", [(10_000.0, 20_000, 4, 256), (1_000_000.0, 3, 2, 500), (7.0, 50, 3, 10)])
def test_quotas_equal_a_heap_with_many_small_sources(spark, large, small, shards, blocks):
    import heapq

    rows = [(1, large)] + [(i + 2, 0.5) for i in range(small)]
    heap, want = [(-t, p, 1) for p, t in rows], []
    heapq.heapify(heap)
    for _ in range(shards * blocks):
        key, p, d = heapq.heappop(heap)
        want.append(p)
        heapq.heappush(heap, (-rows[p - 1][1] / (d + 2), p, d + 2))
    got = {(r["shard"], r.pos): r.quota for r in apportion.shard_quotas(spark.createDataFrame(rows, "pos int, target double"), shards, blocks).collect()}
    expected = {}
    for at, p in enumerate(want):
        expected[at // blocks, p] = expected.get((at // blocks, p), 0) + 1
    assert got == expected


def _words_by_shard(docs, plan, shards, blocks, seed):
    """Every word of every source's selection dealt one by one: {rid: words per shard}."""
    n_blocks, total = shards * blocks, sum(len_ for _, _, len_ in docs)
    out = {}
    for source, (bounds, want, order, drawn) in plan.items():
        place = {}
        at = 0
        for rid, n in order:
            out.setdefault(rid, [0] * shards)
            for _ in range(n):
                place[at] = rid
                at += 1
        size, block = at, max(1, -(-total // n_blocks))
        words = [w for b in drawn for w in range(b * block, min(size, (b + 1) * block))]
        for i in range(want):
            shard = next(s for s in range(shards) if bounds[s] <= i < bounds[s + 1])
            out[place[words[i % size]]][shard] += 1
    return out


def test_shards_get_their_quotas_of_words(spark):
    """Shards hold whole quotas, documents at most their epochs, and both sums agree."""
    docs = with_row_ids(table(spark, "/root/testdata/sf0.01", "documents"), "t")
    rows = apportion.mix(docs, shards=5, blocks_per_shard=64).collect()
    by = {}
    for r in rows:
        assert len(r.shard_words) == 5 and min(r.shard_words) >= 0 and sum(r.shard_words) == r.taken
        words = by.setdefault(r.source, [0] * 5)
        by[r.source] = [a + b for a, b in zip(words, r.shard_words)]
    sized = docs.select("source", F.coalesce(F.regexp_count("text", F.lit(apportion.WORD)), F.lit(0)).cast("long").alias("size"))
    targets = apportion.source_targets(sized)
    block = sum(r["size"] for r in rows) / 320
    source = {r.pos: r.source for r in targets.collect()}
    quota = {}
    for r in apportion.shard_quotas(targets, 5, 64).collect():
        quota[source[r.pos], r["shard"]] = r.quota
    for s, words in by.items():
        assert all(abs(w - quota.get((s, i), 0) * block) <= block for i, w in enumerate(words)) or not any(quota.get((s, i)) for i in range(5))
    whole = [sum(w[i] for w in by.values()) for i in range(5)]
    assert all(abs(w - 64 * block) <= 0.5 * block * len(by) for w in whole)


def test_words_of_shards_equal_dealing_one_by_one(spark):
    """One source of 30 words three times, another of 300 words in part, on 3 shards of 4 blocks."""
    sizes = [("a", 10), ("a", 3), ("a", 17), ("b", 120), ("b", 1), ("b", 179), ("c", 1)]
    docs = with_row_ids(spark.createDataFrame([(i, s, "w " * n) for i, (s, n) in enumerate(sizes)], "doc_id long, source string, text string").coalesce(1), "t")
    rows = {r.doc_id: r for r in apportion.mix(docs, shards=3, blocks_per_shard=4, seed=5).collect()}
    h = {r.doc_id: (r.place, r.spread) for r in docs.select("doc_id", F.xxhash64(F.lit(5), "doc_id").alias("place"), F.xxhash64(F.lit(6), "doc_id").alias("spread")).collect()}
    targets = {r.source: r for r in apportion.source_targets(docs.select("source", F.size(F.split(F.trim("text"), " ")).cast("long").alias("size"))).collect()}
    frame = spark.createDataFrame([(t.pos, t.target) for t in targets.values()], "pos int, target double")
    quota = {(r.pos, r["shard"]): r.quota for r in apportion.shard_quotas(frame, 3, 4).collect()}
    plan, total = {}, sum(n for _, n in sizes)
    for s, t in targets.items():
        want, q = int(t.target + 0.5), [quota.get((t.pos, i), 0) for i in range(3)]
        bounds = [0] + ([int(want * (sum(q[: i + 1]) / sum(q)) + 0.5) for i in range(3)] if sum(q) else [want if i >= t.pos % 3 else 0 for i in range(3)])
        order = [(i, n) for i, (x, n) in sorted(enumerate(sizes), key=lambda d: h[d[0]][0]) if x == s]
        n_blocks = -(-t.source_size // -(-total // 12))
        seeded = spark.range(n_blocks).select(F.col("id").cast("int").alias("b"), F.xxhash64(F.lit(5), F.lit(s), F.col("id").cast("int")).alias("h")).orderBy("h", "b").collect()
        plan[s] = (bounds, want, order, [r.b for r in seeded])
    want = _words_by_shard([(i, s, n) for i, (s, n) in enumerate(sizes)], plan, 3, 4, 5)
    assert {i: list(r.shard_words) for i, r in rows.items()} == want
    assert max(sum(w) / sizes[i][1] for i, w in want.items()) == 3


def test_mix_meets_targets(spark):
    docs = with_row_ids(table(spark, "/root/testdata/sf0.01", "documents"), "t")
    rows = apportion.mix(docs).collect()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        t, n = by.get(r.source, (r.target, 0))
        by[r.source] = (t, n + r.taken)
    assert all(abs(t - n) <= 1 for t, n in by.values())
    again = sorted((r.doc_id, r.taken) for r in apportion.mix(docs).collect())
    assert again == sorted((r.doc_id, r.taken) for r in rows)


@pytest.mark.parametrize("sf, error", [("sf0.01", 0.15), ("sf0.1", 0.06)])
def test_whole_rows_meet_targets(spark, sf, error):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    size = F.coalesce(F.regexp_count("text", F.lit(apportion.WORD)), F.lit(0)).cast("long")
    target = {r.source: r.target for r in apportion.source_targets(docs.select("source", size.alias("size"))).collect()}
    largest = {r.source: r.m for r in docs.groupBy("source").agg(F.max(size).alias("m")).collect()}
    got = {r.source: r.n for r in apportion.mixed_documents(docs).groupBy("source").agg(F.sum(size).alias("n")).collect()}
    assert all(abs(got.get(s, 0) - t) <= max(0.5 * largest[s] + 1, 0.01 * t) for s, t in target.items())
    assert all(abs(got.get(s, 0) / t - 1) <= error for s, t in target.items())


def test_mix_awkward(awkward, no_docs, spark):
    rows = apportion.mix(awkward.select("doc_id", "source", "text").withColumn("rid", __import__("pyspark").sql.functions.monotonically_increasing_id())).collect()
    assert len(rows) == 11 and sum(r["size"] for r in rows) > 30_000
    assert all(r.taken == 0 for r in rows if r["size"] == 0)
    mixed = apportion.mixed_documents(awkward)
    assert mixed.columns == awkward.columns and mixed.where("text is null").count() == 0
    assert apportion.mixed_documents(no_docs).count() == 0
