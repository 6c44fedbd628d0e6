import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, rounds=4, entries=256):
    """rows: (vec_id, vector, label) of one length that 4 divides, in plain Python integers."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v], a) for i, v, a in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    w = len(kept[0][1]) // 4
    parts = [[v[k * w: (k + 1) * w] for k in range(4)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1]))[:entries]
    books = [[list(parts[j][k]) for j in first] for k in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k in range(4):
            members = {}
            for p in parts:
                members.setdefault(nearest(p[k], books[k])[1], []).append(p[k])
            books[k] = [[sum(c) // len(members[i]) for c in zip(*members[i])] if i in members else e for i, e in enumerate(books[k])]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = [[nearest(p[k], books[k]) for k in range(4)] for p in parts]
    out = [(i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), a) for (i, _, a), f in zip(kept, found)]
    total = Counter()
    for _, _, e, a in out:
        total[a] += e
    return sorted(((i, c, e, total[a], sha) for i, c, e, a in out), key=repr)


def _got(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n, dims, spread", [(1, 1, 1), (2, 3, 5), (64, 2, 3), (65, 16, 2000), (256, 16, 40), (200, 1, 10), (256, 7, 10**7)])
def test_nearest_equals_brute_force_with_ties(n, dims, spread):
    rng = np.random.default_rng(n + dims)
    entries = rng.integers(-spread, spread, (n, dims))
    x = np.concatenate([rng.integers(-3 * spread, 3 * spread, (300, dims)), entries, entries + 1])
    square = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    best, least = vector_codes.SliceIndex(entries).nearest(x)
    assert (best == square.argmin(axis=1)).all() and (least == square.min(axis=1)).all()


def test_cube_masks_hold_the_entries_within_the_radius():
    rng = np.random.default_rng(2)
    entries = rng.integers(-50, 50, (130, 3))
    index = vector_codes.SliceIndex(entries)
    x = rng.integers(-60, 60, (40, 3))
    mask = index._cube(x, np.full(40, 20))
    bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(bool)
    assert (bits == (np.abs(x[:, None] - entries[None]) <= 20).all(axis=2)).all()


def _rows(n, dims, seed):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    return [(i, [c + rnd.gauss(0, 0.2) for c in rnd.choice(centres)], rnd.choice([None, 1, 2])) for i in range(n)]


def test_codes_equal_brute_force(spark):
    rows = _rows(420, 8, 1) + [(1000 + i, [0.25] * 8, 1) for i in range(200)] + [(5, None, 1), (6, [1.0, None] * 4, 2), (7, [math.nan] * 8, None), (8, [math.inf] * 8, 1)]
    rows += [(None, [0.5] * 8, 3), (3, [0.1] * 8, None), (3, [0.1] * 8, None)]
    random.Random(3).shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("vec", "code", "error", "length", "label_error")})
    assert _got(vector_codes.compress(table)) == _brute(rows)


def test_fewer_vectors_than_entries(spark):
    rows = _rows(9, 4, 2)
    got = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
    assert _got(got) == _brute(rows) and all(r.error == 0 for r in got.collect())


def test_lengths_have_codebooks_of_their_own(spark):
    rows = _rows(30, 8, 4) + [(100 + i, v, a) for i, v, a in _rows(30, 4, 5)] + [(200, [], 1), (201, [1.0, 2.0, 3.0], 1)]
    got = {r.vec_id: r for r in vector_codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 62 and got[200].code == "00000000" and got[201].error == 0
    want = {r[0]: r for part in (rows[:30], rows[30:60]) for r in _brute(part)}
    assert all((got[i].code, got[i].error, got[i].codebooks_sha256) == (w[1], w[2], w[4]) for i, w in want.items())


def test_decoded_codes_are_as_far_as_the_error_says(spark):
    rows = _rows(300, 8, 6)
    vectors = spark.createDataFrame(rows, SCHEMA).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    books = vector_codes.fit(vectors, 8)
    src = {r.vec_id: r.vec for r in vectors.collect()}
    for r in vector_codes.decode(vector_codes.encode(vectors, 8, books), books).collect():
        assert sum((math.floor(1024 * a) - b) ** 2 for a, b in zip(src[r.vec_id], r.decoded)) == r.error


def test_too_large_components_and_empty_tables(spark):
    assert vector_codes.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1), (2, [None], 1)], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30] * 4, 1)], SCHEMA)).count()
