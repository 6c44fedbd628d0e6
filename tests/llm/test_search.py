import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskframe.llm import chosen_path, license_dice, pq_dedup, spaced_seeds
from riskframe.llm.common import table
from riskframe.llm.words import shingle_sets


def _brute(texts):
    """(links, class number) of every text by exact Jaccard of all pairs."""
    sets = [frozenset(s.tolist()) for s in shingle_sets(pa.array(texts, pa.string()))]
    links, head = [0] * len(sets), list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            low, high = sorted((head[a], head[b]))
            head = [low if h == high else h for h in head]
    return links, head


def _variants(n, words, changes, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(changes + 1)):
            w[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_join_equals_brute_force_with_a_large_group(spark):
    texts = _variants(330, 150, 4, 1) + _variants(20, 60, 1, 2) + ["same old text of a few words"] * 15 + [f"free {i} text {i * 7} of its own {i * 13} words" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = chosen_path.near_duplicates(docs, bucket_limit=32).orderBy("doc_id").collect()
    links, head = _brute(texts)
    assert [r.n_links for r in got] == links and [r.class_id for r in got] == head
    assert sum(r.keeper for r in got) == len(set(head))


def test_runs_reach_the_target():
    assert chosen_path.runs_for(0.9) < chosen_path.runs_for(0.9999) <= 5


def test_join_awkward(awkward, no_docs):
    got = {(r.doc_id, r.n_copies): r for r in chosen_path.near_duplicates(awkward).collect()}
    assert got[6, 2].n_links == 1 and got[1, 1].class_id == 1 and got[4, 1].n_links == 0
    kept = chosen_path.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.count() == 10
    assert chosen_path.near_duplicates(no_docs).count() == 0


def test_leaks_tolerate_substitutions(spark):
    rnd = random.Random(3)
    items = [" ".join(f"t{rnd.randrange(5000)}" for _ in range(n)) for n in (14, 30, 60)] + ["", None]
    def changed(text, k):
        w = text.split()
        for i in rnd.sample(range(len(w)), k):
            w[i] = "other"
        return " ".join(w)
    fill = lambda n: " ".join(f"c{rnd.randrange(5000)}" for _ in range(n))
    docs = [fill(50) + " " + items[0] + ". " + fill(9), fill(5) + " " + changed(items[1], 4) + " " + fill(80), changed(items[2], 9), fill(200),
            items[2].split()[0] + " " + fill(30), None, "", "T" + items[0][1:].upper()]
    got = spaced_seeds.detect(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), block_tokens=20).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 0), (1, 1), (2, 2), (7, 0)}
    assert next(r for r in got if r.doc_id == 0).first_token == 50


def test_masks_hit_every_window_with_two_substitutions():
    for bad in itertools.combinations(range(13), 2):
        assert any(all(s + o not in bad for o in spaced_seeds._offsets(m)) for m in spaced_seeds.MASKS for s in range(13 - len(m) + 1))


def test_best_segment_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(300):
        equal = rng.random(rng.integers(1, 30)) < rng.choice([0.3, 0.7, 0.85])
        most = max((int(equal[i:j].sum()) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1) if 5 * equal[i:j].sum() >= 4 * (j - i)), default=0)
        first, length, n = spaced_seeds._best_segment(equal)
        assert n == most == equal[first: first + length].sum() and 5 * n >= 4 * length


@pytest.mark.parametrize("words, replaced, least", [(5, 1, 1), (6, 1, 1), (7, 1, 1), (8, 1, 1), (9, 1, 1), (10, 1, 0.9), (12, 1, 1), (15, 2, 0.9), (15, 3, 0.9), (20, 3, 0.9), (20, 4, 0.9), (40, 8, 0.9)])
def test_whole_copies_with_replaced_words_are_found(words, replaced, least):
    rnd = random.Random(words * 100 + replaced)
    items = [[f"i{i}w{k}" for k in range(words)] for i in range(300)]
    texts = []
    for w in items:
        bad = rnd.sample(range(words), replaced)
        texts.append(" ".join(["before", "it"] + [f"new{k}" if k in bad else x for k, x in enumerate(w)] + ["behind"]))
    index = spaced_seeds.build_index([(i, " ".join(w)) for i, w in enumerate(items)])
    found = {(t, i): n for t, i, _, _, n in spaced_seeds.find_overlaps(pa.array(texts), index)}
    assert set(found) <= {(i, i) for i in range(300)} and len(found) >= least * 300


def test_short_items_need_80_percent():
    index = spaced_seeds.build_index([(1, "a b c d e"), (2, "k l m n o p")])
    texts = pa.array(["x a b c d e", "a b x d e", "a x c x e", "k l m n o x", "k l m x x p"])
    assert sorted(spaced_seeds.find_overlaps(texts, index)) == [(0, 0, 1, 5, 5), (1, 0, 0, 5, 4), (3, 1, 0, 5, 5)]


def test_leaks_awkward(awkward, no_docs, spark):
    tests = spark.createDataFrame([(1, "one two three four"), (None, "a text of no known number at all here"), (3, None)], "item_id long, text string")
    got = spaced_seeds.detect(awkward, tests).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(None, -1)]  # four words are shorter than every mask
    clean = spaced_seeds.remove(awkward, tests)
    assert clean.columns == awkward.columns and clean.count() == 10
    assert spaced_seeds.detect(no_docs, tests).count() == 0 and spaced_seeds.detect(awkward, tests.limit(0)).count() == 0


def test_license_equals_brute_force(spark):
    mit = license_dice.TEMPLATES[3][1]
    docs = ["prose\nReleased under the MIT License.\nmore", "Licensed under CC BY-NC 4.0.", "x\n\n" + mit.replace(". ", ".\n") + "\n\ny", "licensed under the apache license version 2 0 today",
            "by the way, other copies of this", None, "", "License", mit + " with a few words more at its end", "This work is licensed under the GNU General Public License, version 2."]
    got = {(r.doc_id, r.license): (r.dice, r.n_units) for r in license_dice.scan(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()}
    want = {}
    import re
    for i, d in enumerate(docs):
        t = (d or "").lower()
        for u in dict.fromkeys([*t.split("\n"), *re.split(r"\n\s*\n", t), t]):
            g = license_dice.bigrams(u)
            best = max(((2 * len(g & license_dice.bigrams(x)) / (len(g) + len(license_dice.bigrams(x))), -k, n) for k, (n, x) in enumerate(license_dice.TEMPLATES)), default=(0, 0, ""))
            if g and best[0] >= 0.8:
                v, c = want.get((i, best[2]), (0, 0))
                want[i, best[2]] = (max(v, round(best[0], 6)), c + 1)
    assert got == want and (2, "MIT") in got and (9, "GPL-2.0") in got


def test_license_inside_long_documents(spark):
    names, texts = zip(*license_dice.TEMPLATES)
    long = [(n, t) for n, t in license_dice.TEMPLATES if len(license_dice.bigrams(t)) >= license_dice.LONG]
    assert {"MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"} <= {n for n, _ in long}
    prose = lambda k, n=400: " ".join(f"p{k}x{i}" for i in range(n))
    wrap = lambda t, n=9: "\n".join(" ".join(t.split()[i: i + n]) for i in range(0, len(t.split()), n))
    mit = names.index("MIT", 3)
    docs = [prose(0) + "\n\n" + texts[mit].replace(": The above", ":\n\nThe above").replace(". THE", ".\n\nTHE") + "\n\n" + prose(1)]  # paragraphs in a long document
    docs += [prose(2) + "\n" + wrap(t) + "\nint main ( ) " + prose(3) for _, t in long]  # hard-wrapped, code directly after it
    docs += [prose(4) + " " + t + " " + prose(5) for _, t in long]  # in the middle of a line
    docs += [prose(6) + "\n" + wrap(texts[mit]) + "\n" + prose(7, 30) + "\n" + wrap(texts[mit]) + "\n" + prose(8), prose(9) + " " + " ".join(texts[mit].split()[:60]) + " " + prose(10)]
    rows = license_dice.scan(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    want = {(i, n): (1.0, 1) for i, n in enumerate(["MIT", *[n for n, _ in long] * 2])} | {(len(docs) - 2, "MIT"): (1.0, 2)}
    want[next(i for i, n in want if n == "Apache-2.0"), "Apache-2.0"] = (1.0, 2)  # its first wrapped line is a short notice too
    assert {(r.doc_id, r.license): (r.dice, r.n_units) for r in rows} == want


def test_license_awkward(awkward, no_docs):
    assert license_dice.scan(awkward).count() == 0 and license_dice.scan(no_docs).count() == 0


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 32))
    for i in range(0, 300):
        x[i] = x[i % 9] + rng.normal(scale=0.04 * (i % 7), size=32)
    got = {r.vec_id: r for r in pq_dedup.near_duplicates(_vectors(spark, [(i, [float(f) for f in v], 0) for i, v in enumerate(x)]), list_rows=60).collect()}
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    near = (y @ y.T >= 0.95) & ~np.eye(len(y), dtype=bool)
    assert [got[i].n_links for i in range(700)] == near.sum(axis=1).tolist()
    comp = np.arange(700)
    while True:
        low = np.minimum(comp, np.where(near, comp[None, :], 700).min(axis=1))
        if (low == comp).all():
            break
        comp = low
    assert [got[i].component_id for i in range(700)] == comp.tolist() and all(got[i].kept == (comp[i] == i) for i in range(700))


def test_embeddings_awkward(spark):
    one = [1.0, 0.0, 2.0, 0.5]
    rows = [(1, one, 0), (2, [2 * v for v in one], 1), (3, [0.0] * 4, 0), (4, None, 0), (5, [1.0, float("nan"), 0.0, 0.0], 0), (6, [1.0, None, 0.0, 0.0], 0),
            (7, [float("inf"), 0.0, 0.0, 0.0], 0), (8, [1.0, 0.0], 0), (1, one, 0), (None, one, 2), (9, [], 0)]
    got = collections.Counter((r.vec_id, r.n_links, r.component_id) for r in pq_dedup.near_duplicates(_vectors(spark, rows)).collect())
    assert got[1, 3, 1] == 2 and got[2, 3, 1] == 1 and got[None, 3, 1] == 1
    assert all(got[i, 0, i] == 1 for i in (3, 4, 5, 6, 7, 8, 9))
    assert pq_dedup.near_duplicates(_vectors(spark, [])).count() == 0


def test_embeddings_of_every_length_link_among_themselves(spark):
    rows = [(i, [1.0, 0.0, 0.0, float(i)], 0) for i in range(6)] + [(10, [0.5, 0.5], 0), (11, [2.0, 2.0], 0), (12, [1.0, -1.0], 0)]
    rows += [(20, [3.0], 0), (21, [4.0], 0), (22, [-4.0], 0)] + [(30 + i, [1.0, 1.0, 2.0], 0) for i in range(40)]
    table = _vectors(spark, rows).withColumns({"rid": F.lit("x"), "vec": F.lit(7), "list": F.lit(1), "near": F.lit(0.5)})
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq_dedup.near_duplicates(table).collect()}
    for i, x, _ in rows:
        near = [j for j, y, _ in rows if j != i and len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95]
        assert got[i][0] == len(near), i
    assert got[10] == (1, 10) and got[11] == (1, 10) and got[12] == (0, 12) and got[21] == (1, 20) and got[22] == (0, 22) and got[45] == (39, 30)


@pytest.mark.parametrize("seed", [1, 2])
def test_probes_are_sufficient(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(400, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = pq_dedup.fit_index(x, 12)
    home, _, _ = pq_dedup.encode(x, index)
    r, c = pq_dedup.probes(x, home, index, 0.4)
    seen = set(zip(r.tolist(), c.tolist()))
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert all((i, home[j]) in seen for i, j in zip(*np.nonzero(d <= 0.4)))


def test_one_sided_probes_are_known_to_the_other_end():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 300))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = pq_dedup.fit_index(x, 20)
    home, _, _ = pq_dedup.encode(x, index)
    seen = set(zip(*(v.tolist() for v in pq_dedup.probes(x, home, index, 0.31))))
    for h in range(20):
        mine = np.flatnonzero(home == h)
        for c in range(20):
            assert pq_dedup.reaches(x[mine], h, np.full(len(mine), c), index, 0.31).tolist() == [(i, c) in seen for i in mine]
    assert any((i, home[j]) in seen and (j, home[i]) not in seen for i in range(500) for j in range(500))


def test_low_rank_links_count_for_both_ends(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 5)) @ rng.normal(size=(5, 300))
    rows = [(i, [float(f) for f in v], 0) for i, v in enumerate(x)] + [(900 + i, [float(f) for f in x[0]], 0) for i in range(450)]
    got = {r.vec_id: r for r in pq_dedup.near_duplicates(_vectors(spark, rows), list_rows=60).collect()}
    y = np.array([v for _, v, _ in rows], np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    true = (y @ y.T >= 0.95).sum(axis=1) - 1
    links = np.array([got[i].n_links for i in range(len(rows))])
    assert (links <= true).all() and links.sum() >= 0.9 * true.sum() and links.sum() % 2 == 0
    assert len({(got[i].n_links, got[i].component_id) for i in [0, *range(900, 1350)]}) == 1 and links[0] >= 450


def test_components(spark):
    from riskframe.llm.common import connected_components

    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 7), (200, 201), (5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 1, 200: 200, 201: 200}


def test_rank_is_gapless(spark):
    from riskframe.llm.common import with_rank

    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2))
    rows = with_rank(df, ["g"], [F.col("id")], F.xxhash64("id"), 5000, "r", per_bucket=64).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.g].append(r.r)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(rows) == 5000
