import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskframe.llm import term_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, min_docs=10, top=10):
    """rows: (text, lang, source). The audit in plain Python integers."""
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    in_docs, in_lang, in_group = Counter(), Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [t.translate(FOLD) for t in TERM.findall(text)]
        in_docs.update((lang, t) for t in set(terms))
        in_lang.update((lang, t) for t in terms)
        in_group[lang, source].update(terms)
    out = []
    for lang in {a for _, a, _ in rows}:
        kept = [t for (a, t), n in in_docs.items() if a == lang and n >= min_docs]
        sources = sorted({s for _, a, s in rows if a == lang})

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(in_group[lang, s]) for s in sources}
        q = shares({t: in_lang[lang, t] for t in kept})
        gap = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-gap(p[s][t], q[t]), t.encode(), t) for t in kept if in_group[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def _got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


WORDS = ["a", "Ab", "LONGWORD", "nineteenletterswords", "straße", "ÉCOLE", "naïveté", "漢字", "x" * 8, "x" * 9, "x" * 16, "x" * 17, "y" * 32, "y" * 33, "z" * 300, "é" * 8, "é" * 9]


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice([*WORDS, *"abXY09-_\n\x00\x7f "]) + rnd.choice(["", " ", "1", "\x00"]) for _ in range(rnd.randrange(60))) for _ in range(40)]
    texts += ["", None, "   ", "word", "q" * 100_000]
    groups = np.sort(np.array([rnd.randrange(4) for _ in texts]))
    got, n_docs = Counter(), Counter()
    for terms, group, n, docs in term_audit.count_terms(pa.array(texts, pa.string()), groups):
        for t, g, k, d in zip(terms.tolist(), group.tolist(), n.tolist(), docs.tolist()):
            assert (t.decode(), g) not in got
            got[t.decode(), g], n_docs[t.decode(), g] = k, d
    want, want_docs = Counter(), Counter()
    for text, g in zip(texts, groups.tolist()):
        terms = [t.translate(FOLD) for t in TERM.findall(text or "")]
        want.update((t, g) for t in terms)
        want_docs.update((t, g) for t in set(terms))
    assert got == want and n_docs == want_docs


def test_radix_order_sorts_stably():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 5, 500).astype(np.uint64) << np.uint64(40), rng.integers(0, 2**63, 500).astype(np.uint64) % np.uint64(7)]
    assert term_audit._radix_order(words).tolist() == sorted(range(500), key=lambda i: (int(words[0][i]), int(words[1][i]), i))


def _rows(seed, n, n_sources, langs=("en", "de", None)):
    rnd = random.Random(seed)
    vocabulary = [*WORDS, *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))]
    return [(" ".join(rnd.choice(vocabulary[: rnd.randrange(5, len(vocabulary))]) for _ in range(rnd.randrange(40))), rnd.choice(langs), rnd.choice([None, *(f"s{i}" for i in range(n_sources))])) for _ in range(n)]


@pytest.mark.parametrize("block, chunk", [(64, 4096), (2, 20)])
def test_audit_equals_brute_force(spark, monkeypatch, block, chunk):
    """With blocks of two sources and chunks of 20 terms every path of the pairs runs."""
    monkeypatch.setattr(term_audit, "BLOCK", block)
    monkeypatch.setattr(term_audit, "CHUNK_TERMS", chunk)
    rows = [*_rows(4, 260, 6), ("", "fr", "alone"), (None, "it", "x"), (None, "it", "y"), ("rare words here", "it", "x")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert _got(term_audit.audit(docs)) == _brute(rows)


def test_a_hot_source_and_repeated_documents(spark):
    rows = [("same words of one copy", "en", "hot")] * 400 + _rows(5, 150, 3, ("en",))
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("doc_id", F.lit(1))
    assert _got(term_audit.audit(docs)) == _brute(rows)


def test_audit_awkward(awkward, no_docs, spark):
    extra = awkward.withColumns({c: F.lit(5) for c in ("term", "number", "p", "docs", "value", "rank", "total")})
    got = _got(term_audit.audit(extra, min_docs=1))
    assert got == _brute([(r.text, r.lang, r.source) for r in awkward.collect()], min_docs=1)
    assert term_audit.audit(no_docs).count() == 0
    assert _got(term_audit.audit(awkward)) == _brute([(r.text, r.lang, r.source) for r in awkward.collect()])
