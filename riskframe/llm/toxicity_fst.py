"""Toxicity by a weighted finite-state pattern grammar.

Tokens become symbols: I insult, T threat verb, P target (a person addressed), N negation,
R reporting verb, O other. Four sequential transducers are composed into one machine that reads a
clause: negation and reported speech mark the insults and threats in their scope, the target
transducer marks those aimed at someone, and the scorer turns each mark into a factor on the
token's weight. A text's value is the sum over its matched clauses; a two-parameter logistic curve
fitted on labelled rows makes it a score from 0 to 1. Words outside a clause with a match count
nothing.

Insult forms and their weights are learned: the documents of a bounded sample of labelled rows
(``train_rows``) give, for every word and word stem (first 4 to 7 letters), the numbers of toxic
and other documents that hold it; those which stand out become arcs of the insult transducer with
their log-odds as weight. The seed words below only add to them.

Composed and decomposed letters are the same: texts and arcs are compared in composed form (NFC).

Defined cases: null, empty and wordless texts get the curve's value at 0 (the score of no match);
repeated rows score alike; labels given twice count once, as toxic if any says so; with no usable
labels the seeds and a fixed curve are used; an empty table gives an empty result; other columns
are ignored by ``score`` and kept by ``reject``.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialise, small_batches

# Seed vocabulary of the grammar.
INSULTS = ("idiot", "stupid", "moron", "loser", "scum", "worthless", "pathetic", "disgusting", "trash", "clown", "imbecile", "vermin", "garbage")
THREATS = ("kill", "hurt", "destroy", "stab", "shoot", "beat", "strangle")
TARGETS = ("you", "your", "yourself", "u", "he", "she", "him", "her", "they", "them", "these", "those")
NEGATIONS = ("not", "never", "no", "nobody", "isn", "aren", "wasn", "don", "doesn", "didn", "nicht", "kein", "keine", "ne", "pas", "jamais", "nunca")
REPORTING = ("said", "says", "wrote", "writes", "quoted", "reported", "claimed", "alleged", "tweeted", "according")
SEED_WEIGHT, THREAT_WEIGHT = 2.5, 1.0
TRAIN_ROWS = 10_000
FOLDS = 5
_STEMS = (4, 5, 6, 7)
_SPLIT = r"[^\p{L}\p{M}\p{N}_]+"
_CLAUSE = re.compile(r"[^.!?;:\n]+")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}_]+")  # the words that ``_SPLIT`` leaves when arcs are learned
_SYMBOLS = "ITPNRO"


@dataclass
class Transducer:
    """Sequential transducer: arcs[state][symbol] = (next state, output symbol)."""

    arcs: list[dict[str, tuple[int, str]]]

    def compose(self, other: Transducer) -> Transducer:
        """This machine's output read by ``other``; states are the reachable pairs."""
        states, arcs, todo = {(0, 0): 0}, [], [(0, 0)]
        while todo:
            a, b = todo.pop(0)
            row = {}
            for symbol, (a2, mid) in self.arcs[a].items():
                b2, out = other.arcs[b][mid]
                if (a2, b2) not in states:
                    states[a2, b2] = len(states)
                    todo.append((a2, b2))
                row[symbol] = (states[a2, b2], out)
            arcs.append(row)
        return Transducer(arcs)


def scope_marker(opener: str, length: int, marks: dict[str, str], alphabet: str) -> Transducer:
    """Rewrites symbols by ``marks`` for ``length`` tokens after ``opener``; others pass unchanged."""
    arcs = []
    for left in range(length + 1):
        row = {s: (max(0, left - 1), marks.get(s, s) if left else s) for s in alphabet}
        row[opener] = (length, opener)
        arcs.append(row)
    return Transducer(arcs)


# Output marks: n negated, r reported, X and Y insult and threat aimed at a target.
FACTORS = {"I": 1.0, "X": 1.5, "T": 0.0, "Y": 2.0, "n": -0.25, "r": 0.25}


def grammar() -> Transducer:
    negation = scope_marker("N", 3, {"I": "n", "T": "n"}, _SYMBOLS)
    reported = scope_marker("R", 12, {"I": "r", "T": "r"}, _SYMBOLS + "n")
    target = scope_marker("P", 3, {"I": "X", "T": "Y"}, _SYMBOLS + "nr")
    return negation.compose(reported).compose(target)


@dataclass
class ToxicityModel:
    """Learned arcs and curve; small enough to travel with every task."""

    words: dict[str, float]
    stems: dict[str, float]
    slope: float = 1.0
    intercept: float = -2.0
    machine: Transducer = field(default_factory=grammar)

    def symbol(self, word: str) -> tuple[str, float]:
        w = self.words.get(word)
        if w is not None:
            return "I", w
        for n in _STEMS:
            w = self.stems.get(word[:n]) if len(word) >= n else None
            if w is not None:
                return "I", w
        if word in INSULTS:
            return "I", SEED_WEIGHT
        if word in THREATS:
            return "T", THREAT_WEIGHT
        for symbol, words in (("P", TARGETS), ("N", NEGATIONS), ("R", REPORTING)):
            if word in words:
                return symbol, 0.0
        return "O", 0.0

    def clause_value(self, clause: str) -> float:
        state, total = 0, 0.0
        for word in _WORD.findall(clause):
            symbol, weight = self.symbol(word)
            state, mark = self.machine.arcs[state][symbol]
            total += weight * FACTORS.get(mark, 0.0)
        return max(0.0, total)

    def pattern(self) -> str:
        """A substring pattern that every text with a positive clause matches."""
        forms = {unicodedata.normalize(f, w) for w in (*self.words, *self.stems, *INSULTS, *THREATS) for f in ("NFC", "NFD")}
        return "(?i)" + "|".join(sorted(map(re.escape, forms)))

    def values(self, texts: pa.Array) -> np.ndarray:
        """Sum of clause values per text; texts without any of the forms are skipped by one scan."""
        texts = pc.fill_null(texts, "")
        out = np.zeros(len(texts))
        some = np.flatnonzero(pc.match_substring_regex(texts, self.pattern()).to_numpy(zero_copy_only=False))
        for i in some:
            text = unicodedata.normalize("NFC", texts[int(i)].as_py().lower())
            out[i] = sum(self.clause_value(c) for c in _CLAUSE.findall(text))
        return out

    def scores(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + self.slope * np.minimum(values, 50.0))))


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """At most about ``train_rows`` distinct labelled texts outside the held-out fold: (text, toxic)."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.where(~F.coalesce(held_out("doc_id"), F.lit(True)))
    share = min(1.0, train_rows / max(1, marks.count()))
    marks = marks.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < int(share * 1_000_000))
    both = docs.where("text is not null").select("doc_id", "text").join(marks, "doc_id")
    words = F.split(F.lower("text"), _SPLIT)
    sketch = [F.array_min(F.transform("words", _salted_triple(seed))).alias(f"m{seed}") for seed in (1, 2, 3)]
    both = both.select("text", "toxic", words.alias("words")).select("text", "toxic", *sketch)
    # Copies and near copies say the same thing many times: one text for each min-hash of word triples.
    for name in ("m1", "m2", "m3"):
        rest = [c for c in both.columns if c not in (name, "toxic")]
        both = both.groupBy(name, "toxic").agg(F.min(F.struct(*rest)).alias("r")).select("toxic", name, *[F.col("r")[c].alias(c) for c in rest])
    return both.select("text", "toxic")


def _salted_triple(seed: int):
    return lambda w, i: F.xxhash64(F.lit(seed), w, F.get("words", i + 1), F.get("words", i + 2))


def _longer(n: int):
    return lambda w: F.length(w) >= n


def _prefix(n: int):
    return lambda w: F.concat(F.lit("<"), F.substring(w, 1, n))


def piece_counts(train: DataFrame) -> DataFrame:
    """(piece, whole, pos, neg, forms) for words (whole) and stems found in toxic documents."""
    words = train.select(F.monotonically_increasing_id().alias("row"), "toxic", F.array_distinct(F.filter(
        F.split(F.lower("text"), _SPLIT), lambda w: (F.length(w) >= 3) & (F.length(w) <= 30))).alias("words"))
    stems = F.flatten(F.array(*[F.transform(F.filter("words", _longer(n)), _prefix(n)) for n in _STEMS]))
    pieces = words.select("toxic", F.explode(F.concat("words", F.array_distinct(stems))).alias("p"))
    counts = pieces.groupBy("p").agg(F.sum("toxic").cast("long").alias("pos"), F.sum(1 - F.col("toxic")).cast("long").alias("neg")).where("pos >= 2")
    forms = words.where("toxic = 1").select(F.explode("words").alias("w")).distinct()
    forms = forms.select(F.explode(F.array(*[F.when(F.length("w") >= n, F.concat(F.lit("<"), F.substring("w", 1, n))) for n in _STEMS])).alias("p")).where("p is not null").groupBy("p").agg(F.count("*").alias("forms"))
    return counts.join(forms, "p", "left").select("p", "pos", "neg", F.coalesce("forms", F.lit(1)).alias("forms"))


def _evidence(pos, neg, n_pos, n_neg):
    """Log-likelihood ratio of a piece being as frequent in toxic documents as in others."""
    def ll(k, n, p):
        return k * math.log(max(p, 1e-12)) + (n - k) * math.log(max(1 - p, 1e-12))
    p = (pos + neg) / (n_pos + n_neg)
    return 2 * (ll(pos, n_pos, pos / n_pos) + ll(neg, n_neg, neg / n_neg) - ll(pos, n_pos, p) - ll(neg, n_neg, p))


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, min_evidence: float = 24.0, min_forms: int = 6) -> ToxicityModel:
    """Fit the insult arcs and the curve on the bounded training sample."""
    train = materialise(training_rows(docs, labels, train_rows), "tox-train")
    n_pos, n_neg = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    n_pos, n_neg = int(n_pos), int(n_neg)
    model = ToxicityModel({}, {})
    if not n_pos or not n_neg:
        return model
    # At least ten times as frequent in toxic documents; a stem needs less evidence if only toxic
    # documents hold it, in several forms.
    odds = (F.col("pos") + 0.5) / (n_pos + 1) / ((F.col("neg") + 0.5) / (n_neg + 1))
    kept = piece_counts(train).where((odds >= 10) & (F.col("pos") >= max(2, n_pos // 200))).collect()
    arcs: list[tuple[str, float]] = []
    ranked = sorted(((_evidence(r.pos, r.neg, n_pos, n_neg), r) for r in kept), key=lambda x: (-x[0], x[1].p.startswith("<"), -len(x[1].p), x[1].p))
    for g, r in ranked:
        productive = r.p.startswith("<") and r.neg == 0 and r.forms >= min_forms and g >= 10
        if g < min_evidence and not productive:
            continue
        bare = r.p.lstrip("<")
        covered = any((q.startswith("<") and bare.startswith(q[1:])) or q.lstrip("<").startswith(bare) for q, _ in arcs)
        if not covered:
            weight = math.log((r.pos + 0.5) / (n_pos + 1)) - math.log((r.neg + 0.5) / (n_neg + 1))
            arcs.append((r.p, min(weight, 6.0)))
    model.words = {unicodedata.normalize("NFC", p): w for p, w in arcs if not p.startswith("<")}
    model.stems = {unicodedata.normalize("NFC", p[1:]): w for p, w in arcs if p.startswith("<")}
    values = train.select("toxic", F.pandas_udf(lambda t: pd.Series(model.values(pa.Array.from_pandas(t, type=pa.string()))), "double")("text").alias("v"))
    sample = np.array([(r.toxic, r.v) for r in values.collect()], float)
    model.slope, model.intercept = fit_curve(np.minimum(sample[:, 1], 50.0), sample[:, 0])
    return model


def fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, rounds: int = 60) -> tuple[float, float]:
    """Logistic slope and intercept by Newton steps, lightly penalised so separable data stay finite."""
    a, b = 0.5, -2.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - y) * x).sum() + penalty * a, (p - y).sum() + penalty * b])
        w = p * (1 - p)
        h = np.array([[(w * x * x).sum() + penalty, (w * x).sum()], [(w * x).sum(), w.sum() + penalty]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return float(max(a, 0.0)), float(b)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with a column ``toxicity`` (0 to 1) from the text alone."""
    small_batches(docs.sparkSession)
    @F.pandas_udf("double")
    def value(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(model.values(pa.Array.from_pandas(texts, type=pa.string()))))

    return docs.withColumn("toxicity", value(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = learn(docs, labels, **options)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the texts that score 0.5 or more, columns unchanged."""
    columns = docs.columns
    model = learn(docs, labels, **options)
    slim = docs.withColumnRenamed("toxicity", "_toxicity") if "toxicity" in columns else docs
    out = score(slim, model).where("toxicity < 0.5").drop("toxicity")
    return out.withColumnRenamed("_toxicity", "toxicity") if "toxicity" in columns else out
