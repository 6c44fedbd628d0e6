"""Personal data by weak-supervision aggregation (DataFrame operations only).

1. Candidates: e-mail, ip, card and phone spans by their formats (the base spans, always kept) and
   mixed letter-digit tokens of 16 characters or more, possible secrets.
2. Labelers vote on every candidate (1, -1 or 0 for no opinion): a strict-format regex, a gazetteer
   of words before it, its context characters, and its shape.
3. The votes of all candidates are counted by pattern (at most 5 kinds x 3^4 patterns, whatever the
   input); expectation-maximisation over these counts estimates the prior and each labeler's
   reliability per class, and so a probability for each pattern.
4. The final span classifier is a logistic regression (``pyspark.ml``) on the candidates' features,
   counted by feature pattern and weighted by those probabilities. Spans at 0.5 or more are added.

Positions are code points; a span's start is the length of what the pattern left between matches
before it plus the matches themselves, so texts are cut with the JVM's regular expressions only.

Defined cases: null, empty and wordless texts have no spans; repeated rows are rows of their own;
no candidates at all, or candidates of one class only, leave the base spans; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import materialise

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = ("email", "ip", "card", "phone")
# A run that can't start a match fails once, not at each of its characters: \G or no run before it.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{16,}+",
}
# What a text must hold for the pattern to be tried at all.
HINTS = {"email": "@", "phone": "+"}
# Gazetteer of the words that announce or deny personal data.
ANNOUNCE = r"(?:e-?mail|mail|contact|phone|tel|call|fax|mobile|card|visa|account|iban|ip|host|server|address|from|to|token|password|passwd|pwd|secret|api|key|login|user)"
DENY = r"(?:version|isbn|issn|doi|order|invoice|article|chapter|section|page|sha256|md5|commit|checksum|build)"
CONTEXT = 24


def _matches(kind: str) -> Column:
    """Array of (gap, left, match, right) for one kind: gap is the number of characters since the last match."""
    found = F.regexp_extract_all("t", F.lit(PATTERNS[kind]), F.lit(0))
    if kind in HINTS:
        found = F.when(F.instr("t", HINTS[kind]) > 0, found).otherwise(F.array().cast("array<string>"))
    return found


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    n = F.length(digits)
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: F.when((n - i) % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substr(digits, i, F.lit(1)).cast("int") + 1)).otherwise(F.substr(digits, i, F.lit(1)).cast("int")))
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    n = F.length(digits)
    octets = F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^[0-9]{1,3}$") & (F.regexp_replace(p, "^0+(?=.)", "").try_cast("int") <= 255))
    return (F.when(kind == "ip", octets).when(kind == "card", n.between(12, 19) & luhn(digits)).when(kind == "phone", n.between(9, 15)).otherwise(True))


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): stored rows (rid, doc_id) and their valid candidates (rid, kind_no, start, end, match, left, right)."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    rows = rows.select("rid", "doc_id", "t", *[_matches(k).alias(f"m_{k}") for k in KINDS])
    parts = []
    for no, kind in enumerate(KINDS):
        gaps = F.split("t", PATTERNS[kind], -1)
        cut = F.transform(f"m_{kind}", lambda m, i: F.struct(F.lit(no).alias("kind_no"), i.alias("pos"), m.alias("match")))
        zipped = F.zip_with(cut, F.slice(F.transform(gaps, lambda g: F.struct(F.length(g).alias("gap"), F.right(g, F.lit(CONTEXT)).alias("left"))), 1, F.size(f"m_{kind}")),
                            lambda a, b: F.struct(a["kind_no"].alias("kind_no"), a["pos"].alias("pos"), a["match"].alias("match"), b["gap"].alias("gap"), b["left"].alias("left")))
        parts.append(F.when(F.size(f"m_{kind}") > 0, zipped).otherwise(F.array().cast("array<struct<kind_no:int,pos:int,match:string,gap:int,left:string>>")))
    rows = materialise(rows.select("rid", "doc_id", F.concat(*parts).alias("found")), "pii-rows")
    flat = rows.where(F.size("found") > 0).select("rid", F.inline("found"))
    before = Window.partitionBy("rid", "kind_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flat = flat.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(before)).withColumn("start", F.col("end") - F.length("match"))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind_no") + 1)
    spans = flat.withColumn("kind", kind).where(_valid(F.col("kind"), F.col("match")))
    return rows.select("rid", "doc_id"), materialise(spans.select("rid", "kind_no", "kind", "start", "end", "match", "left"), "pii-spans")


def votes() -> dict[str, Column]:
    """Labelers: name -> vote (1, -1, 0) on a candidate."""
    kind, match, left = F.col("kind"), F.col("match"), F.lower("left")
    digits = F.length(_digits(match))
    strict = (F.when(kind == "email", F.when(match.rlike(r"\.[A-Za-z]{2,24}$"), 1).otherwise(-1))
              .when(kind == "ip", F.when(match.rlike(r"^(0|127|255)\.|\.0\.0\.0$|^1\.0\.0|(^|\.)0[0-9]"), -1).otherwise(1))
              .when(kind == "card", F.when((digits >= 13) & match.rlike("^[2-6]"), 1).otherwise(0))
              .when(kind == "phone", F.when(match.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]"), 1).otherwise(0))
              .otherwise(F.when(match.rlike("^[0-9a-f]+$") | (F.length(match) >= 24), 1).otherwise(-1)))
    words = (F.when(left.rlike(rf"(?<![a-z]){DENY}[^a-z]*$"), -1).when(left.rlike(rf"(?<![a-z]){ANNOUNCE}[^a-z]*$"), 1).otherwise(0))
    context = (F.when(left.rlike(r"[=:]\s*[\"']?$"), 1).when(left.rlike(r"[\p{L}0-9_/.#-]$"), -1).otherwise(0))
    kinds = F.size(F.array_distinct(F.split(match, "")))
    shape = F.when(kinds >= 8, 1).when(kinds <= 3, -1).otherwise(0)
    return {"strict": strict, "words": words, "context": context, "shape": shape}


def em(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Probability of the positive class for each vote pattern (votes independent given the class).

    ``patterns`` are (votes, count); starts from the majority vote; smoothed by one vote each.
    """
    p = {v: min(0.9, max(0.1, 0.5 + 0.2 * sum(v))) for v, _ in patterns}
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        prior = (1 + sum(n * p[v] for v, n in patterns)) / (2 + total)
        like = []
        for k in range(len(patterns[0][0])):
            table = {}
            for vote in (-1, 0, 1):
                pos = 1 + sum(n * p[v] for v, n in patterns if v[k] == vote)
                neg = 1 + sum(n * (1 - p[v]) for v, n in patterns if v[k] == vote)
                table[vote] = (pos / (3 + sum(n * p[v] for v, n in patterns)), neg / (3 + sum(n * (1 - p[v]) for v, n in patterns)))
            like.append(table)
        new = {}
        for v, _ in patterns:
            odds = math.log(prior) - math.log(1 - prior) + sum(math.log(like[k][x][0]) - math.log(like[k][x][1]) for k, x in enumerate(v))
            new[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        done = max(abs(new[v] - p[v]) for v in p) < 1e-6
        p = new
        if done:
            break
    return p


def features() -> dict[str, Column]:
    """Indicator features of the final classifier."""
    kind, match, left = F.col("kind"), F.col("match"), F.lower("left")
    share = F.length(_digits(match)) / F.length(match)
    flag = lambda c: c.cast("int")
    out = {f"kind_{k}": flag(kind == k) for k in KINDS}
    out |= {"long": flag(F.length(match) >= 32), "mid": flag(F.length(match).between(20, 31)), "digits_high": flag(share >= 0.75), "digits_low": flag(share < 0.25),
            "hex": flag(match.rlike("^[0-9a-f]+$")), "after_sign": flag(left.rlike(r"[=:]\s*[\"']?$")), "after_word": flag(left.rlike(r"[\p{L}0-9_]$")),
            "announced": flag(left.rlike(rf"(?<![a-z]){ANNOUNCE}[^a-z]*$")), "denied": flag(left.rlike(rf"(?<![a-z]){DENY}[^a-z]*$"))}
    return out


def classifier(spark: SparkSession, spans: DataFrame) -> Column:
    """Probability column of the trained span classifier (over the columns of ``spans``)."""
    ballots, feats = votes(), features()
    counted = spans.select("kind", *[v.alias(f"v_{k}") for k, v in ballots.items()], *[f.alias(f"f_{k}") for k, f in feats.items()])
    counted = counted.groupBy(*counted.columns).agg(F.count("*").alias("n")).collect()  # bounded by the patterns, not by the data
    vote_cols, feat_cols = [f"v_{k}" for k in ballots], [f"f_{k}" for k in feats]
    belief = {}
    for kind in KINDS:  # reliabilities may differ between kinds
        tally: dict[tuple[int, ...], int] = {}
        for r in counted:
            if r.kind == kind:
                key = tuple(r[c] for c in vote_cols)
                tally[key] = tally.get(key, 0) + r.n
        if tally:
            belief |= {(kind, v): p for v, p in em(sorted(tally.items())).items()}
    rows = []
    for r in counted:
        p = belief[r.kind, tuple(r[c] for c in vote_cols)]
        x = Vectors.dense([float(r[c]) for c in feat_cols])
        rows += [(x, 1.0, float(r.n * p)), (x, 0.0, float(r.n * (1 - p)))]
    rows = [r for r in rows if r[2] > 0]
    if len({r[1] for r in rows}) < 2:
        return F.lit(0.0)
    train = spark.createDataFrame(sorted(rows, key=lambda r: (list(r[0]), r[1])), ["features", "label", "weight"]).coalesce(1)
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=30).fit(train)
    score = F.lit(float(model.intercept))
    for c, w in zip(feats.values(), model.coefficients):
        score = score + c * F.lit(float(w))
    return 1 / (1 + F.exp(-score))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    spark = docs.sparkSession
    rows, spans = candidates(docs)
    is_base = F.col("kind_no") < len(BASE)
    kept = spans.withColumn("p", classifier(spark, spans)).where(is_base | (F.col("p") >= 0.5))
    span = F.struct("start", "kind_no", "end")
    per = kept.groupBy("rid").agg(
        *[F.sum((F.col("kind_no") == i).cast("long")).alias(f"n_{k}") for i, k in enumerate(BASE)], F.sum((~is_base).cast("long")).alias("n_added"),
        F.sort_array(F.collect_list(F.when(is_base, span))).alias("base"), F.sort_array(F.collect_list(span)).alias("all"))
    none = F.lit(0).cast("long")
    return rows.join(per, "rid", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", none).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce(_joined(F.col("base")), F.lit("")), 256).alias("base_sha256"), F.coalesce(_joined(F.col("all")), F.lit("")).alias("spans"), F.coalesce("n_added", none).alias("n_added"))
