"""Balanced label propagation: shards that keep linked documents together (DataFrame operations only).

Documents with equal texts are linked; shard sizes follow the law ``rows``: counts at most one
apart. Every document starts in the shard its row hash names. A group of linked documents is a
unit (one larger than a shard is dealt into as few units as fit), and its members' shards are its
votes. In each round every unsettled unit asks for the shard with most of its members among those
with room; requests are granted in order of size up to the shard's quota, and the members move
there. What is left after the rounds, single documents and units that found no room, fills the
remaining quotas in an order that keeps a unit's members together, so counts come out exact.

Votes are (unit, shard) counts, combined before the shuffle; quotas are one number per shard;
ranks are taken in hash buckets. No group, link list or shard is ever gathered in one task.

Defined cases: a null text counts as empty (size 1) and equals the empty text; repeated rows and
tied or null doc ids are rows of their own; fewer rows than shards fill the first shards; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialise, with_rank

SHARDS = 16
ROUNDS = 5
SEED = 17
_TIERS = 48


def _facts(docs: DataFrame, shards: int) -> DataFrame:
    """What sharding needs of each row; the only pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text.alias("t")).select(
        "rid", "doc_id", (F.octet_length("t") + 1).cast("long").alias("size"), F.crc32(F.col("t").cast("binary")).alias("text_crc32"),
        F.xxhash64("t", F.length("t")).alias("ka"), F.xxhash64(F.lit(SEED), "t").alias("kb"),
        F.pmod(F.xxhash64("rid", F.lit(SEED)), F.lit(shards)).cast("int").alias("shard"))


def _room(settled: DataFrame | None, quotas: list[int]) -> list[int]:
    """Free places of every shard (one row per shard reaches the driver)."""
    used = {} if settled is None else {r.label: r.n for r in settled.groupBy("label").agg(F.sum("rows").alias("n")).collect()}
    return [q - used.get(s, 0) for s, q in enumerate(quotas)]


def label_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = materialise(_facts(docs, shards), "shard-rows")
    n = rows.count()
    quotas = [n // shards + (s < n % shards) for s in range(shards)]
    largest = max(1, n // shards)

    groups = rows.groupBy("ka", "kb").agg(F.count("*").alias("members")).where("members > 1")
    groups = materialise(groups.withColumn("n_units", F.ceil(F.col("members") / largest).cast("int")), "shard-groups")
    unit = F.when(F.col("n_units").isNotNull(), F.xxhash64("ka", "kb", F.pmod(F.xxhash64("rid"), F.col("n_units"))))
    rows = materialise(rows.join(groups, ["ka", "kb"], "left").withColumn("unit", unit).drop("members", "n_units", "ka", "kb"), "shard-linked")

    votes = rows.where("unit is not null").groupBy("unit", "shard").agg(F.count("*").alias("v"))
    units = materialise(votes.groupBy("unit").agg(F.sum("v").cast("long").alias("rows"), F.collect_list(F.struct(F.col("v"), F.col("shard"))).alias("votes")), "shard-units")
    n_units = units.count()
    settled, waiting = None, units
    for r in range(rounds if n_units else 0):
        room = _room(settled, quotas)
        free = F.array(*[F.lit(x).cast("long") for x in room])
        # Every shard with room is a choice; most of the own members first, then by a hash.
        votes_for = F.map_from_entries(F.transform("votes", lambda v: F.struct(v["shard"], v["v"])))
        choices = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(
            F.coalesce(F.element_at(votes_for, s), F.lit(0)).alias("v"), F.xxhash64("unit", s, F.lit(r)).alias("h"), s.alias("s"), F.get(free, s).alias("room")))
        asked = waiting.withColumn("want", F.array_max(F.filter(choices, lambda c: c["room"] >= F.col("rows"))))
        asked = asked.where("want is not null").withColumn("label", F.col("want.s"))
        tier = F.lit(_TIERS - 1) - F.least(F.lit(_TIERS - 1), F.floor(F.log2(F.col("rows").cast("double")))).cast("int")
        ranked = with_rank(asked, ["label"], [F.col("rows").desc(), F.col("unit")], F.xxhash64("unit"), max(1, n_units // shards), "before", weight="rows", tier=tier, n_tiers=_TIERS)
        granted = ranked.where(F.col("before") + F.col("rows") <= F.get(free, F.col("label"))).select("unit", "rows", "label")
        granted = materialise(granted, "shard-granted")
        settled = granted if settled is None else settled.unionByName(granted)
        waiting = materialise(waiting.join(granted.select("unit"), "unit", "left_anti"), "shard-waiting")
        if not waiting.limit(1).count():
            break

    room = _room(settled, quotas)
    placed = rows.withColumn("label", F.lit(None).cast("int")) if settled is None else rows.join(settled.select("unit", "label"), "unit", "left")
    placed = materialise(placed, "shard-placed")
    # The rest fills the quotas: place p goes to the first shard whose running room exceeds p.
    rest = with_rank(placed.where("label is null"), [], [F.coalesce(F.col("unit"), F.xxhash64("rid")), F.col("rid")], F.xxhash64(F.coalesce(F.col("unit"), F.col("rid"))), n, "place")
    ends, at = [], 0
    for x in room:
        at += x
        ends.append(at)
    filled = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("place")))
    done = placed.where("label is not null").select("rid", "doc_id", "size", "text_crc32", F.col("label").alias("shard")).unionByName(
        rest.select("rid", "doc_id", "size", "text_crc32", filled.cast("int").alias("shard")))
    done = materialise(done, "shard-done")
    out = with_rank(done, ["shard"], [F.col("rid")], F.xxhash64("rid", F.lit(3)), max(1, n // shards), "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
