"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame operations only).

1. Targets. Source weights share the corpus' words; a target stops at ``max_epochs`` times its
   source's words and the excess goes to the others by weight, until none is above.
2. Quotas. The mix is ``shards x blocks_per_shard`` equal-token blocks. Sainte-Laguë gives them to
   sources by highest quotients target / (2k + 1); shard s takes the s-th run of that ranking, so
   every shard has integer quotas that add up to the same number of blocks.
3. Selection. Each source's documents lie in a seeded order, cut into blocks of the same token
   length. A target holds some whole epochs of its source; of the rest, blocks are taken in a
   second seeded order until the target's words are reached, the last block in part.
4. Shards. A source's chosen words, epoch after epoch in the order in which blocks were drawn, are
   dealt to the shards by their quotas of it: shard s gets the share quota / blocks, next after
   those before it. So a shard's words of a source are its quota times the block length,
   up to the half block by which all quotas of a source differ from its target. A source
   too small for any block goes to one shard, its number modulo the shards.

Everything a task ranks is bounded: documents in hash buckets (``with_rank``), the quotient table
by ``shards x blocks_per_shard`` plus two rows per source, whatever the rows.

Defined cases: null or blank text has size 0 and is never taken; a null source is a source of its
own, last in the order; repeated rows are rows of their own; an empty table gives an empty
result; a corpus of no words has targets of 0. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import materialise, scratch, with_rank
from riskframe.operators.joins import null_safe_join

WORD = r"[^\x20\x09-\x0D]+"
SHARDS = 16
BLOCKS_PER_SHARD = 1024
MAX_EPOCHS = 3
SEED = 20240229
_UNIT = 1 << 24
_TIERS = 32


def source_targets(sizes: DataFrame, weight_cycle: int = 3, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, weight, source_size, target) from rows (source, size): one row per source.

    Sorting sources by cap / weight, the sources that stop at their cap are a prefix: source i
    stops iff (words left after the caps before it) * weight_i / (weight from i on) > cap_i.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    one = Window.partitionBy(F.lit(0))
    per = per.withColumn("pos", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())))
    per = per.withColumn("weight", (F.col("pos") - 1) % weight_cycle + 1)
    per = per.withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = one.orderBy("ratio", "pos")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(one))
    per = per.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    per = per.withColumn("w_left", F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    per = per.withColumn("share", F.col("left") / F.col("w_left"))
    per = per.withColumn("stops", F.col("share") > F.col("ratio"))
    # The level of the first source that doesn't stop holds for all after it.
    per = per.withColumn("level", F.min(F.when(~F.col("stops"), F.struct("ratio", "pos", "share"))).over(one)["share"])
    return per.select("source", "weight", "pos", "source_size",
                      F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")).cast("double").alias("target"))


def shard_quotas(targets: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """(pos, shard, quota): Sainte-Laguë blocks of every source in every shard.

    With N blocks, m sources and T words in all, the N-th highest quotient is at least T / (2N + m): above
    that value the sources have N quotients or more. So a source's quotients down to it suffice, at most
    N + m in all; one more of each source covers rounding.
    """
    n = shards * blocks_per_shard
    one = Window.partitionBy(F.lit(0))
    shares = targets.withColumn("share", F.col("target") / F.sum("target").over(one)).where("target > 0")
    most = F.floor((F.col("share") * (F.lit(2 * n) + F.count(F.lit(1)).over(one)) + 1) / 2)
    seats = shares.withColumn("most", most.cast("int")).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("most"))))
    ranked = seats.withColumn("place", F.row_number().over(one.orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "pos")) - 1)
    return ranked.where(F.col("place") < n).groupBy("pos", (F.col("place") / blocks_per_shard).cast("int").alias("shard")).agg(F.count("*").alias("quota"))


def _shard_bounds(quotas: DataFrame, shards: int) -> DataFrame:
    """(pos, blocks, ends): all blocks of a source, and the blocks of shards 0 to s for every s."""
    sums = [F.sum(F.when(F.col("shard") <= s, F.col("quota")).otherwise(0)) for s in range(shards)]
    return quotas.groupBy("pos").agg(F.sum("quota").alias("blocks"), F.array(*sums).alias("ends"))


def _words_by_shard(upto: Column, part: Column, drawn: Column, shards: int) -> Column:
    """Words that each shard takes of a block's first ``upto`` words: of every epoch, those whose places in
    the source's chosen words lie between the shard's bounds. ``part`` limits the last, partial epoch."""

    def of_shard(s):
        lo, hi = F.get("bounds", s), F.get("bounds", s + 1)

        def of_epoch(e):
            at = e * F.col("source_size") + drawn
            n = F.when(e < F.col("epochs"), upto).otherwise(F.least(upto, part))
            return F.greatest(F.lit(0), F.least(at + n, hi) - F.greatest(at, lo)).cast("long")

        return F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("epochs")), F.lit(0).cast("long"), lambda acc, e: acc + of_epoch(e))

    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), of_shard)


def mix(docs: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, size, source_size, target, taken, quota of its source), by row id ``rid``.

    ``shard_words`` says how many of the taken words go to each shard.
    """
    sized = docs.select("rid", "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sized = materialise(sized, "mix-sizes")
    n_rows = sized.count()
    targets = materialise(source_targets(sized), "mix-targets")
    n_blocks = shards * blocks_per_shard
    quotas = _shard_bounds(shard_quotas(targets, shards, blocks_per_shard), shards)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    plan = targets.withColumn("block_len", F.greatest(F.lit(1), F.ceil(total / n_blocks)).cast("long")).join(quotas, "pos", "left").select(
        "source", "pos", "source_size", "block_len", "target", F.coalesce("blocks", F.lit(0)).alias("blocks"), "ends", F.floor(F.col("target") + 0.5).cast("long").alias("want"))
    # Where each shard's words end among the source's chosen words; without a block, one shard has them all.
    by_quota = F.transform("ends", lambda e: F.floor(F.col("want") * (e / F.col("blocks")) + 0.5).cast("long"))
    at_once = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.when(i >= F.col("pos") % shards, F.col("want")).otherwise(0).cast("long"))
    plan = plan.withColumn("bounds", F.concat(F.array(F.lit(0).cast("long")), F.when(F.col("blocks") > 0, by_quota).otherwise(at_once))).drop("ends")
    # Whole epochs, and the words beyond them.
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("want") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = materialise(plan.withColumn("rest", F.col("want") - F.col("epochs") * F.col("source_size")), "mix-plan")

    # Blocks of each source in seeded order, with the words chosen before each: about n_blocks rows in all.
    blocks = plan.where("source_size > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("source_size") - 1) / F.col("block_len")).cast("int"))))
    blocks = blocks.withColumn("len", F.least(F.col("block_len"), F.col("source_size") - F.col("block") * F.col("block_len")))
    drawn = Window.partitionBy("pos").orderBy(F.xxhash64(F.lit(seed), "source", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("drawn", F.coalesce(F.sum("len").over(drawn), F.lit(0)).cast("long"))
    blocks = blocks.withColumn("part", F.least(F.col("len"), F.greatest(F.lit(0), F.col("rest") - F.col("drawn"))))
    placed = Window.partitionBy("pos").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("own", _words_by_shard(F.col("len"), F.col("part"), F.col("drawn"), shards))
    earlier = F.array(*[F.coalesce(F.sum(F.get("own", F.lit(i))).over(placed), F.lit(0)) for i in range(shards)])
    blocks = blocks.select("pos", "block", "part", "drawn", F.coalesce(F.sum("part").over(placed), F.lit(0)).alias("before"), earlier.alias("earlier"))
    blocks = materialise(blocks, "mix-blocks")

    # Documents along their source in seeded order; words chosen up to a place x are
    # before(block of x) + min(part, x - start of block).
    laid = with_rank(sized, ["source"], [F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "size", "rid"], F.xxhash64(F.lit(seed + 1), "doc_id"), n_rows, "begin", weight="size")
    laid = null_safe_join(laid, plan, ["source"])
    laid = laid.withColumn("end", F.col("begin") + F.col("size"))
    for side, at in (("b", "begin"), ("e", "end")):
        block = F.least(F.floor(F.col(at) / F.col("block_len")), F.floor((F.greatest(F.col("source_size"), F.lit(1)) - 1) / F.col("block_len"))).cast("int")
        laid = laid.withColumn(f"{side}_block", block)
        found = blocks.select(F.col("pos").alias("_p"), F.col("block").alias("_k"), F.col("part").alias(f"{side}_part"), F.col("before").alias(f"{side}_before"),
                              F.col("drawn").alias(f"{side}_drawn"), F.col("earlier").alias(f"{side}_earlier"))
        laid = laid.join(found, (F.col("pos") == F.col("_p")) & (F.col(f"{side}_block") == F.col("_k")), "left").drop("_p", "_k")
        inside = F.col(at) - F.col(f"{side}_block") * F.col("block_len")
        laid = laid.withColumn(f"{side}_c", F.col(f"{side}_before") + F.least(F.col(f"{side}_part"), inside))
        own = _words_by_shard(inside, F.col(f"{side}_part"), F.col(f"{side}_drawn"), shards)
        laid = laid.withColumn(f"{side}_words", F.zip_with(f"{side}_earlier", own, lambda x, y: x + y))
    taken = F.col("epochs") * F.col("size") + F.coalesce(F.col("e_c") - F.col("b_c"), F.lit(0))
    by_shard = F.coalesce(F.zip_with("e_words", "b_words", lambda x, y: x - y), F.array_repeat(F.lit(0).cast("long"), shards))
    return laid.select("rid", "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", F.col("blocks").alias("source_blocks"), by_shard.alias("shard_words"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix holds them: each row taken / size times, in whole rows; columns unchanged.

    The shares taken / size are rounded as running sums along each source, larger rows first (by powers
    of two, hash bucket, size and seed), so a row comes the whole number below or above its share
    times. What one row is rounded by is made up by the next of about its size, and a source's words
    stay within half its largest row of the target where one bucket holds a power of two's rows.
    Rows of size 0 are never taken.
    """
    columns = docs.columns
    seed = options.get("seed", SEED)
    stored = materialise(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-docs")
    with scratch(docs.sparkSession):
        plan = mix(stored.select(F.col("_mix_row").alias("rid"), "doc_id", "source", "text"), **options)
        # Shares in fixed point, so that running sums don't depend on their order.
        shares = plan.where("size > 0").select("rid", "doc_id", "source", "size", F.round(F.lit(float(_UNIT)) * F.col("taken") / F.col("size")).cast("long").alias("share"))
        shares = materialise(shares, "mix-shares")
        tier = F.greatest(F.lit(0), F.lit(_TIERS - 1) - F.floor(F.log2("size")).cast("int"))
        laid = with_rank(shares, ["source"], [F.col("size").desc(), F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "rid"], F.xxhash64(F.lit(seed + 2), "doc_id"),
                         shares.count(), "before", weight="share", tier=tier, n_tiers=_TIERS)
        whole = lambda x: F.shiftright(x + _UNIT // 2, _UNIT.bit_length() - 1)
        copies = laid.select(F.col("rid").alias("_mix_row"), (whole(F.col("before") + F.col("share")) - whole(F.col("before"))).cast("int").alias("_mix_copies"))
        copies = materialise(copies.where("_mix_copies > 0"), "mix-copies", keep=True)
    out = stored.join(copies, "_mix_row").withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
    return out.select(*[F.col(f"`{c}`") for c in columns])
