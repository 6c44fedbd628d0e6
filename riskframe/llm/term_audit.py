"""Source divergence audit: how far the word use of each source lies from the other sources of its language.

Terms are counted inside tasks by length-bucketed packing. A batch's texts, ordered by
(lang, source), are one byte array; terms of up to 8 bytes become one uint64 word, terms of up to
16 bytes two, both radix-sorted (16-bit digits, least significant first) and counted as runs;
longer terms are laid out as fixed-width byte strings, one bucket for each power of two, and sorted
bytewise. Every run is one (lang, source, term) with its occurrences and documents; Spark adds
these up, partial sums first.

Pairs of sources need every kept term of both. Sources are cut into blocks of ``BLOCK`` and terms
into chunks by hash; one group of rows is two source blocks and one chunk, so its size has a bound,
and no term sends out its pairs. Terms that neither block has are added as one product.

Arithmetic is exact: 64-bit integers, and decimals where counts are multiplied.

Defined cases: null text, lang or source reads as ''; every row is a document of its own, also
with a repeated or null doc_id; a group without kept terms has counts of 0; a language without
kept terms gives pairs of value 0 and no terms; an empty table gives an empty result; other columns
of the input are ignored; texts and terms of any length count whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import materialise, scratch, small_batches
from riskframe.llm.words import text_chunks

MIN_DOCS = 10  # documents of its language that a kept term is in
TOP = 10
SCALE = 1_000_000_000
BLOCK = 64  # sources
CHUNK_TERMS = 4096

# A byte of a term: an ASCII letter, in lower case, or a byte of any other character; 0 separates.
_FOLD = np.zeros(256, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("A"): ord("Z") + 1] = _FOLD[ord("a"): ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


def _radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows of uint64 words, the first word counting most: 16-bit digits from the last to the first."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _octets(words: list[np.ndarray]) -> np.ndarray:
    """The words' bytes, big-endian, as fixed-width byte strings without their trailing zeros."""
    return np.stack(words, axis=1).astype(">u8").view(f"S{8 * len(words)}").ravel()


def _runs(key_starts: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first row, occurrences, documents) of each run of one term in one group; rows are sorted by term, group and document."""
    new = key_starts.copy()
    new[1:] |= group[1:] != group[:-1]
    first = np.flatnonzero(new)
    other_doc = new.copy()
    other_doc[1:] |= doc[1:] != doc[:-1]
    return first, np.diff(np.append(first, len(doc))), np.add.reduceat(other_doc.astype(np.int64), first)


def count_terms(texts: pa.Array, groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(term bytes, group, occurrences, documents) of all terms of the texts, one bucket of lengths after the other.

    ``groups`` are ascending numbers, one for each text.
    """
    flat = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    sizes = np.array([len(t) for t in flat], np.int64)
    raw = _FOLD[np.frombuffer(b"\n".join(flat) + b"\n" * 16, np.uint8)]  # each text ends with a separator; 8 bytes can be read anywhere
    del flat
    inside = (raw != 0).astype(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = end - start
    text_end = np.cumsum(sizes + 1)
    doc = np.searchsorted(text_end, start, side="right")
    group = groups[doc]
    eight = np.ndarray(max(0, len(raw) - 7), ">u8", raw.tobytes(), strides=(1,))

    def word(at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The ``n`` (0 to 8) bytes from ``at`` on as a big-endian word filled up with zeros."""
        keep = np.where(n > 0, np.uint64(0xFFFFFFFFFFFFFFFF) << (np.uint64(64) - np.uint64(8) * np.maximum(n, 1).astype(np.uint64)), np.uint64(0))
        return eight[np.minimum(at, len(eight) - 1)].astype(np.uint64) & keep

    for low, high in ((0, 8), (8, 16)):
        of = np.flatnonzero((length > low) & (length <= high))
        if not len(of):
            continue
        words = [word(start[of] + k, np.clip(length[of] - k, 0, 8)) for k in range(0, high, 8)]
        order = _radix_order(words)
        words, of = [w[order] for w in words], of[order]
        new = np.ones(len(of), bool)
        new[1:] = np.logical_or.reduce([w[1:] != w[:-1] for w in words])
        first, n, docs = _runs(new, group[of], doc[of])
        yield _octets([w[first] for w in words]), group[of[first]], n, docs

    width = 32
    while (length > width // 2).any():
        of = np.flatnonzero((length > width // 2) & (length <= width))
        if len(of):
            filled = np.zeros((len(of), width), np.uint8)
            row = np.repeat(np.arange(len(of)), length[of])
            column = np.arange(len(row)) - np.repeat(np.cumsum(length[of]) - length[of], length[of])
            filled[row, column] = raw[np.repeat(start[of], length[of]) + column]
            keys = filled.view(f"S{width}").ravel()
            order = np.argsort(keys, kind="stable")
            keys, of = keys[order], of[order]
            new = np.ones(len(of), bool)
            new[1:] = keys[1:] != keys[:-1]
            first, n, docs = _runs(new, group[of], doc[of])
            yield keys[first], group[of[first]], n, docs
        width *= 2


def term_counts(docs: DataFrame) -> DataFrame:
    """Columns lang, source, term, n (occurrences), docs (documents of the group with the term)."""
    small_batches(docs.sparkSession, 2000)
    schema = "lang string, source string, term string, n long, docs long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                keys = pa.table([chunk.column("lang"), chunk.column("source"), pa.array(np.arange(chunk.num_rows))], names=["lang", "source", "row"])
                order = keys.sort_by([("lang", "ascending"), ("source", "ascending")])
                lang, source = order.column("lang").combine_chunks(), order.column("source").combine_chunks()
                new = np.ones(chunk.num_rows, bool)
                for names in (lang, source):
                    new[1:] |= pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
                    if names is lang:
                        by_lang = new.copy()
                new[1:] |= by_lang[1:]
                head = pa.array(np.flatnonzero(new))
                lang, source = lang.take(head), source.take(head)
                for terms, group, n, in_docs in count_terms(chunk.column("text").take(order.column("row").combine_chunks()), np.cumsum(new) - 1):
                    at = pa.array(group)
                    yield pa.RecordBatch.from_arrays([lang.take(at), source.take(at), pa.array(terms.tolist(), pa.binary()).cast(pa.string()), pa.array(n), pa.array(in_docs)],
                                                     names=["lang", "source", "term", "n", "docs"])

    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return read.mapInArrow(count, schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, n_terms: str):
    """1 + floor(SCALE * (count + 2) / (total + 2 * n_terms)), exact; null without kept terms."""
    return F.expr(f"if({n_terms} > 0, 1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0))) div cast({total} + 2 * {n_terms} as decimal(20,0)), null)")


def _gap(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _block_sums(rows: pa.Table) -> pa.Table:
    """One group: two blocks of sources and one chunk of terms. Sums of gaps, and terms seen, of every pair across the blocks.

    Rows without a term hold the share of a term that a source doesn't have.
    """
    number, share = (rows.column(c).to_numpy() for c in ("number", "p"))
    absent = rows.column("term").is_null().to_numpy()
    sources, slot = np.unique(number[absent], return_inverse=True)
    base = np.empty(len(sources), np.int64)
    base[slot] = share[absent]
    coded = rows.column("term").filter(pa.array(~absent)).combine_chunks().dictionary_encode()
    at, n_terms = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
    lang, left, right = (rows.column(c)[0].as_py() for c in ("lang", "left_block", "right_block"))
    total = np.zeros((len(sources), len(sources)), np.int64)
    column = np.searchsorted(sources, number[~absent])
    for first in range(0, n_terms, 256):  # so many terms are spread out at once
        part = (at >= first) & (at < first + 256)
        p = np.tile(base, (min(256, n_terms - first), 1))
        p[at[part] - first, column[part]] = share[~absent][part]
        for i in np.flatnonzero(sources // BLOCK == left):
            gap = p[:, i: i + 1] - p
            total[i] += (gap * gap // (p[:, i: i + 1] + p)).sum(axis=0)
    a, b = np.nonzero((sources // BLOCK == left)[:, None] & (sources // BLOCK == right)[None, :] & (sources[:, None] < sources[None, :]))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(sources[a], pa.int64()), "b": pa.array(sources[b], pa.int64()),
                     "value": pa.array(total[a, b]), "seen": pa.array(np.full(len(a), n_terms, np.int64))})


def _pairs(groups: DataFrame, cells: DataFrame, n_chunks: int) -> DataFrame:
    """Columns lang, source, item, value of every ordered pair of sources of a language.

    ``groups``: lang, source, number, n_sources, n_terms, p0; ``cells``: lang, number, n_sources, term, p.
    """
    block = F.expr(f"number div {BLOCK}")
    others = F.expr(f"sequence(0L, (n_sources - 1) div {BLOCK})")

    def meet(rows: DataFrame) -> DataFrame:
        """A row for every pair of blocks that the source's block is part of."""
        met = rows.withColumn("other", F.explode(others)).withColumn("own", block)
        return met.select("lang", F.least("own", "other").alias("left_block"), F.greatest("own", "other").alias("right_block"), "chunk", "number", "term", "p")

    of_terms = meet(cells.withColumn("chunk", F.pmod(F.xxhash64("term"), F.lit(n_chunks))))
    filler = groups.where("n_terms > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long"))))
    of_absent = meet(filler.select("lang", "number", "n_sources", "chunk", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p")))
    sums = of_terms.unionByName(of_absent).groupBy("lang", "left_block", "right_block", "chunk").applyInArrow(
        _block_sums, "lang string, a long, b long, value long, seen long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))

    left = groups.select("lang", "source", F.col("number").alias("own"), "n_terms", F.col("p0").alias("p"), F.explode(others).alias("to_block"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"), F.col("p0").alias("q"), block.alias("to_block"))
    both = left.join(right, ["lang", "to_block"]).where("own <> other").withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")})
    unseen = (F.col("n_terms") - F.coalesce("seen", F.lit(0))) * F.coalesce(_gap("p", "q"), F.lit(0))
    return both.join(sums, ["lang", "a", "b"], "left").select("lang", "source", "item", (F.coalesce("value", F.lit(0)) + unseen).cast("long").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Columns lang, source, part (pair, term), item, value, rank: see the module's head."""
    spark = docs.sparkSession
    with scratch(spark):
        counts = materialise(term_counts(docs), "audit-counts")
        kept = materialise(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).where(f"d >= {min_docs}").drop("d"), "audit-kept")
        cells = materialise(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "audit-cells")

        # One row for each (lang, source) and each lang. Numbers of the sources: a window over one language's sources.
        names = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
        of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("lang_n").alias("lang_total"))
        of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = names.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["total", "n_terms", "lang_total"])
        by_lang = Window.partitionBy("lang")
        groups = groups.withColumns({"number": (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long"), "n_sources": F.count(F.lit(1)).over(by_lang)})
        groups = materialise(groups.withColumn("p0", _share("0L", "total", "n_terms")), "audit-groups")

        shares = cells.join(groups, ["lang", "source"]).select(
            "lang", "source", "number", "n_sources", "term", _share("n", "total", "n_terms").alias("p"), _share("lang_n", "lang_total", "n_terms").alias("q"))
        shares = materialise(shares, "audit-shares")
        n_terms = groups.groupBy("lang").agg(F.max("n_terms").alias("n")).agg(F.max("n")).first()[0] or 0
        pairs = _pairs(groups, shares.select("lang", "number", "n_sources", "term", "p"), max(1, -(-n_terms // CHUNK_TERMS)))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
        pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
        terms = terms.withColumn("rank", F.row_number().over(order)).where(f"rank <= {top}")
        return materialise(pairs.unionByName(terms), "audit-result", keep=True)
