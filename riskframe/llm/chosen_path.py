"""N-gram Jaccard join by chosen paths: five-word shingle sets, similarity 0.8 or more.

1. Every text becomes its set of shingle hashes and a sketch of ``COORDS`` min-hash tokens. Texts
   of one set form a copy class, kept once with its multiplicity.
2. Chosen paths: each of ``runs`` repetitions starts ``BRANCH`` paths from sampled sketch
   coordinates; sets sharing the token there share a bucket. A bucket of more than
   ``bucket_limit`` sets is split again on tokens sampled by the hash of its path, up to
   ``MAX_DEPTH`` times. A pair of similarity s stays together on a path of depth d with
   probability s * (1 - (1 - s)^BRANCH)^(d - 1); ``runs`` is the smallest number of repetitions
   that reaches ``target_recall`` at the threshold (see ``runs_for``).
3. Brute force: a bucket is compared inside tasks. One still above the limit is laid out as a
   grid of block pairs, so a group of any size is spread over tasks whole. Sketches drop sets
   without a likely partner; the remaining sets meet with their full shingles, and Jaccard is
   exact in integers. A pair that meets in several buckets counts only in the first one (both
   sets carry the list of their buckets). Tasks give link counts and spanning edges, one row per
   set and cell, never pairs.
4. Classes are the connected components of the links; counts include exact copies.

Defined cases: words are runs of letters, marks, digits and underscores, lower-cased. A text of
one to four words is one shingle of all its words; a text without words (null, empty,
punctuation) links with nothing and is its own class. Repeated rows and tied or null doc ids are
rows of their own; a class id is the smallest doc_id of the class (null only if all are null).
An empty table gives an empty result. Other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import connected_components, materialise, scratch, small_batches, with_row_ids
from riskframe.llm.groups import sorted_groups
from riskframe.llm.words import mix, shingle_sets, text_chunks

COORDS = 64
BRANCH = 2
MAX_DEPTH = 3
BUCKET_LIMIT = 2048
BLOCK = 512
THRESHOLD = (4, 5)  # similarity 0.8 as a fraction
LIKELY = 35  # of COORDS equal tokens: below it a pair of similarity 0.8 falls once in about 1e6
TARGET_RECALL = 0.9999
_SLOTS = 2 ** MAX_DEPTH - 1  # path places of one root


def runs_for(target_recall: float, similarity: float = 0.8, depth: int = MAX_DEPTH) -> int:
    """Repetitions after which a pair of ``similarity`` has met in a bucket with the target probability."""
    meet = similarity * (1 - (1 - similarity) ** BRANCH) ** (depth - 1)
    return max(1, math.ceil(math.log(1 - target_recall) / math.log(1 - meet) / BRANCH))


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hash tokens, one row of ``COORDS`` per non-empty set."""
    seeds = mix(np.arange(1, 2 * COORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1].astype(np.int64)
    out = np.empty((len(sets), COORDS), np.uint32)
    for c in range(COORDS):
        if len(sets):
            out[:, c] = np.minimum.reduceat((flat * seeds[2 * c] + seeds[2 * c + 1]) >> np.uint64(32), starts)
    return out.view(np.int32)


def _sketch_rows(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                sets = shingle_sets(chunk.column("text"), width)
                full = np.flatnonzero([len(s) > 0 for s in sets])
                kept = [sets[i] for i in full]
                n = np.array([len(s) for s in kept], np.int64)
                flat = np.concatenate(kept) if kept else np.empty(0, np.uint64)
                starts = np.concatenate([[0], np.cumsum(n)])[:-1].astype(np.int64)
                name = [np.add.reduceat(mix(flat ^ np.uint64(salt)), starts).view(np.int64) if kept else np.empty(0, np.int64) for salt in (0x1234567, 0xFEDCBA987)]
                rows = sketch(kept)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("rid").take(pa.array(full)), chunk.column("doc_id").take(pa.array(full)), pa.array(name[0]), pa.array(name[1]), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1) * COORDS, pa.int32()), pa.array(rows.ravel()))],
                    names=["rid", "doc_id", "set_a", "set_b", "n", "sketch"])

    return docs.select("rid", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "rid long, doc_id long, set_a long, set_b long, n long, sketch array<int>")


def _paths(reps: DataFrame, runs: int, bucket_limit: int) -> DataFrame:
    """Buckets of every set: rows (slot, key, rep, cnt), only of buckets with two sets or more."""
    order = np.random.default_rng(7).permutation(COORDS)
    roots = [int(order[i % COORDS]) for i in range(BRANCH * runs)]
    nodes = reps.select("rep", F.explode(F.array(*[
        F.struct(F.lit(i * _SLOTS).alias("slot"), F.xxhash64(F.lit(i), F.lit(c), F.col("sketch")[c]).alias("key"))
        for i, c in enumerate(roots)])).alias("node")).select("node.slot", "node.key", "rep")
    leaves = None
    for depth in range(MAX_DEPTH):
        counts = materialise(nodes.groupBy("key").agg(F.count("*").alias("cnt")).where("cnt > 1"), "path-counts")
        shared = materialise(nodes.join(counts, "key"), "path-nodes")
        last = depth == MAX_DEPTH - 1
        done = shared if last else shared.where(F.col("cnt") <= bucket_limit)
        done = done.select("slot", "key", "rep", "cnt")
        leaves = done if leaves is None else leaves.unionByName(done)
        if last:
            break
        wide = shared.where(F.col("cnt") > bucket_limit).join(reps.select("rep", "sketch"), "rep")
        first = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(COORDS))
        second = F.pmod(first + 1 + F.pmod(F.xxhash64("key", F.lit(2)), F.lit(COORDS - 1)), F.lit(COORDS))
        heap = F.col("slot") % _SLOTS
        children = F.array(*[F.struct((F.col("slot") + heap + 1 + b).alias("slot"), F.xxhash64(
            "key", c, F.element_at("sketch", (c + 1).cast("int"))).alias("key")) for b, c in enumerate((first, second))])
        nodes = wide.select("rep", F.explode(children).alias("node")).select("node.slot", "node.key", "rep")
    return materialise(leaves, "path-leaves")


def _bucket_matrix(table: pa.Table, n_slots: int) -> np.ndarray:
    lists = table.column("slots").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    keys = table.column("keys").combine_chunks()
    keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
    out = np.zeros((table.num_rows, n_slots), np.int64)
    row = np.repeat(np.arange(table.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    out[row, pc.list_flatten(lists).to_numpy()] = pc.list_flatten(keys).to_numpy()
    return out


def _list_rows(table: pa.Table, name: str) -> np.ndarray:
    col = table.column(name).combine_chunks()
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    return pc.list_flatten(col).to_numpy()


def _cell_pairs(block: np.ndarray, a: int, b: int, likely) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell that pass ``likely``, in stripes so memory stays bounded."""
    left, right = (np.arange(len(block)), None) if a == b else (np.flatnonzero(block == a), np.flatnonzero(block == b))
    found = []
    for at in range(0, len(left), 64):
        i = left[at: at + 64]
        j = left if right is None else right
        ok = likely(i, j)
        if right is None:
            ok &= j[None, :] > i[:, None]
        r, c = np.nonzero(ok)
        found.append((i[r], j[c]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _owned(buckets: np.ndarray, i: np.ndarray, j: np.ndarray, slot: int) -> np.ndarray:
    """Pairs whose first common bucket is the one in ``slot``."""
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), 20_000):
        p, q = buckets[i[at: at + 20_000]], buckets[j[at: at + 20_000]]
        out[at: at + 20_000] = np.argmax((p == q) & (p != 0), axis=1) == slot
    return out


_CELL = ["slot", "key", "a", "b"]


def _likely_members(cells: DataFrame, n_slots: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_groups(batches, _CELL):
            tokens = _list_rows(table, "sketch").reshape(-1, COORDS)
            size = table.column("n").to_numpy()
            block = table.column("block").to_numpy()
            buckets = _bucket_matrix(table, n_slots)
            cell = {k: table.column(k).to_numpy() for k in _CELL}
            keep = np.zeros(table.num_rows, bool)
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                t, m = tokens[s:e], size[s:e]

                def likely(i, j):
                    same = (t[i][:, None, :] == t[j][None, :, :]).sum(axis=2)
                    ni, nj = m[i][:, None], m[j][None, :]
                    return (same >= LIKELY) & (THRESHOLD[1] * np.minimum(ni, nj) >= THRESHOLD[0] * np.maximum(ni, nj))

                i, j = _cell_pairs(block[s:e], int(cell["a"][s]), int(cell["b"][s]), likely)
                if len(i):
                    own = _owned(buckets[s:e], i, j, int(cell["slot"][s]))
                    keep[s + i[own]] = True
                    keep[s + j[own]] = True
            if keep.any():
                yield from table.select([*_CELL, "rep", "block"]).filter(pa.array(keep)).to_batches()

    return cells.mapInArrow(run, "slot int, key long, a int, b int, rep long, block int")


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common shingles of each pair (i, j)."""
    if len(i) <= 64:
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    flat, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[inverse] > 1
    column = (np.cumsum(times > 1) - 1)[inverse[shared]]
    owner = owner[shared]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column.max()) + 1 if len(column) else 0, 4096):
        part = (column >= at) & (column < at + 4096)
        ones = np.zeros((len(sets), 4096), np.float32)
        ones[owner[part], column[part] - at] = 1
        common += ones @ ones.T
    return common[i, j].astype(np.int64)


def _exact_links(members: DataFrame, n_slots: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_groups(batches, _CELL):
            buckets = _bucket_matrix(table, n_slots)
            raw = table.column("shingles").to_pylist()
            rep, times, block = (table.column(c).to_numpy() for c in ("rep", "mult", "block"))
            cell = {k: table.column(k).to_numpy() for k in _CELL}
            linked, texts, head = np.zeros(len(rep), np.int64), np.zeros(len(rep), np.int64), rep.copy()
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                sets = [np.frombuffer(x, "<u8") for x in raw[s:e]]
                m = np.array([len(x) for x in sets])
                i, j = _cell_pairs(block[s:e], int(cell["a"][s]), int(cell["b"][s]), lambda i, j: THRESHOLD[1] * np.minimum(m[i][:, None], m[j][None, :]) >= THRESHOLD[0] * np.maximum(m[i][:, None], m[j][None, :]))
                own = _owned(buckets[s:e], i, j, int(cell["slot"][s]))
                i, j = i[own], j[own]
                if not len(i):
                    continue
                both = _overlaps(sets, i, j)
                near = THRESHOLD[1] * both >= THRESHOLD[0] * (m[i] + m[j] - both)
                i, j = i[near], j[near]
                np.add.at(linked, s + i, times[s + j])
                np.add.at(linked, s + j, times[s + i])
                texts[s:e] += np.bincount(i, minlength=e - s) + np.bincount(j, minlength=e - s)
                label = rep[s:e].copy()
                while len(i):  # smallest set reachable inside the cell
                    low = np.minimum(label[i], label[j])
                    if (label[i] == low).all() and (label[j] == low).all():
                        break
                    np.minimum.at(label, i, low)
                    np.minimum.at(label, j, low)
                head[s:e] = label
            got = texts > 0
            if got.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[got]) for x in (rep, linked, texts, head)], names=["rep", "linked", "texts", "head"])

    return members.mapInArrow(run, "rep long, linked long, texts long, head long")


def _shingle_table(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                sets = shingle_sets(chunk.column("text"), width)
                yield pa.RecordBatch.from_arrays([chunk.column("rep"), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["rep", "shingles"])

    return docs.select("rep", "text").mapInArrow(run, "rep long, shingles binary")


def jaccard_join(docs: DataFrame, width: int = 5, target_recall: float = TARGET_RECALL, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``docs`` has (rid, doc_id, text) with ``rid`` unique (see ``with_row_ids``).

    One row per document: rid, doc_id, class_id, n_links (other documents at 0.8 or more, copies
    included), n_texts (linked documents' distinct shingle sets), n_copies, keeper (one row of each class).
    """
    small_batches(docs.sparkSession)
    runs = runs_for(target_recall)
    n_slots = BRANCH * runs * _SLOTS
    rows = materialise(_sketch_rows(docs, width), "path-sketches")
    reps = materialise(rows.groupBy("set_a", "set_b").agg(
        F.min("rid").alias("rep"), F.min("doc_id").alias("set_doc"), F.count("*").alias("mult"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "path-sets")

    leaves = _paths(reps, runs, bucket_limit)
    own = leaves.groupBy("rep").agg(F.collect_list("slot").alias("slots"), F.collect_list("key").alias("keys"))
    known = materialise(reps.select("rep", "n", "sketch", "mult").join(own, "rep"), "path-known")
    n_blocks = F.ceil(F.col("cnt") / BLOCK).cast("int")
    grid = leaves.withColumn("block", F.pmod(F.xxhash64("rep", "key"), n_blocks).cast("int"))
    grid = grid.join(known.select("rep", "n", "sketch", "slots", "keys"), "rep")
    grid = grid.withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1))).select(
        "slot", "key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "rep", "block", "n", "sketch", "slots", "keys")
    likely = materialise(_likely_members(grid.repartition(*_CELL).sortWithinPartitions(*_CELL), n_slots), "path-likely")

    wanted = likely.select("rep").distinct()
    texts = docs.select(F.col("rid").alias("rep"), "text").join(wanted, "rep", "left_semi")
    shingles = materialise(_shingle_table(texts, width), "path-shingles")
    members = likely.join(shingles, "rep").join(known.select("rep", "mult", "slots", "keys"), "rep")
    links = materialise(_exact_links(members.repartition(*_CELL).sortWithinPartitions(*_CELL), n_slots), "path-links")

    per_set = links.groupBy("rep").agg(F.sum("linked").alias("linked"), F.sum("texts").alias("texts"))
    parts = connected_components(links.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct(), "path")
    sets = reps.select("set_a", "set_b", "rep", "mult", "set_doc").join(per_set, "rep", "left").join(
        parts.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sets = materialise(sets, "path-classes")
    # The class: its smallest doc_id, and the one row that stands for it.
    names = sets.groupBy("component").agg(F.min(F.struct(F.col("set_doc").isNull().alias("x"), F.col("set_doc").alias("doc"), "rep")).alias("low"))
    named = materialise(sets.join(names, "component").select(
        "set_a", "set_b", "mult", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("texts", F.lit(0)).alias("texts"),
        F.col("low.doc").alias("class_doc"), (F.col("low.rep") == F.col("rep")).alias("lead"), F.col("component").alias("class_rid")), "path-named")
    # Row of each leading set that stays: its smallest (doc_id, rid), nulls last.
    per_row = rows.select("rid", F.col("doc_id").alias("row_doc"), "set_a", "set_b").join(named, ["set_a", "set_b"])
    per_row = materialise(per_row, "path-rows")
    stays = per_row.where("lead").groupBy("class_rid").agg(F.min(F.struct(F.col("row_doc").isNull().alias("x"), "row_doc", "rid")).alias("k")).select(F.col("k.rid").alias("rid"), F.lit(True).alias("keeper"))
    out = docs.select("rid", F.col("doc_id").cast("long").alias("doc_id")).join(per_row.drop("row_doc", "set_a", "set_b", "lead", "class_rid"), "rid", "left").join(stays, "rid", "left")
    wordless = F.col("mult").isNull()
    return out.select("rid", "doc_id", F.when(wordless, F.col("doc_id")).otherwise(F.col("class_doc")).alias("class_id"),
                      F.coalesce(F.col("linked") + F.col("mult") - 1, F.lit(0)).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_texts"),
                      F.coalesce("mult", F.lit(1)).alias("n_copies"), (F.coalesce("keeper", F.lit(False)) | wordless).alias("keeper"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``jaccard_join`` of a table (doc_id, text) without row ids of its own."""
    with scratch(docs.sparkSession):
        return materialise(jaccard_join(with_row_ids(docs.select("doc_id", "text"), "path-docs"), **options), "path-result", keep=True)


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of every class of near duplicates (smallest doc_id), columns unchanged."""
    columns = docs.columns
    stored = materialise(docs.withColumn("_path_row", F.monotonically_increasing_id()), "path-docs")
    with scratch(docs.sparkSession):
        found = jaccard_join(stored.select(F.col("_path_row").alias("rid"), "doc_id", "text"), **options)
        gone = materialise(found.where(~F.col("keeper")).select(F.col("rid").alias("_path_row")), "path-gone", keep=True)
    return stored.join(gone, "_path_row", "left_anti").select(*[F.col(f"`{c}`") for c in columns])
