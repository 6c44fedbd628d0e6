"""Embedding near-duplicates by inverted lists and product quantisation.

0. Equal vectors collapse to one representative that carries their number, so a group of copies of
   any size is compared once; copies are links of each other.
1. Vectors become unit vectors in double precision. ``n_lists`` coarse centroids and, for each of
   ``N_SUB`` sub-spaces, ``N_CODES`` residual codewords are fitted by k-means on a bounded sample of
   different vectors (``train_rows``, documented); every vector is then indexed.
2. A vector lives in the list of its nearest centroid as residual codes, plus the exact length of
   what the codes leave over. As a query it probes the lists that a vector within the link radius
   can live in: list c is left out if the bisector between c and the own centroid is further away
   than ``MARGIN`` standard deviations of a displacement of that length in a random direction
   (never more than the radius itself: then no link at all can be lost, as for 16 dimensions or
   fewer). Measured on the test tables every link is found (see README).
3. In a list, asymmetric distances come from per-query lookup tables; by the triangle inequality a
   code whose table distance exceeds radius + left-over length can't be within the radius. The
   others are reranked by exact cosine in double precision.
4. Lists are laid out in blocks of members and of queries, one task group per pair of blocks, so
   a list of any size is spread. Tasks return link counts and one spanning edge per vector, never
   pairs. A link found from one end only (the other end doesn't probe that list) counts for both. Components are the connected components of the links.

Defined cases: null and zero vectors, and vectors with null or non-finite components, link with
nothing (their own component); vectors of each length have an index of their own and link only
among themselves; repeated rows and tied ids count as other vectors; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import connected_components, materialise, with_row_ids
from riskframe.llm.groups import sorted_groups

THRESHOLD = 0.95
N_SUB = 8
N_CODES = 64
TRAIN_ROWS = 8192
LIST_ROWS = 512
BLOCK = 1024
MARGIN = 4.0
_SLACK = 1e-9


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres)
        for d in range(x.shape[1]):
            total = np.bincount(near, x[:, d], minlength=k)
            count = np.bincount(near, minlength=k)
            centres[:, d] = np.where(count > 0, total / np.maximum(count, 1), centres[:, d])
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres ** 2).sum(axis=1)
    return np.concatenate([np.argmin(half[None, :] - part @ centres.T, axis=1) for part in np.array_split(x, max(1, len(x) // 4096 + 1))]) if len(x) else np.empty(0, np.int64)


def fit_index(sample: np.ndarray, n_lists: int) -> dict:
    """Coarse centroids and residual codebooks from unit vectors."""
    coarse = kmeans(sample.copy(), n_lists)
    residual = sample - coarse[nearest(sample, coarse)]
    cuts = np.linspace(0, sample.shape[1], min(N_SUB, sample.shape[1]) + 1).astype(int)
    books = [kmeans(residual[:, a:b].copy(), N_CODES, seed=11 + a) for a, b in zip(cuts[:-1], cuts[1:])]
    return {"coarse": coarse, "cuts": cuts, "books": books}


def encode(x: np.ndarray, index: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list, codes, left-over length) of unit vectors."""
    home = nearest(x, index["coarse"])
    residual = x - index["coarse"][home]
    codes = np.empty((len(x), len(index["books"])), np.uint8)
    left = np.zeros(len(x))
    for m, (a, b, book) in enumerate(zip(index["cuts"][:-1], index["cuts"][1:], index["books"])):
        codes[:, m] = nearest(residual[:, a:b], book)
        left += ((residual[:, a:b] - book[codes[:, m]]) ** 2).sum(axis=1)
    return home, codes, np.sqrt(left)


def probes(x: np.ndarray, home: np.ndarray, index: dict, radius: float, margin: float = MARGIN) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs of the lists that a vector within ``radius`` can live in."""
    centres = index["coarse"]
    reach = radius * min(1.0, margin / np.sqrt(x.shape[1]))
    gap = np.sqrt(np.maximum(0, ((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)))
    rows, lists = [], []
    for at in range(0, len(x), 2048):
        part, own = x[at: at + 2048], home[at: at + 2048]
        d = np.maximum(0, (part ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1)[None, :] - 2 * part @ centres.T)
        bisector = (d - d[np.arange(len(part)), own][:, None]) / (2 * np.maximum(gap[own], 1e-300))
        near = bisector <= reach + _SLACK
        near[np.arange(len(part)), own] = True
        r, c = np.nonzero(near)
        rows.append(r + at), lists.append(c)
    return (np.concatenate(rows), np.concatenate(lists)) if rows else (np.empty(0, np.int64), np.empty(0, np.int64))


def reaches(x: np.ndarray, home: int, lists: np.ndarray, index: dict, radius: float, margin: float = MARGIN) -> np.ndarray:
    """Whether each vector, all living in list ``home``, probes its list in ``lists`` (as ``probes`` decides)."""
    centres = index["coarse"]
    reach = radius * min(1.0, margin / np.sqrt(x.shape[1]))
    gap = np.sqrt(((centres[lists] - centres[home]) ** 2).sum(axis=1))
    bisector = (((x - centres[lists]) ** 2).sum(axis=1) - ((x - centres[home]) ** 2).sum(axis=1)) / (2 * np.maximum(gap, 1e-300))
    return (lists == home) | (bisector <= reach + _SLACK)


def _unit(col: pa.Array) -> np.ndarray:
    """Doubles of a vector column, scaled to length one (all rows of one length, no nulls)."""
    x = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    return x / np.sqrt((x ** 2).sum(axis=1))[:, None]


def _links_of(usable: DataFrame, n: int, stored_type: str, threshold: float, train_rows: int, list_rows: int) -> DataFrame:
    """(rid, links, near) of the ``n`` different vectors (rid, vec, copies) of one length: link counts
    (copies of the other ends), and spanning edges with 0 links."""
    spark = usable.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    share = min(1.0, train_rows / n)
    picked = usable.where(F.pmod(F.xxhash64("vec"), F.lit(1_000_000)) < max(1, int(share * 1_000_000)))
    if not picked.limit(1).count():
        picked = usable.limit(1)
    sample = np.unique(np.array([r.vec for r in picked.select("vec").collect()]), axis=0)
    sample /= np.sqrt((sample ** 2).sum(axis=1))[:, None]
    # One centroid for about list_rows rows, up to what the sample can support.
    index = spark.sparkContext.broadcast(fit_index(sample, int(max(1, min(n // list_rows, len(sample) // 8)))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):  # bounded memory however many lists a vector probes
                batch = whole.slice(at, 1024)
                x = _unit(batch.column("vec"))
                home, codes, left = encode(x, index.value)
                r, lists = probes(x, home, index.value, radius)
                rows_at = pa.array(r)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rid").take(rows_at), pa.array(lists.astype(np.int32)), pa.array(lists == home[r]),
                     pa.array([bytes(c) for c in codes[r]], pa.binary()), pa.array(left[r]), batch.column("vec").take(rows_at),
                     pa.array(home[r].astype(np.int32)), batch.column("copies").take(rows_at)],
                    names=["rid", "list", "member", "codes", "left", "vec", "home", "copies"])

    placed = materialise(usable.mapInArrow(place, f"rid long, list int, member boolean, codes binary, left double, vec {stored_type}, home int, copies long"), "pq-placed")
    sizes = placed.groupBy("list").agg(F.ceil(F.sum(F.col("member").cast("int")) / BLOCK).cast("int").alias("m_blocks"), F.ceil(F.count("*") / BLOCK).cast("int").alias("q_blocks"))
    sizes = materialise(sizes.where("m_blocks > 0"), "pq-sizes")
    laid = placed.join(sizes, "list")
    h = F.xxhash64("rid", "list")
    queries = laid.select("list", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1)).alias("m"), F.pmod(h, F.col("q_blocks")).cast("int").alias("q"), "rid", F.lit(False).alias("is_member"), "codes", "left", "vec", "home", "copies")
    members = laid.where("member").select("list", F.pmod(h, F.col("m_blocks")).cast("int").alias("m"), F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("q"), "rid", F.lit(True).alias("is_member"), "codes", "left", "vec", "home", "copies")
    cells = queries.unionByName(members).repartition("list", "m", "q").sortWithinPartitions("list", "m", "q")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_groups(batches, ["list", "m", "q"]):
            rid, left = table.column("rid").to_numpy(), table.column("left").to_numpy()
            is_member = table.column("is_member").to_numpy(zero_copy_only=False)
            lists, home, copies = (table.column(c).to_numpy() for c in ("list", "home", "copies"))
            vec = table.column("vec").combine_chunks()
            unit = _unit(vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec)
            codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint8).reshape(len(rid), -1)
            found = []
            for s, e in zip(starts[:-1], starts[1:]):
                mem, qry = s + np.flatnonzero(is_member[s:e]), s + np.flatnonzero(~is_member[s:e])
                if not len(mem) or not len(qry):
                    continue
                i, j = links(unit[qry], unit[mem], codes[mem], left[mem], int(lists[s]), index.value, threshold, radius)
                other = rid[qry][i] != rid[mem][j]
                i, j = i[other], j[other]
                if len(i):
                    # The other end counts the link itself where it probes the query's list; else it is counted here.
                    away = np.flatnonzero(home[qry][i] != lists[s])
                    unseen = away[~reaches(unit[mem[j[away]]], int(lists[s]), home[qry[i[away]]], index.value, radius)]
                    for end, other_end in ((qry[i], mem[j]), (mem[j[unseen]], qry[i[unseen]])):
                        ends, at = np.unique(end, return_inverse=True)
                        count = np.bincount(at, weights=copies[other_end], minlength=len(ends)).astype(np.int64)
                        found.append((rid[ends], count, rid[ends]))
                    found.append(_spanning(i, j, rid[qry], rid[mem]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[c] for f in found])) for c in range(3)], names=["rid", "links", "near"])

    return cells.mapInArrow(compare, "rid long, links long, near long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS, list_rows: int = LIST_ROWS) -> DataFrame:
    """One row per vector of (vec_id, embedding): vec_id, n_links, component_id, kept."""
    stored_type = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = with_row_ids(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(stored_type).alias("vec")), "pq-rows")
    finite = ~F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("vec").isNotNull() & finite & F.exists("vec", lambda v: v != 0)
    # Equal vectors share two 64-bit hashes; rows without a usable vector have none and meet nothing.
    rows = rows.withColumn("ka", F.when(usable, F.xxhash64("vec"))).withColumn("kb", F.when(usable, F.xxhash64(F.lit(1), "vec")))
    heads = materialise(rows.where("ka is not null").groupBy("ka", "kb").agg(F.min("rid").alias("rid"), F.count("*").alias("copies")), "pq-heads")
    different = materialise(rows.select("rid", "vec").join(heads.select("rid", "copies"), "rid"), "pq-different")
    lengths = different.groupBy(F.size("vec").alias("d")).count().orderBy("d").collect()  # one row for each vector length
    if not lengths:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = [_links_of(different.where(F.size("vec") == r.d), r["count"], stored_type, threshold, train_rows, list_rows) for r in lengths]
    links_table = materialise(functools.reduce(DataFrame.unionByName, found), "pq-links")
    counts = links_table.groupBy("rid").agg(F.sum("links").alias("others"))
    edges = links_table.where("rid <> near").select(F.col("rid").alias("a"), F.col("near").alias("b")).distinct()
    parts = connected_components(edges, "pq").withColumnRenamed("node", "rid")
    groups = heads.join(counts, "rid", "left").join(parts, "rid", "left").select(
        "ka", "kb", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rid").alias("component"))
    # One join on the hash key, between stored tables: a hot group's rows are split by the adaptive skew join.
    known = rows.select("rid", "vec_id", "ka", "kb").join(materialise(groups, "pq-groups"), ["ka", "kb"], "left")
    known = materialise(known.select("vec_id", "n_links", F.coalesce("component", "rid").alias("component")), "pq-known")
    least = materialise(known.groupBy("component").agg(F.min("vec_id").alias("component_id")).where("component_id is not null"), "pq-least")
    return known.join(least, "component", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _spanning(i: np.ndarray, j: np.ndarray, query: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spanning edges of the bipartite links (i, j): every vector to the smallest of its component in this cell."""
    ids = np.unique(np.concatenate([query[i], member[j]]))
    a, b = np.searchsorted(ids, query[i]), np.searchsorted(ids, member[j])
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            break
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
    return ids, np.zeros(len(ids), np.int64), ids[label]


def links(query: np.ndarray, member: np.ndarray, codes: np.ndarray, left: np.ndarray, home: int, index: dict, threshold: float, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(query row, member row) with exact cosine >= threshold, filtered by table-lookup distances."""
    found_i, found_j = [], []
    residual = query - index["coarse"][home]
    for at in range(0, len(query), 256):
        part = residual[at: at + 256]
        estimate = np.zeros((len(part), len(member)))
        for m, (a, b, book) in enumerate(zip(index["cuts"][:-1], index["cuts"][1:], index["books"])):
            tables = np.maximum(0, (part[:, a:b] ** 2).sum(axis=1)[:, None] + (book ** 2).sum(axis=1)[None, :] - 2 * part[:, a:b] @ book.T)
            estimate += tables[:, codes[:, m]]
        i, j = np.nonzero(np.sqrt(estimate) <= radius + left[None, :] + 1e-6)
        cosine = np.concatenate([np.einsum("ij,ij->i", query[at + i[k: k + 65536]], member[j[k: k + 65536]]) for k in range(0, len(i), 65536)]) if len(i) else np.empty(0)
        near = cosine >= threshold
        found_i.append(at + i[near]), found_j.append(j[near])
    return np.concatenate(found_i), np.concatenate(found_j)
