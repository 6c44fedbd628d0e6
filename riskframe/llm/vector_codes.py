"""Vector code compression: product codes whose nearest entries come from sorted slices and bitmasks.

Vectors become integers (floor of 1024 times a component) and are cut into ``PARTS`` parts; each
part position has a codebook of at most ``ENTRIES`` entries, moved in ``ROUNDS`` rounds of
assignment and averaging. The nearest entry is found by slice and intersect: for every dimension
the entries' coordinates are sorted, and prefix masks (bits of the entries up to each place) give
the entries within a radius as the difference of two prefixes; the masks of all dimensions,
ANDed, leave the entries in a cube around the vector. An entry no further than the radius lies in
the cube, so a best distance within it is exact; other vectors try again with the distance found,
or twice the radius if the cube was empty.

Tasks return sums and counts for each (part, entry) only; codebooks are the one thing that reaches
the driver, of a size fixed by the parameters and the vectors' length.

Defined cases: null vectors and vectors with null or non-finite components are dropped; vectors of
each length have codebooks of their own (a length that 4 doesn't divide is filled up with zeros);
of the first entries, ties of vec_id go by vector and null ids come last; fewer vectors than
entries make smaller codebooks; repeated rows are coded one by one; null labels are one label; an
empty table gives an empty result; other columns of the input are ignored. Squared distances must
fit 64 bits: an integer of 2 ** 29 / sqrt(components of a part) or more in size (of 64-dimensional
vectors: a component of 131,072) raises an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialise, scratch
from riskframe.operators.joins import null_safe_join

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
WIDE = 16  # components whose sums stand in one row
_ROWS = 8192  # vectors looked up at once
_PAIRS = 1 << 18  # candidates compared at once


class SliceIndex:
    """The entries of one codebook (rows of integers), each dimension sorted, with prefix bitmasks."""

    def __init__(self, entries: np.ndarray):
        n, self.dims = entries.shape
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, axis=0).T)
        words = -(-n // 64)
        self.prefix = np.zeros((self.dims, n + 1, words), np.uint64)
        bit = np.uint64(1) << (order % 64).astype(np.uint64)
        for d in range(self.dims):
            own = np.zeros((n, words), np.uint64)
            own[np.arange(n), order[:, d] // 64] = bit[:, d]
            self.prefix[d, 1:] = np.bitwise_or.accumulate(own, axis=0)
        # A first radius: half the median distance from an entry to its nearest other one.
        if n > 1:
            gap = entries[:, None, :] - entries[None, :, :]
            square = (gap * gap).sum(axis=2)
            np.fill_diagonal(square, np.iinfo(np.int64).max)
            self.radius = max(1, int(np.median(square.min(axis=1)) ** 0.5 / 2))
        else:
            self.radius = 1

    def _cube(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """uint64 masks of the entries within ``radius`` of each row in every dimension."""
        mask = np.full((len(x), self.prefix.shape[2]), ~np.uint64(0))
        for d in range(self.dims):
            low = np.searchsorted(self.sorted[d], x[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[d], x[:, d] + radius, side="right")
            mask &= self.prefix[d, high] & ~self.prefix[d, low]
        if not self.dims:
            mask &= np.uint64(1)
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for every row; of equal distances the lowest entry."""
        best, square = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        open_rows, radius = np.arange(len(x)), np.full(len(x), self.radius, np.int64)
        while len(open_rows):
            mask = self._cube(x[open_rows], radius)
            bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            distance = np.empty(len(row), np.int64)
            for at in range(0, len(row), _PAIRS):
                gap = x[open_rows[row[at: at + _PAIRS]]] - self.entries[entry[at: at + _PAIRS]]
                distance[at: at + _PAIRS] = (gap * gap).sum(axis=1)
            again = np.ones(len(open_rows), bool)
            if len(row):
                starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                least = np.minimum.reduceat(distance, starts)
                hit = np.flatnonzero(distance == np.repeat(least, np.diff(np.append(starts, len(row)))))
                hit = hit[np.concatenate([[True], row[hit][1:] != row[hit][:-1]])]  # entries ascend within a row
                found = row[hit]
                sure = least <= radius[found] * radius[found]
                best[open_rows[found[sure]]], square[open_rows[found[sure]]] = entry[hit[sure]], least[sure]
                again[found[sure]] = False
                radius *= 2
                reach = np.sqrt(least[~sure].astype(np.float64)).astype(np.int64) + 2  # at least the root, whatever the rounding
                radius[found[~sure]] = reach
            else:
                radius *= 2
            open_rows, radius = open_rows[again], np.minimum(radius[again], np.int64(1) << 31)
        return best, square


def _integers(flat: np.ndarray, length: int) -> np.ndarray:
    """Rows of integer components, filled up with zeros to a multiple of ``PARTS``."""
    x = np.floor(flat.astype(np.float64) * SCALE).reshape(-1, length) if length else np.zeros((len(flat), 0))
    wide = -(-length // PARTS) * PARTS
    if x.size and np.abs(x).max() >= 2**29 / (wide // PARTS) ** 0.5:
        raise ValueError("components are too large for squared distances of 64 bits")
    return np.concatenate([x.astype(np.int64), np.zeros((len(x), wide - length), np.int64)], axis=1)


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    return _integers(column.flatten().to_numpy(zero_copy_only=False), length) if length else np.zeros((len(column), 0), np.int64)


def _assign(x: np.ndarray, indexes: list[SliceIndex]) -> tuple[np.ndarray, np.ndarray]:
    width = x.shape[1] // PARTS
    found = [index.nearest(x[:, k * width: (k + 1) * width]) for k, index in enumerate(indexes)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _step(vectors: DataFrame, length: int, books: np.ndarray) -> np.ndarray:
    """Codebooks (part, entry, position) after one assignment of all vectors; unused entries stay."""
    n_entries, width = books.shape[1:]
    n_slices = -(-width // WIDE)
    columns = [f"s{k}" for k in range(WIDE)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [SliceIndex(b) for b in books]
        total = np.zeros((PARTS, n_entries, n_slices * WIDE), np.int64)
        count = np.zeros((PARTS, n_entries), np.int64)
        for batch in _slices(batches):
            x = _vectors(batch.column("vec"), length)
            codes, _ = _assign(x, indexes)
            for k in range(PARTS):
                np.add.at(total[k, :, :width], codes[:, k], x[:, k * width: (k + 1) * width])
                count[k] += np.bincount(codes[:, k], minlength=n_entries)
        part, entry = np.nonzero(count)
        part, entry, place = np.repeat(part, n_slices), np.repeat(entry, n_slices), np.tile(np.arange(n_slices), len(part))
        block = total.reshape(PARTS, n_entries, n_slices, WIDE)[part, entry, place]
        yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in (part, entry, place, count[part, entry])), *(pa.array(block[:, k]) for k in range(WIDE))],
                                         names=["part", "entry", "place", "n", *columns])

    schema = ", ".join(f"{c} long" for c in ("part", "entry", "place", "n", *columns))
    moved = vectors.mapInArrow(sums, schema).groupBy("part", "entry", "place").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", *columns)])
    after = books.copy()
    for r in moved.collect():  # one row for each slice of an entry that is used
        at = slice(r.place * WIDE, min(width, (r.place + 1) * WIDE))
        after[r.part, r.entry, at] = [int(r[c]) // int(r.n) for c in columns][: at.stop - at.start]
    return after


def _finite(vector: str):
    return F.expr(f"{vector} is not null and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")


def fit(vectors: DataFrame, length: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) of vectors (columns vec_id, vec) of one length."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).collect()
    x = _integers(np.array([c for r in first for c in r.vec], np.float64), length) if length else np.zeros((len(first), 0), np.int64)
    books = x.reshape(len(first), PARTS, -1).transpose(1, 0, 2) if x.size else np.zeros((PARTS, len(first), 0), np.int64)
    books = np.ascontiguousarray(books)
    for _ in range(rounds):
        books = _step(vectors, length, books)
    return books


def encode(vectors: DataFrame, length: int, books: np.ndarray) -> DataFrame:
    """Columns vec_id, label, code, error of vectors (columns vec_id, label, vec) of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [SliceIndex(b) for b in books]
        for batch in _slices(batches):
            codes, square = _assign(_vectors(batch.column("vec"), length), indexes)
            hexes = [c.hex() for c in map(bytes, codes.astype(np.uint8))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(hexes, pa.string()), pa.array(square.sum(axis=1))],
                                             names=["vec_id", "label", "code", "error"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "label", "vec").mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, column: str = "code") -> DataFrame:
    """``codes`` with the integers that the codes stand for in a column ``decoded``."""
    listed = F.array(*[F.array(*[F.array(*map(F.lit, e.tolist())) for e in book]) for book in books])
    parts = [F.get(F.get(listed, F.lit(k)), F.conv(F.substring(column, 2 * k + 1, 2), 16, 10).cast("int")) for k in range(PARTS)]
    return codes.withColumn("decoded", F.concat(*parts))


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """Columns vec_id, code, error, label_error, codebooks_sha256 of every usable vector."""
    spark = table.sparkSession
    with scratch(spark):
        kept = table.where(_finite(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col(vector).cast("array<double>").alias("vec"))
        kept = materialise(kept.withColumn("length", F.size("vec")), "codes-vectors")
        coded = None
        for length in sorted(r.length for r in kept.select("length").distinct().collect()):  # vectors of one table have one length, or few
            own = kept.where(F.col("length") == length)
            books = fit(own, length)
            part = encode(own, length, books).withColumn("codebooks_sha256", F.lit(books_sha256(books)))
            coded = part if coded is None else coded.unionByName(part)
        if coded is None:
            coded = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256"))
        coded = materialise(coded, "codes-coded")
        labels = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
        out = null_safe_join(coded, labels, ["label"]).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
        return materialise(out, "codes-result", keep=True)
