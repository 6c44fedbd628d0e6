"""Binned feature tables: quantile cut points fitted once, one byte per feature and row.

A binned table has the key, the label and ``bins``, a binary column with the bin number of
every feature. Learners that look at counts per bin read it instead of the wide table of
doubles, and any subset of the features is a choice of positions in it. Bin ``b`` of a feature
holds the values above cut ``b - 1`` and up to cut ``b``; null and NaN are in bin 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BINS = 64


@dataclass
class Binning:
    """Cut points of every feature, in feature order."""

    names: list[str]
    cuts: list[np.ndarray]

    @property
    def n_bins(self) -> int:
        return max([1, *(len(c) + 1 for c in self.cuts)])

    def bin(self, values: np.ndarray) -> np.ndarray:
        """(rows, features) bin numbers of a matrix of doubles."""
        out = np.zeros(values.shape, np.uint8)
        for j, cuts in enumerate(self.cuts):
            x = values[:, j]
            out[:, j] = np.where(np.isnan(x), 0, np.searchsorted(cuts, x, side="left"))
        return out


def fit_bins(df: DataFrame, values: Column, names: Sequence[str], max_bins: int = MAX_BINS, accuracy: int = 10_000) -> Binning:
    """Cut points at ``max_bins`` quantiles of every feature (fewer where values repeat), from one aggregate.

    ``values`` is an array of doubles, one per name. The quantiles are those of
    ``percentile_approx``: any cut points make valid bins, and the sketch has a bounded size.
    """
    if not 2 <= max_bins <= 256:
        raise ValueError("a bin number must fit one byte")
    at = [F.get(values, F.lit(i)) for i in range(len(names))]
    x = [F.when(~F.isnan(c), c) for c in at]
    probs = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    aggs = [a for i, c in enumerate(x) for a in (F.percentile_approx(c, probs, accuracy).alias(f"q{i}"), F.max(c).alias(f"m{i}"))]
    row = df.agg(*aggs).first()
    cuts = [np.array(sorted({q for q in row[f"q{i}"] or () if q < row[f"m{i}"]})) for i in range(len(names))]
    return Binning(list(names), cuts)


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """A binary array with one value for each row of a matrix."""
    rows = np.ascontiguousarray(matrix)
    width = rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32)), pa.py_buffer(rows.tobytes())])


def matrix_rows(column: pa.Array, dtype=np.uint8) -> np.ndarray:
    """The matrix that :func:`binary_rows` made a column of."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), dtype)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    return data.view(dtype).reshape(len(column), -1)


def bin_table(df: DataFrame, values: Column, binning: Binning, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` and ``bins`` of every row of ``df``."""
    source = df.select(*keep, values.alias("__values"))
    schema = source.drop("__values").withColumn("bins", F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("__values").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            matrix = binning.bin(flat.reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), binary_rows(matrix)], names=[*keep, "bins"])

    return source.mapInArrow(run, schema)
