"""Feed-forward networks trained by distributed mini-batch steps.

ReLU layers with dropout, one logit, binary cross-entropy in which positives weigh
``positive_weight``, Adam. Rows are dealt into mini-batches once, by a hash of their key: a batch is
one partition (or several, if it holds more than ``PIECE_ROWS`` rows) of an RDD of packed rows that
stays persisted while the networks are trained. An epoch visits the batches in a seeded order, so it
reads every row once. One step is one job over the partitions of its batch, with one task for each of
them and model; tasks add up the gradients of their rows and the driver, which holds parameters only,
takes the Adam step. All specs given to :func:`fit` share the jobs, and specs that differ in their
number of epochs only are trained once.

Steps follow each other, and one whose batch is a single partition has one task for each model. Many such
steps are taken inside one task for each model: it copies the batches to a temporary file of its own, reads
them back in the order of each epoch, and returns the parameters. The sums and the steps are the same.

Dropout masks are a hash of key, epoch, layer and unit, and the sums of blocks of rows are rounded to
fixed-point integers before they are added, so another partitioning changes a gradient by no more
than 2 ** -36 for each block. A step is worth a job where ``batch_size`` is large; raise it with the
number of rows.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.binning import binary_rows, matrix_rows

UNIT = 2.0**36  # fixed-point gradients: a batch's sum must stay below 2 ** 27
PIECE_ROWS = 8192  # rows of a batch that one task of a step reads, about
IN_TASK_STEPS = 16  # more steps than these are worth a copy of the batches for each model
TASK_BYTES = 16_000_000_000  # of batches that a task may copy to its disk
_MEMORY_BYTES = 32_000_000  # of those that it holds in memory instead
_ROWS = 2048  # rows whose activations are held at once


@dataclass(frozen=True)
class NetworkSpec:
    name: str
    hidden: tuple[int, ...] = (256, 64)
    dropout: float = 0.2
    learning_rate: float = 0.001
    epochs: int = 20
    positive_weight: float = 1.0
    seed: int = 42

    def initial(self, inputs: int) -> np.ndarray:
        """Flat parameters: every layer's weights, then its biases, uniform within 1 / sqrt(inputs of the layer)."""
        rng = np.random.default_rng(self.seed)
        sizes = [inputs, *self.hidden, 1]
        return np.concatenate([rng.uniform(-1, 1, (a + 1) * b) / max(1, a) ** 0.5 for a, b in zip(sizes, sizes[1:])])

    def layers(self, flat: np.ndarray, inputs: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Views (weights, biases) of the layers in the flat parameters."""
        out, at, sizes = [], 0, [inputs, *self.hidden, 1]
        for a, b in zip(sizes, sizes[1:]):
            out.append((flat[at: at + a * b].reshape(a, b), flat[at + a * b: at + (a + 1) * b]))
            at += (a + 1) * b
        return out


@dataclass
class Network:
    spec: NetworkSpec
    inputs: int
    parameters: np.ndarray
    history: list[float] = field(default_factory=list)  # mean train loss of each epoch

    def logits(self, x: np.ndarray) -> np.ndarray:
        for w, b in (layers := self.spec.layers(self.parameters, self.inputs))[:-1]:
            x = np.maximum(x @ w + b, 0.0)
        w, b = layers[-1]
        return (x @ w + b)[:, 0]


def _keep_mask(hashed: np.ndarray, units: int, dropout: float, step: int) -> np.ndarray:
    """(rows, units): 0 for dropped units, 1 / (1 - dropout) for the others."""
    if dropout <= 0:
        return np.ones((len(hashed), units))
    x = hashed.astype(np.uint64)[:, None] + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) + (np.arange(units, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >= np.uint64(int(dropout * 2**64))) / (1.0 - dropout)


def loss_and_gradient(spec: NetworkSpec, flat: np.ndarray, x: np.ndarray, label: np.ndarray, weight: np.ndarray, hashed: np.ndarray, epoch: int) -> tuple[float, np.ndarray]:
    """Sums over the rows of the weighted loss and of its gradient."""
    layers = spec.layers(flat, x.shape[1])
    inputs, masks, a = [x], [], x
    for i, (w, b) in enumerate(layers[:-1]):
        mask = _keep_mask(hashed, w.shape[1], spec.dropout, (spec.seed * 1009 + epoch) * 64 + i)
        z = a @ w + b
        a = np.where(z > 0, z, 0.0) * mask
        inputs.append(a), masks.append((z > 0) * mask)
    w, b = layers[-1]
    logit = (a @ w + b)[:, 0]
    row_weight = weight * np.where(label == 1, spec.positive_weight, 1.0)
    loss = float((row_weight * (np.logaddexp(0.0, logit) - label * logit)).sum())
    delta = (row_weight * (1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500))) - label))[:, None]
    parts = []
    for i in range(len(layers) - 1, -1, -1):
        parts[:0] = [(inputs[i].T @ delta).ravel(), delta.sum(axis=0)]
        if i:
            delta = (delta @ layers[i][0].T) * masks[i - 1]
    return loss, np.concatenate(parts)


def _block_sums(spec: NetworkSpec, flat: np.ndarray, block: Sequence, epoch: int) -> tuple[np.ndarray, int]:
    """Fixed-point gradient and loss of a block of rows."""
    y, w, hashed, x = block[:4]
    label = np.frombuffer(y, np.int32).astype(np.float64)
    loss, gradient = loss_and_gradient(spec, flat, np.frombuffer(x, np.float64).reshape(len(label), -1), label, np.frombuffer(w, np.float64), np.frombuffer(hashed, np.int64), epoch)
    return np.rint(gradient * UNIT).astype(np.int64), round(loss * UNIT)


def _gradient_job(blocks: RDD, parts: Sequence[int], specs: Sequence[NetworkSpec], parameters: Sequence[np.ndarray], epoch: int) -> tuple[list[np.ndarray], list[float]]:
    """Gradient and loss sums of all models over the rows of one batch, which are the partitions ``parts`` of ``blocks``."""
    sc, n_parts = blocks.context, blocks.getNumPartitions()
    shared = sc.broadcast(list(parameters))  # model-sized
    of_models = sc.union([blocks] * len(specs)) if len(specs) > 1 else blocks  # partition m * n_parts + p: model m on partition p

    def add(index: int, rows: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray, int]]:
        m = index // n_parts
        spec, flat, total, loss = specs[m], shared.value[m], None, 0
        for block in rows:
            part, own_loss = _block_sums(spec, flat, block, epoch)
            total, loss = part if total is None else total + part, loss + own_loss
        if total is not None:
            yield m, total, loss

    found = sc.runJob(of_models.mapPartitionsWithIndex(add), lambda rows: rows, [m * n_parts + p for m in range(len(specs)) for p in parts])  # the models' sizes
    shared.destroy()
    gradients, losses = [np.zeros(len(p), np.int64) for p in parameters], [0] * len(specs)
    for m, total, loss in found:
        gradients[m] += total
        losses[m] += loss
    return [g / UNIT for g in gradients], [x / UNIT for x in losses]


def fit(df: DataFrame, features: Column, inputs: int, specs: Sequence[NetworkSpec], key: str, label: str, batch_size: int = 1024, weight: Column | None = None) -> list[Network]:
    """Train all ``specs`` on the rows of ``df``; ``features`` is an array of ``inputs`` doubles, ``label`` is 0 or 1.

    ``weight`` multiplies a row's loss, and a batch's loss and gradient are divided by its sum of weights:
    a row of weight 2 counts as that row twice. Null and NaN features count as 0.
    """
    n = df.count()
    n_batches, pieces = max(1, -(-n // batch_size)), max(1, -(-batch_size // PIECE_ROWS))
    epochs: dict[NetworkSpec, int] = {}  # what is trained, whatever its name, and how long
    for s in specs:
        epochs[_run(s)] = max(s.epochs, epochs.get(_run(s), 0))
    runs = {s: Network(s, inputs, s.initial(inputs)) for s in epochs}
    first, second = ({s: np.zeros(len(r.parameters)) for s, r in runs.items()} for _ in range(2))
    networks = [Network(s, inputs, runs[_run(s)].parameters.copy()) for s in specs]
    blocks = _blocks(_deal(df, features, key, label, weight, n_batches), label, n_batches, pieces).rdd.mapPartitionsWithIndex(_numbered).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes: dict[int, float] = {}
        for part, size in blocks.mapPartitionsWithIndex(_weights).collect():  # one row for each batch
            sizes[part // pieces] = sizes.get(part // pieces, 0.0) + size
        if pieces == 1 and len(sizes) * max(epochs.values(), default=0) > IN_TASK_STEPS and n * inputs * 8 <= TASK_BYTES:
            _train_in_tasks(blocks, runs, epochs, sizes, networks, specs[0].seed)
            return networks
        taken = 0
        for epoch in range(max(epochs.values(), default=0)):
            active = [s for s in runs if epoch < epochs[s]]
            losses = dict.fromkeys(active, 0.0)
            for batch in _order(sizes, specs[0].seed, epoch):
                gradients, lost = _gradient_job(blocks, range(batch * pieces, (batch + 1) * pieces), active, [runs[s].parameters for s in active], epoch)
                taken += 1
                for s, g, loss in zip(active, gradients, lost):
                    losses[s] += loss
                    _adam(runs[s].parameters, g / sizes[batch], first[s], second[s], taken, s.learning_rate)
            for s in active:
                runs[s].history.append(losses[s] / max(1e-300, sum(sizes.values())))
            for net in networks:
                if net.spec.epochs == epoch + 1:
                    net.parameters, net.history = runs[_run(net.spec)].parameters.copy(), list(runs[_run(net.spec)].history)
    finally:
        blocks.unpersist()
    return networks


def _run(spec: NetworkSpec) -> NetworkSpec:
    """What specs that differ in their name and number of epochs only have in common."""
    return replace(spec, name="", epochs=0)


def _order(sizes: dict[int, float], seed: int, epoch: int) -> list[int]:
    """The batches in the order in which an epoch visits them."""
    return np.random.default_rng((seed, epoch)).permutation(sorted(sizes)).tolist()


def _numbered(part: int, rows: Iterator) -> Iterator[tuple]:
    """Blocks with the partition they are in."""
    return ((*row, part) for row in rows)


def _train_in_tasks(blocks: RDD, runs: dict[NetworkSpec, Network], epochs: dict[NetworkSpec, int], sizes: dict[int, float], networks: Sequence[Network], seed: int) -> None:
    """Train each run in a task of its own, one partition being one batch; fills the parameters and histories of ``networks``."""
    trained, sc = list(runs), blocks.context
    ends = {s: {n.spec.epochs for n in networks if _run(n.spec) == s} for s in trained}
    inputs, whole = networks[0].inputs, max(1e-300, sum(sizes.values()))

    def train(m: int, rows: Iterator[tuple]) -> Iterator[tuple]:
        spec = trained[m]
        flat, held = spec.initial(inputs), {}
        first, second = np.zeros(len(flat)), np.zeros(len(flat))
        history, taken = [], 0
        with tempfile.SpooledTemporaryFile(_MEMORY_BYTES) as copy:
            for *block, part in rows:
                held.setdefault(part, []).append((copy.tell(), [len(b) for b in block]))
                copy.writelines(block)
            for epoch in range(epochs[spec]):
                losses = 0.0
                for batch in _order(sizes, seed, epoch):
                    total, loss = np.zeros(len(flat), np.int64), 0
                    for at, lengths in held[batch]:
                        copy.seek(at)
                        part, own_loss = _block_sums(spec, flat, [copy.read(n) for n in lengths], epoch)
                        total, loss = total + part, loss + own_loss
                    taken, losses = taken + 1, losses + loss / UNIT
                    _adam(flat, total / UNIT / sizes[batch], first, second, taken, spec.learning_rate)
                history.append(losses / whole)
                if epoch + 1 in ends[spec]:
                    yield m, epoch + 1, flat.copy(), list(history)

    alone = blocks.coalesce(1)
    of_models = sc.union([alone] * len(trained)) if len(trained) > 1 else alone
    found = {(m, epoch): (flat, history) for m, epoch, flat, history in of_models.mapPartitionsWithIndex(train).collect()}  # the models' sizes
    for net in networks:
        if net.spec.epochs:
            flat, history = found[trained.index(_run(net.spec)), net.spec.epochs]
            net.parameters, net.history = flat.copy(), list(history)


def _weights(part: int, rows: Iterator[tuple]) -> Iterator[tuple[int, float]]:
    """The sum of weights of a partition that holds rows."""
    found = [float(np.frombuffer(row[1], np.float64).sum()) for row in rows]
    if found:
        yield part, sum(found)


def _deal(df: DataFrame, features: Column, key: str, label: str, weight: Column | None, n_batches: int) -> DataFrame:
    """Rows with their batch, weight and features as bytes."""
    source = df.select(F.col(label).cast("int").alias(label), (F.lit(1.0) if weight is None else weight.cast("double")).alias("weight"),
                       F.xxhash64(key).alias("__hash"), features.alias("__x"))
    source = source.withColumn("batch", F.pmod(F.xxhash64("__hash", F.lit(17)), F.lit(n_batches)).cast("int"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.nan_to_num(batch.column("__x").flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (label, "weight", "__hash", "batch")), binary_rows(x)], names=[label, "weight", "__hash", "batch", "x"])

    return source.mapInArrow(pack, f"{label} int, weight double, __hash long, batch int, x binary")


def _blocks(dealt: DataFrame, label: str, n_batches: int, pieces: int) -> DataFrame:
    """Blocks of rows (labels, weights, hashes and features as bytes); partition batch * pieces + piece holds the rows
    of that piece of a batch."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                y, w, hashed = (part.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in ((label, np.int32), ("weight", np.float64), ("__hash", np.int64)))
                packed = [y, w, hashed, matrix_rows(part.column("x"), np.float64)]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in packed], names=["y", "w", "hashed", "x"])

    part = F.col("batch") * pieces + F.pmod(F.xxhash64("__hash", F.lit(18)), F.lit(pieces)).cast("int")
    rows = dealt.withColumn("part", part).repartitionById(n_batches * pieces, "part").sortWithinPartitions("__hash")
    return rows.mapInArrow(block, "y binary, w binary, hashed binary, x binary")


def _adam(parameters: np.ndarray, gradient: np.ndarray, first: np.ndarray, second: np.ndarray, step: int, rate: float) -> None:
    """One Adam step in place, with its usual constants."""
    first += 0.1 * (gradient - first)
    second += 0.001 * (gradient * gradient - second)
    parameters -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)


def score(df: DataFrame, features: Column, networks: Sequence[Network], key: str, label: str) -> DataFrame:
    """Long (model, key, label, score) of all networks in one pass."""
    types = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.nan_to_num(batch.column("__x").flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(batch.num_rows, -1)
                for net in networks:
                    p = 1.0 / (1.0 + np.exp(-np.clip(net.logits(x), -500, 500)))
                    yield pa.RecordBatch.from_arrays([pa.array([net.spec.name] * len(p), pa.string()), batch.column(key), batch.column(label), pa.array(p)], names=["model", key, "label", "score"])

    return df.select(key, label, features.alias("__x")).mapInArrow(run, f"model string, {key} {types[key]}, label {types[label]}, score double")
