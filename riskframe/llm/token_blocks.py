"""Token-ID output: patched frame-of-reference (PFOR) segments.

Tokens of consecutive documents form a stream, cut into blocks of ``BLOCK`` ids. Each block
stores its minimum, the width that covers ``percentile`` of its offsets from the minimum, the
offsets' low bits packed at that width, and an exception list (position, high bits) for the rest.

Segment image (little-endian), one per row of the segment table, documents never split:

    magic "PFR1" | n_docs u32 | n_tokens u64 | n_blocks u32 | n_exceptions u32 | end_id u32
    doc lengths u32[n_docs] | block minimum u32[n_blocks] | block width u8[n_blocks]
    block start u64[n_blocks + 1] (byte offset in the packed area; the index for random access)
    exception start u32[n_blocks + 1] | exception position u8[n_exc] | exception high bits u32[n_exc]
    packed area

Segments are written through Spark as a Parquet table (part, segment, doc ids, payload), so any
store Spark writes to works and a retried task leaves no stray file.

Defined cases: null or empty text is the end id alone; repeated rows and tied or null doc ids
are encoded one by one, nulls first, ties by text; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import small_batches
from riskframe.llm.words import text_chunks, worker_state
from riskframe.session import ensure_checkpoint_dir

BLOCK = 128
END_ID = 2
SEGMENT_TOKENS = 1 << 19
PERCENTILE = 0.9
_HEADER = np.dtype([("magic", "S4"), ("n_docs", "<u4"), ("n_tokens", "<u8"), ("n_blocks", "<u4"), ("n_exc", "<u4"), ("end", "<u4")])

SEGMENT_SCHEMA = "part int, segment int, n_docs long, n_tokens long, doc_ids array<bigint>, payload binary"


def _bit_width(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1))).astype(np.int64) + 1, 0)


def pack_segment(ids: np.ndarray, lengths: np.ndarray, percentile: float = PERCENTILE, end_id: int = END_ID) -> bytes:
    """Encode one segment; ``ids`` fit 32 bits, ``lengths`` are the documents' token counts."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    padded = np.empty(n_blocks * BLOCK, np.int64)
    padded[:n] = ids
    padded[n:] = ids[-1] if n else 0
    blocks = padded.reshape(n_blocks, BLOCK)
    low = blocks.min(axis=1) if n_blocks else np.empty(0, np.int64)
    delta = blocks - low[:, None]
    rank = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    cover = np.partition(delta, rank, axis=1)[:, rank] if n_blocks else np.empty(0, np.int64)
    width = _bit_width(cover)
    high = delta >> width[:, None]
    row, pos = np.nonzero(high)
    exc_start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n_blocks))]).astype("<u4")
    start = np.concatenate([[0], np.cumsum(width * BLOCK // 8)]).astype("<u8")
    packed = np.zeros(int(start[-1]), np.uint8)
    for w in np.unique(width):
        if w == 0:
            continue
        of = np.flatnonzero(width == w)
        for part in np.array_split(of, max(1, len(of) // 2048 + 1)):  # bounded bit matrix
            octets = delta[part].astype("<u4").view(np.uint8).reshape(len(part) * BLOCK, 4)
            bits = np.unpackbits(octets, axis=1, count=int(w), bitorder="little")
            rows = np.packbits(bits.reshape(len(part), -1), axis=1, bitorder="little")
            packed[(start[part].astype(np.int64)[:, None] + np.arange(rows.shape[1])).ravel()] = rows.ravel()
    head = np.array([(b"PFR1", len(lengths), n, n_blocks, len(pos), end_id)], _HEADER)
    return b"".join((head.tobytes(), lengths.astype("<u4").tobytes(), low.astype("<u4").tobytes(), width.astype("u1").tobytes(),
                     start.tobytes(), exc_start.tobytes(), pos.astype("u1").tobytes(), high[row, pos].astype("<u4").tobytes(), packed.tobytes()))


def _layout(payload: bytes):
    head = np.frombuffer(payload, _HEADER, 1)[0]
    if head["magic"] != b"PFR1":
        raise ValueError("not a PFR1 segment")
    at = _HEADER.itemsize
    parts = []
    for kind, count in (("<u4", head["n_docs"]), ("<u4", head["n_blocks"]), ("u1", head["n_blocks"]), ("<u8", head["n_blocks"] + 1),
                        ("<u4", head["n_blocks"] + 1), ("u1", head["n_exc"]), ("<u4", head["n_exc"])):
        parts.append(np.frombuffer(payload, kind, int(count), at))
        at += int(count) * np.dtype(kind).itemsize
    return int(head["n_tokens"]), parts, np.frombuffer(payload, np.uint8, -1, at) if at < len(payload) else np.empty(0, np.uint8)


def unpack_blocks(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of blocks ``first`` to ``last`` (exclusive; all by default), found through the block index."""
    n, (_, low, width, start, exc_start, exc_pos, exc_high), packed = _layout(payload)
    last = len(low) if last is None else min(last, len(low))
    sel = np.arange(first, max(first, last))
    out = np.zeros((len(sel), BLOCK), np.int64)
    for w in np.unique(width[sel]):
        if w == 0:
            continue
        w = int(w)
        of = np.flatnonzero(width[sel] == w)
        for part in np.array_split(of, max(1, len(of) // 2048 + 1)):
            raw = packed[start[sel[part]].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)]
            bits = np.zeros((len(part) * BLOCK, 32), np.uint8)
            bits[:, :w] = np.unpackbits(raw, axis=1, bitorder="little").reshape(-1, w)
            out[part] = np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(len(part), BLOCK)
    a, b = int(exc_start[first]) if len(low) else 0, int(exc_start[max(first, last)]) if len(low) else 0
    row = np.repeat(np.arange(len(sel)), np.diff(exc_start[first: max(first, last) + 1].astype(np.int64)))
    out[row, exc_pos[a:b]] |= exc_high[a:b].astype(np.int64) << width[sel][row].astype(np.int64)
    out += low[sel].astype(np.int64)[:, None]
    flat = out.ravel()
    return flat[: max(0, n - first * BLOCK)] if last == len(low) else flat


def unpack_segment(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, document lengths) of a whole segment."""
    return unpack_blocks(payload), _layout(payload)[1][0].astype(np.int64)


# Letters of Latin-1 and a run of ASCII punctuation (no apostrophe): a piece of this form is cut
# by the pre-tokenizer between the two, and lower-casing and normalising change nothing else.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]*"
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_SIMPLE = f"^{_LETTERS}[{re.escape(_MARKS)}]*$"
_CACHE_ENTRIES = 140_000
_SLICE_PIECES = 100_000


def _byte_alphabet() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class _Encoder:
    """texts -> slices of (ids, ids per text), equal to encoding every whole text.

    The tokenizer's normaliser and pre-tokenizer never join across white space, so each different
    space-separated piece is encoded once, and texts are assembled from the pieces. Simple pieces go
    to the tokenizer's model as a word and its marks. Two generations of at most
    ``_CACHE_ENTRIES`` parts each are kept between the tasks of a worker.
    """

    def __init__(self, tokenizer_name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(public_tokenizers.path(tokenizer_name))
        self.model, self.alphabet = self.tok.model, _byte_alphabet()
        self.new, self.old = {"": b""}, {}

    def _part(self, word: str) -> bytes:
        """Ids of one word or run of marks, as little-endian 32-bit integers (a third of a tuple's memory)."""
        got = self.new.get(word)
        if got is None:
            got = self.old.get(word)
            if got is None:
                shown = word if word.isascii() else "".join(self.alphabet[b] for b in word.encode())
                tokens = self.model.tokenize(shown)
                got = pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            if len(self.new) >= _CACHE_ENTRIES:
                self.old, self.new = self.new, {"": b""}
            self.new[word] = got
        return got

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = pc.dictionary_encode(pc.list_flatten(lists))
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        pieces = coded.dictionary
        simple = pc.match_substring_regex(pieces, _SIMPLE)
        words = pc.dictionary_encode(pc.if_else(simple, pc.utf8_rtrim(pc.utf8_lower(pieces), _MARKS), ""))
        marks = pc.dictionary_encode(pc.if_else(simple, pc.replace_substring_regex(pieces, f"^{_LETTERS}", ""), ""))
        other = pieces.filter(pc.invert(simple)).to_pylist()
        # Parts: the different words, the different marks, the other pieces, the empty part. A piece is two of them.
        parts = [self._part(w) for w in words.dictionary.to_pylist()] + [self._part(m) for m in marks.dictionary.to_pylist()]
        first_other = len(parts)
        parts += [np.asarray(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(other, add_special_tokens=False)] if other else []
        parts.append(b"")
        plain = simple.to_numpy(zero_copy_only=False)
        head = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        tail = marks.indices.to_numpy(zero_copy_only=False).astype(np.int64) + len(words.dictionary)
        head[~plain] = first_other + np.arange(len(other))
        tail[~plain] = len(parts) - 1
        n_ids = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<i4")
        first = np.cumsum(n_ids) - n_ids
        which = coded.indices.to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        start = 0
        while start < len(texts):  # assembled a slice of texts at a time, so the index arrays stay small
            end = max(start + 1, int(np.searchsorted(cuts, cuts[start] + _SLICE_PIECES, side="right")) - 1)
            seen = which[cuts[start]: cuts[end]]
            part = np.stack([head[seen], tail[seen]], axis=1).ravel()
            counts = n_ids[part]
            at = np.concatenate([[0], np.cumsum(counts)])
            ids = flat[np.repeat(first[part] - at[:-1], counts) + np.arange(at[-1])]
            yield ids, np.diff(at[2 * (cuts[start: end + 1] - cuts[start])])
            start = end


def encode_segments(docs: DataFrame, tokenizer_name: str = "word_bpe_49k.json", end_id: int = END_ID,
                    percentile: float = PERCENTILE, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """One row per PFOR segment, in ascending doc_id order over (part, segment)."""
    small_batches(docs.sparkSession, 4000)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, segment = TaskContext.get().partitionId(), 0
        kept = worker_state()
        ids, lengths, doc_ids, held = [], [], [], 0

        def emit():
            nonlocal segment, held
            all_ids, all_len = np.concatenate(ids), np.concatenate(lengths)
            names = pa.concat_arrays(doc_ids)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(all_len)], pa.int64()), pa.array([len(all_ids)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), pa.array([pack_segment(all_ids, all_len, percentile, end_id)], pa.binary())],
                names=["part", "segment", "n_docs", "n_tokens", "doc_ids", "payload"])
            ids.clear(), lengths.clear(), doc_ids.clear()
            segment, held = segment + 1, 0
            return row

        for batch in batches:
            for chunk in text_chunks(batch, chars=10_000_000):
                if tokenizer_name not in kept:
                    kept[tokenizer_name] = _Encoder(tokenizer_name)
                names = chunk.column("doc_id").cast(pa.int64())
                done = 0
                for got, n in kept[tokenizer_name].encode(chunk.column("text")):
                    with_end = np.insert(got, np.cumsum(n), end_id)
                    ids.append(with_end), lengths.append(n + 1), doc_ids.append(names.slice(done, len(n)))
                    done, held = done + len(n), held + len(with_end)
                    if held >= segment_tokens:
                        yield emit()
        if held:
            yield emit()

    return ordered.mapInArrow(encode, SEGMENT_SCHEMA)


def write_segments(docs: DataFrame, path: str, **options) -> None:
    encode_segments(docs, **options).write.mode("overwrite").parquet(path)


def read_documents(segments: DataFrame, with_tokens: bool = False) -> DataFrame:
    """Decode stored segments: one row per document with its place, length and crc32 (and ids on request)."""
    schema = "part int, segment int, doc_no long, doc_id long, seg_start long, n_tokens long, ids_crc32 long" + (", token_ids array<int>" if with_tokens else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, n = unpack_segment(batch.column("payload")[i].as_py())
                stream = ids.astype("<u4")
                cuts = np.concatenate([[0], np.cumsum(n)])
                raw = memoryview(stream.tobytes())
                crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(cuts[:-1], cuts[1:])]
                names = batch.column("doc_ids")[i].values
                cols = [pa.array(np.full(len(n), batch.column("part")[i].as_py(), np.int32)), pa.array(np.full(len(n), batch.column("segment")[i].as_py(), np.int32)),
                        pa.array(np.arange(len(n))), names, pa.array(cuts[:-1]), pa.array(n), pa.array(crc, pa.int64())]
                if with_tokens:
                    cols.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in schema.split(", ")])

    docs = segments.select("part", "segment", "doc_ids", "payload").mapInArrow(decode, schema)
    # Token offsets: running sums over parts (one row per range partition), then within a part.
    index = segments.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n"))
    parts = index.groupBy("part").agg(F.sum("n").alias("pn"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("pn").over(before), F.lit(0)).alias("p0"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    index = index.withColumn("s0", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "segment", (F.col("p0") + F.col("s0")).alias("first"))
    return docs.join(index, ["part", "segment"]).withColumn("start", (F.col("first") + F.col("seg_start")).cast("long")).drop("first", "seg_start")


def token_blocks(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Encode ``docs``, write the segment files, read them back; one row per document."""
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/llm-pfor-{uuid.uuid4().hex}"
    write_segments(docs, path, **options)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    return read_documents(segments).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "segment", "doc_no")
