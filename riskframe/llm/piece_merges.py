"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch's normalised text is one flat byte array. It is cut into words wherever two neighbouring
bytes stand next to each other in no piece of the model, so no merge can cross a cut. Each
different word of the batch is encoded once: its characters become a flat array of symbols, and
every round finds the smallest pair rank of each word (a segmented minimum), merges its
occurrences from the left in all words at the same time, and compacts the arrays; words without a
pair leave. Within a word, a round stops after the first merge whose new neighbours rank no later
than the pair itself, because the sequential order would go on there. So the result equals merging
one best pair after another, ties to the left.

Characters without a piece become byte pieces. Decoding gathers the pieces' bytes from the ids and
drops the one white space that normalising put before the text.

Supported models: BPE with byte pieces, no unused or user-defined pieces.

Defined cases: null or empty text has the begin and end ids only and decodes to the empty string;
rows with repeated, tied or null doc ids are encoded one by one; an empty table gives an empty
result; other columns of the input are ignored; a text of any length is encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches
from riskframe.llm.words import text_chunks, worker_state

MODEL = "piece_bpe_32k.model"
_SPACE = "▁"  # how pieces write white space
_NONE = np.int32(np.iinfo(np.int32).max)  # the rank of two symbols that don't merge
_SLICE_WORDS = 1 << 16  # texts are assembled from their words' ids in slices of about so many words
_KEPT_WORDS, _KEPT_BYTES = 500_000, 16_000_000  # above either, a worker forgets the words of earlier batches


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of ``count`` items each, one range after the other."""
    total = int(count.sum())
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(total)


class PieceModel:
    """The tables of a model: symbols of characters, merges of symbol pairs, bytes of pieces."""

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.size = sp.get_piece_size()
        ids = range(self.size)
        byte = {i: int(sp.id_to_piece(i)[1:-1], 16) for i in ids if sp.is_byte(i)}
        if len(byte) != 256 or any(map(sp.is_unused, ids)):
            raise ValueError("the model must have all byte pieces and no unused pieces")
        plain = {sp.id_to_piece(i).replace(_SPACE, " "): i for i in ids if not (i in byte or sp.is_control(i) or sp.is_unknown(i))}
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.byte_ids = np.zeros(256, np.int64)
        self.byte_ids[list(byte.values())] = list(byte)

        # Symbols: pieces, then characters that stand in pieces without being one, then all other characters.
        symbol = dict(plain)
        for c in sorted({c for p in plain for c in p} - plain.keys()):
            symbol[c] = self.size + len(symbol) - len(plain)
        other = self.size + len(symbol) - len(plain)
        self.of_char = np.full(0x110000, other, np.int32)
        for s, i in symbol.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i

        scores = np.array([sp.get_score(i) for i in plain.values()])
        rank = dict(zip(plain, np.unique(-scores, return_inverse=True)[1].tolist()))
        splits = [(symbol[p[:k]], symbol[p[k:]], rank[p], i) for p, i in plain.items() for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        left, right, ranks, into = np.array(splits, np.int64).reshape(-1, 4).T
        self.base = other + 1
        keys = left * self.base + right
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(ranks[order], _NONE).astype(np.int32)
        self.into = np.append(into[order], 0).astype(np.int32)

        self.joined = np.zeros(1 << 16, bool)  # by two neighbouring bytes: they may lie in one piece, or in one character
        self.joined.reshape(256, 256)[:, 0x80:0xC0] = True
        for p in plain:
            raw = np.frombuffer(p.encode(), np.uint8).astype(np.int64)
            self.joined[raw[:-1] << 8 | raw[1:]] = True

        surfaces = [bytes([byte[i]]) if i in byte else b"" if sp.is_control(i) else sp.decode([i]).encode() if sp.is_unknown(i)
                    else sp.id_to_piece(i).replace(_SPACE, " ").encode() for i in ids]
        self.spaced = np.array([i not in byte and s.startswith(b" ") and not sp.is_unknown(i) for i, s in zip(ids, surfaces)])
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_size = np.array([len(s) for s in surfaces], np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.silent = np.array([sp.is_control(i) for i in ids])
        self.words, self.ids, self.n_ids = pa.array([], pa.binary()), np.empty(0, np.uint32), np.empty(0, np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of neighbouring symbols."""
        key = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, key)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], _NONE), self.into[at]

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the words' symbols; returns (symbol, index of its first character), in text order.

        ``word`` is the ascending number of the word that each symbol belongs to.
        """
        n = len(symbols)
        final = np.full(n, -1, np.int32)
        sym, at = symbols.astype(np.int32), np.arange(n)
        rank, into = np.full(n, _NONE, np.int32), np.zeros(n, np.int32)
        if n > 1:
            rank[:-1], into[:-1] = self._pairs(sym[:-1], sym[1:])
            rank[:-1][word[:-1] != word[1:]] = _NONE
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(sym)))
            if (least == _NONE).any():
                stay = np.repeat(least < _NONE, lengths)
                final[at[~stay]] = sym[~stay]
                sym, at, word, rank, into = sym[stay], at[stay], word[stay], rank[stay], into[stay]
                lengths, least = lengths[least < _NONE], least[least < _NONE]
                if not len(sym):
                    break
            # The pairs of the smallest rank; of overlapping ones, every other one from the left.
            pos = np.flatnonzero(rank == np.repeat(least, lengths))
            head = np.concatenate([[True], np.diff(pos) != 1])
            pos = pos[(pos - np.maximum.accumulate(np.where(head, pos, 0))) % 2 == 0]
            own, low, merged = word[pos], rank[pos], into[pos]
            # What the merged symbol makes with its neighbours.
            follows = np.concatenate([[False], np.diff(pos) == 2]) & np.concatenate([[False], own[1:] == own[:-1]])
            has_left = (pos > 0) & (word[pos - 1] == own)
            left = np.where(follows, np.concatenate([merged[:1], merged[:-1]]), sym[pos - 1])
            after = np.minimum(pos + 2, len(sym) - 1)
            has_right = (pos + 2 < len(sym)) & (word[after] == own)
            left_rank, left_into = self._pairs(left, merged)
            right_rank, right_into = self._pairs(merged, sym[after])
            left_rank[~has_left], right_rank[~has_right] = _NONE, _NONE
            # Each word goes up to its first merge after which another pair comes before the others of this rank.
            stops = np.minimum(left_rank, right_rank) <= low
            if stops.any():
                before = np.cumsum(stops) - stops
                first = np.concatenate([[True], own[1:] != own[:-1]])
                keep = before == np.maximum.accumulate(np.where(first, before, 0))
                pos, merged, follows, has_left = pos[keep], merged[keep], follows[keep], has_left[keep]
                left_rank, left_into, right_rank, right_into = left_rank[keep], left_into[keep], right_rank[keep], right_into[keep]
            sym[pos], rank[pos], into[pos] = merged, right_rank, right_into
            neighbour = np.where(follows, pos - 2, pos - 1)[has_left]
            rank[neighbour], into[neighbour] = left_rank[has_left], left_into[has_left]
            stay = np.ones(len(sym), bool)
            stay[pos + 1] = False
            sym, at, word, rank, into = sym[stay], at[stay], word[stay], rank[stay], into[stay]
        kept = np.flatnonzero(final >= 0)
        return final[kept], kept

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, ids per word)."""
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        raw = b"".join(words.to_pylist())
        octets = np.frombuffer(raw, np.uint8)
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        char_at = np.flatnonzero((octets & 0xC0) != 0x80)  # byte offsets of the characters
        word = np.repeat(np.arange(len(sizes)), sizes)[char_at]
        symbols, first = self.merge(self.of_char[codes], word)
        known = symbols < self.size
        width = np.diff(np.append(char_at, len(octets)))
        n_ids = np.where(known, 1, width[first])
        ids = np.repeat(symbols.astype(np.int64), n_ids)
        ids[np.repeat(~known, n_ids)] = self.byte_ids[octets[_ranges(char_at[first[~known]], n_ids[~known])]]
        return ids, np.bincount(word[first], n_ids, len(sizes)).astype(np.int64)

    def _look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of each word, ids, ids per place), over the words of earlier batches and the new ones."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        ids, n_ids = self._encode_words(new)
        place = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[at.is_null().to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
        ids, n_ids = np.concatenate([self.ids, ids.astype(np.uint32)]), np.concatenate([self.n_ids, n_ids])
        self.words, self.ids, self.n_ids = pa.concat_arrays([self.words, new]), ids, n_ids
        if len(self.words) > _KEPT_WORDS or self.words.nbytes > _KEPT_BYTES:  # only this batch's words stay
            self.words, self.ids, self.n_ids = words, ids[_ranges((np.cumsum(n_ids) - n_ids)[place], n_ids[place])], n_ids[place]
        return place, ids, n_ids

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Slices of (ids, ids per text) of the texts, with begin and end ids."""
        flat = [self.sp.normalize(t).replace(_SPACE, " ").encode() for t in texts]
        sizes = np.array([len(t) for t in flat], np.int64)
        raw = b"".join(flat)
        del flat
        octets = np.frombuffer(raw, np.uint8)
        starts = np.cumsum(sizes) - sizes
        cut = np.ones(len(octets), bool)
        if len(octets):
            cut[1:] = ~self.joined[octets[:-1].astype(np.uint16) << np.uint16(8) | octets[1:]]
            cut[starts[sizes > 0]] = True
        at = np.append(np.flatnonzero(cut), len(octets))
        words = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])
        coded = words.dictionary_encode()
        place, ids, n_ids = self._look_up(coded.dictionary)
        first_id = np.cumsum(n_ids) - n_ids
        which = place[coded.indices.to_numpy(zero_copy_only=False)]
        first_word = np.searchsorted(at, np.append(starts, len(octets)))
        done = 0
        while done < len(texts):
            end = max(done + 1, int(np.searchsorted(first_word, first_word[done] + _SLICE_WORDS, side="right")) - 1)
            part = which[first_word[done]: first_word[end]]
            counts = n_ids[part]
            body = ids[_ranges(first_id[part], counts)].astype(np.int64)
            cuts = np.concatenate([[0], np.cumsum(counts)])[first_word[done: end + 1] - first_word[done]]
            whole = np.insert(body, np.repeat(cuts, np.r_[1, np.full(end - done - 1, 2, int), 1]), np.tile([self.bos, self.eos], end - done))
            yield whole, np.diff(cuts) + 2
            done = end

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ``counts`` ids."""
        sizes = self.surface_size[ids]
        octets = self.surface[_ranges(self.surface_start[ids], sizes)]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(counts)
        heard = np.append(np.flatnonzero(~self.silent[ids]), len(ids))
        opening = heard[np.searchsorted(heard, ends - counts)]  # the first id of each text that isn't a control id
        drop = (opening < ends) & self.spaced[ids[np.minimum(opening, max(0, len(ids) - 1))]] if len(ids) else np.zeros(len(counts), bool)
        raw = memoryview(octets.tobytes())
        out = []
        for a, b, skip in zip((ends - counts).tolist(), ends.tolist(), drop.tolist()):
            try:
                out.append(str(raw[int(bounds[a]) + skip: int(bounds[b])], "utf-8"))
            except UnicodeDecodeError:  # ids whose bytes are no text
                out.append(self.sp.decode(ids[a:b].tolist()))
        return out


def _model(name: str) -> PieceModel:
    kept = worker_state()
    if ("pieces", name) not in kept:
        kept["pieces", name] = PieceModel(name)
    return kept["pieces", name]


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    cuts = np.concatenate([[0], np.cumsum(counts)]) * 4
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(values.astype("<u4").tobytes())])


def encode(docs: DataFrame, model: str = MODEL, with_decoded: bool = False) -> DataFrame:
    """Columns doc_id, ids (little-endian unsigned 32-bit integers), and with ``with_decoded`` the text that the ids decode to."""
    small_batches(docs.sparkSession, 2000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, chars=2_000_000):
                pieces, done = _model(model), 0
                for ids, counts in pieces.encode(pc.fill_null(chunk.column("text"), "").to_pylist()):
                    columns = [chunk.column("doc_id").slice(done, len(counts)), _binary(ids, counts)]
                    if with_decoded:
                        columns.append(pa.array(pieces.decode(ids, counts), pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])
                    done += len(counts)

    schema = "doc_id long, ids binary" + (", decoded string" if with_decoded else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """Columns doc_id, decoded of a table with doc_id and ids; null ids decode to the empty text."""
    small_batches(encoded.sparkSession, 2000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "ids"):
                raw = [x or b"" for x in chunk.column("ids").to_pylist()]
                texts = _model(model).decode(np.frombuffer(b"".join(raw), "<u4").astype(np.int64), np.array([len(x) // 4 for x in raw], np.int64))
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again in one pass."""
    both = encode(docs, model, with_decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
