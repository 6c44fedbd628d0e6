"""Arrow-batched word tokenising and shingle hashing inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Everything that is neither a letter, a mark, a number nor an underscore separates words.
_SEPARATORS = r"[^\pL\pM\pN_]+"


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lower-cased words of every text: (offsets of n + 1, flat words). Null text: no words."""
    flat = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), _SEPARATORS, " ")
    lists = pc.split_pattern(pc.utf8_trim(flat, " "), " ")
    words = pc.list_flatten(lists)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(words, "").to_numpy(zero_copy_only=False)
    if blank.any():  # a text without words gives one empty string
        owner = np.repeat(np.arange(len(lengths)), lengths)
        lengths = lengths - np.bincount(owner[blank], minlength=len(lengths))
        words = words.filter(pa.array(~blank))
    return np.concatenate([[0], np.cumsum(lengths)]), words


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) on a uint64 array."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash for every word, computed once for each distinct word of the batch."""
    import xxhash

    if not len(words):
        return np.empty(0, np.uint64)
    coded = pc.dictionary_encode(words)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    per_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return per_word[coded.indices.to_numpy(zero_copy_only=False)]


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of every text.

    A text of fewer words (but at least one) has one shingle, all its words; one without words has none.
    """
    offsets, words = split_words(texts)
    codes = word_hashes(words)
    n = len(codes)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        part = np.zeros(n, np.uint64)
        part[: max(0, n - k)] = codes[k:]
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k + 1))
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a: b - width + 1]))
        elif b > a:
            h = np.uint64(0xA5A5A5A5)
            with np.errstate(over="ignore"):
                for c in codes[a:b]:
                    h = mix(np.array([h * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(77)]))[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def text_chunks(batch: pa.RecordBatch, column: str = "text", chars: int = 4_000_000):
    """Slices of a batch holding about ``chars`` bytes of text each, so memory does not follow row size."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, base + chars, side="right")))
        yield batch.slice(start, end - start)
        start = end
    pa.default_memory_pool().release_unused()  # workers are kept between tasks; what they hold back adds up


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    import sys
    import types

    return vars(sys.modules.setdefault("_riskframe_worker_state", types.ModuleType("_riskframe_worker_state")))
