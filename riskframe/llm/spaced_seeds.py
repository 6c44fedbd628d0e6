"""Benchmark decontamination by spaced seeds.

A mask such as ``1101011`` keeps the token positions marked 1 and ignores the rest, so a window
still hashes alike when an ignored token was replaced. Every window of every test item is hashed
under each mask; the windows of the training texts are looked up in those hashes, and around each
hit the test item and the text are compared token by token on the same diagonal. The overlap is
the segment with the most equal tokens among all that hold 80 % equal tokens or more, without the
replaced tokens at its ends. A text is contaminated by an item if the overlap has at least
``min_tokens`` equal tokens, or for a shorter item 80 % of all its tokens.

Items shorter than the longest mask are also looked up whole, each with one token left out in turn:
below ten tokens 80 % allow one replaced token. Items of fewer than ``SHORTEST`` words are not looked
up; single everyday words and phrases would match. Of longer items a mask may miss an overlap whose
replaced tokens lie on its kept positions everywhere.

Test items are taken in blocks of about ``block_tokens`` tokens; only one block (its words and
hashes) is sent to the tasks at a time, so what is broadcast is bounded whatever the test set's
size. Texts aren't shuffled: the lookup and the check run where the text is read.

Defined cases: null, empty and wordless texts are clean; test items without words are ignored;
repeated texts and items give a row for each; ties between overlaps go to the first position; an
empty table on either side gives no hits; other columns are ignored (``detect``) or passed
through (``remove``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches
from riskframe.llm.words import mix, split_words, text_chunks, word_hashes

MASKS = ("1101011", "1110111", "110010111", "1011000111")
MIN_TOKENS = 10
BLOCK_TOKENS = 1_000_000
SHORTEST = 5
_MISS = -4


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def _window_hashes(codes: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Hash of the kept positions of the window starting at each place (len(codes) - len(mask) + 1 of them)."""
    n = max(0, len(codes) - len(mask) + 1)
    h = np.full(n, np.uint64(salt + 1))
    for k in _offsets(mask):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + codes[k: k + n])
    return h


def build_index(items: list[tuple[int, str]], masks=MASKS) -> dict:
    """Lookup tables of one block of test items."""
    offsets, words = split_words(pa.array([t for _, t in items], pa.string()))
    codes = word_hashes(words)
    owner = np.repeat(np.arange(len(items)), np.diff(offsets))
    index = {"ids": np.array([i for i, _ in items], np.int64), "offsets": offsets, "codes": codes,
             "known": np.unique(codes), "masks": list(masks), "tables": []}
    lengths = np.diff(offsets)
    short = [n for n in np.unique(lengths).tolist() if SHORTEST <= n < max(map(len, masks), default=0)]
    index["masks"] += ["1" * k + "0" + "1" * (n - k - 1) for n in short for k in range(n)]
    for salt, mask in enumerate(index["masks"]):
        h = _window_hashes(codes, mask, salt)
        at = np.arange(len(h))
        whole = owner[at] == owner[at + len(mask) - 1] if len(h) else np.empty(0, bool)  # not across items
        if salt >= len(masks) and len(h):
            whole &= lengths[owner[at]] == len(mask)
        h, at = h[whole], at[whole]
        order = np.argsort(h, kind="stable")
        index["tables"].append((h[order], at[order], len(mask)))
    return index


def _best_segment(equal: np.ndarray) -> tuple[int, int, int]:
    """(first, length, equal tokens) of the segment with the most equal tokens among those of 80 % or more."""
    gain = np.concatenate([[0], np.cumsum(np.where(equal, 1, _MISS))])  # not less at the end than at the start: 80 %
    count = np.concatenate([[0], np.cumsum(equal)])
    first = np.searchsorted(-np.minimum.accumulate(gain), -gain)  # the earliest start for each end
    end = int(np.argmax(count - count[first]))
    kept = first[end] + np.flatnonzero(equal[first[end]: end])
    return (int(kept[0]), int(kept[-1] - kept[0] + 1), len(kept)) if len(kept) else (0, 0, 0)


def find_overlaps(texts: pa.Array, index: dict, min_tokens: int = MIN_TOKENS) -> list[tuple[int, int, int, int, int]]:
    """(text number, item number, first token, length, equal tokens): the best overlap of each text and item."""
    offsets, words = split_words(texts)
    codes = word_hashes(words)
    item_off, item_codes = index["offsets"], index["codes"]
    if not len(codes) or not len(item_codes):
        return []
    known = index["known"]
    slot = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    in_test = known[slot] == codes
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    found: set[tuple[int, int, int]] = set()
    for salt, (hashes, places, span) in enumerate(index["tables"]):
        n = len(codes) - span + 1
        if n <= 0 or not len(hashes):
            continue
        may = np.ones(n, bool)
        for k in _offsets(index["masks"][salt]):
            may &= in_test[k: k + n]
        at = np.flatnonzero(may & (text_of[:n] == text_of[span - 1:]))
        h = np.full(len(at), np.uint64(salt + 1))
        for k in _offsets(index["masks"][salt]):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + codes[at + k])
        lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        hit = np.flatnonzero(hi > lo)
        times = hi[hit] - lo[hit]
        pos = np.repeat(at[hit], times)
        place = places[np.repeat(lo[hit] - np.concatenate([[0], np.cumsum(times)])[:-1], times) + np.arange(times.sum())]
        item = np.searchsorted(item_off, place, "right") - 1
        found.update(zip(text_of[pos].tolist(), item.tolist(), (pos - place).tolist()))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, item, shift in sorted(found):
        a, b = int(item_off[item]), int(item_off[item + 1])
        lo, hi = max(a, int(offsets[text]) - shift), min(b, int(offsets[text + 1]) - shift)
        first, length, equal = _best_segment(item_codes[lo:hi] == codes[lo + shift: hi + shift])
        if equal >= min(min_tokens, -(-8 * (b - a) // 10)) and equal > best.get((text, item), (0, 0, -1))[2]:
            best[text, item] = (lo + shift + first - int(offsets[text]), length, equal)
    return [(t, i, *v) for (t, i), v in best.items()]


def test_blocks(tests: DataFrame, block_tokens: int = BLOCK_TOKENS):
    """Test items in blocks of about ``block_tokens`` words, each collected on its own."""
    items = tests.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    n_words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n_blocks = max(1, -(-n_words // block_tokens))
    for b in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b)
        rows = [(-1 if r.item_id is None else r.item_id, r.text) for r in part.collect()]
        if rows:
            yield sorted(rows)


def detect(docs: DataFrame, tests: DataFrame, min_tokens: int = MIN_TOKENS, masks=MASKS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows (doc_id, item_id, first_token, n_tokens, n_equal): the best overlap of every contaminated text and item."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = "doc_id long, item_id long, first_token long, n_tokens long, n_equal long"
    out = None
    for rows in test_blocks(tests, block_tokens):
        shared = spark.sparkContext.broadcast(build_index(rows, masks))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for chunk in text_chunks(batch):
                    hits = find_overlaps(chunk.column("text"), index, min_tokens)
                    if hits:
                        ids = chunk.column("doc_id").to_pylist()
                        got = [(ids[t], int(index["ids"][i]), f, n, e) for t, i, f, n, e in hits]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)], names=["doc_id", "item_id", "first_token", "n_tokens", "n_equal"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def remove(docs: DataFrame, tests: DataFrame, min_tokens: int = MIN_TOKENS, masks=MASKS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``docs`` without its contaminated texts, all columns kept."""
    spark = docs.sparkSession
    small_batches(spark)
    for rows in test_blocks(tests, block_tokens):
        shared = spark.sparkContext.broadcast(build_index(rows, masks))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in text_chunks(batch):
                    clean = np.ones(chunk.num_rows, bool)
                    for hit in find_overlaps(chunk.column("text"), shared.value, min_tokens):
                        clean[hit[0]] = False
                    yield chunk.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
