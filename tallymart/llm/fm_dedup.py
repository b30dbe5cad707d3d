"""Removal of repeated word sequences with a compressed FM-index per shard.

A shard holds the segments of some anchors (see ``repeats``). Its index is the
Burrows-Wheeler transform of their words in a wavelet matrix of packed bits.
The segments are streamed through it: backward search extends a match to the
left for as long as it occurs twice, which gives the matching statistics at its
right end, and every window inside a match of the threshold's length is
reported.

Edge cases: a null text has no words; a text with fewer words than the window
keeps them all; rows that repeat id and text are copies of each other; null ids
come last; an empty table gives an empty result. Only ``doc_id`` and
``text`` are read, so other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymart.llm.repeats import Ranges, Shard, Windows, covered, repeated_starts, runs_of, window_hashes
from tallymart.llm.text import split_words

WINDOWS = Windows(length=35, anchor=8, words=True)


class WaveletMatrix:
    """Rank over a sequence of small integers: one row of packed bits per binary digit."""

    def __init__(self, values: np.ndarray) -> None:
        self.digits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        for digit in range(self.digits - 1, -1, -1):
            bits = (values >> digit) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            counts = np.zeros(len(packed), np.int32)
            np.cumsum(np.bitwise_count(packed[:-1]), out=counts[1:])
            self.words.append(packed)
            self.before.append(counts)
            ones = bits.astype(bool)
            self.zeros.append(int(len(bits) - ones.sum()))
            values = np.concatenate([values[~ones], values[ones]])

    def ranks(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before ``low`` and before ``high``, above its first row."""
        base = np.zeros_like(low)
        rows = np.concatenate([base, low, high])
        n = len(low)
        for level, digit in enumerate(range(self.digits - 1, -1, -1)):
            word, bit = rows >> 6, (rows & 63).astype(np.uint64)
            own = self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
            ones = self.before[level][word] + np.bitwise_count(own)
            one = np.tile((symbol >> digit) & 1, 3).astype(bool)
            rows = np.where(one, self.zeros[level] + ones, rows - ones)
        return rows[n : 2 * n] - rows[:n], rows[2 * n :] - rows[:n]


class FMIndex:
    """Backward search over segments, each followed by the symbol 0; matches are at most ``depth`` long."""

    def __init__(self, symbols: np.ndarray, depth: int) -> None:
        n = len(symbols)
        rank = symbols.astype(np.int64)
        span = 1
        order = np.argsort(rank, kind="stable")
        while span < depth:  # order by twice as many symbols
            after = np.zeros(n, np.int64)
            after[: max(0, n - span)] = rank[span:] + 1
            both = rank * (int(after.max(initial=0)) + 1) + after
            order = np.argsort(both, kind="stable")
            new = np.ones(n, bool)
            new[1:] = both[order[1:]] != both[order[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            span *= 2
        self.suffixes = order
        self.wavelet = WaveletMatrix(symbols[order - 1])
        counts = np.bincount(symbols, minlength=int(symbols.max()) + 1 if n else 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the matches with ``symbol`` put before them."""
        below, upto = self.wavelet.ranks(symbol, low, high)
        return self.first[symbol] + below, self.first[symbol] + upto


def repeated_windows(symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Of each place in ``symbols``, whether a window that occurs twice starts there.

    ``weight`` holds the occurrences each segment stands for. All segments are
    searched in step; each search runs left from its end while the match counts
    twice, which is the matching statistic of that end.
    """
    index = FMIndex(symbols, int(sizes.max(initial=0)))
    place = np.repeat(weight, sizes + 1)
    sums = np.concatenate([[0], np.cumsum(place[index.suffixes])])
    out = np.zeros(len(symbols), bool)
    begin, end = first.copy(), first + sizes - 1  # of the segment, and the last word of the match
    low, high = np.zeros(len(first), np.int64), np.full(len(first), len(symbols))
    at = end.copy()  # the next word to put before the match
    while len(begin):
        new_low, new_high = index.extend(symbols[at], low, high)
        twice = sums[new_high] - sums[new_low] >= 2
        out[at[twice & (end - at + 1 >= length)]] = True
        # A match that ends here settles every window that starts in it and every window with
        # its end and an earlier start; the next to look for ends before both.
        end = np.where(twice, end, np.minimum(end - 1, at + length - 1))
        low, high = np.where(twice, new_low, 0), np.where(twice, new_high, len(symbols))
        at = np.where(twice, at - 1, end)
        more = (at >= begin) & (end - length + 1 >= begin)
        begin, end, at, low, high = (x[more] for x in (begin, end, at, low, high))
    return out


def judge(shard: Shard, windows: Windows, ranges: Ranges) -> None:
    """Report every window that occurs twice in the shard, at each of its places."""
    length = windows.length
    data = np.frombuffer(b"".join(shard.segments), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in shard.segments])])
    texts = split_words(data, offsets)
    hashes, sizes = texts.word_hashes(), texts.counts
    _, numbers = np.unique(hashes, return_inverse=True)
    symbols = np.zeros(len(hashes) + len(sizes), np.int64)
    first = texts.first[:-1] + np.arange(len(sizes))
    symbols[np.arange(len(hashes)) + texts.owner] = numbers + 1
    weight = np.array([len(p) for p in shard.places])
    found = repeated_windows(symbols, first, sizes, weight, length)

    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    begin, end = runs_of(found, owner)
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        i = int(owner[a])
        ranges.add(shard.places[i], np.int64(a - first[i]), np.int64(b - first[i]))
    # Of a dealt key each distinct window is compared with those of its other shards.
    counts = np.where(shard.hot, sizes - length + 1, 0)
    own = np.repeat(np.arange(len(sizes)), counts)
    if len(own):
        within = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
        one, two = window_hashes(hashes, texts.first[own] + within, length)
        _, kept = np.unique(np.stack([one, two]), axis=1, return_index=True)
        ranges.add_open(shard.least[own[kept]], within[kept], one[kept], two[kept])


def remove_repeated_words(docs: DataFrame, windows: Windows = WINDOWS, shard: int | None = None) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (words joined by spaces) and ``kept_sha256``.

    Removed is every word covered by a window whose words also start elsewhere,
    in another row or in the same one.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in names[1:]]
            columns = (batch.column(i) for i in (1, 2, 3))
            for text, copies, spans in zip(*columns, strict=True):
                words = text.as_py().encode().split()
                n = len(words)
                if copies.as_py() != 1 and n >= windows.length:
                    kept: list[bytes] = []
                else:
                    at, kept = 0, []
                    for a, b in covered(n, spans.as_py() or [], windows.length):
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                joined = b" ".join(kept)
                result = (n, n - len(kept), joined.decode(), hashlib.sha256(joined).hexdigest())
                for column, value in zip(rows, result, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 2 + [pa.string()] * 2
            made = [pa.array(r, t) for r, t in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names)

    found = repeated_starts(docs, windows, judge, keep_first=False, **({"shard": shard} if shard else {}))
    return found.mapInArrow(cut, f"doc_id {id_type}, n_words long, n_removed long, kept string, kept_sha256 string")
