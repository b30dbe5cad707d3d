"""Removal of repeated byte strings with suffixes in deep-shallow order.

A shard holds the segments of some anchors (see ``repeats``). Their windows, the
suffixes cut at the window length, are ordered as deep-shallow sorting does:
multikey quicksort on characters of eight bytes to a shallow depth, and blind
tries for the groups that still share a prefix. Equal neighbours are repeats.

Edge cases: a null text is empty; a text shorter than the window keeps all its
bytes; rows that repeat id and text are one document and get equal results; a
null ids come last; an empty table gives an empty result. Only
``doc_id`` and ``text`` are read, so other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymart.llm.repeats import Ranges, Shard, Windows, covered, repeated_starts, runs_of, window_hashes
from tallymart.llm.text import byte_values

SHALLOW = 32
WINDOWS = Windows(length=100, anchor=20, words=False)


class BlindTrie:
    """A trie of equally long strings that stores branching depths and characters only.

    Inserting descends blindly to some leaf, finds the common prefix with that
    leaf's string, and branches there; equal strings share a leaf.
    """

    def __init__(self, text: bytes, value: int) -> None:
        self.root: list = [None, text, [value]]  # a leaf; an inner node is [depth, {character: node}]

    def insert(self, text: bytes, value: int) -> None:
        node = self.root
        while node[0] is not None:
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        other = node[1]
        if other == text:
            node[2].append(value)
            return
        depth = _common(other, text)
        holder, slot, node = self, "root", self.root
        while node[0] is not None and node[0] < depth:
            holder, slot = node[1], text[node[0]]
            node = holder[slot]
        leaf = [None, text, [value]]
        if node[0] == depth:
            node[1][text[depth]] = leaf
            return
        branch = [depth, {other[depth]: node, text[depth]: leaf}]
        if holder is self:
            self.root = branch
        else:
            holder[slot] = branch

    def groups(self) -> Iterator[list[int]]:
        """The values of each distinct string, in the order of the strings."""
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node[0] is None:
                yield node[2]
            else:
                todo.extend(node[1][c] for c in sorted(node[1], reverse=True))


def _common(a: bytes, b: bytes) -> int:
    low, high = 0, len(a)
    while high - low > 1:
        mid = (low + high) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid
    return low


def _shallow_groups(data: np.ndarray, starts: np.ndarray, key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that share their key and first ``depth`` bytes with another one, and their group.

    Multikey quicksort on a character of eight bytes at a time: each round orders
    the groups still tied by the next character and leaves those tied again.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data),), ">u8", buffer=padded.tobytes(), strides=(1,))
    order, group = np.arange(len(starts)), key.copy()
    for at in range(0, depth, 8):
        character = eight[starts[order] + at].astype(np.uint64)
        by = np.lexsort((character, group))
        order, group, character = order[by], group[by], character[by]
        new = np.ones(len(order), bool)
        new[1:] = (group[1:] != group[:-1]) | (character[1:] != character[:-1])
        number = np.cumsum(new)
        tied = np.bincount(number)[number] > 1
        order, group = order[tied], number[tied]
        if not len(order):
            break
    return order, group


def equal_windows(data: np.ndarray, starts: np.ndarray, key: np.ndarray, length: int, shallow: int = SHALLOW) -> np.ndarray:
    """A number for each window, equal for equal windows of one key."""
    run = np.arange(len(starts))
    order, group = _shallow_groups(data, starts, key, min(shallow, length) // 8 * 8)
    if not len(order):
        return run
    # The first of each group is the first leaf of its trie; what equals it joins that leaf at once.
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(begin, len(order)))
    leader = np.repeat(order[begin], sizes)
    equal = np.ones(len(order), bool)
    eight = np.ndarray((len(data) - 7,), ">u8", buffer=data, strides=(1,))
    own, other = starts[order], starts[leader]
    for at in range(0, length, 8):
        at = min(at, length - 8)
        equal &= eight[own + at] == eight[other + at]
    run[order[equal]] = leader[equal]
    text = data.tobytes()
    left = np.flatnonzero(~equal)
    at = 0
    while at < len(left):
        end = at
        own = group[left[at]]
        while end < len(left) and group[left[end]] == own:
            end += 1
        head = int(leader[left[at]])
        trie = BlindTrie(text[starts[head] : starts[head] + length], head)
        for i in order[left[at:end]].tolist():
            trie.insert(text[starts[i] : starts[i] + length], i)
        for same in trie.groups():
            run[same] = same[0]
        at = end
    return run


def judge(shard: Shard, windows: Windows, ranges: Ranges) -> None:
    """Report every window with an earlier occurrence in the shard."""
    length = windows.length
    sizes = np.array([len(s) for s in shard.segments])
    data = np.frombuffer(b"".join(shard.segments), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + within
    least = shard.least
    later = [places[1:] for places in shard.places if len(places) > 1]
    if later:
        last = np.repeat([n - 1 for n, places in zip(counts, shard.places, strict=True) if len(places) > 1], list(map(len, later)))
        ranges.add(np.concatenate(later), np.int64(0), last)

    run = equal_windows(data, starts, shard.key[owner], length)
    order = np.lexsort((least[owner, 2] + within, least[owner, 1], least[owner, 0], run))
    new = np.ones(len(order), bool)
    new[1:] = run[order[1:]] != run[order[:-1]]
    earliest = np.zeros(len(order), bool)
    earliest[order[new]] = True
    begin, end = runs_of(~earliest, owner)
    ranges.add(least[owner[begin]], within[begin], within[end])
    open_ = np.flatnonzero(earliest & shard.hot[owner])
    if len(open_):
        one, two = window_hashes(byte_values(data), starts[open_], length)
        ranges.add_open(least[owner[open_]], within[open_], one, two)


def remove_repeats(docs: DataFrame, windows: Windows = WINDOWS, shard: int | None = None) -> DataFrame:
    """Per row ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` and ``kept_sha256``.

    Removed is every byte covered by a string of the window's length that also
    starts earlier in the corpus; ``kept`` holds the other bytes.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in names[1:]]
            columns = (batch.column(i) for i in (1, 2, 3))
            for text, copies, spans in zip(*columns, strict=True):
                data = text.as_py().encode()
                n = len(data)
                if copies.as_py() is None:
                    gone = [(0, n)] if n >= windows.length else []
                else:
                    gone = covered(n, spans.as_py() or [], windows.length)
                kept, at = data, 0
                if gone:
                    parts = []
                    for a, b in gone:
                        parts.append(data[at:a])
                        at = b
                    kept = b"".join([*parts, data[at:]])
                result = (n, n - len(kept), len(gone), kept, hashlib.sha256(kept).hexdigest())
                for column, value in zip(rows, result, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            made = [pa.array(r, t) for r, t in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names)

    found = repeated_starts(docs, windows, judge, keep_first=True, **({"shard": shard} if shard else {}))
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return found.mapInArrow(cut, schema)
