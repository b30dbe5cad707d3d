"""Finding windows of a fixed length that occur more than once in a corpus.

Both substring operators share this frame and differ in the kernel that sorts or
indexes a shard:

1. Exact copies of a text are represented by their first row, so a group of
   copies costs one text, whatever its size.
2. Every window names its anchor, the least hashed run of ``anchor`` symbols in
   it (the leftmost of equals). Equal windows have equal anchors at the same
   place, so an anchor that occurs once rules out all windows it stands for.
   Only anchors are shuffled, about two for each window length.
3. Windows of repeated anchors travel as segments (a run of windows with one
   anchor), keyed by the anchor. Equal segments of a task travel once with the
   list of their places. An anchor with more than ``SHARD`` places is dealt over
   several shards, whose distinct windows are merged by a 128-bit hash in a last
   step; so no task meets more than ``SHARD`` segments of a key.
4. A kernel judges each shard and returns ranges of window starts per text.

Symbols are bytes or words. Texts are keyed by (id, 64-bit hash): rows that
repeat both are one document; null ids come after all others, which are below
2 ** 62.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.text import Texts, byte_values, each_piece, mix, range_hashes, salted

SHARD = 1_000
CHUNK = 4_000_000
_SLICE = 1 << 22
_PLACE_BITS = np.uint64(24)
_NULL_ID = 1 << 62
_KEY = ["_id", "_tid"]
FOUND = "_id long, _tid long, s long, e long, w1 long, w2 long, hot boolean"


@dataclass(frozen=True)
class Windows:
    """Windows of ``length`` symbols with anchors of ``anchor`` symbols."""

    length: int
    anchor: int
    words: bool

    def symbols(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of some texts and the number of each text's first one."""
        if self.words:
            return texts.word_hashes(), texts.first
        return byte_values(texts.data), texts.offsets

    def slices(self, texts: Texts, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte ranges of the windows that start from ``first`` to ``last``."""
        if self.words:
            return texts.starts[first], texts.ends[last + self.length - 1]
        return first, last + self.length


@dataclass
class Segments:
    """Runs of window starts with one anchor: first and last start, anchor, text."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    owner: np.ndarray


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from minima of aligned blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, ~np.uint64(0), np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchor_segments(symbols: np.ndarray, first: np.ndarray, windows: Windows) -> Segments:
    """The segments of some texts, whose symbols follow one another from ``first``."""
    width = windows.length - windows.anchor + 1
    parts: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(1, len(symbols) - windows.length + 1), _SLICE):
        part = symbols[at : at + _SLICE + windows.length - 1]
        if len(part) < windows.length:
            continue
        places = np.arange(len(part) - windows.anchor + 1)
        hashes = range_hashes(part, places, places + windows.anchor)
        ranked = ((hashes >> _PLACE_BITS) << _PLACE_BITS) | places.astype(np.uint64)
        least = (_window_minima(ranked, width) & np.uint64((1 << 24) - 1)).astype(np.int64)
        starts = np.arange(len(least)) + at
        owner = np.searchsorted(first, starts, "right") - 1
        inside = starts + windows.length <= first[owner + 1]
        starts, owner, least = starts[inside], owner[inside], least[inside]
        if not len(starts):
            continue
        new = np.ones(len(starts), bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(starts)) - 1
        parts.append((starts[begin], starts[end], hashes[least[begin]], owner[begin]))
    if not parts:
        empty = np.zeros(0, np.int64)
        return Segments(empty, empty, empty.astype(np.uint64), empty)
    return Segments(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def keyed_texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashed = docs.select("doc_id", text.alias("text")).withColumn("_tid", F.xxhash64("text"))
    # Null ids come last and differ by text, so that they are spread.
    spread = F.col("_tid").bitwiseAND(F.lit(_NULL_ID - 1)).bitwiseOR(F.lit(_NULL_ID))
    return hashed.select("text", "_tid", F.coalesce(F.col("doc_id").cast("long"), spread).alias("_id"))


def first_copies(texts: DataFrame) -> DataFrame:
    """The key of the first row of each distinct text, and how many rows have it."""
    return (
        texts.groupBy(F.sha2("text", 256).alias("_sha"))
        .agg(F.min("_id").alias("_id"), F.min("_tid").alias("_other"), F.count("*").alias("copies"))
        .drop("_sha")
    )


def _anchor_rows(windows: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for at, _, texts in each_piece(batch.column(2)):
                found = anchor_segments(*windows.symbols(texts), windows)
                order = np.lexsort((found.anchor, found.owner))
                anchor, owner = found.anchor[order], found.owner[order]
                new = np.ones(len(order), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
                begin = np.flatnonzero(new)
                n = np.diff(np.append(begin, len(order)))
                rows = owner[begin] + at
                columns = [anchor[begin].view(np.int64), ids[rows], n]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "_id", "n"])

    return run


def _segment_rows(windows: Windows, shard: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["key", "hot", "segment", "places"]

    def flush(found: dict) -> pa.RecordBatch:
        anchors = np.array([anchor for anchor, _ in found], np.uint64)
        totals = np.array([n for n, _ in found.values()], np.int64)
        ends = np.cumsum([len(own) for _, own in found.values()])
        places = np.array(list(chain.from_iterable(own for _, own in found.values())), np.int64)
        starts = np.append(0, ends[:-1])
        salts = -(-totals // shard)
        salt = mix(places[starts].view(np.uint64)) % salts.astype(np.uint64)
        offsets = pa.py_buffer((np.append(0, ends) * 8).astype(np.int32).tobytes())
        columns = [
            pa.array(salted(anchors, salt).view(np.int64)),
            pa.array(salts > 1),
            pa.array([segment for _, segment in found], pa.binary()),
            pa.Array.from_buffers(pa.binary(), len(found), [None, offsets, pa.py_buffer(places.tobytes())]),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, bytes], tuple[int, list[int]]] = {}
        size = 0
        for batch in batches:
            ids, tids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            hits = batch.column(3)
            hit_at = np.asarray(hits.offsets).astype(np.int64)
            inner = hits.flatten()
            hit_at = hit_at - hit_at[0]
            hit_anchor = np.asarray(inner.field(0)).view(np.uint64)
            hit_n = np.asarray(inner.field(1))
            for at, end, texts in each_piece(batch.column(2)):
                segments = anchor_segments(*windows.symbols(texts), windows)
                origin = texts.first if windows.words else texts.offsets
                own = slice(hit_at[at], hit_at[end])
                rows = np.repeat(np.arange(end - at), np.diff(hit_at[at : end + 1]))
                wanted = salted(hit_anchor[own], rows)
                order = np.argsort(wanted)
                wanted, counts = wanted[order], hit_n[own][order]
                mine = salted(segments.anchor, segments.owner)
                place = np.minimum(np.searchsorted(wanted, mine), max(0, len(wanted) - 1))
                chosen = np.flatnonzero(wanted[place] == mine) if len(wanted) else np.zeros(0, np.int64)
                data = texts.data.tobytes()
                owner, first = segments.owner[chosen], segments.first[chosen]
                columns = (
                    segments.anchor[chosen], *windows.slices(texts, first, segments.last[chosen]), counts[place[chosen]],
                    ids[at + owner], tids[at + owner], first - origin[owner],
                )
                for anchor, a, b, n, own_id, own_tid, start in zip(*(c.tolist() for c in columns), strict=True):
                    key = (anchor, data[a:b])
                    entry = found.get(key)
                    if entry is None:
                        entry = found[key] = (n, [])
                        size += b - a + 150
                    entry[1].extend((own_id, own_tid, start))
                    size += 100
                    if size > 4 * CHUNK:
                        yield flush(found)
                        found, size = {}, 0
        if found:
            yield flush(found)

    return run


@dataclass
class Shard:
    """Distinct segments of a few keys: owners' places and which keys are dealt over shards."""

    key: np.ndarray  # number of the key, for each segment
    hot: np.ndarray
    segments: list[bytes]
    places: list[np.ndarray]  # for each segment (id, tid, first start), least first
    least: np.ndarray  # the first place of each segment


def _shards(batches: Iterator[pa.RecordBatch], dealt: bool) -> Iterator[Shard]:
    """Whole keys, dealt ones or the others, some ``CHUNK`` bytes at a time; rows come sorted by key."""
    found: dict[tuple[int, bytes], list[bytes]] = {}
    hot_of: dict[int, bool] = {}
    size, last = 0, None

    def build() -> Shard:
        numbers = {k: i for i, k in enumerate(hot_of)}
        rows = np.frombuffer(b"".join(chain.from_iterable(found.values())), np.int64).reshape(-1, 3)
        counts = np.array([sum(map(len, own)) // 24 for own in found.values()])
        if len(rows) > len(counts):
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0], np.repeat(np.arange(len(counts)), counts)))]
        ends = np.cumsum(counts)
        return Shard(
            np.array([numbers[k] for k, _ in found], np.int64),
            np.array([hot_of[k] for k, _ in found], bool),
            [segment for _, segment in found],
            np.split(rows, ends[:-1]),
            rows[ends - counts],
        )

    for batch in batches:
        batch = batch.filter(pc.equal(batch.column(1), dealt))
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for key, hot, segment, places in zip(*columns, strict=True):
            if key != last and size > CHUNK:
                yield build()
                found, hot_of, size = {}, {}, 0
            last = key
            hot_of[key] = hot
            found.setdefault((key, segment), []).append(places)
            size += len(segment) + len(places) + 100
    if found:
        yield build()


def window_hashes(values: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each window."""
    one = range_hashes(values, starts, starts + length)
    two = range_hashes(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts, starts + length)
    return one.view(np.int64), two.view(np.int64)


@dataclass
class Ranges:
    """Result rows of a kernel, gathered column by column."""

    rows: list[tuple[np.ndarray, ...]]

    def add(self, place: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Window starts from ``first`` to ``last`` of a segment, at each of its places."""
        n = len(place)
        if n:
            begin, end = place[:, 2] + first, place[:, 2] + last
            self.rows.append((place[:, 0], place[:, 1], begin, end, place[:, 1], begin, np.zeros(n, bool)))

    def add_open(self, place: np.ndarray, starts: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """Distinct windows of a dealt key, to be compared with those of its other shards."""
        if len(place):
            begin = place[:, 2] + starts
            self.rows.append((place[:, 0], place[:, 1], begin, begin, one, two, np.ones(len(place), bool)))

    def batch(self) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*self.rows, strict=True)]
        kinds = [pa.int64()] * 6 + [pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["_id", "_tid", "s", "e", "w1", "w2", "hot"],
        )


def runs_of(flags: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of set flags that stays in one group."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (group[at[1:]] != group[at[:-1]])
    begin = np.flatnonzero(new)
    return at[begin], at[np.append(begin[1:], len(at)) - 1]


Kernel = Callable[[Shard, Windows, Ranges], None]


def repeated_starts(docs: DataFrame, windows: Windows, kernel: Kernel, keep_first: bool, shard: int = SHARD) -> DataFrame:
    """Every row of ``docs`` with the ranges of its repeated windows.

    Columns: ``doc_id``, ``text`` (null as empty), ``copies`` (rows with this
    text, null on copies after the first) and ``spans`` (array of first and last
    window start; null without any). With ``keep_first`` the earliest occurrence
    of a window is not reported, else all occurrences are.
    """
    texts = keyed_texts(docs)
    firsts = first_copies(texts).hint("shuffle_hash")

    def with_copies(how: str) -> DataFrame:
        # The texts meet every other side by ``_id`` alone, so that they are shuffled once.
        same_text = (texts["_id"] == firsts["_id"]) & (texts["_tid"] - firsts["_other"] == 0)
        return texts.join(firsts, same_text, how).drop(firsts["_id"]).drop("_other")

    distinct = with_copies("inner")
    rows = distinct.select(*_KEY, "text").mapInArrow(_anchor_rows(windows), "a long, _id long, n long")
    # The anchor travels under another value than its counts were grouped by, so both sides of
    # the join get a plain exchange and adaptive execution can split a frequent anchor.
    flipped = F.bitwise_not("a").alias("b")
    total = rows.groupBy("a").agg(F.sum("n").alias("total")).where("total > 1")
    hits = rows.select(flipped, "_id").join(total.select(flipped, "total"), "b")
    by_text = hits.groupBy("_id").agg(F.collect_list(F.struct(F.bitwise_not("b").alias("a"), "total")).alias("hits"))
    segments = (
        distinct.join(by_text.hint("shuffle_hash"), "_id")
        .select(*_KEY, "text", "hits")
        .mapInArrow(_segment_rows(windows, shard), "key long, hot boolean, segment binary, places binary")
    )
    shards = segments.repartition("key").sortWithinPartitions("key")

    def judge(dealt: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for own in _shards(batches, dealt):
                ranges = Ranges([])
                kernel(own, windows, ranges)
                if ranges.rows:
                    yield ranges.batch()

        return run

    # The shards are read twice, so that only the few windows of dealt anchors are shuffled again.
    whole = shards.mapInArrow(judge(False), FOUND).select(*_KEY, "s", "e")
    same = Window.partitionBy("w1", "w2")
    if keep_first:
        again = F.row_number().over(same.orderBy(*_KEY, "s")) > 1
    else:
        again = F.count("*").over(same) > 1
    dealt = (
        shards.mapInArrow(judge(True), FOUND)
        .withColumn("again", again)
        .where(~F.col("hot") | F.col("again"))
        .select(*_KEY, "s", "e")
    )
    spans = whole.union(dealt).groupBy("_id").agg(F.collect_list(F.struct("_tid", "s", "e")).alias("spans"))
    own = F.filter("spans", lambda x: x["_tid"] == F.col("_tid"))
    # The id is made from its key: with the same columns as above, the texts' shuffle is used again.
    doc_id = F.when(F.col("_id") < _NULL_ID, F.col("_id")).cast(docs.schema["doc_id"].dataType)
    return (
        with_copies("left")
        .join(spans.hint("shuffle_hash"), "_id", "left")
        .select(doc_id.alias("doc_id"), "text", "copies", own.alias("spans"))
    )


def covered(n: int, spans: list[dict], length: int) -> list[tuple[int, int]]:
    """The maximal runs of ``n`` symbols that windows starting in ``spans`` cover."""
    out: list[tuple[int, int]] = []
    for first, last in sorted((x["s"], x["e"]) for x in spans):
        end = min(n, last + length)
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out
