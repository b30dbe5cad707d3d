"""Near-duplicate groups with fast similarity sketches, banding and exact verification.

A sketch has ``SIZE`` coordinates. In round i every shingle is hashed to one
coordinate, and a coordinate that is still empty keeps the least hash it gets;
after ``SIZE`` rounds round ``SIZE`` + j hashes all shingles to coordinate j, so
each coordinate fills. The share of equal coordinates estimates the similarity
with the concentration of independent hashes, at one hash per shingle for all
but short texts.

Texts with equal sets are one node. Nodes that agree in a whole band meet in a
bucket, and each bucket compares all its nodes with its least one: a number of
pairs linear in its size. Confirmed links make components. Only where nodes that
buckets connect still fall into several components is there more to find: each
node outside the largest component of such a group meets the others, block by
block, and those with near sketches are confirmed until they are joined. Every
link is confirmed on the full sets.

Rows of a band and the cut on the estimate follow from ``percent``: a pair at
that similarity misses all bands, or has an estimate below the cut, each with a
chance below ``MISS`` (binomial tail). At the pipeline's 0.80 that is 38 bands of
5 rows, missed with 3e-07, and a cut of 0.656, missed with 1e-06; at 0.85
32 bands of 6 rows (3e-07) and a cut of 0.719 (1e-06). More similar
pairs miss less.

Edge cases: a null or empty text, or one without words, has an empty set and is
linked with nothing; fewer words than a shingle are one shingle; rows that
repeat or tie are copies of each other; a null id comes after all others and
shows as a null ``component_id`` when it leads its group (real ids are below
2 ** 62); an empty table gives an empty result. Only ``doc_id`` and ``text`` are
read. Sets are told apart by a 64-bit hash of the whole set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.graph import components
from tallymart.llm.storage import written
from tallymart.llm.text import Texts, each_piece, mix, salted, shingle_hashes

SIZE, ROWS = 192, 6
MISS = 2e-6
BLOCK = 256
_NULL_ID = 1 << 62
_FULL = ~np.uint64(0)


def band_rows(percent: int) -> int:
    """The most rows of a band, up to ``ROWS``, with which pairs at ``percent`` miss all bands with a chance below ``MISS``."""
    share = percent / 100
    return max((r for r in range(1, ROWS + 1) if (1 - share**r) ** (SIZE // r) < MISS), default=1)


def least_share(percent: int) -> float:
    """The largest share of equal coordinates that pairs at ``percent`` fall below with a chance below ``MISS``."""
    share, below, equal = percent / 100, 0.0, 0
    while equal < SIZE and (below := below + comb(SIZE, equal) * share**equal * (1 - share) ** (SIZE - equal)) < MISS:
        equal += 1
    return equal / SIZE


def shingle_sets(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, text by text in order, and how many each has."""
    words, owner = texts.word_hashes(lower=True), texts.owner
    found = shingle_hashes(words, n)
    whole = np.flatnonzero(owner[: len(found)] == owner[n - 1 :]) if len(found) else np.zeros(0, np.int64)
    parts, owners = [found[whole]], [owner[whole]]
    counts = texts.counts
    for size in range(1, n):  # texts too short for one shingle
        short = np.flatnonzero(counts == size)
        total = np.full(len(short), size, np.uint64)
        for k in range(size):
            total = mix(total * np.uint64(31) + words[texts.first[short] + k])
        parts.append(total)
        owners.append(short)
    elements, owners = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((elements, owners))
    elements, owners = elements[order], owners[order]
    new = np.ones(len(order), bool)
    new[1:] = (elements[1:] != elements[:-1]) | (owners[1:] != owners[:-1])
    return elements[new], np.bincount(owners[new], minlength=len(counts)).astype(np.int64)


def sketches(elements: np.ndarray, counts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """A row of ``size`` coordinates per set; rows of empty sets stay full."""
    n = len(counts)
    table = np.full((n, size), _FULL, np.uint64)
    flat = table.reshape(-1)
    owner = np.repeat(np.arange(n), counts)
    active = elements
    for i in range(size):
        if not len(active):
            return table
        hashes = salted(active, i)
        cells = owner * size + ((hashes >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
        values = mix(hashes) >> np.uint64(1)
        empty = flat[cells] == _FULL
        cells, values = cells[empty], values[empty]
        np.minimum.at(flat, cells, values)
        open_ = (table == _FULL).any(axis=1)
        more = open_[owner]
        active, owner = active[more], owner[more]
    for j in range(size):
        if not len(active):
            break
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        least = np.minimum.reduceat(mix(salted(active, size + j)) >> np.uint64(1), starts)
        rows = owner[starts]
        table[rows, j] = np.where(table[rows, j] == _FULL, least, table[rows, j])
    return table


def _keyed(docs: DataFrame) -> DataFrame:
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    tid = F.xxhash64("text")
    spread = tid.bitwiseAND(F.lit(_NULL_ID - 1)).bitwiseOR(F.lit(_NULL_ID))
    return text.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), spread)).withColumn("_tid", tid)


def _sketch_rows(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, nodes, rows = [], [], []
        for _, _, texts in each_piece(batch.column(0)):
            elements, counts = shingle_sets(texts, shingle)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements))])
            ends = np.cumsum(counts)
            nodes.append(mix(sums[ends] - sums[ends - counts] + counts.astype(np.uint64)).view(np.int64))
            n.append(counts)
            table = sketches(elements, counts).astype(np.uint16)
            rows.extend(row.tobytes() if c else b"" for row, c in zip(table, counts, strict=True))
        n = np.concatenate([*n, np.zeros(0, np.int64)])
        nodes = np.concatenate([*nodes, np.zeros(0, np.int64)])
        columns = [pa.array(n), pa.array(nodes), pa.array(rows, pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], ["_id", "_tid", "n", "node", "sketch"])


def _set_rows(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[bytes] = []
        for _, _, texts in each_piece(batch.column(1)):
            elements, counts = shingle_sets(texts, shingle)
            ends = np.cumsum(counts)
            rows.extend(elements[e - c : e].tobytes() for e, c in zip(ends.tolist(), counts.tolist(), strict=True))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["node", "elements"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _exact_rows(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = [
            _similar(np.frombuffer(one.as_py(), np.uint64), np.frombuffer(other.as_py(), np.uint64), percent)
            for one, other in zip(batch.column(2), batch.column(3), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [c.filter(pa.array(linked, pa.bool_())) for c in batch.columns[:2]], ["a", "b"]
        )


def _estimate_rows(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(-1, SIZE) for c in batch.columns[2:4])
        near = pa.array((x == y).mean(axis=1) >= least_share(percent))
        yield pa.RecordBatch.from_arrays([c.filter(near) for c in batch.columns[:2]], ["a", "b"])


def _open_links(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows of side 0 with rows of side 1 that join different labels; rows come sorted by key."""
    held: list[tuple] = []
    last = None

    def links() -> pa.RecordBatch:
        one, two = [h for h in held if h[1] == 0], [h for h in held if h[1] == 1]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        found = []
        if one and two:
            table = np.frombuffer(b"".join(h[4] for h in two), np.uint16).reshape(-1, SIZE)
            sets = [np.frombuffer(h[5], np.uint64) for h in two]
            for _, _, node, label, sketch, elements in one:
                own = np.frombuffer(elements, np.uint64)
                near = (table == np.frombuffer(sketch, np.uint16)).mean(axis=1)
                for i in np.argsort(-near, kind="stable")[: int((near >= least_share(percent)).sum())].tolist():
                    if find(two[i][3]) != find(label) and _similar(own, sets[i], percent):
                        found.append((node, two[i][2]))
                        root[find(two[i][3])] = find(label)
        columns = list(zip(*found, strict=True)) if found else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != last and held:
                yield links()
                held = []
            last = row[0]
            held.append(row)
    if held:
        yield links()


def _linked(pairs: DataFrame, sketched: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose full sets are similar enough."""

    def with_both(found: DataFrame, of: DataFrame, name: str) -> DataFrame:
        one = of.select(F.col("node").alias("a"), F.col(name).alias("x"))
        two = of.select(F.col("node").alias("b"), F.col(name).alias("y"))
        return found.join(one, "a").join(two, "b").select("a", "b", "x", "y")

    near = with_both(pairs, sketched, "sketch").mapInArrow(partial(_estimate_rows, percent), "a long, b long")
    return with_both(near, sets, "elements").mapInArrow(partial(_exact_rows, percent), "a long, b long")


def _labelled(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per row ``_id``, ``_tid``, the number of shingles ``n`` and the ``label`` of its component, null without a word."""
    texts = _keyed(docs)
    rows = written(
        texts.select("text", "_id", "_tid").mapInArrow(
            partial(_sketch_rows, shingle), "_id long, _tid long, n long, node long, sketch binary"
        )
    )
    nodes = written(
        rows.where("n > 0")
        .groupBy("node")
        .agg(F.min("_id").alias("_id"), F.min_by("_tid", "_id").alias("_tid"), F.first("sketch").alias("sketch"))
    )
    size = band_rows(percent)
    width = 2 * size
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("sketch", k * width + 1, width)) for k in range(SIZE // size)])
    placed = nodes.select("node", F.explode(bands).alias("bucket"))
    # Grouped by one value and joined by another, so that a large bucket is split.
    other = F.bitwise_not("bucket").alias("other")
    buckets = (
        placed.groupBy("bucket")
        .agg(F.min("node").alias("least"), F.count("*").alias("members"))
        .where("members > 1")
        .select(other, "least")
    )
    star = written(
        placed.select(other, "node")
        .join(buckets, "other")
        .where("node != least")
        .select(F.col("least").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    groups = written(components(star).withColumnRenamed("label", "group"))
    chosen = nodes.join(groups.select("node"), "node").select("node", "_id", F.col("_tid").alias("_other"))
    sets = written(
        texts.select("_id", "_tid", "text")
        .join(chosen.hint("shuffle_hash"), "_id")
        .where("_tid = _other")
        .select("node", "text")
        .mapInArrow(partial(_set_rows, shingle), "node long, elements binary")
        .dropDuplicates(["node"])
    )
    links = written(_linked(star, nodes, sets, percent))
    labels = components(links)

    # Groups of buckets that still hold several components: every node outside the largest one
    # meets all others of its group, block by block.
    grouped = written(
        groups.join(labels, "node", "left").select("node", "group", F.coalesce("label", "node").alias("label"))
    )
    flipped = F.bitwise_not("group").alias("flipped")
    open_groups = written(
        grouped.groupBy("group", "label")
        .agg(F.count("*").alias("n"))
        .groupBy("group")
        .agg(F.max_by("label", "n").alias("main"), F.max("n").alias("largest"), F.sum("n").alias("members"))
        .where("members > 2 and members > largest")
        .select(
            flipped, "main", F.ceil(F.col("members") / BLOCK).alias("right"),
            F.ceil((F.col("members") - F.col("largest")) / BLOCK).alias("left"),
        )
    )
    if not open_groups.isEmpty():  # else nothing is joined for them
        whole = (
            grouped.select(flipped, "node", "label")
            .join(open_groups, "flipped")
            .join(nodes.select("node", "sketch"), "node")
            .join(sets, "node")
        )

        def dealt(side: int, own: str, others: str) -> DataFrame:
            block = F.pmod(F.xxhash64("node"), F.col(own))
            pair = (lambda i: (block, i)) if side == 0 else (lambda i: (i, block))
            keys = F.transform(F.sequence(F.lit(0).cast("long"), F.col(others) - 1), lambda i: F.xxhash64("flipped", *pair(i)))
            rows_of = whole.where("label != main") if side == 0 else whole
            return rows_of.select(
                F.explode(keys).alias("key"), F.lit(side).cast("long").alias("side"), "node", "label", "sketch", "elements"
            )

        more = written(
            dealt(0, "left", "right")
            .union(dealt(1, "right", "left"))
            .repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(partial(_open_links, percent), "a long, b long")
        )
        if not more.isEmpty():
            labels = components(links.union(more))

    return rows.join(labels, "node", "left").select(
        "_id", "_tid", "n", F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("label")
    )


def groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``_id``, ``_tid`` and ``group`` of every text with a word: the least ``_id`` of its group of near-duplicates, and its label."""
    labelled = _labelled(docs, shingle, percent).where("label is not null").select("_id", "_tid", "label")
    least = labelled.groupBy("label").agg(F.min("_id").alias("least"))
    flipped = F.bitwise_not("label").alias("flipped")  # joined by another value, so that a large group is split
    rows = labelled.distinct().select("_id", "_tid", "label", flipped)
    return rows.join(least.select(flipped, "least"), "flipped").select("_id", "_tid", F.struct("least", "label").alias("group"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``, and ``_id`` and ``_tid`` to join rows by.

    Texts are linked when 100 * intersection >= ``percent`` * union of their
    shingle sets; ``component_id`` is the least id reachable.
    """
    labelled = _labelled(docs, shingle, percent)
    least = labelled.where("label is not null").groupBy("label").agg(F.min("_id").alias("least"))
    flipped = F.bitwise_not("label").alias("flipped")
    grouped = labelled.select("_id", "_tid", "n", flipped).join(least.select(flipped, "least"), "flipped", "left")
    leader = F.coalesce("least", "_id")
    return grouped.select(
        F.when(F.col("_id") < _NULL_ID, F.col("_id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(leader < _NULL_ID, leader).alias("component_id"),
        (F.col("_id") == leader).alias("kept"),
        "_id",
        "_tid",
    )


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without the near-duplicates of a row with a smaller id.

    Rows that repeat id and text are one document, of which one row is kept.
    """
    kept = near_duplicates(docs, shingle, percent).where("kept").select("_id", "_tid").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("_tid", F.xxhash64(text))
    spread = F.col("_tid").bitwiseAND(F.lit(_NULL_ID - 1)).bitwiseOR(F.lit(_NULL_ID))
    keyed = keyed.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), spread))
    return keyed.join(kept, ["_id", "_tid"]).dropDuplicates(["_id", "_tid"]).drop("_id", "_tid")
