"""How five filters overlap: what each removes alone, after others, and on average over all orders.

One pass of a byte transducer measures a text. Its tables give, for a state and
the class of the next byte, the next state and what the byte adds: the start or
the end of a word, a capital, a code point, a symbol. A byte that does not continue
a character leads to the same state from everywhere, so whole batches of texts go
through the tables at once, and only continuation bytes take up to three rounds
more. The word spans then go into a hash table of open addresses. A word counts
as met before only if its bytes equal those of the word in its place, whatever
their hashes are.

The filters, by letter: A too few words, B words that repeat, C too many
capitals, D symbols, E the text of a smaller id. The five outcomes of a document are bits of
a mask. Documents are counted by part, mask and labels, at most 128 rows a part, and
all figures of all 120 orders are bitwise sums over these counts.

E compares SHA-256 digests of whole texts: the smallest id of a digest, found with
partial sums, meets the documents by digest and id, so a text that a third
of all documents share is no group of one task.

Edge cases: a null text is empty, a null source the part ''. A null id is larger than
every other id, and equal ids are not smaller than one another: copies under one id
all pass E. Equal rows count as often as they are there. Labels of one id are joined
with or; a null label is no label. An empty table has no parts and gives no rows. Only
``doc_id``, ``source`` and ``text`` of documents are read. Bytes that are no UTF-8
count as a code point each. Memory follows a piece of about 2 MB of text, or the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.storage import written
from tallymart.llm.text import byte_column, mix, pieces

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2

#: The symbols of filter D.
SYMBOLS = "#$%&*|"

GAP, WORD, ONE_MORE, TWO_MORE, THREE_MORE = range(5)
SPACE, CAPITAL, SYMBOL, PLAIN, CONTINUED, LEAD_2, LEAD_3, LEAD_4 = range(8)
STARTS, STOPS, IS_CAPITAL, IS_POINT, IS_SYMBOL = (1 << k for k in range(5))


def _classes() -> np.ndarray:
    classes = np.full(256, PLAIN, np.uint8)
    classes[[0x20, *range(0x09, 0x0E)]] = SPACE
    classes[ord("A") : ord("Z") + 1] = CAPITAL
    classes[list(SYMBOLS.encode())] = SYMBOL
    classes[0x80:0xC0], classes[0xC0:0xE0], classes[0xE0:0xF0], classes[0xF0:] = CONTINUED, LEAD_2, LEAD_3, LEAD_4
    return classes


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The next state and the emitted bits by state and class."""
    following = np.full((5, 8), WORD, np.uint8)
    following[:, SPACE] = GAP
    following[:, LEAD_2], following[:, LEAD_3], following[:, LEAD_4] = ONE_MORE, TWO_MORE, THREE_MORE
    following[THREE_MORE, CONTINUED], following[TWO_MORE, CONTINUED] = TWO_MORE, ONE_MORE
    emitted = np.full((5, 8), IS_POINT, np.uint8)
    emitted[ONE_MORE:, CONTINUED] = 0
    emitted[:, CAPITAL] |= IS_CAPITAL
    emitted[:, SYMBOL] |= IS_SYMBOL
    emitted[GAP, SPACE + 1 :] |= STARTS
    emitted[WORD:, SPACE] |= STOPS
    return following, emitted


CLASS = _classes()
NEXT, EMIT = _tables()


def transduce(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What each byte emits; every text starts between words."""
    classes = CLASS[data]
    after = NEXT[WORD][classes]  # right but for continuation bytes
    heads = offsets[:-1][np.diff(offsets) > 0]

    def before(at: np.ndarray | slice) -> np.ndarray:
        own = np.empty_like(after)
        own[1:] = after[:-1]
        own[heads] = GAP
        return own[at]

    inner = np.flatnonzero(classes == CONTINUED)
    for _ in range(3 if len(inner) else 0):
        after[inner] = NEXT[before(inner), CONTINUED]
    return EMIT.ravel()[before(slice(None)) * np.uint8(8) + classes]


def per_text(bits: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of set ``bits`` in each text."""
    counts = np.zeros(len(offsets) - 1, np.int64)
    filled = np.diff(offsets) > 0
    if filled.any():
        counts[filled] = np.add.reduceat(bits, offsets[:-1][filled], dtype=np.int64)
    return counts


class WordTable:
    """The distinct words of each text, in one hash table of word numbers with linear probing."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> None:
        padded = np.append(data, np.zeros(8, np.uint8))
        self._eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        self.starts, self.lengths, self.owner = starts, ends - starts, owner
        self.hashes = mix(owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.lengths.astype(np.uint64))
        k, long = 0, np.arange(len(starts))
        while len(long):
            self.hashes[long] = mix(self.hashes[long] ^ self._chunk(long, k))
            k += 1
            long = long[self.lengths[long] > 8 * k]

    def _chunk(self, words: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 8 of words that are longer than 8k, zeros after their end."""
        bits = np.clip(64 - 8 * (self.lengths[words] - 8 * k), 0, 56).astype(np.uint64)
        chunk = self._eight[self.starts[words] + 8 * k]
        return (chunk << bits) >> bits

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words are of one text and have the same bytes."""
        same = (self.hashes[a] == self.hashes[b]) & (self.owner[a] == self.owner[b])
        same &= self.lengths[a] == self.lengths[b]
        k, at = 0, np.flatnonzero(same)
        while len(at):
            same[at] = self._chunk(a[at], k) == self._chunk(b[at], k)
            k += 1
            at = at[same[at] & (self.lengths[a[at]] > 8 * k)]
        return same

    def distinct(self) -> np.ndarray:
        """The number of one word of each set of equal ones."""
        size = 1 << max(4, int(2 * len(self.starts)).bit_length())
        table = np.full(size, -1, np.int64)
        pending, slots = np.arange(len(self.starts)), (self.hashes & np.uint64(size - 1)).astype(np.int64)
        while len(pending):
            free = table[slots] < 0
            table[slots[free]] = pending[free]
            met = table[slots]
            left = met != pending
            left[left] = ~self.equal(met[left], pending[left])
            pending, slots = pending[left], (slots[left] + 1) & (size - 1)
        return table[table >= 0]


def measures(column: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    """Words, distinct words, capitals, code points and symbols of each text, piece by piece."""
    data, offsets = byte_column(column)
    for at, end in pieces(offsets):
        own = offsets[at : end + 1] - offsets[at]
        text = data[offsets[at] : offsets[end]]
        emitted = transduce(text, own)
        starts = np.flatnonzero(emitted & STARTS)
        owner = np.searchsorted(own, starts, "right") - 1
        # a word ends at the space that stops it or with its text
        closes = np.zeros(len(text) + 1, bool)
        closes[:-1] = emitted & STOPS
        closes[own[1:]] = True
        closed = np.flatnonzero(closes)
        ends = closed[np.searchsorted(closed, starts, "right")]
        words = WordTable(text, starts, ends, owner)
        yield {
            "words": np.bincount(owner, minlength=end - at),
            "distinct": np.bincount(owner[words.distinct()], minlength=end - at),
            "capitals": per_text((emitted & IS_CAPITAL) > 0, own),
            "points": per_text((emitted & IS_POINT) > 0, own),
            "symbols": per_text((emitted & IS_SYMBOL) > 0, own),
        }


def _masks(column: pa.Array) -> np.ndarray:
    """The failures of A to D as bits 0 to 3."""
    masks = [np.zeros(0, np.int32)]
    for m in measures(column):
        failed = (
            m["words"] < MIN_WORDS,
            100 * m["distinct"] < MIN_DISTINCT_PERCENT * m["words"],
            100 * m["capitals"] > MAX_CAPITAL_PERCENT * m["points"],
            m["symbols"] > 0,
        )
        masks.append(sum(f.astype(np.int32) << k for k, f in enumerate(failed)))
    return np.concatenate(masks)


def failures(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, ``part``, ``mask`` with a bit for each filter that it fails."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            digests = [hashlib.sha256(t.as_buffer() if t.is_valid else b"").digest() for t in text]
            columns = [batch.column(0), batch.column(1), pa.array(_masks(text)), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "digest"])

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    rows = docs.select("doc_id", part, F.col("text").cast("string").cast("binary").alias("text"))
    rows = written(rows.mapInArrow(measured, f"doc_id {kind}, part string, mask int, digest binary"))
    first = rows.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("_first"))
    first = first.withColumn("_is_first", F.lit(True))
    own = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_first"))
    copy = F.when(F.col("_is_first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(first, own, "left").select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def patterns(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of each part and mask: ``n``, and of these ``good`` and ``toxic`` by their labels."""
    is_one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("long")), F.lit(0))
    own = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_labelled"))
    own = own.agg(is_one("quality").alias("_good"), is_one("toxic").alias("_toxic"))
    joined = failed.join(own, F.col("doc_id") == F.col("_labelled"), "left")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return joined.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), count("_good").alias("good"), count("_toxic").alias("toxic")
    )


def interactions(counted: DataFrame) -> DataFrame:
    """All figures of each part, order and step, from the counts of ``patterns``."""
    orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    rows = counted.withColumn("filter_order", F.explode(orders))
    rows = rows.select("*", F.posexplode(F.split("filter_order", "")).alias("_at", "_letter"))
    bit = lambda letter: F.expr(f"shiftleft(1, ascii({letter}) - {ord('A')})")
    earlier = F.expr(
        "aggregate(split(left(filter_order, _at), ''), 0, (m, x) -> if(x = '', m, m | "
        f"shiftleft(1, ascii(x) - {ord('A')})))"
    )
    rows = rows.withColumns({"_bit": bit("_letter"), "_before": earlier})
    fails, gone = F.expr("mask & _bit <> 0"), F.expr("mask & _before <> 0")
    total = lambda of, where: F.coalesce(F.sum(F.when(where, F.col(of))), F.lit(0)).cast("long")
    figures = rows.groupBy("part", "filter_order", "_at", "_letter").agg(
        total("n", ~fails & ~gone).alias("kept"),
        total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"),
        total("n", F.col("mask") == F.col("_bit")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"),
        total("toxic", fails & ~gone).alias("toxic_lost"),
    )
    over_orders = F.sum("removed").over(Window.partitionBy("part", "_letter"))
    return figures.select(
        "part",
        "filter_order",
        (F.col("_at") + 1).cast("int").alias("step"),
        *("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"),
        over_orders.cast("long").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interaction figures of the five filters over whole documents."""
    return interactions(patterns(failures(docs), labels))
