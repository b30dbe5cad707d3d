"""Benchmark decontamination with DataFrame functions only.

1. Shingles of five lower-cased words propose windows: a document window of an
   item's number of words that puts a shared shingle at its place in the item.
   A window with a similarity of 0.8 shares shingles, so none is missed.
2. Each window gets a 64-bit SimHash of its weighted shingles. Fingerprints are
   cut into ``RADIUS`` + 1 blocks; two within the radius agree in a whole block,
   so an equi-join on (item, block, value) finds every one of them.
3. The weighted Jaccard similarity (sum of the smaller over sum of the larger
   shingle counts) of what is within the radius decides, on the shingles
   themselves. Fingerprints of a pair at 0.8 differ in about 10 of 64 bits, more
   than 4 standard deviations below the radius.

Edge cases: null or empty texts and items have no words and match nothing; an
item or window with fewer than five words is one shingle; a document shorter
than the item is compared whole; rows that repeat id and text get equal results;
items that repeat count once; ties do not matter, as all matches count; empty
tables give an empty result or no match. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.storage import written

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
#: The most benchmark shingles that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

_KEY = ["_id", "_tid"]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def _starts(words: Column, n: Column) -> Column:
    """The numbers, from 0, of the words that start a run of ``n``; none if there are too few."""
    return F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))


def shingles(words: Column, n: Column) -> Column:
    return F.transform(_starts(words, n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))


def simhash(found: Column) -> Column:
    """64 bits: bit b is the sign of the summed bits b of the hashes of all shingles, repeats included."""
    hashes = F.transform(found, lambda s: F.xxhash64(s))

    def bit(b: Column) -> Column:
        total = F.aggregate(hashes, F.lit(0), lambda acc, h: acc + F.getbit(h, b).cast("int") * 2 - 1)
        return F.when(total > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x)
    )


def blocks(fingerprint: Column) -> Column:
    """(number, value) of each block; bit b belongs to block b modulo the number of blocks."""
    n = RADIUS + 1

    def block(k: int) -> Column:
        value = F.lit(0)
        for i, b in enumerate(range(k, 64, n)):
            value = value + F.getbit(fingerprint, F.lit(b)).cast("int") * (1 << i)
        return F.struct(F.lit(k).alias("block"), value.alias("value"))

    return F.array(*[block(k) for k in range(n)])


def weighted_jaccard(a: Column, b: Column) -> Column:
    def count(of: Column, x: Column) -> Column:
        return F.size(F.filter(of, lambda y: y == x))

    every = F.array_distinct(F.concat(a, b))
    least = F.aggregate(every, F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x)))
    # The counts of a and b add up to the smaller and the larger ones.
    most = F.size(a) + F.size(b) - least
    return F.when(most > 0, least / most).otherwise(F.lit(0.0))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Distinct items with words: ``_item``, ``item_id``, their size, shingles and fingerprint."""
    found = benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    n = F.least(F.lit(SHINGLE), F.size("words"))
    return (
        found.select(
            F.xxhash64("item_id", "words").alias("_item"),
            "item_id",
            F.size("words").alias("size"),
            n.alias("n"),
            shingles(F.col("words"), n).alias("item_shingles"),
        )
        .dropDuplicates(["_item"])
        .withColumn("item_hash", simhash(F.col("item_shingles")))
    )


def contaminated_windows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Windows with a similarity of 0.8 or more: ``_id``, ``_tid``, ``item_id``, ``start``, ``size``, ``similarity``."""
    # Read from a file in six places, so that none of their plans has the making of the items.
    items = written(benchmark_items(benchmark))
    texts = _keyed(docs).select(*_KEY, words_of(F.col("text")).alias("words"))
    grams = items.select("_item", "size", "n", F.posexplode("item_shingles").alias("place", "gram")).select(
        "_item", "size", "n", "place", F.xxhash64(F.split("gram", " ")).alias("h")
    )
    bounded = grams.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    small = (lambda df: F.broadcast(df)) if bounded else (lambda df: df)
    # Almost always only 5; shorter items add the lengths of their only shingle.
    lengths = sorted(r.n for r in items.select("n").distinct().collect()) or [SHINGLE]

    def spots_of(n: int) -> DataFrame:
        # The hash of an array of words is that of the words one by one, so no shingle is built here.
        hashes = F.transform(_starts(F.col("words"), F.lit(n)), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(n)]))
        return texts.select(*_KEY, F.posexplode(hashes).alias("at", "h"), F.lit(n).alias("n"))  # rows without the words

    spots = reduce(DataFrame.union, [spots_of(n) for n in lengths])
    proposed = (
        spots.join(small(grams), ["h", "n"])
        .select(*_KEY, "_item", "size", "n", F.greatest(F.lit(0), F.col("at") - F.col("place")).alias("start"))
        .distinct()
    )

    def within(w: Column) -> Column:
        """The window moved back to end with the text."""
        last = F.greatest(F.lit(0), F.size("words") - w["size"])
        return w.withField("start", F.least(last, w["start"]))

    # Written, so that its size is known before the texts are joined and each step runs once.
    per_text = written(
        proposed.groupBy(*_KEY).agg(F.collect_list(F.struct("_item", "size", "n", "start")).alias("windows"))
    )
    windows = written(
        _keyed(docs)
        .select(*_KEY, "text")
        .join(per_text, _KEY)
        .dropDuplicates(_KEY)
        .select(*_KEY, "windows", words_of(F.col("text")).alias("words"))
        .select(*_KEY, "words", F.explode(F.array_distinct(F.transform("windows", within))).alias("w"))
        .select(*_KEY, "w.*", F.slice("words", F.col("w.start") + 1, F.col("w.size")).alias("own"))
        .select(*_KEY, "_item", "size", "start", shingles(F.col("own"), F.least(F.col("n"), F.size("own"))).alias("own"))
        .withColumn("own_hash", simhash(F.col("own")))
    )
    index = items.select("_item", F.inline(blocks(F.col("item_hash"))))
    keys = [*_KEY, "_item", "start"]
    near = (
        windows.select(*keys, "own_hash", F.inline(blocks(F.col("own_hash"))))
        .join(small(index), ["_item", "block", "value"])
        .select(*keys, "own_hash")
        .distinct()
        .join(small(items.select("_item", "item_hash")), "_item")
        .where(F.bit_count(F.col("own_hash").bitwiseXOR(F.col("item_hash"))) <= RADIUS)
        .select(*keys)
    )
    return (
        windows.join(near, keys)
        .join(small(items.select("_item", "item_id", "item_shingles")), "_item")
        .withColumn("similarity", weighted_jaccard(F.col("own"), F.col("item_shingles")))
        .where(F.col("similarity") >= SIMILARITY)
        .select(*_KEY, "_item", "item_id", "start", "size", "similarity")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key that null and repeated ids share only with equal texts."""
    tid = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.withColumn("_tid", tid).withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.col("_tid")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``contaminated``, ``n_items``, ``items`` (ids, joined by commas) and the highest ``similarity``."""
    matched = (
        contaminated_windows(docs, benchmark)
        .groupBy(*_KEY)
        .agg(
            F.countDistinct("_item").alias("n_items"),
            F.array_join(F.sort_array(F.collect_set(F.col("item_id").cast("long"))), ",").alias("items"),
            F.max("similarity").alias("similarity"),
        )
    )
    return (
        _keyed(docs)
        .select("doc_id", *_KEY)
        .join(matched, _KEY, "left")
        .select(
            "doc_id",
            F.col("n_items").isNotNull().alias("contaminated"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items", F.lit("")).alias("items"),
            F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a contaminated window."""
    found = contaminated_windows(docs, benchmark).select(*_KEY).distinct()
    return _keyed(docs).join(found, _KEY, "left_anti").drop(*_KEY)
