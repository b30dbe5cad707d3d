"""Mixing sources to target weights with DataFrame functions only.

The words of each source follow one another, document by document in the order of a hash,
and are packed into blocks of ``BLOCK`` words. The output has shards of ``SHARD``
slots. Each shard draws its source counts: every source gets the whole part of
its expected count, and a multinomial draw deals the other slots by the
remaining fractions, so totals stay near the targets. The j-th slot of a source
takes block ``permutation(j)``, a pseudorandom permutation of its block numbers
for each pass over the source (a Feistel network over a square that covers the
block numbers, walked until it lands on one), and the slots of a shard are permuted
the same way. Slots and blocks are joined by number, and a block is the spans of
words of the documents it was packed from. These spans are the mix, and what it takes
of a document is their sum. A source has at most three passes, so no document is taken more than
three times.

Edge cases: a null or empty text has no words, size 0 and nothing taken; a null
source is a source of its own, the last; rows that repeat id and text, and ties
in the order, are interchangeable; an empty table gives an empty result. Only
``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.storage import written

#: The repeating weights and the most passes over a source.
WEIGHTS = (5, 2, 1)
PASSES = 3
BLOCK = 16
SHARD = 1024
CELLS = 4096
#: About so many rows are in a chunk of the running word counts, and slots in a task of the draw.
CHUNK = 4096
TASK_SLOTS = 50_000
#: Steps of a walk. The square has at most 2 sqrt(n) + 1 numbers too many: a walk gets off them within
#: that many steps, or within these with all but a chance of (2 / sqrt(n)) ** WALK.
WALK = 16
#: The most sources that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
SEED = 20_231


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``size``: the words of the whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Every word but the last is followed by separators: count the starts of words.
    size = F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.cast("long").alias("size"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source its size, weight and target in words, from one row per source.

    One task sorts these rows of a few bytes: millions of sources are a small sort.

    Targets are min(3 * size, rate * weight) with the one rate that shares out
    all words: what passes over capped sources is reshared by weight.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    number = F.row_number().over(by_name) - 1
    numbered = per_source.withColumn("number", number).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    )
    cap = PASSES * F.col("source_size")
    ranked = numbered.withColumn("fill", cap / F.col("weight"))
    upto = Window.orderBy("fill", "number")
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    before = F.sum(cap).over(upto) - cap
    weights_left = F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight")
    # The rate if this and all sources with a larger fill were open. From the first source that
    # it does not fill on, rates fall, so the largest of those is the one that holds.
    rated = ranked.withColumn("rate", (total - before) / weights_left)
    open_rate = F.max(F.when(F.col("rate") <= F.col("fill"), F.col("rate"))).over(everything)
    rate = F.coalesce(open_rate, F.lit(math.inf))
    target = F.when(F.col("fill") < rate, cap.cast("double")).otherwise(rate * F.col("weight"))
    return rated.select("source", "number", "weight", "source_size", target.alias("target"))


def with_offsets(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``offset``, the words of the source before each document.

    Documents go by a hash of the id, whatever ids there are: running sums within chunks
    of hashes, and over the totals of chunks, so that a source with a third of all rows
    is not ordered in one task. One task meets a total per ``CHUNK`` rows of a source.
    """
    chunks = max(1, sizes.count() // CHUNK)
    chunk = F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks))
    chunked = sizes.withColumn("chunk", chunk)
    keys = ["source", "chunk"]
    inside = Window.partitionBy(*keys).orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        chunked.groupBy(*keys)
        .agg(F.sum("size").alias("words"))
        .withColumn("base", F.coalesce(F.sum("words").over(over), F.lit(0)))
        .drop("words")
    )
    within = chunked.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = [within[k].eqNullSafe(starts[k]) for k in keys]
    return within.join(starts, same).select(
        within["doc_id"], within["source"], within["size"], (within["within"] + starts["base"]).alias("offset")
    )


def permuted(x: str, n: str, key: Column, at: str, df: DataFrame) -> DataFrame:
    """``df`` with ``at``, the place of ``x`` in a pseudorandom permutation of 0 .. ``n`` - 1 that ``key`` chooses.

    Steps are columns of their own, so that each is taken once; few rows have to walk on after the first one.
    """
    side = F.greatest(F.lit(1).cast("long"), F.ceil(F.sqrt(F.col(n))).cast("long"))

    def network(at: Column) -> Column:
        # A fold over the rounds: written out, each round would hold the one before it twice.
        halves = F.struct(F.floor(at / F.col("_side")).cast("long").alias("a"), F.pmod(at, F.col("_side")).alias("b"))
        rounds = F.array(*[F.lit(SEED + r) for r in range(4)])
        return F.aggregate(
            rounds, halves,
            lambda x, seed: F.struct(x["b"].alias("a"), _turned(x["a"], x["b"], seed).alias("b")),
            lambda x: x["a"] * F.col("_side") + x["b"],
        )

    walk = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.least(F.lit(WALK).cast("long"), F.col("_side") * F.col("_side") - F.col(n) + 1)),
        F.col(at),
        lambda to, _: F.when(to < F.col(n), to).otherwise(network(to)),
    )
    found = df.withColumns({"_side": side, "_key": key})
    found = found.withColumns({"_0": F.floor(F.col(x) / F.col("_side")).cast("long"), "_1": F.pmod(F.col(x), F.col("_side"))})
    for r in range(4):
        found = found.withColumn(f"_{r + 2}", _turned(F.col(f"_{r}"), F.col(f"_{r + 1}"), F.lit(SEED + r)))
    found = found.withColumn(at, F.col("_4") * F.col("_side") + F.col("_5"))
    found = found.withColumn(at, F.when(F.col(at) < F.col(n), F.col(at)).otherwise(walk))
    return found.drop("_side", "_key", *[f"_{r}" for r in range(6)])


def _turned(left: Column, right: Column, seed: Column) -> Column:
    """A round of the network over the square of ``_side`` numbers a side that ``_key`` chooses."""
    return F.pmod(left + F.pmod(F.xxhash64(right, F.col("_key"), seed), F.col("_side")), F.col("_side"))


def slot_table(sources: DataFrame) -> DataFrame:
    """Intervals of [0, 1) that slots fall into: source, block count, quota and first quota place.

    The first part has the whole expected counts, the second the fractions.
    """
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / BLOCK))
    whole = Window.partitionBy()
    upto = Window.orderBy("number")
    wanted = F.col("target") * blocks / F.col("source_size")
    quotas = (
        sources.where("source_size > 0")
        .withColumn("blocks", blocks)
        .withColumn("wanted", wanted)
        .withColumn("n_slots", F.sum("wanted").over(whole))
        .withColumn("n_shards", F.greatest(F.lit(1).cast("long"), F.floor(F.col("n_slots") / SHARD)))
        .withColumn("per_shard", F.ceil(F.col("n_slots") / F.col("n_shards")))
        .withColumn("mean", F.col("wanted") / F.col("n_slots") * F.col("per_shard"))
        .withColumn("quota", F.floor("mean"))
        .withColumn("fraction", F.col("mean") - F.col("quota"))
        .withColumn("quota_end", F.sum("quota").over(upto))
        .withColumn("quotas", F.sum("quota").over(whole))
        .withColumn("fraction_end", F.sum("fraction").over(upto))
        .withColumn("fractions", F.greatest(F.sum("fraction").over(whole), F.lit(1e-300)))
    )
    return quotas.select(
        "number", "source", "blocks", "n_shards", "per_shard", "quota", "quotas",
        (F.col("quota_end") - F.col("quota")).alias("quota_from"),
        ((F.col("fraction_end") - F.col("fraction")) / F.col("fractions")).alias("low"),
        (F.col("fraction_end") / F.col("fractions")).alias("high"),
    )


def drawn_blocks(sources: DataFrame) -> DataFrame:
    """Per slot that is filled: ``shard``, ``slot`` (its place there), ``number`` of the source and ``block``."""
    spark = sources.sparkSession
    # A row per source, used three times: read from a file, so that its windows are planned and run once.
    table = written(slot_table(sources))
    numbers = table.agg(
        F.max("n_shards").alias("shards"), F.max("per_shard").alias("slots"), F.max("quotas").alias("quotas")
    ).first()
    shards, left = int(numbers.shards or 0), int((numbers.slots or 0) - (numbers.quotas or 0))
    # A row of a few bytes stands for up to thousands of slots, so the numbers of tasks follow the
    # slots: adaptive execution would go by the bytes, and put them all into one.
    tasks = max(1, shards * int(numbers.slots or 0) // TASK_SLOTS)
    every = spark.range(0, shards, 1, max(1, min(shards, tasks))).withColumnRenamed("id", "shard")
    # Whole counts: each shard takes the next ``quota`` places of the source.
    fixed = (
        table.where("quota > 0")
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_shards") - 1)))
        .repartition(tasks, "number", "shard")
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("nth"))
        .select(
            "number", "blocks", "shard", "per_shard", (F.col("quota_from") + F.col("nth")).alias("at"),
            (F.col("shard") * F.col("quota") + F.col("nth")).alias("place"),
        )
    )
    # The rest of each shard: a uniform number per slot, and the source whose interval holds it.
    # Intervals are listed per cell of [0, 1), so this is an equi-join.
    uniform = (F.pmod(F.xxhash64("shard", "slot", F.lit(SEED)), F.lit(1 << 52)) / float(1 << 52)).alias("u")
    cell = F.floor(F.col("u") * CELLS).alias("cell")
    slots = (
        every.where(F.lit(left) > 0)
        .select("shard", F.explode(F.sequence(F.lit(1), F.lit(max(1, left)))).alias("slot"))
        .select("shard", "slot", uniform)
        .select("shard", "slot", "u", cell)
    )
    cells = F.sequence(F.floor(F.col("low") * CELLS), F.least(F.lit(CELLS - 1).cast("long"), F.floor(F.col("high") * CELLS)))
    intervals = table.where("high > low").select(
        "number", "blocks", "quota", "quotas", "n_shards", "per_shard", "low", "high", F.explode(cells).alias("cell")
    )
    drawn = written(slots.join(intervals, "cell").where("u >= low and u < high"))  # less than a slot per shard and source
    # Places after the fixed ones: shards before this one, then the slots before it.
    counts = drawn.groupBy("number", "shard").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("number", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ordered = drawn.withColumn("nth", F.row_number().over(Window.partitionBy("number", "shard").orderBy("slot")) - 1)
    loose = ordered.join(base, ["number", "shard"]).select(
        "number", "blocks", "shard", "per_shard", (F.col("quotas") + F.col("slot") - 1).alias("at"),
        (F.col("n_shards") * F.col("quota") + F.col("base") + F.col("nth")).alias("place"),
    )
    # dealt as the fixed ones are, because the walk of the permutation is the work
    places = fixed.union(loose.repartition(tasks)).where(F.col("place") < PASSES * F.col("blocks"))
    turn = F.floor(F.col("place") / F.col("blocks"))
    places = places.withColumns({"in_turn": F.pmod("place", "blocks"), "at": F.col("at").cast("long")})
    blocks = permuted("in_turn", "blocks", F.xxhash64("number", turn), "block", places)
    slots = permuted("at", "per_shard", F.xxhash64("shard", F.lit(SEED)), "slot", blocks)
    return slots.select("shard", "slot", "number", "block")


def _packed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with the place of their words in their source, and the spans of them that fill the slots."""
    # Both are small next to the texts and used several times: written once, read from there.
    sizes = written(sized(docs))
    sources = written(source_targets(sizes))
    drawn = drawn_blocks(sources)
    bounded = sources.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    of = sources.select(F.col("source").alias("_source"), "number", "source_size", "target")
    offsets = with_offsets(sizes)
    placed = offsets.join(
        F.broadcast(of) if bounded else of, offsets["source"].eqNullSafe(F.col("_source"))
    ).drop("_source")
    end = F.col("offset") + F.col("size")
    blocks = F.sequence(F.floor(F.col("offset") / BLOCK), F.floor((end - 1) / BLOCK))
    # A document with words is known by its source and offset.
    pieces = placed.where("size > 0").select("doc_id", "source", "number", "offset", "size", F.explode(blocks).alias("block"))
    # A row of the drawn ones stands for thousands of slots until it is exploded: by its size all slots would be broadcast.
    start = F.greatest(F.col("offset"), F.col("block") * BLOCK)
    spans = pieces.select(
        "doc_id", "source", "number", "offset", "block", (start - F.col("offset")).alias("start"),
        (F.least(end, (F.col("block") + 1) * BLOCK) - start).alias("n_words"),
    ).join(drawn.hint("merge"), ["number", "block"])
    return placed, spans


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself: per ``shard`` and ``slot`` (its place in the shard) the spans of words that fill it.

    A span is ``n_words`` words of the document ``doc_id`` of ``source`` from word ``start`` on; a slot of several has them in
    the order of ``offset``, the words of the source before the document.
    """
    return _packed(docs)[1].select("shard", "slot", "source", "doc_id", "offset", "start", "n_words")


def mix(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken``, the words of its spans in the mix."""
    placed, spans = _packed(docs)
    taken = spans.groupBy("number", "offset", F.lit(True).alias("with_words")).agg(F.sum("n_words").cast("long").alias("taken"))
    return (
        placed.withColumn("with_words", F.col("size") > 0)
        .join(taken, ["number", "offset", "with_words"], "left")
        .select(
            "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
        )
    )
