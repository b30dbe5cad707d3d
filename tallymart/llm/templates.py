"""Removal of boilerplate lines: identical lines, and those of a log-template tree.

A line whose words recur alike in ``MIN_COPIES`` documents is dropped but for its
earliest place, however short it is.

Longer lines also go down a tree of fixed depth: by their number of tokens, then
by their leading tokens, where a token with a digit is a variable field. In a leaf
that reaches ``MIN_DOCS`` documents, the other tokens of a line are put in order by how
many lines (the distinct ones of each document) have them at that place. The first of them, for
each number of them, are fixed tokens of a template and the rest its variable
fields, so tokens that all lines share stay longest. A template keeps at least ``MIN_FIXED``
tokens, and half, fixed after the leading ones: other lines (short ones, rows of
numbers) recur by equality alone. A line goes with the template of most fixed tokens among its own
that ``MIN_DOCS`` documents have. It is dropped unless it is the earliest with that
template, so no text is lost to its own copies.

Each step is a count or a join by one hash, of a leaf, of a token at its place, or of a
template, so no leaf is gathered anywhere, rows grow as the lines do, and the result does not depend on
how the documents are dealt. A frequent line, token or template is counted by parts before it is
shuffled, and the joins are fed by shuffles of their own, which adaptive execution splits.

With groups of copies, exact or near, a group counts as one document: a line recurs, and a template has its
documents, by the groups that have it, and all texts of the earliest group keep it. So copies lose the same lines
and stay copies, and lines that only copies share stay. (Tokens are put in order by all documents.)

Edge cases: a null or empty text has no lines; lines without a word are kept; a
text without line breaks is one line, so of texts that are copies one keeps its
lines; rows that repeat id and text count as different documents and get
equal results; null ids come last; an empty
table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.storage import written
from tallymart.llm.text import Texts, each_piece, mix, range_hashes, salted

DEPTH = 3
MIN_FIXED = 2
MIN_COPIES, MIN_DOCS = 2, 10

_MASK = (1 << 64) - 1
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)


def _least_fixed(size: int | np.ndarray) -> int | np.ndarray:
    """How many tokens after the leading ones a template of ``size`` tokens keeps fixed."""
    return np.maximum(MIN_FIXED, (size - DEPTH + 1) // 2)


class Lines:
    """The lines of some texts: owner, number, first token, size, hash of the words; the leaves of ``long`` ones; tokens as hashes, 0 if variable."""

    def __init__(self, texts: Texts) -> None:
        self.tokens = texts.word_hashes()
        breaks = np.flatnonzero(texts.data == 10) + 1
        starts = np.unique(np.concatenate([texts.offsets[:-1], breaks]))
        starts = starts[starts < len(texts.data)] if len(texts.data) else starts[:0]
        ends = np.append(starts[1:], len(texts.data))[: len(starts)]
        self.owner = np.searchsorted(texts.offsets[1:], starts, "right")
        self.number = np.arange(len(starts)) - np.searchsorted(self.owner, self.owner)
        self.first = np.searchsorted(texts.starts, starts)
        self.size = np.searchsorted(texts.starts, ends) - self.first
        self.words = range_hashes(self.tokens, self.first, self.first + self.size).view(np.int64)
        digits = np.zeros(len(texts.data) + 1, np.int64)
        np.cumsum(_DIGIT[texts.data], out=digits[1:])
        self.tokens[digits[texts.ends] > digits[texts.starts]] = 0
        fixed = np.concatenate([[0], np.cumsum(self.tokens != 0)])
        rest = np.minimum(self.first + DEPTH, self.first + self.size)
        self.long = np.flatnonzero(fixed[self.first + self.size] - fixed[rest] >= _least_fixed(self.size))
        leaf = self.size[self.long].astype(np.uint64)
        for k in range(DEPTH):
            leaf = mix(leaf * np.uint64(31) + self.tokens[self.first[self.long] + k])
        self.leaf = leaf.view(np.int64)


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with words: hash, leaf if any, place, and whether the first of its hash, and of its leaf, in the row."""
    for batch in batches:
        for at, _, texts in each_piece(batch.column(2)):
            lines = Lines(texts)
            worded = np.flatnonzero(lines.size)
            leaf, has = np.zeros(len(lines.size), np.int64), np.zeros(len(lines.size), bool)
            leaf[lines.long], has[lines.long] = lines.leaf, True
            new = [np.zeros(len(lines.size), bool), np.zeros(len(lines.size), bool)]
            for marks, values, own in zip(new, (lines.words, leaf), (worded, lines.long), strict=True):
                order = own[np.lexsort((own, values[own], lines.owner[own]))]
                marks[order] = np.append(
                    True, (values[order][1:] != values[order][:-1]) | (lines.owner[order][1:] != lines.owner[order][:-1])
                )[: len(order)]
            rows = pa.array(lines.owner[worded] + at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(lines.number[worded]),
                    pa.array(lines.words[worded]), pa.array(leaf[worded], mask=~has[worded]), *(pa.array(x[worded]) for x in new),
                ],
                ["_id", "_tid", "number", "line", "leaf", "new", "new_leaf"],
            )


def _leaf_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines whose leaf is listed for their row, with their tokens, and whether the first of its words in the row."""
    for batch in batches:
        for at, end, texts in each_piece(batch.column(2)):
            lines, listed = Lines(texts), batch.column(3)[at:end]
            row = np.repeat(np.arange(end - at), listed.value_lengths().to_numpy(zero_copy_only=False))
            leaves = salted(listed.flatten().to_numpy(zero_copy_only=False).view(np.uint64), row)
            wanted = np.isin(salted(lines.leaf.view(np.uint64), lines.owner[lines.long]), leaves)
            own, leaf = lines.long[wanted], lines.leaf[wanted]
            new = np.zeros(len(own), bool)
            new[np.unique(salted(lines.words[own].view(np.uint64), lines.owner[own]), return_index=True)[1]] = True
            ends = np.cumsum(lines.size[own])
            starts = ends - lines.size[own]
            taken = np.repeat(lines.first[own] - starts, lines.size[own]) + np.arange(ends[-1] if len(ends) else 0)
            tokens = pa.array(lines.tokens[taken].view(np.int64))
            rows = pa.array(lines.owner[own] + at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(lines.number[own]),
                    pa.array(lines.words[own]), pa.array(new), pa.array(leaf),
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), tokens),
                ],
                ["_id", "_tid", "number", "line", "new", "leaf", "tokens"],
            )


def _gone(found: list[dict] | None) -> set[int]:
    """The lines to drop: not the earliest of any template they have or, without one, not the earliest of their words.

    Of the earliest lines with the same key, that is the first."""
    kept: dict[tuple[int, bool], bool] = {}
    met: set[tuple[bool, int]] = set()
    for x in sorted(found or (), key=lambda x: x["number"]):
        place, key = (x["number"], x["templated"]), (x["templated"], x["key"])
        kept[place] = kept.get(place, False) or x["earliest"] and key not in met
        if x["earliest"]:
            met.add(key)
    return {n for (n, templated), own in kept.items() if not own and (templated or (n, True) not in kept)}


def _words(parts: list[bytes]) -> int:
    return sum(len(p.split()) for p in parts)


def _cut(whole_from: float | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_lines", "n_dropped", "kept", "kept_sha256"]
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for text, found in zip(batch.column(1), batch.column(2), strict=True):
            data = text.as_py().encode()
            parts = data.split(b"\n") if data else []
            gone = _gone(found.as_py())
            if gone and whole_from is not None and _words([parts[k] for k in gone]) >= whole_from * _words(parts):
                gone = set()
            kept = b"\n".join(p for k, p in enumerate(parts) if k not in gone) if gone else data
            for column, value in zip(columns, (len(parts), len(gone), kept.decode(), hashlib.sha256(kept).hexdigest()), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["carried", *names])


def _met(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Inner join of ``rows`` with ``keys`` unique by ``on``.

    ``keys`` come from counts grouped by ``on``; the join goes by another value, so
    that both sides are shuffled for it and a frequent key is split.
    """
    other = F.bitwise_not(on).alias("other")
    return rows.select("*", other).drop(on).join(keys.select(other, *[c for c in keys.columns if c != on]), "other")


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The templates of each line: one for each number of its tokens, in their order, that may stay fixed."""
    for batch in batches:
        for at, line in enumerate(batch.column(0).to_pylist()):
            size, leaf = batch.column(1)[at].as_py(), batch.column(2)[at].as_py()
            hashes = batch.column(3)[at].values.field("hash").to_numpy().view(np.uint64)
            # the places of a line are distinct, so the exclusive or of their hashes stands for the set
            keys = np.bitwise_xor.accumulate(hashes)
            fixed = np.arange(1, len(keys) + 1)
            keys = mix(keys ^ mix(np.uint64(leaf & _MASK) + fixed.astype(np.uint64)))[fixed >= _least_fixed(size)]
            fixed = fixed[fixed >= _least_fixed(size)]
            if len(keys):
                columns = [pa.array(np.full(len(keys), line)), pa.array(fixed), pa.array(keys.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["line", "fixed", "template"])


def _templates(wanted: DataFrame, min_docs: int) -> DataFrame:
    """``line``, ``fixed``, ``template``: the templates that each distinct line may go with."""
    lines = written(wanted.groupBy("line").agg(
        F.first("leaf").alias("leaf"), F.first("tokens").alias("tokens"), F.sum(F.col("new").cast("long")).alias("docs")
    ))
    places = lines.select("line", "leaf", "docs", F.size("tokens").alias("size"), F.posexplode("tokens").alias("at", "token"))
    places = places.where((F.col("at") >= DEPTH) & (F.col("token") != 0))
    places = places.withColumn("place", F.xxhash64("leaf", "at", "token"))
    counted = places.groupBy("place").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "at", "hash")))
    own = _met(places.select("line", "leaf", "size", "at", "place", F.col("place").alias("hash")), counted, "place")
    own = own.groupBy("line").agg(F.first("size").alias("size"), F.first("leaf").alias("leaf"), ordered.alias("own"))
    return own.mapInArrow(_chains, "line long, fixed long, template long")


def _recurring(places: DataFrame, lines: DataFrame, templated: bool) -> DataFrame:
    """The ``places`` of the recurring ``lines``, and whether they are the earliest."""
    met = _met(places.select("line", "_id", "_tid", "number"), lines.select("line", "first"), "line")
    return met.select(
        "_id", "_tid", "number", F.lit(templated).alias("templated"),
        # Rows that repeat id and text share the place.
        (F.struct("_id", "_tid", "number") == F.col("first")).alias("earliest"), F.col("number").alias("key"),
    )


def _recurring_of_groups(places: DataFrame, lines: DataFrame, templated: bool) -> DataFrame:
    """As ``_recurring``, where a whole ``group`` is the earliest."""
    met = _met(places.select("line", "_id", "_tid", "number", "group"), lines.select("line", "first", "key"), "line")
    earliest = (F.col("group") == F.col("first")).alias("earliest")
    return met.select("_id", "_tid", "number", F.lit(templated).alias("templated"), earliest, "key")


def _of_groups(places: DataFrame, key: str, least: int) -> DataFrame:
    """``key``s that ``least`` groups have, and the ``first`` of these."""
    met = places.select(key, "group").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("groups"), F.min("group").alias("first"))
    return met.where(F.col("groups") >= least)


def _longest_of_groups(wanted: DataFrame, places: DataFrame, min_docs: int) -> DataFrame:
    """As ``_longest``, counted by groups; ``key`` is the template."""
    chains = written(_templates(wanted, min_docs))
    # a line has several templates and several groups: both sides go by the line, which is split if it is frequent
    met = chains.select("line", "template").join(places.select(F.col("line").alias("_line"), "group").distinct(), F.expr("line = _line"))
    recurring = _of_groups(met, "template", min_docs)
    own = _met(chains.select("line", "fixed", "template", F.col("template").alias("key")), recurring.select("template", "first"), "template")
    longest = own.groupBy("line").agg(F.max_by(F.struct("first", "key"), "fixed").alias("best"))
    return longest.select("line", "best.first", "best.key")


def _longest(wanted: DataFrame, min_docs: int) -> DataFrame:
    """Of each line with a recurring template, the place where the longest of them comes first."""
    first = F.min(F.struct("_id", "_tid", "number")).alias("first")
    chains = written(_templates(wanted, min_docs))
    places = _met(chains, wanted.groupBy("line", "_id", "_tid", "number").agg(F.count(F.lit(1)).alias("rows")), "line")
    # rows that repeat id and text repeat their places, and are documents of their own
    docs = places.groupBy("template", "_id", "_tid").agg(F.max("rows").alias("rows"), F.min("number").alias("number"))
    recurring = docs.groupBy("template").agg(F.sum("rows").alias("docs"), first).where(F.col("docs") >= min_docs)
    own = _met(chains.select("line", "fixed", "template"), recurring.select("template", "first"), "template")
    return own.groupBy("line").agg(F.max_by("first", "fixed").alias("first"))


def _cut_lines(
    docs: DataFrame, min_docs: int, min_copies: int, carried: Column, whole_from: float | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spread = F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    texts = docs.select(
        carried.alias("carried"), F.coalesce(F.col("doc_id").cast("long"), spread).alias("_id"),
        F.xxhash64(text).alias("_tid"), text.alias("text"),
    )
    place = "_id long, _tid long, number long, line long"
    rows = written(texts.select("_id", "_tid", "text").mapInArrow(_line_rows, f"{place}, leaf long, new boolean, new_leaf boolean"))
    first = F.min(F.struct("_id", "_tid", "number")).alias("first")
    copied = rows.groupBy("line").agg(F.sum(F.col("new").cast("long")).alias("docs"), first).where(F.col("docs") >= min_copies)

    leaves = rows.where("new_leaf").select("leaf", "_id", "_tid")
    frequent = leaves.groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf")
    listed = _met(leaves.withColumn("listed", F.col("leaf")), frequent, "leaf")
    by_text = listed.groupBy("_id", "_tid").agg(F.collect_set("listed").alias("leaves"))
    wanted = written(
        texts.join(by_text.hint("shuffle_hash"), ["_id", "_tid"])
        .select("_id", "_tid", "text", "leaves")
        .mapInArrow(_leaf_lines, f"{place}, new boolean, leaf long, tokens array<long>")
    )
    if groups is None:
        found = _recurring(wanted, _longest(wanted, min_docs), True).union(_recurring(rows, copied, False))
    else:
        long, all_lines = (x.select("_id", "_tid", "number", "line").join(groups, ["_id", "_tid"]) for x in (wanted, rows))
        shared = _of_groups(all_lines, "line", min_copies).withColumn("key", F.col("line"))
        # Written, so that the plan of the cut, which the driver makes anew after each of its shuffles, is half as large.
        longest = written(_longest_of_groups(wanted, long, min_docs))
        found = _recurring_of_groups(long, longest, True).union(_recurring_of_groups(all_lines, shared, False))
    gone = found.groupBy("_id", "_tid").agg(F.collect_set(F.struct("number", "templated", "earliest", "key")).alias("found"))
    cut = texts.join(gone.hint("shuffle_hash"), ["_id", "_tid"], "left").select("carried", "text", "found")
    kind = cut.schema["carried"].dataType.simpleString()
    schema = f"carried {kind}, n_lines long, n_dropped long, kept string, kept_sha256 string"
    return cut.mapInArrow(partial(_cut, whole_from), schema)


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_copies: int = MIN_COPIES) -> DataFrame:
    """Per row ``doc_id``, ``n_lines``, ``n_dropped``, ``kept`` (the other lines) and ``kept_sha256``."""
    return _cut_lines(docs, min_docs, min_copies, F.col("doc_id")).withColumnRenamed("carried", "doc_id")


def cut_recurring_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_copies: int = MIN_COPIES, whole_from: float | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``docs`` with the other lines as ``text`` and, where there, their code points as ``n_chars``.

    A row whose lines all recur stays, with an empty text; a null text stays null. With ``whole_from`` a
    row stays whole if at least that share of its words is in lines that would go: it is
    a copy as a document, and no document with boilerplate. With ``groups`` (those of ``minhash.groups``) a group of
    copies counts as one document, and no share decides.
    """
    others = [c for c in docs.columns if c != "text"]
    carried = F.struct(*[F.col(f"`{c}`") for c in others], F.col("text").isNull().alias("_null"))
    cut = _cut_lines(docs, min_docs, min_copies, carried, whole_from, groups)
    kept = F.when(~F.col("carried._null"), F.col("kept"))
    values = {c: F.col(f"carried.`{c}`") for c in others} | {"text": kept}
    if "n_chars" in values:
        values["n_chars"] = F.when(F.col("n_dropped") > 0, F.length(kept)).otherwise(values["n_chars"])
    return cut.select(*[values[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
