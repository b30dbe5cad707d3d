"""Quality rules as a ledger of failure bits.

``rule_ledger`` measures every text once and stores the measurements with one
bit per failed rule. A policy is a version with the set of rules it enforces, so
``apply_policy`` and ``ablation`` read only the bits: changing a policy never
reads a text again.

Edge cases: a null or empty text has no words, measures 0 everywhere and fails
``few_words``; repeated rows and tied ids are judged row by row; an empty table
gives an empty ledger. Only ``doc_id`` and ``text`` are read, so other columns,
also with names of the measurements, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.text import IS_SPACE, LOWER, Texts, byte_values, each_piece, range_hashes, salted, shingle_hashes

#: The symbols that the measurement counts, and terms of abuse.
SYMBOLS = "#*$%&|<>"
ABUSE = (
    "clown",
    "disgusting",
    "idiot",
    "loser",
    "moron",
    "pathetic",
    "scum",
    "stupid",
    "trash",
    "worthless",
)

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_abuse",
    "n_learned_abuse",
)

#: Rules in the order of their bits; a rule is never renumbered, new ones are added at the end.
RULES = (
    ("few_words", lambda: F.col("n_words") < 50),
    ("repeated_words", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ("many_symbols", lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    ("long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
    ("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    ("shouting", lambda: 2 * F.col("n_upper") > F.col("word_chars")),
    ("repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    ("abuse", lambda: 1000 * F.col("n_abuse") > 2 * F.col("n_words")),
    ("learned_abuse", lambda: 1000 * F.col("n_learned_abuse") > 8 * F.col("n_words")),
)
RULE_NAMES = tuple(name for name, _ in RULES)
BASE_RULES = ("few_words", "repeated_words")

#: Policies by version: the rules whose failure rejects a document.
POLICIES = {
    "base-1": BASE_RULES,
    "clean-1": (*BASE_RULES, "many_symbols", "shouting", "repeated_lines"),
    "clean-2": RULE_NAMES,
}
CURRENT = "clean-2"

#: Bounds of what the abuse rule learns: labelled rows, terms, and how much more frequent a term must be.
SAMPLE, TERMS, RATIO = 20_000, 256, 30
PREFIXES = (4, 6, 7, 8)

_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))
_POINT = (np.arange(256) & 0xC0) != 0x80
_WORD_POINT = _POINT & ~IS_SPACE
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_ABUSE_PATTERN = r"(?i)\b(?:" + "|".join(ABUSE) + r")\b"


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key, whether it occurs again, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    before, any_other = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    before[order[1:]] = same
    any_other[order[1:]] = same
    any_other[order[:-1]] |= same
    return any_other, before


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _prefixes(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per prefix length: the words that have one, and their lower-cased first bytes as a number."""
    data = LOWER[np.concatenate([texts.data, np.zeros(max(PREFIXES), np.uint8)])]
    sizes = texts.ends - texts.starts
    number, out = np.zeros(len(sizes), np.uint64), []
    for k in range(max(PREFIXES)):
        number |= data[texts.starts + k].astype(np.uint64) << np.uint64(8 * (7 - k))
        if k + 1 in PREFIXES:
            words = np.flatnonzero(sizes > k)
            out.append((words, number[words]))
    return out


def learn_abuse(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, terms: int = TERMS) -> list[int]:
    """Word prefixes, as numbers, that toxic documents use far more often than others.

    Fitted on at most ``rows`` labelled documents, those with the least hashed
    id, so the sample may be broadcast. A prefix needs ``RATIO`` times the rate
    of the other documents and 5 toxic documents or 2 % of them; the ``terms``
    found in most toxic documents are returned.
    """
    key = F.col("doc_id").cast("long")
    sample = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy(key.alias("_id"))
        .agg(F.max(F.col("toxic").cast("long")).alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    chosen = (
        docs.where("text is not null")
        .select(key.alias("_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(sample), "_id")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column(1)).astype(bool)
            for at, end, texts in each_piece(batch.column(0)):
                own, owner = toxic[at:end], texts.owner
                keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for words, numbers in _prefixes(texts):
                    keys.append(numbers)
                    owners.append(owner[words])
                keys, owners = np.concatenate(keys), np.concatenate(owners)
                order = np.lexsort((owners, keys))
                keys, owners = keys[order], owners[order]
                new_key, new_pair = np.ones(len(keys), bool), np.ones(len(keys), bool)
                new_key[1:] = keys[1:] != keys[:-1]
                new_pair[1:] = new_key[1:] | (owners[1:] != owners[:-1])
                begin = np.flatnonzero(new_key)
                sums = [np.add.reduceat(x.astype(np.int64), begin) if len(begin) else x[:0].astype(np.int64)
                        for x in (own[owners], ~own[owners], new_pair & own[owners])]
                # Key 0 has the totals: toxic words, other words, toxic documents.
                totals = [texts.counts[own].sum(), texts.counts[~own].sum(), own.sum()]
                columns = [np.append(keys[begin], np.uint64(0)).view(np.int64)]
                columns += [np.append(s, t).astype(np.int64) for s, t in zip(sums, totals, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "toxic", "other", "docs"])

    counts = (
        chosen.select("text", "_toxic")
        .mapInArrow(count, "key long, toxic long, other long, docs long")
        .groupBy("key")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.sum("docs").alias("docs"))
    )
    total = counts.where("key = 0").first()
    if not total or not total.toxic or not total.other:
        return []
    least = max(5.0, 0.02 * total.docs)
    ratio = (F.col("toxic") / total.toxic) / ((F.col("other") + 0.5) / total.other)
    found = counts.where(F.col("key") != 0).where((F.col("docs") >= least) & (ratio >= RATIO))
    return [r.key for r in found.orderBy(F.desc("docs"), "key").limit(terms).collect()]


def _measure(column: pa.Array, learned: np.ndarray) -> dict[str, np.ndarray]:
    out = {name: np.zeros(len(column), np.int64) for name in MEASURES}
    out["n_abuse"][:] = pc.fill_null(pc.count_substring_regex(column, _ABUSE_PATTERN), 0).to_numpy(
        zero_copy_only=False
    )
    for at, end, texts in each_piece(column):
        rows = slice(at, end)
        for name, table in (("word_chars", _WORD_POINT), ("n_symbols", _SYMBOL), ("n_upper", _UPPER)):
            out[name][rows] = _per_text(table[texts.data], texts.offsets)
        out["n_words"][rows] = texts.counts
        values = byte_values(texts.data)

        words = range_hashes(values, texts.starts, texts.ends)
        owner = texts.owner
        windows = shingle_hashes(words, 3)
        whole = owner[: len(windows)] == owner[2:]
        found = np.flatnonzero(whole)
        repeated, _ = _twice(salted(windows[found], owner[found]))
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[found[repeated] + k] = True
        out["n_repeat_words"][rows] = _per_text(covered, texts.first)

        if len(learned):
            hits = np.zeros(len(words), bool)
            for own, numbers in _prefixes(texts):
                place = np.minimum(np.searchsorted(learned, numbers), len(learned) - 1)
                hits[own[learned[place] == numbers]] = True
            out["n_learned_abuse"][rows] = _per_text(hits, texts.first)

        breaks = np.flatnonzero(texts.data == 10)
        line_starts = np.concatenate([texts.offsets[:-1], breaks + 1])
        # Empty texts share their start with the next text, which owns the one line that starts there.
        line_starts = np.unique(line_starts)
        line_owner = np.searchsorted(texts.offsets[1:], line_starts, "right")
        inside = line_starts < len(texts.data)
        line_starts, line_owner = line_starts[inside], line_owner[inside]
        line_ends = np.append(line_starts[1:], len(texts.data))
        closed = texts.data[line_ends - 1] == 10
        hashes = range_hashes(values, line_starts, line_ends - closed)
        with_word = np.searchsorted(texts.starts, line_ends) > np.searchsorted(texts.starts, line_starts)
        hashes, line_owner = hashes[with_word], line_owner[with_word]
        _, before = _twice(salted(hashes, line_owner))
        n = end - at
        out["n_lines"][rows] = np.bincount(line_owner, minlength=n)[:n]
        out["n_dup_lines"][rows] = np.bincount(line_owner[before], minlength=n)[:n]
    return out


def measure_texts(docs: DataFrame, learned: list[int] = []) -> DataFrame:  # noqa: B006
    """``doc_id`` and the measurements of every text, each text read once."""
    terms = np.sort(np.array(learned, np.int64).view(np.uint64))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            measured = _measure(batch.column(1), terms)
            columns = [batch.column(0), *(pa.array(measured[name], pa.int64()) for name in MEASURES)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *MEASURES])

    schema = f"doc_id {id_type}, " + ", ".join(f"{name} long" for name in MEASURES)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(batches, schema)


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << RULE_NAMES.index(name) for name in rules)


def rule_ledger(docs: DataFrame, learned: list[int] = []) -> DataFrame:  # noqa: B006
    """The measurements and ``failed_bits``, with bit i set where rule i fails.

    ``learned`` are the prefixes of ``learn_abuse``; without them that rule never fails.
    """
    bits: Column = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits + F.when(fails(), F.lit(1 << i)).otherwise(0)
    return measure_texts(docs, learned).withColumn("failed_bits", bits)


def apply_policy(ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return ledger.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablation(ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: how many fail it, fail it alone, and are kept without it.

    The ledger is reduced to counts per failure pattern first, so at most
    2 ** rules rows are shuffled per task.
    """
    rules, all_bits = POLICIES[version], mask(POLICIES[version])
    patterns = ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(all_bits)).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rule_rows = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in rules])
    )
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    others = F.col("bits").bitwiseAND(F.lit(all_bits) - F.col("r.bit")) == 0
    return (
        patterns.select("bits", "n", rule_rows.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(fails & others, F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(others, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame | None = None, version: str = CURRENT) -> DataFrame:
    """Per document the measurements, the failure bits and the verdict of a policy.

    ``labels`` (doc_id, toxic) teach the abuse rule terms beyond its fixed list.
    """
    learned = learn_abuse(docs, labels) if labels is not None else []
    ledger = rule_ledger(docs, learned).withColumn(
        "base_failed", F.col("failed_bits").bitwiseAND(F.lit(mask(BASE_RULES))) != 0
    )
    return apply_policy(ledger, version).withColumn("kept", F.col("kept") & ~F.col("base_failed"))


def keep_good(docs: DataFrame, labels: DataFrame | None = None, version: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with their columns."""
    learned = learn_abuse(docs, labels) if labels is not None else []
    # The whole row travels in the place of the id, so nothing is joined.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col("text"))
    kept = apply_policy(rule_ledger(rows, learned), version).where("kept")
    return kept.select(*[F.col(f"doc_id.`{c}`").alias(c) for c in docs.columns])
