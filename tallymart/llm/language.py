"""Language of texts by a linear-chain conditional random field over their words.

A word's score for a language is a sum of learned weights: of the word itself,
its prefixes and suffixes, its n-grams, and of the lexicons (the most frequent
training words of each language) that hold it. Learned transitions join
neighbouring words, and forward-backward gives every word's probability of each
language, so code-switched text is labelled word by word. A text's language is
the one with the highest mean probability over its words with letters.

The model is fitted by gradient steps on the driver from a bounded sample: at
most ``SAMPLE_ROWS`` rows, those with the least hashed id among rows with a
language whose crc32(doc_id) modulo 4 is not 2, and of a language with fewer than
``LEAST_ROWS`` of them its ``LEAST_ROWS`` least; so every language with a row that is
not held out is learned. Fitting reads the first ``SAMPLE_CHARS`` characters of a row
(``LEAST_CHARS`` of an added one). Weights take memory in proportion to the languages.
Chains switch between sampled texts, which is where transitions are learned.
Texts are labelled in chains of ``CHAIN`` words, whole and in vectorised steps.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as
are all texts when nothing can be learned; null or empty languages are not
learned; a null id is neither held out nor learned from; rows that repeat get
equal results; an empty table gives an empty result. Only ``doc_id``, ``text``
and, for fitting, ``lang`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.text import LOWER, Texts, byte_values, each_piece, mix, range_hashes, split_words

SAMPLE_ROWS, SAMPLE_CHARS = 2_000, 100_000
LEAST_ROWS, LEAST_CHARS = 50, 10_000
CHAIN = 64
BUCKETS = (1 << 17) - 8
LEXICON = 400
EPOCHS, BATCH, RATE, DECAY = 3, 256, 0.2, 1e-6
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (buckets, then one row for each lexicon) x languages
    transitions: np.ndarray  # from x to
    lexicons: list[np.ndarray]  # sorted word hashes


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of some words, word by word, and where each word's begin."""
    values = byte_values(LOWER[data])
    sizes = ends - starts
    owners, hashes = [np.arange(len(starts))], [range_hashes(values, starts, ends)]
    for k in (1, 2, 3):
        own = np.flatnonzero(sizes >= k)
        for salt, at in ((k, starts[own]), (k + 4, ends[own] - k)):
            owners.append(own)
            hashes.append(mix(range_hashes(values, at, at + k) + np.uint64(salt)))
    for n in (2, 3, 4):
        counts = np.maximum(0, sizes - n + 1)
        own = np.repeat(np.arange(len(starts)), counts)
        at = starts[own] + np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
        owners.append(own)
        hashes.append(mix(range_hashes(values, at, at + n) + np.uint64(n + 8)))
    owner, hashed = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owner, kind="stable")
    buckets = (hashed[order] % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.searchsorted(owner[order], np.arange(len(starts) + 1))


def _lexicon_columns(words: np.ndarray, lexicons: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(words), len(lexicons)), np.float32)
    for i, lexicon in enumerate(lexicons):
        if len(lexicon):
            place = np.minimum(np.searchsorted(lexicon, words), len(lexicon) - 1)
            out[:, i] = lexicon[place] == words
    return out


def _posteriors(scores: np.ndarray, alive: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and summed transition probabilities of chains: scores (chains, words, languages)."""
    n, length, k = scores.shape
    moves = np.exp(transitions - transitions.max())
    emits = np.exp(scores - scores.max(axis=2, keepdims=True))
    forward, backward = np.empty_like(emits), np.ones_like(emits)
    forward[:, 0] = emits[:, 0] / emits[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        step = (forward[:, t - 1] @ moves) * emits[:, t]
        forward[:, t] = step / step.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(length - 2, -1, -1):
        on = alive[:, t + 1, None]
        ahead = emits[:, t + 1] * backward[:, t + 1]
        step = ahead @ moves.T
        backward[:, t] = np.where(on, step / step.sum(axis=1, keepdims=True), 1.0)
        joint = forward[:, t, :, None] * moves * ahead[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pairs += (joint * on[:, :, None]).sum(axis=0)
    found = forward * backward
    return found / found.sum(axis=2, keepdims=True), pairs


def fit(texts: list[str], languages: list[str], seed: int = 7) -> Model | None:
    """A model from texts and their languages; None without words."""
    names = sorted(set(languages))
    encoded = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in encoded])]).astype(np.int64)
    words = split_words(data, offsets)
    if not len(words.starts) or not names:
        return None
    k = len(names)
    label_of = np.array([names.index(x) for x in languages])
    labels = label_of[words.owner]
    hashes = words.word_hashes(lower=True)
    unique, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    counts = np.zeros((len(unique), k), np.int64)
    np.add.at(counts, (number, labels), 1)
    lexicons = [np.sort(unique[np.argsort(-counts[:, i], kind="stable")[:LEXICON]]) for i in range(k)]
    buckets, at = _features(data, words.starts[first], words.ends[first])
    lexical = _lexicon_columns(unique, lexicons)

    # Chains of runs from different texts: a run of a text, then a run of another one, and so on.
    random = np.random.default_rng(seed)
    runs: list[np.ndarray] = []
    for i in range(len(texts)):
        a, b = int(words.first[i]), int(words.first[i + 1])
        while a < b:
            size = int(random.integers(8, 65))
            runs.append(np.arange(a, min(b, a + size)))
            a += size
    order = np.concatenate([runs[i] for i in random.permutation(len(runs))])
    order = order[: len(order) // CHAIN * CHAIN].reshape(-1, CHAIN) if len(order) >= CHAIN else order.reshape(1, -1)

    weights, moves = np.zeros((BUCKETS + k, k)), np.zeros((k, k))
    squares, move_squares = np.full((BUCKETS + k, k), 1e-6), np.full((k, k), 1e-6)
    for _ in range(EPOCHS):
        for start in range(0, len(order), BATCH):
            chosen = order[random.integers(0, len(order), min(BATCH, len(order)))]
            own, place = np.unique(number[chosen.ravel()], return_inverse=True)
            sizes = at[own + 1] - at[own]
            inner = np.repeat(at[own] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            used = buckets[inner]
            emits = np.add.reduceat(weights[used], np.cumsum(sizes) - sizes, axis=0)
            emits += lexical[own] @ weights[BUCKETS:]
            scores = emits[place].reshape(*chosen.shape, k)
            truth = labels[chosen]
            probable, pairs = _posteriors(scores, np.ones(chosen.shape, bool), moves)
            gradient = probable.reshape(-1, k)
            gradient[np.arange(len(gradient)), truth.ravel()] -= 1
            per_word = np.zeros((len(own), k))
            np.add.at(per_word, place, gradient)
            flat = np.zeros((BUCKETS + k, k))
            np.add.at(flat, used, np.repeat(per_word, sizes, axis=0))
            flat[BUCKETS:] += lexical[own].T @ per_word
            flat /= len(gradient)
            touched = np.flatnonzero(flat.any(axis=1))
            squares[touched] += flat[touched] ** 2
            weights[touched] -= RATE * (flat[touched] / np.sqrt(squares[touched]) + DECAY * weights[touched])
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
            step = (pairs - seen) / max(1, truth[:, 1:].size)
            move_squares += step**2
            moves -= RATE * step / np.sqrt(move_squares)
    return Model(names, weights.astype(np.float32), moves, lexicons)


def word_probabilities(model: Model, texts: Texts) -> np.ndarray:
    """The probability of each language for every word of some texts."""
    k = len(model.languages)
    hashes = texts.word_hashes(lower=True)
    if not len(hashes):
        return np.zeros((0, k))
    unique, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    buckets, at = _features(texts.data, texts.starts[first], texts.ends[first])
    emits = np.add.reduceat(model.weights[buckets], at[:-1], axis=0).astype(np.float64)
    emits += _lexicon_columns(unique, model.lexicons) @ model.weights[BUCKETS:]
    chains = -(-texts.counts // CHAIN)
    owner = texts.owner
    within = np.arange(len(owner)) - texts.first[owner]
    row = (np.cumsum(chains) - chains)[owner] + within // CHAIN
    column = within % CHAIN
    scores = np.zeros((int(chains.sum()), CHAIN, k))
    alive = np.zeros(scores.shape[:2], bool)
    scores[row, column] = emits[number]
    alive[row, column] = True
    found, _ = _posteriors(scores, alive, model.transitions)
    return found[row, column]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _least_hashes(able: DataFrame, rows: int) -> int | None:
    """The hash of id up to which ``rows`` rows of ``able`` have theirs; None if there are no more rows than that.

    Only hashes below a bound that a count gives travel to the driver, about twice as many as asked
    for at any size; the bound is raised until they are enough.
    """
    total = able.count()
    share = 2 * rows / max(1, total)
    while share < 1:
        bound = int(share * 2**63) * 2 - 2**63
        low = able.where(F.col("_hash") <= bound).select("_hash").orderBy("_hash").limit(rows).collect()
        if len(low) == rows:
            return low[-1]["_hash"]
        share *= 4
    return None


def learn(docs: DataFrame) -> Model | None:
    """The model of the bounded sample of rows that may be learned from.

    The hashes of ids choose the rows first; only then are their texts fetched.
    """
    able = (
        docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
        .where("lang is not null and lang != '' and text is not null")
        .select(
            "doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
            F.xxhash64("doc_id").alias("_hash"),
        )
    )
    order = [F.col("_hash"), F.col("doc_id"), F.col("text"), F.col("lang")]

    def chosen(rows: DataFrame, count: int, chars: int) -> list:
        cut = _least_hashes(rows, count)
        low = rows if cut is None else rows.where(F.col("_hash") <= cut)
        # rows of one id share its hash, so there can still be more
        return low.withColumn("text", F.substring("text", 1, chars)).orderBy(*order).limit(count).collect()

    rows = chosen(able, SAMPLE_ROWS, SAMPLE_CHARS)
    sampled = Counter(r.lang for r in rows)
    counts = able.groupBy("lang").count().collect()
    for rare in sorted(r.lang for r in counts if sampled[r.lang] < min(LEAST_ROWS, r["count"])):
        own = chosen(able.where(F.col("lang") == rare), LEAST_ROWS, LEAST_CHARS)
        rows = [r for r in rows if r.lang != rare] + own
    return fit([r.text for r in rows], [r.lang for r in rows])


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``n_other`` (words labelled otherwise)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "lang_pred", "score", "n_other"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen: list[str] = []
            scores: list[float] = []
            others: list[int] = []
            for at, end, texts in each_piece(batch.column(2)):
                n = end - at
                if model is None:
                    chosen += [UNKNOWN] * n
                    scores += [0.0] * n
                    others += [0] * n
                    continue
                found = word_probabilities(model, texts)
                letters = np.concatenate([[0], np.cumsum(_LETTER[texts.data])])
                worded = letters[texts.ends] > letters[texts.starts]
                sums = np.zeros((n, len(model.languages)))
                own = texts.owner[worded]
                np.add.at(sums, own, found[worded])
                counts = np.bincount(own, minlength=n)
                best = sums.argmax(axis=1)
                other = np.bincount(own[found[worded].argmax(axis=1) != best[own]], minlength=n)
                ascii_ = np.concatenate([[0], np.cumsum(_LETTER[texts.data] & (texts.data < 128))])
                for i in range(n):
                    a, b = texts.offsets[i], texts.offsets[i + 1]
                    known = counts[i] and (ascii_[b] > ascii_[a] or _has_letter(texts.data[a:b].tobytes()))
                    chosen.append(model.languages[best[i]] if known else UNKNOWN)
                    scores.append(min(1.0, float(sums[i, best[i]] / counts[i])) if known else 0.0)
                    others.append(int(other[i]) if known else 0)
            made = [pa.array(chosen, pa.string()), pa.array(scores, pa.float64()), pa.array(others, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], names)

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double, n_other long")


def languages(docs: DataFrame) -> DataFrame:
    """``predict`` with the model that ``learn`` fits on the same documents."""
    return predict(docs, learn(docs))
