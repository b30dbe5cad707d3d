"""Line removal against brute force: equal lines, and templates of fixed tokens."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tallymart.llm import templates

DEPTH = templates.DEPTH


def tokens_of(line):
    return line.encode().split()


def field(token):
    return b"" if any(48 <= c <= 57 for c in token) else token


def least(size):
    return max(templates.MIN_FIXED, (size - DEPTH + 1) // 2)


def leaf_of(line):
    """(size, leading fields) of a line that can have a template, else None."""
    own = [field(t) for t in tokens_of(line)]
    if len(own) and sum(t != b"" for t in own[DEPTH:]) >= least(len(own)):
        return len(own), *own[:DEPTH]
    return None


def brute(rows, min_docs, min_copies):
    """(id, number of lines, kept text) of every row; ids of unlike texts differ and null ids come last."""
    docs = [(i is None, i or 0, (t or "").split("\n") if t else []) for i, t in rows]
    copies, leaves = Counter(), Counter()
    for _, _, lines in docs:
        copies.update({tuple(w) for line in lines if (w := tokens_of(line))})
        leaves.update({leaf for line in lines if (leaf := leaf_of(line))})
    places = Counter()
    for _, _, lines in docs:
        for words in {tuple(tokens_of(line)) for line in lines if leaves[leaf_of(line)] >= min_docs}:
            leaf = leaf_of(b" ".join(words).decode())
            places.update((leaf, k, field(t)) for k, t in enumerate(words) if k >= DEPTH and field(t))

    def chain(line):
        """The templates of a line, shortest first."""
        leaf = leaf_of(line)
        if leaf is None or leaves[leaf] < min_docs:
            return []
        own = [(-places[leaf, k, t], k, t) for k, t in enumerate(map(field, tokens_of(line))) if k >= DEPTH and t]
        own = sorted(x for x in own if -x[0] >= min_docs)
        return [(leaf, frozenset(x[1:] for x in own[:n])) for n in range(least(leaf[0]), len(own) + 1)]

    first: dict = {}
    counted = Counter()
    for null, i, lines in docs:
        counted.update({t for line in lines for t in chain(line)})
        for n, line in enumerate(lines):
            for key in (*chain(line), tuple(tokens_of(line))):
                first[key] = min(first.get(key, (null, i, n)), (null, i, n))
    result = Counter()
    for null, i, lines in docs:
        kept = []
        for n, line in enumerate(lines):
            words = tuple(tokens_of(line))
            recurring = [t for t in chain(line) if counted[t] >= min_docs]
            if recurring:
                stays = first[recurring[-1]] == (null, i, n)
            else:
                stays = not words or copies[words] < min_copies or first[words] == (null, i, n)
            if stays:
                kept.append(line)
        result[None if null else i, len(lines), "\n".join(kept)] += 1
    return result


def made(spark, rows, partitions, **limits):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    return Counter((r.doc_id, r.n_lines, r.kept) for r in templates.drop_recurring_lines(df, **limits).collect())


def test_odd_rows(spark, odd_rows):
    rows = [r[:2] for r in odd_rows]
    assert made(spark, rows, 3, min_docs=2) == brute(rows, 2, 2)
    assert made(spark, rows, 3) == brute(rows, 10, 2)


@pytest.mark.parametrize("seed", range(3))
def test_templates_of_many_documents(spark, seed):
    rng = np.random.default_rng(seed)
    pick = lambda n: str(rng.choice([f"w{chr(97 + k)}" for k in range(n)]))
    shapes = [
        lambda: f"Posted by the user {pick(9)} on a {pick(3)} in the forum {pick(20)}",
        lambda: f"Page {rng.integers(99)} of {pick(2)} is here for all of you",
        lambda: f"{rng.integers(9)} {rng.integers(9)} {rng.integers(9)} {rng.integers(9)} {rng.integers(9)}",
        lambda: f"all of it {pick(20)} {pick(20)} {pick(20)} {pick(20)}",
        lambda: pick(5),
        lambda: " \t",
        lambda: f"  one   two three four five {pick(30)}\r",
    ]
    rows = [(i, "\n".join(shapes[int(k)]() for k in rng.integers(0, len(shapes), int(rng.integers(0, 7))))) for i in range(120)]
    rows += [rows[5], rows[5], (None, rows[7][1])]
    expected = brute(rows, 4, 2)
    assert made(spark, rows, 3, min_docs=4) == made(spark, rows, 7, min_docs=4) == expected
    assert sum((Counter(dict.fromkeys(expected, 1)) - Counter(dict.fromkeys(brute(rows, 10**6, 2), 1))).values()) > 10


def test_copies_can_stay_whole(spark):
    boilerplate = "All rights reserved by us"
    rows = [(i, f"own line {i} about the topic at hand and more of it\n{boilerplate}") for i in range(4)]
    rows += [(10 + i, "a line of a copy\nand the other line of it\nand a third of them") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in templates.cut_recurring_lines(df, whole_from=0.5).collect()}
    assert kept[0] == rows[0][1] and all(kept[i] == rows[i][1].split("\n")[0] for i in (1, 2, 3))
    assert all(kept[i] == rows[4][1] for i in (10, 11, 12))


def test_a_leaf_of_many_documents_has_one_template_for_each_frequent_value(spark):
    sizes = []
    for n in (200, 400):
        text = F_TEXT.format
        rows = [(i, "\n".join(text(a="by" + "ab" * i, b=f"x{'abcde'[k]}") for k in range(5))) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found = templates.drop_recurring_lines(df).collect()
        sizes.append(sum(r.n_dropped for r in found))
    assert sizes == [200 * 5 - 5, 400 * 5 - 5]


F_TEXT = "in the same leaf are {b} lines that {a} vary at only one place or two"
