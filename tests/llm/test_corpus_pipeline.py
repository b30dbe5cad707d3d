"""The whole pipeline on planted copies, leaks, junk and odd rows, and on empty tables."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import LEAK

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, found int"
RNG = np.random.default_rng(11)
VOCABULARY = ["".join(RNG.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(2000)]


def prose(words, lines=8):
    own = [" ".join(RNG.choice(VOCABULARY, words // lines)).capitalize() + "." for _ in range(lines)]
    return "\n".join(own)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    footer = "All rights reserved by the company, its owners and their friends"
    texts = {i: prose(160) for i in range(40)}
    for i in range(0, 40, 2):
        texts[i] += "\n" + footer
    copied = texts[1]
    for i in (101, 102, 103):
        texts[i] = copied
    near = texts[3].split(" ")
    near[30] = "otherwise"
    texts[110] = " ".join(near)
    near[90] = "besides"
    texts[111] = " ".join(near)
    texts[120] = prose(160) + "\n" + LEAK
    texts |= {130: None, 131: "", 132: "too short", 133: " \n\t", 140: prose(160_000, 4000)}
    rows = [(i, t, "en", f"s{i % 3}" if i else None, len(t or ""), "x", 1) for i, t in texts.items()]
    rows += [rows[5], (None, prose(160), None, None, None, None, None), (150, texts[7], "en", "s1", 1, "x", 1)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, LEAK)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, texts


def test_stages_each_do_their_part(spark, folder):
    root, texts = folder
    docs, kept, columns = spark.read.parquet(f"{root}/documents.parquet"), {}, []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, root).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        columns.append(docs.columns)
    assert all(c == SCHEMA.replace(",", "").split()[::2] for c in columns[:-1])
    junk, copies, leaks = {130, 131, 132, 133}, {101, 102, 103, 110, 111, 150}, {120}
    assert set(kept["quality"]) == set(texts) - junk | {None, 150}
    assert set(kept["lines"]) == set(kept["quality"])
    assert all(r.text.strip() for r in kept["lines"].values())
    assert all(kept["lines"][i].text == texts[i] for i in (1, 3, 101, 102, 103, 110, 111))  # copies stay whole
    assert [i for i in range(0, 40, 2) if "rights reserved" in kept["lines"][i].text] == [0]
    assert kept["lines"][2].n_chars == len(kept["lines"][2].text)
    assert set(kept["near_duplicates"]) == set(kept["lines"]) - copies
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - leaks
    assert set(kept["mixing"]) == set(kept["decontamination"])
    assert all(r.taken <= 3 * r.size for r in kept["mixing"].values())


def test_run_returns_the_mix_of_the_kept(spark, folder):
    root, texts = folder
    found = corpus_pipeline.run(spark, root).collect()
    clean = set(range(40)) | {140, None}
    assert {r.doc_id for r in found} == clean and len(found) == len(clean)
    sizes = {r.doc_id: r.size for r in found}
    assert sizes[140] == 160_000 and sizes[1] == 160


def test_boilerplate_goes_from_documents_that_are_no_copies(spark):
    bodies = [prose(40, 2) for _ in range(12)]
    notice = "Read our terms of use with care before you go on with any of these pages here"
    rows = [(i, f"{b}\n{notice}") for i, b in enumerate(bodies)]  # a fourth of the words
    copies = [(20, rows[3][1]), (21, rows[3][1].replace("Read our", "Read all")), (22, rows[5][1])]
    pieced = [(30, "\n".join(b.split("\n")[0] for b in bodies))]  # nothing of its own, and no copy
    docs = spark.createDataFrame(rows + copies + pieced, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    assert kept[0] == rows[0][1]
    assert all(kept[i] == bodies[i] for i in range(1, 12))
    assert kept[20] == bodies[3] and kept[22] == bodies[5] and kept[21].startswith(bodies[3])
    assert 30 not in kept and len(kept) == 15


def test_empty_tables(spark, folder, tmp_path):
    root, _ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{root}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
