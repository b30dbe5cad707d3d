"""Every operator against brute force on the odd rows, and on an empty table."""

from __future__ import annotations

import hashlib
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import (
    decontaminate,
    fm_dedup,
    graph,
    html_text,
    language,
    minhash,
    mixing,
    quality,
    suffix_dedup,
    templates,
    url_filter,
)
from tests.llm.conftest import LEAK, PROSE


def words(text):
    return (text or "").encode().split()


def by_row(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def test_quality_measures(odd, odd_rows):
    expected = Counter()
    for doc_id, text, *_ in odd_rows:
        own = words(text)
        grams = list(zip(own, own[1:], own[2:], strict=False))
        counts = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
        lines = [line for line in (text or "").split("\n") if line.encode().split()]
        symbols = sum((text or "").count(c) for c in quality.SYMBOLS)
        failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
        chars = sum(len(w.decode()) for w in own)
        expected[(doc_id, len(own), chars, symbols, len(lines) - len(set(lines)), len(covered), failed)] += 1
    found = quality.quality_verdicts(odd)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert by_row(found, *names) == expected
    assert not found.where("base_failed and kept").count()


def test_ablation_counts_failures_of_one_rule(spark, odd):
    ledger = quality.rule_ledger(odd)
    rows = {r.rule: r for r in quality.ablation(ledger).collect()}
    kept = quality.apply_policy(ledger).where("kept").count()
    assert all(r.n_kept_without == kept + r.n_failed_alone for r in rows.values())
    assert set(rows) == set(quality.POLICIES[quality.CURRENT])


def test_learned_abuse_is_caught(spark):
    rows = [(i, f"{PROSE} word{i} " + ("blorgish blorgable " * 3 if i % 4 == 0 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    kept = {r.doc_id for r in quality.quality_verdicts(docs, labels).where("kept").collect()}
    assert kept == {i for i in range(60) if i % 4}


def test_keep_good_keeps_columns_and_rows(odd):
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns
    assert by_row(kept, "doc_id")[(2,)] == 2


def order(rows):
    """Rows as documents: those that repeat id and text are one, null ids come last."""
    return sorted({(d is None, d or 0, t or "") for d, t, *_ in rows})


@pytest.mark.parametrize("shard", [None, 2])
def test_suffix_dedup(odd, odd_rows, shard):
    seen, kept = set(), {}
    for null, doc_id, text in order(odd_rows):
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(data[i : i + 100])
        rest = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        kept[(None if null else doc_id, text)] = (len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    expected = Counter((d, *kept[(d, t or "")]) for d, t, *_ in odd_rows)
    found = suffix_dedup.remove_repeats(odd, shard=shard)
    assert by_row(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


@pytest.mark.parametrize("shard", [None, 2])
def test_fm_dedup(odd, odd_rows, shard):
    n = 35
    windows = Counter(tuple(w[i : i + n]) for w in (words(t) for _, t, *_ in odd_rows) for i in range(len(w) - n + 1))
    expected = Counter()
    for doc_id, text, *_ in odd_rows:
        own = words(text)
        gone = {i + k for i in range(len(own) - n + 1) if windows[tuple(own[i : i + n])] > 1 for k in range(n)}
        rest = b" ".join(w for i, w in enumerate(own) if i not in gone)
        expected[(doc_id, len(own), len(gone), hashlib.sha256(rest).hexdigest())] += 1
    found = fm_dedup.remove_repeated_words(odd, shard=shard)
    assert by_row(found, "doc_id", "n_words", "n_removed", "kept_sha256") == expected


def test_blind_trie_orders_and_groups():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, 12).astype(np.uint8)) for _ in range(300)]
    trie = suffix_dedup.BlindTrie(texts[0], 0)
    for i, text in enumerate(texts[1:], 1):
        trie.insert(text, i)
    groups = list(trie.groups())
    assert [texts[g[0]] for g in groups] == sorted(set(texts))
    assert all(len({texts[i] for i in g}) == 1 for g in groups)


def test_fm_index_counts_occurrences():
    rng = np.random.default_rng(2)
    symbols = np.append(rng.integers(1, 5, 400), 0)
    index = fm_dedup.FMIndex(symbols, 8)
    for _ in range(50):
        at = int(rng.integers(0, 390))
        low, high = np.array([0]), np.array([len(symbols)])
        for s in symbols[at : at + 6][::-1]:
            low, high = index.extend(np.array([s]), low, high)
        pattern = symbols[at : at + 6]
        count = sum((symbols[i : i + 6] == pattern).all() for i in range(len(symbols) - 5))
        assert high[0] - low[0] == count


def shingle_set(text, n):
    own = (text or "").encode().lower().split()
    return frozenset(tuple(own[i : i + n]) for i in range(len(own) - n + 1)) or frozenset([tuple(own)] if own else [])


def test_near_duplicates(odd, odd_rows):
    sets = [shingle_set(t, 3) for _, t, *_ in odd_rows]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    lead = defaultdict(list)
    for (doc_id, *_), own in zip(odd_rows, label, strict=True):
        lead[own].append(doc_id)
    least = {own: min((d for d in ids if d is not None), default=None) for own, ids in lead.items()}
    expected = Counter((d[0], len(s), least[own]) for d, s, own in zip(odd_rows, sets, label, strict=True))
    found = minhash.near_duplicates(odd, 3, 85)
    assert by_row(found, "doc_id", "n_shingles", "component_id") == expected
    assert found.where("kept and doc_id != component_id").count() == 0


def test_near_duplicates_of_a_chain_and_a_large_group(spark):
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(400):
        own = list(base)
        for at in rng.integers(0, 120, 2 + i % 4):
            own[at] = f"v{i}_{at}"
        rows.append((i, " ".join(own)))
    sets = [shingle_set(t, 3) for _, t in rows]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if label[i] != label[j] and 100 * len(a & b) >= 85 * len(a | b):
                old, new = label[i], label[j]
                label = [min(old, new) if x in (old, new) else x for x in label]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(label))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    table = minhash.sketches(np.concatenate([a, b]), np.array([len(a), len(b)]))
    assert (table != ~np.uint64(0)).all()
    assert abs((table[0] == table[1]).mean() - 0.6) < 0.15


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)]
    found = graph.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.label for r in found.collect()} == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_components_plan_few_links_and_few_rounds(spark, monkeypatch):
    """The driver keeps the plan of every round, so rounds read their links few times and stop at stars."""
    scans, plain = [], graph.written

    def counted(df):
        scans.append(optimized(df).count("Relation ["))
        return plain(df)

    monkeypatch.setattr(graph, "written", counted)
    stars = [(9, 1), (8, 1), (1, 7), (20, 30), (20, 20)]
    found = graph.components(spark.createDataFrame(stars, "a long, b long"))
    assert {(r.node, r.label) for r in found.collect()} == {(9, 1), (8, 1), (7, 1), (1, 1), (30, 20), (20, 20)}
    assert len(scans) == 1
    path = [(i, i + 1) for i in range(40)] + [(50, 49), (60, 50), (60, 49)]
    found = graph.components(spark.createDataFrame(path, "a long, b long"))
    assert {(r.node, r.label) for r in found.collect()} == {(i, 0) for i in range(41)} | {(i, 49) for i in (49, 50, 60)}
    assert max(scans) <= 4


def test_no_open_group_no_comparisons(spark, odd, monkeypatch):
    """Without a group of several components nothing is joined for further links."""
    links, plain = [], minhash.written
    monkeypatch.setattr(minhash, "written", lambda df: (links.append(df.columns == ["a", "b"]), plain(df))[1])
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(odd.where("doc_id is not null"), 3, 85).collect()}
    assert found[2] == found[3] == 1 and found[7] == 6 and found[12] == 12
    assert sum(links) == 2


def test_plans_hold_written_parts_once(spark, odd, benchmark):
    """The items are not made anew in each of their joins, and no slot of the mix is broadcast."""
    assert "regexp_extract_all" not in optimized(decontaminate.drop_contaminated(odd, benchmark))
    plan = optimized(mixing.mix(odd))
    assert "strategy=merge" in plan
    assert plan.count("Window [") <= 6, plan.count("Window [")


def test_components_write_as_links_need(spark, conf, monkeypatch):
    conf(spark__sql__shuffle__partitions="64", spark__sql__adaptive__coalescePartitions__enabled="false")
    files, plain = [], graph.written

    def counted(df):
        out = plain(df)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "written", counted)
    links = [(i, i + 1) for i in range(3000) if i % 300]
    found = {r.node: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: (i - 1) // 300 * 300 + 1 for i in range(1, 3001)}
    assert len(files) > 3 and max(files[1:]) <= graph.TASKS


def test_permutation_takes_each_step_once(spark):
    sizes = (1, 2, 3, 5, 16, 17, 26, 1000, 1024, 1025)
    rows = spark.createDataFrame([(n, x) for n in sizes for x in range(n)], "n long, x long")
    found = mixing.permuted("x", "n", F.xxhash64("n"), "y", rows)
    assert found.columns == ["n", "x", "y"]
    for n in sizes:
        places = {r.x: r.y for r in found.where(F.col("n") == n).collect()}
        assert sorted(places.values()) == list(range(n))
        assert n < 1000 or sum(x == y for x, y in places.items()) < 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    walked = plan.count("lambda")
    assert walked and sum("xxhash64" in line and "lambda" not in line for line in plan.splitlines()) >= 4


def test_mixing(odd, odd_rows):
    rows = mixing.mix(odd).collect()
    sizes = Counter()
    for _, text, _, source, _ in odd_rows:
        sizes[source] += len(words(text))
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, len(words(t))) for d, t, *_ in odd_rows)
    assert all(r.source_size == sizes[r.source] and r.taken <= 3 * r.size for r in rows)
    targets = {r.source: r.target for r in rows}
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    assert all(t <= 3 * sizes[s] for s, t in targets.items())
    again = mixing.mix(odd.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in rows)


def test_the_mix_is_spans_of_documents(spark):
    texts = {i: " ".join(f"w{i}_{k}" for k in range(1 + 37 * i % 90)) for i in range(300)} | {300: None, 301: " "}
    docs = spark.createDataFrame([(i, t, f"s{i % 4}" if i % 4 else None) for i, t in texts.items()], "doc_id long, text string, source string")
    taken, slots, times = Counter(), {}, Counter()
    for r in mixing.mixture(docs).collect():
        own = texts[r.doc_id].split()
        assert 0 <= r.start and 0 < r.n_words and r.start + r.n_words <= len(own)
        taken[r.doc_id] += r.n_words
        times.update((r.doc_id, r.start + k) for k in range(r.n_words))
        slots.setdefault((r.shard, r.slot), []).append(r)
    assert taken == {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    assert max(times.values()) <= mixing.PASSES
    for parts in slots.values():  # a slot holds one block: adjacent words of one source
        parts.sort(key=lambda r: r.offset)
        assert len({r.source for r in parts}) == 1 and sum(r.n_words for r in parts) <= mixing.BLOCK
        ends = [r.offset + r.start + r.n_words for r in parts]
        assert ends[:-1] == [r.offset + r.start for r in parts[1:]]
    first = [slots[k][0].source for k in sorted(slots) if k[0] == 0]
    changes = sum(a != b for a, b in zip(first, first[1:], strict=False))
    assert changes > 4 * 4  # sources alternate inside a shard


def test_decontamination(odd, odd_rows, benchmark):
    found = {r.doc_id: r for r in decontaminate.contamination(odd, benchmark).collect()}
    assert found[10].contaminated and found[10].items == "1" and found[10].similarity == 1.0
    assert not any(r.contaminated for d, r in found.items() if d != 10)
    kept = decontaminate.drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows) - 1


def test_decontamination_finds_edited_passages(spark, benchmark):
    edited = LEAK.split()
    edited[3] = "these"
    other = list(edited)
    other[9] = "cold"
    rows = [(1, "x y z " + " ".join(edited)), (2, " ".join(other)), (3, LEAK[:40])]
    found = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), benchmark)

    def similarity(text):
        item, own = LEAK.split(), text.split()
        best = 0.0
        for s in range(max(0, len(own) - len(item)) + 1):
            a, b = (Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (item, own[s : s + len(item)]))
            best = max(best, sum((a & b).values()) / max(1, sum((a | b).values())))
        return best

    assert {r.doc_id: r.contaminated for r in found.collect()} == {d: similarity(t) >= 0.8 for d, t in rows}


def test_recurring_lines_go_but_the_first(spark, odd):
    rows = [(i, f"Line {i} of its own makes this text unlike others {i * 7}x\nPage {i} of the annual report, all rights reserved") for i in range(15)]
    rows.append((20, "all on its own here without any other"))
    found = {r.doc_id: r for r in templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0].n_dropped == 0 and found[20].n_dropped == 0
    assert all(found[i].n_dropped >= 1 and "annual report" not in found[i].kept for i in range(1, 15))
    cut = templates.cut_recurring_lines(odd)
    assert cut.columns == odd.columns and cut.where("text is null").count() == odd.where("text is null").count()


def test_language_held_out_accuracy(spark):
    rng = np.random.default_rng(5)
    vocabulary = {"aa": "tak nie jest sie dla przez oraz kiedy".split(), "bb": "the and with from that this have been".split()}
    rows = [(i, " ".join(rng.choice(vocabulary[lang], 30)), lang) for i, lang in enumerate(["aa", "bb"] * 100)]
    rows += [(900, None, "aa"), (901, "12 !!", "aa"), (902, "", None), (None, "the and with", "bb")]
    found = language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.lang_pred == ("aa" if r.doc_id % 2 == 0 else "bb") for r in found if r.doc_id is not None and r.doc_id < 900)
    assert {(r.lang_pred, r.score) for r in found if r.doc_id in (900, 901, 902)} == {("und", 0.0)}
    model = language.fit([r[1] for r in rows[:200]], [r[2] for r in rows[:200]])
    texts = language.split_words(*language_bytes("tak nie jest sie dla przez the and with from that this"))
    labels = language.word_probabilities(model, texts).argmax(axis=1)
    assert labels.tolist() == [0] * 6 + [1] * 6


def language_bytes(text):
    return np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])


PAGE = (
    '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>'
    '<div class="cookie-notice">We use cookies.</div><article><h1>A &amp; B</h1><p>First <b>bold</b>\n text.<br>Next.'
    '<p>Second &lt;one&gt;.</p><div class="comments"><p>Nice!</p></div><form><label>Mail</label></form></article>'
    "<aside>More</aside><footer>&copy; x</footer></body></html>"
)


def test_html_extraction(spark):
    plain = "<body><div class='menu'>a b</div><div><h2>Head</h2><p>" + "Long text, with words. " * 20 + "</p></div><p>cut &am"
    rows = [(1, "u", PAGE, 0), (2, None, None, 0), (3, "u", "", 0), (1, "u", PAGE, 0), (4, "u", plain, 0), (5, "u", "<p>a < b<br", 0)]
    found = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    texts = {r.page_id: r.text for r in found}
    assert texts[1] == "A & B\n\nFirst bold text. Next.\n\nSecond <one>."
    assert texts[2] == texts[3] == "" and texts[5] == "a < b"
    assert texts[4].startswith("Head\n\nLong text")
    assert all(r.n_chars == len(r.text) for r in found) and len(found) == 6


def test_url_verdicts(spark):
    link = '<a href="http://{}/x">'
    rows = [
        (1, "http://A.example.com/en/1?q", None, "allow"),
        (2, "http://www.example.com/en/1", "", "allow"),
        (3, "http://b.net/es/1#x", "", "block"),
        (4, None, None, "allow"),
        (5, "no url", link.format("b.net"), "allow"),
        (6, "ftp://good.org/a", "", "allow"),
        (7, "http://good.com/", link.format("good.org"), "allow"),
        (8, "http://bad.org/p", link.format("b.net") * 2, "block"),
        (8, "http://bad.org/p", link.format("b.net"), "block"),
        (9, "http://com", "", "allow"),
    ]
    expected = {r[0]: r[3] for r in rows} | {1: "block"}
    found = url_filter.url_verdicts(spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string"))
    got = {r.page_id: r for r in found.collect()}
    assert {k: r.verdict for k, r in got.items()} == expected
    assert (got[1].host, got[1].path, got[1].rule) == ("a.example.com", "/en/1", "example.com/en/")
    assert (got[9].host, got[9].path, got[9].rule) == ("com", "", None)
    assert got[6].trust > 0 and got[8].distrust > 0


def test_empty_tables(spark, empty, benchmark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    results = [
        quality.quality_verdicts(empty, empty.selectExpr("doc_id", "1 as toxic")),
        suffix_dedup.remove_repeats(empty),
        fm_dedup.remove_repeated_words(empty),
        minhash.near_duplicates(empty),
        url_filter.url_verdicts(pages),
        mixing.mix(empty),
        html_text.extract_text(pages),
        language.languages(empty),
        templates.drop_recurring_lines(empty),
        decontaminate.contamination(empty, benchmark.limit(0)),
    ]
    assert all(df.count() == 0 for df in results)


def test_article_elements_that_are_teasers_do_not_hide_the_text():
    body = "".join(f"<p>Paragraph {i} of the body, with commas, and a good deal of prose. It goes on; it ends here.</p>" for i in range(8))
    teasers = "".join(f"<article><h3>Card {i}</h3><p>More.</p></article>" for i in range(4))
    text = html_text.main_text(f"<body><div><h1>Title</h1>{body}</div>{teasers}</body>")
    assert text.startswith("Title\n\nParagraph 0") and "Paragraph 7" in text and "Card" not in text and "More." not in text
    links = "<ul>" + "<li><a href='/'>Link</a></li>" * 9 + "</ul>"
    text = html_text.main_text(f"<body><main><h1>Title</h1><article><h2>Part</h2>{body}<p>So.</p>{links}</article></main>{teasers}</body>")
    assert text.startswith("Title\n\nPart\n\nParagraph 0") and text.endswith("So.") and "Link" not in text


@pytest.mark.parametrize("percent", [70, 80, 85])
def test_sketch_cuts_follow_the_similarity_asked_for(spark, percent):
    rows, near = [], set()
    for i in range(200):  # pairs of 100 common words and so many of their own that they reach percent just so
        own = round(100 * (100 - percent) / percent / 2)
        for j in (0, 1):
            rows.append((2 * i + j, " ".join([f"c{i}_{k}" for k in range(100)] + [f"o{i}_{j}_{k}" for k in range(own)])))
        if 100 * 100 >= percent * (100 + 2 * own):
            near.add(2 * i)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 1, percent).collect()}
    assert all(found[a + 1] == (a if a in near else a + 1) for a in range(0, 400, 2))
    share, cut = percent / 100, minhash.least_share(percent)
    assert share - cut > 4.5 * (share * (1 - share) / minhash.SIZE) ** 0.5


def kept_lines(spark, rows):
    found = templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    return {r.doc_id: r.kept.split("\n") for r in found.collect()}


def test_short_and_twice_met_lines_recur(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"only {i} x{i}\nRead more\nHome" + (f"\n{long}" if i in (3, 7) else "")) for i in range(12)]
    kept = kept_lines(spark, rows)
    assert kept[0] == ["only 0 x0", "Read more", "Home"]
    assert kept[3] == ["only 3 x3", long]
    assert all(kept[i] == [f"only {i} x{i}"] for i in range(1, 12) if i != 3)


def test_lines_that_share_little_are_not_one_template(spark):
    nouns = "ash oak elm fir yew box bay fig pea hop rye oat".split()
    rows = [
        (i, f"{i} {i * 3} {i * 5} {i * 7}\nThe river near {n}\nThe river near {n} bends {n}ly past {n}s and {n}er {i}\nPage {i} of the annual report is yours")
        for i, n in enumerate(nouns)
    ]
    kept = kept_lines(spark, rows)
    assert kept[0] == rows[0][1].split("\n")
    assert all(kept[i] == text.split("\n")[:3] for i, text in rows[1:])


def test_lexicons_of_many_languages_are_learned():
    rng = np.random.default_rng(6)
    names = [f"l{i}" for i in range(10)]
    texts = [" ".join(f"{n}w{j}" for j in rng.integers(0, 20, 40)) for n in names for _ in range(4)]
    model = language.fit(texts, [n for n in names for _ in range(4)])
    assert len(model.weights) == language.BUCKETS + 10 and model.weights[language.BUCKETS :].any(axis=1).all()
    labels = language.word_probabilities(model, language.split_words(*language_bytes(" ".join(texts[::4])))).argmax(axis=1)
    assert (labels == np.repeat(np.arange(10), 40)).mean() > 0.95


def test_rare_and_long_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(language, "SAMPLE_CHARS", 400)
    rows = [(i, "the and with from that this have been " * 3, "bb") for i in range(300)]
    rows += [(1000 + i, "tak nie jest sie dla przez oraz kiedy " * 20, "aa") for i in range(4)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb"]


LONG_LINES = "".join(f"<p>Paragraph {i} of the body, with commas, and a good deal of prose. It goes on; it ends here.</p>" for i in range(8))


def test_boilerplate_names_around_the_text_do_not_hide_it():
    page = f'<body><div class="post-login-review widget-guide"><h1>Title</h1>{LONG_LINES}</div><div>Imprint and more.</div></body>'
    text = html_text.main_text(page)
    assert text.startswith("Title\n\nParagraph 0") and text.endswith("it ends here.")
    wrapped = f'<body><form><div class="menu"><p>Home.</p></div><div class="comments-open">{LONG_LINES}</div></form></body>'
    assert html_text.main_text(wrapped).count("Paragraph") == 8 and "Home" not in html_text.main_text(wrapped)


def test_text_under_a_doubtful_name_in_an_article_stays():
    part = "<p>Work by others came close, as far as we know. It differs, though, in two ways; both are told below.</p>" * 3
    page = f'<body><article><h1>Title</h1>{LONG_LINES}<section class="related-work"><h2>Related</h2>{part}</section></article></body>'
    assert html_text.main_text(page).count("Work by others") == 3
    notes = '<div class="comments"><p>Nice one, thanks!</p><p>First.</p></div><div class="share"><p>Tell a friend.</p></div>'
    text = html_text.main_text(page.replace("</article>", notes + "</article>"))
    assert "Nice one" not in text and "Tell a friend" not in text and text.count("Work by others") == 3


def test_lists_tables_and_verses_beside_long_text_stay():
    steps = "".join(f"<li>Step {i}</li>" for i in range(12))
    intro = "<p>This soup, which my aunt made every Sunday, needs an hour. It keeps for days, and it freezes well, too.</p>"
    table = "<table><tr><td>Salt</td><td>1 g</td></tr></table><pre>stir  well</pre>"
    page = f"<body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Soup</h1>{intro}<ol>{steps}</ol>{table}</article></body>"
    text = html_text.main_text(page)
    assert text.startswith("Soup\n\nThis soup") and all(f"Step {i}" in text for i in range(12))
    assert "Salt" in text and "1 g" in text and text.endswith("stir well") and "Home" not in text
    verses = "".join(f"<p>line {i} of it</p>" for i in range(12))
    quote = "<blockquote><p>" + "It was said, long ago, that the sea, which gives, takes back; so it was, and so it is. " * 4 + "</p></blockquote>"
    text = html_text.main_text(f"<body><article><h1>Poem</h1>{verses}{quote}</article><div>Contact.</div></body>")
    assert text.startswith("Poem\n\nline 0") and all(f"line {i} of it" in text for i in range(12)) and "Contact" not in text


def test_a_quote_that_is_not_closed_ends_with_its_tag():
    text = html_text.main_text(f'<body><article><p>Go <a href="x>link</a> now, it is good.</p><p class="y">Next, too.</p>{LONG_LINES}</article>')
    assert text.startswith("Go link now, it is good.\n\nNext, too.\n\nParagraph 0")
    assert html_text.main_text('<p title="a > b">One, two.</p>') == "One, two."
    assert html_text.main_text('<p>See <b title="it\'s">this, or <a href=\'x>that.</p>') == "See this, or that."


def test_long_pages_take_time_in_proportion(monkeypatch):
    page = "<article>" + "<p>One, two, three words.</p>" * 16_000 + "</article>"
    start = time.perf_counter()
    assert html_text.main_text(page).count("One, two") == 16_000
    assert time.perf_counter() - start < 3
    nested = "<div>" * 3000 + "Deep, deep text." + "</div>" * 3000
    assert html_text.main_text(nested) == "Deep, deep text."


def test_scores_choose_on_the_given_pages(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    scored = [html_text.main_text(p) for p in pages]
    assert all(scored)
    monkeypatch.setattr(html_text, "path_scores", lambda page: np.ones(len(page.texts)))
    without = [html_text.main_text(p) for p in pages]
    assert sum(a != b for a, b in zip(scored, without, strict=True)) >= len(pages) / 2


def brute_ranks(seeds, edges):
    out = defaultdict(list)
    for a, b in edges:
        out[a].append(b)
    base = {h: 1 / len(seeds) for h in seeds}
    ranks = dict(base)
    for _ in range(300):
        new = {h: 0.15 * x for h, x in base.items()}
        for a, x in ranks.items():
            for b in out[a]:
                new[b] = new.get(b, 0) + 0.85 * x / len(out[a])
        ranks = new
    return ranks


def test_page_ranks_reach_the_fixed_point(spark):
    rng = np.random.default_rng(12)
    edges = sorted({(f"h{a}", f"h{b}") for a, b in rng.integers(0, 40, (120, 2)) if a != b} | {(f"c{i}", f"c{i + 1}") for i in range(30)})
    seeds = {"x": ["h0", "h1", "c0"], "y": ["h2"]}
    found = url_filter.page_ranks(
        spark.createDataFrame([(k, h) for k, own in seeds.items() for h in own], "kind string, host string"),
        spark.createDataFrame([(k, a, b) for k in seeds for a, b in edges], "kind string, src string, dst string"),
    ).collect()
    for kind, own in seeds.items():
        expected, got = brute_ranks(own, edges), {r.host: r["rank"] for r in found if r.kind == kind}
        assert set(got) == set(expected)
        assert sum(abs(expected[h] - got[h]) for h in got) < 2 * url_filter.TOLERANCE


def test_distrust_reaches_far_and_through_hosts_without_pages(spark):
    link = '<a href="http://{}/x">'.format
    chain = [(i, f"http://h{i}.org/p", link(f"h{i + 1}.org")) for i in range(14)]
    rows = [*chain, (14, "http://h14.org/p", '<a href="https://spam.net/es/1">'), (20, "http://lone.org/", None), (20, "http://lone.org/", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, n string")
    found = {r.page_id: r for r in url_filter.url_verdicts(docs).collect()}
    assert all(found[i].verdict == "block" and found[i].distrust > 0 for i in range(15))
    assert all(found[i].distrust < found[i + 1].distrust for i in range(14))
    assert found[20].verdict == "allow" and found[20].distrust == 0
    long = "<p>" + "word " * 200_000 + "</p>" + link("spam.net") * 1000
    rows = spark.createDataFrame([(1, "http://a.org/", long), (2, "http://b.net/es/", None)], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_filter.url_verdicts(rows).collect()} == {1: "allow", 2: "block"}
