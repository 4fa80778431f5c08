"""Near duplicates, repeated lines, passages, languages, resampling and packing."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from netsieve.llm import decontaminate, language, line_dedup, near_dedup, packing, resampling, words
from netsieve.llm.components import connected_components

from . import helpers

DOCS = "doc_id long, text string, source string, KEY string, __row string, own int"


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def odd_docs(spark, rows):
    """Rows with columns whose names are also used inside the operators."""
    return spark.createDataFrame([(*r, "s", "k", "r", 1) for r in rows], DOCS)


def near_copies(seed=5, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts, i = {}, 0
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 9, 40, 200]))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts[i] = " ".join(copy)
            i += 1
    return texts


def test_words_agree_with_patterns():
    texts = ["", "Aé B\tc\x0bD", "x", "É,ß;9z_a\x7fb", "a" * 40, " lead", "trail \n", "日本 語"]
    for row, data, offsets in words.slices(pa.array([*texts, None])):
        for split_at, pattern in ((words.BLANK, helpers.blank_words), (words.ALNUM, helpers.alnum_words)):
            low = words.lower(data)
            starts, ends, first = words.split(low, offsets, split_at)
            got = [[bytes(low[s:e]).decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first[:-1], first[1:])]
            assert got == [pattern(t) for t in [*texts, None]]
        assert row == 0


def test_equal_spans_hash_equal_wherever_they_stand():
    data = np.frombuffer(b"abc zz abc acb", dtype=np.uint8)
    h = words.hash_spans(data, np.array([0, 4, 7, 11]), np.array([3, 6, 10, 14]))
    assert h[0] == h[2] and len(set(h.tolist())) == 3


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_match_brute_force(spark, width):
    texts = near_copies()
    got = near_dedup.near_duplicates(odd_docs(spark, texts.items()), width=width).collect()
    want = helpers.components(texts, width)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_crowded_regions_lose_no_link(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts = {}
    for i in range(700):  # more than a block, each another text
        copy = list(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(copy)
    got = near_dedup.near_duplicates(table(spark, list(texts.items())), width=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == helpers.components(texts, 4)


def test_members_far_from_the_leader_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(4)
    start = [f"w{i}" for i in range(120)]
    texts, i = {}, 0
    for family in range(3):  # families share words but are not all linked
        base = list(start)
        for k in rng.sample(range(120), 2 + 2 * family):
            base[k] = f"f{family}x{k}"
        for _ in range(40):  # a chain of edits leads away from each family's first text
            copy = list(base)
            copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
            texts[i] = " ".join(copy)
            base, i = (copy if i % 5 == 0 else base), i + 1
    got = near_dedup.near_duplicates(odd_docs(spark, texts.items()), width=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == helpers.components(texts, 4)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A b"), (None, "a b"), (6, helpers.LONG), (7, helpers.LONG), (7, helpers.LONG), (8, "c")]
    got = near_dedup.near_duplicates(table(spark, rows), width=4).collect()
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in got)
    n = 60_001 - 3
    assert found == [(-1, 1, 4, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, n, 6, True), (7, n, 6, False), (7, n, 6, False), (8, 1, 8, True)]
    assert near_dedup.near_duplicates(table(spark, [])).count() == 0


def test_near_duplicates_judge_rows_that_repeat_an_id(spark):
    base = " ".join(f"w{i}" for i in range(100))
    near, other = base.replace("w99", "x"), " ".join(f"v{i}" for i in range(50))
    rows = [(3, base), (5, near), (5, other), (5, other), (None, other + " z"), (None, "p q"), (None, "p q"), (9, None), (9, None)]
    got = near_dedup.near_duplicates(table(spark, rows), width=4).collect()
    found = sorted((r.component_id or -1, r.doc_id or -1, r.n_shingles, r.kept) for r in got)
    assert found == [(-1, -1, 1, False), (-1, -1, 1, False), (3, 3, 97, True), (3, 5, 97, False), (5, -1, 48, False), (5, 5, 47, True), (5, 5, 47, True), (9, 9, 0, True), (9, 9, 0, True)]
    numbered = table(spark, [(k, *r) for k, r in enumerate(rows)], "number long, doc_id long, text string")
    marked = {r.number: r.chosen for r in near_dedup.near_duplicates(numbered, width=4, row_col="number").collect()}
    assert sorted(k for k in marked if marked[k]) == [0, 2, 5, 7, 8]


def test_near_dedup_stage_keeps_one_row_of_each_group(spark):
    base = " ".join(f"w{i}" for i in range(100))
    near, other, third = base.replace("w99", "x"), " ".join(f"v{i}" for i in range(50)), "p q r s t"
    rows = [(3, base, 1), (5, near, 2), (5, other, 3), (7, third, 4), (7, third, 5), (None, third, 6), (None, "u", 7), (None, "u", 8), (8, None, 9)]
    docs = table(spark, rows, "doc_id long, text string, row_id int")
    got = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted((r.doc_id or -1, r.text) for r in got.collect())
    assert kept == [(-1, "u"), (3, base), (5, other), (7, third), (8, None)]


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(9, 9)]
    got = {r.node: r.component for r in connected_components(table(spark, links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]}


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", "d"]) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "x\ny\nz"), (63, "x\ny\nz"), (64, "q\n" * 5000)]
    got = line_dedup.drop_repeated_lines(odd_docs(spark, rows)).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == helpers.kept_lines(rows)
    assert got[0].asDict().keys() >= {"KEY", "own", "source"}


def test_line_dedup_of_odd_rows(spark):
    text = "a\nb\nc"
    docs = table(spark, [(1, text, 9), (1, text, 9), (None, text, 9), (2, text, 9)], "doc_id long, text string, N_LINES int")
    got = sorted((r.doc_id or -1, r.text, r.n_removed) for r in line_dedup.drop_repeated_lines(docs).collect())
    assert got == [(-1, text, 0), (1, "", 3), (1, "", 3), (2, "", 3)]
    assert line_dedup.drop_repeated_lines(table(spark, [])).count() == 0


def passages_by_hand(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = helpers.alnum_words(text)
        for k in range(max(len(w) - width + 1, min(len(w), 1))):
            windows[tuple(w[k : k + width])].add(item)
    out = {}
    for i, text in docs:
        w, hits, found = helpers.alnum_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hits.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])] - {None}
        out[i] = (len(w), sorted(hits), sorted(map(str, found)))
    return out


@pytest.mark.parametrize("limit", [decontaminate.AUTOMATON_BYTES, 300])
def test_passages_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "AUTOMATON_BYTES", limit)  # one automaton, or many
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice(["a", "b", "É", "é", "c1"]) for _ in range(n))
    items = [(i, say(rng.randint(8, 14))) for i in range(12)] + [(100, None), (101, "?!"), (102, "zz"), (103, "ZZ, yy"), (None, "qq"), (104, "zz")]
    docs = [(i, say(rng.randint(0, 400))) for i in range(20)] + [(50, None), (51, ""), (52, "é—x-zz,yy... ZZ"), (53, "qq"), (54, helpers.LONG + " zz")]
    docs += [(60 + k, f"{say(5)}, {t}! {say(3)}") for k, (_, t) in enumerate(items[:12])]
    got = decontaminate.find_passages(odd_docs(spark, docs), table(spark, items, "item_id long, text string"), width=10).collect()
    assert {r.doc_id: (r.n_words, r.hit_words, r.items) for r in got} == passages_by_hand(docs, items)
    spans = {r.doc_id: [r.text[s.begin : s.end] for s in r.spans] for r in got if r.doc_id in (52, 53, 54)}
    assert spans == {52: ["zz,yy... ZZ"], 53: ["qq"], 54: ["zz"]}


@pytest.mark.parametrize("limit", [decontaminate.AUTOMATON_BYTES, 60])
def test_short_items_inside_windows_of_longer_ones(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "AUTOMATON_BYTES", limit)
    items = [(1, "c d"), (2, "a b c d e f g h i j"), (3, "f"), (4, "h i"), (5, "k l m")]
    docs = [(1, "a b c d e f g h i j"), (2, "x c d a b c d e f g h i j k l m f"), (3, "b c d e h i j"), (4, "a b c d e f g h i j a b c d e f g h i j")]
    got = {r.doc_id: r for r in decontaminate.find_passages(table(spark, docs), table(spark, items, "item_id long, text string")).collect()}
    assert {i: (r.n_words, r.hit_words, r.items) for i, r in got.items()} == passages_by_hand(docs, items)
    assert got[1].hit_words == list(range(10)) and [(s.begin, s.end) for s in got[1].spans] == [(0, 19)]


def test_parts_of_a_benchmark_are_collected_one_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "AUTOMATON_BYTES", 60)
    done, part, store = [], decontaminate._part, decontaminate.stored
    monkeypatch.setattr(decontaminate, "_part", lambda windows, k: done.append("part") or part(windows, k))
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: done.append(name) or store(df, name))
    items = [(k, f"{x} {x}") for k, x in enumerate("abcd")]
    got = decontaminate.find_passages(table(spark, [(1, "a a b b c d d")]), table(spark, items, "item_id long, text string")).collect()
    assert [(r.hit_words, r.items) for r in got] == [([0, 1, 2, 3, 5, 6], ["0", "1", "3"])]
    n = done.count("part")
    assert n > 1 and done == ["windows", "part"] + ["scanned", "part"] * (n - 1)


def test_passages_of_empty_tables(spark):
    docs, items = table(spark, [(1, "a b")], "doc_id long, text string"), table(spark, [], "item_id long, text string")
    assert [(r.n_words, r.hit_words, r.items, r.spans) for r in decontaminate.find_passages(docs, items).collect()] == [(2, [], [], [])]
    assert decontaminate.find_passages(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language.fit_languages(docs.where(~held_out))
    got = language.predict_languages(docs.where(held_out).drop("source"), model)
    n, right, low, high = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right / n > 0.98 and 0 <= low <= high <= 1
    rows = [(1, None, 5), (2, "", 5), (3, "12 — 3", 5), (4, "é", 5), (5, "the and of " * 30_000, 5)]
    odd = language.predict_languages(table(spark, rows, "doc_id long, text string, SCORE int"), model)
    found = {r.doc_id: (r.lang_pred, r.score) for r in odd.collect()}
    assert [found[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3 and found[4][0] in model.languages and found[5][0] == "en"
    assert odd.columns == ["doc_id", "text", "lang_pred", "score"]


def test_language_without_labels_or_rows(spark):
    docs = table(spark, [(1, "abc", None)], "doc_id long, text string, lang string")
    model = language.fit_languages(docs)
    assert [(r.lang_pred, r.score) for r in language.predict_languages(docs, model).collect()] == [("und", 0.0)]
    assert language.predict_languages(docs.limit(0), model).count() == 0


def test_language_stage_keeps_unlabelled_and_rejects_unknown_texts(spark):
    schema = "doc_id long, text string, lang string, FOUND int"
    run = lambda rows: sorted(r.doc_id for r in corpus_pipeline.language_id(spark, table(spark, rows, schema), "").collect())
    bare = [(1, "plain words", None, 0), (2, "12 - 3", None, 0), (3, None, None, 0), (4, "hi", None, 0)]
    assert run(bare) == [1, 4]
    labelled = [(k, "the cat and the dog sat on the mat", "en", 0) for k in range(10, 15)] + [(20, "zq xj vk", "zz", 0)]
    unknown = [(30, "\u0449\u0448\u0433 \u044a\u044b\u044d", None, 0), (31, "qzxjk vbwpm", "en", 0), (32, "that cat", None, 0)]
    assert run(bare + labelled + unknown) == [4, *range(10, 15), 20, 32]


def test_filters_hold_all_languages_and_few_more():
    rng = np.random.default_rng(1)
    grams, owners = rng.integers(0, 1 << 62, 30_000).astype(np.uint64), np.arange(30_000) % 70
    model = language.LanguageModel.build([f"l{k:02}" for k in range(70)], grams, owners)
    mask = None
    for slot in language._slots(grams, len(model.masks)):
        mask = model.masks[slot] if mask is None else mask & model.masks[slot]
    assert (((mask[np.arange(len(grams)), owners // 64]) >> (owners % 64).astype(np.uint64)) & np.uint64(1)).all()
    assert model.false_rate.max() < 0.003


def test_resampling_by_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["good", "fine", "nice"] if i % 2 else ["bad", "poor", "sad"]) for _ in range(rng.randint(1, 60)))) for i in range(80)]
    docs += [(None, "good"), (200, None), (201, ""), (7, "good good"), (300, helpers.LONG)]
    labels = [(i, i % 2, 0) for i in range(40)] + [(1, 1, 0), (3, 0, 0), (None, 1, 0), (5, 1, 1)]
    got = resampling.resample(odd_docs(spark, docs), table(spark, labels, "doc_id long, quality int, toxic int"), share=0.5).collect()
    assert len(got) == len(docs)
    kept = [r for r in got if r.selected]
    assert len(kept) == round(len(docs) / 2)
    assert min(r.gumbel_key for r in kept) >= max(r.gumbel_key for r in got if not r.selected)
    weight = {r.doc_id: r.log_weight for r in got}
    assert weight[200] == weight[201] == 0 and weight[79] > 0 > weight[78]
    # the weight is the sum of the ratios of its n-grams
    target = {i for i in range(40) if i % 2} - {3, 5}
    column = pa.array([t for _, t in docs])
    counts = np.zeros((len(docs), resampling.BUCKETS))
    for row, _, texts, buckets in resampling._features(column):
        np.add.at(counts, (row + texts, buckets), 1)
    good = np.array([i in target for i, _ in docs])
    shares = [(c + 1) / (c + 1).sum() for c in (counts.sum(axis=0), counts[good].sum(axis=0))]
    want = counts @ (np.log(shares[1]) - np.log(shares[0]))
    assert np.allclose(sorted(r.log_weight for r in got), sorted(want))


def test_resampling_without_labels_or_rows(spark):
    docs, labels = table(spark, [(1, "a")]), table(spark, [], "doc_id long, quality int, toxic int")
    assert [r.selected for r in resampling.resample(docs, labels).collect()] == [False]
    assert resampling.resample(docs.limit(0), labels).count() == 0


def test_packing_keeps_every_word_and_no_conflict(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 70)) + f" t{i % 50}", f"s{rng.choice([0, 0, 0, 1, 2, 3, None])}") for i in range(300)]
    rows += [(400, None, "s0"), (401, "", None), (402, "a b", None), (403, "c d", None), (None, "e", None), (402, "a b", None), (500, helpers.LONG, "s1")]
    docs = table(spark, [(*r, 1) for r in rows], "doc_id long, text string, source string, SHARD int")
    got = packing.pack(docs, capacity=64).collect()
    total, bins, sources = defaultdict(int), defaultdict(list), {i: s for i, _, s in rows}
    for r in got:
        total[r.doc_id] += r.n_words
        assert r.first_word == r.piece * 64
        if r.bin_id:
            bins[r.bin_id].append(r)
    want = defaultdict(int)
    for i, text, _ in rows:
        want[i] += len((text or "").split())
    assert total == want
    text_of = {i: t for i, t, _ in rows}
    for rows_ in bins.values():
        assert sum(r.n_words for r in rows_) == rows_[0].bin_words <= 64
        for values in ([sources[r.doc_id] for r in rows_], [text_of[r.doc_id] for r in rows_]):
            named = [v for v in values if v is not None]
            assert len(named) == len(set(named))
    assert packing.pack(docs.limit(0)).count() == 0


def test_best_fit_takes_the_tightest_agreeing_bin():
    rng = random.Random(9)
    pieces = sorted(((rng.randint(1, 50), rng.choice("abcd"), rng.choice([None, 1, 2, 3])) for _ in range(200)), reverse=True, key=lambda p: p[0])
    chosen, used = packing.best_fit(*[[p[k] for p in pieces] for k in range(3)], 50)
    bins = []  # [room, sources, clusters]
    for (size, source, cluster), b in zip(pieces, chosen):
        fit = [k for k, (room, s, c) in enumerate(bins) if room >= size and source not in s and (cluster is None or cluster not in c)]
        best = min(fit, key=lambda k: (bins[k][0], k)) if fit else len(bins)
        if not fit:
            bins.append([50, set(), set()])
        assert b == best
        bins[b][0] -= size
        bins[b][1].add(source)
        bins[b][2].add(cluster)
    assert [50 - b[0] for b in bins] == used


def brute_grams(text):
    """N-grams of bytes, other bytes than letters as blanks, none over a blank inside."""
    data = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in text.lower().encode())
    return [data[k : k + n] for n in language.GRAMS for k in range(len(data) - n + 1) if 0x20 not in data[k + 1 : k + n - 1]]


def test_language_counts_equal_plain_sets():
    rng = random.Random(12)
    said = {"a": "abcde ", "b": "cdefg ", "c": "xyzé "}
    texts = {k: ["".join(rng.choice(v) for _ in range(300)) for _ in range(5)] for k, v in said.items()}
    names, sets = sorted(texts), {k: {g for t in v for g in brute_grams(t)} for k, v in texts.items()}

    def hashed(text):
        data = text.encode()
        found = language._grams(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
        return np.concatenate([g for _, g in found])

    pairs = {(int(g), k) for k, name in enumerate(names) for t in texts[name] for g in hashed(t)}
    model = language.LanguageModel.build(names, np.array([p[0] for p in pairs], dtype=np.uint64), np.array([p[1] for p in pairs]))
    tried = [t[:40] for v in texts.values() for t in v] + ["zzz qqq", "é", "abc cde xyz"]
    best, score, total = model._count(pa.array(tried))
    for text, b, s, n in zip(tried, best, score, total):
        grams = brute_grams(text)
        claims = [sum(g in sets[name] for g in grams) for name in names]
        assert n == len(grams)
        if max(claims) > 0:
            assert claims[b] == max(claims) and abs(s - max(claims) / sum(claims)) < 0.02


def test_more_languages_than_a_word_has_bits(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, f"{letters[k % 26]}{letters[k // 26]}{letters[k % 26]}{letters[(k * 7) % 26]} " * 10, f"l{k:03d}") for k in range(300)]
    docs = table(spark, rows * 2, "doc_id long, text string, lang string")
    model = language.fit_languages(docs)
    assert len(model.languages) == 300
    got = {r.doc_id: r.lang_pred for r in language.predict_languages(docs, model).select("doc_id", "lang_pred").collect()}
    assert sum(got[k] == lang for k, _, lang in rows) >= 290


def test_languages_of_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "aaa aaa", "x", 5), (1, "aaa aaa", "x", 5), (2, "aaa aaa", "w", 6), (2, "aaa aaa", "w", 7), (3, None, "w", 8), (4, "?", "w", 9)]
    docs = table(spark, rows, "doc_id long, text string, lang string, Score int")
    got = language.predict_languages(docs, language.fit_languages(docs))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert sorted((r.doc_id, r.lang_pred) for r in got.collect()) == [(1, "w"), (1, "w"), (2, "w"), (2, "w"), (3, "und"), (4, "und")]
    assert language.predict_languages(docs.limit(0), language.fit_languages(docs.limit(0))).count() == 0


def test_stages_leave_the_columns_of_callers_alone(spark, sf):
    rows = [(1, "one two\nthree four\nfive", "en", 1, "a", [2], "b", "c", 9), (2, "six", "en", 2, "d", [3], "e", "f", 8)]
    docs = table(spark, rows, "doc_id long, text string, lang string, n_lines int, Spans string, n_words array<int>, items string, n_removed string, hit_words int")
    for stage in (corpus_pipeline.language_id, corpus_pipeline.line_dedup_stage, corpus_pipeline.near_dedup_stage, corpus_pipeline.decontamination):
        got = stage(spark, docs, sf)
        assert got.schema.fieldNames() == docs.columns
        assert sorted(tuple(r) for r in got.collect()) == [tuple(r) for r in rows]
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_decontamination_stage_drops_documents_with_passages(spark, tmp_path):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    table(spark, [("q1", passage)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = {1: "clean text", 2: f"so {passage.upper()} end", 3: None, 4: "alpha beta gamma delta epsilon zeta eta theta iota"}
    got = corpus_pipeline.decontamination(spark, table(spark, list(texts.items())), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4]


def test_languages_are_counted_in_little_memory():
    import tracemalloc

    import pyarrow as pa

    from netsieve.llm import language

    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.choice([*range(97, 123), 32], 4000))) for _ in range(500)]
    model = language.LanguageModel.build(["a", "b"], rng.integers(0, 1 << 63, 5000).astype(np.uint64), rng.integers(0, 2, 5000))
    tracemalloc.start()
    whole = model.predict(pa.array(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6
    single = [model.predict(pa.array([t])) for t in texts[:20]]
    assert [s[0][0] for s in single] == whole[0][:20] and [s[1][0] for s in single] == whole[1][:20].tolist()
