"""Periodic runs, the conversation trie and toxicity."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from netsieve.llm import queries, runs, toxicity, trie

from . import helpers


def brute_runs(words, exponent=4, shortest=6):
    n, found = len(words), {}
    for q in range(n // exponent, 0, -1):
        j = 0
        while j + q < n:
            if words[j] != words[j + q]:
                j += 1
                continue
            start = j
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - start >= max(shortest, exponent * q):
                found[start, j + q] = q
    return sorted((s, e - s, q) for (s, e), q in found.items())


def split(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def periodic_words(rng, alphabet, n):
    words = [f"w{rng.randrange(alphabet)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        at = rng.randrange(n)
        words[at:at] = words[at:][: rng.randint(1, 9)] * rng.randint(2, 9)
    return words


def test_runs_equal_those_of_brute_force():
    rng = random.Random(3)
    for _ in range(120):
        texts = [periodic_words(rng, rng.choice([1, 2, 3, 30]), rng.choice([0, 1, 5, 20, 80, 250])) for _ in range(rng.randint(1, 5))]
        number = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
        ids = np.array([number[w] for t in texts for w in t], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        start, end, period = runs.find_runs(ids, first)
        got = sorted(zip(start.tolist(), end.tolist(), period.tolist()))
        assert got == sorted((s + f, s + f + n, q) for f, t in zip(first.tolist(), texts) for s, n, q in brute_runs(t))


def test_runs_do_not_rest_on_hashes(monkeypatch):
    monkeypatch.setattr(runs, "_BASE", np.uint64(0))  # all spans hash alike
    rng = random.Random(4)
    for _ in range(20):
        words = periodic_words(rng, 2, 40)
        ids = np.array([int(w[1:]) for w in words], dtype=np.int64)
        start, end, period = runs.find_runs(ids, np.array([0, len(ids)]))
        assert sorted(zip(start.tolist(), (end - start).tolist(), period.tolist())) == brute_runs(words)


def test_repair_replaces_pairs_until_none_occurs_twice():
    ids = np.array([0, 1, 2, 3] * 64, dtype=np.int64)
    places, owners, borders, left = runs._repair(ids, np.zeros(len(ids), dtype=np.int64))
    assert len(left[0]) <= 3 and left[1].sum() == len(ids)
    assert len(borders[0]) == len(np.unique(owners)) < 24 and len(places) > 100


def test_runs_and_collapsed_texts_of_odd_rows(spark):
    rows = [
        (1, "a b a b a b a b x", 7), (1, "a b a b a b a b x", 7), (2, None, 7), (2, "", None), (None, "  \t ", 1),
        (3, "x " + "z " * 60_000, 1), (4, "é é é é é é", 1), (5, "a\x0bb\ta\nb\ra\x0cb a b", 1), (6, "A a A a A a a", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_WORDS int").repartition(3)
    got = runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    for r in got.collect():
        words = split(r["text"])
        want = [(0, len(words), 1)] if len(words) > 60_000 else brute_runs(words) if words else []
        if len(words) > 60_000:
            want = [(1, 60_000, 1)]
        assert (r["n_words"], [tuple(x) for x in r["runs"]]) == (len(words), want)
        gone = {k for s, n, q in want for k in range(s + q, s + n)}
        assert r["collapsed"] == (None if r["text"] is None else " ".join(w for k, w in enumerate(words) if k not in gone))
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, exponent=1)


def expected_runs(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    top = min(((-m, s, q) for s, m, q in found), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (
        doc_id, len(found), *((top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_run_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("coalesce(length(text), 0) < 4000").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op11_periodic_runs(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for doc_id, text in docs:
        assert got[doc_id] == expected_runs(doc_id, text)


def brute_trie(conversations):
    """``conversations``: id to list of (role, text)."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = {}
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        out[path] = (
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), sum(len(p) == len(path) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(path)).encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_trie_equals_brute_force(spark):
    rng = random.Random(8)
    said = [("user", "hé"), ("assistant", ""), ("", "x" * 50_000), ("user", "no"), ("system", "né")]
    conversations = {c: [rng.choice(said[: rng.randint(1, 5)]) for _ in range(rng.choice([1, 2, 3, 5, 9]))] for c in range(-20, 60)}
    conversations |= {100 + k: [("user", "hé")] * 40 for k in range(3)}
    rows = [(c, t if rng.random() < 0.9 or t else None, role or None, text or None, "x") for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows + [(None, 0, "user", "lost", "x")], "conv_id long, turn long, role string, text string, pos string").repartition(5)
    want = brute_trie(conversations)
    assert as_rows(trie.prefix_trie(table)) == want
    # the same in segments and shards of a few rows
    assert as_rows(trie.prefix_trie(table, segment=4, shard=16)) == want


def test_trie_of_nothing_and_of_silent_conversations(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(table).count() == 0
    steps, _ = trie.number_turns(trie.digest_turns(table))
    root = as_rows(trie.build_trie(steps, spark.createDataFrame([(3,), (1,)], "conv_id long")))
    assert root == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,3").hexdigest())]


def test_repeated_turns_are_turns_of_their_own(spark):
    table = spark.createDataFrame([(1, 0, "u", "a")] * 3 + [(2, 0, "u", "a")], "conv_id long, turn long, role string, text string")
    assert as_rows(trie.prefix_trie(table)) == brute_trie({1: [("u", "a")] * 3, 2: [("u", "a")]})


def test_trie_query_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect()
    original = defaultdict(list)
    for r in rows:
        original[r["conv_id"]].append((r["role"] or "", r["text"] or ""))
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(c - c % 5, [])[:h] + own[h:]
    assert as_rows(queries.op12_conversation_trie(spark, sf)) == brute_trie(rebuilt)


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        a, b = rng.integers(0, 1 << 63, n).astype(np.uint64), np.arange(n, dtype=np.uint64)
        table = trie.SlotTable(a, b)
        slots = table.find(a, b)
        assert sorted(slots.tolist()) == list(range(n)) and (table.a[slots] == a).all()
        assert (table.find(a, b + np.uint64(n)) == -1).all()
    with pytest.raises(ValueError):
        trie.SlotTable(np.zeros(2, dtype=np.uint64), np.zeros(2, dtype=np.uint64))


def brute_texts_with(texts):
    """Texts that have each word and each beginning of a word."""
    out = defaultdict(int)
    for text in texts:
        words = set(helpers.alnum_words(text))
        keys = {("whole", w) for w in words} | {w.encode()[:k] for w in words for k in toxicity.BEGINNINGS if len(w.encode()) >= k}
        for key in keys:
            out[key] += 1
    return sorted(out.values())


def test_expressions_are_counted_once_a_text():
    texts = ["", None, "Ab ab abc, abcd", "abcdefghijklmnop ab", "élan é", "x" * 30_000]
    counts = [np.bincount(keys, minlength=len(distinct)) for _, _, distinct, _, keys in toxicity._texts_with(pa.array(texts))]
    assert sorted(counts[0].tolist()) == brute_texts_with(texts)


def labelled(spark, n=400, seed=2):
    """Texts of random words; toxic ones hold a rare word with a telling beginning."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}" for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(max(1, len(words) // 8)):
                words.insert(rng.randrange(len(words)), f"zorkil{rng.randrange(10_000)}")
        docs.append((i, " ".join(words), "k"))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, Score string"), labels


def test_rare_words_with_a_telling_beginning_are_found(spark):
    docs, labels = labelled(spark, 1000)
    table = spark.createDataFrame(labels, "doc_id long, toxic int").where("doc_id % 4 > 0")
    got = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table))
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    wrong = sum(r["predicted"] != (r["doc_id"] % 5 == 0) for r in got.where("doc_id % 4 = 0").collect())
    assert wrong <= 5


def test_toxicity_of_odd_rows(spark):
    docs, labels = labelled(spark)
    table = spark.createDataFrame(labels + [(None, 1), (0, 0), (0, None), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs.union(docs.limit(5)), table)
    odd = [(1, None), (2, ""), (None, "?!"), (5, "zorkil1 " * 20_000), (5, "zorkil1 " * 20_000), (6, "é")]
    got = toxicity.score_toxicity(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert [r["score"] for r in got[:3]] == [model.usual] * 3 and 0 < model.usual < 0.5
    assert got[3]["predicted"] == 1 and got[3]["score"] == got[4]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_toxicity_without_labels_of_both_classes(spark):
    docs, _ = labelled(spark, 20)
    for rows, want in (([], 0), ([(1, 0)], 0), ([(1, 1), (2, 1)], 1)):
        model = toxicity.fit_toxicity(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert {r["predicted"] for r in toxicity.score_toxicity(docs, model).collect()} == {want}


def test_toxicity_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op13_toxicity(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right = both.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    usual = both.agg(F.avg((F.col("toxic") == 0).cast("int"))).first()[0]
    assert right >= usual
