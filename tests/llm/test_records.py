"""WARC bundles, chats, url rules, nearest vectors, the pipeline and what the queries need."""

import hashlib
import json
import random
import re
import subprocess
import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from netsieve.llm import chat, neighbours, packing, queries, url_rules, warc
from netsieve.llm.store import new_folder, whole_groups

from . import helpers


def pages_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, size int")


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 5000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 3000)
    rng = random.Random(1)
    big = "".join(rng.choice("abcé") for _ in range(1500))
    rows = [(i, f"http://h/{i}", rng.choice([big, big + "x", "small", None, "", "y" * 999, "y" * 1000])) for i in range(120)]
    rows += [(500, None, helpers.LONG), (501, "http://a\r\nb", helpers.LONG), (501, "u", helpers.LONG), (None, "u", big), (None, "v", "only" * 300)]
    folder = new_folder(spark, "warc")
    index = warc.write_bundles(pages_table(spark, rows), folder)
    got = sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_bundles(spark, index).collect())
    top = defaultdict(lambda: -1)
    for i, _, html in rows:
        top[html or ""] = max(top[html or ""], i or -1)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = top[html or ""]
        again = len(data) >= 1000 and (i or -1) != first
        want.append((i or -1, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=lambda r: tuple((x is not None, x) for x in r)) or sorted(map(str, got)) == sorted(map(str, want))
    # any tool reads a bundle from the start, and records lie where the index says
    one = index.orderBy("bundle").first().bundle.removeprefix("file://")
    with open(one, "rb") as f:
        whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    at = [(r.frame, r.offset, r.length) for r in index.where(F.col("bundle").endswith(one.rsplit("/", 1)[1])).collect()]
    assert len(whole) == sum(x[2] for x in at) and whole.startswith(b"WARC/1.1\r\n")
    assert index.select("bundle").distinct().count() > 1 and max(x[0] for x in at) > 0


def test_warc_of_no_pages(spark):
    index = warc.write_bundles(pages_table(spark, []), new_folder(spark, "warc"))
    assert warc.read_bundles(spark, index).count() == 0


ODD_TEXTS = ["", "\\", "\\\\", "###", "####", "a ### User: b", " </turn>\n", "</turn></turn>", "\\### Assistant: </turn> ok", "#", "x\n### @b: ", "é\U0001f600", ": "]


@pytest.mark.parametrize("text", ODD_TEXTS)
@pytest.mark.parametrize("role", ["user", "assistant", "tool:\\ ###", ""])
def test_turns_read_back(text, role):
    template = chat.Template()
    turns = [(role, text), ("assistant", text), (role, text)]
    line = "".join(s for r, t in turns for s, _ in template.segments(r, t))
    assert chat.read_turns(line, template) == turns
    assert line.count("### ") - len(re.findall(r"\\### ", line)) == 3


def test_chats_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "tool"]), rng.choice([*ODD_TEXTS, None, "long " * 9000])) for c in range(15) for t in range(rng.randint(1, 9))]
    rows += [(50, 0, "user", "a"), (50, 1, "assistant", "b"), (50, 1, "assistant", "b"), (51, None, "system", "s"), (51, 1, "user", "u"), (51, 2, "assistant", "v"), (None, 0, "user", "n")]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, position string, segments int")
    got = {r.conv_id: r for r in chat.digest_chats(chat.format_chats(turns)).collect()}
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    assert got.keys() == convs.keys()
    for c, said in convs.items():
        said = [x[2:] for x in sorted(said)]
        loss = "".join(t for r, t in said if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(said), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        states = "".join({"system": "s", "user": "u", "assistant": "a"}.get(a, "?") for a, _ in said)
        assert r.valid == bool(re.fullmatch("s?(ua)+", states))
        assert r.formatted_chars == sum(len(s) for a, b in said for s, _ in chat.Template().segments(a, b))
    assert chat.digest_chats(chat.format_chats(turns.limit(0))).count() == 0


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "", "block"), ("com", "/x/y", "allow"), ("com", "/x", "block"), ("", "/", "block"), (None, "/", "block"), ("org", None, "block"), ("com", "/x", "zzz")]


def test_url_rules_match_brute_force(spark):
    rng = random.Random(2)
    hosts = ["net", "Example.NET", "a.example.net", "b.a.example.net", "xexample.net", "com", "h.com", "hcom", "", ".net", "a..net", "net:80", "日.com"]
    urls = [f"{rng.choice(['http', 'x', ''])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/1', '/en', '/x', '/x/y?z', '?/x', '#/', '/X'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "a://b://net/", "http://net/\nq", "http://" + "l." * 2000 + "net/" + "p" * 100_000] + ["http://hot.net/en/"] * 300
    pages = spark.createDataFrame([(i, u, "k", 3) for i, u in enumerate(urls)], "page_id long, url string, key string, PATH int")
    got = url_rules.judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    assert got.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
            host, path = helpers.lower(m[1]), m[2]
        fits = [(len(h), len(p), h + p, v) for h, p, v in RULES[:5] if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits)[2:] if fits else (None, "allow")
        assert got[i] == (host, path, *want), url
    assert len(got) == len(urls)


def test_url_rules_of_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in url_rules.judge_urls(pages, rules.limit(0), otherwise="block").collect()] == [(None, "block")]
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


def test_nearest_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATES", 100)
    monkeypatch.setattr(neighbours, "QUERIES", 20)
    rng = np.random.default_rng(5)
    vectors = [list(map(float, v)) for v in rng.normal(size=(300, 8)).astype(np.float32)]
    hot = vectors[0]
    vectors += [hot] * 150 + [[x * 1e-30 for x in hot], [x * 1e30 for x in hot], [-x for x in hot]]
    rows = [(i, v) for i, v in enumerate(vectors)]
    bad = [(900, None), (901, [0.0] * 8), (920, [float("nan")] * 8), (940, [float("inf")] + [0.0] * 7), (960, [None] + [1.0] * 7), (None, hot), (980, [1.0, 2.0]), (981, [2.0, 2.0]), (982, [])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows + bad + [(5, hot)]], "vec_id long, embedding array<double>, dim int, r string")
    got = defaultdict(list)
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert got.keys() == {i for i in range(len(rows)) if i % 20 == 0} | {980}
    for q, found in got.items():
        if q == 980:
            assert found == [(1, 981, 6.0)]
            continue
        scores = []
        for i, v in [*rows, (5, hot)]:
            total = 0.0
            for a, b in zip(vectors[q], v):
                total += a * b
            scores.append((-total, i))
        want = [(k, i, -s) for k, (s, i) in enumerate(sorted(x for x in scores if x[1] != q)[:20], 1)]
        assert sorted(found) == want
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_whole_groups_never_cut_a_group():
    values = [1, 1, 2, 2, 2, 2, 2, None, None, 4]
    for size in (1, 2, 3, 10):
        batches = [pa.RecordBatch.from_pydict({"k": pa.array(values[i : i + size], pa.int64()), "n": list(range(len(values)))[i : i + size]}) for i in range(0, len(values), size)]
        tables = [t.to_pydict() for t in whole_groups(iter(batches), "k")]
        assert [n for t in tables for n in t["n"]] == list(range(len(values)))
        seen = [set(t["k"]) for t in tables]
        assert sum(map(len, seen)) == len(set(values))


def test_pipeline_stages_keep_their_contract(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(10_001, None, "en", "s", 0), (10_002, "1 2 3", None, None, None), (10_003, "The and of thing", "en", "s", 1), (None, "the of and", "en", "s", 2)]
    columns, before = docs.columns, docs.union(spark.createDataFrame(rows, docs.schema))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf).persist()
        n = after.count()
        if name == "best_fit_packing":
            assert {r.doc_id for r in after.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}
            break
        assert after.columns == columns and 0 < n <= before.count()
        text = {r.doc_id: r.text for r in before.collect()}
        if name == "language_id":
            assert text.keys() - {r.doc_id for r in after.collect()} == {10_001, 10_002}
        if name == "line_dedup":
            want = helpers.kept_lines(sorted(text.items(), key=lambda x: (x[0] is not None, x[0])))
            want = {i: t for i, (t, lines, gone) in want.items() if gone < lines or not gone}
            assert {r.doc_id: r.text for r in after.collect()} == want
        if name == "near_dedup":
            parts = helpers.components({i: t for i, t in text.items() if i is not None}, 5)
            assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in parts.items() if c == i} | {None}
        before = after
    assert packing.pack(before.limit(0)).count() == 0


def test_rest_imports_without_these_operators(tmp_path):
    """The entry module works where the subpackage is absent."""
    code = (
        "import sys, json, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name.startswith('netsieve.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "print(json.dumps([len(e.queries()), len(e.oracle_sql()), any(x.startswith('op1_') for x in e.queries())]))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    n, n_sql, has = json.loads(out.stdout)
    assert n > 150 and n_sql > 100 and not has


def test_every_operator_is_registered():
    names = queries.queries()
    assert [n.split("_")[0] for n in names] == [*(f"op{k}" for k in range(1, 11)), "pipeline"]
    assert set(queries.oracle_sql()) < set(names)


def test_neighbours_of_huge_and_tiny_components(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)] + [(100, [1e160, 0.0, 0.0, 0.0]), (101, [-1e160, 1.0, 0.0, 0.0]), (102, [1e-300, 0.0, 0.0, 1e-310]), (103, [1e308, 1e308, 1e308, 1e308])]
    rows += [(200 + i, [1e160 * (i + 1), 0.0, 0.0, 0.0]) for i in range(25)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.nearest(vectors, F.col("vec_id").isin(1, 2, 100, 102)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    by_id = dict(rows)
    for q, found in got.items():
        with np.errstate(over="ignore"):
            scores = []
            for v, x in rows:
                if v != q:
                    s = 0.0
                    for a, b in zip(by_id[q], x):
                        s += float(np.float64(a) * np.float64(b))
                    scores.append((-s, v))
        assert found == [(v, -s) for s, v in sorted(scores)[:20]]
    assert len(got) == 4
