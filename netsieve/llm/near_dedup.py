"""Near duplicates by an LSH forest of MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm import words
from netsieve.llm.components import connected_components
from netsieve.llm.store import stored, whole_groups
from netsieve.operators.skew import join_counted, join_spread

SIGNATURE = 72  # MinHash values of a document
STEP = 3  # a new sorted order begins at every third value: 24 orders
SHALLOW, DEEP = 3, 4  # depth of sparse and of crowded regions
BLOCK = 256  # documents of a region or cluster that one task compares with as many others
LEADERS = 4  # members of a larger one that are tried as its leader
# Of 72 values, two sets with similarity s agree in 72 s on average. At 0.8 fewer than 40
# agree in about one case of a million; other thresholds keep the same distance.
SLACK = 5.3

_FACTORS = words.seeds(SIGNATURE, salt=3) | np.uint64(1)
_SKETCH = "row_id long, doc_id long, n_shingles long, h1 long, h2 long, sig array<int>"


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, row_col: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``, with ``row_col`` also ``chosen``.

    Two documents are linked if 100 * common shingles >= ``percent`` * all shingles of both;
    ``component_id`` is the smallest id within reach over links.

    - Rows are told apart by a number of their own: ``row_col``, a stored column of distinct
      longs that the result then has first, or else one that is stored here.
    - Equal sets are folded into one class first, so exact copies cost one row each.
    - The forest has 24 orders of the classes, each by the signature from another value on.
      A region is a run of classes with a longest common prefix of at least three values; a
      region of more than ``BLOCK`` classes is taken at depth four. Within a region all
      pairs are compared on their signatures, large regions as pairs of blocks in tasks of
      their own; only links that join two parts are emitted. A pair at 0.8 shares no prefix
      in any order with a probability of about 1e-5 in crowded and 1e-7 in sparse regions.
    - Connected candidates form clusters, whose texts are read again. Pairs in a cluster that
      are not joined yet and whose signatures are close are compared on their full sets.

    ``kept`` is true where ``doc_id`` equals ``component_id``, so rows that repeat the smallest id
    are all kept, and null ids never. ``chosen`` marks exactly one row of each component: the one
    with the smallest id, of several with that id or without any the one with the smallest
    number; and every row without words. Null and empty texts, and
    texts without words, have an empty set and are linked with nothing. Rows
    without an id are linked like others; their component is null if no row of it has an id.
    Rows that repeat an id are judged one by one by their own texts. An empty table gives an
    empty result. Other columns are neither read nor returned.
    """
    number = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    docs = docs.select(number.alias("row_id"), F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    docs = stored(docs, "rows") if row_col is None else docs
    sketches = stored(docs.mapInArrow(_sketcher(width), _SKETCH), "sketches")
    docs = docs.select("row_id", "text")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    classes = stored(
        sketches.where("n_shingles > 0").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("row_id").alias("rep"), F.min(first).alias("first")), "classes"
    )
    nodes = sketches.join(classes.select(F.col("rep").alias("row_id")), "row_id", "left_semi").drop("doc_id")
    clusters = connected_components(_candidates(nodes, percent))
    links = _confirmed(docs, nodes, clusters, width, percent)
    components = connected_components(links).withColumnRenamed("node", "rep")
    found = classes.join(components, "rep", "left").withColumn("root", F.coalesce("component", "rep"))
    found = join_spread(found.drop("first"), found.groupBy("root").agg(F.min("first").alias("first")), ["root"], "inner")
    empty = F.col("n_shingles") == 0
    found = stored(found.select("h1", "h2", "first", "n"), "found")
    rows = join_counted(sketches.drop("sig"), found, ["h1", "h2"], "n")
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return rows.select(
        *([F.col("row_id").alias(row_col)] if row_col else []),
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
        *([(empty | (F.col("row_id") == F.col("first.row_id"))).alias("chosen")] if row_col else []),
    )


def _fewest(percent: int) -> int:
    """Agreeing values below which no pair can be expected to reach ``percent``."""
    s = percent / 100
    return int(SIGNATURE * s - SLACK * (SIGNATURE * s * (1 - s)) ** 0.5)


def _sets(column, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, values and offsets of the shingle sets of slices of texts."""
    for row, data, offsets in words.slices(column):
        data = words.lower(data)
        starts, ends, first = words.split(data, offsets, words.BLANK)
        texts, values = words.shingles(words.hash_spans(data, starts, ends), first, width)
        yield row, *words.distinct_sets(texts, values, len(offsets) - 1)


def _signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros((len(offsets) - 1, SIGNATURE), dtype=np.int32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        at = offsets[full]
        for k, factor in enumerate(_FACTORS):
            out[full, k] = np.minimum.reduceat((values * factor) >> np.uint64(32), at).astype(np.uint32).view(np.int32)
    return out


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, dtype=np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full])
    return out.view(np.int64)


def _sketcher(width: int):
    def sketch(batches):
        for batch in batches:
            for row, values, offsets in _sets(batch.column(1), width):
                n = len(offsets) - 1
                signatures = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1, dtype=np.int32) * SIGNATURE), pa.array(_signatures(values, offsets).ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n),
                        batch.column(2).slice(row, n),
                        pa.array(np.diff(offsets).astype(np.int64)),
                        pa.array(_sums(words.mix(values), offsets)),
                        pa.array(_sums(words.mix(values ^ words.seeds(1, salt=4)), offsets)),
                        signatures,
                    ],
                    ["row_id", "doc_id", "n_shingles", "h1", "h2", "sig"],
                )

    return sketch


def _prefix(order: int, depth: int):
    """Key of the region that a signature has in one of the orders."""
    start = order * STEP
    return F.xxhash64(F.lit(order * 10 + depth), *[F.col("sig")[(start + k) % SIGNATURE] for k in range(depth)])


def _candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that connect all pairs whose signatures are close within a region."""
    orders = range(SIGNATURE // STEP)
    keys = F.array(*[F.struct(_prefix(t, SHALLOW).alias("key"), _prefix(t, DEEP).alias("deep")) for t in orders])
    rows = nodes.select("row_id", F.explode(keys).alias("k")).select("row_id", "k.key", "k.deep")
    sizes = stored(rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "sizes")
    shared = stored(join_counted(rows, sizes.withColumn("n", F.col("m")), ["key"], "n", "inner"), "regions")
    crowded = shared.where(F.col("m") > BLOCK).select("row_id", F.col("deep").alias("key"))
    deep_sizes = crowded.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    deep = stored(join_spread(crowded, deep_sizes, ["key"], "inner").select("key", "row_id", "m"), "crowded")
    small = shared.select("key", "row_id", "m").union(deep).where(F.col("m") <= BLOCK)
    fewest = _fewest(percent)
    led = _led(deep.where(F.col("m") > BLOCK), nodes, percent, fewest)
    rows = _with_open(small, led).join(nodes.select("row_id", "n_shingles", "sig"), "row_id")

    def compare(batches):
        for table in whole_groups(batches, "key", "i", "j"):
            ids = table["row_id"].to_numpy()
            sizes = table["n_shingles"].to_numpy()
            signatures = table["sig"].combine_chunks().flatten().to_numpy().reshape(-1, SIGNATURE)

            def close(p, q):
                return _close(sizes, signatures, p, q, percent, fewest)

            p, q = _joining(_codes(table, "key", "i", "j"), table["joined"].to_numpy(), close)
            yield pa.RecordBatch.from_arrays([pa.array(ids[p]), pa.array(ids[q])], ["a", "b"])

    links = _by_blocks(rows, "key").mapInArrow(compare, "a long, b long")
    return links.union(led.where("joined and row_id <> leader").select("leader", "row_id"))


def _led(rows: DataFrame, nodes: DataFrame, percent: int, fewest: int) -> DataFrame:
    """``key, row_id, m, leader, joined``: the leader of each group and who is close to it.

    Of ``LEADERS`` members drawn by hash the one leads that has the most members close to it.
    """
    rows = rows.join(nodes.select("row_id", "n_shingles", "sig"), "row_id")
    member = F.struct("row_id", "n_shingles", "sig")
    drawn = F.array(*[F.min_by(member, F.xxhash64(F.lit(t), "row_id")) for t in range(LEADERS)])
    rows = join_spread(rows, rows.groupBy("key").agg(drawn.alias("drawn")), ["key"], "inner")

    def near(other):
        alike = F.size(F.filter(F.zip_with("sig", other["sig"], lambda a, b: a == b), lambda x: x)) >= fewest
        sizes = F.least("n_shingles", other["n_shingles"]) * 100 >= F.greatest("n_shingles", other["n_shingles"]) * percent
        return sizes & alike

    rows = rows.select("key", "row_id", "m", F.col("drawn.row_id").alias("drawn"), F.transform("drawn", near).alias("near"))
    rows = stored(rows, "led")
    counts = [F.struct(F.count_if(F.col("near")[t]).alias("n"), F.lit(t).alias("t")) for t in range(LEADERS)]
    best = rows.groupBy("key").agg(F.greatest(*counts)["t"].alias("best"))
    rows = join_spread(rows, best, ["key"], "inner")
    leader = F.col("drawn")[F.col("best")]
    return rows.select("key", "row_id", "m", leader.alias("leader"), (F.col("near")[F.col("best")] | (F.col("row_id") == leader)).alias("joined"))


def _with_open(small: DataFrame, led: DataFrame) -> DataFrame:
    """Rows of all groups with ``joined`` and ``n_open``, the number of rows that are not.

    Groups that their leader joins as a whole have nothing left to compare.
    """
    still = led.groupBy("key").agg(F.count_if(~F.col("joined")).alias("n_open")).where("n_open > 0")
    rest = join_spread(led, still, ["key"], "inner").select("key", "row_id", "m", "joined", "n_open")
    return small.select("key", "row_id", "m", F.lit(False).alias("joined"), F.col("m").alias("n_open")).union(rest)


def _by_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Each group of ``key`` as pairs of blocks, a pair within one task.

    Open and joined rows are dealt over blocks of about ``BLOCK`` rows of their own kind. An
    open row goes to each pair that its block is part of, a joined one only to pairs with open
    blocks. A group of up to ``BLOCK`` rows is one block.
    """
    n_open = F.ceil(F.col("n_open") / F.lit(BLOCK)).cast("int")
    n_joined = F.ceil((F.col("m") - F.col("n_open")) / F.lit(BLOCK)).cast("int")
    at = F.xxhash64("row_id")
    own = F.when(F.col("joined"), n_open + F.pmod(at, F.greatest(n_joined, F.lit(1)))).otherwise(F.pmod(at, n_open)).cast("int")
    last = n_open - 1 + F.when(F.col("joined"), 0).otherwise(n_joined)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    return rows.drop("m", "n_open", "own", "other").repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "row_id")


def _codes(table: pa.Table, *keys: str) -> np.ndarray:
    """Running number of the group of each row; rows are sorted by ``keys``."""
    new = np.zeros(table.num_rows, dtype=bool)
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def _close(sizes, signatures, p, q, percent, fewest) -> np.ndarray:
    """Whether pairs may be linked by their sizes and signatures."""
    ok = 100 * np.minimum(sizes[p], sizes[q]) >= percent * np.maximum(sizes[p], sizes[q])
    at = np.flatnonzero(ok)
    for lo in range(0, len(at), 8192):
        some = at[lo : lo + 8192]
        ok[some] = (signatures[p[some]] == signatures[q[some]]).sum(axis=1) >= fewest
    return ok


def _joining(groups: np.ndarray, joined: np.ndarray, test) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that pass ``test`` and join two parts of it.

    The ``joined`` rows of a group are one part from the start. All pairs are tried, by rising
    distance in the table, but for those whose rows are already joined.
    """
    n = len(groups)
    part = np.arange(n)
    led = np.flatnonzero(joined)
    part[led] = led[np.searchsorted(groups[led], groups[led])]
    first, second = [], []
    rows, lag = np.arange(n), 0
    while True:
        lag += 1
        rows = rows[: np.searchsorted(rows, n - lag)]
        rows = rows[groups[rows] == groups[rows + lag]]
        if not len(rows):
            break
        open_ = rows[part[rows] != part[rows + lag]]
        if not len(open_):
            continue
        hits = open_[test(open_, open_ + lag)]
        for p in hits.tolist():
            a, b = _root(part, p), _root(part, p + lag)
            if a != b:
                part[max(a, b)] = min(a, b)
                first.append(p)
                second.append(p + lag)
        if len(hits):
            while (part != part[part]).any():
                part = part[part]
    return np.array(first, dtype=np.int64), np.array(second, dtype=np.int64)


def _root(part: np.ndarray, x: int) -> int:
    while part[x] != x:
        x = int(part[x])
    return x


def _confirmed(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` that hold on full sets and connect each component."""
    clusters = clusters.select(F.col("node").alias("row_id"), F.col("component").alias("key"))
    clusters = stored(join_spread(clusters, clusters.groupBy("key").agg(F.count("*").alias("m")), ["key"], "inner"), "clusters")
    small, large = clusters.where(F.col("m") <= BLOCK), clusters.where(F.col("m") > BLOCK)
    fewest = _fewest(percent)
    led = _led(large, nodes, percent, fewest)
    # the only shuffle of all texts: those of members are read from here on
    members = stored(docs.join(clusters.select("row_id"), "row_id"), "members")
    sure = stored(_linked_to_leader(members, led, width, percent), "led_links")
    known = sure.select("key", F.col("b").alias("row_id")).union(led.where("row_id = leader").select("key", "row_id")).distinct()
    led = large.join(known.withColumn("joined", F.lit(True)), ["key", "row_id"], "left")
    led = stored(led.withColumn("joined", F.coalesce("joined", F.lit(False))), "confirmed")
    rows = members.join(_with_open(small, led), "row_id").select("key", "row_id", "m", "joined", "n_open", "text")

    def confirm(batches):
        for table in whole_groups(batches, "key", "i", "j"):
            ids = table["row_id"].to_numpy()
            sets, signatures = [], []
            for _, values, offsets in _sets(table["text"], width):
                sets += np.split(values, offsets[1:-1])
                signatures.append(_signatures(values, offsets))
            signatures = np.concatenate(signatures)
            sizes = np.array([len(x) for x in sets])

            def linked(p, q):
                ok = _close(sizes, signatures, p, q, percent, fewest)
                for k in np.flatnonzero(ok):
                    ok[k] = _alike(sets[p[k]], sets[q[k]], percent)
                return ok

            p, q = _joining(_codes(table, "key", "i", "j"), table["joined"].to_numpy(), linked)
            yield pa.RecordBatch.from_arrays([pa.array(ids[p]), pa.array(ids[q])], ["a", "b"])

    return _by_blocks(rows, "key").mapInArrow(confirm, "a long, b long").union(sure.select("a", "b"))


def _linked_to_leader(docs: DataFrame, led: DataFrame, width: int, percent: int) -> DataFrame:
    """``key, a, b``: the leader of each group and the close members whose full sets agree.

    Members are dealt over blocks of about ``BLOCK``; the leader goes to all of them.
    """
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    leads = F.col("row_id") == F.col("leader")
    block = F.when(leads, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64("row_id"), blocks).cast("int")))
    dealt = led.where("joined").select("key", "row_id", leads.alias("leads"), F.explode(block).alias("block"))
    rows = docs.join(dealt, "row_id").select("key", "row_id", "leads", "block", "text")

    def confirm(batches):
        for table in whole_groups(batches, "key", "block"):
            keys, ids, leads = (table[c].to_pylist() for c in ("key", "row_id", "leads"))
            at, found, leaders = 0, [], []
            codes = _codes(table, "key", "block")
            for _, values, offsets in _sets(table["text"], width):
                for own in np.split(values, offsets[1:-1]):
                    if at and codes[at] != codes[at - 1]:
                        leaders = []
                    if leads[at]:
                        leaders.append((ids[at], own))
                    else:
                        found += [(keys[at], a, ids[at]) for a, other in leaders if _alike(other, own, percent)]
                    at += 1
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["key", "a", "b"])

    ordered = rows.repartition("key", "block").sortWithinPartitions("key", "block", F.desc("leads"))
    return ordered.mapInArrow(confirm, "key long, a long, b long")


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = _common(a, b)
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int((a[at] == b).sum()) if len(a) else 0
