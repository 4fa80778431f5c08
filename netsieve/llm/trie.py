"""Prefix trie of conversations: distinct prefixes, their members and sums over subtrees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsieve.llm import words
from netsieve.llm.store import stored, whole_groups

SEGMENT = 4096  # turns of a conversation that one task takes at a time
SHARD = 1 << 18  # rows of the node table of a shard, about
HOT_PARENTS = 4096  # parents with so many children that their rows are broadcast, at most
LEVELS = 64


def digest_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, key, n_bytes`` of each turn; ``key`` is a digest of role and text, null or empty alike."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    key = F.unhex(F.substring(F.sha2(said, 256), 1, 32))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.where("conv_id is not null")


def number_turns(digests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with ``pos`` from 0 in each conversation, and the pieces that the conversations lie in.

    Turns go by ``turn``, nulls first, then by ``key``. All turns are cut into ranges of that
    order, so a conversation of any size is dealt over several tasks: a piece is the part of a
    conversation in one range (``conv_id, piece, before, n_turns``; ``before`` counts the turns
    of earlier pieces, ``n_turns`` those of the conversation).
    """
    digests = stored(digests, "digests")
    ranged = digests.repartitionByRange("conv_id", "turn", "key").withColumn("piece", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    along = Window.partitionBy("conv_id")
    pieces = ranged.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(along.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    pieces = stored(pieces.select("conv_id", "piece", F.coalesce(earlier, F.lit(0)).alias("before"), F.sum("n").over(along).alias("n_turns")), "pieces")
    place = F.row_number().over(Window.partitionBy("conv_id", "piece").orderBy("turn", "key"))
    rows = ranged.join(pieces.drop("n_turns"), ["conv_id", "piece"]).withColumn("pos", place - 1 + F.col("before"))
    return rows.select("conv_id", "piece", "pos", "key", "n_bytes"), pieces


def prefix_trie(turns: DataFrame, segment: int = SEGMENT, shard: int = SHARD, **columns: str) -> DataFrame:
    """The nodes of the trie of the conversations in ``turns``, as ``build_trie`` returns them."""
    rows, pieces = number_turns(digest_turns(turns, **columns))
    return build_trie(rows, pieces.select("conv_id").distinct(), segment, shard)


def build_trie(steps: DataFrame, conversations: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """One row per distinct prefix of the conversations, from the empty one (the root) on.

    ``steps`` has ``conv_id, pos, key, n_bytes``, positions from 0 without gaps;
    ``conversations`` all distinct ids, those without a turn included. A node is a sequence of
    keys; its members are the conversations that begin with it. Returned are ``conv_id``
    (smallest member), ``depth, parent_conv_id`` (null for the root), ``n_convs, n_children,
    n_leaves`` (nodes without children in its subtree, itself included), ``saved_tokens`` (sum
    over its subtree of members less one times ``n_bytes`` of the last turn) and
    ``ends_sha256`` (of the members that end there: ids in ascending order, joined by commas).

    - A prefix has a 128-bit digest, the XOR of a hash of position and key for each of its
      turns, so it grows along a conversation and can be carried from one segment of
      ``segment`` turns to the next. Digests that meet with different depths, parents or sizes
      stop the job.
    - Distinct digests are enumerated by a grouped count. The smallest member owns a node; what
      it owns is the end of its own path.
    - Segments of conversations are dealt over shards. A shard enumerates its own digests, gives
      each a slot by a minimal perfect hash that is verified against the digest stored there,
      scatters leaves, children and bytes saved into flat arrays and adds them up through the
      slots of the parents, deepest nodes first. Owners count for leaves and children, all
      other members for the bytes, so the sums of shards add up without a node being
      counted twice, whichever way the conversations are dealt.

    Rows without ``conv_id`` take no part, repeated rows are turns of their own, other columns are not
    read. Without a conversation there is no node, not even the root. A conversation of any
    length, a turn that all share and ids that end at one node are spread over tasks; only
    the SHA-256 over those ids runs in one, over text that others have joined.
    """
    position = F.col("pos").cast("long")
    steps = steps.select("conv_id", position.alias("pos"), F.expr(f"pos div {segment}").alias("seg"), "n_bytes", *[F.xxhash64(F.lit(k), position, "key").alias(f"v{k}") for k in (1, 2)])
    steps = stored(steps, "steps")
    paths, segments = _paths(steps)
    nodes = _nodes(paths, conversations)
    sums = _subtree_sums(paths, segments, nodes, segment, shard)
    nodes = stored(nodes.join(sums, ["a1", "a2"], "left").na.fill(0, ["n_children", "n_leaves", "saved_tokens"]), "summed")
    nodes = _with_parents(nodes)
    ends = paths.where("depth = len").select("a1", "a2", "conv_id")
    idle = conversations.join(segments.where("seg = 0").select("conv_id"), "conv_id", "left_anti")
    ends = _ends(ends.union(idle.select(F.lit(0).cast("long"), F.lit(0).cast("long"), "conv_id")))
    return nodes.join(ends, ["a1", "a2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _paths(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Digest and parent's digest of each prefix, and what is known of each segment."""
    own = [F.bit_xor(f"v{k}").alias(f"x{k}") for k in (1, 2)]
    segments = steps.groupBy("conv_id", "seg").agg(*own, F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    along = Window.partitionBy("conv_id")
    earlier = along.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.bit_xor(f"x{k}").over(earlier), F.lit(0)).alias(f"c{k}") for k in (1, 2)]
    segments = stored(segments.select("conv_id", "seg", "bytes", *carried, F.sum("n").over(along).alias("len")), "segments")
    inside = Window.partitionBy("conv_id", "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = steps.join(segments.drop("bytes"), ["conv_id", "seg"])
    rows = rows.select("*", *[F.bit_xor(f"v{k}").over(inside).bitwiseXOR(F.col(f"c{k}")).alias(f"a{k}") for k in (1, 2)])
    parents = [F.col(f"a{k}").bitwiseXOR(F.col(f"v{k}")).alias(f"p{k}") for k in (1, 2)]
    return stored(rows.select("conv_id", "seg", (F.col("pos") + 1).alias("depth"), "a1", "a2", *parents, "n_bytes", "len"), "paths"), segments


def _nodes(paths: DataFrame, conversations: DataFrame) -> DataFrame:
    same = F.xxhash64("depth", "p1", "p2", "n_bytes")
    clash = F.when(F.min(same) != F.max(same), F.raise_error(F.lit("two prefixes have one digest")))
    nodes = paths.groupBy("a1", "a2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[F.coalesce(clash.cast("long"), F.min(c)).alias(c) for c in ("depth",)],
        *[F.min(c).alias(c) for c in ("p1", "p2", "n_bytes")],
        (F.max("len") == F.min("depth")).alias("leaf"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("a1"), zero.alias("a2"), "conv_id", "n_convs", zero.alias("depth"), none.alias("p1"), none.alias("p2"), zero.alias("n_bytes"), F.lit(False).alias("leaf"))
    return stored(nodes.unionByName(root), "nodes")


_SUMS = "a1 long, a2 long, n_children long, n_leaves long, saved_tokens long"


def _subtree_sums(paths: DataFrame, segments: DataFrame, nodes: DataFrame, segment: int, shard: int) -> DataFrame:
    """Children of each node, and leaves and saved bytes of its subtree, summed over the shards."""
    owned = nodes.where("depth > 0").groupBy("conv_id", F.expr(f"(depth - 1) div {segment}").alias("seg")).agg(
        F.min("depth").alias("owns_from"), F.max(F.col("leaf").cast("long")).alias("leaf"), F.sum("n_bytes").alias("own_bytes")
    )
    rows = segments.select("conv_id", "seg", "bytes").join(owned, ["conv_id", "seg"], "left")
    rows = rows.select("conv_id", "seg", "owns_from", F.coalesce("leaf", F.lit(0)).alias("leaf"), (F.col("bytes") - F.coalesce("own_bytes", F.lit(0))).alias("saved"))
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("seg"))
    through = deeper.rowsBetween(Window.unboundedPreceding, 0)
    before = deeper.rowsBetween(Window.unboundedPreceding, -1)
    facts = rows.select(
        "conv_id", "seg", F.lit(0).cast("long").alias("depth"), "owns_from",
        F.sum("leaf").over(through).alias("leaves"), F.coalesce(F.sum("saved").over(before), F.lit(0)).alias("saved"),
    )
    both = paths.drop("len").unionByName(facts, allowMissingColumns=True)
    dealt = both.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "depth")
    return dealt.mapInArrow(_shards(segment, shard), _SUMS).groupBy("a1", "a2").agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])


def _shards(segment: int, rows: int):
    """Whole segments of conversations, about ``rows`` rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for table in whole_groups(batches, "conv_id", "seg"):
            some.append(table)
            n += table.num_rows
            if n >= rows:
                yield _shard(pa.concat_tables(some), segment)
                some, n = [], 0
        if some:
            yield _shard(pa.concat_tables(some), segment)

    return run


def _shard(table: pa.Table, length: int) -> pa.RecordBatch:
    def column(name, absent=0):
        return table[name].fill_null(absent).combine_chunks().to_numpy()

    depth = column("depth")
    facts, turns = np.flatnonzero(depth == 0), np.flatnonzero(depth > 0)
    segment = np.searchsorted(facts, turns) - 1
    last = turns[np.append(np.flatnonzero(np.diff(segment)), len(turns) - 1)]
    a1, a2, p1, p2 = (column(c)[turns].view(np.uint64) for c in ("a1", "a2", "p1", "p2"))
    depth = depth[turns]
    begins = (depth - 1) % length == 0  # their parents are the root, or with the segment before
    every1, every2 = np.concatenate([a1, p1[begins]]), np.concatenate([a2, p2[begins]])
    order = np.lexsort((every2, every1))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (every1[order][1:] != every1[order][:-1]) | (every2[order][1:] != every2[order][:-1])
    distinct = order[new]
    table_of = SlotTable(every1[distinct], every2[distinct])
    slots, parents = table_of.find(a1, a2), table_of.find(p1, p2)
    n = len(distinct)
    parent, deep = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
    parent[slots], deep[slots] = parents, depth
    children, totals = np.zeros(n, dtype=np.int64), np.zeros((n, 2), dtype=np.int64)
    owned = depth >= column("owns_from", 1 << 62)[facts][segment]
    np.add.at(children, parents[owned], 1)
    np.add.at(totals[:, 1], slots[~owned], column("n_bytes")[turns][~owned])
    ends = slots[np.searchsorted(turns, last)]
    np.add.at(totals[:, 0], ends, column("leaves")[facts])
    np.add.at(totals[:, 1], ends, column("saved")[facts])
    by_depth = np.argsort(deep, kind="stable")
    for d in np.unique(deep)[::-1]:
        if d == 1 or (d - 1) % length:  # sums of later segments have been carried to the end of this one
            level = by_depth[np.searchsorted(deep[by_depth], d) : np.searchsorted(deep[by_depth], d, side="right")]
            level = level[parent[level] >= 0]
            np.add.at(totals, parent[level], totals[level])
    columns = (table_of.a.view(np.int64), table_of.b.view(np.int64), children, totals[:, 0], totals[:, 1])
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in _SUMS.split(", ")])


class SlotTable:
    """Minimal perfect hash of distinct 128-bit digests, with the digest of each slot.

    On each level a digest that has a place of a bit array to itself keeps it, the others go
    on to the next level. A slot is the number of set bits before that place.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels, self.a, self.b = [], np.empty_like(a), np.empty_like(b)
        rest, base = np.arange(len(a)), 0
        while len(rest):
            if len(self.levels) == LEVELS:
                raise ValueError("digests are not distinct")
            size = 2 * len(rest)
            at = self._places(a[rest], b[rest], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            slots = base + np.cumsum(alone) - 1
            kept = alone[at]
            self.levels.append((size, alone, slots))
            self.a[slots[at[kept]]], self.b[slots[at[kept]]] = a[rest[kept]], b[rest[kept]]
            base += int(alone.sum())
            rest = rest[~kept]

    @staticmethod
    def _places(a, b, level, size):
        return (words.mix(a ^ words.mix(b + words.seeds(level + 1, salt=6)[level])) % np.uint64(size)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for one that the table doesn't hold."""
        found, rest = np.full(len(a), -1, dtype=np.int64), np.arange(len(a))
        for level, (size, alone, slots) in enumerate(self.levels):
            at = self._places(a[rest], b[rest], level, size)
            hit = alone[at]
            slot, of = slots[at[hit]], rest[hit]
            ok = (self.a[slot] == a[of]) & (self.b[slot] == b[of])
            found[of[ok]] = slot[ok]
            rest = rest[~hit]
        return found


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_conv_id``.

    The children of all nodes are as many as there are nodes, so at most ``HOT_PARENTS`` have
    more than that part of them. Those are broadcast, the children of others are joined.
    """
    hot = max(nodes.count() // HOT_PARENTS, 1000)
    parents = nodes.where("n_children > 0").select(F.col("a1").alias("p1"), F.col("a2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    crowded = parents.where(F.col("n_children") > hot).drop("n_children")
    nodes = nodes.join(F.broadcast(crowded.withColumnRenamed("parent_conv_id", "known")), ["p1", "p2"], "left")
    rest = nodes.where("known is null").drop("known").join(parents.where(F.col("n_children") <= hot).drop("n_children"), ["p1", "p2"], "left")
    return rest.unionByName(nodes.where("known is not null").withColumnRenamed("known", "parent_conv_id"))


def _ends(ends: DataFrame) -> DataFrame:
    """``a1, a2, ends_sha256`` of ``a1, a2, conv_id``."""
    ranged = stored(ends, "ends").repartitionByRange("a1", "a2", "conv_id").sortWithinPartitions("a1", "a2", "conv_id")

    def join(batches):
        for batch in batches:
            a1, a2, ids = (batch.column(k).to_numpy() for k in range(3))
            cuts = np.append(np.flatnonzero((np.diff(a1) != 0) | (np.diff(a2) != 0)) + 1, len(ids)) if len(ids) else []
            lo, out = 0, []
            for hi in cuts:
                out.append((a1[lo], a2[lo], ids[lo], ",".join(map(str, ids[lo:hi].tolist()))))
                lo = hi
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate([pa.int64()] * 3 + [pa.string()])], ["a1", "a2", "first", "ids"])

    joined = ranged.mapInArrow(join, "a1 long, a2 long, first long, ids string").repartition("a1", "a2").sortWithinPartitions("a1", "a2", "first")

    def digest(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for a1, a2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if node == (a1, a2):
                    state.update(b"," + ids.encode())
                    continue
                done += [(*node, state.hexdigest())] if node else []
                node, state = (a1, a2), hashlib.sha256(ids.encode())
            yield _digests(done)
        if node:
            yield _digests([(*node, state.hexdigest())])

    return joined.mapInArrow(digest, "a1 long, a2 long, ends_sha256 string")


def _digests(rows):
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["a1", "a2", "ends_sha256"])
