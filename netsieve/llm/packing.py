"""Best-fit packing of documents into sequences of bounded length, with conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm import words
from netsieve.llm.columns import add_columns, position
from netsieve.llm.store import stored, whole_groups

CAPACITY = 2048  # words of a sequence
SHARD = 8192  # pieces that one task packs against each other, on average


def count_words(docs: DataFrame, text_col: str = "text", out: str = "n_words") -> DataFrame:
    """``docs`` with the number of blank-separated words of the whole text; null has none."""
    at = position(docs, text_col)

    def count(batch):
        parts = [np.zeros(0, dtype=np.int64)]
        for _, data, offsets in words.slices(batch.column(at)):
            parts.append(np.diff(words.split(data, offsets, words.BLANK)[2]))
        return [pa.array(np.concatenate(parts).astype(np.int64))]

    return add_columns(docs, count, f"{out} long")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None
) -> DataFrame:
    """One row per piece: ``doc_id, piece, first_word, n_words, bin_id, bin_words``.

    A document is cut into pieces of ``capacity`` words; full ones are bins of their own, the
    last one is packed. Pieces go by falling length into the bin with the least room left that
    still fits and has neither their source nor their duplicate cluster: bins stand in order
    of room, each with a bitmap of sources and one of clusters, and the search moves on to the
    next larger room until a bin agrees; if none does, a new one opens. The cluster is
    ``cluster_col`` or else the hash of the text, so equal texts never share a bin. Pieces of
    one document share a cluster too.

    Pieces are dealt over shards of about ``SHARD`` by the hash of all they are, which splits a
    source or cluster of any size evenly; each shard is packed on its own and may leave its
    last bins open. Null sources and clusters are no conflict. Documents without words have one
    row without a bin. Repeated rows are packed each, in different bins. An empty table gives
    an empty result; other columns are not read.
    """
    cluster = F.xxhash64(text_col) if cluster_col is None else F.xxhash64(cluster_col)
    of_cluster = F.col(text_col if cluster_col is None else cluster_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.when(of_cluster.isNotNull(), cluster).alias("cluster"),
        F.col(text_col).alias("text"),
    )
    counted = stored(count_words(rows).drop("text").withColumn("salt", F.monotonically_increasing_id()), "lengths")
    size = F.lit(int(capacity))
    full = F.floor(F.col("n_words") / size)
    tails = counted.withColumn("piece", full).withColumn("n_words", F.col("n_words") % size).where("n_words > 0")
    n_tails = tails.count()
    shards = max(-(-n_tails // SHARD), 1)
    tails = tails.withColumn("shard", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(shards)).cast("int"))
    ordered = tails.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("n_words"), "doc_id", "salt")
    id_type = counted.schema["doc_id"].dataType.simpleString()
    packed = ordered.select("doc_id", "piece", "n_words", "source", "cluster", "shard").mapInArrow(
        _packer(capacity), f"doc_id {id_type}, piece long, n_words long, bin_id string, bin_words long"
    )
    whole = counted.where(F.col("n_words") >= size).select(
        "doc_id", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("piece"), size.cast("long").alias("n_words"), "salt"
    )
    whole = whole.select("doc_id", "piece", "n_words", F.concat_ws("-", F.lit("w"), "salt", "piece").alias("bin_id"), size.cast("long").alias("bin_words"))
    none = counted.where("n_words = 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), "n_words", F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("long").alias("bin_words")
    )
    return packed.unionByName(whole).unionByName(none).select("doc_id", "piece", (F.col("piece") * size).alias("first_word"), "n_words", "bin_id", "bin_words")


def _packer(capacity):
    def run(batches):
        for table in whole_groups(batches, "shard"):
            shards = table["shard"].to_numpy()
            cuts = np.flatnonzero(np.diff(shards)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(shards)], strict=True):
                part = table.slice(lo, hi - lo)
                bins, used = best_fit(part["n_words"].to_pylist(), part["source"].to_pylist(), part["cluster"].to_pylist(), capacity)
                names = [f"{shards[lo]}-{b}" for b in bins]
                arrays = [part[c].combine_chunks() for c in ("doc_id", "piece", "n_words")]
                arrays += [pa.array(names, pa.string()), pa.array([used[b] for b in bins], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "n_words", "bin_id", "bin_words"])

    return run


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """The bin of each piece, in the order given, and the words in each bin."""
    source_bits, cluster_bits = _bits(sources), _bits(clusters)
    open_: list[tuple[int, int]] = []  # (room, bin), in order
    held_sources, held_clusters, used, chosen = [], [], [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = source_bits.get(source, 0), cluster_bits.get(cluster, 0)
        at = bisect_left(open_, (size, -1))
        while at < len(open_) and (held_sources[open_[at][1]] & s or held_clusters[open_[at][1]] & c):
            at += 1
        if at < len(open_):
            room, b = open_.pop(at)
        else:
            room, b = capacity, len(used)
            held_sources.append(0)
            held_clusters.append(0)
            used.append(0)
        held_sources[b] |= s
        held_clusters[b] |= c
        used[b] += size
        chosen.append(b)
        if room > size:
            insort(open_, (room - size, b))
    return chosen, used


def _bits(values) -> dict:
    """A bit for each value that occurs more than once; others can't conflict."""
    often = [v for v, n in Counter(values).items() if n > 1 and v is not None]
    return {v: 1 << k for k, v in enumerate(often)}
