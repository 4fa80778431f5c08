"""Repeated passages of three lines, found by overlapping windows over the whole corpus."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm.columns import add_columns, free_name, position
from netsieve.llm.store import stored
from netsieve.operators.skew import join_counted

LINES = 3


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES) -> DataFrame:
    """``docs`` with ``text`` cut, and ``n_lines, n_removed``.

    A window is ``lines`` consecutive lines (parts between line feeds, compared as they
    are). Of all equal windows in the corpus the one with the smallest (id, text hash, line)
    stays; the lines that any later one covers are removed, overlapping windows merged. A
    line that goes has an equal line earlier in that order, so no line vanishes from the
    corpus altogether. Lines are joined again by line feeds.

    Null texts stay null and have 0 lines, an empty text has one. Texts with fewer lines than
    a window are left alone; a text that loses all its lines becomes empty. Rows equal in id
    and text count as one and keep the same lines. Null ids come first in the order. An empty
    table gives an empty result. Columns named ``n_lines`` and ``n_removed`` give way to the results.

    Windows move as 128-bit hashes. A window that makes up much of the corpus is counted
    before the shuffle, and its rows stay where they are in the join.
    """
    # two hashes tell rows apart, as they do for windows
    row = F.struct(F.xxhash64(id_col, text_col).alias("a"), F.xxhash64(F.lit(1), id_col, text_col).alias("b"))
    rows = docs.select(F.col(id_col).alias("id"), row.alias("row"), F.col(text_col).alias("text"))
    id_type = docs.schema[position(docs, id_col)].dataType.simpleString()
    windows = stored(rows.mapInArrow(_windows(lines), f"h1 long, h2 long, id {id_type}, row struct<a:long,b:long>, line int"), "windows")
    place = F.struct("id", "row", "line")
    repeated = stored(windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"), "repeated")
    later = join_counted(windows, repeated, ["h1", "h2"], "n", "inner").where(~place.eqNullSafe(F.col("first")))
    key, gone = free_name(docs, "_row"), free_name(docs, "_later")
    covered = later.groupBy(F.col("row").alias(key)).agg(F.sort_array(F.collect_set("line")).alias(gone))
    marked = docs.withColumn(key, row).join(covered, key, "left").drop(key)
    at, text = position(marked, gone), position(marked, text_col)
    name = marked.columns[text]
    cut = add_columns(marked, _cutter(text, at, lines), f"`{name}` string, n_lines long, n_removed long", replaced=(gone,))
    return cut.select(*[f"`{c}`" for c in docs.columns if c.lower() not in ("n_lines", "n_removed")], "n_lines", "n_removed")


def _windows(lines):
    def run(batches):
        for batch in batches:
            h1, h2, rows, at = [], [], [], []
            for k, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                parts = text.split(b"\n") if text is not None else []
                for i in range(len(parts) - lines + 1):
                    digest = xxhash.xxh3_128_intdigest(b"\n".join(parts[i : i + lines]))
                    h1.append((digest >> 64) - (1 << 63))
                    h2.append((digest & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                    rows.append(k)
                    at.append(i)
            rows = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at, pa.int32())],
                ["h1", "h2", "id", "row", "line"],
            )

    return run


def _cutter(text, at, lines):
    def cut(batch):
        kept, total, removed = [], [], []
        for value, later in zip(batch.column(text).cast(pa.binary()).to_pylist(), batch.column(at).to_pylist(), strict=True):
            n = value.count(b"\n") + 1 if value is not None else 0
            gone = {k + j for k in later for j in range(lines)} if later else ()
            if gone:
                value = b"\n".join(x for k, x in enumerate(value.split(b"\n")) if k not in gone)
            kept.append(value)
            total.append(n)
            removed.append(len(gone))
        return [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())]

    return cut
