"""Tables that cut lineage, and streams of whole groups inside a task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; local sessions without one (tests) get their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="netsieve-"))


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/netsieve-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    What a lost executor has to redo ends at such a table. The folder belongs to the caller,
    who deletes it when the job is over.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Tables that hold only whole groups, from batches whose rows are sorted by ``keys``.

    The last group of a batch waits for the next one, so a group is never cut.
    """
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and not _same(rest[-1], rest[-1].num_rows - 1, batch, batch.num_rows - 1, keys):
            cut = _last_group(batch, keys)
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        elif rest:
            rest.append(batch)
        else:
            cut = _last_group(batch, keys)
            if cut:
                yield pa.Table.from_batches([batch.slice(0, cut)])
            rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest)


def _same(a, i, b, j, keys) -> bool:
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in (a.schema.get_field_index(x) for x in keys))


def _last_group(batch: pa.RecordBatch, keys) -> int:
    """First row of the batch's last group."""
    last = batch.num_rows - 1
    equal = None
    for key in keys:
        column = batch.column(batch.schema.get_field_index(key))
        one = pc.fill_null(pc.equal(column, column[last]), False) if column[last].is_valid else column.is_null()
        equal = one if equal is None else pc.and_(equal, one)
    return pc.index(equal, True).as_py()
