"""Columns that a Python function adds to the rows of a table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType, _parse_datatype_string


def add_columns(df: DataFrame, fn, added: str, replaced: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns of the schema string ``added``, in one narrow pass.

    ``fn`` gets a record batch and returns one array per added column. A column of ``df`` with
    the name of an added one gives way, whatever its case; the names in ``replaced`` are
    dropped too.
    """
    new = _parse_datatype_string(added)
    gone = {f.name.lower() for f in new} | {x.lower() for x in replaced}
    kept = [i for i, f in enumerate(df.schema) if f.name.lower() not in gone]
    schema = StructType([df.schema[i] for i in kept] + list(new))
    names = schema.fieldNames()

    def run(batches):
        for batch in batches:
            arrays = [batch.column(i) for i in kept] + list(fn(batch))
            yield pa.RecordBatch.from_arrays(arrays, names)

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def position(df: DataFrame, name: str) -> int:
    """Place of a column, by its name in any case."""
    return [f.name.lower() for f in df.schema].index(name.lower())
