"""What the operators of this subpackage share: text batches, staging and word patterns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"  # bytes.split() without arguments cuts at the same six characters
BATCH_ROWS = 1000            # texts a Python worker holds at once


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", binary: bool = True) -> DataFrame:
    """(doc_id, text): a null text counts as empty; other columns are left behind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (text.cast("binary") if binary else text).alias("text"))


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str | T.StructType) -> DataFrame:
    """fn over the rows of each partition, moved in Arrow batches of BATCH_ROWS rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in schema]
    types = [_arrow(f.dataType) for f in schema]

    def rows(batches):
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def run(batches):
        out, weight = [], 0
        for row in fn(rows(batches)):
            out.append(row)
            weight += 1 + sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(out) == 20_000 or weight > 1 << 24:
                yield _batch(out, names, types)
                out, weight = [], 0
        if out:
            yield _batch(out, names, types)

    return df.mapInArrow(run, schema)


def _batch(rows, names, types):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
            "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}[kind.simpleString()]


def id_field(df: DataFrame, name: str = "doc_id") -> T.StructField:
    return T.StructField(name, df.schema[name].dataType)
