"""Words, hashes and Arrow batches shared by the corpus operators.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``, which is exactly
what ``bytes.split`` yields; ``bytes.lower`` changes A-Z only. Texts therefore
travel as binary columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import configure

SPACE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Rows of a batch sent to a Python worker: with texts of up to some MB each a
# batch stays far below the worker's memory.
BATCH_ROWS = "400"


def prepare(spark: SparkSession, batch_rows: str = BATCH_ROWS) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    return spark


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def hash64(data: bytes) -> int:
    """The value of Spark's ``xxhash64`` over one binary or string column."""
    return signed(xxhash.xxh64_intdigest(data, 42))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of an id's decimal text modulo ``n``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(-1))


def crc_of(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def raw(name: str) -> Column:
    """A text column as bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def map_lists(df: DataFrame, make: Callable[[], Callable], ddl: str) -> DataFrame:
    """Run ``make()`` once per task; the function it returns takes each batch's
    columns as lists and returns the columns of ``ddl`` as lists or arrays."""
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches):
        step = make()
        for batch in batches:
            out = step(*[c.to_pylist() for c in batch.columns])
            if len(out[0]):
                arrays = [pa.array(v, type=f.type) for v, f in zip(out, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)
