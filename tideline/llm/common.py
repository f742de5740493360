"""What the corpus operators share: the shared work folder and column checks."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows, and bytes of text, that a Python worker holds as objects at a time; a longer text comes alone.
SLICE, SLICE_BYTES = 1000, 2_000_000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: The word pattern of the contracts, as Java and Python regular expressions read it.
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, else one of our own (local runs only)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        set_before = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = set_before.get() if set_before.isDefined() else None
    if not path:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends here, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    small_batches(spark)
    df.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Deletes what ``stored`` wrote, once nothing reads it any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch than by default, unless the session sets a number: whole texts are large rows."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(2 * SLICE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (long) and text (string, null as empty); all other columns are left behind, so none can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def by_columns(df: DataFrame, made: Callable[..., Sequence[Sequence]], schema: str) -> DataFrame:
    """mapInArrow over plain lists: made gets a list for each column of a batch and returns those of the result.

    Unlike pandas, this keeps null and 64-bit ids as they are. A batch holds a bounded number of rows and bytes.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))
    small_batches(df.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield to_batch(made(*(c.to_pylist() for c in batch.columns)), fields)

    return df.mapInArrow(rows, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE, n_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of up to ``rows`` rows and about ``n_bytes`` bytes, so that few texts are Python objects at a time.

    At the end of the task what it used goes back to the system: workers are used again, for other operators too.
    """
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        sums = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            full = int(np.searchsorted(sums, (sums[at - 1] if at else 0) + n_bytes, "right"))
            stop = min(max(at + 1, full), at + rows)
            yield batch.slice(at, stop - at)
            at = stop
    release()


def release() -> None:
    """Unused memory of this worker, back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def to_batch(columns: Sequence[Sequence], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type, from_pandas=False) for c, f in zip(columns, fields, strict=True)], schema=fields)


def columns_of(rows: Sequence[tuple], n: int) -> list[Sequence]:
    """Rows as n columns."""
    return list(zip(*rows, strict=True)) if rows else [[] for _ in range(n)]
