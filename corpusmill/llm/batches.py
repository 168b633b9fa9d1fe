"""Arrow batches between Spark and small Python helpers, and tables that outlive a lost executor."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text that a helper is handed at once; a longer single text comes alone.
SLICE_BYTES = 4_000_000


def slices(batch: pa.RecordBatch, column: int, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds at most max_bytes of the given column, or one row."""
    size = batch.column(column).nbytes
    step = max(1, batch.num_rows * max_bytes // max(1, size)) if batch.num_rows else 1
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_rows(df: DataFrame, inputs: list[str], keep: int, results: list[T.StructField], make: Callable[[], Callable[..., list]]) -> DataFrame:
    """Run a per-task helper over slices of columns.

    df: any table; of its columns only `inputs` are read, so others never clash. keep: so many leading inputs
    are returned unchanged before the results. make(): called once in a task, gives f(*columns as lists) that
    returns one list for each result.
    """
    picked = df.select(*inputs)
    schema = T.StructType([*picked.schema.fields[:keep], *results])
    arrow = to_arrow_schema(schema)
    last = len(inputs) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        helper = make()
        for batch in batches:
            for piece in slices(batch, last):
                found = helper(*(piece.column(i).to_pylist() for i in range(keep, len(inputs))))
                columns = [piece.column(i).cast(arrow.field(i).type) for i in range(keep)]
                columns += [pa.array(x, arrow.field(keep + i).type) for i, x in enumerate(found)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return picked.mapInArrow(run, schema)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names. One is set here only on a single machine, as in tests."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or f"/tmp/checkpoints/{sc.applicationId}")


def shared_folder(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, *partitions: str, dictionary: bool = True) -> tuple[DataFrame, str]:
    """df written to the shared folder as compressed Parquet and read again, and its path for discard(). dictionary: worth trying; tables of hashes only lose time by it."""
    path = shared_folder(df.sparkSession)
    df.write.partitionBy(*partitions).option("parquet.enable.dictionary", dictionary).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of tables that nothing refers to any more; checkpoints too, where
    spark.cleaner.referenceTracking.cleanCheckpoints is on."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
