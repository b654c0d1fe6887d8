"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrail.session import ensure_checkpoint_dir

#: Rows in one Arrow batch: bounds what a Python worker holds when texts are long.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def small_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batch size to BATCH_ROWS if it is larger."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return df


def narrow_batches(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """A larger Arrow batch for rows of a few numbers, until the next small_batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the n+1 offsets of its values
    (null counts as empty), without a Python object per value."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None and n else np.zeros(0, np.uint8)
    return raw, at - at[0]


def texts_of(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values: splitmix64's multipliers


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads the bits of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def crc_fold(column, folds: int):
    """crc32(column as text) mod folds."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(folds)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder, for tables
    that columns compress well; it is deleted when the session ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    # the shuffle files of a finished step go when the driver finds its plan unused
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    place, files = _place(spark, path)
    files.deleteOnExit(place)
    table = spark.read.schema(schema).parquet(path)
    _STORED[id(table)] = path
    return table


def scratch(spark: SparkSession, name: str) -> str:
    """The path of a new folder in the shared one; it is deleted when the session ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place, files = _place(spark, path)
    files.mkdirs(place.getParent())
    files.deleteOnExit(place)
    return path


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its rows in the same places each time it is read, so that
    numbers given by place name the same rows in every join: a plan that deals
    rows anew (its order may change with the columns read, or when a lost
    task runs again) becomes a stored table; tables stay as they are."""
    return stored(df) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def release(table: DataFrame) -> None:
    """Delete a stored table that no later step reads."""
    path = _STORED.pop(id(table), None)
    if path:
        place, files = _place(table.sparkSession, path)
        files.delete(place, True)


_STORED: dict[int, str] = {}


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
