"""Periodic re-indexing as an incremental upsert.

The index is a keyed table of the current rows, kept in ``buckets`` folders by
a hash of the key.  A batch of changes rewrites only the buckets that it
touches: their current files are read, the last change per key is applied, and
the result is written under a new version.  A manifest, one small file per
version, names the version that each bucket is at; readers follow the latest
manifest, so they see a batch whole or not at all, and a batch that is run
again (the same stream batch after a failure) finds its manifest and does
nothing, or overwrites what it left unfinished.

``compact`` deletes the bucket folders that no kept manifest names.

Only the manifest passes the driver: one number per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Manifest columns: the version in whose folder a bucket's rows stand.
MANIFEST = "bucket int, version bigint"


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, target: str) -> list[int]:
    """The finished versions of an index, oldest first (none if there is no index)."""
    place, files = _folder(spark, f"{target}/manifest")
    if not files.exists(place):
        return []
    found = []
    for s in files.listStatus(place):
        name = s.getPath().getName()
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
        if name.startswith("v=") and files.exists(done):
            found.append(int(name[2:]))
    return sorted(found)


def _manifest(spark: SparkSession, target: str, version: int | None) -> dict[int, int]:
    if version is None:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(f"{target}/manifest/v={version}").collect()  # bounded: one row per bucket
    return {r["bucket"]: r["version"] for r in rows}


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, target: str, at: dict[int, int], schema) -> DataFrame:
    """The rows of the buckets in ``at``, each from its version's folder."""
    paths = [f"{target}/data/version={v}/bucket={b}" for b, v in sorted(at.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_index(spark: SparkSession, target: str, schema, version: int | None = None) -> DataFrame:
    """The current rows of an index, or those of an older kept ``version``."""
    kept = versions(spark, target)
    if version is not None and version not in kept:
        raise ValueError(f"version {version} is not kept")
    return _read(spark, target, _manifest(spark, target, version if version is not None else (kept[-1] if kept else None)), schema)


def last_changes(changes: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, that of the greatest ``order`` (among equals the
    greatest row), by a partial aggregate: a hot key meets nowhere."""
    rest = [c for c in changes.columns if c not in (key, order)]
    best = F.max(F.struct(order, *rest)).alias("_last")
    return changes.groupBy(key).agg(best).select(key, "_last.*")


def upsert(changes: DataFrame, target: str, version: int, schema, key: str = "doc_id", order: str = "seq", op: str = "op", buckets: int = 64) -> int:
    """Apply ``changes`` (the table's columns, ``order`` and ``op``: ``upsert``
    or ``delete``) as ``version``; how many buckets were rewritten.

    The last change per key counts (greatest ``order``); a deleted key that is
    not there, and a delete of a key added by the same batch, leave nothing.
    A version at or below the latest finished one was applied before: nothing
    happens.  Rows with a null key are kept as one key.  The first call makes
    the table; later ones must name the same ``buckets``.
    """
    spark = changes.sparkSession
    done = versions(spark, target)
    if done and version <= done[-1]:
        return 0
    at = _manifest(spark, target, done[-1] if done else None)
    last = last_changes(changes, key, order).withColumn("_bucket", _bucket(key, buckets)).checkpoint(eager=True)
    touched = sorted(r["_bucket"] for r in last.select("_bucket").distinct().collect())  # bounded: buckets
    names = [f.name for f in schema.fields]
    old = _read(spark, target, {b: v for b, v in at.items() if b in set(touched)}, schema)
    stay = old.join(last.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    new = last.where(F.col(op) != "delete").select(*names)
    rows = stay.unionByName(new).withColumn("bucket", _bucket(key, buckets))
    # a bucket is one task's file or, if Spark splits it, several
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/data/version={version}")
    place, files = _folder(spark, f"{target}/data/version={version}")
    for b in touched:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, f"bucket={b}")
        if files.exists(path):
            at[b] = version
        else:  # every row of the bucket was deleted
            at.pop(b, None)
    manifest = spark.createDataFrame(sorted(at.items()), MANIFEST).coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{target}/manifest/v={version}")
    return len(touched)


def compact(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` manifests, and the bucket folders that
    none of these names; how many folders went.  Readers of older versions
    must have ended."""
    kept = versions(spark, target)[-keep:]
    named = {(v, b) for k in kept for b, v in _manifest(spark, target, k).items()}
    gone = 0
    place, files = _folder(spark, f"{target}/manifest")
    if files.exists(place):
        for s in files.listStatus(place):
            if s.getPath().getName().startswith("v=") and int(s.getPath().getName()[2:]) not in kept:
                files.delete(s.getPath(), True)
    place, files = _folder(spark, f"{target}/data")
    if kept and files.exists(place):
        for v in files.listStatus(place):
            number = int(v.getPath().getName().removeprefix("version="))
            if number > kept[-1]:
                continue  # being written
            inside = [b for b in files.listStatus(v.getPath()) if b.getPath().getName().startswith("bucket=")]
            idle = [b for b in inside if (number, int(b.getPath().getName()[7:])) not in named]
            for b in idle:
                files.delete(b.getPath(), True)
                gone += 1
            if len(idle) == len(inside):
                files.delete(v.getPath(), True)
    return gone


def stream_upsert(changes: DataFrame, target: str, checkpoint: str, schema, key: str = "doc_id", order: str = "seq", op: str = "op",
                  buckets: int = 64, compact_every: int = 10):
    """Start the re-indexing of a change stream: what has arrived since the
    last run is merged batch by batch (run it from a scheduler every few
    hours; it ends when it has caught up), old versions are compacted every
    ``compact_every`` batches.  A batch's number is its version, so an index
    and a checkpoint folder belong together; later batches count as later
    changes, whatever their ``order``."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, target, batch_id, schema, key, order, op, buckets)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, target)

    return changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def apply_changes(table: DataFrame, changes: DataFrame, key: str = "doc_id", order: str = "seq", op: str = "op") -> DataFrame:
    """The batch twin: ``table`` after all ``changes``."""
    last = last_changes(changes, key, order)
    stay = table.join(last.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return stay.unionByName(last.where(F.col(op) != "delete").select(*table.columns))
