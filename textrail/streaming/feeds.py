"""Structured Streaming operators.

Each streaming operator has a batch twin of the same name in
:mod:`textrail.operators` (or here, for the windowed counts) that serves as
its oracle: the same transformation applied to the same rows as a table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_ocr, topic
from ..operators.chunking import token_window
from ..session import compute_once

FEEDBACK_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("query", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("feedback", T.StringType()),
    T.StructField("response_time", T.DoubleType()),
])


def stream_feedback(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = FEEDBACK_SCHEMA,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """G1: append-only feedback log as a stream (explicit schema; CSV
    fields may be quoted and span lines)."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("multiLine", True).option("escape", '"')
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def live_counters(sdf: DataFrame, query: str = "query", label: str = "feedback", rt: str = "response_time") -> DataFrame:
    """Running good / bad / total and mean response time per keyword
    category (use with ``outputMode("update")`` or ``"complete"``)."""
    good = F.sum(F.when(F.lower(F.col(label)) == "good", 1).otherwise(0))
    return (sdf.withColumn("category", topic(query)).groupBy("category")
            .agg(good.cast("bigint").alias("good"), (F.count(F.lit(1)) - good).cast("bigint").alias("bad"),
                 F.count(F.lit(1)).cast("bigint").alias("total"), F.avg(rt).alias("avg_response_time")))


def periodic_changes(df: DataFrame, ts: str, period: str = "6 hours", kind: str | None = None,
                     watermark: str | None = None) -> DataFrame:
    """Change counts per period window (and per change kind); works on a
    batch table or, with ``watermark``, on a stream in append mode."""
    src = df.withWatermark(ts, watermark) if watermark else df
    keys = [F.window(ts, period).alias("period")] + ([F.col(kind)] if kind else [])
    return (src.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_changes"))
            .select(F.col("period.start").alias("period_start"), F.col("period.end").alias("period_end"),
                    *([kind] if kind else []), "n_changes"))


def job_counters(df: DataFrame, job: str = "job_name", status: str = "status") -> DataFrame:
    """Job outcome counters (batch or streaming aggregate)."""
    return df.groupBy(job, status).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def stream_cache_split(sdf: DataFrame, cache: DataFrame, key: str = "cache_key", ts: str = "timestamp",
                       watermark: str = "1 hour") -> tuple[DataFrame, DataFrame]:
    """Cache hits (stream-static inner join) and new, de-duplicated
    misses (anti join + ``dropDuplicatesWithinWatermark``)."""
    hits = sdf.join(cache, key, "inner")
    misses = (sdf.join(cache.select(key), key, "left_anti")
              .withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key]))
    return hits, misses


HISTORY_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("context", T.StringType()),
])


def rolling_history(sdf: DataFrame, n: int = 2, key: str = "conv_id", order: str = "turn", text: str = "text",
                    ts: str | None = None, watermark: str = "1 hour", idle_seconds: float = 30 * 86400.0) -> DataFrame:
    """For every incoming turn, the text of the previous ``n`` turns of
    its conversation (list state of ``n`` entries per key; null texts are
    left out).

    With ``ts``, turns older than the watermark are dropped and a
    conversation's state ends once the watermark is ``idle_seconds`` past its
    last turn.  Without it the state stays, as there is no time to end it by."""
    src = sdf.select(F.col(key).cast("long").alias("conv_id"), F.col(order).cast("long").alias("turn"),
                     F.col(text).alias("text"), *([F.col(ts).cast("timestamp").alias("_wm")] if ts else []))
    if ts:
        src = src.withColumn("_ms", F.unix_millis("_wm")).withWatermark("_wm", watermark)

    def fn(k, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        prev = list(state.get[0]) if state.exists else []
        rows = []
        frames = [p for p in pdfs]
        if frames:
            pdf = pd.concat(frames).sort_values("turn")
            for tn, tx in zip(pdf["turn"], pdf["text"]):
                rows.append((k[0], int(tn), "\n".join(x for x in prev if x is not None)))
                prev = (prev + [tx])[-n:]
            if ts:
                state.setTimeoutTimestamp(max(int(pdf["_ms"].max()), state.getCurrentWatermarkMs()) + int(idle_seconds * 1000))
        state.update((prev,))
        yield pd.DataFrame(rows, columns=["conv_id", "turn", "context"])

    state_schema = T.StructType([T.StructField("last", T.ArrayType(T.StringType()))])
    return src.groupBy("conv_id").applyInPandasWithState(fn, HISTORY_SCHEMA, state_schema, "append",
                                                         "EventTimeTimeout" if ts else "NoTimeout")


def incremental_index(sdf: DataFrame, target: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text",
                      size: int = 500, overlap: int = 50, trigger_once: bool = True):
    """New and changed documents -> layout-OCR cleaning -> token windows in
    a parquet table with one ``batch_id`` folder per micro-batch.

    A batch that is run again replaces its own folder, so a failure between
    write and commit leaves no second copy.  The ids of documents without text
    go to the table ``<target>.blank``.  :func:`latest_chunks` gives each
    document's chunks from its last batch."""
    target = target.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = compute_once(batch.select(id_col, text_col), "_t", F.coalesce(clean_ocr(text_col), F.lit("")))
        chunks = token_window(docs.where(F.col("_t") != ""), id_col, "_t", size, overlap, global_ids=False)
        chunks.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        docs.where(F.col("_t") == "").select(id_col).write.mode("overwrite").parquet(f"{target}.blank/batch_id={batch_id}")

    w = sdf.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def latest_chunks(spark: SparkSession, target: str, id_col: str = "doc_id") -> DataFrame:
    """The current chunks of a table kept by :func:`incremental_index`: those
    of each document's last batch (none if it has become empty)."""
    table, blank = spark.read.parquet(target), spark.read.parquet(f"{target.rstrip('/')}.blank")
    last = (table.select(id_col, "batch_id").union(blank.select(id_col, "batch_id"))
            .groupBy(id_col).agg(F.max("batch_id").alias("batch_id")))
    return table.join(last, [id_col, "batch_id"])
