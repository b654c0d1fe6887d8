"""Registered plans: batch twins of the streaming operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import files as SF
from ..streaming import feeds as G
from ..streaming import trigger as TR
from ..streaming import upsert as U
from . import sqlfrag as S
from .chunk_plans import _sql_windows
from .common import r6, register, t
from .feedback_plans import _topic_sql
from .source_plans import _scratch


def _sql_trigger(strict: bool) -> str:
    elapsed = "floor(epoch(ts) - lt) % 86400" if strict else "epoch(ts) - lt"
    return f"""
WITH RECURSIVE ev AS (
  SELECT CAST(user_id AS VARCHAR) AS key, event_id, ts, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
win AS (SELECT *, avg(bad) OVER (PARTITION BY key ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS recent,
               avg(bad) FILTER (WHERE i <= 10) OVER (PARTITION BY key) AS old FROM ev),
fold AS (
  SELECT key, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS bc, epoch(min(ts)) AS lt, CAST(NULL AS VARCHAR) AS reason,
         CAST(NULL AS BIGINT) AS fired_bad FROM ev GROUP BY key
  UNION ALL
  SELECT f.key, w.i,
    CASE WHEN r.reason IS NULL THEN r.bc1 ELSE 0 END,
    CASE WHEN r.reason IS NULL THEN f.lt ELSE epoch(w.ts) END,
    r.reason, r.bc1
  FROM fold f JOIN win w ON w.key = f.key AND w.i = f.i + 1,
  LATERAL (SELECT f.bc + w.bad AS bc1,
      CASE WHEN f.bc + w.bad >= 20 THEN 'threshold'
           WHEN {elapsed.replace('ts', 'w.ts').replace('lt', 'f.lt')} >= 3600 AND f.bc + w.bad > 5 THEN 'interval'
           WHEN w.i > 20 AND w.recent > w.old * 1.5 THEN 'degradation' END AS reason) r)
SELECT f.key, w.event_id, w.ts, f.reason, f.fired_bad AS bad_count,
       CASE WHEN f.reason = 'degradation' THEN 2e-5 ELSE 1e-5 END AS learning_rate,
       CAST(CASE WHEN f.reason = 'degradation' THEN 5 ELSE 3 END AS INTEGER) AS epochs
FROM fold f JOIN win w ON w.key = f.key AND w.i = f.i WHERE f.reason IS NOT NULL
"""


@register("retrain_trigger_fold", sql=_sql_trigger(False))
def retrain_trigger_fold(spark, sf_dir):
    """G3 batch twin: trigger decisions per user over the ordered events."""
    e = t(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    return TR.retrain_trigger_batch(e, "user_id", "ts", "event_id", F.col("event_type") == "error")


@register("retrain_trigger_strict", sql=_sql_trigger(True))
def retrain_trigger_strict(spark, sf_dir):
    """G3 with the reference's ``timedelta.seconds`` interval quirk."""
    e = t(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    return TR.retrain_trigger_batch(e, "user_id", "ts", "event_id", F.col("event_type") == "error", strict_reference=True)


@register("periodic_changes", sql="""
SELECT time_bucket(INTERVAL '6 hours', ts) AS period_start, time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS period_end,
       event_type, CAST(count(*) AS BIGINT) AS n_changes FROM events GROUP BY ALL
""")
def periodic_changes(spark, sf_dir):
    """G4 batch twin: change counts per 6-hour period and change kind."""
    # event time stays timestamp_ntz: windows are cut on the wall-clock
    # value, independent of the session time zone
    e = t(spark, sf_dir, "events", ["ts", "event_type"])
    return G.periodic_changes(e, "ts", "6 hours", kind="event_type")


@register("job_counters", sql="""
SELECT CASE WHEN event_type IN ('view', 'click') THEN 'reindex' ELSE 'retrain' END AS job_name,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY ALL
""")
def job_counters(spark, sf_dir):
    """G5 batch twin: job outcome counters."""
    e = t(spark, sf_dir, "events", ["event_type"])
    jobs = e.select(F.when(F.col("event_type").isin("view", "click"), "reindex").otherwise("retrain").alias("job_name"),
                    F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"))
    return G.job_counters(jobs)


# --- streams over the tables, run to their end; the batch results are the oracles

def _stream(spark, sf_dir, name, cols):
    # a glob, as a stream's plain path has to be a folder and a table may be one file
    path = f"{sf_dir.rstrip('/')}/{name}.parque[t]"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path).select(*cols)


def _waves(df, order, n=3):
    """``df`` in ``n`` parts of about equal size that follow one another by
    ``order`` (nulls last), as the rows of a log arrive."""
    kind = df.schema[order].dataType
    bounds = df.agg(F.percentile_approx(order, [i / n for i in range(1, n)]).alias("b")).first()["b"] or []
    part = F.lit(n - 1)
    for i, bound in reversed(list(enumerate(bounds))):
        part = F.when(F.col(order) <= F.lit(str(bound)).cast(kind), i).otherwise(part)
    return [df.where(part == i) for i in range(n)]


def _run_waves(waves, spark, name, build):
    """Run the stream that ``build`` makes of the waves' folder each time a
    wave has arrived, on one state: every wave is a micro-batch (or several)
    of its own, and the query restarts from its checkpoint in between."""
    path = _scratch(spark, name)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    for wave in waves:
        wave.write.mode("append").parquet(f"{path}/in")
        stream = build(spark.readStream.schema(wave.schema).parquet(f"{path}/in"))
        (stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{path}/state")
         .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{path}/out").drop("batch")


def _run(stream, spark, name):
    """Run a stream over what is there; each batch replaces the whole result."""
    path = _scratch(spark, name)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/out")

    q = (stream.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{path}/state")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{path}/out")


@register("stream_retrain_trigger", sql=_sql_trigger(False))
def stream_retrain_trigger(spark, sf_dir):
    """The trigger as a stream over the events, which arrive in three waves."""
    e = t(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    return _run_waves(_waves(e, "ts"), spark, "trigger", lambda s: TR.retrain_trigger_stream(
        s, "user_id", "ts", "event_id", F.col("event_type") == "error", idle_seconds=3650 * 86400.0))


@register("stream_live_counters", sql=f"""
SELECT {_topic_sql("text")} AS category, CAST(count(*) FILTER (WHERE role = 'user') AS BIGINT) AS good,
       CAST(count(*) FILTER (WHERE role <> 'user') AS BIGINT) AS bad, CAST(count(*) AS BIGINT) AS total,
       round(avg(CAST(turn AS DOUBLE)), 6) AS avg_response_time
FROM conversations GROUP BY 1
""")
def stream_live_counters(spark, sf_dir):
    """G1 + G2: the turns as a CSV feedback log (user turns good), streamed
    into running counters per topic."""
    c = t(spark, sf_dir, "conversations")
    path = _scratch(spark, "live-log")
    SF.append_rows(c.select(F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), F.col("text").alias("query"),
                            F.col("text").alias("answer"), F.lit("log").alias("source"),
                            F.when(F.col("role") == "user", "good").otherwise("bad").alias("feedback"),
                            F.col("turn").cast("double").alias("response_time")), path)
    out = _run(G.live_counters(G.stream_feedback(spark, path, max_files_per_trigger=1)), spark, "live")
    return out.withColumn("avg_response_time", r6(F.col("avg_response_time")))


@register("stream_cache_split", sql="""
SELECT CASE WHEN l.doc_id IS NULL THEN 'miss' ELSE 'hit' END AS kind, e.user_id AS cache_key,
       CAST(CASE WHEN bool_or(l.doc_id IS NULL) THEN 1 ELSE count(*) END AS BIGINT) AS n
FROM events e LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = e.user_id
WHERE e.user_id IS NOT NULL GROUP BY 1, 2
""")
def stream_cache_split(spark, sf_dir):
    """Events, arriving in three waves, against a cache of the labelled
    ids: hits, and each missing key once."""
    e = t(spark, sf_dir, "events", ["ts", "user_id"]).where("user_id IS NOT NULL").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("user_id").alias("cache_key"))
    waves = _waves(e, "timestamp")
    cache = t(spark, sf_dir, "labels", ["doc_id"], spread_rows=False).select(F.col("doc_id").alias("cache_key")).distinct()
    both = [_run_waves(waves, spark, "cache", lambda s, i=i: G.stream_cache_split(s, cache, watermark="3650 days")[i].select("cache_key"))
            .groupBy("cache_key").agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit(kind).alias("kind"), "cache_key", "n")
            for i, kind in enumerate(("hit", "miss"))]
    return both[0].unionByName(both[1])


@register("stream_rolling_history", sql="""
SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(string_agg(text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn
       ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '') AS context FROM conversations
""")
def stream_rolling_history(spark, sf_dir):
    """The two turns before each turn, as a stream of three waves of turns."""
    c = t(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    return _run_waves(_waves(c, "turn"), spark, "history", lambda s: G.rolling_history(s, 2))


@register("stream_index", sql=f"""
SELECT * FROM ({_sql_windows("SELECT doc_id, " + S.clean_ocr("text") + " AS text FROM documents", 500, 450)})
""")
def stream_index(spark, sf_dir):
    """Documents streamed through cleaning and windows into an index table."""
    path = _scratch(spark, "index")
    G.incremental_index(_stream(spark, sf_dir, "documents", ["doc_id", "text"]), f"{path}/chunks", f"{path}/state").awaitTermination()
    return G.latest_chunks(spark, f"{path}/chunks").select("doc_id", "chunk_no", "chunk_text", "n_tokens")


@register("reindex_upsert", sql="""
WITH base AS (SELECT doc_id, max(text) AS text FROM documents GROUP BY doc_id),
bad AS (SELECT doc_id FROM labels WHERE toxic = 1), poor AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0 AND toxic = 0),
second AS (
  SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM poor) THEN concat(text, ' [edited]') ELSE text END AS text
  FROM base WHERE doc_id NOT IN (SELECT doc_id FROM bad))
SELECT doc_id, text FROM second WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id % 10 = 0)
UNION ALL SELECT -item_id - 1, text FROM benchmark
""")
def reindex_upsert(spark, sf_dir):
    """Three runs of the periodic re-index (the corpus; removals and edits;
    removals and additions) merged into a keyed table."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    lab = t(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"], spread_rows=False)
    b = t(spark, sf_dir, "benchmark", ["item_id", "text"], spread_rows=False)
    none = F.lit(None).cast("string").alias("text")

    def change(op, seq):
        return [F.lit(seq).cast("bigint").alias("seq"), F.lit(op).alias("op")]

    poor = lab.where("quality = 0 and toxic = 0").select("doc_id").distinct().join(d, "doc_id")
    waves = [d.select("doc_id", "text", *change("upsert", 0)),
             poor.select("doc_id", F.concat("text", F.lit(" [edited]")).alias("text"), *change("upsert", 1))
             .unionByName(lab.where("toxic = 1").select("doc_id", none, *change("delete", 2))),
             b.select((-F.col("item_id") - 1).alias("doc_id"), "text", *change("upsert", 3))
             .unionByName(lab.where("quality = 1 and doc_id % 10 = 0").select("doc_id", none, *change("delete", 4)))]
    path = _scratch(spark, "reindex")
    schema = d.schema
    for wave in waves:  # a scheduler's runs: changes arrive, then the stream catches up
        wave.write.mode("append").parquet(f"{path}/changes")
        changes = spark.readStream.schema(wave.schema).parquet(f"{path}/changes")
        U.stream_upsert(changes, f"{path}/index", f"{path}/state", schema, buckets=16, compact_every=2).awaitTermination()
    return U.read_index(spark, f"{path}/index", schema)
