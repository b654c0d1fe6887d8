"""Adaptive retraining trigger (G3): one state machine per key.

After every feedback event the state is updated and three rules are
checked in order; the first that holds fires a (re)training:

1. ``threshold``: bad feedback since the last training >= 20;
2. ``interval``: at least 3600 s since the last training and more than 5
   bad feedbacks since then;
3. ``degradation``: more than 20 events seen and the bad ratio of the last
   10 events exceeds 1.5 x the bad ratio of the first 10 events (the event
   buffer is never cleared, so the first 10 stay fixed).

On a fire the bad counter resets to 0 and the training time becomes the
event time (training is treated as instantaneous).  With
``training_seconds > 0`` a training instead runs for that long: triggers
during it are ignored, and at its end the bad counter resets (dropping the
bad feedback counted meanwhile) and the training time becomes the end
time, as in the reference's background training.  Event time comes from
the rows, never from the wall clock.  ``strict_reference=True`` measures
the interval like ``timedelta.seconds`` (whole days dropped).

The same :class:`TriggerState` step drives the batch fold (secondary sort +
``mapInPandas``: bounded memory, a key's events stream through one task in
order - the rules are sequential by definition) and the streaming operator
(``applyInPandasWithState``: O(1) state per key across micro-batches).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values ----------------------------------------------------------
BAD_THRESHOLD = 20
INTERVAL_SECONDS = 3600
INTERVAL_MIN_BAD = 5
WINDOW = 10
DEGRADATION_FACTOR = 1.5
# learning rate / epochs chosen for a fire: degradation vs other reasons
TRAINING_PARAMS = {"degradation": (2e-5, 5), "other": (1e-5, 3)}
# ---------------------------------------------------------------------------
#: What a missing time is as a number.
NO_TIME = -(1 << 63)

OUTPUT_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("reason", T.StringType()),
    T.StructField("bad_count", T.LongType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("epochs", T.IntegerType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("bad", T.LongType()),
    T.StructField("last_train", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("first", T.StringType()),
    T.StructField("recent", T.StringType()),
    T.StructField("busy_until", T.DoubleType()),
])


@dataclass
class TriggerState:
    bad: int = 0
    last_train: float | None = None      # epoch seconds
    n: int = 0
    first: list = field(default_factory=list)
    recent: list = field(default_factory=list)
    busy_until: float | None = None      # end of a running training

    def step(self, ts: float, is_bad: bool, strict_reference: bool = False,
             training_seconds: float = 0.0) -> tuple[str, int] | None:
        if self.last_train is None:
            self.last_train = ts
        if self.busy_until is not None and ts >= self.busy_until:
            self.bad = 0                       # the running training completed
            self.last_train = self.busy_until
            self.busy_until = None
        self.n += 1
        if is_bad:
            self.bad += 1
        if len(self.first) < WINDOW:
            self.first.append(1 if is_bad else 0)
        self.recent.append(1 if is_bad else 0)
        if len(self.recent) > WINDOW:
            self.recent.pop(0)
        elapsed = ts - self.last_train
        if strict_reference:
            elapsed = float(int(elapsed) % 86400)
        reason = None
        if self.bad >= BAD_THRESHOLD:
            reason = "threshold"
        elif elapsed >= INTERVAL_SECONDS and self.bad > INTERVAL_MIN_BAD:
            reason = "interval"
        elif self.n > 2 * WINDOW and (sum(self.recent) / len(self.recent)) > (sum(self.first) / len(self.first)) * DEGRADATION_FACTOR:
            reason = "degradation"
        if reason is None or self.busy_until is not None:
            return None                        # nothing fired, or ignored while training
        fired_bad = self.bad
        if training_seconds > 0:
            self.busy_until = ts + training_seconds
        else:
            self.bad = 0
            self.last_train = ts
        return reason, fired_bad

    def to_row(self) -> tuple:
        return (self.bad, self.last_train, self.n, ",".join(map(str, self.first)), ",".join(map(str, self.recent)),
                self.busy_until)

    @classmethod
    def from_row(cls, row) -> "TriggerState":
        def ints(s):
            return [int(x) for x in s.split(",")] if s else []
        return cls(int(row[0]), row[1], int(row[2]), ints(row[3]), ints(row[4]), row[5])


def _out_row(key, eid, ts, reason, bad):
    lr, ep = TRAINING_PARAMS["degradation" if reason == "degradation" else "other"]
    return (key, eid, ts, reason, bad, lr, ep)


def _seconds(ts: pd.Series) -> list[float]:
    """Seconds of a column of wall-clock times, converted at once."""
    return (ts.to_numpy("datetime64[us]").astype("int64") / 1e6).tolist()


def _event(text: str) -> list:
    """(microseconds, event, bad, milliseconds) of a row's text."""
    return [int(x) if x else None for x in text.split(",")]


def _prepare(df: DataFrame, key: str, ts: str, event_id: str, bad: F.Column) -> DataFrame:
    # event time as timestamp_ntz: the rules see wall-clock seconds, whatever
    # the session time zone (no daylight-saving jumps in the differences)
    return df.select(F.col(key).cast("string").alias("key"), F.col(event_id).cast("long").alias("event_id"),
                     F.col(ts).cast("timestamp_ntz").alias("ts"), bad.cast("boolean").alias("is_bad"))


def retrain_trigger_batch(df: DataFrame, key: str, ts: str, event_id: str, bad: F.Column,
                          strict_reference: bool = False, partitions: int | None = None,
                          training_seconds: float = 0.0) -> DataFrame:
    """Batch twin of the trigger: one row per fired training.

    Rows are hash-partitioned by key and sorted within partitions by
    (key, ts, event_id) - an external sort that spills, not a gather - and
    a ``mapInPandas`` pass streams each key's events through the state
    machine, carrying state across Arrow batches.
    """
    prepared = _prepare(df, key, ts, event_id, bad)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = prepared.repartition(n, "key").sortWithinPartitions("key", "ts", "event_id")

    def run(batches):
        cur_key, state = None, None
        for pdf in batches:
            out = []
            for k, eid, t, second, b in zip(pdf["key"], pdf["event_id"], pdf["ts"], _seconds(pdf["ts"]), pdf["is_bad"].tolist()):
                if k != cur_key:
                    cur_key, state = k, TriggerState()
                fired = state.step(second, bool(b), strict_reference, training_seconds)
                if fired:
                    out.append(_out_row(k, int(eid), t, fired[0], fired[1]))
            yield pd.DataFrame(out, columns=OUTPUT_SCHEMA.fieldNames())

    return ordered.mapInPandas(run, OUTPUT_SCHEMA)


def retrain_trigger_stream(sdf: DataFrame, key: str, ts: str, event_id: str, bad: F.Column,
                           strict_reference: bool = False, watermark: str = "1 hour",
                           training_seconds: float = 0.0, idle_seconds: float = 30 * 86400.0) -> DataFrame:
    """Streaming trigger with ``applyInPandasWithState`` (append mode).

    Rows of a key inside one micro-batch are processed in (ts, event_id)
    order.  Rows older than the watermark are dropped.  A key's state ends
    once the watermark is ``idle_seconds`` past its last event; a later event
    starts it anew.
    """
    # watermarks need a zoned timestamp: a separate column bounds lateness
    # while the rules keep reading the wall-clock value
    # and what a row says travels as one text, as a key's every column costs
    # more on its way to Python than its few rows
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    parts = [micros, F.col("event_id"), F.col("is_bad").cast("int"), F.unix_millis("_wm")]
    event = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in parts])
    prepared = (_prepare(sdf, key, ts, event_id, bad).withColumn("_wm", F.col("ts").cast("timestamp"))
                .select("key", "_wm", event.alias("event")).withWatermark("_wm", watermark))

    def fn(k, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        st = TriggerState.from_row(state.get) if state.exists else TriggerState()
        out = []
        rows = sorted((_event(x) for p in pdfs for x in p["event"].tolist()), key=lambda r: tuple((x is None, x) for x in r[:2]))
        if rows:
            for us, eid, b, _ in rows:
                fired = st.step((NO_TIME if us is None else us) / 1e6, bool(b), strict_reference, training_seconds)
                if fired:
                    out.append(_out_row(k[0], eid, pd.NaT if us is None else pd.Timestamp(us, unit="us"), fired[0], fired[1]))
            last = max((r[3] for r in rows if r[3] is not None), default=0)
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + int(idle_seconds * 1000))
        state.update(st.to_row())
        if out:
            yield pd.DataFrame(out, columns=OUTPUT_SCHEMA.fieldNames())

    return prepared.groupBy("key").applyInPandasWithState(
        fn, OUTPUT_SCHEMA, STATE_SCHEMA, "append", "EventTimeTimeout")
