"""Quality classifier by co-training.

Two classifiers see a document from two sides: its content (hashed byte 2-
and 3-grams) and its page metadata (source, language, length, layout).  Both
start from the labelled rows; in every round each scores all unlabelled rows
and labels those it is most sure of for the other.  Each is then calibrated on labelled rows
that neither was trained on, with the classes in the shares they have there,
and the mean of the two calibrated log-odds scores every document.

Of the labelled rows at most LABELLED are used, chosen by a hash of their ids.
Every unlabelled row takes part in every round: the views of all rows are stored
once, scored in Spark by each round's classifiers, and the ADDED surest different
documents are learned from (copies count as one, so that a large group of copies
is no more than one example).  Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_view, mix64, release, small_batches, stored
from .ngrams import codes
from .words import word_hashes

#: Labelled rows that are learned from and calibrated on.
LABELLED = 4000
ROUNDS = 5
#: Unlabelled documents that each side labels for the other in a round.
ADDED = 160
#: A side labels only rows it is this sure of.
SURE = 0.9
#: Documents whose probability of good quality is at least this are kept.
KEEP = 0.5
CONTENT = 512
_HASHED = 24
# classes of a byte: space, line end, lower case, capital, digit, usual punctuation, other ASCII, non-ASCII
_KIND = np.array([7 if b >= 128 else 1 if b == 10 else 0 if b in (9, 11, 12, 13, 32) else 2 if 97 <= b <= 122 else 3 if 65 <= b <= 90
                  else 4 if 48 <= b <= 57 else 5 if chr(b) in ".,;:'\"-?()" else 6 for b in range(256)], np.uint8)


def content_view(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Square roots of the shares of each hashed gram (texts x CONTENT)."""
    n = len(at) - 1
    code, doc = codes(raw, at)
    slot = _SLOT[code]
    x = np.bincount(doc * CONTENT + slot, minlength=n * CONTENT).reshape(n, CONTENT)
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def _slots() -> np.ndarray:
    from .ngrams import CODES
    return (mix64(np.arange(CODES)) % np.uint64(CONTENT)).astype(np.int64)


_SLOT = _slots()


def metadata_view(raw: np.ndarray, at: np.ndarray, source: list, lang: list) -> np.ndarray:
    """Length, layout, and hashed source and language."""
    n = len(at) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    kinds = np.bincount(doc * 8 + _KIND[raw], minlength=n * 8).reshape(n, 8)
    size = np.maximum(kinds.sum(axis=1), 1)
    lines, gaps = kinds[:, 1] + 1, kinds[:, 0] + kinds[:, 1] + 1
    word, of = word_hashes(raw, at)
    again = np.bincount(of[1:][(word[1:] == word[:-1]) & (of[1:] == of[:-1])], minlength=n) / gaps
    layout = np.column_stack([again, np.log1p(size), np.log1p(lines), np.log1p(size / lines), np.log1p(size / gaps), kinds / size[:, None],
                              kinds[:, 5] / gaps, kinds[:, 6] / gaps, kinds[:, 3] / np.maximum(kinds[:, 2] + kinds[:, 3], 1)])
    named = np.zeros((n, 2 * _HASHED))
    for k, column in enumerate((source, lang)):
        slots = {v: k * _HASHED + int(mix64(np.array([sum(c * 257 ** i for i, c in enumerate(str(v).encode()[:64])) % (1 << 63)]))[0] % np.uint64(_HASHED))
                 for v in set(column) if v is not None}
        for i, v in enumerate(column):
            if v is not None:
                named[i, slots[v]] = 1
    return np.concatenate([layout, named], axis=1).astype(np.float32)


@dataclass
class Side:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0   # calibration
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.raw(x) * self.slope + self.shift, -12, 12)


@dataclass
class Model:
    content: Side | None
    metadata: Side | None
    prior: float


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 100, l2: float = 1e-3) -> Side:
    """Logistic regression by accelerated gradient descent; classes count alike."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = ((x - mean) / scale).astype(np.float32)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)).astype(np.float32)
    # the step follows from the largest curvature, found by power iteration
    v = np.full(z.shape[1], z.shape[1] ** -0.5, np.float32)
    for _ in range(20):
        v = z.T @ (share * (z @ v))
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (0.25 * float(v @ (z.T @ (share * (z @ v)))) + l2 + 0.25)
    w, b = np.zeros(z.shape[1], np.float32), 0.0
    pw, pb = w, b
    for t in range(steps):
        m = t / (t + 3)
        qw, qb = w + m * (w - pw), b + m * (b - pb)
        r = (share * (_sigmoid(z @ qw + qb) - y)).astype(np.float32)
        pw, pb = w, b
        w, b = (qw - step * (z.T @ r + l2 * qw)).astype(np.float32), float(qb - step * r.sum())
    return Side(mean, scale, w, float(b))


def _calibrate(side: Side, x: np.ndarray, y: np.ndarray, prior: float) -> None:
    """Platt's log-odds of ``y`` by Newton's method, every row alike, with his
    targets short of 0 and 1; without enough rows those of training, at ``prior``."""
    side.shift = float(np.log(prior / (1 - prior)))
    if len(y) < 10 or not 0 < y.sum() < len(y):
        return
    z, good = side.raw(x).astype(float), float(y.sum())
    mean, scale = z.mean(), z.std() + 1e-9
    z = np.column_stack([(z - mean) / scale, np.ones(len(y))])
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    w = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(z @ w)
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2), z.T @ (p - target))
        w -= move / max(1.0, np.abs(move).max())
    if w[0] > 0:
        side.slope, side.shift = float(w[0] / scale), float(w[1] - w[0] * mean / scale)


Proposal = Callable[[list[Side], float], list[tuple[np.ndarray, np.ndarray]]]


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, fold: np.ndarray, propose: Proposal | None = None, rounds: int = ROUNDS) -> Model:
    """y: 1, 0 or NaN (takes no part); fold: labelled rows of fold 0 calibrate.

    ``propose(sides, good)`` gives for each side the views and labels of the
    unlabelled documents that the other side is surest of and that it has not
    been given yet; ``good`` is the share of good rows to keep to."""
    labelled = ~np.isnan(y)
    prior = float(y[labelled].mean()) if labelled.any() else 1.0
    train, held = labelled & (fold != 0), labelled & (fold == 0)
    if len(set(y[train])) < 2:
        return Model(None, None, prior)
    known = [(x[train], y[train]) for x in views]
    good = float(y[train].mean())
    sides = []
    for r in range(rounds + 1):
        sides = [logistic(x, k) for x, k in known]
        if r == rounds or propose is None:
            break
        more = propose(sides, good)
        if not any(len(k) for _, k in more):
            break
        known = [(np.concatenate([x, a]), np.concatenate([k, b])) for (x, k), (a, b) in zip(known, more, strict=True)]
    for side, x in zip(sides, views, strict=True):
        _calibrate(side, x[held], y[held], prior)
    return Model(sides[0], sides[1], prior)


def probabilities(model: Model, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of good quality: by content, by metadata, by both."""
    if model.content is None:
        same = np.full(len(content), model.prior)
        return same, same, same
    a, b = model.content.log_odds(content), model.metadata.log_odds(metadata)
    return _sigmoid(a), _sigmoid(b), _sigmoid((a + b) / 2)


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, at = byte_view(batch.column("_text"))
    return content_view(raw, at), metadata_view(raw, at, batch.column("_source").to_pylist(), batch.column("_lang").to_pylist())


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", labelled: int = LABELLED, added: int = ADDED) -> Model:
    """Co-train on ``docs`` (doc_id, text, lang, source) and ``labels`` (doc_id, label_col in 0 and 1).

    Null labels and labels of null ids are not used; an id labelled twice
    counts with its greater label, an id with several documents with that of
    the smallest key.  Documents without a label, null ids included, are the
    unlabelled rows; the order of rows and their partitions do not matter."""
    marks = (labels.select(F.col("doc_id").alias("_id"), F.col(f"`{label_col}`").cast("double").alias("_y"))
             .where("_id is not null and _y in (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y")))
    rate = min(1.0, 1.5 * labelled / max(marks.count(), 1))
    h = F.xxhash64(F.col("_id"), F.lit(11))
    ids = marks.where(F.pmod(h, F.lit(1_000_003)) < int(np.ceil(rate * 1_000_003))).orderBy(h, "_id").limit(labelled)
    views = _stored_views(docs)
    try:
        first = (views.join(F.broadcast(ids), "_id")  # at most ``labelled`` rows
                 .groupBy("_id").agg(F.first("_y").alias("y"), F.min(F.struct("_key", "_view")).alias("v"))
                 .select("_id", "y", F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(5)).alias("f"), F.col("v._view").alias("view")).toArrow())
        if not first.num_rows:
            return Model(None, None, 1.0)
        first = first.sort_by("_id")
        pair = _halves(first.column("view").to_pylist())
        return co_train(pair, first.column("y").to_numpy().astype(float), first.column("f").to_numpy(), _proposals(views, marks, added))
    finally:
        release(views)


def key(source: Column, lang: Column, text: Column) -> Column:
    """Names what the classifiers see of a document."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.coalesce(source, F.lit("\0")), F.coalesce(lang, F.lit("\0")))


def _stored_views(docs: DataFrame) -> DataFrame:
    """(_id, _key, _view): both views of every row, as half-precision numbers."""
    rows = _sources(docs, [F.col("doc_id").alias("_id")])
    rows = rows.withColumn("_key", key(F.col("_source"), F.col("_lang"), F.col("_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate(_views(batch), axis=1).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_key"), pa.array([r.tobytes() for r in x], pa.binary())], names=["_id", "_key", "_view"])

    schema = T.StructType([rows.schema["_id"], T.StructField("_key", T.LongType()), T.StructField("_view", T.BinaryType())])
    return stored(small_batches(rows).mapInArrow(run, schema))


def _halves(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The content and metadata views of stored rows."""
    x = np.frombuffer(b"".join(rows), np.float16).reshape(len(rows), -1).astype(np.float32)
    return x[:, :CONTENT], x[:, CONTENT:]


def _proposals(views: DataFrame, marks: DataFrame, added: int) -> Proposal:
    """Scores all unlabelled rows and takes the ``added`` surest of each side."""
    spark = views.sparkSession
    given: list[set[int]] = [set(), set()]  # keys by side: at most rounds x added
    empty = np.zeros(0)

    def propose(sides: list[Side], good: float) -> list[tuple[np.ndarray, np.ndarray]]:
        box = spark.sparkContext.broadcast(sides)  # bounded: a weight per feature

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                # rounded, so that copies in different batches are equal
                p = [np.round(_sigmoid(side.raw(x)).astype(float), 6) for side, x in zip(box.value, _halves(batch.column("_view").to_pylist()), strict=True)] if batch.num_rows else [empty, empty]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_key"), *map(pa.array, p)], names=["_id", "_key", "p0", "p1"])

        schema = T.StructType([views.schema["_id"], views.schema["_key"], *(T.StructField(c, T.DoubleType()) for c in ("p0", "p1"))])
        scored = stored(views.mapInArrow(run, schema).join(marks, "_id", "left_anti")
                        .groupBy("_key").agg(F.max("p0").alias("p0"), F.max("p1").alias("p1")))
        named: list[dict[int, int]] = [{}, {}]
        for me, other in ((0, 1), (1, 0)):
            p = F.col(f"p{me}")
            free = scored.where(~F.col("_key").isin(*given[other])) if given[other] else scored
            for label, sure, order, n in ((0, p <= 1 - SURE, p, added * (1 - good)), (1, p >= SURE, p.desc(), added * good)):
                named[other] |= dict.fromkeys((r._key for r in free.where(sure).orderBy(order, "_key").limit(max(1, int(n))).collect()), label)
            given[other] |= named[other].keys()
        release(scored)
        wanted = sorted(named[0].keys() | named[1].keys())
        if not wanted:
            return [(np.zeros((0, 0), np.float32), empty)] * 2
        chosen = F.broadcast(spark.createDataFrame([(k,) for k in wanted], "_key bigint"))  # at most 2 x added rows
        got = {r._key: bytes(r._view) for r in views.join(chosen, "_key").groupBy("_key").agg(F.min("_view").alias("_view")).collect()}
        halves = [_halves([got[k] for k in sorted(n)])[side] if n else None for side, n in enumerate(named)]
        return [(x if x is not None else np.zeros((0, len(sides[i].mean)), np.float32), np.array([named[i][k] for k in sorted(named[i])], float))
                for i, x in enumerate(halves)]

    return propose


def _sources(docs: DataFrame, keep: list[Column]) -> DataFrame:
    named = [F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string") for c in ("source", "lang")]
    return docs.select(*keep, F.col("text").alias("_text"), named[0].alias("_source"), named[1].alias("_lang"))


def score(docs: DataFrame, model: Model, keep: list[Column] | None = None, threshold: float = KEEP) -> DataFrame:
    """``keep`` columns (default: all), then ``p_content, p_metadata, quality_score, keep``.

    A null text counts as empty; null source and language as unnamed.  Without
    labels of both classes every row gets the labelled share of good rows (1
    without labels).  Each row stands alone: repeated rows get the same
    answer, an empty table gives an empty result; the four results replace
    columns of their names.
    """
    made = ("p_content", "p_metadata", "quality_score", "keep")
    kept = _sources(docs, keep if keep is not None else [F.col(f"`{c}`") for c in docs.columns])
    out = [f for f in kept.schema.fields if f.name not in ("_text", "_source", "_lang", *made)]
    schema = T.StructType([*out, *(T.StructField(c, T.DoubleType()) for c in made[:3]), T.StructField("keep", T.BooleanType())])
    box = docs.sparkSession.sparkContext.broadcast(model)  # bounded: a weight per feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, p = probabilities(box.value, *_views(batch))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in out), pa.array(a.astype(float)), pa.array(b.astype(float)),
                                              pa.array(p.astype(float)), pa.array(p >= threshold)], names=[*(f.name for f in out), *made])

    return small_batches(kept).mapInArrow(run, schema)
