"""Hard negatives by a secondary sort.

Scores of (anchor, row) pairs are shuffled under packed keys (anchor,
descending score, id), sorted inside their partitions, and read as a stream:
a row of the anchor's label opens a window of scores below its own, and rows
of other labels are emitted while they fall into an open window.  The stream
holds the open windows and the ties of the present score, never an anchor.

Anchors times rows are scored in a grid of blocks: a cell holds a bounded
number of anchors and streams its rows past them.  What a cell sends to the
sort is aggregated first: of each anchor the cell's best rows of its label,
and, once the anchors' positives are known, the first rows of other labels in
each positive's window.  No more of them can be asked for, so nothing is lost.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Anchors that a cell of the grid holds.
HELD = 2048
#: Rows that a cell streams past them, about.
STREAMED = 500_000
#: Rows that are multiplied at a time.
STEP = 512
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _packed(df: DataFrame) -> DataFrame:
    """Vectors as the 32-bit floors of their components times 256.  A squared
    norm below 2**62 keeps every product of two of them in 64 bits."""
    kinds = "asks boolean, id bigint, label bigint, dim int, vec binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("vec")
            at = np.asarray(col.offsets)
            x = np.floor(256 * np.asarray(col.values)[:int(at[-1])]) if len(col) else np.zeros(0)
            vecs = [x[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            fits = [float((v * v).sum()) < 2.0 ** 62 for v in vecs]
            packed = [v.astype("<i4").tobytes() if ok else None for v, ok in zip(vecs, fits, strict=True)]
            out = [batch.column("asks"), batch.column("id"), batch.column("label"), pa.array(np.diff(at).astype(np.int32)), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=["asks", "id", "label", "dim", "vec"]).filter(pa.array(fits, pa.bool_()))

    return df.mapInArrow(run, kinds)


def _products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where these are exact."""
    if a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) < 2.0 ** 53:
        return (a.astype(float) @ x.T.astype(float)).astype(np.int64)
    return a @ x.T


class _Best:
    """The ``k`` first (score descending, null ids last, id, row) of each key."""

    def __init__(self, keys: int, k: int):
        self.k, self.kept = k, tuple(np.zeros(0, np.int64) for _ in range(5))
        self.least = np.full(keys, _LOW)  # a key's k-th score, once it has k

    def add(self, *new: np.ndarray) -> None:
        cols = [np.concatenate(c) for c in zip(self.kept, new, strict=True)]
        key, score, null, ident, row = cols
        order = np.lexsort((row, ident, null, -score, key))
        key = key[order]
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        rank = np.arange(len(key)) - np.repeat(begins, np.diff(np.r_[begins, len(key)]))
        last = order[rank == self.k - 1]
        self.least[cols[0][last]] = score[last]
        self.kept = tuple(c[order[rank < self.k]] for c in cols)


def _bounds(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest whole score s with low * p <= 100 * s <= high * p, without overflow."""
    whole, rest = scores // 100, scores % 100
    return low * whole - (-low * rest) // 100, high * whole + high * rest // 100


def _grid(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int) -> DataFrame:
    """Every row and every anchor in the cells where they meet: (dim, cell, kind, label, id, row, vec, scores)."""
    blocks = max(1, -(-n_anchors // HELD))
    slots = 2 * rows.sparkSession.sparkContext.defaultParallelism
    runs = max(-(-n_rows // STREAMED), min(-(-slots // blocks), -(-n_rows // 1000)), 1)
    line = F.pmod(F.xxhash64("row"), F.lit(runs))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    common = ["dim", "label", "id", "row", "vec"]
    streamed = (rows.select(*common, F.lit(None).cast("array<bigint>").alias("scores"), F.lit(1).alias("kind"), line.alias("line"), every(blocks).alias("block")))
    held = (anchors.select(*common, "scores", F.lit(0).alias("kind"), every(runs).alias("line"), block.alias("block")))
    cells = held.unionByName(streamed).withColumn("cell", F.col("line") * blocks + F.col("block")).drop("line", "block")
    return cells.repartition(blocks * runs, "dim", "cell").sortWithinPartitions("dim", "cell", "kind", "label")


def _met(cells: DataFrame, k: int, window: tuple[int, int] | None) -> DataFrame:
    """(anchor, score, id, row): of every cell, each anchor's k first other
    rows of its label, or with a ``window`` the k first rows of other labels in
    the window of each score it carries."""

    def ids(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        col = part.column("id")
        return np.asarray(col.is_null()).astype(np.int64), np.asarray(col.fill_null(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, ready = None, [], None

        def load() -> tuple:
            label = np.concatenate([np.asarray(p.column("label")) for p in held])
            row = np.concatenate([np.asarray(p.column("row")) for p in held])
            vec = np.concatenate([vectors(p) for p in held])
            if window is None:
                return label, row, vec, None, None, _Best(len(row), k)
            scores = [s or [] for p in held for s in p.column("scores").to_pylist()]
            wide = max(map(len, scores), default=0)
            low, high = np.full((len(row), wide), _HIGH), np.full((len(row), wide), _LOW)
            for i, s in enumerate(scores):
                low[i, :len(s)], high[i, :len(s)] = _bounds(np.array(s, np.int64), *window)
            return label, row, vec, low, high, _Best(len(row) * wide, k)

        def vectors(p: pa.RecordBatch) -> np.ndarray:
            return np.frombuffer(b"".join(p.column("vec").to_pylist()), "<i4").reshape(p.num_rows, -1).astype(np.int64)

        def meet(p: pa.RecordBatch) -> None:
            label, row, vec, low, high, best = ready
            x, xl, xr = vectors(p), np.asarray(p.column("label")), np.asarray(p.column("row"))
            null, ident = ids(p)
            if window is None:
                for value in np.unique(xl):
                    a, b = np.flatnonzero(label == value), np.flatnonzero(xl == value)
                    if len(a):
                        s = _products(vec[a], x[b])
                        i, j = np.nonzero((s >= best.least[a][:, None]) & (row[a][:, None] != xr[b][None, :]))
                        if len(i):
                            best.add(a[i], s[i, j], null[b[j]], ident[b[j]], xr[b[j]])
                return
            s, other = _products(vec, x), label[:, None] != xl[None, :]
            for w in range(low.shape[1]):
                keys = np.arange(len(row)) * low.shape[1] + w
                floor = np.maximum(low[:, w], best.least[keys])
                i, j = np.nonzero((s >= floor[:, None]) & (s <= high[:, w][:, None]) & other)
                if len(i):
                    best.add(keys[i], s[i, j], null[j], ident[j], xr[j])

        def found() -> Iterator[pa.RecordBatch]:
            if ready is None:
                return
            _, row, _, low, _, best = ready
            key, score, null, ident, xr = best.kept
            anchor = row[key // (low.shape[1] if low is not None else 1)] if len(key) else key
            order = np.lexsort((xr, anchor))  # a row in several windows is sent once
            once = order[np.r_[True, (anchor[order][1:] != anchor[order][:-1]) | (xr[order][1:] != xr[order][:-1])]] if len(order) else order
            cols = [anchor[once], score[once], pa.array(ident[once], mask=null[once].astype(bool)), xr[once]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["anchor", "score", "id", "row"])

        for batch in batches:
            dim, cell, kind = (np.asarray(batch.column(c)) for c in ("dim", "cell", "kind"))
            cuts = np.flatnonzero((dim[1:] != dim[:-1]) | (cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if lo == hi:
                    continue
                if (dim[lo], cell[lo]) != here:
                    yield from found()
                    here, held, ready = (dim[lo], cell[lo]), [], None
                if kind[lo] == 0:
                    held.append(batch.slice(lo, hi - lo))
                elif held:
                    ready = ready or load()
                    for a in range(lo, hi, STEP):
                        meet(batch.slice(a, min(STEP, hi - a)))
        yield from found()

    return cells.mapInArrow(run, "anchor bigint, score bigint, id bigint, row bigint")


def _ordered(column: Column) -> Column:
    """A long as eight bytes that sort like it."""
    return F.lpad(F.hex(column.bitwiseXOR(F.lit(_LOW))), 16, "0")


def _keyed(pairs: DataFrame, positive: bool) -> DataFrame:
    """(anchor, key, positive): the key sorts by anchor, descending score, null ids last, id and row."""
    null = F.when(F.col("id").isNull(), "01").otherwise("00")
    parts = [_ordered(F.col("anchor")), _ordered(F.bitwise_not("score")), null, _ordered(F.coalesce("id", F.lit(0))), _ordered(F.col("row"))]
    return pairs.select("anchor", F.unhex(F.concat(*parts)).alias("key"), F.lit(positive).alias("positive"))


def _windows(pairs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """The stream over sorted keys: rows of an anchor's label open windows, rows of others fall into them."""
    schema = "anchor bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    names = [c.split()[0] for c in schema.split(", ")]
    flip = 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_of = struct.Struct(">QQ?QQ")
        here, windows, ties, tied = None, [], [], None  # windows: [id, score, least, greatest, emitted]
        for batch in batches:
            out: list[tuple] = []

            def emit(w: list, ident: int | None, score: int, out: list = out) -> None:
                if w[2] <= score <= w[3] and w[4] < k:
                    w[4] += 1
                    out.append((here - flip, w[0], w[4], ident, w[1], score))

            for key, positive in zip(batch.column("key").to_pylist(), batch.column("positive").to_pylist(), strict=True):
                anchor, score, null, ident, _ = key_of.unpack(key)
                score, ident = ~(score - flip), None if null else ident - flip
                if anchor != here:
                    here, windows, ties, tied = anchor, [], [], None
                if score != tied:
                    ties, tied = [], score
                if positive:
                    least, greatest = _bounds(np.array([score]), low, high)
                    windows.append([ident, score, int(least[0]), int(greatest[0]), 0])
                    for t in ties:  # as good as the positive, with smaller ids
                        emit(windows[-1], t, score)
                else:
                    if len(ties) < k:
                        ties.append(ident)
                    windows = [w for w in windows if score >= w[2] and w[4] < k]
                    for w in windows:
                        emit(w, ident, score)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*out, strict=True), _TYPES, strict=True)], names=names)

    dealt = pairs.repartition("anchor").sortWithinPartitions("key").select("key", "positive")
    return dealt.mapInArrow(run, schema)


_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def mine(df: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of the floors of 256 times the components.
    An anchor's positives are its ``positives`` first other rows of equal
    ``label`` (a whole number), each positive's negatives the ``negatives``
    first rows of other labels whose score s and the positive's p satisfy
    low * p <= 100 * s <= high * p (0 <= low <= high <= 100).  Higher scores come
    first, ties by smaller id, null ids last.

    Rows with a null label or vector, or a null or non-finite component, take
    no part, nor do vectors whose scaled squared norm reaches 2**62, whose
    products may not fit a long.  Vectors meet only vectors of their length.
    Rows that repeat an id are rows of their own, each an anchor if ``anchors``
    holds; where that is null the row is none.  An anchor without positives or
    a positive without negatives gives no rows; an empty table gives none.
    Other columns are not read.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("0 <= low <= high <= 100 must hold")
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    clean = df.select(F.coalesce(anchors, F.lit(False)).alias("asks"), F.col(f"`{id_col}`").cast("bigint").alias("id"), label.cast("bigint").alias("label"), vec.alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    clean = clean.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad)
    rows = stored(_packed(clean).withColumn("row", F.monotonically_increasing_id()))
    asked = rows.where("asks").withColumn("scores", F.lit(None).cast("array<bigint>"))
    n_rows, n_anchors = rows.count(), asked.count()
    first = W.partitionBy("anchor").orderBy(F.desc("score"), F.isnull("id"), "id", "row")
    best = _met(_grid(rows, asked, n_rows, n_anchors), positives, None)
    chosen = stored(best.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives).drop("place"))
    scores = chosen.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("scores"))
    near = _met(_grid(rows, asked.drop("scores").join(scores, "row"), n_rows, n_anchors), negatives, (low, high))
    mined = _windows(_keyed(chosen, True).unionByName(_keyed(near, False)), negatives, low, high)
    ids = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return mined.join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
