"""Exact nearest rows without all pairs (V4, V9).

Every vector lies in the cell of its nearest pivot, and every cell in a block
of neighbouring cells, which is the unit that tasks hold.  A query is first
compared inside the block of its own cell; its k-th distance there bounds the
rest.  A cell can hold something nearer only if that bound reaches into it:

* triangle inequality: a vector at distance d of the cell's pivot is at least
  ``|d(q, pivot) - d|`` away, so the cell's nearest and farthest d bound it;
* Voronoi border: it lies on its pivot's side of the plane halfway to the
  query's pivot, ``(d(q, pivot)^2 - d(q, own)^2) / 2 d(pivot, own)`` away.

Blocks with a cell that the bound reaches are visited in a second round, and
in a visited block only such cells are compared.  If nothing can be ruled out
the work is that of blocked all pairs; it is never more rows than one copy of
a query per block.  Blocks hold at most ``block_rows`` vectors (a larger cell
is dealt to several), and a block's queries are dealt to several tasks, so
neither a dense region nor a popular one meets in one place.

The driver holds the pivots and one row of statistics per cell: at most
MAX_PIVOTS of each, whatever the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BLOCK_ROWS = 16_384
#: Pivots, and with them cells, at most.
MAX_PIVOTS = 2048
#: Visits of one block that one task compares.
BLOCK_VISITS = 65_536
#: Rows of a matrix product.
STEP = 256
# Bounds and fast products are compared with margins far above their rounding,
# as shares of the greatest squared norm and of its root; what lies within is
# decided by exact distances, so rounding can neither lose nor reorder rows.
MARGIN, SHIFT = 1e-9, 1e-7


@dataclass
class Cells:
    metric: str
    pivots: np.ndarray        # cells x dimension
    near: np.ndarray          # least distance of a cell's vectors to its pivot
    far: np.ndarray           # greatest
    block: np.ndarray         # a cell's first block
    pieces: np.ndarray        # and how many blocks it is dealt to
    centre: np.ndarray
    blocks: int = 1
    scale: float = 1.0        # no squared norm is greater

    def of_blocks(self) -> list[np.ndarray]:
        """The cells of each block."""
        cells = np.repeat(np.arange(len(self.block)), self.pieces)
        begin = np.repeat(self.block - np.cumsum(self.pieces) + self.pieces, self.pieces)
        at = begin + np.arange(len(cells))
        order = np.argsort(at, kind="stable")
        return np.split(cells[order], np.searchsorted(at[order], np.arange(1, self.blocks)))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dim)


def _placed(metric: str, x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Vectors where distances have the metric's order: cosines on the unit
    sphere, others around the centre, so that far origins cost no precision."""
    return x - centre if metric == "l2sq" else x / np.linalg.norm(x, axis=1, keepdims=True)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0))


def _exact(metric: str, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The reported score of pairs: squared distance, or one minus the cosine."""
    if metric == "l2sq":
        diff = v - q
        return (diff * diff).sum(1)
    return 1.0 - (v * q).sum(1) / (np.sqrt((q * q).sum(1)) * np.sqrt((v * v).sum(1)))


def _usable(df: DataFrame, id_col: str, vec_col: str, metric: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec").isNotNull()).where(~odd)
    return rows if metric == "l2sq" else rows.where(F.exists("vec", lambda x: x != 0))


def _assigned(rows: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """(id, vec, cell, far): each row's nearest pivot and the distance to it."""
    box = rows.sparkSession.sparkContext.broadcast((cells.metric, cells.pivots, cells.centre))  # bounded: MAX_PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metric, pivots, centre = box.value
        for batch in batches:
            x = _placed(metric, _vectors(batch.column("vec"), dim), centre)
            cell, far = np.zeros(len(x), np.int32), np.zeros(len(x))
            for lo in range(0, len(x), STEP):
                d = _distances(x[lo:lo + STEP], pivots)
                cell[lo:lo + STEP] = d.argmin(1)
                far[lo:lo + STEP] = d.min(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(cell), pa.array(far)], names=["id", "vec", "cell", "far"])

    return rows.where(F.size("vec") == dim).mapInArrow(run, "id bigint, vec array<double>, cell int, far double")


def _blocks(pivots: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Neighbouring cells in blocks of at most ``most`` vectors, by halving
    along the line between two far pivots; a larger cell gets blocks of its own."""
    block, pieces, made = np.zeros(len(count), np.int64), np.ones(len(count), np.int64), 0
    todo = [np.arange(len(count))]
    while todo:
        part = todo.pop()
        total = int(count[part].sum())
        if total <= most or len(part) == 1:
            block[part], pieces[part] = made, max(1, math.ceil(total / most)) if len(part) == 1 else 1
            made += int(pieces[part[0]])
            continue
        x = pivots[part]
        a = x[_distances(x, x[:1])[:, 0].argmax()]
        b = x[_distances(x, a[None, :])[:, 0].argmax()]
        order = np.argsort(x @ (b - a), kind="stable")
        half = int(np.clip(np.searchsorted(np.cumsum(count[part][order]), total / 2) + 1, 1, len(part) - 1))
        todo += [part[order[half:]], part[order[:half]]]
    return block, pieces, made


def build_cells(rows: DataFrame, metric: str, block_rows: int = BLOCK_ROWS) -> tuple[Cells, DataFrame, int]:
    """Cells over ``rows`` (id, vec), the rows in them (checkpointed), and the
    dimension: the commonest vector length (the greater of equally common)."""
    ensure_checkpoint_dir(rows.sparkSession)
    shape = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    dim, n = (shape["dim"], shape["n"]) if shape else (1, 0)
    wanted = min(MAX_PIVOTS, max(1, math.ceil(2 * math.sqrt(n))))
    sample = rows.where(F.size("vec") == dim).orderBy(F.xxhash64("id", "vec")).limit(wanted).collect()  # bounded: MAX_PIVOTS rows
    raw = np.array([r["vec"] for r in sample], dtype=np.float64).reshape(-1, dim) if sample else np.ones((1, dim))
    centre = raw.mean(0)
    pivots = np.unique(_placed(metric, raw, centre), axis=0)
    none = np.zeros(len(pivots))
    cells = Cells(metric, pivots, none, none, none.astype(np.int64), none.astype(np.int64) + 1, centre)
    placed = _assigned(rows, cells, dim).checkpoint(eager=True)
    count = np.zeros(len(pivots), np.int64)
    cells.near, cells.far = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("near"), F.max("far").alias("far")).collect():  # bounded: cells
        count[r["cell"]], cells.near[r["cell"]], cells.far[r["cell"]] = r["n"], r["near"], r["far"]
    if n:
        cells.scale = float((np.sqrt((pivots * pivots).sum(1)).max() + cells.far.max()) ** 2)
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    most = min(block_rows, max(256, math.ceil(n / (2 * parallel))))
    cells.block, cells.pieces, cells.blocks = _blocks(pivots, count, most)
    return cells, placed, dim


def _in_block(placed: DataFrame, cells: Cells) -> DataFrame:
    """Each row's block: its cell's, or one of them by the row's id."""
    spark = placed.sparkSession
    of = spark.createDataFrame([*zip(range(len(cells.block)), cells.block.tolist(), cells.pieces.tolist(), strict=True)], "cell int, first bigint, pieces bigint")
    of = F.broadcast(of)  # bounded: MAX_PIVOTS rows
    return placed.join(of, "cell").withColumn("block", F.col("first") + F.pmod(F.xxhash64("id"), F.col("pieces"))).drop("first", "pieces")


class _Nearest:
    """The k best (score, id) of each of ``n`` queries."""

    def __init__(self, n: int, k: int):
        self.k, self.limit = k, np.full(n, np.inf)
        self.kept = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))

    def add(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        query, score, ident = (np.concatenate(c) for c in zip(self.kept, (query, score, ident), strict=True))
        order = np.lexsort((ident, score, query))
        query, score, ident = query[order], score[order], ident[order]
        begins = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(begins, np.diff(np.r_[begins, len(query)]))
        full = rank == self.k - 1
        self.limit[query[full]] = score[full]
        self.kept = tuple(c[rank < self.k] for c in (query, score, ident))


def _reach(metric: str, score: np.ndarray, scale: float) -> np.ndarray:
    """The distance that a score stands for, with the margin."""
    return np.sqrt(np.maximum(score if metric == "l2sq" else 2 * score, 0) + MARGIN * scale)


def _least(cells: Cells, q: np.ndarray, own: np.ndarray, own_far: np.ndarray, some: np.ndarray, scale: float) -> np.ndarray:
    """No vector of the cells ``some`` is nearer to q than this (queries x cells)."""
    d = _distances(q, cells.pivots[some])
    ring = np.maximum(d - cells.far[some][None, :], cells.near[some][None, :] - d)
    kinds, which = np.unique(own, return_inverse=True)
    apart = _distances(cells.pivots[kinds], cells.pivots[some])[which]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(apart > SHIFT * math.sqrt(scale), (d * d - (own_far * own_far)[:, None]) / (2 * apart), 0)
    return np.maximum(ring, plane) - SHIFT * math.sqrt(scale)


def _compared(vectors: DataFrame, visits: DataFrame, cells: Cells, dim: int, k: int, exclude_self: bool, last: bool) -> DataFrame:
    """(query, id, score, seen, block, vec, cell, far, reach).

    Rows with an ``id`` are the k best of a visit in its block; the first of
    them tells how many vectors it has ``seen``.  Unless it is the ``last``
    round, rows with a ``block`` are the visits of the other blocks that the
    k-th distance found reaches.
    """
    metric = cells.metric
    box = vectors.sparkSession.sparkContext.broadcast(cells)  # bounded: MAX_PIVOTS pivots
    parts = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_VISITS).cast("int").alias("parts"))
    held = vectors.join(parts, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"),
                                               "id", "vec", "cell", "far", F.lit(None).cast("double").alias("reach"))
    asks = visits.join(parts, "block").select("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), "id", "vec", "cell", "far", "reach")
    dealt = held.unionByName(asks).repartition("block", "part").sortWithinPartitions("block", "part", "kind", "cell")
    schema = "query bigint, id bigint, score double, seen bigint, block bigint, vec array<double>, cell int, far double, reach double"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Cells = box.value
        inside = index.of_blocks()
        everywhere, begins = np.concatenate(inside), np.cumsum([0, *map(len, inside)])[:-1]
        here, gathered, ready = None, [], None

        def load() -> tuple:
            none = [np.zeros((0, dim))], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            vec, ident, cell = (np.concatenate(c) for c in (zip(*((_vectors(p.column("vec"), dim), p.column("id").to_numpy(), p.column("cell").to_numpy()) for p in gathered), strict=True) if gathered else none))
            order = np.lexsort((ident, cell))
            some, begin = np.unique(cell[order], return_index=True)
            at = _placed(metric, vec[order], index.centre)
            return at, vec[order], ident[order], some, np.r_[begin, len(cell)], (at * at).sum(1)

        def emit(**columns) -> pa.RecordBatch:
            n = len(columns["query"])
            return pa.RecordBatch.from_arrays([pa.nulls(n, t) if c not in columns else columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], t)
                                               for c, t in zip(names, kinds, strict=True)], names=names)

        def visit(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            at, vec, ident, some, begin, norm = ready
            raw = _vectors(part.column("vec"), dim)
            who, own, far = (part.column(c).to_numpy() for c in ("id", "cell", "far"))
            given = part.column("reach").fill_null(float("inf")).to_numpy()
            q = _placed(metric, raw, index.centre)
            own_norm = (q * q).sum(1)
            scale = max(index.scale, float(own_norm.max()), 1e-300)
            best, seen = _Nearest(len(q), k), np.zeros(len(q), np.int64)

            def compare(need: np.ndarray, c: int, bound: np.ndarray) -> None:
                for lo in range(begin[c], begin[c + 1], 16 * STEP):
                    hi = min(lo + 16 * STEP, begin[c + 1])
                    d = own_norm[need][:, None] + norm[None, lo:hi] - 2 * (q[need] @ at[lo:hi].T)
                    limit = bound[need] ** 2
                    if hi - lo > k + 1:  # one more than k: a query may be among them itself
                        limit = np.minimum(limit, np.partition(d, k, axis=1)[:, k])
                    i, j = np.nonzero(d <= limit[:, None] + MARGIN * scale)
                    if exclude_self:
                        other = ident[lo + j] != who[need[i]]
                        i, j = i[other], j[other]
                    if len(i):
                        best.add(need[i], _exact(metric, raw[need[i]], vec[lo + j]), ident[lo + j])
                seen[need] += begin[c + 1] - begin[c]

            if len(some):
                least = _least(index, q, own, far, some, scale)
                for c in np.flatnonzero(np.isin(some, own)):  # one's own cell bounds the others
                    compare(np.flatnonzero(own == some[c]), c, given)
                for c in np.argsort(least.mean(0), kind="stable"):
                    bound = np.minimum(given, _reach(metric, best.limit, scale))
                    need = np.flatnonzero((least[:, c] <= bound) & (own != some[c]))
                    if len(need):
                        compare(need, c, bound)
            query, score, found = best.kept
            lead = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
            yield emit(query=who[query], id=found, score=score, seen=np.where(lead, seen[query], 0))
            if not last:
                bound = np.minimum(given, _reach(metric, best.limit, scale))
                reached = _least(index, q, own, far, np.arange(len(index.block)), scale) <= bound[:, None]
                i, block = np.nonzero(np.logical_or.reduceat(reached[:, everywhere], begins, axis=1))
                i, block = i[block != here[0]], block[block != here[0]]
                for lo in range(0, len(i), 4 * STEP):
                    some_i = i[lo:lo + 4 * STEP]
                    vecs = pa.ListArray.from_arrays(np.arange(len(some_i) + 1, dtype=np.int32) * dim, raw[some_i].ravel())
                    yield emit(query=who[some_i], block=block[lo:lo + 4 * STEP], vec=vecs, cell=own[some_i], far=far[some_i], reach=bound[some_i])

        for batch in batches:
            block, piece, kind = (batch.column(c).to_numpy() for c in ("block", "part", "kind"))
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (piece[1:] != piece[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if lo == hi:
                    continue
                if (block[lo], piece[lo]) != here:
                    here, gathered, ready = (block[lo], piece[lo]), [], None
                if kind[lo] == 0:
                    gathered.append(batch.slice(lo, hi - lo))
                else:
                    ready = ready or load()
                    for a in range(lo, hi, STEP):
                        yield from visit(batch.slice(a, min(STEP, hi - a)))

    return dealt.mapInArrow(run, schema)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "l2sq", exclude_self: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, vec_id, rank, score, seen): the exact k nearest rows of
    ``vectors`` (vec_id, embedding) to each of ``queries`` (query_id, qvec).

    ``score`` is the squared distance (``l2sq``) or one minus the cosine
    (``cosine``); ties go to the smaller id.  ``seen`` is the number of vectors
    that the query was compared with.  Vectors that are null, hold a null or
    non-finite component or have another length than the commonest take no
    part, with ``cosine`` neither have zero vectors.
    """
    cells, placed, dim = build_cells(_usable(vectors, "vec_id", "embedding", metric), metric, block_rows)
    held = _in_block(placed, cells)
    asked = _in_block(_assigned(_usable(queries, "query_id", "qvec", metric), cells, dim), cells).withColumn("reach", F.lit(None).cast("double"))
    first = _compared(held, asked, cells, dim, k, exclude_self, last=cells.blocks == 1)
    if cells.blocks > 1:
        first = first.checkpoint(eager=True)
        more = first.where("block is not null").select("block", F.col("query").alias("id"), "vec", "cell", "far", "reach")
        found = first.where("block is null").unionByName(_compared(held, more, cells, dim, k, exclude_self, last=True))
    else:
        found = first
    whole = Window.partitionBy("query")
    ranked = (found.select("query", "id", "score", F.sum("seen").over(whole).alias("seen"), F.row_number().over(whole.orderBy("score", "id")).alias("rank"))
              .where(F.col("rank") <= k))
    return ranked.select(F.col("query").alias("query_id"), F.col("id").alias("vec_id"), F.col("rank").cast("bigint").alias("rank"), "score", "seen")
