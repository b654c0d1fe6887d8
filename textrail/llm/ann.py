"""Nearest neighbours by inner product with multi-probe p-stable hashing.

Vectors are lifted to the unit sphere (scaled by the greatest norm, with one
more component that fills them up), where the largest inner product with a
query is the least Euclidean distance.  A table hashes a vector to the cell
floor((a.x + b) / w) of Gaussian (2-stable) projections that are orthogonal to
each other; their number grows with the logarithm of the rows, so that a cell
holds about CELL vectors at every size.  A query visits the cells of each table
in the order of the estimated probability that a neighbour lies there: along a
projection, a vector whose cosine with the query is c lies around c times the
query's own place.

How many cells are visited is fitted to the data: at most SAMPLE queries are
compared with all rows, and the visits are the fewest that find TARGET of their
neighbours.  Where rows lie in clusters these are few; rows that lie evenly in
many dimensions need more.

Rows of the index lie in groups by table and first hashes, sorted by cell.  A
query goes to a group once, with the cells it visits there.  The candidates of
all tables are ranked in single precision, and the best of them by the exact
inner product in double precision.  Equal vectors are one candidate that
carries the ids it needs.  A query that has found fewer than it could is
compared with all vectors, in blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, mix64, small_batches

TABLES, CELL = 8, 12
#: Queries that are compared with all rows to fit the visits, the share of their neighbours that the visits find, and the most visits a table gets.
SAMPLE, TARGET, MOST = 96, 0.94, 4096
#: Rows that the middle and the spread of a projection are taken from.
ROWS = 4096
#: Cell width in standard deviations of a projection: two wide cells on each side of its middle.
WIDTH = 4.0
#: Vectors in one piece of a group.
PIECE = 20_000
#: Entries that a task gathers before it ranks them.
GATHER = 500_000
#: Candidates that are ranked exactly beyond those asked for.
SLACK = 8
SEED = 3

@dataclass
class Tables:
    greatest: float
    directions: np.ndarray   # tables x (dimension + 1) x hashes
    middles: np.ndarray      # tables x hashes
    widths: np.ndarray       # tables x hashes
    lead: int                # hashes that name a group
    near: float = 0.0        # cosine of a query and its neighbours
    probes: int = 1          # cells that a query visits in each table


def make_tables(greatest: float, rows: np.ndarray, total: int) -> Tables:
    """Tables for ``total`` vectors; ``rows``: a sample of them."""
    rng = np.random.default_rng(SEED)
    size = rows.shape[1] + 1
    hashes = int(np.clip(np.ceil(np.log2(max(total, 1) / CELL)), 1, 30))
    blocks = [np.concatenate([np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(-(-hashes // size))], axis=1)[:, :hashes] for _ in range(TABLES)]
    directions = np.stack(blocks) * np.sqrt(size)
    places = np.stack([_lift(rows, greatest) @ d for d in directions]) if len(rows) else np.zeros((TABLES, 1, hashes))
    middles = np.median(places, axis=1)
    widths = WIDTH * np.maximum(places.std(axis=1), 1e-9)
    return Tables(greatest, directions, middles, widths, int(np.clip(np.ceil(np.log2(max(total, 1) / PIECE)), 0, hashes)))


def _lift(x: np.ndarray, greatest: float) -> np.ndarray:
    y = x / greatest
    return np.column_stack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))])


def _unit(q: np.ndarray) -> np.ndarray:
    q = q / np.abs(q).max(axis=1, keepdims=True)
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def _names(table: int, cells: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """The group and the cell that integer cells (... x hashes) stand for."""
    h = np.full(cells.shape[:-1], table + 1, np.uint64)
    group = mix64(h)
    for j in range(cells.shape[-1]):
        h = mix64(h ^ cells[..., j].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        if j + 1 == lead:
            group = h
    return group.view(np.int64), h.view(np.int64)


def cells_of(t: Tables, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group and the cell of each vector in each table (vectors x tables)."""
    y = _lift(x, t.greatest)
    names = [_names(k, np.floor((y @ t.directions[k] - t.middles[k]) / t.widths[k]).astype(np.int64), t.lead) for k in range(TABLES)]
    return np.stack([g for g, _ in names], axis=1), np.stack([c for _, c in names], axis=1)


def _below(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, by the logistic curve near it."""
    return 1 / (1 + np.exp(-np.clip(1.5976 * z + 0.07056 * z ** 3, -500, 500)))


def visits_of(t: Tables, q: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups and cells that each query visits (queries x tables x visits),
    likeliest first: own cells, those next to them, and their combinations."""
    y = np.column_stack([_unit(q), np.zeros(len(q))])
    steps = np.array([0, -1, 1])
    spread = np.sqrt(max(1 - t.near * t.near, 1e-6))
    out = []
    for k in range(TABLES):
        f = y @ t.directions[k]
        cell = np.floor((f - t.middles[k]) / t.widths[k]).astype(np.int64)
        at = cell[..., None] + steps
        low = t.middles[k][:, None] + at * t.widths[k][:, None]
        mean = t.near * f[..., None]
        p = _below((low + t.widths[k][:, None] - mean) / spread) - _below((low - mean) / spread)
        cost = -np.log(np.maximum(p, 1e-12))
        cost -= cost.min(axis=2, keepdims=True)
        # the cheapest sums of the first j hashes hold those of the first j + 1
        total, picked = np.zeros((len(q), 1)), np.zeros((len(q), 1, 0), np.int64)
        for j in range(cell.shape[1]):
            total = (total[:, :, None] + cost[:, j][:, None, :]).reshape(len(q), -1)
            order = np.argsort(total, axis=1, kind="stable")[:, :probes]
            total = np.take_along_axis(total, order, axis=1)
            before = np.take_along_axis(picked, (order // 3)[..., None], axis=1)
            mine = np.take_along_axis(at[:, j], order % 3, axis=1)
            picked = np.concatenate([before, mine[..., None]], axis=2)
        out.append(_names(k, picked, t.lead))
    return np.stack([g for g, _ in out], axis=1), np.stack([c for _, c in out], axis=1)


def fit_visits(t: Tables, queries: np.ndarray, neighbours: list[np.ndarray], target: float = TARGET) -> Tables:
    """The fewest visits that find ``target`` of the queries' neighbours."""
    pairs = [(i, v) for i, n in enumerate(neighbours) for v in n]
    if not pairs:
        return t
    who, found = np.array([i for i, _ in pairs]), np.stack([v for _, v in pairs])
    t.near = float(np.clip(((_unit(queries)[who]) * (found / t.greatest)).sum(axis=1).mean(), 0, 0.999))
    _, cells = cells_of(t, found)
    # every pair's place in the order of visits, the best of its tables
    place = np.full(len(pairs), MOST, np.int64)
    for i in range(len(queries)):
        mine = np.flatnonzero(who == i)
        visits = visits_of(t, queries[i:i + 1], MOST)[1][0]
        for k in range(TABLES):
            hit = visits[k][None, :] == cells[mine, k][:, None]
            place[mine] = np.minimum(place[mine], np.where(hit.any(axis=1), hit.argmax(axis=1), MOST))
    t.probes = int(min(np.sort(place)[min(len(place) - 1, int(np.ceil(target * len(place))))] + 1, MOST))
    return t


def _usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0)


def _spread(rows: DataFrame, tables: Tables, query: bool) -> DataFrame:
    """(cell, kind, node, keys, vec): every table's entries by group, or each
    query's visits, once for a group with all the cells it visits there."""
    box = rows.sparkSession.sparkContext.broadcast(tables)  # bounded: tables x dimension x hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = box.value
        step = 200 if not query else max(1, 200_000 // (TABLES * t.probes))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                x = np.stack(part.column("vec").to_numpy(zero_copy_only=False)).astype(float)
                node = part.column("node").to_numpy()
                group, key = (a.reshape(len(x), -1) for a in (visits_of(t, x, t.probes) if query else cells_of(t, x)))
                row = np.repeat(np.arange(len(x)), group.shape[1])
                order = np.lexsort((group.ravel(), row))
                row, group, key = row[order], group.ravel()[order], key.ravel()[order]
                begins = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (group[1:] != group[:-1])])
                raw = [v.tobytes() for v in (_unit(x) if query else x / t.greatest).astype(np.float32)]
                keys = pa.ListArray.from_arrays(pa.array(np.r_[begins, len(row)].astype(np.int32)), pa.array(key))
                yield pa.RecordBatch.from_arrays([pa.array(group[begins]), pa.array(np.full(len(begins), int(query), np.int32)), pa.array(node[row[begins]]),
                                                  keys, pa.array([raw[i] for i in row[begins]], pa.binary())], names=["cell", "kind", "node", "keys", "vec"])

    return small_batches(rows.select("node", "vec")).mapInArrow(run, "cell bigint, kind int, node bigint, keys array<bigint>, vec binary")


def _neighbours(nodes: DataFrame, queries: list, greatest: float, k: int) -> list[np.ndarray]:
    """The exact ``k`` nearest vectors of a bounded number of (node, vector) queries."""
    own = np.array([n for n, _ in queries], np.int64)
    asks = nodes.sparkSession.sparkContext.broadcast(_unit(np.array([v for _, v in queries])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros((0, asks.value.shape[1])))] * len(own)
        for batch in batches:
            x = np.stack(batch.column("vec").to_numpy(zero_copy_only=False)).astype(float)
            s = asks.value @ (x / greatest).T
            s[own[:, None] == batch.column("node").to_numpy()[None, :]] = -np.inf
            for i, (score, vec) in enumerate(best):
                floor = score[-1] if len(score) == k else -np.inf
                new = np.flatnonzero(s[i] > floor)
                score, vec = np.r_[score, s[i][new]], np.concatenate([vec, x[new]])
                order = np.argsort(-score, kind="stable")[:k]
                best[i] = score[order], vec[order]
        for i, (score, vec) in enumerate(best):
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), i, np.int32)), pa.array(score), pa.array(list(vec), pa.list_(pa.float64()))],
                                                 names=["query", "score", "vec"])

    found = small_batches(nodes.select("node", "vec")).mapInArrow(run, "query int, score double, vec array<double>")
    first = found.withColumn("r", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score")))).where((F.col("r") <= k) & (F.col("score") > float("-inf")))
    out: list[list] = [[] for _ in queries]
    for row in first.select("query", "vec").collect():  # bounded: SAMPLE x k
        out[row["query"]].append(row["vec"])
    return [np.array(v, float) for v in out]


def _best(query: np.ndarray, node: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best different candidates."""
    order = np.lexsort((score, node, query))
    query, node, score = query[order], node[order], score[order]
    last = np.r_[(query[1:] != query[:-1]) | (node[1:] != node[:-1]), True] if len(query) else np.zeros(0, bool)
    query, node, score = query[last], node[last], score[last]
    order = np.lexsort((node, -score, query))
    query, node, score = query[order], node[order], score[order]
    begins = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(begins, np.diff(np.r_[begins, len(query)]))
    keep = rank < k
    return query[keep], node[keep], score[keep]


def _compared(entries: DataFrame, k: int) -> DataFrame:
    """(query, node, near): the best k candidates of each query among the
    pieces that a task holds, of rows (cell, piece, kind, node, keys, vec).
    A piece's vectors are held, its queries streamed; queries without keys are
    compared with the whole piece."""
    dealt = entries.withColumn("first", F.coalesce(F.get("keys", F.lit(0)), F.lit(0).cast("bigint"))).repartition("cell", "piece").sortWithinPartitions("cell", "piece", "kind", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, found = None, [], []

        def ranked() -> tuple:
            return _best(*(np.concatenate(c) for c in zip(*found, strict=True)), k)

        for batch in batches:
            cell, piece, kind = (batch.column(c).to_numpy() for c in ("cell", "piece", "kind"))
            node = batch.column("node").to_numpy()
            first = batch.column("first").to_numpy()
            x = np.frombuffer(b"".join(batch.column("vec").to_pylist()), np.float32).reshape(len(node), -1)
            lists = batch.column("keys")
            cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (piece[1:] != piece[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(node)]):
                if (cell[lo], piece[lo]) != here:
                    here, held, ids = (cell[lo], piece[lo]), [], None
                if kind[lo] == 0:
                    held.append((node[lo:hi], first[lo:hi], x[lo:hi]))
                    continue
                if not held:
                    continue
                if ids is None:
                    ids, keys, vecs = (np.concatenate(c) for c in zip(*held, strict=True))
                    names, begins = np.unique(keys, return_index=True)
                    ends = np.r_[begins[1:], len(ids)]
                for i in range(lo, hi):
                    wanted = lists[i].values
                    if wanted is None:
                        at = np.arange(len(ids))
                    else:
                        wanted = wanted.to_numpy()
                        spot = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
                        spot = spot[names[spot] == wanted]
                        lengths = ends[spot] - begins[spot]
                        at = np.arange(lengths.sum()) + np.repeat(begins[spot] - np.r_[0, np.cumsum(lengths)[:-1]], lengths)
                    if len(at):
                        s = vecs[at] @ x[i]
                        top = np.argpartition(-s, k)[:k] if len(s) > k else np.arange(len(s))
                        found.append((np.full(len(top), node[i]), ids[at[top]], s[top].astype(float)))
                if len(found) * k > GATHER:
                    found = [ranked()]
                    if len(found[0][0]) > GATHER // 2:  # as many queries: the next step ranks on
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, found.pop())), names=["query", "node", "near"])
        if found:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, ranked())), names=["query", "node", "near"])

    return small_batches(dealt).mapInArrow(run, "query bigint, node bigint, near double")


def nearest(df: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row where ``queries``
    holds, its k nearest rows other than itself.

    Vectors that are null, empty, zero, or hold a null or non-finite component
    take no part, nor do vectors of another length than the commonest (the
    greater, if two are equally common).  Ties go to the smaller id, null ids
    last; rows that repeat an id are rows of their own.  A query that has
    fewer than k other rows gets them all; an empty table gives an empty
    result.  Other columns are not read.
    """
    clean = (df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("vec"), queries.alias("asks"))
             .where(_usable(F.col("vec"))).withColumn("size", F.size("vec")))
    most_part = F.array_max(F.transform("vec", F.abs))
    norm = most_part * F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / most_part) * (x / most_part)))
    shape = clean.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("greatest")).orderBy(F.desc("n"), F.desc("size")).first()
    greatest = shape["greatest"] if shape else 1.0
    rows = cut(clean.where(F.col("size") == (shape["size"] if shape else 1)).drop("size").withColumn("row", F.monotonically_increasing_id()))
    mine = W.partitionBy("vec").orderBy(F.isnull("id"), "id", "row")
    # the k + 1 first ids of equal vectors are all that any query can need of them
    nodes = cut(rows.withColumn("place", F.row_number().over(mine)).where(F.col("place") <= k + 1)
                .groupBy("vec").agg(F.min("row").alias("node"), F.collect_list(F.struct("id", "row")).alias("ids")))
    asked = cut(rows.where("asks").select("vec", "id", "row").join(nodes.select("vec", "node"), "vec"))
    wanted = asked.select("node").distinct().join(nodes.select("node", "vec"), "node")
    total = nodes.count()
    few = [r["vec"] for r in nodes.orderBy(F.xxhash64("node", F.lit(SEED))).limit(ROWS).select("vec").collect()]
    tables = make_tables(greatest, np.array(few, float).reshape(len(few), shape["size"] if shape else 1), total)
    tried = [(r["node"], r["vec"]) for r in wanted.orderBy(F.xxhash64("node", F.lit(SEED + 1))).limit(SAMPLE).collect()]
    if tried:
        tables = fit_visits(tables, np.array([v for _, v in tried], float), _neighbours(nodes, tried, greatest, k))
    keep = k + 1 + SLACK
    found = cut(_first(_compared(_pieces(_spread(nodes, tables, False), _spread(wanted, tables, True)), keep), keep))
    # an exact way for queries that the cells gave too little
    most = min(k + 1, total)
    short = found.groupBy("query").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= most).select(F.col("query").alias("node"))
    short = cut(wanted.join(short, "node", "left_anti"))
    if not short.isEmpty():
        raw = F.pandas_udf(lambda s: s.map(lambda v: _unit(np.asarray(v, float)[None])[0].astype(np.float32).tobytes()), "binary")
        scaled = F.pandas_udf(lambda s: s.map(lambda v: (np.asarray(v, float) / greatest).astype(np.float32).tobytes()), "binary")
        blocks = -(-total // PIECE)
        none = F.lit(None).cast("array<bigint>").alias("keys")
        every = nodes.select(F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("cell"), F.lit(0).alias("piece"), F.lit(0).alias("kind"), "node", none, scaled("vec").alias("vec"))
        ask = short.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("cell"), F.lit(0).alias("piece"),
                           F.lit(1).alias("kind"), "node", none, raw("vec").alias("vec"))
        found = cut(_first(found.select("query", "node", "near").unionByName(_compared(every.unionByName(ask), keep)), keep))
    product = F.aggregate(F.zip_with("qv", "vec", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    scored = (found.join(nodes, "node").join(wanted.select(F.col("node").alias("query"), F.col("vec").alias("qv")), "query")
              .select("query", product.alias("score"), F.explode("ids").alias("it")).select("query", "score", "it.id", "it.row"))
    pairs = (asked.select(F.col("node").alias("query"), F.col("id").alias("query_id"), F.col("row").alias("own"))
             .join(scored, "query").where("own <> row"))
    order = W.partitionBy("own").orderBy(F.desc("score"), F.isnull("id"), "id", "row")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"))


def _first(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query", "node").agg(F.max("near").alias("near"))
    return best.withColumn("r", F.row_number().over(W.partitionBy("query").orderBy(F.desc("near"), "node"))).where(F.col("r") <= k).drop("r")


def _pieces(index: DataFrame, asks: DataFrame) -> DataFrame:
    """Index entries and visits of one cell, both dealt to the pieces of large cells."""
    sizes = cut(index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces")).where("pieces > 1"))
    if sizes.isEmpty():
        return index.withColumn("piece", F.lit(0)).unionByName(asks.withColumn("piece", F.lit(0)))
    pieces = F.coalesce("pieces", F.lit(1))
    dealt = index.join(sizes, "cell", "left").withColumn("piece", F.pmod(F.xxhash64("node"), pieces).cast("int")).drop("pieces")
    return dealt.unionByName(asks.join(sizes, "cell", "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("pieces"))
