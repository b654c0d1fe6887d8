"""Near-duplicate documents by ProbMinHash.

A document is the multiset of its shingles of five words.  Every shingle of a
document starts a Poisson process whose rate is its count: its arrivals, drawn
from a hash of the shingle, fall on random registers of the signature, and a
register keeps the shingle that arrives first.  A shingle stops as soon as it
is later than the slowest register.  Two documents agree in a register with
the probability Jaccard similarity of their weights.

Banding: documents that agree in all registers of a band share a bucket.
Buckets of equal members are taken once, and a large bucket is cut into blocks
whose pairs are pieces of their own.  Verification: a piece compares all its
documents exactly, the shared mass of each pair coming from a product of
matrices, and gives the links of a spanning forest, which keep the classes
that all its links make.

Equal texts are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix64, settled, small_batches
from .graph import components
from .words import parts, shingles, weighted, word_hashes

BANDS, ROWS = 24, 6
WORDS = 5
SIMILAR = 0.8
#: Documents of a bucket that are compared with one another in one piece.
BLOCK = 512


def signatures(key: np.ndarray, doc: np.ndarray, count: np.ndarray, n: int, size: int = BANDS * ROWS) -> np.ndarray:
    """The winning shingle of each register (n x size) of texts given by
    their different shingles and counts; 0 for a text without shingles."""
    time = np.full(n * size, np.inf)
    won = np.zeros(n * size, np.uint64)
    clock, number = np.zeros(len(key)), 0
    rate = count.astype(float)
    while len(key):
        number += 1
        r = mix64(key + np.uint64(number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        clock = clock - np.log1p(-(r >> np.uint64(11)).astype(float) * 2.0 ** -53) / rate
        slot = doc * size + (mix64(r) % np.uint64(size)).astype(np.int64)
        np.minimum.at(time, slot, clock)
        first = time[slot] == clock
        won[slot[first]] = key[first]
        here, at = np.unique(doc, return_inverse=True)
        going = clock < time.reshape(n, size)[here].max(axis=1)[at]
        if not going.all():
            key, doc, rate, clock = key[going], doc[going], rate[going], clock[going]
    return won.reshape(n, size)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two texts' (sorted shingles, counts):
    sum over shared i of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    pairs, n = np.unique(np.column_stack([x, y]), axis=0, return_counts=True)
    both = (pairs > 0).all(axis=1)
    p, q = pairs[both, 0][:, None], pairs[both, 1][:, None]
    spread = (np.maximum(pairs[:, 0] / p, pairs[:, 1] / q) * n).sum(axis=1) if both.any() else np.ones(0)
    return float((n[both] / spread).sum())


def _sign(src: DataFrame) -> DataFrame:
    """(_row, _id, _key, _bands) of (_row, _id, _key, _text)."""
    schema = f"_row bigint, _id {src.schema['_id'].dataType.simpleString()}, _key binary, _bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = []
            for first, last, raw, at in parts(batch.column("_text")):
                n = last - first
                key, doc, count = weighted(*shingles(*word_hashes(raw, at), WORDS))
                won = signatures(key, doc, count, n)
                some = np.bincount(doc, minlength=n) > 0
                band = np.zeros((n, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for j in range(ROWS):
                    band = mix64(band + won.reshape(n, BANDS, ROWS)[:, :, j])
                bands += [b.view(np.int64).tolist() if s else [] for b, s in zip(band, some, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("_id"), batch.column("_key"),
                                              pa.array(bands, pa.list_(pa.int64()))],
                                             names=["_row", "_id", "_key", "_bands"])

    return small_batches(src).mapInArrow(run, schema)


def forest(key: np.ndarray, doc: np.ndarray, count: np.ndarray, side: np.ndarray, crossing: bool) -> list[tuple[int, int]]:
    """Links of a spanning forest of the texts (by number) whose similarity is
    SIMILAR or more; ``crossing``: only pairs of different ``side`` count."""
    n = len(side)
    total = np.maximum(np.bincount(doc, weights=count, minlength=n), 1)
    plain = np.bincount(doc, weights=count > 1, minlength=n) == 0
    column, of = np.unique(key, return_inverse=True)
    often = np.bincount(of, minlength=len(column)) > 1
    place = np.cumsum(often) - 1
    use = often[of]
    row, col, value = doc[use], place[of[use]], count[use].astype(np.float32)
    mass = np.zeros((n, n))  # of the first text, in shingles of the second
    order = np.argsort(col, kind="stable")
    row, col, value = row[order], col[order], value[order]
    for lo in range(0, int(often.sum()), 4096):
        i, j = np.searchsorted(col, (lo, lo + 4096))
        x = np.zeros((n, 4096), np.float32)
        x[row[i:j], col[i:j] - lo] = value[i:j]
        mass += x @ (x > 0).T.astype(np.float32)
    # neither text can have a smaller part in common than their similarity
    bound = np.minimum(mass / total[:, None], mass.T / total[None, :])
    exact = np.where(plain[:, None] & plain[None, :], mass / (total[:, None] + total[None, :] - mass), bound)
    allowed = np.triu(exact >= SIMILAR - 1e-9, 1)
    if crossing:
        allowed &= side[:, None] != side[None, :]
    a, b = np.nonzero(allowed)
    best = np.argsort(-exact[a, b], kind="stable")
    cuts = np.searchsorted(doc, np.arange(n + 1))
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a[best].tolist(), b[best].tolist(), strict=True):
        p, q = find(x), find(y)
        if p == q:
            continue
        if not (plain[x] and plain[y]):
            bags = [(key[cuts[t]:cuts[t + 1]], count[cuts[t]:cuts[t + 1]]) for t in (x, y)]
            if probability_jaccard(*bags) < SIMILAR - 1e-9:
                continue
        root[p] = q
        out.append((x, y))
    return out


def _links(entries: DataFrame) -> DataFrame:
    """(a, b): the forest's links of every piece (g, i, j) of (node, block, text)."""
    dealt = entries.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "node")

    def solve(piece: pa.Table) -> Iterator[tuple[int, int]]:
        node = piece.column("node").to_numpy()
        bags, at = [], 0
        for first, last, raw, offsets in parts(pa.concat_arrays(piece.column("text").chunks)):
            key, doc, count = weighted(*shingles(*word_hashes(raw, offsets), WORDS))
            bags.append((key, doc + at, count))
            at += last - first
        i, j = piece.column("i")[0].as_py(), piece.column("j")[0].as_py()
        for x, y in forest(*(np.concatenate(c) for c in zip(*bags, strict=True)), piece.column("block").to_numpy(), i != j):
            yield int(node[x]), int(node[y])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            g, i, j = (rows.column(c).to_numpy() for c in ("g", "i", "j"))
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            begin, out = 0, []
            for end in cuts.tolist():
                out += solve(rows.slice(begin, end - begin))
                begin = end
            held = rows.slice(begin)
            yield _pairs(out)
        if held is not None and held.num_rows:
            yield _pairs(list(solve(held)))

    return small_batches(dealt).mapInArrow(run, "a bigint, b bigint")


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(out, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``_row, doc_id, class_id, class_size, kept``.

    Classes are the connected components of the links (similarity 0.8 or
    more) that banding finds.  ``class_id`` is the least id of the class; the
    row with that id (the first, if it is repeated) is kept.  Equal texts are
    always in one class; a null text counts as empty.  Texts without words are
    linked to equal texts only; texts of fewer than five words have one
    shingle.  Null ids come after all others, and a class of null ids alone
    has a null class_id.  An empty table gives an empty result.  No other
    columns are read.  ``_row`` numbers the rows of ``df`` as read.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    df = settled(df)
    src = df.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.unhex(F.md5(text)).alias("_key"), text.alias("_text"))
    rows = cut(_sign(src))
    nodes = cut(rows.groupBy("_key").agg(F.first("_bands").alias("_bands"), F.min("_row").alias("_first")))
    nodes = nodes.withColumn("node", F.monotonically_increasing_id())
    banded = nodes.select("node", F.explode("_bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = cut(banded.join(shared, "band"))
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "_first")
    texts = cut(src.select(F.col("_row").alias("_first"), F.col("_text").alias("text")).join(wanted, "_first").select("node", "text"))
    few = (shared.where(F.col("size") <= BLOCK).groupBy("band").agg(F.sort_array(F.collect_list("node")).alias("members"))
           .groupBy("members").agg(F.min("band").alias("g"))
           .select("g", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"), F.explode("members").alias("node")))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    many = (shared.where(F.col("size") > BLOCK).withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.col("band").alias("g"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node"))
    comp = components(_links(few.unionByName(many).join(texts, "node")))
    member = rows.select("_row", "_id", "_key").join(nodes.select("_key", "node"), "_key")
    member = cut(member.join(comp, "node", "left").select("_row", "_id", F.coalesce("comp", "node").alias("_comp")))
    first = F.struct(F.isnull("_id").alias("x"), F.col("_id").alias("id"), F.col("_row").alias("r"))
    classes = cut(member.groupBy("_comp").agg(F.min(first).alias("_least"), F.count(F.lit(1)).alias("_size")))
    return member.join(classes, "_comp").select("_row", F.col("_id").alias("doc_id"), F.col("_least.id").alias("class_id"),
                                                F.col("_size").alias("class_size"), (F.col("_row") == F.col("_least.r")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near copies (see near_groups),
    all columns but an own ``_row`` kept."""
    docs = settled(docs).withColumn("_row", F.monotonically_increasing_id())
    gone = near_groups(docs.drop("_row"), id_col, text_col).where("not kept").select("_row")
    return docs.join(gone, "_row", "left_anti").drop("_row")
