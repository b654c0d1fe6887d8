"""Spelling variants: pairs of words one edit apart, by finite-state composition.

The vocabulary is cut into initial-state partitions: of two words one edit
apart, with L code points in the shorter, either the first L // 2 agree or the
last L - L // 2, so both stand in a partition named by L and that half, in
which an acceptor only has to read what follows it (the second kind reads
backwards).  In a partition, the acceptor of the words of L code points is
composed with a transducer that copies, replaces or inserts one code point and
with the acceptor of all its words, of L and L + 1; deletions are insertions
seen from the other word.

Acceptors are minimised, over many partitions at once: the trie's nodes are
named from the leaves up by the names of what they read, so states with equal
right languages are one.  Arcs carry how many words come before them, so that
a path sums up to its word's place.  The composition is expanded level by
level, trimmed from its final states, and its accepted paths are enumerated.

Partitions above LIMIT words are dealt to a grid of pieces, each composed on
its own, so that no partition has to fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, stored

#: Words of a partition in one piece.
LIMIT = 20_000
#: Words that are composed at a time, in whole partitions.
CHUNK = 20_000


class Acceptor:
    """Minimal acceptors of several sorted word lists, in one set of states.

    ``roots`` holds each list's initial state; a state's arcs lie at
    first[state]:first[state + 1], sorted by label, with the state they lead to
    and how many of the state's words come before those read through the arc.
    """

    def __init__(self, owner: np.ndarray, codes: np.ndarray, at: np.ndarray, lists: int):
        """Word k has the code points codes[at[k]:at[k + 1]] and belongs to
        list owner[k]; words are sorted by list and code points, and differ."""
        size = np.diff(at)
        alphabet, codes = np.unique(codes, return_inverse=True)
        wide = len(alphabet) + 1
        rows, node = np.arange(len(size)), owner.astype(np.int64)
        nodes, words = lists, [np.bincount(owner, minlength=lists)]
        final = [np.zeros(lists, bool)]
        parents, labels, children, levels = [], [], [], [(0, lists)]
        final[0][owner[size == 0]] = True
        depth = 0
        while True:  # the trie, level by level: sorted words make equal prefixes neighbours
            deeper = size[rows] > depth
            rows, node = rows[deeper], node[deeper]
            if not len(rows):
                break
            label = codes[at[rows] + depth]
            new = np.r_[True, (node[1:] != node[:-1]) | (label[1:] != label[:-1])]
            child = nodes + np.cumsum(new) - 1
            parents.append(node[new])
            labels.append(label[new])
            children.append(child[new])
            made = int(new.sum())
            words.append(np.bincount(child - nodes, minlength=made))
            ends = np.zeros(made, bool)
            depth += 1
            ends[child[size[rows] == depth] - nodes] = True
            final.append(ends)
            levels.append((nodes, nodes + made))
            nodes, node = nodes + made, child
        none = [np.zeros(0, np.int64)]
        parent, label, child = (np.concatenate(c or none) for c in (parents, labels, children))
        word, last = np.concatenate(words), np.concatenate(final)
        degree = np.bincount(parent, minlength=nodes)
        first = np.r_[0, np.cumsum(degree)]
        height, least = np.zeros(nodes, np.int64), np.where(last, 0, np.iinfo(np.int64).max)
        for k in range(len(parents) - 1, -1, -1):
            np.maximum.at(height, parents[k], height[children[k]] + 1)
            np.minimum.at(least, parents[k], least[children[k]] + 1)
        # states: nodes of one height that are final alike and have equal labels and states behind them
        state = np.full(nodes, -1)
        order = np.argsort(height, kind="stable")
        marks = np.r_[0, np.cumsum(np.bincount(height))]
        kept, states = [], 0
        for h in range(len(marks) - 1):
            here = order[marks[h]:marks[h + 1]]
            name, deg = last[here].astype(np.int64), degree[here]
            for j in range(int(deg.max(initial=0))):
                more = np.flatnonzero(deg > j)
                arc = first[here[more]] + j
                _, name[more] = np.unique((name[more] * wide + label[arc]) * (states + 1) + state[child[arc]], return_inverse=True)
            _, one, name = np.unique(deg * (len(here) + 2) + name, return_index=True, return_inverse=True)
            state[here] = states + name
            kept.append(here[one])
            states += len(one)
        kept = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        self.roots = state[:lists]
        self.final, self.least, self.greatest = last[kept], least[kept], height[kept]
        self.degree = degree[kept]
        self.first = np.r_[0, np.cumsum(self.degree)]
        arcs = _ranges(first[kept], self.degree)
        self.label, self.to = label[arcs], state[child[arcs]]
        before = np.cumsum(word[child[arcs]]) - word[child[arcs]]
        of = np.repeat(np.arange(states), self.degree)
        self.before = before - before[self.first[of]] + self.final[of] if len(arcs) else before
        self.wide = wide
        self.keys = of * wide + self.label
        # the labels that a state reads, folded to 64 bits
        self.reads = np.zeros(states, np.uint64)
        np.bitwise_or.at(self.reads, of, np.uint64(1) << (self.label % 64).astype(np.uint64))


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], ..., begin[0] + count[0] - 1, begin[1], ..."""
    total = int(count.sum())
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(total)


def compose(m: Acceptor, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k, u, v): for each k, the places of all words u of the list with root
    left[k] and v of the one with root right[k] such that v is u with exactly
    one code point replaced or inserted."""
    # level by level: nodes (state of u, state of v, edited), edges to the next level
    states = len(m.final) + 1
    key = (left * states + right) * 2
    nodes, begin = np.unique(key, return_inverse=True)
    levels: list[tuple] = []
    while len(nodes):
        edited, p, q = nodes % 2, nodes // 2 // states, nodes // 2 % states
        # copied: both read the same label
        src = np.repeat(np.arange(len(nodes)), m.degree[p])
        a = _ranges(m.first[p], m.degree[p])
        want = q[src] * m.wide + m.label[a]
        b = np.searchsorted(m.keys, want)
        ok = b < len(m.keys)
        ok[ok] = m.keys[b[ok]] == want[ok]
        src, a, b = src[ok], a[ok], b[ok]
        edges = [(src, m.to[a], m.to[b], edited[src], m.before[a], m.before[b])]
        plain = np.flatnonzero(edited == 0)
        if len(plain):
            # inserted: v alone reads a label
            src = np.repeat(plain, m.degree[q[plain]])
            b = _ranges(m.first[q[plain]], m.degree[q[plain]])
            edges.append((src, p[src], m.to[b], np.ones(len(src), np.int64), np.zeros(len(src), np.int64), m.before[b]))
            # replaced: they read different labels
            each = m.degree[p[src]]
            again, b = np.repeat(src, each), np.repeat(b, each)
            a = _ranges(m.first[p[src]], each)
            other = m.label[a] != m.label[b]
            again, a, b = again[other], a[other], b[other]
            edges.append((again, m.to[a], m.to[b], np.ones(len(again), np.int64), m.before[a], m.before[b]))
        src, p, q, e, x, y = (np.concatenate(c) for c in zip(*edges, strict=True))
        # what follows an edit must read a common word: its length and its first label must be possible
        meet = (m.least[p] <= m.greatest[q]) & (m.least[q] <= m.greatest[p])
        meet &= (m.final[p] & m.final[q]) | (m.reads[p] & m.reads[q] != 0)
        ok = (e == 0) | meet
        src, x, y, key = src[ok], x[ok], y[ok], ((p * states + q) * 2 + e)[ok]
        after, dst = np.unique(key, return_inverse=True)
        levels.append((nodes, src, dst, x, y))
        nodes = after
    # trimmed: from the last level back, only what leads to acceptance
    alive, trimmed = np.zeros(0, bool), []
    for nodes, src, dst, x, y in reversed(levels):
        accepts = (nodes % 2 == 1) & m.final[nodes // 2 // states] & m.final[nodes // 2 % states]
        keep = alive[dst] if len(alive) else np.zeros(len(dst), bool)
        src, dst, x, y = src[keep], dst[keep], x[keep], y[keep]
        alive = accepts.copy()
        alive[src] = True
        order = np.argsort(src, kind="stable")
        trimmed.append((accepts, np.bincount(src, minlength=len(nodes)), dst[order], x[order], y[order]))
    # enumerated: every partial path leads to a pair
    found = []
    k = np.flatnonzero(alive[begin]) if len(alive) else np.zeros(0, np.int64)
    at, u, v = begin[k], np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
    for accepts, count, dst, x, y in reversed(trimmed):
        done = accepts[at]
        found.append((k[done], u[done], v[done]))
        first = np.cumsum(count) - count
        edge = _ranges(first[at], count[at])
        path = np.repeat(np.arange(len(at)), count[at])
        k, at, u, v = k[path], dst[edge], u[path] + x[edge], v[path] + y[edge]
    none = [tuple(np.zeros(0, np.int64) for _ in range(3))]
    k, u, v = (np.concatenate(c) for c in zip(*(found or none), strict=True))
    # a code point inserted anywhere in a run of its like: several paths, one pair
    order = np.lexsort((v, u, k))
    k, u, v = k[order], u[order], v[order]
    once = np.r_[True, (k[1:] != k[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])] if len(k) else np.zeros(0, bool)
    return k[once], u[once], v[once]


def near_pairs(cell: np.ndarray, role: np.ndarray, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (u, v) with u a left word (role bit 1) and v a right word (bit 2)
    of one cell, v being u with one code point replaced or inserted.  Rows are
    sorted by cell and code points; a cell's words differ."""
    names, cell = np.unique(cell, return_inverse=True)
    lefts, rights = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    rows = np.r_[lefts, rights]  # lists 0 .. n - 1 are the cells' left words, the others their right words
    owner = np.r_[cell[lefts], cell[rights] + len(names)]
    size = np.diff(at)[rows]
    m = Acceptor(owner, codes[_ranges(at[rows], size)], np.r_[0, np.cumsum(size)], 2 * len(names))
    begins = np.searchsorted(owner, np.arange(2 * len(names)))
    full = np.bincount(owner, minlength=2 * len(names)) > 0
    both = np.flatnonzero(full[:len(names)] & full[len(names):])
    k, u, v = compose(m, m.roots[both], m.roots[both + len(names)])
    return rows[begins[both[k]] + u], rows[begins[both[k] + len(names)] + v]


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of every pair of the distinct
    words of ``vocab`` (word, n) that differ by exactly one replaced, inserted
    or deleted code point.  Words of one code point are near to no other: they
    have no half.  The work on a word grows with its length."""
    word, size = F.col("word"), F.char_length("word")
    backward = F.reverse(word)

    def places(length: Column, short: int) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        rest = length - half
        forward = F.struct(F.lit(0).alias("side"), length.alias("length"), F.substring(word, F.lit(1), half).alias("half"),
                           F.substring(word, half + 1, size).alias("rest"), F.lit(short | 2).alias("role"))
        back = F.struct(F.lit(1).alias("side"), length.alias("length"), F.substring(backward, F.lit(1), rest).alias("half"),
                        F.substring(backward, rest + 1, size).alias("rest"), F.lit(short | 2).alias("role"))
        return [forward, back]

    placed = (vocab.where(size >= 2).select("n", F.explode(F.array(*places(size, 1), *places(size - 1, 0))).alias("at")).select("n", "at.*").where("length >= 2"))
    cell = ["side", "length", "half"]
    large = cut(placed.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / LIMIT).cast("int").alias("pieces")).where("pieces > 1"))
    if large.isEmpty():
        dealt = placed.withColumn("piece", F.lit(0))
    else:
        spread = placed.join(large, cell, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
        spread = spread.withColumn("own", F.pmod(F.xxhash64("rest"), F.col("pieces")).cast("int"))
        grid = F.sequence(F.lit(0), F.col("pieces") - 1)
        # as a left word in its row of the grid, as a right word in its column
        rows = spread.where("role & 1 = 1").select("*", F.explode(grid).alias("j")).withColumn("piece", F.col("own") * F.col("pieces") + F.col("j")).withColumn("role", F.lit(1))
        cols = spread.select("*", F.explode(grid).alias("j")).withColumn("piece", F.col("j") * F.col("pieces") + F.col("own")).withColumn("role", F.lit(2))
        keep = ["n", *cell, "rest", "role", "piece"]
        dealt = rows.select(keep).unionByName(cols.select(keep)).groupBy("n", *cell, "rest", "piece").agg(F.sum("role").cast("int").alias("role"))
    order = [*cell, "piece"]
    dealt = dealt.repartition(*order).sortWithinPartitions(*order, "rest")
    schema = "side int, word string, near string, near_n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            side, length, piece, role, n = (table.column(c).to_numpy() for c in ("side", "length", "piece", "role", "n"))
            half, rest = table.column("half").to_pylist(), table.column("rest").to_pylist()
            new = np.r_[True, (side[1:] != side[:-1]) | (length[1:] != length[:-1]) | (piece[1:] != piece[:-1]) | np.fromiter((a != b for a, b in zip(half, half[1:], strict=False)), bool, len(half) - 1)]
            cell = np.cumsum(new) - 1
            # cells of one word have no pairs
            use = np.flatnonzero(np.bincount(cell)[cell] > 1)
            if not len(use):
                return
            texts = [rest[i] for i in use]
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
            u, v = near_pairs(cell[use], role[use], codes, np.r_[0, np.cumsum(size)])
            longer = size[v] > size[u]
            # seen from the other word too, an insertion is a deletion
            a, b = use[np.r_[u, v[longer]]], use[np.r_[v, u[longer]]]
            for lo in range(0, len(a), 10_000):
                i, j = a[lo:lo + 10_000].tolist(), b[lo:lo + 10_000].tolist()
                back = side[i] == 1
                yield pa.RecordBatch.from_arrays([pa.array(side[i]), pa.array([whole(half[x], rest[x], r) for x, r in zip(i, back, strict=True)], pa.string()),
                                                  pa.array([whole(half[x], rest[x], r) for x, r in zip(j, back, strict=True)], pa.string()), pa.array(n[j])],
                                                 names=["side", "word", "near", "near_n"])

        def whole(half: str, rest: str, back: bool) -> str:
            return (half + rest)[::-1] if back else half + rest

        held, rows, here = [], 0, None
        for batch in batches:
            begin = 0
            cols = [batch.column(c) for c in order]
            side, length, piece = (cols[c].to_numpy() for c in (0, 1, 3))
            half = cols[2].to_pylist()
            new = np.r_[(side[0], length[0], half[0], piece[0]) != here if batch.num_rows else False,
                        (side[1:] != side[:-1]) | (length[1:] != length[:-1]) | (piece[1:] != piece[:-1]) | np.fromiter((a != b for a, b in zip(half, half[1:], strict=False)), bool, max(len(half) - 1, 0))]
            for edge in np.flatnonzero(new):
                if rows + edge - begin >= CHUNK and rows + edge - begin > 0:
                    if edge > begin:
                        held.append(batch.slice(begin, edge - begin))
                    yield from found(held)
                    held, rows, begin = [], 0, edge
            if batch.num_rows > begin:
                held.append(batch.slice(begin))
                rows += batch.num_rows - begin
                here = (side[-1], length[-1], half[-1], piece[-1])
        if held:
            yield from found(held)

    pairs = dealt.mapInArrow(run, schema)
    # an insertion beside the middle is found on both sides: the first counts
    middle = F.floor(F.least(size, F.char_length("near")) / 2).cast("int")
    twice = (F.col("side") == 1) & (size != F.char_length("near")) & (F.substring(word, F.lit(1), middle) == F.substring("near", F.lit(1), middle))
    return pairs.where(~twice).drop("side")


def count_words(words: DataFrame, least: int, often: int) -> DataFrame:
    """(word, n): the distinct words of at least ``least`` code points that
    occur at least ``often`` times."""
    return words.where(F.char_length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often)


def group_variants(vocab: DataFrame, factor: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``vocab``
    (word, n), whose words differ.

    A word's form is its near word of largest n (ties: the smallest in
    code-point order) if that n is at least ``factor`` (2 or more) times its
    own; its root is where following forms ends, the word itself without a
    form.  A null word or count takes no part; an empty vocabulary gives no
    rows.  Other columns are not read.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms could run in circles")
    vocab = stored(vocab.select(F.col("word").cast("string"), F.col("n").cast("bigint")).where("word is not null and n is not null"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows = vocab.join(near, "word", "left")
    good = -F.col("best.less") >= factor * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                              F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")))
    # every step multiplies n, so few doublings of the steps reach every root
    root = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        up = root.select(F.col("word").alias("root"), F.col("root").alias("up"))
        step = cut(root.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")))
        root = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return rows.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
