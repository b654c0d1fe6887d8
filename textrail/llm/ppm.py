"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts up to ORDER bytes, held as one table per
order: a row for each context and next byte with its count in the training
texts.  A byte is coded in its longest known context; a byte that is new there
escapes to the next shorter one with the probability d / 2n (d different
bytes among n, method D), and the bytes of the longer context are excluded
below it.  Under order 0 all 256 symbols are alike.  As a context's bytes are
a part of those of its suffix, what is left after an exclusion is known for
each context, so the code length of every (context, byte) is worked out once,
order by order, with joins and windows of at most 256 rows.

A text is the sequence of its words, A-Z lowered, with one space between two
and an end symbol; contexts at its start hold start symbols.  UTF-8 has no
bytes 0xFE and 0xFF, which stand for the two.

Neither texts nor models pass through the driver.  Documents are dealt with in
blocks: a block asks once for each different gram and word that it holds and
gets back their code lengths and counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import narrow_batches, release, settled, small_batches, stored
from .words import LOWER, SPACE, parts

ORDER = 5
END, START = 0xFE, 0xFF
#: Bytes of text, about, in a block.
BLOCK_BYTES = 48_000_000
#: Answers that a task gathers before it hands them out by block.
GATHER = 2_000_000
#: Bytes of text whose grams are held at once.
PART = 1 << 21
_TABLE = bytes(LOWER.tolist())


def grams(raw: np.ndarray, at: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The gram (context and byte, order + 1 bytes in one integer) of each
    symbol of each text, and the text's number."""
    n = len(at) - 1
    inside = ~SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][np.diff(at) > 0]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    text = np.repeat(np.arange(n, dtype=np.int32), np.diff(at))
    doc = text[starts]
    keep = inside.copy()
    keep[starts[1:][doc[1:] == doc[:-1]] - 1] = True  # one space before every word but a text's first
    here = np.flatnonzero(keep)
    of = text[here]
    size = np.bincount(of, minlength=n)
    ends = np.cumsum(size + order + 1) - 1
    symbols = np.full(len(here) + n * (order + 1), START, np.uint8)
    symbols[ends] = END
    plain = np.ones(len(symbols), bool)
    plain[ends] = False
    plain[(np.r_[0, ends[:-1] + 1][:, None] + np.arange(order)).ravel()] = False
    symbols[plain] = np.where(inside[here], LOWER[raw[here]], 32)
    plain[ends] = True
    return _keys(symbols, order)[plain], np.repeat(np.arange(n), size + 1)


def _keys(symbols: np.ndarray, order: int) -> np.ndarray:
    """For each place the last order + 1 symbols, the latest in the low byte."""
    key, have = symbols.astype(np.int64), 1
    while have <= order:  # twice as many symbols in each step
        more = min(have, order + 1 - have)
        earlier = key[:-have] if more == have else key[:-have] & ((1 << 8 * more) - 1)
        longer = key.copy()
        longer[have:] |= earlier << (8 * have)
        key, have = longer, have + more
    return key


def _words(raw: np.ndarray, at: np.ndarray) -> Iterator[list[bytes]]:
    data = raw.tobytes().translate(_TABLE)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield data[a:b].split()


def _features(src: DataFrame, order: int) -> DataFrame:
    """(block, key, word, n): the different grams (word null) and words (key
    null) of each block with their counts in its training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, words = None, [], [], Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            key, n = _summed(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.int64),) * 2
            for k, w, c in ((key, None, n), (None, sorted(words), None)):
                size = len(k) if w is None else len(w)
                for lo in range(0, size, 100_000):
                    m = min(100_000, size - lo)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(m, now)), pa.array(k[lo:lo + m]) if w is None else pa.nulls(m, pa.int64()),
                        pa.nulls(m, pa.string()) if w is None else pa.array([x.decode() for x in w[lo:lo + m]], pa.string()),
                        pa.array(c[lo:lo + m]) if w is None else pa.array([words[x] for x in w[lo:lo + m]], pa.int64())], names=["block", "key", "word", "n"])

        for batch in batches:
            block = batch.column("block").to_numpy()
            for a, b in _runs(block):
                if block[a] != now:
                    if now is not None:
                        yield from flush()
                    now, keys, counts, words = int(block[a]), [], [], Counter()
                part = batch.slice(a, b - a)
                train = part.column("train").to_numpy(zero_copy_only=False).astype(bool)
                for first, last, raw, at in parts(part.column("text"), PART):
                    key, doc = grams(raw, at, order)
                    learned = train[first:last][doc]
                    for some, one in ((key[learned], 1), (key[~learned], 0)):
                        some, n = _counted(np.sort(some))
                        keys.append(some)
                        counts.append(n * one)
                    for t, found in zip(train[first:last], _words(raw, at), strict=True):
                        if t:
                            words.update(found)
                        else:
                            words.update(dict.fromkeys(found, 0))
        if now is not None:
            yield from flush()

    return small_batches(src.select("block", "train", "text")).mapInArrow(run, "block bigint, key bigint, word string, n bigint")


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of a sorted array and how often each stands in it."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.r_[first, len(values)])


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return key, n
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n, first)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def code_lengths(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, lp): log10 of the probability of each gram's byte in its context,
    from (key, c), the grams' training counts (0: asked for, but not learned)."""
    top = counts
    below: DataFrame | None = None
    for j in range(order + 1):
        mask = F.lit((1 << 8 * (j + 1)) - 1)
        level = (top.groupBy(F.col("key").bitwiseAND(mask).alias("key")).agg(F.sum("c").alias("c")) if j < order else top.select("key", "c"))
        context = W.partitionBy(F.shiftright("key", 8))
        own = [F.sum("c").over(context).alias("n"), F.sum((F.col("c") > 0).cast("long")).over(context).alias("d")]
        if below is None:
            rows = level.select("key", "c", *own)
            after = -F.log10(F.lit(256) - F.col("d"))
            shorter = F.lit(-float(np.log10(256)))
        else:
            lower = below.select(F.col("key").alias("low"), F.col("c").alias("lc"), F.col("n").alias("ln"), F.col("d").alias("ld"), F.col("after").alias("la"), F.col("lp").alias("llp"))
            joined = level.withColumn("low", F.col("key").bitwiseAND(F.lit((1 << 8 * j) - 1))).join(lower, "low")
            # of the shorter context, what the exclusion of this one's bytes leaves
            rows = joined.select("key", "c", "lc", "la", "llp", "ln", "ld", *own, F.sum(F.when(F.col("c") > 0, F.col("lc"))).over(context).alias("x"))
            t, d = F.col("ln") - F.coalesce("x", F.lit(0)), F.col("ld") - F.col("d")
            after = F.when(t <= 0, F.col("la")).when(F.col("lc") > 0, F.log10((2 * F.col("lc") - 1) / (2 * t))).otherwise(F.log10(d / (2 * t)) + F.col("la"))
            shorter = F.col("llp")
        rows = rows.withColumn("after", after)
        lp = (F.when(F.col("c") > 0, F.log10((2 * F.col("c") - 1) / (2 * F.col("n"))))
              .when(F.col("n") > 0, F.log10(F.col("d") / (2 * F.col("n"))) + F.col("after")).otherwise(shorter))
        below = rows.withColumn("lp", lp).select("key", "c", "n", "d", "after", "lp")
    return below.select("key", "lp")


def score(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every
    row; the model learns from the rows where ``train`` holds.

    ``score`` is the log10 probability of the text (its words, one space
    between two, and the end), ``base_score`` that of its words and end under
    add-half word counts.  A null text counts as empty: the end alone.  Without
    training rows all symbols are alike.  Repeated rows count and score as
    often as they stand; an empty table gives an empty result.  Other columns
    are not read.
    """
    df = settled(df)
    src = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    about = src.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"), F.sum(F.col("train").cast("long")).alias("ends")).first()
    mean = max(1.0, (about["size"] or 0) / max(about["n"], 1))
    # a block is this many neighbouring rows of a partition; the scores don't depend on it
    shift = int(np.clip(np.log2(BLOCK_BYTES / mean), 0, 16))
    src = src.withColumn("block", F.shiftright("row", shift))
    asked = stored(_features(src, order))
    sums = asked.where("key is not null").groupBy("key").agg(F.sum("n").alias("c"))
    learned = stored(sums)
    lengths = stored(code_lengths(learned, order))
    release(learned)
    vocabulary = stored(asked.where("word is not null").groupBy("word").agg(F.sum("n").alias("c")))
    known = vocabulary.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    ends = about["ends"] or 0
    total, kinds = (known["n"] or 0) + ends, (known["v"] or 0) + (ends > 0)
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, lp = (np.concatenate([np.frombuffer(x.as_py(), t) for x in answers.column(c)]) if answers.num_rows else np.zeros(0, t)
                    for c, t in (("keys", np.int64), ("lps", np.float32)))
        by = np.argsort(keys)
        keys, lp = keys[by], lp[by].astype(float)
        words = [w for x in answers.column("words") for w in x.as_py().split()]
        counts = np.frombuffer(b"".join(x.as_py() for x in answers.column("counts")), np.int64)
        value = np.log10((counts + 0.5) / (total + 0.5 * (kinds + 1)))
        base = dict(zip(words, value.tolist(), strict=True))
        fresh = float(np.log10(0.5 / (total + 0.5 * (kinds + 1))))
        end = float(np.log10((ends + 0.5) / (total + 0.5 * (kinds + 1))))
        out: list[tuple] = []
        text = pa.concat_arrays(docs.column("text").chunks)
        for first, last, raw, at in parts(text, PART):
            key, doc = grams(raw, at, order)
            code, key = pd.factorize(key)
            model = np.bincount(doc, weights=lp[np.searchsorted(keys, key)][code], minlength=last - first)
            for s, found in zip(model.tolist(), _words(raw, at), strict=True):
                parts_ = list(map(base.__getitem__, found))
                out.append((len(found) + 1, len(found) - parts_.count(fresh) + (ends > 0), total, sum(parts_) + end, s))
        cols = list(zip(*out, strict=True)) if out else [()] * 5
        kinds_ = [pa.int64()] * 3 + [pa.float64()] * 2
        return pa.table([docs.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(cols, kinds_, strict=True))], names=[c.split()[0] for c in schema.split(", ")])

    grams_ = asked.where("key is not null").select("block", "key").join(lengths, "key").select("block", "key", "lp", F.lit(None).cast("string").alias("word"), F.lit(None).cast("long").alias("c"))
    words = asked.where("word is not null").select("block", "word").join(vocabulary, "word").select("block", F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("lp"), "word", "c")
    answers = stored(_packed(grams_.unionByName(words)))
    del grams_, words, sums
    for done in (asked, lengths, vocabulary):
        release(done)
    return small_batches(src.select("block", "doc_id", "text")).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def _packed(answers: DataFrame) -> DataFrame:
    """The answers that a task holds for a block in one row: keys and their
    code lengths (in single precision: seven digits of each; the sums are
    double), words (joined by spaces) and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            block = rows.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            block, rows = block[order], rows.take(pa.array(order))
            out = []
            for a, b in _runs(block):
                part = rows.slice(a, b - a)
                g, w = part.filter(pc.is_valid(part.column("key"))), part.filter(pc.is_valid(part.column("word")))
                out.append((int(block[a]), g.column("key").to_numpy().tobytes(), g.column("lp").to_numpy().astype(np.float32).tobytes(),
                            " ".join(w.column("word").to_pylist()).encode(), w.column("c").to_numpy().astype(np.int64).tobytes()))
            cols = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [pa.int64(), *[pa.binary()] * 4], strict=True)],
                                              names=["block", "keys", "lps", "words", "counts"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= GATHER:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return narrow_batches(answers).mapInArrow(run, "block bigint, keys binary, lps binary, words binary, counts binary")
