"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary classifier
(naive Bayes over byte 2- and 3-grams of the letters) tells the languages
whose bit is 1 from the others.  Decoding takes the language with the least
loss summed over the bits, each bit weighted by how well its classifier does
on that language; a text whose two best losses lie close is flagged.

The gram counts come from all training rows.  Only the slopes and weights of
the bits are fitted on a bounded sample (CALIBRATION rows).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_view, small_batches, texts_of
from .ngrams import CODES, LETTERS, codes, mean_weights

#: Training rows, about, on which the bits' slopes and weights are fitted.
CALIBRATION = 2000
#: Two best scores closer than this are ambiguous.
MARGIN = 0.2
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray        # languages x bits, of -1 and 1
    weights: np.ndarray     # grams x bits
    slope: np.ndarray       # bits
    trust: np.ndarray       # languages x bits, rows sum to 1


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of -1 and 1: all splits of up to six languages, otherwise
    random splits, about ten for each doubling of n."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 6:
        bits = [[1 if i == 0 or not c >> (i - 1) & 1 else -1 for i in range(n)] for c in range(1, 1 << (n - 1))]
        return np.array(bits, dtype=float).T
    rng, cols = np.random.default_rng(seed), []
    while len(cols) < int(10 * np.ceil(np.log2(n))) or len({tuple(r) for r in np.array(cols).T}) < n:
        col = rng.permutation(np.where(np.arange(n) % 2, 1, -1))
        cols.append(col)
    return np.array(cols, dtype=float).T


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in _LETTER.findall(text)) if not text.isascii() else bool(_LETTER.search(text))


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, at = byte_view(column)
    return codes(LETTERS[raw], at)


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, code, n) over all rows of (lang, text), summed within each task first.
    Code -1 counts the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            code, doc = _grams(batch.column("text"))
            names = np.array(batch.column("lang").to_pylist(), dtype=object)
            for name in set(names.tolist()):
                of = names == name
                sums = total.setdefault(name, np.zeros(CODES + 1, np.int64))
                sums[:CODES] += np.bincount(code[of[doc]], minlength=CODES)
                sums[CODES] += of.sum()
        for name, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(np.where(at == CODES, -1, at)), pa.array(sums[at])],
                                             names=["lang", "code", "n"])

    return small_batches(rows).mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, smooth: float = 0.5, calibration: int = CALIBRATION) -> Model:
    """Learn from all rows of (lang, text) whose lang and text are not null.
    The counts that reach the driver are bounded by languages times CODES."""
    rows = rows.where("lang is not null and text is not null")
    counts = gram_counts(rows).toPandas()
    sizes = counts[counts.code < 0]
    langs = sorted(sizes.lang)
    code = codewords(len(langs))
    table = np.zeros((len(langs), CODES))
    grams = counts[counts.code >= 0]
    table[[langs.index(x) for x in grams.lang], grams.code.to_numpy()] = grams.n.to_numpy()
    weights = np.zeros((CODES, code.shape[1]))
    # every language counts alike, however many rows it has
    share = table / np.maximum(table.sum(axis=1, keepdims=True), 1)
    seen = max(int((table.sum(axis=0) > 0).sum()), 1)
    scale = np.maximum(table.sum(axis=1).min(initial=1e6), 1e4)
    for b in range(code.shape[1]):
        yes, no = share[code[:, b] > 0].mean(axis=0), share[code[:, b] < 0].mean(axis=0)
        weights[:, b] = np.log(yes * scale + smooth) - np.log(no * scale + smooth)
        weights[table.sum(axis=0) == 0, b] = 0
    del seen
    model = Model(langs, code, weights, np.ones(code.shape[1]), np.full(code.shape, 1 / max(code.shape[1], 1)))
    if code.shape[1]:
        _calibrate(model, rows, int(sizes.n.sum()), calibration)
    return model


def _calibrate(model: Model, rows: DataFrame, n: int, calibration: int) -> None:
    part = min(1.0, calibration / max(n, 1))
    picked = rows.where((F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < F.lit(int(np.ceil(part * 1_000_003)))))
    bits = model.code.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, doc = _grams(batch.column("text"))
            margin = mean_weights(code, doc, batch.num_rows, model.weights)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), *(pa.array(c) for c in margin.T)], names=["lang", *map(str, range(bits))])

    schema = ", ".join(["lang string", *(f"`{b}` double" for b in range(bits))])
    # what is gathered: for each language and bit, sums over the sample
    sums = picked.mapInArrow(run, schema).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.abs(F.col(f"`{b}`"))).alias(f"a{b}") for b in range(bits)),
        *(F.sum((F.col(f"`{b}`") > 0).cast("int")).alias(f"p{b}") for b in range(bits))).collect()
    if not sums:
        return
    size = np.zeros(bits)
    right = np.full(model.code.shape, 0.5)
    for r in sums:
        k = model.langs.index(r["lang"])
        up = np.array([r[f"p{b}"] for b in range(bits)])
        right[k] = (np.where(model.code[k] > 0, up, r["n"] - up) + 1) / (r["n"] + 2)
        size += [r[f"a{b}"] for b in range(bits)]
    # a margin of the usual size speaks for its side with about 95 %
    model.slope = 3 / np.maximum(size / sum(r["n"] for r in sums), 1e-6)
    model.trust = right / right.sum(axis=1, keepdims=True)


def decode(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows of bit margins: the language's number, its score (0 to 1) and
    whether the second best is close."""
    n = len(margin)
    if len(model.langs) < 2:
        return np.zeros(n, int), np.ones(n), np.zeros(n, bool)
    side = margin[:, None, :] * model.slope * model.code
    loss = (np.logaddexp(0, -side) * model.trust).sum(axis=2)
    p = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * 4)
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    top = np.sort(p, axis=1)
    return best, top[:, -1], top[:, -1] - top[:, -2] < MARGIN


def predict(df: DataFrame, model: Model, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` columns, then ``lang_pred, score, ambiguous`` for every row.

    A text that is null or has no letter is ``und`` with score 0; so is every
    text if nothing was learned.  Each row stands alone: repeated rows get the
    same answer, an empty table gives an empty result.  ``keep`` names the
    columns to carry (default: all); the three results replace columns of
    their names.
    """
    kept = df.select(*(keep if keep is not None else [F.col(f"`{c}`") for c in df.columns]), F.col(f"`{text_col}`").alias("_text"))
    out = [f for f in kept.schema.fields if f.name not in ("_text", "lang_pred", "score", "ambiguous")]
    schema = T.StructType([*out, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])
    box = df.sparkSession.sparkContext.broadcast(model)  # bounded: CODES x bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = box.value
        langs = np.array(m.langs, dtype=object)
        for batch in batches:
            texts = batch.column("_text")
            code, doc = _grams(texts)
            best, score, close = decode(m, mean_weights(code, doc, batch.num_rows, m.weights))
            known = np.array([has_letter(t) for t in texts_of(texts)], bool) & bool(len(langs))
            name = np.where(known, langs[best] if len(langs) else UNKNOWN, UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in out), pa.array(name.tolist(), pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(close & known)],
                names=[*(f.name for f in out), "lang_pred", "score", "ambiguous"])

    return small_batches(kept).mapInArrow(run, schema)
