"""Text-similarity metrics between paired texts.

Adjacent chunks meet in one exchange, by document and span of ``SPAN``
chunks, so even a huge document is spread over many tasks; the per-pair
scores are computed by one Arrow UDF that counts the n-grams
of many pairs at once - a narrow, shuffle-free step, where exploding every
n-gram would shuffle tens of rows per token.

Definitions (fixed by the reference's libraries):

* BLEU-4: clipped n-gram precision for n = 1..4, uniform weights, brevity
  penalty against the single reference; smoothing "method 1" replaces a
  zero numerator by 0.1; no matching unigram at all gives 0.
* ROUGE-n / ROUGE-L F1: lower case, ``[^a-z0-9]+`` -> space, white-space
  tokens; n-gram multiset overlap, or longest common subsequence.  The
  reference stems tokens (Porter); no stemmer ships here, so tokens are
  compared unstemmed.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values ----------------------------------------------------------
BLEU_WEIGHTS = (0.25, 0.25, 0.25, 0.25)
BLEU_EPSILON = 0.1
ROUGE_NON_ALNUM = re.compile(r"[^a-z0-9]+")
ROUGE_NON_ALNUM_LINE = re.compile(r"[^a-z0-9\n]+")
SPAN = 64                         # chunks of a document that are exchanged together
SLICE = 1 << 22                   # characters of texts whose n-grams are counted at once
# ---------------------------------------------------------------------------

METRICS_SCHEMA = T.StructType([T.StructField(n, T.DoubleType()) for n in ("bleu", "rouge1", "rouge2", "rougeL")])


def _ngrams(toks, n):
    return Counter(tuple(toks[i:i + n]) for i in range(len(toks) - n + 1))


def bleu(reference: list[str], hypothesis: list[str], smooth: bool = True) -> float:
    """Sentence BLEU-4 of ``hypothesis`` against one ``reference``."""
    nums, dens = [], []
    for n in range(1, len(BLEU_WEIGHTS) + 1):
        hyp = _ngrams(hypothesis, n) if len(hypothesis) >= n else Counter()
        ref = _ngrams(reference, n)
        nums.append(sum(min(c, ref[g]) for g, c in hyp.items()))
        dens.append(max(1, sum(hyp.values())))
    return _bleu(nums, dens, len(reference), len(hypothesis), smooth)


def _bleu(nums: list[int], dens: list[int], r: int, c: int, smooth: bool) -> float:
    """BLEU of clipped n-gram counts ``nums`` of ``dens``, ``r`` and ``c`` tokens long."""
    if nums[0] == 0:
        return 0.0
    bp = 1.0 if c > r else (0.0 if c == 0 else math.exp(1 - r / c))
    logs = []
    for w, num, den in zip(BLEU_WEIGHTS, nums, dens):
        if num == 0:
            if not smooth:
                return 0.0
            p = BLEU_EPSILON / den
        else:
            p = num / den
        logs.append(w * math.log(p))
    return bp * math.exp(math.fsum(logs))


def rouge_tokens(text: str) -> list[str]:
    return [t for t in ROUGE_NON_ALNUM.sub(" ", text.lower()).split() if t]


def _f1(overlap: int, n_pred: int, n_ref: int) -> float:
    p = overlap / n_pred if n_pred > 0 else 0.0
    r = overlap / n_ref if n_ref > 0 else 0.0
    return 2 * p * r / (p + r) if p + r > 0 else 0.0


def rouge_n(target: list[str], prediction: list[str], n: int) -> float:
    t, p = _ngrams(target, n), _ngrams(prediction, n)
    overlap = sum(min(c, t[g]) for g, c in p.items())
    return _f1(overlap, sum(p.values()), sum(t.values()))


def lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence length, bit-parallel over ``b``
    (one big-integer update per token of ``a``: O(len(a) * len(b) / 64))."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for j, y in enumerate(b):
        masks[y] = masks.get(y, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


def lcs_length_dp(a: list[str], b: list[str]) -> int:
    """Plain dynamic-programming LCS (reference for tests)."""
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if x == y else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def rouge_l(target: list[str], prediction: list[str]) -> float:
    return _f1(lcs_length(target, prediction), len(prediction), len(target))


def shared_ngrams(a: list[str], b: list[str], n_max: int) -> list[int]:
    """For n = 1..``n_max`` the size of the multiset overlap of the n-grams of
    ``a`` and ``b``: every n-gram of both gets a number, made of the numbers of
    its first n - 1 tokens and of its last, and is counted on both sides."""
    numbers: dict[str, int] = {}
    one_a, one_b = (np.array([numbers.setdefault(x, len(numbers)) for x in s], dtype=np.int64) for s in (a, b))
    out, at_a, at_b = [], one_a, one_b
    for n in range(1, n_max + 1):
        if n > 1:
            at_a, at_b = (at[:-1] * len(numbers) + one[n - 1:] for at, one in ((at_a, one_a), (at_b, one_b)))
        if not len(at_a) or not len(at_b):
            return out + [0] * (n_max + 1 - n)
        at = np.unique(np.concatenate([at_a, at_b]), return_inverse=True)[1]
        at_a, at_b = at[:len(at_a)], at[len(at_a):]
        out.append(int(np.minimum(np.bincount(at_a, minlength=at.max() + 1), np.bincount(at_b, minlength=at.max() + 1)).sum()))
    return out


def pair_scores(a: str | None, b: str | None, with_lcs: bool = True) -> dict:
    """All scores of a pair; the n-grams are compared as numbers."""
    a = a or ""
    b = b or ""
    ta, tb = rouge_tokens(a), rouge_tokens(b)
    ref, hyp = a.split(), b.split()
    nums = shared_ngrams(ref, hyp, len(BLEU_WEIGHTS))
    over = shared_ngrams(ta, tb, 2)
    f1 = [_f1(over[n - 1], max(0, len(tb) - n + 1), max(0, len(ta) - n + 1)) for n in (1, 2)]
    return {"bleu": _bleu(nums, [max(1, len(hyp) - n) for n in range(len(BLEU_WEIGHTS))], len(ref), len(hyp), True),
            "rouge1": f1[0], "rouge2": f1[1], "rougeL": rouge_l(ta, tb) if with_lcs else None}


def split_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct pieces between the spaces of all texts, the pieces of each
    text in order as numbers, and the text of each."""
    lists = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), " ")
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())


def _numbered(lines: list[str], at: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers, and the text of each, of texts made of pieces; ``lines``
    holds each piece's tokens between spaces."""
    distinct, tokens, line = split_pieces(pa.array(lines, pa.large_string()))
    real = (pc.utf8_length(distinct).to_numpy() > 0)[tokens]
    tokens, n = tokens[real].astype(np.int64), np.bincount(line[real], minlength=len(lines))
    of, first = n[at], (np.cumsum(n) - n)[at]
    return tokens[np.repeat(first - (np.cumsum(of) - of), of) + np.arange(of.sum())], np.repeat(text, of)


def _numbered_words(pieces: list[str], at: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if " ".join(pieces).split() == pieces:                    # no other white space: each piece is a token
        return at.astype(np.int64), text
    return _numbered([" ".join(p.split()) for p in pieces], at, text)


def _numbered_rouge(pieces: list[str], at: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens as :func:`rouge_tokens` has them, of all pieces in one pass of the pattern."""
    lines = "\n".join(pieces)
    if lines.count("\n") >= len(pieces):                      # a piece holds some
        lines = "\n".join(p.replace("\n", " ") for p in pieces)
    return _numbered(ROUGE_NON_ALNUM_LINE.sub(" ", lines.lower()).split("\n"), at, text)


def _shared(tokens: np.ndarray, text: np.ndarray, n_max: int, pairs: int) -> np.ndarray:
    """:func:`shared_ngrams` of texts ``i`` and ``pairs + i`` for every pair, as
    ``(n_max, pairs)``.  Sorted by pair, n-gram and side, the n-grams that both
    sides have are neighbouring runs."""
    out, at, base = np.zeros((n_max, pairs), dtype=np.int64), tokens, int(tokens.max(initial=0)) + 1
    for n in range(1, n_max + 1):
        if n > 1:
            at = pd.factorize(at[:-1] * base + tokens[n - 1:])[0]
        if not len(at):
            break
        whole = text[:len(at)] == text[n - 1:]
        side = text[:len(at)][whole] >= pairs
        grams = int(at.max()) + 1
        runs = np.sort(((text[:len(at)][whole] - pairs * side) * grams + at[whole]) * 2 + side)
        first = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]][:len(runs)])
        count, gram = np.diff(np.r_[first, len(runs)]), runs[first] >> 1
        both = np.flatnonzero(gram[1:] == gram[:-1])
        out[n - 1] = np.bincount(gram[both] // grams, np.minimum(count[both], count[both + 1]), minlength=pairs)
    return out


def batch_scores(a: pa.Array, b: pa.Array, with_lcs: bool = True) -> pa.Array:
    """:func:`pair_scores` of each pair.  No token spans a space, so only the
    distinct pieces between spaces are parted into tokens."""
    n, rows = len(a), []
    distinct, at, text = split_pieces(pa.concat_arrays([a, b]))
    pieces = distinct.to_pylist()
    words, rouge = _numbered_words(pieces, at, text), _numbered_rouge(pieces, at, text)
    n_words, n_rouge = (np.bincount(x[1], minlength=2 * n).tolist() for x in (words, rouge))
    nums, over = _shared(*words, len(BLEU_WEIGHTS), n).T.tolist(), _shared(*rouge, 2, n).T.tolist()
    for i in range(n):
        ref, hyp, ta, tb = n_words[i], n_words[n + i], n_rouge[i], n_rouge[n + i]
        f1 = [_f1(over[i][k - 1], max(0, tb - k + 1), max(0, ta - k + 1)) for k in (1, 2)]
        lcs = rouge_l(*(rouge_tokens(s[i].as_py() or "") for s in (a, b))) if with_lcs else None
        rows.append((_bleu(nums[i], [max(1, hyp - k) for k in range(len(BLEU_WEIGHTS))], ref, hyp, True), *f1, lcs))
    return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.float64()) for k in range(4)], METRICS_SCHEMA.names)


def in_slices(fn, a: pa.Array, b: pa.Array) -> pa.Array:
    """``fn`` of two columns of texts, about ``SLICE`` characters at a time."""
    size = sum(pc.utf8_length(s).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for s in (a, b))
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE)) + 1).tolist(), len(a)]
    return pa.concat_arrays([fn(a[lo:hi], b[lo:hi]) for lo, hi in zip(cuts, cuts[1:])])


@F.arrow_udf(METRICS_SCHEMA)
def _scores_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return in_slices(batch_scores, a, b)


@F.arrow_udf(METRICS_SCHEMA)
def _scores_no_lcs_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return in_slices(lambda x, y: batch_scores(x, y, with_lcs=False), a, b)


def text_pair_metrics(pairs: DataFrame, reference: str, candidate: str, out: str = "m",
                      with_lcs: bool = True) -> DataFrame:
    """M1-M3: BLEU-4 and ROUGE-1/2/L F1 of ``candidate`` against ``reference``
    (ROUGE-L left null when ``with_lcs`` is false)."""
    fn = _scores_udf if with_lcs else _scores_no_lcs_udf
    return pairs.withColumn(out, fn(F.col(reference), F.col(candidate)))


def adjacent_pairs(chunks: DataFrame, id_col: str, order_col: str, text_col: str,
                   by_document: bool = True) -> DataFrame:
    """Consecutive chunks as ``(id, order, text_a, text_b)``.

    ``by_document``: chunk ``order`` and ``order + 1`` of the same document;
    texts are exchanged once, by document and span of ``SPAN`` numbers, and a
    span's first chunk to the span before it as well.  Rows that share a number
    are all paired; rows without id or number have no pair.  Otherwise
    consecutive over the whole sequence ordered by ``(id, order)``: positions
    come from distributed running numbers, so no single-partition window is
    used."""
    if by_document:
        shifted = F.col(order_col) + SPAN // 2                # chunk 0 is no span's first
        span = F.floor(shifted / SPAN)
        rows = (chunks.where(F.col(id_col).isNotNull() & F.col(order_col).isNotNull())
                .select(id_col, order_col, F.col(text_col).alias("text_a"),
                        F.explode(F.when(F.pmod(shifted, F.lit(SPAN)) == 0, F.array(span, span - 1)).otherwise(F.array(span))).alias("_span")))
        after = Window.partitionBy(id_col, "_span").orderBy(order_col).rangeBetween(1, 1)
        met = rows.withColumn("_next", F.collect_list(F.struct("text_a")).over(after)).where(F.col("_span") == span)
        return (met.select(id_col, order_col, "text_a", F.explode("_next").alias("_b"))
                .select(id_col, order_col, "text_a", F.col("_b.text_a").alias("text_b")))
    from .offsets import global_offsets
    keyed = chunks.select(F.struct(id_col, order_col).alias("_k"), F.col(text_col).alias("_t"))
    pos = global_offsets(keyed.select("_k", F.lit(1).alias("_one")), "_k", "_one", "_pos").drop("_one")
    seq = keyed.join(pos, "_k")
    a = seq.select("_pos", F.col("_k").alias("_ka"), F.col("_t").alias("text_a"))
    b = seq.select((F.col("_pos") - 1).alias("_pos"), F.col("_t").alias("text_b"))
    return (a.join(b, "_pos").select(F.col(f"_ka.{id_col}").alias(id_col), F.col(f"_ka.{order_col}").alias(order_col),
                                     "text_a", "text_b"))


def overlap_report(scored: DataFrame, cols=("cosine", "bleu", "rouge1", "rouge2", "rougeL")) -> DataFrame:
    """M4: mean of each metric over all pairs (one row)."""
    return scored.agg(*[F.avg(c).alias(f"avg_{c}") for c in cols], F.count(F.lit(1)).cast("bigint").alias("n_pairs"))
