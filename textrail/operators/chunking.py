"""Chunking operators (table generators).

All operators take ``(df, id_col, text_col, **params)`` and return one row
per chunk.  Windows are built with ``sequence``/``slice``/``posexplode`` so
the work stays in generated code and is parallel over documents; no document
ever leaves its task.  Order-dependent packing folds (sentence packing) use
SQL ``aggregate`` with a struct accumulator; only the recursive character
splitter needs an Arrow UDF.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import WS, WS_CHARS
from ..functions.text import punct_tokens, strip, words
from .offsets import global_offsets

# --- fixed values ----------------------------------------------------------
SENTENCE_END = r"(?<=[.!?]) +"                 # sentence split, punctuation kept
HEADING = r"(?md)^([A-Z][A-Za-z0-9" + WS_CHARS + r"&\-]+)\n"
SEPARATORS = ("\n\n", "\n", " ")               # C8, coarse to fine
PART_CHARS, PART_ROWS = 1 << 20, 1 << 13       # C8: what a task holds of its chunks
SWEEP_THRESHOLDS = (50, 150, 300, 450)
SWEEP_OVERLAP_RATIO = 0.15
# ---------------------------------------------------------------------------


def _windows(tokens: Column, size: int, step: int, full_only: bool, early_stop: bool) -> Column:
    """Array of token windows over ``tokens``.

    * default: starts 0, step, 2*step ... < n (last may hold only overlap);
    * ``full_only``: only windows of exactly ``size`` tokens;
    * ``early_stop``: stop after the first window that reaches the end.
    """
    n = F.size(tokens)
    if full_only:
        last = n - size
        starts = F.when(n >= size, F.sequence(F.lit(0), last - (last % step), F.lit(step)))
    elif early_stop:
        k = F.when(n <= size, F.lit(1)).otherwise(F.lit(1) + F.ceil((n - size) / F.lit(step)).cast("int"))
        starts = F.when(n > 0, F.sequence(F.lit(0), (k - 1) * step, F.lit(step)))
    else:
        starts = F.when(n > 0, F.sequence(F.lit(0), n - 1 - ((n - 1) % step), F.lit(step)))
    starts = F.coalesce(starts, F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(tokens, s + 1, size))


def token_window(df: DataFrame, id_col: str, text_col: str, size: int = 500, overlap: int = 50,
                 name_col: Column | None = None, global_ids: bool = True, keep: tuple[str, ...] = (),
                 tokenizer: str = "ws") -> DataFrame:
    """Fixed token windows with overlap; blank chunks dropped.

    ``chunk_id`` is ``<name>_<counter>`` with one counter running over all
    documents in ``id_col`` order (0-based), or per document when
    ``global_ids=False``.  ``tokenizer``: ``"ws"`` (white-space tokens) or
    ``"punct"`` (word runs and single punctuation marks).
    """
    if size <= overlap:
        raise ValueError("size must exceed overlap")
    name = name_col if name_col is not None else F.col(id_col).cast("string")
    k = list(keep)
    tok_fn = {"ws": words, "punct": punct_tokens}[tokenizer]
    toks = df.select(F.col(id_col), *k, name.alias("_name"), tok_fn(F.col(text_col)).alias("_all"))
    if global_ids:
        # the window counts and the windows both come from these tokens:
        # materialise them once (reliable checkpoint in the shared folder)
        # instead of running the text rules twice
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        toks = toks.checkpoint(eager=True)
    exploded = (toks.select(id_col, *k, "_name", _windows(F.col("_all"), size, size - overlap, False, False).alias("_w"))
                .select(id_col, *k, "_name", F.posexplode_outer("_w").alias("chunk_no", "_toks"))
                .where(F.col("chunk_no").isNotNull())
                .select(id_col, *k, "_name", F.col("chunk_no").cast("bigint").alias("chunk_no"),
                        F.array_join("_toks", " ").alias("chunk_text"),
                        F.size("_toks").cast("bigint").alias("n_tokens"))
                # white-space tokens are never blank, so a window is blank
                # exactly when it has no token (no regex over every chunk)
                .where(F.col("n_tokens") > 0))
    if not global_ids:
        return exploded.select(id_col, *k, "chunk_no",
                               F.concat_ws("_", "_name", F.col("chunk_no").cast("string")).alias("chunk_id"),
                               "chunk_text", "n_tokens")
    step = size - overlap
    n_tok = F.size("_all")
    counts = toks.select(id_col, F.when(n_tok > 0, F.ceil(n_tok / F.lit(step))).otherwise(F.lit(0)).cast("bigint").alias("_n"))
    offs = global_offsets(counts, id_col, "_n", "_off").drop("_n")
    return (exploded.join(offs, id_col)
            .select(id_col, *k, "chunk_no",
                    F.concat_ws("_", "_name", (F.col("_off") + F.col("chunk_no")).cast("string")).alias("chunk_id"),
                    "chunk_text", "n_tokens"))


def sliding(df: DataFrame, id_col: str, text_col: str, window: int = 50, step: int = 25,
            name_col: Column | None = None) -> DataFrame:
    """Full windows only; id ``<name>_<i>`` per document."""
    name = name_col if name_col is not None else F.col(id_col).cast("string")
    return (df.select(F.col(id_col), name.alias("_name"), words(F.col(text_col)).alias("_all"))
            .select(id_col, "_name", _windows(F.col("_all"), window, step, True, False).alias("_w"))
            .select(id_col, "_name", F.posexplode_outer("_w").alias("chunk_no", "_toks"))
            .where(F.col("chunk_no").isNotNull())
            .select(id_col, F.col("chunk_no").cast("bigint").alias("chunk_no"),
                    F.concat_ws("_", "_name", F.col("chunk_no").cast("string")).alias("chunk_id"),
                    F.array_join("_toks", " ").alias("chunk_text"),
                    F.size("_toks").cast("bigint").alias("n_tokens")))


def fixed_words(df: DataFrame, id_col: str, text_col: str, size: int = 100) -> DataFrame:
    """Consecutive windows of ``size`` words, no overlap."""
    return token_window(df, id_col, text_col, size=size, overlap=0, global_ids=False)


def paragraphs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """CRLF/CR -> LF, split on blank line, strip, drop blanks.

    A document without any paragraph keeps one row with a null chunk.
    """
    norm = F.regexp_replace(F.regexp_replace(F.col(text_col), "\r\n", "\n"), "\r", "\n")
    paras = F.filter(F.transform(F.split(norm, "\n\n"), lambda p: strip(p)), lambda p: p != "")
    return (df.where(F.col(text_col).isNotNull())
            .select(id_col, F.posexplode_outer(paras).alias("chunk_no", "chunk_text"))
            .select(id_col, F.col("chunk_no").cast("bigint").alias("chunk_no"), "chunk_text"))


def section_hybrid(df: DataFrame, id_col: str, text_col: str, threshold: int = 300,
                   overlap: int | None = None) -> DataFrame:
    """Heading sections; short sections are one chunk, long ones are
    split in windows of ``threshold`` words with ``overlap`` and an early
    stop at the end.  Text before the first heading is dropped; a text
    without headings is one section called ``FullText``.
    """
    if overlap is None:
        overlap = int(threshold * SWEEP_OVERLAP_RATIO)
    return _section_chunks(df.select(id_col, text_col, F.lit(threshold).alias("threshold"),
                                     F.lit(overlap).alias("_ov")), id_col, text_col, keep_threshold=False)


def sweep(df: DataFrame, id_col: str, text_col: str, thresholds=SWEEP_THRESHOLDS,
          ratio: float = SWEEP_OVERLAP_RATIO) -> DataFrame:
    """C9 for every threshold in one scan (threshold as a column).

    Thresholds come from a literal array that is exploded per row - no join.
    """
    pairs = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(int(t * ratio)).alias("o")) for t in thresholds])
    return _section_chunks(df.select(id_col, text_col), id_col, text_col, keep_threshold=True, thresholds=pairs)


def _section_chunks(src: DataFrame, id_col: str, text_col: str, keep_threshold: bool,
                    thresholds: Column | None = None) -> DataFrame:
    """Sections are cut once per document; with ``thresholds`` (an array of
    (t, o) structs) each section's words are then windowed per threshold."""
    text = F.col(text_col)
    titles = F.regexp_extract_all(text, F.lit(HEADING), 1)
    bodies = F.split(text, HEADING)
    secs = F.when(F.size(titles) == 0,
                  F.array(F.struct(F.lit("FullText").alias("title"), text.alias("body"))))
    secs = secs.otherwise(F.arrays_zip(F.transform(titles, lambda t: strip(t)).alias("title"),
                                       F.slice(bodies, 2, 1 << 30).alias("body")))
    keys = [id_col] if thresholds is not None else [id_col, "threshold", "_ov"]
    sec = (src.select(*keys, F.posexplode_outer(secs).alias("section_no", "_s")).where(F.col("section_no").isNotNull())
           .select(*keys, "section_no", F.col("_s.title").alias("section"),
                   words(strip(F.col("_s.body"))).alias("_words")))
    if thresholds is not None:
        sec = (sec.select("*", F.explode(thresholds).alias("_p"))
               .select(id_col, F.col("_p.t").alias("threshold"), F.col("_p.o").alias("_ov"),
                       "section_no", "section", "_words"))
    n = F.size("_words")
    step = F.col("threshold") - F.col("_ov")
    k = F.when(n <= F.col("threshold"), F.lit(1)).otherwise(
        F.lit(1) + F.ceil((n - F.col("threshold")) / step).cast("int"))
    starts = F.sequence(F.lit(0), (k - 1) * step, F.when(step > 0, step).otherwise(F.lit(1)))
    wins = F.transform(starts, lambda s: F.slice(F.col("_words"), s + 1, F.col("threshold")))
    wins = F.when(n <= F.col("threshold"), F.array(F.col("_words"))).otherwise(wins)
    out = (sec.select(id_col, "threshold", "section_no", "section", F.posexplode_outer(wins).alias("_i", "_toks"))
           .where(F.col("_i").isNotNull())
           .select(id_col, *(["threshold"] if keep_threshold else []),
                   F.col("section_no").cast("bigint").alias("section_no"), "section",
                   (F.col("_i") + 1).cast("bigint").alias("chunk_no"),
                   F.concat(F.col("section"), F.lit("_"), (F.col("_i") + 1).cast("string")).alias("chunk_id"),
                   F.array_join("_toks", " ").alias("chunk_text"),
                   F.size("_toks").cast("bigint").alias("n_tokens")))
    return out


def sentences(c: Column | str, style: str = "punct", min_len: int = 20) -> Column:
    """C11 sentence splitters.

    ``punct``: split after ``.``/``!``/``?`` followed by spaces;
    ``dot``: split on ``'. '`` and keep stripped parts longer than 20 chars;
    ``line``: non-blank stripped lines.
    """
    x = F.col(c) if isinstance(c, str) else c
    if style == "punct":
        return F.split(x, SENTENCE_END)
    if style == "dot":
        return F.filter(F.transform(F.split(x, r"\. "), lambda s: strip(s)), lambda s: F.length(s) > min_len)
    if style == "line":
        return F.filter(F.transform(F.split(x, "\n"), lambda s: strip(s)), lambda s: s != "")
    raise ValueError(style)


def explode_sentences(df: DataFrame, id_col: str, text_col: str, style: str = "punct") -> DataFrame:
    return (df.select(id_col, F.posexplode_outer(sentences(text_col, style)).alias("sent_no", "sentence"))
            .where(F.col("sent_no").isNotNull())
            .select(id_col, F.col("sent_no").cast("bigint").alias("sent_no"), "sentence"))


# --- packing folds (C2-C4) ---------------------------------------------------

def _sentence_tokens(text: Column) -> Column:
    """Sentences (punctuation split) as arrays of white-space tokens."""
    return F.transform(F.split(text, SENTENCE_END), lambda s: words(s))


def sentence_pack(df: DataFrame, id_col: str, text_col: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """Add whole sentences while the total stays within ``size`` tokens;
    on overflow emit, then carry the last ``overlap`` tokens (all of them if
    the chunk is not longer than ``overlap``) plus the new sentence.

    Quirks kept: a first sentence longer than ``size`` emits an empty chunk,
    and a carried chunk may exceed ``size``.
    """
    init = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("cur"))

    def step(acc, toks):
        fits = F.size(acc["cur"]) + F.size(toks) <= size
        tail = F.when(F.lit(overlap) < F.size(acc["cur"]), F.slice(acc["cur"], -overlap, overlap)).otherwise(acc["cur"]) \
            if overlap > 0 else F.when(F.size(acc["cur"]) > 0, F.array().cast("array<string>")).otherwise(acc["cur"])
        return F.when(fits, F.struct(acc["out"].alias("out"), F.concat(acc["cur"], toks).alias("cur"))).otherwise(
            F.struct(F.concat(acc["out"], F.array(F.array_join(acc["cur"], " "))).alias("out"),
                     F.concat(tail, toks).alias("cur")))

    def finish(acc):
        return F.when(F.size(acc["cur"]) > 0, F.concat(acc["out"], F.array(F.array_join(acc["cur"], " ")))).otherwise(acc["out"])

    folded = F.aggregate(_sentence_tokens(F.col(text_col)), init, step, finish)
    return _explode_chunks(df, id_col, folded)


def dynamic_pack(df: DataFrame, id_col: str, text_col: str, size: int = 512) -> DataFrame:
    """Sentence packing without overlap; never emits an empty chunk;
    an over-long sentence becomes its own chunk."""
    init = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("cur"))

    def step(acc, toks):
        over = F.size(acc["cur"]) + F.size(toks) > size
        emitted = F.when(F.size(acc["cur"]) > 0, F.concat(acc["out"], F.array(F.array_join(acc["cur"], " ")))).otherwise(acc["out"])
        return F.when(over, F.struct(emitted.alias("out"), toks.alias("cur"))).otherwise(
            F.struct(acc["out"].alias("out"), F.concat(acc["cur"], toks).alias("cur")))

    def finish(acc):
        return F.when(F.size(acc["cur"]) > 0, F.concat(acc["out"], F.array(F.array_join(acc["cur"], " ")))).otherwise(acc["out"])

    folded = F.aggregate(_sentence_tokens(F.col(text_col)), init, step, finish)
    return _explode_chunks(df, id_col, folded)


def sentence_overlap(df: DataFrame, id_col: str, text_col: str, max_words: int = 120, overlap: int = 20,
                     overlap_unit: str = "sentence") -> DataFrame:
    """C4: emit when the word count would exceed ``max_words``, then keep the
    last ``overlap`` sentences (or, with ``overlap_unit='word'``, sentences
    covering the last words are not split: the last ``overlap`` words)."""
    # every sentence's words are counted once; the fold adds up the counts, and
    # a chunk's words are the sum of its sentences' (they are joined by a space)
    piece = "array<struct<s:string,n:int>>"
    sents = F.transform(F.transform(F.split(F.col(text_col), SENTENCE_END), lambda s: strip(s)),
                        lambda s: F.struct(s.alias("s"), F.size(words(s)).alias("n")))
    init = F.struct(F.array().cast("array<struct<chunk_text:string,n_tokens:int>>").alias("out"),
                    F.array().cast(piece).alias("cur"), F.lit(0).alias("len"))

    def emitted(acc):
        text = F.array_join(F.transform(acc["cur"], lambda x: x["s"]), " ")
        return F.concat(acc["out"], F.array(F.struct(text.alias("chunk_text"), acc["len"].alias("n_tokens"))))

    def step(acc, s):
        if overlap_unit == "sentence":
            # Python's cur[-k:] keeps everything when the list is short; Spark's
            # slice with a start before the first element returns nothing.
            kept = (F.when(F.size(acc["cur"]) > overlap, F.slice(acc["cur"], -overlap, overlap)).otherwise(acc["cur"])
                    if overlap > 0 else F.array().cast(piece))
        else:
            joined = words(F.array_join(F.transform(acc["cur"], lambda x: x["s"]), " "))
            tail = F.when(F.size(joined) > overlap, F.slice(joined, -overlap, overlap)).otherwise(joined)
            kept = F.when(F.size(tail) > 0, F.array(F.struct(F.array_join(tail, " ").alias("s"), F.size(tail).alias("n")))).otherwise(
                F.array().cast(piece))
        kept_len = F.aggregate(kept, F.lit(0), lambda a, x: a + x["n"])
        on_over = F.struct(emitted(acc).alias("out"), F.concat(kept, F.array(s)).alias("cur"), (kept_len + s["n"]).alias("len"))
        normal = F.struct(acc["out"].alias("out"), F.concat(acc["cur"], F.array(s)).alias("cur"), (acc["len"] + s["n"]).alias("len"))
        return F.when(acc["len"] + s["n"] > max_words, on_over).otherwise(normal)

    folded = F.aggregate(sents, init, step, lambda acc: F.when(F.size(acc["cur"]) > 0, emitted(acc)).otherwise(acc["out"]))
    return (df.select(id_col, F.posexplode_outer(folded).alias("chunk_no", "_c")).where(F.col("chunk_no").isNotNull())
            .select(id_col, F.col("chunk_no").cast("bigint").alias("chunk_no"), "_c.chunk_text", F.col("_c.n_tokens").cast("bigint").alias("n_tokens")))


def _explode_chunks(df: DataFrame, id_col: str, chunks: Column) -> DataFrame:
    return (df.select(id_col, F.posexplode_outer(chunks).alias("chunk_no", "chunk_text"))
            .where(F.col("chunk_no").isNotNull())
            .select(id_col, F.col("chunk_no").cast("bigint").alias("chunk_no"), "chunk_text",
                    F.size(words(F.col("chunk_text"))).cast("bigint").alias("n_tokens")))


# --- recursive character splitter (C8) ---------------------------------------

def _packed(cuts, size: int, overlap: int):
    """Spans between rising ``cuts``, none two of which are ``size`` or more
    apart: each takes all that fits into ``size`` characters and starts again
    at most ``overlap`` characters before the end of the one before."""
    last, lo = len(cuts) - 1, 0
    while lo < last:
        hi = bisect_right(cuts, cuts[lo] + size) - 1
        yield cuts[lo], cuts[hi]
        if hi == last:
            return
        lo = min(hi, max(bisect_left(cuts, cuts[hi] - overlap), bisect_left(cuts, cuts[hi + 1] - size)))


def _char_spans(text: str, lo: int, hi: int, seps: tuple[str, ...], size: int, overlap: int):
    """Chunk spans of ``text[lo:hi]``, cut before each occurrence of the
    first separator it contains.  Pieces of ``size`` characters and more are
    cut again by the later separators, in the end between any two characters."""
    k = next((i for i, s in enumerate(seps) if text.find(s, lo, hi) >= 0), None)
    if k is None:
        yield from _packed(range(lo, hi + 1), size, overlap)
        return
    found = (m.start() for m in re.compile(re.escape(seps[k])).finditer(text, lo, hi))
    cuts = sorted({lo, hi, *found})
    run = [lo]
    for a, b in zip(cuts, cuts[1:]):
        if b - a < size:
            run.append(b)
        else:
            yield from _packed(run, size, overlap)
            yield from _char_spans(text, a, b, seps[k + 1:], size, overlap)
            run = [b]
    yield from _packed(run, size, overlap)


def recursive_chars(df: DataFrame, id_col: str, text_col: str, size: int = 1000, overlap: int = 100) -> DataFrame:
    """C8 re-aimed per document: character chunks of at most ``size``, cut at
    blank lines, else new lines, else spaces, else anywhere, each repeating at
    most ``overlap`` characters of the one before.  A separator stays at the
    start of the piece after it; chunks are stripped, blank ones dropped, null
    and empty texts give none.  The UDF finds span ends by bisection (a
    few steps per chunk) and hands its chunks on in parts of at most
    ``PART_CHARS`` characters (or one chunk) and ``PART_ROWS`` rows, so that
    its memory is one Arrow batch, one text and one part, however many or
    long the texts."""

    def _split(batches):
        for batch in batches:
            texts = batch.column(1)
            at, numbers, chunks, held = [], [], [], 0
            for i in range(batch.num_rows):
                t = texts[i].as_py()
                spans = _char_spans(t, 0, len(t), SEPARATORS, size, overlap) if t else ()
                no = 0
                for a, b in spans:
                    if not (c := t[a:b].strip()):
                        continue
                    at.append(i)
                    numbers.append(no)
                    chunks.append(c)
                    no += 1
                    held += len(c)
                    if held >= PART_CHARS or len(at) >= PART_ROWS:
                        yield _part(batch.column(0), at, numbers, chunks)
                        at, numbers, chunks, held = [], [], [], 0
            yield _part(batch.column(0), at, numbers, chunks)

    def _part(ids, at, numbers, chunks):
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(numbers, pa.int64()), pa.array(chunks, pa.string())],
                                          names=["_id", "chunk_no", "chunk_text"])

    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    out = T.StructType([rows.schema["_id"], T.StructField("chunk_no", T.LongType()), T.StructField("chunk_text", T.StringType())])
    return rows.mapInArrow(_split, out).select(
        F.col("_id").alias(id_col), "chunk_no", F.concat(F.lit("chunk_"), (F.col("chunk_no") + 1).cast("string")).alias("chunk_id"), "chunk_text")


def merge_fragments(df: DataFrame, group_col: str, order_col: str, text_col: str,
                    length_col: str | None = None, first_cols: tuple[str, ...] = ()) -> DataFrame:
    """Per group, join fragment texts by space in fragment order, sum
    lengths, take other columns from the first fragment.

    Texts are gathered per group; a group is one logical document (pages of
    one scan), so its size is the size of that document.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(text_col).alias("t"))))
    aggs = [F.array_join(F.transform(ordered, lambda s: s["t"]), " ").alias("merged_text")]
    if length_col:
        aggs.append(F.sum(length_col).cast("bigint").alias("total_length"))
    for c in first_cols:
        aggs.append(F.min_by(c, order_col).alias(c))
    return df.groupBy(group_col).agg(*aggs)


def chunk_counts(chunks: DataFrame, id_col: str) -> DataFrame:
    """Chunks per document (the total is the sum)."""
    return chunks.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_chunks"))
