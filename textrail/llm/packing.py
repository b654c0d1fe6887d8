"""Packing of token sequences by minimum bin slack.

Every document becomes token ids plus an end id.  Whole windows are cut off
first; what remains of a document (shorter than a window) waits in a buffer of
bounded size.  A buffer is packed window by window: the longest remainder goes
first, and a subset-sum program over the multiset of remaining lengths, held
as the bits of one integer, finds the lengths whose sum comes closest to the
rest of the window; the counts of each length are traced back.  Where even the
best sum leaves a gap, one remainder is cut to fill it.  What is left at the
end of a partition is cut at powers of two, which need no padding.

Nothing is shuffled: a partition is a stream, and its memory is one buffer.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_chars
from .common import small_batches, texts_of

WINDOW = 2048
#: Remainders that are packed together.
BUFFER = 4096
END_ID = 1
#: A partition's sequences are numbered from its number times this.
PER_PARTITION = 1 << 33
# fixed value: the pattern that byte-level vocabularies split text by
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, tiktoken.Encoding] = {}
_LIBRARY: dict[str, Tokenizer] = {}


def load(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file.  Its vocabulary strings
    become byte strings and its ids their ranks, which gives the library's ids
    several times as fast; the strings of special tokens become their ids."""
    if path not in _LOADED:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = {c: b for b, c in byte_chars().items()}
        ranks = {bytes(byte[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        _LOADED[path] = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _LOADED[path]


def ids_of(path: str, text: str) -> list[int]:
    """The library's ids of a text.  The fast encoder gives up on runs of some
    hundred thousand spaces or line ends; such texts go to the library itself."""
    try:
        return load(path).encode(text, allowed_special="all")
    except ValueError:
        if path not in _LIBRARY:
            _LIBRARY[path] = Tokenizer.from_file(path)
            _LIBRARY[path].no_padding()
            _LIBRARY[path].no_truncation()
        return _LIBRARY[path].encode(text, add_special_tokens=False).ids


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum is at most
    ``capacity`` and as close to it as any choice comes."""
    full, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    goal = 1 << capacity
    for length in sorted((x for x, c in counts.items() if c and x <= capacity), reverse=True):
        copies, part = min(counts[length], capacity // length), 1
        while copies and not reach & goal:
            part = min(part, copies)
            copies -= part
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & full
            part *= 2
        if reach & goal:
            break
    rest, taken = reach.bit_length() - 1, defaultdict(int)
    for length, part, before in reversed(steps):
        if not before >> rest & 1:
            taken[length] += part
            rest -= length * part
    return dict(taken)


def fill_windows(lengths: list[int], window: int, last: bool) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int]]]:
    """Sequences of (item, start, length), and what is left of items as
    (item, start) if ``last`` is false and no window is full any more."""
    waiting: dict[int, list[tuple[int, int]]] = defaultdict(list)
    counts: dict[int, int] = defaultdict(int)

    def put(item: int, start: int, length: int) -> None:
        waiting[length].append((item, start))
        counts[length] += 1

    def take(length: int) -> tuple[int, int]:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return waiting[length].pop()

    for i in range(len(lengths) - 1, -1, -1):
        put(i, 0, lengths[i])
    total, out = sum(lengths), []
    while total >= window:
        longest = max(counts)
        seq = [(*take(longest), longest)]
        gap = window - longest
        for length, n in best_fill(counts, gap).items():
            for _ in range(n):
                seq.append((*take(length), length))
                gap -= length
        if gap:  # cut the shortest remainder that can fill the gap
            length = min(x for x in counts if x > gap)
            item, start = take(length)
            seq.append((item, start, gap))
            put(item, start + gap, length - gap)
        out.append(seq)
        total -= window
    left = [(item, start, n) for n in sorted(counts, reverse=True) for item, start in reversed(waiting[n])]
    if not last:
        return out, [(item, start) for item, start, _ in left]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        seq = []
        while size:
            item, start, n = left.pop(0)
            seq.append((item, start, min(n, size)))
            if n > size:
                left.insert(0, (item, start + size, n - size))
            size -= min(n, size)
        out.append(seq)
    return out, []


def pack_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = END_ID, buffer: int = BUFFER) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers,
    ``start`` its document's ids before it, ``offset`` its place in the
    sequence.  A null or empty text is its end id alone.  Each row is a
    document of its own, also if its id is null or repeated.  An empty table
    gives no pieces.  Only the two named columns are read.
    """
    src = small_batches(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() * PER_PARTITION, 0
        held: list[tuple] = []  # (id, all its tokens, ids before, bytes of the rest)
        id_type = None
        end = np.array([end_id], dtype="<u4").tobytes()

        def rows(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(cols, kinds, strict=True)], names=names)

        def packed(last: bool) -> list[tuple]:
            nonlocal made, held
            out, left = [], []
            seqs, rest = fill_windows([len(h[3]) // 4 for h in held], window, last)
            for seq in seqs:
                offset = 0
                for item, start, n in seq:
                    doc, tokens, before, raw = held[item]
                    out.append((doc, before + start, n, raw[4 * start:4 * (start + n)], tokens, base + made, offset))
                    offset += n
                made += 1
            for item, start in rest:
                doc, tokens, before, raw = held[item]
                left.append((doc, tokens, before + start, raw[4 * start:]))
            held = left
            return out

        for batch in batches:
            id_type = batch.column("doc_id").type
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                raw = np.asarray(ids_of(path, text), dtype="<u4").tobytes() + end
                tokens, at = len(raw) // 4, 0
                while tokens - at >= window:
                    out.append((doc, at, window, raw[4 * at:4 * (at + window)], tokens, base + made, 0))
                    at, made = at + window, made + 1
                if at < tokens:
                    held.append((doc, tokens, at, raw[4 * at:]))
                if len(held) >= buffer:
                    out += packed(last=False)
            if out:
                yield rows(out)
        if held:
            yield rows(packed(last=True))

    return src.mapInArrow(run, schema)
