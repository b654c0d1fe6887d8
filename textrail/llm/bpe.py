"""Byte-pair encoding with word ends, and its decoding.

A word's symbols form a doubly linked list; a priority queue holds the rank of
every adjacent pair that can merge.  The least rank merges first (leftmost on
a tie); entries whose symbols have changed since are stale and skipped.
The ids of a text are decoded by joining its vocabulary strings.

A text is a sequence of words between white space, and a word's ids do not
depend on its neighbours, so a worker encodes a word once and remembers it in
a table of bounded size.  Everything about a document is computed in its row.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts_of

#: Words in each of the two generations that a worker remembers.
REMEMBER = 400_000


class WordBpe:
    """A vocabulary file of the ``tokenizers`` library of the kind BPE, with
    NFC, lower case and byte-level words that end in a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # (left id, right id) -> (rank, id of the merged symbol)
        self.ranks = {(self.vocab[a], self.vocab[b]): (r, self.vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.byte_char = byte_chars()
        # strings only: containers in a large table would slow Python's garbage collector
        self.known: tuple[dict[str, str], dict[str, str]] = {}, {}
        self.older: tuple[dict[str, str], dict[str, str]] = {}, {}
        self.merged: dict[str, str] = {}
        self.path, self.library = path, None

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge a word's symbols by rank."""
        n = len(symbols)
        ranks = self.ranks.get
        queue = [(hit[0], i, pair[0], pair[1], hit[1]) for i, pair in enumerate(pairwise(symbols)) if (hit := ranks(pair))]
        if not queue:
            return symbols
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        symbols = list(symbols)
        while queue:
            _, i, a, b, merged = pop(queue)
            j = right[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # stale
            symbols[i], symbols[j] = merged, -1
            right[i] = after = right[j]
            if after >= 0:
                left[after] = i
                if hit := ranks((merged, symbols[after])):
                    push(queue, (hit[0], i, merged, symbols[after], hit[1]))
            before = left[i]
            if before >= 0 and (hit := ranks((symbols[before], merged))):
                push(queue, (hit[0], before, symbols[before], merged, hit[1]))
        return [s for s in symbols if s >= 0]

    def encode_plain(self, text: str) -> list[int]:
        """Ids of a text that holds no special token."""
        if not text.isascii():
            if any(unicodedata.category(c) == "Cn" for c in text):
                return self._encode_unassigned(text)
            # the library lowers code point by code point: no final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        ids: list[int] = []
        text = text.lower()
        # the pattern's letters run as far as they can
        for word in [text] if text.isascii() and text.isalpha() else self.words.findall(text):
            got = self.merged.get(word)
            if got is None:
                if len(self.merged) >= REMEMBER:
                    self.merged.clear()
                got = self.merged[word] = "".join(map(chr, self.merge_word(list(map(self.byte_char.__getitem__, word.encode())))))
            ids += map(ord, got)
        return ids

    def merge_word(self, chars: list[str]) -> list[int]:
        chars[-1] += self.end
        return self.merge(list(map(self.vocab.__getitem__, chars)))

    def _encode_unassigned(self, text: str) -> list[int]:
        """For code points that Python's Unicode tables don't know yet, the
        library's own tables say what is a letter and what lower case."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [i for word, _ in words for i in self.merge_word(list(word))]

    def encode(self, text: str) -> list[int]:
        """Ids of any text; the strings of special tokens become their ids."""
        if self.specials is None or not self.specials.search(text):
            return self.encode_plain(text)
        ids: list[int] = []
        for part in self.specials.split(text):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += self.encode_plain(part)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings; the file names no decoder, so a space joins them."""
        return " ".join([self.strings[i] for i in ids])

    def both(self, text: str) -> tuple[str, str]:
        """The ids in decimal and the decoded text, both joined by spaces."""
        if ODD_SPACE.search(text) or self.specials and self.specials.search(text):
            ids = self.encode(text)
            return " ".join(map(str, ids)), self.decode(ids)
        words = text.split()
        ids, strings = (list(map(half.get, words)) for half in self.known)
        if None in strings:
            for k, got in enumerate(strings):
                if got is None:
                    ids[k], strings[k] = self._look_up(words[k])
        return " ".join(filter(None, ids)), " ".join(filter(None, strings))

    def _look_up(self, word: str) -> tuple[str, str]:
        (ids, strings), (old_ids, old_strings) = self.known, self.older
        if word in strings:
            return ids[word], strings[word]
        if word in old_strings:
            got = old_ids[word], old_strings[word]
        else:
            found = self.encode_plain(word)
            got = " ".join(map(str, found)), self.decode(found)
        if len(strings) >= REMEMBER:  # words in use come back from the older half
            self.older, self.known = self.known, ({}, {})
            ids, strings = self.known
        ids[word], strings[word] = got
        return got


#: Python's split() takes these for white space, the vocabulary's pattern does not.
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")


def byte_chars() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The vocabulary, read once in each worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids string, decoded string`` of every whole text.

    ``ids`` holds the decimal ids joined by one space.  A null or empty text,
    or one of white space alone, has empty ``ids`` and ``decoded``.  Each row
    is encoded on its own: repeated rows and null ids are kept as they are,
    an empty table gives an empty result, and no other column is read.
    """
    return _mapped(df, path, id_col, text_col, "doc_id {id}, ids string, decoded string", lambda ids, decoded: (ids, decoded))


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of what
    encode_documents gives, taken where it is made."""
    def digest(ids: str, decoded: str):
        return ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return _mapped(df, path, id_col, text_col, "doc_id {id}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", digest)


def _mapped(df: DataFrame, path: str, id_col: str, text_col: str, schema: str, row) -> DataFrame:
    src = small_batches(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))
    schema = schema.format(id=src.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            out = [row(*bpe.both(t)) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c)) for c in zip(*out, strict=True))], names=names)

    names = [c.split()[0] for c in schema.split(", ")]
    return src.mapInArrow(run, schema)
