"""Removal of repeated runs of words by winnowing.

A text is a sequence of words; lines and sentences play no part, so a passage
is found wherever it stands and however it is wrapped.  A gram is GRAM words
from any word on, known by a hash.  Winnowing: of the grams in each window of
GUARANTEE words (all of a text, if it has fewer), the one with the least hash
is a fingerprint.  Two texts that share a run of GUARANTEE words or more share
a fingerprint in it.

Each fingerprint's first place in a text is matched with its first place of
all (documents by id), and its later places in the text with the ones before
them.  The matched grams are deleted, and up to REACH words more on both
sides as far as the words agree: a run that goes on farther has another
fingerprint there.  What is deleted always has equal words earlier on, so the
first copy of everything stays.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, release, settled, small_batches, stored
from .words import SPACE, parts, word_spans

GRAM, GUARANTEE = 40, 50
REACH = GUARANTEE - GRAM
#: Groups of fingerprints for each shuffle partition.
BUCKETS = 8
_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def fingerprints(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each fingerprint's text, place (word of its text) and hash, in the
    order of the texts; ``first``: n+1 offsets of the texts' words."""
    n = len(word)
    if n < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(word * _powers(_FACTOR, n), out=prefix[1:])
    h = mix64((prefix[GRAM:] - prefix[:-GRAM]) * _powers(_INVERSE, n - GRAM + 1))
    del prefix
    # grams that go over a text's end are greater than all others
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    left = first[doc + 1] - np.arange(n)      # words from here to the text's end
    whole = left[:len(h)] >= GRAM
    # the least of each window (the first, if several are), by doubling
    best, here = h.copy(), np.arange(len(h))
    best[~whole] = np.iinfo(np.uint64).max
    size, width = 1, REACH + 1
    while size < width:
        step = min(size, width - size)
        less = best[step:] < best[:-step]
        best[:-step][less], here[:-step][less] = best[step:][less], here[step:][less]
        size += step
    # windows begin where GUARANTEE words are left, and at the start of shorter texts
    window = left[:len(h)] >= GUARANTEE
    starts = first[:-1][(np.diff(first) >= GRAM) & (np.diff(first) < GUARANTEE)]
    window[starts] = True
    pick = np.unique(here[window])
    return doc[pick], pick - first[doc[pick]], h[pick]


def _words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and begins of the words, and the n+1 offsets of the texts' words."""
    word, begin = word_spans(raw, at)
    return word, begin, np.searchsorted(begin, at)


def clusters(places: np.ndarray) -> list[tuple[int, int]]:
    """Runs of words (first, last + 1) that the grams at the sorted places cover."""
    gap = np.flatnonzero(np.diff(places) > GRAM)
    return list(zip(places[np.r_[0, gap + 1]].tolist(), (places[np.r_[gap, len(places) - 1]] + GRAM).tolist(), strict=True))


def widened(a: int, b: int, mine: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[int, int]:
    """The run of ``mine`` with the words on both sides that agree with the
    ones ``before`` and ``after`` its earlier copy."""
    k = min(a, len(before))
    same = mine[a - k:a] == before[len(before) - k:]
    left = k if same.all() else int(np.argmin(same[::-1]))
    k = min(len(mine) - b, len(after))
    same = mine[b:b + k] == after[:k]
    right = k if same.all() else int(np.argmin(same))
    return a - left, b + right


def _around(words: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    return words[max(a - REACH, 0):a], words[b:b + REACH]


def _prints(src: DataFrame, buckets: int) -> DataFrame:
    """Of (row, id, text): the first place of each fingerprint of a text, many
    together (bucket, prints, rows, ids, places), and (row, own) with bucket
    null, the runs of words that repeat earlier ones of the same text."""
    kind = src.schema["id"].dataType.simpleString()
    schema = f"bucket int, prints array<bigint>, rows array<bigint>, ids array<{kind}>, places array<int>, row bigint, own array<bigint>"
    names = ["bucket", "prints", "rows", "ids", "places", "row", "own"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("id"), batch.column("row").to_numpy()
            for begin, _, raw, at in parts(batch.column("text")):
                word, _, first = _words(raw, at)
                doc, place, h = fingerprints(word, first)
                if not len(doc):
                    continue
                order = np.lexsort((place, h, doc))
                doc, place, h = doc[order], place[order], h[order]
                again = np.r_[False, (doc[1:] == doc[:-1]) & (h[1:] == h[:-1])]
                # a repeat is compared with the place before it, so a run that recurs all along has one shift
                shifts: dict[tuple[int, int], list[int]] = defaultdict(list)
                for k in np.flatnonzero(again).tolist():
                    shifts[int(doc[k]), int(place[k] - place[k - 1])].append(int(place[k]))
                own: dict[int, list[int]] = defaultdict(list)
                for (d, shift), places in shifts.items():
                    mine = word[first[d]:first[d + 1]]
                    for a, b in clusters(np.array(sorted(places))):
                        own[d] += widened(a, b, mine, *_around(mine, a - shift, b - shift))
                doc, place, h = doc[~again], place[~again], h[~again]
                bucket = (h % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                doc, place, h, bucket = doc[order] + begin, place[order], h[order], bucket[order]
                edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                cuts = pa.array(np.r_[edge, len(bucket)].astype(np.int32))
                n, m = len(edge), len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[edge]), *(pa.ListArray.from_arrays(cuts, x) for x in (pa.array(h.view(np.int64)), pa.array(rows[doc]), ids.take(pa.array(doc)), pa.array(place.astype(np.int32)))),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], names=names)
                if m:
                    mine = [pa.nulls(m, pa.int32()), *(pa.nulls(m, pa.list_(x)) for x in (pa.int64(), pa.int64(), ids.type, pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*mine, pa.array(rows[np.array(list(own)) + begin]), pa.array(list(own.values()), pa.list_(pa.int64()))], names=names)

    return small_batches(src).mapInArrow(run, schema)


def _matched(table: pa.Table) -> pa.Table:
    """(row, from, shift, place) of each fingerprint that has an earlier place
    in another row: least id (nulls last), then row."""
    prints, rows, ids, places = (pc.list_flatten(table.column(c)).combine_chunks() for c in ("prints", "rows", "ids", "places"))
    h = prints.to_numpy()
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    order = order[np.r_[False, same] | np.r_[same, False]] if len(same) else order[:0]
    h, row, place = h[order], rows.to_numpy()[order], places.to_numpy()[order].astype(np.int64)
    rank = pc.rank(ids.take(pa.array(order)), "ascending", null_placement="at_end", tiebreaker="dense").to_numpy() if len(order) else order
    order = np.lexsort((row, rank, h))
    h, row, place = h[order], row[order], place[order]
    starts = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
    lead = np.flatnonzero(starts)[np.cumsum(starts) - 1]
    rest = ~starts
    return pa.table({"row": row[rest], "from": row[lead][rest], "shift": (place - place[lead])[rest], "place": place[rest]},
                    schema=pa.schema([("row", pa.int64()), ("from", pa.int64()), ("shift", pa.int64()), ("place", pa.int64())]))


def _asked(pairs: DataFrame) -> DataFrame:
    """(row, runs, around) of (row, from, shift, places, text): the runs of
    words of a row that the matched grams cover, and the hashes of the words
    before and after each one's copy in the earlier text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            source = batch.column("from").to_numpy()
            # rows of the same earlier text mostly stand together: it is read once
            lead = np.flatnonzero(np.r_[True, source[1:] != source[:-1]])
            owner = np.cumsum(np.r_[True, source[1:] != source[:-1]]) - 1
            words: list[np.ndarray] = []
            for _, _, raw, at in parts(batch.column("text").take(pa.array(lead))):
                word, _, first = _words(raw, at)
                words += [word[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
            runs, around = [], []
            for k, shift, places in zip(owner.tolist(), batch.column("shift").to_pylist(), batch.column("places").to_pylist(), strict=True):
                spans = clusters(np.array(sorted(places)))
                runs.append([x for span in spans for x in span])
                around.append([x.tobytes() for a, b in spans for x in _around(words[k], a - shift, b - shift)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(runs, pa.list_(pa.int64())), pa.array(around, pa.list_(pa.binary()))], names=["row", "runs", "around"])

    return small_batches(pairs).mapInArrow(run, "row bigint, runs array<bigint>, around array<binary>")


def _without(raw: np.ndarray, begin: np.ndarray, runs: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """A text without the runs of its words, and how many of its lines (also
    cut at sentence ends) that have words lost all of them, and words removed."""
    text = raw.tobytes()
    gone = np.zeros(len(begin) + 1, np.int64)
    for a, b in runs:
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    inside = ~SPACE[raw]
    end = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    left, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        # of the white space around, what keeps the words apart as lines
        head, tail = int(end[a - 1]) if a else 0, int(begin[b]) if b < len(begin) else len(text)
        front = text[head:int(begin[a])]
        if a == 0 or b == len(begin) or b"\n" in front:
            left.append(text[at:int(begin[a])])
            at = tail
        else:
            left.append(text[at:head])
            at = int(end[b - 1])
    left.append(text[at:])
    stops = line_ends(raw)
    last = np.searchsorted(begin, stops)
    total = np.r_[0, np.cumsum(gone)]
    lost, size = np.diff(np.r_[0, total[last]]), np.diff(np.r_[0, last])
    return b"".join(left).strip(b" \n"), int(((size > 0) & (lost == size)).sum()), int(gone.sum())


def line_ends(raw: np.ndarray) -> np.ndarray:
    """Ends of the lines (of sentences, if a line has several) of a text."""
    stop = (raw == 46) | (raw == 33) | (raw == 63)
    follows = np.r_[raw[1:] == 32, False]
    return np.union1d(np.flatnonzero((raw == 10) | stop & follows) + 1, [len(raw)])


def _deleted(rows: DataFrame, columns: list) -> DataFrame:
    """(columns, clean_text, removed_lines, removed_words) with the runs deleted."""
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    names = [f.name for f in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, lines, words = batch.column("_text").to_pylist(), [0] * batch.num_rows, [0] * batch.num_rows
            hit = np.flatnonzero(batch.column("_runs").is_valid().to_numpy(zero_copy_only=False))
            found = batch.column("_runs").take(pa.array(hit)).to_pylist()
            for begin_row, _, raw, at in parts(batch.column("_text").take(pa.array(hit))):
                word, begin, first = _words(raw, at)
                for k in range(len(at) - 1):
                    mine = word[first[k]:first[k + 1]]
                    runs = []
                    for one in found[begin_row + k]:
                        spans = list(zip(one["runs"][::2], one["runs"][1::2], strict=True))
                        if one["around"] is not None:
                            near = [np.frombuffer(x, np.uint64) for x in one["around"]]
                            spans = [widened(a, b, mine, x, y) for (a, b), x, y in zip(spans, near[::2], near[1::2], strict=True)]
                        runs += spans
                    row = int(hit[begin_row + k])
                    left, lines[row], words[row] = _without(raw[at[k]:at[k + 1]], begin[first[k]:first[k + 1]] - at[k], runs)
                    text[row] = left.decode()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(text, pa.string()), pa.array(lines, pa.int64()), pa.array(words, pa.int64())],
                                             names=[*names, "clean_text", "removed_lines", "removed_words"])

    return small_batches(rows).mapInArrow(run, f"{head}, clean_text string, removed_lines bigint, removed_words bigint")


def drop_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, clean_text, removed_lines, removed_words`` for every row.

    A run of words that repeats an earlier one (GUARANTEE words are always
    found, GRAM words needed) is deleted, also within one text.  Earlier means
    a smaller id (null ids last), then an earlier row, then an earlier place.
    If parts of a run stand first in different texts, up to REACH words at
    each of its ends can stay.  Rows repeated whole keep the text of the
    first.  Words are compared without regard to A-Z's case and to white
    space; ``removed_lines`` counts the lines (sentences, if a line has
    several) that lost all their words.  A null text stays null, an empty one
    empty; an empty table gives an empty result.  No other column is read.
    """
    spark = df.sparkSession
    df = settled(df)
    src = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    printed = _prints(src, BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # own runs go with the matches, so that the texts are read once for both
    schema = "row bigint, from bigint, shift bigint, place bigint, own array<bigint>"

    def match(table: pa.Table) -> pa.Table:
        if table.column("bucket").null_count:
            n = len(table)
            return pa.table([table.column("row"), *(pa.nulls(n, pa.int64()) for _ in range(3)), table.column("own")], names=["row", "from", "shift", "place", "own"])
        got = _matched(table)
        return got.append_column("own", pa.nulls(len(got), pa.list_(pa.int64())))

    # rows with own runs are dealt by row among keys below zero
    key = F.coalesce("bucket", -1 - F.pmod(F.xxhash64("row"), F.lit(4096))).cast("int")
    found = stored(printed.groupBy(key.alias("key")).applyInArrow(match, schema))
    pairs = found.where("from is not null").groupBy("row", "from", "shift").agg(F.collect_list("place").alias("places"))
    earlier = src.where("text is not null").select(F.col("row").alias("from"), "text")
    asked = _asked(pairs.join(earlier, "from").select("row", "from", "shift", "places", "text"))
    own = found.where("own is not null").select("row", F.col("own").alias("runs"), F.lit(None).cast("array<binary>").alias("around"))
    runs = stored(asked.unionByName(own).groupBy("row").agg(F.collect_list(F.struct("runs", "around")).alias("_runs")))
    release(found)
    rows = src.join(runs, "row", "left").select(F.col("id").alias("doc_id"), F.col("text").alias("_text"), "_runs")
    return _deleted(rows, [f for f in rows.schema.fields if f.name == "doc_id"])
