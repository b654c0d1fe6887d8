"""Exact dedup by deterministic block naming.

A text (white space deleted) is cut into fixed-size blocks.  The different
blocks of all texts are sorted and numbered from 1: a block's name is its
number, so equal blocks get equal names and different blocks different ones.
Then adjacent names are paired, the different pairs sorted and numbered in the
same way, level by level, until one name is left for a document.  Two documents
are equal exactly if they have the same number of blocks and the same last name.

Blocks are sorted by a 64-bit hash (their bucket) and then by content, so only
the first step shuffles contents: equal ones are combined before it, the others
compared in full.  A bucket's first number is the count of different contents in
all smaller buckets (range-partitioned running numbers).  Where a bucket holds
one content, its occurrences get their names by the bucket alone; where it holds
several, these are numbered in their order and joined by content.

Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textrail.operators.offsets import global_offsets

from .common import cut, settled

#: Code points in a block.
BLOCK = 2048


def squeeze(text: Column) -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _blocks(text: Column, size: int) -> Column:
    parts = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))
    return F.when(F.length(text) <= size, F.array(text)).otherwise(parts)


def _bucket(content: Column, bits: int) -> Column:
    h = F.xxhash64(content)
    return h if bits >= 64 else F.shiftrightunsigned(h, 64 - bits)


def _numbers(cutup: DataFrame, bits: int) -> DataFrame:
    """(_bucket, _many, offset): the different contents of each bucket, and those of all smaller ones."""
    parts = cutup.select(F.explode_outer("_blocks").alias("_content"))
    different = parts.select(_bucket(F.col("_content"), bits).alias("_bucket"), "_content").distinct()
    return global_offsets(different.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_many")), "_bucket", "_many")


def _block_names(rows: DataFrame, numbers: DataFrame, shared: bool) -> DataFrame:
    """(_row, _n, _pos, _name): every block's name."""
    held = F.arrays_zip("_buckets", "_blocks") if shared else F.arrays_zip("_buckets")
    parts = (rows.select("_row", "_n", F.posexplode(held).alias("_pos", "_part"))
             .select("_row", "_n", "_pos", F.col("_part._buckets").alias("_bucket"), *([F.col("_part._blocks").alias("_content")] if shared else []))
             .join(numbers, "_bucket"))
    names = parts.where("_many = 1").select("_row", "_n", "_pos", (F.col("offset") + 1).alias("_name"))
    if shared:
        several = parts.where("_many > 1")
        order = W.partitionBy("_bucket").orderBy("_content")
        placed = several.select("_bucket", "_content").distinct().withColumn("_no", F.row_number().over(order))
        names = names.unionByName(several.join(placed, ["_bucket", "_content"])
                                  .select("_row", "_n", "_pos", (F.col("offset") + F.col("_no")).alias("_name")))
    return names


def _last_names(at: DataFrame) -> DataFrame:
    """(_row, _name): each row's last name, from the names of its blocks."""
    at = cut(at)
    done, part = [at.where("_n = 1")], 1
    at = at.where("_n > 1")
    while not at.isEmpty():
        # an odd last name is carried up as a pair whose second part is 0
        pairs = cut(at.groupBy("_row", "_n", F.floor(F.col("_pos") / 2).alias("_pos"))
                    .agg(F.struct(F.max(F.when(F.col("_pos") % 2 == 0, F.col("_name"))).alias("a"),
                                  F.coalesce(F.max(F.when(F.col("_pos") % 2 == 1, F.col("_name"))), F.lit(0)).alias("b")).alias("_pair")))
        numbers = global_offsets(pairs.select("_pair").distinct().withColumn("_many", F.lit(1)), "_pair", "_many")
        named = cut(pairs.join(numbers, "_pair").select("_row", "_n", "_pos", (F.col("offset") + 1).alias("_name")))
        part *= 2
        done.append(named.where(F.col("_n") <= part))
        at = named.where(F.col("_n") > part)
    return reduce(DataFrame.unionByName, done).select("_row", "_name")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK, bits: int = 64) -> DataFrame:
    """One row per row of ``df``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are identical without white space.  The row with
    the most code points in its original text stays, then the smallest id
    (a null id comes last), then the first row of equal ids.  A null text
    counts as empty, so null, empty and blank texts form one group.  Rows that
    are repeated whole are copies of one another: one of them stays.  An empty
    table gives an empty result.  Other columns of ``df`` are not read, so
    their names cannot clash.  ``bits`` (the buckets' width) changes the
    work, never the result.
    """
    return _grouped(df, id_col, text_col, block, bits).drop("_row")


def _grouped(df: DataFrame, id_col: str, text_col: str, block: int = BLOCK, bits: int = 64) -> DataFrame:
    text = squeeze(F.col(f"`{text_col}`"))
    src = df.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.char_length(F.col(f"`{text_col}`")), F.lit(0)).alias("_len"),
                    text.alias("_t"))
    cutup = src.withColumn("_blocks", _blocks(F.col("_t"), block))
    numbers = _numbers(cutup, bits)
    shared = not numbers.where("_many > 1").isEmpty()
    rows = cut(cutup.select(F.monotonically_increasing_id().alias("_row"), "_id", "_len", F.sha2("_t", 256).alias("_sha"), F.size("_blocks").cast("long").alias("_n"),
                            F.transform("_blocks", lambda b: _bucket(b, bits)).alias("_buckets"), *(["_blocks"] if shared else [])))
    names = _last_names(_block_names(rows, numbers, shared))
    rows = cut(rows.select("_row", "_id", "_len", "_sha", "_n").join(names, "_row"))
    first = F.struct((-F.col("_len")).alias("l"), F.isnull("_id").alias("x"), F.col("_id").alias("id"), F.col("_row").alias("r"))
    groups = rows.groupBy("_n", "_name").agg(F.min(first).alias("_first"), F.count(F.lit(1)).alias("_size"))
    return rows.join(groups, ["_n", "_name"]).select(
        "_row", F.col("_id").alias("doc_id"), F.col("_first.id").alias("keep_id"), F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_first.r")).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the row of each group that stays (see exact_groups), all
    columns but an own ``_row`` kept."""
    docs = settled(docs).withColumn("_row", F.monotonically_increasing_id())
    gone = _grouped(docs.select(f"`{id_col}`", f"`{text_col}`"), id_col, text_col).where("not kept").select("_row")
    return docs.join(gone, "_row", "left_anti").drop("_row")
