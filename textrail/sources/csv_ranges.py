"""Multi-line CSV read in byte ranges.

The CSV reader's multi-line mode reads a file in one task.  Here a file is read
as lines, in as many tasks as it has splits.  A line begins a record if the
number of quotes before it in its file is even; that number is summed in two
steps, over the few splits of a file and over the lines of a split.  The lines
of a record, which may lie in several splits, then meet by the record's first
split and its number there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import FEEDBACK_LOG_SCHEMA, LOG_TIME_FORMAT

QUOTE, MARK = '"', "\ufeff"


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, record_no, record``: the records of the CSV files under
    ``path`` as text; ``block`` is the byte where the record's split begins,
    ``record_no`` its number there, from 1.

    Quotes inside a value are doubled (RFC 4180); a quote that is never closed
    makes the rest of its file one record.  Line ends inside a value stay as
    they are.  Blank records are dropped; empty files have none."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit(QUOTE), F.lit("")))
    inside = W.partitionBy("file", "block").orderBy("seq")
    earlier = F.coalesce(F.sum(quotes).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # odd: whether the line lies in quotes if the split begins outside of them
    read = lines.withColumn("odd", earlier % 2 == 1).withColumn("quotes", quotes)
    splits = read.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("turns"), F.count_if(~F.col("odd")).alias("n_out"), F.count_if("odd").alias("n_in"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # a row for each split of a file
    splits = splits.withColumn("opens", F.coalesce(F.sum("turns").over(before) % 2 == 1, F.lit(False)))
    splits = splits.withColumn("n", F.when(F.col("opens"), F.col("n_in")).otherwise(F.col("n_out")))
    last = F.last(F.when(F.col("n") > 0, F.struct(F.col("block").alias("block"), F.col("n").alias("n"))), ignorenulls=True).over(before)
    splits = splits.select("file", "block", "opens", last.alias("open_record"))
    begins = (F.col("odd") == F.col("opens")).cast("int")
    placed = read.join(splits, ["file", "block"]).withColumn("no", F.sum(begins).over(inside.rowsBetween(W.unboundedPreceding, 0)))
    own = F.col("no") > 0
    keyed = placed.select("file", F.when(own, F.col("block")).otherwise(F.col("open_record.block")).alias("first"),
                          F.when(own, F.col("no")).otherwise(F.col("open_record.n")).alias("record_no"), F.struct("block", "seq", "line").alias("part"))
    whole = keyed.groupBy("file", "first", "record_no").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    text = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["line"]), "\n"), r"\r\z", "")
    text = F.when((F.col("first") == 0) & (F.col("record_no") == 1), F.regexp_replace(text, rf"\A{MARK}", "")).otherwise(text)
    return (whole.select("file", F.col("first").alias("block"), F.col("record_no").cast("bigint").alias("record_no"), text.alias("record"))
            .where(F.trim("record") != ""))


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType = FEEDBACK_LOG_SCHEMA, header: bool = True, sep: str = ",") -> DataFrame:
    """CSV files with quoted multi-line values under an explicit schema, one
    file in several tasks; the first record of each file is its header.

    Empty values are null; missing values at a record's end are null, further
    ones are left out; a ``timestamp`` column in the log's text form is parsed."""
    records = csv_records(spark, path)
    if header:
        records = records.where("not (block = 0 and record_no = 1)")
    values = F.from_csv("record", schema.toDDL(), {"sep": sep, "quote": QUOTE, "escape": QUOTE})
    df = records.select(values.alias("v")).select("v.*")
    if "timestamp" in df.columns and dict(df.dtypes)["timestamp"] == "string":
        df = df.withColumn("timestamp", F.to_timestamp("timestamp", LOG_TIME_FORMAT))
    return df
