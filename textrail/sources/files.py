"""Corpus and log readers, writers and image helpers.

Readers are thin, declarative wrappers over ``DataFrameReader`` so Catalyst
keeps column pruning and filter push-down into the scan; positional ids
come from the parquet ``_metadata`` columns plus distributed running
numbers, never from a driver-side loop.
"""

from __future__ import annotations

import datetime as _dt

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..operators.offsets import global_offsets

# --- fixed values ----------------------------------------------------------
DELIMITER = "\n---\n"
PNG_SIGNATURE = "89504E470D0A1A0A"
JPEG_SIGNATURE = "FFD8FF"
SNAPSHOT_FORMAT = "%Y%m%d_%H%M%S"
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# feedback log layouts: the answer log, and the timed log of the adaptive manager
FEEDBACK_LOG_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("query", "answer", "source", "feedback")])
TIMED_FEEDBACK_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("timestamp", "query", "answer", "feedback")])
# ---------------------------------------------------------------------------


def read_corpus(spark: SparkSession, path: str, columns: list[str] | None = None, tolerant: bool = False,
                require: str | None = None, row_index: bool = False, fmt: str = "parquet") -> DataFrame:
    """Every file of a folder (or glob) as one table.

    * files with different columns are merged by name (missing -> null);
    * ``tolerant``: unreadable files are skipped (``ignoreCorruptFiles``)
      and, with ``require``, files in which that column is entirely absent
      (all null) are dropped;
    * ``columns``: projection pushed into the scan;
    * ``row_index``: a fresh 0-based index over all rows, ordered by
      (file path, row in file), from per-file counts and offsets.

    ``file_name`` is the base name; files are told apart by their whole path,
    so folders may hold files of one name.
    """
    r = spark.read.format(fmt).option("mergeSchema", "true")
    if tolerant:
        r = r.option("ignoreCorruptFiles", "true")
    df = r.load(path)
    meta = [F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("_path")]
    if row_index:
        meta.append(F.col("_metadata.row_index").alias("_row_in_file"))
    cols = columns or df.columns
    df = df.select(*cols, *meta)
    if tolerant and require:
        present = df.groupBy("_path").agg(F.count(require).alias("_n")).where(F.col("_n") > 0).select("_path")
        df = df.join(present, "_path", "left_semi")
    if row_index:
        per_file = df.groupBy("_path").agg(F.count(F.lit(1)).alias("_n"))
        offs = global_offsets(per_file, "_path", "_n", "_off").drop("_n")
        df = (df.join(offs, "_path")
              .withColumn("row_id", (F.col("_off") + F.col("_row_in_file")).cast("bigint"))
              .drop("_off", "_row_in_file"))
    return df.drop("_path")


def profile_files(df_with_file: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Rows per file."""
    return df_with_file.groupBy(file_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def profile_columns(df: DataFrame) -> DataFrame:
    """Column names and types as a table (schema metadata only)."""
    spark = df.sparkSession
    return spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(df.dtypes)], "position int, column string, type string")


def describe_numeric(df: DataFrame, cols: list[str], quartiles: bool = False, accuracy: int = 10000) -> DataFrame:
    """Count / mean / stddev / min / max per numeric column in one
    aggregate pass; with ``quartiles`` also the 25/50/75 % points from
    ``percentile_approx`` (a mergeable sketch: exact order statistics are
    a full sort at scale)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if quartiles:
            aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"{c}__q"))
    wide = df.agg(*aggs)

    def row(c):
        fields = [F.lit(c).alias("column"), F.col(f"{c}__count").cast("bigint").alias("count"),
                  F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min")]
        if quartiles:
            fields += [F.col(f"{c}__q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
        return F.struct(*fields, F.col(f"{c}__max").alias("max"))
    return wide.select(F.explode(F.array(*[row(c) for c in cols])).alias("s")).select("s.*")


def write_text_dir(df: DataFrame, path: str, key: str, col: str, folders: int = 64) -> None:
    """A file for each row's text (null: empty), dealt over ``folders``
    folders by its key, so that their number does not grow with the rows and
    tasks list them; tasks move their files to their place themselves."""
    deal = F.pmod(F.xxhash64(key), F.lit(folders)).alias("folder")
    (df.select(deal, F.coalesce(col, F.lit("")).alias("value"))
     .write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy("folder").text(path))


def read_text_dir(spark: SparkSession, path: str) -> DataFrame:
    """A folder of ``.txt`` files -> ``(filename, text)``; text
    stripped, empty files dropped.  Bytes that are not UTF-8 decode to
    U+FFFD, which is removed (the reference ignores undecodable bytes)."""
    from ..session import compute_once
    df = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("filename"), "value")
    df = compute_once(df, "text", strip(F.regexp_replace("value", "\ufffd", "")))   # strip once, filter after
    return df.where(F.col("text") != "").select("filename", "text")


def read_feedback_csv(spark: SparkSession, path: str, schema: T.StructType | None = FEEDBACK_LOG_SCHEMA) -> DataFrame:
    """CSV log with header and quoted multi-line fields (explicit
    schema, no inference pass); a ``timestamp`` column in the log's
    ``yyyy-MM-dd HH:mm:ss`` text form is parsed to a timestamp."""
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    df = (r.schema(schema) if schema else r).csv(path)
    if "timestamp" in df.columns and dict(df.dtypes)["timestamp"] == "string":
        df = df.withColumn("timestamp", F.to_timestamp("timestamp", LOG_TIME_FORMAT))
    return df


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, columns: list[str] | None = None) -> DataFrame:
    """JSON lines with an explicit schema and a projection."""
    df = spark.read.schema(schema).json(path)
    return df.select(*columns) if columns else df


def write_delimited(df: DataFrame, path: str, col: str, sep: str = DELIMITER, mode: str = "overwrite") -> None:
    """One record per text (stripped), each followed by ``sep``."""
    df.select(strip(F.col(col)).alias("value")).write.mode(mode).option("lineSep", sep).text(path)


def read_delimited(spark: SparkSession, path: str, sep: str = DELIMITER) -> DataFrame:
    """Split a delimited corpus back into records; blank parts dropped."""
    from ..session import compute_once
    df = compute_once(spark.read.option("lineSep", sep).text(path), "text", strip("value"))
    return df.where(F.col("text") != "").select("text")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | str | None = None,
                mode: str = "overwrite", header: bool = True) -> None:
    """Parquet / csv / json sink without an index column;
    ``partition_by`` gives one folder per value (e.g. per threshold)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # RFC 4180 quoting (quotes doubled), as Python's csv module writes
        # and as read_feedback_csv reads; multi-line values stay quoted
        w = w.option("header", header).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def append_rows(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append to a log folder (each part file carries its header)."""
    write_table(df, path, fmt=fmt, mode="append")


def export_snapshot(df: DataFrame, prefix: str, ts: _dt.datetime | None = None, fmt: str = "csv") -> str:
    """Write a time-stamped copy ``<prefix>_<yyyyMMdd_HHmmss>``; returns the path."""
    ts = ts or _dt.datetime.now(_dt.timezone.utc)
    path = f"{prefix}_{ts.strftime(SNAPSHOT_FORMAT)}"
    write_table(df, path, fmt=fmt)
    return path


# --- images -------------------------------------------------------------------

@F.pandas_udf(T.BinaryType())
def _bytes_from_dict(s: pd.Series) -> pd.Series:
    """Stringified dict ``{'bytes': b'...', 'path': ...}``."""
    import ast

    def one(v):
        try:
            d = ast.literal_eval(v) if v is not None else None
        except (ValueError, SyntaxError):
            return None
        b = d.get("bytes") if isinstance(d, dict) else None
        return bytes(b) if isinstance(b, (bytes, bytearray)) else None
    return s.map(one)


@F.pandas_udf(T.StringType())
def _jpeg_size(s: pd.Series) -> pd.Series:
    """``"W x H px"`` from a JPEG's frame header, found by the lengths of the
    segments before it; null if there is none."""
    def one(b):
        at = 2
        while b is not None and at + 9 <= len(b) and b[at] == 0xFF:
            kind = b[at + 1]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return f"{int.from_bytes(b[at + 7:at + 9], 'big')} x {int.from_bytes(b[at + 5:at + 7], 'big')} px"
            if kind == 0xFF:                             # fill byte
                at += 1
            elif kind == 0x01 or 0xD0 <= kind <= 0xD9:   # no length
                at += 2
            else:
                at += 2 + int.from_bytes(b[at + 2:at + 4], "big")
        return None
    return s.map(one)


def image_bytes(df: DataFrame, col: str) -> Column:
    """Image bytes from a binary column, a ``struct<bytes, path>``, a
    base64 string or a stringified dict; unsupported values give null."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.BinaryType):
        return F.col(col)
    if isinstance(dt, T.StructType):
        return F.col(f"{col}.bytes")
    if isinstance(dt, T.StringType):
        text = strip(F.col(col))
        is_dict = text.startswith("{")
        return F.when(is_dict, _bytes_from_dict(F.when(is_dict, text))).otherwise(
            F.try_to_binary(F.when(~is_dict, text), F.lit("base64")))
    return F.lit(None).cast("binary")


def image_header(b: Column) -> tuple[Column, Column]:
    """(format, ``"W x H px"``) from the PNG header (IHDR width and
    height, big-endian) or the JPEG frame header; else null."""
    sig = F.hex(F.substring(b, 1, 8))
    is_png = sig == F.lit(PNG_SIGNATURE)
    is_jpeg = F.substring(sig, 1, 6) == F.lit(JPEG_SIGNATURE)
    w = F.conv(F.hex(F.substring(b, 17, 4)), 16, 10)
    h = F.conv(F.hex(F.substring(b, 21, 4)), 16, 10)
    fmt = F.when(is_png, F.lit("PNG")).when(is_jpeg, F.lit("JPEG"))
    size = F.when(is_png, F.concat(w, F.lit(" x "), h, F.lit(" px"))).when(is_jpeg, _jpeg_size(F.when(is_jpeg, b)))
    return fmt, size


def image_manifest(df: DataFrame, style: str = "label_row", label: str = "label", file_col: str = "file_name",
                   row_col: str = "row_in_file") -> DataFrame:
    """Derived image file names per row:
    ``label_row`` -> ``{label}_{row}.png``; ``file_row`` ->
    ``{file:04d}_img_{row:05d}.png``; ``row_label`` -> ``image_{row}_label_{label}.jpg``.
    File numbers are the rank of the file name (a per-file table)."""
    if style == "label_row":
        name = F.concat(F.col(label).cast("string"), F.lit("_"), F.col(row_col).cast("string"), F.lit(".png"))
        return df.withColumn("image_name", name)
    if style == "row_label":
        name = F.concat(F.lit("image_"), F.col(row_col).cast("string"), F.lit("_label_"), F.col(label).cast("string"), F.lit(".jpg"))
        return df.withColumn("image_name", name)
    files = df.select(file_col).distinct().select(file_col, F.lit(1).alias("_one"))
    nums = global_offsets(files, file_col, "_one", "_file_no").drop("_one")
    name = F.concat(F.lpad(F.col("_file_no").cast("string"), 4, "0"), F.lit("_img_"),
                    F.lpad(F.col(row_col).cast("string"), 5, "0"), F.lit(".png"))
    return df.join(nums, file_col).withColumn("image_name", name).drop("_file_no")


def batch_ids(df: DataFrame, order_by: str, size: int, out: str = "batch_id") -> DataFrame:
    """Fixed-size batches (the last may be short) over a total order
    of a unique key, via distributed running numbers."""
    ones = df.select(order_by, F.lit(1).alias("_one"))
    offs = global_offsets(ones, order_by, "_one", "_pos").drop("_one")
    return df.join(offs, order_by).withColumn(out, F.floor(F.col("_pos") / size).cast("bigint")).drop("_pos")


def extract_images(df: DataFrame, image_col: str, label_col: str | None = "label", style: str = "label_row",
                   path_col: str | None = None) -> DataFrame:
    """S13-S15 as one table step: image bytes from any supported encoding
    (rows with none are dropped), format and ``W x H px`` from the header,
    a derived file name per row (row number within the source file from
    ``_metadata.row_index`` when the frame comes from a file scan, else
    ``row_in_file`` must exist), and the stored path decoded to text when it
    was kept as bytes."""
    cols = df.columns
    out = df.withColumn("_img", image_bytes(df, image_col))
    if path_col and isinstance(df.schema[path_col].dataType, T.BinaryType):
        out = out.withColumn(path_col, F.decode(F.col(path_col), "UTF-8"))
    out = out.where(F.col("_img").isNotNull())
    fmt, size = image_header(F.col("_img"))
    out = out.withColumn("format", fmt).withColumn("size", size)
    if "row_in_file" not in cols:
        out = out.withColumn("row_in_file", F.col("_metadata.row_index"))
    if "file_name" not in cols and style == "file_row":
        out = out.withColumn("file_name", F.col("_metadata.file_name"))
    out = image_manifest(out, style=style, label=label_col or "label")
    return out.withColumnRenamed("_img", "image_bytes")
