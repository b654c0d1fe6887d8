"""OCR output text: one ``[Source image: f]`` header, then one line per
recognised text as ``text (Confidence: 0.96)``, or a ``[NO TEXT DETECTED]``
/ ``[ERROR ...]`` marker.  :func:`parse_ocr_lines` turns that text back
into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
HEADER = r"^\[Source image: ([^\]]*)\]"
LINE = r"^(.*) \(Confidence: ([0-9.]+)\)$"
# ---------------------------------------------------------------------------


def format_ocr_line(text, confidence) -> F.Column:
    """``text (Confidence: 0.96)`` with two decimals."""
    return F.concat(text, F.lit(" (Confidence: "), F.format_number(confidence, 2), F.lit(")"))


def parse_ocr_lines(df: DataFrame, id_col: str, raw_col: str) -> DataFrame:
    """One row per non-blank, non-header line:
    ``(id, source_image, line_no, text, confidence, status)``."""
    lines = (df.select(id_col, F.nullif(F.regexp_extract(raw_col, HEADER, 1), F.lit("")).alias("source_image"),
                       F.posexplode_outer(F.split(F.col(raw_col), "\n")).alias("line_no", "line"))
             .where((F.col("line") != "") & ~F.col("line").startswith("[Source image:")))
    conf = F.regexp_extract("line", r" \(Confidence: ([0-9.]+)\)$", 1)
    return lines.select(
        id_col, "source_image", F.col("line_no").cast("bigint").alias("line_no"),
        F.when(F.col("line").rlike(r" \(Confidence: [0-9.]+\)$"), F.regexp_extract("line", LINE, 1)).alias("text"),
        F.when(conf != "", conf.try_cast("double")).alias("confidence"),
        F.when(F.col("line").startswith("[NO TEXT DETECTED]"), F.lit("no_text"))
        .when(F.col("line").startswith("[ERROR"), F.lit("error")).otherwise(F.lit("ok")).alias("status"))
