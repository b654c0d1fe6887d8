"""Registered plans: corpus reads, profiles, HTML paragraphs, batches
(S1-S4, S16, S19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import feedback as FB
from ..sources import files as SF
from ..sources.csv_ranges import read_csv_ranges
from ..sources import html as H
from . import sqlfrag as S
from .common import r6, register, t


@register("read_corpus_indexed", sql="""
SELECT doc_id, lang, 'documents.parquet' AS file_name, CAST(row_number() OVER () - 1 AS BIGINT) AS row_id FROM documents
""")
def read_corpus_indexed(spark, sf_dir):
    """S1 + S3: folder read with a projection and a fresh row index."""
    return SF.read_corpus(spark, f"{sf_dir.rstrip('/')}/documents.parquet", columns=["doc_id", "lang"], row_index=True)


@register("profile_documents", sql="""
SELECT 'n_chars' AS column, CAST(count(n_chars) AS BIGINT) AS count, round(avg(n_chars), 6) AS mean,
       round(stddev_samp(n_chars), 6) AS std, CAST(min(n_chars) AS DOUBLE) AS min, CAST(max(n_chars) AS DOUBLE) AS max FROM documents
UNION ALL
SELECT 'doc_id', CAST(count(doc_id) AS BIGINT), round(avg(doc_id), 6), round(stddev_samp(doc_id), 6),
       CAST(min(doc_id) AS DOUBLE), CAST(max(doc_id) AS DOUBLE) FROM documents
""")
def profile_documents(spark, sf_dir):
    """Numeric profile (count, mean, std, min, max) of a table."""
    d = t(spark, sf_dir, "documents", ["doc_id", "n_chars"], spread_rows=False)
    p = SF.describe_numeric(d, ["n_chars", "doc_id"])
    return p.select("column", "count", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"), "min", "max")


@register("rows_per_file", sql="SELECT 'events.parquet' AS file_name, CAST(count(*) AS BIGINT) AS n_rows FROM events")
def rows_per_file(spark, sf_dir):
    """Rows per source file."""
    df = SF.read_corpus(spark, f"{sf_dir.rstrip('/')}/events.parquet", columns=["event_id"])
    return SF.profile_files(df)


def _sql_paragraphs() -> str:
    ends = "|".join(H.CONTAINER_ENDS)
    body = f"regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g')"
    m1 = f"regexp_replace({body}, '(?i)<p\\b[^>]*>', chr(1), 'g')"
    m2 = f"regexp_replace({m1}, '(?i)</p>|</({ends})>', chr(2), 'g')"
    txt = "regexp_replace(split_part(x, chr(2), 1), '<[^>]*>', '', 'g')"
    for ent, ch in H.ENTITIES:
        txt = f"replace({txt}, {S.q(ent)}, {S.q(ch)})"
    return f"array_to_string(list_transform(string_split({m2}, chr(1))[2:21], lambda x: {txt}), ' ')"


@register("html_paragraphs", sql=f"SELECT page_id, url, {_sql_paragraphs()} AS text FROM pages")
def html_paragraphs(spark, sf_dir):
    """First 20 paragraph texts of every page."""
    p = t(spark, sf_dir, "pages")
    return H.html_paragraphs(p, "html", 20)


@register("upload_batches", sql="""
SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 100) AS BIGINT) AS batch_id FROM documents
""")
def upload_batches(spark, sf_dir):
    """100-row upload batches in key order (last batch short)."""
    d = t(spark, sf_dir, "documents", ["doc_id"], spread_rows=False)
    return SF.batch_ids(d, "doc_id", 100)


def _scratch(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    import uuid
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/textrail-io/{name}-{uuid.uuid4().hex}"


@register("delimited_roundtrip", sql=f"""
SELECT {S.strip('text')} AS text FROM documents WHERE {S.strip('text')} <> ''
""")
def delimited_roundtrip(spark, sf_dir):
    """Every document written as a ``---``-delimited text corpus (in the
    shared checkpoint folder) and split back into records."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    path = _scratch(spark, "delimited")
    SF.write_delimited(d, path, "text")
    return SF.read_delimited(spark, path)


@register("csv_append_roundtrip", sql="""
SELECT CAST(doc_id AS VARCHAR) AS query, text AS answer, source, lang AS feedback FROM documents
""")
def csv_append_roundtrip(spark, sf_dir):
    """S6 + S9 + S11: documents logged as a CSV feedback log in two appends
    (multi-line quoted texts) and read back with the log schema."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text", "source", "lang"])
    rows = d.select(F.col("doc_id").cast("string").alias("query"), F.col("text").alias("answer"), "source",
                    F.col("lang").alias("feedback"))
    path = _scratch(spark, "feedback-log")
    SF.append_rows(rows.where(F.col("feedback").isin("en", "de")), path)
    SF.append_rows(rows.where(~F.col("feedback").isin("en", "de")), path)
    return SF.read_feedback_csv(spark, path)


@register("csv_ranges_roundtrip", sql="""
SELECT CAST(doc_id AS VARCHAR) AS query, text AS answer, source, lang AS feedback FROM documents
""")
def csv_ranges_roundtrip(spark, sf_dir):
    """Documents logged as CSV with multi-line quoted texts and read back
    in byte ranges, one file in as many tasks as it has splits."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text", "source", "lang"])
    path = _scratch(spark, "feedback-ranges")
    SF.append_rows(d.select(F.col("doc_id").cast("string").alias("query"), F.col("text").alias("answer"), "source",
                            F.col("lang").alias("feedback")), path)
    return read_csv_ranges(spark, path)


@register("jsonl_roundtrip", sql="SELECT doc_id, text FROM documents")
def jsonl_roundtrip(spark, sf_dir):
    """Documents written as JSON lines and read back with an explicit
    schema and a projection."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    path = _scratch(spark, "jsonl")
    SF.write_table(d, path, fmt="json")
    return SF.read_jsonl(spark, path, "doc_id long, text string, lang string, source string", ["doc_id", "text"])


def _sweep_sql() -> str:
    from .chunk_plans import _HEAD_SRC_SQL, _sql_sections
    from ..operators import chunking as C
    inner = _sql_sections(f"SELECT doc_id, {_HEAD_SRC_SQL} AS text FROM documents",
                          [(t_, int(t_ * 0.15)) for t_ in C.SWEEP_THRESHOLDS], None)
    return f"SELECT CAST(threshold AS INTEGER) AS threshold, doc_id, section_no, section, chunk_no, chunk_id, chunk_text, n_tokens FROM ({inner})"


@register("sweep_partitioned_read", sql=_sweep_sql())
def sweep_partitioned_read(spark, sf_dir):
    """The threshold sweep written with one folder per threshold and
    every folder read back (a filter on the threshold reads its folder only)."""
    from .chunk_plans import chunk_sweep
    path = _scratch(spark, "sweep")
    SF.write_table(chunk_sweep(spark, sf_dir), path, partition_by="threshold")
    back = spark.read.parquet(path)
    return back.select(F.col("threshold").cast("int").alias("threshold"), "doc_id", "section_no", "section", "chunk_no", "chunk_id", "chunk_text", "n_tokens")


@register("tolerant_read", sql="""
SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND n_chars IS NOT NULL
""")
def tolerant_read(spark, sf_dir):
    """Documents written in two layouts, one without ``n_chars``; the
    tolerant read merges them and drops the files that lack the column."""
    d = t(spark, sf_dir, "documents", ["doc_id", "lang", "n_chars"])
    path = _scratch(spark, "layouts")
    SF.write_table(d.where("lang = 'en' AND n_chars IS NOT NULL"), f"{path}/full")
    SF.write_table(d.where("NOT (lang <=> 'en')").drop("n_chars"), f"{path}/short")
    return SF.read_corpus(spark, f"{path}/*", columns=["doc_id", "n_chars"], tolerant=True,
                          require="n_chars").select("doc_id", "n_chars")


@register("text_dir_roundtrip", sql=f"""
SELECT text FROM (SELECT {S.strip("replace(html, chr(65533), '')")} AS text FROM pages) WHERE text <> ''
""")
def text_dir_roundtrip(spark, sf_dir):
    """Every page written as a text file of its own and the folders read back."""
    p = t(spark, sf_dir, "pages", ["page_id", "html"])
    path = _scratch(spark, "texts")
    SF.write_text_dir(p, path, "page_id", "html")
    return SF.read_text_dir(spark, path).select("text")


@register("snapshot_roundtrip", sql="SELECT event_id, user_id, event_type, value FROM events")
def snapshot_roundtrip(spark, sf_dir):
    """A time-stamped CSV copy of the events, read back."""
    e = t(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    path = SF.export_snapshot(e, _scratch(spark, "snapshot"))
    return spark.read.schema(e.schema).option("header", True).option("escape", '"').csv(path)


@register("image_manifest_docs", sql="""
SELECT concat(lang, '_', CAST(doc_id AS VARCHAR), '.png') AS image_name, 'PNG' AS format,
       concat(CAST(n_chars AS VARCHAR), ' x ', CAST(doc_id + 1 AS VARCHAR), ' px') AS size FROM documents
""")
def image_manifest_docs(spark, sf_dir):
    """S13 + S14 + S15: images stored as base64 text (headers made of the
    documents' numbers): bytes, format, size and file name."""
    d = t(spark, sf_dir, "documents", ["doc_id", "lang", "n_chars"])
    head = F.concat(F.lit(SF.PNG_SIGNATURE + "0000000D49484452"), F.lpad(F.hex("n_chars"), 8, "0"),
                    F.lpad(F.hex(F.col("doc_id") + 1), 8, "0"), F.lit("0802000000"))
    rows = d.select(F.base64(F.unhex(head)).alias("image"), "lang", F.col("doc_id").alias("row_in_file"))
    return SF.extract_images(rows, "image", label_col="lang").select("image_name", "format", "size")


@register("row_guards", sql="""
SELECT lang, count(*) >= 5 AS enough FROM documents WHERE lang IS NOT NULL GROUP BY lang
""")
def row_guards(spark, sf_dir):
    """For each language, whether there are five documents (rows beyond
    the fifth change nothing, so the count is the guard)."""
    d = t(spark, sf_dir, "documents", ["lang"], spread_rows=False)
    return FB.rows_guard(d.where("lang IS NOT NULL"), "lang", 5)
