"""Registered queries of the training-data operators.

Each query applies one operator to its whole table with production parameters
and derives the digest columns its contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, cotrain, exact, langid, licenses, linededup, minhash, negatives, packing, ppm, variants, warc
from .common import crc_fold, documents, scratch, table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir)).drop("_row")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table has no paths: a file in nested folders of 10,000, 1,000 and 100 ids of its source; of the rows
    # that name a licence, those whose id four divides are licence files of one of their three folders
    doc = F.col("doc_id")
    folders = F.array(*(F.floor(doc / n).cast("string") for n in (10_000, 1_000, 100)))
    is_file = F.coalesce(F.col("text").contains("icense") & (doc % 4 == 0), F.lit(False))
    depth = F.when(is_file, F.pmod(F.floor(doc / 4), F.lit(3)).cast("int") + 1).otherwise(3)
    name = F.concat(F.when(is_file, "LICENSE-").otherwise(""), doc.cast("string"), F.when(is_file, "").otherwise(".txt"))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.when(doc.isNotNull(), F.array_join(F.slice(folders, F.lit(1), depth), "/")), name)
    return licenses.scan(documents(spark, sf_dir), path)


def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_fold("doc_id", 5) == 1, F.lit(False))
    scored = ppm.score(documents(spark, sf_dir), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeats(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = cotrain.fit(docs, table(spark, sf_dir, "labels"))
    return cotrain.score(docs, model, keep=[F.col("doc_id")])


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", crc_fold("doc_id", 5) == 0)
    model = langid.fit(docs.where("not coalesce(held_out, false)").select("lang", "text"))
    return langid.predict(docs, model, keep=[F.col("doc_id"), F.coalesce("held_out", F.lit(False)).alias("held_out")])


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
), g AS (
  SELECT doc_id, t, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place, count(*) OVER (PARTITION BY t) AS group_size
  FROM d WINDOW w AS (PARTITION BY t ORDER BY len DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM g
"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.pages_of(warc.read_archives(spark, folder))


OP12_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), g AS (
  SELECT page_id, h, strlen(h) AS n, row_number() OVER (PARTITION BY h ORDER BY page_id) AS place, min(page_id) OVER (PARTITION BY h) AS head FROM p
)
SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN n >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND place > 1 THEN head END AS refers_to
FROM g
"""


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # runs of fewer than seven code points cannot become words; deletions make runs shorter only
    runs = documents(spark, sf_dir).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z\u00C0-\u00FF]{7,})"), F.lit(1))).alias("run"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = runs.select("doc_id", F.translate("run", upper, upper.lower()).alias("run"))
    mark = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run").cast("binary"))
    cut_at = (mark % F.char_length("run")).cast("int")
    typo = F.concat(F.substring("run", F.lit(1), cut_at), F.substring("run", cut_at + 2, F.char_length("run")))
    words = runs.select(F.when(mark % 31 == 0, typo).otherwise(F.col("run")).alias("word"))
    return variants.group_variants(variants.count_words(words, least=7, often=2))


QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_licenses, op3_ppm, op4_bpe, op5_line_dedup, op6_quality, op7_language, op8_neighbours, op9_exact_dedup, op10_packing, op11_hard_negatives, op12_warc, op13_variants)}
ORACLES = {"op9_exact_dedup": OP9_SQL, "op11_hard_negatives": OP11_SQL, "op12_warc": OP12_SQL}
