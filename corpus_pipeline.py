"""Corpus pipeline: language, quality, exact and near copies, packing.

Each stage is a function of (spark, docs, sf_dir).  Its result is written as
Parquet and read again as the next one's docs, so every stage starts from a
table and nothing is computed twice.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textrail.llm import cotrain, exact, langid, minhash, packing
from textrail.llm.common import documents, table
from textrail.session import ensure_checkpoint_dir, ship_package

#: Code points from which an ambiguous language speaks against a text.
TOLD = 200


def carried(docs: DataFrame) -> Column:
    """A document's columns in one, so that no stage can lose or replace one of them."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told.  Texts that are null or without
    letters are rejected, and ambiguous ones that are long enough (TOLD code
    points) to be told.  Repeated rows have one fate; columns of any name stay
    as they are; an empty table gives an empty one."""
    model = langid.fit(docs.select("lang", "text"))
    told = langid.predict(docs, model, keep=[carried(docs)])
    clear = ~F.col("ambiguous") | (F.char_length("doc.text") < TOLD)
    return told.where((F.col("lang_pred") != langid.UNKNOWN) & clear).select("doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality.  A null text counts as empty; repeated rows
    have one fate; columns of any name stay as they are; an empty table gives
    an empty one."""
    model = cotrain.fit(docs, table(spark, sf_dir, "labels"))
    return cotrain.score(docs, model, keep=[carried(docs)]).where("keep").select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (null counts as empty): the
    longest before white space is deleted, then the smallest id, null ids
    last.  Columns of any name stay as they are."""
    return exact.drop_copies(docs.select(carried(docs), "doc_id", "text")).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id,
    null ids last.  Columns of any name stay as they are."""
    return minhash.drop_near_copies(docs.select(carried(docs), "doc_id", "text")).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences.  A null or empty text is
    its end id alone; repeated rows are documents of their own."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", pack)]

#: Trained models and MinHash have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; their tables lie in the shared checkpoint folder."""
    ship_package(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
