"""Shared pieces of the registered query plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread, table

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query plan ``(spark, sf_dir) -> DataFrame`` and its oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None,
      spread_rows: bool = True) -> DataFrame:
    """Scan one table (optionally projected) and spread it over the cores."""
    df = table(spark, sf_dir, name)
    if cols:
        df = df.select(*cols)
    return spread(df) if spread_rows else df


def noisy_text(doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Column:
    """OCR-style markers around a document (mirrors ``sqlfrag.noisy_text``)."""
    return F.concat(
        F.lit("[Source image: "), F.col(doc_id).cast("string"), F.lit(".png]\n\n"), F.col(text),
        F.lit("\n[ERROR reading block 7]"),
        F.when(F.col(lang) == "de", F.lit("\nReferences and notes")).otherwise(F.lit("")),
        F.lit(" (Confidence: 0.96) ( ) see http://img.example.com/"), F.col(doc_id).cast("string"),
        F.lit(" Page 3 of 10\u00a0[NO TEXT DETECTED]"))


def r6(c: Column) -> Column:
    """Round a double to 6 places (oracle comparisons)."""
    return F.round(c.cast("double"), 6)
