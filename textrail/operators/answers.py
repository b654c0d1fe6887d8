"""Answering a table of questions (the online question flow as one batch
plan): retrieve -> candidate answers (+ the snippet answer) -> score ->
best of n -> best snippet and its source document.

Answers are extractive here (each retrieved text as a whole):
text generation is a model runtime, not a data operator, and any model
output table can be fed in as ``candidates`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import heuristic_reward
from .selection import add_snippet_candidate, best_of_n
from .snippets import best_snippet


def extractive_candidates(hits: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One candidate per retrieved text: the text itself (rank order)."""
    return (hits.join(docs.select(doc_id, text_col), doc_id)
            .select("query_id", F.col(text_col).alias("answer"),
                    F.col("rank").alias("ord")))


def answer_queries(hits: DataFrame, docs: DataFrame, queries: DataFrame, idf: DataFrame | None = None,
                   candidates: DataFrame | None = None, score=heuristic_reward, doc_id: str = "doc_id",
                   text_col: str = "text", query_vectors: DataFrame | None = None) -> DataFrame:
    """``hits(query_id, doc_id, rank)``, ``docs(doc_id, text)``,
    ``queries(query_id, text)`` -> ``(query_id, answer, reward, source, snippet)``.

    ``score``: ``Column -> Column`` reward of an answer (default: the
    heuristic reward); ties go to the earlier candidate."""
    snip = best_snippet(hits, docs, queries, doc_id=doc_id, text_col=text_col, idf=idf, query_vectors=query_vectors)
    cands = candidates if candidates is not None else extractive_candidates(hits, docs, doc_id, text_col)
    allc = add_snippet_candidate(cands.withColumnRenamed("query_id", "query"),
                                 snip.select(F.col("query_id").alias("query"), "snippet"))
    scored = allc.withColumn("reward", score(F.col("answer")))
    best = best_of_n(scored, "query", "reward", "ord").withColumnRenamed("query", "query_id")
    src = snip.select("query_id", F.concat(F.col("source_doc").cast("string"), F.lit(".txt")).alias("source"), "snippet")
    return best.join(src, "query_id", "left").select("query_id", "answer", "reward", "source", "snippet")
