"""Best snippet (V8): the sentence of the retrieved chunks that is most
similar to the question.

The reference embeds every sentence of every hit in a double loop; here
the hits are exploded into sentences and their terms once, weighed by a join
on ``term`` with the corpus statistics and the question, and the arg-max is a
``row_number`` per query.  Ties go to the earlier hit, then the earlier
sentence (the strict ``>`` of a left-to-right scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ellipsize, strip
from ..session import compute_once
from . import features as FE
from .chunking import SENTENCE_END


def best_snippet(hits: DataFrame, docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id",
                 text_col: str = "text", idf: DataFrame | None = None, max_length: int = 250,
                 min_len: int = 0, fallback: bool = False, query_vectors: DataFrame | None = None) -> DataFrame:
    """``hits(query_id, doc_id, rank)``, ``docs(doc_id, text)``,
    ``queries(query_id, text)`` -> ``(query_id, source_doc, sent_no, score, snippet)``.

    ``min_len``/``fallback`` give variant B: stripped sentences shorter than
    ``min_len`` are ignored and a query without any sentence falls back to
    its first hit cut at ``max_length`` plus ``...``.
    """
    if idf is None:
        tc = FE.term_counts(docs, doc_id, text_col)
        idf = FE.idf_table(tc, doc_id, docs.count())
    sents = (hits.join(docs.select(doc_id, text_col), doc_id)
             .select("query_id", "rank", doc_id, F.posexplode_outer(F.split(F.col(text_col), SENTENCE_END)).alias("sent_no", "sentence"))
             .where(F.col("sent_no").isNotNull()))
    if min_len > 0:
        sents = sents.withColumn("sentence", strip(F.col("sentence"))).where(F.length("sentence") >= min_len)
    # one pass: a sentence's terms, its norm and its product with the question;
    # the sentence itself rides on its first term's row
    sents = compute_once(sents, "_terms", F.sort_array(FE.tokens("sentence")))
    terms = sents.select("query_id", "rank", doc_id, "sent_no", "sentence", F.posexplode_outer(FE.count_runs("_terms")).alias("_at", "_c"))
    terms = terms.select("query_id", "rank", doc_id, "sent_no", F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("sentence")).alias("sentence"), "_c.term", "_c.tf")
    # the questions' TF-IDF rows, unless retrieval already built them
    qv = (query_vectors if query_vectors is not None else FE.tfidf(queries, "query_id", text_col, fit=idf)).select(
        "query_id", "term", F.col("weight").alias("_qw"))
    raw = F.col("tf") * F.col("idf")
    weighed = terms.join(idf, "term", "left").join(qv, ["query_id", "term"], "left")
    scored = (weighed.groupBy("query_id", "rank", doc_id, "sent_no")
              .agg(F.max("sentence").alias("sentence"), F.sum(raw * F.col("_qw")).alias("_dot"), F.sqrt(F.sum(raw * raw)).alias("_norm"))
              .withColumn("score", F.coalesce(F.col("_dot") / F.col("_norm"), F.lit(0.0))))
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), F.col("rank").asc(), F.col("sent_no").asc())
    best = (scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select("query_id", F.col(doc_id).alias("source_doc"), F.col("sent_no").cast("bigint").alias("sent_no"),
                    "score", ellipsize(F.col("sentence"), max_length, "A").alias("snippet")))
    if not fallback:
        return best
    first = (hits.where(F.col("rank") == 1).join(docs.select(doc_id, text_col), doc_id)
             .select("query_id", F.col(doc_id).alias("source_doc"), F.lit(None).cast("bigint").alias("sent_no"),
                     F.lit(0.0).alias("score"),
                     F.concat(strip(F.substring(text_col, 1, max_length)), F.lit("...")).alias("snippet")))
    missing = first.join(best.select("query_id"), "query_id", "left_anti")
    return best.unionByName(missing)
