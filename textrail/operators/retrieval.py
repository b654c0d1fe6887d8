"""Exact retrieval.

The k nearest rows are found through pivot cells (``cells``): only blocks that
a query's k-th distance can reach are compared with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine
from . import cells


def topk(vectors: DataFrame, queries: DataFrame, k: int = 5, metric: str = "l2sq",
         vec_id: str = "vec_id", vec_col: str = "embedding", query_id: str = "query_id",
         query_col: str = "qvec", exclude_self: bool = False, block_rows: int = cells.BLOCK_ROWS) -> DataFrame:
    """Exact top-``k`` per query.

    ``metric="l2sq"`` ranks by squared L2 distance ascending (reported as
    ``distance``); ``metric="cosine"`` ranks by cosine similarity descending
    (reported as ``similarity``).  Ties go to the smaller ``vec_id``.
    Returns ``(query_id, vec_id, rank, distance|similarity)``.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec_col).alias("embedding"))
    asks = queries.select(F.col(query_id).alias("query_id"), F.col(query_col).alias("qvec"))
    ranked = cells.nearest(rows, asks, k, metric, exclude_self, block_rows)
    score = F.col("score").alias("distance") if metric == "l2sq" else (F.lit(1.0) - F.col("score")).alias("similarity")
    return ranked.select("query_id", "vec_id", "rank", score)


def pairwise_topk(vectors: DataFrame, k: int = 5, min_score: float | None = None, **kw) -> DataFrame:
    """V9 re-aimed: the n x n cosine matrix becomes each row's top-``k``
    most similar other rows (optionally above ``min_score``)."""
    q = vectors.select(F.col(kw.get("vec_id", "vec_id")).alias("query_id"), F.col(kw.get("vec_col", "embedding")).alias("qvec"))
    out = topk(vectors, q, k=k, metric="cosine", exclude_self=True, **kw)
    return out if min_score is None else out.where(F.col("similarity") >= min_score)


def rerank(hits: DataFrame, query_vecs: DataFrame, keep: int = 2, key: str = "query_id",
           hit_vec: str = "embedding", query_vec: str = "qvec", hit_id: str = "vec_id") -> DataFrame:
    """V7: cosine of each retrieved row to its query, descending, keep 2."""
    scored = hits.join(query_vecs.select(key, query_vec), key).withColumn("cos", cosine(hit_vec, query_vec))
    w = Window.partitionBy(key).orderBy(F.col("cos").desc_nulls_last(), F.col(hit_id).asc())
    return (scored.withColumn("rerank", F.row_number().over(w)).where(F.col("rerank") <= keep)
            .drop(query_vec))


def index_apply(index: DataFrame, changes: DataFrame, key: str = "vec_id", op_col: str = "op") -> DataFrame:
    """Apply ``add`` / ``update`` / ``delete`` rows to a keyed index.

    * add: insert; an existing id is replaced;
    * update: replace only when the id exists;
    * delete: remove only when the id exists.
    The last change per id wins (changes carry an order column ``seq``).
    """
    w = Window.partitionBy(key).orderBy(F.col("seq").desc())
    last = changes.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
    present = last.join(index.select(key), key, "left_semi")
    effective = last.where(F.col(op_col) == "add").unionByName(
        present.where(F.col(op_col).isin("update", "delete")))
    kept = index.join(effective.select(key), key, "left_anti")
    cols = index.columns
    upserts = effective.where(F.col(op_col).isin("add", "update")).select(*cols)
    return kept.unionByName(upserts)


def index_get(index: DataFrame, ids: DataFrame, key: str = "vec_id", text_col: str = "text") -> DataFrame:
    """V11 search view: requested ids with ``[DELETED]`` for missing text."""
    return ids.join(index, key, "left").select(ids.columns[0] if key not in ids.columns else key,
                                              F.coalesce(F.col(text_col), F.lit("[DELETED]")).alias(text_col))


def add_context(hits: DataFrame, extra: DataFrame, replace: bool = False, rank_col: str = "rank") -> DataFrame:
    """Append an extra context row per query after the retrieved
    rows (rank = max + 1), or use the extra row instead of them."""
    if replace:
        return extra.withColumn(rank_col, F.lit(1).cast("bigint"))
    maxr = hits.groupBy("query_id").agg(F.max(rank_col).alias("_m"))
    extra_ranked = (extra.join(maxr, "query_id", "left")
                    .withColumn(rank_col, (F.coalesce(F.col("_m"), F.lit(0)) + 1).cast("bigint")).drop("_m"))
    return hits.unionByName(extra_ranked, allowMissingColumns=True)
