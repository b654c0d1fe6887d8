"""Exact text top-k by pruned inverted lists.

The postings of the terms that queries ask for are kept as blocks: a term's
documents are dealt to pieces of about ``block`` postings, and a piece is cut
into impact levels (weights within a factor of the square root of two).  A
block carries its greatest weight, so whole blocks can be passed over; blocks
and joins are bounded by postings, however common a term is.

A query's threshold is the exact score of its k-th best document among those
that head its terms' best levels.  What a set of terms can add is at most the
sum of their greatest contributions and, where documents have a known norm, by
the Cauchy-Schwarz inequality their norm in the query times it.  Hence

* the terms with the longest lists that together cannot reach the threshold
  need not propose documents; a hit holds another, *essential* term;
* in an essential term's lists only blocks, and in them postings, count that
  reach the threshold with the most that all other terms can add.

What was proposed has then a score in part, whose k-th best raises the
threshold; what can still reach it is scored exactly, by looking up the rest.
Common words are hardly ever essential, so their lists are not joined.

Lists pay only where many queries ask for the same postings.  For few queries
a document's postings are brought together once, meet the queries in place,
and all their pairs are scored, without lists and lookups.
Everything is joins and aggregates on built-in functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import join_small, stored

BLOCK = 1024
#: Up to so many pairs of a posting and a query that asks for it, per posting,
#: all are scored in place: building lists costs more than these joins.
IN_PLACE = 32
#: One of so many documents is scored first there, for a threshold.
PART = 16
#: Postings of a term's best block that look for the threshold.
HEAD = 64
#: Scores this close to a threshold are decided exactly.
MARGIN = 1e-7


def impact_lists(postings: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(term, piece, level, top, entries)`` from ``(doc, term, w)``: entries
    are (w, doc), greatest first, at most about ``block`` in a piece."""
    sizes = postings.groupBy("term").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("pieces")).where("pieces > 1")
    dealt = (postings.join(sizes, "term", "left")
             .withColumn("piece", F.pmod(F.xxhash64("doc"), F.coalesce("pieces", F.lit(1))).cast("int"))
             .withColumn("level", F.floor(F.log2("w") * -2).cast("int")))
    return dealt.groupBy("term", "piece", "level").agg(F.max("w").alias("top"), F.sort_array(F.collect_list(F.struct("w", "doc")), asc=False).alias("entries"))


def _scored(pairs: DataFrame, postings: DataFrame, asked: DataFrame) -> DataFrame:
    """(query, doc, score): the exact scores of ``pairs``."""
    looked = pairs.join(asked.select("query", "term", "qw"), "query").join(postings, ["doc", "term"])
    return looked.groupBy("query", "doc").agg(F.sum(F.col("qw") * F.col("w")).alias("score"))


def _scored_in_place(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """(query, doc, score) of every pair with a common term; what is exchanged
    is the postings, by document."""
    whole = postings.where(F.col("doc").isNotNull()).repartition("doc")
    met = join_small(whole, asked.where(F.col("query").isNotNull()), "term")
    return met.groupBy("query", "doc").agg(F.sum(F.col("qw") * F.col("w")).alias("score"))


def _reaching(postings: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Those of ``_scored_in_place`` that reach the k-th best score among a
    part of the documents, which the k-th best of all cannot be below: few are
    left to be sorted."""
    part = _first(_scored_in_place(postings.where(F.pmod(F.xxhash64("doc"), F.lit(PART)) == 0), asked), k)
    bound = stored(part.groupBy("query").agg(F.max("rank").alias("found"), F.min("score").alias("threshold")).where(F.col("found") == k).drop("found"))
    scored = join_small(_scored_in_place(postings, asked), bound, "query", "left")
    return scored.where(F.col("score") >= F.coalesce("threshold", F.lit(0.0)) - MARGIN).drop("threshold")


def _first(scored: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.round("score", 9).desc(), "doc")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _hits(scored: DataFrame, k: int, doc_id: str, query_id: str) -> DataFrame:
    return _first(scored, k).select(
        F.col("query").alias(query_id), F.col("doc").alias(doc_id), F.col("rank").cast("bigint").alias("rank"), F.col("score").alias("similarity"))


def _most(c, square, norm: float | None):
    """The most that terms with these sums of contributions and of squared weights can add."""
    return c if norm is None else F.least(c, F.sqrt(F.greatest(square, F.lit(0.0))) * norm)


def plan_queries(lists: DataFrame, postings: DataFrame, asked: DataFrame, k: int, norm: float | None = None) -> DataFrame:
    """``(query, term, qw, n, threshold, essential, least, rest)`` for every
    term of ``asked`` (query, term, qw) that has postings (``n``): ``least`` is
    the smallest weight that can still reach the threshold, ``rest`` the most
    that the query's terms without proposals can add."""
    head = F.max_by(F.slice("entries", 1, HEAD), F.struct("top", F.negative("piece"))).alias("head")
    terms = asked.join(lists.groupBy("term").agg(F.max("top").alias("most"), F.sum(F.size("entries")).alias("n"), head), "term")
    heads = terms.select("query", "qw", F.explode("head").alias("e"))
    partial = heads.groupBy("query", F.col("e.doc").alias("doc")).agg(F.sum(F.col("qw") * F.col("e.w")).alias("score"))
    exact = _scored(_first(partial, 2 * k).select("query", "doc"), postings, asked)
    threshold = _first(exact, k).groupBy("query").agg(F.when(F.max("rank") == k, F.min("score")).alias("threshold"))
    longest, whole = Window.partitionBy("query").orderBy(F.desc("n"), "term"), Window.partitionBy("query")
    planned = terms.drop("head").join(threshold, "query", "left").withColumn("threshold", F.coalesce("threshold", F.lit(0.0)) - MARGIN)
    planned = planned.withColumn("c", F.col("qw") * F.col("most")).withColumn("square", F.col("qw") * F.col("qw"))
    planned = planned.withColumn("essential", _most(F.sum("c").over(longest), F.sum("square").over(longest), norm) >= F.col("threshold"))
    others = _most(F.sum("c").over(whole) - F.col("c"), F.sum("square").over(whole) - F.col("square"), norm)
    idle = [F.sum(F.when(F.col("essential"), 0.0).otherwise(F.col(x))).over(whole) for x in ("c", "square")]
    return planned.select("query", "term", "qw", "n", "threshold", "essential", ((F.col("threshold") - others) / F.col("qw")).alias("least"), _most(*idle, norm).alias("rest"))


def topk_text(doc_terms: DataFrame, query_terms: DataFrame, k: int = 5, doc_id: str = "doc_id", query_id: str = "query_id",
              block: int = BLOCK, norm: float | None = None, report: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """The exact ``k`` best documents of each query by the sum of products of
    the weights of their common terms: ``(query_id, doc_id, rank, similarity)``,
    ties (to nine digits) to the smaller id.  Both tables are (id, term,
    weight) with weights above 0 (others count as absent) and one row per id
    and term.  Documents without a common term are no hits.  ``norm``: no
    document's weights have a greater Euclidean norm (TF-IDF rows: 1).

    With ``report`` also ``(query_id, postings, joined, scored)``: the postings
    of the query's terms, those that were joined, and the documents scored;
    the lists are used then, however few the queries.
    """
    bound = None if norm is None else norm * (1 + 1e-9)
    asked = stored(query_terms.select(F.col(query_id).cast("bigint").alias("query"), "term", F.col("weight").alias("qw")).where("qw > 0"))
    wanted = asked.select("term").distinct()
    postings = stored(doc_terms.select(F.col(doc_id).cast("bigint").alias("doc"), "term", F.col("weight").alias("w")).where("w > 0").join(wanted, "term", "left_semi"))
    if not report:
        pairs = asked.join(postings.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term").agg(F.sum("n")).first()[0] or 0
        if pairs <= IN_PLACE * postings.count():
            return _hits(_reaching(postings, asked, k), k, doc_id, query_id)
    lists = stored(impact_lists(postings, block))
    plan = stored(plan_queries(lists, postings, asked, k, bound))
    reached = plan.where("essential").join(lists, "term").where("top >= least")
    joined = reached.select("query", "qw", "threshold", "rest", "least", F.explode("entries").alias("e")).where("e.w >= least")
    proposed = stored(joined.groupBy("query", F.col("e.doc").alias("doc")).agg(
        F.sum(F.col("qw") * F.col("e.w")).alias("score"), F.first("threshold").alias("threshold"), F.first("rest").alias("rest"), F.count(F.lit(1)).alias("n")))
    raised = _first(proposed, k).groupBy("query").agg(F.when(F.max("rank") == k, F.min("score")).alias("raised"))
    alive = proposed.join(raised, "query").where(F.col("score") + F.col("rest") >= F.greatest("threshold", F.col("raised") - MARGIN))
    hits = _hits(_scored(alive.select("query", "doc"), postings, asked), k, doc_id, query_id)
    if not report:
        return hits
    total = plan.groupBy("query").agg(F.sum("n").alias("postings"))
    used = proposed.groupBy("query").agg(F.sum("n").alias("joined")).join(alive.groupBy("query").agg(F.count(F.lit(1)).alias("scored")), "query", "left")
    return hits, total.join(used, "query", "left").select(F.col("query").alias(query_id), "postings", F.coalesce("joined", F.lit(0)).alias("joined"), F.coalesce("scored", F.lit(0)).alias("scored"))
