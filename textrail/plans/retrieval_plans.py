"""Registered plans: vectors, TF-IDF and exact retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as VF
from ..operators import features as FE
from ..operators import retrieval as R
from ..session import join_small, stored
from .common import r6, register, t

# ------------------------------------------------------------------ SQL pieces

_L2_SQL = ("list_sum(list_transform(range(1, len(a.embedding) + 1), "
           "lambda i: (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)) ** 2))")
_COS_SQL = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


def _sql_tfidf(src: str, id_col: str) -> str:
    """TF-IDF long table in SQL for a source ``(id, text)``."""
    return f"""
    (WITH s AS ({src}),
    tok AS (SELECT {id_col} AS id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}')) AS term FROM s),
    tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY id, term),
    n AS (SELECT count(DISTINCT {id_col}) AS n FROM s),
    dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    raw AS (SELECT tf.id, tf.term, tf.tf * (ln((1.0 + n.n) / (1.0 + dfq.df)) + 1.0) AS raw
            FROM tf JOIN dfq USING (term) CROSS JOIN n)
    SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw)"""


def _n(spark, sf_dir, name, col):
    """Row count of a raw table scan (parquet metadata)."""
    return t(spark, sf_dir, name, [col], spread_rows=False).count()


def _query_vectors(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec"))


# ------------------------------------------------------------------ V4 / V13


@register("topk_l2_all", sql=f"""
SELECT query_id, vec_id, CAST(rnk AS BIGINT) AS rank, round(d, 6) AS distance FROM (
  SELECT a.vec_id AS query_id, b.vec_id, {_L2_SQL} AS d,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY {_L2_SQL}, b.vec_id) AS rnk
  FROM embeddings a, embeddings b) WHERE rnk <= 5
""")
def topk_l2_all(spark, sf_dir):
    """Every vector as a query, exact top-5 by squared L2."""
    e = t(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    out = R.topk(e, _query_vectors(spark, sf_dir), k=5, metric="l2sq")
    return out.select("query_id", "vec_id", "rank", r6(F.col("distance")).alias("distance"))


@register("rerank_top2", sql=f"""
WITH hits AS (
  SELECT a.vec_id AS query_id, b.vec_id, {_COS_SQL} AS cos,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY {_L2_SQL}, b.vec_id) AS rnk
  FROM embeddings a, embeddings b QUALIFY rnk <= 5)
SELECT query_id, vec_id, CAST(rr AS BIGINT) AS rerank, round(cos, 6) AS cos FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cos DESC, vec_id) AS rr FROM hits) WHERE rr <= 2
""")
def rerank_top2(spark, sf_dir):
    """V4 -> V6 -> V7: top-5 by L2, re-scored by cosine, keep 2."""
    e = t(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    q = _query_vectors(spark, sf_dir)
    hits = R.topk(e, q, k=5).join(e, "vec_id")
    out = R.rerank(hits, q, keep=2)
    return out.select("query_id", "vec_id", F.col("rerank").cast("bigint").alias("rerank"), r6(F.col("cos")).alias("cos"))


@register("pairwise_cosine_top5", sql=f"""
SELECT query_id, vec_id, CAST(rnk AS BIGINT) AS rank, round(s, 6) AS similarity FROM (
  SELECT a.vec_id AS query_id, b.vec_id, {_COS_SQL} AS s,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY 1.0 - {_COS_SQL}, b.vec_id) AS rnk
  FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id) WHERE rnk <= 5
""")
def pairwise_cosine_top5(spark, sf_dir):
    """V9 re-aimed: each vector's 5 most similar other vectors."""
    e = t(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    out = R.pairwise_topk(e, k=5)
    return out.select("query_id", "vec_id", "rank", r6(F.col("similarity")).alias("similarity"))


@register("centroid_cosine", sql="""
WITH ex AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
cen AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM ex GROUP BY label, i),
dots AS (SELECT ex.vec_id, ex.label, sum(CAST(ex.x AS DOUBLE) * cen.m) AS d, sum(CAST(ex.x AS DOUBLE) * CAST(ex.x AS DOUBLE)) AS a2,
                sum(cen.m * cen.m) AS b2
         FROM ex JOIN cen ON ex.label = cen.label AND ex.i = cen.i GROUP BY ex.vec_id, ex.label)
SELECT vec_id, label, round(d / sqrt(a2 * b2), 6) AS cos_to_centroid FROM dots
""")
def centroid_cosine(spark, sf_dir):
    """V6: cosine of every vector to the mean vector of its label."""
    e = t(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    ex = e.select("label", F.posexplode_outer(VF.as_double("embedding")).alias("i", "x")).where(F.col("i").isNotNull())
    cen = (ex.groupBy("label", "i").agg(F.avg("x").alias("m"))
           .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("_c"))
           .select("label", F.transform("_c", lambda s: s["m"]).alias("centroid")))
    # one row per label: broadcast only behind a checked row count
    return (join_small(e, cen, "label")
            .select("vec_id", "label", r6(VF.cosine("embedding", "centroid")).alias("cos_to_centroid")))


@register("wide_vectors", sql="""
SELECT vec_id, label, round(CAST(embedding[1] AS DOUBLE), 6) AS emb_0, round(CAST(embedding[64] AS DOUBLE), 6) AS emb_63,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total
FROM embeddings
""")
def wide_vectors(spark, sf_dir):
    """S17 + S18: vector -> 64 columns -> text -> parsed back -> checks."""
    e = t(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    wide = VF.to_wide(e, "embedding", 64).withColumn("first", F.col("emb_0")).withColumn("last", F.col("emb_63"))
    back = VF.from_wide(wide, 64).select("vec_id", "label", F.to_json(F.col("embedding").cast("array<double>")).alias("vtext"),
                                         F.col("first").alias("emb_0"), F.col("last").alias("emb_63"))
    parsed = back.select("*", VF.parse_vector("vtext").alias("v"))
    return parsed.select("vec_id", "label", r6(F.col("emb_0")).alias("emb_0"), r6(F.col("emb_63")).alias("emb_63"),
                         r6(F.aggregate("v", F.lit(0.0), lambda s, x: s + x)).alias("total"))


# ------------------------------------------------------------------ V1 / V5 / V8


@register("tfidf_docs", sql=f"""
SELECT id AS doc_id, term, round(weight, 6) AS weight FROM {_sql_tfidf('SELECT doc_id, text FROM documents', 'doc_id')}
""")
def tfidf_docs(spark, sf_dir):
    """V1: TF-IDF (smooth idf, L2 rows) of every document."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    out = FE.tfidf(d, "doc_id", "text", n_docs=_n(spark, sf_dir, "documents", "doc_id"))
    return out.select("doc_id", "term", r6(F.col("weight")).alias("weight"))


def _sql_query_topk(k: int) -> str:
    docs = _sql_tfidf("SELECT doc_id, text FROM documents", "doc_id")
    return f"""
    WITH d AS {docs},
    tok AS (SELECT item_id AS id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}')) AS term FROM benchmark),
    tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY id, term),
    n AS (SELECT count(*) AS n FROM documents),
    dtok AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}')) AS term FROM documents),
    dfq AS (SELECT term, count(DISTINCT doc_id) AS df FROM dtok GROUP BY term),
    qraw AS (SELECT tf.id, tf.term, tf.tf * (ln((1.0 + n.n) / (1.0 + dfq.df)) + 1.0) AS raw FROM tf JOIN dfq USING (term) CROSS JOIN n),
    q AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM qraw),
    s AS (SELECT q.id AS query_id, d.id AS doc_id, sum(q.weight * d.weight) AS sim FROM q JOIN d USING (term) GROUP BY 1, 2)
    SELECT query_id, doc_id, CAST(rnk AS BIGINT) AS rank, sim FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, doc_id) AS rnk FROM s) WHERE rnk <= {k}"""


def query_hits(spark, sf_dir, k: int, with_idf: bool = False):
    """Benchmark items as text queries against documents (TF-IDF cosine)."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    b = t(spark, sf_dir, "benchmark", ["item_id", "text"])
    # the row count of the raw scan: answered from parquet metadata
    n_docs = t(spark, sf_dir, "documents", ["doc_id"], spread_rows=False).count()
    # every text is cut into terms once: statistics, rows and questions read the counts
    tc = stored(FE.term_counts(d, "doc_id", "text"))
    idf = stored(FE.idf_table(tc, "doc_id", n_docs))
    qv = stored(FE.tfidf(b, "item_id", "text", fit=idf).withColumnRenamed("item_id", "query_id"))
    # rows of the questions' terms only: the norms are those of all terms
    dv = FE.tfidf(d, "doc_id", "text", fit=idf, counts=tc, only=qv)
    hits = stored(FE.topk_sparse(dv, qv, k=k, norm=1.0))
    return (hits, idf, qv) if with_idf else hits


@register("text_query_top5", sql=f"""
SELECT query_id, doc_id, rank, round(sim, 6) AS similarity FROM ({_sql_query_topk(5)})
""")
def text_query_top5(spark, sf_dir):
    """Every benchmark item as a text query, exact top-5 documents."""
    out = query_hits(spark, sf_dir, 5)
    return out.select("query_id", "doc_id", "rank", r6(F.col("similarity")).alias("similarity"))


BEST_SNIPPET_SQL = f"""
WITH hits AS ({_sql_query_topk(2)}),
sents AS (
  SELECT h.query_id, h.rank, h.doc_id, unnest(string_split(regexp_replace(d.text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1))) AS sentence,
         generate_subscripts(string_split(regexp_replace(d.text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)), 1) AS sent_no
  FROM hits h JOIN documents d USING (doc_id)),
stok AS (SELECT query_id, rank, sent_no, doc_id, sentence, unnest(regexp_extract_all(lower(sentence), '[\\pL\\pN_]{{2,}}')) AS term FROM sents),
stf AS (SELECT query_id, rank, sent_no, term, count(*) AS tf FROM stok GROUP BY ALL),
n AS (SELECT count(*) AS n FROM documents),
dtok AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}')) AS term FROM documents),
dfq AS (SELECT term, count(DISTINCT doc_id) AS df FROM dtok GROUP BY term),
sraw AS (SELECT stf.*, tf * (ln((1.0 + n.n) / (1.0 + dfq.df)) + 1.0) AS raw FROM stf JOIN dfq USING (term) CROSS JOIN n),
sv AS (SELECT query_id, rank, sent_no, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_id, rank, sent_no)) AS w FROM sraw),
qtok AS (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}')) AS term FROM benchmark),
qtf AS (SELECT query_id, term, count(*) AS tf FROM qtok GROUP BY ALL),
qraw AS (SELECT qtf.*, tf * (ln((1.0 + n.n) / (1.0 + dfq.df)) + 1.0) AS raw FROM qtf JOIN dfq USING (term) CROSS JOIN n),
qv AS (SELECT query_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_id)) AS w FROM qraw),
sc AS (SELECT sv.query_id, sv.rank, sv.sent_no, sum(sv.w * qv.w) AS score FROM sv JOIN qv USING (query_id, term) GROUP BY ALL),
allsc AS (SELECT s.query_id, s.rank, s.sent_no, s.doc_id, s.sentence, coalesce(sc.score, 0.0) AS score
          FROM sents s LEFT JOIN sc USING (query_id, rank, sent_no)),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, rank, sent_no) AS r FROM allsc)
SELECT query_id, doc_id AS source_doc, CAST(sent_no - 1 AS BIGINT) AS sent_no, round(score, 6) AS score,
       CASE WHEN length(sentence) > 250 THEN concat(substr(sentence, 1, 250), '...') ELSE sentence END AS snippet
FROM best WHERE r = 1
"""


@register("best_snippet", sql=BEST_SNIPPET_SQL)
def best_snippet(spark, sf_dir):
    """V8: retrieve 2 documents per query, split into sentences, the best
    sentence by TF-IDF cosine wins (earlier hit / sentence on ties),
    ellipsized at 250 characters."""
    from ..operators.snippets import best_snippet as snip
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    b = t(spark, sf_dir, "benchmark", ["item_id", "text"]).withColumnRenamed("item_id", "query_id")
    hits, idf, qv = query_hits(spark, sf_dir, 2, with_idf=True)
    out = snip(hits, d, b, doc_id="doc_id", idf=idf, query_vectors=qv)
    return out.select("query_id", "source_doc", "sent_no", r6(F.col("score")).alias("score"), "snippet")


# ------------------------------------------------------------------ V11 / V12


@register("index_crud", sql="""
WITH ch AS (
  SELECT doc_id, 'delete' AS op, NULL AS text, 1 AS seq FROM labels WHERE toxic = 1
  UNION ALL SELECT doc_id, 'update', concat(d.text, ' [edited]'), 2 FROM labels JOIN documents d USING (doc_id) WHERE quality = 0 AND toxic = 0
  UNION ALL SELECT -3 * item_id - 1, 'add', text, 3 FROM benchmark
  UNION ALL SELECT -3 * item_id - 2, 'update', text, 4 FROM benchmark
  UNION ALL SELECT -3 * item_id - 3, 'delete', NULL, 5 FROM benchmark),
last AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY seq DESC) = 1),
eff AS (SELECT * FROM last WHERE op = 'add' OR (op IN ('update', 'delete') AND doc_id IN (SELECT doc_id FROM documents)))
SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM eff)
UNION ALL SELECT doc_id, text FROM eff WHERE op IN ('add', 'update')
""")
def index_crud(spark, sf_dir):
    """Keyed index upsert / update-if-present / delete-if-present."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    lab = t(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"], spread_rows=False)
    b = t(spark, sf_dir, "benchmark", ["item_id", "text"], spread_rows=False)
    dels = lab.where(F.col("toxic") == 1).select("doc_id", F.lit("delete").alias("op"), F.lit(None).cast("string").alias("text"),
                                                 F.lit(1).alias("seq"))
    upd = (lab.where((F.col("quality") == 0) & (F.col("toxic") == 0)).join(d, "doc_id")
           .select("doc_id", F.lit("update").alias("op"), F.concat("text", F.lit(" [edited]")).alias("text"), F.lit(2).alias("seq")))
    adds = b.select((F.col("item_id") * -3 - 1).alias("doc_id"), F.lit("add").alias("op"), "text", F.lit(3).alias("seq"))
    upd_missing = b.select((F.col("item_id") * -3 - 2).alias("doc_id"), F.lit("update").alias("op"), "text", F.lit(4).alias("seq"))
    del_missing = b.select((F.col("item_id") * -3 - 3).alias("doc_id"), F.lit("delete").alias("op"),
                           F.lit(None).cast("string").alias("text"), F.lit(5).alias("seq"))
    changes = dels.unionByName(upd).unionByName(adds).unionByName(upd_missing).unionByName(del_missing)
    return R.index_apply(d, changes, key="doc_id")


@register("hits_with_context", sql=f"""
WITH h AS ({_sql_query_topk(2)})
SELECT query_id, CAST(doc_id AS VARCHAR) AS chunk_id, rank FROM h
UNION ALL
SELECT item_id AS query_id, 'ocr_chunk' AS chunk_id, CAST(coalesce(m, 0) + 1 AS BIGINT) AS rank
FROM benchmark LEFT JOIN (SELECT query_id, max(rank) AS m FROM h GROUP BY query_id) mx ON mx.query_id = benchmark.item_id
""")
def hits_with_context(spark, sf_dir):
    """Extra uploaded-text row appended after each query's hits."""
    hits = query_hits(spark, sf_dir, 2).select("query_id", F.col("doc_id").cast("string").alias("chunk_id"), "rank")
    b = t(spark, sf_dir, "benchmark", ["item_id"], spread_rows=False)
    extra = b.select(F.col("item_id").alias("query_id"), F.lit("ocr_chunk").alias("chunk_id"))
    return R.add_context(hits, extra)
