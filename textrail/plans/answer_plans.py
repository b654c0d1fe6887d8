"""Registered plan: the question-answering flow over a table of questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import answers as AN
from .common import r6, register, t
from .retrieval_plans import BEST_SNIPPET_SQL, _sql_query_topk, query_hits


_SNIP = BEST_SNIPPET_SQL.strip()


@register("answer_table", sql=f"""
WITH h AS ({_sql_query_topk(2)}),
snip AS ({_SNIP}),
c AS (SELECT h.query_id, d.text AS answer, h.rank AS ord
      FROM h JOIN documents d USING (doc_id)),
mx AS (SELECT query_id, max(ord) AS m FROM c GROUP BY query_id),
allc AS (SELECT * FROM c
         UNION ALL
         SELECT snip.query_id, concat('Based on the documents, here is some info:', chr(10), snip.snippet), coalesce(mx.m, -1) + 1
         FROM snip LEFT JOIN mx USING (query_id)),
sc AS (SELECT *, (CASE WHEN contains(lower(answer), 'summary') THEN 1.0 ELSE 0.0 END)
                 + (CASE WHEN len(list_filter(regexp_split_to_array(answer, '[\\t\\n\\x{{0B}}\\x{{0C}}\\r\\x{{1C}}-\\x{{1F}} \\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+'), lambda w: w <> '')) < 80
                         THEN 0.5 ELSE 0.0 END) AS reward FROM allc),
best AS (SELECT query_id, arg_max(answer, (reward, -ord)) AS answer, max(reward) AS reward FROM sc GROUP BY query_id)
SELECT best.query_id, best.answer, round(CAST(best.reward AS DOUBLE), 6) AS reward,
       concat(CAST(snip.source_doc AS VARCHAR), '.txt') AS source, snip.snippet
FROM best LEFT JOIN snip USING (query_id)
""")
def answer_table(spark, sf_dir):
    """V5 -> J13 -> P10 -> J9 -> V8 -> J7: every benchmark question answered
    from its top-2 documents; the best candidate (extractive or the
    snippet answer) by heuristic reward, with source file and snippet."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    b = t(spark, sf_dir, "benchmark", ["item_id", "text"]).withColumnRenamed("item_id", "query_id")
    hits, idf, qv = query_hits(spark, sf_dir, 2, with_idf=True)
    out = AN.answer_queries(hits, d, b, idf=idf, query_vectors=qv)
    return out.select("query_id", "answer", r6(F.col("reward")).alias("reward"), "source", "snippet")
