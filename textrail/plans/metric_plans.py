"""Registered plans: chunk-overlap metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunking as C
from ..operators import features as FE
from ..operators import metrics as M
from ..session import stored
from . import sqlfrag as S
from .chunk_plans import _sql_windows
from .common import r6, register, t
from .retrieval_plans import _sql_tfidf

_WHOLE = -1  # chunk number of a whole document


def _key(chunk_no) -> "F.Column":
    """Key of a chunk: (document, chunk number)."""
    return F.struct("doc_id", (F.lit(chunk_no) if isinstance(chunk_no, int) else chunk_no).cast("bigint").alias("chunk_no"))


def _sql_key(doc_id: str, chunk_no) -> str:
    return f"struct_pack(doc_id := {doc_id}, chunk_no := CAST({chunk_no} AS BIGINT))"


def _sql_pairs() -> str:
    return f"""
    WITH w AS ({_sql_windows("SELECT doc_id, text FROM documents", 500, 450)}),
    pairs AS (SELECT a.doc_id, a.chunk_no, a.chunk_text AS text_a, b.chunk_text AS text_b
              FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.chunk_no = a.chunk_no + 1)"""


def _sql_grams(tok_expr: str, src: str, side: str) -> str:
    """n-gram counts (n = 1..4) of a token list per pair."""
    return f"""(SELECT doc_id, chunk_no, n, gram, count(*) AS c FROM (
        SELECT doc_id, chunk_no, n, unnest(list_transform(range(1, len(tk) - n + 2),
               lambda i: array_to_string(tk[i : i + n - 1], chr(1)))) AS gram
        FROM (SELECT doc_id, chunk_no, {tok_expr} AS tk FROM {src}) CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n))
      GROUP BY ALL) AS {side}"""


def _sql_sequence() -> str:
    """Pairs over the whole sequence: a document's last chunk is followed by the next one's first."""
    return f"""
    WITH w AS ({_sql_windows("SELECT doc_id, text FROM documents", 500, 450)}),
    pairs AS (SELECT doc_id, chunk_no, chunk_text AS text_a, lead(chunk_text) OVER (ORDER BY doc_id NULLS FIRST, chunk_no) AS text_b
              FROM w QUALIFY text_b IS NOT NULL)"""


def _sql_metrics(pairs: str | None = None) -> str:
    words_a, words_b = S.words("text_a"), S.words("text_b")
    rt = ("list_filter(string_split(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda s: s <> '')")
    ra, rb = rt.format(x="text_a"), rt.format(x="text_b")
    cos_src = f"(SELECT {_sql_key('doc_id', 'chunk_no')} AS cid, chunk_text AS text FROM w)"
    return f"""{pairs or _sql_pairs()},
    P AS (SELECT doc_id, chunk_no, len({words_a}) AS rl, len({words_b}) AS hl FROM pairs),
    nn AS (SELECT P.*, n FROM P CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n)),
    clip AS (SELECT h.doc_id, h.chunk_no, h.n, sum(least(h.c, coalesce(r.c, 0))) AS num
             FROM {_sql_grams(words_b, 'pairs', 'h')} LEFT JOIN {_sql_grams(words_a, 'pairs', 'r')}
             ON h.doc_id = r.doc_id AND h.chunk_no = r.chunk_no AND h.n = r.n AND h.gram = r.gram GROUP BY ALL),
    pn AS (SELECT nn.doc_id, nn.chunk_no, nn.n, nn.rl, nn.hl, coalesce(clip.num, 0) AS num, greatest(1, nn.hl - nn.n + 1) AS den
           FROM nn LEFT JOIN clip USING (doc_id, chunk_no, n)),
    bleu AS (SELECT doc_id, chunk_no,
               CASE WHEN max(num) FILTER (WHERE n = 1) = 0 THEN 0.0 ELSE
                 (CASE WHEN max(hl) > max(rl) THEN 1.0 WHEN max(hl) = 0 THEN 0.0 ELSE exp(1 - max(rl) / max(hl)) END)
                 * exp(sum(0.25 * ln(CASE WHEN num = 0 THEN 0.1 / den ELSE num / den END))) END AS bleu
             FROM pn GROUP BY doc_id, chunk_no),
    RT AS (SELECT doc_id, chunk_no, {ra} AS ta, {rb} AS tb FROM pairs),
    rg AS (SELECT doc_id, chunk_no, n, len(ta) - n + 1 AS nt, len(tb) - n + 1 AS np FROM RT CROSS JOIN (SELECT unnest([1, 2]) AS n)),
    ov AS (SELECT p.doc_id, p.chunk_no, p.n, sum(least(p.c, coalesce(t.c, 0))) AS o
           FROM {_sql_grams('tb', 'RT', 'p')} LEFT JOIN {_sql_grams('ta', 'RT', 't')}
           ON p.doc_id = t.doc_id AND p.chunk_no = t.chunk_no AND p.n = t.n AND p.gram = t.gram WHERE p.n <= 2 GROUP BY ALL),
    rf AS (SELECT rg.doc_id, rg.chunk_no, rg.n, coalesce(ov.o, 0) AS o, greatest(rg.nt, 0) AS nt, greatest(rg.np, 0) AS np
           FROM rg LEFT JOIN ov USING (doc_id, chunk_no, n)),
    rs AS (SELECT doc_id, chunk_no, n,
             CASE WHEN (CASE WHEN np > 0 THEN o / np ELSE 0 END) + (CASE WHEN nt > 0 THEN o / nt ELSE 0 END) > 0
                  THEN 2 * (CASE WHEN np > 0 THEN o / np ELSE 0 END) * (CASE WHEN nt > 0 THEN o / nt ELSE 0 END)
                       / ((CASE WHEN np > 0 THEN o / np ELSE 0 END) + (CASE WHEN nt > 0 THEN o / nt ELSE 0 END))
                  ELSE 0.0 END AS f FROM rf),
    tv AS {_sql_tfidf("SELECT cid, text FROM " + cos_src, "cid")},
    cs AS (SELECT a.id AS ida, b.id AS idb, sum(a.weight * b.weight) AS cos FROM tv a JOIN tv b USING (term) GROUP BY 1, 2),
    scored AS (
      SELECT pairs.doc_id, pairs.chunk_no, bleu.bleu,
             (SELECT f FROM rs WHERE rs.doc_id = pairs.doc_id AND rs.chunk_no = pairs.chunk_no AND rs.n = 1) AS rouge1,
             (SELECT f FROM rs WHERE rs.doc_id = pairs.doc_id AND rs.chunk_no = pairs.chunk_no AND rs.n = 2) AS rouge2,
             coalesce(cs.cos, 0.0) AS cosine
      FROM pairs JOIN bleu USING (doc_id, chunk_no)
      LEFT JOIN cs ON cs.ida = {_sql_key('pairs.doc_id', 'pairs.chunk_no')} AND cs.idb = {_sql_key('pairs.doc_id', 'pairs.chunk_no + 1')})"""


def _scored(spark, sf_dir, with_lcs: bool = False):
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    # read for the statistics and for the pairs
    chunks = stored(C.token_window(d, "doc_id", "text", 500, 50, global_ids=False).select("doc_id", "chunk_no", "chunk_text"))
    pairs = M.adjacent_pairs(chunks, "doc_id", "chunk_no", "chunk_text")
    scored = M.text_pair_metrics(pairs, "text_a", "text_b", with_lcs=with_lcs).select(*pairs.columns, "m.*")
    idf = FE.row_idf(chunks.select(_key(F.col("chunk_no")).alias("cid"), "chunk_text"), "cid", "chunk_text")
    return FE.pair_cosine(scored, ["doc_id", "chunk_no"], "text_a", "text_b", idf)


@register("chunk_overlap_metrics", sql=_sql_metrics() + """
SELECT doc_id, chunk_no, round(bleu, 6) AS bleu, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2,
       round(cosine, 6) AS cosine FROM scored
""")
def chunk_overlap_metrics(spark, sf_dir):
    """M1 + M2 + V10: BLEU-4, ROUGE-1/2 and TF-IDF cosine of adjacent chunks."""
    s = _scored(spark, sf_dir)
    return s.select("doc_id", "chunk_no", *[r6(F.col(c)).alias(c) for c in ("bleu", "rouge1", "rouge2", "cosine")])


@register("sequence_overlap_metrics", sql=_sql_metrics(_sql_sequence()) + """
SELECT doc_id, chunk_no, round(bleu, 6) AS bleu, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2 FROM scored
""")
def sequence_overlap_metrics(spark, sf_dir):
    """V10 over the whole sequence: BLEU-4 and ROUGE-1/2 of each chunk and the next, across documents too."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    chunks = C.token_window(d, "doc_id", "text", 500, 50, global_ids=False)
    pairs = M.adjacent_pairs(chunks, "doc_id", "chunk_no", "chunk_text", by_document=False)
    scored = M.text_pair_metrics(pairs, "text_a", "text_b", with_lcs=False)
    return scored.select("doc_id", "chunk_no", *[r6(F.col(f"m.{c}")).alias(c) for c in ("bleu", "rouge1", "rouge2")])


@register("overlap_report", sql=_sql_metrics() + """
SELECT round(avg(cosine), 6) AS avg_cosine, round(avg(bleu), 6) AS avg_bleu, round(avg(rouge1), 6) AS avg_rouge1,
       round(avg(rouge2), 6) AS avg_rouge2, CAST(count(*) AS BIGINT) AS n_pairs FROM scored
""")
def overlap_report(spark, sf_dir):
    """M4: average overlap metrics over all adjacent chunk pairs."""
    rep = M.overlap_report(_scored(spark, sf_dir), cols=("cosine", "bleu", "rouge1", "rouge2"))
    return rep.select(*[r6(F.col(f"avg_{c}")).alias(f"avg_{c}") for c in ("cosine", "bleu", "rouge1", "rouge2")], "n_pairs")


# the subsequence's length by thresholds: t[k] is the least place of tb where a common
# subsequence of k tokens can end; a token of ta moves each to its next place after t[k - 1]
@register("chunk_rouge_l", sql=_sql_metrics().replace("WITH", "WITH RECURSIVE", 1) + """,
places AS (SELECT doc_id, chunk_no, x, list(j ORDER BY j) AS p
           FROM (SELECT doc_id, chunk_no, unnest(tb) AS x, generate_subscripts(tb, 1) AS j FROM RT) GROUP BY ALL),
steps AS (SELECT doc_id, chunk_no, p, row_number() OVER (PARTITION BY doc_id, chunk_no ORDER BY i) AS i
          FROM (SELECT doc_id, chunk_no, unnest(ta) AS x, generate_subscripts(ta, 1) AS i FROM RT) JOIN places USING (doc_id, chunk_no, x)),
lcs AS (
  SELECT doc_id, chunk_no, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS t FROM RT
  UNION ALL
  SELECT l.doc_id, l.chunk_no, s.i,
    list_filter(list_transform(range(1, len(l.t) + 2), lambda k:
      least(coalesce(l.t[k], 1000000000), coalesce(list_min(list_filter(s.p, lambda j: j > coalesce(l.t[k - 1], 0))), 1000000000))), lambda v: v < 1000000000)
  FROM lcs l JOIN steps s ON s.doc_id = l.doc_id AND s.chunk_no = l.chunk_no AND s.i = l.i + 1),
length AS (SELECT doc_id, chunk_no, max(len(t)) AS c FROM lcs GROUP BY ALL)
SELECT doc_id, chunk_no, round(CASE WHEN c = 0 THEN 0.0 ELSE 2 * (c / len(tb)) * (c / len(ta)) / (c / len(tb) + c / len(ta)) END, 6) AS "rougeL"
FROM length JOIN RT USING (doc_id, chunk_no)
""")
def chunk_rouge_l(spark, sf_dir):
    """M3: ROUGE-L F1 (longest common subsequence) of adjacent chunks."""
    s = _scored(spark, sf_dir, with_lcs=True)
    return s.select("doc_id", "chunk_no", r6(F.col("rougeL")).alias("rougeL"))


@register("doc_chunk_tfidf_cosine", sql=f"""
WITH w AS ({_sql_windows("SELECT doc_id, text FROM documents", 100, 100)}),
u AS (SELECT {_sql_key('doc_id', _WHOLE)} AS id, text FROM documents
      UNION ALL SELECT {_sql_key('doc_id', 'chunk_no')} AS id, chunk_text AS text FROM w),
tv AS {_sql_tfidf("SELECT id, text FROM u", "id")},
cs AS (SELECT a.id AS ida, b.id AS idb, sum(a.weight * b.weight) AS cos FROM tv a JOIN tv b USING (term)
       WHERE a.id.chunk_no = {_WHOLE} AND b.id.chunk_no <> {_WHOLE} AND a.id.doc_id = b.id.doc_id GROUP BY 1, 2)
SELECT w.doc_id, w.chunk_no, round(coalesce(cs.cos, 0.0), 6) AS cosine
FROM w LEFT JOIN cs ON cs.ida = {_sql_key('w.doc_id', _WHOLE)} AND cs.idb = {_sql_key('w.doc_id', 'w.chunk_no')}
""")
def doc_chunk_tfidf_cosine(spark, sf_dir):
    """M5: document-vs-chunk TF-IDF cosine, vocabulary fitted on both sides."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    chunks = C.fixed_words(d, "doc_id", "text", 100)
    pairs = chunks.select(_key(F.col("chunk_no")).alias("id"))
    cos = FE.chunk_cosine(d, "doc_id", "text", 100).select(_key(F.col("chunk_no")).alias("id"), "cosine")
    return pairs.join(cos, "id", "left").select("id.doc_id", "id.chunk_no", r6(F.coalesce("cosine", F.lit(0.0))).alias("cosine"))
