"""Registered plans: feedback analytics, pairs, lookups, selection, windows
(A1-A8, J1-J14, W1-W8).

Stand-ins from the driver tables (the same mapping in the SQL twins):

* feedback log = ``events``: query ``<keyword> question <user_id>`` (the
  keyword cycles over the topic lists so categories are exercised), answer
  ``<event_type> answer <floor(value/10)>``, feedback ``bad`` for errors
  else ``good``, response time ``value``, time ``ts``;
* graded feedback: purchase good, click partially correct, view incorrect,
  error hallucinated;
* labelled answers = ``documents`` join ``labels``: query ``source|lang``,
  answer ``doc_<id>``, label ``quality``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import feedback as FB
from ..operators import selection as SEL
from . import sqlfrag as S
from ..session import compute_once
from .common import r6, register, t

# --- fixed values ----------------------------------------------------------
QUERY_KEYWORDS = ("código", "historia", "qué", "hola", "zzz")
GRADES = (("purchase", "good"), ("click", "partially correct"), ("view", "incorrect"), ("error", "hallucinated"))
# ---------------------------------------------------------------------------

_KW_SQL = "[" + ", ".join(S.q(k) for k in QUERY_KEYWORDS) + "]"


def _query_sql(uid: str = "user_id") -> str:
    return f"concat({_KW_SQL}[({uid}) % 5 + 1], ' question ', CAST(({uid}) AS VARCHAR))"


FB_SQL = f"""(SELECT event_id, ts, user_id, event_type, value AS response_time,
  {_query_sql()} AS query,
  concat(event_type, ' answer ', CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR)) AS answer,
  CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS feedback FROM events)"""


def query_col(uid: str = "user_id"):
    kw = F.element_at(F.array(*[F.lit(k) for k in QUERY_KEYWORDS]), (F.col(uid) % 5 + 1).cast("int"))
    return F.concat(kw, F.lit(" question "), F.col(uid).cast("string"))


def feedback_log(spark, sf_dir):
    e = t(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select("event_id", "ts", "user_id", "event_type", F.col("value").alias("response_time"),
                    query_col().alias("query"),
                    F.concat(F.col("event_type"), F.lit(" answer "), F.floor(F.col("value") / 10).cast("bigint").cast("string")).alias("answer"),
                    F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(F.lit("good")).alias("feedback"))


# ------------------------------------------------------------------ A1-A8


@register("feedback_scores", sql=f"""
WITH c AS (SELECT query, count(*) FILTER (WHERE feedback = 'good') AS good, count(*) FILTER (WHERE feedback = 'bad') AS bad
           FROM {FB_SQL} GROUP BY query),
q AS (SELECT DISTINCT {_query_sql('conv_id + 100')} AS query FROM conversations)
SELECT q.query, CAST(good AS BIGINT) AS good, CAST(bad AS BIGINT) AS bad,
       CASE WHEN good IS NULL THEN 'No feedback yet.'
            ELSE concat('Feedback: 👍 ', CAST(good AS VARCHAR), ' | 👎 ', CAST(bad AS VARCHAR)) END AS summary
FROM q LEFT JOIN c USING (query)
""")
def feedback_scores(spark, sf_dir):
    """A1: good/bad per asked query, ``No feedback yet.`` when unseen."""
    fb = feedback_log(spark, sf_dir)
    c = t(spark, sf_dir, "conversations", ["conv_id"], spread_rows=False)
    asked = c.select((F.col("conv_id") + 100).alias("uid")).select(query_col("uid").alias("query"))
    return FB.feedback_score(fb, asked)


@register("lang_share", sql="""
SELECT lang, CAST(count(*) AS BIGINT) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM documents GROUP BY lang
""")
def lang_share(spark, sf_dir):
    """A2 + P9: value counts and shares of the language column."""
    d = t(spark, sf_dir, "documents", ["lang"], spread_rows=False)
    return FB.value_share(d, "lang").select("lang", "n", r6(F.col("pct")).alias("pct"))


@register("dedupe_answers", sql=f"""
SELECT query, arg_min(answer, event_id) AS answer, min(event_id) AS event_id,
       CAST(count(DISTINCT answer) AS BIGINT) AS n_distinct_answers
FROM {FB_SQL} GROUP BY query
""")
def dedupe_answers(spark, sf_dir):
    """A3: first answer per query (order-preserving dedup) + distinct count."""
    fb = feedback_log(spark, sf_dir)
    first = FB.dedupe_first(fb, "query", "event_id", ["answer"])
    nd = fb.select("query", "answer").distinct().groupBy("query").agg(F.count(F.lit(1)).cast("bigint").alias("n_distinct_answers"))
    return first.join(nd, "query")


@register("performance_report", sql=f"""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE lower(feedback) = 'good') AS BIGINT) AS good,
       CAST(count(*) - count(*) FILTER (WHERE lower(feedback) = 'good') AS BIGINT) AS bad,
       round(count(*) FILTER (WHERE lower(feedback) = 'good') / greatest(count(*), 1), 6) AS success_rate,
       round(coalesce(avg(response_time), 0.0), 6) AS avg_response_time, max(ts) AS last_event
FROM {FB_SQL}
""")
def performance_report(spark, sf_dir):
    """A4: one-row performance report of the feedback log."""
    rep = FB.performance_report(feedback_log(spark, sf_dir), ts="ts")
    return rep.select("total", "good", "bad", r6(F.col("success_rate")).alias("success_rate"),
                      r6(F.col("avg_response_time")).alias("avg_response_time"), "last_event")


def _topic_sql(x: str) -> str:
    parts = []
    for name, keys in T.TOPIC_RULES:
        cond = " OR ".join(f"contains(lower({x}), {S.q(k)})" for k in keys)
        parts.append(f"WHEN {cond} THEN {S.q(name)}")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


_CAT_SQL = f"""(SELECT {_topic_sql('query')} AS category,
   CAST(count(*) FILTER (WHERE lower(feedback) = 'good') AS BIGINT) AS good,
   CAST(count(*) - count(*) FILTER (WHERE lower(feedback) = 'good') AS BIGINT) AS bad,
   CAST(count(*) AS BIGINT) AS total FROM {FB_SQL} GROUP BY 1)"""


@register("category_report", sql=f"SELECT * FROM {_CAT_SQL}")
def category_report(spark, sf_dir):
    """A5: per-category good / bad / total."""
    return FB.category_report(feedback_log(spark, sf_dir))


@register("problem_categories", sql=f"""
SELECT category, good, bad, total, round(bad / total, 6) AS bad_ratio FROM {_CAT_SQL} WHERE total > 0 AND bad / total > 0.18
""")
def problem_categories(spark, sf_dir):
    """Categories with a bad share above the limit (0.18 here so the
    synthetic log, ~20 % errors, yields both outcomes)."""
    out = FB.problem_categories(feedback_log(spark, sf_dir), limit=0.18)
    return out.select("category", "good", "bad", "total", r6(F.col("bad_ratio")).alias("bad_ratio"))


@register("quality_metrics", sql="""
WITH p AS (SELECT l.quality AS label, CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS prediction
           FROM labels l JOIN documents d USING (doc_id)),
a AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS correct,
             count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM p),
m AS (SELECT correct / n AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS prec,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rec FROM a)
SELECT round(accuracy, 6) AS accuracy, round(prec, 6) AS precision, round(rec, 6) AS recall,
       round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END, 6) AS f1 FROM m
""")
def quality_metrics(spark, sf_dir):
    """Accuracy / precision / recall / F1 of a length rule vs quality labels."""
    lab = t(spark, sf_dir, "labels", ["doc_id", "quality"], spread_rows=False)
    d = t(spark, sf_dir, "documents", ["doc_id", "n_chars"], spread_rows=False)
    p = lab.join(d, "doc_id").select(F.col("quality").alias("label"),
                                     F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("prediction"))
    m = FB.binary_metrics(p)
    return m.select(*[r6(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register("ranking_loss", sql="""
WITH p AS (SELECT value AS chosen, CAST(json_extract(props, '$.k') AS DOUBLE) / 10.0 AS rejected,
                  CASE WHEN event_type IN ('purchase', 'signup') THEN 1.0 ELSE 0.0 END AS preferred FROM events),
x AS (SELECT (chosen - rejected) * (2.0 * preferred - 1.0) AS x, chosen, rejected FROM p)
SELECT round(avg(greatest(0.0, 1.0 - (chosen - rejected))), 6) AS hinge_loss,
       round(avg(CASE WHEN x >= 0 THEN ln(1 + exp(-x)) ELSE -x + ln(1 + exp(x)) END), 6) AS logistic_loss FROM x
""")
def ranking_loss(spark, sf_dir):
    """Hinge (margin 1) and logistic pairwise ranking losses."""
    e = t(spark, sf_dir, "events", ["value", "props", "event_type"])
    p = e.select(F.col("value").alias("chosen"),
                 (F.get_json_object("props", "$.k").cast("double") / 10.0).alias("rejected"),
                 F.when(F.col("event_type").isin("purchase", "signup"), 1.0).otherwise(0.0).alias("preferred"))
    out = p.agg(FB.pairwise_loss_expr("chosen", "rejected", "hinge", margin=1.0).alias("hinge_loss"),
                FB.pairwise_loss_expr("chosen", "rejected", "logistic", preferred="preferred").alias("logistic_loss"))
    return out.select(r6(F.col("hinge_loss")).alias("hinge_loss"), r6(F.col("logistic_loss")).alias("logistic_loss"))


# ------------------------------------------------------------------ J1 / J2
# the stand-in questions cover a bounded span (200 documents; a user's day), so that pairs grow with the rows


def _sql_pairs(distinct: str, rows: str, label: str, good: str, bad: str, left: str, right: str) -> str:
    return f"""
    WITH fb AS {rows}
    SELECT g.query, g.answer AS {left}, b.answer AS {right}
    FROM (SELECT {distinct} query, answer FROM fb WHERE {label} {good}) g
    JOIN (SELECT {distinct} query, answer FROM fb WHERE {label} {bad}) b USING (query)"""


_LABELLED_SQL = "(SELECT concat(d.lang, '|', CAST(d.doc_id // 200 AS VARCHAR)) AS query, concat('doc_', CAST(d.doc_id AS VARCHAR)) AS answer, l.quality AS label FROM documents d JOIN labels l USING (doc_id))"


@register("preference_pairs", sql=_sql_pairs("DISTINCT", _LABELLED_SQL, "label", "= 1", "= 0", "answer_preferred", "answer_dispreferred"))
def preference_pairs(spark, sf_dir):
    """Preferred x dispreferred answers per query."""
    d = t(spark, sf_dir, "documents", ["doc_id", "lang"], spread_rows=False)
    lab = t(spark, sf_dir, "labels", ["doc_id", "quality"], spread_rows=False)
    fb = d.join(lab, "doc_id").select(F.concat_ws("|", "lang", F.floor(F.col("doc_id") / 200).cast("string")).alias("query"),
                                      F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("answer"),
                                      F.col("quality").alias("label"))
    return FB.preference_pairs(fb)


def _grade_sql() -> str:
    return "CASE event_type " + " ".join(f"WHEN {S.q(a)} THEN {S.q(b)}" for a, b in GRADES) + " END"


_GRADED_SQL = f"(SELECT concat({_query_sql()}, ' on ', strftime(ts, '%Y-%m-%d')) AS query, concat(event_type, ' answer ', CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR)) AS answer, {_grade_sql()} AS grade FROM events)"


@register("graded_pairs", sql=_sql_pairs("ALL", _GRADED_SQL, "grade", "= 'good'", "IN ('partially correct', 'hallucinated', 'incorrect')",
                                          "chosen_answer", "rejected_answer"))
def graded_pairs(spark, sf_dir):
    """Good x lower-graded answers per query and day."""
    fb = feedback_log(spark, sf_dir)
    grade = F.lit(None).cast("string")
    for a, b in reversed(GRADES):
        grade = F.when(F.col("event_type") == a, F.lit(b)).otherwise(grade)
    fb = fb.withColumn("query", F.concat(F.col("query"), F.lit(" on "), F.date_format("ts", "yyyy-MM-dd")))
    return FB.graded_pairs(fb.withColumn("grade", grade), grade="grade")


# ------------------------------------------------------------------ J4-J8


@register("lookup_last_turn", sql="""
WITH last AS (SELECT concat('q', CAST(conv_id AS VARCHAR)) AS question, arg_max(text, turn) AS chunk FROM conversations GROUP BY conv_id),
keys AS (SELECT DISTINCT concat('q', CAST(conv_id + 50 AS VARCHAR)) AS question FROM conversations)
SELECT keys.question, coalesce(chunk, 'No answer found.') AS chunk FROM keys LEFT JOIN last USING (question)
""")
def lookup_last_turn(spark, sf_dir):
    """Question -> text, last entry wins, default ``No answer found.``."""
    c = t(spark, sf_dir, "conversations")
    src = c.select(F.concat(F.lit("q"), F.col("conv_id").cast("string")).alias("question"), F.col("text").alias("chunk"), "turn")
    keys = c.select(F.concat(F.lit("q"), (F.col("conv_id") + 50).cast("string")).alias("question")).distinct()
    return FB.lookup_last(src, "question", "chunk", "turn", keys)


@register("cache_aside", sql=f"""
WITH req AS (SELECT DISTINCT concat(text, '_noocr') AS cache_key, text FROM conversations WHERE role = 'user'),
cache AS (SELECT DISTINCT concat(text, '_noocr') AS cache_key, concat('cached: ', CAST(conv_id AS VARCHAR)) AS answer
          FROM conversations WHERE role = 'user' AND conv_id % 3 = 0),
miss AS (SELECT cache_key, {S.after_marker("concat('Answer: ', text)", 'Answer:')} AS answer FROM req WHERE cache_key NOT IN (SELECT cache_key FROM cache))
SELECT cache_key, answer, 'cache' AS origin FROM cache
UNION ALL SELECT cache_key, answer, 'fresh' FROM miss WHERE answer IS NOT NULL
""")
def cache_aside(spark, sf_dir):
    """J5 (+T15, T16): cache hits, computed misses, merged new cache."""
    c = t(spark, sf_dir, "conversations")
    users = c.where(F.col("role") == "user")
    req = users.select(T.cache_key(F.col("text")).alias("cache_key"), "text").distinct()
    cache = (users.where(F.col("conv_id") % 3 == 0)
             .select(T.cache_key(F.col("text")).alias("cache_key"),
                     F.concat(F.lit("cached: "), F.col("conv_id").cast("string")).alias("answer")).distinct())
    _, misses = FB.cache_split(req, cache)
    fresh = compute_once(misses, "answer", T.after_marker(F.concat(F.lit("Answer: "), F.col("text")), "Answer:")).select(
        "cache_key", "answer")
    merged = FB.cache_merge(cache.withColumn("origin", F.lit("cache")), fresh.withColumn("origin", F.lit("fresh")))
    return merged


@register("attach_latest_rt", sql="""
WITH lastv AS (SELECT user_id, arg_max(value, ts) AS v FROM events WHERE event_type = 'view' GROUP BY user_id)
SELECT e.event_id, e.user_id, round(coalesce(lastv.v, 0.0), 6) AS response_time
FROM events e LEFT JOIN lastv USING (user_id) WHERE e.event_type = 'error'
""")
def attach_latest_rt(spark, sf_dir):
    """Each bad feedback gets the user's latest view time (0 if none)."""
    e = t(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    fb = e.where(F.col("event_type") == "error").select("event_id", "user_id")
    log = e.where(F.col("event_type") == "view").select("user_id", "value", "ts")
    out = FB.attach_latest(fb, log, ["user_id"], "value", "ts", 0.0, out="response_time")
    return out.select("event_id", "user_id", r6(F.col("response_time")).alias("response_time"))


@register("source_documents", sql="""
SELECT b.item_id, concat(CAST(b.item_id * 7 AS VARCHAR), '.txt') AS filename, d.text AS full_text, round(e.s, 6) AS vec_sum
FROM benchmark b LEFT JOIN documents d ON d.doc_id = b.item_id * 7
LEFT JOIN (SELECT vec_id, list_sum(CAST(embedding AS DOUBLE[])) AS s FROM embeddings) e ON e.vec_id = b.item_id * 7
""")
def source_documents(spark, sf_dir):
    """J7 + J8 + J3: file name -> full document (null if missing), vector by key."""
    b = t(spark, sf_dir, "benchmark", ["item_id"], spread_rows=False)
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    e = t(spark, sf_dir, "embeddings", ["vec_id", "embedding"], spread_rows=False)
    req = b.select("item_id", (F.col("item_id") * 7).alias("doc_id"))
    docs = d.select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), F.col("text").alias("full_text"))
    vec = e.select(F.col("vec_id").alias("doc_id"), F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0),
                                                                 lambda s, x: s + x).alias("s"))
    out = (req.withColumn("filename", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
           .join(docs, "filename", "left").join(vec, "doc_id", "left"))
    return out.select("item_id", "filename", "full_text", r6(F.col("s")).alias("vec_sum"))


# ------------------------------------------------------------------ J9-J13


@register("best_of_n", sql=f"""
SELECT query, arg_max(answer, (response_time, -event_id)) AS answer, max(response_time) AS reward,
       arg_max(event_id, (response_time, -event_id)) AS ord
FROM {FB_SQL} GROUP BY query
""")
def best_of_n(spark, sf_dir):
    """Highest reward per query (reward = value), first wins ties."""
    fb = feedback_log(spark, sf_dir).select("query", "answer", F.col("response_time").alias("reward"),
                                            F.col("event_id").alias("ord"))
    return SEL.best_of_n(fb, "query", "reward", "ord")


@register("longest_answer", sql="""
WITH b AS (SELECT conv_id, arg_max(text, (length(text), -turn)) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
k AS (SELECT DISTINCT conv_id FROM conversations)
SELECT k.conv_id, coalesce(b.answer, 'No answer found.') AS answer FROM k LEFT JOIN b USING (conv_id)
""")
def longest_answer(spark, sf_dir):
    """Longest assistant answer per conversation, default text."""
    c = t(spark, sf_dir, "conversations")
    cands = c.where(F.col("role") == "assistant").select("conv_id", F.col("text").alias("answer"), F.col("turn").alias("ord"))
    return SEL.longest(cands, "conv_id", keys=c.select("conv_id").distinct())


def _band_sql(x: str, key: str) -> str:
    return f"""(CASE
      WHEN contains(lower({x}), 'bad') OR contains(lower({x}), 'irrelevant') OR contains(lower({x}), 'nonsensical')
           OR contains(lower({x}), 'a bit off') THEN 0.0 + {S.uniform_hash(key, 42)} * 0.3
      WHEN contains(lower({x}), 'good') OR contains(lower({x}), 'excellent') OR contains(lower({x}), 'clear')
           OR contains(lower({x}), 'precise') THEN 0.7 + {S.uniform_hash(key, 42)} * 0.3
      ELSE 0.3 + {S.uniform_hash(key, 42)} * 0.6 END)"""


@register("chosen_rejected", sql=f"""
WITH p AS (
  SELECT u.conv_id, u.text AS prompt, a1.text AS r1, a2.text AS r2,
         {_band_sql('a1.text', "concat(CAST(a1.conv_id AS VARCHAR), ':', CAST(a1.turn AS VARCHAR))")} AS s1,
         {_band_sql('a2.text', "concat(CAST(a2.conv_id AS VARCHAR), ':', CAST(a2.turn AS VARCHAR))")} AS s2
  FROM conversations u JOIN conversations a1 ON a1.conv_id = u.conv_id AND a1.turn = u.turn + 1
  JOIN conversations a2 ON a2.conv_id = u.conv_id AND a2.turn = u.turn + 3
  WHERE u.role = 'user')
SELECT conv_id, prompt, CASE WHEN s1 >= s2 THEN r1 ELSE r2 END AS chosen, CASE WHEN s1 >= s2 THEN r2 ELSE r1 END AS rejected
FROM p WHERE r1 <> r2
""")
def chosen_rejected(spark, sf_dir):
    """J11 + P11: chosen/rejected from two quality-scored follow-up turns."""
    c = t(spark, sf_dir, "conversations")
    key = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    scored = c.select("conv_id", "turn", "text", T.quality_band("text", key, 42).alias("s"))
    u = c.where(F.col("role") == "user").select("conv_id", F.col("turn").alias("ut"), F.col("text").alias("prompt"))
    a1 = scored.select("conv_id", (F.col("turn") - 1).alias("ut"), F.col("text").alias("response_1"), F.col("s").alias("score_1"))
    a2 = scored.select("conv_id", (F.col("turn") - 3).alias("ut"), F.col("text").alias("response_2"), F.col("s").alias("score_2"))
    p = u.join(a1, ["conv_id", "ut"]).join(a2, ["conv_id", "ut"])
    return SEL.chosen_rejected(p, prompt="prompt", keep=("conv_id",))


@register("fallback_answers", sql=f"""
SELECT conv_id, turn,
  CASE WHEN primary_a IS NOT NULL AND {S.strip('primary_a')} <> '' AND NOT (length({S.strip('primary_a')}) < 20 OR contains(primary_a, '....')
            OR contains(primary_a, 'andand') OR contains(primary_a, 's.s.s') OR contains(primary_a, ',.,.,') OR contains(primary_a, '0000'))
       THEN primary_a
       WHEN secondary_a IS NOT NULL AND {S.strip('secondary_a')} <> '' AND NOT (length({S.strip('secondary_a')}) < 20 OR contains(secondary_a, '....')
            OR contains(secondary_a, 'andand') OR contains(secondary_a, 's.s.s') OR contains(secondary_a, ',.,.,') OR contains(secondary_a, '0000'))
       THEN secondary_a
       ELSE 'I''m sorry, I could not find an answer.' END AS answer,
  CASE WHEN primary_a IS NOT NULL AND {S.strip('primary_a')} <> '' AND NOT (length({S.strip('primary_a')}) < 20 OR contains(primary_a, '....')
            OR contains(primary_a, 'andand') OR contains(primary_a, 's.s.s') OR contains(primary_a, ',.,.,') OR contains(primary_a, '0000'))
       THEN 'api'
       WHEN secondary_a IS NOT NULL AND {S.strip('secondary_a')} <> '' AND NOT (length({S.strip('secondary_a')}) < 20 OR contains(secondary_a, '....')
            OR contains(secondary_a, 'andand') OR contains(secondary_a, 's.s.s') OR contains(secondary_a, ',.,.,') OR contains(secondary_a, '0000'))
       THEN 'local'
       ELSE 'fallback' END AS model_used
FROM (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text END AS primary_a,
             CASE WHEN role <> 'system' THEN text END AS secondary_a FROM conversations)
""")
def fallback_answers(spark, sf_dir):
    """J12 (+P5): primary -> secondary -> fixed message, with provenance."""
    c = t(spark, sf_dir, "conversations")
    x = c.select("conv_id", "turn", F.when(F.col("role") == "assistant", F.col("text")).alias("primary_a"),
                 F.when(F.col("role") != "system", F.col("text")).alias("secondary_a"))
    out = SEL.fallback_chain(x, ["primary_a", "secondary_a"], gate=T.is_gibberish, names=["api", "local"])
    return out.select("conv_id", "turn", "answer", "model_used")


@register("candidate_set", sql="""
WITH c AS (SELECT conv_id AS query, text AS answer, turn AS ord FROM conversations WHERE role = 'assistant'),
s AS (SELECT conv_id AS query, text AS snippet FROM conversations WHERE turn = 0),
mx AS (SELECT query, max(ord) AS m FROM c GROUP BY query)
SELECT query, answer, ord FROM c
UNION ALL SELECT s.query, concat('Based on the documents, here is some info:', chr(10), s.snippet), coalesce(mx.m, -1) + 1
FROM s LEFT JOIN mx USING (query)
""")
def candidate_set(spark, sf_dir):
    """Model answers + the snippet-based answer as the last candidate."""
    c = t(spark, sf_dir, "conversations")
    cands = c.where(F.col("role") == "assistant").select(F.col("conv_id").alias("query"), F.col("text").alias("answer"),
                                                         F.col("turn").alias("ord"))
    snips = c.where(F.col("turn") == 0).select(F.col("conv_id").alias("query"), F.col("text").alias("snippet"))
    return SEL.add_snippet_candidate(cands, snips)


# ------------------------------------------------------------------ W1-W8


@register("hash_sample_docs", sql="""
SELECT doc_id, lang FROM documents ORDER BY md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR))), doc_id LIMIT 50
""")
def hash_sample_docs(spark, sf_dir):
    """Reproducible sample of 50 documents (sampling is the feature)."""
    d = t(spark, sf_dir, "documents", ["doc_id", "lang"], spread_rows=False)
    return FB.hash_sample(d, "doc_id", 50, seed=42)


@register("hash_split_labels", sql=f"""
SELECT CASE WHEN {S.uniform_hash('doc_id', 42)} < 0.8 THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(quality) AS BIGINT) AS n_good
FROM labels GROUP BY 1
""")
def hash_split_labels(spark, sf_dir):
    """Deterministic 80/20 split of the labelled set."""
    lab = t(spark, sf_dir, "labels", ["doc_id", "quality"], spread_rows=False)
    s = FB.hash_split(lab, "doc_id", (0.8, 0.2), seed=42)
    return s.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("quality").cast("bigint").alias("n_good"))


@register("history_last2", sql="""
SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 2
""")
def history_last2(spark, sf_dir):
    """Last two turns of every conversation."""
    c = t(spark, sf_dir, "conversations", ["conv_id", "turn", "role"])
    return FB.last_n(c, "conv_id", "turn", 2)


@register("first_docs", sql="SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 10")
def first_docs(spark, sf_dir):
    """First-n rows by key (the head is the feature)."""
    return t(spark, sf_dir, "documents", ["doc_id", "source"], spread_rows=False).orderBy("doc_id").limit(10)


@register("top3_events_per_user", sql="""
SELECT user_id, event_id, CAST(r AS BIGINT) AS rank FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 3
""")
def top3_events_per_user(spark, sf_dir):
    """Top-3 rows per key by a descending score."""
    e = t(spark, sf_dir, "events", ["user_id", "event_id", "value"])
    out = FB.top_k(e, "user_id", [F.col("value").desc(), F.col("event_id").asc()], 3)
    return out.select("user_id", "event_id", F.col("rank").cast("bigint").alias("rank"))


@register("softmax_rewards", sql=f"""
SELECT event_id, query, round(e / sum(e) OVER (PARTITION BY query), 6) AS prob FROM (
  SELECT event_id, query, exp(response_time - max(response_time) OVER (PARTITION BY query)) AS e FROM {FB_SQL})
""")
def softmax_rewards(spark, sf_dir):
    """Softmax of rewards per query."""
    fb = feedback_log(spark, sf_dir)
    out = SEL.softmax_by(fb.select("event_id", "query", "response_time"), "query", "response_time")
    return out.select("event_id", "query", r6(F.col("prob")).alias("prob"))


@register("template_weights", sql="""
WITH RECURSIVE sel AS (
  SELECT user_id % 3 AS template, ts, CAST(CASE WHEN event_type = 'error' THEN -1.0 ELSE 0.25 END AS DOUBLE) AS reward,
         row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) AS i FROM events),
fold AS (
  SELECT template, CAST(0 AS BIGINT) AS i, CAST(1.0 AS DOUBLE) AS w FROM (SELECT DISTINCT template FROM sel)
  UNION ALL
  SELECT f.template, f.i + 1, greatest(CAST(0.1 AS DOUBLE), f.w + s.reward) FROM fold f JOIN sel s ON s.template = f.template AND s.i = f.i + 1),
fin AS (SELECT template, arg_max(w, i) AS weight FROM fold GROUP BY template),
grid AS (SELECT range AS template FROM range(3))
SELECT CAST(grid.template AS INTEGER) AS template, round(coalesce(weight, 1.0), 6) AS weight,
       round(coalesce(weight, 1.0) / sum(coalesce(weight, 1.0)) OVER (), 6) AS share
FROM grid LEFT JOIN fin USING (template)
""")
def template_weights(spark, sf_dir):
    """Template weights (start 1.0, + reward, floor 0.1), normalised."""
    e = t(spark, sf_dir, "events", ["user_id", "ts", "event_type", "event_id"])
    sel = e.select((F.col("user_id") % 3).cast("int").alias("template"), "ts", "event_id",
                   F.when(F.col("event_type") == "error", -1.0).otherwise(0.25).alias("reward"))
    out = FB.template_weights(sel, 3, tie="event_id")
    return out.select("template", r6(F.col("weight")).alias("weight"), r6(F.col("share")).alias("share"))


@register("degradation_users", sql="""
WITH x AS (SELECT user_id, ts, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts) AS ra,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rd,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, CAST(max(n) AS BIGINT) AS n_rows, round(avg(bad) FILTER (WHERE ra <= 10), 6) AS old_bad_ratio,
       round(avg(bad) FILTER (WHERE rd <= 10), 6) AS recent_bad_ratio,
       (max(n) > 20 AND avg(bad) FILTER (WHERE rd <= 10) > avg(bad) FILTER (WHERE ra <= 10) * 1.5) AS degraded
FROM x GROUP BY user_id
""")
def degradation_users(spark, sf_dir):
    """Recent vs first-10 bad ratio per user, flag when 1.5x worse."""
    e = t(spark, sf_dir, "events", ["user_id", "ts", "event_type"])
    out = FB.degradation(e, "user_id", "ts", F.col("event_type") == "error")
    return out.select("user_id", F.col("n_rows").cast("bigint").alias("n_rows"), r6(F.col("old_bad_ratio")).alias("old_bad_ratio"),
                      r6(F.col("recent_bad_ratio")).alias("recent_bad_ratio"), "degraded")


def _sql_weak(x: str) -> str:
    phrases = " OR ".join(f"contains(lower({x}), {S.q(ph)})" for ph in T.GENERIC_PHRASES)
    return f"({S.strip(x)} = '' OR {phrases})"


@register("weak_answer_fallback", sql=f"""
SELECT conv_id, turn, w AS fallback,
       CASE WHEN w THEN concat([{", ".join(S.q(a) for a in SEL.APOLOGIES)}][
                CAST(floor({S.uniform_hash("concat(CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR))", 42)} * {len(SEL.APOLOGIES)}) AS INTEGER) + 1],
                {S.q(SEL.FALLBACK_TIP)})
            ELSE ans END AS final_answer
FROM (SELECT conv_id, turn, ans, {_sql_weak('ans')} AS w FROM (
        SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text ELSE concat('I''m sorry: ', text) END AS ans FROM conversations))
""")
def weak_answer_fallback(spark, sf_dir):
    """J12 apology variant (+P6): weak answers (non-assistant turns are
    prefixed with a generic apology phrase) become a drawn apology + tip."""
    c = t(spark, sf_dir, "conversations")
    ans = F.when(F.col("role") == "assistant", F.col("text")).otherwise(F.concat(F.lit("I'm sorry: "), F.col("text")))
    key = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    out = SEL.weak_answer_fallback(c.select("conv_id", "turn", ans.alias("ans"), key.alias("_k")), "ans", "_k", T.is_weak)
    return out.select("conv_id", "turn", "fallback", "final_answer")
