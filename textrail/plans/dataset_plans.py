"""Registered plans: prompts, questions and training sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import datasets as D
from ..operators import feedback as FB
from ..session import stored
from . import sqlfrag as S
from .common import register, t
from .feedback_plans import FB_SQL, _CAT_SQL, feedback_log
from .retrieval_plans import _sql_query_topk, query_hits


LOG_TS = "2024-02-01 00:00:00"   # log time of the query-log plan (a parameter)


def _hits(spark, sf_dir, k=2):
    # the documents are read once, whatever number of prompts is made of the hits
    docs = t(spark, sf_dir, "documents", ["doc_id", "text"], spread_rows=False)
    return stored(query_hits(spark, sf_dir, k).join(docs, "doc_id").select("query_id", "rank", F.col("text").alias("chunk_text")))


def _queries(spark, sf_dir):
    return t(spark, sf_dir, "benchmark", ["item_id", "text"], spread_rows=False).select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def _history(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"]).withColumnRenamed("conv_id", "query_id")


def _sql_fill(template: str, vals: dict[str, str]) -> str:
    import re
    parts = [p for p in re.split(r"(\{[a-z_]+\})", template) if p]
    out = []
    for p in parts:
        m = re.fullmatch(r"\{([a-z_]+)\}", p)
        out.append(vals[m.group(1)] if m else S.q(p))
    return "concat(" + ", ".join(out) + ")"


_CTX_SQL = f"""
WITH h AS ({_sql_query_topk(2)}),
hits AS (SELECT h.query_id, h.rank, d.text AS chunk_text FROM h JOIN documents d USING (doc_id)),
ctx AS (SELECT query_id, string_agg(chunk_text, chr(10) ORDER BY rank) AS context,
               arg_min(chunk_text, rank) AS first_chunk FROM hits GROUP BY query_id),
qs AS (SELECT item_id AS query_id, text AS question FROM benchmark),
hist0 AS (SELECT u.conv_id AS query_id, u.turn, u.text AS question, a.text AS answer FROM conversations u
          JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user'),
hist AS (SELECT query_id, string_agg(concat('Q', CAST(i AS VARCHAR), ': ', question, chr(10), 'A', CAST(i AS VARCHAR), ': ', answer, chr(10)), '' ORDER BY turn) AS history
         FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY turn) AS i FROM
                 (SELECT * FROM hist0 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY turn DESC) <= 2))
         GROUP BY query_id),
base AS (SELECT qs.query_id, qs.question, coalesce(ctx.context, '') AS context, coalesce(ctx.first_chunk, '') AS first_chunk,
                coalesce(hist.history, '') AS history
         FROM qs LEFT JOIN ctx USING (query_id) LEFT JOIN hist USING (query_id))"""

_VALS = {"context": "context", "first_chunk": "first_chunk", "question": "question", "history": "history"}


@register("prompts_history", sql=_CTX_SQL + f"""
SELECT query_id, {_sql_fill(D.PROMPT_TEMPLATES['history'], _VALS)} AS prompt FROM base
""")
def prompts_history(spark, sf_dir):
    """B1: context + last-two-turn history + question prompt per query."""
    return D.build_prompt(_hits(spark, sf_dir), _queries(spark, sf_dir), "history", history=_history(spark, sf_dir))


@register("prompt_templates", sql=_CTX_SQL + f"""
SELECT query_id,
  {_sql_fill(D.PROMPT_TEMPLATES['history_v2'], _VALS)} AS prompt_history_v2,
  {_sql_fill(D.PROMPT_TEMPLATES['strict'], _VALS)} AS prompt_strict,
  {_sql_fill(D.PROMPT_TEMPLATES['one_sentence'], _VALS)} AS prompt_one_sentence,
  {_sql_fill(D.PROMPT_TEMPLATES['short_fallback'], _VALS)} AS prompt_short_fallback,
  {_sql_fill(D.PROMPT_TEMPLATES['rag'], _VALS)} AS prompt_rag
FROM base
""")
def prompt_templates(spark, sf_dir):
    """B1 template variants: history v2, strict, one sentence, short fallback, RAG."""
    hits, qs, hist = _hits(spark, sf_dir), _queries(spark, sf_dir), _history(spark, sf_dir)
    out = None
    for name in ("history_v2", "strict", "one_sentence", "short_fallback", "rag"):
        p = D.build_prompt(hits, qs, name, history=hist if name.startswith("history") else None).withColumnRenamed(
            "prompt", f"prompt_{name}")
        out = p if out is None else out.join(p, "query_id")
    return out


@register("map_reduce_prompts", sql=f"""
WITH h AS ({_sql_query_topk(2)}),
hits AS (SELECT h.query_id, h.rank, d.text AS chunk_text FROM h JOIN documents d USING (doc_id)),
m AS (SELECT hits.*, concat(chunk_text, chr(10), chr(10), 'Question: ', b.text) AS map_prompt,
             chunk_text AS answer
      FROM hits JOIN benchmark b ON b.item_id = hits.query_id)
SELECT query_id,
  concat({S.q(D.MAP_PROMPT_HEADER)}, string_agg(map_prompt, {S.q(D.MAP_PROMPT_SEP)} ORDER BY rank)) AS mapped_prompt,
  concat({S.q(D.REDUCE_HEADER)}, string_agg(answer, chr(10) ORDER BY rank)) AS reduce_prompt
FROM m GROUP BY query_id
""")
def map_reduce_prompts(spark, sf_dir):
    """B2: per-chunk map prompts joined with ``---`` and the reduce prompt
    over per-chunk answers (the chunk itself stands in)."""
    hits, qs = _hits(spark, sf_dir), _queries(spark, sf_dir)
    mp = D.mapped_prompt(hits, qs).withColumnRenamed("prompt", "mapped_prompt")
    answers = hits.select("query_id", "rank", F.col("chunk_text").alias("answer"))
    return mp.join(D.reduce_prompts(answers), "query_id")


def _sql_question(x: str, version: int) -> str:
    c = S.clean_citations(x)
    useful = f"(length({c}) >= 30 AND len(regexp_extract_all({c}, '\\p{{Nd}}')) <= 10)"

    def subj(sep):
        s = S.strip(f"split_part({c}, {S.q(sep)}, 1)")
        return s if version == 1 else f"array_to_string({S.words(s)}[1:5], ' ')"
    parts = [f"WHEN contains({c}, {S.q(sep)}) THEN concat({S.q(head)}, {subj(sep)}, '?')" for sep, head in D.QUESTION_RULES]
    if version == 1:
        parts.append(f"WHEN contains({c}, ' refers to ') THEN concat({subj(' refers to ')}, ' refers to what?')")
        other = f"concat('Tell me something about ', {S.strip(f'substr({c}, 1, 50)')}, '...')"
    else:
        parts.append(f"WHEN contains({c}, ' refers to ') THEN concat('What does ', {subj(' refers to ')}, ' refer to?')")
        other = f"concat('What is ', array_to_string({S.words(c)}[1:5], ' '), '?')"
    return f"(CASE WHEN {useful} THEN (CASE {' '.join(parts)} ELSE {other} END) END)"


@register("template_questions", sql=f"""
SELECT conv_id, turn, {_sql_question('text', 1)} AS question_v1, {_sql_question('text', 3)} AS question_v3 FROM conversations
""")
def template_questions(spark, sf_dir):
    """Rule-based questions (v1 full subject, v3 five-word subject)."""
    c = t(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", D.template_question("text", 1).alias("question_v1"),
                    D.template_question("text", 3).alias("question_v3"))


def _sql_synth(n: int, seed: int) -> str:
    u = lambda purpose: S.uniform_hash(f"concat_ws('|', CAST(draw AS VARCHAR), '{purpose}')", seed)
    verbs = "[" + ", ".join(S.q(v) for v in D.SYNTH_VERBS) + "]"
    acc, cases = 0.0, []
    for name, wgt in D.SYNTH_GRADES:
        acc += wgt
        cases.append(f"WHEN g < {acc!r} THEN {S.q(name)}")
    grade = "CASE " + " ".join(cases) + f" ELSE {S.q(D.SYNTH_GRADES[-1][0])} END"
    return f"""
    WITH pos AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents),
    tot AS (SELECT count(*) AS n FROM documents),
    dr AS (SELECT range AS draw FROM range({n})),
    d2 AS (SELECT draw, CAST(floor({u('row')} * tot.n) AS BIGINT) AS p, CAST(floor({u('verb')} * {len(D.SYNTH_VERBS)}) AS INTEGER) AS v,
                  {u('grade')} AS g FROM dr CROSS JOIN tot),
    pk AS (SELECT d2.*, pos.doc_id, {S.words('pos.text')} AS w FROM d2 JOIN pos USING (p)),
    ee AS (SELECT *, concat(upper(substr(w[1], 1, 1)), lower(substr(w[1], 2))) AS e, {grade} AS feedback FROM pk WHERE len(w) >= 10)
    SELECT draw, concat('What ', {verbs}[v + 1], ' ', e, ' do?') AS query,
      CASE feedback WHEN 'good' THEN concat(array_to_string(w[1:30], ' '), '...')
                    WHEN 'partially correct' THEN concat(array_to_string(w[1:15], ' '), ' [some details missing]...')
                    WHEN 'incorrect' THEN 'This chunk refers to something else entirely.'
                    ELSE concat(e, ' was a spaceship pilot in World War II.') END AS answer,
      CAST(doc_id AS VARCHAR) AS source, feedback FROM ee"""


@register("synthetic_feedback", sql=_sql_synth(200, 42))
def synthetic_feedback(spark, sf_dir):
    """200 seeded draws with replacement over the documents."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    n_rows = t(spark, sf_dir, "documents", ["doc_id"], spread_rows=False).count()
    return D.synthetic_feedback(d, "doc_id", "text", n=200, seed=42, n_rows=n_rows)


def _sql_synth_templates() -> str:
    rows = []
    for cat, pairs in D.SYNTH_TEMPLATES.items():
        concepts = D.SYNTH_CONCEPTS_TECHNICAL if cat == "technical" else D.SYNTH_CONCEPTS_OTHER
        for q_, a_ in pairs:
            for c in concepts:
                fill = {k: c for k in ("concept", "issue", "topic", "system")}
                rows.append(f"({S.q(cat)}, {S.q(q_.format(**fill))}, {S.q(a_.format(**fill))})")
    return "(VALUES " + ", ".join(rows) + ") AS tpl(cat, query, answer)"


@register("adaptive_training_set", sql=f"""
WITH pc AS (SELECT category FROM {_CAT_SQL} WHERE total > 0 AND bad / total > 0.18)
SELECT tpl.query, tpl.answer, CAST(1.0 AS DOUBLE) AS reward, concat('synthetic_', pc.category) AS category
FROM pc JOIN {_sql_synth_templates()} ON tpl.cat = pc.category
UNION ALL
SELECT query, answer, CAST(CASE WHEN lower({S.strip('feedback')}) = 'good' THEN 1.0 ELSE 0.0 END AS DOUBLE), 'real_feedback' FROM {FB_SQL}
""")
def adaptive_training_set(spark, sf_dir):
    """B5 + B11 (+A6, T23): synthetic template data for problem categories
    unioned with the real feedback and its reward."""
    fb = feedback_log(spark, sf_dir)
    problems = FB.problem_categories(fb, limit=0.18)
    synth = D.synthetic_templates(problems)
    real = fb.select("query", "answer", T.map_label("feedback", "good_float").alias("reward"),
                     F.lit("real_feedback").alias("category"))
    return D.union_datasets(synth, real)


@register("instruction_texts", sql=f"""
SELECT conv_id, turn, concat({S.q(D.INSTRUCTION[0])}, text, {S.q(D.INSTRUCTION[1])}) AS text FROM conversations
""")
def instruction_texts(spark, sf_dir):
    """Summarisation instruction text for every turn."""
    c = t(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", D.instruction_text("text").alias("text"))


@register("encode_turns", sql=f"""
WITH toks AS (SELECT conv_id, turn, {S.words('text')} AS w FROM conversations),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY token) + 1 AS INTEGER) AS token_id
          FROM (SELECT DISTINCT unnest(w) AS token FROM toks)),
ex AS (SELECT conv_id, turn, unnest(w[1:128]) AS token, generate_subscripts(w[1:128], 1) AS pos FROM toks),
ids AS (SELECT conv_id, turn, list(coalesce(v.token_id, 1) ORDER BY pos) AS arr FROM ex LEFT JOIN vocab v USING (token) GROUP BY ALL),
b AS (SELECT t.conv_id, t.turn, coalesce(ids.arr, CAST([] AS INTEGER[])) AS arr FROM toks t LEFT JOIN ids USING (conv_id, turn))
SELECT conv_id, turn, array_to_string(list_concat(arr, list_transform(range(128 - len(arr)), lambda x: 0)), ' ') AS input_ids,
       array_to_string(list_concat(list_transform(range(len(arr)), lambda x: 1), list_transform(range(128 - len(arr)), lambda x: 0)), ' ') AS attention_mask,
       array_to_string(list_concat(arr, list_transform(range(128 - len(arr)), lambda x: 0)), ' ') AS labels
FROM b
""")
def encode_turns(spark, sf_dir):
    """Vocabulary ids, truncation/padding to 128, mask, labels."""
    c = t(spark, sf_dir, "conversations")
    keyed = c.select(F.struct("conv_id", "turn").alias("rid"), "text")
    vocab = D.build_vocab(keyed, "text")
    enc = D.encode(keyed, "rid", "text", vocab, max_len=128)
    # arrays rendered as space-joined ids for the comparison with SQL
    as_text = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return enc.select("rid.conv_id", "rid.turn", *as_text)


@register("pack_blocks", sql=f"""
WITH toks AS (SELECT doc_id, {S.words('text')} AS w FROM documents),
off AS (SELECT doc_id, w, coalesce(sum(len(w)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM toks),
ex AS (SELECT o + generate_subscripts(w, 1) - 1 AS gpos, unnest(w) AS tok FROM off),
bl AS (SELECT CAST(floor(gpos / 128) AS BIGINT) AS block_no, list(tok ORDER BY gpos) AS tokens FROM ex GROUP BY 1)
SELECT block_no, array_to_string(tokens, ' ') AS tokens FROM bl WHERE len(tokens) = 128
""")
def pack_blocks(spark, sf_dir):
    """All document token streams packed into 128-token blocks."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    blocks = D.pack(d.select("doc_id", T.words("text").alias("toks")), "doc_id", "toks", 128)
    return blocks.select("block_no", F.array_join("tokens", " ").alias("tokens"))  # tokens hold no spaces


@register("prompt_variants", sql=_CTX_SQL + f"""
SELECT query_id, v.variant, concat(v.tpl, chr(10), chr(10), {_sql_fill(D.PROMPT_TEMPLATES['strict'], _VALS)}) AS variant_prompt
FROM base CROSS JOIN (VALUES {", ".join(f"({i}, {S.q(x)})" for i, x in enumerate(D.VARIANT_TEMPLATES))}) AS v(variant, tpl)
""")
def prompt_variants(spark, sf_dir):
    """Each strict prompt under the three instruction templates."""
    p = D.build_prompt(_hits(spark, sf_dir), _queries(spark, sf_dir), "strict")
    return D.prompt_variants(p).select("query_id", "variant", "variant_prompt")


@register("query_log", sql=f"""
WITH h AS ({_sql_query_topk(2)}),
hits AS (SELECT h.query_id, h.rank, d.text AS chunk_text FROM h JOIN documents d USING (doc_id)),
rc AS (SELECT query_id, list(chunk_text ORDER BY rank) AS retrieved_chunks FROM hits GROUP BY query_id)
SELECT b.item_id AS query_id, b.text AS query, array_to_string(rc.retrieved_chunks, chr(30)) AS retrieved_chunks,
       CASE WHEN rc.retrieved_chunks IS NULL THEN 'I''m sorry, I could not find an answer.'
            ELSE rc.retrieved_chunks[1] END AS answer,
       CASE WHEN rc.retrieved_chunks IS NULL THEN 'fallback' ELSE 'extractive' END AS model_used,
       TIMESTAMP '{LOG_TS}' AS timestamp, CAST(NULL AS VARCHAR) AS user_feedback
FROM benchmark b LEFT JOIN rc ON rc.query_id = b.item_id
""")
def query_log(spark, sf_dir):
    """B9 (+J12): one log record per query with its retrieved chunks, an
    extractive answer (the best chunk) or the fallback."""
    hits = _hits(spark, sf_dir)
    qs = t(spark, sf_dir, "benchmark", ["item_id", "text"], spread_rows=False).select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    first = hits.where(F.col("rank") == 1).select("query_id", F.col("chunk_text").alias("a1"))
    answers = (qs.select("query_id").join(first, "query_id", "left")
               .withColumn("answer", F.coalesce("a1", F.lit("I'm sorry, I could not find an answer.")))
               .withColumn("model_used", F.when(F.col("a1").isNull(), F.lit("fallback")).otherwise(F.lit("extractive")))
               .drop("a1"))
    log = D.query_log(qs, hits, answers, ts=F.lit(LOG_TS).cast("timestamp_ntz"))
    # chunk list rendered with a record separator for the comparison with SQL
    return log.withColumn("retrieved_chunks", F.array_join("retrieved_chunks", "\x1e"))
