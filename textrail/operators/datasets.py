"""Prompt, question and training-set construction (B1-B11, plus the
query log).  All table -> table; per-query gathers are bounded by the
retrieved ``k`` rows or the last ``n`` history turns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_citations, is_useful, strip, uniform_hash, words
from .offsets import global_offsets

# --- fixed values ----------------------------------------------------------
PROMPT_TEMPLATES = {
    "history": ("You are a helpful assistant. Use the context below to answer.\n\n"
                "{history}\n### Context ###\n{context}\n\n### Question ###\n{question}\n\n### Answer ###\n"),
    "history_v2": ("You are a helpful assistant. Answer the user's question using the provided context.\n\n"
                   "### Prior Conversation ###\n{history}### Context from Documents ###\n{context}\n\n"
                   "### Question ###\n{question}\n\n### Answer ###\n"),
    "strict": ("You are a helpful assistant. Only use the context below to answer the user's question clearly "
               "and concisely.\n\nContext:\n{context}\n\nQuestion: {question}\nAnswer:"),
    "one_sentence": ("Use the information below to answer the question in one complete sentence.\n\n"
                     "### Context ###\n{context}\n\n### Question ###\n{question}\n\n### Answer ###"),
    "short_fallback": "Use the following context to answer the question briefly.\n\nContext: {first_chunk}\n\nQuestion: {question}\n\nAnswer:",
    "rag": "Context:\n{context}\n\nUser Question:\n{question}\n\nAnswer:",
}
MAP_PROMPT_HEADER = "Answer the question below using the provided context. Think step by step and explain your reasoning.\n\n"
MAP_PROMPT_SEP = "\n\n---\n\n"
REDUCE_HEADER = "Summarize the following answers. Think step by step and explain your answer:\n\n"
INSTRUCTION = ("<|user|> Summarize the following:\n", " <|assistant|>")
VARIANT_TEMPLATES = (
    "Template 1: Provide a concise answer without long paragraphs.",
    "Template 2: Provide a detailed answer with examples.",
    "Template 3: Provide a simple and direct answer.",
)
QUESTION_RULES = ((" is ", "What is "), (" was ", "Who was "), (" are ", "What are "))
SYNTH_VERBS = ("is", "was", "did", "worked as", "appeared in")
SYNTH_GRADES = (("good", 0.5), ("partially correct", 0.2), ("incorrect", 0.2), ("hallucinated", 0.1))
SYNTH_TEMPLATES = {
    "technical": (("¿Cómo implementar {concept}?", "Aquí tienes una implementación clara de {concept}..."),
                  ("Explica {concept} paso a paso", "Te explico {concept} de manera estructurada..."),
                  ("¿Qué error puede causar {issue}?", "Este error suele ocurrir cuando...")),
    "creative": (("Escribe una historia sobre {topic}", "Había una vez..."),
                 ("Crea un poema sobre {topic}", "En versos fluidos..."),
                 ("Imagina un diálogo sobre {topic}", "- Personaje 1: ...")),
    "informational": (("¿Qué es {concept}?", "{concept} es..."),
                      ("¿Cómo funciona {system}?", "{system} funciona mediante..."),
                      ("¿Cuáles son los beneficios de {topic}?", "Los principales beneficios son...")),
}
SYNTH_CONCEPTS_TECHNICAL = ("algoritmo", "función", "clase", "variable")
SYNTH_CONCEPTS_OTHER = ("naturaleza", "aventura", "amistad")
PAD_ID, UNK_ID = 0, 1
# ---------------------------------------------------------------------------


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders of a literal template with columns."""
    parts = re.split(r"(\{[a-z_]+\})", template)
    cols = []
    for p in parts:
        if not p:
            continue
        m = re.fullmatch(r"\{([a-z_]+)\}", p)
        cols.append(values[m.group(1)] if m else F.lit(p))
    return F.concat(*cols)


def gather_context(hits: DataFrame, key: str = "query_id", rank: str = "rank", text: str = "chunk_text",
                   sep: str = "\n") -> DataFrame:
    """Context text per query: hit texts in rank order joined by ``sep``
    (gathers at most the ``k`` retrieved rows of each query)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(text).alias("t"))))
    return hits.groupBy(key).agg(F.array_join(F.transform(ordered, lambda s: s["t"]), sep).alias("context"),
                                 F.try_element_at(F.transform(ordered, lambda s: s["t"]), F.lit(1)).alias("first_chunk"))


def history_text(history: DataFrame, key: str = "query_id", order: str = "turn", q: str = "question",
                 a: str = "answer", last: int = 2) -> DataFrame:
    """``Q1: ..\\nA1: ..\\n`` for the last ``last`` exchanges per key."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    lastn = history.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= last)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(q).alias("q"), F.col(a).alias("a"))))
    return lastn.groupBy(key).agg(ordered.alias("_h")).select(
        key, F.array_join(F.transform("_h", lambda s, i: F.concat(
            F.lit("Q"), (i + 1).cast("string"), F.lit(": "), s["q"], F.lit("\nA"), (i + 1).cast("string"),
            F.lit(": "), s["a"], F.lit("\n"))), "").alias("history"))


def build_prompt(hits: DataFrame, queries: DataFrame, template: str = "history", key: str = "query_id",
                 question: str = "question", history: DataFrame | None = None, **hit_cols) -> DataFrame:
    """B1: one prompt per query from its ranked context rows, optional
    history and the question, with one of :data:`PROMPT_TEMPLATES`."""
    ctx = gather_context(hits, key, **hit_cols)
    out = queries.select(key, question).join(ctx, key, "left")
    if history is not None:
        out = out.join(history_text(history, key), key, "left")
    else:
        out = out.withColumn("history", F.lit(""))
    vals = {"context": F.coalesce("context", F.lit("")), "first_chunk": F.coalesce("first_chunk", F.lit("")),
            "question": F.col(question), "history": F.coalesce("history", F.lit(""))}
    return out.select(key, _fill(PROMPT_TEMPLATES[template], vals).alias("prompt"))


def map_prompts(hits: DataFrame, queries: DataFrame, key: str = "query_id", question: str = "question",
                text: str = "chunk_text") -> DataFrame:
    """B2 map step: ``<chunk>\\n\\nQuestion: <query>`` per retrieved row."""
    return hits.join(queries.select(key, question), key).withColumn(
        "map_prompt", F.concat(F.col(text), F.lit("\n\nQuestion: "), F.col(question)))


def reduce_prompts(answers: DataFrame, key: str = "query_id", rank: str = "rank", answer: str = "answer") -> DataFrame:
    """B2 reduce step: one prompt from the per-chunk answers (rank order)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.coalesce(F.col(answer), F.lit("")).alias("a"))))
    return answers.groupBy(key).agg(
        F.concat(F.lit(REDUCE_HEADER), F.array_join(F.transform(ordered, lambda s: s["a"]), "\n")).alias("reduce_prompt"))


def mapped_prompt(hits: DataFrame, queries: DataFrame, key: str = "query_id", question: str = "question",
                  rank: str = "rank", text: str = "chunk_text") -> DataFrame:
    """B1 ``---`` variant: every chunk followed by the question, joined."""
    m = map_prompts(hits, queries, key, question, text)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col("map_prompt").alias("p"))))
    return m.groupBy(key).agg(F.concat(F.lit(MAP_PROMPT_HEADER),
                                       F.array_join(F.transform(ordered, lambda s: s["p"]), MAP_PROMPT_SEP)).alias("prompt"))


def template_question(c: Column | str, version: int = 1) -> Column:
    """Rule-based question from a text (after citation cleaning and the
    usefulness gate v1; null when not useful).

    v1: full subject before `` is ``/`` was ``/`` are ``, ``... refers to
    what?``, else ``Tell me something about <first 50 chars>...``.
    v3: subject cut to its first five words; ``What does .. refer to?``;
    else ``What is <first five words>?``.
    """
    t = clean_citations(c)

    def subj(sep: str) -> Column:
        s = strip(F.substring_index(t, sep, 1))
        if version == 1:
            return s
        return F.array_join(F.slice(words(s), 1, 5), " ")

    expr = None
    for sep, head in QUESTION_RULES:
        cond = t.contains(sep)
        val = F.concat(F.lit(head), subj(sep), F.lit("?"))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    if version == 1:
        expr = expr.when(t.contains(" refers to "), F.concat(subj(" refers to "), F.lit(" refers to what?")))
        expr = expr.otherwise(F.concat(F.lit("Tell me something about "), strip(F.substring(t, 1, 50)), F.lit("...")))
    else:
        expr = expr.when(t.contains(" refers to "), F.concat(F.lit("What does "), subj(" refers to "), F.lit(" refer to?")))
        expr = expr.otherwise(F.concat(F.lit("What is "), F.array_join(F.slice(words(t), 1, 5), " "), F.lit("?")))
    return F.when(is_useful(t, 1), expr)


def instruction_text(c: Column | str) -> Column:
    """``<|user|> Summarize the following:\\n<text> <|assistant|>``."""
    x = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(INSTRUCTION[0]), x, F.lit(INSTRUCTION[1]))


def prompt_variants(prompts: DataFrame, prompt_col: str = "prompt", templates=VARIANT_TEMPLATES) -> DataFrame:
    """Every prompt x instruction template (variant number kept); the
    templates are a literal array exploded per row (no join)."""
    arr = F.array(*[F.struct(F.lit(i).alias("variant"), F.lit(tx).alias("tpl")) for i, tx in enumerate(templates)])
    return (prompts.select("*", F.explode(arr).alias("_v"))
            .select(*prompts.columns, F.col("_v.variant").alias("variant"),
                    F.concat(F.col("_v.tpl"), F.lit("\n\n"), F.col(prompt_col)).alias("variant_prompt")))


def synthetic_feedback(chunks: DataFrame, id_col: str, text_col: str, n: int = 200, seed: int = 42,
                       n_rows: int | None = None) -> DataFrame:
    """``n`` draws with replacement from the chunk table; entity =
    capitalised first word, a question verb, a grade drawn with weights
    .5/.2/.2/.1 and an answer built for the grade; texts under 10 words
    are skipped.  Draws are md5-uniforms of ``(seed, draw, purpose)`` so
    the result is reproducible; rows are found by global position."""
    spark = chunks.sparkSession
    counts = chunks.select(id_col, F.lit(1).alias("_one"))
    pos = global_offsets(counts, id_col, "_one", "_pos").drop("_one")
    total = n_rows if n_rows is not None else chunks.count()
    draws = spark.range(n).select(F.col("id").alias("draw"))
    u_row = uniform_hash(F.col("draw"), F.lit("row"), seed=seed)
    u_verb = uniform_hash(F.col("draw"), F.lit("verb"), seed=seed)
    u_grade = uniform_hash(F.col("draw"), F.lit("grade"), seed=seed)
    draws = draws.select("draw", F.floor(u_row * total).cast("bigint").alias("_pos"),
                         F.floor(u_verb * len(SYNTH_VERBS)).cast("int").alias("_verb"), u_grade.alias("_g"))
    from ..session import compute_once
    picked = compute_once(draws.join(pos, "_pos").join(chunks.select(id_col, text_col), id_col), "_words",
                          words(F.col(text_col)))
    w = F.col("_words")
    first = F.try_element_at(w, F.lit(1))
    entity = F.concat(F.upper(F.substring(first, 1, 1)), F.lower(F.substring(first, 2, 1 << 30)))
    verb = F.element_at(F.array(*[F.lit(v) for v in SYNTH_VERBS]), F.col("_verb") + 1)
    grade = None
    acc = 0.0
    for name, wgt in SYNTH_GRADES:
        acc += wgt
        cond = F.col("_g") < F.lit(acc)
        grade = F.when(cond, F.lit(name)) if grade is None else grade.when(cond, F.lit(name))
    grade = grade.otherwise(F.lit(SYNTH_GRADES[-1][0]))
    g = picked.select("draw", id_col, w.alias("_w"), entity.alias("_e"), verb.alias("_verb_s"), grade.alias("feedback"))
    answer = (F.when(F.col("feedback") == "good", F.concat(F.array_join(F.slice("_w", 1, 30), " "), F.lit("...")))
              .when(F.col("feedback") == "partially correct",
                    F.concat(F.array_join(F.slice("_w", 1, 15), " "), F.lit(" [some details missing]...")))
              .when(F.col("feedback") == "incorrect", F.lit("This chunk refers to something else entirely."))
              .otherwise(F.concat(F.col("_e"), F.lit(" was a spaceship pilot in World War II."))))
    return (g.where(F.size("_w") >= 10)
            .select("draw", F.concat(F.lit("What "), F.col("_verb_s"), F.lit(" "), F.col("_e"), F.lit(" do?")).alias("query"),
                    answer.alias("answer"), F.col(id_col).cast("string").alias("source"), "feedback"))


def synthetic_templates(categories: DataFrame, category_col: str = "category") -> DataFrame:
    """Template question/answer pairs x concepts for the given
    (problem) categories; every placeholder is filled with the concept."""
    rows = []
    for cat, pairs in SYNTH_TEMPLATES.items():
        concepts = SYNTH_CONCEPTS_TECHNICAL if cat == "technical" else SYNTH_CONCEPTS_OTHER
        for q, a in pairs:
            for c in concepts:
                fill = {k: c for k in ("concept", "issue", "topic", "system")}
                rows.append(F.struct(F.lit(cat).alias("cat"), F.lit(q.format(**fill)).alias("query"),
                                     F.lit(a.format(**fill)).alias("answer")))
    table = F.array(*rows)  # fixed 57-row template table, exploded per category row
    return (categories.select(category_col).distinct()
            .select(category_col, F.explode(table).alias("_t"))
            .where(F.col("_t.cat") == F.col(category_col))
            .select(F.col("_t.query").alias("query"), F.col("_t.answer").alias("answer"), F.lit(1.0).alias("reward"),
                    F.concat(F.lit("synthetic_"), F.col(category_col)).alias("category")))


def build_vocab(texts: DataFrame, text_col: str) -> DataFrame:
    """B7 vocabulary: distinct white-space tokens numbered in token order
    from 2 (0 = padding, 1 = unknown), with distributed running numbers."""
    toks = texts.select(F.explode_outer(words(F.col(text_col))).alias("token")).where(F.col("token").isNotNull()).distinct()
    return (global_offsets(toks.select("token", F.lit(1).alias("_one")), "token", "_one", "_off")
            .select("token", (F.col("_off") + 2).cast("int").alias("token_id")))


def encode(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame, max_len: int = 128) -> DataFrame:
    """Token ids truncated/padded to ``max_len``, attention mask and a
    copy as labels.  Tokens are joined to the vocabulary (a shuffle join;
    the planner broadcasts a small vocabulary) and gathered back per row
    (bounded by ``max_len``)."""
    ex = (df.select(id_col, F.posexplode_outer(F.slice(words(F.col(text_col)), 1, max_len)).alias("pos", "token"))
          .where(F.col("pos").isNotNull()))
    ids = ex.join(vocab, "token", "left").select(id_col, "pos", F.coalesce("token_id", F.lit(UNK_ID)).alias("tid"))
    gathered = ids.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "tid"))).alias("_s"))
    base = df.select(id_col).join(gathered, id_col, "left")
    arr = F.coalesce(F.transform("_s", lambda s: s["tid"]), F.array().cast("array<int>"))
    pad = F.lit(max_len) - F.size(arr)
    return base.select(id_col, F.concat(arr, F.array_repeat(F.lit(PAD_ID), pad)).alias("input_ids"),
                       F.concat(F.array_repeat(F.lit(1), F.size(arr)), F.array_repeat(F.lit(0), pad)).alias("attention_mask")
                       ).withColumn("labels", F.col("input_ids"))


def pack(df: DataFrame, id_col: str, tokens_col: str, block: int = 128) -> DataFrame:
    """Concatenate all token streams (in ``id_col`` order) and cut into
    blocks of ``block`` tokens; the incomplete tail block is dropped.

    Stream offsets come from :func:`global_offsets`; each token gets its
    global position and blocks are gathered by ``floor(pos / block)``, so a
    block (bounded size) is the largest unit that meets in one task."""
    lens = df.select(id_col, F.size(tokens_col).alias("_n"))
    offs = global_offsets(lens, id_col, "_n", "_off").drop("_n")
    ex = (df.join(offs, id_col).select(F.posexplode_outer(tokens_col).alias("i", "tok"), "_off").where(F.col("i").isNotNull())
          .select((F.col("_off") + F.col("i")).alias("gpos"), "tok"))
    blocks = (ex.withColumn("block_no", F.floor(F.col("gpos") / block))
              .groupBy("block_no").agg(F.array_sort(F.collect_list(F.struct("gpos", "tok"))).alias("_s"))
              .select("block_no", F.transform("_s", lambda s: s["tok"]).alias("tokens")))
    return blocks.where(F.size("tokens") == block)


def query_log(queries: DataFrame, hits: DataFrame, answers: DataFrame, prompts: DataFrame | None = None,
              key: str = "query_id", ts: Column | None = None) -> DataFrame:
    """One record per query: time, query, retrieved chunk texts (rank
    order), prompt (when given), answer, model used, feedback (null)."""
    chunks = hits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_text"))).alias("_c")).select(
        key, F.transform("_c", lambda s: s["chunk_text"]).alias("retrieved_chunks"))
    out = queries.join(chunks, key, "left")
    if prompts is not None:
        out = out.join(prompts, key, "left")
    out = out.join(answers, key, "left")
    return out.withColumn("timestamp", ts if ts is not None else F.current_timestamp()).withColumn(
        "user_feedback", F.lit(None).cast("string"))


def union_datasets(*dfs: DataFrame) -> DataFrame:
    """Old + new rows by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
