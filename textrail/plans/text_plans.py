"""Registered plans: scalar text rules (T*) and predicates (P*).

Inputs are the driver tables; where a rule needs markers the driver text
lacks (URLs, citations, list syntax ...), the same literal is injected by
``concat`` in the plan and in its SQL twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..session import compute_once
from . import sqlfrag as S
from .common import r6, register, t

# ------------------------------------------------------------------ T3 / T4


def _wiki_src_spark():
    return F.concat(F.col("text"), F.lit(" etc. , con ••• y . fin Editar esta página"))


_WIKI_SRC_SQL = "concat(text, ' etc. , con ••• y . fin Editar esta página')"


@register("clean_wiki_revert", sql=f"""
SELECT doc_id, kept AS clean_text, CAST(length(kept) AS BIGINT) AS length_after,
       (kept = src) AS reverted
FROM (SELECT doc_id, src, {S.clean_or_revert('src', S.clean_wiki('src'))} AS kept
      FROM (SELECT doc_id, {_WIKI_SRC_SQL} AS src FROM documents))
""")
def clean_wiki_revert(spark, sf_dir):
    """T3 + T4: wiki rule set, reverted when it removes over 10 %."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", _wiki_src_spark().alias("src"))
    d = compute_once(d, "clean", T.clean_wiki("src"))
    kept = T.clean_or_revert(F.col("src"), F.col("clean"))
    return d.select("doc_id", kept.alias("clean_text"), F.length(kept).cast("bigint").alias("length_after"),
                    (kept == F.col("src")).alias("reverted"))


# ------------------------------------------------------------------ T5


def _emb_src_spark():
    return F.concat(F.lit("Menu junk From Wikipedia, the free encyclopedia "), F.col("text"),
                    F.lit(" [12] [edit] {cite} mail me@example.com http://x.example.org/a This page was last edited today"))


_EMB_SRC_SQL = ("concat('Menu junk From Wikipedia, the free encyclopedia ', text, "
                "' [12] [edit] {cite} mail me@example.com http://x.example.org/a This page was last edited today')")


@register("clean_for_embedding_docs", sql=f"""
SELECT doc_id, {S.clean_for_embedding(_EMB_SRC_SQL)} AS embed_text FROM documents
""")
def clean_for_embedding_docs(spark, sf_dir):
    """T5: text prepared for embedding (sentences > 20 chars)."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", T.clean_for_embedding(_emb_src_spark()).alias("embed_text"))


# ------------------------------------------------------------------ T6 / T7


@register("clean_ascii_docs", sql=f"SELECT doc_id, {S.clean_ascii('text')} AS ascii_text FROM documents")
def clean_ascii_docs(spark, sf_dir):
    """Strip, collapse, drop non-ASCII."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", T.clean_ascii("text").alias("ascii_text"))


_CIT_SQL = "concat(text, ' Retrieved 8 October 2015. See October 8, 2015 and 3 May 2001 [3] end')"


@register("clean_citations_docs", sql=f"SELECT doc_id, {S.clean_citations(_CIT_SQL)} AS clean_text FROM documents")
def clean_citations_docs(spark, sf_dir):
    """Retrieval notes, dates and bracket references removed."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    src = F.concat(F.col("text"), F.lit(" Retrieved 8 October 2015. See October 8, 2015 and 3 May 2001 [3] end"))
    return d.select("doc_id", T.clean_citations(src).alias("clean_text"))


# ------------------------------------------------------------------ T8 / T9


@register("unlist_turns", sql="""
SELECT conv_id, turn,
  CASE WHEN starts_with(src, '[') AND ends_with(src, ']')
       THEN replace(regexp_replace(CASE WHEN length(src) >= 2 THEN substr(src, 2, length(src) - 2) ELSE '' END, '[''"]', '', 'g'), ',', ' ')
       ELSE src END AS flat_text
FROM (SELECT conv_id, turn,
        CASE WHEN role = 'user' THEN concat('[''', replace(text, ' ', ''', '''), ''']') ELSE text END AS src
      FROM conversations)
""")
def unlist_turns(spark, sf_dir):
    """Printed lists (user turns rendered as ``['a', 'b']``) flattened."""
    c = t(spark, sf_dir, "conversations")
    src = F.when(F.col("role") == "user",
                 F.concat(F.lit("['"), F.replace(F.col("text"), F.lit(" "), F.lit("', '")), F.lit("']"))).otherwise(F.col("text"))
    return c.select("conv_id", "turn", T.unlist(src).alias("flat_text"))


_CORR_SQL_SRC = "concat(text, ' Wixxrepia Creale x Donale Adicle Viewhistory WIKPDIA Wilkipedia')"


def _sql_corrections(x: str, regex: bool) -> str:
    col = x
    if not regex:
        for wrong, right in T.OCR_CORRECTIONS.items():
            col = f"replace({col}, {S.q(wrong)}, {S.q(right)})"
        return col
    for pat, right in T.OCR_CORRECTION_PATTERNS.items():
        core = pat.replace(r"\b", "")
        col = S.rx(col, r"(^|[^\pL\pN_])(?i:" + core + r")([^\pL\pN_]|$)", r"\1" + right + r"\2")
    return col


@register("ocr_corrections", sql=f"""
SELECT doc_id, {_sql_corrections(_CORR_SQL_SRC, False)} AS fixed_literal,
       {_sql_corrections(_CORR_SQL_SRC, True)} AS fixed_regex FROM documents
""")
def ocr_corrections(spark, sf_dir):
    """Literal and case-insensitive pattern OCR corrections."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    src = F.concat(F.col("text"), F.lit(" Wixxrepia Creale x Donale Adicle Viewhistory WIKPDIA Wilkipedia"))
    return d.select("doc_id", T.apply_corrections(src).alias("fixed_literal"),
                    T.apply_corrections(src, regex=True).alias("fixed_regex"))


# ------------------------------------------------------------------ T10 / T11 / T12


@register("keep_text_lines_docs", sql=f"""
SELECT doc_id, CASE WHEN len({S.words('j')}) >= 6 THEN j END AS ocr_text FROM (
  SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda s: {S.strip('s')}),
                                             lambda s: length(s) >= 3), ' ') AS j FROM documents)
""")
def keep_text_lines_docs(spark, sf_dir):
    """Lines longer than 2 chars joined; null below 6 words."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", T.keep_text_lines("text").alias("ocr_text"))


def _ocr_raw_spark():
    return F.concat(F.lit("[Source image: "), F.col("doc_id").cast("string"), F.lit(".png]\n\n"),
                    F.replace(F.col("text"), F.lit("\n"), F.lit(" (Confidence: 0.95)\n")),
                    F.lit(" (Confidence: 0.88)\n"),
                    F.when(F.col("lang") == "fr", F.lit("[NO TEXT DETECTED]")).otherwise(F.lit("")))


_OCR_RAW_SQL = ("concat('[Source image: ', CAST(doc_id AS VARCHAR), '.png]', chr(10), chr(10), "
                "replace(text, chr(10), ' (Confidence: 0.95)' || chr(10)), ' (Confidence: 0.88)', chr(10), "
                "CASE WHEN lang = 'fr' THEN '[NO TEXT DETECTED]' ELSE '' END)")


@register("parse_ocr_lines_docs", sql=f"""
WITH raw AS (SELECT doc_id, {_OCR_RAW_SQL} AS raw FROM documents),
lines AS (SELECT doc_id, regexp_extract(raw, '^\\[Source image: ([^\\]]*)\\]', 1) AS source_image,
                 unnest(string_split(raw, chr(10))) AS line, generate_subscripts(string_split(raw, chr(10)), 1) - 1 AS line_no
          FROM raw)
SELECT doc_id, nullif(source_image, '') AS source_image, CAST(line_no AS BIGINT) AS line_no,
       CASE WHEN regexp_matches(line, ' \\(Confidence: [0-9.]+\\)$') THEN regexp_extract(line, '^(.*) \\(Confidence: [0-9.]+\\)$', 1)
            ELSE NULL END AS text,
       TRY_CAST(nullif(regexp_extract(line, ' \\(Confidence: ([0-9.]+)\\)$', 1), '') AS DOUBLE) AS confidence,
       CASE WHEN line LIKE '[NO TEXT DETECTED]%' THEN 'no_text'
            WHEN line LIKE '[ERROR%' THEN 'error' ELSE 'ok' END AS status
FROM lines
WHERE line <> '' AND NOT starts_with(line, '[Source image:')
""")
def parse_ocr_lines_docs(spark, sf_dir):
    """OCR output lines parsed back to (image, text, confidence, status)."""
    from ..sources.ocr import parse_ocr_lines
    d = t(spark, sf_dir, "documents", ["doc_id", "text", "lang"]).select("doc_id", _ocr_raw_spark().alias("raw"))
    return parse_ocr_lines(d, "doc_id", "raw")


@register("split_paths", sql="""
SELECT conv_id, turn, regexp_extract(path, '(.+?)_\\d+\\.jpg', 1) AS group_id,
       CAST(regexp_extract(path, '_(\\d+)\\.jpg', 1) AS BIGINT) AS fragment_order
FROM (SELECT conv_id, turn, concat('scan', CAST(conv_id AS VARCHAR), '_', CAST(turn AS VARCHAR), '.jpg') AS path FROM conversations)
""")
def split_paths(spark, sf_dir):
    """``<group>_<n>.jpg`` -> group id and fragment order."""
    c = t(spark, sf_dir, "conversations", ["conv_id", "turn"])
    path = F.concat(F.lit("scan"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"), F.lit(".jpg"))
    gid, order = T.split_path(path)
    return c.select("conv_id", "turn", gid.alias("group_id"), order.alias("fragment_order"))


# ------------------------------------------------------------------ T13 / T14 / T15


@register("text_stats_docs", sql=f"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(len({S.words('text')}) AS BIGINT) AS n_words,
       concat(CAST(doc_id AS VARCHAR), '_', lang) AS doc_key FROM documents
""")
def text_stats_docs(spark, sf_dir):
    """T13 + T14: length, word count, composite id."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return d.select("doc_id", T.text_length("text").alias("n_chars"), T.word_count("text").alias("n_words"),
                    T.composite_id("doc_id", "lang").alias("doc_key"))


@register("cache_keys", sql="""
SELECT conv_id, turn, concat(text, '_', CASE WHEN role = 'user' AND text <> '' THEN substr(md5(text), 1, 8) ELSE 'noocr' END) AS cache_key
FROM conversations
""")
def cache_keys(spark, sf_dir):
    """``query_<md5 prefix of extra text>`` or ``query_noocr``."""
    c = t(spark, sf_dir, "conversations")
    extra = F.when(F.col("role") == "user", F.col("text"))
    return c.select("conv_id", "turn", T.cache_key(F.col("text"), extra).alias("cache_key"))


# ------------------------------------------------------------------ T16-T19


_QA_SQL = "concat('Question: ', text, chr(10), 'Answer: ', replace(text, '.', '.' || chr(10)), chr(10), 'Answer: fin')"


@register("answer_extract", sql=f"""
SELECT conv_id, turn, {S.after_marker('src', 'Answer:')} AS answer, {S.after_marker('src', 'Question:')} AS question
FROM (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN {_QA_SQL} ELSE text END AS src FROM conversations)
""")
def answer_extract(spark, sf_dir):
    """T16 + T17: text after the last ``Answer:`` / ``Question:`` marker."""
    c = t(spark, sf_dir, "conversations")
    qa = F.concat(F.lit("Question: "), F.col("text"), F.lit("\nAnswer: "),
                  F.replace(F.col("text"), F.lit("."), F.lit(".\n")), F.lit("\nAnswer: fin"))
    src = F.when(F.col("role") == "assistant", qa).otherwise(F.col("text"))
    return c.select("conv_id", "turn", T.after_marker(src, "Answer:").alias("answer"),
                    T.after_marker(src, "Question:").alias("question"))


@register("summaries_docs", sql=f"""
SELECT doc_id, CASE WHEN ends_with(s, '.') THEN s ELSE concat(s, '.') END AS summary,
       {S.ellipsize('text', 250, 'A')} AS snippet_a, {S.ellipsize('text', 250, 'B')} AS snippet_b
FROM (SELECT doc_id, text, array_to_string(string_split(text, '. ')[1:2], '. ') AS s FROM documents)
""")
def summaries_docs(spark, sf_dir):
    """T18 + T19: two-sentence summary and 250-char snippets (A and B)."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", T.first_sentences("text", 2).alias("summary"),
                    T.ellipsize("text", 250, "A").alias("snippet_a"), T.ellipsize("text", 250, "B").alias("snippet_b"))


# ------------------------------------------------------------------ T20-T23


@register("pair_unpair", sql="""
SELECT doc_id, p AS input_text, split_part(p, ' [SEP] ', 1) AS query,
       substr(p, strpos(p, ' [SEP] ') + 7) AS answer
FROM (SELECT doc_id, concat(source, ' [SEP] ', text) AS p FROM documents)
""")
def pair_unpair(spark, sf_dir):
    """``query [SEP] answer`` and its inverse."""
    d = t(spark, sf_dir, "documents", ["doc_id", "source", "text"])
    p = T.pair_text(F.col("source"), F.col("text"))
    d = d.select("doc_id", p.alias("input_text"))
    q, a = T.unpair_text(F.col("input_text"))
    return d.select("doc_id", "input_text", q.alias("query"), a.alias("answer"))


_RAW_FB_SQL = ("CASE WHEN role = 'system' THEN text ELSE concat('Q', CAST(conv_id AS VARCHAR), ' Answer: \"', "
               "replace(text, ',', ';'), '\",', CASE WHEN role = 'user' THEN ' thumbs_up' ELSE ' thumbs_down' END) END")


@register("repair_feedback_lines", sql=f"""
WITH r AS (SELECT conv_id, turn, replace({_RAW_FB_SQL}, ',', CASE WHEN role = 'system' THEN '' ELSE ',' END) AS raw FROM conversations),
p AS (SELECT conv_id, turn, raw, strpos(raw, ',') > 0 AS has_comma,
             {S.strip("regexp_extract(raw, '(?s)^(.*),', 1)")} AS head,
             {S.strip("regexp_extract(raw, '(?s),([^,]*)$', 1)")} AS fb FROM r)
SELECT conv_id, turn,
  CASE WHEN has_comma THEN {S.strip("CASE WHEN strpos(head, 'Answer:') > 0 THEN split_part(head, 'Answer:', 1) ELSE head END")} ELSE raw END AS prompt,
  CASE WHEN has_comma THEN replace(regexp_replace({S.strip("CASE WHEN strpos(head, 'Answer:') > 0 THEN substr(head, strpos(head, 'Answer:') + 7) ELSE '' END")}, '^"+|"+$', '', 'g'), chr(10), ' ') ELSE '' END AS answer,
  CASE WHEN has_comma THEN fb ELSE '' END AS feedback,
  CASE WHEN has_comma THEN (CASE WHEN contains(lower(fb), 'up') THEN 1 ELSE 0 END) ELSE 0 END AS label
FROM p
""")
def repair_feedback_lines(spark, sf_dir):
    """T21 + T23(up): malformed feedback lines split into prompt/answer/label."""
    c = t(spark, sf_dir, "conversations")
    raw = F.when(F.col("role") == "system", F.replace(F.col("text"), F.lit(","), F.lit(""))).otherwise(
        F.concat(F.lit("Q"), F.col("conv_id").cast("string"), F.lit(" Answer: \""),
                 F.replace(F.col("text"), F.lit(","), F.lit(";")), F.lit("\","),
                 F.when(F.col("role") == "user", F.lit(" thumbs_up")).otherwise(F.lit(" thumbs_down"))))
    prompt, answer, feedback = T.repair_feedback(raw)
    return c.select("conv_id", "turn", prompt.alias("prompt"), answer.alias("answer"), feedback.alias("feedback"),
                    T.map_label(feedback, "up").alias("label"))


_CHOICE_SQL = ("concat('{\"TinyLLaMA\": \"t', CAST(event_id AS VARCHAR), '\", \"Direct\": \"d', CAST(user_id AS VARCHAR), "
               "'\", \"Variant\": \"v', event_type, '\"', CASE WHEN event_type = 'error' THEN '' ELSE '}' END)")


@register("parse_choices_events", sql=f"""
WITH s AS (SELECT event_id, {_CHOICE_SQL} AS responses,
             CASE event_type WHEN 'click' THEN ' TinyLlama' WHEN 'view' THEN 'direct ' WHEN 'purchase' THEN 'Variant'
                             ELSE 'other' END AS selected_best FROM events),
p AS (SELECT event_id, lower({S.strip('selected_best')}) AS sel, json_valid(responses) AS ok,
             json_extract_string(responses, '$.TinyLLaMA') AS a, json_extract_string(responses, '$.Direct') AS b,
             json_extract_string(responses, '$.Variant') AS c FROM s)
SELECT event_id, sel AS label,
       concat('TinyLLaMA: ', coalesce(a, ''), chr(10), 'Direct: ', coalesce(b, ''), chr(10), 'Variant: ', coalesce(c, '')) AS combined_text,
       CASE sel WHEN 'tinyllama' THEN a WHEN 'direct' THEN b ELSE c END AS chosen_text
FROM p WHERE ok AND sel IN ('tinyllama', 'direct', 'variant')
""")
def parse_choices_events(spark, sf_dir):
    """T22 + J14: JSON candidate maps parsed, malformed/unknown skipped."""
    from ..operators.selection import parse_choices
    e = t(spark, sf_dir, "events", ["event_id", "user_id", "event_type"])
    responses = F.concat(F.lit('{"TinyLLaMA": "t'), F.col("event_id").cast("string"), F.lit('", "Direct": "d'),
                         F.col("user_id").cast("string"), F.lit('", "Variant": "v'), F.col("event_type"), F.lit('"'),
                         F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("}")))
    sel = (F.when(F.col("event_type") == "click", F.lit(" TinyLlama")).when(F.col("event_type") == "view", F.lit("direct "))
           .when(F.col("event_type") == "purchase", F.lit("Variant")).otherwise(F.lit("other")))
    return parse_choices(e.select("event_id", responses.alias("responses"), sel.alias("selected_best")),
                         "responses", "selected_best", keep=("event_id",))


@register("label_maps_events", sql="""
SELECT event_id,
  CASE fb WHEN 'good' THEN 1 WHEN 'bad' THEN 0 END AS label_good_bad,
  CASE WHEN contains(fb2, 'Yes') THEN 1 ELSE 0 END AS label_yes,
  CAST(CASE WHEN lower(regexp_replace(fb3, '^\\s+|\\s+$', '', 'g')) = 'good' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS reward
FROM (SELECT event_id,
        CASE event_type WHEN 'purchase' THEN 'good' WHEN 'error' THEN 'bad' ELSE event_type END AS fb,
        CASE WHEN event_type IN ('purchase', 'signup') THEN 'Yes, great' ELSE 'No' END AS fb2,
        CASE WHEN event_type = 'error' THEN ' bad' ELSE ' Good ' END AS fb3 FROM events)
""")
def label_maps_events(spark, sf_dir):
    """Feedback label maps (good/bad, contains Yes, trimmed lower good)."""
    e = t(spark, sf_dir, "events", ["event_id", "event_type"])
    fb = (F.when(F.col("event_type") == "purchase", F.lit("good")).when(F.col("event_type") == "error", F.lit("bad"))
          .otherwise(F.col("event_type")))
    fb2 = F.when(F.col("event_type").isin("purchase", "signup"), F.lit("Yes, great")).otherwise(F.lit("No"))
    fb3 = F.when(F.col("event_type") == "error", F.lit(" bad")).otherwise(F.lit(" Good "))
    return e.select("event_id", T.map_label(fb, "good_bad").alias("label_good_bad"),
                    T.map_label(fb2, "yes").alias("label_yes"), T.map_label(fb3, "good_float").alias("reward"))


def _sql_topic(x: str) -> str:
    parts = []
    for name, keys in T.TOPIC_RULES:
        cond = " OR ".join(f"contains(lower({x}), {S.q(k)})" for k in keys)
        parts.append(f"WHEN {cond} THEN {S.q(name)}")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


@register("topic_turns", sql=f"SELECT conv_id, turn, {_sql_topic('text')} AS category FROM conversations")
def topic_turns(spark, sf_dir):
    """Keyword topic of each turn (first matching list wins)."""
    c = t(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", T.topic("text").alias("category"))


@register("projections_docs", sql="""
SELECT CAST(doc_id AS VARCHAR) AS id, text AS chunk_text, source AS group_id, CAST(NULL AS INTEGER) AS label,
       CAST(n_chars AS DOUBLE) AS n_chars_d FROM documents
""")
def projections_docs(spark, sf_dir):
    """keep/drop/rename/cast columns, add an empty label column."""
    d = t(spark, sf_dir, "documents", spread_rows=False)
    return (d.drop("lang").withColumnRenamed("text", "chunk_text").withColumnRenamed("source", "group_id")
            .select(F.col("doc_id").cast("string").alias("id"), "chunk_text", "group_id",
                    F.lit(None).cast("int").alias("label"), F.col("n_chars").cast("double").alias("n_chars_d")))


# ------------------------------------------------------------------ predicates


@register("gates_turns", sql=f"""
SELECT conv_id, turn,
  (length(text) > 50) AS long_enough,
  (length(text) >= 30 AND len(regexp_extract_all(text, '\\p{{Nd}}')) <= 10) AS useful_v1,
  (length(text) >= 40
   AND CAST(length(text) - length(regexp_replace(text, '[.,\\[\\]()\\-_]', '', 'g')) AS DOUBLE) / CAST(length(text) AS DOUBLE) <= 0.1
   AND NOT (contains(lower(text), 'archived') OR contains(lower(text), 'retrieved') OR contains(lower(text), 'original')
            OR contains(lower(text), 'citation') OR contains(lower(text), 'source'))
   AND len(regexp_extract_all(text, '\\p{{Nd}}')) <= 5) AS useful_v2,
  (length({S.strip('text')}) < 20 OR contains(text, '....') OR contains(text, 'andand') OR contains(text, 's.s.s')
   OR contains(text, ',.,.,') OR contains(text, '0000')) AS gibberish,
  ({S.strip('text')} = '' OR contains(lower(text), 'you are an intelligent assistant') OR contains(lower(text), 'i''m sorry')
   OR contains(lower(text), 'i don''t know') OR contains(lower(text), 'as an ai')) AS weak,
  (contains(text, '?') OR contains(lower(text), 'explain') OR contains(lower(text), 'how') OR contains(lower(text), 'what')) AS question_like,
  round(CAST((CASE WHEN contains(lower(text), 'summary') THEN 1.0 ELSE 0.0 END)
        + (CASE WHEN len({S.words('text')}) < 80 THEN 0.5 ELSE 0.0 END) AS DOUBLE), 6) AS reward_v1,
  round(CAST((CASE WHEN contains(lower(text), 'summary') THEN 1.0 ELSE 0.0 END)
        + (CASE WHEN len({S.words('text')}) < 80 THEN 0.2 ELSE 0.0 END) AS DOUBLE), 6) AS reward_v2
FROM conversations
""")
def gates_turns(spark, sf_dir):
    """P2-P7 + P10: length, usefulness v1/v2, gibberish, weak, question-like, heuristic rewards."""
    c = t(spark, sf_dir, "conversations")
    x = F.col("text")
    return c.select("conv_id", "turn", (F.length(x) > 50).alias("long_enough"),
                    T.is_useful(x, 1).alias("useful_v1"), T.is_useful(x, 2).alias("useful_v2"),
                    T.is_gibberish(x).alias("gibberish"), T.is_weak(x).alias("weak"),
                    T.is_question_like(x).alias("question_like"),
                    r6(T.heuristic_reward(x, 1)).alias("reward_v1"), r6(T.heuristic_reward(x, 2)).alias("reward_v2"))


@register("quality_band_turns", sql=f"""
SELECT conv_id, turn, round(CASE
  WHEN contains(lower(text), 'bad') OR contains(lower(text), 'irrelevant') OR contains(lower(text), 'nonsensical')
       OR contains(lower(text), 'a bit off') THEN 0.0 + u * 0.3
  WHEN contains(lower(text), 'good') OR contains(lower(text), 'excellent') OR contains(lower(text), 'clear')
       OR contains(lower(text), 'precise') THEN 0.7 + u * 0.3
  ELSE 0.3 + u * 0.6 END, 6) AS quality
FROM (SELECT *, {S.uniform_hash("concat(CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR))", 42)} AS u FROM conversations)
""")
def quality_band_turns(spark, sf_dir):
    """Keyword quality band with a deterministic hash draw."""
    c = t(spark, sf_dir, "conversations")
    key = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    return c.select("conv_id", "turn", r6(T.quality_band("text", key, 42)).alias("quality"))


@register("drop_blank_good", sql=f"""
SELECT d.doc_id, d.source, d.lang FROM documents d JOIN labels l USING (doc_id)
WHERE d.text IS NOT NULL AND {S.strip('d.text')} <> '' AND length(d.text) > 50 AND l.quality = 1 AND d.lang = 'en'
""")
def drop_blank_good(spark, sf_dir):
    """P1 + P2 + P8 + P9: non-blank, long, good-quality, English documents."""
    from ..operators.feedback import drop_blank
    d = t(spark, sf_dir, "documents", ["doc_id", "text", "source", "lang"])
    lab = t(spark, sf_dir, "labels", ["doc_id", "quality"], spread_rows=False)
    good = lab.where(F.col("quality") == 1).select("doc_id")
    d = drop_blank(d, ["text"], min_len=51).where(F.col("lang") == "en")
    return d.join(good, "doc_id", "left_semi").select("doc_id", "source", "lang")
