"""Registered plans: cleaning + chunking over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunking as C
from ..session import compute_once
from . import sqlfrag as S
from .common import noisy_text, register, t

# ---------------------------------------------------------------- helpers (SQL)


def _sql_ocr_clean_docs() -> str:
    return (f"SELECT doc_id, lang, {S.clean_ocr(S.noisy_text())} AS text FROM documents")


def _sql_windows(src: str, size: int, step: int) -> str:
    """Token windows in SQL: starts 0, step, ... < n."""
    return f"""
    WITH src AS ({src}),
    tok AS (SELECT doc_id, {S.words('text')} AS toks FROM src),
    win AS (
      SELECT doc_id, toks, unnest(range(0, len(toks), {step})) AS s FROM tok WHERE len(toks) > 0
    )
    SELECT doc_id, CAST(s / {step} AS BIGINT) AS chunk_no,
           array_to_string(toks[s + 1 : s + {size}], ' ') AS chunk_text,
           CAST(len(toks[s + 1 : s + {size}]) AS BIGINT) AS n_tokens
    FROM win
    """


# ---------------------------------------------------------------- T1 / T2


@register("clean_ocr_docs", sql=f"""
SELECT doc_id, text AS clean_text, CAST(length(text) AS BIGINT) AS n_chars
FROM ({_sql_ocr_clean_docs()}) WHERE text <> ''
""")
def clean_ocr_docs(spark, sf_dir):
    """T2 + P1: layout-OCR cleaning of every document (markers injected)."""
    d = compute_once(t(spark, sf_dir, "documents"), "clean_text", T.clean_ocr(noisy_text()))
    return (d.where(F.col("clean_text") != "")
            .select("doc_id", "clean_text", F.length("clean_text").cast("bigint").alias("n_chars")))


@register("clean_scan_docs", sql=f"""
SELECT doc_id, x AS clean_text, CAST(length(x) AS BIGINT) AS n_chars FROM (
  SELECT doc_id, {S.clean_scan(S.noisy_text())} AS x FROM documents) WHERE x <> ''
""")
def clean_scan_docs(spark, sf_dir):
    """Scan-OCR cleaning; footer words cut the rest of the text."""
    d = compute_once(t(spark, sf_dir, "documents"), "clean_text", T.clean_scan(noisy_text()))
    return (d.where(F.col("clean_text") != "")
            .select("doc_id", "clean_text", F.length("clean_text").cast("bigint").alias("n_chars")))


# ---------------------------------------------------------------- C1 (flagship)


def cleaned_docs(spark, sf_dir):
    d = t(spark, sf_dir, "documents", ["doc_id", "lang", "text"])
    d = compute_once(d, "clean", T.clean_ocr(noisy_text()))
    return d.select("doc_id", "lang", F.col("clean").alias("text")).where(F.col("text") != "")


@register("chunk_token_window", sql=f"""
WITH w AS ({_sql_windows(_sql_ocr_clean_docs() + " WHERE text <> ''", 500, 450)}),
c AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
o AS (SELECT doc_id, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM c)
SELECT w.doc_id, w.chunk_no,
       concat(CAST(w.doc_id AS VARCHAR), '.txt_', CAST(o.off + w.chunk_no AS VARCHAR)) AS chunk_id,
       w.chunk_text, w.n_tokens
FROM w JOIN o USING (doc_id)
""")
def chunk_token_window(spark, sf_dir):
    """T2 -> P1 -> C1: 500-token windows, 50 overlap, global chunk counter."""
    docs = cleaned_docs(spark, sf_dir)
    return C.token_window(docs, "doc_id", "text", 500, 50,
                          name_col=F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


@register("chunk_stats_by_lang", sql=f"""
WITH d AS ({_sql_ocr_clean_docs()} ),
w AS ({_sql_windows("SELECT doc_id, text FROM (" + _sql_ocr_clean_docs() + ") WHERE text <> ''", 500, 450)})
SELECT d.lang, CAST(count(DISTINCT w.doc_id) AS BIGINT) AS n_docs, CAST(count(*) AS BIGINT) AS n_chunks,
       CAST(sum(w.n_tokens) AS BIGINT) AS n_tokens, round(avg(w.n_tokens), 6) AS avg_tokens
FROM w JOIN d USING (doc_id) GROUP BY d.lang
""")
def chunk_stats_by_lang(spark, sf_dir):
    """Flagship: clean -> chunk -> chunks and tokens per language."""
    docs = cleaned_docs(spark, sf_dir)
    chunks = C.token_window(docs, "doc_id", "text", 500, 50, global_ids=False, keep=("lang",))
    return (chunks.groupBy("lang")
            .agg(F.countDistinct("doc_id").cast("bigint").alias("n_docs"),
                 F.count(F.lit(1)).cast("bigint").alias("n_chunks"),
                 F.sum("n_tokens").cast("bigint").alias("n_tokens"),
                 F.round(F.avg("n_tokens"), 6).alias("avg_tokens")))


# ---------------------------------------------------------------- C5-C13

_HEAD_SRC_SQL = ("CASE WHEN lang = 'en' THEN concat('Preface text.', chr(10), 'Introduction and Scope', chr(10), text, "
                 "chr(10), 'Notes', chr(10), 'Short closing words here') ELSE text END")


def _head_src():
    return F.when(F.col("lang") == "en",
                  F.concat(F.lit("Preface text.\nIntroduction and Scope\n"), F.col("text"),
                           F.lit("\nNotes\nShort closing words here"))).otherwise(F.col("text"))


def _sql_sections(src: str, thresholds: list[tuple[int, int]] | None, single: tuple[int, int] | None) -> str:
    head = C.HEADING.replace("(?md)", "(?m)")
    tlist = "[" + ", ".join(f"{{'t': {t_}, 'o': {o}}}" for t_, o in (thresholds or [single])) + "]"
    return f"""
    WITH src AS ({src}),
    sp AS (SELECT doc_id, text, regexp_extract_all(text, {S.q(head)}, 1) AS titles,
                  regexp_split_to_array(text, {S.q(head)}) AS bodies FROM src),
    sec AS (SELECT doc_id,
              CASE WHEN len(titles) = 0 THEN ['FullText'] ELSE list_transform(titles, lambda x: {S.strip('x')}) END AS ts,
              CASE WHEN len(titles) = 0 THEN [text] ELSE bodies[2:] END AS bs FROM sp),
    ex AS (SELECT doc_id, unnest(ts) AS section, unnest(bs) AS body, generate_subscripts(ts, 1) - 1 AS section_no FROM sec),
    w AS (SELECT doc_id, section_no, section, {S.words(S.strip('body'))} AS ws FROM ex),
    p AS (SELECT w.*, unnest({tlist}) AS par FROM w),
    q AS (SELECT doc_id, section_no, section, ws, par.t AS threshold, par.t - par.o AS step, len(ws) AS n FROM p),
    st AS (SELECT *, unnest(CASE WHEN n <= threshold THEN [0]
                            ELSE range(0, (CAST(ceil((n - threshold) / step) AS BIGINT)) * step + 1, step) END) AS s FROM q)
    SELECT doc_id, {"threshold, " if thresholds else ""}CAST(section_no AS BIGINT) AS section_no, section,
           CAST(s / step + 1 AS BIGINT) AS chunk_no, concat(section, '_', CAST(CAST(s / step + 1 AS BIGINT) AS VARCHAR)) AS chunk_id,
           array_to_string(ws[s + 1 : s + threshold], ' ') AS chunk_text, CAST(len(ws[s + 1 : s + threshold]) AS BIGINT) AS n_tokens
    FROM st"""


@register("chunk_sections", sql=_sql_sections(f"SELECT doc_id, {_HEAD_SRC_SQL} AS text FROM documents", None, (300, 45)))
def chunk_sections(spark, sf_dir):
    """Heading sections, 300-word windows with 45 overlap, early stop."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return C.section_hybrid(d.select("doc_id", _head_src().alias("text")), "doc_id", "text", 300)


@register("chunk_sweep", sql=_sql_sections(f"SELECT doc_id, {_HEAD_SRC_SQL} AS text FROM documents",
                                           [(t_, int(t_ * 0.15)) for t_ in C.SWEEP_THRESHOLDS], None))
def chunk_sweep(spark, sf_dir):
    """The section chunker at thresholds 50/150/300/450 in one scan."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return C.sweep(d.select("doc_id", _head_src().alias("text")), "doc_id", "text")


@register("chunk_sweep_summary", sql=f"""
SELECT threshold, CAST(count(*) AS BIGINT) AS n_chunks, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
       CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs
FROM ({_sql_sections(f"SELECT doc_id, {_HEAD_SRC_SQL} AS text FROM documents", [(t_, int(t_ * 0.15)) for t_ in C.SWEEP_THRESHOLDS], None)})
GROUP BY threshold
""")
def chunk_sweep_summary(spark, sf_dir):
    """C10 + C13: chunk totals per threshold of the sweep."""
    s = chunk_sweep(spark, sf_dir)
    return s.groupBy("threshold").agg(F.count(F.lit(1)).cast("bigint").alias("n_chunks"),
                                      F.sum("n_tokens").cast("bigint").alias("n_tokens"),
                                      F.countDistinct("doc_id").cast("bigint").alias("n_docs"))


@register("chunk_paragraphs", sql=f"""
SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS BIGINT) AS chunk_no, unnest(p) AS chunk_text FROM (
  SELECT doc_id, list_filter(list_transform(string_split(replace(replace(replace(text, chr(10), chr(10) || chr(10)), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10) || chr(10)),
                                            lambda s: {S.strip('s')}), lambda s: s <> '') AS p FROM documents WHERE text IS NOT NULL)
WHERE len(p) > 0
UNION ALL
SELECT doc_id, NULL, NULL FROM documents WHERE text IS NOT NULL AND len(list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda s: {S.strip('s')}), lambda s: s <> '')) = 0
""")
def chunk_paragraphs(spark, sf_dir):
    """Paragraphs (each line break doubled to form paragraphs)."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return C.paragraphs(d.select("doc_id", F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")).alias("text")), "doc_id", "text")


@register("chunk_sliding", sql=f"""
WITH tok AS (SELECT doc_id, {S.words('text')} AS toks FROM documents),
st AS (SELECT doc_id, toks, unnest(range(0, len(toks) - 50 + 1, 25)) AS s FROM tok WHERE len(toks) >= 50)
SELECT doc_id, CAST(s / 25 AS BIGINT) AS chunk_no, concat(CAST(doc_id AS VARCHAR), '_', CAST(CAST(s / 25 AS BIGINT) AS VARCHAR)) AS chunk_id,
       array_to_string(toks[s + 1 : s + 50], ' ') AS chunk_text, CAST(50 AS BIGINT) AS n_tokens FROM st
""")
def chunk_sliding(spark, sf_dir):
    """Full 50-word windows every 25 words."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return C.sliding(d, "doc_id", "text", 50, 25)


@register("chunk_fixed100", sql=f"""
WITH tok AS (SELECT doc_id, {S.words('text')} AS toks FROM documents),
st AS (SELECT doc_id, toks, unnest(range(0, len(toks), 100)) AS s FROM tok WHERE len(toks) > 0)
SELECT doc_id, CAST(s / 100 AS BIGINT) AS chunk_no, concat(CAST(doc_id AS VARCHAR), '_', CAST(CAST(s / 100 AS BIGINT) AS VARCHAR)) AS chunk_id,
       array_to_string(toks[s + 1 : s + 100], ' ') AS chunk_text, CAST(len(toks[s + 1 : s + 100]) AS BIGINT) AS n_tokens FROM st
""")
def chunk_fixed100(spark, sf_dir):
    """Consecutive 100-word chunks."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return C.fixed_words(d, "doc_id", "text", 100)


@register("sentences_docs", sql="""
SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS sent_no, unnest(s) AS sentence FROM (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS s FROM documents)
""")
def sentences_docs(spark, sf_dir):
    """C11: sentence split after . ! ? followed by spaces."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return C.explode_sentences(d, "doc_id", "text")


@register("merge_turns", sql="""
SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS merged_text, CAST(sum(length(text)) AS BIGINT) AS total_length,
       arg_min(role, turn) AS role
FROM conversations GROUP BY conv_id
""")
def merge_turns(spark, sf_dir):
    """Fragments (turns) merged per group in order; first-row fields."""
    c = t(spark, sf_dir, "conversations").withColumn("len", F.length("text"))
    return C.merge_fragments(c, "conv_id", "turn", "text", length_col="len", first_cols=("role",))


@register("chunk_counts_docs", sql=f"""
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_chunks FROM (
  SELECT doc_id, unnest(range(0, len({S.words('text')}), 100)) FROM documents) GROUP BY doc_id
""")
def chunk_counts_docs(spark, sf_dir):
    """Chunks per document (100-word chunks)."""
    return C.chunk_counts(chunk_fixed100(spark, sf_dir), "doc_id")


# ---------------------------------------------------------------- folds (recursive SQL twins)


def _sql_sentences(src: str) -> str:
    """Sentences (split after . ! ? plus spaces) with 1-based index."""
    return f"""SELECT doc_id, unnest(sp) AS sentence, generate_subscripts(sp, 1) AS i FROM (
        SELECT doc_id, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS sp FROM ({src}))"""


def _sql_fold_chunks(steps: str, final: str) -> str:
    """Emitted chunks of a recursive fold ``r(doc_id, i, ..., emitted)`` plus
    the final carried chunk, numbered per document."""
    return f"""
    em AS (SELECT doc_id, i AS pos, emitted AS chunk_text FROM r WHERE emitted IS NOT NULL
           UNION ALL
           SELECT doc_id, i + 1 AS pos, {final} AS chunk_text FROM r
           WHERE (doc_id, i) IN (SELECT doc_id, max(i) FROM r GROUP BY doc_id) AND {steps})
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS BIGINT) AS chunk_no, chunk_text,
           CAST(len({S.words('chunk_text')}) AS BIGINT) AS n_tokens FROM em"""


def _sql_sentence_pack(src: str, size: int, overlap: int) -> str:
    return f"""
    WITH RECURSIVE s AS (SELECT doc_id, i, {S.words('sentence')} AS toks FROM ({_sql_sentences(src)})),
    r AS (
      SELECT DISTINCT doc_id, 0 AS i, CAST([] AS VARCHAR[]) AS cur, CAST(NULL AS VARCHAR) AS emitted FROM s
      UNION ALL
      SELECT r.doc_id, s.i,
        CASE WHEN len(r.cur) + len(s.toks) <= {size} THEN list_concat(r.cur, s.toks)
             ELSE list_concat(CASE WHEN {overlap} < len(r.cur) THEN r.cur[-{overlap}:] ELSE r.cur END, s.toks) END,
        CASE WHEN len(r.cur) + len(s.toks) <= {size} THEN NULL ELSE array_to_string(r.cur, ' ') END
      FROM r JOIN s ON s.doc_id = r.doc_id AND s.i = r.i + 1),
    {_sql_fold_chunks("len(cur) > 0", "array_to_string(cur, ' ')")}"""


def _sql_dynamic_pack(src: str, size: int) -> str:
    return f"""
    WITH RECURSIVE s AS (SELECT doc_id, i, {S.words('sentence')} AS toks FROM ({_sql_sentences(src)})),
    r AS (
      SELECT DISTINCT doc_id, 0 AS i, CAST([] AS VARCHAR[]) AS cur, CAST(NULL AS VARCHAR) AS emitted FROM s
      UNION ALL
      SELECT r.doc_id, s.i,
        CASE WHEN len(r.cur) + len(s.toks) > {size} THEN s.toks ELSE list_concat(r.cur, s.toks) END,
        CASE WHEN len(r.cur) + len(s.toks) > {size} AND len(r.cur) > 0 THEN array_to_string(r.cur, ' ') END
      FROM r JOIN s ON s.doc_id = r.doc_id AND s.i = r.i + 1),
    {_sql_fold_chunks("len(cur) > 0", "array_to_string(cur, ' ')")}"""


def _sql_sentence_overlap(src: str, max_words: int, overlap: int) -> str:
    nw = f"len({S.words('x')})"
    return f"""
    WITH RECURSIVE s AS (SELECT doc_id, i, {S.strip('sentence')} AS sent FROM ({_sql_sentences(src)})),
    s2 AS (SELECT doc_id, i, sent, len({S.words('sent')}) AS w FROM s),
    r AS (
      SELECT DISTINCT doc_id, 0 AS i, CAST([] AS VARCHAR[]) AS cur, CAST(0 AS BIGINT) AS ln, CAST(NULL AS VARCHAR) AS emitted FROM s2
      UNION ALL
      SELECT r.doc_id, s2.i,
        CASE WHEN r.ln + s2.w > {max_words}
             THEN list_append(CASE WHEN len(r.cur) > {overlap} THEN r.cur[-{overlap}:] ELSE r.cur END, s2.sent)
             ELSE list_append(r.cur, s2.sent) END,
        CASE WHEN r.ln + s2.w > {max_words}
             THEN CAST(coalesce(list_sum(list_transform(CASE WHEN len(r.cur) > {overlap} THEN r.cur[-{overlap}:] ELSE r.cur END,
                                                        lambda x: {nw})), 0) AS BIGINT) + s2.w
             ELSE r.ln + s2.w END,
        CASE WHEN r.ln + s2.w > {max_words} THEN array_to_string(r.cur, ' ') END
      FROM r JOIN s2 ON s2.doc_id = r.doc_id AND s2.i = r.i + 1),
    {_sql_fold_chunks("len(cur) > 0", "array_to_string(cur, ' ')")}"""


_CLEANED_SRC = f"SELECT doc_id, text FROM ({_sql_ocr_clean_docs()}) WHERE text <> ''"


@register("chunk_sentence_pack", sql=_sql_sentence_pack(_CLEANED_SRC, 500, 50))
def chunk_sentence_pack(spark, sf_dir):
    """Sentence packing to 500 tokens with 50-token carry-over."""
    return C.sentence_pack(cleaned_docs(spark, sf_dir), "doc_id", "text", 500, 50)


@register("chunk_dynamic_pack", sql=_sql_dynamic_pack("SELECT doc_id, text FROM documents", 512))
def chunk_dynamic_pack(spark, sf_dir):
    """Sentence packing to 512 tokens, no overlap."""
    return C.dynamic_pack(t(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text", 512)


@register("chunk_sentence_overlap", sql=_sql_sentence_overlap("SELECT doc_id, text FROM documents", 120, 20))
def chunk_sentence_overlap(spark, sf_dir):
    """C4: 120-word chunks carrying the last 20 sentences."""
    return C.sentence_overlap(t(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text", 120, 20)


def _sql_recursive_chars(src: str, size: int, overlap: int) -> str:
    """Per separator, the segments that hold it are cut before each of its
    places; runs of small pieces are kept as lists of cuts, long pieces and
    segments without it go on to the next separator.  Spans of a run follow
    by recursion over chunks."""
    ctes, runs = [f"g0 AS (SELECT doc_id, 0 AS pos, text AS seg FROM ({src}) WHERE text <> '')"], []
    for k, sep in enumerate(C.SEPARATORS):
        q = " || ".join(f"chr({ord(c)})" for c in sep)
        ctes.append(f"""c{k} AS (
      SELECT doc_id, pos AS gpos, piece, i, pos + CAST(coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, pos ORDER BY i
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
      FROM (SELECT doc_id, pos, i, CASE WHEN i = 1 THEN p ELSE {q} || p END AS piece FROM (
        SELECT doc_id, pos, unnest(string_split(seg, {q})) AS p, generate_subscripts(string_split(seg, {q}), 1) AS i
        FROM g{k} WHERE contains(seg, {q}))))""")
        ctes.append(f"""n{k} AS (SELECT *, count_if(length(piece) >= {size}) OVER (PARTITION BY doc_id, gpos ORDER BY i) AS run
      FROM c{k} WHERE piece <> '')""")
        ctes.append(f"""g{k + 1} AS (SELECT doc_id, pos, piece AS seg FROM n{k} WHERE length(piece) >= {size}
      UNION ALL SELECT doc_id, pos, seg FROM g{k} WHERE NOT contains(seg, {q}))""")
        runs.append(f"""SELECT doc_id, min(pos) AS rs, list_append(list(pos ORDER BY pos), max(pos + length(piece))) AS cuts
      FROM n{k} WHERE length(piece) < {size} GROUP BY doc_id, gpos, run""")
    runs.append(f"SELECT doc_id, pos, range(pos, pos + length(seg) + 1) FROM g{len(C.SEPARATORS)}")
    return f"""
    WITH RECURSIVE {", ".join(ctes)},
    runs AS ({" UNION ALL ".join(runs)}),
    r AS (
      SELECT doc_id, rs, cuts, rs AS a, list_max(list_filter(cuts, lambda x: x <= rs + {size})) AS b FROM runs
      UNION ALL
      SELECT doc_id, rs, cuts, a2, list_max(list_filter(cuts, lambda x: x <= a2 + {size})) FROM (
        SELECT doc_id, rs, cuts, list_min(list_filter(cuts, lambda x: x >= b - {overlap} AND x >= nxt - {size})) AS a2 FROM (
          SELECT doc_id, rs, cuts, b, list_min(list_filter(cuts, lambda x: x > b)) AS nxt FROM r WHERE b < list_max(cuts)))),
    em AS (SELECT r.doc_id, rs, a, {S.strip("substr(s.text, CAST(a + 1 AS BIGINT), CAST(b - a AS BIGINT))")} AS chunk_text
           FROM r JOIN ({src}) s ON s.doc_id = r.doc_id)
    SELECT doc_id, CAST(rn - 1 AS BIGINT) AS chunk_no, concat('chunk_', CAST(rn AS VARCHAR)) AS chunk_id, chunk_text FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rs, a) AS rn FROM em WHERE chunk_text <> '')"""


@register("chunk_recursive_chars", sql=_sql_recursive_chars(f"SELECT doc_id, {S.clean_ascii('text')} AS text FROM documents", 1000, 100))
def chunk_recursive_chars(spark, sf_dir):
    """T6 + C8: cleaned documents in 1000-char chunks with 100-char overlap."""
    d = t(spark, sf_dir, "documents", ["doc_id", "text"])
    return C.recursive_chars(d.select("doc_id", T.clean_ascii("text").alias("text")), "doc_id", "text", 1000, 100)


@register("chunk_recursive_lines", sql=_sql_recursive_chars("SELECT doc_id, text FROM documents", 120, 30))
def chunk_recursive_lines(spark, sf_dir):
    """C8 on texts with their lines: 120-char chunks cut at blank lines, new
    lines and spaces, coarse before fine."""
    return C.recursive_chars(t(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text", 120, 30)
