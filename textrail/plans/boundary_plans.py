"""Registered plans: sentence boundaries and rule tokens."""

from __future__ import annotations

from ..operators import boundaries as B
from . import sqlfrag as S
from .common import r6, register, t


def _sql_type(x: str) -> str:
    return f"lower(regexp_replace(regexp_replace({x}, {S.q(B.OPENING)}, ''), {S.q(B.CLOSING)}, ''))"


_SHORT = f"""
    seen AS (SELECT word FROM (SELECT {_sql_type('w')} AS word FROM (SELECT unnest({S.words('text')}) AS w FROM documents)) WHERE regexp_matches(word, '\\pL')),
    counts AS (SELECT regexp_replace(word, '\\.$', '') AS type, count(*) FILTER (WHERE word LIKE '%.') AS n_with, count(*) FILTER (WHERE word NOT LIKE '%.') AS n_without
               FROM seen GROUP BY 1),
    total AS (SELECT CAST(sum(n_with + n_without) AS DOUBLE) AS words, CAST(sum(n_with) AS DOUBLE) AS stops FROM counts),
    scored AS (SELECT type, n_with, n_without, CAST(length(replace(type, '.', '')) AS DOUBLE) AS letters, length(type) AS len, stops / words AS p
               FROM counts, total WHERE n_with > 0 AND words > stops),
    short AS (SELECT type, n_with, n_without, score FROM (
        SELECT type, n_with, n_without, -2.0 * (n_with * ln(p / {B.PERIOD_GIVEN}) + n_without * ln((1.0 - p) / (1.0 - {B.PERIOD_GIVEN})))
               * exp(-letters) * (len - letters + 1.0) * pow(letters, -CAST(n_without AS DOUBLE)) AS score FROM scored) WHERE score >= {B.ABBREVIATION})"""

_SENTENCES = f"""{_SHORT},
    texts AS (SELECT doc_id, {S.words('text')} AS ws FROM documents),
    words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM texts),
    marked AS (SELECT doc_id, pos, w, regexp_matches(w, {S.q(B.STOPPED)}) AS stop, regexp_replace({_sql_type('w')}, '\\.+$', '') AS type,
                      lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM words),
    ended AS (SELECT doc_id, pos, w, regexp_matches(w, {S.q(B.ENDS)}) AND NOT (stop AND (type IN (SELECT type FROM short)
                      OR coalesce((regexp_matches(type, '^[0-9]+$') AND regexp_matches(nxt, '^\\p{{Ll}}')) OR (regexp_matches(type, '^\\pL$') AND nxt IS NOT NULL), false))) AS fin FROM marked),
    numbered AS (SELECT doc_id, pos, w, CAST(coalesce(sum(CAST(fin AS INT)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS sent_no FROM ended),
    sentences AS (SELECT doc_id, sent_no, string_agg(w, ' ' ORDER BY pos) AS sentence FROM numbered GROUP BY 1, 2)"""


def _sql_tokens(x: str) -> str:
    x = f"concat({x}, ' ')"
    for rule, by in B.WORD_RULES:
        x = S.rx(x, rule, by.replace("$", "\\"))
    return S.words(x)


@register("abbreviation_statistics", sql=f"WITH {_SHORT} SELECT type, n_with, n_without, round(score, 6) AS score FROM short")
def abbreviation_statistics(spark, sf_dir):
    """C11: abbreviations of the corpus by unsupervised statistics of full stops."""
    short = B.abbreviations(t(spark, sf_dir, "documents", ["text"]), "text")
    return short.select("type", "n_with", "n_without", r6(short["score"]).alias("score"))


@register("sentences_by_statistics", sql=f"WITH {_SENTENCES} SELECT doc_id, sent_no, sentence FROM sentences")
def sentences_by_statistics(spark, sf_dir):
    """C11: sentences of every document, full stops of abbreviations, initials and ordinals apart."""
    return B.split_sentences(t(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text")


@register("chunk_rule_tokens", sql=f"""WITH {_SENTENCES},
    toks AS (SELECT doc_id, flatten(list({_sql_tokens('sentence')} ORDER BY sent_no)) AS tk FROM sentences GROUP BY doc_id),
    starts AS (SELECT doc_id, tk, unnest(range(0, len(tk), 450)) AS s FROM toks)
SELECT doc_id, CAST(s // 450 AS BIGINT) AS chunk_no, array_to_string(tk[s + 1 : s + 500], ' ') AS chunk_text, CAST(len(tk[s + 1 : s + 500]) AS BIGINT) AS n_tokens FROM starts
""")
def chunk_rule_tokens(spark, sf_dir):
    """C1 with word tokens by rule: windows of 500, 50 of them repeated."""
    return B.sentence_token_windows(t(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text", 500, 50)
