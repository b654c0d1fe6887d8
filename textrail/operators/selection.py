"""Selection operators: best-of-n, longest answer, chosen/rejected pairs,
fallback chains, candidate sets and vote parsing (J9-J14, W6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, uniform_hash

# --- fixed values ----------------------------------------------------------
CHOICE_KEYS = ("TinyLLaMA", "Direct", "Variant")
SNIPPET_ANSWER_PREFIX = "Based on the documents, here is some info:\n"
NO_ANSWER = "No answer found."
APOLOGIES = (
    "I'm sorry, I couldn't find a helpful answer. Could you rephrase your question?",
    "Hmm... I didn’t quite get that. Can you ask it in a different way?",
    "I’m still learning! Can you try asking it another way?",
    "Apologies, I’m unable to help with that one. Could you provide more context?",
)
FALLBACK_TIP = "\nTip: Try being more specific, like mentioning a topic or keyword."
# ---------------------------------------------------------------------------


def parse_choices(df: DataFrame, responses_col: str, selected_col: str, keys=CHOICE_KEYS,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """T22 + J14: parse the JSON map of candidate answers; rows with a
    malformed map or a vote outside ``keys`` are skipped.  Returns the
    vote as the label, the labelled concatenation and the voted text."""
    from ..session import compute_once
    m = F.from_json(F.col(responses_col), "map<string,string>")
    sel = F.lower(strip(F.col(selected_col)))
    allowed = [k.lower() for k in keys]
    # parse once: the filter would otherwise be pushed below and re-parse
    parsed = compute_once(df.select(*keep, F.col(responses_col), F.col(selected_col)), "_p",
                          F.struct(m.alias("m"), sel.alias("label")))
    parsed = (parsed.select(*keep, F.col("_p.m").alias("_m"), F.col("_p.label").alias("label"))
              .where(F.col("_m").isNotNull() & F.col("label").isin(allowed)))
    combined = F.concat_ws("\n", *[F.concat(F.lit(k + ": "), F.coalesce(F.col("_m")[k], F.lit(""))) for k in keys])
    chosen = F.try_element_at(F.map_values(F.map_filter(F.col("_m"), lambda k, v: F.lower(k) == F.col("label"))), F.lit(1))
    return parsed.select(*keep, "label", combined.alias("combined_text"), chosen.alias("chosen_text"))


def best_of_n(cands: DataFrame, key: str, score: str, order: str, answer: str = "answer") -> DataFrame:
    """Highest score per key, the first candidate (``order``) wins
    ties; rows without a score rank last (so without a model the first
    candidate wins).  A partial ``max_by`` aggregate: no group is sorted."""
    rank_key = F.struct(F.coalesce(F.col(score), F.lit(float("-inf"))).alias("s"), (-F.col(order)).alias("o"))
    return cands.groupBy(key).agg(F.max_by(F.struct(answer, score, order), rank_key).alias("_b")).select(
        key, F.col(f"_b.{answer}").alias(answer), F.col(f"_b.{score}").alias(score), F.col(f"_b.{order}").alias(order))


def longest(cands: DataFrame, key: str, answer: str = "answer", order: str = "ord",
            keys: DataFrame | None = None) -> DataFrame:
    """The longest answer per key (first wins ties); keys without an
    answer get ``No answer found.``."""
    best = cands.groupBy(key).agg(
        F.max_by(answer, F.struct(F.length(answer).alias("l"), (-F.col(order)).alias("o"))).alias(answer))
    if keys is None:
        return best
    return keys.select(key).join(best, key, "left").select(key, F.coalesce(F.col(answer), F.lit(NO_ANSWER)).alias(answer))


def chosen_rejected(df: DataFrame, prompt: str = "prompt", r1: str = "response_1", s1: str = "score_1",
                    r2: str = "response_2", s2: str = "score_2", r3: str | None = None, s3: str | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """chosen/rejected from two scored responses: score1 >= score2
    keeps the first as chosen.  When the two texts are identical, a
    lower-scored third response becomes the rejected one, else the prompt
    is skipped."""
    first_wins = F.col(s1) >= F.col(s2)
    chosen = F.when(first_wins, F.col(r1)).otherwise(F.col(r2))
    chosen_score = F.when(first_wins, F.col(s1)).otherwise(F.col(s2))
    rejected = F.when(first_wins, F.col(r2)).otherwise(F.col(r1))
    same = F.col(r1) == F.col(r2)
    if r3 is not None:
        use3 = same & (F.col(r3) != chosen) & (F.col(s3) < chosen_score)
        rejected = F.when(use3, F.col(r3)).otherwise(rejected)
        keep_row = ~same | use3
    else:
        keep_row = ~same
    return df.where(keep_row).select(*keep, prompt, chosen.alias("chosen"), rejected.alias("rejected"))


def fallback_chain(df: DataFrame, cols: list[str], gate=None, default: str = "I'm sorry, I could not find an answer.",
                   names: list[str] | None = None, out: str = "answer", source: str = "model_used") -> DataFrame:
    """First candidate column that is present, non-blank and passes
    ``gate`` (a ``Column -> Column`` predicate that is True for a *bad*
    answer, e.g. :func:`textrail.functions.text.is_gibberish`), else the
    default; the provenance column names the winner."""
    names = names or cols
    ans, src = F.lit(default), F.lit("fallback")
    for c, name in reversed(list(zip(cols, names))):
        x = F.col(c)
        ok = x.isNotNull() & (strip(x) != "")
        if gate is not None:
            ok = ok & ~gate(x)
        ans = F.when(ok, x).otherwise(ans)
        src = F.when(ok, F.lit(name)).otherwise(src)
    return df.withColumn(out, ans).withColumn(source, src)


def add_snippet_candidate(cands: DataFrame, snippets: DataFrame, key: str = "query", answer: str = "answer",
                          order: str = "ord", snippet: str = "snippet") -> DataFrame:
    """Candidates + ``Based on the documents, here is some info:\\n<snippet>``
    as the last candidate of each key."""
    mx = cands.groupBy(key).agg(F.max(order).alias("_m"))
    extra = (snippets.join(mx, key, "left")
             .select(key, F.concat(F.lit(SNIPPET_ANSWER_PREFIX), F.col(snippet)).alias(answer),
                     (F.coalesce(F.col("_m"), F.lit(-1)) + 1).alias(order)))
    return cands.select(key, answer, order).unionByName(extra)


def softmax_by(df: DataFrame, key: str, score: str, out: str = "prob") -> DataFrame:
    """``exp(x - max) / sum(exp(x - max))`` per key.

    Both statistics are partial (map-side combined) aggregates joined back
    on the key, so a key holding a large share of the rows is never
    buffered in one task the way an unordered window partition would be."""
    mx = df.groupBy(key).agg(F.max(score).alias("_mx"))
    e = df.join(mx, key).withColumn("_e", F.exp(F.col(score) - F.col("_mx")))
    tot = e.groupBy(key).agg(F.sum("_e").alias("_z"))
    return e.join(tot, key).withColumn(out, F.col("_e") / F.col("_z")).drop("_mx", "_e", "_z")


def apology(key, seed: int = 42, apologies=APOLOGIES, tip: str = FALLBACK_TIP) -> Column:
    """J12 apology variant: one of the apology texts, drawn by an
    md5-seeded uniform of ``key`` (reproducible), followed by the tip."""
    k = F.col(key) if isinstance(key, str) else key
    idx = F.floor(uniform_hash(k, seed=seed) * len(apologies)).cast("int")
    return F.concat(F.element_at(F.array(*[F.lit(a) for a in apologies]), idx + 1), F.lit(tip))


def weak_answer_fallback(df: DataFrame, answer: str, key, gate, seed: int = 42, out: str = "final_answer",
                         flag: str = "fallback") -> DataFrame:
    """Keep the answer unless ``gate`` flags it (e.g. P6 weak / P5
    gibberish); then answer with an apology plus the tip."""
    bad = gate(F.col(answer))
    return (df.withColumn(flag, bad)
            .withColumn(out, F.when(bad, apology(key, seed)).otherwise(F.col(answer))))
