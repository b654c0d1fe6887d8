"""Sentence boundaries from statistics of the corpus, and rule word tokens.

A full stop ends a sentence unless it belongs to an abbreviation, an initial or
an ordinal.  Which words are abbreviations is counted over the corpus without
supervision (Kiss and Strunk, "Unsupervised multilingual sentence boundary
detection", 2006): a word is one if its full stop follows it far more often
than chance, if it is short, and if it seldom stands without it.

Everything is counting and joining: word types are counted with partial
aggregates, abbreviations are a table, and only the words before a full stop
are joined to it.  Word tokens are a chain of replacements inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import words
from ..session import stored

# --- fixed values ----------------------------------------------------------
ABBREVIATION = 0.3          # least score of an abbreviation
PERIOD_GIVEN = 0.99         # chance of a full stop after an abbreviation
OPENING = r"^[(\[{\"'`]+"    # marks before a word
CLOSING = r"[)\]}\"',;:!?]+$"  # marks behind a word, full stops aside
ENDS = r"[.!?][)\]}\"']*$"   # a word that can end a sentence
STOPPED = r"\.[)\]}\"']*$"   # ... with a full stop
# Penn Treebank word rules, in order; valid in Java and RE2 alike
WORD_RULES = (
    (r"^\"", "`` "),
    (r"([ (\[{<])\"", "$1 `` "),
    (r"([:,])([^0-9])", " $1 $2"),
    (r"([:,])$", " $1 "),
    (r"\.\.\.", " ... "),
    (r"([;@#$%&])", " $1 "),
    (r"([^.])(\.)([\])}>\"']*)[ \t\n]*$", "$1 $2$3 "),
    (r"([?!])", " $1 "),
    (r"([\]\[(){}<>])", " $1 "),
    (r"--", " -- "),
    (r"\"", " '' "),
    (r"([^' ])('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
    (r"([^' ])('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
)
# ---------------------------------------------------------------------------


def word_tokens(sentence: Column) -> Column:
    """Words and punctuation marks of a sentence as an array: marks, brackets
    and clitics are tokens of their own, a full stop only at the end."""
    x = F.concat(sentence, F.lit(" "))
    for rule, by in WORD_RULES:
        x = F.regexp_replace(x, F.lit(rule), F.lit(by))
    return words(x)


def word_type(word: Column) -> Column:
    """A word in lower case without the marks around it; a full stop stays."""
    return F.lower(F.regexp_replace(F.regexp_replace(word, OPENING, ""), CLOSING, ""))


def abbreviations(df: DataFrame, text_col: str) -> DataFrame:
    """``type, n_with, n_without, score``: the abbreviations of the corpus,
    without their last full stop.

    Null and empty texts hold no words; a repeated text counts each time; an
    empty table gives an empty one."""
    # the rules for types look at each different word once
    seen = df.select(F.explode_outer(words(F.col(f"`{text_col}`"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.select(word_type(F.col("word")).alias("word"), "n").where(F.col("word").rlike(r"\pL"))
    stopped = F.endswith("word", F.lit("."))
    counts = (seen
              .groupBy(F.regexp_replace("word", r"\.$", "").alias("type"))
              .agg(F.coalesce(F.sum(F.when(stopped, F.col("n"))), F.lit(0)).alias("n_with"), F.coalesce(F.sum(F.when(~stopped, F.col("n"))), F.lit(0)).alias("n_without")))
    counts = stored(counts)   # read twice: for the chance below and for the scores
    # the chance of a full stop after any word, one number; null where every word or none has one
    by_chance = counts.agg((F.sum("n_with") / F.nullif(F.sum("n_with") + F.sum("n_without"), F.lit(0))).alias("p")).scalar()
    letters = F.char_length(F.replace("type", F.lit("."), F.lit(""))).cast("double")
    dots = F.char_length("type") - letters + 1.0
    likelihood = -2.0 * (F.col("n_with") * F.log(F.col("p") / PERIOD_GIVEN) + F.col("n_without") * F.log((1.0 - F.col("p")) / (1.0 - PERIOD_GIVEN)))
    score = likelihood * F.exp(-letters) * dots * F.pow(letters, -F.col("n_without").cast("double"))
    scored = counts.where("n_with > 0").withColumn("p", by_chance).where("p < 1")
    return scored.select("type", "n_with", "n_without", score.alias("score")).where(F.col("score") >= ABBREVIATION)


def split_sentences(df: DataFrame, id_col: str, text_col: str, short: DataFrame | None = None) -> DataFrame:
    """``id, sent_no, sentence``: sentences of every text, words joined by one space.

    A word that ends in ``!`` or ``?`` ends a sentence, one that ends in a full
    stop does unless it is an abbreviation (``short``, by default counted over
    ``df``), an initial, or a number before a word in lower case.  Closing
    brackets and quotes belong to the word before them.  ``id_col`` must be
    unique; texts that are null, empty or blank give no sentence."""
    short = abbreviations(df, text_col) if short is None else short
    texts = df.select(F.col(f"`{id_col}`").alias("_id"), words(F.col(f"`{text_col}`")).alias("_words"))
    # a word that can end a sentence goes on with its place and the next word, never with its whole text
    marked = F.transform("_words", lambda w, i: F.when(
        (F.contains(w, F.lit(".")) | F.contains(w, F.lit("!")) | F.contains(w, F.lit("?"))) & w.rlike(ENDS),
        F.struct(i.alias("_at"), w.alias("_word"), F.get(F.col("_words"), i + 1).alias("_next"))))
    places = F.filter(marked, lambda p: p.isNotNull())
    ends = (texts.select("_id", F.explode_outer(places).alias("_p")).where(F.col("_p").isNotNull()).select("_id", "_p.*")
            .select("_id", "_at", F.col("_word").rlike(STOPPED).alias("_stop"), F.regexp_replace(word_type(F.col("_word")), r"\.+$", "").alias("type"), "_next"))
    ordinal = F.col("type").rlike("^[0-9]+$") & F.col("_next").rlike(r"^\p{Ll}")
    initial = F.col("type").rlike(r"^\pL$") & F.col("_next").isNotNull()
    # the abbreviations' table is joined by what can end a sentence only; a word's places in a text are one row
    grouped = (ends.where(~(F.col("_stop") & F.coalesce(ordinal | initial, F.lit(False))))
               .groupBy("_id", "_stop", "type").agg(F.collect_list("_at").alias("_ats")))
    open_ends = (grouped.join(short.select("type", F.lit(True).alias("_short")), "type", "left")
                 .where(~(F.col("_stop") & F.coalesce("_short", F.lit(False)))))
    cuts = open_ends.groupBy("_id").agg(F.array_sort(F.flatten(F.collect_list("_ats"))).alias("_cuts"))
    last = F.size("_words") - 1
    stops = F.array_distinct(F.concat(F.coalesce("_cuts", F.array().cast("array<int>")), F.array(last)))
    held = texts.where(F.size("_words") > 0).join(cuts, "_id", "left").withColumn("_stops", stops)
    begins = F.concat(F.array(F.lit(0)), F.transform(F.slice("_stops", F.lit(1), F.size("_stops") - 1), lambda p: p + 1))
    pieces = F.transform(F.arrays_zip(begins.alias("b"), F.col("_stops").alias("e")), lambda p: F.array_join(F.slice("_words", p["b"] + 1, p["e"] - p["b"] + 1), " "))
    return (held.select("_id", F.posexplode_outer(pieces).alias("sent_no", "sentence"))
            .select(F.col("_id").alias(id_col), F.col("sent_no").cast("bigint").alias("sent_no"), "sentence"))


def sentence_token_windows(df: DataFrame, id_col: str, text_col: str, size: int = 500, overlap: int = 50, short: DataFrame | None = None) -> DataFrame:
    """C1 over rule tokens: ``id, chunk_no, chunk_text, n_tokens``, windows of
    ``size`` word tokens of the text's sentences, each repeating ``overlap``."""
    from .chunking import _windows
    if size <= overlap:
        raise ValueError("size must exceed overlap")
    split = split_sentences(df, id_col, text_col, short).select(F.col(f"`{id_col}`").alias("_id"), "sent_no", word_tokens(F.col("sentence")).alias("_t"))
    whole = split.groupBy("_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("sent_no", "_t"))), lambda s: s["_t"])).alias("_all"))
    return (whole.select("_id", F.posexplode_outer(_windows(F.col("_all"), size, size - overlap, False, False)).alias("chunk_no", "_w"))
            .where(F.col("chunk_no").isNotNull())
            .select(F.col("_id").alias(id_col), F.col("chunk_no").cast("bigint").alias("chunk_no"), F.array_join("_w", " ").alias("chunk_text"), F.size("_w").cast("bigint").alias("n_tokens")))
