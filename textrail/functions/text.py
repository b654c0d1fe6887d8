"""Scalar text rules (``Column -> Column``): cleaning, parsing, predicates.

Everything here is a composition of built-in Spark expressions, so it runs
inside whole-stage codegen with no Python on the executors.  Rule order
matters and follows the documented order of each rule set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import (DIGIT, EDGE_WS, NON_WS, WORD, WS, WS_CHARS,
                       java_word_end, java_word_start)

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- fixed values ----------------------------------------------------------
# Markers written by the OCR step and removed by the cleaners.
ERROR_MARKER = r"\[ERROR.*?\]"
NO_TEXT_MARKER = r"\[NO TEXT DETECTED\]"
FOOTER_WORDS = ("source", "references", "footer")
# `\S+@\S+` from the start of a non-space run: to the first `@` that is not the
# run's first character, and on; ASCII and letters are tried first, for speed.
ADDRESS = (r"(?<![!-~\pL[^" + WS_CHARS + r"]])" + NON_WS + r"[!-?A-~\pL[^@" + WS_CHARS + r"]]*+@" + NON_WS + "+")
# Spanish wiki boiler-plate headers (clean_wiki).
WIKI_HEADERS = ("Wikipedia", "Artículo", "Editar", "Ver historial", "Desde Wikipedia")
# Answer gates.
GIBBERISH_MARKS = ("....", "andand", "s.s.s", ",.,.,", "0000")
GENERIC_PHRASES = ("you are an intelligent assistant", "i'm sorry", "i don't know", "as an ai")
QUESTION_WORDS = ("explain", "how", "what")
USEFUL_V2_PUNCT = (".", ",", "[", "]", "(", ")", "-", "_")
USEFUL_V2_BAD_WORDS = ("archived", "retrieved", "original", "citation", "source")
# Keyword topics, checked in this order; first hit wins, else "other".
TOPIC_RULES = (
    ("technical", ("código", "programar", "error", "función", "algoritmo")),
    ("creative", ("historia", "poema", "crear", "imaginar", "escribir")),
    ("informational", ("qué", "cómo", "cuándo", "dónde", "por qué")),
    ("conversational", ("hola", "gracias", "adiós", "bien", "mal")),
)
# Literal and pattern OCR corrections.
OCR_CORRECTIONS = {
    "Wixxrepia": "Wikipedia",
    "Creale": "Create",
    "Donale": "Donate",
    "Adicle": "Article",
    "Viewhistory": "View history",
}
OCR_CORRECTION_PATTERNS = {
    r"\bW[ilx]{1,2}[kq]{0,1}p[aei]{0,2}d{0,1}i{0,2}a\b": "Wikipedia",
    r"\bDonale\b": "Donate",
    r"\bCreale\b": "Create",
    r"\bAdicle\b": "Article",
    r"\bViewhistory\b": "View history",
}
# Quality band keywords.
BAND_LOW_WORDS = ("bad", "irrelevant", "nonsensical", "a bit off")
BAND_HIGH_WORDS = ("good", "excellent", "clear", "precise")
# ---------------------------------------------------------------------------


def strip(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: remove Unicode white space at both ends."""
    return F.regexp_replace(_c(c), EDGE_WS, "")


def collapse_ws(c: ColumnOrName) -> Column:
    """Python ``re.sub(r'\\s+', ' ', s)``."""
    return F.regexp_replace(_c(c), WS + "+", " ")


def drop_non_ascii(c: ColumnOrName) -> Column:
    """Python ``s.encode('ascii', errors='ignore').decode()``."""
    return F.regexp_replace(_c(c), r"[^\x{00}-\x{7F}]", "")


def words(c: ColumnOrName) -> Column:
    """Python ``s.split()``: white-space tokens, empty array for blank text.

    One regex pass: split on white-space runs, then drop the empty edge
    pieces a leading or trailing run leaves behind."""
    return F.filter(F.split(_c(c), WS + "+"), lambda w: w != "")


def punct_tokens(c: ColumnOrName) -> Column:
    """Word runs and single punctuation marks as separate tokens (Python
    ``re.findall(r"\\w+|[^\\w\\s]", s)``): the ``tokenizer="punct"`` option."""
    return F.regexp_extract_all(_c(c), F.lit(WORD + "+|[^\\pL\\pN_" + WS_CHARS + "]"), 0)


def _footer_rule(to_end_of_text: bool) -> str:
    alt = "|".join(FOOTER_WORDS)
    tail = "(?s).*" if to_end_of_text else ".*"
    # (?d): only \n ends a line, as in Python.
    return "(?iud)" + java_word_start() + "(" + alt + ")" + java_word_end() + tail


def clean_scan(c: ColumnOrName) -> Column:
    """Scan-OCR rule set (white space first, then markers, lower case).

    Because new lines are collapsed before the footer rule, a footer word
    deletes the rest of the document; this is the documented behaviour.
    """
    t = F.regexp_replace(_c(c), "\u00a0", " ")
    t = collapse_ws(t)
    t = F.regexp_replace(t, "(?iud)" + ERROR_MARKER, "")
    t = F.regexp_replace(t, "(?iu)" + NO_TEXT_MARKER, "")
    t = F.regexp_replace(t, "(?iu)https?://" + NON_WS + "+", "")
    t = F.regexp_replace(t, "(?iu)page" + WS + "*" + DIGIT + "+" + WS + "*(of" + WS + "*" + DIGIT + "+)?", "")
    t = F.regexp_replace(t, _footer_rule(False), "")
    t = drop_non_ascii(t)
    return F.lower(strip(t))


def clean_ocr(c: ColumnOrName) -> Column:
    """Layout-OCR rule set (markers first, then white space, keep case)."""
    t = F.regexp_replace(_c(c), "\u00a0", " ")
    t = F.regexp_replace(t, "(?iud)" + ERROR_MARKER, "")
    t = F.regexp_replace(t, "(?iu)" + NO_TEXT_MARKER, "")
    t = F.regexp_replace(t, "(?iu)https?://" + NON_WS + "+", "")
    t = F.regexp_replace(t, _footer_rule(False), "")
    t = F.regexp_replace(t, r"(?iu)\(Confidence:" + WS + "*" + DIGIT + r"+(\." + DIGIT + r"+)?\)", "")
    t = F.regexp_replace(t, r"(?iud)\[" + WS + r"*Source image:.*?\]", "")
    t = collapse_ws(t)
    t = F.regexp_replace(t, r"\(" + WS + r"*\)", "")
    t = drop_non_ascii(t)
    return strip(t)


def clean_wiki(c: ColumnOrName) -> Column:
    """Spanish wiki rule set."""
    t = F.regexp_replace(_c(c), "\n", " ")
    t = F.regexp_replace(t, "[•]{3,}", "")
    t = F.regexp_replace(t, "(" + "|".join(WIKI_HEADERS) + ")[^\n]*", "")
    t = F.replace(t, F.lit("etc."), F.lit("etcétera"))
    t = collapse_ws(t)
    t = F.regexp_replace(t, WS + "([,.])", "$1")
    return strip(t)


def clean_or_revert(original: ColumnOrName, cleaned: ColumnOrName, keep: float = 0.9) -> Column:
    """T4: keep the original when cleaning removed more than ``1 - keep``.

    The comparison is done in double precision like the documented rule.
    """
    o, cl = _c(original), _c(cleaned)
    return F.when(F.length(cl).cast("double") < F.lit(float(keep)) * F.length(o).cast("double"), o).otherwise(cl)


def clean_for_embedding(c: ColumnOrName, min_sentence: int = 20) -> Column:
    """T5: cut wiki header/footer, drop markers, lower, keep sentences > 20 chars."""
    t = F.regexp_replace(_c(c), r"(?s)\A.*?From Wikipedia, the free encyclopedia", "")
    t = F.regexp_replace(t, r"(?s)This page was last edited.*\z", "")
    t = F.regexp_replace(t, r"\[" + DIGIT + r"+\]", "")
    t = F.regexp_replace(t, r"\[" + WORD + r"+\]", "")
    t = F.regexp_replace(t, r"\{[^}]*\}", "")
    t = F.lower(t)
    # same matches as `http\S+|\S+@\S+`: an address is a whole non-space run
    # and never crosses a space, so only pieces with an `@` meet its pattern
    t = F.array_join(F.transform(F.split(t, " "), lambda s: F.when(F.instr(s, "@") > 0, F.regexp_replace(s, ADDRESS, "")).otherwise(s)), " ")
    t = F.regexp_replace(t, "http" + NON_WS + "+", "")
    # other characters become spaces and runs of spaces one: a run of either at once
    t = F.regexp_replace(t, r"[^\pL\pN_.,]+", " ")
    # a single space is the only white space left, so the space-only trim
    # equals str.strip() here (and avoids a regex per piece)
    parts = F.transform(F.split(t, r"\."), lambda s: F.trim(s))
    kept = F.filter(parts, lambda s: F.length(s) > min_sentence)
    return F.array_join(kept, ". ")


def clean_ascii(c: ColumnOrName) -> Column:
    """Strip, collapse white space, drop non-ASCII runs (in this order)."""
    return F.regexp_replace(collapse_ws(strip(c)), r"[^\x{00}-\x{7F}]+", "")


def clean_citations(c: ColumnOrName) -> Column:
    """Remove retrieval notes, dates and bracketed references."""
    ws, we = java_word_start(), java_word_end()
    d = DIGIT
    t = F.regexp_replace(_c(c), "(?iud)" + ws + "(retrieved|retrieval)" + we + ".*?(" + d + "{4}|" + d + "{1,2}, " + d + "{4})", "")
    t = F.regexp_replace(t, ws + d + "{1,2} [A-Za-z]+ " + d + "{4}" + we, "")
    t = F.regexp_replace(t, ws + "[A-Za-z]+ " + d + "{1,2}, " + d + "{4}" + we, "")
    t = F.regexp_replace(t, r"\[[^\]]*\]", "")
    return strip(collapse_ws(t))


def unlist(c: ColumnOrName) -> Column:
    """Text stored as a printed list ``['a', 'b']`` -> ``a  b``.

    Brackets are dropped, both quote kinds removed, commas become spaces.
    """
    x = _c(c)
    inner = F.when(F.length(x) >= 2, F.regexp_extract(x, r"(?s)\A.(.*).\z", 1)).otherwise(F.lit(""))
    body = F.regexp_replace(inner, "['\"]", "")
    return F.when(x.startswith("[") & x.endswith("]"), F.replace(body, F.lit(","), F.lit(" "))).otherwise(x)


def apply_corrections(c: ColumnOrName, mapping: dict | None = None, regex: bool = False) -> Column:
    """Fold literal (or case-insensitive pattern) corrections in order."""
    if mapping is None:
        mapping = OCR_CORRECTION_PATTERNS if regex else OCR_CORRECTIONS
    col = _c(c)
    for wrong, right in mapping.items():
        if regex:
            pat = wrong.replace(r"\b", "")
            pat = "(?iu)" + java_word_start() + pat + java_word_end() if wrong.startswith(r"\b") else "(?iu)" + wrong
            col = F.regexp_replace(col, pat, right.replace("$", r"\$"))
        else:
            col = F.replace(col, F.lit(wrong), F.lit(right))
    return col


def keep_text_lines(c: ColumnOrName, min_len: int = 3, min_words: int = 6) -> Column:
    """Keep lines with > 2 chars after strip; null unless > 5 words."""
    lines = F.transform(F.split(_c(c), "\n"), lambda s: strip(s))
    joined = F.array_join(F.filter(lines, lambda s: F.length(s) >= min_len), " ")
    return F.when(F.size(words(joined)) >= min_words, joined)


def split_path(c: ColumnOrName) -> tuple[Column, Column]:
    """``<group>_<n>.jpg`` -> (group_id, fragment_order)."""
    x = _c(c)
    gid = F.regexp_extract(x, r"(?d)(.+?)_" + DIGIT + r"+\.jpg", 1)
    order = F.regexp_extract(x, r"_(" + DIGIT + r"+)\.jpg", 1)
    return F.when(gid != "", gid), F.when(order != "", order.cast("bigint"))


def text_length(c: ColumnOrName) -> Column:
    return F.length(_c(c)).cast("bigint")


def word_count(c: ColumnOrName) -> Column:
    """``len(s.split())`` (0 for blank text)."""
    return F.size(words(c)).cast("bigint")


def composite_id(*cols: ColumnOrName, sep: str = "_") -> Column:
    """``a_b`` style ids from any columns (cast to string)."""
    return F.concat_ws(sep, *[_c(x).cast("string") for x in cols])


def cache_key(query: ColumnOrName, extra: ColumnOrName | None = None, none_tag: str = "noocr") -> Column:
    """``<query>_<first 8 hex of md5(extra)>`` or ``<query>_noocr``."""
    q = _c(query)
    if extra is None:
        return F.concat(q, F.lit("_" + none_tag))
    e = _c(extra)
    h = F.when(e.isNotNull() & (e != ""), F.substring(F.md5(e), 1, 8)).otherwise(F.lit(none_tag))
    return F.concat(q, F.lit("_"), h)


def after_marker(c: ColumnOrName, marker: str = "Answer:") -> Column:
    """Part after the last marker (or all), stripped, first line."""
    return F.substring_index(strip(F.substring_index(_c(c), marker, -1)), "\n", 1)


def first_sentences(c: ColumnOrName, n: int = 2) -> Column:
    """First ``n`` parts split on ``'. '``, rejoined, ending in '.'."""
    s = F.array_join(F.slice(F.split(_c(c), r"\. ", -1), 1, n), ". ")
    return F.when(s.endswith("."), s).otherwise(F.concat(s, F.lit(".")))


def ellipsize(c: ColumnOrName, n: int = 250, variant: str = "A") -> Column:
    """Cut to ``n`` characters with ``...``.

    Variant A: ``s[:n] + '...'`` when ``len(s) > n``.
    Variant B: ``s[:n].strip() + '...'`` when ``len(s) >= n``.
    """
    x = _c(c)
    if variant == "A":
        return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)
    return F.when(F.length(x) >= n, F.concat(strip(F.substring(x, 1, n)), F.lit("..."))).otherwise(x)


def pair_text(q: ColumnOrName, a: ColumnOrName, sep: str = " [SEP] ") -> Column:
    """``query [SEP] answer``."""
    return F.concat(_c(q), F.lit(sep), _c(a))


def unpair_text(c: ColumnOrName, sep: str = " [SEP] ") -> tuple[Column, Column]:
    """T20 inverse: split at the first separator."""
    x = _c(c)
    pos = F.locate(sep, x)
    q = F.when(pos > 0, F.substring_index(x, sep, 1)).otherwise(x)
    a = F.when(pos > 0, x.substr(pos + F.lit(len(sep)), F.lit(1 << 30)))
    return q, a


def repair_feedback(c: ColumnOrName) -> tuple[Column, Column, Column]:
    """Malformed ``prompt Answer: answer,label`` line -> 3 columns."""
    x = _c(c)
    has_comma = x.contains(",")
    head = F.regexp_extract(x, r"(?s)\A(.*),", 1)
    feedback = strip(F.regexp_extract(x, r"(?s),([^,]*)\z", 1))
    head = strip(head)
    has_ans = F.locate("Answer:", head) > 0
    prompt_part = F.when(has_ans, F.substring_index(head, "Answer:", 1)).otherwise(head)
    answer_part = F.when(has_ans, head.substr(F.locate("Answer:", head) + F.lit(7), F.lit(1 << 30))).otherwise(F.lit(""))
    answer = F.replace(F.regexp_replace(strip(answer_part), r'\A"+|"+\z', ""), F.lit("\n"), F.lit(" "))
    return (F.when(has_comma, strip(prompt_part)).otherwise(x),
            F.when(has_comma, answer).otherwise(F.lit("")),
            F.when(has_comma, feedback).otherwise(F.lit("")))


def map_label(c: ColumnOrName, scheme: str = "good_bad") -> Column:
    """T23 label maps.

    ``good_bad``: good->1, bad->0, else null.  ``yes``: contains 'Yes'->1 else 0.
    ``up``: lower contains 'up'->1 else 0.  ``good_float``: trimmed lower ==
    'good' -> 1.0 else 0.0.
    """
    x = _c(c)
    if scheme == "good_bad":
        return F.when(x == "good", F.lit(1)).when(x == "bad", F.lit(0))
    if scheme == "yes":
        return F.when(x.contains("Yes"), F.lit(1)).otherwise(F.lit(0))
    if scheme == "up":
        return F.when(F.lower(x).contains("up"), F.lit(1)).otherwise(F.lit(0))
    if scheme == "good_float":
        return F.when(F.lower(strip(x)) == "good", F.lit(1.0)).otherwise(F.lit(0.0))
    raise ValueError(f"unknown label scheme {scheme!r}")


def topic(c: ColumnOrName, rules=TOPIC_RULES, default: str = "other") -> Column:
    """First category whose keyword occurs in the lower-cased text."""
    low = F.lower(_c(c))
    expr = None
    for name, keys in rules:
        cond = reduce(lambda a, b: a | b, [low.contains(k) for k in keys])
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))


# --- predicates (P*) --------------------------------------------------------

def is_blank(c: ColumnOrName) -> Column:
    x = _c(c)
    return x.isNull() | (strip(x) == "")


def digit_count(c: ColumnOrName) -> Column:
    return F.regexp_count(_c(c), F.lit(DIGIT))


def is_useful(c: ColumnOrName, version: int = 1) -> Column:
    """P3 (v1) / P4 (v2) chunk usefulness."""
    x = _c(c)
    n = F.length(x)
    if version == 1:
        return (n >= 30) & (digit_count(x) <= 10)
    punct = reduce(lambda a, b: a + b,
                   [F.regexp_count(x, F.lit(_re_lit(p))) for p in USEFUL_V2_PUNCT])
    low = F.lower(x)
    bad = reduce(lambda a, b: a | b, [low.contains(w) for w in USEFUL_V2_BAD_WORDS])
    share = F.when(n > 0, punct.cast("double") / n.cast("double"))
    return (n >= 40) & (share <= 0.1) & ~bad & (digit_count(x) <= 5)


def _re_lit(ch: str) -> str:
    return "\\" + ch if ch in r".[]()-\^$|?*+{}" else ch


def is_gibberish(c: ColumnOrName) -> Column:
    """P5: short after strip, or contains a junk mark."""
    x = _c(c)
    junk = reduce(lambda a, b: a | b, [x.contains(m) for m in GIBBERISH_MARKS])
    return (F.length(strip(x)) < 20) | junk


def is_weak(c: ColumnOrName, phrases=GENERIC_PHRASES) -> Column:
    """Blank, or contains a generic phrase (lower case)."""
    x = _c(c)
    low = F.lower(x)
    return (strip(x) == "") | reduce(lambda a, b: a | b, [low.contains(p) for p in phrases])


def is_question_like(c: ColumnOrName) -> Column:
    """Contains '?', or explain/how/what as a substring (lower case)."""
    x = _c(c)
    low = F.lower(x)
    return x.contains("?") | reduce(lambda a, b: a | b, [low.contains(w) for w in QUESTION_WORDS])


def heuristic_reward(c: ColumnOrName, variant: int = 1) -> Column:
    """P10: +1 (+1.0) for 'summary', +0.5 (+0.2) for fewer than 80 words."""
    x = _c(c)
    has_summary, short = (1.0, 0.5) if variant == 1 else (1.0, 0.2)
    return (F.when(F.lower(x).contains("summary"), F.lit(has_summary)).otherwise(F.lit(0.0))
            + F.when(F.size(words(x)) < 80, F.lit(short)).otherwise(F.lit(0.0)))


def uniform_hash(*cols: ColumnOrName, seed: int | str = 42) -> Column:
    """Deterministic U[0,1) from md5 of (seed, cols): same in Spark and SQL."""
    key = F.concat_ws("|", F.lit(str(seed)), *[_c(x).cast("string") for x in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def quality_band(c: ColumnOrName, key: ColumnOrName, seed: int = 42) -> Column:
    """Keyword band, then a hash-seeded draw inside the band."""
    low = F.lower(_c(c))
    u = uniform_hash(key, seed=seed)
    is_low = reduce(lambda a, b: a | b, [low.contains(w) for w in BAND_LOW_WORDS])
    is_high = reduce(lambda a, b: a | b, [low.contains(w) for w in BAND_HIGH_WORDS])
    return (F.when(is_low, F.lit(0.0) + u * 0.3)
            .when(is_high, F.lit(0.7) + u * 0.3)
            .otherwise(F.lit(0.3) + u * 0.6))
