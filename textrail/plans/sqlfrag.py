"""DuckDB SQL fragments used by the oracle queries.

The oracle is independent SQL over the same parquet tables.  RE2 has no
look-around, so word boundaries are spelled with explicit groups; the
character classes come from :mod:`textrail.functions.patterns`, which are
valid in both Java and RE2.
"""

from __future__ import annotations

from ..functions.patterns import DIGIT, NON_WS, WS

EMPTY_LIST = "CAST([] AS VARCHAR[])"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx(x: str, pat: str, rep: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pat)}, {q(rep)}, {q(flags)})"


def strip(x: str) -> str:
    return rx(x, r"\A" + WS + r"+|" + WS + r"+\z")


def collapse(x: str) -> str:
    return rx(x, WS + "+", " ")


def non_ascii(x: str) -> str:
    return rx(x, r"[^\x{00}-\x{7F}]")


def words(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN {s} = '' THEN {EMPTY_LIST} ELSE regexp_split_to_array({s}, {q(WS + '+')}) END)"


def _footer(x: str, to_end: bool) -> str:
    if to_end:
        return rx(x, r"(^|[^\pL\pN_])(?i:source|references|footer)([^\pL\pN_].*|$)", r"\1")
    return rx(x, r"(^|[^\pL\pN_])(?i:source|references|footer)([^\pL\pN_\n][^\n]*|(\n)|$)", r"\1\3")


def clean_scan(x: str) -> str:
    t = f"replace({x}, chr(160), ' ')"
    t = collapse(t)
    t = rx(t, r"(?i)\[ERROR[^\n]*?\]")
    t = rx(t, r"(?i)\[NO TEXT DETECTED\]")
    t = rx(t, r"(?i)https?://" + NON_WS + "+")
    t = rx(t, r"(?i)page" + WS + "*" + DIGIT + "+" + WS + "*(of" + WS + "*" + DIGIT + "+)?")
    t = _footer(t, True)
    t = non_ascii(t)
    return f"lower({strip(t)})"


def clean_ocr(x: str) -> str:
    t = f"replace({x}, chr(160), ' ')"
    t = rx(t, r"(?i)\[ERROR[^\n]*?\]")
    t = rx(t, r"(?i)\[NO TEXT DETECTED\]")
    t = rx(t, r"(?i)https?://" + NON_WS + "+")
    t = _footer(t, False)
    t = rx(t, r"(?i)\(Confidence:" + WS + "*" + DIGIT + r"+(\." + DIGIT + r"+)?\)")
    t = rx(t, r"(?i)\[" + WS + r"*Source image:[^\n]*?\]")
    t = collapse(t)
    t = rx(t, r"\(" + WS + r"*\)")
    t = non_ascii(t)
    return strip(t)


def noisy_text(doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> str:
    """OCR-style markers injected around a document (same literal as the
    Spark side in :func:`textrail.plans.common.noisy_text`)."""
    return ("concat('[Source image: ', CAST(" + doc_id + " AS VARCHAR), '.png]', chr(10), chr(10), " + text +
            ", chr(10), '[ERROR reading block 7]', "
            "CASE WHEN " + lang + " = 'de' THEN concat(chr(10), 'References and notes') ELSE '' END, "
            "' (Confidence: 0.96) ( ) see http://img.example.com/', CAST(" + doc_id + " AS VARCHAR), "
            "' Page 3 of 10', chr(160), '[NO TEXT DETECTED]')")


def round6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def clean_wiki(x: str) -> str:
    t = f"replace({x}, chr(10), ' ')"
    t = rx(t, "[•]{3,}")
    t = rx(t, "(Wikipedia|Artículo|Editar|Ver historial|Desde Wikipedia)[^\\n]*")
    t = f"replace({t}, 'etc.', 'etcétera')"
    t = collapse(t)
    t = rx(t, WS + "([,.])", r"\1")
    return strip(t)


def clean_or_revert(orig: str, cleaned: str) -> str:
    return f"(CASE WHEN CAST(length({cleaned}) AS DOUBLE) < 0.9 * CAST(length({orig}) AS DOUBLE) THEN {orig} ELSE {cleaned} END)"


def clean_for_embedding(x: str) -> str:
    t = rx(x, r"(?s)\A.*?From Wikipedia, the free encyclopedia", "", "")
    t = rx(t, r"(?s)This page was last edited.*\z", "", "")
    t = rx(t, r"\[" + DIGIT + r"+\]")
    t = rx(t, r"\[[\pL\pN_]+\]")
    t = rx(t, r"\{[^}]*\}")
    t = f"lower({t})"
    t = rx(t, "http" + NON_WS + "+|" + NON_WS + "+@" + NON_WS + "+")
    from ..functions.patterns import WS_CHARS
    t = rx(t, r"[^\pL\pN_" + WS_CHARS + r".,]", " ")
    t = strip(collapse(t))
    parts = f"list_transform(string_split({t}, '.'), lambda s: {strip('s')})"
    return f"array_to_string(list_filter({parts}, lambda s: length(s) > 20), '. ')"


def clean_ascii(x: str) -> str:
    return rx(collapse(strip(x)), r"[^\x{00}-\x{7F}]+")


def clean_citations(x: str) -> str:
    d = DIGIT
    t = rx(x, r"(?i)\b(retrieved|retrieval)\b[^\n]*?(" + d + "{4}|" + d + "{1,2}, " + d + "{4})")
    t = rx(t, r"\b" + d + "{1,2} [A-Za-z]+ " + d + r"{4}\b")
    t = rx(t, r"\b[A-Za-z]+ " + d + "{1,2}, " + d + r"{4}\b")
    t = rx(t, r"\[[^\]]*\]")
    return strip(collapse(t))


def after_marker(x: str, marker: str) -> str:
    last = f"(CASE WHEN strpos({x}, {q(marker)}) > 0 THEN string_split({x}, {q(marker)})[-1] ELSE {x} END)"
    return f"string_split({strip(last)}, chr(10))[1]"


def ellipsize(x: str, n: int, variant: str) -> str:
    if variant == "A":
        return f"(CASE WHEN length({x}) > {n} THEN concat(substr({x}, 1, {n}), '...') ELSE {x} END)"
    return f"(CASE WHEN length({x}) >= {n} THEN concat({strip(f'substr({x}, 1, {n})')}, '...') ELSE {x} END)"


def uniform_hash(key_sql: str, seed) -> str:
    """md5-based U[0,1): same as textrail.functions.text.uniform_hash."""
    k = f"concat_ws('|', '{seed}', CAST({key_sql} AS VARCHAR))"
    return f"(CAST(('0x' || substr(md5({k}), 1, 8))::UBIGINT AS DOUBLE) / 4294967296.0)"
