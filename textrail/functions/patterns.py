"""Regex building blocks that behave the same in Java (Spark) and RE2 (DuckDB).

The cleaning rules were written against Python's ``re`` on ``str``: there
``\\s`` is Unicode white space, ``\\w`` is any Unicode letter/digit plus
``_``, ``\\d`` any decimal digit and ``.`` everything but ``\\n``.  Java and
RE2 default to ASCII classes, so the rules below spell the classes out.
Both engines accept ``\\x{...}`` escapes and ``\\p{..}`` classes.
"""

# --- fixed values: character classes matching Python's str semantics -------
# Python str.isspace(): \t \n \x0b \x0c \r \x1c-\x1f space \x85 \xa0
# \u1680 \u2000-\u200a \u2028 \u2029 \u202f \u205f \u3000
WS_CHARS = (r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}"
            r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = "[" + WS_CHARS + "]"          # Python \s
NON_WS = "[^" + WS_CHARS + "]"     # Python \S
WORD = r"[\pL\pN_]"                # Python \w
NON_WORD = r"[^\pL\pN_]"           # Python \W
DIGIT = r"\p{Nd}"                  # Python \d
NON_NL = r"[^\n]"                  # Python '.' without DOTALL
EDGE_WS = r"\A" + WS + r"+|" + WS + r"+\z"   # what str.strip() removes


def java_word_start() -> str:
    """Java look-behind equivalent of a leading ``\\b`` before a word char."""
    return r"(?<!" + WORD + r")"


def java_word_end() -> str:
    """Java look-ahead equivalent of a trailing ``\\b`` after a word char."""
    return r"(?!" + WORD + r")"
