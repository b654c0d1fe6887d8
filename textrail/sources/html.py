"""HTML pages -> paragraph text.

Paragraphs follow HTML5 parsing: a ``<p>`` ends at ``</p>``, at the next
``<p>``, or at the end of its container.  Scripts, styles and comments are
removed first (a script may contain the text ``</p>``), inner tags are
dropped and the basic character entities decoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
DROP_BLOCKS = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
CONTAINER_ENDS = ("article", "div", "body", "section", "main", "td", "li", "blockquote", "html")
PARAGRAPH = (r"(?is)<p\b[^>]*>(.*?)(?=</p>|<p\b|</(?:" + "|".join(CONTAINER_ENDS) + r")>|\z)")
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
# ---------------------------------------------------------------------------


def paragraph_texts(html: Column) -> Column:
    """All paragraph texts of a page, in document order."""
    body = F.regexp_replace(html, DROP_BLOCKS, "")
    paras = F.regexp_extract_all(body, F.lit(PARAGRAPH), 1)

    def text(p):
        t = F.regexp_replace(p, "<[^>]*>", "")
        for ent, ch in ENTITIES:
            t = F.replace(t, F.lit(ent), F.lit(ch))
        return t
    return F.transform(paras, text)


def html_paragraphs(df: DataFrame, html_col: str = "html", n: int = 20, out: str = "text") -> DataFrame:
    """The first ``n`` paragraph texts of each page joined by a space."""
    return df.withColumn(out, F.array_join(F.slice(paragraph_texts(F.col(html_col)), 1, n), " ")).drop(html_col)
