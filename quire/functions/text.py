"""Text as Column expressions: classes of characters, normal forms, escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: every white space character: the ASCII ones, the information separators, next line, and all Unicode separators
SPACE = "[\\s\\x1c-\\x1f\\x85\\p{Z}]"
NOT_SPACE = "[^" + SPACE[1:]
REPLACEMENT = "�"


def without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(NOT_SPACE)


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def html_escape(text: Column, quote: bool = True) -> Column:
    out = text
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")) + ((('"', "&quot;"), ("'", "&#x27;")) if quote else ()):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def markdown_escape(text: Column) -> Column:
    """Backslashes, inline marks, and marks that would begin a heading, quote, list or rule."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.regexp_replace(out, "([`*_\\[\\]<>|~])", "\\\\$1")
    out = F.regexp_replace(out, "(?m)^(\\s*)([#>+-])(?=\\s)", "$1\\\\$2")
    out = F.regexp_replace(out, "(?m)^(\\s*)(\\d+)([.)])(?=\\s)", "$1$2\\\\$3")
    return F.regexp_replace(out, "(?m)^(\\s*)(---+)(\\s*)$", "$1\\\\$2$3")


def clean_markers(text: Column) -> Column:
    """Without the markers that stand for nested tables in cell text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "(?:\\n)?\\[嵌套表格\\s+[^\\]]+\\]", "")


def to_int(text: Column, default: int) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(default))


def switched_on(present: Column, value: Column) -> Column:
    """A boolean element: absent is off; present is on unless its value says otherwise."""
    return present & ~F.coalesce(F.lower(value).isin("0", "false", "off", "none"), F.lit(False))


def document_name(stem: Column, content: Column) -> Column:
    return F.concat(stem, F.lit("-"), F.substring(F.sha2(content, 256), 1, 8))
