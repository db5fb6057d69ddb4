"""Text cleaning expressions (F1, F2, F4) and HTML entity decoding.

All of these are built-in Column expressions: they run inside whole-stage
codegen on the executors. Texts may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of Python's ``str.isspace`` (which the
# original cleaner's ``re.sub(r"\s+", ...)`` and ``str.strip`` use), written as a
# Java-regex character class. Java's plain ``\s`` misses U+00A0 and friends.
WHITESPACE_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)

# Same class in RE2 syntax for the DuckDB oracle.
WHITESPACE_CLASS_RE2 = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)

# HTML entities decoded in page text, ``&amp;`` last so that
# ``&amp;lt;`` becomes ``&lt;`` and not ``<``.
HTML_ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_whitespace(c: Column | str) -> Column:
    """NULL/empty -> '', every whitespace run (NBSP included) -> one space, trimmed."""
    collapsed = F.regexp_replace(F.coalesce(_col(c), F.lit("")), WHITESPACE_CLASS + "+", " ")
    return F.trim(collapsed)


def clean_string_whitespace(c: Column | str) -> Column:
    """F1 under its original name (a Column expression here)."""
    return clean_whitespace(c)


def strip_html_tags(c: Column | str) -> Column:
    """Remove markup tags, keeping the text between them."""
    return F.regexp_replace(_col(c), "<[^>]*>", "")


def decode_entities(c: Column | str) -> Column:
    out = _col(c)
    for entity, char in HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def html_text(c: Column | str) -> Column:
    """Visible text of an HTML fragment: tags dropped, entities decoded, whitespace cleaned."""
    return clean_whitespace(decode_entities(strip_html_tags(c)))


_PLAYER_LINK = "See Player Page"
# What white space to collapse needs at least: a character beyond the printable ASCII ones, or two spaces.
_SPACED = "[^ -~]|  "


def _without_label(text: Column, label: Column) -> Column:
    raw = F.coalesce(text, F.lit(""))
    cut = F.overlay(raw, F.lit(""), F.instr(raw, label), F.length(label))
    return F.when(F.contains(raw, label), cut).otherwise(raw)


def even_space(text: Column) -> Column:
    """:func:`clean_whitespace` of a text that is there, for a plain column: the pattern is tried on those only that can hold it."""
    return F.trim(F.when(F.rlike(text, F.lit(_SPACED)), F.regexp_replace(text, WHITESPACE_CLASS + "+", " ")).otherwise(text))


def _without_quotes(text: Column) -> Column:
    link = F.contains(F.lower(text), F.lit(_PLAYER_LINK.lower()))
    text = F.when(link, F.trim(F.regexp_replace(text, f"(?i){_PLAYER_LINK}", ""))).otherwise(text)
    for quoted, plain in ((": '", ": "), (".'", "."), ("?'", "?")):
        text = F.replace(text, F.lit(quoted), F.lit(plain))
    # strip("'") then strip('"'), then whitespace
    return F.trim(F.btrim(F.btrim(text, F.lit("'")), F.lit('"')))


# F2 step by step: each names its text more than once, so a caller with many texts computes one after another.
INJURY_TEXT_STEPS = (_without_label, lambda text, label: even_space(text), lambda text, label: _without_quotes(text))


def clean_injury_text(c: Column | str, label: str) -> Column:
    """the grid cell cleaner.

    Drops the first occurrence of the cell's mobile ``label``, collapses
    whitespace, removes "See Player Page" in any case, unwraps manager quotes
    (``: '`` -> ``: ``, ``.'`` -> ``.``, ``?'`` -> ``?``) and strips outer
    quotes.
    """
    text = _col(c)
    for step in INJURY_TEXT_STEPS:
        text = step(text, F.lit(label))
    return text
