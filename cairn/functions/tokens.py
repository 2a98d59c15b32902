"""Tokenisation with the exact semantics of a Java ``String.split(" ")``.

Contract (C1): the separator is U+0020 only; trailing empty tokens are dropped while leading
and interior ones are kept; ``""`` gives one empty token; a string of spaces gives none.
No case folding or punctuation stripping (C4).  NULL text gives NULL (no tokens).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the line terminators recognised when a text column is split into lines,
# the same set Hadoop's line reader accepts: CRLF, CR, LF.
LINE_BREAK_REGEX = "\r\n|\r|\n"
# Fixed value: Java's Scanner default delimiter (any run of Java whitespace).
JAVA_WHITESPACE_REGEX = r"\p{javaWhitespace}+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def space_tokens(text: Column | str) -> Column:
    """array<string> of the tokens of ``text`` split on single spaces (C1)."""
    t = _col(text)
    stripped = F.rtrim(t)  # removes trailing U+0020 only
    only_spaces = (t != F.lit("")) & (stripped == F.lit(""))
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(
        F.split(stripped, " ", -1))


def utf16_length(word: Column | str) -> Column:
    """Length in UTF-16 code units, as Java ``String.length()`` counts (C3)."""
    return (F.octet_length(F.encode(_col(word), "UTF-16BE")) / F.lit(2)).cast("int")


def whitespace_tokens(text: Column | str) -> Column:
    """Non-empty tokens separated by runs of Java whitespace (number files, SRC1)."""
    return F.filter(F.split(_col(text), JAVA_WHITESPACE_REGEX, -1), lambda s: s != F.lit(""))


def line_split(text: Column | str) -> Column:
    """array<string> of the lines of a text value (CRLF, CR or LF), as a line reader gives
    them: a final line break opens no further line, an empty text has no lines."""
    parts = F.split(_col(text), LINE_BREAK_REGEX, -1)
    return F.when(F.element_at(parts, -1) == F.lit(""),
                  F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
