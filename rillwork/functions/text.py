"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def literal(text: str) -> str:
    """A regular expression that matches the text itself."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def token(text: str | Column, position: int, separator: str = " ") -> Column:
    """The token at a position from 0, null where there are fewer."""
    return F.get(F.split(_column(text), literal(separator)), position)


def words(text: str | Column) -> Column:
    """Tokens of the text's lines between blanks, empty ones removed."""
    one_line = F.replace(_column(text), F.lit("\n"), F.lit(" "))
    return F.array_remove(F.split(one_line, " "), "")


def lines(text: str | Column) -> Column:
    return F.split(_column(text), "\n")


def blank_lines(text: str | Column) -> Column:
    """How many lines of the text are empty."""
    every = lines(text)
    return (F.size(every) - F.size(F.array_remove(every, ""))).cast("bigint")


def api_name(link: str | Column) -> Column:
    """What follows the last slash in the link's first three dot-separated parts."""
    return F.substring_index(F.substring_index(_column(link), ".", 3), "/", -1)
