"""Column expressions shared by the operators: words, lines, local names.

A word is a run of characters other than space and the controls 9 to 13; other
Unicode spaces belong to words. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body (and
    the lambdas in it) use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(docs: DataFrame, without: tuple[str, ...] = ("text",)) -> Column:
    """A row's columns as one struct named `row`, so that columns of any name
    pass through an operator without meeting its own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("row")


def unpacked(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of a table in their order out of `row`, some of them new; a
    text that changed has its length in n_chars again."""
    if "text" in new and "n_chars" in docs.columns:
        new["n_chars"] = F.length(new["text"]).cast(docs.schema["n_chars"].dataType)
    return [new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns]


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    even = F.translate(whole(text), SPACES[1:], " " * (len(SPACES) - 1))
    return F.filter(F.split(even, " "), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def plain_lines(text: Column) -> Column:
    """Lines in the form in which they are compared: lower case, inner runs of
    spaces as one, none at the ends. Lines without a word are ''."""
    even = F.regexp_replace(F.lower(whole(text)), r"[ \t\x0B\f\r]+", " ")
    return F.transform(F.split(even, "\n"), lambda line: F.btrim(line))
