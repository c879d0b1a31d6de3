"""Expressions and column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, new: Iterable[str]) -> list[Column]:
    """The columns of `df` that an output does not replace."""
    new = {n.lower() for n in new}
    return [quoted(c) for c in df.columns if c.lower() not in new]


def with_outputs(df: DataFrame, **outputs: Column) -> DataFrame:
    """Add columns in one projection; an input column of the same name is replaced."""
    return df.select(*others(df, outputs), *[c.alias(n) for n, c in outputs.items()])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(quoted(text).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def word_count(text: str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")
