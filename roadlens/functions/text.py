"""Scalar Column helpers for text records (J2, J10, A5, F20 tokenising).

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def pad_trailing_comma(line: Column) -> Column:
    """A line ending in exactly one comma gets another one.

    One regex over the line (it references ``line`` once, so an upstream
    expression producing the line is never evaluated twice)."""
    return F.regexp_replace(line, r"(?<!,),\z", ",,")


def unquote(line: Column) -> Column:
    """``", "`` becomes two blanks everywhere, then quote marks vanish; a quoted
    comma without a blank after it still separates fields."""
    return F.regexp_replace(F.regexp_replace(line, ", ", "  "), '"', "")


def csv_fields(line: Column) -> Column:
    """Comma-split fields (trailing empty fields kept)."""
    return F.split(unquote(pad_trailing_comma(line)), ",", -1)


def field(items: Column, i: int) -> Column:
    """0-based field ``i`` or null when the line is shorter."""
    return F.try_element_at(items, F.lit(i + 1))


def yes_flag(v: Column) -> Column:
    """``yes`` in any case is true, anything else (also empty) false; absent null."""
    return F.lower(v) == "yes"


def words(text: Column) -> Column:
    """Words of a text: lines split on newline, words on single blanks; empty
    words between adjacent separators are kept."""
    return F.split(text, "[ \\n]", -1)


def violation_record(items: Column) -> list[Column]:
    """The 35 named, typed columns of one violations line (A5), from its
    ``csv_fields`` array (computed once by the caller)."""
    cols = []
    for i, name in enumerate(S.VIOLATION_COLUMNS):
        v = field(items, i)
        if i in S.VIOLATION_BOOL_POSITIONS:
            c = yes_flag(v)
        else:
            c = F.nullif(v, F.lit(""))
            if name in S.VIOLATION_DOUBLE_COLUMNS:
                c = c.try_cast("double")
            elif name in S.VIOLATION_INT_COLUMNS:
                c = c.try_cast("int")
        cols.append(c.alias(name))
    return cols
