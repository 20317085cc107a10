"""Column expressions used by more than one operator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# The characters that count as white space.
WHITE_SPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a" \
              "\u2028\u2029\u202f\u205f\u3000"


def strip_text(column: Column) -> Column:
    """Cast to text and strip white space of every kind, tabs and line ends included, at both ends."""
    return F.btrim(column.cast("string"), F.lit(WHITE_SPACE))


def signed_log(column: Column) -> Column:
    """log1p of the magnitude with the sign kept: tames heavy tails that reach below zero."""
    return F.signum(column) * F.log1p(F.abs(column))


def calendar_days(end: Column, start: Column) -> Column:
    """Difference of the two calendar dates in days."""
    return F.datediff(end, start)


def elapsed_days(end: Column, start: Column) -> Column:
    """Whole 24-hour periods between two instants: 1 for 47 hours, where calendar days may be 2."""
    return F.timestamp_diff("DAY", start, end).cast("int")


def next_day_after(column: Column) -> Column:
    return column + F.expr("interval 1 day")


def round_half_even(column: Column, scale: int = 0) -> Column:
    return F.bround(column, scale)
