"""Casts with R's NA-on-failure behaviour (ANSI mode raises on bad casts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_MIN = -2147483647.0  # R's smallest integer (-2^31 is NA in R)
_INT_LIMIT = 2147483648.0


def try_double(c: Column) -> Column:
    """Text or number to double; null when blank, ``NA`` or not a number."""
    return c.cast("string").try_cast("double")


def r_as_integer(c: Column) -> Column:
    """``as.integer(x)``: text or numbers to int, truncating decimals toward
    zero, null when the value does not parse or does not fit (R gives NA).
    A direct ``try_cast('12.7' as int)`` would be null, hence the double step."""
    dbl = try_double(c)
    fits = (dbl >= F.lit(_INT_MIN)) & (dbl < F.lit(_INT_LIMIT))
    return F.when(fits, dbl.cast("long").cast("int"))
