"""Text rules of the partner-CSV cleanup (FN-1..FN-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _regex_literal(s: str) -> str:
    """Escape a literal for a Java regex."""
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in s)


def _replacement_literal(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def replace_first(c: Column, pattern: str, replacement: str, literal: bool = True) -> Column:
    """stringr ``str_replace``: replace the **first** match only (Spark's
    ``regexp_replace`` replaces every match).  ``(?s)^(.*?)`` captures the
    shortest prefix before the first match and puts it back."""
    pat = _regex_literal(pattern) if literal else pattern
    rep = _replacement_literal(replacement) if literal else replacement
    return F.regexp_replace(c, F.lit(f"(?s)^(.*?){pat}"), F.lit(f"$1{rep}"))


def replace_first_chain(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Apply first-match rewrites one after the other, in list order (each
    sees the previous one's output, so order matters)."""
    for pattern, replacement in rules:
        c = replace_first(c, pattern, replacement)
    return c


def blank_to_null(c: Column) -> Column:
    """``ifelse(x == "", NA, x)``."""
    return F.nullif(c, F.lit(""))


def exact_fix(c: Column, wrong: str, right: str) -> Column:
    """Whole-value correction: ``ifelse(x == wrong, right, x)``; an NA stays NA."""
    return F.when(c == F.lit(wrong), F.lit(right)).otherwise(c)


def r_text(c: Column) -> Column:
    """A field as R's ``read.csv`` gives a character column: an empty field
    is ``""`` and the text ``NA`` is missing.  Spark's CSV reader returns an
    empty field as null, so null becomes ``""`` first."""
    return F.nullif(F.coalesce(c, F.lit("")), F.lit("NA"))
