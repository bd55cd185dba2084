"""Text cleaning and text predicates (survey I1-I3, B4-B9, B13, H11).

Semantics are binary (exact) by default: equality, grouping and joins
compare code points.  ``F.trim`` removes blanks (U+0020) only, as the
modelled loads do; U+00A0 is deleted explicitly instead.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the modelled loads delete or match.
NBSP = "\u00a0"          # no-break space, deleted from names
MOJIBAKE_A = "\u00c2"    # 'Â', left over from a UTF-8/Latin-1 mix-up
TAKA = "\u09f3"          # '৳', the currency sign in price text
MICRO = "\u00b5"         # 'µ', micro sign


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _drop(c: Column, text: str) -> Column:
    return F.replace(c, F.lit(text), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """Delete no-break spaces, then trim blanks."""
    return F.trim(_drop(_col(c), NBSP))


def restore_commas(c: Column | str) -> Column:
    """Source files write ',' inside a field as ';'.  Turn it back, using the
    same NBSP deletion and trim as :func:`clean_text` so lookups on both sides
    of a join see one convention (I2)."""
    return F.trim(F.replace(_drop(_col(c), NBSP), F.lit(";"), F.lit(",")))


def strip_mojibake(c: Column | str) -> Column:
    """Delete a stray 'Â' and no-break spaces, then trim."""
    return F.trim(_drop(_drop(_col(c), MOJIBAKE_A), NBSP))


def is_present(c: Column | str) -> Column:
    """Not NULL and not the empty string."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def is_null_or_blank(c: Column | str) -> Column:
    """NULL, or only blanks."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def has_non_ascii(c: Column | str) -> Column:
    """Any character outside printable ASCII (B9).  Note that a newline
    counts, as in the modelled check."""
    return _col(c).rlike("[^ -~]")


def occurrences(c: Column | str, literal: str) -> Column:
    """Number of non-overlapping occurrences of ``literal``."""
    return F.regexp_count(_col(c), F.lit(re.escape(literal)))


def to_decimal_price(text: Column) -> Column:
    """Trim, drop thousands separators, ``try_cast`` to DECIMAL(10,2).
    Junk or overflow gives NULL instead of failing the job (H14)."""
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("decimal(10,2)")
