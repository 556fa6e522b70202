"""Blank-aware arithmetic and counting (measure semantics).

A measure engine treats BLANK differently from SQL NULL:

* a division by zero or by BLANK gives BLANK, not an error;
* a distinct count counts BLANK as one more value;
* BLANK behaves as 0 in ``+``, ``-`` and comparisons.

These helpers express those rules as plain Spark columns so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ddivide(num, den, alternate=None) -> Column:
    """num / den; BLANK (null) - or ``alternate`` - when den is 0 or null."""
    q = F.try_divide(_c(num).cast("double"), F.when(_c(den) != 0, _c(den)))
    return q if alternate is None else F.coalesce(q, F.lit(alternate))


def blank0(x) -> Column:
    """Value with BLANK read as 0, as in ``+``, ``-`` and comparisons."""
    return F.coalesce(_c(x), F.lit(0))


def dcount_blank(x) -> Column:
    """Distinct count that counts a null as one value (aggregate)."""
    c = _c(x)
    return (F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))).cast("long")


def count_nonblank(x) -> Column:
    """COUNT / COUNTA: rows where the value is not blank (aggregate)."""
    return F.count(_c(x))
