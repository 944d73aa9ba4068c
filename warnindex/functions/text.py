"""Substring predicates and report formatting columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from warnindex.params import COASTAL_KEYWORDS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(c, words) -> Column:
    """True when the text contains any of ``words`` (case-sensitive); null text -> false."""
    text = F.coalesce(_col(c), F.lit(""))
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words], F.lit(False))


def class_from_text(c="riverOrSea", words=COASTAL_KEYWORDS) -> Column:
    """Coastal/tidal when the lower-cased text contains any keyword (plain substring)."""
    return contains_any(F.lower(F.coalesce(_col(c), F.lit(""))), words)


def arrow(change) -> Column:
    ch = _col(change)
    return F.when(ch > 0, "^").when(ch < 0, "v").otherwise("-")


def bar(value, step: float = 5.0, mark: str = "#") -> Column:
    """One mark per whole ``step`` points (truncated toward zero; negative -> empty)."""
    n = (_col(value) / F.lit(float(step))).cast("int")
    return F.repeat(F.lit(mark), F.greatest(n, F.lit(0)))
