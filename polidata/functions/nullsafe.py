"""NULL semantics of the reference's data-frame language, as Spark Columns.

Spark aggregates skip NULL; R's ``mean/sum/min/max`` without ``na.rm`` return
NA as soon as one input is NA.  ``sum(x, na.rm=TRUE)`` over an all-NA group is
0 in R and NULL in Spark.  ``if_else(NA, a, b)`` is NA in R while Spark's
``when`` takes the else branch.  These helpers make each rule explicit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict(agg, c: ColumnOrName) -> Column:
    """``agg(c)`` that is NULL when any input row has NULL ``c`` (R default)."""
    c = _c(c)
    return F.when(F.count(F.lit(1)) == F.count(c), agg(c))


def strict_avg(c: ColumnOrName) -> Column:
    return strict(F.avg, c)


def strict_sum(c: ColumnOrName) -> Column:
    return strict(F.sum, c)


def strict_min(c: ColumnOrName) -> Column:
    return strict(F.min, c)


def strict_max(c: ColumnOrName) -> Column:
    return strict(F.max, c)


def sum_na_zero(c: ColumnOrName) -> Column:
    """``sum(x, na.rm = TRUE)``: NULLs skipped, an all-NULL group gives 0."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def if_else(cond: Column, yes, no) -> Column:
    """R ``if_else``: NULL condition gives NULL, not the else branch."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def str_c(*cols: ColumnOrName, sep: str = "") -> Column:
    """``str_c``: NULL if any part is NULL (``concat_ws`` would skip it)."""
    cs = [_c(c) for c in cols]
    if not sep:
        return F.concat(*cs)
    parts = []
    for i, c in enumerate(cs):
        if i:
            parts.append(F.lit(sep))
        parts.append(c)
    return F.concat(*parts)


def row_sum(*cols: ColumnOrName, na_rm: bool) -> Column:
    """Row-wise sum; ``na_rm`` treats NULL as 0, otherwise any NULL gives NULL."""
    cs = [_c(c) for c in cols]
    if na_rm:
        cs = [F.coalesce(c, F.lit(0)) for c in cs]
    return reduce(lambda a, b: a + b, cs)


def null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition that pairs NULL keys like a data-frame ``left_join``."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split_part(c: ColumnOrName, sep_regex: str, k: int) -> Column:
    """k-th (1-based) piece of a split; a missing piece is '' like
    ``simplify=T``; NULL input stays NULL."""
    c = _c(c)
    return F.when(c.isNotNull(), F.coalesce(F.get(F.split(c, sep_regex), k - 1), F.lit("")))
