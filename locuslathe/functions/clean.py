"""Column expressions for coordinates and names as the call tables hold them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bare_chrom(c: Column | str) -> Column:
    """The chromosome without surrounding blanks; null where nothing is left."""
    return F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit(""))


def low(a: Column | str, b: Column | str) -> Column:
    """The smaller coordinate; null if either is null (``least`` would skip nulls)."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def high(a: Column | str, b: Column | str) -> Column:
    """The larger coordinate; null if either is null."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))
