"""Text to number and missing-value rules of the call tables' loader."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that a table reader takes for a missing value
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
_FLOAT = r"^\s*[+-]?(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+)?\s*$"


def is_missing(c: Column) -> Column:
    """Null, blank, or a text that stands for a missing value."""
    return c.isNull() | F.trim(c).eqNullSafe("") | c.isin(*NA_TOKENS)


def to_float(c: Column) -> Column:
    """The number a text holds, or null. ``.``, words, infinities and texts in other notations give null."""
    text = c.cast("string")
    d = F.when(text.rlike(_FLOAT), F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("double"))
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def to_int(c: Column) -> Column:
    """The number a text holds, cut toward zero; null if there is none or it exceeds 64 bits."""
    d = to_float(c)
    exact = F.trim(c.cast("string")).try_cast("long")
    return F.coalesce(exact, F.when(F.abs(d) < F.lit(9.2e18), d).cast("long"))
