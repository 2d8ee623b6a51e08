"""Channels of a workflow as tables: items that belong together by a key, or that all get the same values."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_channels(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Items of equal keys side by side, each pair of them once. Null keys meet nothing.

    A column that both sides have comes from the left; the right one's is named ``<name>_right``.
    """
    taken = {c.lower() for c in left.columns}
    renamed = right.select(*(F.col(c).alias(c if c == key or c.lower() not in taken else f"{c}_right") for c in right.columns))
    return left.join(renamed, key)


def with_each(df: DataFrame, values: list[dict[str, Any]]) -> DataFrame:
    """Every item with each of the given values: a few files or settings that the driver knows, all with the same names.

    They become literals of the rows, so nothing is joined. A name that an item has already raises ValueError. No values,
    no rows.
    """
    if not values:
        return df.where("false")
    names = list(values[0])
    clash = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if clash or any(list(v) != names for v in values):
        raise ValueError(f"values need the same new names each: {', '.join(sorted(clash) or names)}")
    rows = F.array(*(F.struct(*(F.lit(v[n]).alias(n) for n in names)) for v in values))
    return df.select("*", F.inline(rows))


def with_value(df: DataFrame, **value: Any) -> DataFrame:
    """Every item with one value of each name; see ``with_each``."""
    return with_each(df, [value])
