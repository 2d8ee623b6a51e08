"""Predicates and labels over pairs of inclusive intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def near_overlap(s1: Column, e1: Column, s2: Column, e2: Column, tol: int) -> Column:
    """The intervals overlap or lie within ``tol``, and at least one pair of breakpoints is within ``tol``."""
    t = F.lit(tol)
    return (s2 <= e1 + t) & (e2 >= s1 - t) & ((F.abs(s1 - s2) <= t) | (F.abs(e1 - e2) <= t))


def overlap_length(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared bases; 0 where disjoint."""
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)


def overlap_percent(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared bases in percent of the longer interval."""
    return overlap_length(s1, e1, s2, e2) / F.greatest(e1 - s1 + 1, e2 - s2 + 1) * 100


def relation(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """How the first interval, which overlaps the second, lies to it."""
    return (
        F.when((s1 == s2) & (e1 == e2), "exact_coordinates")
        .when((s1 >= s2) & (e1 <= e2), "nested_in")
        .when((s1 <= s2) & (e1 >= e2), "contains")
        .otherwise("overlap")
    )


def linked_relation(s1: Column, e1: Column, s2: Column, e2: Column, tol: int) -> Column:
    """``relation`` of overlapping intervals; for disjoint ones a label if both ends lie within ``tol``, else null."""
    overlaps = (s1 <= e2) & (s2 <= e1)
    close = (F.abs(s1 - s2) <= tol) & (F.abs(e1 - e2) <= tol)
    label = F.when(overlaps, relation(s1, e1, s2, e2))
    return label.when(F.lit(tol > 0) & close, f"same_coordinates_within_{tol}bp") if tol > 0 else label


def _two_decimals(p: Column) -> Column:
    """A number from 0 to 100 with two decimals, rounded by its exact binary value and ties to even, as C prints it.

    The number is split into two of fewer bits, whose hundredfolds are exact.
    """
    high = p.cast("float").cast("double")
    whole = F.floor(high * 100)
    beyond_half = (high * 100 - whole - 0.5) + (p - high) * 100
    up = (beyond_half > 0) | ((beyond_half == 0) & (whole % 2 == 1))
    n = whole + up.cast("long")
    return F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))


def format_percents(values: Column) -> Column:
    """Percentages as text: whole ones without decimals, others with two, separated by comma and blank."""
    one = lambda p: F.concat(F.when(p == F.floor(p), F.floor(p).cast("string")).otherwise(_two_decimals(p)), F.lit("%"))
    return F.array_join(F.transform(values, one), ", ")


def format_link(event_id: Column, std_type: Column, chrom: Column, start: Column, end: Column, rel: Column) -> Column:
    return F.format_string("%s (%s, %s:%d-%d, %s)", event_id, std_type, chrom, start, end, rel)
