"""Algebra of closed intervals, structs (first, second)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def region(first: Column, second: Column) -> Column:
    return F.struct(first.cast("long").alias("first"), second.cast("long").alias("second"))


def region_overlap(a: Column | str, b: Column | str) -> Column:
    """Places that both intervals have; 0 or less if there is none."""
    a, b = _c(a), _c(b)
    return F.least(a["second"], b["second"]) - F.greatest(a["first"], b["first"]) + 1


def region_union(a: Column | str, b: Column | str) -> Column:
    """One interval if they overlap, else both in order."""
    a, b = _c(a), _c(b)
    one = F.array(region(F.least(a["first"], b["first"]), F.greatest(a["second"], b["second"])))
    return F.when(region_overlap(a, b) > 0, one).otherwise(F.array_sort(F.array(region(a["first"], a["second"]), region(b["first"], b["second"]))))


def region_minus(a: Column | str, b: Column | str) -> Column:
    """What is left of ``a`` without ``b``; empty if they do not overlap."""
    a, b = _c(a), _c(b)
    left, right = region(a["first"], b["first"] - 1), region(b["second"] + 1, a["second"])
    return F.when(region_overlap(a, b) <= 0, F.array().cast("array<struct<first:bigint,second:bigint>>")).otherwise(F.filter(F.array(left, right), lambda r: r["first"] <= r["second"]))
