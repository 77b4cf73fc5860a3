"""Expressions on ordered id lists (all of bounded length: at most k ids)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def interleave(first: Column, second: Column) -> Column:
    """first[0], second[0], first[1], ... up to the shorter list."""
    shorter = F.least(F.size(first), F.size(second))
    pairs = F.zip_with(
        F.slice(first, F.lit(1), shorter),
        F.slice(second, F.lit(1), shorter),
        lambda a, b: F.array(a, b),
    )
    return F.flatten(pairs)


def keep_first(ids: Column) -> Column:
    """Drop repeats, keep the first occurrence of each id."""
    return F.array_distinct(ids)


def head(ids: Column, k: int) -> Column:
    return F.slice(ids, 1, k)
