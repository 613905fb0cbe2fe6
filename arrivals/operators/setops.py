"""Set operations over relations with the same column order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position (the first frame's names win)."""
    if not frames:
        raise ValueError("union of no frames")
    return reduce(DataFrame.union, frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION DISTINCT of many frames as one plan: one union, one distinct.

    Folding ``union().distinct()`` pairwise would stack a shuffle per step
    for the optimizer to collapse; the single distinct over the whole union
    is the same set with exactly one partial/final aggregate.
    """
    return union_all(frames).distinct()
