"""Ratios, scores, bins and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the engagement score.
ENGAGEMENT_WEIGHTS = {"ev_play": 1.0, "ev_pause": 0.5, "ev_next": 1.2, "active_days": 3.0, "sessions": 2.0}

# Lower percentile bounds of the risk segments.
RISK_BANDS = ((80.0, "High Risk"), (40.0, "Medium Risk"))
LOWEST_RISK = "Low Risk"


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0 where that is undefined."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Sum of column x weight with nulls counted as 0."""
    return reduce(add, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(w) for c, w in weights.items()])


def evenly_spaced(start: float, stop: float, count: int) -> list[float]:
    """``count`` points from ``start`` to ``stop``, both included."""
    if count < 2:
        return [start][:count]
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def right_closed_bin(value: Column, edges: Sequence[float]) -> Column:
    """Index of the bin (edge[i], edge[i+1]] holding ``value``; the first bin also takes its left edge.

    Null for values outside the edges.
    """
    index = reduce(add, [(value > F.lit(e)).cast("int") for e in edges[1:-1]], F.lit(0))
    return F.when(value.between(edges[0], edges[-1]), index)


def label_at(score: Column, threshold: float | Column) -> Column:
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when(score >= threshold, 1).otherwise(0)


def risk_band(percentile: Column) -> Column:
    chain = F
    for bound, name in RISK_BANDS:
        chain = chain.when(percentile >= bound, name)
    return chain.otherwise(LOWEST_RISK)


def percent_text(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def share_of(part: Column, total: Column, digits: int = 2) -> Column:
    """``part`` as a rounded percentage of ``total``."""
    return F.round(F.try_divide(part.cast("double") * 100, total.cast("double")), digits)
