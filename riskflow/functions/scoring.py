"""Weighted rule scores, the strongest signal, and risk tiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.config import HIGH_RISK, MEDIUM_RISK, TIER_HIGH, TIER_LOW, TIER_MEDIUM, Rule


def weighted_score(rules: Sequence[Rule]) -> Column:
    """Sum of the weights of the rules that fire, kept within [0, 1]."""
    points = [F.when(F.expr(r.condition), r.weight).otherwise(0) for r in rules]
    total = reduce(lambda a, b: a + b, points)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), total / F.lit(100.0)))


def top_signal(rules: Sequence[Rule]) -> Column:
    """Name of the heaviest rule that fires (ties: first in the list), else 'none'."""
    ranked = sorted(rules, key=lambda r: -r.weight)
    fired = [F.when(F.expr(r.condition), F.lit(r.name)) for r in ranked]
    return F.coalesce(*fired, F.lit("none"))


def risk_tier(score: Column, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> Column:
    """Tier by inclusive lower bounds; a NULL score is low."""
    return (
        F.when(score >= high, TIER_HIGH).when(score >= medium, TIER_MEDIUM).otherwise(TIER_LOW)
    )
