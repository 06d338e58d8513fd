"""Numeric functions and buckets as Column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper ends of the rank buckets and their names, the first that holds.
RANK_BINS = ((20_000, "0_20k"), (30_000, "20k_30k"), (37_000, "30k_37k"), (40_000, "37k_40k"), (50_000, "40k_50k"), (60_000, "50k_60k"), (75_000, "60k_75k"), (100_000, "75k_100k"), (150_000, "100k_150k"), (250_000, "150k_250k"), (400_000, "250k_400k"))
PLAN_BINS = ((2, "plan_1_2"), (5, "plan_3_5"), (10, "plan_6_10"), (30, "plan_11_30"))
RANK_BANDS = ((18_000, "超冲"), (32_000, "冲"), (46_000, "贴合"), (65_000, "稳"), (90_000, "保"), (120_000, "低优先保底"))
BAND_SCORES = {"超冲": 8, "冲": 24, "贴合": 35, "稳": 32, "保": 22, "低优先保底": 8, "远保底": -12, "无历史": 14}
PRIORITIES = ((100, "A"), (84, "B"), (68, "C"), (52, "D"))
YEAR_WEIGHTS = (0.2, 0.3, 0.5)
CONFIDENCE = {"high": 1.0, "medium": 0.82, "low": 0.55, "derived": 0.65, "user": 1.0}
RISK_WEIGHTS = {"contains_excluded_major_in_remark": 18, "class_diversion": 18, "trial_or_experimental_class": 8, "target_only_in_remark": 14, "sino_foreign": 12, "industry_or_enterprise_track": 8, "new_no_history": 9, "small_plan": 8, "high_rank_volatility": 7, "very_high_tuition": 8, "low_fit_school": 100}


def upper_bucket(x: Column, ends: Sequence[tuple[float, str]], beyond: str, missing: str | None = None) -> Column:
    """Name of the first bucket whose upper end is not exceeded; beyond the last, and for null, the given names."""
    out = F.when(x.isNull(), F.lit(missing))
    for end, name in ends:
        out = out.when(x <= end, name)
    return out.otherwise(beyond)


def lower_bucket(x: Column, ends: Sequence[tuple[float, str]], below: str) -> Column:
    """Name of the first bucket whose lower end is reached."""
    out = F.when(F.lit(False), F.lit(below))
    for end, name in ends:
        out = out.when(x >= end, name)
    return out.otherwise(below)


def rank_bin(rank: Column) -> Column:
    return F.when(rank < 0, "out").otherwise(upper_bucket(rank, RANK_BINS, "out", "out"))


def plan_bin(plan: Column) -> Column:
    return upper_bucket(plan, PLAN_BINS, "plan_31_plus", "unknown")


def rank_band(rank: Column) -> Column:
    return upper_bucket(rank, RANK_BANDS, "远保底", "无历史")


def scored(x: Column, scores: dict[str, float], default: float = 0) -> Column:
    """The number that stands for a label."""
    table = F.create_map(*[F.lit(v) for pair in scores.items() for v in pair])
    return F.coalesce(F.try_element_at(table, x), F.lit(default))


def logit_rank(rank: Column, population: float) -> Column:
    p = F.least(F.greatest(rank / F.lit(float(population)), F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(p / (1 - p))


def weighted_mean(values: Sequence[Column], weights: Sequence[float]) -> Column:
    """Mean of the values that are there, by their weights; null if none is."""
    total = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in zip(values, weights, strict=True)), F.lit(0.0))
    weight = sum((F.when(v.isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for v, w in zip(values, weights, strict=True)), F.lit(0.0))
    return F.when(weight > 0, total / weight)


def present(*values: Column) -> Column:
    """The values that are not null, in order."""
    return F.filter(F.array(*values), lambda v: v.isNotNull())


def spread(values: Column) -> Column:
    """Largest minus smallest of at least two values, else 0."""
    return F.when(F.size(values) >= 2, F.array_max(values) - F.array_min(values)).otherwise(F.lit(0))


def penalty(flags: Column, weights: dict[str, float] = RISK_WEIGHTS) -> Column:
    """Sum of the weights of an array of flags; unknown flags weigh nothing."""
    table = F.create_map(*[F.lit(v) for pair in weights.items() for v in pair])
    return F.aggregate(flags, F.lit(0).cast("long"), lambda acc, f: acc + F.coalesce(F.try_element_at(table, f), F.lit(0)))


def priority(score: Column) -> Column:
    return lower_bucket(score, PRIORITIES, "E")


def confidence_factor(x: Column) -> Column:
    return scored(x, CONFIDENCE, 0.75)


def kernel(z_distance: Column, plan_distance: Column, same_family: Column, same_region: Column) -> Column:
    """Weight of a sample by its distances; samples of the same family and region weigh less."""
    return F.exp(-z_distance / 0.22) * F.exp(-plan_distance / 1.2) * F.when(same_family, 0.75).otherwise(1.0) * F.when(same_region, 0.85).otherwise(1.0)


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution, by a rational approximation with an error below 7.5e-8; plain arithmetic, so any engine agrees."""
    t = 1 / (1 + 0.2316419 * F.abs(x))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(x >= 0, 1 - tail).otherwise(tail)


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))
