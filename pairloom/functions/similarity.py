"""Similarity and calibration arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def token_sim(a: Column, b: Column) -> Column:
    """The larger of Jaccard and 0.92 of containment; 0 if either is empty."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    both = F.size(F.array_intersect(a, b))
    contain = both / F.least(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.greatest(jaccard(a, b), contain * 0.92))


def relative(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1e-9))


def numeric_sim(a: Column, b: Column, tolerance: float = 0.03) -> Column:
    """1, 0.9, 0.45 or 0 by relative difference; 0 if either is unknown."""
    r = relative(a, b)
    return F.when(r <= 0.005, 1.0).when(r <= tolerance, 0.90).when(r <= 0.10, 0.45).otherwise(0.0)


def near(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1e-9))


def near_any(a: Column, b: Column, tolerance: float) -> Column:
    """Whether some numbers of two arrays are that near."""
    return F.exists(a, lambda x: F.exists(b, lambda y: near(x, y, tolerance)))


def sigmoid(z: Column) -> Column:
    return F.when(z >= 0, 1 / (1 + F.exp(-z))).otherwise(F.exp(z) / (1 + F.exp(z)))


def calibrated(raw: Column, coefficient: float, intercept: float) -> Column:
    return sigmoid(raw * coefficient + intercept)


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def related_brands(a: Column, b: Column) -> Column:
    """Of two arrays of brand words without generic ones: one holds the other, or 0.6 of the smaller is shared."""
    generic = F.array(*[F.lit(w) for w in ("llc", "inc", "co", "company", "foods", "food", "organic")])
    a, b = F.array_except(a, generic), F.array_except(b, generic)
    some = (F.size(a) > 0) & (F.size(b) > 0)
    return some & (F.size(F.array_intersect(a, b)) >= 0.6 * F.least(F.size(a), F.size(b)))


def numeric_value(dim: Column, other: Column, a: Column, b: Column) -> Column:
    """Similarity of two tagged quantities; null where the dimensions differ or one is unknown."""
    return F.when(dim == other, numeric_sim(a, b))


def queue_priority(support: Column, raw: Column, functional: Column, nonmatch: Column, verdict: Column, policy: Column) -> Column:
    bonus = F.when(verdict == "REVIEW", 0.08).otherwise(0.0) + F.when(policy == "PRIVATE", 0.06).otherwise(0.0)
    return support + 0.35 * raw + 0.22 * functional - 0.25 * nonmatch + bonus


def quantity_relation(similarity: Column) -> Column:
    """COMPATIBLE from 0.72 on, else CONFLICT; UNKNOWN for null, negative and exact zero, which stands for no value."""
    return F.when(F.coalesce(similarity, F.lit(-1.0)) <= 0, "UNKNOWN").when(similarity >= 0.72, "COMPATIBLE").otherwise("CONFLICT")
