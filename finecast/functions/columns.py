"""Cleaning and arithmetic on single columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """Double with NaN and both infinities turned into NULL."""
    d = c.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), None).otherwise(d)


def num(c: Column) -> Column:
    """Tolerant number: text that does not parse, NaN and infinities are NULL."""
    return finite(c.try_cast("double"))


def flag(c: Column) -> Column:
    """Boolean from booleans or from the spellings true/1/yes and false/0/no."""
    s = F.lower(F.trim(c.cast("string")))
    return (
        F.when(s.isin("true", "1", "yes"), True)
        .when(s.isin("false", "0", "no"), False)
        .otherwise(None)
    )


def canonical_id(c: Column) -> Column:
    """Trimmed text id; ``123.0`` becomes ``123``; blank becomes NULL."""
    s = F.regexp_replace(F.trim(c.cast("string")), r"^(\d+)\.0$", "$1")
    return F.when(F.length(s) > 0, s)


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp into [low, high]; NULL stays NULL (greatest/least alone skip NULLs)."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(c.isNotNull(), out)


def within(c: Column, low: float, high: float) -> Column:
    """The value if inside [low, high], else NULL."""
    return F.when(c.between(low, high), c)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when b is zero or either side is NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def log1p(c: Column) -> Column:
    """ln(1 + x) with negatives floored at zero first."""
    return F.log1p(clip(c, 0.0))


def expm1(c: Column) -> Column:
    """exp(x) - 1 floored at zero."""
    return clip(F.expm1(c), 0.0)


def close(a: Column, b: Column, rtol: float, atol: float) -> Column:
    """|a - b| <= atol + rtol * |b|, with NULL equal to NULL only."""
    both = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(both)


def weighted_mean_strict(values: Sequence[Column], weights: Sequence[float]) -> Column:
    """Weighted mean over layers; NULL as soon as one layer is NULL."""
    total = sum(weights)
    acc = values[0] * F.lit(float(weights[0]))
    for v, w in zip(values[1:], weights[1:]):
        acc = acc + v * F.lit(float(w))
    return acc / F.lit(float(total))


def circular_mean(mean_sin: Column, mean_cos: Column) -> tuple[Column, Column]:
    """Direction in [0, 360) and resultant length from mean sine and cosine."""
    direction = F.pmod(F.degrees(F.atan2(mean_sin, mean_cos)), F.lit(360.0))
    return direction, F.hypot(mean_sin, mean_cos)


def renormalised(probabilities: Sequence[Column]) -> Column:
    """Array of probabilities clipped to [0, 1] and scaled to sum one.

    NULL when any member is NULL or not finite, or when the sum is zero.
    """
    members = [finite(p) for p in probabilities]
    bad = members[0].isNull()
    for m in members[1:]:
        bad = bad | m.isNull()
    clipped = F.array(*[clip(m, 0.0, 1.0) for m in members])
    total = F.aggregate(clipped, F.lit(0.0), lambda a, x: a + x)
    return F.when(~bad & (total > 0), F.transform(clipped, lambda p: p / total))


def entropy(probabilities: Sequence[Column]) -> Column:
    """Shannon entropy in nats of renormalised class probabilities."""
    return F.aggregate(
        renormalised(probabilities),
        F.lit(0.0),
        lambda a, p: a - F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0)),
    )


def dominant(probabilities: Sequence[Column], labels: Sequence[str]) -> tuple[Column, Column]:
    """Label of the largest probability (first wins on ties) and that value."""
    arr = F.array(*probabilities)
    best = F.array_max(arr)
    names = F.array(*[F.lit(n) for n in labels])
    return F.element_at(names, F.array_position(arr, best).cast("int")), best
