"""Vector and overlap measures. Pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if either vector is all zeros."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size)


def search_score(a: Column, b: Column) -> Column:
    """Cosine moved from -1..1 to 0..1."""
    return (cosine(a, b) + 1) / 2


def overlap(a: Column, b: Column) -> Column:
    """Shared elements over the larger set's size; 0 if either is empty."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    most = F.greatest(F.size(x), F.size(y))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / most).otherwise(0.0)


OPEN_LICENCES = ("mit", "apache", "gpl", "bsd", "open")


def is_open(licence: Column) -> Column:
    low, out = F.lower(licence), F.lit(False)
    for part in OPEN_LICENCES:
        out = out | F.contains(low, F.lit(part))
    return out


def relevance(tasks: Column, other_tasks: Column, keywords: Column, other_keywords: Column, name: Column, other_name: Column, licence: Column, other_licence: Column) -> Column:
    """0.4 shared tasks + 0.25 shared keywords + 0.1 one name within the other + 0.05 licences alike in openness, at most 1."""
    a, b = F.lower(name), F.lower(other_name)
    named = F.when((a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a)), 0.1).otherwise(0.0)
    alike = F.when((licence != "") & (other_licence != "") & (is_open(licence) == is_open(other_licence)), 0.05).otherwise(0.0)
    return F.least(0.4 * overlap(tasks, other_tasks) + 0.25 * overlap(keywords, other_keywords) + named + alike, F.lit(1.0))


def scaled_half_even(x: Column, digits: int) -> Column:
    """The whole number nearest to x * 10^digits, as a double; a tie, which only an exact one is, goes to the even number.

    x is taken for what its bits say: 2.675 lies below its decimal text, so it gives 267. The product with 2 * 10^digits
    is split into its rounded value and what rounding lost (two halves of x, each with an exact product), so the side of
    the half-way point is known exactly. For digits up to 7, x beyond 1e-280 or zero, and x * 10^digits up to 2^53.
    """
    twice = 2.0 * 10**digits
    size = F.abs(x)
    spread = size * F.lit(134217729.0)  # 2^27 + 1
    high = spread - (spread - size)
    product = size * F.lit(twice)
    lost = (high * F.lit(twice) - product) + (size - high) * F.lit(twice)
    below = F.floor(product / 2).cast("double")
    side = ((product - below * 2) - 1) + lost
    nearest = below + F.when((side > 0) | ((side == 0) & (below % 2 == 1)), 1.0).otherwise(0.0)
    return F.when(x < 0, -nearest).otherwise(nearest)


def round_binary(x: Column, digits: int) -> Column:
    """x rounded to decimals by its exact value, ties to even. Too large to have such decimals, not finite, null: as it is."""
    fits = F.abs(x) * F.lit(10.0**digits) < F.lit(2.0**53)
    return F.when(fits & ~F.isnan(x), scaled_half_even(x, digits) / F.lit(10.0**digits)).otherwise(x)
