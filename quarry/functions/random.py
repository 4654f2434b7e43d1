"""Counter-based random columns: every number is a function of (seed, row key, draw number).

The MD5 of the three gives 52 random bits, so a row's numbers do not depend on partitions, order, cluster or engine,
a rerun or a lost executor changes nothing, and any number can be computed again on its own.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 52
ATTEMPTS = 64     # an attempt at a gamma number is accepted with 95 % at least, so this many fail with less than 1e-80


def uniform(seed: int, key: Column, draw: int | Column) -> Column:
    """Uniform in (0, 1): an odd multiple of 2 ** -53, never 0 or 1.  A null key counts as an empty one."""
    number = F.lit(draw) if isinstance(draw, int) else draw
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), number.cast("string"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / float(1 << BITS)


def normal(seed: int, key: Column, draw: int | Column, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Normal by Box and Muller from the draws ``2 * draw`` and ``2 * draw + 1``."""
    n = F.lit(draw) if isinstance(draw, int) else draw
    u, v = uniform(seed, key, n * 2), uniform(seed, key, n * 2 + 1)
    return F.lit(mean) + F.lit(sd) * F.sqrt(-2.0 * F.ln(u)) * F.cos(2.0 * math.pi * v)


def integers(seed: int, key: Column, draw: int | Column, low: int, high: int) -> Column:
    """Whole numbers from ``low`` up to, not including, ``high``."""
    return F.lit(low) + F.floor(uniform(seed, key, draw) * (high - low)).cast("long")


def choice(seed: int, key: Column, draw: int | Column, values: Sequence, weights: Sequence[float] | None = None) -> Column:
    """One of ``values``, by weight (equal weights by default)."""
    weights = list(weights or [1.0] * len(values))
    if len(weights) != len(values) or min(weights) < 0 or not sum(weights) > 0:
        raise ValueError("one weight a value, none negative, not all zero")
    u, upto = uniform(seed, key, draw), 0.0
    last = max(i for i, w in enumerate(weights) if w)
    out = None
    for value, w in list(zip(values, weights))[:last]:
        upto += w / sum(weights)
        out = F.when(u < upto, F.lit(value)) if out is None else out.when(u < upto, F.lit(value))
    return F.lit(values[last]) if out is None else out.otherwise(F.lit(values[last]))


def gamma(seed: int, key: Column, draw: int, shape: float, scale: float = 1.0) -> Column:
    """Gamma numbers by Marsaglia and Tsang: with d = shape - 1/3 and c = 1 / sqrt(9 d), a normal x and a uniform u give
    d v, v = (1 + c x) ** 3, if v > 0 and ln u < x² / 2 + d - d v + d ln v; otherwise the row tries again with its next
    numbers.  A shape below 1 takes the number of shape + 1 times u ** (1 / shape).

    Draw numbers used: ``draw * 1024`` and up.  A row with ``ATTEMPTS`` refusals raises an error rather than return a
    number of another distribution."""
    if shape <= 0:
        raise ValueError("shape must be positive")
    if shape < 1:
        own = uniform(seed, key, draw * 1024 + 3 * ATTEMPTS)
        return gamma(seed, key, draw, shape + 1.0, scale) * F.pow(own, F.lit(1.0 / shape))
    d = shape - 1.0 / 3.0
    c = 1.0 / math.sqrt(9.0 * d)

    def attempt(i: Column) -> Column:
        first = i * 3 + draw * 1024
        u, v = uniform(seed, key, first), uniform(seed, key, first + 1)
        return F.struct((F.sqrt(-2.0 * F.ln(u)) * F.cos(2.0 * math.pi * v)).alias("x"), uniform(seed, key, first + 2).alias("u"))

    def judged(a: Column) -> Column:
        v = F.pow(1.0 + c * a["x"], F.lit(3.0))
        return F.when((v > 0) & (F.ln(a["u"]) < 0.5 * a["x"] * a["x"] + d - d * v + d * F.ln(v)), d * v)
    tries = F.sequence(F.lit(0), F.lit(ATTEMPTS - 1))
    # aggregate evaluates an attempt only while none was accepted
    got = F.aggregate(tries, F.lit(None).cast("double"), lambda a, i: F.when(a.isNotNull(), a).otherwise(judged_once(attempt(i), judged)))
    return F.coalesce(got, F.raise_error(F.lit("no gamma number was accepted")).cast("double")) * scale


def judged_once(value: Column, judge) -> Column:
    """``judge(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), judge), 1)
