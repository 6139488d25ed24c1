"""Seeded pseudo-random draws as pure functions of a row id.

Nothing here depends on partitioning or evaluation order, so a lost task recomputes the same rows and
another SQL engine can reproduce them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Mersenne prime 2^31 - 1 and two multipliers below it. Every product below stays
# inside BIGINT for ids under about 1.9e14.
MODULUS = 2147483647
ID_STEP = 48271
SALT_STEP = 40503
MIX_STEP = 16807


def bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value computed once, however often ``of`` mentions it.

    Written out, a draw mentions its id some fifty times; pushed into a filter that makes a method the JVM does not compile.
    """
    return F.transform(F.array(value), of)[0]


def mix(row_id: Column, salt: int) -> Column:
    """A number in [0, MODULUS). Squaring keeps draws with different salts from moving in step."""
    start = (row_id.cast("bigint") * F.lit(ID_STEP) + F.lit(salt * SALT_STEP)) % F.lit(MODULUS)
    return bound(start, lambda x: ((x * x) % F.lit(MODULUS) + x * F.lit(MIX_STEP)) % F.lit(MODULUS))


def wide_mix(row_id: Column, salt: int) -> Column:
    """A number in [0, MODULUS^2), for draws from more than MODULUS places or of more than MODULUS ids."""
    # what of the id the first number cannot tell apart goes into the second, and from there into both
    turns = F.call_function("div", row_id.cast("bigint"), F.lit(MODULUS))
    second = mix(turns + mix(row_id, salt), salt + 1)
    return bound(second, lambda x: mix(x + turns, salt) * F.lit(MODULUS) + x)
