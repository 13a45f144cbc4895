"""A place on a space-filling curve for rows with several numbers.

Each number becomes its rank among evenly filled ranges, so that neither outliers nor
popular values stretch the curve, and the bits of the ranks are interleaved (Morton
order). Rows near each other on the curve are near each other in every number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ranges of a number: 2 ** BITS. Three numbers make 262,144 cells, more than files are wanted.
BITS = 6
ACCURACY = 10_000


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """Bits of whole numbers below ``2 ** bits``, taken in turn, the first number's lowest."""
    if bits * len(ranks) > 62:
        raise ValueError("the curve's key would not fit a long")
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + i))
    return key


def range_limits(df: DataFrame, by: Mapping[str, Column], bits: int = BITS) -> dict[str, list]:
    """Ascending different limits, fewer than ``2 ** bits``, that cut each number into evenly filled ranges."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(c.cast("long"), shares, ACCURACY).alias(n) for n, c in by.items()]).first()
    return {name: sorted(set(found[name] or [])) for name in by}


def _passed(limits: list[int], number: Column, before: int = 0) -> Column:
    """How many ascending limits a number reaches, and ``before``, by halving; a null reaches none."""
    if not limits:
        return F.lit(before)
    middle = len(limits) // 2
    above = _passed(limits[middle + 1 :], number, before + middle + 1)
    return F.when(number >= F.lit(limits[middle]).cast("long"), above).otherwise(_passed(limits[:middle], number, before))


def curve_key(df: DataFrame, by: Mapping[str, Column], bits: int = BITS) -> Column:
    """Place of a row of ``df`` on the curve through ``by``; nulls are in a number's first range. Runs a small job."""
    ranks = []
    for name, limits in range_limits(df, by, bits).items():
        if limits:
            ranks.append(_passed(limits, by[name].cast("long")))
        else:
            ranks.append(F.lit(0))
    return interleaved(ranks, bits)
