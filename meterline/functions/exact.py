"""Sums of doubles without rounding, the same bits in whatever order the rows are added.

A double is cut into whole numbers of falling units, 2^48 down to 2^-96, each LANE_BITS
below the one before. Each lane is a sum of integers, which Spark adds up exactly and per
task; only the end result is rounded. Exact are all values under 2^72 in size whose last
binary digit is not below 2^-96, as it is for every double of at least 2^-43. Others, and NaN and the
infinities, are added as doubles in a sum of their own, which is part of the result.
A lane holds 2^39 rows a group; more raise an overflow and give no wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LANE_BITS = 24
#: Exponents of the lanes' units, from the greatest.
UNITS = [48, 24, 0, -24, -48, -72, -96]
#: Values of this size and more have no place in the first lane.
LIMIT = 2.0**72


def _whole(value: Column, unit: int) -> Column:
    """The value in a unit, to the nearest whole number, as a double; exact for what is no fraction there."""
    return F.rint(value * F.lit(2.0**-unit))


def _held(value: Column) -> Column:
    """Whether the lanes hold the value without loss."""
    last = UNITS[-1]
    return (F.abs(value) < LIMIT) & (_whole(value, last) * F.lit(2.0**last) == value)


def exact_sums(value: Column) -> Column:
    """An aggregate: the struct of lane sums that ``exact_total`` reads; nulls are passed over."""
    kept = F.when(_held(value), value)
    lanes, above = [], None
    for unit in UNITS:
        whole = _whole(kept, unit)
        # What the lane above has rounded to is taken off again; the difference of the two is exact.
        part = whole if above is None else whole - above * F.lit(2.0**LANE_BITS)
        lanes.append(F.coalesce(F.sum(part.cast("long")), F.lit(0)))
        above = whole
    rest = F.sum(F.when(value.isNotNull() & ~F.coalesce(_held(value), F.lit(False)), value))
    return F.struct(F.array(*lanes).alias("lanes"), rest.alias("rest"), F.count(value).alias("count"))


def _carried(lanes: Column) -> Column:
    """Lanes as digits under 2^LANE_BITS, the first of them of any size; from the last lane up."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(done: Column, lane: Column) -> Column:
        sum_ = done["carry"] + lane
        digit = F.array(sum_.bitwiseAND((1 << LANE_BITS) - 1))
        return F.struct(F.shiftright(sum_, LANE_BITS).alias("carry"), F.concat(digit, done["digits"]).alias("digits"))

    below = F.aggregate(F.reverse(F.slice(lanes, 2, len(UNITS) - 1)), start, step)
    return F.concat(F.array(below["carry"] + F.get(lanes, F.lit(0))), below["digits"])


def exact_total(sums: Column) -> Column:
    """The sum, rounded once its last digits are added; NULL without values."""
    lanes = sums["lanes"]
    sign = F.when(F.get(_carried(lanes), F.lit(0)) < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    digits = _carried(F.transform(lanes, lambda lane: lane * sign))

    def pair(first: int) -> Column:
        """Two digits as one whole number of the second one's unit."""
        high, low = (F.get(digits, F.lit(place)) for place in (first, first + 1))
        return (F.shiftleft(high, LANE_BITS) + low).cast("double") * F.lit(2.0 ** UNITS[first + 1])

    # Digits have one sign here, so that adding the small ones first loses nothing that counts.
    total = ((pair(5) + pair(3)) + pair(1)) + F.get(digits, F.lit(0)).cast("double") * F.lit(2.0 ** UNITS[0])
    return F.when(sums["count"] > 0, total * sign.cast("double") + F.coalesce(sums["rest"], F.lit(0.0)))


def exact_mean(sums: Column) -> Column:
    return exact_total(sums) / F.when(sums["count"] > 0, sums["count"])
