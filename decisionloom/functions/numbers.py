"""Rounding of doubles by their exact binary value, ties to even, in integers only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Places of the point beyond which a number below 2^53 rounds to nothing at twelve digits, and digits at most.
SHIFTS, DIGITS = 126, 12


def round_exact(x: Column, digits: int = 0) -> Column:
    """x rounded to so many digits (0 to 12): the nearest decimal to the exact value of the double, and the even one of two.

    What stands behind the point is a whole number over a power of two, found by shifting the point (exact for doubles); times
    10^digits it is divided by that power in integers of 38 digits, and the remainder decides.  Null, NaN, infinities and numbers
    from 2^53 on stay as they are.
    """
    if not 0 <= digits <= DIGITS:
        raise ValueError(f"digits must be from 0 to {DIGITS}")
    ten, least = Decimal(10**digits), Decimal(1).scaleb(-digits)
    powers = F.array(*[F.lit(Decimal(2**k)).cast("decimal(38,0)") for k in range(SHIFTS + 1)])

    def nearest(parts: Column) -> Column:
        """parts(whole, scaled, power) -> the rounded number."""
        power, rest = parts["power"], F.pmod(parts["scaled"], parts["power"])
        quotient = F.call_function("div", parts["scaled"], power)
        odd = ((parts["whole"] * (10**digits % 2) + quotient) % 2) == 1
        up = (rest > 0) & ((rest > power - rest) | ((rest == power - rest) & odd))
        units = (quotient + F.when(up, F.lit(1)).otherwise(F.lit(0))).cast("decimal(13,0)")
        return (parts["whole"].cast("decimal(16,0)") + units * F.lit(least).cast(f"decimal({digits + 1},{digits})")).cast("double")

    def of(a: Column) -> Column:
        shift = F.least(F.greatest(F.lit(52) - F.floor(F.log2(a)), F.lit(0)), F.lit(SHIFTS)).cast("int")
        whole = F.floor(a)
        behind = F.floor((a - whole.cast("double")) * F.pow(F.lit(2.0), shift.cast("double"))).cast("bigint")
        scaled = (behind.cast("decimal(19,0)") * F.lit(ten).cast(f"decimal({digits + 1},0)")).cast("decimal(38,0)")
        return _once(F.struct(whole.alias("whole"), scaled.alias("scaled"), F.element_at(powers, shift + 1).alias("power")), nearest)

    def signed(x: Column) -> Column:
        plain = x.isNull() | F.isnan(x) | (F.abs(x) >= float(2**53)) | (x == 0)
        return F.when(plain, x).when(x < 0, -_once(-x, of)).otherwise(_once(x, of))

    return _once(x.cast("double"), signed)


def _once(value: Column, of) -> Column:
    """of(value) with the value computed once, however often it is used; otherwise the generated code outgrows its limit."""
    return F.get(F.transform(F.array(value), of), 0)
