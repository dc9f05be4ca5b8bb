"""Unit conversions, rates and rounding."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit conversions.
MILES_PER_KM = 0.6213712
FEET_PER_MILE = 5280


def guarded(col: Column, digits: int) -> Column:
    """Decimal with six spare digits, which absorbs binary noise before a half-up rounding."""
    return col.cast(f"decimal(28,{digits + 6})")


def round_half_up(col: Column, digits: int) -> Column:
    """Round half away from zero as decimals do: 1.005 -> 1.01, whatever its binary neighbour.

    Sums and averages of doubles differ in their last bits with the order of addition; the spare digits
    make the rounded value independent of it.
    """
    return F.round(guarded(col, digits), digits).cast("double")


# Scaled measures below it are doubles whose error is far smaller than the distance that tells a tie.
QUICK_LIMIT, QUICK_TIE = 1e9, 0.499


def _scaled(col: Column, digits: int) -> tuple[Column, Column, Column]:
    """A double in units of its last place, the nearest whole number of them, and that back as a double (never -0.0)."""
    scaled = col.cast("double") * F.lit(10.0**digits)
    near = F.rint(scaled)
    return scaled, near, near / F.lit(10.0**digits) + F.lit(0.0)


def quick_half_up(col: Column, digits: int) -> Column:
    """``round_half_up`` of a double; decimals are made only of values close to a tie, or large ones."""
    scaled, near, value = _scaled(col, digits)
    clear = (F.abs(scaled) < QUICK_LIMIT) & (F.abs(scaled - near) < QUICK_TIE)
    return F.when(clear, value).otherwise(round_half_up(col, digits))


def quick_guarded(col: Column, digits: int) -> Column:
    """``guarded`` of a double, as a double; decimals are made only of values that have more places, or large ones."""
    scaled, _, value = _scaled(col, digits)
    clear = (F.abs(scaled) < QUICK_LIMIT) & (value == col.cast("double"))
    return F.when(clear, value).otherwise(guarded(col, digits).cast("double"))


# Bits of a limb of the fraction, and how many there are: a group may have 2**43 rows before a sum of limbs overflows.
LIMB_BITS, LIMBS = 20, 3


def limbs(col: Column) -> list[Column]:
    """A double as longs whose sums are exact in any order: the whole part, then the fraction in pieces of 20 bits.

    Bits below 2**-60 are left out, which only values under 2**-7 can have. NaN and infinities count as null.
    """
    finite = F.when(F.abs(col) < F.lit(float("inf")), col.cast("double"))
    whole = F.floor(finite)
    fraction = ((finite - whole) * F.lit(float(1 << LIMB_BITS * LIMBS))).cast("bigint")
    mask = F.lit((1 << LIMB_BITS) - 1).cast("bigint")
    pieces = [F.shiftright(fraction, LIMB_BITS * i) for i in reversed(range(LIMBS))]
    return [whole.cast("bigint"), pieces[0], *(p.bitwiseAND(mask) for p in pieces[1:])]


def from_limbs(sums: Sequence[Column], digits: int) -> Column:
    """The double nearest to summed limbs, rounded half up to so many places (18 at most)."""
    mask, sums = F.lit((1 << LIMB_BITS) - 1).cast("bigint"), list(sums)
    for i in range(LIMBS, 0, -1):  # what a piece has beyond its bits goes to the one above
        sums[i - 1] = sums[i - 1] + F.shiftright(sums[i], LIMB_BITS)
        sums[i] = sums[i].bitwiseAND(mask)
    fraction = sums[1]
    for piece in sums[2:]:
        fraction = F.shiftleft(fraction, LIMB_BITS) + piece
    one = 1 << LIMB_BITS * LIMBS
    half = F.when(sums[0] < 0, F.lit(Decimal(one // 2 - 1))).otherwise(F.lit(Decimal(one // 2)))
    scaled = fraction.cast("decimal(19,0)") * F.lit(Decimal(10**digits)) + half
    places = F.call_function("div", scaled, F.lit(Decimal(one)))
    unit = F.lit(Decimal(1).scaleb(-digits))
    return (sums[0].cast("decimal(19,0)") + places.cast("decimal(19,0)") * unit).cast("double")


def exact_sum(col: Column, digits: int = 9) -> Column:
    """Sum of doubles, the same in whatever order the rows come, rounded half up to so many places (18 at most).

    Four sums of longs, which hash aggregates keep in place; no row makes a decimal. Null if no row has a finite value;
    sums beyond a long raise.
    """
    return from_limbs([F.sum(limb) for limb in limbs(col)], digits)


def divide(num: Column, den: Column, on_zero: str = "error") -> Column:
    """Fractional division; a zero divisor raises, or yields null with ``on_zero='null'``."""
    if on_zero == "error":
        return num.cast("double") / den.cast("double")
    if on_zero == "null":
        return F.try_divide(num.cast("double"), den.cast("double"))
    raise ValueError(f"on_zero must be 'error' or 'null', not {on_zero!r}")


def km_to_mi(col: Column, digits: int = 3) -> Column:
    """Kilometres to miles."""
    return round_half_up(col * F.lit(MILES_PER_KM), digits)


def per_capita(num: Column, den: Column, scale: int = 100, digits: int = 2, on_zero: str = "error") -> Column:
    """Rate per ``scale`` inhabitants: 100 gives percent, 100000 the usual incidence."""
    return round_half_up(divide(num, den, on_zero) * F.lit(float(scale)), digits)


def length_ratio_pct(feet: Column, miles: Column, on_zero: str = "error") -> Column:
    """Feet as a share of a length in miles, rounded to 5 digits and only then scaled to percent."""
    share = divide(feet.cast("double") / F.lit(float(FEET_PER_MILE)), miles, on_zero)
    return round_half_up(share, 5) * F.lit(100.0)
