"""Text keys, mileposts and reference points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadweave.functions.measures import guarded


def concat_present(*cols: Column | str) -> Column:
    """Concatenate, treating null as empty; null only when nothing is left."""
    return F.nullif(F.concat_ws("", *cols), F.lit(""))


def blank_as_null(col: Column, blank: str = " ") -> Column:
    """A value that is exactly ``blank``, or empty, becomes null."""
    return F.when(~col.isin(blank, ""), col)


def milepost_to_number(col: Column, digits: int | None = 3) -> Column:
    """``'12+0.345'`` -> 12.345 and ``'12-0.5'`` -> 11.5; either part may be absent, null is 0.

    The parts are added as decimals of 18 places and rounded half up at the end; without ``digits`` not at all.
    """
    exact, zero = "decimal(38,18)", F.lit(0).cast("decimal(38,18)")
    miles = F.regexp_substr(col, F.lit("^[0-9]+")).cast(exact)
    fraction = F.regexp_substr(col, F.lit("[+-][0-9.]*")).cast(exact)
    mile = (F.coalesce(miles, zero) + F.coalesce(fraction, zero)).cast(exact)
    return mile if digits is None else F.round(mile, digits).cast(f"decimal(18,{digits})")


# Mileposts whose millionths a double holds exactly.
_PLACES = 6
_SHORT_POST = "^[0-9]{1,8}[+-][0-9]{1,4}[.][0-9]{1,6}$"


def milepost_to_double(col: Column, digits: int = 3) -> Column:
    """``milepost_to_number`` as a double.

    Texts such as ``'12+0.345'`` are read into whole millionths, without a decimal; others, with more digits than
    fit or a part missing, go the exact way, as do results of more than 6 digits, which a double may not hold.
    """
    exact = milepost_to_number(col, digits).cast("double")
    if digits > _PLACES:
        return exact
    unit, step = float(10**_PLACES), float(10 ** (_PLACES - digits))

    def short(sign: str) -> Column:
        miles, offset = (F.substring_index(col, sign, n).cast("double") for n in (1, -1))
        # The nearest whole number is the text's own, as a double's error is far below a half here.
        millionths = miles * unit + (1 if sign == "+" else -1) * F.rint(offset * unit)
        size = F.floor((F.abs(millionths) + step / 2) / step) / F.lit(float(10**digits))
        return size if sign == "+" else F.when(millionths < 0, F.lit(0.0) - size).otherwise(size)

    ahead = F.contains(col, F.lit("+"))
    return F.when(col.rlike(_SHORT_POST), F.when(ahead, short("+")).otherwise(short("-"))).otherwise(exact)


def reference_point(marker: Column, offset: Column) -> Column:
    """Marker and offset as ``' 012+0.523'``: a blank, three digits, plus sign, three decimals.

    Markers of more than three digits keep all of them.
    """
    digits = marker.cast("string")
    padded = F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    return F.concat_ws(
        "", F.when(marker.isNotNull(), F.concat(F.lit(" "), padded)), F.lit("+"),
        F.round(guarded(offset, 3), 3).cast("decimal(18,3)").cast("string"),
    )


def reference_point_to_number(col: Column, exact: bool = False) -> Column:
    """Reference point text back to a mile.

    As the source data is read: marker digits, then the offset from its decimal point on, so whole miles of offset
    are lost, however many digits they have (``' 012+1.250'`` and ``' 012+13.250'`` -> 12.250). ``exact=True`` adds
    marker and offset (13.250 and 25.250).
    """
    if exact:
        marker = F.trim(F.substring_index(col, "+", 1)).cast("decimal(18,3)")
        offset = F.substring_index(col, "+", -1).cast("decimal(18,3)")
        return (marker + offset).cast("double")
    joined = F.concat(F.trim(F.substring_index(col, "+", 1)), F.coalesce(F.regexp_substr(col, F.lit("[.][0-9]+$")), F.lit("")))
    return joined.cast("decimal(18,3)").cast("double")


def corridor_number(col: Column) -> Column:
    """The six digits after the system letter, as a number; malformed codes raise (F8)."""
    return F.substring(col, 2, 6).cast("int")
