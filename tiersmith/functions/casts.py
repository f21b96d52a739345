"""String-to-type casts that turn bad values into NULL, whatever the ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type -> its bits, and how many digits always fit.
_INTEGRAL = {
    T.ByteType: (8, 2),
    T.ShortType: (16, 4),
    T.IntegerType: (32, 9),
    T.LongType: (64, 18),
}

# Digits with an optional sign and a fraction, padded by control characters.
_PADDING = r"[\x00-\x20\x7F]*"
_WHOLE_PART = rf"^{_PADDING}([+-]?[0-9]+)(?:\.[0-9]*)?{_PADDING}$"
_FRACTION_ONLY = rf"^{_PADDING}[+-]?\.[0-9]*{_PADDING}$"


def lenient_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast with NULL for what does not fit.

    A string with a fraction becomes an integer by dropping the fraction
    (``'7.9'`` is 7); exponents (``'1e3'``) are not integers.
    """
    if source == target:
        return value
    if isinstance(source, T.StringType) and type(target) in _INTEGRAL:
        # The cast itself is fast but pays an exception for each string it
        # rejects: it only gets to see short plain numbers. The others are
        # taken apart, and those too large are sorted out as decimals.
        bits, safe = _INTEGRAL[type(target)]
        plain = F.regexp_like(value, F.lit(rf"^[+-]?[0-9]{{1,{safe}}}$"))
        digits = F.nullif(F.regexp_extract(value, _WHOLE_PART, 1), F.lit(""))
        number = digits.try_cast(T.DecimalType(38, 0))
        limit = 1 << (bits - 1)
        fits = F.when(number.between(-limit, limit - 1), number.cast(target))
        fraction = F.when(F.regexp_like(value, F.lit(_FRACTION_ONLY)), F.lit(0).cast(target))
        return F.when(plain, value.try_cast(target)).otherwise(
            F.coalesce(fits, F.when(digits.isNull(), fraction))
        )
    return value.try_cast(target)
