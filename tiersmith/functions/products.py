"""Product names, prices, pack sizes and unit prices as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The units a pack size may carry, in matching order.
UNITS = ("ml", "cl", "g", "kg", "l", "s", "pk", "litre", "pack", "pads", "'s")
# Units that count pieces.
PIECE_UNITS = ("s", "'s", "pk", "pack", "pads")
# Unit -> (factor into the base unit, base unit).
CONVERTED_UNITS = {"l": (1000, "ml"), "litre": (1000, "ml"), "cl": (10, "ml")}
# Base unit -> (size a price is quoted for, label).
PRICE_BASES = {"g": (100, "100g"), "ml": (100, "100ml"), "ea": (1, "ea")}

_WHITESPACE = (
    r"[\s\x1C-\x1F\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
)
_NUMBER = r"[0-9]*\.?[0-9]+"
_PACK_SIZE = f"(?iu){_NUMBER}{_WHITESPACE}?(?:{'|'.join(UNITS)})"
_TRIMMED = " \t\n\r\x0b\x0c\u00a0"

PRICE_TYPE = "decimal(18,2)"
SIZE_TYPE = "decimal(18,6)"


def clean_name(name: Column) -> Column:
    """Undo the ``&amp;`` escape of a product name."""
    return F.replace(name, F.lit("&amp;"), F.lit("&"))


def clean_price(*parts: Column) -> Column:
    """The amount after the first pound sign of the joined parts, else of all of it."""
    text = F.concat(*parts) if len(parts) > 1 else parts[0]
    amount = F.substring(text, F.instr(text, "£") + 1, F.length(text))
    return F.btrim(amount, F.lit(_TRIMMED)).try_cast(PRICE_TYPE)


def pack_size(name: Column) -> Column:
    """The first number with a unit in a name, empty without one."""
    return F.regexp_extract(name, _PACK_SIZE, 0)


def size_number(found: Column) -> Column:
    """The number of a ``pack_size``, empty without one."""
    return F.regexp_extract(found, f"^{_NUMBER}", 0)


def size_unit(found: Column) -> Column:
    """The unit of a ``pack_size`` in lower case, empty without one."""
    return F.lower(F.regexp_replace(found, f"^{_NUMBER}{_WHITESPACE}?", ""))


def base_quantity(number: Column, unit: Column) -> Column:
    """``struct(multiplier, quantity, unit)`` of a size number and its unit.

    Without a number it is a single piece. Litres and centilitres become
    millilitres, pack words become pieces, other units stay as they are. The
    multiplier is always 1: ``3x40ml`` reads as 40 ml.
    """
    factor = F.lit(1)
    base_unit = F.when((number == "") | unit.isin(*PIECE_UNITS), "ea")
    for long_unit, (times, base) in CONVERTED_UNITS.items():
        factor = F.when(unit == long_unit, times).otherwise(factor)
        base_unit = base_unit.when(unit == long_unit, base)
    # The number is read in one place: short generated code is compiled by the JVM.
    amount = (number.try_cast(SIZE_TYPE) * factor.cast("decimal(4,0)")).try_cast(SIZE_TYPE)
    quantity = F.when(number == "", F.lit(1).cast(SIZE_TYPE))
    return F.when(
        number.isNotNull(),
        F.struct(
            F.lit(1).alias("multiplier"),
            quantity.otherwise(amount).alias("quantity"),
            base_unit.otherwise(unit).alias("unit"),
        ),
    )


def parse_quantity(name: Column) -> Column:
    """The ``base_quantity`` of the first pack size in a product name."""
    found = pack_size(name)
    return base_quantity(size_number(found), size_unit(found))


def price_per(price: Column, quantity: Column) -> Column:
    """``struct(price, unit)``: the price of 100 g, 100 ml or one piece.

    Units without a base keep a NULL label and the price of one unit; a size
    of zero gives NULL. The price is exact up to one division.
    """
    unit = quantity["unit"]
    factor, label = F.lit(1), F.lit(None).cast("string")
    for base, (size, text) in PRICE_BASES.items():
        factor = F.when(unit == base, size).otherwise(factor)
        label = F.when(unit == base, text).otherwise(label)
    total = quantity["quantity"] * quantity["multiplier"]
    return F.struct(
        F.when(total != 0, price * factor.cast("decimal(3,0)") / total).alias("price"),
        label.alias("unit"),
    )


def quote_path(text: Column) -> Column:
    """Percent-encode for a URL path: spaces as ``%20``; ``/`` and ``~`` stay."""
    encoded = F.url_encode(text)
    # Form encoding -> path encoding.
    for form, path in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(form), F.lit(path))
    return encoded
