"""Geohash decoding as integer arithmetic, with no per-row Python and no join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The geohash alphabet and the digits Spark's ``conv`` reads in base 32.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

# Twelve characters hold 60 bits, the most whole characters a 64-bit number takes.
_CHARS = 12
_AXIS_BITS = 30


def is_valid(geohash: Column) -> Column:
    return F.coalesce(F.translate(geohash, GEOHASH_ALPHABET, "") == "", F.lit(False))


def _corner(chunk: Column, bit_of_digit: str) -> Column:
    """Lower cell bound in 1/2^30 of the axis, for up to twelve characters.

    Bits alternate, longitude first, so a base-4 digit holds one bit of each axis.
    """
    digits = F.translate(F.rpad(chunk, _CHARS, "0"), GEOHASH_ALPHABET, BASE32_DIGITS)
    bits = F.translate(F.conv(digits, 32, 4), "0123", bit_of_digit)
    return F.conv(bits, 2, 10).cast("bigint")


def _coordinate(geohash: Column, axis: str, span: int, strict: bool) -> Column:
    digit, first = ("0011", 1) if axis == "lon" else ("0101", 0)
    cells = float(2**_AXIS_BITS)
    # The next twelve characters refine beyond what a double resolves.
    fine = _corner(F.substring(geohash, _CHARS + 1, _CHARS), digit) / cells
    bits = F.floor((F.length(geohash) * 5 + first) / 2)
    value = ((_corner(geohash, digit) + fine) / cells + F.pow(F.lit(0.5), bits + 1)) * span - span / 2
    # Added instead of wrapped around, so that the axes share their common parts.
    if strict:
        illegal = F.raise_error(F.concat(F.lit("illegal geohash: "), F.coalesce(geohash, F.lit("NULL"))))
        return F.coalesce(value, F.lit(0.0)) + F.when(is_valid(geohash), 0.0).otherwise(illegal.cast("double"))
    return value + F.when(is_valid(geohash), 0.0)


def latitude(geohash: str = "geohash", strict: bool = False) -> Column:
    """Latitude of the cell centre; NULL for an illegal hash unless ``strict``."""
    return _coordinate(F.col(geohash), "lat", 180, strict)


def longitude(geohash: str = "geohash", strict: bool = False) -> Column:
    return _coordinate(F.col(geohash), "lon", 360, strict)
