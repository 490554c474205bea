"""Typed projections of raw text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: admission timestamps are day-first; single-digit day, month, hour and
# minute parts are accepted as well as padded ones.
VISIT_TS_PATTERN = "d-M-yyyy H:m"

# A number in text: the engine's own cast also takes type suffixes ("45F"), which are not data.
NUMBER_TEXT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"

# Every text that the engine's cast reads as a double (and a few that it does not): suffixes and
# hexadecimal numbers are among them.
CAST_TEXT = (r"^[\x00-\x20]*+[+-]?+(0[xX][0-9a-fA-F.]+[pP][+-]?[0-9]+[fFdD]?"
             r"|([0-9]++\.?+[0-9]*+|\.[0-9]++)([eE][+-]?[0-9]++)?+[fFdD]?+|(?i:infinity|inf|nan))[\x00-\x20]*+$")

# Age bands as (exclusive upper bound, label), open-ended last band.
AGE_BANDS = [(18, "0-17"), (35, "18-34"), (50, "35-49"), (65, "50-64")]
AGE_BAND_LAST = "65+"
AGE_BAND_ORDER = ["0-17", "18-34", "35-49", "50-64", "65+"]

# Shift bands by hour of day (inclusive ranges); other hours are Night.
SHIFTS = [(7, 14, "Day"), (15, 22, "Evening")]
SHIFT_OTHER = "Night"

UNKNOWN = "unknown"


def parse_visit_ts(raw: Column, strict: bool = True) -> Column:
    """Day-first text -> TIMESTAMP_NTZ.

    Strict raises on an unparseable non-null string (the build stops, as a typed cast
    in a warehouse would); lenient returns NULL and leaves counting to the caller.
    """
    text = F.trim(raw)
    if strict:
        return F.to_timestamp_ntz(text, F.lit(VISIT_TS_PATTERN))
    return F.try_to_timestamp(text, F.lit(VISIT_TS_PATTERN)).cast("timestamp_ntz")


def parse_double(raw: Column) -> Column:
    """Text -> DOUBLE for plain decimals, blanks around them ignored, and for inf and nan in
    any case; other text, such as a number with a type suffix, is NULL."""
    return F.when(raw.rlike(NUMBER_TEXT), raw.try_cast("double"))


def cast_double(raw: Column) -> Column:
    """``raw.try_cast("double")``, without the exception that the cast raises and catches within
    for every text that is no number, which costs far more than looking at the text first."""
    return F.when(raw.rlike(CAST_TEXT), raw.try_cast("double"))


def parse_int_rounding(raw: Column) -> Column:
    """Text -> INT the lenient way: surrounding blanks ignored, decimals rounded half
    away from zero ('4.6' -> 5, '-4.5' -> -5), junk or overflow -> NULL."""
    return F.round(parse_double(raw)).try_cast("int")


def parse_bool_text(raw: Column) -> Column:
    """'true' in any case, blanks trimmed -> TRUE; other text FALSE; NULL stays NULL."""
    return F.upper(F.trim(raw)) == F.lit("TRUE")


def age_band(age: Column) -> Column:
    expr = None
    for upper, label in AGE_BANDS:
        expr = F.when(age < upper, label) if expr is None else expr.when(age < upper, label)
    return F.when(age.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(AGE_BAND_LAST))


def shift_band(hour: Column) -> Column:
    expr = None
    for lo, hi, label in SHIFTS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(SHIFT_OTHER)


def segment_key(age_band_col: Column, gender: Column, race: Column) -> Column:
    """32-hex md5 of 'age_band|gender|race', NULL parts written as 'unknown'."""
    parts = [F.coalesce(c, F.lit(UNKNOWN)) for c in (age_band_col, gender, race)]
    return F.md5(F.concat_ws("|", *parts))
