"""String to value conversions that give NULL on bad input, whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

# Padding that Spark's string casts ignore: ASCII control characters and blank.
_PAD = r"[\x00-\x20\x7F]*"

# Group 1 is the signed whole part, or a lone "." where there are no whole digits.
# Possessive quantifiers keep the match linear on long digit strings.
# The end is \z: $ would also match before a last line separator such as U+2028.
_WHOLE_PART = rf"^{_PAD}([+-]?(?:[0-9]++|\.(?!\.)))\.?[0-9]*+{_PAD}\z"


def lenient_int(text: Column) -> Column:
    """Whole part of a decimal number: ``"500.0"`` is 500, ``"-1.9"`` is -1, ``".5"`` is 0.

    Plain ``try_cast`` rejects every value with a fraction, and it raises and catches an exception
    for each rejected value. Matching the shape first gives the wanted result and keeps the cost of
    a bad value close to that of a good one.
    """
    whole = F.replace(F.regexp_extract(text, _WHOLE_PART, 1), F.lit("."), F.lit("0"))
    return F.nullif(whole, F.lit("")).try_cast("int")


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def lenient_timestamp(text: Column) -> Column:
    """Timestamp in the session time zone, from any text Spark's timestamp cast accepts."""
    # given as an object: the name "timestamp" means another type under spark.sql.timestampType
    return text.try_cast(TimestampType())
