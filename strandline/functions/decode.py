"""Column expressions that undo the encodings of a change-event envelope.

All of them are built-in expressions, so a decode stays inside one generated
stage, and all of them turn malformed input into NULL instead of failing the
job (ANSI mode is on).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# timestamp_millis multiplies by 1000 into a 64-bit microsecond count.
_MAX_EPOCH_MS = (2**63 - 1) // 1000


def decode_decimal(encoded: Column, precision: int, scale: int) -> Column:
    """Base64 of a big-endian two's-complement integer, scaled by ``10**-scale``.

    The hexadecimal text is sign-extended to 64 bits and read back as a signed
    number. Eight bytes hold 18 digits, more than the columns decoded here
    have; anything longer, empty, or not base64 gives NULL.
    """
    if precision > 18:
        raise ValueError("decode_decimal reads values of up to 18 digits")
    raw = F.try_to_binary(encoded, F.lit("base64"))
    digits = F.hex(raw)
    filler = F.when(F.substring(digits, 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0"))
    extended = F.concat(F.repeat(filler, 16 - F.length(digits)), digits)
    unscaled = F.conv(extended, 16, -10).try_cast("decimal(19,0)")
    scaled = (unscaled * F.lit(Decimal(1).scaleb(-scale))).try_cast(f"decimal({precision},{scale})")
    return F.when(F.length(raw).between(1, 8), scaled)


def decode_epoch_days(days: Column) -> Column:
    """Days since 1970-01-01 as DATE."""
    return F.date_from_unix_date(days.try_cast("int"))


def decode_zoned_timestamp(text: Column) -> Column:
    """ISO text carrying its zone (``…Z``) as an instant, whatever the session zone."""
    return text.try_cast("timestamp")


def decode_epoch_millis(millis: Column) -> Column:
    """Epoch milliseconds as TIMESTAMP, keeping the milliseconds."""
    number = millis.try_cast("bigint")
    return F.when(number.between(-_MAX_EPOCH_MS, _MAX_EPOCH_MS), F.timestamp_millis(number))
