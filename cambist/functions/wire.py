"""Decoding of the values a change-event connector puts on the wire.

Nothing here raises on bad input: an undecodable value becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Padded base64 only; Spark's own decoder also accepts spaces and missing padding.
STRICT_BASE64 = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"

# The first six bits decide the sign: these characters stand for 32 to 63.
NEGATIVE_BASE64 = "^[g-z0-9+/]"

# First and last instants of the years 1 and 9999, the range a Spark timestamp can show.
MIN_MICROS = -62_135_596_800_000_000
MAX_MICROS = 253_402_300_799_999_999

DECIMAL_MODES = ("auto", "precise", "string", "double")


def wire_type(column: T.StructField) -> T.DataType:
    """How a column is read from JSON: as text, or as VARIANT where its JSON type matters."""
    if isinstance(column.dataType, T.DecimalType):
        return T.VariantType()
    if isinstance(column.dataType, (T.LongType, T.TimestampType, T.StringType)):
        return T.StringType()
    raise ValueError(f"no wire form for {column.dataType.simpleString()} ({column.name})")


def integer(text: Column) -> Column:
    """A whole number, also one written with a fraction of zeros; a true fraction is NULL."""
    whole = F.regexp_extract(text, r"^([+-]?[0-9]+)\.0+$", 1)
    return F.coalesce(text.try_cast("bigint"), whole.try_cast("bigint"))


def log_position(text: Column) -> Column:
    """A non-negative whole number, given as a number or as digits."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def micro_timestamp(text: Column) -> Column:
    micros = integer(text)
    return F.when(micros.between(MIN_MICROS, MAX_MICROS), F.timestamp_micros(micros))


def milli_timestamp(text: Column) -> Column:
    millis = integer(text)
    return F.when(millis.between(MIN_MICROS // 1000, MAX_MICROS // 1000), F.timestamp_millis(millis))


def unscaled_integer(encoded: Column) -> Column:
    """Strict base64 of a big-endian two's-complement integer → BIGINT.

    Any width decodes as long as the value fits 64 bits; a wider value is NULL,
    as it fits no money column either.
    """
    digits = F.hex(F.try_to_binary(encoded, F.lit("base64")))
    sign = F.when(encoded.rlike(NEGATIVE_BASE64), F.lit("F")).otherwise(F.lit("0"))
    # Only the rare wide payload has sign bytes worth dropping.
    minimal = F.regexp_replace(digits, "^(?:(?:00)+(?=[0-7])|(?:FF)+(?=[89A-F]))", "")
    wide = F.when(F.length(minimal) <= 16, minimal)
    eight_bytes = F.lpad(F.when(F.length(encoded) > 12, wide).otherwise(digits), 16, sign)
    return F.when(F.length(encoded) > 0, F.conv(eight_bytes, 16, -10).try_cast("bigint"))


def wide_integer(encoded: Column) -> Column:
    """Strict base64 of a big-endian two's-complement integer → its digits, up to 128 bits.

    Two limbs of 64 bits: the value is (signed upper) * 2**64 + lower, and where it has no
    more than 38 digits, the product and the sum are exact decimals. Wider is NULL.

    Plain expressions throughout, which are compiled; a lambda would be interpreted row by row.
    """
    digits = F.hex(F.try_to_binary(encoded, F.lit("base64")))
    negative = encoded.rlike(NEGATIVE_BASE64)
    # Only the rare payload beyond 16 bytes has sign bytes worth dropping.
    minimal = F.regexp_replace(digits, "^(?:(?:00)+(?=[0-7])|(?:FF)+(?=[89A-F]))", "")
    beyond = (F.length(encoded) > 24) | ((F.length(encoded) == 24) & ~encoded.endswith("=="))
    kept = F.when(beyond, F.when(F.length(minimal) <= 32, minimal)).otherwise(digits)
    limbs = F.lpad(kept, 32, F.when(negative, F.lit("F")).otherwise(F.lit("0")))
    base = F.lit(str(1 << 64)).cast("decimal(20,0)")
    # Both terms with the value's sign, so that neither has more digits than it.
    carry = F.when(negative, F.lit(1)).otherwise(F.lit(0))
    upper = F.conv(F.substring(limbs, 1, 16), 16, -10).cast("decimal(20,0)") + carry
    lower = F.conv(F.substring(limbs, 17, 16), 16, 10).cast("decimal(20,0)") - carry * base
    value = F.try_add(F.try_multiply(upper, base), lower).try_cast("decimal(38,0)")
    return F.when(F.length(encoded) > 0, value.cast("string"))


def _pointed(digits: Column, scale: int) -> Column:
    """Digits of a whole number of units of the last place as the text of a decimal, which a cast reads exactly."""
    return F.concat(digits, F.lit(f"E-{scale}"))


def variant_text(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "string")


def money(variant: Column, text: Column, decimal_type: T.DecimalType, mode: str = "auto") -> Column:
    """An amount in any of the forms a connector can be told to send.

    ``text`` is ``variant_text(variant)`` as a column of its own, since it is
    referred to many times. Only for text that could be a string or another
    JSON value is the value's type looked up. ``auto`` reads a string as base64
    if it is valid base64 and as plain digits otherwise, so digits that happen
    to be valid base64 (``"1499"``) need ``string`` or ``double`` mode.
    """
    if mode not in DECIMAL_MODES:
        raise ValueError(f"decimal mode must be one of {DECIMAL_MODES}, not {mode!r}")
    target = decimal_type.simpleString()
    scale = decimal_type.scale
    wide = decimal_type.precision > 18  # beyond the 64 bits that the usual column is decoded by

    def scaled(unscaled: Column) -> Column:
        if wide:
            return _pointed(unscaled.cast("string"), scale).try_cast(target)
        unit = F.lit(f"{10**-scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")
        return (unscaled.cast("decimal(19,0)") * unit).try_cast(target)

    kind = F.schema_of_variant(variant)
    from_base64 = scaled(wide_integer(text) if wide else unscaled_integer(text))
    from_digits = text.try_cast(target)
    is_base64 = text.rlike(STRICT_BASE64)
    looks_like_a_number = text.rlike("^-?[0-9]")
    if mode == "auto":
        from_string = F.when(is_base64, from_base64).when(looks_like_a_number, from_digits)
    elif mode == "precise":
        # Fractions are numbers; they reach this point without their type.
        fraction = text.contains(".") & (kind != "STRING") & looks_like_a_number
        from_string = F.when(is_base64, from_base64).when(fraction, from_digits)
    else:
        from_string = F.when(looks_like_a_number, from_digits)
    whole = F.when(kind == "BIGINT", scaled(text.try_cast("bigint")))
    if wide:  # a whole number of more digits than a bigint may hold; the longest bigints are read the same way
        whole = F.when(F.length(text) > 18, scaled(text)).when(kind == "BIGINT", scaled(text))
    whole = whole.when(kind.startswith("DECIMAL"), from_digits)
    return (
        F.when(text.isNull(), None)
        .when(text.rlike("^(?:-?[0-9]+|true)$") & (kind != "STRING"), whole)
        .otherwise(from_string)
    )
