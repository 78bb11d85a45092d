"""Text forms of database values that have no JSON form of their own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DateType, DoubleType, FloatType, StringType, StructType, TimestampNTZType, TimestampType

from changeloom.model import MULTIRANGE_OIDS, UUID_ARRAY_OID, UUID_OID


def _part(condition: Column, *parts: Column) -> Column:
    return F.when(condition, F.concat(*[p.cast("string") for p in parts])).otherwise("")


def fraction(micros: Column) -> Column:
    """Six digits of microseconds without their trailing zeros, after a point; nothing for none."""
    return _part(micros != 0, F.lit("."), F.rtrim(F.lpad(micros.cast("string"), 6, "0"), F.lit("0")))


def interval_text(months: Column, days: Column, micros: Column) -> Column:
    """ISO 8601: parts that are zero are left out, PT0S stands for nothing. Months divide into years by truncation and
    keep their sign; each part of a negative time has its own. Null if any part is null."""
    whole = F.abs(micros)
    sign = F.when(micros < 0, "-").otherwise("")
    div = lambda a, n: F.floor(a / F.lit(n)).cast("bigint")
    years = (months / 12).cast("bigint")
    hours, minutes, rest = div(whole, 3_600_000_000), div(whole, 60_000_000) % 60, whole % 60_000_000
    time = F.concat(_part(hours != 0, sign, hours, F.lit("H")), _part(minutes != 0, sign, minutes, F.lit("M")), _part(rest != 0, sign, div(rest, 1_000_000), fraction(rest % 1_000_000), F.lit("S")))
    text = F.concat(F.lit("P"), _part(years != 0, years, F.lit("Y")), _part(months % 12 != 0, months % 12, F.lit("M")), _part(days != 0, days, F.lit("D")), _part(micros != 0, F.lit("T"), time))
    text = F.when(text == "P", "PT0S").otherwise(text)
    return F.when(months.isNotNull() & days.isNotNull() & micros.isNotNull(), text)


def bits_text(data: Column, length: Column) -> Column:
    """A bit string of the first length bits, most significant first."""
    digits = F.regexp_extract_all(F.hex(data), F.lit("([0-9A-F])"))
    return F.when(data.isNotNull(), F.substring(F.array_join(F.transform(digits, lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), ""), F.lit(1), length.cast("int")))


#: Kinds of a range's end: included, excluded, unbounded; of an empty range.
INCLUDED, EXCLUDED, UNBOUNDED, EMPTY = "i", "e", "u", "empty"


def range_text(lower: Column, upper: Column, lower_type: Column, upper_type: Column, empty: Column) -> Column:
    """[lo,hi) and so on; empty for an empty range. An end that is unbounded or null has no text, and only included
    ends have square brackets. Null if both kinds of end are."""
    bound = lambda value, kind: F.when(kind == UNBOUNDED, "").otherwise(F.coalesce(value, F.lit("")))
    text = F.concat(F.when(lower_type == INCLUDED, "[").otherwise("("), bound(lower, lower_type), F.lit(","), bound(upper, upper_type), F.when(upper_type == INCLUDED, "]").otherwise(")"))
    return F.when(empty, "empty").when(lower_type.isNotNull() & upper_type.isNotNull(), text)


def float_text(value: Column) -> Column:
    """The shortest text of a double; with an exponent of two digits or more where that is below -4 or above 5."""

    def formed(x: Column) -> Column:
        whole, point = x["digits"], x["point"]
        exponent = F.concat(F.when(point < 1, "-").otherwise("+"), F.lpad(F.abs(point - 1).cast("string"), F.greatest(F.lit(2), F.length(F.abs(point - 1).cast("string"))), F.lit("0")))
        scientific = F.concat(F.substring(whole, 1, 1), F.when(F.length(whole) > 1, F.concat(F.lit("."), F.substring(whole, 2, 400))).otherwise(""), F.lit("e"), exponent)
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), whole)
        large = F.concat(F.rpad(F.substring(whole, F.lit(1), point), point, F.lit("0")), F.when(F.length(whole) > point, F.concat(F.lit("."), F.substring(whole, point + 1, F.lit(400)))).otherwise(""))
        return F.concat(x["sign"], F.when(whole == "", "0").when((point < -3) | (point > 6), scientific).when(point < 1, small).otherwise(large))

    def split(text: Column) -> Column:
        mantissa = F.regexp_extract(text, r"^-?([0-9.]+)", 1)
        shift = F.coalesce(F.nullif(F.regexp_extract(text, r"E(-?[0-9]+)", 1), F.lit("")).cast("int"), F.lit(0))
        digits = F.regexp_replace(mantissa, r"\.", "")
        zeros = F.length(F.regexp_extract(digits, "^0*", 0))
        return F.struct(F.when(text.startswith("-"), "-").otherwise("").alias("sign"), F.regexp_replace(digits, "^0+|0+$", "").alias("digits"), (F.instr(mantissa, ".") - 1 - zeros + shift).alias("point"))

    text = value.cast("string")
    return F.when(text.rlike("^-?[0-9]"), F.transform(F.array(text), lambda t: F.transform(F.array(split(t)), formed)[0])[0]).otherwise(text)


def range_bound(value: Column, kind: DataType) -> Column:
    """The text of a bound by its type: date, timestamp without and with a zone, float, or what casts to text; quotes of
    text don't count."""
    iso = F.regexp_replace(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.?0+$", "")
    if isinstance(kind, DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, TimestampNTZType):
        return iso
    if isinstance(kind, TimestampType):
        return F.concat(iso, F.lit("Z"))
    if isinstance(kind, (DoubleType, FloatType)):
        return float_text(value)
    text = value.cast("string")
    return F.regexp_replace(text, '^"|"$', "") if isinstance(kind, StringType) else text


def multirange_text(ranges: Column) -> Column:
    """{r1,r2} of an array of range texts; {} for none, null for null."""
    return F.when(ranges.isNotNull(), F.concat(F.lit("{"), F.array_join(ranges, ","), F.lit("}")))


def uuid_text(data: Column) -> Column:
    """16 bytes in the canonical 8-4-4-4-12 form; other bytes are text as they are."""
    canonical = F.regexp_replace(F.lower(F.hex(data)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(F.octet_length(data) == 16, canonical).otherwise(F.decode(data, "UTF-8"))


def normalised(value: Column, kind: DataType, oid: int = 0) -> Column:
    """A native value as JSON has it: text for UUIDs, intervals, bit strings, ranges and multiranges, times and bytes;
    arrays element by element; all else as it is.

    Intervals are structs of months, days and micros; bit strings of bits and length; ranges of lower, upper,
    lower_type and upper_type. A multirange is an array of ranges with a type number of its own.
    """
    if isinstance(kind, ArrayType):
        element = UUID_OID if oid == UUID_ARRAY_OID else 0
        parts = F.transform(value, lambda v: normalised(v, kind.elementType, element))
        return multirange_text(parts) if oid in MULTIRANGE_OIDS else parts
    if isinstance(kind, StructType):
        if {"months", "days", "micros"} <= set(kind.names):
            return interval_text(value["months"], value["days"], value["micros"])
        if {"bits", "length"} <= set(kind.names):
            return bits_text(value["bits"], value["length"])
        if {"lower", "upper", "lower_type", "upper_type"} <= set(kind.names):
            low, high = (range_bound(value[c], kind[c].dataType) for c in ("lower", "upper"))
            return range_text(low, high, value["lower_type"], value["upper_type"], value["lower_type"] == EMPTY)
    if isinstance(kind, BinaryType):
        return uuid_text(value) if oid == UUID_OID else F.base64(value)
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return range_bound(value.cast("timestamp"), TimestampType())
    return value
