"""Log positions and commit times as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lsn_text(lsn: Column) -> Column:
    """A 64-bit position as two hexadecimal halves, X/X."""
    return F.format_string("%X/%X", F.shiftrightunsigned(lsn, 32), lsn.bitwiseAND(F.lit(4294967295)))


def lsn_number(text: Column) -> Column:
    """lsn_text() undone; null where the text isn't of that form."""
    half = lambda k: F.conv(F.split(text, "/")[k], 16, 10).cast("bigint")
    return F.when(text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), half(0) * F.lit(4294967296) + half(1))


def commit_time(ts: Column) -> Column:
    """UTC to the second, cut off. The session's time zone must be UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def exact_time(ts: Column) -> Column:
    """UTC with the fraction of the second, its trailing zeros cut off."""
    return F.concat(F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.?0+$", ""), F.lit("Z"))
