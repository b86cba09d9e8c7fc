"""Byte-wise masking as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask(c: Column, sign: str) -> Column:
    """First byte, ``sign`` for each byte between, last byte; texts of two bytes or fewer stay.

    The end bytes of texts beyond ASCII show as the Latin-1 characters of those bytes. ASCII texts, whose
    bytes are their characters, take the short way.
    """
    size = F.octet_length(c)
    raw = F.encode(c, "UTF-8")
    plain = F.concat(F.substring(c, 1, 1), F.repeat(F.lit(sign), size - 2), F.substring(c, -1, 1))
    byte = lambda at: F.decode(F.substring(raw, at, 1), "ISO-8859-1")
    exact = F.concat(byte(1), F.repeat(F.lit(sign), size - 2), byte(-1))
    return F.when(size <= 2, c).when(size == F.char_length(c), plain).otherwise(exact)
