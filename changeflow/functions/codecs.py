"""PostgreSQL text formats as column expressions: decoding to typed columns and encoding back.

Decoding gives NULL where a text is not of the type; a filter on such a value drops the row, as it does
on a decoding error. Everything stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow import pgtypes

#: Spellings of boolean text (fixed values).
TRUE, FALSE = ("1", "t", "T", "TRUE", "true", "True"), ("0", "f", "F", "FALSE", "false", "False")
_STAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}([.,]\d{1,9})?(Z|[+-]\d{2}(:\d{2})?)?$"


def decode_bool(c: Column) -> Column:
    return F.when(c.isin(*TRUE), True).when(c.isin(*FALSE), False)


def decode_int(c: Column) -> Column:
    return F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("long"))


def decode_float(c: Column) -> Column:
    """The text NULL, in any case, is null."""
    return F.when(F.lower(c) != "null", c.try_cast("double"))


def decode_numeric(c: Column, precision: int = 38, scale: int = 18) -> Column:
    return c.try_cast(f"decimal({precision},{scale})")


def decode_bytea(c: Column) -> Column:
    """``\\x`` and hexadecimal digits, or the bytes of the text."""
    digits = F.substring(c, 3, 2**31 - 1)
    hexed = F.when((F.length(digits) % 2 == 0) & digits.rlike("^[0-9A-Fa-f]*$"), F.unhex(digits))
    return F.when(c.startswith("\\x"), hexed).otherwise(F.encode(c, "UTF-8"))


def decode_timestamp(c: Column) -> Column:
    """Date and time with or without fraction and zone; without zone it is UTC. A bare date or time is none."""
    return F.when(c.rlike(_STAMP), F.replace(c, F.lit(","), F.lit(".")).try_cast("timestamp"))


def decode_date(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def array_elements(c: Column) -> Column:
    """The elements of a one-dimensional array text, NULL ones as null, quotes and backslashes resolved; ``{}`` is empty.

    Elements are cut by a pattern that keeps quoted commas together.
    """
    body = F.substring(c, F.lit(2), F.length(c) - 2)
    raw = F.regexp_extract_all(F.concat(body, F.lit(",")), F.lit(r'("(?:[^"\\]|\\.)*"|[^,"]*),'), F.lit(1))
    plain = lambda e: F.when(e.startswith('"'), F.regexp_replace(F.substring(e, F.lit(2), F.length(e) - 2), r"\\(.)", "$1")).when(F.upper(e) == "NULL", F.lit(None)).otherwise(e)
    return F.when(~c.rlike(r"(?s)^\{.*\}$"), F.lit(None)).when(c == "{}", F.array().cast("array<string>")).otherwise(F.transform(raw, plain))


def decode_array(c: Column, inner: str) -> Column:
    """An array text of elements of the PostgreSQL type ``inner``; null if an element is not of the type."""
    elements = array_elements(c)
    if inner in ("text", "varchar"):
        return elements
    one = {"int2": decode_int, "int4": decode_int, "int8": decode_int, "float4": decode_float, "float8": decode_float, "bool": decode_bool}[inner]
    typed = F.transform(elements, one)
    wrong = F.exists(F.zip_with(elements, typed, lambda a, b: a.isNotNull() & b.isNull()), lambda x: x)
    return F.when(~wrong, typed)


def decode(c: Column, oid: int, precision: int = 38, scale: int = 18) -> Column:
    """The typed column of a text column, by PostgreSQL type number; types without a decoder stay text."""
    name = pgtypes.type_name(oid)
    if oid == pgtypes.VARCHAR_ARRAY:
        name = "text[]"
    if name.endswith("[]") and name[:-2] in ("text", "int2", "int4", "int8", "float4", "float8", "bool"):
        return decode_array(c, name[:-2])
    found = {"bool": decode_bool, "int2": decode_int, "int4": decode_int, "int8": decode_int, "float4": decode_float, "float8": decode_float, "bytea": decode_bytea, "timestamp": decode_timestamp, "timestamptz": decode_timestamp, "date": decode_date}
    if name == "numeric":
        return decode_numeric(c, precision, scale)
    if name in found:
        made = found[name](c)
        return made.try_cast(pgtypes.spark_type(oid)) if name in ("int2", "int4", "float4") else made
    return F.when(F.try_parse_json(c).isNotNull(), c) if name == "jsonb" else c


def encode(c: Column, oid: int) -> Column:
    """The text that PostgreSQL reads for a typed column."""
    name = pgtypes.type_name(oid)
    if name == "bool":
        return F.when(c, "true").when(~c, "false")
    if name == "bytea":
        return F.concat(F.lit("\\x"), F.lower(F.hex(c)))
    if name in ("timestamp", "timestamptz"):
        return F.regexp_replace(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), r"\.?0*Z$", "Z")
    if name.endswith("[]"):
        quoted = lambda e: F.when(e.rlike(r'[,"\\{}\s]') | (e == "") | (F.upper(e) == "NULL"), F.concat(F.lit('"'), F.regexp_replace(e, r'(["\\])', r"\\$1"), F.lit('"'))).otherwise(e)
        return F.concat(F.lit("{"), F.array_join(F.transform(c, lambda e: F.coalesce(quoted(e.cast("string")), F.lit("NULL"))), ","), F.lit("}"))
    return c.cast("string")
