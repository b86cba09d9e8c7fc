"""Filter predicates, compiled once to column expressions.

Predicates are two-valued: a null value, an operand of the wrong type or a column that is not there is
false. ``where`` drops null like false, so a compiled predicate stays bare and reaches the scan; where
the boolean itself is wanted, ``two_valued`` makes it one.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import pgtypes

COMPARISONS = ("eq", "ne", "gt", "lt", "gte", "lte")
OPERATORS = (*COMPARISONS, "contains")
_STAMP = re.compile(r"(\d{4}-\d{2}-\d{2})[ T](\d{2}:\d{2}:\d{2})(?:[.,](\d{1,9}))?(Z|[+-]\d{2}(?::\d{2})?)?")


def as_int(v: object) -> int | None:
    """An integer operand: integers and their texts, no floats and no booleans."""
    if isinstance(v, bool):
        return None
    if isinstance(v, int):
        return v if -(2**63) <= v < 2**63 else None
    return as_int(int(v)) if isinstance(v, str) and re.fullmatch(r"[+-]?\d+", v) else None


def as_float(v: object) -> float | None:
    if isinstance(v, bool):
        return None
    if isinstance(v, (int, float)):
        return float(v)
    try:
        return float(v) if isinstance(v, str) and v == v.strip() and v else None
    except ValueError:
        return None


def as_timestamp(v: object) -> datetime | None:
    """A point in time from one of the timestamp layouts; without zone it is UTC."""
    if isinstance(v, datetime):
        return v.astimezone(timezone.utc) if v.tzinfo else v.replace(tzinfo=timezone.utc)
    if not isinstance(v, str) or not (m := _STAMP.fullmatch(v)):
        return None
    zone = m[4] or "Z"
    try:
        at = datetime.fromisoformat(f"{m[1]}T{m[2]}.{(m[3] or '0')[:6].ljust(6, '0')}+00:00")
    except ValueError:
        return None
    if zone == "Z":
        return at
    sign = 1 if zone[0] == "+" else -1
    hours, _, minutes = zone[1:].partition(":")
    return at - sign * timedelta(hours=int(hours), minutes=int(minutes or 0))


def as_decimal(v: object) -> Decimal | None:
    """A numeric operand, which must be text."""
    try:
        found = Decimal(v) if isinstance(v, str) and v == v.strip() else None
    except InvalidOperation:
        return None
    return found if found is not None and found.is_finite() else None


def _ordered(c: Column, operator: str, value: Column) -> Column:
    return {"eq": c == value, "ne": c != value, "gt": c > value, "lt": c < value, "gte": c >= value, "lte": c <= value}[operator]


def _never() -> Column:
    return F.lit(False)


def _decimal(c: Column, field: T.StructField, value: Decimal, operator: str) -> Column:
    exponent = max(0, -value.as_tuple().exponent)
    digits = max(len(value.as_tuple().digits) + max(0, value.as_tuple().exponent), exponent + 1)
    if digits > 38:
        raise ValueError(f"numeric operands have at most 38 digits: {value}")
    literal = F.lit(format(value, "f")).cast(T.DecimalType(digits, exponent))
    # Text of a numeric column has no fixed scale; 18 places hold what a comparison needs.
    return _ordered(c if isinstance(field.dataType, T.DecimalType) else c.try_cast("decimal(38,18)"), operator, literal)


def predicate(c: Column, field: T.StructField, operator: str, value: object, typed: bool = False) -> Column:
    """``c operator value`` for a column of the field's type. With ``typed``, dates compare as dates, other texts as texts; else they never match."""
    if operator not in OPERATORS:
        raise ValueError(f"{operator!r} is none of the operators {sorted(OPERATORS)}")
    kind = pgtypes.kind_of(field)
    if operator == "contains":
        if not isinstance(value, str) or not pgtypes.is_text_like(field):
            return _never()
        return F.contains(c.cast("string"), F.lit(value))
    if kind == pgtypes.INT:
        v = as_int(value)
        return _never() if v is None else _ordered(c, operator, F.lit(v))
    if kind == pgtypes.FLOAT:
        v = as_float(value)
        if v is None:
            return _never()
        # Not-a-number equals nothing and is not ordered; Spark takes it as the largest number.
        if v != v:
            return c.isNotNull() if operator == "ne" else _never()
        compared = _ordered(c.cast("double"), operator, F.lit(v)) if isinstance(field.dataType, T.FloatType) else _ordered(c, operator, F.lit(v))
        if operator == "ne":
            return F.isnan(c) | compared
        return ~F.isnan(c) & compared if operator in ("gt", "gte") else compared
    if kind == pgtypes.TEXT:
        return _ordered(c, operator, F.lit(value)) if isinstance(value, str) else _never()
    if kind == pgtypes.TIMESTAMP:
        v = as_timestamp(value)
        if v is None:
            return _never()
        literal = F.lit(v.replace(tzinfo=None)).cast("timestamp_ntz") if isinstance(field.dataType, T.TimestampNTZType) else F.lit(v)
        return _ordered(c, operator, literal)
    if kind == pgtypes.BOOL:
        if not isinstance(value, bool) or operator in ("gt", "lt"):
            return _never()
        return c != F.lit(value) if operator == "ne" else c == F.lit(value)
    if kind == pgtypes.NUMERIC:
        v = as_decimal(value)
        return _never() if v is None else _decimal(c, field, v, operator)
    if typed and isinstance(field.dataType, T.DateType) and isinstance(value, str):
        return _ordered(c, operator, F.lit(value).try_cast("date"))
    if typed and kind == pgtypes.PASSED and isinstance(value, str):
        return _ordered(c, operator, F.lit(value))
    return _never()


def two_valued(c: Column) -> Column:
    """The predicate as a boolean column: null is false."""
    return F.coalesce(c, F.lit(False))
