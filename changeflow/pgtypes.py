"""PostgreSQL type names and numbers, and what kind of Spark column each is.

The kind of a column decides how filters compare it and whether transforms see it; it comes from the
``pg_oid`` in the field's metadata, else from the Spark type.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Type numbers of the PostgreSQL catalogue (fixed values).
OIDS = {
    "bool": 16, "bytea": 17, "int8": 20, "int2": 21, "int4": 23, "text": 25, "json": 114, "float4": 700, "float8": 701,
    "bool[]": 1000, "int2[]": 1005, "int4[]": 1007, "text[]": 1009, "bytea[]": 1001, "int8[]": 1016, "float4[]": 1021, "float8[]": 1022,
    "bpchar": 1042, "varchar": 1043, "date": 1082, "time": 1083, "timestamp": 1114, "timestamp[]": 1115, "date[]": 1182,
    "timestamptz": 1184, "timestamptz[]": 1185, "interval": 1186, "numeric[]": 1231, "bit": 1560, "varbit": 1562, "numeric": 1700,
    "uuid": 2950, "uuid[]": 2951, "jsonb": 3802, "jsonb[]": 3807,
}
_NAMES = {oid: name for name, oid in OIDS.items()}
#: Not named above, but decoded as text arrays.
VARCHAR_ARRAY = 1015

INT, FLOAT, TEXT, TIMESTAMP, BOOL, NUMERIC, PASSED, OTHER = "int", "float", "text", "timestamp", "bool", "numeric", "passed", "other"
_KINDS = {"int2": INT, "int4": INT, "int8": INT, "float4": FLOAT, "float8": FLOAT, "text": TEXT, "varchar": TEXT, "timestamp": TIMESTAMP, "timestamptz": TIMESTAMP, "bool": BOOL, "numeric": NUMERIC}
_DECODED = {"bytea", "date", "jsonb", "text[]", "int2[]", "int4[]", "int8[]", "float4[]", "float8[]", "bool[]"}


def type_name(oid: int) -> str:
    return _NAMES.get(oid, f"unknown_{oid}")


def type_oid(name: str) -> int:
    return OIDS.get(name, 0)


def oid_of(field: T.StructField) -> int:
    """The type number in the field's metadata, else the usual one of its Spark type."""
    if "pg_oid" in (field.metadata or {}):
        return int(field.metadata["pg_oid"])
    kinds = {T.BooleanType: "bool", T.BinaryType: "bytea", T.LongType: "int8", T.IntegerType: "int4", T.ShortType: "int2", T.ByteType: "int2", T.StringType: "text", T.FloatType: "float4", T.DoubleType: "float8", T.DateType: "date", T.TimestampType: "timestamptz", T.TimestampNTZType: "timestamp", T.DecimalType: "numeric", T.VariantType: "jsonb"}
    t = field.dataType
    if isinstance(t, T.ArrayType):
        inner = type_name(oid_of(T.StructField("e", t.elementType)))
        return OIDS.get(f"{inner}[]", 0)
    return OIDS.get(kinds.get(type(t), ""), 0)


def kind_of(field: T.StructField) -> str:
    """How filters see the column: INT, FLOAT, TEXT, TIMESTAMP, BOOL, NUMERIC, or PASSED (text of other types) and OTHER, which never match a comparison."""
    name = type_name(oid_of(field))
    if name in _KINDS:
        return _KINDS[name]
    if name in _DECODED or oid_of(field) == VARCHAR_ARRAY:
        return OTHER
    return PASSED if isinstance(field.dataType, T.StringType) else OTHER


def is_text_like(field: T.StructField) -> bool:
    """Whether transforms and ``contains`` see a string: text, numeric and every type that is passed on as text."""
    return kind_of(field) in (TEXT, NUMERIC, PASSED)


def spark_type(oid: int, precision: int = 38, scale: int = 18) -> T.DataType:
    """The Spark column for a type number; types without one stay text."""
    name = type_name(oid)
    plain = {"bool": T.BooleanType(), "bytea": T.BinaryType(), "int8": T.LongType(), "int4": T.IntegerType(), "int2": T.ShortType(), "float4": T.FloatType(), "float8": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(), "timestamptz": T.TimestampType(), "numeric": T.DecimalType(precision, scale)}
    if name in plain:
        return plain[name]
    if name.endswith("[]") and name in _DECODED:
        inner = name[:-2]
        return T.ArrayType(T.LongType() if inner.startswith("int") else T.DoubleType() if inner.startswith("float") else T.BooleanType() if inner == "bool" else T.StringType())
    return T.ArrayType(T.StringType()) if oid == VARCHAR_ARRAY else T.StringType()
