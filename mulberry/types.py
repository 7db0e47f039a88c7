"""Column types by name, their Spark counterparts, and the defaults that stand where a non-nullable column has no value."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The names of simple types and what holds their range in Spark; unsigned types take the next wider one.
SIMPLE: dict[str, T.DataType] = {
    "Int8": T.ByteType(), "Int16": T.ShortType(), "Int32": T.IntegerType(), "Int64": T.LongType(),
    "UInt8": T.ShortType(), "UInt16": T.IntegerType(), "UInt32": T.LongType(), "UInt64": T.DecimalType(20, 0),
    "Int128": T.DecimalType(38, 0), "UInt128": T.DecimalType(38, 0), "Int256": T.StringType(), "UInt256": T.StringType(),
    "Float32": T.FloatType(), "Float64": T.DoubleType(), "BFloat16": T.FloatType(), "Bool": T.BooleanType(), "Boolean": T.BooleanType(),
    "String": T.StringType(), "UUID": T.StringType(), "IPv4": T.StringType(), "IPv6": T.StringType(),
    "Date": T.DateType(), "Date32": T.DateType(), "DateTime": T.TimestampType(), "DateTime64": T.TimestampType(),
    "Time": T.DayTimeIntervalType(), "Time64": T.DayTimeIntervalType(), "JSON": T.VariantType(), "Dynamic": T.VariantType(), "Variant": T.VariantType(),
    "Nothing": T.NullType(),
}
_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
_LINE = T.ArrayType(_POINT)
SIMPLE |= {"Point": _POINT, "Ring": _LINE, "LineString": _LINE, "Polygon": T.ArrayType(_LINE), "MultiLineString": T.ArrayType(_LINE), "MultiPolygon": T.ArrayType(T.ArrayType(_LINE))}
SIMPLE |= {f"Interval{unit}": T.IntegerType() for unit in ("Nanosecond", "Microsecond", "Millisecond", "Second", "Minute", "Hour", "Day", "Week", "Month", "Quarter", "Year")}
#: Inclusive ranges that are narrower than the Spark type's.
RANGES = {"UInt8": (0, 2**8 - 1), "UInt16": (0, 2**16 - 1), "UInt32": (0, 2**32 - 1), "UInt64": (0, 2**64 - 1)}
DIGITS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38}


def arguments(text: str) -> list[str]:
    """Top-level comma-separated parts of a type's arguments."""
    out, depth, start, quoted = [], 0, 0, False
    for i, c in enumerate(text):
        if c == "'":
            quoted = not quoted
        elif not quoted:
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                out.append(text[start:i].strip())
                start = i + 1
    last = text[start:].strip()
    return [*out, last] if last else out


def spark_type(name: str) -> T.DataType:
    """The Spark type for a type name; ValueError for those that none can hold."""
    name = name.strip()
    base, inner = name, ""
    if m := re.fullmatch(r"(\w+)\s*\((.*)\)", name, re.S):
        base, inner = m[1], m[2]
    args = arguments(inner)
    if base in ("Nullable", "LowCardinality"):
        return spark_type(args[0])
    if base == "Array":
        return T.ArrayType(spark_type(args[0]))
    if base == "Map":
        return T.MapType(spark_type(args[0]), spark_type(args[1]))
    if base in ("Tuple", "Nested"):
        fields = []
        for i, arg in enumerate(args, 1):
            named = re.fullmatch(r"(\w+|`[^`]+`)\s+(.+)", arg, re.S)
            fields.append(T.StructField(named[1].strip("`"), spark_type(named[2])) if named else T.StructField(f"_{i}", spark_type(arg)))
        struct = T.StructType(fields)
        return T.ArrayType(struct) if base == "Nested" else struct
    if base == "Decimal" or base in DIGITS:
        precision, scale = (int(args[0]), int(args[1]) if len(args) > 1 else 0) if base == "Decimal" else (DIGITS[base], int(args[0]))
        if precision > 38:
            raise ValueError(f"{name}: more than 38 digits")
        return T.DecimalType(precision, scale)
    if base == "FixedString":
        return T.BinaryType()
    if base.startswith("Enum"):
        return T.StringType()
    if base == "QBit":
        return T.ArrayType(spark_type(args[0]))
    if base == "SimpleAggregateFunction":
        return spark_type(args[1])
    if base in SIMPLE:
        return SIMPLE[base]
    raise ValueError(f"no Spark type for {name}")


def nullable(name: str) -> bool:
    return re.match(r"\s*(LowCardinality\s*\(\s*)?Nullable\s*\(", name) is not None


def schema(described: str | dict[str, str]) -> T.StructType:
    """'a UInt8, b String' or a dictionary -> Spark schema."""
    pairs = [re.fullmatch(r"(`[^`]+`|\"[^\"]+\"|\S+)\s+(.+)", x, re.S).groups() for x in arguments(described)] if isinstance(described, str) else list(described.items())
    return T.StructType([T.StructField(n.strip("`\""), spark_type(t), True, {"type": t.strip()}) for n, t in pairs])


def default_of(kind: T.DataType) -> Column:
    """What a non-nullable column of this type holds where no value is."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BinaryType):
        return F.lit(b"")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, T.MapType):
        return F.create_map().cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[default_of(f.dataType).alias(f.name) for f in kind.fields])
    return F.lit(0).cast(kind)


def with_defaults(df: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """Null cells of these columns take their type's default, in the rows ``where`` holds (all, if not given)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    filled = {c: F.coalesce(F.col(f"`{c}`"), default_of(kinds[c])) for c in columns}
    return df.withColumns(filled if where is None else {c: F.when(where, x).otherwise(F.col(f"`{c}`")) for c, x in filled.items()})


def checked(column: Column, name: str) -> Column:
    """Cast to the named type; a value outside an unsigned type's range raises an error."""
    if name not in RANGES:
        return column.cast(spark_type(name))
    low, high = RANGES[name]
    wide = column.cast("decimal(38,0)")
    return F.when(wide.isNull() | wide.between(F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(high)).cast("decimal(38,0)")), wide).otherwise(F.raise_error(F.concat(F.lit(f"out of range of {name}: "), wide.cast("string")))).cast(spark_type(name))


def wrapped(column: Column, bits: int = 8) -> Column:
    """Modular signed conversion, as text formats take integers that are too large."""
    half = 1 << (bits - 1)
    return F.pmod(column.cast("long") + half, F.lit(1 << bits)) - half
