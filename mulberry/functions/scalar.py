"""Scalar functions as Column expressions; all stay inside the JVM but for ``reduced``."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..types import checked, spark_type

to_string = lambda c: c.cast("string")
length = F.octet_length


def to_uint(c: Column, bits: int) -> Column:
    """Checked conversion to an unsigned integer."""
    return checked(c, f"UInt{bits}")


def int_div(a: Column, b: Column) -> Column:
    """Integer quotient; division by zero raises."""
    return F.call_function("div", a, b)


def start_of_day(c: Column) -> Column:
    return F.date_trunc("day", c)


def yyyymm(c: Column) -> Column:
    return (F.year(c) * 100 + F.month(c)).cast("long")


def to_datetime(c: Column, zone: str | None = None) -> Column:
    """A timestamp; with a zone, the text or local time is of that zone."""
    return F.to_utc_timestamp(c, zone) if zone else F.to_timestamp(c)


#: C-style date format codes and Spark's patterns for them.
PATTERNS = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm", "%i": "mm", "%S": "ss", "%s": "ss", "%f": "SSSSSS",
    "%p": "a", "%j": "DDD", "%b": "MMM", "%a": "EEE", "%F": "yyyy-MM-dd", "%T": "HH:mm:ss", "%D": "MM/dd/yy", "%R": "HH:mm",
}


def spark_pattern(pattern: str) -> str:
    """C-style date pattern -> Spark's."""
    out, plain, i = [], "", 0

    def quoted() -> str:
        text = plain.replace("'", "''")
        return f"'{text}'" if any(c.isalpha() for c in text) else text

    while i < len(pattern):
        code = pattern[i : i + 2]
        if code == "%%":
            plain, i = plain + "%", i + 2
        elif code in PATTERNS:
            out += [quoted(), PATTERNS[code]]
            plain, i = "", i + 2
        elif pattern[i] == "%":
            raise ValueError(f"no such code: {code}")
        else:
            plain, i = plain + pattern[i], i + 1
    return "".join([*out, quoted()])


def format_datetime(c: Column, pattern: str, zone: str | None = None) -> Column:
    return F.date_format(F.from_utc_timestamp(c, zone) if zone else c, spark_pattern(pattern))


def format_template(template: str, *columns: Column) -> Column:
    """'{} and {}' or '{0} and {1}' filled with columns; doubled braces are braces."""
    import string

    parts, n = [], 0
    for text, field, spec, _ in string.Formatter().parse(template):
        if spec:
            raise ValueError("no format specifications")
        if text:
            parts.append(F.lit(text))
        if field is not None:
            parts.append(columns[int(field) if field else n].cast("string"))
            n += 1
    return F.concat(*parts)


def has(array: Column, value: Column) -> Column:
    return F.coalesce(F.array_contains(array, value), F.lit(False))


def wkt_polygon(c: Column) -> Column:
    """'POLYGON((x y, ...), (...))' -> array of rings of points."""
    rings = F.regexp_extract_all(c, F.lit(r"\(([^()]+)\)"), F.lit(1))
    point = lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("x"), F.split(F.trim(p), r"\s+")[1].cast("double").alias("y"))
    return F.transform(rings, lambda ring: F.transform(F.split(ring, ","), point))


def array_map(body: Callable[..., Column], *arrays: Column) -> Column:
    """One array: its elements; more: elements by position; arrays of unequal lengths raise an error."""
    if len(arrays) == 1:
        return F.transform(arrays[0], body)
    same = F.size(arrays[0]) == F.size(arrays[1])
    for other in arrays[2:]:
        same = same & (F.size(arrays[0]) == F.size(other))
    zipped = F.arrays_zip(*[a.alias(f"a{i}") for i, a in enumerate(arrays)])
    return F.when(same, F.transform(zipped, lambda x: body(*[x[f"a{i}"] for i in range(len(arrays))]))).otherwise(F.raise_error(F.lit("arrays of unequal lengths")))


def array_filter(body: Callable[[Column], Column], array: Column) -> Column:
    return F.filter(array, body)


def array_sort(array: Column, key: Callable[[Column], Column] | None = None) -> Column:
    """Ascending, nulls last; by a key if given."""
    if key is None:
        return F.array_sort(array)
    return F.transform(F.array_sort(F.transform(array, lambda x: F.struct(key(x).alias("k"), x.alias("v")))), lambda s: s["v"])


def array_enumerate(array: Column) -> Column:
    return F.transform(array, lambda _, i: (i + 1).cast("long"))


def json_array_raw(c: Column) -> Column:
    """Elements of a JSON array as JSON texts, strings with their quotes."""
    elements = F.from_json(c, "array<variant>")
    return F.transform(elements, lambda v: F.to_json(v))


def json_path(c: Column, *path: str, kind: str | None = None) -> Column:
    """A path of a JSON text or variant, cast if a type is named; text otherwise. Keys may hold dots."""
    where = "$" + "".join(f'["{p}"]' if not p.isidentifier() else f".{p}" for p in path)
    target = spark_type(kind).simpleString() if kind else "string"
    return F.try_variant_get(c, where, target)


def parse_json(c: Column) -> Column:
    return F.try_parse_json(c)


def variant_type(c: Column) -> Column:
    return F.schema_of_variant(c)


def l2_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def reduced(bits: int) -> Callable[[Column], Column]:
    """Vectors of 32-bit floats with all but their first ``bits`` bits cleared."""
    if not 1 <= bits <= 32:
        raise ValueError("1 to 32 bits")
    mask = (0xFFFFFFFF << (32 - bits)) & 0xFFFFFFFF

    @F.pandas_udf("array<float>")
    def cut(vectors: pd.Series) -> pd.Series:
        import numpy as np

        return vectors.map(lambda v: None if v is None else (np.asarray(v, np.float32).view(np.uint32) & np.uint32(mask)).view(np.float32))

    return cut


def empty_map(key: str, value: str) -> Column:
    return F.map_from_arrays(F.array().cast(f"array<{spark_type(key).simpleString()}>"), F.array().cast(f"array<{spark_type(value).simpleString()}>"))


def throw_if(condition: Column, message: str) -> Column:
    """0, or an error where the condition holds."""
    return F.when(condition, F.raise_error(F.lit(message))).otherwise(F.lit(0)).cast("int")


def sum_decimal(c: Column, kind: str = "decimal(12,2)") -> Column:
    return F.sum(c.cast(kind))


def ip_to_int(c: Column) -> Column:
    """Dotted IPv4 -> long."""
    part = F.split(c, r"\.")
    return sum((F.shiftleft(part[i].cast("long"), 24 - 8 * i) for i in range(1, 4)), F.shiftleft(part[0].cast("long"), 24))


def int_to_ip(c: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(c.cast("long"), 24 - 8 * i).bitwiseAND(F.lit(255)).cast("string") for i in range(4)])
