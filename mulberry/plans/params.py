"""Typed parameters of SQL texts. Values are never put into the text: they go to Spark as named arguments."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..types import spark_type

_SERVER = r"\{\s*(?P<name>\w+)\s*:\s*(?P<kind>[^{}]+?)\s*\}"
_CLIENT = r"%\((?P<name>\w+)\)s"
_COMMENT = re.compile(r"('(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`)|(--[^\n]*|/\*.*?\*/)", re.S)
_QUOTED = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`"
_WORDS = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`|\w+|\S")


def strip_comments(sql: str) -> str:
    """SQL without comments; quoted text stays as it is."""
    return _COMMENT.sub(lambda m: m[1] or " ", sql).strip()


def classify(sql: str) -> str:
    """'select', 'insert' or 'command'."""
    first = re.match(r"\W*(\w+)", strip_comments(sql))
    word = first[1].upper() if first else ""
    if word in ("SELECT", "WITH", "SHOW", "DESCRIBE", "DESC", "EXISTS", "VALUES", "EXPLAIN", "FROM"):
        return "select"
    return "insert" if word == "INSERT" else "command"


def has_limit(sql: str) -> bool:
    """Whether the outermost SELECT has a LIMIT."""
    depth = 0
    for word in _WORDS.findall(strip_comments(sql)):
        depth += (word == "(") - (word == ")")
        if depth == 0 and word.upper() == "LIMIT":
            return True
    return False


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: Any) -> Any:
    """A Python value as Spark takes it for an argument."""
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(literal(x)) for x in value])
    if isinstance(value, dict):
        return F.map_from_arrays(F.array(*[F.lit(literal(k)) for k in value]), F.array(*[F.lit(literal(v)) for v in value.values()]))
    if isinstance(value, uuid.UUID):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def _outside(marker: str, replaced: Callable[[re.Match], str], sql: str) -> str:
    """Replace what matches, but for quoted text."""
    return re.sub(f"(?P<quoted>{_QUOTED})|{marker}", lambda m: m[0] if m["quoted"] else replaced(m), sql, flags=re.S)


def bound(sql: str, parameters: dict[str, Any] | list | tuple | None = None) -> tuple[str, dict[str, Any]]:
    """SQL with ``{name:Type}``, ``{name:Identifier}``, ``%(name)s`` or ``%s`` -> SQL with ``:name`` markers, and the arguments.
    What looks like a marker inside quoted text or a quoted name stays as it is."""
    args: dict[str, Any] = {}
    if isinstance(parameters, (list, tuple)):
        values = iter(enumerate(parameters))

        def positional(m: re.Match) -> str:
            i, value = next(values)
            args[f"p{i}"] = literal(value)
            return f":p{i}"

        return _outside("%s", positional, sql), args
    given = parameters or {}

    def typed(m: re.Match) -> str:
        name, kind = m["name"], m["kind"]
        if name not in given:
            raise ValueError(f"no value for parameter {name}")
        value = given[name]
        if kind == "Identifier":
            args[name] = value
            return f"IDENTIFIER(:{name})"
        args[name] = str(value) if isinstance(value, int) and abs(value) >= 1 << 63 else literal(value)
        return f"CAST(:{name} AS {spark_type(kind).simpleString()})"

    def untyped(m: re.Match) -> str:
        name = m["name"]
        if name not in given:
            raise ValueError(f"no value for parameter {name}")
        args[name] = literal(given[name])
        return f":{name}"

    return _outside(_CLIENT, untyped, _outside(_SERVER, typed, sql)), args


def query(spark: SparkSession, sql: str, parameters: dict[str, Any] | list | tuple | None = None, limit: int = 0) -> DataFrame:
    """Run SQL with parameters. ``limit`` applies to selects that have none of their own."""
    text, args = bound(strip_comments(sql), parameters)
    df = spark.sql(text, args)
    return df.limit(limit) if limit and classify(sql) == "select" and not has_limit(sql) else df


@dataclass(frozen=True)
class QueryContext:
    """A query that is run again with other parameters."""

    sql: str
    parameters: dict[str, Any] = field(default_factory=dict)
    limit: int = 0

    def set_parameters(self, **values: Any) -> QueryContext:
        return replace(self, parameters=self.parameters | values)

    def updated_copy(self, **changes: Any) -> QueryContext:
        return replace(self, **changes)

    def run(self, spark: SparkSession) -> DataFrame:
        return query(spark, self.sql, self.parameters, self.limit)


