"""Errors by the DB-API's names."""

from __future__ import annotations

from pyspark.errors import AnalysisException, ParseException, PySparkException


class Warning(Exception):  # noqa: A001
    """Named by the DB-API."""


class Error(Exception):
    def __init__(self, message: str, code: str | None = None, state: str | None = None):
        super().__init__(message)
        self.code, self.state = code, state


class InterfaceError(Error): ...


class DatabaseError(Error): ...


class DataError(DatabaseError): ...


class OperationalError(DatabaseError): ...


class IntegrityError(DatabaseError): ...


class InternalError(DatabaseError): ...


class ProgrammingError(DatabaseError): ...


class NotSupportedError(DatabaseError): ...


def wrapped(error: PySparkException) -> Error:
    """A Spark error as one of these, with its condition and SQL state; long plans are left out of the message."""
    kind = ProgrammingError if isinstance(error, (ParseException, AnalysisException)) else OperationalError
    code = error.getCondition() if hasattr(error, "getCondition") else None
    state = error.getSqlState() if hasattr(error, "getSqlState") else None
    return kind(str(error).split("JVM stacktrace")[0].split("== SQL")[0].strip(), code, state)
