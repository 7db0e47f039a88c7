"""A select whose clauses may be given in any order and are applied in SQL's:

FINAL, SAMPLE, ARRAY JOIN, JOIN, PREWHERE, WHERE, GROUP BY, HAVING, SELECT, DISTINCT, ORDER BY, LIMIT BY, LIMIT.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import modifiers
from ..operators.arrays import array_join
from ..operators.joins import ch_join


@dataclass(frozen=True)
class Select:
    source: DataFrame
    _final: tuple | None = None
    _sample: tuple | None = None
    _arrays: tuple = ()
    _joins: tuple = ()
    _prewhere: tuple = ()
    _where: tuple = ()
    _group: tuple = ()
    _aggregates: tuple = ()
    _having: tuple = ()
    _columns: tuple = ()
    _distinct: bool = False
    _order: tuple = ()
    _limit_by: tuple | None = None
    _limit: tuple | None = None
    options: dict[str, Any] = field(default_factory=dict)

    def final(self, key: list[str], version: str | None = None, is_deleted: str | None = None) -> Select:
        return replace(self, _final=(key, version, is_deleted))

    def sample(self, amount: float | int | str, key: str | None = None, **more: Any) -> Select:
        return replace(self, _sample=(amount, key, more))

    def array_join(self, *arrays: str | Column, **more: Any) -> Select:
        return replace(self, _arrays=(*self._arrays, (arrays, more)))

    def ch_join(self, right: DataFrame, on: Column | None = None, **more: Any) -> Select:
        return replace(self, _joins=(*self._joins, (right, on, more)))

    def prewhere(self, condition: Column) -> Select:
        return replace(self, _prewhere=(*self._prewhere, condition))

    def where(self, condition: Column) -> Select:
        return replace(self, _where=(*self._where, condition))

    def group_by(self, *keys: str | Column) -> Select:
        return replace(self, _group=keys)

    def aggregate(self, *columns: Column) -> Select:
        return replace(self, _aggregates=columns)

    def having(self, condition: Column) -> Select:
        return replace(self, _having=(*self._having, condition))

    def columns(self, *columns: str | Column) -> Select:
        return replace(self, _columns=columns)

    def distinct(self) -> Select:
        return replace(self, _distinct=True)

    def order_by(self, *columns: str | Column) -> Select:
        return replace(self, _order=columns)

    def limit_by(self, by: list[str], n: int, offset: int = 0) -> Select:
        return replace(self, _limit_by=(by, n, offset))

    def limit(self, n: int, offset: int = 0) -> Select:
        return replace(self, _limit=(n, offset))

    def frame(self) -> DataFrame:
        """The DataFrame of all clauses."""
        df = self.source
        if self._final:
            df = modifiers.final(df, *self._final)
        if self._sample:
            amount, key, more = self._sample
            df = modifiers.sample(df, amount, key, **more)
        for arrays, more in self._arrays:
            df = array_join(df, *arrays, **more)
        for right, on, more in self._joins:
            df = ch_join(df, right, on, **more)
        df = modifiers.prewhere(df, *self._prewhere, *self._where)
        if self._group or self._aggregates:
            df = df.groupBy(*self._group).agg(*self._aggregates) if self._aggregates else df.select(*self._group).distinct()
        df = modifiers.prewhere(df, *self._having)
        if self._columns:
            df = df.select(*self._columns)
        if self._distinct:
            df = df.distinct()
        if self._limit_by:
            by, n, offset = self._limit_by
            df = modifiers.limit_by(df, by, n, list(self._order) or [F.lit(1)], offset)
        if self._order:
            df = df.orderBy(*self._order)
        if self._limit:
            df = modifiers.limit_offset(df, *self._limit)
        return df


def select(source: DataFrame) -> Select:
    return Select(source)
