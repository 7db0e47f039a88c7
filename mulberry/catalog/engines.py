"""Table engines as table properties, and what they mean when a table is read."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.modifiers import final
from ..plans.params import quote_ident
from ..sinks.tables import ident
from ..types import arguments, schema

FAMILIES = ("MergeTree", "ReplacingMergeTree", "SummingMergeTree", "AggregatingMergeTree", "CollapsingMergeTree", "VersionedCollapsingMergeTree", "Memory", "Log", "StripeLog", "TinyLog", "Null", "Set", "File", "Merge", "Distributed")


@dataclass(frozen=True)
class Engine:
    """An engine's name and parameters; replicated and shared variants are their base engines, as storage replicates."""

    name: str = "MergeTree"
    order_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    sample_by: str = ""
    ttl: str = ""
    arguments: tuple[str, ...] = ()
    settings: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.base not in FAMILIES:
            raise ValueError(f"no such engine: {self.name}")
        if self.base.endswith("MergeTree") and not (self.order_by or self.primary_key):
            raise ValueError(f"{self.name} needs order_by or primary_key")

    @property
    def base(self) -> str:
        return re.sub(r"^(Replicated|Shared)", "", self.name)

    @property
    def key(self) -> list[str]:
        return [*(self.order_by or self.primary_key)]

    def text(self) -> str:
        parts = [f"{self.name}({', '.join(self.arguments)})" if self.arguments else self.name]
        for word, columns in (("PARTITION BY", self.partition_by), ("PRIMARY KEY", self.primary_key), ("ORDER BY", self.order_by)):
            if columns:
                parts.append(f"{word} ({', '.join(columns)})")
        parts += [f"SAMPLE BY {self.sample_by}"] * bool(self.sample_by) + [f"TTL {self.ttl}"] * bool(self.ttl)
        if self.settings:
            parts.append("SETTINGS " + ", ".join(f"{k} = {v}" for k, v in self.settings.items()))
        return " ".join(parts)


def parse_engine(text: str) -> Engine:
    """An engine from its full text."""
    head = re.match(r"\s*(\w+)\s*(?:\(([^()]*)\))?", text)
    if not head:
        raise ValueError(f"no engine: {text}")

    def clause(word: str) -> str:
        m = re.search(rf"\b{word}\s+(.*?)(?=\s+(?:PARTITION BY|PRIMARY KEY|ORDER BY|SAMPLE BY|TTL|SETTINGS)\b|$)", text[head.end() :], re.S)
        return m[1].strip() if m else ""

    def columns(word: str) -> tuple[str, ...]:
        inner = clause(word)
        inner = inner[1:-1] if inner.startswith("(") and inner.endswith(")") else re.sub(r"^tuple\((.*)\)$", r"\1", inner)
        return tuple(arguments(inner))

    given = dict(x.split("=", 1) for x in arguments(clause("SETTINGS")))
    own = tuple(x.strip("'") for x in arguments(head[2] or ""))
    skip = 2 if head[1].startswith(("Replicated", "Shared")) and len(own) >= 2 and own[0].startswith("/") else 0
    return Engine(head[1], columns("ORDER BY"), columns("PARTITION BY"), columns("PRIMARY KEY"), clause("SAMPLE BY"), clause("TTL"), own[skip:], {k.strip(): v.strip() for k, v in given.items()})


def create_table(spark: SparkSession, table: str, described: str | dict[str, str], engine: Engine, comment: str = "", if_not_exists: bool = False) -> None:
    """A Parquet table with the engine as properties; partitions by the engine's plain partition columns."""
    kinds = schema(described)
    columns = ", ".join(f"{quote_ident(f.name)} {f.dataType.simpleString()}" for f in kinds.fields)
    names = [c for c in engine.partition_by if c in kinds.names]
    text = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    types = {f.name: f.metadata.get("type", "") for f in kinds.fields}
    properties = {"engine.name": engine.name, "engine.full": engine.text(), "engine.json": json.dumps(asdict(engine)), "engine.types": json.dumps(types)}
    spark.sql(
        f"CREATE TABLE {'IF NOT EXISTS ' * if_not_exists}{ident(table)} ({columns}) USING parquet"
        + (f" PARTITIONED BY ({', '.join(map(quote_ident, names))})" if names else "") + (f" COMMENT {text(comment)}" if comment else "")
        + f" TBLPROPERTIES ({', '.join(f'{text(k)} = {text(v)}' for k, v in properties.items())})")


def engine_of(spark: SparkSession, table: str) -> Engine:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {ident(table)}").collect()}
    if "engine.json" not in found:
        raise ValueError(f"{table} has no engine")
    stored = json.loads(found["engine.json"])
    return Engine(**{k: tuple(v) if isinstance(v, list) else v for k, v in stored.items()})


#: Functions of aggregated columns; any value will do for ``any`` and ``anyLast``, so the least is taken, which reruns repeat.
MERGES = {"sum": F.sum, "min": F.min, "max": F.max, "any": F.min, "anyLast": F.min, "groupBitAnd": F.bit_and, "groupBitOr": F.bit_or, "groupBitXor": F.bit_xor}


def merge_function(kind: str) -> str | None:
    """The function of a type ``SimpleAggregateFunction(f, T)``; None for other types."""
    m = re.fullmatch(r"\s*SimpleAggregateFunction\s*\((.*)\)\s*", kind, re.S)
    if not m:
        return None
    name = arguments(m[1])[0]
    if name not in MERGES:
        raise ValueError(f"no merging by {name}")
    return name


def read(df: DataFrame, engine: Engine, types: dict[str, str] | None = None) -> DataFrame:
    """The rows of a table as its engine merges them: newest versions, sums, states, or pairs that cancel; without what TTL has expired.

    Summing: numeric columns that are not of the key are added up (of all, or those named), others keep their least value.
    Aggregating: columns whose type in ``types`` is ``SimpleAggregateFunction(f, T)`` are merged by f and keep their type, others keep their least value.
    Collapsing: rows with sign 1 that no row of sign -1 with equal other columns (versions included) cancels.
    """
    if engine.ttl:
        df = df.where(~F.coalesce(F.expr(engine.ttl) < F.current_timestamp(), F.lit(False)))
    key, base, args = engine.key, engine.base, engine.arguments
    if base == "ReplacingMergeTree":
        return final(df, key, args[0] if args else None, args[1] if len(args) > 1 else None)
    if base == "SummingMergeTree":
        numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
        added = [c for c in df.columns if c not in key and (c in args if args else c in numeric)]
        return df.groupBy(*key).agg(*[(F.sum(c) if c in added else F.min(c)).alias(c) for c in df.columns if c not in key]).select(*df.columns)
    if base == "AggregatingMergeTree":
        own = [(f, MERGES[merge_function((types or {}).get(f.name, "")) or "any"]) for f in df.schema.fields if f.name not in key]
        if not own:
            return df.dropDuplicates(key)
        return df.groupBy(*key).agg(*[merge(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f, merge in own]).select(*df.columns)
    if base in ("CollapsingMergeTree", "VersionedCollapsingMergeTree"):
        sign = args[0]
        rest = [c for c in df.columns if c != sign]
        left = df.groupBy(*rest).agg(F.sum(sign).alias("_n")).where("_n > 0")
        return left.select(*rest, F.lit(1).cast(df.schema[sign].dataType).alias(sign), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i")).select(*df.columns)
    return df


def table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, read as its engine says."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {ident(name)}").collect()}
    return read(spark.table(name), engine_of(spark, name), json.loads(found.get("engine.types", "{}")))
