"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sets import combine
from .base import QUERIES, SQL, read

_CUSTOMERS = "SELECT c_nationkey AS k FROM customer WHERE c_mktsegment = 'BUILDING'"
_SUPPLIERS = "SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 0"


def _add(name: str, operation: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        a = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_nationkey").alias("k"))
        b = read(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("k"))
        return combine(operation, a, b)

    QUERIES[name], SQL[name] = run, f"{_CUSTOMERS} {operation} {_SUPPLIERS}"


for _name, _operation in (("set_union", "UNION"), ("set_union_all", "UNION ALL"), ("set_intersect", "INTERSECT"), ("set_intersect_all", "INTERSECT ALL"), ("set_except", "EXCEPT"), ("set_except_all", "EXCEPT ALL")):
    _add(_name, _operation)
