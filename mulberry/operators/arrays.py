"""ARRAY JOIN: a row for each element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import default_of


def array_join(df: DataFrame, *arrays: str | Column, left: bool = False, alias: str | list[str] | None = None, unequal: bool = False) -> DataFrame:
    """Explode columns or expressions; several go side by side by position, not as a product.

    Without an alias the element takes the array's place; with one the array stays. Rows with empty arrays go, or stay with the
    type's default if ``left``. Arrays of unequal lengths raise an error, or are filled with defaults if ``unequal``.
    """
    names = [alias] if isinstance(alias, str) else list(alias or [])
    columns = [F.col(a) if isinstance(a, str) else a for a in arrays]
    if not names:
        if not all(isinstance(a, str) for a in arrays):
            raise ValueError("expressions need an alias")
        names = list(arrays)
    if len(names) != len(columns):
        raise ValueError("as many aliases as arrays")
    staged = df.select("*", *[c.alias(f"_a{i}") for i, c in enumerate(columns)])
    kinds = [staged.schema[f"_a{i}"].dataType for i in range(len(columns))]
    if not all(isinstance(k, T.ArrayType) for k in kinds):
        raise ValueError("only arrays can be joined")
    zipped = F.transform(F.col("_a0"), lambda x: F.struct(x.alias("0")))
    if len(columns) > 1:
        zipped = F.arrays_zip(*[F.coalesce(F.col(f"_a{i}"), F.array().cast(k)).alias(str(i)) for i, k in enumerate(kinds)])
        if not unequal:
            same = F.lit(True)
            for i in range(1, len(columns)):
                same = same & (F.size(F.coalesce("_a0", F.array().cast(kinds[0]))) == F.size(F.coalesce(f"_a{i}", F.array().cast(kinds[i]))))
            zipped = F.when(same, zipped).otherwise(F.raise_error(F.lit("arrays of unequal lengths")))
    out = staged.withColumn("_e", (F.explode_outer if left else F.explode)(zipped))
    for i, (name, kind) in enumerate(zip(names, kinds, strict=True)):
        cell = F.col("_e")[str(i)]
        fill = (left or unequal) and not isinstance(kind.elementType, T.VariantType)
        out = out.withColumn(name, F.coalesce(cell, default_of(kind.elementType)) if fill else cell)
    return out.drop("_e", *[f"_a{i}" for i in range(len(columns))])
