"""Joins with strictness.

``ALL`` gives every match, ``ANY`` at most one right row for each left row, ``SEMI`` and ``ANTI`` filter, ``ASOF`` gives the closest.
Unmatched cells of an outer join are nulls, or the types' defaults with ``defaults``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..types import with_defaults

STRICTNESS = (None, "ALL", "ANY", "SEMI", "ANTI", "ASOF")
#: A right side of at most so many bytes, by Spark's estimate, is broadcast where GLOBAL asks for it; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20


def size_estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _check(on: object, isouter: bool, full: bool, cross: bool, using: object, strictness: str | None, distribution: str | None) -> None:
    if strictness not in STRICTNESS:
        raise ValueError(f"no such strictness: {strictness}")
    if distribution not in (None, "GLOBAL"):
        raise ValueError(f"no such distribution: {distribution}")
    if cross and (on is not None or using or strictness or isouter or full):
        raise ValueError("a cross join takes no condition, USING, strictness or outer side")
    if not cross and on is None and not using:
        raise ValueError("a condition or USING is needed")
    if on is not None and using:
        raise ValueError("a condition and USING exclude each other")
    if full and strictness in ("ANY", "SEMI", "ANTI", "ASOF"):
        raise ValueError(f"{strictness} cannot be full")
    if strictness in ("SEMI", "ANTI") and not isouter:
        raise ValueError(f"{strictness} needs isouter")


def first_per_key(right: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row of each key that is least by ``order_by`` and then by the other columns; aggregated before the shuffle, so that hot keys stay small."""
    rest = [*order_by, *[c for c in right.columns if c not in keys and c not in order_by]]
    if not rest:
        return right.select(*keys).distinct()
    picked = right.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in right.columns])


def ch_join(left: DataFrame, right: DataFrame, on: Column | None = None, *, isouter: bool = False, full: bool = False, cross: bool = False, using: list[str] | None = None,
            strictness: str | None = None, distribution: str | None = None, defaults: bool = False, order_by: list[str] | None = None) -> DataFrame:
    """Join by condition or USING. ``order_by`` says which right row ANY keeps. GLOBAL broadcasts the right side if it is small enough.
    ``defaults``: cells of the side that has no match take their type's default; nulls of matched rows stay."""
    _check(on, isouter, full, cross, using, strictness, distribution)
    if cross:
        return left.crossJoin(right)
    if strictness == "ASOF":
        raise ValueError("use asof_join")
    if strictness == "ANY":
        if not using:
            raise ValueError("ANY takes USING")
        right = first_per_key(right, using, order_by or [])
    if distribution == "GLOBAL" and size_estimate(right) <= BROADCAST_BYTES:
        right = F.broadcast(right)
    how = {"SEMI": "left_semi", "ANTI": "left_anti"}.get(strictness or "", "full" if full else "left" if isouter else "inner")
    if not (defaults and how in ("left", "full")):
        return left.join(right, using if using else on, how)
    # marks of both sides tell cells without a match from nulls of the tables, which stay
    out = left.withColumn("_in_left", F.lit(True)).join(right.withColumn("_in_right", F.lit(True)), using if using else on, how)
    own, others = ([c for c in side.columns if c not in (using or [])] for side in (left, right))
    out = with_defaults(out, others, F.col("_in_right").isNull())
    if how == "full":
        out = with_defaults(out, own, F.col("_in_left").isNull())
    return out.drop("_in_left", "_in_right")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_order: str, right_order: str, *, op: str = ">=", isouter: bool = False, bucket: Column | None = None, defaults: bool = False) -> DataFrame:
    """For each left row the right row of equal keys that is closest among those with ``left_order op right_order``.

    Both sides are shuffled once by key into one ordered run, in which the last right row seen is carried along. ``bucket`` (an
    expression of the column ``_t``, non-decreasing with it) divides a key's run into pieces that are ordered apart; the last right
    row of each piece is handed to later pieces, so that a hot key is no single task. Right rows with equal keys and order: the
    greatest by the other columns. A null key or order matches nothing, on either side. ``defaults``: as in ``ch_join``.
    """
    if op not in (">=", ">", "<=", "<"):
        raise ValueError(f"no such comparison: {op}")
    back = op in (">=", ">")
    payload = [c for c in right.columns if c not in keys]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    own = F.struct(*[F.col(c) for c in left.columns])
    shape = right.select(F.struct(*payload).alias("_r")).schema["_r"].dataType
    lefts = left.select(*keys, F.col(left_order).alias("_t"), F.lit(0 if op in (">", "<") else 1).alias("_side"), own.alias("_l"), F.lit(None).cast(shape).alias("_r"))
    whole = F.lit(True)
    for c in keys:
        whole = whole & F.col(c).isNotNull()
    rights = right.where(whole & F.col(right_order).isNotNull()).select(*keys, F.col(right_order).alias("_t"), F.lit(1 if op in (">", "<") else 0).alias("_side"), F.lit(None).cast(lefts.schema["_l"].dataType).alias("_l"), F.struct(*payload).alias("_r"))
    both = lefts.unionByName(rights)
    order = [F.col("_t").asc() if back else F.col("_t").desc(), F.col("_side").asc(), F.col("_r").asc_nulls_first()]
    if bucket is None:
        run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        matched = both.withColumn("_m", F.last("_r", ignorenulls=True).over(run))
    else:
        cut = both.withColumn("_b", bucket)
        run = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        near = cut.withColumn("_m", F.last("_r", ignorenulls=True).over(run))
        latest = cut.where("_r is not null").groupBy(*keys, "_b", "_t").agg(F.max("_r").alias("_x"))  # of equal orders the greatest, as within a piece
        ends = F.struct("_t", F.col("_x").alias("_r"))
        last = latest.groupBy(*keys, "_b").agg((F.max(ends) if back else F.min(ends)).alias("_last"))
        pieces = cut.select(*keys, "_b").distinct().join(last, [*keys, "_b"], "left")
        over = Window.partitionBy(*keys).orderBy(F.col("_b").asc() if back else F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carried = pieces.select(*keys, "_b", F.last("_last", ignorenulls=True).over(over)["_r"].alias("_before"))
        matched = near.join(carried, [*keys, "_b"], "left").withColumn("_m", F.coalesce("_m", "_before"))
    out = matched.where("_l is not null").withColumn("_m", F.when(whole & F.col("_t").isNotNull(), F.col("_m")))
    if not isouter:
        out = out.where("_m is not null")
    out = out.select("_l.*", *[F.col(f"_m.{c}").alias(c) for c in payload], F.col("_m").isNull().alias("_alone"))
    return (with_defaults(out, payload, F.col("_alone")) if defaults else out).drop("_alone")
