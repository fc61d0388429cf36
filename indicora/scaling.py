"""Small helpers that keep plans safe when one key holds much of the data."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def constant_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A fixed lookup as a local relation: its size is known to the optimizer."""
    return spark.createDataFrame(pa.table(columns))


def nulls_last_key(*columns: str | Column) -> Column:
    """Ordering struct in which a null ranks after every value."""
    parts: list[Column] = []
    for item in columns:
        col = F.col(item) if isinstance(item, str) else item
        parts += [col.isNull(), col]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def keep_extreme(
    df: DataFrame, keys: list[str], order: Column, *, last: bool = False
) -> DataFrame:
    """One whole row per key, chosen by ``order``.

    An aggregate, not a ranking window: copies of a hot key are combined inside each map task,
    so no task ever receives the whole group. Nulls in the key compare equal.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def count_before(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    flag: Column,
    slices: list[Column],
    name: str,
) -> DataFrame:
    """Running count of ``flag`` over strictly earlier rows of the key, in ``order``.

    ``slices`` are nested, coarse to fine (say hour, then ten seconds); none may decrease along
    ``order``. Rows are ranked only inside their finest slice. What lies before a slice is added
    up level by level on combined totals: fine slices inside their coarse slice, coarse slices
    inside the key. A key, or an hour of it, that holds a third of all rows is thus spread over
    its slices, and no ordered window sees more than one slice's rows or one level's totals.
    """
    names = [f"_s{i}" for i in range(len(slices))]
    sliced = df.withColumns(dict(zip(names, slices))).withColumn("_flag", flag.cast("long"))

    totals = sliced.groupBy(*keys, *names).agg(F.sum("_flag").alias("_n"))
    before = None
    for depth in range(len(names), 0, -1):
        outer, level = [*keys, *names[: depth - 1]], names[depth - 1]
        earlier = (
            Window.partitionBy(*outer).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        )
        offset = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        placed = totals.select(*outer, level, offset.alias("_offset"))
        before = placed if before is None else _added(before, placed, [*outer, level])
        totals = totals.groupBy(*outer).agg(F.sum("_n").alias("_n"))

    part = [*keys, *names]
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = sliced.withColumn("_local", F.coalesce(F.sum("_flag").over(inside), F.lit(0)))
    joined = _null_safe_join(ranked, before, part)
    return joined.select(*df.columns, (F.col("_local") + F.col("_offset")).alias(name))


def _null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, condition).drop(*[f"_r_{c}" for c in on])


def _added(fine: DataFrame, coarse: DataFrame, on: list[str]) -> DataFrame:
    joined = _null_safe_join(fine, coarse.withColumnRenamed("_offset", "_more"), on)
    return joined.withColumn("_offset", F.col("_offset") + F.col("_more")).drop("_more")
