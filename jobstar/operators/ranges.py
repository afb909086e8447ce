"""Running sums and islands inside groups of any size, without gathering a group into one task.

Rows are dealt by range of (group, order) and written once, so that a large group lies over
several consecutive partitions. Windows run inside partitions; what crosses a partition's
border travels in one row per group and partition, of which a group has at most as many as
there are partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize


def dealt_by_range(df: DataFrame, keys: list[str], order: str, partitions: int | None = None) -> DataFrame:
    """``df`` sorted over its partitions by ``keys`` and ``order``, with the partition as ``_part``."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *keys, order).withColumn("_part", F.spark_partition_id()), "dealt-by-range")


def _join_segments(rows: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of their (group, partition); NULL groups are groups like others."""
    renamed = segments.withColumnsRenamed({c: f"_s_{c}" for c in (*keys, "_part")})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in (*keys, "_part")])
    return rows.join(renamed, same).drop(*[f"_s_{c}" for c in (*keys, "_part")])


def running_sum(df: DataFrame, keys: list[str], order: str, value: str, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the group's rows up to this one by ``order``
    (unique inside a group), and ``{name}_total`` over the whole group."""
    rows = dealt_by_range(df, keys, order, partitions)
    by_group = Window.partitionBy(*keys)
    segments = rows.groupBy(*keys, "_part").agg(F.sum(value).alias("_own"))
    segments = segments.select(*keys, "_part", F.sum("_own").over(by_group).alias(f"{name}_total"), F.coalesce(
        F.sum("_own").over(by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part", *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = _join_segments(rows.withColumn(name, F.sum(value).over(inside)), segments, keys)
    return summed.withColumn(name, F.col(name) + F.col("_before")).drop("_before", "_part")


def islands(df: DataFrame, keys: list[str], order: str, gap: int, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: the least ``order`` of the row's island, where neighbours of a group are on one
    island if their ``order`` differs by at most ``gap``. ``order`` is unique inside a group."""
    rows = dealt_by_range(df, keys, order, partitions)
    inside = Window.partitionBy("_part", *keys).orderBy(order)
    opens = F.lag(order).over(inside).isNull() | (F.col(order) - F.lag(order).over(inside) > gap)
    rows = rows.withColumn("_opens", opens).withColumn(
        name, F.max(F.when(F.col("_opens"), F.col(order))).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    segments = rows.groupBy(*keys, "_part").agg(
        F.min(order).alias("_from"), F.max(order).alias("_to"), F.max(name).alias("_last"))
    by_part = Window.partitionBy(*keys).orderBy("_part")
    goes_on = F.coalesce(F.col("_from") - F.lag("_to").over(by_part) <= gap, F.lit(False))
    segments = segments.withColumn("_goes_on", goes_on)
    # The newest island that began in an earlier partition; one that fills a whole partition began before it.
    begun = F.when(~F.col("_goes_on") | (F.col("_last") > F.col("_from")), F.col("_last"))
    segments = segments.select(*keys, "_part", "_from", "_goes_on", F.last(begun, ignorenulls=True).over(
        by_part.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    first = F.col("_goes_on") & (F.col(name) == F.col("_from"))
    return (_join_segments(rows, segments, keys).withColumn(name, F.when(first, F.col("_carried")).otherwise(F.col(name)))
            .drop("_opens", "_from", "_goes_on", "_carried", "_part"))


def grouped_quantile(counts: DataFrame, keys: list[str], value: str, n: str, q: float, name: str,
                     partitions: int | None = None) -> DataFrame:
    """``keys, {name}_n, name``: the linear-interpolated ``q`` quantile of every group at once, from
    ``counts`` (``keys, value, n``: how often the group has the value; a pair may come several times)."""
    per_value = counts.groupBy(*keys, value).agg(F.sum(n).alias("_n"))
    ranked = running_sum(per_value, keys, value, "_n", "_upto", partitions)
    pos = (F.col("_upto_total") - 1) * F.lit(float(q))
    holds = lambda rank: (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))
    picked = (ranked.where(holds(F.floor(pos)) | holds(F.ceil(pos)))
              .groupBy(*keys, "_upto_total")
              .agg(F.max(F.when(holds(F.floor(pos)), F.col(value).cast("double"))).alias("_lo"),
                   F.max(F.when(holds(F.ceil(pos)), F.col(value).cast("double"))).alias("_hi")))
    return picked.select(*keys, F.col("_upto_total").alias(f"{name}_n"),
                         (F.col("_lo") + (pos - F.floor(pos)) * (F.col("_hi") - F.col("_lo"))).alias(name))
