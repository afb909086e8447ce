"""Exact order statistics without gathering a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .joins import with_totals


def exact_quantile(df: DataFrame, value_col: str, q: float) -> DataFrame:
    """One row ``(n, value)``: the linear-interpolated ``q`` quantile of non-null values
    (same definition as ``percentile`` / ``percentile_cont``); NULL without values.

    Equal values are counted first, with map-side partial counts. The counts are
    range-partitioned by value; the partitions' totals (one row per partition) show which
    partitions hold the one or two ranks wanted, and only those are ordered and added up.
    """
    counts = df.where(F.col(value_col).isNotNull()).groupBy(F.col(value_col).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(counts.repartitionByRange(parts, "_v").withColumn("_part", F.spark_partition_id()),
                         "value-counts")
    totals = ranged.groupBy("_part").agg(F.sum("_n").alias("_rows"))
    upto = Window.orderBy("_part")  # one row per partition
    totals = totals.select("_part", "_rows", (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before"))
    n = ranged.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n"))
    pos = (F.col("n") - 1) * F.lit(float(q))
    held = lambda rank: (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_rows"))
    wanted = totals.transform(with_totals, n).where(held(F.floor(pos)) | held(F.ceil(pos)))
    inside = Window.partitionBy("_part").orderBy("_v")
    first = F.col("_before") + F.sum("_n").over(inside) - F.col("_n")
    ranks = (ranged.join(F.broadcast(wanted), "_part")
             .select("n", F.col("_v").cast("double").alias("_v"), first.alias("_first"), (first + F.col("_n")).alias("_end")))
    at = lambda rank: F.max(F.when((rank >= F.col("_first")) & (rank < F.col("_end")), F.col("_v")))
    picked = ranks.groupBy("n").agg(at(F.floor(pos)).alias("_lo"), at(F.ceil(pos)).alias("_hi"))
    out = picked.select("n", (F.col("_lo") + (pos - F.floor(pos)) * (F.col("_hi") - F.col("_lo"))).alias("value"))
    # Keep a row (value NULL) when there are no values at all.
    return n.join(out, "n", "left")
