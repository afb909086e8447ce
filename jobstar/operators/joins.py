"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach the columns of a one-row global aggregate to every row of ``df``.

    The DataFrame form of an uncorrelated scalar subquery: ``totals`` must be a
    global ``agg`` (exactly one row), so the broadcast holds one row and no row
    of ``df`` is ever paired with more than that one row.
    """
    return df.crossJoin(F.broadcast(totals))


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, spread: str) -> DataFrame:
    """``df`` with ``value`` of the row of ``dim`` whose ``dim_key`` equals ``key``, else NULL.

    Rows with a NULL key match nothing; they are dealt out by ``spread`` (a text column)
    instead of meeting in one reducer. Whether ``dim`` is broadcast is left to the planner.
    """
    dealt = F.coalesce(F.col(key), F.concat(F.lit("\x00"), F.col(spread)))
    side = dim.select(F.col(dim_key).alias("_dim_key"), F.col(value))
    return (df.withColumn("_deal", dealt)
            .join(side, (F.col("_deal") == F.col("_dim_key")) & F.col(key).isNotNull(), "left")
            .drop("_deal", "_dim_key"))
