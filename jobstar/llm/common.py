"""Column rules shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\t\n\x0b\x0c\r "
BLANK_WORD = r"[^\x20\x09-\x0D]+"


def fold_ascii(text: Column) -> Column:
    """Lower-case A to Z only; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def tmp_name(*taken: DataFrame) -> str:
    """A prefix for helper columns that no column of the given frames begins with."""
    names = {c.lower() for df in taken for c in df.columns}
    while True:
        prefix = f"_t{uuid.uuid4().hex[:6]}_"
        if not any(c.startswith(prefix) for c in names):
            return prefix


def small_batches(df: DataFrame) -> None:
    """Whole texts go to Python in batches of rows: keep a batch to some megabytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row in partition


def numbered(df: DataFrame, group: str, order: list[str], name: str, few_groups: bool = False) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... inside each ``group`` by ``order``, however large a group is.

    One range exchange by group and order, written once with row numbers inside partitions;
    a group's rows in a partition are consecutive, so adding the counts of its earlier
    partitions numbers it through. ``few_groups`` says that groups are bounded in number, so
    that the counts (a row per group and partition) may be broadcast. Null groups are one group.
    """
    p = tmp_name(df)
    ranged = (df.repartitionByRange(shuffle_partitions(df), group, *order)
              .sortWithinPartitions(group, *order)
              .withColumn(p + "at", F.monotonically_increasing_id()))
    ranged = materialize(ranged, f"numbered-{name}").withColumn(p + "part", F.shiftright(F.col(p + "at"), _LOCAL_BITS))
    runs = ranged.groupBy(F.col(group).alias(p + "g"), F.col(p + "part").alias(p + "q")).agg(
        F.min(p + "at").alias(p + "first"), F.count(F.lit(1)).alias(p + "n"))
    before = F.sum(p + "n").over(Window.partitionBy(p + "g").orderBy(p + "q")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(p + "g", p + "q", (F.coalesce(before, F.lit(0)) - F.col(p + "first")).alias(p + "shift"))
    same = F.col(group).eqNullSafe(F.col(p + "g")) & (F.col(p + "part") == F.col(p + "q"))
    return (ranged.join(F.broadcast(runs) if few_groups else runs, same)
            .select(*df.columns, (F.col(p + "at") + F.col(p + "shift")).cast("long").alias(name)))
