"""Sets of dense keys as bitmaps: exact distinct counts of any window from stored rows.

A bitmap covers 32,768 keys; a set is a row per covered range that holds any. Sets are merged
by or-ing, so distinct keys per day, stored once, give those of any days without the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def key_bitmaps(df: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``by, range, keys``: the set of non-null ``key`` values (positive whole numbers, as surrogate ids are)."""
    return (df.where(F.col(key).isNotNull())
            .groupBy(*by, F.bitmap_bucket_number(key).alias("range"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("keys")))


def merged(sets: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The union of sets, per ``by``."""
    return sets.groupBy(*by, "range").agg(F.bitmap_or_agg("keys").alias("keys"))


def key_count(sets: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``by, name``: how many keys the union of the sets holds (0 without ``by`` for none)."""
    return merged(sets, by).groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("keys")), F.lit(0)).alias(name))


def orphan_key_count(used: DataFrame, known: DataFrame, name: str = "orphan_keys") -> DataFrame:
    """One row: how many keys of ``used`` aren't in ``known`` (both as ``key_bitmaps``); no fact is joined."""
    both = merged(used.select("range", "keys").unionByName(known.select("range", "keys")))
    sizes = key_count(both, "_all").crossJoin(F.broadcast(key_count(known, "_known")))  # one row each
    return sizes.select((F.col("_all") - F.col("_known")).alias(name))
