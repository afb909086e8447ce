"""Exact deduplication by sorting the content itself.

Splitters are sampled over the normalised bytes: a few texts per partition, cut to
``HEAD_CHARS``, are ranked, and of the texts at the quantiles only as much is kept as parts
them from the sampled text before. They range-partition the rows; each partition is sorted
by its texts (Spark's sort spills to disk), so equal texts become neighbours and a window
compares each text in full with the one before it. The text crosses the network once.

Skew: a text that holds more than ``1 / HOT_SHARE`` of all rows is found first by an exact
count of text hashes (at most ``HOT_SHARE`` of them can exist, which bounds the broadcast).
Its rows get a salt, so the group is cut over many partitions; each salted part
keeps its own winner, and the few winners are merged by full text digest afterwards. Where
more rows than a partition takes begin with the same ``HEAD_CHARS`` characters, no splitter
can part them: these rows alone are dealt by the hash of their text as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import fold_ascii, shuffle_partitions

HOT_SHARE = 200
HEAD_CHARS = 1024
SAMPLED_PER_PARTITION = 20
_SEED = 8
_PREFIXES = (16, 64, 256, HEAD_CHARS)


def sampled_splitters(norm: DataFrame, parts: int, fraction: float) -> list[tuple[str, bool]]:
    """Ascending splitters of the column ``norm`` with whether the bucket that begins there can't be cut further.

    At most ``parts`` come to the driver, of at most ``HEAD_CHARS`` characters. One task orders the sample's distinct
    heads, about ``SAMPLED_PER_PARTITION * parts`` of that length.
    """
    heads = (norm.sample(fraction, _SEED).groupBy(F.substring("norm", 1, HEAD_CHARS).alias("head"))
             .agg(F.count(F.lit(1)).alias("n")))
    up_to = Window.orderBy("head")
    ranked = heads.select("head", "n", F.sum("n").over(up_to).alias("upto"), F.lag("head").over(up_to).alias("before"),
                          F.sum("n").over(Window.partitionBy()).alias("total"))
    # The quantiles that fall on a head; more than one: the head holds more than a partition's share.
    share = F.greatest(F.lit(1.0), F.col("total") / parts)
    quantiles = F.floor(F.col("upto") / share) - F.floor((F.col("upto") - F.col("n")) / share)
    start = F.when(F.col("before").isNull(), F.substring("head", 1, _PREFIXES[0]))
    for size in _PREFIXES:
        start = start.when(F.substring("head", 1, size) != F.substring("before", 1, size), F.substring("head", 1, size))
    picked = ranked.where(quantiles > 0).select(start.alias("start"), (quantiles > 1).alias("full"))
    return sorted(((r["start"], r["full"]) for r in picked.collect()), key=lambda s: s[0].encode())


def bucket_of(norm: Column, splitters: list[tuple[str, bool]]) -> tuple[Column, Column]:
    """How many splitters a text has reached, found in two steps, and whether its bucket can't be cut further."""
    if not splitters:
        return F.lit(0), F.lit(False)
    step = math.isqrt(len(splitters) - 1) + 1
    rows = [splitters[i:i + step] for i in range(0, len(splitters), step)]
    reached = lambda starts: F.size(F.filter(starts, lambda s: s <= norm))
    row = reached(F.array(*[F.lit(r[0][0]) for r in rows]))
    inside = F.get(F.array(*[F.array(*[F.lit(s) for s, _ in r]) for r in rows]), row - 1)
    bucket = F.when(row == 0, 0).otherwise((row - 1) * step + reached(inside))
    full = F.coalesce(F.get(F.array(*[F.lit(f) for _, f in splitters]), bucket - 1), F.lit(False))
    return bucket, full


def content_sort_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        keep: str = "smallest") -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty.
    ``keep`` names the identifier that stays, ``smallest`` or ``largest``. A null identifier
    stays only if its whole group has none. Rows that repeat identifier and text are all
    marked like one another. An empty table gives an empty result; other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    parts = shuffle_partitions(docs)
    rows = docs.select(F.col(id_col).alias("id"),
                       fold_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    hashed = rows.select(F.xxhash64("norm").alias("h"))
    # Exact counts with map-side combining, then the hashes over the share.
    counts = materialize(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "content-counts")
    total = docs.count()
    hot = counts.where(F.col("n") * HOT_SHARE > F.lit(total)).select("h", F.lit(True).alias("hot"))

    salted = (rows.withColumn("h", F.xxhash64("norm"))
              .join(F.broadcast(hot), "h", "left")
              .withColumn("salt", F.when(F.col("hot"), F.monotonically_increasing_id() % parts).otherwise(F.lit(-1))))
    pick = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    fraction = min(1.0, SAMPLED_PER_PARTITION * parts / max(1, total))
    splitters = sampled_splitters(salted.where("salt < 0").select("norm"), parts, fraction)
    bucket, full = bucket_of(F.col("norm"), splitters)
    salted = (salted.withColumn("bucket", bucket)
              .withColumn("tie", F.when(full, F.col("h")).otherwise(F.lit(0).cast("long"))))
    group = Window.partitionBy("bucket", "norm", "tie", "salt")
    sorted_once = (salted.repartitionByRange(parts, "bucket", "tie", "salt")
                   .withColumn("part_keep", F.first("id").over(group.orderBy(pick)))
                   .withColumn("part_size", F.count(F.lit(1)).over(group.orderBy(pick).rowsBetween(
                       Window.unboundedPreceding, Window.unboundedFollowing)))
                   .select("id", "salt", "part_keep", "part_size", F.sha2("norm", 256).alias("text_sha256")))
    sorted_once = materialize(sorted_once, "content-sorted")

    # One row per salted part of a hot text: at most HOT_SHARE * parts rows.
    best = F.min if keep == "smallest" else F.max
    merged = (sorted_once.where("salt >= 0")
              .groupBy("text_sha256", "salt").agg(best("part_keep").alias("k"), F.max("part_size").alias("n"))
              .groupBy("text_sha256").agg(best("k").alias("all_keep"), F.sum("n").alias("all_size")))
    return (sorted_once.join(F.broadcast(merged), "text_sha256", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("salt") >= 0, F.col("all_keep")).otherwise(F.col("part_keep")).alias("keep_id"),
                    F.coalesce("all_size", "part_size").cast("long").alias("group_size"),
                    "text_sha256")
            .select(id_col, "keep_id", "group_size",
                    F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
