"""Line deduplication with levelled sorted runs of line hashes.

A batch's line keys (two 64-bit hashes) are merge-anti-joined with the runs of all earlier
batches; keys that are new form the batch's own sorted run at level 0. When a level holds
``fanout`` runs they are merged into one sorted run a level up, so a batch meets at most
``fanout * log(batches)`` runs. Batches come in ascending identifiers, so a key that isn't new
belongs to a smaller document and all its lines in the batch go; inside a batch the
smallest document holding a key keeps its lines.

Runs are stored in buckets of the hashes, a sorted file per bucket, as are a batch's keys: the
anti-joins merge them as they lie, without exchange or sort. Texts are read twice: once for the
hashes and positions of all lines, and once when documents meet their dropped positions.
Counts per key combine on the map side, so a line found in a third of all documents is a single row per task
before it is exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_path
from ..sources.stored import store_bucketed
from .common import BLANKS, fold_ascii, shuffle_partitions

MIN_CHARS = 10
FANOUT = 2
KEY = ["h1", "h2"]


# Scans go bucket by bucket, also where a plan could do without, and one-file buckets keep their order.
_BUCKET_SCANS = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
                 "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


@contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """The plans made and run inside read sorted buckets as they lie."""
    before = {name: spark.conf.get(name) for name in _BUCKET_SCANS}
    for name, value in _BUCKET_SCANS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class LineRuns:
    """Sorted runs of the line hashes seen so far, by level: stored tables of ``h1, h2, owner``."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def seen(self) -> DataFrame | None:
        """The keys of all runs; no two runs share one."""
        runs = [run.select(*KEY) for level in self.levels for run in level]
        found = None
        for run in runs:
            found = run if found is None else found.unionByName(run)
        return found

    def unseen(self, keys: DataFrame) -> DataFrame:
        """``keys`` without those that a run holds, by a merge-anti-join with each run."""
        for level in self.levels:
            for run in level:
                keys = keys.join(run.select(*KEY).hint("merge"), KEY, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> DataFrame:
        """Store ``keys`` (``h1, h2, owner``, none of them in a run; rows with a true ``old`` are left
        out) as a sorted run, compact full levels, return the run."""
        rows = keys.where("not old").drop("old") if "old" in keys.columns else keys
        run = self._put(0, rows)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._put(level + 1, merged.repartition(shuffle_partitions(merged), *KEY))
            level += 1
        return run

    def _put(self, level: int, rows: DataFrame) -> DataFrame:
        run = store_run(rows, f"line-run-{level}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        return run


def store_run(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, dealt by their hashes already, in one sorted file per bucket."""
    return store_bucketed(rows, name, KEY, shuffle_partitions(rows), KEY, exchange=False)


def line_keys(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but ``text``, and ``pos, h1, h2`` of each line whose key has at least
    ``MIN_CHARS`` code points."""
    own = [c for c in rows.columns if c != "text"]
    lines = rows.select(*own, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = fold_ascii(F.trim(F.col("line"), F.lit(BLANKS)))
    return (lines.select(*own, "pos", key.alias("key"))
            .where(F.char_length("key") >= MIN_CHARS)
            .select(*own, "pos", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit("second")).alias("h2")))


def shared_keys(keys: DataFrame, runs: LineRuns) -> DataFrame:
    """``h1, h2, owner`` of a batch's keys that lose lines in it; the new ones become a run.

    ``owner`` is the document that keeps the lines, NULL where an earlier batch holds the key.
    """
    with sorted_buckets(keys.sparkSession):
        by_key = store_run(keys.groupBy(*KEY).agg(F.min("id").alias("owner"), F.max("id").alias("last")), "line-keys")
        run = runs.add(runs.unseen(by_key).drop("last"))
        none = F.lit(None).cast(keys.schema["id"].dataType)
        seen = by_key.join(run.select(*KEY).hint("merge"), KEY, "left_anti").select(*KEY, none.alias("owner"))
        here = by_key.where("last > owner").join(run.select(*KEY).hint("merge"), KEY, "left_semi").drop("last")
        return materialize(seen.unionByName(here), "line-shared")


def batch_of(docs: DataFrame, batches: int) -> Column:
    """The batch of an ``id``, by ascending identifiers; rows without one come last."""
    cuts: list = []
    if batches > 1:
        at = [i / batches for i in range(1, batches)]
        cuts = sorted(set(docs.agg(F.percentile_approx("id", at, 1000)).first()[0] or []))
    batch = F.when(F.col("id").isNull(), len(cuts) + 1)
    for i, cut in enumerate(cuts):
        batch = batch.when(F.col("id") <= F.lit(cut), i)
    return batch.otherwise(len(cuts))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 4,
                runs: LineRuns | None = None) -> DataFrame:
    """``id_col, n_lines, n_dropped, kept_text``, one row per document.

    A text is split at line feeds (null or empty: one empty line). A line's key is the line
    stripped of blanks at both ends, A-Z lower-cased. Keys of ``MIN_CHARS`` code points or
    more that at least two documents hold lose their lines everywhere but in the smallest
    identifier. ``batches`` splits the table by identifier and does not change the result.
    Rows that repeat an identifier are one document: its lines stay in each of them. Rows
    without identifier form the last batch: they lose lines that an identified document
    holds, and keep those only they hold. Other columns are ignored.
    """
    spark = docs.sparkSession
    runs = runs or LineRuns(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    ids = docs.select(F.col(id_col).alias("id"))
    path = scratch_path(spark, "lines")
    keys = line_keys(rows.withColumn("batch", batch_of(ids, batches)))
    keys.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(keys.select(*[c for c in keys.columns if c != "batch"], "batch").schema).parquet(path)
    drops = None
    # At most ``batches`` values and one for rows without identifier.
    for batch in sorted(r[0] for r in keys.select("batch").distinct().collect()):
        here = keys.where(F.col("batch") == batch)
        lost = here.drop("batch").join(shared_keys(here, runs), KEY).where(F.col("owner").isNull() | (F.col("id") > F.col("owner")))
        drops = lost if drops is None else drops.unionByName(lost)
    if drops is None:
        drops = keys.select(*KEY, "id", "th", "pos")  # no line is long enough
    drops = materialize(drops.groupBy(F.col("id").alias("drop_id"), F.col("th").alias("drop_th"))
                        .agg(F.collect_set("pos").alias("drops")), "line-drops")
    joined = rows.join(drops.hint("merge"), (F.col("th") == F.col("drop_th")) & F.col("id").eqNullSafe(F.col("drop_id")), "left")
    joined = joined.select("id", "text", F.split("text", "\n", -1).alias("lines"), "drops")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    return joined.select(
        F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")).alias("kept_text"))
