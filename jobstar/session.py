"""Session construction and the small amount of session state the library reads."""

from __future__ import annotations

import os
import tempfile
import time
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Settings every job in this library assumes. Timestamps are UTC wall-clock and
# ANSI mode stays on (bad casts raise, so parsing goes through try_* functions).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "jobstar", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset and the master is ``local`` (tests, the bench) is a fresh scratch
    folder made; on a cluster, where executors can't see it, this raises instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share: "
                             f"a folder of this machine can't serve master {sc.master}")
        configured = tempfile.mkdtemp(prefix="jobstar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str, under: str | None = None) -> str:
    """A fresh folder for tables a job writes itself, under the checkpoint root or the folder ``under``."""
    import uuid

    root = (under or ensure_checkpoint_dir(spark)).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, under: str | None = None, compression: str = "snappy"):
    """Cut lineage by writing ``df`` as Parquet under the reliable checkpoint folder.

    Unlike ``checkpoint()`` this computes the plan once (no second pass to write)
    and later reads get column pruning and filter push-down. Survives executor
    loss: the files live in the shared folder, not on an executor. A job that runs again and
    again names a folder of its own with ``under`` and deletes it when it is done.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name, under)
    with released(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.parquet(path)


RELEASE_SECONDS = 2.0  # a shorter write has too little in its exchanges to matter


_due: set[str] = set()  # applications whose last write may have left exchanged rows


@contextmanager
def released(spark: SparkSession):
    """Around a write that cuts lineage: the exchanged rows that it leaves go, at the latest when the next one begins.

    Spark deletes the files of an exchange once the driver's garbage collector finds that no plan refers to it,
    which on a large driver heap can be long after; until then every step's exchanges add up on the executors' disks.
    """
    app = spark.sparkContext.applicationId
    if app in _due:
        _due.discard(app)
        spark._jvm.System.gc()
    began = time.monotonic()
    yield
    if time.monotonic() - began > RELEASE_SECONDS:
        _due.add(app)  # what has just ended may be referred to for a moment yet
        spark._jvm.System.gc()


SLICE_ROWS = 1 << 23


def slices_of(rows: int) -> int:
    """In how many slices a job that exchanges ``rows`` whole rows is done, so that only a slice's
    exchange lies on the disks at a time."""
    return max(1, -(-rows // SLICE_ROWS))


def slice_of(df: DataFrame, key: str, slices: int, number: int) -> DataFrame:
    """The rows of ``df`` in one of ``slices``: every row is in one, rows of equal ``key`` (NULL too) in the same.

    A frame that isn't stored is worked out anew for each slice, so it must give the same rows each time.
    """
    # Not the hash that deals rows to partitions, buckets or leaves, so that each slice has its share of all.
    return df if slices == 1 else df.where(F.pmod(F.xxhash64(F.lit("slice"), F.col(key)), F.lit(slices)) == number)
