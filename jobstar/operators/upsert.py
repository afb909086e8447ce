"""Idempotent merge of landed rows into the raw table.

Key ``(job_id, search_term)``. On conflict every non-key column takes the value of
the last applied row and ``id`` keeps the value of the first. Rows are applied in
``(batch_seq, row_seq)`` order. Parquet has no MERGE, so the result is a new
frame that the caller writes to a new location (never over the one being read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import slice_of, slices_of
from ..sources.stored import store_slices

RAW_KEY = ("job_id", "search_term")
HOT_SHARE = 200  # a job with more than one in so many rows is merged before the exchange by job
BUCKET_ROWS = 1 << 18  # rows of a stored bucket, more or less: few enough to be merged and grouped in memory


def upsert_raw(existing: DataFrame | None, batch: DataFrame,
               batch_order: tuple[str, ...] = ("fetched_at", "id"),
               key: tuple[str, ...] = RAW_KEY) -> DataFrame:
    """Merge ``batch`` into ``existing`` (either may repeat keys).

    ``batch_order`` names the columns that give arrival order inside the batch (by default
    the stand-in feed's: fetch time, then id), so a replay gives the same table. Existing
    rows are applied before any batch row, whatever their fetch times.
    One shuffle on the key; both picks are partial aggregates, so a hot key is
    combined map-side before the exchange.
    """
    return _merged(_applied(existing, batch), batch.columns, batch_order, key)


def _applied(existing: DataFrame | None, batch: DataFrame) -> DataFrame:
    """All rows with ``_src``: 0 for the table's, 1 for the batch's."""
    rows = batch.withColumn("_src", F.lit(1))
    if existing is None:
        return rows
    # Order-only columns of the batch (e.g. page position) are NULL for table rows;
    # table rows always precede batch rows anyway.
    fill = [F.col(c) if c in existing.columns else F.lit(None).cast(batch.schema[c].dataType).alias(c)
            for c in batch.columns]
    return existing.select(*fill).withColumn("_src", F.lit(0)).unionByName(rows)


def _merged(rows: DataFrame, cols: list[str], batch_order: tuple[str, ...], key: tuple[str, ...]) -> DataFrame:
    order = F.struct(F.col("_src"), *[F.col(c) for c in batch_order])
    value_cols = [c for c in cols if c not in key and c != "id"]
    merged = rows.groupBy(*key).agg(
        F.min_by(F.col("id"), order).alias("id"),
        F.max_by(F.struct(*[F.col(c) for c in value_cols]), order).alias("_v"))
    return merged.select(*[F.col(c) if c in key or c == "id" else F.col(f"_v.{c}").alias(c) for c in cols])


def _hot_jobs(rows: DataFrame, job: str) -> tuple[list, int]:
    """The jobs, at most ``HOT_SHARE``, that hold more than one in ``HOT_SHARE`` rows, and the number of rows
    (counted without payloads)."""
    most = rows.groupBy(job).count().orderBy(F.desc("count")).limit(HOT_SHARE).collect()
    total = rows.count() if most else 0
    return [r[job] for r in most if r["count"] * HOT_SHARE > total], total


def upsert_by_job(existing: DataFrame | None, batch: DataFrame, buckets: int,
                  batch_order: tuple[str, ...] = ("fetched_at", "id"),
                  key: tuple[str, ...] = RAW_KEY, hot: list | None = None) -> DataFrame:
    """``upsert_raw`` with the result dealt by job over ``buckets`` partitions, in one exchange of the payload.

    Dealt by job, the rows need no further exchange to be merged by key, stored in buckets of the
    job, or grouped by job for staging. A job with many rows is merged on the map side first, as in
    ``upsert_raw``; only its merged rows (one per search term) are dealt with the others. ``hot`` names these
    jobs where they are known.
    """
    rows = _applied(existing, batch)
    job = F.col(key[0])
    hot = _hot_jobs(rows.select(key[0]), key[0])[0] if hot is None else hot
    if hot:
        known = [j for j in hot if j is not None]
        is_hot = F.coalesce(job.isin(known), F.lit(None in hot))
        merged = _merged(rows.where(is_hot), batch.columns, batch_order, key).withColumn("_src", F.lit(1))
        rows = rows.where(~is_hot).unionByName(merged)
    return _merged(rows.repartition(buckets, key[0]), batch.columns, batch_order, key)


def store_raw(existing: DataFrame | None, batch: DataFrame, buckets: int,
              batch_order: tuple[str, ...] = ("fetched_at", "id"), name: str = "raw_jobs") -> DataFrame:
    """The merged raw table, stored in buckets of the job and read back: staging groups it as it lies.

    The buckets (``buckets`` or more) keep their size as the table grows. A large table is merged and written
    in slices of the jobs, so that of its payloads only a slice is exchanged at a time.
    """
    hot, total = _hot_jobs(_applied(existing, batch).select("job_id"), "job_id")
    buckets, slices = bucket_count(total, buckets), slices_of(total)
    cut = lambda df, k: df if df is None else slice_of(df, "job_id", slices, k)
    merged = (upsert_by_job(cut(existing, k), cut(batch, k), buckets, batch_order, hot=hot) for k in range(slices))
    return store_slices(merged, name, ["job_id"], buckets, ["job_id", "search_term"], "zstd")


def bucket_count(rows: int, least: int) -> int:
    return max(least, -(-rows // BUCKET_ROWS))
