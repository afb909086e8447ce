"""Reports kept up to date by change rows: each drop adds and takes away counts, nothing is counted anew.

For every landed row (job, term) a narrow row of facets is kept: the columns that reports group by. A
drop's rows are shredded once; with the kept facets of the same jobs they give each job's posting
before and after the drop. The posting before counts -1, the one after +1; equal rows cancel out,
and what is left are the change rows. Summed by a report's key they are one more run of its stored counts. A
reader adds up the runs; runs are merged when the newer ones reach half of the first, so stored counts stay
about as large as the report's keys, and a job sent again with nothing new adds nothing.

A drop reads its own payloads and the facets of the buckets it falls in, never an older payload. Numbers of versions are those of
the raw table (``ingest.apply_batch`` calls ``follow`` before it publishes one): a version that is
followed twice, as after a failure, starts from the one before and replaces what it wrote.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import with_totals
from ..operators.mart import LOCATION_LEVELS, folded_levels
from ..operators.staging import PICK_ORDER, shred_payload
from ..operators.upsert import RAW_KEY
from ..session import materialize, scratch_path
from . import logtable

FACETS = ("posted_date", *LOCATION_LEVELS, "category_tag", "category_label")
# The key of each report's counts; the date serves reports between two dates.
CUBES = {
    "days": ("posted_date",),
    "places": ("posted_date", *LOCATION_LEVELS),
    "categories": ("posted_date", "category_tag", "category_label"),
}
_CUBE_NO = {cube: i for i, cube in enumerate(CUBES)}
BUCKETS = 64
SPLIT_BYTES = 128 << 20


def facets_of(rows: DataFrame) -> DataFrame:
    """The facets of raw rows (with ``_arrival``); the payload is parsed and left behind."""
    return shred_payload(rows.select("id", *RAW_KEY, "fetched_at", "_arrival", "raw_data")).select(
        "id", *RAW_KEY, "fetched_at", *FACETS, "_arrival")


def postings(facets: DataFrame, sign: int) -> DataFrame:
    """Each job's facets, of its representative row as in staging, with ``n`` = ``sign``."""
    order = F.struct(*[F.col(c) for c in PICK_ORDER])
    picked = facets.groupBy("job_id").agg(F.max_by(F.struct(*FACETS), order).alias("_p"))
    return picked.select("_p.*", F.lit(sign).cast("long").alias("n"))


def added_up(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(*key).agg(F.sum("n").alias("n")).where("n <> 0")


def change_rows(old: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """What the ``fresh`` facet rows change: facets with the number ``n`` of postings that come (or go, below zero).

    ``old`` holds all kept facet rows of the fresh rows' jobs. A fresh row replaces the kept row of its key.
    """
    if old is None:
        return added_up(postings(fresh, 1), FACETS)
    now = logtable.merge_by_arrival(old.unionByName(fresh))
    return added_up(postings(old, -1).unionByName(postings(now, 1)), FACETS)


@dataclass
class KeptReports:
    """The kept facets and counts under ``root``; ``follow`` is given to ``apply_batch`` or ``ingest_incremental``."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS
    keep_versions: int = logtable.KEEP_VERSIONS

    @property
    def _facets(self) -> str:
        return f"{self.root.rstrip('/')}/facets"

    @property
    def _counts(self) -> str:
        return f"{self.root.rstrip('/')}/counts"

    def start(self, raw: DataFrame, version: int) -> None:
        """Begin with a table that is there already: ``raw`` is its rows (with ``_arrival``) at ``version``."""
        if logtable.manifests(self.spark, self._counts):
            raise ValueError(f"reports under {self.root} have begun already")
        self._apply(raw, version, logtable.State(), logtable.State())

    def follow(self, rows: DataFrame | None, version: int) -> None:
        """Take in the rows that make ``version`` of the raw table; None if they are none."""
        facets, counts = (logtable.State.newest(self.spark, r, version) for r in (self._facets, self._counts))
        if facets.version != version - 1 or counts.version != version - 1:
            raise ValueError(f"reports are at version {counts.version}, so they can't follow version {version}: "
                             "start them from the table")
        self._apply(rows, version, facets, counts)

    def _apply(self, rows: DataFrame | None, version: int, facets: logtable.State, counts: logtable.State) -> None:
        scratch = scratch_path(self.spark, "kept")
        try:
            self._take_in(rows, version, facets, counts, scratch)
        finally:
            logtable.delete(self.spark, scratch)

    def _take_in(self, rows: DataFrame | None, version: int, facets: logtable.State, counts: logtable.State, scratch: str) -> None:
        facets.version = counts.version = version - 1
        fresh = materialize(facets_of(rows), "facets", f"{scratch}/fresh") if rows is not None else None
        if not facets.runs:
            size = logtable.folder_bytes(self.spark, f"{scratch}/fresh") if fresh is not None else 0
            facets.runs = {b: [] for b in logtable.first_buckets(self.buckets, size, SPLIT_BYTES)}
            counts.runs = {i: [] for i in _CUBE_NO.values()}
        name = f"data/v{version:08d}"
        if fresh is not None:
            placed = logtable.with_bucket(fresh, sorted(facets.runs))
            # A line per bucket, of which there are as many as the directory has.
            touched = [r["bucket"] for r in placed.select("bucket").distinct().collect()]
            old = logtable.read_runs(self.spark, self._facets, [run for b in touched for run in facets.runs[b]])
            if old is not None:
                jobs = fresh.select(F.col("job_id").alias("_job")).distinct()
                old = logtable.merge_by_arrival(
                    old.select(*fresh.columns).join(jobs, F.col("job_id").eqNullSafe(F.col("_job")), "left_semi"))
            changes = materialize(change_rows(old, fresh), "changes", scratch)
            self._add(changes, counts, name)
            largest = max((sum(n for _, n in facets.runs[b]) for b in touched), default=0)
            written = logtable.write_run(placed, self._facets, name, F.lit(largest))
            for b, run in written.items():
                facets.runs[b].append(run)
            logtable.compact(self.spark, self._facets, facets, set(written), f"{name}-compacted", SPLIT_BYTES)
        # Two versions at least: a version that is followed again needs the one before.
        for root, state in ((self._facets, facets), (self._counts, counts)):
            logtable.publish(self.spark, root, state, "reports", version, max(2, self.keep_versions))

    def _add(self, changes: DataFrame, counts: logtable.State, name: str) -> None:
        for cube, key in CUBES.items():
            self._write_counts(added_up(changes, key), counts, name, cube)
            runs = counts.runs[_CUBE_NO[cube]]
            if len(runs) > 1 and (2 * sum(n for _, n in runs[1:]) >= runs[0][1] or len(runs) > logtable.MAX_RUNS + 1):
                whole = added_up(logtable.read_runs(self.spark, self._counts, runs), key)
                counts.runs[_CUBE_NO[cube]] = []
                self._write_counts(whole, counts, f"{name}-compacted", cube)

    def _write_counts(self, rows: DataFrame, counts: logtable.State, name: str, cube: str) -> None:
        no = _CUBE_NO[cube]
        folder = f"{name}/bucket={no}"
        rows.write.mode("overwrite").parquet(f"{self._counts}/{folder}")
        counts.runs[no].append((folder, logtable.folder_bytes(self.spark, f"{self._counts}/{folder}")))

    def counts(self, cube: str, version: int | None = None) -> DataFrame:
        """A report's keys with the number ``n`` of postings at a version, the newest by default."""
        before = None if version is None else version + 1
        state = logtable.State.newest(self.spark, self._counts, before)
        if version not in (None, state.version) or not state.runs:
            raise ValueError(f"no counts at version {version}")
        runs = state.runs[_CUBE_NO[cube]]
        if not runs:
            columns = ", ".join(f"{c} {'date' if c == 'posted_date' else 'string'}" for c in CUBES[cube])
            return self.spark.createDataFrame([], f"{columns}, n long")
        return added_up(logtable.read_runs(self.spark, self._counts, runs), CUBES[cube])

    # ---- the reports, as ``plans.reports`` counts them from the fact ----

    def postings_by_location(self, level: str = "city", top: int = 10, start: str | None = None, end: str | None = None,
                             version: int | None = None) -> DataFrame:
        """R1 from the kept counts."""
        keys = [f"_{c}" for c in LOCATION_LEVELS]
        places = (self.counts("places", version).select("*", *[f.alias(k) for f, k in zip(folded_levels(), keys)])
                  .groupBy(*keys).agg(F.max(level).alias("_name"), _inside(start, end).alias("n")))
        per = places.groupBy(F.coalesce("_name", F.lit("Unknown")).alias("location")).agg(F.sum("n").alias("postings"))
        return (_shares(per).select(F.lit(level).alias("level"), "location", "postings", "pct")
                .orderBy(F.col("postings").desc(), "location").limit(top))

    def daily_trend(self, start: str | None = None, end: str | None = None, version: int | None = None) -> DataFrame:
        """R5 from the kept counts."""
        return (self.counts("days", version).where(F.col("posted_date").isNotNull() & _between(start, end))
                .select(F.col("posted_date").alias("full_date"), F.col("n").alias("postings")).orderBy("full_date"))

    def category_share(self, start: str | None = None, end: str | None = None, version: int | None = None) -> DataFrame:
        """R11 from the kept counts."""
        tags = (self.counts("categories", version).groupBy("category_tag")
                .agg(F.max("category_label").alias("_label"), _inside(start, end).alias("n")))
        label = F.when(F.col("category_tag").isNotNull(), F.col("_label"))
        per = tags.groupBy(F.coalesce(label, F.lit("Unknown")).alias("category")).agg(F.sum("n").alias("postings"))
        return _shares(per).select("category", "postings", "pct").orderBy(F.col("postings").desc(), "category")


def _between(start: str | None, end: str | None) -> Column:
    day = F.col("posted_date")
    bounds = [day >= F.lit(start).cast("date")] * (start is not None) + [day <= F.lit(end).cast("date")] * (end is not None)
    return reduce(Column.__and__, bounds, F.lit(True))


def _inside(start: str | None, end: str | None) -> Column:
    """Postings between two dates; a name is taken from all dates, as a dimension takes it."""
    return F.sum(F.when(_between(start, end), F.col("n")).otherwise(0))


def _shares(per: DataFrame) -> DataFrame:
    per = per.where("postings > 0")
    total = per.agg(F.sum("postings").alias("_total"))
    return per.transform(with_totals, total).withColumn(
        "pct", F.round(F.try_divide(100.0 * F.col("postings"), F.col("_total")), 1).cast("double"))
