"""End-to-end wiring: landed feed -> raw -> staging -> star -> bridge.

Each step is a pure DataFrame function; this module only connects them. ``Star``
builds each layer at most once per instance, so reports over the same star share
one set of frames (and one set of checkpoints for the surrogate keys).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators import mart, quality, salary, skills, staging
from ..operators.upsert import store_raw
from ..sources.schemas import checked
from ..sources.standin import feed_rows
from ..session import materialize
from ..sources.tables import Tables


def build_raw(t: Tables) -> DataFrame:
    """Landed rows of the stand-in feed, merged into one row per (job_id, search_term) and stored by job."""
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return store_raw(None, feed_rows(t), buckets)


def build_staging(raw: DataFrame) -> DataFrame:
    """W7 then W8: staging with settled salaries."""
    return salary.finalize_salary(staging.load_staging(raw))


def _stored(df: DataFrame, table: str) -> DataFrame:
    """A layer written as its declared table."""
    return materialize(checked(df, table), table)


class Star:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, raw: DataFrame | None = None):
        self.spark = spark
        self.tables = Tables(spark, sf_dir) if sf_dir else None
        self._raw = raw

    @cached_property
    def raw(self) -> DataFrame:
        # The merged raw table is a stored layer (bronze), laid out by job; staging needs no exchange on it.
        return self._raw if self._raw is not None else build_raw(self.tables)

    @cached_property
    def stg(self) -> DataFrame:
        # Staging feeds every later layer; write it once as a table in the reliable
        # checkpoint folder so dimensions, fact, bridge and checks do not re-derive it.
        # The quality metrics ride along with that write (no extra scan).
        self._stg_observation = Observation("stg_quality")
        observed = checked(build_staging(self.raw), "stg_jobs").observe(self._stg_observation, *quality.observed_metrics())
        return materialize(observed, "stg_jobs", compression="zstd")

    @property
    def stg_metrics(self) -> dict:
        """Quality metrics collected while staging was written (see ``quality.observed_metrics``)."""
        self.stg  # noqa: B018 - make sure the write (and so the observation) happened
        return self._stg_observation.get

    @cached_property
    def dim_company(self) -> DataFrame:
        return _stored(mart.dim_company(self.stg), "dim_company")

    @cached_property
    def dim_location(self) -> DataFrame:
        return _stored(mart.dim_location(self.stg), "dim_location")

    @cached_property
    def dim_date(self) -> DataFrame:
        return _stored(mart.dim_date(self.stg), "dim_date")

    @cached_property
    def dim_category(self) -> DataFrame:
        return _stored(mart.dim_category(self.stg), "dim_category")

    @cached_property
    def fact(self) -> DataFrame:
        # Written once as the fact table; every report and the bridge read it.
        return _stored(mart.load_fact(self.stg, self.dim_company, self.dim_location, self.dim_category),
                       "fact_job_postings")

    @cached_property
    def dim_skill(self) -> DataFrame:
        return _stored(skills.dim_skill(self.spark), "dim_skill")

    @cached_property
    def bridge(self) -> DataFrame:
        return _stored(skills.bridge_job_skills(self.fact, self.stg, self.dim_skill), "bridge_job_skills")


_BUILT: dict[tuple[str, str], Star] = {}


def star_for(spark: SparkSession, sf_dir: str) -> Star:
    """The star built from ``sf_dir`` in this Spark application, built at most once.

    Layers are written tables, so later queries read them instead of re-deriving
    staging, keys, fact and bridge.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    star = _BUILT.get(key)
    if star is None or star.spark is not spark:
        star = _BUILT[key] = Star(spark, sf_dir)
    return star
