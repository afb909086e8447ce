"""Read-only data-quality profile of staging."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import contains_text
from .joins import with_totals
from ..functions.vocab import (
    CHECK_CATEGORY, CHECK_DATES, CHECK_FUZZY_LOOSE, CHECK_FUZZY_TIGHT, CHECK_LOCATION, CHECK_NULLS, CHECK_PK,
    CHECK_SALARY_AVAILABILITY,
)


def _one() -> Column:
    return F.lit(1)


def _pct(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(100.0 * num, den), 1).cast("double")


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    return as_of


def dq_pk(stg: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows, distinct keys, duplicates, PASS/FAIL.

    Distinct keys come from a per-key aggregate (partial counts map-side), not
    from a global COUNT(DISTINCT).
    """
    per_key = stg.groupBy(key).agg(F.count(_one()).alias("_n"))
    s = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
                    F.count(_one()).alias("distinct_job_ids"))
    return s.select(
        F.lit(CHECK_PK).alias("check_name"), "total_rows", "distinct_job_ids",
        (F.col("total_rows") - F.col("distinct_job_ids")).alias("duplicate_pks"),
        F.when(F.col("total_rows") == F.col("distinct_job_ids"), "PASS").otherwise("FAIL").alias("status"))


def _null_cols() -> list[Column]:
    return [
        F.count_if(F.col("title").isNull()).alias("null_title"),
        F.count_if(F.col("company_name").isNull()).alias("null_company"),
        F.count_if(F.col("state").isNull()).alias("null_state"),
        F.count_if(F.col("posted_date").isNull()).alias("null_posted_date"),
        F.count_if(F.col("description_clean").isNull() | (F.col("description_clean") == ""))
         .alias("null_description"),
    ]


def dq_nulls(stg: DataFrame) -> DataFrame:
    """NULL counts of the key fields."""
    return stg.agg(F.lit(CHECK_NULLS).alias("check_name"), F.count(_one()).alias("total"),
                   *_null_cols())


def _location_cols() -> list[Column]:
    return [
        *[F.count(c).alias(f"has_{c}") for c in ("country", "state", "region", "city", "suburb")],
        _pct(F.count_if(F.col("state").isNull()), F.count(_one())).alias("pct_missing_state"),
    ]


def dq_location(stg: DataFrame) -> DataFrame:
    """Non-null count per location level, percent without a state."""
    return stg.agg(F.lit(CHECK_LOCATION).alias("check_name"), F.count(_one()).alias("total"),
                   *_location_cols())


def _date_cols(as_of) -> list[Column]:
    d = F.col("posted_date")
    failed = F.count_if(d.isNull())
    future = F.count_if(d > _as_of(as_of))
    return [
        failed.alias("failed_parse"), future.alias("future_dates"),
        F.min(d).alias("earliest"), F.max(d).alias("latest"),
        F.when((failed == 0) & (future == 0), "PASS").otherwise("REVIEW").alias("date_status"),
    ]


def dq_dates(stg: DataFrame, as_of=None) -> DataFrame:
    """Failed parses, dates after ``as_of`` (default today), range, PASS/REVIEW."""
    return stg.agg(F.lit(CHECK_DATES).alias("check_name"), F.count(_one()).alias("total"),
                   *_date_cols(as_of)).withColumnRenamed("date_status", "status")


TIGHT_KEYS = ("title_normalized", "company_normalized", "state", "suburb")
LOOSE_KEYS = ("title_normalized", "company_normalized", "state")


def _pairs(n: Column) -> Column:
    """n * (n - 1) / 2 in whole decimals: exact, and no 64-bit overflow."""
    n = n.cast("decimal(19,0)")
    # One of the factors is even, so halving it leaves a whole number.
    even = F.when(n % 2 == 0, n).otherwise(n - 1)
    odd = F.when(n % 2 == 0, n - 1).otherwise(n)
    return (even / 2).cast("decimal(19,0)") * odd


def fuzzy_pair_count(df: DataFrame, keys: tuple[str, ...] = TIGHT_KEYS, date_col: str = "posted_date",
                     days: int = 7) -> DataFrame:
    """``fuzzy_dup_pairs``: unordered pairs of rows equal on ``keys`` (plain ``=``, so NULLs
    never pair) whose dates are at most ``days`` apart; ``rows_involved``: distinct rows in
    such a pair. Rows are assumed to have unique ids.

    No pair is ever formed. Rows are first counted per (key, day), the only shuffle that
    sees every row, with map-side partial counts, so one hot key costs no more than one row
    per day. A window over a key's days then adds up the neighbouring counts:

        pairs = sum C(n_d, 2) + sum_d n_d * (n_{d+1} + ... + n_{d+days})
    """
    valid = F.lit(True)
    for k in (*keys, date_col):
        valid = valid & F.col(k).isNotNull()
    day = F.unix_date(F.col(date_col).cast("date"))
    counts = df.where(valid).groupBy(*keys, day.alias("_day")).agg(F.count(_one()).alias("_n"))
    by_day = Window.partitionBy(*keys).orderBy("_day")
    later = F.coalesce(F.sum("_n").over(by_day.rangeBetween(1, days)), F.lit(0)).cast("decimal(19,0)")
    around = F.sum("_n").over(by_day.rangeBetween(-days, days))
    per_day = counts.select("_n", (_pairs(F.col("_n")) + F.col("_n").cast("decimal(19,0)") * later).alias("_v"),
                            around.alias("_around"))
    return per_day.agg(
        F.coalesce(F.sum("_v"), F.lit(0)).cast("long").alias("fuzzy_dup_pairs"),
        F.coalesce(F.sum(F.when(F.col("_around") > 1, F.col("_n"))), F.lit(0)).cast("long").alias("rows_involved"))


def fuzzy_dup_tight(stg: DataFrame, days: int = 7) -> DataFrame:
    """Re-posting pairs (same title, company, state, suburb; within ``days``), their
    percent of all rows, and the distinct rows in them (the percent may exceed 100)."""
    total = stg.agg(F.count(_one()).alias("_total"))
    return fuzzy_pair_count(stg, TIGHT_KEYS, "posted_date", days).transform(with_totals, total).select(
        F.lit(CHECK_FUZZY_TIGHT).alias("check_name"), "fuzzy_dup_pairs",
        _pct(F.col("fuzzy_dup_pairs"), F.col("_total")).alias("pct_of_total"), "rows_involved")


def group_pair_count(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``rows_flagged`` (rows that have a twin on ``keys``) and ``fuzzy_dup_pairs``, from group sizes alone."""
    valid = F.lit(True)
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    return pairs_of_sizes(df.where(valid).groupBy(*keys).agg(F.count(_one()).alias("_n")))


def pairs_of_sizes(groups: DataFrame) -> DataFrame:
    """``rows_flagged, fuzzy_dup_pairs`` of groups with ``_n`` rows each."""
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("long").alias("rows_flagged"),
        F.coalesce(F.sum(_pairs(F.col("_n"))), F.lit(0)).cast("long").alias("fuzzy_dup_pairs"))


def fuzzy_dup_loose(stg: DataFrame, keys: tuple[str, ...] = LOOSE_KEYS) -> DataFrame:
    """Same title, company, state: rows that have a twin, and the pair count."""
    total = stg.agg(F.count(_one()).alias("_total"))
    return group_pair_count(stg, keys).transform(with_totals, total).select(
        F.lit(CHECK_FUZZY_LOOSE).alias("check_name"), "rows_flagged", "fuzzy_dup_pairs",
        _pct(F.col("rows_flagged"), F.col("_total")).alias("pct_rows_flagged"))


def dq_category(stg: DataFrame) -> DataFrame:
    """Count and percent per category (NULL included), largest first."""
    per = stg.groupBy("category_tag").agg(F.count(_one()).alias("job_count"))
    total = stg.agg(F.count(_one()).alias("_total"))
    return (per.transform(with_totals, total).select(
        F.lit(CHECK_CATEGORY).alias("check_name"), "category_tag", "job_count",
        _pct(F.col("job_count"), F.col("_total")).alias("pct"))
        .orderBy(F.col("job_count").desc(), F.col("category_tag").asc_nulls_first()))


def _salary_avail_cols() -> list[Column]:
    return [
        F.count("salary_min_api").alias("has_api_salary_min"),
        F.count("salary_max_api").alias("has_api_salary_max"),
        _pct(F.count_if(F.col("salary_min_api").isNull()), F.count(_one())).alias("pct_missing_api_salary"),
        F.count_if(contains_text(F.col("description_clean"), "$")).alias("desc_contains_dollar"),
    ]


def dq_salary_availability(stg: DataFrame) -> DataFrame:
    """API salary presence and descriptions that mention a dollar amount."""
    return stg.agg(F.lit(CHECK_SALARY_AVAILABILITY).alias("check_name"), F.count(_one()).alias("total"),
                   *_salary_avail_cols())


def dq_report(stg: DataFrame, as_of=None) -> DataFrame:
    """Every single-pass check from one scan and one aggregate, and the distinct job ids, as one row.

    Covers W7v, W8v, W17, W18, W19, W20 and W24. Job ids are grouped on their own, from a scan of that
    column: a distinct count beside the other aggregates would send them all through the grouping.
    """
    avg = F.col("salary_avg_final")
    n = F.count(_one())
    metrics = stg.agg(
        n.alias("total_rows"),
        *_null_cols(), *_location_cols(), *_date_cols(as_of), *_salary_avail_cols(),
        F.count_if(F.col("search_term_count") > 1).alias("multi_search_jobs"),
        F.max("search_term_count").alias("max_search_terms"),
        F.count(avg).alias("has_salary"),
        _pct(F.count(avg), n).alias("pct_with_salary"),
        F.count_if(F.col("salary_min_final") > F.col("salary_max_final")).alias("inverted_ranges"),
        F.count_if(avg > 1000000).alias("over_1m"),
        F.count_if((avg < 20000) & avg.isNotNull()).alias("under_20k"),
        F.count_if(F.col("job_id") == "").alias("empty_job_ids"),
    )
    jobs = stg.groupBy("job_id").agg(F.count(_one()).alias("_held")).agg(F.count("job_id").alias("distinct_job_ids"))
    return metrics.transform(with_totals, jobs).select(
        "total_rows", "distinct_job_ids", *[c for c in metrics.columns if c != "total_rows"],
        (F.col("total_rows") - F.col("distinct_job_ids")).alias("duplicate_pks"),
        F.when(F.col("total_rows") == F.col("distinct_job_ids"), "PASS").otherwise("FAIL").alias("pk_status"),
    )


def observed_metrics(as_of=None) -> list[Column]:
    """The single-pass checks of ``dq_report`` that ``DataFrame.observe`` can carry
    (no distinct counts), to collect them as a side effect of writing staging."""
    avg = F.col("salary_avg_final")
    return [
        F.count(_one()).alias("total_rows"),
        *_null_cols(), *_location_cols(),
        F.count_if(F.col("posted_date").isNull()).alias("failed_parse"),
        F.count_if(F.col("posted_date") > _as_of(as_of)).alias("future_dates"),
        F.min("posted_date").alias("earliest"), F.max("posted_date").alias("latest"),
        *_salary_avail_cols(),
        F.count(avg).alias("has_salary"),
        F.count_if(F.col("salary_min_final") > F.col("salary_max_final")).alias("inverted_ranges"),
    ]
