"""W8 / W8v: settle salaries under the explicit rules, then check them.

Rules, in order: currency defaults to AUD; API values <= 0 become NULL; period is
'annual' when either API value is present (even if both were cleared); an inverted
range is swapped (both sides from the old values); the average is the midpoint, or
the single bound present; an average below the floor clears min, max, avg and period.
All of it is one projection — no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.vocab import DEFAULT_CURRENCY, SALARY_FLOOR, SALARY_PERIOD, CHECK_SALARY_COVERAGE, CHECK_SALARY_SANITY

MONEY = "decimal(12,2)"


def finalize_salary(stg: DataFrame) -> DataFrame:
    lo_api, hi_api = F.col("salary_min_api"), F.col("salary_max_api")
    lo = F.when(lo_api > 0, lo_api)
    hi = F.when(hi_api > 0, hi_api)
    period = F.when(lo_api.isNotNull() | hi_api.isNotNull(), F.lit(SALARY_PERIOD))
    inverted = lo.isNotNull() & hi.isNotNull() & (lo > hi)
    lo2 = F.when(inverted, hi).otherwise(lo)
    hi2 = F.when(inverted, lo).otherwise(hi)
    avg = (F.when(lo2.isNotNull() & hi2.isNotNull(), ((lo2 + hi2) / 2).cast(MONEY))
            .when(lo2.isNotNull(), lo2).otherwise(hi2))
    step = stg.withColumns({
        "_lo": lo2.cast(MONEY), "_hi": hi2.cast(MONEY), "_avg": avg.cast(MONEY), "_period": period})
    cleared = F.col("_avg").isNotNull() & (F.col("_avg") < SALARY_FLOOR)
    keep = lambda c: F.when(~cleared, F.col(c))
    return step.withColumns({
        "salary_currency": F.coalesce(F.col("salary_currency"), F.lit(DEFAULT_CURRENCY)),
        "salary_min_final": keep("_lo"),
        "salary_max_final": keep("_hi"),
        "salary_avg_final": keep("_avg"),
        "salary_period": F.when(cleared, F.lit(None).cast("string")).otherwise(F.col("_period")),
    }).drop("_lo", "_hi", "_avg", "_period")


def salary_coverage(stg: DataFrame) -> DataFrame:
    avg = F.col("salary_avg_final")
    total = F.count(F.lit(1))
    return stg.agg(
        F.lit(CHECK_SALARY_COVERAGE).alias("check_name"),
        total.alias("total_jobs"),
        F.count(avg).alias("has_salary"),
        F.round(F.try_divide(100.0 * F.count(avg), total), 1).cast("double").alias("pct_with_salary"),
        F.round(F.min(avg), 0).cast("double").alias("min_salary"),
        F.round(F.avg(avg), 0).cast("double").alias("avg_salary"),
        F.round(F.max(avg), 0).cast("double").alias("max_salary"))


def salary_sanity(stg: DataFrame) -> DataFrame:
    lo, hi, avg = F.col("salary_min_final"), F.col("salary_max_final"), F.col("salary_avg_final")
    return stg.agg(
        F.lit(CHECK_SALARY_SANITY).alias("check_name"),
        F.count_if(lo > hi).alias("inverted_ranges"),
        F.count_if(avg > 1000000).alias("over_1m"),
        F.count_if((avg < 20000) & avg.isNotNull()).alias("under_20k"))
