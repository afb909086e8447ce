"""Report questions over the star (the reference describes them in prose only).

Each takes a built ``Star``. Fact rows are first reduced on the small dimension
keys and only then joined to dimension attributes, so joins and sorts work on
at most dimension-sized inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import keysets
from ..operators.joins import with_totals
from ..operators.mart import LOCATION_LEVELS
from ..operators.ranges import grouped_quantile
from ..operators.stats import exact_quantile
from .pipeline import Star

# FIXED VALUES — salary bands named in the reference (100-160K, 130-160K, 160-200K, 200K+)
# plus lower edges of our own; each band is [lower, next lower).
SALARY_BAND_EDGES = [0, 30000, 60000, 100000, 130000, 160000, 200000]


def _one() -> Column:
    return F.lit(1)


def _pct(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(100.0 * num, den), 1).cast("double")


def _total(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(_one()).alias("_total"))


def _facts_in_window(s: Star, start: str | None, end: str | None) -> DataFrame:
    """Facts whose posting date lies in [start, end]; the filter works on ``date_id``
    (yyyymmdd), so it needs no join to the calendar."""
    f = s.fact
    if start is not None:
        f = f.where(F.col("date_id") >= int(start.replace("-", "")))
    if end is not None:
        f = f.where(F.col("date_id") <= int(end.replace("-", "")))
    return f


def postings_by_location(s: Star, level: str = "city", top: int = 10, start: str | None = None,
                         end: str | None = None) -> DataFrame:
    """Postings per location level (NULL shown as 'Unknown') between two dates (both
    included, all if none), percent of the postings there, top ``top``."""
    facts = _facts_in_window(s, start, end)
    per_loc = facts.groupBy("location_id").agg(F.count(_one()).alias("_n"))
    named = per_loc.join(s.dim_location.select("location_id", level), "location_id", "left")
    per = named.groupBy(F.coalesce(F.col(level), F.lit("Unknown")).alias("location")).agg(
        F.sum("_n").alias("postings"))
    return (per.transform(with_totals, _total(facts))
            .select(F.lit(level).alias("level"), "location", "postings",
                    _pct(F.col("postings"), F.col("_total")).alias("pct"))
            .orderBy(F.col("postings").desc(), F.col("location")).limit(top))


def postings_by_company(s: Star, top: int = 10) -> DataFrame:
    """R2: top hiring companies."""
    per = (s.fact.where(F.col("company_id").isNotNull())
           .groupBy("company_id").agg(F.count(_one()).alias("postings")))
    return (per.join(s.dim_company.select("company_id", "company_name"), "company_id")
            .transform(with_totals, _total(s.fact))
            .select("company_name", "postings", _pct(F.col("postings"), F.col("_total")).alias("pct"))
            .orderBy(F.col("postings").desc(), F.col("company_name")).limit(top))


def salary_stats(s: Star, start: str | None = None, end: str | None = None) -> DataFrame:
    """Mean, exact median, n and coverage among disclosed salaries, between two dates."""
    f = _facts_in_window(s, start, end)
    basic = f.agg(F.count(_one()).alias("total_jobs"), F.count("salary_avg").alias("n"),
                  F.round(F.avg("salary_avg"), 0).cast("double").alias("mean_salary"))
    med = exact_quantile(f, "salary_avg", 0.5).select(
        F.round(F.col("value"), 0).alias("median_salary"))
    return basic.transform(with_totals, med).select(
        "n", "mean_salary", "median_salary", _pct(F.col("n"), F.col("total_jobs")).alias("pct_with_salary"))


def salary_counts(s: Star) -> DataFrame:
    """``company_id, date_id, salary_avg, n``: how often a company posted a salary on a day. Stored once, the
    counts of any days and companies add up."""
    return (s.fact.where(F.col("salary_avg").isNotNull()).groupBy("company_id", "date_id", "salary_avg")
            .agg(F.count(_one()).alias("n")))


def salary_stats_by_company_and_window(s: Star, counts: DataFrame, windows: list[tuple[str, str, str]]) -> DataFrame:
    """R3 per window (name, first and last date) and company: n, mean and exact median of disclosed
    salaries, from ``salary_counts``; every group's ranks are found at once."""
    inside = [F.when(F.col("date_id").between(int(lo.replace("-", "")), int(hi.replace("-", ""))), F.lit(name))
              for name, lo, hi in windows]
    named = counts.where(F.col("company_id").isNotNull()).withColumn("window", F.explode(F.array_compact(F.array(*inside))))
    keys = ["window", "company_id"]
    per_value = named.groupBy(*keys, "salary_avg").agg(F.sum("n").alias("n"))
    mean = per_value.groupBy(*keys).agg(
        F.round(F.sum(F.col("salary_avg") * F.col("n").cast("decimal(10,0)")) / F.sum("n"), 0).cast("double").alias("mean_salary"))
    median = grouped_quantile(per_value, keys, "salary_avg", "n", 0.5, "median")
    return (median.join(mean, keys).join(s.dim_company.select("company_id", "company_name"), "company_id")
            .select("window", "company_name", F.col("median_n").alias("n"), "mean_salary",
                    F.round("median", 0).alias("median_salary")))


def distinct_in_windows(days: DataFrame, companies: DataFrame, windows: list[tuple[str, str, str]]) -> DataFrame:
    """R2 and R7 per window from stored rows: active days, postings and distinct companies.

    ``days`` has ``date_id, n`` (postings a day), ``companies`` the companies of each day as
    ``keysets.key_bitmaps(fact, "company_id", ("date_id",))``.
    """
    inside = [F.when(F.col("date_id").between(int(lo.replace("-", "")), int(hi.replace("-", ""))), F.lit(name))
              for name, lo, hi in windows]
    window = F.explode(F.array_compact(F.array(*inside))).alias("window")
    per = days.select(window, "n").groupBy("window").agg(F.count(_one()).alias("active_days"), F.sum("n").alias("postings"))
    held = keysets.key_count(companies.select(window, "range", "keys"), "distinct_companies", ("window",))
    return per.join(held, "window", "left").withColumn("distinct_companies", F.coalesce("distinct_companies", F.lit(0)))


def band_label(c: Column, edges=SALARY_BAND_EDGES) -> tuple[Column, Column]:
    lower = F.lit(None).cast("int")
    for e in edges:
        lower = F.when(c >= e, F.lit(e)).otherwise(lower)
    names = {e: (f"{e // 1000}K+" if i == len(edges) - 1 else f"{e // 1000}-{edges[i + 1] // 1000}K")
             for i, e in enumerate(edges)}
    label = F.lit(None).cast("string")
    for e, n in names.items():
        label = F.when(lower == e, F.lit(n)).otherwise(label)
    return lower, label


def salary_histogram(s: Star, start: str | None = None, end: str | None = None) -> DataFrame:
    """Postings per salary band (of postings with a salary) between two dates."""
    f = _facts_in_window(s, start, end).where(F.col("salary_avg").isNotNull())
    lower, label = band_label(F.col("salary_avg"))
    per = f.groupBy(lower.alias("band_lower")).agg(F.count(_one()).alias("postings"))
    _, lab = band_label(F.col("band_lower"))
    tot = f.agg(F.count(_one()).alias("_total"))
    return (per.transform(with_totals, tot).select(lab.alias("band"), "band_lower", "postings",
                                      _pct(F.col("postings"), F.col("_total")).alias("pct"))
            .orderBy("band_lower"))


def daily_trend(s: Star, start: str | None = None, end: str | None = None) -> DataFrame:
    """Postings per posted date."""
    per = _facts_in_window(s, start, end).where(F.col("date_id").isNotNull()).groupBy("date_id").agg(
        F.count(_one()).alias("postings"))
    return (per.join(s.dim_date.select("date_id", "full_date"), "date_id")
            .select("full_date", "postings").orderBy("full_date"))


def monthly_profile(s: Star) -> DataFrame:
    """Per year-month the number of days with postings and the postings."""
    per_day = s.fact.where(F.col("date_id").isNotNull()).groupBy("date_id").agg(
        F.count(_one()).alias("_n"))
    return (per_day.join(s.dim_date.select("date_id", "year", "month"), "date_id")
            .groupBy("year", "month")
            .agg(F.count(_one()).alias("active_days"), F.sum("_n").alias("postings"))
            .orderBy("year", "month"))


def analysis_window(s: Star, start: str, end: str) -> DataFrame:
    """First and last date, active days, postings and distinct companies in a window."""
    f = _facts_in_window(s, start, end)
    days = f.groupBy("date_id").agg(F.count(_one()).alias("_n")).agg(
        F.min("date_id").alias("_first"), F.max("date_id").alias("_last"),
        F.count(_one()).alias("active_days"), F.coalesce(F.sum("_n"), F.lit(0)).alias("postings"))
    companies = (f.where(F.col("company_id").isNotNull()).select("company_id").distinct()
                 .agg(F.count(_one()).alias("distinct_companies")))
    d = lambda c: F.to_date(F.col(c).cast("string"), "yyyyMMdd")
    return days.transform(with_totals, companies).select(
        d("_first").alias("first_date"), d("_last").alias("last_date"), "active_days", "postings",
        "distinct_companies")


def filter_probe(s: Star, on: str, year: int) -> DataFrame:
    """The same count under no filter, ``<= on``, ``>= on`` and ``year = year``, side by side."""
    key = int(on.replace("-", ""))
    d = F.col("date_id")
    return s.fact.agg(
        F.count(_one()).alias("no_filter"),
        F.count_if(d <= key).alias("on_or_before"),
        F.count_if(d >= key).alias("on_or_after"),
        F.count_if((d >= year * 10000) & (d < (year + 1) * 10000)).alias("in_year"))


def top_skills_in_window(s: Star, start: str, end: str, min_count: int = 5) -> DataFrame:
    """Skill demand among postings in a date window, skills below ``min_count`` dropped."""
    f = _facts_in_window(s, start, end).select("job_posting_id")
    demand = (s.bridge.join(f, "job_posting_id")
              .groupBy("skill_id").agg(F.count(_one()).alias("demand_count"))
              .where(F.col("demand_count") >= min_count))
    return (demand.join(s.dim_skill.select("skill_id", "skill_name", "skill_category"), "skill_id")
            .transform(with_totals, f.agg(F.count(_one()).alias("_total")))
            .select("skill_name", "skill_category", "demand_count",
                    _pct(F.col("demand_count"), F.col("_total")).alias("pct_of_jobs"))
            .orderBy(F.col("demand_count").desc(), "skill_name"))


def skill_category_rollup(s: Star) -> DataFrame:
    """Skill mentions and distinct jobs per skill category."""
    tagged = s.bridge.join(s.dim_skill.select("skill_id", "skill_category"), "skill_id")
    per_job = tagged.groupBy("skill_category", "job_posting_id").agg(F.count(_one()).alias("_n"))
    return (per_job.groupBy("skill_category")
            .agg(F.sum("_n").alias("mentions"), F.count(_one()).alias("jobs"))
            .orderBy(F.col("mentions").desc(), "skill_category"))


def category_share(s: Star, start: str | None = None, end: str | None = None) -> DataFrame:
    """Percent of the postings between two dates per job family (missing category as 'Unknown')."""
    facts = _facts_in_window(s, start, end)
    per = facts.groupBy("category_id").agg(F.count(_one()).alias("_n"))
    named = per.join(s.dim_category.select("category_id", "category_label"), "category_id", "left")
    out = named.groupBy(F.coalesce("category_label", F.lit("Unknown")).alias("category")).agg(
        F.sum("_n").alias("postings"))
    return (out.transform(with_totals, _total(facts))
            .select("category", "postings", _pct(F.col("postings"), F.col("_total")).alias("pct"))
            .orderBy(F.col("postings").desc(), "category"))


def location_drilldown(s: Star) -> DataFrame:
    """Postings at every prefix of country > state > region > city > suburb.

    Facts are first counted per location id (dimension-sized), then rolled up;
    ``level`` is ``grouping_id`` (0 = full detail, 31 = grand total), which keeps a
    NULL level apart from a subtotal.
    """
    per = s.fact.groupBy("location_id").agg(F.count(_one()).alias("_n"))
    named = per.join(s.dim_location.select("location_id", *LOCATION_LEVELS), "location_id", "left")
    return (named.rollup(*LOCATION_LEVELS)
            .agg(F.grouping_id().alias("level"), F.sum("_n").alias("postings")))


def multi_definition_jobs(s: Star) -> DataFrame:
    """Postings found under more than one search term, by number of terms."""
    per = (s.fact.where(F.col("search_term_count") > 1)
           .groupBy("search_term_count").agg(F.count(_one()).alias("jobs")))
    return (per.transform(with_totals, _total(s.fact))
            .select("search_term_count", "jobs", _pct(F.col("jobs"), F.col("_total")).alias("pct_of_all"))
            .orderBy("search_term_count"))
