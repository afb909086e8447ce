"""Dimensions, fact table and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import date_key, iso_weekday
from .joins import lookup
from .keys import surrogate_key
from ..functions.vocab import CHECK_FACT_INTEGRITY

LOCATION_LEVELS = ("country", "state", "region", "city", "suburb")


def folded_levels() -> list[F.Column]:
    """The five levels with NULL as empty text: together the key of a place."""
    return [F.coalesce(F.col(c), F.lit("")) for c in LOCATION_LEVELS]


def location_key() -> F.Column:
    """The levels joined by '|', for display; places whose names hold a bar may share it."""
    return F.concat_ws("|", *folded_levels())


def dim_company(stg: DataFrame, collation: str | None = None) -> DataFrame:
    """One row per non-null normalised name; byte-greatest display name.

    With a ``collation`` (such as ``UNICODE_CI_AI``) names that it takes as equal are one company, under
    the byte-least of its normalised names; ``company_normalized`` then bears the collation, so a
    lookup by it compares in the same way (``lookup_company``).
    """
    named = stg.where(F.col("company_normalized").isNotNull())
    if collation is None:
        d = named.groupBy("company_normalized").agg(F.max("company_name").alias("company_name"))
    else:
        d = (named.groupBy(F.collate("company_normalized", collation).alias("_same"))
             .agg(F.max("company_name").alias("company_name"), F.min("company_normalized").alias("company_normalized"))
             .select("company_name", "company_normalized"))
    numbered = surrogate_key(d, ["company_normalized"], "company_id").select(
        "company_id", "company_name", "company_normalized")
    if collation is None:
        return numbered
    return numbered.withColumn("company_normalized", F.collate("company_normalized", collation))


def lookup_company(stg: DataFrame, company: DataFrame, collation: str) -> DataFrame:
    """``job_id, company_id``: each posting's company under a collated dimension (NULL without a name)."""
    postings = stg.select("job_id", F.collate("company_normalized", collation).alias("_name"))
    same = postings["_name"] == F.collate(company["company_normalized"], collation)
    return postings.join(company, same, "left").select("job_id", "company_id")


def dim_location(stg: DataFrame) -> DataFrame:
    """One row per place, that is per five levels with NULL and empty text alike.

    The fact lookup uses the same five levels, so it cannot fan out. ``location_id`` counts
    in the order of the levels; coordinates are maxima taken independently.
    """
    keys = [f"_{c}" for c in LOCATION_LEVELS]
    d = (stg.select("*", *[f.alias(k) for f, k in zip(folded_levels(), keys)])
            .groupBy(*keys)
            .agg(*[F.max(c).alias(c) for c in LOCATION_LEVELS],
                 F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"))
            .withColumn("location_key", location_key()))
    return surrogate_key(d, keys, "location_id").select(
        "location_id", *LOCATION_LEVELS, "latitude", "longitude", "location_key")


def date_parts(d: F.Column) -> list[F.Column]:
    wd = iso_weekday(d)
    return [
        date_key(d).alias("date_id"), d.alias("full_date"), F.year(d).alias("year"),
        F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day_of_month"),
        wd.alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.when(wd >= 6, 1).otherwise(0).alias("is_weekend"),
    ]


def dim_date(stg: DataFrame) -> DataFrame:
    """One row per distinct posted date (smart key yyyymmdd, no surrogate)."""
    days = stg.where(F.col("posted_date").isNotNull()).select("posted_date").distinct()
    return days.select(*date_parts(F.col("posted_date")))


def dim_category(stg: DataFrame) -> DataFrame:
    """One row per non-null tag, greatest label."""
    d = (stg.where(F.col("category_tag").isNotNull())
            .groupBy("category_tag").agg(F.max("category_label").alias("category_label")))
    return surrogate_key(d, ["category_tag"], "category_id").select(
        "category_id", "category_tag", "category_label")


def load_fact(stg: DataFrame, company: DataFrame, location: DataFrame,
              category: DataFrame) -> DataFrame:
    """One fact per staging row with four left key lookups.

    ``date_id`` is the smart key of ``posted_date``; ``dim_date`` holds every
    non-null posted date by construction, so no join is needed for it.
    The numbering of facts by ``job_id`` is the last step (W9).
    """
    # The place's whole key as one value, so that no two places share it.
    s = stg.withColumn("_place", F.to_json(F.array(*folded_levels())))
    places = location.withColumn("_place", F.to_json(F.array(*folded_levels())))
    fact = (s.transform(lookup, company, "company_normalized", "company_normalized", "company_id", "job_id")
              .transform(lookup, places, "_place", "_place", "location_id", "job_id")
              .transform(lookup, category, "category_tag", "category_tag", "category_id", "job_id")
              .select(
                  "job_id", "title", "company_id", "location_id",
                  date_key(F.col("posted_date")).alias("date_id"), "category_id",
                  F.col("salary_min_final").alias("salary_min"),
                  F.col("salary_max_final").alias("salary_max"),
                  F.col("salary_avg_final").alias("salary_avg"),
                  F.when(F.col("salary_avg_final").isNotNull(), 1).otherwise(0).alias("has_salary"),
                  "contract_type", "contract_time", "search_term_count"))
    return surrogate_key(fact, ["job_id"], "job_posting_id").select(
        "job_posting_id", "job_id", "title", "company_id", "location_id", "date_id", "category_id",
        "salary_min", "salary_max", "salary_avg", "has_salary", "contract_type", "contract_time",
        "search_term_count")


def mart_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(tbl, cnt)`` for each named frame."""
    frames = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
              for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def fact_integrity(fact: DataFrame) -> DataFrame:
    """Facts whose lookup found no dimension row, per key."""
    return fact.agg(
        F.lit(CHECK_FACT_INTEGRITY).alias("check_name"),
        F.count(F.lit(1)).alias("total_facts"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c[:-3]}")
          for c in ("company_id", "location_id", "date_id", "category_id")])


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null ``key`` has no row in ``dim`` (an enforced FK would refuse them)."""
    return fact.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def fact_orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key: facts whose non-null key has no dimension row (``left_anti``),
    the check an enforced FOREIGN KEY would make."""
    frames = [orphan_keys(fact, dim, key).agg(F.count(F.lit(1)).alias("orphans"))
              .select(F.lit(key).alias("fk"), "orphans") for key, dim in dims.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
