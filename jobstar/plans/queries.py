"""Registered queries: name -> (Spark builder over an sf folder, oracle SQL or None).

Every builder reads the provided tables (or frames Spark derives from them) in
full. Output columns are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import collapse_whitespace, contains_text
from ..operators import keysets, mart, parity, quality, salary, skills, staging
from ..operators.dictionary import match_dictionary
from ..operators.joins import with_totals
from ..operators.repostings import reposting_groups
from ..operators.upsert import bucket_count, upsert_raw
from ..session import materialize, scratch_path, slice_of, slices_of
from ..sources import landing
from ..sources.schemas import schema_listing
from ..sources.standin import feed_rows
from ..sources.stored import store_slices, stored_path, stored_slices
from ..sources.tables import Tables
from ..streaming.ingest import apply_batch, ingest_incremental
from ..streaming.kept_reports import KeptReports
from ..streaming.logtable import delete, read_version
from . import oracle_sql as O
from . import reports as R
from .pipeline import Star, star_for


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operator: str


REGISTRY: dict[str, Query] = {}


def register(name: str, operator: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, operator)
        return fn
    return deco


def _cols_sql(cols) -> str:
    return ", ".join(cols)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


RAW_COLS = ["id", "job_id", "search_term", "fetched_at", "title", "company_name", "location_display",
            "category_tag", "contract_type", "contract_time", "salary_min", "salary_max",
            "salary_is_predicted", "latitude", "longitude", "created_at"]

# ---------------------------------------------------------------- raw / staging


@register("upsert_raw", "W2", O.with_ctes(*O.CHAIN_RAW) + f" SELECT {_cols_sql(RAW_COLS)} FROM raw")
def q_upsert_raw(spark, sf):
    feed = feed_rows(Tables(spark, sf))
    slices = slices_of(feed.count())
    return _union([materialize(upsert_raw(None, slice_of(feed, "job_id", slices, k)).select(*RAW_COLS), "raw-merged")
                   for k in range(slices)])


@register("upsert_two_batches", "W2", O.with_ctes(*O.CHAIN_RAW) + """
 , again AS (SELECT job_id, search_term, max(id) AS id FROM feed
           WHERE CAST(substr(search_term, 6) AS INTEGER) % 2 = 0 GROUP BY job_id, search_term),
 fresh AS (SELECT 'new-' || job_id AS job_id, search_term, min(id) AS first_id, max(id) AS id FROM feed
           WHERE search_term = 'term_1' GROUP BY job_id, search_term)
 SELECT r.id, job_id, search_term, CASE WHEN a.id IS NULL THEN fetched_at ELSE TIMESTAMP '1970-01-01' END AS fetched_at,
   CASE WHEN a.id IS NULL THEN title ELSE 'second ' || a.id END AS title,
   CASE WHEN a.id IS NULL THEN company_name END AS company_name,
   CASE WHEN a.id IS NOT NULL THEN '{"second":' || a.id || '}' END AS second_raw_data
 FROM raw r LEFT JOIN again a USING (job_id, search_term)
 UNION ALL
 SELECT first_id + 1, job_id, search_term, TIMESTAMP '1970-01-01', 'second ' || id, NULL, '{"second":' || id || '}' FROM fresh""")
def q_upsert_two_batches(spark, sf):
    """The second batch has older fetch times and other values, and wins all the same; ids stay."""
    feed = feed_rows(Tables(spark, sf))
    old = F.lit("1970-01-01").cast("timestamp_ntz")
    line = F.substring_index("search_term", "_", -1).cast("int")
    sent = feed.where((line % 2 == 0) | (line == 1))
    job = F.when(line == 1, F.concat(F.lit("new-"), F.col("job_id"))).otherwise(F.col("job_id"))
    text = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in feed.schema.fields}
    second = sent.select(*[c.alias(n) for n, c in (text | {
        "id": F.col("id") + 1, "job_id": job, "search_term": F.col("search_term"), "fetched_at": old,
        "title": F.concat(F.lit("second "), F.col("id").cast("string")),
        "raw_data": F.concat(F.lit('{"second":'), F.col("id").cast("string"), F.lit("}"))}).items()])
    slices = slices_of(feed.count())
    merged = []
    for k in range(slices):  # a slice of the first table stays only until its second batch is in
        scratch = scratch_path(spark, "raw-slice")
        first = materialize(upsert_raw(None, slice_of(feed, "job_id", slices, k)), "raw-first", scratch)
        both = upsert_raw(first, slice_of(second, "job_id", slices, k)).select(
            "id", "job_id", "search_term", "fetched_at", "title", "company_name",
            F.when(F.col("raw_data").startswith('{"second"'), F.col("raw_data")).alias("second_raw_data"))
        merged.append(materialize(both, "raw-merged"))
        delete(spark, scratch)
    return _union(merged)


@register("dedup_latest", "W3", O.with_ctes(*O.CHAIN_RAW) + """
 SELECT job_id, id, search_term, fetched_at FROM (
   SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY fetched_at DESC, id DESC) AS rn FROM raw)
 WHERE rn = 1""")
def q_dedup_latest(spark, sf):
    return staging.dedup_latest(star_for(spark, sf).raw).select("job_id", "id", "search_term", "fetched_at")


@register("search_context", "W4", O.with_ctes(*O.CHAIN_RAW, O.STAGE0) +
          " SELECT job_id, search_terms, search_term_count, first_fetched_at, last_fetched_at FROM stage0")
def q_search_context(spark, sf):
    return staging.search_context(star_for(spark, sf).raw)


STAGE_COLS = [c for c in staging.STAGING_COLUMNS if c not in (
    "transformed_at", "salary_min_extracted", "salary_max_extracted", "salary_period", "salary_currency",
    "salary_min_final", "salary_max_final", "salary_avg_final")]


@register("stage_jobs", "W5-W7", O.with_ctes(*O.CHAIN_RAW, O.STAGE0) + f" SELECT {_cols_sql(STAGE_COLS)} FROM stage0")
def q_stage_jobs(spark, sf):
    return staging.load_staging(star_for(spark, sf).raw).select(*STAGE_COLS)


@register("staging_summary", "W7v", O.with_ctes(*O.CHAIN_RAW, O.STAGE0) + """
 SELECT count(*) AS total, count(state) AS has_state, count(suburb) AS has_suburb,
        count(*) FILTER (WHERE search_term_count > 1) AS multi_search_jobs,
        max(search_term_count) AS max_search_terms FROM stage0""")
def q_staging_summary(spark, sf):
    return staging.staging_summary(star_for(spark, sf).stg)


SAL_COLS = ["job_id", "salary_min_api", "salary_max_api", "salary_currency", "salary_period",
            "salary_min_final", "salary_max_final", "salary_avg_final"]


@register("finalize_salary", "W8", O.with_ctes(*O.CHAIN_STG) + f" SELECT {_cols_sql(SAL_COLS)} FROM stg")
def q_finalize_salary(spark, sf):
    return star_for(spark, sf).stg.select(*SAL_COLS)


@register("salary_coverage", "W8v", O.with_ctes(*O.CHAIN_STG) + """
 SELECT 'Salary coverage' AS check_name, count(*) AS total_jobs, count(salary_avg_final) AS has_salary,
   CAST(round(100.0 * count(salary_avg_final) / count(*), 1) AS DOUBLE) AS pct_with_salary,
   CAST(round(min(salary_avg_final), 0) AS DOUBLE) AS min_salary,
   CAST(round(avg(salary_avg_final), 0) AS DOUBLE) AS avg_salary,
   CAST(round(max(salary_avg_final), 0) AS DOUBLE) AS max_salary FROM stg""")
def q_salary_coverage(spark, sf):
    return salary.salary_coverage(star_for(spark, sf).stg)


@register("salary_sanity", "W8v", O.with_ctes(*O.CHAIN_STG) + """
 SELECT 'Salary sanity' AS check_name,
   count(*) FILTER (WHERE salary_min_final > salary_max_final) AS inverted_ranges,
   count(*) FILTER (WHERE salary_avg_final > 1000000) AS over_1m,
   count(*) FILTER (WHERE salary_avg_final < 20000 AND salary_avg_final IS NOT NULL) AS under_20k FROM stg""")
def q_salary_sanity(spark, sf):
    return salary.salary_sanity(star_for(spark, sf).stg)


# ---------------------------------------------------------------- star


@register("dim_company", "W9+W10", O.with_ctes(*O.CHAIN_STAR) + " SELECT * FROM dim_company")
def q_dim_company(spark, sf):
    return star_for(spark, sf).dim_company


@register("dim_location", "W9+W11", O.with_ctes(*O.CHAIN_STAR) + " SELECT * FROM dim_location")
def q_dim_location(spark, sf):
    return star_for(spark, sf).dim_location


@register("dim_date", "W12", O.with_ctes(*O.CHAIN_STAR) + " SELECT * FROM dim_date")
def q_dim_date(spark, sf):
    return star_for(spark, sf).dim_date


@register("dim_category", "W9+W13", O.with_ctes(*O.CHAIN_STAR) + " SELECT * FROM dim_category")
def q_dim_category(spark, sf):
    return star_for(spark, sf).dim_category


@register("fact_postings", "W9+W14", O.with_ctes(*O.CHAIN_STAR) + " SELECT * FROM fact")
def q_fact_postings(spark, sf):
    return star_for(spark, sf).fact


@register("mart_row_counts", "W15", O.with_ctes(*O.CHAIN_STAR) + """
 SELECT 'dim_company' AS tbl, count(*) AS cnt FROM dim_company
 UNION ALL SELECT 'dim_location', count(*) FROM dim_location
 UNION ALL SELECT 'dim_date', count(*) FROM dim_date
 UNION ALL SELECT 'dim_category', count(*) FROM dim_category
 UNION ALL SELECT 'fact_job_postings', count(*) FROM fact""")
def q_mart_row_counts(spark, sf):
    s = star_for(spark, sf)
    return mart.mart_row_counts({"dim_company": s.dim_company, "dim_location": s.dim_location,
                                 "dim_date": s.dim_date, "dim_category": s.dim_category,
                                 "fact_job_postings": s.fact})


@register("fact_integrity", "W16", O.with_ctes(*O.CHAIN_STAR) + """
 SELECT 'fact integrity' AS check_name, count(*) AS total_facts,
   count(*) FILTER (WHERE company_id IS NULL) AS missing_company,
   count(*) FILTER (WHERE location_id IS NULL) AS missing_location,
   count(*) FILTER (WHERE date_id IS NULL) AS missing_date,
   count(*) FILTER (WHERE category_id IS NULL) AS missing_category FROM fact""")
def q_fact_integrity(spark, sf):
    return mart.fact_integrity(star_for(spark, sf).fact)


@register("fact_orphans", "W16", O.with_ctes(*O.CHAIN_STAR) + """
 SELECT 'company_id' AS fk, count(*) AS orphans FROM fact f
   WHERE f.company_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_company d WHERE d.company_id = f.company_id)
 UNION ALL SELECT 'location_id', count(*) FROM fact f
   WHERE f.location_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_location d WHERE d.location_id = f.location_id)
 UNION ALL SELECT 'date_id', count(*) FROM fact f
   WHERE f.date_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_id = f.date_id)
 UNION ALL SELECT 'category_id', count(*) FROM fact f
   WHERE f.category_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_category d WHERE d.category_id = f.category_id)""")
def q_fact_orphans(spark, sf):
    s = star_for(spark, sf)
    return mart.fact_orphans(s.fact, {"company_id": s.dim_company, "location_id": s.dim_location,
                                      "date_id": s.dim_date, "category_id": s.dim_category})


_ACCENTED = "CASE WHEN CAST(job_id AS BIGINT) % 3 = 0 THEN replace(company_normalized, 'o', 'ó') " \
            "WHEN CAST(job_id AS BIGINT) % 3 = 1 THEN upper(company_normalized) ELSE company_normalized END"


def _respelled(s: Star) -> DataFrame:
    """Postings whose company names differ in case and accents."""
    name, job = F.col("company_normalized"), F.col("job_id").cast("long")
    return s.stg.select("job_id", "company_name", F.when(job % 3 == 0, F.replace(name, F.lit("o"), F.lit("ó")))
                        .when(job % 3 == 1, F.upper(name)).otherwise(name).alias("company_normalized"))


_CI_AI_SQL = O.with_ctes(*O.CHAIN_STG) + f"""
 , named AS (SELECT job_id, company_name, {_ACCENTED} AS name FROM stg),
 d AS (SELECT lower(strip_accents(name)) AS same, max(company_name) AS company_name, min(name) AS company_normalized
       FROM named WHERE name IS NOT NULL GROUP BY 1),
 dim AS (SELECT row_number() OVER (ORDER BY company_normalized) AS company_id, * FROM d)"""


@register("dim_company_ci_ai", "W10", _CI_AI_SQL + " SELECT company_id, company_name, company_normalized FROM dim")
def q_dim_company_ci_ai(spark, sf):
    dim = mart.dim_company(_respelled(star_for(spark, sf)), "UNICODE_CI_AI")
    return dim.withColumn("company_normalized", F.collate("company_normalized", "UTF8_BINARY"))


@register("lookup_company_ci_ai", "W10+W14", _CI_AI_SQL + """
 SELECT job_id, company_id FROM named LEFT JOIN dim ON lower(strip_accents(name)) = same""")
def q_lookup_company_ci_ai(spark, sf):
    postings = _respelled(star_for(spark, sf))
    dim = materialize(mart.dim_company(postings, "UNICODE_CI_AI"), "dim_company_ci_ai")
    return mart.lookup_company(postings, dim, "UNICODE_CI_AI")


@register("orphan_key_counts", "W16", O.with_ctes(*O.CHAIN_STAR) + """
 SELECT 'company_id' AS fk, (SELECT count(DISTINCT company_id) FROM fact WHERE company_id IS NOT NULL
   AND company_id NOT IN (SELECT company_id FROM dim_company WHERE company_id % 5 > 0)) AS orphan_keys
 UNION ALL SELECT 'location_id', (SELECT count(DISTINCT location_id) FROM fact WHERE location_id IS NOT NULL
   AND location_id NOT IN (SELECT location_id FROM dim_location WHERE location_id % 5 > 0))
 UNION ALL SELECT 'category_id', (SELECT count(DISTINCT category_id) FROM fact WHERE category_id IS NOT NULL
   AND category_id NOT IN (SELECT category_id FROM dim_category))""")
def q_orphan_key_counts(spark, sf):
    """Keys of facts that dimensions lack: every fifth company and place is taken away, no category."""
    s = star_for(spark, sf)
    dims = {"company_id": s.dim_company.where("company_id % 5 > 0"), "location_id": s.dim_location.where("location_id % 5 > 0"),
            "category_id": s.dim_category}
    found = [keysets.orphan_key_count(keysets.key_bitmaps(s.fact, k), keysets.key_bitmaps(d, k)).select(
        F.lit(k).alias("fk"), "orphan_keys") for k, d in dims.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


# ---------------------------------------------------------------- quality


@register("dq_pk", "W17", O.with_ctes(*O.CHAIN_STG) + """
 SELECT '1. PK uniqueness' AS check_name, count(*) AS total_rows, count(DISTINCT job_id) AS distinct_job_ids,
   count(*) - count(DISTINCT job_id) AS duplicate_pks,
   CASE WHEN count(*) = count(DISTINCT job_id) THEN 'PASS' ELSE 'FAIL' END AS status FROM stg""")
def q_dq_pk(spark, sf):
    return quality.dq_pk(star_for(spark, sf).stg)


NULLS_SQL = """count(*) FILTER (WHERE title IS NULL) AS null_title,
   count(*) FILTER (WHERE company_name IS NULL) AS null_company,
   count(*) FILTER (WHERE state IS NULL) AS null_state,
   count(*) FILTER (WHERE posted_date IS NULL) AS null_posted_date,
   count(*) FILTER (WHERE description_clean IS NULL OR description_clean = '') AS null_description"""
LOC_SQL = """count(country) AS has_country, count(state) AS has_state, count(region) AS has_region,
   count(city) AS has_city, count(suburb) AS has_suburb,
   CAST(round(100.0 * count(*) FILTER (WHERE state IS NULL) / count(*), 1) AS DOUBLE) AS pct_missing_state"""
DATES_SQL = f"""count(*) FILTER (WHERE posted_date IS NULL) AS failed_parse,
   count(*) FILTER (WHERE posted_date > DATE '{O.AS_OF}') AS future_dates,
   min(posted_date) AS earliest, max(posted_date) AS latest,
   CASE WHEN count(*) FILTER (WHERE posted_date IS NULL) = 0
         AND count(*) FILTER (WHERE posted_date > DATE '{O.AS_OF}') = 0 THEN 'PASS' ELSE 'REVIEW' END"""
SALAVAIL_SQL = """count(salary_min_api) AS has_api_salary_min, count(salary_max_api) AS has_api_salary_max,
   CAST(round(100.0 * count(*) FILTER (WHERE salary_min_api IS NULL) / count(*), 1) AS DOUBLE)
     AS pct_missing_api_salary,
   count(*) FILTER (WHERE contains(description_clean, '$')) AS desc_contains_dollar"""


@register("dq_nulls", "W18", O.with_ctes(*O.CHAIN_STG) +
          f" SELECT '2. NULL completeness' AS check_name, count(*) AS total, {NULLS_SQL} FROM stg")
def q_dq_nulls(spark, sf):
    return quality.dq_nulls(star_for(spark, sf).stg)


@register("dq_location", "W19", O.with_ctes(*O.CHAIN_STG) +
          f" SELECT '3. Location completeness' AS check_name, count(*) AS total, {LOC_SQL} FROM stg")
def q_dq_location(spark, sf):
    return quality.dq_location(star_for(spark, sf).stg)


@register("dq_dates", "W20", O.with_ctes(*O.CHAIN_STG) +
          f" SELECT '4. Date validity' AS check_name, count(*) AS total, {DATES_SQL} AS status FROM stg")
def q_dq_dates(spark, sf):
    return quality.dq_dates(star_for(spark, sf).stg, O.AS_OF)


@register("fuzzy_dup_tight", "W21", O.with_ctes(*O.CHAIN_STG) + """
 , twins AS (
   -- For each row: how many other rows of its group lie within seven days.
   SELECT count(*) OVER (PARTITION BY title_normalized, company_normalized, state, suburb ORDER BY posted_date
                         RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY FOLLOWING) - 1 AS others
   FROM stg WHERE title_normalized IS NOT NULL AND company_normalized IS NOT NULL AND state IS NOT NULL
              AND suburb IS NOT NULL AND posted_date IS NOT NULL)
 SELECT '5b. Fuzzy dup (tightened)' AS check_name, CAST(coalesce(sum(others), 0) // 2 AS BIGINT) AS fuzzy_dup_pairs,
   CAST(round(100.0 * (coalesce(sum(others), 0) // 2) / (SELECT count(*) FROM stg), 1) AS DOUBLE) AS pct_of_total,
   count(*) FILTER (WHERE others > 0) AS rows_involved FROM twins""")
def q_fuzzy_dup_tight(spark, sf):
    return quality.fuzzy_dup_tight(star_for(spark, sf).stg)


@register("fuzzy_dup_orders", "W21", """
 WITH twins AS (
   SELECT count(*) OVER (PARTITION BY o_custkey, o_orderpriority, o_orderstatus ORDER BY CAST(o_orderdate AS DATE)
                         RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY FOLLOWING) - 1 AS others
   FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL
                 AND o_orderdate IS NOT NULL)
 SELECT CAST(coalesce(sum(others), 0) // 2 AS BIGINT) AS fuzzy_dup_pairs,
   count(*) FILTER (WHERE others > 0) AS rows_involved FROM twins""")
def q_fuzzy_dup_orders(spark, sf):
    return quality.fuzzy_pair_count(Tables(spark, sf).orders,
                                    ("o_custkey", "o_orderpriority", "o_orderstatus"), "o_orderdate", 7)


def _reposting_sql(rows: str, keys: str, ident: str, day: str) -> str:
    """Islands of days by a running count of gaps; ``keys`` are non-null in ``rows``."""
    return f"""
 g AS (SELECT *, CASE WHEN {day} - lag({day}) OVER w <= 7 THEN 0 ELSE 1 END AS opens
       FROM {rows} WINDOW w AS (PARTITION BY {keys} ORDER BY {day}, {ident})),
 isl AS (SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY {day}, {ident}) AS no FROM g)
 SELECT * FROM (
   SELECT {ident}, min({ident}) OVER p AS group_id, count(*) OVER p AS group_size,
     min({day}) OVER p AS first_day, max({day}) OVER p AS last_day
   FROM isl WINDOW p AS (PARTITION BY {keys}, no)) WHERE group_size > 1"""


_TIGHT = "title_normalized, company_normalized, state, suburb"


@register("reposting_groups", "W21", O.with_ctes(*O.CHAIN_STG) + f"""
 , dated AS (SELECT job_id, {_TIGHT}, posted_date FROM stg
   WHERE title_normalized IS NOT NULL AND company_normalized IS NOT NULL AND state IS NOT NULL
     AND suburb IS NOT NULL AND posted_date IS NOT NULL),""" + _reposting_sql("dated", _TIGHT, "job_id", "posted_date"))
def q_reposting_groups(spark, sf):
    return reposting_groups(star_for(spark, sf).stg)


@register("reposting_groups_orders", "W21", """
 WITH dated AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, o_custkey % 50 AS account,
   CAST(o_orderdate AS DATE) AS d FROM orders
   WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL AND o_orderdate IS NOT NULL),
""" + _reposting_sql("dated", "account, o_orderpriority, o_orderstatus", "o_orderkey", "d"))
def q_reposting_groups_orders(spark, sf):
    orders = Tables(spark, sf).orders.withColumn("account", F.col("o_custkey") % 50)
    return reposting_groups(orders, ("account", "o_orderpriority", "o_orderstatus"), "o_orderdate", 7, "o_orderkey")


@register("fuzzy_dup_loose", "W22", O.with_ctes(*O.CHAIN_STG) + """
 , g AS (SELECT count(*) AS n FROM stg WHERE title_normalized IS NOT NULL AND company_normalized IS NOT NULL
          AND state IS NOT NULL GROUP BY title_normalized, company_normalized, state)
 SELECT '5a. Fuzzy dup (loose)' AS check_name,
   CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_flagged,
   (SELECT count(*) FROM stg a JOIN stg b ON a.title_normalized = b.title_normalized
      AND a.company_normalized = b.company_normalized AND a.state = b.state AND a.job_id < b.job_id)
     AS fuzzy_dup_pairs,
   CAST(round(100.0 * coalesce(sum(n) FILTER (WHERE n > 1), 0) / (SELECT count(*) FROM stg), 1) AS DOUBLE)
     AS pct_rows_flagged
 FROM g""")
def q_fuzzy_dup_loose(spark, sf):
    return quality.fuzzy_dup_loose(star_for(spark, sf).stg)


@register("dq_category", "W23", O.with_ctes(*O.CHAIN_STG) + """
 SELECT '6. Category diversity' AS check_name, category_tag, count(*) AS job_count,
   CAST(round(100.0 * count(*) / (SELECT count(*) FROM stg), 1) AS DOUBLE) AS pct
 FROM stg GROUP BY category_tag""")
def q_dq_category(spark, sf):
    return quality.dq_category(star_for(spark, sf).stg)


@register("dq_salary_availability", "W24", O.with_ctes(*O.CHAIN_STG) +
          f" SELECT '7. Salary availability' AS check_name, count(*) AS total, {SALAVAIL_SQL} FROM stg")
def q_dq_salary_availability(spark, sf):
    return quality.dq_salary_availability(star_for(spark, sf).stg)


@register("dq_report", "W25", O.with_ctes(*O.CHAIN_STG) + f"""
 SELECT count(*) AS total_rows, count(DISTINCT job_id) AS distinct_job_ids, {NULLS_SQL}, {LOC_SQL},
   {DATES_SQL} AS date_status, {SALAVAIL_SQL},
   count(*) FILTER (WHERE search_term_count > 1) AS multi_search_jobs,
   max(search_term_count) AS max_search_terms,
   count(salary_avg_final) AS has_salary,
   CAST(round(100.0 * count(salary_avg_final) / count(*), 1) AS DOUBLE) AS pct_with_salary,
   count(*) FILTER (WHERE salary_min_final > salary_max_final) AS inverted_ranges,
   count(*) FILTER (WHERE salary_avg_final > 1000000) AS over_1m,
   count(*) FILTER (WHERE salary_avg_final < 20000 AND salary_avg_final IS NOT NULL) AS under_20k,
   count(*) FILTER (WHERE job_id = '') AS empty_job_ids,
   count(*) - count(DISTINCT job_id) AS duplicate_pks,
   CASE WHEN count(*) = count(DISTINCT job_id) THEN 'PASS' ELSE 'FAIL' END AS pk_status
 FROM stg""")
def q_dq_report(spark, sf):
    return quality.dq_report(star_for(spark, sf).stg, O.AS_OF)


# ---------------------------------------------------------------- skills


@register("match_skills", "W27", O.with_ctes(*O.CHAIN_SKILLS) + " SELECT job_posting_id, skill_id FROM bridge")
def q_match_skills(spark, sf):
    return star_for(spark, sf).bridge


@register("match_skills_vocabulary", "W27", O.with_ctes(*O.CHAIN_SKILLS) + " SELECT job_posting_id, skill_id FROM bridge")
def q_match_skills_vocabulary(spark, sf):
    s = star_for(spark, sf)
    return skills.bridge_from_vocabulary(s.fact, s.stg, s.dim_skill)


@register("skill_category_counts", "W26+W28", O.with_ctes(*O.CHAIN_SKILLS) + """
 SELECT d.skill_category, count(*) AS cnt,
   count(*) FILTER (WHERE d.skill_id IN (SELECT skill_id FROM bridge)) AS skills_matched
 FROM dim_skill d GROUP BY d.skill_category""")
def q_skill_category_counts(spark, sf):
    s = star_for(spark, sf)
    return skills.skill_category_counts(s.dim_skill, s.bridge)


@register("bridge_summary", "W29", O.with_ctes(*O.CHAIN_SKILLS) + """
 SELECT 'bridge summary' AS check_name, count(*) AS total_links,
   count(DISTINCT job_posting_id) AS jobs_with_skills, count(DISTINCT skill_id) AS skills_matched,
   CAST(round(CAST(count(*) AS DECIMAL(20,0)) / nullif(count(DISTINCT job_posting_id), 0), 2) AS DOUBLE)
     AS avg_skills_per_job FROM bridge""")
def q_bridge_summary(spark, sf):
    return skills.bridge_summary(star_for(spark, sf).bridge)


# Per posting: whether any skill was found in it.
_TAGGED = """
 , tagged AS (SELECT f.job_id, EXISTS (SELECT 1 FROM bridge b WHERE b.job_posting_id = f.job_posting_id) AS has_skill FROM fact f)"""


@register("skill_coverage", "W30", O.with_ctes(*O.CHAIN_SKILLS) + _TAGGED + """
 SELECT 'skill coverage' AS check_name, count(*) AS total_jobs, count(*) FILTER (WHERE has_skill) AS jobs_with_skill,
   CAST(round(100.0 * count(*) FILTER (WHERE has_skill) / count(*), 1) AS DOUBLE) AS pct_coverage FROM tagged""")
def q_skill_coverage(spark, sf):
    s = star_for(spark, sf)
    return skills.skill_coverage(s.fact, s.bridge)


@register("top_skills", "W31", O.with_ctes(*O.CHAIN_SKILLS) + """
 , demand AS (SELECT skill_id, count(*) AS n FROM bridge GROUP BY skill_id),
 size AS (SELECT count(*) AS jobs FROM fact)
 SELECT skill_name, skill_category, n AS demand_count, CAST(round(100.0 * n / jobs, 1) AS DOUBLE) AS pct_of_jobs
 FROM demand JOIN dim_skill USING (skill_id), size""")
def q_top_skills(spark, sf):
    s = star_for(spark, sf)
    return skills.top_skills(s.bridge, s.dim_skill, s.fact)


@register("skill_limitation", "W32", O.with_ctes(*O.CHAIN_SKILLS) + _TAGGED + """
 SELECT 'skill extraction limitation' AS check_name, count(*) AS total_jobs,
   CAST(round(avg(description_length), 0) AS DOUBLE) AS avg_desc_length,
   count(*) FILTER (WHERE regexp_matches(description_clean, '…|[.][.][.]')) AS truncated_descriptions,
   count(*) FILTER (WHERE has_skill) AS jobs_with_skill,
   CAST(round(100.0 * count(*) FILTER (WHERE has_skill) / count(*), 1) AS DOUBLE) AS pct_coverage,
   'API truncation at 500 chars limits coverage' AS interpretation
 FROM stg JOIN tagged USING (job_id)""")
def q_skill_limitation(spark, sf):
    s = star_for(spark, sf)
    return skills.skill_limitation(s.stg, s.bridge)


@register("match_part_names", "W27", O.with_ctes(*O.CHAIN_STG) + """
 , names AS (SELECT p_partkey, p_name, lower(p_name) AS low FROM part WHERE p_name IS NOT NULL),
 texts AS (SELECT job_id, description_clean, lower(description_clean) AS low FROM stg WHERE description_clean IS NOT NULL)
 SELECT t.job_id, n.p_partkey FROM texts t JOIN names n ON contains(t.low, n.low)
 WHERE regexp_matches(t.low, '(^|[^a-z0-9])' || regexp_escape(n.low) || '([^a-z0-9]|$)')""")
def q_match_part_names(spark, sf):
    """Every part name, thousands of them, as the dictionary of the descriptions."""
    parts = Tables(spark, sf).part.select("p_partkey", "p_name")
    return match_dictionary(star_for(spark, sf).stg, "job_id", "description_clean", parts, "p_partkey", "p_name")


# ---------------------------------------------------------------- events and documents (direct inputs)


WS_SQL = O.WHITESPACE_CLASS


@register("shred_events_json", "W5", """
 SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_shred_events_json(spark, sf):
    ev = Tables(spark, sf).events
    return ev.select("event_id", F.from_json("props", "k string")["k"].try_cast("int").alias("k"))


@register("events_latest", "W3", """
 SELECT user_id, event_id, ts, event_type FROM (
   SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
 WHERE rn = 1""")
def q_events_latest(spark, sf):
    ev = Tables(spark, sf).events
    return staging.dedup_latest(ev, "user_id", ("ts", "event_id")).select("user_id", "event_id", "ts", "event_type")


@register("events_context", "W4", """
 SELECT user_id, CAST(to_json(list_sort(list_distinct(list(event_type)))) AS VARCHAR) AS event_types,
   CAST(count(DISTINCT event_type) AS INTEGER) AS event_type_count, min(ts) AS first_ts, max(ts) AS last_ts
 FROM events GROUP BY user_id""")
def q_events_context(spark, sf):
    return staging.search_context(Tables(spark, sf).events, "user_id", "event_type", "ts", "event_type")


@register("clean_documents", "W6", f"""
 SELECT doc_id, trim(regexp_replace(text, '{WS_SQL}+', ' ', 'g')) AS text_clean,
   CAST(length(text) AS INTEGER) AS raw_length,
   CAST(length(trim(regexp_replace(text, '{WS_SQL}+', ' ', 'g'))) AS INTEGER) AS clean_length
 FROM documents""")
def q_clean_documents(spark, sf):
    d = Tables(spark, sf).documents
    clean = collapse_whitespace(F.col("text"))
    return d.select("doc_id", clean.alias("text_clean"), F.char_length("text").alias("raw_length"),
                    F.char_length(clean).alias("clean_length"))


def _clean_docs(spark, sf):
    return Tables(spark, sf).documents.select("doc_id", collapse_whitespace(F.col("text")).alias("text_clean"))


# Terms that occur in the documents: common words of their four languages, spellings in
# several forms, parts of the license line, and near-misses.
DOCUMENT_TERMS = [
    ("license", "Legal", "Apache License"), ("license", "Legal", "Licensed under"), ("version", "Legal", "2.0"),
    ("english", "Language", "of the"), ("english", "Language", "that"), ("german", "Language", "und"),
    ("german", "Language", "in die"), ("french", "Language", "dans"), ("spanish", "Language", "para"),
    ("spanish", "Language", "de la"), ("token", "Security", "token"), ("mail", "Contact", "example.com"),
    ("insult", "Tone", "idiot"), ("insult", "Tone", "worthless"), ("rare", "None", "no such phrase"),
]
_TERM_ROWS = ", ".join(f"('{n}', '{c}', '{O.whole_word(p)}', '{p.lower()}')" for n, c, p in DOCUMENT_TERMS)

DOCS_SKILLS_SQL = O.with_ctes(f"""
skill_defs(skill_name, skill_category, pattern, literal) AS (VALUES {_TERM_ROWS})""", f"""
docs AS (SELECT doc_id, trim(regexp_replace(text, '{WS_SQL}+', ' ', 'g')) AS text_clean FROM documents),
doc_skills AS (SELECT DISTINCT d.doc_id, sd.skill_name FROM docs d CROSS JOIN skill_defs sd
               WHERE d.text_clean IS NOT NULL AND contains(lower(d.text_clean), sd.literal)
                 AND regexp_matches(d.text_clean, sd.pattern))""")


@register("match_skills_documents", "W27", DOCS_SKILLS_SQL + " SELECT doc_id, skill_name FROM doc_skills")
def q_match_skills_documents(spark, sf):
    return skills.match_skills(_clean_docs(spark, sf), "doc_id", "text_clean", DOCUMENT_TERMS)


@register("match_vocabulary_documents", "W27", DOCS_SKILLS_SQL + " SELECT doc_id, skill_name FROM doc_skills")
def q_match_vocabulary_documents(spark, sf):
    terms = skills.dim_skill(spark, DOCUMENT_TERMS)
    hits = skills.match_vocabulary(_clean_docs(spark, sf), "doc_id", "text_clean", terms)
    return hits.join(terms.select("skill_id", "skill_name"), "skill_id").select("doc_id", "skill_name")


@register("match_dictionary_documents", "W27", DOCS_SKILLS_SQL + " SELECT doc_id, skill_name FROM doc_skills")
def q_match_dictionary_documents(spark, sf):
    terms = spark.createDataFrame([(n, p) for n, _, p in DOCUMENT_TERMS], "skill_name string, literal string")
    return match_dictionary(_clean_docs(spark, sf), "doc_id", "text_clean", terms, "skill_name").distinct()


@register("document_profile", "W24+W32", DOCS_SKILLS_SQL + """
 SELECT count(*) AS total_docs, CAST(round(avg(length(text_clean)), 0) AS DOUBLE) AS avg_length,
   count(*) FILTER (WHERE contains(text_clean, '$')) AS with_dollar,
   count(*) FILTER (WHERE contains(text_clean, '…') OR contains(text_clean, '...')) AS truncated,
   (SELECT count(DISTINCT doc_id) FROM doc_skills) AS docs_with_skill
 FROM docs""")
def q_document_profile(spark, sf):
    docs = _clean_docs(spark, sf)
    c = F.col("text_clean")
    base = docs.agg(F.count(F.lit(1)).alias("total_docs"),
                    F.round(F.avg(F.char_length(c)), 0).cast("double").alias("avg_length"),
                    F.count_if(contains_text(c, "$")).alias("with_dollar"),
                    F.count_if(contains_text(c, "…") | contains_text(c, "...")).alias("truncated"))
    hit = (skills.match_skills(docs, "doc_id", "text_clean", DOCUMENT_TERMS).select("doc_id").distinct()
           .agg(F.count(F.lit(1)).alias("docs_with_skill")))
    return base.transform(with_totals, hit)


# ---------------------------------------------------------------- landing, conforming, copies, stream

LANDED_COLS = [c for c in RAW_COLS if c != "id"]


def _feed_sql_cols() -> str:
    return ("job_id, search_term, fetched_at, title, company_name, location_display, category_tag, "
            "contract_type, contract_time, salary_min, salary_max, salary_is_predicted, latitude, longitude, "
            "try_strptime(created, '%Y-%m-%dT%H:%M:%SZ') AS created_at")


@register("read_feed", "W1", O.with_ctes(O.FEED, O.PAYLOAD) + f" SELECT {_feed_sql_cols()}, raw_data FROM payload")
def q_read_feed(spark, sf):
    path = scratch_path(spark, "landing")
    landing.land_rows(feed_rows(Tables(spark, sf)), path)
    return landing.read_feed(spark, path).select(*LANDED_COLS, "raw_data")


CONFORM_SPLIT = "1997-01-01"


@register("conform_raw", "W33", O.with_ctes(*O.CHAIN_RAW) + f"""
 SELECT id, job_id, search_term, fetched_at, title, company_name, location_display, category_tag,
   contract_type, contract_time, salary_min, salary_max,
   CASE WHEN fetched_at < TIMESTAMP '{CONFORM_SPLIT}' THEN 0 ELSE salary_is_predicted END AS salary_is_predicted,
   CASE WHEN fetched_at < TIMESTAMP '{CONFORM_SPLIT}' THEN NULL ELSE latitude END AS latitude,
   CASE WHEN fetched_at < TIMESTAMP '{CONFORM_SPLIT}' THEN NULL ELSE longitude END AS longitude,
   created_at FROM raw""")
def q_conform_raw(spark, sf):
    raw = star_for(spark, sf).raw
    old = F.col("fetched_at") < F.lit(CONFORM_SPLIT).cast("timestamp_ntz")
    v1, v2 = scratch_path(spark, "raw-v1"), scratch_path(spark, "raw-v2")
    # An older layout: no coordinates / prediction flag, salary_min stored as text.
    (raw.where(old).drop("latitude", "longitude", "salary_is_predicted")
        .withColumn("salary_min", F.col("salary_min").cast("string")).write.parquet(v1))
    raw.where(~old).write.parquet(v2)
    return landing.read_conformed(spark, [v1, v2], landing.RAW_SCHEMA,
                                  {"salary_is_predicted": 0}).select(*RAW_COLS)


@register("copy_to_bronze", "W34", O.with_ctes(*O.CHAIN_RAW) + """
 SELECT 'raw_jobs' AS tbl, count(*) AS source_rows, count(*) AS copied_rows, 'MATCH' AS status FROM raw""")
def q_copy_to_bronze(spark, sf):
    return landing.copy_table(star_for(spark, sf).raw, scratch_path(spark, "bronze"), "raw_jobs")


@register("copy_check_damaged", "W34", O.with_ctes(*O.CHAIN_RAW) + """
 SELECT 'whole' AS tbl, count(*) AS source_rows, count(*) AS copied_rows, 'MATCH' AS status FROM raw
 UNION ALL SELECT 'changed', count(*), count(*), CASE WHEN count(title) = 0 THEN 'MATCH' ELSE 'MISMATCH' END FROM raw
 UNION ALL SELECT 'short', count(*), count(*) FILTER (WHERE id % 97 <> 0),
   CASE WHEN count(*) FILTER (WHERE id % 97 = 0) = 0 THEN 'MATCH' ELSE 'MISMATCH' END FROM raw""")
def q_copy_check_damaged(spark, sf):
    """A whole copy, one of as many rows with one title changed, and one that lacks rows."""
    raw = star_for(spark, sf).raw
    first = raw.where("title IS NOT NULL").agg(F.min("id").alias("_first"))
    changed = raw.transform(with_totals, first).withColumn(
        "title", F.when(F.col("id") == F.col("_first"), F.concat("title", F.lit("!"))).otherwise(F.col("title"))).drop("_first")
    # The whole copy lies otherwise; it is dealt and looked at in slices, so that not all payloads are exchanged at once.
    slices = stored_slices(raw, slices_of(raw.count()))
    whole = landing.fingerprint_check(parity.table_fingerprint(raw), parity.added_fingerprints([s.repartition(3) for s in slices]), "whole")
    return _union([whole, *[landing.copy_check(raw, copy, name) for name, copy in (
        ("changed", changed), ("short", raw.where("id % 97 <> 0")))]])


PARITY_TABLES = ["stg_jobs", "dim_company", "dim_location", "dim_date", "dim_category", "dim_skill",
                 "fact_job_postings", "bridge_job_skills"]


def _star_tables(s: Star) -> dict[str, DataFrame]:
    return {"stg_jobs": s.stg.drop("transformed_at"), "dim_company": s.dim_company,
            "dim_location": s.dim_location, "dim_date": s.dim_date, "dim_category": s.dim_category,
            "dim_skill": s.dim_skill, "fact_job_postings": s.fact, "bridge_job_skills": s.bridge}


@register("parity_check", "W35", O.with_ctes(*O.CHAIN_SKILLS) + " " + " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, count(*) AS rows_a, count(*) AS rows_b, true AS rows_match, true AS content_match "
    f"FROM {src}" for t, src in zip(PARITY_TABLES, ["stg", "dim_company", "dim_location", "dim_date",
                                                    "dim_category", "dim_skill", "fact", "bridge"])))
def q_parity_check(spark, sf):
    a = star_for(spark, sf)
    # The copy is laid out by job as well: its staging exchanges no payload.
    buckets = bucket_count(a.raw.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    copy = store_slices([a.raw], "raw-copy", ["job_id"], buckets, compression="zstd")
    b = Star(spark, raw=copy)
    path = stored_path(copy) if copy.inputFiles() else None
    b.stg  # noqa: B018 - written, and the last that needs the copy
    if path:
        delete(spark, path)
    return parity.parity_check(_star_tables(a), _star_tables(b))


@register("parity_differences", "W35", O.with_ctes(*O.CHAIN_STG) + """
 , a AS (SELECT job_id, salary_min_final, salary_max_final FROM stg),
 b AS (SELECT job_id, CASE WHEN moved THEN salary_max_final ELSE salary_min_final END AS salary_min_final,
              CASE WHEN moved THEN salary_min_final ELSE salary_max_final END AS salary_max_final
       FROM (SELECT *, salary_min_final IS NULL AND salary_max_final IS NOT NULL AS moved FROM stg)),
 gone AS (SELECT * FROM b WHERE job_id NOT LIKE '%7')
 SELECT 'moved' AS build, 'only_a' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
 UNION ALL SELECT 'moved', 'only_b', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
 UNION ALL SELECT 'gone', 'only_a', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM gone)""")
def q_parity_differences(spark, sf):
    """Builds that differ: a value that stands in the next column, and rows that are missing."""
    a, b, gone = _differing_builds(star_for(spark, sf))
    return (parity.locate_differences(a, b).withColumn("build", F.lit("moved"))
            .unionByName(parity.locate_differences(b, gone).withColumn("build", F.lit("gone"))))


@register("parity_differences_by_leaf", "W35", O.with_ctes(*O.CHAIN_STG) + """
 , a AS (SELECT job_id, salary_min_final, salary_max_final FROM stg),
 b AS (SELECT job_id, CASE WHEN job_id = (SELECT min(job_id) FROM stg WHERE salary_min_final IS NOT NULL)
   THEN salary_min_final + 1 ELSE salary_min_final END AS salary_min_final, salary_max_final FROM stg)
 SELECT 'only_a' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
 UNION ALL SELECT 'only_b', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def q_parity_differences_by_leaf(spark, sf):
    """Builds that differ in one row: one leaf of each is read."""
    stg = star_for(spark, sf).stg.select("job_id", "salary_min_final", "salary_max_final")
    first = stg.where("salary_min_final IS NOT NULL").agg(F.min("job_id").alias("_first"))
    moved = stg.transform(with_totals, first).withColumn("salary_min_final", F.when(
        F.col("job_id") == F.col("_first"), F.col("salary_min_final") + 1).otherwise(F.col("salary_min_final"))
        .cast(stg.schema["salary_min_final"].dataType)).drop("_first")
    a, b = (parity.store_leaves(df, ["job_id"], 64, name) for df, name in ((stg, "leaves-a"), (moved, "leaves-b")))
    return parity.locate_differences_in_leaves(a, b)


def _differing_builds(s: Star) -> tuple[DataFrame, DataFrame, DataFrame]:
    lo, hi = F.col("salary_min_final"), F.col("salary_max_final")
    a = s.stg.select("job_id", lo, hi)
    moved = lo.isNull() & hi.isNotNull()
    b = a.select("job_id", F.when(moved, hi).otherwise(lo).alias("salary_min_final"),
                 F.when(moved, lo).otherwise(hi).alias("salary_max_final"))
    return a, b, b.where(~F.col("job_id").endswith("7"))


@register("parity_check_differing", "W35", O.with_ctes(*O.CHAIN_STG) + """
 SELECT 'moved' AS tbl, count(*) AS rows_a, count(*) AS rows_b, true AS rows_match,
   count(*) FILTER (WHERE salary_min_final IS NULL AND salary_max_final IS NOT NULL) = 0 AS content_match FROM stg
 UNION ALL SELECT 'gone', count(*), count(*) FILTER (WHERE job_id NOT LIKE '%7'),
   count(*) FILTER (WHERE job_id LIKE '%7') = 0, count(*) FILTER (WHERE job_id LIKE '%7') = 0 FROM stg
 UNION ALL SELECT 'same', count(*), count(*), true, true FROM stg""")
def q_parity_check_differing(spark, sf):
    a, b, gone = _differing_builds(star_for(spark, sf))
    return parity.parity_check({"moved": a, "gone": b, "same": a}, {"moved": b, "gone": gone, "same": a.repartition(3)})


@register("ingest_incremental", "W36", O.with_ctes(*O.CHAIN_RAW) +
          f" SELECT {_cols_sql(LANDED_COLS)}, title AS raw_title FROM raw")
def q_ingest_incremental(spark, sf):
    pages = landing.pages_from_rows(feed_rows(Tables(spark, sf)), dealt=True)
    pages_root = scratch_path(spark, "landing-stream")
    # One drop; the files of a (term, page) hold its fetches in order.
    landing.land_pages(pages, f"{pages_root}/drop", compression="gzip", dealt=True)
    raw = ingest_incremental(spark, f"{pages_root}/drop", scratch_path(spark, "raw-table"),
                             scratch_path(spark, "stream-ckpt"))
    return raw.select(*LANDED_COLS, F.get_json_object("raw_data", "$.title").alias("raw_title"))


SMALL_DROPS = 5
PAGE_COLS = ["id", "job_id", "search_term", "fetched_at", "raw_data"]


@register("ingest_many_small_drops", "W2+W36", O.with_ctes(O.FEED, O.PAYLOAD, f"""
 sent AS (
   SELECT CASE WHEN search_term = 'term_1' AND j % 100 < {SMALL_DROPS} THEN 1 + j % 100 ELSE 0 END AS drop_no, *
   FROM (SELECT *, CAST(job_id AS BIGINT) AS j FROM payload)
   UNION ALL
   SELECT j % 100 - 49, * REPLACE ('{{"resent":' || (j % 100 - 49) || ',' || raw_data[2:] AS raw_data)
   FROM (SELECT *, CAST(job_id AS BIGINT) AS j FROM payload)
   WHERE search_term = 'term_2' AND j % 100 BETWEEN 50 AND 49 + {SMALL_DROPS}),
 arrived AS (
   SELECT *, {{'d': drop_no, 'f': fetched_at, 'p': j // 50, 's': row_number() OVER (
     PARTITION BY drop_no, search_term, fetched_at, j // 50 ORDER BY id, raw_data)}} AS came FROM sent),
 kept AS (
   SELECT job_id, search_term, min(came) AS first_came, max_by(raw_data, came) AS raw_data, max_by(title, came) AS title,
          max_by(fetched_at, came) AS fetched_at FROM arrived GROUP BY job_id, search_term)""") + """
 SELECT row_number() OVER (ORDER BY first_came, job_id, search_term) AS id, job_id, search_term, fetched_at, title, raw_data
 FROM kept""")
def q_ingest_many_small_drops(spark, sf):
    """A first drop with most rows, then drops of new keys and of keys sent again with other payloads."""
    feed = materialize(feed_rows(Tables(spark, sf)).select(*PAGE_COLS), "landed", compression="zstd")  # pages hold no flat columns
    job = F.col("job_id").cast("long")
    fresh = F.when((F.col("search_term") == "term_1") & (job % 100 < SMALL_DROPS), 1 + job % 100).otherwise(0)
    again = feed.where((F.col("search_term") == "term_2") & (job % 100).between(50, 49 + SMALL_DROPS)).withColumns({
        "drop_no": job % 100 - 49,
        "raw_data": F.concat(F.lit('{"resent":'), (job % 100 - 49).cast("string"), F.lit(","), F.expr("substring(raw_data, 2)"))})
    sent = feed.withColumn("drop_no", fresh).unionByName(again)
    table = scratch_path(spark, "raw-drops")
    for d in range(1 + SMALL_DROPS):
        landed = scratch_path(spark, "drop")
        pages = materialize(landing.pages_from_rows(sent.where(F.col("drop_no") == d)), "pages", landed, "zstd").withColumns({
            "_corrupt": F.lit(None).cast("string"), "modified": F.lit(f"2026-01-0{1 + d} 00:00:00").cast("timestamp"),
            "file": F.lit(f"drop-{d}")})
        apply_batch(spark, pages, table, "drops", d, buckets=8, split_bytes=1 << 20)
        delete(spark, landed)
    return read_version(spark, table).select("id", "job_id", "search_term", "fetched_at", "title", "raw_data")


REPORT_DROPS = 3


@register("reports_after_drops", "W36+R1+R5+R11", O.with_ctes(O.FEED, f"""
 sent AS (
   SELECT CASE WHEN j % 10 = 1 AND search_term = 'term_1' THEN 1 WHEN j % 10 = 2 THEN 2 ELSE 0 END AS drop_no, *
   FROM (SELECT *, CAST(job_id AS BIGINT) AS j FROM feed)
   UNION ALL
   SELECT 1, * REPLACE (NULL AS area, regexp_replace(created, '^199[0-9]', '1999') AS created)
   FROM (SELECT *, CAST(job_id AS BIGINT) AS j FROM feed) WHERE j % 10 = 3
   UNION ALL
   SELECT 2, * FROM (SELECT *, CAST(job_id AS BIGINT) AS j FROM feed) WHERE j % 10 = 3 AND search_term = 'term_2'),
 arrived AS (
   SELECT *, {{'d': drop_no, 'f': fetched_at, 'p': j // 50, 's': row_number() OVER (
     PARTITION BY drop_no, search_term, fetched_at, j // 50 ORDER BY id)}} AS came FROM sent),
 snap AS (
   SELECT d AS drop_no, job_id, search_term, min(came) AS first_came,
          max_by({{'f': fetched_at, 'area': area, 'tag': category_tag, 'label': category_label, 'created': created}}, came) AS v
   FROM arrived JOIN (SELECT unnest(range({REPORT_DROPS})) AS d) ON arrived.drop_no <= d GROUP BY d, job_id, search_term),
 posting AS (
   SELECT drop_no, job_id, max_by(v, {{'f': v.f, 'c': first_came, 't': search_term}}) AS v FROM snap GROUP BY drop_no, job_id),
 facet AS (
   SELECT drop_no, CAST(try_strptime(v.created, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS day, v.area[4] AS city,
          CASE WHEN v.tag IS NOT NULL THEN v.label END AS label FROM posting),
 line AS (
   SELECT drop_no, 'city' AS report, coalesce(city, 'Unknown') AS item FROM facet
   UNION ALL SELECT drop_no, 'day', CAST(day AS VARCHAR) FROM facet WHERE day IS NOT NULL
   UNION ALL SELECT drop_no, 'category', coalesce(label, 'Unknown') FROM facet)""") + """
 SELECT CAST(drop_no AS INTEGER) AS drop_no, report, item, count(*) AS postings, CASE WHEN report <> 'day' THEN
   CAST(round(100.0 * count(*) / (SELECT count(*) FROM facet f WHERE f.drop_no = line.drop_no), 1) AS DOUBLE) END AS pct
 FROM line GROUP BY drop_no, report, item""")
def q_reports_after_drops(spark, sf):
    """Three drops (new terms, new jobs, jobs sent again that move and come back); the kept reports after each."""
    feed = materialize(feed_rows(Tables(spark, sf)).select(*PAGE_COLS), "landed", compression="zstd")  # pages hold no flat columns
    j = F.col("job_id").cast("long") % 10
    first = F.when((j == 1) & (F.col("search_term") == "term_1"), 1).when(j == 2, 2).otherwise(0)
    moved = F.regexp_replace(F.regexp_replace("raw_data", r'"location":\{[^}]*\},', ""), '"created":"199[0-9]', '"created":"1999')
    sent = (feed.withColumn("drop_no", first)
            .unionByName(feed.where(j == 3).withColumns({"drop_no": F.lit(1), "raw_data": moved}))
            .unionByName(feed.where((j == 3) & (F.col("search_term") == "term_2")).withColumn("drop_no", F.lit(2))))
    table = scratch_path(spark, "raw-followed")
    kept = KeptReports(spark, scratch_path(spark, "kept-reports"), buckets=8, keep_versions=REPORT_DROPS)
    for d in range(REPORT_DROPS):
        landed = scratch_path(spark, "drop")
        pages = materialize(landing.pages_from_rows(sent.where(F.col("drop_no") == d)), "pages", landed, "zstd").withColumns({
            "_corrupt": F.lit(None).cast("string"), "modified": F.lit(f"2026-01-0{1 + d} 00:00:00").cast("timestamp"),
            "file": F.lit(f"drop-{d}")})
        apply_batch(spark, pages, table, "drops", d, buckets=8, follow=kept.follow)
        delete(spark, landed)
    out = None
    for d in range(REPORT_DROPS):
        for report, rows in (("city", kept.postings_by_location("city", 2**31 - 1, version=d).withColumnRenamed("location", "item")),
                             ("day", kept.daily_trend(version=d).select(F.col("full_date").cast("string").alias("item"), "postings",
                                                                        F.lit(None).cast("double").alias("pct"))),
                             ("category", kept.category_share(version=d).withColumnRenamed("category", "item"))):
            lines = rows.select(F.lit(d).alias("drop_no"), F.lit(report).alias("report"), "item", "postings", "pct")
            out = lines if out is None else out.unionByName(lines)
    return out


# The stored star's tables, the SQL's name of each, and the columns declared not null.
LISTED = {"stg_jobs": "stg", "dim_company": "dim_company", "dim_location": "dim_location", "dim_date": "dim_date",
          "dim_category": "dim_category", "fact_job_postings": "fact", "bridge_job_skills": "bridge"}
LISTED_TYPES = {
    "stg_jobs": {"job_id": "string!", "latitude": "decimal(10,6)", "salary_is_predicted": "int", "salary_avg_final": "decimal(12,2)",
                 "description_length": "int", "posted_date": "date", "posted_at": "timestamp_ntz", "search_term_count": "int"},
    "dim_company": {"company_id": "bigint!", "company_name": "string!", "company_normalized": "string!"},
    "dim_location": {"location_id": "bigint!", "state": "string", "suburb": "string", "location_key": "string!"},
    "dim_date": {"date_id": "int!", "full_date": "date!", "is_weekend": "int!"},
    "dim_category": {"category_id": "bigint!", "category_tag": "string!", "category_label": "string"},
    "fact_job_postings": {"job_posting_id": "bigint!", "job_id": "string!", "company_id": "bigint", "location_id": "bigint",
                          "date_id": "int", "category_id": "bigint", "salary_avg": "decimal(12,2)", "has_salary": "int!"},
    "bridge_job_skills": {"job_posting_id": "bigint!", "skill_id": "bigint!"},
}


@register("schema_listing", "2.2", O.with_ctes(*O.CHAIN_SKILLS) + " " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k.rstrip('!')}' AS declared_type, '{k.rstrip('!')}' AS stored_type, "
    f"{str(not k.endswith('!')).lower()} AS is_nullable, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, 'ok' AS status FROM {LISTED[t]}"
    for t, columns in LISTED_TYPES.items() for c, k in columns.items()))
def q_schema_listing(spark, sf):
    """The catalogue of the stored star (of staging the typed columns that tell most)."""
    s = star_for(spark, sf)
    listed = schema_listing({t: df for t, df in (_star_tables(s) | {"stg_jobs": s.stg}).items() if t in LISTED})
    picked = [(t, c) for t, columns in LISTED_TYPES.items() for c in columns]
    return (listed.where(F.concat_ws(".", "table_name", "column_name").isin([f"{t}.{c}" for t, c in picked]))
            .select("table_name", "column_name", "declared_type", "stored_type", "is_nullable", "n_rows", "n_nulls", "status"))


# ---------------------------------------------------------------- reports

WIN_FROM, WIN_TO = "1996-01-01", "1997-12-31"
PROBE_DAY, PROBE_YEAR = "1998-06-01", 1998
TOP_N = 10


def _pct_sql(num: str, den: str) -> str:
    return f"CAST(round(100.0 * {num} / {den}, 1) AS DOUBLE)"


STAR_SQL = O.with_ctes(*O.CHAIN_STAR)
SKILL_SQL = O.with_ctes(*O.CHAIN_SKILLS)
FACTS = "(SELECT count(*) FROM fact)"


@register("postings_by_city", "R1", STAR_SQL + f"""
 SELECT 'city' AS level, coalesce(dl.city, 'Unknown') AS location, count(*) AS postings,
   {_pct_sql('count(*)', FACTS)} AS pct
 FROM fact f LEFT JOIN dim_location dl ON f.location_id = dl.location_id
 GROUP BY coalesce(dl.city, 'Unknown') ORDER BY postings DESC, location LIMIT {TOP_N}""")
def q_postings_by_city(spark, sf):
    return R.postings_by_location(star_for(spark, sf), "city", TOP_N)


@register("postings_by_city_in_window", "R1", STAR_SQL + f"""
 , w AS (SELECT location_id FROM fact WHERE date_id BETWEEN {WIN_FROM.replace('-', '')} AND {WIN_TO.replace('-', '')})
 SELECT 'city' AS level, coalesce(dl.city, 'Unknown') AS location, count(*) AS postings,
   {_pct_sql('count(*)', '(SELECT count(*) FROM w)')} AS pct
 FROM w LEFT JOIN dim_location dl USING (location_id)
 GROUP BY coalesce(dl.city, 'Unknown') ORDER BY postings DESC, location LIMIT {TOP_N}""")
def q_postings_by_city_in_window(spark, sf):
    return R.postings_by_location(star_for(spark, sf), "city", TOP_N, WIN_FROM, WIN_TO)


@register("postings_by_company", "R2", STAR_SQL + f"""
 SELECT dc.company_name, count(*) AS postings, {_pct_sql('count(*)', FACTS)} AS pct
 FROM fact f JOIN dim_company dc ON f.company_id = dc.company_id
 GROUP BY dc.company_id, dc.company_name ORDER BY postings DESC, company_name LIMIT {TOP_N}""")
def q_postings_by_company(spark, sf):
    return R.postings_by_company(star_for(spark, sf), TOP_N)


@register("salary_stats", "R3", STAR_SQL + f"""
 SELECT count(salary_avg) AS n, CAST(round(avg(salary_avg), 0) AS DOUBLE) AS mean_salary,
   round(quantile_cont(CAST(salary_avg AS DOUBLE), 0.5), 0) AS median_salary,
   {_pct_sql('count(salary_avg)', 'count(*)')} AS pct_with_salary FROM fact""")
def q_salary_stats(spark, sf):
    return R.salary_stats(star_for(spark, sf))


def _band_sql() -> str:
    edges = R.SALARY_BAND_EDGES
    lower = "CASE " + " ".join(f"WHEN salary_avg >= {e} THEN {e}" for e in reversed(edges)) + " END"
    names = []
    for i, e in enumerate(edges):
        n = f"{e // 1000}K+" if i == len(edges) - 1 else f"{e // 1000}-{edges[i + 1] // 1000}K"
        names.append(f"WHEN {e} THEN '{n}'")
    return lower, "CASE band_lower " + " ".join(names) + " END"


_LOWER_SQL, _LABEL_SQL = _band_sql()


@register("salary_histogram", "R4", STAR_SQL + f"""
 , b AS (SELECT CAST({_LOWER_SQL} AS INTEGER) AS band_lower FROM fact WHERE salary_avg IS NOT NULL)
 SELECT {_LABEL_SQL} AS band, band_lower, count(*) AS postings,
   {_pct_sql('count(*)', '(SELECT count(*) FROM b)')} AS pct FROM b GROUP BY band_lower""")
def q_salary_histogram(spark, sf):
    return R.salary_histogram(star_for(spark, sf))


@register("daily_trend", "R5", STAR_SQL + """
 SELECT dd.full_date, count(*) AS postings FROM fact f JOIN dim_date dd ON f.date_id = dd.date_id
 GROUP BY dd.full_date""")
def q_daily_trend(spark, sf):
    return R.daily_trend(star_for(spark, sf))


@register("monthly_profile", "R6", STAR_SQL + """
 SELECT dd.year, dd.month, count(DISTINCT dd.date_id) AS active_days, count(*) AS postings
 FROM fact f JOIN dim_date dd ON f.date_id = dd.date_id GROUP BY dd.year, dd.month""")
def q_monthly_profile(spark, sf):
    return R.monthly_profile(star_for(spark, sf))


@register("analysis_window", "R7", STAR_SQL + f"""
 SELECT min(dd.full_date) AS first_date, max(dd.full_date) AS last_date,
   count(DISTINCT f.date_id) AS active_days, count(*) AS postings,
   count(DISTINCT f.company_id) AS distinct_companies
 FROM fact f JOIN dim_date dd ON f.date_id = dd.date_id
 WHERE dd.full_date BETWEEN DATE '{WIN_FROM}' AND DATE '{WIN_TO}'""")
def q_analysis_window(spark, sf):
    return R.analysis_window(star_for(spark, sf), WIN_FROM, WIN_TO)


@register("filter_probe", "R8", STAR_SQL + f"""
 SELECT count(*) AS no_filter,
   count(*) FILTER (WHERE dd.full_date <= DATE '{PROBE_DAY}') AS on_or_before,
   count(*) FILTER (WHERE dd.full_date >= DATE '{PROBE_DAY}') AS on_or_after,
   count(*) FILTER (WHERE dd.year = {PROBE_YEAR}) AS in_year
 FROM fact f LEFT JOIN dim_date dd ON f.date_id = dd.date_id""")
def q_filter_probe(spark, sf):
    return R.filter_probe(star_for(spark, sf), PROBE_DAY, PROBE_YEAR)


@register("top_skills_in_window", "R9", SKILL_SQL + f"""
 , wf AS (SELECT f.job_posting_id FROM fact f JOIN dim_date dd ON f.date_id = dd.date_id
          WHERE dd.full_date BETWEEN DATE '{WIN_FROM}' AND DATE '{WIN_TO}')
 SELECT ds.skill_name, ds.skill_category, count(*) AS demand_count,
   {_pct_sql('count(*)', '(SELECT count(*) FROM wf)')} AS pct_of_jobs
 FROM bridge b JOIN wf ON b.job_posting_id = wf.job_posting_id JOIN dim_skill ds ON ds.skill_id = b.skill_id
 GROUP BY ds.skill_id, ds.skill_name, ds.skill_category HAVING count(*) >= 5""")
def q_top_skills_in_window(spark, sf):
    return R.top_skills_in_window(star_for(spark, sf), WIN_FROM, WIN_TO, 5)


@register("skill_category_rollup", "R10", SKILL_SQL + """
 SELECT ds.skill_category, count(*) AS mentions, count(DISTINCT b.job_posting_id) AS jobs
 FROM bridge b JOIN dim_skill ds ON b.skill_id = ds.skill_id GROUP BY ds.skill_category""")
def q_skill_category_rollup(spark, sf):
    return R.skill_category_rollup(star_for(spark, sf))


@register("category_share", "R11", STAR_SQL + f"""
 SELECT coalesce(dc.category_label, 'Unknown') AS category, count(*) AS postings,
   {_pct_sql('count(*)', FACTS)} AS pct
 FROM fact f LEFT JOIN dim_category dc ON f.category_id = dc.category_id
 GROUP BY coalesce(dc.category_label, 'Unknown')""")
def q_category_share(spark, sf):
    return R.category_share(star_for(spark, sf))


@register("location_drilldown", "R12", STAR_SQL + """
 SELECT dl.country, dl.state, dl.region, dl.city, dl.suburb,
   CAST(grouping(dl.country, dl.state, dl.region, dl.city, dl.suburb) AS BIGINT) AS level, count(*) AS postings
 FROM fact f LEFT JOIN dim_location dl ON f.location_id = dl.location_id
 GROUP BY ROLLUP (dl.country, dl.state, dl.region, dl.city, dl.suburb)""")
def q_location_drilldown(spark, sf):
    return R.location_drilldown(star_for(spark, sf))


@register("multi_definition_jobs", "R13", STAR_SQL + f"""
 SELECT search_term_count, count(*) AS jobs, {_pct_sql('count(*)', FACTS)} AS pct_of_all
 FROM fact WHERE search_term_count > 1 GROUP BY search_term_count""")
def q_multi_definition_jobs(spark, sf):
    return R.multi_definition_jobs(star_for(spark, sf))


# ---------------------------------------------------------------- windows from stored counts and key sets

WINDOWS = [("1996", "1996-01-01", "1996-12-31"), ("1997", "1997-01-01", "1997-12-31"),
           ("both", "1996-01-01", "1997-12-31"), ("all", "1900-01-01", "2099-12-31")]
_WINDOWS_SQL = "win(name, lo, hi) AS (VALUES " + ", ".join(
    f"('{n}', {lo.replace('-', '')}, {hi.replace('-', '')})" for n, lo, hi in WINDOWS) + ")"
_IN_WINDOW = f"date_id BETWEEN {WIN_FROM.replace('-', '')} AND {WIN_TO.replace('-', '')}"


@register("salary_stats_by_company_and_window", "R3", STAR_SQL + f"""
 , {_WINDOWS_SQL}
 SELECT win.name AS window, dc.company_name, count(*) AS n, CAST(round(avg(salary_avg), 0) AS DOUBLE) AS mean_salary,
   round(quantile_cont(CAST(salary_avg AS DOUBLE), 0.5), 0) AS median_salary
 FROM fact f JOIN win ON f.date_id BETWEEN lo AND hi JOIN dim_company dc ON dc.company_id = f.company_id
 WHERE salary_avg IS NOT NULL GROUP BY win.name, dc.company_id, dc.company_name""")
def q_salary_stats_by_company_and_window(spark, sf):
    s = star_for(spark, sf)
    return R.salary_stats_by_company_and_window(s, materialize(R.salary_counts(s), "salary-counts"), WINDOWS)


@register("distinct_in_windows", "R2+R7", STAR_SQL + f"""
 , {_WINDOWS_SQL}
 SELECT win.name AS window, count(DISTINCT date_id) AS active_days, count(*) AS postings,
   count(DISTINCT company_id) AS distinct_companies
 FROM fact f JOIN win ON f.date_id BETWEEN lo AND hi GROUP BY win.name""")
def q_distinct_in_windows(spark, sf):
    s = star_for(spark, sf)
    dated = s.fact.where("date_id IS NOT NULL")
    days = materialize(dated.groupBy("date_id").agg(F.count(F.lit(1)).alias("n")), "postings-by-day")
    companies = materialize(keysets.key_bitmaps(dated, "company_id", ("date_id",)), "companies-by-day")
    return R.distinct_in_windows(days, companies, WINDOWS)


@register("salary_stats_in_window", "R3", STAR_SQL + f"""
 SELECT count(salary_avg) AS n, CAST(round(avg(salary_avg), 0) AS DOUBLE) AS mean_salary,
   round(quantile_cont(CAST(salary_avg AS DOUBLE), 0.5), 0) AS median_salary,
   {_pct_sql('count(salary_avg)', 'count(*)')} AS pct_with_salary FROM fact WHERE {_IN_WINDOW}""")
def q_salary_stats_in_window(spark, sf):
    return R.salary_stats(star_for(spark, sf), WIN_FROM, WIN_TO)


@register("salary_histogram_in_window", "R4", STAR_SQL + f"""
 , b AS (SELECT CAST({_LOWER_SQL} AS INTEGER) AS band_lower FROM fact WHERE salary_avg IS NOT NULL AND {_IN_WINDOW})
 SELECT {_LABEL_SQL} AS band, band_lower, count(*) AS postings,
   {_pct_sql('count(*)', '(SELECT count(*) FROM b)')} AS pct FROM b GROUP BY band_lower""")
def q_salary_histogram_in_window(spark, sf):
    return R.salary_histogram(star_for(spark, sf), WIN_FROM, WIN_TO)


@register("category_share_in_window", "R11", STAR_SQL + f"""
 , w AS (SELECT category_id FROM fact WHERE {_IN_WINDOW})
 SELECT coalesce(dc.category_label, 'Unknown') AS category, count(*) AS postings,
   {_pct_sql('count(*)', '(SELECT count(*) FROM w)')} AS pct
 FROM w LEFT JOIN dim_category dc USING (category_id) GROUP BY coalesce(dc.category_label, 'Unknown')""")
def q_category_share_in_window(spark, sf):
    return R.category_share(star_for(spark, sf), WIN_FROM, WIN_TO)
