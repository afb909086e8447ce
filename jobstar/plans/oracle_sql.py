"""Independent SQL (DuckDB dialect) for every registered query.

The stand-in feed rules are restated here over the base tables without JSON, so
a match checks the JSON round trip, the dedup/upsert picks, the salary rules,
the keys and the skill matching — not just that two renderings of one plan agree.
Patterns and constants are spelled out here, not taken from the code under test; only the
vocabulary and the feed's phrases, which are data, are shared.
"""

from __future__ import annotations

from ..functions.vocab import SKILL_PATTERNS
from ..sources.standin import PHRASES

# Unicode blanks: tab to carriage return, space, next line, no-break space and the wide ones.
WHITESPACE_CLASS = (r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

AS_OF = "2001-06-01"  # fixed "today" for the date-validity check


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


PHRASE_LIST = _sql_list(PHRASES)
NP = len(PHRASES)

FEED = f"""
geo AS (
  SELECT n.n_nationkey, n.n_name, r.r_name
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
oc AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, c.c_acctbal
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
base AS (
  SELECT l.*, oc.o_orderkey, oc.o_custkey, oc.o_orderdate, oc.c_acctbal,
         p.p_partkey, p.p_name, p.p_type, g.n_name, g.r_name,
         oc.o_custkey // 25 AS c,
         l.l_orderkey + l.l_linenumber AS k
  FROM lineitem l
  LEFT JOIN oc ON l.l_orderkey = oc.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN geo g ON (oc.o_custkey // 25) % 25 = g.n_nationkey
),
feed0 AS (
  SELECT *,
    (o_custkey IS NOT NULL AND o_custkey % 50 <> 7) AS has_loc,
    'Company ' || CAST(c AS VARCHAR) AS cname,
    CAST(c % 6 + 1 AS INTEGER) AS depth
  FROM base
),
feed AS (
  SELECT
    (l_partkey * 10000000 + l_suppkey) * 10 + l_linenumber AS id,
    CAST(l_orderkey AS VARCHAR) AS job_id,
    'term_' || CAST(l_linenumber AS VARCHAR) AS search_term,
    l_shipdate AS fetched_at,
    CASE k % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN '  ' || p_name || ' '
         ELSE upper(substr(p_name, 1, 1)) || substr(p_name, 2) END AS title,
    CASE WHEN o_custkey % 43 = 0 THEN NULL
         WHEN l_linenumber % 3 = 0 THEN upper(cname)
         WHEN l_linenumber % 3 = 1 THEN ' ' || cname || ' '
         ELSE cname END AS company_name,
    CASE WHEN has_loc THEN concat_ws(', ', n_name, r_name) END AS location_display,
    CASE WHEN has_loc THEN list_slice([r_name, n_name, 'Region ' || CAST(c AS VARCHAR),
         'City ' || CAST(c AS VARCHAR), 'Suburb ' || CAST(c AS VARCHAR),
         'Street ' || CAST(c AS VARCHAR)], 1, depth) END AS area,
    CASE WHEN has_loc AND c % 6 >= 2 THEN
         CAST(CAST(-((c + 10) * 1000000 + c * 12345) AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(10,6)) END AS latitude,
    CASE WHEN has_loc AND c % 6 >= 2 THEN
         CAST(CAST((c + 110) * 1000000 + c * 6789 AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(10,6)) END AS longitude,
    CASE WHEN p_partkey % 29 <> 0 THEN lower(p_type) || '-jobs' END AS category_tag,
    CASE WHEN p_partkey % 29 <> 0 THEN upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ' Jobs' END
         AS category_label,
    CASE l_returnflag WHEN 'A' THEN 'permanent' WHEN 'N' THEN 'contract' END AS contract_type,
    CASE WHEN l_linestatus = 'O' THEN 'full_time' ELSE 'part_time' END AS contract_time,
    CASE WHEN k % 3 = 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 10 AS DECIMAL(12,2)) END AS salary_min,
    CASE WHEN k % 4 = 0 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS salary_max,
    CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS salary_is_predicted,
    CASE WHEN k % 31 <> 0 THEN
      (CASE WHEN l_linenumber % 3 = 0 THEN '  ' ELSE '' END)
      || 'Seeking a ' || p_name || ' analyst'
      || (CASE k % 5 WHEN 0 THEN chr(9) WHEN 1 THEN '  ' WHEN 2 THEN chr(10) ELSE ' ' END)
      || 'with ' || {PHRASE_LIST}[(l_partkey % {NP}) + 1] || ' and '
      || {PHRASE_LIST}[(l_suppkey % {NP}) + 1] || '.'
      || (CASE WHEN l_quantity >= 40 THEN ' Pay $' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR)
               || ' per year.' ELSE '' END)
      || (CASE k % 7 WHEN 0 THEN ' Apply now...' WHEN 1 THEN ' More…' ELSE '' END)
      || (CASE WHEN l_linenumber % 4 = 0 THEN ' ' || chr(160) ELSE '' END)
    END AS description,
    CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-date'
         ELSE strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%dT%H:%M:%SZ') END AS created,
    'https://jobs.example.org/ad/' || CAST(l_orderkey AS VARCHAR) AS redirect_url
  FROM feed0
)"""

# The payload text of each landed row: absent fields are left out.
_TEXT = "'\"{0}\":' || CAST(to_json({1}) AS VARCHAR)"
_NUMBER = "'\"{0}\":' || CAST({1} AS VARCHAR)"


def _object(fields: list[str]) -> str:
    return "'{' || array_to_string(list_filter([" + ", ".join(fields) + "], lambda f: f IS NOT NULL), ',') || '}'"


PAYLOAD = f"""
payload AS (
  SELECT *, {_object([
    _TEXT.format("id", "job_id"), _TEXT.format("title", "title"),
    "'\"company\":' || CASE WHEN company_name IS NOT NULL THEN " + _object([_TEXT.format("display_name", "company_name")]) + " END",
    "'\"location\":' || CASE WHEN location_display IS NOT NULL THEN " + _object([
        _TEXT.format("display_name", "location_display"),
        "'\"area\":[' || array_to_string(list_transform(area, lambda a: coalesce(CAST(to_json(a) AS VARCHAR), 'null')), ',') || ']'"]) + " END",
    _NUMBER.format("latitude", "latitude"), _NUMBER.format("longitude", "longitude"),
    "'\"category\":' || CASE WHEN category_tag IS NOT NULL THEN " + _object([
        _TEXT.format("tag", "category_tag"), _TEXT.format("label", "category_label")]) + " END",
    _TEXT.format("contract_type", "contract_type"), _TEXT.format("contract_time", "contract_time"),
    _NUMBER.format("salary_min", "salary_min"), _NUMBER.format("salary_max", "salary_max"),
    _NUMBER.format("salary_is_predicted", "salary_is_predicted"), _TEXT.format("description", "description"),
    _TEXT.format("created", "created"), _TEXT.format("redirect_url", "redirect_url")])} AS raw_data
  FROM feed
)"""

# Per (job_id, search_term) the newest row's values, the first row's id.
RAW = """
raw AS (
  SELECT * EXCLUDE (rn, first_id, id), first_id AS id,
         try_strptime(created, '%Y-%m-%dT%H:%M:%SZ') AS created_at
  FROM (
    SELECT *,
      row_number() OVER (PARTITION BY job_id, search_term ORDER BY fetched_at DESC, id DESC) AS rn,
      first_value(id) OVER (PARTITION BY job_id, search_term ORDER BY fetched_at, id) AS first_id
    FROM feed)
  WHERE rn = 1
)"""

# One aggregate per job; the whole newest row comes along as a struct.
STAGE0 = f"""
per_job AS (
  SELECT job_id, max_by(r, {{'f': r.fetched_at, 'i': r.id}}) AS newest,
         min(r.fetched_at) AS first_fetched_at, max(r.fetched_at) AS last_fetched_at,
         list_sort(list(DISTINCT r.search_term)) AS terms
  FROM (SELECT job_id, raw AS r FROM raw) GROUP BY job_id
),
stage0 AS (
  SELECT job_id, newest.title AS title, lower(trim(newest.title)) AS title_normalized,
    newest.company_name AS company_name, lower(trim(newest.company_name)) AS company_normalized,
    newest.location_display AS location_display,
    newest.area[1] AS country, newest.area[2] AS state, newest.area[3] AS region, newest.area[4] AS city,
    list_filter(newest.area, lambda x: x IS NOT NULL)[-1] AS suburb,
    newest.latitude AS latitude, newest.longitude AS longitude, newest.category_tag AS category_tag,
    newest.category_label AS category_label, newest.contract_type AS contract_type,
    newest.contract_time AS contract_time, newest.salary_min AS salary_min_api,
    newest.salary_max AS salary_max_api, newest.salary_is_predicted AS salary_is_predicted,
    newest.description AS description_raw,
    trim(regexp_replace(newest.description, '{WHITESPACE_CLASS}+', ' ', 'g')) AS description_clean,
    CAST(length(newest.description) AS INTEGER) AS description_length,
    newest.created_at AS posted_at, CAST(newest.created_at AS DATE) AS posted_date,
    newest.redirect_url AS redirect_url, CAST(to_json(terms) AS VARCHAR) AS search_terms,
    CAST(len(terms) AS INTEGER) AS search_term_count, first_fetched_at, last_fetched_at
  FROM per_job
)"""

SALARY = """
sal1 AS (
  SELECT *,
    CASE WHEN salary_min_api > 0 THEN salary_min_api END AS lo0,
    CASE WHEN salary_max_api > 0 THEN salary_max_api END AS hi0,
    CASE WHEN salary_min_api IS NOT NULL OR salary_max_api IS NOT NULL THEN 'annual' END AS period0
  FROM stage0
),
sal2 AS (
  SELECT *,
    CASE WHEN lo0 > hi0 THEN hi0 ELSE lo0 END AS lo1,
    CASE WHEN lo0 > hi0 THEN lo0 ELSE hi0 END AS hi1
  FROM sal1
),
sal3 AS (
  SELECT *,
    CASE WHEN lo1 IS NOT NULL AND hi1 IS NOT NULL THEN CAST((lo1 + hi1) * 0.5 AS DECIMAL(12,2))
         WHEN lo1 IS NOT NULL THEN lo1 ELSE hi1 END AS avg1
  FROM sal2
),
stg AS (
  SELECT * EXCLUDE (lo0, hi0, period0, lo1, hi1, avg1),
    'AUD' AS salary_currency,
    CASE WHEN avg1 < 30000 THEN NULL ELSE period0 END AS salary_period,
    CASE WHEN avg1 < 30000 THEN NULL ELSE lo1 END AS salary_min_final,
    CASE WHEN avg1 < 30000 THEN NULL ELSE hi1 END AS salary_max_final,
    CASE WHEN avg1 < 30000 THEN NULL ELSE avg1 END AS salary_avg_final
  FROM sal3
)"""

DIMS = """
dim_company AS (
  SELECT row_number() OVER (ORDER BY company_normalized) AS company_id, company_name, company_normalized
  FROM (SELECT max(company_name) AS company_name, company_normalized FROM stg
        WHERE company_normalized IS NOT NULL GROUP BY company_normalized)
),
dim_location AS (
  SELECT row_number() OVER (ORDER BY l1, l2, l3, l4, l5) AS location_id, country, state, region, city, suburb,
         latitude, longitude, l1 || '|' || l2 || '|' || l3 || '|' || l4 || '|' || l5 AS location_key
  FROM (SELECT coalesce(country, '') AS l1, coalesce(state, '') AS l2, coalesce(region, '') AS l3,
               coalesce(city, '') AS l4, coalesce(suburb, '') AS l5, max(country) AS country, max(state) AS state,
               max(region) AS region, max(city) AS city, max(suburb) AS suburb,
               max(latitude) AS latitude, max(longitude) AS longitude
        FROM stg GROUP BY l1, l2, l3, l4, l5)
),
dim_date AS (
  SELECT DISTINCT
    CAST(strftime(posted_date, '%Y%m%d') AS INTEGER) AS date_id, posted_date AS full_date,
    CAST(year(posted_date) AS INTEGER) AS year, CAST(quarter(posted_date) AS INTEGER) AS quarter,
    CAST(month(posted_date) AS INTEGER) AS month, monthname(posted_date) AS month_name,
    CAST(dayofmonth(posted_date) AS INTEGER) AS day_of_month,
    CAST(isodow(posted_date) AS INTEGER) AS day_of_week, dayname(posted_date) AS day_name,
    CASE WHEN isodow(posted_date) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM stg WHERE posted_date IS NOT NULL
),
dim_category AS (
  SELECT row_number() OVER (ORDER BY category_tag) AS category_id, category_tag, category_label
  FROM (SELECT category_tag, max(category_label) AS category_label FROM stg
        WHERE category_tag IS NOT NULL GROUP BY category_tag)
),
fact AS (
  -- A dimension's number is the dense rank of its key: no lookup is needed here.
  SELECT row_number() OVER (ORDER BY job_id) AS job_posting_id, job_id, title,
    CASE WHEN company_normalized IS NOT NULL THEN
         dense_rank() OVER (PARTITION BY company_normalized IS NULL ORDER BY company_normalized) END AS company_id,
    dense_rank() OVER (ORDER BY coalesce(country, ''), coalesce(state, ''), coalesce(region, ''),
                                coalesce(city, ''), coalesce(suburb, '')) AS location_id,
    CAST(strftime(posted_date, '%Y%m%d') AS INTEGER) AS date_id,
    CASE WHEN category_tag IS NOT NULL THEN
         dense_rank() OVER (PARTITION BY category_tag IS NULL ORDER BY category_tag) END AS category_id,
    salary_min_final AS salary_min, salary_max_final AS salary_max, salary_avg_final AS salary_avg,
    CAST(salary_avg_final IS NOT NULL AS INTEGER) AS has_salary,
    contract_type, contract_time, search_term_count
  FROM stg
)"""


def whole_word(literal: str) -> str:
    """RE2: the literal between characters that are no ASCII letters or digits, in any case."""
    escaped = "".join(c if c.isalnum() or c == " " else "\\" + c for c in literal)
    return f"(?i)(^|[^A-Za-z0-9]){escaped}([^A-Za-z0-9]|$)"


def _skill_values() -> str:
    rows = ", ".join(
        f"('{n}', '{c}', '{whole_word(p)}', '{p.lower()}')" for n, c, p in SKILL_PATTERNS)
    return rows


# ``contains(lower(text), literal)`` is a necessary condition for the whole-word
# match; it only spares DuckDB compiling the per-row pattern on hopeless rows.
SKILLS = f"""
skill_defs(skill_name, skill_category, pattern, literal) AS (VALUES {_skill_values()}),
dim_skill AS (
  SELECT row_number() OVER (ORDER BY skill_name) AS skill_id, skill_name, min(skill_category) AS skill_category
  FROM skill_defs GROUP BY skill_name
),
skill_hits AS (
  SELECT s.job_id, sd.skill_name FROM stg s CROSS JOIN skill_defs sd
  WHERE s.description_clean IS NOT NULL AND contains(lower(s.description_clean), sd.literal)
    AND regexp_matches(s.description_clean, sd.pattern)
),
bridge AS (
  SELECT DISTINCT f.job_posting_id, ds.skill_id
  FROM skill_hits h JOIN fact f ON f.job_id = h.job_id JOIN dim_skill ds ON ds.skill_name = h.skill_name
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)


CHAIN_RAW = (FEED, RAW)
CHAIN_STG = (FEED, RAW, STAGE0, SALARY)
CHAIN_STAR = (FEED, RAW, STAGE0, SALARY, DIMS)
CHAIN_SKILLS = (FEED, RAW, STAGE0, SALARY, DIMS, SKILLS)
