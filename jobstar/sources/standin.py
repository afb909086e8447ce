"""Stand-in job feed derived from the TPC-H-style tables.

There are no job postings among the provided tables, so this adapter derives one
landed feed row per ``lineitem`` row, deterministically, with the same shape the
job API returns (flat columns plus the full JSON payload). Every quirk the
pipeline must handle is produced by a rule on the keys: repeated fetches of a job
under several search terms, mixed-case and padded names, variable location depth,
absent objects, non-positive / inverted / sub-floor salaries, malformed dates,
irregular whitespace and skill words (including near-misses) in descriptions.

The same rules are written once more in SQL for the DuckDB oracle
(``jobstar.plans.oracle_sql``); both read ``PHRASES`` below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_iso_z
from ..functions.json import coordinate
from .tables import Tables

# Phrases placed in descriptions, indexed by part and supplier keys: real skill
# mentions, spelling variants and near-misses that must not match.
PHRASES = [
    "SQL", "Python and SQL", "Power BI dashboards", "PowerBI", "Excellent communication",
    "Excel", "NoSQL stores", "PostgreSQL", "T-SQL", "SQL_x", "caféSQL", "machine learning",
    "a data warehouse", "DataWarehouse design", "Azure Synapse", "AWS/GCP", "dbt-core",
    "Git", "GitHub", "Sparkling tools", "Apache Spark", "Kafka streams", "Docker", "Airflow",
    "Databricks", "Snowflake", "Hadoop", "Tableau", "Looker", "SAS", "ETL", "Microsoft Fabric",
    "MongoDB", "Lakehouse", "data pipeline", "Power Query", "PowerQuery", "DAX", "Pythonic style",
    "teamwork",
]

CUSTOMERS_PER_COMPANY = 25  # a company (and its place) per so many customers, so re-postings recur
LOCATION_LEVELS = 6


def _phrase(idx: Column) -> Column:
    arr = F.array(*[F.lit(p) for p in PHRASES])
    return F.element_at(arr, (idx % len(PHRASES)).cast("int") + 1)


def feed_rows(t: Tables) -> DataFrame:
    """Landed feed rows: ``id, job_id, search_term, fetched_at, raw_data`` + flat columns.

    Keys ``(job_id, search_term)`` repeat across fetches; ``upsert_raw`` settles them.
    """
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    cust = t.customer.select("c_custkey", "c_acctbal")
    part = t.part.select("p_partkey", "p_name", "p_type")
    geo = (t.nation.select("n_nationkey", "n_name", "n_regionkey")
           .join(t.region.select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"), "left")
           .select("n_nationkey", "n_name", "r_name"))

    oc = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = (li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"), "left")
              .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
              .withColumn("_c", F.expr(f"o_custkey div {CUSTOMERS_PER_COMPANY}"))
              .join(geo, (F.col("_c") % 25) == F.col("n_nationkey"), "left"))

    c = F.col("_c")
    k = F.col("l_orderkey") + F.col("l_linenumber")
    line = F.col("l_linenumber")
    p_name = F.col("p_name")

    title = (F.when(k % 4 == 0, p_name)
              .when(k % 4 == 1, F.upper(p_name))
              .when(k % 4 == 2, F.concat(F.lit("  "), p_name, F.lit(" ")))
              .otherwise(F.concat(F.upper(F.substring(p_name, 1, 1)), F.substring(p_name, 2, 1 << 20))))
    cname = F.concat(F.lit("Company "), c.cast("string"))
    company_name = (F.when(F.col("o_custkey") % 43 == 0, F.lit(None).cast("string"))
                     .when(line % 3 == 0, F.upper(cname))
                     .when(line % 3 == 1, F.concat(F.lit(" "), cname, F.lit(" ")))
                     .otherwise(cname))
    depth = (c % LOCATION_LEVELS + 1).cast("int")
    full_area = F.array(
        F.col("r_name"), F.col("n_name"),
        F.concat(F.lit("Region "), c.cast("string")), F.concat(F.lit("City "), c.cast("string")),
        F.concat(F.lit("Suburb "), c.cast("string")), F.concat(F.lit("Street "), c.cast("string")))
    has_location = F.col("o_custkey").isNotNull() & (F.col("o_custkey") % 50 != 7)
    location = F.when(has_location, F.struct(
        F.concat_ws(", ", F.col("n_name"), F.col("r_name")).alias("display_name"),
        F.slice(full_area, 1, depth).alias("area")))
    has_coords = has_location & (c % LOCATION_LEVELS >= 2)
    micro = F.lit(0.000001).cast("decimal(7,6)")
    # Coordinates grow with the customer's key: the payload holds them whole, the flat columns
    # are NULL where they don't fit, as for any value of a landed payload.
    latitude = F.when(has_coords, (-((c + 10) * 1000000 + c * 12345)).cast("decimal(18,0)") * micro)
    longitude = F.when(has_coords, ((c + 110) * 1000000 + c * 6789).cast("decimal(18,0)") * micro)
    ptype = F.col("p_type")
    category = F.when(F.col("p_partkey") % 29 != 0, F.struct(
        F.concat(F.lower(ptype), F.lit("-jobs")).alias("tag"),
        F.concat(F.upper(F.substring(ptype, 1, 1)), F.lower(F.substring(ptype, 2, 1 << 20)),
                 F.lit(" Jobs")).alias("label")))
    contract_type = (F.when(F.col("l_returnflag") == "A", "permanent")
                      .when(F.col("l_returnflag") == "N", "contract"))
    contract_time = F.when(F.col("l_linestatus") == "O", "full_time").otherwise("part_time")
    salary_min = F.when(k % 3 == 0, (F.col("c_acctbal").cast("decimal(12,2)") * 10).cast("decimal(12,2)"))
    salary_max = F.when(k % 4 == 0, F.col("l_extendedprice").cast("decimal(12,2)"))
    predicted = F.when(F.col("l_discount") >= 0.05, 1).otherwise(0)
    gap = (F.when(k % 5 == 0, F.lit("\t")).when(k % 5 == 1, F.lit("  "))
            .when(k % 5 == 2, F.lit("\n")).otherwise(F.lit(" ")))
    pay = F.when(F.col("l_quantity") >= 40, F.concat(
        F.lit(" Pay $"), F.floor(F.col("l_extendedprice")).cast("bigint").cast("string"), F.lit(" per year.")
    )).otherwise(F.lit(""))
    tail = (F.when(k % 7 == 0, F.lit(" Apply now...")).when(k % 7 == 1, F.lit(" More…"))
             .otherwise(F.lit("")))
    description = F.when(k % 31 != 0, F.concat(
        F.when(line % 3 == 0, F.lit("  ")).otherwise(F.lit("")),
        F.lit("Seeking a "), p_name, F.lit(" analyst"), gap,
        F.lit("with "), _phrase(F.col("l_partkey")), F.lit(" and "), _phrase(F.col("l_suppkey")), F.lit("."),
        pay, tail,
        F.when(line % 4 == 0, F.lit(" \u00a0")).otherwise(F.lit(""))))
    created_ts = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    created = F.when(F.col("o_orderkey") % 97 == 0, F.lit("not-a-date")).otherwise(
        F.date_format(created_ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    job_id = F.col("l_orderkey").cast("string")

    payload = F.struct(
        job_id.alias("id"), title.alias("title"),
        F.when(company_name.isNotNull(), F.struct(company_name.alias("display_name"))).alias("company"),
        location.alias("location"), latitude.alias("latitude"), longitude.alias("longitude"),
        category.alias("category"), contract_type.alias("contract_type"),
        contract_time.alias("contract_time"), salary_min.alias("salary_min"),
        salary_max.alias("salary_max"), predicted.alias("salary_is_predicted"),
        description.alias("description"), created.alias("created"),
        F.concat(F.lit("https://jobs.example.org/ad/"), job_id).alias("redirect_url"))

    # Flat columns come straight from the payload struct; only raw_data is serialised.
    landed = rows.select(
        ((F.col("l_partkey") * 10000000 + F.col("l_suppkey")) * 10 + F.col("l_linenumber")).alias("id"),
        job_id.alias("job_id"),
        payload.alias("_p"),
        F.concat(F.lit("term_"), line.cast("string")).alias("search_term"),
        F.col("l_shipdate").alias("fetched_at"))
    p = F.col("_p")
    return landed.select(
        "id", "job_id",
        p["title"].alias("title"),
        p["company"]["display_name"].alias("company_name"),
        p["location"]["display_name"].alias("location_display"),
        p["category"]["tag"].alias("category_tag"),
        p["contract_type"].alias("contract_type"),
        p["contract_time"].alias("contract_time"),
        p["salary_min"].alias("salary_min"),
        p["salary_max"].alias("salary_max"),
        p["salary_is_predicted"].alias("salary_is_predicted"),
        coordinate(p["latitude"]).alias("latitude"),
        coordinate(p["longitude"]).alias("longitude"),
        parse_iso_z(p["created"]).alias("created_at"),
        F.to_json(p).alias("raw_data"),
        "search_term", "fetched_at")

