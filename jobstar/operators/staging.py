"""W3-W7v: raw rows -> one staging row per job.

The direct form (aggregate search context, rank rows, join the two) costs two
shuffles and a join. Here one ``groupBy(job_id)`` picks the representative
payload with ``max_by`` and gathers the search context in the same pass; the
payload is parsed once per job after the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import parse_iso_z
from ..functions.json import coordinate, money, parse_payload
from ..functions.text import collapse_whitespace, normalize_name

# Representative row: newest fetch, then highest id.
PICK_ORDER = ("fetched_at", "id")


def _pick_order() -> F.Column:
    return F.struct(*[F.col(c) for c in PICK_ORDER])


def dedup_latest(raw: DataFrame, key: str = "job_id", order: tuple[str, ...] = PICK_ORDER) -> DataFrame:
    """Keep one row per ``key``: the greatest by ``order`` (all descending).

    ``row_number() == 1`` over a key window; Catalyst inserts a partial
    WindowGroupLimit before the exchange, so each map task ships at most one
    row per key and a hot key does not pile up in one reducer.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return raw.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def search_context(raw: DataFrame, key: str = "job_id", term: str = "search_term",
                   time_col: str = "fetched_at", prefix: str = "search_term") -> DataFrame:
    """Per key the sorted distinct terms (JSON text), their count, first/last time.

    The term set per key is bounded by the term vocabulary (the configured search
    terms), and ``collect_set`` combines it map-side, so a hot key stays small.
    """
    first = "first_fetched_at" if time_col == "fetched_at" else f"first_{time_col}"
    last = "last_fetched_at" if time_col == "fetched_at" else f"last_{time_col}"
    return (raw.groupBy(key)
            .agg(F.sort_array(F.collect_set(term)).alias("_terms"),
                 F.min(time_col).alias(first),
                 F.max(time_col).alias(last))
            .select(key, F.to_json("_terms").alias(f"{prefix}s"),
                    F.size("_terms").alias(f"{prefix}_count"), first, last))


def shred_payload(df: DataFrame, payload_col: str = "raw_data") -> DataFrame:
    """W5 + W6: typed staging columns from the JSON payload (other columns kept)."""
    p = F.col("_p")
    area = p["location"]["area"]
    desc = p["description"]
    created = parse_iso_z(p["created"])
    return df.withColumn("_p", parse_payload(F.col(payload_col))).select(
        "*",
        p["title"].alias("title"),
        normalize_name(p["title"]).alias("title_normalized"),
        p["company"]["display_name"].alias("company_name"),
        normalize_name(p["company"]["display_name"]).alias("company_normalized"),
        p["location"]["display_name"].alias("location_display"),
        F.get(area, 0).alias("country"),
        F.get(area, 1).alias("state"),
        F.get(area, 2).alias("region"),
        F.get(area, 3).alias("city"),
        F.try_element_at(F.array_compact(area), F.lit(-1)).alias("suburb"),
        coordinate(p["latitude"]).alias("latitude"),
        coordinate(p["longitude"]).alias("longitude"),
        p["category"]["tag"].alias("category_tag"),
        p["category"]["label"].alias("category_label"),
        p["contract_type"].alias("contract_type"),
        p["contract_time"].alias("contract_time"),
        money(p["salary_min"]).alias("salary_min_api"),
        money(p["salary_max"]).alias("salary_max_api"),
        p["salary_is_predicted"].try_cast("int").alias("salary_is_predicted"),
        desc.alias("description_raw"),
        collapse_whitespace(desc).alias("description_clean"),
        F.char_length(desc).alias("description_length"),
        created.alias("posted_at"),
        F.to_date(created).alias("posted_date"),
        p["redirect_url"].alias("redirect_url"),
    ).drop("_p")


STAGING_COLUMNS = [
    "job_id", "title", "title_normalized", "company_name", "company_normalized",
    "location_display", "country", "state", "region", "city", "suburb", "latitude",
    "longitude", "category_tag", "category_label", "contract_type", "contract_time",
    "salary_min_api", "salary_max_api", "salary_is_predicted", "salary_min_extracted",
    "salary_max_extracted", "salary_period", "salary_currency", "salary_min_final",
    "salary_max_final", "salary_avg_final", "description_raw", "description_clean",
    "description_length", "posted_at", "posted_date", "redirect_url", "search_terms",
    "search_term_count", "first_fetched_at", "last_fetched_at", "transformed_at",
]


def load_staging(raw: DataFrame) -> DataFrame:
    """One row per job_id with the full staging layout (salary finals still empty).

    Single exchange on job_id: ``max_by`` keeps one payload per key per map task,
    ``collect_set`` keeps the distinct terms (bounded by the configured search
    terms, not by row count), min/max are plain partial aggregates.
    """
    per_job = raw.groupBy("job_id").agg(
        F.max_by("raw_data", _pick_order()).alias("raw_data"),
        F.sort_array(F.collect_set("search_term")).alias("_terms"),
        F.min("fetched_at").alias("first_fetched_at"),
        F.max("fetched_at").alias("last_fetched_at"))
    shredded = shred_payload(per_job)
    dec = lambda p, s: F.lit(None).cast(f"decimal({p},{s})")
    return shredded.select(
        *[F.col(c) for c in STAGING_COLUMNS[:20]],
        dec(12, 2).alias("salary_min_extracted"), dec(12, 2).alias("salary_max_extracted"),
        F.lit(None).cast("string").alias("salary_period"),
        F.lit(None).cast("string").alias("salary_currency"),
        dec(12, 2).alias("salary_min_final"), dec(12, 2).alias("salary_max_final"),
        dec(12, 2).alias("salary_avg_final"),
        "description_raw", "description_clean", "description_length", "posted_at", "posted_date",
        "redirect_url",
        F.to_json("_terms").alias("search_terms"),
        F.size("_terms").alias("search_term_count"),
        "first_fetched_at", "last_fetched_at",
        F.current_timestamp().alias("transformed_at"))


def staging_summary(stg: DataFrame) -> DataFrame:
    """W7v: one-row load check."""
    return stg.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("state").alias("has_state"),
        F.count("suburb").alias("has_suburb"),
        F.count_if(F.col("search_term_count") > 1).alias("multi_search_jobs"),
        F.max("search_term_count").alias("max_search_terms"))
