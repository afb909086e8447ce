"""Declared schemas of staging and star: checked at each write, merged at reads, listed beside what is stored.

Parquet takes any frame, so a column that is lost or narrowed by an earlier step would only show
in a report. ``checked`` stands before each write of a layer; ``read_merged`` reads folders written
under an older declaration (fewer columns, narrower types) as the declared table;
``schema_listing`` is the catalogue: a line per column with both types and the column's NULLs.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

_DDL = {
    "stg_jobs": """
        job_id string not null, title string, title_normalized string, company_name string, company_normalized string,
        location_display string, country string, state string, region string, city string, suburb string,
        latitude decimal(10,6), longitude decimal(10,6), category_tag string, category_label string,
        contract_type string, contract_time string, salary_min_api decimal(12,2), salary_max_api decimal(12,2),
        salary_is_predicted int, salary_min_extracted decimal(12,2), salary_max_extracted decimal(12,2),
        salary_period string, salary_currency string, salary_min_final decimal(12,2), salary_max_final decimal(12,2),
        salary_avg_final decimal(12,2), description_raw string, description_clean string, description_length int,
        posted_at timestamp_ntz, posted_date date, redirect_url string, search_terms string, search_term_count int,
        first_fetched_at timestamp_ntz, last_fetched_at timestamp_ntz, transformed_at timestamp""",
    "dim_company": "company_id bigint not null, company_name string not null, company_normalized string not null",
    "dim_location": """
        location_id bigint not null, country string, state string, region string, city string, suburb string,
        latitude decimal(10,6), longitude decimal(10,6), location_key string not null""",
    "dim_date": """
        date_id int not null, full_date date not null, year int not null, quarter int not null, month int not null,
        month_name string not null, day_of_month int not null, day_of_week int not null, day_name string not null,
        is_weekend int not null""",
    "dim_category": "category_id bigint not null, category_tag string not null, category_label string",
    "dim_skill": """
        skill_id bigint not null, skill_name string not null, skill_category string, match_pattern string,
        first_words array<string>""",
    "fact_job_postings": """
        job_posting_id bigint not null, job_id string not null, title string, company_id bigint, location_id bigint,
        date_id int, category_id bigint, salary_min decimal(12,2), salary_max decimal(12,2), salary_avg decimal(12,2),
        has_salary int not null, contract_type string, contract_time string, search_term_count int""",
    "bridge_job_skills": "job_posting_id bigint not null, skill_id bigint not null",
}
TABLES = tuple(_DDL)

_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


@cache
def schema(table: str) -> T.StructType:
    """The declared schema; its text is parsed by the running session."""
    return T.StructType.fromDDL(_DDL[table])


class SchemaMismatch(ValueError):
    """A frame doesn't fit the declared table."""


def widens(found: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of ``found`` is a value of ``declared``."""
    if found == declared:
        return True
    if found in _WHOLE and declared in _WHOLE:
        return _WHOLE.index(found) <= _WHOLE.index(declared)
    if isinstance(declared, T.DecimalType):
        if isinstance(found, T.DecimalType):
            return found.scale <= declared.scale and found.precision - found.scale <= declared.precision - declared.scale
        return found in _WHOLE and _WHOLE_DIGITS[found.simpleString()] <= declared.precision - declared.scale
    if isinstance(found, T.FloatType):
        return isinstance(declared, T.DoubleType)
    if isinstance(found, T.NullType):
        return True
    return isinstance(found, T.StringType) and isinstance(declared, T.StringType)  # collated strings


def problems(found: T.StructType, declared: T.StructType, optional: bool = False) -> list[str]:
    """What keeps a frame of schema ``found`` from the declared table. With ``optional`` nullable columns may lack."""
    have = {f.name: f.dataType for f in found.fields}
    out = [f"{n} occurs {k} times" for n in have if (k := found.names.count(n)) > 1]
    for f in declared.fields:
        if f.name not in have:
            if not (optional and f.nullable):
                out.append(f"{f.name} is missing")
        elif not widens(have[f.name], f.dataType):
            out.append(f"{f.name} is {have[f.name].simpleString()}, which doesn't fit {f.dataType.simpleString()}")
    return out + [f"{n} isn't declared" for n in have if n not in declared.names]


def checked(df: DataFrame, table: str, optional: bool = False) -> DataFrame:
    """``df`` as the declared ``table``: its columns, order and types.

    Raises ``SchemaMismatch`` at once if a column is missing, unknown, repeated or of a type whose values
    the declared one can't all hold; narrower types are widened. A NULL in a column declared
    ``not null`` fails the job that writes, in the same pass. With ``optional`` missing nullable columns are NULL.
    """
    declared = schema(table)
    wrong = problems(df.schema, declared, optional)
    if wrong:
        raise SchemaMismatch(f"{table}: {'; '.join(wrong)}")
    return df.select(*[_declared_column(df, table, f).alias(f.name) for f in declared.fields])


def _declared_column(df: DataFrame, table: str, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    c = F.col(f"`{field.name}`")
    found = df.schema[field.name].dataType
    if found != field.dataType and not isinstance(found, T.StringType):
        c = c.cast(field.dataType)
    if field.nullable:
        return c
    return F.when(c.isNull(), F.raise_error(F.lit(f"NULL in {table}.{field.name}, which is declared not null"))).otherwise(c)


def read_merged(spark: SparkSession, paths: list[str], table: str) -> DataFrame:
    """Folders written under this or an older declaration, as one declared table.

    Each folder is checked on its own, so a folder that can't be widened is named by the error.
    """
    frames = []
    for path in paths:
        try:
            frames.append(checked(spark.read.parquet(path), table, optional=True))
        except SchemaMismatch as e:
            raise SchemaMismatch(f"{path}: {e}") from None
    return reduce(DataFrame.unionByName, frames)


def schema_listing(stored: dict[str, DataFrame]) -> DataFrame:
    """The catalogue of ``stored`` tables: a line per declared or stored column, in declared order.

    ``status`` is ``ok``, ``widened`` (the stored type is narrower and fits), ``differs``, ``missing``, ``undeclared``
    or ``nulls`` (in a column declared not null). One scan per table counts rows and NULLs.
    """
    return reduce(DataFrame.unionByName, [_listing(name, df) for name, df in stored.items()])


def _listing(table: str, df: DataFrame) -> DataFrame:
    declared = schema(table)
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    lines = []
    for place, name in enumerate([*declared.names, *[c for c in df.columns if c not in declared.names]], 1):
        want = declared[name] if name in declared.names else None
        found = df.schema[name].dataType if name in df.columns else None
        nulls = F.col("n") - F.col(f"c{df.columns.index(name)}") if found is not None else F.lit(None).cast("long")
        if want is None:
            status = F.lit("undeclared")
        elif found is None:
            status = F.lit("missing")
        elif not widens(found, want.dataType):
            status = F.lit("differs")
        else:
            fits = "ok" if found == want.dataType else "widened"
            status = F.lit(fits) if want.nullable else F.when(nulls > 0, "nulls").otherwise(fits)
        text = lambda t: F.lit(t.simpleString() if t is not None else None).cast("string")
        lines.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(place).alias("ordinal"), F.lit(name).alias("column_name"),
            text(want.dataType if want else None).alias("declared_type"), text(found).alias("stored_type"),
            F.lit(want.nullable if want else True).alias("is_nullable"), F.col("n").alias("n_rows"),
            nulls.alias("n_nulls"), status.alias("status")))
    return counts.select(F.inline(F.array(*lines)))
