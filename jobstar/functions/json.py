"""The job payload schema and the single ``from_json`` that shreds it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

S = T.StringType()

# Leaves are read as text and typed afterwards with try_cast, so one bad value
# turns into NULL instead of failing the whole record.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("id", S),
    T.StructField("title", S),
    T.StructField("company", T.StructType([T.StructField("display_name", S)])),
    T.StructField("location", T.StructType([
        T.StructField("display_name", S),
        T.StructField("area", T.ArrayType(S)),
    ])),
    T.StructField("latitude", S),
    T.StructField("longitude", S),
    T.StructField("category", T.StructType([
        T.StructField("tag", S),
        T.StructField("label", S),
    ])),
    T.StructField("contract_type", S),
    T.StructField("contract_time", S),
    T.StructField("salary_min", S),
    T.StructField("salary_max", S),
    T.StructField("salary_is_predicted", S),
    T.StructField("description", S),
    T.StructField("created", S),
    T.StructField("redirect_url", S),
])


def parse_payload(c: Column) -> Column:
    return F.from_json(c, PAYLOAD_SCHEMA)


def money(c: Column) -> Column:
    return c.try_cast("decimal(12,2)")


def coordinate(c: Column) -> Column:
    return c.try_cast("decimal(10,6)")
