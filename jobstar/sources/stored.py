"""Bucketed stored tables: Parquet laid out by key, so that later plans need no exchange on it.

A bucketed table's scan tells the planner that equal keys lie in one partition: grouping,
windows and joins by the key (or by more columns that include it) start without an exchange.
The files lie under the checkpoint folder; the table is declared in the session's catalogue,
and ``declare_bucketed`` declares it anew in another session.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import released, scratch_path


def store_bucketed(df: DataFrame, name: str, key: list[str], buckets: int, sort: list[str] | None = None,
                   exchange: bool = True) -> DataFrame:
    """Write ``df`` in ``buckets`` buckets of ``key``, sorted by ``sort`` inside, and read it back.

    With ``exchange`` the rows are dealt by key first, so each bucket is one file. A frame that is
    dealt by ``repartition(buckets, *key)`` already needs none.
    """
    return store_slices([df.repartition(buckets, *key) if exchange else df], name, key, buckets, sort)


def store_slices(slices: Iterable[DataFrame], name: str, key: list[str], buckets: int, sort: list[str] | None = None,
                 compression: str = "snappy") -> DataFrame:
    """One bucketed table of several frames, written one after the other: a bucket has files of each."""
    table, path = _table_name(name), None
    for number, rows in enumerate(slices):
        spark = rows.sparkSession
        path = path or scratch_path(spark, name)
        writer = (rows.write.format("parquet").option("path", path).option("compression", compression)
                  .bucketBy(buckets, *key).mode("append" if number else "error"))
        with released(spark):
            (writer.sortBy(*sort) if sort else writer).saveAsTable(table)
    return spark.table(table)


def declare_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: list[str], buckets: int,
                     sort: list[str] | None = None, name: str = "stored") -> DataFrame:
    """A bucketed table that ``store_bucketed`` wrote to ``path``, perhaps in another session."""
    table = _table_name(name)
    quoted = lambda cols: ", ".join(f"`{c}`" for c in cols)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({quoted(key)}) "
              + (f"SORTED BY ({quoted(sort)}) " if sort else "") + f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def stored_slices(df: DataFrame, slices: int) -> list[DataFrame]:
    """A stored table's frame as at most ``slices`` frames of about as many files, which make it up."""
    files = sorted(df.inputFiles())
    if slices == 1 or len(files) < 2:
        return [df]
    return [df.sparkSession.read.schema(df.schema).parquet(*[unquote(f) for f in files[k::slices]]) for k in range(min(slices, len(files)))]


def stored_path(df: DataFrame) -> str:
    """The folder of a stored table's frame."""
    return unquote(df.inputFiles()[0].rsplit("/", 1)[0])


def _table_name(name: str) -> str:
    return f"{''.join(c if c.isalnum() else '_' for c in name)}_{uuid.uuid4().hex[:12]}"
