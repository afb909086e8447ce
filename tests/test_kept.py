"""Declared schemas, and reports kept up to date by change rows."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from jobstar.plans import reports as R
from jobstar.plans.pipeline import Star
from jobstar.session import ensure_checkpoint_dir, scratch_path
from jobstar.sources.schemas import SchemaMismatch, checked, read_merged, schema, schema_listing
from jobstar.streaming import kept_reports, logtable
from jobstar.streaming.ingest import apply_batch
from jobstar.streaming.kept_reports import KeptReports, change_rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- declared schemas ----

COMPANY = "company_id bigint, company_name string, company_normalized string"


def test_a_write_with_a_missing_narrowed_or_unknown_column_raises(spark):
    good = spark.createDataFrame([(1, "A", "a")], COMPANY)
    assert checked(good, "dim_company").columns == schema("dim_company").names
    for wrong, said in ((good.drop("company_name"), "company_name is missing"),
                        (good.withColumn("company_id", F.lit("1")), "company_id is string"),
                        (good.withColumn("more", F.lit(1)), "more isn't declared")):
        with pytest.raises(SchemaMismatch, match=said):
            checked(wrong, "dim_company")
    day = spark.createDataFrame([(20260101, dt.date(2026, 1, 1), 2026, 1, 1, "January", 1, 4, "Thursday", 0)], schema("dim_date"))
    with pytest.raises(SchemaMismatch, match="date_id is bigint"):
        checked(day.withColumn("date_id", F.col("date_id").cast("long")), "dim_date")
    with pytest.raises(SchemaMismatch, match="latitude is decimal"):
        place = spark.createDataFrame([], schema("dim_location"))
        checked(place.withColumn("latitude", F.lit(None).cast("decimal(12,6)")), "dim_location")


def test_order_and_narrower_types_are_put_right(spark):
    df = spark.createDataFrame([("a", "A", 7)], "company_normalized string, company_name string, company_id int")
    out = checked(df, "dim_company")
    assert out.columns == schema("dim_company").names and out.schema["company_id"].dataType.simpleString() == "bigint"
    assert rows_of(out) == [(7, "A", "a")]
    places = spark.createDataFrame([], schema("dim_location"))
    narrow = places.withColumn("latitude", F.col("latitude").cast("decimal(8,4)"))
    assert checked(narrow, "dim_location").schema["latitude"].dataType.simpleString() == "decimal(10,6)"


def test_a_null_in_a_column_declared_not_null_fails_the_write(spark):
    df = spark.createDataFrame([(1, None, "a")], COMPANY)
    with pytest.raises(Exception, match="NULL in dim_company.company_name"):
        checked(df, "dim_company").write.parquet(scratch_path(spark, "nulls"))


def test_folders_of_an_older_declaration_are_read_as_the_declared_table(spark):
    old, new, bad = (scratch_path(spark, n) for n in ("old", "new", "bad"))
    spark.createDataFrame([(1, "t1")], "category_id int, category_tag string").write.parquet(old)
    spark.createDataFrame([(2, "t2", "L")], "category_id bigint, category_tag string, category_label string").write.parquet(new)
    spark.createDataFrame([("x", "t3")], "category_id string, category_tag string").write.parquet(bad)
    assert rows_of(read_merged(spark, [old, new], "dim_category")) == [(1, "t1", None), (2, "t2", "L")]
    with pytest.raises(SchemaMismatch, match="bad.*category_id is string"):
        read_merged(spark, [new, bad], "dim_category")


def test_the_listing_names_what_differs(spark):
    df = spark.createDataFrame([(1, None, 5, "x"), (2, "t", None, None)],
                               "category_id int, category_tag string, category_label long, more string")
    got = {r.column_name: (r.ordinal, r.status, r.n_rows, r.n_nulls) for r in schema_listing({"dim_category": df}).collect()}
    assert got == {"category_id": (1, "widened", 2, 0), "category_tag": (2, "nulls", 2, 1),
                   "category_label": (3, "differs", 2, 1), "more": (4, "undeclared", 2, 1)}
    short = schema_listing({"dim_category": df.select("category_id")}).where("status = 'missing'")
    assert rows_of(short.select("column_name", "stored_type", "n_nulls")) == [
        ("category_label", None, None), ("category_tag", None, None)]
    empty = schema_listing({"dim_category": spark.createDataFrame([], schema("dim_category"))})
    assert {r.status for r in empty.collect()} == {"ok"}


# ---- kept reports ----

def job(i, day, area, tag, label):
    out = {"id": str(i), "title": f"t{i}", "created": f"{day}T00:00:00Z" if day else None}
    if area is not None:
        out["location"] = {"display_name": "x", "area": area}
    if tag or label:
        out["category"] = {"tag": tag, "label": label}
    return out


def drop(spark, no, jobs, term="t", fetched=None):
    rows = [(term, fetched or f"2026-03-01 00:00:{no:02d}", 1, [json.dumps(j) for j in jobs], None)]
    df = spark.createDataFrame(rows, "search_term string, fetched_at string, page long, results array<string>, _corrupt string")
    return df.withColumns({"modified": F.lit(f"2026-03-01 00:{no:02d}:00").cast("timestamp"), "file": F.lit(f"d{no}-{term}")})


def drops(spark):
    place = lambda k: ["AU", "NSW", "R", f"City {k}"]
    first = [job(i, f"2026-01-{1 + i % 9:02d}", place(i % 3), f"g{i % 2}", f"Group {i % 2}") for i in range(30)]
    first += [job(30, None, None, None, None), job(31, "2026-01-02", ["AU", "NSW", "R", ""], "g2", "Only one")]
    moved = [job(3, "2026-02-01", place(9), "g1", "Group 1"), job(31, "2026-01-02", None, None, "No tag"), job(40, None, place(0), "g1", "A")]
    return [drop(spark, 0, first),
            # Jobs that move, one under a second term, and one that comes new.
            drop(spark, 1, moved).unionByName(drop(spark, 1, [job(5, "2026-02-02", place(8), "g0", "Z label")], "u")),
            # One moves back, an older fetch changes nothing, one is sent again as it was.
            drop(spark, 2, [job(3, "2026-01-04", place(0), "g1", "Group 1")])
            .unionByName(drop(spark, 2, [job(7, "2026-02-02", place(8), "g0", "x")], "u", "2020-01-01 00:00:00"))
            .unionByName(drop(spark, 2, [job(6, "2026-01-07", place(0), "g0", "Group 0")], "v"))]


WINDOWS = [{}, {"start": "2026-01-03", "end": "2026-02-01"}]


def reports(kept):
    return [rows_of(r) for w in WINDOWS for r in (kept.postings_by_location(**w), kept.daily_trend(**w), kept.category_share(**w))]


def rebuilt(spark, table):
    s = Star(spark, raw=logtable.read_version(spark, table).drop("_arrival"))
    return [rows_of(r) for w in WINDOWS for r in
            (R.postings_by_location(s, **w), R.daily_trend(s, **w), R.category_share(s, **w))]


def test_after_each_drop_the_kept_reports_equal_a_full_rebuild(spark):
    table, kept = scratch_path(spark, "raw"), KeptReports(spark, scratch_path(spark, "kept"), buckets=4)
    for no, pages in enumerate(drops(spark)):
        apply_batch(spark, pages, table, "s", no, buckets=4, follow=kept.follow)
        assert reports(kept) == rebuilt(spark, table), no
    # An empty drop is a version too; a replayed one changes nothing.
    apply_batch(spark, drop(spark, 3, []), table, "s", 3, follow=kept.follow)
    before = rows_of(kept.counts("places"))
    apply_batch(spark, drops(spark)[2], table, "s", 2, follow=kept.follow)
    assert rows_of(kept.counts("places")) == before and kept.counts("days", 3).count() > 0
    with pytest.raises(ValueError, match="can't follow"):
        kept.follow(None, 9)


def test_a_drop_that_fails_before_its_version_is_published_is_followed_again(spark):
    table, kept = scratch_path(spark, "raw"), KeptReports(spark, scratch_path(spark, "kept"), buckets=4)
    plain = KeptReports(spark, scratch_path(spark, "plain"), buckets=4)
    first, second, _ = drops(spark)
    apply_batch(spark, first, table, "s", 0, buckets=4, follow=kept.follow)
    # Reports may also start from a table that is there.
    plain.start(logtable.read_version(spark, table), 0)

    def fails(rows, version):
        kept.follow(rows, version)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        apply_batch(spark, second, table, "s", 1, follow=fails)
    def both(rows, version):
        kept.follow(rows, version)
        plain.follow(rows, version)

    apply_batch(spark, second, table, "s", 1, follow=both)
    for cube in ("days", "places", "categories"):
        assert rows_of(kept.counts(cube)) == rows_of(plain.counts(cube))
        assert kept.counts(cube).agg(F.sum("n")).first()[0] == 33


def test_a_drop_leaves_its_table_and_reports_and_no_other_folder(spark):
    table, kept = scratch_path(spark, "raw"), KeptReports(spark, scratch_path(spark, "kept"), buckets=4)
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))

    def fails(rows, version):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        apply_batch(spark, drops(spark)[0], table, "s", 0, buckets=4, follow=fails)
    for no, pages in enumerate(drops(spark)):
        apply_batch(spark, pages, table, "s", no, buckets=4, follow=kept.follow)
    assert set(os.listdir(root)) - before == {os.path.basename(p) for p in (table, kept.root)}


def test_the_first_facets_get_buckets_by_their_size(spark, monkeypatch):
    monkeypatch.setattr(kept_reports, "SPLIT_BYTES", 512)
    table, kept = scratch_path(spark, "raw"), KeptReports(spark, scratch_path(spark, "kept"), buckets=1)
    apply_batch(spark, drops(spark)[0], table, "s", 0, buckets=4, follow=kept.follow)
    # Written as one bucket, they would be split once.
    assert len(logtable.State.newest(spark, f"{kept.root}/facets").runs) > 2
    assert reports(kept) == rebuilt(spark, table)


def test_a_drop_gives_change_rows_for_its_own_jobs_alone(spark):
    types = ("id long, job_id string, search_term string, fetched_at int, posted_date date, country string, state string, "
             "region string, city string, suburb string, category_tag string, category_label string, _arrival int")
    facet = lambda i, term, city, came: (i, f"j{i}", term, came, None, None, None, None, city, None, None, None, came)
    old = spark.createDataFrame([facet(1, "a", "X", 1), facet(2, "a", "X", 1)], types)
    fresh = spark.createDataFrame([facet(1, "a", "X", 2), facet(2, "a", "Y", 2)], types)
    got = {(r.city, r.n) for r in change_rows(old, fresh).collect()}
    assert got == {("X", -1), ("Y", 1)}  # job 1 is sent again as it was: no change row
    assert {(r.city, r.n) for r in change_rows(None, fresh).collect()} == {("X", 1), ("Y", 1)}
    assert change_rows(old.limit(0), fresh.limit(0)).count() == 0
