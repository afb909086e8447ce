"""Stored layouts: bucketed tables, one payload exchange to staging, the log-structured raw table."""

import json
import os
import random
import time
from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from conftest import SF_SMALL
from oracle_compare import compare, duck
from jobstar import session
from jobstar.operators import upsert
from jobstar.operators.parity import added_fingerprints, table_fingerprint
from jobstar.operators.staging import load_staging
from jobstar.operators.upsert import store_raw, upsert_by_job, upsert_raw
from jobstar.plans import pipeline
from jobstar.plans.queries import REGISTRY
from jobstar.session import scratch_path
from jobstar.sources import landing
from jobstar.sources.standin import feed_rows
from jobstar.sources.stored import declare_bucketed, store_bucketed, stored_path, stored_slices
from jobstar.sources.tables import Tables
from jobstar.streaming import logtable
from jobstar.streaming.ingest import apply_batch, ingest_incremental


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def payload_exchanges(text):
    """Exchange lines whose rows carry the payload are above the aggregates that pick it."""
    return sum("Exchange hashpartitioning" in line for line in text.splitlines())


def test_upsert_by_job_equals_the_plain_upsert_with_a_hot_job(spark, monkeypatch):
    rnd = random.Random(1)
    schema = "id long, job_id string, search_term string, fetched_at int, raw_data string"
    rows = [(i, "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", None, *map(str, range(40))]), rnd.choice(["x", "y", None]),
             rnd.randint(0, 9), f"p{i}") for i in range(800)]
    old, new = (spark.createDataFrame(r, schema).repartition(6) for r in (rows[:300], rows[300:]))
    for share in (200, 1):  # with and without hot jobs
        monkeypatch.setattr(upsert, "HOT_SHARE", share)
        assert rows_of(upsert_by_job(None, new, 5)) == rows_of(upsert_raw(None, new))
        assert rows_of(upsert_by_job(upsert_raw(None, old), new, 5)) == rows_of(upsert_raw(upsert_raw(None, old), new))


def test_from_feed_to_staging_the_payload_is_exchanged_once(spark):
    feed_path = scratch_path(spark, "feed")
    feed_rows(Tables(spark, SF_SMALL)).write.parquet(feed_path)
    feed = spark.read.parquet(feed_path)
    assert payload_exchanges(plan(upsert_by_job(None, feed, 8))) == 1
    # Straight on, and from the stored table: staging adds no exchange.
    assert payload_exchanges(plan(load_staging(upsert_by_job(None, feed, 8)))) == 1
    raw = store_raw(None, feed, 8)
    assert payload_exchanges(plan(load_staging(raw))) == 0
    drop = ["transformed_at"]
    assert rows_of(load_staging(raw).drop(*drop)) == rows_of(load_staging(upsert_raw(None, feed)).drop(*drop))


def test_a_bucketed_table_is_declared_anew_and_joined_as_it_lies(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    first = store_bucketed(df, "left side", ["k"], 4, ["k"])
    again = declare_bucketed(spark, stored_path(first), first.schema, ["k"], 4, ["k"])
    assert rows_of(again) == rows_of(df)
    other = store_bucketed(df.where("v < 50"), "right", ["k"], 4, ["k"])
    joined = again.hint("merge").join(other.withColumnRenamed("v", "w"), "k")
    assert payload_exchanges(plan(joined)) == 0
    assert joined.count() == df.join(df.where("v < 50").withColumnRenamed("v", "w"), "k").count()


# ---- the log-structured table ----

def pages(spark, jobs, drop, term="t"):
    rows = [(term, f"2026-03-01 00:00:{drop:02d}", 1, [json.dumps({"id": str(i), "title": t}) for i, t in jobs], None)]
    df = spark.createDataFrame(rows, "search_term string, fetched_at string, page long, results array<string>, _corrupt string")
    return df.withColumns({"modified": F.lit(f"2026-03-01 00:{drop:02d}:00").cast("timestamp"), "file": F.lit(f"d{drop}")})


def titles(spark, table):
    return {r.job_id: (r.id, json.loads(r.raw_data)["title"]) for r in logtable.read_version(spark, table).collect()}


def written_bytes(table, before):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{table}/data") for f in fs
               if f.endswith(".parquet") and os.path.join(d, f) not in before)


def files(table):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{table}/data") for f in fs}


def test_a_later_number_of_buckets_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "raw")
    apply_batch(spark, pages(spark, [(i, f"first {i}") for i in range(200)], 1), table, "s", 0, buckets=64)
    apply_batch(spark, pages(spark, [(i, f"second {i}") for i in range(190, 203)], 2), table, "s", 1, buckets=10)
    got = titles(spark, table)
    assert len(got) == 203 and logtable.read_version(spark, table).count() == 203
    assert got["195"] == (196, "second 195") and got["5"] == (6, "first 5") and got["202"] == (203, "second 202")


def test_a_small_drop_writes_about_its_own_size(spark, tmp_path):
    table = str(tmp_path / "raw")
    rnd = random.Random(2)
    text = lambda: "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    apply_batch(spark, pages(spark, [(i, text()) for i in range(2000)], 1), table, "s", 0, buckets=4)
    base = written_bytes(table, set())
    for d in range(2, 5):
        before = files(table)
        apply_batch(spark, pages(spark, [(100 * d + i, text()) for i in range(20)], d), table, "s", d)
        assert written_bytes(table, before) < 0.03 * base


def test_many_drops_are_compacted_and_full_buckets_split(spark, tmp_path):
    table, want = str(tmp_path / "raw"), {}
    rnd = random.Random(3)
    for d in range(1, 11):
        jobs = [(rnd.randrange(40 * d), f"{d} {i} {rnd.random()}" * 20) for i in range(60)]
        apply_batch(spark, pages(spark, jobs, d), table, "s", d, buckets=2, split_bytes=12_000)
        want |= {str(i): t for i, t in jobs}
        assert {k: t for k, (_, t) in titles(spark, table).items()} == want
    lines = logtable.manifest(spark, table, max(logtable.manifests(spark, table)))
    buckets = {m["bucket"] for m in lines}
    assert len(buckets) > 2 and max(sum(m["bucket"] == b for m in lines) for b in buckets) <= logtable.MAX_RUNS + 1
    # The buckets cover every hash once.
    assert sum(1 / (1 << (b.bit_length() - 1)) for b in buckets) == 1
    ids = [i for i, _ in titles(spark, table).values()]
    assert sorted(ids) == list(range(1, len(want) + 1))
    dealt = logtable.read_version(spark, table, dealt=3)
    assert {r.job_id: r.id for r in dealt.collect()} == {k: i for k, (i, _) in titles(spark, table).items()}
    assert payload_exchanges(plan(dealt.groupBy("job_id").agg(F.max("raw_data")))) == 1


def test_rows_that_arrived_earlier_never_win_and_missing_terms_are_keys(spark, tmp_path):
    table = str(tmp_path / "raw")
    apply_batch(spark, pages(spark, [(1, "late")], 9, term=None), table, "s", 0)
    apply_batch(spark, pages(spark, [(1, "early"), (2, "new")], 3, term=None), table, "s", 1)
    apply_batch(spark, pages(spark, [(1, "other term")], 4), table, "s", 2)
    got = {(r.job_id, r.search_term, r.id, json.loads(r.raw_data)["title"]) for r in logtable.read_version(spark, table).collect()}
    assert got == {("1", None, 1, "late"), ("2", None, 2, "new"), ("1", "t", 3, "other term")}


def test_a_bucket_of_one_job_is_not_split(spark, tmp_path):
    table = str(tmp_path / "raw")
    for d in range(1, 3):
        for term in range(3):
            apply_batch(spark, pages(spark, [(7, f"{d}" * 4000)], d, term=f"t{d}{term}"), table, "s", 3 * d + term, buckets=1, split_bytes=500)
    assert logtable.read_version(spark, table).count() == 6
    assert len({m["bucket"] for m in logtable.manifest(spark, table, max(logtable.manifests(spark, table)))}) <= 16


def test_buckets_double_in_every_bit(spark):
    buckets = [4, 7, *logtable.children(5), *logtable.children(6)]
    rows = spark.range(3000).select(F.col("id").cast("string").alias("job_id"))
    found = logtable.with_bucket(rows, buckets)
    assert found.count() == 3000
    wrong = found.where(F.expr("(1 << cast(floor(log2(bucket)) AS int)) + (xxhash64(job_id) & ((1 << cast(floor(log2(bucket)) AS int)) - 1)) <> bucket"))
    assert wrong.count() == 0 and found.select("bucket").distinct().count() == 6
    assert logtable.first_buckets(10, 0, 100) == list(range(16, 32)) and logtable.first_buckets(1, 1000, 100) == list(range(16, 32))


def test_ingest_with_another_number_of_buckets_through_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def land(name, jobs, at):
        path = folder / f"{name}.json"
        path.write_text(json.dumps({"search_term": "t", "fetched_at": "2026-03-01 00:00:00", "page": 1, "results": jobs}) + "\n")
        os.utime(path, (at, at))

    args = str(folder), str(tmp_path / "raw"), str(tmp_path / "ckpt")
    land("a", [{"id": str(i)} for i in range(100)], 1000)
    assert ingest_incremental(spark, *args, buckets=64).count() == 100
    land("b", [{"id": str(i)} for i in range(95, 103)], 2000)
    raw = ingest_incremental(spark, *args, buckets=10)
    assert raw.count() == 103 and raw.select("job_id").distinct().count() == 103
    assert landing.RAW_SCHEMA.fieldNames()[0] == "id" and "_arrival" not in raw.columns




def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_a_written_table_leaves_no_exchanged_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "RELEASE_SECONDS", 0.0)
    session.materialize(spark.range(10), "nothing")
    time.sleep(2)
    before = shuffle_files(spark)
    session.materialize(spark.range(1000).repartition(7, "id"), "dealt")
    session.materialize(spark.range(10), "next")
    until = time.monotonic() + 20
    while shuffle_files(spark) > before and time.monotonic() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before


def test_a_raw_table_stored_in_slices_is_the_whole_one(spark, monkeypatch):
    rnd = random.Random(5)
    schema = "id long, job_id string, search_term string, fetched_at int, raw_data string"
    rows = [(i, "hot" if rnd.random() < 0.2 else rnd.choice([None, "", *map(str, range(90))]), rnd.choice(["x", "y", None]),
             rnd.randint(0, 9), f"p{i}") for i in range(900)]
    old, new = (spark.createDataFrame(r, schema).repartition(6) for r in (rows[:300], rows[300:]))
    monkeypatch.setattr(session, "SLICE_ROWS", 200)
    monkeypatch.setattr(upsert, "BUCKET_ROWS", 50)
    raw = store_raw(old, new, 8)
    assert 8 < len({f.rsplit("_", 1)[1][:5] for f in raw.inputFiles()}) <= 18  # buckets grow with the rows
    assert payload_exchanges(plan(raw.groupBy("job_id").agg(F.max("raw_data")))) == 0
    assert rows_of(raw) == rows_of(upsert_raw(old, new))
    cut = stored_slices(raw, 4)
    assert len(cut) == 4 and rows_of(reduce(DataFrame.unionByName, cut)) == rows_of(raw)
    assert rows_of(added_fingerprints(cut)) == rows_of(table_fingerprint(raw))


@pytest.mark.parametrize("name", ["upsert_raw", "upsert_two_batches", "copy_check_damaged", "parity_check", "read_feed",
                                  "ingest_many_small_drops", "reports_after_drops"])
def test_queries_in_slices_give_the_same_rows(spark, monkeypatch, name):
    monkeypatch.setattr(session, "SLICE_ROWS", 1500)
    monkeypatch.setattr(pipeline, "_BUILT", {})
    modes = []
    if name == "read_feed":  # its pages land packed
        monkeypatch.setattr(landing, "land_pages", lambda *a, land=landing.land_pages, **k: modes.append(a[2:]) or land(*a, **k))
    problems, n = compare(REGISTRY[name].build(spark, SF_SMALL), duck(SF_SMALL), REGISTRY[name].sql)
    assert not problems and n
    assert name != "read_feed" or modes == [("error", "gzip")] + [("append", "gzip")] * 3
