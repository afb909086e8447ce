"""Hand-written rows for each semantic trap (see FIXTURES.md section 6)."""

import datetime as dt
import json
from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import functions as F

from jobstar.functions.text import collapse_whitespace
from jobstar.operators import mart, quality, salary, skills, staging
from jobstar.operators.keys import surrogate_key
from jobstar.operators.upsert import upsert_raw
from jobstar.sources.landing import RAW_SCHEMA, conform
from jobstar.sources.standin import feed_rows

T0 = dt.datetime(2026, 3, 1, 10, 0, 0)


def raw_rows(spark, rows):
    """rows: (id, job_id, search_term, fetched_at, payload dict)."""
    data = [(i, j, t, f, json.dumps(p)) for i, j, t, f, p in rows]
    return spark.createDataFrame(data, "id long, job_id string, search_term string, fetched_at timestamp_ntz, raw_data string")


def test_dedup_picks_newest_then_highest_id(spark):
    raw = raw_rows(spark, [
        (1, "a", "t1", T0, {"title": "old"}),
        (2, "a", "t2", T0 + dt.timedelta(days=1), {"title": "new"}),
        (1, "b", "t1", T0, {"title": "id1"}),
        (2, "b", "t2", T0, {"title": "id2"}),
        (3, "c", "t1", T0, {}), (4, "c", "t2", T0, {}), (5, "c", "t3", T0, {}),
    ])
    stg = staging.load_staging(raw).select("job_id", "title", "search_terms", "search_term_count")
    got = {r.job_id: r for r in stg.collect()}
    assert got["a"].title == "new"
    assert got["b"].title == "id2"
    assert got["c"].search_term_count == 3 and got["c"].search_terms == '["t1","t2","t3"]'
    latest = {r.job_id: r.id for r in staging.dedup_latest(raw).collect()}
    assert latest == {"a": 2, "b": 2, "c": 5}


def test_upsert_idempotent_last_applied_wins_id_kept(spark):
    base = spark.createDataFrame(
        [(1, "j", "t", T0, "v1")], "id long, job_id string, search_term string, fetched_at timestamp_ntz, raw_data string")
    once = upsert_raw(None, base)
    twice = upsert_raw(once, base)
    assert sorted(once.collect()) == sorted(twice.collect())
    older_later = spark.createDataFrame(
        [(9, "j", "t", T0 - dt.timedelta(days=3), "v2")],
        "id long, job_id string, search_term string, fetched_at timestamp_ntz, raw_data string")
    r = upsert_raw(once, older_later).collect()
    assert len(r) == 1 and r[0].raw_data == "v2" and r[0].id == 1


def test_area_depth_json_null_numbers_dates(spark):
    payloads = {
        "e": {"location": {"area": []}}, "abs": {}, "d1": {"location": {"area": ["AU"]}},
        "d2": {"location": {"area": ["AU", "NSW"]}},
        "d4": {"location": {"area": ["AU", "NSW", "Syd", "CBD"]}},
        "d7": {"location": {"area": list("ABCDEFG")}},
        "dn": {"location": {"area": ["A", None]}, "title": None,
               "salary_min": "abc", "salary_max": 50000.5, "created": "bad"},
        "ok": {"salary_min": "50000", "created": "2026-03-25T21:23:49Z"},
    }
    raw = raw_rows(spark, [(i, k, "t", T0, p) for i, (k, p) in enumerate(payloads.items())])
    got = {r.job_id: r for r in staging.load_staging(raw).collect()}
    assert got["e"].suburb is None and got["abs"].suburb is None
    assert got["d1"].suburb == "AU" and got["d1"].state is None
    assert got["d2"].suburb == "NSW" and got["d4"].suburb == "CBD" and got["d4"].city == "CBD"
    assert got["d7"].suburb == "G" and got["d7"].city == "D"
    assert got["dn"].suburb == "A" and got["dn"].title is None
    assert got["dn"].salary_min_api is None and got["dn"].salary_max_api == Decimal("50000.50")
    assert got["ok"].salary_min_api == Decimal("50000.00")
    assert got["dn"].posted_at is None and got["abs"].posted_at is None
    assert got["ok"].posted_at == dt.datetime(2026, 3, 25, 21, 23, 49)
    assert got["ok"].posted_date == dt.date(2026, 3, 25)


def test_whitespace_collapse(spark):
    df = spark.createDataFrame([("  a  b\tc\nd e  ",)], "t string")
    assert df.select(collapse_whitespace(F.col("t"))).first()[0] == "a b c d e"


def test_salary_rules(spark):
    cases = [(-1, 50000), (0, 0), (90000, 60000), (50000, None), (None, 50000), (98, 98),
             (29999, 30001), (29999.99, 29999.99), (None, None)]
    df = spark.createDataFrame(
        [(str(i), None if a is None else Decimal(str(a)), None if b is None else Decimal(str(b)), None)
         for i, (a, b) in enumerate(cases)],
        "job_id string, salary_min_api decimal(12,2), salary_max_api decimal(12,2), salary_currency string")
    got = {int(r.job_id): r for r in salary.finalize_salary(df).collect()}
    assert (got[0].salary_min_final, got[0].salary_max_final, got[0].salary_avg_final) == (None, Decimal("50000.00"), Decimal("50000.00"))
    assert got[1].salary_avg_final is None and got[1].salary_period == "annual"
    assert (got[2].salary_min_final, got[2].salary_max_final, got[2].salary_avg_final) == (Decimal("60000.00"), Decimal("90000.00"), Decimal("75000.00"))
    assert got[3].salary_avg_final == Decimal("50000.00") and got[4].salary_avg_final == Decimal("50000.00")
    assert got[5].salary_avg_final is None and got[5].salary_period is None and got[5].salary_min_final is None
    assert got[6].salary_avg_final == Decimal("30000.00")
    assert got[7].salary_avg_final is None
    assert got[8].salary_period is None and got[8].salary_currency == "AUD"


def test_fuzzy_pairs_band_and_nulls(spark):
    d = dt.date(2026, 5, 1)
    rows = [("1", "x", "c", "s", "u", d), ("2", "x", "c", "s", "u", d + dt.timedelta(days=7)),
            ("3", "y", "c", "s", "u", d), ("4", "y", "c", "s", "u", d + dt.timedelta(days=8)),
            ("5", "z", "c", None, "u", d), ("6", "z", "c", None, "u", d),
            ("7", "w", "c", "s", "u", d), ("8", "w", "c", "s", "u", d), ("9", "w", "c", "s", "u", d)]
    df = spark.createDataFrame(rows, "job_id string, title_normalized string, company_normalized string, "
                                     "state string, suburb string, posted_date date")
    assert quality.fuzzy_pair_count(df).first()[0] == 1 + 0 + 0 + 3


def test_fuzzy_pairs_equal_brute_force_on_orders(spark):
    from conftest import SF_SMALL
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("d", F.to_date("o_orderdate"))
    keys = ("o_custkey", "o_orderpriority")
    fast = quality.fuzzy_pair_count(o, keys, "d", 30).first()[0]
    a, b = o.alias("a"), o.alias("b")
    cond = ((F.col("a.o_custkey") == F.col("b.o_custkey")) & (F.col("a.o_orderpriority") == F.col("b.o_orderpriority"))
            & (F.col("a.o_orderkey") < F.col("b.o_orderkey")) & (F.abs(F.datediff("a.d", "b.d")) <= 30))
    assert fast == a.join(b, cond).count()


def test_location_key_null_and_empty_share_one_row(spark):
    stg = spark.createDataFrame([("AU", None), ("AU", "")], "country string, state string").select(
        "country", "state", *[F.lit(None).cast("string").alias(c) for c in ("region", "city", "suburb")],
        F.lit(None).cast("decimal(10,6)").alias("latitude"), F.lit(None).cast("decimal(10,6)").alias("longitude"))
    assert mart.dim_location(stg).count() == 1


def test_skill_matching_traps(spark):
    texts = ["Excel", "Excellent", "NoSQL", "PostgreSQL", "T-SQL", "SQL_x", "PowerBI and Power BI",
             "caféSQL", "sql at start and end python", "Data  Warehouse", "Sparkling"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {}
    for r in skills.match_skills(df, "id", "text").collect():
        got.setdefault(r.id, set()).add(r.skill_name)
    assert got.get(0) == {"Excel"} and 1 not in got
    assert got[2] == {"NoSQL"} and got[3] == {"PostgreSQL"} and got[4] == {"SQL"} and got[5] == {"SQL"}
    assert got[6] == {"Power BI"} and got[7] == {"SQL"} and got[8] == {"SQL", "Python"}
    assert 9 not in got and 10 not in got   # two blanks only match after cleaning; Sparkling is not Spark


def test_skill_array_form_equals_nested_loop(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.concat(F.col("text"), F.lit(" sql, Python; power bi")).alias("t"))
    fast = skills.match_skills(docs, "doc_id", "t")
    dim = skills.dim_skill(spark)
    slow = (docs.crossJoin(dim).where(F.expr("t rlike match_pattern"))
            .select("doc_id", "skill_name").distinct())
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_calendar_parts(spark):
    stg = spark.createDataFrame([(dt.date(2026, 5, 15),), (dt.date(2026, 1, 4),), (None,)], "posted_date date")
    got = {r.date_id: r for r in mart.dim_date(stg).collect()}
    assert set(got) == {20260515, 20260104}
    assert got[20260515].day_of_week == 5 and got[20260515].is_weekend == 0 and got[20260515].day_name == "Friday"
    assert got[20260104].day_of_week == 7 and got[20260104].is_weekend == 1 and got[20260104].month_name == "January"


def test_surrogate_key_dense_and_equal_to_row_number(spark):
    df = spark.range(0, 5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("k"))
    expected = [r.k for r in df.orderBy("k").collect()]
    got = surrogate_key(df, ["k"], "sid").orderBy("sid").collect()
    assert [r.sid for r in got] == list(range(1, 5001))
    assert [r.k for r in got] == expected


def test_empty_quality_checks(spark):
    from jobstar.operators.staging import STAGING_COLUMNS
    from jobstar.plans.pipeline import build_staging
    raw = raw_rows(spark, [])
    stg = build_staging(raw)
    assert set(STAGING_COLUMNS) == set(stg.columns)
    r = quality.dq_report(stg, "2026-01-01").first()
    assert r.total_rows == 0 and r.pct_missing_state is None and r.pk_status == "PASS"
    assert quality.fuzzy_dup_tight(stg).first().fuzzy_dup_pairs == 0


def test_conform_adds_defaults_and_casts(spark):
    old = spark.createDataFrame([(1, "j", "12.5")], "id long, job_id string, salary_min string")
    out = conform(old, RAW_SCHEMA, {"salary_is_predicted": 0}).first()
    assert out.salary_min == Decimal("12.50") and out.salary_is_predicted == 0 and out.latitude is None


def test_exact_quantile_distributed_equals_percentile(spark):
    from jobstar.operators.stats import exact_quantile
    df = spark.range(0, 4001).select("id", ((F.col("id") * 7919) % 1000 / 7.0).alias("v"))
    for q in (0.5, 0.25, 0.9):
        got = exact_quantile(df, "v", q).first()
        want = df.agg(F.percentile("v", q)).first()[0]
        assert got.n == 4001 and abs(got.value - want) < 1e-9
    empty = exact_quantile(df.where("id < 0"), "v", 0.5).first()
    assert empty.n == 0 and empty.value is None


def test_pair_counts_are_exact_beyond_doubles(spark):
    sizes = spark.createDataFrame([(134_217_731,), (1,), (2,)], "_n long")
    r = quality.pairs_of_sizes(sizes).first()
    assert r.fuzzy_dup_pairs == 9007199590285315 + 1 and r.rows_flagged == 134_217_733
    big = spark.createDataFrame([(4_000_000_000,)], "_n long")
    assert quality.pairs_of_sizes(big).first().fuzzy_dup_pairs == 4_000_000_000 * 3_999_999_999 // 2


def test_parity_sees_values_that_moved(spark):
    from jobstar.operators.parity import locate_differences, parity_check
    schema = "salary_max int, salary_min int"
    a, b = spark.createDataFrame([(None, 50000)], schema), spark.createDataFrame([(50000, None)], schema)
    r = parity_check({"t": a}, {"t": b}).first()
    assert r.rows_match and not r.content_match
    assert {(x.salary_max, x.salary_min, x.side) for x in locate_differences(a, b).collect()} == {
        (None, 50000, "only_a"), (50000, None, "only_b")}
    only = parity_check({"t": a}, {}).first()
    assert only.rows_b is None and not only.content_match


def test_places_with_bars_stay_apart(spark):
    stg = spark.createDataFrame([("j1", "A|B", "C"), ("j2", "A", "B|C"), ("j3", "A", "B|C")], "job_id string, country string, state string")
    for c in ("region", "city", "suburb", "title", "company_normalized", "category_tag", "contract_type", "contract_time"):
        stg = stg.withColumn(c, F.lit(None).cast("string"))
    for c in ("latitude", "longitude", "salary_min_final", "salary_max_final", "salary_avg_final"):
        stg = stg.withColumn(c, F.lit(None).cast("decimal(12,2)"))
    stg = stg.withColumn("posted_date", F.lit(None).cast("date")).withColumn("search_term_count", F.lit(1))
    places = mart.dim_location(stg)
    assert {(r.country, r.state) for r in places.collect()} == {("A|B", "C"), ("A", "B|C")} and places.count() == 2
    company = spark.createDataFrame([], "company_id long, company_normalized string")
    category = spark.createDataFrame([], "category_id long, category_tag string")
    fact = {r.job_id: r.location_id for r in mart.load_fact(stg, company, places, category).collect()}
    assert len(fact) == 3 and fact["j1"] != fact["j2"] == fact["j3"]


def test_orphans_are_found(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "job_posting_id long, company_id long")
    dim = spark.createDataFrame([(10,)], "company_id long")
    assert mart.fact_orphans(fact, {"company_id": dim}).first().orphans == 1


def test_vocabulary_of_another_list(spark):
    import pytest
    terms = [("cpp", "Language", "C++"), ("net", "Platform", ".NET"), ("two words", "X", "Data Lake")]
    dim = skills.dim_skill(spark, terms)
    texts = ["c++ and .net", "C", "x.net", "DATA lake house", "datalake", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    names = {r.skill_id: r.skill_name for r in dim.collect()}
    got = sorted((r.id, names[r.skill_id]) for r in skills.match_vocabulary(df, "id", "text", dim).collect())
    want = sorted(tuple(r) for r in skills.match_skills(df, "id", "text", terms).collect())
    assert got == want and {(0, "cpp"), (0, "net"), (3, "two words")} <= set(got)
    fact = spark.createDataFrame([("0", 1)], "job_id string, job_posting_id long")
    stg = spark.createDataFrame([("0", "C++")], "job_id string, description_clean string")
    assert skills.bridge_job_skills(fact, stg, dim, terms).count() == 1
    assert skills.bridge_from_vocabulary(fact, stg, dim).count() == 1
    with pytest.raises(ValueError):
        skills.bridge_job_skills(fact, stg, dim)


def test_reports_come_in_order(spark):
    dim = spark.createDataFrame([(1, "b", "X"), (2, "a", "Y"), (3, "c", "Y")], "skill_id long, skill_name string, skill_category string")
    fact = spark.createDataFrame([(1,), (2,), (3,)], "job_posting_id long")
    bridge = spark.createDataFrame([(1, 1), (2, 1), (1, 2), (2, 2), (3, 3)], "job_posting_id long, skill_id long")
    assert [r.skill_name for r in skills.top_skills(bridge, dim, fact).collect()] == ["a", "b", "c"]
    assert [r.skill_category for r in skills.skill_category_counts(dim, bridge).collect()] == ["Y", "X"]
    stg = spark.createDataFrame([(None,), ("x",), ("x",), ("a",)], "category_tag string")
    assert [r.category_tag for r in quality.dq_category(stg).collect()] == ["x", None, "a"]


def test_feed_of_large_customer_keys(spark):
    """Coordinates that don't fit their columns: whole in the payload, NULL in raw and staging."""
    keys = [100, 899_950]
    frames = {
        "lineitem": ([(k, 1, 1, 1, 10.0, 500.0, 0.0, "A", "O", T0) for k in keys],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(k, k, T0) for k in keys], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "customer": ([(k, 1.0) for k in keys], "c_custkey long, c_acctbal double"),
        "part": ([(1, "blue bolt", "SMALL")], "p_partkey long, p_name string, p_type string"),
        "nation": ([(n, f"N{n}", 0) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
    }
    feed = feed_rows(SimpleNamespace(**{t: spark.createDataFrame(*f) for t, f in frames.items()}))
    assert feed.schema["latitude"].dataType.simpleString() == "decimal(10,6)"
    rows = {r.job_id: r for r in feed.collect()}
    near, far = rows["100"], rows["899950"]
    assert (near.latitude, near.longitude) == (Decimal("-14.049380"), Decimal("114.027156"))
    assert '"latitude":-14.049380,"longitude":114.027156' in near.raw_data
    assert far.latitude is None and far.longitude is None
    assert '"latitude":-36452.395310,"longitude":36352.390422' in far.raw_data
    staged = {r.job_id: r.latitude for r in staging.shred_payload(feed.select("job_id", "raw_data")).collect()}
    assert staged == {"100": near.latitude, "899950": None}
