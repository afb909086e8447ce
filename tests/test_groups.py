"""Islands, running sums, quantiles of many groups, key sets, dictionaries, collated keys, leaves: against brute force."""

import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from jobstar.functions.patterns import word_regex
from jobstar.operators import dictionary, keysets, mart, parity
from jobstar.operators.dictionary import match_dictionary
from jobstar.operators.ranges import grouped_quantile, islands, running_sum
from jobstar.operators.repostings import reposting_groups
from jobstar.sources.landing import copy_check


def hot_groups(rnd, n):
    """A third of the rows in one group, NULL groups too."""
    return ["hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", None, *map(str, range(20))]) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_islands_and_sums_over_partition_borders(spark, partitions):
    rnd = random.Random(partitions)
    points = sorted({(g, rnd.randrange(900)) for g in hot_groups(rnd, 700)}, key=str)
    df = spark.createDataFrame([(g, at, at % 5) for g, at in points], "g string, at int, n int").repartition(4)
    got = {(r.g, r.at): r.start for r in islands(df, ["g"], "at", 4, "start", partitions).collect()}
    sums = {(r.g, r.at): (r.upto, r.upto_total) for r in running_sum(df, ["g"], "at", "n", "upto", partitions).collect()}
    want, want_sums = {}, {}
    for g in {g for g, _ in points}:
        start = before = None
        total = 0
        days = sorted(at for h, at in points if h == g)
        for at in days:
            start = at if before is None or at - before > 4 else start
            total += at % 5
            want[g, at], want_sums[g, at] = start, (total, sum(d % 5 for d in days))
            before = at
    assert got == want and sums == want_sums


def test_an_island_over_many_whole_partitions(spark):
    df = spark.range(400).select(F.lit("one").alias("g"), F.col("id").cast("int").alias("at"))
    df = df.unionByName(spark.range(2).select(F.lit("one").alias("g"), (F.col("id") * 50 + 1000).cast("int").alias("at")))
    got = islands(df, ["g"], "at", 1, "start", 13)
    assert sorted(r[0] for r in got.select("start").distinct().collect()) == [0, 1000, 1050]


def test_reposting_groups_are_the_components_of_all_pairs(spark):
    rnd = random.Random(7)
    day = dt.date(2026, 1, 1)
    rows = [(f"j{i:03d}", g, rnd.choice(["x", None, "y"]), None if rnd.random() < 0.1 else day + dt.timedelta(rnd.randrange(200)))
            for i, g in enumerate(hot_groups(rnd, 500))]
    rows += [("same1", "solo", "x", day), ("same2", "solo", "x", day)]
    df = spark.createDataFrame(rows, "job_id string, a string, b string, posted_date date").repartition(5)
    label = {r[0]: r[0] for r in rows}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    pairs = [(p[0], q[0]) for i, p in enumerate(rows) for q in rows[:i]
             if None not in p and None not in q and p[1:3] == q[1:3] and abs((p[3] - q[3]).days) <= 7]
    for p, q in pairs:
        a, b = sorted((find(p), find(q)))
        label[b] = a
    members = {}
    for r in rows:
        members.setdefault(find(r[0]), []).append(r)
    want = {r[0]: (g, len(m), min(x[3] for x in m), max(x[3] for x in m)) for g, m in members.items() if len(m) > 1 for r in m}
    for partitions in (1, 9):
        got = reposting_groups(df, ("a", "b"), partitions=partitions)
        assert {r.job_id: tuple(r)[1:] for r in got.collect()} == want
    assert reposting_groups(df.limit(0), ("a", "b")).count() == 0


def test_quantiles_of_many_groups_at_once(spark):
    rnd = random.Random(3)
    rows = [(g, rnd.randrange(50) * 10) for g in hot_groups(rnd, 900)]
    counts = spark.createDataFrame([(g, v, 1) for g, v in rows], "g string, v int, n int").repartition(6)
    for q, partitions in ((0.5, 1), (0.5, 11), (0.25, 7)):
        got = {r.g: (r.m_n, r.m) for r in grouped_quantile(counts, ["g"], "v", "n", q, "m", partitions).collect()}
        for g in {g for g, _ in rows}:
            mine = sorted(v for h, v in rows if h == g)
            at = (len(mine) - 1) * q
            want = mine[int(at)] + (at % 1) * (mine[min(int(at) + 1, len(mine) - 1)] - mine[int(at)])
            assert got[g] == (len(mine), pytest.approx(want))
            assert q != 0.5 or want == statistics.median(mine)


def test_key_sets_merge_and_count_exactly(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(6), rnd.choice([None, *range(1, 100_000, 997)])) for _ in range(800)]
    df = spark.createDataFrame(rows, "day int, k long")
    sets = keysets.key_bitmaps(df, "k", ("day",))
    for days in ({0}, {1, 2}, set(range(6)), {9}):
        want = len({k for d, k in rows if d in days and k is not None})
        assert keysets.key_count(sets.where(F.col("day").isin(list(days))), "n").first()[0] == want
    per_day = {r["day"]: r["n"] for r in keysets.key_count(sets, "n", ("day",)).collect()}
    assert per_day == {d: len({k for e, k in rows if e == d and k}) for d in {d for d, _ in rows}}
    known = spark.range(1, 50_000).select(F.col("id").alias("k"))
    orphans = keysets.orphan_key_count(keysets.key_bitmaps(df, "k"), keysets.key_bitmaps(known, "k")).first()[0]
    assert orphans == len({k for _, k in rows if k and k >= 50_000})


LITERALS = ["SQL", "C++", ".NET", "Power BI", "power  bi", "T-SQL", "c", "a.b.c", "é", "naïve sql", "++", "(x)", "R&D", "sql sql",
            "Data-Warehouse 2.0", "[a-z]+", "", None]
BITS = ["SQL", "sql", "C++", "C+++", "c", ".NET", "x.NET", "..net", "Power BI", "power  bi", "POWER BI9", "T-SQL", "É", "é", "naïve sql",
        "(x)", "((x))", "r&d", "R&Dx", "sql sql sql", "data-warehouse 2.0", "a.b.c", "a.b.cd", "_sql_", "[a-z]+", " ", ", ", "", "1", "x"]


def test_dictionary_matches_like_a_regex_per_pair(spark):
    rnd = random.Random(11)
    texts = [None, "", *LITERALS[:-1], *BITS] + ["".join(rnd.choice(BITS) + rnd.choice(["", " ", "-", "\n"]) for _ in range(rnd.randint(1, 12)))
                                                 for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    terms = spark.createDataFrame(list(enumerate(LITERALS)), "term_id int, literal string")
    got = {tuple(r) for r in match_dictionary(df, "id", "text", terms).collect()}
    want = {(i, j) for i, t in enumerate(texts) if t is not None for j, lit in enumerate(LITERALS)
            if lit and re.search("[A-Za-z0-9]", lit) and re.search(word_regex([lit]), t, re.ASCII)}
    assert got == want
    assert "rlike literal" not in match_dictionary(df, "id", "text", terms)._jdf.queryExecution().toString().lower()
    assert match_dictionary(df, "id", "text", terms.limit(0)).count() == 0


@pytest.mark.parametrize("heads", [0, 64])
def test_dictionary_with_shared_terms_and_literals(spark, heads, monkeypatch):
    """Terms of one and of several literals, literals of many terms, NULL and repeated keys; with few first words and with many."""
    monkeypatch.setattr(dictionary, "HEADS", heads)
    rnd = random.Random(heads)
    texts = [(i % 40 or None, "".join(rnd.choice(BITS) + rnd.choice([" ", "-", "\n", "\r\n"]) for _ in range(rnd.randint(1, 9))))
             for i in range(120)]
    named = [(rnd.randrange(9) or None, rnd.choice(LITERALS)) for _ in range(60)] + [(100, "sql"), (100, "sql"), (101, "SQL"), (102, "C++")]
    df = spark.createDataFrame(texts, "id int, text string")
    terms = spark.createDataFrame(named, "term_id int, literal string")
    got = [tuple(r) for r in match_dictionary(df, "id", "text", terms).collect()]
    want = {(i, j) for i, t in texts for j, lit in named
            if lit and re.search("[A-Za-z0-9]", lit) and re.search(word_regex([lit]), t, re.ASCII)}
    assert len(got) == len(set(got)) and set(got) == want
    once = spark.createDataFrame([(100, "sql"), (101, "SQL"), (102, "a.b.c")], terms.schema)
    plan = match_dictionary(df, "id", "text", once)._jdf.queryExecution().optimizedPlan().toString()
    # What is made distinct is texts and literals; their terms are joined in after it.
    assert plan.lstrip().startswith("Project") and plan.index("Join") < plan.index("Aggregate")


def test_collated_companies_are_one_and_looked_up_once(spark):
    rows = [("1", "Société", "société"), ("2", "SOCIETE", "societe"), ("3", "Other", "other"), ("4", None, None), ("5", "Sociêté", "sociêté")]
    stg = spark.createDataFrame(rows, "job_id string, company_name string, company_normalized string")
    dim = mart.dim_company(stg, "UNICODE_CI_AI")
    assert sorted((r.company_id, r.company_normalized) for r in dim.collect()) == [(1, "other"), (2, "societe")]
    assert mart.dim_company(stg).count() == 4
    got = {r.job_id: r.company_id for r in mart.lookup_company(stg, dim, "UNICODE_CI_AI").collect()}
    assert got == {"1": 2, "2": 2, "3": 1, "4": None, "5": 2}


def test_only_differing_leaves_are_read(spark):
    a = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 11).alias("v"))
    b = a.withColumn("v", F.when(F.col("k") == 77, 99).otherwise(F.col("v"))).where("k <> 1500")
    left, right = (parity.store_leaves(df, ["k"], 32, name) for df, name in ((a, "a"), (b, "b")))
    leaves = parity.differing_leaves(left[1], right[1])
    want = spark.createDataFrame([(77,), (1500,)], "k long").select(parity.leaf_of(["k"], 32)).distinct().collect()
    assert leaves == sorted(r[0] for r in want)
    found = parity.locate_differences_in_leaves(left, right)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, parity.locate_differences(a, b).collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") >= 4 and plan.count("PartitionFilters: [_leaf") == plan.count("FileScan")
    assert parity.locate_differences_in_leaves(left, left).count() == 0


def test_a_changed_copy_is_no_match(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    assert copy_check(df, df.repartition(3)).first()["status"] == "MATCH"
    assert copy_check(df, spark.createDataFrame([(1, None), (2, "a")], df.schema)).first()["status"] == "MISMATCH"
    assert copy_check(df, df.limit(1)).first()["status"] == "MISMATCH"
