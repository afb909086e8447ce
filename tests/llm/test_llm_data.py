"""Operators on sources, shards, archives, chats and labels, and the pipeline."""

import gzip
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from jobstar.llm import histogram_sort, pu_toxicity, warc_normal
from jobstar.llm.histogram_sort import histogram_sort_shards
from jobstar.llm.pareto_mix import mix, pareto_copies, source_targets
from jobstar.llm.pu_toxicity import fit_model, held_out, score_toxicity
from jobstar.llm.tool_links import CHAT_SCHEMAS, call_levels, chat_calls, link_tool_calls
from jobstar.llm.warc_normal import inflate, read_index, read_records, records, warc_round_trip
from jobstar.session import scratch_path

SCHEMA = "doc_id long, text string, source string, size string, shard string, k1 string, copies int, score int, target string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z", 1, 2, "w") for i, t, s in rows], SCHEMA)


# ---- sharding ----

def test_shards_hold_near_equal_bytes(spark):
    rng = random.Random(1)
    rows = [(i, "t" * rng.randrange(2000) + str(i), "s") for i in range(3000)] + [(5000 + i, "copy " * 40, "s") for i in range(1500)]
    got = histogram_sort_shards(frame(spark, rows), shards=7).toPandas()
    assert Counter(got.doc_id) == Counter(i for i, _, _ in rows) and set(got.law) == {"bytes"}
    assert (got["size"] == [len((t or "").encode()) + 16 for t in got.text]).all()
    sizes = got.groupby("shard")["size"].sum()
    mean = sizes.sum() / 7
    assert len(sizes) == 7 and (abs(sizes - mean) <= 2 * (histogram_sort.TOLERANCE * mean + got["size"].max())).all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    # Equal texts stand side by side: they are cut by splitters alone.
    copies = got[got.text.str.startswith("copy")]
    assert copies.shard.max() - copies.shard.min() + 1 == copies.shard.nunique()


def test_shard_edge_cases(spark):
    rows = [(1, None, "s"), (2, "", None), (None, "a", "s"), (None, None, None), (3, "b" * 400_000, "s"), (4, "c", "s"), (4, "c", "s")]
    got = histogram_sort_shards(frame(spark, rows), shards=3, columns=["doc_id", "text", "shard"]).toPandas()
    assert len(got) == len(rows) and got.shard.between(0, 2).all() and got[got.doc_id == 4].shard.nunique() == 1
    assert got[got.doc_id == 1]["size"].item() == 16 and got[got.doc_id == 1].text_crc32.item() == 0
    empty = histogram_sort_shards(frame(spark, []), shards=3)
    assert empty.count() == 0 and "slot" in empty.columns


def test_identical_rows_are_cut(spark):
    """Half the table is one row repeated, with and without identifier."""
    for ident in (7, None):
        rows = [(ident, "the same row" * 3, "s")] * 2000 + [(i, f"{i} words", "s") for i in range(2000)]
        got = histogram_sort_shards(frame(spark, rows).repartition(5), shards=40).toPandas()
        sizes = got.groupby("shard")["size"].sum()
        mean = sizes.sum() / 40
        assert len(sizes) == 40 and len(got) == 4000
        assert (abs(sizes - mean) <= 2 * (histogram_sort.TOLERANCE * mean + got["size"].max())).all()
        for _, g in got.groupby("shard"):
            assert sorted(g.slot) == list(range(len(g)))


def test_shards_follow_the_law_of_a_whole_sort(spark):
    """A brute-force cut of the sorted rows at each multiple of the mean, within the tolerance of the probes."""
    rng = random.Random(8)
    rows = [(rng.choice([None, i]), rng.choice([None, "", "copy " * 30, "x" * rng.randrange(900)]), "s") for i in range(1500)]
    got = histogram_sort_shards(frame(spark, rows).repartition(4), shards=9).toPandas()
    got = got.sort_values(["shard", "slot"])
    ends = got["size"].cumsum()
    total, slack = got["size"].sum(), histogram_sort.TOLERANCE * got["size"].sum() / 9 + got["size"].max()
    for i in range(1, 9):
        assert abs(ends[got.shard < i].max() - total * i / 9) <= slack


# ---- mixing ----

def filled(sizes, weights, share, cap):
    """Targets by resharing what is over, round after round."""
    total, out, open_ = sum(sizes.values()) * share, dict.fromkeys(sizes, 0.0), [s for s in sizes if sizes[s]]
    left = total
    while open_ and left > 1e-9:
        w = sum(weights[s] for s in open_)
        give = {s: left * weights[s] / w for s in open_}
        left = 0.0
        for s in list(open_):
            out[s] += give[s]
            if out[s] >= cap * sizes[s]:
                left += out[s] - cap * sizes[s]
                out[s] = cap * sizes[s]
                open_.remove(s)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_targets_are_reshared(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 5, 100, 1000, 20_000]) for i in range(9)} | {None: 300}
    order = sorted((s for s in sizes if s), key=str) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    want = filled(sizes, weights, 1.5, 2)
    assert all(abs((got[s] or 0) - want[s]) < 1e-6 * max(1, want[s]) for s in sizes), (got, want)


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 60), f"s{int(rng.random() ** 2 * 6)}") for i in range(4000)]
    rows += [(9000, None, "s0"), (9001, "", None), (9002, "a b", None), (None, "a b c", "s1"), (9003, "q " * 100_000, "big"), (9004, "r", "s2"), (9004, "r", "s2")]
    got = pareto_copies(frame(spark, rows)).select("doc_id", "text", "source", "size", "source_size", "target", "copies", "taken").toPandas()
    again = pareto_copies(frame(spark, rows).repartition(3)).select("doc_id", "taken").toPandas()
    assert Counter(zip(got.doc_id.fillna(-1), got.taken)) == Counter(zip(again.doc_id.fillna(-1), again.taken))
    assert len(got) == len(rows) and (got["size"] == [len((t or "").split()) for t in got.text]).all()
    assert (got.taken <= 2 * got["size"]).all() and (got.taken == got["size"] * got.copies).all()
    for _, g in got.groupby("source", dropna=False):
        assert g["size"].sum() == g.source_size.iloc[0]
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
    mixed = mix(frame(spark, rows))
    assert mixed.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert mixed.count() == got.copies.sum() and {r["size"] for r in mixed.collect()} == {"x"}
    assert pareto_copies(frame(spark, [])).count() == 0


def test_rows_without_identifier_or_repeated_draw_on_their_own(spark):
    for rows in ([(None, "w " * 10 + str(i), "a") for i in range(2000)], [(5, "w " * 11, "a")] * 2000, [(None, "w " * 11, "a")] * 2000):
        rows = rows + [(i, "v " * 11, "b") for i in range(10_000, 12_000)]
        got = pareto_copies(frame(spark, rows).repartition(6)).toPandas()
        assert len(got) == len(rows)
        for _, g in got.groupby("source"):
            assert abs(g.taken.sum() - g.target.iloc[0]) <= 11
        again = pareto_copies(frame(spark, rows).repartition(3)).toPandas()
        assert Counter(zip(got.doc_id.fillna(-1), got.text, got.taken)) == Counter(zip(again.doc_id.fillna(-1), again.text, again.taken))


def test_the_cut_is_that_of_sorted_odds(spark):
    """Brute force: sort a source's fractional copies by odds, take from the least until the words are nearest."""
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(1, 9), rng.choice("abc")) for i in range(900)]
    got = pareto_copies(frame(spark, rows)).toPandas()
    for _, g in got.groupby("source"):
        share = g.target.iloc[0] / g.source_size.iloc[0]
        extra = g.copies - int(share)
        assert extra.isin([0, 1]).all()
        words = (g["size"] * g.copies).sum()
        assert abs(words - g.target.iloc[0]) <= g["size"].max() / 2 + 1


def test_weights_raise_the_odds(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(2000)]
    got = pareto_copies(frame(spark, rows).withColumn("q", F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0)), weight=F.col("q"), share=0.5).toPandas()
    taken = got.groupby(got.doc_id % 4 < 2).taken.sum()
    assert taken[True] > 1.5 * taken[False]


@pytest.mark.parametrize("sources", [("void", "s"), (None, "void")])
def test_mix_of_a_source_without_words(spark, sources):
    void, other = sources  # the first without words
    rows = [(1, None, void), (2, "", void), (3, " \t\n", void)]
    rows += [(i, "a b c", other) for i in range(10, 60)]
    got = pareto_copies(frame(spark, rows)).toPandas()
    of_void = got[got.doc_id < 10]
    assert len(got) == len(rows) and (of_void[["size", "source_size", "target", "copies", "taken"]] == 0).all(axis=None)
    rest = got[got.doc_id >= 10]
    assert abs(rest.taken.sum() - 1.5 * rest["size"].sum()) <= 3
    mixed = mix(frame(spark, rows))
    assert mixed.where("doc_id < 10").count() == 0 and mixed.count() == got.copies.sum()


# ---- archives ----

PAGES = "page_id long, url string, html string, payload string, digest int"


def test_warc_round_trip_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(warc_normal, "READ_BYTES", 700)  # chunks end inside headers and blocks
    big = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", big), (None, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"),
            (8, "u", "z" * 3_000_000), (9, "u", "y" * 2000), (9, "u", "y" * 2000)]
    pages = spark.createDataFrame([(i, u, h, "p", 1) for i, u, h in rows], PAGES).repartition(3)
    folder = scratch_path(spark, "warc-test")
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc_round_trip(pages, folder).collect())
    n = len(big.encode())
    assert got == Counter({(1, n, "revisit", 3): 1, (2, n, "revisit", 3): 1, (3, n, "response", None): 1, (None, n, "revisit", 3): 1,
                           (4, 0, "response", None): 1, (5, 0, "response", None): 1, (6, 5, "response", None): 1, (7, 5, "response", None): 1,
                           (8, 3_000_000, "response", None): 1, (9, 2000, "response", None): 2})
    index = read_index(spark, f"{folder}/records")
    back = read_records(index.where("page_id = '3'"), with_payload=True).collect()
    assert [r["payload"] for r in back] == [big]
    assert {r["url"] for r in read_records(index).where("page_id = 1").collect()} == {"http://a/%20%20X:%20y"}
    # Each member is a gzip file of its own, and the members are the whole file.
    at = index.orderBy("file", "offset").collect()
    fs = pafs.LocalFileSystem()
    for file in {r["file"] for r in at}:
        data = fs.open_input_file(file.removeprefix("file://")).read()
        own = [r for r in at if r["file"] == file]
        assert sum(r["length"] for r in own) == len(data)
        parts = [gzip.decompress(data[r["offset"]:r["offset"] + r["length"]]) for r in own]
        assert b"".join(parts) == gzip.decompress(data) and all(p.startswith(b"WARC/1.1\r\n") for p in parts)


def test_warc_identifiers_are_whole_numbers(spark):
    pages = spark.createDataFrame([("a", "u", "h")], "page_id string, url string, html string")
    with pytest.raises(ValueError, match="page_id is string"):
        warc_round_trip(pages, scratch_path(spark, "warc-test"))


def test_short_payloads_are_dealt_out(spark):
    pages = spark.createDataFrame([(i, "u", None if i % 2 else "x" * 2000) for i in range(400)],
                                  "page_id long, url string, html string")
    typed = warc_normal.typed_records(pages.repartition(4))
    assert Counter((r.record_type, r.refers_to) for r in typed.collect()) == {("response", None): 201, ("revisit", 398): 199}
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:  # the type comes from the join, so the join can't be left out
        per_task = (warc_normal.typed_records(pages.repartition(4)).where("payload = ''")
                    .groupBy("record_type", F.spark_partition_id().alias("task")).count().collect())
        assert len(per_task) == 8 and max(r["count"] for r in per_task) < 60
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_warc_of_no_pages(spark):
    got = warc_round_trip(spark.createDataFrame([], PAGES), scratch_path(spark, "warc-test"))
    assert got.count() == 0


def test_inflate_reads_members_one_after_the_other():
    data = gzip.compress(b"a" * 5000) + gzip.compress(b"b" * 10)
    assert b"".join(inflate(data[i:i + 7] for i in range(0, len(data), 7))) == b"a" * 5000 + b"b" * 10
    with pytest.raises(ValueError):
        list(records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))
    with pytest.raises(ValueError):
        list(records(iter([b"junk\r\n\r\n"])))


# ---- tool calls ----

CALLS = "conv string, id string, turn long, name string, arguments string, needs array<string>"
RESULTS = "conv string, id string, turn long, content string"


def test_tool_links_edge_cases(spark):
    good = '{ "limit":3, "query":"q\\u00e9", "filters":{"b":1,"a":[1, 2]} }'
    calls = [("c", "a", 1, "search", good, []), ("c", "b", 3, "translate", '{"text":"t","to":7}', ["a", "gone", None]),
             ("c", "d", 2, "summarise", '{"text":"t","loud":true}', ["b", "a"]), ("c", "x", 5, "search", good, ["y"]), ("c", "y", 6, "search", good, ["x"]),
             ("c", "z", 7, "search", good, ["y"]), ("c", "a", 9, "search", "{}", ["d"]), ("e", "a", 1, "other", "{", None),
             ("e", "s", 4, None, None, ["s"]), (None, "a", 1, "search", "[1]", None), ("e", None, 2, "translate", '{"to":"en"}', None)]
    results = [("c", "a", 2, "ok"), ("c", "a", 8, "late"), ("c", "b", 1, "too early"), ("c", "d", 4, None), ("k", "a", 1, 'quote " \n'), (None, "a", 2, "lost")]
    rows = link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), CHAT_SCHEMAS).collect()
    got = {(r["conv"], r["id"], r["kind"]): r for r in rows}
    assert len(rows) == 15 and len(got) == 14  # the call a at turn 9 and its late result are both duplicates
    assert sorted(r["canonical"] for r in rows if r["kind"] == "duplicate") == [
        '{"arguments":{},"id":"a","name":"search","needs":["d"],"result":null}', '{"id":"a","result":"late"}']
    placed = [r["id"] for r in sorted((r for r in rows if r["conv"] == "c" and r["position"] is not None), key=lambda r: r["position"])]
    assert placed == ["a", "b", "d", "x", "y", "z"]
    assert got["c", "a", "linked"]["canonical"] == ('{"arguments":{"filters":{"a":[1,2],"b":1},"limit":3,"query":"qé"},"id":"a",'
                                                    '"name":"search","needs":[],"result":"ok"}')
    assert got["c", "a", "linked"]["valid"] and got["c", "d", "linked"]["errors"] == ["loud is unknown"]
    assert got["c", "b", "unanswered"]["errors"] == ["to is not of type string"] and got["c", "b", "unanswered"]["level"] == 1
    assert got["c", "d", "linked"]["level"] == 2
    assert {k for k in got if k[2] == "circular"} == {("c", "x", "circular"), ("c", "y", "circular"), ("c", "z", "circular"), ("e", "s", "circular")}
    assert got["e", "a", "unanswered"]["errors"] == ["unknown tool", "arguments are not JSON"]
    assert got[None, "a", "unanswered"]["errors"] == ["arguments are not an object"]
    assert got["e", None, "unanswered"]["errors"] == ["text is missing"]
    assert json.loads(got["k", "a", "orphan"]["canonical"]) == {"id": "a", "result": 'quote " \n'}
    assert {("c", "b", "orphan"), (None, "a", "orphan")} <= set(got)
    none = link_tool_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), CHAT_SCHEMAS)
    assert none.count() == 0


def test_every_call_and_result_has_a_row(spark):
    """The first result at or after its call answers it; what else bears the identifier isn't dropped."""
    calls = [("c", "a", 3, "search", "{}", []), ("c", "a", 4, "search", "{}", [])]
    results = [("c", "a", 1, "too early"), ("c", "a", 4, "right"), ("c", "a", 5, "later"), ("c", "a", 4, "right")]
    rows = link_tool_calls(spark.createDataFrame(calls, CALLS).withColumn("called", F.lit(1)),
                           spark.createDataFrame(results, RESULTS).withColumn("known", F.lit(1)), CHAT_SCHEMAS).collect()
    got = Counter((r["kind"], json.loads(r["canonical"])["result"]) for r in rows)
    assert got == Counter([("linked", "right"), ("duplicate", None), ("orphan", "too early"), ("duplicate", "later"), ("duplicate", "right")])
    assert [r["position"] for r in rows if r["kind"] == "linked"] == [0]


def test_long_arguments_keep_their_text(spark):
    calls = spark.range(1).select(F.lit("c").alias("conv"), F.lit("a").alias("id"), F.lit(1).cast("long").alias("turn"), F.lit("summarise").alias("name"),
                                  F.concat(F.lit('{"text":"'), F.repeat(F.lit("x"), 20_100_000), F.lit('"}')).alias("arguments"),
                                  F.array().cast("array<string>").alias("needs"))
    linked = link_tool_calls(calls, spark.createDataFrame([], RESULTS), CHAT_SCHEMAS)
    row = linked.select("errors", F.length("canonical").alias("n"), F.instr("canonical", '"arguments_text":"{').alias("at")).first()
    assert row["errors"] == ["arguments are too long to parse"] and row["n"] > 20_100_000 and row["at"] > 0


def test_chat_calls_against_brute_force(spark):
    conversations = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    calls, results = chat_calls(conversations)
    rows = link_tool_calls(calls, results, CHAT_SCHEMAS).collect()
    turns = {(r["conv_id"], r["turn"]): r for r in conversations.collect()}
    asked = {k for k, r in turns.items() if r["role"] == "assistant"}

    def level(conv, turn):
        half = (conv, turn // 2)
        return 1 + level(*half) if turn > 1 and half in asked else 0

    by_conv = defaultdict(list)
    for conv, turn in asked:
        by_conv[conv].append((level(conv, turn), turn))
    want = {}
    for conv, some in by_conv.items():
        for at, (lev, turn) in enumerate(sorted(some)):
            answered = (conv, turn + 1) in turns and (conv, turn + 1) not in asked
            want[conv, f"{conv}:{turn}"] = ("linked" if answered else "unanswered", at, lev)
    assert {(r["conv"], r["id"]): (r["kind"], r["position"], r["level"]) for r in rows if r["kind"] != "orphan"} == want
    assert sum(r["kind"] == "orphan" for r in rows) == sum((c, t - 1) not in asked for c, t in turns if (c, t) not in asked)
    for r in rows:
        parsed = json.loads(r["canonical"])
        assert r["canonical"] == json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        if r["kind"] != "orphan":
            assert r["valid"] == (not r["errors"]) and parsed["id"] == r["id"]


def test_call_levels_of_a_chain(spark):
    calls = spark.createDataFrame([("c", str(i), [str(i - 1)] if i else []) for i in range(12)], "conv string, id string, needs array<string>")
    assert {int(r["id"]): r["level"] for r in call_levels(calls).collect()} == {i: i for i in range(12)}


# ---- toxicity ----

def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = fit_model(docs, labels)
    got = score_toxicity(docs, model).join(labels.where(held_out()), "doc_id").select("score", "predicted", "toxic").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert len(got) > 1000 and toxic.predicted.mean() > 0.85 and clean.predicted.mean() < 0.02
    rank = got.score.rank().to_numpy()
    auc = (rank[got.toxic == 1].mean() - (len(toxic) + 1) / 2) / len(clean)
    assert auc > 0.97
    # Held-out labels sway nothing.
    other = labels.withColumn("toxic", held_out().cast("int"))
    assert fit_model(docs, labels.where(~held_out())).weights == model.weights and other.count() > 0


def test_toxicity_edge_cases(spark):
    rows = [(i, f"clean words number {i}" if i % 5 else f"awful words number {i}", "s") for i in range(300)]
    rows += [(400, None, "s"), (401, "", None), (None, "awful", "s"), (402, "awful " * 100_000, "s"), (7, rows[7][1], "s"), (7, rows[7][1], "s")]
    labels = spark.createDataFrame([(i, int(i % 5 == 0), "x") for i in range(200)] + [(None, 1, "x"), (3, None, "x"), (10, 1, "y")], "doc_id long, toxic int, text string")
    docs = frame(spark, rows)
    got = score_toxicity(docs, fit_model(docs, labels))
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]
    p = got.toPandas()
    assert len(p) == len(rows) and p.score.between(0, 1).all()
    assert p[p.text.fillna("").str.startswith("awful words")].predicted.mean() > 0.95 and p[p.text.fillna("").str.startswith("clean")].predicted.max() == 0
    # No label, or no document: a model without weights.
    assert fit_model(docs, labels.limit(0)).weights == {} and fit_model(frame(spark, []), labels).weights == {}
    assert score_toxicity(frame(spark, []), fit_model(docs, labels.limit(0))).count() == 0


def test_negative_risk_is_corrected():
    """Positives that fill the unlabelled sample would drive a plain estimate below zero."""
    texts = [f"bad{i % 3} thing" for i in range(60)] + [f"bad{i % 3} thing" for i in range(20)] + ["good thing"] * 100
    used, weight, bias, slope = pu_toxicity.train(texts, np.arange(180) < 60, 0.2)
    assert np.isfinite(weight).all() and np.isfinite([bias, slope]).all() and np.abs(weight).max() < 50


# ---- pipeline ----

def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "decontamination", "mixing", "sharding"]
    extra = docs.withColumn("score", F.lit("x")).withColumn("n_hit", F.lit("y")).withColumn("size", F.lit("z"))
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:4]:
        extra = corpus_pipeline.materialize(stage(spark, extra, folder), "test-stage")
        assert extra.columns == [*docs.columns, "score", "n_hit", "size"]
        now = extra.count()
        assert name == "mixing" or 0.5 * before < now < before
        before = now
    last = corpus_pipeline.STAGES[4][1](spark, extra, folder)
    assert last.count() == before and {"shard", "slot"} <= set(last.columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


STAGE_DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, hit_spans string"


def test_stages_on_nulls_repeats_and_long_texts(spark):
    """Each stage on rows without identifier or text, repeated rows, and identifiers that name two texts."""
    folder = "/root/testdata/sf0.01"
    long = " ".join(f"word{i}" for i in range(40_000))
    texts = [None, "", "   ", "one two three four five six seven", long, long + " end", "quite another text that stands alone here"]
    rows = [(i, t, None, s, None, "x", "y") for t in texts for i in (None, 1, 2) for s in (None, "s")]
    docs = spark.createDataFrame(rows + rows[:4], STAGE_DOCS).repartition(4)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert set(STAGE_DOCS.split()[::2]) <= set(out.columns)
        n = out.count()
        if name == "ngram_jaccard":
            # The long texts are near duplicates; texts without words have none and all stay.
            assert n == len([r for r in rows + rows[:4] if not (r[1] or "").strip()]) + 3
        if name == "sharding":
            assert n == docs.count()
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_jaccard_judges_rows_and_not_identifiers(spark):
    copy = "the same text of more than five words in several rows"
    unique = "a text of its own that nobody else has at all"
    rows = [(1, copy), (5, copy), (5, unique), (None, copy), (None, copy), (None, "another one without an identifier of its own kind"),
            (None, "two rows without identifiers share this long text"), (None, "two rows without identifiers share this long text")]
    docs = spark.createDataFrame([(i, t, "l", "s", 1, "x", "y") for i, t in rows], STAGE_DOCS).repartition(3)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.jaccard(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, copy), (5, unique), rows[5], rows[6]], key=str)


def shingled(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_jaccard_and_decontamination_against_brute_force(spark):
    folder = SF_SMALL
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    sets, label = [shingled(r.text) for r in rows], list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    want = {rows[i].doc_id for i in range(len(rows)) if find(i) == i}
    kept = corpus_pipeline.materialize(corpus_pipeline.jaccard(spark, docs, folder), "kept")
    assert {r.doc_id for r in kept.collect()} == want and kept.count() == len(want)

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower() if (text or "").isascii() else (text or "").translate(
            str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))

    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    clean = {r.doc_id for r in kept.collect() if not any(
        tuple(words(r.text)[i:i + n]) in windows for n in sizes for i in range(len(words(r.text)) - n + 1))}
    assert {r.doc_id for r in corpus_pipeline.decontamination(spark, kept, folder).collect()} == clean
