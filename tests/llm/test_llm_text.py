"""Operators on texts: near and exact duplicates, lines, contamination, secrets."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from jobstar.llm import content_sort, fm_index, guess_cost, line_runs, ngram_join, queries
from jobstar.llm.common import numbered
from jobstar.llm.content_sort import content_sort_groups
from jobstar.llm.fm_index import Phrases, _mark, find_contamination
from jobstar.llm.guess_cost import base_spans, guess_bits, scan_secrets
from jobstar.llm.line_runs import LineRuns, dedup_lines
from jobstar.llm.ngram_join import ngram_components, ngram_links
from jobstar.llm.signature_tree import SignatureTree, bitmap_bits, candidate_pairs, linked, own_components
from oracle_compare import compare, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# doc_id, text, and columns named like those that operators add or use inside.
SCHEMA = "doc_id long, text string, source string, size string, score string, h string, id string, n_words int, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "x", "y", "z", "w", 1, 2) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, con, name):
    problems, n = compare(queries.queries()[name](spark, SF_SMALL), con, queries.SQL[name])
    assert not problems and n > 0, problems


# ---- n-gram join ----

def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute_components(rows):
    """``{row number: (n, component)}`` with identifiers as in the operator's docstring."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        seen = Counter(j for g in s for j in holders[g])
        for j, k in seen.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(i)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)].append(d)
    return Counter((d, len(sets[i]), min(ids[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows))


def near_copies(rng, words, n, share):
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(int(len(words) * share)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("small_blocks", [False, True])
def test_ngram_join_is_exact(spark, monkeypatch, small_blocks):
    if small_blocks:  # blocks of a few sets, so that groups are joined across blocks
        monkeypatch.setattr(ngram_join, "BLOCK_SETS", 4)
        monkeypatch.setattr(ngram_join, "FLUSH", 500)
        monkeypatch.setattr(ngram_join, "OFTEN", 3)
    rng = random.Random(5)
    texts = []
    for n, share in ((40, 0.01), (12, 0.03), (12, 0.06), (3, 0.0)):
        texts += near_copies(rng, [f"f{n}x{rng.randrange(9999)}" for _ in range(120)], n, share)
    passage = " ".join(f"p{i}" for i in range(70))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.choice([0, 20, 40, 200]))) for _ in range(25)]
    texts += ["one two", "ONE  two", "one two three", "", None, " \t\n", "a b c d e", "A B C D E", "x " * 20_000]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "only here without id"), (3, texts[3]), (3, texts[3])]
    rng.shuffle(rows)
    got = Counter(tuple(r) for r in ngram_components(frame(spark, rows)).collect())
    assert got == brute_components(rows)


def brute_links(rows):
    sets = [shingles(t) for _, t in rows]
    near = lambda a, b: bool(a) and 100 * len(a & b) >= 75 * len(a | b)
    return Counter((d, sum(near(s, o) for k, o in enumerate(sets) if k != i)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_ngram_join_counts_every_link(spark, monkeypatch):
    # Groups of linked texts within a block and over many blocks and size classes, with copies.
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    rng = random.Random(7)
    texts = [f"a b c d e f g h i j k l m n o p q r s t {i}" for i in range(6)]
    for n, share in ((45, 0.01), (6, 0.03)):
        base = [f"f{n}x{rng.randrange(9999)}" for _ in range(120)]
        texts += [t + " more" * rng.randrange(2) + " ".join(f" y{rng.randrange(9)}{k}" for k in range(rng.choice([0, 0, 15, 30, 60])))
                  for t in near_copies(rng, base, n, share)]
    rows = list(enumerate(texts)) + [(900, None), (901, "  "), (902, "alone"), (None, texts[0]), (3, texts[3]), (903, texts[9].upper())]
    got = ngram_links(frame(spark, rows)).toPandas()
    want = brute_links(rows)
    assert Counter((None if d != d else int(d), k) for d, k in zip(got.doc_id, got.n_links)) == want
    assert want[(902, 0)] == 1 and max(k for _, k in want) > 8 and len({k for _, k in want}) > 5


def test_ngram_join_of_given_documents_and_of_none(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = Counter(tuple(r) for r in ngram_components(docs).collect())
    assert got == brute_components([tuple(r) for r in docs.collect()])
    empty = ngram_components(frame(spark, []))
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.count() == 0


def test_components_of_a_chain_and_a_cross(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)]
    got = dict(ngram_join.connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 200}


@pytest.mark.parametrize("seed", range(8))
def test_signature_tree_loses_no_link(seed):
    rng = np.random.default_rng(seed)
    new = lambda k: rng.integers(0, 1 << 63, k, dtype=np.uint64)
    sets = []
    for _ in range(12):
        base = np.unique(new(rng.integers(1, 300)))
        for _ in range(rng.integers(1, 12)):
            s = np.unique(np.concatenate([base[rng.random(len(base)) > rng.random() * 0.25], new(int(rng.integers(0, 1 + len(base) // 8)))]))
            if len(s):
                sets.append(s)
    sets = [sets[i] for i in rng.permutation(len(sets))]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    assert own_components(sets).tolist() == label
    cut = max(1, len(sets) // 3)
    bits = bitmap_bits(np.array([len(s) for s in sets]))
    a, b = SignatureTree(sets[:cut], bits), SignatureTree(sets[cut:], bits)
    found = {(int(a.order[i]), int(b.order[j])) for i, j in zip(*candidate_pairs(a, b))}
    assert found >= {(i, j) for i in range(cut) for j in range(len(sets) - cut) if linked(sets[i], sets[cut + j])}


# ---- decontamination ----

@pytest.mark.parametrize("seed", range(12))
def test_fm_index_marks_every_occurrence(seed):
    rng = random.Random(seed)
    alphabet = "abcdefgh"
    items = [(str(i), " ".join(rng.choice(alphabet[:rng.choice([2, 4, 8])]) for _ in range(rng.choice([1, 3, 10, 12, 30]))).encode())
             for i in range(5)]
    docs = []
    for _ in range(20):
        words = [rng.choice(alphabet + "zQ") for _ in range(rng.choice([0, 1, 5, 60]))]
        if rng.random() < 0.6:
            words += rng.choice(items)[1].decode().split()
        docs.append(" ".join(words).encode())
    for doc, (n, spans, found) in zip(docs, _mark(docs, Phrases(items))):
        w = doc.decode().lower().split()
        hit, named = [0] * len(w), set()
        for i, t in items:
            p = t.decode().split()
            size = min(10, len(p))
            for a in range(len(p) - size + 1):
                for b in range(len(w) - size + 1):
                    if w[b:b + size] == p[a:a + size]:
                        named.add(i)
                        hit[b:b + size] = [1] * size
        assert (n, found) == (len(w), sorted(named))
        assert [k for b, e in spans for k in range(b, e)] == [k for k, x in enumerate(hit) if x]


def test_contamination_edge_cases(spark, monkeypatch):

    passage = " ".join(f"q{i}" for i in range(12))
    rows = [(1, passage.upper()), (1, passage.upper()), (2, None), (3, ""), (None, "x " + passage), (4, "short ITEM here"),
            (5, "w " * 300_000 + passage), (6, " ".join(f"q{i}" for i in range(9)))]
    items = spark.createDataFrame([(7, passage), (7, "short item"), (8, None), (9, " ,; "), (None, "w w")], "item_id long, text string")
    want = {(1, 12, 12, "7"), (2, 0, 0, ""), (3, 0, 0, ""), (None, 13, 12, "7"), (4, 3, 2, "7"), (5, 300_012, 300_012, "7"), (6, 9, 0, "")}  # "w w" has no identifier and hits all the same
    for words in (fm_index.BLOCK_WORDS, 1):  # the second: each item in a block of its own
        monkeypatch.setattr(fm_index, "BLOCK_WORDS", words)
        got = find_contamination(frame(spark, rows), items).select("doc_id", "n_words", "n_hit", "hit_items", "n_items", "source").collect()
        assert len(got) == len(rows) and {(r[0], r[1], r[2], ",".join(r[3])) for r in got} == want
        assert all(r[4] == len(r[3]) + (r[0] == 5) and r[5] == "s" for r in got)
    none = find_contamination(frame(spark, rows), items.limit(0))
    assert {(r["n_words"], r["n_hit"]) for r in none.where("doc_id = 1").collect()} == {(12, 0)}
    assert find_contamination(frame(spark, []), items).count() == 0


@pytest.mark.parametrize("words", [1, 3, 50, 1000])
def test_pieces_hold_every_window_of_an_item(words):
    rnd = random.Random(words)
    for n in (0, 1, 9, 10, 11, 40, 200):
        text = b" -- ".join(rnd.choice([b"Ab", "é漢".encode(), b"7", b"longer"]) + str(i).encode() for i in range(n))
        whole = Phrases([("a", text)])
        parts = Phrases([("a", t) for t in fm_index.pieces(text, words)])
        own = lambda p: {tuple(np.append(0, p.words)[r]) for r in p.symbols}
        assert own(whole) == own(parts) and whole.item_ids == parts.item_ids


# ---- exact duplicates ----

@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_content_sort_edge_cases(spark, monkeypatch, keep):
    monkeypatch.setattr(content_sort, "HOT_SHARE", 3)  # the common text is a hot one
    rows = [(i, "The Same") for i in range(40)] + [(50, "the same"), (51, "thé same"), (52, "THÉ SAME"), (53, None), (54, ""),
            (None, "the same"), (None, "alone"), (None, "alone"), (60, "a" * 500_000), (61, "A" * 500_000), (62, "twice"), (62, "twice")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    pick = min if keep == "smallest" else max
    want = Counter()
    for t, ids in groups.items():
        best = pick((i for i in ids if i is not None), default=None)
        want.update((i, best, len(ids), i == best, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    got = content_sort_groups(frame(spark, rows), keep=keep)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert content_sort_groups(frame(spark, []), keep=keep).count() == 0


@pytest.mark.parametrize("head", [1024, 8])
def test_splitters_part_rows_by_content_and_shared_heads_by_hash(spark, monkeypatch, head):
    monkeypatch.setattr(content_sort, "HEAD_CHARS", head)
    monkeypatch.setattr(content_sort, "_PREFIXES", (2, 4, head))
    # A third begins alike and differs late; others share shorter heads or are cut by bytes beyond ASCII.
    texts = ["common " * 3 + str(i) for i in range(300)] + [f"{c}{i}" for c in "aézß漢😀" for i in range(100)] + ["", ""]
    norm = spark.createDataFrame([(t,) for t in texts], "norm string")
    splitters = content_sort.sampled_splitters(norm, 9, 1.0)
    starts = [s.encode() for s, _ in splitters]
    assert starts == sorted(set(starts)) and 5 <= len(starts) <= 9
    assert any(full for _, full in splitters) == (head == 8)
    bucket, full = content_sort.bucket_of(F.col("norm"), splitters)
    got = norm.select("norm", bucket.alias("b"), full.alias("f")).collect()
    assert all(r.b == sum(s <= r.norm.encode() for s in starts) for r in got)
    sizes = Counter(r.b for r in got if not r.f)
    assert max(sizes.values()) <= 2 * len(texts) / 9
    assert all(r.f for r in got if r.norm.startswith("common ")) == (head == 8)


@pytest.mark.parametrize("head", [1024, 4])
def test_content_sort_of_many_partitions_equals_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(content_sort, "HEAD_CHARS", head)
    monkeypatch.setattr(content_sort, "_PREFIXES", (2, head))
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["long head ", "long tail ", "é", ""]) + str(rnd.randrange(120))) for i in range(600)]
    rows += [(1000 + i, "Hot") for i in range(200)]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t.translate(LOWER)].append(i)
    want = {(i, max(ids), len(ids)) for ids in groups.values() for i in ids}
    got = content_sort_groups(frame(spark, rows), keep="largest")
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got.collect()} == want


# ---- lines ----

def brute_lines(rows):
    key = lambda line: line.strip("\t\n\x0b\x0c\r ").translate(LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        if i is None:
            kept = [x for x in lines if len(key(x)) < 10 or not holders[key(x)]]
        else:
            kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_line_runs_edge_cases(spark, batches):
    rng = random.Random(batches)
    pool = [f"line number {i} of the pool" for i in range(30)] + ["short", "", "  ", "ééééééééé", "éééééééééé"]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\r", "\t\x0b"]) for _ in range(rng.choice([0, 1, 5, 20])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "Line Number 1 of the pool\nonly without an id"), (None, "only without an id"),
             (103, "twice the same row\ntwice the same row"), (103, "twice the same row\ntwice the same row"),
             (104, "\n".join(f"a long text's line {i}" for i in range(20_000)) + "\nline number 3 of the pool")]
    got = dedup_lines(frame(spark, rows), batches=batches)
    assert Counter(tuple(r) for r in got.collect()) == brute_lines(rows)
    assert dedup_lines(frame(spark, []), batches=batches).count() == 0


def test_line_runs_are_levelled(spark):
    runs = LineRuns(spark, fanout=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(i, i, None, False)], "h1 long, h2 long, owner long, old boolean"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r["h1"] for r in runs.seen().collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        LineRuns(spark, fanout=1)


def test_line_runs_are_merged_as_they_lie(spark, tmp_path):
    """Keys of a batch meet older runs without an exchange or a sort on either side."""
    spark.range(3000).selectExpr("id AS h1", "id % 7 AS h2", "id").write.parquet(str(tmp_path / "k"))
    keys = spark.read.parquet(str(tmp_path / "k"))
    runs = LineRuns(spark, fanout=3)

    def stored(lo, hi):
        return line_runs.store_run(keys.where(f"id >= {lo} AND id < {hi}").groupBy("h1", "h2").agg(F.min("id").alias("owner")), "keys")

    with line_runs.sorted_buckets(spark):
        for lo in (0, 1000):
            runs.add(runs.unseen(stored(lo, lo + 1000)))
        left = runs.unseen(stored(500, 2600))
        text = left._jdf.queryExecution().executedPlan().toString()
        assert text.count("SortMergeJoin") == 2 and "Exchange" not in text and "Sort [" not in text
        assert left.count() == 600
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"


def test_components_never_end_short(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    with pytest.raises(RuntimeError, match="rounds"):
        ngram_join.connected(chain, max_rounds=2)


def test_items_without_identifier_hit_words(spark):
    text = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(None, text), (None, "twelve words here"), ("b", text[:40])], "item_id string, text string")
    docs = spark.createDataFrame([(1, "so " + text), (2, "twelve words here"), (3, "clean"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.hit_items) for r in find_contamination(docs, items).collect()}
    assert got == {1: (11, 2, ["b"]), 2: (3, 1, []), 3: (0, 0, []), 4: (0, 0, [])}


# ---- secrets ----

def brute_base(text):
    """The contract's patterns as they stand, filtered by length."""
    found = []
    kinds = ((r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A,
              lambda m: len(m[2]) >= 12),
             (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 18), (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 16))
    for kind, (pattern, flags, keep) in enumerate(kinds):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, flags) if keep(m)]
    return sorted(found)


def test_base_spans_follow_the_patterns():
    rng = random.Random(3)
    parts = ["password", "PassWD", "api_key", "apikey", "token", "secret", " ", ":", "=", "'", '"', "AKIA", "ABCDEF0123456789XY",
             "deadbeef", "0123456789abcdef", "é", "ſecret", "toKen", "x", "abc/def+ghi.jkl", "\n"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert base_spans(text) == brute_base(text), text


def test_guess_costs_rank_values():
    cheap = ["password1", "Passw0rd2019", "qwertyuiop", "aaaaaaaaaaaaaaaa", "abcabcabcabc", "20190501", "12345678", "monkeydragon"]
    dear = ["x7$Kq9!mZp2w", "f33e61083db5dbdf4bd2369d2f80176e57f7fda2", "Zr4-kT0vqLw81s"]
    assert max(map(guess_bits, cheap)) < 25 < 40 < min(map(guess_bits, dear))
    assert guess_bits("") == 0 and guess_bits("é") > 0
    # No segmentation costs more than guessing each character, or than cutting at any place.
    for v in cheap + dear:
        assert all(guess_bits(v) <= guess_bits(v[:i]) + guess_bits(v[i:]) + 1e-9 for i in range(len(v)))


def brute_bits(value):
    """All pieces between all places; for lower-case values without words and dates."""
    best = [0.0] + [float("inf")] * len(value)
    for e in range(1, len(value) + 1):
        best[e] = best[e - 1] + guess_cost._char_bits(value[e - 1])
        for i in range(e):
            piece, n = value[i:e], e - i
            steps = {guess_cost._NEXT.get(p, 0) for p in zip(piece, piece[1:])}
            costs = [np.log2(2 * sum(map(len, guess_cost._KEY_ROWS))) + np.log2(n)] if n >= 3 and steps in ({1}, {-1}) else []
            costs += [sum(map(guess_cost._char_bits, piece[:u])) + np.log2(n // u) for u in range(1, min(8, n // 2) + 1)
                      if n >= 3 and n % u == 0 and piece == piece[:u] * (n // u)]
            best[e] = min([best[e], *(best[i] + 1 + c for c in costs)])
    return best[-1]


def test_guess_costs_are_the_least():
    assert guess_bits("asdfghello") < 16  # asdfg and hello, not the longest walk
    rng = random.Random(4)
    for _ in range(300):
        parts = ["qwe", "asdf", "zxcv", "cxz", "x", "q", "xq", "zz", "asd" * 2, "vbn" * 3]
        value = "".join(rng.choice(parts) * rng.choice([1, 1, 2, 5]) for _ in range(rng.randrange(1, 8)))
        assert abs(guess_bits(value) - brute_bits(value)) < 1e-6, value


def test_planted_secrets_are_found_and_prose_is_left_alone(spark):
    """Values that the base patterns miss, among the sentences of the documents themselves."""
    rng = random.Random(12)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!@#$%^&*+-_"
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").limit(400).collect()
    keys = ["pwd: ", "passphrase=", "auth = ", "Credentials: ", "password: ", "private_key=", "passcode is "]
    planted, prose = [], []
    common = ["monday", "whatever", "freedom", "sunshine", "november", "princess"]
    for i, r in enumerate(docs[:150]):
        value = "".join(rng.choice(signs) for _ in range(12)) + "9"
        planted.append((i, f"{r.text} {keys[i % len(keys)]}{value} {r.text}", value))
    words = [w for r in docs for w in (r.text or "").split() if w.isalpha() and len(w) > 2]
    for i in range(300):
        a, b = rng.choice(words), rng.choice(common)
        prose.append((1000 + i, f"the password is {a} and the bypass is {b}, compass: {a}{b} secret: {a} token={b}{i % 10} pwd: {a}{b}"))
    rows = [(i, t) for i, t, _ in planted] + prose + [(5000 + n, r.text) for n, r in enumerate(docs)]
    got = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(any(s.split(":")[0] in ("guess", "assign") and t[int(s.split(":")[1]):int(s.split(":")[2])].endswith(v)
                    for s in got[i].spans.split(",") if s) for i, t, v in planted)
    assert found >= 0.9 * len(planted)
    marked = [i for i, _ in prose if "guess" in got[i].spans]
    assert len(marked) <= 0.02 * len(prose)
    assert sum("guess" in got[5000 + n].spans for n in range(len(docs))) <= 0.01 * len(docs)


def test_corpus_words_are_ranked_by_documents(spark):
    docs = spark.createDataFrame([(i, "Berlin berlin rare" + str(i) + (" tower" if i < 4 else "")) for i in range(9)], "doc_id long, text string")
    words = guess_cost.corpus_words(docs, most=2)
    assert words["berlin"] == 1 and words["rare"] == np.log2(3) and "tower" not in words and words["password"] <= 1
    assert guess_bits("berlintower", words) < guess_bits("berlintower")


def test_secret_scan_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "pwd: x7$Kq9!mZp2w and passphrase is monkeydragon"), (3, "pwd: x7$Kq9!mZp2w and passphrase is monkeydragon"),
            (None, "é token = 'f33e61083db5dbdf4bd2369d2f80176e57f7fda2'"), (4, "pwd=" + "aB3$x" * 20_000)]
    got = Counter((r["doc_id"], r["n_assign"], r["n_hex"], r["spans"]) for r in scan_secrets(frame(spark, rows)).collect())
    assert got == Counter({(1, 0, 0, ""): 1, (2, 0, 0, ""): 1, (3, 0, 0, "guess:5:17"): 2,
                           (None, 1, 1, "assign:2:51,hex:11:51"): 1, (4, 0, 0, ""): 1})
    assert scan_secrets(frame(spark, [])).count() == 0


# ---- numbering ----

def test_numbered_equals_row_number(spark):
    rows = [(g, k) for k in range(300) for g in ("hot", None, f"g{k % 7}")]
    df = spark.createDataFrame(rows, "g string, k long")
    got = numbered(df, "g", ["k"], "at").collect()
    per = defaultdict(list)
    for r in got:
        per[r["g"]].append((r["k"], r["at"]))
    assert len(got) == len(rows)
    for values in per.values():
        assert [a for _, a in sorted(values)] == list(range(len(values)))
