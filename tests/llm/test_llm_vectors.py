"""Hard negatives, byte-level BPE and vector codes against brute force."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from jobstar.llm.chunk_bpe import PieceIds, bpe_decode, bpe_encode, bpe_round_trip, merge_piece, read_ranks
from jobstar.llm.equal_average import Codebook, compress_vectors
from jobstar.llm.gnat_negatives import Tree, mine_hard_negatives

PATTERN = public_tokenizers.PATTERN


def known_first(x):
    return tuple((v is None, v or 0) for v in x)


# ---- byte-level BPE ----

@pytest.fixture(scope="module")
def ranks(spark):
    return read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(encoding, text):
    ids = encoding.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


SIGNS = ["a", "bc", " ", "  ", "\n", "\n\n", "'", "'re", "'ll", "1", "23", "!", "...", "é", "漢字", "😀", " the",
         "x" * 30, " " * 30, "'" * 5, "\t", " ", "\x1c", "<|endoftext|>"]
# Places that a chunk's own split gets wrong, and stretches without a common boundary.
HARD = ["x" * 500, " " * 500, "x" * 200 + " " * 300 + "y" * 300, "a b " * 200 + "q" * 100 + "'re " + "z" * 90, "é" * 300,
        "12" * 200, "\n" * 39 + "b" + "\n" * 41, ("!" * 38 + "'re") * 9, "'" * 90, "漢" * 80 + "。" + "字" * 80, " " * 40 + "x"]


def test_bpe_is_the_library_s_over_many_chunk_edges(spark, ranks, encoding):
    rnd = random.Random(5)
    texts = [None, "", "a", " ", "hello world", *HARD] + [
        "".join(rnd.choice(SIGNS) for _ in range(rnd.randint(1, 300))) for _ in range(150)]
    # Null and repeated identifiers, repeated rows, and columns named like the operator's own.
    rows = [(i % 40 if i % 7 else None, t, 1, "x", "y") for i, t in enumerate(texts + HARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, ids string, id string").repartition(4)
    want = sorted(((r[0], *digest(encoding, r[1])) for r in rows), key=str)
    for chunk, overlap in ((40, 12), (7 + 30, 30)):
        got = bpe_round_trip(docs, ranks, PATTERN, chunk=chunk, overlap=overlap).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_bpe_parts_join_to_the_whole_list_of_ids(spark, ranks, encoding):
    text = "".join(random.Random(3).choice(SIGNS) for _ in range(2000))
    short, long = bpe_encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), ranks, PATTERN, chunk=100, overlap=20)
    parts = sorted(long.collect(), key=lambda r: r["part"])
    assert short.count() == 0 and len(parts) > 10
    assert [i for r in parts for i in r["ids"]] == encoding.encode_ordinary(text)
    data = b"".join(r["data"] for r in sorted(bpe_decode(long, ranks).collect(), key=lambda r: r["part"]))
    assert data.decode() == text


def test_bpe_of_an_empty_table(spark, ranks):
    empty = bpe_round_trip(spark.createDataFrame([], "doc_id long, text string"), ranks, PATTERN)
    assert empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and empty.count() == 0


def test_bpe_merges_one_long_piece(ranks, encoding):
    for piece in ("ab" * 3000, "x" * 5000, "thequickbrown" * 300):
        assert merge_piece(piece.encode(), ranks, max(map(len, ranks))) == encoding.encode_ordinary(piece)


def test_bpe_pieces_of_every_kind_of_character(ranks, encoding):
    known, split = PieceIds(ranks), regex.compile(PATTERN).findall
    for start in range(0, 0x30000, 97):
        text = "".join(f"e{chr(c)}er 1{chr(c)}2" for c in range(start, min(start + 97, 0x30000)) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(b"".join(known[p] for p in split(text)), np.int32).tolist() == encoding.encode_ordinary(text)


def test_bpe_refuses_ranks_without_all_bytes(spark, ranks):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="single byte"):
        bpe_encode(docs, {b"a": 0}, PATTERN)
    with pytest.raises(ValueError, match="overlap"):
        bpe_encode(docs, ranks, PATTERN, chunk=10, overlap=20)


# ---- vector codes ----

def brute_codes(rows, entries=256, rounds=4, parts=4, scale=1024):
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([r[1] for r in kept], np.int64)
    w = x.shape[1] // parts
    books = [x[:entries, p * w:(p + 1) * w].copy() for p in range(parts)]

    def assign():
        for p in range(parts):
            d = ((x[:, None, p * w:(p + 1) * w] - books[p][None]) ** 2).sum(2)
            yield d.argmin(1), d.min(1)

    for _ in range(rounds):
        for p, (a, _) in enumerate(list(assign())):
            for e in set(a.tolist()):
                mine = x[a == e, p * w:(p + 1) * w]
                books[p][e] = [int(s) // len(mine) for s in mine.sum(0)]
    last = list(assign())
    error = sum(d for _, d in last).tolist()
    label = {}
    for (_, _, of), e in zip(kept, error):
        label[of] = label.get(of, 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{a[j]:02x}" for a, _ in last), error[j], label[r[2]], sha) for j, r in enumerate(kept)), key=str)


VECTORS = "vec_id long, embedding array<float>, label int, code string, error string, id int"


def vector_rows(seed, n, dims, ids=60):
    rnd = random.Random(seed)
    values = [None, [float("nan")] * dims, [1.0, None] * (dims // 2), [float("inf")] * dims]
    return [(rnd.choice([None, *range(ids)]),
             rnd.choice([*values, *[[rnd.choice([-1.0, 0.0, 0.5, 1.0, 2.0]) for _ in range(dims)] for _ in range(12)]]),
             rnd.choice([None, 1, 2])) for _ in range(n)]


@pytest.mark.parametrize("entries, rounds", [(7, 4), (256, 2), (1, 1)])
def test_codes_match_brute_force(spark, entries, rounds):
    rows = vector_rows(entries, 300, 8)
    df = spark.createDataFrame([(*r, "c", "e", 1) for r in rows], VECTORS).repartition(5)
    coded = compress_vectors(df, entries=entries, rounds=rounds)
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in coded.collect()]
    assert sorted(got, key=str) == brute_codes(rows, entries, rounds)


def test_codes_of_no_rows_and_of_ragged_vectors(spark):
    df = spark.createDataFrame([(1, [1.0] * 8, 1, "", "", 1), (2, [1.0] * 4, 1, "", "", 1), (3, None, 1, "", "", 1)], VECTORS)
    assert compress_vectors(df.limit(0)).count() == 0
    assert compress_vectors(df.where("vec_id = 3")).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        compress_vectors(df)


def test_equal_average_search_is_exact_with_ties():
    rnd = np.random.default_rng(4)
    for dims in (1, 3, 16):
        entries = rnd.integers(-3, 4, (60, dims))
        entries[30:40] = entries[:10]
        parts = rnd.integers(-4, 5, (500, dims))
        which, best = Codebook(entries).nearest(parts)
        d = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (which == d.argmin(1)).all() and (best == d.min(1)).all()


# ---- hard negatives ----

def brute_negatives(rows, is_anchor, positives=5, negatives=10):
    kept = [(i, [int(np.floor(float(x) * 256)) for x in v], label) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([k[1] for k in kept], np.int64).reshape(len(kept), -1)
    out = []
    for a, (i, _, label) in enumerate(kept):
        if i is None or not is_anchor(i):
            continue
        score = (x @ x[a]).tolist()
        order = sorted((j for j in range(len(kept)) if j != a), key=lambda j: (-score[j], kept[j][0] is None, kept[j][0] or 0))
        for p in [j for j in order if kept[j][2] == label][:positives]:
            window = [j for j in order if kept[j][2] != label and 30 * score[p] <= 100 * score[j] <= 90 * score[p]]
            out += [(i, kept[p][0], r, kept[j][0], score[p], score[j]) for r, j in enumerate(window[:negatives], 1)]
    return sorted(out, key=known_first)


@pytest.mark.parametrize("sample, fan_out, block", [(50, 3, 20), (400, 4, 7), (1, 2, 1000), (8192, 16, 2048)])
def test_negatives_match_brute_force(spark, sample, fan_out, block):
    rows = vector_rows(sample, 400, 4, ids=150)
    df = spark.createDataFrame([(*r, "c", "e", 1) for r in rows], VECTORS).repartition(5)
    got = mine_hard_negatives(df, F.expr("vec_id % 10 = 0"), sample=sample, fan_out=fan_out, block=block).collect()
    assert sorted(map(tuple, got), key=known_first) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_with_many_groups_of_queries(spark, monkeypatch):
    rows = vector_rows(9, 300, 4, ids=300)
    monkeypatch.setattr("jobstar.llm.gnat_negatives.GROUP", 20)
    df = spark.createDataFrame([(*r, "c", "e", 1) for r in rows], VECTORS)
    got = mine_hard_negatives(df, F.expr("vec_id % 3 = 0"), sample=60, fan_out=3, block=16).collect()
    assert sorted(map(tuple, got), key=known_first) == brute_negatives(rows, lambda i: i % 3 == 0)


def test_negatives_of_empty_and_ragged_tables(spark):
    df = spark.createDataFrame([(1, [1.0] * 8, 1, "", "", 1), (100, [1.0] * 4, 1, "", "", 1)], VECTORS)
    assert mine_hard_negatives(df.limit(0), F.expr("vec_id % 100 = 0")).count() == 0
    assert mine_hard_negatives(df.where("vec_id = 100"), F.expr("vec_id % 100 = 0")).count() == 0
    with pytest.raises(ValueError, match="inner product"):
        mine_hard_negatives(df, F.expr("vec_id % 100 = 0"))


def test_tree_reaches_every_row_of_a_window_and_leaves_subtrees_out():
    rnd = np.random.default_rng(1)
    centres = rnd.integers(-200, 200, (12, 6))
    rows = centres[rnd.integers(0, 12, 1500)] + rnd.integers(-6, 7, (1500, 6))
    tree = Tree.fit(rows[:300], int((rows ** 2).sum(1).max()), 4, 20)
    least = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    most = [np.full((len(p), len(p)), -np.inf) for p in tree.points]

    def see(node, far, side):
        for j in set(side.tolist()):
            least[node][:, j] = np.minimum(least[node][:, j], far[side == j].min(0))
            most[node][:, j] = np.maximum(most[node][:, j], far[side == j].max(0))

    leaf = tree.route(rows, see)
    tree.nearest, tree.farthest = least, most
    queries, scores = rows[:50], rows[:50] @ rows.T
    top = np.sort(scores, axis=1)[:, -10]
    q, leaves = tree.reach(queries, top[:, None].astype(float), np.full((50, 1), 2.0 ** 53))
    reached = set(zip(q.tolist(), leaves.tolist()))
    assert all((i, leaf[j]) in reached for i in range(50) for j in np.nonzero(scores[i] >= top[i])[0])
    assert len(reached) < 0.7 * 50 * tree.leaves
