"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Scores are inner products of whole-number vectors. With one more component, ``sqrt(M - |x|^2)``
for rows and 0 for queries (``M`` the largest squared length), a score ``s`` of query ``q`` is the
distance ``sqrt(|q|^2 + M - 2 s)``: a window of scores is an annulus around the query.

A node of the tree has several split points; a row belongs to the subtree of the nearest one.
For every split point and every sibling subtree the node holds the least and greatest distance
from the point to the subtree's rows. A query's distance from one split point bounds its
distance from each subtree's rows on both sides; a subtree is eliminated when for any split
point these bounds miss the annulus of every window. Leaves are searched exactly.

The tree's shape is fitted on a bounded sample (``SAMPLE`` rows, by hash); every row is routed
through it, and the ranges are taken over all rows. A leaf's rows are dealt over blocks of about
``BLOCK`` rows, so a leaf of any size is many tasks' work. The sample also gives each window a
first bound on its last place (rows of the table are in the sample, so it is a true bound),
which shrinks the annulus; it never decides what is returned.

Blocks and the queries that reach them meet sorted in one exchange: a task holds one block
and streams the queries past it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize
from .common import shuffle_partitions, tmp_name
from .equal_average import whole_vectors

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
SAMPLE, FAN_OUT, BLOCK = 8192, 16, 2048
GROUP = 20_000  # queries that a block meets in one task
_SLICE = 256  # queries scored at once
_NONE = np.iinfo(np.int64).min


@dataclass
class Tree:
    """``points[n]`` are node ``n``'s split points with the added component, ``child[n]`` its subtrees:
    a node's number, or ``-1 - leaf``. Without nodes there is one leaf, 0."""

    largest: float
    points: list[np.ndarray]
    child: list[np.ndarray]
    leaves: int = 1
    nearest: list[np.ndarray] | None = None
    farthest: list[np.ndarray] | None = None

    @classmethod
    def fit(cls, sample: np.ndarray, largest: int, fan_out: int, leaf_rows: int) -> Tree:
        tree = cls(float(largest), [], [], 0)
        if len(sample):
            tree._grow(tree.lift(sample), fan_out, max(2, leaf_rows))
        tree.leaves = max(1, tree.leaves)
        return tree

    def lift(self, rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(np.float64)
        return np.column_stack((rows, np.sqrt(np.maximum(0, self.largest - np.einsum("ij,ij->i", rows, rows)))))

    def _grow(self, rows: np.ndarray, fan_out: int, leaf_rows: int) -> int:
        if len(rows) > leaf_rows:
            points = _spread(rows, fan_out)
            side = self._to(rows, points).argmin(axis=1)
            if len(points) > 1:
                node = len(self.points)
                self.points.append(points)
                self.child.append(np.zeros(len(points), np.int64))
                for j in range(len(points)):
                    self.child[node][j] = self._grow(rows[side == j], fan_out, leaf_rows)
                return node
        self.leaves += 1
        return -self.leaves

    def _to(self, lifted: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 * self.largest - 2 * lifted @ points.T))

    def route(self, rows: np.ndarray, see=None) -> np.ndarray:
        """Leaf of each row; ``see(node, distances, sides)`` is called at every node that rows pass."""
        lifted = self.lift(rows)
        leaf = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))] if self.points and len(rows) else []
        while todo:
            node, here = todo.pop()
            far = self._to(lifted[here], self.points[node])
            side = far.argmin(axis=1)
            if see:
                see(node, far, side)
            for j in np.unique(side).tolist():
                to, those = int(self.child[node][j]), here[side == j]
                if to < 0:
                    leaf[those] = -1 - to
                else:
                    todo.append((to, those))
        return leaf

    def reach(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(query, leaf)`` pairs that may hold a row whose score lies in one of the query's windows.

        ``low`` and ``high`` hold the windows' bounds ``(query, window)``; a window is void if they cross.
        """
        queries = queries.astype(np.float64)
        own = np.einsum("ij,ij->i", queries, queries)[:, None] + self.largest
        slack = 1e-6 * (1 + np.sqrt(self.largest) + np.sqrt(own))  # over the rounding of any distance here
        inner = np.sqrt(np.maximum(0, own - 2 * high)) - slack
        outer = np.sqrt(np.maximum(0, own - 2 * low)) + slack
        some = np.nonzero((low <= high).any(axis=1))[0]
        if not self.points:
            return some, np.zeros(len(some), np.int64)
        void = low > high
        inner[void], outer[void] = np.inf, -np.inf
        got = []
        todo = [(0, some)]
        while todo:
            node, here = todo.pop()
            points = self.points[node]
            far = np.sqrt(np.maximum(0, own[here] - 2 * (queries[here] @ points[:, :-1].T)))[:, :, None]
            near, most = self.nearest[node][None], self.farthest[node][None]
            least = np.maximum(np.maximum(far - most, near - far), 0).max(axis=1)  # (query, subtree)
            greatest = (far + most).min(axis=1)
            open_ = ((least[:, :, None] <= outer[here][:, None, :])
                     & (greatest[:, :, None] >= inner[here][:, None, :])).any(axis=2)
            for j in np.nonzero(open_.any(axis=0))[0].tolist():
                to, those = int(self.child[node][j]), here[open_[:, j]]
                if to < 0:
                    got.append((those, np.full(len(those), -1 - to)))
                else:
                    todo.append((to, those))
        if not got:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])


def _spread(rows: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different rows, each far from those chosen before."""
    pool = np.unique(rows[np.linspace(0, len(rows) - 1, min(len(rows), 4 * count)).astype(int)], axis=0)
    chosen = [0]
    apart = np.linalg.norm(pool - pool[0], axis=1)
    while len(chosen) < min(count, len(pool)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, np.linalg.norm(pool - pool[chosen[-1]], axis=1))
    return pool[chosen]


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _router(shared, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(**shared.value)
        for batch in batches:
            leaf = tree.route(_matrix(batch.column("v"), dims))
            yield batch.append_column("leaf", pa.array(leaf.astype(np.int32)))
    return run


def _ranger(shared, dims: int):
    """Per task one line for each split point and sibling subtree that rows went to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(**shared.value)
        least = [np.full((len(p), len(p)), np.inf) for p in tree.points]
        most = [np.full((len(p), len(p)), -np.inf) for p in tree.points]

        def see(node, far, side):
            for j in np.unique(side).tolist():
                those = far[side == j]
                least[node][:, j] = np.minimum(least[node][:, j], those.min(axis=0))
                most[node][:, j] = np.maximum(most[node][:, j], those.max(axis=0))

        for batch in batches:
            tree.route(_matrix(batch.column("v"), dims), see)
        for node, (lo, hi) in enumerate(zip(least, most)):
            i, j = np.nonzero(hi >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), node, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(lo[i, j]), pa.array(hi[i, j])], names=["node", "point", "subtree", "lo", "hi"])
    return run


def _with_ranges(tree: Tree, rows: DataFrame, dims: int) -> Tree:
    """The tree with the ranges over all ``rows``; a line per node, point and subtree comes back."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(tree))
    found = (rows.select("v").mapInArrow(_ranger(shared, dims), "node int, point int, subtree int, lo double, hi double")
             .groupBy("node", "point", "subtree").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).toPandas())
    tree.nearest = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.farthest = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    for node, of in found.groupby("node"):
        tree.nearest[node][of.point, of.subtree] = of.lo
        tree.farthest[node][of.point, of.subtree] = of.hi
    return tree


def _packer(dims: int):
    """Rows sorted by leaf and salt in, one line per block out."""
    def line(key, held):
        table = pa.Table.from_batches(held)
        of = {c: table.column(c).combine_chunks() for c in ("row", "id", "label", "v")}
        return {"leaf": key[0], "salt": key[1], "rows": of["row"].to_numpy().tobytes(),
                "has_id": np.asarray(of["id"].is_valid()).tobytes(),
                "ids": of["id"].fill_null(0).to_numpy().tobytes(), "labels": of["label"].to_numpy().tobytes(),
                "vectors": _matrix(of["v"], dims).astype(np.int32).tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("leaf", pa.int32()), ("salt", pa.int32()), *((c, pa.binary()) for c in _PACKED)])
        key, held = None, []
        for batch in batches:
            keys = np.stack((batch.column("leaf").to_numpy(), batch.column("salt").to_numpy()), axis=1)
            cuts = [0, *(np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and key != tuple(keys[lo].tolist()):
                    yield pa.RecordBatch.from_pylist([line(key, held)], schema)
                    held = []
                key = tuple(keys[lo].tolist())
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield pa.RecordBatch.from_pylist([line(key, held)], schema)
    return run


_PACKED = ("rows", "has_id", "ids", "labels", "vectors")


def _bounder(tree, pilot, dims: int, wanted: int, same: bool):
    """Queries with ``low, high`` per window: adds ``least`` (``low``, or the sample's ``wanted``-th best
    score in the window if that is more) and the leaves to visit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_tree = Tree(**tree.value)
        rows, labels, vectors = pilot.value
        others = vectors.astype(np.float64).T
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                queries = _matrix(part.column("v"), dims)
                fits = (part.column("label").to_numpy()[:, None] == labels[None]) == same
                fits &= part.column("row").to_numpy()[:, None] != rows[None]
                scores = np.where(fits, queries.astype(np.float64) @ others, -np.inf)
                bounds = part.column("windows").flatten()
                low, high = (bounds.field(c).to_numpy().reshape(len(queries), -1) for c in ("low", "high"))
                least = low.copy()
                for w in range(low.shape[1]):
                    if scores.shape[1] >= wanted:
                        inside = np.where((scores >= low[:, w, None]) & (scores <= high[:, w, None]), scores, -np.inf)
                        best = np.partition(inside, -wanted, axis=1)[:, -wanted]
                        full = np.isfinite(best)
                        least[full, w] = np.maximum(least[full, w], best[full].astype(np.int64))
                query, leaf = own_tree.reach(queries, least.astype(np.float64), high.astype(np.float64))
                order = np.argsort(query, kind="stable")
                ends = np.searchsorted(query[order], np.arange(len(queries) + 1))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("row", "label", "v")),
                     pa.array(list(least), pa.list_(pa.int64())), pa.array(list(high), pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(leaf[order].astype(np.int32)))],
                    names=["row", "label", "v", "least", "high", "leaf"])
    return run


def _searcher(dims: int, wanted: int, same: bool):
    """Blocks, each followed by the queries that reach it, in; each window's best rows of the block out."""
    def best(block, part):
        rows, has_id, ids, labels, vectors = block
        queries = _matrix(part.column("v"), dims)
        own, own_label = part.column("row").to_numpy(), part.column("label").to_numpy()
        least, high = ([x.as_py() for x in part.column(c)] for c in ("least", "high"))
        scores = np.rint(queries.astype(np.float64) @ vectors).astype(np.int64)
        fits = (own_label[:, None] == labels[None]) == same
        fits &= own[:, None] != rows[None]
        for q in range(len(queries)):
            for w, (lo, hi) in enumerate(zip(least[q], high[q])):
                at = np.nonzero(fits[q] & (scores[q] >= lo) & (scores[q] <= hi))[0]
                if len(at) > wanted:
                    # No row below the wanted-th best score can stay; ties are settled by identifier.
                    cut = np.partition(scores[q, at], -wanted)[-wanted]
                    at = at[scores[q, at] >= cut]
                    at = at[np.lexsort((rows[at], ids[at], ~has_id[at], -scores[q, at]))[:wanted]]
                for i in at.tolist():
                    yield int(own[q]), w, int(rows[i]), int(ids[i]) if has_id[i] else None, int(scores[q, i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, key = None, None
        schema = pa.schema([("row", pa.int64()), ("w", pa.int32()), ("found_row", pa.int64()), ("found_id", pa.int64()),
                            ("score", pa.int64())])
        for batch in batches:
            is_block = np.asarray(batch.column("rows").is_valid())
            cuts = sorted({0, len(is_block), *np.nonzero(is_block)[0].tolist(), *(np.nonzero(is_block)[0] + 1).tolist()})
            for lo, hi in zip(cuts, cuts[1:]):
                if is_block[lo]:
                    raw = {c: batch.column(c)[lo].as_py() for c in _PACKED}
                    block = (np.frombuffer(raw["rows"], np.int64), np.frombuffer(raw["has_id"], bool),
                             np.frombuffer(raw["ids"], np.int64), np.frombuffer(raw["labels"], np.int64),
                             np.frombuffer(raw["vectors"], np.int32).reshape(-1, dims).T.astype(np.float64))
                    key = tuple(batch.column(c)[lo].as_py() for c in ("leaf", "salt", "g"))
                    continue
                for at in range(lo, hi, _SLICE):
                    part = batch.slice(at, min(_SLICE, hi - at))
                    assert key == tuple(part.column(c)[0].as_py() for c in ("leaf", "salt", "g"))
                    found = list(best(block, part))
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
    return run


def _search(queries: DataFrame, blocks: DataFrame, sizes: DataFrame, tree, pilot, dims: int, wanted: int, same: bool,
            groups: int) -> DataFrame:
    """``row, w, found_row, found_id, score``: for each query row and window the best ``wanted`` rows.

    ``queries`` has ``row, label, v, windows`` (an array of ``low, high``, equally many in every row); rows of
    the query's label are searched if ``same``, else the rows of other labels.
    """
    schema = "row long, label long, v array<long>, least array<long>, high array<long>, leaf array<int>"
    bounded = queries.select("row", "label", "v", "windows").mapInArrow(_bounder(tree, pilot, dims, wanted, same), schema)
    # A row per leaf of the sample's tree in ``sizes``: bounded, so it may be broadcast.
    reached = (bounded.withColumn("leaf", F.explode("leaf")).join(F.broadcast(sizes), "leaf")
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    g = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    asks = reached.select("leaf", "salt", g.alias("g"), "row", "label", "v", "least", "high",
                          *[F.lit(None).cast("binary").alias(c) for c in _PACKED])
    each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    held = blocks.select("leaf", "salt", each.alias("g"), *[F.lit(None).cast(t).alias(c) for c, t in (
        ("row", "long"), ("label", "long"), ("v", "array<long>"), ("least", "array<long>"), ("high", "array<long>"))], *_PACKED)
    met = (held.unionByName(asks).repartition(shuffle_partitions(queries), "leaf", "salt", "g")
           .sortWithinPartitions("leaf", "salt", "g", F.col("row").asc_nulls_first()))
    found = met.mapInArrow(_searcher(dims, wanted, same), "row long, w int, found_row long, found_id long, score long")
    order = Window.partitionBy("row", "w").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def mine_hard_negatives(df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                        label_col: str = "label", scale: int = SCALE, positives: int = POSITIVES,
                        negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, sample: int = SAMPLE,
                        fan_out: int = FAN_OUT, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, exact for every anchor.

    Rows with a null label or vector, or a null or non-finite component, take no part. Components
    become ``floor(scale * x)``; a score is the inner product. ``anchors`` says of each row whether it is an
    anchor (null: no). An anchor's positives are the first ``positives`` other rows of its label, its
    negatives for one of them the first ``negatives`` rows of other labels whose score is from ``low`` to
    ``high`` percent of the positive's. First means higher score, then smaller identifier, rows
    without identifier last. Rows that repeat an identifier or a vector are rows of their own, as
    anchors too. An anchor without positives or a positive without negatives gives no row; a
    negative positive score allows none. Other columns are ignored; an empty table gives an empty
    result. Identifiers and labels are whole numbers. Vectors of different lengths, or so large
    that a score may pass 2**53, are an error.
    """
    spark = df.sparkSession
    p = tmp_name(df)
    v = whole_vectors(df, vector_col, scale)
    rows = (df.withColumn(p + "v", v).where(F.col(p + "v").isNotNull() & F.col(label_col).isNotNull())
            .select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                    F.col(label_col).cast("long").alias("label"), F.col(p + "v").alias("v"),
                    F.coalesce(anchors, F.lit(False)).alias("anchor")))
    rows = materialize(rows, "gnat-rows")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, asked, dims, most, largest = rows.agg(
        F.count(F.lit(1)), F.count_if("anchor"), F.min(F.size("v")), F.max(F.size("v")), F.max(square)).first()
    dims, largest = dims or 0, largest or 0.0
    if n and dims != most:
        raise ValueError(f"vectors of {dims} to {most} components have no inner product")
    if largest >= 2.0 ** 51:
        raise ValueError("scores may pass 2**53; use a smaller scale")
    if n and not dims:  # all vectors are empty: a component of 0 changes no score
        rows, dims = rows.withColumn("v", F.array(F.lit(0).cast("long"))), 1

    # The sample bounds what the driver holds; its least hashes are the same in every run.
    picked = rows.orderBy(F.xxhash64("row"), "row").limit(sample).select("row", "label", "v").toPandas()
    vectors = np.array(picked.v.tolist(), np.int64).reshape(len(picked), max(dims, 1))
    tree = Tree.fit(vectors, largest, fan_out, leaf_rows=max(2, len(picked) * block // max(n, 1)))
    tree = _with_ranges(tree, rows, dims) if tree.points else tree
    sc = spark.sparkContext
    shared, pilot = sc.broadcast(vars(tree)), sc.broadcast((picked.row.to_numpy(), picked.label.to_numpy(), vectors))

    routed = rows.drop("anchor").mapInArrow(_router(shared, dims), T.StructType(
        [*rows.drop("anchor").schema, T.StructField("leaf", T.IntegerType())]))
    routed = materialize(routed, "gnat-routed")
    sizes = materialize(routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "gnat-leaves")
    dealt = (routed.join(F.broadcast(sizes), "leaf")
             .withColumn("salt", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).drop("blocks")
             .repartition(shuffle_partitions(df), "leaf", "salt").sortWithinPartitions("leaf", "salt"))
    blocks = materialize(dealt.mapInArrow(_packer(dims), "leaf int, salt int, rows binary, has_id binary, ids binary, "
                                          "labels binary, vectors binary"), "gnat-blocks")

    groups = -(-max(asked, 1) // GROUP)
    queries = rows.where("anchor").drop("anchor")
    every = F.array(F.struct(F.lit(-(1 << 53)).cast("long").alias("low"), F.lit(1 << 53).cast("long").alias("high")))
    near = _search(queries.withColumn("windows", every), blocks, sizes, shared, pilot, dims, positives, True, groups)
    near = materialize(near.select("row", F.col("rank").alias("place"), F.col("found_id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), "gnat-positives")
    # Whole-number bounds of each window; a place without positive gets a void one.
    score = F.col("positive_score")
    bounds = F.struct(F.col("place").alias("place"), F.ceil(low * score / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low"),
                      F.floor(high * score / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"))
    void = F.struct(F.lit(1).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
    by_row = near.groupBy("row").agg(F.sort_array(F.collect_list(bounds)).alias("of"))
    windows = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(
        F.get(F.transform("of", lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high"))), i), void))
    hard = _search(queries.join(by_row, "row").withColumn("windows", windows), blocks, sizes, shared, pilot, dims,
                   negatives, False, groups)
    hard = hard.select("row", (F.col("w") + 1).alias("place"), "rank", F.col("found_id").alias("negative_id"),
                       F.col("score").alias("negative_score"))
    return (near.join(hard, ["row", "place"]).join(queries.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
