"""Vector code compression with equal-average search of the codebooks.

Vectors of whole numbers are cut in equal consecutive parts; every part position has a
codebook. An entry's squared distance from a part is at least the squared gap of their
component sums over the number of components. So a codebook is sorted by sum, and from a
part's own sum the search goes outward on both sides, entry by entry; a side ends when its
squared gap over the dimension strictly exceeds the best distance so far (an equal one may
still bear a tie of lower index).

A round of fitting is one pass: tasks assign their rows and add up components and counts per
entry, those are summed over tasks, and the new codebooks, whose size depends on the entries
and the dimension alone, go out with the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize
from .common import tmp_name

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# A part's squared distance and the sums of a task must fit in 64 bits.
_MAX_COMPONENT = 1 << 26
_SLICE = 4096  # rows searched at once


@dataclass
class Codebook:
    """Entries ``(entry, component)`` of one part position, with their order by component sum."""

    entries: np.ndarray

    def __post_init__(self):
        sums = self.entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lower index) and its squared distance, per row."""
        found = [self._nearest(parts[i:i + _SLICE]) for i in range(0, len(parts), _SLICE)]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def _nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, dims = parts.shape
        own = parts.sum(axis=1)
        best = np.full(n, np.iinfo(np.int64).max)
        which = np.full(n, len(self.order))
        start = np.searchsorted(self.sums, own)
        for side in (1, -1):
            # The first entry of a side, then outward. The right side's best ends the left side sooner.
            at = start if side == 1 else start - 1
            rows = np.arange(n)
            while len(rows):
                inside = (at >= 0) & (at < len(self.order))
                rows, at = rows[inside], at[inside]
                gap = self.sums[at] - own[rows]
                # gap * gap / dims > best, in whole numbers
                near = (gap * gap + dims - 1) // dims <= best[rows]
                rows, at = rows[near], at[near]
                entry = self.order[at]
                apart = parts[rows] - self.entries[entry]
                distance = np.einsum("ij,ij->i", apart, apart)
                better = (distance < best[rows]) | ((distance == best[rows]) & (entry < which[rows]))
                best[rows[better]], which[rows[better]] = distance[better], entry[better]
                at = at + side
        return which, best


def whole_vectors(df: DataFrame, vector_col: str, scale: int) -> Column:
    """``floor(scale * x)`` of each component; null where the vector or a component is null or not finite."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values.reshape(-1, dims)


def _assigned(vectors: np.ndarray, books: list[Codebook]) -> list[tuple[np.ndarray, np.ndarray]]:
    return [book.nearest(part) for book, part in zip(books, np.split(vectors, len(books), axis=1))]


def _round_sums(shared, dims: int):
    """Per task one line for each used entry: part, entry, count, component sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(entries) for entries in shared.value]
        shape = books[0].entries.shape
        total = np.zeros((len(books), *shape), np.int64)
        count = np.zeros((len(books), shape[0]), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), dims)
            for p, (which, _) in enumerate(_assigned(vectors, books)):
                part = vectors[:, p * shape[1]:(p + 1) * shape[1]]
                by_entry = np.argsort(which, kind="stable")
                used, first, n = np.unique(which[by_entry], return_index=True, return_counts=True)
                if len(used):
                    total[p, used] += np.add.reduceat(part[by_entry], first, axis=0)
                    count[p, used] += n
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]),
             pa.array(list(total[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])
    return run


def _coder(shared, dims: int, at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(entries) for entries in shared.value]
        for batch in batches:
            found = _assigned(_matrix(batch.column(at), dims), books)
            code = np.stack([which for which, _ in found], axis=1).astype(np.uint8) if len(books[0].entries) else None
            error = np.sum([distance for _, distance in found], axis=0).astype(np.int64)
            raw = code.tobytes().hex()
            width = 2 * len(books)
            codes = [raw[i:i + width] for i in range(0, len(raw), width)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns) if i != at), pa.array(codes, pa.string()), pa.array(error)],
                names=names)
    return run


def fit_codebooks(vectors: DataFrame, vector_col: str, order: list[str], dims: int, parts: int = PARTS,
                  entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Codebook]:
    """Codebooks that begin with the first ``entries`` rows by ``order`` and are fitted over all rows.

    Every round assigns each part to its nearest entry and puts the floor of the mean of its
    parts in each entry's place; an entry without parts stays. ``vectors`` must hold no null.
    """
    spark = vectors.sparkSession
    first = vectors.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(entries).select(vector_col).collect()
    start = np.array([r[0] for r in first], np.int64).reshape(len(first), dims)
    books = [Codebook(part.copy()) for part in np.split(start, parts, axis=1)]
    schema = "part int, entry int, n long, total array<long>"
    width = dims // parts
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast([book.entries for book in books])
        sums = vectors.select(vector_col).mapInArrow(_round_sums(shared, dims), schema)
        # At most parts * entries rows come back.
        new = (sums.groupBy("part", "entry")
               .agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"c{i}") for i in range(width)]).collect())
        grown = [book.entries.copy() for book in books]
        for r in new:
            grown[r["part"]][r["entry"]] = [r[f"c{i}"] // r["n"] for i in range(width)]
        books = [Codebook(g) for g in grown]
        shared.unpersist()
    return books


def codebooks_text(books: list[Codebook]) -> str:
    """All components by part, entry and position, joined by commas."""
    return ",".join(str(x) for book in books for x in book.entries.ravel().tolist())


def compress_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``id_col, label_col, code, error, label_error, codebooks_sha256``, a row per kept row.

    Vectors that are null or hold a null or non-finite component are dropped; the others
    become ``floor(scale * x)``. ``code`` has two hex digits a part, ``error`` is the sum of the
    parts' squared distances, ``label_error`` its sum over the rows of equal label (nulls are one
    label). Rows that repeat an identifier are coded each; the first ``entries`` rows are chosen by
    identifier, then vector, rows without identifier last. With fewer rows the codebooks have fewer
    entries. Kept vectors must have one length, a multiple of ``parts``, and components below 2**26 in
    size: else an error is raised. Other columns are ignored; an empty table gives an empty result.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    p = tmp_name(df)
    whole = df.select(F.col(id_col).alias(p + "id"), F.col(label_col).alias(p + "label"),
                      whole_vectors(df, vector_col, scale).alias(p + "v")).where(F.col(p + "v").isNotNull())
    whole = materialize(whole, "whole-vectors")
    v = F.col(p + "v")
    dims, most, size = whole.agg(F.min(F.size(v)), F.max(F.size(v)), F.max(F.array_max(F.transform(v, F.abs)))).first()
    if dims is None:
        dims = most = parts
    if dims != most or dims % parts or not dims:
        raise ValueError(f"vectors of {dims} to {most} components can't be cut in {parts} equal parts")
    if (size or 0) >= _MAX_COMPONENT:
        raise ValueError(f"a component of size {size}; at most {_MAX_COMPONENT - 1} is exact")
    books = fit_codebooks(whole, p + "v", [p + "id", p + "v"], dims, parts, entries, rounds)
    shared = df.sparkSession.sparkContext.broadcast([book.entries for book in books])
    names = [p + "id", p + "label", "code", "error"]
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in whole.schema if f.name != p + "v"),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = materialize(whole.mapInArrow(_coder(shared, dims, 2, names), schema), "vector-codes")
    by_label = coded.groupBy(F.col(p + "label").alias(p + "l")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return (coded.join(by_label, F.col(p + "label").eqNullSafe(F.col(p + "l")))
            .select(F.col(p + "id").alias(id_col), F.col(p + "label").alias(label_col), "code", "error", "label_error",
                    F.lit(digest).alias("codebooks_sha256")))
