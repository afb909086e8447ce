"""Sharding by histogram sort: exact byte counts below probe keys, refined, then one exchange.

The sort key is ``(hash of the text, hash of the identifier, hash of a row number)``, so rows are
shuffled well and equal texts stay side by side. Rows and keys are written once, so that a row keeps its number. A splitter is wanted at each multiple of ``total / shards``
bytes. Every round counts the exact bytes between probe keys across all partitions (an
aggregate with map-side combining), keeps for each splitter the interval that holds its
target, and lays new probes inside it, until the nearest probe is within the tolerance.
Probes divide the key's bits, ``2 ** BITS`` of them per open interval and round, so the
driver sees at most ``shards * 2 ** BITS`` counts however large the table is.

A splitter falls inside a group of equal texts only if the group is larger than the
tolerance; then the second hash is refined in the same way, and inside rows equal in both
(repeats of one row) the third.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import numbered, tmp_name

BITS = 10
TOLERANCE = 0.01  # of a shard's mean bytes
KEY_BITS = 62
ROW_BYTES = 16  # counted for each row besides its text
LAW = "bytes"


def sort_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two non-negative 62-bit hashes: of the text and of the identifier."""
    mask = F.lit((1 << KEY_BITS) - 1)
    return (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(mask),
            F.xxhash64(F.col(id_col).cast("string"), F.lit("row")).bitwiseAND(mask))


KEYS = ("k1", "k2", "k3")
Key = tuple[int, ...]


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[Key]:
    """``shards - 1`` keys ``(k1, k2, k3)``, ascending; shard i holds the keys from splitter i - 1 on.

    ``keys`` has the columns ``k1, k2, k3, size`` and is read once per round.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    # An open splitter: its target and the interval of one key column that holds it, given by
    # its first key (lo) and the bytes below it. at: the values of the earlier columns it is inside of.
    open_ = [{"i": i, "target": total * i / shards, "lo": 0, "below": 0, "at": ()} for i in range(1, shards)]
    found: dict[int, Key] = {}
    for column in KEYS:
        bits = KEY_BITS
        while open_ and bits > 0:
            step = max(0, bits - BITS)
            counts = _count_between(keys, column, bits, step, open_)
            open_ = [s for s in (_refine(s, counts, column, bits, step, tolerance * total / shards, found)
                                 for s in open_) if s]
            bits = step
        # What is still open lies in one value of the column: go on with the next column inside it.
        open_ = [s | {"at": (*s["at"], s["lo"]), "lo": 0} for s in open_]
    out = [found[i] for i in sorted(found)]
    return [max(out[: i + 1]) for i in range(len(out))]


def _refine(s: dict, counts: dict, column: str, bits: int, step: int, slack: float, found: dict) -> dict | None:
    """The splitter with a finer interval, or None when ``found`` has got its key."""
    below, best, inside = s["below"], (abs(s["below"] - s["target"]), s["lo"]), None
    for b, size, rows in sorted(counts.get((s["at"], s["lo"] >> bits), [])):
        at = b << step
        best = min(best, (abs(below - s["target"]), at))
        if below <= s["target"] < below + size:
            inside = (at, below, rows)
        below += size
        best = min(best, (abs(below - s["target"]), at + (1 << step)))
    # One row holds the target: no probe between rows can be nearer than its two ends.
    if best[0] <= slack or inside is None or inside[2] == 1 or (step == 0 and column == KEYS[-1]):
        key = (*s["at"], best[1])
        found[s["i"]] = key + (0,) * (len(KEYS) - len(key))
        return None
    return s | {"lo": inside[0], "below": inside[1]}


def _count_between(keys: DataFrame, column: str, bits: int, step: int, open_: list[dict]) -> dict:
    """Exact bytes and rows between probes: ``{(earlier columns, interval): [(bin, bytes, rows)]}``."""
    rows = keys.where(F.shiftright(column, bits).isin(sorted({s["lo"] >> bits for s in open_})))
    by = [F.shiftright(column, step).alias("bin")]
    earlier = KEYS[:KEYS.index(column)]
    for i, c in enumerate(earlier):
        rows = rows.where(F.col(c).isin(sorted({s["at"][i] for s in open_})))
        by.append(F.col(c))
    out: dict = {}
    for r in rows.groupBy(*by).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect():
        out.setdefault((tuple(r[c] for c in earlier), r["bin"] >> (bits - step)), []).append((r["bin"], r["bytes"], r["rows"]))
    return out


def shard_of(key: list[Column], splits: list[Key]) -> Column:
    """The number of splitters at or below the key."""
    k1, k2, k3 = key
    shard = F.lit(0)
    for a, b, c in splits:
        past = (k1 > F.lit(a)) | ((k1 == F.lit(a)) & ((k2 > F.lit(b)) | ((k2 == F.lit(b)) & (k3 >= F.lit(c)))))
        shard = shard + F.when(past, 1).otherwise(0)
    return shard.cast("int")


def histogram_sort_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id",
                          text_col: str = "text", tolerance: float = TOLERANCE,
                          columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all by default) plus ``size, text_crc32, law, shard, slot, grown_shard``.

    Shards hold near equal bytes: each boundary is within ``tolerance`` of a shard's mean, or
    at the nearest row if one row is larger. ``slot`` counts from 0 without gaps inside a
    shard, in key order. A null text has no bytes, a null identifier is hashed as such; rows
    that repeat both are dealt like others where they are many. An input column named like an added one is replaced.
    An empty table gives an empty result.
    """
    p = tmp_name(docs)
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    columns = [c for c in (columns or docs.columns) if c not in added]
    k1, k2 = sort_key(id_col, text_col)
    k3 = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << KEY_BITS) - 1))
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    names = [p + k for k in KEYS]
    keyed = materialize(docs.select(*columns, *[k.alias(n) for k, n in zip((k1, k2, k3), names)], size.alias("size"),
                                    F.crc32(text.cast("binary")).alias("text_crc32")), "shard-rows")
    splits = splitters(keyed.select(*[F.col(n).alias(k) for k, n in zip(KEYS, names)], "size"), shards, tolerance)
    # The one exchange of the rows; range bounds inside a shard only spread the work.
    sharded = keyed.withColumn("shard", shard_of([F.col(n) for n in names], splits))
    placed = numbered(sharded, "shard", names, "slot", few_groups=True)
    return placed.select(*columns, "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
