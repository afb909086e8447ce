"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of more than ``CHUNK`` characters is cut in chunks, each with the first ``OVERLAP``
characters of the next. Every chunk is split into pre-tokens on its own, from its first
character, whether or not a pre-token begins there. Two neighbours are stitched at the first
place of the overlap where both have a boundary: from a common boundary on both split alike,
as the pattern looks at nothing before a match. Then each chunk's pre-tokens from its own
stitch to the next one are merged by rank; decoding concatenates the bytes of the ids.

Which boundaries can be trusted:

- At a chunk's end the text is cut, so a match that ends in its last ``LOOK`` characters may
  be another one in the full text; such boundaries aren't used unless the text ends there.
- At a chunk's beginning the split may be out of step. Between a letter, digit or other sign
  and a character of another class a boundary lies in *every* split (but for an apostrophe
  before a letter), so a chunk that has such an ``ANCHOR`` is in step from there on.
- A stitch needs a character before it that is no blank: a run of blanks is split by what
  follows it, so a piece must not end inside one.

Where neighbours have no common boundary in the overlap (one pre-token of hundreds of
characters), or a chunk has no anchor, the chunks are put together again and split as one.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize
from .common import small_batches

CHUNK = 16_384
OVERLAP = 256
LOOK = 3
MAX_RANKS = 2_000_000  # entries of a rank file that may be broadcast
_CACHED_PIECES, _CACHED_CHARS = 300_000, 64
_SHORT, _NONE = 64, 1 << 60  # bytes of a piece merged by plain scans; no rank

# Between these two characters every split by the pattern has a boundary.
ANCHOR = r"\p{L}(?=[^\p{L}])|\p{N}(?=[^\p{N}])|[^\s\p{L}\p{N}](?=[\s\p{N}])"


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (a token in base 64 and its rank per line) that the driver sees.

    The file is a vocabulary, not data: more than ``MAX_RANKS`` entries are an error.
    """
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if len(ranks) > MAX_RANKS:
        raise ValueError(f"{len(ranks)} ranks; at most {MAX_RANKS} are broadcast")
    return ranks


def merge_piece(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one pre-token: the neighbours of least rank, the leftmost of equal ones, are merged until none is left."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    if n <= _SHORT:
        rank, parts = ranks.get, [piece[i:i + 1] for i in range(n)]
        pairs = [rank(piece[i:i + 2], _NONE) for i in range(n - 1)]
        while pairs and (least := min(pairs)) != _NONE:
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], _NONE)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], _NONE)
        return [ranks[p] for p in parts]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if gone[i] or j >= n or after[j] != end:
            continue  # one of the two has been merged since
        gone[j] = 1
        after[i] = end
        if end < n:
            before[end] = i
            far = after[end]
            if far - i <= longest and (r := ranks.get(piece[i:far])) is not None:
                heappush(heap, (r, i, far))
        left = before[i]
        if left >= 0 and end - left <= longest and (r := ranks.get(piece[left:end])) is not None:
            heappush(heap, (r, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class PieceIds(dict):
    """The ids of a pre-token, as packed 32-bit numbers; short ones are remembered, up to a bound."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.longest = ranks, max(map(len, ranks), default=0)

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", merge_piece(piece.encode(), self.ranks, self.longest)).tobytes()
        if len(piece) <= _CACHED_CHARS:
            if len(self) >= _CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def _encoder(shared, pattern: str, text_col: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, state = regex.compile(pattern).findall, shared.value
        # A worker keeps its copy of the broadcast, and with it the pieces it has met, over its tasks.
        known = state.setdefault("known", PieceIds(state["ranks"]))
        for batch in batches:
            kept = [i for i, c in enumerate(batch.schema.names) if c != text_col]
            lo, ids, ends = 0, [], [0]
            for i, text in enumerate(batch.column(text_col)):
                ids.append(b"".join(map(known.__getitem__, pieces(text.as_py()))))
                ends.append(ends[-1] + len(ids[-1]) // 4)
                if ends[-1] > 4_000_000 or i == batch.num_rows - 1:
                    part = batch.slice(lo, i + 1 - lo)
                    found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), found],
                                                     names=[*(part.schema.names[c] for c in kept), "ids"])
                    lo, ids, ends = i + 1, [], [0]
    return encode


def _ids_of(df: DataFrame, text_col: str, shared, pattern: str) -> DataFrame:
    """``df`` with ``ids`` in place of its text."""
    kept = df.drop(text_col)
    schema = kept.withColumn("ids", F.array().cast("array<int>")).schema
    return df.mapInArrow(_encoder(shared, pattern, text_col), _nullable(schema))


def _nullable(schema):
    for field in schema.fields:
        field.nullable = True
    return schema


def chunk_boundaries(body: str, complete: bool, split, anchor, chunk: int, overlap: int) -> tuple[list[int], list[int], bool]:
    """Boundaries of a chunk's own split: those of its first ``overlap`` characters, those of the
    overlap with the next chunk (counted from there), and whether the latter are in step."""
    last = len(body) if complete else len(body) - LOOK
    cuts = [0, *accumulate(map(len, split(body)))]
    safe = [b for b in cuts if b <= last and (b < overlap or b >= chunk) and (b == 0 or not body[b - 1].isspace())]
    return ([b for b in safe if b < overlap], [b - chunk for b in safe if b >= chunk],
            anchor.search(body, 0, min(chunk, len(body))) is not None)


def _splitter(pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, anchor = regex.compile(pattern).findall, regex.compile(ANCHOR)
        for batch in batches:
            found = [chunk_boundaries(body, complete, split, anchor, chunk, overlap)
                     for body, complete in zip(batch.column("body").to_pylist(), batch.column("complete").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("k"), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.int32())), pa.array([f[2] for f in found], pa.bool_())],
                names=["row", "k", "head", "tail", "in_step"])
    return run


def cut_chunks(docs: DataFrame, id_col: str, text: Column, chunk: int, overlap: int) -> DataFrame:
    """``id, row, k, body, complete``: the chunks of each text; ``row`` tells the input's rows apart.

    Written once, so that a row's number stays the same however often the chunks are read.
    """
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), parts.alias("parts"))
    following = F.transform("parts", lambda c, k: F.struct(
        F.concat(c, F.coalesce(F.substring(F.get(F.col("parts"), k + 1), 1, overlap), F.lit(""))).alias("body"),
        ((k + 1 == F.size("parts")) | ((k + 2 == F.size("parts")) & (
            F.char_length(F.get(F.col("parts"), k + 1)) <= overlap))).alias("complete")))
    chunks = rows.select("id", "row", F.posexplode(following).alias("k", "c")).select("id", "row", "k", "c.*")
    return materialize(chunks, "bpe-chunks")


def stitched(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``row, k, run, alone, begin, end``: chunk ``k`` counts from ``begin`` to ``end`` of its body.

    Chunks that aren't stitched to the one before share its ``run`` (``begin`` is null).
    """
    schema = "row long, k int, head array<int>, tail array<int>, in_step boolean"
    found = chunks.select("row", "k", "body", "complete").mapInArrow(_splitter(pattern, chunk, overlap), schema)
    by_row = Window.partitionBy("row").orderBy("k")
    common = F.array_min(F.array_intersect("tail", F.lead("head").over(by_row)))
    found = found.select("row", "k", F.when(F.col("in_step") | (F.col("k") == 0), common).alias("meet"))
    found = found.withColumn("begin", F.when(F.col("k") == 0, 0).otherwise(F.lag("meet").over(by_row)))
    found = found.withColumn("run", F.count("begin").over(by_row))
    return found.select("row", "k", "run", (F.count(F.lit(1)).over(Window.partitionBy("row", "run")) == 1).alias("alone"),
                        "begin", (F.col("meet") + chunk).alias("end"))


def pieces_of_chunks(chunks: DataFrame, stitches: DataFrame, chunk: int) -> DataFrame:
    """``id, row, part, text``: texts that can be split on their own and make up each row's text."""
    own = chunks.join(stitches, ["row", "k"])
    upto = F.coalesce(F.col("end"), F.char_length("body"))
    single = own.where("alone").select(
        "id", "row", F.col("run").alias("part"), F.expr("substring(body, begin + 1, coalesce(end, char_length(body)) - begin)").alias("text"))
    joint = (own.where("not alone").groupBy("id", "row", "run")
             .agg(F.sort_array(F.collect_list(F.struct("k", F.col("body"), upto.alias("upto"), "begin"))).alias("c")))
    whole = F.concat(
        F.array_join(F.transform(F.slice("c", F.lit(1), F.size("c") - 1), lambda x: F.substring(x["body"], 1, chunk)), ""),
        F.expr("substring(c[size(c) - 1].body, 1, c[size(c) - 1].upto)"))
    joint = joint.select("id", "row", F.col("run").alias("part"), F.col("c")[0]["begin"].alias("begin"), whole.alias("text"))
    return single.unionByName(joint.select("id", "row", "part", F.expr("substring(text, begin + 1)").alias("text")))


def bpe_encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
               chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[DataFrame, DataFrame]:
    """Two frames ``id, row, part, ids``: texts of one chunk (``row`` null, ``part`` 1), and longer ones.

    A longer text's ids are those of its parts in order; ``row`` tells rows apart that share an
    identifier. ``pattern`` must be the split of the rank files (see the module's notes on what is used of
    it) and ``ranks`` must hold every single byte. A null text counts as empty and has no ids.
    Repeated rows and null identifiers are kept as they are; other columns are ignored; an
    empty table gives empty frames.
    """
    if not 2 * LOOK < overlap < chunk - LOOK:
        raise ValueError("overlap must be shorter than a chunk")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the ranks lack a single byte")
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks})
    text = F.coalesce(F.col(text_col), F.lit(""))
    short = docs.where(F.char_length(text) <= chunk).select(
        F.col(id_col).alias("id"), F.lit(None).cast("long").alias("row"), F.lit(1).cast("long").alias("part"), text.alias("text"))
    chunks = cut_chunks(docs.where(F.char_length(text) > chunk), id_col, text, chunk, overlap)
    long = pieces_of_chunks(chunks, stitched(chunks, pattern, chunk, overlap), chunk)
    return tuple(_ids_of(df, "text", shared, pattern) for df in (short, long))


def bpe_decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` with ``data``, the bytes of each row's ``ids`` put together (a part may end inside a character)."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: data for data, rank in shared.value.items()}
        for batch in batches:
            data = [b"".join(map(token.__getitem__, ids.values.to_numpy().tolist())) for ids in batch.column("ids")]
            yield batch.append_column("data", pa.array(data, pa.binary()))

    return encoded.mapInArrow(decode, _nullable(encoded.withColumn("data", F.lit(b"")).schema))


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts in, one line per row out; only the running hashes are held."""
    row = doc = count = text = data = None

    def line(doc, count, text, data):
        return {"id": doc, "n_tokens": count, "ids_sha256": text.hexdigest(), "decoded_sha256": data.hexdigest()}

    for batch in batches:
        out = []
        for r, i, ids, joined, raw in zip(*(batch.column(c) for c in ("row", "id", "n", "joined", "data"))):
            if r.as_py() != row:
                if row is not None:
                    out.append(line(doc, count, text, data))
                row, doc, count, text, data = r.as_py(), i.as_py(), 0, hashlib.sha256(), hashlib.sha256()
            if ids.as_py():
                text.update((b"," if count else b"") + joined.as_py().encode())
                data.update(raw.as_py())
                count += ids.as_py()
        if out:
            yield pa.RecordBatch.from_pylist(out, _hash_schema(batch))
    if row is not None:
        yield pa.RecordBatch.from_pylist([line(doc, count, text, data)], _hash_schema(batch))


def _hash_schema(batch: pa.RecordBatch) -> pa.Schema:
    return pa.schema([("id", batch.schema.field("id").type), ("n_tokens", pa.int64()),
                      ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def in_order(long: DataFrame) -> DataFrame:
    """Each row's parts in one partition and in order; a text's ids are exchanged, not its bytes."""
    return long.repartition("row").sortWithinPartitions("row", "part")


def bpe_digests(short: DataFrame, long: DataFrame) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of decoded frames, a line per input row.

    The hashes are those of the decimal ids joined by commas and of the bytes. ``long`` must
    come with a row's parts in one partition, in order (``in_order``): they are hashed one after the other.
    """
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    one = short.select("id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
                       F.sha2("data", 256).alias("decoded_sha256"))
    parts = long.select("id", "row", F.size("ids").cast("long").alias("n"), joined.alias("joined"), "data")
    return one.unionByName(parts.mapInArrow(_hash_rows, _nullable(one.schema)))


def bpe_round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: every text encoded and decoded again, as ``bpe_encode`` says."""
    short, long = bpe_encode(docs, ranks, pattern, id_col, text_col, chunk, overlap)
    return bpe_digests(bpe_decode(short, ranks), bpe_decode(in_order(long), ranks)).withColumnRenamed("id", id_col)
