"""Benchmark decontamination with an FM-index per training shard.

A task gathers its documents into shards of ``SHARD_WORDS`` words. Each shard's word
sequence is indexed: suffix order, Burrows-Wheeler transform, a wavelet matrix over it for
ranks, and suffix positions sampled every ``SAMPLE`` places. All phrases (windows of
``WINDOW`` benchmark words, and whole items that are shorter) are searched backward at once,
their occurrences located by walking to the next sampled position, and the spans merged.

A word that no phrase holds can't be part of an occurrence: in the index it ends a stretch,
and a stretch shorter than the shortest phrase is left out. That loses nothing.

The phrases are the broadcast side. They are split in blocks of ``BLOCK_WORDS`` benchmark
words, a longer item in pieces, which bounds what is broadcast and held by the driver at once;
documents pass the blocks one after the other and are written in between with their hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import small_batches, tmp_name
from .words import ALNUM, hash_words, text_bytes

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1 << 21
SAMPLE = 8


def _named_first(name: str | None) -> tuple[bool, str]:
    return name is None, name or ""


class Phrases:
    """The distinct phrases of some items, as arrays of symbols from 1 on."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        seen: dict[bytes, int] = {}
        owners: list[set[int]] = []
        rows: list[np.ndarray] = []
        self.item_ids = sorted({i for i, _ in items}, key=_named_first)
        number = {i: n for n, i in enumerate(self.item_ids)}
        for item, text in items:
            words, _ = hash_words([text], ALNUM)
            width = min(window, len(words))
            for at in range(len(words) - width + 1 if width else 0):
                phrase = words[at:at + width]
                n = seen.setdefault(phrase.tobytes(), len(rows))
                if n == len(rows):
                    rows.append(phrase)
                    owners.append(set())
                owners[n].add(number[item])
        self.owners = [np.array(sorted(o)) for o in owners]
        self.length = np.array([len(r) for r in rows], dtype=np.int64)
        self.words = np.unique(np.concatenate(rows)) if rows else np.empty(0, np.uint64)
        # Right-aligned, so a backward search reads the columns from the last one.
        self.symbols = np.zeros((len(rows), window), dtype=np.int64)
        for n, r in enumerate(rows):
            self.symbols[n, window - len(r):] = np.searchsorted(self.words, r) + 1
        self.shortest = int(self.length.min()) if rows else 0

    def symbols_of(self, words: np.ndarray) -> np.ndarray:
        """The symbol of each word, 0 for a word that no phrase holds."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1, 0)


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``seq`` in order, by doubling the sorted length.

    Zeros end a stretch and sort by place, so no comparison goes past one.
    """
    n = len(seq)
    ends = seq == 0
    rank = np.where(ends, np.cumsum(ends) - 1, seq + int(ends.sum()))
    rank = np.unique(rank, return_inverse=True)[1]
    reach = 1
    while rank.max(initial=0) < n - 1:
        after = np.zeros(n, dtype=np.int64)
        after[:-reach] = rank[reach:] + 1
        after[ends] = 0
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
        reach *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Counts and locates words of a sequence that ends with 0; 0 separates stretches."""

    def __init__(self, seq: np.ndarray, symbols: int):
        order = suffix_order(seq)
        self.bwt = seq[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=symbols + 1))))
        begins = np.concatenate(([True], seq[:-1] == 0))
        sampled = begins[order] | (order % SAMPLE == 0)
        self.sampled, self.places = sampled, np.where(sampled, order, -1)
        # Wavelet matrix: per bit from the highest, ones before each place; zeros go first.
        self.levels = []
        now = self.bwt
        for bit in range(max(1, int(symbols).bit_length()) - 1, -1, -1):
            ones = (now >> bit) & 1
            self.levels.append((bit, np.concatenate(([0], np.cumsum(ones))), int(len(now) - ones.sum())))
            now = np.concatenate((now[ones == 0], now[ones == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands among the first ``upto`` places of the transform."""
        lo, hi = np.zeros_like(upto), upto
        for bit, ones, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            lo = np.where(one, zeros + ones[lo], lo - ones[lo])
            hi = np.where(one, zeros + ones[hi], hi - ones[hi])
        return hi - lo

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row interval ``[lo, hi)`` of each right-aligned phrase; 0 pads on the left."""
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), len(self.bwt), dtype=np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[:, column]
            on = np.flatnonzero((symbol > 0) & (hi > lo))
            s = symbol[on]
            lo[on], hi[on] = self.first[s] + self.rank(s, lo[on]), self.first[s] + self.rank(s, hi[on])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the sequence of each row: step back until a sampled one, add the steps."""
        at, found = rows.copy(), np.full(len(rows), -1, dtype=np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            here = at[open_]
            done = self.sampled[here]
            found[open_[done]] = self.places[here[done]] + steps
            open_ = open_[~done]
            symbol = self.bwt[at[open_]]
            at[open_] = self.first[symbol] + self.rank(symbol, at[open_])
            steps += 1
        return found


def _stretches(symbols: np.ndarray, shortest: int) -> np.ndarray:
    """Places to index: those in runs of phrase words at least ``shortest`` long."""
    inside = np.concatenate(([0], (symbols > 0).astype(np.int8), [0]))
    step = np.diff(inside)
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = end - begin >= shortest
    edge = np.zeros(len(symbols) + 1, dtype=np.int64)
    edge[begin[long]] += 1
    edge[end[long]] -= 1
    return np.flatnonzero(np.cumsum(edge[:-1]))


def shard_occurrences(words: np.ndarray, offsets: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of the phrases in a shard: ``(phrase, first word)``; none spans two documents."""
    nothing = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(words) or not phrases.shortest:
        return nothing
    symbols = phrases.symbols_of(words)
    # A place of 0 after each document.
    spaced = np.zeros(len(words) + len(offsets) - 1, dtype=np.int64)
    where = np.arange(len(words)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    spaced[where] = symbols
    back = np.zeros(len(spaced), dtype=np.int64)
    back[where] = np.arange(len(words))
    keep = _stretches(spaced, phrases.shortest)
    if not len(keep):
        return nothing
    # Kept places, with a 0 wherever the next kept place isn't the next one of the text.
    gap = np.append(np.diff(keep) > 1, True)
    to = np.arange(len(keep)) + np.concatenate(([0], np.cumsum(gap)[:-1]))
    seq = np.zeros(len(keep) + int(gap.sum()), dtype=np.int64)
    seq[to] = spaced[keep]
    source = np.zeros(len(seq), dtype=np.int64)
    source[to] = back[keep]
    index = FMIndex(seq, len(phrases.words))
    lo, hi = index.search(phrases.symbols)
    count = hi - lo
    rows = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(np.arange(len(lo)), count), source[index.locate(rows)]


def _mark(texts: list[bytes], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """For each text of a shard: words, merged spans of word numbers, items found."""
    words, offsets = hash_words(texts, ALNUM)
    which, at = shard_occurrences(words, offsets, phrases)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + phrases.length[which], -1)
    inside = np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]))
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    if len(at):
        step = np.diff(inside)
        # A stretch of hits may run on into the next document: cut it there.
        cuts = offsets[1:-1][(inside[1:-1][offsets[1:-1] - 1] > 0) & (inside[1:-1][np.minimum(offsets[1:-1], len(words) - 1)] > 0)
                             & (offsets[1:-1] > 0) & (offsets[1:-1] < len(words))]
        cuts = np.unique(cuts)
        begin = np.sort(np.concatenate((np.flatnonzero(step == 1), cuts)))
        end = np.sort(np.concatenate((np.flatnonzero(step == -1), cuts)))
        doc = np.searchsorted(offsets, begin, side="right") - 1
        for d, b, e in zip(doc.tolist(), (begin - offsets[doc]).tolist(), (end - offsets[doc]).tolist()):
            spans[d].append((b, e))
        pairs = np.unique(np.stack((np.searchsorted(offsets, at, side="right") - 1, which)), axis=1)
        for d, w in pairs.T.tolist():
            items[d].update(phrases.owners[w].tolist())
    return [(int(n), s, [phrases.item_ids[k] for k in sorted(i)])
            for n, s, i in zip(np.diff(offsets), spans, items)]


def merge_spans(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted([*a, *b]):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _searcher(shared, text_col: str, p: str):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases([])
        phrases.__dict__.update(shared.value)
        for batch in batches:
            texts = text_bytes(batch.column(text_col))
            found, lo, held = [], 0, 0
            for i, t in enumerate(texts):
                held += len(t)
                if held >= 6 * SHARD_WORDS or i == len(texts) - 1:  # about six bytes a word
                    found += _mark(texts[lo:i + 1], phrases)
                    lo, held = i + 1, 0
            old = batch.select([p + "spans", p + "items"]).to_pylist()
            rows = [{"words": n,
                     "spans": [{"begin": b, "end": e} for b, e in merge_spans(
                         [(x["begin"], x["end"]) for x in o[p + "spans"]], s)],
                     "items": sorted({*o[p + "items"], *i}, key=_named_first)}
                    for (n, s, i), o in zip(found, old)]
            kept = [c for c in batch.schema.names if not c.startswith(p)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept),
                 pa.array([r["words"] for r in rows], pa.int64()),
                 pa.array([r["spans"] for r in rows], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array([r["items"] for r in rows], pa.list_(pa.string()))],
                names=[*kept, p + "words", p + "spans", p + "items"])
    return search


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def pieces(text: bytes, words: int, window: int = WINDOW) -> Iterator[bytes]:
    """``text`` in stretches that together hold each of its windows; about ``words`` words each."""
    if len(text) <= 6 * words:  # about six bytes a word
        yield text
        return
    places = [m.span() for m in _WORD.finditer(text)]
    for at in range(0, max(1, len(places) - window + 1), words):
        held = places[at:at + words + window - 1]
        yield text[held[0][0]:held[-1][1]] if held else b""


def phrase_blocks(items: DataFrame, item_col: str = "item_id", text_col: str = "text",
                  window: int = WINDOW) -> Iterator[Phrases]:
    """Blocks of phrases of at most about ``BLOCK_WORDS`` words; a longer item is in several."""
    held: list[tuple[str, bytes]] = []
    size = 0
    rows = items.select(F.col(item_col).cast("string"), F.col(text_col))
    for item, text in rows.toLocalIterator():
        for data in pieces((text or "").encode(), BLOCK_WORDS, window):
            if held and size + len(data) > 6 * BLOCK_WORDS:
                yield Phrases(held, window)
                held, size = [], 0
            held.append((item, data))
            size += len(data)
    if held:
        yield Phrases(held, window)


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Every column of ``docs`` plus ``n_words, n_hit, n_items, hit_items, hit_spans``.

    Words are runs of ASCII letters, digits and code points over 0x7F, A-Z lower-cased. A word
    inside an occurrence of a phrase is hit. ``hit_spans`` are the merged spans ``(begin, end)``
    of word numbers from 0, end exclusive; ``hit_items`` the item identifiers as sorted strings.
    A null or empty text has no words; an item without words has no phrases;
    items that repeat an identifier count as one. Items without identifier hit words like
    others; together they are one more item in ``n_items``, without a name in ``hit_items``. Repeated rows get equal results. Input
    columns named like added ones are replaced. An empty table gives an empty result.
    """
    small_batches(docs)
    p = tmp_name(docs)
    added = ("n_words", "n_hit", "n_items", "hit_items", "hit_spans")
    own = [c for c in docs.columns if c not in added]
    span = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    result = docs.select(*own, F.lit(0).cast("long").alias(p + "words"), F.array().cast(span).alias(p + "spans"),
                         F.array().cast("array<string>").alias(p + "items"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in result.schema])
    spark = docs.sparkSession
    blocks = phrase_blocks(items, window=window)
    block = next(blocks, Phrases([]))  # without items the words are counted all the same
    while block is not None:
        shared = spark.sparkContext.broadcast(vars(block))
        result = result.mapInArrow(_searcher(shared, text_col, p), schema)
        block = next(blocks, None)
        if block is not None:  # one block at a time is held by the driver and the tasks
            result = materialize(result, "fm-block")
            shared.destroy()
    hits = F.aggregate(p + "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return result.select(*own, F.col(p + "words").alias("n_words"), hits.alias("n_hit"),
                         F.size(p + "items").cast("long").alias("n_items"),
                         F.array_compact(p + "items").alias("hit_items"), F.col(p + "spans").alias("hit_spans"))
