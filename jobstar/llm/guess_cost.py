"""Secret scans: fixed patterns, and guess costs of values that stand where credentials do.

The guess cost of a value is the least number of guesses (in bits) over all ways to cut it
into words, dates, repeats, keyboard walks and characters guessed one by one. It is found by
dynamic programming over the value's places. Every end of a walk (from three characters on) and
every whole number of repetitions is tried, beside the words and dates of bounded length; the
unit of a repeat has at most ``_MAX_UNIT`` characters. Words are those of ``COMMON_WORDS`` and the
most frequent ones of the corpus, by the number of documents that hold them: a guesser tries them
in that order, so the bits of a word are those of its rank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import inf, log2

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import small_batches

# The patterns of the base kinds, in their order.
_LETTERS = re.ASCII | re.IGNORECASE
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _LETTERS)
ASSIGN_HINT = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so this is [0-9a-f]+ with at least 16 characters
KINDS = ("assign", "access", "hex", "guess")

# Where a credential's value stands, beyond the base keywords.
CONTEXT = re.compile(r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|api_?key|private_?key|access_?key)"""
                     r"""["']?[\x20\t]*(?::|=|\bis\b(?=\s+\S*\d))[\x20\t]*["']?([^\s"'<>,;]+)""", _LETTERS)
CONTEXT_HINT = ("pass", "pwd", "secret", "token", "credential", "auth", "apikey", "api_key",
                "privatekey", "private_key", "accesskey", "access_key")
MIN_BITS = 40.0
MAX_WORDS = 50_000  # corpus words that are broadcast
MIN_DOCS = 3  # documents that must hold a word

# Frequent passwords and words in them, most frequent first.
COMMON_WORDS = """password qwerty admin welcome login letmein monkey dragon master shadow
sunshine princess football baseball superman batman trustno hello freedom whatever secret
love test user guest root default change summer winter spring autumn january february march
april may june july august september october november december monday friday sunday michael
jordan hunter ranger buster soccer hockey killer george charlie andrew thomas robert daniel
jessica jennifer ashley nicole pepper ginger cookie banana orange apple flower angel star
money lucky magic happy purple silver golden matrix access internet computer server system
example sample demo temp pass token key""".split()
_WORD_BITS = {w: log2(n + 2) for n, w in reversed(list(enumerate(COMMON_WORDS)))}
_LONGEST_WORD = 24
_LEET = str.maketrans("013457@$!", "oleastasi")
_KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
_NEXT = {(a, b): step for row in _KEY_ROWS for step, pairs in ((1, zip(row, row[1:])), (-1, zip(row[1:], row)))
         for a, b in pairs}
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
_YEAR = re.compile(r"(?:19|20)\d\d")
_DATE_BITS, _YEAR_BITS = log2(130 * 365 * 4), log2(130)
_CLASS_BITS = {"lower": log2(26), "upper": log2(26), "digit": log2(10), "ascii": log2(33), "other": log2(1000)}
_PIECE_BITS = 1.0  # each cut costs a guess between two ways to go on
_MAX_UNIT = 8  # characters of a repeated piece


def _char_bits(c: str) -> float:
    if "a" <= c <= "z":
        return _CLASS_BITS["lower"]
    if "A" <= c <= "Z":
        return _CLASS_BITS["upper"]
    if "0" <= c <= "9":
        return _CLASS_BITS["digit"]
    return _CLASS_BITS["ascii"] if c < "\x7f" else _CLASS_BITS["other"]


def _longest_walks(lower: str) -> list[int]:
    """For each place the end of the longest walk along a key row that begins there."""
    n = len(lower)
    end, step = [i + 1 for i in range(n)], [0] * n
    for i in range(n - 2, -1, -1):
        way = _NEXT.get((lower[i], lower[i + 1]), 0)
        if way:
            step[i] = way
            end[i] = end[i + 1] if step[i + 1] == way else i + 2
    return end


def _longest_repeats(value: str, unit: int) -> list[int]:
    """For each place how many characters on the value repeats with this period."""
    n = len(value)
    same = [0] * (n + 1)
    for i in range(n - unit - 1, -1, -1):
        same[i] = same[i + 1] + 1 if value[i] == value[i + unit] else 0
    return same


def corpus_words(docs: DataFrame, text_col: str = "text", most: int = MAX_WORDS, min_docs: int = MIN_DOCS) -> dict[str, float]:
    """Bits of the words that the most documents hold, at most ``most``, and of ``COMMON_WORDS``.

    A word is a run of 3 to ``_LONGEST_WORD`` letters in lower case, held by ``min_docs`` documents or more;
    all documents are counted. Words held by equally many documents are in or out together. Only
    the chosen words come to the driver, after a line for each number of documents.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit(rf"(?<!\p{{L}})(\p{{L}}{{3,{_LONGEST_WORD}}})(?!\p{{L}})")))
    counted = materialize(docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("docs"))
                          .where(F.col("docs") >= min_docs), "word-counts")
    least, taken = None, 0
    for level in counted.groupBy("docs").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("docs")).limit(most).collect():
        if taken + level["n"] > most:
            break
        least, taken = level["docs"], taken + level["n"]
    held = counted.where(F.col("docs") >= least).collect() if taken else []
    held.sort(key=lambda r: (-r["docs"], r["word"]))
    bits = {r["word"]: log2(rank + 2) for rank, r in enumerate(held)}
    return bits | {w: min(b, bits.get(w, b)) for w, b in _WORD_BITS.items()}


def guess_bits(value: str, words: dict[str, float] | None = None) -> float:
    """The least bits over all segmentations of ``value``; 0 for an empty one. ``words`` gives the bits of
    words in lower case (by default ``COMMON_WORDS``)."""
    words = _WORD_BITS if words is None else words
    n = len(value)
    lower = value.lower() if value.isascii() else "".join(c.lower() if c.isascii() else c for c in value)
    plain = lower.translate(_LEET)
    best = [0.0] + [float("inf")] * n
    walks = _longest_walks(lower)
    repeats = [(u, _longest_repeats(value, u), [[] for _ in range(u)])
               for u in range(1, min(_MAX_UNIT, n // 2) + 1)]

    def reach(end: int, bits: float) -> None:
        if bits < best[end]:
            best[end] = bits

    for i in range(n + 1):
        # Repeats that may end here, by start: ``(start, last end, bits but for the times)``. A later
        # start that an earlier one beats once loses to it at every end that both reach.
        for u, _, starts in repeats:
            open_ = []
            for s in starts[i % u]:
                times = (i - s[0]) // u
                bits = s[2] + log2(times)
                if s[1] < i or times >= 2 and any(e[1] >= s[1] and e[2] + log2((i - e[0]) // u) <= bits for e in open_):
                    continue
                open_.append(s)
                if times >= 2 and u * times >= 3:
                    reach(i, bits)
            starts[i % u] = open_
        if i == n:
            break
        now = best[i]
        reach(i + 1, now + _char_bits(value[i]))
        now += _PIECE_BITS
        for size in range(2, min(_LONGEST_WORD, n - i) + 1):
            w = min(words.get(plain[i:i + size], inf), words.get(lower[i:i + size], inf))
            if w < inf:
                piece = value[i:i + size]
                changed = (piece != lower[i:i + size]) + (lower[i:i + size] not in words)
                reach(i + size, now + w + changed * log2(size + 1))
        if value[i].isdigit():
            for pattern, bits in ((_DATE, _DATE_BITS), (_YEAR, _YEAR_BITS)):
                m = pattern.match(value, i)
                if m:
                    reach(m.end(), now + bits)
        if walks[i] - i >= 3:
            for end in range(i + 3, walks[i] + 1):
                reach(end, now + log2(len("".join(_KEY_ROWS)) * 2) + log2(end - i))
        for u, same, starts in repeats:
            if same[i] >= u:
                bits = now + sum(map(_char_bits, value[i:i + u]))
                if not any(e[1] >= i + u + same[i] and e[2] + log2((i - e[0]) // u + 2) <= bits + 1 for e in starts[i % u]):
                    starts[i % u].append((i, i + u + same[i], bits))
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds; kind is a place in ``KINDS``."""
    spans = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINT):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def added_spans(text: str, base: list[tuple[int, int, int]], min_bits: float = MIN_BITS,
                words: dict[str, float] | None = None) -> list[tuple[int, int, int]]:
    """Values in a credential's place that overlap no base span and cost ``min_bits`` or more."""
    low = text.lower()
    if not any(h in low for h in CONTEXT_HINT):
        return []
    spans, at, covered_to = [], 0, -1
    for m in CONTEXT.finditer(text):
        begin, end = m.span(1)
        while at < len(base) and base[at][0] < end:
            covered_to = max(covered_to, base[at][2])
            at += 1
        if covered_to <= begin and guess_bits(m.group(1), words) >= min_bits:
            spans.append((begin, 3, end))
    return spans


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{b}:{e}" for b, k, e in spans)


def _scan(min_bits: float, text_col: str, names: list[str], shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            counts, base, spans = ([], [], []), [], []
            for text in texts:
                own = base_spans(text or "")
                for kind, count in enumerate(counts):
                    count.append(sum(k == kind for _, k, _ in own))
                base.append(_joined(own))
                spans.append(_joined(sorted(own + added_spans(text or "", own, min_bits, words))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()),
                 pa.array(spans, pa.string())], names=[*batch.schema.names, *names])
    return scan


def scan_secrets(docs: DataFrame, text_col: str = "text", min_bits: float = MIN_BITS,
                 words: dict[str, float] | None = None) -> DataFrame:
    """Every column of ``docs`` plus ``n_assign, n_access, n_hex, base_spans, spans``.

    Spans read ``kind:start:end`` in code points, end exclusive, by start and then kind, joined
    with commas; ``spans`` holds the base ones and those added as ``guess``. An added value
    stands in a credential's place, overlaps no base span and costs at least ``2 ** min_bits``
    guesses, given the frequent words of ``docs`` (or ``words``). A place follows a keyword such as ``pwd`` or
    ``credential`` that no letter stands before, and a colon or equals sign (or ``is``, if the value
    has a digit). A null or empty text has none; equal texts get equal spans. Input columns named
    like added ones are replaced. An empty table gives an empty result.
    """
    names = ["n_assign", "n_access", "n_hex", "base_spans", "spans"]
    small_batches(docs)
    own = docs.drop(*names)
    schema = T.StructType([*own.schema.fields, *(T.StructField(n, T.LongType()) for n in names[:3]),
                           *(T.StructField(n, T.StringType()) for n in names[3:])])
    words = corpus_words(docs, text_col) if words is None else words
    return own.mapInArrow(_scan(min_bits, text_col, names, docs.sparkSession.sparkContext.broadcast(words)), schema)
