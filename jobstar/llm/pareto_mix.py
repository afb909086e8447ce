"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words: a share of all words by weight, stopped at
``max_copies`` times the source's own words, what is over being shared again by weight.
A document's expected copies are target / words of its source, times its own weight if one
is given. The whole part is taken for certain. The fractional part is its inclusion
probability p, and with a uniform number u from its identifier the documents of a source are
ranked by ``(u / (1 - u)) / (p / (1 - p))`` and taken in that order until the target is met:
a sample of fixed size with unequal probabilities.

The cut in that order is found without sorting a source: words are summed per bin of the
rank (map-side combined), the bin that holds the cut is opened in finer bins, and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import with_totals
from ..operators.ranges import running_sum
from ..session import materialize
from .common import BLANK_WORD, numbered, tmp_name

WEIGHTS = (5, 2, 1)  # of the sources in code point order, repeating
SHARE = 1.5
MAX_COPIES = 2
BITS = 11  # of the rank, opened per round
RANK_BITS = 44
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target`` per source; ``sized`` has ``source, size``.

    Sources, however many, are numbered and summed through over range partitions. With sources
    sorted by cap / weight, those up to some place are capped and the rest share what is left by
    weight; the place is the last one whose cap is at most the level ``left / weights`` that it
    would leave.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    # Null sorts first in a range exchange: its place is set aside and is the last one.
    one = sums.withColumns({"all": F.lit(0), "last": F.col("source").isNull()})
    placed = numbered(one, "all", ["last", "source"], "place", few_groups=True)
    w = placed.withColumn("w", F.get(cycle, (F.col("place") % len(weights)).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * float(max_copies))
    w = w.select("source", "source_size", "all", "w", "cap", F.struct(F.col("cap") / F.col("w"), "place").alias("order"))
    through = running_sum(w, ["all"], "order", "cap", "caps")
    through = running_sum(through, ["all"], "order", "w", "ws")
    left = F.col("caps_total") / float(max_copies) * F.lit(float(share)) - (F.col("caps") - F.col("cap"))
    level = left / (F.col("ws_total") - (F.col("ws") - F.col("w")))
    w = through.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("level") * F.col("w"))
    # Levels rise up to the first source that isn't capped and fall from there: its level holds.
    w = with_totals(w, w.agg(F.max(F.when(~F.col("capped"), F.col("level"))).alias("flat")))
    return w.select("source", "source_size",
                    F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * F.col("flat")).alias("target"))


def pareto_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weight: Column | None = None, weights=WEIGHTS, share: float = SHARE,
                  max_copies: int = MAX_COPIES, seed: int = 9) -> DataFrame:
    """Every column of ``docs`` plus ``size, source_size, target, copies, taken``.

    ``size`` counts the words of the text (null: 0), ``copies`` is how often the document is
    taken (0 to ``max_copies``) and ``taken`` the words. A null source is a source of its own,
    the last. A row draws its number from identifier and text, and from its place among the rows that
    repeat both, so reruns agree and neither copies nor rows without identifier go in lockstep. ``weight`` (positive, null: 1) raises a document's odds inside its source.
    A source without words has target 0, and its documents are taken 0 times.
    Input columns named like added ones are replaced. An empty table gives an empty result.
    """
    p = tmp_name(docs)
    own = [c for c in docs.columns if c not in ADDED]
    draw = F.xxhash64(F.col(id_col).cast("string"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(seed))
    docs, draw = _apart(docs, draw, p)
    keyed = docs.select(*own, word_count(F.col(text_col)).alias("size"),
                        draw.alias(p + "draw"), F.coalesce(weight if weight is not None else F.lit(1.0), F.lit(1.0)).cast("double").alias(p + "w"))
    thin = materialize(keyed.select(F.col(source_col).alias("source"), F.col(p + "draw").alias("draw"), F.col(p + "w").alias("w"), "size"), "mix-sizes")
    plan = materialize(source_targets(thin, weights, share, max_copies)
                       .join(thin.groupBy("source").agg(F.try_divide(F.sum(F.col("w") * F.col("size")), F.sum("size")).alias("mean_w"))
                             .withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2"), "mix-targets")
    cuts = _cuts(thin, plan, max_copies)
    rows = keyed.join(cuts.withColumnRenamed("source", p + "source"),
                      F.col(source_col).eqNullSafe(F.col(p + "source")), "left")
    whole, rank = _whole_and_rank(F.col(p + "draw"), F.col(p + "w"), F.col("size"), max_copies)
    copies = whole + F.when((whole < max_copies) & (rank < F.col("cut")), 1).otherwise(0)
    return (rows.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("int"))
            .select(*own, "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).cast("long").alias("taken")))


def _apart(docs: DataFrame, draw: Column, p: str) -> tuple[DataFrame, Column]:
    """``docs`` and a draw that differs between rows of equal ``draw``.

    Where some rows repeat, the table is written once with a row number, and the repeats, however
    many, are numbered through without gaps; the numbers' multiset doesn't depend on the rows' order.
    """
    draws = docs.select(draw.alias(p + "draw"))
    if draws.groupBy(p + "draw").count().where("count > 1").isEmpty():
        return docs, draw
    docs = materialize(docs.withColumns({p + "draw": draw, p + "row": F.monotonically_increasing_id()}), "mix-rows")
    often = docs.groupBy(p + "draw").count().where("count > 1").select(F.col(p + "draw").alias(p + "of"))
    repeats = docs.select(p + "draw", p + "row").join(often, F.col(p + "draw") == F.col(p + "of"), "left_semi")
    places = numbered(repeats, p + "draw", [p + "row"], p + "place").select(F.col(p + "row").alias(p + "at"), p + "place")
    docs = docs.join(places.where(F.col(p + "place") > 0), F.col(p + "row") == F.col(p + "at"), "left")
    return docs, F.when(F.col(p + "place").isNull(), F.col(p + "draw")).otherwise(F.xxhash64(p + "draw", p + "place"))


def _whole_and_rank(draw: Column, w: Column, size: Column, max_copies: int) -> tuple[Column, Column]:
    """Certain copies, and the Pareto rank as an integer of ``RANK_BITS`` bits in odds order."""
    expected = F.least(F.lit(float(max_copies)),
                       F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)) * w / F.col("mean_w"), F.lit(0.0)))
    whole = F.floor(expected)
    p = F.greatest(expected - whole, F.lit(1e-9))
    u = (draw.bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)
    odds = (u / (1 - u)) / (p / F.greatest(1 - p, F.lit(1e-9)))
    # x / (1 + x) keeps the order and maps the odds to [0, 1).
    return whole, F.least(F.floor(odds / (1 + odds) * float(1 << RANK_BITS)), F.lit((1 << RANK_BITS) - 1))


def _cuts(thin: DataFrame, plan: DataFrame, max_copies: int) -> DataFrame:
    """``plan`` with ``cut``: ranks below it are taken once more, words nearest to the target."""
    state = plan.select("source", "source_size", "target", "mean_w", F.lit(0).cast("long").alias("lo"),
                        F.lit(None).cast("double").alias("need"))
    bits = RANK_BITS
    while bits > 0:
        step = max(0, bits - BITS)
        rows = thin.withColumnRenamed("source", "s").join(state, F.col("s").eqNullSafe(F.col("source")))
        whole, rank = _whole_and_rank(F.col("draw"), F.col("w"), F.col("size"), max_copies)
        rows = rows.select("source", "size", "lo", whole.alias("whole"), rank.alias("rank"))
        sums = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("certain"))
        in_bin = (F.col("whole") < max_copies) & (F.shiftright("rank", bits) == F.shiftright("lo", bits))
        bins = (rows.where(in_bin).groupBy("source", F.shiftright(F.col("rank") - F.col("lo"), step).alias("bin"))
                .agg(F.sum("size").alias("words")))
        bins = bins.withColumnRenamed("source", "bs")
        known = state.join(sums.withColumnRenamed("source", "cs"), F.col("source").eqNullSafe(F.col("cs")), "left").drop("cs")
        known = known.withColumn("need", F.coalesce("need", F.col("target") - F.coalesce("certain", F.lit(0))))
        by = Window.partitionBy("source").orderBy("bin")
        upto = bins.join(known, F.col("bs").eqNullSafe(F.col("source"))).withColumn(
            "through", F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        # Per source at most 2 ** BITS bins. The bin that holds the cut is the first to go past it.
        opened = (upto.where(F.col("through") > F.col("need"))
                  .groupBy(F.col("source").alias("os"))
                  .agg(F.min_by(F.struct("bin", (F.col("through") - F.col("words")).alias("below"), "words"), "bin").alias("o")))
        nxt = known.join(opened, F.col("source").eqNullSafe(F.col("os")), "left")
        if step == 0:
            # One rank (in practice one document) is left: take it if that comes nearer.
            over = F.col("o.words") - (F.col("need") - F.col("o.below"))
            last = F.when(over < F.col("need") - F.col("o.below"), 1).otherwise(0)
            lo = F.col("lo") + F.coalesce(F.col("o.bin") + last, F.lit(1 << bits))
        else:
            lo = F.col("lo") + F.coalesce(F.shiftleft(F.col("o.bin"), step), F.lit(1 << bits) - 1)
        need = F.col("need") - F.coalesce(F.col("o.below"), F.lit(0))
        state = materialize(nxt.select("source", "source_size", "target", "mean_w", lo.cast("long").alias("lo"), need.cast("double").alias("need")), "mix-cuts")
        bits = step
    return state.select("source", "source_size", "target", "mean_w", F.col("lo").alias("cut"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; the columns stay the same."""
    p = tmp_name(docs)
    clash = {c: p + c for c in docs.columns if c in ADDED}
    taken = pareto_copies(docs.withColumnsRenamed(clash), **options).where("copies > 0")
    return (taken.withColumn(p, F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns]))
