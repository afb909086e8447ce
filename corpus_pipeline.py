"""The corpus pipeline: documents in, shards of a clean, mixed corpus out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes what a stage returns as Parquet in the shared
folder and reads it again as the next stage's documents, so a lost executor costs at most
the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobstar.llm.common import tmp_name
from jobstar.llm.fm_index import find_contamination
from jobstar.llm.histogram_sort import histogram_sort_shards
from jobstar.llm.ngram_join import ngram_components
from jobstar.llm.pareto_mix import mix
from jobstar.llm.pu_toxicity import fit_model, score_toxicity
from jobstar.session import ensure_checkpoint_dir, materialize
from jobstar.sources.tables import read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts to be toxic go.

    Each row is judged by its text alone (null counts as empty); repeated rows and rows without
    identifier are judged alike. Without labels nothing is rejected; an empty table stays empty.
    """
    ensure_checkpoint_dir(spark)
    model = fit_model(docs, read_table(spark, sf_dir, "labels"))
    p = tmp_name(docs)
    own = docs.withColumnsRenamed({c: p + c for c in docs.columns if c in ("score", "predicted")})
    kept = score_toxicity(own, model).where("predicted = 0")
    return kept.select(*[F.col(p + c if p + c in own.columns else c).alias(c) for c in docs.columns])


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that of the least identifier.

    Decisions are made for rows, not for identifiers: rows that repeat an identifier with different
    texts are judged on their own, exact repeats of a row are copies of each other, and rows
    without identifier come after all others of their group, so one of them stays only where none has
    an identifier. Null and empty texts have no near duplicates and stay. Other columns are kept as they are; an
    empty table stays empty.
    """
    ensure_checkpoint_dir(spark)
    p = tmp_name(docs)
    # Written with a row number, which names the rows in the join and in what follows from it.
    docs = materialize(docs.withColumn(p, F.monotonically_increasing_id()), "jaccard-rows")
    group = ngram_components(docs.select(F.col(p).alias("row"), "text"), "row").select(
        F.col("row").alias(p + "at"), F.col("component_id").alias(p + "group"))
    ranked = docs.select(p, F.col("doc_id").isNull().alias(p + "null"), F.col("doc_id").alias(p + "id"))
    ranked = ranked.join(group, F.col(p) == F.col(p + "at"))
    stay = (ranked.groupBy(p + "group").agg(F.min(F.struct(p + "null", p + "id", p)).alias("first"))
            .select(F.col(f"first.{p}").alias(p + "stay")))
    return docs.join(stay, F.col(p) == F.col(p + "stay"), "left_semi").drop(p)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go.

    Each row is judged by its text alone: one without words stays, repeated rows share their fate.
    Items without identifier count like others. An empty table stays empty.
    """
    ensure_checkpoint_dir(spark)
    p = tmp_name(docs)
    added = ("n_words", "n_hit", "n_items", "hit_items", "hit_spans")
    own = docs.withColumnsRenamed({c: p + c for c in docs.columns if c in added})
    kept = find_contamination(own, read_table(spark, sf_dir, "benchmark")).where("n_hit = 0")
    return kept.select(*[F.col(p + c if p + c in own.columns else c).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source near its target of words; a document is repeated as often as it is taken.

    Rows without words are never taken. A null source is one of its own; repeated rows and rows
    without identifier draw on their own. An empty table stays empty.
    """
    ensure_checkpoint_dir(spark)
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with shard and slot; 40 shards of near equal bytes.

    Every row gets a place, rows without text or identifier and repeated rows as well, however many
    are alike. Columns named like added ones are replaced. An empty table stays empty.
    """
    ensure_checkpoint_dir(spark)
    return histogram_sort_shards(docs, shards=40)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", jaccard), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

# The toxicity stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
