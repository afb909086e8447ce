"""The registered queries of the training-data operators and, where SQL has a form, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.tables import read_table
from .chunk_bpe import bpe_round_trip, read_ranks
from .content_sort import content_sort_groups
from .equal_average import compress_vectors
from .fm_index import find_contamination
from .gnat_negatives import mine_hard_negatives
from .guess_cost import scan_secrets
from .histogram_sort import histogram_sort_shards
from .line_runs import dedup_lines
from .ngram_join import ngram_links
from .pareto_mix import pareto_copies
from .pu_toxicity import fit_model, held_out, score_toxicity
from .tool_links import CHAT_SCHEMAS, chat_calls, link_tool_calls
from .warc_normal import warc_round_trip

_FOLDED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_links(read_table(spark, sf_dir, "documents"))


def op2_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP2_SQL = f"""
WITH doc AS (
    SELECT doc_id, {_WORDS.format(_FOLDED.format("text"))} AS w FROM documents),
item AS (
    SELECT item_id, {_WORDS.format(_FOLDED.format("text"))} AS w FROM benchmark),
phrase AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
width AS (SELECT DISTINCT n FROM phrase),
place AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
          FROM doc CROSS JOIN width WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, n, i FROM place JOIN phrase USING (n, p)),
hit AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM found) GROUP BY doc_id),
names AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)"""


def op3_warc_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_round_trip(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
SELECT page_id, CAST(strlen(p) AS BIGINT) AS payload_bytes, sha1(p) AS payload_digest,
       CASE WHEN strlen(p) >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(p) >= 1000 AND page_id < last THEN last END AS refers_to
FROM (SELECT page_id, p, max(page_id) OVER (PARTITION BY p) AS last
      FROM (SELECT page_id, coalesce(html, '') AS p FROM pages))"""


def op4_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat_calls(read_table(spark, sf_dir, "conversations"))
    linked = link_tool_calls(calls, results, CHAT_SCHEMAS)
    return linked.withColumnsRenamed({"conv": "conv_id", "id": "call_id"}).withColumn(
        "errors", F.array_join("errors", "; "))


def op5_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return histogram_sort_shards(docs, shards=40, columns=["doc_id"])


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dedup_lines(read_table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_SQL = """
WITH lines AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
          FROM documents)),
owners AS (
    SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10
    GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE owner IS NOT NULL AND owner <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN owners USING (k) GROUP BY doc_id"""


def op7_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op8_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort_groups(read_table(spark, sf_dir, "documents"), keep="largest")


OP8_SQL = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, {_FOLDED.format("text")} AS norm FROM documents)
WINDOW g AS (PARTITION BY norm)"""


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return pareto_copies(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_model(docs, read_table(spark, sf_dir, "labels"))
    return (score_toxicity(docs, model)
            .select("doc_id", held_out().alias("held_out"), "score", "predicted"))


def op11_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine_hard_negatives(rows, anchors=F.expr("vec_id % 100 = 0"))


# Components as whole numbers; rows with a null vector or a null or non-finite component are left out.
_WHOLE = """list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
OP11_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           {_WHOLE.format(scale=256)} AND label IS NOT NULL),
score AS MATERIALIZED (
    SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.r AS other, b.vec_id,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s
    FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positive AS (
    SELECT r, anchor_id, other, vec_id AS positive_id, s AS positive_score FROM score WHERE same
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY s DESC, vec_id NULLS LAST, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY r, p.other ORDER BY s DESC, vec_id NULLS LAST, score.other) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, s AS negative_score
FROM positive p JOIN score USING (r, anchor_id)
WHERE NOT same AND 100 * s BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10"""


def op12_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe_round_trip(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)


def op13_equal_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compress_vectors(read_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _op13_sql() -> str:
    assigned = """a{i} AS MATERIALIZED (
    SELECT r, p.part, p.x, min(CAST(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x)
                                    + list_inner_product(b.x, b.x) AS BIGINT) * 256 + entry) AS best
    FROM cut p JOIN b{i} b ON p.part = b.part GROUP BY r, p.part, p.x)"""
    grown = """b{j} AS MATERIALIZED (
    SELECT part, entry, coalesce(m.x, old.x) AS x FROM b{i} old LEFT JOIN (
        SELECT part, entry, list(floor_of ORDER BY place) AS x FROM (
            SELECT part, best % 256 AS entry, place, CAST((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) AS BIGINT)
                   / count(*) AS floor_of
            FROM (SELECT part, best, unnest(x)::BIGINT AS c, generate_subscripts(x, 1) AS place FROM a{i})
            GROUP BY part, best % 256, place) GROUP BY part, entry) m USING (part, entry))"""
    rounds = ",\n".join(f"{assigned.format(i=i)},\n{grown.format(i=i, j=i + 1)}" for i in range(4))
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, v
    FROM (SELECT vec_id, label, {_WHOLE.format(scale=1024)})),
cut AS MATERIALIZED (
    SELECT r, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS x
    FROM kept, (SELECT unnest(generate_series(0, 3)) AS part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM cut WHERE r <= 256),
{rounds},
{assigned.format(i=4)},
book AS (
    SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
    FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM b4)),
coded AS (
    SELECT r, string_agg(format('{{:02x}}', best % 256), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error
    FROM a4 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), book"""


OP13_SQL = _op13_sql()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_fm_index": op2_fm_index,
    "op3_warc_normal": op3_warc_normal,
    "op4_tool_links": op4_tool_links,
    "op5_histogram_sort": op5_histogram_sort,
    "op6_line_runs": op6_line_runs,
    "op7_guess_cost": op7_guess_cost,
    "op8_content_sort": op8_content_sort,
    "op9_pareto_mix": op9_pareto_mix,
    "op10_pu_toxicity": op10_pu_toxicity,
    "op11_gnat_negatives": op11_gnat_negatives,
    "op12_chunk_bpe": op12_chunk_bpe,
    "op13_equal_average": op13_equal_average,
}

SQL: dict[str, str] = {
    "op2_fm_index": OP2_SQL,
    "op3_warc_normal": OP3_SQL,
    "op6_line_runs": OP6_SQL,
    "op8_content_sort": OP8_SQL,
    "op11_gnat_negatives": OP11_SQL,
    "op13_equal_average": OP13_SQL,
}


def _prepared(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_checkpoint_dir(spark)
        return build(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _prepared(build) for name, build in QUERIES.items()}
