"""Skill vocabulary, whole-word matching into a bridge, and its checks.

The reference tests every (job, pattern) pair with a regex held in a column,
which Spark can only run as a nested-loop join. For a short constant list each skill
here becomes one regex inside a single projection (``match_skills``): one narrow pass
over the texts, no join, no shuffle, each regex guarded by a case-folded ``contains``.
A vocabulary table of any size meets the texts in an equi-join on words instead
(``match_vocabulary``).
"""

from __future__ import annotations

import re
from collections import OrderedDict

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.patterns import word_regex
from ..functions.text import contains_text
from ..functions.vocab import SKILL_PATTERNS, CHECK_BRIDGE_SUMMARY, CHECK_SKILL_COVERAGE, CHECK_SKILL_LIMITATION, LIMITATION_NOTE
from .joins import with_totals
from .keys import surrogate_key

def skill_rules(patterns=SKILL_PATTERNS) -> "OrderedDict[str, tuple[str, list[str]]]":
    """skill name -> (category = min over its rows, literals), ordered by name."""
    rules: dict[str, tuple[str, list[str]]] = {}
    for name, cat, lit in patterns:
        prev = rules.get(name)
        rules[name] = (min(cat, prev[0]) if prev else cat, (prev[1] if prev else []) + [lit])
    return OrderedDict(sorted(rules.items()))


def dim_skill(spark: SparkSession, patterns=SKILL_PATTERNS) -> DataFrame:
    """One row per skill name, ``min(category)``, the whole-word regex, dense id by name."""
    rows = [(n, c, word_regex(lits), first_words(lits)) for n, (c, lits) in skill_rules(patterns).items()]
    df = spark.createDataFrame(rows, "skill_name string, skill_category string, match_pattern string, "
                                     "first_words array<string>")
    return surrogate_key(df, ["skill_name"], "skill_id").select(
        "skill_id", "skill_name", "skill_category", "match_pattern", "first_words")


def first_words(literals: list[str]) -> list[str]:
    """The first alphanumeric word of each literal, lower-cased: what a matching text must hold."""
    found = [re.search(_TOKEN, lit) for lit in literals]
    if not all(found):
        raise ValueError(f"a literal needs a letter or digit: {literals}")
    return sorted({m[0].lower() for m in found})


def skill_hits(text: Column, patterns=SKILL_PATTERNS) -> Column:
    """array<string> of the skills whose literal occurs in ``text`` as a whole word."""
    low = F.lower(text)
    arms = []
    for name, (_cat, lits) in skill_rules(patterns).items():
        guard = None
        for lit in lits:
            g = contains_text(low, lit.lower())
            guard = g if guard is None else (guard | g)
        arms.append(F.when(guard & text.rlike(word_regex(lits)), F.lit(name)))
    return F.array_compact(F.array(*arms))


def match_skills(df: DataFrame, id_col: str, text_col: str, patterns=SKILL_PATTERNS) -> DataFrame:
    """W27 core: ``(id_col, skill_name)`` for every whole-word skill hit in ``text_col``.

    Each skill appears at most once per input row, so with a unique ``id_col``
    the pairs are already distinct and no shuffle is needed for DISTINCT.
    """
    return (df.where(F.col(text_col).isNotNull())
              .select(F.col(id_col), F.explode(skill_hits(F.col(text_col), patterns)).alias("skill_name")))


# The characters around an alphanumeric word, as in ``functions.patterns``.
_TOKEN = "[A-Za-z0-9]+"


def match_vocabulary(df: DataFrame, id_col: str, text_col: str, skills: DataFrame) -> DataFrame:
    """``(id_col, skill_id)`` for every whole-word hit of a vocabulary table of any size.

    A literal can only match where its first alphanumeric word stands as a word, so texts
    meet patterns in an equi-join on lower-case words; each pattern is then tried only on
    texts that hold the first word of one of its literals. Words and candidates travel
    without the texts. ``id_col`` is unique; ``skills`` has ``skill_id``, ``match_pattern``
    (whole-word, see ``word_regex``) and ``first_words``.
    """
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(id_col), F.col(text_col).alias("_text"))
    words = texts.select(id_col, F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("_text"), F.lit(f"({_TOKEN})")))).alias("_word"))
    patterns = skills.select("skill_id", "match_pattern", F.explode("first_words").alias("_word"))
    tried = words.join(patterns, "_word").select(id_col, "skill_id", "match_pattern").distinct()
    return (texts.join(tried, id_col).where(F.expr("_text rlike match_pattern"))
            .select(id_col, "skill_id"))


def bridge_job_skills(fact: DataFrame, stg: DataFrame, skills: DataFrame, patterns=SKILL_PATTERNS) -> DataFrame:
    """``bridge_job_skills(job_posting_id, skill_id)`` from fact x staging x vocabulary.

    Matching runs on staging as it is partitioned (the regex work is the costly part and
    stays fully parallel); only the hits are joined to the fact keys. Raises when ``skills``
    wasn't built from ``patterns``; for a vocabulary known only as a table there is
    ``bridge_from_vocabulary``.
    """
    want = {(n, word_regex(lits)) for n, (_, lits) in skill_rules(patterns).items()}
    have = skills.select("skill_name", "match_pattern").limit(len(want) + 1).collect()
    if {tuple(r) for r in have} != want:
        raise ValueError("the skill table and the patterns disagree")
    hits = match_skills(stg.select("job_id", "description_clean"), "job_id", "description_clean", patterns)
    return (hits.join(fact.select("job_id", "job_posting_id"), "job_id")
                .join(skills.select("skill_id", "skill_name"), "skill_name")
                .select("job_posting_id", "skill_id"))


def bridge_from_vocabulary(fact: DataFrame, stg: DataFrame, skills: DataFrame) -> DataFrame:
    """W27 with the patterns of ``skills``, however many and whatever they were built from."""
    hits = match_vocabulary(stg.select("job_id", "description_clean"), "job_id", "description_clean", skills)
    return hits.join(fact.select("job_id", "job_posting_id"), "job_id").select("job_posting_id", "skill_id")


def skill_category_counts(skills: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """Skills per category, most first; with a bridge also how many of them were matched."""
    order = (F.col("cnt").desc(), F.col("skill_category"))
    per_cat = skills.groupBy("skill_category").agg(F.count(F.lit(1)).alias("cnt"))
    if bridge is None:
        return per_cat.orderBy(*order)
    matched = (bridge.select("skill_id").distinct()
               .join(skills.select("skill_id", "skill_category"), "skill_id")
               .groupBy("skill_category").agg(F.count(F.lit(1)).alias("skills_matched")))
    return (per_cat.join(matched, "skill_category", "left")
            .select("skill_category", "cnt", F.coalesce("skills_matched", F.lit(0)).alias("skills_matched"))
            .orderBy(*order))


def bridge_summary(bridge: DataFrame) -> DataFrame:
    """Links, jobs with a skill, distinct skills, links per job.

    Two small aggregates instead of two COUNT(DISTINCT) in one (which would
    duplicate every bridge row through an Expand).
    """
    per_job = bridge.groupBy("job_posting_id").agg(F.count(F.lit(1)).alias("n"))
    jobs = per_job.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_links"),
                       F.count(F.lit(1)).alias("jobs_with_skills"))
    skills = (bridge.groupBy("skill_id").agg(F.count(F.lit(1)).alias("n"))
              .agg(F.count(F.lit(1)).alias("skills_matched")))
    return jobs.transform(with_totals, skills).select(
        F.lit(CHECK_BRIDGE_SUMMARY).alias("check_name"), "total_links", "jobs_with_skills", "skills_matched",
        F.round(F.try_divide(F.col("total_links").cast("decimal(20,0)"), F.col("jobs_with_skills")), 2)
         .cast("double").alias("avg_skills_per_job"))


def _jobs_with_skill(bridge: DataFrame) -> DataFrame:
    return bridge.select("job_posting_id").distinct().agg(F.count(F.lit(1)).alias("jobs_with_skill"))


def skill_coverage(fact: DataFrame, bridge: DataFrame) -> DataFrame:
    """Share of facts with at least one skill."""
    total = fact.agg(F.count(F.lit(1)).alias("total_jobs"))
    return total.transform(with_totals, _jobs_with_skill(bridge)).select(
        F.lit(CHECK_SKILL_COVERAGE).alias("check_name"), "total_jobs", "jobs_with_skill",
        F.round(F.try_divide(100.0 * F.col("jobs_with_skill"), F.col("total_jobs")), 1)
         .cast("double").alias("pct_coverage"))


def top_skills(bridge: DataFrame, skills: DataFrame, fact: DataFrame) -> DataFrame:
    """Demand per skill and percent of all jobs, most demanded first.

    The bridge is reduced to one row per skill before it meets the (tiny) skill
    dimension, so the join and sort work on at most vocabulary-many rows.
    """
    demand = bridge.groupBy("skill_id").agg(F.count(F.lit(1)).alias("demand_count"))
    total = fact.agg(F.count(F.lit(1)).alias("_total"))
    return (demand.join(skills.select("skill_id", "skill_name", "skill_category"), "skill_id")
            .transform(with_totals, total)
            .select("skill_name", "skill_category", "demand_count",
                    F.round(F.try_divide(100.0 * F.col("demand_count"), F.col("_total")), 1)
                     .cast("double").alias("pct_of_jobs"))
            .orderBy(F.col("demand_count").desc(), F.col("skill_name")))


def skill_limitation(stg: DataFrame, bridge: DataFrame) -> DataFrame:
    """Description length and truncation beside skill coverage."""
    clean = F.col("description_clean")
    base = stg.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.round(F.avg("description_length"), 0).cast("double").alias("avg_desc_length"),
        F.count_if(contains_text(clean, "…") | contains_text(clean, "...")).alias("truncated_descriptions"))
    return base.transform(with_totals, _jobs_with_skill(bridge)).select(
        F.lit(CHECK_SKILL_LIMITATION).alias("check_name"), "total_jobs", "avg_desc_length",
        "truncated_descriptions", "jobs_with_skill",
        F.round(F.try_divide(100.0 * F.col("jobs_with_skill"), F.col("total_jobs")), 1)
         .cast("double").alias("pct_coverage"),
        F.lit(LIMITATION_NOTE).alias("interpretation"))
