"""Tool calls of chats: linked to results, ordered, validated, in canonical JSON.

Calls and results are hash-joined by conversation and call identifier. Calls that depend on
other calls are ordered by peeling: calls whose dependencies are settled get the next level,
round after round, so the rounds are the longest chain. Arguments are parsed as variants:
their types are checked against the tool's schema, and a variant writes its keys sorted and
without blanks, which is the canonical form.

No step gathers a conversation: identifiers are pre-aggregated, and positions come from one
range exchange, so a conversation may hold any share of the rows.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import numbered

# type of a parameter -> the beginnings of its type as a variant
_TYPES = {"string": ["STRING"], "integer": ["BIGINT", "INT", "SMALLINT", "TINYINT"],
          "number": ["BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT"],
          "boolean": ["BOOLEAN"], "object": ["OBJECT"], "array": ["ARRAY"]}

# Longer arguments may be valid JSON that the parser doesn't take (it ends at 20 million characters a string).
LONGEST = 15_000_000

Schemas = dict[str, dict[str, tuple[str, bool]]]


def json_string(text: Column) -> Column:
    """A string as a JSON literal; null as ``null``."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNull(), "null").otherwise(F.substring(listed, F.lit(2), F.length(listed) - 2))


def argument_errors(name: Column, arguments: Column, parsed: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, as an array of messages; empty if nothing is."""
    kind = F.schema_of_variant(parsed)
    known = F.array(*[F.lit(t) for t in schemas]).cast("array<string>")
    checks = [F.when(~F.coalesce(F.array_contains(known, name), F.lit(False)), F.lit("unknown tool")),
              F.when(parsed.isNull() & (F.length(arguments) > LONGEST), "arguments are too long to parse")
              .when(parsed.isNull(), "arguments are not JSON")
              .when(~kind.startswith("OBJECT"), "arguments are not an object")]
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    extra = F.lit(None).cast("array<string>")
    for tool, params in schemas.items():
        here = (name == tool) & is_object
        for param, (type_, required) in params.items():
            # A null value counts as missing.
            got = F.schema_of_variant(F.variant_get(parsed, f"$['{param}']", "variant"))
            absent = got.isNull() | (got == "VOID")
            fits = F.lit(False)
            for start in _TYPES[type_]:
                fits = fits | got.startswith(start)
            if required:
                checks.append(F.when(here & absent, f"{param} is missing"))
            checks.append(F.when(here & ~absent & ~fits, f"{param} is not of type {type_}"))
        extra = F.when(here, F.array_sort(F.array_except(keys, F.array(*[F.lit(x) for x in params])))).otherwise(extra)
    unknown = F.transform(F.coalesce(extra, F.array().cast("array<string>")), lambda k: F.concat(k, F.lit(" is unknown")))
    return F.concat(F.filter(F.array(*checks), lambda e: e.isNotNull()), unknown)


def call_levels(calls: DataFrame) -> DataFrame:
    """``conv, id, level``: 0 without dependencies, else one more than the deepest of them.

    ``calls`` has ``conv, id, needs`` (an array of identifiers in the same conversation).
    Dependencies on calls that don't exist are ignored. Calls in or behind a circle get no row.
    There are as many rounds as the longest chain has calls.
    """
    ids = calls.select("conv", "id")
    edges = (calls.select("conv", "id", F.explode(F.array_distinct("needs")).alias("need")).where("need is not null")
             .join(ids.withColumnRenamed("id", "need"), ["conv", "need"], "left_semi"))
    edges = materialize(edges, "call-edges")
    done = materialize(ids.join(edges.select("conv", "id"), ["conv", "id"], "left_anti")
                       .withColumn("level", F.lit(0)), "call-levels")
    levels = [done]
    for level in count(1):
        # Of the edges left, those whose need has just been settled go; calls without others are next.
        if edges.isEmpty():
            break
        settled = done.select("conv", F.col("id").alias("need"))
        rest = materialize(edges.join(settled, ["conv", "need"], "left_anti"), "call-edges")
        done = materialize(edges.select("conv", "id").distinct()
                           .join(rest.select("conv", "id"), ["conv", "id"], "left_anti")
                           .withColumn("level", F.lit(level)), "call-levels")
        if done.isEmpty():
            break
        levels.append(done)
        edges = rest
    out = levels[0]
    for df in levels[1:]:
        out = out.unionByName(df)
    return out


def described(calls: DataFrame, schemas: Schemas) -> DataFrame:
    """``calls`` (with ``content``) and their ``errors, canonical``."""
    both = calls.withColumn("parsed", F.try_parse_json("arguments"))
    both = both.withColumn("errors", argument_errors(F.col("name"), F.col("arguments"), F.col("parsed"), schemas))
    needs = F.array_sort(F.filter(F.array_distinct(F.coalesce("needs", F.array().cast("array<string>"))), lambda x: x.isNotNull()))
    raw = F.when(F.col("parsed").isNull() & (F.length("arguments") > LONGEST),
                 F.concat(F.lit(',"arguments_text":'), json_string(F.col("arguments")))).otherwise("")
    return both.withColumn("canonical", F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json("parsed"), F.lit("null")), raw,
        F.lit(',"id":'), json_string(F.col("id")), F.lit(',"name":'), json_string(F.col("name")),
        F.lit(',"needs":'), F.to_json(needs), F.lit(',"result":'), json_string(F.col("content")), F.lit("}"))).drop("parsed")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """A row per call and per result that isn't a call's answer:
    ``conv, id, kind, position, level, valid, errors, canonical``.

    ``calls`` has ``conv, id, turn, name, arguments`` (JSON text) and ``needs`` (identifiers),
    ``results`` has ``conv, id, turn, content``; other columns are ignored. Of calls that repeat an
    identifier in a conversation the first by turn, then by content, counts. Its answer is the
    first result, by turn, then by content, that doesn't stand before it (a null turn never does).

    ``kind`` is ``linked``, ``unanswered``, ``circular`` (its dependencies can't be met),
    ``orphan`` (a result without a call, or before it) or ``duplicate`` (a call that repeats an
    identifier, or a further result). ``position`` counts a conversation's calls from 0 by level, turn
    and identifier, circular ones last; duplicates have none, and no level. ``valid`` says that
    ``errors`` is empty; results have neither. ``canonical`` is JSON with sorted keys and no blanks;
    arguments that aren't JSON are given as null, arguments too long for the parser as null beside
    their text as ``arguments_text``, with an error of its own.
    A null conversation or identifier links with nothing: it is unanswered, or an orphan.
    Repeated rows each get a row. Empty tables give an empty result.
    """
    named = "conv is not null and id is not null"
    calls = materialize(calls.select("conv", "id", "turn", "name", "arguments", "needs",
                                     F.monotonically_increasing_id().alias("m")), "calls")
    results = materialize(results.select("conv", "id", "turn", "content", F.monotonically_increasing_id().alias("m")), "results")
    cols = ["conv", "id", "turn", "name", "arguments", "needs"]
    first_call = materialize(calls.where(named).groupBy("conv", "id")
                             .agg(F.min(F.struct("turn", "name", "arguments", "needs", "m")).alias("c"))
                             .select("conv", "id", "c.*"), "first-calls")
    repeated = calls.where(named).join(first_call.select("m"), "m", "left_anti").select(*cols)
    called = first_call.select("conv", "id", F.col("turn").alias("called"), F.lit(True).alias("known"))
    early = F.coalesce(F.col("turn") < F.col("called"), F.lit(False))
    answer = materialize(results.where(named).join(called, ["conv", "id"]).where(~early).groupBy("conv", "id")
                         .agg(F.min(F.struct("turn", "content", "m")).alias("r"))
                         .select("conv", "id", F.col("r.m").alias("m"), F.col("r.content").alias("content")), "answers")
    levels = call_levels(first_call.select("conv", "id", "needs"))
    both = (first_call.select(*cols).unionByName(calls.where(f"not ({named})").select(*cols))
            .join(answer.withColumnRenamed("m", "answered"), ["conv", "id"], "left")
            .join(levels, ["conv", "id"], "left"))
    lone = F.col("conv").isNull() | F.col("id").isNull()
    kind = (F.when(~lone & F.col("level").isNull(), "circular")
            .when(F.col("answered").isNotNull(), "linked").otherwise("unanswered"))
    both = described(both, schemas).withColumn("kind", kind).withColumn("deep", F.coalesce("level", F.lit(2 ** 31 - 1)))
    rows = both.select("conv", "id", "turn", "deep", "kind", F.col("level").cast("long").alias("level"),
                       (F.size("errors") == 0).alias("valid"), "errors", "canonical")
    placed = numbered(rows, "conv", ["deep", "turn", "id"], "position").drop("turn", "deep")
    again = described(repeated.withColumn("content", F.lit(None).cast("string")), schemas).select(
        "conv", "id", F.lit("duplicate").alias("kind"), (F.size("errors") == 0).alias("valid"), "errors", "canonical")
    rest = (results.join(answer.select("m"), "m", "left_anti").join(called, ["conv", "id"], "left")
            .select("conv", "id", F.when(F.coalesce("known", F.lit(False)) & ~early, "duplicate").otherwise("orphan").alias("kind"),
                    F.concat(F.lit('{"id":'), json_string(F.col("id")), F.lit(',"result":'),
                             json_string(F.col("content")), F.lit("}")).alias("canonical")))
    out = ["conv", "id", "kind", "position", "level", "valid", "errors", "canonical"]
    return (placed.select(*out).unionByName(again, allowMissingColumns=True)
            .unionByName(rest, allowMissingColumns=True).select(*out))


# ---- calls and results in plain conversations ----

CHAT_SCHEMAS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", True), "filters": ("object", False)},
    "translate": {"text": ("string", True), "to": ("string", True)},
    "summarise": {"text": ("string", True), "words": ("integer", False)},
}


def chat_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of ``conversations (conv_id, turn, role, text)``, which hold no tool messages.

    An assistant's turn is a call named ``conversation:turn`` whose tool, arguments and faults
    follow from the text's length; it needs the call at half its turn number. Any other turn
    is a result for the turn before it.
    """
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("long")
    size = F.coalesce(F.length("text"), F.lit(0))
    name_of = lambda t: F.concat(conv, F.lit(":"), t.cast("string"))
    search = F.to_json(F.struct(
        F.when(size % 11 != 0, F.col("text")).alias("query"),
        F.struct(F.col("role").alias("role"), (turn + 1).alias("before"), turn.alias("after")).alias("filters"),
        (size % 50).alias("limit")))
    translate = F.concat(F.lit('{ "to" : '), F.when(size % 13 == 0, F.lit("7")).otherwise(F.lit('"en"')),
                         F.lit(' , "text" : '), json_string(F.col("text")),
                         F.when(size % 17 == 0, F.lit("")).otherwise(F.lit(" }")))
    summarise = F.to_json(F.struct((size % 100).alias("words"), F.col("text").alias("text"),
                                   F.when(size % 19 == 0, F.lit(True)).alias("loud")))
    tool = size % 3
    calls = conversations.where("role = 'assistant'").select(
        F.col("conv_id").alias("conv"), name_of(turn).alias("id"), turn.alias("turn"),
        F.when(tool == 0, "search").when(tool == 1, "translate").otherwise("summarise").alias("name"),
        F.when(tool == 0, search).when(tool == 1, translate).otherwise(summarise).alias("arguments"),
        F.when(turn > 1, F.array(name_of(F.floor(turn / 2)))).otherwise(F.array().cast("array<string>")).alias("needs"))
    results = conversations.where("role <> 'assistant' or role is null").select(
        F.col("conv_id").alias("conv"), name_of(turn - 1).alias("id"), turn.alias("turn"), F.col("text").alias("content"))
    return calls, results
