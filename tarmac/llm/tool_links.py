"""Tool calls linked with their results, ordered, checked and written as canonical JSON. DataFrame functions only.

A call names at most one call it follows, so the calls form a forest; its depth gives a topological order (by depth, then
turn). Depths come from pointer doubling: each round joins every call with its ancestor's ancestor,
so a chain of n calls takes log2(n) rounds. A call in a cycle, or behind one, has no depth. A call whose predecessor is
missing is a root and says so.

Calls and results meet in a hash join by identifier. Of several calls or results with one identifier the first by
turn (then by content) counts; the copies are counted. A call without result has a null result, a result without a call is a row
with an error; a null identifier links with nothing and is left out, as is a call of a null conversation. Arguments that are not a JSON object, lack a required field,
hold a field the schema does not list, or hold one of another type are reported in ``errors``. An unknown
tool name is an error as well. JSON objects are written with sorted keys and without spaces.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.store import keep, setup

ID = ["conv_id", "call_id"]
SCHEMA = "name string, field string, type string, required boolean"
# Fields of the tools that the derived calls use.
TOOLS = [
    ("lookup", "limit", "BIGINT", True),
    ("lookup", "query", "STRING", True),
    ("search", "limit", "BIGINT", False),
    ("search", "query", "STRING", True),
    ("translate", "query", "STRING", True),
    ("translate", "target", "STRING", True),
]


def depths(calls: DataFrame) -> DataFrame:
    """Rows (conv_id, call_id, depth, missing); ``calls`` has unique identifiers and the column ``after``."""
    known = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known"))
    state = calls.select(*ID, "after").join(known, ["conv_id", "after"], "left")
    found = F.col("known").isNotNull()
    state = state.select(
        *ID,
        F.when(found, F.col("after")).alias("up"),
        F.when(found, 1).otherwise(0).cast("long").alias("depth"),
        (F.col("after").isNotNull() & ~found).alias("missing"),
    )
    state = keep(state)
    rounds = math.ceil(math.log2(max(2, state.count()))) + 1
    for _ in range(rounds):
        if state.where("up is not null").isEmpty():
            break
        above = state.select(
            "conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more")
        )
        state = keep(
            state.join(above, ["conv_id", "up"], "left").select(
                *ID,
                F.col("next").alias("up"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                "missing",
            )
        )
    return state.select(*ID, F.when(F.col("up").isNull(), F.col("depth")).alias("depth"), "missing")


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds ``value`` (the parsed arguments or null) and ``errors`` (sorted texts); ``schemas`` as in ``SCHEMA``."""
    field = F.struct("field", "type", "required")
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(field)).alias("fields"))
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    calls = calls.withColumn("value", F.when(is_object, parsed))
    calls = calls.join(tools, "name", "left")
    # The top-level fields and their types.
    given = F.from_json(F.to_json("value"), "map<string,variant>")
    names = F.map_keys("given")
    calls = calls.withColumn("given", given)
    kinds = F.transform(
        "fields",
        lambda f: F.struct(
            f["field"].alias("field"),
            f["type"].alias("type"),
            f["required"].alias("required"),
            F.array_contains(names, f["field"]).alias("there"),
            F.schema_of_variant(F.element_at("given", f["field"])).alias("kind"),
        ),
    )
    calls = calls.withColumn("kinds", kinds)
    missing = F.transform(
        F.filter("kinds", lambda f: f["required"] & ~f["there"]), lambda f: F.concat(F.lit("missing "), f["field"])
    )
    wrong = F.transform(
        F.filter("kinds", lambda f: f["there"] & (f["kind"] != f["type"])),
        lambda f: F.concat(F.lit("type of "), f["field"]),
    )
    listed = F.transform("fields", lambda f: f["field"])
    unknown = F.transform(F.array_except(names, listed), lambda n: F.concat(F.lit("unknown "), n))
    errors = (
        F.when(F.col("fields").isNull(), F.array(F.lit("no such tool")))
        .when(F.col("value").isNull(), F.array(F.lit("not an object")))
        .otherwise(F.sort_array(F.concat(missing, wrong, unknown)))
    )
    return calls.withColumn("errors", errors).drop("fields", "given", "kinds")


def link_tools(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Calls (conv_id, call_id, after, turn, name, arguments), results (conv_id, call_id, turn, content)."""
    setup(calls.sparkSession)
    there = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = F.min(F.struct("turn", "name", "arguments", "after")).alias("c")
    calls = calls.where(there).groupBy(*ID).agg(first, F.count(F.lit(1)).alias("copies"))
    calls = keep(calls.select(*ID, "c.*", "copies"))
    answer = F.min(F.struct("turn", "content")).alias("r")
    results = results.where(there).groupBy(*ID).agg(answer, F.count(F.lit(1)).alias("answers"))
    results = results.select(
        *ID, F.col("r.turn").alias("answer_turn"), F.col("r.content").alias("content"), "answers"
    )
    linked = argument_errors(calls, schemas).join(depths(calls), ID)
    # Results without a call are rows as well.
    linked = linked.join(results, ID, "full").withColumn(
        "errors", F.coalesce("errors", F.array(F.lit("result without a call")))
    )
    canonical = F.to_json(
        F.struct(
            F.col("after"),
            F.coalesce(F.col("value"), F.to_variant_object(F.struct())).alias("arguments"),
            F.col("call_id"),
            F.col("depth"),
            F.array_join("errors", "; ").alias("errors"),
            F.col("name"),
            F.col("content").alias("result"),
        )
    )
    return linked.select(
        *ID,
        F.coalesce("turn", "answer_turn").alias("turn"),
        "depth",
        "missing",
        "name",
        (F.size("errors") == 0).alias("valid"),
        F.array_join("errors", "; ").alias("errors"),
        F.coalesce("answers", F.lit(0).cast("long")).alias("answers"),
        F.coalesce("copies", F.lit(0).cast("long")).alias("copies"),
        canonical.alias("json"),
    )


def tools(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TOOLS, SCHEMA)


def _member(name: str, text: Column) -> Column:
    """A member of a JSON object with its text escaped."""
    whole = F.to_json(F.struct(text.alias(name)))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each user turn as a tool call, each assistant turn as the result of the call one turn earlier.

    The arguments hold the text and its length; by turn and length some lack a field, hold a number as a text or are cut off.
    """
    turns = conversations.withColumn("n", F.length(F.coalesce("text", F.lit(""))))
    name = F.when(F.col("n") % 5 == 0, "translate").when(F.col("n") % 2 == 0, "lookup").otherwise("search")
    limit = F.when(F.col("n") % 7 == 0, F.concat(F.lit('"'), F.col("n"), F.lit('"'))).otherwise(F.col("n").cast("string"))
    query = F.when(
        F.col("n") % 11 == 0, F.lit("")
    ).otherwise(F.concat(_member("query", F.coalesce("text", F.lit(""))), F.lit(", ")))
    end = F.when(F.col("n") % 13 == 0, "").otherwise("}")
    call_id = F.concat(F.lit("call_"), F.col("turn"))
    calls = turns.where("role = 'user'").select(
        "conv_id",
        call_id.alias("call_id"),
        F.when(F.col("turn") >= 2, F.concat(F.lit("call_"), F.col("turn") - 2)).alias("after"),
        "turn",
        name.alias("name"),
        F.concat(F.lit("{"), query, F.lit('"limit": '), limit, end).alias("arguments"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id",
        F.concat(F.lit("call_"), F.col("turn") - 1).alias("call_id"),
        "turn",
        F.coalesce("text", F.lit("")).alias("content"),
    )
    return calls, results
