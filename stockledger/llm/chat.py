"""Tool calls and their results, linked by identifier, checked and put into canonical JSON.

Calls and results are hash-joined on conversation and identifier. A call without result is
`unanswered`, a result without call an `orphan`; of calls, or results, that share an identifier the
first in (turn, place) counts and the number of the others is given. The order is topological: a
call comes after the calls it names in `after`, one level deeper than the deepest of them, and a
result after its call; calls that wait for each other are `cyclic` and have no level. Arguments are
checked against a table of parameters: JSON that is no object, unknown names, wrong types and
missing required ones are errors. Canonical JSON has sorted keys and no white space.

Plain dialogue is calls of `reply`. A message of another role than user or assistant (a system prompt,
a tool's turn, a turn without role) is the context of the user's turn right after it, with role and
text in that call's JSON. Without such a turn, or beside another one that is the context already, it
is a row of its own with the status `context`. The text holds tagged bodies as well.

Nothing is gathered per conversation, so one that holds a third of all turns is rows like any other.
NULL conversations or identifiers link with nothing and stay single rows; NULL text holds no calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.functions.distributed import materialize
from stockledger.llm.common import row_hash

CALLS = r"(?s)<tool_call>(.*?)</tool_call>"
RESULTS = r"(?s)<tool_response>(.*?)</tool_response>"
# fixed values: JSON schema's types and how Spark names a value's type
TYPES = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT", "null": "VOID"}


def tagged(messages: DataFrame, pattern: str, conv_col="conv_id", turn_col="turn", text_col="text") -> DataFrame:
    """(`conv`, `turn`, `place`, `body`) of every tagged JSON body in the messages' text."""
    bodies = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(1))
    return messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.posexplode(bodies).alias("place", "body"))


def calls_in(messages: DataFrame, **columns) -> DataFrame:
    """Calls in messages: `conv`, `id`, `turn`, `place`, `name`, `arguments`, `after`."""
    body = F.col("body")
    return tagged(messages, CALLS, **columns).select(
        "conv", F.get_json_object(body, "$.id").alias("id"), "turn", "place", F.get_json_object(body, "$.name").alias("name"),
        F.coalesce(F.get_json_object(body, "$.arguments"), F.lit("{}")).alias("arguments"),
        F.coalesce(F.try_variant_get(F.try_parse_json(body), "$.after", "array<string>"), F.array().cast("array<string>")).alias("after"),
    )


def results_in(messages: DataFrame, **columns) -> DataFrame:
    """Results in messages: `conv`, `id`, `turn`, `place`, `content`."""
    body = F.col("body")
    return tagged(messages, RESULTS, **columns).select(
        "conv", F.get_json_object(body, "$.id").alias("id"), "turn", "place", F.get_json_object(body, "$.content").alias("content")
    )


def _first(rows: DataFrame, values: list[str], repeated: str) -> DataFrame:
    """The first row of each (conv, id); rows without either stay single."""
    whole = F.struct("turn", "place", *values)
    lone = F.when(F.col("conv").isNull() | F.col("id").isNull(), row_hash("conv", "id", "turn", "place", *values))
    return rows.withColumn("lone", lone).groupBy("conv", "id", "lone").agg(F.min(whole).alias("_w"), (F.count(F.lit(1)) - 1).alias(repeated)).select(
        "conv", "id", "lone", "_w.*", repeated
    )


def argument_errors(calls: DataFrame, parameters: DataFrame) -> DataFrame:
    """`call`, `errors` (sorted texts) of the calls with errors; `parameters`: `name`, `parameter`, `type`, `required`."""
    spark = calls.sparkSession
    parsed = calls.select("call", "name", F.try_parse_json("arguments").alias("v"))
    kind = F.schema_of_variant("v")
    broken = parsed.where(F.col("v").isNull() | ~F.coalesce(kind.startswith("OBJECT"), F.lit(False)))
    objects = parsed.where(F.col("v").isNotNull() & F.coalesce(kind.startswith("OBJECT"), F.lit(False)))
    given = objects.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
        "call", "name", F.col("key").alias("parameter"), F.schema_of_variant("value").alias("got")
    )
    known = parameters.select("name", "parameter", "type", "required")
    tools = known.select("name").distinct().withColumn("is_tool", F.lit(True))
    checked = given.join(known, ["name", "parameter"], "left")
    wanted = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])[F.col("type")]
    number = (F.col("type") == "number") & F.col("got").rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)")
    fits = F.col("got").startswith(wanted) | number
    missing = objects.join(known.where("required"), "name").join(given.select("call", "parameter"), ["call", "parameter"], "left_anti")
    errors = (
        broken.select("call", F.lit("arguments are no object").alias("error"))
        .unionByName(parsed.join(tools, "name", "left_anti").select("call", F.concat(F.lit("unknown tool "), F.coalesce("name", F.lit("NULL"))).alias("error")))
        .unionByName(checked.where("type is null").join(tools, "name").select("call", F.concat(F.lit("unknown "), "parameter").alias("error")))
        .unionByName(checked.where(F.col("type").isNotNull() & ~F.coalesce(fits, F.lit(False))).select("call", F.concat("parameter", F.lit(" is no "), "type").alias("error")))
        .unionByName(missing.select("call", F.concat(F.lit("missing "), "parameter").alias("error")))
    )
    return errors.groupBy("call").agg(F.array_sort(F.collect_list("error")).alias("errors"))


def call_levels(calls: DataFrame) -> DataFrame:
    """`call`, `level` of the calls that wait for others, NULL in or behind a cycle; the rest are level 0.

    A round settles one level; there are as many as the longest chain, none without `after`.
    """
    waits = calls.where("conv is not null").select("call", "conv", F.explode("after").alias("id")).distinct()
    edges = materialize(waits.join(calls.select("conv", "id", F.col("call").alias("needed")), ["conv", "id"]).select("call", "needed"))
    waiting = edges.select("call").distinct()
    settled = materialize(edges.select(F.col("needed").alias("call")).distinct().join(waiting, "call", "left_anti").withColumn("level", F.lit(0)))
    many = -1
    while (now := settled.count()) > many:
        many = now
        ready = (
            edges.join(settled.select(F.col("call").alias("needed"), "level"), "needed", "left")
            .groupBy("call")
            .agg(F.max("level").alias("level"), F.count(F.when(F.col("level").isNull(), 1)).alias("open"))
            .where("open = 0")
            .select("call", (F.col("level") + 1).alias("level"))
        )
        settled = materialize(settled.where("level = 0").unionByName(ready))
    return waiting.join(settled, "call", "left")


def link_calls(calls: DataFrame, results: DataFrame, parameters: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """One row per identifier: `conv`, `id`, `turn`, `level`, `status`, `errors`, repeats and `json`; `contexts`: `conv`, `id`, `context`."""
    asked = _first(calls, ["name", "arguments", "after"], "repeated_calls").withColumn("call", row_hash("conv", "id", "lone"))
    asked = materialize(asked)
    answered = _first(results, ["content"], "repeated_results")
    answered = answered.select("conv", "id", F.col("lone").alias("result_lone"), F.col("turn").alias("result_turn"), "content", "repeated_results")
    both = asked.join(answered, ["conv", "id"], "full").join(call_levels(asked).withColumn("waits", F.lit(True)), "call", "left")
    both = both.join(argument_errors(asked, parameters), "call", "left")
    both = both.withColumn("context", F.lit(None).cast("string")) if contexts is None else both.join(contexts, ["conv", "id"], "left")
    is_call, is_result = F.col("call").isNotNull(), F.col("repeated_results").isNotNull()
    cyclic = F.coalesce("waits", F.lit(False)) & F.col("level").isNull()
    status = F.when(~is_call, "orphan").when(cyclic, "cyclic").when(~is_result, "unanswered").otherwise("linked")
    level = F.when(is_call & ~cyclic, F.coalesce("level", F.lit(0)))
    zero = F.lit(0).cast("long")
    return both.select(
        "conv", "id", F.coalesce("turn", "result_turn").alias("turn"), "result_turn", "name", level.alias("level"), status.alias("status"),
        F.coalesce("errors", F.array().cast("array<string>")).alias("errors"),
        F.coalesce("repeated_calls", zero).alias("repeated_calls"), F.coalesce("repeated_results", zero).alias("repeated_results"),
        F.to_json(F.struct(_canonical(F.col("arguments")).alias("arguments"), F.col("context").alias("context"), F.col("id").alias("id"), F.col("name").alias("name"), F.col("content").alias("result"))).alias("json"),
    )


def _canonical(text: Column) -> Column:
    """JSON as a value whose keys are sorted; what does not parse stays a text."""
    return F.coalesce(F.try_parse_json(text), F.to_variant_object(F.struct(text.alias("invalid"))))


REPLY_PARAMETERS = [("reply", "prompt", "string", True), ("reply", "turn", "integer", True)]


def reply_parameters(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(n).alias("name"), F.lit(p).alias("parameter"), F.lit(t).alias("type"), F.lit(r).alias("required")) for n, p, t, r in REPLY_PARAMETERS]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def exchanges(messages: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> tuple[DataFrame, DataFrame]:
    """Plain dialogue as calls and results: a user's turn calls `reply`, the next turn, if an assistant's, answers it."""
    conv, turn, text = F.col(conv_col).alias("conv"), F.col(turn_col).cast("long"), F.col(text_col)
    named = lambda t: F.concat_ws(":", F.lit("reply"), t)
    asked = messages.where(F.col(role_col) == "user").select(
        conv, F.when(turn.isNotNull(), named(turn)).alias("id"), turn.alias("turn"), F.lit(0).alias("place"), F.lit("reply").alias("name"),
        F.to_json(F.struct(text.alias("prompt"), turn.alias("turn"))).alias("arguments"), F.array().cast("array<string>").alias("after"),
    )
    answered = messages.where(F.col(role_col) == "assistant").select(
        conv, F.when(turn.isNotNull(), named(turn - 1)).alias("id"), turn.alias("turn"), F.lit(0).alias("place"), text.alias("content")
    )
    return asked, answered


def contexts(messages: DataFrame, asked: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> tuple[DataFrame, DataFrame]:
    """Messages of other roles than user or assistant: (`conv`, `id`, `context`) of the calls of `reply` right after one,
    and (`conv`, `turn`, `context`) of all others. `asked`: the calls of `reply`."""
    role, turn = F.col(role_col), F.col(turn_col).cast("long")
    said = F.struct(role.alias("role"), F.col(text_col).alias("text"))
    other = messages.where(~F.coalesce(role.isin("user", "assistant"), F.lit(False)))
    # equal messages are one row with their number, so that exactly one of them can go
    alike = materialize(other.select(F.col(conv_col).alias("conv"), turn.alias("turn"), said.alias("context")).groupBy("conv", "turn", "context").agg(F.count(F.lit(1)).alias("many")))
    first = alike.where("turn is not null").groupBy("conv", "turn").agg(F.min("context").alias("context"))
    calls = asked.select("conv", "id", (F.col("turn") - 1).alias("turn")).where("id is not null").distinct()
    joined = materialize(first.join(calls, ["conv", "turn"]))
    gone = joined.select(F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), F.col("context").alias("_context"))
    same_turn = (F.col("conv") == F.col("_conv")) & (F.col("turn") == F.col("_turn"))
    taken = F.coalesce(F.col("context").eqNullSafe(F.col("_context")) & F.col("_conv").isNotNull(), F.lit(False))
    rest = alike.join(gone, same_turn, "left").withColumn("left", F.col("many") - taken.cast("int")).where("left > 0")
    return joined.select("conv", "id", "context"), rest.select("conv", "turn", "context", F.explode(F.sequence(F.lit(1).cast("long"), "left"))).drop("col")


def context_rows(rest: DataFrame, like: DataFrame) -> DataFrame:
    """Context that no call holds, with the columns of `like`."""
    ident = F.when(F.col("turn").isNotNull(), F.concat_ws(":", F.lit("context"), "turn"))
    zero = F.lit(0).cast("long")
    given = {
        "conv": F.col("conv"), "id": ident, "turn": F.col("turn"), "status": F.lit("context"), "errors": F.array().cast("array<string>"),
        "repeated_calls": zero, "repeated_results": zero, "json": F.to_json(F.struct("context", ident.alias("id"))),
    }
    return rest.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def format_conversations(messages: DataFrame, parameters: DataFrame | None = None, **columns) -> DataFrame:
    """Linked calls of all messages: tagged tool calls by their identifiers, plain dialogue as calls of `reply`, other messages as their context."""
    spoken = {k: v for k, v in columns.items() if k != "role_col"}
    asked, answered = exchanges(messages, **columns)
    known = reply_parameters(messages.sparkSession)
    known = known if parameters is None else known.unionByName(parameters.select("name", "parameter", "type", "required"))
    held, rest = contexts(messages, asked, **columns)
    linked = link_calls(asked.unionByName(calls_in(messages, **spoken)), answered.unionByName(results_in(messages, **spoken)), known, held)
    return linked.unionByName(context_rows(rest, linked))
