"""Chat formatting: tool calls linked with their results, in DataFrame functions only.

Calls and results meet in a hash join on the call's identifier. A call may name another
call that comes before it (``after``); its depth, the place in a topological order, is
found by pointer doubling, so the number of rounds is the logarithm of the longest chain.
Arguments are checked against the tool's schema, and each call is written as one line of
canonical JSON (keys sorted, no white space, numbers in their shortest form). All of it
is a row per call: a conversation of any length is never gathered in one place, and
sorting by ``depth, id`` gives its calls in order.

Defined results: of several results with one identifier the first by ``at`` counts, then
the smallest text; of calls likewise; a call without an identifier is linked with
nothing and has depth 1; ``after`` that names no call counts as none; calls on or after a cycle
have a null depth; arguments that aren't a JSON object are an error and written as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import salted_join, stored

#: JSON types of the schema by the variant types that they take.
TYPES = {"string": r"^STRING$", "integer": r"^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
         "boolean": r"^BOOLEAN$", "object": r"^OBJECT.*", "array": r"^ARRAY.*", "null": r"^VOID$"}


def first_of(rows: DataFrame, *rest: str) -> DataFrame:
    """One row per non-null ``id``, the first by ``at`` and then by the other columns."""
    named = rows.where(F.col("id").isNotNull())
    kept = named.groupBy("id").agg(F.min(F.struct(F.col("at").isNull().alias("none"), "at", *rest)).alias("x"))
    return kept.select("id", "x.at", *[f"x.{c}" for c in rest])


def depths(calls: DataFrame) -> DataFrame:
    """``id`` and ``depth`` of calls (``id``, ``after``) that are unique by id: 1 without a call before, else one more."""
    ids = calls.select(F.col("id").alias("after"), F.lit(True).alias("is_call"))
    one = F.lit(1).cast("long").alias("depth")
    first = calls.where("after IS NULL").select("id", F.col("after").alias("up"), one)  # not in the join: all share that key
    rest = calls.where("after IS NOT NULL").join(ids, "after", "left").select(
        "id", F.when(F.col("is_call"), F.col("after")).alias("up"), one)
    todo = stored(first.unionByName(rest), "chains")
    left = todo.where("up IS NOT NULL").count()
    while left:
        above = todo.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = todo.where("up IS NOT NULL").join(above, "up").select(
            "id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        todo = stored(todo.where("up IS NULL").unionByName(moved), "chains")
        last, left = left, todo.where("up IS NOT NULL").count()
        if left == last:  # only what a cycle holds never ends
            break
    return todo.select("id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def schema_errors(arguments: Column, params: Column) -> Column:
    """What is wrong with a map of variant types, in the order of names; ``params`` may be null."""
    names, have = F.map_keys(arguments), F.transform_values(arguments, lambda _, v: v)
    right = F.lit(False)
    missing = F.transform(F.filter(params, lambda p: p["required"] & ~F.array_contains(names, p["param"])),
                          lambda p: F.concat(F.lit("missing:"), p["param"]))
    unknown = F.transform(F.array_except(names, F.transform(params, lambda p: p["param"])),
                          lambda n: F.concat(F.lit("unknown:"), n))

    def fits(p):
        out = right
        for kind, pattern in TYPES.items():
            out = out | ((p["type"] == kind) & have[p["param"]].rlike(pattern))
        return out

    typed = F.transform(F.filter(params, lambda p: F.array_contains(names, p["param"]) & ~fits(p)),
                        lambda p: F.concat(F.lit("type:"), p["param"]))
    return F.when(params.isNull(), F.array(F.lit("tool"))).when(
        arguments.isNull(), F.array(F.lit("json"))).otherwise(F.array_sort(F.concat(missing, unknown, typed)))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Link, order, check and serialise.

    ``calls``: id, at, tool, arguments (JSON text), after. ``results``: id, at, content.
    ``schemas``: tool, param, type, required. Returns id, at, tool, depth, linked, errors, line.
    """
    known = first_of(calls, "tool", "arguments", "after")
    nameless = calls.where(F.col("id").isNull()).select("id", "at", "tool", "arguments", F.lit(1).cast("long").alias("depth"))
    rows = known.join(depths(known.select("id", "after")), "id").select("id", "at", "tool", "arguments", "depth").unionByName(nameless)
    rows = rows.join(first_of(results, "content").select("id", "content", F.lit(True).alias("linked")), "id", "left")
    params = schemas.groupBy("tool").agg(F.array_sort(F.collect_list(F.struct("param", "type", "required"))).alias("params"))
    rows = salted_join(rows, params, ["tool"])
    rows = rows.withColumn("value", F.try_parse_json("arguments"))
    rows = rows.withColumn("map", F.expr("try_cast(value AS map<string, variant>)"))
    rows = rows.withColumn("types", F.expr("transform_values(map, (k, v) -> schema_of_variant(v))"))
    head = F.to_json(F.struct("id", F.col("tool").alias("name"), F.col("depth").alias("order"), F.col("content").alias("result")),
                     {"ignoreNullFields": "false"})
    body = F.when(F.col("map").isNotNull(), F.to_json("value")).otherwise("null")
    return rows.select("id", "at", "tool", "depth", F.coalesce("linked", F.lit(False)).alias("linked"),
                       schema_errors(F.col("types"), F.col("params")).alias("errors"),
                       F.concat(F.lit('{"arguments":'), body, F.lit(","), F.substr(head, F.lit(2))).alias("line"))


def turns_as_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations (conv_id, turn, role, text).

    A turn of the user calls ``ask``, one of the system ``instruct``; both are named by
    conversation and turn. A turn of the assistant is the result of the turn before it. A
    call comes after the call that its conversation's turn before made or answered.
    """
    def name(turn):
        return F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))

    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    is_call = F.col("role").isin("user", "system")
    before = messages.where(known).groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.min("role").alias("role_before"))
    calls = messages.where(is_call).join(before, ["conv_id", "turn"], "left").select(
        F.when(known, name(F.col("turn"))).alias("id"), F.col("turn").alias("at"),
        F.when(F.col("role") == "user", "ask").otherwise("instruct").alias("tool"),
        F.to_json(F.struct("turn", "text"), {"ignoreNullFields": "false"}).alias("arguments"),
        F.when(F.col("role_before") == "assistant", name(F.col("turn") - 2)).when(
            F.col("role_before").isNotNull(), name(F.col("turn") - 1)).alias("after"))
    results = messages.where((F.col("role") == "assistant") & known).select(
        name(F.col("turn") - 1).alias("id"), F.col("turn").alias("at"), F.col("text").alias("content"))
    return calls, results


def turn_schemas(spark) -> DataFrame:
    return spark.sql("SELECT tool, param, type, required FROM VALUES ('ask', 'text', 'string', true), ('ask', 'turn', 'integer', true), "
                     "('instruct', 'text', 'string', true), ('instruct', 'turn', 'integer', true) AS t(tool, param, type, required)")


ORACLE_SQL = """
WITH RECURSIVE call AS (
  SELECT c.conv_id || ':' || c.turn AS call_id, c.turn, CASE c.role WHEN 'user' THEN 'ask' ELSE 'instruct' END AS tool,
         '{"text":' || coalesce(CAST(to_json(c.text) AS VARCHAR), 'null') || ',"turn":' || c.turn || '}' AS arguments,
         CASE WHEN b.role = 'assistant' THEN c.conv_id || ':' || (c.turn - 2) WHEN b.role IS NOT NULL THEN c.conv_id || ':' || (c.turn - 1) END AS after,
         c.text IS NULL AS bad
  FROM conversations c LEFT JOIN conversations b ON b.conv_id = c.conv_id AND b.turn = c.turn - 1
  WHERE c.role IN ('user', 'system')),
chain AS (
  SELECT call_id, CAST(1 AS BIGINT) AS depth FROM call WHERE after IS NULL OR after NOT IN (SELECT call_id FROM call)
  UNION ALL SELECT call.call_id, chain.depth + 1 FROM call JOIN chain ON call.after = chain.call_id),
result AS (SELECT conv_id || ':' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant')
SELECT call.call_id, CAST(call.turn AS BIGINT) AS turn, tool, depth, result.call_id IS NOT NULL AS linked, NOT bad AS valid,
       sha256('{"arguments":' || arguments || ',"id":' || CAST(to_json(call.call_id) AS VARCHAR) || ',"name":"' || tool || '","order":' || depth
              || ',"result":' || coalesce(CAST(to_json(result.text) AS VARCHAR), 'null') || '}') AS line_sha256
FROM call JOIN chain ON chain.call_id = call.call_id LEFT JOIN result ON result.call_id = call.call_id
"""
