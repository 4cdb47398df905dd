"""Linking tool calls to their results.

Calls and results of a conversation meet in a hash join on the conversation and the call's
identifier. A call may need the results of others: calls are ordered so that none comes before
one it needs. Where every need points back in time, which one join shows, the turns are such
an order already; only calls that need a later one, and those that need them, are moved,
by passing positions along the needs until nothing changes. Arguments are checked against
the tool's schema, and each call becomes one canonical JSON record: keys sorted, no blanks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termshard.llm.common import materialized
from termshard.operators.bounds import broadcast_if_small

ID = ["conv_id", "call_id"]
TYPES = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}  # others by prefix
PREFIXES = {"number": "DOUBLE|BIGINT|DECIMAL", "array": "ARRAY", "object": "OBJECT|VOID"}


def linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One row per conversation and call identifier.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), needs (identifiers).
    ``results``: conv_id, turn, call_id, content. Of several calls or results with one
    identifier the one of the earliest turn counts, of equals the smallest; ``n_calls`` and
    ``n_results`` tell. A null conversation or identifier names nothing: such rows go.
    """
    first = F.min(F.struct("turn", "name", "arguments", "needs")).alias("c")
    calls = calls.dropna(subset=ID).groupBy(*ID).agg(first, F.count("*").alias("n_calls"))
    answer = F.min(F.struct(F.col("turn").alias("result_turn"), F.col("content").alias("result"))).alias("r")
    results = results.dropna(subset=ID).groupBy(*ID).agg(answer, F.count("*").alias("n_results"))
    joined = calls.join(results.hint("shuffle_hash"), ID, "left")
    n = F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results")
    return joined.select(*ID, "c.*", "n_calls", "r.*", n)


def ordered(calls: DataFrame) -> DataFrame:
    """``calls`` with ``position`` and ``hops``: in their order, a call comes after all it needs.

    A call that needs none later has its turn and 0. Needs that name no call don't count.
    Calls on a cycle, or that need one that is, have a null position.
    """
    calls = materialized(calls)
    needs = calls.select("conv_id", F.col("call_id").alias("child"), F.col("turn").alias("child_turn"),
                         F.explode(F.array_distinct("needs")).alias("call_id"))
    edges = needs.join(calls.select(*ID, "turn"), ID)
    edges = materialized(edges.withColumnRenamed("call_id", "parent"))
    late = edges.filter(F.col("turn") >= F.col("child_turn"))
    start = {"position": F.col("turn"), "hops": F.lit(0).cast("bigint")}
    if late.isEmpty():
        return calls.withColumns(start)
    most = calls.groupBy("conv_id").agg(F.count("*").alias("most"))
    place = F.struct(F.col("turn").alias("position"), F.lit(0).cast("bigint").alias("hops"))
    state = materialized(calls.select(*ID, place.alias("place")))
    moved = late.select("conv_id", F.col("parent").alias("call_id")).distinct().join(state, ID)
    lost = calls.select(*ID).limit(0)
    while not moved.isEmpty():
        pushed = F.struct(F.col("place.position").alias("position"), (F.col("place.hops") + 1).alias("hops"))
        asked = moved.join(edges.select("conv_id", F.col("parent").alias("call_id"), "child"), ID)
        asked = asked.groupBy("conv_id", F.col("child").alias("call_id")).agg(F.max(pushed).alias("new"))
        changed = state.join(asked, ID).filter(F.col("new") > F.col("place")).join(most, "conv_id")
        changed = materialized(changed.select(*ID, F.col("new").alias("place"), (F.col("new.hops") > F.col("most")).alias("_lost")))
        lost = materialized(lost.union(changed.filter("_lost").select(*ID)).distinct())
        moved = changed.filter("NOT _lost").drop("_lost")
        state = state.join(changed.select(*ID, F.col("place").alias("_new")), ID, "left")
        state = materialized(state.select(*ID, F.coalesce("_new", "place").alias("place")))
    reached = lost
    while not reached.isEmpty():  # whoever needs a lost call is lost
        asked = reached.join(edges.select("conv_id", F.col("parent").alias("call_id"), "child"), ID)
        asked = asked.select("conv_id", F.col("child").alias("call_id")).distinct()
        reached = materialized(asked.join(lost, ID, "left_anti"))
        lost = materialized(lost.union(reached))
    placed = state.join(lost.withColumn("_lost", F.lit(True)), ID, "left")
    gone = F.col("_lost").isNotNull()
    placed = placed.select(*ID, F.when(~gone, F.col("place.position")).alias("position"),
                           F.when(~gone, F.col("place.hops")).alias("hops"))
    return calls.join(placed, ID)


def checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``valid`` and ``errors``, an array of strings, sorted.

    ``schemas``: name, field, type (string, integer, number, boolean, array, object), required.
    Arguments must be a JSON object with the required fields, no unknown ones, and values of
    the right types. A tool without a schema is an error; null arguments are no object.
    """
    fields = schemas.groupBy("name").agg(F.collect_list(F.struct("field", "type", "required")).alias("_fields"))
    rows = calls.join(broadcast_if_small(materialized(fields.withColumnRenamed("name", "_tool"))),
                      F.col("name") == F.col("_tool"), "left")
    rows = rows.withColumn("_json", F.expr("try_parse_json(arguments)"))
    is_object = F.col("arguments").rlike(r"^\s*\{") & F.col("_json").isNotNull()
    rows = rows.withColumn("_given", F.when(is_object, F.expr("cast(_json AS map<string, variant>)")))
    kind = "schema_of_variant(_given[f.field])"
    ok = " ".join(
        [f"WHEN '{t}' THEN {kind} = '{v}'" for t, v in TYPES.items()]
        + [f"WHEN '{t}' THEN {kind} RLIKE '^({p})'" for t, p in PREFIXES.items()]
    )
    wrong = f"""transform(_fields, f -> CASE
        WHEN NOT map_contains_key(_given, f.field) THEN if(f.required, concat('missing ', f.field), NULL)
        WHEN NOT coalesce(CASE f.type {ok} END, false) THEN concat('type ', f.field) END)"""
    unknown = """transform(filter(map_keys(_given), k -> NOT exists(_fields, f -> f.field = k)),
        k -> concat('unknown ', k))"""
    errors = F.expr(f"""CASE WHEN _fields IS NULL THEN array('no schema') WHEN _given IS NULL
        THEN array('no object') ELSE array_sort(filter(concat({wrong}, {unknown}), e -> e IS NOT NULL)) END""")
    rows = rows.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)
    return rows.drop("_tool", "_fields", "_given")


def tool_records(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Linked, ordered and checked calls, with ``record``: canonical JSON of arguments, id, name
    and result. Arguments that are no JSON stay text in it; missing values are null.
    Repeated rows count once and show in the counts; empty tables give no rows."""
    rows = checked(ordered(linked(calls, results)), schemas)
    given = "coalesce(_json, cast(arguments AS variant))"
    record = F.expr(f"""to_json(named_struct('arguments', {given}, 'id', call_id, 'name', name,
        'result', result), map('ignoreNullFields', 'false'))""")
    return rows.withColumn("record", record).drop("_json")


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of people and systems as calls, those of assistants as results: a result answers
    the turn before it, and a call needs the results of the two turns before, where they are calls."""
    turn = F.col("turn")
    asks = conversations.filter("role <> 'assistant'")
    calls = asks.select(
        "conv_id", "turn", F.concat(F.lit("c"), turn.cast("string")).alias("call_id"),
        F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        F.array(*(F.concat(F.lit("c"), (turn - i).cast("string")) for i in (1, 2))).alias("needs"),
    )
    results = conversations.filter("role = 'assistant'").select(
        "conv_id", "turn", F.concat(F.lit("c"), (turn - 1).cast("string")).alias("call_id"),
        F.col("text").alias("content"),
    )
    return calls, results
