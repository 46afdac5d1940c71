"""Tool-call linking: calls and results joined, ordered, checked and serialised.

Everything is DataFrame functions. Calls name a tool, carry arguments as JSON
and may come ``after`` another call; results name their call. No step gathers a
conversation: keys are single calls, so a long conversation is spread like any
other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import plain, settled

CALLS = "conv_id bigint, call_id string, turn bigint, name string, arguments string, after string"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"
#: One row for each parameter; ``choices`` (null: any) lists the strings allowed.
TOOLS = "tool string, param string, type string, required boolean, choices array<string>"


def _same(a: DataFrame, b: DataFrame, *names: tuple[str, str]) -> Column:
    on = F.lit(True)
    for x, y in names:
        on = on & a[x].eqNullSafe(b[y])
    return on


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, order): how many calls must come before each.

    ``calls`` has one row for each (conv_id, call_id). Every call points to the
    one it comes after; each round adds the levels along the pointer and lets
    it skip as far again, so a chain of n calls takes about log2(n) rounds. A
    call whose pointer is still set after the rounds that the longest possible
    chain takes is on a cycle or behind one: ``order`` is 'cycle' and the level
    null. A pointer to a call that is not there is 'dangling'; the call counts
    as a first one. The others are 'ordered'.
    """
    named = calls.select(F.col("conv_id").alias("t_conv"), F.col("call_id").alias("t_call"))
    wish = calls.select("conv_id", "call_id", "after")
    aimed = wish.join(named, _same(wish, named, ("conv_id", "t_conv")) & (wish["after"] == named["t_call"]), "left").select(
        "conv_id",
        "call_id",
        F.col("t_call").alias("to"),
        F.col("t_call").isNotNull().cast("bigint").alias("level"),
        (F.col("after").isNotNull() & F.col("t_call").isNull()).alias("dangling"),
    )
    now = settled(aimed, "pointers")
    rounds = now.count().bit_length() + 1
    for _ in range(rounds):
        if now.filter("to is not null").isEmpty():
            break
        ahead = now.select(F.col("conv_id").alias("a_conv"), F.col("call_id").alias("a_call"), F.col("to").alias("a_to"), F.col("level").alias("a_level"))
        met = now.join(ahead, _same(now, ahead, ("conv_id", "a_conv")) & (now["to"] == ahead["a_call"]), "left")
        now = settled(
            met.select("conv_id", "call_id", F.col("a_to").alias("to"), (F.col("level") + F.coalesce("a_level", F.lit(0))).alias("level"), "dangling"),
            "pointers",
        )
    cycle = F.col("to").isNotNull()
    order = F.when(cycle, "cycle").when(F.col("dangling"), "dangling").otherwise("ordered")
    return now.select("conv_id", "call_id", F.when(~cycle, F.col("level")).alias("level"), order.alias("order"))


def _fits(kind: Column, wanted: Column) -> Column:
    """Does a variant's type, as text, fit a JSON schema type?"""
    return (
        F.when(wanted == "string", kind == "STRING")
        .when(wanted == "integer", kind == "BIGINT")
        .when(wanted == "number", kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"))
        .when(wanted == "boolean", kind == "BOOLEAN")
        .when(wanted == "null", kind == "VOID")
        .when(wanted == "object", kind.startswith("OBJECT"))
        .when(wanted == "array", kind.startswith("ARRAY"))
        .otherwise(F.lit(False))
    )


def validated(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """``calls`` with ``parsed`` (variant) and ``errors``, a sorted list.

    Errors: ``not an object`` (also for broken JSON and repeated keys),
    ``unknown tool``, ``missing p``, ``type p``, ``choice p``, ``extra p``. An
    argument that is null counts as given, of type null.
    """
    schema = (
        tools.filter("tool is not null and param is not null")
        .groupBy("tool")
        .agg(F.sort_array(F.collect_set(F.struct("param", "type", "required", "choices"))).alias("params"))
    )
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.expr("schema_of_variant(parsed)").startswith("OBJECT"), F.lit(False))
    held = calls.withColumn("parsed", parsed).withColumn("is_object", is_object)
    given = held.withColumn("given", F.when(F.col("is_object"), F.from_json("arguments", "map<string,variant>")))
    met = given.join(schema, given["name"] == schema["tool"], "left")

    def complaints(p: Column) -> Column:
        value = F.try_element_at(F.col("given"), p["param"])
        there = F.array_contains(F.map_keys("given"), p["param"])
        kind = F.schema_of_variant(value)
        listed = p["choices"].isNull() | F.array_contains(p["choices"], F.try_variant_get(value, "$", "string"))
        return (
            F.when(~there & F.coalesce(p["required"], F.lit(False)), F.concat(F.lit("missing "), p["param"]))
            .when(there & p["type"].isNotNull() & ~_fits(kind, p["type"]), F.concat(F.lit("type "), p["param"]))
            .when(there & ~F.coalesce(listed, F.lit(False)), F.concat(F.lit("choice "), p["param"]))
        )

    known = F.transform("params", lambda p: p["param"])
    extra = F.transform(F.array_except(F.map_keys("given"), known), lambda k: F.concat(F.lit("extra "), k))
    wrong = F.array_compact(F.concat(F.transform("params", complaints), extra))
    errors = (
        F.when(F.col("params").isNull(), F.array(F.lit("unknown tool")))
        .when(~F.col("is_object"), F.array(F.lit("not an object")))
        .otherwise(F.array_sort(F.array_distinct(wrong)))
    )
    return met.withColumn("errors", errors).drop("tool", "params", "given", "is_object")


def canonical(value: Column) -> Column:
    """JSON without spaces, keys sorted at every depth."""
    return F.to_json(F.to_variant_object(value))


def link_calls(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """(conv_id, kind, call_id, turn, level, status, errors, json): linked messages.

    In a conversation, (level, kind, turn, call_id) is a topological order: a
    call comes after the call that it names, and a result after its call. The
    least row (turn, name, SHA-256 of the arguments, after) of a call id counts,
    others are 'duplicate'. Repeated rows count once. ``status`` is 'answered',
    'unanswered' or 'duplicate' for calls and 'linked' or 'orphan' for results;
    ``errors`` joins what validating found, then 'cycle' or 'dangling'. A call
    id that is null links to nothing. Empty tables give no rows; extra columns
    are ignored.
    """
    calls = plain(calls, "conv_id", "call_id", "turn", "name", "arguments", "after").distinct()
    results = plain(results, "conv_id", "call_id", "turn", "content").distinct()
    calls, results = settled(calls, "calls"), settled(results, "results")
    # A row is compared by its digest, so arguments only move where rows are made.
    body = F.struct("turn", "name", F.sha2("arguments", 256).alias("digest"), "after")
    firsts = calls.filter("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(body).alias("chosen"))
    firsts = settled(firsts, "firsts")
    placed = levels(firsts.select("conv_id", "call_id", "chosen.after"))
    placed = placed.select(F.col("conv_id").alias("p_conv"), F.col("call_id").alias("p_call"), "level", "order")
    answers = results.filter("call_id is not null").groupBy("conv_id", "call_id").agg(F.count("*").alias("answers"))
    answers = answers.select(F.col("conv_id").alias("a_conv"), F.col("call_id").alias("a_call"), "answers")
    met = firsts.join(placed, _same(firsts, placed, ("conv_id", "p_conv")) & (firsts["call_id"] == placed["p_call"]))
    met = met.join(answers, _same(met, answers, ("conv_id", "a_conv")) & (met["call_id"] == answers["a_call"]), "left")
    state = met.select(
        F.col("conv_id").alias("f_conv"),
        F.col("call_id").alias("f_call"),
        "level",
        "order",
        "chosen",
        F.col("answers").isNotNull().alias("answered"),
    )
    state = settled(state, "state")
    checked = validated(calls, tools)
    # Calls and results meet their call's one row by hash join on the identifier; the
    # runtime cuts a skewed key of the left side.
    state = state.hint("shuffle_hash")
    met = checked.join(state, _same(checked, state, ("conv_id", "f_conv")) & (checked["call_id"] == state["f_call"]), "left")
    first = F.col("chosen").isNotNull() & F.col("chosen").eqNullSafe(body)
    status = (
        F.when(F.col("call_id").isNull(), "unanswered")
        .when(~first, "duplicate")
        .when(F.col("answered"), "answered")
        .otherwise("unanswered")
    )
    found = F.concat("errors", F.when(F.col("order").isin("cycle", "dangling"), F.array("order")).otherwise(F.array().cast("array<string>")))
    call = F.struct(F.col("parsed").alias("arguments"), F.col("call_id").alias("id"), "name", F.lit("call").alias("type"))
    out = met.select(
        "conv_id",
        F.lit("call").alias("kind"),
        "call_id",
        "turn",
        F.when(F.col("call_id").isNull(), F.lit(0)).otherwise(F.col("level")).cast("bigint").alias("level"),
        status.alias("status"),
        F.array_join(found, "; ").alias("errors"),
        canonical(call).alias("json"),
    )
    answer = F.struct("content", F.col("call_id").alias("id"), F.lit("result").alias("type"))
    met = results.join(state, _same(results, state, ("conv_id", "f_conv")) & (results["call_id"] == state["f_call"]), "left")
    linked = F.col("f_call").isNotNull()
    replies = met.select(
        "conv_id",
        F.lit("result").alias("kind"),
        "call_id",
        "turn",
        "level",
        F.when(linked, "linked").otherwise("orphan").alias("status"),
        F.when(F.col("order") == "cycle", "cycle").otherwise("").alias("errors"),
        canonical(answer).alias("json"),
    )
    return out.unionByName(replies)


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a table (conv_id, turn, role, text).

    A user's turn calls the tool ``ask``, a system turn ``configure``; another
    role's turn is the result of the turn just before it. Each call comes after
    the call that precedes it: the turn before, or the one before a reply. A
    turn without role or turn number is a result that links to nothing.
    """
    turns = plain(turns, "conv_id", "turn", "role", "text").distinct()
    number = F.col("turn").cast("bigint")
    name = lambda n: F.concat_ws(":", F.col("conv_id").cast("string"), n.cast("string"))
    asks = F.coalesce(F.col("role").isin("user", "system") & F.col("turn").isNotNull(), F.lit(False))
    calls = turns.filter(asks)
    before = turns.groupBy("conv_id", "turn").agg(F.min("role").alias("before")).select(F.col("conv_id").alias("b_conv"), (F.col("turn") + 1).alias("b_turn"), "before")
    met = calls.join(before, _same(calls, before, ("conv_id", "b_conv")) & (calls["turn"] == before["b_turn"]), "left")
    back = F.when(F.col("before").isin("user", "system"), 1).when((F.col("before").isNotNull()) & (number >= 2), 2)
    prompt = F.struct(F.col("text").alias("prompt"), number.alias("turn"))
    order = F.struct(F.col("text").alias("instruction"))
    made = met.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        name(number).alias("call_id"),
        number.alias("turn"),
        F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", F.to_json(prompt)).otherwise(F.to_json(order)).alias("arguments"),
        F.when(back.isNotNull(), name(number - back)).alias("after"),
    )
    replies = turns.filter(~asks).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.when(F.col("turn").isNotNull(), name(number - 1)).alias("call_id"),
        number.alias("turn"),
        F.col("text").alias("content"),
    )
    return made, replies


#: The schemas of the two tools that conversations call.
CONVERSATION_TOOLS = [
    ("ask", "prompt", "string", True, None),
    ("ask", "turn", "integer", True, None),
    ("configure", "instruction", "string", True, None),
]


def conversation_tools(spark: SparkSession) -> DataFrame:
    """:data:`CONVERSATION_TOOLS` as a table, written in expressions."""
    kinds = [f.split(" ")[1] for f in TOOLS.split(", ")]
    rows = [F.struct(*[F.lit(v).cast(k).alias(n.split(" ")[0]) for v, k, n in zip(row, kinds, TOOLS.split(", "))]) for row in CONVERSATION_TOOLS]
    return spark.range(1).select(F.inline(F.array(*rows)))
