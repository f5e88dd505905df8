"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

DataFrame operations only. A conversation is a set of events: plain messages, tool calls and tool results. Calls and results meet in a
hash join on their identifier. Each event has to follow others: a result its call, a call the results it names as
inputs. Events keep their recorded place if that already respects all links; only conversations in
which some event stands before one it needs are sorted anew, by level: an event comes after the highest level it needs. Chains,
however long, are contracted by pointers that double; only events with several needs take rounds, one for each of them on a
path, and every round writes the shared folder. Events of a cycle and what follows them, which no order can serve, come
last in recorded order and are marked. Arguments are parsed, checked against the schema of the tool (unknown tool or
argument, missing argument, wrong type) and written as JSON with sorted keys and no spaces.

Ranks within a conversation are built from counts of ranges of places, so a conversation that holds a large part of all
events is spread over tasks; nothing is collected per conversation.

A row without conv_id is a conversation of its own. Null places come first, events of one place in the order of a hash. Null identifiers link nothing. A call that repeats an identifier is kept, the first in recorded order owns the links
and the rest are marked `duplicate`. Results without a call are `orphan`, calls without a result `open`. Arguments that are null
or no JSON object are `invalid`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.lookup import join_lookup
from tidewatch.session import materialize

#: Columns of events: kind is message, call or result; needs are identifiers of calls whose results come first.
EVENT = "conv_id long, place long, kind string, call_id string, tool string, arguments string, needs array<string>, role string, text string"


def canonical(document: Column) -> Column:
    """JSON with sorted keys, no spaces and plain escapes; null for what is no JSON."""
    return F.to_json(F.try_parse_json(document))


def _type_name(value: Column) -> Column:
    """JSON type of a variant: null, boolean, integer, number, string, array or object."""
    shape = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (shape == "VOID"), "null").when(shape == "BOOLEAN", "boolean").when(shape == "BIGINT", "integer")
        .when(shape.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number").when(shape.startswith("ARRAY"), "array")
        .when(shape.startswith("OBJECT"), "object").otherwise("string")
    )


def validate(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds arguments_json (canonical) and problems, a sorted array of strings; empty for a valid call.

    `schemas` has a row per tool and argument: tool, argument, type, required. A type `number` accepts integers.
    """
    argument = F.struct("argument", "type", "required")
    tools = schemas.groupBy("tool").agg(F.sort_array(F.collect_set(argument)).alias("schema"))  # one row per tool
    joined = join_lookup(calls, tools, ["tool"], "left")
    parsed = F.try_parse_json("arguments")
    isobject = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    fields = F.when(isobject, parsed.cast("map<string,variant>"))
    rows = joined.withColumns({"_fields": fields, "arguments_json": F.to_json(parsed)})
    names = F.map_keys("_fields")
    known = F.transform("schema", lambda s: s["argument"])
    missing = F.transform(F.filter("schema", lambda s: s["required"] & ~F.array_contains(names, s["argument"])), lambda s: F.concat(F.lit("missing:"), s["argument"]))
    unknown = F.transform(F.array_except(names, known), lambda n: F.concat(F.lit("unknown:"), n))

    def wrong(s: Column) -> Column:
        found = _type_name(F.element_at("_fields", s["argument"]))
        return F.array_contains(names, s["argument"]) & (found != s["type"]) & ~((s["type"] == "number") & (found == "integer"))

    typed = F.transform(F.filter("schema", wrong), lambda s: F.concat(F.lit("type:"), s["argument"]))
    problems = (
        F.when(F.col("kind") != "call", F.array().cast("array<string>"))
        .when(F.col("schema").isNull(), F.array(F.lit("unknown_tool")))
        .when(F.col("_fields").isNull(), F.array(F.lit("invalid")))
        .otherwise(F.sort_array(F.concat(missing, unknown, typed)))
    )
    return rows.withColumn("problems", problems).drop("_fields", "schema")


def ranked(rows: DataFrame, keys: dict[str, Column], name: str) -> DataFrame:
    """Adds the rank (from 1) within conv_id by several sort keys, each refining the one before; 1 without conv_id.

    Counts per key prefix are added up level by level, so a window holds the distinct values of one key below one prefix, and
    the last one the rows that share all keys but the last.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = rows.withColumns(dict(zip(names, keys.values(), strict=True)))
    known = keyed.filter("conv_id IS NOT NULL")
    for n in names[:-1]:
        known = known.withColumn(n, F.coalesce(F.col(n).cast("long"), F.lit(-(2**62))))
    counts = known.groupBy("conv_id", *names[:-1]).agg(F.count(F.lit(1)).alias("held"))
    counts = materialize(counts, "rank_counts")
    offsets = counts.select("conv_id", *names[:-1], F.lit(0).cast("long").alias("before"))
    for level in range(len(names) - 1):
        prefix = ["conv_id", *names[: level + 1]]
        sums = counts.groupBy(*prefix).agg(F.sum("held").alias("held"))
        earlier = Window.partitionBy(*prefix[:-1]).orderBy(prefix[-1]).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select(*prefix, F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("more"))
        offsets = offsets.join(sums, prefix).withColumn("before", F.col("before") + F.col("more")).drop("more")
    inner = Window.partitionBy("conv_id", *names[:-1]).orderBy(names[-1])
    own = known.withColumn("_own", F.row_number().over(inner)).join(offsets, ["conv_id", *names[:-1]])
    whole = own.withColumn(name, (F.col("before") + F.col("_own")).cast("long"))
    alone = keyed.filter("conv_id IS NULL").withColumn(name, F.lit(1).cast("long"))
    columns = [*rows.columns, name]
    return whole.select(*columns).union(alone.select(*columns))


def link(events: DataFrame) -> DataFrame:
    """Adds event (a number per conversation, from 1), status, call_event (of a result) and result_event (of a call)."""
    content = F.xxhash64("kind", "call_id", "role", "text", "arguments")
    keys = {"range": F.floor(F.col("place") / 1024), "place": F.col("place"), "byte": F.shiftright(content, 56), "content": content}
    numbered = materialize(ranked(events, keys, "event"), "events")
    keyed = numbered.filter("call_id IS NOT NULL AND kind IN ('call', 'result')")
    owners = keyed.groupBy("conv_id", "call_id").agg(
        F.min(F.when(F.col("kind") == "call", F.col("event"))).alias("first_call"),
        F.min(F.when(F.col("kind") == "result", F.col("event"))).alias("first_result"),
    )
    owners = owners.select(F.col("conv_id").alias("o_conv"), F.col("call_id").alias("o_call"), "first_call", "first_result")
    joined = numbered.join(owners, (F.col("conv_id") == F.col("o_conv")) & (F.col("call_id") == F.col("o_call")), "left")
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    status = (
        F.when(call & (F.col("event") > F.coalesce("first_call", "event")), "duplicate")
        .when(call & F.col("first_result").isNull(), "open")
        .when(result & F.col("first_call").isNull(), "orphan")
        .otherwise("ok")
    )
    return joined.withColumns({
        "status": status,
        "call_event": F.when(result, F.col("first_call")),
        "result_event": F.when(call & (status != "duplicate"), F.col("first_result")),
    }).drop("o_conv", "o_call", "first_call", "first_result")


def _links(linked: DataFrame) -> DataFrame:
    """(conv_id, before, after): events that must stand in this order."""
    own = linked.filter("call_event IS NOT NULL").select("conv_id", F.col("call_event").alias("before"), F.col("event").alias("after"))
    needed = linked.filter("kind = 'call'").select("conv_id", F.col("event").alias("after"), F.explode("needs").alias("need"))
    results = linked.filter("kind = 'result' AND status = 'ok'").groupBy("conv_id", "call_id").agg(F.min("event").alias("before"))
    results = results.select(F.col("conv_id").alias("r_conv"), "call_id", "before")
    met = needed.join(results, (F.col("conv_id") == F.col("r_conv")) & (F.col("need") == F.col("call_id")))
    return own.union(met.select("conv_id", "before", "after")).distinct()


def _resolved(links: DataFrame) -> DataFrame:
    """(conv_id, event, anchor, apart) of the events that follow exactly one other: the nearest event before them that follows none or several.

    Pointers double in length until they stand on an anchor, so a chain of any length takes a logarithmic number of rounds. Chains
    without an anchor are cycles and keep a null anchor.
    """
    single = links.groupBy("conv_id", F.col("after").alias("event")).agg(F.min("before").alias("anchor"), F.count(F.lit(1)).alias("needs"))
    single = materialize(single.filter("needs = 1").select("conv_id", "event", "anchor", F.lit(1).cast("long").alias("apart")), "single")
    further = single.select(F.col("conv_id").alias("s_conv"), F.col("event").alias("s_event"))
    on = (F.col("conv_id") == F.col("s_conv")) & (F.col("anchor") == F.col("s_event"))
    pointers = materialize(single.join(further, on, "left").withColumn("done", F.col("s_event").isNull()).drop("s_conv", "s_event"), "pointers")
    longest = single.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    reach = 1
    while reach <= longest and not pointers.filter("NOT done").isEmpty():
        jump = pointers.select(
            F.col("conv_id").alias("s_conv"), F.col("event").alias("s_event"), F.col("anchor").alias("next"), F.col("apart").alias("more"), F.col("done").alias("there")
        )
        moved = pointers.filter("NOT done").join(jump, on).select(
            "conv_id", "event", F.col("next").alias("anchor"), (F.col("apart") + F.col("more")).alias("apart"), F.col("there").alias("done")
        )
        pointers = materialize(pointers.filter("done").union(moved), "pointers")
        reach *= 2
    return pointers.select("conv_id", "event", F.when(F.col("done"), F.col("anchor")).alias("anchor"), "apart")


def levels(links: DataFrame) -> DataFrame:
    """(conv_id, event, level) of all events in links: 1 for what follows nothing, else one more than the highest it follows.

    Events of a cycle and all that follow them have a null level. Chains are contracted first; then every round settles the events
    that follow several others, all settled. The number of rounds is that of such events on one path.
    """
    resolved = materialize(_resolved(links), "resolved")
    sources = links.select("conv_id", F.col("before").alias("event")).distinct().join(links.select("conv_id", F.col("after").alias("event")), ["conv_id", "event"], "left_anti")
    known = materialize(sources.withColumn("level", F.lit(1).cast("long")), "levels")
    counted = links.groupBy("conv_id", F.col("after").alias("event")).agg(F.count(F.lit(1)).alias("needs")).filter("needs > 1")
    several = links.withColumnRenamed("after", "event").join(counted.drop("needs"), ["conv_id", "event"])
    pointer = resolved.select(F.col("conv_id").alias("s_conv"), F.col("event").alias("s_event"), "anchor", "apart")
    several = several.join(pointer, (F.col("conv_id") == F.col("s_conv")) & (F.col("before") == F.col("s_event")), "left")
    anchor = F.when(F.col("s_event").isNull(), F.col("before")).otherwise(F.col("anchor"))
    several = several.select("conv_id", "event", anchor.alias("anchor"), (F.coalesce("apart", F.lit(0)) + 1).alias("apart"))
    waiting = materialize(several.groupBy("conv_id", "event", "anchor").agg(F.max("apart").alias("apart")), "waiting")
    while not waiting.isEmpty():
        settled = known.select(F.col("conv_id").alias("k_conv"), F.col("event").alias("k_event"), "level")
        met = waiting.join(settled, (F.col("conv_id") == F.col("k_conv")) & (F.col("anchor") == F.col("k_event")), "left")
        ready = met.groupBy("conv_id", "event").agg(F.max(F.col("level") + F.col("apart")).alias("level"), F.max(F.col("level").isNull()).alias("open"))
        ready = materialize(ready.filter("NOT open").drop("open"), "ready")
        if ready.isEmpty():
            break
        known = known.union(ready)
        waiting = materialize(waiting.join(ready.select("conv_id", "event"), ["conv_id", "event"], "left_anti"), "waiting")
    settled = known.select(F.col("conv_id").alias("k_conv"), F.col("event").alias("k_event"), "level")
    chained = resolved.join(settled, (F.col("conv_id") == F.col("k_conv")) & (F.col("anchor") == F.col("k_event")), "left")
    stuck = waiting.select("conv_id", "event").distinct().withColumn("level", F.lit(None).cast("long"))
    return known.union(chained.select("conv_id", "event", F.col("level") + F.col("apart"))).union(stuck)


def topological(linked: DataFrame) -> DataFrame:
    """Adds position (from 0, per conversation) and cyclic."""
    links = materialize(_links(linked), "chat_links")
    upset = links.filter("before >= after").select("conv_id").distinct()
    if upset.isEmpty():
        return linked.withColumns({"cyclic": F.lit(False), "position": F.col("event") - 1})
    open_links = links.join(upset.withColumnRenamed("conv_id", "u"), F.col("conv_id") == F.col("u")).drop("u")
    placed = levels(materialize(open_links, "upset_links"))
    placed = placed.select(F.col("conv_id").alias("p_conv"), F.col("event").alias("p_event"), "level")
    on = (F.col("conv_id") == F.col("p_conv")) & (F.col("event") == F.col("p_event"))
    moved = linked.join(upset.withColumnRenamed("conv_id", "u"), F.col("conv_id") == F.col("u")).drop("u").join(placed, on, "left")
    moved = moved.withColumn("cyclic", F.col("p_event").isNotNull() & F.col("level").isNull())
    turn_of = F.when(F.col("cyclic"), F.lit(2**62)).otherwise(F.coalesce("level", F.lit(0)))
    moved = materialize(moved.withColumn("round", turn_of).select(*linked.columns, "cyclic", "round"), "moved")
    keys = {"rounds": F.floor(F.col("round") / 1024), "round": F.col("round"), "range": F.floor(F.col("event") / 1024), "event": F.col("event")}
    moved = ranked(moved, keys, "position").withColumn("position", F.col("position") - 1).drop("round")
    still = linked.join(upset.withColumnRenamed("conv_id", "u"), F.col("conv_id") == F.col("u"), "left_anti")
    still = still.withColumns({"cyclic": F.lit(False), "position": F.col("event") - 1})
    return moved.select(*linked.columns, "cyclic", "position").union(still)


def serialise(ordered: DataFrame) -> DataFrame:
    """Adds json, the canonical line of an event."""
    quoted = lambda c: F.substring(F.to_json(F.struct(c.alias("v"))), F.lit(6), F.length(F.to_json(F.struct(c.alias("v")))) - 6)
    field = lambda name, value: F.concat(F.lit(f'"{name}":'), value)
    text = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(quoted(c))
    call = F.concat(
        F.lit("{"), F.concat_ws(",", field("arguments", F.coalesce("arguments_json", text(F.col("arguments")))), field("id", text(F.col("call_id"))),
        field("role", text(F.col("role"))), field("tool", text(F.col("tool")))), F.lit("}"),
    )
    plain = F.concat(F.lit("{"), F.concat_ws(",", field("content", text(F.col("text"))), field("role", text(F.col("role")))), F.lit("}"))
    result = F.concat(F.lit("{"), F.concat_ws(",", field("content", text(F.col("text"))), field("role", text(F.col("role"))), field("tool_call_id", text(F.col("call_id")))), F.lit("}"))
    return ordered.withColumn("json", F.when(F.col("kind") == "call", call).when(F.col("kind") == "result", result).otherwise(plain))


def format_chats(events: DataFrame, schemas: DataFrame) -> DataFrame:
    """Every event with position, status, problems, links, cyclic and json."""
    linked = materialize(link(validate(events, schemas)), "linked")
    return serialise(topological(linked))


# --- plain turns as tool traffic ------------------------------------------------------------------------

#: Schemas of the tools that turns_as_events calls: tool, argument, type, required.
TURN_TOOLS = [
    ("long_reply", "final", "boolean", False), ("long_reply", "n_words", "integer", True), ("long_reply", "prompt", "string", True),
    ("short_reply", "final", "boolean", False), ("short_reply", "prompt", "string", True),
]


def turn_schemas(spark) -> DataFrame:
    return spark.createDataFrame(TURN_TOOLS, "tool string, argument string, type string, required boolean")


def arrival(turns: DataFrame) -> Column:
    """A place for each turn as if turns were logged in any order: 28 bits of a hash of conversation and turn."""
    named = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.coalesce(F.col("turn").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 7), 16, 10).cast("long")


def turns_as_events(turns: DataFrame, place: Column | None = None) -> DataFrame:
    """Events of plain (conv_id, turn, role, text): a user turn calls a reply tool, the assistant turn after it is the result.

    A call needs the result of the call two turns before; other roles are messages. A prompt of at least 40 blanks asks
    for a long reply. The recorded place of an event is its turn unless another is given; the column turn is kept.
    """
    place = F.col("turn") if place is None else place
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    words = F.length("text") - F.length(F.replace("text", F.lit(" "))) + 1
    name = lambda turn: F.concat(F.lit("t"), turn.cast("string"))
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), words.alias("n_words"), (F.col("turn") >= 4).alias("final")))
    return turns.select(
        "conv_id", place.cast("long").alias("place"),
        F.when(user, "call").when(assistant, "result").otherwise("message").alias("kind"),
        F.when(user, name(F.col("turn"))).when(assistant, name(F.col("turn") - 1)).alias("call_id"),
        F.when(user, F.when(words > 40, "long_reply").otherwise("short_reply")).alias("tool"),
        F.when(user, arguments).alias("arguments"),
        F.when(user, F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("needs"),
        "role", "text", F.col("turn").cast("long").alias("turn"),
    )


def report(turns: DataFrame) -> DataFrame:
    """conv_id, turn, position, kind, call_id, status, problems (comma-joined), cyclic, json of every turn, recorded in order of arrival."""
    made = format_chats(turns_as_events(turns, arrival(turns)), turn_schemas(turns.sparkSession))
    problems = F.concat_ws(",", "problems").alias("problems")
    return made.select("conv_id", "turn", "position", "kind", "call_id", "status", problems, "cyclic", "json")
