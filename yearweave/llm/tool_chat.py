"""Tool calls in chats: link calls to results, order them, validate arguments, write canonical JSON.

All DataFrame operations. Calls and results meet in a hash join by conversation and call identifier, each side
reduced to one row per identifier before. An argument may refer to the result of another call as ``"${id}"``, at any
depth of its JSON; a call comes after all it refers to. Its level is the length of the longest chain of references
behind it, in every conversation alike, so that (level, turn) is a topological order. Calls with one reference, the
usual case, find the end of their chain by doubling pointers, in rounds that grow with the logarithm of the
longest chain; calls with several go through rounds that take, level by level, those whose references are known.
Canonical JSON has sorted keys, no white space and numbers in one form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: JSON types by the prefix of the type that Spark's variant functions report.
JSON_TYPES = {
    "string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"],
    "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}
#: Tool name to its parameters: the JSON type, and whether it is required.
Schemas = dict[str, dict[str, tuple[str, bool]]]
REPLY: Schemas = {"reply": {"after": ("string", False), "text": ("string", True), "turn": ("integer", True)}}
#: A JSON string that is a reference as a whole, and not the name of a field.
_REFERENCE = r'(?<!\\)"\$\{([^}"\\]+)\}"(?!:)'


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Array of what is wrong with a call's JSON arguments: malformed, unknown tool, missing, wrongly typed or unknown parameters."""
    variant = F.try_parse_json(arguments)
    is_object = F.schema_of_variant(variant).startswith("OBJECT")
    per_tool = []
    for tool, parameters in schemas.items():
        errors = []
        for parameter, (kind, required) in parameters.items():
            found = F.schema_of_variant(F.variant_get(variant, f"$['{parameter}']", "variant"))
            fits = F.lit(False)
            for prefix in JSON_TYPES[kind]:
                fits = fits | found.startswith(prefix)
            missing = found.isNull() | (found == "VOID")
            errors.append(F.when(missing, f"missing {parameter}" if required else None).when(~fits, f"{parameter} is not {kind}"))
        unknown = F.transform(
            F.array_sort(F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, parameters)))),
            lambda k: F.concat(F.lit("unknown "), k))
        per_tool.append((tool, F.concat(F.array_compact(F.array(*errors)), unknown)))
    checked = F.array(F.lit("unknown tool"))
    for tool, errors in per_tool:
        checked = F.when(name == tool, errors).otherwise(checked)
    return F.when(variant.isNull() | ~is_object, F.array(F.lit("malformed arguments"))).otherwise(checked)


def _chain_ends(single: DataFrame) -> DataFrame:
    """Of calls with one reference (conv_id, call_id, refers_to): ``end``, the first call down the chain that is none
    of them, and ``steps`` to it; calls in a cycle, or behind one, get no row."""
    pointers = stage(single.select("conv_id", "call_id", F.col("refers_to").alias("end"), F.lit(1).cast("long").alias("steps")), "pointers")
    for _ in range(pointers.count().bit_length() + 1):
        further = pointers.select("conv_id", F.col("call_id").alias("end"), F.col("end").alias("next"), F.col("steps").alias("more"))
        pointers = stage(pointers.join(further, ["conv_id", "end"], "left").select(
            "conv_id", "call_id", F.coalesce("next", "end").alias("end"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("next").isNotNull().alias("moved")), "pointers")
        if pointers.filter("moved").isEmpty():
            return pointers.drop("moved")
        pointers = pointers.drop("moved")
    inside = single.select("conv_id", F.col("call_id").alias("end"))
    return pointers.join(inside, ["conv_id", "end"], "left_anti")


def _levels(nodes: DataFrame, references: DataFrame) -> DataFrame:
    """The longest chain of references behind each call: conv_id, call_id, level; those in a cycle, or behind one, get
    no row. References to no call do not count."""
    key = ["conv_id", "call_id"]
    nodes = nodes.select(*key).dropna().distinct()
    known = stage(references.select(*key, "refers_to").distinct().join(
        nodes.select("conv_id", F.col("call_id").alias("refers_to")), ["conv_id", "refers_to"], "left_semi"), "known")
    counted = known.groupBy(*key).agg(F.count("*").alias("n"), F.min("refers_to").alias("refers_to"))
    free = nodes.join(counted, key, "left_anti").withColumn("level", F.lit(0).cast("long"))
    ends = stage(_chain_ends(counted.filter("n = 1")), "ends")
    several = stage(counted.filter("n > 1").select(*key), "several")
    levels = free
    if not several.isEmpty():
        # Each reference of these calls, led on to the end of its chain.
        last = ends.select("conv_id", F.col("call_id").alias("refers_to"), "end", "steps")
        chained = counted.filter("n = 1").select("conv_id", F.col("call_id").alias("refers_to"), F.lit(True).alias("chained"))
        links = stage(known.join(several, key, "left_semi").join(last, ["conv_id", "refers_to"], "left").join(
            chained, ["conv_id", "refers_to"], "left").select(
            *key, F.when(F.col("chained"), F.col("end")).otherwise(F.col("refers_to")).alias("end"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps")),
            "links")
        levels, waiting = stage(free, "levels"), several
        while True:
            at_end = levels.select("conv_id", F.col("call_id").alias("end"), F.col("level").alias("before"))
            met = links.join(waiting, key, "left_semi").join(at_end, ["conv_id", "end"], "left")
            ready = stage(met.groupBy(*key).agg(
                F.bool_and(F.col("before").isNotNull()).alias("all"), F.max(F.col("before") + F.col("steps")).alias("level")).filter("all").drop("all"), "ready")
            if ready.isEmpty():
                break
            levels, waiting = stage(levels.unionByName(ready), "levels"), stage(waiting.join(ready, key, "left_anti"), "waiting")
    at_end = levels.select("conv_id", F.col("call_id").alias("end"), "level")
    chains = ends.join(at_end, ["conv_id", "end"]).select(*key, (F.col("level") + F.col("steps")).alias("level"))
    return levels.unionByName(chains)


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per different call, and per identifier of results without a call.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text); ``results``: conv_id, call_id, turn,
    content. Returns conv_id, call_id, turn, level, name, n_results, errors and message (canonical JSON).
    (level, turn) sorts a conversation's calls topologically; level is 0 without references to known calls, and a call in
    a cycle, or behind one, has none. Of several
    results with one identifier the earliest (then least) is linked. Calls repeated in every column count once;
    an identifier with different calls is an error of each. A null identifier links to nothing. Other columns
    are not read.
    """
    key = ["conv_id", "call_id"]
    calls = stage(calls.select(*key, "turn", "name", "arguments").distinct(), "calls")
    identifiers = calls.groupBy(*key).agg(F.count("*").alias("n_calls"))
    canonical = F.to_json(F.try_parse_json("arguments"))
    references = stage(calls.select(*key, "turn", F.explode(F.regexp_extract_all(canonical, F.lit(_REFERENCE), 1)).alias("refers_to")).distinct(),
                       "references")
    known = references.join(identifiers.select(
        "conv_id", F.col("call_id").alias("refers_to"), F.lit(True).alias("known")), ["conv_id", "refers_to"], "left")
    broken = known.filter("known IS NULL").select(*key, "turn", F.concat(F.lit("unknown reference "), "refers_to").alias("e")).groupBy(
        *key, "turn").agg(F.array_sort(F.collect_set("e")).alias("broken"))
    levels = _levels(calls, references)
    answers = results.select(*key, "turn", "content").groupBy(*key).agg(
        F.count("*").alias("n_results"), F.min(F.struct("turn", "content")).alias("answer"))
    ordered = (
        calls.join(identifiers.select(*key, "n_calls"), key, "left").join(broken, [*key, "turn"], "left")
        .join(levels, key, "left"))
    unnamed = F.col("conv_id").isNull() | F.col("call_id").isNull()  # links to nothing, so waits for nothing
    ordered = ordered.withColumn("level", F.when(unnamed, 0).otherwise(F.col("level")).cast("int"))
    linked = ordered.withColumn("is_call", F.lit(True)).join(answers.hint("shuffle_hash"), key, "full")
    none = F.array().cast("array<string>")
    errors = F.when(F.col("is_call"), F.concat(
        argument_errors(F.col("name"), F.col("arguments"), schemas),
        F.when(F.col("n_calls") > 1, F.array(F.lit("identifier used twice"))).otherwise(none),
        F.coalesce("broken", none),
        F.when(F.col("level").isNull(), F.array(F.lit("cyclic references"))).otherwise(none),
        F.when(F.col("n_results").isNull(), F.array(F.lit("no result"))).otherwise(none),
    )).otherwise(F.array(F.lit("result without a call")))
    message = F.to_json(F.struct(
        F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"), F.col("name"),
        F.col("answer.content").alias("result")), {"ignoreNullFields": "false"})
    return linked.select(
        *key, F.coalesce("turn", "answer.turn").alias("turn"), "level", "name",
        F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"), errors.alias("errors"), message.alias("message"))


def calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chat turns as tool calls: a user turn calls ``reply`` with its text and refers to the user turn two
    before, where there is one; the assistant turn after it is the result."""
    call_id = lambda turn: F.concat(F.lit("turn-"), (turn).cast("string"))
    users = conversations.filter("role = 'user'").select("conv_id", "turn", "text")
    earlier = users.select("conv_id", (F.col("turn") + 2).alias("turn"), F.lit(True).alias("follows")).distinct()
    after = F.when(F.col("follows"), F.concat(F.lit("${"), call_id(F.col("turn") - 2), F.lit("}")))
    calls = users.join(earlier, ["conv_id", "turn"], "left").select(
        "conv_id", call_id(F.col("turn")).alias("call_id"), "turn", F.lit("reply").alias("name"),
        F.to_json(F.struct(after.alias("after"), "text", "turn")).alias("arguments"))
    results = conversations.filter("role = 'assistant'").select(
        "conv_id", call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def linked_chat(conversations: DataFrame) -> DataFrame:
    return link_calls(*calls_and_results(conversations), REPLY)
