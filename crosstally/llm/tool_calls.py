"""Chat formatting: tool calls linked to their results, ordered, checked and serialised.

Calls and results meet in a hash join on (conversation, call id), after each side was
reduced to one row per id, so a repeated id costs a row per task. Calls are ordered
topologically: a call's level is one more than the highest level of the calls it depends
on. Levels are found in rounds, as many as the longest chain of dependencies is long; each
round joins the calls released last with the edges and writes the calls still waiting to
the shared folder. (level, position) orders a conversation, which needs no task that holds
a whole conversation. Arguments are checked against a schema for each tool, and each record
is written as canonical JSON: keys sorted, no spaces, explicit nulls, one form for each
number. Native DataFrame code; schemas are a small table given by the caller.

Numbers: whole ones are written as digits without fraction or exponent (`1e2` and `100.0`
become `100`), integers with all their digits; others with the digits that the JVM writes for
the double (the fewest that give it, but for rare values of JVMs before 19), with an exponent
below 1e-6 and from 1e21.

Results for odd input: of calls that repeat an id the first by position, name and
arguments counts, and of results the first by position and content; `repeats` counts the
others of both. A result without a call is a record of its own (status orphan), a call
without a result is pending; calls on a cycle, or behind one, have no level (status
cycle). Arguments that are no JSON are kept as a string. Dependencies on unknown calls are
listed but do not order. Null ids of a
conversation are one conversation; calls and results with a null call id are left out,
as nothing can refer to them. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from crosstally.llm.common import saved

KEY = ["conv_id", "call_id"]
#: JSON types of schemas and the variant types that they accept: fixed values.
ACCEPTS = {
    "integer": "BIGINT",
    "number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT",
    "string": "STRING",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
    "null": "VOID",
}


@dataclass(frozen=True)
class Parameter:
    kind: str
    required: bool = True


def json_text(text: Column) -> Column:
    """A string as a JSON string; null as null."""
    listed = F.to_json(F.array(text))
    inner = F.substring(listed, F.lit(2), F.length(listed) - 2)
    return F.when(text.isNull(), F.lit("null")).otherwise(inner)


def argument_errors(name: Column, arguments: Column, tools: Mapping[str, Mapping[str, Parameter]]) -> Column:
    """What is wrong with the arguments (a JSON text), sorted; empty if nothing is."""
    parsed = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    errors = F.array(F.lit("unknown tool"))
    for tool, parameters in tools.items():
        found = []
        for key, parameter in sorted(parameters.items()):
            kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{key}", "variant"))
            wrong = ~kind.rlike(f"^({ACCEPTS[parameter.kind]})$")
            missing = F.lit(f"missing {key}") if parameter.required else F.lit(None).cast("string")
            found.append(F.when(kind.isNull(), missing).when(wrong, F.lit(f"{key} is not {parameter.kind}")))
        unexpected = F.array_except(keys, F.array(*(F.lit(k) for k in parameters)).cast("array<string>"))
        found = F.filter(F.array(*found).cast("array<string>"), lambda e: e.isNotNull())
        checked = F.concat(found, F.transform(unexpected, lambda k: F.concat(F.lit("unexpected "), k)))
        whole = F.when(parsed.isNull(), F.array(F.lit("not JSON"))).when(
            ~F.schema_of_variant(parsed).startswith("OBJECT"), F.array(F.lit("not an object"))
        )
        errors = F.when(name == tool, F.coalesce(whole, checked)).otherwise(errors)
    return F.array_sort(errors)


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls that can be ordered; calls hold depends_on."""
    ids = calls.select(*KEY)
    wanted = calls.select(*KEY, F.explode(F.array_distinct("depends_on")).alias("dep"))
    known = ids.select(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_call"))
    edges = wanted.join(
        known, F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("dep") == F.col("k_call")), "left_semi"
    )
    edges = saved(edges, "call_edges")
    waiting = saved(edges.groupBy(*KEY).agg(F.count("*").alias("open")), "call_waiting")
    w = waiting.select(F.col("conv_id").alias("w_conv"), F.col("call_id").alias("w_call"))
    free = ids.join(w, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("call_id") == F.col("w_call")), "left_anti")
    frontier = saved(free.withColumn("level", F.lit(0)), "call_level")
    done = frontier
    level = 0
    while not frontier.isEmpty() and not waiting.isEmpty():
        level += 1
        f = frontier.select(F.col("conv_id").alias("f_conv"), F.col("call_id").alias("f_call"))
        met = edges.join(f, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("dep") == F.col("f_call")))
        met = met.groupBy(F.col("conv_id").alias("m_conv"), F.col("call_id").alias("m_call")).agg(
            F.count("*").alias("met")
        )
        same = F.col("conv_id").eqNullSafe(F.col("m_conv")) & (F.col("call_id") == F.col("m_call"))
        left = waiting.join(met, same, "left").select(*KEY, (F.col("open") - F.coalesce("met", F.lit(0))).alias("open"))
        left = saved(left, "call_waiting")
        waiting = left.filter("open > 0")
        frontier = left.filter("open = 0").select(*KEY, F.lit(level).alias("level"))
        done = done.unionByName(frontier)
    return done


def link(calls: DataFrame, results: DataFrame, tools: Mapping[str, Mapping[str, Parameter]]) -> DataFrame:
    """One record per call and per result without a call.

    calls: conv_id, call_id, position, name, arguments (JSON text), depends_on (array);
    results: conv_id, call_id, position, content. Returns conv_id, call_id, level,
    position, name, status, errors, repeats, json.
    """
    first_call = F.min(F.struct("position", "name", "arguments", "depends_on"))
    calls = calls.filter("call_id IS NOT NULL").groupBy(*KEY).agg(first_call.alias("c"), F.count("*").alias("n_calls"))
    calls = saved(calls.select(*KEY, "c.*", "n_calls"), "calls")
    first_result = F.min(F.struct("position", "content"))
    results = results.filter("call_id IS NOT NULL").groupBy(*KEY).agg(first_result.alias("r"), F.count("*").alias("n"))
    results = saved(
        results.select(
            F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), F.col("r.position").alias("r_position"),
            F.col("r.content").alias("content"), F.col("n").alias("n_results"),
        ),
        "call_results",
    )
    placed = saved(levels(calls), "call_levels").select(
        F.col("conv_id").alias("l_conv"), F.col("call_id").alias("l_call"), "level"
    )
    same_result = F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("call_id") == F.col("r_call"))
    same_level = F.col("conv_id").eqNullSafe(F.col("l_conv")) & (F.col("call_id") == F.col("l_call"))
    linked = calls.join(results.hint("shuffle_hash"), same_result, "left").join(
        placed.hint("shuffle_hash"), same_level, "left"
    )
    errors = argument_errors(F.col("name"), F.col("arguments"), tools)
    linked = linked.withColumn("errors", F.array_join(errors, "; ")).select(
        "conv_id", "call_id", "level", "position", "name", "arguments", "depends_on", "content", "errors",
        (F.col("n_calls") + F.coalesce("n_results", F.lit(1)) - 2).alias("repeats"),
        F.when(F.col("level").isNull(), "cycle").when(F.col("errors") != "", "invalid")
        .when(F.col("n_results").isNull(), "pending").otherwise("ok").alias("status"),
    )
    c = calls.select(F.col("conv_id").alias("c_conv"), F.col("call_id").alias("c_call"))
    orphans = results.join(
        c, F.col("r_conv").eqNullSafe(F.col("c_conv")) & (F.col("r_call") == F.col("c_call")), "left_anti"
    ).select(
        F.col("r_conv").alias("conv_id"), F.col("r_call").alias("call_id"), F.col("r_position").alias("position"),
        "content", F.lit("").alias("errors"), (F.col("n_results") - 1).alias("repeats"),
        F.lit("orphan").alias("status"),
    )
    both = linked.unionByName(orphans, allowMissingColumns=True)
    return both.withColumn("json", canonical_json()).select(
        "conv_id", "call_id", "level", "position", "name", "status", "errors", "repeats", "json"
    )


def canonical_number(number: Column) -> Column:
    """The one form of a JSON number."""
    value = number.cast("double")
    size = F.abs(value)
    whole = (value == F.rint(value)) & (size < 1e21)
    fraction = F.when(size < 1, value.cast("decimal(38,25)").cast("string")).otherwise(
        value.cast("decimal(38,18)").cast("string")
    )
    scientific = F.replace(value.cast("string"), F.lit(".0E"), F.lit("E"))
    scientific = F.regexp_replace(F.replace(scientific, F.lit("E-"), F.lit("e-")), "E", "e+")
    return (
        F.when(number.rlike("^-?0+$"), "0")
        .when(number.rlike("^-?[0-9]+$"), number)
        .when(value == 0, "0")
        .when(whole, value.cast("decimal(22,0)").cast("string"))
        .when((size >= 1e-6) & (size < 1e21), F.regexp_replace(fraction, r"\.?0+$", ""))
        .otherwise(scientific)
    )


def canonical_numbers(json: Column) -> Column:
    """A JSON text with all its numbers in their one form; strings are left alone.

    Two control characters, which JSON never holds bare, stand for escaped backslashes and
    quotes while the text is cut at quotes: every second piece is then a string.
    """
    backslash, quote = ("\\\\", "\1"), ('\\"', "\2")
    plain = json
    for escaped, sign in (backslash, quote):
        plain = F.replace(plain, F.lit(escaped), F.lit(sign))

    def outside(piece: Column) -> Column:
        tokens = F.regexp_extract_all(piece, F.lit("-?[0-9][0-9.eE+-]*|[^0-9-]+"), 0)
        return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), canonical_number(t)).otherwise(t)), "")

    pieces = F.transform(F.split(plain, '"'), lambda piece, i: F.when(i % 2 == 0, outside(piece)).otherwise(piece))
    done = F.array_join(pieces, '"')
    for escaped, sign in (quote, backslash):
        done = F.replace(done, F.lit(sign), F.lit(escaped))
    return done


def canonical_json() -> Column:
    """The record as canonical JSON; arguments that are no JSON become a string, keys of objects are sorted."""
    depends = F.array_sort(F.filter("depends_on", lambda d: d.isNotNull()))
    arguments = canonical_numbers(F.to_json(F.try_parse_json("arguments")))
    return F.concat(
        F.lit('{"arguments":'), F.coalesce(arguments, json_text(F.col("arguments"))),
        F.lit(',"call_id":'), json_text(F.col("call_id")),
        F.lit(',"depends_on":'), F.coalesce(F.to_json(depends), F.lit("[]")),
        F.lit(',"name":'), json_text(F.col("name")),
        F.lit(',"result":'), json_text(F.col("content")),
        F.lit(',"status":'), json_text(F.col("status")), F.lit("}"),
    )


#: Tools of the calls that `derived_calls` makes.
TOOLS: Mapping[str, Mapping[str, Parameter]] = {
    "search": {"query": Parameter("string"), "limit": Parameter("integer")},
    "lookup": {"id": Parameter("integer"), "fields": Parameter("array", False), "note": Parameter("string", False)},
    "translate": {"text": Parameter("string"), "target": Parameter("string"), "formal": Parameter("boolean", False)},
    "convert": {"value": Parameter("number"), "note": Parameter("string", False)},
}


def derived_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read from the turns (conv_id, turn, role, text) of conversations.

    Each assistant turn is a call whose tool follows from the length of its text and whose
    arguments hold the whole text. A call depends on the calls at half and a third of its
    turn. Each user turn is the result of the call one turn before; opening turns and those
    of other roles answer no call and are results under an id of their own.
    """
    text = F.coalesce("text", F.lit(""))
    quoted = json_text(text)
    n = F.size(F.split(text, " "))
    limit = F.when(n % 7 == 0, F.lit('"many"')).otherwise((n % 20).cast("string"))
    search = F.concat(F.lit('{"query": '), quoted, F.lit(', "limit": '), limit, F.lit("}"))
    number = F.when(n % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(', "id": '), F.col("turn").cast("string")))
    lookup = F.concat(F.lit('{"note": '), quoted, F.lit(', "fields": ["b", "a"]'), number, F.lit("}"))
    tone = F.when(n % 6 == 0, F.lit(', "tone": "dry"')).otherwise(F.lit(""))
    translate = F.concat(F.lit('{"text": '), quoted, tone, F.lit(', "formal": true, "target": "de"}'))
    value = F.when(n % 2 == 0, F.lit(', "value": ')).otherwise(F.lit(', "value": 2.50}'))
    convert = F.concat(F.lit('{"note": '), quoted, value)
    kind = F.length(text) % 4
    name = F.when(kind == 0, "search").when(kind == 1, "lookup").when(kind == 2, "translate")
    name = name.otherwise(F.when(n % 3 == 0, "forget").otherwise("convert"))
    arguments = F.when(kind == 0, search).when(kind == 1, lookup).when(kind == 2, translate).otherwise(convert)
    calls = turns.filter("role = 'assistant'").select(
        "conv_id", F.expr("concat('call-', turn)").alias("call_id"), F.col("turn").alias("position"),
        name.alias("name"), arguments.alias("arguments"),
        F.expr("array_distinct(array(concat('call-', turn div 2), concat('call-', turn div 3)))").alias("depends_on"),
    )
    calls = calls.withColumn("depends_on", F.array_remove("depends_on", F.col("call_id")))
    answered = F.expr("IF(role = 'user' AND turn > 0, concat('call-', turn - 1), concat(coalesce(role, 'turn'), '-', turn))")
    results = turns.filter("coalesce(role, '') <> 'assistant'").select(
        "conv_id", answered.alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )
    return calls, results
