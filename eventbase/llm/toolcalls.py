"""Tool calls and their results: linked, ordered, validated and written as canonical JSON. DataFrame functions only.

Input: ``calls`` with conv_id, turn, call_id, name, arguments (JSON text) and ``results`` with conv_id, turn, call_id,
content. A result is joined to its call by the identifier. A call whose arguments mention other calls of the conversation,
as strings of the list named ``references``, comes after them: ``level`` is its place in the topological order (0 first; within a
level calls are independent and keep the order of turns). Levels are peeled off one after the other by joins,
so a conversation of any length is spread over many tasks.

Arguments are checked against a JSON schema per tool: type object, properties with type, minLength, minimum, maximum and enum,
required, additionalProperties. The VARIANT that is checked is also what is written: its keys are sorted, no space is left.

Rules for odd input: of calls that repeat an identifier in a conversation the first by turn counts, ``n_calls`` tells how
many there were; of several results the first counts, ``n_results`` tells; results without a call are returned with status
``orphan``; null ids or conversations link with nothing; arguments that are no JSON object are an error; calls in a circle, and calls
that wait for them, have no level; references to calls that are not there are errors; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventbase.llm.common import settle

KEY = ["conv_id", "call_id"]
KINDS = {
    "string": "STRING", "boolean": "BOOLEAN", "integer": r"BIGINT|DECIMAL\(\d+,0\)", "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\)",
    "array": "ARRAY<.*>", "object": "OBJECT<.*>", "null": "VOID",
}


def errors_of(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with a call, as an array of short texts; empty if nothing is."""
    value = F.try_parse_json(arguments)
    found = [
        F.when(~F.coalesce(name.isin(list(schemas)), F.lit(False)), F.lit("unknown tool")),
        F.when(~F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False)), F.lit("no object")),
    ]
    for tool, schema in schemas.items():
        wrong: list[Column] = []
        properties = schema.get("properties", {})
        for field, rule in properties.items():
            path = f"$['{field}']"
            kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
            if field in schema.get("required", []):
                wrong.append(F.when(kind.isNull(), F.lit(f"{field}: missing")))
            if "type" in rule:
                wrong.append(F.when(~kind.rlike(f"^({KINDS[rule['type']]})$"), F.lit(f"{field}: not {rule['type']}")))
            number, text = F.try_variant_get(value, path, "double"), F.try_variant_get(value, path, "string")
            is_number, is_text = kind.rlike(f"^({KINDS['number']})$"), kind == "STRING"
            if "minimum" in rule:
                wrong.append(F.when(is_number & (number < rule["minimum"]), F.lit(f"{field}: below minimum")))
            if "maximum" in rule:
                wrong.append(F.when(is_number & (number > rule["maximum"]), F.lit(f"{field}: above maximum")))
            if "minLength" in rule:
                wrong.append(F.when(is_text & (F.length(text) < rule["minLength"]), F.lit(f"{field}: too short")))
            if "enum" in rule:
                wrong.append(F.when(~F.coalesce(text.isin(rule["enum"]), F.lit(False)) & kind.isNotNull(), F.lit(f"{field}: not allowed")))
        if schema.get("additionalProperties") is False:
            more = F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, properties)).cast("array<string>"))
            wrong.append(F.when(F.size(more) > 0, F.lit("unknown fields")))
        found += [F.when(name == tool, w) for w in wrong]
    return F.sort_array(F.filter(F.array(*found), lambda e: e.isNotNull()))


def levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """Rows (conv_id, call_id, level) by peeling: what needs nothing that is left comes next.

    ``needs`` has conv_id, call_id and the call_id it needs, ``needed``. Circles and what waits for them get no level.
    """
    known = settle(calls.select(*KEY).distinct())
    there = known.withColumnRenamed("call_id", "needed")
    left = settle(needs.join(there, ["conv_id", "needed"], "left_semi").distinct())
    waiting = left.select(*KEY).distinct()
    ready = settle(known.join(waiting, KEY, "left_anti"))
    out, level = ready.withColumn("level", F.lit(0)), 0
    while not left.isEmpty():
        level += 1
        rest = settle(left.join(ready.withColumnRenamed("call_id", "needed"), ["conv_id", "needed"], "left_anti"))
        ready = settle(left.select(*KEY).distinct().join(rest.select(*KEY).distinct(), KEY, "left_anti"))
        if ready.isEmpty():
            break
        out = out.unionByName(ready.withColumn("level", F.lit(level)))
        left = rest
    return out


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], references: str = "after") -> DataFrame:
    """One row per call (and per orphaned identifier): conv_id, call_id, turn, name, result_turn, n_calls, n_results, status,
    errors, level, json."""
    call = F.struct("turn", "name", "arguments")
    calls = calls.groupBy(*KEY).agg(F.min(call).alias("c"), F.count("*").alias("n_calls")).select(*KEY, "c.*", "n_calls")
    calls = settle(calls)
    answer = F.struct("turn", "content")
    results = results.groupBy(*KEY).agg(F.min(answer).alias("r"), F.count("*").alias("n_results"))
    results = results.select(*KEY, F.col("r.turn").alias("result_turn"), "r.content", "n_results")

    value = F.try_parse_json("arguments")
    listed = F.from_json(F.get_json_object("arguments", f"$['{references}']"), "array<string>")
    needs = settle(calls.select(*KEY, F.explode(F.array_distinct(listed)).alias("needed")).filter("needed is not null"))
    there = calls.select("conv_id", F.col("call_id").alias("needed"), F.lit(True).alias("there"))
    dangling = needs.join(there, ["conv_id", "needed"], "left").filter("there is null").select(*KEY).distinct()
    placed = levels(calls, needs)
    joined = (
        calls.join(results, KEY, "full").join(placed, KEY, "left").join(dangling.withColumn("dangling", F.lit(True)), KEY, "left")
    )
    is_call = F.col("n_calls").isNotNull()
    more = [F.when(F.col("dangling"), "unknown reference"), F.when(is_call & F.col("level").isNull() & F.col("call_id").isNotNull() & F.col("conv_id").isNotNull(), "circle")]
    errors = F.when(is_call, F.sort_array(F.concat(errors_of(F.col("name"), F.col("arguments"), schemas), F.filter(F.array(*more), lambda e: e.isNotNull()))))
    status = F.when(~is_call, "orphan").when(F.size(errors) > 0, "invalid").when(F.col("result_turn").isNull(), "no result").otherwise("linked")
    record = F.struct(value.alias("arguments"), F.col("call_id").alias("id"), "name", F.col("content").alias("result"))
    return joined.select(
        *KEY, "turn", "name", "result_turn", F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        status.alias("status"), F.array_join(errors, "; ").alias("errors"), "level", F.to_json(record).alias("json"),
    )
