"""Tool calls: validation against the catalogue, results, the turn's response, the last good render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip

#: Tools and their required arguments, in the catalogue's order.
TOOLS = {"insert_element": ["fragment", "rootId"], "modify_element": ["targetId", "attrs"], "remove_element": ["targetId"], "replace_element": ["targetId", "fragment"], "clear": []}
#: A result without error; the texts of invalid_reason() and of a failed render are fixed too.
SUCCESS = "tool execute success"


def invalid_reason(name: Column, keys: Column) -> Column:
    """Why a call is not valid by the catalogue; '' for a valid one. Null values count as given."""
    required = F.create_map(*[x for k, v in TOOLS.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    missing = F.filter(required[name], lambda k: ~F.array_contains(keys, k))
    return (
        F.when(required[name].isNull(), F.concat(F.lit("invalid tool name: "), name))
        .when(F.size(missing) > 0, F.concat(F.lit("missing args for "), name, F.lit(": "), F.array_join(missing, ", ")))
        .when((name == "clear") & (F.size(keys) > 0), F.lit("clear arguments must be {}"))
        .otherwise("")
    )


def compiled(tools: DataFrame) -> DataFrame:
    """One row, rules: what a catalogue (name, parameters: a JSON schema) asks of calls, by name. A schema's required arguments, types of properties and additionalProperties are read; what is left out asks nothing."""
    read = lambda path, kind: F.from_json(F.get_json_object("parameters", path), kind)
    named = lambda schema: F.get_json_object(schema, "$.type")
    types = F.transform_values(F.coalesce(read("$.properties", "map<string,string>"), F.create_map().cast("map<string,string>")), lambda k, v: F.when(named(v).startswith("["), F.from_json(named(v), "array<string>")).otherwise(F.filter(F.array(named(v)), lambda t: t.isNotNull())))
    rule = F.struct(F.coalesce(read("$.required", "array<string>"), F.array().cast("array<string>")).alias("required"), types.alias("types"), F.coalesce(F.get_json_object("parameters", "$.additionalProperties") == "false", F.lit(False)).alias("closed"))
    return tools.select("name", rule.alias("rule")).agg(F.map_from_entries(F.collect_list(F.struct("name", "rule"))).alias("rules"))


def broken_rule(rules: Column, call: Column) -> Column:
    """Why a call (name, keys, kinds) breaks compiled() rules; '' for a valid one. In order: an unknown name, missing arguments, arguments that are not listed, types. A whole number is a number too; arguments without a type take any."""
    name, keys = call["name"], call["keys"]
    rule = rules[name]
    missing = F.filter(rule["required"], lambda k: ~F.array_contains(keys, k))
    extra = F.when(rule["closed"], F.filter(keys, lambda k: ~F.array_contains(F.map_keys(rule["types"]), k))).otherwise(F.array().cast("array<string>"))
    fits = lambda a: F.coalesce((F.size(rule["types"][a["k"]]) == 0) | F.array_contains(rule["types"][a["k"]], a["t"]) | ((a["t"] == "integer") & F.array_contains(rule["types"][a["k"]], "number")), F.lit(True))
    wrong = F.transform(F.filter(F.zip_with(keys, call["kinds"], lambda k, t: F.struct(k.alias("k"), t.alias("t"))), lambda a: ~fits(a)), lambda a: a["k"])
    told = lambda words, ks: F.concat(F.lit(words), name, F.lit(": "), F.array_join(ks, ", "))
    return (
        F.when(rule.isNull(), F.concat(F.lit("invalid tool name: "), name))
        .when(F.size(missing) > 0, told("missing args for ", missing))
        .when((F.size(extra) > 0) & (F.size(rule["types"]) == 0), F.concat(name, F.lit(" arguments must be {}")))
        .when(F.size(extra) > 0, told("unexpected args for ", extra))
        .when(F.size(wrong) > 0, told("wrong types for ", wrong))
        .otherwise("")
    )


def render_path(root: str = "renders", call: Column | str = "call") -> Column:
    """Over task_id, pid, turn and call."""
    return F.format_string(f"{root}/task-%d-pid-%s/rendered-turn-%03d-tool-%02d.png", "task_id", "pid", "turn", call)


def first_render_path(root: str = "renders") -> Column:
    return F.format_string(f"{root}/task-%d-pid-%s/rendered-turn-000.png", "task_id", "pid")


def render_manifest(edits: DataFrame, root: str = "renders") -> DataFrame:
    """task_id, turn, call, session_id, path: where the render of each edit (task_id, pid, turn, call) goes, and that of turn 0, whose call is null."""
    session = F.format_string("task-%d-pid-%s", "task_id", "pid")
    each = edits.select("task_id", "turn", "call", session.alias("session_id"), render_path(root).alias("path"))
    first = edits.select("task_id", "pid").distinct().select("task_id", F.lit(0).alias("turn"), F.lit(None).cast("int").alias("call"), session.alias("session_id"), first_render_path(root).alias("path"))
    return each.unionByName(first)


def with_calls(turns: DataFrame, main_rounds: int | None = None, root: str = "renders", catalogue: DataFrame | None = None) -> DataFrame:
    """turns with ran (call from 0, name, arguments_json, invalid, result, path, before), tool_response and last_render.

    Everything about a turn stays in its row: a call's path is that of its render, '' for an error; before, the latest path
    before it; last_render, the latest up to the turn's end; tool_response, the last error of the turn, else success, '' without calls.
    turns: parsed, with pid, render_ok and first_render, '' where turn 0's render failed; without render_error a failed
    render says no more than that. After main_rounds no tools run. An edit whose target is missing is a success.
    catalogue (name, parameters): tools in place of TOOLS.
    """
    if catalogue is not None:
        turns = turns.join(F.broadcast(compiled(catalogue)))  # one row, as large as the tools' schemas
    error = F.col("render_error") if "render_error" in turns.columns else F.lit("render failed")
    reverted = F.concat(F.lit("Error: "), error, F.lit(". Reverted to previous successful state."))
    result = lambda c: F.when(c["invalid"] != "", F.concat(F.lit("Error: "), c["invalid"])).when(~F.col("render_ok"), reverted).otherwise(SUCCESS)
    latest = lambda calls: F.try_element_at(F.filter(F.transform(calls, lambda c: c["path"]), lambda p: p != ""), F.lit(-1))
    named = F.transform("tool_calls", lambda c, i: F.struct(i.alias("call"), strip(c["name"]).alias("name"), c["arguments_json"].alias("arguments_json"), c["keys"].alias("keys"), c["kinds"].alias("kinds")))
    out = turns.withColumn("ran", F.when(F.col("turn") <= main_rounds, named).otherwise(F.filter(named, lambda c: F.lit(False))) if main_rounds else named)
    out = out.withColumn("ran", F.transform("ran", lambda c: F.struct(c["call"].alias("call"), c["name"].alias("name"), c["arguments_json"].alias("arguments_json"), (invalid_reason(c["name"], c["keys"]) if catalogue is None else broken_rule(F.col("rules"), c)).alias("invalid"))))
    out = out.withColumn("ran", F.transform("ran", lambda c: c.withField("result", result(c))))
    out = out.withColumn("ran", F.transform("ran", lambda c: c.withField("path", F.when(c["result"] == SUCCESS, render_path(root, c["call"])).otherwise(""))))
    out = out.withColumn("own", latest(F.col("ran")))
    past = Window.partitionBy("task_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("before", F.coalesce(F.last("own", ignorenulls=True).over(past), "first_render"))
    out = out.withColumn("ran", F.transform("ran", lambda c: c.withField("before", F.coalesce(latest(F.slice("ran", F.lit(1), c["call"])), F.col("before")))))
    errors = F.filter(F.transform("ran", lambda c: c["result"]), lambda r: r != SUCCESS)
    response = F.when(F.size("ran") == 0, "").otherwise(F.coalesce(F.try_element_at(errors, F.lit(-1)), F.lit(SUCCESS)))
    return out.withColumn("tool_response", response).withColumn("last_render", F.coalesce("own", "before")).drop("own", "before")


def call_rows(turns: DataFrame) -> DataFrame:
    """A row for each call of with_calls(): task_id, turn and what ran holds."""
    return turns.select("task_id", "turn", F.explode("ran").alias("c")).select("task_id", "turn", "c.*")
