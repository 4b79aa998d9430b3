"""Chat formatting with linked tool calls.

Calls and results are joined on conversation and identifier. Arguments are checked against the schema of their tool. Within a
conversation calls get a topological order: a call waits for those it depends on. Messages become canonical JSON: sorted keys,
no spaces, plain UTF-8.

The order is (wave, turn): a call is a wave later than a dependency that stands after it, and in no earlier wave than one that
stands before it. Logs list calls mostly in a valid order already, so the waves settle after a round or two of joins on the
identifier; no conversation is ever gathered in one task.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.common import stored

_TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


def canonical(value) -> str:
    """JSON with sorted keys and no spaces; characters are kept, numbers as JSON writes them."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def is_type(value, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, _TYPES.get(kind, object))


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """Where ``value`` breaks a JSON schema: type, enum, const, required, properties, additionalProperties, items, and the
    bounds on numbers, lengths and counts."""
    out = []
    kinds = schema.get("type")
    if kinds is not None and not any(is_type(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{path}: not of type {kinds}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not in enum")
    if "const" in schema and value != schema["const"]:
        out.append(f"{path}: not the constant")
    if is_type(value, "number"):
        limits = (("minimum", value.__lt__), ("maximum", value.__gt__), ("exclusiveMinimum", value.__le__), ("exclusiveMaximum", value.__ge__))
        out += [f"{path}: breaks {k}" for k, broken in limits if k in schema and broken(type(value)(schema[k])) is True]
    for kind, low, high in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems"), (dict, "minProperties", "maxProperties")):
        if isinstance(value, kind):
            out += [f"{path}: breaks {low}"] if len(value) < schema.get(low, 0) else []
            out += [f"{path}: breaks {high}"] if len(value) > schema.get(high, len(value)) else []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}: lacks {k}" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += violations(v, known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}: unknown {k}")
            elif isinstance(schema.get("additionalProperties"), dict):
                out += violations(v, schema["additionalProperties"], f"{path}.{k}")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for i, v in enumerate(value):
            out += violations(v, schema["items"], f"{path}[{i}]")
    return out


def check(text: str | None, schema: dict | None) -> tuple[str | None, list[str]]:
    """(canonical arguments, violations) of one call; arguments that are no JSON stay null."""
    try:
        value = json.loads(text) if text is not None else None
    except ValueError:
        return None, ["$: not JSON"]
    if text is None:
        return None, ["$: missing"]
    return canonical(value), ["$: unknown tool"] if schema is None else violations(value, schema)


def waves(calls: DataFrame) -> DataFrame:
    """``calls`` (conv, id_, pos, deps) with ``wave`` and ``cyclic``, one row for each conversation and identifier, stored.

    Dependencies on unknown calls are no edges. A wave above the number of a conversation's forward edges proves a cycle.
    """
    nodes = calls.select("conv", "id_", "pos")
    edges = calls.select("conv", "id_", "pos", F.explode(F.array_distinct("deps")).alias("dep")).join(
        nodes.select("conv", F.col("id_").alias("dep"), F.col("pos").alias("dep_pos")), ["conv", "dep"]).select(
        "conv", "id_", "dep", (F.col("dep_pos") >= F.col("pos")).cast("long").alias("later"))
    edges = stored(edges, "call-edges")
    most = edges.groupBy("conv").agg(F.sum("later").alias("most_")).where("most_ > 0")
    now = stored(nodes.withColumn("wave", F.lit(0).cast("long")), "call-waves")
    # only conversations with an edge against the order can move
    moving = stored(edges.join(most, "conv"), "call-edges-against")
    while not moving.isEmpty():
        asked = moving.join(now.select("conv", F.col("id_").alias("dep"), F.col("wave").alias("dep_wave")), ["conv", "dep"])
        need = asked.groupBy("conv", "id_").agg(F.max(F.least(F.col("dep_wave") + F.col("later"), F.col("most_") + 1)).alias("need_"))
        then = stored(now.join(need, ["conv", "id_"], "left").withColumn("new_", F.greatest("wave", F.coalesce("need_", "wave"))),
                      "call-waves")
        changed = not then.where("new_ > wave").isEmpty()
        now = then.select("conv", "id_", "pos", F.col("new_").alias("wave"))
        if not changed:
            break
    return now.join(most, "conv", "left").select(
        "conv", "id_", "pos", "wave", (F.col("wave") > F.coalesce("most_", F.lit(0))).alias("cyclic"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call: conv_id, call_id, position, wave, cyclic, n_calls, n_results, missing_deps, errors, valid, message.

    ``calls``: conv_id, call_id, position (long), name, arguments (JSON text), depends_on (array of call ids, may be null).
    ``results``: conv_id, call_id, content. Order by (wave, position) is topological, unless ``cyclic``. Calls that share
    conversation and identifier stay rows of their own (``n_calls`` tells); the first position counts for the order. Of several
    results the smallest content is used (``n_results`` tells); results without a call are dropped. Calls with a null
    conversation or identifier stay, linked to nothing, in wave 0; a null position counts as 0, a null name as an unknown tool.
    ``message`` is canonical JSON with id, name, arguments (null if unreadable) and result (null if there is none). Empty
    tables give no rows. Other columns are ignored.
    """
    calls = calls.select(F.col("conv_id").alias("conv"), F.col("call_id").alias("id_"),
                         F.coalesce(F.col("position").cast("long"), F.lit(0)).alias("pos"), "name", "arguments",
                         F.coalesce("depends_on", F.array().cast("array<string>")).alias("deps"))
    known = calls.where("conv IS NOT NULL AND id_ IS NOT NULL")
    unique = known.groupBy("conv", "id_").agg(F.min("pos").alias("pos"), F.flatten(F.collect_set("deps")).alias("deps"),
                                              F.count("*").alias("n_calls"))
    unique = stored(unique, "calls")
    order = waves(unique.select("conv", "id_", "pos", "deps")).drop("pos")
    met = results.groupBy(F.col("conv_id").alias("conv"), F.col("call_id").alias("id_")).agg(
        F.min("content").alias("content"), F.count("*").alias("n_results"))
    # the dependencies of a call that exist in its conversation
    present = unique.select("conv", "id_", F.explode(F.array_distinct("deps")).alias("dep")).join(
        unique.select("conv", F.col("id_").alias("dep")), ["conv", "dep"]).groupBy("conv", "id_").agg(F.collect_set("dep").alias("there_"))
    facts = unique.select("conv", "id_", "n_calls").join(order, ["conv", "id_"]).join(met, ["conv", "id_"], "left").join(
        present, ["conv", "id_"], "left")
    joined = calls.join(facts, ["conv", "id_"], "left")

    @F.pandas_udf("canonical string, errors array<string>")
    def checked(name: pd.Series, arguments: pd.Series) -> pd.DataFrame:
        rows = [check(a, schemas.get(n)) for n, a in zip(name, arguments, strict=True)]
        return pd.DataFrame(rows, columns=["canonical", "errors"])

    @F.pandas_udf("string")
    def message(call_id: pd.Series, name: pd.Series, arguments: pd.Series, content: pd.Series) -> pd.Series:
        none = {None: None}
        rows = [canonical({"arguments": json.loads(a) if a is not None else None, "id": none.get(i, i), "name": n, "result": c})
                for i, n, a, c in zip(call_id, name, arguments, content, strict=True)]
        return pd.Series(rows, dtype=object)

    done = joined.withColumn("c_", checked("name", "arguments"))
    return done.select(
        F.col("conv").alias("conv_id"), F.col("id_").alias("call_id"), F.col("pos").alias("position"),
        F.coalesce("wave", F.lit(0)).alias("wave"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        F.coalesce("n_calls", F.lit(1)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.size(F.array_except("deps", F.coalesce("there_", F.array().cast("array<string>")))).cast("long").alias("missing_deps"),
        F.col("c_.errors").alias("errors"), (F.size("c_.errors") == 0).alias("valid"),
        message(F.col("id_").cast("string"), "name", "c_.canonical", "content").alias("message"))


ASK = {"type": "object", "required": ["text", "turn"], "additionalProperties": False,
       "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 2000}, "turn": {"type": "integer", "minimum": 0}}}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that stand in a table of turns: a user turn asks, the assistant turn after it answers.

    A question is a call of the tool ``ask`` known by its turn; it depends on the question two turns before.
    """
    ident = lambda turn: F.concat(F.lit("t"), turn.cast("string"))
    asked = turns.where("role = 'user'")
    calls = asked.select(
        "conv_id", ident(F.col("turn")).alias("call_id"), F.col("turn").alias("position"), F.lit("ask").alias("name"),
        F.to_json(F.struct("text", "turn")).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(ident(F.col("turn") - 2))).alias("depends_on"))
    results = turns.where("role = 'assistant'").select("conv_id", ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
