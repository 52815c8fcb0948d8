"""Tool calls of chats: linked to their results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on conversation and identifier. Calls that use the result of
another call name it in their arguments; levels follow from that graph by joins alone, so that no
conversation has to fit into one task. Chains are shortened by pointer doubling, so that a chain of
n calls takes log n rounds; only calls with several references wait for each other round by round.
Arguments are checked against the schema of their tool.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import table, written
from odsflow.sinks.paths import scratch

#: Tools of the query and the schemas of their arguments.
SCHEMAS = {
    "search": {
        "type": "object",
        "properties": {
            "query": {"type": "string", "minLength": 1},
            "limit": {"type": "integer", "minimum": 1, "maximum": 60},
            "after": {"type": "object", "properties": {"$ref": {"type": "string"}}, "required": ["$ref"]},
        },
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "translate": {
        "type": "object",
        "properties": {
            "text": {"type": "string", "maxLength": 4000},
            "to": {"enum": ["de", "en", "es"]},
            "after": {"type": "object", "properties": {"$ref": {"type": "string"}}, "required": ["$ref"]},
        },
        "required": ["text", "to"],
        "additionalProperties": False,
    },
}

_TYPES = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "null": type(None),
}


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or (isinstance(value, float) and (kind == "number" or value.is_integer()))
        return whole and not isinstance(value, bool)
    return isinstance(value, _TYPES[kind])


def errors(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a value under a JSON schema (types, required and further properties, enum,
    bounds, lengths, patterns and items), as ``path: rule``."""
    out = []
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    if "enum" in schema and not any(type(value) is type(e) and value == e for e in schema["enum"]):
        out.append(f"{at}: enum")
    if _is(value, "number"):
        out += [f"{at}: minimum"] if value < schema.get("minimum", -math.inf) else []
        out += [f"{at}: maximum"] if value > schema.get("maximum", math.inf) else []
    if isinstance(value, str):
        out += [f"{at}: minLength"] if len(value) < schema.get("minLength", 0) else []
        out += [f"{at}: maxLength"] if len(value) > schema.get("maxLength", math.inf) else []
        out += [f"{at}: pattern"] if not re.search(schema.get("pattern", ""), value) else []
    if isinstance(value, list):
        out += [f"{at}: minItems"] if len(value) < schema.get("minItems", 0) else []
        out += [f"{at}: maxItems"] if len(value) > schema.get("maxItems", math.inf) else []
        for i, item in enumerate(value):
            out += errors(item, schema.get("items", {}), f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{name}: required" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in known:
                out += errors(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{name}: additionalProperties")
            elif isinstance(schema.get("additionalProperties"), dict):
                out += errors(value[name], schema["additionalProperties"], f"{at}.{name}")
    return out


def _number(value: float) -> str:
    """A double as ECMAScript writes it: shortest digits, exponents from 1e21 and below 1e-6 only."""
    if not math.isfinite(value):
        raise ValueError("not a JSON number")
    _, digits, exponent = Decimal(repr(abs(value))).normalize().as_tuple()
    text, sign = "".join(map(str, digits)), "-" if value < 0 else ""
    point = len(text) + exponent
    if value == 0:
        return "0"
    if len(text) <= point <= 21:
        return sign + text.ljust(point, "0")
    if 0 < point <= 21:
        return f"{sign}{text[:point]}.{text[point:]}"
    if -6 < point <= 0:
        return f"{sign}0.{'0' * -point}{text}"
    rest = f".{text[1:]}" if text[1:] else ""
    return f"{sign}{text[0]}{rest}e{point - 1:+d}"


def canonical(value) -> str:
    """JSON in canonical form (RFC 8785): keys sorted by UTF-16 units, no blanks, doubles as ECMAScript
    writes them, only controls, quotes and backslashes escaped. Integers stay exact at any size."""
    if isinstance(value, dict):
        names = sorted(value, key=lambda name: name.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(name)}:{canonical(value[name])}" for name in names) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    return _number(value) if isinstance(value, float) else json.dumps(value, ensure_ascii=False)


def references(value) -> set[str]:
    """Identifiers that a value names as ``{"$ref": id}``."""
    if isinstance(value, dict):
        own = {value["$ref"]} if isinstance(value.get("$ref"), str) else set()
        return own.union(*map(references, value.values()))
    return set().union(*map(references, value)) if isinstance(value, list) else set()


def _refuse(name: str):
    raise ValueError(name)


def _checked(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls`` with ``problems``, ``clean`` (canonical arguments; null if they are not JSON) and ``refs``."""
    added = T.StructType(
        [
            T.StructField("problems", T.ArrayType(T.StringType())),
            T.StructField("clean", T.StringType()),
            T.StructField("refs", T.ArrayType(T.StringType())),
        ]
    )
    schema = T.StructType(calls.schema.fields + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            problems, clean, refs = [], [], []
            for name, text in zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist()):
                try:
                    value = json.loads(text or "", parse_constant=_refuse)
                    canonical(value).encode()
                except (ValueError, RecursionError):
                    problems.append(["$: json"])
                    clean.append(None)
                    refs.append([])
                    continue
                problems.append(errors(value, schemas[name]) if name in schemas else ["$: unknown tool"])
                clean.append(canonical(value))
                refs.append(sorted(references(value)))
            strings = pa.list_(pa.string())
            columns = [pa.array(problems, strings), pa.array(clean, pa.string()), pa.array(refs, strings)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added.fieldNames()])

    return calls.mapInArrow(run, schema)


def _chains(single: DataFrame) -> DataFrame:
    """Where the chain of each call with one reference ends: (conv_id, call_id, end, steps).

    ``end`` is the first call on the way that has no reference, or several. Each round a call takes
    over the end and the steps of its end, which doubles its steps. Calls whose chain runs into a
    cycle have no end and are left out.
    """
    key = ["conv_id", "call_id"]
    jumps = written(single.select(*key, F.col("ref").alias("end"), F.lit(1).cast("long").alias("steps")), "chains")
    longest = jumps.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    ends = lambda df: df.select("conv_id", F.col("call_id").alias("end"), F.col("end").alias("next"), F.col("steps").alias("more"))
    # After k rounds an open chain has 2^k steps, so no chain without a cycle is open after these.
    for _ in range(int(longest).bit_length()):
        joined = jumps.join(ends(jumps), ["conv_id", "end"], "left")
        jumps = written(
            joined.select(
                *key, F.coalesce("next", "end").alias("end"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "chains",
        )
        if jumps.where("moved").isEmpty():
            break
        jumps = jumps.drop("moved")
    return jumps.join(ends(jumps), ["conv_id", "end"], "left_anti").select(*key, "end", "steps")


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (conv_id, call_id, level): 0 for calls that refer to no other call, else one more than the
    highest level referred to. Calls on a cycle, and those that refer to one, are left out.

    ``edges`` (conv_id, call_id, ref) are distinct and name calls that exist. A call with one
    reference follows its chain to the end; calls with several wait until the ends of all their
    references are settled, a round for every such call on the longest way.
    """
    key = ["conv_id", "call_id"]
    spark = calls.sparkSession
    degrees = edges.groupBy(*key).agg(F.count("*").alias("n"))
    chains = _chains(edges.join(degrees.where("n = 1"), key, "left_semi"))
    through = chains.select("conv_id", F.col("call_id").alias("ref"), "end", "steps")
    alone = edges.join(degrees.where("n = 1"), key, "left_semi").select("conv_id", F.col("call_id").alias("ref"), F.lit(True).alias("one"))
    several = edges.join(degrees.where("n > 1"), key, "left_semi")
    # A reference that runs into a cycle has no end, and whatever waits for it is never settled.
    several = several.join(alone, ["conv_id", "ref"], "left").join(through, ["conv_id", "ref"], "left")
    waiting = written(
        several.select(
            *key, F.when(F.col("one"), F.col("end")).otherwise(F.col("ref")).alias("end"),
            F.coalesce("steps", F.lit(0)).cast("long").alias("steps"), F.lit(None).cast("long").alias("seen"),
        ),
        "references",
    )
    folder = scratch(spark, "levels")
    shape = T.StructType([*calls.select(*key).schema.fields, T.StructField("level", T.LongType())])

    def keep(df: DataFrame, number: int) -> DataFrame:
        df.write.parquet(f"{folder}/round={number}")
        return spark.read.schema(shape).parquet(f"{folder}/round={number}")

    new = keep(calls.join(degrees, key, "left_anti").select(*key, F.lit(0).cast("long").alias("level")), 0)
    number = 0
    while not waiting.isEmpty() and not new.isEmpty():
        known = new.select("conv_id", F.col("call_id").alias("end"), "level")
        joined = waiting.join(known, ["conv_id", "end"], "left")
        waiting = written(
            joined.select(*key, "end", "steps", F.coalesce(F.col("level") + F.col("steps"), "seen").alias("seen")), "references"
        )
        settled = waiting.groupBy(*key).agg(F.max("seen").alias("high"), F.max(F.col("seen").isNull()).alias("open"))
        number += 1
        new = keep(settled.where(~F.col("open")).select(*key, (F.col("high") + 1).alias("level")), number)
        waiting = waiting.join(new, key, "left_anti")
    ends = spark.read.schema(shape).parquet(folder).select(*key, "level")
    reached = chains.join(ends.select("conv_id", F.col("call_id").alias("end"), "level"), ["conv_id", "end"])
    return ends.union(reached.select(*key, (F.col("level") + F.col("steps")).alias("level")))


def _messages(linked: DataFrame) -> DataFrame:
    """``linked`` with ``clean`` and ``content`` replaced by ``message``, written by ``canonical``."""
    rest = [f for f in linked.schema.fields if f.name not in ("clean", "content")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("clean", "call_id", "name", "content")))
            # Keys in order; arguments are canonical already.
            texts = [
                f'{{"arguments":{clean or "null"},"call_id":{canonical(call)},"name":{canonical(name)},"result":{canonical(content)}}}'
                for clean, call, name, content in rows
            ]
            kept = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*(f.name for f in rest), "message"])

    return linked.mapInArrow(run, T.StructType([*rest, T.StructField("message", T.StringType())]))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call and per result without a call: (conv_id, call_id, name, level, status, problems,
    message).

    ``calls`` has conv_id, call_id, name, arguments (JSON text), ``results`` has conv_id, call_id and
    content; other columns are ignored. Names, arguments and contents may be null (null arguments are
    not JSON). ``status`` is the first that holds of ``no_identifier`` (conv_id or call_id is null:
    each such call and each such result is a row of its own that links nothing), ``duplicate`` (the
    identifier stands for several different calls or results; of these the least arguments and the
    least content are kept), ``invalid`` (see ``problems``), ``dangling`` (refers to a call that is
    not there), ``cycle`` (is on one or leads to one), ``no_result``, ``no_call``, ``ok``. ``message``
    is canonical JSON; ``level`` orders calls so that each comes after those it refers to, null on
    cycles and without identifiers. Repeated rows count once. Empty tables give no rows.
    """
    key = ["conv_id", "call_id"]
    some = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one_call = F.min(F.struct("name", "arguments"))
    named = calls.where(some).select(*key, "name", "arguments").groupBy(*key).agg(
        one_call.alias("call"), (one_call != F.max(F.struct("name", "arguments"))).alias("twice")
    )
    nameless = calls.where(~some).select(*key, "name", "arguments", F.lit(False).alias("twice")).distinct()
    checked = written(_checked(named.select(*key, "call.name", "call.arguments", "twice").union(nameless), schemas), "calls")
    calls = checked.where(some)
    loose = checked.where(~some).select(*key, "name", "problems", "clean", F.lit(None).cast("string").alias("content"))
    unasked = results.where(~some).select(*key, "content").distinct()
    unasked = unasked.select(
        *key, F.lit(None).cast("string").alias("name"), F.lit(None).cast("array<string>").alias("problems"),
        F.lit(None).cast("string").alias("clean"), "content",
    )
    results = results.where(some).select(*key, "content").groupBy(*key).agg(
        F.min("content").alias("content"), (F.count("content") > 0).alias("filled"), (F.min("content") != F.max("content")).alias("many")
    )
    edges = calls.select(*key, F.explode("refs").alias("ref")).distinct()
    ids = calls.select(*key)
    targets = ids.select("conv_id", F.col("call_id").alias("ref"))
    lost = edges.join(targets, ["conv_id", "ref"], "left_anti").select(*key).distinct().withColumn("lost", F.lit(True))
    level = levels(ids, written(edges.join(targets, ["conv_id", "ref"], "left_semi"), "edges"))
    linked = calls.withColumn("called", F.lit(True)).join(results.withColumn("answered", F.lit(True)), key, "full")
    linked = linked.join(lost, key, "left").join(level, key, "left")
    status = (
        F.when(F.coalesce("twice", F.lit(False)) | F.coalesce("many", F.lit(False)), "duplicate")
        .when(F.size("problems") > 0, "invalid")
        .when(F.col("lost"), "dangling")
        .when(F.col("called") & F.col("level").isNull(), "cycle")
        .when(F.col("answered").isNull(), "no_result")
        .when(F.col("called").isNull(), "no_call")
        .otherwise("ok")
    )
    linked = linked.select(*key, "name", "level", status.alias("status"), "problems", "clean", "content")
    apart = loose.union(unasked).select(
        *key, "name", F.lit(None).cast("long").alias("level"), F.lit("no_identifier").alias("status"), "problems", "clean", "content"
    )
    problems = F.array_join(F.coalesce("problems", F.array().cast("array<string>")), "; ").alias("problems")
    return _messages(linked.union(apart).select(*key, "name", "level", "status", problems, "clean", "content"))


def derived_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of chats stand for.

    A user's turn calls a tool, chosen by its text, whose arguments carry the whole text. It refers to
    the call before it, so that chains are as long as chats; if the length of its text is 3 modulo 64,
    it refers to the call after it instead, which makes a cycle or, in the last pair, leads nowhere.
    An assistant's turn is the result of the call in the turn before it.
    """
    text = F.coalesce("text", F.lit(""))
    name = F.when(F.length(text) % 2 == 0, "search").otherwise("translate")
    call_id = lambda turn: F.concat(F.lit("call_"), F.lpad(turn.cast("string"), 10, "0"))
    limit = F.length(text) % 64
    languages = F.element_at(F.array(*[F.lit(x) for x in ("de", "en", "es", "fr")]), (F.floor(F.length(text) / 2) % 4 + 1).cast("int"))
    other = F.when(F.length(text) % 64 == 3, F.col("turn") + 2).when(F.col("turn") >= 2, F.col("turn") - 2)
    after = F.when(other.isNotNull(), F.struct(call_id(other).alias("$ref")))
    arguments = F.when(name == "search", F.to_json(F.struct(text.alias("query"), limit.alias("limit"), after.alias("after")))).otherwise(
        F.to_json(F.struct(text.alias("text"), languages.alias("to"), after.alias("after")))
    )
    calls = turns.where("role = 'user'").select("conv_id", call_id(F.col("turn")).alias("call_id"), name.alias("name"), arguments.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op1_tool_calls(spark, sf_dir: str) -> DataFrame:
    """Calls and results of every row of ``conversations``, linked, ordered and validated."""
    return link_calls(*derived_calls(table(spark, sf_dir, "conversations")), SCHEMAS)
