"""Tool-call linking in DataFrame functions only.

Calls (scope, call_id, position, name, arguments, after) and results (scope,
call_id, position, content) are hash-joined by scope and identifier. Arguments
are JSON text and are checked against a schema by name. A call's level is one
more than the highest level of the calls that it comes after; levels are peeled
off in rounds, so calls are in topological order by level, then position. Each
call becomes one line of canonical JSON: keys sorted, no white space.

Defined results: of calls with one scope and identifier the first by position,
then name and arguments, counts, and n_calls tells how many there were; likewise
for results; a call without result has a null one; results without call are left
out of the links and counted by orphans(); an identifier in after that names no
call of the scope is ignored; calls on or behind a cycle have no level; an
unknown name, arguments that are no JSON object, a missing required key, a key
that the schema does not name, a wrong type or an empty required string are
invalid; null scopes or identifiers take no part; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm import shared

#: A schema: JSON type by key, and the required keys.
Schema = dict[str, dict[str, str] | list[str]]
#: Variant types that stand for a JSON type.
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",)}


def valid(name: Column, arguments: Column, schemas: dict[str, Schema]) -> Column:
    """Whether arguments fulfil the schema of the name."""
    out = F.lit(False)
    parsed, keys = F.try_parse_json(arguments), F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    for known, schema in schemas.items():
        properties, required = schema["properties"], schema["required"]
        ok = F.startswith(F.ltrim(arguments), F.lit("{")) & parsed.isNotNull()
        ok = ok & (F.size(F.array_except(keys, F.array(*map(F.lit, properties)))) == 0)
        ok = ok & (F.size(F.array_except(F.array(*map(F.lit, required)), keys)) == 0) if required else ok
        for key, kind in properties.items():
            value = F.try_variant_get(parsed, f"$.{key}", "variant")
            typed = F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0).isin(*TYPES[kind])
            ok = ok & (~F.array_contains(keys, key) | F.coalesce(typed, F.lit(False)))
            if kind == "string" and key in required:
                ok = ok & (F.coalesce(F.get_json_object(arguments, f"$.{key}"), F.lit("")) != "")
        out = F.when(name == known, F.coalesce(ok, F.lit(False))).otherwise(out)
    return out


def _first(rows: DataFrame, by: tuple[str, ...], count: str) -> DataFrame:
    """The first row of each scope and call_id, and how many there are."""
    rows = rows.where("scope is not null and call_id is not null")
    others = [c for c in rows.columns if c not in ("scope", "call_id", *by)]
    first = F.min(F.struct(*by, *others)).alias("first")
    return rows.groupBy("scope", "call_id").agg(first, F.count("*").alias(count)).select("scope", "call_id", "first.*", count)


def levels(calls: DataFrame) -> DataFrame:
    """(scope, call_id, level) of the calls that no cycle holds back; calls must be distinct by scope and call_id.

    Chains of calls that come after one other call are followed by pointer
    doubling, in as many rounds as the logarithm of their length; only calls that
    come after several are peeled level by level.
    """
    nodes, key = calls.select("scope", "call_id"), ["scope", "call_id"]
    edges = calls.select(*key, F.explode(F.array_distinct("after")).alias("dep"))
    edges, _ = shared.stored(edges.join(nodes.withColumnRenamed("call_id", "dep"), ["scope", "dep"], "left_semi"), "calls-edges")
    degree = edges.groupBy(*key).agg(F.count("*").alias("n"), F.min("dep").alias("dep"))
    chain = degree.where("n = 1").select(*key, F.col("dep").alias("anchor"), F.lit(1).cast("long").alias("off"))
    chain, path = shared.stored(chain.withColumn("on", F.lit(True)), "calls-chain")
    for _ in range(chain.count().bit_length() + 1):
        ahead = chain.select("scope", F.col("call_id").alias("anchor"), F.col("anchor").alias("next"), F.col("off").alias("more"))
        moved = chain.join(ahead, ["scope", "anchor"], "left").select(
            *key, F.coalesce("next", "anchor").alias("anchor"), (F.col("off") + F.coalesce("more", F.lit(0))).alias("off"), F.col("next").isNotNull().alias("on")
        )
        moved, new = shared.stored(moved, "calls-chain")
        shared.forget(calls.sparkSession, path)
        chain, path = moved, new
        if chain.where("on").isEmpty():
            break
    chain = chain.where("not on").drop("on")
    known = nodes.join(edges, key, "left_anti").withColumn("level", F.lit(0).cast("long"))
    several = edges.join(degree.where("n > 1").select(*key), key, "left_semi")
    ends = chain.select("scope", F.col("call_id").alias("dep"), "anchor", "off")
    several = several.join(ends, ["scope", "dep"], "left").select(*key, F.coalesce("anchor", "dep").alias("anchor"), F.coalesce("off", F.lit(0)).alias("off"))
    several, _ = shared.stored(several, "calls-several")
    while not several.isEmpty():
        at = known.select("scope", F.col("call_id").alias("anchor"), "level")
        seen = several.join(at, ["scope", "anchor"], "left").groupBy(*key)
        ready = seen.agg(F.bool_and(F.col("level").isNotNull()).alias("all"), (F.max(F.col("level") + F.col("off")) + 1).alias("level")).where("all")
        ready, _ = shared.stored(ready.select(*key, "level"), "calls-ready")
        if ready.isEmpty():
            break
        known = known.unionByName(ready)
        several, _ = shared.stored(several.join(ready, key, "left_anti"), "calls-several")
    at = known.select("scope", F.col("call_id").alias("anchor"), "level")
    return known.unionByName(chain.join(at, ["scope", "anchor"]).select(*key, (F.col("level") + F.col("off")).alias("level")))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """(scope, call_id, position, level, valid, linked, n_calls, n_results, json): a row per distinct call."""
    calls, _ = shared.stored(_first(calls.select("scope", "call_id", "position", "name", "arguments", "after"), ("position", "name", "arguments"), "n_calls"), "calls")
    found = _first(results.select("scope", "call_id", "position", "content"), ("position", "content"), "n_results").drop("position")
    joined = calls.join(levels(calls), ["scope", "call_id"], "left").join(found.hint("shuffle_hash"), ["scope", "call_id"], "left")
    ok = valid(F.col("name"), F.col("arguments"), schemas)
    # variants hold the keys of objects in order, so their text is canonical
    arguments = F.coalesce(F.to_json(F.try_parse_json("arguments")), F.to_json(F.struct("arguments")))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    text = F.concat(
        F.lit('{"arguments":'), arguments, F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"level":'), F.coalesce(F.col("level").cast("string"), F.lit("null")),
        F.lit(',"name":'), quoted(F.col("name")), F.lit(',"result":'), F.when(F.col("n_results").isNull(), F.lit("null")).otherwise(quoted(F.col("content"))), F.lit("}"),
    )
    return joined.select(
        "scope", "call_id", "position", "level", ok.alias("valid"), F.col("n_results").isNotNull().alias("linked"), "n_calls",
        F.coalesce("n_results", F.lit(0)).alias("n_results"), text.alias("json"),
    )


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(scope, n): results whose identifier names no call."""
    named = results.where("scope is not null and call_id is not null")
    return named.join(calls, ["scope", "call_id"], "left_anti").groupBy("scope").agg(F.count("*").alias("n"))


#: Turns as calls: users ask, system turns configure; the next turn of the assistant is the result.
SCHEMAS: dict[str, Schema] = {
    "ask": {"properties": {"prompt": "string", "turn": "integer"}, "required": ["prompt", "turn"]},
    "configure": {"properties": {"prompt": "string", "turn": "integer"}, "required": ["turn"]},
}


def of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of conversations: identifiers are conv_id.turn, an ask comes after the one two turns before."""
    turns = turns.select(F.col("conv_id").alias("scope"), F.col("turn").alias("position"), "role", F.coalesce("text", F.lit("")).alias("text"))
    name = lambda shift: F.concat_ws(".", F.col("scope").cast("string"), (F.col("position") - shift).cast("string"))
    asked = turns.where("role in ('user', 'system') and position is not null").select(
        "scope", name(0).alias("call_id"), "position", F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), F.col("position").alias("turn"))).alias("arguments"), F.array(name(2)).alias("after"),
    )
    given = turns.where("role = 'assistant' and position is not null").select("scope", name(1).alias("call_id"), "position", F.col("text").alias("content"))
    return asked, given


def op4_tool_calls(spark, sf_dir: str) -> DataFrame:
    asked, given = of_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    done = link(asked, given, SCHEMAS)
    return done.select(F.col("scope").alias("conv_id"), "call_id", F.col("position").alias("turn"), "level", "valid", "linked", "n_calls", "n_results", "json")


OP4_SQL = """
with recursive turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations where conv_id is not null and turn is not null
), asked as (
  select conv_id, turn, case when role = 'user' then 'ask' else 'configure' end as name,
         '{"prompt":' || to_json(text) || ',"turn":' || turn || '}' as arguments, text
  from turns where role in ('user', 'system')
), calls as (
  select conv_id, turn, count(*) as n_calls, min(struct_pack(name := name, arguments := arguments, text := text)) as f
  from asked group by conv_id, turn
), given as (
  select conv_id, turn - 1 as turn, count(*) as n_results, min(text) as content from turns where role = 'assistant' group by conv_id, turn
), leveled as (
  select conv_id, turn, 0 as level from calls c
  where not exists (select 1 from calls d where d.conv_id = c.conv_id and d.turn = c.turn - 2)
  union all
  select c.conv_id, c.turn, l.level + 1 from leveled l join calls c on c.conv_id = l.conv_id and c.turn = l.turn + 2
)
select c.conv_id, c.conv_id || '.' || c.turn as call_id, c.turn, l.level,
       c.f.name = 'configure' or c.f.text <> '' as valid, g.n_results is not null as linked,
       c.n_calls, coalesce(g.n_results, 0) as n_results,
       '{"arguments":' || c.f.arguments || ',"id":"' || c.conv_id || '.' || c.turn || '","level":' || l.level
         || ',"name":"' || c.f.name || '","result":' || case when g.n_results is null then 'null' else to_json(g.content) end || '}' as json
from calls c join leveled l using (conv_id, turn) left join given g using (conv_id, turn)
"""
