"""Chat formatting: tool-call linking.

Assistant messages carry tool calls, tool messages carry results.  Both are
unpacked, joined by (conversation, call id), and put in topological order: a
string argument ``$call:<id>`` names another call of the conversation, whose
result it needs.  Levels are found over all conversations at once, chains by
pointer doubling, the rest by peeling; what never gets free waits in a cycle.  Arguments are validated against the tool's schema and every call is
serialised as canonical JSON.  No conversation is ever gathered in one place.

Cases: of calls with one id the first by turn is linked, later ones are
``repeated`` (equal rows are alike); of several results the first by turn
counts; a call without result is ``no_result``, a result without call
``no_call`` with no level; a reference to no call is an error and waits for
nothing; null ids link with nothing but are reported; null and malformed
payloads give no calls, malformed arguments are an error; a null conversation
id is a conversation of its own; extra columns are not read, empty tables give
empty results.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import re
from collections.abc import Callable, Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import scratch_path
from .common import spark_struct, structs, table
from .components import saved

REFERENCE = "$call:"
CALLS_TYPE = "array<struct<id:string,function:struct<name:string,arguments:string>>>"
CHECKED = pa.struct([("arguments", pa.string()), ("errors", pa.string()), ("needs", pa.list_(pa.string()))])

#: Tools of the query below, as JSON Schema.
SCHEMAS = {
    "reply": {"type": "object", "required": ["question", "words"], "additionalProperties": False,
              "properties": {"question": {"type": "string", "minLength": 1}, "after": {"type": "string"},
                             "words": {"type": "integer", "minimum": 1, "maximum": 20}}},
    "elaborate": {"type": "object", "required": ["question", "words"], "additionalProperties": False,
                  "properties": {"question": {"type": "string", "minLength": 200}, "after": {"type": "string"},
                                 "words": {"type": "integer", "minimum": 30}}},
}


# --- canonical JSON ------------------------------------------------------

def number_text(value: int | float) -> str:
    """A number's shortest decimal form, the same for equal numbers: digits
    from 1e-6 up to 1e21, else one exponent form; integers that no double holds
    keep all their digits."""
    if isinstance(value, int) and (abs(value) < 10 ** 21 or abs(value) > 10 ** 308 or int(float(value)) != value):
        return str(value)
    if value == 0:
        return "0"
    sign, found, exponent = Decimal(repr(float(value))).normalize().as_tuple()
    digits = "".join(map(str, found))
    point = len(digits) + exponent  # where the decimal point stands
    if len(digits) <= point <= 21:
        text = digits + "0" * (point - len(digits))
    elif 0 < point <= 21:
        text = f"{digits[:point]}.{digits[point:]}"
    elif -6 < point <= 0:
        text = f"0.{'0' * -point}{digits}"
    else:
        rest = f".{digits[1:]}" if len(digits) > 1 else ""
        text = f"{digits[0]}{rest}e{point - 1:+d}"
    return "-" * sign + text


def canonical(value) -> str:
    """Keys sorted by UTF-16 code units, no white space, ``number_text``, text as it is."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return number_text(value)
    return json.dumps(value, ensure_ascii=False)


def strict(text: str):
    """Parse JSON; repeated keys and non-finite numbers are errors."""
    def pairs(found):
        out = dict(found)
        if len(out) != len(found):
            raise ValueError("repeated key")
        return out

    def number(raw: str) -> float:
        value = float(raw)
        if not math.isfinite(value):
            raise ValueError("number out of range")
        return value

    return json.loads(text, object_pairs_hook=pairs, parse_float=number,
                      parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))


# --- schemas -------------------------------------------------------------

_IS = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list), "null": lambda v: v is None,
    "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
}


#: Keywords that say nothing about whether a value is valid.
_NOTES = {"$schema", "$id", "$defs", "definitions", "title", "description", "default", "examples", "format", "deprecated", "readOnly", "writeOnly"}
_RULES = {"type", "enum", "const", "required", "properties", "additionalProperties", "patternProperties", "items", "minimum", "maximum",
          "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "minLength", "maxLength", "pattern", "minItems", "maxItems",
          "uniqueItems", "minProperties", "maxProperties", "allOf", "anyOf", "oneOf", "not", "$ref"}


def check_schema(schema: dict | bool, root: dict | bool | None = None) -> None:
    """Raise for a schema with a keyword or reference that ``violations`` does not know."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return
    unknown = set(schema) - _RULES - _NOTES
    if unknown:
        raise ValueError(f"schema keywords {sorted(unknown)} are not supported")
    if "$ref" in schema:
        _target(schema["$ref"], root)
    inner = [*schema.get("allOf", []), *schema.get("anyOf", []), *schema.get("oneOf", [])]
    for k in ("properties", "patternProperties", "$defs", "definitions"):
        inner += schema.get(k, {}).values()
    for s in inner + [schema[k] for k in ("items", "additionalProperties", "not") if k in schema]:
        check_schema(s, root)


def _target(ref: str, root):
    """The schema at a reference inside ``root`` (``#`` and a JSON pointer)."""
    if not ref.startswith("#"):
        raise ValueError(f"reference {ref!r} leaves the schema")
    at = root
    for part in ref[1:].split("/")[1:]:
        part = part.replace("~1", "/").replace("~0", "~")
        try:
            at = at[int(part)] if isinstance(at, list) else at[part]
        except (KeyError, IndexError, ValueError, TypeError):
            raise ValueError(f"reference {ref!r} leads nowhere") from None
    return at


def _multiple(value, step) -> bool:
    return Decimal(repr(value)) % Decimal(repr(step)) == 0


def violations(value, schema: dict | bool, path: str = "", root: dict | bool | None = None) -> list[str]:
    """``path: rule`` for each broken rule of the schema.  Equal values are those
    with one canonical text, so ``true`` is not ``1``."""
    root = schema if root is None else root
    at, out = path or "/", []
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: unknown"]
    broken = lambda s: violations(value, s, path, root)

    def rule(name: str, holds: Callable[[], bool]) -> None:
        if name in schema and not holds():
            out.append(f"{at}: {name}")

    kinds = schema.get("type")
    if kinds is not None and not any(_IS[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    if "$ref" in schema:
        out += broken(_target(schema["$ref"], root))
    rule("enum", lambda: canonical(value) in map(canonical, schema["enum"]))
    rule("const", lambda: canonical(value) == canonical(schema["const"]))
    for s in schema.get("allOf", []):
        out += broken(s)
    rule("anyOf", lambda: any(not broken(s) for s in schema["anyOf"]))
    rule("oneOf", lambda: sum(not broken(s) for s in schema["oneOf"]) == 1)
    rule("not", lambda: bool(broken(schema["not"])))
    if _IS["number"](value):
        rule("minimum", lambda: value >= schema["minimum"])
        rule("maximum", lambda: value <= schema["maximum"])
        rule("exclusiveMinimum", lambda: value > schema["exclusiveMinimum"])
        rule("exclusiveMaximum", lambda: value < schema["exclusiveMaximum"])
        rule("multipleOf", lambda: _multiple(value, schema["multipleOf"]))
    if isinstance(value, str):
        rule("minLength", lambda: len(value) >= schema["minLength"])
        rule("maxLength", lambda: len(value) <= schema["maxLength"])
        rule("pattern", lambda: re.search(schema["pattern"], value) is not None)
    if isinstance(value, list):
        rule("minItems", lambda: len(value) >= schema["minItems"])
        rule("maxItems", lambda: len(value) <= schema["maxItems"])
        rule("uniqueItems", lambda: not schema["uniqueItems"] or len(set(map(canonical, value))) == len(value))
        for i, v in enumerate(value):
            out += violations(v, schema.get("items", True), f"{path}/{i}", root)
    if isinstance(value, dict):
        rule("minProperties", lambda: len(value) >= schema["minProperties"])
        rule("maxProperties", lambda: len(value) <= schema["maxProperties"])
        out += [f"{path}/{k}: required" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            held = [schema["properties"][k]] if k in schema.get("properties", {}) else []
            held += [s for p, s in schema.get("patternProperties", {}).items() if re.search(p, k)]
            for s in held or [schema.get("additionalProperties", True)]:
                out += violations(value[k], s, f"{path}/{k}", root)
    return out


def references(value) -> list[str]:
    if isinstance(value, str):
        return [value[len(REFERENCE):]] if value.startswith(REFERENCE) else []
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return [r for v in inner for r in references(v)]


def check_arguments(name: str | None, raw: str | None, schemas: dict[str, dict]) -> tuple:
    """(canonical arguments or null, errors, ids of the calls it needs)."""
    try:
        value = strict(raw or "")
        text = canonical(value)
    except (ValueError, RecursionError):
        return None, "/: not JSON", []
    found = violations(value, schemas[name]) if name in schemas else ["/: unknown tool"]
    return text, "; ".join(found), sorted(set(references(value)))


# --- operator ------------------------------------------------------------

def unpack(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of messages (conv_id, turn, role, tool_calls, tool_call_id, content)."""
    call = F.explode(F.from_json("tool_calls", CALLS_TYPE))
    calls = (messages.filter("role = 'assistant'").select("conv_id", "turn", call.alias("c"))
             .select("conv_id", "turn", F.col("c.id").alias("call_id"), F.col("c.function.name").alias("name"),
                     F.col("c.function.arguments").alias("raw")))
    results = messages.filter("role = 'tool'").select("conv_id", "turn", F.col("tool_call_id").alias("call_id"), "content")
    return calls, results


def _on(condition: str):
    return F.expr(f"l.conv_id <=> r.conv_id and {condition}")


def _mark(left: DataFrame, calls: DataFrame, column: str = "call_id") -> DataFrame:
    """``left`` with ``met``: is (conv_id, ``column``) one of ``calls``?"""
    known = calls.select("conv_id", "call_id", F.lit(True).alias("met"))
    marked = left.alias("l").join(known.alias("r"), _on(f"l.{column} = r.call_id"), "left")
    return marked.select("l.*", F.coalesce("r.met", F.lit(False)).alias("met"))


def chains(single: DataFrame, calls: int, path: str) -> DataFrame:
    """Calls with one need each (conv_id, call_id, up): the first call above
    them that has no or several needs, and the steps to it.  The pointers
    double every round; one that points to a call with one need after more
    steps than there are ``calls`` runs in a cycle and is left out."""
    hops = saved(single.withColumn("steps", F.lit(1)).withColumn("moves", F.lit(True)), f"{path}/hops0")
    for turn in itertools.count(1):
        above = hops.select("conv_id", "call_id", F.col("up").alias("next"), F.col("steps").alias("more"))
        hops = hops.alias("l").join(above.alias("r"), _on("l.up = r.call_id"), "left").select(
            "l.conv_id", "l.call_id", F.coalesce("r.next", "l.up").alias("up"),
            (F.col("l.steps") + F.coalesce("r.more", F.lit(0))).alias("steps"), F.col("r.next").isNotNull().alias("moves"))
        hops = saved(hops, f"{path}/hops{turn}")
        if hops.filter("moves").isEmpty():
            return hops.drop("moves")
        if 2 ** turn > calls:
            return _mark(hops.drop("moves"), single, "up").filter("not met").drop("met")


def levels(needs: DataFrame, path: str) -> DataFrame:
    """(conv_id, call_id, level) of the calls in ``needs`` (conv_id, call_id,
    needed, distinct) that get free: one more than the highest level they need.

    Chains of single needs take a logarithm of their length in rounds; calls
    with several needs take one round per such call on the longest path."""
    counted = saved(needs.join(needs.groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("k"))
                               .select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "k"),
                               F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i"))).drop("c", "i"),
                    f"{path}/counted")
    single = counted.filter("k = 1").select("conv_id", "call_id", F.col("needed").alias("up"))
    hops = chains(single, counted.count() + 1, path)
    who = counted.select("conv_id", "call_id").distinct()

    # Several needs: each leads, through its chain, to a call without need or to another of them.
    several = counted.filter("k > 1").alias("l").join(hops.alias("r"), _on("l.needed = r.call_id"), "left").select(
        "l.conv_id", "l.call_id", F.coalesce("r.up", "l.needed").alias("up"), (F.coalesce("r.steps", F.lit(0)) + 1).alias("steps"))
    waiting = _mark(several, who, "up").withColumn("reached", F.when(~F.col("met"), F.col("steps"))).drop("met")
    found = who.select("*", F.lit(0).alias("level")).filter(F.lit(False))
    for turn in itertools.count():
        waiting = saved(waiting, f"{path}/waiting{turn}")
        free = waiting.groupBy("conv_id", "call_id").agg(F.max("reached").alias("level"), F.every(F.col("reached").isNotNull()).alias("free"))
        free = free.filter("free").drop("free").alias("l").join(found.alias("r"), _on("l.call_id = r.call_id"), "left_anti")
        free = saved(free, f"{path}/level{turn}")
        if free.isEmpty():
            break
        found = found.unionAll(free)
        waiting = waiting.alias("l").join(free.alias("r"), _on("l.up = r.call_id"), "left").select(
            "l.conv_id", "l.call_id", "l.up", "l.steps", F.coalesce("l.reached", F.col("r.level") + F.col("l.steps")).alias("reached"))

    ends = _mark(hops, who, "up").alias("l").join(found.alias("r"), _on("l.up = r.call_id"), "left")
    level = F.when(~F.col("l.met"), F.col("l.steps")).otherwise(F.col("r.level") + F.col("l.steps"))
    return ends.select("l.conv_id", "l.call_id", level.alias("level")).filter("level is not null").unionAll(found)


@F.arrow_udf(StringType())
def _record(arguments: pa.Array, call_id: pa.Array, name: pa.Array, result: pa.Array) -> pa.Array:
    """The canonical JSON of a call; ``arguments`` are canonical JSON already."""
    columns = zip(*(c.to_pylist() for c in (arguments, call_id, name, result)))
    return pa.array([f'{{"arguments":{a or "null"},"id":{canonical(i)},"name":{canonical(n)},"result":{canonical(r)}}}'
                     for a, i, n, r in columns], pa.string())


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call and per result without call: status, level, validity,
    errors and the call as canonical JSON.  (conv_id, level, turn, call_id)
    sorts every conversation topologically."""
    for schema in schemas.values():
        check_schema(schema)
    path = scratch_path(messages.sparkSession, "toolcalls")

    @F.arrow_udf(spark_struct(CHECKED))
    def checked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for names, raws in batches:
            yield structs([check_arguments(n, r, schemas) for n, r in zip(names.to_pylist(), raws.to_pylist())], CHECKED)

    calls, results = unpack(messages)
    calls = calls.withColumn("c", checked("name", "raw")).select("conv_id", "turn", "call_id", "name", "c.*")
    calls = saved(calls, f"{path}/calls")
    known = calls.select("conv_id", "call_id").filter("call_id is not null").distinct()
    needs = calls.filter("call_id is not null").select("conv_id", "call_id", F.explode("needs").alias("needed")).distinct()
    needs = saved(_mark(needs, known, "needed"), f"{path}/needs")
    met = needs.filter("met").drop("met")

    # What is known of each (conversation, id), from all sides, in one aggregate.
    sides = {"first": (calls, F.col("turn")), "answer": (results, F.struct("turn", "content")),
             "missing": (needs.filter("not met"), F.concat(F.lit("no call "), "needed")),
             "waits": (met, F.lit(True)), "level": (levels(met, path), F.col("level"))}
    parts = [rows.select("conv_id", "call_id", value.alias(name)) for name, (rows, value) in sides.items()]
    facts = functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    facts = facts.groupBy("conv_id", "call_id").agg(
        F.min("first").alias("first"), F.min("answer").alias("answer"), F.max("waits").alias("waits"), F.max("level").alias("level"),
        F.array_join(F.sort_array(F.collect_set("missing")), "; ").alias("missing"))
    rows = calls.alias("l").join(facts.alias("r"), _on("l.call_id = r.call_id"), "left")
    rows = rows.select("l.*", "r.first", "r.answer", "r.waits", "r.level", F.nullif("r.missing", F.lit("")).alias("missing"))
    later = F.coalesce(F.col("turn") != F.col("first"), F.lit(False))
    status = F.when(later, "repeated").when(F.col("answer").isNull(), "no_result").otherwise("linked")
    errors = F.concat_ws("; ", F.when(F.col("errors") != "", F.col("errors")), "missing",
                         F.when(F.col("waits") & F.col("level").isNull(), F.lit("cycle")))
    linked = rows.select(
        "conv_id", "turn", "call_id", "name", status.alias("status"),
        F.when(F.col("waits").isNull(), F.lit(0)).otherwise(F.col("level")).alias("level"),
        (errors == "").alias("valid"), errors.alias("errors"),
        _record("arguments", "call_id", "name", F.when(~later, F.col("answer.content"))).alias("json"))
    nothing = F.lit(None).cast("string")
    alone = _mark(results, known).filter("not met").select(
        "conv_id", "turn", "call_id", nothing.alias("name"), F.lit("no_call").alias("status"),
        F.lit(None).cast("int").alias("level"), F.lit(False).alias("valid"), F.lit("no call").alias("errors"),
        _record(nothing, "call_id", nothing, "content").alias("json"))
    return linked.unionAll(alone)


# --- query ---------------------------------------------------------------

def conversation_messages(conversations: DataFrame) -> DataFrame:
    """The conversations as tool traffic: a user's turn becomes a call that
    needs the user's turn before it, the assistant's next turn its result."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    before = F.when(F.col("turn") >= 2, F.concat(F.lit(REFERENCE + "c"), (F.col("turn") - 2).cast("string")))
    arguments = F.to_json(F.struct(F.col("text").alias("question"), words.alias("words"), before.alias("after")))
    name = F.when(words <= 25, "reply").otherwise("elaborate")
    call = F.struct(F.concat(F.lit("c"), F.col("turn").cast("string")).alias("id"),
                    F.struct(name.alias("name"), arguments.alias("arguments")).alias("function"))
    role = F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role"))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), F.when(F.col("role") == "user", F.to_json(F.array(call))).alias("tool_calls"),
        F.when(F.col("role") == "assistant", F.concat(F.lit("c"), (F.col("turn") - 1).cast("string"))).alias("tool_call_id"),
        F.when(F.col("role") == "assistant", F.col("text")).alias("content"))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_tool_calls(conversation_messages(table(spark, sf_dir, "conversations")), SCHEMAS)


TOOL_CALLS_SQL = """
with recursive users as (
  select conv_id, turn, text as question, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words
  from conversations where role = 'user'),
answers as (select conv_id, turn - 1 as turn, turn as answered, text from conversations where role = 'assistant'),
chain(conv_id, turn, level) as (
  select u.conv_id, u.turn, 0 from users u left join users p on p.conv_id = u.conv_id and p.turn = u.turn - 2 where p.turn is null
  union all
  select u.conv_id, u.turn, c.level + 1 from chain c join users u on u.conv_id = c.conv_id and u.turn = c.turn + 2),
calls as (
  select u.*, c.level, a.text as result, a.answered,
         case when words <= 25 then 'reply' else 'elaborate' end as name,
         concat_ws('; ', case when words > 25 and length(question) < 200 then '/question: minLength'
                              when words <= 25 and length(question) < 1 then '/question: minLength' end,
                   case when words < 1 then '/words: minimum' when words between 21 and 25 then '/words: maximum'
                        when words between 26 and 29 then '/words: minimum' end,
                   case when u.turn >= 2 and c.level = 0 then 'no call c' || (u.turn - 2) end) as errors
  from users u join chain c on c.conv_id = u.conv_id and c.turn = u.turn
  left join answers a on a.conv_id = u.conv_id and a.turn = u.turn)
select conv_id, turn, 'c' || turn as call_id, name, case when answered is null then 'no_result' else 'linked' end as status,
       level::integer as level, errors = '' as valid, errors,
       '{"arguments":{' || case when turn >= 2 then '"after":"$call:c' || (turn - 2) || '",' else '' end ||
       '"question":' || to_json(question)::varchar || ',"words":' || words || '},"id":"c' || turn || '","name":"' || name ||
       '","result":' || case when answered is null then 'null' else to_json(result)::varchar end || '}' as json
from calls
union all
select a.conv_id, a.answered, 'c' || a.turn, null, 'no_call', null, false, 'no call',
       '{"arguments":null,"id":"c' || a.turn || '","name":null,"result":' || to_json(a.text)::varchar || '}'
from answers a left join users u on u.conv_id = a.conv_id and u.turn = a.turn where u.turn is null
"""
