"""Tool-call linking: calls meet their results by identifier, are ordered by what they wait for, checked
against schemas, and written as canonical JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, written

_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def problems(value, schema: Mapping, at: str = "$") -> list[str]:
    """Where a value departs from a JSON schema: type, enum, required, properties, additionalProperties, items, and bounds."""
    out: list[str] = []
    kind = schema.get("type")
    if kind:
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        whole = number and (isinstance(value, int) or value.is_integer())
        if not (whole if kind == "integer" else number if kind == "number" else isinstance(value, _KINDS[kind])):
            return [f"{at}: not {kind}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{name}: missing" for name in schema.get("required", ()) if name not in value]
        for name in sorted(value):
            if name in known:
                out += problems(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{name}: not known")
    elif isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += problems(item, schema["items"], f"{at}[{i}]")
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: too long")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{at}: too small")
        if value > schema.get("maximum", value):
            out.append(f"{at}: too large")
    return out


_SURROGATE = re.compile("[\ud800-\udfff]")
#: Levels of lists and objects within each other that arguments may have.
MAX_DEPTH = 200


def escaped(text: str) -> str:
    """Text without lone surrogates, which no encoding takes: each as its JSON escape."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    """JSON with sorted names, no spare space, and characters as they are, but for lone surrogates."""
    try:
        return escaped(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))
    except ValueError:  # some integer is too long for the library
        return _spelled(value)


def _spelled(value) -> str:
    if isinstance(value, dict):
        return "{%s}" % ",".join(f"{canonical(name)}:{_spelled(value[name])}" for name in sorted(value))
    if isinstance(value, list):
        return "[%s]" % ",".join(map(_spelled, value))
    return value.digits if isinstance(value, LongInteger) else escaped(json.dumps(value, ensure_ascii=False, allow_nan=False))


#: Digits that Python turns into a number at once; more are put together by halves.
SHORT_DIGITS = 4000


class LongInteger(int):
    """An integer of any length that remembers its digits, since Python writes out no more than some thousands."""

    digits: str


def _integer(text: str) -> int:
    if len(text) <= SHORT_DIGITS:
        return int(text)

    def value(digits: str) -> int:
        if len(digits) <= SHORT_DIGITS:
            return int(digits)
        k = len(digits) // 2
        return value(digits[:-k]) * 10**k + value(digits[-k:])

    found = LongInteger(-value(text[1:]) if text[0] == "-" else value(text))
    found.digits = text
    return found


def _finite(text: str) -> float:
    value = float(text)
    if value - value != 0:  # infinite: digits that no double holds
        raise ValueError("number out of range")
    return value


def _constant(name: str):
    raise ValueError(f"{name} is not JSON")


#: Brackets, and strings as a whole; one that doesn't end goes on to the end of the text, so nothing is read twice.
_MARKS = re.compile(r'[\[{\]}]|"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?\Z)', re.S)


def parsed(text: str):
    """A JSON value; ValueError for text that is none, has NaN or Infinity or a number beyond a double, or is nested over MAX_DEPTH levels."""
    depth = 0
    for mark in _MARKS.findall(text):
        if mark in ("[", "{"):
            depth += 1
            if depth > MAX_DEPTH:
                raise ValueError("nested too deep")
        elif mark in ("]", "}"):
            depth -= 1
    return json.loads(text, parse_int=_integer, parse_float=_finite, parse_constant=_constant)


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a table of conversation turns (conv_id, turn, role, text).

    A text that is a JSON object with "name" and "arguments" is that call, and a turn of role "tool"
    is the result of its "tool_call_id". Of the others each turn but an assistant's is a call to its
    role, named conversation:turn, that waits for the call two turns before; an assistant's turn is the
    result of the turn before it. Rows without a conversation or a turn number take no part.
    """
    t = turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), "text"
    )
    name_of = lambda n: F.concat_ws(":", F.col("conv_id"), n)
    is_json = F.coalesce(F.col("text").rlike(r"^\s*\{"), F.lit(False))
    field = lambda f: F.when(is_json, F.get_json_object("text", f"$.{f}"))
    t = t.withColumn("_name", field("name")).withColumn("_args", field("arguments"))
    stated = F.col("_name").isNotNull() & F.col("_args").isNotNull()
    tool = F.col("role") == "tool"
    assistant = F.col("role") == "assistant"
    plain = F.to_json(F.struct("turn", "text"), {"ignoreNullFields": "false"})
    calls = t.where(stated | ~(tool | assistant)).select(
        "conv_id",
        F.coalesce(F.when(stated, field("id")), name_of(F.col("turn"))).alias("call_id"),
        F.when(stated, field("after")).otherwise(name_of(F.col("turn") - 2)).alias("after"),
        F.when(stated, F.col("_name")).otherwise(F.col("role")).alias("name"),
        F.when(stated, F.col("_args")).otherwise(plain).alias("arguments"),
    )
    results = t.where(~stated & (tool | assistant)).select(
        "conv_id",
        F.when(tool, F.coalesce(field("tool_call_id"), name_of(F.col("turn") - 1))).otherwise(name_of(F.col("turn") - 1)).alias("call_id"),
        F.col("turn").alias("seq"),
        F.when(tool, F.coalesce(field("content"), F.col("text"))).otherwise(F.col("text")).alias("content"),
    )
    return calls, results


def waits(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, after: one row for each call that a call waits for; of repeated calls, all that any of them waits for.

    `after` is an identifier, a JSON list of identifiers as text, or an array.
    """
    after = F.col("after")
    if calls.schema["after"].dataType.typeName() != "array":
        text = after.cast("string")
        parsed = F.when(text.rlike(r"^\s*\["), F.from_json(text, "array<string>"))
        after = F.coalesce(parsed, F.array(text))
    return calls.select("conv_id", "call_id", F.explode(after).alias("after")).dropna().distinct()


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: calls on the longest way to each; -1 in, or behind, a circle.

    A call that waits for a call that isn't there doesn't wait for it. Lines of calls that wait for one
    other each are followed by doubling up to their head, a call that waits for none or for several:
    after r rounds each call knows its 2^r-th predecessor or its head, so the rounds grow with the
    logarithm of the longest line; what has no head when no line can be longer is in, or behind, a
    circle. The heads that wait for several get their levels in rounds of join and maximum, each taking
    those whose predecessors all have theirs; there are as many rounds as such calls on the longest way.
    """
    key = ["conv_id", "call_id"]
    nodes = written(calls.select(*key).distinct(), "calls")
    edges = written(waits(calls).join(nodes.withColumnRenamed("call_id", "after"), ["conv_id", "after"], "left_semi").select(*key, "after"), "waits")
    ups = edges.groupBy(*key).agg(F.count("*").alias("n"), F.min("after").alias("after"))
    single, several = F.col("n") == 1, F.coalesce(F.col("n") > 1, F.lit(False))
    # a call with a head: up is null, head is set
    now = nodes.join(ups, key, "left").select(
        *key, several.alias("several"), F.when(single, F.col("after")).alias("up"), F.when(single, None).otherwise(F.col("call_id")).alias("head"), F.when(single, 1).otherwise(0).cast("long").alias("level")
    )
    now = written(now, "levels")
    reach, n = 1, now.count()
    while reach <= n and not now.where(F.col("up").isNotNull()).isEmpty():
        above = now.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("further"), F.col("head").alias("top"), F.col("level").alias("more"))
        before = now
        now = written(
            now.join(above, ["conv_id", "up"], "left").select(*key, "several", F.col("further").alias("up"), F.coalesce("head", "top").alias("head"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")),
            "levels",
        )
        dropped(before)
        reach *= 2
    heads = now.where("several").select(*key)
    if heads.isEmpty():
        return now.select(*key, F.when(F.col("head").isNotNull(), F.col("level")).otherwise(-1).alias("level"))
    # what heads wait for, as far as the heads above; base is the level of such a head, once it has one
    above = now.select("conv_id", F.col("call_id").alias("after"), F.col("head").alias("above"), (F.col("level") + 1).alias("steps"))
    late = heads.select("conv_id", F.col("call_id").alias("above"), F.lit(True).alias("late"))
    rest = edges.join(heads, key, "left_semi").join(above, ["conv_id", "after"]).join(late, ["conv_id", "above"], "left")
    rest = rest.select(*key, "above", "steps", F.when(F.col("above").isNotNull() & F.col("late").isNull(), 0).cast("long").alias("base"))
    rest, done = written(rest, "rest"), heads.limit(0).withColumn("base", F.lit(0).cast("long"))
    while True:
        fresh = rest.groupBy(*key).agg(F.max(F.col("base") + F.col("steps")).alias("base"), F.count("*").alias("n"), F.count("base").alias("known")).where("n = known").select(*key, "base")
        fresh = written(fresh, "fresh")
        if fresh.isEmpty():
            break
        done = done.union(fresh)
        found = fresh.select("conv_id", F.col("call_id").alias("above"), F.col("base").alias("found"))
        rest = rest.join(fresh, key, "left_anti").join(found, ["conv_id", "above"], "left")
        rest = written(rest.select(*key, "above", "steps", F.coalesce("base", "found").alias("base")), "rest")
    late = heads.join(done, key, "left").select("conv_id", F.col("call_id").alias("head"), F.lit(True).alias("late"), "base")
    level = F.when(F.col("head").isNull() | F.col("late") & F.col("base").isNull(), -1).otherwise(F.col("level") + F.coalesce("base", F.lit(0)))
    return now.join(late, ["conv_id", "head"], "left").select(*key, level.alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row for each call, and for each identifier that has results but no call.

    conv_id, call_id, level (order within a conversation, with call_id), n_results, valid, errors
    (joined by "; "), status ("linked", "unanswered", "orphan", "circle") and canonical: the call with
    its first result, by seq and content, as JSON. Arguments that aren't JSON are invalid and kept as
    text, as are those with NaN, Infinity, numbers beyond a double, or over MAX_DEPTH levels ("not JSON");
    integers of any length are kept; lone surrogates are written as escapes; very long texts are kept whole;
    of results with equal seq the least content is first; other columns are left out, whatever their names;
    no calls and no results give no rows; names without a schema are invalid; null identifiers match none; repeated calls are kept and
    share their results; null contents count as results and are null in JSON. Results of one call are
    counted, and only the first is carried, so a call with very many never fills a task.
    """
    key = ["conv_id", "call_id"]
    calls = calls.where(F.col("call_id").isNotNull()).select(*key, "after", "name", "arguments")
    of = results.where(F.col("call_id").isNotNull()).groupBy(*key).agg(F.count("*").alias("n_results"), F.min(F.struct("seq", "content")).alias("result"))
    linked = calls.withColumn("called", F.lit(True)).join(of, key, "full").join(levels(calls), key, "left")

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for conv, call, name, arguments, called, n, content, level in pdf.itertuples(index=False):
                n = 0 if pd.isna(n) else int(n)
                called = called is True or called == True  # noqa: E712
                out, errors = {"id": call}, []
                if called:
                    try:
                        value = parsed(arguments) if arguments is not None else None
                        errors = problems(value, schemas[name]) if name in schemas else ["no schema"]
                    except ValueError:
                        value, errors = arguments, ["not JSON"]
                    out |= {"name": name, "arguments": value}
                if n:
                    out["result"] = content
                status = "orphan" if not called else "circle" if level == -1 else "linked" if n else "unanswered"
                rows.append((conv, call, None if pd.isna(level) else int(level), n, called and not errors, escaped("; ".join(errors)), status, canonical(out)))
            yield pd.DataFrame(rows, columns=names).astype({"level": "Int64"})

    names = ["conv_id", "call_id", "level", "n_results", "valid", "errors", "status", "canonical"]
    flat = linked.select("conv_id", "call_id", "name", "arguments", "called", "n_results", F.col("result.content").alias("content"), "level")
    return flat.mapInPandas(write, "conv_id long, call_id string, level long, n_results long, valid boolean, errors string, status string, canonical string")
