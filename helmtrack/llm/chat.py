"""Tool-call linking in chats, with DataFrame functions only.

Calls and results are joined by (conversation, call identifier). A call may name one call of the same
conversation that it comes after; levels follow that relation topologically: 0 without a predecessor, else
one more than it. They are found by pointer doubling, so a chain of n calls takes log2(n) rounds. Arguments
are checked against the schema of the call's tool and everything is written as canonical JSON: keys in
order, no white space, strings in their shortest form, numbers without exponents and without zeros after their point
(``12.0`` and ``1.2e1`` are ``12``, and integers for a rule), except those of more than 19 digits before or 18 after it.

``calls``: conv_id, call_id, after_id (or null), name, arguments (JSON text).
``results``: conv_id, call_id, content.
``schemas``: tool name -> {field: rule}; a rule has "type" ("string", "integer", "number", "boolean",
"object", "array"), and optionally "required", "min_length", "max_length", "minimum", "maximum", "enum".

Defined results: of calls or results with one identifier the least row stays and their number is told. A
call without a result has status ``pending``, a result without a call ``orphan``. A call that comes after
itself or an unknown call has level 0 if unknown, and null level and status ``cyclic`` if its predecessors
never end. Null or malformed arguments, unknown tools and failed rules are named in ``errors``. Rows with a
null conv_id or call_id are left out. Other columns play no part. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helmtrack.llm.common import cut

KEY = ["conv_id", "call_id"]


#: In JSON text: a string, or what stands between strings; there, a number, or what stands between numbers.
_PIECE, _NUMBER = r'("(?:[^"\\]|\\.)*"|[^"]+)', r"(-?\d+(?:\.\d+)?(?:E-?\d+)?|[^-0-9]+|-)"
#: Numbers that may have a shorter form: with an exponent, or with zeros after their point.
_LONG = r"\d(?:E|\.\d*0(?![\d]))"


def _plain(number: Column) -> Column:
    """A number without exponent and without zeros after its point, if it has at most 19 digits before and 18 after it; else as it is."""
    exact = number.try_cast("decimal(38, 18)")
    digits = F.regexp_replace(F.regexp_replace(exact.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    fits = exact.isNotNull() & (F.abs(exact) < F.lit(1e19)) & (exact.cast("double") == number.try_cast("double"))
    return F.when(number.rlike(r"^-?\d") & number.rlike(_LONG) & F.coalesce(fits, F.lit(False)), F.when(digits.isin("-0", "0E-18"), "0").otherwise(digits)).otherwise(number)


def _written(parsed: Column) -> Column:
    """A variant as JSON text in which equal numbers are written alike."""
    text = F.to_json(parsed)
    numbers = lambda between: F.array_join(F.transform(F.regexp_extract_all(between, F.lit(_NUMBER), F.lit(1)), _plain), "")
    pieces = F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(1)), lambda p: F.when(F.startswith(p, F.lit('"')), p).otherwise(numbers(p)))
    return F.when(text.rlike(_LONG), F.array_join(pieces, "")).otherwise(text)


def canonical(json_text: Column) -> Column:
    """JSON text in canonical form; null where it isn't JSON."""
    return _written(F.try_parse_json(json_text))


def _path(field: str) -> str:
    """The path of a field of any name, with dots or brackets in it too."""
    return f"$['{field}']" if '"' in field else f'$["{field}"]'


def _type_of(value: Column, number: Column | None = None) -> Column:
    """The JSON type of a variant; null if it is missing. A number without a fraction is an integer, however it is written, if ``number`` (its
    value) is given."""
    kind = F.schema_of_variant(value)
    real = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    whole = (real & (number == F.floor(number))) if number is not None else F.lit(False)
    return (
        F.when(kind == "STRING", "string")
        .when((kind == "BIGINT") | F.coalesce(whole, F.lit(False)), "integer")
        .when(real, "number")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "VOID", "null")
    )


def _field_errors(field: str, rule: dict) -> list[Column]:
    """For each rule of a field: its error where it fails, else null."""
    path = _path(field)
    value = F.try_variant_get("parsed", path, "variant")
    text = F.try_variant_get("parsed", path, "string")
    number = F.try_variant_get("parsed", path, "double")
    kind = _type_of(value, number)
    wanted = rule["type"]
    fits = kind.isin("integer", "number") if wanted == "number" else kind == wanted
    out = [F.when(value.isNotNull() & ~F.coalesce(fits, F.lit(False)), f"{field}: not {wanted}")]
    if rule.get("required"):
        out.append(F.when(value.isNull(), f"{field}: missing"))
    if "min_length" in rule:
        out.append(F.when((kind == "string") & (F.char_length(text) < rule["min_length"]), f"{field}: too short"))
    if "max_length" in rule:
        out.append(F.when((kind == "string") & (F.char_length(text) > rule["max_length"]), f"{field}: too long"))
    if "minimum" in rule:
        out.append(F.when(kind.isin("integer", "number") & (number < rule["minimum"]), f"{field}: too small"))
    if "maximum" in rule:
        out.append(F.when(kind.isin("integer", "number") & (number > rule["maximum"]), f"{field}: too large"))
    if "enum" in rule:
        out.append(F.when(value.isNotNull() & ~text.isin(*rule["enum"]), f"{field}: not allowed"))
    return out


def validated(calls: DataFrame, schemas: dict) -> DataFrame:
    """``calls`` with ``arguments`` made canonical and ``errors``, an array of what fails."""
    parsed = calls.withColumn("parsed", F.try_parse_json("arguments"))
    is_object = F.coalesce(_type_of(F.col("parsed")) == "object", F.lit(False))
    errors = F.when(~F.coalesce(F.col("name").isin(*schemas), F.lit(False)), F.array(F.lit("unknown tool"))).when(~is_object, F.array(F.lit("arguments: not an object")))
    for name, fields in sorted(schemas.items()):
        found = [e for field, rule in sorted(fields.items()) for e in _field_errors(field, rule)]
        errors = errors.when(F.col("name") == name, F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"))
    return parsed.select(*calls.columns, errors.alias("errors"), _written(F.col("parsed")).alias("canonical_arguments"))


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: how many calls come before a call; null on or after a cycle."""
    node = calls.select(*KEY, "after_id")
    known = calls.select("conv_id", F.col("call_id").alias("after_id"), F.lit(True).alias("known"))
    state = node.join(known, ["conv_id", "after_id"], "left")
    state = cut(state.select(*KEY, F.when(F.col("known"), F.col("after_id")).alias("up"), F.when(F.col("known"), 1).otherwise(0).cast("long").alias("level")))
    n = state.where("up IS NOT NULL").count()
    for _ in range(math.ceil(math.log2(n + 1)) + 1 if n else 0):
        # A pointer that reaches a first call is replaced by null: its level is final.
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("further"), F.col("level").alias("more"))
        state = cut(state.join(above, ["conv_id", "up"], "left").select(*KEY, F.col("further").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")))
        if state.where("up IS NOT NULL").isEmpty():
            break
    return state.select(*KEY, F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row per call, and per result without one: conv_id, call_id, level, status, n_calls, n_results,
    n_errors, errors and record, the canonical JSON of it all."""
    present = "conv_id IS NOT NULL AND call_id IS NOT NULL"
    fields = ["name", "after_id", "arguments"]
    one = calls.where(present).groupBy(*KEY).agg(F.min(F.struct(*fields)).alias("call"), F.count("*").alias("n_calls"))
    one = one.select(*KEY, *[F.col(f"call.{f}").alias(f) for f in fields], "n_calls")
    answer = results.where(present).groupBy(*KEY).agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    checked = validated(one, schemas).join(levels(one), KEY)
    joined = checked.join(answer, KEY, "full")
    status = (
        F.when(F.col("n_calls").isNull(), "orphan")
        .when(F.col("level").isNull(), "cyclic")
        .when(F.col("n_results").isNull(), "pending")
        .when(F.size("errors") > 0, "invalid")
        .otherwise("linked")
    )
    joined = joined.withColumns({"status": status, "n_calls": F.coalesce("n_calls", F.lit(0)), "n_results": F.coalesce("n_results", F.lit(0))})
    quoted = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1), F.lit(""))
    text = lambda c: F.when(F.col(c).isNull(), "null").otherwise(quoted(c))
    record = F.concat(
        F.lit('{"after":'), text("after_id"), F.lit(',"arguments":'), F.coalesce("canonical_arguments", F.lit("null")),
        F.lit(',"id":'), text("call_id"), F.lit(',"level":'), F.coalesce(F.col("level").cast("string"), F.lit("null")),
        F.lit(',"name":'), text("name"), F.lit(',"result":'), text("content"), F.lit("}"),
    )
    return joined.select(*KEY, "level", "status", "n_calls", "n_results", F.coalesce(F.size("errors"), F.lit(0)).alias("n_errors"), F.array_join("errors", "; ").alias("errors"), record.alias("record"))


#: The tools that the turns of a conversation are read as calls of.
TURN_SCHEMAS = {
    "reply": {
        "text": {"type": "string", "required": True, "min_length": 1, "max_length": 400},
        "turn": {"type": "integer", "required": True, "minimum": 0},
    },
    "configure": {
        "text": {"type": "string", "required": True, "min_length": 1, "max_length": 300},
        "turn": {"type": "integer", "required": True, "minimum": 0, "maximum": 0},
    },
}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A conversation's user turns as calls of ``reply`` and its system turns as calls of ``configure``, each
    after the call two turns earlier or, for want of it, one earlier; an assistant turn is the result of the
    turn before it. All keys follow from conv_id and turn, so no conversation is gathered in one place."""
    named = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    asked = conversations.where("role IN ('user', 'system') AND conv_id IS NOT NULL AND turn IS NOT NULL")
    turns = asked.select("conv_id", "turn").distinct()
    earlier = lambda n, name: turns.select("conv_id", (F.col("turn") + n).alias("turn"), F.lit(True).alias(name))
    placed = asked.join(earlier(2, "two"), ["conv_id", "turn"], "left").join(earlier(1, "one"), ["conv_id", "turn"], "left")
    calls = placed.select(
        "conv_id",
        named(F.col("turn")).alias("call_id"),
        F.when(F.col("one"), named(F.col("turn") - 1)).when(F.col("two"), named(F.col("turn") - 2)).alias("after_id"),
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
    )
    results = conversations.where("role = 'assistant'").select("conv_id", named(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def linked_turns(conversations: DataFrame) -> DataFrame:
    return link_tool_calls(*turns_as_calls(conversations), TURN_SCHEMAS)
