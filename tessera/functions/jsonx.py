"""JSON text: keys, gaps, and what can be read of broken arrays. Documents as rows: see operators/trees.py."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_key(j: Column, key: str) -> Column:
    """Whether an object has a key, also one with a null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(j), key), F.lit(False))


def is_blank(j: Column) -> Column:
    """Whether JSON text is a gap: absent, null, a blank string, an empty array or object; decided by type, so the string
    "[]" is none."""
    return F.coalesce(j.rlike(r'(?U)^\s*(null|\[\s*\]|\{\s*\}|"(?:\s|\\[nrtfb])*")?\s*$'), F.lit(True))


def is_blank_text(c: Column) -> Column:
    """Whether text is absent or blank."""
    return F.coalesce(F.trim(c) == "", F.lit(True))


#: A string (or the rest of the text, where it is cut off inside one), a bracket, or anything between.
_TOKEN = r'"(?:[^"\\]|\\(?s:.))*(?:"|\\?\z)|[\[\]{}]|[^"\[\]{}]+'


def repaired(text: Column) -> Column:
    """The objects of a fenced or cut-off JSON array, as the text of a JSON array; null without any.

    A fold over the tokens of the text counts brackets outside strings. A whole array is taken as it is; else the
    complete objects at the top, up to the first that is no JSON. Text around the array is ignored.
    """
    body = F.regexp_replace(F.trim(text), r"^\s*```\w*|```\s*$", "")
    array_at, object_at = F.instr(body, "["), F.instr(body, "{")
    start = F.when((array_at > 0) & ((object_at == 0) | (array_at < object_at)), array_at)

    def spans(tail: Column, opening: str, closing: str) -> Column:
        """The parts of `tail` from an opening bracket to the one that closes it."""

        def step(state: Column, token: Column) -> Column:
            deeper, shallower = token.isin(*opening), token.isin(*closing) & (state["depth"] > 0)
            depth = state["depth"] + F.when(deeper, 1).when(shallower, -1).otherwise(0)
            held = F.when((state["depth"] == 0) & ~deeper, "").otherwise(F.concat(state["held"], token))
            full = shallower & (depth == 0)
            found = F.when(full, F.concat(state["found"], F.array(held))).otherwise(state["found"])
            return F.struct(depth.alias("depth"), F.when(full, "").otherwise(held).alias("held"), found.alias("found"))

        none = F.struct(F.lit(0).alias("depth"), F.lit("").alias("held"), F.array().cast("array<string>").alias("found"))
        return F.aggregate(F.regexp_extract_all(tail, F.lit(_TOKEN), F.lit(0)), none, step)["found"]

    whole = F.get(spans(F.substring(body, start, F.length(body)), "[{", "]}"), F.lit(0))
    objects = spans(F.substring(body, object_at, F.length(body)), "{", "}")
    parsed = F.transform(objects, lambda o: F.to_json(F.try_parse_json(o)))
    bad = F.coalesce(F.array_position(F.transform(parsed, lambda o: o.isNull()), True), F.lit(0))
    good = F.when(bad == 0, parsed).otherwise(F.slice(parsed, F.lit(1), F.greatest(bad - 1, F.lit(0)).cast("int")))
    stream = F.when((object_at > 0) & (F.size(good) > 0), F.concat(F.lit("["), F.array_join(good, ","), F.lit("]")))
    return F.coalesce(F.to_json(F.try_parse_json(whole)), stream)
