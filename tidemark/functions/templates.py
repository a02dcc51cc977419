"""Attribute templates and the filters made from them."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_PLACEHOLDER = re.compile(r"\$\{([^{}]*)\}")


def has_placeholder(template: str) -> bool:
    return _PLACEHOLDER.search(template) is not None


def render(template: str, attrs: Column) -> Column:
    """Replace each ``${name}`` of a constant template by ``attrs[name]``.

    A missing attribute becomes the empty string.  Values are never rendered
    again.  The template is cut up once, when the plan is built, so the row
    cost is one ``concat``.
    """
    parts, pos = [], 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(attrs[m.group(1)], F.lit("")))
        pos = m.end()
    if pos < len(template) or not parts:
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def render_column(template: Column, attrs: Column) -> Column:
    """``render`` for templates that differ from row to row."""

    def fill(token: Column) -> Column:
        close = F.instr(token, "}")
        name = F.substring(token, F.lit(1), close - 1)
        value = F.coalesce(F.element_at(attrs, name), F.lit(""))
        rest = F.substring(token, close + 1, F.length(token))
        literal = (close == 0) | F.contains(name, F.lit("{"))
        return F.when(literal, F.concat(F.lit("${"), token)).otherwise(F.concat(value, rest))

    tokens = F.split(template, r"\$\{")
    tail = F.transform(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))), fill)
    return F.concat(F.element_at(tokens, 1), F.array_join(tail, ""))


def blank_as_null(c: Column) -> Column:
    """Null when the text is empty or only whitespace (Java's whitespace class)."""
    return F.when(~c.rlike(r"\A\p{javaWhitespace}*\z"), c)


def resolve_filter(template: str | None, attrs: Column, no_trigger: str = "render") -> Column:
    """Resolve a filter template against a trigger; null means "no filter".

    ``no_trigger="render"`` renders against an empty map when there is no
    trigger.  ``"ignore"`` switches a templated filter off in that case, which
    is what the data-lake listing does (it also treats an empty map so).
    """
    if template is None:
        return F.lit(None).cast("string")
    empty = attrs.isNull() | (F.size(attrs) == 0)
    rendered = render(template, F.coalesce(attrs, F.create_map().cast("map<string,string>")))
    if no_trigger == "ignore":
        fallback = F.lit(None).cast("string") if has_placeholder(template) else F.lit(template)
        rendered = F.when(empty, fallback).otherwise(rendered)
    elif no_trigger != "render":
        raise ValueError("no_trigger must be 'render' or 'ignore'")
    return blank_as_null(rendered)


def wrap_full(pattern: str | Column) -> str | Column:
    """Turn a pattern into one that finds only whole-text matches."""
    if isinstance(pattern, str):
        return rf"\A(?:{pattern})\z"
    return F.concat(F.lit(r"\A(?:"), pattern, F.lit(r")\z"))


def full_match(text: Column, pattern: str | Column) -> Column:
    """Whole-text regular expression match; a null pattern column lets all through.

    A constant pattern is compiled once per task.  A pattern column goes through
    ``regexp_instr``, which recompiles only when the pattern changes between
    rows (``rlike`` recompiles on every row).
    """
    if isinstance(pattern, str):
        return text.rlike(wrap_full(pattern))
    return pattern.isNull() | (F.regexp_instr(text, wrap_full(pattern)) > 0)


def pattern_compiles(pattern: Column) -> Column:
    """Whether the JVM accepts a pattern, checked row by row inside Spark.

    ``try_reflect`` turns the compile error into null, so one bad pattern does
    not fail the job and nothing is collected.  The wrapped form is checked as
    well because that is the one a listing runs.
    """
    def compiles(p: Column) -> Column:
        return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), p).isNotNull()

    return compiles(pattern) & compiles(wrap_full(pattern))
