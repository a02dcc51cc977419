"""Validation: bad rows come out as a table, with all their errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.templates import blank_as_null, pattern_compiles
from tidemark.functions.values import parse_initial_timestamp


def _is_blank(c: Column) -> Column:
    return blank_as_null(c).isNull()


def valid_pattern(pattern: Column) -> Column:
    """Blank or templated patterns are accepted, literal ones must compile."""
    templated = pattern.rlike(r"\$\{[^{}]*\}")
    return _is_blank(pattern) | templated | pattern_compiles(pattern)


def valid_suffix(suffix: Column) -> Column:
    return suffix.isNull() | ~suffix.rlike(r"[/\\]")


def path_filter_needs_recursion(path_filter: Column, recursive: Column) -> Column:
    return path_filter.isNull() | recursive


def password_given(has_user: Column, has_password: Column) -> Column:
    return ~has_user | has_password


def valid_initial_timestamp(s: Column) -> Column:
    return s.isNull() | parse_initial_timestamp(s)["error"].isNull()


def required(c: Column) -> Column:
    return ~_is_blank(c)


def valid_port(port: Column) -> Column:
    n = port.cast("string").try_cast("int")
    return F.coalesce(n.between(1, 65_535), F.lit(False))


def positive(n: Column) -> Column:
    return F.coalesce(n.cast("string").try_cast("int") > 0, F.lit(False))


def collect_errors(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add ``errors`` (names of failed checks, in the given order) and ``is_valid``."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return (df.withColumn("errors", F.array_compact(F.array(*failed)))
            .withColumn("is_valid", F.size("errors") == 0))


def validate_triggers(df: DataFrame) -> DataFrame:
    """Check the settings found among the columns of a trigger table.

    Recognised columns: ``file_filter``, ``path_filter``, ``recursive``,
    ``ignore_suffix``, ``has_user``, ``has_password``, ``initial_timestamp``,
    ``host``, ``share``, ``port``, ``batch_size``.
    """
    have, checks = set(df.columns), {}
    for name in ("file_filter", "path_filter"):
        if name in have:
            checks[f"{name} is not a valid pattern"] = valid_pattern(F.col(name))
    if "ignore_suffix" in have:
        checks["ignore_suffix holds a separator"] = valid_suffix(F.col("ignore_suffix"))
    if {"path_filter", "recursive"} <= have:
        checks["path_filter needs recursion"] = path_filter_needs_recursion(F.col("path_filter"), F.col("recursive"))
    if {"has_user", "has_password"} <= have:
        checks["password is missing"] = password_given(F.col("has_user"), F.col("has_password"))
    if "initial_timestamp" in have:
        checks["initial_timestamp is malformed"] = valid_initial_timestamp(F.col("initial_timestamp"))
    for name in ("host", "share"):
        if name in have:
            checks[f"{name} is blank"] = required(F.col(name))
    if "port" in have:
        checks["port is out of range"] = valid_port(F.col("port"))
    if "batch_size" in have:
        checks["batch_size is not positive"] = positive(F.col("batch_size"))
    return collect_errors(df, checks)


