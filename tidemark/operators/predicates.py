"""File and message predicates.  All bounds are inclusive."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.paths import relative_dir
from tidemark.functions.templates import full_match
from tidemark.functions.values import parse_duration, parse_size
from tidemark.schema import DEFAULT_MIN_AGE

Amount = int | float | str


def _ms(d: Amount) -> Column:
    return parse_duration(F.lit(d)) if isinstance(d, str) else F.lit(int(d))


def _bytes(n: Amount) -> Column:
    return parse_size(F.lit(n)) if isinstance(n, str) else F.lit(n)


def _instant(ms: Column | int) -> Column:
    """Constant instant.  The comparison stays on the bare column, so it reaches the scan."""
    return F.timestamp_millis(F.lit(ms) if isinstance(ms, int) else ms)


def min_age(d: Amount, now_ms: int) -> Column:
    return F.col("last_modified") <= _instant(F.lit(now_ms) - _ms(d))


def max_age(d: Amount, now_ms: int) -> Column:
    return F.col("last_modified") >= _instant(F.lit(now_ms) - _ms(d))


def min_size(n: Amount) -> Column:
    return F.col("size") >= _bytes(n)


def max_size(n: Amount) -> Column:
    return F.col("size") <= _bytes(n)


def min_timestamp(ms: int) -> Column:
    return F.col("last_modified") >= _instant(ms)


def initial_timestamp(ms: int) -> Column:
    """Extra floor of a first listing; see ``initial_floor``."""
    return min_timestamp(ms)


def file_filter(pattern: str | Column) -> Column:
    return full_match(F.col("filename"), pattern)


def path_filter(pattern: str | Column, base: Column | str | None = None) -> Column:
    """Whole-text match on the directory, below ``base`` if one is given."""
    directory = F.col("directory") if base is None else relative_dir(F.col("directory"), base)
    return full_match(directory, pattern)


def ignore_suffix(suffix: str) -> Column:
    return ~F.col("filename").endswith(suffix)


def exclude_temp(marker: str) -> Column:
    return ~F.col("full_path").contains(marker)


def exclude_directories() -> Column:
    return ~F.col("is_directory")


def or_directory(rule: Column) -> Column:
    """Directories pass a rule untouched (secure file transfer listings)."""
    return F.col("is_directory") | rule


def ignore_dotted() -> Column:
    return ~F.col("filename").startswith(".")


def message_size(limit: int, body: str = "body") -> Column:
    return F.octet_length(F.col(body)) <= limit


def topic_filter(topics: Column | str, event: str = "event") -> Column:
    """The event is one of the comma-separated topics (blanks around a topic are dropped)."""
    topics = F.lit(topics) if isinstance(topics, str) else topics
    return F.array_contains(F.transform(F.split(topics, ","), lambda t: F.trim(t)), F.col(event))


@dataclass(frozen=True)
class FilterSpec:
    """Settings of one listing.  Unset rules are left out of the plan.

    Ages and sizes are numbers (milliseconds, bytes) or texts such as
    ``"5 secs"`` and ``"10 MB"``.  ``directories`` is ``"drop"``, ``"pass"``
    (directories skip age and size) or ``"keep"`` (no special rule).
    """

    min_age: Amount | None = DEFAULT_MIN_AGE
    max_age: Amount | None = None
    min_size: Amount | None = None
    max_size: Amount | None = None
    min_timestamp: int | None = None
    initial_timestamp: int | None = None
    file_filter: str | None = None
    path_filter: str | None = None
    path_base: str | None = None
    ignore_suffix: str | None = None
    temp_marker: str | None = None
    ignore_dotted: bool = False
    directories: str = "drop"

    def rules(self, now_ms: int) -> dict[str, Column]:
        """Active rules by name, cheap ones first and regular expressions last."""
        out: dict[str, Column] = {}
        if self.directories == "drop":
            out["directories"] = exclude_directories()
        aged: dict[str, Column] = {}
        if self.min_age is not None:
            aged["min_age"] = min_age(self.min_age, now_ms)
        if self.max_age is not None:
            aged["max_age"] = max_age(self.max_age, now_ms)
        if self.min_size is not None:
            aged["min_size"] = min_size(self.min_size)
        if self.max_size is not None:
            aged["max_size"] = max_size(self.max_size)
        if self.directories == "pass":
            aged = {name: or_directory(rule) for name, rule in aged.items()}
        out |= aged
        if self.min_timestamp is not None:
            out["min_timestamp"] = min_timestamp(self.min_timestamp)
        if self.initial_timestamp is not None:
            out["initial_timestamp"] = initial_timestamp(self.initial_timestamp)
        if self.ignore_suffix:
            out["ignore_suffix"] = ignore_suffix(self.ignore_suffix)
        if self.temp_marker:
            out["exclude_temp"] = exclude_temp(self.temp_marker)
        if self.ignore_dotted:
            out["ignore_dotted"] = ignore_dotted()
        if self.file_filter and self.file_filter.strip():
            out["file_filter"] = file_filter(self.file_filter)
        if self.path_filter and self.path_filter.strip():
            out["path_filter"] = path_filter(self.path_filter, self.path_base)
        return out

    def raw_time_bounds(self, ms: Column, now_ms: int) -> list[Column]:
        """The age and time rules on a column of epoch milliseconds.

        Only repeats what ``rules`` says, in a form that a scan can use.
        """
        if self.directories == "pass":
            return []
        out = []
        if self.min_age is not None:
            out.append(ms <= F.lit(now_ms) - _ms(self.min_age))
        if self.max_age is not None:
            out.append(ms >= F.lit(now_ms) - _ms(self.max_age))
        out += [ms >= F.lit(t) for t in (self.min_timestamp, self.initial_timestamp) if t is not None]
        return out


def all_of(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, rules.values(), F.lit(True))


def apply_filters(inv: DataFrame, spec: FilterSpec, now_ms: int) -> DataFrame:
    """Keep the files that pass every rule of a listing, at one instant ``now_ms``."""
    for rule in spec.rules(now_ms).values():
        inv = inv.where(rule)
    return inv
