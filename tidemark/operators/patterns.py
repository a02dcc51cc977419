"""Which of very many patterns can match a text: by literals that their matches must contain."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

# Stands for patterns without a literal; they are tried on every text.
ANYWHERE = 0
# Names are looked up at up to this many lengths of the texts that patterns begin with.
HEAD_LENGTHS = 16
QUANTIFIERS = "?*+{"


def _after_class(p: str, i: int) -> int:
    """The place after a character class that opens at ``i``; classes nest, and ``]`` may come first."""
    level = 0
    while i < len(p):
        if p[i] == "\\":
            i += 1
        elif p[i] == "[":
            level += 1
            i += p.startswith("^", i + 1)
            i += p.startswith("]", i + 1)
        elif p[i] == "]":
            level -= 1
            if not level:
                return i + 1
        i += 1
    return len(p)


def required_literal(pattern: str | None) -> str | None:
    """The longest text that every whole match of a pattern contains, as far as it is plain to see; none if in doubt.

    Looks at letters outside of groups and classes that are not optional.
    Alternatives at the top, inline flags, look-around and quoted parts give none.
    """
    return max(_required_texts(pattern) or [""], key=len) or None


def required_head(pattern: str | None) -> str:
    """The text that every whole match of a pattern begins with, as far as ``required_literal`` sees it; may be empty."""
    return (_required_texts(pattern) or [""])[0]


def _required_texts(pattern: str | None) -> list[str] | None:
    """Texts that every whole match contains, in their order; the match begins with the first, which may be empty."""
    if pattern is None or "(?" in pattern.replace("(?:", "") or "\\Q" in pattern:
        return None
    found, run, i, n = [], "", 0, len(pattern)
    ends = found.append
    while i < n:
        c, literal = pattern[i], None
        if c == "|":
            return None
        if c == "\\":
            nxt = pattern[i + 1:i + 2]
            if not nxt:
                return None
            if nxt.isalnum():
                if nxt not in "dDwWsSbB":
                    return None  # codes, back references and the like
            else:
                literal = nxt
            i += 2
        elif c == "[":
            i = _after_class(pattern, i)
        elif c == "(":
            level = 0
            while i < n:
                if pattern[i] == "\\":
                    i += 1
                elif pattern[i] == "[":
                    i = _after_class(pattern, i) - 1
                elif pattern[i] in "()":
                    level += 1 if pattern[i] == "(" else -1
                    if not level:
                        break
                i += 1
            i += 1
        else:
            literal = None if c in "^$.)" or c in QUANTIFIERS else c
            i += 1
        if literal is None:
            ends(run)
            run = ""
        elif pattern[i:i + 1] and pattern[i] in QUANTIFIERS:
            ends(run + literal if pattern[i] == "+" else run)
            run = ""
        else:
            run += literal
        # A quantifier belongs to what stood before it.
        while i < n and pattern[i] in QUANTIFIERS:
            i = pattern.find("}", i) + 1 if pattern[i] == "{" else i + 1
            if not i:
                return None
    ends(run)
    return found


@F.pandas_udf(T.StringType())
def _required(patterns: pd.Series) -> pd.Series:
    return patterns.map(required_literal, na_action=None)


def with_literal(df: DataFrame, pattern: str, out: str) -> DataFrame:
    """Add the hash of the literal of a pattern column, ``ANYWHERE`` for those without one."""
    literal = _required(F.col(pattern))
    return (df.withColumn("_literal", literal)
            .withColumn(out, F.coalesce(F.when(F.col("_literal").isNotNull(), F.xxhash64("_literal")), F.lit(ANYWHERE))))


@F.pandas_udf(T.StringType())
def _heads(patterns: pd.Series) -> pd.Series:
    return patterns.map(required_head)


def with_head(df: DataFrame, pattern: str, out: str) -> DataFrame:
    """Add the text that names must begin with to match a pattern column; empty if there is none."""
    return df.withColumn(out, F.coalesce(_heads(F.col(pattern)), F.lit("")))


def head_lengths(df: DataFrame, head: str) -> list[int]:
    """Lengths that heads are cut to: those that occur, or as many of them as ``HEAD_LENGTHS``, the shortest included."""
    found = sorted(df.agg(F.collect_set(F.char_length(head))).first()[0]) or [0]
    return sorted({found[i * len(found) // HEAD_LENGTHS] for i in range(HEAD_LENGTHS)})


def headed(df: DataFrame, text: str, lengths: list[int], out: str | None = None) -> DataFrame:
    """``df`` with one row per given length that a text reaches, and the head of that length as ``out``.

    Without ``out`` the text itself is cut, to the greatest of the lengths that it reaches.
    """
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.char_length(F.coalesce(text, F.lit(""))))
    cut = F.array_max(cuts) if out is None else F.explode(cuts)
    shorter = F.substring(F.coalesce(text, F.lit("")), F.lit(1), F.col("_length"))
    return df.withColumn("_length", cut).withColumn(out or text, shorter).drop("_length")


def contained(df: DataFrame, text: str, literals: DataFrame, out: str) -> DataFrame:
    """``df`` with one row per literal that a text column contains, and one for ``ANYWHERE``.

    ``literals`` (hash, literal) must be few: they go to all tasks, which put
    them into one automaton and run it once over each different text of a batch.
    A null text contains none.
    """
    known = df.sparkSession.sparkContext.broadcast([tuple(r) for r in literals.distinct().collect()])

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for code, literal in known.value:
            automaton.add_word(literal, code)
        automaton.make_automaton()
        for texts in batches:
            at, different = pd.factorize(texts)
            hits = [list({code for _, code in automaton.iter(t)}) for t in different]
            yield pd.Series([hits[i] if i >= 0 else [] for i in at], dtype=object)

    codes = F.array(F.lit(ANYWHERE).cast("bigint"))
    if not known.value:
        return df.withColumn(out, F.explode(codes))
    return df.withColumn(out, found(F.col(text))).withColumn(out, F.explode(F.array_distinct(F.concat(codes, F.col(out)))))


def literals_of(df: DataFrame, out: str) -> DataFrame:
    """The different literals that ``with_literal`` found: (hash, literal)."""
    return df.where(F.col("_literal").isNotNull()).select(F.col(out), F.col("_literal"))
