"""Literals of patterns, and listings with very many patterns."""

import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.operators import listing as listing_module
from tidemark.operators.listing import ListingTemplates, list_for_triggers
from tidemark.operators.patterns import contained, literals_of, required_literal, with_literal


@pytest.mark.parametrize("pattern, literal", [
    ("abc", "abc"), ("a.bcd.*", "bcd"), (r".*\.csv", ".csv"), ("abcd?e", "abc"), ("abc+de", "abc"), ("ab{0,2}cd", "cd"), ("a|b", None),
    ("(a|b)cd", "cd"), ("(abc)?d", "d"), ("[abc]de[^]f]gh", "de"), ("[a[bc]]xyz", "xyz"), (r"\d+_file", "_file"), (r"\x41bc", None),
    ("(?i)abc", None), ("(?:abc)+de", "de"), (r"\Qa.b\E", None), (".*", None), ("", None), (None, None), ("a(?=b)c", None), (r"a\(bc\)", "a(bc)"),
    ("ab**", "a"), ("x*", None), (r"([)]a)bc", "bc"), (r"a\.{2}bc", "bc"), (r"[\]]de", "de"), ("^ab$", "ab"), ("ab+?c", "ab"), (r"\1ab", None), ("a{2", None)])
def test_required_literal(pattern, literal):
    assert required_literal(pattern) == literal


def test_every_match_contains_the_literal():
    rnd, checked = random.Random(8), 0
    parts = ["a", "b", "ab", ".", "[ab]", "(a|bc)", "(?:b)", "\\.", "c?", "b*", "a+", "[^a]", "a{1,2}", "(ab)?", "\\w", "|"]
    texts = ["".join(rnd.choices("abc.", k=rnd.randint(0, 7))) for _ in range(3_000)]
    for _ in range(600):
        pattern = "".join(rnd.choices(parts, weights=[4] * 15 + [1], k=rnd.randint(1, 6)))
        literal = required_literal(pattern)
        if literal is not None:
            for text in texts:
                if re.fullmatch(pattern, text):
                    assert literal in text, (pattern, literal, text)
                    checked += 1
    assert checked > 2_000


def make(spark, n):
    rnd = random.Random(9)
    names = [rnd.choice([f"part-{rnd.randrange(n)}-x.csv", f"{rnd.randrange(n)}.txt", "odd", f"log_{rnd.randrange(n)}"]) for _ in range(600)] + [None, ""]
    kinds = ["part-{}-.*", ".*-{}-x[.]csv", "{}[.]txt", "log_({}|0)", "(?i)LOG_{}", "o?dd{{1,2}}", ".*{}", "[a-z]*|{}"]
    t = [(i, {"b": rnd.choice(["c", "d"]), "f": kinds[i % len(kinds)].format(i)}) for i in range(n)]
    files = spark.createDataFrame([(rnd.choice(["c", "d"]), i, name) for i, name in enumerate(names)], "container string, id int, filename string")
    files = files.withColumns({"directory": F.lit(""), "full_path": F.col("filename"), "is_directory": F.lit(False)}).persist()
    triggers = spark.createDataFrame(t, "trigger_id bigint, attrs map<string,string>")
    want = sorted((i, r.id) for i, a in t for r in files.collect() if r.container == a["b"] and r.filename is not None and re.fullmatch(a["f"], r.filename))
    return triggers, files, want


def test_many_patterns_by_brute_force(spark):
    triggers, files, want = make(spark, 320)
    got = list_for_triggers(triggers, files, ListingTemplates(container="${b}", file_filter="${f}"))
    assert rows(got, "trigger_id", "id") == sorted(want, key=repr) and len(want) > 500


def test_few_literals_and_no_pattern_at_all(spark, monkeypatch):
    monkeypatch.setattr(listing_module, "CONSTANT_PATTERNS", 1)
    files = spark.createDataFrame([("c", "a.csv"), ("c", None)], "container string, filename string").withColumns(
        {"directory": F.lit(""), "full_path": F.col("filename")})
    for patterns, want in (([".*", ".+", " "], [(0, "a.csv"), (1, "a.csv"), (2, None), (2, "a.csv")]), (["a.csv", ".*csv", "x"], [(0, "a.csv"), (1, "a.csv")])):
        t = spark.createDataFrame([(i, {"f": p}) for i, p in enumerate(patterns)], "trigger_id bigint, attrs map<string,string>")
        assert rows(list_for_triggers(t, files, ListingTemplates(container="c", file_filter="${f}")), "trigger_id", "filename") == sorted(want, key=repr)


def test_patterns_run_on_few_pairs(spark):
    """5,000 patterns with 2,000 names: after the join on literals below 5 % of the pairs are left to be tried."""
    t = spark.range(5_000).select("id", F.concat(F.lit("f"), F.col("id").cast("string"), F.lit("_[0-9]*[.](csv|txt)")).alias("p"))
    names = spark.range(2_000).select(F.concat(F.lit("f"), (F.col("id") * 3).cast("string"), F.lit("_7.csv")).alias("name"))
    t = with_literal(t, "p", "k").persist()
    tried = contained(names, "name", literals_of(t, "k"), "k").join(t, "k").where("p IS NOT NULL")
    assert 1_667 <= tried.count() < 0.05 * 5_000 * 2_000


def test_many_patterns_of_too_many_triggers_by_brute_force(spark):
    """Triggers that cannot be broadcast: names meet only patterns that begin as they do, whatever the patterns (F5)."""
    from tidemark.plans.joins import BroadcastLimit

    triggers, files, want = make(spark, 320)
    got = list_for_triggers(triggers, files, ListingTemplates(container="${b}", file_filter="${f}"), limit=BroadcastLimit(rows=10))
    assert "t_head" in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got, "trigger_id", "id") == sorted(want, key=repr)


def test_every_match_begins_with_the_head(monkeypatch):
    from tidemark.operators.patterns import required_head

    assert [required_head(p) for p in ("f1_[0-9]*", "ab*c", "ab+c", "a|b", ".*x", "(?i)abc", "a?bc", "(ab)?cd", None, r"\.x", "ab{2}c")] == [
        "f1_", "a", "ab", "", "", "", "", "", "", ".x", "a"]
    rnd, checked = random.Random(8), 0
    parts = ["a", "b", "ab", ".", "[ab]", "(a|bc)", "(?:b)", "\\.", "c?", "b*", "a+", "[^a]", "a{1,2}", "(ab)?", "\\w", "|"]
    texts = ["".join(rnd.choices("abc.", k=rnd.randint(0, 7))) for _ in range(1_000)]
    for _ in range(400):
        pattern = "".join(rnd.choices(parts, weights=[4] * 15 + [1], k=rnd.randint(1, 6)))
        head = required_head(pattern)
        for text in texts if head else []:
            if re.fullmatch(pattern, text):
                assert text.startswith(head), (pattern, head, text)
                checked += 1
    assert checked > 100


def test_heads_of_very_many_lengths_are_cut(spark):
    from tidemark.operators.patterns import HEAD_LENGTHS, head_lengths, headed

    df = spark.range(60).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("h"))
    lengths = head_lengths(df, "h")
    assert len(lengths) == HEAD_LENGTHS and lengths[0] == 0
    assert {len(r.h) for r in headed(df, "h", lengths).collect()} == set(lengths)
    names = spark.createDataFrame([("xx",), (None,)], "n string")
    assert rows(headed(names, "n", [0, 1, 5], "h")) == [("xx", ""), ("xx", "x"), (None, "")]
