"""URLs allowed or blocked: by rules where one fits, else by a learned score.

The score is a logistic regression on hashed character n-grams of host and path,
fitted on a small table of labelled URLs.  Rules and scoring are column
expressions; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import ascii_lower, table, without
from tidemark.llm.registry import query

#: Buckets that n-grams are hashed to, and the lengths of n-grams.
BUCKETS, LENGTHS = 2_048, (3, 4)

# Rules (host and path, verdict).
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]

# Labelled URLs for training.
BLOCKED = """
casino-royal.example/slots  win-casino.example/bonus  online-casino.example/play  casino-slots.example/en/1
free-bets.example/today  sports-bets.example/odds  best-bets.example/tips  bets-win.example/en/77
cheap-pills.example/order  buy-pills.example/shop  pills-online.example/rx  discount-pills.example/en/9
adult-videos.example/watch  adult-x.example/cams  xxx-adult.example/free  hot-adult.example/en/4
spam-farm.example/links  link-farm.example/seo  spam-links.example/page  seo-spam.example/en/12
ads-track.example/pixel  track-ads.example/click  ad-tracker.example/beacon  popup-ads.example/en/5
free-money.example/win  win-prizes.example/claim  lottery-win.example/now  poker-free.example/en/3
payday-loans.example/apply  fast-loans.example/cash  crypto-double.example/send  warez-crack.example/download
phish-login.example/verify  account-verify.example/login  malware-drop.example/exe  torrent-warez.example/en/8
"""
ALLOWED = """
library.example/catalogue  museum.example/en/visit  university.example/courses/1  school.example/de/news
news-daily.example/politics/4  weather.example/forecast  recipes.example/soup  gardening.example/roses
hospital.example/contact  city-council.example/fr/services  science.example/articles/22  physics.example/en/lecture
history.example/medieval/3  travel.example/guide/rome  railway.example/timetable  theatre.example/programme
blog.writers.example/en/2014  m.paper.example/article/17  www.research.example/publications  docs.software.example/api/v2
forum.cooking.example/thread/8  wiki.language.example/en/grammar  blog.astronomy.example/de/5  photos.nature.example/birds
parliament.example/debates  statistics.example/table/6  dictionary.example/en/word  maps.example/es/street
thinking.example/en/100  nation.example/de/2000  ththis.example/en/4711  blog.tionher.example/fr/99
www.theran.example/es/512  m.erhest.example/en/31  ingthe.example/de/875  andthon.example/en/6/
"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``: host in lower case, and path; empty without a ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    found = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(found, parts, 1)), F.regexp_extract(found, parts, 2)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls.  On equal length the longer host wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0].index("/"))):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def hashed_grams(host: Column, path: Column) -> Column:
    """Buckets of all n-grams; the two parts are marked, and their ends are part of the grams."""
    marked = [F.concat(F.lit(mark), part, F.lit(end)) for mark, part, end in (("<", host, ">"), ("{", path, "}"))]

    def grams(part: Column, n: int) -> Column:
        # A part shorter than n is one gram; sequence(1, 0) would count down, hence greatest.
        starts = F.sequence(F.lit(1), F.greatest(F.char_length(part) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substr(part, i, F.lit(n))), F.lit(BUCKETS)).cast("int"))

    return F.concat(*[grams(m, n) for m in marked for n in LENGTHS])


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = [(f"https://{u}", y) for text, y in ((BLOCKED, 1.0), (ALLOWED, 0.0)) for u in text.split()]
    return spark.createDataFrame(rows, "url string, label double")


def fit(labelled: DataFrame, reg: float = 0.0003) -> tuple[list[float], float]:
    """Weight of each bucket, and intercept.  ``labelled`` has url and label (1 to block); it is small."""
    grams = hashed_grams(*host_and_path(F.col("url")))
    counts = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)),
                         lambda b: F.size(F.filter(F.col("grams"), lambda g: g == b)) / F.sqrt(F.size("grams")))
    rows = labelled.where(F.col("label").isin(0.0, 1.0)).select("label", grams.alias("grams"))
    rows = rows.select("label", array_to_vector(counts).alias("features"))
    model = LogisticRegression(regParam=reg, standardization=False, maxIter=100).fit(rows)
    return [float(w) for w in model.coefficients], float(model.intercept)


def filter_urls(pages: DataFrame, weights: list[float], intercept: float, rules: list[tuple[str, str]] | None = None,
                threshold: float = 0.5) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` (that the URL should be blocked) and ``verdict``.

    A null URL, or one without ``://``, has an empty host and path and is judged
    by the score of these.  Repeated rows get equal results.  Columns named as
    the results are replaced.
    """
    names = ["host", "path", "rule", "score", "verdict"]
    host, path = host_and_path(F.col("url"))
    base = pages.select(*without(pages, [*names, "_host", "_path"]), host.alias("_host"), path.alias("_path"))
    host, path = F.col("_host"), F.col("_path")
    table = F.array(*[F.lit(w) for w in weights])
    grams = hashed_grams(host, path)
    total = F.aggregate(F.transform(grams, lambda b: F.get(table, b)), F.lit(0.0), lambda a, b: a + b)
    score = 1 / (1 + F.exp(-(total / F.sqrt(F.size(grams)) + F.lit(intercept))))
    rule, verdict = rule_for(host, path, RULES if rules is None else rules)
    return (base.withColumns({"host": host, "path": path, "rule": rule, "score": score})
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") >= threshold, "block").otherwise("allow")))
            .drop("_host", "_path"))


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    weights, intercept = fit(labelled_urls(spark))
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), weights, intercept)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")
