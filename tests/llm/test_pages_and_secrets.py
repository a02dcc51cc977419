"""URL filter and secret scan: exact parts against plain Python, learned parts on cases kept out of training."""

import re

from pyspark.sql import functions as F

from tidemark.llm import secrets
from tidemark.llm.url_filter import ALLOWED, BLOCKED, RULES, filter_urls, fit, labelled_urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return m[1].translate(LOWER), m[2]


def rule(host, path):
    fits = [(len(r), r, v) for r, v in RULES for h, _, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/", "http://com", "http://com?x/", "HTTP://A.Example.COM/en/x#y",
            "http://www.example.com/en/", "http://xwww.example.com/en/", "http://b.www.example.com/en/q?://z", "http://example.com/de/",
            "http://x.net/es/1", "http://x.net/ES/1", "ftp://net/fr/", "http://subcom/", "http://İ.net/fr/", "http://a\nb.net/es/",
            "http://h/" + "p" * 100_000, "://x.net/es/"] * 2
    rows = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, host string, score string")
    weights, intercept = fit(labelled_urls(spark))
    out = {r.page_id: r for r in filter_urls(rows, weights, intercept).collect()}
    assert len(out) == len(urls)
    for i, u in enumerate(urls):
        r, (host, path) = out[i], parts(u)
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert filter_urls(rows.limit(0), weights, intercept).collect() == []


def test_url_scores_on_held_out_urls(spark):
    table = labelled_urls(spark)
    kept_out = F.pmod(F.xxhash64("url"), F.lit(4)) == 0
    weights, intercept = fit(table.where(~kept_out))
    out = filter_urls(table.where(kept_out), weights, intercept, rules=[]).collect()
    assert len(out) >= 10 and sum((r.score >= 0.5) == (r.label == 1.0) for r in out) >= 0.7 * len(out)
    assert len((BLOCKED + ALLOWED).split()) < 200


def test_secrets_on_held_out_findings(spark, sf_dir):
    words = secrets.dictionary(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = secrets.labelled_findings(spark, 600)
    model = secrets.fit(found.where("doc_id < 400"), words)
    rest = found.where("doc_id >= 400")
    judged = model.transform(secrets.describe(secrets.find_candidates(rest), words).join(rest.select("doc_id", "label"), "doc_id"))
    out = judged.select("label", "prediction").collect()
    assert len(out) >= 190 and sum(r.label == r.prediction for r in out) >= 0.97 * len(out)


def test_candidates_at_the_edges(spark, make_docs, odd_texts):
    sha = "3c4226790fc3f8022bcc4434e93601b2005f1325"
    rows = [*enumerate(odd_texts), (50, f'say token = "{sha}" x'), (50, f'say token = "{sha}" x'), (51, sha), (None, f"a {sha}"),
            (52, f"{sha}:{sha[::-1]} {'a' * 30}")]
    docs = make_docs(rows)
    found = [r for r in secrets.find_candidates(docs).collect() if r.doc_id is None or r.doc_id >= 50]
    assert sorted((r.doc_id or 0, r.word_no, r.candidate) for r in found) == sorted(
        [(50, 3, sha), (50, 3, sha), (51, 0, sha), (0, 1, sha), (52, 0, sha), (52, 0, sha[::-1])])
    first = next(r for r in found if r.doc_id == 50)
    assert (first.before2, first.before1, first.after1) == ("token", "=", "x")
    out = secrets.scan_secrets(docs, secrets.labelled_findings(spark, 200)).where("doc_id = 50").collect()
    assert [r.secret for r in out] == [True, True]
    assert secrets.scan_secrets(docs.limit(0), secrets.labelled_findings(spark, 100)).collect() == []
