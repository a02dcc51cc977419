"""Archives: whole streams, normalised members, indexes and revisits."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.llm import warc as W

PAGES = T.StructType([T.StructField("page_id", T.LongType()), *[T.StructField(n, T.StringType()) for n in
                      ("url", "html", "archive", "record", "offset", "payload", "a.b")]])


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], PAGES).repartition(3)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def read(archives):
    return W.fetch_records(W.read_index(archives)).collect()


ROWS = [(5, "http://a/x", "same"), (3, "http://b/\r\ny%0A", "same"), (9, None, "same"), (None, "u", "same"), (1, "http://c/", None), (2, "http://d/", ""),
        (4, "ü", "line\r\n\r\nWARC/1.1\r\n\r\nend" * 3), (6, "z", "é" * 400_000), (7, "r", "twice"), (7, "r", "twice"), (7, "q", "twice")]


def test_round_trip(spark, tmp_path):
    rows = ROWS + [(100 + i, f"http://h/{i}", random.Random(i % 40).choice("abc") * (i % 40)) for i in range(300)]
    found = read(W.archive_pages(pages(spark, rows), str(tmp_path)))
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest) for r in found), key=repr) == sorted(
        ((p, u, len((h or "").encode()), digest(h)) for p, u, h in rows), key=repr)
    by = {}
    for p, u, h in rows:
        by.setdefault(h or "", []).append((p is None, p, u is None, u))
    for r in found:
        group = sorted(by[next(h for h in by if digest(h) == r.payload_digest)])
        if r.record_type == "response":
            assert r.payload_digest == digest(r.payload.decode()) and (r.page_id, r.url) == (group[0][1], group[0][3]) and r.refers_to is None
        else:
            assert r.payload == b"" and r.refers_to == group[0][1]
    assert sum(r.record_type == "response" for r in found) == len(by)


def test_every_record_is_a_member_and_the_index_finds_it(spark, tmp_path):
    archives = W.archive_pages(pages(spark, ROWS), str(tmp_path)).collect()
    assert sum(a.records for a in archives) == len(ROWS)
    for a in archives:
        data, at = open(a.archive, "rb").read(), 0
        for line in open(a["index"]):
            offset, length, kind, name, *_ = line.rstrip("\n").split("\t")
            member = gzip.decompress(data[int(offset):int(offset) + int(length)])
            assert int(offset) == at and member.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and name.encode() in member
            at += int(length)
        assert at == len(data)
        # The stream that it was made from is one member from end to end, and holds the same records in full.
        whole = gzip.decompress(open(a.archive.rsplit("-", 1)[0] + ".whole.warc.gz", "rb").read())
        assert whole.count(b"WARC-Type: response") == a.records


def test_smaller_payloads_stay_responses(spark, tmp_path):
    found = read(W.archive_pages(pages(spark, ROWS), str(tmp_path), min_bytes=5))
    assert sorted((r.page_id, r.refers_to) for r in found if r.record_type == "revisit") == [(7, 7), (7, 7)]


def test_many_archives_and_streams_of_many_members(spark, tmp_path):
    written = W.write_archives(pages(spark, [(i, "u", "text " * 100) for i in range(60)]), str(tmp_path), file_bytes=2_000)
    names = [r[0] for r in written.select("archive").distinct().collect()]
    assert len(names) >= 15
    joined = str(tmp_path / "joined.warc.gz")  # a stream of several members is normalised alike
    with open(joined, "wb") as out:
        for name in names:
            out.write(open(name, "rb").read())
    again = read(W.normalise_archives(spark.createDataFrame([(joined,)], "archive string")))
    assert sorted(r.page_id for r in again) == list(range(60)) and {r.record_type for r in again} == {"response"}


def test_damaged_streams_raise(spark, tmp_path):
    (name,) = {r.archive for r in W.write_archives(pages(spark, ROWS).coalesce(1), str(tmp_path)).collect()}
    data = open(name, "rb").read()
    for i, bad in enumerate((data[:len(data) // 2], gzip.compress(gzip.decompress(data)[:-3]), b"not gzip")):
        path = tmp_path / f"bad{i}.warc.gz"
        path.write_bytes(bad)
        with pytest.raises(Exception, match="stream ends early|within a record|incorrect header"):
            W.normalise_archives(spark.createDataFrame([(str(path),)], "archive string"))


def test_empty_table_and_hot_payload(spark, tmp_path):
    assert read(W.archive_pages(pages(spark, []), str(tmp_path / "none"))) == []
    hot = spark.range(2_000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("html"))
    found = W.fetch_records(W.read_index(W.archive_pages(hot, str(tmp_path / "hot"))))
    assert found.where("record_type = 'revisit' AND refers_to = 1").count() == found.where("record_type = 'revisit'").count() == 1_332
