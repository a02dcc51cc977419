import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators.routes import route_message


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def apply(spark, function, *values):
    return [r[0] for r in texts(spark, *values).select("i", function(F.col("s")).alias("x")).orderBy("i").select("x").collect()]


def attrs(**kv):
    return F.create_map(*[c for k, v in kv.items() for c in (F.lit(k.replace("_", ".")), F.lit(v))])


def test_blank_is_javas_class(spark):
    blank = ["", " ", "\t\n", "\u3000", "\u2028", "\u001c"]
    solid = ["\u00a0", "x ", "."]
    assert apply(spark, fn.blank_as_null, *blank, None) == [None] * 7
    assert apply(spark, fn.blank_as_null, *solid) == solid


def test_full_match(spark):
    def match(p, s):
        return one(spark, fn.full_match(F.lit(s), p)), one(spark, fn.full_match(F.lit(s), F.lit(p)))

    assert match("export", "export.done") == (False, False)
    assert match("^export.done", "export.done") == (True, True)
    assert match("a|ab", "ab") == (True, True)
    assert match("a", "a\n") == (False, False)
    assert match("te.*", "test.txt") == (True, True)
    assert match(".*", "") == (True, True)
    assert one(spark, fn.full_match(F.lit("anything"), F.lit(None).cast("string"))) is True


def test_render(spark):
    a = attrs(dir="in", file="x")
    assert one(spark, fn.render("${dir}/${file}", a)) == "in/x"
    assert one(spark, fn.render("${nothing}", a)) == ""
    assert one(spark, fn.render("plain", a)) == "plain"
    assert one(spark, fn.render("", a)) == ""
    assert one(spark, fn.render("a}b${dir", a)) == "a}b${dir"
    assert one(spark, fn.render("${dir}", attrs(dir="${file}", file="x"))) == "${file}"  # one pass only


@pytest.mark.parametrize("template", ["${dir}/${file}", "${no}", "plain", "", "a}b${dir", "${dir}${dir}", "${a${dir}}", "${}", "$x{dir}", "${a{b}"])
def test_render_column_agrees(spark, template):
    a = attrs(dir="in", file="x")
    assert one(spark, fn.render_column(F.lit(template), a)) == one(spark, fn.render(template, a))


def test_render_column_is_one_pass(spark):
    assert one(spark, fn.render_column(F.lit("${dir}"), attrs(dir="${file}", file="x"))) == "${file}"


def test_resolve_filter(spark):
    none = F.lit(None).cast("map<string,string>")
    empty = F.create_map().cast("map<string,string>")
    f = fn.resolve_filter
    assert one(spark, f("${file_filter}", attrs(other="x"))) is None  # attribute missing
    assert one(spark, f("${f}", attrs(f=""))) is None
    assert one(spark, f("${f}", attrs(f="te.*"))) == "te.*"
    assert one(spark, f("p_${x}", none)) == "p_"
    for no_attrs in (none, empty):
        assert one(spark, f("p_${x}", no_attrs, no_trigger="ignore")) is None
        assert one(spark, f("p_.*", no_attrs, no_trigger="ignore")) == "p_.*"
    assert one(spark, f("p_${x}", attrs(x="1"), no_trigger="ignore")) == "p_1"
    assert one(spark, f(None, none)) is None


def test_merge_listing_wins(spark):
    merged = one(spark, fn.merge_attributes(attrs(batch_id="12345", origin="trigger"), attrs(origin="listing", filename="f")))
    assert merged == {"batch.id": "12345", "origin": "listing", "filename": "f"}
    assert one(spark, fn.merge_attributes(F.lit(None).cast("map<string,string>"), attrs(a="1"))) == {"a": "1"}


def test_paths(spark):
    assert apply(spark, fn.normalise_path, "\\a\\b", "/", None, "", "a/b") == ["/a/b", "", "", "", "a/b"]
    assert apply(spark, lambda c: fn.normalise_path(c, relative=True), "\\a\\b", "/", "//x") == ["a/b", "", "/x"]
    assert apply(spark, fn.parent, "a/b", "b", "/b", "/a/b/c") == ["a", None, "/", "/a/b"]
    assert apply(spark, fn.depth, "", "a", "a/b/c") == [0, 1, 3]
    assert apply(spark, fn.ancestors, "a/b/c", "/a/b", "/", "", None) == [
        ["a", "a/b", "a/b/c"], ["/", "/a", "/a/b"], ["/"], [], []]
    join = lambda d: fn.join_path(d, F.lit("f"))
    assert apply(spark, join, "a", "a/", "", " ", None, "/", "a//b") == ["a/f", "a/f", "f", "f", "f", "/f", "a/b/f"]
    rel = lambda c: fn.relative_dir(c, "base")
    assert apply(spark, rel, "base/x", "base", "basement", "x/base") == ["x", "", "ment", "x/base"]
    assert apply(spark, lambda c: fn.relative_dir(c, "a.b"), "a.b/x", "axb/x") == ["x", "axb/x"]  # literal, no pattern


def test_uris(spark):
    service = fn.service_uri(F.lit("localhost"), F.lit(445), F.lit("share"))
    assert one(spark, service) == "smb://localhost:445/share"
    uri = lambda c: fn.transit_uri(service, c)
    assert apply(spark, uri, "sub\\f.txt", "/sub/f.txt", "", "a b/c%d", "ü[1]", "a\tb") == [
        "smb://localhost:445/share/sub/f.txt", "smb://localhost:445/share/sub/f.txt", "smb://localhost:445/share",
        "smb://localhost:445/share/a%20b/c%25d", "smb://localhost:445/share/ü%5B1%5D", "smb://localhost:445/share/a%09b"]
    assert apply(spark, lambda c: fn.display_path(service, c), "", "/", "a") == [
        "smb://localhost:445/share/", "smb://localhost:445/share/", "smb://localhost:445/share/a/"]


def test_errors(spark):
    codes = spark.createDataFrame([(0xC0000034,), (0xC000003A,), (0xC000000F,), (0xC0000022,), (None,)], "c bigint")
    got = [tuple(r) for r in codes.select(fn.classify_error(F.col("c")), fn.error_code_text(F.col("c"))).collect()]
    assert got == [("not found", "3221225524"), ("not found", "3221225530"), ("not found", "3221225487"),
                   ("failure", "3221225506"), ("failure", "-2")]


def test_initial_timestamp(spark):
    good = apply(spark, fn.parse_initial_timestamp, "2025-02-01T00:00:00Z", "1738368000000", "2025-02-01T01:00:00+01:00",
                 "2025-02-01T00:00:00.123456789Z", "+5", "-5")
    assert [g["ms"] for g in good] == [1738368000000, 1738368000000, 1738368000000, 1738368000123, 5, -5]
    assert all(g["error"] is None for g in good)
    bad = apply(spark, fn.parse_initial_timestamp, "2025-02-01", "abc", "2025-02-30T00:00:00Z", " 5", "99999999999999999999", "")
    assert [b["ms"] for b in bad] == [None] * 6
    assert bad[1]["error"] == "'abc' is neither an epoch timestamp nor a UTC datetime."


def test_quantities(spark):
    assert apply(spark, fn.parse_size, "10 MB", "1.5KB", "7 b", "5", "x KB", None) == [10485760.0, 1536.0, 7.0, None, None, None]
    assert apply(spark, fn.parse_duration, "5 secs", "1 hour", "2d", "1.5 min", "300 ms", "9",
                 "9999999999999999999999 days") == [5000, 3600000, 172800000, 90000, 300, None, None]


def test_root_cause(spark):
    def causes(*chain):
        return F.array(*[F.struct(F.lit(c).alias("class"), F.lit(m).cast("string").alias("message")) for c, m in chain])

    deep = one(spark, fn.root_cause(causes(("Outer", "o"), ("Mid", "m"), ("Inner", "i"))))
    assert tuple(deep) == ("Inner", "i")
    assert tuple(one(spark, fn.root_cause(causes(("Outer", "o"), ("Inner", None))))) == ("Inner", "o")
    assert tuple(one(spark, fn.root_cause(causes(("Outer", "o"), ("Inner", "i")), deepest=False))) == ("Outer", "o")
    none = F.array().cast("array<struct<class:string,message:string>>")
    assert tuple(one(spark, fn.root_cause(none))) == (None, None)


def test_auth_mode(spark):
    yes, no = F.lit(True), F.lit(False)
    assert [one(spark, fn.auth_mode("sftp", yes, p, k)) for p, k in ((yes, yes), (yes, no), (no, yes), (no, no))] == [
        "both", "password", "key", "none"]
    assert [one(spark, fn.auth_mode("put", u, p)) for u, p in ((yes, yes), (yes, no), (no, yes))] == [
        "password", "anonymous", "anonymous"]
    assert one(spark, fn.auth_mode("share", yes, no)) == "password"


def test_target_attributes(spark):
    got = one(spark, fn.target_attributes("s3", F.lit("b"), F.lit(None)))
    assert got == {"s3.bucket": "b"}
    got = one(spark, fn.target_attributes("sftp", F.lit("h"), F.lit(22), F.lit("u")))
    assert got == {"sftp.remote.host": "h", "sftp.remote.port": "22", "sftp.listing.user": "u"}


MESSAGES = [
    ('{"id":"a","event":"e"}', "text message", "a"),
    ('{"event":"e","id":"a"}', "text message", "a"),
    (' \n{"id":"a","event":"e"}', "text message", "a"),
    ('{"id":"a","event":"/e"}', "text message", None),
    ("{bad", "text message", None),
    ("hello", "text message", None),
    ("123abc", "text message", None),
    ('{"id":"a","event":"e"', "text message", None),  # truncated
    ("{'id':\"a\",\"event\":\"e\"}", "text message", None),  # single quotes are not JSON
    ('{"id":NaN,"event":"e"}', "text message", None),
    ('{"id":"a"}', "failure", None),
    ('{"event":"e"}', "failure", None),
    ("{}", "failure", None),
    ("[1]", "failure", None),
    ('[{"id":"a","event":"e"}]', "failure", None),
    ('[{"a":1,"a":2}]', "failure", None),
    ("123", "failure", None),
    ('"x"', "failure", None),
    ("null", "failure", None),
    ("", "failure", None),
    ("  ", "failure", None),
    (None, "failure", None),
    ('{"id":null,"event":"e"}', "text message", "null"),
    ('{"id":"a","event":null}', "text message", "a"),
    ('{"id":{"a":1},"event":"e"}', "text message", ""),
    ('{"id":[1],"event":"e"}', "text message", ""),
    ('{"id":"a","event":{"x":1}}', "text message", "a"),
    ('{"id":"{a","event":"e"}', "text message", "{a"),
    ('{"id":"[a","event":"e"}', "text message", "[a"),
    ('{"id":1,"id":2,"event":"e"}', "text message", "2"),  # the last one counts
    ('{"id":"a","event":"e"} trailing', "text message", "a"),
    ('{"id":1.50,"event":true}', "text message", "1.5"),
    ('{"id":2.0,"event":"e"}', "text message", "2.0"),
    ('{"id":true,"event":"e"}', "text message", "true"),
    ('{"id":12345678901234567890,"event":"e"}', "text message", "12345678901234567890"),
    ('{"id":"q\\"\\u00e9","event":"e"}', "text message", 'q\\"é'),
]


def test_message_routes(spark):
    df = spark.createDataFrame([(i, m[0]) for i, m in enumerate(MESSAGES)], "message_id bigint, body string")
    got = route_message(df).orderBy("message_id").collect()
    for row, (body, route, ack) in zip(got, MESSAGES):
        want = None if ack is None else f'{{"event":"ack","msg":"{ack}"}}'
        assert (row["route"], row["ack"], row["body"]) == (route, want, body), body


def test_message_limit_counts_bytes(spark):
    body = '{"id":"ü","event":"e"}'
    size = len(body.encode())
    df = spark.createDataFrame([(1, body)], "message_id bigint, body string")
    assert route_message(df, limit=size).first()["route"] == "text message"
    over = route_message(df, limit=size - 1, with_error=True).first()
    assert (over["route"], over["ack"], over["error_message"], over["body"]) == ("failure", None, "message too large", body)
    plain = route_message(df, limit=size, with_error=True).first()
    assert plain["error_message"] is None


SAMPLE = ('{"id":"a067a663","event":"model.v1.folder.create","client":{"user_id":"u1","connection_id":"c1"},'
          '"msg":{"correlationID":"k","eventKey":"model.v1.folder.create","eventDtm":"2024-04-15T14:54:47.474301733Z",'
          '"source":"s","resourceURI":"","version":0,"data":{"_Id":"4w","_flags":0},"journal":{},'
          '"objectId":"{\\"_uLog\\":\\"L\\",\\"table\\":\\"folder\\"}"}}')


def test_envelope(spark):
    e = one(spark, fn.parse_envelope(F.lit(SAMPLE)))
    assert (e["id"], e["event"], e["client"]["user_id"]) == ("a067a663", "model.v1.folder.create", "u1")
    assert e["msg"]["eventDtm"] == "2024-04-15T14:54:47.474301733Z"  # nanoseconds stay in the text
    assert e["msg"]["data"] == {"_Id": "4w", "_flags": "0"} and e["msg"]["journal"] == {} and e["msg"]["version"] == 0
    assert one(spark, fn.object_id(fn.parse_envelope(F.lit(SAMPLE)))) == {"_uLog": "L", "table": "folder"}


def test_attributes_smb(spark):
    inv = spark.sql("""SELECT 'smb' provider, 'smb://localhost:445/share' container, 'sub/folder' directory, 'test.txt' filename,
        'sub/folder/test.txt' full_path, 456L size, timestamp_millis(1704067201999) last_modified, false is_directory,
        CAST(NULL AS STRING) etag, map('shortName', 'test.txt', 'allocationSize', '512', 'creationTime', '2024-01-01T00:00:00') extra""")
    got = inv.select(fn.to_attributes("smb").alias("a")).first()["a"]
    assert got == {"filename": "test.txt", "shortName": "test.txt", "path": "sub/folder", "serviceLocation": "smb://localhost:445/share",
                   "lastModifiedTime": "2024-01-01T00:00:01", "creationTime": "2024-01-01T00:00:00", "size": "456", "allocationSize": "512"}


def test_attributes_s3_keeps_tags(spark):
    inv = spark.sql("""SELECT 's3' provider, 'b' container, 'k' directory, 'f' filename, 'k/f' full_path, 1L size,
        timestamp_millis(5) last_modified, false is_directory, 'e' etag,
        map('s3.tag.team', 'x', 's3.user.metadata.m', 'y', 'region', 'eu', 'other', 'z') extra""")
    got = inv.select(fn.to_attributes("s3").alias("a")).first()["a"]
    assert got == {"filename": "k/f", "s3.bucket": "b", "s3.region": "eu", "s3.etag": "e", "s3.lastModified": "5", "s3.length": "1",
                   "s3.tag.team": "x", "s3.user.metadata.m": "y"}


