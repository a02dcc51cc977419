"""WARC archives: written as one gzip stream, normalised to one gzip member per record, read by offset.

A file that was compressed as a whole can only be read from its beginning.  The
normaliser inflates such a stream once, piece by piece, writes every record as a
gzip member of its own into a new archive, and beside it an index with the
offset and length of each member.  Records can then be read alone.  On the way,
records whose payload another record has become revisits of it: which ones,
Spark decides from the digests, before the streams are inflated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import SMALL, table
from tidemark.llm.registry import query
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import open_store, shared_dir, stage, task_count

#: Bytes of records after which a task begins a new archive, bytes that are held at a time, and gzip levels.
FILE_BYTES, PIECE, WHOLE_LEVEL, MEMBER_LEVEL = 64 * 1024 * 1024, 1024 * 1024, 1, 6

# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

WRITTEN = "archive string, record int, page_id bigint, url string, payload_bytes bigint, payload_digest string"
ARCHIVES = "archive string, index string, records int"
RECORDS = ("archive string, offset bigint, length bigint, record_type string, page_id bigint, refers_to bigint, url string, "
           "payload_bytes bigint, payload_digest string, payload binary")


def _digest(data: bytes) -> str:
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(archive: str, record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{record}')}>"


def _one_line(value: str) -> str:
    """A header value: line ends and percent signs written as percent codes."""
    for c in "%\r\n\0":
        value = value.replace(c, f"%{ord(c):02X}")
    return value


def _plain(value: str) -> str:
    for c in "\0\n\r%":
        value = value.replace(f"%{ord(c):02X}", c)
    return value


def _head(fields: dict[str, str], http: bytes, payload_bytes: int) -> bytes:
    """A record up to its payload: WARC fields, then the HTTP head."""
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    lines.append(f"Content-Length: {len(http) + payload_bytes}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + END + http


def _http(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}".encode() + END


class _Inflated:
    """A gzip stream of one or more members, read forward; holds one piece of it."""

    def __init__(self, file):
        import zlib

        self.file, self.zlib, self.data, self.at = file, zlib, b"", 0
        self.inflate, self.rest = zlib.decompressobj(31), b""

    def _more(self) -> bool:
        while True:
            if not self.rest:
                self.rest = self.file.read(PIECE)
                if not self.rest:
                    if not self.inflate.eof:
                        raise ValueError("the gzip stream ends early")
                    return False
            if self.inflate.eof:
                self.inflate = self.zlib.decompressobj(31)
            out = self.inflate.decompress(self.rest, PIECE)
            self.rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                self.data, self.at = self.data[self.at:] + out, 0
                return True

    def _take(self, size: int) -> bytes:
        out = self.data[self.at:self.at + size]
        self.at += len(out)
        return out

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with a mark; None at the end of the stream."""
        while (found := self.data.find(mark, self.at)) < 0:
            if not self._more():
                if self.at < len(self.data):
                    raise ValueError("the archive ends within a record")
                return None
        return self._take(found + len(mark) - self.at)

    def pieces(self, size: int):
        """The next ``size`` bytes, piece by piece."""
        while size:
            if self.at == len(self.data) and not self._more():
                raise ValueError("the archive ends within a record")
            out = self._take(size)
            size -= len(out)
            yield out


def _fields(head: bytes) -> dict[str, str]:
    lines = head[:-len(END)].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(line.split(": ", 1) for line in lines[1:])


def write_archives(pages: DataFrame, root: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a response record per page, each archive one gzip stream; the rows written, staged.

    Archives have names of their own in every attempt of a task, and only those
    of attempts that came to an end are among the rows, so a repeated task does
    no harm.  ``archive`` and ``record`` (its place, from 0) name a record.
    """
    def run(batches):
        import gzip

        fs, top = open_store(root)
        fs.create_dir(top, recursive=True)
        name, raw, out, record, size = None, None, None, 0, 0
        for batch in batches:
            done = []
            for page, url, html in zip(*[batch[c] for c in ("page_id", "url", "html")]):
                if out is None:
                    name, record, size = f"{top}/{uuid.uuid4().hex}.whole.warc.gz", 0, 0
                    raw = fs.open_output_stream(name, compression=None)
                    out = gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=WHOLE_LEVEL, mtime=0)
                page, url = page.as_py(), url.as_py()
                payload = b"" if (buffer := html.as_buffer()) is None else buffer.to_pybytes()
                digest, http = _digest(payload), _http(len(payload))
                head = _head({
                    "WARC-Type": "response", "WARC-Record-ID": _id(name, record), "WARC-Date": "1970-01-01T00:00:00Z",
                    "WARC-Target-URI": None if url is None else _one_line(url), "WARC-Page-ID": None if page is None else str(page),
                    "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response"}, http, len(payload))
                for part in (head, payload, END):
                    out.write(part)
                done.append((name, record, page, url, len(payload), digest))
                record, size = record + 1, size + len(head) + len(payload)
                if size >= file_bytes:
                    out.close()
                    raw.close()
                    out = None
            if done:
                yield _batch(done, WRITTEN)
        if out is not None:
            out.close()
            raw.close()

    slim = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return stage(slim.mapInArrow(run, WRITTEN), "archives-written")


def _batch(rows: list[tuple], ddl: str):
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    parts = [part.split() for part in ddl.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in parts]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, parts)], names=[n for n, _ in parts])


def revisits(written: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The records that revisit another: ``archive``, ``record``, and the record that they refer to.

    Of records with equal payloads of at least ``min_bytes`` the one with the
    smallest ``page_id`` (null last; ties by url, then by place) is the response.
    Payloads are compared by digest and length.  Digests that stand once are
    gone after the first, map-side reduced, aggregation.
    """
    same = ["payload_digest", "payload_bytes"]
    # Structs put nulls first; these flags put them last.
    order = F.struct(F.col("page_id").isNull().alias("_n"), "page_id", F.col("url").isNull().alias("_m"), "url", "archive", "record")
    large = written.where(F.col("payload_bytes") >= min_bytes)
    first = stage(large.groupBy(*same).agg(F.count(F.lit(1)).alias("_count"), F.min(order).alias("_first")).where("_count > 1").select(
        *same, F.col("_first.page_id").alias("to_page"), F.col("_first.url").alias("to_url"),
        F.col("_first.archive").alias("to_archive"), F.col("_first.record").alias("to_record")), "payloads")
    return (join_checked(large, first, same, limit=SMALL)
            .where("archive <> to_archive OR record <> to_record")
            .select("archive", "record", "to_page", "to_url", "to_archive", "to_record"))


def normalise_archives(archives: DataFrame, revisited: DataFrame | None = None, level: int = MEMBER_LEVEL) -> DataFrame:
    """Rewrite archives (column ``archive``) with one gzip member per record, each with an index beside it.

    Every stream is inflated once and never held whole, whatever the length of
    its records.  Records named in ``revisited`` lose their payload and refer to
    the other record.  Returns ``archive``, ``index`` and the number of records
    of the new ones, staged.  The index has a line per record: offset, length,
    type, record id, payload digest, target URI.
    """
    spark = archives.sparkSession
    what = "archive string, record int, to_page bigint, to_url string, to_archive string, to_record int"
    tagged = archives.select("archive", *[F.lit(None).cast(part.split()[1]).alias(part.split()[0]) for part in what.split(", ")[1:]])
    if revisited is not None:
        tagged = tagged.union(revisited.select(tagged.columns))
    tagged = stage(tagged, "archives-revisited")  # as a table, so that Spark deals archives to as many tasks as asked for

    def run(batches):
        name, marked, done = None, {}, []
        for batch in batches:
            for archive, record, *to in zip(*[c.to_pylist() for c in batch.columns]):
                if name is not None and archive != name:
                    done.append(_normalise(name, marked, level))
                    marked = {}
                name = archive
                if record is not None:
                    marked[record] = to
        if name is not None:
            done.append(_normalise(name, marked, level))
        if done:
            yield _batch(done, ARCHIVES)

    spread = tagged.repartition(task_count(spark), "archive").sortWithinPartitions("archive")
    return stage(spread.mapInArrow(run, ARCHIVES), "archives-normalised")


def _normalise(archive: str, marked: dict[int, list], level: int) -> tuple[str, str, int]:
    import zlib

    fs, path = open_store(archive)
    stem = f"{path.removesuffix('.gz').removesuffix('.warc').removesuffix('.whole')}-{uuid.uuid4().hex[:8]}"
    names, at, record = (f"{stem}.warc.gz", f"{stem}.index"), 0, 0
    with fs.open_input_stream(path, compression=None) as file, fs.open_output_stream(names[0], compression=None) as out, \
            fs.open_output_stream(names[1], compression=None) as index:
        stream = _Inflated(file)
        while (head := stream.until(END)) is not None:
            fields, length = _fields(head), 0
            size, to, pack = int(fields["Content-Length"]), marked.get(record), zlib.compressobj(level, zlib.DEFLATED, 31)
            if to is not None:
                page, url, source, number = to
                fields |= {"WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _id(source, number)}
                fields |= {} if url is None else {"WARC-Refers-To-Target-URI": _one_line(url)}
                fields |= {} if page is None else {"WARC-Refers-To-Page-ID": str(page)}
                http = b"".join(_upto(stream, size, END))  # the HTTP head stays and tells the payload's length
                del fields["Content-Length"]
                parts = iter([_head(fields, http, 0)])
            else:
                parts = (part for source in ([head], stream.pieces(size)) for part in source)
            for part in parts:
                length += out.write(pack.compress(part))
            length += out.write(pack.compress(END) + pack.flush())
            if b"".join(stream.pieces(len(END))) != END:
                raise ValueError("a record of the archive is longer than it says")
            index.write("\t".join([str(at), str(length), fields["WARC-Type"], fields["WARC-Record-ID"],
                                   fields.get("WARC-Payload-Digest", "-"), fields.get("WARC-Target-URI", "-")]).encode() + b"\n")
            at, record = at + length, record + 1
    return (*names, record)


def _upto(stream: _Inflated, size: int, mark: bytes):
    """The bytes up to a mark within the next ``size``; what follows it is passed over."""
    kept, found = b"", False
    for part in stream.pieces(size):
        if not found:
            kept += part
            found = mark in kept
    yield kept[:kept.index(mark) + len(mark)]


def read_index(archives: DataFrame) -> DataFrame:
    """The records of normalised archives by their indexes: ``archive``, ``offset``, ``length``, ``record_type``."""
    def run(batches):
        for batch in batches:
            for archive, index in zip(batch["archive"].to_pylist(), batch["index"].to_pylist()):
                fs, path = open_store(index)
                with fs.open_input_stream(path, compression=None) as file:
                    rest = b""
                    while piece := file.read(PIECE):
                        *lines, rest = (rest + piece).split(b"\n")
                        cut = [line.split(b"\t", 3)[:3] for line in lines]
                        yield _batch([(archive, int(o), int(n), kind.decode()) for o, n, kind in cut],
                                     "archive string, offset bigint, length bigint, record_type string")

    spread = archives.select("archive", "index").repartition(task_count(archives.sparkSession), "archive")
    return spread.mapInArrow(run, "archive string, offset bigint, length bigint, record_type string")


def fetch_records(found: DataFrame, payloads: bool = True) -> DataFrame:
    """Read records, given by ``archive``, ``offset`` and ``length``, each alone.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload: of a
    response counted again from what is read, of a revisit as its record says.
    Without ``payloads`` the column is null.
    """
    def run(batches):
        name, file, size = None, None, 0
        for batch in batches:
            done = []
            for archive, offset, length in zip(*[batch[c].to_pylist() for c in ("archive", "offset", "length")]):
                if archive != name:
                    if file is not None:
                        file.close()
                    fs, path = open_store(archive)
                    name, file = archive, fs.open_input_file(path)
                done.append((archive, offset, length, *_parse(file.read_at(length, offset), payloads)))
                size += len(done[-1][-1] or b"")
                if size >= PIECE:
                    yield _batch(done, RECORDS)
                    done, size = [], 0
            if done:
                yield _batch(done, RECORDS)
        if file is not None:
            file.close()

    return found.select("archive", "offset", "length").mapInArrow(run, RECORDS)


def _parse(member: bytes, payloads: bool) -> tuple:
    import gzip

    data = gzip.decompress(member)
    cut = data.index(END) + len(END)
    fields = _fields(data[:cut])
    body = cut + data[cut:cut + PIECE].index(END) + len(END)
    payload = data[body:cut + int(fields["Content-Length"])]
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        if _digest(payload) != stated:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
        size = len(payload)
    else:
        http = dict(line.split(": ", 1) for line in data[cut:body - len(END)].decode().split("\r\n")[1:])
        size = int(http["Content-Length"])
    page, to = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
    url = fields.get("WARC-Target-URI")
    return (fields["WARC-Type"], None if page is None else int(page), None if to is None else int(to),
            None if url is None else _plain(url), size, stated, payload if payloads else None)


def archive_pages(pages: DataFrame, root: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Pages (``page_id``, ``url``, ``html``) as normalised archives: ``archive``, ``index``, ``records``.

    A null html is an empty payload, a null url or ``page_id`` a record without
    it; rows that repeat are records of their own, and revisits of the first.
    Among equal payloads the smallest ``page_id`` (null last) is the response;
    ties go by url, then by place.  A page must fit in a task's memory, as any value
    of a row must; streams pass in pieces.  Other columns are not looked at, and an
    empty table gives no archive.
    ``root`` is a folder that all executors share.
    """
    root = root or f"{shared_dir(pages.sparkSession)}/archives/{pages.sparkSession.sparkContext.applicationId}-{uuid.uuid4().hex}"
    written = write_archives(pages, root)
    return normalise_archives(written.select("archive").distinct(), revisits(written, min_bytes))


OP11_SQL = r"""
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h, url FROM pages
), coded AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1, 1)), '') AS payload_digest
  FROM sized
), placed AS (
  SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS first FROM coded
  WINDOW same AS (PARTITION BY h, payload_bytes ORDER BY page_id NULLS LAST, url NULLS LAST)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first END AS refers_to
FROM placed
"""


@query("op11_warc", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fetch_records(read_index(archive_pages(table(spark, sf_dir, "pages"))), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
