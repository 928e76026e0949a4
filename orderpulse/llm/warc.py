"""WARC archives of pages, and a two-level index by which single captures are read.

Each task writes its pages into archive files of its own, a gzip member for each record, and
gives one row for each record with file, offset and length. Only those rows make a file count:
what a lost task leaves behind is named by none. Of pages with the same payload the one with the
largest id is a response, the others are revisits that name it and hold no payload.

The index has the captures sorted by their URL with the host reversed (com,example,www)/path),
then by page id. Blocks of some thousand lines are compressed one by one; the directory has the
first line of each block and where it lies, one row for many captures. A lookup finds the part
of the directory that holds a key in a bounded sample of it, the block by binary search in that
part, reads the one block, finds the capture by binary search in its lines, and reads the range
of the archive that holds the record.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from orderpulse.llm.common import saved, slices

#: Bytes of an archive file and of a range that is read by one task, about.
FILE, RANGE = 64 << 20, 32 << 20
#: Lines of an index block, and rows of the directory's sample at most (and one for each file).
LINES, TOP = 2048, 65536
#: Tasks that read archives at most, and captures that one task fetches one by one, about.
READERS, FETCHES = 50_000, 4096
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
#: In place of a page id that is null: it sorts before all others.
NO_ID = -(1 << 63)
LEVEL = 6

CAPTURE = "key string, page_id long, file string, offset long, length long, record_type string"
RECORD = ("page_id long, record_type string, uri string, payload_bytes long, "
          "payload_digest string, refers_to long, refers_to_uri string")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file that all executors reach."""
    return fs.FileSystem.from_uri(path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def uri_of(url: str | None, page_id: int | None) -> str:
    """The URL with all that a header can't hold escaped; a page without one has a name."""
    if not url:
        return name_of(page_id)
    return quote(url, safe="!#$%&'()*+,-./:;=?@[]_~|")


def name_of(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def id_of(name: str) -> int | None:
    number = name.strip("<>").removeprefix("urn:page:")
    return int(number) if number else None


def key_of(uri: str) -> str:
    """Sort key of an escaped URL: host labels from the last to the first, then path and query.
    The scheme, a user name and a standard port don't count; a URI without host is its own key."""
    try:
        parts = urlsplit(uri)
        host, port = parts.hostname, parts.port
    except ValueError:
        return uri
    if not host:
        return uri
    port = "" if port in (None, 80, 443) else f":{port}"
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(host.strip(".").split(".")[::-1]) + f"{port}){rest}"


def record_of(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
              refers_to_url: str | None, revisit: bool) -> bytes:
    """One WARC record, not compressed."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {REVISIT if revisit else RESPONSE}",
            f"WARC-Record-ID: <{name_of(page_id)}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {uri_of(url, page_id)}",
            f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{name_of(refers_to)}>",
                 f"WARC-Refers-To-Target-URI: {uri_of(refers_to_url, refers_to)}",
                 f"WARC-Refers-To-Date: {DATE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, with names in lower case, and the payload behind the HTTP headers."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = {n.lower(): v for n, v in (line.split(": ", 1) for line in lines[1:])}
    block = rest[:int(named["content-length"])]
    if len(block) != int(named["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"a record of {named.get('warc-record-id')} is cut off")
    return named, block.partition(b"\r\n\r\n")[2]


def row_of(record: bytes) -> tuple:
    """The columns of RECORD; those of a payload are null for a revisit."""
    head, payload = parsed(record)
    own = id_of(head["warc-record-id"]), head["warc-type"], head["warc-target-uri"]
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == REVISIT:
        return *own, None, digest, id_of(head["warc-refers-to"]), head["warc-refers-to-target-uri"]
    if digest_of(payload) != digest:
        raise ValueError(f"the payload of {head['warc-record-id']} does not have its digest")
    return *own, len(payload), digest, None, None


def judged(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, refers_to_url, revisit) of every page.

    Of pages with the same payload of at least ``least`` bytes the one with the largest page_id
    is the response. Where no page of them has an id, all are responses, as are repeated rows of
    the largest id. Groups of copies are counted without their payloads.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        payload.alias("payload")).withColumn("same", F.sha2("payload", 256))
    copied = saved(rows.filter(F.length("payload") >= least).groupBy("same").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("page_id").isNotNull(), F.struct(
            "page_id", "url"))).alias("first")).filter("n > 1 and first is not null").select(
        "same", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")),
        "copied")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(copied, "same", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("first_id")).alias("refers_to"),
        F.when(revisit, F.col("first_url")).alias("refers_to_url"), revisit.alias("revisit"))


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        stream, name, rows = None, "", []

        def done() -> pa.RecordBatch:
            stream.close()
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                [c.split()[0] for c in CAPTURE.split(", ")])

        for part in slices(batches):
            for page_id, url, payload, refers, refers_url, revisit in zip(
                    *(c.to_pylist() for c in part.columns)):
                if stream is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    stream, rows = store.open_output_stream(f"{root}/{name}", compression=None), []
                member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = member.compress(record_of(page_id, url, payload, refers, refers_url,
                                                 revisit)) + member.flush()
                rows.append((key_of(uri_of(url, page_id)), page_id, name, stream.tell(), len(data),
                             REVISIT if revisit else RESPONSE))
                stream.write(data)
                if stream.tell() >= FILE:
                    yield done()
                    stream = None
        if stream is not None:
            yield done()
    return run


def _members(stream, length: int) -> Iterator[bytes]:
    """Contents of the gzip members in the next ``length`` bytes of a stream."""
    data = b""
    while data or length:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if not data:
                data = stream.read(min(length, 1 << 16))
                length -= len(data)
                if not data:
                    raise ValueError("an archive ends within a record")
            parts.append(member.decompress(data))
            data = member.unused_data
        yield b"".join(parts)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      [c.split()[0] for c in RECORD.split(", ")])


def _reader(folder: str):
    """Rows of (file, offset, length), which hold whole records, to those of RECORD."""
    def run(batches):
        store, root = _open(folder)
        for batch in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(f"{root}/{file}") as stream:
                    stream.seek(offset)
                    rows = []
                    for record in _members(stream, length):
                        rows.append(row_of(record))
                        if len(rows) == 1024:
                            yield _record_batch(rows)
                            rows = []
                    if rows:
                        yield _record_batch(rows)
    return run


def _blocks(folder: str, size: int):
    """Sorted captures to compressed blocks in a file of the task, and the directory's rows."""
    def run(batches):
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        name, stream, lines, out, nth = f"index-{uuid.uuid4().hex}.gz", None, [], [], 0

        def block():
            nonlocal stream, lines, nth
            if stream is None:
                stream = store.open_output_stream(f"{root}/{name}", compression=None)
            data = zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode())
            out.append((name, nth, lines[0][0], lines[0][1], stream.tell(), len(data)))
            stream.write(data)
            lines, nth = [], nth + 1

        for batch in batches:
            for key, page_id, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append((key, NO_ID if page_id is None else page_id, *rest))
                if len(lines) == size:
                    block()
        if lines:
            block()
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [
                "file", "nth", "first_key", "first_id", "offset", "length"])
    return run


def _places(first: list[tuple[str, int]], line: tuple[str, int]) -> range:
    """Numbers of the blocks that can hold a line, by the sorted first lines of all blocks."""
    return range(max(0, bisect.bisect_left(first, line) - 1), bisect.bisect_right(first, line))


def _find(folder: str):
    """Asked (key, page_id) and the part of the directory that can have them, to captures."""
    def run(asked: pa.Table, directory: pa.Table) -> pa.Table:
        store, root = _open(folder)
        found: list[tuple] = []
        rows = sorted(zip(*(directory[c].to_pylist() for c in (
            "first_key", "first_id", "file", "offset", "length"))))
        first, at, lines, starts = [r[:2] for r in rows], -1, [], []
        for line in sorted(set(zip(asked["key"].to_pylist(), asked["page_id"].to_pylist()))):
            for block in _places(first, line):
                if block != at:  # the asked are sorted, so a block stays while it is needed
                    file, offset, length = rows[block][2:]
                    with store.open_input_file(f"{root}/{file}") as stream:
                        data = zlib.decompress(stream.read_at(length, offset))
                    lines = [(k, int(i), *rest) for k, i, *rest in
                             (x.split("\t") for x in data.decode().split("\n"))]
                    at, starts = block, [x[:2] for x in lines]
                for key, page_id, file, offset, length, kind in lines[
                        bisect.bisect_left(starts, line):bisect.bisect_right(starts, line)]:
                    found.append((key, None if page_id == NO_ID else page_id, file, int(offset),
                                  int(length), kind))
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*found)) or [()] * len(kinds)
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)],
                        [c.split()[0] for c in CAPTURE.split(", ")])
    return run


@dataclass
class Archive:
    """Archives below a folder that all executors share, and their index."""

    root: str
    captures: DataFrame
    directory: DataFrame

    @classmethod
    def write(cls, pages: DataFrame, root: str, least: int = 0, lines: int = LINES) -> Archive:
        """Write a record for each row of ``pages`` (page_id, url, html), and the index in blocks
        of so many lines.

        A null html is an empty payload, a null or empty url the name of the page. Repeated rows
        are records of their own; an empty table gives no file. Other columns aren't looked at.
        """
        captures = saved(judged(pages, least).mapInArrow(_writer(f"{root}/archive"), CAPTURE),
                         "captures")
        order = ["key", "page_id", "file", "offset"]
        sorted_ = captures.repartitionByRange(*order).sortWithinPartitions(*order)
        directory = saved(sorted_.mapInArrow(
            _blocks(f"{root}/index", lines), "file string, nth long, first_key string, first_id long, "
            "offset long, length long"), "directory")
        return cls(root, captures, directory)

    def records(self) -> DataFrame:
        """RECORD rows of all records, read from the archives range by range."""
        ranges = saved(self.captures.groupBy("file", F.floor(F.col("offset") / RANGE).alias("nth"))
                       .agg(F.min("offset").alias("offset"), F.sum("length").alias("length")),
                       "ranges").select("file", "offset", "length")
        # The rows are few and short, so Spark would give them all to one task.
        tasks = max(1, min(ranges.count(), READERS))
        return ranges.repartition(tasks).mapInArrow(_reader(f"{self.root}/archive"), RECORD)

    def lookup(self, asked: DataFrame) -> DataFrame:
        """The captures (CAPTURE) of distinct (key, page_id); those that aren't there give no
        row. The driver holds TOP rows of the directory and one for each index file, and a task
        the part of the directory between two of them."""
        stride = -(-self.directory.count() // TOP) or 1
        top = sorted((r.first_key, r.first_id, r.file, r.part) for r in self.directory.filter(
            F.col("nth") % stride == 0).select("first_key", "first_id", "file", (
                F.col("nth") / stride).cast("long").alias("part")).collect())
        first = [t[:2] for t in top]

        def slot(batches):
            for batch in batches:
                found = [(*x, *top[p][2:]) for x in zip(*(c.to_pylist() for c in batch.columns))
                         for p in _places(first, x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(list(zip(*found)) or [()] * 4, (
                        pa.string(), pa.int64(), pa.string(), pa.int64()))],
                    ["key", "page_id", "file", "part"])

        wanted = asked.select("key", F.coalesce("page_id", F.lit(NO_ID)).alias("page_id"))
        dealt = wanted.distinct().mapInArrow(
            slot, "key string, page_id long, file string, part long")
        parts = self.directory.withColumn("part", (F.col("nth") / stride).cast("long"))
        return dealt.groupBy("file", "part").cogroup(parts.groupBy("file", "part")).applyInArrow(
            _find(f"{self.root}/index"), CAPTURE)

    def fetch(self, captures: DataFrame) -> DataFrame:
        """RECORD rows of single captures, by range reads of the archives."""
        wanted = saved(captures.select("file", "offset", "length"), "fetch")
        tasks = max(1, min(-(-wanted.count() // FETCHES), READERS))
        return wanted.repartition(tasks).mapInArrow(_reader(f"{self.root}/archive"), RECORD)

    def payloads(self) -> DataFrame:
        """RECORD rows of all records; revisits have the size and the digest of the payload that
        they refer to, found through the index."""
        records = saved(self.records(), "records")
        revisits = records.filter(F.col("record_type") == REVISIT)
        key = F.arrow_udf(_keys, "string")
        asked = revisits.select("refers_to", "refers_to_uri").distinct().select(
            key("refers_to_uri").alias("key"), F.col("refers_to").alias("page_id"))
        there = self.fetch(self.lookup(asked)).select(
            F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("bytes"),
            F.col("payload_digest").alias("digest")).distinct()
        full = revisits.withColumnRenamed("payload_digest", "digest").join(
            there, ["refers_to", "digest"]).select(
            "page_id", "record_type", "uri", F.col("bytes").alias("payload_bytes"),
            F.col("digest").alias("payload_digest"), "refers_to", "refers_to_uri")
        return records.filter(F.col("record_type") == RESPONSE).union(full)


def _keys(uris: pa.Array) -> pa.Array:
    return pa.array([key_of(u) for u in uris.to_pylist()], pa.string())
