"""WARC archives and their index: round trips, odd pages, look-ups against plain search."""

import base64
import gzip
import hashlib
import random

import oracle
import pytest
from orderpulse.llm import warc
from orderpulse.llm.queries import OP13_SQL, op13_warc

PAGES = "page_id long, url string, html string, file string, key int"


def odd_pages():
    rng = random.Random(9)
    hosts = ["www.example.com", "a.b.example.org", "EXAMPLE.com:8080", "user:pw@example.net", "x.y"]
    bodies = [f"<p>{n} é\U0001f600\r\n\r\n</p>" * n for n in range(1, 12)]
    rows = [(n, f"http://{rng.choice(hosts)}/{rng.randrange(9)}?q={rng.randrange(3)}",
             rng.choice(bodies) + rng.choice(["", str(n)])) for n in range(300)]
    rows += [(1000 + n, "http://hot.example.com/", "copy") for n in range(200)]  # one URL and body
    rows += [(2000, None, "no url"), (2001, "", "empty url"), (2002, "http://e.com/", None),
             (2003, "http://e.com/", ""), (2004, "not a url\r\nWARC-Type: x\t\x00", "odd"),
             (2005, "http://[bad/", "bad"), (2006, "http://é.com/ü ", "wide"),
             (2007, "http://e.com/long", "long " * 400_000), (-5, "http://e.com/minus", "less")]
    rows += [(3000, "http://r.com/", "again"), (3000, "http://r.com/", "again"),
             (3000, "http://r.com/", "other"), (2999, "http://r.com/", "other"),
             (2998, "http://r.com/", "again")]
    rows += [(None, "http://n.com/", "nobody"), (None, "http://n.com/", "nobody"),
             (None, "http://n.com/", "copy")]
    return rows


def plain(rows, least=0):
    top = {}
    for page_id, _, html in rows:
        if page_id is not None:
            top[html or ""] = max(page_id, top.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = top.get(html or "", page_id) if len(data) >= least else page_id
        out.append((page_id, len(data), digest, "response" if page_id == first else "revisit",
                    None if page_id == first else first))
    return sorted(out, key=str)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in odd_pages()], PAGES).repartition(3)


@pytest.fixture(scope="module")
def archive(pages, tmp_path_factory):
    return warc.Archive.write(pages, str(tmp_path_factory.mktemp("warc")), lines=16)


def test_round_trip(archive):
    assert sorted(map(tuple, archive.payloads().select(*COLUMNS).collect()), key=str) == plain(
        odd_pages())


def test_least_bytes(pages, tmp_path):
    found = warc.Archive.write(pages, f"file://{tmp_path}", least=100).payloads()
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=str) == plain(odd_pages(), 100)


def test_query_as_sql(spark, tmp_path):
    rows = [(i, u, h, "x", 1) for i, u, h in odd_pages() if i is not None and i != 3000]
    spark.createDataFrame(rows, PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    con = oracle.duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM read_parquet("
                f"'{tmp_path}/pages.parquet/*.parquet')")
    assert oracle.compare(op13_warc(spark, str(tmp_path)), con, OP13_SQL) == ""


@pytest.mark.parametrize("top", [65536, 3])
def test_every_capture_is_found(spark, archive, monkeypatch, top):
    monkeypatch.setattr(warc, "TOP", top)
    captures = [tuple(r) for r in archive.captures.collect()]
    missing = [("com,example,www)/nowhere", 1), ("", None), ("zz", 5), ("com,example,hot)/", 7)]
    asked = spark.createDataFrame([c[:2] for c in captures] + missing, "key string, page_id long")
    assert sorted(map(tuple, archive.lookup(asked).collect()), key=str) == sorted(captures, key=str)


def test_directory_is_sparse_and_sorted(archive):
    captures = archive.captures.count()
    rows = archive.directory.collect()
    assert len(rows) <= captures // 16 + archive.directory.select("file").distinct().count()
    for file in {r.file for r in rows}:
        own = [(r.first_key, r.first_id) for r in sorted(rows, key=lambda r: r.nth) if r.file == file]
        assert own == sorted(own)


def test_files_are_warc(archive):
    """Any gzip reader sees whole records, one after another."""
    row = archive.captures.orderBy("file", "offset").first()
    with gzip.open(f"{archive.root}/archive/{row.file}") as stream:
        text = stream.read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")
    assert text.count(b"WARC/1.1\r\n") == archive.captures.filter(
        archive.captures.file == row.file).count()


def test_lost_tasks_leave_nothing(archive):
    """A file that no row names is not read."""
    with open(f"{archive.root}/archive/pages-lost.warc.gz", "wb") as lost:
        lost.write(b"\x1f\x8b half a record")
    assert archive.records().count() == len(odd_pages())


def test_damage_is_seen(tmp_path):
    record = warc.record_of(1, "http://e.com/", b"body", None, None, False)
    assert warc.row_of(record)[:2] == (1, "response")
    for wrong in (record.replace(b"body", b"bode"), record[:-5], b"x" + record):
        with pytest.raises(ValueError):
            warc.row_of(wrong)


def test_keys():
    for url, key in (("http://www.Example.com/a?b=1#c", "com,example,www)/a?b=1"),
                     ("https://user:pw@example.com:443", "com,example)/"),
                     ("http://example.com:8080/", "com,example:8080)/"),
                     ("http://example.com./x", "com,example)/x"), ("urn:page:7", "urn:page:7")):
        assert warc.key_of(warc.uri_of(url, 7)) == key
    assert warc.uri_of("a\r\nb \t", 1) == "a%0D%0Ab%20%09" and warc.uri_of(None, 3) == "urn:page:3"


def test_empty(spark, tmp_path):
    archive = warc.Archive.write(spark.createDataFrame([], PAGES), str(tmp_path))
    assert archive.payloads().collect() == [] and archive.records().collect() == []
