import hashlib
import zlib

import duckdb
import pytest

from casebook.llm import warc
from casebook.llm.queries import op2


def expected(rows):
    last = {}
    for i, t in rows:
        data = (t or "").encode()
        if len(data) >= 1000 and i is not None:
            last[data] = max(last.get(data, i), i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        to = last.get(data) if i is not None and i < last.get(data, i) else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_query(spark, sf):
    rows = duckdb.sql(f"select page_id, html from '{sf}/pages.parquet'").fetchall()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op2(spark, sf).collect()]
    assert sorted(got, key=str) == expected(rows)


ROWS = [
    (1, "http://a/", "x" * 1200),
    (2, None, "x" * 1200),
    (3, "http://a/ b\r\nc", "x" * 1200),
    (4, "http://a/é", "y" * 999),
    (5, "u", "y" * 999),
    (6, "u", None),
    (7, "u", ""),
    (8, "u", "ü\r\n\r\nWARC/1.1\r\n" * 100),
    (9, "u", "ü\r\n\r\nWARC/1.1\r\n" * 100),
    (9, "u", "ü\r\n\r\nWARC/1.1\r\n" * 100),
    (None, "u", "x" * 1200),
    (10, "u", "long " * 400_000),
]


@pytest.fixture
def index(spark, frame):
    return warc.write_archives(frame(ROWS, "page_id long, url string, html string").repartition(3))


def test_round_trip(index):
    got = warc.read_records(index).collect()
    facts = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(facts, key=str) == expected([(i, t) for i, _, t in ROWS])
    texts = {(r.id, bytes(r.payload).decode()) for r in got if r.record_type == "response"}
    assert texts == {(i, t or "") for i, _, t in ROWS if i not in (1, 2, 8)}
    assert {r.url for r in got if r.id == 3} == {"http://a/%20b%0D%0Ac"}


def test_selected_records_in_few_ranges(index):
    one = index.filter("id in (4, 8)")
    assert sorted(r.id for r in warc.read_records(one.union(one)).collect()) == [4, 8]
    files = index.select("file").distinct().count()
    assert warc.ranges(index).count() == files
    assert warc.ranges(index, gap=0, size=1).count() == len(ROWS)


def test_archives_are_gzip_members(index):
    row = index.filter("id = 4").first()
    with open(row.file.removeprefix("file:"), "rb") as file:
        file.seek(row.offset)
        data = zlib.decompress(file.read(row.length), 31)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"y\r\n\r\n")


def test_damage_is_an_error():
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.parse(data)[1] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r", b"payloat\r"))


def test_empty_table(spark, frame):
    index = warc.write_archives(frame([], "page_id long, url string, html string"))
    assert warc.read_records(index).collect() == []
