"""Archives: round trip, global order, revisits, the SQL."""

import base64
import hashlib
import random

from conftest import SF
from oracle import compare, connect

from tallycast.llm.queries import ORACLES, QUERIES
from tallycast.llm.warc import LoserTree, archive_pages, order_of, url_key
from tallycast.session import scratch_path

PAGES = "page_id long, url string, html string, file string, part int, same string"


def test_loser_tree():
    r = random.Random(1)
    for _ in range(200):
        runs = [
            sorted(
                ({"urlkey": r.choice("abc"), "captured": r.randint(0, 5), "page_id": r.choice([None, 1, 2]), "file": "f", "record_start": r.randint(0, 99)} for _ in range(r.randint(0, 6))),
                key=order_of,
            )
            for _ in range(r.randint(0, 7))
        ]
        assert [order_of(e) for e in LoserTree(runs)] == sorted(order_of(e) for x in runs for e in x)


def test_url_key():
    assert url_key("https://www.Ab.example.com:8080/X?q=1#top") == "com,example,ab:8080)/x?q=1"
    assert url_key("http://a.b") == "b,a)/" and url_key(None) == ")/" and url_key("http://[bad") == "http://[bad"


def test_query_and_sql(spark):
    assert compare(QUERIES["op10_warc"](spark, SF), connect(SF), ORACLES["op10_warc"]) == []


def rows(spark, data):
    return spark.createDataFrame([(*x, "f", 1, "s") for x in data], PAGES)


def test_round_trip_in_global_order(spark):
    data = [
        (1, "http://b.com/", "<p>one</p>"), (2, "http://a.com/", "<p>one</p>"), (3, "http://a.com/", "é\r\n\r\nWARC/1.1\r\n"),
        (4, None, None), (5, "http://a.com/\nX: y", ""), (6, "http://a.com/", "x" * 300_000), (7, "http://b.com/", "<p>one</p>"),
        (7, "http://b.com/", "<p>one</p>"), (None, "http://c.com/", "<p>one</p>"), (None, "http://c.com/", "only"),
    ] + [(100 + i, "http://hot.com/", f"{i % 3}") for i in range(60)]
    last = {}
    for i, _, html in data:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    want = []
    for i, _, html in data:
        raw = (html or "").encode()
        first = last.get(html or "")
        again = first is not None and i != first
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    got = archive_pages(rows(spark, data), entries_per_range=7).orderBy("part", "place").collect()
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=repr) == sorted(want, key=repr)
    keys = [(r["urlkey"], r["captured"]) for r in got]
    assert keys == sorted(keys) and len({r["part"] for r in got}) > 5
    assert max(sum(r["part"] == p for r in got) for p in {r["part"] for r in got}) < 30


def test_small_payloads_are_not_revisited(spark):
    data = [(1, "http://a.com/", "ab"), (2, "http://a.com/", "ab"), (3, "http://a.com/", "abcd"), (4, "http://a.com/", "abcd")]
    got = {r["page_id"]: r["record_type"] for r in archive_pages(rows(spark, data), min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_no_pages(spark):
    assert archive_pages(rows(spark, [])).collect() == []


def test_archives_are_records(spark):
    path = scratch_path(spark, "archive")
    archive_pages(rows(spark, [(1, "http://a.com/", "x"), (2, "http://a.com/", "x")]), path).collect()
    text = spark.read.text(path, wholetext=True).collect()
    assert sum(t["value"].count("WARC/1.1\r\n") for t in text) == 2
    assert all(t["value"].endswith("\r\n\r\n") for t in text)


def test_ranges_grow_with_the_pages(spark):
    from tallycast.llm.warc import range_bounds

    pages = rows(spark, [(i, f"http://a.com/{i:03}", "x") for i in range(200)]).select("page_id", "url")
    assert len(range_bounds(pages, 10, sample=4)) == 19
