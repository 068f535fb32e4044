"""Revisit resolution against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from pagemill.llm import warc

SCHEMA = "record_id long, url string, at long, status int, etag string, last_modified long, headers map<string,string>, body string"


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://WWW.A.org:80/x/?b=2&a=1#f", "a.org/x?a=1&b=2"),
        ("https://a.org", "a.org"),
        ("https://m.a.org/P/?utm_source=x&ref=y", "m.a.org/P"),
        ("a.org/x?ref=1&refs=2", "a.org/x?refs=2"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, key):
    row = spark.createDataFrame([(url,)], "url string").select(warc.canonical_url(F.col("url"))).first()
    assert row[0] == key


@pytest.mark.parametrize("spans", [1, 7, 1024])
def test_revisits_against_a_loop(spark, spans):
    rng = random.Random(spans)
    rows = []
    for i in range(400):
        url = f"http://a.org/{min(rng.randrange(8), 3)}"
        status = rng.choice([200, 304, 304, 404])
        rows.append((i, url, rng.randrange(150), status, rng.choice(['"1"', 'W/"1"', '"2"', None]), rng.choice([5, 6, None]),
                     {"Date": str(i), "Content-Type": f"t{i}"}, f"b{i}" if status == 200 else None))
    got = {r.record_id: r for r in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA), spans).collect()}
    assert set(got) == {r[0] for r in rows if r[3] == 304}
    for i, url, at, status, etag, modified, headers, _ in rows:
        if status != 304:
            continue
        full = max((r for r in rows if r[3] == 200 and r[1] == url and r[2] < at), key=lambda r: (r[2], r[0]), default=None)
        if full is None:
            outcome = "missing"
        elif etag is not None:
            same = full[4] is not None and full[4].removeprefix("W/") == etag.removeprefix("W/")
            outcome = "etag" if same else "mismatch"
        elif modified is not None:
            outcome = "modified" if modified == full[5] else "mismatch"
        else:
            outcome = "unchecked"
        row, agreed = got[i], outcome in ("etag", "modified")
        assert row.outcome == outcome and row.full_id == (full[0] if agreed else None)
        assert row.body == (full[7] if agreed else None)
        wanted = [("content-type", full[6]["Content-Type"]), ("date", headers["Date"])] if agreed else None
        assert (row.headers and [tuple(h) for h in row.headers]) == wanted


def test_odd_records(spark):
    full = (1, "http://a.org/", 5, 200, '"e"', None, None, "")
    rows = [full, full, (2, "http://a.org", 9, 304, '"e"', None, None, None), (2, "http://a.org", 9, 304, '"e"', None, None, None)]
    rows += [(3, None, 9, 304, '"e"', 1, {}, None), (None, "http://a.org", 9, 304, '"e"', 1, {}, None), (4, "http://a.org", None, 304, '"e"', 1, {}, None)]
    records = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("mine")).withColumn("span", F.lit(1))
    got = sorted((r.record_id or 0, r.outcome, r.full_id, r.body) for r in warc.resolve_revisits(records).collect())
    assert got == [(0, "missing", None, None), (2, "etag", 1, ""), (2, "etag", 1, ""), (3, "missing", None, None), (4, "missing", None, None)]
    assert warc.resolve_revisits(records.limit(0)).count() == 0
    assert warc.page_records(spark.createDataFrame([(1, None, None)], "page_id long, url string, html string")).count() == 3
