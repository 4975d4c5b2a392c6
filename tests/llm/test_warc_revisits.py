from __future__ import annotations

import random

import pytest

from reviewmill.llm import warc_revisits as wr

SCHEMA = "record_id long, url string, date long, kind string, status int, headers map<string,string>, response_id int"


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTP://www.Example.com:80/a/?utm_source=x&b=2&a=1#top", "example.com/a?a=1&b=2"),
        ("https://example.com/a?ref=x", "example.com/a"),
        ("//example.com", "example.com"),
        ("https://example.com:8080/A//", "example.com:8080/A"),
        (" mailto:X ", "mailto:x"),
        ("https://e.com/?refer=1&reference", "e.com?refer=1&reference"),
        ("", None),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    row = spark.createDataFrame([(url,)], "url string").select(wr.canonical_url("url").alias("c")).first()
    assert row.c == want


def _resolve(spark, rows, **options):
    found = wr.resolve_revisits(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), **options).collect()
    return sorted(((r.record_id, r.response_id, r.outcome, r.headers) for r in found), key=str)


def test_validators_and_headers(spark):
    old = {"ETag": '"a"', "Content-Type": "text/html", "Cache-Control": "x", "Last-Modified": "monday"}
    rows = [
        (1, "http://e.com/p", 10, "response", 200, old),
        (2, "http://e.com/p", 11, "response", 404, {"ETag": '"b"'}),
        (3, "https://www.e.com/p/#x", 12, "revisit", 304, {"etag": 'W/"a"', "content-type": "no", "cache-control": "y", "vary": "z"}),
        (4, "http://e.com/p", 13, "revisit", 304, {"ETAG": '"b"', "last-modified": "monday"}),
        (5, "http://e.com/p", 14, "revisit", 304, {"last-modified": "tuesday"}),
        (6, "http://e.com/p", 15, "revisit", 304, None),
        (7, "http://e.com/p", 10, "revisit", 304, {"etag": '"a"'}),
        (8, "http://e.com/q", 99, "revisit", 304, {}),
        (9, None, 99, "revisit", 304, {}),
        (10, "http://e.com/p", None, "revisit", 304, {}),
        (11, "http://e.com/p", 99, "metadata", 200, {}),
    ]
    got = {r[0]: r[1:] for r in _resolve(spark, rows)}
    small = {k.lower(): v for k, v in old.items()}
    assert got[3] == (1, "resolved", small | {"etag": 'W/"a"', "cache-control": "y", "vary": "z"})
    assert got[4] == (1, "changed", None) and got[5] == (1, "changed", None)
    assert got[6] == (1, "unchecked", small)
    assert all(got[i] == (None, "missing", None) for i in (7, 8, 9, 10)) and 11 not in got


def test_hot_url_against_brute_force(spark):
    draw, rows = random.Random(2), []
    for i in range(3_000):
        url = "http://hot.com/" if draw.random() < 0.4 else f"http://e.com/{draw.randrange(200)}"
        kind = draw.choice(["response", "revisit", "revisit"])
        rows.append((i, url, draw.randrange(1_000), kind, 200 if kind == "response" else 304, {}))
    responses = {}
    for i, url, date, kind, *_ in rows:
        if kind == "response":
            responses.setdefault(url, []).append((date, i))
    want = {}
    for i, url, date, kind, *_ in rows:
        if kind == "revisit":
            want[i] = max((r for r in responses.get(url, []) if r[0] < date), default=(0, None))[1]
    assert {r[0]: r[1] for r in _resolve(spark, rows)} == want


def test_repeated_and_empty(spark):
    rows = [(1, "http://e.com", 1, "response", 200, {}), (1, "http://e.com", 1, "response", 200, {})]
    rows += [(2, "http://e.com", 5, "revisit", 304, {})] * 2 + [(None, "http://e.com", 5, "revisit", 304, {})]
    got = _resolve(spark, rows)
    assert [r[:3] for r in got] == [(2, 1, "unchecked")] * 2 + [(None, None, "missing")]
    assert _resolve(spark, []) == []
