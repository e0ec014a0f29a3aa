"""Revisit resolution against brute force, and its query on whole pages."""

import random

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import queries, revisits

DATA = "/root/testdata/sf0.001"
SCHEMA = (
    "record_id long, url string, time long, kind string, status int, "
    "headers array<struct<name:string,value:string>>, payload string"
)
URLS = ["http://A.example:80/x/../p%7e#f", "http://a.example/p~", "https://a.example/p~", "http://b.example", None, " "]
DATES = ["Sun, 06 Nov 1994 08:49:37 GMT", "Sunday, 06-Nov-94 08:49:37 GMT", "Mon, 07 Nov 1994 08:49:37 GMT"]


def stream(n=1500):
    pick = random.Random(4)
    rows = []
    for i in range(n):
        url = URLS[0] if pick.random() < 0.7 else pick.choice(URLS)  # most records are of one URL
        kind = pick.choice(["response", "revisit", "revisit", "revisit", "request"])
        headers = [("Date", str(i)), ("Content-Length", str(i)), ("Set-Cookie", "a"), ("set-cookie", str(i))]
        headers += [pick.choice([("ETag", '"1"'), ("etag", 'W/"1"'), ("ETag", '"2"')])] * pick.randint(0, 1)
        headers += [("Last-Modified", pick.choice(DATES))] * pick.randint(0, 1)
        if kind == "revisit":
            headers = [*headers[1:], ("Connection", "X-Hop, close"), ("x-hop", "1"), ("Keep-Alive", "5")]
        status = pick.choice([200, 200, 206, 404, 203]) if kind == "response" else 304
        time = None if pick.random() < 0.02 else pick.randint(0, 400)
        number = None if pick.random() < 0.02 else i
        payload = f"body {i}" if kind == "response" else None
        rows.append((number, url, time, kind, status, None if pick.random() < 0.05 else headers, payload))
    return rows


def value(headers, name):
    return next((v for n, v in headers or [] if n.lower() == name), None)


def brute(rows):
    out = []
    for number, url, time, kind, _, headers, _ in rows:
        if kind != "revisit":
            continue
        own, answer = revisits.canonical(url), None
        for r in rows if own and time is not None else []:
            if r[3] == "response" and r[4] in (200, 203) and revisits.canonical(r[1]) == own and r[2] is not None:
                key = (r[2], -1 if r[0] is None else r[0])
                if r[2] < time and (answer is None or key > answer[0]):
                    answer = key, r
        if not answer:
            out.append((number, time, "no earlier response", None, None, None, None))
            continue
        base = answer[1]
        tags = [(value(h, "etag") or "").removeprefix("W/") for h in (headers, base[5])]
        dates = [revisits.moment(value(h, "last-modified")) for h in (headers, base[5])]
        if tags[0] or dates[0]:
            verdict = "resolved" if (tags if tags[0] else dates)[0] == (tags if tags[0] else dates)[1] else "other version"
        else:
            verdict = "not validated" if tags[1] or dates[1] else "resolved"
        if verdict != "resolved":
            out.append((number, time, verdict, None, None, None, None))
            continue
        fixed = {"connection", "x-hop", "keep-alive", "content-length"}
        fresh = [h for h in headers or [] if h[0].lower() not in fixed]
        names = {n.lower() for n, _ in fresh}
        merged = [h for h in base[5] or [] if h[0].lower() not in names] + fresh
        out.append((number, time, verdict, base[0], base[4], merged, base[6]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", ["1", "13"])
def test_equals_brute_force_also_when_a_url_is_cut_by_time(spark, parts):
    rows = stream()
    kept = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        records = spark.createDataFrame(rows, SCHEMA).withColumns({"_at": F.lit("x"), "verdict": F.lit("x")})
        found = revisits.resolved(records).collect()
    finally:
        for name, old in kept.items():
            spark.conf.set(name, old)
    got = [
        (r.record_id, r.time, r.verdict, r.refers_to, r.status, r.headers and [tuple(h) for h in r.headers], r.payload)
        for r in found
    ]
    assert sorted(got, key=repr) == brute(rows)
    assert {r.verdict for r in found} == {"resolved", "no earlier response", "other version", "not validated"}


def test_canonical_urls():
    same = ["HTTP://u@A.Example.:80/%7ea/./b/../c?x=%c3#y", "http://u@a.example/~a/c?x=%C3"]
    assert len({revisits.canonical(u) for u in same}) == 1
    assert revisits.canonical("https://[::1]:443") == "https://[::1]/"
    assert revisits.canonical("http://a:8080/..") == "http://a:8080/"
    assert revisits.canonical("http://[oops/") == "http://[oops/" and revisits.canonical("dns:a") == "dns:a"
    assert revisits.canonical("http://a/x?b=1&a") != revisits.canonical("http://a/x?a&b=1")


def test_empty_table(spark):
    assert revisits.resolved(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_resolves_the_whole_table(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    records = [tuple(r) for r in revisits.page_records(pages).collect()]
    assert sum(r[3] == "revisit" for r in records) == 2 * pages.count()
    found = queries.QUERIES["op4_warc_revisits"](spark, DATA).collect()
    got = [
        (r.record_id, r.time, r.verdict, r.refers_to, r.status, r.headers and [tuple(h) for h in r.headers], r.payload)
        for r in found
    ]
    assert sorted(got, key=repr) == brute([(*r[:5], [tuple(h) for h in r[5]], r[6]) for r in records])
    assert {r.verdict for r in found} >= {"resolved", "no earlier response", "other version"}
