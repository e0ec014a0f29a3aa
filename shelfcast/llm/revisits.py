"""Resolution of not-modified revisits in a stream of WARC records.

A revisit record holds the headers of a 304 answer and no payload. It is resolved by an as-of join: records
are sorted once by canonical URL and time over all partitions, and the last full response is carried
forward. The sort cuts the records of a hot URL into ranges of time; the last full response of each range is
carried over the boundary to the ranges behind it. A response is taken only if the validators of the
revisit confirm it (RFC 9110, 8.8; RFC 9111, 4.3.4). It then lends its payload, and its headers are
updated by those of the revisit that may replace them (RFC 9111, 3.2).
"""

from __future__ import annotations

import re
from datetime import UTC
from email.utils import parsedate_to_datetime
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.frames import PART_BITS, Staged

RECORDS = ("record_id", "url", "time", "kind", "status", "headers", "payload")
FULL = (200, 203)  # a 206 holds a part only
#: Of one connection, or of the payload as it was stored: a revisit never replaces them.
STORED = (
    "connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization",
    "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
    "content-encoding", "content-length", "content-md5", "content-range", "content-type",
)
PORTS = {"http": "80", "https": "443"}
_ESCAPE = re.compile("%([0-9A-Fa-f]{2})")
_HOST = re.compile(r"(\[[^\]]*\]|[^:]*)(?::(\d*))?")
_PLAIN = re.compile("[A-Za-z0-9._~-]")


def _escapes(text: str) -> str:
    def one(found: re.Match) -> str:
        sign = chr(int(found[1], 16))
        return sign if _PLAIN.fullmatch(sign) else found[0].upper()

    return _ESCAPE.sub(one, text)


def _dots(path: str) -> str:
    out, names = [], path.split("/")[1:]
    for name in names:
        if name == "..":
            del out[-1:]
        elif name != ".":
            out.append(name)
    if names[-1:] in (["."], [".."]):
        out.append("")
    return "/" + "/".join(out)


def canonical(url: str | None) -> str | None:
    """The URL in the normal form of RFC 3986, 6.2.2 and 6.2.3, without fragment. Scheme, ``www`` and query
    parameters stay: they can name other resources. What is no http(s) URL is only trimmed."""
    if url is None or not url.strip():
        return None
    whole = url.strip()
    try:
        parts = urlsplit(whole)
    except ValueError:
        return whole
    scheme = parts.scheme.lower()
    user, at, place = parts.netloc.rpartition("@")
    host = _HOST.fullmatch(place)
    if scheme not in PORTS or not host or not host[1]:
        return whole
    port = f":{host[2]}" if host[2] and host[2] != PORTS[scheme] else ""
    query = f"?{_escapes(parts.query)}" if parts.query else ""
    return f"{scheme}://{user}{at}{host[1].lower().rstrip('.')}{port}{_dots(_escapes(parts.path))}{query}"


def moment(date: str | None) -> str | None:
    """An HTTP date in seconds; what is no date is compared as it stands."""
    if date is None or not date.strip():
        return None
    try:
        found = parsedate_to_datetime(date)
        return str(int((found if found.tzinfo else found.replace(tzinfo=UTC)).timestamp()))
    except (ValueError, TypeError, OverflowError, IndexError):
        return date.strip()


def _name(header: Column) -> Column:
    return F.lower(F.trim(F.coalesce(header["name"], F.lit(""))))


def _first(name: str) -> Column:
    return F.get(F.filter("headers", lambda h: _name(h) == name), F.lit(0))["value"]


def _parsed(rows: DataFrame) -> DataFrame:
    """``rows`` with canonical URL, entity tag without weakness mark and time of the last change."""

    @F.pandas_udf("string")
    def address(url: pd.Series) -> pd.Series:
        return url.map(canonical, na_action="ignore")

    @F.pandas_udf("string")
    def seconds(date: pd.Series) -> pd.Series:
        return date.map(moment, na_action="ignore")

    tag = F.regexp_replace(F.trim(_first("etag")), "^W/", "")
    return rows.select(
        "*",
        address("url").alias("_canon"),
        F.when(tag != "", tag).alias("_tag"),
        seconds(_first("last-modified")).alias("_changed"),
    )


def earlier_responses(parsed: DataFrame) -> DataFrame:
    """Revisits of ``parsed`` with ``_from``: the latest full response of the same canonical URL at an
    earlier time (of several at that time the one with the largest id), null if there is none."""
    full = F.col("_full")
    # Of records at one time revisits come first, so that all responses before them are earlier.
    order = ["_canon", "time", "_full", "record_id", "_row"]
    placed = parsed.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = Staged(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered").rows
    rows = rows.withColumn("_part", F.shiftright("_at", PART_BITS))
    last = rows.where(full).groupBy("_part").agg(
        F.max_by(F.struct("_canon", "_row", "_tag", "_changed"), "_at").alias("_last")
    )
    # One row for each range partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.select("_part").distinct().join(last, "_part", "left")
    carried = parts.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    inside = (
        Window.partitionBy("_part", "_canon").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    )
    own = F.when(full, F.struct("_canon", "_row", "_tag", "_changed"))
    found = rows.withColumn("_own", F.last(own, ignorenulls=True).over(inside)).where(~full)
    # The last full response before the range is that of the URL, if the URL has any before it.
    before = F.when(F.col("_carried._canon") == F.col("_canon"), F.col("_carried"))
    joined = found.join(F.broadcast(carried), "_part", "left")
    return joined.withColumn("_from", F.coalesce("_own", before)).drop("_own", "_carried", "_part", "_at")


def _verdict() -> Column:
    there = F.col("_from").isNotNull()
    theirs = F.col("_from._tag"), F.col("_from._changed")
    same = (
        F.when(F.col("_tag").isNotNull(), F.col("_tag").eqNullSafe(theirs[0]))
        .when(F.col("_changed").isNotNull(), F.col("_changed").eqNullSafe(theirs[1]))
        .otherwise(theirs[0].isNull() & theirs[1].isNull())
    )
    bare = F.col("_tag").isNull() & F.col("_changed").isNull()
    return (
        F.when(~there, "no earlier response")
        .when(same, "resolved")
        .when(bare, "not validated")
        .otherwise("other version")
    )


def merged(stored: Column, fresh: Column) -> Column:
    """Stored headers whose names ``fresh`` doesn't replace, then those of ``fresh`` that may."""
    stored, fresh = (F.coalesce(h, F.array().cast("array<struct<name:string,value:string>>")) for h in (stored, fresh))
    listed = F.transform(
        F.filter(fresh, lambda h: _name(h) == "connection"),
        lambda h: F.transform(F.split(F.lower(F.coalesce(h["value"], F.lit(""))), ","), F.trim),
    )
    fixed = F.concat(F.array(*map(F.lit, STORED)), F.array(F.lit("")), F.flatten(listed))
    allowed = F.filter(fresh, lambda h: ~F.array_contains(fixed, _name(h)))
    names = F.transform(allowed, _name)
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(names, _name(h))), allowed)


def resolved(records: DataFrame) -> DataFrame:
    """(record_id, url, time, verdict, refers_to, status, headers, payload) of every revisit.

    ``records`` has the columns RECORDS, with ``headers`` an array of (name, value) and ``kind`` ``response`` or
    ``revisit``. A revisit is answered by the latest full response (status 200 or 203) of its canonical URL at an
    earlier time. With an entity tag, the tags must agree, weak or not; without one the times of last
    change must agree; a revisit with neither agrees only with a response that has neither.
    ``verdict`` is ``resolved``, or ``no earlier response``, ``other version`` or ``not validated``; then the
    last four columns are null, the revisit's own status and headers being those of its record.

    Revisits don't update each other. Null or empty URLs and null times find nothing; other kinds and statuses
    take no part. Repeated rows and rows with null or equal ids take part each for itself. An empty
    table gives no rows; other columns are not read.
    """
    named = records.select(*RECORDS).where(F.col("kind").isin("revisit", "response"))
    stored = Staged(
        named.where((F.col("kind") == "revisit") | F.col("status").isin(*FULL))
        .withColumn("_full", F.col("kind") == "response")
        .withColumn("_row", F.monotonically_increasing_id()),
        "records",
    ).rows
    parsed = _parsed(stored.select("_row", "_full", "record_id", "url", "time", "headers"))
    # The headers of responses come with their payloads.
    parsed = parsed.withColumn("headers", F.when(~F.col("_full"), F.col("headers")))
    placeable = F.col("_canon").isNotNull() & F.col("time").isNotNull()
    found = earlier_responses(parsed.where(placeable)).withColumn("verdict", _verdict())
    found = Staged(found, "found").rows
    answers = stored.where("_full").select(
        F.col("_row").alias("_answer"),
        F.col("record_id").alias("refers_to"),
        "status",
        F.col("headers").alias("_stored"),
        "payload",
    )
    own = ["record_id", "url", "time", "verdict"]
    good = (
        found.where("verdict = 'resolved'")
        .withColumn("_answer", F.col("_from._row"))
        .join(answers, "_answer")
        .select(*own, "refers_to", "status", merged(F.col("_stored"), F.col("headers")).alias("headers"), "payload")
    )
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema.fields[len(own) :]]
    unplaced = parsed.where(~F.col("_full") & ~placeable).withColumn("verdict", F.lit("no earlier response"))
    rest = found.where("verdict != 'resolved'").select(*own).union(unplaced.select(*own))
    return good.union(rest.select(*own, *nothing))


def page_records(pages: DataFrame) -> DataFrame:
    """Three records of every row of ``pages``, which have URLs and bodies only: its response, and two
    revisits with all forms of validators, some of them of another version or from before the response."""
    number = F.coalesce(F.col("page_id"), F.lit(0)).cast("long")
    start = F.lit(1_600_000_000) + number * 60
    body = F.coalesce(F.col("html"), F.lit(""))
    tag = F.concat(F.lit('"'), F.md5(body.cast("binary")), F.lit('"'))
    form = number % 4  # of the response: both validators, tag, time, none

    def date(seconds: Column) -> Column:
        utc = F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone())
        return F.concat(F.date_format(utc, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))

    changed = date(start - 86_400)

    def header(name: str, value: Column | str) -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    def record(place: int, url: Column, time: Column, kind: str, status: int, headers: list, payload: Column):
        return F.struct(
            (number * 3 + place).alias("record_id"), url.alias("url"), F.timestamp_seconds(time).alias("time"),
            F.lit(kind).alias("kind"), F.lit(status).alias("status"),
            F.filter(F.array(*headers), lambda h: h["value"].isNotNull()).alias("headers"),
            payload.cast("string").alias("payload"),
        )

    def revisit(place: int, url: Column, time: Column, shown: Column) -> Column:
        other = F.when(number % 16 == 5, F.lit('"other"')).otherwise(tag)
        return record(place, url, time, "revisit", 304, [
            header("date", date(time)),
            header("etag", F.when(form < 2, F.when(shown, F.concat(F.lit("W/"), other)).otherwise(other))),
            header("last-modified", F.when(form == 2, changed)),
            header("cache-control", F.concat(F.lit("max-age="), (number % 100).cast("string"))),
            header("content-length", "0"),
            header("connection", "x-hop"),
            header("x-hop", "1"),
        ], F.lit(None))

    url = F.col("url")
    response = record(0, url, start, "response", 200, [
        header("Date", date(start)),
        header("Content-Type", "text/html; charset=utf-8"),
        header("Content-Length", F.octet_length(body).cast("string")),
        header("ETag", F.when(form < 2, tag)),
        header("Last-Modified", F.when((form == 0) | (form == 2), changed)),
        header("Cache-Control", "max-age=3600"),
    ], body)
    # Every tenth first revisit comes before its response.
    first = F.when(number % 10 == 7, start - 30).otherwise(start + 30 + number % 7 * 86_400)
    records = [
        response,
        revisit(1, F.concat(F.regexp_replace(url, "#.*", ""), F.lit("#again")), first, number % 3 == 0),
        revisit(2, url, start + 40 + number % 11 * 86_400, F.lit(False)),
    ]
    return pages.select(F.explode(F.array(*records)).alias("r")).select("r.*")
