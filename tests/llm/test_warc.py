import random

import pytest

from corpweave.llm import warc

from .conftest import pairs

SCHEMA = "record_id bigint, kind string, uri string, at bigint, status int, headers string, body string, span bigint, seen string"


def brute_url(url):
    import re

    if not url:
        return None
    bare = re.sub("^[A-Za-z][A-Za-z0-9+.-]*://", "", re.sub("#.*$", "", url.strip(" ")))
    host = re.sub(":(80|443)$", "", re.sub(r"^www\.", "", re.match("[^/?]*", bare)[0].lower()))
    if not host:
        return None
    path, _, query = bare[len(re.match("[^/?]*", bare)[0]) :].partition("?")
    fields = sorted(p for p in query.split("&") if p and not re.match(warc.TRACKING, p))
    return host + (path or "/") + ("?" + "&".join(fields) if fields else "")


def fields(headers):
    return [line for line in (headers or "").replace("\r\n", "\n").split("\n") if ":" in line]


def name(line):
    return line.partition(":")[0].strip().lower()


def value(headers, wanted):
    return next((line.partition(":")[2].strip() for line in fields(headers) if name(line) == wanted), None)


def brute(rows):
    out = []
    for rid, kind, uri, at, _, update, *_ in rows:
        if kind != "revisit":
            continue
        full = [r for r in rows if r[1] == "response" and r[4] == 200 and brute_url(r[2]) == brute_url(uri) is not None
                and (float("-inf") if r[3] is None else r[3]) < (float("-inf") if at is None else at)]
        if not full:
            out.append((rid, None, "no_response", None, None, None))
            continue
        best = max(full, key=lambda r: (float("-inf") if r[3] is None else r[3], r[0]))
        tag, modified = value(update, "etag"), value(update, "last-modified")
        stored = value(best[5], "etag")
        if tag is not None:
            outcome = "resolved" if stored is not None and tag.removeprefix("W/") == stored.removeprefix("W/") else "validator_mismatch"
        elif modified is not None:
            outcome = "resolved" if modified == value(best[5], "last-modified") else "validator_mismatch"
        else:
            outcome = "resolved_unchecked"
        if outcome == "validator_mismatch":
            out.append((rid, None, outcome, None, None, None))
            continue
        new = [x for x in fields(update) if name(x) in warc.PERMITTED]
        old = [x for x in fields(best[5]) if name(x) not in {name(x) for x in new}]
        out.append((rid, best[0], outcome, 200, "\r\n".join(old + new), best[6]))
    return sorted(out, key=repr)


def made_rows(n=300):
    rng = random.Random(8)
    urls = ["http://a.com/x?b=2&a=1", "HTTPS://www.A.com:443/x?a=1&b=2#f", "a.com/x?a=1&utm_source=q&b=2", "http://b.org", "b.org/", None, "", "#x"]
    rows = []
    for i in range(n):
        kind = rng.choice(["response", "response", "revisit", "request"])
        at = rng.choice([None, rng.randrange(40) * 20_000, rng.randrange(800_000)])
        headers = rng.choice([None, "", "ETag: \"1\"\r\nServer: x", "etag: W/\"1\"\nDate: d\r\nX-A: b: c", "Last-Modified: m\r\nCache-Control: k", "ETag: \"2\"\r\nlast-modified: m", "no field"])
        rows.append((i, kind, rng.choice(urls), at, rng.choice([200, 200, 304, 404, None]), headers, f"body {i}", 1, "x"))
    return rows


@pytest.mark.parametrize("span", [warc.SPAN_SECONDS, 1_000, 10**9])
def test_against_brute_force(spark, span):
    rows = made_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = warc.resolve_revisits(df, span)
    assert pairs(found, "record_id", "resolved_id", "outcome", "status", "headers", "body") == brute(rows)


def test_repeated_records_and_empty_tables(spark):
    rows = made_rows(20)
    twice = spark.createDataFrame(rows + [r for r in rows if r[1] == "revisit"], SCHEMA)
    n = sum(r[1] == "revisit" for r in rows)
    assert warc.resolve_revisits(twice).count() == 2 * n
    assert warc.resolve_revisits(twice.where("false")).count() == 0


def test_plan_is_native(spark):
    plan = warc.resolve_revisits(spark.createDataFrame(made_rows(5), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
