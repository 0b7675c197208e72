from pyspark.sql import functions as F

from tillcast.llm.queries import ORACLES, QUERIES
from tillcast.llm.revisits import PERMITTED, canonical_url, resolve_revisits
from tests.conftest import SMALL

SCHEMA = "record_id long, kind string, url string, captured long, headers map<string,string>, payload string"
U = "http://www.Example.com:80/a/b/?utm_source=x#frag"


def test_canonical_urls(spark):
    urls = {U: "https://example.com/a/b", "HTTPS://example.com/a/b?ref=1&page=2": "https://example.com/a/b?page=2",
            "https://example.com": "https://example.com", "https://example.com/A?b=1&a=2": "https://example.com/A?b=1&a=2",
            "nonsense": "nonsense", "": "", None: None}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.c for r in df.withColumn("c", canonical_url(F.col("u"))).collect()} == urls


def brute(records):
    out = {}
    for r in records:
        if r[1] != "revisit":
            continue
        canon = {U: "e"}.get(r[2], r[2])
        before = [x for x in records if x[1] == "response" and {U: "e"}.get(x[2], x[2]) == canon and canon is not None
                  and x[3] is not None and r[3] is not None and x[3] < r[3]]
        if not before:
            out[r[0]] = ("missing", None, r[4])
            continue
        x = max(before, key=lambda x: (x[3], x[0]))
        mine, theirs = r[4] or {}, x[4] or {}
        tag = lambda h: h.get("etag", "").removeprefix("W/")
        if "etag" in mine and "etag" in theirs:
            s = "resolved" if tag(mine) == tag(theirs) else "changed"
        elif "last-modified" in mine and "last-modified" in theirs:
            s = "resolved" if mine["last-modified"] == theirs["last-modified"] else "changed"
        else:
            s = "unchecked"
        merged = {**theirs, **{k: v for k, v in mine.items() if k in PERMITTED}} if s == "resolved" else mine
        out[r[0]] = (s, x[0], merged)
    return out


def test_against_brute_force_over_many_partitions(spark):
    records = []
    for i in range(600):
        url = U if i % 3 else f"https://h.org/{i % 17}"          # two thirds of all records are one URL
        headers = {}
        if i % 4 < 3:
            headers["etag"] = f'{"W/" if i % 5 == 0 else ""}"{i % 2}"'
        if i % 7 < 4:
            headers["last-modified"] = str(i % 3)
        headers["content-length"] = str(i)
        records.append((i, "response" if i % 5 == 0 else "revisit", url, (i * 7919) % 400, headers, f"body {i}"))
    got = {r.record_id: r for r in resolve_revisits(spark.createDataFrame(records, SCHEMA)).collect()}
    want = brute(records)
    assert set(got) == set(want)
    for i, (status, ref, headers) in want.items():
        assert (got[i].status, got[i].response_id, got[i].headers) == (status, ref, headers)
        assert got[i].payload == (f"body {ref}" if status == "resolved" else None)
    assert {r.status for r in got.values()} == {"resolved", "changed", "unchecked", "missing"}


def test_hostile_rows(spark):
    rows = [(1, "response", U, 10, {"ETag": '"a"'}, None), (2, "revisit", U, 10, {"etag": '"a"'}, None),
            (3, "revisit", U, 11, {"ETAG": 'W/"a"', "Expires": None}, "ignored"), (3, "revisit", U, 11, {"ETAG": 'W/"a"'}, None),
            (4, "revisit", None, 12, None, None), (5, "revisit", U, None, None, None), (6, "request", U, 20, None, None),
            (7, "response", None, 1, None, "x"), (8, None, U, 30, None, None), (None, "revisit", U, 40, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_part", F.lit("clash")).withColumn("status", F.lit(1))
    got = sorted((r.record_id or 0, r.status, r.payload) for r in resolve_revisits(df).collect())
    assert got == [(0, "unchecked", None), (2, "missing", None), (3, "resolved", ""), (3, "resolved", ""),
                   (4, "missing", None), (5, "missing", None)]
    assert resolve_revisits(df.limit(0)).collect() == []


def test_payloads_are_not_stored_with_the_ranked_records(spark, monkeypatch):
    from tillcast.llm import revisits
    stored, durable = [], revisits.durable
    monkeypatch.setattr(revisits, "durable", lambda df: stored.append(df.columns) or durable(df))
    rows = [(1, "response", U, 10, {"etag": "a"}, "body"), (2, "revisit", U, 11, {"etag": "a"}, None)]
    out = resolve_revisits(spark.createDataFrame(rows, SCHEMA))
    assert [(r.record_id, r.status, r.payload) for r in out.collect()] == [(2, "resolved", "body")]
    assert stored and not any("payload" in c for c in stored)


def test_query_has_all_cases_and_an_oracle(spark, duck):
    from tools.oracle_check import compare
    key = "op2_warc_revisits"
    r = compare(spark, duck, key, QUERIES[key], ORACLES[key], SMALL)
    assert r["status"] == "ok", r
    assert {x[0] for x in QUERIES[key](spark, SMALL).select("status").distinct().collect()} >= {"resolved", "changed", "missing"}
