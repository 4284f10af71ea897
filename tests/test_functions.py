"""Scalar functions against golden values and plain Python."""

from __future__ import annotations

import hashlib
import hmac
import random
from datetime import datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from cartlake.functions import numeric, regions, signature
from cartlake.functions import timeutil as tu


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_country_to_region(spark):
    got = column(spark, ["GB", "US", "CA", "au", "LV", "UK", None], "string", regions.region_of_country)
    assert got == ["UK", "US", "CA", "AU", None, "UK", None]
    legacy = column(spark, ["GB", "UK", "au"], "string", regions.region_of_country_legacy)
    assert legacy == ["UK", None, None]


def test_tokens(spark):
    (tokens,) = column(spark, ["winter.push+CA|clip_SCALE 7"], "string", lambda v: regions.ad_tokens(v))
    assert {"CA", "SCALE"} <= set(tokens) and "" not in tokens


def test_ad_region_account_then_keywords_then_default(spark):
    ads = spark.createDataFrame(
        [
            ("act_123", "plain", "plain"),
            ("act_999", "winter.push+AU|clip 7", "AU/best three"),
            ("act_999", "both uk and au", None),
            (None, None, None),
            ("act_0", "canada only", ""),
        ],
        "account_id string, campaign_name string, adset_name string",
    )
    small = {"act_123": "UK", "act_0": ""}
    big = {f"x{i}": "CA" for i in range(500)} | small
    table = spark.createDataFrame(list(small.items()), "a string, r string")
    # an account mapped to an empty region falls through to the keywords, whatever holds the map
    want = [("plain", "UK"), ("winter.push+AU|clip 7", "AU"), ("both uk and au", "AU"), (None, "US"), ("canada only", "CA")]
    for accounts in (small, big, table):
        rows = regions.with_ad_region(ads, accounts).select("campaign_name", "region").collect()
        assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_region_of_text_is_the_token_rule(spark):
    rng = random.Random(6)
    words = ["AU", "au", "aus", "GB", "uk", "CA", "Can", "USA", "us", "xAU", "AUx", "é", "AUé", "1", "CA1", "united", "UnitedKingdom"]
    rows = [("".join(rng.choice(words) + rng.choice([" ", "-", "_", "", ".", "/"]) for _ in range(5)), rng.choice(words + [None, ""])) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string")
    cols = [F.col("a"), F.col("b")]
    for r in df.select(regions.region_of_text(cols).alias("r"), regions.ad_tokens(*cols).alias("t")).collect():
        hits = [k for k, v in regions.REGION_KEYWORDS.items() if set(v) & set(r.t)]
        assert r.r == (hits[0] if hits else None)


@pytest.mark.parametrize(
    "clock, utc",
    [
        ("2025-10-14 23:00:00", "2025-10-15 04:00:00"),
        ("2024-03-10 02:30:00", "2024-03-10 08:30:00"),  # does not exist: spring gap
        ("2024-11-03 01:30:00", "2024-11-03 06:30:00"),  # happens twice: the first
    ],
)
def test_store_hour_to_utc(spark, clock, utc):
    (got,) = column(spark, [clock], "string", lambda v: tu.store_to_utc(v.cast("timestamp_ntz"), "America/Chicago").cast("string"))
    assert got == utc


def test_unknown_region_is_an_error(spark):
    df = spark.createDataFrame([("XX",)], "region string")
    with pytest.raises(Exception, match="unsupported region"):
        df.select(tu.region_zone(F.col("region"))).collect()


def test_text_instants(spark):
    got = column(
        spark, ["2025-10-03T12:00:00-04:00", "2025-10-03T12:00:00Z", "soon", None], "string", lambda v: tu.utc_clock(v).cast("string")
    )
    assert got == ["2025-10-03 16:00:00", "2025-10-03 12:00:00", None, None]


def test_fetch_window_covers_every_region_day(spark):
    start, end = datetime(2024, 7, 1), datetime(2024, 7, 3, 23, 59, 59)
    low, high = tu.fetch_window(start, end, "America/Chicago")
    for zone in tu.REGION_ZONES.values():
        first = datetime(2024, 7, 1, tzinfo=ZoneInfo(zone)).astimezone(ZoneInfo("UTC")).replace(tzinfo=None)
        last = datetime(2024, 7, 3, 23, 59, 59, tzinfo=ZoneInfo(zone)).astimezone(ZoneInfo("UTC")).replace(tzinfo=None)
        assert low <= first and last <= high
    df = spark.createDataFrame([(start, end)], "s timestamp_ntz, e timestamp_ntz")
    got = df.select(*tu.fetch_window_columns(F.col("s"), F.col("e"), "America/Chicago")).first()
    assert (got[0], got[1]) == (low, high)
    with pytest.raises(ValueError):
        tu.fetch_window(end, start, "UTC")


def test_round_exact_is_python_round(spark):
    rng = random.Random(7)
    values = [2.675, 1.005, 0.285, 69.695, 0.5, 1.5, -2.675, 0.0, 1234567.125, 1e-9]
    values += [round(rng.uniform(-1000, 1000), 3) for _ in range(3000)] + [rng.uniform(-10, 10) for _ in range(500)]
    for digits in (2, 3, 4):
        got = column(spark, values, "double", lambda v: numeric.round_exact(v, digits))
        assert got == [round(v, digits) for v in values]


def test_money_and_cents(spark):
    got = column(spark, ["1.5", "", None, "x", " 2 "], "string", numeric.money)
    assert [float(v) for v in got] == [1.5, 0.0, 0.0, 0.0, 2.0]
    assert [float(v) for v in column(spark, [1999, 5], "bigint", numeric.cents)] == [19.99, 0.05]
    assert column(spark, [0.5, 1.5, 2.5], "double", numeric.count_of) == [0, 2, 2]
    assert column(spark, ["7", "", None], "string", numeric.number) == [7.0, 0.0, 0.0]


@pytest.mark.parametrize("key", ["short", "k" * 64, "long" * 30, "schlüssel"])
def test_hmac_is_python_hmac(spark, key):
    bodies = ["", "a", "héllo wörld", "x" * 1000]
    got = column(spark, bodies, "string", lambda v: signature.hmac_sha256_hex(v, key))
    assert got == [hmac.new(key.encode(), b.encode(), hashlib.sha256).hexdigest() for b in bodies]


def test_missing_signature_or_body_is_invalid(spark):
    good = hmac.new(b"s", b"body", hashlib.sha256).hexdigest()
    empty = hmac.new(b"s", b"", hashlib.sha256).hexdigest()
    rows = [("body", good), ("body", None), ("body", ""), ("", empty), (None, good), ("body", good.upper())]
    df = spark.createDataFrame([({"sig": s} if s is not None else {}, b) for b, s in rows], "headers map<string,string>, body string")
    ok, bad = signature.split_by_body_signature(df, "s", "sig")
    assert ok.count() == 1 and bad.count() == 5


def test_gateway_signature_reasons(spark):
    body, stamp = '{"id": "evt_1"}', "1700000000"
    sign = lambda t, b: hmac.new(b"s", f"{t}.{b}".encode(), hashlib.sha256).hexdigest()
    rows = [
        (body, f"t={stamp},v1={sign(stamp, body)}"),
        (body, f"t={stamp},v1=00,v1={sign(stamp, body)}"),
        (body, f"t={stamp},v1={sign('1', body)}"),
        ("not json", f"t={stamp},v1={sign(stamp, 'not json')}"),
        (body, None),
    ]
    df = spark.createDataFrame(rows, "body string, header string")
    reason = signature.gateway_signature_reason(F.col("body"), F.col("header"), "s")
    assert [r[0] for r in df.select(reason).collect()] == [None, None, "bad_signature", "bad_payload", "bad_signature"]
    old = signature.gateway_signature_reason(F.col("body"), F.col("header"), "s", F.lit(1700000301))
    assert df.select(old).first()[0] == "bad_signature"


def test_sums_lose_no_small_or_large_values(spark):
    small = spark.range(1_000_000).selectExpr("4e-7D AS v").selectExpr(numeric.exact_total("v") + " AS s")
    assert small.first().s == 0.4
    large = spark.createDataFrame([(1e13,), (2.5e13,), (None,)], "v double").selectExpr(numeric.exact_total("v") + " AS s")
    assert large.first().s == 3.5e13


def test_typed_fact_reads_text(spark):
    from cartlake.sources import readers

    raw = spark.createDataFrame(
        [(" 1.5 ", "2024-01-01", "x", 1), ("", "no day", None, 2), (None, None, "y", 3), ("1,5", "2024-01-02", "n/a", 4)],
        "spend string, day string, name string, extra int",
    )
    schema = "spend double, day date, name string, missing double"
    got = readers.typed_fact(raw, schema)
    assert got.schema.simpleString() == "struct<spend:double,day:date,name:string,missing:double>"
    rows = [(r.spend, str(r.day), r.name, r.missing) for r in got.collect()]
    assert rows == [(1.5, "2024-01-01", "x", None), (0.0, "None", None, None), (0.0, "None", "y", None), (0.0, "2024-01-02", "n/a", None)]
    assert {tuple(r) for r in readers.unreadable(raw, schema).collect()} == {("spend", 1), ("day", 1)}
    assert readers.unreadable(raw, "name string").count() == 0
    assert readers.typed_fact(raw.limit(0), schema).count() == 0
