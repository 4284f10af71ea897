"""Per-key picks against brute force, with hot keys cut and not cut."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartlake.operators import backfill, curated, ranking, state

START = datetime(2024, 1, 1)


def versions(n=300, seed=11):
    """A third of the rows belong to one key; times collide, ids do not; some keys are null."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.choice([1, 2, 3, 4, None])
        rows.append((i, key, START + timedelta(seconds=rng.choice([0, 1, 59, 60, 61, 7200, 90000])), rng.choice("abc")))
    rng.shuffle(rows)
    return rows


SCHEMA = "seq bigint, key bigint, ts timestamp_ntz, kind string"


def by_key(rows):
    groups = {}
    for r in rows:
        if r[1] is not None:
            groups.setdefault(r[1], []).append(r)
    return {k: sorted(v, key=lambda r: (r[2], r[0])) for k, v in groups.items()}


@pytest.mark.parametrize("hot_rows", [1, 40, 10**6])
def test_split_row_number(spark, hot_rows):
    rows = versions()
    df = spark.createDataFrame(rows, SCHEMA)
    levels = ranking.time_levels(F.col("ts"), F.shiftleft("seq", 18))
    got = ranking.split_row_number(df, ["key"], levels, ["ts", "seq"], "n", hot_rows)
    want = {r[0]: i + 1 for group in by_key(rows).values() for i, r in enumerate(group)}
    assert {r.seq: r.n for r in got.collect()} == {**{r[0]: None for r in rows}, **want}
    assert got.columns == ["seq", "key", "ts", "kind", "n"] or set(got.columns) == {"seq", "key", "ts", "kind", "n"}


@pytest.mark.parametrize("hot_rows", [1, 40, 10**6])
def test_split_lag(spark, hot_rows):
    rows = versions()
    df = spark.createDataFrame(rows, SCHEMA)
    levels = ranking.time_levels(F.col("ts"), F.shiftleft("seq", 18))
    got = ranking.split_lag(df, ["key"], levels, ["ts", "seq"], ["seq", "kind"], "old", hot_rows)
    want = {}
    for group in by_key(rows).values():
        for before, r in zip([None, *group], group):
            want[r[0]] = before and (before[0], before[3])
    assert {r.seq: r.old and tuple(r.old) for r in got.collect()} == {**{r[0]: None for r in rows}, **want}


def test_latest_and_merge_do_not_depend_on_row_order(spark):
    rows = [r for r in versions() if r[1] is not None]
    want = {k: v[-1][0] for k, v in by_key(rows).items()}
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.key: r.seq for r in state.upsert(df, ["key"], ["ts", "seq"]).collect()} == want
    first, rest = spark.createDataFrame(rows[:150], SCHEMA), spark.createDataFrame(rows[100:], SCHEMA)
    merged = state.merge_state(state.upsert(first, ["key"], ["ts", "seq"]), rest, ["key"], ["ts", "seq"])
    again = state.merge_state(merged, rest, ["key"], ["ts", "seq"])
    assert {r.key: r.seq for r in again.collect()} == want


def test_most_frequent_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (3, "z"), (3, None)], "k int, v string")
    assert {r.k: r.v for r in ranking.most_frequent(df, ["k"], "v").collect()} == {1: "a", 3: "z"}


def test_expiry_and_lookup(spark):
    now = state.as_of_literal("2024-01-02 00:00:00")
    df = spark.createDataFrame([(1, 1704153600), (2, 1704153601), (3, None)], "k bigint, ttl bigint")
    assert {r.k for r in state.alive(df, now).collect()} == {2, 3}
    many = list(range(2, 5000))
    assert {r.k for r in state.look_up(df, "k", many).collect()} == {2, 3}
    assert {r.k for r in state.look_up(df, "k", [1]).collect()} == {1}


def test_one_side_of_a_day_may_be_missing(spark, folder):
    from cartlake.sources import readers

    df = spark.createDataFrame([("1",)], "order_id string")
    assert state.combine_orders(None, df) is df and state.combine_orders(df, None) is df
    with pytest.raises(ValueError):
        state.combine_orders(None, None)
    with pytest.raises(FileNotFoundError):
        readers.read_day(spark, folder + "/e", folder + "/s", "2024-01-01")


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_rebill_number(spark, hot_rows):
    rng = random.Random(2)
    rows = [(str(i), rng.choice(["a", "a", "b", None]), START + timedelta(days=rng.randint(0, 3)), rng.random() < 0.8) for i in range(120)]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, created_at timestamp_ntz, is_subscription boolean")
    want = {r[0]: None for r in rows if r[3] and r[1] is None}
    for c in "ab":
        own = sorted((r for r in rows if r[3] and r[1] == c), key=lambda r: (r[2], int(r[0])))
        want |= {r[0]: i + 1 for i, r in enumerate(own)}
    got = curated.with_rebill_number(df, hot_rows)
    assert {r.order_id: r.rebill_number for r in got.collect()} == want


def test_windows_match_their_definition(spark):
    start, end, days = date(2024, 1, 1), date(2024, 1, 16), 7
    rows = backfill.windows(spark, start, end, days).orderBy("window_id").collect()
    edges, at, stop = [], datetime(2024, 1, 1), datetime(2024, 1, 17)
    while at < stop:
        edges.append((at, min(at + timedelta(days=days), stop)))
        at += timedelta(days=days)
    assert [(r.window_start, r.window_end) for r in rows] == edges
    moments = [datetime(2023, 12, 31, 23) + timedelta(hours=h) for h in range(0, 24 * 19)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    got = {(r.t, r.window_id) for r in backfill.assign_windows(df, "t", start, end, days).collect()}
    assert got == {(m, i) for m in moments for i, (a, b) in enumerate(edges) if a <= m <= b}


def test_erasure(spark):
    table = spark.createDataFrame([(i, i % 4) for i in range(20)], "id int, customer int")
    requests = spark.createDataFrame([(1,), (1,), (9,)], "c int")
    kept, audit = backfill.erase({"t": (table, "customer")}, requests, "c")
    assert kept["t"].filter("customer = 1").count() == 0 and kept["t"].count() == 15
    assert [tuple(r) for r in audit.collect()] == [("t", 5)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [1, 40, 10**6])
def test_salted_join_is_a_plain_join(spark, how, hot_rows):
    from cartlake.operators.skew import salted_join

    many = spark.createDataFrame(versions(), SCHEMA)
    one = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z"), (99, "q")], "key bigint, name string")
    got = salted_join(many, one, ["key"], how, hot_rows).select("seq", "name").collect()
    want = many.join(one, "key", how).select("seq", "name").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
