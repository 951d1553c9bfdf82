"""Late versions, as-of membership and maintained trends against plain Python."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from refinery.operators.history import ACTIVE, CHANGE, HASH, REPLACED, VALID_FROM, VALID_TO, change_set, scd1_merge, splice_changes, splice_versions
from refinery.operators.timeline import SLICES, carried, time_slices, with_next
from refinery.plans.marts import (
    DISTINCT_ERROR,
    RANK_ERROR,
    TREND_COLUMNS,
    daily_sketches,
    maintain_trend,
    member_asof,
    member_at_response,
    monthly_trend,
    read_sketches,
    rollup_sketches,
    trend_deltas,
    trend_grain,
)
from refinery.plans.queries import QUERIES, Silver, ntz
from refinery.sources import fixtures

DAY0 = dt.datetime(2024, 1, 1)
VERSION = f"k string, v string, {HASH} string, {ACTIVE} boolean, {VALID_FROM} timestamp, {VALID_TO} timestamp"


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def series(seed, n=400):
    """Rows of a few keys, one of which holds a third of them; some share a time."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", rng.randrange(60) if rng.random() < 0.9 else rng.randrange(9000), i,
             rng.randrange(100) if rng.random() < 0.3 else None) for i in range(n)]


@pytest.mark.parametrize("rows", [5, 1_000_000])
def test_next_and_carried_across_slices(spark, rows):
    data = series(1)
    df = spark.createDataFrame([(k, day(t), i, v) for k, t, i, v in data], "k string, at timestamp, i int, v int").repartition(3)
    sliced = time_slices(df, ["k"], "at", rows)
    per_slice = sliced.groupBy("k", *SLICES).count().collect()
    if rows == 5:
        hot = [r for r in per_slice if r.k == "hot"]
        assert len(hot) > 8 and max(r["count"] for r in hot) < 60  # the outlying times fill a first slice, which is cut again
    else:
        assert all(r[s] == 0 for r in per_slice for s in SLICES)
    order = sorted(data, key=lambda r: (r[0], r[1], r[2]))
    after = {a[2]: b[2] if a[0] == b[0] else None for a, b in zip(order, order[1:] + [("", 0, 0, 0)])}
    assert {r.i: r.nxt for r in with_next(df, ["k"], "at", ["i"], F.col("i"), "nxt", rows).collect()} == after
    last, most, state = {}, {}, {}
    for k, _, i, v in order:
        seen = state.setdefault(k, [])
        seen += [] if v is None else [v]
        last[i], most[i] = (seen[-1], max(seen)) if seen else (None, None)
    assert {r.i: r.c for r in carried(df, ["k"], "at", ["i"], F.col("v"), "c", rows).collect()} == last
    assert {r.i: r.c for r in carried(df, ["k"], "at", ["i"], F.col("v"), "c", rows, greatest=True).collect()} == most


def stored(spark, scratch, df):
    """A table between two steps, as it is on disk."""
    path = f"{scratch}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def versions(spark, rows):
    return spark.createDataFrame([(k, v, v, True, day(t), None) for k, t, v in rows], VERSION)


def table_rows(df):
    return sorted((r.k, r.v, r[ACTIVE], r[VALID_FROM], r[VALID_TO]) for r in df.collect())


def history_of(seen):
    """Of each key and time the greatest value, each up to the next."""
    out = []
    for k in {r[0] for r in seen}:
        at = {}
        for _, t, v in (r for r in seen if r[0] == k):
            at[t] = max(v, at.get(t, v))
        times = sorted(at)
        for t, nxt in zip(times, times[1:] + [None]):
            out.append((k, at[t], nxt is None, day(t), day(nxt)))
    return sorted(out, key=lambda r: (r[0], r[1], r[2], r[3], r[4] or DAY0))


def by_text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_arrival_gives_the_same_history(spark, scratch, seed):
    rng = random.Random(seed)
    seen = [(f"k{rng.randrange(6)}", rng.randrange(15), rng.choice("ABC")) for _ in range(45)]
    want = by_text(history_of(seen))
    for _ in range(2):
        rng.shuffle(seen)
        table = versions(spark, [])
        for i in range(0, len(seen), 15):
            table = stored(spark, scratch, splice_versions(table, versions(spark, seen[i : i + 15]), ["k"], slice_rows=4))
        assert by_text((r.k, r.v, r[ACTIVE], r[VALID_FROM], r[VALID_TO]) for r in table.collect()) == want
    # what is stored already changes nothing
    assert splice_changes(table, versions(spark, seen), ["k"]).count() == 0


def test_a_late_version_goes_between_its_neighbours(spark, scratch):
    table = stored(spark, scratch, splice_versions(versions(spark, []), versions(spark, [("a", 1, "x"), ("a", 9, "z"), ("b", 2, "x")]), ["k"]))
    changes = splice_changes(table, versions(spark, [("a", 5, "y"), ("c", 3, "w")]), ["k"])
    got = sorted((r.k, r.v, r[ACTIVE], r[VALID_FROM], r[VALID_TO], r[CHANGE]) for r in changes.collect())
    assert got == [("a", "x", False, day(1), day(5), "recut"), ("a", "y", False, day(5), day(9), "new"), ("c", "w", True, day(3), None, "new")]
    # rows without a key or a time have no place
    odd = spark.createDataFrame([(None, "v", "v", True, day(1), None), ("a", "v", "v", True, None, None)], VERSION)
    assert splice_changes(table, odd, ["k"]).count() == 0


def test_departures_end_what_was_valid_then(spark, scratch):
    table = stored(spark, scratch, splice_versions(versions(spark, []), versions(spark, [("a", 1, "x"), ("b", 1, "x"), ("b", 8, "y")]), ["k"]))
    gone = spark.createDataFrame([("a", day(6)), ("b", day(6)), ("z", day(6))], f"k string, {VALID_TO} timestamp")
    table = stored(spark, scratch, splice_versions(table, versions(spark, []), ["k"], gone))
    assert by_text(table_rows(table)) == by_text([("a", "x", False, day(1), day(6)), ("b", "x", False, day(1), day(6)), ("b", "y", True, day(8), None)])
    # late versions keep the end: one before it ends there, one after it is active
    table = stored(spark, scratch, splice_versions(table, versions(spark, [("a", 3, "l"), ("a", 7, "m")]), ["k"]))
    assert by_text(r for r in table_rows(table) if r[0] == "a") == by_text(
        [("a", "x", False, day(1), day(3)), ("a", "l", False, day(3), day(6)), ("a", "m", True, day(7), None)])


def rsvp_frames(spark, n=600):
    rng = random.Random(8)
    members = [f"m{i}" for i in range(12)]
    history = []
    for m in members + ["hot"]:
        for _ in range(rng.randrange(1, 9)):
            a = rng.randrange(100)
            history.append((m, rng.choice("AB"), rng.random() < 0.5, day(a), day(rng.choice([None, a + rng.randrange(-5, 30)]))))
    history.append((None, "A", True, day(0), None))
    events = [(f"e{i}", rng.choice("AB")) for i in range(20)]
    rsvps = [(f"r{i}", rng.choice([*(e for e, _ in events), "e-none"]), "hot" if i % 3 == 0 else rng.choice([*members, "m-none", None]),
              day(rng.choice([None, *range(120)]))) for i in range(n)]
    return (spark.createDataFrame(rsvps, "event_rsvp_id string, event_id string, membership_id string, responded_at timestamp").repartition(3),
            spark.createDataFrame(events, "event_id string, team_id string"),
            spark.createDataFrame(history, f"membership_id string, group_id string, {ACTIVE} boolean, {VALID_FROM} timestamp, {VALID_TO} timestamp"))


@pytest.mark.parametrize("rows", [20, 1_000_000])
def test_membership_as_of_the_answer(spark, rows):
    rsvps, events, history = rsvp_frames(spark)
    want = sorted(map(str, member_at_response(rsvps, events, history).collect()))
    assert sorted(map(str, member_asof(rsvps, events, history, rows).collect())) == want
    plan = member_asof(rsvps, events, history, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "<=" not in "".join(line for line in plan.splitlines() if "Join" in line)  # equi-joins alone


def test_trend_is_kept_up_by_changes(spark):
    """Answers that come, change event, month or status; events that change
    team, end and come back; groups that come to nothing."""
    rng = random.Random(5)
    schema = f"event_rsvp_id string, event_id string, responded_at_datekey int, rsvp_status long, {HASH} string, system_created_at timestamp"
    rsvps = spark.createDataFrame([], schema)
    events = spark.createDataFrame([], f"event_id string, team_id string, {ACTIVE} boolean")
    grain, trend = trend_grain(rsvps), monthly_trend(rsvps, events)
    for step in range(4):
        rows = [(f"r{i}", f"e{rng.randrange(8)}", 20240100 + 100 * rng.randrange(3) + 1 + rng.randrange(9), rng.randrange(3)) for i in rng.sample(range(90), 40)]
        batch = spark.createDataFrame([(*r, str(r), DAY0) for r in rows], schema)
        merged = scd1_merge(rsvps, batch, ["event_rsvp_id"]).persist()
        after = spark.createDataFrame([(f"e{i}", rng.choice("TUV"), rng.random() < 0.8) for i in range(8)], events.schema)
        trend, grain = maintain_trend(trend, grain, trend_deltas(rsvps, change_set(merged)), events, after)
        trend, grain = trend.persist(), grain.persist()
        rsvps, events = merged.drop(CHANGE), after
        assert sorted(map(str, trend.select(*sorted(trend.columns)).collect())) == sorted(
            map(str, (monthly_trend(rsvps, events).select(*sorted(trend.columns))).collect())), step


def test_superseded_values_come_with_the_change_set(spark):
    rng = random.Random(6)
    schema = f"event_rsvp_id string, event_id string, responded_at_datekey int, rsvp_status long, {HASH} string, system_created_at timestamp"
    first, second = (spark.createDataFrame([(f"r{i}", f"e{rng.randrange(8)}", 20240101, rng.randrange(3), str(rng.random()), DAY0) for i in rng.sample(range(90), 60)], schema)
                     for _ in range(2))
    plain, carrying = (scd1_merge(first, second, ["event_rsvp_id"], replaced=r) for r in ((), TREND_COLUMNS))
    assert sorted(map(str, carrying.drop(REPLACED).collect())) == sorted(map(str, plain.collect()))
    want = sorted(map(str, trend_deltas(first, change_set(plain)).collect()))
    got = trend_deltas(first.where("false"), change_set(carrying))
    assert want == sorted(map(str, got.collect())) and any("rsvps=-" in r for r in want)


def shipped_tables(spark, folder):
    """A few rows of each table that the bronze ones are derived from."""
    at = dt.datetime(1996, 3, 1)
    tables = {
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "nation": ([(n, f"N{n}", 0) for n in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(c, f"C{c}", c % 3, 0.0, "BUILDING") for c in range(1, 61)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": ([(o, 1 + o % 60, "O", 1.0, at + dt.timedelta(days=o % 90), "1") for o in range(1, 201)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(o, o % 7, 1, n, at + dt.timedelta(days=(o + n) % 70)) for o in range(1, 201) for n in range(1, 6)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("query", ["trend_incremental", "scd1_upsert_bucketed"])
def test_batches_are_derived_from_joins_made_once(spark, scratch, monkeypatch, query):
    shipped_tables(spark, scratch)
    read, found = [], fixtures.read_shipped
    monkeypatch.setattr(fixtures, "read_shipped", lambda s, d, name: read.append(name) or found(s, d, name))
    rows = QUERIES[query](spark, scratch)
    assert read.count("lineitem") == 1
    parent = Silver(spark, scratch).teams.accepted
    first, second = (Silver(spark, scratch, b, parent) for b in (1, 2))
    if query == "trend_incremental":
        want = monthly_trend(first.rsvps.accepted, first.events.accepted)
        rows = rows.where("batch = 1")
    else:
        want = scd1_merge(first.rsvps.accepted, second.rsvps.accepted, ["event_rsvp_id"])
        want = ntz(want)
    got = sorted(map(str, rows.select(*want.columns).collect()))
    assert got and got == sorted(map(str, want.collect()))


def test_sketches_roll_up_without_members(spark):
    """Days to months to years, within the stated errors of exact counts."""
    rng = random.Random(11)
    rows = [(f"e{rng.randrange(30)}", f"m{rng.randrange(9000)}", DAY0 + dt.timedelta(days=rng.randrange(700))) for _ in range(30000)]
    rsvps = spark.createDataFrame(rows, "event_id string, membership_id string, responded_at timestamp").withColumn(
        "responded_at_datekey", F.date_format("responded_at", "yyyyMMdd").cast("int"))
    events = spark.createDataFrame([(f"e{i}", "AB"[i % 2], DAY0 + dt.timedelta(days=30 * i)) for i in range(30)], "event_id string, team_id string, event_start timestamp")
    daily = daily_sketches(rsvps, events)
    assert set(daily.columns) == {"team_id", "datekey", "rsvps", "members", "ahead"}
    months = rollup_sketches(daily, F.floor(F.col("datekey") / 100).cast("int"), "datekey")
    got = {(r.team_id, r.year): r for r in read_sketches(rollup_sketches(months, F.floor(F.col("datekey") / 100).cast("int"), "year"), 0.25).collect()}
    team, begin = {f"e{i}": "AB"[i % 2] for i in range(30)}, {f"e{i}": DAY0 + dt.timedelta(days=30 * i) for i in range(30)}
    exact = {}
    for e, m, at in rows:
        exact.setdefault((team[e], at.year), []).append((m, (begin[e].date() - at.date()).days))
    assert set(got) == set(exact)
    for k, found in exact.items():
        members, ahead, n = {m for m, _ in found}, sorted(a for _, a in found), len(found)
        assert got[k].rsvps == n and abs(got[k].members - len(members)) <= DISTINCT_ERROR * len(members)
        below, upto = sum(a < got[k].ahead for a in ahead), sum(a <= got[k].ahead for a in ahead)
        assert below - RANK_ERROR * n <= 0.25 * n <= upto + RANK_ERROR * n
