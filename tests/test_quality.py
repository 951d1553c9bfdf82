"""Operator tests for the quality rules on small inline frames."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from refinery.operators.quality import (
    REASON,
    ForeignKey,
    Predicate,
    Timestamps,
    UniqueKey,
    evaluate,
    check_event_rules,
    check_membership_rules,
    check_rsvp_rules,
    check_team_rules,
    check_unique_key,
    split,
    tag,
)


def test_unique_key_rejects_null_and_every_copy(spark):
    sightings = [("owl", 3, "oak"), ("owl", 3, "elm"), ("fox", 1, "den"), (None, 2, "den"), (None, 2, "den"),
                 ("elk", 5, "bog"), ("elk", 5, "bog"), ("elk", 6, "bog"), ("ELK", 5, "bog")]
    df = spark.createDataFrame(sightings, "animal string, day int, place string")
    good, bad = check_unique_key(df, "animal")
    assert sorted(map(tuple, good.collect())) == [("ELK", 5, "bog"), ("fox", 1, "den")]
    reasons = {}
    for r in bad.collect():
        reasons.setdefault((r.animal, r[REASON]), []).append((r.day, r.place))
    assert {k: sorted(v) for k, v in reasons.items()} == {
        ("owl", "duplicate_key"): [(3, "elm"), (3, "oak")],
        (None, "null_key"): [(2, "den"), (2, "den")],
        ("elk", "duplicate_key"): [(5, "bog"), (5, "bog"), (6, "bog")],
    }


def test_unique_key_any_column_position(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, k string")
    good, bad = check_unique_key(df, "k")
    assert good.columns == ["v", "k"] and [r.v for r in good.collect()] == [3]
    assert bad.columns == ["v", "k", REASON] and bad.count() == 2


def test_composite_unique_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (None, "a")], "x int, y string")
    good, bad = split(df, [UniqueKey(("x", "y"))])
    assert [tuple(r) for r in good.collect()] == [(1, "b")]
    assert bad.count() == 3


def test_foreign_key_semi_semantics_and_null(spark):
    child = spark.createDataFrame([("c1", "p1"), ("c2", "p2"), ("c3", None)], "id string, fk string")
    # the parent key repeats: the child row must not be multiplied
    parent = spark.createDataFrame([("p1",), ("p1",), (None,)], "pk string")
    good, bad = split(child, [ForeignKey("fk", parent, "pk")])
    assert [r.id for r in good.collect()] == ["c1"]
    assert sorted((r.id, r[REASON]) for r in bad.collect()) == [("c2", "unknown_fk"), ("c3", "unknown_fk")]


def test_timestamps_typed_good_raw_bad(spark):
    df = spark.createDataFrame([("a", "2023-01-01 08:00:00"), ("b", "2024-02-30"), ("c", ""), ("d", None)],
                               "id string, ts string")
    good, bad = split(df, [Timestamps(("ts",))])
    rows = good.collect()
    assert [r.id for r in rows] == ["a"] and rows[0].ts == dt.datetime(2023, 1, 1, 8, 0)
    assert dict(good.dtypes)["ts"] == "timestamp"
    assert sorted((r.id, r.ts) for r in bad.collect()) == [("b", "2024-02-30"), ("c", ""), ("d", None)]


def test_timestamps_row_local_with_repeated_ids(spark):
    # a bad row must not take its namesake with it (rows are judged alone)
    df = spark.createDataFrame([("x", "2023-01-01"), ("x", "bad")], "id string, ts string")
    good, bad = split(df, [Timestamps(("ts",))])
    assert good.count() == 1 and bad.count() == 1


def test_team_rules(spark):
    df = spark.createDataFrame([("t1", "a", "NO"), ("t2", None, "NO"), ("t3", "a", None), ("t4", None, None)],
                               "team_id string, team_activity string, country_code string")
    good, bad = check_team_rules(df)
    assert [r.team_id for r in good.collect()] == ["t1"]
    assert sorted((r.team_id, r[REASON]) for r in bad.collect()) == [
        ("t2", "null_activity"), ("t3", "null_country"), ("t4", "null_country")]


def test_event_rules_boundaries(spark):
    ts = dt.datetime(2024, 1, 1)
    later = dt.datetime(2024, 1, 2)
    rows = [
        ("ok", ts, later, 10.0, 20.0),
        ("nulls_ok", ts, later, None, None),
        ("equal", ts, ts, 1.0, 1.0),
        ("reverse", later, ts, 1.0, 1.0),
        ("half", ts, later, 1.0, None),
        ("lon", ts, later, 0.0, 180.5),
        ("lat", ts, later, -90.5, 0.0),
        ("edge", ts, later, -90.0, 180.0),
    ]
    df = spark.createDataFrame(rows, "event_id string, event_start timestamp, event_end timestamp, "
                                     "latitude double, longitude double")
    good, bad = check_event_rules(df)
    assert sorted(r.event_id for r in good.collect()) == ["edge", "nulls_ok", "ok"]
    assert dict((r.event_id, r[REASON]) for r in bad.collect()) == {
        "equal": "zero_length", "reverse": "start_after_end", "half": "half_null_coordinates",
        "lon": "coordinates_out_of_range", "lat": "coordinates_out_of_range"}


def test_membership_roles(spark):
    df = spark.createDataFrame([("m1", "member"), ("m2", "admin"), ("m3", "guest"), ("m4", None)],
                               "membership_id string, role_title string")
    good, bad = check_membership_rules(df)
    assert sorted(r.membership_id for r in good.collect()) == ["m1", "m2"]
    assert bad.count() == 2


def test_rsvp_team_membership(spark):
    events = spark.createDataFrame([("e1", "T1"), ("e2", "T2")], "event_id string, team_id string")
    members = spark.createDataFrame([("m1", "T1"), ("m2", "T2")], "membership_id string, group_id string")
    rsvps = spark.createDataFrame(
        [("r1", "e1", "m1", 1), ("r2", "e1", "m2", 1), ("r3", "e1", "m1", 4), ("r4", "e1", "m1", None),
         ("r5", "e9", "m1", 0)],
        "event_rsvp_id string, event_id string, membership_id string, rsvp_status bigint")
    good, bad = check_rsvp_rules(rsvps, members, events)
    assert [r.event_rsvp_id for r in good.collect()] == ["r1"]
    assert dict((r.event_rsvp_id, r[REASON]) for r in bad.collect()) == {
        "r2": "not_team_member", "r3": "status_range", "r4": "status_range", "r5": "not_team_member"}


def test_partition_invariant(spark):
    """accepted ∪ rejected = input (as a bag), for a stack of rules."""
    df = spark.range(200).select(
        F.when(F.col("id") % 17 == 0, None).otherwise((F.col("id") % 150).cast("string")).alias("k"),
        F.when(F.col("id") % 7 == 0, F.lit("x")).otherwise(F.lit("2024-01-01")).alias("ts"),
        (F.col("id") % 5).alias("v"))
    rules = [UniqueKey("k"), Timestamps(("ts",)), Predicate("v < 4", "v_range")]
    good, bad = split(df, rules)
    assert good.count() + bad.count() == df.count()
    back = good.select("k", F.col("ts").cast("string").substr(1, 10).alias("ts"), "v").unionByName(
        bad.select("k", "ts", "v"))
    assertDataFrameEqual(back, df)
    t = tag(df, rules)
    assert t.where(F.col(REASON).isNull()).count() == good.count()


def test_rules_do_not_depend_on_row_or_column_order(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "k string, v string")
    g1, b1 = split(df, [UniqueKey("k")])
    g2, b2 = split(df.select("v", "k").orderBy(F.desc("v")), [UniqueKey("k")])
    assertDataFrameEqual(g1, g2.select("k", "v"))
    assertDataFrameEqual(b1, b2.select("k", "v", REASON))


def test_rows_that_fail_leave_the_accepted_ones_before_the_joins(spark):
    parent = spark.createDataFrame([("p",)], "pk string")
    df = spark.createDataFrame([("a", "p", 1), ("b", "q", 1), ("c", "p", 9), ("d", None, 1), ("e", "p", None), ("f", "p", 1), ("f", "p", 1)], "k string, fk string, n int")
    tagged = evaluate(df, [UniqueKey("k"), ForeignKey("fk", parent, "pk"), Predicate(F.col("n") < 5, "big")])
    assert [tuple(r) for r in tagged.accepted().collect()] == [("a", "p", 1)]
    assert {(r.k, r.dq_reason) for r in tagged.rejected().collect()} == {
        ("b", "unknown_fk"), ("c", "big"), ("d", "unknown_fk"), ("e", "big"), ("f", "duplicate_key")}
    plan = tagged.accepted()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "coalesce" not in plan, plan
