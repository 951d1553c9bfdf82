"""Type-1 / type-2 history: edge cases on inline frames, the three-batch
scenario of FIXTURES.md section 5, and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from refinery.operators.history import (
    ACTIVE,
    CHANGE,
    VALID_FROM,
    VALID_TO,
    apply_scd1,
    apply_scd2,
    changed_rows,
    scd1_merge,
    scd2_changes,
    scd2_close,
    scd2_merge,
    stamp_scd1,
    stamp_scd2,
)
from refinery.plans.queries import Scenario
from refinery.sources.tables import SILVER_SCHEMAS

from shipped import SF

D1, D2, D3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def _batch(spark, rows, t=D1):
    """rows: (key, value) or (key, value, valid_from)."""
    df = spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else t) for r in rows],
                               "k string, v string, ts timestamp")
    return stamp_scd2(df, "ts")


def _empty2(spark):
    return _batch(spark, []).limit(0)


def test_digest_marks_nulls_and_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("ab", "", None), ("a", "b", "")],
                               "x string, y string, z string")
    hashes = [r.hash_key for r in stamp_scd1(df, as_of="2024-01-01").collect()]
    assert len(set(hashes)) == 4


def test_scd1_upsert_keeps_creation_time(spark):
    t0 = spark.createDataFrame([("a", "1", D1), ("b", "1", D1)], "k string, v string, ts timestamp")
    target = stamp_scd1(t0, "ts")
    batch = stamp_scd1(spark.createDataFrame([("a", "2", D2), ("b", "1", D1), ("c", "1", D2)],
                                             "k string, v string, ts timestamp"), "ts")
    merged = {r.k: r for r in scd1_merge(target, batch, ["k"]).collect()}
    assert {k: r[CHANGE] for k, r in merged.items()} == {"a": "changed", "b": "same", "c": "new"}
    assert merged["a"].v == "2" and merged["a"].system_created_at == D1 and merged["a"].system_updated_at == D2
    # unchanged batch → nothing changes, and the change set is empty
    again = apply_scd1(target, target, ["k"])
    assert changed_rows(target, again, ["k"]).count() == 0
    # type 1 never deletes
    assert apply_scd1(target, batch.where("k = 'c'"), ["k"]).count() == 3


def test_changed_rows_keeps_new_key_with_equal_values(spark):
    t = stamp_scd1(spark.createDataFrame([("a", "1")], "k string, v string"), as_of="2024-01-01",
                   digest_columns=["v"])
    b = stamp_scd1(spark.createDataFrame([("b", "1")], "k string, v string"), as_of="2024-01-01",
                   digest_columns=["v"])
    assert changed_rows(b, t, ["k"]).count() == 1


def test_scd2_supersede_depart_return_revert(spark):
    s1 = apply_scd2(_empty2(spark), _batch(spark, [("a", "A"), ("b", "B"), ("c", "C")], D1), ["k"], D1)
    # a changes A→X, b leaves the source, c unchanged
    b2 = _batch(spark, [("a", "X", D2), ("c", "C", D1)])
    s2 = apply_scd2(s1, b2, ["k"], D2)
    rows = {(r.k, r.v, r[ACTIVE]): r for r in s2.collect()}
    assert len(rows) == 4
    assert rows[("a", "A", False)][VALID_TO] == D2 and rows[("a", "X", True)][VALID_TO] is None
    assert rows[("b", "B", False)][VALID_TO] == D2
    assert rows[("c", "C", True)][VALID_FROM] == D1
    # a reverts X→A, b returns unchanged: both open new versions
    s3 = apply_scd2(s2, _batch(spark, [("a", "A", D3), ("b", "B", D3), ("c", "C", D1)]), ["k"], D3)
    active = {r.k: r.v for r in s3.where(F.col(ACTIVE)).collect()}
    assert active == {"a": "A", "b": "B", "c": "C"}
    assert s3.count() == 6
    # re-running the same batch changes nothing
    m = scd2_merge(s3, _batch(spark, [("a", "A", D3), ("b", "B", D3), ("c", "C", D1)]), ["k"], D3)
    assert {r[CHANGE] for r in m.collect()} <= {"same", "history"}


def test_scd2_rejected_row_is_held_not_closed(spark):
    s1 = apply_scd2(_empty2(spark), _batch(spark, [("a", "A"), ("b", "B")]), ["k"], D1)
    raw_keys = spark.createDataFrame([("a",), ("b",)], "k string")  # b is in the source but failed a check
    accepted = _batch(spark, [("a", "A")])
    m = {r.k: r[CHANGE] for r in scd2_merge(s1, accepted, ["k"], D2, present=raw_keys).collect()}
    assert m == {"a": "same", "b": "held"}
    m2 = {r.k: r[CHANGE] for r in scd2_merge(s1, accepted, ["k"], D2).collect()}
    assert m2 == {"a": "same", "b": "departed"}


def test_scd2_changes_and_close_halves(spark):
    s1 = apply_scd2(_empty2(spark), _batch(spark, [("a", "A"), ("b", "B")]), ["k"], D1)
    b2 = _batch(spark, [("a", "X"), ("n", "N")], D2)
    new, gone = scd2_changes(b2, s1, ["k"])
    assert sorted(r.k for r in new.collect()) == ["a", "n"]
    assert [r.k for r in gone.collect()] == ["b"]
    closed = scd2_close(s1, b2, ["k"], D2)
    assert closed.count() == 2 and closed.where(F.col(ACTIVE)).count() == 0


# Expected counts from FIXTURES.md section 5 (an independent key → version model).
EXPECTED = {
    ("teams", "0.001"): [(18, 0, 0, None, 18, 18), (3, 2, 13, None, 21, 21), (0, 2, 17, None, 21, 21)],
    ("teams", "0.01"): [(18, 0, 0, None, 18, 18), (3, 2, 13, None, 21, 21), (0, 2, 17, None, 21, 21)],
    ("memberships", "0.001"): [(92, 0, 0, 0, 92, 92), (10, 11, 61, 12, 90, 113), (12, 11, 79, 0, 102, 136)],
    ("memberships", "0.01"): [(930, 0, 0, 0, 930, 930), (100, 109, 606, 108, 922, 1139),
                              (108, 109, 811, 0, 1030, 1356)],
    ("events", "0.001"): [(951, 0, 0, 0, 951, 951), (120, 105, 642, 103, 968, 1176), (103, 105, 858, 0, 1071, 1384)],
    ("events", "0.01"): [(9625, 0, 0, 0, 9625, 9625), (1085, 1057, 6431, 1060, 9650, 11767),
                         (1060, 1052, 8561, 0, 10710, 13879)],
}
EXPECTED_CLOSE_REJECTED = {
    ("memberships", "0.001"): [(10, 11, 61, 20, 82, 113), (20, 11, 71, 0, 102, 144)],
    ("memberships", "0.01"): [(100, 109, 606, 215, 815, 1139), (215, 109, 704, 2, 1028, 1463)],
    ("events", "0.001"): [(120, 105, 642, 204, 867, 1176), (203, 105, 758, 4, 1066, 1484)],
    ("events", "0.01"): [(1085, 1057, 6431, 2137, 8573, 11767), (2128, 1052, 7493, 28, 10673, 14947)],
}


def _summary(merged, scd2: bool):
    c = {r[CHANGE]: r["n"] for r in merged.groupBy(CHANGE).agg(F.count("*").alias("n")).collect()}
    table = merged.drop(CHANGE)
    active = table.where(F.col(ACTIVE)).count() if scd2 else table.count()
    return (c.get("new", 0), c.get("changed", 0), c.get("same", 0),
            c.get("departed", 0) if scd2 else None, active, table.count())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_three_batch_scenario(spark, sf):
    sc = Scenario(spark, SF[sf])
    for table in ("teams", "memberships", "events"):
        got = [_summary(m, table != "teams") for m in sc.states[table]]
        assert got == EXPECTED[(table, sf)], table


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_three_batch_scenario_close_rejected(spark, sf):
    sc = Scenario(spark, SF[sf], close_rejected=True)
    for table in ("memberships", "events"):
        got = [_summary(m, True) for m in sc.states[table][1:]]
        assert got == EXPECTED_CLOSE_REJECTED[(table, sf)], table


def test_scenario_invariants(spark):
    sc = Scenario(spark, SF["0.001"])
    for table, key in (("memberships", "membership_id"), ("events", "event_id")):
        final = sc.table(table, 3)
        # at most one active version per key; closed versions have valid_to
        assert final.where(F.col(ACTIVE)).groupBy(key).count().where("count > 1").count() == 0
        assert final.where(~F.col(ACTIVE) & F.col(VALID_TO).isNull()).count() == 0
        assert final.where(F.col(ACTIVE) & F.col(VALID_TO).isNotNull()).count() == 0
        assert list(final.columns) == SILVER_SCHEMAS[f"{table}_refined"].names


def test_merges_state_constraints_once_per_row(spark):
    """The digest names every column.  If a merge renames them, the optimizer
    states that constraint for each choice of old and new names, 2^columns."""
    columns = [f"c{i}" for i in range(9)]
    rows = spark.createDataFrame([("a", *columns, D1), ("b", *columns, D1)], f"k string, {', '.join(f'{c} string' for c in columns)}, ts timestamp")
    batch = stamp_scd2(rows, "ts")
    nothing = batch.where(F.lit(False))
    merged = scd2_merge(nothing, batch, ["k"], D1)
    plan, found = merged._jdf.queryExecution().optimizedPlan(), []
    while plan.children().size():
        if plan.nodeName() == "Project":
            found.append(plan.getAllValidConstraints(plan.projectList()).size())
        plan = plan.children().apply(0)
    assert found and max(found) < 2 ** len(columns)
    # a chain of them is planned and gives its rows
    final = apply_scd2(apply_scd2(merged.drop(CHANGE), batch.where("k = 'a'"), ["k"], D2), batch, ["k"], D3)
    assert sorted((r.k, r[ACTIVE], r[VALID_TO]) for r in final.collect()) == [("a", True, None), ("b", False, D2), ("b", True, None)]
