"""Driver contract and small helpers."""

import os

import duckdb

import __spark_entry__ as E
from refinery.plans.queries import QUERIES
from refinery.sources.tables import checkpoint_root, staging

from shipped import SF

TABLES = ["region", "nation", "customer", "orders", "lineitem"]


def test_entry_runs_flagship(spark):
    df = E.entry(spark)
    assert df.count() == 2201  # FIXTURES.md section 4: accepted RSVPs at sf0.001
    assert "hash_key" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_building_a_query_runs_no_job(spark):
    """Plans are lazy; only a refresh, which writes tables, runs jobs."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        for name in ("id_rejected", "fk_multi_accepted", "rsvp_rules_accepted", "geo_nearest", "silver_rsvps", "quarantine_summary", "scd2_appended", "calendar"):
            QUERIES[name](spark, SF["0.001"])
        # schema discovery lists files and reads one footer per table
        kinds = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("building")]
        assert all(len(i.stageIds) == 1 and tracker.getStageInfo(i.stageIds[0]).numTasks == 1 for i in kinds if i)
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_key_rules_take_any_threshold_notation(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for value in ("10MB", "100m"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
            assert QUERIES["fk_accepted"](spark, SF["0.001"]).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_oracle_columns_match_spark_columns(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF['0.001']}/{t}.parquet')")
    sql = E.oracle_sql()
    for name in ("silver_events", "quarantine_summary", "scd2_next_snapshot", "calendar"):
        spark_cols = sorted(E.queries()[name](spark, SF["0.001"]).columns)
        duck_cols = sorted(con.sql(sql[name]).columns)
        assert spark_cols == duck_cols, name


def test_staging_cuts_lineage_and_leaves_nothing(spark):
    folder = os.path.join(checkpoint_root(spark).removeprefix("file:"), "refinery-stage")
    others = set(os.listdir(folder)) if os.path.isdir(folder) else set()  # of runs that were ended
    df = spark.range(1000).selectExpr("id", "id % 7 AS k").groupBy("k").count()
    with staging(spark) as stage:
        staged = stage(df, "counts")
        assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, df.collect()))
        # the staged frame is a plain file scan, no aggregate left in its plan
        assert "Aggregate" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert set(os.listdir(folder)) <= others
