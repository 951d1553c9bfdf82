"""End-to-end refresh against stored tables."""

import os
from contextlib import contextmanager

from pyspark.sql import functions as F

import refinery.plans.pipelines as pipelines
from refinery.operators.ranges import BITS, differing_ranges, in_ranges, key_range, range_digests
from refinery.plans.pipelines import read_quarantine, refresh
from refinery.plans.queries import QUERIES
from refinery.sources.fixtures import bronze_tables
from refinery.sources.tables import SILVER_SCHEMAS, ParquetTables, checkpoint_root

from shipped import SF


def files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def staged_folders(spark):
    """What lies in the staging folder (runs that were ended leave theirs)."""
    staged = os.path.join(checkpoint_root(spark).removeprefix("file:"), "refinery-stage")
    return set(os.listdir(staged)) if os.path.isdir(staged) else set()


def test_refresh_first_load_rerun_and_changes(spark, scratch):
    store = ParquetTables(spark, scratch, buckets=4)
    d, others = SF["0.001"], staged_folders(spark)

    s1 = refresh(spark, bronze_tables(spark, d, 1), store, as_of="2024-01-01 00:00:00")
    assert s1["teams"] == {"new": 18}
    for name in SILVER_SCHEMAS:
        assert store.read(name).columns == SILVER_SCHEMAS[name].names
    assert store.read("event_rsvps_refined").count() == s1["event_rsvps"]["new"] > 0
    rejected = read_quarantine(store).count()
    assert rejected > 0

    # unchanged input: no change and not one file more, rejected rows included
    before = files(scratch)
    s2 = refresh(spark, bronze_tables(spark, d, 1), store, as_of="2024-01-02 00:00:00")
    assert set(s2) == {"teams", "memberships", "events", "event_rsvps"} and not any(s2.values())
    assert files(scratch) == before
    assert read_quarantine(store).count() == rejected

    # second batch: inserts, updates, deletes and rows turning bad
    s3 = refresh(spark, bronze_tables(spark, d, 2), store, as_of="2024-01-03 00:00:00")
    assert s3["teams"] == {"new": 3, "changed": 2}
    assert s3["event_rsvps"]["changed"] > 0 and s3["memberships"]["departed"] > 0 and s3["events"]["changed"] > 0
    mem = store.read("memberships_refined")
    assert mem.where(F.col("system_is_active")).groupBy("membership_id").count().where("count > 1").count() == 0
    # closed versions keep their history
    assert mem.where(~F.col("system_is_active")).count() == s3["memberships"]["departed"] + s3["memberships"]["superseded"]
    q = read_quarantine(store)
    # a rejected row bears the time of the refresh that last checked its key range
    assert {str(r.refreshed_at) for r in q.select("refreshed_at").distinct().collect()} == {"2024-01-01 00:00:00", "2024-01-03 00:00:00"}
    assert q.where("table_name = 'event_rsvps'").select("refreshed_at").distinct().count() == 1
    assert q.where(F.col("dq_reason").isNull()).count() == 0
    # staged data is gone with the refresh
    assert staged_folders(spark) <= others


def one_team_changed(bronze):
    teams = bronze["teams"].withColumn("team_activity", F.when(F.col("team_id") == "T1", F.lit("CHANGED")).otherwise(F.col("team_activity")))
    return {**{t: bronze[t] for t in ("memberships", "events", "event_rsvps")}, "teams": teams}


def test_a_change_rewrites_its_bucket_alone(spark, scratch):
    store = ParquetTables(spark, scratch, buckets=8)
    bronze = bronze_tables(spark, SF["0.001"], 1)
    refresh(spark, bronze, store, as_of="2024-01-01 00:00:00", keep_quarantine=False)
    before = files(store.path("teams_refined"))
    stats = refresh(spark, one_team_changed(bronze), store, as_of="2024-01-02 00:00:00", keep_quarantine=False)
    assert stats["teams"] == {"changed": 1} and not stats["memberships"] and not stats["events"]
    after = files(store.path("teams_refined"))
    bucket = spark.createDataFrame([("T1",)], "team_id string").select(store.bucket_of("team_id")).first()[0]
    assert {f for f in set(before) ^ set(after)} and all(f"bucket={bucket}/" in f for f in set(before) ^ set(after))
    assert store.read("teams_refined").count() == 18
    assert store.read("teams_refined", buckets=[bucket]).where("team_id = 'T1'").first()["team_activity"] == "CHANGED"


def test_few_changed_keys_are_refreshed_by_their_ranges(spark, scratch, monkeypatch):
    """Same tables as a whole refresh; only the rows of differing ranges are
    checked, and their rejected rows replace the stored ones."""
    bronze = bronze_tables(spark, SF["0.001"], 1)
    rsvps = bronze["event_rsvps"]
    turned = rsvps.withColumn("rsvp_status", F.when(F.pmod(F.xxhash64("event_rsvp_id"), F.lit(200)) == 3, F.lit(9).cast("bigint")).otherwise(F.col("rsvp_status")))
    turned = turned.where(F.pmod(F.xxhash64("event_rsvp_id"), F.lit(200)) != 7)
    changed = {**{t: bronze[t] for t in ("teams", "memberships", "events")}, "event_rsvps": turned}
    seen = []
    whole = pipelines.rsvps_batch
    monkeypatch.setattr(pipelines, "rsvps_batch", lambda raw, *a, **k: (seen.append(raw.count()), whole(raw, *a, **k))[1])
    stores = [ParquetTables(spark, os.path.join(scratch, n), buckets=4) for n in ("steps", "whole")]
    for store in stores:
        refresh(spark, bronze, store, as_of="2024-01-01 00:00:00")
    # The second store forgets its digests, so it checks everything again.
    for table in ("teams", "memberships", "events", "event_rsvps"):
        stores[1].replace(f"digests/{table}", spark.createDataFrame([], pipelines.DIGESTS))
    seen.clear()
    counts = [refresh(spark, changed, store, as_of="2024-01-02 00:00:00") for store in stores]
    assert counts[0] == counts[1] and seen[0] < seen[1] / 5 and seen[1] == turned.count()
    for name in SILVER_SCHEMAS:
        assert stores[0].read(name).exceptAll(stores[1].read(name)).count() == 0 and stores[0].read(name).count() == stores[1].read(name).count()
    stored = [read_quarantine(s).drop("refreshed_at") for s in stores]
    assert stored[0].exceptAll(stored[1]).count() == 0 and stored[0].count() == stored[1].count()


def test_a_parent_change_is_not_skipped(spark, scratch):
    """A team that turns bad takes its members along, though their rows stay."""
    store = ParquetTables(spark, scratch, buckets=4)
    bronze = bronze_tables(spark, SF["0.001"])
    refresh(spark, bronze, store, as_of="2024-01-01 00:00:00")
    teams = bronze["teams"].where("team_id <> 'T1' or team_id is null").unionByName(
        bronze["teams"].where("team_id = 'T1'").withColumn("team_id", F.lit("T1000")))
    # type 1 never deletes: the stored T1 stays a parent; a new team makes new members possible
    members = bronze["memberships"].unionByName(bronze["memberships"].where("membership_id = 'M1'").select(
        F.lit("M-new").alias("membership_id"), F.lit("T1000").alias("group_id"), F.lit("member").alias("role_title"), "joined_at"))
    stats = refresh(spark, {**{t: bronze[t] for t in ("events", "event_rsvps")}, "teams": teams, "memberships": members}, store, as_of="2024-01-02 00:00:00")
    assert stats["teams"] == {"new": 1} and stats["memberships"] == {"new": 1} and not stats["events"]


def test_digest_trees_find_the_ranges_that_differ(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b"))
    df = df.unionByName(spark.createDataFrame([(None, 1, None), (None, None, 1)], "k string, a long, b long"))
    tree = range_digests(df, ["k"])
    assert differing_ranges(tree, range_digests(df.repartition(7), ["k"])).count() == 0
    # a changed, a missing, an added row, a NULL key's value moved to another column, and one of two equal rows
    changes = {"changed": df.withColumn("a", F.when(F.col("k") == "17", F.lit(99)).otherwise(F.col("a"))), "missing": df.where("k is null or k <> '18'"),
               "added": df.unionByName(spark.createDataFrame([("x", 1, 1)], "k string, a long, b long"))}
    for name, key in (("changed", "17"), ("missing", "18"), ("added", "x")):
        want = spark.createDataFrame([(key,)], "k string").select(key_range(["k"])).first()[0]
        ranges = differing_ranges(tree, range_digests(changes[name], ["k"]))
        assert [r.range for r in ranges.collect()] == [want], name
        assert in_ranges(changes[name], ["k"], ranges).count() < 30
    swapped = df.withColumns({"a": F.when(F.col("k").isNull(), F.col("b")).otherwise(F.col("a")), "b": F.when(F.col("k").isNull(), F.lit(None)).otherwise(F.col("b"))})
    assert differing_ranges(tree, range_digests(swapped, ["k"])).count() == 1
    twice = df.where("k = '5'")
    assert differing_ranges(tree, range_digests(df.unionByName(twice), ["k"])).count() == 1
    assert differing_ranges(range_digests(df.limit(0), ["k"]), tree).count() <= 1 << BITS
    assert differing_ranges(range_digests(df.limit(0), ["k"]), range_digests(df.limit(0), ["k"])).count() == 0


def test_a_write_takes_as_many_tasks_as_the_data_asks(spark, scratch):
    """A bucket above the advisory size is written by several tasks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        store = ParquetTables(spark, scratch, buckets=2)
        rows = spark.range(0, 60000, 1, 8).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("team_id"), F.sha2(F.col("id").cast("string"), 256).alias("team_activity"))
        for c in SILVER_SCHEMAS["teams_refined"].fields[2:]:
            rows = rows.withColumn(c.name, F.lit(None).cast(c.dataType))
        store.write("teams_refined", rows, "team_id", "created_at_datekey")
        assert len(files(scratch)) > 8 and store.read("teams_refined").count() == 60000
        assert all(store.read("teams_refined", buckets=[b]).count() > 0 for b in (0, 1))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_date_key_filter_reaches_the_scan(spark, scratch):
    store = ParquetTables(spark, scratch, buckets=2)
    refresh(spark, bronze_tables(spark, SF["0.001"], 1), store, as_of="2024-01-01 00:00:00", keep_quarantine=False)
    plan = store.read("event_rsvps_refined").where("responded_at_datekey >= 19980101")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(responded_at_datekey,19980101)" in plan


def test_without_a_quarantine_the_merge_is_the_only_reader(spark, scratch, monkeypatch):
    d, names, whole = SF["0.001"], [], pipelines.staging

    @contextmanager
    def watched(session):
        with whole(session) as stage:
            yield lambda df, name: names.append(name) or stage(df, name)

    monkeypatch.setattr(pipelines, "staging", watched)
    store = ParquetTables(spark, scratch, buckets=4)
    first = refresh(spark, bronze_tables(spark, d), store, as_of="2024-01-01 00:00:00", keep_quarantine=False)
    # neither the tagged rows nor the change set of a first load are stored in between
    assert {n.split("_")[0] for n in names} == {"digests"}
    kept = ParquetTables(spark, f"{scratch}-kept", buckets=4)
    assert refresh(spark, bronze_tables(spark, d), kept, as_of="2024-01-01 00:00:00") == first
    for name in SILVER_SCHEMAS:
        assert store.read(name).exceptAll(kept.read(name)).count() == 0 == kept.read(name).exceptAll(store.read(name)).count()


def test_the_quarters_are_counted_from_stored_rows(spark):
    assert not any("lineitem" in f for f in QUERIES["rsvps_by_quarter"](spark, SF["0.001"]).inputFiles())
