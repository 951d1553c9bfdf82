"""Table layer: layers by environment, CSV load."""

import os

from pyspark.sql import functions as F

from refinery.operators.history import scd1_merge, stamp_scd1
from refinery.plans.pipelines import events_batch, quarantine, staged_counts, teams_batch
from refinery.functions.columns import packed_digest
from refinery.sources.tables import BRONZE_SCHEMAS, MALFORMED, SILVER_SCHEMAS, bucketed_table, conform, create_layers, empty, moved, read_bronze_csv, staging


def test_layers_are_created_once_per_environment(spark):
    names = create_layers(spark, "trial")
    assert len(names) == 9 and create_layers(spark, "trial") == names
    for name in names:
        assert spark.table(name).count() == 0
    bronze = spark.table("trial_bronze.events")
    assert bronze.schema.simpleString() == BRONZE_SCHEMAS["events"].simpleString()
    for layer in ("bronze", "silver"):
        spark.sql(f"DROP SCHEMA trial_{layer} CASCADE")


def test_csv_numbers_that_do_not_parse_are_quarantined(spark, scratch):
    teams = os.path.join(scratch, "teams.csv")
    with open(teams, "w") as f:
        f.write("team_id,team_activity,country_code,created_at\nT1,run,NO,2024-01-01 08:00:00\n")
    events = os.path.join(scratch, "events.csv")
    with open(events, "w") as f:
        f.write("event_id,team_id,event_start,event_end,latitude,longitude,created_at\n"
                "E1,T1,2024-02-01 10:00:00,2024-02-01 12:00:00,59.9,10.7,2024-01-05 00:00:00\n"
                "E2,T1,2024-02-01 10:00:00,2024-02-01 12:00:00,north,10.7,2024-01-05 00:00:00\n"
                "E3,T1,2024-02-01 10:00:00,2024-02-01 12:00:00,,,2024-01-05 00:00:00\n")
    t = teams_batch(read_bronze_csv(spark, teams, "teams"))
    bronze = read_bronze_csv(spark, events, "events")
    assert [r[MALFORMED] for r in bronze.orderBy("event_id").collect()] == [None, "latitude=north", None]
    b = events_batch(bronze, t.accepted)
    assert sorted(r.event_id for r in b.accepted.collect()) == ["E1", "E3"]
    rejected = quarantine(b, "2024-03-01").collect()
    assert [(r.record_key, r.dq_reason) for r in rejected] == [("E2", "malformed_number")] and "latitude=north" in rejected[0].raw_row


def test_bucketed_tables_merge_without_a_shuffle_of_the_stored_side(spark, scratch):
    """Several files a bucket, written by as many tasks; in the merge's plan
    only the batch is exchanged."""
    rows = spark.range(0, 4000, 1, 4).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("team_id"), F.lit("run").alias("team_activity"),
                                             F.lit("NO").alias("country_code"), F.lit("2024-01-01 08:00:00").alias("created_at"))
    accepted = teams_batch(rows).accepted
    name = "bucketed_teams_test"
    try:
        stored = bucketed_table(accepted, name, "team_id", os.path.join(scratch, "t"), buckets=8, files_per_bucket=3)
        files = [f for f in os.listdir(os.path.join(scratch, "t")) if f.startswith("part")]
        assert len(files) == 24 and len({f.split("_")[-1].split(".")[0] for f in files}) == 8
        batch = accepted.where("team_id < 'T3'").withColumn("hash_key", F.lit("other")).limit(500)
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            merged = scd1_merge(stored, batch, ["team_id"])
            assert sorted(r.change for r in merged.select("change").distinct().collect()) == ["changed", "kept"] and merged.count() == 4000
            plan = merged._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if name in line)
        join = max(i for i, line in enumerate(lines[:scan]) if "SortMergeJoin" in line)
        assert "Bucketed: true" in lines[scan] and not any("Exchange" in line for line in lines[join:scan])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_rules_are_counted_during_the_one_write(spark, scratch):
    """Counts of the write equal a count of the tagged rows, and no source is
    read again for them or for what follows."""
    path = os.path.join(scratch, "bronze")
    rows = [(f"T{i % 90}", None if i % 7 == 0 else "run", None if i % 5 == 0 else "NO", "bad" if i % 11 == 0 else "2024-01-01 08:00:00") for i in range(100)]
    spark.createDataFrame(rows, BRONZE_SCHEMAS["teams"]).write.parquet(path)
    plain = teams_batch(spark.read.parquet(path))
    want = {r.dq_reason: r["count"] for r in plain.tagged.rejected().groupBy("dq_reason").count().collect()}
    counts = {}
    with staging(spark) as stage:
        batch = teams_batch(spark.read.parquet(path), through=staged_counts(stage, counts))
        assert counts == {"teams": {"rows": 100, **want}}
        for df in (batch.accepted, batch.tagged.rejected()):
            assert path not in df._jdf.queryExecution().optimizedPlan().toString() and path not in str(df.inputFiles())
        assert sorted(map(str, batch.accepted.collect())) == sorted(map(str, plain.accepted.collect()))
        assert sorted(map(str, batch.tagged.rejected().collect())) == sorted(map(str, plain.tagged.rejected().collect()))


def test_digests_travel_packed_and_come_back(spark, scratch):
    texts = ["0a" * 32, "0A" * 32, "0a" * 31, "0a" * 32 + "\n", "", "h1", None]
    df = spark.createDataFrame([(t,) for t in texts], "hash_key string")
    assert sorted(r[0] or "-" for r in moved(df, lambda rows: rows.repartition(3)).collect()) == sorted(t or "-" for t in texts)
    assert sorted(r[0] or 0 for r in df.select(F.octet_length(packed_digest("hash_key"))).collect()) == sorted(
        [0 if t is None else 32 if t == texts[0] else 33 + len(t) for t in texts])
    with staging(spark) as stage:
        assert all(f.endswith(".zstd.parquet") for f in stage(df, "digests").inputFiles())


def test_digests_of_travelling_columns_are_taken_after_the_move(spark, scratch):
    digest, name = ["k", "v"], "digest_columns_test"
    first, second = (stamp_scd1(spark.range(n).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > m, "x").alias("v")), as_of="2024-01-01", digest_columns=digest)
                     for n, m in ((60, 0), (80, 1)))
    try:
        stored = bucketed_table(first, name, "k", os.path.join(scratch, "t"), buckets=4, files_per_bucket=2, digest_columns=digest)
        assert stored.columns == first.columns and sorted(map(str, stored.collect())) == sorted(map(str, first.collect()))
        plain, late = (scd1_merge(stored, second, ["k"], digest_columns=c) for c in (None, digest))
        assert sorted(map(str, late.collect())) == sorted(map(str, plain.collect()))
        assert {r["change"] for r in late.select("change").distinct().collect()} == {"new", "changed", "same"}
        lines = late._jdf.queryExecution().optimizedPlan().toString().splitlines()
        join = next(i for i, line in enumerate(lines) if "Join FullOuter" in line)
        assert any("sha2(" in line for line in lines[:join]) and not any("sha2(" in line for line in lines[join:])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_merge_into_no_rows_moves_nothing(spark):
    batch = spark.createDataFrame([("R1", "0a" * 32)], "event_rsvp_id string, hash_key string")
    schema = SILVER_SCHEMAS["event_rsvps_refined"]
    merged = scd1_merge(empty(spark, schema), conform(batch.select("*", *[F.lit(None).alias(c) for c in schema.names if c not in batch.columns]), schema), ["event_rsvp_id"])
    assert [(r.event_rsvp_id, r.hash_key, r.change) for r in merged.collect()] == [("R1", "0a" * 32, "new")]
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()
