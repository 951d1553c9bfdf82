"""Micro-batch refresh from a stream of bronze change files."""

import os

from pyspark.sql import functions as F

from refinery.plans.pipelines import events_batch, refresh
from refinery.sources.fixtures import bronze_tables
from refinery.sources.tables import ParquetTables
from refinery.streaming import bronze_stream, refresh_stream, release, unique_changes

from shipped import SF


def test_stream_of_team_changes(spark, scratch):
    store = ParquetTables(spark, os.path.join(scratch, "silver"))
    inbox = os.path.join(scratch, "inbox")
    b = bronze_tables(spark, SF["0.001"])
    # first file: the whole table; second: a change set touching two teams
    b["teams"].write.parquet(os.path.join(inbox, "f1"))
    seen = []
    ckpt = os.path.join(scratch, "stream-ckpt")
    q = refresh_stream(bronze_stream(spark, inbox + "/*", "teams"), "teams", store, checkpoint=ckpt,
                       on_batch=lambda e, c: seen.append(c))
    q.awaitTermination(120)
    assert seen and seen[0].get("new") == 20  # T23 twice: two changes of it, the later one counts
    first = store.read("teams_refined").collect()  # the next refresh replaces files
    assert len(first) == 20

    # two changes of T1 (the later by time counts, whatever their order) and a bad T2
    change = b["teams"].where("team_id = 'T1'").withColumn("team_activity", F.explode(F.array(F.lit("LAST"), F.lit("FIRST"))))
    change = change.withColumn("created_at", F.when(F.col("team_activity") == "LAST", "2024-05-02 00:00:00").otherwise("2024-05-01 00:00:00"))
    bad = b["teams"].where("team_id = 'T2'").withColumn("created_at", F.lit("never"))
    change.unionByName(bad).write.parquet(os.path.join(inbox, "f2"))
    seen.clear()
    # the same checkpoint: only the new file is read
    q = refresh_stream(bronze_stream(spark, inbox + "/*", "teams"), "teams", store, checkpoint=ckpt,
                       on_batch=lambda e, c: seen.append(c))
    q.awaitTermination(120)
    assert seen == [{"changed": 1}]
    after = store.read("teams_refined")
    assert after.count() == 20
    assert [r.team_activity for r in after.where("team_id = 'T1'").collect()] == ["LAST"]
    assert after.where("team_id = 'T2'").collect() == [r for r in first if r.team_id == "T2"]
    rejected = spark.read.parquet(os.path.join(scratch, "silver", "quarantine_stream", "teams"))
    assert [(r.record_key, r.dq_reason) for r in rejected.where("epoch = 1").collect()] == [("T2", "bad_timestamp")]


def test_changes_that_wait_for_their_parents(spark, scratch):
    """RSVPs come before their events, which come two batches later: the end
    is the batch result, and what waited too long is rejected."""
    b = bronze_tables(spark, SF["0.001"])
    teams, members, events = (b[t] for t in ("teams", "memberships", "events"))
    once = b["event_rsvps"].join(b["event_rsvps"].groupBy("event_rsvp_id").count().where("count = 1"), "event_rsvp_id", "left_semi")
    # parents with one row per key, so that a stream of changes accepts what a batch does
    members, events = (df.join(df.groupBy(k).count().where("count = 1"), k, "left_semi") for df, k in ((members, "membership_id"), (events, "event_id")))
    teams = teams.where("team_id <> 'T23'")
    late = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    batch = ParquetTables(spark, os.path.join(scratch, "batch"), buckets=2)
    refresh(spark, {"teams": teams, "memberships": members, "events": events, "event_rsvps": once}, batch, as_of="2024-01-01 00:00:00", keep_quarantine=False)

    store = ParquetTables(spark, os.path.join(scratch, "stream"), buckets=2)
    refresh(spark, {"teams": teams, "memberships": members, "events": events.where(~late), "event_rsvps": once.limit(0)}, store,
            as_of="2024-01-01 00:00:00", keep_quarantine=False)
    inbox = os.path.join(scratch, "inbox")

    def send(df, epoch):
        df.coalesce(1).write.parquet(os.path.join(inbox, f"f{epoch}"))
        q = refresh_stream(bronze_stream(spark, inbox + "/*", "event_rsvps"), "event_rsvps", store, checkpoint=os.path.join(scratch, "ckpt"),
                           as_of=lambda e: f"2024-01-0{e + 1} 00:00:00", wait="3 days")
        q.awaitTermination(300)

    part = F.pmod(F.xxhash64("event_rsvp_id"), F.lit(2))
    send(once.where(part == 0), 0)
    waiting = spark.read.parquet(store.path("waiting/event_rsvps"))
    assert waiting.count() > 0 and store.read("event_rsvps_refined").count() < batch.read("event_rsvps_refined").count() / 2
    # the first half's late parents arrive with nothing new for RSVPs, the second half follows
    first = waiting.select("event_id").distinct().collect()
    arrived = events.where(late)
    changes = events_batch(arrived, store.read("teams_refined")).accepted
    store.write("events_refined", store.read("events_refined").unionByName(changes), "event_id", "created_at_datekey")
    assert release(spark, "event_rsvps", store, "3 days", as_of="2024-01-02 00:00:00").get("new", 0) > 0 and first
    send(once.where(part == 1), 1)
    want = batch.read("event_rsvps_refined")
    got = store.read("event_rsvps_refined")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    # what is left names parents that never come: still waiting within three days, rejected after
    left = spark.read.parquet(store.path("waiting/event_rsvps"))
    assert left.count() > 0
    n = left.count()
    release(spark, "event_rsvps", store, "3 days", as_of="2024-01-09 00:00:00")
    assert spark.read.parquet(store.path("waiting/event_rsvps")).count() == 0
    rejected = spark.read.parquet(os.path.join(store.root, "quarantine_stream", "event_rsvps"))
    assert rejected.where("refreshed_at = '2024-01-09'").count() == n
    assert "waiting_since" not in rejected.first()["raw_row"]


def test_late_versions_of_a_stream_go_into_the_history(spark, scratch):
    b = bronze_tables(spark, SF["0.001"])
    one = b["memberships"].where("membership_id = 'M1'").limit(1).withColumn("role_title", F.lit("member")).withColumn("group_id", F.lit("T1"))
    days = ["2023-05-03 00:00:00", "2023-05-09 00:00:00", "2023-05-01 00:00:00", "2023-05-05 00:00:00"]
    histories = []
    for turn, order in enumerate((days, sorted(days))):
        store = ParquetTables(spark, os.path.join(scratch, f"s{turn}"), buckets=2)
        refresh(spark, {t: b[t] if t == "teams" else b[t].limit(0) for t in ("teams", "memberships", "events", "event_rsvps")}, store,
                as_of="2024-01-01 00:00:00", keep_quarantine=False)
        inbox = os.path.join(scratch, f"in{turn}")
        for i in (0, 2):  # two changes of the key per micro-batch
            one.withColumn("joined_at", F.explode(F.array(*[F.lit(x) for x in order[i : i + 2]]))).coalesce(1).write.parquet(f"{inbox}/f{i}")
            refresh_stream(bronze_stream(spark, inbox + "/*", "memberships"), "memberships", store, checkpoint=os.path.join(scratch, f"c{turn}"),
                           late_versions=True).awaitTermination(120)
        histories.append(sorted(map(str, store.read("memberships_refined").collect())))
        rows = store.read("memberships_refined").orderBy("system_valid_from").collect()
        assert [str(r.system_valid_from) for r in rows] == sorted(days)
        assert [r.system_valid_to for r in rows] == [r.system_valid_from for r in rows[1:]] + [None] and [r.system_is_active for r in rows] == [False] * 3 + [True]
    assert histories[0] == histories[1]


def test_repeated_changes_across_micro_batches(spark, scratch):
    """A file sent twice and late copies are dropped; the state is let go
    once the arrival times have moved on; nothing but copies is lost."""
    inbox = os.path.join(scratch, "inbox")
    os.makedirs(inbox)
    schema = "team_id string, team_activity string, country_code string, created_at string"
    start = 1_700_000_000
    day = 86_400

    def send(name, rows, at):
        path = os.path.join(scratch, f"w-{name}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        part = next(f for f in os.listdir(path) if f.startswith("part"))
        os.utime(os.path.join(path, part), (at, at))
        os.rename(os.path.join(path, part), os.path.join(inbox, f"{name}.parquet"))

    old = [(f"T{i}", "a", "NO", "2020-01-01 00:00:00") for i in range(50)]
    send("a", old, start)
    send("b", old[:30] + [("T1", "b", "NO", "2020-01-01 00:00:00"), ("T0", None, None, "bad")], start + day)  # a retry with two changes
    send("c", [("T900", "a", "NO", "1999-01-01 00:00:00")], start + 5 * day)  # an old business time is not late
    send("d", [("T901", "a", "NO", None)], start + 6 * day)
    send("e", [("T1", "b", "NO", "2020-01-01 00:00:00")], start + 9 * day)  # long after its first: goes through
    out, states = [], []
    stream = unique_changes(bronze_stream(spark, inbox, "teams", max_files_per_trigger=1), "2 days", F.col("_metadata.file_modification_time"))
    q = stream.writeStream.foreachBatch(lambda df, e: out.append([tuple(r) for r in df.collect()])).option(
        "checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    got = [rows for rows in out if rows]
    assert [len(rows) for rows in got] == [50, 2, 1, 1, 1]
    assert max(states) >= 52 and states[-1] <= 3
