"""Named queries over the shipped tables, one or more per operator.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Bronze inputs
are derived from the shipped Parquet (:mod:`refinery.sources.fixtures`);
every query runs over the whole tables.  Timestamps are returned as
``timestamp_ntz`` (wall-clock UTC) so other engines compare them as plain
timestamps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from refinery.operators.areas import containing_area
from refinery.operators.enrich import add_datekeys, nearest_place
from refinery.operators.history import (
    ACTIVE,
    CHANGE,
    REPLACED,
    VALID_TO,
    append_versions,
    change_set,
    changed_rows,
    scd1_merge,
    scd2_changes,
    scd2_close,
    splice_versions,
    stamp_scd1,
    stamp_scd2,
)
from refinery.operators.quality import (
    ForeignKey,
    Timestamps,
    UniqueKey,
    event_rules,
    membership_rules,
    rsvp_rules,
    split,
    team_rules,
)
from refinery.operators.ranges import differing_ranges, in_ranges, range_digests
from refinery.functions.columns import row_digest
from refinery.plans.marts import (
    DISTINCT_ERROR,
    RANK_ERROR,
    TREND_COLUMNS,
    by_calendar,
    calendar,
    daily_rolling,
    daily_sketches,
    maintain_trend,
    member_asof,
    member_at_response,
    monthly_trend,
    read_sketches,
    recent,
    rollup_sketches,
    trend_deltas,
    trend_grain,
)
from refinery.plans.pipelines import (
    Batch,
    events_batch,
    memberships_batch,
    merge_batch,
    quarantine,
    read_quarantine,
    refresh,
    rsvps_batch,
    silver_digest_columns,
    staged_counts,
    teams_batch,
)
from refinery.sources.fixtures import JOINED, areas_from_customers, bronze_tables, clustered_places, places_from_customers, points_around
from refinery.sources.tables import BRONZE_SCHEMAS, SILVER_SCHEMAS, ParquetTables, bucketed_table, checkpoint_root, conform, empty, write_parquet

Query = Callable[[SparkSession, str], DataFrame]
Store = Callable[[DataFrame, str], DataFrame]

# Refresh times of the three scenario batches.
AS_OF = ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00")


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock ``timestamp_ntz`` (session zone is UTC)."""
    return df.select(*[
        F.col(f.name).cast(TimestampNTZType()).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


class Silver:
    """The four first-load batches of one data directory, each built on
    first use (building a plan has a cost of its own)."""

    def __init__(self, spark: SparkSession, sf_dir: str, batch: int | None = None,
                 teams_parent: DataFrame | None = None, joined: dict[str, DataFrame] | None = None, store: Store | None = None):
        """``joined`` as in :func:`bronze_tables`; with a ``store`` the
        accepted events, which RSVPs and a history read, are stored once."""
        self.bronze = bronze_tables(spark, sf_dir, batch, joined)
        self._teams_parent = teams_parent
        self._store, self._name = store, f"batch_{batch or 'full'}"
        self._built: dict[str, Batch] = {}

    def _get(self, name: str, build) -> Batch:
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    @property
    def parent(self) -> DataFrame:
        return self.teams.accepted if self._teams_parent is None else self._teams_parent

    @property
    def teams(self) -> Batch:
        return self._get("teams", lambda: teams_batch(self.bronze["teams"]))

    @property
    def memberships(self) -> Batch:
        return self._get("memberships", lambda: memberships_batch(self.bronze["memberships"], self.parent))

    @property
    def events(self) -> Batch:
        def build() -> Batch:
            batch = events_batch(self.bronze["events"], self.parent)
            return replace(batch, accepted=self._store(batch.accepted, f"{self._name}_events")) if self._store else batch

        return self._get("events", build)

    @property
    def rsvps(self) -> Batch:
        return self._get("rsvps", lambda: rsvps_batch(
            self.bronze["event_rsvps"], self.memberships.accepted, self.events.accepted))


class Scenario:
    """Three batches (FIXTURES.md section 5) through teams (type 1) and
    memberships / events (type 2); parents are the accepted teams of the
    whole data.  ``states[t][i]`` is the merged frame (with ``change``) of
    table t after batch i+1, built on first use.

    With a ``store``, what several steps read is stored once: the joins below
    the bronze tables, the parents, the accepted events, and every state, so
    that a batch is merged into the stored state before it and the work grows
    with the number of batches, not with its square."""

    def __init__(self, spark: SparkSession, sf_dir: str, close_rejected: bool = False, store: Store | None = None):
        self.spark = spark
        self.close_rejected = close_rejected
        self.store = store
        joined = _stored_joins(spark, sf_dir, store) if store else None
        parent = Silver(spark, sf_dir).teams.accepted
        if store:
            parent = store(parent, "teams_parent")
        self.batches = [Silver(spark, sf_dir, b, parent, joined, store) for b in (1, 2, None)]
        self.states = _LazyStates(self)

    def _build(self, table: str) -> list[DataFrame]:
        target = empty(self.spark, SILVER_SCHEMAS[f"{table}_refined"])
        out = []
        for i, b in enumerate(self.batches):
            batch: Batch = getattr(b, table)
            merged = merge_batch(batch, target, AS_OF[i], b.bronze[table], self.close_rejected)
            if self.store:
                merged = self.store(merged, f"{table}_{i + 1}")
            out.append(merged)
            target = merged.drop(CHANGE)
        return out

    def table(self, name: str, after: int) -> DataFrame:
        return self.states[name][after - 1].drop(CHANGE)


class _LazyStates(dict):
    def __init__(self, scenario: Scenario):
        super().__init__()
        self._scenario = scenario

    def __missing__(self, table: str) -> list[DataFrame]:
        self[table] = self._scenario._build(table)
        return self[table]


def _bronze(name: str) -> Query:
    return lambda spark, d: bronze_tables(spark, d)[name]


def _id(spark, d, accepted: bool):
    acc, rej = split(bronze_tables(spark, d)["event_rsvps"], [UniqueKey("event_rsvp_id")])
    return acc if accepted else rej


def _fk(spark, d, accepted: bool):
    s = Silver(spark, d)
    acc, rej = split(s.bronze["memberships"], [ForeignKey("group_id", s.teams.accepted, "team_id")])
    return acc if accepted else rej


def _fk_multi(spark, d, accepted: bool):
    s = Silver(spark, d)
    acc, rej = split(s.bronze["event_rsvps"], [
        ForeignKey("event_id", s.events.accepted, "event_id"),
        ForeignKey("membership_id", s.memberships.accepted, "membership_id"),
    ])
    return acc if accepted else rej


def _ts(spark, d, accepted: bool):
    acc, rej = split(bronze_tables(spark, d)["events"], [Timestamps(("event_start", "event_end", "created_at"))])
    return ntz(acc) if accepted else rej


def _team_rules(spark, d, accepted: bool):
    acc, rej = split(bronze_tables(spark, d)["teams"], team_rules())
    return acc if accepted else rej


def _event_rules(spark, d, accepted: bool):
    acc, rej = split(bronze_tables(spark, d)["events"],
                     [Timestamps(("event_start", "event_end", "created_at")), *event_rules()])
    return ntz(acc) if accepted else rej


def _membership_rules(spark, d, accepted: bool):
    acc, rej = split(bronze_tables(spark, d)["memberships"], membership_rules())
    return acc if accepted else rej


def _rsvp_rules(spark, d, accepted: bool):
    s = Silver(spark, d)
    acc, rej = split(s.bronze["event_rsvps"], rsvp_rules(s.memberships.accepted, s.events.accepted))
    return acc if accepted else rej


def _datekeys(spark, d):
    ts = ["event_start", "event_end", "created_at"]
    acc, _ = split(bronze_tables(spark, d)["events"], [Timestamps(tuple(ts))])
    out = add_datekeys(acc, ts)
    return ntz(out.select("event_id", *[x for c in ts for x in (c, f"{c}_datekey")]))


def _geo_constant(spark, d):
    return Silver(spark, d).events.accepted.select("event_id", "latitude", "longitude", "county", "state")


def _geo_nearest(spark, d):
    events = bronze_tables(spark, d)["events"]
    return nearest_place(events, places_from_customers(spark, d), radius_km=500.0)


def _geo_nearest_clustered(spark, d):
    return nearest_place(points_around(spark, d), clustered_places(spark, d), radius_km=50.0)


def _geo_within(spark, d):
    return containing_area(bronze_tables(spark, d)["events"], areas_from_customers(spark, d))


def _row_digest(spark, d):
    ev = bronze_tables(spark, d)["events"]
    return ev.select("event_id", row_digest(ev.columns).alias("hash_key"))


def _quarantine_summary(spark, d):
    s = Silver(spark, d)
    rows = None
    for b in (s.teams, s.memberships, s.events, s.rsvps):
        q = quarantine(b).select("table_name", "dq_reason")
        rows = q if rows is None else rows.unionByName(q)
    return rows.groupBy("table_name", "dq_reason").agg(F.count(F.lit(1)).alias("rows"))


def _scd1_changed(spark, d):
    sc = Scenario(spark, d)
    return ntz(changed_rows(sc.batches[1].teams.accepted, sc.table("teams", 1), ["team_id"]))


def _scd2_new_versions(spark, d):
    sc = Scenario(spark, d)
    b = sc.batches[1]
    new, _ = scd2_changes(b.events.accepted, sc.table("events", 1), ["event_id"], b.bronze["events"].select("event_id"))
    return ntz(new)


def _scd2_departed(spark, d):
    sc = Scenario(spark, d)
    b = sc.batches[1]
    _, gone = scd2_changes(b.events.accepted, sc.table("events", 1), ["event_id"], b.bronze["events"].select("event_id"))
    return ntz(gone)


def _scenario_counts(close_rejected: bool) -> Query:
    def q(spark, d):
        sc = Scenario(spark, d, close_rejected)
        parts = []
        for table in ("teams", "memberships", "events"):
            for i, merged in enumerate(sc.states[table]):
                parts.append(merged.groupBy(CHANGE).agg(F.count(F.lit(1)).alias("rows")).select(
                    F.lit(table).alias("table_name"), F.lit(i + 1).alias("batch"), CHANGE, "rows"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    return q


def _store(spark: SparkSession) -> ParquetTables:
    return ParquetTables(spark, f"{checkpoint_root(spark)}/refinery-queries/{uuid.uuid4().hex}")


def _stored(spark: SparkSession):
    """``store(df, name)`` for a query that works on stored states: written
    under the checkpoint folder and read back."""
    root = f"{checkpoint_root(spark)}/refinery-queries/{uuid.uuid4().hex}"

    def store(df: DataFrame, name: str) -> DataFrame:
        write_parquet(df, f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    return store


def _stored_bronze(spark: SparkSession, sf_dir: str, batch: int | None = None) -> dict[str, DataFrame]:
    """The bronze tables of a refresh, stored once each: it reads them for
    their digests, their repeated keys and their rows, and deriving them is a
    join."""
    store = _stored(spark)
    return {name: store(bronze_tables(spark, sf_dir, batch)[name], name) for name in BRONZE_SCHEMAS}


def _stored_joins(spark: SparkSession, sf_dir: str, store: Store, names: tuple[str, ...] = tuple(JOINED)) -> dict[str, DataFrame]:
    """The joins below the bronze tables, stored once each for a query that
    derives several batches from them."""
    return {name: store(JOINED[name](spark, sf_dir), f"joined_{name}") for name in names}


def _late_versions(spark, d):
    """Membership versions that arrive in the order of batches 2, 3, 1, so
    that batch 3 holds versions older than the stored ones; keys that batch 1
    no longer has depart."""
    store, key = _stored(spark), ["membership_id"]
    full = Silver(spark, d)
    first, second = (Silver(spark, d, b, full.teams.accepted) for b in (1, 2))
    table = empty(spark, SILVER_SCHEMAS["memberships_refined"])
    for name, batch in (("second", second), ("third", full)):
        table = store(splice_versions(table, store(batch.memberships.accepted, f"{name}_batch"), key), name)
    gone = table.where(F.col(ACTIVE)).select(*key).join(first.bronze["memberships"].select(*key), key, "left_anti")
    gone = gone.withColumn(VALID_TO, F.lit(AS_OF[2]).cast("timestamp"))
    return ntz(splice_versions(table, store(first.memberships.accepted, "first_batch"), key, gone))


def _changed_ranges(spark, d):
    """RSVPs of batch 2 that are new or differ from those of batch 1, looked
    for only in the key ranges whose digests differ."""
    store, key = _stored(spark), ["event_rsvp_id"]
    parent = Silver(spark, d).teams.accepted
    target, batch = (store(Silver(spark, d, b, parent).rsvps.accepted, f"batch_{b}") for b in (1, 2))
    ranges = store(differing_ranges(*[range_digests(t, key, [*key, "hash_key"]) for t in (target, batch)]), "ranges")
    return ntz(changed_rows(in_ranges(batch, key, ranges), in_ranges(target, key, ranges), key))


def _trend_incremental(spark, d):
    """The trend after each of the three batches, carried on from the one
    before by the batch's changes alone."""
    store = _stored(spark)
    sc = Scenario(spark, d, store=store)
    rsvps = empty(spark, SILVER_SCHEMAS["event_rsvps_refined"])
    events = empty(spark, SILVER_SCHEMAS["events_refined"])
    grain, trend, out = trend_grain(rsvps), monthly_trend(rsvps, events), None
    digest = silver_digest_columns("event_rsvps_refined")
    for i, batch in enumerate(sc.batches):
        merged = store(scd1_merge(rsvps, batch.rsvps.accepted, ["event_rsvp_id"], replaced=TREND_COLUMNS, digest_columns=digest), f"rsvps_{i}")
        events_next = sc.table("events", i + 1)
        deltas = store(trend_deltas(rsvps, change_set(merged)), f"deltas_{i}")
        trend, grain = maintain_trend(trend, grain, deltas, events, events_next, lambda df: store(df, f"counts_{i}"))  # noqa: B023
        trend = store(trend, f"trend_{i}")
        rsvps, events = merged.drop(CHANGE, REPLACED), events_next
        step = trend.withColumn("batch", F.lit(i + 1))
        out = step if out is None else out.unionByName(step)
    return out


def _trend_rollup(spark, d):
    """Per team and year: daily sketches rolled up over months to years,
    beside the exact counts, and whether they keep their stated errors."""
    store, s = _stored(spark), Silver(spark, d)
    rsvps, events = store(s.rsvps.accepted, "rsvps"), store(s.events.accepted, "events")
    daily = store(daily_sketches(rsvps, events), "daily")
    months = rollup_sketches(daily, F.floor(F.col("datekey") / 100).cast("int"), "month")
    years = read_sketches(rollup_sketches(months.withColumnRenamed("month", "datekey"), F.floor(F.col("datekey") / 100).cast("int"), "year"))
    years = store(years.select("team_id", "year", F.col("members").alias("estimate"), F.col("ahead").alias("median")), "years")
    raw = rsvps.join(events.select("event_id", "team_id", "event_start"), "event_id").select(
        "team_id", F.year("responded_at").alias("year"), "membership_id", F.datediff("event_start", "responded_at").cast("long").alias("ahead"))
    found = raw.join(years, ["team_id", "year"], "left").groupBy("team_id", "year", "estimate", "median").agg(
        F.count(F.lit(1)).alias("rsvps"), F.count_distinct("membership_id").alias("members"),
        F.count_if(F.col("ahead") < F.col("median")).alias("below"), F.count_if(F.col("ahead") <= F.col("median")).alias("upto"))
    half, off = F.col("rsvps") / 2, F.col("rsvps") * RANK_ERROR + 1
    return found.select("team_id", "year", "rsvps", "members",
                        (F.abs(F.col("estimate") - F.col("members")) <= F.col("members") * DISTINCT_ERROR + 0.5).alias("members_within"),
                        ((F.col("below") <= half + off) & (F.col("upto") >= half - off)).alias("median_within"))


def _quarantine_observed(spark, d):
    """Rejections per rule as observed during the one write of each table's
    tagged rows."""
    counts, bronze = {}, bronze_tables(spark, d)
    through = staged_counts(_stored(spark), counts)
    teams = teams_batch(bronze["teams"], through=through)
    memberships = memberships_batch(bronze["memberships"], teams.accepted, through=through)
    events = events_batch(bronze["events"], teams.accepted, through=through)
    rsvps_batch(bronze["event_rsvps"], memberships.accepted, events.accepted, through=through)
    rows = [(table, reason, n) for table, found in counts.items() for reason, n in found.items() if reason != "rows"]  # a row per rule
    return spark.createDataFrame(rows, "table_name string, dq_reason string, rows long")


def _upsert_bucketed(spark, d):
    """RSVPs of batch 2 into those of batch 1, stored in Spark's own buckets."""
    parent = Silver(spark, d).teams.accepted
    joined = _stored_joins(spark, d, _stored(spark), ("event_rsvps",))
    first, second = (Silver(spark, d, b, parent, joined).rsvps.accepted for b in (1, 2))
    run, digest = uuid.uuid4().hex, silver_digest_columns("event_rsvps_refined")
    stored = bucketed_table(first, f"rsvps_{run}", "event_rsvp_id", f"{checkpoint_root(spark)}/refinery-queries/{run}", buckets=16, files_per_bucket=2,
                            digest_columns=digest)
    return ntz(scd1_merge(stored, second, ["event_rsvp_id"], digest_columns=digest))


def _history_asof(spark, d):
    store, sc = _stored(spark), Scenario(spark, d)
    full = sc.batches[2]
    frames = {"rsvps": full.rsvps.accepted, "events": full.events.accepted, "memberships": sc.table("memberships", 3)}
    return member_asof(*[store(df, name) for name, df in frames.items()])


def _refreshed(table: str) -> Query:
    """Two consecutive refreshes (scenario batches 1 and 2) into a fresh
    store under the checkpoint folder; the stored table afterwards."""
    def q(spark, d):
        store = _store(spark)
        for b in (1, 2):
            refresh(spark, _stored_bronze(spark, d, b), store, as_of=AS_OF[b - 1], keep_quarantine=False)
        return ntz(store.read(table))
    return q


def _rerun(table: str) -> Query:
    """The whole data refreshed twice into one store: the second run must
    change nothing, so the stored table equals the first load."""
    def q(spark, d):
        store, bronze = _store(spark), _stored_bronze(spark, d)
        for _ in range(2):
            refresh(spark, bronze, store, as_of=AS_OF[2], keep_quarantine=False)
        return ntz(store.read(table))
    return q


def _stored_quarantine(batches: tuple) -> Query:
    """The stored rejected rows after refreshes of ``batches``: key, reason
    and the raw values, in the bronze table's column order ('-': NULL)."""
    def q(spark, d):
        store = _store(spark)
        bronze = {b: _stored_bronze(spark, d, b) for b in dict.fromkeys(batches)}
        for b in batches:
            refresh(spark, bronze[b], store, as_of=AS_OF[0])
        rows = read_quarantine(store)
        values = F.lit(None).cast("string")
        for table, schema in BRONZE_SCHEMAS.items():
            got = [F.coalesce(F.get_json_object("raw_row", f"$.{c}"), F.lit("-")) for c in schema.names]
            values = F.when(F.col("table_name") == table, F.concat_ws("|", *got)).otherwise(values)
        return rows.select("table_name", "record_key", "dq_reason", values.alias("raw_values"))
    return q


def _events_geo(spark, d):
    s = Silver(spark, d)
    return ntz(events_batch(s.bronze["events"], s.parent, places_from_customers(spark, d), radius_km=500.0).accepted)


def _upsert_rsvps(spark, d):
    """RSVPs of batch 2 into those of batch 1: inserts, updates, no deletes."""
    parent = Silver(spark, d).teams.accepted
    first, second = (Silver(spark, d, b, parent).rsvps.accepted for b in (1, 2))
    return ntz(scd1_merge(first, second, ["event_rsvp_id"]))


def _second_events(spark, d):
    sc = Scenario(spark, d)
    b = sc.batches[1]
    return sc.table("events", 1), b.events.accepted, b.bronze["events"].select("event_id")


def _scd2_appended(spark, d):
    """Closings applied, then the new versions appended, as two steps."""
    target, accepted, present = _second_events(spark, d)
    closed = scd2_close(target, accepted, ["event_id"], AS_OF[1], present)
    new, _ = scd2_changes(accepted, target, ["event_id"], present)
    return ntz(append_versions(closed, new))


def _scd2_closed(spark, d):
    sc = Scenario(spark, d)
    b = sc.batches[1]
    present = b.bronze["memberships"].select("membership_id")
    return ntz(scd2_close(sc.table("memberships", 1), b.memberships.accepted, ["membership_id"], AS_OF[1], present))


def _scd2_null_flag(spark, d):
    """Batch 2 into a table some of whose rows lost their active flag: these
    stay as they are, and their keys open new versions."""
    sc = Scenario(spark, d)
    b = sc.batches[1]
    stored = sc.table("memberships", 1)
    stored = stored.withColumn(ACTIVE, F.when(~F.col("membership_id").endswith("5"), F.col(ACTIVE)))
    return ntz(merge_batch(b.memberships, conform(stored, SILVER_SCHEMAS["memberships_refined"]), AS_OF[1], b.bronze["memberships"]))


def _by_quarter(spark, d):
    # Stored first: the calendar and the count are two readings.
    acc = _stored(spark)(Silver(spark, d).rsvps.accepted.select("responded_at", "responded_at_datekey"), "rsvps")
    return by_calendar(acc, "responded_at_datekey", calendar(acc, "responded_at"), ["year", "quarter"])


def _calendar(spark, d):
    # dates as ISO text so engines that surface DATE differently compare equal
    cal = calendar(Silver(spark, d).rsvps.accepted, "responded_at")
    return cal.withColumns({"date": F.col("date").cast("string"), "month_start": F.col("month_start").cast("string")})


def _with_team(s: Silver) -> DataFrame:
    return s.rsvps.accepted.join(s.events.accepted.select("event_id", "team_id"), "event_id")


def _recent(spark, d):
    # Stored first: the latest time and the rows after it are two readings.
    acc = _stored(spark)(Silver(spark, d).rsvps.accepted.select(
        "event_rsvp_id", "event_id", "membership_id", "rsvp_status", "responded_at", "responded_at_datekey"), "rsvps")
    return ntz(recent(acc, "responded_at", 30))


def _history_check(spark, d):
    sc = Scenario(spark, d)
    full = sc.batches[2]
    return member_at_response(full.rsvps.accepted, full.events.accepted, sc.table("memberships", 3))


QUERIES: dict[str, Query] = {
    "bronze_teams": _bronze("teams"),
    "bronze_memberships": _bronze("memberships"),
    "bronze_events": _bronze("events"),
    "bronze_rsvps": _bronze("event_rsvps"),
    "id_accepted": lambda s, d: _id(s, d, True),
    "id_rejected": lambda s, d: _id(s, d, False),
    "fk_accepted": lambda s, d: _fk(s, d, True),
    "fk_rejected": lambda s, d: _fk(s, d, False),
    "fk_multi_accepted": lambda s, d: _fk_multi(s, d, True),
    "fk_multi_rejected": lambda s, d: _fk_multi(s, d, False),
    "ts_accepted": lambda s, d: _ts(s, d, True),
    "ts_rejected": lambda s, d: _ts(s, d, False),
    "team_rules_accepted": lambda s, d: _team_rules(s, d, True),
    "team_rules_rejected": lambda s, d: _team_rules(s, d, False),
    "event_rules_accepted": lambda s, d: _event_rules(s, d, True),
    "event_rules_rejected": lambda s, d: _event_rules(s, d, False),
    "membership_rules_accepted": lambda s, d: _membership_rules(s, d, True),
    "membership_rules_rejected": lambda s, d: _membership_rules(s, d, False),
    "rsvp_rules_accepted": lambda s, d: _rsvp_rules(s, d, True),
    "rsvp_rules_rejected": lambda s, d: _rsvp_rules(s, d, False),
    "datekeys": _datekeys,
    "geo_constant": _geo_constant,
    "geo_nearest": _geo_nearest,
    "geo_nearest_clustered": _geo_nearest_clustered,
    "geo_within": _geo_within,
    "row_digest": _row_digest,
    "scd1_stamped": lambda s, d: ntz(stamp_scd1(bronze_tables(s, d)["event_rsvps"], as_of=AS_OF[0])),
    "scd2_stamped": lambda s, d: ntz(stamp_scd2(bronze_tables(s, d)["memberships"], as_of=AS_OF[0])),
    "silver_teams": lambda s, d: ntz(Silver(s, d).teams.accepted),
    "silver_memberships": lambda s, d: ntz(Silver(s, d).memberships.accepted),
    "silver_events": lambda s, d: ntz(Silver(s, d).events.accepted),
    "silver_rsvps": lambda s, d: ntz(Silver(s, d).rsvps.accepted),
    "silver_events_geo": _events_geo,
    "quarantine_summary": _quarantine_summary,
    "quarantine_observed": _quarantine_observed,
    "scd1_changed": _scd1_changed,
    "scd1_upsert": lambda s, d: ntz(Scenario(s, d).states["teams"][1]),
    "scd2_new_versions": _scd2_new_versions,
    "scd2_departed": _scd2_departed,
    "scd1_upsert_rsvps": _upsert_rsvps,
    "scd1_upsert_bucketed": _upsert_bucketed,
    "scd2_closed": _scd2_closed,
    "scd2_appended": _scd2_appended,
    "scd2_null_flag": _scd2_null_flag,
    "scd2_next_snapshot": lambda s, d: ntz(Scenario(s, d).states["memberships"][2]),
    "scd2_late_versions": _late_versions,
    "scd1_changed_ranges": _changed_ranges,
    "scenario_counts": _scenario_counts(False),
    "scenario_counts_close_rejected": _scenario_counts(True),
    "calendar": _calendar,
    "rsvps_by_quarter": _by_quarter,
    "rsvps_last_30_days": _recent,
    "rsvp_rolling_30d": lambda s, d: daily_rolling(_with_team(Silver(s, d)), ["team_id"], "responded_at", 30),
    "rsvp_trend": lambda s, d: monthly_trend(Silver(s, d).rsvps.accepted, Silver(s, d).events.accepted),
    "trend_incremental": _trend_incremental,
    "trend_rollup": _trend_rollup,
    "rsvp_history_check": _history_check,
    "rsvp_history_asof": _history_asof,
    "refresh_teams": _refreshed("teams_refined"),
    "refresh_memberships": _refreshed("memberships_refined"),
    "refresh_events": _refreshed("events_refined"),
    "refresh_rsvps": _refreshed("event_rsvps_refined"),
    "refresh_quarantine": _stored_quarantine((1, 2)),
    "refresh_rerun_quarantine": _stored_quarantine((None, None)),
    "refresh_rerun_teams": _rerun("teams_refined"),
    "refresh_rerun_memberships": _rerun("memberships_refined"),
    "refresh_rerun_events": _rerun("events_refined"),
    "refresh_rerun_rsvps": _rerun("event_rsvps_refined"),
}
