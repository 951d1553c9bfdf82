"""The four silver pipelines and the full refresh.

Each ``*_batch`` function is lazy: bronze frame (+ parent silver frames) →
:class:`Batch` with the accepted rows shaped like the silver table and the
quarantined raw rows.  :func:`refresh` runs them in dependency order
(teams → memberships ∥ events → RSVPs) against
:class:`refinery.sources.tables.ParquetTables`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from refinery.operators.enrich import add_datekeys, add_geography
from refinery.operators.history import (
    ACTIVE,
    CHANGE,
    apply_change_set,
    apply_splice,
    as_of_column,
    change_counts,
    change_set,
    latest_per_key,
    scd1_merge,
    scd2_merge,
    splice_changes,
    stamp_scd1,
    stamp_scd2,
)
from refinery.operators.quality import (
    REASON,
    ForeignKey,
    Tagged,
    Predicate,
    Rule,
    Timestamps,
    UniqueKey,
    evaluate,
    event_rules,
    membership_rules,
    rsvp_rules,
    team_rules,
)
from refinery.operators.ranges import DIGEST_SCHEMA, differing_ranges, in_ranges, key_range, range_digests
from refinery.sources.tables import MALFORMED, QUARANTINE_SCHEMA, SILVER_SCHEMAS, ParquetTables, conform, staging

KEYS = {
    "teams": "team_id",
    "memberships": "membership_id",
    "events": "event_id",
    "event_rsvps": "event_rsvp_id",
}
SILVER = {
    "teams": "teams_refined",
    "memberships": "memberships_refined",
    "events": "events_refined",
    "event_rsvps": "event_rsvps_refined",
}


# The business time whose date key orders a table's files, and which orders
# the changes of one key in a stream.
TIMES = {
    "teams": "created_at",
    "memberships": "joined_at",
    "events": "created_at",
    "event_rsvps": "responded_at",
}


@dataclass
class Batch:
    table: str
    tagged: Tagged
    accepted: DataFrame


# What a batch's tagged rows go through before they are cut into accepted and
# rejected ones (nothing, or :func:`staged_counts`).
Through = Callable[[Tagged, str], Tagged]


def staged_counts(stage, counts: dict[str, dict[str, int]]) -> Through:
    """Tagged rows are written once by ``stage`` and read from there by all
    that follows; the rows and rejections per rule, observed during that
    write, go to ``counts`` by table."""
    def through(tagged: Tagged, table: str) -> Tagged:
        observation = Observation()
        seen = tagged.observed(observation)
        staged = replace(seen, frame=stage(seen.frame, f"tagged_{table}"))
        counts[table] = {k: v for k, v in observation.get.items() if v}
        return staged

    return through


def _checked(table: str, bronze: DataFrame, rules: list[Rule], through: Through | None) -> Tagged:
    tagged = evaluate(bronze, rules)
    return through(tagged, table) if through else tagged


def silver_digest_columns(silver: str) -> list[str]:
    """The columns whose digest is the ``hash_key`` of an accepted row."""
    system = {"hash_key", "system_created_at", "system_updated_at", "system_is_active",
              "system_valid_from", "system_valid_to"}
    return [f.name for f in SILVER_SCHEMAS[silver].fields if f.name not in system]


def _own_key(key: str, changes: bool | str) -> Rule:
    """In a whole table a repeated key is an error; in a set of changes it is
    a sequence of them, of which the last counts."""
    return Predicate(F.col(key).isNotNull(), "null_key") if changes else UniqueKey(key)


def _readable(bronze: DataFrame) -> list[Rule]:
    """Rows whose file held a number that does not parse."""
    return [Predicate(F.col(MALFORMED).isNull(), "malformed_number")] if MALFORMED in bronze.columns else []


# ``changes`` of a batch: it is a set of changes of which every one counts,
# not only a key's last.
EVERY = "every"


def _batch(table: str, tagged: Tagged, accepted: DataFrame, changes: bool | str) -> Batch:
    accepted = conform(accepted, SILVER_SCHEMAS[SILVER[table]])
    return Batch(table, tagged, latest_per_key(accepted, KEYS[table], TIMES[table]) if changes is True else accepted)


def teams_batch(bronze: DataFrame, changes: bool | str = False, through: Through | None = None) -> Batch:
    rules = [*_readable(bronze), _own_key("team_id", changes), Timestamps(("created_at",)), *team_rules()]
    t = _checked("teams", bronze, rules, through)
    acc = add_datekeys(t.accepted(), ["created_at"])
    acc = stamp_scd1(acc, "created_at", digest_columns=silver_digest_columns("teams_refined"))
    return _batch("teams", t, acc, changes)


def memberships_batch(bronze: DataFrame, teams: DataFrame, changes: bool | str = False, through: Through | None = None) -> Batch:
    rules = [*_readable(bronze), _own_key("membership_id", changes), ForeignKey("group_id", teams, "team_id"),
             Timestamps(("joined_at",)), *membership_rules()]
    t = _checked("memberships", bronze, rules, through)
    acc = add_datekeys(t.accepted(), ["joined_at"])
    acc = stamp_scd2(acc, "joined_at", digest_columns=silver_digest_columns("memberships_refined"))
    return _batch("memberships", t, acc, changes)


def events_batch(bronze: DataFrame, teams: DataFrame, places: DataFrame | None = None,
                 radius_km: float = 100.0, changes: bool | str = False, through: Through | None = None) -> Batch:
    ts = ("event_start", "event_end", "created_at")
    rules = [*_readable(bronze), _own_key("event_id", changes), ForeignKey("team_id", teams, "team_id"), Timestamps(ts), *event_rules()]
    t = _checked("events", bronze, rules, through)
    acc = add_geography(t.accepted(), places, radius_km=radius_km)
    acc = add_datekeys(acc, list(ts))
    acc = stamp_scd2(acc, "created_at", digest_columns=silver_digest_columns("events_refined"))
    return _batch("events", t, acc, changes)


def rsvps_batch(bronze: DataFrame, memberships: DataFrame, events: DataFrame, changes: bool = False,
                through: Through | None = None) -> Batch:
    """``memberships`` / ``events``: the silver tables; only active versions
    are used as parents."""
    m = memberships.where(F.col(ACTIVE)) if ACTIVE in memberships.columns else memberships
    e = events.where(F.col(ACTIVE)) if ACTIVE in events.columns else events
    rules = [*_readable(bronze), _own_key("event_rsvp_id", changes),
             *rsvp_rules(m, e, check_keys=True, between=(Timestamps(("responded_at",)),))]
    t = _checked("event_rsvps", bronze, rules, through)
    acc = add_datekeys(t.accepted(), ["responded_at"])
    acc = stamp_scd1(acc, "responded_at", digest_columns=silver_digest_columns("event_rsvps_refined"))
    return _batch("event_rsvps", t, acc, changes)


def quarantine(batch: Batch, as_of=None) -> DataFrame:
    """Rejected rows as (table, key, first reason, raw row as JSON, time)."""
    return quarantined(batch.table, batch.tagged.rejected(), as_of)


def quarantined(table: str, rejected: DataFrame, as_of=None) -> DataFrame:
    """:func:`quarantine` of given rejected rows (with ``dq_reason``)."""
    cols = [c for c in rejected.columns if c != REASON]
    return conform(rejected.select(
        F.lit(table).alias("table_name"),
        F.col(KEYS[table]).cast("string").alias("record_key"),
        F.col(REASON),
        F.to_json(F.struct(*cols)).alias("raw_row"),
        as_of_column(as_of).alias("refreshed_at"),
    ), QUARANTINE_SCHEMA)


# --------------------------------------------------------------------------
# First load / one step, as pure frames
# --------------------------------------------------------------------------


def merge_batch(batch: Batch, target: DataFrame, as_of=None, raw: DataFrame | None = None,
                close_rejected: bool = False, departures: bool = True) -> DataFrame:
    """Next silver table (+ ``change`` label) for one batch.

    Type 2 closes keys absent from the *raw* batch (``raw``) by default; with
    ``close_rejected`` a key whose row merely failed a check is closed too.
    ``departures=False``: the batch is a change set, absent keys stay open.
    """
    key = KEYS[batch.table]
    if batch.table in ("memberships", "events"):
        present = None if close_rejected or raw is None else raw.select(key)
        return scd2_merge(target, batch.accepted, [key], as_of, present, departures=departures)
    return scd1_merge(target, batch.accepted, [key])


def write_changes(store: ParquetTables, table: str, merged: DataFrame, stage) -> dict[str, int]:
    """Writes what ``merged`` changes in the stored table of ``table``;
    returns the rows per change label (none: nothing written).

    The change set is staged once, counted, and applied to the buckets that
    hold one of its keys; no other stored row is read again or rewritten.  A
    table that does not exist yet can only get new rows: it is written at once
    and counted as stored (a metric observed during the write is lost when the
    planner finds that there are no rows).
    """
    silver, key = SILVER[table], KEYS[table]
    if not store.exists(silver):
        store.write(silver, change_set(merged).drop(CHANGE), key, f"{TIMES[table]}_datekey")
        rows = store.read(silver).count()
        return {"new": rows} if rows else {}
    changes = stage(change_set(merged), silver)
    counts = {r[CHANGE]: r["rows"] for r in change_counts(changes).collect()}
    if counts:
        touched = [r[0] for r in changes.select(store.bucket_of(key)).distinct().collect()]  # at most store.buckets
        store.write(silver, apply_change_set(store.read(silver, buckets=touched), changes, key), key, f"{TIMES[table]}_datekey")
    return counts


def write_splice(store: ParquetTables, table: str, batch: Batch, stage) -> dict[str, int]:
    """Splices the versions of ``batch`` (``changes=EVERY``) into the stored
    type-2 table, wherever their ``valid_from`` puts them; returns the rows
    per label (none: nothing written)."""
    silver, key = SILVER[table], KEYS[table]
    changes = stage(splice_changes(store.read(silver), batch.accepted, [key]), silver)
    counts = {r[CHANGE]: r["rows"] for r in change_counts(changes).collect()}
    if counts:
        touched = [r[0] for r in changes.select(store.bucket_of(key)).distinct().collect()]  # at most store.buckets
        store.write(silver, apply_splice(store.read(silver, buckets=touched), changes, [key]), key, f"{TIMES[table]}_datekey")
    return counts


# --------------------------------------------------------------------------
# Refresh against stored tables
# --------------------------------------------------------------------------

QUARANTINE = "quarantine"
PARENTS = {"teams": (), "memberships": ("teams",), "events": ("teams",), "event_rsvps": ("memberships", "events")}

# What was last refreshed: the digest tree of each bronze table, what else its
# result depends on, and an id of the stored state.
DIGESTS = StructType([*DIGEST_SCHEMA.fields, StructField("settings", StringType()), StructField("state", StringType())])


def read_quarantine(store: ParquetTables) -> DataFrame:
    """The stored rejected rows of all tables."""
    frames = [store.read_whole(f"{QUARANTINE}/{t}", QUARANTINE_SCHEMA) for t in SILVER]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal bags of rejected rows, whatever their order and time."""
    one, other = ([r[c] for c in ("n", "total", "mix")] if r else None for r in (
        range_digests(f, ["record_key"], ["table_name", "record_key", "dq_reason", "raw_row"], bits=0).where("level = 0").first() for f in (a, b)))
    return one == other


def write_quarantine(store: ParquetTables, table: str, rejected: DataFrame, stage, ranges: DataFrame | None = None) -> bool:
    """Stores the rejected rows of one table; the same rows again write
    nothing.  ``rejected`` (staged) holds all of them, or those of the key
    ``ranges`` that were refreshed, whose stored rows it replaces."""
    name = f"{QUARANTINE}/{table}"
    stored = store.read_whole(name, QUARANTINE_SCHEMA)
    if _same_rows(rejected, stored if ranges is None else in_ranges(stored, ["record_key"], ranges)):
        return False
    if ranges is not None:
        rest = stored.join(ranges, key_range(["record_key"]) == F.col("range"), "left_anti")
        rejected = stage(rest.unionByName(rejected), f"quarantine_{table}")
    store.replace(name, rejected)
    return True


def refresh(spark: SparkSession, bronze: dict[str, DataFrame], store: ParquetTables, as_of=None,
            places: DataFrame | None = None, close_rejected: bool = False,
            keep_quarantine: bool = True, rule_counts: dict[str, dict[str, int]] | None = None) -> dict[str, dict[str, int]]:
    """Run the four pipelines against ``store``; returns the changed rows per
    table and label (an empty dict: unchanged, nothing written).
    ``rule_counts`` is given the rows looked at and the rejections per rule of
    every table that was not skipped.

    A table whose bronze rows have the digests of its last refresh, and whose
    parents' stored tables have not been refreshed since, is skipped after one
    scan.  If the parents are the same and some key ranges differ, only the
    rows of these ranges are checked and merged: every rule looks at a row,
    its parents, or rows of the same key.  Otherwise the whole table is.

    Per table the tagged rows are written once for their two readers (merge
    and rejected rows), and the rules are counted during that write; these,
    digests, change set and rejected rows are staged and deleted with the
    refresh.  With neither a quarantine nor ``rule_counts`` the merge is the
    only reader, and takes the accepted rows as they come.
    """
    stats: dict[str, dict[str, int]] = {}
    states: dict[str, str] = {}

    with staging(spark) as stage:
        def step(table: str, build) -> None:
            key, raw, silver = KEYS[table], bronze[table], SILVER[table]
            # Events looked up in a places table depend on it as well, so they are always processed.
            settings = json.dumps([close_rejected, keep_quarantine, uuid.uuid4().hex if places is not None and table == "events" else "",
                                   sorted(raw.columns), [states[p] for p in PARENTS[table]]])
            digests = stage(range_digests(raw, [key], sorted(raw.columns)), f"digests_{table}")
            stored = store.read_whole(f"digests/{table}", DIGESTS)
            last = stored.where("level = 0").first()
            ranges = None
            if last is not None and last["settings"] == settings:
                root = digests.where("level = 0").first()
                if root is not None and all(root[c] == last[c] for c in ("n", "total", "mix")):
                    states[table], stats[table] = last["state"], {}
                    return
                ranges = stage(differing_ranges(stored, digests), f"ranges_{table}")
                raw = in_ranges(raw, [key], ranges)
            batch = build(raw)
            target = store.read(silver)
            merged = merge_batch(batch, target if ranges is None else in_ranges(target, [key], ranges), as_of, raw, close_rejected)
            stats[table] = write_changes(store, table, merged, stage)
            if keep_quarantine:
                write_quarantine(store, table, stage(quarantine(batch, as_of), f"rejected_{table}"), stage, ranges)
            # Last: a refresh that failed before is done again.
            states[table] = uuid.uuid4().hex
            store.replace(f"digests/{table}", digests.select("*", F.lit(settings).alias("settings"), F.lit(states[table]).alias("state")))

        through = None
        if keep_quarantine or rule_counts is not None:
            through = staged_counts(stage, {} if rule_counts is None else rule_counts)
        step("teams", lambda raw: teams_batch(raw, through=through))
        # memberships and events depend only on teams: submit both as
        # concurrent Spark jobs (one driver thread each)
        with ThreadPoolExecutor(max_workers=2) as pool:
            futures = [
                pool.submit(step, "memberships", lambda raw: memberships_batch(raw, store.read(SILVER["teams"]), through=through)),
                pool.submit(step, "events", lambda raw: events_batch(raw, store.read(SILVER["teams"]), places, through=through)),
            ]
            for f in futures:
                f.result()
        step("event_rsvps", lambda raw: rsvps_batch(raw, store.read(SILVER["memberships"]), store.read(SILVER["events"]), through=through))
    return stats
