"""Reporting layer on top of the silver tables: calendar, recent-period
views, lower-grain trends, and the RSVP check against membership history.

All joins are on integer date keys or business keys; windows run on
already-aggregated rows (one per group and day), never on raw rows of one
hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.functions.columns import datekey
from refinery.operators.history import ACTIVE, CHANGE, REPLACED, VALID_FROM, VALID_TO
from refinery.operators.timeline import SLICE_ROWS, carried


def calendar(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date in ``df[column]``,
    keyed by the integer ``datekey`` used in the silver tables.

    The range comes from one aggregate row and is expanded with
    ``sequence`` + ``explode``: the output grows with the span of dates, not
    with the number of input rows.
    """
    bounds = df.agg(F.min(F.to_date(column)).alias("lo"), F.max(F.to_date(column)).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        datekey(F.col("date")).alias("datekey"),
        F.col("date"),
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.weekofyear("date").alias("iso_week"),
        (F.weekday("date") + 1).alias("iso_day_of_week"),
        F.dayofmonth("date").alias("day_of_month"),
        F.date_trunc("month", "date").cast("date").alias("month_start"),
    )


def by_calendar(df: DataFrame, column: str, cal: DataFrame, grain: list[str]) -> DataFrame:
    """Rows per calendar ``grain`` (columns of :func:`calendar`), joined on
    the integer date key ``column``.  Rows are counted per date key first, so
    the join moves one row per day."""
    daily = df.groupBy(F.col(column).alias("datekey")).agg(F.count(F.lit(1)).alias("__rows"))
    return daily.join(cal, "datekey").groupBy(*grain).agg(F.sum("__rows").alias("rows"))


def recent(df: DataFrame, column: str, days: int = 30, anchor=None) -> DataFrame:
    """Rows whose ``column`` lies in the ``days`` days up to ``anchor``
    (default: the latest value in the data, as a scalar subquery, so ``df`` is
    read twice: give stored rows, of which that reads one column)."""
    if anchor is None:
        anchor_col = df.select(F.max(column)).scalar()
    else:
        anchor_col = F.lit(anchor).cast("timestamp")
    start = anchor_col - F.make_interval(days=F.lit(days))
    return df.where((F.col(column) > start) & (F.col(column) <= anchor_col))


def daily_rolling(df: DataFrame, group: list[str], column: str, days: int = 30) -> DataFrame:
    """Per group and day: row count and the rolling ``days``-day sum.

    Rows are first counted per (group, day) — a partial aggregate, so a hot
    group is combined map-side — and the range window then runs over one row
    per day of each group.
    """
    daily = df.groupBy(*group, F.to_date(column).alias("date")).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy(*group).orderBy(F.unix_date("date")).rangeBetween(-(days - 1), 0)
    return daily.select(*group, datekey(F.col("date")).alias("datekey"), "rows",
                        F.sum("rows").over(w).alias(f"rows_{days}d"))


def monthly_trend(rsvps: DataFrame, events: DataFrame) -> DataFrame:
    """RSVPs per team, month and status, without member-level rows."""
    e = events.where(F.col(ACTIVE)).select("event_id", "team_id") if ACTIVE in events.columns \
        else events.select("event_id", "team_id")
    return rsvps.join(e, "event_id").groupBy(
        "team_id", (F.col("responded_at_datekey") / 100).cast("int").alias("month_key"), "rsvp_status"
    ).agg(F.count(F.lit(1)).alias("rsvps"), F.count_distinct("event_id").alias("events"))


def trend_grain(rsvps: DataFrame) -> DataFrame:
    """RSVPs counted per event, month and status: what the trend needs of
    them, without members and without the events' teams."""
    return rsvps.groupBy("event_id", (F.col("responded_at_datekey") / 100).cast("int").alias("month_key"), "rsvp_status").agg(
        F.count(F.lit(1)).alias("rsvps"))


# What the trend counts of an RSVP.
TREND_COLUMNS = ("event_id", "responded_at_datekey", "rsvp_status")


def trend_deltas(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Signed counts per event, month and status of a type-1 change set
    (``changes`` of :func:`refinery.operators.history.change_set`) against the
    table before it: superseded rows count -1, new ones +1.  A change set
    whose rows bring their superseded values along (``scd1_merge`` with
    ``replaced=TREND_COLUMNS``) is read alone, others are joined to the table
    for them."""
    if REPLACED in changes.columns:
        old = F.when(F.col(REPLACED).isNotNull(), F.struct(*[F.col(f"{REPLACED}.{c}").alias(c) for c in TREND_COLUMNS], F.lit(-1).alias("sign")))
        new = F.struct(*TREND_COLUMNS, F.lit(1).alias("sign"))
        signed = changes.select(F.inline(F.filter(F.array(old, new), lambda s: s.isNotNull())))
    else:
        replaced = stored.join(changes.where(F.col(CHANGE) == "changed").select("event_rsvp_id"), "event_rsvp_id", "left_semi")
        signed = replaced.select(*TREND_COLUMNS, F.lit(-1).alias("sign")).unionByName(changes.select(*TREND_COLUMNS, F.lit(1).alias("sign")))
    return signed.groupBy("event_id", (F.col("responded_at_datekey") / 100).cast("int").alias("month_key"), "rsvp_status").agg(
        F.sum("sign").alias("rsvps")).where(F.col("rsvps") != 0)


def _teams(events: DataFrame) -> DataFrame:
    e = events.where(F.col(ACTIVE)) if ACTIVE in events.columns else events
    return e.select("event_id", "team_id")


def maintain_trend(trend: DataFrame, grain: DataFrame, deltas: DataFrame, events_before: DataFrame,
                   events_after: DataFrame, keep=lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(trend, grain) after ``deltas`` (:func:`trend_deltas`) and a change of
    the events, without the RSVPs.

    The grain and the deltas move once, by event, and are summed to an old and
    a new count; ``keep`` may store these, as trend and grain both read them.
    Only the counts of events that have a delta, or whose active team is
    another than before, go on to the trend: each takes its old count from its
    old team's group and adds its new count to its new team's; the signed sums
    are added to the stored trend, and a group that comes to nothing goes.
    Both changes may come at once.
    """
    keys = ["event_id", "month_key", "rsvp_status"]
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    zero = F.lit(0).cast("long")
    lines = grain.select(*keys, F.col("rsvps").alias("old_n"), zero.alias("change")).unionByName(
        deltas.select(*keys, zero.alias("old_n"), F.col("rsvps").alias("change")))
    counts = keep(lines.repartition("event_id").groupBy(*keys).agg(
        F.sum("old_n").alias("old_n"), (F.sum("old_n") + F.sum("change")).alias("new_n")))
    teams = _teams(events_before).withColumnRenamed("team_id", "old_team").join(
        _teams(events_after).withColumnRenamed("team_id", "new_team"), "event_id", "full_outer")
    touched = ~same("old_team", "new_team") | (F.col("old_n") != F.col("new_n"))
    both = counts.join(teams, "event_id").where(touched)
    sides = F.array(F.struct(F.col("old_team").alias("team_id"), (-F.col("old_n")).alias("rsvps"), (-(F.col("old_n") > 0).cast("long")).alias("events")),
                    F.struct(F.col("new_team").alias("team_id"), F.col("new_n").alias("rsvps"), (F.col("new_n") > 0).cast("long").alias("events")))
    signed = both.select("month_key", "rsvp_status", F.inline(sides)).where(F.col("team_id").isNotNull() & (F.col("rsvps") != 0))
    group = ["team_id", "month_key", "rsvp_status"]
    summed = trend.select(*group, "rsvps", "events").unionByName(signed.select(*group, "rsvps", "events")).groupBy(*group).agg(
        F.sum("rsvps").alias("rsvps"), F.sum("events").alias("events")).where(F.col("rsvps") != 0)
    return summed, counts.where(F.col("new_n") != 0).select(*keys, F.col("new_n").alias("rsvps"))


# Sizes of the stored sketches and the errors they state: the distinct count
# within 2.5 % (three standard errors of 2^14 registers), the rank of a
# quantile within 1 %.
HLL_BITS, KLL_K = 14, 800
DISTINCT_ERROR, RANK_ERROR = 0.025, 0.01


def daily_sketches(rsvps: DataFrame, events: DataFrame) -> DataFrame:
    """Per team and day, without member rows: the RSVPs, a sketch of the
    distinct members, and one of the days from answer to event start."""
    e = events.where(F.col(ACTIVE)) if ACTIVE in events.columns else events
    r = rsvps.join(e.select("event_id", "team_id", "event_start"), "event_id")
    ahead = F.datediff("event_start", "responded_at").cast("long")
    return r.groupBy("team_id", F.col("responded_at_datekey").alias("datekey")).agg(
        F.count(F.lit(1)).alias("rsvps"), F.hll_sketch_agg("membership_id", HLL_BITS).alias("members"),
        F.kll_sketch_agg_bigint(ahead, KLL_K).alias("ahead"))


def rollup_sketches(daily: DataFrame, period: Column, name: str) -> DataFrame:
    """Daily rows rolled up to ``period`` (of the date key) by merging their
    sketches; the same rows can be rolled up again."""
    return daily.groupBy("team_id", period.alias(name)).agg(
        F.sum("rsvps").alias("rsvps"), F.hll_union_agg("members").alias("members"), F.kll_merge_agg_bigint("ahead").alias("ahead"))


def read_sketches(rolled: DataFrame, quantile: float = 0.5) -> DataFrame:
    """The estimates of rolled-up rows: ``members`` and ``ahead``."""
    return rolled.withColumns({"members": F.hll_sketch_estimate("members"), "ahead": F.kll_sketch_get_quantile_bigint("ahead", F.lit(quantile))})


def member_asof(rsvps: DataFrame, events: DataFrame, membership_history: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """:func:`member_at_response` by carry-forward instead of a range join.

    Versions and RSVPs of a member are put into one time order, and the
    versions valid so far are carried along, so an RSVP meets one row however
    many versions its member has, and no pair of an RSVP and a version is
    made.  A member with very many RSVPs is cut by time
    (:mod:`refinery.operators.timeline`).

    A member's versions may overlap, so what is carried, per member and team,
    is the latest end of the versions that began so far: the responder was a
    member if it lies after the answer.
    """
    e = _teams(events).withColumnRenamed("team_id", "group_id")
    r = rsvps.select("event_rsvp_id", "event_id", "membership_id", "responded_at").join(e, "event_id", "left")
    keys = ["membership_id", "group_id"]
    known = F.col("membership_id").isNotNull() & F.col("group_id").isNotNull()
    v = membership_history.where(known & F.col(VALID_FROM).isNotNull())
    open_end = F.coalesce(F.col(VALID_TO), F.lit("9999-12-31").cast("timestamp"))
    v = v.select(*keys, F.col(VALID_FROM).alias("at"), open_end.alias("until"))
    columns = ["event_rsvp_id", "event_id", "membership_id", "group_id"]
    nothing = [F.lit(None).cast(r.schema[c].dataType).alias(c) for c in columns[:2]]
    line = v.select(*nothing, *keys, "at", F.lit(0).alias("kind"), "until").unionByName(
        r.where(known & F.col("responded_at").isNotNull()).select(*columns, F.col("responded_at").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("timestamp").alias("until")))
    found = carried(line, keys, "at", ["kind"], F.col("until"), "last", slice_rows, greatest=True).where(F.col("kind") == 1)
    found = found.select(*columns[:3], F.coalesce(F.col("at") < F.col("last"), F.lit(False)).alias("member_at_response"))
    rest = r.where(~known | F.col("responded_at").isNull()).select(*columns[:3], F.lit(False).alias("member_at_response"))
    return found.unionByName(rest).groupBy("event_rsvp_id", "membership_id", "event_id").agg(F.bool_or("member_at_response").alias("member_at_response"))


def member_at_response(rsvps: DataFrame, events: DataFrame, membership_history: DataFrame) -> DataFrame:
    """For each RSVP: was the responder a member of the event's team when
    responding, by any version of the membership (not just the active one)?

    Interval join: RSVP ⋈ versions on ``membership_id`` (equi-key, so it
    shuffles or broadcasts as usual) with ``valid_from <= responded_at <
    valid_to`` (open end for the active version) and the same team.  One left
    join and one flag per RSVP, so the RSVPs are read once.
    """
    e = events.select("event_id", F.col("team_id").alias("event_team"))
    if ACTIVE in events.columns:
        e = events.where(F.col(ACTIVE)).select("event_id", F.col("team_id").alias("event_team"))
    r = rsvps.select("event_rsvp_id", "event_id", "membership_id", "responded_at").join(e, "event_id", "left")
    v = membership_history.select(
        F.col("membership_id").alias("v_member"), F.col("group_id").alias("v_group"),
        F.col(VALID_FROM).alias("v_from"), F.col(VALID_TO).alias("v_to"))
    cond = ((F.col("membership_id") == F.col("v_member")) & (F.col("event_team") == F.col("v_group"))
            & (F.col("v_from") <= F.col("responded_at"))
            & (F.col("v_to").isNull() | (F.col("responded_at") < F.col("v_to"))))
    return r.join(v, cond, "left").groupBy("event_rsvp_id", "membership_id", "event_id").agg(
        F.bool_or(F.col("v_member").isNotNull()).alias("member_at_response"))
