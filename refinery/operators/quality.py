"""Data-quality rules that partition a DataFrame into accepted and rejected rows.

Design: *tag, do not peel*.  Every rule contributes one or more pass
conditions; :func:`tag` evaluates all of them on one frame and writes the
first failing reason (in rule order) to ``dq_reason``.  ``accepted`` is
``dq_reason IS NULL`` and ``rejected`` is the rest, so the two outputs are a
partition of the input by construction (a NULL condition counts as a fail).

Rules that need other rows join against a *keyed set*: the repeated keys
(UniqueKey) or the distinct parent keys (Lookup / ForeignKey), each a
partial aggregate, so a hot key is combined map-side.
:func:`refinery.sources.tables.keyed_side` puts a plain shuffle above it, so
AQE can broadcast a set that measures small and can split a skewed partition
of the big side (a hot key, or many NULL keys) across tasks.  Everything
stays one lazy plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import count
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from refinery.functions.columns import parse_timestamp
from refinery.sources.tables import keyed_side

REASON = "dq_reason"
_PREFIX = "__dq"
_ids = count()


def _fresh(stem: str) -> str:
    return f"{_PREFIX}{next(_ids)}_{stem}"


@dataclass
class Attached:
    """Result of attaching a rule: the widened frame, its pass conditions as
    (reason, condition) pairs, and raw copies of columns it rewrote."""

    df: DataFrame
    conditions: list[tuple[str, Column]] = field(default_factory=list)
    raw: dict[str, str] = field(default_factory=dict)


@dataclass
class KeySet:
    """The keyed side of a rule's join, built from the input (or a parent)
    alone."""

    frame: DataFrame
    names: dict


class Rule:
    def keyset(self, df: DataFrame) -> KeySet | None:
        return None

    def attach(self, df: DataFrame, keyset: KeySet | None = None) -> Attached:  # pragma: no cover
        raise NotImplementedError


@dataclass(frozen=True, eq=False)
class UniqueKey(Rule):
    """Key must be non-NULL and occur once; *every* copy of a repeated key is
    rejected (no survivor is chosen)."""

    columns: tuple[str, ...] | str
    null_reason: str = "null_key"
    duplicate_reason: str = "duplicate_key"

    def _cols(self) -> tuple[str, ...]:
        return (self.columns,) if isinstance(self.columns, str) else tuple(self.columns)

    def _not_null(self) -> Column:
        not_null = F.lit(True)
        for c in self._cols():
            not_null = not_null & F.col(c).isNotNull()
        return not_null

    def keyset(self, df: DataFrame) -> KeySet:
        cols = self._cols()
        flag = _fresh("dup")
        tmp = {c: _fresh(c) for c in cols}
        # groupBy does a partial (map-side) count, so a key held by a third of
        # the rows is combined before the shuffle; only repeated keys survive.
        repeated = (
            df.where(self._not_null())
            .groupBy(*cols)
            .agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > 1)
            .select(*[F.col(c).alias(tmp[c]) for c in cols], F.lit(True).alias(flag))
        )
        return KeySet(repeated, {"flag": flag, "tmp": tmp})

    def attach(self, df: DataFrame, keyset: KeySet | None = None) -> Attached:
        ks = keyset or self.keyset(df)
        tmp, flag = ks.names["tmp"], ks.names["flag"]
        on = None
        for c in self._cols():
            cond = F.col(c) == F.col(tmp[c])
            on = cond if on is None else on & cond
        out = df.join(ks.frame, on, "left").drop(*tmp.values())
        return Attached(
            out,
            [(self.null_reason, self._not_null()), (self.duplicate_reason, F.col(flag).isNull())],
        )


@dataclass(frozen=True, eq=False)
class Lookup(Rule):
    """Attach attributes of a parent row found by key, without a condition.

    ``carry`` maps a parent column to an output name; the output is the
    *set* of distinct parent values for the key (one element when the parent
    key is unique), so a non-unique parent never multiplies child rows.
    Internal names starting with ``__dq`` are dropped by :func:`split`.
    """

    column: str
    parent: DataFrame
    parent_column: str
    carry: tuple[tuple[str, str], ...] = ()

    def keyset(self, df: DataFrame) -> KeySet:
        key = _fresh(self.column)
        found = _fresh("found")
        parent = self.parent.where(F.col(self.parent_column).isNotNull())
        if self.carry:
            keys = parent.groupBy(F.col(self.parent_column).alias(key)).agg(
                *[F.collect_set(src).alias(dst) for src, dst in self.carry]
            )
        else:
            keys = parent.select(F.col(self.parent_column).alias(key)).distinct()
        return KeySet(keys.withColumn(found, F.lit(True)), {"key": key, "found": found})

    def _join(self, df: DataFrame, keyset: KeySet | None) -> tuple[DataFrame, str]:
        ks = keyset or self.keyset(df)
        key = ks.names["key"]
        out = df.join(ks.frame, F.col(self.column) == F.col(key), "left").drop(key)
        return out, ks.names["found"]

    def attach(self, df: DataFrame, keyset: KeySet | None = None) -> Attached:
        out, found = self._join(df, keyset)
        return Attached(out.drop(found))


@dataclass(frozen=True, eq=False)
class ForeignKey(Lookup):
    """Child column must match a non-NULL key of ``parent``; NULL never matches."""

    reason: str | None = None

    def attach(self, df: DataFrame, keyset: KeySet | None = None) -> Attached:
        out, found = self._join(df, keyset)
        return Attached(out, [(self.reason or f"unknown_{self.column}", F.col(found).isNotNull())])


@dataclass(frozen=True, eq=False)
class Timestamps(Rule):
    """Each column must parse as a timestamp (missing or malformed → fail).

    Accepted rows carry the parsed values under the same names; rejected
    rows get their raw strings back from :func:`split`.
    """

    columns: tuple[str, ...]
    reason: str = "bad_timestamp"

    def attach(self, df: DataFrame, keyset: KeySet | None = None) -> Attached:
        raw = {c: _fresh(f"raw_{c}") for c in self.columns}
        out = df.withColumns({v: F.col(k) for k, v in raw.items()}).withColumns(
            {c: parse_timestamp(F.col(raw[c])) for c in self.columns}
        )
        ok = F.lit(True)
        for c in self.columns:
            ok = ok & F.col(c).isNotNull()
        return Attached(out, [(self.reason, ok)], raw)


@dataclass(frozen=True, eq=False)
class Predicate(Rule):
    """Row-local condition (Column or SQL text); NULL counts as a fail."""

    condition: Column | str
    reason: str

    def attach(self, df: DataFrame, keyset: KeySet | None = None) -> Attached:
        cond = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return Attached(df, [(self.reason, cond)])


@dataclass
class Tagged:
    """A frame carrying ``dq_reason`` plus what is needed to cut it into the
    accepted and rejected outputs.  ``persist`` it when both are consumed.

    ``passed`` says the same as a missing reason, rule by rule: Spark then
    drops rows that fail a row-local rule before the joins, and makes inner
    joins of the foreign keys, so rejected rows do not travel on to be
    dropped at the end.  A stored frame has only the reason."""

    frame: DataFrame
    columns: list[str]
    raw: dict[str, str]
    reasons: list[str] = field(default_factory=list)
    passed: Column | None = None

    def observed(self, observation: Observation) -> "Tagged":
        """The same rows, which when first written or counted give
        ``observation`` the number of ``rows`` and of each reason: rule counts
        without a pass of their own."""
        frame = self.frame.select(*self.columns, *self.raw.values(), REASON).observe(
            observation, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(REASON) == r).alias(r) for r in dict.fromkeys(self.reasons)])
        return replace(self, frame=frame, passed=None)

    def tagged(self) -> DataFrame:
        return self.frame.select(*self.columns, REASON)

    def accepted(self) -> DataFrame:
        passed = F.col(REASON).isNull() if self.passed is None else self.passed
        return self.frame.where(passed).select(*self.columns)

    def rejected(self) -> DataFrame:
        return self.frame.where(F.col(REASON).isNotNull()).select(
            *[F.col(self.raw[c]).alias(c) if c in self.raw else F.col(c) for c in self.columns], REASON)

    def persist(self) -> "Tagged":
        self.frame = self.frame.persist()
        return self

    def unpersist(self) -> None:
        self.frame.unpersist()


def evaluate(df: DataFrame, rules: list[Rule]) -> Tagged:
    """Attach every rule and compute ``dq_reason`` (first failing reason)."""
    columns = list(df.columns)
    found: dict[int, list[tuple[str, Column]]] = {}
    raw: dict[str, str] = {}
    # Joins run in this order: lookups on other keys first, the own-key
    # check last, so the tagged rows leave hash-partitioned by their own key
    # and a following merge on that key needs no further shuffle of them.
    # Reasons keep the declared order.
    order = sorted(range(len(rules)), key=lambda i: isinstance(rules[i], UniqueKey))
    # Key sets depend on the input or a parent only.
    sets = {i: KeySet(keyed_side(ks.frame), ks.names) for i, ks in ((i, r.keyset(df)) for i, r in enumerate(rules)) if ks is not None}
    for i in order:
        att = rules[i].attach(df, sets.get(i))
        df = att.df
        found[i] = att.conditions
        raw.update(att.raw)
    conditions = [c for i in range(len(rules)) for c in found[i]]
    if conditions:
        reason = F.coalesce(
            *[F.when(~F.coalesce(cond, F.lit(False)), F.lit(r)) for r, cond in conditions]
        )
    else:
        reason = F.lit(None).cast("string")
    passed = reduce(and_, [cond for _, cond in conditions]) if conditions else None
    return Tagged(df.withColumn(REASON, reason), columns, raw, [r for r, _ in conditions], passed)


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Input columns (rewritten by :class:`Timestamps` where declared) plus
    ``dq_reason``: the first failing rule's reason, NULL when all pass."""
    return evaluate(df, rules).tagged()


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected).  Accepted keeps the input column order with typed
    timestamps; rejected keeps the raw input values plus ``dq_reason``.
    Both come from one tagged plan (:func:`evaluate`)."""
    t = evaluate(df, rules)
    return t.accepted(), t.rejected()


# --------------------------------------------------------------------------
# Rule sets of the four silver tables, in the order the checks are applied.
# --------------------------------------------------------------------------

# Allowed membership roles and RSVP status range.
MEMBERSHIP_ROLES = ("member", "admin")
RSVP_STATUS_MIN, RSVP_STATUS_MAX = 0, 3


def team_rules() -> list[Rule]:
    return [
        Predicate(F.col("country_code").isNotNull(), "null_country"),
        Predicate(F.col("team_activity").isNotNull(), "null_activity"),
    ]


def event_rules() -> list[Rule]:
    """Start strictly before end; coordinates both NULL or both set and in range."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return [
        Predicate(F.col("event_start") <= F.col("event_end"), "start_after_end"),
        Predicate(F.col("event_start") < F.col("event_end"), "zero_length"),
        Predicate(lat.isNull() == lon.isNull(), "half_null_coordinates"),
        Predicate(
            lat.isNull() | (lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)),
            "coordinates_out_of_range",
        ),
    ]


def membership_rules(roles: tuple[str, ...] = MEMBERSHIP_ROLES) -> list[Rule]:
    return [Predicate(F.col("role_title").isin(*roles), "bad_role")]


def rsvp_rules(memberships: DataFrame, events: DataFrame, check_keys: bool = False,
               between: tuple[Rule, ...] = ()) -> list[Rule]:
    """Status in range, and the responder is a member of the event's team.

    The team check looks up the event's team and the member's group once
    each (linear in the RSVPs) instead of expanding members × events per
    team.  With ``check_keys`` the two lookups are also the foreign-key
    checks (reasons ``unknown_event_id`` / ``unknown_membership_id``), so a
    full RSVP check needs only these two joins.  ``between`` rules are
    placed after the lookups (the timestamp check, in pipeline order).
    """
    kind = ForeignKey if check_keys else Lookup
    event_team, member_team = _fresh("event_team"), _fresh("member_team")
    return [
        kind("event_id", events, "event_id", (("team_id", event_team),)),
        kind("membership_id", memberships, "membership_id", (("group_id", member_team),)),
        *between,
        Predicate(F.col("rsvp_status").between(RSVP_STATUS_MIN, RSVP_STATUS_MAX), "status_range"),
        Predicate(F.arrays_overlap(F.col(event_team), F.col(member_team)), "not_team_member"),
    ]


# --------------------------------------------------------------------------
# One-call forms of the checks: DataFrame → (accepted, rejected).
# --------------------------------------------------------------------------


def check_unique_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return split(df, [UniqueKey(key)])


def check_foreign_keys(df: DataFrame, keys: list[ForeignKey]) -> tuple[DataFrame, DataFrame]:
    return split(df, list(keys))


def check_timestamps(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    return split(df, [Timestamps(tuple(columns))])


def check_team_rules(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(df, team_rules())


def check_event_rules(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(df, event_rules())


def check_membership_rules(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(df, membership_rules())


def check_rsvp_rules(df: DataFrame, memberships: DataFrame, events: DataFrame):
    return split(df, rsvp_rules(memberships, events))
