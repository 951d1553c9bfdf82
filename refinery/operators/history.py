"""Change capture and type-1 / type-2 histories as pure DataFrame plans.

Every function takes the current table (``target``) and the accepted batch
and returns DataFrames; nothing is written here (see
:mod:`refinery.sources.tables` for the snapshot sink).  The next state of a
table comes from **one** full outer join of the active rows with the batch
on the business key, so close-and-append is computed from one consistent
snapshot and lands in one write.

Each output row carries a ``change`` label; counting labels gives the
refresh statistics without a second pass:

* type 1: ``new``, ``changed``, ``same``, ``kept`` (not in the batch; type 1
  never deletes).
* type 2: ``new`` / ``changed`` (the new active version), ``superseded``
  (the version it closes), ``same``, ``held`` (key present in the raw batch
  but rejected by a check: left active), ``departed`` (closed because the
  key left the source), ``history`` (already inactive, passed through).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import digest_of, packed_digest, row_digest, unpacked_digest
from refinery.operators.timeline import SLICE_ROWS, with_next
from refinery.sources.tables import keyed_side

HASH = "hash_key"
CREATED, UPDATED = "system_created_at", "system_updated_at"
ACTIVE, VALID_FROM, VALID_TO = "system_is_active", "system_valid_from", "system_valid_to"
CHANGE = "change"
REPLACED = "replaced"
SCD1_SYSTEM = (HASH, CREATED, UPDATED)
SCD2_SYSTEM = (HASH, ACTIVE, VALID_FROM, VALID_TO)


def as_of_column(as_of: str | _dt.datetime | Column | None) -> Column:
    """Refresh time: a literal for repeatable runs, else ``current_timestamp``."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def _time(column: str | None, as_of) -> Column:
    return F.col(column) if column else as_of_column(as_of)


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in SCD1_SYSTEM + SCD2_SYSTEM + (CHANGE,)]


def stamp_scd1(df: DataFrame, time_column: str | None = None, as_of=None,
               digest_columns: list[str] | None = None) -> DataFrame:
    """Add ``hash_key`` (over all business columns) and the two SCD1 system
    times, taken from ``time_column`` or else the refresh time."""
    cols = digest_columns or business_columns(df)
    t = _time(time_column, as_of)
    return df.withColumns({HASH: row_digest(cols), CREATED: t, UPDATED: t})


def stamp_scd2(df: DataFrame, time_column: str | None = None, as_of=None,
               digest_columns: list[str] | None = None) -> DataFrame:
    """Add ``hash_key``, ``system_is_active`` = true, ``system_valid_from``
    from ``time_column`` (or the refresh time) and a typed NULL ``valid_to``."""
    cols = digest_columns or business_columns(df)
    return df.withColumns({
        HASH: row_digest(cols),
        ACTIVE: F.lit(True),
        VALID_FROM: _time(time_column, as_of),
        VALID_TO: F.lit(None).cast("timestamp"),
    })


def is_active() -> Column:
    """A stored row without the flag counts as inactive, never as neither."""
    return F.coalesce(F.col(ACTIVE), F.lit(False))


# The two sides of a merge, the table and the batch, are told apart by
# qualifiers.  Renaming their columns instead lets the optimizer state every
# constraint of a row (its digest names all columns) once for each choice of
# old and new names, which grows as 2^columns and ends in the driver's memory.
T, B = "__table", "__batch"
IN_T, IN_B = "__t", "__b"


def _of(side: str, column: str) -> Column:
    return F.col(f"{side}.`{column}`")


def _side(df: DataFrame, marker: str) -> DataFrame:
    """One side of a merge, its digest packed for the shuffle."""
    return df.withColumns({**({HASH: packed_digest(HASH)} if HASH in df.columns else {}), marker: F.lit(True)})


def _value(side: str, column: str) -> Column:
    """A column of one side as it was before :func:`_side`."""
    return unpacked_digest(_of(side, column)) if column == HASH else _of(side, column)


def _unpacked(df: DataFrame) -> DataFrame:
    return df.withColumns({c: unpacked_digest(c) for c in (HASH,) if c in df.columns})


def _on(keys: list[str], left: str, right: str) -> Column:
    cond = None
    for k in keys:
        c = _of(left, k) == _of(right, k)
        cond = c if cond is None else cond & c
    return cond


# --------------------------------------------------------------------------
# Type 1
# --------------------------------------------------------------------------


def changed_rows(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows that are new or differ from the stored row (key + digest
    not in the target).  Comparing the key as well as the digest keeps a new
    key whose other values equal a stored row."""
    packed = [df.withColumn(HASH, packed_digest(HASH)) for df in (batch, target.select(*keys, HASH))]
    return _unpacked(packed[0].join(packed[1], on=[*keys, HASH], how="left_anti")).select(*batch.columns)


def scd1_merge(target: DataFrame, batch: DataFrame, keys: list[str],
               preserve: tuple[str, ...] = (CREATED,), replaced: tuple[str, ...] = (),
               digest_columns: list[str] | None = None) -> DataFrame:
    """Upsert ``batch`` into ``target`` on ``keys`` → next table + ``change``.

    Matched and different: batch values, except ``preserve`` columns keep the
    stored value (the creation time survives updates).  Matched and equal:
    the stored row untouched.  Unmatched batch rows are inserted; stored rows
    without a batch row stay (type 1 never deletes).  ``replaced`` names
    columns whose stored values a ``changed`` row brings along, as the struct
    ``replaced``, for readers that would join the stored table again for them.
    ``digest_columns``: the batch's digest is that of these columns, which
    travel anyway, so it is taken after the join and does not travel.
    """
    cols = list(target.columns)
    t = _side(target, IN_T).alias(T)
    b = _side(batch.select(*[c for c in cols if c != HASH or not digest_columns]), IN_B).alias(B)
    j = t.join(b, _on(keys, T, B), "full_outer")
    taken = F.when(F.col(IN_B), F.unhex(digest_of([_of(B, c) for c in digest_columns]))) if digest_columns else _of(B, HASH)
    j = j.withColumn("__digest", taken)
    change = (
        F.when(F.col(IN_T).isNull(), F.lit("new"))
        .when(F.col(IN_B).isNull(), F.lit("kept"))
        .when(_of(T, HASH) == F.col("__digest"), F.lit("same"))
        .otherwise(F.lit("changed"))
    )
    j = j.withColumn(CHANGE, change)
    take_batch = F.col(CHANGE).isin("new", "changed")
    out = []
    for c in cols:
        use_b = (F.col(CHANGE) == "new") if c in preserve else take_batch
        out.append(F.when(use_b, F.col("__digest") if c == HASH else _of(B, c)).otherwise(_of(T, c)).alias(c))
    old = [F.when(F.col(CHANGE) == "changed", F.struct(*[_of(T, c).alias(c) for c in replaced])).alias(REPLACED)] if replaced else []
    return _unpacked(j.select(*out, CHANGE, *old))


def apply_scd1(target: DataFrame, batch: DataFrame, keys: list[str],
               preserve: tuple[str, ...] = (CREATED,)) -> DataFrame:
    return scd1_merge(target, batch, keys, preserve).drop(CHANGE)


# --------------------------------------------------------------------------
# Type 2
# --------------------------------------------------------------------------


def _scd2_join(target: DataFrame, accepted: DataFrame, keys: list[str],
               present: DataFrame | None, departures: bool = True) -> tuple[DataFrame, list[str]]:
    """Active target rows ⋈ batch on keys (full outer), with a ``change`` label.

    ``present`` holds the keys that are still in the source (default: the
    accepted keys).  ``departures=False`` treats the batch as a change set
    (a stream increment): absent keys are ``kept``, never closed.  It is joined onto the batch side first, so the batch
    side stays hash-partitioned by the keys and only the active rows
    shuffle for the full outer join.
    """
    cols = list(target.columns)
    active = target.where(is_active())
    t = _side(active, IN_T)
    b = _side(accepted.select(*cols), IN_B)
    if present is not None:
        p = (present.select(*keys).where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).distinct()
             .withColumn("__p", F.lit(True)))
        b = p.join(b, on=keys, how="left")
    else:
        b = b.withColumn("__p", F.lit(True))
    j = t.alias(T).join(b.alias(B), _on(keys, T, B), "full_outer")
    change = (
        F.when(F.col(IN_T).isNull() & F.col(IN_B).isNotNull(), F.lit("new"))
        .when(F.col(IN_T).isNull(), F.lit(None).cast("string"))
        .when(F.col(IN_B).isNotNull() & (_of(T, HASH) == _of(B, HASH)), F.lit("same"))
        .when(F.col(IN_B).isNotNull(), F.lit("changed"))
        .when(F.col("__p").isNotNull(), F.lit("held"))
        .otherwise(F.lit("departed" if departures else "kept"))
    )
    return j.withColumn(CHANGE, change).where(F.col(CHANGE).isNotNull()), cols


def scd2_changes(accepted: DataFrame, target: DataFrame, keys: list[str],
                 present: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new_versions, departed): batch rows that are new or differ from the
    *active* version of their key, and active rows whose key left the source
    (returned as stored, still active)."""
    j, cols = _scd2_join(target, accepted, keys, present)
    new_versions = j.where(F.col(CHANGE).isin("new", "changed")).select(
        *[_value(B, c).alias(c) for c in cols])
    departed = j.where(F.col(CHANGE) == "departed").select(*[_value(T, c).alias(c) for c in cols])
    return new_versions, departed


def scd2_merge(target: DataFrame, accepted: DataFrame, keys: list[str], as_of=None,
               present: DataFrame | None = None, append: bool = True,
               departures: bool = True) -> DataFrame:
    """Next type-2 table (+ ``change``) in one pass.

    A superseded version is closed at the new version's ``valid_from``; a
    departed one at ``as_of``.  Compared with *active* versions only, so a
    value that reverts (A → B → A) and a key that returns after leaving both
    open a new version.  ``append=False`` gives the stored table with the
    closings applied and no new versions.
    """
    j, cols = _scd2_join(target, accepted, keys, present, departures)
    ch = F.col(CHANGE)
    closed_at = F.when(ch == "changed", _of(B, VALID_FROM)).otherwise(as_of_column(as_of))
    closing = ch.isin("changed", "departed")

    old_fields = []
    for c in cols:
        v = _value(T, c)
        if c == ACTIVE:
            v = F.when(closing, F.lit(False)).otherwise(v)
        elif c == VALID_TO:
            v = F.when(closing, closed_at.cast("timestamp")).otherwise(v)
        old_fields.append(v.alias(c))
    old_label = F.when(ch == "changed", F.lit("superseded")).otherwise(ch)
    old = F.when(F.col(IN_T).isNotNull(), F.struct(*old_fields, old_label.alias(CHANGE)))
    new = F.when(ch.isin("new", "changed") & F.lit(append),
                 F.struct(*[_value(B, c).alias(c) for c in cols], ch.alias(CHANGE)))
    versions = j.select(F.inline(F.filter(F.array(old, new), lambda s: s.isNotNull())))
    history = target.where(~is_active()).select(*cols, F.lit("history").alias(CHANGE))
    return history.unionByName(versions)


def apply_scd2(target: DataFrame, accepted: DataFrame, keys: list[str], as_of=None,
               present: DataFrame | None = None) -> DataFrame:
    return scd2_merge(target, accepted, keys, as_of, present).drop(CHANGE)


def scd2_close(target: DataFrame, accepted: DataFrame, keys: list[str], as_of=None,
               present: DataFrame | None = None) -> DataFrame:
    """Stored rows with superseded and departed versions closed, no appends."""
    return scd2_merge(target, accepted, keys, as_of, present, append=False).drop(CHANGE)


def latest_per_key(df: DataFrame, key: str, sequence: str) -> DataFrame:
    """The last change of each key: the row of greatest ``sequence`` (ties:
    the greatest digest), found by a partial aggregate."""
    row = F.struct(F.col(sequence).alias("__seq"), F.col(HASH).alias("__hash"), F.struct(*df.columns).alias("__row"))
    return df.groupBy(F.col(key).alias("__key")).agg(F.max(row).alias("__last")).select("__last.__row.*")


# --------------------------------------------------------------------------
# Type 2, versions in any order of arrival
# --------------------------------------------------------------------------


def splice_changes(target: DataFrame, incoming: DataFrame, keys: list[str], departed: DataFrame | None = None,
                   slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Versions that ``incoming`` adds to the type-2 table ``target``, or whose
    end it moves, with ``change``: ``new`` or ``recut``.

    Unlike :func:`scd2_merge`, which makes an arriving version the active one,
    a version goes where its ``valid_from`` puts it: the stored and incoming
    versions of a key are merged in time order, and each ends where the next
    begins.  So any order of arrival gives the same history.  What ends a
    version without a successor is kept: a stored ``valid_to`` stays an end
    unless a version begins there, and ``departed`` (the keys and a
    ``system_valid_to``) ends what is valid at that time.  A departure counts
    from what is known when it arrives: versions that begin later stay.

    Of two versions of one key and time the one with the greater digest
    stands.  Versions already stored (key, time and digest) change nothing.
    A version equal to its predecessor stays a version of its own, since a
    late one may fall between the two.  Incoming rows without a key or a
    ``valid_from`` have no place and are left out.

    ``target`` is read three times, so it should be a stored table, not the
    plan of an earlier splice (chained plans take very long to optimise).
    Only the stored versions of keys with something to add are read again (a
    semi-join); the time order comes from :mod:`refinery.operators.timeline`,
    which cuts the versions of a hot key by time.
    """
    cols = list(target.columns)
    placed = incoming.select(*cols).where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, VALID_FROM))).distinct()
    fresh = placed.join(target.select(*keys, VALID_FROM, HASH), on=[*keys, VALID_FROM, HASH], how="left_anti").select(*cols)
    touched = fresh.select(*keys)
    if departed is not None:
        gone = departed.select(*keys, F.col(VALID_TO).alias("__at")).where(F.col("__at").isNotNull())
        touched = touched.unionByName(gone.select(*keys))
    stored = target.join(keyed_side(touched.distinct()), on=keys, how="left_semi").select(*cols)

    version = F.struct(*cols)
    nothing = F.lit(None).cast(stored.select(version.alias("v")).schema["v"].dataType)
    ends = stored.where(F.col(VALID_TO).isNotNull()).select(*keys, F.col(VALID_TO).alias("__at"))
    if departed is not None:
        ends = ends.unionByName(gone)
    # Ends come before versions of the same time, the version that stands comes last.
    line = ends.distinct().select(*keys, "__at", F.lit(0).alias("__kind"), F.lit(None).cast("string").alias("__digest"), F.lit(False).alias("__new"), nothing.alias("__v"))
    for frame, new in ((stored, False), (fresh, True)):
        line = line.unionByName(frame.select(*keys, F.col(VALID_FROM).alias("__at"), F.lit(1).alias("__kind"), F.col(HASH).alias("__digest"),
                                             F.lit(new).alias("__new"), version.alias("__v")))
    found = with_next(line, keys, "__at", ["__kind", "__digest"], F.struct("__at", "__kind"), "__next", slice_rows)
    stands = (F.col("__kind") == 1) & ~F.coalesce((F.col("__next.__at") == F.col("__at")) & (F.col("__next.__kind") == 1), F.lit(False))
    end = F.col("__next.__at")
    moved = ~F.col(f"__v.{VALID_TO}").eqNullSafe(end) | (F.coalesce(F.col(f"__v.{ACTIVE}"), F.lit(False)) != end.isNull())
    out = {ACTIVE: end.isNull(), VALID_TO: end}
    return found.where(stands & (F.col("__new") | moved)).select(
        *[out.get(c, F.col(f"__v.{c}")).alias(c) for c in cols], F.when(F.col("__new"), F.lit("new")).otherwise(F.lit("recut")).alias(CHANGE))


def apply_splice(stored: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``stored`` after ``changes`` of :func:`splice_changes`."""
    at = changes.select(*keys, VALID_FROM).distinct()
    return append_versions(stored.join(at, on=[*keys, VALID_FROM], how="left_anti").select(*stored.columns), changes)


def splice_versions(target: DataFrame, incoming: DataFrame, keys: list[str], departed: DataFrame | None = None,
                    slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The type-2 table after :func:`splice_changes`."""
    return apply_splice(target, splice_changes(target, incoming, keys, departed, slice_rows), keys)


# Labels of rows that a merge would write; all others stay as they are stored.
CHANGES = ("new", "changed", "superseded", "departed")


def change_set(merged: DataFrame) -> DataFrame:
    return merged.where(F.col(CHANGE).isin(*CHANGES))


def apply_change_set(stored: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``stored`` (all versions of some keys) after ``changes`` of those keys:
    rows that were replaced or closed go, closed and new versions are
    appended.  Type 1 without the active flag, type 2 with it."""
    columns = stored.columns
    touched = changes.where(F.col(CHANGE).isin("changed", "superseded", "departed")).select(F.col(key).alias("__key")).distinct()
    on = F.col(key) == F.col("__key")
    kept = stored.join(touched, on & is_active() if ACTIVE in columns else on, "left_anti")
    return append_versions(kept, changes.select(*columns))


def append_versions(table: DataFrame, new_versions: DataFrame) -> DataFrame:
    """Append rows matched by column name."""
    return table.unionByName(new_versions.select(*table.columns))


def change_counts(merged: DataFrame) -> DataFrame:
    """``change`` label → row count (a handful of rows)."""
    return merged.groupBy(CHANGE).agg(F.count(F.lit(1)).alias("rows"))
