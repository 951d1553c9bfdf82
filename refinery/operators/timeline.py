"""Rows of one key in time order, without one task per key.

A window over a key puts all its rows into one task.  Here a key with more
than ``rows`` rows is cut into slices of time first: one aggregate counts the
rows per key and takes their first and last time, and a hot key gets as many
equally wide slices as its count asks for.  A slice that is still over the
limit is cut once more by its own first and last time.  Windows then run
within (key, slice); what a slice needs from its neighbours comes from one
row per slice of the hot keys alone, so keys that were not cut cost nothing
more than a plain window.

Times are ordered to the microsecond; rows of one key and one time always
share a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.sources.tables import keyed_side

SLICE_ROWS = 1_000_000
SLICES = ("__slice_a", "__slice_b")


def time_slices(df: DataFrame, keys: list[str], time: str, rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with the two slice numbers of each row (0 and 0 unless its key
    is hot); they rise with ``time`` within a key."""
    at = F.unix_micros(F.col(time).cast("timestamp")).cast("double")
    for level, name in enumerate(SLICES):
        group = [*keys, *SLICES[:level]]
        hot = (df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"), F.min(at).alias("__lo"), F.max(at).alias("__hi"))
               .where((F.col("__n") > rows) & (F.col("__hi") > F.col("__lo")))
               .select(*[F.col(c).alias(f"__of_{c}") for c in group], "__lo", "__hi", F.ceil(F.col("__n") / rows).cast("long").alias("__k")))
        on = None
        for c in group:
            same = F.col(c) == F.col(f"__of_{c}")
            on = same if on is None else on & same
        number = F.coalesce(F.width_bucket(at, F.col("__lo"), F.col("__hi"), F.col("__k")), F.lit(0)).cast("long")
        df = df.join(keyed_side(hot), on, "left").withColumn(name, number).select(*df.columns, name)
    return df


def _per_slice(df: DataFrame, keys: list[str], value: Column, over: Column, name: str) -> DataFrame:
    """One row per slice of the hot keys: ``over`` (a window function of
    ``__v``) along each key's slices."""
    hot = df.where(F.col(SLICES[0]) > 0).groupBy(*keys, *SLICES).agg(value.alias("__v"))
    found = hot.select(*[F.col(c).alias(f"__of_{c}") for c in (*keys, *SLICES)], over.alias(name))
    return keyed_side(found)


def _beside(df: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    on = None
    for c in (*keys, *SLICES):
        same = F.col(c) == F.col(f"__of_{c}")
        on = same if on is None else on & same
    return df.join(extra, on, "left").drop(*[f"__of_{c}" for c in (*keys, *SLICES)])


def with_next(df: DataFrame, keys: list[str], time: str, order: list[str], value: Column, name: str, rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with ``name``: ``value`` (not NULL) of the key's next row by
    ``time`` and ``order``; NULL at its last."""
    sliced = time_slices(df, keys, time, rows).withColumn("__value", value)
    inside = Window.partitionBy(*keys, *SLICES).orderBy(time, *order)
    first = F.min_by("__value", F.struct(time, *order))
    along = F.lead("__v").over(Window.partitionBy(*keys).orderBy(*SLICES))
    out = _beside(sliced.withColumn(name, F.lead("__value").over(inside)), _per_slice(sliced, keys, first, along, "__after"), keys)
    return out.withColumn(name, F.coalesce(name, "__after")).select(*df.columns, name)


def carried(df: DataFrame, keys: list[str], time: str, order: list[str], value: Column, name: str, rows: int = SLICE_ROWS,
            greatest: bool = False) -> DataFrame:
    """``df`` with ``name``: the last ``value`` that is not NULL up to and
    including the row, by ``time`` and ``order``; with ``greatest`` the
    greatest one instead."""
    sliced = time_slices(df, keys, time, rows).withColumn("__value", value)
    inside = Window.partitionBy(*keys, *SLICES).orderBy(time, *order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(*SLICES).rowsBetween(Window.unboundedPreceding, -1)
    if greatest:
        own, per_slice, along = F.max("__value").over(inside), F.max("__value"), F.max("__v").over(before)
    else:
        own = F.last("__value", ignorenulls=True).over(inside)
        per_slice = F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(time, *order)))
        along = F.last("__v", ignorenulls=True).over(before)
    out = _beside(sliced.withColumn(name, own), _per_slice(sliced, keys, per_slice, along, "__before"), keys)
    return out.withColumn(name, F.greatest(name, "__before") if greatest else F.coalesce(name, "__before")).select(*df.columns, name)
