"""Refresh silver tables from a stream of bronze change files.

Each micro-batch is a set of changes of one table: it goes through the same
checks and the same merge as a batch refresh (``foreachBatch``), except that

* a key may occur several times: of its accepted changes the one with the
  latest business time counts (ties: the greatest digest).  With
  ``late_versions`` a type-2 table takes every one of them, each where its
  ``valid_from`` puts it, so late changes end up in the history instead of
  on top of it (:func:`refinery.operators.history.splice_changes`);
* keys absent from the micro-batch stay as they are (absence means "not
  changed", not "deleted");
* rejected rows are kept per micro-batch under
  ``<root>/quarantine_stream/<table>/epoch=<n>``.  With ``wait`` a change
  that names an unknown parent is not rejected at once: it waits in
  ``<root>/waiting/<table>`` and is checked again with every later
  micro-batch (or by :func:`release`, after a refresh of the parents) until
  the parent has arrived, or the time is up and it is rejected.

A replayed micro-batch finds equal digests and writes nothing, and replaces
its own rejected rows, so a restart after a failure is harmless.
:func:`unique_changes` drops repeated changes before they get here, across
micro-batches, in Spark's state store.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from refinery.operators.history import as_of_column
from refinery.operators.quality import REASON
from refinery.plans.pipelines import (
    EVERY,
    SILVER,
    Batch,
    events_batch,
    memberships_batch,
    merge_batch,
    quarantined,
    rsvps_batch,
    teams_batch,
    write_changes,
    write_splice,
)
from refinery.sources.tables import BRONZE_SCHEMAS, ParquetTables, checkpoint_root, staging

SINCE = "waiting_since"


def bronze_stream(spark: SparkSession, path: str, table: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of bronze change files with the declared schema."""
    reader = spark.readStream.schema(BRONZE_SCHEMAS[table]).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.load(path)


def unique_changes(stream: DataFrame, delay: str = "2 days", arrived: Column | None = None) -> DataFrame:
    """``stream`` without changes that equal one that arrived up to ``delay``
    before, in whatever micro-batch (a producer's retry, a file sent twice).

    ``arrived`` is the arrival time of a row (default: the time of its
    micro-batch), not its business time: arrival times do not go back, so no
    change is late for the watermark and none is lost, while the state keeps
    the changes of the last ``delay`` only.  An equal change after that goes
    through, and the merge finds it unchanged.
    """
    columns = stream.columns
    at = F.current_timestamp() if arrived is None else arrived
    marked = stream.select(*columns, at.cast("timestamp").alias("__arrived")).withWatermark("__arrived", delay)
    return marked.dropDuplicatesWithinWatermark(columns).select(*columns)


def _pipeline(table: str, store: ParquetTables, changes: bool | str) -> Callable[[DataFrame], Batch]:
    if table == "teams":
        return lambda df: teams_batch(df, changes=changes)
    if table == "memberships":
        return lambda df: memberships_batch(df, store.read(SILVER["teams"]), changes=changes)
    if table == "events":
        return lambda df: events_batch(df, store.read(SILVER["teams"]), changes=changes)
    return lambda df: rsvps_batch(df, store.read(SILVER["memberships"]), store.read(SILVER["events"]), changes=changes)


def _step(df: DataFrame, table: str, store: ParquetTables, epoch: int, as_of, wait: str | None, late_versions: bool) -> dict[str, int]:
    spark, now = df.sparkSession, as_of_column(as_of)
    silver = SILVER[table]
    waiting = StructType([*BRONZE_SCHEMAS[table].fields, StructField(SINCE, TimestampType())])
    with staging(spark) as stage:
        if wait:
            df = df.withColumn(SINCE, now).unionByName(store.read_whole(f"waiting/{table}", waiting))
        batch = _pipeline(table, store, EVERY if late_versions else True)(df)
        batch.tagged.persist()
        try:
            if late_versions:
                counts = write_splice(store, table, batch, stage)
            else:
                counts = write_changes(store, table, merge_batch(batch, store.read(silver), as_of, departures=False), stage)
            rejected = batch.tagged.rejected()
            if wait:
                stays = F.col(REASON).startswith("unknown_") & (F.col(SINCE) + F.expr(f"INTERVAL {wait}") > now)
                kept = stage(rejected.where(stays).select(*waiting.names), f"waiting_{table}")
                rejected = rejected.where(~stays).drop(SINCE)
            quarantined(table, rejected, as_of).write.mode("overwrite").parquet(f"{store.root}/quarantine_stream/{table}/epoch={epoch}")
            if wait:
                store.replace(f"waiting/{table}", kept)
        finally:
            batch.tagged.unpersist()
    return counts


def release(spark: SparkSession, table: str, store: ParquetTables, wait: str, as_of=None, late_versions: bool = False) -> dict[str, int]:
    """Checks the waiting changes of ``table`` again without new ones, for
    instance after a refresh of its parents; returns the changed rows."""
    nothing = spark.createDataFrame([], BRONZE_SCHEMAS[table])
    return _step(nothing, table, store, -time.time_ns(), as_of, wait, late_versions)


def refresh_stream(stream: DataFrame, table: str, store: ParquetTables, as_of=None,
                   checkpoint: str | None = None, available_now: bool = True,
                   on_batch: Callable[[int, dict[str, int]], None] | None = None,
                   wait: str | None = None, late_versions: bool = False) -> StreamingQuery:
    """Start a query that merges each micro-batch of ``stream`` into the
    silver table of ``table``.  Parents are read from ``store`` per batch,
    so they see the latest refresh of the upstream tables.  ``as_of`` may be
    a function of the epoch; ``wait`` is an interval such as ``3 days``."""
    spark = stream.sparkSession
    checkpoint = checkpoint or f"{checkpoint_root(spark)}/refinery-streams/{table}-{uuid.uuid4().hex}"

    def step(batch_df: DataFrame, epoch_id: int) -> None:
        counts = _step(batch_df, table, store, epoch_id, as_of(epoch_id) if callable(as_of) else as_of, wait, late_versions)
        if on_batch is not None:
            on_batch(epoch_id, counts)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
