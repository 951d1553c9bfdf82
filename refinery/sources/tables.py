"""Declared table schemas, bronze readers, and the Parquet sink.

A silver table is a plain partitioned Parquet folder,
``<root>/<table>/bucket=<n>``, cut by key hash.  A refresh writes the buckets
that hold a change and no others (Spark's dynamic partition overwrite), so a
run with nothing to change writes nothing.  The rows are rebalanced by bucket
before the write: AQE gives a large bucket several tasks and files and small
ones one task together, so the tasks follow the data, not the number of
buckets.  Rows are sorted by date key within a file, so Parquet statistics
prune date-key filters.  Any Hadoop file system the cluster mounts works.

Limits: one writer at a time; a reader of a bucket that is replaced under it
fails and starts again; a job that dies in its tasks leaves the table as it
was, one whose driver dies while it renames the finished buckets may leave
some of them missing, and the bronze data gives their active rows again.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from refinery.functions.columns import packed_digest, row_digest, unpacked_digest


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, I, L, B, T = StringType(), DoubleType(), IntegerType(), LongType(), BooleanType(), TimestampType()

BRONZE_SCHEMAS = {
    "teams": _schema(("team_id", S), ("team_activity", S), ("country_code", S), ("created_at", S)),
    "memberships": _schema(("membership_id", S), ("group_id", S), ("role_title", S), ("joined_at", S)),
    "events": _schema(("event_id", S), ("team_id", S), ("event_start", S), ("event_end", S),
                      ("latitude", D), ("longitude", D), ("created_at", S)),
    "event_rsvps": _schema(("event_rsvp_id", S), ("event_id", S), ("membership_id", S),
                           ("rsvp_status", L), ("responded_at", S)),
}

_SCD1 = (("hash_key", S), ("system_created_at", T), ("system_updated_at", T))
_SCD2 = (("hash_key", S), ("system_is_active", B), ("system_valid_from", T), ("system_valid_to", T))

SILVER_SCHEMAS = {
    "teams_refined": _schema(("team_id", S), ("team_activity", S), ("country_code", S), ("created_at", T),
                             ("created_at_datekey", I), *_SCD1),
    "memberships_refined": _schema(("membership_id", S), ("group_id", S), ("role_title", S),
                                   ("joined_at", T), ("joined_at_datekey", I), *_SCD2),
    "events_refined": _schema(("event_id", S), ("team_id", S), ("event_start", T), ("event_start_datekey", I),
                              ("event_end", T), ("event_end_datekey", I), ("latitude", D), ("longitude", D),
                              ("created_at", T), ("created_at_datekey", I), ("county", S), ("state", S), *_SCD2),
    "event_rsvps_refined": _schema(("event_rsvp_id", S), ("event_id", S), ("membership_id", S),
                                   ("rsvp_status", L), ("responded_at", T), ("responded_at_datekey", I), *_SCD1),
}

QUARANTINE_SCHEMA = _schema(("table_name", S), ("record_key", S), ("dq_reason", S), ("raw_row", S),
                            ("refreshed_at", T))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to the declared schema (order and types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, and the planner knows it: a merge into it moves nothing."""
    return spark.createDataFrame([], schema).where(F.lit(False))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with zstd, which halves hex digests (snappy keeps their length)."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def moved(df: DataFrame, move, digest_columns: list[str] | None = None) -> DataFrame:
    """``move(df)`` (a shuffle) with the digests packed while they travel, or
    taken from ``digest_columns`` after it."""
    if "hash_key" not in df.columns:
        return move(df)
    if digest_columns:
        return move(df.drop("hash_key")).withColumn("hash_key", row_digest(digest_columns)).select(*df.columns)
    out = move(df.withColumn("hash_key", packed_digest("hash_key")))
    return out.withColumn("hash_key", unpacked_digest("hash_key"))


MALFORMED = "malformed"


def read_bronze_csv(spark: SparkSession, path: str, table: str, **options) -> DataFrame:
    """Bronze load from CSV with the declared columns (no inference).

    Numbers are parsed here; what does not parse is kept as text in
    ``malformed`` (``column=text``, else NULL), so that the pipelines can
    quarantine the row instead of taking the value for a missing one.
    """
    schema = BRONZE_SCHEMAS[table]
    text = _schema(*[(f.name, S) for f in schema.fields])
    raw = spark.read.schema(text).options(header="true", **options).csv(path)
    bad = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.concat(F.lit(f"{f.name}="), F.col(f.name)))
           for f in schema.fields if f.dataType != S]
    found = F.nullif(F.concat_ws(" ", *bad), F.lit("")) if bad else F.lit(None).cast("string")
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], found.alias(MALFORMED))


def create_layers(spark: SparkSession, environment: str) -> list[str]:
    """Creates what is absent of an environment's schemas and tables, with the
    declared column types; returns the table names."""
    names = []
    for layer, tables in (("bronze", BRONZE_SCHEMAS), ("silver", {**SILVER_SCHEMAS, "quarantine": QUARANTINE_SCHEMA})):
        schema = f"{environment}_{layer}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
        for table, fields in tables.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            spark.sql(f"CREATE TABLE IF NOT EXISTS `{schema}`.`{table}` ({columns}) USING parquet")
            names.append(f"{schema}.{table}")
    return names


def read_bronze_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, bounds: tuple[int, int],
                     source_table: str | None = None, num_partitions: int = 64, **options) -> DataFrame:
    """Bronze load from a database over JDBC, read in parallel ranges of a
    numeric ``partition_column``; without them one task would read it all."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", source_table or table)
    reader = (reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0])
              .option("upperBound", bounds[1]).option("numPartitions", num_partitions))
    return conform(reader.options(**options).load(), BRONZE_SCHEMAS[table])


# --------------------------------------------------------------------------
# Shared scratch space
# --------------------------------------------------------------------------


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set on the
    cluster).  Unset, a local session gets a folder of its own (tests); on a
    cluster that is an error, since no machine's own folder is shared."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        d = tempfile.mkdtemp(prefix="refinery-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def staging(spark: SparkSession):
    """``stage(df, name)`` for the block: writes ``df`` as Parquet under the
    checkpoint folder and reads it back, which cuts the lineage (a lost
    executor re-reads files) and lets several outputs share one computation.
    The folder is deleted when the block ends."""
    root = f"{checkpoint_root(spark)}/refinery-stage/{uuid.uuid4().hex}"

    def stage(df: DataFrame, name: str) -> DataFrame:
        write_parquet(df, f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    try:
        yield stage
    finally:
        delete_path(spark, root)


def keyed_side(df: DataFrame) -> DataFrame:
    """The keyed side (an aggregate: one row per key) of a join whose other
    side may hold hot keys.

    An aggregate directly under the join leaves AQE unable to split a skewed
    partition of the other side, since both sides must be plain shuffles.  A
    rebalance above the aggregate gives it one: AQE then measures the keyed
    side (and broadcasts it if it turns out small) and splits hot partitions
    of the other.  It is one lazy plan at every size; only keys move twice.
    """
    return df.hint("rebalance")


# --------------------------------------------------------------------------
# Sink
# --------------------------------------------------------------------------


class ParquetTables:
    """Silver tables under ``root`` (see module docstring).  ``buckets`` stays
    for the life of the tables."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 32):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def read(self, table: str, schema: StructType | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The table (absent: no rows), or only the rows of some buckets."""
        schema = schema or SILVER_SCHEMAS[table]
        if not self.exists(table):
            return empty(self.spark, schema)
        rows = self.spark.read.schema(StructType([*schema.fields, StructField("bucket", I, True)])).parquet(self.path(table))
        return (rows if buckets is None else rows.where(F.col("bucket").isin(buckets))).select(*schema.names)

    def bucket_of(self, *key: str):
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def write(self, table: str, df: DataFrame, key: str, order: str | None = None) -> None:
        """Replaces the buckets that ``df`` has rows of; ``df`` may read them."""
        out = moved(df.withColumn("bucket", self.bucket_of(key)), lambda rows: rows.hint("rebalance", F.col("bucket")))
        out = out.sortWithinPartitions("bucket", *([order] if order else []))
        out.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd").partitionBy("bucket").parquet(self.path(table))

    def read_whole(self, name: str, schema: StructType) -> DataFrame:
        """A small table without buckets (absent: no rows)."""
        return self.spark.read.schema(schema).parquet(self.path(name)) if self.exists(name) else empty(self.spark, schema)

    def replace(self, name: str, df: DataFrame) -> None:
        """Replaces such a table by ``df``, which must not read it."""
        write_parquet(df, self.path(name), "overwrite")


def bucketed_table(df: DataFrame, name: str, key: str, path: str, buckets: int = 64, files_per_bucket: int = 4,
                   digest_columns: list[str] | None = None) -> DataFrame:
    """Writes ``df`` as a catalog table with Spark's own buckets, sorted by
    ``key`` within a file, and returns the table.

    Rows are dealt by the key to ``buckets * files_per_bucket`` tasks; as that
    is a multiple of the buckets, each task holds rows of one bucket and
    writes one file, so a load uses that many tasks and a bucket is that many
    files.  Merges and joins on ``key`` then read the table without a shuffle:
    only the other side moves.  It suits tables that are merged whole; the
    buckets of :class:`ParquetTables` suit few changes, which replace some.
    ``digest_columns``: the rows' digest is that of these columns, and is taken
    from them after the rows are dealt.
    """
    dealt = moved(df, lambda rows: rows.repartition(buckets * files_per_bucket, key), digest_columns)
    dealt.write.mode("overwrite").format("parquet").options(path=path, compression="zstd").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)
