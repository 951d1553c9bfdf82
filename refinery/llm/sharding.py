"""Sharding by extendible hashing.

Every row has a string of hash bits.  The directory starts with one bucket
for all rows; a bucket whose rows hold more than ``max_bytes`` is split on
the next bit, and only such buckets are, until every bucket fits.  A bucket
is thus named by a bit prefix, and prefixes of the directory are disjoint.

Plan: the columns given are written once with the key hash, place and bytes of
each row (give narrow ones and join the shard ids back where texts are large).
Then in rounds of ``step`` bits: open rows are summed per ``step``-bit cell (partial
aggregation, at most 2^step cells per open bucket), each cell's sum is rolled
up to its ancestors, and a cell takes the shortest prefix that fits.  Rows in
cells that fit no prefix go to the next round, ``step`` bits deeper; all
others are done.  A round halves an open bucket ``step`` times, so rounds grow
with log(bytes / max_bytes) / step.  The row-to-cell join is on cell number;
Spark broadcasts the cell table when its files are small and splits skewed
partitions otherwise.

Key bits are 60 bits of md5(key).  Rows that agree in all of them (copies of
one key, which may be a third of the table) are split on 60 further bits, a
hash of the row's place that was written with it, so the salt is the same
after any retry.

Defined cases: a null key hashes as the empty string; a null text has 0
bytes (a null size is 0), a very long one its whole length; a row larger than ``max_bytes`` on its own can fit no bucket and gets
a shard to itself, named ``big-<place>``; ``shard_id``, ``shard_depth`` and
``shard_row_bytes`` replace input columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, without

KEY_BITS = 60
MAX_BYTES = 1 << 20
STEP = 12


def _prefix(bits: int):
    """The first ``bits`` of the row's 120 hash bits, as a number (the first
    60 bits are fixed within an open bucket beyond them)."""
    if bits <= KEY_BITS:
        return F.shiftright("__h", KEY_BITS - bits)
    return F.shiftright("__salt", 2 * KEY_BITS - bits)


def _bucket(base: int):
    """What tells open buckets apart at depth ``base``."""
    return ["__h"] if base >= KEY_BITS else []


def assign_shards(df: DataFrame, key: str = "doc_id", size: Column | None = None, max_bytes: int = MAX_BYTES,
                  step: int = STEP) -> DataFrame:
    """``df`` with ``shard_id`` (the bucket's bits; '' for a sole bucket),
    ``shard_depth`` (how many) and ``shard_row_bytes``.  ``size`` is a row's
    bytes, by default those of its ``text``."""
    size = F.octet_length("text") if size is None else size
    if KEY_BITS % step:
        raise ValueError("step must divide 60")
    scratch = Scratch(df.sparkSession, "shards")
    columns = without(df.columns, ("shard_id", "shard_depth", "shard_row_bytes"))
    rows = df.select(
        *columns,
        F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long").alias("__h"),
        F.coalesce(size, F.lit(0)).cast("long").alias("__bytes"),
    )
    rows = scratch.put(rows.withColumn("__row", F.monotonically_increasing_id()), "rows")
    rows = rows.withColumn("__salt", F.shiftrightunsigned(F.xxhash64("__row"), 64 - KEY_BITS))
    whole = rows.select(*columns, F.concat(F.lit("big-"), F.col("__row")).alias("shard_id"),
                        F.lit(0).alias("shard_depth"), F.col("__bytes").alias("shard_row_bytes"), "__bytes")
    out = whole.where(F.col("__bytes") > max_bytes).drop("__bytes")
    rest = rows.where(F.col("__bytes") <= max_bytes)
    for base in range(0, 2 * KEY_BITS, step):
        by = _bucket(base)
        cells = rest.groupBy(*by, _prefix(base + step).alias("__cell")).agg(F.sum("__bytes").alias("__sum"))
        levels = cells.select(*by, "__cell", "__sum", F.explode(F.sequence(F.lit(0), F.lit(step))).alias("__d"))
        levels = levels.withColumn("__at", F.expr(f"shiftright(__cell, {step} - __d)"))
        fits = levels.groupBy(*by, "__d", "__at").agg(F.sum("__sum").alias("__total")).where(F.col("__total") <= max_bytes)
        depth = (
            levels.join(fits, [*by, "__d", "__at"], "left")
            .groupBy(*by, "__cell")
            .agg(F.min(F.when(F.col("__total").isNotNull(), F.col("__d"))).alias("__depth"))
        )
        depth = scratch.put(depth.select(*[F.col(c).alias(f"__of{c}") for c in by], F.col("__cell").alias("__of"), "__depth"), f"cells{base}")
        on = _prefix(base + step) == F.col("__of")
        for c in by:
            on &= F.col(c) == F.col(f"__of{c}")
        placed = rest.join(depth, on)
        bits = F.lpad(F.conv(F.col("__of").cast("string"), 10, 2), base + step - (KEY_BITS if by else 0), "0")
        if by:
            bits = F.concat(F.lpad(F.conv(F.col("__h").cast("string"), 10, 2), KEY_BITS, "0"), bits)
        total = F.lit(base) + F.col("__depth")
        done = placed.where(F.col("__depth").isNotNull()).select(
            *columns, F.substring(bits, F.lit(1), total).alias("shard_id"), total.alias("shard_depth"),
            F.col("__bytes").alias("shard_row_bytes"))
        out = out.unionByName(done)
        if depth.where(F.col("__depth").isNull()).isEmpty():
            return out
        rest = placed.where(F.col("__depth").isNull()).select(*rest.columns)
    raise RuntimeError("rows with equal hash and salt exceed max_bytes")


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard; a shard's rows come from one task, which holds
    whole shards of bounded size."""
    assigned.repartition("shard_id").write.partitionBy("shard_id").parquet(path)


def op1_extendible_shards(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.octet_length("text").alias("n_bytes"))
    out = assign_shards(docs, size=F.col("n_bytes"))
    return out.select("doc_id", "shard_id", F.col("shard_depth").cast("long").alias("shard_depth"),
                      F.col("shard_row_bytes").alias("n_bytes"))


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h, strlen(text) AS n_bytes FROM documents
), levels AS (SELECT doc_id, n_bytes, h, k, h >> (60 - k) AS p FROM d, range(0, 41) r(k)
), fits AS (SELECT k, p FROM levels GROUP BY k, p HAVING sum(n_bytes) <= {MAX_BYTES}
), depth AS (SELECT doc_id, min(k) AS k FROM levels JOIN fits USING (k, p) GROUP BY doc_id)
SELECT doc_id, substr(lpad(bin(h), 60, '0'), 1, CAST(k AS INTEGER)) AS shard_id, CAST(k AS BIGINT) AS shard_depth, n_bytes
FROM d JOIN depth USING (doc_id)
"""
