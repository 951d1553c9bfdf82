"""Which key ranges of two tables differ, found by comparing digests.

Keys fall into ``2**bits`` ranges by hash.  A range's digest is its number of
rows, the sum and the exclusive or of their 64-bit hashes: the same for the
same rows in any order, and one partial aggregate over one scan.  Digests add
up, so every ``STEP`` bits a level of parents is kept, up to one root.

:func:`differing_ranges` compares two trees from the root down and looks at
the children of differing nodes only; equal tables are told apart by one row.
What follows (checks, joins, merges) then needs the rows of the differing
ranges alone.  A change is missed only if sum and exclusive or of 64-bit
hashes collide at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StructField, StructType

BITS, STEP = 12, 4

DIGEST_SCHEMA = StructType([StructField("level", IntegerType()), StructField("node", IntegerType()), StructField("n", LongType()),
                            StructField("total", DecimalType(38, 0)), StructField("mix", LongType())])


def key_range(keys: list[str], bits: int = BITS) -> Column:
    """The range of a key (NULL keys have one as well)."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << bits)).cast("int")


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of a row; a NULL hashes unlike any value, in its place."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def _levels(bits: int) -> list[int]:
    """The bits of each level, the root's 0 first."""
    return [*range(0, bits, STEP), bits]


def range_digests(df: DataFrame, keys: list[str], columns: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """The digest tree of ``df``: ``level`` (0: root), ``node``, ``n``,
    ``total`` and ``mix``; nodes without rows have no row."""
    rows = df.select(key_range(keys, bits).alias("__range"), row_hash(columns or df.columns).alias("__h"))
    leaves = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("__h").cast(DecimalType(38, 0))).alias("total"), F.bit_xor("__h").alias("mix"))
    up = F.array(*[F.struct(F.lit(i).alias("level"), F.shiftright("__range", bits - b).alias("node")) for i, b in enumerate(_levels(bits))])
    return leaves.select(F.inline(up), "n", "total", "mix").groupBy("level", "node").agg(
        F.sum("n").alias("n"), F.sum("total").cast(DecimalType(38, 0)).alias("total"), F.bit_xor("mix").alias("mix"))


def differing_ranges(old: DataFrame, new: DataFrame, bits: int = BITS) -> DataFrame:
    """``range`` of every key range whose rows differ between the two trees
    (:func:`range_digests` with these ``bits``)."""
    levels, above = _levels(bits), None
    both = old.withColumn("__side", F.lit("o")).unionByName(new.withColumn("__side", F.lit("w")), allowMissingColumns=True)
    for i, b in enumerate(levels):
        here = both.where(F.col("level") == i)
        if above is not None:  # only children of what differs
            here = here.join(above, F.shiftright("node", b - levels[i - 1]) == F.col("__up"), "left_semi")
        of = {s: F.max(F.when(F.col("__side") == s, F.struct("n", "total", "mix"))) for s in ("o", "w")}
        above = here.groupBy("node").agg(*[v.alias(s) for s, v in of.items()]).where(~F.col("o").eqNullSafe(F.col("w"))).select(F.col("node").alias("__up"))
    return above.select(F.col("__up").alias("range"))


def in_ranges(df: DataFrame, keys: list[str], ranges: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose key lies in ``ranges`` (at most ``2**bits`` rows)."""
    return df.join(ranges.select(F.col("range").alias("__range")), key_range(keys, bits) == F.col("__range"), "left_semi")
