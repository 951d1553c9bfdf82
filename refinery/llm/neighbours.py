"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions by a random rotation, squashed to
the unit cube, shifted, and ordered along a Hilbert curve; this is done
``CURVES`` times with other dimensions and shifts.  A query's candidates are
the rows within ``REACH`` of all places around it on each curve; they are
merged over the curves and reranked by the inner product of the original
vectors.  As the nearness is an inner product, rows get one more coordinate
that makes all lengths equal, and queries a zero there; for unit vectors that
changes nothing.

``REACH`` is a share because vectors without structure need it: on the given
tables (64 near-isotropic dimensions) eight curves of 10 % each way find about
95 % of the true neighbours.  Vectors with structure do with far less.

Equal vectors have one key on every curve, so a group of copies larger than
the reach would hide its smallest ids, which come first among ties.  What is
indexed is therefore the class of equal vectors, by its smallest id and with
its ``k + 1`` smallest; a class asks if one of its rows does.  The first
``k + 1`` ids in order lie in the first ``k + 1`` classes, ordered by score
and smallest id; without the query's own id the ``k`` nearest are left.
``REACH`` stays a share of all rows, so copies leave no other query less.

Plan on Spark: a window with a limit before its shuffle finds the smallest ids
of a class, so a class of any size sends ``k + 1`` rows a task (and as many
that ask).  Scale and spread of the projections are fitted on about
``SAMPLE`` classes; every class is indexed.  (curve, key, id) rows are
range-partitioned and sorted, so equal keys split over tasks too; their order
is written, and a place is the partition's first place (one number per
partition) plus the place in it.  Places are cut into blocks of ``BLOCK``; a
class is in one block per curve, a query visits the blocks in reach, in chunks
of bounded size.  A task multiplies one block by one chunk and returns the
best ``k + 1`` per query, so nothing is grouped without a bound.  The queries
are joined to their class's list on the vector; that list is one row, so AQE
splits a large class's queries.

Defined cases: vectors that are null, zero, or hold a null or non-finite
component take no part, nor do rows with a null id or another length than
most; rows of one id are one candidate, and never that id's own; fewer
candidates than ``k`` are all returned; ties go to the smaller id; no valid
rows give an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, ship

K = 20
CURVES = 8
DIMENSIONS = 4
BITS = 8
REACH = 0.07
BLOCK = 2048
CHUNK = 4096
SAMPLE = 4096
QUERY_EVERY = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates
    (Skilling's transform, then the bits interleaved)."""
    x = [c.astype(np.int64) for c in cells.T]
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(len(x)):
            swap = np.where(x[i] & level, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(x[i] & level, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] = x[i] ^ swap
        level >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        turn = np.where(x[-1] & level, turn ^ (level - 1), turn)
        level >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ turn) >> b) & 1)
    return key


class Curves:
    """Rotations, scales and shifts, fitted on a sample."""

    def __init__(self, sample: np.ndarray, longest: float, curves: int, dimensions: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.longest, size = longest, sample.shape[1] + 1
        take = min(dimensions, size)
        axes = []
        while len(axes) < curves:
            turned = np.linalg.qr(rng.normal(size=(size, size)))[0]
            axes.extend(turned[:, i : i + take] for i in range(0, size - take + 1, take))
        self.axes = np.concatenate(axes[:curves], 1)
        self.curves, self.take = curves, take
        seen = self.lifted(sample) @ self.axes
        self.mean, self.spread = seen.mean(0), np.maximum(seen.std(0), 1e-12)
        self.shift = rng.uniform(0, 0.5, self.axes.shape[1])

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = 1 - (rows * rows).sum(1) / self.longest**2
        return np.concatenate([rows / self.longest, np.sqrt(np.maximum(rest, 0))[:, None]], 1)

    def asked(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([rows / np.sqrt((rows * rows).sum(1))[:, None], np.zeros((len(rows), 1))], 1)

    def keys(self, lifted: np.ndarray) -> np.ndarray:
        """A column of keys per curve."""
        unit = 0.5 / (1 + np.exp(-1.7 * (lifted @ self.axes - self.mean) / self.spread)) + self.shift
        cells = (unit * (1 << BITS)).astype(np.int64)
        return np.stack([hilbert_keys(cells[:, i * self.take : (i + 1) * self.take], BITS) for i in range(self.curves)], 1)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, vec_id: str, vector: str, is_query: Column) -> DataFrame:
    """``vec_id``, ``vector`` (doubles) and ``asks`` of the rows that take
    part, one per id."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))  # -0.0 is 0.0
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & fine).select(
        F.col(vec_id).alias("vec_id"), v.alias("vector"), is_query.alias("asks"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("vector", "asks")).alias("r")).select("vec_id", "r.vector", "r.asks")


def equal_classes(rows: DataFrame, k: int) -> DataFrame:
    """A row per vector of ``usable`` rows: its smallest ``vec_id``, whether
    one of its rows ``asks``, and its ``k`` smallest ``ids`` in order."""
    nth = F.row_number().over(Window.partitionBy("vector", "asks").orderBy("vec_id"))
    least = rows.withColumn("__nth", nth).where(F.col("__nth") <= k)
    ids = F.slice(F.sort_array(F.collect_list("vec_id")), 1, k)  # 2 k at most are collected
    return least.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.max("asks").alias("asks"), ids.alias("ids"))


def _places(rows: DataFrame, curves: Curves, scratch: Scratch) -> tuple[DataFrame, int]:
    """Every row on every curve (``asks`` False), and every query once more
    (True), with its ``place`` on the curve; also the places per curve."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(curves)

    def run(batches):
        curves = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            m, asks = _matrix(batch.column("vector")), batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            which = np.flatnonzero(asks)
            at = np.concatenate([np.arange(len(m)), which])
            keys = np.concatenate([curves.keys(curves.lifted(m)), curves.keys(curves.asked(m[which]))])
            asking = np.concatenate([np.zeros(len(m), bool), np.ones(len(which), bool)])
            taken = pa.array(at)
            for c in range(keys.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(taken), batch.column("vector").take(taken), pa.array(asking),
                     pa.array(np.full(len(at), c, np.int32)), pa.array(keys[:, c])], ["vec_id", "vector", "asks", "curve", "key"])

    keyed = rows.mapInArrow(run, f"vec_id {kind}, vector array<double>, asks boolean, curve int, key long")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "key", "vec_id", "asks"]
    sorted_ = scratch.put(keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33)
    counts = sorted({r["p"]: r["count"] for r in sorted_.groupBy(part.alias("p")).count().collect()}.items())  # a row per partition
    first = np.cumsum([0] + [c for _, c in counts]).tolist()
    total = first[-1] // curves.curves
    firsts = rows.sparkSession.createDataFrame([(p, f) for (p, _), f in zip(counts, first)], "__p long, __first long")
    placed = sorted_.join(F.broadcast(firsts), part == F.col("__p"))  # a row per partition
    place = F.col("__first") + F.col("__at").bitwiseAND((1 << 33) - 1) - F.col("curve") * F.lit(total).cast("long")
    return placed.select("vec_id", "vector", "asks", "curve", place.alias("place")), total


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` best, ties to the smaller id."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, col = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
    else:
        row, col = np.nonzero(scores > -np.inf)
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row, "left")
    return row[nth < k], col[nth < k]


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = K,
            curves: int = CURVES, dimensions: int = DIMENSIONS, reach: float = REACH) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k``
    nearest found rows of every row for which ``is_query`` holds."""
    spark = ship(vectors.sparkSession)
    scratch = Scratch(spark, "neighbours")
    kind = vectors.schema[vec_id].dataType.simpleString()
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    rows = scratch.put(usable(vectors, vec_id, vector, is_query), "rows")
    sizes = sorted(rows.groupBy(F.size("vector").alias("d")).count().collect(), key=lambda r: (-r["count"], r["d"]))  # a row per length
    if not sizes:
        return empty
    rows = rows.where(F.size("vector") == sizes[0]["d"])
    classes = scratch.put(equal_classes(rows, k + 1), "classes")
    n, asking, longest = classes.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).first()
    if not asking:
        return empty
    longest, share = math.sqrt(longest), min(1.0, SAMPLE / n)
    sample = classes.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select("vector").collect()  # about SAMPLE rows
    fitted = Curves(np.array([r["vector"] for r in sample], np.float64), longest, curves, dimensions)
    placed, places = _places(classes.drop("ids"), fitted, scratch)
    blocks = -(-places // BLOCK)
    around = min(blocks, math.ceil(reach * places * sizes[0]["count"] / n / BLOCK))  # a share of all rows, copies included
    chunks = max(1, math.ceil((2 * around + 1) * BLOCK * asking / places / CHUNK))
    block = F.floor(F.col("place") / BLOCK).cast("int")
    held = placed.where(~F.col("asks")).select("vec_id", "vector", "asks", "curve", block.alias("block"),
                                               F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    asked = placed.where("asks").select(
        "vec_id", "vector", "asks", "curve", F.explode(F.sequence(F.greatest(block - around, F.lit(0)), F.least(block + around, F.lit(blocks - 1)))).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"))

    def search(pdf):
        import pandas as pd

        asks = pdf["asks"].to_numpy()
        q, c = pdf[asks], pdf[~asks]
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": q["vec_id"][:0], "vec_id": c["vec_id"][:0], "score": np.zeros(0)})
        scores = np.stack(q["vector"].to_numpy()) @ np.stack(c["vector"].to_numpy()).T
        qi, ci = q["vec_id"].to_numpy(), c["vec_id"].to_numpy()
        row, col = _best(scores, ci, k + 1)
        return pd.DataFrame({"query_id": qi[row], "vec_id": ci[col], "score": scores[row, col]})

    found = held.unionByName(asked).groupBy("curve", "block", "chunk").applyInPandas(search, f"query_id {kind}, vec_id {kind}, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    near = merged.withColumn("rank", rank).where(F.col("rank") <= k + 1).withColumnsRenamed({"query_id": "__class", "vec_id": "__found"})
    several = classes.where(F.size("ids") > 1).select(F.col("vec_id").alias("__copy"), "ids")
    ids = F.coalesce("ids", F.array("__found"))
    order = F.transform(ids, lambda i: F.struct((-F.col("score")).alias("less"), i.alias("vec_id")))
    listed = (near.join(several, F.col("__found") == F.col("__copy"), "left").groupBy("__class")
              .agg(F.slice(F.sort_array(F.flatten(F.collect_list(order))), 1, k + 1).alias("near")))  # (k + 1)^2 at most are collected
    answers = classes.where("asks").join(listed, F.col("vec_id") == F.col("__class")).select(F.col("vector").alias("__vector"), "near")
    queries = rows.where("asks").select(F.col("vec_id").alias("query_id"), "vector").join(answers, F.col("vector") == F.col("__vector"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return queries.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.less")).alias("score"))


def op4_neighbours(spark, sf_dir):
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % QUERY_EVERY == 0)
