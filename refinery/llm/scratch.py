"""Intermediate tables in the folder the cluster shares.

A :class:`Scratch` owns one folder under ``spark.checkpoint.dir``.  ``put``
writes a frame there as Parquet and reads it back: lineage is cut, a lost
executor re-reads files, and several consumers share one computation.
``drop`` removes a table as soon as nothing reads it any more; whatever the
returned frames still read is removed when the interpreter ends.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Only a single-process local
    session without that setting gets a folder of its own; a cluster without
    it is an error, since a machine's own folder is not shared."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="refinery-llm-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def ship(spark: SparkSession) -> SparkSession:
    """Lets the executors' Python import this package, once per context, and
    bounds the bytes of an Arrow batch."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * BATCH_BYTES))
    if not getattr(context, "_refinery_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="refinery-py-"), "refinery.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
        context._refinery_shipped = True
    return spark


def parts(batches, column: int, nbytes: int = BATCH_BYTES, done=None):
    """The batches cut to about ``nbytes`` of one text or binary column, so
    that a task's Python holds little more than that, or one row.  After the
    last one ``done`` is called and freed memory goes back to the system,
    since the worker stays for later tasks."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = (np.cumsum(sizes) - 1).clip(0) // nbytes
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                yield batch.slice(a, b - a)
    if done:
        done()
    release()


def gathered(batches, column: int, nbytes: int):
    """The batches joined to about ``nbytes`` of one text column."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
            if size >= nbytes:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def release() -> None:
    """Returns freed memory of this process to the system."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def without(columns: list[str], names) -> list[str]:
    """``columns`` but for ``names``, which Spark compares without case."""
    gone = {n.lower() for n in names}
    return [c for c in columns if c.lower() not in gone]


def beside(docs: DataFrame, names, operator) -> DataFrame:
    """``operator(docs)`` cut to the columns of ``docs``, whose own columns
    named like those it adds (``names``) come through unchanged."""
    taken = set(docs.columns) - set(without(docs.columns, names))
    out = operator(docs.withColumnsRenamed({c: f"__own_{c}" for c in taken}))
    return out.select(*[F.col(f"__own_{c}").alias(c) if c in taken else F.col(c) for c in docs.columns])


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
        atexit.register(self.clear)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        if jvm is None:
            return
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def put(self, df: DataFrame, name: str, few: bool = False) -> DataFrame:
        """``few``: a narrow table after a shuffle, written by few tasks to
        spare later jobs tiny files: an eighth of the shuffle partitions, or
        twice the session's cores if that is more.  The rebalance before keeps
        what comes before it at its own number of tasks."""
        if few:
            spark = self.spark
            tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
            df = df.hint("rebalance").coalesce(tasks)
        path = f"{self.root}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.root}/{name}")

    def clear(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                self._delete(self.root)
        except Exception:  # the session has ended; its shared folder goes with the run
            pass
