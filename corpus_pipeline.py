"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.  :func:`run`
writes every stage's result to the shared folder and reads it again.

1. language ID: documents without a determinable language go; a missing label
   is filled with the prediction.
2. line dedup: lines on more than a tenth of a source's documents go.
3. near-dedup: one document (the smallest id) of each near-duplicate group
   stays, and one row of each id: five-word shingles, similarity 0.8 or more.
4. decontamination: documents mostly made of benchmark text go, from others
   the benchmark spans go.
5. packing: what is left is tokenised and packed into 4096-token sequences.

``n_chars`` follows the text.  No SQL can express the whole (EM, the
similarity join and the packing order), so ``ORACLE_SQL`` is None and
``tests/llm/test_pipeline.py`` holds the stages against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import language
from refinery.llm import line_dedup as lines
from refinery.llm.decontaminate import decontaminate
from refinery.llm.near_dups import components
from refinery.llm.packing import default_tokenizer, pack
from refinery.llm.scratch import Scratch, beside

NEAR_PERCENT = 80
ORACLE_SQL = None


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def known(own: DataFrame) -> DataFrame:
        found = language.identify(own).where(F.col("lang_pred") != language.UNDETERMINED)
        return found.withColumn("lang", F.coalesce("lang", "lang_pred"))

    return beside(docs, language.ADDED, known)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(beside(docs, lines.ADDED, lines.drop_boilerplate), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dropped = components(docs, percent=NEAR_PERCENT).where(~F.col("kept")).select(F.col("doc_id").alias("__gone"))
    left = docs.join(dropped, F.col("doc_id") == F.col("__gone"), "left_anti")
    # Rows of one id are one document: the one of least text stays (a null id is no id).
    several = docs.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__several")).count().where("count > 1").select("__several")
    of = F.col("doc_id") == F.col("__several")
    one = F.min_by(F.struct(*docs.columns), F.struct("text", "source", "lang")).alias("__row")
    single = left.join(several, of, "left_semi").groupBy(F.col("doc_id").alias("__id")).agg(one).select("__row.*")
    return left.join(several, of, "left_anti").unionByName(single)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, default_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontamination),
    ("pack", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents`` of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        if k > 1:
            scratch.drop(STAGES[k - 1][0])
    return docs
