"""Hot keys: a third of the rows on one foreign key and a third with a NULL
id must not end up in one task.  The key rules put a plain shuffle above their
keyed side, so AQE sees one on both sides and splits the hot partition."""

import pytest
from pyspark.sql import functions as F

from refinery.operators.quality import ForeignKey, UniqueKey, evaluate

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_foreign_key_and_null_ids_are_split(spark, skew_conf):
    n = 90_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.when(F.col("id") % 3 == 1, F.lit("HOT")).otherwise(F.concat(F.lit("p"), (F.col("id") % 500).cast("string"))).alias("fk"))
    parent = spark.range(500).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("pk")).unionByName(
        spark.createDataFrame([("HOT",)], "pk string"))
    tagged = evaluate(df, [UniqueKey("k"), ForeignKey("fk", parent, "pk")]).tagged()
    rows = tagged.collect()
    assert len(rows) == n
    assert sum(r.dq_reason == "null_key" for r in rows) == n // 3
    assert sum(r.dq_reason is None for r in rows) == n - n // 3
    final = tagged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "skew=true" in final, final
