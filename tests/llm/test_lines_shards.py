import hashlib
from collections import Counter, defaultdict

import pytest
from frames import documents
from pyspark.sql import functions as F

from refinery.llm import line_dedup, sharding


def test_boilerplate_lines_against_plain_python(spark):
    rows = []
    for i in range(40):
        lines = [f"body {i}", "  menu " if i % 2 else "menu", "", f"half {i % 2}"]
        rows.append((i, "\n".join(lines), "h1" if i < 30 else "h2"))
    rows += [(99, None, "h1"), (98, "", None), (97, "menu", None), (5, rows[5][1], "h1")]
    df = spark.createDataFrame(rows, "page long, body string, host string").withColumn("n_lines", F.lit("clash"))
    got = sorted(((r["page"], r["body"], r["n_lines"], r["n_removed"]) for r in
                  line_dedup.drop_boilerplate(df, "host", "body", 0.6, 3).collect()), key=str)
    with_line, pages = Counter(), Counter(h for _, _, h in rows)
    for _, t, h in rows:
        with_line.update((h, x) for x in {y.strip() for y in (t.split("\n") if t is not None else [])} if x)
    bad = {k for k, c in with_line.items() if c >= 3 and c > 0.6 * pages[k[0]]}
    want = []
    for p, t, h in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for x in lines if (h, x.strip()) not in bad]
        want.append((p, "\n".join(kept) if t is not None else None, len(lines), len(lines) - len(kept)))
    assert bad == {("h1", "menu"), ("h2", "menu")}
    assert got == sorted(want, key=str)


def test_line_dedup_edge_rows(spark):
    df = documents(spark)
    out = line_dedup.drop_boilerplate(df)
    assert out.count() == df.count() and set(df.columns) <= set(out.columns)
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def directory(rows, limit):
    """Extendible hashing by plain recursion: (id, bytes) to shard bits."""
    key = lambda i: format(int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16), "060b")
    out = {}

    def fill(prefix, members):
        if sum(n for _, n in members) <= limit or len(prefix) == 60:
            for i, _ in members:
                out[i] = prefix
        else:
            for bit in "01":
                fill(prefix + bit, [m for m in members if key(m[0])[len(prefix)] == bit])

    fill("", rows)
    return out


def test_shards_are_the_extendible_directory(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"))
    for limit in (1 << 30, 20_000, 700):
        got = {r["doc_id"]: r["shard_id"] for r in sharding.assign_shards(df, max_bytes=limit).collect()}
        assert got == directory([(i, i % 90) for i in range(3000)], limit)


def test_shards_split_one_hot_key_and_set_large_rows_apart(spark):
    hot = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("y" * 50).alias("text"), F.col("id").alias("shard_id"))
    rest = spark.createDataFrame([(None, "z", 1), (8, None, 2), (9, "", 3), (10, "b" * 5000, 4)], "doc_id long, text string, shard_id long")
    out = sharding.assign_shards(hot.unionByName(rest), max_bytes=2000).collect()
    assert len(out) == 4004
    total = defaultdict(int)
    for r in out:
        total[r["shard_id"]] += r["shard_row_bytes"]
    big = [s for s, n in total.items() if n > 2000]
    assert len(big) == 1 and big[0].startswith("big-") and total[big[0]] == 5000
    bits = sorted(s for s in total if not s.startswith("big-"))
    assert all(not b.startswith(a) for a, b in zip(bits, bits[1:]))


def test_shards_of_an_empty_table_and_clashing_columns(spark):
    df = documents(spark)
    assert sharding.assign_shards(df.limit(0)).count() == 0
    assert sharding.assign_shards(df).count() == df.count()
    with pytest.raises(ValueError):
        sharding.assign_shards(df, step=7)


def test_written_shards_hold_every_row(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.lit(40)).alias("text"))
    sharding.write_shards(sharding.assign_shards(df, max_bytes=1000), f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == 500
