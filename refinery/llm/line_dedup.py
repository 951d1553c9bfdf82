"""Line dedup by site-relative frequency.

A line is boilerplate for a host when it stands on more than ``max_ratio`` of
that host's pages (and on at least ``min_pages`` of them, 2 by default: one
page cannot repeat a line, and a host of one page keeps all); boilerplate
lines are dropped from every page of the host, wherever they stand.

Plan: one pass turns each page into its distinct trimmed lines' 64-bit keys;
``groupBy(host, key)`` combines map-side, so a line on a third of all pages
leaves each task as one row.  Only keys over the ratio remain, as one array
per host: with p pages of m distinct lines on average, fewer than
m / max_ratio keys can pass, whatever p is.  That table is written, joined to
the pages on the host (Spark broadcasts it when its files are small, or
splits the skewed partitions of a sort-merge join), and the lines are
filtered in place.  Texts are never regrouped.

Defined cases: a null text stays null with no lines; an empty text has one
blank line; a text of any length is taken whole; blank lines are never counted or dropped; a null host is a host
of its own; copies of a page are pages of their own, ids are not used;
``n_lines`` and ``n_removed`` replace input columns of these names.  Two
lines of one host are taken for one only when their 64-bit hashes collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, without

BLANK = " \t\r\f\x0b"
MAX_RATIO = 0.1
MIN_PAGES = 2
ADDED = ("n_lines", "n_removed")


def _lines(text: Column) -> Column:
    return F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def boilerplate(pages: DataFrame, host: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """One row per host that has boilerplate: ``__host`` and ``__keys``, the
    hashes of its boilerplate lines."""
    distinct = F.array_distinct(F.filter(F.transform(_lines(F.col(text)), _trimmed), lambda x: x != ""))
    counts = (
        pages.select(F.col(host).alias("__host"), F.explode(distinct).alias("__line"))
        .groupBy("__host", F.xxhash64("__line").alias("__key"))
        .agg(F.count(F.lit(1)).alias("__with"))
        .where(F.col("__with") >= min_pages)
    )
    totals = pages.groupBy(F.col(host).alias("__of")).agg(F.count(F.lit(1)).alias("__pages"))
    return (
        counts.join(totals, F.col("__host").eqNullSafe(F.col("__of")))
        .where(F.col("__with") > F.lit(max_ratio) * F.col("__pages"))
        .groupBy("__host")
        .agg(F.collect_list("__key").alias("__keys"))
    )


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with ``text`` freed of its host's boilerplate lines, plus
    ``n_lines`` (lines before) and ``n_removed``."""
    scratch = Scratch(pages.sparkSession, "lines")
    found = scratch.put(boilerplate(pages, host, text, max_ratio, min_pages), "boilerplate")
    kept_columns = without(pages.columns, ADDED)
    joined = pages.select(*kept_columns).join(found, F.col(host).eqNullSafe(F.col("__host")), "left")
    lines = _lines(F.col(text))
    kept = F.when(F.col("__keys").isNull(), lines).otherwise(
        F.filter(lines, lambda x: (_trimmed(x) == "") | ~F.array_contains(F.col("__keys"), F.xxhash64(_trimmed(x)))))
    return (
        joined.withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("__kept", kept)
        .withColumn("n_removed", F.col("n_lines") - F.size("__kept"))
        .withColumn(text, F.when(F.col(text).isNotNull(), F.array_join("__kept", "\n")))
        .select(*kept_columns, "n_lines", "n_removed")
    )


def op10_site_lines(spark, sf_dir):
    out = drop_boilerplate(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "source", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("text_sha256"))


OP10_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, i, l, trim(l, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS k
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS l,
               unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
), totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source
), boiler AS (
  SELECT source, k FROM (SELECT DISTINCT doc_id, source, k FROM lines WHERE k <> '') JOIN totals USING (source)
  GROUP BY source, k, pages HAVING count(*) >= {MIN_PAGES} AND count(*) > {MAX_RATIO} * pages
)
SELECT doc_id, source, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(b.k) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN b.k IS NULL THEN l END, chr(10) ORDER BY i), '')) AS text_sha256
FROM lines LEFT JOIN boiler b USING (source, k) GROUP BY doc_id, source
"""
