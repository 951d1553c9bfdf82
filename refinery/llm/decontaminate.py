"""Benchmark decontamination with a broadcast set of test n-grams.

Both sides are normalised alike (A-Z lower-cased, words are runs of letters,
digits and non-ASCII characters).  A window is ``n`` consecutive words of a
test item, or all words of a shorter item.  Every document window of these
lengths is hashed and looked up in the set of test-window hashes; a hit is
then verified on its words, and the hit spans or whole documents are removed.

Plan: the distinct test windows are numbered and counted first.  Up to
``MAX_BROADCAST`` bytes of hashes their set is broadcast, and documents are
scanned once, exploded to (length, position, window hash) for all lengths that
windows have, and looked up without a shuffle; beyond that bound Spark
shuffles both sides on the hash, with the same result.  Only numbers are
exploded, no text is copied.  Hits are grouped by document, whose own length
bounds the group, and joined to the documents by (id, text hash) in one
sort-merge join, which Spark splits where it is skewed; there the words of
every hit are compared.  A hit carries its window's number; which items a
window belongs to stays a table of (window, item) rows, to which a document's
distinct windows are joined, so a window that thousands of items share costs
no hit anything.

Defined cases: a null or wordless text has no words and no hits; a wordless
item has no window; rows with the same id and text get the same result, rows
with the same id and other text their own; null ids match each other; a
repeated item id counts once; columns this adds replace input columns of
their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, beside, without

NGRAM = 10
MAX_BROADCAST = 16 << 20
# Fixed value: what stands between words.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before lower-casing, and the words themselves.
SEPARATOR_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_RAW = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Normalised words of a text; none for null."""
    split = F.split(F.translate(text, UPPER, LOWER), SEPARATOR, -1)
    return F.coalesce(F.filter(split, lambda w: w != ""), F.array().cast("array<string>"))


def _starts(size: Column, length: int) -> Column:
    return F.when(size >= length, F.sequence(F.lit(0), size - length)).otherwise(F.array().cast("array<int>"))


def _window_hash(hashes: str, length: int, at: Column) -> Column:
    """Hash of the ``length`` word hashes from 0-based ``at``; element by
    element, since slicing would copy the array for every window."""
    return F.xxhash64(*[F.get(F.col(hashes), at + j) for j in range(length)])


class Windows(NamedTuple):
    """Distinct test windows (``__window``, ``__hash``, ``__length`` and
    ``__gram``, the words, space-joined) and the items of each (``__window``,
    ``__item``, ids as strings)."""

    grams: DataFrame
    members: DataFrame


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", n: int = NGRAM) -> Windows:
    """The windows of all items, written once: their numbers must stay."""
    scratch = Scratch(items.sparkSession, "decontaminate")
    w = items.select(F.col(item_id).cast("string").alias("__item"), words(F.col(text)).alias("__w"))
    w = w.where(F.size("__w") > 0).withColumn("__length", F.least(F.size("__w"), F.lit(n)))
    spans = w.select("__item", "__length", "__w", F.explode(F.sequence(F.lit(1), F.size("__w") - F.col("__length") + 1)).alias("__p"))
    grams = spans.select("__item", "__length", F.expr("slice(__w, __p, __length)").alias("__g"))
    by_length = None
    for length in range(1, n + 1):
        hashed = F.xxhash64(*[F.xxhash64(F.get(F.col("__g"), F.lit(j))) for j in range(length)])
        by_length = F.when(F.col("__length") == length, hashed) if by_length is None else by_length.when(F.col("__length") == length, hashed)
    pairs = scratch.put(grams.select("__item", "__length", by_length.alias("__hash"), F.array_join("__g", " ").alias("__gram")).distinct(), "pairs")
    key = ["__hash", "__length", "__gram"]
    numbered = scratch.put(pairs.select(*key).distinct().withColumn("__window", F.monotonically_increasing_id()), "windows")
    return Windows(numbered, pairs.where(F.col("__item").isNotNull()).join(numbered, key).select("__window", "__item"))


def hashed_hits(docs: DataFrame, grams: DataFrame, doc_id: str, text: str, max_bytes: int = MAX_BROADCAST) -> DataFrame | None:
    """``__id``, ``__text`` (its hash) of documents and ``__start``,
    ``__length``, ``__hash`` of the windows in them whose hash is known."""
    size = grams.agg(F.count(F.lit(1))).first()[0] * 16
    lengths = sorted(r[0] for r in grams.select("__length").distinct().collect())  # at most n numbers
    if not lengths:
        return None
    keyed = docs.select(F.col(doc_id).alias("__id"), F.xxhash64(F.col(text)).alias("__text"),
                        F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("__h"))

    def hashes(length: int) -> Column:
        return F.transform(_starts(F.size("__h"), length), lambda i: _window_hash("__h", length, i))

    every = F.array(*[F.struct(F.lit(length).alias("__length"), hashes(length).alias("__hashes")) for length in lengths])
    windows = keyed.select("__id", "__text", F.inline(every)).select("__id", "__text", "__length", F.posexplode("__hashes").alias("__start", "__hash"))
    known = grams.select("__hash", "__length").distinct()
    return windows.join(F.broadcast(known) if size <= max_bytes else known, ["__hash", "__length"], "left_semi")


def find_hits(docs: DataFrame, windows: Windows, doc_id: str = "doc_id", text: str = "text", max_bytes: int = MAX_BROADCAST,
              count_all: bool = True) -> DataFrame:
    """``docs`` with ``n_words`` and ``hits``: verified (start, length, window
    number) of test windows in the document, word positions from 0.  Without
    ``count_all`` only documents with candidate hits are split into words
    again; ``n_words`` is NULL for the others."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    hits = hashed_hits(docs, windows.grams, doc_id, text, max_bytes)
    columns = without(docs.columns, ("hits", "n_words"))
    out = docs.select(*columns)
    empty = F.array().cast("array<struct<start:int,length:int,window:bigint>>")
    if hits is None:
        return out.withColumn("n_words", F.size(words(F.col(text))).cast("long")).withColumn("hits", empty)
    detailed = hits.distinct().join(windows.grams, ["__hash", "__length"])
    near = scratch.put(
        detailed.groupBy("__id", "__text").agg(F.collect_list(F.struct(
            F.col("__start").alias("start"), F.col("__length").alias("length"),
            F.col("__window").alias("window"), F.col("__gram").alias("gram"))).alias("__hits")), "hits")
    # The same kind of join at every size; what it moves is the documents once.
    on = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__dtext") == F.col("__text"))
    out = out.withColumn("__dtext", F.xxhash64(F.col(text))).join(near.hint("merge"), on, "left")
    out = out.withColumn("__w", words(F.col(text)) if count_all else F.when(F.col("__hits").isNotNull(), words(F.col(text))))
    same = F.filter("__hits", lambda h: F.array_join(F.slice("__w", h["start"] + 1, h["length"]), " ") == h["gram"])
    plain = F.transform(same, lambda h: F.struct(h["start"].alias("start"), h["length"].alias("length"), h["window"].alias("window")))
    n_words = F.when(F.col("__w").isNotNull(), F.size("__w").cast("long"))
    return out.select(*columns, n_words.alias("n_words"), F.coalesce(plain, empty).alias("hits"))


def _covered(hits: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))))


def contamination(found: DataFrame) -> DataFrame:
    """Adds ``n_hit`` (words inside hits) and ``contaminated`` to the result
    of :func:`find_hits`."""
    return found.withColumn("n_hit", F.size(_covered(F.col("hits"))).cast("long")).withColumn("contaminated", F.col("n_hit") > 0)


def with_items(found: DataFrame, windows: Windows) -> DataFrame:
    """``found`` with ``items``, the sorted ids of the items whose windows
    occur in the row.  The rows are written (leave texts out before)."""
    found = Scratch(found.sparkSession, "decontaminate").put(found.withColumn("__row", F.monotonically_increasing_id()), "rows")
    own = found.select("__row", F.explode(F.array_distinct(F.transform("hits", lambda h: h["window"]))).alias("__window"))
    named = own.join(windows.members, "__window").select(F.col("__row").alias("__of"), "__item").distinct()
    listed = named.groupBy("__of").agg(F.sort_array(F.collect_list("__item")).alias("items"))
    out = found.join(listed, F.col("__row") == F.col("__of"), "left")
    return out.select(*found.drop("__row").columns, F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = NGRAM,
                  max_hit_share: float = 0.5) -> DataFrame:
    """``docs`` without contamination, same columns: a document with more
    than ``max_hit_share`` of its words in hits goes; from others the hit
    words go, with what stands between them and the next kept word."""
    def clean(own: DataFrame) -> DataFrame:
        raw = F.filter(F.split(F.col(text), SEPARATOR_RAW, -1), lambda w: w != "")
        pieces = F.transform(raw, lambda w, i: F.when(F.array_contains("__hit", i), F.lit("")).otherwise(
            F.concat(w, F.get(F.col("__gaps"), i + 1))))
        cleaned = F.concat(F.get(F.col("__gaps"), F.lit(0)), F.array_join(pieces, ""))
        found = contamination(find_hits(own, benchmark_windows(items, n=n), doc_id, text, count_all=False))
        found = found.where(~F.col("contaminated") | (F.col("n_hit") <= max_hit_share * F.col("n_words")))
        gaps = F.when(F.col("contaminated"), F.split(F.col(text), WORD_RAW, -1))
        found = found.withColumn("__hit", _covered(F.col("hits"))).withColumn("__gaps", gaps)
        return found.withColumn(text, F.when(F.col("contaminated"), cleaned).otherwise(F.col(text)))

    return beside(docs, ("hits", "n_words", "n_hit", "contaminated"), clean)


def op7_decontaminate(spark, sf_dir):
    windows = benchmark_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = find_hits(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), windows)
    found = with_items(contamination(found.select("doc_id", "n_words", "hits")), windows)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP7_SQL = f"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATOR}'), lambda x: x <> '') AS w FROM documents
), bw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATOR}'), lambda x: x <> '') AS w FROM benchmark
), sized AS (SELECT item_id, w, least(len(w), {NGRAM}) AS n FROM bw WHERE len(w) > 0
), grams AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM sized)
), spans AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)
), hits AS (SELECT doc_id, n, p, item_id FROM spans JOIN grams USING (n, g)
), hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hits)) GROUP BY 1
), found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""
