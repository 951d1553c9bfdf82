"""Substring dedup by level-wise doubling.

A window is ``min_words`` consecutive words.  A window whose word sequence
also starts in a document of smaller id is repeated, and every word it covers
is removed.  The search goes up in lengths, each twice the one before (13, 25
and 50 words): a window repeated at one length alone is extended to the next,
until no candidate survives or the length is reached.

Short levels without touching every window: of the windows of a level's length
inside each full window only the one of least hash is compared.  Equal full
windows have equal least ones at every level, so no repeat is lost, and about
one window in 19 is compared at the first level.  A full window goes on to the
next level only if its least window of this one occurs in several documents;
the documents of those that pass all short levels are read again, and only
full windows over a survivor are hashed and compared, by their smallest
document id.

Plan on Spark: one pass over the texts finds each document's distinct rows of
least hashes, a number per short level.  A level is ``groupBy(hash).agg(min,
max)``, combined map-side, so a passage that a third of all documents share is
one row per task; survivors are written and the rows joined to them on the
hash, where Spark splits skewed partitions.  What returns to a document is a
set of hashes bounded by its own length.  Nothing is compared pairwise and no
group of documents is ever gathered.

Words are hashed to 64 bits and windows to 64 + 32 bits by two polynomials
over them; windows are compared by both, and found again in their document by
the first, so different windows are taken for one only if 64 bits agree.

Defined cases: a null text has no words; a text of any length is read whole, a
batch of its own if it is long; documents shorter than ``min_words``
are kept whole; rows of one id never remove each other's words (no id is
smaller), each row is judged on its own text; a row with a null id removes
nothing and loses nothing; an empty table gives an empty result; columns this
adds replace input columns of their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, parts, ship, without

MIN_WORDS = 50
FIRST = 13
CACHE_WORDS = 300_000
# Odd bases of the two polynomials and the 64-bit finisher.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hash by word, computed once for each word seen."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = WordHashes()


def forget_words() -> None:
    _HASHES.clear()


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def hash_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in one array, and the texts' bounds."""
    if len(_HASHES) > CACHE_WORDS:
        _HASHES.clear()
    bounds = np.cumsum([0] + [len(t) for t in texts])
    flat = np.fromiter((h for t in texts for h in map(_HASHES.__getitem__, t)), np.uint64, int(bounds[-1]))
    return flat, bounds


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def window_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` words, by its start."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    base = BASES[which]
    up, down = _powers(base, n), _powers(pow(base, -1, 1 << 64), n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:n], dtype=np.uint64)])
    h = (sums[length:] - sums[:-length]) * down[: n - length + 1]
    for shift, m in zip((30, 27), MIX):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(m)
    return h ^ (h >> np.uint64(31))


def _sliding(a: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) over each run of ``width`` entries."""
    done = 1
    while 2 * done <= width:
        a = best(a[: len(a) - done], a[done:])
        done *= 2
    rest = width - done
    return best(a[: len(a) - rest], a[rest:]) if rest else a


def level_lengths(length: int, first: int = FIRST) -> list[int]:
    """Window lengths of the levels: doubled (rounded up) to ``length``, from
    ``first`` words or less; one short level at least."""
    out = [length]
    while out[0] > first or len(out) == 1:
        out.insert(0, -(-out[0] // 2))
    return out


def least_windows(words: np.ndarray, width: int, length: int) -> np.ndarray:
    """By the start of each full window of ``length`` words: the least hash of
    the windows of ``width`` words in it."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    return _sliding(window_hashes(words, width), length - width + 1, np.minimum)


def describe(docs: DataFrame, doc_id: str, text: str, length: int, first: int = FIRST) -> DataFrame:
    """``doc_id``, ``n_words``, ``sha256`` (of the words, space-joined) and
    ``least`` (the distinct rows of least hashes, ``k0`` and so on by short
    level) of every document."""
    ship(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    widths = level_lengths(length, first)[:-1]
    names = [f"k{i}" for i in range(len(widths))]

    def run(batches):
        for batch in parts(batches, 1, done=forget_words):
            texts = [split_words(t) for t in batch.column(1).to_pylist()]
            words, bounds = hash_words(texts)
            every = np.stack([least_windows(words, w, length).view(np.int64) for w in widths])
            moves = np.ones(every.shape[1], bool)
            moves[1:] = (every[:, 1:] != every[:, :-1]).any(0)
            found = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = slice(a, max(a, b - length + 1))
                rows = every[:, own]
                rows = rows[:, moves[own] | (np.arange(rows.shape[1]) == 0)]
                rows = rows[:, np.lexsort(rows)]
                fresh = np.ones(rows.shape[1], bool)
                fresh[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
                found.append(rows[:, fresh])
            offsets = pa.array(np.cumsum([0] + [f.shape[1] for f in found]), pa.int32())
            flat = np.concatenate(found, 1) if found else every[:, :0]
            least = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(f) for f in flat], names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(t)).hexdigest() for t in texts]), least],
                ["doc_id", "n_words", "sha256", "least"])

    fields = ",".join(f"{n}:bigint" for n in names)
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, f"doc_id {kind}, n_words long, sha256 string, least array<struct<{fields}>>")


def _windows(rows: DataFrame, width: int, length: int) -> DataFrame:
    """Full windows over survivors of the last short level (of ``width``
    words): ``doc_id`` and arrays ``h``, ``g`` (the hashes) and ``free`` (no
    smaller document holds that survivor)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in parts(batches, 1, done=forget_words):
            texts = [split_words(t) for t in batch.column(1).to_pylist()]
            words, bounds = hash_words(texts)
            least = least_windows(words, width, length)
            h, g = window_hashes(words, length), window_hashes(words, length, 1)
            least, h, g = least.view(np.int64), h.view(np.int64), g.astype(np.uint32).view(np.int32)
            out = []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                live = np.array(batch.column(2)[i].as_py(), np.int64)
                own = np.array(batch.column(3)[i].as_py(), np.int64)
                span = slice(a, max(a, b - length + 1))
                at = np.flatnonzero(np.isin(least[span], live)) + a
                _, first = np.unique(h[at], return_index=True)
                at = at[first]
                out.append((h[at], g[at], np.isin(least[at], own)))
            offsets = pa.array(np.cumsum([0] + [len(o[0]) for o in out]), pa.int32())
            flat = [np.concatenate([o[k] for o in out]) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.ListArray.from_arrays(offsets, pa.array(f)) for f in flat]], ["doc_id", "h", "g", "free"])

    return rows.select("doc_id", "text", "live", "own").mapInArrow(run, f"doc_id {kind}, h array<long>, g array<int>, free array<boolean>")


def _repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """Values that several documents hold, with the smallest id."""
    found = rows.groupBy(*by).agg(F.min("doc_id").alias("__first"), F.max("doc_id").alias("__last"))
    return found.where(F.col("__first") < F.col("__last")).select(*[F.col(c).alias(f"__{c}") for c in by], "__first")


def repeated_windows(docs: DataFrame, described: DataFrame, doc_id: str, text: str, length: int,
                     scratch: Scratch, first: int = FIRST) -> tuple[DataFrame, DataFrame] | None:
    """The documents that hold a candidate of the last level (``doc_id``,
    ``text``), and by ``doc_id`` the hashes ``gone`` of the windows to remove;
    None when no candidate survives a short level."""
    widths = level_lengths(length, first)[:-1]
    rows = described.where(F.col("doc_id").isNotNull()).select("doc_id", F.inline("least"))
    for i in range(len(widths)):
        shared = scratch.put(_repeated(rows, [f"k{i}"]), f"level{i}")
        if shared.isEmpty():
            return None
        rows = rows.join(shared, F.col(f"k{i}") == F.col(f"__k{i}"))
        if i + 1 < len(widths):  # what survives is extended to the next length
            rows = scratch.put(rows.select("doc_id", *[f"k{j}" for j in range(i + 1, len(widths))]), f"rows{i}")
            scratch.drop(f"level{i}", f"rows{i - 1}")
    last = f"k{len(widths) - 1}"
    live = rows.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_set(last).alias("live"), F.collect_set(F.when(F.col("__first") == F.col("doc_id"), F.col(last))).alias("own"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    matched = scratch.put(texts.join(live, F.col("doc_id") == F.col("__id")).drop("__id"), "matched")
    scratch.drop(f"level{len(widths) - 1}", f"rows{len(widths) - 2}")
    windows = scratch.put(_windows(matched, widths[-1], length), "windows")
    each = windows.select("doc_id", F.explode(F.arrays_zip("h", "g", "free")).alias("w")).select("doc_id", "w.h", "w.g", "w.free")
    twice = scratch.put(_repeated(each, ["h", "g"]), "repeated")
    gone = (
        each.where(~F.col("free"))
        .join(twice, (F.col("h") == F.col("__h")) & (F.col("g") == F.col("__g")) & (F.col("doc_id") > F.col("__first")))
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.collect_set("h").alias("gone"))
    )
    gone = scratch.put(gone, "gone")
    scratch.drop("windows", "repeated")
    return matched, gone


def keep_mask(words: np.ndarray, length: int, gone: np.ndarray) -> np.ndarray:
    """False for the words covered by a window whose hash is in ``gone``."""
    starts = np.flatnonzero(np.isin(window_hashes(words, length).view(np.int64), gone))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) == 0


def _kept(words: list[bytes], gone, length: int) -> list[bytes]:
    if gone is None or not len(gone):
        return words
    keep = keep_mask(hash_words([words])[0], length, np.array(gone, np.int64))
    return [w for w, k in zip(words, keep.tolist()) if k]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                   first: int = FIRST) -> DataFrame:
    """``docs`` whose ``text`` lost its repeated windows (a changed text is its
    kept words joined by one space), plus ``n_words`` and ``n_removed``."""
    scratch = Scratch(docs.sparkSession, "substrings")
    described = scratch.put(describe(docs, doc_id, text, min_words, first), "described")
    found = repeated_windows(docs, described, doc_id, text, min_words, scratch, first)
    columns = without(docs.columns, ("n_words", "n_removed"))
    gone = found[1] if found else docs.sparkSession.createDataFrame([], f"__id {docs.schema[doc_id].dataType.simpleString()}, gone array<long>")
    joined = docs.select(*columns).join(gone, F.col(doc_id) == F.col("__id"), "left").drop("__id")
    at = columns.index(text)

    def run(batches):
        for batch in parts(batches, at, done=forget_words):
            old = batch.column(at).to_pylist()
            words = [split_words(t) for t in old]
            kept = [_kept(w, g, min_words) for w, g in zip(words, batch.column(len(columns)).to_pylist())]
            new = [t if len(k) == len(w) else b" ".join(k).decode("utf-8", "replace") for t, w, k in zip(old, words, kept)]
            cols = [batch.column(i) for i in range(len(columns))]
            cols[at] = pa.array(new, pa.string())
            counts = [pa.array([len(w) for w in words], pa.int64()), pa.array([len(w) - len(k) for w, k in zip(words, kept)], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + counts, [*columns, "n_words", "n_removed"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    return joined.mapInArrow(run, ", ".join([*fields, "n_words long, n_removed long"]))


def removal_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                    first: int = FIRST) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of what
    :func:`remove_repeats` keeps; only texts that lose words move again."""
    scratch = Scratch(docs.sparkSession, "substrings")
    described = scratch.put(describe(docs, doc_id, text, min_words, first), "described")
    found = repeated_windows(docs, described, doc_id, text, min_words, scratch, first)
    whole = described.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha256").alias("kept_sha256"))
    if found is None:
        return whole
    matched, gone = found
    kind = described.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in parts(batches, 1, done=forget_words):
            words = [split_words(t) for t in batch.column(1).to_pylist()]
            kept = [_kept(w, g, min_words) for w, g in zip(words, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([len(w) - len(k) for w, k in zip(words, kept)], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for k in kept])], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    changed = matched.select("doc_id", "text").join(gone, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "gone").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
    rest = whole.join(gone.select("__id"), F.col("doc_id") == F.col("__id"), "left_anti")
    return rest.unionByName(changed)


def op2_repeated_spans(spark, sf_dir):
    return removal_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(w[p : p + {MIN_WORDS - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {MIN_WORDS - 2})) AS p FROM d WHERE len(w) >= {MIN_WORDS})
), gone AS (
  SELECT DISTINCT doc_id, p + j AS q FROM win JOIN (SELECT g, min(doc_id) AS first FROM win GROUP BY g) f USING (g), range(0, {MIN_WORDS}) r(j)
  WHERE doc_id > first
), words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS t FROM words LEFT JOIN gone g USING (doc_id, q) WHERE g.q IS NULL GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
