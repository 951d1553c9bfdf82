"""MinHash near-dedup as a chosen-path set similarity join.

A document's set is its distinct ``shingle``-word shingles.  Documents whose
sets have 100 * |intersection| >= ``percent`` * |union| are linked; components
of links are near-duplicate groups, and the smallest id of each is kept.

Method.  Documents of equal sets are one class, represented by its smallest
id.  In each of ``TREES`` independent trees a class goes down from the root
to the node of its minwise token under a function that the node selects; two
sets of Jaccard J take the same child with probability J.  Nodes of at most
``SMALL`` classes are compared exhaustively on their minwise values.  Larger
nodes branch on: each class by one selected token, at every fourth node by
two, which is 1.25 children on average, so the expected number of nodes that
a linked pair shares does not fall with depth.  From level ``DENSE_FROM`` on,
nodes of at most ``DENSE`` classes are clouds of similar texts and are
compared exhaustively on their full sets; larger ones branch to ``DEPTH`` and
are then compared exhaustively in pairs of blocks, so no pair of a node is
left out.  A pair at Jaccard 0.85 misses all first-level nodes with
probability 0.15^8 < 3e-7; one whose nodes stay large must survive branching
too, and if only level ``DEPTH`` compares it, it is missed with 0.8 % (5.3 %
at 0.8; trees and choices taken as independent).  Candidates from minwise
values (estimated similarity within 0.25, five standard deviations, of the
threshold) are confirmed on the full sets.

Large first-level nodes also link their members to the smallest one, which
joins most near copies of one text at once.  From then on a node whose
classes are in one component has nothing to add and is dropped, and a cloud
compares only classes outside its largest component with all others.

Plan on Spark: one pass computes set digests and ``FUNCTIONS`` minwise values
per document; all tree work moves (node, class) rows and 256 bytes of minwise
values.  Texts move once, and only of classes that have a candidate partner;
from there to the comparisons.  Full sets are compared inside a task as
products of incidence matrices, column block by column block, and a task
returns a spanning set of its links.  Components come from minimum labels
with pointer jumping on written tables; no links or labels reach the driver,
only counts.

Defined cases: a text without words (or null) has an empty set and is linked
with nothing; a text of any length is taken whole; fewer words than ``shingle`` are one shingle, all of them; rows
of one id are one document (its rows' links all count); a row with a null id
is linked with nothing, has a null component and is kept; an empty table
gives an empty result; added columns replace input columns of their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, parts, ship
from refinery.llm.substrings import forget_words, hash_words, window_hashes

SHINGLE = 5
PERCENT = 85
TREES = 8
FUNCTIONS = 64
SMALL = 40
DENSE = 2048
CLOUD_BYTES = 16 << 20
DENSE_FROM = 2
DEPTH = 10
BLOCK = 1024
MARGIN = 0.25
COLUMNS = 4096


def lower_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased words between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_sets(texts: list[list[bytes]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the texts' bounds."""
    words, bounds = hash_words(texts)
    hashes = window_hashes(words, length)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= length:
            sets.append(np.unique(hashes[a : b - length + 1]))
        else:
            sets.append(window_hashes(words[a:b], b - a) if b > a else hashes[:0])
    return np.concatenate(sets) if sets else hashes[:0], np.cumsum([0] + [len(s) for s in sets])


def _seeds(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minwise(sets: np.ndarray, bounds: np.ndarray, functions: int = FUNCTIONS) -> np.ndarray:
    """Minwise values (upper 32 bits), a row per text; zeros for empty sets."""
    out = np.zeros((len(bounds) - 1, functions), np.int32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for f, (a, b) in enumerate(zip(*_seeds(functions, 20240917))):
            x = sets ^ b
            x *= a
            x ^= x >> np.uint64(29)
            x *= a
            out[full, f] = (np.minimum.reduceat(x, bounds[:-1][full]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def describe(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, set digest ``d1``, ``d2``, and ``mins``."""
    ship(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in parts(batches, 1, done=forget_words):
            sets, bounds = shingle_sets([lower_words(t) for t in batch.column(1).to_pylist()], shingle)
            digests = []
            for a, b in zip(*_seeds(2, 7)):
                x = (sets ^ b) * a
                x = (x ^ (x >> np.uint64(31))) * a
                digests.append(np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])[bounds]).view(np.int64))
            mins = minwise(sets, bounds)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, mins.size + 1, mins.shape[1], dtype=np.int32)), pa.array(mins.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds).astype(np.int64)), pa.array(digests[0]), pa.array(digests[1]), lists],
                ["doc_id", "n_shingles", "d1", "d2", "mins"])

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, f"doc_id {kind}, n_shingles long, d1 long, d2 long, mins array<int>")


def _pairs_in(nodes: DataFrame, loose: float) -> DataFrame:
    """Candidate pairs (a < b) inside small nodes given as array columns;
    ``first`` marks each b's smallest partner.  Pairs in one component go."""
    kind = nodes.schema["reps"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            reps, labels, flat = (batch.column(i) for i in range(3))
            out = ([], [], [])
            for i in range(batch.num_rows):
                r = np.array(reps[i].as_py())
                order = np.argsort(r, kind="stable")
                m = flat[i].values.flatten().to_numpy().reshape(len(r), -1)[order]
                r, of = r[order], np.array(labels[i].as_py())[order]
                near = np.triu((m[:, None, :] == m[None, :, :]).mean(2) >= loose, 1) & (of[:, None] != of[None, :])
                a, b = np.nonzero(near)
                seen = np.argmax(near, 0)
                out[0].extend(r[a].tolist())
                out[1].extend(r[b].tolist())
                out[2].extend((seen[b] == a).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], reps.type.value_type), pa.array(out[1], reps.type.value_type), pa.array(out[2], pa.bool_())],
                                             ["a", "b", "first"])

    return nodes.select("reps", "labels", "mins").mapInArrow(run, f"a {kind}, b {kind}, first boolean")


def _estimated(pairs: DataFrame, classes: DataFrame, loose: float) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is at least ``loose``."""
    left = classes.select(F.col("rep").alias("a"), F.col("mins").alias("__ma")).hint("merge")
    right = classes.select(F.col("rep").alias("b"), F.col("mins").alias("__mb")).hint("merge")
    agree = F.aggregate(F.zip_with("__ma", "__mb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.join(left, "a").join(right, "b").where(agree >= loose * F.size("__ma")).select("a", "b")


def _confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full sets meet the threshold."""
    kind = pairs.schema["a"].dataType.simpleString()
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("__ta")).hint("merge")
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("__tb")).hint("merge")

    def run(batches):
        for batch in parts(batches, 2, done=forget_words):
            ta, tb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            new = list(dict.fromkeys(ta + tb))
            sets, bounds = shingle_sets([lower_words(t) for t in new], shingle)
            known = {t: sets[bounds[k] : bounds[k + 1]] for k, t in enumerate(new)}
            ok = []
            for a, b in zip(ta, tb):
                x, y = known[a], known[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "__ta", "__tb")
    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def common_counts(left: np.ndarray, left_of: np.ndarray, right: np.ndarray, right_of: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Sizes of the intersections of two families of sets, given as hashes
    and the set of each: products of incidence matrices, some columns at once."""
    shared = np.intersect1d(left, right)
    out = np.zeros(shape, np.float32)
    for at in range(0, len(shared), COLUMNS):
        some = shared[at : at + COLUMNS]
        sides = []
        for h, of, n in ((left, left_of, shape[0]), (right, right_of, shape[1])):
            place = np.searchsorted(some, h).clip(0, len(some) - 1)
            hit = some[place] == h
            m = np.zeros((n, len(some)), np.float32)
            m[of[hit], place[hit]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def spanning_links(reps: np.ndarray, asks: np.ndarray, texts: list, shingle: int, percent: int) -> list[tuple]:
    """Links between the sets that ask and all others, enough to connect what
    they connect."""
    sets, bounds = shingle_sets([lower_words(t) for t in texts], shingle)
    size = np.diff(bounds)
    of = np.repeat(np.arange(len(reps)), size)
    rows = np.flatnonzero(asks)
    place = np.full(len(reps), -1)
    place[rows] = np.arange(len(rows))
    mine = place[of] >= 0
    both = common_counts(sets[mine], place[of[mine]], sets, of, (len(rows), len(reps)))
    linked = (both > 0) & (100 * both >= percent * (size[rows][:, None] + size[None, :] - both))
    group, out = list(range(len(reps))), []

    def root(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for r, c in zip(*np.nonzero(linked)):
        i, j = root(int(rows[r])), root(int(c))
        if i != j:
            group[max(i, j)] = min(i, j)
            a, b = reps[rows[r]], reps[c]
            out.append((min(a, b), max(a, b)))
    return out


def _clouds(rows: DataFrame, labels: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links inside clouds, rows (key, rep): every class outside its cloud's
    largest component against all classes, on full sets; clouds of more than
    ``DENSE`` classes or ``CLOUD_BYTES`` of text in pairs of blocks."""
    kind = rows.schema["rep"].dataType.simpleString()
    rows = rows.join(labels, "rep").join(texts.select("rep", F.octet_length("text").cast("long").alias("bytes")), "rep")
    size = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("bytes").alias("bytes"))
    largest = size.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("n"), F.sum("bytes").alias("all_bytes"),
                                      F.count(F.lit(1)).alias("k"))
    rows = rows.join(largest.where("k > 1"), "key")
    by_number = F.when(F.col("n") <= DENSE, F.lit(1)).otherwise(F.ceil(F.col("n") / BLOCK))
    blocks = F.greatest(by_number, F.ceil(F.col("all_bytes") / CLOUD_BYTES)).cast("int")
    rows = rows.select("key", "rep", (F.col("label") != F.col("main")).alias("asks"), blocks.alias("blocks"),
                       F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("mine"))
    # Block x asks block y: a class goes to its own row of pairs as asker and to its column as asked.
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asking = rows.where("asks").select("key", "rep", "asks", F.col("mine").alias("x"), others.alias("y"))
    asked = rows.select("key", "rep", F.lit(False).alias("asks"), others.alias("x"), F.col("mine").alias("y"))
    dealt = asking.unionByName(asked).groupBy("key", "x", "y", "rep").agg(F.bool_or("asks").alias("asks"))

    def compare(pdf):
        import pandas as pd

        links = spanning_links(pdf["rep"].to_numpy(), pdf["asks"].to_numpy(), pdf["text"].tolist(), shingle, percent) if pdf["asks"].any() else []
        forget_words()
        return pd.DataFrame({"a": pd.Series([a for a, _ in links], dtype=pdf["rep"].dtype), "b": pd.Series([b for _, b in links], dtype=pdf["rep"].dtype)})

    held = dealt.join(texts.hint("merge"), "rep").select("key", "x", "y", "rep", "asks", "text")
    return held.groupBy("key", "x", "y").applyInPandas(compare, f"a {kind}, b {kind}").distinct()


def merge_labels(labels: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``labels`` (rep, label: the smallest rep of its component) after adding
    ``links`` (a, b): minimum labels over links of components, then pointer
    jumping, until nothing changes."""
    ends = links.join(labels.select(F.col("rep").alias("a"), F.col("label").alias("la")), "a").join(
        labels.select(F.col("rep").alias("b"), F.col("label").alias("lb")), "b").where("la <> lb")
    both = ends.select(F.inline(F.array(F.struct(F.col("la").alias("v"), F.col("lb").alias("w")), F.struct(F.col("lb").alias("v"), F.col("la").alias("w")))))
    edges = scratch.put(both.distinct(), f"{name}-edges", few=True)
    if edges.isEmpty():
        return labels
    now = scratch.put(edges.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("to")), f"{name}-0", few=True)
    step = 0
    while True:
        step += 1
        told = edges.join(now.select(F.col("v").alias("w"), "to"), "w").groupBy("v").agg(F.min("to").alias("told"))
        near = now.join(told, "v").select("v", F.least("to", "told").alias("near"), F.col("to").alias("was"))
        jump = now.select(F.col("v").alias("near"), F.col("to").alias("next"))
        new = near.join(jump, "near").select("v", F.least("near", "next").alias("to"), "was")
        new = scratch.put(new, f"{name}-{step}", few=True)
        now = new.select("v", "to")
        if new.where("to <> was").isEmpty():
            break
    moved = labels.join(now.select(F.col("v").alias("label"), "to"), "label", "left")
    merged = scratch.put(moved.select("rep", F.coalesce("to", "label").alias("label")), f"{name}-labels", few=True)
    scratch.drop(f"{name}-edges", *[f"{name}-{k}" for k in range(step + 1)])
    return merged


def _open_rows(rows: DataFrame) -> DataFrame:
    """Rows (key, rep, label) of nodes that hold several components, with
    ``n`` (classes in the node) and ``pivot`` (its smallest class)."""
    nodes = rows.groupBy(F.col("key").alias("__k")).agg(
        F.count(F.lit(1)).alias("n"), F.min("rep").alias("pivot"), F.min("label").alias("__l0"), F.max("label").alias("__l1"))
    nodes = nodes.where(F.col("__l0") < F.col("__l1")).select("__k", "n", "pivot")
    return rows.join(nodes.hint("rebalance"), F.col("key") == F.col("__k")).drop("__k")


def _small_pairs(rows: DataFrame, classes: DataFrame, loose: float) -> DataFrame:
    nodes = rows.where(F.col("n") <= SMALL).join(classes.hint("merge"), "rep").groupBy("key").agg(
        F.collect_list("rep").alias("reps"), F.collect_list("label").alias("labels"), F.collect_list("mins").alias("mins"))
    return _pairs_in(nodes, loose)


def _branch(rows: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """The next level of the nodes that hold several components: each class
    to the child of its minwise token under the function (two at every fourth
    node) that the node's number selects.  Rows (rep, key, label)."""
    of = rows.join(labels, "rep")
    apart = of.groupBy(F.col("key").alias("__k")).agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("__k")
    rows = of.join(apart.hint("rebalance"), F.col("key") == F.col("__k")).drop("__k")
    twice = F.when(F.pmod(F.xxhash64("key"), F.lit(4)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.join(classes.hint("merge"), "rep").select("rep", "key", "label", "mins", F.explode(twice).alias("child"))
    which = (F.lit(TREES) + F.pmod(F.xxhash64("key", "child"), F.lit(FUNCTIONS - TREES))).cast("int")
    return rows.select("rep", F.xxhash64("key", "child", F.get("mins", which)).alias("key"), "label").distinct()


def _still_apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    of_a = labels.select(F.col("rep").alias("a"), F.col("label").alias("la"))
    of_b = labels.select(F.col("rep").alias("b"), F.col("label").alias("lb"))
    return pairs.join(of_a, "a").join(of_b, "b").where("la <> lb").select("a", "b")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``,
    ``component_id`` and ``kept``."""
    scratch, loose = Scratch(docs.sparkSession, "neardups"), percent / 100 - MARGIN
    described = scratch.put(describe(docs, doc_id, text, shingle), "described")
    full = described.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    reps = scratch.put(full.groupBy(F.col("d1").alias("__d1"), F.col("d2").alias("__d2")).agg(F.min("doc_id").alias("rep")), "reps")
    same = (F.col("d1") == F.col("__d1")) & (F.col("d2") == F.col("__d2"))
    members = full.join(reps, same)
    classes = scratch.put(members.where(F.col("doc_id") == F.col("rep")).dropDuplicates(["rep", "d1", "d2"]).select("rep", "mins"), "classes")
    labels = classes.select("rep", F.col("rep").alias("label")).distinct()
    # Rows of one id with different texts are one document.
    several = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("__b")).where("a < __b").select(F.col("doc_id").alias("__id"), "a")
    same_id = members.join(several, F.col("doc_id") == F.col("__id")).where("a < rep").select("a", F.col("rep").alias("b")).distinct()

    # First level: all trees; large nodes link their members to the smallest.
    rows = classes.select("rep", F.posexplode(F.slice("mins", 1, TREES)).alias("tree", "least"))
    rows = _open_rows(rows.select("rep", F.xxhash64("tree", "least").alias("key"), F.col("rep").alias("label")))
    rows = scratch.put(rows, "level1", few=True)
    large = rows.where(F.col("n") > SMALL)
    stars = _estimated(large.where("pivot < rep").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), classes, loose)
    found = _small_pairs(rows, classes, loose).unionByName(stars.withColumn("first", F.lit(True)))
    every = scratch.put(found.groupBy("a", "b").agg(F.max("first").alias("first")), "pairs1", few=True)

    # Texts of all classes that can still be compared, and the links that connect most.
    asked = every.select(F.col("a").alias("rep")).union(every.select(F.col("b").alias("rep"))).union(large.select("rep")).distinct()
    chosen = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).join(asked.hint("merge"), F.col("__id") == F.col("rep"))
    texts = scratch.put(chosen.select("rep", "text"), "texts")
    links = _confirm(every.where("first").select("a", "b"), texts, shingle, percent).unionByName(same_id)
    labels = merge_labels(labels, scratch.put(links, "links1", few=True), scratch, "join1")

    # Further levels, for nodes still in several components: small ones give pairs, clouds wait.
    clouds, deep = None, large.select("rep", "key")
    for level in range(2, DEPTH + 1):
        rows = scratch.put(_open_rows(_branch(deep, classes, labels)), f"level{level}", few=True)
        if rows.isEmpty():
            break
        every = every.unionByName(_small_pairs(rows, classes, loose).withColumn("first", F.lit(False)))
        large = rows.where(F.col("n") > SMALL)
        if level >= DENSE_FROM:
            cloud = (large if level == DEPTH else large.where(F.col("n") <= DENSE)).select("key", "rep")
            clouds = cloud if clouds is None else clouds.unionByName(cloud)
            large = large.where(F.col("n") > DENSE)
        deep = large.select("rep", "key")
    rest = every.groupBy("a", "b").agg(F.max("first").alias("first")).where("not first").select("a", "b")
    links = _confirm(_still_apart(rest, labels), texts, shingle, percent)
    if clouds is not None:
        links = links.unionByName(_clouds(clouds, labels, texts, shingle, percent))
    labels = merge_labels(labels, scratch.put(links, "links2", few=True), scratch, "join2")

    named = reps.join(labels, "rep").select("__d1", "__d2", "label")
    out = described.join(named, same & F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), "left")
    component = F.coalesce("label", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op6_near_duplicates(spark, sf_dir):
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP6_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + {SHINGLE - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS p FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes u ON u.doc_id = a JOIN sizes v ON v.doc_id = b WHERE 100 * i >= {PERCENT} * (u.n + v.n - i)
), reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN sizes USING (doc_id)
"""
