"""Substring dedup, near duplicates and decontamination against brute force."""

import hashlib
import re

import numpy as np
import pytest
from frames import documents, many, prose
from pyspark.sql import functions as F

from refinery.llm import decontaminate, near_dups, substrings

ASCII_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def split(text):
    return [w for w in ASCII_SPACE.split(text or "") if w]


def removed(rows, n):
    """Per row: words kept when windows of ``n`` words also start in a
    document of smaller id."""
    first = {}
    for i, t in rows:
        w = split(t)
        for p in range(len(w) - n + 1 if i is not None else 0):
            g = tuple(w[p : p + n])
            first[g] = min(i, first.get(g, i))
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for p in range(len(w) - n + 1 if i is not None else 0):
            if first[tuple(w[p : p + n])] < i:
                gone.update(range(p, p + n))
        out.append((i, len(w), len(gone), [x for k, x in enumerate(w) if k not in gone]))
    return out


def test_lengths_double_from_level_to_level():
    assert substrings.level_lengths(50) == [13, 25, 50]
    assert substrings.level_lengths(50, 4) == [4, 7, 13, 25, 50]
    assert substrings.level_lengths(7) == [4, 7] and substrings.level_lengths(1) == [1, 1]


@pytest.mark.parametrize("n,first", [(50, substrings.FIRST), (50, 4), (50, 25), (7, substrings.FIRST), (20, 3)])
def test_substrings(spark, n, first):
    for df in (documents(spark), many(spark)):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        want = sorted(((i, a, b, hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, a, b, k in removed(rows, n)), key=str)
        got = sorted((tuple(r) for r in substrings.removal_digests(df, min_words=n, first=first).collect()), key=str)
        assert got == want
        full = substrings.remove_repeats(df, min_words=n, first=first)
        texts = sorted(((r["doc_id"], r["n_words"], r["n_removed"], split(r["text"])) for r in full.collect()), key=str)
        assert texts == sorted(removed(rows, n), key=str)
        assert set(df.columns) <= set(full.columns)


def test_candidates_fall_from_level_to_level(spark):
    """A passage shared at 13 words only ends at the second level, one shared
    at 25 only at the last: each level has fewer rows than the one before."""
    docs = [(i, f"{prose(900 + i, 60)} {prose(1, 16)} {prose(950 + i, 60)} {prose(2, 30) if i % 2 else prose(970 + i, 30)} {prose(990 + i, 30)}") for i in range(40)]
    docs += [(i, prose(3, 60)) for i in (100, 101)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = substrings.describe(df, "doc_id", "text", 50, 4).select("doc_id", F.inline("least"))
    left = []
    for i in range(4):
        shared = rows.groupBy(f"k{i}").agg(F.count_distinct("doc_id").alias("n")).where("n > 1").select(f"k{i}")
        rows = rows.join(shared, f"k{i}").persist()
        left.append(rows.count())
    assert left[0] > left[2] > left[3] > 0
    assert rows.select("doc_id").distinct().count() <= 22
    got = {r["doc_id"]: r["n_removed"] for r in substrings.removal_digests(df, first=4).collect()}
    assert {i for i, n in got.items() if n} == {101} and got[101] == 60


def test_substrings_of_nothing(spark):
    df = documents(spark)
    assert substrings.removal_digests(df.limit(0)).count() == 0
    assert substrings.remove_repeats(df.limit(0)).count() == 0
    alone = df.where("doc_id = 0")
    assert substrings.remove_repeats(alone).first()["text"] == alone.first()["text"]


def linked(rows, percent):
    """Components of documents by all pairs of full sets."""
    sets, ids = {}, sorted({i for i, _ in rows if i is not None})
    for i, t in rows:
        w = split((t or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
        s = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and any(x & y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: root(i) for i in ids}, sets


@pytest.mark.parametrize("percent,small,dense,cloud", [(85, near_dups.SMALL, near_dups.DENSE, near_dups.CLOUD_BYTES), (85, 3, 20, 1 << 20), (60, 2, 8, 1 << 20), (85, 3, 200, 6000)])
def test_near_duplicates(spark, monkeypatch, percent, small, dense, cloud):
    """With small bounds, nodes branch, become clouds, and end in blocks, by
    their number or by their bytes."""
    monkeypatch.setattr(near_dups, "CLOUD_BYTES", cloud)
    monkeypatch.setattr(near_dups, "SMALL", small)
    monkeypatch.setattr(near_dups, "DENSE", dense)
    monkeypatch.setattr(near_dups, "DENSE_FROM", 2)
    monkeypatch.setattr(near_dups, "DEPTH", 3)
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    # One id with three texts: a copy of another, a near copy of a third, and a short one.
    other = {r["doc_id"]: r["text"] for r in documents(spark).where("doc_id in (3, 12)").collect()}
    again = documents(spark).where("doc_id = 9").withColumn("text", F.explode(F.array(F.lit(other[12]), F.lit(other[3] + " tail"))))
    for df in (documents(spark).unionByName(again), many(spark)):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        want, sets = linked(rows, percent)
        out = near_dups.components(df, percent=percent).collect()
        assert len(out) == len(rows)
        for r in out:
            i = r["doc_id"]
            assert r["component_id"] == want.get(i) and r["kept"] == (i is None or want[i] == i)
            assert r["n_shingles"] in {len(s) for s in sets[i]}
    assert near_dups.components(documents(spark).limit(0), percent=percent).count() == 0


def test_intersections_by_incidence_products(monkeypatch):
    monkeypatch.setattr(near_dups, "COLUMNS", 5)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(30)]
    of = np.repeat(np.arange(30), [len(s) for s in sets])
    flat = np.concatenate(sets)
    got = near_dups.common_counts(flat, of, flat, of, (30, 30))
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets] for x in sets]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))


def test_decontamination(spark):
    docs = documents(spark)
    passage = docs.where("doc_id = 1").first()["text"].split()
    items = spark.createDataFrame([(100, " ".join(passage[:25])), (20, " ".join(passage[5:16]).upper()), (3, "One, two!"), (4, "no such item at all"),
                                   (5, None), (6, "..."), (7, "same " * 12), (3, "One, two!"), (8, "éé É"), (None, "ça va")], "item_id long, text string")
    windows = {}
    for r in items.collect():
        w = words(r["text"])
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add(r["item_id"])
    want = []
    for r in docs.collect():
        w, hit, found = words(r["text"]), set(), set()
        for n in {len(g) for g in windows}:
            for p in range(len(w) - n + 1):
                if g := windows.get(tuple(w[p : p + n])):
                    hit.update(range(p, p + n))
                    found |= g
        want.append((r["doc_id"], len(w), len(hit), sorted(str(i) for i in found if i is not None), bool(hit)))
    marked = decontaminate.benchmark_windows(items)
    assert marked.grams.count() == len(windows)
    for bound in (decontaminate.MAX_BROADCAST, 0):
        found = decontaminate.with_items(decontaminate.contamination(decontaminate.find_hits(docs, marked, max_bytes=bound)), marked)
        got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert set(docs.columns) - {"hits"} <= set(found.columns)


def test_a_window_of_many_items_costs_its_hits_nothing(spark):
    """2,000 items with one window, 200 times in a document."""
    window = "one two three four five six seven eight nine ten"
    items = spark.range(2000).select(F.col("id").alias("item_id"), F.lit(window).alias("text")).repartition(4)
    docs = spark.createDataFrame([(1, " and ".join([window] * 200)), (2, window), (3, "other")], "doc_id long, text string")
    marked = decontaminate.benchmark_windows(items)
    found = decontaminate.find_hits(docs, marked).persist()
    assert [r["n"] for r in found.orderBy("doc_id").select(F.size("hits").alias("n")).collect()] == [200, 1, 0]
    assert found.select(F.explode("hits").alias("h")).schema["h"].dataType.names == ["start", "length", "window"]  # no list of items
    got = decontaminate.with_items(decontaminate.contamination(found), marked).orderBy("doc_id").collect()
    assert [(r["n_hit"], len(r["items"])) for r in got] == [(2000, 2000), (10, 2000), (0, 0)]


def test_items_of_several_lengths_take_one_scan(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i))) for i in range(1, 13)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(f"w{j}" for j in range(12)))], "doc_id long, text string").repartition(2)
    marked = decontaminate.benchmark_windows(items)
    hits = decontaminate.hashed_hits(docs, marked.grams, "doc_id", "text")
    assert hits.select("__length").distinct().count() == 10
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_decontamination_removes_hit_words_only(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, f"Start here: {item.title()}, then the End of a text that goes on and on."), (2, item), (3, "clean text"), (4, None)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: "Start here: then the End of a text that goes on and on.", 3: "clean text", 4: None}
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 4
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminate(docs.where(F.col("doc_id") == 3), items).first()["text"] == "clean text"
