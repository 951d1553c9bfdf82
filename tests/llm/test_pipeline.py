"""The five stages against plain Python on a small corpus."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from frames import prose
from test_texts import WORD, linked, words

from refinery.llm import line_dedup, packing

SYLLABLES = {"aa": "ba ko ti lu", "bb": "sch ung en ver"}


def spoken(seed, lang, n):
    s = SYLLABLES[lang].split()
    return " ".join(s[int(w[1:]) % 4] + s[int(w[1:]) // 4 % 4] + s[int(w[1:]) // 16 % 4] for w in prose(seed, n).split())


def corpus():
    item = spoken(900, "aa", 30)
    menu = spoken(901, "aa", 6)
    base = spoken(902, "bb", 150).split()
    rows = []
    for i in range(90):
        lang = "aa" if i % 2 else "bb"
        lines = [spoken(i, lang, 25), spoken(1000 + i, lang, 30 + i)]
        if i % 3 == 0:
            lines.insert(0, menu if i % 2 else f" {menu} ")
        if i % 11 == 0:
            lines[-1] += " " + item.upper()
        rows.append((i, "\n".join(lines), lang if i % 7 else None, f"site{i % 2}"))
    for i in range(90, 100):
        near = list(base)
        near[i - 60] = "changed"
        rows.append((i, " ".join(near), "bb", "site3"))
    rows += [(100, None, "aa", "site0"), (101, "12 34 !!", "aa", "site0"), (102, "", None, None), (103, item, "aa", "site4"),
             (104, rows[4][1], "bb", "site0")]
    return [(*r, len(r[1] or "")) for r in rows], [(1, item), (2, None), (3, spoken(903, "bb", 12))]


def expected(rows, items):
    rows = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    pages, on = Counter(r[3] for r in rows), Counter()
    for r in rows:
        on.update({(r[3], x.strip()) for x in r[1].split("\n")})
    bad = {k for k, c in on.items() if k[1] and c >= line_dedup.MIN_PAGES and c > line_dedup.MAX_RATIO * pages[k[0]]}
    docs = [(r[0], "\n".join(x for x in r[1].split("\n") if (r[3], x.strip()) not in bad)) for r in rows]
    group, _ = linked(docs, corpus_pipeline.NEAR_PERCENT)
    docs = [d for d in docs if group[d[0]] == d[0]]
    windows = set()
    for _, t in items:
        w = words(t)
        windows |= {tuple(w[p : p + 10]) for p in range(len(w) - 9)}
    out = []
    for i, t in docs:
        w, hit = words(t), set()
        for p in range(len(w) - 9):
            if tuple(w[p : p + 10]) in windows:
                hit.update(range(p, p + 10))
        if len(hit) * 2 > len(w):
            continue
        if hit:
            spans = [m.span() for m in WORD.finditer(t.lower())]
            ends = [s for s, _ in spans[1:]] + [len(t)]
            t = t[: spans[0][0]] + "".join(t[s:e] for k, ((s, _), e) in enumerate(zip(spans, ends)) if k not in hit)
        out.append((i, t))
    return out


def test_stages_against_plain_python(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encoder = packing.WordEncoder(packing.default_tokenizer())
    want = []
    for i, t in expected(rows, items):
        ids = np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4")
        want += [(i, k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    assert 80 < len({r["doc_id"] for r in got}) < 100
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_own_columns_come_through_the_stages(spark, tmp_path):
    rows, items = corpus()
    own = {"Score": F.col("doc_id"), "hits": F.lit("own"), "N_Removed": F.lit(3), "items": F.lit(4), "rep": F.lit(5), "label": F.lit(6), "lang_set": F.lit(7)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(own)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        got = {tuple(r) for r in out.select(*own).collect()}
        assert got <= {tuple(r) for r in docs.select(*own).collect()} and len(got) > 50


def test_one_row_of_each_id_stays(spark, tmp_path):
    rows = [(1, "one two three four five six", "aa", "s"), (1, "one two three four five six", "aa", "s"), (2, "b " * 9, "aa", "s"), (2, "a " * 9, None, "s"),
            (3, "c d e f g h i", "aa", "s"), (None, "x y z", "aa", "s"), (None, "x y z", "aa", "s"), (4, None, "aa", "s"), (4, None, "aa", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [rows[0], rows[3], rows[4], rows[5], rows[6], rows[7]]))


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "pack"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
