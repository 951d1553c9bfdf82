"""Infill, vector codes and pieces against plain Python and the library."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from frames import documents, many
from refinery.llm import codes, infill, pieces

# -- infill ---------------------------------------------------------------


def plain_infill(doc_id, text, rate=100, spm=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    p, s, m = marks
    if not text or any(x in text for x in marks) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(lines), "spm", len(pre), len(mid), s + suf + p + pre + m + mid
    return len(lines), "psm", len(pre), len(mid), p + pre + s + suf + m + mid


def infill_rows(spark):
    rng = random.Random(3)
    texts = ["", None, "\n", "\n\n\n", "a", "a\n", "a\nb", "\na", "x <P> y", "x<S>\ny", "<M>", "a<\nS>b\n<", "é\n中\U0001f600\r\n\tz", "one\n" * 20_000, "long " * 50_000]
    texts += ["".join(rng.choice(["ab", "\n", "é", "<", "P>", " "]) for _ in range(rng.randrange(40))) for _ in range(300)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "a\nb\nc\n", None), (4, "a\nb\nc\n", "again"), (4, "a\nb\nc\n", "again")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, output string").repartition(3)


@pytest.mark.parametrize("rate", [100, 40])
def test_infill_against_plain_python(spark, rate):
    rows, df = infill_rows(spark)
    got = infill.restore(infill.fill_in_middle(df, rate=rate)).collect()
    found = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got), key=repr)
    assert found == sorted(((d, *plain_infill(d, t, rate)) for d, t, _ in rows), key=repr)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert sorted(r["restored"] for r in got) == sorted(t or "" for _, t, _ in rows)


def test_infill_of_an_empty_table(spark):
    _, df = infill_rows(spark)
    assert infill.restore(infill.fill_in_middle(df.limit(0))).count() == 0


# -- codes ----------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds=2, scale=256):
    """(codes, codebooks) of (id, vector, label) rows, by plain scans."""
    fine = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and len(r[1]) and len(r[1]) % parts == 0]
    sizes = sorted({len(r[1]) for r in fine}, key=lambda d: (-sum(len(r[1]) == d for r in fine), d))
    fine = [r for r in fine if len(r[1]) == sizes[0]]
    whole = [[math.floor(scale * x) for x in r[1]] for r in fine]
    w = sizes[0] // parts
    order = sorted(range(len(fine)), key=lambda i: (fine[i][0] is None, fine[i][0] or 0, fine[i][1]))[:entries]
    books = [[whole[i][p * w : p * w + w] for i in order] for p in range(parts)]

    def nearest(p):
        return [min((sum((a - b) ** 2 for a, b in zip(v[p * w : p * w + w], e)), j) for j, e in enumerate(books[p])) for v in whole]

    for _ in range(rounds):
        for p in range(parts):
            owner = [j for _, j in nearest(p)]
            for j in range(len(books[p])):
                own = [v[p * w : p * w + w] for v, o in zip(whole, owner) if o == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    final = [nearest(p) for p in range(parts)]
    return [(r[0], r[2], [final[p][i][1] for p in range(parts)], sum(final[p][i][0] for p in range(parts))) for i, r in enumerate(fine)], books


def vectors(spark, n=500, d=8):
    rng = random.Random(9)
    centres = [[rng.uniform(-1, 1) for _ in range(d)] for _ in range(12)]
    rows = []
    for i in range(n):
        v = [float(np.float32(x + rng.gauss(0, 0.05))) for x in rng.choice(centres)]
        rows.append((i * 3 % n, [0.25] * d if i % 3 == 0 else v, i % 5 if i % 7 else None))
    rows += [(2, None, 1), (None, [0.5] * d, 1), (7, [0.5] * (d - 1) + [None], 1), (8, [float("nan")] * d, 1), (9, [float("inf")] * d, 2),
             (10, [], 1), (11, [0.5] * (d + 1), 1), (12, [0.5] * (2 * d), 1), (13, [0.0] * d, 1), (14, [-0.001] * d, None), (14, [-0.001] * d, None)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, code string").repartition(3)


@pytest.mark.parametrize("entries", [16, 64])
def test_codes_against_plain_scans(spark, entries):
    rows, df = vectors(spark)
    want, books = plain_codes(rows, 2, entries)
    found, got_books = codes.compress(df, parts=2, entries=entries)
    got = [(r["vec_id"], r["label"], r["code"], r["error"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert got_books.tolist() == books
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert {(r["label"], r["label_error"]) for r in codes.with_label_error(found).collect()} == set(sums.items())


def test_codes_of_few_rows_and_none(spark):
    rows, df = vectors(spark)
    found, books = codes.compress(df.where("vec_id < 3"), parts=4)
    assert books.shape[1] == df.where("vec_id < 3 and embedding is not null").count() and {r["error"] for r in found.collect()} == {0}
    found, books = codes.compress(df.where("vec_id in (8, 9) and embedding[0] > 1"), parts=4)
    assert books.shape[1] == 0 and codes.with_label_error(found).count() == 0


def test_codes_hold_huge_components(spark):
    df = spark.createDataFrame([(i, [float(i), 3e38 * (-1) ** i, 0.0, 1.0], 1) for i in range(6)], "vec_id long, embedding array<float>, label int")
    found, books = codes.compress(df, parts=2, entries=2)
    assert int(np.abs(books).max()) == codes.limit(4)
    assert codes.with_label_error(found).count() == 6


@pytest.mark.parametrize("seed", range(12))
def test_ball_tree_equals_a_plain_scan(seed):
    rng = np.random.default_rng(seed)
    d, n = int(rng.integers(1, 6)), int(rng.integers(1, 1500))
    spread = [3, 40, 2000, 1 << 27][seed % 4]
    points = rng.integers(-spread, spread, (n, d)) if seed % 3 else (rng.integers(-spread, spread, (8, d))[rng.integers(0, 8, n)] + rng.integers(-3, 4, (n, d)))
    points, counts = np.unique(points, axis=0, return_counts=True)
    tree = codes.BallTree(points.astype(np.int64), counts.astype(np.int64), leaf=int(rng.integers(1, 20)))
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    assert int(tree.counts[0]) == counts.sum() and tree.sums[0].tolist() == (points * counts[:, None]).sum(0).tolist()
    for k in (1, 2, 17, 64):
        book = np.concatenate([points[rng.integers(0, len(points), k)], rng.integers(-spread, spread, (k, d))]).astype(np.int64)
        book[-1] = book[0]  # equal entries: the lower index wins
        far = ((points[:, None].astype(np.int64) - book[None]) ** 2).sum(2)
        owner = far.argmin(1)
        got, error = tree.codes(book)
        assert got.tolist() == owner.tolist() and error.tolist() == far.min(1).tolist()
        n_of, sums = tree.totals(book)
        assert n_of.tolist() == np.bincount(owner, counts, len(book)).astype(int).tolist()
        assert sums.tolist() == [(points[owner == j] * counts[owner == j, None]).sum(0).tolist() for j in range(len(book))]


def test_balls_are_owned_without_their_points():
    rng = np.random.default_rng(1)
    centres = rng.integers(-10_000, 10_000, (20, 4))
    points = np.unique(centres[rng.integers(0, 20, 4000)] + rng.integers(-30, 31, (4000, 4)), axis=0)
    tree = codes.BallTree(points, np.ones(len(points), np.int64))
    looked = sum(stop - start for _, start, stop, entry in tree.owners(centres) if not isinstance(entry, int))
    assert looked < len(points) / 20


# -- pieces ---------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def model():
    with open(pieces.default_model(), "rb") as f:
        return pieces.PieceModel(f.read())


def odd_texts():
    rng = random.Random(2)
    texts = ["", None, " ", "  a", "a  b ", "\n", "▁x", "é中\x00퟿", "<s> <0x0A> </s>", "a\xa0b\tc\r\n", "�", "a" * 5000, " " * 3000 + "x" + " " * 40,
             "ab" * 1000, "aab" * 700, "=" * 777, "=-" * 500, "\U0001f600‍\U0001f469", "fi ﬁ Ａ", "1234567890" * 30]
    alphabets = ["ab ", "aab  ", "the quick brown fox\n", "éü中文日本語 a", "()[]{};= \t\n", " ▁x", "".join(map(chr, range(32, 0x500, 3)))]
    return texts + ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(120))) for _ in range(1500)]


def test_pieces_equal_the_library(model, library):
    texts = odd_texts() + [library.decode([i, j]) for i, j in zip(range(259, 32000, 7), range(31999, 259, -7))]
    coded = model.encode(pa.array(texts, pa.string()))
    want = [library.encode(t or "") for t in texts]
    assert coded.to_pylist() == want
    assert model.decode(coded).to_pylist() == [library.decode(w) for w in want]


def test_the_agenda_equals_the_rounds(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "ROUNDS", 2)
    texts = odd_texts()
    assert model.encode(pa.array(texts, pa.string())).to_pylist() == [library.encode(t or "") for t in texts]


def test_any_ids_decode_like_the_library(model, library):
    rng = random.Random(4)
    lists = [[rng.randrange(rng.choice([3, 259, 32000])) for _ in range(rng.randrange(10))] for _ in range(2000)]
    assert model.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [library.decode(x) for x in lists]


def test_pieces_of_tables(spark, library):
    path = pieces.default_model()
    for df in (documents(spark), many(spark)):
        rows = df.select("doc_id", "text").collect()
        got = pieces.decode(pieces.encode(df, path), path).collect()
        want = [(r["doc_id"], library.encode(r["text"] or "")) for r in rows]
        assert sorted(((r["doc_id"], r["ids"], r["text"]) for r in got), key=repr) == sorted(((d, w, library.decode(w)) for d, w in want), key=repr)
    assert pieces.decode(pieces.encode(documents(spark).limit(0), path), path).count() == 0


def test_op13_on_the_shipped_documents(spark, library):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = set()
    for r in rows:
        ids = library.encode(r["text"] or "")
        want.add((r["doc_id"], len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert {tuple(r) for r in pieces.op13_pieces(spark, "/root/testdata/sf0.01").collect()} == want


def test_other_models_are_refused(model):
    with open(pieces.default_model(), "rb") as f:
        raw = f.read()
    with pytest.raises(ValueError):
        pieces.PieceModel(raw.replace(b"\x98\x02\x01", b"\x98\x02\x00"))
