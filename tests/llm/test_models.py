import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from frames import documents
from pyspark.sql import functions as F

from refinery.llm import hmm, language, neighbours

# --- HMM ----------------------------------------------------------------------


def brute_likelihood(sequence, model):
    """Sum over all state paths."""
    start, move, emit = model
    total = 0.0
    states = range(len(start))
    paths = [((s,), start[s] * emit[sequence[0], s]) for s in states]
    for x in sequence[1:]:
        paths = [((*p, s), q * move[p[-1], s] * emit[x, s]) for p, q in paths for s in states]
    total = sum(q for _, q in paths)
    return total, paths


def test_forward_and_expected_counts_against_all_paths():
    rng = np.random.default_rng(2)
    start, move, emit = rng.random(3), rng.random((3, 3)), rng.random((5, 3))
    model = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)
    sequences = [rng.integers(0, 5, n) for n in (1, 4, 2, 6, 4)]
    got = hmm.log_likelihoods(sequences, model)
    starts, moves, emits, fit = hmm.expected_counts(sequences, model)
    w_starts, w_moves, w_emits, w_fit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for s, g in zip(sequences, got):
        total, paths = brute_likelihood(s, model)
        assert g == pytest.approx(math.log10(total))
        w_fit += math.log(total)
        for p, q in paths:
            w_starts[p[0]] += q / total
            for a, b in zip(p, p[1:]):
                w_moves[a, b] += q / total
            for x, a in zip(s, p):
                w_emits[x, a] += q / total
    for a, b in ((starts, w_starts), (moves, w_moves), (emits, w_emits), (fit, w_fit)):
        assert np.allclose(a, b)


def texts(n):
    rng = random.Random(9)
    kinds = [[f"{k}{i}" for i in range(60)] for k in "ab"]
    return [(i, " ".join(rng.choice(kinds[i % 2]) for _ in range(rng.randrange(1, 60)))) for i in range(n)]


def test_scores_against_plain_counts_and_better_than_the_base(spark):
    rows = texts(400) + [(1000, None), (1001, ""), (None, "a1 b2"), (1002, "never seen"), (5, "a1 a1")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, score int").repartition(3)
    out = hmm.score_documents(df, states=2, iterations=4, frequent=20, suffixes=16, listed=40).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c: Counter = Counter()
    for i, t in rows:
        if i is not None and not held(i):
            c.update([*hmm.tokens(t), hmm.END])
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in rows:
        w = [*hmm.tokens(t), hmm.END]
        want.append((i, held(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    got = [tuple(r)[:6] for r in out]
    for a, b in zip(sorted(got, key=str), sorted(want, key=str)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    unseen = [r for r in out if r["held_out"]]
    assert unseen and sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_class_shares_add_up_to_one(spark):
    """Known words and one unseen word of each class share its probability."""
    df = spark.createDataFrame(texts(60), "doc_id long, text string")
    classes = hmm.Classes(hmm.count_words(df, "text"), 4, 3, 6)
    inside = 10 ** classes.inside()
    own = (classes.size[:4] + 1) / inside[:4]
    shared = (classes.size[4:] + classes.kinds[4:] + 1) / inside[4:]
    assert np.allclose(np.concatenate([own, shared]), 1)


def test_training_raises_the_likelihood(spark):
    df = spark.createDataFrame(texts(200), "doc_id long, text string")
    classes = hmm.Classes(hmm.count_words(df, "text"))
    _, history = hmm.train(hmm.encode(df, classes, "doc_id", "text"), classes.size, 3, 5)
    assert all(b > a - 1e-6 for a, b in zip(history, history[1:])) and history[-1] > history[0]


def test_scores_of_awkward_and_no_rows(spark):
    df = documents(spark)
    out = hmm.score_documents(df, iterations=1).collect()
    assert len(out) == df.count() and all(np.isfinite(r["score"]) for r in out)
    assert hmm.score_documents(df.limit(0), iterations=1).count() == 0
    only_held = df.where(hmm.is_held_out(F.col("doc_id")))
    for r in hmm.score_documents(only_held, iterations=1).collect():
        assert r["train_tokens"] == 0 and r["n_known"] == 0 and np.isfinite(r["score"])


# --- language -----------------------------------------------------------------

SYLLABLES = {"xx": ["ba", "ko", "ti", "lu"], "yy": ["sch", "ung", "en", "ver"], "zz": ["ção", "ña", "él", "rr"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def test_languages_on_held_out_documents_and_mixtures(spark):
    rng = random.Random(1)
    rows = [(i, speak(rng, lang, rng.randrange(5, 80)).upper() if i % 5 == 0 else speak(rng, lang, rng.randrange(5, 80)), lang)
            for i in range(600) for lang in [list(SYLLABLES)[i % 3]]]
    rows += [(1000, speak(rng, "xx", 60) + " " + speak(rng, "yy", 30), None), (1001, None, "xx"), (1002, "123 !!", "xx"), (1003, "", ""), (1005, "½ ² 12 _", "xx"),
             (None, speak(rng, "zz", 20), "yy"), (1004, "a", "xx")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string")
    out = {r["doc_id"]: r for r in language.identify(df, sample=80).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([out[i]["lang_pred"] == list(SYLLABLES)[i % 3] for i in held]) > 0.99
    assert out[1000]["lang_set"] == ["xx", "yy"] and abs(out[1000]["score"] - 0.55) < 0.2
    assert [out[i]["lang_pred"] for i in (1001, 1002, 1003, 1005)] == ["und"] * 4 and out[1001]["score"] == 0.0
    assert out[None]["lang_pred"] == "zz" and out[1004]["lang_pred"] in SYLLABLES
    assert all(0 <= r["score"] <= 1 for r in out.values())


def plain_em(grams, logs, rounds=language.ROUNDS):
    """One n-gram at a time: proportions and log-likelihood."""
    k = logs.shape[1]
    share = [1 / k] * k
    for _ in range(rounds):
        new = [0.0] * k
        for g in grams:
            top = max(logs[g])
            parts = [s * math.exp(x - top) for s, x in zip(share, logs[g])]
            for j in range(k):
                new[j] += parts[j] / sum(parts) / len(grams)
        change, share = max(abs(a - b) for a, b in zip(new, share)), new
        if change < 1e-3:
            break
    fit = sum(math.log(sum(s * math.exp(x - max(logs[g])) for s, x in zip(share, logs[g]))) for g in grams)
    return share, fit


def plain_set(grams, logs):
    share, _ = plain_em(grams, logs)
    order = sorted(range(len(share)), key=lambda j: (-share[j], j))
    best = None
    for size in range(1, len(order) + 1):
        some = order[:size]
        if size > 1 and share[order[size - 1]] < language.MIN_SHARE:
            break
        # the likelihood is taken against the best language of all, not of the set
        cut = np.array([[logs[g][j] - max(logs[g]) for j in some] for g in range(len(logs))])
        part, fit = [1.0], sum(cut[g][0] for g in grams)
        if size > 1:
            part, _ = plain_em(grams, cut)
            fit = sum(math.log(sum(p * math.exp(x) for p, x in zip(part, cut[g]))) for g in grams)
        value = fit / language.GRAM - 0.5 * (size - 1) * math.log(len(grams))
        if best is None or value > best[0] + 1e-9:
            best = value, some, part
    _, some, part = best
    turn = sorted(range(len(some)), key=lambda i: (-part[i], i))
    return [some[i] for i in turn], [share[some[i]] for i in turn]


@pytest.mark.parametrize("seed", range(6))
def test_mixture_and_set_equal_a_plain_em(seed):
    rng = np.random.default_rng(seed)
    k, kinds = int(rng.integers(1, 6)), 40
    counts = rng.dirichlet(np.full(kinds, 0.3), k).T + 1e-4
    logs = np.log(counts / counts.sum(0))
    truth = rng.dirichlet(np.full(k, 0.7))
    grams = [int(rng.choice(kinds, p=np.exp(logs[:, j]))) for j in rng.choice(k, 400, p=truth)]
    some, n = np.unique(grams, return_counts=True)
    share, _ = language.mixture(np.exp(logs[some] - logs[some].max(1, keepdims=True)), n)
    assert np.allclose(share, plain_em(grams, logs)[0], atol=1e-9)
    got, want = language.infer(some, n, logs), plain_set(grams, logs)
    assert got[0] == want[0] and np.allclose(got[1], want[1], atol=1e-9)


def test_grams_of_long_texts_are_counted_in_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["", "a", "ab cd", "\u0130 \u03a3A\u03a3 \u03a3", "x" * 5000, "".join(rng.choice(list("ab \u00e9\u4e2d1.\nZ"), 4000))]
    whole = [language.gram_counts(t) for t in texts]
    plain = []
    for t in texts:
        data, seen = language.TABLE[np.frombuffer((" " + t.lower() + " ").encode(), np.uint8)].tobytes(), {}
        for i in range(len(data) - 3):
            if 32 not in data[i + 1 : i + 3]:
                b = int.from_bytes(data[i : i + 4], "little") * int(language.SPREAD) % 2**32 >> 16
                seen[b] = seen.get(b, 0) + 1
        plain.append(seen)
    assert [dict(zip(b.tolist(), n.tolist())) for b, n in whole] == plain
    for chunk in (7, 64, 1000):
        monkeypatch.setattr(language, "CHUNK", chunk)
        for t, (b, n) in zip(texts, whole):
            got = language.gram_counts(t)
            if "\u03a3" not in t:  # a chunk of a few letters has no spaces to be cut at
                assert got[0].tolist() == b.tolist() and got[1].tolist() == n.tolist()


def test_a_very_long_text_costs_little_memory():
    import tracemalloc

    text = "the quick brown fox jumps over the lazy dog. " * 400_000
    logs = np.log(np.random.default_rng(2).dirichlet(np.ones(language.BUCKETS), 8).T).astype(np.float32)
    tracemalloc.start()
    language.infer(*language.gram_counts(text), logs)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20  # of a text of 18 MB
    tracemalloc.stop()


def test_languages_without_labels_or_rows(spark):
    df = documents(spark)
    assert {r["lang_pred"] for r in language.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(df.limit(0)).count() == 0
    assert language.identify(df).count() == df.count()


# --- nearest neighbours ---------------------------------------------------------


def exact(ids, m, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = m @ m[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def frame(spark, ids, m, extra=()):
    rows = [(int(i), [float(x) for x in v], 1) for i, v in zip(ids, m)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


def test_hilbert_keys_walk_to_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        side = np.arange(1 << bits)
        cells = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = neighbours.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_neighbours_are_exact_when_all_is_in_reach(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(3)
    m = np.round(rng.normal(size=(90, 6)) * 4) / 4
    m[30:60] = m[30]  # ties
    m = m[(m != 0).any(1)].astype(np.float32)
    ids = np.arange(len(m)) * 3
    odd = [(400, None, 1), (None, [1.0] * 6, 1), (420, [0.0] * 6, 1), (440, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
           (460, [float("nan")] * 6, 1), (480, [float("inf")] + [1.0] * 5, 1), (500, [1.0], 1), (0, [float(x) for x in m[0]], 1)]
    got = neighbours.nearest(frame(spark, ids, m, odd), F.col("vec_id") % 20 == 0, reach=1.0, curves=2)
    want = exact(ids, m.astype(np.float64), 20, 20)
    by = {}
    for r in sorted(got.collect()):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert {q: [v for v, _ in x] for q, x in by.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    assert np.allclose([s for x in by.values() for _, s in x], [s for q in by for _, s in want[q]])


def test_recall_on_clusters_with_a_narrow_reach(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    m = (centres[rng.integers(0, 40, 3000)] + 0.15 * rng.normal(size=(3000, 16))).astype(np.float32)
    ids = np.arange(3000)
    neighbours_found = {}
    for r in neighbours.nearest(frame(spark, ids, m), F.col("vec_id") % 100 == 0, k=10).collect():
        neighbours_found.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = exact(ids, m.astype(np.float64), 100, 10)
    recall = np.mean([v in neighbours_found[q] for q, x in want.items() for v, _ in x])
    assert recall >= 0.9


def test_recall_on_clusters_when_most_rows_are_out_of_reach(spark, monkeypatch):
    block, reach, rows, every = 32, 0.01, 3000, 100
    monkeypatch.setattr(neighbours, "BLOCK", block)
    places = rows + rows // every
    blocks, around = -(-places // block), math.ceil(reach * places / block)
    assert neighbours.CURVES * (2 * around + 1) / blocks < 0.3  # of all rows, were no row met on two curves
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    m = (centres[rng.integers(0, 40, rows)] + 0.15 * rng.normal(size=(rows, 16))).astype(np.float32)
    ids, got = np.arange(rows), {}
    for r in neighbours.nearest(frame(spark, ids, m), F.col("vec_id") % every == 0, k=10, reach=reach).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = exact(ids, m.astype(np.float64), every, 10)
    recall = np.mean([v in got[q] for q, x in want.items() for v, _ in x])
    assert recall >= 0.9


def test_copies_beyond_the_reach_are_found_by_id(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(6)
    m = rng.normal(size=(1500, 16))
    m /= np.sqrt((m * m).sum(1))[:, None]
    m[rng.permutation(1500)[:600]] = m[0]  # one vector, far more than the reach
    m, ids = m.astype(np.float32), np.arange(1500)
    m[7] = m[11] = -m[0]  # a small class
    got = {}
    for r in sorted(neighbours.nearest(frame(spark, ids, m), F.col("vec_id") % 20 == 0, k=10).collect()):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = exact(ids, m.astype(np.float64), 20, 10)
    copies = [q for q in want if (m[q] == m[0]).all()]
    assert len(copies) > 20
    for q in copies:  # the group's smallest ids, whatever the query's place in it
        assert got[q] == [int(i) for i in ids if (m[i] == m[0]).all() and i != q][:10]
    assert all(len(got[q]) == 10 for q in want)


def test_few_or_no_vectors(spark):
    df = frame(spark, [0, 20], np.ones((2, 4)))
    assert sorted(tuple(r)[:3] for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()) == [(0, 1, 20), (20, 1, 0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
