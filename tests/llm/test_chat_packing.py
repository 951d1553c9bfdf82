import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from frames import documents
from pyspark.sql import functions as F

from refinery.llm import chat, packing


def conversations(spark):
    rng = random.Random(3)
    rows = []
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", f"be kind {c} <|user|> \\l"))
        for t in range(1, rng.randrange(2, 40)):
            rows.append((c, t, "assistant" if t % 2 == 0 else "user", " ".join(["word"] * rng.randrange(0, 60)) + " <//> \\b \\\\ é"))
    rows += [(100, 0, "system", "alone"), (101, 5, None, "no role"), (101, 5, "assistant", None), (101, None, "user", "null turn"),
             (102, 0, "assistant", "tie"), (102, 0, "assistant", "tie"), (102, 0, "a|>b<", "odd role"), (None, 1, "assistant", "null conversation"),
             (103, -3, "user", "before"), (103, 2, "assistant", "big " * 900), (103, 3, "user", "after")]
    rows += [(200, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, window int")


def expected(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(ts)] for c, ts in by.items()}


@pytest.mark.parametrize("budget,history,block", [(200, 40, chat.BLOCK), (60, 10, 16), (100_000, 0, chat.BLOCK)])
def test_windows_read_back_exactly(spark, monkeypatch, budget, history, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows, df = conversations(spark)
    windows = chat.read_back(chat.format_windows(df, budget=budget, history=history)).collect()
    by = defaultdict(list)
    for w in windows:
        by[w["conv_id"]].append(w)
    want = expected(rows)
    assert set(by) == set(want)
    for c, ws in by.items():
        ws.sort(key=lambda w: (w["block"]["numbers"] is not None, w["block"]["numbers"] or 0, w["block"]["piece"], w["window"]))
        assert [(t["role"], t["text"]) for w in ws for t in w["turns"]] == want[c]
        assert [x for w in ws for x in w["targets"]] == [x for r, x in want[c] if r == "assistant"]
        system = want[c][0] if want[c][0][0] == "system" else None
        for i, w in enumerate(ws):
            assert len(w["formatted"].split("<//>")) - 1 == w["n_turns"]
            fresh = w["n_turns"] - w["n_repeated"]
            cost = {t: 2 + len(re.findall(r"[^\W]+|[^\s\w]", t)) for t in [x["text"] for x in w["turns"]] + [system[1] if system else ""]}
            least = cost[w["turns"][-1]["text"]] + (cost[system[1]] if system and (i or fresh > 1) else 0)
            assert w["n_tokens"] <= budget or (fresh <= 2 and least > budget and w["n_tokens"] == least)
            if system and i:
                assert w["formatted"].startswith("<|system|>") and w["n_repeated"] >= 1


def test_history_gives_way_to_the_budget(spark):
    """A large new turn leaves no room for history, a large system turn less."""
    rows = [(1, 0, "user", "w " * 100), (1, 1, "assistant", "w " * 950), (1, 2, "user", "w " * 20),
            (2, 0, "system", "s " * 1000), (2, 1, "user", "a b c"), (2, 2, "assistant", "d e f"), (2, 3, "user", "g " * 40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(w["conv_id"], w["window"]): (w["n_tokens"], w["n_repeated"]) for w in chat.format_windows(df).collect()}
    assert got == {(1, 0): (102, 0), (1, 1): (952, 0), (1, 2): (22, 0), (2, 0): (1007, 0), (2, 1): (1012, 2), (2, 2): (1044, 1)}


def test_equal_and_null_turn_numbers_make_bounded_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 50)
    rows = [(1, None if i % 2 else 7, "assistant" if i % 3 else "user", f"text {i % 90:03d}") for i in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    ws = chat.read_back(chat.format_windows(df, budget=40, history=10)).orderBy("block", "window").collect()
    assert [(t["role"], t["text"]) for w in ws for t in w["turns"]] == expected(rows)[1]
    assert max(w["n_turns"] for w in ws) < 50 and len({str(w["block"]) for w in ws}) == 14


def test_windows_repeat_limited_history(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", "a b c d e f g h") for t in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ws = chat.format_windows(df, budget=60, history=25).orderBy("window").collect()
    assert [w["n_repeated"] for w in ws] == [0] + [2] * (len(ws) - 1)
    assert chat.format_windows(df.limit(0)).count() == 0


def test_chat_query_against_plain_python(spark, tmp_path):
    rows, df = conversations(spark)
    df.where("conv_id is not null").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in chat.op3_chat_windows(spark, str(tmp_path)).collect()}
    said = "\\### Assistant: </turn> ok"
    want = expected([r for r in rows if r[0] is not None] + [(-7, 0, "user", said), (-7, 1, "assistant", said)])
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        g = got[c]
        assert (g["n_turns"], g["loss_chars"]) == (len(turns), len(loss))
        assert g["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert g["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert g["formatted_chars"] >= sum(len(x) for _, x in turns)


def test_words_encode_like_whole_texts():
    encoder = packing.WordEncoder(packing.default_tokenizer())
    texts = ["It's foo's 'll don't. x' 'twas", "Élan, vital's... «quoi» 12ab34 a1. <|endoftext|>x X<|ENDOFTEXT|>",
             "ΑΣ ΣΑΣ. İstanbul ǅ ﬁ été. ́x ª º ² ⅷ", "日本語。テスト ไทย नमस्ते देव!", "a\x1cb\x85c\xa0d zero​width",
             "naïve—dash…end 'Re 're", "don't'. o'. o'', it's'", "", None, "  \n\t x \x0b\x0c ", "word " * 5000]
    for _ in range(2):
        ids, first = encoder.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[first[i] : first[i + 1]].tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_plan_gives_every_piece_one_gapless_slot():
    rng = random.Random(4)
    for _ in range(30):
        capacity = rng.choice([7, 64, 500])
        histogram = {rng.randint(1, capacity): rng.randint(1, 60) for _ in range(rng.randint(1, 40))}
        used, ranks = defaultdict(list), defaultdict(list)
        for length, rank, n, each, first, offset in packing.plan(histogram, capacity):
            for i in range(n):
                ranks[length].append(rank + i)
                used[first + i // each].append((offset + i % each * length, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
        for parts in used.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        items = sorted((k for k, n in histogram.items() for _ in range(n)), reverse=True)
        bins: list[int] = []
        for x in items:  # best-fit decreasing, one by one
            fit = min((b for b in range(len(bins)) if bins[b] >= x), key=lambda b: bins[b], default=None)
            if fit is None:
                bins.append(capacity)
                fit = len(bins) - 1
            bins[fit] -= x
        assert len(used) == len(bins)


def test_packing_holds_whole_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 3)
    df = documents(spark)
    path = packing.default_tokenizer()
    capacity = 512
    out = packing.pack(df, path, capacity=capacity, with_ids=True)
    rows = out.collect()
    encoder = packing.WordEncoder(path)
    by = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by[r["doc_id"]].append(r)
    for d in df.collect():
        ids = encoder.tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        want = [(k, k * capacity, ids[k * capacity : (k + 1) * capacity]) for k in range(-(-len(ids) // capacity))]
        got = sorted({(r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in by[d["doc_id"]]})
        assert got == [(k, s, tuple(x)) for k, s, x in want]
    joined = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in packing.sequences(out).collect()}
    assert sum(len(x) for x in joined.values()) == sum(r["length"] for r in rows) and max(map(len, joined.values())) <= capacity
    for r in rows:
        assert joined[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tobytes() == r["ids"]
    assert packing.pack(df.limit(0), path).count() == 0
    assert packing.pack(df.where(F.col("doc_id") == 7), path).first()["length"] == 1
