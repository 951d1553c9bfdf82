"""Language-model scoring with a hidden Markov model over word classes.

Tokens are lower-cased words and one end per text.  A token's class is the
word itself for the ``FREQUENT`` commonest training words, else one of
``SUFFIXES`` classes by its last bytes.  Latent states emit classes and a
class emits its words by add-one counts, so

    P(text) = P(classes | HMM) * prod P(word | class)

is a proper distribution (each suffix class keeps one share for unseen words).
Baum-Welch trains the states: every partition computes expected counts over
its texts by forward-backward, Spark adds them up by class, and the driver
renormalises a model whose size is fixed by the class and state counts.  The
likelihood of a text is exact: one scaled forward recursion over all of it.

Plan on Spark: word counts are combined in each task and summed by word; the
vocabulary stays a distributed table.  One pass writes every text as class
numbers (two bytes a token), which the iterations read.  Counts of the
``LISTED`` commonest words go to the tasks as a list of that size; all other
words of a text, each once, are joined to the vocabulary on the word, so the
base score is exact at any vocabulary size.  Training sequences are cut every
``SEGMENT`` tokens (all are used); scored ones never are.

Defined cases: a null or empty text is the end alone; a null id is in no
training (it has no remainder) but is scored and not held out; without
training rows N = V = 0 and all words are unseen; repeated rows count each;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, parts, ship

STATES = 8
ITERATIONS = 5
FREQUENT = 8192
SUFFIXES = 4096
SUFFIX_BYTES = 3
LISTED = 65536
SEGMENT = 256
SMOOTH = 0.05
END = b"\n"  # no word holds white space
FLUSH = 400_000
PART_BYTES = 1 << 20


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """``word`` (bytes) and ``c`` over ``docs``, the end counted as a word."""
    ship(docs.sparkSession)

    def run(batches):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])

        for batch in parts(batches, 0):
            for t in batch.column(0).to_pylist():
                seen.update(tokens(t))
            seen[END] += batch.num_rows
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
        yield out()

    return docs.select(F.col(text)).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")).where("c > 0")


def suffix_class(word: bytes, frequent: int = FREQUENT, suffixes: int = SUFFIXES) -> int:
    return frequent + zlib.crc32(word[-SUFFIX_BYTES:]) % suffixes


class Classes:
    """Word to class number, count (of listed words) and class sizes."""

    def __init__(self, vocabulary: DataFrame, frequent: int = FREQUENT, suffixes: int = SUFFIXES, listed: int = LISTED):
        self.frequent, self.suffixes, classes = frequent, suffixes, frequent + suffixes
        # The commonest words without a sort: by steps of 1/64 octave of their
        # counts, as many whole steps as hold ``listed`` words at most.
        step = F.floor(F.log2("c") * 64).cast("int")
        steps = vocabulary.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("words"), F.sum("c").alias("c")).collect()  # 64 * 63 at most
        self.total, self.distinct = sum(int(r["c"]) for r in steps), sum(r["words"] for r in steps)
        least, room = 1 << 30, listed
        for r in sorted(steps, key=lambda r: -r["s"]):
            room -= r["words"]
            if room < 0:
                break
            least = r["s"]
        top = vocabulary.where(step >= least).collect()  # ``listed`` words at most
        top.sort(key=lambda r: (-r["c"], bytes(r["word"])))
        self.listed = {bytes(r["word"]): (i if i < frequent else suffix_class(bytes(r["word"]), frequent, suffixes), int(r["c"])) for i, r in enumerate(top)}
        self.size = np.zeros(classes)
        self.kinds = np.zeros(classes)
        own = [w for w, (k, _) in self.listed.items() if k < frequent]
        for w in own:
            self.size[self.listed[w][0]], self.kinds[self.listed[w][0]] = self.listed[w][1], 0
        single = vocabulary.sparkSession.createDataFrame([(bytearray(w),) for w in own], "single binary")
        rest = vocabulary.join(F.broadcast(single), F.col("word") == F.col("single"), "left_anti")  # ``frequent`` rows
        last = F.when(F.length("word") < SUFFIX_BYTES, F.col("word")).otherwise(F.substring("word", -SUFFIX_BYTES, SUFFIX_BYTES))
        number = F.lit(frequent) + F.crc32(last) % suffixes
        for r in rest.groupBy(number.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
            self.size[int(r["k"])], self.kinds[int(r["k"])] = r["c"], r["v"]
        # The end is in every text; it has a class and count even where it is not listed or learned.
        found = vocabulary.where(F.col("word") == F.lit(END)).first()
        self.end = self.listed.get(END, (suffix_class(END, frequent, suffixes), int(found["c"]) if found else 0))

    def inside(self) -> np.ndarray:
        """log10 of each class's denominator: of P(word | class)."""
        shared = np.arange(len(self.size)) >= self.frequent
        return np.log10(np.where(shared, self.size + self.kinds + 1, self.size + 1))


def encode(docs: DataFrame, classes: Classes, doc_id: str, text: str) -> DataFrame:
    """Every text as ``classes`` (uint16 each, the end last), ``n_tokens``,
    what the listed words give (``listed_known``, ``listed_log``), and its
    other words with their counts."""
    ship(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    listed, end = classes.listed, classes.end
    logs = {w: (k, math.log10(c + 1)) for w, (k, c) in listed.items()}
    shared = docs.sparkSession.sparkContext.broadcast((logs, end, classes.frequent, classes.suffixes))  # ``listed`` words

    def run(batches):
        logs, end, frequent, buckets = shared.value
        get, suffixes = logs.get, {}
        end_log, end_known = math.log10(end[1] + 1), int(end[1] > 0)
        for batch in parts(batches, 2):
            out = {k: [] for k in ("classes", "n", "known", "log", "words", "counts")}
            for t in batch.column(2).to_pylist():
                words, rest, ids, total = tokens(t), [], [], end_log
                for w in words:
                    hit = get(w)
                    if hit is None:
                        rest.append(w)
                        s = w[-SUFFIX_BYTES:]
                        k = suffixes.get(s)
                        if k is None:
                            k = suffixes[s] = suffix_class(s, frequent, buckets)
                        ids.append(k)
                    else:
                        ids.append(hit[0])
                        total += hit[1]
                ids.append(end[0])
                other = Counter(rest)
                for k, v in zip(out, (np.array(ids, "<u2").tobytes(), len(ids), len(words) - len(rest) + end_known, total, list(other), list(other.values()))):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out["classes"], pa.binary()), pa.array(out["n"], pa.int64()), pa.array(out["known"], pa.int64()),
                 pa.array(out["log"], pa.float64()), pa.array(out["words"], pa.list_(pa.binary())), pa.array(out["counts"], pa.list_(pa.int32()))],
                ["doc_id", "held_out", "classes", "n_tokens", "listed_known", "listed_log", "words", "counts"])

    return docs.select(F.col(doc_id), is_held_out(F.col(doc_id)), F.col(text)).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, classes binary, n_tokens long, listed_known long, listed_log double, words array<binary>, counts array<int>")


# --- the hidden Markov model -------------------------------------------------


def first_model(size: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sticky transitions; emissions are the class counts, pulled apart by a
    fixed pseudo-random factor."""
    rng = np.random.default_rng(11)
    start = np.full(states, 1 / states)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    emit = (size + 1)[:, None] * np.exp(rng.normal(0, 1.0, (len(size), states)))
    return start, move, emit / emit.sum(0)


def by_time(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences, longest first and end to end: each token's place when
    ordered by time, each time's first place, and how many are still on."""
    on = np.searchsorted(-lengths, -np.arange(lengths[0]), "left") if len(lengths) else np.zeros(0, int)
    first = np.concatenate([[0], np.cumsum(on)])
    rank = np.repeat(np.arange(len(lengths)), lengths)
    time = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return first[time] + rank, first, on


def forward(seen: np.ndarray, first: np.ndarray, on: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Scales of the forward recursion by place; ``seen`` (emissions by
    place) becomes the scaled forward values."""
    scale = np.empty(len(seen))
    for t in range(len(on)):
        now = seen[first[t] : first[t + 1]]
        now *= start if t == 0 else seen[first[t - 1] : first[t - 1] + on[t]] @ move
        s = now.sum(1)
        now /= s[:, None]
        scale[first[t] : first[t + 1]] = s
    return scale


def expected_counts(sequences: list[np.ndarray], model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions over sequences, and their
    log-likelihood."""
    start, move, emit = model
    sequences = sorted(sequences, key=len, reverse=True)
    lengths = np.array([len(s) for s in sequences])
    place, first, on = by_time(lengths)
    flat = np.empty(len(place), np.int64)
    flat[place] = np.concatenate(sequences)
    seen = emit[flat]
    alpha = seen.copy()
    scale = forward(alpha, first, on, start, move)
    moves = np.zeros_like(move)
    beta = np.ones((on[0], len(start)))
    for t in range(len(on) - 1, 0, -1):
        n = on[t]
        a, b = first[t], first[t + 1]
        ahead = seen[a:b] * beta[:n] / scale[a:b, None]
        moves += alpha[first[t - 1] : first[t - 1] + n].T @ ahead
        alpha[a:b] *= beta[:n]
        beta[:n] = ahead @ move.T
    alpha[: on[0]] *= beta
    emits = np.stack([np.bincount(flat, weights=alpha[:, k], minlength=len(emit)) for k in range(len(start))], 1)
    return alpha[: on[0]].sum(0), moves * move, emits, float(np.log(scale).sum())


def log_likelihoods(sequences: list[np.ndarray], model) -> np.ndarray:
    """log10 P(classes) of each sequence, by the scaled forward recursion."""
    start, move, emit = model
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lengths = np.array([len(sequences[i]) for i in order])
    place, first, on = by_time(lengths)
    flat = np.empty(len(place), np.int64)
    flat[place] = np.concatenate([sequences[i] for i in order])
    scale = np.log10(forward(emit[flat], first, on, start, move))
    sums = np.add.reduceat(scale[place], np.cumsum(lengths) - lengths)
    out = np.empty(len(order))
    out[order] = sums
    return out


def _sequences(batch, at: int, cut: int | None = None) -> list[np.ndarray]:
    out = []
    for b in batch.column(at).to_pylist():
        ids = np.frombuffer(b, "<u2")
        out.extend([ids] if cut is None or len(ids) <= cut else [ids[i : i + cut] for i in range(0, len(ids), cut)])
    return out


def train(encoded: DataFrame, size: np.ndarray, states: int, iterations: int):
    """Baum-Welch over all rows of ``encoded``; returns the model and the
    log-likelihood before each iteration."""
    context = encoded.sparkSession.sparkContext
    model, history, n = first_model(size, states), [], len(size)
    schema = "id int, " + ", ".join(f"s{k} double" for k in range(states))
    for _ in range(iterations):
        shared = context.broadcast(model)

        def run(batches, shared=shared):
            model = shared.value
            sums = np.zeros((n + states + 2, states))
            for batch in parts(batches, 0, PART_BYTES):
                starts, moves, emits, fit = expected_counts(_sequences(batch, 0, SEGMENT), model)
                sums[:n] += emits
                sums[n : n + states] += moves
                sums[n + states] += starts
                sums[n + states + 1, 0] += fit
            some = np.flatnonzero(sums.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(sums[some, k]) for k in range(states)]],
                                             ["id", *[f"s{k}" for k in range(states)]])

        rows = encoded.select("classes").mapInArrow(run, schema).groupBy("id").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)]).collect()
        sums = np.zeros((n + states + 2, states))
        for r in rows:  # one row per class, state and total
            sums[r[0]] = r[1:]
        shared.destroy()
        if not rows:
            break
        history.append(float(sums[n + states + 1, 0]))
        emit = sums[:n] + SMOOTH * (size + 1)[:, None] / (size + 1).mean()
        move = sums[n : n + states] + 1.0
        start = sums[n + states] + 1.0
        model = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)
    return model, history


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", states: int = STATES, iterations: int = ITERATIONS,
                    frequent: int = FREQUENT, suffixes: int = SUFFIXES, listed: int = LISTED) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10 probabilities) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "hmm")
    learned = docs.where(F.col(doc_id).isNotNull() & ~is_held_out(F.col(doc_id)))
    vocabulary = scratch.put(count_words(learned, text), "vocabulary")
    classes = Classes(vocabulary, frequent, suffixes, listed)
    encoded = scratch.put(encode(docs, classes, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "encoded")
    model, _ = train(encoded.where(F.col("doc_id").isNotNull() & ~F.col("held_out")), classes.size, states, iterations)
    inside = classes.inside()
    shared = spark.sparkContext.broadcast((model, inside))

    def run(batches):
        model, inside = shared.value
        for batch in parts(batches, 1, PART_BYTES):
            sequences = _sequences(batch, 1)
            latent = log_likelihoods(sequences, model) - np.array([inside[s].sum() for s in sequences])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(latent)], ["__row", "latent"])

    latent = encoded.select("row", "classes").mapInArrow(run, "__row long, latent double")
    other = encoded.select("row", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("row", "w.words", "w.counts")
    other = other.join(vocabulary.hint("merge"), F.col("words") == F.col("word"))
    other = other.groupBy(F.col("row").alias("__of")).agg(F.sum("counts").alias("known"), F.sum(F.col("counts") * F.log10(F.col("c") + 1)).alias("log"))
    out = encoded.drop("classes", "words", "counts").join(latent, F.col("row") == F.col("__row")).join(other, F.col("row") == F.col("__of"), "left")
    logs = F.col("listed_log") + F.coalesce("log", F.lit(0.0))
    total = F.lit(classes.total).cast("long")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("listed_known") + F.coalesce("known", F.lit(0))).alias("n_known"), total.alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(total + F.lit(classes.distinct + 1))).alias("base_score"), (logs + F.col("latent")).alias("score"))


def op5_hmm_scores(spark, sf_dir):
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
