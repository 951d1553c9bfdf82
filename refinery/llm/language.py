"""Language identification by mixture inference.

Each language has a distribution over hashed ``GRAM``-byte n-grams of
lower-cased words, add-one smoothed, learned from labelled documents.  A document is a mixture:
expectation-maximisation finds the language proportions that make its n-grams
likeliest, then the language set of best penalised likelihood (each further
language must pay half a log of the n-gram count, as in the Bayesian
information criterion).  Sets grow in order of the proportions, and a language
under ``MIN_SHARE`` of the text is not tried: so little of a text is as likely
names and loan words, and the tries are bounded whatever the number of labels.
The prediction is the set's largest language, the score its proportion.

A text is its distinct n-gram buckets with their counts, at most ``BUCKETS``
numbers, gathered in chunks of ``CHUNK`` characters; the EM works on these, so
neither its memory nor its time grows with the length of a text.

Plan on Spark: the classifier is fitted on a bounded sample, up to about
``SAMPLE`` documents of each label, taken by a hash of id and text (labels
with fewer give all); per-task sums of n-gram counts are added up by (label,
bucket).  The sums, ``BUCKETS`` per label at most, come to the driver as Arrow
columns; the model is ``BUCKETS`` numbers per label and is broadcast, and
every document is then read once, without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is everything when no label was learned; a null or empty label is not
learned; a letter with no n-gram (one-letter words) takes the commonest
label; rows with a null id are not learned from, but predicted; a text of any
length is read whole; repeated rows are predicted each; an empty table gives an empty result; added columns
replace input columns of their names.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import parts, ship, without

SAMPLE = 4000
BUCKETS = 1 << 16
GRAM = 4
CHUNK = 1 << 20
ROUNDS = 30
MIN_SHARE = 0.02
PLAIN_LETTER = re.compile(r"[A-Za-z]")
UNDETERMINED = "und"
ADDED = ("lang_pred", "score", "lang_set", "lang_share")
# Fixed value: an odd multiplier that spreads n-grams over the buckets.
SPREAD = np.uint32(0x9E3779B1)


def has_letter(text: str) -> bool:
    return bool(PLAIN_LETTER.search(text)) or any(map(str.isalpha, text))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _byte_classes() -> np.ndarray:
    """Letters and non-ASCII bytes as they are, all others a space."""
    table = np.full(256, 32, np.uint8)
    for low, high in ((97, 123), (128, 256)):
        table[low:high] = np.arange(low, high)
    return table


TABLE = _byte_classes()


def _hashed(data: np.ndarray) -> np.ndarray:
    """Buckets of the byte n-grams in ``data`` that lie in or border on one word."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint16)
    inside = data != 32
    whole = np.logical_and.reduce([inside[i : len(data) - GRAM + 1 + i] for i in range(1, GRAM - 1)])
    x = data.astype(np.uint32)
    grams = x[: len(x) - GRAM + 1].copy()
    for i in range(1, GRAM):
        grams |= x[i : len(x) - GRAM + 1 + i] << np.uint32(8 * i)
    return ((grams[whole] * SPREAD) >> np.uint32(16)).astype(np.uint16)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text's n-grams and their counts."""
    if len(text) <= CHUNK:
        found, counts = np.unique(_hashed(_bytes(" " + text.lower() + " ")), return_counts=True)
        return found.astype(np.int64), counts
    sums, rest, at = np.zeros(BUCKETS, np.int64), _bytes(" "), 0
    while at < len(text):
        # Cut at a space if there is one: lower-casing looks at neighbouring letters.
        end = at + CHUNK
        end = len(text) if end >= len(text) else max(text.rfind(" ", at + 1, end), 0) or end
        data = np.concatenate([rest, _bytes(text[at:end].lower() + " " * (end == len(text)))])
        sums += np.bincount(_hashed(data), minlength=BUCKETS)
        rest, at = data[-(GRAM - 1) :], end
    found = np.flatnonzero(sums)
    return found, sums[found]


def _bytes(text: str) -> np.ndarray:
    return TABLE[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]


def learn(docs: DataFrame, doc_id: str, text: str, label: str, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Labels (commonest first) and log-probabilities, a column per label."""
    ship(docs.sparkSession)
    known = docs.where(F.col(doc_id).isNotNull() & ~is_held_out(F.col(doc_id)) & F.col(text).isNotNull() & (F.col(label) != ""))
    counts = sorted(known.groupBy(label).count().collect(), key=lambda r: (-r["count"], r[label]))  # a row per label
    if not counts:
        return [], np.zeros((BUCKETS, 0))
    labels = [r[label] for r in counts]
    place = {name: i for i, name in enumerate(labels)}
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(1 << 20))
    upto = F.create_map(*[F.lit(x) for r in counts for x in (r[label], math.ceil(min(1.0, sample / r["count"]) * (1 << 20)))])
    chosen = known.where(draw < F.element_at(upto, F.col(label)))

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in parts(batches, 1):
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, n = gram_counts(t)
                sums.setdefault(place[name], np.zeros(BUCKETS, np.int64))[found] += n
        for i, s in sums.items():
            some = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), i, np.int32)), pa.array(some.astype(np.int32)), pa.array(s[some])], ["label", "bucket", "n"])

    summed = chosen.select(label, text).mapInArrow(run, "label int, bucket int, n long")
    got = summed.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows per label at most
    found = np.ones((BUCKETS, len(labels)))
    found[got["bucket"].to_numpy(), got["label"].to_numpy()] += got["n"].to_numpy()
    return labels, np.log(found / found.sum(0))


def mixture(likelihood: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood by expectation-maximisation; rows of
    ``likelihood`` are distinct n-grams (``counts`` of each), columns
    languages."""
    n, k = counts.sum(), likelihood.shape[1]
    share = np.full(k, 1 / k)
    for _ in range(rounds):
        new = share * (likelihood.T @ (counts / (likelihood @ share))) / n
        change = np.abs(new - share).max()
        share = new
        if change < 1e-3:
            break
    return share, float(counts @ np.log(likelihood @ share))


def infer(buckets: np.ndarray, counts: np.ndarray, logs: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The language set (largest first) and the proportions within it, of a
    text given by its distinct buckets and their counts."""
    if not len(buckets):
        return [0], np.array([1 / max(1, logs.shape[1])])
    found = logs[buckets]
    likelihood = np.exp(found - found.max(1, keepdims=True))
    share, _ = mixture(likelihood, counts)
    order = np.argsort(-share, kind="stable")
    # Overlapping n-grams are not independent: a word's worth of them counts as one.
    best, pick = None, None
    for size in range(1, len(order) + 1):
        if size > 1 and share[order[size - 1]] < MIN_SHARE:
            break
        some = order[:size]
        if size == 1:
            part, fit = np.ones(1), float(counts @ np.log(np.maximum(likelihood[:, some[0]], 1e-300)))
        else:
            part, fit = mixture(likelihood[:, some], counts)
        value = fit / GRAM - 0.5 * (size - 1) * math.log(counts.sum())
        if best is None or value > best:
            best, pick = value, (some, part)
    some, part = pick
    turn = np.argsort(-part, kind="stable")
    # Proportions among all languages, so that an unclear text scores low.
    return [int(some[i]) for i in turn], share[some[turn]]


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, and the whole set as
    ``lang_set`` with its proportions ``lang_share``."""
    labels, logs = learn(docs, doc_id, text, label, sample)
    columns, added = without(docs.columns, ADDED), list(ADDED)
    at = columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast((labels, logs.astype(np.float32)))  # BUCKETS numbers per label

    def run(batches):
        labels, logs = shared.value
        for batch in parts(batches, at):
            sets, shares = [], []
            for t in batch.column(at).to_pylist():
                if not labels or t is None or not has_letter(t):
                    sets.append([])
                    shares.append([])
                else:
                    some, share = infer(*gram_counts(t), logs)
                    sets.append([labels[i] for i in some])
                    shares.append([float(min(1.0, x)) for x in share])
            new = [pa.array([s[0] if s else UNDETERMINED for s in sets], pa.string()), pa.array([s[0] if s else 0.0 for s in shares], pa.float64()),
                   pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(columns))] + new, columns + added)

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    schema = ", ".join([*fields, "lang_pred string, score double, lang_set array<string>, lang_share array<double>"])
    return docs.select(*columns).mapInArrow(run, schema)


def op9_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
