"""Best-fit packing planned on the length histogram.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
Only the histogram of piece lengths (at most ``capacity`` numbers) goes to the
driver, where best-fit decreasing runs over counts: bins of equal content are
one group, and a step places as many equal pieces into as many equal bins as
it can.  The plan says which ranks within a length go to which sequences;
pieces then take their slot by rank.

Plan on Spark: tokenising is one pass without a shuffle; its narrow result
(no ids unless asked for) is written once with a row number, so ranks are the
same after a retry.  Ranks come in two levels, so that a length held by a
third of all pieces is no single task: pieces are dealt into buckets of about
``BUCKET_ROWS``, ranked within (length, bucket), and a window over the counts
per bucket gives each bucket's first rank.  The planned slot is found in the
plan's sorted arrays, whose size depends on ``capacity`` alone.

Tokenising: no pretoken of this tokenizer spans white space, so each distinct
word is encoded once by the library and kept in a bounded cache; the result
equals encoding the whole text (tested).  Special tokens' strings in a text
get the tokenizer's own ids, as its ``encode`` does by default.

Defined cases: a null or empty text is the end id alone; repeated rows and
ids are packed each; an empty table gives no pieces; longer documents are cut
into ``capacity`` pieces, whole; added columns replace input columns of their
names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, gathered, parts, ship, without

CAPACITY = 4096
END_ID = 1
BUCKET_ROWS = 50_000
CACHE_BYTES = 48 << 20
PART_BYTES = 6 << 20
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEncoder:
    """Token ids of texts, encoding each distinct word once."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {"": b""}
        self.held = 0  # bytes of the cache, about
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _plain(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, letters: list[str], others: list[str]) -> None:
        """Encodes new words.  A word of Latin letters alone is one pretoken,
        so many are encoded as one text, each ending at a token that ends a
        word."""
        odd = [w for w in letters if not w.isascii() and (max(w) >= "\u0250" or "\u0130" in w)]
        letters = [w for w in letters if w.isascii() or (max(w) < "\u0250" and "\u0130" not in w)]
        if letters:
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(letters)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) == len(letters):
                raw = ids.tobytes()
                self.cache.update(zip(letters, [raw[a:b] for a, b in zip([0, *ends], ends)]))
                self.held += sum(map(len, letters)) + len(raw) + 200 * len(letters)
            else:
                odd += letters
        for w in odd + others:
            self.cache[w] = self._plain(w)
            self.held += len(w) + len(self.cache[w]) + 200

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (little-endian uint32) and each text's first place."""
        texts = pc.fill_null(texts, "")
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        if self.held > CACHE_BYTES:
            self.cache, self.held = {"": b""}, 0
        cache, heads, tails, letters, others = self.cache, [], [], set(), set()
        for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist():
            # What follows a word's last letter as ASCII punctuation is a pretoken of its own.
            stem = w.rstrip(PUNCTUATION)
            if stem.isalpha():
                tail = w[len(stem):]
                if stem not in cache:
                    letters.add(stem)
                if tail not in cache:
                    others.add(tail)
            else:
                stem, tail = w, ""
                if w not in cache:
                    others.add(w)
            heads.append(stem)
            tails.append(tail)
        self._learn(list(letters), list(others))
        by_word = [cache[h] + cache[t] for h, t in zip(heads, tails)]
        sizes = np.fromiter(map(len, by_word), np.int64, len(by_word)) // 4
        table = np.frombuffer(b"".join(by_word), "<u4")
        first = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[at]
        ends = np.cumsum(n)
        ids = table[np.repeat(first[at] - (ends - n), n) + np.arange(int(n.sum()))]
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]


_ENCODERS: dict[str, WordEncoder] = {}


def token_pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if
    asked for, ``ids`` (little-endian uint32) of every piece."""
    ship(docs.sparkSession)
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length int, ids_crc32 long" + ", ids binary" * with_ids
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches):
        encoder = _ENCODERS.get(tokenizer)
        if encoder is None:
            encoder = _ENCODERS[tokenizer] = WordEncoder(tokenizer)
        for batch in parts(gathered(batches, 1, PART_BYTES), 1, PART_BYTES):
            rows = {k: [] for k in ("at", "piece", "start", "length", "crc", "ids")}
            flat, first = encoder.encode(batch.column(1))
            for i, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
                ids = flat[a:b].tobytes() + end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    for k, v in zip(rows, (i, piece, start // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)):
                        rows[k].append(v)
            out = [batch.column(0).take(pa.array(rows["at"], pa.int32())), pa.array(rows["piece"], pa.int32()), pa.array(rows["start"], pa.int64()),
                   pa.array(rows["length"], pa.int32()), pa.array(rows["crc"], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(rows["ids"], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(cut, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.  Rows (length, first_rank, n, each,
    first_sequence, offset): the ``n`` pieces of this length from that rank go
    ``each`` to a sequence, from that sequence on, from that offset."""
    out, bins, rooms, sequences = [], {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in bins:
                bins[room] = []
                insort(rooms, room)
            bins[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            each = room // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, full * each, each, first, capacity - room))
                put(room - each * length, first, full)
                left, rank = left - full * each, rank + full * each
            if full < n and left and left < each:
                out.append((length, rank, left, each, first + full, capacity - room))
                put(room - left * length, first + full, 1)
                left, full = 0, full + 1
            put(room, first + full, n - full)
    return out


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` and a unique, stored ``__row``) with
    ``sequence_id`` and ``offset``."""
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    rows = np.array(plan(histogram, capacity), np.int64).reshape(-1, 6)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    shift = 1 << 44
    keys = rows[:, 0] * shift + rows[:, 1]
    buckets = max(1, -(-sum(histogram.values()) // BUCKET_ROWS))
    dealt = pieces.withColumn("__bucket", F.pmod(F.xxhash64("__row"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(F.col("length").alias("__l"), F.col("__bucket").alias("__b")).count()
    before = Window.partitionBy("__l").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__l", "__b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"))
    within = F.row_number().over(Window.partitionBy("length", "__bucket").orderBy("__row")) - 1
    ranked = dealt.withColumn("__within", within).join(first, (F.col("length") == F.col("__l")) & (F.col("__bucket") == F.col("__b")))
    columns = without(pieces.columns, ("__row", "sequence_id", "offset"))
    ranked = ranked.select(*columns, (F.col("__first") + F.col("__within")).cast("long").alias("__rank"))

    def slots(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False)
            slot = rows[np.searchsorted(keys, length * shift + rank, "right") - 1]
            i = rank - slot[:, 1]
            new = [pa.array(slot[:, 4] + i // slot[:, 3]), pa.array(slot[:, 5] + i % slot[:, 3] * length)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + new, [*columns, "sequence_id", "offset"])

    fields = [f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in columns]
    return ranked.mapInArrow(slots, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: columns of
    :func:`token_pieces`, ``sequence_id`` and ``offset``."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = token_pieces(docs, tokenizer, doc_id, text, capacity, with_ids)
    pieces = scratch.put(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    return assign_sequences(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and ``ids``; a group
    holds at most one sequence's tokens."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("__p"))
    joined = F.aggregate("__p", F.lit(b"").cast("binary"), lambda s, p: F.concat(s, p["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_best_fit(spark, sf_dir):
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
    return packed.withColumn("length", F.col("length").cast("long"))
