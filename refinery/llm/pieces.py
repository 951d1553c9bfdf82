"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file gives pieces, scores and flags; nothing of the library runs.
A batch's texts are cut at white space into words, and each distinct word is
encoded once.  All words' characters lie in one flat array of symbols, cut
into segments wherever two neighbouring characters stand together in no piece
(no merge can cross such a place).  A round finds each segment's best pair
(least rank; a segmented minimum), merges all its leftmost occurrences at
once, compacts the array and looks up only the pairs at the new symbols;
segments without a pair leave the array.  Rounds go on until none is left.

Merging several occurrences at once must equal merging one by one, which the
library does.  A merge can only come between if the symbols it makes form a
pair of the same or a better rank with a neighbour; then the segment's merges
of this round end with that one.  What is still open after ``ROUNDS`` rounds
(segments of very many symbols, such as long runs of spaces) is finished by
an agenda, the same order one by one, so that no text takes quadratic time.

Decoding gathers the pieces' bytes from one table and cuts them per text.

Plan on Spark: one pass without a shuffle.  A task holds batches of about
``PART_BYTES`` of text, or one row, and no cache; the model (half a megabyte)
is broadcast as its file's bytes.

Defined cases: a null or empty text has no ids and decodes to an empty one;
characters without a piece become byte pieces; U+2581 in a text is a space to
the model, so it comes back as one; bytes that are no UTF-8 count as U+FFFD;
repeated rows and ids are each encoded; an empty table gives no rows; other
columns of the input, whatever their names, are not read.  Models that are
not BPE with byte fallback and the identity normaliser, or have user-defined
or unused pieces, are refused.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import gathered, parts, ship

SPACE = "▁"
PART_BYTES = 4 << 20
ROUNDS = 400
NEVER = np.int32(2**31 - 1)
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(raw: bytes):
    """(number, value) of each field of a protocol buffer message."""
    def varint(at):
        value = shift = 0
        while True:
            byte = raw[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class PieceModel:
    """Tables of one model: pair ranks, neighbouring characters, bytes."""

    def __init__(self, raw: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for number, value in _fields(raw):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), struct.unpack("<f", f.get(2, bytes(4)))[0], f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        kinds = {k for _, _, k in pieces}
        # BPE, byte fallback; a dummy prefix, spaces kept and escaped, no character map.
        if (trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24, 0) or kinds & {USER_DEFINED, UNUSED} or normaliser.get(2)
                or (normaliser.get(3, 1), normaliser.get(4, 1), normaliser.get(5, 1)) != (1, 0, 1)):
            raise ValueError("only BPE models with byte fallback, the identity normaliser and no special pieces are supported")
        self.size = len(pieces)
        surface = trainer.get(44, b" \xe2\x81\x87 ")
        self.bytes_of = [t.replace(SPACE, " ").encode() if k == NORMAL else bytes([int(t[3:5], 16)]) if k == BYTE else surface if k == UNKNOWN else b""
                         for t, _, k in pieces]
        self.lengths = np.array([len(b) for b in self.bytes_of])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.silent = np.array([k == CONTROL for _, _, k in pieces])
        self.spaced = np.array([k == NORMAL and t.startswith(SPACE) for t, _, k in pieces])
        self.byte_id = np.zeros(256, np.int32)
        for i, (t, _, k) in enumerate(pieces):
            if k == BYTE:
                self.byte_id[int(t[3:5], 16)] = i
        known = {t: i for i, (t, _, k) in enumerate(pieces) if k == NORMAL}
        # A symbol is a piece, or a character without one: the pieces' number plus its code point.
        self.symbol = np.arange(self.size, self.size + 0x110000, dtype=np.int32)
        for t, i in known.items():
            if len(t) == 1:
                self.symbol[ord(t)] = i
        self.span = self.size + 0x110000
        ranks = np.unique([-s for _, s, _ in pieces], return_inverse=True)[1]
        self.rank_of = np.append(ranks, NEVER).astype(np.int32)  # the last one: no piece
        pairs, near = {}, set()
        for t, i in known.items():
            near.update(zip(t, t[1:]))
            for cut in range(1, len(t)):
                left, right = (int(self.symbol[ord(x)]) if len(x) == 1 else known.get(x, -1) for x in (t[:cut], t[cut:]))
                if left >= 0 and right >= 0:
                    pairs[left * self.span + right] = i
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_piece = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.near = np.array(sorted(ord(a) << 21 | ord(b) for a, b in near), np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        keys = left.astype(np.int64) * self.span + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_piece[at], -1)

    def symbols(self, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The final symbol at the first character of each, -1 at others."""
        final = np.full(len(chars), -1, np.int32)
        if not len(chars):
            return final
        keys = chars[:-1].astype(np.int64) << 21 | chars[1:]
        at = np.minimum(np.searchsorted(self.near, keys), len(self.near) - 1)
        cut = np.zeros(len(chars), bool)
        cut[1:] = self.near[at] != keys
        cut[starts] = True
        sym, seg, pos = self.symbol[chars], np.cumsum(cut) - 1, np.arange(len(chars))
        made = np.full(len(sym), -1, np.int32)
        inner = np.flatnonzero(~cut[1:])
        made[inner] = self.merged(sym[inner], sym[inner + 1])

        for _ in range(ROUNDS):
            rank = self.rank_of[made]
            heads = np.flatnonzero(np.diff(seg, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(heads, append=len(seg)))
            live = best < NEVER
            if not live.all():  # compaction
                final[pos[~live]] = sym[~live]
                sym, seg, pos, made, rank, best = sym[live], seg[live], pos[live], made[live], rank[live], best[live]
            if not len(sym):
                return final
            at = np.flatnonzero(rank == best)
            # Of overlapping occurrences the first, third and so on.
            opens = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            nth = np.arange(len(at)) - np.repeat(opens, np.diff(opens, append=len(at)))
            at = at[nth % 2 == 0]
            new, r = made[at], best[at]
            touches = np.diff(at, prepend=-3) == 2
            before, after = np.maximum(at - 1, 0), np.minimum(at + 2, len(sym) - 1)
            left = np.where(touches, np.roll(new, 1), sym[before])
            has_left = (at > 0) & (seg[before] == seg[at])
            has_right = (at + 2 < len(sym)) & (seg[after] == seg[at])
            with_left = np.where(has_left & (~touches | (seg[np.maximum(at - 2, 0)] == seg[at])), self.rank_of[self.merged(left, new)], NEVER)
            with_right = np.where(has_right, self.rank_of[self.merged(new, sym[after])], NEVER)
            comes_between = (with_left <= r) | (with_right <= r)
            if comes_between.any():
                earlier = np.cumsum(comes_between) - comes_between
                groups = np.flatnonzero(np.diff(seg[at], prepend=-1))
                own = earlier - np.repeat(earlier[groups], np.diff(groups, append=len(at)))
                at, new = at[own == 0], new[own == 0]
            sym[at] = new
            kept = np.ones(len(sym), bool)
            kept[at + 1] = False
            place = np.cumsum(kept) - 1
            sym, seg, pos, made = sym[kept], seg[kept], pos[kept], made[kept]
            near = np.zeros(len(sym), bool)
            near[place[at]] = True
            near[:-1] |= near[1:]
            fresh = np.flatnonzero(near)
            nxt = np.minimum(fresh + 1, len(sym) - 1)
            inside = (fresh + 1 < len(sym)) & (seg[nxt] == seg[fresh])
            made[fresh] = np.where(inside, self.merged(sym[fresh], sym[nxt]), -1)

        heads = np.flatnonzero(np.diff(seg, prepend=-1)).tolist()
        for a, b in zip(heads, heads[1:] + [len(seg)]):
            where, what = self._agenda(sym[a:b].tolist())
            final[pos[a:b][where]] = what
        return final

    def _agenda(self, sym: list[int]) -> tuple[list[int], list[int]]:
        """Places and symbols left after merging pairs one by one."""
        n = len(sym)
        before, after, rank_of = list(range(-1, n - 1)), list(range(1, n + 1)), self.rank_of
        table = getattr(self, "_pairs", None)
        if table is None:
            table = self._pairs = dict(zip(self.pair_keys.tolist(), self.pair_piece.tolist()))
        heap = []

        def offer(i):
            j = after[i]
            if j < n:
                piece = table.get(sym[i] * self.span + sym[j])
                if piece is not None:
                    heapq.heappush(heap, (int(rank_of[piece]), i, sym[i], sym[j], piece))

        for i in range(n):
            offer(i)
        gone = [False] * n
        while heap:
            _, i, left, right, piece = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or sym[i] != left or sym[j] != right:
                continue
            sym[i], gone[j], after[i] = piece, True, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        where = [i for i in range(n) if not gone[i]]
        return where, [sym[i] for i in where]

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, each after one space, and each one's first place."""
        sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        starts = np.cumsum(sizes) - sizes
        chars = np.full(int(sizes.sum()), ord(SPACE), np.uint32)
        inside = np.ones(len(chars), bool)
        inside[starts] = False
        chars[inside] = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
        chars[chars == 32] = ord(SPACE)
        final = self.symbols(chars, starts)
        at = np.flatnonzero(final >= 0)
        sym = final[at].astype(np.int64)
        loose = sym >= self.size
        points = np.where(loose, sym - self.size, 0)
        width = np.where(loose, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), 1)
        ends = np.cumsum(width)
        ids = np.repeat(np.where(loose, 0, sym), width)
        odd = np.flatnonzero(loose)
        if len(odd):
            raw = np.frombuffer("".join(map(chr, points[odd].tolist())).encode(), np.uint8)
            ids[np.repeat(loose, width)] = self.byte_id[raw]
        counts = np.add.reduceat(width, np.searchsorted(at, starts)) if len(starts) else np.zeros(0, np.int64)
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])

    def encode(self, texts: pa.Array) -> pa.Array:
        """Lists of ids."""
        texts = pc.replace_substring(pc.fill_null(_readable(texts), ""), SPACE, " ")
        lists = pc.split_pattern(texts, " ")
        pieces = pc.list_flatten(lists)
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        parent = np.repeat(np.arange(len(sizes)), sizes)
        # A word starts with all spaces before it; those at the end of a text are one more.
        ends = pc.not_equal(pieces, "").to_numpy(zero_copy_only=False)
        ends[np.cumsum(sizes) - 1] = True
        ends &= pc.not_equal(texts, "").to_numpy(zero_copy_only=False)[parent]
        at = np.flatnonzero(ends)
        opens = np.maximum(np.concatenate([[-1], at[:-1]]) + 1, (np.cumsum(sizes) - sizes)[parent[at]])
        words, spaces = pieces.take(pa.array(at)), at - opens
        if spaces.any():
            words = pc.binary_join_element_wise(pc.binary_repeat(pa.array([" "] * len(at), pa.string()), pa.array(spaces)), words, "")
        coded = words.dictionary_encode()
        table, first = self.word_ids(coded.dictionary)
        which = coded.indices.to_numpy(zero_copy_only=False)
        n = np.diff(first)[which]
        stops = np.cumsum(n)
        ids = table[np.repeat(first[which] - (stops - n), n) + np.arange(int(n.sum()))]
        offsets = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(np.bincount(parent[at], minlength=len(sizes)))])]
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))

    def decode(self, lists: pa.Array) -> pa.Array:
        """Texts of lists of ids."""
        ids = pc.fill_null(pc.list_flatten(lists), 0).to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        n = self.lengths[ids]
        stops = np.concatenate([[0], np.cumsum(n)])
        data = self.flat[np.repeat(self.first[ids] - stops[:-1], n) + np.arange(int(stops[-1]))]
        bounds = stops[np.concatenate([begin, [len(ids)]])]
        # The space before a text's first piece that is not a control piece goes.
        lead, end = begin.copy(), begin + sizes
        while len(skip := np.flatnonzero((lead < end) & self.silent[ids[np.minimum(lead, max(len(ids) - 1, 0))]] if len(ids) else [])):
            lead[skip] += 1
        strip = np.zeros(len(sizes), bool)
        some = lead < end
        strip[some] = self.spaced[ids[lead[some]]]
        kept = np.ones(len(data), bool)
        kept[bounds[:-1][strip]] = False
        data = data[kept]
        bounds = bounds - np.concatenate([[0], np.cumsum(strip)])
        out = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        try:
            if self.silent[ids].any():
                raise pa.ArrowInvalid("control pieces part the bytes around them")
            out.validate(full=True)
        except pa.ArrowInvalid:
            out = pa.array([self._slowly(ids[a : a + n].tolist(), cut) for a, n, cut in zip(begin.tolist(), sizes.tolist(), strip.tolist())], pa.string())
        return out

    def _slowly(self, ids: list[int], strip: bool) -> str:
        """One text whose byte pieces may be no characters."""
        runs = [[]]
        for i in ids:
            if self.silent[i]:
                runs.append([])
            else:
                runs[-1].append(self.bytes_of[i])
        text = "".join(_lossy(b"".join(run)) for run in runs)
        return text[1:] if strip else text


def _lossy(raw: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _readable(texts: pa.Array) -> pa.Array:
    try:
        texts.validate(full=True)
        return texts
    except pa.ArrowInvalid:
        return pa.array([None if b is None else _lossy(b) for b in texts.cast(pa.binary()).to_pylist()], pa.string())


_MODELS: dict[int, PieceModel] = {}


def _shared(spark, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # the model file, whatever the input's size


def _loaded(shared) -> PieceModel:
    key = hash(shared.value)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = PieceModel(shared.value)
    return _MODELS[key]


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (without begin or end) of every row."""
    spark = ship(docs.sparkSession)
    shared = _shared(spark, model)

    def run(batches):
        tables = _loaded(shared)
        for batch in parts(gathered(batches, 1, PART_BYTES), 1, PART_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0), tables.encode(batch.column(1))], ["doc_id", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(coded: DataFrame, model: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``coded`` with the text ``into`` that its ids stand for (a null list:
    empty; a column of that name is replaced)."""
    spark = ship(coded.sparkSession)
    shared = _shared(spark, model)
    columns = [c for c in coded.columns if c.lower() != into.lower()]
    at = columns.index(ids)

    def run(batches):
        tables = _loaded(shared)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, tables.decode(batch.column(at))], [*columns, into])

    fields = [f"`{c}` {coded.schema[c].dataType.simpleString()}" for c in columns]
    return coded.select(*columns).mapInArrow(run, ", ".join([*fields, f"`{into}` string"]))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_pieces(spark, sf_dir):
    model = default_model()
    found = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), model), model)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))
