"""Vector codes by k-means per part, accelerated by metric trees.

A vector's components become integers (``floor(scale * x)``) and are cut into
``parts`` equal consecutive parts.  Each part position has a codebook of
``entries`` entries, started from the rows of the smallest ids and moved
``rounds`` times to the floor of the mean of what it owns; a row's code is its
nearest entry per part (squared Euclidean distance, ties to the lower index).

Trees (the anchors hierarchy): rows lie in blocks of ``BLOCK``; a block's
distinct points of one part position form one tree.  Built middle-out: about
sqrt(n) anchors, each new one at the point farthest from its anchor and
stealing the points that are nearer to it (an anchor whose farthest point lies
within half the distance between the anchors has none to lose); anchors then
merge pairwise, nearest first, up to a root, and split the same way down to
``LEAF`` points.  Every ball keeps its points' count and component sums, so
an entry that owns a whole ball takes them without a look at the points.

Assignment walks down with a list of candidate entries inherited from the
parent ball: entry c leaves the list if some entry b is nearer to every point
of the ball, that is if |p-c|^2 - |p-b|^2 > 2 R |b-c| for its centre p and
radius R, by more than rounding can amount to.  A ball left with one candidate
is owned; leaves compare what is left in exact integers.  So codes, sums and
errors are those of a plain scan.

Plan on Spark: blocks with their trees are built in one pass and written
(a lost executor reads them again); a round is one pass over them with the
codebooks broadcast (``parts * entries`` entries, a parameter), each task
sending its totals once; the driver sees one total per entry and component.
The codes are one more pass.  No shuffle moves a vector; equal labels are
summed with a partial aggregate, so a label held by a third of all rows is no
single task.

Defined cases: rows whose vector is null or holds a null or non-finite
component are left out, as are those of another length than the commonest one
that ``parts`` divides (ties: the shorter); a null id or label is a value like
others; repeated rows and ids are each coded; with fewer rows than ``entries``
the codebooks are as short; integers are held within a bound (``limit``) that
keeps every sum of squares in 64 bits, 2^27 at 64 components; an empty table
gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch, release, ship

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0
BLOCK, LEAF = 4096, 32


def limit(components: int) -> int:
    """The largest size of an integer component."""
    return math.isqrt((2**63 - 1) // components) // 2


class BallTree:
    """The balls over some points (integers, distinct), parents first.  Ball i
    holds the points ``start[i]:stop[i]`` of ``points``; ``left[i]`` and
    ``right[i]`` are its halves, -1 at a leaf."""

    def __init__(self, points: np.ndarray, weights: np.ndarray, leaf: int = LEAF):
        self.leaf, self._at = leaf, points.astype(np.float64)
        self.order = np.zeros(0, np.int64)
        root = self._grow(np.arange(len(points)))
        # Parents first, points in the order of the leaves.
        self.left, self.right, centres, radii, starts, stops, order, place = [], [], [], [], [], [], [], 0
        stack = [(root, -1, False)]
        while stack:
            (centre, radius, members, halves), parent, is_right = stack.pop()
            me = len(centres)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = me
            centres.append(centre)
            radii.append(radius)
            starts.append(place)
            stops.append(place + len(members))
            self.left.append(-1)
            self.right.append(-1)
            if halves:
                stack += [(halves[1], me, True), (halves[0], me, False)]
            else:
                order.append(members)
                place += len(members)
        self.order = np.concatenate(order)
        self.points, self.weights = points[self.order], weights[self.order]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.start, self.stop = np.array(starts), np.array(stops)
        total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(self.points * self.weights[:, None], axis=0)])
        self.sums = total[self.stop] - total[self.start]
        count = np.concatenate([[0], np.cumsum(self.weights)])
        self.counts = count[self.stop] - count[self.start]
        del self._at

    def _ball(self, members: np.ndarray, halves=None):
        points = self._at[members]
        centre = points.mean(0)
        return centre, math.sqrt(((points - centre) ** 2).sum(1).max()), members, halves

    def _grow(self, members: np.ndarray):
        if len(members) <= self.leaf:
            return self._ball(members)
        anchors = self._anchors(members)
        if len(anchors) == 1:
            return self._ball(members)
        balls = [self._grow(owned) for owned in anchors]
        # Middle-out, upwards: the two balls whose union is smallest become one.
        while len(balls) > 1:
            centres, radii = np.array([b[0] for b in balls]), np.array([b[1] for b in balls])
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2)) + radii[:, None] + radii[None]
            np.fill_diagonal(apart, np.inf)
            # Every ball that is the nearest of its nearest merges at once.
            nearest = apart.argmin(1)
            pairs = [(i, j) for i, j in enumerate(nearest.tolist()) if i < j and nearest[j] == i]
            if not pairs:
                i, j = divmod(int(apart.argmin()), len(balls))
                pairs = [(min(i, j), max(i, j))]
            gone = {i for pair in pairs for i in pair}
            merged = [self._ball(np.concatenate([balls[i][2], balls[j][2]]), (balls[i], balls[j])) for i, j in pairs]
            balls = [b for i, b in enumerate(balls) if i not in gone] + merged
        return balls[0]

    def _anchors(self, members: np.ndarray) -> list[np.ndarray]:
        """The members by anchor; each anchor's from the farthest inwards."""
        def owned(place, rows, far):
            order = np.argsort(-far, kind="stable")
            return place, rows[order], far[order]

        first = self._at[members[0]]
        anchors = [owned(first, members, np.sqrt(((self._at[members] - first) ** 2).sum(1)))]
        for _ in range(math.isqrt(len(members) - 1)):
            widest = max(range(len(anchors)), key=lambda i: anchors[i][2][0])
            if anchors[widest][2][0] == 0:
                break
            place = self._at[anchors[widest][1][0]]
            rows, far = [], []
            for i, (other, own, away) in enumerate(anchors):
                half = math.sqrt(((place - other) ** 2).sum()) / 2
                near = int(np.searchsorted(-away, -half, "right"))  # points farther from their anchor than that
                if near:
                    there = np.sqrt(((self._at[own[:near]] - place) ** 2).sum(1))
                    takes = there < away[:near]
                    if takes.any():
                        rows.append(own[:near][takes])
                        far.append(there[takes])
                        stays = np.concatenate([~takes, np.ones(len(own) - near, bool)])
                        anchors[i] = other, own[stays], away[stays]
            anchors = [a for a in anchors if len(a[1])]
            anchors.append(owned(place, np.concatenate(rows), np.concatenate(far)))
        return [own for _, own, _ in anchors]

    def owners(self, codebook: np.ndarray):
        """(ball, start, stop, entries) of every owned ball (one number) and
        every leaf's points (an array)."""
        firsts = np.sort(np.unique(codebook, axis=0, return_index=True)[1])  # equal entries: only the lowest can win
        entries = codebook.astype(np.float64)
        apart = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(2))
        size = 1.0 + np.abs(entries).max() + (np.abs(self.centres).max() if len(self.centres) else 0.0)
        slack = size * size * entries.shape[1] * 1e-12
        stack = [(0, firsts)]
        while stack:
            ball, kept = stack.pop()
            far = ((entries[kept] - self.centres[ball]) ** 2).sum(1)
            best = int(far.argmin())
            kept = kept[far - far[best] <= 2 * self.radii[ball] * apart[kept, kept[best]] + slack]
            start, stop = int(self.start[ball]), int(self.stop[ball])
            if len(kept) == 1:
                yield ball, start, stop, int(kept[0])
            elif self.left[ball] < 0:
                gaps = self.points[start:stop, None, :] - codebook[kept][None]
                yield ball, start, stop, kept[(gaps * gaps).sum(2).argmin(1)]
            else:
                stack += [(self.left[ball], kept), (self.right[ball], kept)]

    def totals(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and component sums of what each entry owns."""
        counts, sums = np.zeros(len(codebook), np.int64), np.zeros(codebook.shape, np.int64)
        for ball, start, stop, entry in self.owners(codebook):
            if isinstance(entry, int):
                counts[entry] += self.counts[ball]
                sums[entry] += self.sums[ball]
            else:
                w = self.weights[start:stop]
                np.add.at(counts, entry, w)
                np.add.at(sums, entry, self.points[start:stop] * w[:, None])
        return counts, sums

    def codes(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each point, in the order given."""
        found = np.zeros(len(self.points), np.int64)
        for _, start, stop, entry in self.owners(codebook):
            found[start:stop] = entry
        gaps = self.points - codebook[found]
        back = np.empty(len(found), np.int64)
        back[self.order] = np.arange(len(found))
        return found[back], (gaps * gaps).sum(1)[back]


def _trees(rows: np.ndarray, parts: int) -> bytes:
    """A block's trees and, per part position, each row's point."""
    out = []
    for part in np.split(rows, parts, axis=1):
        points, which, counts = np.unique(part, axis=0, return_inverse=True, return_counts=True)
        out.append((BallTree(points, counts.astype(np.int64)), which.reshape(-1).astype(np.int32)))
    return pickle.dumps(out, protocol=5)


def usable(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: float) -> DataFrame:
    """``vec_id``, ``label`` and the integer components ``x`` (in doubles, not
    held within the limit yet) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(vector).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(fine).select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.transform(v, lambda x: x * F.lit(scale)).alias("x"))


def _integers(column, most: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.clip(np.floor(flat), -most, most).astype(np.int64)


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): ``vec_id``, ``label``, ``code`` (array of entry
    numbers) and ``error`` of every row that takes part, and the codebooks as
    an array of (part, entry, component)."""
    spark = ship(vectors.sparkSession)
    scratch = Scratch(spark, "codes")
    id_kind, label_kind = vectors.schema[vec_id].dataType, vectors.schema[label].dataType
    out = f"vec_id {id_kind.simpleString()}, label {label_kind.simpleString()}, code array<int>, error long"
    rows = usable(vectors, vec_id, vector, label, scale)
    sizes = rows.groupBy(F.size("x").alias("d")).count().where((F.col("d") > 0) & (F.col("d") % parts == 0)).orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], out), np.zeros((parts, 0, 0), np.int64)
    d = sizes["d"]
    rows, most = rows.where(F.size("x") == d), limit(d)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()  # ``entries`` rows
    start = np.clip(np.floor(np.array([r["x"] for r in first], np.float64)), -most, most).astype(np.int64)
    books = np.stack(np.split(start, parts, axis=1))  # part, entry, component

    def build(batches):
        held, n = [], 0
        for batch in batches:
            held, n = held + [batch], n + batch.num_rows
            while n >= BLOCK:
                table = pa.Table.from_batches(held)
                yield _block(table.slice(0, BLOCK), most, parts)
                held, n = table.slice(BLOCK).to_batches(), n - BLOCK
        if n:
            yield _block(pa.Table.from_batches(held), most, parts)
        release()

    schema = f"ids array<{id_kind.simpleString()}>, labels array<{label_kind.simpleString()}>, trees binary"
    blocks = scratch.put(rows.mapInArrow(build, schema), "blocks")

    for _ in range(rounds):
        sums = _totals(blocks, books)
        for r in sums.collect():  # a row per entry and component
            books[r["part"], r["entry"], r["axis"]] = int(r["total"]) // int(r["n"])

    shared = spark.sparkContext.broadcast(books)

    def code(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column(0).slice(i, 1).flatten(), batch.column(1).slice(i, 1).flatten()
                codes, error = np.zeros((len(ids), parts), np.int32), np.zeros(len(ids), np.int64)
                for k, (tree, which) in enumerate(pickle.loads(batch.column(2)[i].as_py())):
                    entry, far = tree.codes(shared.value[k])
                    codes[:, k] = entry[which]
                    error += far[which]
                offsets = pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1))), pa.array(error)],
                                                 ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(code, out), books


def _block(table: pa.Table, most: int, parts: int) -> pa.RecordBatch:
    table = table.combine_chunks()
    columns = [table.column(k).chunk(0) for k in range(3)]
    offsets = pa.array([0, table.num_rows], pa.int32())
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, columns[0]), pa.ListArray.from_arrays(offsets, columns[1]),
                                       pa.array([_trees(_integers(columns[2], most), parts)], pa.binary())], ["ids", "labels", "trees"])


def _totals(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``n`` and ``total`` per part, entry and component, of entries that own
    something."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        counts, sums, any_ = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64), False
        for batch in batches:
            for raw in batch.column(0):
                any_ = True
                for k, (tree, _) in enumerate(pickle.loads(raw.as_py())):
                    c, s = tree.totals(books[k])
                    counts[k] += c
                    sums[k] += s
        if any_:
            part, entry = np.nonzero(counts)
            axes = books.shape[2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part, axes).astype(np.int32)), pa.array(np.repeat(entry, axes).astype(np.int32)),
                 pa.array(np.tile(np.arange(axes, dtype=np.int32), len(part))), pa.array(np.repeat(counts[part, entry], axes)),
                 pa.array(sums[part, entry].reshape(-1))], ["part", "entry", "axis", "n", "total"])
        release()

    found = blocks.select("trees").mapInArrow(run, "part int, entry int, axis int, n long, total long")
    return found.groupBy("part", "entry", "axis").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the errors summed over equal labels."""
    sums = codes.groupBy(F.col("label").alias("__label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("__sum"))
    held = F.least("__sum", F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    return codes.join(sums.hint("rebalance"), F.col("label").eqNullSafe(F.col("__label"))).withColumn("label_error", held).drop("__label", "__sum")


def op12_codes(spark, sf_dir):
    found, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    two = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")), "")
    return with_label_error(found).select("vec_id", two.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    return f"""
near{k} as (
  select x.id, x.part, b.entry, list_sum(list_transform(range(1, len(x.c) + 1), lambda i: (x.c[i] - b.c[i]) * (x.c[i] - b.c[i]))) as far,
         row_number() over (partition by x.id, x.part order by far, b.entry) as nth
  from parts x join book{k} b on b.part = x.part),
owned{k} as (select id, part, entry, far from near{k} where nth = 1)"""


def _move_sql(k: int) -> str:
    return f"""
mean{k} as (
  select part, entry, list(m order by axis) as c from (
    select o.part, o.entry, a.axis, cast(floor(sum(x.c[a.axis]) / cast(count(*) as double)) as bigint) as m
    from owned{k} o join parts x on x.id = o.id and x.part = o.part cross join (select unnest(range(1, 1 + (select max(len(c)) from parts))) as axis) a
    group by o.part, o.entry, a.axis) group by part, entry),
book{k + 1} as (
  select b.part, b.entry, coalesce(m.c, b.c) as c from book{k} b left join mean{k} m on m.part = b.part and m.entry = b.entry)"""


OP12_SQL = f"""
with kept as (
  select row_number() over (order by vec_id) as id, vec_id, label, list_transform(embedding, lambda x: cast(floor(256.0 * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (
  select id, p.part, v[p.part * (len(v) // {PARTS}) + 1 : (p.part + 1) * (len(v) // {PARTS})] as c
  from kept cross join (select unnest(range({PARTS})) as part) p),
book0 as (select part, id - 1 as entry, c from parts where id <= {ENTRIES}),
{_round_sql(0)},
{_move_sql(0)},
{_round_sql(1)},
{_move_sql(1)},
{_round_sql(2)},
books as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as h from book2),
coded as (
  select id, string_agg(format('{{:02x}}', entry), '' order by part) as code, cast(sum(far) as bigint) as error from owned2 group by id)
select k.vec_id, c.code, c.error, cast(sum(c.error) over (partition by k.label) as bigint) as label_error, h as codebooks_sha256
from coded c join kept k on k.id = c.id cross join books
"""
