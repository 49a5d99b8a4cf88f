"""Hard negatives from an inverted multi-index (operator 11).

A vector's two halves are each coded by a codebook fitted on a bounded sample; a pair of code words is a cell, and every row
lies in one. A cell's rows score at most the sum of its two half scores, each with the radius of its half; a multi-sequence
heap visits an anchor's cells by falling sums. Two rounds make a search: the first cells of the heap, until they hold
`seed_rows` rows, give the score that counts (of the last positive, or of the last negative of each window); the second
round goes on until the sum falls below it, which certifies the windows. So the lists are exact, whatever the codebooks.

Cells are dealt into shards of equal size: small neighbours share one, a cell with many rows has several. An anchor is sent
to the shards of the cells that it visits, with these cells, and a task holds one shard while anchors stream through it.

Rows: those with a null id, label, vector or component, or a component that is not finite, take no part; nor do empty
vectors and those of another length than most (of lengths equally common the greatest counts). Of rows with one id that with
the least (label, components) stands. Scores are 64-bit sums of 256 times the components, rounded down. Ties go to the
smaller id. Empty tables give no rows; further columns take no part, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep, scratch, stage


@dataclass(frozen=True)
class MinePolicy:
    positives: int = 5
    negatives: int = 10
    low: int = 30  # a negative scores low to high percent of the positive
    high: int = 90
    codewords: int = 64
    sample: int = 20_000  # rows that the codebooks are fitted on, with sample_values components at most
    sample_values: int = 1 << 22
    seed_rows: int = 4096
    shards: int = 24  # at least, for tables of so many rows
    shard_rows: int = 131_072


OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def fit_codebook(half: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centres of k-means over the distinct rows of half."""
    if not half.shape[1] or not len(half):
        return np.zeros((1, half.shape[1]))
    rows = np.unique(half.astype(np.float64), axis=0)
    centres = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)]
    for _ in range(rounds):
        near = nearest(rows, centres)[0]
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, distance to it, rounded up) of each row."""
    wide = (centres**2).sum(1) - 2 * rows @ centres.T
    near = wide.argmin(1)
    return near, np.sqrt(((rows - centres[near]) ** 2).sum(1)) * (1 + 1e-9) + 1e-9


@dataclass
class Cells:
    """What the router knows: codebooks, and of every cell its rows, radii and shards."""

    first: np.ndarray
    second: np.ndarray
    rows: dict[int, int]
    radii: dict[int, tuple[float, float]]
    shards: dict[int, tuple[int, int]]

    def __post_init__(self):
        self.wide = np.zeros(len(self.first)), np.zeros(len(self.second))
        for cell, pair in self.radii.items():
            for side, code in enumerate(divmod(cell, len(self.second))):
                self.wide[side][code] = max(self.wide[side][code], pair[side])

    def visit(self, vector: np.ndarray) -> Iterator[tuple[int, float, float, float]]:
        """(cell, bound of what follows, own upper and lower bound) of all cells that have rows, by falling sums of half scores."""
        h = self.first.shape[1]
        parts = self.first @ vector[:h], self.second @ vector[h:]
        norms = [float(np.sqrt((x**2).sum())) for x in (vector[:h], vector[h:])]
        bounds = [p + n * w for p, n, w in zip(parts, norms, self.wide, strict=True)]
        orders = [np.argsort(-b, kind="stable").tolist() for b in bounds]
        a, b = ([bound[i] for i in order] for bound, order in zip(bounds, orders, strict=True))
        slack = 1e-9 * (1 + sum(float(np.abs(x).max()) for x in bounds)) + 1e-6
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if not j and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
            cell = orders[0][i] * len(self.second) + orders[1][j]
            if cell in self.rows:
                middle = parts[0][orders[0][i]] + parts[1][orders[1][j]]
                reach = norms[0] * self.radii[cell][0] + norms[1] * self.radii[cell][1] + slack
                yield cell, slack - bound, middle + reach, middle - reach


def _floor_div(x: Column, by: int) -> Column:
    """Whole-number division that rounds down."""
    return F.call_function("div", x - F.pmod(x, F.lit(by)), F.lit(by))


_MESSAGE = "shard int, kind int, cell int, id bigint, label bigint, q array<bigint>, cells array<int>, low array<bigint>, high array<bigint>"


def _route(cells: Cells, policy: MinePolicy, certify: bool):
    """Messages of anchors (id, label, q, low, high) to shards. low and high: the scores that still count, for each list that is sought; certify: the second round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, label, q, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sought = [(lo, hi) for lo, hi in zip(low, high, strict=True) if lo <= hi]
                least = min((lo for lo, _ in sought), default=None)
                to: dict[int, list[int]] = {}
                seen = 0
                for cell, bound, upper, lower in cells.visit(np.asarray(q, np.float64)):
                    if least is None or bound < least or not certify and seen >= policy.seed_rows:
                        break
                    first = seen < policy.seed_rows
                    fits = any(upper >= lo and lower <= hi for lo, hi in sought) if certify else upper >= least
                    if not certify and not fits:
                        continue
                    seen += cells.rows[cell]
                    if fits and first != certify:
                        shard, parts = cells.shards[cell]
                        for s in range(shard, shard + parts):
                            to.setdefault(s, []).append(cell)
                out += [(s, 1, None, anchor, label, q, found, low, high) for s, found in to.items()]
            names = [c.split()[0] for c in _MESSAGE.split(", ")]
            types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return run


class Shard:
    """Rows of one shard, by cell."""

    def __init__(self, rows: list[pa.RecordBatch], dims: int):
        table = pa.Table.from_batches(rows)
        self.ids, self.labels, cell = (table[c].to_numpy() for c in ("id", "label", "cell"))
        whole = table["q"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        self.most = max(int(whole.max(initial=0)), -int(whole.min(initial=0)))
        self.exact = self.most * dims < 1 << 30  # then doubles hold every sum with vectors of up to 2^23
        self.matrix = whole.astype(np.float64) if self.exact else whole
        codes, begin = np.unique(cell, return_index=True)
        self.range = {c: (b, e) for c, b, e in zip(codes.tolist(), begin.tolist(), [*begin.tolist()[1:], len(cell)], strict=True)}

    def scores(self, vector: np.ndarray, cells: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(rows, their scores) of some cells; in doubles where these hold every sum exactly."""
        ranges = [self.range[c] for c in cells if c in self.range]
        if not ranges:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = np.concatenate([np.arange(b, e) for b, e in ranges])
        if self.exact and max(int(vector.max(initial=0)), -int(vector.min(initial=0))) <= 1 << 23:
            return rows, (self.matrix[rows] @ vector.astype(np.float64)).astype(np.int64)
        return rows, self.matrix[rows].astype(np.int64) @ vector


def _search(dims: int, same: bool, k: int):
    """anchor_id, place, other_id, score: the first k rows of each list of an anchor in one shard, with its label (same) or others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number, shard = [], None, None
        for batch in batches:
            kind = batch.column(1).to_numpy()
            at = batch.column(0).to_numpy()
            for i, j in _stretches(at, kind):
                if at[i] != number:
                    held, number, shard = [], at[i], None
                part = batch.slice(i, j - i)
                if not kind[i]:
                    held.append(part)
                    continue
                if shard is None and held:
                    shard, held = Shard(held, dims), []
                out = []
                if shard:
                    for anchor, label, q, cells, low, high in zip(*(part.column(c).to_pylist() for c in range(3, 9)), strict=True):
                        rows, score = shard.scores(np.asarray(q, np.int64), cells)
                        other = (shard.ids[rows] != anchor) & (shard.labels[rows] == label) if same else shard.labels[rows] != label
                        other &= (score >= min(low)) & (score <= max(high))
                        ids, score = shard.ids[rows[other]], score[other]
                        order = np.lexsort((ids, -score))
                        ids, down = ids[order], -score[order]
                        for place, (lo, hi) in enumerate(zip(low, high, strict=True)):
                            b, e = np.searchsorted(down, -hi), np.searchsorted(down, -lo, side="right")
                            out += [(anchor, place, x, -s) for x, s in zip(ids[b : min(e, b + k)].tolist(), down[b : min(e, b + k)].tolist(), strict=True)]
                columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor_id", "place", "other_id", "score"])

    return run


def _stretches(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal values."""
    change = np.zeros(len(columns[0]) - 1 if len(columns[0]) else 0, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(columns[0])]
    return ((i, j) for i, j in zip(edges, edges[1:], strict=False) if j > i)


class MultiIndex:
    """Codebooks, cells and the sharded rows of a table (id, label, q) with vectors of dims whole numbers."""

    def __init__(self, vectors: DataFrame, dims: int, policy: MinePolicy):
        self.dims, self.policy = dims, policy
        n = min(policy.sample, max(1, policy.sample_values // dims))
        share = 2 * n / max(1, vectors.count())  # some twice the sample is drawn by hash, and the first of these taken
        drawn = vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else vectors
        some = drawn.orderBy(F.xxhash64("id"), "id").limit(n).select("q").toArrow()["q"].combine_chunks()
        some = some.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        first, second = fit_codebook(some[:, : dims // 2], policy.codewords), fit_codebook(some[:, dims // 2 :], policy.codewords)

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)
                (a, d), (b, e) = nearest(rows[:, : dims // 2], first), nearest(rows[:, dims // 2 :], second)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((a * len(second) + b).astype(np.int32)), pa.array(d), pa.array(e)], ["id", "label", "q", "cell", "d1", "d2"])

        coded = stage(vectors.select("id", "label", "q").mapInArrow(code, "id bigint, label bigint, q array<bigint>, cell int, d1 double, d2 double"), "coded")
        found = coded.groupBy("cell").agg(F.count("*").alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).orderBy("cell").collect()  # codewords^2 rows at most
        total = sum(c.n for c in found)
        size = min(policy.shard_rows, -(-total // policy.shards) or 1)
        shards, at, room = {}, -1, 0
        for c in found:
            if c.n > size:
                shards[c.cell], at, room = (at + 1, -(-c.n // size)), at - (-c.n // size), 0
            else:
                if room < c.n:
                    at, room = at + 1, size
                shards[c.cell], room = (at, 1), room - c.n
        self.count = at + 1
        self.cells = Cells(first, second, {c.cell: c.n for c in found}, {c.cell: (c.d1, c.d2) for c in found}, shards)
        places = F.broadcast(coded.sparkSession.createDataFrame([(c, s, p) for c, (s, p) in shards.items()], "cell int, shard int, parts int"))
        self.rows = coded.join(places, "cell").select((F.col("shard") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("shard"), F.lit(0).alias("kind"), "cell", "id", "label", "q", *[F.lit(None).cast(t).alias(c) for c, t in (("cells", "array<int>"), ("low", "array<bigint>"), ("high", "array<bigint>"))])

    def search(self, anchors: DataFrame, same: bool, k: int) -> DataFrame:
        """anchor_id, place, other_id, score, rank: the k best rows of each list; anchors (id, label, q, low, high) name the scores that count in each list, from low to high."""
        best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "other_id")
        found, sought = None, anchors
        for certify in (False, True):
            messages = sought.select("id", "label", "q", "low", "high").mapInArrow(_route(self.cells, self.policy, certify), _MESSAGE)
            met = self.rows.unionByName(messages).repartitionById(self.count, "shard").sortWithinPartitions("shard", "kind", "cell", "id")
            hits = met.mapInArrow(_search(self.dims, same, k), "anchor_id bigint, place int, other_id bigint, score bigint")
            hits = hits if found is None else hits.unionAll(found.drop("rank"))
            found = stage(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "hits")
            if not certify:
                full = found.where(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("reached"))
                raised = F.transform("low", lambda x, i: F.coalesce(F.element_at("reached", i), x))
                sought = anchors.join(full, anchors["id"] == full["anchor_id"], "left").withColumn("low", raised)
        return found


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, label: Column) -> tuple[DataFrame, int | None]:
    """(id, label, q) of the rows that take part, one for each id, and the length of their vectors."""
    spark = df.sparkSession
    x = df.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = x.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine)
    x = x.select("id", "label", F.transform("v", lambda c: F.floor(c * 256)).alias("q"))
    common = x.groupBy(F.size("q").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return spark.createDataFrame([], "id bigint, label bigint, q array<bigint>"), None
    one = x.where(F.size("q") == common["n"]).groupBy("id").agg(F.min(F.struct("label", "q")).alias("r"))
    return stage(one.select("id", "r.*"), "vectors"), common["n"]


def mine_hard_negatives(df: DataFrame, anchors: Column, label: Column | str = "label", policy: MinePolicy = MinePolicy(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each anchor (a condition on `id`) and each of its first positives, the first hard negatives."""
    spark = df.sparkSession
    with scratch(spark):
        vectors, dims = whole_vectors(df, id_col, vector_col, F.col(label) if isinstance(label, str) else label)
        if dims is None:
            return spark.createDataFrame([], OUT)
        index = MultiIndex(vectors, dims, policy)
        all_scores = [F.array(F.lit(x).cast("bigint")) for x in (-(1 << 63), (1 << 63) - 1)]
        asking = vectors.where(anchors).withColumns({"low": all_scores[0], "high": all_scores[1]})
        positives = index.search(asking, True, policy.positives)
        scores = positives.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
        low = F.transform("scores", lambda s: -_floor_div(-policy.low * s, 100))
        high = F.transform("scores", lambda s: _floor_div(policy.high * s, 100))
        seeking = stage(vectors.join(scores, vectors["id"] == scores["anchor_id"]).select("id", "label", "q", low.alias("low"), high.alias("high")), "seeking")
        negatives = index.search(seeking, False, policy.negatives)
        pairs = positives.select("anchor_id", (F.col("rank") - 1).alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
        named = negatives.join(pairs, ["anchor_id", "place"])
        return keep(named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "hard-negatives")


ORACLE = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
           FROM {table} WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.id AS a, o.id AS o, a.label = o.label AS same, list_inner_product(a.q, o.q)::BIGINT AS s FROM v a JOIN v o ON a.id <> o.id WHERE a.id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, o) AS k FROM s WHERE same),
n AS (SELECT p.a, p.o AS positive, p.s AS ps, s.o AS negative, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.o ORDER BY s.s DESC, s.o)::INTEGER AS rank
      FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.s <= 100 * s.s AND 100 * s.s <= 90 * p.s WHERE p.k <= 5)
SELECT a AS anchor_id, positive AS positive_id, rank, negative AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE rank <= 10"""
