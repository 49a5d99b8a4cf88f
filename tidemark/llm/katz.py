"""Katz backoff language model of any order (operator 7).

n-gram counts with Good-Turing discounts for each order and backoff weights that make every history's distribution sum to
one over the training vocabulary and one unknown word. Texts are packed into chunks: the distinct words of some megabytes
of text and the sequence of their places. A chunk sends its distinct words, packed, to partitions by hash; each partition adds
the counts of all chunks, names the words by number and answers every chunk for its words. Then, order by order, the chunks
send their distinct n-grams by history (one with a large share of the tokens is spread by the next word as well), and get
back the n-gram's count and, for each history, whole numbers from which its backoff weight follows under any discounts. The
tables of counts lie in partitions that grow in number with the corpus; nothing but a dozen totals an order passes through
the driver. Every message holds an n-gram that its chunk has, so there are never more messages than tokens.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tidemark.llm.common import arrow_rows, keep, setting
from tidemark.llm.quality_fm import held_out
from tidemark.llm.tokens import Splitter, buffers, mix, pack, runs, unpack

#: Token that ends every text (a hash), and number of the token before a text's first.
END, START = np.uint64(1), 0
#: Counts above CUT are not discounted.
CUT = 5


@dataclass(frozen=True)
class KatzPolicy:
    """order: longest n-gram. chunk: bytes of text that a task works on at a time. partition: bytes of text for each partition of the count tables."""

    order: int = 3
    folds: int = 10
    chunk: int = 4 << 20
    partition: int = 8 << 20
    least_partitions: int = 16


def _unique(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each, and each element's number among them. Faster than a stable sort, which nothing needs here."""
    order = np.argsort(x)
    y = x[order]
    new = np.ones(len(x), bool)
    new[1:] = y[1:] != y[:-1]
    inverse = np.empty(len(x), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return y[new], order[new], inverse


def packed_chunks(docs: DataFrame, policy: KatzPolicy = KatzPolicy()) -> DataFrame:
    """(cid, ids, held, sizes, keys, tokens): runs of documents. keys: hashes of the distinct words, as gaps; tokens: their places in text order, END after each text; sizes: tokens of each text. Null texts count as empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(lower=True)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for i, j in runs(offsets, policy.chunk):
                hashes, doc = [], []
                for a, b in runs(offsets[i : j + 1]):
                    part = offsets[i + a : i + b + 1]
                    w = splitter.split(data[part[0] : part[-1]], part - part[0])
                    hashes.append(w.hashes)
                    doc.append(w.doc + a)
                n = j - i
                of = np.concatenate([*doc, np.arange(n)])
                order = np.argsort(of, kind="stable")  # a text's words keep their order, its END comes last
                keys, _, tokens = _unique(np.concatenate([*hashes, np.full(n, END)])[order])
                cid = int.from_bytes(np.random.default_rng().bytes(8), "little") >> 1  # kept by the stored table
                wrap = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                packed = [pa.array([pack(x)], pa.binary()) for x in (np.bincount(of, minlength=n), np.diff(keys, prepend=np.uint64(0)), tokens)]
                yield pa.RecordBatch.from_arrays([pa.array([cid]), wrap(batch.column(0).slice(i, n)), wrap(batch.column(2).slice(i, n)), *packed], ["cid", "ids", "held", "sizes", "keys", "tokens"])

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), policy.folds).alias("held"))
    return rows.mapInArrow(run, f"cid long, ids array<{kind}>, held array<boolean>, sizes binary, keys binary, tokens binary")


class Chunk:
    """Tokens of a packed chunk: of (place among keys), doc, train (mark) and first (place of its text's first token) of each."""

    def __init__(self, row: dict):
        self.keys = np.cumsum(unpack(row["keys"]).view(np.uint64), dtype=np.uint64)
        self.of, sizes = unpack(row["tokens"]), unpack(row["sizes"])
        self.n = len(sizes)
        self.doc = np.repeat(np.arange(self.n), sizes)
        self.first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.train = ~np.asarray(row["held"], bool)[self.doc]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: a chunk is megabytes."""
    for batch in batches:
        for k in range(len(batch)):
            yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}


def _messages(cid: int, p: np.ndarray, columns: dict[str, tuple[np.ndarray, np.ndarray]], parts: int) -> pa.RecordBatch:
    """A row for each partition that p (sorted) names. columns: name -> (partition of each value, sorted; values)."""
    some = np.unique(p)
    cut = {name: (np.searchsorted(at, some), np.searchsorted(at, some, side="right")) for name, (at, _) in columns.items()}
    packed = {name: pa.array([pack(values[a:b]) for a, b in zip(*cut[name], strict=True)], pa.binary()) for name, (_, values) in columns.items()}
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(some), cid)), pa.array(some.astype(np.int32)), *packed.values()], ["cid", "p", *packed])


def _word_requests(chunks: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row)
            p = (c.keys >> np.uint64(64 - bits)).astype(np.int64)
            gaps = np.where(np.diff(p, prepend=-1) != 0, c.keys, np.diff(c.keys, prepend=np.uint64(0)))
            yield _messages(row["cid"], p, {"keys": (p, gaps), "n": (p, np.bincount(c.of, c.train, len(c.keys)))}, 1 << bits)

    return chunks.select("cid", "held", "sizes", "keys", "tokens").mapInArrow(run, "cid long, p int, keys binary, n binary")


def _of_counts(c: np.ndarray) -> list[int]:
    """Total, types, and types that occur 1 ... CUT + 1 times."""
    return [int(c.sum()), int((c > 0).sum()), *np.bincount(np.minimum(c, CUT + 2), minlength=CUT + 3)[1 : CUT + 2].tolist()]


def _answers(pdf: pd.DataFrame, answers: list[list[bytes]], names: list[str], totals: list[int]) -> pd.DataFrame:
    """A row for each message, and one with the partition's totals (null cid)."""
    out = pd.DataFrame(answers, columns=names)
    out.insert(0, "cid", pdf["cid"].to_numpy())
    out.insert(1, "p", pdf["p"].to_numpy())
    out["totals"] = None
    last = pd.DataFrame({"cid": [None], "p": pdf["p"].iloc[:1].to_numpy(), **{n: [None] for n in names}, "totals": [totals]})
    return pd.concat([out.astype({"cid": "Int64"}), last.astype({"cid": "Int64"})])


def _count_words(bits: int):
    """One partition of the word table: for every chunk the numbers and counts of its words. The more frequent a word, the smaller its number."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpack(k).view(np.uint64), dtype=np.uint64) for k in pdf["keys"]]
        every, _, of = _unique(np.concatenate(keys))
        total = np.bincount(of, np.concatenate([unpack(n) for n in pdf["n"]]), len(every)).astype(np.int64)
        name = np.empty(len(every), np.int64)
        name[np.argsort(-total, kind="stable")] = (np.arange(len(every), dtype=np.int64) << bits) + int(pdf["p"].iloc[0]) + 1
        ends = np.cumsum([len(k) for k in keys])
        answers = [[pack(name[of[e - len(k) : e]]), pack(total[of[e - len(k) : e]])] for k, e in zip(keys, ends, strict=True)]
        return _answers(pdf, answers, ["names", "n"], _of_counts(total))

    return run


def _fitted(n: list[int]) -> float | None:
    """Slope of Simple Good-Turing's line through log(counts of counts) over log(count); None where it does not fall by more than 1 / count."""
    r = np.flatnonzero(n) + 1
    if len(r) < 2:
        return None
    before, after = np.append(0, r[:-1]), np.append(r[1:], r[-1] + 1)
    slope = float(np.polyfit(np.log(r), np.log(2 * np.asarray(n, float)[r - 1] / (after - before)), 1)[0])
    return slope if slope < -1 else None


def discounts(n: list[int]) -> np.ndarray:
    """Katz's Good-Turing ratios for counts 0 ... CUT from the numbers of types n[0] (once), n[1] (twice) ... n[CUT].

    Turing's own ratios hold as long as they rise inside (0, 1); from the first that does not, those of the smoothed counts
    of counts hold (Simple Good-Turing), which always do. Only counts of counts that do not fall by more than 1 / count, so
    that Good-Turing gives no ratio under 1, have half a count taken off what Turing's ratios do not cover.
    """
    n = [int(x) for x in n[: CUT + 1]]
    r = np.arange(1, CUT + 1)
    slope = _fitted(n)
    rest = (r - 0.5) / r
    if slope is not None:
        tail = (CUT + 1.0) ** (slope + 1)
        rest = ((1 + 1 / r) ** (slope + 1) - tail) / (1 - tail)
    out = np.append(1.0, rest)
    tail = (CUT + 1) * n[CUT] / n[0] if n[0] else 1.0
    for k in range(1, CUT + 1):
        ratio = ((k + 1) * n[k] / n[k - 1] / k - tail) / (1 - tail) if tail < 1 and n[CUT] and n[k - 1] else 0.0
        if not (0.0 if k == 1 else out[k - 1]) < ratio < 1:
            break
        out[k] = ratio
    return out


def taken(d: np.ndarray) -> float:
    """What discounts take off a count of CUT: so much is taken in all where every count is higher, in proportion to the counts."""
    return float(CUT * (1 - d[CUT]))


@dataclass
class Totals:
    """What every task knows of the corpus: training tokens and types, training texts, discounts of each order.

    top: share that word counts above CUT keep; under 1 only where no word has a lower count, so that unknown words have some mass.
    """

    tokens: int
    types: int
    texts: int
    unknown: float
    bits: int
    discounts: list[np.ndarray] = field(default_factory=list)
    top: float = 1.0

    def p1(self, c: np.ndarray) -> np.ndarray:
        """Discounted word probability; a word that training lacks gets the whole mass left over."""
        p = np.where(c > CUT, self.top, self.discounts[0][np.minimum(c, CUT)]) * c / max(self.tokens, 1)
        return np.where(c > 0, p, self.unknown)

    def spread(self, c: np.ndarray) -> np.ndarray:
        """Partitions that a history of count c is dealt to: more than one from half a partition's mean."""
        return np.clip((c * ((2 << self.bits) / max(self.tokens, 1))).astype(np.int64), 1, 1 << self.bits)


class Grams:
    """A chunk's distinct n-grams of one order as the partitions see them, sorted by partition, history and next word.

    of: place of each token's n-gram in that order. Histories are sorted by partition too; one that is dealt to several
    partitions asks all of them for its sums. h_of: each token's history; h_count: a history's count.
    """

    def __init__(self, c: Chunk, name: np.ndarray, history: np.ndarray, ids: list[np.ndarray], h_count: np.ndarray, low: np.ndarray, t: Totals):
        """history: each token's history, numbered; ids: the names of its words, the nearest first, for each history; low: count of the n-gram without its first word, for each token."""
        size, many = len(name), len(ids[0])
        rank = np.empty(size, np.int64)
        rank[np.argsort(name)] = np.arange(size)
        by_rank = np.sort(name)
        pair, first, of = _unique(history * size + rank[c.of])
        h, w = pair // size, by_rank[pair % size]
        n = np.bincount(of, c.train, len(pair)).astype(np.int64)
        wide = t.spread(h_count)
        mixed = np.zeros(many, np.uint64)
        for x in ids:
            mixed = mix(mixed * np.uint64(0x9E3779B97F4A7C15) + x.astype(np.uint64))
        home = (mixed >> np.uint64(64 - t.bits)).astype(np.int64)
        p = home[h]
        far = np.flatnonzero(wide[h] > 1)
        p[far] += (mix(w[far].astype(np.uint64)) >> np.uint64(11)).astype(np.int64) % wide[h[far]]
        p %= 1 << t.bits
        order = np.argsort(p.astype(np.uint16) if t.bits <= 16 else p, kind="stable")
        place = np.empty(len(pair), np.int64)
        place[order] = np.arange(len(pair))
        self.of, self.h_of, self.h_count = place[of], history, h_count
        self.p, self.h, self.w, self.n, self.low = p[order], h[order], w[order], n[order], np.where(n > 0, low[first], 0)[order]
        some = np.flatnonzero(wide > 1)
        g_h = np.concatenate([np.flatnonzero(wide == 1), np.repeat(some, wide[some])])
        turn = np.concatenate([np.zeros(many - len(some), np.int64), np.arange(int(wide[some].sum())) - np.repeat(np.cumsum(wide[some]) - wide[some], wide[some])])
        key = np.sort((home[g_h] + turn) % (1 << t.bits) * many + g_h)
        self.g_p, self.g_h = key // many, key % many
        self.row_group = np.searchsorted(key, self.p * many + self.h) if len(some) else self._groups()
        self.g_n = np.bincount(self.row_group, minlength=len(key))
        self.wide = wide[self.g_h] > 1
        self.ids = [x[self.g_h] for x in ids]

    def _groups(self) -> np.ndarray:
        """Group of each row where no history is spread: rows and groups have one order, and each history one group."""
        at = np.empty(len(self.h_count), np.int64)
        at[self.g_h] = np.arange(len(self.g_h))
        return at[self.h]

    def asked(self, count: np.ndarray) -> np.ndarray:
        """Groups that get their sums: those with an n-gram that training lacks, and those of spread histories."""
        return self.wide | (np.bincount(self.row_group, count == 0, len(self.g_h)) > 0)

    def w_gaps(self) -> np.ndarray:
        """Each next word less the one before it after the same history."""
        new = (np.diff(self.p, prepend=-1) != 0) | (np.diff(self.h, prepend=-1) != 0)
        return np.where(new, self.w, np.diff(self.w, prepend=0))

    def messages(self, cid: int, parts: int) -> pa.RecordBatch:
        near = self.ids[0]  # sorted inside a partition
        gaps = np.where(np.diff(self.g_p, prepend=-1) != 0, near, np.diff(near, prepend=0))
        columns = {"h1": (self.g_p, gaps), **{f"h{k + 2}": (self.g_p, x) for k, x in enumerate(self.ids[1:])}, "hn": (self.g_p, self.g_n), "wide": (self.g_p, self.wide), "w": (self.p, self.w_gaps()), "n": (self.p, self.n), "low": (self.p, self.low)}
        return _messages(cid, self.g_p, columns, parts)


def _columns(order: int) -> list[str]:
    return [*[f"h{k}" for k in range(1, order)], "hn", "wide", "w", "n", "low"]


def _from_gaps(gaps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Running sums inside groups of the given sizes."""
    out = np.cumsum(gaps)
    start = (np.cumsum(sizes) - sizes)[sizes > 0]
    return out - np.repeat(out[start] - gaps[start], sizes[sizes > 0])


def _count_grams(order: int):
    """One partition of the table of an order: for every chunk the counts of its n-grams, for each history whether all its
    followers have counts above CUT (bare), and for the histories that it asks for (Grams.asked), over the followers seen in
    training: how many have a count of 1 ... CUT; how many have a lower-order count of 1 ... CUT, and the sum of the higher ones."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h1 = [np.cumsum(unpack(x)) for x in pdf["h1"]]
        hs = [np.concatenate(h1), *[np.concatenate([unpack(x) for x in pdf[f"h{k}"]]) for k in range(2, order)]]
        hn = [unpack(x) for x in pdf["hn"]]
        w = np.concatenate([_from_gaps(unpack(x), sizes) for x, sizes in zip(pdf["w"], hn, strict=True)])
        n, low = (np.concatenate([unpack(x) for x in pdf[name]]) for name in ("n", "low"))
        h_of, many = _ranks(hs)
        of, rows, first = _ranks([np.repeat(h_of, np.concatenate(hn)), w], True)
        total = np.bincount(of, n, rows).astype(np.int64)
        lower = np.zeros(rows, np.int64)
        lower[of[n > 0]] = low[n > 0]  # chunks send it with n-grams that they train on
        th = np.repeat(h_of, np.concatenate(hn))[first]
        seen = total > 0
        of_class = lambda c: [np.bincount(th[seen & (c == r)], minlength=many) for r in range(1, CUT + 1)]
        sums = np.stack([*of_class(total), *of_class(lower), np.bincount(th, np.where(seen & (lower > CUT), lower, 0), many).astype(np.int64)])
        bare = sums[:CUT].sum(axis=0) == 0
        answers, at, row = [], 0, 0
        for keys, sizes, wide in zip(h1, hn, pdf["wide"], strict=True):
            mine, own = h_of[at : at + len(keys)], total[of[row : row + int(sizes.sum())]]
            at, row = at + len(keys), row + len(own)
            asked = (unpack(wide) > 0) | (np.bincount(np.repeat(np.arange(len(keys)), sizes), own == 0, len(keys)) > 0)
            answers.append([pack(own), pack(bare[mine]), pack(sums[:, mine[asked]].ravel())])
        return _answers(pdf, answers, ["n", "bare", "sums"], _of_counts(total))

    return run


def _ranks(columns: list[np.ndarray], firsts: bool = False) -> tuple:
    """Number of each row's distinct value, in order of the columns, and how many there are (and a row of each)."""
    bits = [int(x.max(initial=0)).bit_length() for x in columns]
    if sum(bits) < 63:
        key = columns[0]
        for x, n in zip(columns[1:], bits[1:], strict=True):
            key = key << n | x
        values, first, out = _unique(key)
        return (out, len(values), first) if firsts else (out, len(values))
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in columns:
        y = x[order]
        new[1:] |= y[1:] != y[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return (out, int(new.sum()), order[new]) if firsts else (out, int(new.sum()))


def _filled(answers: list, name: str) -> np.ndarray:
    """Answers of all partitions in the order of the partitions."""
    return np.concatenate([np.zeros(0, np.int64), *[unpack(a[name]) for a in sorted(answers, key=lambda a: a["p"])]])


def orders(row: dict, c: Chunk, t: Totals, upto: int) -> Iterator[tuple[Grams | None, np.ndarray]]:
    """For orders 1 ... upto: the n-grams, and the count of each token's n-gram (where the row has the answers, else None)."""
    name, count = _filled(row["words"], "names"), _filled(row["words"], "n")[c.of]
    yield None, count
    at, history, ids, one = np.arange(len(c.of)), np.zeros(len(c.of), np.int64), [], name[c.of]
    for k in range(2, upto + 1):
        far = at - (k - 1)
        before = np.where(at > c.first, np.append(0, count[:-1])[: len(at)], t.texts)
        if k == 2:  # histories are numbered as the words by name, after START
            by_name = np.argsort(name)
            rank = np.empty(len(name), np.int64)
            rank[by_name] = np.arange(1, len(name) + 1)
            history = np.where(far >= c.first, rank[c.of[np.maximum(far, 0)]], 0)
            ids = [np.append(START, name[by_name])]
        else:
            word = np.where(far >= c.first, one[np.maximum(far, 0)], START)
            _, back, new = _unique(history * (int(word.max(initial=0)) + 1) + word)
            ids, history = [*[x[history[back]] for x in ids], word[back]], new
        h_count = np.zeros(len(ids[0]), np.int64)
        h_count[history] = before
        low = count
        g = Grams(c, name, history, ids, h_count, low, t)
        count = _filled(row[f"grams{k}"], "n")[g.of] if row.get(f"grams{k}") else None
        yield g, count


def _gram_requests(chunks: DataFrame, totals: Totals, order: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row)
            *_, (g, _) = orders(row, c, totals, order)
            yield g.messages(row["cid"], 1 << totals.bits)

    return chunks.drop("ids").mapInArrow(run, "cid long, p int, " + ", ".join(f"{x} binary" for x in _columns(order)))


class Tables:
    """Tables of the shared warehouse in buckets by cid: chunks and their answers meet without a shuffle. Dropped at the end."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names, self.buckets = spark, [], max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def store(self, df: DataFrame) -> DataFrame:
        self.names.append(f"katz_{uuid.uuid4().hex}")
        with setting(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            df.write.bucketBy(self.buckets, "cid").saveAsTable(self.names[-1])
        return self.spark.table(self.names[-1])

    def answers(self, chunks: DataFrame, answers: DataFrame, name: str, *columns: str) -> tuple[DataFrame, list[int]]:
        """chunks with each one's own answers as column name, and the sum of the partitions' totals."""
        row = answers.withColumn("cid", F.coalesce("cid", -1 - F.col("p")))  # totals: a row of their own for each partition
        lists = row.repartition(self.buckets, "cid").groupBy("cid").agg(F.collect_list(F.struct("p", *columns)).alias(name), F.any_value("totals").alias("totals"))
        stored = self.store(lists)
        got = stored.where("cid < 0").agg(*[F.sum(F.col("totals")[k]).alias(f"t{k}") for k in range(CUT + 3)]).first()
        return chunks.join(stored.where("cid >= 0").select("cid", name).hint("shuffle_hash"), "cid", "left"), [int(x or 0) for x in got]

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def score_texts(docs: DataFrame, policy: KatzPolicy = KatzPolicy()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Learns from the rows that are not held out; null and empty texts consist of the END token. Without any training text
    every token is unknown and has probability 1. Rows that repeat an id or a text are texts of their own; a null id is held
    out. Needs doc_id and text; other columns are not looked at.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    tables = Tables(spark)
    try:
        with arrow_rows(spark, 10_000):  # a batch holds a chunk at least
            chunks = tables.store(packed_chunks(docs, policy))
        with arrow_rows(spark, 1):  # a chunk is megabytes
            return _scored(tables, chunks, kind, policy)
    finally:
        tables.drop()


def _scored(tables: Tables, chunks: DataFrame, kind: DataType, policy: KatzPolicy) -> DataFrame:
    if chunks.isEmpty():
        return chunks.sparkSession.createDataFrame([], _scores_schema(kind))
    size = chunks.agg(F.sum(F.length("tokens").cast("long")).alias("b"), F.sum(F.size(F.filter("held", lambda x: ~x))).alias("t")).first()
    bits = max((policy.least_partitions - 1).bit_length(), (4 * size.b // policy.partition).bit_length())  # packed tokens take about a quarter of the text
    words = _word_requests(chunks, bits).groupBy("p").applyInPandas(_count_words(bits), "cid long, p int, names binary, n binary, totals array<long>")
    named, (n, v, *ones) = tables.answers(chunks, words, "words", "names", "n")
    d1 = discounts(ones)
    kept = sum(d1[r] * r * ones[r - 1] for r in range(1, CUT + 1)) + n - sum(r * ones[r - 1] for r in range(1, CUT + 1))
    bare = n > 0 and not any(ones[:CUT])
    left = taken(d1) / n if bare else float(1 - kept / n) if n else 1.0
    totals = Totals(n, v, int(size.t), left, bits, [d1], top=1 - left if bare else 1.0)
    for k in range(2, policy.order + 1):
        grams = _gram_requests(named, totals, k).groupBy("p").applyInPandas(_count_grams(k), "cid long, p int, n binary, bare binary, sums binary, totals array<long>")
        named, counted = tables.answers(named, grams, f"grams{k}", "n", "bare", "sums")
        totals.discounts = [*totals.discounts, discounts(counted[2:])]
    return keep(_score(named, totals, policy.order, kind), "scores")


def log_probabilities(row: dict, c: Chunk, t: Totals, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(count of each token's word, log10 of its probability): its n-gram's discounted share if training has the n-gram, else its history's weight times the probability of the next lower order.

    Every history keeps some mass for words that it was not seen with: one whose followers all have counts above CUT gives
    up what is taken off one count of CUT.
    """
    r = np.arange(1, CUT + 1)
    words = p = below = None
    for k, (g, count) in enumerate(orders(row, c, t, order), 1):
        if k == 1:
            words, p = count, t.p1(count)
            below = np.full(len(count), max(t.tokens, 1)), np.full(len(count), t.top)  # count of the history, and what high counts keep after it
            continue
        d, lower, many = t.discounts[k - 1], t.discounts[k - 2], len(g.h_count)
        parts = [unpack(a["sums"]).reshape(2 * CUT + 1, -1) for a in sorted(row[f"grams{k}"], key=lambda a: a["p"])]
        asked = g.g_h[g.asked(_filled(row[f"grams{k}"], "n"))]
        sums = np.stack([np.bincount(asked, x, many) for x in np.concatenate(parts, axis=1)])  # a spread history's parts add up
        single = ~g.wide
        alone = np.zeros(many, bool)
        alone[g.g_h[single]] = _filled(row[f"grams{k}"], "bare")[single] > 0
        alone[g.g_h[g.wide]] = (sums[:CUT].sum(axis=0) == 0)[g.g_h[g.wide]]
        known = np.maximum(g.h_count, 1)
        bare = (g.h_count > 0) & alone
        left = np.where(bare, taken(d), ((1 - d[1:]) * r) @ sums[:CUT])
        top = np.where(bare, 1 - left / known, 1.0)
        h, (under, kept) = g.h_of, below
        mass = (((lower[1:] * r) @ sums[CUT : 2 * CUT])[h] + kept * sums[2 * CUT][h]) / under  # of the followers, in the next lower order
        weight = np.where(g.h_count[h] > 0, (left / known)[h] / np.maximum(1 - mass, 1e-15), 1.0)
        seen = np.where(count > CUT, top[h], d[np.minimum(count, CUT)]) * count / known[h]
        p = np.where(count > 0, seen, weight * p)
        below = known[h], top[h]
    return words, np.log10(p)


def _scores_schema(kind: DataType) -> str:
    return f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(chunks: DataFrame, totals: Totals, order: int, kind: DataType) -> DataFrame:
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row)
            words, p = log_probabilities(row, c, totals, order)
            columns = [
                pa.array(row["ids"], id_type),
                pa.array(row["held"], pa.bool_()),
                pa.array(np.bincount(c.doc, minlength=c.n)),
                pa.array(np.bincount(c.doc, words > 0, c.n).astype(np.int64)),
                pa.array(np.full(c.n, totals.tokens)),
                pa.array(np.bincount(c.doc, np.log10((words + 0.1) / (totals.tokens + 0.1 * (totals.types + 1))), c.n)),
                pa.array(np.bincount(c.doc, p, c.n)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return chunks.mapInArrow(run, _scores_schema(kind))
