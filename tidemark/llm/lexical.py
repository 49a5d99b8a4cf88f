"""Ranked lexical search with the roles reversed (operator 12).

The queries are indexed, not the documents: an inverted index from terms to items is sent to all tasks, every document's
term counts stream through it once, and a heap of k places per item holds its best documents. Heaps of tasks are merged in
two steps. Items are taken in blocks of at most `postings` (item, term) pairs, so that the index has a bound of some tens of
megabytes whatever the number of items; each block is one pass over the documents.

Rows: null and empty texts have no terms, and documents without terms do not count; repeated documents are documents of
their own; documents without an id count in the statistics but cannot be named in a result; every item row is an item of its
own, also with a repeated or null id; an empty table gives no rows; further columns take no part, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep, scratch, stage
from tidemark.llm.tokens import buffers, pack, runs, unpack


@dataclass(frozen=True)
class SearchPolicy:
    k: int = 20
    postings: int = 2_000_000
    cells: int = 1 << 21  # places of a documents x items table of sums
    merge: int = 64  # heaps of this many groups of tasks meet first


class Terms:
    """Splits texts into maximal runs of [0-9A-Za-z] and characters beyond ASCII, A-Z as a-z."""

    def __init__(self):
        self.inside = np.zeros(256, bool)
        self.fold = np.arange(256, dtype=np.uint8)
        for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
            self.inside[low : high + 1] = True
        self.fold[0x41:0x5B] += 32

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(terms as binary, index of the text of each)."""
        inside = self.inside[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begin = offsets[:-1][offsets[:-1] < len(data)]
        first[begin] = inside[begin]
        at = np.flatnonzero(first)
        edges = np.append(np.flatnonzero(first[inside]), np.count_nonzero(inside))
        body = self.fold[data[inside]]
        if edges[-1] < 1 << 31:
            edges, kind = edges.astype(np.int32), pa.binary()
        else:
            kind = pa.large_binary()
        terms = pa.Array.from_buffers(kind, len(at), [None, pa.py_buffer(edges), pa.py_buffer(body)])
        return terms, np.searchsorted(offsets[1:], at, side="right")


def term_rows(items: DataFrame) -> DataFrame:
    """row, item_id, term, n: the terms of every item, counted; row numbers the item rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Terms()
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for i, j in runs(offsets):
                terms, of = splitter.split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                found = Counter(zip(of.tolist(), terms.to_pylist(), strict=True))
                rows = pa.array([i + d for d, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array([t.decode() for _, t in found], pa.string()), pa.array(found.values(), pa.int64())], ["row", "item_id", "term", "n"])

    numbered = items.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return numbered.mapInArrow(run, "row bigint, item_id bigint, term string, n bigint")


class Index:
    """Postings of some items by term; weights follow from the corpus."""

    def __init__(self, rows: pa.Table):
        coded = rows["term"].combine_chunks().dictionary_encode()
        self.terms = coded.dictionary.cast(pa.binary())
        term = coded.indices.to_numpy()
        number, item = np.unique(rows["row"].to_numpy(), return_inverse=True)
        order = np.argsort(term, kind="stable")
        self.begin = np.append(0, np.cumsum(np.bincount(term, minlength=len(self.terms))))
        self.item, self.times, self.rows, self.items = item[order], rows["n"].to_numpy()[order], number, len(number)

    def weigh(self, n: int, total: int, df: np.ndarray) -> None:
        self.n, self.total = n, total
        self.weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    def sums(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Score of each of len(length) documents for each item, from their (document, term, occurrences)."""
        size = [100 - 25 + (25 * x * self.n) // self.total for x in length.tolist()]  # in whole numbers of any size
        part = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * np.array(size, np.int64)[doc]))
        count = np.diff(self.begin)[term]
        ends = np.cumsum(count)
        at = np.repeat(self.begin[term] - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
        out = np.zeros(len(length) * self.items, np.int64)
        np.add.at(out, np.repeat(doc * self.items, count) + self.item[at], np.repeat(part, count) * self.times[at])
        return out.reshape(len(length), self.items)


class Heaps:
    """The k best documents of each item: higher scores first, then smaller ids."""

    def __init__(self, items: int, k: int):
        self.score, self.doc, self.k = np.zeros((items, k), np.int64), np.full((items, k), np.iinfo(np.int64).max), k

    def offer(self, doc: np.ndarray, score: np.ndarray) -> None:
        """score: documents x items; sums of 0 never enter."""
        least = self.score[:, -1]
        row, item = np.nonzero((score >= least) & (score > 0))
        better = (score[row, item] > least[item]) | (doc[row] < self.doc[item, -1])
        row, item = row[better], item[better]
        if not len(row):
            return
        touched = np.unique(item)
        items = np.concatenate([np.repeat(touched, self.k), item])
        scores = np.concatenate([self.score[touched].ravel(), score[row, item]])
        docs = np.concatenate([self.doc[touched].ravel(), doc[row]])
        order = np.lexsort((docs, -scores, items))
        begins = np.searchsorted(items[order], touched)
        best = order[begins[:, None] + np.arange(self.k)]
        self.score[touched], self.doc[touched] = scores[best], docs[best]


def _count(terms: pa.Array):
    """doc_id, n, terms, tf: occurrences of the given terms in each document; n: all its terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Terms()
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for i, j in runs(offsets):
                found, of = splitter.split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                code = pc.index_in(found.cast(pa.binary()), value_set=terms)
                known = code.is_valid().to_numpy(zero_copy_only=False)
                key, tf = np.unique(of[known] * len(terms) + code.drop_null().to_numpy(), return_counts=True)
                edge = np.searchsorted(key, np.arange(j - i + 1) * len(terms))
                key -= np.repeat(np.arange(j - i), np.diff(edge)) * len(terms)
                lists = [(pack(key[a:b]), pack(tf[a:b])) if b > a else (None, None) for a, b in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.bincount(of, minlength=j - i)), pa.array([x for x, _ in lists], pa.binary()), pa.array([x for _, x in lists], pa.binary())], ["doc_id", "n", "terms", "tf"])

    return run


def _statistics(terms: int):
    """term, df of one task's documents; -1: documents with a term, -2: terms in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            size = batch.column(0).to_numpy()
            n, total = n + int((size > 0).sum()), total + int(size.sum())
            for held in batch.column(1).drop_null().to_pylist():
                df[unpack(held)] += 1
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, [-1, -2])), pa.array(np.append(df[seen], [n, total]))], ["term", "df"])

    return run


def _search(index: Index, policy: SearchPolicy):
    """task, item, doc_id, score: one task's heaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.items, policy.k)
        step = max(1, policy.cells // max(1, index.items))
        for batch in batches:
            ids, length = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            held, times = [unpack(x) for x in batch.column(2).to_pylist()], [unpack(x) for x in batch.column(3).to_pylist()]
            for i in range(0, len(ids), step):
                part = held[i : i + step]
                doc = np.repeat(np.arange(len(part)), [len(x) for x in part])
                heaps.offer(ids[i : i + step], index.sums(doc, np.concatenate(part), np.concatenate(times[i : i + step]), length[i : i + step]))
        item, place = np.nonzero(heaps.score)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(item), TaskContext.get().partitionId(), np.int64)), pa.array(index.rows[item]), pa.array(heaps.doc[item, place]), pa.array(heaps.score[item, place])], ["task", "row", "doc_id", "score"])

    return run


def rank_documents(docs: DataFrame, items: DataFrame, policy: SearchPolicy = SearchPolicy()) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.desc("score"), F.asc("doc_id")]
    with scratch(spark):
        terms = stage(term_rows(items), "item-terms")
        sizes = terms.groupBy("row").count()
        blocks = -(-(sizes.agg(F.sum("count")).first()[0] or 0) // policy.postings)  # an item is never divided
        block = F.pmod(F.xxhash64("row"), F.lit(max(1, blocks)))
        out = None
        for b in range(max(1, blocks)):
            index = Index(terms.where(block == b).select("row", "term", "n").toArrow())
            counted = stage(texts.mapInArrow(_count(index.terms), "doc_id bigint, n bigint, terms binary, tf binary"), "term-counts")
            sums = dict(counted.select("n", "terms").mapInArrow(_statistics(len(index.terms)), "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect())
            index.weigh(sums.get(-1, 0), sums.get(-2, 0), np.array([sums.get(t, 0) for t in range(len(index.terms))], np.int64))
            hit = counted.where("terms IS NOT NULL AND doc_id IS NOT NULL")
            tops = hit.mapInArrow(_search(index, policy), "task bigint, row bigint, doc_id bigint, score bigint")
            for keys in (["row", F.pmod("task", F.lit(policy.merge))], ["row"]):
                tops = tops.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= policy.k)
            tops = stage(tops.select("row", "rank", "doc_id", "score"), "tops")
            out = tops if out is None else out.unionAll(tops)
        named = terms.select("row", "item_id").distinct()
        return keep(out.join(named, "row").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranking")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+') AS terms FROM {docs}),
i AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM {items}),
q AS (SELECT i, item_id, term, count(*) AS times FROM i GROUP BY ALL),
corpus AS (SELECT count(*) AS n, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, corpus),
s AS (SELECT i, item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(terms) * n) // total))))::BIGINT AS score
      FROM tf JOIN d USING (r) JOIN q USING (term) JOIN w USING (term), corpus WHERE doc_id IS NOT NULL GROUP BY i, item_id, r, doc_id),
t AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM t WHERE rank <= 20"""
