"""Quality classifier: a factorisation machine (operator 2).

Features of a text are its hashed words, bins of structure statistics (symbols, capitals, repetition, line shape) and
bins of metadata (its stated and its real length). The score is
sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)), linear in the features.
The machine is fitted on a bounded sample of labelled rows; labels, language, source and id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import Splitter, Words, buffers, runs

WORD_BITS = 14
BINS = 16
STATS = ("symbols", "pipes", "bangs", "capitals", "digits", "stutter", "repeats", "lines", "word_length", "words", "stated_chars")
SIZE = (1 << WORD_BITS) + BINS * len(STATS)


@dataclass(frozen=True)
class FmPolicy:
    """sample: bound on the labelled rows that are fitted on, the first in the order of a hash of their ids."""

    sample: int = 8_000
    rank: int = 6
    epochs: int = 12
    batch: int = 256
    rate: float = 0.1
    decay: float = 1e-4
    accept: float = 0.3


def held_out(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text leaves no remainder. Null ids count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def _features(words: Words, stated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, value, text) sorted by text; the squared values of a text's words sum to 1, each bin has value 1/2."""
    n = len(words.offsets) - 1
    counts = words.counts()
    keys, times = np.unique(words.doc.astype(np.int64) << WORD_BITS | (words.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
    of = keys >> WORD_BITS
    value = np.log1p(times).astype(np.float32)
    norm = np.sqrt(np.bincount(of, value**2, n))
    value /= norm[of].astype(np.float32)

    def per_text(*codes: int | range) -> np.ndarray:
        table = np.zeros(256, bool)
        for c in codes:
            table[c] = True
        return np.diff(np.append(0, np.cumsum(table[words.data], dtype=np.int64))[words.offsets])

    many, size = np.maximum(counts, 1), np.maximum(np.diff(words.offsets), 1)
    twin = np.bincount(words.doc[1:][(words.hashes[1:] == words.hashes[:-1]) & (words.doc[1:] == words.doc[:-1])], minlength=n)
    distinct = np.bincount(of, minlength=n)
    log = lambda x: np.log2(np.maximum(x, 0) + 1)
    stats = [
        per_text(*map(ord, "#*$%&<>")) / many * 8,
        per_text(ord("|")) / many * 16,
        per_text(ord("!")) / many * 8,
        per_text(list(range(65, 91))) / size * 24,
        per_text(list(range(48, 58))) / size * 24,
        twin / many * 16,
        np.where(counts > 0, 1 - distinct / many, 0) * 16,
        log(per_text(10) / many * 64),
        size / many,
        log(counts),
        log(stated),
    ]
    bins = [(1 << WORD_BITS) + BINS * k + np.clip(np.nan_to_num(s), 0, BINS - 1).astype(np.int64) for k, s in enumerate(stats)]
    feature = np.concatenate([keys & ((1 << WORD_BITS) - 1), *bins])
    of = np.concatenate([of, *[np.arange(n)] * len(bins)])
    value = np.concatenate([value, np.full(n * len(bins), 0.5, np.float32)])
    order = np.argsort(of, kind="stable")
    return feature[order], value[order], of[order]


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, feature: np.ndarray, value: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        """Sum-of-squares identity, one pass over the features of n texts; each text has some, sorted."""
        out = np.full(n, self.w0) + np.bincount(of, self.w[feature] * value, n)
        for f in range(self.v.shape[1]):
            part = self.v[feature, f] * value
            out += 0.5 * (np.bincount(of, part, n) ** 2 - np.bincount(of, part * part, n))
        return out


def fit_machine(feature: np.ndarray, value: np.ndarray, sizes: np.ndarray, y: np.ndarray, policy: FmPolicy) -> Machine:
    """Mini-batch AdaGrad on logistic loss over texts of sizes[i] features each. Without labels of both kinds: the share of label 1."""
    rng = np.random.default_rng(7)
    share = np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, policy.rank)))
    if len(y) == 0 or y.min() == y.max():
        m.v[:] = 0
        return m
    gw, gv, g0 = np.full(SIZE, 1e-6), np.full(m.v.shape, 1e-6), 1e-6
    ends = np.cumsum(sizes)
    for _ in range(policy.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), policy.batch):
            rows = order[at : at + policy.batch]
            take = np.concatenate([np.arange(ends[r] - sizes[r], ends[r]) for r in rows])
            of = np.repeat(np.arange(len(rows)), sizes[rows])
            f, x = feature[take], value[take].astype(float)
            err = 1 / (1 + np.exp(-m.margin(f, x, of, len(rows)))) - y[rows]
            e = err[of] * x
            used = np.unique(f)
            step = np.bincount(f, e, SIZE)[used] + policy.decay * m.w[used]
            gw[used] += step**2
            d0 = err.sum()
            g0 += d0**2
            for k in range(policy.rank):
                part = m.v[f, k] * x
                total = np.bincount(of, part, len(rows))
                d = np.bincount(f, e * (total[of] - part), SIZE)[used] + policy.decay * m.v[used, k]
                gv[used, k] += d**2
                m.v[used, k] -= policy.rate * d / np.sqrt(gv[used, k])
            m.w[used] -= policy.rate * step / np.sqrt(gw[used])
            m.w0 -= policy.rate * d0 / np.sqrt(g0)
    return m


def train_quality(docs: DataFrame, labels: DataFrame, policy: FmPolicy = FmPolicy()) -> Machine:
    """Machine from at most policy.sample labelled documents of the learning folds; repeated labels of an id count as the lowest."""
    marked = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = marked.where(~held_out(F.col("doc_id"), 5)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(policy.sample)
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(marked), "doc_id").select("text", "n_chars", "quality")  # sample rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter()
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            stated = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in runs(offsets):
                f, x, of = _features(splitter.split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), stated[i:j])
                cuts = np.append(0, np.cumsum(np.bincount(of, minlength=j - i))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(a)) for a in (f.astype(np.int32), x.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([*lists, batch.column(2).slice(i, j - i).cast(pa.int32())], ["f", "x", "y"])

    got = rows.mapInArrow(run, "f array<int>, x array<float>, y int").toArrow()
    flat = lambda name, kind: np.concatenate([np.zeros(0, kind), *[c.flatten().to_numpy() for c in got[name].chunks]])
    sizes = np.concatenate([np.zeros(0, np.int64), *[np.diff(c.offsets.to_numpy()) for c in got["f"].chunks]]).astype(np.int64)
    return fit_machine(flat("f", np.int64).astype(np.int64), flat("x", np.float32), sizes, got["y"].to_numpy().astype(float), policy)


def score_quality(docs: DataFrame, machine: Machine, policy: FmPolicy = FmPolicy()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row. Null and empty texts get the score of a text without words; a null
    n_chars counts as 0, a null id as held out; rows that repeat are scored each. Needs doc_id, text and n_chars; other
    columns are not looked at, whatever their names.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    small = Machine(machine.w0, machine.w.astype(np.float32), machine.v.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter()
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            stated = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
            score = np.zeros(len(batch))
            for i, j in runs(offsets):
                part = _features(splitter.split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), stated[i:j])
                score[i:j] = 1 / (1 + np.exp(-np.clip(small.margin(*part, j - i), -60, 60)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    scored = docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n_chars")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), 5).alias("held_out"), "score", (F.col("score") >= policy.accept).cast("int").alias("predicted"))
