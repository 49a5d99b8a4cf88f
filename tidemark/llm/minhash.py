"""Near-duplicate classes by improved consistent weighted sampling (operator 1).

A document is its weighted set of 5-word shingles: the count of a shingle times the mean inverse document frequency of its
words (document frequencies of all documents, in a fixed number of hashed buckets). Improved consistent weighted sampling
gives signatures whose positions agree with a probability of the weighted Jaccard similarity; bands of them make buckets.

Exact copies collapse to one text first. In each bucket every text is compared with a leader, so a bucket of n texts costs n
comparisons. Buckets whose texts are not all in one class then go on: the texts outside the bucket's largest class meet
those of other classes: in small buckets as pairs; in large ones first the best agreeing partners of a text, then, block by
block, all that are left, and only links leave a block. No two texts of a bucket stay apart without a comparison, and no
pair inside a class is made. Pairs whose signatures agree in far fewer positions than the threshold asks for are dropped, the others are
verified by the weighted Jaccard similarity of their whole texts. Classes are the connected components of the verified links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_rows, keep, scratch, small, stage
from tidemark.llm.tokens import Splitter, Words, buffers, mix, runs, shingles

DF_BITS = 18
_STEP = 4096


@dataclass(frozen=True)
class NearPolicy:
    """bands x rows sampled positions. slack: share of agreeing positions below which a
    pair is not verified (four standard deviations under the threshold). all_pairs: size of a small bucket. block: texts of a block of a large one."""

    size: int = 5
    threshold: float = 0.8
    bands: int = 16
    rows: int = 4
    slack: float = 0.6
    all_pairs: int = 16
    block: int = 512
    df_tasks: int = 4096


def document_frequencies(docs: DataFrame, policy: NearPolicy = NearPolicy()) -> tuple[np.ndarray, int]:
    """Documents that hold a word of each hashed bucket, and documents with a word; 2**DF_BITS numbers whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, total = Splitter(lower=True), np.zeros((1 << DF_BITS) + 1, np.int64)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for i, j in runs(offsets):
                w = splitter.split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                keys = np.unique(w.doc.astype(np.int64) << DF_BITS | (w.hashes >> np.uint64(64 - DF_BITS)).astype(np.int64))
                total[:-1] += np.bincount(keys & ((1 << DF_BITS) - 1), minlength=1 << DF_BITS)
                total[-1] += (w.counts() > 0).sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    counted = docs.select("text").coalesce(policy.df_tasks).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((1 << DF_BITS) + 1, np.int64)
    out[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return out[:-1], int(out[-1])


def inverse_frequencies(df: np.ndarray, docs: int) -> np.ndarray:
    return np.log1p(docs / (df + 0.5)).astype(np.float32)


def weighted_shingles(words: Words, idf: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight, text) of the distinct shingles, sorted by text and hash."""
    h, of = shingles(words, size)
    if not len(h):
        return h, np.zeros(0, np.float32), of
    value = np.append(0, np.cumsum(idf[(words.hashes >> np.uint64(64 - DF_BITS)).astype(np.int64)], dtype=np.float64))
    counts = words.counts()
    first = np.cumsum(counts) - counts
    made = np.bincount(of, minlength=len(counts))
    nth = np.arange(len(of)) - np.repeat(np.cumsum(made) - made, made)
    at = first[of] + nth
    width = np.minimum(size, counts[of])
    mean = ((value[at + width] - value[at]) / width).astype(np.float32)
    order = np.lexsort((h, of))
    h, of, mean = h[order], of[order], mean[order]
    new = np.append(True, (h[1:] != h[:-1]) | (of[1:] != of[:-1]))
    start = np.flatnonzero(new)
    times = np.diff(np.append(start, len(h)))
    return h[start], np.maximum(mean[start], 1e-3) * times.astype(np.float32), of[start]


class Sampler:
    """Improved consistent weighted sampling; the Gamma(2, 1) variates of a hash come from quantile tables."""

    def __init__(self, n: int):
        p = (np.arange(_STEP) + 0.5) / _STEP
        x = np.full(_STEP, 1.5)
        for _ in range(60):  # Newton steps on 1 - (1 + x) exp(-x) = p
            x = np.clip(x - (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-12), x / 4, x * 4)
        self.gamma, self.log_gamma = x.astype(np.float32), np.log(x).astype(np.float32)
        self.seed = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def signature(self, h: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """32-bit samples of one weighted set; memory is bounded whatever its size."""
        best, sample = None, None
        log_w = np.log(weight).astype(np.float32)
        for i in range(0, len(h), 2048):
            s, lw = h[i : i + 2048], log_w[i : i + 2048]
            x = s[None, :] * self.seed[:, None]
            x ^= x >> np.uint64(31)
            x *= np.uint64(0xD6E8FEB86659FD93)
            r = self.gamma[(x >> np.uint64(52)).astype(np.int32)]
            log_c = self.log_gamma[((x >> np.uint64(40)) & np.uint64(_STEP - 1)).astype(np.int32)]
            beta = ((x >> np.uint64(16)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(1 / (1 << 24))
            t = np.floor(lw / r + beta)
            log_a = log_c - r * (t - beta + np.float32(1))
            at = log_a.argmin(axis=1)
            rows = np.arange(len(at))
            low, picked = log_a[rows, at], (s[at] ^ (t[rows, at].astype(np.int64).astype(np.uint64) << np.uint64(40)))
            if best is None:
                best, sample = low, picked
            else:
                better = low < best
                best, sample = np.where(better, low, best), np.where(better, picked, sample)
        return (mix(sample) >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, idf: np.ndarray, policy: NearPolicy = NearPolicy()) -> DataFrame:
    """doc_id, digest (of the words), bands (bucket keys) and sig for every row; no words: null digest and no bands."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # 2**DF_BITS floats
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, sampler = Splitter(lower=True), Sampler(policy.bands * policy.rows)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for i, j in runs(offsets):
                w = splitter.split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                h, weight, of = weighted_shingles(w, shared.value, policy.size)
                cut = np.searchsorted(of, np.arange(j - i + 1))
                word = np.append(0, np.cumsum(w.counts()))
                digest, bands, sigs = [], [], []
                for k in range(j - i):
                    a, b = cut[k], cut[k + 1]
                    if a == b:
                        digest.append(None), bands.append([]), sigs.append([])
                        continue
                    digest.append(xxhash.xxh3_128_hexdigest(w.hashes[word[k] : word[k + 1]].tobytes()))
                    sig = sampler.signature(h[a:b], weight[a:b])
                    key = np.full(policy.bands, 0, np.uint64)
                    for part in sig.reshape(policy.bands, policy.rows).T:
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part)
                    bands.append(mix(key + np.arange(policy.bands, dtype=np.uint64)).view(np.int64))
                    sigs.append(sig.view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(digest, pa.string()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int32()))],
                    ["doc_id", "digest", "bands", "sig"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, digest string, bands array<long>, sig array<int>")


def _features(docs: DataFrame, ids: DataFrame, idf: np.ndarray, policy: NearPolicy) -> DataFrame:
    """(doc, h, w) of the documents in ids: sorted shingle hashes and weights, as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    rows = docs.select(F.col("doc_id").alias("doc"), "text").join(small(ids, 200_000), "doc", "left_semi")
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(lower=True)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for i, j in runs(offsets):
                h, weight, of = weighted_shingles(splitter.split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), shared.value, policy.size)
                cut = np.searchsorted(of, np.arange(j - i + 1))
                parts = [[x[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)] for x in (h, weight)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *[pa.array(p, pa.binary()) for p in parts]], ["doc", "h", "w"])

    return rows.mapInArrow(run, f"doc {kind}, h binary, w binary").dropDuplicates(["doc", "h", "w"])


def weighted_jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater weights; hashes sorted and distinct."""
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    hit = hb[at] == ha
    both = np.minimum(wa[hit], wb[at[hit]]).sum(dtype=np.float64)
    return float(both / (wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - both))


def _blocks(rows: DataFrame, policy: NearPolicy) -> tuple[DataFrame, DataFrame]:
    """The two sides of the block comparison of large buckets. rows: (key, band, doc, n, label, top, ...).

    Texts outside a bucket's largest class meet all texts of the bucket, one block with one block at a time.
    """
    blocks = F.ceil(F.col("n") / policy.block).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc"), blocks).cast("int"))
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    own = [c for c in rows.columns if c not in ("key", "n", "block")]
    outside = rows.where("label <> top")
    left = outside.select("key", F.col("block").alias("i"), every.alias("j"), *own)
    met = outside.select("key", F.col("block").alias("i")).distinct()  # a bucket is copied only to blocks that hold texts outside its largest class
    right = rows.join(met, "key").select("key", "i", F.col("block").alias("j"), *own)
    return left, right.toDF(*[f"{c}_r" for c in right.columns])


def _agreement(x: pd.DataFrame, y: pd.DataFrame, policy: NearPolicy) -> np.ndarray:
    """Agreeing positions of each pair of signatures; 0 for a pair of one class, one that an earlier band brings together, or one met the other way round."""
    sx, sy = np.stack(x["sig"].to_numpy()), np.stack(y["sig_r"].to_numpy())
    agree = np.zeros((len(x), len(y)), np.uint8)
    earlier = np.zeros(agree.shape, bool)
    for band in range(policy.bands):
        whole = np.ones(agree.shape, bool)
        for k in range(band * policy.rows, (band + 1) * policy.rows):
            same = sx[:, k][:, None] == sy[:, k]
            agree += same
            whole &= same
        if band < x["band"].iloc[0]:
            earlier |= whole
    dx, dy = x["doc"].to_numpy(), y["doc_r"].to_numpy()
    outside = (y["label_r"] != y["top_r"]).to_numpy()
    agree[earlier | (x["label"].to_numpy()[:, None] == y["label_r"].to_numpy()) | (outside & (dx[:, None] >= dy))] = 0
    return agree


def _block_pairs(rows: DataFrame, policy: NearPolicy, best: int = 4) -> DataFrame:
    """Pairs (a, b) of different classes from large buckets: the best agreeing partners of a text in each block."""
    left, right = _blocks(rows, policy)
    kind = rows.schema["doc"].dataType.simpleString()
    least = int(policy.slack * policy.bands * policy.rows)

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []})
        agree = _agreement(x, y, policy)
        to = np.argsort(-agree.astype(np.int16), axis=1, kind="stable")[:, :best]
        at = np.repeat(np.arange(len(x)), to.shape[1])
        to = to.ravel()
        ok = agree[at, to] >= least
        p, q = x["doc"].to_numpy()[at[ok]], y["doc_r"].to_numpy()[to[ok]]
        return pd.DataFrame({"a": np.minimum(p, q), "b": np.maximum(p, q)})

    return left.groupBy("key", "i", "j").cogroup(right.groupBy("key_r", "i_r", "j_r")).applyInPandas(compare, f"a {kind}, b {kind}")


def _block_links(rows: DataFrame, policy: NearPolicy) -> DataFrame:
    """Verified links (a, b) of different classes from large buckets. rows: with h and w, the shingles.

    Every pair that agrees well enough is compared, the best agreeing first; none is once its two classes are linked in the block.
    """
    left, right = _blocks(rows, policy)
    kind = rows.schema["doc"].dataType.simpleString()
    least = int(policy.slack * policy.bands * policy.rows)

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []})
        agree = _agreement(x, y, policy)
        at, to = np.nonzero(agree >= least)
        order = np.argsort(-agree[at, to].astype(np.int16), kind="stable")
        shingle = lambda df, s: [(np.frombuffer(h, np.uint64), np.frombuffer(w, np.float32)) for h, w in zip(df[f"h{s}"], df[f"w{s}"], strict=True)]
        fx, fy = shingle(x, ""), shingle(y, "_r")
        lx, ly = x["label"].tolist(), y["label_r"].tolist()
        dx, dy = x["doc"].tolist(), y["doc_r"].tolist()
        root: dict = {}

        def find(v):
            while root.get(v, v) != v:
                v = root[v]
            return v

        out = []
        for i, j in zip(at[order].tolist(), to[order].tolist(), strict=True):
            p, q = find(lx[i]), find(ly[j])
            if p != q and weighted_jaccard(*fx[i], *fy[j]) >= policy.threshold:
                root[p] = q
                out.append((min(dx[i], dy[j]), max(dx[i], dy[j])))
        return pd.DataFrame(out, columns=["a", "b"])

    return left.groupBy("key", "i", "j").cogroup(right.groupBy("key_r", "i_r", "j_r")).applyInPandas(compare, f"a {kind}, b {kind}")


def _verify(pairs: DataFrame, docs: DataFrame, sigs: DataFrame, idf: np.ndarray, policy: NearPolicy) -> DataFrame:
    """The pairs (a, b) with a similarity of the threshold or more."""
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    near = (
        pairs.join(sigs.select(F.col("doc").alias("a"), F.col("sig").alias("sa")), "a")
        .join(sigs.select(F.col("doc").alias("b"), F.col("sig").alias("sb")), "b")
        .where(agree >= int(policy.slack * policy.bands * policy.rows))
        .select("a", "b")
    )
    near = stage(near, "near")
    ids = near.select(F.col("a").alias("doc")).union(near.select(F.col("b").alias("doc"))).distinct()
    with arrow_rows(pairs.sparkSession, 2000):
        features = stage(_features(docs, stage(ids, "ids"), idf, policy), "shingles")
    side = lambda s: features.select(F.col("doc").alias(s), F.col("h").alias(f"h{s}"), F.col("w").alias(f"w{s}"))
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ha, wa, hb, wb = (batch.column(c).to_pylist() for c in ("ha", "wa", "hb", "wb"))
            keep = [
                weighted_jaccard(np.frombuffer(p, np.uint64), np.frombuffer(q, np.float32), np.frombuffer(r, np.uint64), np.frombuffer(s, np.float32)) >= policy.threshold
                for p, q, r, s in zip(ha, wa, hb, wb, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wide = near.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ha", "wa", "hb", "wb")
    with arrow_rows(pairs.sparkSession, 256):  # a row holds the shingles of two texts
        return stage(wide.mapInArrow(run, f"a {kind}, b {kind}"), "verified")


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(doc, label): the least document of the component of every document in edges (a, b). Minimum labels spread and jump until none changes."""
    both = stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("doc")).agg(F.least(F.col("doc"), F.min("b")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("doc").alias("b"), "label"), "b").groupBy(F.col("a").alias("doc")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "doc").select("doc", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("doc").alias("label"), F.col("label").alias("far"))
        labels_new = stage(spread.join(jump, "label", "left").select("doc", "old", F.least("label", "far").alias("label")), "labels")
        labels = labels_new.drop("old")
        if labels_new.where("label <> old").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def near_classes(docs: DataFrame, policy: NearPolicy = NearPolicy()) -> DataFrame:
    """doc_id, class_id, class_size, keeper for every row: class_id is the least doc_id of the class, keeper marks its document.

    Texts without words are never copies: each is its own class. Rows that repeat an id count as one document if their texts
    agree; an id with several texts ties the classes of all of them to one. Rows without an id take the class of an equal
    text, else none. Needs doc_id and text; other columns are not looked at, whatever their names.
    """
    with scratch(docs.sparkSession):
        return keep(_near_classes(docs, policy), "classes")


def _near_classes(docs: DataFrame, policy: NearPolicy) -> DataFrame:
    df, n = document_frequencies(docs, policy)
    idf = inverse_frequencies(df, n)
    signed = stage(signatures(docs, idf, policy), "signed")
    texts = signed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"))
    texts = stage(texts.where("doc IS NOT NULL"), "texts")
    sigs = texts.select("doc", "sig")
    banded = texts.select("doc", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("leader")).where("n > 1")
    buckets = stage(banded.join(shared, "key"), "buckets")  # texts that share a bucket with another

    pairs = buckets.where("doc <> leader").select(F.least("doc", "leader").alias("a"), F.greatest("doc", "leader").alias("b")).distinct()
    pairs = stage(pairs, "pairs")
    links = stage(_verify(pairs, docs, sigs, idf, policy), "links")
    labels = connected_components(links)
    big = F.col("n") > policy.all_pairs

    def unsettled() -> DataFrame:
        """Texts of buckets that are not one class yet."""
        named = buckets.select("key", "band", "doc", "n").join(labels, "doc", "left").withColumn("label", F.coalesce("label", "doc"))
        sizes = named.groupBy("key", "label").agg(F.count("*").alias("m"))
        top = sizes.groupBy("key").agg(F.max(F.struct("m", "label"))["label"].alias("top"), F.count("*").alias("parts")).where("parts > 1").select("key", "top")
        return stage(named.join(top, "key").select("key", "band", "doc", "n", "label", "top"), "split")

    split = unsettled()
    few = split.where(~big)
    others = few.select("key", F.col("doc").alias("other"), F.col("label").alias("other_label"))
    both = few.where("label <> top").join(others, "key").where("label <> other_label")
    new = both.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).union(_block_pairs(split.where(big).join(sigs, "doc"), policy))
    new = stage(new.distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    links = stage(links.union(_verify(new, docs, sigs, idf, policy)), "links")
    labels = connected_components(links)
    split = unsettled().where(big)
    if not split.isEmpty():
        features = stage(_features(docs, stage(split.select("doc").distinct(), "ids"), idf, policy), "shingles")
        with arrow_rows(docs.sparkSession, 256):
            links = stage(links.union(_block_links(split.join(sigs, "doc").join(features, "doc"), policy)), "links")
        labels = connected_components(links)

    classes = texts.select("digest", "doc").join(labels, "doc", "left").select("digest", F.coalesce("label", "doc").alias("class"))
    out = signed.select("doc_id", "digest").join(classes, "digest", "left").select("doc_id", F.coalesce("class", "doc_id").alias("class_id"))
    counts = out.groupBy("class_id").agg(F.countDistinct("doc_id").alias("class_size"))
    joined = out.join(counts, "class_id", "left")
    return joined.select("doc_id", "class_id", F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("keeper"))


def drop_near_copies(docs: DataFrame, policy: NearPolicy = NearPolicy()) -> DataFrame:
    """docs with one document of each class, the one of the least id; columns as they are."""
    dropped = stage(near_classes(docs, policy).where(~F.col("keeper")).select("doc_id").distinct(), "dropped")
    return docs.join(small(dropped, 200_000), "doc_id", "left_anti").select(*docs.columns)
