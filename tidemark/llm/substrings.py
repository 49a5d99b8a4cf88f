"""Substring dedup by content-defined chunks (operator 5).

A gear rolling hash over the last 32 bytes picks cut points among the starts of words (in text without spaces among its
characters), so cuts depend on nearby content only and an insertion moves no later chunk. Chunks are deduplicated by a 128-bit
digest. Neighbouring chunks that repeat the same other place, side by side there too, make a run; each run then grows to
both sides as far as the words around it equal those around the other place. Runs of enough words count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep, scratch, stage
from tidemark.llm.tokens import buffers, mix, runs

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class ChunkPolicy:
    """least, most: bytes of a chunk. bits: a word start is a cut point with a chance of 1 in 2**bits. inner: bytes without a space
    from which characters can be cut points too, with a chance of 1 in 2**inner_bits. span_words: least words of a repeated
    span; word_chars characters count as a word where spaces are rarer. reach: words by which a run of
    seed_words or more can grow to a side."""

    least: int = 32
    most: int = 512
    bits: int = 2
    inner: int = 64
    inner_bits: int = 5
    span_words: int = 20
    word_chars: int = 16
    seed_words: int = 6
    reach: int = 40


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of it and the 31 bytes before it: h = 2 h + gear[byte], in 32 bits, by doubling."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def cut_points(data: np.ndarray, offsets: np.ndarray, policy: ChunkPolicy = ChunkPolicy()) -> list[list[int]]:
    """Byte positions, from each text's start to its end, between which its chunks lie."""
    n = len(data)
    if not n:
        return [[0] for _ in offsets[1:]]
    blank = _SPACE[data]
    h = gear_hashes(data)
    start = np.zeros(n, bool)
    start[1:] = blank[:-1] & ~blank[1:] & (h[:-1] >> np.uint32(32 - policy.bits) == 0)
    char = (data & 0xC0) != 0x80  # no cut parts a character
    at = np.arange(n)
    border = blank.copy()
    border[offsets[:-1][offsets[:-1] < n]] = True
    since = at - np.maximum.accumulate(np.where(border, at, -1))  # bytes since a space or the text's start
    start[1:] |= (since[1:] >= policy.inner) & char[1:] & ~blank[1:] & (h[:-1] >> np.uint32(32 - policy.inner_bits) == 0)
    places = np.flatnonzero(start)
    at = np.searchsorted(places, offsets)
    out = []
    for k in range(len(offsets) - 1):
        a, b = int(offsets[k]), int(offsets[k + 1])
        cuts, last = [0], a
        for p in [*places[at[k] : at[k + 1]].tolist(), b]:
            if p - last < policy.least and p < b:
                continue
            while p - last > policy.most:
                last += policy.most
                while not char[last]:
                    last -= 1
                cuts.append(last - a)
            if p > last:
                last = p
                cuts.append(p - a)
        out.append(cuts)
    return out


def document_chunks(docs: DataFrame, policy: ChunkPolicy = ChunkPolicy()) -> DataFrame:
    """doc_id, th (hash of the text) and chunks (hi, lo: digest; pos, size: code points; words) of every text with a word. White space at the ends is not digested."""
    fields = "hi:bigint,lo:bigint,pos:int,size:int,words:int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for i, j in runs(offsets):
                part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                cuts = cut_points(part, off, policy)
                sizes = np.array([len(c) - 1 for c in cuts])
                begin = np.concatenate([np.asarray(c[:-1], np.int64) + off[k] for k, c in enumerate(cuts)])
                end = np.concatenate([np.asarray(c[1:], np.int64) + off[k] for k, c in enumerate(cuts)])
                points = np.append(0, np.cumsum((part & 0xC0) != 0x80))
                blank = _SPACE[part]
                first = ~blank
                first[1:] &= blank[:-1]
                first[begin[begin < len(part)]] |= ~blank[begin[begin < len(part)]]
                words = np.append(0, np.cumsum(first))
                blob = part.tobytes()
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(blob[a:b].strip(b" \t\n\v\f\r")) for a, b in zip(begin.tolist(), end.tolist(), strict=True)), ">i8").astype(np.int64)
                base = np.repeat(points[off[:-1]], sizes)
                cols = [digest[0::2], digest[1::2], (points[begin] - base).astype(np.int32), (points[end] - points[begin]).astype(np.int32), (words[end] - words[begin]).astype(np.int32)]
                structs = pa.StructArray.from_arrays([pa.array(c) for c in cols], ["hi", "lo", "pos", "size", "words"])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), structs)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), lists], ["doc_id", "th", "chunks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.hash("text").alias("th"), "text").where("text IS NOT NULL").mapInArrow(run, f"doc_id {kind}, th int, chunks array<struct<{fields}>>")


def _place(pos: str = "pos"):
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", F.col(pos).alias("pos"))


def _chains(hits: list, side: str, me: tuple) -> Iterator[tuple[int, int, int, tuple]]:
    """(start, end, words, other place) of the runs of neighbouring chunks that repeat one other place, side by side there too."""
    run: list | None = None
    for c in sorted(hits, key=lambda c: c["pos"]):
        other = tuple(c[side][k] for k in ("none", "doc_id", "th", "pos"))
        if other == (*me, c["pos"]):
            continue
        if run and run[1] == c["pos"] and run[3][:3] == other[:3] and run[3][3] + run[1] - run[0] == other[3]:
            run[1] += c["size"]
            run[2] += c["words"]
            continue
        if run:
            yield tuple(run)
        run = [c["pos"], c["pos"] + c["size"], c["words"], other]
    if run:
        yield tuple(run)


def repeated_runs(docs: DataFrame, policy: ChunkPolicy = ChunkPolicy()) -> DataFrame:
    """(doc_id, th, start, end, words, later, other, other_th, other_none, at): runs of whole chunks that repeat a place in a document: its first one (later: true) or its last."""
    chunks = stage(document_chunks(docs, policy), "chunks")
    flat = chunks.select("doc_id", "th", F.inline("chunks")).where("words > 0")
    seen = flat.groupBy("hi", "lo").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last")).where("first < last")
    hits = flat.join(seen, ["hi", "lo"])
    own = F.struct("pos", "size", "words", "first", "last")
    grouped = hits.groupBy("doc_id", "th").agg(F.collect_set(own).alias("hits"))  # one document's own chunks
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for doc, th, hits in zip(pdf["doc_id"], pdf["th"], pdf["hits"], strict=True):
                me = (pd.isna(doc), None if pd.isna(doc) else doc if isinstance(doc, str) else int(doc), th)
                for later, side in ((True, "first"), (False, "last")):
                    out += [[me[1], th, a, b, n, later, o[1], o[2], o[0], o[3]] for a, b, n, o in _chains(hits, side, me)]
            yield pd.DataFrame(out, columns=["doc_id", "th", "start", "end", "words", "later", "other", "other_th", "other_none", "at"]).astype({"doc_id": "object", "other": "object"})

    return grouped.mapInPandas(run, f"doc_id {kind}, th int, start int, end int, words int, later boolean, other {kind}, other_th int, other_none boolean, at int")


def _contexts(docs: DataFrame, places: DataFrame, policy: ChunkPolicy) -> DataFrame:
    """(doc_id, th, at, ahead, near, steps): hashes of the words that begin at each place (ahead) or end before it, the nearest first, and how far their far ends are. places: (doc_id, th, at, ahead), distinct."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = places.groupBy("doc_id", "th").agg(F.collect_set(F.struct("at", "ahead")).alias("ats"))  # places of one document
    rows = docs.select("doc_id", F.hash("text").alias("th"), "text").where("text IS NOT NULL")
    far = 25 * policy.reach

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for doc, th, text, ats in zip(pdf["doc_id"], pdf["th"], pdf["text"], pdf["ats"], strict=True):
                for at, ahead in ((int(p["at"]), p["ahead"]) for p in ats):
                    low = at if ahead else max(0, at - far)
                    piece = text[low : low + far] if ahead else text[low:at]
                    if ahead:
                        words = [(m.group(), m.end()) for m in _WORD.finditer(piece) if m.end() < len(piece) or low + far >= len(text)]
                    else:
                        words = [(m.group(), at - low - m.start()) for m in _WORD.finditer(piece) if m.start() or not low][::-1]
                    words = words[: policy.reach]
                    out.append([doc, th, at, ahead, [xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) - (1 << 31) for w, _ in words], [n for _, n in words]])
            yield pd.DataFrame(out, columns=["doc_id", "th", "at", "ahead", "near", "steps"])

    joined = rows.join(wanted, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])
    return joined.select("doc_id", "th", "text", "ats").mapInPandas(run, f"doc_id {kind}, th int, at int, ahead boolean, near array<int>, steps array<smallint>")


def _grown(docs: DataFrame, found: DataFrame, policy: ChunkPolicy) -> DataFrame:
    """found with start, end and words grown to both sides as far as the words agree with those around the other place."""
    stop = F.col("at") + F.col("end") - F.col("start")
    place = lambda doc, th, at, ahead: F.struct(F.col(doc).alias("doc_id"), F.col(th).alias("th"), at.alias("at"), F.lit(ahead).alias("ahead"))
    four = [place("doc_id", "th", F.col("start"), False), place("doc_id", "th", F.col("end"), True), place("other", "other_th", F.col("at"), False), place("other", "other_th", stop, True)]
    places = found.where("NOT other_none AND doc_id IS NOT NULL").where(F.greatest(F.col("words"), F.floor((F.col("end") - F.col("start")) / policy.word_chars)) >= policy.seed_words).select(F.explode(F.array(*four)).alias("p")).select("p.*").distinct()
    around = stage(_contexts(docs, places, policy), "contexts")

    def side(at: str, doc: str, th: str, ahead: bool, **columns: str) -> DataFrame:
        return around.where(F.col("ahead") == ahead).select(F.col("doc_id").alias(doc), F.col("th").alias(th), F.col("at").alias(at), *[F.col(c).alias(n) for n, c in columns.items()])

    x = found.withColumn("stop", stop)
    x = x.join(side("start", "doc_id", "th", False, l1="near", p1="steps"), ["doc_id", "th", "start"], "left")
    x = x.join(side("end", "doc_id", "th", True, r1="near", q1="steps"), ["doc_id", "th", "end"], "left")
    x = x.join(side("at", "other", "other_th", False, l2="near"), ["other", "other_th", "at"], "left")
    x = x.join(side("stop", "other", "other_th", True, r2="near"), ["other", "other_th", "stop"], "left")

    def agree(a: str, b: str):
        same = F.coalesce(F.array_position(F.zip_with(F.col(a), F.col(b), lambda p, q: F.coalesce(p == q, F.lit(False))), F.lit(False)), F.lit(1).cast("long"))
        return F.when(same == 0, F.size(a)).otherwise(same - 1).cast("int")

    x = x.withColumn("nl", agree("l1", "l2")).withColumn("nr", agree("r1", "r2"))
    grown = lambda n, steps: F.when(F.col(n) > 0, F.get(steps, F.col(n) - 1).cast("int")).otherwise(F.lit(0))
    return x.select("doc_id", "th", "later", "other", (F.col("start") - grown("nl", "p1")).alias("start"), (F.col("end") + grown("nr", "q1")).alias("end"), (F.col("words") + F.col("nl") + F.col("nr")).alias("words"))


def repeated_spans(docs: DataFrame, policy: ChunkPolicy = ChunkPolicy()) -> DataFrame:
    """One row for each document with a repeated span of policy.span_words or more.

    n_spans, span_chars: of spans that occur in another place too, first occurrences included; drop_chars: of those that
    repeat an earlier place (a lesser id, or further up); first_docs: documents of the first occurrences; spans: start:end in
    code points, comma-joined; drop_spans: the part that dedup removes, likewise. Null and empty texts have none. Rows that
    repeat an id and a text count as one document, other texts of an id as documents of their own. Rows without an id come last
    in the order of places, and their runs do not grow. Needs doc_id and text; other columns are not looked at.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    with scratch(docs.sparkSession):
        with scratch(docs.sparkSession):  # the chunks go when the runs are found
            found = keep(repeated_runs(docs, policy), "runs")
        grown = _grown(docs, found, policy)
        enough = F.greatest(F.col("words"), F.floor((F.col("end") - F.col("start")) / policy.word_chars)) >= policy.span_words
        grouped = grown.where(enough).groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("start", "end", "later", "other"))).alias("runs"))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                out = []
                for doc, found in zip(pdf["doc_id"], pdf["runs"], strict=True):
                    spans, drops = _union(found), _union([r for r in found if r["later"]])
                    firsts = sorted({r["other"] for r in found if r["later"] and not pd.isna(r["other"])} - {doc})
                    text = lambda x: ",".join(f"{a}:{b}" for a, b in x)
                    size = lambda x: sum(b - a for a, b in x)
                    out.append([doc, len(spans), size(spans), size(drops), firsts, text(spans), text(drops)])
                yield pd.DataFrame(out, columns=["doc_id", "n_spans", "span_chars", "drop_chars", "first_docs", "spans", "drop_spans"])

        rows = grouped.mapInPandas(run, f"doc_id {kind}, n_spans long, span_chars long, drop_chars long, first_docs array<{kind}>, spans string, drop_spans string")
        return keep(rows, "spans")


def _union(found: list) -> list[list[int]]:
    """Intervals that overlap, or touch, as one; found in order of their starts."""
    out: list[list[int]] = []
    for r in found:
        if out and r["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["end"])
        else:
            out.append([r["start"], r["end"]])
    return out


def drop_repeats(docs: DataFrame, policy: ChunkPolicy = ChunkPolicy()) -> DataFrame:
    """docs with the repeats of earlier spans cut out of the texts; columns as they are. Rows without an id, and those of an id with several texts, stay as they are."""
    drops = repeated_spans(docs, policy).where("drop_chars > 0 AND doc_id IS NOT NULL").select(F.struct("doc_id", "drop_spans").alias("d"))
    single = docs.groupBy("doc_id").agg(F.countDistinct("text").alias("n")).where("n = 1").select(F.struct("doc_id").alias("one"))
    drops = drops.join(single, F.col("d.doc_id") == F.col("one.doc_id")).select("d.doc_id", "d.drop_spans").toDF("_tm_of", "_tm_drop")
    joined = docs.join(drops, docs["doc_id"] == F.col("_tm_of"), "left")
    pairs = F.transform(F.split("_tm_drop", ","), lambda s: F.split(s, ":").cast("array<int>"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, p: F.struct(p[1].alias("at"), F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, p[0] - a["at"])).alias("out"))
    cut = F.aggregate(pairs, start, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text") - a["at"])))
    return joined.withColumn("text", F.when(F.col("_tm_drop").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
