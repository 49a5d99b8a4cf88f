"""Packing of tokenised documents into sequences (operator 13).

Bounded-space online packing: a partition keeps a fixed number of open windows. A piece goes into the fullest window that
holds it (best fit); if none does and no further window may be opened, the fullest is emitted. One that would leave more
than `slack` places empty is first filled with the head of the piece. What is open at a partition's end meets the leftovers
of `fan_in` partitions, longest pieces first, under the same rule, and so on in rounds until one set is left; this is
concatenated, and its last rest is cut at powers of two, which need no padding. A task's memory is its open windows and one
run of text, whatever the sizes of the table and of a document.

Rows: a null text counts as empty, an empty one is its end token only; repeated rows are documents of their own; a null
doc_id stays null; an empty table gives no rows; columns besides doc_id and text take no part, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep, scratch, stage
from tidemark.llm.tokens import buffers, pack, unpack


@dataclass(frozen=True)
class PackPolicy:
    window: int = 4096
    open_windows: int = 64
    slack: int = 32
    fan_in: int = 64
    end_id: int = 2


class WordEncoder:
    """Ids of texts under a lower-casing word BPE of the tokenizers library.

    Its split never crosses white space, so words are encoded apart and repeated ones once. A word of plain characters falls
    into runs of letters, single digits and runs of signs, as under the vocabulary's own pattern; any other word (quotes,
    further scripts, special tokens) goes through the library whole.
    """

    limit = 800_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        kind = np.full(256, 4, np.uint8)  # what may not be cut inside a word
        kind[[0x20, *range(0x09, 0x0E)]] = 0
        kind[0x21:0x7F] = 3
        kind[0x30:0x3A] = 2
        kind[0x41:0x5B] = kind[0x61:0x7B] = 1
        kind[0x27] = 4
        self.kind = kind
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        self.shown = {b: 256 + i for i, b in enumerate(others)}  # characters that stand for bytes
        self._clear()

    def _clear(self):
        self.slots: dict[bytes, int] = {}
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, words: list[bytes], odd: np.ndarray) -> None:
        even = [w for w, o in zip(words, odd, strict=True) if not o]
        shown, coded = self.shown, []
        for w in even:
            coded.append([t.id for t in self.model.tokenize(w.decode() if w.isascii() else w.decode("latin-1").translate(shown))])
        rest = [w for w, o in zip(words, odd, strict=True) if o]
        coded += [x.ids for x in self.whole.encode_batch([w.decode() for w in rest], add_special_tokens=False)]
        self.slots.update(zip(even + rest, range(len(self.starts) - 1, len(self.starts) - 1 + len(words)), strict=True))
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(sizes))
        self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(coded), np.uint32, int(sizes.sum())))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends of the texts among them) of UTF-8 texts."""
        n, m = len(data), len(offsets) - 1
        if not n:
            return np.zeros(0, np.uint32), np.zeros(m, np.int64)
        kind, low = self.kind[data], self.fold[data]
        pair = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # letters of Latin-1
        kind[pair] = kind[pair + 1] = 1
        capital = pair[data[pair + 1] <= 0x9E] + 1
        low[capital] += 32
        kind[np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))] = 4  # <|
        inside = kind != 0
        kinds = kind[inside]
        if not len(kinds):
            return np.zeros(0, np.uint32), np.zeros(m, np.int64)
        word = np.ones(n, bool)
        word[1:] = kind[:-1] == 0
        word[offsets[:-1][offsets[:-1] < n]] = True
        word = word[inside]
        begins = np.flatnonzero(word)
        strange = np.maximum.reduceat(kinds, begins) == 4
        cut = np.ones(len(kinds), bool)
        cut[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2)
        body = low[inside]
        if strange.any():
            whole = np.repeat(strange, np.diff(np.append(begins, len(kinds))))
            cut &= ~whole
            np.copyto(body, data[inside], where=whole)
        of = np.flatnonzero(cut | word)
        sort = kinds[of] if not strange.any() else np.where(whole[of], 4, kinds[of])
        edges = np.append(of, len(kinds)).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(edges), pa.py_buffer(body)]).dictionary_encode()
        named, index = parts.dictionary.to_numpy(zero_copy_only=False).tolist(), parts.indices.to_numpy()
        odd = np.zeros(len(named), bool)
        odd[index] = sort == 4
        if len(self.slots) + len(named) > self.limit:
            self._clear()
        new = [i for i, w in enumerate(named) if w not in self.slots]
        self._learn([named[i] for i in new], odd[new])
        slot = np.fromiter(map(self.slots.__getitem__, named), np.int64, len(named))
        begin, size = self.starts[slot][index], np.diff(self.starts)[slot][index]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(begin - ends + size, size) + np.arange(ends[-1])]
        before = np.append(0, np.cumsum(inside, dtype=np.int32))[offsets[1:]]  # characters that are no spaces before each text's end
        until = np.searchsorted(of, before)
        return ids, np.append(0, ends)[until]


def encoded(column: pa.Array, encoder: WordEncoder, run: int = 1 << 22) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(row, ids, whether the row ends) of a text column, in order; a text longer than run comes in several parts, cut at spaces."""
    data, offsets = buffers(column)
    spaces, i, n = encoder.kind == 0, 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + run, side="right")) - 1)
        at, end = int(offsets[i]), int(offsets[j])
        if j == i + 1:
            while end - at > run:
                step = run
                while at + step < end and not len(blank := np.flatnonzero(spaces[data[at : at + step]])):
                    step *= 2
                if at + step >= end:
                    break
                stop = at + int(blank[-1]) + 1
                yield i, encoder.encode(data[at:stop], np.array([0, stop - at]))[0], False
                at = stop
            yield i, encoder.encode(data[at:end], np.array([0, end - at]))[0], True
        else:
            ids, ends = encoder.encode(data[at:end], offsets[i : j + 1] - at)
            begin = 0
            for k, stop in enumerate(ends.tolist()):
                yield i + k, ids[begin:stop], True
                begin = stop
        i = j


@dataclass(order=True)
class _Window:
    gap: int
    number: int
    pieces: list = field(compare=False, default_factory=list)


class Packer:
    """Places pieces (key, ids); calls emit(pieces) for each finished sequence."""

    def __init__(self, policy: PackPolicy, emit):
        self.policy, self.emit, self.open, self.count = policy, emit, [], 0

    def add(self, key: tuple, start: int, ids: np.ndarray) -> None:
        p = self.policy
        while len(ids):
            if len(ids) >= p.window:
                self.emit([(key, start, ids[: p.window])])
                start, ids = start + p.window, ids[p.window :]
                continue
            at = bisect_left(self.open, _Window(len(ids), -1))
            if at < len(self.open):
                window, size = self.open.pop(at), len(ids)
            elif len(self.open) < p.open_windows:
                self.count += 1
                window, size = _Window(p.window, self.count), len(ids)
            else:
                window = self.open.pop(0)
                size = window.gap if window.gap > p.slack else 0
                if not size:
                    self.emit(window.pieces)
                    continue
            window.pieces.append((key, start, ids[:size].copy()))
            window.gap -= size
            if window.gap:
                insort(self.open, window)
            else:
                self.emit(window.pieces)
            start, ids = start + size, ids[size:]

    def leftovers(self) -> Iterator[tuple[tuple, int, np.ndarray]]:
        for window in self.open:
            yield from window.pieces
        self.open = []

    def finish(self) -> None:
        """Close all: pieces one after another, the last rest in sequences of a power of two."""
        room, held = self.policy.window, []
        pieces = sorted(self.leftovers(), key=lambda x: -len(x[2]))
        rest = sum(len(x[2]) for x in pieces)
        room = self._room(rest)
        for key, start, ids in pieces:
            while len(ids):
                size = min(room, len(ids))
                held.append((key, start, ids[:size]))
                start, ids, room, rest = start + size, ids[size:], room - size, rest - size
                if not room:
                    self.emit(held)
                    held, room = [], self._room(rest)

    def _room(self, rest: int) -> int:
        return self.policy.window if rest >= self.policy.window else 1 << max(0, rest.bit_length() - 1)


_ROW = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary, left int"


class _Rows:
    """Rows of one set of pieces; sequences are numbered by round, set and place."""

    def __init__(self, with_ids: bool, first: int, into: int):
        self.with_ids, self.next, self.into, self.rows = with_ids, first, into, []

    def emit(self, pieces: list) -> None:
        offset = 0
        for (doc, total), start, ids in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset, pack(ids) if self.with_ids else None, None))
            offset += len(ids)
        self.next += 1

    def leave(self, pieces) -> None:
        for (doc, total), start, ids in pieces:
            self.rows.append((doc, start, len(ids), None, total, None, None, pack(ids), self.into))

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least:
            names = [c.split()[0] for c in _ROW.split(", ")]
            types = [pa.int64()] * 7 + [pa.binary(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), types, strict=True)], names)
            self.rows = []


def _first_id(round_: int, part: int) -> int:
    return round_ << 58 | part << 32


_encoders: dict[str, WordEncoder] = {}


def _pack_texts(path: str, policy: PackPolicy, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(path, None) or WordEncoder(path)
        _encoders[path] = encoder  # stays with the worker for its next tasks
        part = TaskContext.get().partitionId()
        rows = _Rows(with_ids, _first_id(0, part), part)
        packer = Packer(policy, rows.emit)
        end = np.array([policy.end_id], np.uint32)
        for batch in batches:
            docs, held = batch.column(0).to_pylist(), []
            for i, ids, last in encoded(batch.column(1), encoder):
                held.append(ids)
                if last:
                    ids = np.concatenate([*held, end])
                    packer.add((docs[i], len(ids)), 0, ids)
                    held = []
                    yield from rows.batches(5000)
        rows.leave(packer.leftovers())
        yield from rows.batches(0)

    return run


def _merge(policy: PackPolicy, with_ids: bool, round_: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = packer = rows = None
        for batch in batches:
            for left, doc, start, total, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if left != group:
                    if packer:
                        yield from _close(packer, rows, last)
                    group, rows = left, _Rows(with_ids, _first_id(round_, left), left)
                    packer = Packer(policy, rows.emit)
                packer.add((doc, total), start, unpack(ids).astype(np.uint32))
                yield from rows.batches(5000)
        if packer:
            yield from _close(packer, rows, last)

    return run


def _close(packer: Packer, rows: _Rows, last: bool) -> Iterator[pa.RecordBatch]:
    if last:
        packer.finish()
    else:
        rows.leave(packer.leftovers())
    yield from rows.batches(0)


def pack_documents(docs: DataFrame, tokenizer: str, policy: PackPolicy = PackPolicy(), with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece; with_ids: and ids, the piece's ids as packed bytes (tokens.unpack)."""
    spark = docs.sparkSession
    with scratch(spark):
        done = stage(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_pack_texts(tokenizer, policy, with_ids), _ROW), "packed", codec="zstd")
        found, round_ = [done.where("left IS NULL")], 0
        sets = (done.agg(F.max("left")).first()[0] or 0) + 1
        while True:
            round_, sets = round_ + 1, -(-sets // policy.fan_in)
            group = F.floor(F.col("left") / policy.fan_in).cast("int")
            rest = done.where("left IS NOT NULL").select(group.alias("left"), "doc_id", "start", "doc_tokens", "ids", "length")
            rest = rest.repartition(sets, "left").sortWithinPartitions("left", F.desc("length"), "doc_id", "start", "ids").drop("length")
            done = stage(rest.mapInArrow(_merge(policy, with_ids, round_, sets == 1), _ROW), "packed", codec="zstd")
            found.append(done.where("left IS NULL"))
            if sets == 1:
                break
        out = found[0]
        for more in found[1:]:
            out = out.unionAll(more)
        return keep(out.drop("left") if with_ids else out.drop("left", "ids"), "sequences")
