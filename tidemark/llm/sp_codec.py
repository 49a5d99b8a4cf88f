"""SentencePiece encoding and decoding by batched numpy Viterbi (operator 4).

A text is cut into segments (the spaces before a word, and the word) that no piece crosses. The distinct segments of a
run of texts are encoded together: words of equal length advance as one matrix. Substring hashes probe the sorted keys of
the pieces of each length. At every end position the pieces that end there are candidates, from the longest down, and a
vectorised maximum stores the backpointer. The given model is a BPE model, so the largest sum of piece scores is not its
segmentation; a transition is therefore open only if the two neighbouring pieces, merged from their characters in the
order of the scores, come out as these two pieces. Just one candidate is then open at each position and the path is the
model's own encoding, character for character. Long words, of which few have one length, take the same steps one by one.
Spaces before a word join pieces last of all, from the left. Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import Splitter, buffers, runs

_B = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int64(1 << 40)
_SEGMENT = re.compile(r" *[^ \n]+| +|\n")
#: Characters of a word from which it is encoded alone: so long, hardly two words of a batch have one length.
_LONG = 64


def load_pieces(model_file: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind: normal, byte or special. Read on the driver only."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    kind = lambda i: "byte" if model.is_byte(i) else "special" if model.is_control(i) or model.is_unknown(i) else "normal"
    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.vocab_size())]


class Codec:
    """Tables of a BPE piece vocabulary; some megabytes, whatever the corpus."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == "normal"}
        self.score = [s for _, s, _ in pieces]
        self.bytes = np.zeros(256, np.int32)
        self.unknown = len(pieces)
        for i, (p, _, k) in enumerate(pieces):
            if k == "byte":
                self.bytes[int(p[3:5], 16)] = i
        raw = [bytes([int(p[3:5], 16)]) if k == "byte" else b"" if k == "special" else p.replace("▁", " ").encode() for p, _, k in pieces]
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(x) for x in raw])
        self.at = np.cumsum(self.size) - self.size
        # A merge comes the earlier the higher its piece scores; single characters are there from the start.
        order = {s: r for r, s in enumerate(sorted({s for _, s, k in pieces if k == "normal"}, reverse=True))}
        self.rank = np.full(len(pieces) + 1, -1, np.int64)
        self.left, self.right = np.full(len(pieces) + 1, -1), np.full(len(pieces) + 1, -1)
        pairs = {}
        for p, i in self.ids.items():
            if len(p) < 2:
                continue
            self.rank[i] = order[self.score[i]]
            for c in range(1, len(p)):
                a, b = self.ids.get(p[:c]), self.ids.get(p[c:])
                if a is not None and b is not None:
                    pairs[a * (len(pieces) + 1) + b] = self.rank[i]
            if not p.strip("▁"):
                continue
            path = self.merge(p, last=True)
            if len(path) == 2 and None not in path:
                self.left[i], self.right[i] = path
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list] = {}
        for p, i in self.ids.items():
            if i == self.ids.get(p) and (len(p) == 1 or self.left[i] >= 0):
                h = np.uint64(0)
                for ch in p:
                    h = np.multiply(h, _B) + np.uint64(ord(ch))
                by_size.setdefault(len(p), []).append((h, i))
        for n, found in by_size.items():
            found.sort()
            self.keys[n] = np.array([h for h, _ in found], np.uint64), np.array([i for _, i in found], np.int64)
        self.valid = {p: i for p, i in self.ids.items() if len(p) == 1 or self.left[i] >= 0}
        self.longest = max(map(len, self.valid), default=1)
        self.marks = sorted((len(p), i) for p, i in self.ids.items() if not p.strip("▁"))[::-1]
        self.rank_of: dict | None = None
        self.known = np.zeros(1 << 18, np.int64) - 1  # pairs seen lately, and whether they stand
        self.stands = np.zeros(1 << 18, bool)

    def merge(self, word: str, last: bool = False) -> list:
        """Ids of a word by merging from characters, best score first, leftmost of ties; None for a character outside the vocabulary.

        last: the two parts before the final merge, or the result if there is no merge. n log n in the word.
        """
        text = list(word)
        nxt, prev = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list = []

        def offer(i: int) -> None:
            if i >= 0 and nxt[i] < len(text) and (p := self.ids.get(text[i] + text[nxt[i]])) is not None:
                heapq.heappush(heap, (-self.score[p], i, text[i], text[nxt[i]]))

        for i in range(len(text) - 1):
            offer(i)
        left = len(text)
        while heap and not (last and left == 2):
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if text[i] else 0
            if text[i] != a or j >= len(text) or text[j] != b:
                continue
            text[i], text[j] = a + b, ""
            nxt[i] = nxt[j]
            if nxt[i] < len(text):
                prev[nxt[i]] = i
            left -= 1
            offer(prev[i])
            offer(i)
        return [self.ids.get(t) for t in text if t]

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * (self.unknown + 1) + b
        k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[k] == key, self.pair_rank[k], _NONE)

    def _stand(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b side by side stay as they are: undo their merges, latest first, and see that none across came earlier."""
        out = np.ones(len(a), bool)
        live, limit = np.arange(len(a)), np.full(len(a), _NONE)
        while len(live):
            broken = self._pair(a, b) < limit
            out[live[broken]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~broken & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def stand(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * (self.unknown + 1) + b
        slot = (key.astype(np.uint64) * _B >> np.uint64(46)).astype(np.int64)
        hit = self.known[slot] == key
        out = self.stands[slot]
        if not hit.all():
            miss, of = np.unique(key[~hit], return_inverse=True)
            got = self._stand(miss // (self.unknown + 1), miss % (self.unknown + 1))
            out[~hit] = got[of]
            slot = slot[~hit]
            self.known[slot] = key[~hit]
            self.stands[slot] = self.known[slot] == key[~hit]
            same = self.known[slot] == key[~hit]
            self.stands[slot[same]] = got[of][same]
        return out

    def viterbi(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of equal length, a matrix of code points: (ids, counts), ids in order, unknown characters as self.unknown."""
        n, size = chars.shape
        c = chars.astype(np.uint64)
        piece: list = [None]
        h = np.zeros_like(c)
        for k in range(1, min(size, max(self.keys)) + 1):
            h = h[:, : size - k + 1] * _B + c[:, k - 1 :]
            if k not in self.keys:
                piece.append(None)
                continue
            keys, ids = self.keys[k]
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            piece.append(np.where(keys[at] == h, ids[at], self.unknown if k == 1 else -1))
        last = np.zeros((n, size + 1), np.int64)
        back = np.zeros((n, size + 1), np.int64)
        for end in range(1, size + 1):
            todo = np.arange(n)
            for k in range(min(end, len(piece) - 1), 0, -1):
                if piece[k] is None or not len(todo):
                    continue
                ids = piece[k][todo, end - k]
                some = np.flatnonzero(ids >= 0)
                if not len(some):
                    continue
                rows, ids = todo[some], ids[some]
                ok = self.stand(last[rows, end - k], ids) if end > k else np.ones(len(rows), bool)
                last[rows[ok], end], back[rows[ok], end] = ids[ok], k  # longest open candidate: the maximum
                keep = np.ones(len(todo), bool)
                keep[some[ok]] = False
                todo = todo[keep]
            if len(todo):
                raise ValueError("no piece stands")  # cannot be: a character alone always can
        count, at, path = np.zeros(n, np.int64), np.full(n, size), []
        while (at > 0).any():
            live = at > 0
            path.append(np.where(live, last[np.arange(n), at], -1))
            count += live
            at = np.where(live, at - back[np.arange(n), at], 0)
        flat = np.stack(path[::-1], axis=1).ravel()
        return flat[flat >= 0], count

    def _stands(self, a: int, b: int) -> bool:
        """_stand() of one pair."""
        if self.rank_of is None:  # made where it is first asked for
            self.rank_of = dict(zip(self.pair_keys.tolist(), self.pair_rank.tolist(), strict=True))
            self.lists = self.rank.tolist(), self.left.tolist(), self.right.tolist()
            self.asked: dict = {}
        key = a * (self.unknown + 1) + b
        if (found := self.asked.get(key)) is not None:
            return found
        rank, left, right = self.lists
        limit, none, out = 1 << 40, 1 << 40, True
        while True:
            if self.rank_of.get(a * (self.unknown + 1) + b, none) < limit:
                out = False
                break
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                limit, a = ra, right[a]
            else:
                limit, b = rb + 1, left[b]
        if len(self.asked) < 400_000:
            self.asked[key] = out
        return out

    def viterbi_one(self, word: str) -> list[int]:
        """viterbi() of one word."""
        last, back = [0] * (len(word) + 1), [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            for k in range(min(end, self.longest), 0, -1):
                i = self.valid.get(word[end - k : end], self.unknown if k == 1 else None)
                if i is not None and (k == end or self._stands(last[end - k], i)):
                    last[end], back[end] = i, k  # longest open candidate: the maximum
                    break
        path, at = [], len(word)
        while at:
            path.append(last[at])
            at -= back[at]
        return path[::-1]

    def _spaces(self, n: int) -> list[int]:
        """Pieces of n marks: the longest from the left."""
        out = []
        for size, i in self.marks:
            out += [i] * (n // size)
            n %= size
        return out

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of distinct segments in order, spaces as the piece mark; byte pieces for characters outside the vocabulary."""
        lead = [len(s) - len(s.lstrip(" ")) for s in segments]
        if max(lead, default=0) > 1:  # encode what stands behind all spaces but one; the others follow from its first piece
            cores = [s if n < 2 else s[n - 1 :] if n < len(s) else "" for s, n in zip(segments, lead, strict=True)]
            ids, counts = self.encode_segments(cores)
            mark, out, new, at = self.ids.get("▁"), [], [], 0
            for n, s, k in zip(lead, segments, counts.tolist(), strict=True):
                own = ids[at : at + k]
                at += k
                if n > 1:
                    alone = n == len(s) or (k and own[0] == mark)
                    front = self._spaces(n if alone else n - 1)
                    own = np.concatenate([np.array(front, np.int32), own[1:] if alone and k else own])
                out.append(own)
                new.append(len(own))
            return np.concatenate(out).astype(np.int32), np.array(new, np.int64)
        sizes = np.array([len(s) for s in segments], np.int64)
        text = "".join(segments).replace(" ", "▁")
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(sizes)
        plain = (sizes > 0) & (sizes <= _LONG)
        counts = np.zeros(len(segments), np.int64)
        parts: list = [None] * 0
        order = []
        for size in np.unique(sizes[plain]):
            rows = np.flatnonzero(plain & (sizes == size))
            for i in range(0, len(rows), 20_000):
                some = rows[i : i + 20_000]
                ids, n = self.viterbi(points[(ends[some] - size)[:, None] + np.arange(size)])
                counts[some] = n
                parts.append(ids)
                order.append(some)
        for r in np.flatnonzero(sizes > _LONG):
            ids = self.viterbi_one(text[ends[r] - sizes[r] : ends[r]])
            counts[r] = len(ids)
            parts.append(np.array(ids, np.int64))
            order.append(np.array([r]))
        if not parts:
            return np.zeros(0, np.int32), counts
        ids, rows = np.concatenate(parts), np.concatenate(order)
        start = np.empty(len(segments), np.int64)
        start[rows] = np.cumsum(counts[rows]) - counts[rows]
        ids = ids[_spread(start, counts)]
        if (ids == self.unknown).any():
            ids, counts = self._bytes(segments, ids, counts)
        return ids.astype(np.int32), counts

    def _bytes(self, segments: list[str], ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, new, at = [], counts.copy(), 0
        bad = np.append(0, np.cumsum(ids == self.unknown))
        hit = np.diff(bad[np.append(0, np.cumsum(counts))])
        for r, (s, n) in enumerate(zip(segments, counts, strict=True)):
            own = ids[at : at + n]
            if hit[r]:
                spelled, i = [], 0
                for t in own.tolist():
                    if t == self.unknown:
                        spelled += self.bytes[list(s[i].encode("utf-8", "surrogatepass"))].tolist()
                        i += 1
                    else:
                        spelled.append(t)
                        i += len(self._text(t))
                own = np.array(spelled, np.int64)
                new[r] = len(own)
            out.append(own)
            at += n
        return np.concatenate(out), new

    def _text(self, i: int) -> str:
        return bytes(self.blob[self.at[i] : self.at[i] + self.size[i]]).decode()

    def decode_flat(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of many ids, one after the other, and the number of bytes of each."""
        n = self.size[ids]
        return self.blob[_spread(self.at[ids], n)], n

    def decode(self, ids: list[int]) -> str:
        """Text of one document; the mark that encoding puts in front goes."""
        text = bytes(self.decode_flat(np.asarray(ids, np.int64))[0]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        found = _SEGMENT.findall(" " + text.replace("▁", " "))
        distinct = list(dict.fromkeys(found))
        ids, counts = self.encode_segments(distinct)
        parts = dict(zip(distinct, np.split(ids, np.cumsum(counts)[:-1]), strict=True))
        return [int(x) for s in found for x in parts[s]]


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i]+1, ... size[i] of them, for each i."""
    total = int(size.sum())
    out = np.ones(total, np.int64)
    some = size > 0
    s, n = start[some], size[some]
    if not len(s):
        return out
    at = np.cumsum(n) - n
    out[at] = s
    out[at[1:]] -= s[:-1] + n[:-1] - 1
    return np.cumsum(out)


def _cut(data: np.ndarray, offsets: np.ndarray, splitter: Splitter) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, texts and hashes of the segments of texts that begin with a space each."""
    starts, ends, of, hashes = [], [], [], []
    for i, j in runs(offsets):
        base = offsets[i]
        part, off = data[base : offsets[j]], offsets[i : j + 1] - base
        space, line = part == 0x20, part == 0x0A
        begin = np.zeros(len(part), bool)
        before_space, before_line = np.zeros(len(part), bool), np.zeros(len(part), bool)
        before_space[1:], before_line[1:] = space[:-1], line[:-1]
        begin |= (space & ~before_space) | line | before_line
        begin[off[:-1][np.diff(off) > 0]] = True
        s = np.flatnonzero(begin)
        e = np.append(s[1:], len(part)) if len(s) else s
        hashes.append(splitter.hash_ranges(part, s, e))
        starts.append(s + base)
        ends.append(e + base)
        of.append(i + np.searchsorted(off[1:], s, side="right"))
    none = np.zeros(0, np.int64)
    join = lambda x, kind=np.int64: np.concatenate([none.astype(kind), *x])
    return join(starts), join(ends), join(of), join(hashes, np.uint64)


def _with_prefix(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text that has bytes gets a space in front."""
    size = np.diff(offsets)
    new = np.append(0, np.cumsum(size + (size > 0)))
    out = np.full(new[-1], 0x20, np.uint8)
    keep = np.ones(new[-1], bool)
    keep[new[:-1][size > 0]] = False
    out[keep] = data
    return out, new


def encode_batch(codec: Codec, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: first and last text, ids, number of ids of each text, prefixed bytes, their offsets."""
    splitter = Splitter()
    data, offsets = buffers(column)
    for i, j in runs(offsets, 2 << 20):
        part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        raw, at = _with_prefix(part, off)
        if b"\xe2\x96\x81" in raw.tobytes():  # the mark itself stands for a space
            texts = [bytes(raw[a:b]).decode().replace("▁", " ").encode() for a, b in zip(at, at[1:], strict=False)]
            cut_raw, cut_at = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
        else:
            cut_raw, cut_at = raw, at
        s, e, of, h = _cut(cut_raw, cut_at, splitter)
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        blob = cut_raw.tobytes()
        ids, counts = codec.encode_segments([blob[a:b].decode() for a, b in zip(s[first].tolist(), e[first].tolist(), strict=True)])
        start = np.cumsum(counts) - counts
        n = counts[which]
        flat = ids[_spread(start[which], n)]
        yield i, j, flat, np.bincount(of, n, j - i).astype(np.int64), raw, at


def encode_documents(docs: DataFrame, codec: Codec, with_ids: bool = True, with_text: bool = False) -> DataFrame:
    """docs without text, with n_pieces, ids_hash (xxhash64 of the ids as little-endian 32-bit integers, hex) and round_trip.

    round_trip: decoding the ids gives the text again (a text that holds the mark U+2581 does not come back). Null and empty
    texts have no ids and come back as empty. Other columns stay, unless they have the name of one that is added here: those
    give way. Rows that repeat are encoded each. with_ids adds ids (array), with_text decoded, the decoded text.
    """
    extra = ["n_pieces long", "ids_hash string", "round_trip boolean"] + ["ids array<int>"] * with_ids + ["decoded string"] * with_text
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in {x.split()[0] for x in extra}])
    at = docs.columns.index("text")
    keep = [k for k, c in enumerate(docs.columns) if c != "text"]
    kept_names = [docs.columns[k] for k in keep]
    shared = docs.sparkSession.sparkContext.broadcast(codec)  # of the size of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for batch in batches:
            for i, j, ids, sizes, raw, offsets in encode_batch(codec, batch.column(at)):
                cuts = np.append(0, np.cumsum(sizes))
                back, n = codec.decode_flat(ids)
                stop = np.append(0, np.cumsum(n))[cuts]
                blob, whole = ids.astype("<i4"), raw.tobytes()
                decoded = back.tobytes()
                same = [decoded[stop[k] : stop[k + 1]] == whole[offsets[k] : offsets[k + 1]] for k in range(j - i)]
                cols = [batch.column(k).slice(i, j - i) for k in keep]
                cols += [
                    pa.array(sizes),
                    pa.array([xxhash.xxh64_hexdigest(blob[cuts[k] : cuts[k + 1]].tobytes()) for k in range(j - i)], pa.string()),
                    pa.array(same, pa.bool_()),
                ]
                names = [*kept_names, "n_pieces", "ids_hash", "round_trip"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(blob)))
                    names.append("ids")
                if with_text:
                    cols.append(pa.array([decoded[stop[k] + (sizes[k] > 0) : stop[k + 1]].decode("utf-8", "replace") for k in range(j - i)], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    return docs.mapInArrow(run, ", ".join(fields + extra))


def decode_documents(encoded: DataFrame, codec: Codec) -> DataFrame:
    """encoded (column ids) with the column text decoded from them, in place of one of that name; null ids give null."""
    encoded = encoded.drop("text")
    at = encoded.columns.index("ids")
    shared = encoded.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else shared.value.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema]
    return encoded.mapInArrow(run, ", ".join([*fields, "text string"]))
