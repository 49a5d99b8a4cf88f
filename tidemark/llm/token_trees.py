"""Edit-aware token counts (operator 10).

A document's pre-tokens are the leaves of a segment tree over blocks; nodes hold the sums of characters and of tokens. An
edit finds its place by descending the sums of characters, splits and encodes again only from the pre-token before it until
the split meets an old boundary beyond it, and updates the sums on the path to the root. The split pattern never looks back,
and looks one character past a match at most, so the counts are those of a whole encoding.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import pack, unpack

#: Split pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 128
_CACHE = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Counter(dict):
    """Tokens of a pre-token; remembers a bounded number of them."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        import tiktoken

        self.code = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        n = len(self.code._encode_single_piece(piece))
        if len(self) < _CACHE:
            self[piece] = n
        return n


class TokenTree:
    """text with blocks of (length, tokens) of its pre-tokens under a segment tree of sums."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.encoded = text, counter, 0
        pieces = counter.split.findall(text)
        self.pretokens = len(pieces)
        sizes, counts = list(map(len, pieces)), list(map(counter.__getitem__, pieces))
        self._build([(sizes[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(sizes), BLOCK)] or [([], [])])

    @classmethod
    def load(cls, text: str, sizes: list[int], counts: list[int], counter: Counter) -> TokenTree:
        """A tree from stored leaves; nothing is encoded."""
        tree = cls("", counter)
        tree.text, tree.pretokens = text, len(sizes)
        tree._build([(list(sizes[i : i + BLOCK]), list(counts[i : i + BLOCK])) for i in range(0, len(sizes), BLOCK)] or [([], [])])
        return tree

    def leaves(self) -> tuple[list[int], list[int]]:
        return [x for s, _ in self.blocks for x in s], [x for _, c in self.blocks for x in c]

    def _build(self, blocks: list[tuple[list[int], list[int]]]) -> None:
        self.blocks = blocks
        self.width = 1 << (len(blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, (s, c) in enumerate(blocks):
            self.chars[self.width + k], self.tokens[self.width + k] = sum(s), sum(c)
        for k in range(self.width - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _block_at(self, pos: int) -> tuple[int, int]:
        """Block that holds the character at pos (the last one beyond the end), and where it begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if pos >= begin + self.chars[node]:
                begin += self.chars[node]
                node += 1
        k = min(node - self.width, len(self.blocks) - 1)
        return (k, begin) if k == node - self.width else (k, begin - self.chars[self.width + k])

    def edit(self, pos: int, delete: int, insert: str) -> None:
        """Replace delete characters at pos by insert; positions past the end count as the end."""
        pos = max(0, min(pos, len(self.text)))
        delete = max(0, min(delete, len(self.text) - pos))
        stop = pos + delete
        first, begin = self._block_at(max(pos - 2, 0))
        sizes, counts = self.blocks[first]
        keep = 0
        while keep < len(sizes) and begin + sizes[keep] + 1 < pos:  # pre-tokens that end before the context of the edit
            begin += sizes[keep]
            keep += 1
        head = (sizes[:keep], counts[:keep])
        self.text = self.text[:pos] + insert + self.text[stop:]
        shift = len(insert) - delete
        # old boundaries from the restart on, block by block
        last, old, at = first, keep, begin
        new_sizes, new_counts, place = [], [], begin
        while True:
            # drop old pre-tokens that begin before the place reached, or inside the edit
            while last < len(self.blocks) and (at < stop or at + shift < place):
                if old < len(self.blocks[last][0]):
                    at += self.blocks[last][0][old]
                    old += 1
                else:
                    last, old = last + 1, 0
            if place >= pos + len(insert) and at + shift == place:
                break
            if place >= len(self.text):
                break
            piece = self.counter.split.match(self.text, place)[0]
            new_sizes.append(len(piece))
            new_counts.append(self.counter[piece])
            place += len(piece)
        self.encoded += len(new_sizes)
        tail = (self.blocks[last][0][old:], self.blocks[last][1][old:]) if last < len(self.blocks) else ([], [])
        end = min(last, len(self.blocks) - 1)
        merged = (head[0] + new_sizes + tail[0], head[1] + new_counts + tail[1])
        self.pretokens += len(merged[0]) - sum(len(s) for s, _ in self.blocks[first : end + 1])
        if end == first and len(merged[0]) <= 2 * BLOCK:
            self.blocks[first] = merged
            node = self.width + first
            self.chars[node], self.tokens[node] = sum(merged[0]), sum(merged[1])
            while node > 1:
                node //= 2
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        else:  # blocks went or one is too full: the tree over the blocks is made again, no pre-token is encoded
            cut = [(merged[0][i : i + BLOCK], merged[1][i : i + BLOCK]) for i in range(0, len(merged[0]), BLOCK)]
            self._build(self.blocks[:first] + cut + self.blocks[end + 1 :] or [([], [])])


def build_trees(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, text, n_tokens, tree_sizes and tree_counts (the leaves, packed) of every row, for storage. Null texts count as empty. Other columns are not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # of the size of the vocabulary
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            totals, sizes, counts = [], [], []
            for text in batch.column(1):
                tree = TokenTree(text.as_py() or "", counter)
                totals.append(tree.total)
                for out, leaves in zip((sizes, counts), tree.leaves(), strict=True):
                    out.append(pack(np.array(leaves, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(totals, pa.int64()), pa.array(sizes, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "text", "n_tokens", "tree_sizes", "tree_counts"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, n_tokens long, tree_sizes binary, tree_counts binary")


def count_edited(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, n_tokens, n_pretokens, n_edits, n_reencoded (pre-tokens that the edits encoded again), n_tokens_after, n_pretokens_after.

    docs: doc_id, text and edits, array<struct<pos int, del int, ins string>>, made one after the other (null: none); with
    columns tree_sizes and tree_counts, as build_trees stores them, the trees are loaded and nothing is encoded but what the
    edits touch; leaves that do not add up to the text are of another text, and its tree is built. Null texts count as
    empty, rows that repeat are counted each, a null id is allowed; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    stored = {"tree_sizes", "tree_counts"} <= set(docs.columns)
    names = ["n_tokens", "n_pretokens", "n_edits", "n_reencoded", "n_tokens_after", "n_pretokens_after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            rows = []
            for k in range(len(batch)):
                text, edits, *leaves = (batch.column(c)[k].as_py() for c in range(1, batch.num_columns))
                sizes = unpack(leaves[0]).tolist() if stored and leaves[0] is not None else None
                if sizes is not None and sum(sizes) == len(text or ""):
                    tree = TokenTree.load(text or "", sizes, unpack(leaves[1]).tolist(), counter)
                else:
                    tree = TokenTree(text or "", counter)
                before = tree.total, tree.pretokens
                for e in edits or []:
                    tree.edit(int(e["pos"] or 0), int(e["del"] or 0), e["ins"] or "")
                rows.append([*before, len(edits or []), tree.encoded, tree.total, tree.pretokens])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[c] for r in rows], pa.int64()) for c in range(len(names))]], ["doc_id", *names])

    wanted = ["doc_id", "text", "edits", *(["tree_sizes", "tree_counts"] if stored else [])]
    return docs.select(*wanted).mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names))


def derived_edits(text: Column, doc_id: Column, n: int = 4) -> Column:
    """n edits of a text that follow from its id: at a hashed place some characters go and a passage from elsewhere in the text comes."""
    size = F.length(F.coalesce(text, F.lit("")))
    draw = lambda k, m: F.pmod(F.xxhash64(doc_id, F.lit(k)), m).cast("int")
    return F.array(
        *[
            F.struct(
                draw(3 * k, size + 1).alias("pos"),
                draw(3 * k + 1, F.lit(24)).alias("del"),
                F.coalesce(F.substring(text, draw(3 * k + 2, size + 1) + 1, draw(3 * k, F.lit(40)) + 1), F.lit("")).alias("ins"),
            )
            for k in range(n)
        ]
    )
