"""Packing: ids equal the library's, every id lies in one piece, windows are full or a power of two."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import Packer, PackPolicy, WordEncoder, encoded, pack_documents
from tidemark.llm.tokens import unpack

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, start string, sequence_id int, length int"
ODD = [
    "Don't it's 'S x''s ''t 've I'll",
    "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|> <|",
    "ÀÉÿß×÷ Ñandú İstanbul ſ naïve",
    "a b c\x85d\x1ce",
    "漢字かな 12٣٤ ½² x9y",
    "é ́x ﬁ Å",
    "\x00\x7f\x1b (a)-[b]_c",
    "🙂🙂 a🙂b ΑΣ ΟΔΟΣ",
    "a" * 3000,
    "",
    "  \n\t",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("run", [1 << 20, 9, 1])
def test_ids_are_the_library_s(library, run):
    r = random.Random(7)
    texts = ODD + ["".join(r.choice("aBé'. \n1ñÑ<|×字") for _ in range(60)) for _ in range(200)]
    encoder, found = WordEncoder(PATH), defaultdict(list)
    for row, ids, _ in encoded(pa.array(texts), encoder, run):
        found[row] += ids.tolist()
    for row, text in enumerate(texts):
        assert found[row] == library.encode(text, add_special_tokens=False).ids, text


def test_forgetting_words_changes_nothing(library):
    encoder, found = WordEncoder(PATH), defaultdict(list)
    encoder.limit = 3
    for row, ids, _ in encoded(pa.array(ODD), encoder, 20):
        found[row] += ids.tolist()
    for row, text in enumerate(ODD):
        assert found[row] == library.encode(text, add_special_tokens=False).ids


def check(rows, docs, library, policy):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for x in rows:
        by_doc[x.doc_id].append(x)
        by_sequence[x.sequence_id].append(x)
        assert x.length > 0 and zlib.crc32(unpack(x.ids).astype("<u4").tobytes()) == x.ids_crc32
    for pieces in by_sequence.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= policy.window
    for doc, text in docs:
        ids = []
        for x in sorted(by_doc[doc], key=lambda x: x.start):
            assert x.start == len(ids)
            ids += unpack(x.ids).tolist()
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, policy.end_id] and all(x.doc_tokens == len(ids) for x in by_doc[doc])
    sizes = [sum(x.length for x in pieces) for pieces in by_sequence.values()]
    return sum(0 if n & (n - 1) == 0 else policy.window - n for n in sizes), sum(sizes)


@pytest.mark.parametrize("policy", [PackPolicy(), PackPolicy(window=64, open_windows=3, slack=4, fan_in=2)])
def test_every_id_lies_in_one_piece(spark, library, policy):
    r = random.Random(3)
    docs = [(i, " ".join(r.choice(["alpha", "Beta", "ga-mma", "δ", "x1"]) for _ in range(r.choice([1, 3, 20, 50, 300])))) for i in range(150)]
    docs += [(1000, None), (1001, ""), (1002, "word " * 9000), *((1010 + i, t) for i, t in enumerate(ODD))]
    rows = pack_documents(spark.createDataFrame([(*d, "s", 1, 2) for d in docs], SCHEMA).repartition(9), PATH, policy, with_ids=True).collect()
    padding, total = check(rows, docs, library, policy)
    assert padding <= 0.05 * total


def test_repeated_rows_nulls_and_an_empty_table(spark):
    def packed(rows):
        return pack_documents(spark.createDataFrame(rows, SCHEMA), PATH).collect()

    assert packed([]) == []
    rows = packed([(1, "a b", "", 0, 0), (1, "a b", "", 0, 0), (None, "c", "", 0, 0)])
    assert sorted((x.doc_id or 0, x.length) for x in rows if x.start == 0)[0][0] == 0
    assert sum(x.length for x in rows) == 8


def test_best_fit_and_fullest_first():
    out = []
    packer = Packer(PackPolicy(window=10, open_windows=2, slack=1), out.append)
    ids = np.arange(100, dtype=np.uint32)
    for name, size in (("a", 7), ("b", 5), ("c", 3), ("d", 4), ("e", 8)):
        packer.add(name, 0, ids[:size])
    # c fills a's window, d joins b (gap 1), e opens the second window
    assert [[p[0] for p in s] for s in out] == [["a", "c"]]
    packer.add("f", 0, ids[:6])  # none holds it; b's window is the fullest, its gap is small enough to stay empty
    assert [p[0] for p in out[1]] == ["b", "d"]
    packer.finish()
    assert [sum(len(p[2]) for p in s) for s in out[2:]] == [10, 4]
