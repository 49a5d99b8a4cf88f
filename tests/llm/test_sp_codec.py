import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import sp_codec
from tidemark.llm.queries import PIECE_MODEL

SCHEMA = "doc_id long, text string, ids string, n_pieces string"


@pytest.fixture(scope="module")
def codec():
    return sp_codec.Codec(sp_codec.load_pieces(PIECE_MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


TEXTS = [
    "The quick brown fox, 1234 times.",
    "  two  leading   spaces    and\n\nlines\t\ttabs ",
    "日本語 текст 😀 naïve éèê ß",
    "aaaaaaaaaaaaaaaaaaaaaa bbbbbbbbbbb abababababab",
    "x" * 3000,
    "representation representations representationrepresentation",
    "\n", " ", "   ", "a", "",
    "mid▁mark",
    *[" " * k + "word" + " " * (k + 3) + "é \n" + " " * k for k in range(1, 40)],
    "lookupsubstringhashes" * 9, "日本語" * 60, "ab1" * 50 + "  " + "q" * 70 + "😀" * 30,
]


def test_same_pieces_as_the_library(codec, library):
    for t in TEXTS:
        assert codec.encode(t) == library.encode(t), t


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdeirstn  \n.,0é"), st.characters(blacklist_categories=["Cs"], blacklist_characters="\x00")), max_size=40))
def test_random_texts(text):
    codec, library = _both()
    assert codec.encode(text) == library.encode(text)
    if "▁" not in text:
        assert codec.decode(codec.encode(text)) == text


_kept = []


def _both():
    if not _kept:
        _kept.extend([sp_codec.Codec(sp_codec.load_pieces(PIECE_MODEL)), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)])
    return _kept


def test_documents_round_trip(spark, codec, library):
    rows = [(i, t, "clash", "clash") for i, t in enumerate([*TEXTS, None])]
    df = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "n_pieces").withColumnRenamed("n_pieces", "extra")
    out = sp_codec.encode_documents(df, codec, with_text=True)
    got = {r.doc_id: r for r in out.collect()}
    for i, t, *_ in rows:
        assert got[i].ids == library.encode(t or "") and got[i].n_pieces == len(got[i].ids) and got[i].extra == "clash"
        assert got[i].round_trip == ("▁" not in (t or "")) and (not got[i].round_trip or got[i].decoded == (t or ""))
    back = {r.doc_id: r.text for r in sp_codec.decode_documents(out.select("doc_id", "ids"), codec).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t, *_ in rows)
    assert sp_codec.encode_documents(spark.createDataFrame([], "doc_id long, text string"), codec).count() == 0


def test_long_words_take_bounded_time(codec, library):
    import random
    import time

    rng = random.Random(2)
    for text in ("".join(rng.choice("abcdefghij") for _ in range(200_000)), "ab" * 100_000, " " * 300_000, "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(60_000))):
        began = time.perf_counter()
        got = codec.encode(text)
        assert time.perf_counter() - began < 20
        assert got == library.encode(text)
