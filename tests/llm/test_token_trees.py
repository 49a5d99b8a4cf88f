import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import token_trees as tt
from tidemark.llm.queries import BYTE_RANKS

RANKS = tt.load_ranks(BYTE_RANKS)
CODE = tiktoken.Encoding("own", pat_str=tt.PATTERN, mergeable_ranks=RANKS, special_tokens={})
COUNTER = tt.Counter(RANKS)
ALPHABET = "ab 'st\n\t  1é.,漢"
WORDS = st.text(alphabet=ALPHABET, max_size=30)


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=200), st.lists(st.tuples(st.integers(0, 220), st.integers(0, 40), WORDS), max_size=6))
def test_counts_equal_a_whole_encoding(text, edits):
    block, tt.BLOCK = tt.BLOCK, 4
    try:
        tree = tt.TokenTree(text, COUNTER)
        for pos, delete, insert in edits:
            tree.edit(pos, delete, insert)
            p = min(pos, len(text))
            text = text[:p] + insert + text[p + min(delete, len(text) - p) :]
            assert tree.text == text
            assert tree.total == len(CODE.encode_ordinary(text))
            sizes, counts = tree.leaves()
            assert sizes == [len(x) for x in COUNTER.split.findall(text)] and tree.pretokens == len(sizes) and sum(counts) == tree.total
    finally:
        tt.BLOCK = block


def test_edit_touches_few_pretokens():
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = tt.TokenTree(text, COUNTER)
    for k in range(50):
        tree.edit(k * 2000, 5, "some new text")
    assert tree.encoded < 50 * 12
    assert tree.total == len(CODE.encode_ordinary(tree.text))


def test_documents(spark):
    rows = [(1, "Some text here, isn't it?", [(5, 4, "words"), (0, 0, "  ")], 1), (2, None, None, 1), (3, "", [(0, 3, "new")], 1), (4, "z " * 5000, [(5000, 1, "")], 1), (1, "again", [], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<pos int, del int, ins string>>, n_tokens int")
    got = sorted(tt.count_edited(df, RANKS).collect(), key=lambda r: (r.doc_id, r.n_tokens))
    assert [r.n_tokens for r in got] == [1, len(CODE.encode_ordinary(rows[0][1])), 0, 0, len(CODE.encode_ordinary(rows[3][1]))]
    assert got[1].n_tokens_after == len(CODE.encode_ordinary("  Some words here, isn't it?")) and got[3].n_tokens_after == 1
    trees = tt.build_trees(df, RANKS).where("doc_id = 4").select("doc_id", "tree_sizes", "tree_counts")
    again = tt.count_edited(df.where("doc_id = 4").join(trees, "doc_id"), RANKS).first()
    assert again == next(r for r in got if r.doc_id == 4)
    assert tt.count_edited(df.where("false"), RANKS).count() == 0


@pytest.mark.parametrize("n", [1, 4])
def test_derived_edits_follow_from_the_row(spark, n):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "abc def"), (2, None), (3, "")], "doc_id long, text string").withColumn("e", tt.derived_edits(F.col("text"), F.col("doc_id"), n))
    assert all(len(r.e) == n and all(x.pos is not None and x.ins is not None for x in r.e) for r in df.collect())
