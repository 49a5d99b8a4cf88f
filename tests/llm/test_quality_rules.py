import re
from collections import Counter

import duckdb
import pytest

from tidemark.llm import quality_rules as rules

SCHEMA = "doc_id long, text string, lang string, source string, q string, kept string, n_words int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    n, r = len(words), len(hit)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


TEXTS = [
    "a b c d e f g h i j k l m n o p",
    "one two three four five six one two three four five six seven",
    "x " * 400,
    "l1 is here\nl1 is here\n\n  \nother line é ü\nl1 is here\tand on and on it goes\x0bthen",
    "",
    None,
    " \n\t ",
    "a b c d e a b c d e f a b c d e",
    "word with nbsp counts as one here two three four five six seven eight",
    "sym### bol*** $$ % & | < > yes no a b c d e",
    "w" * 100_000 + " " + " ".join(f"w{i}" for i in range(3000)),
    "SHOUT!! AT!! ALL!! OF!! THEM!! AND!! MORE!! OF!! THIS!! NOISE!! NOW!!",
    "go go go go stop stop stop stop run run run run walk walk walk walk end end",
]


@pytest.fixture(scope="module")
def rows():
    plain = [(100 + i, " ".join(f"word{i}x{k}" for k in range(30)) + ".", "en", "src") for i in range(250)]
    return [(i, t, [None, "en", "de"][i % 3], [None, "src"][i % 2]) for i, t in enumerate(TEXTS)] + plain


def test_counts_match_brute_force_and_sql(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash", 7) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in rules.apply_quality_rules(df.select("doc_id", "text", "lang", "source")).collect()}
    for i, t, *_ in rows:
        q = got[i].q
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == brute(t), i
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?, ?)", rows)
    sql = {r[0]: r[-1] for r in con.execute(rules.ORACLE.format(docs="d")).fetchall()}
    assert sql == {i: r.kept for i, r in got.items()}
    assert all(got[100 + i].kept for i in range(250))
    assert not got[11].kept and not got[12].kept and not got[9].kept and not got[4].kept and not got[5].kept


def test_filter_keeps_columns_and_ties(spark):
    text = "clean words that stand alone in one line of plain prose here"
    df = spark.createDataFrame([(1, text, "en", None, "clash", "clash", 7)] * 3 + [(2, "short", "en", "a", "c", "c", 1)], SCHEMA)
    out = rules.keep_good(df.drop("q", "kept"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_words"] and out.count() == 3
    assert rules.keep_good(spark.createDataFrame([], SCHEMA).drop("q", "kept")).count() == 0


def test_sketch_buckets_are_ordered_and_close(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.common import sketch_bucket, sketch_value

    rows = spark.range(0, 200_000, 7).select("id", sketch_bucket(F.col("id")).alias("b")).select("id", "b", sketch_value(F.col("b")).alias("v")).collect()
    assert all(r.v <= r.id and (r.id - r.v) * 16 <= r.id for r in rows)
    assert [r.b for r in rows] == sorted(r.b for r in rows)
