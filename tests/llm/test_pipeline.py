import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.common import ROW_GROUP, text_batches
from tidemark.llm.queries import PIECE_MODEL

ITEM = "A train leaves the town at noon and travels with constant speed until it meets the other train beyond the old river bridge"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(n))
    rows = {i: prose(60) for i in range(150)}
    rows |= {200: "short text", 201: None, 202: "", 203: " ".join(["same words again and"] * 50)}  # rejected by the rules
    rows |= {210: rows[3], 211: rows[4].replace(" ", "  "), 212: rows[5] + " end"}  # copies
    rows |= {220: prose(30) + " " + ITEM + " " + prose(10)}  # leak
    rows |= {230: prose(30) + " write to joe@mail.example.com soon " + prose(5)}  # personal data
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows.items()], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def test_run_matches_a_plain_version(spark, folder):
    import sentencepiece

    path, rows = folder
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(out) == {i for i in range(150)} | {230}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for i, r in out.items():
        text = re.sub(r"\S+@\S+", "[EMAIL]", rows[i])
        assert r.text == text and r.n_chars == len(text) and r.ids == model.encode(text) and r.round_trip
    assert out[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "n_pieces", "round_trip", "ids"}


def test_stages_chain_and_keep_the_columns(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [len(n) > 0 and callable(f) for n, f in corpus_pipeline.STAGES] == [True] * 5
    empty = docs.where("false")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, path).count() == 0
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, empty, path).columns == docs.columns


def test_stages_take_odd_rows_and_clashing_columns(spark, folder):
    path, rows = folder
    text = rows[7]
    odd = [(None, text, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", None), (3, text, "en", "s", 5), (3, text, "en", "s", 5), (4, "x" * 300_000, "en", "s", 300_000), (5, "word " * 60_000, "en", "s", 1), (6, text + " a@b.example.com", "en", "s", 1)]
    extra = "q string, kept string, label string, n string, hash string, spans string, win string, row string, leader string, h string"
    df = spark.createDataFrame([(*r, *["c"] * 10) for r in odd], f"{DOCS}, {extra}")
    clash = ("q", "kept", "label", "n", "hash", "spans", "win", "row", "leader", "h")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, df, path)
        got = out.collect()
        assert set(df.columns) <= set(out.columns) and all(r[c] == "c" for r in got for c in clash), name
        if name in ("personal data", "SentencePiece"):
            assert len(got) == len(odd)
    got = {r.doc_id for r in corpus_pipeline.decontamination(spark, df, path).collect()}
    assert got == {None, 1, 2, 3, 4, 5, 6}
    kept = corpus_pipeline.near_dedup(spark, df, path).collect()
    assert {1, 2, 3, 4, 5} <= {r.doc_id for r in kept} and None in {r.doc_id for r in kept} and 6 not in {r.doc_id for r in kept}


def test_row_groups_of_texts_are_small(spark, tmp_path):
    """What a task buffers of a stage's texts does not grow with its rows: 36 MB are several row groups."""
    import pyarrow.parquet as pq

    text_batches(spark)
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(140)), lambda k: F.sha2(F.concat_ws(" ", "id", k), 256)))
    spark.range(4000).coalesce(1).select("id", text.alias("text")).write.parquet(f"{tmp_path}/texts")
    (file,) = (tmp_path / "texts").glob("*.parquet")
    held = pq.ParquetFile(file).metadata
    sizes = [held.row_group(i).total_byte_size for i in range(held.num_row_groups)]
    assert sum(sizes) > 30 << 20 and max(sizes) < 1.5 * ROW_GROUP
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 500
