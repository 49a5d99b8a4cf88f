"""One query opN_<name> for each corpus operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from tidemark.llm import decontaminate, hard_negatives, html_main, katz, lexical, minhash, packing, pii, quality_fm, quality_rules, sp_codec, substrings, token_trees
from tidemark.llm.common import read, stage, text_batches

#: Vocabulary files of public tokenizers; installed beside Python, never part of this repository.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op9_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    kept = quality_rules.apply_quality_rules(docs, carry=("doc_id",))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return kept.select("doc_id", *[f"q.{c}" for c in counts], "kept")


def op1_minhash_near_dedup(spark, sf_dir):
    return minhash.near_classes(read(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality_fm.score_quality(docs, quality_fm.train_quality(docs, read(spark, sf_dir, "labels")))


def op5_substring_dedup(spark, sf_dir):
    return substrings.repeated_spans(read(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir, ranks_file=BYTE_RANKS):
    docs, ranks = read(spark, sf_dir, "documents").select("doc_id", "text"), token_trees.load_ranks(ranks_file)
    trees = stage(token_trees.build_trees(docs, ranks), "trees", codec="zstd")  # stored with the texts that they count
    return token_trees.count_edited(trees.withColumn("edits", token_trees.derived_edits(F.col("text"), F.col("doc_id"))), ranks)


def op6_pii(spark, sf_dir):
    return pii.detect_pii(read(spark, sf_dir, "documents")).drop("spans_flat")


def op7_katz_lm(spark, sf_dir):
    return katz.score_texts(read(spark, sf_dir, "documents"))


def op8_html_main_text(spark, sf_dir):
    return html_main.extract_main_text(read(spark, sf_dir, "pages"))


def op4_sentencepiece(spark, sf_dir, model_file=PIECE_MODEL):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sp_codec.encode_documents(docs, sp_codec.Codec(sp_codec.load_pieces(model_file)))


def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def op12_ranked_search(spark, sf_dir):
    return lexical.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_sequence_packing(spark, sf_dir, tokenizer=None):
    import public_tokenizers

    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))


def _over_texts(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        text_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _over_texts(f) for f in (op1_minhash_near_dedup, op2_quality_classifier, op3_decontamination, op4_sentencepiece, op5_substring_dedup, op6_pii, op7_katz_lm, op8_html_main_text, op9_quality_rules, op10_token_counts, op11_hard_negatives, op12_ranked_search, op13_sequence_packing)}

ORACLE_SQL = {
    "op9_quality_rules": quality_rules.ORACLE.format(docs="documents"),
    "op11_hard_negatives": hard_negatives.ORACLE.format(table="embeddings"),
    "op12_ranked_search": lexical.ORACLE.format(docs="documents", items="benchmark"),
}
