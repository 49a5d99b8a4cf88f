"""Quality rules with adaptive thresholds (operator 9, native).

Each document gets counts (words, symbols, repeated lines, repeated 5-word windows, words equal to the next, capitals). The counts become
integer signals; every (language, source) group keeps a mergeable log-linear quantile sketch of each signal, made by
one partially aggregated count for each bucket. A group's upper fence is its third quartile plus three times its
quartile range, with a least distance; groups with few documents borrow the sketch of their language, then of the
whole corpus. Documents join their group's fences and are kept if no signal passes them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, sketch_bucket, sketch_value, small, stage, text_of, words_of

#: Signals (integers, thousandths, or hundredths of a code point for word_length) and the least distance of a fence above the third quartile.
SIGNALS = {"symbols": 200, "repeats": 200, "stutter": 200, "dup_lines": 500, "capitals": 300, "word_length": 600}


@dataclass(frozen=True)
class RulePolicy:
    """min_docs: group size from which its own sketch is used. spread: quartile ranges between third quartile and fence."""

    min_docs: int = 100
    spread: int = 3
    min_words: int = 10
    max_repeat_percent: int = 20


def _repeated_words(hashes: Column, n: Column) -> Column:
    """Words inside 5-word windows that occur twice or more. Only documents with such a window sort anything."""
    windows = F.transform(
        F.slice(hashes, F.lit(1), F.greatest(n - 4, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2), F.get(hashes, i + 3), F.get(hashes, i + 4)),
    )

    def covered(win: Column) -> Column:
        placed = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def twice(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            marked = F.transform(s, lambda x, i: F.struct(x["p"].alias("p"), (same(x, i - 1) | same(x, i + 1)).alias("d")))
            at = F.sort_array(F.transform(F.filter(marked, lambda x: x["d"]), lambda x: x["p"].cast("long")))
            start = F.struct(F.lit(-5).cast("long").alias("last"), F.lit(0).cast("long").alias("total"))
            return F.aggregate(
                at,
                start,
                lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(5).cast("long"), p - a["last"])).alias("total")),
                lambda a: a["total"],
            )

        return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0).cast("long")).otherwise(let(placed, twice))

    return F.when(n < 6, F.lit(0).cast("long")).otherwise(let(windows, covered))


def quality_features(docs: DataFrame, policy: RulePolicy = RulePolicy()) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the signals, in column q (struct).

    Null texts count as empty: no words, base_failed. Columns of docs stay as they are, but for one named q, which gives way;
    only text, lang and source are read, and any of them may be null. Rows that repeat are judged each.
    """
    text = text_of()
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    step = docs.withColumn("_tm_w", words_of(text)).withColumn("_tm_l", lines)
    step = step.withColumn("_tm_n", F.size("_tm_w")).withColumn("_tm_h", F.transform("_tm_w", lambda w: F.xxhash64(w)))
    n = F.col("_tm_n").cast("long")
    word_chars = F.length(F.array_join("_tm_w", "")).cast("long")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "\\p{Lu}+", ""))
    step = step.withColumn(
        "_tm_c",
        F.struct(
            n.alias("n_words"),
            word_chars.alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            (F.size("_tm_l") - F.size(F.array_distinct("_tm_l"))).cast("long").alias("n_dup_lines"),
            F.size("_tm_l").cast("long").alias("n_lines"),
            _repeated_words(F.col("_tm_h"), F.col("_tm_n")).alias("n_repeat_words"),
            capitals.cast("long").alias("n_capitals"),
            F.size(F.filter("_tm_h", lambda h, i: h == F.get(F.col("_tm_h"), i + 1))).cast("long").alias("n_stutter"),
        ),
    ).drop("_tm_w", "_tm_l", "_tm_n", "_tm_h")
    c = lambda name: F.col(f"_tm_c.{name}")
    ratio = lambda a, b, k=1000: F.coalesce(F.try_divide(a * k, b), F.lit(0)).cast("long")
    failed = (c("n_words") < policy.min_words) | (100 * c("n_repeat_words") > policy.max_repeat_percent * c("n_words"))
    return step.withColumn(
        "q",
        F.struct(
            *[c(x).alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            failed.alias("base_failed"),
            ratio(c("n_symbols"), c("n_words")).alias("symbols"),
            ratio(c("n_repeat_words"), c("n_words")).alias("repeats"),
            ratio(c("n_stutter"), c("n_words")).alias("stutter"),
            ratio(c("n_dup_lines"), c("n_lines")).alias("dup_lines"),
            ratio(c("n_capitals"), c("word_chars")).alias("capitals"),
            ratio(c("word_chars"), c("n_words"), 100).alias("word_length"),
            F.coalesce("lang", F.lit("")).alias("lang_key"),
            F.coalesce("source", F.lit("")).alias("source_key"),
        ),
    ).drop("_tm_c")


def quality_sketches(features: DataFrame) -> DataFrame:
    """(lang_key, source_key, signal, bucket) -> n over all documents with a word. Sketches merge by adding n."""
    rows = features.where("q.n_words > 0").select(
        "q.lang_key",
        "q.source_key",
        F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), sketch_bucket(F.col(f"q.{s}")).alias("bucket")) for s in SIGNALS])).alias("x"),
    )
    return rows.groupBy("lang_key", "source_key", F.col("x.signal").alias("signal"), F.col("x.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, keys: list[str], policy: RulePolicy) -> DataFrame:
    """Quartiles and upper fence of each group and signal; the windows run over a sketch's buckets, some hundreds at most."""
    merged = sketch.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "signal")
    ranked = merged.withColumn("cum", F.sum("n").over(w.orderBy("bucket"))).withColumn("total", F.sum("n").over(w))
    at = lambda k: F.min(F.when(F.col("cum") * 4 >= F.col("total") * k, F.col("bucket")))
    least = F.element_at(F.create_map(*[x for s, m in SIGNALS.items() for x in (F.lit(s), F.lit(m))]), F.col("signal"))
    return (
        ranked.groupBy(*keys, "signal")
        .agg(F.max("total").alias("docs"), sketch_value(at(1)).alias("q1"), sketch_value(at(3)).alias("q3"))
        .select(*keys, "signal", "docs", (F.col("q3") + F.greatest(policy.spread * (F.col("q3") - F.col("q1")), least)).cast("long").alias("fence"))
    )


def adaptive_thresholds(sketches: DataFrame, policy: RulePolicy = RulePolicy()) -> DataFrame:
    """One row for each (lang_key, source_key): a fence for every signal, of the group, else its language, else the corpus."""
    own = _fences(sketches, ["lang_key", "source_key"], policy)
    lang = _fences(sketches, ["lang_key"], policy).select("lang_key", "signal", F.col("docs").alias("l_docs"), F.col("fence").alias("l_fence"))
    whole = _fences(sketches, [], policy).select("signal", F.col("fence").alias("c_fence"))
    best = (
        F.when(F.col("docs") >= policy.min_docs, F.col("fence")).when(F.col("l_docs") >= policy.min_docs, F.col("l_fence")).otherwise(F.col("c_fence"))
    )
    wide = own.join(lang, ["lang_key", "signal"]).join(F.broadcast(whole), "signal")  # whole: a row for each signal
    return wide.groupBy("lang_key", "source_key").agg(*[F.max(F.when(F.col("signal") == s, best)).alias(f"max_{s}") for s in SIGNALS])


def _judged(docs: DataFrame, policy: RulePolicy, carry: tuple[str, ...]) -> DataFrame:
    """(row, q, kept): row has the carried columns, whatever their names. The features are staged once."""
    rows = docs.select("text", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"))
    features = stage(quality_features(rows, policy).select("row", "q"), "quality")
    limits = stage(adaptive_thresholds(quality_sketches(features), policy), "fences").select(
        F.col("lang_key").alias("of_lang"), F.col("source_key").alias("of_source"), *[F.col(f"max_{s}") for s in SIGNALS]
    )
    joined = features.join(small(limits), (F.col("q.lang_key") == F.col("of_lang")) & (F.col("q.source_key") == F.col("of_source")), "left")
    passed = F.lit(True)
    for s in SIGNALS:
        passed = passed & (F.col(f"q.{s}") <= F.col(f"max_{s}"))
    return joined.select("row", "q", F.coalesce(~F.col("q.base_failed") & passed, F.lit(False)).alias("kept"))


def apply_quality_rules(docs: DataFrame, policy: RulePolicy = RulePolicy(), carry: tuple[str, ...] | None = None) -> DataFrame:
    """docs (its columns named in carry, else all) with q (counts and signals) and kept; columns of these two names give way.

    Empty and null texts fail; rows that repeat are judged each; an empty table gives an empty table.
    """
    carry = tuple(carry or docs.columns)
    return _judged(docs, policy, carry).select(*[F.col(f"row.`{c}`") for c in carry if c not in ("q", "kept")], "q", "kept")


def keep_good(docs: DataFrame, policy: RulePolicy = RulePolicy()) -> DataFrame:
    """Only the documents that the rules keep, with the columns of docs, whatever their names."""
    return _judged(docs, policy, tuple(docs.columns)).where("kept").select("row.*")


#: The same rows in DuckDB's SQL.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang_key, coalesce(source, '') AS source_key FROM {docs}),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, ws[i:i+4] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, sum(least(5, i - prev)) AS r FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - 5) AS prev FROM dup) GROUP BY doc_id),
c AS (SELECT doc_id, lang_key, source_key, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines, coalesce(r, 0)::BIGINT AS n_repeat_words,
             length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_capitals,
             len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS n_stutter
      FROM w LEFT JOIN rep USING (doc_id)),
s AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
             coalesce(n_symbols * 1000 // nullif(n_words, 0), 0) AS symbols, coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0) AS repeats, coalesce(n_stutter * 1000 // nullif(n_words, 0), 0) AS stutter,
             coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0) AS dup_lines, coalesce(n_capitals * 1000 // nullif(word_chars, 0), 0) AS capitals,
             coalesce(word_chars * 100 // nullif(n_words, 0), 0) AS word_length FROM c),
v AS (SELECT lang_key, source_key, u.signal, u.least_gap, u.v FROM s, LATERAL (SELECT unnest([
        {{'signal': 'symbols', 'least_gap': 200, 'v': symbols}}, {{'signal': 'repeats', 'least_gap': 200, 'v': repeats}}, {{'signal': 'stutter', 'least_gap': 200, 'v': stutter}},
        {{'signal': 'dup_lines', 'least_gap': 500, 'v': dup_lines}}, {{'signal': 'capitals', 'least_gap': 300, 'v': capitals}},
        {{'signal': 'word_length', 'least_gap': 600, 'v': word_length}}]) AS u) WHERE n_words > 0),
b AS (SELECT lang_key, source_key, signal, least_gap,
             CASE WHEN v < 32 THEN v ELSE (v >> (length(bin(v)) - 5)) << (length(bin(v)) - 5) END AS low FROM v),
g AS (SELECT lang_key, source_key, signal, least_gap, low, 0 AS lvl FROM b UNION ALL SELECT lang_key, NULL, signal, least_gap, low, 1 FROM b
      UNION ALL SELECT NULL, NULL, signal, least_gap, low, 2 FROM b),
h AS (SELECT lvl, lang_key, source_key, signal, least_gap, low, count(*) AS n FROM g GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER (PARTITION BY lvl, lang_key, source_key, signal ORDER BY low) AS cum,
               sum(n) OVER (PARTITION BY lvl, lang_key, source_key, signal) AS total FROM h),
f AS (SELECT lvl, lang_key, source_key, signal, max(total) AS docs,
             min(low) FILTER (cum * 4 >= total * 3) + greatest(3 * (min(low) FILTER (cum * 4 >= total * 3) - min(low) FILTER (cum * 4 >= total)), max(least_gap)) AS fence
      FROM cum GROUP BY ALL),
best AS (SELECT o.lang_key, o.source_key, o.signal, CASE WHEN o.docs >= 100 THEN o.fence WHEN l.docs >= 100 THEN l.fence ELSE a.fence END AS fence
         FROM f o JOIN f l ON l.lvl = 1 AND l.lang_key = o.lang_key AND l.signal = o.signal JOIN f a ON a.lvl = 2 AND a.signal = o.signal WHERE o.lvl = 0),
p AS (SELECT lang_key, source_key, max(fence) FILTER (signal = 'symbols') AS f1, max(fence) FILTER (signal = 'repeats') AS f2,
             max(fence) FILTER (signal = 'dup_lines') AS f3, max(fence) FILTER (signal = 'capitals') AS f4, max(fence) FILTER (signal = 'word_length') AS f5, max(fence) FILTER (signal = 'stutter') AS f6
      FROM best GROUP BY ALL)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words, base_failed,
       coalesce(NOT base_failed AND symbols <= f1 AND repeats <= f2 AND dup_lines <= f3 AND capitals <= f4 AND word_length <= f5 AND stutter <= f6, false) AS kept
FROM s LEFT JOIN p USING (lang_key, source_key)
"""
