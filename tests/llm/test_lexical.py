"""Ranked search against a plain version, over several blocks of items and many partitions."""

import math
import random
import re

import numpy as np

from tidemark.llm.lexical import Heaps, SearchPolicy, rank_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS, ITEMS = "doc_id bigint, text string, rank string, item_id int, n int", "item_id bigint, text string, score int"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    split = [(i, terms(t)) for i, t, *_ in docs]
    n, total = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    df = {}
    for _, t in split:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text, *_ in items:
        scored = []
        for i, t in split:
            if i is not None:
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 12 * (75 + 25 * len(t) * n // total))) for x in terms(text) if x in df and x in t)
                if s > 0:
                    scored.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **policy):
    found = rank_documents(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), SearchPolicy(**policy))
    return sorted(map(tuple, found.collect()), key=str)


def table(seed):
    r = random.Random(seed)
    words = ["the", "The", "Él", "él", "x1", "漢字", "naïve", "a", "b", "c", "d", "e-f", "g_h", "ß"]
    text = lambda n: r.choice([" ", "\n", ", "]).join(r.choice(words) for _ in range(n))
    docs = [(i, text(r.randrange(40)), "r", 1, 2) for i in range(80)] + [(100 + i, "the same a b", None, None, None) for i in range(40)]
    docs += [(None, "the él a b c", "", 1, 1), (7, None, "", 1, 1), (8, "", "", 1, 1), (9, " .,! ", "", 1, 1), (3, "the the the", "", 1, 1), (3, "the the the", "", 1, 1), (500, "a b " * 30000, "", 1, 1)]
    items = [(i, text(8), 1) for i in range(12)] + [(1, "the a a a", 2), (None, "x1 Él", 3), (50, None, 4), (51, "", 5), (52, "nowhere", 6)]
    return docs, items


def test_equals_plain_version(spark):
    docs, items = table(1)
    assert ranked(spark, docs, items, k=5, cells=64) == brute(docs, items, 5)


def test_blocks_of_items_change_nothing(spark):
    docs, items = table(2)
    assert ranked(spark, docs, items, k=7, postings=9, merge=2) == brute(docs, items, 7)


def test_empty_tables(spark):
    docs, items = table(3)
    assert ranked(spark, [], items) == []
    assert ranked(spark, docs, []) == []
    assert ranked(spark, [(1, None, "", 1, 1)], items) == []


def test_heaps_hold_the_best():
    r = np.random.default_rng(5)
    score, doc = r.integers(0, 6, (400, 3)), r.permutation(400).astype(np.int64)
    heaps = Heaps(3, 10)
    for i in range(0, 400, 37):
        heaps.offer(doc[i : i + 37], score[i : i + 37])
    for item in range(3):
        want = sorted((-s, d) for s, d in zip(score[:, item].tolist(), doc.tolist(), strict=True) if s)[:10]
        assert list(zip((-heaps.score[item]).tolist(), heaps.doc[item].tolist(), strict=True)) == want
