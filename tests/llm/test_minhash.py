import random

import numpy as np
import pytest

from tidemark.llm import minhash as mh

SCHEMA = "doc_id long, text string, label string, class_id string"


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def make(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    prose = lambda n: [word() for _ in range(n)]
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append((n, " ".join(words)))
        n += 1

    for _ in range(30):
        add(prose(rng.randint(1, 120)))
    base = prose(300)
    for _ in range(60):  # a hot group: one or two words changed
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(300)] = word()
        add(w)
    shared = prose(40)
    for _ in range(60):  # a common passage in texts that are no copies
        add(prose(60) + shared + prose(60))
    for _ in range(25):  # exact copies, with other white space
        rows.append((n, "\n".join(base[:100])))
        n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("policy", [mh.NearPolicy(), mh.NearPolicy(all_pairs=2, block=8)])
def test_classes_match_brute_force(spark, policy):
    rows = make()
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in mh.near_classes(df, policy).collect()}
    want = brute(rows)
    assert {i: r.class_id for i, r in got.items()} == want
    for i, r in got.items():
        assert r.class_size == sum(c == want[i] for c in want.values()) and r.keeper == (want[i] == i)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "same text here"), (5, "same   text\there"), (6, long), (7, long + " end"), (7, long + " end"), (None, "same text here"), (8, "w " * 5000)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    out = mh.near_classes(df).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.class_id, r.class_size) for r in out}
    assert got[1] == (1, 1) and got[2] == (2, 1) and got[3] == (3, 1) and got[4] == got[5] == (4, 2) and got[6] == got[7] == (6, 2) and got[8] == (8, 1)
    assert got[None][0] == 4
    kept = mh.drop_near_copies(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 6, 8, None}


def test_an_id_with_several_texts_ties_their_classes(spark):
    rng = random.Random(3)
    a, b = (" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80)) for _ in range(2))
    rows = [(1, a), (2, b), (3, a + " x"), (3, b + " y"), (4, "quite another text of some words")]
    got = {r.doc_id: r.class_id for r in mh.near_classes(spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_empty_table(spark):
    assert mh.near_classes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sampler_agrees_as_often_as_the_similarity():
    rng = np.random.default_rng(2)
    h = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
    wa, wb = rng.uniform(0.5, 5, len(h)).astype(np.float32), rng.uniform(0.5, 5, len(h)).astype(np.float32)
    a, b = slice(0, 330), slice(60, None)
    sampler = mh.Sampler(4000)
    share = (sampler.signature(h[a], wa[a]) == sampler.signature(h[b], wb[b])).mean()
    assert abs(share - mh.weighted_jaccard(h[a], wa[a], h[b], wb[b])) < 0.03
    assert (sampler.signature(h, wa) == sampler.signature(h, wa)).all()
