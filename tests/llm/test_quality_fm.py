import random
import zlib

import numpy as np

from tidemark.llm import quality_fm as fm

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def rows():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    out = []
    for i in range(1200):
        n = rng.randint(5, 80)
        w = [rng.choice(words) for _ in range(n)]
        bad = i % 4 == 0
        text = " ".join(x + "###" for x in w) if bad and i % 8 else " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w)
        out.append((i, text, int(not bad)))
    return out


def test_held_out_quality(spark):
    data = rows()
    odd = [(5000, None, None), (5001, "", None), (5002, "word " * 60_000, None)]
    docs = spark.createDataFrame([(i, t, None, "s", None if i % 3 else len(t or ""), "clash") for i, t, _ in data + odd], DOCS)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in data] + [(5, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in fm.score_quality(docs, fm.train_quality(docs, labels)).collect()}
    assert len(out) == len(data) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    held = [(out[i].predicted, q) for i, _, q in data if out[i].held_out]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.97


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", None, None, 3, "x")], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert 0 <= fm.score_quality(docs, fm.train_quality(docs, none)).first().score <= 1
    assert fm.score_quality(docs.where("false"), fm.train_quality(docs.where("false"), none)).count() == 0


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = fm.Machine(0.5, rng.normal(size=fm.SIZE), rng.normal(size=(fm.SIZE, 4)))
    f, x = rng.choice(fm.SIZE, 20, replace=False), rng.normal(size=20)
    pairs = sum(m.v[f[i]] @ m.v[f[j]] * x[i] * x[j] for i in range(20) for j in range(i))
    assert np.isclose(m.margin(f, x, np.zeros(20, int), 1)[0], 0.5 + (m.w[f] * x).sum() + pairs)
