"""Hard negatives against all pairs, with few code words and seeds so that both rounds and the certificate work."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.hard_negatives import OUT, MinePolicy, mine_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, anchor_id string, q int"
SMALL = MinePolicy(codewords=4, seed_rows=6, shards=5, sample=40, positives=3, negatives=4)


def brute(rows, policy):
    import math
    import struct

    def single(x):
        return struct.unpack("f", struct.pack("f", x))[0]

    fit = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        fit.setdefault(i, []).append((label, [math.floor(256 * single(x)) for x in v]))
    lengths = [len(v) for found in fit.values() for _, v in found]
    common = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 0
    fit = {i: min(x for x in found if len(x[1]) == common) for i, found in fit.items() if any(len(x[1]) == common for x in found)}
    out = []
    for a, (label, q) in fit.items():
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, other == label) for i, (other, v) in fit.items() if i != a)
        for s, p, _ in [x for x in scored if x[2]][: policy.positives]:
            good = [(n, t) for t, n, same in scored if not same and policy.low * -s <= 100 * -t <= policy.high * -s]
            out += [(a, p, k + 1, n, -s, -t) for k, (n, t) in enumerate(good[: policy.negatives])]
    return sorted(out)


def mined(spark, rows, policy=SMALL):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, mine_hard_negatives(df, F.col("id") % 10 == 0, "label", policy).collect()))


def table(seed, n=160, dims=5):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [x + r.gauss(0, 0.3) for x in r.choice(centres)], r.randrange(3), "x", 1) for i in range(n)]
    copy = [0.5] * dims
    return rows + [(n + i, copy, r.randrange(3), None, None) for i in range(n // 2)]  # a third are copies


@pytest.mark.parametrize("seed,dims", [(1, 5), (2, 1), (3, 8)])
def test_equals_all_pairs(spark, seed, dims):
    rows = table(seed, dims=dims)
    assert mined(spark, rows) == brute(rows, SMALL)


def test_odd_rows_take_no_part(spark):
    rows = table(4, 60) + [
        (None, [1.0] * 5, 1, "", 0),
        (1000, None, 1, "", 0),
        (1010, [1.0] * 5, None, "", 0),
        (1020, [1.0, None, 1.0, 1.0, 1.0], 1, "", 0),
        (1030, [float("nan")] * 5, 1, "", 0),
        (1040, [float("inf")] * 5, 1, "", 0),
        (1050, [], 1, "", 0),
        (1060, [1.0] * 6, 1, "", 0),
        (1070, [1e6] * 5, 1, "", 0),
        (20, [9.0] * 5, 2, "", 0),
    ]
    rows += [rows[3], rows[3], (30, [0.25] * 5, 0, "", 0)]
    assert mined(spark, rows) == brute(rows, SMALL)


def test_few_and_no_rows(spark):
    empty = mine_hard_negatives(spark.createDataFrame([], SCHEMA), F.col("id") % 10 == 0)
    assert empty.collect() == [] and [f"{c} {t}" for c, t in empty.dtypes] == OUT.split(", ")
    assert mined(spark, [(0, [1.0, 1.0], 1, "", 0)]) == []
    assert mined(spark, [(0, [1.0], 1, "", 0), (1, [1.0], 1, "", 0), (2, [0.5], 2, "", 0)]) == [(0, 1, 1, 2, 256 * 256, 256 * 128)]
