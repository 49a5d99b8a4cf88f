import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import katz

SCHEMA = "doc_id long, text string, lang string, n_tokens string"


def held(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def tokens(text):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in fold.replace("\t", " ").replace("\n", " ").split(" ") if w] + ["</s>"]


class Brute:
    """The model by its definition, for any order."""

    def __init__(self, rows, order=3):
        self.order, self.count, self.follow = order, [Counter() for _ in range(order + 1)], defaultdict(set)
        for i, t in rows:
            if held(i):
                continue
            self.count[0][()] += len(tokens(t))
            w = ["<s>"] * (order - 1) + tokens(t)
            for at in range(order - 1, len(w)):
                for k in range(1, order + 1):
                    self.count[k][tuple(w[at - k + 1 : at + 1])] += 1
                    self.follow[tuple(w[at - k + 1 : at])].add(w[at])
        self.n, self.uni = self.count[0][()], {k[0]: v for k, v in self.count[1].items()}
        self.v = len(self.uni)
        self.d = [None, *[katz.discounts([sum(c == r for c in self.count[k].values()) for r in range(1, 7)]) for k in range(1, order + 1)]]
        self.memo = {}

    def history(self, h):
        return sum(self.count[len(h) + 1][(*h, w)] for w in self.follow[h]) if h in self.follow else 0

    def shares(self, h):
        """Probability of each follower of h, and what is left for others."""
        if h not in self.memo:
            counts, n, d = {w: self.count[len(h) + 1][(*h, w)] for w in self.follow[h]}, self.history(h), self.d[len(h) + 1]
            if all(c > 5 for c in counts.values()):
                left = 5 * (1 - d[5]) / n
                self.memo[h] = {w: (1 - left) * c / n for w, c in counts.items()}, left
            else:
                own = {w: (d[c] if c <= 5 else 1) * c / n for w, c in counts.items()}
                self.memo[h] = own, 1 - sum(own.values())
        return self.memo[h]

    def p(self, h, w):
        if not self.history(h):
            return self.p(h[1:], w) if h else 1.0
        own, left = self.shares(h)
        if w in own:
            return own[w]
        return left / (1 - sum(self.p(h[1:], x) for x in own)) * self.p(h[1:], w) if h else left

    def score(self, text):
        w = ["<s>"] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(w[i - self.order + 1 : i]), w[i])) for i in range(self.order - 1, len(w)))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    vocab = [f"W{k}" for k in range(60)]
    p = 1 / np.arange(1, 61)
    out = [(i, " ".join(rng.choice(vocab, size=int(rng.integers(1, 40)), p=p / p.sum()))) for i in range(120)]
    return [*out, (500, ""), (501, None), (502, "  \n\t "), (503, "never-seen é W1"), (504, "the " * 5000), (505, out[0][1]), (506, out[0][1])]


@pytest.mark.parametrize("policy", [katz.KatzPolicy(), katz.KatzPolicy(order=2, chunk=500, partition=400), katz.KatzPolicy(chunk=500, partition=400, least_partitions=4), katz.KatzPolicy(order=4, chunk=900, partition=900, least_partitions=2)])
def test_against_brute_force(spark, rows, policy):
    model = Brute(rows, policy.order)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in katz.score_texts(df, policy).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = tokens(t)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(x in model.uni for x in w), model.n)
        assert r.base_score == pytest.approx(sum(math.log10((model.uni.get(x, 0) + 0.1) / (model.n + 0.1 * (model.v + 1))) for x in w), rel=1e-9)
        assert r.score == pytest.approx(model.score(t), rel=1e-9)


def test_distributions_sum_to_one(rows):
    model = Brute(rows)
    for h in [(), ("<s>",), ("w0",), ("<s>", "w0"), ("w1", "w0"), ("w0", "w59")]:
        assert sum(model.p(h, w) for w in model.uni) + model.p(h, "never seen") == pytest.approx(1, abs=1e-9)


def test_large_numbers_keep_all_bits():
    x = np.array([0, 1, 2**32 + 5, 2**62, 255], np.int64)
    assert (katz.unpack(katz.pack(x)) == x).all() and len(katz.unpack(katz.pack(x[:0]))) == 0


def test_clashing_columns_null_ids_and_text_ids(spark):
    df = spark.createDataFrame([("a", "x y", 1, "p"), ("a", "x y", 1, "p"), (None, "x z", 2, "q"), ("b", None, 3, "r")], "doc_id string, text string, cid long, words string")
    got = katz.score_texts(df).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == ["None", "a", "a", "b"] and all(np.isfinite(r.score) for r in got)
    assert next(r for r in got if r.doc_id is None).held_out


def test_empty_table_and_only_held_out(spark):
    assert katz.score_texts(spark.createDataFrame([], SCHEMA)).collect() == []
    only = next(i for i in range(1000) if held(i))
    r = katz.score_texts(spark.createDataFrame([(only, "a b", "x", "y")], SCHEMA)).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0)
    assert np.isfinite(r.score)


def test_one_odd_count_of_counts_keeps_good_turing():
    n = [1000, 300, 150, 90, 100, 50]  # only counts 4 and 5 give no ratio that rises in (0, 1)
    tail = 6 * 50 / 1000
    turing = [((r + 1) * n[r] / n[r - 1] / r - tail) / (1 - tail) for r in range(1, 6)]
    assert turing[3] > 1
    got = katz.discounts(n)
    assert got[1:4] == pytest.approx(turing[:3])
    x, y = np.log(np.arange(1, 7)), np.log(n)
    slope = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()
    smooth = lambda r: (((r + 1) / r) ** (slope + 1) - 6 ** (slope + 1)) / (1 - 6 ** (slope + 1))
    assert got[4:] == pytest.approx([smooth(4), smooth(5)])
    assert 0 < got[4] < got[5] < 1


def test_discounts_of_small_and_copied_corpora_lie_inside():
    for n in ([50, 0, 9, 0, 2, 0], [700, 200, 90, 50, 33, 22], [9, 1, 0, 0, 0, 0], [0, 80, 0, 70, 0, 60], [0] * 6, [5, 5, 5, 5, 5, 5]):
        got = katz.discounts(n)
        assert (got[1:] > 0).all() and (got[1:] < 1).all()
    assert katz.discounts([50, 0, 9, 0, 2, 0])[1] != 0.5


def test_copied_passage_with_one_changed_word(spark):
    passage = "one two three four five six"
    for more in ([], [f"rare{k} tail{k % 7}" for k in range(30)]):
        train, test = [i for i in range(400) if not held(i)], [i for i in range(400) if held(i)]
        rows = [*zip(train, [*[passage] * 40, *more], strict=False), (test[0], passage.replace("four", "never")), (test[1], passage), (test[2], passage.replace("four", "six"))]
        got = {r.doc_id: r.score for r in katz.score_texts(spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)).collect()}
        model = Brute(rows)
        assert sum(model.p(("two", "three"), w) for w in model.uni) + model.p(("two", "three"), "never") == pytest.approx(1)
        for i, t in rows:
            assert got[i] == pytest.approx(model.score(t), rel=1e-9)
        assert -30 < got[test[0]] < got[test[1]] and -30 < got[test[2]] < got[test[1]]
