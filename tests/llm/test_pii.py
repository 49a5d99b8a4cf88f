import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: [c for c in s if "0" <= c <= "9"]

    def luhn(s):
        d = [int(c) for c in reversed(digits(s))]
        return sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])

    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)] if "@" in text else []  # the pattern is quadratic in long words
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and luhn(m.group()) % 10 == 0]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab.@-+ 0123459()%_é\n", max_size=60))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_hard_texts_are_linear():
    for text in ("a" * 200_000, "1" * 200_000, "+1" * 100_000, "a@" * 100_000, "1." * 100_000, "+1 " + "(" * 200_000, "1 " * 100_000, "A" * 50_000 + "@b"):
        pii.base_spans(text, [])
        for _, pattern in pii._MORE:
            list(pattern.finditer(text))


SCHEMA = "doc_id long, text string, spans string, base int"


def test_query_shape_and_cases(spark):
    base = [
        "mail joe@mail.example.com or +1 (714) 555-9345 and 64.147.79.24, card 4111 1111 1111 1111",
        "999.1.1.1 and 4111111111111112 and +12",
        "",
        None,
        "x" * 300_000,
        "é a.b@c.de",
    ]
    rows = [(i, base[i % len(base)], "clash", 0) for i in range(60)] + [(3, None, "clash", 0)]
    got = pii.detect_pii(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(base[r.doc_id % len(base)] or "")
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in want) for x in range(4)]
        assert set(text.split(",")) <= set(r.spans.split(","))
    assert pii.detect_pii(spark.createDataFrame([], SCHEMA)).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail joe@mail.example.com now", "c", 1), (2, None, "c", 1), (3, "clean", "c", 1)], SCHEMA)
    got = {r.doc_id: r.text for r in pii.redact_documents(df).collect()}
    assert got == {1: "mail [EMAIL] now", 2: None, 3: "clean"}


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 20, (3000, pii.N_FEATURES)).astype(np.uint8)
    x[:, 0] = rng.integers(0, 4, 3000)
    y = (x[:, 2] > 9) & (x[:, 5] < 15)
    model = pii.fit_trees(x, y, pii.PiiPolicy())
    assert ((model.score(x) >= 0.5) == y).mean() > 0.97


def card(rng):
    digits = [rng.randrange(10) for _ in range(15)]
    return next("".join(map(str, [*digits, c])) for c in range(10) if pii.luhn("".join(map(str, [*digits, c]))))


def test_spans_beyond_the_base_are_added(spark):
    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice(["of", "the", "sea", "and", "red", "town"]) for _ in range(n))
    made, look, rows = {}, {}, []
    for i in range(900):
        c, ip, secret = card(rng), ".".join(str(rng.randrange(256)) for _ in range(4)), "".join(rng.choice("0123456789abcdef") for _ in range(40))
        national = f"({rng.randint(201, 989)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        wrong = c[:-1] + str((int(c[-1]) + 1) % 10)
        kinds = [
            (f"mail joe{i}@mail{i % 9}.example.com", "", ""),
            (f"write to ann{i} [at] host{i % 5}.example.org soon", f"ann{i} [at] host{i % 5}.example.org", ""),
            (f"paid {c} {wrong} then", c, wrong),
            (f"card {c}", "", ""),
            (f"call {national} now", national, ""),
            (f"call +1 {national} now", "", ""),
            (f'token = "{secret}" x', secret, ""),
            (f"host {ip} version 3.{i}.12.{300 + i % 500} of 2019-11-{10 + i % 19} sum {wrong}", "", wrong),
        ]
        part, want, bad = kinds[i % len(kinds)]
        before = words(rng.randint(0, 9)) + " "
        rows.append((i, before + part + " " + words(5), "clash", 0))
        if want:
            at = len(before) + part.index(want)
            made[i] = (at, at + len(want))
        if bad:
            at = len(before) + part.index(bad)
            look[i] = (at, at + len(bad))
    got = {r.doc_id: {tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x} for r in pii.detect_pii(spark.createDataFrame(rows, SCHEMA), pii.PiiPolicy(sample=300)).collect()}
    found = sum(made[i] in got[i] for i in made) / len(made)
    assert found > 0.95
    assert sum(any(a < look[i][1] and look[i][0] < b for a, b in got[i]) for i in look) <= 0.02 * len(look)


def test_added_spans_match_a_plain_version():
    rng = random.Random(8)
    for _ in range(300):
        spans = lambda n: [(s := rng.randrange(60), rng.randrange(7), s + rng.randint(1, 9)) for _ in range(n)]  # noqa: E731, B023
        base, cand = sorted(spans(rng.randrange(5))), spans(rng.randrange(30))
        score = np.array([rng.choice([-1.0, 0.2, 0.5, 0.9]) for _ in cand])
        want = list(base)
        for j in np.argsort(-score, kind="stable"):
            if score[j] >= 0 and all(cand[j][2] <= a or cand[j][0] >= b for a, _, b in want):
                want.append(cand[j])
        assert pii.added_spans(base, cand, score) == sorted(want)


def test_rare_kinds_go_by_their_check(spark):
    rows = [(1, "iban DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00", "c", 1), (None, "ssn 123-45-6789 or 000-12-3456", "c", 1), (2, "x" * 200_000 + " 1" * 1000, "c", 1)]
    got = {r.doc_id: r.spans for r in pii.detect_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == "iban:5:32" and got[None] == "ssn:4:15"
