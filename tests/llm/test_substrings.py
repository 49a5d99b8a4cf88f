import random

import numpy as np

from tidemark.llm import substrings as sub

SCHEMA = "doc_id long, text string, chunks string, pos int"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def brute_chunks(text):
    """Cut points by the rolling definition, byte after byte."""
    data, p = text.encode(), sub.ChunkPolicy()
    spaces = b" \t\n\v\f\r"
    cuts, last = [0], 0
    for i in range(1, len(data) + 1):
        cut = i == len(data)
        if not cut and data[i] not in spaces:
            h = 0
            for b in data[max(0, i - 32) : i]:
                h = (2 * h + int(sub._GEAR[b])) & 0xFFFFFFFF
            since = i - max([0, *(k for k in range(max(0, i - 80), i) if data[k] in spaces)]) if any(data[k] in spaces for k in range(max(0, i - 80), i)) else min(i, 80)
            inner = since >= p.inner and data[i] & 0xC0 != 0x80 and h >> (32 - p.inner_bits) == 0
            cut = (inner or (data[i - 1] in spaces and h >> (32 - p.bits) == 0)) and i - last >= p.least
        if cut:
            while i - last > p.most:
                last += p.most
                while data[last] & 0xC0 == 0x80:
                    last -= 1
                cuts.append(last)
            if i > last:
                cuts.append(i)
                last = i
    return cuts


def test_cut_points_match_the_rolling_definition():
    rng = random.Random(1)
    texts = [prose(rng, 200), "é" * 900, "", "a b " * 300, prose(rng, 3), "\n".join(prose(rng, 5) for _ in range(20)), "".join(chr(rng.randint(0x4E00, 0x4FFF)) for _ in range(1500))]
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    got = sub.cut_points(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert got == [brute_chunks(t) if t else [0] for t in texts]


def test_repeats_are_found_shifted_and_clean_texts_are_left_alone(spark):
    rng = random.Random(2)
    passage = prose(rng, 70)
    rows = [(i, prose(rng, 80)) for i in range(20)]
    rows += [(100, prose(rng, 40) + " " + passage + " " + prose(rng, 33)), (101, "x " + prose(rng, 17) + "\n" + passage + " " + prose(rng, 9)), (102, passage), (103, "é " + passage)]
    rows += [(200, ""), (201, None), (202, " "), (203, rows[0][1]), (204, "tiny text"), (205, "tiny text")]
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in sub.repeated_spans(df).collect()}
    assert set(got) == {0, 203, 100, 101, 102, 103}
    text = dict(rows)
    for i in (100, 101, 102, 103):
        spans = [tuple(map(int, s.split(":"))) for s in got[i].spans.split(",")]
        assert len(spans) == 1 and text[i][slice(*spans[0])].strip() == passage
    assert got[100].drop_chars == 0 and got[101].first_docs == [100] and got[203].drop_chars == len(text[0])
    kept = {r.doc_id: r.text for r in sub.drop_repeats(df).collect()}
    assert kept[203] == "" and kept[0] == text[0] and kept[201] is None and len(kept[101]) == len(text[101]) - got[101].drop_chars
    assert sub.repeated_spans(df.where("false")).count() == 0


def test_shift_resistance_without_spaces():
    rng = random.Random(6)
    text = "".join(chr(rng.randint(0x4E00, 0x5FFF)) for _ in range(4000))
    chunks = []
    for t in (text, text[:50] + "x" + text[50:]):
        raw = t.encode()
        cuts = sub.cut_points(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        chunks.append({raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)})
    assert len(chunks[0] & chunks[1]) > 0.9 * len(chunks[0])


def test_passages_of_51_words_are_found_whole(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for k in range(150):
        passage = prose(rng, 51)
        for i in (2 * k, 2 * k + 1):
            before, after = prose(rng, rng.randint(0, 60)), prose(rng, rng.randint(1, 60))
            text = f"{before} {passage} {after}"
            rows.append((i, text))
            want[i] = (len(before) + 1, len(before) + 1 + len(passage))
    rows += [(1000 + k, prose(rng, 120)) for k in range(100)]
    got = {r.doc_id: r.spans for r in sub.repeated_spans(spark.createDataFrame([(i, t, "c", 0) for i, t in rows], SCHEMA)).collect()}
    assert not [i for i in got if i >= 1000]
    cover = []
    for i, (a, b) in want.items():
        spans = [tuple(map(int, s.split(":"))) for s in got.get(i, "0:0").split(",")]
        cover.append(sum(max(0, min(b, y) - max(a, x)) for x, y in spans) / (b - a))
    assert sum(c > 0.97 for c in cover) > 0.99 * len(cover)


def test_chunks_from_unrelated_places_do_not_join(spark):
    rng = random.Random(8)
    parts = [prose(rng, 14) for _ in range(8)]
    rows = [(k, f"{prose(rng, 50)} {p} {prose(rng, 50)}") for k, p in enumerate(parts)] + [(100, " ".join(parts))]
    assert sub.repeated_spans(spark.createDataFrame([(i, t, "c", 0) for i, t in rows], SCHEMA)).count() == 0


def test_text_ids_and_repeated_ids(spark):
    rng = random.Random(9)
    p, q = prose(rng, 60), prose(rng, 60)
    rows = [("a", p), ("b", f"{prose(rng, 9)} {p}"), ("b", f"{prose(rng, 30)} {q}"), ("c", q), ("c", q), (None, p)]
    got = [(r.doc_id, r.n_spans, r.first_docs) for r in sub.repeated_spans(spark.createDataFrame(rows, "doc_id string, text string")).collect()]
    assert sorted(got, key=str) == sorted([("a", 1, []), ("b", 1, ["a"]), ("b", 1, []), ("c", 1, ["b"]), (None, 1, ["a"])], key=str)
