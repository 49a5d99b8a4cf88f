import random
import re

from tidemark.llm import decontaminate as dc

DOCS = "doc_id long, text string, item_id string, raw string"
ITEMS = "item_id long, text string, doc_id string"
ITEM = "If Anna buys 3 apples and Bob buys 5 apples, how many apples do Anna and Bob have together at the end of the day?"
PROSE = "Nothing of the kind stands in this text, which speaks of weather and of the sea for quite a while and then ends."


def leaks(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS)
    m = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    return {(r.doc_id, r.item_id): r for r in dc.find_leaks(d, m).collect()}


def test_verbatim_and_parameterised_leaks(spark):
    other = ITEM.replace("Anna", "Carla").replace("Bob", "Dan").replace("3", "12").replace("5", "40")
    docs = [(1, f"Some words before. {ITEM} And some words after."), (2, f"{PROSE} {other}"), (3, PROSE), (4, ""), (5, None), (6, ITEM.upper()), (7, ITEM[:45]), (1, f"Some words before. {ITEM} And some words after."), (8, PROSE * 400 + " " + ITEM)]
    got = leaks(spark, docs, [(10, ITEM), (11, "too short"), (12, None), (13, ITEM)])
    assert {k for k in got if k[0] not in (6,)} == {(d, i) for d in (1, 2, 8) for i in (10, 13)}
    assert got[1, 10].n_changed == 0 and got[2, 10].n_changed >= 3 and got[2, 10].covered > 15


def test_inconsistent_slots_are_no_leak(spark):
    item = "Tom has 4 red hats and then Tom gives 4 red hats to his aunt so that Tom now owns 4 hats fewer than 4 days ago"
    same = item.replace(" 4 ", " 7 ")
    text = item
    for n in ("7", "8", "9", "6"):
        text = text.replace(" 4 ", f" {n} ", 1)
    got = leaks(spark, [(1, same), (2, text)], [(1, item)])
    assert (1, 1) in got and (2, 1) not in got


def test_filter_and_empty_tables(spark):
    d = spark.createDataFrame([(1, f"x {ITEM} y", "a", "b"), (2, PROSE, "a", "b"), (None, ITEM, "a", "b")], DOCS)
    m = spark.createDataFrame([(1, ITEM, "z")], ITEMS)
    out = dc.drop_leaks(d, m)
    assert out.columns == d.columns and {r.doc_id for r in out.collect()} == {2, None}
    assert dc.drop_leaks(d, m.where("false")).count() == 3
    assert dc.find_leaks(d.where("false"), m).count() == 0


def test_one_result_at_every_size_of_the_benchmark(spark):
    rng = random.Random(8)
    part = lambda n: " ".join(rng.choice(["why", "Paris", "ROME", "nasa", "Lands", "Apollo", "the", "4", "km", "and", "so", "on", "Anna"]) for _ in range(n))
    items = [(0, "Why Paris Rome"), (1, "NASA lands Apollo"), (2, ITEM), *((10 + i, part(rng.choice([3, 5, 8, 14]))) for i in range(25))]
    docs = [(0, "people ask why paris rome and so on"), (1, "then the NASA lands Apollo again"), (2, ITEM.lower())]
    docs += [(10 + i, f"{part(4)} {rng.choice([str.lower, str.upper, str.title, str])(rng.choice(items)[1])} {part(4)}") for i in range(80)]
    d, m = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS), spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    key = lambda df: sorted(map(tuple, df.collect()))
    found = key(dc.find_leaks(d, m))
    assert {(0, 0), (1, 1), (2, 2)} <= {x[:2] for x in found}
    assert found == key(dc.find_leaks(d, m, dc.LeakPolicy(block=20)))


def test_letter_case_hides_no_leak(spark):
    items = [(0, "What is the tallest mountain of Europe called in books"), (1, "A train leaves Boston at 5 pm and travels to New York at 60 mph without any stop")]
    docs = [(0, f"{PROSE} {items[0][1].lower()} {PROSE}"), (1, f"{PROSE} {items[1][1].lower()} {PROSE}"), (2, items[0][1].upper()), (3, "what is the tallest tree of Europe"), (4, PROSE)]
    assert set(leaks(spark, docs, items)) == {(0, 0), (1, 1), (2, 0)}


def test_template_keeps_the_number_of_tokens(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.common import words_of

    texts = ["a 12 km, b", "x -- y < z > 5%", "He met Anna. Then 3.5 kg!", "", " e È À b "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", dc.template(words_of(F.col("t")), F.lit(True)).alias("x"))
    rows = df.collect()
    assert all(len(r.t.split()) == len(r.x) for r in rows)
    assert rows[0].x == ["a", "<n>", "<u>", "b"] and rows[2].x == ["he", "met", "<p>", "then", "<n>", "<u>"]


def test_each_place_is_judged_alone(spark):
    other = lambda *v: ITEM.replace("Anna", v[0]).replace("Bob", v[1]).replace("3", v[2]).replace("5", v[3])
    a, b = other("Carla", "Dan", "12", "40"), other("Eve", "Fritz", "7", "9")
    docs = [(1, f"{ITEM} {PROSE} {a}"), (2, f"{a} {PROSE} {b}"), (3, f"{PROSE} {a} {b}"), (4, ITEM.replace(" have together", " now still have together"))]
    got = leaks(spark, docs, [(10, ITEM)])
    assert set(got) == {(1, 10), (2, 10), (3, 10), (4, 10)} and got[1, 10].n_changed == 0


def test_items_with_many_slots(spark):
    items = ["Compute 12 + 45 - 7 * 3 and then 18 / 2 + 6 - 1 = 14 for x = 3, y = 4.", "Solve 3 x + 4 y = 10 and 2 x - 5 y = 7 for x and y."]
    other = "Compute 99 + 98 - 97 * 96 and then 95 / 94 + 93 - 92 = 91 for x = 90, y = 89."
    got = leaks(spark, [*[(i, f"{PROSE} {t} {PROSE}") for i, t in enumerate(items)], (9, other), (10, "1 + 2 - 3 * 4 and then 5 / 6 + 7 - 8 = 9"), (11, "12 + 45 - 7 * 3 " * 50)], list(enumerate(items)))
    assert set(got) == {(0, 0), (1, 1), (9, 0)}
    assert all(got[k].covered >= got[k].item_tokens - 1 and got[k].n_changed == 0 for k in ((0, 0), (1, 1))) and got[9, 0].n_changed > 10


def test_short_items_are_one_window(spark):
    items = [(0, "Which river flows through that old town?"), (1, "12 + 45 - 7 * 3 = ?"), (2, "3 + 4"), (3, "ab cd"), (4, "Who wrote it?")]
    docs = [(i, f"{PROSE} {t} {PROSE}") for i, t in items] + [(9, "12 + 45 - 7 * 4 = ?"), (10, "So which river flows through that old town"), (11, "who wrote them"), (12, "3 + 4 0")]
    got = leaks(spark, docs, items)
    assert set(got) == {(0, 0), (1, 1), (2, 2), (4, 4), (10, 0), (12, 2)}


def test_long_tokens_and_repeated_ids(spark):
    docs = [(1, "x" * 1_000_000 + "1"), (2, "1" * 1_000_000), (3, "<" * 300_000 + " " + ITEM), (4, "nothing"), (4, ITEM), (5, "(" * 500_000)]
    assert set(leaks(spark, docs, [(10, ITEM)])) == {(3, 10), (4, 10)}


def tokens(text):
    raw, out = [w for w in re.split("[ \\t-\\r]+", text) if w], []
    for i, t in enumerate(raw):
        bare = "".join(c for c in t if c.isalpha()).lower()
        if (t in dc._UNITS or bare in dc._UNITS) and i and re.search("[0-9]", raw[i - 1]) and not re.search("[0-9]", t):
            out.append("<u>")
        elif re.search("[0-9]", t):
            out.append("<n>")
        elif re.fullmatch("[A-Z][a-z].*", t) and not re.match(f"(?:{dc._COMMON})(?![A-Za-z])", t):
            out.append("<p>")
        else:
            out.append(bare or "<s>")
    return raw, out


def windows(tpl, n=8, m=5):
    out = {}
    for i in range(len(tpl)):
        words = [j for j in range(i, len(tpl)) if tpl[j][0] != "<"]
        if len(words) >= m and max(words[m - 1] + 1, i + n) <= len(tpl):
            out[i] = max(words[m - 1] + 1, i + n)
    return out


def brute(doc, item):
    """Whether doc leaks item."""
    (raw, tpl), (iraw, itpl) = tokens(doc), tokens(item)
    if len(itpl) < 3:
        return False
    clean = lambda w: re.sub("^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "", w).lower() or w
    own, found = windows(itpl), []
    if own:
        for d, e in windows(tpl).items():
            found += [(d, i, j) for i, j in own.items() if tpl[d:e] == itpl[i:j]]
    elif sum(t[0] != "<" for t in itpl) >= 5:
        found += [(d, 0, len(itpl)) for d in range(len(tpl)) if tpl[d : d + len(itpl)] == itpl]
    low, ilow = [w.lower() for w in raw], [w.lower() for w in iraw]
    runs = [(i, i + 8) for i in range(len(ilow) - 7) if sum(t[0] != "<" for t in itpl[i : i + 8]) >= 5] if own else [(0, len(ilow))]
    found += [(d, i, j) for i, j in runs for d in range(len(low)) if low[d : d + j - i] == ilow[i:j]]
    hits = []
    for d, i, j in found:
        end = j
        while end < len(itpl) and itpl[end][0] == "<":
            end += 1
        if tpl[d : d + end - i] == itpl[i:end]:
            j = end
        hits.append((d - i, i, j, {(clean(iraw[k]), clean(raw[d - i + k])) for k in range(i, j) if itpl[k][0] == "<"}))
    shifts = sorted({h[0] for h in hits})
    groups = [[s] for s in shifts] + [shifts]
    run = []
    for s in shifts:
        if run and s - run[-1] >= 8:
            groups.append(run)
            run = []
        run = [*run, s]
    for g in [*groups, run]:
        mine = [h for h in hits if h[0] in g]
        covered = len({k for _, i, j, _ in mine for k in range(i, j)})
        pairs = set().union(*[h[3] for h in mine])
        if mine and covered * 100 >= len(itpl) * 50 and len({a for a, _ in pairs}) * 100 >= len(pairs) * 80:
            return True
    return False


def test_against_brute_force(spark):
    rng = random.Random(5)
    part = lambda n: " ".join(rng.choice(["to", "of", "it", "red", "Anna", "Bob", "3", "4,", "5", "km", "+", "the", "end."]) for _ in range(n))
    items = [(i, part(rng.choice([2, 4, 6, 9, 12, 20, 30]))) for i in range(60)]
    docs = []
    for i in range(200):
        text = " ".join(rng.choice(items)[1] for _ in range(2))
        changed = [rng.choice(["3", "7", "Carla", "the", w]) if rng.random() < 0.25 and (w[0].isdigit() or w in ("Anna", "Bob")) else w for w in text.split()]
        if rng.random() < 0.4:
            changed.insert(rng.randrange(len(changed) + 1), "of")
        docs.append((i, f"{part(rng.randint(0, 8))} {' '.join(changed)} {part(rng.randint(0, 8))}"))
    want = {(d, i) for d, t in docs for i, x in items if brute(t, x)}
    assert 100 < len(want) < 12000
    assert set(leaks(spark, docs, items)) == want


def test_names_at_sentence_starts(spark):
    item = "Anna buys three red apples at the old market. Bob buys several more apples there."
    got = leaks(spark, [(1, f"{PROSE} {item.replace('Anna', 'Carla').replace('Bob', 'Dan')}")], [(1, item)])
    assert got[1, 1].covered == got[1, 1].item_tokens and got[1, 1].n_changed == 2
