"""Benchmark decontamination by template canonicalisation (operator 3, native).

Numbers, units, names and signs become typed placeholders (slots) and words lose case and punctuation, so a question with
other parameters keeps its template. A template window begins at any token and ends with the token that makes it hold enough
tokens and enough words, so a window among many slots is a long one and never stands for any row of numbers. Windows of the
documents are hash-joined with those of the benchmark; items that are too short for a window are one window as a whole. As
letter case decides what is a name, runs of `window` tokens are compared by their lower-cased words too. A document leaks an item if, in one place of the document (or in all of it), the windows cover enough of the item and the slots
are consistent: one value of the item always stands for one value of the document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, small, stage, text_of, words_of

#: Units after a number.
_UNITS = (
    "m mm cm km nm km2 mi mile miles foot feet ft inch inches yard yards g kg mg kilo kilos ton tons pound pounds lb lbs oz ounce ounces l ml cl liter liters litre litres gallon gallons"
    " s ms ns sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years km/h mph w kw wh kwh volt volts amp amps hz percent degree degrees"
    " dollar dollars cent cents euro euros usd eur % € $ £"
).split()
#: Capitalised words that are no names, wherever they stand.
_COMMON = (
    "The|An|And|But|Or|Nor|So|Yet|For|If|Then|Than|That|This|These|Those|There|Here|He|She|It|Its|We|You|They|His|Her|My|Your|Our|Their|Who|Whom|Whose|What|When|Where|Which|While|Why|How"
    "|Is|Are|Was|Were|Be|Do|Does|Did|Has|Have|Had|Can|Could|Will|Would|Shall|Should|May|Might|Must|Not|No|Yes|In|On|At|By|To|Of|Off|Up|Out|From|With|Without|Into|Over|Under|After|Before"
    "|During|Between|About|Because|Since|Until|Although|Though|As|All|Any|Each|Every|Some|Many|Most|More|Both|One|Two|Three|Only|Also|Now|Let|Let's|However|Given|Suppose|Assume|Consider"
    "|Compute|Calculate|Solve|Find|Show|Prove|Determine|Evaluate|Simplify|Write|Explain|Describe|List|Name|Round|Express|Use|Using|Question|Answer|Problem|Nothing"
)


@dataclass(frozen=True)
class LeakPolicy:
    """window, words: least tokens of a window, and least words (tokens that are no slots) among them. least_cover: part of an
    item's tokens that windows must cover, percent. least_tokens: shorter items tell no leak. least_consistent: percent of the slot
    values of an item that keep to one value. block: windows of the benchmark that documents are probed for at once; larger ones
    take several passes, each the same."""

    window: int = 8
    words: int = 5
    least_cover: int = 50
    least_tokens: int = 3
    least_consistent: int = 80
    block: int = 50_000


def template(raw: Column, digits: Column) -> Column:
    """The tokens raw with placeholders in place of numbers, units, names and signs, as many as before. digits: whether any token may have one.

    Patterns look at one token and the one before and never go back in them: time is linear in the text. Most tokens
    are lower-case letters and end at the first test.
    """

    def one(t: Column, i: Column) -> Column:
        before = F.coalesce(F.get(raw, i - 1), F.lit(""))
        unit = lambda x: digits & x.isin(_UNITS) & before.rlike("[0-9]")
        name = t.rlike("^\\p{Lu}") & ~t.rlike(f"^(?:{_COMMON})(?!\\p{{L}})") & (t.rlike("^\\p{Lu}\\p{Ll}") | before.rlike("[\\p{Ll},;)]$"))
        bare = F.lower(F.regexp_replace(t, "[^\\p{L}\\p{M}]++", ""))
        rest = let(bare, lambda x: F.when(unit(x) | unit(t), "<u>").when(x == "", "<s>").otherwise(x))
        return F.when(t.rlike("^[\\p{Ll}\\p{M}]++$"), F.when(unit(t), "<u>").otherwise(t)).when(digits & t.rlike("[0-9]"), "<n>").when(name, "<p>").otherwise(rest)

    return F.transform(raw, one)


def _is_word(t: Column) -> Column:
    return ~t.startswith("<")


def _where(items: Column, test) -> Column:
    """Places of the elements for which test(element, place) holds."""
    return F.filter(F.transform(items, lambda t, i: F.when(test(t, i), i)), lambda i: i.isNotNull())


def _head(tpl: Column, t: Column, i: Column) -> Column:
    """Hash of the three tokens that begin a window."""
    return F.xxhash64(t, F.get(tpl, i + 1), F.get(tpl, i + 2))


def _raw_hash(words: Column) -> Column:
    """Hash of a window of lower-cased words."""
    return F.xxhash64(F.lit("raw"), F.array_join(words, " "))


def _in(numbers: list[int]) -> str:
    """SQL list of 64-bit numbers: as text it is parsed at once, however many they are."""
    return ", ".join(f"{x}L" for x in numbers)


def _hash(tokens: Column) -> Column:
    """Hash of a window: its template and length."""
    return F.xxhash64(F.array_join(tokens, " "))


def _sized(tail: Column, policy: LeakPolicy) -> Column:
    """Tokens of the window at the start of tail; null if tail ends before."""
    last = lambda at: F.get(at, F.lit(policy.words - 1)) + 1
    sized = lambda at: F.when(last(at).isNotNull() & (F.size(tail) >= policy.window), F.greatest(last(at), F.lit(policy.window)))
    return let(_where(tail, lambda t, i: _is_word(t)), sized).cast("int")


def _tokens(rows: DataFrame) -> DataFrame:
    """rows with raw, low and tpl: their tokens, the same in lower case, and those of their template."""
    step = rows.withColumn("raw", words_of(text_of())).withColumn("digits", text_of().rlike("[0-9]"))
    return step.withColumn("tpl", template(F.col("raw"), F.col("digits"))).withColumn("low", F.transform("raw", F.lower)).drop("digits")


def benchmark_windows(items: DataFrame, policy: LeakPolicy = LeakPolicy()) -> DataFrame:
    """(hash, heads, item_id, ipos, size, lengths, item_tokens, own, own_raw): the windows of the items, each by its template and by its words.

    own, own_raw: template and raw tokens of the window and of the slots behind it. lengths: the size of an item that is one
    window, because it has too few tokens or words for another; with too few words only its raw words tell it.
    """
    rows = _tokens(items.select("item_id", "text")).withColumn("n", F.size("tpl")).where(F.col("n") >= policy.least_tokens)
    many = F.size(_where(F.col("tpl"), lambda t, i: _is_word(t))) >= policy.words
    starts = F.transform("tpl", lambda t, i: F.struct(i.alias("ipos"), let(F.slice("tpl", i + 1, F.size("tpl")), lambda x: _sized(x, policy)).alias("size")))
    found = F.filter(starts, lambda s: s["size"].isNotNull() & (s["ipos"] + s["size"] <= F.size("tpl")))
    rows = rows.withColumn("many", many).withColumn("found", found).withColumn("short", F.size("found") == 0)
    at = lambda items, raw: F.transform(items, lambda s: F.struct(s["ipos"].alias("ipos"), s["size"].cast("int").alias("size"), F.lit(raw).alias("raw")))
    whole = F.array(F.struct(F.lit(0).alias("ipos"), F.col("n").alias("size")))
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.col("n") - policy.window, F.lit(0))), lambda i: F.struct(i.alias("ipos"), F.least(F.col("n"), F.lit(policy.window)).alias("size")))
    by_template = F.when(~F.col("short"), at(F.col("found"), False)).when(F.col("many"), at(whole, False)).otherwise(F.array().cast("array<struct<ipos:int,size:int,raw:boolean>>"))
    by_words = F.array_union(at(runs, True), F.when(F.col("short"), at(whole, True)).otherwise(F.array().cast("array<struct<ipos:int,size:int,raw:boolean>>")))
    # a run of slots alone is no window, unless it is all of a short item
    by_words = F.filter(by_words, lambda s: (F.col("short") & (s["size"] == F.col("n"))) | (F.size(_where(F.slice("tpl", s["ipos"] + 1, s["size"]), lambda t, i: _is_word(t))) >= policy.words))
    rows = rows.withColumn("w", F.explode(F.concat(by_template, by_words)))
    ipos, size = F.col("w.ipos"), F.col("w.size")
    behind = F.aggregate(F.slice("tpl", ipos + size + 1, F.col("n")), F.struct(F.lit(0).alias("k"), F.lit(True).alias("on")), lambda a, t: F.struct((a["k"] + (a["on"] & ~_is_word(t)).cast("int")).alias("k"), (a["on"] & ~_is_word(t)).alias("on")), lambda a: a["k"])
    rows = rows.withColumn("long", size + behind)
    own = lambda c, n=F.col("long"): F.slice(F.col(c), ipos + 1, n)
    key = F.when(F.col("w.raw"), _raw_hash(own("low", size))).otherwise(_hash(own("tpl", size)))
    first = F.get("tpl", ipos)  # a unit's name is a word at the item's start, and a unit where a document has a number before
    heads = F.when(F.col("w.raw"), F.array(_head(F.col("low"), F.get("low", ipos), ipos))).otherwise(F.array(_head(F.col("tpl"), first, ipos), F.when(first.isin(_UNITS), _head(F.col("tpl"), F.lit("<u>"), ipos))))
    lengths = F.when(F.col("short") & (size == F.col("n")), size)
    return rows.select(key.alias("hash"), F.array_compact(heads).alias("heads"), "item_id", ipos.alias("ipos"), size.alias("size"), lengths.alias("lengths"), F.col("n").alias("item_tokens"), own("tpl").alias("own"), own("raw").alias("own_raw"))


def _candidates(docs: DataFrame, policy: LeakPolicy, longest: int, reach: int, lengths: list[int], heads: list[int], hashes: list[int]) -> DataFrame:
    """(doc_id, text_hash, dpos, hash, tail, tail_raw): windows of the documents that are among the benchmark's, by their first tokens (heads) and whole (hashes).

    longest: of the benchmark's windows; reach: the same with the slots behind; lengths: of items that are one window.
    """
    rows = _tokens(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))).drop("text")
    begins = "filter(transform({0}, (t, i) -> CASE WHEN xxhash64(t, get({0}, i + 1), get({0}, i + 2)) IN (" + _in(heads) + ") THEN i END), i -> i IS NOT NULL)"
    rows = rows.withColumn("at", F.expr(begins.format("tpl"))).withColumn("at_raw", F.expr(begins.format("low")))
    none = F.array().cast("array<struct<dpos:int,hash:bigint>>")

    def windows(tokens: Column, i: Column, sized: list[Column], own_hash, sizes: list[int]) -> Column:
        fits = [F.when(i + n <= F.size(tokens), own_hash(F.slice(tokens, i + 1, n))) for n in sizes]
        return F.transform(F.array_compact(F.array_distinct(F.array(*sized, *fits))), lambda h: F.struct(i.alias("dpos"), h.alias("hash")))

    def of(at: str, tokens: str, body) -> Column:
        return F.when(F.size(at) == 0, none).otherwise(let(F.col(tokens), lambda x: F.flatten(F.transform(at, lambda i: body(x, i)))))

    def grown(x: Column, i: Column) -> list[Column]:
        return [let(F.slice(x, i + 1, longest), lambda y: let(_sized(y, policy), lambda n: F.when(n.isNotNull(), _hash(F.slice(y, F.lit(1), n)))))]

    by_template = of("at", "tpl", lambda x, i: windows(x, i, grown(x, i), _hash, lengths))
    by_words = of("at_raw", "low", lambda x, i: windows(x, i, [], _raw_hash, sorted({policy.window, *lengths})))
    rows = rows.select("doc_id", "text_hash", "raw", "tpl", F.concat(by_template, by_words).alias("win"))
    rows = rows.withColumn("win", F.expr(f"filter(win, w -> w.hash IN ({_in(hashes)}))"))
    tail = lambda c: F.slice(F.col(c), F.col("w.dpos") + 1, reach)
    # explode_outer: before explode, Spark filters by the size of win, for which it makes all templates again
    return rows.withColumn("w", F.explode_outer("win")).where("w IS NOT NULL").select("doc_id", "text_hash", "w.dpos", "w.hash", tail("tpl").alias("tail"), tail("raw").alias("tail_raw"))


def _hits(docs: DataFrame, bench: DataFrame, policy: LeakPolicy) -> DataFrame | None:
    """Windows of documents beside the benchmark windows of the same hash; None without benchmark windows. The benchmark is taken in blocks, by the windows' hashes: one result, whatever its size."""
    blocks = -(-bench.count() // policy.block)
    out = None
    for k in range(blocks):
        part = bench.where(F.pmod("hash", F.lit(blocks)) == k) if blocks > 1 else bench
        about = part.agg(F.max("size").alias("longest"), F.max(F.size("own")).alias("reach"), F.collect_set("lengths").alias("lengths"), F.sum(F.size("own")).alias("tokens"), F.array_distinct(F.flatten(F.collect_set("heads"))).alias("heads"), F.collect_set("hash").alias("hashes")).first()  # a block's numbers
        if about.hashes:
            found = _candidates(docs, policy, about.longest, about.reach, sorted(about.lengths), about.heads, about.hashes)
            found = found.join(F.broadcast(part) if about.tokens <= 40 * policy.block else part, "hash")
            found = stage(found, "hits") if blocks > 1 else found
            out = found if out is None else out.unionAll(found)
    return out


def find_leaks(docs: DataFrame, items: DataFrame, policy: LeakPolicy = LeakPolicy()) -> DataFrame:
    """One row for each leaked (doc_id, item_id): item_tokens, covered (item tokens inside shared windows), n_slots, n_changed.

    An item is looked for in every place of the document: in windows that are aligned word by word, in those with a few words
    more or less between them, and in all of the document. The place that leaks it with the widest cover, then the fewest
    changes, is reported. Null and empty texts leak nothing; an item that occurs twice in the benchmark is reported twice; items
    of fewer than policy.least_tokens tokens are never reported. Rows that repeat a document count as one; the texts of an id
    that stands for several are judged one by one and the worst is reported. Needs doc_id and text of docs, item_id and
    text of items; other columns are not looked at, whatever their names.
    """
    bench = stage(benchmark_windows(items, policy), "windows")
    hits = _hits(docs, bench, policy)
    if hits is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}, item_tokens bigint, covered bigint, n_slots bigint, n_changed bigint")
    long = F.when(F.slice("tail", F.lit(1), F.size("own")) == F.col("own"), F.size("own")).otherwise(F.col("size"))
    hits = hits.withColumn("long", long)
    clean = lambda w: F.lower(F.regexp_replace(w, "^[^\\p{L}\\d]+|[^\\p{L}\\d]+$", ""))
    slots = _where(F.slice("own", F.lit(1), F.col("long")), lambda t, i: ~_is_word(t))
    bare = lambda w: F.when(clean(w) == "", w).otherwise(clean(w))
    pairs = F.transform(slots, lambda i: F.struct(bare(F.get("own_raw", i)).alias("a"), bare(F.get("tail_raw", i)).alias("b")))
    key = ["doc_id", "text_hash", "item_id"]
    aligned = hits.groupBy(*key, (F.col("dpos") - F.col("ipos")).alias("shift")).agg(
        F.max("item_tokens").alias("item_tokens"),
        F.collect_set(F.struct("ipos", (F.col("ipos") + F.col("long")).alias("stop"))).alias("at"),  # at most the windows of the item
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
    )
    by_shift = Window.partitionBy(*key).orderBy("shift")  # one item's places in one document
    apart = aligned.withColumn("new", (F.col("shift") - F.lag("shift").over(by_shift) >= policy.window).cast("int"))
    near = F.sum(F.coalesce("new", F.lit(0))).over(by_shift).cast("int")
    place = lambda kind, no: F.struct(F.lit(kind).alias("kind"), no.alias("no"))
    places = F.array(place("aligned", F.col("shift")), place("near", F.col("near")), place("all", F.lit(0)))
    found = apart.withColumn("near", near).withColumn("place", F.explode(places)).groupBy(*key, "place").agg(
        F.max("item_tokens").alias("item_tokens"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"),
    )
    last = F.struct(F.lit(0).alias("last"), F.lit(0).alias("sum"))
    step = lambda a, p: F.struct(F.greatest(a["last"], p["stop"]).alias("last"), (a["sum"] + F.greatest(F.lit(0), p["stop"] - F.greatest(a["last"], p["ipos"]))).alias("sum"))
    out = found.select(
        "doc_id",
        "item_id",
        F.col("item_tokens").cast("long"),
        F.aggregate("at", last, step, lambda a: a["sum"].cast("long")).alias("covered"),
        F.size("pairs").cast("long").alias("n_slots"),
        F.size(F.filter("pairs", lambda p: p["a"] != p["b"])).cast("long").alias("n_changed"),
        F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"]))).cast("long").alias("values"),
    )
    enough = F.col("covered") * 100 >= F.col("item_tokens") * policy.least_cover
    consistent = F.col("values") * 100 >= F.col("n_slots") * policy.least_consistent
    best = F.max_by(F.struct("item_tokens", "covered", "n_slots", "n_changed"), F.struct("covered", -F.col("n_changed"), -F.col("n_slots"))).alias("x")
    return out.where(enough & consistent).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.*")


def drop_leaks(docs: DataFrame, items: DataFrame, policy: LeakPolicy = LeakPolicy()) -> DataFrame:
    """docs without those that leak an item: all rows of such an id go; documents with a null id stay. Columns as they are."""
    leaked = stage(find_leaks(docs, items, policy).select("doc_id").distinct(), "leaks")
    return docs.join(small(leaked, 200_000), "doc_id", "left_anti").select(*docs.columns)
