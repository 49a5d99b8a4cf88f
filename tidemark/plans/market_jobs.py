"""Market series: segment cells, sum checks, year-to-date and changes, fact packs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.functions.text import br_numbers, first_volume, normalize_key, parse_int_br, reference_period
from tidemark.operators.prefixes import longest_prefix
from tidemark.operators.relational import dedupe, series_change, sum_checks
from tidemark.plans.registry import query
from tidemark.sources.tables import Tables

col = F.col

#: Segments of the monthly table, in its order: code, name, labels of a row (fixed values).
SEGMENTS = [
    ("autos", "Autos", ["A) Autos", "Autos"]),
    ("comerciais_leves", "Comerciais Leves", ["B) Com. Leves", "Com. Leves", "Comerciais Leves"]),
    ("autos_comerciais_leves", "Autos + Comerciais Leves", ["A + B", "A+B"]),
    ("caminhoes", "Caminhoes", ["C) Caminhoes", "C) Caminhões", "Caminhoes", "Caminhões"]),
    ("onibus", "Onibus", ["D) Onibus", "D) Ônibus", "Onibus", "Ônibus"]),
    ("caminhoes_onibus", "Caminhoes + Onibus", ["C + D", "C+D"]),
    ("subtotal", "Subtotal", ["Subtotal"]),
    ("motos", "Motos", ["E) Motos", "Motos"]),
    ("implementos_rodoviarios", "Implementos Rodoviarios", ["F) Impl. Rod.", "Impl. Rod.", "Implementos Rodoviarios"]),
    ("outros", "Outros", ["Outros"]),
    ("total", "Total", ["Total"]),
]
CHECKS = {
    "autos_plus_light": (("autos", "comerciais_leves"), "autos_comerciais_leves"),
    "trucks_plus_buses": (("caminhoes", "onibus"), "caminhoes_onibus"),
    "sum_to_total": (("subtotal", "motos", "implementos_rodoviarios", "outros"), "total"),
}


def segments(spark: SparkSession) -> DataFrame:
    """(segment_code, segmento, place) of the expected segments."""
    return spark.createDataFrame([(c, n, i) for i, (c, n, _) in enumerate(SEGMENTS)], "segment_code string, segmento string, place int")


def segment_aliases(spark: SparkSession) -> DataFrame:
    """(alias, segment_code): labels as keys, each once."""
    rows = spark.createDataFrame([(label, c) for c, _, labels in SEGMENTS for label in labels], "label string, segment_code string")
    return rows.select(normalize_key(col("label")).alias("alias"), "segment_code").distinct()


def segment_of(cells: DataFrame) -> DataFrame:
    """cells (an array column `cells`) with segment_code, of rows that name a segment.

    The longest alias wins: the first that the first cell begins with, else one that the whole row is or begins with before a
    space.
    """
    aliases = segment_aliases(cells.sparkSession)
    x = cells.withColumn("__first", normalize_key(F.get("cells", F.lit(0)))).withColumn("__row", F.concat(normalize_key(F.array_join("cells", " ")), F.lit(" ")))
    x = longest_prefix(x, "__first", aliases, "alias", "segment_code", "__a")
    spaced = aliases.select(F.concat("alias", F.lit(" ")).alias("alias"), "segment_code")
    x = longest_prefix(x, "__row", spaced, "alias", "segment_code", "__b")
    return x.withColumn("segment_code", F.coalesce("__a", "__b")).where(col("segment_code").isNotNull()).drop("__first", "__row", "__a", "__b")


def normalize_registrations(cells: DataFrame) -> DataFrame:
    """Segment rows (path, reference_period, place, segment_code, segmento, mes_atual) from raw cells (path, row_number, cells).

    Volumes come from the cells after the first, or from all cells where these hold none. The first row of a code counts.
    """
    tail = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))
    volume = F.coalesce(first_volume(br_numbers(tail)), first_volume(br_numbers(col("cells"))))
    x = segment_of(cells).select("path", "row_number", "segment_code", parse_int_br(volume).alias("mes_atual"), reference_period(col("path")).alias("reference_period"))
    x = dedupe(x.where("mes_atual IS NOT NULL"), ["path", "segment_code"], [col("row_number")])
    return x.join(F.broadcast(segments(cells.sparkSession)), "segment_code").select("path", "reference_period", "place", "segment_code", "segmento", "mes_atual")  # eleven rows


def missing_codes(registrations: DataFrame) -> DataFrame:
    """(path, place, segment_code): the expected segments that a file lacks, in their order."""
    all_codes = registrations.select("path").distinct().crossJoin(F.broadcast(segments(registrations.sparkSession)))  # eleven rows
    return all_codes.join(registrations.select("path", "segment_code"), ["path", "segment_code"], "left_anti").select("path", "place", "segment_code")


def file_status(checks: DataFrame, by: list[str]) -> DataFrame:
    """validated, or failed if a check of severity error did not pass."""
    bad = F.bool_or(~col("passed") & (col("severity") == "error"))
    return checks.groupBy(*by).agg(F.when(bad, "failed").otherwise("validated").alias("extraction_status"))


#: Labels of the monthly table's rows, as its files have them; the last five are sums.
LABELS = ("A) Autos", "B) Com. Leves", "C) Caminhões", "D) Ônibus", "E) Motos", "F) Impl. Rod.", "Outros")
CELLS_CTE = """
units AS (SELECT l_suppkey % 10 AS f, l_partkey % 7 AS s, sum(l_quantity::BIGINT)::BIGINT AS n FROM lineitem GROUP BY 1, 2),
months AS (SELECT f, 'm/2026/2026_' || lpad((f + 1)::VARCHAR, 2, '0') || '_01.pdf' AS path, make_date(2026, (f + 1)::INT, 1) AS reference_period,
   coalesce(sum(n) FILTER (s = 0), 0)::BIGINT AS a, coalesce(sum(n) FILTER (s = 1), 0)::BIGINT AS b, coalesce(sum(n) FILTER (s = 2), 0)::BIGINT AS c, coalesce(sum(n) FILTER (s = 3), 0)::BIGINT AS d,
   coalesce(sum(n) FILTER (s = 4), 0)::BIGINT AS e, coalesce(sum(n) FILTER (s = 5), 0)::BIGINT AS i, coalesce(sum(n) FILTER (s = 6), 0)::BIGINT AS g FROM units GROUP BY f),
sums AS (SELECT *, a + b + CASE WHEN f % 4 = 1 THEN 7 ELSE 0 END AS ab, c + d AS cd, a + b + c + d AS sub, a + b + c + d + e + i + g - CASE WHEN f % 4 = 2 THEN 1 ELSE 0 END AS total FROM months),
norm AS (SELECT path, reference_period, f, unnest(['autos', 'comerciais_leves', 'autos_comerciais_leves', 'caminhoes', 'onibus', 'caminhoes_onibus', 'subtotal', 'motos', 'implementos_rodoviarios', 'outros', 'total']) AS segment_code,
   unnest([a, b, ab, c, d, cd, sub, e, i, g, total]) AS mes_atual FROM sums),
listed AS (SELECT path, reference_period, segment_code, mes_atual FROM norm WHERE NOT (f % 4 = 3 AND segment_code = 'caminhoes_onibus')),
checked AS (SELECT path, 'autos_plus_light' AS check_name, a + b AS found, ab AS expected FROM sums UNION ALL SELECT path, 'trucks_plus_buses', c + d, CASE WHEN f % 4 <> 3 THEN cd END FROM sums UNION ALL SELECT path, 'sum_to_total', sub + e + i + g, total FROM sums)
"""


def raw_cells(t: Tables) -> DataFrame:
    """Cells in the monthly table's form, from the sums of ten groups of suppliers by seven of parts: label, number in Brazilian form, change.

    Every fourth month has a wrong sum of the first two rows, another a wrong total, another lacks the row of a sum.
    """
    f = (col("l_suppkey") % 10).cast("int")
    part = lambda k: F.coalesce(F.sum(F.when(col("l_partkey") % 7 == k, col("l_quantity").cast("long"))), F.lit(0))
    x = t.raw("lineitem").groupBy(f.alias("f")).agg(*[part(k).alias(n) for k, n in enumerate("abcdeig")])
    odd = lambda k, n: F.when(col("f") % 4 == k, n).otherwise(0)
    pair, trucks = col("a") + col("b"), col("c") + col("d")
    values = [*[(label, col(n)) for label, n in zip(LABELS, "abcdeig", strict=True)], ("A+B", pair + odd(1, 7)), ("C + D", trucks), ("Subtotal", pair + trucks), ("Total", pair + trucks + col("e") + col("i") + col("g") - odd(2, 1))]
    rows = F.array(*[F.struct(F.lit(i).alias("row_number"), F.lit(label).alias("label"), v.alias("n")) for i, (label, v) in enumerate(values)])
    path = F.concat(F.lit("m/2026/2026_"), F.lpad((col("f") + 1).cast("string"), 2, "0"), F.lit("_01.pdf"))
    x = x.select("f", path.alias("path"), F.inline(rows)).where("NOT (f % 4 = 3 AND label = 'C + D')")
    return x.select("path", "row_number", F.array("label", F.translate(F.format_number("n", 0), ",", "."), F.lit("-9,23")).alias("cells"))


@query("q25_normalize_registrations", "SELECT * FROM listed", CELLS_CTE)
def q25(t):
    return normalize_registrations(raw_cells(t)).select("path", "reference_period", "segment_code", "mes_atual")


@query("a13_missing_codes", "SELECT path, 5 AS place, 'caminhoes_onibus' AS segment_code FROM months WHERE f % 4 = 3", CELLS_CTE)
def a13(t):
    return missing_codes(normalize_registrations(raw_cells(t)))


NAMED_CTE = f"""
al AS (SELECT trim(regexp_replace(lower(strip_accents(label)), '[^a-z0-9+]+', ' ', 'g')) AS alias, code FROM (VALUES {', '.join(f"('{label}', '{c}')" for c, _, labels in SEGMENTS for label in labels)}) v(label, code) GROUP BY ALL),
parts AS (SELECT p_partkey, p_partkey % 22 AS r, p_name FROM part)
"""
#: First cells for the parts: labels, labels that run on, and what no segment begins with.
FIRST_CELLS = ("A+B", "A + B", "Totalizador", "C+D", "Motos", "Com. Leves x", "  d) ônibus", "Outro", "", "x", "Subtotal geral")


@query(
    "f40_segment_of",
    """SELECT p_partkey, segment_code FROM (SELECT p_partkey, coalesce((SELECT max_by(code, length(alias)) FROM al WHERE starts_with(f, alias)), (SELECT max_by(code, length(alias)) FROM al WHERE starts_with(w || ' ', alias || ' '))) AS segment_code FROM
  (SELECT p_partkey, trim(regexp_replace(lower(strip_accents(a)), '[^a-z0-9+]+', ' ', 'g')) AS f, trim(regexp_replace(lower(strip_accents(a || ' ' || b || ' ' || p_name)), '[^a-z0-9+]+', ' ', 'g')) AS w FROM
   (SELECT p_partkey, p_name, [{first}][r % 11 + 1] AS a, CASE WHEN r < 11 THEN 'Outros' ELSE 'Autos' END AS b FROM parts))) WHERE segment_code IS NOT NULL""".format(first=", ".join(f"'{x}'" for x in FIRST_CELLS)),
    NAMED_CTE,
)
def f40(t):
    """Segments of rows whose first cell is a label, runs on, or is none: the row's other cells decide then."""
    k = col("p_partkey") % 22
    first = F.element_at(F.array(*map(F.lit, FIRST_CELLS)), (k % 11 + 1).cast("int"))
    rows = t.raw("part").select("p_partkey", F.array(first, F.when(k < 11, "Outros").otherwise("Autos"), "p_name").alias("cells"))
    return segment_of(rows).select("p_partkey", "segment_code")


@query(
    "q26_registration_sum_checks",
    "SELECT path, check_name, found, expected, found - expected AS difference, coalesce(found = expected, false) AS passed, CASE WHEN expected IS NULL THEN 'warning' ELSE 'error' END AS severity FROM checked",
    CELLS_CTE,
)
def q26(t):
    return sum_checks(normalize_registrations(raw_cells(t)), ["path"], "segment_code", "mes_atual", CHECKS).drop("note")


@query("s16_file_status", "SELECT path, CASE WHEN bool_or(expected IS NOT NULL AND found <> expected) THEN 'failed' ELSE 'validated' END AS extraction_status FROM checked GROUP BY 1", CELLS_CTE)
def s16(t):
    return file_status(sum_checks(normalize_registrations(raw_cells(t)), ["path"], "segment_code", "mes_atual", CHECKS), ["path"])


@query(
    "q26_series_sum_checks",
    """SELECT reference_period, sum(mes_atual) FILTER (segment_code NOT IN ('total', 'economy_anodized_brass'))::BIGINT AS found, sum(mes_atual) FILTER (segment_code = 'total')::BIGINT AS expected,
  coalesce(sum(mes_atual) FILTER (segment_code NOT IN ('total', 'economy_anodized_brass')) = sum(mes_atual) FILTER (segment_code = 'total'), false) AS passed FROM registrations GROUP BY 1""",
)
def q26b(t):
    """The monthly totals against all part types but one: months in which that one sold do not pass."""
    r = t.registrations.where("segment_code <> 'economy_anodized_brass'").withColumn("side", F.when(col("segment_code") == "total", "total").otherwise("part"))
    return sum_checks(r, ["reference_period"], "side", "mes_atual", {"all": (("part",), "total")}).select("reference_period", F.nullif(col("found"), F.lit(0)).alias("found"), "expected", "passed")


SERIES_CTE = """
series AS (SELECT *, (sum(mes_atual) OVER (PARTITION BY segment_code, year(reference_period) ORDER BY reference_period ROWS UNBOUNDED PRECEDING))::BIGINT AS ytd,
   lag(mes_atual) OVER w AS lag_1, lag(mes_atual, 12) OVER w AS lag_12 FROM registrations WINDOW w AS (PARTITION BY segment_code ORDER BY reference_period)),
pct AS (SELECT *, CASE WHEN lag_1 <> 0 THEN round((mes_atual - lag_1)::DECIMAL(38,10) * 100 / lag_1, 2)::DOUBLE END AS mom_pct, CASE WHEN lag_12 <> 0 THEN round((mes_atual - lag_12)::DECIMAL(38,10) * 100 / lag_12, 2)::DOUBLE END AS yoy_pct FROM series)
"""


def registration_summary(t: Tables, calendar_safe: bool = False) -> DataFrame:
    x = series_change(t.registrations, "segment_code", "reference_period", "mes_atual", calendar_safe=calendar_safe)
    return x.withColumn("mom_pct", M.change_pct(col("mes_atual"), col("lag_1"))).withColumn("yoy_pct", M.change_pct(col("mes_atual"), col("lag_12")))


@query("q27_registration_summary", "SELECT reference_period, segment_code, segmento, mes_atual, ytd, lag_1, lag_12, mom_pct, yoy_pct FROM pct", SERIES_CTE)
def q27(t):
    return registration_summary(t).select("reference_period", "segment_code", "segmento", "mes_atual", "ytd", "lag_1", "lag_12", "mom_pct", "yoy_pct")


@query(
    "q27_registration_summary_calendar",
    "SELECT a.reference_period, a.segment_code, a.mes_atual, b.mes_atual AS lag_1, c.mes_atual AS lag_12 FROM registrations a LEFT JOIN registrations b ON b.segment_code = a.segment_code AND b.reference_period = a.reference_period - INTERVAL 1 MONTH LEFT JOIN registrations c ON c.segment_code = a.segment_code AND c.reference_period = a.reference_period - INTERVAL 12 MONTH",
)
def q27b(t):
    return registration_summary(t, True).select("reference_period", "segment_code", "mes_atual", "lag_1", "lag_12")


@query(
    "q46_monthly_segments",
    "SELECT segment_code, max(reference_period) AS last_month, max_by(mes_atual, reference_period) AS units, max_by(ytd, reference_period) AS ytd, count(*) AS months FROM pct WHERE segment_code <> 'total' GROUP BY 1",
    SERIES_CTE,
)
def q46(t):
    by = lambda c, n: F.max_by(c, "reference_period").alias(n)
    x = registration_summary(t).where("segment_code <> 'total'").groupBy("segment_code")
    return x.agg(F.max("reference_period").alias("last_month"), by("mes_atual", "units"), by("ytd", "ytd"), F.count("*").alias("months"))


@query(
    "q47_market_fact_pack",
    """SELECT p.reference_period, p.mes_atual AS total, p.lag_1 AS previous, p.mom_pct, p.ytd, abs(p.mom_pct) > 10 AS large_move,
  (SELECT list(segment_code ORDER BY mes_atual DESC, segment_code) FROM (FROM pct s WHERE s.segment_code <> 'total' AND s.reference_period = p.reference_period ORDER BY mes_atual DESC, segment_code LIMIT 3)) AS top_segments
  FROM pct p WHERE segment_code = 'total' AND p.reference_period = (SELECT max(reference_period) FROM registrations)""",
    SERIES_CTE,
)
def q47(t, top: int = 3, large: float = 10.0):
    """One nested row of facts for the latest month."""
    x = registration_summary(t)
    last = x.agg(F.max("reference_period").alias("reference_period"))
    rows = x.join(F.broadcast(last), "reference_period")  # one month
    segments = rows.where("segment_code <> 'total'").orderBy(col("mes_atual").desc(), "segment_code").limit(top)
    names = segments.agg(F.transform(F.sort_array(F.collect_list(F.struct((-col("mes_atual")).alias("m"), "segment_code"))), lambda s: s["segment_code"]).alias("top_segments"))
    total = rows.where("segment_code = 'total'").select("reference_period", col("mes_atual").alias("total"), col("lag_1").alias("previous"), "mom_pct", "ytd", (F.abs("mom_pct") > large).alias("large_move"))
    return total.crossJoin(names)  # one row each


@query(
    "q49_market_source_trace",
    "SELECT n_name AS source_name, s_suppkey AS file_id, date_trunc('month', min(l_shipdate))::DATE AS first_period, count(*) AS rows FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2",
)
def q49(t):
    files = t.raw("lineitem").groupBy(col("l_suppkey").alias("file_id")).agg(F.trunc(F.min("l_shipdate"), "month").alias("first_period"), F.count("*").alias("rows"))
    sources = t.raw("supplier").join(t.raw("nation"), col("s_nationkey") == col("n_nationkey"))
    return files.join(sources, col("file_id") == col("s_suppkey")).select(col("n_name").alias("source_name"), "file_id", "first_period", "rows")


@query(
    "q58_brand_attention_vs_market",
    """SELECT brand, coalesce(mentions, 0) AS mentions, units FROM (SELECT p_brand AS brand, sum(l_quantity::BIGINT)::BIGINT AS units FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
  LEFT JOIN (SELECT brand, count(*) AS mentions FROM (SELECT DISTINCT o_orderkey, p_brand AS brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderpriority = '1-URGENT') GROUP BY 1) USING (brand)""",
)
def q58(t):
    """Units of each brand beside the short posts whose items name it (posts have no free titles here)."""
    items = t.raw("lineitem").join(t.raw("part").select("p_partkey", col("p_brand").alias("brand")), col("l_partkey") == col("p_partkey"))
    units = items.groupBy("brand").agg(F.sum(col("l_quantity").cast("long")).alias("units"))
    urgent = t.raw("orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    named = items.join(urgent, col("l_orderkey") == col("o_orderkey")).select("o_orderkey", "brand").distinct().groupBy("brand").agg(F.count("*").alias("mentions"))
    return units.join(named, "brand", "left").select("brand", M.or0(col("mentions")).alias("mentions"), "units")


@query("q52_layer_quality", "SELECT count(*) AS rows, count(DISTINCT p_name) AS names, count(*) - count(DISTINCT (p_name, p_brand, p_type)) AS duplicates, count(*) FILTER (contains(p_type, 'STEEL')) AS steel FROM part")
def q52(t):
    p = t.raw("part")
    return p.agg(F.count("*").alias("rows"), F.count_distinct("p_name").alias("names"), (F.count("*") - F.count_distinct("p_name", "p_brand", "p_type")).alias("duplicates"), F.count_if(col("p_type").contains("STEEL")).alias("steel"))


@query("f33_normalize_key", r"SELECT doc_id, trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9+]+', ' ', 'g')) AS k FROM documents")
def f33(t):
    return t.raw("documents").select("doc_id", normalize_key(col("text")).alias("k"))
