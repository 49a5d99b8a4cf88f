"""Names, numbers, URLs and labels, as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with marks of the Latin blocks and what is left without the marks, by rule: canonical decomposition.
_MARKED = [c for c in map(chr, range(0xC0, 0x250)) if len(unicodedata.normalize("NFKD", c)) > 1 and not unicodedata.combining(unicodedata.normalize("NFKD", c)[0])]
_BARE = [unicodedata.normalize("NFKD", c)[0] for c in _MARKED]


def strip_accents(x: Column) -> Column:
    """Latin letters without their marks, JVM-side; combining marks that stand alone go too."""
    return F.regexp_replace(F.translate(x, "".join(_MARKED), "".join(_BARE)), "\\p{Mn}+", "")


def normalized_name(x: Column) -> Column:
    return F.lower(F.trim(strip_accents(x)))


def normalize_text(x: Column) -> Column:
    """Null as empty; white space, line ends and no-break spaces as one space; trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), "[\\s\\u00a0]+", " "))


def normalize_key(x: Column) -> Column:
    """Letters, digits and plus signs of the lower-cased bare text, others as one space."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(F.coalesce(x, F.lit("")))), "[^a-z0-9+]+", " "))


def normalize_label(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.lower(F.coalesce(x, F.lit(""))), "áàâãéêíóôõúç", "aaaaeeiooouc"), "\\s+", " "))


def safe_filename(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, "[^A-Za-z0-9_-]+", "_"), "^_+|_+$", "")


#: Numbers in Brazilian form (fixed value).
BR_NUMBER = r"-?\d{1,3}(?:\.\d{3})*(?:,\d+)?|-?\d+,\d+|-?\d+"


def br_numbers(cells: Column) -> Column:
    """All numbers of an array of cells, in order. An ungrouped number falls into groups of three, as the fixed pattern has it."""
    return F.regexp_extract_all(F.array_join(cells, " "), F.lit(f"({BR_NUMBER})"), 1)


def first_volume(numbers: Column) -> Column:
    """First number that is neither a decimal nor negative."""
    return F.get(F.filter(numbers, lambda n: ~n.contains(",") & ~n.startswith("-")), 0)


def parse_int_br(x: Column) -> Column:
    """187.313 is 187313; decimals are cut; dashes and empty texts are null, and so are other texts, of which int_error() tells."""
    return F.split(F.translate(normalize_text(x), ". ", ""), ",")[0].try_cast("long")


def int_error(x: Column) -> Column:
    """Why parse_int_br(x) has no number; null if it has one or x holds none."""
    return F.when(~normalize_text(x).isin("", "-", "--") & parse_int_br(x).isNull(), F.concat(F.lit("not a whole number: "), x))


def parse_decimal_br(x: Column) -> Column:
    return F.translate(F.trim(x), ",.%", ".").try_cast("double")


def _period(path: Column) -> tuple[Column, Column]:
    name, narrow, wide = F.element_at(F.split(path, "/"), -1), "(20\\d{2})[_-](\\d{2})", "(20\\d{2})[^\\d]+(\\d{2})"
    in_name = F.regexp_extract(name, narrow, 1) != ""
    return tuple(F.when(in_name, F.regexp_extract(name, narrow, k)).otherwise(F.regexp_extract(path, wide, k)).try_cast("int") for k in (1, 2))


def reference_period(path: Column) -> Column:
    """First day of the month: 20yy_mm or 20yy-mm in the file name, else 20yy and mm with no digit between them in the path. Null where period_error() tells why."""
    year, month = _period(path)
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


def period_error(path: Column) -> Column:
    """Why a path has no period: none is in it, or its month is none; null if it has one."""
    year, month = _period(path)
    return F.when(year.isNull(), "no period in the path").when(~month.between(1, 12), F.concat(F.lit("invalid month: "), month.cast("string")))


def year_of(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x, "\\b((?:19|20)\\d{2})\\b", 1), F.lit(""))


def query_param(url: Column, key: str) -> Column:
    """First value of a query key (any case of the key), decoded; null if it is absent."""
    raw = F.regexp_extract(url, f"(?i)[?&]{key}=([^&#]*)", 1)
    return F.when(url.rlike(f"(?i)[?&]{key}="), F.try_url_decode(raw))


def host_of(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)?([^?#]*)", 1)


def resolve_link(base: Column, href: Column) -> Column:
    """href against base: absolute, scheme-relative, root-relative, query-only, fragment or relative; backslashes count as slashes."""
    h = F.trim(F.translate(href, "\\", "/"))
    root = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    page = F.regexp_extract(base, "^([^?#]*)", 1)
    folder = F.when(F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/.*)?$", 1) == "", F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    return (
        F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), h))
        .when(h.startswith("/"), F.concat(root, h))
        .when(h.startswith("?"), F.concat(page, h))
        .when(h.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), h))
        .when(h == "", base)
        .otherwise(F.concat(folder, F.regexp_replace(h, "^\\./", "")))
    )


def build_query(base: Column, params: dict[str, Column]) -> Column:
    parts = [F.concat(F.lit(f"{k}="), F.url_encode(v)) for k, v in params.items()]
    return F.concat(base, F.lit("?"), F.concat_ws("&", *parts))


#: Query keys that hold a page number, in order; keys that tell catalogues apart (fixed values).
PAGE_KEYS = ("curpage", "pagina", "page", "pag", "pg")
CATALOG_KEYS = ("fabricante", "varnome", "modelo", "anoini", "anofim", "ano", "codmodelo", "codigo")


def page_number(url: Column) -> Column:
    """First digits of the first page key that has any; else 1."""
    return F.coalesce(*[F.regexp_extract(query_param(url, k), "\\d+", 0).try_cast("int") for k in PAGE_KEYS], F.lit(1))


def same_catalog_signature(candidate: Column, seed: Column) -> Column:
    """Every catalogue key that both have agrees, compared as labels; a key that one of them lacks decides nothing."""
    out = F.lit(True)
    for k in CATALOG_KEYS:
        x, y = query_param(candidate, k), query_param(seed, k)
        out = out & (x.isNull() | y.isNull() | (x == "") | (y == "") | (normalize_label(x) == normalize_label(y)))
    return F.coalesce(out, F.lit(False))


def is_error_url(url: Column) -> Column:
    return F.lower(path_of(url)).endswith("/erro.asp")


def safe_int(x: Column) -> Column:
    return x.try_cast("long")


def iso_timestamp(x: Column) -> Column:
    """ISO text with or without a zone, as time without zone in UTC; null on errors."""
    zoned = F.when(x.rlike("(?:[Zz]|[+-]\\d{2}:?\\d{2})$"), x).otherwise(F.concat(x, F.lit("Z")))
    return F.to_utc_timestamp(zoned.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")


def is_group_header(x: Column) -> Column:
    """A title of a group of fields: no digit, 40 characters at most, mostly letters, all upper case."""
    letters = F.length(F.regexp_replace(x, "[^\\p{L}]", ""))
    return (F.length(x) > 0) & ~x.rlike("\\d") & (F.length(x) <= 40) & (letters >= 0.6 * F.length(x)) & (x == F.upper(x))

