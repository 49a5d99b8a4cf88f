"""Longest-prefix matching without comparing every row with every alias."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

col = F.col


def longest_prefix(df: DataFrame, key: str, aliases: DataFrame, alias: str, value: str, out: str, literal: int = 1000) -> DataFrame:
    """df with out: value of the longest alias that key begins with; null if none does. Aliases are distinct.

    Only prefixes of the lengths that aliases have can match. Up to `literal` aliases are a map in the plan, in which they are
    looked up, longest first: no join. More aliases are joined with the prefixes by equality, and the longest of a key's hits
    counts; keys go through that join once, whatever the number of rows that share them.
    """
    known = aliases.where(col(alias).isNotNull() & (col(alias) != ""))
    sizes = sorted((r[0] for r in known.select(F.length(alias)).distinct().collect()), reverse=True)  # lengths, not aliases
    few = known.select(alias, value).limit(literal + 1).collect()
    if not few:
        return df.withColumn(out, F.lit(None).cast(aliases.schema[value].dataType))
    prefix = lambda k, n: F.when(F.length(k) >= n, F.substring(k, 1, n))
    if len(few) <= literal:
        table = F.create_map(*[F.lit(x) for row in few for x in row])
        found = F.transform(F.array(key), lambda k: F.coalesce(*[F.try_element_at(table, prefix(k, n)) for n in sizes]))  # key is made once
        return df.withColumn(out, F.element_at(found, 1))
    keys = df.select(key).where(col(key).isNotNull()).distinct()
    cut = keys.select(key, F.explode(F.filter(F.array(*[prefix(col(key), n) for n in sizes]), lambda p: p.isNotNull())).alias("__p"))
    hits = cut.join(known.select(col(alias).alias("__p"), col(value).alias(out)), "__p")
    best = hits.groupBy(key).agg(F.max_by(out, F.length("__p")).alias(out))
    return df.join(best, key, "left").select(*df.columns, out)
