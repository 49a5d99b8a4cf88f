"""Order statistics and positions without one task that holds a whole group or table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.materialize import create_table_as
from tidemark.sources.ledger import Ledger

col = F.col


def small(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """A broadcast hint where a count shows at most so many narrow rows; beyond that a shuffled join stays."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that are equal or both null; the keys of a stay."""
    named = b.select(*[col(c).alias(f"__b_{c}") if c in keys else col(c) for c in b.columns])
    on = reduce(lambda x, y: x & y, [col(k).eqNullSafe(col(f"__b_{k}")) for k in keys], F.lit(True))
    return a.join(small(named), on).drop(*[f"__b_{k}" for k in keys])


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, shares: dict[str, float], most: int = 1_000_000, cuts: int = 32) -> DataFrame:
    """by and, for each name of shares, the continuous percentile of value in its group, exactly; nulls do not count.

    The two values of a percentile are sought by rank. A mergeable sketch cuts the range that holds a rank into `cuts`
    pieces, exact counts of the pieces choose one, and so on until at most `most` rows, or copies of one value, are left;
    only these are sorted. Every pass is a partial aggregate, whatever the size of a group.
    """
    keys = [*by, "__name", "__side"]
    rows = create_table_as(df.where(col(value).isNotNull()).select(*by, col(value).alias("__v")), "values")
    whole = rows.groupBy(*by).agg(F.count("*").alias("inside"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    place = lambda p: (F.lit(p) * (col("inside") - 1)).alias("at")
    wanted = whole.select(*by, "inside", "lo", "hi", F.inline(F.array(*[F.struct(F.lit(n).alias("__name"), place(p)) for n, p in shares.items()])))
    side = F.explode(F.array(F.lit(0), F.lit(1))).alias("__side")
    wanted = wanted.select(*by, "__name", side, "inside", "lo", "hi", "at").withColumn("rank", F.least(F.floor("at") + col("__side"), col("inside") - 1)).withColumn("below", F.lit(0).cast("long"))
    open_ = create_table_as(wanted.select(*keys, "at", "rank", "below", "inside", "lo", "hi"), "ranks")
    large = (col("inside") > most) & (col("lo") < col("hi"))
    while not open_.where(large).isEmpty():
        big = open_.where(large)
        grid = F.percentile_approx("__v", [i / cuts for i in range(cuts + 1)], 4 * cuts)
        grids = create_table_as(_inside(rows, big, by).groupBy(*keys).agg(F.array_distinct(grid).alias("grid")), "cuts")
        x = join_same(_inside(rows, big, by).select(*keys, "__v"), grids, keys)
        piece = 2 * F.size(F.filter("grid", lambda c: c < col("__v"))) + F.array_contains("grid", col("__v")).cast("int")
        counts = x.groupBy(*keys, piece.alias("piece")).agg(F.count("*").alias("n"), F.min("__v").alias("l"), F.max("__v").alias("h"))
        w = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = create_table_as(counts.withColumn("until", F.sum("n").over(w)), "pieces")  # 2 * cuts + 1 rows of a rank
        met = join_same(counts, big.select(*keys, "at", "rank", "below"), keys).where((col("rank") < col("below") + col("until")) & (col("rank") >= col("below") + col("until") - col("n")))
        met = met.select(*keys, "at", "rank", (col("below") + col("until") - col("n")).alias("below"), col("n").alias("inside"), col("l").alias("lo"), col("h").alias("hi"))
        open_ = create_table_as(open_.where(~large).unionByName(met), "ranks")
    left = _inside(rows, open_, by).groupBy(*keys, "at", "rank", "below", "__v").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = left.withColumn("until", col("below") + F.sum("n").over(w)).where((col("rank") < col("until")) & (col("rank") >= col("until") - col("n")))
    sides = left.groupBy(*by, "__name").agg(*[F.max(F.when(col("__side") == s, col("__v").cast("double"))).alias(f"v{s}") for s in (0, 1)], F.max("at").alias("at"))
    out = sides.withColumn("x", col("v0") + (col("v1") - col("v0")) * (col("at") - F.floor("at")))
    return out.groupBy(*by).agg(*[F.max(F.when(col("__name") == n, col("x"))).alias(n) for n in shares])


def _inside(rows: DataFrame, open_: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows that lie in the range of a rank that is sought, beside it."""
    return join_same(rows, open_, by).where((col("__v") >= col("lo")) & (col("__v") <= col("hi")))


class RankedTable:
    """A table in a total order, in range partitions whose counts are known: any position is found without ranking what comes before."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, held = spark, path.rstrip("/"), Ledger(spark, f"{path.rstrip('/')}/_counts").read(0)
        self.order, self.columns, self.parts = held["order"], held["columns"], [tuple(x) for x in held["parts"]]

    @classmethod
    def write(cls, df: DataFrame, path: str, order: Sequence[str], partitions: int) -> RankedTable:
        spark, path = df.sparkSession, path.rstrip("/")
        dealt = df.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id())
        dealt.write.mode("overwrite").partitionBy("part").parquet(f"{path}/rows")
        counts = sorted(spark.read.parquet(f"{path}/rows").groupBy("part").count().collect())  # partitions at most
        log = Ledger(spark, f"{path}/_counts")
        log.remove(log.path)
        log.commit(0, {"order": list(order), "columns": df.columns, "parts": [[p, n] for p, n in counts]})
        return cls(spark, path)

    @property
    def total(self) -> int:
        return sum(n for _, n in self.parts)

    def slice(self, start: int, n: int) -> DataFrame:
        """Rows start ... start + n - 1 with `position`; only the partitions that hold them are read."""
        first, at = {}, 0
        for p, size in self.parts:
            if at < start + n and at + size > start:
                first[p] = at
            at += size
        rows = self.spark.read.parquet(f"{self.path}/rows").where(col("part").isin(*first) if first else F.lit(False))
        begin = F.element_at(F.create_map(*[F.lit(x) for pair in first.items() for x in pair]), col("part")) if first else F.lit(0)
        place = begin + F.row_number().over(Window.partitionBy("part").orderBy(*self.order)) - 1
        return rows.withColumn("position", place.cast("long")).where((col("position") >= start) & (col("position") < start + n)).select(*self.columns, "position")

    def round_robin(self, cursor: int, n: int) -> tuple[DataFrame, int]:
        """The batch at the cursor and the next cursor; a cursor past the end begins again, and the last batch leads back to 0."""
        start = 0 if cursor >= self.total else cursor
        return self.slice(start, n), 0 if start + n >= self.total else start + n
