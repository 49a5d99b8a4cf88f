"""Reusable relational operators of the snapshot jobs. Every order they rank by is total, every time is a parameter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, lags: dict[str, Column], values: Sequence[str], tie: str) -> DataFrame:
    """left with a struct column for each lag: the right row with the latest time at or before left_time - lag (null if none).

    One equi-join and one partially aggregated pass for all lags: no window, no sort of a key's history.
    """
    side = right.select(F.col(on), F.col(right_time).alias("__t"), F.col(tie).alias("__tie"), *[F.col(v).alias(f"__{v}") for v in values])
    wide = left.select(on, left_time).join(side, on)
    picked = []
    for name, lag in lags.items():
        ok = F.col("__t") <= F.col(left_time) - lag
        row = F.struct(F.col("__t").alias(right_time), *[F.col(f"__{v}").alias(v) for v in values])
        picked.append(F.max_by(F.when(ok, row), F.when(ok, F.struct("__t", "__tie"))).alias(name))
    found = wide.groupBy(on).agg(*picked)
    return left.join(found, on, "left")


def topk(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int | Column, rank: str = "rank") -> DataFrame:
    """First k rows of each group, numbered from 1; a group is never sorted beyond k rows a task (window group limit)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_rows(df: DataFrame, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows of all, numbered from 1. Only these n rows meet in one task."""
    return df.orderBy(*order).limit(n).withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def quota_batch(
    df: DataFrame,
    key: str,
    band: str,
    quotas: dict[int, int],
    total: int,
    band_order: Sequence[Column],
    refill_order: Sequence[Column],
    guardrail: tuple[Column, Sequence[Column], int] | None = None,
) -> DataFrame:
    """A batch of total rows: a guardrail slice (0), quotas of each band (1), then a refill by one order (2), in slice_order.

    guardrail: (condition, order, n); rows that meet the condition are in no other slice. Each slice is at most total rows,
    so the slices are small whatever df is.
    """
    spark = df.sparkSession
    parts = []
    normal = df
    if guardrail:
        condition, order, n = guardrail
        parts.append(first_rows(df.where(condition), order, n).drop("rank").withColumn("slice_order", F.lit(0)))
        normal = df.where(~condition)
    quota = spark.createDataFrame(sorted(quotas.items()), f"{band} int, quota int")
    ranked = topk(normal, [band], band_order, max(quotas.values()))
    primary = ranked.join(F.broadcast(quota), band).where("rank <= quota").drop("rank", "quota").withColumn("slice_order", F.lit(1))
    parts.append(primary.select(*df.columns, "slice_order"))
    # the refill is among the first 2 * total rows of the refill order, as at most total of them are taken already
    rest = normal.orderBy(*refill_order).limit(2 * total).join(primary.select(key), key, "left_anti")
    taken = reduce(DataFrame.unionByName, parts)
    room = taken.agg(F.greatest(F.lit(total) - F.count("*"), F.lit(0)).alias("room"))
    refill = first_rows(rest, refill_order, total).crossJoin(F.broadcast(room)).where("rank <= room")  # room: one row
    return taken.unionByName(refill.select(*df.columns, F.lit(2).alias("slice_order")))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "first") -> DataFrame:
    """One row for each key: the first or last of a total order, by one partially aggregated pass."""
    fields = [c for c in df.columns if c not in keys]
    rank = F.struct(*order)
    pick = (F.min_by if keep == "first" else F.max_by)(F.struct(*fields), rank)
    return df.groupBy(*keys).agg(pick.alias("__row")).select(*keys, "__row.*").select(*df.columns)


def dedupe_best(df: DataFrame, keys: Sequence[str], score: Column, position: Column) -> DataFrame:
    """The row of the highest score for each key, the first position of ties."""
    return dedupe(df, keys, [score, -position], keep="last")


def dedupe_last_at_first(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The last row of each key, at the position of its first, by one partially aggregated pass."""
    fields = [c for c in df.columns if c not in keys and c != position]
    both = df.groupBy(*keys).agg(F.max_by(F.struct(*fields), F.col(position)).alias("__row"), F.min(position).alias(position))
    return both.select(*keys, position, "__row.*").select(*df.columns)


def endpoints(df: DataFrame, key: str, time: str, tie: str, cols: Sequence[str], start: Column) -> DataFrame:
    """first_* and latest_* of each key since start, for keys with two different times."""
    rows = df.where(F.col(time) >= start)
    row, order = F.struct(time, *cols), F.struct(time, tie)
    both = rows.groupBy(key).agg(F.min_by(row, order).alias("a"), F.max_by(row, order).alias("b"))
    out = [F.col(f"a.{c}").alias(f"first_{c}") for c in (time, *cols)] + [F.col(f"b.{c}").alias(f"latest_{c}") for c in (time, *cols)]
    return both.select(key, *out).where(F.col(f"latest_{time}") > F.col(f"first_{time}"))


def missing(requested: DataFrame, returned: DataFrame, key: str, position: str | None = None) -> DataFrame:
    """Distinct requested keys that did not come back, nulls dropped; with a position: in the order of their first request."""
    asked = requested.where(F.col(key).isNotNull())
    asked = asked.select(key).distinct() if position is None else asked.groupBy(key).agg(F.min(position).alias(position))
    return asked.join(returned.select(key), key, "left_anti")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of either side with side: both, left_only or right_only. Columns get the suffixes _a and _b."""
    left = a.select(F.col(key), *[F.col(c).alias(f"{c}_a") for c in a.columns if c != key], F.lit(True).alias("__a"))
    right = b.select(F.col(key), *[F.col(c).alias(f"{c}_b") for c in b.columns if c != key], F.lit(True).alias("__b"))
    side = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "left_only").otherwise("right_only")
    return left.join(right, key, "full").withColumn("side", side).drop("__a", "__b")


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti").select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source.select(*target.columns))


def merge_with(target: DataFrame, source: DataFrame, keys: Sequence[str], update: dict[str, Column], insert: dict[str, Column]) -> DataFrame:
    """Insert or update by key; expressions see the target row as t.* and the source row as s.*. Columns that are not named stay, or are null."""
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = source.withColumn("__s", F.lit(True)).alias("s")
    on = reduce(lambda x, y: x & y, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    cols = []
    for c in target.columns:
        old = F.col(f"t.{c}")
        new = F.col(f"s.{c}") if c in keys else insert.get(c, F.lit(None))
        value = F.when(F.col("t.__t").isNull(), new).when(F.col("s.__s").isNull() if c in update else F.lit(True), old)
        cols.append((value.otherwise(update[c]) if c in update else value).cast(target.schema[c].dataType).alias(c))
    return t.join(s, on, "full").select(*cols)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], sets: dict[str, Column]) -> DataFrame:
    """target with columns set where source has the key (at most once); expressions see t.* and s.*."""
    t, s = target.alias("t"), source.withColumn("__s", F.lit(True)).alias("s")
    on = reduce(lambda x, y: x & y, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    hit = F.col("s.__s").isNotNull()
    cols = [F.when(hit, sets[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in sets else F.col(f"t.{c}") for c in target.columns]
    return t.join(s, on, "left").select(*cols)


def delete_where(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(doomed.select(*keys), list(keys), "left_anti")


def period_filter(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows from the first moment of start to the last of end: half-open, ts < end + 1 day."""
    day = lambda d: F.lit(d).cast("date")
    return df.where((F.col(column) >= day(start)) & (F.col(column) < F.date_add(day(end), 1)))


def strike_state(attempts: DataFrame, key: str, order: Sequence[str], missed: str, time: str, limit: int = 3) -> DataFrame:
    """State of each key after an ordered run of attempts, as the fold of the collection rule gives it.

    failure_count: misses since the last return; a key that never missed has no row. first_failed_at is the first miss of all.
    One partially aggregated pass: the last return's place splits the misses.
    """
    last_hit = attempts.where(~F.col(missed)).groupBy(key).agg(F.max(F.struct(*order)).alias("__hit"), F.max_by(time, F.struct(*order)).alias("last_success_at"))
    misses = attempts.where(F.col(missed)).join(last_hit.select(key, "__hit"), key, "left")
    first_miss = misses.groupBy(key).agg(
        F.min_by(time, F.struct(*order)).alias("first_failed_at"),
        F.max_by(time, F.struct(*order)).alias("last_failed_at"),
        F.min(F.struct(*order)).alias("__miss"),
        F.count_if(F.col("__hit").isNull() | (F.struct(*order) > F.col("__hit"))).alias("failure_count"),
    )
    out = first_miss.join(last_hit, key, "left")
    status = F.when(F.col("failure_count") >= limit, "unavailable").when(F.col("failure_count") > 0, "unavailable_candidate").otherwise("recovered")
    success = F.when(F.col("__hit") > F.col("__miss"), F.col("last_success_at"))  # a return counts only for a key that is known as missed
    return out.select(key, F.col("failure_count"), "first_failed_at", "last_failed_at", success.alias("last_success_at"), status.alias("status"))


def series_change(df: DataFrame, key: str, period: str, value: str, lags: Sequence[int] = (1, 12), calendar_safe: bool = False) -> DataFrame:
    """df with ytd and lag_n of each key's monthly series; lags go by position, or by calendar month if calendar_safe."""
    w = Window.partitionBy(key).orderBy(period)
    year = Window.partitionBy(key, F.year(period)).orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn("ytd", F.sum(value).over(year))
    for n in lags:
        if calendar_safe:
            past = df.select(F.col(key), F.add_months(period, n).alias(period), F.col(value).alias(f"lag_{n}"))
            out = out.join(past, [key, period], "left")
        else:
            out = out.withColumn(f"lag_{n}", F.lag(value, n).over(w))
    return out


def sum_checks(df: DataFrame, by: Sequence[str], code: str, value: str, specs: dict[str, tuple[Sequence[str], str]]) -> DataFrame:
    """For each group and check (name -> (addends, total)): found, expected, difference, passed, severity, note. A missing total is a warning."""
    codes = sorted({c for parts, total in specs.values() for c in (*parts, total)})
    wide = df.groupBy(*by).agg(*[F.sum(F.when(F.col(code) == c, F.col(value))).alias(f"v_{i}") for i, c in enumerate(codes)])
    at = {c: F.col(f"v_{i}") for i, c in enumerate(codes)}
    rows = []
    for name, (parts, total) in specs.items():
        found = reduce(lambda x, y: x + y, [F.coalesce(at[c], F.lit(0)) for c in parts])
        ok = (found == at[total]) & at[total].isNotNull()
        rows.append(
            F.struct(
                F.lit(name).alias("check_name"),
                found.alias("found"),
                at[total].alias("expected"),
                (found - at[total]).alias("difference"),
                F.coalesce(ok, F.lit(False)).alias("passed"),
                F.when(at[total].isNull(), "warning").otherwise("error").alias("severity"),
                F.when(at[total].isNull(), F.concat(F.lit("missing row: "), F.lit(total))).alias("note"),
            )
        )
    return wide.select(*by, F.inline(F.array(*rows)))
