"""Layered jobs that go on where they stopped, and appends that count once, both by a commit log beside the data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.ledger import Ledger

col = F.col


class ResumableJob:
    """Work over numbered rows, chunk by chunk. A chunk's result is written first and its last completed index committed after it.

    A row that meets the stop condition ends the run: rows before it in its chunk are complete, it and what follows are not, and
    the next run begins with it. What a killed run has written without a commit is written again.
    """

    def __init__(self, spark: SparkSession, path: str, index: str, schema: str):
        self.spark, self.path, self.index, self.schema = spark, path.rstrip("/"), index, schema
        self.log = Ledger(spark, f"{self.path}/_log")

    def next_index(self) -> int:
        last = self.log.last()
        return 0 if last < 0 else self.log.read(last)["last_completed_index"] + 1

    def run(self, items: DataFrame, work: Callable[[DataFrame], DataFrame], chunk: int, stop: Column | None = None) -> dict:
        """Process what is left; the last commit: status (ok, stopped, or complete where nothing was left), last_completed_index, next_row_index and, where it stopped, failed_row_index."""
        end = items.agg(F.max(self.index)).first()[0]
        start, said = self.next_index(), None
        while end is not None and start <= end:
            number, until = self.log.last() + 1, min(start + chunk - 1, end)
            folder = f"{self.path}/chunk={number}"
            work(items.where(col(self.index).between(start, until))).write.mode("overwrite").parquet(folder)
            failed = self.spark.read.schema(self.schema).parquet(folder).where(stop).agg(F.min(self.index)).first()[0] if stop is not None else None
            last = until if failed is None else failed - 1
            said = {"status": "ok" if failed is None else "stopped", "last_completed_index": last, "next_row_index": last + 1} | ({} if failed is None else {"failed_row_index": failed})
            self.log.commit(number, said)
            if failed is not None:
                return said
            start = until + 1
        return said or {"status": "complete", "last_completed_index": start - 1, "next_row_index": start}

    def result(self) -> DataFrame:
        """Rows of completed indices, with the chunk that made them."""
        done = [(n, self.log.read(n)["last_completed_index"]) for n in range(self.log.last() + 1)]
        if not done:
            return self.spark.createDataFrame([], f"{self.schema}, chunk int")
        rows = self.spark.read.schema(f"{self.schema}, chunk int").option("basePath", self.path).parquet(*[f"{self.path}/chunk={n}" for n, _ in done])
        ends = F.broadcast(self.spark.createDataFrame(done, "chunk int, __last long"))  # a row a chunk
        return rows.join(ends, "chunk").where(col(self.index) <= col("__last")).select(*rows.columns)


class BatchHistory:
    """An append-only history under path: rows/batch=<n>/d=<day>. A batch counts when it is committed, and it is committed once."""

    def __init__(self, spark: SparkSession, path: str, schema: str, time: str = "collected_at"):
        self.spark, self.path, self.schema, self.time = spark, path.rstrip("/"), schema, time
        self.log = Ledger(spark, f"{self.path}/_log")

    def append(self, rows: DataFrame, batch_id: int) -> list[str]:
        """The days that the batch touched; none if it had been appended before. A batch that was not finished is overwritten."""
        if self.log.has(batch_id):
            return []
        folder = f"{self.path}/rows/batch={batch_id}"
        own = [c.split()[0] for c in self.schema.split(", ")]
        out = rows.select(*own, col(self.time).cast("date").alias("d"))
        out.hint("rebalance", col("d")).write.mode("overwrite").partitionBy("d").parquet(folder)
        days = sorted(str(r.d) for r in out.select("d").distinct().collect())  # a batch's days
        self.log.commit(batch_id, {"days": days})
        return days

    def read(self) -> DataFrame:
        """All committed rows, with d, which prunes days."""
        last = self.log.last()
        if last < 0:
            return self.spark.createDataFrame([], f"{self.schema}, d date")
        rows = self.spark.read.schema(f"{self.schema}, batch int, d date").parquet(f"{self.path}/rows")
        gaps = [n for n in range(last) if not self.log.has(n)]  # numbers of a stream have none
        rows = rows.where(col("batch") <= last)
        return (rows.where(~col("batch").isin(*gaps)) if gaps else rows).drop("batch")


class TrailingWindows:
    """First and last snapshot and number of snapshots of each post and day, kept beside a BatchHistory; reports read days, and the history only for the two days that a window cuts."""

    def __init__(self, history: BatchHistory, path: str, values: tuple[str, ...] = ("views", "likes", "comments")):
        self.history, self.path, self.values = history, path.rstrip("/"), values

    def _row(self) -> Column:
        return F.struct("collected_at", "id", *self.values)

    def _daily(self, rows: DataFrame, *more: str) -> DataFrame:
        return rows.groupBy("post_id", *more).agg(F.count("*").alias("checks"), F.min(self._row()).alias("first"), F.max(self._row()).alias("last"))

    def refresh(self, days: list[str]) -> None:
        """Make the given days anew; other days' files stay as they are."""
        if days:
            touched = self.history.read().where(col("d").isin(*[F.lit(x).cast("date") for x in days]))
            self._daily(touched, "d").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(self.path)

    def report(self, as_of: str, hours: int) -> DataFrame:
        """(post_id, checks, growth of each value, from the first to the last snapshot) over [as_of - hours, as_of]."""
        until = F.lit(as_of).cast("timestamp_ntz")
        since = until - F.make_interval(hours=F.lit(hours))
        first, last = since.cast("date"), until.cast("date")
        days = self.history.spark.read.parquet(self.path)
        whole = days.where((col("d") > first) & (col("d") < last)).select("post_id", "checks", "first", "last")
        edge = self.history.read().where(((col("d") == first) | (col("d") == last)) & col("collected_at").between(since, until))
        both = whole.unionByName(self._daily(edge)).groupBy("post_id").agg(F.sum("checks").alias("checks"), F.min("first").alias("a"), F.max("last").alias("b"))
        return both.select("post_id", "checks", *[(col(f"b.{v}") - col(f"a.{v}")).alias(f"{v}_growth") for v in self.values])
