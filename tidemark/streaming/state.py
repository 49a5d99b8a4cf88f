"""State tables that cost what a batch changes: buckets by key, a change folder a batch, merged on read, compacted by bucket."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.ledger import Ledger

col = F.col

Step = Callable[[DataFrame, DataFrame], DataFrame]


class BucketedState:
    """Rows by key under path. `_log/<batch>` names the live folders `v=<n>/bucket=<b>` of every bucket, oldest first.

    A batch reads and writes only the buckets that its keys fall into. A bucket with more than `depth` folders is rewritten
    as one; folders that neither of the last two commits names are removed. A batch that is committed is never applied again,
    and one that was not finished overwrites its own folder.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = 64, depth: int = 8):
        self.spark, self.path, self.keys, self.buckets, self.depth = spark, path.rstrip("/"), list(keys), buckets, depth
        self.schema = T.StructType.fromDDL(schema)
        self.stored = T.StructType([*self.schema.fields, T.StructField("__v", T.LongType())])
        self.log = Ledger(spark, f"{self.path}/_log")

    def live(self) -> dict[int, list[str]]:
        """Folders of each bucket that has rows."""
        last = self.log.last()
        return {} if last < 0 else {int(b): names for b, names in self.log.read(last)["live"].items()}

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _merged(self, folders: list[str]) -> DataFrame:
        """The newest row of each key in some folders."""
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.stored).parquet(*[f"{self.path}/{f}" for f in folders])
        rest = [f.name for f in self.schema.fields if f.name not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "__v").alias("x"))
        return newest.select(*[col(c) if c in self.keys else col(f"x.{c}") for c in self.schema.names])

    def rows(self) -> DataFrame:
        """The whole state."""
        return self._merged([f for names in self.live().values() for f in names])

    def _write(self, rows: DataFrame, folder: str, version: int) -> None:
        out = rows.select(*self.schema.names, F.lit(version).cast("long").alias("__v"), self._bucket().alias("bucket"))
        out.hint("rebalance", col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")

    def apply(self, batch: DataFrame, batch_id: int, step: Step) -> bool:
        """step(state rows of the batch's keys, batch) gives the new rows of these keys. False: the batch was applied before."""
        if self.log.last() >= batch_id:
            return False
        live = self.live()
        touched = sorted(r.b for r in batch.select(self._bucket().alias("b")).distinct().collect())  # buckets at most
        known = self._merged([f for b in touched for f in live.get(b, [])])
        known = known.join(batch.select(*self.keys).distinct(), self.keys, "left_semi")
        self._write(step(known, batch), f"v={2 * batch_id}", 2 * batch_id)
        for b in touched:
            live.setdefault(b, []).append(f"v={2 * batch_id}/bucket={b}")
        used = {f for names in live.values() for f in names}
        full = [b for b in touched if len(live[b]) > self.depth]
        if full:
            self._write(self._merged([f for b in full for f in live[b]]), f"v={2 * batch_id + 1}", 2 * batch_id + 1)
            live |= {b: [f"v={2 * batch_id + 1}/bucket={b}"] for b in full}
        self._commit(live, used, batch_id)
        return True

    def _commit(self, live: dict[int, list[str]], used: set[str], batch_id: int) -> None:
        last = self.log.last()
        before = self.log.read(last) if last >= 0 else {"live": {}, "gone": []}
        named = {f for names in live.values() for f in names}
        gone = sorted((used | {f for names in before["live"].values() for f in names}) - named)
        self.log.commit(batch_id, {"live": live, "gone": gone})
        for folder in before["gone"]:  # no reader that began before the last commit is left to see them
            self.log.remove(f"{self.path}/{folder}")
        self.log.forget(last)


def run_stream(stream: DataFrame, state: BucketedState, step: Step, checkpoint: str) -> DataFrame:
    """Process all that is there in micro-batches; the state after it. Can be called again with the same folders when more has come."""

    def apply(batch: DataFrame, number: int) -> None:
        state.apply(batch, number, step)

    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return state.rows()
