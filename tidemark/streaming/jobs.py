"""The continuous forms: a micro-batch runs the batch job on the state of its keys (streaming.state), or folds into keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import metrics as M
from tidemark.operators.relational import insert_absent
from tidemark.plans.entity_jobs import sync_latest
from tidemark.sources.resume import BatchHistory
from tidemark.streaming.state import BucketedState, run_stream

col = F.col


def latest_post_step(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Current post rows: the last inserted snapshot wins."""
    values = ["views", "likes", "comments"]
    known = insert_absent(state, batch.select("post_id", *[F.lit(None).cast(state.schema[c].dataType).alias(c) for c in state.columns if c != "post_id"]).distinct(), ["post_id"])
    return sync_latest(known, batch, "post_id", values, "collected_at", "id", False)


def latest_creator_step(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Current creator rows: the newest snapshot wins, a late one is ignored by the state, not by a watermark."""
    blank = batch.select("creator_id").distinct().select("creator_id", *[F.lit(None).cast(state.schema[c].dataType).alias(c) for c in state.columns if c != "creator_id"])
    return sync_latest(insert_absent(state, blank, ["creator_id"]), batch, "creator_id", ["followers"], "collected_at", "id", True)


def queue_step(posts: DataFrame, policy: M.Policy = M.POLICY) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Queue rows with a running number of checks, counted after the batch is appended; posts (post_id, post_date) tell ages."""

    def step(state: DataFrame, batch: DataFrame) -> DataFrame:
        new = batch.groupBy("post_id").agg(F.count("*").alias("n"), F.max_by(F.struct("views", "likes", "comments", "collected_at"), "id").alias("x"))
        score = M.post_priority(col("x.views"), col("x.likes"), col("x.comments"), policy)
        before = state.select("post_id", col("checks").alias("before"))
        new = new.join(posts.select("post_id", "post_date"), "post_id", "left").join(before, "post_id", "left")
        checks = F.coalesce("before", F.lit(0)) + col("n")
        new = new.select("post_id", score.alias("priority_score"), col("x.collected_at").alias("last_checked"), checks.alias("checks"), "post_date")
        return new.withColumn("next_check", M.next_check(col("priority_score"), col("last_checked"), col("post_date"), col("checks"), policy)).drop("post_date")

    return step


def enqueue_step(state: DataFrame, batch: DataFrame) -> DataFrame:
    """New posts enter once."""
    return insert_absent(state, batch.groupBy("post_id").agg(F.min("collected_at").alias("enqueued_at")), ["post_id"])


class Strikes(StatefulProcessor):
    """Failure state of a post: a value that every micro-batch's attempts are folded into, in the order of seq.

    A miss counts one up, at `limit` the post is unavailable; a return sets the count to 0, for a post that is known as
    missed. The first miss of all stays. A post that never missed has no state. Emits the state of each post that changed.
    """

    state = "failure_count long, first_failed_at timestamp_ntz, last_failed_at timestamp_ntz, last_success_at timestamp_ntz"

    def __init__(self, limit: int = 3, forget_after_ms: int | None = None):
        self.limit, self.forget_after_ms = limit, forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("strikes", self.state, self.forget_after_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.value.get()
        now = list(held) if held else None
        for r in sorted(rows, key=lambda r: r.seq):
            if r.missed:
                now = [(now[0] if now else 0) + 1, now[1] if now else r.collected_at, r.collected_at, now[3] if now else None]
            elif now:
                now = [0, now[1], now[2], r.collected_at]
        if now:
            self.value.update(tuple(now))
            status = "unavailable" if now[0] >= self.limit else "unavailable_candidate" if now[0] else "recovered"
            yield Row(post_id=key[0], failure_count=now[0], first_failed_at=now[1], last_failed_at=now[2], last_success_at=now[3], status=status)

    def close(self) -> None:
        pass


def strike_step(limit: int = 3) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The fold of Strikes as one aggregate over a micro-batch, put on top of the state rows of its posts: no call per post."""

    def step(state: DataFrame, batch: DataFrame) -> DataFrame:
        hit, miss = F.when(~col("missed"), col("seq")), F.when(col("missed"), col("seq"))
        rows = batch.withColumn("__hit", F.max(hit).over(Window.partitionBy("post_id")))
        new = rows.groupBy("post_id").agg(
            F.count(miss).alias("misses"),
            F.count_if(col("missed") & (col("__hit").isNull() | (col("seq") > col("__hit")))).alias("after"),
            F.any_value("__hit").alias("hit"),
            F.max_by("collected_at", hit).alias("hit_at"),
            F.min(miss).alias("miss"),
            F.min_by("collected_at", miss).alias("first_at"),
            F.max_by("collected_at", miss).alias("last_at"),
        )
        both = new.join(state.withColumn("held", F.lit(True)), "post_id", "left").where(col("held") | (col("misses") > 0))
        known = F.coalesce(col("held"), F.lit(False)) | (col("miss") < col("hit"))  # as missed, when the last return came
        count = F.when(col("hit").isNotNull(), col("after")).otherwise(F.coalesce("failure_count", F.lit(0)) + col("misses"))
        status = F.when(count >= limit, "unavailable").when(count > 0, "unavailable_candidate").otherwise("recovered")
        success = F.when(known & col("hit").isNotNull(), col("hit_at")).otherwise(col("last_success_at"))
        return both.select("post_id", count.alias("failure_count"), F.coalesce("first_failed_at", "first_at").alias("first_failed_at"), F.coalesce("last_at", "last_failed_at").alias("last_failed_at"), success.alias("last_success_at"), status.alias("status"))

    return step


def strike_stream(attempts: DataFrame, state: BucketedState, checkpoint: str, limit: int = 3, forget_after_ms: int | None = None) -> DataFrame:
    """Strikes over a stream of attempts (post_id, seq, collected_at, missed); the changed rows go to state. All of it, after what is there is processed.

    A micro-batch is folded as a whole (strike_step). forget_after_ms: posts whose state did not change for so long start anew
    (by default never); times of change are kept by the engine, so the posts then go one by one through Strikes on the RocksDB state store.
    """
    if forget_after_ms is None:
        return run_stream(attempts, state, strike_step(limit), checkpoint)
    spark = attempts.sparkSession
    folded = attempts.groupBy("post_id").transformWithState(Strikes(limit, forget_after_ms), SCHEMAS["strikes"], "update", "processingTime")

    def apply(changed: DataFrame, number: int) -> None:
        state.apply(changed, number, lambda _, new: new)

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        folded.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    return state.rows()


SCHEMAS = {
    "post": "post_id string, views long, likes long, comments long, collected_at timestamp_ntz",
    "creator": "creator_id long, followers long, collected_at timestamp_ntz",
    "queue": "post_id string, priority_score double, last_checked timestamp_ntz, checks long, next_check timestamp_ntz",
    "enqueued": "post_id string, enqueued_at timestamp_ntz",
    "strikes": "post_id string, failure_count long, first_failed_at timestamp_ntz, last_failed_at timestamp_ntz, last_success_at timestamp_ntz, status string",
}


def once_per_snapshot(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """A stream without repeated (post_id, collected_at), as far as the lateness goes."""
    return stream.withWatermark("collected_at", lateness).dropDuplicatesWithinWatermark(["post_id", "collected_at"])


def append_stream(stream: DataFrame, history: BatchHistory, checkpoint: str, lateness: str = "1 hour") -> DataFrame:
    """Append a stream of snapshots to the history, each (post_id, collected_at) once as far as the lateness goes, each micro-batch once altogether."""

    def apply(batch: DataFrame, number: int) -> None:
        history.append(batch.withColumn("collected_at", col("collected_at").cast("timestamp_ntz")), number)

    once_per_snapshot(stream, lateness).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return history.read()


def windowed_counts(stream: DataFrame, every: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Checks and views of each hour, for trailing-window reports."""
    w = F.window("collected_at", every)
    return stream.withWatermark("collected_at", lateness).groupBy(w, "post_id").agg(F.count("*").alias("checks"), F.max("views").alias("views"))


def landed(spark: SparkSession, schema, path: str) -> DataFrame:
    """A stream over the Parquet files that land in the folders of path."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def windowed_stream(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """windowed_counts() as a stream that is written to path when a window is complete; all windows that are."""
    rows = windowed_counts(stream)
    rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(rows.schema).parquet(path)
