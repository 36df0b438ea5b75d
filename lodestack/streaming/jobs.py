"""Structured Streaming jobs: event sinks, window rates, keyed state with timers, tables that follow arriving files."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from lodestack.operators import diff
from lodestack.sources.tables import exists, read_folders, rewrite_folders, stored


def events(spark: SparkSession, folder: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def deduplicated(stream: DataFrame, key: str = "event_id", time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Each key once among rows that are not later than the watermark allows."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def append(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target)


def rates(stream: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events of each type in tumbling windows."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each user: runs of events with gaps below `gap`."""
    return stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def sink(spark: SparkSession, target: str, name: str, late: str = "12 hours") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes the rows of a stream to on_time or, behind the rows of earlier batches by more than `late`, to late.

    Each batch has folders of its own (query=.../batch=...). What counts as late is told by the largest
    times of the batches before it, which are written beside them; so a batch that runs again, after a
    lost driver or with another split of tasks, writes the same rows over the same folders.
    """

    def run(batch: DataFrame, number: int) -> None:
        here = f"query={name}/batch={number}"
        rows = stored(batch)
        limit = None
        if number > 0:
            known = spark.read.schema("most timestamp, query string, batch long").parquet(f"{target}/times").where((F.col("query") == name) & (F.col("batch") < number))
            limit = known.agg((F.max("most") - F.expr(f"INTERVAL {late}")).alias("limit")).first()["limit"]
        is_late = F.lit(False) if limit is None else F.coalesce(F.col("ts") < F.lit(limit), F.lit(False))
        rows.where(~is_late).write.mode("overwrite").parquet(f"{target}/on_time/{here}")
        rows.where(is_late).write.mode("overwrite").parquet(f"{target}/late/{here}")
        rows.agg(F.max("ts").alias("most")).write.mode("overwrite").parquet(f"{target}/times/{here}")

    return run


EPISODE = "user_id long, how string, opened_us long, closed_us long, last_id long, n long"


class Pending(StatefulProcessor):
    """Entries by key: an event opens or extends the entry of its key, a closing event clears it, and time ends it.

    Rows out are the entries that ended: cleared (closed at the closing event) or expired (at the
    last event and `ttl_us`). An entry that a later event of its key meets too late has expired as
    well, whether or not its timer has fired; so the split into batches changes nothing.
    """

    def __init__(self, closing: tuple[str, ...], ttl_us: int):
        self.closing, self.ttl_us = closing, ttl_us

    def init(self, handle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "opened_us long, last_us long, last_id long, n long")

    def handleInputRows(self, key, rows, timerValues):
        now = self.entry.get() if self.entry.exists() else None
        for r in sorted(rows, key=lambda r: (r.ts_us, r.event_id)):  # those of one key in one batch
            if now and r.ts_us - now[1] > self.ttl_us:
                yield self._ended(key, "expired", now, now[1] + self.ttl_us)
                now = None
            if r.event_type not in self.closing:
                now = (now[0] if now else r.ts_us, r.ts_us, r.event_id, now[3] + 1 if now else 1)
            elif now:
                yield self._ended(key, "cleared", now, r.ts_us)
                now = None
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if now:
            self.entry.update(now)
            self.handle.registerTimer((now[1] + self.ttl_us) // 1000)
        else:
            self.entry.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.entry.exists():
            now = self.entry.get()
            yield self._ended(key, "expired", now, now[1] + self.ttl_us)
            self.entry.clear()

    @staticmethod
    def _ended(key, how, entry, closed):
        return Row(user_id=key[0], how=how, opened_us=entry[0], closed_us=closed, last_id=entry[2], n=entry[3])

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession):
    """The state store that keyed state with timers needs, for this block."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pending(stream: DataFrame, closing: tuple[str, ...], ttl: timedelta, late: str = "1 hour") -> DataFrame:
    """Ended entries of a stream of events (event_id, ts, user_id, event_type). Run it, and read its state, inside keyed_state."""
    rows = stream.withWatermark("ts", late).select("user_id", "event_id", "event_type", "ts", F.unix_micros("ts").alias("ts_us"))
    return rows.groupBy("user_id").transformWithState(Pending(closing, ttl // timedelta(microseconds=1)), EPISODE, "Append", "EventTime")


def open_entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(user_id, opened_us, last_id, n): the entries that the state at a checkpoint still holds."""
    state = spark.read.format("statestore").option("stateVarName", "entry").load(checkpoint)
    return state.select(F.col("key.user_id").alias("user_id"), "value.opened_us", "value.last_id", "value.n")


def parts(spark: SparkSession, root: str, tables: dict[str, tuple[Callable[[DataFrame], DataFrame], str]], buckets: int = 64, key: str = "id") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps tables made of keyed rows, each in folders by a hash of the key.

    tables: name to (function of the new rows, its schema with `key`). Of rows (key, ord, ...) that share a
    key the largest ord counts, whenever it comes; rows of an older ord change nothing. Only folders with
    a key of the batch are read and written, and a batch that runs again leaves the same tables.
    """
    home = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")

    def run(batch: DataFrame, number: int) -> None:
        new = stored(batch.where(F.col(key).isNotNull()).select("*", home))
        seen = f"{root}/seen"
        known = read_folders(spark, seen, f"{key} {batch.schema[key].dataType.simpleString()}, ord int, bucket int", key) if exists(spark, seen) else None
        odd = new.groupBy(key).agg(F.max("ord").alias("ord"), F.count(F.lit(1)).alias("n"))
        if known is None:
            odd = odd.where("n > 1")
        else:
            known = known.join(F.broadcast(new.select("bucket").distinct()), "bucket", "left_semi")
            older = known.select(key, F.col("ord").alias("_ord"))
            odd = odd.join(older, key, "left").where("n > 1 OR ord < _ord")
        if not odd.isEmpty():  # else all rows count, and they are not shuffled
            new = diff.latest(new, [key], [F.col("ord")])
            if known is not None:
                new = new.join(older, key, "left").where("_ord IS NULL OR ord >= _ord").drop("_ord")
            new = stored(new)
        folders = stored(new.select("bucket").distinct())

        def put(rows: DataFrame, path: str, before: DataFrame | None) -> None:
            if before is not None:
                kept = before.join(F.broadcast(folders), "bucket", "left_semi").join(new.select(key), key, "left_anti")
                rows = kept.unionByName(rows)
            rewrite_folders(rows, folders, path, "bucket")

        for name, (make, schema) in tables.items():
            path = f"{root}/{name}"
            before = read_folders(spark, path, f"{schema}, bucket int", key) if exists(spark, path) else None
            put(make(new).withColumn("bucket", home), path, before)
        put(new.select(key, "ord", "bucket"), seen, known)  # last: until then the batch counts as not seen

    return run


def drain(stream: DataFrame, function, checkpoint: str) -> int:
    """Run all that has arrived through a foreachBatch function; the number of batches."""
    q = stream.writeStream.foreachBatch(function).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    last = q.lastProgress
    return (last["batchId"] + 1) if last else 0
