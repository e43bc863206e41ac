"""State of streams in RocksDB: every row that is sent comes out with a verdict, so none is lost without a trace.

Spark drops rows behind the watermark before a stateful operator sees them, as
long as these have the watermark's column. Here they go in with a plain copy of
it; the operator asks for the watermark and judges by itself. Each batch writes
its rows under a folder of its number, split by verdict, and replaces them if
it runs again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidegraph.operators.temporal import last_events

_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = dt.datetime(1970, 1, 1)


def in_rocksdb(spark: SparkSession) -> None:
    """Queries started from now on keep their state on disk, with changes written for each batch, and not in executors' memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _millis(at: dt.datetime) -> int:
    return (at - _EPOCH) // dt.timedelta(milliseconds=1)


class Sightings(StatefulProcessor):
    """Of each key, the first sighting is kept, a first one behind the watermark is late, and all others are repeated.

    A key is remembered until the watermark is past its time and the delay. So
    a late row is either a first sighting or one of a key that is forgotten,
    which nothing can tell apart; it is no kept row, and is not lost. A group
    is a run of keys, each with its _place there, so that the state is asked
    and written once for all of them and not for each.
    """

    def __init__(self, columns: list[str], at: str, delay_millis: int):
        self.columns, self.at, self.delay = columns, at, delay_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = {"places": TY.ArrayType(TY.LongType()), "untils": TY.ArrayType(TY.LongType()), "timer": TY.LongType()}
        self.seen = handle.getValueState("seen", TY.StructType([TY.StructField(n, k) for n, k in kinds.items()]))

    def _keep(self, until: dict[int, int], timer: int | None) -> None:
        """One timer for a group, at the first time that one of its keys is forgotten."""
        first = min(until.values())
        if timer is None or first < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
            timer = first
        self.seen.update((list(until), list(until.values()), timer))

    def _known(self) -> tuple[dict[int, int], int | None]:
        found = self.seen.get()
        return (dict(zip(found[0], found[1], strict=True)), found[2]) if found else ({}, None)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark, (until, timer) = timerValues.getCurrentWatermarkInMs(), self._known()
        known = len(until)
        # the earliest of a batch is the first, whatever the order of files
        for row in sorted(rows, key=lambda r: (r[self.at] is None, r[self.at] or _EPOCH, str(tuple(r)))):
            verdict = "repeated"
            if row["_place"] not in until:
                at = row[self.at]
                until[row["_place"]] = max(mark, _millis(at) if at is not None else mark) + self.delay
                verdict = "late" if at is None or _millis(at) < mark else "kept"
            yield Row(**{c: row[c] for c in self.columns}, verdict=verdict)
        if len(until) > known:
            self._keep(until, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        until = {k: u for k, u in self._known()[0].items() if u > mark}
        if until:
            self._keep(until, None)
        else:
            self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


#: Keys of a group where they are integers.
RUN = 256


def _grouped(rows: DataFrame, key: str) -> DataFrame:
    """rows with the _run that its key is in and its _place there: integers go by runs of RUN, any other key is a run of its own."""
    if not isinstance(rows.schema[key].dataType, (TY.ByteType, TY.ShortType, TY.IntegerType, TY.LongType)):
        return rows.withColumns({"_run": F.col(key), "_place": F.lit(0)})
    number = F.col(key).cast("long")
    return rows.withColumns({"_run": F.shiftright(number, RUN.bit_length() - 1), "_place": F.coalesce(F.pmod(number, F.lit(RUN)).cast("int"), F.lit(0))})


def start_sightings(stream: DataFrame, target: str, checkpoint: str, *, key: str = "seq", at: str = "ts", delay_seconds: int = 3600) -> StreamingQuery:
    """Writes every row of the stream under target, by verdict: kept, late or repeated; ends when the stream's files are used up.

    kept + late + repeated is what was sent. A null time is late, and rows with
    a null key are one key. The state is forgotten a delay after the key's
    time, so it is as large as what one delay sends. Integer keys share a state
    by runs of RUN, so they should be dense: numbers that go up, not hashes.
    """
    in_rocksdb(stream.sparkSession)
    columns = stream.columns
    marked = stream.withColumn("_mark", F.col(at).cast("timestamp")).withWatermark("_mark", f"{delay_seconds} seconds")
    # a copy of the columns alone: the watermark's own column would have late rows dropped
    plain = marked.select(*(F.col(c) for c in columns), F.unix_micros("_mark").alias("_micros")).drop("_micros")
    schema = TY.StructType([*(TY.StructField(f.name, f.dataType) for f in stream.schema), TY.StructField("verdict", TY.StringType())])
    judged = _grouped(plain, key).groupBy("_run").transformWithState(statefulProcessor=Sightings(columns, at, delay_seconds * 1000), outputStructType=schema, outputMode="Append", timeMode="EventTime")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("verdict").parquet(f"{target}/batch={number}")

    return judged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def judged(spark: SparkSession, target: str, verdict: str | None = None) -> DataFrame:
    """What start_sightings() or start_ledger() has written, with its verdict, or of one verdict without it."""
    found = spark.read.parquet(target).drop("batch")
    return found if verdict is None else found.where(F.col("verdict") == verdict).drop("verdict")


class Ledger(StatefulProcessor):
    """Of each edge, the last event so far decides about the next ones: a later one is applied, an earlier one is late.

    The same place in the order again is repeated, or refused if its content
    is another. The rows of a batch are taken in their order.
    """

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        kinds = {"commit_seq": TY.LongType(), "event_ord": TY.LongType(), "content": TY.StringType()}
        self.last = handle.getValueState("last", TY.StructType([TY.StructField(n, k) for n, k in kinds.items()]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = tuple(self.last.get()) if self.last.exists() else None
        before = last
        for row in sorted(rows, key=lambda r: (r["commit_seq"], r["event_ord"], r["_content"])):
            own = (row["commit_seq"], row["event_ord"], row["_content"])
            if last is None or own[:2] > last[:2]:
                verdict, last = "applied", own
            elif own[:2] < last[:2]:
                verdict = "late"
            else:
                verdict = "repeated" if own == last else "refused"
            yield Row(**{c: row[c] for c in self.columns}, verdict=verdict)
        if last != before:
            self.last.update(last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from ()

    def close(self) -> None:
        pass


def start_ledger(events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Writes every event of a stream under target, by verdict: applied, late, repeated or refused.

    Events have edge_id, commit_seq and event_ord, none of them null. The last
    event of each edge lives in the state store, with a digest of its content.
    state_of() reads the state.
    """
    in_rocksdb(events.sparkSession)
    columns = events.columns
    content = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    schema = TY.StructType([*(TY.StructField(f.name, f.dataType) for f in events.schema), TY.StructField("verdict", TY.StringType())])
    told = events.withColumn("_content", content).groupBy("edge_id").transformWithState(statefulProcessor=Ledger(columns), outputStructType=schema, outputMode="Append", timeMode="None")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("verdict").parquet(f"{target}/batch={number}")

    return told.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state_of(spark: SparkSession, target: str) -> DataFrame:
    """The state that a ledger's applied events make up."""
    return last_events(judged(spark, target, "applied")).where("op = 'assert'")
