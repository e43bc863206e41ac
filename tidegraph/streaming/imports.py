"""Durable imports: files of NDJSON streamed into the event log, each once; signals and state kept up by streams."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegraph.operators.temporal import fold, last_events
from tidegraph.shared import delete, folders
from tidegraph.sources import ndjson

#: Files count however old they are; Spark would pass over those that are a week older than the newest.
ANY_AGE = "36500d"

#: What an import writes, each in a folder of its own with a folder for every batch.
FAMILIES = {"edges": ndjson.triplets, "entities": ndjson.entities, "rejected": ndjson.rejected}


@dataclass
class ImportJob:
    """A running or ended import; the folders under target are its result."""

    query: StreamingQuery
    target: str
    cancelled: bool = False


def start_import(spark: SparkSession, source: str, target: str, checkpoint: str, *, files_per_trigger: int = 100, strict: bool = False, observed_at: str | None = None) -> ImportJob:
    """Imports all files not imported yet, then ends: triplets, entities and lines that are neither, under target.

    The checkpoint makes it durable: after a stop or failure the same call
    goes on where it was, and files that are in target are not read again. A
    batch replaces its own folders, so one that runs again adds nothing. strict
    fails on the first line that is malformed or neither a triplet nor an
    entity, and keeps nothing of its batch. observed_at is a time in ISO form;
    without it, the time of the import.
    """
    lines = spark.readStream.schema(ndjson.SCHEMA).option("maxFilesPerTrigger", files_per_trigger).option("maxFileAge", ANY_AGE).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(source)
    at = F.lit(observed_at).cast("timestamp") if observed_at else F.current_timestamp()

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            if strict and not ndjson.rejected(batch).isEmpty():
                raise ValueError("a line is neither a triplet nor an entity")
            for name, of in FAMILIES.items():
                of(batch).withColumn("observed_at", at).write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")
        finally:
            batch.unpersist()

    return ImportJob(lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), target)


def imported(spark: SparkSession, target: str, family: str = "edges") -> DataFrame:
    """What has been imported so far of a family: edges, entities or rejected."""
    return spark.read.parquet(f"{target}/{family}").drop("batch")


def counts(spark: SparkSession, target: str) -> dict[str, int]:
    """Lines by family, those that are malformed told apart from those that are neither triplet nor entity."""
    found = {name: imported(spark, target, name).count() for name in ("edges", "entities")}
    bad = imported(spark, target, "rejected").agg(F.count_if("malformed"), F.count_if(~F.col("malformed"))).first()
    return found | {"malformed": bad[0], "unknown": bad[1]}


def status(job: ImportJob) -> str:
    """running, succeeded, failed, or cancelled."""
    if job.query.isActive:
        return "running"
    if job.query.exception():
        return "failed"
    return "cancelled" if job.cancelled else "succeeded"


def wait(job: ImportJob, seconds: float | None = None) -> str:
    """Waits for the end, raising what the query raised, or TimeoutError."""
    if seconds is None:
        job.query.awaitTermination()
    elif not job.query.awaitTermination(seconds):
        raise TimeoutError(f"the import still runs after {seconds} s")
    return status(job)


def cancel(job: ImportJob) -> None:
    """Stops a running import; whole batches stay, and the same call of start_import() goes on after them."""
    job.cancelled = job.query.isActive
    job.query.stop()
    while job.query.isActive:
        time.sleep(0.05)


def start_fold(events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keeps the state of a stream of events: each batch is a run of its own, and runs are put together by compact_folded() or when they are read.

    So a batch costs what came and not what there is, and no second copy of
    the state lies in a state store. A batch that runs again replaces its run.
    Each batch also says up to which commit the state has come. folded() reads
    the state.
    """

    def write(batch: DataFrame, number: int) -> None:
        path = f"{target}/batch={number}"
        batch.write.mode("overwrite").option("compression", "zstd").parquet(path)
        batch.sparkSession.read.parquet(path).agg(F.max("commit_seq").alias("commit_seq")).write.mode("overwrite").parquet(f"{target}/published/batch={number}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _generations(spark: SparkSession, target: str) -> tuple[list[int], list[int]]:
    """The numbers of the compactions and of the batches that are written completely."""
    names = [n.split("=") for n in folders(spark, target) if n.startswith(("upto=", "batch="))]
    whole = [(kind, int(n)) for kind, n in names if "_SUCCESS" in folders(spark, f"{target}/{kind}={n}")]
    return sorted(n for kind, n in whole if kind == "upto"), sorted(n for kind, n in whole if kind == "batch")


def _paths(spark: SparkSession, target: str) -> list[str]:
    compacted, batches = _generations(spark, target)
    upto = compacted[-1] if compacted else -1
    return [f"{target}/upto={upto}"] * bool(compacted) + [f"{target}/batch={n}" for n in batches if n > upto]


def folded(spark: SparkSession, target: str) -> DataFrame:
    """The state that start_fold() has kept: of each edge the last event, if that is an assertion.

    Reads the last compaction and the batches after it.
    """
    return _last(spark, _paths(spark, target)).where("op = 'assert'")


def _last(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The last event of every edge; one generation has no others."""
    found = spark.read.parquet(*paths)
    return found if len(paths) == 1 and "/batch=" not in paths[0] else last_events(found)


def compact_folded(spark: SparkSession, target: str) -> int:
    """Writes the last event of every edge so far as one generation, and gives the number of the last batch in it.

    A first batch that is alone stays as it is. What the generation before this one had replaced is deleted; so a reader
    that has listed files just before still finds them.
    """
    compacted, batches = _generations(spark, target)
    before, last = compacted[-1] if compacted else -1, batches[-1]
    if last > before and len(_paths(spark, target)) > 1:
        _last(spark, _paths(spark, target)).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/upto={last}")
        delete(spark, [f"{target}/batch={n}" for n in batches if n <= before] + [f"{target}/upto={n}" for n in compacted[:-1]])
    return last


def published(spark: SparkSession, target: str) -> int:
    """The commit up to which the state of start_fold() has come; 0 before the first batch."""
    if not folders(spark, f"{target}/published"):
        return 0
    return spark.read.parquet(f"{target}/published").agg(F.max("commit_seq")).first()[0] or 0


def read_state(log: DataFrame, target: str, *, consistency: str = "eventual", min_indexed_seq: int | None = None) -> DataFrame:
    """The state as published by start_fold(), or with all commits of the log if consistency is strong.

    Raises if what is read does not reach the floor min_indexed_seq.
    """
    spark = log.sparkSession
    if consistency == "strong":
        read_seq(log.agg(F.max("commit_seq")).first()[0] or 0, 0, consistency=consistency, min_indexed_seq=min_indexed_seq)
        return fold(log)
    read_seq(0, published(spark, target), consistency=consistency, min_indexed_seq=min_indexed_seq)
    return folded(spark, target)


def unique_signals(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Signals without replays: the state of a seq is kept for the watermark's delay only.

    Rows behind the watermark are dropped, first sightings too;
    state.start_sightings() keeps these apart.
    """
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["seq"])


class NotYetVisible(RuntimeError):
    """A read asked for a commit that is not published yet; it can be tried again."""


def require_seq(published: int, wanted: int | None) -> int:
    """The sequence to read at: read-your-writes holds or it raises."""
    if wanted is not None and published < wanted:
        raise NotYetVisible(f"published up to {published}, asked for {wanted}")
    return published


def read_seq(head: int, published: int, *, consistency: str = "eventual", min_indexed_seq: int | None = None) -> int:
    """The commit at which a read pins its snapshot: the head if strong, else what is published, never below the floor."""
    if consistency not in ("eventual", "strong"):
        raise ValueError(f"no consistency {consistency}")
    return require_seq(head if consistency == "strong" else published, min_indexed_seq)
