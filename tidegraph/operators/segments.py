"""Tiered compaction of a log of keyed commits, and reads that open only the folders that they need.

commit_once() writes a folder for each commit. compact_tail() puts the youngest
of them, and older segments of about the size that these add up to, into one
segment in the order of edges, so a commit is rewritten about once each time
the log has grown fourfold and the work goes with the tail. Segments hold every
event, so histories and earlier reads are what they were. What a segment has
replaced stays until sweep() deletes it; a segment is part of the log as soon
as its row in the table of segments is there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.operators.writes import ledger
from tidegraph.shared import delete, folders

#: Commits of the tail that are put together, at least, and how much larger than all younger ones a segment must be to be left alone.
LEAST_TAIL, FANOUT = 4, 4

SEGMENTS = "first long, last long, op_count long, least_edge string, greatest_edge string"


@dataclass(frozen=True)
class Unit:
    """One folder of events: the commits that it holds, how many events, and the range of its edges where that is known."""

    first: int
    last: int
    op_count: int
    least_edge: str | None = None
    greatest_edge: str | None = None

    @property
    def folder(self) -> str:
        return f"commit={self.last}" if self.least_edge is None else f"segment={self.first}-{self.last}"

    def holds(self, edge: str) -> bool:
        return self.least_edge is None or self.least_edge <= edge <= self.greatest_edge


def _segments(spark: SparkSession, path: str) -> list[Unit]:
    if not folders(spark, f"{path}/segments"):
        return []
    return [Unit(*r) for r in spark.read.schema(SEGMENTS).parquet(f"{path}/segments/*").collect()]


def units(spark: SparkSession, path: str) -> list[Unit]:
    """The folders that make up the log now, oldest first: segments that no larger one holds, and commits of no segment."""
    known = sorted(_segments(spark, path), key=lambda s: (s.first, -s.last))
    top: list[Unit] = []
    for s in known:
        if not top or s.last > top[-1].last:
            top.append(s)
    covered = top[-1].last if top else 0
    tail = ledger(spark, path).where(F.col("commit_seq") > covered).select("commit_seq", "op_count").collect()
    return top + sorted((Unit(r["commit_seq"], r["commit_seq"], r["op_count"]) for r in tail), key=lambda u: u.first)


def needed(spark: SparkSession, path: str, *, commit_seq: int | None = None, edge: str | None = None) -> list[Unit]:
    """The units that a read at a commit, or of one edge, has to open."""
    return [u for u in units(spark, path) if u.op_count and (commit_seq is None or u.first <= commit_seq) and (edge is None or u.holds(edge))]


def events(spark: SparkSession, path: str, schema: str, *, commit_seq: int | None = None, edge: str | None = None) -> DataFrame:
    """The log's events up to a commit, or of one edge, from the units that can have them."""
    paths = [f"{path}/events/{u.folder}" for u in needed(spark, path, commit_seq=commit_seq, edge=edge)]
    found = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    if commit_seq is not None:
        found = found.where(F.col("commit_seq") <= commit_seq)
    return found if edge is None else found.where(F.col("edge_id") == edge)


def chosen(now: list[Unit], least_tail: int = LEAST_TAIL, fanout: int = FANOUT, max_segments: int | None = None) -> list[Unit]:
    """The youngest units that are to be one: each next older one is taken as long as it is at most fanout times what is taken.

    Fewer than least_tail are left alone, unless more than max_segments would
    be left; then as many are taken as make it max_segments.
    """
    taken = 0
    size = 0
    for unit in reversed(now):
        if taken and unit.op_count > fanout * max(1, size):
            break
        size += unit.op_count
        taken += 1
    taken = taken if taken >= least_tail else 0
    if max_segments is not None and len(now) - max(0, taken - 1) > max_segments:
        taken = max(taken, len(now) - max_segments + 1)
    return now[len(now) - taken :] if taken > 1 else []


def compact_tail(spark: SparkSession, path: str, schema: str, *, least_tail: int = LEAST_TAIL, fanout: int = FANOUT, max_segments: int | None = None) -> Unit | None:
    """Writes the chosen units as one segment and says which; None if there is nothing to do.

    What an earlier call has left unfinished is replaced.
    """
    # empty commits are no folders that a read opens
    some = chosen([u for u in units(spark, path) if u.op_count], least_tail, fanout, max_segments)
    if not some:
        return None
    name = f"{some[0].first}-{some[-1].last}"
    whole = spark.read.schema(schema).parquet(*(f"{path}/events/{u.folder}" for u in some))
    whole.repartitionByRange("edge_id").sortWithinPartitions("edge_id", "commit_seq", "event_ord").write.mode("overwrite").parquet(f"{path}/events/segment={name}")
    # what was written says what the segment holds
    n, least, greatest = spark.read.schema(schema).parquet(f"{path}/events/segment={name}").agg(F.count("*"), F.min("edge_id"), F.max("edge_id")).first()
    made = Unit(some[0].first, some[-1].last, n, least, greatest)
    row = [(made.first, made.last, n, least, greatest)]
    spark.createDataFrame(row, SEGMENTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/segments/segment={name}")
    return made


def sweep(spark: SparkSession, path: str) -> int:
    """Deletes the folders of events that are part of a segment, and of no use to readers who begin now; gives their number."""
    keep = {u.folder for u in units(spark, path)}
    last = max((u.last for u in units(spark, path)), default=0)
    # a folder of a commit that is not in the ledger yet is being written
    gone = [f for f in folders(spark, f"{path}/events") if f not in keep and int(f.rpartition("=")[2].rpartition("-")[2]) <= last]
    delete(spark, [f"{path}/events/{f}" for f in gone])
    return len(gone)
