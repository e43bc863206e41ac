"""Bitemporal reads over an event log.

Events have edge_id, commit_seq, event_ord, op and valid_from. What fixes a
snapshot (commit_seq, valid time, keys of an edge) is applied below the fold,
where Spark pushes it to the scan; the fold itself is one aggregation by edge
with partial combining, so a hot edge costs a row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def snapshot(events: DataFrame, *, commit_seq: int | Column | None = None, valid_time: object = None) -> DataFrame:
    """The events that a read at these points may see."""
    if commit_seq is not None:
        events = events.where(F.col("commit_seq") <= commit_seq)
    if valid_time is not None:
        events = events.where(F.col("valid_from") <= F.lit(valid_time).cast("timestamp_ntz"))
    return events


def last_events(events: DataFrame) -> DataFrame:
    """Each edge's last event, retractions included; batch or stream."""
    others = [c for c in events.columns if c != "edge_id"]
    order = ["commit_seq", "event_ord", *(c for c in others if c not in ("commit_seq", "event_ord"))]
    last = events.groupBy("edge_id").agg(F.max(F.struct(*order)).alias("_last"))
    return last.select("edge_id", *(F.col(f"_last.{c}").alias(c) for c in others))


def fold(events: DataFrame) -> DataFrame:
    """The state: each edge's last event, if that is an assertion."""
    return last_events(events).where("op = 'assert'")


def state(events: DataFrame, *, commit_seq: int | Column | None = None, valid_time: object = None) -> DataFrame:
    """The state at a commit and a valid time.

    Of the events visible there that speak of the valid time, the last one of
    an edge decides: an event speaks from valid_from up to valid_to, and
    without an end if that is null or no column. So what a later commit says
    of another time changes nothing. Without valid_time, ended edges stay.
    """
    events = snapshot(events, commit_seq=commit_seq, valid_time=valid_time)
    if valid_time is not None and "valid_to" in events.columns:
        events = events.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(valid_time).cast("timestamp_ntz")))
    return fold(events)


def history(events: DataFrame) -> DataFrame:
    """Every event of an edge with its place in the edge's history; retractions stay."""
    order = W.partitionBy("edge_id").orderBy("commit_seq", "event_ord")
    return events.withColumn("place", F.row_number().over(order))


def last_before(rows: DataFrame, key: str, order: Sequence[str], value: Column, name: str, bucket: Column | None = None) -> DataFrame:
    """rows with a column name: the last value that is not null among the key's rows before this one.

    bucket grows with order. With it, rows are ordered within buckets of a key
    only, each bucket leaves its last value, and these are ordered by key; so
    the rows of a hot key are dealt over as many tasks as it has buckets. Rows
    with a null key are then ordered within their bucket alone.
    """
    if bucket is None:
        return rows.withColumn(name, F.last(value, ignorenulls=True).over(W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)))
    # one shuffle, which order within buckets, what they leave and the join of both share
    rows = rows.withColumn("_bucket", bucket).repartition(key, "_bucket")
    inside = F.last(value, ignorenulls=True).over(W.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    left = rows.groupBy(key, "_bucket").agg(F.max(F.when(value.isNotNull(), F.struct(*order, value.alias("_v")))).alias("_l"))
    before = F.last("_l", ignorenulls=True).over(W.partitionBy(key).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    carried = left.select(key, "_bucket", before.alias("_l")).select(key, "_bucket", F.col("_l._v").alias("_carried"))
    return rows.withColumn("_inside", inside).join(carried, [key, "_bucket"], "left").withColumn(name, F.coalesce("_inside", "_carried")).drop("_bucket", "_inside", "_carried")


def next_after(rows: DataFrame, key: str, order: Sequence[str], value: Column, name: str, bucket: Column | None = None) -> DataFrame:
    """rows with a column name: the value of the key's next row, null for the last; bucket as in last_before()."""
    if bucket is None:
        return rows.withColumn(name, F.lead(value).over(W.partitionBy(key).orderBy(*order)))
    # one shuffle, which order within buckets, what they leave and the join of both share
    rows = rows.withColumn("_bucket", bucket).repartition(key, "_bucket")
    inside = F.lead(F.struct(value.alias("_v"))).over(W.partitionBy(key, "_bucket").orderBy(*order))
    first = rows.groupBy(key, "_bucket").agg(F.min(F.struct(*order, value.alias("_v"))).alias("_f"))
    following = first.select(key, "_bucket", F.lead("_f").over(W.partitionBy(key).orderBy("_bucket")).alias("_f")).select(key, "_bucket", F.col("_f._v").alias("_next"))
    found = F.when(F.col("_inside").isNotNull(), F.col("_inside._v")).otherwise(F.col("_next"))
    return rows.withColumn("_inside", inside).join(following, [key, "_bucket"], "left").withColumn(name, found).drop("_bucket", "_inside", "_next")


def transitions(states: DataFrame, entity: str = "src", state: str = "dst", at: str = "valid_from", tie: str | None = None, *, bucket_unit: str | None = None) -> DataFrame:
    """Each entity's states in order with the time until the next one, in microseconds (null for the last), and the state before.

    bucket_unit (day, week, month ...) deals an entity with very many states over
    several tasks.
    """
    order, unit = [at, *([tie] if tie else [])], bucket(bucket_unit, at) if bucket_unit else None
    found = last_before(next_after(states, entity, order, F.col(at), "_until", unit), entity, order, F.struct(F.col(state).alias("_s")), "_previous", unit)
    return found.withColumns({"previous": F.col("_previous._s"), "dwell_micros": F.timestamp_diff("MICROSECOND", F.col(at), F.col("_until"))}).drop("_until", "_previous")


def latest(states: DataFrame, entity: str = "src", state: str = "dst", at: str = "valid_from", as_of: object = None) -> DataFrame:
    """Each entity's state at a time, or now."""
    if as_of is not None:
        states = states.where(F.col(at) <= F.lit(as_of).cast("timestamp_ntz"))
    return states.groupBy(entity).agg(F.max(F.struct(at, state)).alias("_s")).select(entity, F.col(f"_s.{state}").alias(state), F.col(f"_s.{at}").alias(at))


def as_of_join(left: DataFrame, right: DataFrame, on: str, left_at: str, right_at: str, value: str, *, bucket_unit: str | None = None) -> DataFrame:
    """For each row of left, right's last value at or before its time; of values at one time, the largest.

    Both sides go through one shuffle by key: a union, ordered by time with
    right's rows first, and the last value so far. bucket_unit deals a key with
    very many rows over several tasks.
    """
    own = left.select(F.struct("*")).schema[0].dataType
    r = right.select(F.col(on), F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.col(value).alias("_value"), F.lit(None).cast(own).alias("_row"))
    rows = left.select(F.col(on), F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_value"), F.struct("*").alias("_row"))
    both = last_before(r.unionByName(rows), on, ["_at", "_side", "_value"], F.col("_value"), "_found", bucket(bucket_unit, "_at") if bucket_unit else None)
    return both.where("_side = 1").select("_row.*", F.col("_found").alias(value))


def bucket(unit: str, column: str | Column) -> Column:
    """The start of the year, month, week (from Monday), day or hour, without a time zone."""
    return F.date_trunc(unit, column).cast("timestamp_ntz")
