"""Joins of points with the intervals that hold them, and of intervals that overlap, by dyadic nodes.

The domain of the points is cut into cells, as many as there are rows, and
cells into a tree of 8 to a node. Where keys have to be equal too, the rows of
the key that has most decide, so that many small keys need few cells or one. An interval is the disjoint union of at most
14 nodes a level (and up to 64 at the top), however long it is or whether it has
an end; a point has one node a level. A point is in an interval just if they
share a node, and then they share one only. So the join is an equality, rows
grow by the logarithm of their number, and no width has to be chosen. The top
of the tree is 64 nodes and not one, so what spans everything meets the points
of a key in 64 places and not in one.

A range join gives many rows for few: each range with all points in it. There,
points travel in runs of neighbours that share a node, so a range meets a run
and not each point, and the rows that come out are short sequences that repeat,
which Parquet's pages hold in a fraction of a byte a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as TY

#: Bits of a node's children, and of the nodes at the top.
CHILD_BITS, TOP_BITS = 3, 6
#: Levels at most: 2^39 cells.
MOST_LEVELS = 12
#: Rows of a key in a cell that are compared one by one.
CELL_ROWS = 32
#: Bits of the number of points that a run has at most.
RUN_BITS = 4


def position(df: DataFrame, column: str) -> Column:
    """A number that grows with the column: microseconds of a time, else the value itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, TY.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column)).cast("double")
    if isinstance(kind, TY.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, TY.DateType):
        return F.unix_date(column).cast("double")
    return F.col(column).cast("double")


@dataclass(frozen=True)
class Domain:
    """The range of positions that cells divide evenly, and the levels of the tree above the cells; positions outside fall into the outermost cells."""

    low: float
    high: float
    levels: int
    top_bits: int = TOP_BITS

    @property
    def cells(self) -> int:
        return 1 << (self.top_bits + CHILD_BITS * (self.levels - 1))

    def cell(self, at: Column) -> Column:
        """Never falls as at grows; NaN is above all, as it is in Spark's order."""
        share = (at - F.lit(self.low)) / F.lit(max(self.high - self.low, 1e-300)) * self.cells
        inside = F.greatest(F.lit(0.0), F.least(F.floor(share), F.lit(float(self.cells - 1))))
        return F.when(F.isnan(at) | (at == float("inf")), self.cells - 1).when(at == float("-inf"), 0).otherwise(inside).cast("long")


def domain(*points: tuple[DataFrame, str], on: Sequence[str] = ()) -> Domain:
    """What these columns span; as many cells as there are rows, or as the largest key of on needs. One number of each kind a table reaches the driver."""
    low, high, rows = float("inf"), float("-inf"), 0
    for df, column in points:
        at = position(df, column)
        finite = F.when(~F.isnan(at) & (F.abs(at) != float("inf")), at)
        each = df.groupBy(*on).agg(F.count(finite).alias("n"), F.min(finite).alias("a"), F.max(finite).alias("b"))
        # a key with a null meets nothing
        n, a, b = (each.dropna(subset=list(on)) if on else each).agg(F.max("n"), F.min("a"), F.max("b")).first()
        if n:
            low, high, rows = min(low, a), max(high, b), rows + n
    if not rows:
        return Domain(0.0, 1.0, 1)
    bits = rows.bit_length()
    if on:
        bits = (-(-rows // CELL_ROWS) - 1).bit_length()
        if bits <= TOP_BITS:
            return Domain(low, high, 1, bits)
    levels = 1 + max(0, -(-(bits - TOP_BITS) // CHILD_BITS))
    return Domain(low, high, min(MOST_LEVELS, levels))


def _node(level: int, index: Column) -> Column:
    return index * 16 + level


def _run(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def _shift(value: Column, bits: int) -> Column:
    return F.shiftright(value, bits) if bits else value


def cover(first: Column, last: Column, levels: int) -> Column:
    """The fewest nodes that make up the cells from first to last."""
    parts = []
    for level in range(levels):
        low = _shift(first + ((1 << CHILD_BITS * level) - 1), CHILD_BITS * level)
        high = _shift(last + 1, CHILD_BITS * level) - 1
        if level == levels - 1:
            runs = [_run(low, high)]
        else:
            # nodes whose parents are covered too are left to them
            outer_low, outer_high = _shift(low + ((1 << CHILD_BITS) - 1), CHILD_BITS), _shift(high + 1, CHILD_BITS) - 1
            inner = outer_low <= outer_high
            runs = [_run(low, F.when(inner, outer_low * (1 << CHILD_BITS) - 1).otherwise(high)), F.when(inner, _run((outer_high + 1) * (1 << CHILD_BITS), high)).otherwise(F.array().cast("array<bigint>"))]
        parts += [_numbered(run, level) for run in runs]
    return F.flatten(F.array(*parts))


def _numbered(run: Column, level: int) -> Column:
    return F.transform(run, lambda x: _node(level, x))


def above(cell: Column, levels: int) -> Column:
    """The nodes that hold a cell, one a level."""
    return F.array(*(_node(level, _shift(cell, CHILD_BITS * level)) for level in range(levels)))


def stab(points: DataFrame, at: str, intervals: DataFrame, low: str, high: str, on: Sequence[str], where: Column, spans: Domain, *, in_runs: bool = False) -> DataFrame:
    """points with the intervals of equal on that hold them, as where says exactly; each pair once. A null high has no end.

    Columns other than on must differ. Rows with a null key, point or low find
    nothing. in_runs pays where most points are in many intervals.
    """
    cell = spans.cell
    p = points.where(F.col(at).isNotNull()).withColumn("_cell", cell(position(points, at)))
    if in_runs:
        # the hash deals out points of one cell; a run is of one task
        tie = F.xxhash64(*points.columns).alias("_tie")
        p = p.select("*", tie).repartitionByRange(*on, "_cell", "_tie").sortWithinPartitions(*on, "_cell", "_tie").drop("_tie")
        p = p.withColumn("_run", F.shiftright(F.monotonically_increasing_id(), RUN_BITS))
    p = p.withColumn("_node", F.explode(above(F.col("_cell"), spans.levels))).drop("_cell")
    if in_runs:
        own = [c for c in points.columns if c not in on]
        p = p.groupBy(*on, "_node", "_run").agg(F.collect_list(F.struct(*own)).alias("_points")).drop("_run")
    last = F.coalesce(cell(position(intervals, high)), F.lit(spans.cells - 1).cast("long"))
    i = intervals.where(F.col(low).isNotNull())
    # what comes from one small file would be put on nodes by one task
    i = (i.repartition(*i.columns) if in_runs else i).withColumn("_node", F.explode(cover(cell(position(intervals, low)), last, spans.levels)))
    # never a broadcast: what Spark takes for the size of these is that of the rows before they are put on nodes
    met = p.join(i.hint("merge"), [*on, "_node"]).drop("_node")
    if in_runs:
        met = met.select("*", F.inline("_points")).select(*on, *own, *(c for c in intervals.columns if c not in on))
    return met.where(where)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], *, start: str = "valid_from", end: str = "valid_to", spans: Domain | None = None) -> DataFrame:
    """Pairs of rows with equal keys whose intervals [start, end) overlap; right's columns are prefixed r_. A null end has none.

    Two intervals overlap if one's start is in the other; so points are
    starts, those of left in right's intervals and those of right after the
    start in left's. Empty intervals and null starts meet nothing.
    """
    on = list(on)
    some = lambda d: d.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    left = some(left)
    right = some(right)
    spans = spans or domain((left, start), (right, start), on=on)
    r = right.select(*(F.col(c).alias(c if c in on else f"r_{c}") for c in right.columns))
    starts = [F.col(start), F.col(f"r_{start}")]
    ends = [F.col(end), F.col(f"r_{end}")]
    one = stab(left, start, r, f"r_{start}", f"r_{end}", on, (starts[0] >= starts[1]) & (ends[1].isNull() | (starts[0] < ends[1])), spans)
    other = stab(r, f"r_{start}", left, start, end, on, (starts[1] > starts[0]) & (ends[0].isNull() | (starts[1] < ends[0])), spans)
    return one.unionByName(other)


def range_join(left: DataFrame, right: DataFrame, value: str, low: str, high: str, *, on: Sequence[str] = (), spans: Domain | None = None) -> DataFrame:
    """Rows of left with rows of right whose [low, high] holds left's value, whatever the lengths of these ranges."""
    ranges = right.where(F.col(low) <= F.col(high))
    spans = spans or domain((left, value), *([(ranges, low)] if on else []), on=on)
    return stab(left, value, ranges, low, high, on, F.col(value).between(F.col(low), F.col(high)), spans, in_runs=True)
