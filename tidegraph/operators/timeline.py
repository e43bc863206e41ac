"""Valid time laid out: what holds of an edge, and from when to when.

Every event speaks of its edge for [valid_from, valid_to), without an end if
that is null. Where several do, the latest commit decides, so a later
correction of an earlier time changes that time and no other. timeline() cuts
each edge's valid time into disjoint pieces, each with the event that decides
there; times that a retraction decides, or no event, are no pieces.

An edge's pieces are told from the list of its events. An edge with more than
MOST of them is dealt by time: its endpoints are placed in order by a range
shuffle, every MOST-th of them is a bound, and each stretch between bounds has
the events with an endpoint there. What covers whole stretches is put on the
nodes of a tree above them, of which each keeps the latest, so that an event
without an end isn't copied to all stretches after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.operators.intervals import Domain, above, cover, domain, stab
from tidegraph.operators.ranks import placed
from tidegraph.operators.temporal import snapshot
from tidegraph.shared import materialise

#: Events of an edge, or endpoints of a stretch, that are laid out together.
MOST = 128
#: Levels of the tree over an edge's stretches.
LEVELS = 6

def _forever() -> Column:
    return F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz")


def _spans(events: DataFrame) -> DataFrame:
    """(edge_id, _from, _to, _event); events compare by commit and order within it."""
    order = ["commit_seq", "event_ord", *(c for c in events.columns if c not in ("edge_id", "commit_seq", "event_ord"))]
    to = F.col("valid_to") if "valid_to" in events.columns else F.lit(None).cast("timestamp_ntz")
    found = events.select("edge_id", F.col("valid_from").alias("_from"), F.coalesce(to, _forever()).alias("_to"), F.struct(*order).alias("_event"))
    return found.where("_from < _to")


def _laid_out(events: Column) -> Column:
    """The pieces of a list of (_from, _to, _event): (f, t, e) for each stretch that one event decides, retractions included."""
    points = F.array_sort(F.array_distinct(F.flatten(F.transform(events, lambda e: F.array(e["_from"], e["_to"])))))

    def decided(points: Column) -> Column:
        def top(p: Column) -> Column:
            return F.array_max(F.transform(F.filter(events, lambda e: (e["_from"] <= p) & (e["_to"] > p)), lambda e: e["_event"]))

        return F.transform(F.slice(points, 1, F.size(points) - 1), top)

    # let points and tops be computed once
    return F.transform(F.array(points), lambda p: F.transform(F.array(decided(p)), lambda tops: _runs(p, tops)))[0][0]


def _runs(points: Column, tops: Column) -> Column:
    places = F.sequence(F.lit(0), F.size(tops) - 1)
    starts = F.filter(places, lambda i: (i == 0) | ~F.get(tops, i).eqNullSafe(F.get(tops, i - 1)))

    def runs(starts: Column) -> Column:
        return F.transform(starts, lambda s, k: F.struct(F.get(points, s).alias("f"), F.get(points, F.coalesce(F.get(starts, k + 1), F.size(tops))).alias("t"), F.get(tops, s).alias("e")))

    return F.filter(F.transform(F.array(starts), runs)[0], lambda p: p["e"].isNotNull())


def _pieces(spans: DataFrame, key: list[str]) -> DataFrame:
    """(key, f, t, e) of spans, laid out by key."""
    each = spans.groupBy(*key).agg(F.collect_list(F.struct("_from", "_to", "_event")).alias("_l"))
    return each.select(*key, F.inline(_laid_out(F.col("_l"))))


def _dealt(spans: DataFrame, most: int) -> DataFrame:
    """(edge_id, f, t, e) of edges with many events, by stretches of time."""
    # of equal intervals the latest decides
    spans = materialise(spans.groupBy("edge_id", "_from", "_to").agg(F.max("_event").alias("_event")), "spans")
    ends = spans.select("edge_id", F.explode(F.array("_from", "_to")).alias("_t")).distinct()
    ends = materialise(placed(ends, ["edge_id"], ["_t"]), "ends")
    bounds = ends.where(F.col("_at") % most == 0).select("edge_id", F.expr(f"_at div {most}").alias("_b"), F.col("_t").alias("_low"))
    upper = bounds.select("edge_id", (F.col("_b") - 1).alias("_b"), F.col("_low").alias("_high"))
    bounds = materialise(bounds.join(upper, ["edge_id", "_b"], "left").withColumn("_high", F.coalesce("_high", _forever())), "bounds")
    of = lambda name: ends.select("edge_id", F.col("_t").alias(f"_{name}"), F.col("_at").alias(f"_{name}_at"))
    at = spans.join(of("from"), ["edge_id", "_from"]).join(of("to"), ["edge_id", "_to"])
    at = at.withColumns({"_first": F.expr(f"_from_at div {most}"), "_last": F.expr(f"(_to_at - 1) div {most}")})
    at = materialise(at.select("edge_id", "_from", "_to", "_event", "_first", "_last"), "stretches")
    partly = at.withColumn("_b", F.explode(F.array_distinct(F.array("_first", "_last")))).join(bounds, ["edge_id", "_b"])
    partly = partly.select("edge_id", "_b", F.greatest("_from", "_low").alias("_from"), F.least("_to", "_high").alias("_to"), "_event")
    between = at.where("_last - _first > 1").select("edge_id", F.explode(cover(F.col("_first") + 1, F.col("_last") - 1, LEVELS)).alias("_node"), "_event")
    nodes = between.groupBy("edge_id", "_node").agg(F.max("_event").alias("_event"))
    wholly = bounds.withColumn("_node", F.explode(above(F.col("_b"), LEVELS))).join(nodes, ["edge_id", "_node"])
    wholly = wholly.groupBy("edge_id", "_b", "_low", "_high").agg(F.max("_event").alias("_event")).select("edge_id", "_b", F.col("_low").alias("_from"), F.col("_high").alias("_to"), "_event")
    clipped = partly.unionByName(wholly).groupBy("edge_id", "_b", "_from", "_to").agg(F.max("_event").alias("_event"))
    found = _pieces(clipped, ["edge_id", "_b"]).join(bounds, ["edge_id", "_b"])
    # pieces that a bound cut in two are joined again, event by event
    touch = (F.col("f") == F.col("_low")) | (F.col("t") == F.col("_high"))
    found = materialise(found.select("edge_id", "f", "t", "e", touch.alias("_touch")), "pieces")
    own = W.partitionBy("edge_id", "e").orderBy("f")
    cut = found.where("_touch").withColumn("_new", (~F.col("f").eqNullSafe(F.lag("t").over(own))).cast("long")).withColumn("_run", F.sum("_new").over(own))
    joined = cut.groupBy("edge_id", "e", "_run").agg(F.min("f").alias("f"), F.max("t").alias("t"))
    return found.where("NOT _touch").select("edge_id", "f", "t", "e").unionByName(joined.select("edge_id", "f", "t", "e"))


def timeline(events: DataFrame, *, commit_seq: int | Column | None = None, most: int = MOST) -> DataFrame:
    """The pieces of every edge's valid time: holds_from, holds_to (null: no end) and the columns of the event that decides there.

    Pieces of an edge are disjoint and as long as one event decides. Events
    with an empty interval or no start say nothing.
    """
    columns = [c for c in events.columns if c != "edge_id"]
    visible = snapshot(events, commit_seq=commit_seq)
    spans = _spans(visible)
    many = materialise(spans.groupBy("edge_id").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("edge_id"), "many")
    if many.isEmpty():
        found = _pieces(spans, ["edge_id"])
    else:
        few = _pieces(spans.join(many, "edge_id", "left_anti"), ["edge_id"])
        found = few.unionByName(_dealt(spans.join(many, "edge_id", "left_semi"), most))
    holds_to = F.when(F.col("t") < _forever(), F.col("t"))
    return found.where("e.op = 'assert'").select("edge_id", F.col("f").alias("holds_from"), holds_to.alias("holds_to"), *(F.col(f"e.{c}").alias(c) for c in columns))


def asked(events: DataFrame, questions: DataFrame, at: str, *, commit_seq: int | Column | None = None, spans: Domain | None = None) -> DataFrame:
    """Of each question (edge_id, at, ...) that an event speaks to: the event that decides (as decided), and spoken, how many events speak of that time.

    Questions repeat as they are. Each meets the events that hold its time by
    nodes of the time's tree, so an edge with very many events or questions
    is dealt by time.
    """
    told = _spans(snapshot(events, commit_seq=commit_seq))
    rows = questions.withColumn("_question", F.monotonically_increasing_id())
    rows = materialise(rows, "questions")
    inside = (F.col(at) >= F.col("_from")) & (F.col(at) < F.col("_to"))
    met = stab(rows.select("edge_id", at, "_question"), at, told, "_from", "_to", ["edge_id"], inside, spans or domain((rows, at), (told, "_from"), on=["edge_id"]))
    latest = met.groupBy("_question").agg(F.max("_event").alias("decided"), F.count("*").alias("spoken"))
    return rows.join(latest, "_question").drop("_question")
