"""Reads about entities: neighbourhood, sample, metadata, detail, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.operators import temporal
from tidegraph.sources.star import Graph


def neighbourhood(edges: DataFrame, centres: DataFrame, *, most: int = 1000, order: str = "edge_id") -> DataFrame:
    """Out- and in-edges of each centre (id), at most so many in each direction, with what there are in all.

    truncated says where a direction was cut. A hot centre's edges are ranked
    with a group limit below the shuffle, counts come from a combined
    aggregation.
    """
    if not 1 <= most <= 10_000:
        raise ValueError("most must be from 1 to 10000")
    ends = (("out", "src", "dst"), ("in", "dst", "src"))
    frames = [edges.join(centres.select(F.col("id").alias(a)), a, "left_semi").select(F.col(a).alias("id"), F.lit(way).alias("direction"), "relation", F.col(b).alias("other"), order) for way, a, b in ends]
    both = frames[0].unionByName(frames[1])
    totals = both.groupBy("id", "direction").agg(F.count("*").alias("total"))
    ranked = both.withColumn("rank", F.row_number().over(W.partitionBy("id", "direction").orderBy(order, "other"))).where(F.col("rank") <= most)
    return ranked.join(totals, ["id", "direction"]).withColumn("truncated", F.col("total") > most)


def type_counts(graph: Graph) -> DataFrame:
    """Exact number of entities of each type."""
    return graph.all_entities().groupBy("type").agg(F.count("*").alias("entities"))


def type_sample(graph: Graph, kind: str, most: int) -> DataFrame:
    """The same entities on every run: the first by a hash of the id."""
    order = F.md5(F.col("id").cast("binary"))
    return graph.entities[kind].select("id", order.alias("order")).orderBy("order", "id").limit(most)


def metadata(events: DataFrame) -> DataFrame:
    """Per entity: its last commit and how many events touch it."""
    touched = events.select(F.explode(F.array("src", "dst")).alias("id"), "commit_seq")
    return touched.groupBy("id").agg(F.max("commit_seq").alias("last_commit"), F.count("*").alias("events"))


def _listed(rows: DataFrame, name: str, order: list[str], most: int) -> DataFrame:
    """(id, name, name_total): each id's first most rows by order as a sorted array, and how many there are; ranked with a group limit below the shuffle."""
    others = [c for c in rows.columns if c != "id"]
    totals = rows.groupBy("id").agg(F.count("*").alias(f"{name}_total"))
    first = rows.withColumn("_rank", F.row_number().over(W.partitionBy("id").orderBy(*order))).where(F.col("_rank") <= most)
    lists = first.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("_rank", *others))).alias("_rows"))
    return totals.join(lists.select("id", F.transform("_rows", lambda r: F.struct(*(r[c].alias(c) for c in others))).alias(name)), "id")


def detail(events: DataFrame, properties: DataFrame, *, commit_seq: int | None = None, valid_time: object = None, observations: DataFrame | None = None, most: int = 1000) -> DataFrame:
    """One row per entity of properties (id, ...), as of a commit and valid time.

    Its properties and metadata, its out- and in-edges of that state, the
    history of the events that touch it, and its observations (id, at, text).
    Lists hold the first most rows, edges by relation, other end and edge_id,
    history and observations oldest first; the totals count all.
    """
    if not 1 <= most <= 10_000:
        raise ValueError("most must be from 1 to 10000")
    seen = temporal.snapshot(events, commit_seq=commit_seq, valid_time=valid_time)
    now = temporal.state(events, commit_seq=commit_seq, valid_time=valid_time)
    wanted = properties.select("id").distinct()
    ends = (("out", "src", "dst"), ("in", "dst", "src"))
    of = lambda df, a: df.join(wanted.select(F.col("id").alias(a)), a, "left_semi")
    found = properties.join(metadata(seen).join(wanted, "id", "left_semi"), "id", "left").na.fill(0, ["events"])
    for name, a, b in ends:
        edges = of(now, a).select(F.col(a).alias("id"), "relation", F.col(b).alias("other"), "edge_id")
        found = found.join(_listed(edges, f"{name}_edges", ["relation", "other", "edge_id"], most), "id", "left")
    touched = [of(seen, a).select(F.col(a).alias("id"), F.lit(name).alias("direction"), "commit_seq", "event_ord", "op", "relation", F.col(b).alias("other"), "edge_id") for name, a, b in ends]
    found = found.join(_listed(touched[0].unionByName(touched[1]), "history", ["commit_seq", "event_ord", "edge_id", "direction"], most), "id", "left")
    names = ["out_edges", "in_edges", "history"]
    if observations is not None:
        found = found.join(_listed(observations.select("id", "at", "text"), "observations", ["at", "text"], most), "id", "left")
        names.append("observations")
    return found.na.fill(0, [f"{n}_total" for n in names])


def _counted(rows: DataFrame, name: str, order: list[str], most: int) -> DataFrame:
    """What _listed() gives, for ids that have few rows each: one shuffle, since rows are counted where they are ranked; those of one id meet in one task, which spills them."""
    others, each = [c for c in rows.columns if c != "id"], W.partitionBy("id")
    counted = rows.where("id IS NOT NULL").withColumn("_total", F.count(F.lit(1)).over(each))
    first = counted.withColumn("_rank", F.row_number().over(each.orderBy(*order))).where(F.col("_rank") <= most)
    lists = first.groupBy("id").agg(F.max("_total").alias(f"{name}_total"), F.array_sort(F.collect_list(F.struct("_rank", *others))).alias("_rows"))
    return lists.select("id", f"{name}_total", F.transform("_rows", lambda r: F.struct(*(r[c].alias(c) for c in others))).alias(name))


def why(events: DataFrame, evidence: DataFrame, *, most: int = 1000) -> DataFrame:
    """Per edge: the events that made it what it is, oldest first, and the evidence (edge_id, episode, text) for it; lists as in detail()."""
    lineage = _counted(events.select(F.col("edge_id").alias("id"), "commit_seq", "event_ord", "op", "valid_from"), "lineage", ["commit_seq", "event_ord"], most)
    grounds = _counted(evidence.select(F.col("edge_id").alias("id"), "episode", "text"), "evidence", ["episode", "text"], most)
    return lineage.join(grounds, "id", "left").na.fill(0, ["evidence_total"]).withColumnRenamed("id", "edge_id")


def summary(graph: Graph) -> DataFrame:
    """Entities by type and edges by relation."""
    types = graph.all_entities().groupBy(F.col("type").alias("name")).agg(F.count("*").alias("n")).select(F.lit("type").alias("family"), "name", "n")
    relations = graph.all_edges().groupBy(F.col("relation").alias("name")).agg(F.count("*").alias("n")).select(F.lit("relation").alias("family"), "name", "n")
    return types.unionByName(relations)
