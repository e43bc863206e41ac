"""The star schema's tables seen as a graph, one lazy DataFrame for each relation and entity type.

A pattern on one relation reads that relation's table alone, so the split by
relation works like partition pruning; nothing is copied or unioned up front.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Steps of the chain NEXT.
CHAIN = 160


def entity(kind: str, key: str | Column) -> Column:
    """An entity's id: its type and key."""
    return F.concat(F.lit(f"{kind}/"), (F.col(key) if isinstance(key, str) else key).cast("string"))


@dataclass(frozen=True)
class Part:
    """Rows of one table that are edges: the types of both ends, and the columns that hold their keys."""

    rows: DataFrame
    src_kind: str
    src_key: str
    dst_kind: str
    dst_key: str
    #: column of the edge -> column of rows
    more: tuple[tuple[str, str], ...] = ()

    def edges(self) -> DataFrame:
        """(src, dst, ...) with ids as text."""
        return self.rows.select(entity(self.src_kind, self.src_key).alias("src"), entity(self.dst_kind, self.dst_key).alias("dst"), *(F.col(c).alias(n) for n, c in self.more))


@dataclass
class Graph:
    """Edges by relation (src, dst and the edge's own columns) and entities by type (id and typed properties).

    A relation is a frame with ids as text, or parts with types and native
    keys. Patterns on parts filter and join native keys and drop parts whose
    types don't fit; ids become text in what they return.
    """

    spark: SparkSession
    edges: dict[str, DataFrame] = field(default_factory=dict)
    entities: dict[str, DataFrame] = field(default_factory=dict)
    parts: dict[str, list[Part]] = field(default_factory=dict)
    #: type -> (table, key column, property -> column)
    tables: dict[str, tuple[DataFrame, str, dict[str, str]]] = field(default_factory=dict)

    def scan(self, relation: str) -> DataFrame:
        return self.edges[relation]

    def add(self, relation: str, *parts: Part) -> None:
        self.parts[relation] = list(parts)
        frames = [p.edges() for p in parts]
        self.edges[relation] = reduce(lambda a, b: a.unionByName(b), frames)

    def keys(self, relation: str) -> DataFrame:
        """(src, dst) as native keys, for a relation whose ends have one type each."""
        (part,) = self.parts[relation]
        return part.rows.select(F.col(part.src_key).cast("long").alias("src"), F.col(part.dst_key).cast("long").alias("dst"))

    def named(self, relation: str, pairs: DataFrame) -> DataFrame:
        """Native pairs of keys() with ids as text."""
        (part,) = self.parts[relation]
        return pairs.select(entity(part.src_kind, "src").alias("src"), entity(part.dst_kind, "dst").alias("dst"))

    def all_edges(self, relations: list[str] | None = None) -> DataFrame:
        """(src, relation, dst) of the relations named, or of all."""
        frames = [self.edges[r].select("src", F.lit(r).alias("relation"), "dst") for r in relations or sorted(self.edges)]
        return reduce(lambda a, b: a.unionByName(b), frames)

    def all_entities(self) -> DataFrame:
        frames = [df.select(F.lit(kind).alias("type"), "id") for kind, df in sorted(self.entities.items())]
        return reduce(lambda a, b: a.unionByName(b), frames)


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")}
    g = Graph(spark)
    for kind, name, key in (("REGION", "region", "r_regionkey"), ("NATION", "nation", "n_nationkey"), ("CUSTOMER", "customer", "c_custkey"), ("SUPPLIER", "supplier", "s_suppkey"), ("PART", "part", "p_partkey"), ("ORDER", "orders", "o_orderkey")):
        # properties without the table's prefix
        fields = {c.split("_", 1)[1] if key.split("_")[0] == c.split("_")[0] else c: c for c in t[name].columns}
        g.tables[kind] = (t[name], key, fields)
        g.entities[kind] = t[name].select(entity(kind, key).alias("id"), *(F.col(c).alias(n) for n, c in fields.items()))

    g.add("IN_REGION", Part(t["nation"], "NATION", "n_nationkey", "REGION", "n_regionkey"))
    g.add("IN_NATION", Part(t["customer"], "CUSTOMER", "c_custkey", "NATION", "c_nationkey"), Part(t["supplier"], "SUPPLIER", "s_suppkey", "NATION", "s_nationkey"))
    g.add("PLACED", Part(t["orders"], "CUSTOMER", "o_custkey", "ORDER", "o_orderkey", (("valid_from", "o_orderdate"),)))
    g.add("CONTAINS", Part(t["lineitem"], "ORDER", "l_orderkey", "PART", "l_partkey", (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"), ("valid_from", "l_shipdate"))))
    g.add("SUPPLIES", Part(t["lineitem"].select("l_suppkey", "l_partkey").distinct(), "SUPPLIER", "l_suppkey", "PART", "l_partkey"))
    g.add("HAS_STATE", Part(t["events"], "USER", "user_id", "STATE", "event_type", (("valid_from", "ts"), ("event_id", "event_id"), ("value", "value"))))
    g.add("DOUBLES", Part(t["nation"].select("n_nationkey", ((2 * F.col("n_nationkey")) % 25).alias("double")), "NATION", "n_nationkey", "NATION", "double"))
    half = F.floor(F.col("p_partkey") / 2).cast("long")
    g.add("PARENT", Part(t["part"].where("p_partkey > 0").select("p_partkey", half.alias("parent")), "PART", "p_partkey", "PART", "parent"))
    # a chain over the first part keys, deeper than a usual limit of recursion
    g.add("NEXT", Part(t["part"].where(F.col("p_partkey") <= CHAIN).select("p_partkey", (F.col("p_partkey") + 1).alias("next")), "STEP", "p_partkey", "STEP", "next"))
    return g


def edge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append-only log of CONTAINS: a line is asserted with its order's commit; a returned one is retracted 30 days on."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    key = F.md5(F.concat_ws("|", *parts, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.col("l_quantity").cast("int").cast("string")))
    commit = 1 + F.floor(F.col("l_orderkey") / 100).cast("long")
    rows = lines.select(
        key.alias("edge_id"), entity("ORDER", "l_orderkey").alias("src"), F.lit("CONTAINS").alias("relation"), entity("PART", "l_partkey").alias("dst"),
        commit.alias("commit_seq"), F.col("l_shipdate").alias("valid_from"), "l_returnflag", F.col("l_quantity").cast("int").alias("quantity"),
    )
    last = rows.agg(F.max("commit_seq").alias("last"))
    asserted = rows.select(*rows.columns[:6], F.lit("assert").alias("op"), F.lit(0).alias("event_ord"), "quantity")
    retracted = rows.where("l_returnflag = 'R'").crossJoin(F.broadcast(last)).select(
        "edge_id", "src", "relation", "dst", (F.col("commit_seq") + F.col("last")).alias("commit_seq"),
        F.expr("valid_from + INTERVAL 30 DAYS").alias("valid_from"), F.lit("retract").alias("op"), F.lit(1).alias("event_ord"), "quantity",
    )
    return asserted.unionByName(retracted)
