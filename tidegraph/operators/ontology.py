"""Ontology reads and changes: counts, conformance, induction, resolution, additive definition."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.shared import materialise
from tidegraph.sources.star import Graph


@dataclass(frozen=True)
class Relation:
    domains: frozenset[str]
    ranges: frozenset[str]
    max_count: int | None = None


@dataclass(frozen=True)
class Ontology:
    version: int = 1
    types: dict[str, str | None] = field(default_factory=dict)
    relations: dict[str, Relation] = field(default_factory=dict)
    #: relation -> those that it is a case of
    subproperties: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: relation -> the one that leads back
    inverses: dict[str, str] = field(default_factory=dict)


class RestrictiveChange(ValueError):
    """A definition would forbid what is allowed now."""


#: The star schema's ontology; DOUBLES, PARENT and IN_NATION lead to one node each.
STAR = Ontology(
    types={k: None for k in ("REGION", "NATION", "CUSTOMER", "SUPPLIER", "PART", "ORDER")} | {"USER": None, "STATE": None},
    relations={
        "IN_REGION": Relation(frozenset({"NATION"}), frozenset({"REGION"}), 1),
        "IN_NATION": Relation(frozenset({"CUSTOMER", "SUPPLIER"}), frozenset({"NATION"}), 1),
        "PLACED": Relation(frozenset({"CUSTOMER"}), frozenset({"ORDER"})),
        "CONTAINS": Relation(frozenset({"ORDER"}), frozenset({"PART"}), 5),
        "SUPPLIES": Relation(frozenset({"SUPPLIER"}), frozenset({"PART"})),
        "HAS_STATE": Relation(frozenset({"USER"}), frozenset({"STATE"})),
    },
)


def as_table(spark: SparkSession, ontology: Ontology) -> DataFrame:
    rows = [(name, d, r, rel.max_count) for name, rel in sorted(ontology.relations.items()) for d in sorted(rel.domains) for r in sorted(rel.ranges)]
    return spark.createDataFrame(rows, "relation string, domain string, range string, max_count int")


def define(current: Ontology, wanted: Ontology) -> tuple[Ontology, bool]:
    """The ontology after a definition, and whether it changed; what narrows or drops is refused."""
    merged = evolve(current, wanted)[0]
    for name, old in current.relations.items():
        new = wanted.relations.get(name)
        if new and (not old.domains <= new.domains or not old.ranges <= new.ranges):
            raise RestrictiveChange(f"{name} would lose a domain or range")
        if new and new.max_count is not None and (old.max_count is None or new.max_count < old.max_count):
            raise RestrictiveChange(f"{name} would allow fewer edges")
    for name, parent in wanted.types.items():
        if current.types.get(name) is not None and parent != current.types[name]:
            raise RestrictiveChange(f"{name} would change its parent")
    changed = merged.version != current.version
    return (merged, True) if changed else (current, False)


def evolve(current: Ontology, wanted: Ontology) -> tuple[Ontology, bool]:
    """Widened by types, domains and ranges; the version rises only if something changed."""
    relations = dict(current.relations)
    for name, new in wanted.relations.items():
        old = relations.get(name)
        # a definition without a limit says nothing of the limit that there is
        most = new.max_count if old is None else old.max_count if old.max_count is None or new.max_count is None else max(old.max_count, new.max_count)
        relations[name] = Relation(new.domains | (old.domains if old else frozenset()), new.ranges | (old.ranges if old else frozenset()), most)
    types = current.types | {k: v for k, v in wanted.types.items() if k not in current.types}
    wider = {k: tuple(dict.fromkeys(current.subproperties.get(k, ()) + wanted.subproperties.get(k, ()))) for k in current.subproperties | wanted.subproperties}
    inverses = wanted.inverses | current.inverses
    changed = (types, relations, wider, inverses) != (current.types, current.relations, current.subproperties, current.inverses)
    return (Ontology(current.version + changed, types, relations, wider, inverses), changed)


def _kind(column: str) -> Column:
    return F.split(column, "/")[0]


def edge_counts(graph: Graph, ontology: Ontology) -> DataFrame:
    """Each relation of the ontology with its number of edges, 0 included."""
    names = graph.spark.createDataFrame([(n,) for n in sorted(ontology.relations)], "relation string")
    counts = graph.all_edges().groupBy("relation").agg(F.count("*").alias("edge_count"))
    # the ontology's side has a row for each relation, far below any broadcast bound
    return counts.join(F.broadcast(names), "relation", "right").na.fill(0, ["edge_count"])


def view(graph: Graph, ontology: Ontology, *, counts: bool = False) -> DataFrame:
    """Types with their parents, and relations with domains, ranges and limits; with the number of edges if asked for."""
    kinds = [("type", n, parent, None, None, None) for n, parent in sorted(ontology.types.items())]
    relations = [("relation", n, None, sorted(r.domains), sorted(r.ranges), r.max_count) for n, r in sorted(ontology.relations.items())]
    out = graph.spark.createDataFrame([*kinds, *relations], "family string, name string, parent string, domains array<string>, ranges array<string>, max_count int").withColumn("version", F.lit(ontology.version))
    if not counts:
        return out
    return out.join(edge_counts(graph, ontology).withColumnRenamed("relation", "name"), "name", "left")


def _failures(values: DataFrame, constraint: str, wrong: Column) -> DataFrame:
    return values.where(F.coalesce(wrong, F.lit(False))).select(F.col("id").alias("focus"), F.lit(constraint).alias("constraint"), F.col("value").cast("string").alias("value"))


@dataclass(frozen=True)
class Shape:
    """Constraints on one property of the entities of a type; what is None is not asked for."""

    kind: str
    property: str
    min_count: int | None = None
    datatype: str | None = None
    pattern: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    one_of: tuple | None = None


def check_shapes(graph: Graph, shapes: list[Shape]) -> DataFrame:
    """(focus, constraint, value) of every property value that breaks a shape; a missing value breaks min_count only."""
    found = []
    for s in shapes:
        own = graph.entities[s.kind].select("id", F.col(s.property).alias("value"))
        value, name = F.col("value"), f"{s.kind}.{s.property}"
        checks = {
            "minCount": value.isNull() if s.min_count else None,
            "datatype": value.isNotNull() & value.cast("string").try_cast(s.datatype).isNull() if s.datatype else None,
            "pattern": ~value.cast("string").rlike(s.pattern) if s.pattern else None,
            "minInclusive": value < s.min_value if s.min_value is not None else None,
            "maxInclusive": value > s.max_value if s.max_value is not None else None,
            "in": ~value.isin(list(s.one_of)) if s.one_of else None,
        }
        found.extend(_failures(own, f"{name} {kind}", wrong) for kind, wrong in checks.items() if wrong is not None)
    return reduce(lambda a, b: a.unionByName(b), found)


def conformance(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """Sources with more edges of a relation than it allows; reads the whole snapshot and blocks no write."""
    limits = rules.where("max_count IS NOT NULL").select("relation", "max_count").distinct()
    return edges.groupBy("src", "relation").agg(F.count("*").alias("n")).join(F.broadcast(limits), "relation").where("n > max_count")


def induce(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Relation signatures that the edges show and the ontology lacks, with their edges and largest out-degree."""
    per = edges.groupBy("relation", "src", _kind("src").alias("domain"), _kind("dst").alias("range")).agg(F.count("*").alias("n"))
    found = per.groupBy("relation", "domain", "range").agg(F.sum("n").alias("edges"), F.max("n").alias("max_out"))
    return found.join(known.select("relation", "domain", "range"), ["relation", "domain", "range"], "left_anti")


def normalised(column: str | Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(F.col(column) if isinstance(column, str) else column), r"[^0-9A-Za-z]+", " "))


def _pieces(length: Column, most: int) -> list[tuple[Column, Column]]:
    """Where the most + 1 pieces of a text of this length begin, from 0, and how long they are; the last ones take what is left over."""
    each = most + 1
    base, left = F.floor(length / each).cast("int"), (length % each).cast("int")
    return [(base * i + F.greatest(F.lit(0), F.lit(i - each) + left), base + (F.lit(i) >= F.lit(each) - left).cast("int")) for i in range(each)]


def _own_pieces(text: Column, most: int) -> Column:
    """The pieces of a name: its length, the piece's number and text."""
    n = F.length(text)
    return F.array(*(F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(text, start + 1, size).alias("piece")) for i, (start, size) in enumerate(_pieces(n, most))))


def _looked_up(text: Column, most: int) -> Column:
    """The pieces that names of about the text's length may have in common with it, at about the same place."""

    def of_length(n: Column) -> Column:
        found = []
        for i, (start, size) in enumerate(_pieces(n, most)):
            low, high = F.greatest(F.lit(0), start - most), F.least(F.length(text) - size, start + most)
            found.append(F.coalesce(_cuts(text, n, i, size, low, high), F.array().cast("array<struct<n: int, i: int, piece: string>>")))
        return F.flatten(F.array(*found))

    lengths = F.sequence(F.greatest(F.lit(0), F.length(text) - most), F.length(text) + most)
    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def _cuts(text: Column, n: Column, i: int, size: Column, low: Column, high: Column) -> Column:
    return F.when(low <= high, F.transform(F.sequence(low, high), lambda at: F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(text, at + 1, size).alias("piece"))))


def resolve(mentions: DataFrame, names: DataFrame, most: int = 2) -> DataFrame:
    """Each mention's entity by normalised name; those without one by the least edit distance up to most.

    A name is cut into most + 1 pieces, of which so many edits leave one whole,
    moved by at most so many places. So a name is a row for each piece,
    however long it is, and a mention looks up a number of pieces that most
    alone decides; they meet by an equality of length, piece and its number.
    """
    m = mentions.select("mention", normalised("mention").alias("_key")).distinct()
    n = names.select("id", normalised("name").alias("_key"))
    exact = m.join(n, "_key").groupBy("mention").agg(F.min("id").alias("id")).withColumn("distance", F.lit(0))
    rest = m.join(exact, "mention", "left_anti").select("mention", F.col("_key").alias("_m"), F.explode(_looked_up(F.col("_key"), most)).alias("_piece"))
    near = rest.join(n.select("id", F.col("_key").alias("_n"), F.explode(_own_pieces(F.col("_key"), most)).alias("_piece")), "_piece").drop("_piece").distinct()
    near = near.withColumn("distance", F.levenshtein("_m", "_n", most)).where(F.col("distance").between(0, most))
    best = near.groupBy("mention").agg(F.min(F.struct("distance", "id")).alias("_b")).select("mention", "_b.id", "_b.distance")
    return exact.unionByName(best)


#: Letters of the pieces by which names are found.
GRAM = 3
#: Names, and texts, that a task holds at most.
NAMES, TEXTS = 50_000, 100_000
#: Parts into which names are dealt where that leaves enough of them in each.
DEALT, FEW_NAMES = 8, 2_000


def _grams(text: Column) -> Column:
    """The different runs of GRAM letters of a text with a space around it."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - GRAM + 1)), lambda i: F.substring(padded, i, F.lit(GRAM))))


def name_index(names: DataFrame) -> DataFrame:
    """(gram, id, weight, norm): the names' runs of letters, with how much one says, in millionths, and a name's whole weight.

    A run says the logarithm of how many names there are for each that has it.
    """
    # names are dealt by id before they become rows; what Spark takes for the size of these is that of names' files
    rows = names.select("id", normalised("name").alias("_key")).repartition("id").select("id", F.explode(_grams(F.col("_key"))).alias("gram")).distinct()
    total = names.agg(F.count("*").alias("_total"))
    weights = rows.groupBy("gram").agg(F.count("*").alias("_n")).crossJoin(F.broadcast(total))
    weights = weights.select("gram", F.floor(F.log(1 + F.col("_total") / F.col("_n")) * 1_000_000).cast("long").alias("weight"))
    # normalised names have 37 letters, so there are some 50,000 runs at most
    weighed = rows.join(F.broadcast(weights), "gram")
    return weighed.select("gram", "id", "weight", F.sum("weight").over(W.partitionBy("id")).alias("norm"))


def ranked_search(texts: DataFrame, index: DataFrame, most: int = 10) -> DataFrame:
    """For each text (text), the names that share the most of its runs of letters by weight: text, id, shared, rank; at most so many, ties by id.

    shared is the weight in common over the name's and the text's own. Runs
    that no name has count nothing; texts meet names by equal runs only. Names
    of the same runs are met once, by the least of their ids, and told apart
    in the end, so copies of names cost no more than one of each. Names are
    dealt into parts and texts into blocks; a task holds one of each and keeps
    the best of each text, so pairs of texts and names never travel.
    """
    alike = materialise(_of_equal_runs(index, most, more=["_runs", "_norm"]), "alike")
    firsts = alike.where(F.col("id") == F.col("_first")).select("id", "_runs", "_norm")
    asked = texts.select("text", F.explode(_grams(normalised("text"))).alias("gram")).distinct()
    known = asked.join(F.broadcast(index.groupBy("gram").agg(F.max("weight").alias("weight"))), "gram")
    told = known.groupBy("text").agg(F.collect_list(F.struct("gram", "weight")).alias("_known"), F.sum("weight").alias("_own"))
    n = firsts.count()
    parts, blocks = max(1, min(DEALT, math.ceil(n / FEW_NAMES)), math.ceil(n / NAMES)), max(1, math.ceil(texts.count() / TEXTS))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    there = firsts.withColumn("_p", deal("id", parts)).withColumn("_b", every(blocks))
    told = told.withColumn("_b", deal("text", blocks)).withColumn("_p", every(parts))
    met = there.groupBy("_b", "_p").cogroup(told.groupBy("_b", "_p")).applyInArrow(_best_names(most), "text string, id string, shared long")
    best = W.partitionBy("text").orderBy(F.desc("shared"), "id")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    # the best names are among those that are like the best first ones
    found = ranked(met).select("text", F.col("id").alias("_first"), "shared")
    return ranked(found.join(alike.select("_first", "id").hint("merge"), "_first")).select("text", "id", "shared", "rank")


def _best_names(most: int):
    """Of a part of the names, those that each text of a block shares the most with."""

    def best(names: pa.Table, texts: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        if names.num_rows and texts.num_rows:
            # from now on a lower place is a lesser id
            names = names.sort_by("id")
            runs = names.column("_runs").combine_chunks()
            told = runs.flatten().dictionary_encode()
            codes = told.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            holders = np.repeat(np.arange(len(runs)), pc.list_value_length(runs).to_numpy(zero_copy_only=False))[order]
            ends = np.searchsorted(codes[order], np.arange(len(told.dictionary) + 1))
            norm, ids = names.column("_norm").to_numpy(), names.column("id").to_pylist()
            known = texts.column("_known").combine_chunks()
            asked = known.flatten()
            runs_asked = pc.fill_null(pc.index_in(asked.field("gram"), value_set=told.dictionary), -1).to_numpy(zero_copy_only=False)
            weights = asked.field("weight").to_numpy(zero_copy_only=False)
            stops = np.cumsum(pc.list_value_length(known).to_numpy(zero_copy_only=False))
            for text, own, stop, size in zip(texts.column("text").to_pylist(), texts.column("_own").to_pylist(), stops.tolist(), np.diff(stops, prepend=0).tolist(), strict=True):
                both = np.zeros(len(ids), np.int64)
                for run, weight in zip(runs_asked[stop - size : stop].tolist(), weights[stop - size : stop].tolist(), strict=True):
                    if run >= 0:
                        both[holders[ends[run] : ends[run + 1]]] += weight
                some = np.flatnonzero(both)
                shared = both[some] * 1_000_000 // (norm[some] + own - both[some])
                if len(some) > most:
                    near = shared >= np.partition(shared, -most)[-most]
                    some, shared = some[near], shared[near]
                at = np.argsort(-shared, kind="stable")[:most]
                found[0] += [text] * len(at)
                found[1] += [ids[i] for i in some[at]]
                found[2] += shared[at].tolist()
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.table([pa.array(x, k) for x, k in zip(found, kinds, strict=True)], ["text", "id", "shared"])

    return best


def _of_equal_runs(index: DataFrame, most: int, more: list[str] | None = None) -> DataFrame:
    """(_first, id): of names that have the same runs, the first so many by id, each with the least id; more is _runs or _norm."""
    runs = index.groupBy("id").agg(F.sort_array(F.collect_set("gram")).alias("_runs"), F.max("norm").alias("_norm"))
    place = F.row_number().over(W.partitionBy("_runs").orderBy("id"))
    some = runs.withColumn("_place", place).where(F.col("_place") <= most)
    return some.select(F.min("id").over(W.partitionBy("_runs")).alias("_first"), "id", *(more or []))


def search(names: DataFrame, text: str) -> DataFrame:
    """Names that contain the text, whatever the case, closest in length first."""
    key = normalised("name")
    found = names.where(key.contains(text.lower()))
    return found.withColumn("distance", F.levenshtein(key, F.lit(text.lower()))).orderBy("distance", "id")


def subclasses(ontology: Ontology) -> dict[str, set[str]]:
    """Each type with all types below it, itself included."""
    below: dict[str, set[str]] = {t: {t} for t in ontology.types}
    for name in ontology.types:
        parent = ontology.types[name]
        while parent is not None and name not in below.setdefault(parent, {parent}):
            below[parent].add(name)
            parent = ontology.types.get(parent)
    return below
