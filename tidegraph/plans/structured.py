"""Structured requests: patterns, comparisons, grouping, having, order and paging as one call.

A request is plain data; run() maps it to DataFrame operations one to one.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegraph.operators import patterns as P
from tidegraph.operators.ontology import Ontology, subclasses
from tidegraph.operators.reasoning import reasoned
from tidegraph.operators.temporal import bucket
from tidegraph.sources.star import Graph

COMPARISONS = {"eq": operator.eq, "ne": operator.ne, "lt": operator.lt, "le": operator.le, "gt": operator.gt, "ge": operator.ge}


@dataclass(frozen=True)
class DateTime:
    """A date and time in ISO form; a bare string would be text."""

    text: str


@dataclass(frozen=True)
class Compare:
    """variable_field against a value; without a variable, the first pattern's."""

    field: str
    op: str
    value: object
    variable: str | None = None


@dataclass(frozen=True)
class Aggregate:
    function: str
    column: str
    name: str


@dataclass
class Request:
    patterns: Sequence[P.Pattern]
    #: variable -> (type, fields)
    properties: dict[str, tuple[str, Sequence[str]]] = field(default_factory=dict)
    #: relation -> edge columns to carry
    keep: dict[str, Sequence[str]] = field(default_factory=dict)
    filters: Sequence[Column] = ()
    where: Sequence[Compare] = ()
    #: name -> column, or (unit, column) for a date bucket
    group_keys: dict[str, str | tuple[str, str]] = field(default_factory=dict)
    aggregates: Sequence[Aggregate] = ()
    having: Column | None = None
    select: Sequence[str] = ()
    order_by: Sequence[str] = ()
    limit: int | None = None
    offset: int = 0
    max_solutions: int | None = None
    #: An ontology by which a type stands for all types below it, and patterns find edges that follow from its rules.
    reason: Ontology | None = None


def first_variable(patterns: Sequence[P.Pattern]) -> str:
    """The first pattern's subject variable, else its object, else the next pattern's; "entity" if there is none."""
    for subject, _, target in patterns:
        for term in (subject, target):
            if P.is_variable(term):
                return term[1:]
    return "entity"


def literal(value: object) -> Column:
    """bool before int; an integral float is a 64-bit integer; text is never taken for a date."""
    if isinstance(value, bool):
        return F.lit(value)
    if isinstance(value, (int, float)):
        return F.lit(int(value)).cast("long") if float(value).is_integer() else F.lit(float(value))
    if isinstance(value, DateTime):
        at = datetime.fromisoformat(value.text.replace("Z", "+00:00"))
        return F.lit((at - at.utcoffset() if at.utcoffset() else at).replace(tzinfo=None)).cast("timestamp_ntz")
    return F.lit(value)


#: Sums are exact to eight decimal places, so they don't depend on the order of addition.
_SUMMED = {"count": lambda c: F.count(c), "sum": lambda c: F.sum(F.col(c).cast("decimal(28,8)")).cast("double"), "avg": lambda c: F.avg(c), "min": lambda c: F.min(c), "max": lambda c: F.max(c)}


def run(graph: Graph, request: Request) -> DataFrame:
    below = subclasses(request.reason) if request.reason else {}
    if request.reason:
        graph = reasoned(graph, request.reason, [p[1] for p in request.patterns])
    kinds = {v: ([k for k in sorted(below.get(kind, {kind})) if k in graph.entities], fields) for v, (kind, fields) in request.properties.items()}
    out = P.match(graph, request.patterns, request.keep, kinds)
    default = first_variable(request.patterns)
    conditions = [*request.filters, *(COMPARISONS[c.op](F.col(f"{c.variable or default}_{c.field}"), literal(c.value)) for c in request.where)]
    for condition in conditions:
        out = out.where(condition)
    if request.aggregates:
        keys = [(F.col(k) if isinstance(k, str) else bucket(*k)).alias(name) for name, k in request.group_keys.items()]
        out = out.groupBy(*keys).agg(*(_SUMMED[a.function](a.column).alias(a.name) for a in request.aggregates))
    if request.having is not None:
        out = out.where(request.having)
    if request.select:
        out = out.select(*request.select)
    if request.max_solutions is not None and out.limit(request.max_solutions + 1).count() > request.max_solutions:
        raise ValueError(f"more than {request.max_solutions} solutions")
    if request.limit is not None or request.offset:
        return P.page(out, request.order_by, request.limit, request.offset)
    return out.orderBy(*request.order_by) if request.order_by else out
