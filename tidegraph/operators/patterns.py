"""Graph patterns and the algebra over their solutions.

A solution set is a DataFrame with a column for each variable; a null is an
unbound variable. Each function composes DataFrame operations, so Catalyst
orders and executes them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegraph.operators.ranks import placed
from tidegraph.sources.star import Graph, entity

#: subject, relation, object; a term that starts with "?" is a variable
Pattern = tuple[str, str, str]


def is_variable(term: str) -> bool:
    return term.startswith("?")


def _filtered(df: DataFrame, column: str, kind: str | None, term: str) -> DataFrame | None:
    """df where the end is a constant, compared with the native key so that the scan can prune; None where the type does not fit."""
    if kind is None:
        return df.where(F.col(column) == term)
    own, _, key = term.partition("/")
    if own != kind:
        return None
    if dict(df.dtypes)[column] in ("int", "bigint"):
        # a key that is not written as a number is written, or is larger than any, is no key of the table
        fits = re.fullmatch("0|-?[1-9][0-9]{0,18}", key) and -(1 << 63) <= int(key) < 1 << 63
        return df.where(F.col(column) == int(key)) if fits else None
    return df.where(F.col(column) == key)


class _Scan:
    """One pattern over one part: the frame, and for each variable its type (None: text) and column."""

    def __init__(self, df: DataFrame, ends: dict[str, tuple[str | None, str]], keep: Sequence[Column]):
        self.df, self.ends, self.keep = df, ends, keep

    def solutions(self, native: set[str]) -> DataFrame:
        columns = [(F.col(c).cast("long") if v in native and dict(self.df.dtypes)[c] in ("int", "bigint") else F.col(c) if v in native or kind is None else entity(kind, c)).alias(v) for v, (kind, c) in self.ends.items()]
        return self.df.select(*columns, *self.keep)


def _scans(graph: Graph, pattern: Pattern, keep: Sequence[str]) -> list[_Scan]:
    subject, relation, target = pattern
    parts = graph.parts.get(relation)
    sources = [(p.rows, (p.src_kind, p.src_key), (p.dst_kind, p.dst_key), dict(p.more)) for p in parts] if parts else [(graph.scan(relation), (None, "src"), (None, "dst"), {k: k for k in keep})]
    found = []
    for df, src, dst, more in sources:
        for term, (kind, column) in ((subject, src), (target, dst)):
            if df is not None and not is_variable(term):
                df = _filtered(df, column, kind, term)
        if df is None or (is_variable(subject) and subject == target and src[0] != dst[0]):
            continue
        if is_variable(subject) and subject == target:
            df = df.where(F.col(src[1]) == F.col(dst[1]))
        ends = {t[1:]: end for t, end in ((subject, src), (target, dst)) if is_variable(t)}
        found.append(_Scan(df, ends, [F.col(more[k]).alias(k) for k in keep]))
    return found


def scan(graph: Graph, pattern: Pattern, keep: Sequence[str] = ()) -> DataFrame:
    """Solutions of one pattern; keep names columns of the edge to carry along."""
    return match(graph, [pattern], {pattern[1]: keep})


def _weight(pattern: Pattern) -> int:
    return sum(is_variable(t) for t in (pattern[0], pattern[2]))


def _types(scans: list[list[_Scan]], kinds: dict[str, set[str]]) -> None:
    """Narrows kinds to the types that each variable can have in all patterns, and takes out scans of other types."""
    changed = True
    while changed:
        changed = False
        for group in scans:
            for v in {v for s in group for v in s.ends}:
                own = {s.ends[v][0] for s in group}
                narrower = kinds.get(v, own) & own
                if None not in own and narrower != kinds.get(v):  # a frame of text ids can have any type
                    kinds[v], changed = narrower, True
            kept = [s for s in group if all(kind is None or kind in kinds[v] for v, (kind, _) in s.ends.items())]
            changed |= len(kept) < len(group)
            group[:] = kept


#: The most solutions of one side of a product of unconnected patterns.
PRODUCT = 10_000


def match(graph: Graph, patterns: Sequence[Pattern], keep: dict[str, Sequence[str]] | None = None, properties: dict[str, tuple[Sequence[str], Sequence[str]]] | None = None) -> DataFrame:
    """The natural join of the patterns' solutions, and of properties (variable -> types, fields), which add variable_field columns.

    The types of the ends tell which type a variable has; parts of relations
    with other types aren't read. Where a variable has one type, its native
    key is filtered and joined, and its id is made at the end. Patterns with
    constants come first, and each next one shares a variable with those
    before. Only where none does is there a product, and then one side must
    have at most PRODUCT solutions, which is checked. keep maps relations to
    edge columns to carry along.
    """
    keep, properties = keep or {}, properties or {}
    left = sorted(patterns, key=_weight)
    scans = [_scans(graph, p, keep.get(p[1], ())) for p in left]
    kinds = {v: set(types) for v, (types, _) in properties.items()}
    _types(scans, kinds)
    if not all(scans):
        return _none(graph, left, keep, properties)
    as_text = {v for group in scans for s in group for v, (kind, _) in s.ends.items() if kind is None}
    native = {v for v, own in kinds.items() if len(own) == 1 and v not in as_text}
    variables = {v for group in scans for s in group for v in s.ends}
    frames = [reduce(lambda a, b: a.unionByName(b), [s.solutions(native) for s in group]) for group in scans]
    out = frames.pop(0)
    while frames:
        bound = set(out.columns)
        at = next((i for i, f in enumerate(frames) if bound & variables & set(f.columns)), None)
        if at is None:
            out = _product(out, frames.pop(0))
            continue
        found = frames.pop(at)
        out = out.join(found, [c for c in found.columns if c in bound & variables])
    for v, (types, fields) in properties.items():
        if v not in native:
            out = with_properties(graph, out, v, [k for k in types if k in kinds[v]], fields)
        elif fields:
            table, key, columns = graph.tables[next(iter(kinds[v]))]
            number = dict(table.dtypes)[key] in ("int", "bigint")
            out = out.join(table.select((F.col(key).cast("long") if number else F.col(key)).alias(v), *(F.col(columns[f]).alias(f"{v}_{f}") for f in fields)), v)
    return out.select(*(entity(next(iter(kinds[c])), c).alias(c) if c in native else c for c in out.columns))


def _none(graph: Graph, patterns: Sequence[Pattern], keep: dict[str, Sequence[str]], properties: dict) -> DataFrame:
    """No solutions, with the columns that match() would give: a constant or variable has a type that its relation never has."""
    columns = {t[1:]: F.lit(None).cast("string") for p in patterns for t in (p[0], p[2]) if is_variable(t)}
    for p in patterns:
        columns |= {k: F.lit(None).cast(graph.scan(p[1]).schema[k].dataType) for k in keep.get(p[1], ())}
    for v, (types, fields) in properties.items():
        columns |= {f"{v}_{f}": F.lit(None).cast(graph.entities[types[0]].schema[f].dataType) for f in fields}
    return graph.spark.range(0).select(*(c.alias(n) for n, c in columns.items()))


def _product(one: DataFrame, other: DataFrame) -> DataFrame:
    """Every solution of one with every one of other; the smaller side is broadcast after its size is checked."""
    for small, large in ((other, one), (one, other)):
        if small.limit(PRODUCT + 1).count() <= PRODUCT:
            return large.crossJoin(F.broadcast(small))
    raise ValueError(f"patterns that share no variable, with over {PRODUCT} solutions on both sides")


def with_properties(graph: Graph, solutions: DataFrame, variable: str, kind: str | Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Adds variable_field columns; solutions whose variable is of another type have none of them and go.

    Of several types, all have the fields. Without fields only the type is
    asked for, and the id tells it.
    """
    kinds = [kind] if isinstance(kind, str) else list(kind)
    if not fields:
        return solutions.where(F.split(variable, "/", 2)[0].isin(kinds)) if all(k in graph.tables for k in kinds) else solutions.join(reduce(lambda a, b: a.unionByName(b), [graph.entities[k].select(F.col("id").alias(variable)) for k in kinds]), variable)
    props = [graph.entities[k].select(F.col("id").alias(variable), *(F.col(f).alias(f"{variable}_{f}") for f in fields)) for k in kinds]
    return solutions.join(reduce(lambda a, b: a.unionByName(b), props), variable)


def optional(left: DataFrame, right: DataFrame, on: Sequence[str], condition: Column | None = None) -> DataFrame:
    """OPTIONAL: left join, with the inner FILTER as part of the join condition."""
    if condition is None:
        return left.join(right, list(on), "left")
    renamed = reduce(lambda d, c: d.withColumnRenamed(c, f"_r_{c}"), on, right)
    keys = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"_r_{c}") for c in on))
    return left.join(renamed, keys & condition, "left").drop(*(f"_r_{c}" for c in on))


def union(*parts: DataFrame) -> DataFrame:
    """UNION: all solutions, variables that a part lacks being unbound there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def minus(left: DataFrame, right: DataFrame, *, always_bound: bool = False) -> DataFrame:
    """MINUS: solutions with no compatible one that shares a bound variable; without shared variables left stays.

    A variable that either side leaves unbound does not count. So left is
    split by which shared variables it binds, and right by which of those it
    binds too; each such pair is an anti-join on what both bind. always_bound
    says that no shared variable is ever unbound, which leaves one anti-join.
    """
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        return left
    right = right.select(*shared)
    if always_bound:
        return left.join(right, shared, "left_anti")

    def bound(df: DataFrame, yes: Sequence[str], no: Sequence[str]) -> DataFrame:
        return reduce(lambda d, c: d.where(F.col(c).isNull()), no, reduce(lambda d, c: d.where(F.col(c).isNotNull()), yes, df))

    def subsets(of: Sequence[str]) -> list[tuple[str, ...]]:
        return [s for n in range(len(of) + 1) for s in combinations(of, n)]

    parts = []
    for own in subsets(shared):
        part = bound(left, own, [c for c in shared if c not in own])
        for both in subsets(own)[1:]:
            part = part.join(bound(right, both, [c for c in own if c not in both]).select(*both), list(both), "left_anti")
        parts.append(part.select(*left.columns))
    return reduce(lambda a, b: a.unionByName(b), parts)


def exists(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left_semi")


def not_exists(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """NOT EXISTS; without variables to correlate, right decides for all of left."""
    if on:
        return left.join(right, list(on), "left_anti")
    return left.where(F.lit(right.isEmpty()))


def values(graph: Graph, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """VALUES: inline solutions; None is UNDEF."""
    return graph.spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in columns))


def compatible_join(left: DataFrame, right: DataFrame, shared: Sequence[str]) -> DataFrame:
    """Join on shared variables of which either side may be unbound.

    For one variable at a time the sides are split by whether it is bound:
    bound rows meet in an equi-join, and only rows where it is unbound meet
    all of the other side; where nothing is bound, one side must have at most
    PRODUCT rows, which is checked. A plain condition with OR would make every row
    meet every row.
    """
    if not shared:
        return _product(left, right)
    other = reduce(lambda d, c: d.withColumnRenamed(c, f"_r_{c}"), shared, right)

    def joined(a: DataFrame, b: DataFrame, rest: list[str], equal: list[str]) -> DataFrame:
        if not rest:
            keys = [F.col(c) == F.col(f"_r_{c}") for c in equal]
            return a.join(b, reduce(lambda x, y: x & y, keys)) if keys else _product(a, b)
        c, *more = rest
        both = joined(a.where(F.col(c).isNotNull()), b.where(F.col(f"_r_{c}").isNotNull()), more, [*equal, c])
        unbound = joined(a.where(F.col(c).isNull()), b, more, equal)
        half = joined(a.where(F.col(c).isNotNull()), b.where(F.col(f"_r_{c}").isNull()), more, equal)
        return both.unionByName(unbound).unionByName(half)

    out = joined(left, other, list(shared), [])
    return out.select(*(F.coalesce(c, f"_r_{c}").alias(c) if c in shared else c for c in left.columns), *(c for c in right.columns if c not in shared))


def ask(solutions: DataFrame) -> DataFrame:
    """ASK: one row that says whether there is a solution; a limit of one row suffices."""
    return solutions.limit(1).agg((F.count("*") > 0).alias("answer"))


def page(solutions: DataFrame, order: Sequence[Column | str], limit: int | None = None, offset: int = 0) -> DataFrame:
    """LIMIT and OFFSET after an order; without one, that of all columns, so that pages are the same whenever they are asked for."""
    order = list(order or solutions.columns)
    if offset and limit is None:
        # Spark's own offset without a limit puts all rows through one task
        return placed(solutions, [], order, "_place").where(F.col("_place") >= offset).drop("_place").orderBy(*order)
    found = solutions.orderBy(*order)
    found = found.offset(offset) if offset else found
    return found if limit is None else found.limit(limit)


def page_facts(total: int, limit: int, offset: int) -> dict[str, object]:
    """What a page says about itself; next_offset only while there is more."""
    returned = max(0, min(limit, total - offset))
    more = offset + returned < total
    return {"returned": returned, "total": total, "offset": offset, "limit": limit, "has_more": more} | ({"next_offset": offset + returned} if more else {})


def after(df: DataFrame, key: str, cursor: object, limit: int) -> DataFrame:
    """Keyset paging: the next rows by key, one more than limit to tell if there are others."""
    return (df if cursor is None else df.where(F.col(key) > cursor)).orderBy(key).limit(limit + 1)


def sum_or_error(column: str | Column, zero: object = 0) -> Column:
    """SPARQL's SUM: 0 over no solutions, unbound if any value is."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(F.count("*") == 0, F.lit(zero)).when(F.count("*") > F.count(column), None).otherwise(F.sum(column))


def average_or_error(column: str | Column) -> Column:
    """SPARQL's AVG: 0 over no solutions, unbound if any value is."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(F.count("*") == 0, F.lit(0.0)).when(F.count("*") > F.count(column), None).otherwise(F.avg(column))
