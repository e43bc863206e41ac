"""N-Triples and N-Quads: one statement to a line, so Spark splits and parses them with one pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.functions.sparql import canonical

_IRI, _BLANK = r"<(?:[^<>\"{}|^`\\\x00-\x20]|\\[uU][0-9A-Fa-f]{4,8})*+>", r"_:[^\s<>\"]+?"
# possessive throughout: a pattern that could go back would need a stack frame for each character
_LITERAL = r"\"[^\"\\\n\r]*+(?:\\.[^\"\\\n\r]*+)*+\"(?:@[A-Za-z]++(?:-[A-Za-z0-9]++)*+|\^\^<[^>]*+>)?"
STATEMENT = rf"^\s*({_IRI}|{_BLANK})\s*({_IRI})\s*({_IRI}|{_BLANK}|{_LITERAL})\s*({_IRI}|{_BLANK})?\s*\.\s*(?:#.*)?$"


#: Lines that say nothing.
NOTHING = r"^\s*(#.*)?$"


def malformed(lines: DataFrame) -> DataFrame:
    """The lines that parse() drops where it is not strict: no statements, and neither blank nor comments."""
    return lines.where(~F.col("value").rlike(NOTHING) & ~F.col("value").rlike(STATEMENT))


def parse(lines: DataFrame, *, strict: bool = False, scope: str | None = None, graph_uri: str | None = None) -> DataFrame:
    """Quads s, p, o, g in canonical N-Triples text from a column value; blank and comment lines are skipped.

    Escapes of code points are replaced, language tags are in small letters, so
    equal terms have equal texts.

    A line that is no statement is dropped, and told by malformed(), or raises
    if strict. scope
    prefixes blank-node labels, so that labels of different documents differ.
    g is null without a graph, or graph_uri.
    """
    lines = lines.where(~F.col("value").rlike(NOTHING))
    part = lambda i: F.regexp_extract("value", STATEMENT, i)
    good = F.col("value").rlike(STATEMENT)
    lines = lines.withColumn("value", F.when(good, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a statement: "), F.col("value"))))) if strict else lines.where(good)

    def scoped(c: Column) -> Column:
        return c if scope is None else F.when(c.startswith("_:"), F.concat(F.lit("_:"), F.substring(F.sha2(F.lit(scope), 256), 1, 12), F.lit("_"), c.substr(F.lit(3), F.length(c)))).otherwise(c)

    g = F.nullif(part(4), F.lit(""))
    return lines.select(scoped(canonical(part(1))).alias("s"), canonical(part(2)).alias("p"), scoped(canonical(part(3))).alias("o"), scoped(F.coalesce(canonical(g), F.lit(f"<{graph_uri}>")) if graph_uri else canonical(g)).alias("g"))


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    return parse(spark.read.text(path), **options)


def from_edges(edges: DataFrame, base: str = "http://ex/") -> DataFrame:
    """Edges (src, relation, dst) as quads of IRIs."""
    iri = lambda c: F.concat(F.lit(f"<{base}"), F.col(c), F.lit(">"))
    return edges.select(iri("src").alias("s"), F.concat(F.lit(f"<{base}rel/"), F.col("relation"), F.lit(">")).alias("p"), iri("dst").alias("o"), F.lit(None).cast("string").alias("g"))


def statement() -> Column:
    return F.concat_ws(" ", "s", "p", "o", "g", F.lit("."))


def write(quads: DataFrame, path: str) -> None:
    quads.select(statement().alias("value")).write.text(path)


def counts(quads: DataFrame) -> DataFrame:
    """What an import reports: statements, those with a resource or a literal object, predicates, repeated statements."""
    literal = F.col("o").startswith('"')
    each = quads.groupBy("s", "p", "o", "g").agg(F.count("*").alias("n"))
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("statements"),
        F.coalesce(F.sum(F.when(literal, 0).otherwise(F.col("n"))), F.lit(0)).alias("resource_triples"),
        F.coalesce(F.sum(F.when(literal, F.col("n")).otherwise(0)), F.lit(0)).alias("literal_triples"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.countDistinct("p").alias("predicates"),
    )
