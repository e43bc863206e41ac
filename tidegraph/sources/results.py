"""Solutions as SPARQL 1.1 Results JSON; an unbound variable is a key that is left out, not a null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegraph.functions import sparql as S


def rows(solutions: DataFrame) -> DataFrame:
    """One flat JSON object a solution (value), with the bound variables only."""
    return solutions.select(F.to_json(F.struct("*"), {"ignoreNullFields": "true"}).alias("value"))


def _term(name: str) -> Column:
    t = F.col(name)
    kind = F.when(S.is_iri(t), "uri").when(S.is_blank(t), "bnode").when(S.is_literal(t), "literal")
    tag, own = F.nullif(S.lang(t), F.lit("")), S.datatype(t)
    plain = tag.isNotNull() | (own == S.XSD + "string")
    value = F.when(S.is_blank(t), t.substr(F.lit(3), F.length(t))).otherwise(S.lexical(t))
    return F.when(kind.isNotNull(), F.struct(kind.alias("type"), value.alias("value"), tag.alias("xml:lang"), F.when(~plain, own).alias("datatype"))).alias(name)


def bindings(solutions: DataFrame) -> DataFrame:
    """One JSON object a solution, each bound variable an object of type, value, and xml:lang or datatype; columns are terms in N-Triples text."""
    return rows(solutions.select(*(_term(c) for c in solutions.columns)))


def head(solutions: DataFrame) -> dict:
    return {"vars": solutions.columns}


def write(solutions: DataFrame, path: str) -> None:
    """The bindings as lines of text files, since one document would pass through one task."""
    bindings(solutions).write.text(path)


def read(lines: DataFrame, variables: list[str]) -> DataFrame:
    """Lexical values of lines of bindings (value), a column for each variable; keys that are left out are null."""
    kind = "struct<" + ", ".join(f"`{v}`: struct<value: string>" for v in variables) + ">"
    return lines.select(F.from_json("value", kind).alias("_b")).select(*(F.col(f"_b.`{v}`.value").alias(v) for v in variables))
