"""NDJSON lines: triplets and entities mixed, one to a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "struct<type:string,name:string,key:string>"
#: properties is kept as the JSON text that was read, so numbers, texts and booleans stay what they are.
SCHEMA = f"source {END}, relation string, target {END}, evidence string, type string, name string, key string, properties string, _corrupt_record string"


def read(spark: SparkSession, path: str, *, strict: bool = False) -> DataFrame:
    """All lines; strict fails on a malformed one, else it is kept in _corrupt_record."""
    return spark.read.schema(SCHEMA).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def _identity(kind: Column, key: Column, name: Column) -> Column:
    # a slash within a type would look like the one after it
    return F.concat(F.replace(F.replace(kind, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F")), F.lit("/"), F.coalesce(key, name))


def identity(end: str) -> Column:
    """Type and key, or type and name where there is no key."""
    return _identity(F.col(f"{end}.type"), F.col(f"{end}.key"), F.col(f"{end}.name"))


def _own() -> Column:
    return _identity(F.col("type"), F.col("key"), F.col("name"))


def is_triplet() -> Column:
    """A relation between two ends that both have an identity."""
    return F.col("relation").isNotNull() & identity("source").isNotNull() & identity("target").isNotNull()


def is_entity() -> Column:
    """An identity and no relation; properties may be missing."""
    return F.col("relation").isNull() & _own().isNotNull()


def triplets(lines: DataFrame) -> DataFrame:
    """src, relation, dst, the ends' names, evidence, and the edge's own properties as JSON text."""
    return lines.where(is_triplet()).select(identity("source").alias("src"), "relation", identity("target").alias("dst"), F.col("source.name").alias("src_name"), F.col("target.name").alias("dst_name"), "evidence", "properties")


def entities(lines: DataFrame) -> DataFrame:
    """id, type, name and properties as JSON text."""
    return lines.where(is_entity()).select(_own().alias("id"), "type", "name", "properties")


def rejected(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON, and JSON that is neither a triplet nor an entity, as text."""
    none = ~F.coalesce(is_triplet(), F.lit(False)) & ~F.coalesce(is_entity(), F.lit(False))
    known = F.to_json(F.struct("source", "relation", "target", "evidence", "type", "name", "key", "properties"))
    return lines.where(none).select(F.coalesce("_corrupt_record", known).alias("line"), F.col("_corrupt_record").isNotNull().alias("malformed"))


def fields(found: DataFrame) -> DataFrame:
    """(id, field, kind, value) of each property, kind being what JSON says: string, long, double, boolean; null and nested values are json."""
    # names are keys of a map and not parts of a path, so they may have any characters
    typed = found.select("id", F.from_json("properties", "map<string,variant>").alias("_typed"), F.from_json("properties", "map<string,string>").alias("_texts"))
    each = typed.select("id", "_typed", F.explode("_texts").alias("field", "value"))
    raw = each.withColumn("_kind", F.schema_of_variant(F.element_at("_typed", F.col("field"))))
    kind = F.when(F.col("_kind") == "STRING", "string").when(F.col("_kind") == "BOOLEAN", "boolean").when(F.col("_kind") == "BIGINT", "long")
    return raw.select("id", "field", kind.when(F.col("_kind").rlike("^(DOUBLE|FLOAT|DECIMAL)"), "double").otherwise("json").alias("kind"), "value")


def _end(identity_: str, name: str, columns: list[str]) -> Column:
    """The type is what comes before the first slash, the key all after it."""
    parts = F.split(identity_, "/", 2)
    kind, key = F.replace(F.replace(parts[0], F.lit("%2F"), F.lit("/")), F.lit("%25"), F.lit("%")), parts[1]
    if name not in columns:
        return F.struct(kind.alias("type"), key.alias("name"))
    own = F.coalesce(F.col(name), key)
    return F.struct(kind.alias("type"), own.alias("name"), F.when(own != key, key).alias("key"))


def _properties(columns: list[str]) -> list[Column]:
    return [F.parse_json("properties").alias("properties")] if "properties" in columns else []


def write(edges: DataFrame, path: str) -> None:
    """Edges (src, relation, dst, and src_name, dst_name, evidence, properties where there are such) as triplet lines."""
    have = edges.columns
    more = [F.col("evidence")] if "evidence" in have else []
    line = F.to_json(F.struct(_end("src", "src_name", have).alias("source"), "relation", _end("dst", "dst_name", have).alias("target"), *more, *_properties(have)))
    edges.select(line.alias("value")).write.mode("append").text(path)


def write_entities(found: DataFrame, path: str) -> None:
    """Entities (id, properties as JSON text, and name where there is one) as lines."""
    end = _end("id", "name", found.columns)
    rows = found.withColumn("_end", end)
    keyed = [F.col("_end.key")] if "name" in found.columns else []
    line = F.to_json(F.struct(F.col("_end.type"), F.col("_end.name"), *keyed, *_properties(found.columns)))
    rows.select(line.alias("value")).write.mode("append").text(path)
