"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words: its share by weight of a budget, at most a
multiple of its own words, the excess shared again by weight. A document's
expected copies are its source's target over the source's words (times an own
weight, if a column gives one). Whole copies are certain; for the rest f, the
documents of a source are ranked by random odds over inclusion odds,
u/(1-u) / (f/(1-f)), and taken in this order until the source's words are met.

A source may hold most rows, so no task sorts a source: a histogram of the
ranks finds the bucket in which the target is met, and only that bucket's rows
are ordered. All operations are DataFrame functions; u is a hash of id and
text, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.llm.common import materialise, table, word_count

BUCKETS = 1 << 16
#: Every document's expected copies, and so a source's target over its size, stop here.
MOST_COPIES = 2


def _uniform(seed: str, id_col: str, text_col: str) -> Column:
    """In (0, 1), from the first 48 bits of a digest of seed, id and text."""
    parts = [F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))]
    bits = F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = MOST_COPIES) -> DataFrame:
    """Of (_source, _size) rows: _source, _source_size, _target, one row per source, null included.

    The water level is found in closed form: with sources ordered by cap over
    weight, the level at a source is what the capped ones before it leave,
    over the weights from there on; the first level that stays below the
    source's own cap is the one that holds.
    """
    per = sizes.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    place = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    per = per.withColumn("_weight", F.element_at(cycle, (place % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", F.col("_source_size") * F.lit(float(most)))
    per = per.withColumn("_order", F.row_number().over(W.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())))
    before = W.orderBy("_order").rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy(F.col("_order").desc()).rowsBetween(W.unboundedPreceding, 0)
    left = F.sum("_source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) * F.lit(share) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    per = per.withColumn("_level", left / F.sum("_weight").over(after))
    holds = F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.struct("_order", "_level"))
    per = per.withColumn("_level", F.min(holds).over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))["_level"])
    return per.select("_source", "_source_size", F.least("_cap", F.col("_weight") * F.col("_level")).alias("_target"))


def _ranked(rows: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """Adds _whole, the certain copies, _rank in (0, 1] and its _bucket; rank 1 is never chosen."""
    rows = rows.join(targets, rows["_source"].eqNullSafe(targets["_of"]), "left").drop("_of")
    expected = F.when(F.col("_source_size") > 0, F.least(F.col("_target") / F.col("_source_size") * F.col("_own"), F.lit(float(most)))).otherwise(0.0)
    rows = rows.withColumn("_expected", expected).withColumn("_whole", F.floor("_expected").cast("long"))
    f, u = F.col("_expected") - F.col("_whole"), F.col("_u")
    # odds ratio q as q / (1 + q)
    rows = rows.withColumn("_rank", F.when(f > 0, u * (1 - f) / (u * (1 - f) + f * (1 - u))).otherwise(1.0))
    return rows.withColumn("_bucket", F.floor(F.col("_rank") * BUCKETS).cast("int"))


def _edges(ranked: DataFrame) -> DataFrame:
    """Of each source: what the certain copies leave, the bucket in which it is met, the words before that bucket."""
    by = ranked.groupBy("_source", "_bucket").agg(
        F.sum("_size").alias("_words"),
        F.sum(F.col("_size") * F.col("_whole")).alias("_certain"),
        F.max("_target").alias("_goal"),
    )
    of = W.partitionBy("_source")
    by = by.withColumn("_left", F.col("_goal") - F.sum("_certain").over(of))
    by = by.withColumn("_before", F.coalesce(F.sum("_words").over(of.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    met = F.col("_before") + F.col("_words") > F.col("_left")
    first = F.min(F.when(met, F.struct("_bucket", "_before")))
    return by.groupBy(F.col("_source").alias("_of")).agg(first.alias("_edge"), F.max("_left").alias("_left"))


def choose(rows: DataFrame, sizes: DataFrame, *, weights=(3, 1, 2), share=1.5, most: float = MOST_COPIES, order: tuple[str, ...] = ("_id",)) -> DataFrame:
    """rows with _copies, _target and _source_size added.

    Both frames have _source, _size, _u, _own; sizes is scanned several times
    and should be materialised, rows is scanned twice, narrowly.
    """
    targets = materialise(source_targets(sizes, weights=weights, share=share, most=most), "targets").withColumnRenamed("_source", "_of")
    edges = materialise(_edges(_ranked(sizes, targets, most)), "edges")
    ranked = _ranked(rows, targets, most)
    ranked = ranked.join(edges, ranked["_source"].eqNullSafe(edges["_of"]), "left").drop("_of")
    edge, inside = F.coalesce(F.col("_edge._bucket"), F.lit(BUCKETS)), F.col("_rank") < 1
    clear = ranked.where(F.col("_bucket") != edge).withColumn("_copies", F.col("_whole") + (inside & (F.col("_bucket") < edge)).cast("long"))
    near = ranked.where(F.col("_bucket") == edge)
    run = F.sum("_size").over(W.partitionBy("_source").orderBy("_rank", *order).rowsBetween(W.unboundedPreceding, 0))
    middle = F.col("_edge._before") + run - F.col("_size") / 2
    near = near.withColumn("_copies", F.col("_whole") + (inside & F.coalesce(middle <= F.col("_left"), F.lit(True))).cast("long"))
    return clear.unionByName(near)


def _prepared(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str, weight_col: str | None) -> dict[str, Column]:
    own = F.coalesce(F.greatest(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(1.0)) if weight_col else F.lit(1.0)
    return {"_id": F.col(id_col), "_source": F.col(source_col), "_size": word_count(text_col), "_u": _uniform(seed, id_col, text_col), "_own": own}


def mix_plan(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weight_col: str | None = None, seed: str = "mix", **options) -> DataFrame:
    """For every row: id, size, source_size, target, taken = copies x size.

    A null text has size 0; null sources are one source, the last. Rows that
    repeat id and text share a rank, and ties are ordered by id and size. A
    source without words has target 0 and takes nothing. An empty table gives
    no rows. A source's taken words differ from its target by at most half the
    size of one document. weight_col multiplies a row's expected copies (null:
    1), which are then unequal within a source; it should average 1 over a
    source's words. Whole texts are counted, however long; other columns,
    whatever their names, are not read.
    """
    sizes = materialise(docs.select(*(c.alias(n) for n, c in _prepared(docs, seed, id_col, text_col, source_col, weight_col).items())), "sizes")
    return choose(sizes, sizes, order=("_id", "_size"), **options).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def mix(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weight_col: str | None = None, seed: str = "mix", **options) -> DataFrame:
    """The documents of the mix, each as often as mix_plan() takes it, with all their columns.

    Texts are never shuffled but for the few rows of the edge buckets.
    Documents without words are in the mix as often as their rank says. Rows
    that repeat id and text share a rank, and where only some of them fit,
    other columns do not say which. Columns keep their names, whatever these
    are; an empty table stays empty.
    """
    made = _prepared(docs, seed, id_col, text_col, source_col, weight_col)
    sizes = materialise(docs.select(*(c.alias(n) for n, c in made.items())), "sizes")
    row = docs.select(F.struct(*docs.columns).alias("_row"), *(c.alias(n) for n, c in made.items()))
    chosen = choose(row, sizes, order=("_id", "_size"), **options).where("_copies > 0")
    return chosen.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).select("_row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight
  FROM per),
placed AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source ASC NULLS LAST) AS place FROM weighed),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY place DESC ROWS UNBOUNDED PRECEDING) AS level
  FROM placed),
held AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, least(cap, weight * held.level) AS target FROM levels, held),
expected AS (
  SELECT s.*, source_size, target,
         CASE WHEN source_size > 0 THEN least(target / source_size, 2.0::DOUBLE) ELSE 0.0 END AS e
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, floor(e)::BIGINT AS whole,
         CASE WHEN e > floor(e) THEN u * (1 - (e - floor(e))) / (u * (1 - (e - floor(e))) + (e - floor(e)) * (1 - u)) ELSE 1.0 END AS place
  FROM expected),
run AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2 AS middle,
         target - sum(size * whole) OVER (PARTITION BY source) AS rest
  FROM ranked)
SELECT doc_id, size, source_size, target, ((whole + (place < 1 AND middle <= rest)::BIGINT) * size)::BIGINT AS taken
FROM run
"""
