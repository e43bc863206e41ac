"""A Merkle manifest of a table: parents keep their children's hashes, and leaves fold along them.

Leaves are hashed where they lie, numbered within their group by one range
shuffle, and become nodes of a ternary tree. The manifest stores, for every
parent, its preimage: the children's digests side by side. LEVELS levels of
parents above consecutive nodes are one row, a block, so a tree of N leaves has
log_81 N tables, each an 81st of the one below. The groups' roots, in order,
are the leaves of a last tree. Going down again, each block joins the block
above it once, which gives it the preimages of all its ancestors; a leaf cuts
its own 64 characters out of each for its siblings, or puts another digest in
their place and hashes on, to see which root another content leads to.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.llm.common import materialise, settled, table

WAYS, DIGEST = 3, 64
#: Levels of parents that are one row of the manifest.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(columns: Sequence[Column]) -> Column:
    """The digest of a row: each value's UTF-8 length, a colon and the value, or - for null, side by side."""
    framed = [F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")) for c in columns]
    return F.sha2(F.concat(*(F.coalesce(x, F.lit("-")) for x in framed)), 256)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows with _at, their place among those of their _key from 0, and _n, how many these are.

    Rows are dealt by ranges of key and order, so a key with very many rows
    lies in many tasks; each task counts its rows of a key, and only these
    counts are summed up by key.
    """
    placed = rows.repartitionByRange("_key", *order).sortWithinPartitions("_key", *order).withColumn("_row", F.monotonically_increasing_id())
    placed = materialise(placed, "numbered").withColumn("_part", F.shiftright("_row", 33))
    each = placed.groupBy("_key", "_part").agg(F.count("*").alias("_c"), F.min("_row").alias("_first"))
    before = F.sum("_c").over(W.partitionBy("_key").orderBy("_part")) - F.col("_c") - F.col("_first")
    shifts = each.select("_key", "_part", before.alias("_shift"), F.sum("_c").over(W.partitionBy("_key")).alias("_n"))
    return placed.join(shifts, ["_key", "_part"]).withColumn("_at", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")


def _preimages(digests: Column) -> Column:
    """The digests side by side, every WAYS of them; the last run may be shorter."""
    firsts = F.sequence(F.lit(1), F.size(digests), F.lit(WAYS))
    return F.transform(firsts, lambda i: F.array_join(F.slice(digests, i.cast("int"), WAYS), ""))


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """A row for each block of nodes (_key, _at, _n, _hash, ...): _items in order, _steps, the preimages _p1, _p2 ... level by level, and _top.

    A key with no more nodes than a block holds ends there, so it has only as
    many levels as it needs.
    """
    size, more = WAYS**levels, [c for c in nodes.columns if c not in ("_key", "_at", "_n", "_hash")]
    rows = nodes.groupBy("_key", "_n", F.expr(f"_at div {size}").alias("_block")).agg(F.sort_array(F.collect_list(F.struct("_at", "_hash", *more))).alias("_items"))
    rows = rows.withColumn("_steps", sum(((F.col("_n") > WAYS**level).cast("int") for level in range(levels)), F.lit(0)))
    rows = rows.withColumn("_h0", F.col("_items._hash"))
    for level in range(1, levels + 1):
        rows = rows.withColumn(f"_p{level}", F.when(F.col("_steps") >= level, _preimages(F.col(f"_h{level - 1}"))))
        rows = rows.withColumn(f"_h{level}", F.coalesce(F.transform(f"_p{level}", lambda p: F.sha2(p, 256)), F.col(f"_h{level - 1}")))
    return rows.withColumn("_top", F.col(f"_h{levels}")[0]).drop(*(f"_h{level}" for level in range(levels + 1)))


def tree(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The blocks of numbered nodes, written, from the leaves up; the last table has one block for each key that reaches it."""
    size, found = WAYS**levels, []
    # one number for the whole table
    most = nodes.agg(F.max("_n")).first()[0] or 0
    while True:
        found.append(materialise(_blocks(nodes, levels), "blocks"))
        if most <= size:
            return found
        most = -(-most // size)
        nodes = found[-1].where(F.col("_n") > size).select("_key", F.col("_block").alias("_at"), F.expr(f"(_n + {size - 1}) div {size}").alias("_n"), F.col("_top").alias("_hash"))


def roots(blocks: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(_key, _root) of every key of a tree."""
    ends = [b.where(F.col("_n") <= WAYS**levels).select("_key", F.col("_top").alias("_root")) for b in blocks]
    found = ends[0]
    for more in ends[1:]:
        found = found.unionByName(more)
    return found


def _steps_of(place: Column, levels: int) -> Column:
    """The ancestors in its block of the node at a place there: their preimages, and the node's slot in each."""
    slots = [F.when(F.col("_steps") >= level, F.struct(F.get(f"_p{level}", F.floor(place / WAYS**level).cast("int")).alias("pre"), (F.floor(place / WAYS ** (level - 1)) % WAYS).cast("int").alias("slot"))) for level in range(1, levels + 1)]
    return F.filter(F.array(*slots), lambda s: s.isNotNull())


def reached(blocks: list[DataFrame], ends: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """The blocks of the leaves with _above, the preimages and slots of all ancestors of a block, and the columns of ends.

    ends (_key, _end, ...) is what stands above a key's root: the way on from
    there. Every block meets one row, the block above it or its key's end, so
    no key is hot.
    """
    ends = ends if ends is not None else blocks[-1].select("_key", F.array().cast("array<struct<pre: string, slot: int>>").alias("_end"), F.col("_top").alias("_root")).distinct()
    carried, size, above = [c for c in ends.columns if c not in ("_key", "_end")], WAYS**levels, None
    for rows in reversed(blocks):
        now = rows.where(F.col("_n") <= size).join(ends, "_key").withColumnRenamed("_end", "_above")
        if above is not None:
            inner = above.select("_key", *carried, F.posexplode(F.transform("_items", lambda x, j: F.struct(x["_at"].alias("_block"), F.concat(_steps_of(j, levels), F.col("_above")).alias("_above")))).alias("_j", "_x"))
            inner = inner.select("_key", *carried, "_x._block", "_x._above")
            now = now.unionByName(rows.where(F.col("_n") > size).join(inner, ["_key", "_block"]), allowMissingColumns=False)
        above = now
    return above


def _around(step: Column) -> tuple[Column, Column]:
    """What a preimage holds before and after the slot."""
    return F.substr(step["pre"], F.lit(1), step["slot"] * DIGEST), F.substr(step["pre"], step["slot"] * DIGEST + DIGEST + 1)


def siblings(path: Column) -> Column:
    """The digests beside a leaf's way to the root, level by level from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(*_around(s))), "")


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest in the leaf's place leads to."""

    def up(own: Column, step: Column) -> Column:
        before, after = _around(step)
        return F.sha2(F.concat(before, own, after), 256)

    return F.aggregate(path, digest, up)


@dataclass(frozen=True)
class Manifest:
    """The written parents of a table: blocks of rows by group, and blocks of the groups' roots."""

    rows: list[DataFrame]
    groups: list[DataFrame]

    def root(self) -> str | None:
        """The digest of the whole table; None if it is empty."""
        found = roots(self.groups).first()
        return found["_root"] if found else None

    def leaves(self, digest: str = "_hash") -> DataFrame:
        """For every row: _item (its place, digest and what was kept of it), subroot, root, proof (its siblings), folded (the root that the digest named leads to)."""
        above = reached(self.groups).select("_root", F.explode(F.transform("_items", lambda x, j: F.struct(x["_name"].alias("_key"), x["_hash"].alias("_subroot"), F.concat(_steps_of(j, LEVELS), F.col("_above")).alias("_end")))).alias("_x"))
        ends = above.select("_x._key", "_x._end", "_x._subroot", "_root")

        def told(x: Column, j: Column) -> Column:
            path = F.concat(_steps_of(j, LEVELS), F.col("_above"))
            return F.struct(x.alias("item"), siblings(path).alias("proof"), folded(x[digest], path).alias("folded"))

        blocks = reached(self.rows, ends)
        found = blocks.select("_subroot", "_root", F.explode(F.transform("_items", told)).alias("_x"))
        return found.select("_x.item", F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), "_x.proof", "_x.folded")


def manifest(docs: DataFrame, *, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id", other: Column | None = None) -> Manifest:
    """The manifest of docs' fields, by group, in order.

    other is a digest that is kept beside each row's own, of a copy that is to
    be held against the manifest. Null groups are one group, the first; null
    values differ from empty ones. Null orders come first; rows of one order
    come in the order of their digests, so repeated rows have fixed places. An
    empty table has no blocks. Texts are hashed whole where they lie; columns
    that are no fields, whatever their names, are not read.
    """
    own = leaf([F.col(f) for f in fields])
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    rows = docs.select(key.alias("_key"), F.col(order).alias("_order"), own.alias("_hash"), (own if other is None else other).alias("_other"))
    # written, so that texts are read and hashed once
    lower = tree(numbered(materialise(rows, "leaves"), ["_order", "_hash", "_other"]))
    ends = roots(lower).select(F.lit("").alias("_key"), F.col("_key").alias("_name"), F.col("_root").alias("_hash"))
    return Manifest(lower, tree(numbered(ends, ["_name"])))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and the root that its text without line ends leads to, if its id says so.

    A null id is never tampered with, and a null text stays null.
    """

    def build() -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
        text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
        tampered = leaf([text if f == "text" else F.col(f) for f in FIELDS])
        found = manifest(docs, other=tampered).leaves("_other")
        return found.select(
            F.col("item._order").alias("doc_id"), F.col("item._hash").alias("leaf"), "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
            F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
        )

    return settled(spark, "merkle", build)


#: The tree level by level, and each leaf's fold along it; CRC-32 bit by bit.
OP12_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS own,
    [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, CASE WHEN list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) & 1 = 1 THEN replace(text, chr(10), '') ELSE text END] AS changed
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(list_aggregate(list_transform(own, lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '')) AS leaf,
    sha256(list_aggregate(list_transform(changed, lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '')) AS tampered FROM rows),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, tampered) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
up AS (
  SELECT source, 0 AS level, pos, n, leaf AS hash FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY source, level, pos // 3, n),
sub AS (
  SELECT source, level AS height, hash AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS m FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, place AS pos, m AS n, subroot AS hash FROM sub
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
nodes AS (
  SELECT s.place, u.level, u.pos, u.hash FROM up u JOIN sub s ON s.source IS NOT DISTINCT FROM u.source WHERE u.level < s.height
  UNION ALL
  SELECT s.place, s.height + t.level, t.pos, t.hash FROM sub s JOIN top t ON t.n > 1),
fold AS (
  SELECT row_number() OVER () AS id, p.doc_id, p.leaf, s.subroot, s.place, s.height, 0 AS level, CASE WHEN s.height = 0 THEN s.place ELSE p.pos END AS pos, p.tampered AS acc, '' AS beside
  FROM placed p JOIN sub s ON s.source IS NOT DISTINCT FROM p.source
  UNION ALL
  SELECT f.id, f.doc_id, f.leaf, f.subroot, f.place, f.height, f.level + 1, CASE WHEN f.level + 1 = f.height THEN f.place ELSE f.pos // 3 END,
    sha256(string_agg(CASE WHEN x.pos = f.pos THEN f.acc ELSE x.hash END, '' ORDER BY x.pos)), f.beside || coalesce(string_agg(x.hash, '' ORDER BY x.pos) FILTER (x.pos <> f.pos), '')
  FROM fold f JOIN nodes x ON x.place = f.place AND x.level = f.level AND x.pos // 3 = f.pos // 3
  GROUP BY f.id, f.doc_id, f.leaf, f.subroot, f.place, f.height, f.level, f.pos, f.acc, f.beside),
done AS (SELECT * FROM fold QUALIFY level = max(level) OVER (PARTITION BY id))
SELECT doc_id, leaf, subroot, r.hash AS root, sha256(beside) AS proof_sha256, acc AS folded_root, acc = r.hash AS verified
FROM done, (SELECT hash FROM top WHERE n = 1) r"""
