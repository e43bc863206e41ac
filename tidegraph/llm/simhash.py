"""SimHash near-duplicates by self-joins of binary tries.

Fingerprints are 64 bits wide. Two that differ in at most k bits agree on at
least b - k of b blocks, so each distinct fingerprint goes to every choice of
b - k blocks as a key, and linked ones meet under some key. A group's
fingerprints are the leaves of a binary trie. The trie is joined with itself:
pairs of nodes are walked together, bits that differ are added up, and a pair
is left once they exceed the budget, or once both nodes are known to be in one
class. A group gives the edges of a spanning forest, not its pairs, so a
family of near copies costs its own size. Keys that many fingerprints share
are dealt on by pairs of trie nodes that lie within the budget.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import content, materialise, release, settled, table
from tidegraph.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints under one key, beyond which the key is dealt on by node pairs.
HEAVY = 50_000
#: Depth of the trie nodes by which heavy keys are dealt on.
DEPTH = 8

_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, words_each: int) -> np.ndarray:
    """XXH64 of each shingle of lower-cased words, repeats included."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < words_each:
        words, words_each = [b" ".join(words)], 1
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(words_each)), strict=False)], np.uint64)


def fingerprint(text: bytes, words_each: int) -> int:
    """Bit i is 1 if it is set in over half the hashes; a text without words has 0."""
    return majority(shingle_hashes(text, words_each))


def majority(hashes: np.ndarray) -> int:
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 200:
        counts = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _OF_BYTE for i in range(8)])
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), words_each) for x in batch.column("_content")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found, pa.int64())], ["_id", "_fp"])
        release()

    return run


def fingerprints(docs: DataFrame, *, words_each: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _fp) of every row, _fp as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), content(text_col).alias("_content"))
    return rows.mapInArrow(_fingerprints(words_each), "_id long, _fp long")


class TrieJoin:
    """Links of at most budget bits between the leaves of a trie of sorted fingerprints without repeats.

    A node is a range of the sorted values that share the bits above one.
    Linked leaves are merged, and pairs holds the links of a spanning forest.
    """

    BRUTE = 1024

    def __init__(self, values: list[int], budget: int):
        self.values, self.budget = values, budget
        self.array = np.array(values, np.uint64)
        self.parent = list(range(len(values)))
        self.pairs: list[tuple[int, int]] = []
        if values:
            self._within(0, len(values))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def link(self, i: int, j: int) -> None:
        one, other = self.find(i), self.find(j)
        if one != other:
            self.pairs.append((i, j))
            self.parent[max(one, other)] = min(one, other)

    def _split(self, low: int, high: int, bit: int) -> int:
        first = self.values[low] >> (bit + 1) << (bit + 1) | 1 << bit
        return bisect_left(self.values, first, low, high)

    def _one_class(self, low: int, high: int) -> bool:
        root = self.find(low)
        return all(self.find(i) == root for i in range(low + 1, high))

    def _within(self, low: int, high: int) -> bool:
        """Links below one node; whether they make it one class."""
        if high - low == 1:
            return True
        if (high - low) ** 2 <= self.BRUTE:
            self._brute(low, high, low, high)
            return self._one_class(low, high)
        bit = (self.values[low] ^ self.values[high - 1]).bit_length() - 1
        middle = self._split(low, high, bit)
        one = self._within(low, middle) & self._within(middle, high)
        self._across((low, middle), (middle, high), bit - 1, 1, one)
        return one and self.find(low) == self.find(middle)

    def _brute(self, a: int, b: int, c: int, d: int) -> None:
        for start in range(a, b, 1024):
            stop = min(b, start + 1024)
            near = np.bitwise_count(self.array[start:stop, None] ^ self.array[None, c:d]) <= self.budget
            for i, j in zip(*np.nonzero(near), strict=True):
                if start + i < c + j:
                    self.link(start + int(i), c + int(j))

    def _across(self, one: tuple[int, int], other: tuple[int, int], bit: int, used: int, uniform: bool) -> None:
        """Links between two nodes that differ in used bits above bit.

        uniform: each node is one class by itself, so no link is needed once
        they are the same class.
        """
        if used > self.budget or uniform and self.find(one[0]) == self.find(other[0]):
            return
        (a, b), (c, d) = one, other
        values = self.values
        down = max((values[a] ^ values[b - 1]).bit_length(), (values[c] ^ values[d - 1]).bit_length()) - 1
        if (b - a) * (d - c) <= self.BRUTE:
            self._brute(a, b, c, d)
            return
        used += ((values[a] ^ values[c]) >> (down + 1) & ((1 << (bit - down)) - 1)).bit_count()
        if used > self.budget:
            return
        m, n = self._split(a, b, down), self._split(c, d, down)
        for x, y, more in (((a, m), (c, n), 0), ((m, b), (n, d), 0), ((a, m), (n, d), 1), ((m, b), (c, n), 1)):
            if x[0] < x[1] and y[0] < y[1]:
                self._across(x, y, down - 1, used + more, uniform)


Group = dict[str, np.ndarray]


def _spanning(budget: int, direct: bool):
    """Of a group of distinct fingerprints: (fingerprint, least of its class), or if direct, pairs that are linked themselves."""

    def of(group: Group) -> tuple[np.ndarray, np.ndarray]:
        join = TrieJoin(np.unique(group["_fp"].view(np.uint64)).tolist(), budget)
        if direct:
            found = np.array(join.pairs, np.int64).reshape(-1, 2)
            return join.array.view(np.int64)[found[:, 0]], join.array.view(np.int64)[found[:, 1]]
        signed, roots = join.array.view(np.int64), np.array([join.find(i) for i in range(len(join.values))])
        told = np.flatnonzero(roots != np.arange(len(roots)))
        return signed[told], signed[roots[told]]

    return of


def _by_key(columns: tuple[str, ...], of):
    """Applies of to each run of rows with one (_key, _sub); rows arrive ordered by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, size = None, [], 0

        def close() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if size > 1:
                yield of({c: np.concatenate([h[c] for h in held]) for c in columns})

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("_key", "_sub")], axis=1)
            values = {c: batch.column(c).to_numpy() for c in columns}
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            found = []
            for low, high in zip(bounds, bounds[1:], strict=False):
                key = (keys[low, 0], keys[low, 1])
                if key != held_key:
                    found.extend(close())
                    held_key, held, size = key, [], 0
                held.append({c: v[low:high] for c, v in values.items()})
                size += high - low
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])
        for a, b in close():
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        release()

    return run


def _blocks(budget: int, blocks: int) -> list[list[tuple[int, int]]]:
    """Choices of blocks that linked fingerprints agree on, as (first bit, width)."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [[(edges[i], edges[i + 1] - edges[i]) for i in chosen] for chosen in combinations(range(blocks), blocks - budget)]


def _mask(parts: list[tuple[int, int]]) -> int:
    """The bits of the parts, as a signed long."""
    mask = sum(((1 << width) - 1) << first for first, width in parts)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _beside(parts: list[tuple[int, int]]) -> int:
    """The first bit that no part holds; parts are whole blocks, so a block begins there."""
    taken = {b for first, width in parts for b in range(first, first + width)}
    return next(b for b in range(BITS) if b not in taken)


def _keyed(prints: DataFrame, *, budget: int, blocks: int, heavy: int) -> DataFrame:
    """prints once for every key, heavy keys once for every pair of nodes, ordered by key in its partition."""
    own, choices = prints.columns, _blocks(budget, blocks)
    depth = min(DEPTH, BITS // blocks)
    of = lambda values, kind: F.element_at(F.lit(values).cast(f"array<{kind}>"), F.col("_choice") + 1)
    keyed = prints.select(*own, F.explode(F.lit(list(range(len(choices)))).cast("array<int>")).alias("_choice"))
    keyed = keyed.withColumn("_key", F.xxhash64("_choice", F.col("_fp").bitwiseAND(of([_mask(c) for c in choices], "long"))))
    many = keyed.groupBy("_key").agg(F.count("*").alias("_many")).where(F.col("_many") > heavy)
    keyed = keyed.join(many, "_key", "left")
    # a heavy row's trie node, and its partners within the budget; the pair is named by both nodes in order
    node = F.call_function("shiftrightunsigned", F.col("_fp"), of([_beside(c) for c in choices], "int")).bitwiseAND(F.lit((1 << depth) - 1).cast("long"))
    flips = [0, *(sum(1 << b for b in bits) for n in range(1, min(budget, depth) + 1) for bits in combinations(range(depth), n))]
    light = F.col("_many").isNull()
    steps = F.when(light, F.array(F.lit(0).cast("long"))).otherwise(F.lit(flips).cast("array<long>"))
    keyed = keyed.select("*", node.alias("_node"), F.explode(steps).alias("_flip"))
    partner = F.col("_node").bitwiseXOR(F.col("_flip"))
    pair = F.shiftleft(F.least("_node", partner), 32).bitwiseOR(F.greatest("_node", partner))
    keyed = keyed.select("_key", F.when(light, F.lit(-1).cast("long")).otherwise(pair).alias("_sub"), "_choice", *own)
    return keyed.repartition("_key", "_sub").sortWithinPartitions("_key", "_sub")


def links(distinct: DataFrame, *, budget: int = 2, blocks: int = 4, heavy: int = HEAVY, direct: bool = False) -> DataFrame:
    """Edges (a, b) of a spanning forest of every group, of (_fp) without repeats.

    Their components are those of all links of at most budget bits. direct
    says that both ends of each edge are linked themselves; otherwise an edge
    leads to the least of its class.
    """
    keyed = _keyed(distinct, budget=budget, blocks=blocks, heavy=heavy)
    return keyed.select("_key", "_sub", "_fp").mapInArrow(_by_key(("_fp",), _spanning(budget, direct)), "a long, b long")


def classes(docs: DataFrame, *, words_each: int = 3, budget: int = 2, blocks: int = 4, heavy: int = HEAVY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _fp, _component): fingerprints of all rows and the least id reachable over links."""
    prints = materialise(fingerprints(docs, words_each=words_each, id_col=id_col, text_col=text_col), "fingerprints")

    def build() -> DataFrame:
        distinct = materialise(prints.groupBy("_fp").agg(F.min("_id").alias("_least")), "distinct")
        roots = components(links(distinct.select("_fp"), budget=budget, blocks=blocks, heavy=heavy))
        linked = distinct.join(roots, F.col("_fp") == F.col("vertex"))
        least = linked.groupBy("root").agg(F.min("_least").alias("_component"))
        found = distinct.join(roots.join(least, "root").select(F.col("vertex").alias("_fp"), "_component"), "_fp", "left")
        return found.select("_fp", F.coalesce("_component", "_least").alias("_component"))

    return prints.join(settled(docs.sparkSession, "classes", build), "_fp")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """For every row: id, fingerprint (16 lowercase hex digits), component_id.

    A null or empty text has fingerprint zero and is linked like any other. A
    null id is never a component_id unless no row of the class has an id.
    Repeated rows come back each. An empty table gives no rows. Other columns
    are not read.
    """
    found = classes(docs, id_col=id_col, text_col=text_col, **options)
    return found.select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_component").alias("component_id"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
