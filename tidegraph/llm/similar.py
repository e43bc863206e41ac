"""Near-duplicate texts: SimHash tries give the close ones, a prefix filter the rest, exact similarity decides.

Two texts are linked if the Jaccard similarity of their sets of five-word
shingles is at least 0.8. One pass over the texts writes, for each, the SimHash
of its distinct words (a change of few words is a change of few bits there), its
rarest shingles and a bitmap of all. Then:

1. Fingerprints within a small budget of bits are joined by operator 6's tries,
   which give a spanning forest and not all pairs. Texts of one fingerprint
   hang on one of them. Every edge of this forest is checked, and those that
   hold give groups.
2. Links of more bits, and links within a class whose forest did not hold, are
   found by a prefix filter. In one order of all shingles, frequent ones last,
   two sets that are similar enough share one of each one's first fifth, so
   texts meet under those. First each shingle's first text is held against the
   others there, which joins up families of copies. Then, where texts of two
   groups still meet, all pairs of different groups are looked at; sizes,
   places and bitmaps rule out most, and what is left is checked. Where more
   pairs than rows are left under a shingle, as in a large family whose members
   are about as similar as asked, no pairs are made: the texts that they
   connect are a block, which bitmaps of all shingles split again, and a task
   that holds a block's sets gives a spanning forest of its links.

So the groups are those of all links, whatever the budget is. A row's number,
given when the pass is written, names it; texts are found again by a digest of
128 bits of id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegraph.llm import simhash
from tidegraph.llm.common import content, kept, materialise, release, settled, unused
from tidegraph.llm.components import components

WORDS_EACH, SIMILARITY = 5, 0.8
#: Bits by which fingerprints that the tries join may differ. Texts with more between them are left to the prefix filter.
BUDGET, BLOCKS = 3, 5
#: Texts that tell which shingles are frequent, at least, and at least every so many; how many shingles are told, each found at least so often.
SAMPLE, EVERY, FREQUENT, OFTEN = 5_000, 50, 100_000, 4
#: Rows under one shingle, beyond which it is dealt into parts that meet by twos.
HEAVY = 20_000
#: Places at most of the bitmap that goes with each of a text's first shingles, so that it does not grow with the text.
WIDEST = 1024
#: Bytes of a block of texts, beyond which it is dealt into parts that meet by twos.
BLOCK_BYTES = 64_000_000
#: Pairs of rows under one shingle that are compared at once.
AT_ONCE = 4_000_000
#: Words whose hash a worker remembers.
REMEMBERED = 200_000

#: By what a shingle's words are weighed, one after the other; all odd.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class Shingler:
    """Hashes of a text's words and of its shingles; each word is hashed once."""

    def __init__(self, words_each: int):
        self.words_each, self.known = words_each, {}

    def words(self, text: bytes) -> np.ndarray:
        import xxhash

        words = text.lower().split()
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set(words)
        self.known.update((w, xxhash.xxh64_intdigest(w, simhash.SEED)) for w in new)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """The set of shingles as sorted signed longs. Fewer words than a shingle has are one; a text without words has one of its own."""
        each = min(self.words_each, len(words))
        if not each:
            return np.zeros(1, np.int64)
        hashed = np.zeros(len(words) - each + 1, np.uint64)
        for i in range(each):
            # the words' hashes are even over 64 bits, and so is their weighed sum
            hashed += words[i : len(words) - each + 1 + i] * np.uint64(_ODD[i % len(_ODD)] + 2 * (i // len(_ODD)))
        return np.unique(hashed.view(np.int64))


def shingler(words_each: int) -> Shingler:
    """This worker's, whose memory of words lasts over its tasks."""
    return kept(("shingles", words_each), lambda: Shingler(words_each))


def _shingled(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shingler(words_each)
        for batch in batches:
            sets = [of.shingles(of.words(x.as_py())) for x in batch.column("_content")]
            yield pa.RecordBatch.from_arrays([batch.column("_leaf"), pa.array(sets, pa.list_(pa.int64()))], ["_leaf", "_set"])
        release()

    return run


def _frequent(rows: DataFrame, texts: int, words_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles in order and how many texts have them, told from some texts. They decide only about the order of shingles."""
    step = min(EVERY, max(1, texts // SAMPLE))
    some = rows.where(F.pmod(F.xxhash64("_who"), F.lit(step)) == 0).select(F.lit(0).cast("long").alias("_leaf"), "_content").mapInArrow(_shingled(words_each), "_leaf long, _set array<long>")
    counts = some.select(F.explode("_set").alias("_key")).groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") >= OFTEN)
    found = counts.orderBy(F.desc("_n"), "_key").limit(FREQUENT).toPandas().sort_values("_key")
    return found["_key"].to_numpy(np.int64), found["_n"].to_numpy(np.int64) * step


def prefix(own: np.ndarray, frequent: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first of a set's shingles by frequency, then value; a set that is similar enough has one of them among its own first."""
    if len(frequent) and len(own):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        own = own[np.lexsort((own, np.where(frequent[at] == own, counts[at], 0)))]
    return own[: len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1]


def bitmap(own: np.ndarray, widest: int | None = None) -> bytes:
    """The parity of a set's shingles in each of as many places as it has shingles, rounded up to a power of two: at least 64, at most widest."""
    width = max(64, 1 << (max(1, len(own)) - 1).bit_length())
    width = min(widest or width, width)
    return np.packbits(np.bincount(own & (width - 1), minlength=width) & 1).tobytes()


def apart(one: bytes, other: bytes) -> int:
    """At most the number of shingles that only one of two sets has, told from bitmaps; the wider is folded."""
    x, y = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _sketched(words_each: int, similarity: float, frequent: np.ndarray, counts: np.ndarray, heavy: int):
    """Each text's fingerprint, number of shingles, first shingles, how many parts the rows of each are dealt into (null: all one), bitmap of all, and a wider one if the text is long."""
    kinds = {"_fp": pa.int64(), "_size": pa.int32(), "_keys": pa.list_(pa.int64()), "_salts": pa.list_(pa.int32()), "_bits": pa.binary(), "_wide": pa.binary()}

    def salts(keys: np.ndarray) -> np.ndarray | None:
        if not len(frequent):
            return None
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        many = np.where(frequent[at] == keys, counts[at], 0)
        return (1 + many // heavy).astype(np.int32) if (many >= heavy).any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shingler(words_each)
        for batch in batches:
            rows = []
            for text in batch.column("_content"):
                words = of.words(text.as_py())
                own = of.shingles(words)
                keys = prefix(own, frequent, counts, similarity)
                rows.append((simhash.majority(np.unique(words)), len(own), keys, salts(keys), bitmap(own, WIDEST), bitmap(own) if len(own) > WIDEST else None))
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True) if rows else [()] * len(kinds), kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_who"), *columns], ["_id", "_who", *kinds])
        release()

    return run


def _sketches(rows: DataFrame, texts: int, similarity: float, words_each: int, heavy: int) -> DataFrame:
    """_leaf, _id, _who, _fp, _size, _keys, _salts, _bits, _wide of every row (_id, _who, _content)."""
    frequent, counts = _frequent(rows, texts, words_each)
    kind = rows.schema["_id"].dataType.simpleString()
    found = rows.mapInArrow(_sketched(words_each, similarity, frequent, counts, heavy), f"_id {kind}, _who binary, _fp long, _size int, _keys array<long>, _salts array<int>, _bits binary, _wide binary")
    # written at once, so the numbers stay what they are
    return materialise(found.select(F.monotonically_increasing_id().alias("_leaf"), "*"), "sketches")


def _jaccard(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("_one"), batch.column("_other"), strict=True):
                one, other = one.values.to_numpy(zero_copy_only=False), other.values.to_numpy(zero_copy_only=False)
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(both >= similarity * (len(one) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    return run


def _within(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other, sizes = (batch.column(c).to_pylist() for c in ("_one", "_other", "_sizes"))
            keep = [apart(x, y) <= (1 - similarity) / (1 + similarity) * n + 1e-9 for x, y, n in zip(one, other, sizes, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    return run


def _sets(leaves: DataFrame, sketches: DataFrame, rows: DataFrame, words_each: int) -> DataFrame:
    """(_leaf, _set) of the leaves named."""
    wanted = materialise(sketches.select("_leaf", "_who").join(leaves, "_leaf", "left_semi"), "wanted")
    return materialise(rows.select("_who", "_content").join(wanted, "_who").select("_leaf", "_content").mapInArrow(_shingled(words_each), "_leaf long, _set array<long>").dropDuplicates(["_leaf"]), "shingles")


def _checked(pairs: DataFrame, sketches: DataFrame, rows: DataFrame, similarity: float, words_each: int) -> DataFrame:
    """The pairs (a, b) that are similar enough. Whole bitmaps, which travel once for each pair, rule out most others, so the sets of few texts travel."""
    of = lambda end, set_: sketches.select(F.col("_leaf").alias(end), F.col("_size").alias(f"_n{end}"), F.coalesce("_wide", "_bits").alias(set_))
    near = pairs.join(of("a", "_one"), "a").join(of("b", "_other"), "b").select("a", "b", "_one", "_other", (F.col("_na") + F.col("_nb")).alias("_sizes"))
    near = materialise(near.mapInArrow(_within(similarity), "a long, b long"), "within")
    sets = _sets(near.select(F.explode(F.array("a", "b")).alias("_leaf")).distinct(), sketches, rows, words_each)
    full = near.join(sets.select(F.col("_leaf").alias("a"), F.col("_set").alias("_one")), "a").join(sets.select(F.col("_leaf").alias("b"), F.col("_set").alias("_other")), "b")
    return full.select("a", "b", "_one", "_other").mapInArrow(_jaccard(similarity), "a long, b long")


def _forest(sketches: DataFrame, budget: int, blocks: int, heavy: int) -> DataFrame:
    """Pairs (a, b) of a spanning forest of all rows within the budget of bits."""
    each = materialise(sketches.groupBy("_fp").agg(F.min("_leaf").alias("_rep"), F.count("*").alias("_n")), "prints")
    near = simhash.links(each.select("_fp"), budget=budget, blocks=blocks, heavy=heavy, direct=True)
    of = lambda end: each.select(F.col("_fp").alias(end), F.col("_rep").alias(f"_{end}"))
    near = near.distinct().join(of("a"), "a").join(of("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    same = sketches.select("_fp", "_leaf").join(each.where("_n > 1").select("_fp", "_rep"), "_fp").where("_leaf != _rep")
    return near.unionByName(same.select(F.col("_rep").alias("a"), F.col("_leaf").alias("b")))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose _key another row has, and all rows of keys that are dealt into parts; rows arrive ordered by key and salt."""
    held, told = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        keys, salts = batch.column("_key").to_numpy(), batch.column("_salt").to_numpy()
        same = (keys[1:] == keys[:-1]) & (salts[1:] == salts[:-1])
        keep = np.append(False, same) | np.append(same, False) | (salts >= 0)
        keep[0] &= not told
        told = bool(keep[-1]) or (told and batch.num_rows == 1)
        yield batch.filter(pa.array(keep))
        # the last row may be met again by the next batch
        held = batch.slice(batch.num_rows - 1)
    release()


def can_be_similar(sizes: np.ndarray, places: np.ndarray, sizes2: np.ndarray, places2: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets that share the shingles at these places of their order can be similar enough."""
    # the first shingle that two texts share leaves at most these for both
    most = np.minimum(sizes - places, sizes2 - places2)
    return most >= similarity / (1 + similarity) * (sizes + sizes2) - 1e-9


Rows = list[np.ndarray]


class Bitmaps:
    """Bitmaps of many rows, each folded to any narrower width as it is asked for."""

    def __init__(self, bitmaps: np.ndarray):
        self.widths = np.array([len(x) for x in bitmaps])
        self.own, self.folded = bitmaps, {}

    def _at(self, width: int) -> np.ndarray:
        """Rows of 64-bit words; those of narrower bitmaps are zero and not to be used."""
        if width not in self.folded:
            out = np.zeros((len(self.own), width // 8), np.uint64)
            for wide in np.unique(self.widths[self.widths >= width]).tolist():
                rows = np.flatnonzero(self.widths == wide)
                whole = np.frombuffer(b"".join(self.own[rows]), np.uint64).reshape(len(rows), wide // width, width // 8)
                out[rows] = np.bitwise_xor.reduce(whole, axis=1)
            self.folded[width] = out
        return self.folded[width]

    def within(self, one: np.ndarray, other: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether rows one and other differ in at most so many places, as apart() tells it."""
        keep, widths = np.zeros(len(one), bool), np.minimum(self.widths[one], self.widths[other])
        for width in np.unique(widths).tolist():
            words, pairs = self._at(width), np.flatnonzero(widths == width)
            for at in range(0, len(pairs), max(1, AT_ONCE // width)):
                some = pairs[at : at + max(1, AT_ONCE // width)]
                keep[some] = np.bitwise_count(words[one[some]] ^ words[other[some]]).sum(axis=1) <= most[some]
        return keep


def _plausible(size: np.ndarray, bitmaps: Bitmaps, one: np.ndarray, other: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs of rows that their bitmaps leave."""
    keep = bitmaps.within(one, other, (1 - similarity) / (1 + similarity) * (size[one] + size[other]) + 1e-9)
    return one[keep], other[keep]


def joined(roots: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The least row that each one leads to, by roots so far and by these pairs of rows."""
    while (roots[one] != roots[other]).any():
        roots = roots.copy()
        ends, least = (roots[one], roots[other]), np.minimum(roots[one], roots[other])
        for end in ends:
            np.minimum.at(roots, end, least)
        while (roots != roots[roots]).any():
            roots = roots[roots]
    return roots


Met = tuple[np.ndarray, np.ndarray, bool]


def _star(rows: Rows, bounds: np.ndarray, similarity: float) -> Iterator[Met]:
    """Of each key, its first row with the rows of other labels."""
    leaf, label, size, pos, bits = rows[2:]
    first, each = np.repeat(bounds[:-1], np.diff(bounds)), np.arange(len(leaf))
    near = np.flatnonzero((label[first] != label[each]) & can_be_similar(size[first], pos[first], size, pos, similarity))
    one, other = _plausible(size, Bitmaps(bits), first[near], near, similarity)
    yield leaf[one], leaf[other], False


def _all_pairs(rows: Rows, bounds: np.ndarray, similarity: float) -> Iterator[Met]:
    """Of each key, all pairs of rows of different labels; if these are more than its rows, then, marked so, each row with the least that they lead to."""
    leaf, label, size, pos, bits = rows[2:]
    bitmaps = Bitmaps(bits)
    for low, high in zip(bounds[:-1][np.diff(bounds) > 1].tolist(), bounds[1:][np.diff(bounds) > 1].tolist(), strict=True):
        own = slice(low, high)
        if (label[own] == label[low]).all():
            continue
        step, found, roots = max(1, AT_ONCE // (high - low)), [], None
        for at in range(low, high, step):
            to = slice(at, min(high, at + step))
            near = (label[to, None] < label[None, own]) & can_be_similar(size[to, None], pos[to, None], size[None, own], pos[None, own], similarity)
            i, j = np.nonzero(near)
            found.append(_plausible(size, bitmaps, at + i, low + j, similarity))
            if roots is not None or sum(len(one) for one, _ in found) > high - low:
                one, other = (np.concatenate(x) - low for x in zip(*found, strict=True))
                roots, found = joined(np.arange(high - low) if roots is None else roots, one, other), []
        if roots is None:
            yield from ((leaf[one], leaf[other], False) for one, other in found)
        else:
            led = np.flatnonzero(roots != np.arange(high - low))
            yield leaf[low + led], leaf[low + roots[led]], True


def spanning(labels: np.ndarray, sets: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links between rows of different labels, as many as join up all labels that links join."""
    sizes = np.array([len(x) for x in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    order = np.argsort(codes, kind="stable")
    # the rows that have a shingle, for every shingle
    having, starts = np.repeat(np.arange(len(sets)), sizes)[order], np.concatenate([[0], np.cumsum(np.bincount(codes))])
    own, found = np.unique(labels, return_inverse=True)[1], []
    for i in range(len(sets)):
        if (own == own[i]).all():
            continue
        both = np.bincount(np.concatenate([having[starts[c] : starts[c + 1]] for c in codes[bounds[i] : bounds[i + 1]].tolist()]), minlength=len(sets))
        near = np.flatnonzero((own != own[i]) & (both >= similarity * (sizes + sizes[i] - both)))
        _, least = np.unique(own[near], return_index=True)
        for j in near[least].tolist():
            found.append((i, j))
            own[own == own[j]] = own[i]
    return found


def _all_links(rows: Rows, bounds: np.ndarray, similarity: float) -> Iterator[Met]:
    """Of each key, a spanning forest of the links between labels, told from whole sets."""
    leaf, label, sets = rows[2:]
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        links = np.array(spanning(label[low:high], sets[low:high], similarity), np.int64).reshape(-1, 2)
        yield leaf[low + links[:, 0]], leaf[low + links[:, 1]], False


def _met(pairs_of, similarity: float, names: tuple[str, ...] = ("_key", "_sub", "_leaf", "_label", "_size", "_pos", "_bits")):
    """Pairs under one (_key, _sub), the lesser leaf first, and whether they stand for more pairs than there are rows; rows arrive ordered by key and sub."""

    def told(rows: Rows, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for one, other, dense in pairs_of(rows, bounds, similarity):
            found.append((np.minimum(one, other), np.maximum(one, other), np.full(len(one), dense)))
            size += len(one)
            if size > AT_ONCE:
                yield batch_of(found)
                found, size = [], 0
        if size:
            yield batch_of(found)

    def batch_of(found: list[Met]) -> pa.RecordBatch:
        # texts meet under many keys, so a pair is here again and again
        a, b, dense = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((dense, b, a))
        a, b, dense = a[order], b[order], dense[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (dense[1:] != dense[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(x[new]) for x in (a, b, dense)], ["a", "b", "dense"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Rows] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if held and (rows[0][-1], rows[1][-1]) == (held[0][0][0], held[0][1][0]):
                held.append(rows)  # all of one key
                continue
            rows = [np.concatenate(x) for x in zip(*held, rows, strict=True)]
            bounds = np.concatenate([[0], np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1])
            yield from told([x[: bounds[-1]] for x in rows], bounds)
            held = [[x[bounds[-1] :] for x in rows]]
        if held:
            rows = [np.concatenate(x) for x in zip(*held, strict=True)]
            yield from told(rows, np.array([0, len(rows[0])]))
        release()

    return run


def _shared_keys(sketches: DataFrame) -> DataFrame:
    """_key, _leaf, _size, _pos of the first shingles that several texts have."""
    keyed = sketches.select("_leaf", "_size", "_salts", F.posexplode("_keys").alias("_pos", "_key"))
    salt = F.when(F.get("_salts", F.col("_pos")) > 1, F.pmod(F.xxhash64("_leaf"), F.get("_salts", F.col("_pos")))).otherwise(-1).cast("int")
    keyed = keyed.select("_key", salt.alias("_salt"), "_leaf", "_size", "_pos")
    return keyed.repartition("_key", "_salt").sortWithinPartitions("_key", "_salt").mapInArrow(_shared, keyed.schema).drop("_salt")


def _meetings(shared: DataFrame, sketches: DataFrame, groups: DataFrame, pairs_of, similarity: float, heavy: int) -> DataFrame:
    """Pairs (a, b, dense) of different groups (vertex, root) that meet under a shingle and can be similar enough; a text of no group is one by itself.

    Bitmaps of bounded width travel with the rows, so that pairs which they rule out are never rows.
    """
    labelled = _labelled(shared, groups)
    # how many rows a shingle has, and whether groups meet there at all; combined before the shuffle
    live = labelled.groupBy("_key").agg(F.count("*").alias("_n"), F.min("_label").alias("_x"), F.max("_label").alias("_y")).where("_x != _y")
    rows = labelled.join(live.select("_key", (1 + F.floor(F.col("_n") / heavy)).cast("int").alias("_parts")), "_key")
    rows = rows.join(sketches.select("_leaf", "_bits"), "_leaf")
    return _dealt(rows, "_leaf", "_label", "_size", "_pos", "_bits").mapInArrow(_met(pairs_of, similarity), _MET).distinct()


_MET = "a long, b long, dense boolean"


def _labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups.withColumnRenamed("vertex", "_leaf"), "_leaf", "left").withColumn("_label", F.coalesce("root", "_leaf")).drop("root")


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """_key, _sub and the columns, ordered by key and sub; a key of several _parts has a sub for each two of them."""
    part = F.pmod(F.xxhash64("_leaf"), F.col("_parts")).cast("int")
    subs = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda x: F.least(x, part) * F.col("_parts") + F.greatest(x, part))
    rows = rows.select("_key", F.explode(F.when(F.col("_parts") == 1, F.array(F.lit(0))).otherwise(subs)).alias("_sub"), *columns)
    return rows.repartition("_key", "_sub").sortWithinPartitions("_key", "_sub", "_leaf")


def _blocks(dense: DataFrame, held: DataFrame, size: Column, groups: DataFrame, heavy: int) -> DataFrame:
    """The rows of held (_leaf, ...) that dense pairs (a, b) connect: _key, their block, _parts, into how many it is dealt by rows and bytes, and _label."""
    block = components(dense.select("a", "b")).select(F.col("root").alias("_key"), F.col("vertex").alias("_leaf"))
    rows = _labelled(held.join(block, "_leaf"), groups)
    sums = rows.groupBy("_key").agg((1 + F.floor(F.greatest(F.count("*") / heavy, F.sum(size) / BLOCK_BYTES))).cast("int").alias("_parts"))
    return rows.join(sums, "_key")


def _links_of_blocks(dense: DataFrame, sketches: DataFrame, rows: DataFrame, groups: DataFrame, similarity: float, words_each: int, heavy: int) -> DataFrame:
    """Links (a, b) of different groups among texts that dense pairs connect, as many as join up all groups that links join."""
    whole = sketches.select("_leaf", "_size", F.lit(0).alias("_pos"), F.coalesce("_wide", "_bits").alias("_bits"))
    split = _dealt(_blocks(dense, whole, F.length("_bits"), groups, heavy), "_leaf", "_label", "_size", "_pos", "_bits")
    split = materialise(split.mapInArrow(_met(_all_pairs, similarity), _MET).distinct(), "split")
    found, dense = _checked(split.where("NOT dense").select("a", "b"), sketches, rows, similarity, words_each), split.where("dense")
    if dense.isEmpty():
        return found
    sets = _sets(dense.select(F.explode(F.array("a", "b")).alias("_leaf")).distinct(), sketches, rows, words_each)
    block = _dealt(_blocks(dense, sets, 8 * F.size("_set"), groups, heavy), "_leaf", "_label", "_set")
    linked = block.mapInArrow(_met(_all_links, similarity, ("_key", "_sub", "_leaf", "_label", "_set")), _MET)
    return found.unionByName(linked.select("a", "b"))


def _who(id_col: str, text_col: str):
    """128 bits of id and text; nulls differ from empty ones."""
    of = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(of(id_col), F.lit("\0"), of(text_col)).cast("binary")))


def _grouped(docs: DataFrame, *, similarity: float = SIMILARITY, words_each: int = WORDS_EACH, budget: int = BUDGET, blocks: int = BLOCKS, heavy: int = HEAVY, id_col: str, text_col: str) -> DataFrame:
    """(_id, _who, _leaf, _root) of all rows that are linked to another."""
    return settled(docs.sparkSession, "groups", lambda: _linked(docs, similarity, words_each, budget, blocks, heavy, id_col, text_col))


def _linked(docs: DataFrame, similarity: float, words_each: int, budget: int, blocks: int, heavy: int, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("_id"), _who(id_col, text_col).alias("_who"), content(text_col).alias("_content"))
    sketches = _sketches(rows, docs.count(), similarity, words_each, heavy)
    found = materialise(_checked(_forest(sketches, budget, blocks, simhash.HEAVY), sketches, rows, similarity, words_each), "near-links")
    shared = materialise(_shared_keys(sketches), "shared")
    groups = components(found)
    for pairs_of in (_star, _all_pairs):
        met = materialise(_meetings(shared, sketches, groups, pairs_of, similarity, heavy), "meetings")
        far, dense = _checked(met.where("NOT dense").select("a", "b"), sketches, rows, similarity, words_each), met.where("dense")
        if not dense.isEmpty():
            far = far.unionByName(_links_of_blocks(dense, sketches, rows, groups, similarity, words_each, heavy))
        far = materialise(far, "far-links")
        if not far.isEmpty():
            found = found.unionByName(far)
            groups = components(found)
    return sketches.select("_leaf", "_id", "_who").join(groups.select(F.col("vertex").alias("_leaf"), F.col("root").alias("_root")), "_leaf")


def similar_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, group): the rows that are linked to another; group is the least id of the rows that links reach.

    Texts of fewer than five words have one shingle, all their words; null
    texts and texts without words are alike. Repeated rows come back each. A
    null id names a group only if the group has no other. An empty table gives
    no rows. Whole texts count, however long; other columns, whatever their
    names, are not read.
    """
    found = _grouped(docs, id_col=id_col, text_col=text_col, **options)
    least = found.groupBy("_root").agg(F.min("_id").alias("_least"))
    return found.join(least, "_root").select(F.col("_id").alias(id_col), F.col("_least").alias("group"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, that with the least id (null last), and all documents without links.

    All columns stay as they are, whatever their names; rows that repeat both
    id and text stay or go together. Null texts and texts without words are
    alike, so one of them stays. An empty table stays empty. Whole texts
    count, however long. Texts travel only for candidates; the result is docs
    less the rows that go, which are found by 128 bits of id and text.
    """
    found = _grouped(docs, id_col=id_col, text_col=text_col, **options)
    kept = found.groupBy("_root").agg(F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_who").alias("w")))["w"].alias("_kept"))
    name = unused(docs, "_who")
    gone = found.join(kept, "_root").where("_who != _kept").select(F.col("_who").alias(name)).distinct()
    return docs.withColumn(name, _who(id_col, text_col)).join(gone, name, "left_anti").drop(name)
