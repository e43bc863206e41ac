"""Best-fit packing with bin completion: as few sequences as can be found.

Documents are encoded where they lie and cut, only if they are too long, into a
first remainder and full sequences; from there on lengths travel. Remainders are
dealt out by a hash of their number into groups of bounded size. In a group,
best fit decreasing gives the incumbent, and a bound tells how few sequences
are possible at all. Where these differ, branch and bound looks for less: it
takes the largest length left, enumerates the fillings of its sequence that no
other filling dominates, least waste first, goes on with each, and turns back
where the waste so far leaves no way to beat the incumbent.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import content, materialise, release, table
from tidegraph.llm.encoders import byte_level
from tidegraph.llm.tokens import public_vocabulary

CAPACITY = 1024
END_ID = 2
#: Remainders that one task packs.
GROUP_PIECES = 25_000
#: Fillings that are built for one sequence, of how many items, and how many of them are gone into.
TRIED, ITEMS, FILLINGS = 100, 3, 6
#: Sequences tried in all, for each that the incumbent has.
EFFORT = 2

Filling = tuple[int, ...]


def least(lengths: Counter, capacity: int) -> int:
    """A bound below: for each k, lengths over half the capacity each need a sequence, and those of k or more go into their gaps or into further ones."""
    sizes = np.zeros(capacity + 1, np.int64)
    sizes[list(lengths)] = list(lengths.values())
    count, total = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(sizes * np.arange(capacity + 1)))
    half = capacity // 2
    large = count[-1] - count[half + 1]
    k = np.arange(half + 1)
    # large ones that leave room for k, and what all of their gaps hold
    fit = count[capacity - k + 1] - count[half + 1]
    gaps = fit * capacity - (total[capacity - k + 1] - total[half + 1])
    small = total[half + 1] - total[k]
    return int((large + np.maximum(0, -(-(small - gaps) // capacity))).max())


def best_fit(lengths: Counter, capacity: int) -> list[Filling]:
    """Best fit decreasing: each length into the fullest sequence that has room for it."""
    held: list[list[int]] = []
    at: dict[int, list[int]] = {}
    gaps = 0
    for length in sorted(lengths, reverse=True):
        for _ in range(lengths[length]):
            fitting = gaps >> length
            if fitting:
                gap = length + (fitting & -fitting).bit_length() - 1
                which = at[gap].pop()
                if not at[gap]:
                    gaps ^= 1 << gap
                held[which].append(length)
            else:
                gap, which = capacity, len(held)
                held.append([length])
            at.setdefault(gap - length, []).append(which)
            gaps |= 1 << (gap - length)
    return [tuple(x) for x in held]


class Stock:
    """The lengths that are left: how many of each, and the bits of those that are there."""

    def __init__(self, lengths: Counter):
        self.count, self.bits = dict(lengths), 0
        for length in lengths:
            self.bits |= 1 << length

    def take(self, filling: Filling) -> None:
        for length in filling:
            self.count[length] -= 1
            if not self.count[length]:
                self.bits ^= 1 << length

    def put(self, filling: Filling) -> None:
        for length in filling:
            if not self.count[length]:
                self.bits ^= 1 << length
            self.count[length] += 1

    def _under(self, length: int) -> Iterator[int]:
        """The lengths that are left up to this one, longest first."""
        there = self.bits & ((1 << (length + 1)) - 1)
        while there:
            found = there.bit_length() - 1
            yield found
            there ^= 1 << found

    def _longest(self, most: int, *taken: int) -> int:
        """The longest that is left up to most, besides what is taken; 0 if there is none."""
        return next((x for x in self._under(most) if self.count[x] > taken.count(x)), 0)

    def _sets(self, room: int, longest: int) -> Iterator[Filling]:
        """Two or three lengths that hold more than the longest single one; the last is the longest that still fits."""
        for x in self._under(longest):
            y = self._longest(min(x, room - x), x)
            if not y or 3 * x <= longest:
                return
            if x + y > longest:
                yield (x, y)
        for x in self._under(longest):
            if 3 * x <= longest:
                return
            for y in self._under(min(x, room - x)):
                if x + 2 * y <= longest:
                    break
                z = self._longest(min(y, room - x - y), x, y) if y != x or self.count[x] > 1 else 0
                if z and x + y + z > longest:
                    yield (x, y, z)

    def dominated(self, filling: Filling, waste: int) -> bool:
        """Whether a length that is left could take the place of some of the filling's, at least as long as they together, and still fit."""
        own = Counter(filling)
        for some in range(1 << len(filling)):
            part = [x for i, x in enumerate(filling) if some >> i & 1]
            total = sum(part)
            # a single one must give way to a longer one
            low = total + (len(part) == 1) + (not part)
            fits = self.bits >> low & ((1 << max(0, total + waste - low + 1)) - 1)
            while fits:
                x = low + (fits & -fits).bit_length() - 1
                if self.count[x] > own[x]:
                    return True
                fits &= fits - 1
        return False

    def fillings(self, room: int, most_waste: int) -> list[Filling]:
        """Undominated fillings of the room, least waste first, of the first TRIED that are built; each leaves at most so much.

        A length that fits dominates all that add up to no more than it. The
        longest that fit, one after the other, are a filling too, for rooms of
        many short ones.
        """
        longest = self._longest(room)
        if not longest:
            return [()] if room <= most_waste else []
        greedy, left, there = [], room, self.bits & ((1 << (room + 1)) - 1)
        while there:
            length = there.bit_length() - 1
            n = min(self.count[length], left // length)
            greedy += [length] * n
            left -= n * length
            there &= (1 << min(length, left + 1)) - 1
        if longest == room:
            return [(longest,)]
        found = dict.fromkeys([tuple(greedy), (longest,), *islice(self._sets(room, longest), TRIED)])
        ordered = sorted((room - sum(x), len(x), x) for x in found)
        good = (x for waste, items, x in ordered if waste <= most_waste and (items > ITEMS or not self.dominated(x, waste)))
        return list(islice(good, FILLINGS))


def complete(lengths: Counter, capacity: int, effort: int = EFFORT) -> list[Filling]:
    """Sequences that use up the lengths, as few as branch and bound finds in effort steps for each of the incumbent's."""
    best, bound = best_fit(lengths, capacity), least(lengths, capacity)
    steps, total = effort * len(best), sum(length * n for length, n in lengths.items())
    stock, path, open_ = Stock(lengths), [], []
    waste = 0
    while len(best) > bound and steps > 0:
        allowed = (len(best) - 1) * capacity - total
        if not stock.bits:
            best = list(path)
        elif len(path) + least(Counter({k: n for k, n in stock.count.items() if n}), capacity) < len(best):
            first = stock.bits.bit_length() - 1
            stock.take((first,))
            open_.append((first, iter(stock.fillings(capacity - first, allowed - waste))))
            path.append(None)
        # the next filling of the sequence that was opened last; without one, the one before is opened again
        while open_:
            first, fillings = open_[-1]
            if path[-1] is not None:
                stock.put(path[-1][1:])
                waste -= capacity - sum(path[-1])
                path[-1] = None
            filling = next(fillings, None)
            if filling is not None and waste + capacity - first - sum(filling) <= (len(best) - 1) * capacity - total:
                stock.take(filling)
                path[-1] = (first, *filling)
                waste += capacity - sum(path[-1])
                break
            if filling is None:
                stock.put((first,))
                open_.pop()
                path.pop()
        steps -= 1
        if not open_:
            break
    return best


def _cut(path: str, capacity: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = byte_level(path, plain_specials=False)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column("_content")):
                ids = np.append(of.ids(text.as_py().decode("utf-8", "replace")), end_id).astype("<u4")
                bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for number, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append(row)
                    piece.append(number)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(ids[low:high].tobytes()))
            columns = [batch.column("_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "piece", "start", "length", "ids_crc32"])
        release()

    return cut


def pieces(docs: DataFrame, *, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): every document's ids and the end id; only longer ones than capacity are cut, and only the first piece may be shorter."""
    rows = docs.select(F.col(id_col).alias("_id"), content(text_col).alias("_content"))
    kind = rows.schema["_id"].dataType.simpleString()
    path = vocabulary or public_vocabulary("byte_bpe_50k.json")
    return rows.mapInArrow(_cut(path, capacity, end_id), f"_id {kind}, piece int, start long, length long, ids_crc32 long")


def _group(capacity: int, groups: int, effort: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_number"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        values, first, counts = np.unique(lengths, return_index=True, return_counts=True)
        following = dict(zip(values.tolist(), first.tolist(), strict=True))
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for number, filling in enumerate(complete(Counter(dict(zip(values.tolist(), counts.tolist(), strict=True))), capacity, effort)):
            at = 0
            for length in filling:
                row = following[length]
                following[length] += 1
                sequence[row], offset[row] = number, at
                at += length
        # odd, as full pieces have even ones
        return pdf.assign(sequence_id=2 * (sequence * groups + pdf["_group"].to_numpy()) + 1, offset=offset)[["_number", "sequence_id", "offset"]]

    return pack


def pack(docs: DataFrame, *, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, effort: int = EFFORT, id_col: str = "doc_id", text_col: str = "text", **encoding) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id, a piece of length 1. Sequences hold at
    most capacity tokens, laid out from 0 without gaps; full pieces are one
    each. Null ids stay null; repeated rows are packed each by itself, dealt
    by their numbers, however alike they are; an empty table gives no rows; a
    very long text is many full pieces, which no task collects; other columns,
    whatever their names, are not read. Each group of remainders may end in a
    sequence that is not full, one for group_pieces of them.
    """
    numbered = pieces(docs, capacity=capacity, id_col=id_col, text_col=text_col, **encoding).withColumn("_number", F.monotonically_increasing_id())
    # written, so that numbers stay what they are
    cut = materialise(numbered, "pieces")
    short = cut.where(F.col("length") < capacity)
    groups = max(1, math.ceil(short.count() / group_pieces))
    dealt = short.select("_number", "length", F.pmod(F.xxhash64("_number"), F.lit(groups)).alias("_group"))
    packed = dealt.groupBy("_group").applyInPandas(_group(capacity, groups, effort), "_number long, sequence_id long, offset long")
    own = ["_id", "piece", "start", "length", "ids_crc32"]
    joined = short.join(packed, "_number").select(*own, "sequence_id", "offset")
    full = cut.where(F.col("length") >= capacity).select(*own, (F.col("_number") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return joined.unionByName(full).withColumnRenamed("_id", id_col)


def op11_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
