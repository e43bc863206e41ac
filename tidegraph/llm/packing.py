"""Packing token sequences by minimum bin slack.

Documents are encoded where they lie; each is cut into full windows and one
remainder, and from there on only lengths travel; tokens follow at the end, if
they are wanted. Pieces are numbered when they are written, and dealt out by a
hash of their number into bins of bounded size, however alike they are. In a bin, each window starts
with the longest piece left; a subset-sum over the multiset of remaining
lengths, kept as the bits of one integer, finds the fill closest to the
capacity, and tracking back gives how many pieces of each length to take.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import content, materialise, release, table
from tidegraph.llm.tokens import encoder, public_vocabulary

CAPACITY = 4096
END_ID = 2
#: Pieces that one task packs.
BIN_PIECES = 25_000


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _cut(path: str, capacity: int, end_id: int, with_ids: bool, remembered: int | None):
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path, as_bytes, remembered)
        for batch in batches:
            rows, starts, lengths, crcs, totals, ids = [], [], [], [], [], []
            texts = (x.as_py() for x in batch.column("_content"))
            parts = (of.by_words if of.words else of.whole)(texts)
            for row, part in enumerate(parts):
                encoded = b"".join(part) + end
                for at in range(0, len(encoded), 4 * capacity):
                    piece = encoded[at : at + 4 * capacity]
                    rows.append(row)
                    starts.append(at // 4)
                    lengths.append(len(piece) // 4)
                    crcs.append(zlib.crc32(piece))
                    totals.append(len(encoded) // 4)
                    if with_ids:
                        ids.append(piece)
            columns = [batch.column("_id").take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))]
            names = ["_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        release()

    return cut


def token_pieces(docs: DataFrame, *, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, remembered: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids and the end id, cut into windows and a remainder.

    with_ids adds the piece's ids, little-endian unsigned 32-bit. remembered
    is how many words a worker remembers, if not tokens.REMEMBERED.
    """
    rows = docs.select(F.col(id_col).alias("_id"), content(text_col).alias("_content"))
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return rows.mapInArrow(_cut(vocabulary or public_vocabulary(), capacity, end_id, with_ids, remembered), schema)


def minimum_bin_slack(lengths: dict[int, int], capacity: int) -> Iterator[list[tuple[int, int]]]:
    """Windows as lists of (length, count), until the multiset is used up."""
    left = dict(lengths)
    present = 0
    for length in left:
        present |= 1 << length
    while present:
        seed = present.bit_length() - 1
        taken: dict[int, int] = defaultdict(int)
        taken[seed] = 1
        left[seed] -= 1
        if not left[seed]:
            present ^= 1 << seed
        room = capacity - seed
        mask = (1 << (room + 1)) - 1
        reach, steps, candidates = 1, [], present & mask
        while candidates and not reach >> room:
            length = candidates.bit_length() - 1
            candidates ^= 1 << length
            for _ in range(min(left[length], room // length)):
                wider = (reach | reach << length) & mask
                if wider == reach:
                    break
                steps.append((length, reach))
                reach = wider
                if reach >> room:
                    break
        fill = reach.bit_length() - 1
        for length, before in reversed(steps):
            if not before >> fill & 1:
                taken[length] += 1
                fill -= length
                left[length] -= 1
                if not left[length]:
                    present ^= 1 << length
        yield list(taken.items())


def _pack(capacity: int, bins: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_id", "start", "ids_crc32", "doc_tokens", "_piece"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        values, first, counts = np.unique(lengths, return_index=True, return_counts=True)
        following = dict(zip(values.tolist(), first.tolist(), strict=True))
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for number, window in enumerate(minimum_bin_slack(dict(zip(values.tolist(), counts.tolist(), strict=True)), capacity)):
            at = 0
            for length, count in window:
                for _ in range(count):
                    row = following[length]
                    following[length] += 1
                    sequence[row], offset[row] = number, at
                    at += length
        return pdf.assign(sequence_id=sequence * bins + pdf["_bin"].to_numpy(), offset=offset)

    return pack


def pack(docs: DataFrame, *, capacity: int = CAPACITY, bin_pieces: int = BIN_PIECES, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", **encoding) -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with_ids adds ids, little-endian unsigned 32-bit.

    A document is its ids and the end id, so a null or empty text is one piece
    of length 1. Pieces are laid out from offset 0 without gaps; no sequence
    is longer than capacity. Null ids stay null; repeated rows are packed each
    by itself, in as many bins as there are; an empty table gives no rows;
    texts are cut at capacity, so very long ones are many pieces; other
    columns, whatever their names, are not read. What is short of capacity is
    padding, unless the length is a power of two.
    """
    found = token_pieces(docs, capacity=capacity, with_ids=with_ids, id_col=id_col, text_col=text_col, **encoding)
    cut = materialise(found.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    bins = max(1, math.ceil(cut.count() / bin_pieces))
    dealt = cut.select("_id", "start", "length", "ids_crc32", "doc_tokens", "_piece", F.pmod(F.xxhash64("_piece"), F.lit(bins)).alias("_bin"))
    kind = cut.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, _piece long, _bin long, sequence_id long, offset long"
    packed = dealt.groupBy("_bin").applyInPandas(_pack(capacity, bins), schema)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        packed = packed.join(cut.select("_piece", "ids"), "_piece")
        names.append("ids")
    return packed.select(F.col("_id").alias(id_col), *names)


def sequences(packed: DataFrame) -> DataFrame:
    """Of pack(with_ids=True): (sequence_id, length, ids, starts), a sequence's ids in order and where its pieces begin; padding is left to the reader."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), pieces.alias("_p"))
    # at most capacity pieces to a sequence
    return whole.select("sequence_id", "length", F.aggregate("_p", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"), F.col("_p.offset").alias("starts"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
