"""Exact deduplication by Grace hashing.

Contents are dealt out by their hash, so that equal ones meet in one task. A
task keeps distinct contents in an open-addressing table that compares whole
contents. Once the table is full, a content that is not in it goes to one of
sixteen spill files by its hash, and each file is worked off in the same way
with another hash seed, until what is left fits the table. Copies of a content
that the table holds never reach a spill file, so a text that makes up a third
of the rows costs one entry.

Before the shuffle, each task folds the copies it sees (flushing instead of
spilling), so a hot text leaves one row per task and not one per copy.
"""

from __future__ import annotations

import struct
import tempfile
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.llm.common import content, release, table, unused

#: A null id is below every other.
NULL_ID = -(1 << 63)
FANOUT = 16
#: Bytes of contents that one table holds.
TABLE_BYTES = 48 << 20

_FRAME = struct.Struct("<qqqq")

#: content, largest id, rows, rows that have that id
Record = tuple[bytes, int, int, int]


class OpenAddressingTable:
    """Distinct contents, found by linear probing and compared in full."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = array("q", [-1]) * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.best: list[int] = []
        self.rows: list[int] = []
        self.ties: list[int] = []
        self.bytes = 0

    def find(self, hashed: int, what: bytes) -> tuple[int, int]:
        """The entry of these contents or -1, and the slot where the search ended."""
        mask = len(self.slots) - 1
        slot = hashed & mask
        while (entry := self.slots[slot]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == what:
                return entry, slot
            slot = (slot + 1) & mask
        return -1, slot

    def fold(self, entry: int, best: int, rows: int, ties: int) -> None:
        self.rows[entry] += rows
        if best > self.best[entry]:
            self.best[entry], self.ties[entry] = best, ties
        elif best == self.best[entry]:
            self.ties[entry] += ties

    def insert(self, slot: int, hashed: int, record: Record) -> None:
        self.slots[slot] = len(self.contents)
        self.hashes.append(hashed)
        for column, value in zip((self.contents, self.best, self.rows, self.ties), record, strict=True):
            column.append(value)
        self.bytes += len(record[0]) + 150
        if 2 * len(self.contents) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = array("q", [-1]) * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, hashed in enumerate(self.hashes):
            slot = hashed & mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot] = entry

    def records(self) -> Iterator[Record]:
        yield from zip(self.contents, self.best, self.rows, self.ties, strict=True)


def _read(path: Path) -> Iterator[Record]:
    with path.open("rb") as file:
        while head := file.read(_FRAME.size):
            size, *rest = _FRAME.unpack(head)
            yield (file.read(size), *rest)


def grace(records: Iterable[Record], budget: int = TABLE_BYTES, level: int = 0) -> Iterator[Record]:
    """One record for each distinct content, with tables of at most budget bytes."""
    import xxhash

    held = OpenAddressingTable()
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        spills: dict[int, object] = {}
        for record in records:
            hashed = xxhash.xxh3_64_intdigest(record[0], level) >> 1
            entry, slot = held.find(hashed, record[0])
            if entry >= 0:
                held.fold(entry, *record[1:])
            elif held.bytes < budget:
                held.insert(slot, hashed, record)
            else:
                bucket = (hashed >> 55) % FANOUT
                if bucket not in spills:
                    spills[bucket] = open(f"{folder}/{bucket}", "wb")  # noqa: SIM115
                spills[bucket].write(_FRAME.pack(len(record[0]), *record[1:]))
                spills[bucket].write(record[0])
        for file in spills.values():
            file.close()
        yield from held.records()
        del held
        for bucket in sorted(spills):
            path = Path(folder, str(bucket))
            yield from grace(_read(path), budget, level + 1)
            path.unlink()


def combine(records: Iterable[Record], budget: int = TABLE_BYTES) -> Iterator[Record]:
    """Folds copies as far as one table reaches; a content can come out again later."""
    import xxhash

    held = OpenAddressingTable()
    for record in records:
        hashed = xxhash.xxh3_64_intdigest(record[0]) >> 1
        entry, slot = held.find(hashed, record[0])
        if entry >= 0:
            held.fold(entry, *record[1:])
            continue
        if held.bytes >= budget:
            yield from held.records()
            held = OpenAddressingTable()
            slot = held.find(hashed, record[0])[1]
        held.insert(slot, hashed, record)
    yield from held.records()


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[Record]:
    for batch in batches:
        columns = [batch.column(name) for name in ("_best", "_rows", "_ties")]
        for what, *rest in zip(batch.column("_content"), *(c.to_pylist() for c in columns), strict=True):
            yield (what.as_py(), *rest)


def _chunks(records: Iterable[Record], most: int = 8 << 20) -> Iterator[list[Record]]:
    chunk, size = [], 0
    for record in records:
        chunk.append(record)
        size += len(record[0]) + 64
        if size >= most:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _before(budget: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(combine(_records(batches), budget)):
            what, best, rows, ties = zip(*chunk, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(what, pa.binary()), *(pa.array(x, pa.int64()) for x in (best, rows, ties))],
                ["_content", "_best", "_rows", "_ties"],
            )
        release()

    return fold


def _after(budget: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for chunk in _chunks(grace(_records(batches), budget)):
            what, best, rows, ties = zip(*chunk, strict=True)
            digests = [hashlib.sha256(x).digest() for x in what]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), *(pa.array(x, pa.int64()) for x in (best, rows, ties))],
                ["_digest", "_best", "_rows", "_ties"],
            )
        release()

    return fold


def distinct_contents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct text: _digest (SHA-256), _best (largest id), _rows, _ties (rows with that id)."""
    rows = docs.select(
        content(text_col).alias("_content"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_best"),
        F.lit(1).cast("long").alias("_rows"),
        F.lit(1).cast("long").alias("_ties"),
    )
    folded = rows.mapInArrow(_before(table_bytes), "_content binary, _best long, _rows long, _ties long")
    return folded.repartition("_content").mapInArrow(_after(table_bytes), "_digest binary, _best long, _rows long, _ties long")


def _digest(text_col: str):
    return F.unhex(F.sha2(content(text_col), 256))


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """For every row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are; a null text is empty. The row
    with the largest id stays. A null id is below all others, and keep_id is
    null where a group has no id. If several rows carry a group's largest id,
    exactly one of them is kept. An empty table gives no rows. Whole texts are
    compared, however long; one that is longer than a table is a table's only
    entry. Other columns, whatever their names, are neither read nor returned.
    """
    groups = distinct_contents(docs, id_col=id_col, text_col=text_col, table_bytes=table_bytes)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"), _digest(text_col).alias("_digest"))
    rows = rows.withColumn("_copy", F.row_number().over(W.partitionBy("_id", "_digest").orderBy("_id")))
    return rows.join(groups, "_digest").select(
        F.nullif("_id", F.lit(NULL_ID)).alias(id_col),
        F.nullif("_best", F.lit(NULL_ID)).alias("keep_id"),
        F.col("_rows").alias("group_size"),
        ((F.col("_id") == F.col("_best")) & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that exact_groups() keeps, with all their columns, whatever their names.

    Texts, nulls and ids count as there: a null text is empty, a null id is
    below all others, of rows that repeat a group's largest id and text one stays,
    any of them. Whole texts are compared, however long; an empty table stays empty. Joins on (digest, id),
    which is as even as the ids are, however many copies a text has; the
    window reuses the join's partitioning.
    """
    groups = distinct_contents(docs, id_col=id_col, text_col=text_col, table_bytes=table_bytes)
    digest, id_, copy = (unused(docs, n) for n in ("_digest", "_id", "_copy"))
    groups = groups.select(F.col("_digest").alias(digest), F.col("_best").alias(id_))
    rows = docs.withColumns({digest: _digest(text_col), id_: F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))})
    kept = rows.join(groups, [digest, id_], "left_semi")
    one = W.partitionBy(digest, id_).orderBy(id_)
    return kept.withColumn(copy, F.row_number().over(one)).where(F.col(copy) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP1_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
