"""WARC archives: writing, normalising monolithic gzip, reading by offset.

Spark's text sink writes records as whole-file gzip streams, which can only be
read from the start. The normaliser inflates each stream once, block by block,
rewrites every record as a gzip member of its own and writes a sidecar index of
offsets next to the archive; with it a record is read by one seek.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.llm.common import materialise, new_folder, table

DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of an archive that one task reads back.
SLICE_BYTES = 16 << 20
INDEX = "archive string, offset long, length long, record_id string, record_type string"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, from four runs of 40 bits."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _id(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("null")), F.lit(">"))


def records(pages: DataFrame, *, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """One WARC record per row, as text (value) without its closing blank lines.

    Of equal payloads of at least least_bytes, the one with the smallest id is
    a response and the others are revisits of it; if several rows have that
    id, one is the response. Only payloads that occur more than once are ordered. Null ids count only where a payload has no other.
    A null payload is empty; a null url is an empty one, and line breaks in a
    url are taken out. An empty table gives no records; whole payloads are
    written, however long; other columns, whatever their names, are not read.
    """
    html = F.coalesce(F.col(text_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"),
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\r\n]+", "").alias("_url"),
        html.alias("_html"),
        F.octet_length(html).cast("long").alias("_bytes"),
        F.unhex(F.sha2(html.cast("binary"), 256)).alias("_same"),
    )
    # written first, so that its size is known: Spark broadcasts it if small, and shuffles pages only if not
    same = materialise(rows.groupBy("_same").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"), "same")
    alone = rows.join(same, "_same", "left_anti").withColumns({"_first": F.col("_id"), "_copy": F.lit(1)})
    among = rows.join(same, "_same").withColumn("_copy", F.row_number().over(W.partitionBy("_same", "_id").orderBy("_url")))
    rows = alone.unionByName(among)
    response = (F.col("_bytes") < least_bytes) | (F.col("_id").eqNullSafe(F.col("_first")) & (F.col("_copy") == 1))
    end = F.lit("\r\n")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit("\r\n\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(response, "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: "), _id("_id"),
        F.when(response, "").otherwise(F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT}\r\nWARC-Refers-To: "), _id("_first"))),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.col("_url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(F.col("_html").cast("binary")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(response, F.col("_bytes")).otherwise(0)).cast("string"), end, end,
    )
    return rows.select(F.concat(head, http, F.when(response, F.col("_html")).otherwise("")).alias("value"))


def write_archives(found: DataFrame, folder: str) -> None:
    """Each partition as one gzip stream of records."""
    found.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)


def inflate(blocks: Iterable[bytes], most: int = 1 << 20) -> Iterator[bytes]:
    """The contents of a gzip stream of one or more members, in pieces of at most most bytes.

    Raises if the stream is cut, also where that is between two records.
    """
    stream = None
    for block in blocks:
        while block:
            if stream is None:
                stream = zlib.decompressobj(31)
            yield stream.decompress(block, most)
            block = stream.unconsumed_tail
            if stream.eof:
                block, stream = stream.unused_data, None
    while stream is not None:
        rest = stream.decompress(stream.unconsumed_tail, most)
        if stream.eof:
            stream = None
        elif not rest:
            raise ValueError("the gzip stream is cut")
        yield rest


def split_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and the record's bytes with its closing blank lines.

    Raises if the stream ends within a record.
    """
    held, need, headers = bytearray(), 0, None
    for piece in pieces:
        held += piece
        while True:
            if headers is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                lines = bytes(held[:end]).decode("utf-8", "replace").split("\r\n")
                headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
                headers[""] = lines[0]
                need = end + 8 + int(headers["content-length"])
            if len(held) < need:
                break
            yield headers, bytes(held[:need])
            del held[:need]
            headers = None
    if held.strip(b"\r\n"):
        raise ValueError("the archive ends within a record")


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _blocks(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    store, base = _open(path)
    with store.open_input_stream(base, compression=None) as file:
        while block := file.read(size):
            yield block


def _put(store, draft: str, target: str) -> None:
    """A task that runs again replaces a file by the same bytes."""
    from pyarrow import fs

    if store.get_file_info(target).type != fs.FileType.NotFound:
        store.delete_file(target)
    store.move(draft, target)


def _normalised(folder: str, entries: int = 10_000):
    names = ["archive", "offset", "length", "record_id", "record_type"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name = path.rsplit("/", 1)[-1].split(".")[0] + ".warc.gz"
                store, base = _open(folder)
                draft = f"{base}/.{name}.{uuid.uuid4().hex}"
                index, at = [], 0
                with store.open_output_stream(draft) as out, store.open_output_stream(f"{draft}.idx") as lines:
                    for headers, record in split_records(inflate(_blocks(path))):
                        packed = member(record)
                        out.write(packed)
                        index.append((at, len(packed), headers["warc-record-id"], headers["warc-type"]))
                        lines.write(("\t".join(map(str, index[-1])) + "\n").encode())
                        at += len(packed)
                        if len(index) >= entries:
                            yield batch_of(name, index)
                            index = []
                _put(store, draft, f"{base}/{name}")
                _put(store, f"{draft}.idx", f"{base}/{name}.idx")
                yield batch_of(name, index)

    def batch_of(name: str, index: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*index, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"] * len(index), pa.string()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names)

    return run


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites every gzip archive in source to target, a record a member; returns the index.

    Archives are read as streams, so they can be of any size: a task holds a
    block of an archive and one record. source and target are folders of file
    systems that pyarrow knows (file, hdfs, s3, gs). Beside each archive its
    index is written as name.idx, with offset, length, record id and type in
    each line. An archive that is cut raises.
    """
    store, base = _open(target)
    store.create_dir(base, recursive=True)
    # only paths and lengths are read here, by which Spark deals the archives out; "*" leaves out marker files, which have no gzip suffix
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    return materialise(files.mapInArrow(_normalised(target), INDEX), "warc-index")


READ = "record_id string, record_type string, refers_to string, uri string, payload_digest string, payload_bytes long, payload binary"


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            rows, size = [], 0
            for entry in batch.to_pylist():
                if entry["archive"] != name:
                    name = entry["archive"]
                    store, base = _open(name)
                    file = store.open_input_file(base)
                file.seek(entry["offset"])
                whole = zlib.decompress(file.read(entry["length"]), 31)
                ((headers, record),) = split_records([whole])
                body = record[record.index(b"\r\n\r\n") + 4 : -4]
                http, _, payload = body.partition(b"\r\n\r\n")
                full = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                if headers["warc-type"] == "response" and (len(payload) != full or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"{headers['warc-record-id']}: the payload is not the one that was written")
                rows.append({"record_id": headers["warc-record-id"], "record_type": headers["warc-type"], "refers_to": headers.get("warc-refers-to"), "uri": headers["warc-target-uri"], "payload_digest": digest, "payload_bytes": full, "payload": payload if with_payload else None})
                size += len(payload) * with_payload
                if size > 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _READ)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, _READ)

    return run


_READ = pa.schema([*((n, pa.string()) for n in ("record_id", "record_type", "refers_to", "uri", "payload_digest")), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def read_archives(index: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """The records that the index names, each by a seek; responses are held against their digest.

    Archives are read in slices, so a large one keeps several tasks busy.
    """
    part = F.floor(F.col("offset") / SLICE_BYTES)
    dealt = index.repartition("archive", part).sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(_read(with_payload), READ)


def _page(column: str) -> Column:
    return F.regexp_extract(column, r"urn:page:(-?\d+)>", 1)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes, normalises and reads back; one row per page."""
    plain, target = new_folder(spark, "warc-plain"), new_folder(spark, "warc")
    write_archives(records(table(spark, sf_dir, "pages")), plain)
    found = read_archives(normalise(spark, plain, target), with_payload=False)
    page = lambda c: F.when(_page(c) != "", _page(c).cast("long"))
    return found.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


OP4_SQL = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
         row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS place,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       translate(to_base(('0x' || hex[1:10])::BIGINT, 32, 8) || to_base(('0x' || hex[11:20])::BIGINT, 32, 8)
                 || to_base(('0x' || hex[21:30])::BIGINT, 32, 8) || to_base(('0x' || hex[31:40])::BIGINT, 32, 8),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first END AS refers_to
FROM rows
"""
