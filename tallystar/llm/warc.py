"""WARC archives with revisit records, and a two-level capture index over them.

Writing: each page becomes one gzip member, so any record can be read by its byte range. Spark's text writer puts the
members into files of the shared folder; the separator it writes after each row is an empty gzip member, so the files
are valid multi-member archives. Each task adds up the bytes it writes and begins a new file before one outgrows
``FILE_BYTES``, so that a file fits a task that reads it. A payload of at least ``MIN_REVISIT`` bytes that occurs again is stored once, by the
smallest page id; the others become revisit records that name it and repeat its digest and length in their headers.

Index: captures are sorted by reversed-host URL key into blocks of compressed lines; a directory holds the first and
last key of each block. A search goes through the directory by bisection, through the block by bisection, and then
reads only the byte range of the record.

Defined results: a null html is an empty payload; a null url has the empty key and no target header, and line breaks in
a url are percent-encoded; a null page id stays null and always revisits. Repeated rows become one record each (rows
with the smallest page id of their payload are all responses). An empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.common import texts
from tallystar.scratch import fresh_dir, stage

MIN_REVISIT = 100
FILE_BYTES = 8 << 20  # of an archive file; a larger record has a file to itself
BLOCK_LINES = 512
BROADCAST_BYTES = 32 << 20  # a larger block directory is joined instead of sent to every task
GZIP = 31
EMPTY_MEMBER = zlib.compressobj(wbits=GZIP).flush()
DATE = "2024-01-01T00:00:00Z"
CAPTURES = "key string, page_id string, file string, offset long, length long"
RECORDS = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


@dataclass(frozen=True)
class Archive:
    spark: SparkSession
    files: str
    captures: DataFrame | None = None  # blocks: number, first, last, size, lines
    directory: DataFrame | None = None  # number, first, last


# ---- writing ------------------------------------------------------------------------------------------------


def url_key(url: str | None) -> str:
    """``http://www.Example.com/a?b`` becomes ``com,example,www)/a?b``."""
    if url is None:
        return ""
    for mark in "\r\n\x01":
        url = url.replace(mark, f"%{ord(mark):02X}")
    rest = url.partition("://")[2] if "://" in url else url
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


def _record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id or ''}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").replace("\x01", "%01"))
    if refers_to:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    """Writes a record per row below the shared folder."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    sized = rows.select("page_id", "digest").where(F.octet_length("payload") >= MIN_REVISIT)
    repeated = sized.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = stage(repeated.where("n > 1").drop("n"), "repeated")
    # Spark broadcasts the stored repeats if they are small; else AQE splits the pages of a digest that is frequent.
    marked = rows.join(repeated, "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    marked = marked.select(
        F.col("page_id").cast("string"), "url", "payload", "digest", refers.cast("string").alias("refers_to")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = filled = 0
        for batch in batches:
            members, shares = [], []
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                packer = zlib.compressobj(level=4, wbits=GZIP)
                members.append(packer.compress(_record(*row)) + packer.flush())
                size = len(members[-1]) + len(EMPTY_MEMBER)
                if filled and filled + size > FILE_BYTES:
                    share, filled = share + 1, 0
                filled += size
                shares.append(share)
            arrays = [pa.array(members, pa.binary()), pa.array(shares, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["member", "share"])

    files = f"{fresh_dir(spark, 'warc')}/files"
    writer = marked.mapInArrow(work, "member binary, share int").select(F.col("member").cast("string"), "share").write
    writer = writer.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.partitionBy("share").text(files)
    return Archive(spark, files)


# ---- reading records ----------------------------------------------------------------------------------------


def members(content: bytes, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member that is not empty."""
    start = 0
    while start < len(content):
        unpack, parts, at = zlib.decompressobj(GZIP), [], start
        while not unpack.eof:
            if at >= len(content):
                raise ValueError(f"the member at {start} is cut off")
            parts.append(unpack.decompress(content[at : at + step]))
            at = min(at + step, len(content))
        end = at - len(unpack.unused_data)
        if any(parts):
            yield start, end - start, b"".join(parts)
        start = end


def parse(record: bytes) -> dict[str, object]:
    """Fields of a record, with the digest and length of the whole payload, which a revisit has in its headers only."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't match its digest")

    def bare(name: str) -> str | None:
        return fields.get(name, "")[len("<urn:page:") : -1] or None

    return {
        "page_id": bare("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": bare("WARC-Refers-To"),
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


# ---- index --------------------------------------------------------------------------------------------------


def _archive_files(archive: Archive) -> DataFrame:
    return archive.spark.read.format("binaryFile").load(archive.files).select("path", "content")


def build_index(archive: Archive) -> Archive:
    """Scans the archives and writes sorted blocks and their directory below the shared folder."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(texts(batch, "path"), batch.column(1), strict=True):
                rows = []
                for offset, length, record in members(content.as_py()):
                    found = parse(record)
                    rows.append((url_key(found["url"]), found["page_id"], path, offset, length))
                columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 5
                kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "page_id", "file", "offset", "length"])

    captures = stage(_archive_files(archive).mapInArrow(scan, CAPTURES), "captures")
    order = ["key", "page_id", "file", "offset"]
    placed = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("*", F.spark_partition_id().alias("part"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = 0

        def block(lines: list[tuple]) -> pa.RecordBatch:
            # Keys come first in a line and hold no line break; a separator that sorts first keeps lines in key order.
            text = "\n".join("\x01".join("" if v is None else str(v) for v in line[:5]) for line in lines)
            row = {"number": (lines[0][5] << 40) + number, "first": lines[0][0], "last": lines[-1][0]}
            row |= {"size": len(lines), "lines": zlib.compress(text.encode())}
            return pa.RecordBatch.from_pylist([row], schema)

        kinds = [("number", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("size", pa.int32())]
        schema = pa.schema([*kinds, ("lines", pa.binary())])
        for batch in batches:
            held.extend(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            while len(held) >= BLOCK_LINES:
                yield block(held[:BLOCK_LINES])
                held, number = held[BLOCK_LINES:], number + 1
        if held:
            yield block(held)

    blocks = placed.mapInArrow(pack, "number long, first string, last string, size int, lines binary")
    blocks = stage(blocks, "capture-blocks")
    return Archive(archive.spark, archive.files, blocks, stage(blocks.select("number", "first", "last"), "directory"))


def matching(lines: bytes, keys: list[str]) -> list[list[str]]:
    """The captures of one compressed block that have one of the keys, by bisection."""
    rows = [line.split("\x01") for line in zlib.decompress(lines).decode().split("\n")]
    order = [row[0] for row in rows]
    return [row for key in keys for row in rows[bisect_left(order, key) : bisect_right(order, key)]]


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """File, offset and length of the captures of each block that have one of the row's keys, or of all."""
    for batch in batches:
        files, offsets, lengths = [], [], []
        keys = texts(batch, "keys")
        for lines, own in zip(texts(batch, "lines"), keys, strict=True):
            for row in matching(lines, own):
                files.append(row[2])
                offsets.append(int(row[3]))
                lengths.append(int(row[4]))
        arrays = [pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["file", "offset", "length"])


def search(archive: Archive, urls: DataFrame, url: str = "url") -> DataFrame:
    """Columns ``file``, ``offset``, ``length``: the captures of each distinct url.

    The directory goes to every task if it is small. Beyond that bound all blocks are unpacked and joined by key.
    """
    as_key = F.pandas_udf(lambda s: s.map(url_key, na_action=None), "string")
    keys = urls.select(as_key(F.col(f"`{url}`")).alias("key")).distinct()
    size = archive.directory.agg(F.sum(F.octet_length("first") + F.octet_length("last") + 64)).first()[0] or 0
    if size > BROADCAST_BYTES:
        unpacked = archive.captures.mapInArrow(_unpack, CAPTURES)
        return unpacked.join(keys, "key", "left_semi").select("file", "offset", "length")
    shared = archive.spark.sparkContext.broadcast(
        sorted((r["first"], r["last"], r["number"]) for r in archive.directory.collect())
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = [r[0] for r in shared.value], [r[1] for r in shared.value]
        for batch in batches:
            found = [
                (shared.value[i][2], key)
                for key in texts(batch, "key")
                for i in range(bisect_left(last, key), bisect_right(first, key))
            ]
            numbers, names = pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())
            yield pa.RecordBatch.from_pydict({"number": numbers, "key": names})

    # A block has at most BLOCK_LINES keys, so the list of those that are wanted of it is short.
    wanted = keys.mapInArrow(find, "number long, key string").groupBy("number").agg(F.collect_set("key").alias("keys"))
    return archive.captures.join(wanted, "number").select("lines", "keys").mapInArrow(
        _captures, "file string, offset long, length long"
    )


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lines in texts(batch, "lines"):
            rows = [line.split("\x01") for line in zlib.decompress(lines).decode().split("\n")]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([r[0] for r in rows]),
                    "page_id": pa.array([r[1] or None for r in rows], pa.string()),
                    "file": pa.array([r[2] for r in rows]),
                    "offset": pa.array([int(r[3]) for r in rows], pa.int64()),
                    "length": pa.array([int(r[4]) for r in rows], pa.int64()),
                }
            )


def read_records(archive: Archive, captures: DataFrame) -> DataFrame:
    """The records at the given byte ranges. An archive file is loaded once for all its ranges."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string())]
        kinds += [("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        schema = pa.schema([*kinds, ("payload", pa.binary())])
        for batch in batches:
            for content, ranges in zip(batch.column(0), texts(batch, "ranges"), strict=True):
                whole = content.as_py()
                for start in range(0, len(ranges), 64):
                    found = [
                        parse(zlib.decompress(whole[r["offset"] : r["offset"] + r["length"]], GZIP))
                        for r in ranges[start : start + 64]
                    ]
                    yield pa.RecordBatch.from_pylist(found, schema)

    # The number of ranges of a file is bounded by the records the writer puts in it.
    wanted = captures.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))
    files = _archive_files(archive).join(wanted, F.col("path") == F.col("file"))
    return files.select("content", "ranges").mapInArrow(cut, RECORDS)


def read_urls(archive: Archive, urls: DataFrame, url: str = "url") -> DataFrame:
    """Every record of the given urls, found through the index."""
    return read_records(archive, search(archive, urls, url))


def lookup(archive: Archive, url: str) -> list[dict[str, object]]:
    """The records of one url: directory, blocks, then a byte range of the archive file each."""
    spark, key = archive.spark, url_key(url)
    blocks = archive.captures.where((F.col("first") <= key) & (F.col("last") >= key)).select("lines")
    found = []
    for row in blocks.toLocalIterator():
        for _, _, file, offset, length in matching(row["lines"], [key]):
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
            try:
                stream.seek(int(offset))
                content = bytes(stream.readNBytes(int(length)))
            finally:
                stream.close()
            found.append(parse(zlib.decompress(content, GZIP)))
    return found
