"""WARC archives of pages, and a two-level index of their captures.

Archives are written by Spark's text writer: a record is text, its last line end is the
writer's separator, and files are in the shared folder. The index sorts captures by URL with
the host reversed, in compressed blocks; a sparse directory holds the first key of each. A
look-up finds the index partition by its first key, the block by binary search in the
directory, and the captures by binary search in the block; the records are then read at
their offsets.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import folders

LEAST_REVISIT = 1000        # bytes from which an equal payload is a revisit
RECORDS_PER_FILE = 2000
LINES = 1000                # captures of a block
CAPTURES_PER_PART = 100_000
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
END = "\r\n"
HTTP = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}{END}"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def surt(url: Column) -> Column:
    """The URL with its host reversed, as a sort key; ``-`` for null."""
    host = F.regexp_replace(F.regexp_extract(
        F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), r":[0-9]*$", "")
    rest = F.regexp_extract(url, r"^[^:]+://[^/?#]*([^#]*)", 1)
    key = F.when(host == "", url).otherwise(F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))
    return F.coalesce(F.regexp_replace(key, r"\s", "%20"), F.lit("-"))


def records(pages: DataFrame) -> DataFrame:
    """Pages with digest, type and the page they refer to; null html is an empty payload.

    Only digests are shuffled to find equal payloads.
    """
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).alias("html")).withColumns({
            "digest": F.sha1(F.col("html").cast("binary")),
            "size": F.octet_length("html").cast("bigint")})
    several = folders.small_enough(folders.written(
        pages.where(F.col("size") >= LEAST_REVISIT).groupBy("digest", "size").agg(
            F.max("page_id").alias("first"), F.count("*").alias("k")).where("k > 1").drop("k"),
        "equal-payloads"))
    return pages.join(several, ["digest", "size"], "left").withColumn(
        "refers_to", F.when(F.col("first") > F.col("page_id"), F.col("first"))).drop("first")


def write_archives(pages: DataFrame) -> str:
    """Write a record for each page; returns the folder of the archives."""
    told = records(pages)
    revisit = F.col("refers_to").isNotNull()

    def line(name, value, present=None):
        text = F.concat(F.lit(f"{name}: "), value, F.lit(END))
        return text if present is None else F.when(present, text).otherwise("")

    block = F.when(revisit, "").otherwise(F.concat(F.lit(HTTP), F.col("html")))
    uri = F.regexp_replace("url", r"\s", "%20")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    value = F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(urn("page_id"), F.lit("<urn:page:>"))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", uri, F.col("url").isNotNull()),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Payload-Length", F.col("size").cast("string")),
        line("WARC-Refers-To", urn("refers_to"), revisit),
        line("WARC-Profile", F.lit(PROFILE), revisit),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END), block, F.lit(f"{END}\r"))       # the writer adds the last \n
    folder = folders.new_folder(pages.sparkSession, "warc")
    told.select(value.alias("value")).write.option("lineSep", "\n").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(folder)
    return folder


def archives(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def headers(content: bytes, at: int) -> tuple[dict[str, str], int]:
    """Header fields of the record at an offset, and where its block begins."""
    end = content.find(b"\r\n\r\n", at)
    lines = content[at:end].decode("utf-8").split(END)
    if end < 0 or not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at byte {at}")
    return dict(field.split(": ", 1) for field in lines[1:]), end + 4


def _captures(batches):
    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                 strict=True):
            at, rows = 0, []
            while at < len(content):
                fields, begin = headers(content, at)
                end = begin + int(fields["Content-Length"]) + 4
                rows.append((fields.get("WARC-Target-URI"), at, end - at))
                at = end
            url, offset, length = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(url, pa.string()), pa.array([file] * len(rows), pa.string()),
                 pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                ["url", "file", "at", "size"])


def _blocks(batches):
    lines, block = [], 0
    part = TaskContext.get().partitionId()

    def row():
        blob = zlib.compress("\n".join(lines).encode())
        return pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([block]), pa.array([lines[0].split(" ", 1)[0]]),
             pa.array([blob], pa.binary())], ["part", "block", "first", "blob"])

    for batch in batches:
        for fields in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lines.append(" ".join(map(str, fields)))
            if len(lines) == LINES:
                yield row()
                lines, block = [], block + 1
    if lines:
        yield row()


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of captures: partition of the index, number, first key and compressed lines."""
    found = folders.written(archives(spark, folder).mapInArrow(
        _captures, "url string, file string, at bigint, size bigint").select(
        surt(F.col("url")).alias("key"), "file", "at", "size"), "captures")
    parts = folders.parts_for(found.count(), CAPTURES_PER_PART)
    return folders.written(
        found.repartitionByRange(parts, "key", "file", "at").sortWithinPartitions(
            "key", "file", "at").mapInArrow(
            _blocks, "part bigint, block bigint, first string, blob binary"), "capture-index")


def _search_part(keys: pa.Table, blocks: pa.Table) -> pa.Table:
    """Captures of keys in one partition of the index."""
    order = sorted(zip(blocks.column("first").to_pylist(), blocks.column("block").to_pylist(),
                       range(len(blocks)), strict=True))
    directory, blobs = [o[0] for o in order], blocks.column("blob")
    opened, rows = (-1, []), []
    for key in sorted(set(keys.column("key").to_pylist())):
        # Captures of one key may begin at the end of the block before.
        at = max(0, bisect.bisect_left(directory, key) - 1)
        while at < len(directory) and directory[at] <= key:
            if opened[0] != at:
                lines = zlib.decompress(blobs[order[at][2]].as_py()).decode().split("\n")
                opened = (at, [line.split(" ") for line in lines])
            lines = opened[1]
            i = bisect.bisect_left(lines, [key])
            while i < len(lines) and lines[i][0] == key:
                rows.append((key, lines[i][1], int(lines[i][2]), int(lines[i][3])))
                i += 1
            at += 1
    key, file, at, size = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({"key": pa.array(key, pa.string()), "file": pa.array(file, pa.string()),
                     "at": pa.array(at, pa.int64()), "size": pa.array(size, pa.int64())})


def look_up(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Captures (``key``, ``file``, ``at``, ``size``) of distinct keys."""
    bounds = index.groupBy("part").agg(F.min("first").alias("first")).orderBy("first").collect()
    firsts, parts = [b["first"] for b in bounds], [b["part"] for b in bounds]

    def route(batches):
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                low = max(0, bisect.bisect_left(firsts, key) - 1)
                rows += [(parts[i], key) for i in range(low, bisect.bisect_right(firsts, key))]
            part, key = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()),
                                              pa.array(key, pa.string())], ["part", "key"])

    return keys.select("key").mapInArrow(route, "part bigint, key string").groupBy(
        "part").cogroup(index.groupBy("part")).applyInArrow(
        _search_part, "key string, file string, at bigint, size bigint")


def _read_ranges(batches):
    for batch in batches:
        for content, ranges in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
            rows = []
            for r in ranges:
                record = content[r["at"]:r["at"] + r["size"]]
                fields, begin = headers(record, 0)
                block = record[begin:begin + int(fields["Content-Length"])]
                revisit = fields["WARC-Type"] == "revisit"
                payload = None if revisit else block[block.find(b"\r\n\r\n") + 4:]
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(fields["WARC-Payload-Length"])
                if not revisit and (len(payload) != size
                                    or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
                number = lambda v: int(v[10:-1]) if v and v != "<urn:page:>" else None
                rows.append((number(fields["WARC-Record-ID"]), size, digest,
                             fields["WARC-Type"], number(fields.get("WARC-Refers-To")),
                             payload))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()),
                    strict=True)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                 "payload"])


def read_captures(spark: SparkSession, folder: str, captures: DataFrame) -> DataFrame:
    """The records at the captures' offsets; payloads are checked against their digests."""
    ranges = folders.small_enough(folders.written(captures.groupBy("file").agg(
        F.collect_list(F.struct("at", "size")).alias("ranges")), "ranges"), 20_000)
    return archives(spark, folder).join(ranges, "file").select("content", "ranges").mapInArrow(
        _read_ranges, "page_id bigint, payload_bytes bigint, payload_digest string, "
                      "record_type string, refers_to bigint, payload binary")


def capture_index(pages: DataFrame) -> DataFrame:
    """Write all pages, index the archives, and read every page's URL back."""
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html")
    folder = write_archives(pages)
    index = build_index(spark, folder)
    keys = pages.select(surt(F.regexp_replace("url", r"\s", "%20")).alias("key")).distinct()
    return read_captures(spark, folder, look_up(index, keys)).drop("payload")
