"""A deterministic, sharded writer of WARC archives, and their reader.

Records are put into ranges of equal size by page id, sorted, and written as one gzip member
each; a file is closed once its compressed size passes a limit. Headers, record ids
and digests are made anew from the payload. Files are written under temporary names and
renamed, and a manifest that names all of them is renamed last: without it there is no archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import SLICE_BYTES, slices, uri
from wardline.session import written

ROLL_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
RANGES = 16_384
DATE = "2000-01-01T00:00:00Z"  # archives of the same pages are equal, byte by byte
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def bare_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def revisits(pages: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """page_id, sha (hexadecimal) and refers_to of the pages that are not the response.

    Of records with equal payloads of at least ``least_bytes``, the one with the largest page_id
    is the response and the others revisit it. Only small columns are shuffled; a payload that a
    third of all pages share is reduced to one row a task before that, and its pages are spread
    again by the join's split of skewed parts.
    """
    facts = pages.select("page_id", size_of("html"), F.sha1(
        F.coalesce("html", F.lit("")).cast("binary")).alias("sha"))
    facts = facts.filter(F.col("payload_bytes") >= least_bytes)
    firsts = (facts.groupBy("sha", "payload_bytes")
              .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") > 1).drop("_n"))
    return (facts.join(firsts, ["sha", "payload_bytes"])
            .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "sha", "refers_to").distinct())


def size_of(html: str) -> Column:
    return F.coalesce(F.octet_length(html), F.lit(0)).cast("bigint").alias("payload_bytes")


def record(page_id, url, payload: bytes, refers_to, copy: int) -> bytes:
    """One WARC record; a revisit has the response's headers and no payload."""
    url = quote(url or "", safe=":/?#[]@!$&'()*+,;=%~-._")
    digest = bare_digest(payload)

    def name(page) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page}')}>"

    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind, extra = ("response", []) if refers_to is None else ("revisit", [
        ("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to)),
        ("X-Refers-To-Page", refers_to)])
    if refers_to is None:
        block += payload
    headers = [("WARC-Type", kind), ("WARC-Record-ID", name(page_id) if not copy else name(f"{page_id}/{copy}")),
               ("WARC-Date", DATE), ("WARC-Target-URI", url),
               ("X-Page-Id", "" if page_id is None else page_id), *extra,
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{bare_digest(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return gzip.compress(head.encode("utf-8") + block + b"\r\n\r\n", 6, mtime=0)


class ShardWriter:
    """Writes the files of one shard; a file that is repeated by another attempt is equal."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        self.files, self.path = pyarrow.fs.FileSystem.from_uri(uri(folder))
        self.shard, self.roll_bytes, self.number, self.out = shard, roll_bytes, 0, None
        self.files.create_dir(self.path, recursive=True)

    def write(self, data: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/_{self.name}.{uuid.uuid4().hex}"
            self.out, self.size, self.records = self.files.open_output_stream(self.temporary), 0, 0
            self.sha = hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.size, self.records = self.size + len(data), self.records + 1
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.files.move(self.temporary, f"{self.path}/{self.name}")
            yield self.name, self.records, self.size, self.sha.hexdigest()
            self.out, self.number = None, self.number + 1


def shard_of(pages: DataFrame, shard_bytes: int):
    """A function that adds ``shard`` to rows with a page_id: ranges of ids of equal payload.

    Payload is summed over ``RANGES`` equal ranges of ids at most, and ranges are cut where the
    running sum passes a multiple of ``shard_bytes``: the shards follow from the pages alone,
    and the broadcast table has ``RANGES`` rows at most.
    """
    low, high = pages.agg(F.min("page_id"), F.max("page_id")).first()
    low, high = low or 0, high or 0
    width = (high - low) // RANGES + 1
    piece = F.floor((F.coalesce("page_id", F.lit(low)) - F.lit(low)) / F.lit(width)).cast("int")
    sums = pages.select(piece.alias("_range"), size_of("html")).groupBy("_range").agg(
        F.sum(F.col("payload_bytes") + 512).alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")
    shards = written(sums.select("_range", F.floor(before / F.lit(shard_bytes)).cast("int")
                                 .alias("shard")), "warc-shards")
    return lambda df: df.withColumn("_range", piece).join(F.broadcast(shards), "_range").drop(
        "_range")


def write_archives(pages: DataFrame, folder: str, *, least_bytes: int = 0,
                   roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> int:
    """Write all ``pages`` (page_id, url, html) to ``folder``; returns the number of records.

    A null html is an empty payload, a null url an empty target, and a page without an id is
    written without one, before all others. Repeated rows are records of their own, in a fixed
    order; of rows with the id and the payload of a response one is the response, the others revisit it (without
    an id there is nothing to refer to, and all are responses). Other columns play no part. Empty tables give a manifest without files.

    The payload is shuffled once: what a page revisits travels as a row of its own that is
    sorted before its page. A task holds one batch of pages, of a bounded size or one page.
    """
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("bigint"), "url", "html")
    add_shard = shard_of(pages, shard_bytes)
    directions = revisits(pages, least_bytes=least_bytes).select(
        "page_id", F.lit(0).alias("is_page"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"), "sha", "refers_to")
    rows = pages.select("page_id", F.lit(1).alias("is_page"), "url", "html",
                        F.lit(None).cast("string").alias("sha"),
                        F.lit(None).cast("bigint").alias("refers_to"))
    names = ["shard", "page_id", "is_page", "url", "html", "sha", "refers_to"]
    tasks = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    ready = (add_shard(directions.unionByName(rows)).select(*names)
             .repartitionByRange(tasks, "shard")
             .sortWithinPartitions("shard", "page_id", "is_page", "html", "url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, last, copy, known, done, before = None, None, 0, {}, [], None
        for batch in slices(batches, "html", 8 * SLICE_BYTES):
            for row in batch.to_pylist():
                if writer is None or writer.shard != row["shard"]:
                    done += writer.close() if writer else ()
                    writer, last = ShardWriter(folder, row["shard"], roll_bytes), ()
                if last != row["page_id"]:
                    last, copy, known, before = row["page_id"], 0, {}, None
                if not row["is_page"]:
                    known[row["sha"]] = row["refers_to"]
                    continue
                payload = (row["html"] or "").encode("utf-8")
                first = known.get(hashlib.sha1(payload).hexdigest()) if known else None
                if first is None and payload == before and len(payload) >= least_bytes:
                    first = row["page_id"]  # rows that repeat a response revisit it
                before = payload
                done += writer.write(record(row["page_id"], row["url"], payload, first, copy))
                copy += 1
            if done:
                yield listing(done)
                done = []
        done += writer.close() if writer else ()
        if done:
            yield listing(done)

    def listing(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)],
                                          names=["file", "records", "bytes", "sha256"])

    return commit(ready.mapInArrow(
        write, "file string, records long, bytes long, sha256 string"), folder)


def commit(listed: DataFrame, folder: str) -> int:
    """Write the manifest (a line for each file, by name) and rename it into its place."""
    files, path = pyarrow.fs.FileSystem.from_uri(uri(folder))
    files.create_dir(path, recursive=True)
    temporary, records = f"{path}/_manifest.{uuid.uuid4().hex}", 0
    with files.open_output_stream(temporary) as out:
        for row in written(listed, "warc-manifest").orderBy("file").toLocalIterator():
            out.write((json.dumps(row.asDict()) + "\n").encode("utf-8"))
            records += row["records"]
    files.move(temporary, f"{path}/manifest.jsonl")
    return records


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one at a time."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should start")
        headers = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name] = value.strip()
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        yield headers, block


def facts(headers: dict[str, str], block: bytes) -> tuple:
    """One result row; the digests of what is stored are computed again and must agree."""
    if headers["WARC-Block-Digest"] != f"sha1:{bare_digest(block)}":
        raise ValueError(f"{headers['WARC-Record-ID']}: the block was changed")
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(head.rsplit(b"Content-Length: ", 1)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (len(payload) != size or bare_digest(payload) != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload was changed")
    page, first = headers["X-Page-Id"], headers.get("X-Refers-To-Page")
    return (int(page) if page else None, size, digest, headers["WARC-Type"],
            int(first) if first else None)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record.

    Reads the files that the manifest names, a record at a time.
    """
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64())])
    result = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    listed = spark.read.schema("file string").json(f"{folder}/manifest.jsonl")
    count = listed.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pyarrow.fs.FileSystem.from_uri(uri(folder))
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with files.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20)
                    rows = [facts(*r) for r in parse(stream)]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return listed.repartition(max(1, count), "file").mapInArrow(read, result)
