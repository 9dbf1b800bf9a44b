"""WARC archives with an index written first, and reads of selected records by byte ranges.

Writing tasks append gzip members, one per record, to archive files of their own and return where
each record lies. The stored index is the commit: files that it does not name, left by failed
tasks, are never read. Reading sorts the selected records by place, joins neighbours to ranges and
reads every range at once.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casebook.llm.common import prepared, stored
from casebook.session import shared_dir

#: Payloads from this size on may become revisits.
LEAST_REVISIT = 1000
#: An archive file is closed after this size. A range is at most RANGE long, unless one record is
#: longer, and spans gaps up to GAP.
FILE_BYTES, RANGE, GAP = 256 << 20, 8 << 20, 64 << 10
#: Archive bytes that one task reads, about.
TASK_BYTES = 32 << 20
LEVEL = 2
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, offset long, length long, id long, url string, digest string, record_type string, refers_to long"


def record_id(id: int | None, digest: str) -> str:
    """The same name for the same page and payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{id}:{digest}')}>"


def field_value(text: str | None) -> str:
    """A URL as a header value: white space and control characters are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text or "")


def record(id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit without the payload, uncompressed."""
    named = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {field_value(url)}",
        f"WARC-Payload-Digest: sha1:{named}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if id is not None:
        head.append(f"Page-ID: {id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes | None, int, str]:
    """Header fields, payload (None for a revisit), payload bytes and SHA-1 of a record.

    The digest of a response is computed from its payload and must agree with the header; a
    revisit has that of its header.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "revisit":
        size = next(int(line[15:]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length:"))
        return fields, None, size, told
    digest = hashlib.sha1(payload).hexdigest()
    if digest != told:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return fields, payload, len(payload), digest


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path there. Any that pyarrow knows will do."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_archives(
    df: DataFrame, folder: str | None = None, id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISIT
) -> DataFrame:
    """Writes one record per row into archive files; returns the stored index.

    ``folder`` must be reachable from all tasks; it defaults to one below the shared checkpoint
    folder. Of rows with equal payloads of at least ``least`` bytes that with the largest id is the
    response and the others are revisits of it; rows that repeat that id are responses too, and so
    are rows without an id. Null payloads are empty; a null URL is an empty one. Other columns are
    not read. An empty table gives an empty index.

    Payloads are not shuffled: repeated digests are counted first, and their stored table, whose
    size Spark then knows, is broadcast if it is small and joined by a shuffle otherwise.
    """
    spark = prepared(df.sparkSession)
    folder = folder or shared_dir(spark, "warc")
    pages = df.select(
        F.col(id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload")
    ).withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    large = pages.filter(F.col("size") >= least).groupBy("digest", "size")
    repeats = stored(large.agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1 and last is not null").drop("n"), "repeated-payloads")
    known = pages.join(repeats, ["digest", "size"], "left")
    rows = known.select("id", "url", "payload", "digest", F.expr("case when id < last then last end").alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_fs(folder)
        system.create_dir(base, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                found = []
                for number, address, data, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or offset >= FILE_BYTES:
                        if out:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(record(number, address, data, digest, refers_to)) + packer.flush()
                    out.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    found.append((f"{folder}/{name}", offset, len(member), number, address, digest, kind, refers_to))
                    offset += len(member)
                yield _index_batch(found)
        finally:
            if out:
                out.close()

    return stored(rows.mapInArrow(write, INDEX), "warc-index")


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
    names = [part.split()[0] for part in INDEX.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def ranges(selected: DataFrame, size: int = RANGE, gap: int = GAP) -> DataFrame:
    """Sorted records of an index joined to ranges: file, start, end, and the records' places.

    A range holds neighbours with at most ``gap`` bytes between them that begin within the same
    ``size`` bytes of a file.
    """
    place = W.partitionBy("file").orderBy("offset")
    before = F.lag(F.struct("offset", (F.col("offset") + F.col("length")).alias("end"))).over(place)
    numbered = (
        selected.select("file", "offset", "length")
        .distinct()
        .withColumn("before", before)
        .withColumn(
            "begins",
            F.col("before").isNull()
            | (F.col("offset") - F.col("before.end") > gap)
            | (F.floor(F.col("offset") / size) != F.floor(F.col("before.offset") / size)),
        )
        .withColumn("range", F.sum(F.col("begins").cast("long")).over(place))
    )
    return numbered.groupBy("file", "range").agg(
        F.min("offset").alias("start"),
        F.max(F.col("offset") + F.col("length")).alias("end"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"),
    )


def read_records(selected: DataFrame, payload: bool = True) -> DataFrame:
    """The records that index rows name: id, url, record_type, payload_bytes, payload_digest,
    refers_to and, unless ``payload`` is false, the payload (null for revisits).

    Sizes and digests are those of the full payload, computed from it for responses. Index rows
    that repeat a record yield it once; no rows yield none. A damaged record is an error.
    """
    prepared(selected.sparkSession)
    schema = "id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    schema += ", payload binary" * payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start, end, places in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                system, path = open_fs(file)
                with system.open_input_file(path) as source:
                    data = memoryview(source.read_at(end - start, start))
                found = []
                for place in places:
                    at = place["offset"] - start
                    fields, body, size, digest = parse(zlib.decompress(data[at : at + place["length"]], 31))
                    number, other = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                    row = (number and int(number), fields["WARC-Target-URI"], fields["WARC-Type"], size, digest, other and int(other))
                    found.append((*row, body) if payload else row)
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                names = [part.split()[0] for part in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds)], names=names)

    # The index is small and its archives are not, so their size sets the number of tasks.
    size = selected.agg(F.sum("length")).first()[0] or 0
    dealt = ranges(selected).repartition(max(1, -(-size // TASK_BYTES)), "file", "range")
    return dealt.select("file", "start", "end", "records").mapInArrow(read, schema)
