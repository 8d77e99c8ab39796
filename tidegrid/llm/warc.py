"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own. A reading task gets a byte range: it looks for the gzip magic in it, checks each
candidate by decoding the member's header and its whole block, and owns the records whose first byte lies in its
range; the last one may end beyond it. From one record on, the next begins where the member ends. A member that was found by search counts only if
records go on behind it without a break, to the end of the file or for CONFIRM_BYTES, so that the members of a smaller archive that is stored in a payload don't pass for records.
"""

from __future__ import annotations

import posixpath
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import prepare, shared_dir, table, written

LEAST_BYTES, SPLIT_BYTES, READ_BYTES = 1000, 8 << 20, 1 << 16
CONFIRM_BYTES = 1 << 20
#: Tasks of a read at most; beyond that many ranges a task reads several.
MOST_TASKS = 50_000
MAGIC = b"\x1f\x8b\x08"
FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, payload binary, path string, record_offset long"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path that driver and executors share: a local mount, or any scheme that Arrow opens."""
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


def _record(page_id: int | None, uri: str | None, kind: str, digest: str, size: int, refers_to: int | None, payload: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    lines += [f"WARC-Record-ID: <urn:page:{page_id}>"] * (page_id is not None)
    lines += [f"WARC-Target-URI: {''.join((uri or '').split())}"] * bool(uri)
    lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] * (kind == "revisit")
    body = b"" if kind == "revisit" else payload
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_BYTES) -> DataFrame:
    """Writes a record for each row of pages(page_id, url, html) below folder; returns (path, bytes, records), a row for each file.

    Of rows with equal payloads of ``least`` bytes or more, those with the largest page_id are responses, the others revisits of
    it. A null html is an empty payload. A null page_id is written without an id and, unless its group has no other, is a revisit.
    Payload digests meet after a map-side maximum, and the payload is joined to one row for each digest. A task
    writes under a name of its attempt and then renames, so a repeated task leaves one file.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    groups = rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
    groups = written(groups.where("n > 1").select(F.col("digest").alias("_digest"), "owner"))
    large = rows.where(F.col("size") >= least).join(groups, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    small = rows.where(F.col("size") < least).withColumn("owner", F.lit(None).cast("long"))
    fs, base = filesystem(folder)
    fs.create_dir(base)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, base = filesystem(folder)
        name = posixpath.join(base, f"part-{task.partitionId():06d}.warc.gz")
        mine, out, n, size = f"{name}.{task.taskAttemptId()}.tmp", None, 0, 0
        for x in batches:
            for page_id, url, payload, digest, length, owner in zip(*(c.to_pylist() for c in x.columns), strict=True):
                out = out or fs.open_output_stream(mine)
                revisit = owner is not None and owner != page_id
                data = _record(page_id, url, "revisit" if revisit else "response", digest, length, owner if revisit else None, payload)
                out.write(data)
                n, size = n + 1, size + len(data)
        if out:
            out.close()
            fs.move(mine, name)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])

    columns = ["page_id", "url", "payload", "digest", "size", "owner"]
    return written(large.select(columns).unionByName(small.select(columns)).mapInArrow(write, "path string, bytes long, records long"))


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}


class _Range:
    """Bytes of a file from any position on, through one buffer."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size, self.first, self.held = file, size, 0, b""

    def at(self, offset: int) -> bytes:
        """The bytes held from offset on; at least the magic's length, unless the file ends."""
        end = self.first + len(self.held)
        if not self.first <= offset <= end - len(MAGIC) and not (offset >= self.first and end == self.size and self.held):
            self.first, self.held = offset, self.file.read_at(max(0, min(READ_BYTES, self.size - offset)), offset)
        return self.held[offset - self.first :]


def _member(source: _Range, offset: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header fields, block and end of the record in the gzip member at offset; None if there is no such member."""
    unpack, data, k = zlib.decompressobj(31), bytearray(), offset
    while not unpack.eof:
        raw = source.at(k)
        if not raw:
            return None
        k += len(raw)
        try:
            data += unpack.decompress(raw)
        except zlib.error:
            return None
        if not data.startswith(b"WARC/1."[: len(data)]):
            return None
    k -= len(unpack.unused_data)
    head, _, rest = bytes(data).partition(b"\r\n\r\n")
    fields = _fields(head)
    if not fields.get("content-length", "").isdigit() or len(rest) != int(fields["content-length"]) + 4:
        return None
    return fields, rest[:-4], k


def _goes_on(source: _Range, offset: int) -> bool:
    """Whether members follow each other from offset on, to the end of the file or for CONFIRM_BYTES."""
    k = offset
    while k < source.size and k < offset + CONFIRM_BYTES:
        found = _member(source, k)
        if not found:
            return False
        k = found[2]
    return True


def records(file: pa.NativeFile, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of the records that begin in [start, end)."""
    source, k, sure = _Range(file, size), start, start == 0
    while k < end:
        found = _member(source, k)
        if found and (sure or _goes_on(_Range(file, size), found[2])):
            yield k, found[0], found[1]
            k, sure = found[2], True
            continue
        sure = False
        while True:  # to the next magic after k
            k += 1
            if k >= end:
                break
            window = source.at(k)
            at = window.find(MAGIC)
            if at >= 0 or len(window) < len(MAGIC):
                k = k + at if at >= 0 else size
                break
            k += len(window) - len(MAGIC)


def _page(urn: str | None) -> int | None:
    """The number in a record id of ours; null for ids of other writers."""
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if urn and urn.startswith("<urn:page:") and number.lstrip("-").isdigit() else None


def read_archives(spark: SparkSession, folder: str, split: int = SPLIT_BYTES) -> DataFrame:
    """A row (FIELDS) for each record of the .warc.gz files in folder; payload is null for revisits. Ranges of ``split`` bytes are read by different tasks.

    A task holds one record at a time, and a few million bytes of those it has read. Ids of other writers become null page ids.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", F.col("length").alias("size"))  # Spark lists; no content is read
    ranges = files.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / split))).alias("n"))
    tasks = ranges.select("path", "size", (F.col("n") * split).alias("start"), F.least(F.col("size"), (F.col("n") + 1) * split).alias("end"))
    tasks = tasks.repartition(MOST_TASKS, "path", "start") if tasks.count() > MOST_TASKS else tasks.repartition(max(1, tasks.count()))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[f.split()[0] for f in FIELDS.split(", ")])

        rows, held = [], 0
        for x in batches:
            for path, size, start, end in zip(*(c.to_pylist() for c in x.columns), strict=True):
                fs, at_path = filesystem(path)
                with fs.open_input_file(at_path) as file:
                    for at, f, block in records(file, size, start, end):
                        kind = f.get("warc-type", "")
                        rows.append((_page(f.get("warc-record-id")), int(f.get("x-payload-length", len(block))), f.get("warc-payload-digest", "").removeprefix("sha1:"), kind, _page(f.get("warc-refers-to")), f.get("warc-target-uri"), None if kind == "revisit" else block, path, at))
                        held += len(block)
                        if held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)

    return tasks.mapInArrow(read, FIELDS)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = LEAST_BYTES, split: int = SPLIT_BYTES) -> DataFrame:
    """pages written as archives to the shared folder and read back (FIELDS). Repeated rows stay repeated; an empty table gives no rows."""
    folder = shared_dir(spark)
    write_archives(pages, folder, least)
    return read_archives(spark, folder, split)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = round_trip(spark, table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d, max(page_id) OVER (PARTITION BY sha1(b)) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM q
"""
