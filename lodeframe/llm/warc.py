"""WARC archives: one record a page, Zstandard frames with a dictionary, revisit records for copies.

An archive is a `.warc.zst` file: a skippable frame that holds the dictionary (itself compressed),
then one independent frame a record. Its dictionary is built from a bounded sample of its own records,
so archives stand alone and a task needs memory for one archive's records only. Payload equality is
decided by SHA-1, SHA-256 and length together, before anything is written, by one aggregation.

Executors write archives under names that hold their task attempt, through a temporary name and a
rename; the names that successful attempts report are the list of archives. What a lost or second
attempt leaves in the folder is on no list and is never read. A folder that only Spark's file systems
reach takes the same archives as rows (name, content) of a Parquet table.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, written

SKIPPABLE = 0x184D2A5D  # the frame type that announces an embedded dictionary
MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 8 << 20
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 16 << 10
DATE = "2024-01-01T00:00:00Z"  # the pages carry no date
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORDS = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: str | None) -> str:
    """Percent-encoded, so that any text is one header line; a null identifier has a form of its own."""
    return "<urn:nopage>" if page_id is None else f"<urn:page:{quote(page_id, safe='')}>"


def _page(value: str | None) -> str | None:
    found = re.fullmatch(r"<urn:page:(.*)>", value or "")
    return unquote(found[1]) if found else None


def _uri(url: str | None) -> str:
    """One header line, whatever the url holds."""
    return "" if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def build_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = HTTP if revisit else HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {_uri(url)}", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def build_archive(records: list[bytes]) -> bytes:
    """The dictionary in a leading skippable frame, then a frame a record."""
    samples, room = [], SAMPLE_BYTES
    for r in records:
        samples.append(r[:64 << 10])
        room -= len(samples[-1])
        if room <= 0:
            break
    trained = None
    try:
        if len(samples) >= 8:
            size = max(256, min(DICTIONARY_BYTES, sum(map(len, samples)) // 8))
            trained = zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        trained = None
    content = trained or b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n"
    packed = zstandard.ZstdCompressor(level=19).compress(content)
    kind = {} if trained else {"dict_type": zstandard.DICT_TYPE_RAWCONTENT}
    writer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content, **kind), write_checksum=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(packed)), packed, *map(writer.compress, records)])


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records, by nothing but what the archive itself holds."""
    kind, size = struct.unpack_from("<II", data)
    if kind != SKIPPABLE:
        raise ValueError("no dictionary frame")
    content = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
    reader, rest = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content)), data[8 + size:]
    view = memoryview(rest)
    while view:
        one = reader.decompressobj()
        yield one.decompress(view)
        left = one.unused_data
        view = view[len(view) - len(left):] if left else view[:0]


def parse_record(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to); a response's digest is computed anew."""
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size, kind = int(fields["Content-Length"]), fields["WARC-Type"]
    block = body[:size]
    if len(body) != size + 4:
        raise ValueError("a record's length is wrong")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    length = int(fields["WARC-Payload-Length"])
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != length:
            raise ValueError("a payload differs from its digest")
    return _page(fields["WARC-Record-ID"]), length, digest, kind, _page(fields.get("WARC-Refers-To"))


def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """__page, __url, __html, __revisit, __refers: which page of equal payloads is archived in full.

    Only digests are shuffled for that; a payload that a third of the pages share is one row a task.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("__page"), F.col(url_col).cast("string").alias("__url"), html.alias("__html"))
    raw = F.col("__html").cast("binary")
    key = F.when(F.octet_length("__html") >= min_bytes,
                 F.struct(F.sha1(raw).alias("a"), F.sha2(raw, 256).alias("b"), F.octet_length("__html").alias("n")))
    keyed = written(rows.select("__page", key.alias("__key")).where(F.col("__key").isNotNull()), "payloads")
    groups = keyed.groupBy("__key").agg(F.max("__page").alias("__keep"), F.count(F.lit(1)).alias("__n")) \
        .where((F.col("__n") > 1) & F.col("__keep").isNotNull())
    copies = keyed.join(groups, "__key").where(~F.col("__page").eqNullSafe(F.col("__keep"))) \
        .select(F.col("__page").alias("__copy"), "__keep", F.struct("__key.b").alias("__sha")).distinct()
    joined = rows.join(copies, F.col("__page").eqNullSafe(F.col("__copy"))
                       & (F.sha2(raw, 256) == F.col("__sha.b")), "left")
    return joined.select("__page", "__url", "__html", F.col("__keep").alias("__refers"),
                         F.col("__sha").isNotNull().alias("__revisit"))


def _local(spark: SparkSession, path: str) -> str | None:
    """The folder, if `path` is on the file system of the machine; a path without a scheme is on Spark's default one."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
    return unquote(urlparse(whole).path) if whole.startswith("file:") else None


def write_archives(planned: DataFrame, path: str, archives: int | None = None) -> DataFrame:
    """Write the planned records under `path` in about ARCHIVE_BYTES of records each; return (name, content)."""
    spark, folder = planned.sparkSession, _local(planned.sparkSession, path)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, attempt, number, records, size = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, [], 0

        def close() -> pa.RecordBatch:
            name, data = f"pages-{part:06d}-{attempt}-{number:04d}.warc.zst", build_archive(records)
            if folder is not None:
                os.makedirs(folder, exist_ok=True)
                passing = f"{folder}/.{name}"
                with open(passing, "wb") as out:
                    out.write(data)
                os.replace(passing, f"{folder}/{name}")
                data = None
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], ["name", "content"])

        for batch in batches:
            for row in batch.to_pylist():
                payload = row["__html"] or b""
                records.append(build_record(row["__page"], row["__url"], payload, row["__refers"], row["__revisit"]))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    number, records, size = number + 1, [], 0
        if records:
            yield close()

    texts = planned.select(F.col("__page").cast("string").alias("__page"), F.make_valid_utf8("__url").alias("__url"), F.col("__html").cast("binary").alias("__html"),
                           F.col("__refers").cast("string").alias("__refers"), "__revisit")
    dealt = texts.repartition(archives, F.xxhash64("__page")) if archives else texts
    out = dealt.mapInArrow(packed, "name string, content binary")
    if folder is None:
        out.write.parquet(path)
        return spark.read.schema("name string, content binary").parquet(path)
    names = written(out.select("name"), "archives")
    return names.select("name", F.lit(None).cast("binary").alias("content"))


def read_archives(archives: DataFrame, path: str) -> DataFrame:
    """Every record of the named archives, read back and verified."""
    folder = _local(archives.sparkSession, path)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = row["content"]
                if data is None:
                    with open(f"{folder}/{row['name']}", "rb") as f:
                        data = f.read()
                columns = list(zip(*map(parse_record, read_archive(data))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return archives.mapInArrow(parsed, RECORDS)


def archive_pages(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES, archives: int | None = None) -> DataFrame:
    """Write every page to archives under `path` (default: a new folder of the shared one) and read them back.

    Returns one row per input row: id_col, payload_bytes, payload_digest, record_type, refers_to.

    Defined results: a null html is an empty payload; a null url is an empty target; control characters
    and spaces of a url are percent-encoded in its header. Among equal payloads a null identifier never
    is the response unless all are null; then all are responses. Rows that repeat both identifier and
    payload get the same kind of record. An empty table writes no archive and gives no rows. Other
    columns are ignored, whatever their names.
    """
    path = path or new_path(pages.sparkSession, "warc")
    planned = plan_records(pages, id_col, url_col, html_col, min_bytes)
    back = read_archives(write_archives(planned, path, archives), path)
    kind = pages.schema[id_col].dataType
    return back.select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))


def archive_table(spark: SparkSession, path: str) -> DataFrame:
    """The archives of a folder that an earlier session wrote, as (name, content)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
