"""WARC archives: written as whole-file gzip streams, normalised to a member per record.

``write_archives`` writes each partition as one gzip stream of WARC records, through Spark's
own text writer. ``normalise`` inflates each such file once, as a stream, writes every record
again as a gzip member of its own, and puts a sidecar of member offsets next to the file, so
that ``read_records`` can fetch single records. A task holds one record at a time.

Archives and sidecars are written under the folder given, by the task that read the source,
first under a name of its own attempt and then moved, so attempts don't write one file and
a task that runs again replaces what it wrote.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CRLF = "\r\n"
REVISIT_BYTES = 1000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20


# ---- writing ----

def typed_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to`` of each row.

    Of rows with one payload of at least ``REVISIT_BYTES`` bytes the largest identifier is the
    response (all of them, if its row repeats) and the others revisit it; a missing identifier
    is smaller than any other.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.sha1(payload.cast("binary")).alias("digest"))
    long = F.octet_length("payload") >= REVISIT_BYTES
    # Digests held twice or more, pre-aggregated before the exchange.
    shared = (rows.where(long).groupBy(F.col("digest").alias("d"))
              .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 and last is not null"))
    # Short payloads match nothing: they are dealt out, not gathered by the few digests they have.
    dealt = F.when(long, F.col("digest")).otherwise(F.concat(F.lit("short "), F.monotonically_increasing_id().cast("string")))
    rows = rows.withColumn("deal", dealt)
    joined = rows.join(shared, F.col("deal") == F.col("d"), "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("last")).alias("refers_to"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit(CRLF))


def record_text(rows: DataFrame) -> DataFrame:
    """One WARC record per row, without the blank lines that end it."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(CRLF + CRLF))
    is_revisit = F.col("record_type") == "revisit"
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    key = F.md5(F.concat_ws("\x00", F.col("page_id").cast("string"), F.col("url"), F.col("digest")).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(key, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    # A line break can't stand in a header.
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    return rows.select(F.concat(
        F.lit("WARC/1.1" + CRLF),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))),
        _header("WARC-Date", F.lit(DATE)),
        F.coalesce(_header("WARC-Target-URI", url), F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.coalesce(_header("X-Page-Id", F.col("page_id").cast("string")), F.lit("")),
        F.when(is_revisit, F.concat(_header("WARC-Profile", F.lit(PROFILE)),
                                    _header("X-Refers-To-Page-Id", F.col("refers_to").cast("string")))).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block).alias("value"))


def write_archives(pages: DataFrame, folder: str, **columns: str) -> None:
    """``pages`` as WARC files under ``folder``, each a single gzip stream."""
    record_text(typed_records(pages, **columns)).write.option("compression", "gzip").option(
        "lineSep", CRLF + CRLF).text(folder)


# ---- normalising ----

def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip file of one or more members."""
    unzip = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            out = unzip.decompress(chunk, READ_BYTES)
            if out:
                yield out
            chunk = unzip.unconsumed_tail
            if unzip.eof:
                chunk = unzip.unused_data
                unzip = zlib.decompressobj(31)
    tail = unzip.flush()
    if tail:
        yield tail


def records(content: Iterator[bytes]) -> Iterator[tuple[bytes, dict[str, str], int]]:
    """Each record's bytes, its headers and where its block begins."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            more = next(content, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        looked = 0
        while (at := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                if held.strip(b"\r\n"):
                    raise ValueError("a WARC file ends inside a record's header")
                return
        headers = _headers(bytes(held[:at]))
        size = at + 4 + int(headers["content-length"])
        if not fill(size):
            raise ValueError("a WARC file ends inside a record's block")
        yield bytes(held[:size]) + b"\r\n\r\n", headers, at + 4
        fill(size + 4)
        del held[:size + 4]


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split(CRLF)
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _normaliser(folder: str):
    def rewrite(uri: str) -> int:
        source, path = _open(uri)
        target, base = _open(folder)
        name = path.rsplit("/", 1)[-1].split(".")[0]
        final = f"{base}/{name}.warc.gz"
        attempt = TaskContext.get().taskAttemptId()
        part = f"{base}/.{name}.{hashlib.sha1(uri.encode()).hexdigest()[:8]}.{attempt}.tmp"
        offset = count = 0
        with source.open_input_stream(path, compression=None) as raw, \
                target.open_output_stream(part, compression=None) as out, \
                target.open_output_stream(part + ".idx", compression=None) as idx:
            for record, headers, _ in records(inflate(iter(lambda: raw.read(READ_BYTES), b""))):
                member = gzip.compress(record, mtime=0)
                out.write(member)
                line = (offset, len(member), headers["warc-type"], headers.get("x-page-id", ""),
                        headers.get("warc-payload-digest", ""))
                idx.write(("\t".join(map(str, line)) + "\n").encode())
                offset += len(member)
                count += 1
        target.move(part, final)
        target.move(part + ".idx", final + ".idx")
        return count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([rewrite(p) for p in paths], pa.int64())],
                                             names=["path", "records"])
    return run


def _qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of the session's file system where it names none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def normalise(spark: SparkSession, source: str, folder: str) -> int:
    """Rewrite every archive of ``source`` into ``folder`` with its sidecar; the number of records."""
    folder = _qualified(spark, folder)
    target, base = _open(folder)
    target.create_dir(base, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(source).select("path")
    n = files.count()
    done = files.repartition(max(1, n)).mapInArrow(_normaliser(folder), "path string, records long")
    return done.agg(F.sum("records")).first()[0] or 0


# ---- reading back ----

_INDEX = "offset long, length long, record_type string, page_id string, digest string"
_READ = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
                      T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
                      T.StructField("payload", T.StringType())])


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``file, offset, length, record_type, page_id, digest`` of every record, from the sidecars."""
    lines = (spark.read.schema(_INDEX).option("sep", "\t").option("pathGlobFilter", "*.warc.gz.idx").csv(folder))
    return lines.select(F.regexp_replace(F.input_file_name(), r"\.idx$", "").alias("file"), "*")


def _reader(with_payload: bool):
    def number(value: str | None) -> int | None:
        return int(value) if value else None

    def parse(member: bytes) -> dict:
        record, headers, block = next(records(iter([gzip.decompress(member)])))
        content = record[block:-4]
        head, _, payload = content.partition(b"\r\n\r\n")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        length = next(int(v) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if k.lower() == b"content-length")
        if headers["warc-type"] == "response":
            if hashlib.sha1(payload).hexdigest() != digest or len(payload) != length:
                raise ValueError(f"record {headers.get('warc-record-id')} doesn't match its digest")
        return {"page_id": number(headers.get("x-page-id")), "url": headers.get("warc-target-uri"),
                "payload_bytes": length, "payload_digest": digest, "record_type": headers["warc-type"],
                "refers_to": number(headers.get("x-refers-to-page-id")),
                "payload": payload.decode() if with_payload and headers["warc-type"] == "response" else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload", pa.string())])
        name, opened = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["file"] != name:
                    fs, path = _open(r["file"])
                    name, opened = r["file"], fs.open_input_file(path)
                rows.append(parse(opened.read_at(r["length"], r["offset"])))
            yield pa.RecordBatch.from_pylist(rows, schema=fields)
    return run


def read_records(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records that ``index`` (or a part of it) names, each fetched by its own offset."""
    wanted = (index.select("file", "offset", "length")
              .sortWithinPartitions("file", "offset"))
    return wanted.mapInArrow(_reader(with_payload), _READ)


def warc_round_trip(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """Write ``pages`` under ``folder``, normalise, read back: a row per page.

    A null payload is empty and always a response; a null url or identifier has no header and
    is read back as null; control characters and spaces in a url are written as ``%20``.
    Repeated rows are separate records with one record identifier. Other columns are ignored.
    An empty table gives no record. Identifiers are whole numbers; others are an error.
    """
    spark = pages.sparkSession
    if not isinstance(pages.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{id_col} is {pages.schema[id_col].dataType.simpleString()}, not a whole number")
    write_archives(pages, f"{folder}/streams", id_col=id_col, url_col=url_col, html_col=html_col)
    normalise(spark, f"{folder}/streams", f"{folder}/records")
    return read_records(read_index(spark, f"{folder}/records"))
