"""WARC archives: writing, the monolithic-gzip normaliser, and indexed reading.

1. ``write_monolithic`` writes a record per page; each output file is *one* gzip
   stream over all its records (what a plain gzip of an archive looks like).
2. ``normalise`` inflates each such file once, as a stream, and writes every
   record as a gzip member of its own, together with a sidecar index (archive,
   offset, length, ...), so that a record can be read without what stands before
   it.  It takes files with any number of members.
3. ``read_records`` seeks each record by the index and parses it.

Records of equal payloads of at least ``LEAST`` bytes: that with the smallest
page id is a response, the others are revisits that refer to it.  Rows that repeat
the response's id are responses as well; rows without an id are revisits where
the payload has a row with an id, responses where not.  A null html is an empty
payload; control characters and spaces of a url are escaped, a null url becomes a
``urn:page:`` one; an empty table gives empty archives and an empty result; other
columns are ignored.

Archives are written in chunks of whole members.  Spark's text writer ends each
chunk with a separator that cannot be empty, so it is an empty gzip member, as
other block-wise gzip formats use for an end mark.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel.llm.common import slices, texts

LEAST = 100
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = bytes.fromhex("1f8b08000000000000ff0300" + "00" * 8)      # an empty gzip member
LINES = b"\r\n\r\n"         # what stands after each record
CHUNK = 4 << 20
UNSAFE = re.compile("[\x00-\x20\x7f]")
ROW_BYTES = 1 << 20         # records that the writer gets as one row
ROWS_PER_FILE = 128         # an archive closes after 128 MB of records (or as many longer ones)
RECORDS_AT_ONCE = 4096


def packed_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, packed): payloads compressed
    before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in slices(batches, "html", 4 << 20):
            payloads = [t.encode("utf-8") for t in texts(b, "html")]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(map(len, payloads), pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                 pa.array(map(z.compress, payloads), pa.binary())], names=["page_id", "url", "payload_bytes", "payload_digest", "packed"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, packed binary")


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """``packed_pages`` with record_type and refers_to; revisits lose their payload."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    first = (pages.filter(F.octet_length(payload) >= least)
             .groupBy(F.sha2(payload.cast("binary"), 256).alias("d")).agg(F.min(F.col(id_col).cast("long")).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 and first is not null").select("d", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return packed_pages(pages, id_col, url_col, html_col).join(first, F.col("payload_digest") == F.col("d"), "left").select(
        "page_id", "url", "payload_bytes", "payload_digest", F.when(~revisit, F.col("packed")).alias("packed"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))


def record(page: dict, date: str) -> bytes:
    """A record without the two line ends after it."""
    own = f"urn:page:{page['payload_digest'] if page['page_id'] is None else page['page_id']}"
    revisit = page["record_type"] == "revisit"
    payload = b"" if revisit else zstandard.ZstdDecompressor().decompress(page["packed"])
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['payload_bytes']}\r\n\r\n".encode() + payload
    lines = ["WARC/1.1", f"WARC-Type: {page['record_type']}", f"WARC-Record-ID: <{own}>", f"WARC-Date: {date}",
             f"WARC-Target-URI: {own if page['url'] is None else UNSAFE.sub('%20', page['url'])}", f"WARC-Payload-Digest: sha256:{page['payload_digest']}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{page['refers_to']}>"]
    if page["page_id"] is not None:
        lines.append(f"X-Page-ID: {page['page_id']}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def write_monolithic(pages: DataFrame, path: str, date: str = DATE, rows_per_file: int = ROWS_PER_FILE, row_bytes: int = ROW_BYTES, **columns) -> None:
    """A record per row of ``pages``; each file below ``path`` is one gzip stream.
    The writer counts rows, so records are joined to rows of about ``row_bytes`` and a
    file closes by the bytes it holds, however many records these are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, 64):
                for page in b.slice(at, 64).to_pylist():
                    held.append(record(page, date))
                    size += len(held[-1])
                    if size >= row_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([LINES.join(held)], pa.binary())], names=["value"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([LINES.join(held)], pa.binary())], names=["value"])

    classify(pages, **columns).mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.mode("overwrite").options(
        compression="gzip", lineSep=LINES.decode(), maxRecordsPerFile=rows_per_file).text(path)


def inflate(data: bytes | pa.Buffer, step: int = 1 << 16) -> Iterator[bytes]:
    """The content of a gzip file of one or many members, in pieces."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, used = zlib.decompressobj(31), at
        while not member.eof and used < len(view):
            take = view[used:used + step]
            yield member.decompress(take)
            used += len(take)
        if not member.eof:
            raise ValueError("gzip stream ends inside a member")
        at = used - len(member.unused_data)


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records (with the line ends after them) of an archive's content."""
    held = bytearray()

    def fill(n: int) -> bool:
        for p in pieces:
            held.extend(p)
            if len(held) >= n:
                return True
        return len(held) >= n
    while True:
        end = held.find(b"\r\n\r\n")
        while end < 0:
            at = max(len(held) - 3, 0)
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("archive ends inside a record's header")
                return
            end = held.find(b"\r\n\r\n", at)
        size = end + 4 + int(header(bytes(held[:end]))["content-length"]) + 4
        if len(held) < size and not fill(size):
            raise ValueError("archive ends inside a record")
        yield bytes(held[:size])
        del held[:size]


def header(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own (no time stamp: equal bytes each run)."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def parse(record: bytes) -> dict:
    """Page id, payload size and digest, type and reference of a record."""
    head, _, block = record.partition(b"\r\n\r\n")
    warc = header(head)
    http, _, payload = block[:int(warc["content-length"])].partition(b"\r\n\r\n")
    refers = warc.get("warc-refers-to")
    revisit = warc["warc-type"] == "revisit"
    return {
        "page_id": int(warc["x-page-id"]) if "x-page-id" in warc else None,
        "payload_bytes": int(header(http)["content-length"]) if revisit else len(payload),
        "payload_digest": warc["warc-payload-digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest(),
        "record_type": warc["warc-type"],
        "refers_to": int(refers.strip("<>").rpartition(":")[2]) if refers else None,
        "uri": warc["warc-target-uri"],
    }


def members(data: bytes | pa.Buffer) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each member of a normalised archive."""
    view, at = memoryview(data), 0
    while at < len(view):
        z, used, out = zlib.decompressobj(31), at, []
        while not z.eof:
            if used >= len(view):
                raise ValueError("gzip stream ends inside a member")
            out.append(z.decompress(view[used:used + (1 << 16)]))
            used = min(used + (1 << 16), len(view))
        end = used - len(z.unused_data)
        yield at, end - at, b"".join(out)
        at = end


INDEX = "archive string, offset long, length long, record_id string, record_type string, uri string, payload_digest string"


def _files(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter("length > 0").select(
        F.regexp_extract("path", name, 1).alias("archive"), "content")


def normalise(spark: SparkSession, source: str, target: str, chunk: int = CHUNK, drop_source: bool = False) -> None:
    """Rewrite the archives below ``source`` as ``target``/archives (a member per
    record) with the index ``target``/index, which is read off the new files.
    ``drop_source`` removes the source when both are written."""
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                number, held, size = 0, [], 0
                for record_ in split_records(inflate(data.as_buffer())):
                    held.append(member(record_))
                    size += len(held[-1])
                    if size >= chunk:
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([number], pa.int32()), pa.array([b"".join(held)], pa.binary())], names=["archive", "chunk", "value"])
                        number, held, size = number + 1, [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([number], pa.int32()), pa.array([b"".join(held)], pa.binary())], names=["archive", "chunk", "value"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                rows = []
                for offset, length, content in members(data.as_buffer()):
                    if content:         # the empty member ends a chunk
                        h = header(content[:content.find(b"\r\n\r\n")])
                        rows.append((name, offset, length, h["warc-record-id"].strip("<>"), h["warc-type"], h["warc-target-uri"], h["warc-payload-digest"]))
                kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in INDEX.split(", ")])

    # a file is one task's, so its chunks are written in order without a shuffle
    (_files(spark, source, "([^/.]+)[^/]*$").mapInArrow(rewrite, "archive string, chunk int, value binary").sortWithinPartitions("archive", "chunk")
     .select(F.col("value").cast("string").alias("value"), "archive").write.mode("overwrite").partitionBy("archive")
     .options(encoding="ISO-8859-1", lineSep=END.decode("ISO-8859-1")).text(f"{target}/archives"))
    _files(spark, f"{target}/archives", "archive=([^/]+)").mapInArrow(index, INDEX).write.mode("overwrite").parquet(f"{target}/index")
    if drop_source:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_records(spark: SparkSession, target: str) -> DataFrame:
    """(archive, offset, page_id, payload_bytes, payload_digest, record_type,
    refers_to, uri) of every indexed record, each read at its own offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data, places in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                view = memoryview(data.as_buffer())
                for at in range(0, len(places), RECORDS_AT_ONCE):
                    out = [{"archive": name, "offset": p["offset"]} | parse(zlib.decompress(view[p["offset"]:p["offset"] + p["length"]], 31))
                           for p in places.values.slice(at, RECORDS_AT_ONCE).to_pylist()]
                    yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                        ("archive", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string())]))

    index = spark.read.schema(INDEX).parquet(f"{target}/index")
    places = index.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places"))
    return _files(spark, f"{target}/archives", "archive=([^/]+)").join(places, "archive").select("archive", "content", "places").mapInArrow(
        run, "archive string, offset long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string")
