"""WARC archives: written and read by Spark, and assembled into captures.

Each page becomes a transaction of three records: a response, or a revisit of an equal
payload, and a request and a metadata record that name it in WARC-Concurrent-To. Spark's
text sink writes them, one record a row, with the two line ends that close a WARC record
as its row separator, so any file system that Spark can write to will do.

Archives are read as whole files, decompressed and parsed as a stream by Content-Length,
one record in memory at a time. A capture is assembled by joining the records of each
kind on the identifier they share.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm.common import small_or_shuffled
from sheafline.session import stored

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
#: Bytes of one archive file before compression, as far as the mean payload tells, and its
#: records at most; three to a page. A file is read whole.
FILE_BYTES = 64 << 20
RECORDS_PER_FILE = 60_000
#: Bytes of the headers of a page's records.
HEADER_BYTES = 1500
#: Bytes of payload that a batch of parsed records may gather.
BATCH_BYTES = 4 << 20
CAPTURED = "2024-01-01T00:00:00Z"
END = "\r\n"
_RECORD_TYPES = ("response", "revisit", "request", "metadata")
_SCHEMA = ("record_id string, record_type string, concurrent_to string, refers_to string, "
           "target_uri string, digest string, page_id long, payload_bytes long, "
           "payload_sha1 string, payload binary")


def _record_id(*parts: Column) -> Column:
    """A name-based identifier: equal parts give equal identifiers."""
    digest = F.md5(F.to_json(F.array(*(p.cast("string") for p in parts))))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind: Column | str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """The text of a record without the two line ends that close it."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    # concat_ws leaves out a header whose value is null.
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)


def _numbered(pages: DataFrame) -> DataFrame:
    """The rows with ``nth``, 0 for all but rows that repeat another. Those are added up by
    their content and dealt out again, so that no task holds a row that repeats very often
    and no other row is shuffled."""
    own = ["page_id", "url", "sha1", "size"]
    often = stored(pages.groupBy(*own).count().where("count > 1"), "repeated_pages")
    none = F.lit(0).cast("long").alias("nth")
    if often.isEmpty():
        return pages.select("*", none)
    side = small_or_shuffled(often.select(*(F.col(c).alias(f"of_{c}") for c in own)), 200)
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in own]
    again = pages.join(side, same, "left_semi").groupBy(*own).agg(
        F.first("payload").alias("payload"), F.count("*").alias("n"))
    dealt = again.select(*own, "payload", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
                         .alias("nth")).repartition(F.xxhash64("sha1", "nth"))
    return pages.join(side, same, "left_anti").select("*", none).unionByName(dealt)


def write_archives(pages: DataFrame, path: str, captured: str = CAPTURED) -> None:
    """Write ``pages (page_id, url, html, …)`` as gzipped WARC files.

    Of pages with equal payloads of at least REVISIT_BYTES bytes the one with the largest
    page_id is the response and the others revisit it; rows that share that page_id are
    responses each. A null html is an empty payload, a null url leaves the target out, a
    null page_id sorts lowest. Every row is a capture of its own, also one that repeats
    another: rows with equal page_id, url and payload are counted, and numbered in their
    record ids. Other columns are ignored.
    """
    payload = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"),
                         F.regexp_replace("url", r"[\r\n\x00]", "%0A").alias("url"),
                         payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"),
                         F.octet_length(payload).alias("size"))
    keepers = stored(
        pages.where(F.col("size") >= REVISIT_BYTES).groupBy("sha1", "size").agg(
            F.max(F.struct("page_id", "url")).alias("keeper"), F.min("page_id").alias("other"),
            F.count_if(F.col("page_id").isNull()).alias("unnamed"))
        .where("keeper.page_id <> other or (unnamed > 0 and keeper.page_id is not null)")
        .select(F.col("sha1").alias("of_sha1"), F.col("size").alias("of_size"), "keeper"), "keepers")
    rows = _numbered(pages).join(small_or_shuffled(keepers, 160), [
        F.col("sha1") == F.col("of_sha1"), F.col("size") == F.col("of_size")], "left")
    again = F.col("keeper").isNotNull() & ~F.col("keeper.page_id").eqNullSafe(F.col("page_id"))
    number = F.when(F.col("nth") > 0, F.col("nth"))
    main = _record_id(F.col("page_id"), F.col("url"), F.col("sha1"), number, F.lit("response"))
    original = _record_id(F.col("keeper.page_id"), F.col("keeper.url"), F.col("sha1"),
                          F.lit(None), F.lit("response"))
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(captured))]
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1")))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"
                          f"Content-Length: "), F.col("size").cast("string"), F.lit(END + END))
    response = F.when(again, _record("revisit", [
        ("WARC-Record-ID", main), *common, digest, ("WARC-Refers-To", original),
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("Content-Type", F.lit("application/http; msgtype=response"))], head)).otherwise(
        _record("response", [
            ("WARC-Record-ID", main), *common, digest,
            ("Content-Type", F.lit("application/http; msgtype=response"))],
            F.concat(head, F.col("payload"))))
    sides = []
    for kind, content, block in (
            ("request", "application/http; msgtype=request",
             F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{END}{END}"))),
            ("metadata", "application/warc-fields",
             F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                      F.lit(END)))):
        own_id = _record_id(F.col("page_id"), F.col("url"), F.col("sha1"), number, F.lit(kind))
        sides.append(_record(kind, [("WARC-Record-ID", own_id), *common,
                                    ("WARC-Concurrent-To", main),
                                    ("Content-Type", F.lit(content))], block))
    mean = pages.agg(F.avg("size")).first()[0] or 0
    most = min(RECORDS_PER_FILE, 3 * max(1, int(FILE_BYTES / (mean + HEADER_BYTES))))
    (rows.select(F.explode(F.array(response, *sides)).alias("value"))
     .write.option("lineSep", END + END).option("compression", "gzip")
     .option("maxRecordsPerFile", most).text(path))


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict, bytes]]:
    """Headers (names in lower case) and block of each record of an open archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers.get("content-length", 0))
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("an archive ends within a record")
        yield headers, block


def _parsed(with_payload: bool):
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _SCHEMA.split(", ")])

    def row(headers: dict, block: bytes) -> dict:
        kind = headers.get("warc-type")
        out = dict.fromkeys(names) | {
            "record_id": headers.get("warc-record-id"), "record_type": kind,
            "concurrent_to": headers.get("warc-concurrent-to"),
            "refers_to": headers.get("warc-refers-to"),
            "target_uri": headers.get("warc-target-uri"),
            "digest": headers.get("warc-payload-digest", "").rpartition(":")[2] or None}
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            out |= {"payload_bytes": len(payload), "payload_sha1": hashlib.sha1(payload).hexdigest(),
                    "payload": payload if with_payload else None}
        elif kind == "metadata":
            fields = dict(x.split(b":", 1) for x in block.split(b"\r\n") if b":" in x)
            value = fields.get(b"page-id", b"").strip()
            out["page_id"] = int(value) if value else None
        return out

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                content = batch.column(0)[i].as_py()
                stream = io.BytesIO(content)
                if content[:2] == b"\x1f\x8b":
                    stream = gzip.GzipFile(fileobj=stream)
                for headers, block in records(stream):
                    if headers.get("warc-type") in _RECORD_TYPES:
                        held.append(row(headers, block))
                        size += len(held[-1]["payload"] or b"") + 500
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per request, response, revisit and metadata record below ``path``."""
    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(_parsed(with_payload), _SCHEMA))


def captures(found: DataFrame) -> DataFrame:
    """One row per response or revisit: record_id, record_type, target_uri, digest,
    payload_bytes, payload_sha1, payload, and the structs request, metadata and original
    (what a revisit refers to). A missing partner is null; of several records that name
    the same response the smallest record_id counts, and a record_id counts once.
    """
    def beside(kind: str, columns: list[str]) -> DataFrame:
        return found.where(F.col("record_type") == kind).groupBy("concurrent_to").agg(
            F.min(F.struct("record_id", *columns)).alias(kind)).withColumnRenamed(
            "concurrent_to", f"{kind}_of")

    request = beside("request", ["target_uri"])
    metadata = beside("metadata", ["page_id"])
    main = found.where(F.col("record_type").isin("response", "revisit")).dropDuplicates(
        ["record_id"])
    joined = (main.drop("page_id", "concurrent_to")
              .join(request, F.col("record_id") == F.col("request_of"), "left")
              .join(metadata, F.col("record_id") == F.col("metadata_of"), "left")
              .drop("request_of", "metadata_of"))
    original = (found.where("record_type = 'response'").dropDuplicates(["record_id"])
                .join(metadata, F.col("record_id") == F.col("metadata_of"), "left")
                .select(F.col("record_id").alias("original_id"), F.struct(
                    "record_id", F.col("metadata.page_id").alias("page_id"), "payload_bytes",
                    "payload_sha1").alias("original")))
    revisits = joined.where("record_type = 'revisit'").join(
        original, F.col("refers_to") == F.col("original_id"), "left").drop("original_id")
    return joined.where("record_type = 'response'").withColumn(
        "original", F.lit(None).cast(original.schema["original"].dataType)).unionByName(revisits)
