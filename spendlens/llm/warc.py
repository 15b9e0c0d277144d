"""WARC archives: writing with segments and revisits, reading with segment reassembly.

A record whose block is longer than a segment is written as a first record with
segment number 1 and continuation records that name it as their origin; the last
one states the total length. Bodies are in chunked transfer framing, so a cut may
fall anywhere, also inside a frame's head. The reader groups continuation records
by their origin, orders them by number, checks numbers and total length, joins the
blocks and only then takes the framing off.

Records never cross a file, and a file holds a bounded number of them. Records in
one piece skip the grouping, so only segments are shuffled.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import stored

#: Bytes of a record's block, bytes of a transfer chunk, records of a file.
SEGMENT = 1 << 14
TRANSFER_CHUNK = 1 << 12
FILE_RECORDS = 4000

#: Payloads from this size on are written once.
REVISIT_BYTES = 1000

# Fixed values of the formats.
_VERSION = b"WARC/1.1"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n"


def framed(body: bytes, size: int = TRANSFER_CHUNK) -> bytes:
    """A body in chunked transfer framing."""
    parts = []
    for i in range(0, len(body), size):
        part = body[i : i + size]
        parts += [b"%x\r\n" % len(part), part, _END]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframed(data: bytes) -> bytes:
    """The body out of chunked transfer framing; ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        line_end = data.find(_END, at)
        if line_end < 0:
            raise ValueError("chunk without a size")
        size = int(data[at:line_end].split(b";")[0], 16)
        at = line_end + 2
        if size == 0:
            return b"".join(parts)
        if data[at + size : at + size + 2] != _END:
            raise ValueError("chunk of another length")
        parts.append(data[at : at + size])
        at += size + 2


def body_of(block: bytes) -> bytes:
    """The payload of an HTTP response: what follows its head, without transfer framing."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("response without a head")
    fields = _fields(head)
    return unframed(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def _fields(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"".join([_VERSION, _END, head.encode(), b"Content-Length: %d\r\n" % len(block),
                     _END, block, _END])


def _uri(url: str | None, page_id) -> str:
    """A target on one line; control characters and blanks are escaped."""
    found = url or f"urn:page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", found)


def records_of(page: dict, date: str, segment: int) -> Iterator[bytes]:
    """The records of one page, each without its last line end."""
    record_id = f"<urn:uuid:{page['record_id']}>"
    fields = [
        ("WARC-Record-ID", record_id),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(page["url"], page["page_id"])),
        ("WARC-Payload-Digest", f"sha1:{page['digest']}"),
        ("Page-ID", page["page_id"]),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page["refers_to"] is not None:
        head = _HTTP + b"Content-Length: %d\r\n\r\n" % page["payload_bytes"]
        yield _record(
            [("WARC-Type", "revisit"), *fields, ("WARC-Profile", _SAME_PAYLOAD),
             ("WARC-Refers-To", f"<urn:uuid:{page['refers_to_record']}>"),
             ("Refers-To-Page-ID", page["refers_to"])],
            head,
        )
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + framed(page["payload"])
    if len(block) <= segment:
        yield _record([("WARC-Type", "response"), *fields], block)
        return
    count = -(-len(block) // segment)
    yield _record(
        [("WARC-Type", "response"), *fields, ("WARC-Segment-Number", 1)], block[:segment]
    )
    for number in range(2, count + 1):
        part = block[(number - 1) * segment : number * segment]
        yield _record(
            [("WARC-Type", "continuation"),
             ("WARC-Record-ID", f"<urn:uuid:{page['record_id']}-{number}>"),
             ("WARC-Date", date),
             ("WARC-Segment-Origin-ID", record_id),
             ("WARC-Segment-Number", number),
             ("WARC-Segment-Total-Length", len(block) if number == count else None)],
            part,
        )


def _write_batches(date: str, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                rows = batch.slice(i, 256).to_pylist()
                found = [r for page in rows for r in records_of(page, date, segment)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["record"])

    return run


def _record_id(page_id, digest):
    """A uuid from page and payload, so a page can name the record it refers to."""
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *parts)


def write_archives(
    pages: DataFrame,
    folder: str,
    date: str = "1970-01-01T00:00:00Z",
    segment: int = SEGMENT,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> None:
    """Write a record for each row of ``pages`` into WARC files in a new ``folder``.

    The payload is the text in UTF-8, null as empty. Of records with equal payloads
    of at least 1000 bytes that with the largest id is a response, the others
    revisit it; smaller ones are all responses. Rows that repeat id and text are
    written as often as given, all as what their id makes them. Without any id in a
    group of equal payloads all of it are responses; beside ids, a row without one
    revisits. A null url becomes one made from the id. Extra columns are ignored; an
    empty table leaves an archive without records.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("bigint")})
    # Only digests that occur twice meet the pages again: payloads are not shuffled for the rest.
    first = stored(
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "original"),
        "warc-originals",
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    records = (
        rows.join(first, "digest", "left")
        .withColumn("refers_to", refers)
        .select(
            "page_id", "url", "digest", "payload_bytes", "refers_to",
            F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
            _record_id(F.col("page_id"), F.col("digest")).alias("record_id"),
            _record_id(F.col("refers_to"), F.col("digest")).alias("refers_to_record"),
        )
        .mapInArrow(_write_batches(date, segment), "record binary")
    )
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(folder)
    )


def parse(content: bytes) -> Iterator[tuple[dict[str, str], int, int]]:
    """Fields of each record of an archive, and where its block begins and ends."""
    at = 0
    while at < len(content):
        if content[at : at + 2] == _END:
            at += 2
            continue
        head_end = content.find(b"\r\n\r\n", at)
        if head_end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        fields = _fields(content[at:head_end])
        begin = head_end + 4
        at = begin + int(fields["content-length"])
        if at > len(content):
            raise ValueError("record is cut off")
        yield fields, begin, at


_COLUMNS = {
    "origin": pa.string(), "number": pa.int32(), "total": pa.int64(), "page_id": pa.int64(),
    "record_type": pa.string(), "digest": pa.string(), "refers_to": pa.int64(),
    "http_length": pa.int64(), "data": pa.binary(), "problem": pa.string(),
}
_SCHEMA = (
    "origin string, number int, total bigint, page_id bigint, record_type string, "
    "digest string, refers_to bigint, http_length bigint, data binary, problem string"
)


def _number(value: str | None) -> int | None:
    return int(value) if value else None


def _payload(block: bytes) -> tuple[bytes | None, str | None]:
    try:
        return body_of(block), None
    except ValueError as error:
        return None, str(error)


def _read_batches(segments: bool):
    """Parse files; of their records only segments, or only records in one piece."""

    def row(fields: dict[str, str], block: bytes) -> tuple:
        number = _number(fields.get("warc-segment-number"))
        origin = fields.get("warc-segment-origin-id") or fields.get("warc-record-id")
        data, problem, length = block, None, None
        if fields["warc-type"] == "revisit":
            data, length = None, _number(_fields(block.partition(b"\r\n\r\n")[0]).get("content-length"))
        elif number is None:
            data, problem = _payload(block)
        return (
            origin, number, _number(fields.get("warc-segment-total-length")),
            _number(fields.get("page-id")), fields["warc-type"],
            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            _number(fields.get("refers-to-page-id")), length, data, problem,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), _COLUMNS.values())]
            return pa.RecordBatch.from_arrays(arrays, names=list(_COLUMNS))

        for batch in batches:
            for value in batch.column(0):
                content = value.as_py()
                if content[:2] == b"\x1f\x8b":
                    content = gzip.decompress(content)
                rows = []
                for fields, begin, end in parse(content):
                    if fields["warc-type"] not in ("response", "revisit", "continuation"):
                        continue
                    if ("warc-segment-number" in fields) == segments:
                        rows.append(row(fields, content[begin:end]))
                    if len(rows) == 512:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return run


def _joined_udf():
    """Payload out of the ordered segments of a record and its total length."""

    def one(segments: list[dict], total: int | None) -> dict:
        numbers = [s["number"] for s in segments]
        block = b"".join(s["data"] for s in segments)
        if numbers != list(range(1, len(numbers) + 1)):
            return {"data": None, "problem": "segments are missing"}
        if len(block) != total:
            return {"data": None, "problem": "segments of another total length"}
        data, problem = _payload(block)
        return {"data": data, "problem": problem}

    @F.arrow_udf("struct<data: binary, problem: string>")
    def joined(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for segments, totals in parts:
            rows = [one(s.as_py(), t.as_py()) for s, t in zip(segments, totals)]
            yield pa.array(rows, pa.struct([("data", pa.binary()), ("problem", pa.string())]))

    return joined.asNondeterministic()


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of the responses and revisits in the WARC files of a folder.

    Returns ``page_id``, ``record_type``, ``payload`` (null for revisits),
    ``payload_bytes``, ``payload_digest``, ``refers_to`` and ``problem``, which says
    why a payload could not be put together (segments missing, another total length,
    broken framing) and is null otherwise. Segments that are stored twice count once
    in a payload; their record comes back as often as its first segment is stored.
    Files may be gzipped. A file that is no archive ends the job.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    whole = files.mapInArrow(_read_batches(False), _SCHEMA)
    rest = [c for c in _COLUMNS if c not in ("origin", "number", "data", "problem")]
    segments = (
        files.mapInArrow(_read_batches(True), _SCHEMA)
        .groupBy("origin", "number")
        .agg(F.count(F.lit(1)).alias("copies"), *[F.any_value(c, True).alias(c) for c in (*rest, "data")])
        .groupBy("origin")
        .agg(
            F.array_sort(F.collect_list(F.struct("number", "data"))).alias("segments"),
            F.max("total").alias("total"),
            *[
                F.max(F.when(F.col("number") == 1, F.col(c))).alias(c)
                for c in (*rest, "copies") if c != "total"
            ],
        )
        .withColumn("joined", _joined_udf()("segments", "total"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.coalesce("copies", F.lit(1))))))
        .select(*rest, "joined.data", "joined.problem")
    )
    every = whole.select(*rest, "data", "problem").unionByName(segments)
    revisit = F.col("record_type") == "revisit"
    return every.select(
        "page_id",
        "record_type",
        F.col("data").alias("payload"),
        F.when(revisit, F.col("http_length")).otherwise(F.octet_length("data")).cast("bigint").alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.sha1("data")).alias("payload_digest"),
        "refers_to",
        "problem",
    )
