"""Legacy web archives (ARC, versions 1 and 2) converted to WARC, and WARC files read back.

An ARC file begins with a version block, whose second line says how the header line of every record
is laid out; a record's length is declared in its header line, never searched for. From
these the WARC fields are made: record ids and digests from the content, times from the ARC date, types from
the content and from the other records. Of records with equal payloads one is kept whole, as a response; the others
become revisits that refer to it.

Files are written by Spark's text writer, one record a row, so they go wherever Spark writes: a record ends with
the two line ends that also part the rows. They are read whole by ``binaryFile`` and unpacked as a stream, so
``RECORDS_PER_FILE`` bounds them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylog.llm.common import small_batches

RECORDS_PER_FILE = 4000
# Payloads from this size on are stored once.
REVISIT_FROM = 1000
# ARC files made from pages hold about so many bytes.
ARC_BYTES = 4 << 20

# The field names that name the two layouts of ARC header lines.
ARC_FIELDS = {
    b"1": [b"URL", b"IP-address", b"Archive-date", b"Content-type", b"Archive-length"],
    b"2": [b"URL", b"IP-address", b"Archive-date", b"Content-type", b"Result-code", b"Checksum", b"Location", b"Offset",
           b"Filename", b"Archive-length"],
}
# Fixed value: the profile of a revisit record whose payload is identical.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ARC


def arc_block(version: bytes, name: str, records: list[tuple[bytes, bytes, bytes]]) -> bytes:
    """An ARC file of records ``(url, date, content)``."""
    fields = b" ".join(ARC_FIELDS[version]) + b"\n"
    about = version + b" 0 tallylog\n" + fields + b"\n"
    out = [_arc_line(version, b"filedesc://" + name.encode(), b"20200101000000", b"text/plain", about, name, 0), about, b"\n"]
    size = sum(map(len, out))
    for url, date, content in records:
        line = _arc_line(version, url, date, b"text/html", content, name, size)
        out += [line, content, b"\n"]
        size += len(line) + len(content) + 1
    return b"".join(out)


def _arc_line(version: bytes, url: bytes, date: bytes, kind: bytes, content: bytes, name: str, offset: int) -> bytes:
    # White space would end the field.
    address = b"%20".join(url.split()) or b"-"
    values = [address, b"0.0.0.0", date, kind]
    if version == b"2":
        values += [b"200", b"-", b"-", str(offset).encode(), name.encode()]
    return b" ".join([*values, str(len(content)).encode()]) + b"\n"


def arc_records(content: bytes) -> Iterator[dict]:
    """The records of an ARC file: the fields of the header line by name, ``offset`` and ``content``.

    Bad headers and lengths beyond the end raise an error: nothing is skipped in silence.
    """
    at, fields = 0, None
    while at < len(content):
        if content[at : at + 1] == b"\n":  # between records
            at += 1
            continue
        end = content.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header line without an end at {at}")
        values = content[at:end].rstrip(b"\r").split(b" ")
        length = int(values[-1])
        body = content[end + 1 : end + 1 + length]
        if len(body) != length:
            raise ValueError(f"ARC record at {at} is cut: {len(body)} of {length} bytes")
        if fields is None:
            about = body.split(b"\n")
            version, fields = about[0].split(b" ")[0], about[1].rstrip(b"\r").split(b" ")
            if not values[0].startswith(b"filedesc://") or ARC_FIELDS.get(version) != fields:
                raise ValueError(f"not an ARC file of version 1 or 2: {about[:2]}")
        elif len(values) != len(fields):
            raise ValueError(f"ARC header line at {at} has {len(values)} fields instead of {len(fields)}")
        else:
            yield dict(zip([f.decode() for f in fields], values)) | {"offset": at, "content": body}
        at = end + 1 + length


def arc_files(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``path, content``: the pages as ARC files, versions in turn, in the shape of ``binaryFile``.

    A record is an HTTP response whose ``X-Page-Id`` header has the key. Null html is an empty payload, a null
    url or key an empty one. Repeated rows are records each; an empty table gives no files; other columns play no part.
    """

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, waiting, size = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> pa.RecordBatch:
            name = f"pages-{part:06d}-{number:06d}.arc"
            content = arc_block(b"2" if number % 2 else b"1", name, waiting)
            return pa.RecordBatch.from_pydict({"path": [name], "content": pa.array([content], pa.binary())})

        for batch in batches:
            for page, address, text in zip(batch["k"], batch["u"], batch["h"].cast(pa.binary())):
                payload = text.as_py() or b""
                page_id = b"" if page.as_py() is None else str(page.as_py()).encode()
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += b"Content-Length: %d\r\nX-Page-Id: %s\r\n\r\n" % (len(payload), page_id)
                waiting.append(((address.as_py() or "").encode(), b"20200101000000", head + payload))
                size += len(head) + len(payload)
                if size >= ARC_BYTES:
                    yield packed()
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield packed()

    rows = small_batches(pages).select(F.col(key).cast("bigint").alias("k"), F.col(url).cast("string").alias("u"), F.col(html).cast("string").alias("h"))
    return rows.mapInArrow(files, "path string, content binary")


_CONVERTED = (
    "path string, offset bigint, uri string, date string, page_id bigint, head string, payload binary, "
    "payload_bytes bigint, payload_digest string"
)


def from_arc(files: DataFrame) -> DataFrame:
    """The records of ARC files ``path, content``, with header block, payload and its digest.

    HTTP headers end at the first empty line; content without them is all payload, and a record without ``X-Page-Id`` has a null
    key. Repeated records and files stay; an empty table gives no rows; other columns play no part. A null content is an error.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                for record in arc_records(content.as_py()):
                    head, payload = split_http(record["content"])
                    rows.append(
                        {
                            "path": path.as_py(),
                            "offset": record["offset"],
                            "uri": record["URL"].decode("utf-8", "replace"),
                            "date": record["Archive-date"].decode("ascii", "replace"),
                            "page_id": page_key(head),
                            "head": head.decode("latin-1"),
                            "payload": payload,
                            "payload_bytes": len(payload),
                            "payload_digest": hashlib.sha1(payload).hexdigest(),
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, _ARC_SCHEMA)

    return files.select("path", "content").mapInArrow(records, _CONVERTED)


_ARC_SCHEMA = pa.schema(
    [("path", pa.string()), ("offset", pa.int64()), ("uri", pa.string()), ("date", pa.string()), ("page_id", pa.int64()),
     ("head", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their empty line, and the payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = content.find(b"\r\n\r\n")
    return (content, b"") if end < 0 else (content[: end + 4], content[end + 4 :])


def http_field(head: bytes, name: bytes) -> bytes | None:
    for line in head.split(b"\r\n")[1:]:
        field, colon, value = line.partition(b":")
        if colon and field.strip().lower() == name:
            return value.strip()
    return None


def page_key(head: bytes) -> int | None:
    value = http_field(head, b"x-page-id")
    return int(value) if value else None


# WARC


def to_warc(records: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """``record``: the text of a WARC record for each of :func:`from_arc`'s rows, without its two last line ends.

    Of equal payloads of ``revisit_from`` bytes or more the record with the largest page id is the response; ties go to the last
    in order of file and offset. Null page ids count as the smallest. An empty table gives no records.
    """
    each = records.withColumn("record_id", _record_id("path", "offset", "uri", "payload_digest"))
    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("k"), "path", "offset")
    winners = (
        each.filter(F.col("payload_bytes") >= revisit_from)
        .groupBy(F.col("payload_digest").alias("d"))
        .agg(F.max(F.struct(order.alias("o"), "record_id", "uri", "date")).alias("w"))
    )
    # Payloads move once, by digest; adaptive execution cuts the partition of a very frequent one.
    each = each.join(winners.hint("merge"), F.col("payload_digest") == F.col("d"), "left")
    revisit = (F.col("payload_bytes") >= revisit_from) & (F.col("w.record_id") != F.col("record_id"))
    head = F.col("head").cast("binary")
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Date: "), _iso_date("date")),
        F.concat(F.lit("WARC-Target-URI: "), "uri"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), F.sha1(block)),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), F.col("w.record_id"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Target-URI: "), F.col("w.uri"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Date: "), _iso_date("w.date"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.length(block).cast("string")),
    ]
    header = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n")).cast("binary")
    # The bytes of the record; the cast to text changes none of them.
    return each.select(F.concat(header, block).cast("string").alias("record"))


def _record_id(*columns: str) -> Column:
    digest = F.sha1(F.concat_ws("\n", *[F.col(c).cast("string") for c in columns]))
    parts = [F.substring(digest, at, size) for at, size in ((1, 8), (9, 4))]
    rest = [F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(F.lit("8"), F.substring(digest, 18, 3)), F.substring(digest, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts, *rest), F.lit(">"))


def _iso_date(column: str) -> Column:
    """A time of WARC from an ARC date of 4 to 14 digits, whose missing parts are their least values; what is no date becomes 1970."""
    # Bytes of other lengths than whole parts keep the parts that are whole.
    whole = f"substring({column}, 1, 4 + 2 * ((length({column}) - 4) div 2))"
    filled = f"concat({whole}, substring('00000101000000', length({whole}) + 1))"
    parts = ", ".join(f"CAST(substring({filled}, {at}, {size}) AS INT)" for at, size in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2)))
    time = f"try_make_timestamp_ntz({parts}, CAST(substring({filled}, 13, 2) AS DECIMAL(16, 6)))"
    known = f"CASE WHEN {column} RLIKE '^[0-9]{{4,14}}$' THEN replace(CAST({time} AS STRING), ' ', 'T') END"
    return F.expr(f"concat(coalesce({known}, '1970-01-01T00:00:00'), 'Z')")


def write_warc(records: DataFrame, path: str) -> None:
    """Writes :func:`to_warc`'s rows as gzip files."""
    writer = records.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.option("zlib.compress.level", "BEST_SPEED").option("compression", "gzip").text(path)


def warc_records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields (names in lower case) and block of every record of a WARC file, gzip or not."""
    buffer = _Unpacked(content)
    while True:
        line = buffer.line()
        while line in (b"\r\n", b"\n"):
            line = buffer.line()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := buffer.line()).strip():
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        size = int(fields["content-length"])
        block = buffer.take(size)
        if len(block) != size:
            raise ValueError(f"WARC record {fields.get('warc-record-id')} is cut")
        yield fields, block


class _Unpacked:
    """Bytes of a file, unpacked bit by bit if it is gzip, of one or many members."""

    STEP = 1 << 20

    def __init__(self, content: bytes):
        self.packed, self.at = content, 0
        self.unpack = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None
        self.ready, self.start = b"", 0

    def _more(self) -> bool:
        if self.at >= len(self.packed):
            return False
        piece = self.packed[self.at : self.at + self.STEP]
        self.at += len(piece)
        if self.unpack:
            out = self.unpack.decompress(piece)
            while self.unpack.eof and (rest := self.unpack.unused_data):
                self.unpack = zlib.decompressobj(31)
                out += self.unpack.decompress(rest)
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
            piece = out
        self.ready, self.start = self.ready[self.start :] + piece, 0
        return True

    def line(self) -> bytes:
        while (end := self.ready.find(b"\n", self.start)) < 0 and self._more():
            pass
        return self.take(end + 1 - self.start if end >= 0 else len(self.ready) - self.start)

    def take(self, size: int) -> bytes:
        while len(self.ready) - self.start < size and self._more():
            pass
        out = self.ready[self.start : self.start + size]
        self.start += len(out)
        return out


def read_warc(spark, path: str, with_payload: bool = False) -> DataFrame:
    """The records of WARC files: id, type, key, length and digest of the full payload, and what a revisit refers to.

    The digest of every block and of every payload that is there is checked; a wrong one is an error.
    """
    fields = "record_id string, record_type string, uri string, page_id bigint, payload_bytes bigint, payload_digest string, refers_to_id string"
    schema = pa.schema(
        [("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("page_id", pa.int64()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string())]
        + [("payload", pa.binary())] * with_payload
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for head, block in warc_records(content.as_py()):
                    rows.append(_described(head, block, with_payload))
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return found.mapInArrow(read, fields + ", payload binary" * with_payload)


def _described(fields: dict, block: bytes, with_payload: bool) -> dict:
    head, payload = split_http(block)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if hashlib.sha1(block).hexdigest() != fields["warc-block-digest"].removeprefix("sha1:"):
        raise ValueError(f"block digest of {fields['warc-record-id']} is wrong")
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload digest of {fields['warc-record-id']} is wrong")
    # A revisit has only the headers, which may declare the full length.
    declared = http_field(head, b"content-length") or b""
    size = (int(declared) if declared.isdigit() else None) if revisit else len(payload)
    row = {
        "record_id": fields["warc-record-id"],
        "record_type": fields["warc-type"],
        "uri": fields["warc-target-uri"],
        "page_id": page_key(head),
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to_id": fields.get("warc-refers-to"),
    }
    return row | ({"payload": payload} if with_payload else {})


def resolved(records: DataFrame) -> DataFrame:
    """The records with ``refers_to``: the key of the response that a revisit refers to.

    A revisit's ``payload_bytes`` are those of that response; only where it is missing they are what the revisit's own headers
    declare, null if nothing. Repeated records stay; an empty table gives no rows.
    """
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full")
    )
    revisits = records.filter("record_type = 'revisit'").join(responses, "refers_to_id", "left")
    revisits = revisits.withColumn("payload_bytes", F.coalesce("full", "payload_bytes"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    whole = records.filter("record_type != 'revisit'").withColumn("refers_to", F.lit(None).cast("bigint"))
    return revisits.select(*columns).unionAll(whole.select(*columns))
