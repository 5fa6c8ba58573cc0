"""Legacy archive converter: ARC to WARC, with revisit records for repeated payloads.

An ARC archive starts with a filedesc record whose block names the format version (1 or 2) and the fields of the header line that
precedes each document: version 1 has URL, address, date, type and length, version 2 also result code, checksum, location, offset
and file name; fields of other names are kept as they are found. A document's bytes are those that its header line declares.
Every document becomes a WARC 1.1 record: its id is a name-based UUID of archive, place and digest, so that a rerun writes the
same bytes; dates, types and digests are synthesised from the header line and the payload.

Of documents with the same payload of at least LEAST_REVISIT bytes the one with the least key is a response, the others are revisits
that refer to it and have no payload; smaller payloads are all responses. Records are written by Spark's text writer, one record per row
with CRLF CRLF after it, through Spark's commit protocol: archives appear whole or not at all, in any store that Spark writes to.

Defined results: a null payload is empty; null keys order last and are written as empty; rows equal in key and payload: one of them is
the response; URLs are percent-encoded where a header line can't hold them, null URLs become "urn:none"; an archive that breaks
off inside a record, or a header line without a length in ASCII digits, gives a record of type "error" and ends that archive; a header line without
a URL, or under a field line that names none, gives one and the next record is read; records of type "error" aren't written; text keys are
percent-encoded in header lines and compared by their own characters; very long payloads are records like others; an empty table gives archives
without records; other columns of the input are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

LEAST_REVISIT = 100
#: Bytes of payload after which a new archive is begun.
ARCHIVE_BYTES = 4_000_000
#: Repeated payloads (a digest, a key and an id each, about 150 bytes) that are broadcast at most.
BROADCAST_ROWS = 100_000
#: Records, and bytes before compression, of a WARC archive at most, but for one record larger than that.
FILE_RECORDS, FILE_BYTES = 2000, 1 << 29
DATE = "20240101000000"
#: The header-line fields of ARC versions 1 and 2.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
RECORD = "key string, url string, date string, type string, record_id string, payload binary, payload_bytes long, payload_digest string, error string"


def arc_archive(version: int, name: str, documents: list[tuple[str, str, bytes]]) -> bytes:
    """An ARC archive of (key, url, payload); the key is the last field before the length, "Document-key"."""
    fields = [*FIELDS[version][:-1], "Document-key", FIELDS[version][-1]]
    head = f"{version} 0 docloom\n{' '.join(fields)}\n\n".encode()
    first = [f"filedesc://{name}", "0.0.0.0", DATE, "text/plain"] + (["200", "-", "-", "0", name] if version == 2 else []) + ["-", str(len(head))]
    out = [" ".join(first).encode() + b"\n" + head]
    at = len(out[0])
    for key, url, payload in documents:
        line = [_field(url) or "urn:none", "0.0.0.0", DATE, "text/html"] + (["200", "-", "-", str(at), name] if version == 2 else [])
        out.append(" ".join([*line, _key(key), str(len(payload))]).encode() + b"\n" + payload + b"\n")
        at += len(out[-1])
    return b"".join(out)


def _field(value: str | None) -> str:
    return quote(value or "", safe="!#$%&'()*+,/:;=?@[]~-._")


def _key(value: str | None) -> str:
    """A key in a header line: "-" for null and "%" for empty, else percent-encoded; see key_of."""
    return "-" if value is None else "%" if value == "" else "%2D" if value == "-" else quote(value, safe="!$&'()*,/:;=?@~._")


def key_of(written: Column) -> Column:
    """The key that _key has written."""
    return F.when(written == "%", "").when(written != "-", F.try_url_decode(written))


def _number(value: str) -> int:
    """A number in ASCII digits that fits 64 bits, else -1."""
    return int(value) if value.isascii() and value.isdigit() and len(value) < 19 else -1


def parse_arc(name: str, content: bytes) -> Iterator[dict]:
    """The documents of one ARC archive."""
    fields, at = FIELDS[1], 0
    while at < len(content):
        if content[at : at + 1] == b"\n":  # between records
            at += 1
            continue
        end = content.find(b"\n", at)
        values = content[at : end if end >= 0 else len(content)].decode("utf-8", "replace").rstrip("\r").split(" ")
        length = _number(values[-1])
        first = end + 1
        if end < 0 or length < 0 or first + length > len(content):
            yield {"error": f"byte {at}: broken record"}
            return
        payload = content[first : first + length]
        if values[0].startswith("filedesc://"):
            lines = payload.split(b"\n")
            version = _number(lines[0].split(b" ")[0].decode("utf-8", "replace"))
            fields = lines[1].decode("utf-8", "replace").split() if len(lines) > 1 and lines[1].strip() else FIELDS.get(version, FIELDS[1])
        else:
            # a URL of the first ARC tools may hold blanks: the other fields count from the right
            extra = max(0, len(values) - len(fields))
            values = [" ".join(values[: extra + 1]), *values[extra + 1 :]]
            named = dict(zip(fields, values, strict=False))
            digest = hashlib.sha256(payload).hexdigest()
            if not named.get("URL"):
                yield {"error": f"byte {at}: header line without a URL"}
                at = first + length
                continue
            yield {
                "key": named.get("Document-key", "-"), "url": named["URL"], "date": _date(named.get("Archive-date", "")), "type": named.get("Content-type", "application/octet-stream"),
                "record_id": str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name} {at} {digest}")), "payload": payload, "payload_bytes": length, "payload_digest": digest,
            }
        at = first + length


def _date(value: str) -> str:
    v = (value + "00000101000000"[len(value) :])[:14] if value.isascii() and value.isdigit() else DATE
    return f"{v[:4]}-{v[4:6]}-{v[6:8]}T{v[8:10]}:{v[10:12]}:{v[12:14]}Z"


def convert(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """archives: path and content, as Spark's binaryFile source gives them. One row of RECORD per document; payloads may be left out."""
    schema = T.StructType.fromDDL(RECORD)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 5 + [pa.binary(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for i in range(batch.num_rows):
                rows = [r if payloads else r | {"payload": None} for r in parse_arc(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return archives.select("path", "content").mapInArrow(run, schema)


def pages_to_arc(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """path and content of ARC archives of the rows, of versions 1 and 2 by turns; no archive is larger than ARCHIVE_BYTES and a document."""
    own = pages.select(F.col(key).cast("string").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[tuple[str, str, bytes]] = []
        size = number = 0

        def archive():
            name = f"part-{TaskContext.get().partitionId():05d}-{number:05d}.arc"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_archive(1 + number % 2, name, held)], pa.binary())], names=["path", "content"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    held, size, number = [], 0, number + 1
        if held:
            yield archive()

    return own.mapInArrow(run, "path string, content binary")


def with_types(records: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """records with record_type, refers_to (key of the response) and refers_to_id. Keys that are numbers are compared as numbers. headers: the same
    records without payloads, if they can be had for less."""
    order = F.struct(F.expr("key = '-'").alias("none"), F.expr("try_cast(key AS decimal(38,0))").isNull().alias("z"), F.expr("try_cast(key AS decimal(38,0))").alias("number"), key_of(F.col("key")).alias("text"), "key", "record_id")
    large = (records if headers is None else headers).filter(F.col("payload_bytes") >= LEAST_REVISIT)
    firsts = large.groupBy("payload_digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = cut(firsts.select("payload_digest", F.col("first.key").alias("first_key"), F.col("first.record_id").alias("first_id")))
    # few repeated payloads are sent to all tasks; many meet the records by digest
    out = records.join(F.broadcast(firsts) if firsts.count() <= BROADCAST_ROWS else firsts, "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & (F.col("payload_bytes") >= LEAST_REVISIT) & (F.col("record_id") != F.col("first_id"))
    kind = F.when(F.col("error").isNotNull(), "error").when(revisit, "revisit").otherwise("response")
    return out.withColumns({"record_type": kind, "refers_to": F.when(revisit, F.col("first_key")), "refers_to_id": F.when(revisit, F.col("first_id"))}).drop("first_key", "first_id")


def write_warc(records: DataFrame, path: str, largest: int = 0) -> None:
    """WARC archives of typed records (those of type "error" are left out), a new one after FILE_RECORDS records of a task, or after fewer where
    payloads of `largest` bytes would make it larger than FILE_BYTES."""
    head = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), "record_id", F.lit(">")), F.concat(F.lit("WARC-Date: "), "date"),
        F.concat(F.lit("WARC-Target-URI: "), "url"), F.concat(F.lit("WARC-Payload-Digest: sha256:"), "payload_digest"), F.concat(F.lit("X-Document-Key: "), "key"), F.concat(F.lit("X-Payload-Length: "), "payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.concat(F.lit("WARC-Refers-To: <urn:uuid:"), "refers_to_id", F.lit(">\r\nX-Refers-To-Key: "), "refers_to", F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.concat(F.lit("Content-Type: "), F.when(F.col("type").contains("/"), F.col("type")).otherwise("application/octet-stream")),
        F.concat(F.lit("Content-Length: "), F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.col("payload_bytes"))),
    ]
    body = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.col("payload").cast("string"))
    rows = records.filter("record_type <> 'error'").select(F.concat(F.concat_ws("\r\n", *head), F.lit("\r\n\r\n"), body).alias("value"))
    rows.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", max(1, min(FILE_RECORDS, FILE_BYTES // (largest + 1000)))).option("compression", "gzip").text(path)


def parse_warc(content: bytes) -> Iterator[dict]:
    """The records of one archive, gzipped or plain."""
    content = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/1.", at):
            yield {"error": f"byte {at}: broken record"}
            return
        head = dict(line.split(b": ", 1) for line in content[at:end].split(b"\r\n")[1:])
        length = int(head[b"Content-Length"])
        body = content[end + 4 : end + 4 + length]
        if len(body) < length:
            yield {"error": f"byte {at}: broken record"}
            return
        text = {k.decode(): v.decode("utf-8", "replace") for k, v in head.items()}
        kind, digest = text["WARC-Type"], text["WARC-Payload-Digest"].removeprefix("sha256:")
        wrong = kind != "revisit" and (hashlib.sha256(body).hexdigest() != digest or length != int(text["X-Payload-Length"]))
        yield {
            "key": text["X-Document-Key"], "payload_bytes": int(text["X-Payload-Length"]), "payload_digest": digest, "record_type": kind, "refers_to": text.get("X-Refers-To-Key"),
            "url": text["WARC-Target-URI"], "record_id": text["WARC-Record-ID"][10:-1], "date": text["WARC-Date"], "error": f"byte {at}: payload and digest differ" if wrong else None,
        }
        at = end + 4 + length + 4


def read_warc(archives: DataFrame) -> DataFrame:
    """archives: path and content. The records' headers, checked against their payloads."""
    schema = T.StructType.fromDDL("key string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string, record_id string, date string, error string")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(parse_warc(batch.column(0)[i].as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], pa.int64() if n == "payload_bytes" else pa.string()) for n in names], names=names)

    return archives.select("content").mapInArrow(run, schema)


def arc_to_warc(archives: DataFrame, path: str) -> DataFrame:
    """Converts, writes WARC archives under `path` and reads them back."""
    headers = cut(convert(archives, payloads=False).select("key", "record_id", "payload_bytes", "payload_digest"))
    largest = headers.agg(F.coalesce(F.max("payload_bytes"), F.lit(0))).first()[0]
    write_warc(with_types(convert(archives), headers), path, largest)
    files = archives.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return read_warc(files)
