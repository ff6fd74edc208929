"""WARC archives with one Zstandard frame per record and an embedded dictionary.

Each archive begins with a skippable frame that holds a dictionary built from the archive's own records (a bounded,
evenly spaced sample of them), followed by one compressed frame per record, so any record can be read alone from its
offset. Records with a payload met before become ``revisit`` records that refer to the first one. Spark decides the
roles (digests are grouped and joined; payloads take part in neither), tasks write archives of bounded size into a
shared folder, and an index table names every record's archive, offset and length. Archives of lost or repeated
attempts have names of their own and stay unread, since no committed index row names them.

Defined results: a null ``html`` is an empty payload; a null url an empty target. The row with the smallest id of its
payload is the response (rows that repeat both id and payload alike); a row without an id is a response if no row with
an id has its payload, else a revisit. An empty table gives no archive and no row. Columns other than ``page_id``,
``url`` and ``html`` are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the skippable frame that carries a dictionary in .warc.zst, and WARC field names
DICTIONARY_FRAME = 0x184D2A5D
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "archive string, offset long, length long, page_id long, record_type string"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary"
)


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: the id of the response that holds the payload already, null for responses."""
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", F.col("html"), F.sha1(body).alias("_digest"))
    keyed = pages.filter(F.octet_length(body) >= min_bytes).select("page_id", F.sha1(body).alias("_digest"))
    first = keyed.groupBy("_digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    again = (
        keyed.join(first.filter("_n > 1 AND refers_to IS NOT NULL").drop("_n"), "_digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .dropDuplicates(["page_id", "_digest"])
        .withColumnRenamed("page_id", "_page")
    )
    return rows.join(
        again, rows["page_id"].eqNullSafe(again["_page"]) & (rows["_digest"] == again["_digest"]), "left"
    ).select("page_id", "url", "html", "refers_to")


def _record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, date: str) -> tuple[bytes, str]:
    payload = (html or "").encode()
    kind = "response" if refers_to is None else "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    fields = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        fields += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", kind


def build_dictionary(records: list[bytes], size: int, sample_bytes: int) -> bytes:
    """A dictionary of at most ``size`` bytes from evenly spaced records of ``sample_bytes`` in all."""
    import zstandard

    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    picked = [r[: 32 << 10] for r in records[::step]]
    try:
        return zstandard.train_dictionary(size, picked, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too few records to learn from: their bytes themselves serve
        return b"".join(picked)[:size]


def _archive(records: list[bytes], size: int, sample_bytes: int, level: int) -> tuple[bytes, list[tuple[int, int]]]:
    import zstandard

    dictionary = build_dictionary(records, size, sample_bytes)
    coder = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
    out = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)), dictionary]
    at, where = 8 + len(dictionary), []
    for r in records:
        frame = coder.compress(r)
        out.append(frame)
        where.append((at, len(frame)))
        at += len(frame)
    return b"".join(out), where


def write_archives(
    rows: DataFrame, folder: str, archive_bytes: int = 8 << 20, dictionary_bytes: int = 32 << 10,
    sample_bytes: int = 1 << 20, level: int = 3, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write rows of :func:`roles` as archives below ``folder``, a URI or path that executors can write to.

    Returns the index, one row per record; the archives exist once it has been computed, and count if it was kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        pending: list[tuple[int | None, str, bytes]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            data, where = _archive([r for _, _, r in pending], dictionary_bytes, sample_bytes, level)
            name = f"{uuid.uuid4().hex}.warc.zst"
            store.create_dir(path, recursive=True)
            with store.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(data)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(pending)),
                    pa.array([o for o, _ in where], pa.int64()),
                    pa.array([n for _, n in where], pa.int64()),
                    pa.array([p for p, _, _ in pending], pa.int64()),
                    pa.array([k for _, k, _ in pending]),
                ],
                names=["archive", "offset", "length", "page_id", "record_type"],
            )
            pending.clear()
            held = 0
            return batch

        for whole in batches:
            for i in range(0, whole.num_rows, 64):
                for row in whole.slice(i, 64).to_pylist():
                    record, kind = _record(row["page_id"], row["url"], row["html"], row["refers_to"], date)
                    pending.append((row["page_id"], kind, record))
                    held += len(record)
                    if held >= archive_bytes:
                        yield flush()
        if pending:
            yield flush()

    return rows.select("page_id", "url", "html", "refers_to").mapInArrow(run, INDEX)


def open_archive(data: bytes) -> tuple[object, int]:
    """A decoder with the archive's dictionary, and the offset of its first record."""
    import zstandard

    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        return zstandard.ZstdDecompressor(), 0
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])), 8 + size


def parse_record(stream: io.BufferedReader) -> dict | None:
    """The next record of a decompressed stream, None at its end."""
    line = stream.readline()
    if not line:
        return None
    if line.strip() != VERSION.encode():
        raise ValueError(f"no record begins with {line[:40]!r}")
    fields: dict[str, str] = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode().partition(": ")
        fields[name.lower().rstrip(":")] = value
    block = stream.read(int(fields["content-length"]))
    if stream.read(4) != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    page = lambda x: int(x[len("<urn:x-page:") : -1]) if x and x != "<urn:x-page:>" else None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (
        len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest
    ):
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    return {
        "page_id": page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri", ""),
        "record_type": kind,
        "refers_to": page(fields.get("warc-refers-to")),
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def records(data: bytes) -> Iterator[dict]:
    decoder, at = open_archive(data)
    source = io.BytesIO(data)
    source.seek(at)
    with decoder.stream_reader(source, read_across_frames=True) as plain:
        stream = io.BufferedReader(plain, 1 << 17)
        while (record := parse_record(stream)) is not None:
            yield record


def read_archives(spark: SparkSession, folder: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives that ``index`` names; payload digests are verified on the way."""
    names = index.select("archive").distinct()
    if names.isEmpty():  # no page, no archive, hence no folder
        return spark.createDataFrame([], RECORDS)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content").join(names, "archive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
            ]
        )
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for r in records(batch.column(1)[i].as_py()):
                    if not payloads:
                        r["payload"] = None
                    rows.append(r)
                    held += r["payload_bytes"]
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(run, RECORDS)
