"""WARC archives with one Zstandard frame per record and a dictionary in a leading skippable frame.

Equal payloads are stored once: digests are computed by Spark and grouped with a pre-aggregated
largest id; other records become revisits. Every task streams its records into archives of bounded
size in the shared folder, under names no other attempt uses, and returns what it finished; the
written list of archives is the commit, so files of lost or repeated attempts are never read.
The files are opened through the file system of their URI, not as local paths.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import chunks, settle
from caseflow.session import scratch_path

ARCHIVE_BYTES = 32 << 20
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
READ_BYTES = 64 << 10

# The skippable frame of a dictionary, the revisit profile, header names and lines.
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
CAPTURED = "2020-01-01T00:00:00Z"
NO_ID = "none"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """The bytes of a response record, or of a revisit of ``refers_to`` without the payload."""
    revisit = refers_to is not None
    block = HTTP_HEAD.format(len(payload)).encode() + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    lines.append(f"WARC-Record-ID: <urn:page:{NO_ID if page_id is None else page_id}>")
    if url is not None:
        # No control character may end a header line early.
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Date: {CAPTURED}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict[str, object]:
    """What a record says: ids as strings, type, digest, and for a response its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    own = headers["WARC-Record-ID"][len("<urn:page:") : -1]
    other = headers.get("WARC-Refers-To")
    return {
        "page_id": None if own == NO_ID else own,
        "url": headers.get("WARC-Target-URI"),
        "record_type": headers["WARC-Type"],
        "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": other and other[len("<urn:page:") : -1],
        "payload_bytes": size,
        "payload": payload if headers["WARC-Type"] == "response" else None,
    }


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from records; a few or uniform records serve as its content themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        content = b"".join(samples)[-DICTIONARY_BYTES:].ljust(8, b"\0")
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """One archive file: opened with the records its dictionary is built from."""

    def __init__(self, folder: str, samples: list[bytes]):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = pafs.FileSystem.from_uri(self.path)
        # The sample is bounded in number and bytes; a longer record gives its first part.
        share = SAMPLE_BYTES // max(1, len(samples))
        dictionary = train([s[: max(share, 64)] for s in samples])
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary).compress
        # No second compression after the extension.
        self.out = system.open_output_stream(path, compression=None)
        content = dictionary.as_bytes()
        self.out.write(DICTIONARY_MAGIC + len(content).to_bytes(4, "little") + content)
        self.records, self.size = 0, 8 + len(content)
        for data in samples:
            self.add(data)

    def add(self, data: bytes) -> None:
        frame = self.compress(data)
        self.out.write(frame)
        self.records += 1
        self.size += len(frame)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.size


def archive_all(records: Iterator[bytes], folder: str) -> Iterator[tuple[str, int, int]]:
    """Write the records to archives of bounded size; path, records and bytes of each."""
    archive, waiting, held = None, [], 0
    for data in records:
        if archive:
            archive.add(data)
        else:
            waiting.append(data)
            held += len(data)
            if len(waiting) >= SAMPLE_RECORDS or held >= 2 * SAMPLE_BYTES:
                archive, waiting, held = Archive(folder, waiting), [], 0
        if archive and archive.size >= ARCHIVE_BYTES:
            yield archive.close()
            archive = None
    if waiting:
        archive = Archive(folder, waiting)
    if archive:
        yield archive.close()


def frames(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    assert stream.read(4) == DICTIONARY_MAGIC, "no dictionary in front"
    content = stream.read(int.from_bytes(stream.read(4), "little"))
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    rest = stream.read(READ_BYTES)
    while rest:
        frame, pieces = reader.decompressobj(), []
        while True:
            pieces.append(frame.decompress(rest))
            rest = frame.unused_data
            if frame.eof:
                break
            rest = stream.read(READ_BYTES)
            if not rest:
                raise EOFError("archive ends inside a record")
        yield b"".join(pieces)
        rest = rest or stream.read(READ_BYTES)


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Write a record for each page; the list of archives: ``path, records, bytes``.

    Of pages with equal payloads those with the largest id are responses, the others revisit it;
    a null html is an empty payload. Rows that repeat both id and payload all stand as responses
    if that id is the largest. A null id is smaller than any other; if all are null, all are
    responses. A null url has no header, control characters in one are percent-encoded. An empty
    table gives no archives.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(
        pages[page_id].alias("_id"),
        pages[url].cast("string").alias("_url"),
        F.coalesce(pages[html].cast("string"), F.lit("")).alias("_html"),
    ).withColumn("_digest", F.sha1("_html"))
    heads = (
        rows.groupBy("_digest")
        .agg(F.max("_id").alias("head"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("_digest", "head")
    )
    sent = rows.join(heads, "_digest", "left").select(
        "_id",
        "_url",
        "_html",
        F.when(~F.col("_id").eqNullSafe(F.col("head")), F.col("head")).alias("_refers"),
    )
    schema = "path string, records long, bytes long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in chunks(batches, "_html"):
                texts = batch.column("_html").cast(pa.binary())
                for own, link, content, refers in zip(
                    *(batch.column(c) for c in ("_id", "_url")), texts, batch.column("_refers"), strict=True
                ):
                    payload = content.as_py()
                    yield record(
                        own.as_py(), link.as_py(), payload, payload_digest(payload), refers.as_py()
                    )

        # The folder exists only where the file system has folders at all.
        system, path = pafs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        for path, count, size in archive_all(records(), folder):
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())],
                ["path", "records", "bytes"],
            )

    return settle(sent.mapInArrow(write, schema), "archives")


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the listed archives: ids as strings, type, digests; ``payload`` if wanted.

    Digest and size of a response are computed from its payload as read; a revisit has those its
    record states. A damaged archive fails the job.
    """
    schema = (
        "page_id string, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to string"
    ) + (", payload binary" if payloads else "")
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("path").to_pylist():
                system, path = pafs.FileSystem.from_uri(file)
                with system.open_input_stream(path, compression=None) as stream:
                    held: list[dict] = []
                    for data in frames(stream):
                        parsed = parse_record(data)
                        if parsed["payload"] is not None:
                            parsed["payload_bytes"] = len(parsed["payload"])
                            parsed["payload_digest"] = payload_digest(parsed["payload"])
                        held.append(parsed)
                        if len(held) >= (100 if payloads else 2_000):
                            yield to_batch(held)
                            held = []
                    if held:
                        yield to_batch(held)

    def to_batch(held: list[dict]) -> pa.RecordBatch:
        kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [pa.array([h[n] for h in held], kinds.get(n, pa.string())) for n in names], names
        )

    # One archive is one unit of work: as many tasks as archives.
    return archives.repartition(max(1, archives.count())).mapInArrow(read, schema)
