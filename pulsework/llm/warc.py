"""WARC archives compressed with a dictionary of their own.

Each archive holds a Zstandard dictionary, built from its records, in a leading skippable frame;
every record is one frame compressed with it. A record of equal payload as an earlier page is a
revisit that names that page's record and carries no payload.

Defined results: a null payload is empty; a null id is always a response and is never referred to;
rows that repeat the smallest id of a payload are all responses; an empty table makes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework.llm.shared_files import open_path, write_new
from pulsework.llm.text import by_bytes
from pulsework.session import new_work_dir

# Fixed values of the formats: the skippable frame for dictionaries, and the profile of revisits.
_SKIPPABLE = 0x184D2A5D
_DICTIONARY = b"\x37\xa4\x30\xec"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL = 6


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def format_record(page: str | None, url: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps digest and size of the payload it leaves out."""
    name = f"<urn:page:{page}>" if page is not None else f"<urn:sha256:{hashlib.sha256(url.encode() + payload).hexdigest()}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Target-URI: {''.join(url.split())}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = payload if refers_to is None else b""
    head += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("the record does not have its stated length")
    return fields, rest[:size]


def build_dictionary(records: list[bytes], dictionary_bytes: int, sample_bytes: int) -> bytes:
    """A dictionary from records evenly spread over the archive, at most ``sample_bytes`` of them.

    Too little to learn from gives a dictionary of plain content: the first records themselves.
    """
    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    samples = [r[: dictionary_bytes * 2] for r in records[::step]]
    try:
        return zstandard.train_dictionary(dictionary_bytes, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:dictionary_bytes]


def compressed(records: list[bytes], dictionary_bytes: int, sample_bytes: int) -> Iterator[bytes]:
    raw = build_dictionary(records, dictionary_bytes, sample_bytes)
    yield struct.pack("<II", _SKIPPABLE, len(raw)) + raw
    codec = zstandard.ZstdCompressor(level=_LEVEL, dict_data=_dictionary(raw))
    for record in records:
        yield codec.compress(record)


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    kind = zstandard.DICT_TYPE_FULLDICT if raw.startswith(_DICTIONARY) else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(raw, dict_type=kind)


def read_records(uri: str, at_once: int = 1 << 16) -> Iterator[bytes]:
    """The records of an archive, one after the other; only one is in memory."""
    system, path = open_path(uri)
    with system.open_input_stream(path) as file:
        magic, size = struct.unpack("<II", file.read(8))
        if magic != _SKIPPABLE:
            raise ValueError(f"{uri} does not begin with a dictionary")
        codec = zstandard.ZstdDecompressor(dict_data=_dictionary(file.read(size)))
        rest = file.read(at_once)
        while rest:
            frame, parts = codec.decompressobj(), []
            while True:
                parts.append(frame.decompress(rest))
                if frame.eof:
                    rest = frame.unused_data or file.read(at_once)
                    break
                rest = file.read(at_once)
                if not rest:
                    raise ValueError(f"{uri} ends within a record")
            yield b"".join(parts)


def with_revisits(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """``refers_to``: for all but the smallest id among equal payloads, that id.

    Payloads are told apart by SHA-256 and length. Counting combines before the shuffle, and only
    digests that occur more than once are joined back.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select("*", F.sha2(payload, 256).alias("_digest"), F.length(payload).alias("_size"))
    firsts = (
        rows.filter(F.col("_size") >= least_bytes)
        .groupBy("_digest", "_size")
        .agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_times"))
        .filter(F.col("_times") > 1)
        .drop("_times")
    )
    refers = F.when(F.col(id_col) != F.col("_first"), F.col("_first"))
    return rows.join(firsts, ["_digest", "_size"], "left").withColumn("refers_to", refers).drop("_digest", "_size", "_first")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    archive_bytes: int = 24 << 20,
    dictionary_bytes: int = 32 << 10,
    sample_bytes: int = 2 << 20,
    date: str = "1970-01-01T00:00:00Z",
) -> str:
    """Write all pages as archives below ``folder``; returns the path of the manifest that lists them.

    A task closes an archive once its records exceed ``archive_bytes`` before compression.
    """
    slim = pages.select(
        F.col(id_col).alias("page"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    )
    rows = with_revisits(slim, "page", "payload", least_bytes).select(
        F.col("page").cast("string"), "url", "payload", F.col("refers_to").cast("string")
    )

    def run(batches) -> Iterator[pa.RecordBatch]:
        stem, number, records, size = f"part-{TaskContext.get().partitionId():06d}", 0, [], 0

        def close() -> pa.RecordBatch:
            uri = write_new(folder, f"{stem}-{number:04d}", ".warc.zst", compressed(records, dictionary_bytes, sample_bytes))
            return pa.record_batch([pa.array([uri]), pa.array([len(records)], pa.int64())], ["archive", "n_records"])

        for batch in by_bytes(batches, "payload"):
            for page, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns)):
                records.append(format_record(page, url, payload.encode(), refers, date))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield close()
                    number, records, size = number + 1, [], 0
        if records:
            yield close()

    manifest = f"{folder}/manifest"
    rows.mapInArrow(run, "archive string, n_records long").write.parquet(manifest)
    return manifest


def read_archives(spark: SparkSession, manifest: str, most_tasks: int = 10_000) -> DataFrame:
    """All records of the archives in the manifest, their digests checked against the payloads.

    Columns: ``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload_bytes``,
    ``payload_digest``, ``payload`` (null for revisits).
    """
    archives = spark.read.parquet(manifest).select("archive")
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]

    def rows_of(uri: str) -> Iterator[tuple]:
        for raw in read_records(uri):
            fields, payload = parse_record(raw)
            kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
            size = int(fields["x-payload-length"])
            if kind == "response" and (payload_digest(payload) != digest or len(payload) != size):
                raise ValueError(f"{uri}: a payload does not have its digest")
            page, refers = (
                name[len("<urn:page:") : -1] if name.startswith("<urn:page:") else None
                for name in (fields["warc-record-id"], fields.get("warc-refers-to", ""))
            )
            own = payload if kind == "response" else None
            yield page, fields["warc-target-uri"], kind, refers, size, digest, own

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                block, size = [], 0
                for row in rows_of(uri):
                    block.append(row)
                    size += row[4]
                    if size > 4 << 20 or len(block) == 5_000:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*block), kinds)], names)
                        block, size = [], 0
                if block:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*block), kinds)], names)

    # A count of archives, so that each task reads about one; adaptive execution would join them all.
    tasks = max(1, min(archives.count(), most_tasks))
    return archives.repartition(tasks).mapInArrow(
        run,
        "page_id string, url string, record_type string, refers_to string, payload_bytes long, "
        "payload_digest string, payload binary",
    )


def new_archive_folder(spark: SparkSession) -> str:
    return new_work_dir(spark, "warc")
