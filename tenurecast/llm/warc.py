"""WARC archives, compressed record by record with a dictionary of their own.

A task cuts its rows into archives of bounded size. Each archive starts with a skippable
frame holding a Zstandard dictionary trained on records spread over that archive; every
record is a frame by itself, so one can be read without the others. Archives are written
under a name of their own and count once the manifest that Spark commits lists them, so a
lost executor leaves unlisted files and no double records.

Of records with equal payloads of ``REVISIT_BYTES`` or more the one with the largest page
id is the response, the others are revisits without a body that refer to it. Rows that
repeat that id are responses too. Null html is an empty payload, a null url no target. A
null page id is archived without a number and never referred to.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.llm.common import table
from tenurecast.session import new_path, staged

REVISIT_BYTES = 1000
#: Uncompressed bytes of an archive, about; bytes of its dictionary and of the records it learns from.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES = 8 << 20, 16 << 10, 1 << 20
LEVEL = 3
# Fixed value: the magic number of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"


def record(page_id, url, kind: str, digest: str, payload: bytes, size: int, refers_to) -> bytes:
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        safe = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"X-Payload-Length: {size}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """Trained on records taken evenly from all; their plain text where too few to train."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    samples = [r[: SAMPLE_BYTES // 8] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _usable(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def archive(records: list[bytes]) -> bytes:
    raw = dictionary(records)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_usable(raw), write_content_size=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw + b"".join(packer.compress(r) for r in records)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive."""
    magic, size = struct.unpack("<II", data[:8])
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not start with a dictionary")
    unpacker = zstandard.ZstdDecompressor(dict_data=_usable(data[8 : 8 + size]))
    stream = io.BufferedReader(unpacker.stream_reader(io.BytesIO(data[8 + size :]), read_across_frames=True), 1 << 18)
    while stream.readline():
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        stream.read(4)
        yield headers, block


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        kept: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            path = f"{root}/{uuid.uuid4().hex}.warc.zst"
            with system.open_output_stream(path) as out:
                out.write(archive(kept))
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(kept)]})

        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, html, refers_to = (batch.column(c)[at].as_py() for c in ("page_id", "url", "html", "refers_to"))
                payload = (html or "").encode()
                digest = hashlib.sha1(payload).hexdigest()
                kind = "response" if refers_to is None else "revisit"
                kept.append(record(page_id, url, kind, digest, payload if refers_to is None else b"", len(payload), refers_to))
                size += len(kept[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    kept, size = [], 0
        if kept:
            yield close()

    return run


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _read(folder: str, payloads: bool):
    number = lambda name: int(name[10:-1]) if name and name != "<urn:page:>" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_stream(path) as source:
                    data = source.read()
                rows = []
                for head, block in records(data):
                    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                    if kind == "response" and (hashlib.sha1(block).hexdigest() != digest or len(block) != int(head["X-Payload-Length"])):
                        raise ValueError(f"{path}: a payload does not match its digest")
                    rows.append((number(head["WARC-Record-ID"]), int(head["X-Payload-Length"]), digest, kind, number(head.get("WARC-Refers-To")), head.get("WARC-Target-URI"), block if payloads else None))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
                names = [c.split()[0] for c in _READ.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return run


def write_warc(pages: DataFrame, folder: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Archive all pages below ``folder``, a place all executors reach; returns the manifest."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    body = F.coalesce("html", F.lit("")).cast("binary")
    digests = pages.select("page_id", F.sha1(body).alias("digest"), F.octet_length(body).alias("size")).filter(F.col("size") >= least)
    copies = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    refers = digests.join(copies, "digest").filter("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()
    # A page id may repeat with another payload, so the digest is part of the key.
    keyed = pages.withColumn("digest", F.sha1(body))
    marked = keyed.join(refers.hint("merge"), ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")
    return staged(marked.mapInArrow(_write(folder), "path string, records long"), "warc-manifest")


def read_warc(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives listed."""
    spread = manifest.select("path").repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(_read(folder, payloads), _READ)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    manifest = write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(manifest, folder, payloads=False).drop("url", "payload")


OP3_SQL = """
with p as (
    select page_id, encode(coalesce(html, '')) as body, sha1(coalesce(html, '')) as digest from pages
), r as (
    select digest, max(page_id) as response from p where octet_length(body) >= 1000 group by digest
)
select page_id, octet_length(body)::bigint as payload_bytes, p.digest as payload_digest,
    case when page_id < response then 'revisit' else 'response' end as record_type,
    case when page_id < response then response end as refers_to
from p left join r on p.digest = r.digest and octet_length(body) >= 1000
"""
