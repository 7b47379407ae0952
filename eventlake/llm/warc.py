"""WARC archives: write one gzip member per record, read them back sequentially.

Writing: each task streams its pages into its own archive files on the shared file system
and returns one manifest row per finished file.  A file counts only if its manifest row
does, so the leavings of a lost or repeated task attempt are never read.  Reading: each
file is one sequential pass that inflates in fixed-size chunks (never a whole file), frames
records by Content-Length and checks block and payload digests.

Of records with equal payloads of at least ``min_bytes`` bytes, those with the smallest
page id are ``response`` records and the others ``revisit`` records that refer to it
(repeated rows of the smallest id are all ``response``).  A null html is an empty payload; a
null page id sorts last and is written without a page id; a null url has an empty target.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm.common import bounded_batches, cut, shared_path, table

CHUNK = 1 << 20
#: Fixed date of the archive records; a run's own date is a parameter of write_archives.
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 3) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def one_line(value) -> str:
    return "" if value is None else " ".join(str(value).split())


def response_record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """A ``response`` record, or a ``revisit`` with an empty body when ``refers_to`` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Date", date),
               ("WARC-Target-URI", one_line(url)), ("WARC-Page-ID", one_line(page_id)),
               ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)), ("WARC-Payload-Bytes", str(len(payload))),
               ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To-Page-ID", one_line(refers_to))]
    return record_bytes(headers, block)


def open_fs(uri: str):
    """(file system, path) of a shared folder's URI or plain path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def members(chunks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """One iterator of inflated chunks per gzip member; members are consumed in order."""
    state = {"rest": b""}

    def next_chunk() -> bytes:
        state["rest"] = state["rest"] or next(chunks, b"")
        return state["rest"]

    while next_chunk():
        inflate = zlib.decompressobj(31)

        def one():
            while not inflate.eof:
                data = next_chunk()
                if not data:
                    raise ValueError("archive ends inside a gzip member")
                state["rest"] = b""
                out = inflate.decompress(data, CHUNK)
                while out or inflate.unconsumed_tail:
                    yield out
                    out = inflate.decompress(inflate.unconsumed_tail, CHUNK) if inflate.unconsumed_tail else b""
            state["rest"] = inflate.unused_data

        yield one()


def read_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; framing and block digests are verified."""
    for member in members(chunks):
        data = b""
        while b"\r\n\r\n" not in data:
            piece = next(member, None)
            if piece is None:
                raise ValueError("record header is cut off")
            data += piece
        head, _, body = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        size, parts, got = int(headers["content-length"]), [body], len(body)
        for piece in member:
            parts.append(piece)
            got += len(piece)
        if got != size + 4:
            raise ValueError(f"Content-Length {size}, but the member holds {got - 4}")
        whole = b"".join(parts)
        if whole[size:] != b"\r\n\r\n":
            raise ValueError("record does not end in two line ends")
        block = whole[:size]
        if headers.get("warc-block-digest", "sha1:" + base32_sha1(block)) != "sha1:" + base32_sha1(block):
            raise ValueError("block digest differs")
        yield headers, block


def plan_records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id") -> DataFrame:
    """Pages with ``refers_to`` (null: response).  Only digests of payloads that occur more
    than once are joined back; the digest side has one row per payload."""
    own = pages.select(F.col(id_col).alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    own = own.withColumn("digest", F.sha1("payload"))
    shared = (own.where(F.length("payload") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null"))
    to = F.when((F.length("payload") >= min_bytes) & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))), F.col("first"))
    return own.join(shared, "digest", "left").select("page_id", "url", "payload", to.alias("refers_to"))


def write_archives(records: DataFrame, folder: str, file_bytes: int = 128 << 20, date: str = DATE) -> DataFrame:
    """(path, records) of each archive file, one or more per task, none above about ``file_bytes``."""
    def run(batches):
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, name, count, size, number = None, "", 0, 0, 0
        for batch in batches:
            for page_id, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{stem}-{number:04d}.warc.gz"
                    out, count, size, number = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0, number + 1
                member = gzip_member(response_record(page_id, url, payload, refers, date))
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [name], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "records": pa.array([count], pa.int64())})

    return records.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "path string, records bigint")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the files named in the manifest.

    A ``response`` payload is checked against its digest; a file with another number of
    records than its manifest row says fails the job."""
    def run(batches):
        fs, root = open_fs(folder)
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_stream(f"{root}/{path}", compression=None) as stream:
                    rows, total = [], 0
                    for headers, block in read_records(iter(lambda: stream.read(CHUNK), b"")):
                        total += 1
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        size = int(headers["warc-payload-bytes"])
                        kind, payload = headers["warc-type"], None
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if len(payload) != size or base32_sha1(payload) != digest:
                                raise ValueError(f"payload digest differs in {path}")
                        number = headers["warc-page-id"]
                        refers = headers.get("warc-refers-to-page-id")
                        rows.append((int(number) if number else None, headers["warc-target-uri"], size, digest, kind,
                                     int(refers) if refers else None, payload))
                        if len(rows) >= 500:
                            yield as_batch(rows)
                            rows = []
                    if total != expected:
                        raise ValueError(f"{path} holds {total} records, its manifest says {expected}")
                    if rows:
                        yield as_batch(rows)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return manifest.mapInArrow(run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
                                    "record_type string, refers_to bigint, payload binary")


def round_trip(pages: DataFrame, min_bytes: int = 0, file_bytes: int = 128 << 20) -> DataFrame:
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = shared_path(spark, "warc")
    manifest = cut(spark, write_archives(plan_records(pages, min_bytes), folder, file_bytes), "warc-manifest")
    files = max(1, manifest.count())
    return read_archives(manifest.repartition(files, "path"), folder)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    return round_trip(table(spark, sf_dir, "pages")).drop("payload", "url")
