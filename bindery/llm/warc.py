"""Archives of web records, compressed with dictionaries of their own.

An archive is a file ``.warc.zst``: a skippable frame that holds a Zstandard dictionary,
then every record as a frame of its own, compressed with that dictionary. So one record
can be read by its place alone, as can the whole file without anything beside it. The
dictionary of an archive is built from its own records, all of them; an archive ends at a
bounded number of bytes, so a task holds no more than that and its largest record.

Records with equal payloads are one response and revisits that refer to it. Which is
which is found on digests; page content moves once, to the task that archives it.

Files are named by what they hold and written under another name first, so a repeated
task or one that runs twice leaves the same files.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stored

#: Magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: First bytes of a structured Zstandard dictionary.
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
#: Bytes of records after which an archive is closed, and of its dictionary at most.
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
#: Bytes of payloads of a part, about, where parts are more than shuffle partitions.
PART_BYTES = 64 << 20
LEVEL = 3
#: Salts over which records of one payload are spread.
SALTS = 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

KEY = T.StringType()
READ = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("key", KEY),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", KEY),
        T.StructField("payload", T.BinaryType()),
    ]
)
WRITTEN = "archive string, key string, start long, length long"


def one_line(value: str) -> str:
    """A header's value: control characters, which would end it, are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value).strip()


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_bytes(
    key: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str
) -> bytes:
    """A response, or a revisit if it refers to the key of one. A revisit's block is the
    response's head alone, which gives the payload's length."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if refers_to is not None else head + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{key}\n{url}\n{digest}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    if key is not None:
        lines.append(f"X-Record-Key: {one_line(key)}")
    if refers_to is not None:
        lines.append(f"WARC-Profile: {PROFILE}")
        lines.append(f"X-Refers-To-Key: {one_line(refers_to)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained(records: list[bytes], most: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the records, at most a twentieth of their size; where they are too
    few to train one, their last bytes."""
    size = max(256, min(most, sum(map(len, records)) // 20))
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def loaded(dictionary: bytes) -> zstandard.ZstdCompressionDict:
    structured = dictionary.startswith(DICTIONARY_MAGIC)
    kind = zstandard.DICT_TYPE_FULLDICT if structured else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(dictionary, dict_type=kind)


@dataclass
class Archive:
    """An archive's bytes and where its records are."""

    content: bytes
    starts: list[int]
    lengths: list[int]


def archive_of(records: list[bytes], level: int = LEVEL) -> Archive:
    """The file that holds the records."""
    dictionary = trained(records)
    compressor = zstandard.ZstdCompressor(
        level=level, dict_data=loaded(dictionary), write_checksum=True, write_content_size=True
    )
    parts = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary]
    starts, lengths, at = [], [], len(parts[0])
    for record in records:
        frame = compressor.compress(record)
        parts.append(frame)
        starts.append(at)
        lengths.append(len(frame))
        at += len(frame)
    return Archive(b"".join(parts), starts, lengths)


def dictionary_of(content: bytes) -> tuple[bytes, int]:
    """The dictionary of an archive and the place of its first record."""
    magic, size = struct.unpack_from("<II", content) if len(content) >= 8 else (0, 0)
    if magic != DICTIONARY_FRAME or len(content) < 8 + size:
        raise ValueError("the archive does not begin with a dictionary")
    return content[8 : 8 + size], 8 + size


def record_at(content: bytes, start: int, length: int) -> bytes:
    """One record by its place."""
    dictionary, _ = dictionary_of(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=loaded(dictionary))
    return decompressor.decompress(content[start : start + length])


def headers(lines: list[str]) -> dict[str, str]:
    parted = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in parted}


def read_head(stream) -> list[str]:
    """Lines up to the empty one; none at the end of the stream."""
    lines = []
    while line := stream.readline():
        line = line.rstrip(b"\r\n").decode()
        if not line:
            break
        lines.append(line)
    return lines


def records_of(content: bytes) -> Iterator[dict]:
    """All records of an archive, each checked against its digest if it has a payload."""
    dictionary, at = dictionary_of(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=loaded(dictionary))
    raw = decompressor.stream_reader(memoryview(content)[at:], read_across_frames=True)
    stream = io.BufferedReader(raw, 1 << 16)
    while lines := read_head(stream):
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not begin with its version")
        named = headers(lines[1:])
        size = int(named["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        head, _, payload = block.partition(b"\r\n\r\n")
        declared = headers(head.decode().split("\r\n")[1:])
        kind = named["warc-type"]
        digest = named["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and base32(hashlib.sha1(payload).digest()) != digest:
            raise ValueError(f"payload of {named['warc-record-id']} differs from its digest")
        yield {
            "record_id": named["warc-record-id"],
            "key": named.get("x-record-key"),
            "url": named.get("warc-target-uri"),
            "record_type": kind,
            "payload_bytes": len(payload) if kind == "response" else int(declared["content-length"]),
            "payload_digest": digest,
            "refers_to": named.get("x-refers-to-key"),
            "payload": payload if kind == "response" else None,
        }


def payload_keys(pages: DataFrame, key: str) -> DataFrame:
    """``_id, _sha1, _bytes, _salt`` of each row, as a stored table."""
    payload = payload_of("html")
    return stored(
        pages.select(
            F.col(key).alias("_id"),
            F.sha1(payload).alias("_sha1"),
            F.length(payload).cast("long").alias("_bytes"),
            F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int").alias("_salt"),
        ),
        "payloads",
    )


def payload_of(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def references(keys: DataFrame, min_bytes: int) -> DataFrame:
    """``_id, _sha1, _first``: rows whose payload of at least ``min_bytes`` has a row of a
    smaller key, the smallest of which is ``_first``.

    Minima are taken by salt first and each salt gets the result, so that a payload of
    very many rows meets its result in as many tasks.
    """
    part = (
        keys.where(F.col("_bytes") >= min_bytes)
        .groupBy("_sha1", "_salt")
        .agg(F.min("_id").alias("_least"), F.count("*").alias("_n"))
    )
    first = (
        part.groupBy("_sha1")
        .agg(
            F.min("_least").alias("_first"),
            F.sum("_n").alias("_rows"),
            F.collect_set("_salt").alias("_salts"),
        )
        .where("_rows > 1")
        .select("_sha1", F.explode("_salts").alias("_salt"), "_first")
    )
    return (
        keys.join(first, ["_sha1", "_salt"])
        .where(~F.col("_id").eqNullSafe(F.col("_first")))
        .select("_id", "_sha1", "_first")
        .distinct()
    )


def save(folder: str, name: str, content: bytes) -> None:
    """Write a file whole or not at all."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(content)
    system.move(part, f"{path}/{name}")


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archive all pages below ``folder``; returns ``archive, key, start, length`` of each
    record, a table that has to be evaluated for the files to be written.

    ``pages`` have ``url`` and ``html``, whose UTF-8 is the payload, and ``key``, a column
    of any type that sorts. Of rows with equal payloads of at least ``min_bytes`` that of
    the smallest key is the response and the others are revisits of it; shorter payloads
    are all responses. Of repeated rows of one key and payload, the first is the response
    if the key is the smallest, and the others revisit it. A null ``html`` is an empty
    payload, a null URL or key a record without it. Null keys come last; if a payload
    has no other key, its rows are all responses. An empty table gives no file. Other
    columns are ignored. Payloads are equal if their SHA-1 is.

    Records are dealt into parts by their keys. A part gets one row for each revisit's
    reference, then the pages, so that content moves once and meets no join.
    """
    keys = payload_keys(pages, key)
    total = keys.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    least = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(least, -(-total // PART_BYTES))

    def placed(rows: DataFrame, first: Column, url: Column, payload: Column) -> DataFrame:
        group = F.pmod(F.xxhash64("_id", "_sha1"), F.lit(groups)).cast("int")
        return rows.select(
            group.alias("_group"),
            F.col("_id").cast("string").alias("_key"),
            "_sha1",
            first.cast("string").alias("_refers"),
            url.alias("_url"),
            payload.alias("_payload"),
        )

    content = pages.select(
        F.col(key).alias("_id"), F.col("url").alias("_address"), payload_of("html").alias("_content")
    ).withColumn("_sha1", F.sha1("_content"))
    dealt = (
        placed(references(keys, min_bytes), F.col("_first"), F.lit(None).cast("string"), F.lit(None).cast("binary"))
        .unionByName(placed(content, F.lit(None), F.col("_address"), F.col("_content")))
        .repartition(groups, "_group")
        .sortWithinPartitions("_group", "_key", "_sha1", F.asc_nulls_last("_refers"), "_url")
    )

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[str | None] = []
        records: list[bytes] = []
        held = number = 0
        group = last = None
        reference: tuple = (None, None, None)

        def close() -> pa.RecordBatch:
            name = f"{group:06d}-{number:05d}.warc.zst"
            made = archive_of(records)
            save(folder, name, made.content)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(keys), pa.string()),
                    pa.array(keys, pa.string()),
                    pa.array(made.starts, pa.int64()),
                    pa.array(made.lengths, pa.int64()),
                ],
                ["archive", "key", "start", "length"],
            )

        for batch in batches:
            columns = [batch.column(c) for c in ("_group", "_key", "_sha1", "_refers", "_url", "_payload")]
            for values in zip(*columns, strict=True):
                own, row_key, sha1, refers, url, payload = (v.as_py() for v in values)
                if payload is None:  # a reference, for the pages that follow
                    reference = (row_key, sha1, refers)
                    continue
                if records and (own != group or held >= archive_bytes):
                    yield close()
                    number = 0 if own != group else number + 1
                    keys, records, held = [], [], 0
                group = own
                if reference[:2] == (row_key, sha1):
                    refers = reference[2]
                elif (row_key, sha1) == last and row_key is not None and len(payload) >= min_bytes:
                    refers = row_key  # a repeated row follows the one that it repeats
                last = (row_key, sha1)
                record = record_bytes(
                    row_key, url, payload, base32(bytes.fromhex(sha1)), refers, date
                )
                keys.append(row_key)
                records.append(record)
                held += len(record)
        if records:
            yield close()

    return dealt.mapInArrow(archive, WRITTEN)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all archives below a folder: ``record_id, key, url, record_type,
    payload_bytes, payload_digest, refers_to, payload`` (null for revisits).

    Every response's payload is compared with its digest; a file that is damaged fails
    the job."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                (f.name, pa.binary() if f.name == "payload" else
                 pa.int64() if f.name == "payload_bytes" else pa.string())
                for f in READ
            ]
        )
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for row in records_of(content.as_py()):
                    rows.append(row)
                    held += row["payload_bytes"]
                    if held >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("content").mapInArrow(parse, READ)


SQL = """WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS digest
  FROM pages),
coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(digest, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER,
      1)), '') AS payload_digest
  FROM hashed),
firsts AS (
  SELECT *, min(page_id) OVER same AS first_id, row_number() OVER (same ORDER BY page_id) AS place
  FROM coded WINDOW same AS (PARTITION BY payload_digest, payload_bytes)),
judged AS (SELECT *, place > 1 AND first_id IS NOT NULL AS again FROM firsts)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM judged"""
