"""WARC records in Zstandard archives (operator 9): writer and reader.

An archive is one binary value: a skippable frame that holds the dictionary, then one frame for each record. The
archives are rows of a table in the shared folder, a few hundred kilobytes each, so that tasks write and read them
without knowing of each other and a lost task is simply run again. The reader loads the dictionary from the leading
frame, decodes frame by frame and checks magic numbers, content sizes, header fields, block lengths and digests.

Which record holds a payload is found from digests alone: the largest page_id of each repeated digest, by an aggregation
that is combined before its shuffle; payloads are not shuffled unless there are too many repeated digests to broadcast.

Defined results: a null page is an empty payload; a null url becomes the record's own name as target; a null page_id is
never the response among copies with ids; repeated rows of the largest id are all responses; a very long payload is held by one
task several times (as text, record and frame); columns besides page_id, url and html are not archived; an empty table gives no
archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import sized, table
from countertide.llm.registry import query
from countertide.plans.shared import freeze

#: Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 512 << 10
DICTIONARY_BYTES = 8 << 10
SAMPLE_BYTES = 256 << 10
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_originals(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` with ``_refers_to``: the largest page_id with an equal payload of ``least`` bytes or more, if another."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.withColumn("_sha1", F.sha1(payload))
    repeated = freeze(
        keyed.filter(F.octet_length(payload) >= least)
        .groupBy(F.col("_sha1").alias("_of"))
        .agg(F.max("page_id").alias("_original"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n"),
        "repeated_payloads",
    )
    joined = keyed.join(sized(repeated), F.col("_sha1") == F.col("_of"), "left")
    return joined.withColumn(
        "_refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_original")), F.col("_original"))
    ).drop("_sha1", "_of", "_original")


def _name(page_id) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url: str | None, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """One record; a revisit keeps the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    target = re.sub(r"[\x00-\x20<>\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else _name(page_id)[1:-1]
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": "sha1:" + payload_digest(payload),
        "WARC-Block-Digest": "sha1:" + payload_digest(block),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from a task's first records, ``SAMPLE_BYTES`` at most; raw content where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples) or VERSION.encode())[:DICTIONARY_BYTES].ljust(8, b" ")


def _archive_writer(batches):
    """Archives of the rows of one partition."""
    dictionary, compressor, frames, held = b"", None, [], 0
    waiting: list[bytes] = []

    def started():
        nonlocal dictionary, compressor
        dictionary = train_dictionary(waiting)
        compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True, write_content_size=True)

    def closed():
        nonlocal frames, held
        content = struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary + b"".join(frames)
        out = pa.RecordBatch.from_arrays([pa.array([len(frames)], pa.int64()), pa.array([content], pa.binary())], names=["records", "content"])
        frames, held = [], 0
        return out

    def add(one: bytes):
        nonlocal held
        frames.append(compressor.compress(one))
        held += len(frames[-1])
        return held >= ARCHIVE_BYTES

    sampled = 0
    for batch in batches:
        columns = [batch.column(n) for n in ("page_id", "url", "html", "_refers_to")]
        for k in range(batch.num_rows):
            page_id, url, html, refers_to = (c[k].as_py() for c in columns)
            one = record(page_id, url, (html or "").encode(), refers_to)
            if compressor is None:
                waiting.append(one)
                sampled += len(one)
                if sampled < SAMPLE_BYTES:
                    continue
                started()
                for w in waiting:
                    if add(w):
                        yield closed()
                waiting = []
            elif add(one):
                yield closed()
    if compressor is None and waiting:
        started()
        for w in waiting:
            if add(w):
                yield closed()
    if frames:
        yield closed()


def write_archives(pages: DataFrame) -> DataFrame:
    """Archives (``records``, ``content``) of ``pages`` (page_id, url, html, _refers_to), written to the shared folder."""
    source = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), "_refers_to")
    return freeze(source.mapInArrow(_archive_writer, "records bigint, content binary"), "warc_archives")


def export_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive to a file of its own under ``folder`` (a URI that Arrow can open); paths and sizes.

    File names are digests of the content: a task that is run again writes the same files again.
    """

    def put(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            paths, sizes = [], []
            for content in batch.column("content"):
                data = content.as_py()
                paths.append(f"{base}/{hashlib.sha1(data).hexdigest()}.warc.zst")
                sizes.append(len(data))
                with store.open_output_stream(paths[-1], compression=None) as out:
                    out.write(data)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return archives.select("content").mapInArrow(put, "path string, bytes bigint")


class BadArchive(ValueError):
    """An archive that breaks its format."""


def frames_of(content: bytes):
    """Decoded records of an archive, one for each frame."""
    if len(content) < 8:
        raise BadArchive("no leading frame")
    magic, size = struct.unpack_from("<II", content)
    if magic != SKIPPABLE_MAGIC or len(content) < 8 + size:
        raise BadArchive("the leading frame holds no dictionary")
    dictionary = content[8 : 8 + size]
    if struct.unpack_from("<I", dictionary)[0] == FRAME_MAGIC:  # a dictionary may be compressed itself
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    view, at = memoryview(content), 8 + size
    while at < len(content):
        if len(content) - at < 4 or struct.unpack_from("<I", content, at)[0] != FRAME_MAGIC:
            raise BadArchive(f"no frame at byte {at}")
        expected = zstandard.get_frame_parameters(view[at : at + 18]).content_size
        one, parts, step = decompressor.decompressobj(), [], 16 << 10
        while not one.eof:
            if at >= len(content):
                raise BadArchive("the last frame is cut off")
            chunk = view[at : at + step]
            try:
                parts.append(one.decompress(chunk))
            except zstandard.ZstdError as bad:
                raise BadArchive(str(bad)) from bad
            at += len(chunk) - len(one.unused_data)
        data = b"".join(parts)
        if len(data) != expected:
            raise BadArchive("a frame's content has another size than its header says")
        yield data


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record, lengths and block digest checked."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise BadArchive("no record header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#-'*+\-.^-z|~0-9A-Z]+", name) or name.lower() in fields:
            raise BadArchive(f"bad header line {line[:60]!r}")
        fields[name.lower()] = value.strip()
    for needed in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if needed not in fields:
            raise BadArchive(f"{needed} is missing")
    if not fields["content-length"].isdigit():
        raise BadArchive("bad length")
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise BadArchive("the block has another length than its header says")
    block = rest[:n]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != "sha1:" + payload_digest(block):
        raise BadArchive("the block has another digest than its header says")
    return fields, block


def read_page(data: bytes) -> dict:
    """Page of a response or revisit record."""
    fields, block = parse_record(data)
    kind = fields["warc-type"]
    head, found, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"\r\nContent-Length: (\d+)", head)
    if kind not in ("response", "revisit") or not found or not length:
        raise BadArchive("neither response nor revisit")
    if kind == "response" and (len(payload) != int(length[1]) or "sha1:" + payload_digest(payload) != fields["warc-payload-digest"]):
        raise BadArchive("the payload differs from its header")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise BadArchive("a revisit with payload or without original")
    number = re.compile(r"<urn:page:(-?\d+)>")
    own, other = number.fullmatch(fields["warc-record-id"]), number.fullmatch(fields.get("warc-refers-to", ""))
    return {
        "page_id": int(own[1]) if own else None,
        "url": fields["warc-target-uri"],
        "payload_bytes": int(length[1]),
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        "record_type": kind,
        "refers_to": int(other[1]) if other else None,
        "payload": payload if kind == "response" else None,
    }


READ_SCHEMA = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _archive_reader(with_payload: bool):
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    if with_payload:
        kinds["payload"] = pa.binary()
    schema = pa.schema(list(kinds.items()))

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = [read_page(x) for x in frames_of(content.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], schema=schema)

    return read


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of archives in a column ``content``, as ``write_archives`` or Spark's ``binaryFile`` source give them."""
    return archives.select("content").mapInArrow(_archive_reader(with_payload), READ_SCHEMA + ", payload binary" * with_payload)


@query("op9_warc")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return read_archives(write_archives(with_originals(pages))).drop("url")
