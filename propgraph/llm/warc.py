"""WARC archives in Zstandard: a writer, and a reader that validates what it reads.

An archive begins with a skippable frame that holds the dictionary; then comes one frame per record, so that a reader can
start at any record it knows the place of. Records with equal payloads are written once, as a ``response``; the others are
``revisit`` records that name it. Archives have a bounded size; each is written by one task under a name of its own, and only
the archives that finished tasks report are read, so a task that is run again leaves nothing that counts.

Archives made elsewhere can be read too: versions 1.0 and 1.1, payloads within HTTP messages, digests of other kinds or none.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.llm.common import rows_mapper, stored
from propgraph.session import scratch_path

#: Payloads shorter than this are never revisits.
SMALLEST_REVISIT = 100
#: Bytes of records before compression in one archive.
ARCHIVE_BYTES = 32 << 20
#: Size of a dictionary, and bytes of records it is trained on; an archive's first records serve as its sample.
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 2 << 20
LEVEL = 3

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
READ_VERSIONS = (b"WARC/1.0", VERSION)
RECORD_TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
DATE = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that does not hold what it says."""


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    """The page that a record is named after; none for ``null`` and for names made elsewhere."""
    found = re.fullmatch(r"<urn:x-page:(-?[0-9]+)>", name)
    return int(found[1]) if found else None


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record: headers, a blank line, the payload (none for a revisit), two line ends."""
    block = b"" if revisit else payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", record_name(refers_to)))
    headers.append(("Content-Type", "text/html; charset=utf-8"))
    headers.append(("Content-Length", str(len(block))))
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), b"", b""]
    return b"\r\n".join(lines) + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary for such records, or no bytes where they are too few or too small to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archive(records: list[bytes]) -> bytes:
    """An archive of records: the dictionary, itself compressed, in a skippable frame, then a frame per record."""
    sample, size = [], 0
    for record in records:
        sample.append(record[: DICTIONARY_BYTES * 4])
        size += len(sample[-1])
        if size >= SAMPLE_BYTES:
            break
    data = train_dictionary(sample)
    head = zstandard.ZstdCompressor(level=LEVEL).compress(data) if data else b""
    dictionary = zstandard.ZstdCompressionDict(data) if data else None
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    frames = [compressor.compress(record) for record in records]
    return b"".join([DICTIONARY_MAGIC.to_bytes(4, "little"), len(head).to_bytes(4, "little"), head, *frames])


def read_archive(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one from each frame. Raises ``WarcError`` where the archive is cut or broken."""
    dictionary, at = None, 0
    if len(archive) >= 8 and int.from_bytes(archive[:4], "little") == DICTIONARY_MAGIC:
        at = 8 + int.from_bytes(archive[4:8], "little")
        if at > len(archive):
            raise WarcError("the dictionary frame is cut off")
        head = archive[8:at]
        if head[:4] == FRAME_MAGIC:
            head = zstandard.ZstdDecompressor().decompressobj().decompress(head)
        dictionary = zstandard.ZstdCompressionDict(head) if head else None
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    view = memoryview(archive)
    while at < len(archive):
        if archive[at : at + 4] != FRAME_MAGIC:
            raise WarcError(f"no frame at byte {at}")
        frame, out, used = decompressor.decompressobj(), [], at
        try:
            # Small pieces, since what a frame does not use of the last one is copied back.
            while not frame.eof:
                piece = view[used : used + (1 << 14)]
                if not len(piece):
                    raise WarcError(f"the frame at byte {at} is cut off")
                out.append(frame.decompress(piece))
                used += len(piece)
        except zstandard.ZstdError as error:
            raise WarcError(f"the frame at byte {at} is broken: {error}") from error
        at = used - len(frame.unused_data)
        yield b"".join(out)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of a record; ``WarcError`` where version, headers or lengths are wrong."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in READ_VERSIONS or not blank:
        raise WarcError("not a WARC record of version 1.0 or 1.1")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode(errors="replace").partition(":")
        if not colon or name.strip().lower() in headers:
            raise WarcError(f"bad header line {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no header {name}")
    if headers["warc-type"] not in RECORD_TYPES:
        raise WarcError(f"unknown record type {headers['warc-type']}")
    if len(rest) != _length(headers, "content-length") + 4 or not rest.endswith(b"\r\n\r\n"):
        raise WarcError("the block is not as long as Content-Length says")
    return headers, rest[:-4]


def _length(headers: dict[str, str], name: str) -> int:
    if not re.fullmatch("[0-9]{1,18}", headers[name]):
        raise WarcError(f"{name} is {headers[name][:80]!r}")
    return int(headers[name])


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What a block carries: all of it, or what follows the headers of the HTTP message that it is."""
    if headers.get("content-type", "").lower().startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def digest_fits(labelled: str, payload: bytes) -> bool:
    """Whether a digest, hexadecimal or in base 32 behind the name of its algorithm, is that of the payload. One by an
    algorithm that is not known here says nothing against it."""
    name, _, value = labelled.rpartition(":")
    algorithm = name.lower().replace("-", "") or "sha256"
    if algorithm not in ("md5", "sha1", "sha256", "sha512"):
        return True
    digest = hashlib.new(algorithm, payload).digest()
    return value.lower() == digest.hex() or value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


def checked(record: bytes) -> tuple[int | None, str, bytes, int | None, str | None, str, int | None] | None:
    """page_id, url, block, payload length, payload digest, type and page referred to of a response or revisit, with the
    payload checked against the digest and length that the record states; None for a sound record of another type.

    The digest of a response is the SHA-256 of its payload, whichever the record states. A revisit has no payload: its length
    and digest are those stated, if any are, a digest by another algorithm with that one's name before it.
    """
    headers, block = parse_record(record)
    kind, name = headers["warc-type"], headers["warc-record-id"]
    if kind not in ("response", "revisit"):
        return None
    payload, stated = payload_of(headers, block), headers.get("warc-payload-digest")
    length = _length(headers, "x-payload-length") if "x-payload-length" in headers else None
    refers = None
    if kind == "response":
        if length not in (None, len(payload)) or (stated is not None and not digest_fits(stated, payload)):
            raise WarcError(f"the payload of {name} is not what its digest says")
        length, digest = len(payload), hashlib.sha256(payload).hexdigest()
    else:
        if payload or not {"warc-refers-to", "warc-refers-to-target-uri"} & headers.keys():
            raise WarcError(f"the revisit {name} has a payload or refers to nothing")
        digest, refers = stated and stated.removeprefix("sha256:"), page_of(headers.get("warc-refers-to", ""))
    return page_of(name), headers.get("warc-target-uri", ""), block, length, digest, kind, refers


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, n_bytes, first_id and revisit of every page.

    Of equal payloads of at least ``SMALLEST_REVISIT`` bytes the page with the smallest id is the response. Digests are
    written and grouped without the pages; pages are shuffled by their id, and no page meets the copies of its payload. The
    first page of each digest is written before it is looked up, so that the look-up has a shuffle of its own, whose parts
    can be split where one payload has very many pages.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    long = rows.where(F.octet_length("html") >= SMALLEST_REVISIT)
    digests = stored(long.select("page_id", F.sha2("html", 256).alias("digest")), "payload-digests")
    first = (
        digests.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select(F.col("digest").alias("g_digest"), "first_id")
    )
    later = (
        digests.join(stored(first, "first-pages"), F.col("digest") == F.col("g_digest"))
        .where("page_id IS NULL OR page_id <> first_id")
        .select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "first_id")
        .distinct()
    )
    return (
        rows.withColumn("digest", F.sha2("html", 256))
        .join(later, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
        .select("page_id", "url", "html", "digest", "first_id", F.col("r_digest").isNotNull().alias("revisit"))
    )


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it. What Hadoop calls ``s3a`` or ``s3n`` is ``s3`` here."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every page into archives below ``folder`` and return name, records and bytes of each.

    ``folder`` is a URI that all executors reach. The result runs the job when it is read: read it once, or store it.
    """

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        target, root = file_system(folder)
        target.create_dir(root, recursive=True)
        held: list[bytes] = []
        size = 0

        def flush() -> tuple:
            name, data = f"{uuid.uuid4().hex}.warc.zst", write_archive(held)
            with target.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            return name, len(held), len(data)

        for page_id, url, html, digest, first_id, revisit in rows:
            held.append(make_record(page_id, url, html.encode(), digest, first_id, revisit))
            size += len(held[-1])
            if size >= archive_bytes:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    schema = pa.schema([("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    return with_revisits(pages).mapInArrow(rows_mapper(each, schema, rows=1), "name string, records long, bytes long")


def read_archives(spark: SparkSession, folder: str, names: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Every response and revisit of the archives ``names`` (name, records, bytes) below ``folder``; records of other types
    are checked and left out.

    Columns: page_id, url, block (binary), payload_bytes, payload_digest, record_type, refers_to. The job fails with
    ``WarcError`` at a broken archive, and at one with another number of records or bytes than were written; these numbers
    may be null for archives made elsewhere. Records named elsewhere have no page_id, revisits of them no refers_to.
    """

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        source, root = file_system(folder)
        for name, records, size in rows:
            with source.open_input_stream(f"{root}/{name}", compression=None) as file:
                data = file.read()
            if size is not None and len(data) != size:
                raise WarcError(f"{name} has {len(data)} bytes instead of {size}")
            n = 0
            for record in read_archive(data):
                n += 1
                row = checked(record)
                if row is not None:
                    yield row
            if records is not None and n != records:
                raise WarcError(f"{name} has {n} records instead of {records}")

    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("block", pa.binary()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )
    n = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(n).mapInArrow(
        rows_mapper(each, schema),
        "page_id long, url string, block binary, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def round_trip(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages and read the archives back: ``read_archives`` of ``write_archives``.

    A null html is an empty payload. A page without id is a record of its own kind: it revisits an equal payload that has an
    id, and stays a response where none has. Rows that repeat an id and a payload are all responses if the id is the smallest,
    else all revisits. White space leaves urls; a null url is empty. Other columns are not read. An empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = folder or as_uri(scratch_path(spark, "warc"))
    listing = f"{folder}-written"
    write_archives(pages, folder, archive_bytes).write.parquet(listing)
    return read_archives(spark, folder, spark.read.schema("name string, records long, bytes long").parquet(listing))


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
