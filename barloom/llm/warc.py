"""Web archives: a deterministic sharded writer, and a reader.

Records are compressed one by one, sorted into one global order and cut into files by their
compressed size. Their sizes are taken first, which fixes the first page of every file; then they
are compressed again and go straight to the task that writes their file, so no record is kept or
moved twice. A task writes a file under a temporary name and renames it when it is whole; the
manifest, committed by Spark, says which files belong to the archive. The same pages always give
the same bytes, so a task that runs twice writes the same file twice.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.batches import Batches, batch_of
from barloom.llm.common import in_order, landed
from barloom.shared import hadoop_path, new_path

#: Files are closed when their records reach this many compressed bytes.
ROLL_BYTES = 64 << 20
#: Most tasks that write files at once.
TASKS = 50_000
#: Equal payloads are written once if they have at least so many bytes.
REVISIT_BYTES = 100
#: Stamped on every record, so that an archive depends on its pages alone.
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 20

MANIFEST = {
    "file_no": pa.int64(), "name": pa.string(), "records": pa.int64(), "bytes": pa.int64(),
    "sha256": pa.string(),
}
MANIFEST_ROWS = "file_no long, name string, records long, bytes long, sha256 string"


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """The same for the same page, in every run."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest}').urn}>"


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A compressed record; headers without a value are left out."""
    given = [(k, v) for k, v in headers if v is not None]
    given += [
        ("WARC-Date", DATE),
        ("WARC-Block-Digest", f"sha256:{_sha(block)}"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {_line(v)}\r\n" for k, v in given)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def _http(size: int) -> bytes:
    return (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()


def _common(kind: str, page_id: int | None, url: str | None, digest: str) -> list[tuple]:
    return [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Target-URI", url),
        ("WARC-Page-ID", None if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]


def response(page_id: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    return _record(_common("response", page_id, url, digest), _http(len(payload)) + payload)


def revisit(page_id, url, size: int, digest: str, first_id, first_url) -> bytes:
    """A record that refers to the response with the same payload; its block has the HTTP head."""
    headers = [
        *_common("revisit", page_id, url, digest),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", record_id(first_id, first_url, digest)),
        ("WARC-Refers-To-Target-URI", first_url),
        ("WARC-Refers-To-Page-ID", None if first_id is None else str(first_id)),
    ]
    return _record(headers, _http(size))


def _measured(batches: Batches) -> Batches:
    """Payload size and digest, and the compressed size that the response record would have."""
    schema = {
        "page_id": pa.int64(), "url": pa.string(), "bytes": pa.int64(), "digest": pa.string(),
        "size": pa.int64(),
    }
    for batch in batches:
        rows = []
        for page, url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            payload = html or b""
            digest = _sha(payload)
            size = len(response(page, url, payload, digest))
            rows.append((page, url, len(payload), digest, size))
        yield batch_of(schema, rows)


def _revisits(batches: Batches) -> Batches:
    schema = {
        "again": pa.int64(), "page_id": pa.int64(), "url": pa.string(), "digest": pa.string(),
        "short": pa.binary(),
    }
    for batch in batches:
        rows = zip(*[c.to_pylist() for c in batch.columns], strict=True)
        yield batch_of(schema, [(*row[:3], row[4], revisit(*row[1:])) for row in rows])


def _key(page_id: int | None, url: str | None, digest: str) -> tuple:
    """Sorts like the columns do in Spark, null first."""
    return page_id is not None, page_id or 0, url is not None, (url or "").encode(), digest


SHORT, FULL = 0, 1
MEMBERS = {
    "file_no": pa.int64(), "page_id": pa.int64(), "url": pa.string(), "digest": pa.string(),
    "kind": pa.int8(), "member": pa.binary(),
}
MEMBER_ROWS = "file_no long, page_id long, url string, digest string, kind byte, member binary"


def _dealing(edges):
    """Records with the number of their file, given the first key of every file."""

    def full(batches: Batches) -> Batches:
        for batch in batches:
            rows, held = [], 0
            for page, url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                payload = html or b""
                digest = _sha(payload)
                number = bisect_right(edges.value, _key(page, url, digest)) - 1
                member = response(page, url, payload, digest)
                rows.append((number, page, url, digest, FULL, member))
                held += len(member)
                if held > 8 * CHUNK:
                    yield batch_of(MEMBERS, rows)
                    rows, held = [], 0
            yield batch_of(MEMBERS, rows)

    def short(batches: Batches) -> Batches:
        for batch in batches:
            rows = zip(*[c.to_pylist() for c in batch.columns], strict=True)
            yield batch_of(MEMBERS, [
                (bisect_right(edges.value, _key(page, url, digest)) - 1, page, url, digest, SHORT, member)
                for page, url, digest, member in rows
            ])

    return full, short


#: Schemes by which Spark clusters name stores, and what Arrow calls them.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
#: Where stores are mounted that are no file system to Arrow.
MOUNTS = {"file": "", "dbfs": "/dbfs"}


def store_uri(folder: str) -> str:
    """The name of a folder for Arrow: a path on the machine, or a URI of a store that it knows."""
    scheme, colon, rest = folder.partition(":")
    if not colon:
        return folder
    if scheme in MOUNTS:
        return f"{MOUNTS[scheme]}/{rest.lstrip('/')}"
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    uri = store_uri(folder)
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def _writing(folder: str):
    """Files of a sorted stream of records; a manifest row for each.

    Of the rows of one page all revisits come first; each of them stands for one of the full
    records after them, which is left out.
    """

    def written(batches: Batches) -> Batches:
        files, base = _store(folder)

        class Open:
            def __init__(self, number: int):
                self.number, self.name = number, f"part-{number:08d}.warc.gz"
                self.temporary = f"{base}/.{self.name}-{uuid.uuid4().hex}.tmp"
                self.out = files.open_output_stream(self.temporary, compression=None)
                self.sha, self.size, self.records = hashlib.sha256(), 0, 0
                text = f"software: barloom\r\nformat: WARC File Format 1.1\r\npart: {number}\r\n"
                known = [
                    ("WARC-Type", "warcinfo"), ("WARC-Filename", self.name),
                    ("WARC-Record-ID", record_id(None, self.name, "")),
                    ("Content-Type", "application/warc-fields"),
                ]
                self.add(_record(known, text.encode()))

            def add(self, member: bytes) -> None:
                self.out.write(member)
                self.sha.update(member)
                self.size += len(member)
                self.records += 1

            def close(self) -> tuple:
                self.out.close()
                final = f"{base}/{self.name}"
                try:
                    files.move(self.temporary, final)
                except OSError:  # stores that do not replace: an equal file is there already
                    if files.get_file_info(final).size != self.size:
                        raise
                    files.delete_file(self.temporary)
                return self.number, self.name, self.records, self.size, self.sha.hexdigest()

        now, page, instead = None, None, 0
        for batch in batches:
            members = batch.column(5)
            scalars = zip(*[c.to_pylist() for c in batch.columns[:5]], strict=True)
            for i, (number, *key, kind) in enumerate(scalars):
                if now is None or now.number != number:
                    if now is not None:
                        yield batch_of(MANIFEST, [now.close()])
                    now, page = Open(number), None
                if key != page:
                    page, instead = key, 0
                if kind == SHORT:
                    instead += 1
                elif instead:
                    instead -= 1
                    continue
                now.add(members[i].as_py())
        if now is not None:
            yield batch_of(MANIFEST, [now.close()])

    return written


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write page_id, url, html to archive files below ``folder``; returns the manifest.

    Every page becomes one record, null html an empty payload. Records are in the order of
    page_id (null first), url and payload digest. Of equal payloads of at least REVISIT_BYTES the
    record with the smallest page_id is the response and the others revisit it; a missing page_id
    comes last there, and of rows that repeat a page_id one is the response. A record longer than
    ``roll_bytes`` gets a file of its own. No pages give an empty manifest.

    The manifest is the commit: renaming is no single step in object stores, and files of an older
    archive in the same folder stay beside those that the new manifest names. Temporary files of
    attempts that failed are removed once it is written.
    """
    spark = pages.sparkSession
    files, place = hadoop_path(spark, folder)
    folder = files.makeQualified(place).toString()
    files.mkdirs(place)

    raw = pages.select(F.col("page_id").cast("long"), "url", F.col("html").cast("binary"))
    facts = raw.mapInArrow(
        _measured, "page_id long, url string, bytes long, digest string, size long"
    )
    facts = landed(facts.withColumn("row", F.monotonically_increasing_id()), "facts")

    one = F.struct(F.col("page_id").isNull(), "page_id", "url", "row")
    first = facts.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min(one).alias("first"), F.count(F.lit(1)).alias("n")
    )
    first = first.where("n > 1").select("digest", "first")
    again = facts.where(F.col("bytes") >= REVISIT_BYTES).join(first, "digest")
    again = again.where(F.col("row") != F.col("first.row")).select(
        "row", "page_id", "url", "bytes", "digest", F.col("first.page_id").alias("first_id"),
        F.col("first.url").alias("first_url"),
    )
    short = landed(
        again.mapInArrow(
            _revisits, "again long, page_id long, url string, digest string, short binary"
        ),
        "revisits",
    )

    lengths = short.select("again", F.length("short").alias("short"))
    sized = facts.join(lengths, F.col("row") == F.col("again"), "left").select(
        "row", "page_id", "url", "digest", F.coalesce("short", "size").alias("size")
    )
    order = [F.col(c) for c in ("page_id", "url", "digest", "row")]
    placed = in_order(landed(sized, "sized"), order, {"before": "size"})
    number = F.floor(F.col("before") / F.lit(roll_bytes)).alias("file_no")
    starts = placed.groupBy(number).agg(F.min(F.struct("page_id", "url", "digest")).alias("key"))
    # One key per file, so by the archive's size a small table; where equal pages lie on both
    # sides of a cut, they all go to the later file.
    keys = sorted({_key(*r["key"]) for r in starts.select("key").collect()})
    full_of, short_of = _dealing(spark.sparkContext.broadcast(keys))
    members = raw.mapInArrow(full_of, MEMBER_ROWS).union(
        short.drop("again").mapInArrow(short_of, MEMBER_ROWS)
    )
    # A task per file, as far as Spark handles so many tasks; beyond, some files one after another.
    tasks = min(max(len(keys), 1), TASKS)
    dealt = members.repartitionById(tasks, (F.col("file_no") % tasks).cast("int"))
    dealt = dealt.sortWithinPartitions("file_no", "page_id", "url", "digest", "kind")
    manifest = dealt.mapInArrow(_writing(folder), MANIFEST_ROWS)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    for left in files.globStatus(hadoop_path(spark, f"{folder}/.part-*.tmp")[1]) or []:
        files.delete(left.getPath(), False)
    return manifest_of(spark, folder)


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST_ROWS).parquet(f"{folder}/manifest")


def records_of(stream, size: int, sha256: str, name: str) -> Iterator[bytes]:
    """Uncompressed records of one archive file, held one at a time."""
    whole, seen = hashlib.sha256(), 0
    unpack, parts = zlib.decompressobj(31), []
    while chunk := stream.read(CHUNK):
        whole.update(chunk)
        seen += len(chunk)
        while chunk:
            parts.append(unpack.decompress(chunk))
            chunk = b""
            if unpack.eof:
                yield b"".join(parts)
                chunk = unpack.unused_data
                unpack, parts = zlib.decompressobj(31), []
    if (seen, whole.hexdigest()) != (size, sha256):
        raise ValueError(f"{name} is not the file that the manifest names")


READ = {
    "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(),
    "payload": pa.binary(),
}
READ_ROWS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines if line)}


def parsed(record: bytes, with_payload: bool) -> tuple | None:
    """A row of a response or revisit record; digests are checked on the way."""
    head, _, rest = record.partition(b"\r\n\r\n")
    known = _fields(head)
    if known["warc-type"] == "warcinfo":
        return None
    block = rest[: int(known["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = known["warc-payload-digest"].removeprefix("sha256:")
    kind = known["warc-type"]
    if f"sha256:{_sha(block)}" != known["warc-block-digest"]:
        raise ValueError(f"the block of {known['warc-record-id']} has another digest")
    if kind == "response" and _sha(payload) != digest:
        raise ValueError(f"the payload of {known['warc-record-id']} has another digest")
    page, first = known.get("warc-page-id"), known.get("warc-refers-to-page-id")
    return (
        None if page is None else int(page),
        known.get("warc-target-uri"),
        kind,
        int(_fields(http)["content-length"]),
        digest,
        None if first is None else int(first),
        payload if with_payload and kind == "response" else None,
    )


def _reading(folder: str, with_payload: bool):
    def read(batches: Batches) -> Batches:
        files, base = _store(folder)
        for batch in batches:
            for _, name, _, size, sha256 in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows, held = [], 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for record in records_of(stream, size, sha256, name):
                        row = parsed(record, with_payload)
                        if row is not None:
                            rows.append(row)
                            held += len(row[-1] or b"") + 200
                        if held > CHUNK:
                            yield batch_of(READ, rows)
                            rows, held = [], 0
                yield batch_of(READ, rows)

    return read


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Rows of the records of an archive: those of the files in its manifest, no others.

    ``payload`` is null for revisits. A file that is missing or not the one that the manifest
    names, or a record whose digest is wrong, is an error.
    """
    files, place = hadoop_path(spark, folder)
    folder = files.makeQualified(place).toString()
    manifest = manifest_of(spark, folder).select(*MANIFEST)
    parts = max(1, manifest.count())
    return manifest.repartition(parts, "file_no").mapInArrow(_reading(folder, with_payload), READ_ROWS)


def write_and_read(pages: DataFrame) -> DataFrame:
    """Write an archive to the shared folder and read it back."""
    folder = new_path(pages.sparkSession, "warc")
    write(pages, folder)
    return read(pages.sparkSession, folder, with_payload=False)
