"""Web archives whose records are compressed one by one with a dictionary made from them."""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
from collections.abc import Iterator
from uuid import UUID, uuid4, uuid5

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import pick, table, written
from ledgerlens.sources.files import work_folder

#: Fixed value: the number that starts a skippable frame with a dictionary, by the convention for such archives
DICTIONARY_FRAME = 0x184D2A5D
#: records that the dictionary is made from, about, and the bytes taken of each at most; its size; bytes after which a file is closed
SAMPLE, SAMPLE_BYTES, DICTIONARY_SIZE, FILE_SIZE = 400, 128 << 10, 64 << 10, 128 << 20
#: Fixed value: the name space that record names are made in
NAMES = UUID("0d9f2f4e-7f3c-4a59-9c55-6a1f5f0b7a11")
DATE = "2024-01-01T00:00:00Z"


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Any store that Arrow reaches by its address; plain and file: paths are the shared folder's own."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def dictionary(some: list[bytes]) -> bytes:
    """A trained dictionary, or, from too few records to train on, the records themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_SIZE, some).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(some)[-DICTIONARY_SIZE:]


def _kind(content: bytes) -> zstandard.ZstdCompressionDict:
    full = content[:4] == b"\x37\xa4\x30\xec"
    return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_FULLDICT if full else zstandard.DICT_TYPE_RAWCONTENT)


def record_id(page_id: int | None, named: str) -> str:
    """The name of a page's record, the same in every run; equal pages have equal names."""
    return f"<urn:uuid:{uuid5(NAMES, f'{page_id}:{named}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One record: named fields, then an HTTP head and, unless another record holds it, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    named = digest(payload)
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, named)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{named}"),
        ("Page-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # no field may hold a line break, and no address a space: what had to be changed is kept beside it
        address = "".join(c if c > " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        fields.append(("WARC-Target-URI", address))
        if address != url:
            fields.append(("Page-URL", json.dumps(url)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if is_revisit:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", record_id(refers_to, named)))
        fields.append(("Page-Refers-To", str(refers_to)))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and payload of each record of an archive, from a stream that is read once."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary in front")
    content = stream.read(size)
    reader = zstandard.ZstdDecompressor(dict_data=_kind(content) if content else None).stream_reader(stream, read_across_frames=True)
    lines = io.BufferedReader(reader, 1 << 16)
    while line := lines.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := lines.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = lines.read(int(fields["Content-Length"]))
        lines.read(4)
        yield fields, block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, folder: str, least: int = 0, sample: int = SAMPLE) -> DataFrame:
    """Writes a record for each page into archives in the folder; gives their paths and numbers of records.

    The payload is the html in UTF-8, null as empty. Of records with equal payloads of at least `least` bytes the one
    with the largest page_id is the response, the others revisit it. Rows that share that page_id are responses each;
    so are rows of a payload whose page_ids are all null, while a null page_id beside others revisits. Records, their
    fields included, have the same bytes in every run. About `sample` records of different payloads, picked by a hash, up to
    128 kB of each, make the dictionary; it opens every file, in a skippable frame. Each task writes files of its own
    under new names, and only files of tasks that ended well are in the list that is returned.
    """
    spark = pages.sparkSession
    rows = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.withColumn("sha1", F.sha1("payload"))
    different = rows.agg(F.approx_count_distinct("sha1", 0.02)).first()[0]
    share = int(min(1.0, sample / max(1, different)) * (1 << 30))
    picked = rows.where(F.pmod(F.xxhash64(F.lit("dictionary"), "sha1"), F.lit(1 << 30)) < share)
    first = picked.groupBy("sha1").agg(F.min(F.struct("page_id", "url")).alias("of"), F.first(F.substring("payload", 1, SAMPLE_BYTES)).alias("payload"))
    taken = first.select("of.page_id", "of.url", "payload").collect()
    content = dictionary(sorted(record(r["page_id"], r["url"], bytes(r["payload"]), None, False) for r in taken))

    shared = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1 and keeper is not null")
        .select(F.col("sha1").alias("of"), "keeper")
    )
    marked = rows.join(shared, F.col("sha1") == F.col("of"), "left").select(
        "page_id",
        "url",
        "payload",
        "keeper",
        (F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))).alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)
        store.create_dir(root, recursive=True)
        compressor = zstandard.ZstdCompressor(level=6, dict_data=_kind(content) if content else None)
        out, made = None, []
        for batch in batches:
            for page_id, url, payload, keeper, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    made.append([f"{root}/{uuid4().hex}.warc.zst", 0])
                    out = store.open_output_stream(made[-1][0])
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
                out.write(compressor.compress(record(page_id, url, payload, keeper, revisit)))
                made[-1][1] += 1
                if out.tell() >= FILE_SIZE:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        paths = [f"{folder.rstrip('/')}/{p.rpartition('/')[2]}" for p, _ in made]
        yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "records": pa.array([n for _, n in made], pa.int64())})

    return written(marked.mapInArrow(write, "path string, records long"), "archives")


_READ = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row for each record of these archives (path): page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to. Digests of payloads that are there are checked. A revisit has no payload of its own (null)."""

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(_READ)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READ)], schema=_READ)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, at = _file_system(path)
                rows: list[tuple] = []
                size = 0
                with store.open_input_stream(at) as stream:
                    for fields, payload in records(stream):
                        is_revisit = fields["WARC-Type"] == "revisit"
                        named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if not is_revisit and digest(payload) != named:
                            raise ValueError(f"{path}: a payload differs from its digest")
                        length = number(fields["Page-Payload-Length"])
                        kept = payload if with_payload and not is_revisit else None
                        url = json.loads(fields["Page-URL"]) if "Page-URL" in fields else fields.get("WARC-Target-URI")
                        row = (number(fields.get("Page-ID")), url, kept, length, named)
                        rows.append((*row, fields["WARC-Type"], number(fields.get("Page-Refers-To"))))
                        size += len(payload) if with_payload else 100
                        if size > 8 << 20:
                            yield emit(rows)
                            rows, size = [], 0
                yield emit(rows)

    # one file a task: files are large, their list is not
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.repartition("path").select("path").mapInArrow(read, schema)


def op10_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), work_folder(spark, "warc"))
    found = read_archives(archives, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
