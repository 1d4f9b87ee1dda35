"""Dictionary-compressed WARC archives: one Zstandard frame per record.

Pages are written as WARC records, an HTTP response each.  Of equal payloads of
at least `least` bytes one is a response and the others are revisits of it, which
hold its headers only.  A task writes volumes: when the records of a volume are
together, a Zstandard dictionary is built from them, embedded in the volume's
leading skippable frame, and each record becomes a frame of its own that needs
only that dictionary, so a record can be read without its neighbours.  Few or large
records are cut into pieces to train on; a volume of too few bytes for that has a
header of its own as raw dictionary, and the manifest says which volumes have one.

Volumes are files in the shared folder, written under a new name and moved into
place, so a task that runs again replaces its own volumes; the manifest names
those that count.  They are read back as binary files, one volume at a time.

Defined results: null html is an empty payload.  Pages without id are archived and
read back without id; among equal payloads they are revisits where one with an id
is there; an empty table has no volumes.  Of repeated ids with one payload, one is the response.  A null url is
an empty target.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import mapped, row_key, shared_folder, slices, stored

#: The skippable frame that holds a dictionary, and that of Zstandard dictionaries.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = 0xEC30A437
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_READ = "page_id bigint,payload_bytes bigint,payload_digest string,record_type string,refers_to bigint,url string,html binary"


def record(page_id, url: str, payload: bytes, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC record; a revisit holds the headers of the response alone."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple:
    """What a record says: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload (None if it isn't there)."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(rest) != len(block) + 4:
        raise ValueError("a WARC record ends early")
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    page = fields["WARC-Record-ID"][10:-1]
    refers = fields.get("WARC-Refers-To", "<urn:page:>")[10:-1]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of page {page} isn't what its record says")
    return (
        int(page) if page else None, size, digest, kind, int(refers) if refers else None, fields["WARC-Target-URI"],
        payload if kind == "response" else None,
    )


def samples(records: Sequence[bytes], most: int) -> list[bytes]:
    """What a dictionary is trained on, about `most` bytes: records evenly spaced, or pieces of them where they are few."""
    total = sum(map(len, records))
    spaced = list(records[:: max(1, total // most)])
    if len(spaced) >= 16:
        return spaced
    size = min(4096, max(256, total // 64))
    pieces = [r[k : k + size] for r in records for k in range(0, len(r), size)]
    return pieces[:: max(1, len(pieces) * size // most)]


def dictionary_of(records: Sequence[bytes], dictionary_bytes: int) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on a volume's records; the first record's header where they hold too little for that."""
    given = samples(records, 100 * dictionary_bytes)
    for size, k in ((dictionary_bytes, 1024), (min(dictionary_bytes, sum(map(len, given)) // 8), 64)):
        try:
            return zstandard.train_dictionary(size, given, k=k, d=8)
        except (zstandard.ZstdError, ValueError):  # too little in the records for one of that size
            continue
    head = records[0].split(b"\r\n\r\n", 1)[0] if records else b"WARC"
    return zstandard.ZstdCompressionDict(head[:dictionary_bytes], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def volume(records: Sequence[bytes], dictionary_bytes: int, level: int) -> bytes:
    """A file of records: the dictionary's frame, then a frame per record."""
    known = dictionary_of(records, dictionary_bytes)
    raw = known.as_bytes()
    press = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True, write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(raw)), raw, *map(press.compress, records)])


def dictionary_kind(data: bytes) -> str:
    """`trained` or `raw`: what the first frame of a volume holds."""
    return "trained" if struct.unpack_from("<I", data, 8)[0] == DICTIONARY_MAGIC else "raw"


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of a volume."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the volume doesn't begin with a dictionary")
    kind = zstandard.DICT_TYPE_FULLDICT if dictionary_kind(data) == "trained" else zstandard.DICT_TYPE_RAWCONTENT
    known = zstandard.ZstdCompressionDict(data[8 : 8 + size], dict_type=kind)
    reader = zstandard.ZstdDecompressor(dict_data=known)
    rest = memoryview(data)[8 + size :]
    while len(rest):
        frame = reader.decompressobj()
        yield frame.decompress(rest)
        rest = rest[len(rest) - len(frame.unused_data) :]


def write_archive(
    pages: DataFrame, least: int = 1000, volume_bytes: int = 16 << 20, dictionary_bytes: int = 64 << 10, level: int = 3,
    date: str = "2024-01-01T00:00:00Z",
) -> tuple[str, DataFrame]:
    """Archive all pages; the folder and the manifest (name, records, bytes, dictionary) of its volumes."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html")
    )
    keyed = stored(rows.withColumn("row", row_key()).withColumn("part", F.spark_partition_id()))
    # Who is a revisit of whom, without payloads; equal means equal by SHA-256 and length.
    same = stored(
        keyed.where(F.octet_length("html") >= least).select(
            "page_id", "row", "part", F.sha2(F.col("html").cast("binary"), 256).alias("d"), F.octet_length("html").alias("n")
        )
    )
    newest = F.max(F.struct(F.col("page_id").isNotNull().alias("has"), "page_id", "row"))
    local = same.groupBy("part", "d", "n").agg(newest.alias("w"), F.count("*").alias("c"))
    best = local.groupBy("d", "n").agg(F.max("w").alias("best"), F.sum("c").alias("c")).where("c > 1")
    # Back over each partition's digests, so a payload that a third of the pages share is no hot key.
    answers = local.select("part", "d", "n").join(best, ["d", "n"]).select("part", "d", "n", "best")
    revisits = (
        same.join(answers, ["part", "d", "n"])
        .where(F.col("row") != F.col("best.row"))
        .select(F.col("row").alias("_row"), F.col("best.page_id").alias("refers_to"))
    )
    folder = shared_folder(spark, "warc")
    _ensure(spark, folder)
    run = uuid.uuid4().hex[:8]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> dict:
            nonlocal made, held, size
            data = volume(held, dictionary_bytes, level)
            name = f"{run}-{part:06d}-{made:05d}.warc.zst"
            fresh = f"{root}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(fresh) as out:
                out.write(data)
            store.move(fresh, f"{root}/{name}")
            done = {"name": [name], "records": [len(held)], "bytes": [len(data)], "dictionary": [dictionary_kind(data)]}
            made, held, size = made + 1, [], 0
            return done

        for batch in slices(batches, "html", 4 << 20):
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "revisit"))
            for page_id, url, text, refers_to, revisit in zip(*columns, strict=True):
                held.append(record(page_id, url, text.encode(), refers_to, revisit, date))
                size += len(held[-1])
                if size >= volume_bytes:
                    yield close()
        if held:
            yield close()

    ready = keyed.join(revisits, F.col("row") == F.col("_row"), "left").select(
        "page_id", "url", "html", "refers_to", F.col("_row").isNotNull().alias("revisit")
    )
    return folder, stored(mapped(ready, write, "name string,records bigint,bytes bigint,dictionary string"))


def _ensure(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def read_archive(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url and html (null for revisits)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = [x.split()[0] for x in _READ.split(",")]
        for batch in batches:
            for data in batch.column("content"):
                rows: list[tuple] = []
                size = 0
                for raw in records_of(data.as_py()):
                    rows.append(parsed(raw))
                    size += len(raw)
                    if size > 8 << 20:
                        yield dict(zip(names, zip(*rows, strict=True), strict=True))
                        rows, size = [], 0
                if rows:
                    yield dict(zip(names, zip(*rows, strict=True), strict=True))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return mapped(named.join(manifest.select("name"), "name", "left_semi"), read, _READ)
