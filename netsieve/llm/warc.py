"""WARC records in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsieve.llm.store import stored

LEAST = 1000  # bytes of a payload from which equal ones are written once
FRAME_BYTES = 256_000  # of records in a frame; a larger record has a frame of its own
BUNDLE_BYTES = 64_000_000  # of compressed frames in a file
TASK_BYTES = 32_000_000  # of unpacked frames that a reading task gets
# Fixed values of the Zstandard seekable format: a skippable frame with a table and a footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"
_INDEX = "bundle string, frame int, offset long, length long, page_id long"


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row to bundles in ``folder``; the stored index of all records.

    Index: ``bundle, frame, offset, length, page_id``: the file, the number of the frame and
    the record's place in the unpacked frame. A bundle is a run of independent Zstandard
    frames, so any tool reads it from the start, followed by a seek table that gives the sizes
    of the frames to readers that jump.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least ``LEAST``
    bytes the one with the largest id is a response and the others revisit it; all others are
    responses. Rows that repeat the largest id are responses each; null ids come last, and are
    responses if no other row has the payload. A null url is written as an empty one.

    Payloads are counted by digest before the shuffle and joined back by a join that Spark
    splits when it is skewed. Files carry the number of the task attempt, and only those of
    attempts that Spark has accepted are in the index, so a lost executor costs files that
    nobody reads. ``folder`` is a URI that pyarrow can write (local, HDFS, S3, GCS). An empty
    table gives an empty index.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    equal = rows.where(F.col("size") >= LEAST).groupBy("digest", "size").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
    marked = rows.join(equal.where("n > 1").drop("n"), ["digest", "size"], "left")
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    marked = marked.select("page_id", "url", "payload", "digest", revisit.alias("refers_to"))
    return stored(marked.mapInArrow(_writer(folder), _INDEX), "index")


def read_bundles(spark: SparkSession, index: DataFrame) -> DataFrame:
    """The records of an index, read from their frames: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to, url, payload``.

    A task gets whole frames and unpacks only those. The payload of a response is checked
    against its digest; a revisit has none and tells the digest and the length of the
    payload it stands for.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    frames = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places"))
    frames = frames.repartition(-(-total // TASK_BYTES) or 1, "bundle", "frame")  # the index says little of the bytes behind it
    columns = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    return frames.sortWithinPartitions("bundle", "frame").mapInArrow(_read_frames, columns)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A WARC record; the digest is given in hex and written in base 32 as is usual."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def parse_record(data: bytes) -> dict:
    """Headers of a record (lower-case names) and its ``payload``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    return fields | {"payload": block.partition(b"\r\n\r\n")[2]}


class _Bundle:
    """A file of frames under way."""

    def __init__(self, folder: str, name: str):
        self.path = f"{folder}/{name}"
        fs, where = pafs.FileSystem.from_uri(folder)
        fs.create_dir(where, recursive=True)
        self.out = fs.open_output_stream(f"{where}/{name}", compression=None)  # the name would ask for one
        self.sizes: list[tuple[int, int]] = []

    def add(self, frame: bytes):
        packed = zstandard.ZstdCompressor(level=3).compress(frame)
        self.out.write(packed)
        self.sizes.append((len(packed), len(frame)))

    def close(self):
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """Start, packed and unpacked size of each frame of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    entries = struct.iter_unpack("<II", file.read(8 * n))
    places, at = [], 0
    for packed, unpacked in entries:
        places.append((at, packed, unpacked))
        at += packed
    return places


def _writer(folder):
    def run(batches):
        task = TaskContext.get()
        bundle, frame, places, n = None, bytearray(), [], 0
        for batch in batches:
            index = []
            for row in zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True):
                data = record(*row)
                if frame and len(frame) + len(data) > FRAME_BYTES:
                    bundle, n = _flush(bundle, folder, task, n, frame)
                    index += _places(bundle, places)
                    frame, places = bytearray(), []
                    if sum(s for s, _ in bundle.sizes) >= BUNDLE_BYTES:
                        bundle.close()
                        bundle = None
                places.append((len(frame), len(data), row[0]))
                frame += data
            yield _index_batch(index)
        if frame:
            bundle, n = _flush(bundle, folder, task, n, frame)
            yield _index_batch(_places(bundle, places))
        if bundle:
            bundle.close()

    return run


def _flush(bundle, folder, task, n, frame):
    if bundle is None:
        bundle, n = _Bundle(folder, f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{n}.warc.zst"), n + 1
    bundle.add(bytes(frame))
    return bundle, n


def _places(bundle, places):
    return [(bundle.path, len(bundle.sizes) - 1, *p) for p in places]


def _index_batch(rows):
    types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["bundle", "frame", "offset", "length", "page_id"])


def _read_frames(batches):
    path, file, table = None, None, []
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload")
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    for batch in batches:
        for bundle, frame, places in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            if bundle != path:
                folder, _, name = bundle.rpartition("/")
                fs, where = pafs.FileSystem.from_uri(folder)
                path, file = bundle, fs.open_input_file(f"{where}/{name}")
                table = read_seek_table(file)
            start, packed, unpacked = table[frame]
            file.seek(start)
            data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=unpacked)
            rows = [_row(parse_record(data[p["offset"] : p["offset"] + p["length"]])) for p in places]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def _row(r: dict):
    digest = base64.b32decode(r["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(r["x-payload-length"])
    if r["warc-type"] == "response" and (len(r["payload"]) != size or hashlib.sha1(r["payload"]).hexdigest() != digest):
        raise ValueError("payload differs from its digest")
    page, refers = r["x-page-id"], r.get("x-refers-to-page")
    return (int(page) if page else None, size, digest, r["warc-type"], int(refers) if refers else None, r["warc-target-uri"], r["payload"])
