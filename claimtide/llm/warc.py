"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: each task turns its pages into records, compresses every record into a frame of its own with the shared
dictionary, and rolls over to a new archive at a given size, so an archive always fits in memory.  Reading: Spark's
binary file source lists and loads archives; each is decoded frame by frame and every record is validated.

A manifest, written by Spark with its own commit, names the archives of the attempts that succeeded.  Readers only
take those, so files of lost or repeated attempts do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.llm.common import shared_folder

# Fixed values of the formats: skippable frame that holds a dictionary, frame and dictionary magics, WARC lines.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

ARCHIVE_BYTES = 32 << 20
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 16_384, 65_536
FEED = 1 << 16
LEVEL = 3


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Records -------------------------------------------------------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def build_record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record with its payload, or a revisit record with HTTP headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id(page_id), "WARC-Date": DATE}
    if url is not None:
        head["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    head["WARC-Payload-Digest"] = f"sha1:{digest(payload)}"
    head["WARC-Block-Digest"] = f"sha1:{digest(block)}"
    if kind == "revisit":
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to)}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record; anything malformed is a ValueError."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or not data.startswith(VERSION + b"\r\n"):
        raise ValueError("no WARC header")
    head: dict[str, str] = {}
    for line in data[len(VERSION) + 2:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed header line {line[:80]!r}")
        head[name.decode().lower()] = value.strip().decode("utf-8", "surrogatepass")
    missing = [n for n in ("warc-type", "warc-record-id", "warc-date", "content-length") if n not in head]
    if missing:
        raise ValueError(f"missing headers {missing}")
    if not head["content-length"].isdigit() or end + 4 + int(head["content-length"]) + 4 != len(data):
        raise ValueError(f"Content-Length {head['content-length']} of {len(data) - end - 8} bytes")
    if data[-4:] != b"\r\n\r\n":
        raise ValueError("no end of record")
    block = data[end + 4:-4]
    if "warc-block-digest" in head and head["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    return head, block


def read_response(data: bytes) -> dict:
    """Fields of a response or revisit record, with lengths and digests checked."""
    head, block = parse_record(data)
    kind = head["warc-type"]
    http, gap, payload = block.partition(b"\r\n\r\n")
    if kind not in ("response", "revisit") or not gap or not http.startswith(b"HTTP/1.1 "):
        raise ValueError(f"{kind} record without HTTP headers")
    length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    claimed = head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != claimed):
        raise ValueError("payload length or digest differs")
    if kind == "revisit" and (payload or "warc-refers-to" not in head or head.get("warc-profile") != REVISIT_PROFILE):
        raise ValueError("malformed revisit record")
    ids = [None if x is None or x == "<urn:page:null>" else int(x.removeprefix("<urn:page:").removesuffix(">"))
           for x in (head["warc-record-id"], head.get("warc-refers-to"))]
    return {"page_id": ids[0], "url": head.get("warc-target-uri"), "record_type": kind, "payload_bytes": length,
            "payload_digest": claimed, "refers_to": ids[1], "payload": payload if kind == "response" else None}


# Archives ------------------------------------------------------------------------------------------------------------

def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary of sample records; empty (no dictionary) where the samples are too few or too alike."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive_start(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else b""


def split_dictionary(data: bytes) -> tuple[bytes, int]:
    """The dictionary of an archive (itself perhaps one compressed frame) and where its records begin."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_FRAME:
        return b"", 0
    size = struct.unpack_from("<I", data, 4)[0]
    found = data[8:8 + size]
    if len(found) != size:
        raise ValueError("the dictionary frame is cut short")
    if found[:4] == FRAME_MAGIC:
        found = zstandard.ZstdDecompressor().decompressobj().decompress(found)
    if found[:4] != DICTIONARY_MAGIC:
        raise ValueError("no dictionary in the leading frame")
    return found, 8 + size


def records(data: bytes) -> Iterator[bytes]:
    """Record after record of an archive: each frame is decoded on its own, later skippable frames are passed over."""
    dictionary, at = split_dictionary(data)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    view = memoryview(data)
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError("a frame is cut short")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            at += 8 + size
            continue
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("a frame is cut short")
            fed = view[at:at + FEED]
            parts.append(frame.decompress(fed))
            at += len(fed) - len(frame.unused_data)
        yield b"".join(parts)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch[c] for c in batch.columns])


def _whole(x) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI; without a scheme it lies in Spark's own default file system, which a written table names."""
    if "://" not in folder and not folder.startswith("file:"):
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}/place")
        folder = spark.read.parquet(f"{folder}/place").inputFiles()[0].rpartition("/place/")[0]
    scheme, _, path = folder.partition(":")
    folder = f"{scheme}://{path}" if not path.startswith("//") else folder
    pafs.FileSystem.from_uri(folder)  # an unknown scheme fails here, not in the tasks
    return folder


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write records of ``page_id, url, payload, record_type, refers_to``; returns the manifest.

    The manifest, a table in the same folder, has one row per archive: ``archive, records, bytes``.  ``folder`` is one that
    every executor reaches, such as one under the shared checkpoint folder; without a scheme it is Spark's to place.
    """
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(dictionary)
    target = qualified(spark, folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = pafs.FileSystem.from_uri(target)
        known = shared.value
        writer = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(known) if known else None, write_checksum=True)
        frames: list[bytes] = []
        size = 0

        def flush() -> pd.DataFrame:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(archive_start(known))
                for f in frames:
                    out.write(f)
            return pd.DataFrame({"archive": [name], "records": [len(frames)], "bytes": [size]})

        store.create_dir(root, recursive=True)
        for page_id, url, payload, kind, refers_to in _rows(batches):
            frames.append(writer.compress(build_record(kind, _whole(page_id), url, bytes(payload), _whole(refers_to))))
            size += len(frames[-1])
            if size >= archive_bytes:
                yield flush()
                frames, size = [], 0
        if frames:
            yield flush()

    schema = "archive string, records long, bytes long"
    pages.select("page_id", "url", "payload", "record_type", "refers_to").mapInPandas(run, schema).write.mode(
        "overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


FIELDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
          "payload binary")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame | None = None,
                  payload: bool = False) -> DataFrame:
    """Records of all archives of a folder, or of those that a manifest names: see ``FIELDS``.

    A revisit record has the length its HTTP headers state and no payload.  ``payload=False`` leaves payloads out
    after they have been checked.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    if manifest is not None:
        files = files.withColumn("archive", F.element_at(F.split("path", "/"), -1)).join(
            manifest.select("archive"), "archive", "left_semi")
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path, content in _rows(batches):
            found, held = [], 0
            for n, record in enumerate(records(content)):
                try:
                    fields = read_response(record)
                except ValueError as e:
                    raise ValueError(f"record {n} of {path}: {e}") from e
                if not payload:
                    fields["payload"] = None
                found.append(fields)
                held += len(record) if payload else 0
                if len(found) == 4096 or held > ARCHIVE_BYTES:
                    yield _frame(found, names)
                    found, held = [], 0
            if found:
                yield _frame(found, names)

    return files.select("path", "content").mapInPandas(run, FIELDS)


def _frame(found: list[dict], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(found, columns=names)
    for c in ("page_id", "refers_to", "payload_bytes"):
        frame[c] = frame[c].astype("Int64")
    return frame


# Pages to archives and back ------------------------------------------------------------------------------------------

def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, record_type, refers_to`` of ``page_id, url, html``.

    Of pages with equal payloads of at least ``least_bytes`` bytes, that with the largest id is the response and the
    others are revisits of it; smaller payloads are all responses.  Pages that share the largest id are all responses;
    a NULL id is the smallest.  A NULL html is an empty payload.  Only ids and SHA-256 digests are grouped, with a
    partial maximum first; the pages meet their group's id in a join that Spark can split.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload"), F.sha2(body, 256).alias("content"))
    large = F.length("payload") >= least_bytes
    heads = rows.filter(large).groupBy("content").agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n"))
    marked = rows.join(heads.filter("n > 1").drop("n"), "content", "left")
    revisit = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return marked.select("page_id", "url", "payload",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("head")).alias("refers_to"))


def sample_dictionary(pages: DataFrame, sample: int = SAMPLE_PAGES, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the pages that come first in hash order: ``sample`` of them, ``SAMPLE_BYTES`` of each at most."""
    at = F.xxhash64("page_id", "url")
    # Hashes alone are ranked; only the pages chosen by them give their text.
    last = pages.select(at.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    start = F.substring(F.coalesce("html", F.lit("")), 1, SAMPLE_BYTES)
    near = pages.select(at.alias("h"), start.alias("start")).filter(F.col("h") <= F.lit(last))
    first = near.distinct().orderBy("h", "start").limit(sample)
    return train_dictionary([r.start.encode("utf-8", "surrogatepass") for r in first.collect()], size)


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0,
                  archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Write all pages as archives below the shared folder; returns the folder and the manifest.

    An empty table writes no archive.  Other columns are ignored.
    """
    folder = folder or shared_folder(pages.sparkSession) + "-warc"
    return folder, write_archives(mark_revisits(pages, least_bytes), folder, sample_dictionary(pages), archive_bytes)
