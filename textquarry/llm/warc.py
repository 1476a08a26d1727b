"""WARC archives as bundles of independent Zstandard frames with a seek table at the end.

Records are grouped into frames of about ``frame_bytes``; each frame can be decompressed on
its own.  A bundle ends with a skippable frame that lists the compressed and decompressed
size and checksum of every frame (the public seekable format), so plain Zstandard readers
still read the whole bundle.  An index maps each record to (bundle, frame, offset in the
decompressed frame), and one ranged read fetches one record.

A task writes its bundles under names of its own attempt, and the index holds those of the
attempts that Spark committed.  A lost executor leaves at most files that no index names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_table

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, bundle string, frame int, frame_start long, frame_bytes long, offset long, length long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary, bundle string, frame int, offset long"
)


def _file_system(place: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(place)


# --------------------------------------------------------------------------
# records


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    digits = urn.rpartition(":")[2].rstrip(">")
    return None if digits == "null" else int(digits)


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record with its HTTP response; a revisit keeps the HTTP headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {clean}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], int, bytes]]:
    """Offset, headers, payload size and payload of each record; a revisit's payload is empty."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        block = data[end + 4 : end + 4 + int(head["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        yield at, head, size, payload
        at = end + 8 + len(block)


# --------------------------------------------------------------------------
# bundles


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The last frame of a bundle: sizes and checksum of all others."""
    entries = b"".join(struct.pack("<III", *f) for f in frames)
    body = entries + struct.pack("<IBI", len(frames), CHECKSUMS, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int, int]]:
    """(start, compressed size, decompressed size, checksum) of every frame, read from the end of a file."""
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC or flags != CHECKSUMS:
        raise ValueError("the file doesn't end with a seek table with checksums")
    file.seek(size - 9 - 12 * n)
    frames, start = [], 0
    for packed, plain, check in struct.iter_unpack("<III", file.read(12 * n)):
        frames.append((start, packed, plain, check))
        start += packed
    return frames


class _Bundle:
    """A bundle that is being written; yields the index rows of each frame as it ends."""

    def __init__(self, folder: str, level: int):
        import zstandard

        self.name = f"{folder}/bundle-{uuid.uuid4()}.warc.zst"
        fs, path = _file_system(self.name)
        # By the name alone it would be compressed once more.
        self._file = fs.open_output_stream(path, compression=None)
        self._compress = zstandard.ZstdCompressor(level=level).compress
        self._frames: list[tuple[int, int, int]] = []
        self._held: list[tuple[int | None, bytes]] = []
        self.start, self.plain = 0, 0

    def add(self, page_id: int | None, record: bytes) -> None:
        self._held.append((page_id, record))
        self.plain += len(record)

    def end_frame(self) -> list[tuple]:
        import xxhash

        if not self._held:
            return []
        data = b"".join(r for _, r in self._held)
        packed = self._compress(data)
        self._file.write(packed)
        rows, offset = [], 0
        for page_id, record in self._held:
            rows.append((page_id, self.name, len(self._frames), self.start, len(packed), offset, len(record)))
            offset += len(record)
        self._frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.start += len(packed)
        self._held, self.plain = [], 0
        return rows

    def close(self) -> None:
        self._file.write(seek_table(self._frames))
        self._file.close()


def _payload(payload: str) -> Column:
    return F.coalesce(F.col(payload).cast("binary"), F.lit(b""))


def with_roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, sha1, refers_to``: of equal payloads that with the smallest id is kept.

    Only digests and numbers are grouped, combined before the shuffle; the payloads are joined with
    the revisits alone, on the page, so a group of copies of any size stays spread.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), _payload(payload).alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload")))
    narrow = rows.filter(F.length("payload") >= least_bytes).select("page_id", "sha1")
    first = narrow.groupBy("sha1").agg(F.min("page_id").alias("refers_to"))
    copies = narrow.join(first, "sha1").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull()).distinct()
    # Written, so that its size is known when the join is planned.
    copies = write_table(copies.select(F.col("page_id").alias("p"), F.col("sha1").alias("s"), "refers_to"))
    return rows.join(copies, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha1") == F.col("s")), "left").drop("p", "s")


def write_bundles(
    records: DataFrame, folder: str, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 28, level: int = 3, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Writes the records of :func:`with_roles` as bundles under ``folder``; returns the index, itself written."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = None
        for batch in batches:
            rows = []
            for page_id, url, payload, sha1, refers_to in batch[["page_id", "url", "payload", "sha1", "refers_to"]].itertuples(index=False):
                page_id, refers_to, url = (None if pd.isna(x) else x for x in (page_id, refers_to, url))
                if bundle is None:
                    bundle = _Bundle(folder, level)
                refers_to = None if refers_to is None else int(refers_to)
                page_id = None if page_id is None else int(page_id)
                bundle.add(page_id, warc_record(page_id, url, payload, base64.b32encode(sha1).decode(), refers_to, date))
                if bundle.plain >= frame_bytes:
                    rows += bundle.end_frame()
                    if bundle.start >= bundle_bytes:
                        bundle.close()
                        bundle = None
            yield _index(rows)
        if bundle is not None:
            yield _index(bundle.end_frame())
            bundle.close()

    def _index(rows: list[tuple]) -> pd.DataFrame:
        names = [c.split()[0] for c in INDEX.split(", ")]
        return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    fs, path = _file_system(folder)
    fs.create_dir(path, recursive=True)
    # Ids as text: a column of longs with nulls would come as floats.
    wide = records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return write_table(wide.mapInPandas(write, INDEX))


def read_bundles(index: DataFrame, with_payload: bool = False, part_bytes: int = 1 << 23) -> DataFrame:
    """All records of the bundles that an index names, read from the archives by their seek tables.

    A bundle is read in parts of about ``part_bytes``, dealt to as many tasks as there are parts: their
    number is given, so that adaptive execution leaves the tiny rows that name them apart.  Checksums
    of frames and digests of payloads are verified; what doesn't agree raises an error.
    """
    import zstandard

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        names = [c.split()[0] for c in RECORDS.split(", ")]
        for batch in batches:
            for bundle, part in zip(batch["bundle"], batch["part"]):
                fs, path = _file_system(bundle)
                with fs.open_input_file(path) as file:
                    for k, (start, packed, plain, check) in enumerate(read_seek_table(file, file.size())):
                        if start // part_bytes != part:
                            continue
                        file.seek(start)
                        data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
                        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
                            raise ValueError(f"frame {k} of {bundle} is damaged")
                        rows = [_row(*r, bundle, k) for r in parse_records(data)]
                        yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    def _row(offset: int, head: dict[str, str], size: int, payload: bytes, bundle: str, frame: int) -> tuple:
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = head["WARC-Type"]
        if kind == "response" and (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
            raise ValueError(f"a payload in frame {frame} of {bundle} is damaged")
        refers_to = _page_of(head["WARC-Refers-To"]) if kind == "revisit" else None
        kept = payload if with_payload and kind == "response" else None
        return (_page_of(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), size, digest, kind, refers_to, kept, bundle, frame, offset)

    parts = index.select("bundle", F.floor(F.col("frame_start") / part_bytes).cast("long").alias("part")).distinct()
    return parts.repartition(max(1, parts.count()), "bundle", "part").mapInPandas(read, RECORDS)


def read_record(bundle: str, frame_start: int, frame_bytes: int, offset: int, length: int) -> bytes:
    """One record by its row of the index: one ranged read of one frame."""
    import zstandard

    fs, path = _file_system(bundle)
    with fs.open_input_file(path) as file:
        file.seek(frame_start)
        data = zstandard.ZstdDecompressor().decompress(file.read(frame_bytes))
    return data[offset : offset + length]


def archive(spark: SparkSession, pages: DataFrame, folder: str, **settings) -> tuple[DataFrame, DataFrame]:
    """Writes a record per page and reads the archives back: (records, index).

    Null payloads count as empty; a null id is archived as ``null`` and is never the one that others
    revisit; rows that repeat an id and its payload are written as often as they occur, all as
    response if their id is the smallest; an empty table gives no bundle.
    """
    index = write_bundles(with_roles(pages), folder, **settings)
    return read_bundles(index), index
