"""Web pages as WARC records in ZIP packages, read back through the packages' directories without unpacking them.

Writing. Each task packs its pages into ZIP files below a folder: a stored member ``archive/data.warc.gz`` (every record a gzip member of its own) and a
stored member ``indexes/index.cdxj`` (per record its offset in the archive, its length, its type and its target). A package is closed once its archive has
``package_bytes``. Of pages with the same payload, that with the largest id becomes a ``response``; the others become ``revisit`` records that name it and
hold the response's HTTP head, whose Content-Length is that of the whole payload, and no payload. A manifest table holds one row per finished package; what
lost attempts left behind is not in it and is never read.

Reading. Of a package the tail is read first: the end record, the ZIP64 end record behind its locator where the end record's
fields are full, then the central directory with its ZIP64 extra fields. Members must be stored, so a byte of a member is a byte of the package. The index
gives every record's place; neighbouring records are fetched by one ranged read of up to ``READ_BYTES``, in tasks of their own.
Lengths, checksums of the index, and digests of payloads are verified; a damaged package raises.

Odd input: a null html is an empty payload; a null url gives a record without a target. A page with a null id is a record whose id
is empty, and comes before all others when the largest id is sought. Of rows with the same id and the same payload one is the response (that with the
largest url, and any of those that are alike in that too), and the others revisit that id. Columns other than the three are not read,
whatever their names. An empty table writes no package and reads as an empty table. A payload, however long, is one record, held whole by the task
that writes or reads it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import os
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.llm.tasks import map_rows
from creditloom.llm.token_records import _place
from creditloom.runtime import materialise, scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: An archive's size from which a package is closed, and the most that is fetched at once unless a single record is longer.
PACKAGE_BYTES, READ_BYTES = 1 << 30, 1 << 22
#: The end record may be followed by a comment of so many bytes.
TAIL_BYTES = 22 + 20 + 65_535
FULL_16, FULL_32 = 0xFFFF, 0xFFFFFFFF
MANIFEST = "part int, path string, n_records bigint"
# fixed values: names of the format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


# ---------------------------------------------------------------- ZIP directories


class Member(NamedTuple):
    """A file of a package, as its central directory describes it."""

    name: str
    stored: bool
    crc: int
    packed: int
    size: int
    header: int


def _zip64_fields(extra: bytes, wanted: int) -> list[int]:
    """The first ``wanted`` numbers of the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return list(struct.unpack_from(f"<{wanted}Q", extra, at + 4))
        at += 4 + length
    raise ValueError("a directory entry lacks its ZIP64 field")


def read_directory(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """The members of a package of ``size`` bytes; ``read(offset, length)`` gives its bytes."""
    tail_at = max(0, size - TAIL_BYTES)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    # a comment may hold the mark as well: the end record's comment reaches to the end of the file
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("not a ZIP package: no end record")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if FULL_16 == count or FULL_32 in (length, start):
        locator = tail[end - 20 : end] if end >= 20 else b""
        if locator[:4] == b"PK\x06\x07":
            record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 end record is damaged")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, members = read(start, length), 0, []
    while at < len(directory):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        flags, method, _, _, crc, packed, full, n_name, n_extra, n_comment, _, _, _, header = struct.unpack_from("<HHHHIIIHHHHHII", directory, at + 8)
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        numbers = [full, packed, header]
        missing = [k for k, value in enumerate(numbers) if value == FULL_32]
        if missing:
            for k, value in zip(missing, _zip64_fields(extra, len(missing))):
                numbers[k] = value
        members.append(Member(name, method == 0, crc, numbers[1], numbers[0], numbers[2]))
        at += 46 + n_name + n_extra + n_comment
    if len(members) != count:
        raise ValueError("the central directory misses members")
    return members


def locate(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where the bytes of a stored member start in the package."""
    if not member.stored or member.packed != member.size:
        raise ValueError(f"{member.name} is compressed, not stored")
    header = read(member.header, 30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError(f"{member.name} has no local header")
    n_name, n_extra = struct.unpack_from("<HH", header, 26)
    return member.header + 30 + n_name + n_extra


# ---------------------------------------------------------------- WARC records


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, is_response: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if is_response else http
    fields = [("WARC-Type", "response" if is_response else "revisit"), ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if not is_response:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _uri(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record; a response whose payload does not fit its digest raises."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    warc = _fields(head)
    length = int(warc["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length is damaged")
    http_head, _, payload = rest[:length].partition(b"\r\n\r\n")
    http = _fields(http_head)
    if warc["warc-type"] == "response" and f"sha1:{base32_sha1(payload)}" != warc["warc-payload-digest"]:
        raise ValueError("a payload does not fit its digest")
    return warc, http, payload


# ---------------------------------------------------------------- writing


def _responses(pages: DataFrame, least: int) -> DataFrame:
    """``pages`` (page_id, url, payload, digest) with is_response and refers_to."""
    same = F.col("digest").isNotNull() & (F.octet_length("payload") >= least)
    order = F.struct(F.col("page_id").isNotNull(), "page_id", F.col("url").isNotNull(), "url")
    # payloads met once need no partner; one row per payload met more often: its winner, and how many rows are exactly like the winner
    copies = pages.where(same).groupBy("digest", "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
    groups = copies.groupBy("digest").agg(F.max(F.struct(order.alias("rank"), "n", "page_id", "url")).alias("best"), F.sum("n").alias("n_rows"))
    winners = materialise(groups.where("n_rows > 1").select("digest", F.col("best.page_id").alias("winner"), F.col("best.url").alias("winner_url"), F.col("best.n").alias("alike")), "warc-winners")
    partner = winners.select(F.col("digest").alias("_digest"), "winner", "winner_url", "alike")
    joined = pages.join(partner, same & (F.col("digest") == F.col("_digest")), "left")
    repeated = F.col("_digest").isNotNull()
    wins = F.col("page_id").eqNullSafe(F.col("winner")) & F.col("url").eqNullSafe(F.col("winner_url"))
    columns = ["page_id", "url", "payload", "digest"]
    tied = repeated & wins & (F.col("alike") > 1)
    if winners.where("alike > 1").isEmpty():
        return joined.select(*columns, (~repeated | wins).alias("is_response"), F.when(repeated & ~wins, F.col("winner")).alias("refers_to"))
    # rows that are alike in everything: one of them answers
    one = F.row_number().over(Window.partitionBy("digest").orderBy("page_id")) == 1
    alone = joined.where(~tied).select(*columns, (~repeated | wins).alias("is_response"), F.when(repeated & ~wins, F.col("winner")).alias("refers_to"))
    alike = joined.where(tied).withColumn("is_response", one)
    return alone.unionByName(alike.select(*columns, "is_response", F.when(~F.col("is_response"), F.col("winner")).alias("refers_to")))


class _Plain:
    """An output stream that can only be written to, whatever else the store's own stream offers."""

    def __init__(self, stream) -> None:
        self.write, self.flush = stream.write, stream.flush


class Package:
    """A ZIP package that is written record by record; its index, some 100 bytes a record, is held until the archive is closed."""

    def __init__(self, stream) -> None:
        self.zip = zipfile.ZipFile(_Plain(stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.index: list[str] = []
        self.at = 0

    def add(self, record: bytes, kind: str, page_id: int | None) -> None:
        data = gzip.compress(record, 6, mtime=0)
        self.member.write(data)
        self.index.append(json.dumps({"offset": self.at, "length": len(data), "type": kind, "id": page_id}) + "\n")
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as out:
            for line in self.index:
                out.write(line.encode())
        self.zip.close()


def write(
    df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None, least_shared: int = 0,
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write the pages as packages below ``folder``; returns the manifest. Payloads under ``least_shared`` bytes are never revisits."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b""))
    pages = df.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    marked = _responses(pages.withColumn("digest", F.unhex(F.sha1("payload"))), least_shared)

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        part, package, count = TaskContext.get().partitionId(), None, 0
        out, uri = None, ""
        for key, target, body, digest, is_response, refers_to in rows:
            if package is None:
                uri, count = f"{folder}/part-{part:05d}-{uuid.uuid4().hex}.zip", 0
                files, path = _place(uri)
                files.create_dir(os.path.dirname(path), recursive=True)
                out = files.open_output_stream(path)
                package = Package(out)
            name = base64.b32encode(digest).decode()
            package.add(record_bytes(key, target, body, name, is_response, refers_to), "response" if is_response else "revisit", key)
            count += 1
            if package.at >= package_bytes:
                package.close()
                out.close()
                yield part, uri, count
                package = None
        if package is not None:
            package.close()
            out.close()
            yield part, uri, count

    return materialise(map_rows(marked, MANIFEST, work), "warc-manifest")


# ---------------------------------------------------------------- reading


class Ranges:
    """Ranged reads of one package."""

    def __init__(self, uri: str) -> None:
        files, path = _place(uri)
        self.file = files.open_input_file(path)
        self.size = self.file.size()

    def __call__(self, offset: int, length: int) -> bytes:
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise ValueError("a package ends too early")
        return data


def blocks(manifest: DataFrame) -> DataFrame:
    """Ranges to fetch (path, start, length, sizes of the gzip members inside), from the packages' directories and indexes."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (uri,) in rows:
            read = Ranges(uri)
            members = {member.name: member for member in read_directory(read, read.size)}
            base, index_at = locate(read, members[ARCHIVE]), locate(read, members[INDEX])
            crc, left, at, carry = 0, members[INDEX].size, index_at, b""
            start, total, sizes = base, 0, []
            while left:
                piece = read(at, min(left, READ_BYTES))
                at, left, crc = at + len(piece), left - len(piece), zlib.crc32(piece, crc)
                *lines, carry = (carry + piece).split(b"\n")
                for line in lines:
                    entry = json.loads(line)
                    if base + entry["offset"] != start + total:
                        raise ValueError("the index leaves a gap")
                    if sizes and total + entry["length"] > READ_BYTES:
                        yield uri, start, total, sizes
                        start, total, sizes = base + entry["offset"], 0, []
                    sizes.append(entry["length"])
                    total += entry["length"]
            if crc != members[INDEX].crc or start + total != base + members[ARCHIVE].size:
                raise ValueError("the index is damaged")
            if sizes:
                yield uri, start, total, sizes

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_rows(manifest.select("path").repartition(spread, "path"), "path string, start bigint, length bigint, sizes array<int>", work)


def read(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the manifest's packages: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the payload on request.

    Bytes and digest are those of the whole payload for revisits too; their own payload is null.
    """
    extra = ", payload binary" if with_payload else ""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        opened, package = "", None
        for uri, start, length, sizes in rows:
            if uri != opened:
                opened, package = uri, Ranges(uri)
            data, at = package(start, length), 0
            for size in sizes:
                warc, http, payload = parse_record(gzip.decompress(data[at : at + size]))
                at += size
                kind = warc["warc-type"]
                refers = _page(warc["warc-refers-to"]) if kind == "revisit" else None
                found = (
                    _page(warc["warc-record-id"]), warc.get("warc-target-uri"), int(http["content-length"]),
                    warc["warc-payload-digest"].removeprefix("sha1:"), kind, refers,
                )
                yield (*found, payload if kind == "response" else None) if with_payload else found

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = blocks(manifest).repartition(spread, "path", "start")
    schema = f"page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint{extra}"
    return map_rows(ranges, schema, work)
