"""WARC records in ZIP packages: writing, and reading by range.

A package holds stored (uncompressed) members: ``archive/*.warc.gz``, one gzip
member per record, and ``indexes/*.cdxj``, a line per record with its offset
and length. The reader finds the central directory from the end of the file,
through the ZIP64 records where sizes or counts need them, reads the indexes,
cuts the records into byte ranges, and reads each range where it lies in the
package; nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import open_store, partitions_for, work_path, write_once

#: A member is closed beyond this size, and a range read ends beyond that one.
MEMBER_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
LEAST_PAYLOAD = 0
_ID = "urn:page:"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


# ---- ZIP directory ----------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int


def directory(f: pa.NativeFile) -> list[Member]:
    """The members that the central directory lists."""
    end = f.size()
    tail_at = max(0, end - (1 << 16) - 22)
    tail = f.read_at(end - tail_at, tail_at)
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\5\6", 0, at)
    if at < 0:
        raise ValueError("no ZIP directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (size, start):
        locator = f.read_at(20, tail_at + at - 20)
        if locator[:4] == b"PK\6\7":
            record = f.read_at(56, int.from_bytes(locator[8:16], "little"))
            if record[:4] != b"PK\6\6":
                raise ValueError("bad ZIP64 directory record")
            count, size, start = struct.unpack_from("<QQQ", record, 32)
    raw, at, out = f.read_at(size, start), 0, []
    for _ in range(count):
        if raw[at:at + 4] != b"PK\1\2":
            raise ValueError("bad ZIP directory entry")
        method, = struct.unpack_from("<H", raw, at + 10)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        header, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46:at + 46 + n_name].decode("utf-8", "replace")
        extra = raw[at + 46 + n_name:at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: only the values that did not fit, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4:4 + n // 8 * 8]))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + n:]
        out.append(Member(name, method, packed, header))
        at += 46 + n_name + n_extra + n_comment
    return out


def data_start(f: pa.NativeFile, m: Member) -> int:
    """Where a stored member's bytes begin."""
    head = f.read_at(30, m.header)
    if head[:4] != b"PK\3\4" or m.method != 0:
        raise ValueError(f"member {m.name} is not stored")
    return m.header + 30 + sum(struct.unpack_from("<HH", head, 26))


# ---- records ----------------------------------------------------------------

def _clean(uri: str) -> str:
    return quote(uri, safe="%/:=&?~#+!$,;'@()*[]")


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {len(block)}"]
    raw = "WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n"
    c = zlib.compressobj(3, zlib.DEFLATED, 31)
    return c.compress(raw.encode() + block + b"\r\n\r\n") + c.flush()


def records(f: pa.NativeFile, lo: int, hi: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the gzip members from byte lo to hi."""
    at, left = lo, b""
    while at < hi or left:
        d, parts = zlib.decompressobj(31), []
        while not d.eof:
            if not left:
                if at >= hi:
                    raise ValueError("cut WARC record")
                left = f.read_at(min(1 << 20, hi - at), at)
                at += len(left)
            parts.append(d.decompress(left))
            left = d.unused_data
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        yield fields, rest[:int(fields["Content-Length"])]


# ---- writing ----------------------------------------------------------------

class _Sink:
    """What zipfile needs of an output that cannot seek."""

    def __init__(self, out):
        self.out = out

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        pass


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_packages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   folder: str | None = None, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Write a record per row and return the manifest (path, n_records). Of the
    rows with equal payloads of ``least_payload`` bytes or more, those of the
    largest id are responses, the others revisits of it. Each task writes a file
    of a new name; only files whose task Spark committed are in the manifest."""
    spark = pages.sparkSession
    folder = folder or work_path(spark, "packages")
    fs, path = open_store(folder)
    fs.create_dir(path, recursive=True)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload")) \
        .withColumn("sha", F.sha1("payload"))
    shared = write_once(rows.where(F.octet_length("payload") >= least_payload).groupBy("sha")
                        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null")
                        .select(F.col("sha").alias("_sha"), "keeper"), "warc-shared")
    typed = rows.join(shared, (rows["sha"] == shared["_sha"]) & (F.octet_length("payload") >= least_payload), "left") \
        .select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        uri, out, z, n, members = "", None, None, 0, 0
        member, at, index = None, 0, []

        def close_member() -> None:
            member.close()
            info = zipfile.ZipInfo(f"indexes/index-{members:05d}.cdxj", (1980, 1, 1, 0, 0, 0))
            z.writestr(info, "".join(index))

        for batch in batches:
            for page, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if z is None:
                    uri = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.wacz"
                    fs, path = open_store(uri)
                    out = fs.open_output_stream(path)
                    z = zipfile.ZipFile(_Sink(out), "w", zipfile.ZIP_STORED, allowZip64=True)
                if member is not None and at > MEMBER_BYTES:
                    close_member()
                    members, member = members + 1, None
                if member is None:
                    member, at, index = z.open(zipfile.ZipInfo(f"archive/data-{members:05d}.warc.gz", (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True), 0, []
                body = payload.encode("utf-8", "surrogatepass")
                fields = [("WARC-Record-ID", f"<{_ID}{'null' if page is None else page}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
                          ("WARC-Payload-Digest", f"sha1:{_digest(body)}"), ("Content-Type", "application/http; msgtype=response")]
                if url is not None:
                    fields.append(("WARC-Target-URI", _clean(url)))
                block = _HTTP.format(len(body)).encode()
                if refers is not None:
                    fields += [("WARC-Refers-To", f"<{_ID}{refers}>"),
                               ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                else:
                    block += body
                raw = _record("response" if refers is None else "revisit", fields, block)
                member.write(raw)
                entry = {"url": url, "offset": at, "length": len(raw), "filename": f"data-{members:05d}.warc.gz"}
                index.append(f"{quote(url or '-')} 19700101000000 {json.dumps(entry)}\n")
                at, n = at + len(raw), n + 1
        if z is not None:
            close_member()
            z.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([n])], names=["path", "n_records"])

    return write_once(typed.mapInArrow(run, "path string, n_records long"), "warc-manifest")


# ---- reading ----------------------------------------------------------------

def read_packages(manifest: DataFrame) -> DataFrame:
    """One row per record of the packages at ``path``: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url. A response's digest is made
    from its payload and must equal the recorded one. Members without an index
    line are read as one range. A revisit's payload size is the content length
    of the HTTP head that it keeps."""
    n = partitions_for(manifest.sparkSession) * 2

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = open_store(uri)
                with fs.open_input_file(path) as f:
                    listed = {m.name: m for m in directory(f)}
                    archives = {k.rpartition("/")[2]: m for k, m in listed.items() if k.startswith("archive/")}
                    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in archives}
                    for k, m in listed.items():
                        if k.startswith("indexes/"):
                            for line in f.read_at(m.size, data_start(f, m)).decode().splitlines():
                                entry = json.loads(line.split(" ", 2)[2])
                                spans[entry["filename"]].append((entry["offset"], entry["offset"] + entry["length"]))
                    out = []
                    for k, m in archives.items():
                        base, run = data_start(f, m), None
                        for lo, hi in sorted(spans[k]) or [(0, m.size)]:
                            if run and lo == run[1] and hi - run[0] <= RANGE_BYTES:
                                run = (run[0], hi)
                                continue
                            if run:
                                out.append((base + run[0], base + run[1]))
                            run = (lo, hi)
                        out.append((base + run[0], base + run[1]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([uri] * len(out)), pa.array([x[0] for x in out]), pa.array([x[1] for x in out])],
                                                     names=["path", "lo", "hi"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
        for batch in batches:
            for uri, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = open_store(uri)
                rows = []
                with fs.open_input_file(path) as f:
                    for head, block in records(f, lo, hi):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = head["WARC-Payload-Digest"].partition(":")[2]
                        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                        if head["WARC-Type"] == "response" and (len(payload) != size or _digest(payload) != digest):
                            raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                        page, refers = (None if x is None or x == "null" else int(x) for x in (
                            v and v[1:-1].removeprefix(_ID) for v in (head["WARC-Record-ID"], head.get("WARC-Refers-To"))))
                        rows.append((page, size, digest, head["WARC-Type"], refers, head.get("WARC-Target-URI")))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows), schema)] if rows
                                                 else [pa.array([], t.type) for t in schema], schema=schema)

    ranges = manifest.select("path").repartition(n, "path").mapInArrow(split, "path string, lo long, hi long")
    return ranges.repartition(n, "path", "lo") \
        .mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")
