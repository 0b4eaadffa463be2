"""Deterministic sharded WARC writer and its reader.

Pages are dealt to parts, which are ranges of page_id cut by payload size; a part
writes its records in page_id order to files that roll at a compressed size. Headers,
record ids and digests are made anew from the payload, so a repeated task writes the
same bytes. Each attempt of a task writes files of temporary names that are its own; the list of files comes from
the attempts that Spark counts, and a second job gives just these their names (it may be repeated: a file that has its name
stays). The manifest table, written last, names the files that count.

Defined results: null html is an empty payload; null page_ids come last, in parts of
their own; of records with equal payload the first by page_id (none last), url and place is the response, whatever the others' ids;
null url becomes a urn. Rows of a page_id (or of none) too many for one part are dealt by their place in the input.
Extra columns are ignored. An empty table makes no file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, drop_paths, drop_table, fresh_path, from_ipc, hot_keys, open_fs, packed, parallelism, ranges, salted_join, stage_table, to_ipc

NAMESPACE = uuid.UUID("8f3c2f8e-5d0b-5c1e-9a52-2f3d9d0a7c11")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, part long, records long, bytes long, sha1 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, date: str, own: str, revisits: tuple[int | None] | None = None) -> bytes:
    """One gzip member. `own` names the record; `revisits`: the page_id of the response that this record revisits, or None for a response."""
    page = "" if page_id is None else str(page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [
        ("WARC-Type", "response" if revisits is None else "revisit"), ("WARC-Record-ID", record_id(own)), ("WARC-Date", date),
        ("WARC-Target-URI", _clean(url) if url else f"urn:page:{page or 'none'}"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"), ("Page-Id", page), ("Payload-Length", str(len(payload))),
    ]
    if revisits is not None:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(f"response/{digest}")), ("Refers-To-Page", "" if revisits[0] is None else str(revisits[0]))]
    return _member(headers, http + (payload if revisits is None else b""))


class _Files:
    """The rolling files of one part, under names that no other attempt uses."""

    def __init__(self, out_dir: str, part: int, roll: int, date: str):
        self.fs, self.dir = open_fs(out_dir)
        self.part, self.roll, self.date, self.rows, self.out, self.attempt = part, roll, date, [], None, uuid.uuid4().hex
        self.fs.create_dir(f"{self.dir}/_temporary", recursive=True)

    def add(self, member: bytes) -> None:
        if self.out is not None and self.bytes + len(member) > self.roll:
            self.close()
        if self.out is None:
            self.name = f"part-{'' if self.part >= 0 else 'none-'}{abs(self.part):08d}-{len(self.rows):05d}.warc.gz"
            self.temp = f"_temporary/{self.name}.{self.attempt}"
            self.out, self.bytes, self.records, self.sha = self.fs.open_output_stream(f"{self.dir}/{self.temp}", compression=None), 0, 0, hashlib.sha1()
            self._put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(f"file/{self.name}")), ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(member)
        self.records += 1

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.rows.append({"file": self.name, "part": self.part, "records": self.records, "bytes": self.bytes, "sha1": self.sha.hexdigest(), "temp": self.temp})


def name_files(written: DataFrame, out_dir: str) -> DataFrame:
    """The manifest of the written files, each given its name; safe to run again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where, folder = open_fs(out_dir)
        for batch in batches:
            for name, temp, size in zip(*(batch.column(c).to_pylist() for c in ("file", "temp", "bytes"))):
                source, target = f"{folder}/{temp}", f"{folder}/{name}"
                if where.get_file_info(target).size != size:
                    if where.get_file_info(target).type != fs.FileType.NotFound:
                        where.delete_file(target)
                    try:
                        where.move(source, target)
                    except OSError:
                        if where.get_file_info(target).size != size:  # else another attempt was here first
                            raise
            yield batch.select(["file", "part", "records", "bytes", "sha1"])

    return written.mapInArrow(run, MANIFEST)


def write_archives(pages: DataFrame, out_dir: str | None = None, roll: int = 32 << 20, part_bytes: int = 64 << 20, min_payload: int = 0, date: str = "2000-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """Write all pages; returns the folder and its manifest, the table `_manifest` in it."""
    spark = pages.sparkSession
    out_dir = (out_dir or fresh_path(spark, "warc")).rstrip("/")
    tasks = parallelism(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    size = F.octet_length(F.coalesce("html", F.lit(""))) + F.lit(400)
    total = pages.agg(F.sum(size)).first()[0] or 0
    parts = ranges(pages, "page_id", size, min(part_bytes, max(1 << 20, total / (4 * tasks))))

    def gather(table: pa.Table) -> pa.Table:
        """A part's rows in the order of their records, and what the others must know of them."""
        whole = from_ipc(table["rows"].to_pylist())
        shas = [hashlib.sha1(p).digest() for p in binaries(whole["html"].combine_chunks())]
        whole = whole.append_column("sha1", pa.array(shas, pa.binary())).sort_by([("page_id", "ascending"), ("sha1", "ascending"), ("url", "ascending")])
        sizes = pa.compute.binary_length(whole["html"].cast(pa.large_binary()))
        thin = pa.StructArray.from_arrays([whole["page_id"].combine_chunks(), whole["sha1"].combine_chunks(), sizes.combine_chunks().cast(pa.int64())], names=["page_id", "sha1", "size"])
        return pa.table({"part": table["part"].slice(0, 1), "rows": pa.array([to_ipc(whole)], pa.binary()), "thin": pa.array([thin.to_pylist()], pa.list_(thin.type))})

    packs = packed(rows, parts, "page_id", "salt").groupBy("part").applyInArrow(gather, "part long, rows binary, thin array<struct<page_id:long,sha1:binary,size:long>>")
    packs = stage_table(packs, "page-packs")
    thin = packs.select("part", F.posexplode("thin").alias("at", "row")).select("part", "at", "row.*").where(F.col("size") >= min_payload)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", (F.col("part") < 0).alias("last"), "part", "at")
    shared = stage_table(thin.groupBy("sha1").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-payloads")
    hot = hot_keys(shared, "sha1", "n", thin.count(), 4 * tasks)
    again = salted_join(thin.withColumn("by", F.xxhash64("part", "at")), shared.drop("n"), "sha1", hot, tasks, "by")
    again = again.where("part <> first.part OR at <> first.at").select("part", "at", F.col("first.page_id").alias("first"))

    def write(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        first = dict(zip(right["at"].to_pylist(), right["first"].to_pylist()))
        files = _Files(out_dir, key[0].as_py(), roll, date)
        for blob in left["rows"].to_pylist():
            table = from_ipc([blob])
            for at, (page, url, payload, sha) in enumerate(zip(table["page_id"].to_pylist(), table["url"].to_pylist(), binaries(table["html"].combine_chunks()), table["sha1"].to_pylist())):
                digest, told = base64.b32encode(sha).decode(), (first[at],) if at in first else None
                referred = told is None and len(payload) >= min_payload  # the one response of its payload
                files.add(record(page, url, payload, digest, date, f"response/{digest}" if referred else f"{files.part}/{at}", told))
            files.close()
        return pa.Table.from_pylist(files.rows, schema=pa.schema([("file", pa.string()), ("part", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string()), ("temp", pa.string())]))

    written = stage_table(packs.select((F.col("part") + 0).alias("part"), "rows").groupBy("part").cogroup(again.groupBy("part")).applyInArrow(write, MANIFEST + ", temp string"), "warc-files")
    name_files(written, out_dir).write.parquet(f"{out_dir}/_manifest")
    drop_paths(spark, [f"{out_dir}/_temporary"])
    for table in (packs, shared, written):
        drop_table(table)
    return out_dir, spark.read.schema(MANIFEST).parquet(f"{out_dir}/_manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 16)
        rest = b""
        if not data:
            if any(parts):
                raise ValueError("the archive ends inside a record")
            return
        parts.append(unpack.decompress(data))
        if unpack.eof:
            rest = unpack.unused_data
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block), with the block's digest checked."""
    head, _, body = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])}
    block = body[: int(headers["content-length"])]
    if headers.get("warc-block-digest", "").removeprefix("sha1:") not in ("", base32_sha1(block)):
        raise ValueError(f"wrong block digest in {headers.get('warc-record-id')}")
    return headers, block


def read_archives(out_dir: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the files the manifest names; the digest of a response is made from its payload."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(out_dir)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for member in members(stream):
                        head, block = parse(member)
                        kind = head["warc-type"]
                        if kind == "warcinfo":
                            continue
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            size, digest = len(payload), base32_sha1(payload)
                        else:
                            size, digest = int(head["payload-length"]), head["warc-payload-digest"].removeprefix("sha1:")
                        number = lambda k: int(head[k]) if head.get(k) else None
                        rows.append({"page_id": number("page-id"), "url": head["warc-target-uri"], "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number("refers-to-page"), "file": name})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return manifest.select("file").repartition(4 * parallelism(manifest.sparkSession)).mapInArrow(read, RECORDS)
