"""WARC: a deterministic sharded writer and its reader.

Records are sorted by page id and cut into shards by the payload bytes before them, counted per block of ids, so
the shards depend on the rows alone and not on how they arrive. The prefix sums already are the bounds of a range sort, so
rows go to the task of their shard without a sample of the html; only beyond max_tasks shards does a task get several neighbours. A task writes
each record as its own gzip member and starts a new file when one reaches the size limit. Headers, digests and record
ids are made anew from the payload, so a rerun gives the same bytes.

Of records with equal payloads of at least min_revisit bytes the smallest page id is the response and the others revisit
it. Groups are reduced to (digest, smallest id) before they meet the rows again; only the narrow rows
take part in that join, and the html is shuffled once, beside its decisions.

Files are written under names of the attempt in a folder of temporary files; a manifest lists those of finished tasks;
then they are moved to their final names, which can be repeated at will; the committed manifest is written last. Readers
read what the committed manifest lists, so a lost executor's leftovers are never seen.

A null payload counts as empty. Rows with a null page id come first, in blocks by digest, and are written without that header. Repeated page ids are
separate records; of equal rows of the smallest id the first is the response. A null url leaves its header out. An empty table gives an empty manifest and no
archive. A very long payload is one record of its own file at least; a task holds one payload at a time besides its batch. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, running_sum

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _store(address: str) -> tuple[fs.FileSystem, str]:
    """The store that an address names: file, hdfs, s3, gs and others of Arrow's."""
    return fs.FileSystem.from_uri(address) if "://" in address or address.startswith("file:") else (fs.LocalFileSystem(), address)


def record_id(page_id: int | None, payload_digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{payload_digest}/{copy}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, copy: int) -> bytes:
    """One WARC record, without compression. A revisit has the HTTP headers alone as its block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest, copy)}", f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {_UNSAFE.sub(lambda m: f'%{ord(m[0]):02X}', url)}"]),
        *([] if page_id is None else [f"X-Page-ID: {page_id}"]),
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, 0)}", f"X-Refers-To-Page-ID: {'' if refers_to is None else refers_to}"] if revisit else []),
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member without a time, so equal records are equal bytes."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def decided(pages: DataFrame, id_col: str, payload: str, min_revisit: int) -> DataFrame:
    """(page, digest, first): rows whose payload an earlier or equal page holds; first is the response's id."""
    narrow = pages.select(F.col(id_col).alias("page"), F.sha2(F.col(payload), 256).alias("digest"), F.octet_length(payload).alias("n")).where(F.col("n") >= min_revisit)
    shared = narrow.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("rows")).where("rows > 1").select(F.col("digest").alias("d"), "first")
    return narrow.join(shared, F.col("digest") == F.col("d")).select("page", "digest", "first").distinct()


def _block(block_ids: int) -> Column:
    """Block of neighbouring page ids; null ids, of which there may be many, are cut by digest into 65,536 blocks before all others."""
    return F.coalesce(F.floor(F.col("page") / block_ids), F.lit(-(1 << 62)) + F.conv(F.substring("digest", 1, 4), 16, 10).cast("long"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html", min_revisit: int = 100, shard_bytes: int = 32 << 20, file_bytes: int = 16 << 20, block_ids: int = 256, max_tasks: int = 100_000) -> DataFrame:
    """Write pages as archives below folder; returns the committed manifest (path, records, bytes, sha256)."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url).cast("string").alias("url"), F.coalesce(F.encode(F.col(html).cast("string"), "utf-8"), F.lit(b"")).alias("payload"))
    # shards: payload bytes before each block of ids
    sizes = rows.withColumn("digest", F.sha2("payload", 256)).groupBy(_block(block_ids).alias("b")).agg(F.sum(F.octet_length("payload") + 400).alias("n"))
    before = running_sum(sizes, ["b"], "n", "before")
    shards = materialise(before.select(F.col("b").alias("_b"), F.floor(F.col("before") / shard_bytes).alias("shard")), "shards")
    first = decided(rows, "page", "payload", min_revisit)
    n_shards = (shards.agg(F.max("shard")).first()[0] or 0) + 1  # one number
    n = min(n_shards, max_tasks)
    both = rows.select("page", "url", "payload", F.sha2("payload", 256).alias("digest"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first")).unionByName(
        first.select("page", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", F.lit(0).alias("kind"), "first")
    )
    dealt = both.join(shards, _block(block_ids) == F.col("_b")).drop("_b")
    order = ["shard", F.col("page").asc_nulls_first(), "digest", "kind", F.col("url").asc_nulls_first()]
    dealt = dealt.repartitionById(n, F.floor(F.col("shard") * n / n_shards).cast("int")).sortWithinPartitions(*order)
    attempt = f"{folder}/_temporary/{uuid.uuid4().hex}"

    def run(batches):
        yield from _write_shards(batches, attempt, file_bytes)

    schema = "temporary string, name string, records long, bytes long, sha256 string"
    listed = materialise(dealt.mapInPandas(run, schema), "manifest")

    def commit(batches):
        for b in batches:
            store, _ = _store(folder)
            for temporary, name in zip(b["temporary"], b["name"], strict=True):
                to = f"{folder}/{name}"
                here, there = _store(temporary)[1], _store(to)[1]
                if store.get_file_info(here).type == fs.FileType.File:  # else an earlier attempt of this task moved it
                    store.move(here, there)
                elif store.get_file_info(there).type != fs.FileType.File:
                    raise FileNotFoundError(temporary)
            yield b.assign(path=[f"{folder}/{x}" for x in b["name"]])[["path", "records", "bytes", "sha256"]]

    final = listed.mapInPandas(commit, "path string, records long, bytes long, sha256 string")
    final.write.parquet(f"{folder}/manifest")
    return spark.read.schema("path string, records long, bytes long, sha256 string").parquet(f"{folder}/manifest")


def _write_shards(batches, attempt: str, file_bytes: int):
    """Write the sorted rows of a task; yields a manifest row for each finished file."""
    store, base = _store(attempt)
    store.create_dir(base, recursive=True)
    out, state = None, {}

    def close():
        nonlocal out
        if out is None:
            return None
        out.close()
        out = None
        return pd.DataFrame([(state["temporary"], state["name"], state["records"], state["bytes"], state["sha"].hexdigest())], columns=["temporary", "name", "records", "bytes", "sha256"])

    shard, part, decision, last, copy = None, 0, None, None, 0
    for b in batches:
        for s, page, url, payload, digest, kind, first in zip(b["shard"], b["page"], b["url"], b["payload"], b["digest"], b["kind"], b["first"], strict=True):
            page = None if pd.isna(page) else int(page)
            if kind == 0:
                decision = (page, digest, None if pd.isna(first) else int(first))
                continue
            if s != shard or out is not None and state["bytes"] >= file_bytes:
                if (row := close()) is not None:
                    yield row
                shard, part = s, part + 1 if s == shard else 0
            if out is None:
                name = f"shard-{int(s):08d}-{part:04d}.warc.gz"
                temporary = f"{attempt}/{uuid.uuid4().hex}-{name}"
                out = store.open_output_stream(_store(temporary)[1])
                state = {"temporary": temporary, "name": name, "records": 0, "bytes": 0, "sha": hashlib.sha256()}
            copy = copy + 1 if last == (page, digest) else 0
            last = (page, digest)
            mine = decision if decision is not None and decision[:2] == (page, digest) else None
            revisit = mine is not None and not (mine[2] == page and copy == 0)
            data = gzip_member(record(page, url, bytes(payload), digest, mine[2] if revisit else None, revisit, copy))
            out.write(data)
            state["records"] += 1
            state["bytes"] += len(data)
            state["sha"].update(data)
    if (row := close()) is not None:
        yield row


def members(stream):
    """The records of an archive, one gzip member at a time."""
    d, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            parts.append(d.decompress(chunk))
            chunk = b""
            if d.eof:
                yield b"".join(parts)
                chunk, d, parts = d.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> dict:
    """Headers and payload of a record, with both digests checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(h["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n" or f"sha256:{hashlib.sha256(block).hexdigest()}" != h["WARC-Block-Digest"]:
        raise ValueError("damaged record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
    if h["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload and digest differ")
    number = lambda k: int(h[k]) if h.get(k) else None
    return {"page_id": number("X-Page-ID"), "url": h.get("WARC-Target-URI"), "record_type": h["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID"), "payload": payload, "payload_bytes": size, "payload_digest": digest}


def read(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the listed archives; each file is streamed by one task."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payloads else [])]
    kinds = {"page_id": "long", "url": "string", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long", "payload": "binary"}
    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, arrow[kinds[n]]) for n in names])

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = _store(path)
                rows: list[dict] = []
                held = 0
                with store.open_input_stream(at) as f:
                    for data in members(f):
                        r = parse(data)
                        rows.append({n: r[n] for n in names})
                        held += len(data) if payloads else 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = manifest.select("path")
    n = max(1, min(files.count(), 100_000))
    return files.repartition(n).mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names))


def round_trip(spark: SparkSession, pages: DataFrame, folder: str, **how) -> DataFrame:
    return read(write(pages, folder, **how))
