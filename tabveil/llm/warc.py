"""WARC archives: written with revisit records, read back by verified record boundaries.

Writing. Of records whose payloads are equal (SHA-1 and length) and have at least ``least`` bytes, the one with
the largest key holds the payload, the others refer to it. Rows that repeat that key hold it as well; a null key
refers to a record that has one. Tasks write files of a bounded size, under names of their own attempt, and
return them for the manifest; files outside the manifest don't count.

Reading. Files are cut into blocks. A task looks for the magic of a record in its block and emits each
candidate with its successor, the offset where its declared length ends. Magic inside payloads gives candidates
too, so the chain from the start of the file decides: within a block a task follows successors to the first
offset beyond the block; across blocks, pointer jumping doubles these steps until everything reachable from
offset 0 is marked. Blocks are then read from their reachable entries only.

Null payload is empty, null address too. No pages: no file, no records. Extra columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import content, small_side, stage
from tabveil.llm.token_frames import open_folder

MAGIC = b"WARC/1.1\r\n"
FILE_BYTES = 256 << 20
BLOCK_BYTES = 16 << 20
BATCH_RECORDS = 1000
ID = "urn:page:"
VISIBLE = "".join(map(chr, range(33, 127)))
ORIGINAL = "X-Original-URI"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, n_bytes long, n_records long"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def http_head(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def record(key: int | None, url: str, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record with its two closing line ends; ``refers_to`` makes it a revisit."""
    head = http_head(len(payload))
    revisit = refers_to is not None
    body = head if revisit else head + payload
    name = f"{ID}{key}" if key is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, sha1_base32(payload))}"
    address = quote(url, safe=VISIBLE)
    fields = [
        f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{name}>",
        f"WARC-Target-URI: {address}", f"WARC-Date: {date}",
        # Percent signs that were there before can't be told from new ones, so a changed address is kept as it was, too.
        *([f"{ORIGINAL}: {base64.b64encode(url.encode()).decode()}"] if address != url else []),
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        *([f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    return MAGIC + "\r\n".join(fields).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
    date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write all pages below ``folder`` (a URI that all executors reach); return the manifest."""
    body = content(payload)
    rows = pages.select(
        F.col(key).cast("long").alias("key"), content(url).alias("url"), body.alias("body"),
        F.concat_ws(":", F.sha1(body), F.octet_length(body).cast("string")).alias("same"),
    )
    groups = rows.where(F.octet_length("body") >= least).groupBy("same").agg(
        F.max("key").alias("first"), F.count(F.lit(1)).alias("n")
    )
    # Only payloads that occur again; broadcast if these are few, else both sides are shuffled.
    again = small_side(groups.where("n > 1 and first is not null").select("same", "first"), "payloads")
    decided = rows.join(again, "same", "left").select(
        "key", "url", "body", F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, n, path = None, 0, 0, ""

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_bytes": [size], "n_records": [n]})

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                payloads = part.column(2).cast(pa.binary()).to_pylist()
                columns = (part.column(0).to_pylist(), part.column(1).to_pylist(), payloads, part.column(3).to_pylist())
                for k, address, data, refers_to in zip(*columns):
                    if out is None:
                        files, base = open_folder(folder)
                        files.create_dir(base, recursive=True)
                        name = f"pages-{uuid.uuid4().hex}.warc"
                        path, size, n = f"{folder.rstrip('/')}/{name}", 0, 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    made = record(k, address, data, refers_to, date)
                    out.write(made)
                    size, n = size + len(made), n + 1
                    if size >= file_bytes:
                        yield closed()
                        out = None
        if out is not None:
            yield closed()

    return stage(decided.mapInArrow(write, MANIFEST), "archives")


def head_at(file, offset: int, end: int) -> tuple[dict[str, str], int] | None:
    """(fields, offset of the block) of the record that starts at ``offset``; None if there is no such record."""
    file.seek(offset)
    data = b""
    while b"\r\n\r\n" not in data:
        more = file.read(min(4096, end - offset - len(data)))
        if not more or not (data + more).startswith(MAGIC[: len(data + more)]):
            return None
        data += more
    head, _, _ = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = dict(line.split(": ", 1) for line in lines if ": " in line)
    if not fields.get("Content-Length", "").isdigit():
        return None
    return fields, offset + len(head) + 4


def successors(file, begin: int, stop: int, end: int) -> list[tuple[int, int]]:
    """(offset, successor) of the candidates that start in [begin, stop)."""
    found, at, chunk = [], begin, 1 << 20
    while at < stop:
        file.seek(at)
        data = file.read(min(chunk + len(MAGIC) - 1, end - at))
        last = min(chunk, stop - at)
        i = data.find(MAGIC)
        while 0 <= i < last:
            head = head_at(file, at + i, end)
            if head and (after := head[1] + int(head[0]["Content-Length"]) + 4) <= end:
                found.append((at + i, after))
            i = data.find(MAGIC, i + 1)
        at += chunk
    return found


def leave(edges: list[tuple[int, int]], stop: int) -> list[tuple[int, int]]:
    """(offset, first offset at or beyond ``stop`` on its chain); chains that break inside are left out."""
    out: dict[int, int] = {}
    for offset, after in reversed(edges):
        exit_at = after if after >= stop else out.get(after)
        if exit_at is not None:
            out[offset] = exit_at
    return sorted(out.items())


def blocks_of(manifest: DataFrame, block: int) -> DataFrame:
    starts = F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(block).cast("long"))
    return manifest.where("n_bytes > 0").select("path", "n_bytes", F.explode(starts).alias("begin"))


def spread(df: DataFrame) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "begin")


def block_exits(manifest: DataFrame, block: int) -> DataFrame:
    """(path, offset, exit) of all candidates."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                base, name = row["path"].rsplit("/", 1)
                files, path = open_folder(base)
                stop = min(row["begin"] + block, row["n_bytes"])
                with files.open_input_file(f"{path}/{name}") as file:
                    exits = leave(successors(file, row["begin"], stop, row["n_bytes"]), stop)
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([row["path"]] * len(exits), pa.string()), "offset": pa.array([a for a, _ in exits], pa.int64()),
                    "exit": pa.array([b for _, b in exits], pa.int64()),
                })

    return spread(blocks_of(manifest, block)).mapInArrow(scan, "path string, offset long, exit long")


def reachable_entries(manifest: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """(path, n_bytes, begin, entry): where the chain from the start of each file enters its blocks."""
    jumps = stage(block_exits(manifest, block), "exits")
    reached = manifest.where("n_bytes > 0").select("path", F.lit(0).cast("long").alias("offset"))
    most = manifest.agg(F.max("n_bytes")).first()[0] or 0
    steps = 1
    while steps * block < most:  # as many doublings as the longest file has
        onward = reached.join(jumps, ["path", "offset"]).select("path", F.col("exit").alias("offset"))
        reached = stage(reached.union(onward).distinct(), "reached")
        after = jumps.select("path", F.col("offset").alias("exit"), F.col("exit").alias("beyond"))
        jumps = stage(
            jumps.join(after, ["path", "exit"], "left").select(
                "path", "offset", F.coalesce("beyond", "exit").alias("exit")
            ),
            "exits",
        )
        steps *= 2
    whole = F.floor(F.col("offset") / F.lit(block)).cast("long") * block
    return reached.join(manifest, "path").where("offset < n_bytes").select(
        "path", "n_bytes", whole.alias("begin"), F.col("offset").alias("entry")
    )


RECORD = "key long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string, payload binary"


def number(name: str | None) -> int | None:
    """The key in a record's name; None for records without one."""
    found = re.fullmatch(rf"<{ID}(-?[0-9]+)>", name or "")
    return int(found[1]) if found else None


def address_of(fields: dict[str, str]) -> str:
    kept = fields.get(ORIGINAL)
    return base64.b64decode(kept).decode() if kept is not None else fields["WARC-Target-URI"]


def read_archives(manifest: DataFrame, block: int = BLOCK_BYTES, payloads: bool = True) -> DataFrame:
    """All records, those of revisits without payload; a payload that doesn't match its digest is an error."""

    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                base, name = row["path"].rsplit("/", 1)
                files, path = open_folder(base)
                at, stop = row["entry"], min(row["begin"] + block, row["n_bytes"])
                with files.open_input_file(f"{path}/{name}") as file:
                    while at < stop:
                        fields, body_at = head_at(file, at, row["n_bytes"])
                        length = int(fields["Content-Length"])
                        file.seek(body_at)
                        head, _, data = file.read(length).partition(b"\r\n\r\n")
                        revisit = fields["WARC-Type"] == "revisit"
                        declared = int(re.search(rb"Content-Length: ([0-9]+)", head)[1])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if not revisit and (len(data) != declared or sha1_base32(data) != digest):
                            raise ValueError(f"record at {at} of {row['path']} is damaged")
                        held.append((
                            number(fields["WARC-Record-ID"]), fields["WARC-Type"], declared, digest, number(fields.get("WARC-Refers-To")),
                            address_of(fields), data if payloads and not revisit else None,
                        ))
                        size += length if payloads else 0
                        at = body_at + length + 4
                        if len(held) == BATCH_RECORDS or size > BLOCK_BYTES:
                            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held), kinds)), names)
                            held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held), kinds)), names)

    entries = spread(reachable_entries(manifest, block))
    return entries.select("path", "n_bytes", "begin", "entry").mapInArrow(parse, RECORD)
