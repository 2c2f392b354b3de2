"""Token ids in binary shards that can be read by document.

A shard holds the ids of consecutive documents as little-endian unsigned 32-bit integers, cut into
independent zstandard frames of a fixed number of ids, each with its own checksum. Behind them stand a
skippable frame with the documents (key, number of ids) and, as the last thing in the file, a
skippable frame with the seek table of the public zstandard seekable format (sizes and checksum of each
frame). A reader takes the tables from the end of the file and decompresses the frames of the documents it wants.

Documents are dealt to tasks by ranges of their key, so the shards in order hold them in ascending order of the
key (null first; rows with equal keys by the hash of their text). A task writes its shard under a name of its own
attempt and returns a row for the manifest; only shards in the manifest count, so a lost or repeated
task does no harm. Null text is empty, and an empty one still has its end id. No documents: no shard.

Text is encoded chunk by chunk between ASCII blanks: the tokenizer's pattern matches no white space, so
this gives the ids of the whole text, and a chunk that comes again is looked up, once for a batch of rows.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabveil.llm.common import content, once_per_worker, stage

# Numbers of the zstandard container and its seekable format.
SKIPPABLE, DOCUMENTS, SEEK_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1

FRAME_IDS = 1 << 16
KNOWN_WORDS, KNOWN_OTHERS = 800_000, 100_000
WORDS_AT_ONCE = 500
ROWS_AT_ONCE, CHUNKS_AT_ONCE = 1000, 1 << 20
# The tokenizer's mark of a word's last token; lines of letters of ASCII and Latin-1, then ASCII punctuation.
WORD_END = "</w>"
LATIN_WORDS = re.compile(r"^(?:([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]*+)([!-/:-@\[-`{-~]*+)$|.*$)", re.MULTILINE)
MANIFEST = "shard int, path string, n_docs long, n_ids long, n_bytes long"


def open_folder(uri: str):
    """(file system, path) of a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def lines_of(values: pa.Array) -> list[str]:
    """The values, which have no line ends, as strings: far faster than one by one."""
    if not len(values):
        return []
    return pc.binary_join(pa.ListArray.from_arrays([0, len(values)], values), "\n")[0].as_py().split("\n")


class Encoder:
    """Ids of a text as bytes; words and other chunks seen before are kept, up to a bound.

    A chunk of Latin letters and then ASCII punctuation is two words to the tokenizer's pattern, whatever stands around them.
    Such words are encoded many at a time with blanks between, and cut where a token ends a word. Other chunks go one by one.
    """

    def __init__(self, tokenizer_json: bytes, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer_json)
        self.end = struct.pack("<I", end_id)
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def ids_of(self, texts: list[str]) -> Iterator[np.ndarray]:
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(e.ids, "<u4")

    def learn_words(self, new: list[str]) -> None:
        for at in range(0, len(new), WORDS_AT_ONCE):
            block = new[at : at + WORDS_AT_ONCE]
            (ids,) = self.ids_of([" ".join(block)])
            cuts = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            if len(cuts) == len(block) and cuts[-1] == len(ids):
                raw = ids.tobytes()
                self.words.update((w, raw[4 * i : 4 * j]) for w, i, j in zip(block, [0, *cuts], cuts))
            else:
                self.words.update(zip(block, (x.tobytes() for x in self.ids_of(block))))

    def parts_of(self, chunks: list[str]) -> list[bytes]:
        """Two parts of each chunk, one after the other: a chunk of letters and punctuation has those, another one itself and nothing."""
        # A match for each line, without groups for other chunks; no chunk has a line end.
        found = LATIN_WORDS.findall("\n".join(chunks)) if chunks else []
        # Lower case keeps the number of these letters.
        letters = "\n".join([x for x, _ in found]).lower().split("\n") if found else []
        marks = [y for _, y in found]
        words, known = self.words, self.known
        self.learn_words(list(set(letters).union(marks).difference(words)))
        parts = [b""] * (2 * len(chunks))
        parts[::2] = map(words.__getitem__, letters)
        parts[1::2] = map(words.__getitem__, marks)
        others = [k for k, (x, y) in enumerate(found) if not (x or y) and chunks[k]]
        new = [chunks[k] for k in others if chunks[k] not in known]
        for at in range(0, len(new), 20_000):
            block = new[at : at + 20_000]
            known.update(zip(block, (x.tobytes() for x in self.ids_of(block))))
        for k in others:
            parts[2 * k] = known[chunks[k]]
        return parts

    def encode(self, texts: pa.Array) -> list[bytes]:
        chunks = pc.ascii_split_whitespace(texts)  # an empty chunk stands before or after a blank at an end
        numbered = chunks.flatten().dictionary_encode()
        if len(self.known) > KNOWN_OTHERS:
            self.known.clear()
        if len(self.words) > KNOWN_WORDS:
            self.words = {"": b""}
        raw = self.parts_of(lines_of(numbered.dictionary))
        table = np.frombuffer(b"".join(raw), "<u4")
        sizes = np.fromiter(map(len, raw), "i8", len(raw)).reshape(-1, 2).sum(axis=1) // 4
        starts = np.cumsum(sizes) - sizes
        which = numbered.indices.to_numpy()
        parts = []
        for at in range(0, len(which), CHUNKS_AT_ONCE):
            block = which[at : at + CHUNKS_AT_ONCE]
            counts = sizes[block]
            # A chunk's ids stand together in the table.
            places = np.repeat(starts[block] - np.cumsum(counts) + counts, counts)
            parts.append(table[places + np.arange(len(places))].tobytes())
        ids = b"".join(parts)
        before = np.concatenate([[0], np.cumsum(4 * sizes[which])])
        offsets = chunks.offsets.to_numpy()
        cuts = before[offsets - offsets[0]].tolist()
        return [ids[a:b] + self.end for a, b in zip(cuts, cuts[1:])]


class ShardWriter:
    def __init__(self, out, frame_ids: int):
        import zstandard

        self.out, self.most = out, frame_ids * 4
        self.zstd = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
        self.buffer, self.frames, self.keys, self.counts, self.bytes = bytearray(), [], [], [], 0

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.counts.append(len(ids) // 4)
        self.buffer += ids
        while len(self.buffer) >= self.most:
            self.flush(self.most)

    def flush(self, size: int) -> None:
        import xxhash

        raw = bytes(self.buffer[:size])
        del self.buffer[:size]
        packed = self.zstd.compress(raw)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.write(packed)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.buffer:
            self.flush(len(self.buffer))
        valid = np.array([k is not None for k in self.keys], "u1")
        keys = np.array([k or 0 for k in self.keys], "<i8")
        index = self.zstd.compress(
            struct.pack("<Q", len(keys)) + keys.tobytes() + np.array(self.counts, "<u8").tobytes() + valid.tobytes()
        )
        self.write(struct.pack("<II", DOCUMENTS, len(index) + 8) + index + struct.pack("<Q", len(index)))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.write(
            struct.pack("<II", SKIPPABLE, len(table) + 9) + table + struct.pack("<IBI", len(self.frames), 0x80, SEEK_MAGIC)
        )


class ShardReader:
    """Reads the tables at the end of a shard, then single frames."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        n_frames, flags, magic = struct.unpack("<IBI", self.at(size - 9, 9))
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        start = size - 9 - 12 * n_frames
        table = np.frombuffer(self.at(start, 12 * n_frames), "<u4").reshape(-1, 3).astype("i8")
        self.sizes, self.sums = table[:, :2], table[:, 2]
        self.packed_at = np.concatenate([[0], np.cumsum(self.sizes[:, 0])])
        self.raw_at = np.concatenate([[0], np.cumsum(self.sizes[:, 1])])
        (length,) = struct.unpack("<Q", self.at(start - 8 - 8, 8))
        index = self.zstd.decompress(self.at(start - 16 - length, length))
        (n,) = struct.unpack_from("<Q", index)
        keys, self.counts = np.frombuffer(index, "<i8", n, 8), np.frombuffer(index, "<u8", n, 8 + 8 * n).astype("i8")
        valid = np.frombuffer(index, "u1", n, 8 + 16 * n)
        self.keys = [int(k) if v else None for k, v in zip(keys, valid)]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def at(self, offset: int, size: int) -> bytes:
        self.file.seek(int(offset))
        data = self.file.read(int(size))
        if len(data) != size:
            raise ValueError("the file ends early")
        return data

    def frame(self, i: int) -> bytes:
        import xxhash

        raw = self.zstd.decompress(self.at(self.packed_at[i], self.sizes[i, 0]))
        if len(raw) != self.sizes[i, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"frame {i} is damaged")
        return raw

    def document(self, n: int) -> bytes:
        """The ids of the n-th document, from the frames that hold them."""
        return b"".join(self.parts(n, {}))

    def parts(self, n: int, last: dict[int, bytes]) -> Iterator[bytes]:
        """The same, part by part; ``last`` keeps the frame read last for the next document."""
        begin, end = 4 * int(self.starts[n]), 4 * int(self.starts[n + 1])
        i = int(np.searchsorted(self.raw_at, begin, "right")) - 1
        while begin < end:
            if i not in last:
                last.clear()
                last[i] = self.frame(i)
            low, high = int(self.raw_at[i]), int(self.raw_at[i + 1])
            yield last[i][begin - low : min(end, high) - low]
            begin, i = min(end, high), i + 1


def write_shards(
    docs: DataFrame, folder: str, tokenizer_json: bytes, end_id: int, key: str = "doc_id", text: str = "text",
    frame_ids: int = FRAME_IDS,
) -> DataFrame:
    """Write all documents below ``folder`` (a URI that all executors reach); return the manifest."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("key"), content(text).alias("body"))
    rows = rows.withColumn("mark", F.xxhash64("body"))
    ordered = rows.repartitionByRange(parts, "key", "mark").sortWithinPartitions("key", "mark")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = out = writer = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                if writer is None:
                    files, base = open_folder(folder)
                    files.create_dir(base, recursive=True)
                    shard = TaskContext.get().partitionId()
                    path = f"{base}/ids-{shard:06d}-{uuid.uuid4().hex}.zst"
                    out = files.open_output_stream(path, compression=None)
                    writer = ShardWriter(out, frame_ids)
                    name = f"encoder_{zlib.crc32(tokenizer_json)}_{end_id}"
                    encoder = once_per_worker(name, lambda: Encoder(tokenizer_json, end_id))
                for k, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1))):
                    writer.add(k, ids)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "path": [f"{folder.rstrip('/')}/{path.rsplit('/', 1)[1]}"],
                "n_docs": [len(writer.counts)], "n_ids": [sum(writer.counts)], "n_bytes": [writer.bytes],
            })

    return stage(ordered.select("key", "body").mapInArrow(write, MANIFEST), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """(shard, doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids of all documents before it, in all shards.
    """
    # One row for each shard.
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("before", F.coalesce(before, F.lit(0).cast("long")))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                base, name = row["path"].rsplit("/", 1)
                files, path = open_folder(base)
                with files.open_input_file(f"{path}/{name}") as file:
                    shard, last, sums = ShardReader(file, row["n_bytes"]), {}, []
                    for n in range(len(shard.keys)):
                        crc = 0
                        for part in shard.parts(n, last):
                            crc = zlib.crc32(part, crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([row["shard"]] * len(sums), pa.int32()),
                        "doc_id": pa.array(shard.keys, pa.int64()),
                        "start": pa.array(shard.starts[:-1] + row["before"], pa.int64()),
                        "n_tokens": pa.array(shard.counts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
                    })

    schema = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.repartition(parts, "shard").mapInArrow(check, schema)


def read_ids(manifest: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ids) of the documents named in ``wanted``; only their frames are decompressed."""
    index = read_shards_index(manifest).join(wanted.select(F.col(key).alias("want")).distinct(), F.col("key") == F.col("want"))
    asked = index.groupBy("path", "n_bytes").agg(F.sort_array(F.collect_list("n")).alias("ns"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                base, name = row["path"].rsplit("/", 1)
                files, path = open_folder(base)
                with files.open_input_file(f"{path}/{name}") as file:
                    shard, last = ShardReader(file, row["n_bytes"]), {}
                    for n in row["ns"]:
                        ids = np.frombuffer(b"".join(shard.parts(n, last)), "<u4").astype("i8")
                        yield pa.RecordBatch.from_pydict({
                            "key": pa.array([shard.keys[n]], pa.int64()),
                            "ids": pa.array([ids], pa.list_(pa.int64())),
                        })

    return asked.mapInArrow(fetch, "key long, ids array<long>").withColumnRenamed("key", key)


def read_shards_index(manifest: DataFrame) -> DataFrame:
    """(path, n_bytes, n, key): the documents of each shard, from its index alone."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                base, name = row["path"].rsplit("/", 1)
                files, path = open_folder(base)
                with files.open_input_file(f"{path}/{name}") as file:
                    keys = ShardReader(file, row["n_bytes"]).keys
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([row["path"]] * len(keys), pa.string()),
                    "n_bytes": pa.array([row["n_bytes"]] * len(keys), pa.int64()),
                    "n": pa.array(range(len(keys)), pa.int64()), "key": pa.array(keys, pa.int64()),
                })

    return manifest.mapInArrow(listed, "path string, n_bytes long, n long, key long")
