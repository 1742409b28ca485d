"""Token ids in binary files, coded by the adaptive range coder.

``write_token_files`` deals the documents by ranges of ids into files of a
bounded size, in ascending order within and across files; each task writes its
file into a shared folder under a passing name and moves it into place, so a
task that runs again replaces its own file. ``read_token_files`` reads a folder
back with Spark and decodes it.

A file holds, all numbers little-endian:

    magic  "CMRC", version (1 byte), flags (1 byte; 1: ids of 2**16 and more)
    groups of blocks: number of blocks (4 bytes), then for every block the
           number of ids, the bytes of code and the checksum (4 bytes each),
           then the codes
    index  number of documents (8 bytes), their ids (8 bytes each), one byte
           each: 1 if the id is null, numbers of ids (8 bytes each), all three
           zlib-compressed as one
    end    place of the index (8 bytes), its length, its CRC-32 (4 bytes each),
           magic

A checksum is the CRC-32 of a block's ids (4 bytes each) followed by its code.

Edge cases: a null or empty text is its end id alone; a null id sorts first;
rows of equal ids stay separate, ordered by a hash of the text; no rows give no
file or files without documents. A damaged or cut file raises.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benelake.llm import range_coder, text
from benelake.llm.tables import importable, text_bytes
from benelake.llm.tokens import BLOCK, Encoder
from benelake.session import ensure_checkpoint_dir

MAGIC = b"CMRC"
FILE_BYTES = 24 << 20  # text that goes into a file
GROUP_IDS = 6144 * range_coder.BLOCK  # ids that are coded in step: most files are one group


def _group(ids: np.ndarray) -> bytes:
    lengths, codes, sums = range_coder.encode(ids)
    head = np.stack((lengths, [len(c) for c in codes], sums.astype(np.int64)), 1).astype("<u4")
    return struct.pack("<I", len(codes)) + head.tobytes() + b"".join(codes)


class _Writer:
    """Codes ids as they come; ``pieces`` are the file's bytes so far."""

    def __init__(self):
        self.pieces, self.ids, self.waiting = [], [], 0
        self.docs: list[np.ndarray] = []
        self.null: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.wide = False

    def add(self, docs: pa.Array, ids: np.ndarray, rows: np.ndarray) -> None:
        self.docs.append(docs.fill_null(0).to_numpy(zero_copy_only=False))
        self.null.append(np.asarray(docs.is_null()))
        self.counts.append(np.diff(rows))
        self.wide |= bool(len(ids)) and int(ids.max()) >= 1 << 16
        self.ids.append(ids)
        self.waiting += len(ids)
        if self.waiting >= GROUP_IDS:
            self.flush(GROUP_IDS)

    def flush(self, least: int = 1) -> None:
        ids = np.concatenate(self.ids or [np.zeros(0, np.uint32)])
        at = 0
        while len(ids) - at >= least:
            self.pieces.append(_group(ids[at : at + GROUP_IDS]))
            at += len(ids[at : at + GROUP_IDS])
        self.ids = [ids[at:]]
        self.waiting = len(ids) - at

    def finish(self) -> tuple[bytes, int, int]:
        self.flush()
        docs, null, counts = (np.concatenate(x or [np.zeros(0)]) for x in (self.docs, self.null, self.counts))
        index = struct.pack("<Q", len(docs)) + docs.astype("<i8").tobytes() + null.astype(np.uint8).tobytes() + counts.astype("<i8").tobytes()
        index = zlib.compress(index, 1)
        head = MAGIC + bytes([1, int(self.wide)])
        place = len(head) + sum(map(len, self.pieces))
        return b"".join([head, *self.pieces, index, struct.pack("<QII", place, len(index), zlib.crc32(index)), MAGIC]), len(docs), int(counts.sum())


def read_file(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, and all ids of one file."""
    if len(data) < 26 or data[:4] != MAGIC or data[-4:] != MAGIC or data[4] != 1:
        raise ValueError("not a whole token file")
    place, size, crc = struct.unpack_from("<QII", data, len(data) - 20)
    index = data[place : place + size]
    if zlib.crc32(index) != crc:
        raise ValueError("the index is damaged")
    index = zlib.decompress(index)
    (n,) = struct.unpack_from("<Q", index)
    docs = np.frombuffer(index, "<i8", n, 8)
    null = np.frombuffer(index, np.uint8, n, 8 + 8 * n).astype(bool)
    counts = np.frombuffer(index, "<i8", n, 8 + 9 * n)
    at, found = 6, []
    while at < place:
        (blocks,) = struct.unpack_from("<I", data, at)
        head = np.frombuffer(data, "<u4", 3 * blocks, at + 4).reshape(-1, 3).astype(np.int64)
        at += 4 + 12 * blocks
        ends = at + np.cumsum(head[:, 1])
        codes = [data[a:b] for a, b in zip((ends - head[:, 1]).tolist(), ends.tolist(), strict=True)]
        found += range_coder.decode(head[:, 0], codes, head[:, 2], bool(data[5] & 1))
        at = int(ends[-1]) if blocks else at
    return pa.array(docs, mask=null), counts, np.concatenate(found or [np.zeros(0, np.uint32)])


def write_token_files(docs: DataFrame, path: str, end: int, folder: str | None = None, id_column: str = "doc_id", column: str = "text", file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Write the ids of ``docs`` by the tokenizer file ``path``, each document
    followed by ``end``. Returns the folder (by default a new one in the shared
    folder) and a row for each file: number, name, n_docs, n_ids, n_bytes."""
    spark = docs.sparkSession
    importable(spark)
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    files = max(1, -(-text_bytes(docs, column) // file_bytes))
    bare = docs.select(F.col(id_column).cast("long").alias("id"), F.col(column).alias("text"))
    # the hash belongs to the ranges too, so many rows of one id make many files
    tied = bare.withColumn("tie", F.xxhash64("text"))
    dealt = tied.repartitionByRange(files, "id", "tie").sortWithinPartitions("id", "tie", "text").drop("tie")

    def write(stream):
        from pyarrow.fs import FileSystem

        store, place = FileSystem.from_uri(folder)
        store.create_dir(place, recursive=True)
        coder, out = Encoder.of(path), _Writer()
        for batch, data, offsets in text.batches(stream, "text", BLOCK):
            out.add(batch.column(0), *coder.encode(data, offsets, end))
        context = TaskContext.get()
        number = context.partitionId()
        data, n_docs, n_ids = out.finish()
        name = f"ids-{number:07d}.bin"
        passing = f"{place}/_{name}.{context.taskAttemptId()}"
        with store.open_output_stream(passing) as sink:
            sink.write(data)
        store.move(passing, f"{place}/{name}")
        yield pa.RecordBatch.from_pydict({"number": [number], "name": [name], "n_docs": [n_docs], "n_ids": [n_ids], "n_bytes": [len(data)]}, pa.schema([("number", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

    schema = "number int, name string, n_docs long, n_ids long, n_bytes long"
    # a row for each file: this runs the job once and keeps what it reported
    rows = dealt.mapInArrow(write, schema).collect()
    return folder, spark.createDataFrame(sorted(rows), schema)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """A row for each document of the files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` and, on demand, ``ids``."""
    importable(spark)
    counts = {r["number"]: r["n_ids"] for r in manifest.select("number", "n_ids").collect()}  # a number for each file
    before = np.concatenate(([0], np.cumsum([counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]))).astype(np.int64)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    if not counts:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.bin").load(folder)
    number = F.regexp_extract("path", r"ids-(\d+)\.bin$", 1).cast("int").alias("number")

    def read(stream):
        for batch in stream:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs, sizes, ids = read_file(data.as_py())
                ends = np.cumsum(sizes)
                if int(ends[-1] if len(ends) else 0) != len(ids) or len(ids) != counts[file]:
                    raise ValueError(f"file {file} is not whole")
                view = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                out = [docs, pa.array(before[file] + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return files.select(number, "content").mapInArrow(read, schema)
