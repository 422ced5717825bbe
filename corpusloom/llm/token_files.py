"""Token ids in Arrow files of fixed-size lists.

The ids of all documents, in the order of doc_id, form one stream. Each file
holds a part of it as rows of ``ids``, a fixed-size list, and ``mask``, which is
false in the padding of a file's last row; ``documents`` has the documents that
start in the row and where. All rows have the same size, uncompressed, so that
row i of a mapped file is read at a known place without copying. Ids take 16
bits where the vocabulary allows it.

A task writes its file under a name of its own attempt and then renames it, so
that a repeated task leaves one complete file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import token_ids
from corpusloom.llm.common import only, prepare, staging_path, tokenizer_path

LENGTH, END_ID = 2048, 0
#: Rows of fixed-size lists in a record batch, bytes of the table that a file is made from, and code points of a text by which rows of one id are dealt to files.
BATCH_ROWS, PART_BYTES, RANGE_CHARS = 256, 1 << 26, 64


def schema(length: int, bits: int) -> pa.Schema:
    ids = pa.uint16() if bits == 16 else pa.uint32()
    starts = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int32())]))
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)), ("documents", starts)])


class Writer:
    """Takes documents one by one and writes full batches; holds one batch."""

    def __init__(self, sink, length: int, bits: int):
        self.length, self.bits, self.schema = length, bits, schema(length, bits)
        self.kind = np.uint16 if bits == 16 else np.uint32
        self.out = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.size = self.total = 0
        self.starts: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.starts.append((doc_id, self.size))
        self.held.append(ids.astype(self.kind))
        self.size += len(ids)
        self.total += len(ids)
        if self.size >= BATCH_ROWS * self.length:
            self._flush(self.size // self.length)

    def _flush(self, rows: int) -> None:
        every = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        n = rows * self.length
        ids, rest = every[:n], every[n:]
        valid = len(ids)
        ids = np.concatenate([ids, np.zeros(n - valid, self.kind)])
        mask = np.arange(n) < valid
        starts: list[list[dict]] = [[] for _ in range(rows)]
        later = []
        for doc_id, at in self.starts:
            if at < n:
                starts[at // self.length].append({"doc_id": doc_id, "at": at % self.length})
            else:
                later.append((doc_id, at - n))
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length), pa.array(starts, self.schema.field("documents").type)]
        self.out.write_batch(pa.record_batch(columns, schema=self.schema))
        self.held, self.size, self.starts = [rest], len(rest), later

    def close(self) -> None:
        if self.size:
            self._flush(-(-self.size // self.length))
        self.out.close()


def open_file(path: str):
    """The file system of a URI and the path in it."""
    return pa.fs.FileSystem.from_uri(path)


def read_documents(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids before it in this file, its ids), a batch at a time; local files are mapped."""
    system, name = open_file(path)
    local = isinstance(system, pa.fs.LocalFileSystem)
    doc_id, start, parts, position, begun = None, 0, [], 0, False
    with (pa.memory_map(name) if local else system.open_input_file(name)) as source, pa.ipc.open_file(source) as file:
        for i in range(file.num_record_batches):
            batch = file.get_batch(i)
            length = batch.schema.field("ids").type.list_size
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            valid = int(batch.column("mask").flatten().true_count)
            at = 0
            for row, starts in enumerate(batch.column("documents").to_pylist()):
                for x in starts:
                    here = row * length + x["at"]
                    parts.append(ids[at:here])
                    if begun:
                        yield doc_id, start, np.concatenate(parts)
                    doc_id, start, parts, at, begun = x["doc_id"], position + here, [], here, True
            parts.append(ids[at:valid].copy())
            position += valid
        if begun:
            yield doc_id, start, np.concatenate(parts)


def write(documents: DataFrame, folder: str, path: str | None = None, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of all documents to ``folder``; a row (part, file, tokens) for each file, in order."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    spark = documents.sparkSession
    prepare(spark)
    rows = only(documents, doc_id=id_col, text=text_col)
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of its files, or an estimate
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES) if size < 1 << 60 else 1)  # beyond: not known
    order = ["doc_id", F.substring("text", 1, RANGE_CHARS), F.xxhash64("text"), "_tie"]  # so that rows of one id are dealt to many files, equal ones too
    ordered = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = token_ids.load(path), TaskContext.get()
        part = task.partitionId()
        system, base = open_file(folder)
        system.create_dir(base, recursive=True)
        name, final = f"{base}/.attempt-{task.taskAttemptId()}", f"part-{part:06d}.arrow"
        bits = 16 if tokenizer.library.get_vocab_size() <= 1 << 16 else 32
        writer = sink = None
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if writer is None:
                    sink = system.open_output_stream(name)
                    writer = Writer(sink, length, bits)
                writer.add(doc_id, np.append(np.frombuffer(tokenizer.ids(text or ""), np.uint32), np.uint32(END_ID)))
        if writer is not None:
            writer.close()
            sink.close()
            system.move(name, f"{base}/{final}")
            yield pa.record_batch({"part": pa.array([part], pa.int32()), "file": [final], "tokens": pa.array([writer.total], pa.int64())})

    return ordered.mapInArrow(run, "part int, file string, tokens long")


def digest(documents: DataFrame, path: str | None = None, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents and read the files back: doc_id, start, n_tokens, ids_crc32.

    Null texts count as empty and give their end id alone; a very long text is
    encoded as a whole, its ids being held by its task, and fills rows and batches as it goes; rows with a null id
    come first and rows with equal ids next to each other, in the order of their first 64 code points and then of a hash of the text, each with its own place; an empty table
    gives no files and no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    folder = folder or staging_path(spark, "tokens")
    files = sorted(map(tuple, write(documents, folder, path, id_col=id_col, text_col=text_col).collect()))  # a row for each file
    starts, total = [], 0
    for _, name, tokens in files:
        starts.append((f"{folder}/{name}", total))
        total += tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                rows: list[tuple] = []
                for doc_id, start, ids in read_documents(file):
                    rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 4096:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    listed = spark.createDataFrame(starts, "file string, base long").repartition(max(1, len(starts)))
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "start", "n_tokens", "ids_crc32"), columns, strict=True)})
