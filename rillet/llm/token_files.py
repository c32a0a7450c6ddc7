"""Token ids in Arrow stream files of fixed-size lists.

A part is two Arrow IPC files.  ``part-N.arrow`` holds the ids of consecutive
documents, cut into sequences of equal length: a fixed-size list of ids and a
fixed-size list of booleans (true: an id, false: padding) per sequence, and
equally many sequences in every record batch but the last.  Sequence i is
therefore row ``i % rows`` of batch ``i // rows``, and a memory map gives it
without a copy.  ``part-N.index.arrow`` holds doc_id, begin and length in ids.
Only the last sequence of a part is padded.

Files go to any file system that pyarrow can open.  A task writes under a name
of its own attempt and reports it; the manifest names the files of the
attempts that succeeded, so a lost or repeated task leaves no wrong rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import slices, texts_of, written
from rillet.llm.encode import encoder

#: Ids of a sequence, and sequences of a record batch.
LENGTH, ROWS = 2048, 64
INDEX_ROWS = 1 << 16
SLICE = 1 << 20


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


class _Writer:
    """One part: ids in, sequences out, holding one record batch of ids."""

    def __init__(self, path: str, dtype: np.dtype, length: int, rows: int):
        fs, where = _open(path)
        fs.create_dir(where.rpartition("/")[0])
        ids = pa.from_numpy_dtype(dtype)
        self.length, self.most, self.dtype = length, length * rows, dtype
        self.schema = pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("begin", pa.int64()), ("length", pa.int64())])
        self.files = [fs.open_output_stream(where + ".arrow"), fs.open_output_stream(where + ".index.arrow")]
        self.out = pa.ipc.new_file(self.files[0], self.schema)
        self.index = pa.ipc.new_file(self.files[1], self.index_schema)
        self.held, self.n_held, self.total = [], 0, 0
        self.entries: tuple[list, list, list] = ([], [], [])

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        for column, value in zip(self.entries, (doc_id, self.total, len(ids))):
            column.append(value)
        if len(self.entries[0]) >= INDEX_ROWS:
            self._write_index()
        self.total += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.most:
            ids = np.concatenate(self.held)
            for i in range(0, len(ids) - self.most + 1, self.most):
                self._write(ids[i:i + self.most], self.most)
            rest = ids[len(ids) - len(ids) % self.most:]
            self.held, self.n_held = [rest.copy()], len(rest)

    def _write(self, ids: np.ndarray, n: int) -> None:
        mask = np.arange(len(ids)) < n
        self.out.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def _write_index(self) -> None:
        self.index.write_batch(pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in self.entries], schema=self.index_schema))
        for c in self.entries:
            c.clear()

    def close(self) -> None:
        if self.n_held:
            padded = np.zeros(-(-self.n_held // self.length) * self.length, dtype=self.dtype)
            padded[:self.n_held] = np.concatenate(self.held)
            self._write(padded, self.n_held)
        self._write_index()
        for f in (self.out, self.index, *self.files):
            f.close()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, length: int = LENGTH,
                 rows: int = ROWS) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the manifest.

    Manifest: part (ascending with doc_id), path (without endings), n_docs,
    n_tokens, base (ids in all parts before it).  A document is its ids by the
    tokenizer, no special tokens added, and ``end_id``.  A null doc_id comes
    first; rows that share a doc_id are ordered by a hash of their text; a null
    text is empty, so it holds ``end_id`` alone; an empty table has no parts.
    Other columns are not looked at.
    """
    tie = F.xxhash64("text")
    ordered = texts_of(docs).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, out, n_docs = context.partitionId(), None, 0
        where = f"{path}/part-{part:06d}-{context.taskAttemptId()}"
        tokens = encoder(tokenizer)
        end = np.array([end_id], dtype=tokens.dtype)
        for b in batches:
            for piece in slices(b, "text", SLICE):
                out = out or _Writer(where, tokens.dtype, length, rows)
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(),
                                       tokens.encode(piece.column("text").to_pylist())):
                    out.add(doc_id, np.concatenate((ids, end)))
                n_docs += piece.num_rows
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [where], "n_docs": [n_docs],
                                              "n_tokens": [out.total]})

    parts = written(ordered.mapInArrow(run, "part long, path string, n_docs long, n_tokens long"), "manifest")
    # One row per file; the base is a running sum over the files, not over documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class TokenFile:
    """Random access to the sequences of one part; batches are read on demand
    and, from a local path, mapped into memory without a copy."""

    def __init__(self, path: str):
        fs, where = _open(path)
        if isinstance(fs, pa.fs.LocalFileSystem):
            sources = [pa.memory_map(where + end) for end in (".arrow", ".index.arrow")]
        else:
            sources = [fs.open_input_file(where + end) for end in (".arrow", ".index.arrow")]
        self.reader, self.index = (pa.ipc.open_file(s) for s in sources)
        self.length = self.reader.schema.field("ids").type.list_size
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0
        self._at, self._ids, self._mask = -1, None, None

    def _load(self, k: int) -> np.ndarray:
        """The ids of batch k, end to end: a view of the file."""
        if k != self._at:
            b = self.reader.get_batch(k)
            self._at, self._ids, self._mask = k, b.column("ids").flatten().to_numpy(), b.column("mask").flatten()
        return self._ids

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids of sequence i (a view of the file) and its mask."""
        ids, at = self._load(i // self.rows), i % self.rows * self.length
        return ids[at:at + self.length], self._mask.slice(at, self.length)

    def runs(self, begin: int, length: int) -> Iterator[np.ndarray]:
        """The ids begin .. begin+length-1 of the part, as views of its batches."""
        most = self.length * max(self.rows, 1)
        while length:
            piece = self._load(begin // most)[begin % most:begin % most + length]
            yield piece
            begin, length = begin + len(piece), length - len(piece)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        for k in range(self.index.num_record_batches):
            b = self.index.get_batch(k)
            yield from zip(*(c.to_pylist() for c in b.columns))


def crc32_of(runs) -> int:
    """crc32 of ids as little-endian unsigned 32-bit numbers."""
    crc = 0
    for ids in runs:
        crc = zlib.crc32(ids.astype("<u4"), crc)
    return crc


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document, read back from the files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32.  A task per file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                f = TokenFile(path)
                rows: list = []
                for doc_id, begin, length in f.documents():
                    rows.append((doc_id, base + begin, length, crc32_of(f.runs(begin, length))))
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    n = max(1, manifest.count())
    return manifest.select("path", "base").repartition(n).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])
