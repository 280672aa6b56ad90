"""Token ids as flat binary files with 64-bit document offsets, read back by memory mapping.

A folder holds, for each range of documents in ascending order of id, three files of little-endian
integers: ``<name>.ids`` with the ids of all its documents end to end (16 bits where the vocabulary
allows, else 32), ``<name>.offsets`` with the place in that file where each document starts and where
the last one ends (64 bits), and ``<name>.docs`` with the document ids (64 bits). ``manifest``, a
Parquet table of one row for each range, gives its name, its documents and ids, and the bases to add:
documents and ids of all ranges before it, as prefix sums.

Documents are dealt out by ranges of (id, hash of the text), so one id on very many rows is split
too. Each attempt of a task writes files of its own name and returns them as its row; only rows of
committed tasks reach the manifest, so a lost executor or a second attempt leaves files that nobody
reads, which are deleted after the manifest is written. Readers seek or map only the blocks they need.

Defined results: null ids come first, in the order of their texts; rows with the same id are ordered by
hash of the text and text; repeated rows are documents of their own; null and empty texts hold the
end id alone; an empty table gives an empty manifest; long texts are whole. Other columns are not looked at and may
have any name.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.llm.arrow_text import slices
from fleetspark.llm.shipping import map_batches
from fleetspark.llm.word_encoder import word_encoder

#: Documents that one task reads of a file at a time, and ids digested at a time.
BLOCK = 1 << 13
WINDOW = 1 << 20


def width_of(vocabulary: int) -> str:
    """The type of the ids in the files."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class _Range:
    """The three files of one range of documents while they are written."""

    def __init__(self, folder: str, kind: str):
        self._fs, root = FileSystem.from_uri(folder)
        self._fs.create_dir(root, recursive=True)
        self.name, self._kind = uuid.uuid4().hex, kind
        self._ids, self._offsets, self._docs = (self._fs.open_output_stream(f"{root}/{self.name}.{e}") for e in ("ids", "offsets", "docs"))
        self.n_docs = self.n_null = self.n_tokens = 0
        self._offsets.write(np.zeros(1, "<i8").tobytes())

    def add(self, docs: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._ids.write(ids.astype(self._kind).tobytes())
        self._offsets.write((self.n_tokens + np.cumsum(lengths)).astype("<i8").tobytes())
        self._docs.write(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        self.n_docs, self.n_null, self.n_tokens = self.n_docs + len(docs), self.n_null + docs.null_count, self.n_tokens + int(lengths.sum())

    def close(self) -> None:
        for f in (self._ids, self._offsets, self._docs):
            f.close()


def _with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The id ``end`` behind the ids of each document."""
    return np.insert(ids, np.cumsum(lengths), end), lengths + 1


def write_token_files(docs: DataFrame, folder: str, path: str, end: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode ``docs`` with the tokenizer file at ``path`` and write them to ``folder``, which every executor can reach."""
    spark = docs.sparkSession
    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    schema = "part int, name string, n_docs long, n_null long, n_tokens long, width string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = word_encoder(path), None
        kind = width_of(max(encoder.size, end + 1))
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                out = out or _Range(folder, kind)
                out.add(part.column(0), *_with_end(*encoder.encode(part.column(1)), end))
        if out:
            out.close()
            row = {"part": TaskContext.get().partitionId(), "name": out.name, "n_docs": out.n_docs, "n_null": out.n_null, "n_tokens": out.n_tokens, "width": kind}
            found = pa.RecordBatch.from_pylist([row])
            yield found.set_column(0, "part", found.column(0).cast(pa.int32()))

    written = f"{folder}/ranges"
    map_batches(dealt, run, schema).write.parquet(written)
    ranges = spark.read.schema(schema).parquet(written)
    # One row for each file: a running sum over them is small whatever the number of documents.
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = {f"base_{c}": F.coalesce(F.sum(f"n_{c}").over(before), F.lit(0)).cast("long") for c in ("docs", "tokens")}
    ranges.withColumns(bases).coalesce(1).write.parquet(f"{folder}/manifest")
    _delete_unlisted(spark, folder)


def _delete_unlisted(spark: SparkSession, folder: str) -> None:
    """Delete files that attempts without a row in the manifest have left."""
    listed = {r["name"] for r in spark.read.parquet(f"{folder}/manifest").select("name").collect()}
    fs, root = FileSystem.from_uri(folder)
    for info in fs.get_file_info(FileSelector(root, allow_not_found=True)):
        if info.type == FileType.File and info.extension in ("ids", "offsets", "docs") and info.base_name.split(".")[0] not in listed:
            fs.delete_file(info.path)


class FlatFile:
    """A flat file of integers: memory-mapped where it is local, else read by position."""

    def __init__(self, folder: str, name: str, kind: str):
        fs, root = FileSystem.from_uri(folder)
        where = f"{root}/{name}"
        self._kind = np.dtype(kind)
        self._size = fs.get_file_info(where).size // self._kind.itemsize
        local = isinstance(fs, LocalFileSystem) and self._size
        self._map = np.memmap(where, self._kind, "r") if local else None
        self._file = None if local else fs.open_input_file(where)

    def __len__(self) -> int:
        return self._size

    def __getitem__(self, span: slice) -> np.ndarray:
        first, last, _ = span.indices(self._size)
        if self._map is not None:
            return self._map[first:last]
        return np.frombuffer(self._file.read_at(max(last - first, 0) * self._kind.itemsize, first * self._kind.itemsize), self._kind)


def ids_crc32(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian 32-bit integers."""
    crc = 0
    for at in range(0, len(ids), WINDOW):
        crc = zlib.crc32(np.ascontiguousarray(ids[at : at + WINDOW], "<u4").tobytes(), crc)
    return crc


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``folder``."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    firsts = F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(BLOCK).cast("long"))
    blocks = manifest.select("name", "width", "n_docs", "n_null", "base_tokens", F.explode(firsts).alias("first"))
    blocks = blocks.repartition("name", "first")
    fields = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids, offsets, docs = (FlatFile(folder, f"{b['name']}.{e}", k) for e, k in (("ids", b["width"]), ("offsets", "<i8"), ("docs", "<i8")))
                last = min(b["first"] + BLOCK, b["n_docs"])
                at = np.asarray(offsets[b["first"] : last + 1], np.int64)
                numbers = np.asarray(docs[b["first"] : last], np.int64)
                null = np.arange(b["first"], last) < b["n_null"]
                crcs = [ids_crc32(ids[s:e]) for s, e in zip(at.tolist(), at[1:].tolist(), strict=False)]
                columns = [pa.array(numbers, mask=null), pa.array(at[:-1] + b["base_tokens"]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return map_batches(blocks, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


class TokenFiles:
    """Random access for a reader on one machine: documents and windows of ids by global place."""

    def __init__(self, spark: SparkSession, folder: str):
        rows = spark.read.parquet(f"{folder}/manifest").orderBy("part").collect()  # one row for each file
        self._folder, self._rows, self._open = folder, rows, {}
        self._docs = np.array([r["base_docs"] for r in rows] + [sum(r["n_docs"] for r in rows)])
        self._ids = np.array([r["base_tokens"] for r in rows] + [sum(r["n_tokens"] for r in rows)])

    def __len__(self) -> int:
        return int(self._docs[-1])

    def _files(self, k: int) -> tuple[FlatFile, FlatFile]:
        if k not in self._open:
            row = self._rows[k]
            self._open[k] = (FlatFile(self._folder, f"{row['name']}.ids", row["width"]), FlatFile(self._folder, f"{row['name']}.offsets", "<i8"))
        return self._open[k]

    def document(self, n: int) -> np.ndarray:
        """The ids of the document of number ``n`` in the order of the files."""
        if not 0 <= n < len(self):
            raise IndexError(n)
        k = int(np.searchsorted(self._docs, n, "right")) - 1
        ids, offsets = self._files(k)
        at = n - int(self._docs[k])
        first, last = offsets[at : at + 2]
        return ids[int(first) : int(last)]

    def window(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from global place ``start`` on, across files; fewer at the end."""
        out, end = [np.zeros(0, "<u4")], min(start + n, int(self._ids[-1]))
        k = int(np.searchsorted(self._ids, start, "right")) - 1
        while start < end:
            base, stop = int(self._ids[k]), min(end, int(self._ids[k + 1]))
            out.append(np.asarray(self._files(k)[0][start - base : stop - base], "<u4"))
            start, k = stop, k + 1
        return np.concatenate(out)
