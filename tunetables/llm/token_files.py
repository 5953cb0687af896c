"""Token ids in Arrow files of equal-length sequences and masks, with random access."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetables.llm.encoding import Encoder
from tunetables.session import new_path, written

#: Ids of a sequence, sequences of a record batch, and bytes of text for each file about.
LENGTH = 2048
ROWS = 128
FILE_BYTES = 24 << 20
END_ID = 1


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Writes a line of ids as rows of ``length`` ids, the last one filled with 0 and masked out."""

    def __init__(self, uri: str, length: int, dtype: np.dtype):
        import pyarrow as pa

        system, path = _opened(uri)
        self.pa, self.length, self.dtype = pa, length, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = system.open_output_stream(path)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.waiting: list[bytes] = []
        self.size, self.total = 0, 0

    def add(self, ids: bytes) -> int:
        """Appends the ids of one document; returns where they start in this file."""
        start = self.total
        self.waiting.append(ids)
        self.size += len(ids)
        self.total += len(ids) // self.dtype.itemsize
        if self.size >= self.length * ROWS * self.dtype.itemsize:
            self._flush(False)
        return start

    def _flush(self, end: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), self.dtype)
        step = self.length * ROWS
        full = len(ids) // step * step
        for at in range(0, full, step):
            self._batch(ids[at : at + step], step)
        rest = ids[full:]
        if end and len(rest):
            padded = np.zeros(-(-len(rest) // self.length) * self.length, self.dtype)
            padded[: len(rest)] = rest
            self._batch(padded, len(rest))
            rest = rest[:0]
        self.waiting, self.size = [rest.tobytes()], rest.nbytes

    def _batch(self, ids: np.ndarray, real: int) -> None:
        pa = self.pa
        mask = np.arange(len(ids)) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.out.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        self._flush(True)
        self.out.close()
        self.sink.close()


class SequenceFile:
    """Random access to a file of equal-length sequences; batches are mapped, not copied, where they can be."""

    def __init__(self, uri: str):
        import pyarrow as pa

        system, path = _opened(uri)
        source = pa.memory_map(path) if system.type_name == "local" else system.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def _flat(self, number: int, column: str = "ids") -> np.ndarray:
        if number != self.at:
            self.at, self.batch = number, self.file.get_batch(number)
        return self.batch.column(column).flatten().to_numpy(zero_copy_only=column == "ids")

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        a = row % ROWS * self.length
        return self._flat(row // ROWS)[a : a + self.length], self._flat(row // ROWS, "mask")[a : a + self.length]

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on, over as many sequences as they take."""
        step, parts = self.length * ROWS, []
        while count > 0:
            number, a = divmod(start, step)
            part = self._flat(number)[a : a + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Encodes every document, appends ``end_id`` and writes all ids in ascending ``doc_id`` order.

    Documents are dealt to files by ranges of ``doc_id`` (null first; equal ids by a hash of the
    text), about 24 MB of text each; every task writes one file and holds one record batch.  The
    result is the stored index: ``part, file, doc_id, first, n_tokens``, with ``first`` counted in
    the file.  It names only files of tasks that ended well, so a task run again leaves at most an
    unused file.  Null and empty texts have the end id only.  An empty table gives an empty index.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "token-files")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = rows.repartitionByRange(max(1, -(-size // FILE_BYTES)), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    base = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    base = base.replace("file:/", "file:///", 1) if base.startswith("file:/") and not base.startswith("file://") else base

    def encoded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, writer, name = TaskContext.get().partitionId(), None, ""
        encoder = Encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        for part in parts:
            if not len(part):
                continue
            if writer is None:
                name = f"{base}/part-{number:06d}-{uuid.uuid4().hex}.arrow"
                _opened(base)[0].create_dir(_opened(base)[1], recursive=True)
                writer = SequenceWriter(name, length, encoder.dtype)
            ids = [x + end for x in encoder.encode(part["text"].tolist())]
            starts = [writer.add(x) for x in ids]
            counts = [len(x) // encoder.dtype.itemsize for x in ids]
            yield pd.DataFrame({"part": number, "file": name, "doc_id": part["doc_id"].tolist(), "first": starts, "n_tokens": counts})
        if writer is not None:
            writer.close()

    spread = spread.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    index = spread.mapInPandas(encoded, "part long, file string, doc_id string, first long, n_tokens long")
    return written(index.withColumn("doc_id", F.col("doc_id").cast("long")), "token-index")


def read_token_files(index: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it in all files.  The running sum over files
    is the only work in one task: a row for each file.
    """
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_base"))
    files = index.groupBy("part").agg(F.first("file").alias("_f")).count()
    rows = index.join(totals, "part")
    rows = rows.repartition(max(1, min(files, 1 << 16)), "part").sortWithinPartitions("part", "first")

    def checked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, file = None, None
        for part in parts:
            sums = []
            for path, first, count in zip(part["file"], part["first"], part["n_tokens"], strict=True):
                if path != name:
                    name, file = path, SequenceFile(path)
                sums.append(zlib.crc32(file.ids(first, count).astype("<u4").tobytes()))
            yield pd.DataFrame({"doc_id": part["doc_id"].tolist(), "start": part["_base"] + part["first"], "n_tokens": part["n_tokens"], "ids_crc32": sums})

    rows = rows.select("file", F.col("doc_id").cast("string").alias("doc_id"), "first", "n_tokens", "_base")
    rows = rows.mapInPandas(checked, "doc_id string, start long, n_tokens long, ids_crc32 long")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def token_files(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes the files and reads them back."""
    return read_token_files(write_token_files(docs, tokenizer, **options))
