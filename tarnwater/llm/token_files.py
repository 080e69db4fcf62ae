"""Token ids as flat binary files.

One file set per partition of documents in ascending doc_id order, in one folder:

    part-00007.bin   the ids of its documents one behind another, unsigned, little-endian, 16 bit (32 for large vocabularies)
    part-00007.idx   unsigned 64-bit offsets, one more than documents: ids of all documents before each one, over all parts
    part-00007.len   the same offsets from the part's own start, of pass one
    part-00007.doc   the documents' ids, signed 64 bit, and one byte each after them: 1 where the id is null

Pass one writes the ids and the documents' lengths; the prefix sum of the partitions' totals is each part's base; pass two adds it
to the offsets. A file is written under a name of its own attempt and then renamed, so a task that runs twice leaves the same file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwater.llm.encode import END_ID, encoder, lean, text_slices, vocabulary_path
from tarnwater.session import materialize, new_path

PART_SCHEMA = "part int, n_docs bigint, n_tokens bigint, width int"
DOC_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
#: Bytes of ids read at a time.
READ_BYTES = 16_000_000


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    return system, path.rstrip("/")


class _Part:
    """The files of one partition; ``suffix`` keeps attempts apart until the end."""

    def __init__(self, uri: str, part: int, suffix: str = ""):
        self.system, folder = _folder(uri)
        self.stem, self.suffix = f"{folder}/part-{part:05d}", suffix

    def create(self, kind: str):
        return self.system.open_output_stream(f"{self.stem}.{kind}{self.suffix}")

    def finish(self, *kinds: str) -> None:
        for kind in kinds:
            self.system.move(f"{self.stem}.{kind}{self.suffix}", f"{self.stem}.{kind}")

    def load(self, kind: str, dtype: str) -> np.ndarray:
        """A file as an array: mapped into memory where the folder is local, else read."""
        path = f"{self.stem}.{kind}"
        size = self.system.get_file_info(path).size // np.dtype(dtype).itemsize
        if not size:
            return np.empty(0, dtype)
        if isinstance(self.system, fs.LocalFileSystem):
            return np.memmap(path, dtype, "r")
        with self.system.open_input_file(path) as file:
            return np.frombuffer(file.read(), dtype)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the ids of every whole text to ``folder``, which all executors reach; returns one row per part, (part, n_docs,
    n_tokens, width, base).

    Documents stand in ascending order of doc_id, null ids first and rows of one id by their text's hash and text. A null or empty text is
    the end id alone. Columns beside doc_id and text are ignored. An empty table writes no files.
    """
    path = vocabulary or vocabulary_path()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keys = ["doc_id", "tie", "text"]
    # Rows that differ only in the text are cut apart by its hash, so that the cut points stay small.
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path, end_id), TaskContext.get().partitionId()
        out = stream = None
        lengths, ids_of = [], []
        for whole in batches:
            for a, b in text_slices(whole.column("text")):
                batch = whole.slice(a, b - a)
                if out is None:
                    _folder(folder)[0].create_dir(_folder(folder)[1], recursive=True)
                    out = _Part(folder, part, f".{uuid.uuid4().hex}")
                    stream = out.create("bin")
                ids, bounds = encode(batch.column("text"))
                stream.write(memoryview(ids))
                lengths.append(np.diff(bounds))
                ids_of.append(batch.column("doc_id"))
        if out is None:
            return
        stream.close()
        doc_ids = pa.chunked_array(ids_of)
        with out.create("doc") as file:
            file.write(doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes())
            file.write(doc_ids.is_null().to_numpy().astype("u1").tobytes())
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<u8")
        with out.create("len") as file:
            file.write(offsets.tobytes())
        out.finish("bin", "doc", "len")
        columns = [[part], [len(doc_ids)], [int(offsets[-1])], [encode.dtype.itemsize]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)], PART_SCHEMA.replace(",", "").split()[::2])

    parts = materialize(ordered.select("doc_id", "text").mapInArrow(lean(write, keep_encoders=True), PART_SCHEMA), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint"))

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = _Part(folder, row["part"], f".{uuid.uuid4().hex}")
                with out.create("idx") as file:
                    file.write((out.load("len", "<u8") + np.uint64(row["base"])).astype("<u8").tobytes())
                out.finish("idx")
            yield batch

    return materialize(_dealt(bases).mapInArrow(shift, f"{PART_SCHEMA}, base bigint"), "bases")


def _dealt(parts: DataFrame) -> DataFrame:
    """One part per task, or a few: the table of parts itself is small."""
    wanted = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(wanted, "part")


def read_token_files(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """One row per document, read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of its
    ids as unsigned little-endian 32-bit integers)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part, n = _Part(folder, row["part"]), row["n_docs"]
                ids, offsets = part.load("bin", f"<u{row['width']}"), np.asarray(part.load("idx", "<u8"), np.int64)
                raw = np.asarray(part.load("doc", "u1"))
                doc_ids, missing = raw[: 8 * n].view("<i8"), raw[8 * n :].astype(bool)
                local = offsets - offsets[0]
                crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(local[:-1].tolist(), local[1:].tolist(), strict=True)]
                columns = [pa.array(doc_ids, mask=missing), pa.array(offsets[:-1]), pa.array(np.diff(local)), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, DOC_SCHEMA.replace(",", "").split()[::2])

    return _dealt(parts).mapInArrow(lean(read), DOC_SCHEMA)


def token_files(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write the files (to a new folder in the shared one, if none is given) and read every document back."""
    spark = docs.sparkSession
    where = folder or new_path(spark, "token-files")
    return read_token_files(spark, where, write_token_files(docs, where, vocabulary))
