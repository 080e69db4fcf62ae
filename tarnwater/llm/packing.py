"""Packing by concatenate and cut: all documents' token ids form one stream that is cut into windows of equal length.

Pass one tokenises each block of rows once, writes the ids with the running total inside the block, and gives one total per
block. The prefix sum of those totals is each block's place in the stream, so pass two knows every document's place and cuts it at
the window borders without moving a token. A document that crosses a border leaves one boundary record (piece) in each window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwater.llm.encode import END_ID, binary_column, encoder, lean, text_slices, vocabulary_path
from tarnwater.session import materialize

WINDOW = 4096

TOKEN_SCHEMA = "part int, block string, first bigint, doc_id bigint, local_start bigint, n_tokens bigint, width int, ids binary"
PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def token_table(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, order: tuple[str, str] | None = None) -> DataFrame:
    """Token ids of every row, written once: part and block name a run of rows that lie together, ``first`` is the place of the
    run's first row, ``local_start`` counts the ids before a row inside its run.

    order: two columns of ``docs``, the file a row was read from and its place there; without, runs are the tasks' partitions.
    """
    path = vocabulary or vocabulary_path()
    block, row = order or (None, None)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        (F.col(block).cast("string") if block else F.lit("")).alias("block"), (F.col(row).cast("bigint") if row else F.lit(0).cast("bigint")).alias("row"),
    )

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), encoder(path, end_id)
        names = TOKEN_SCHEMA.replace(",", "").split()[::2]
        run, first, total = None, 0, 0
        for whole in batches:
            for a, b in text_slices(whole.column("text")):
                batch = whole.slice(a, b - a)
                ids, bounds = encode(batch.column("text"))
                blocks, places = batch.column("block").to_pylist(), batch.column("row").to_pylist()
                starts, firsts = [], []
                for i, n in enumerate(np.diff(bounds).tolist()):
                    if blocks[i] != run:
                        run, first, total = blocks[i], places[i] or 0, 0
                    starts.append(total)
                    firsts.append(first)
                    total += n
                n = len(blocks)
                columns = [
                    pa.array([part] * n, pa.int32()), batch.column("block"), pa.array(firsts, pa.int64()), batch.column("doc_id"),
                    pa.array(starts, pa.int64()), pa.array(np.diff(bounds)), pa.array([ids.itemsize] * n, pa.int32()), binary_column(ids, bounds).cast(pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return materialize(rows.mapInArrow(lean(tokenise, keep_encoders=True), TOKEN_SCHEMA), "tokens")


def stream_starts(tokens: DataFrame) -> DataFrame:
    """First place in the stream of every run, (part, block, base): one row per run, by prefix sum over the runs' totals."""
    totals = tokens.groupBy("part", "block").agg(F.min("first").alias("first"), F.sum("n_tokens").alias("total"))
    before = Window.orderBy("block", "first", "part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("bigint").alias("base"))


def cut(tokens: DataFrame, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Pieces of the documents in windows of ``window`` ids, with the ids (unsigned, little-endian, 32 bit), or null for them."""
    # One row per run of rows, that is per input split; everything else stays where it was read.
    placed = tokens.join(F.broadcast(stream_starts(tokens)), ["part", "block"])
    placed = placed.select("doc_id", (F.col("base") + F.col("local_start")).alias("place"), "n_tokens", "width", "ids")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = PIECE_SCHEMA.replace(",", "").split()[::2]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            size = 0
            raw, at = _flat(batch.column("ids"))
            widths = batch.column("width").to_pylist()
            for i, (doc, place, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "place", "n_tokens")), strict=True)):
                ids = memoryview(raw[at[i] : at[i + 1]].view(f"<u{widths[i]}").astype("<u4")).cast("B")
                start = 0
                while start < n:
                    sequence, offset = divmod(place + start, window)
                    length = min(window - offset, n - start)
                    part = ids[4 * start : 4 * (start + length)]
                    for column, value in zip(out, (doc, start, length, zlib.crc32(part), n, sequence, offset, bytes(part) if with_ids else None), strict=True):
                        column.append(value)
                    start += length
                    size += len(part)
                    if size > 8_000_000:
                        yield _batch(out, names)
                        out, size = [[] for _ in names], 0
            yield _batch(out, names)

    return placed.mapInArrow(lean(pieces), PIECE_SCHEMA)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column one behind another, and the n + 1 places where values begin."""
    wide = column.cast(pa.large_binary())
    _, places, data = wide.buffers()
    at = np.frombuffer(places, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    return np.frombuffer(data or b"", np.uint8), at


def _batch(columns: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack(
    docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, end_id: int = END_ID, order: tuple[str, str] | None = None, with_ids: bool = True
) -> DataFrame:
    """Pack documents (doc_id, text and any more columns) into sequences of ``window`` ids.

    One row per piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens, sequence_id, offset, ids (null unless ``with_ids``).
    Every sequence but the last is full, so padding is less than one window in all. A null or empty text is its end id alone;
    null and repeated doc_ids are documents of their own; ties don't matter, as rows keep the order in which they are read;
    columns beside doc_id and text are ignored; an empty table gives no rows.
    """
    return cut(token_table(docs, vocabulary, end_id, order), window, with_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences from their boundary records: sequence_id, length, ids, and the pieces in order. A sequence has at most as
    many pieces as ids, so a group is bounded by the window."""
    fields = F.struct("offset", "doc_id", "start", "length", "ids")
    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(fields)).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    return grouped.select("sequence_id", (F.length(joined) / 4).cast("bigint").alias("length"), joined.alias("ids"), F.transform("parts", lambda p: p.dropFields("ids")).alias("pieces"))
