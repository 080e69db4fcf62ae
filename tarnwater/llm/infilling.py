"""Fill-in-middle texts by secondary sort.

A text is cut at unit ends (a unit: blanks and the word behind them, or the blanks at the end) into prefix, middle and suffix. Each
part leaves its task as chunks of whole units, one row each, keyed by the document and the place in the output. The
rows are dealt out by document and sorted by (document, place) inside their partitions (repartitionAndSortWithinPartitions, in its
DataFrame form, so that the sort spills on the JVM's side), which brings every output as a stream: it is hashed chunk by chunk as
it passes, and no document is ever put together in memory.

For the way back the same rows are keyed anew, from the marks that the stream shows and the form alone, and sorted again inside their
partitions: nothing is shuffled twice, and the restored text is hashed as it passes too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.llm.encode import lean

SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a chunk; longer only where a single unit is.
CHUNK_BYTES = 16_384

#: Order of the parts in the output of each form, and in the text: 0 prefix, 1 middle, 2 suffix.
_FORMS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)), "plain": (("", 0),)}
_SECTION = {mark.encode(): section for mark, section in _FORMS["psm"]}
_FACTS = 3

CHUNK_SCHEMA = "row bigint, place int, doc_id bigint, n bigint, form string, mark binary, content binary"
SORTED_SCHEMA = "row bigint, section int, place int, doc_id bigint, n bigint, form string, sizes array<bigint>, output_sha256 string, content binary"
DIGEST_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def unit_ends(data: bytes) -> np.ndarray:
    """Places in UTF-8 bytes where units end."""
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(data)) if len(data) else np.zeros(0, np.int64)


def _numbers(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers of a document; a null id counts as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def form_of(data: bytes, doc_id: int | None, n: int, seed: int = SEED) -> tuple[str, int, int]:
    """(form, units before the end of the prefix, of the middle)."""
    h1, h2, h3, h4 = _numbers(doc_id, seed)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not data or any(mark in data for mark in _SECTION) or h3 % 100 >= FIM_PERCENT:
        return "plain", 0, n
    return "spm" if h4 % 100 < SPM_PERCENT else "psm", first, second


def _chunks(data: bytes, ends: np.ndarray, start: int, stop: int) -> Iterator[bytes]:
    """Bytes start to stop in chunks that end at unit ends; an empty part is one empty chunk."""
    if start == stop:
        yield b""
    while start < stop:
        at = int(np.searchsorted(ends, start + CHUNK_BYTES, side="right"))
        end = int(ends[at - 1]) if at and ends[at - 1] > start else int(ends[min(at, len(ends) - 1)])
        end = min(end, stop)
        yield data[start:end]
        start = end


def chunk_rows(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The chunks of all outputs: row (a number of the document's row), place (in the output), doc_id, n (units), form, mark (which stands before the
    chunk, else empty), content. doc_id, n and form stand in place 0 only."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = CHUNK_SCHEMA.replace(",", "").split()[::2]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
        out, size = [], 0
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for i, (row, doc_id) in enumerate(zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), strict=True)):
                data = texts[i].as_py() or b""
                ends = unit_ends(data)
                n = len(ends)
                form, first, second = form_of(data, doc_id, n, seed)
                cut = [0, int(ends[first - 1]) if first else 0, int(ends[second - 1]) if second else 0, len(data)]
                bounds = [(cut[j], cut[j + 1]) for j in range(3)] if form != "plain" else [(0, len(data))]
                place = 0
                for mark, section in _FORMS[form]:
                    for chunk in _chunks(data, ends, *bounds[section]):
                        facts = (doc_id, n, form) if place == 0 else (None, None, None)
                        out.append((row, place, *facts, mark.encode(), chunk))
                        mark, place, size = "", place + 1, size + len(chunk)
                        if size > 2_000_000 or len(out) > 10_000:
                            yield _batch(out, kinds, names)
                            out, size = [], 0
        if out:
            yield _batch(out, kinds, names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(emit), CHUNK_SCHEMA)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def in_output_order(chunks: DataFrame) -> DataFrame:
    """All chunks of a document in one partition, in the order of the output: the outputs as streams."""
    return chunks.repartition("row").sortWithinPartitions("row", "place")


def _signs(content: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(content, np.uint8) & 0xC0) != 0x80))


def read_outputs(ordered: DataFrame) -> DataFrame:
    """Read the streams of outputs: every chunk with the part of the text it belongs to, as the marks say, and one row of facts behind each
    document: its output's sha256 and the parts' code points."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SORTED_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.string(), pa.binary()]
        open_, out, size = None, [], 0

        def closed(o: dict) -> tuple:
            return (o["row"], _FACTS, 0, *o["facts"], o["sizes"], o["sha"].hexdigest(), b"")

        for batch in batches:
            for r in batch.to_pylist():
                if open_ is None or r["row"] != open_["row"]:
                    if open_ is not None:
                        out.append(closed(open_))
                    open_ = {"row": r["row"], "facts": (r["doc_id"], r["n"], r["form"]), "sha": hashlib.sha256(), "sizes": [0, 0, 0], "section": 0, "place": 0}
                if r["mark"]:
                    open_["section"], open_["place"] = _SECTION[r["mark"]], 0
                open_["sha"].update(r["mark"] + r["content"])
                open_["sizes"][open_["section"]] += _signs(r["content"])
                out.append((r["row"], open_["section"], open_["place"], None, None, None, None, None, r["content"]))
                open_["place"] += 1
                size += len(r["content"])
                if size > 2_000_000 or len(out) > 10_000:
                    yield _batch(out, kinds, names)
                    out, size = [], 0
        if open_ is not None:
            out.append(closed(open_))
        if out:
            yield _batch(out, kinds, names)

    return ordered.mapInArrow(lean(read), SORTED_SCHEMA)


def digests(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and any more columns): doc_id, n (units), form (plain, psm, spm), prefix_chars and middle_chars (code
    points; null if plain), output_sha256, restored_sha256 (of the text restored from the output).

    A null text is empty, and an empty text or one that holds a mark is plain. A null doc_id counts as an empty string in the draw. Rows that
    repeat a doc_id are documents of their own. Texts of any length are passed in chunks. An empty table gives no rows; other columns are
    ignored. Rows are numbered as they are read, so ``docs`` should be a table or depend on no order.
    """

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = DIGEST_SCHEMA.replace(",", "").split()[::2]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        sha, out = hashlib.sha256(), []
        for batch in batches:
            for r in batch.to_pylist():
                if r["section"] != _FACTS:
                    sha.update(r["content"])
                    continue
                sizes = (None, None) if r["form"] == "plain" else r["sizes"][:2]
                out.append((r["doc_id"], r["n"], r["form"], *sizes, r["output_sha256"], sha.hexdigest()))
                sha = hashlib.sha256()
            if out:
                yield _batch(out, kinds, names)
                out = []

    # Chunks of a document stay in their partition: sorting again needs no shuffle.
    back = read_outputs(in_output_order(chunk_rows(docs, seed))).sortWithinPartitions("row", "section", "place")
    return back.mapInArrow(lean(restore), DIGEST_SCHEMA)


def outputs(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The outputs as whole texts: (row, doc_id, n, form, output), put together per document from its chunks."""
    piece = F.concat("mark", "content")
    grouped = chunk_rows(docs, seed).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("form").alias("form"), F.sort_array(F.collect_list(F.struct("place", piece.alias("piece")))).alias("pieces")
    )
    whole = F.aggregate("pieces", F.lit(b""), lambda s, p: F.concat(s, p["piece"]))
    return grouped.select("row", "doc_id", "n", "form", F.decode(whole, "utf-8").alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text of an output, from its form and marks."""
    between = lambda a, b: F.regexp_extract(output, f"(?s){a}(.*){b}", 1)
    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, "$"), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, "$"), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
