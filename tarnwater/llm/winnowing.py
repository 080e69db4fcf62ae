"""Benchmark decontamination by winnowing: every span of words that a document shares with a test item is found.

A text's words give one k-gram hash per place. Of every window of consecutive k-grams that covers ``span`` words, the smallest hash
(the first of equal ones) is kept as the window's fingerprint. It follows from the window's words alone, so wherever a document
repeats ``span`` words of an item, both keep the same fingerprint there: no shared span is missed. An item that is shorter than
``span`` is one window of its own length, with the hash of all its words.

* The items' fingerprints fill a bitmap of a fixed size, which every task gets; a document's windows whose fingerprint isn't in it
  can't match and never leave the task that reads the document.
* The windows that stay carry their words. Document and item windows meet by their fingerprint and words together, so a match is verified word
  by word, and one document window meets at most one row: equal item windows are one row that names its set of items.
* Overlapping and touching matches are extended to spans by their union.

A window that many documents share is dealt out over SALTS tasks; a bitmap that false hits fill makes more rows, never other results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwater.llm.encode import lean, text_slices, whole_rows
from tarnwater.session import materialize

SPAN, GRAM = 10, 5
#: Bits of the bitmap of item fingerprints; 4 MB whatever the size of the benchmark.
BITMAP_BITS = 1 << 25
SALTS = 16
#: Bytes of text taken at a time in a task.
SLICE_BYTES = 2_000_000

#: Bytes of a word that are hashed column by column over all words; the rest of a longer word is hashed at once.
LONG_WORD = 64

#: The multipliers of the hash of a word's bytes and of a gram's words: any odd numbers do.
_BYTE_STEP, _WORD_STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

HITS = "array<struct<start:bigint,length:int,print:bigint,words:binary>>"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with all bits spread."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0x94D049BB133111EB)


class Words:
    """Words of some texts, which lie one behind another: A-Z lower-cased, runs of digits, letters a-z and all signs beyond ASCII."""

    def __init__(self, texts: pa.Array):
        wide = texts.fill_null("").cast(pa.large_string())
        _, places, data = wide.buffers()
        at = np.frombuffer(places, np.int64)[wide.offset : wide.offset + len(wide) + 1]
        raw = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]
        self.bytes = _LOWER[raw]
        inside = _IN_WORD[self.bytes]
        before = np.concatenate([[False], inside[:-1]])
        before[(at[:-1] - at[0])[np.diff(at) > 0]] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]])
        after[(at[1:] - at[0] - 1)[np.diff(at) > 0]] = False
        self.stop = np.flatnonzero(inside & ~after) + 1
        #: Places of the texts' first words, and one more.
        self.bounds = np.searchsorted(self.start, at - at[0])
        self.text = np.repeat(np.arange(len(wide)), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word, of its bytes alone."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.stop - self.start
        out = np.full(len(self.start), np.uint64(1))
        rows = np.arange(len(self.start))
        for i in range(min(int(length.max()), LONG_WORD)):
            rows = rows[length[rows] > i]
            out[rows] = (out[rows] + self.bytes[self.start[rows] + i]) * _BYTE_STEP
        for r in np.flatnonzero(length > LONG_WORD).tolist():
            rest = self.bytes[self.start[r] + LONG_WORD : self.stop[r]].tobytes()
            out[r] = np.frombuffer(hashlib.blake2b(rest, digest_size=8, key=out[r].tobytes()).digest(), np.uint64)[0]
        return _mixed(out)

    def joined(self, first: int, n: int) -> bytes:
        """Some words one behind another with blanks between them."""
        return b" ".join(self.bytes[a:b].tobytes() for a, b in zip(self.start[first : first + n].tolist(), self.stop[first : first + n].tolist(), strict=True))


def fingerprints(hashes: np.ndarray, text: np.ndarray, gram: int, span: int) -> np.ndarray:
    """The fingerprint of every window of ``span`` words by the place of its first word; windows across two texts hold no meaning."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    for i in range(gram):
        grams = grams * _WORD_STEP + hashes[i : len(grams) + i]
    grams = _mixed(grams + np.uint64(span * 64 + gram))
    return np.min([grams[i : n + i] for i in range(span - gram + 1)], axis=0)


def _windows(words: Words, hashes: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, fingerprint) of every window that lies in one text."""
    prints = fingerprints(hashes, words.text, gram, span)
    n = len(prints)
    whole = words.text[:n] == words.text[span - 1 : span - 1 + n]
    return np.flatnonzero(whole), prints[whole]


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    for a, b in text_slices(batch.column(column), SLICE_BYTES):
        yield batch.slice(a, b - a)


def item_windows(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Windows of test items (item_id, text): (item string, length, print, words), written once. An item of fewer words than
    ``span`` is one window; null texts and texts without words have none. ``item`` is the id as text, null for a null id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "text"):
                words = Words(batch.column("text"))
                hashes, names = words.hashes(), batch.column("item")
                place, prints = _windows(words, hashes, gram, span)
                rows = [(int(words.text[p]), span, int(x), words.joined(int(p), span)) for p, x in zip(place.tolist(), prints.view(np.int64).tolist(), strict=True)]
                for i, n in enumerate(np.diff(words.bounds).tolist()):
                    if 0 < n < span:
                        first = int(words.bounds[i])
                        x = fingerprints(hashes[first : first + n], words.text[first : first + n], n, n)
                        rows.append((i, n, int(x.view(np.int64)[0]), words.joined(first, n)))
                columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary())],
                    ["item", "length", "print", "words"],
                )

    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(lean(cut), "item string, length int, print bigint, words binary").distinct(), "item-windows")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """One bit per hash of an item fingerprint, packed: BITMAP_BITS bits, put together from rows of 4 KB."""
    bit = F.pmod("print", F.lit(BITMAP_BITS)) + 1  # the functions below number from 1
    distinct = windows.select(bit.alias("bit")).distinct()
    rows = distinct.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in rows.toLocalIterator():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits[(r["bucket"] - 1) * len(part) : r["bucket"] * len(part)] = part
    return bits


def _bit_of(x: np.ndarray) -> np.ndarray:
    """The bit of a fingerprint as ``_bitmap`` numbers it."""
    return np.mod(x.view(np.int64), BITMAP_BITS)


def document_windows(docs: DataFrame, windows: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Every document with its number of words and the windows that an item's fingerprint may hold: (row, doc_id, n_words, hits), written once."""
    short = sorted(r["length"] for r in windows.where(F.col("length") < span).select("length").distinct().collect())
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(windows))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int32()), ("print", pa.int64()), ("words", pa.binary())]))
        known = bits.value
        for whole in batches:
            for batch in _slices(whole, "text"):
                words = Words(batch.column("text"))
                hashes = words.hashes()
                hits: list[list] = [[] for _ in range(batch.num_rows)]
                for n, k in [(span, gram), *((m, m) for m in short)]:
                    place, prints = _windows(words, hashes, k, n)
                    bit = _bit_of(prints)
                    found = np.flatnonzero(known[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                    for p, x in zip(place[found].tolist(), prints[found].view(np.int64).tolist(), strict=True):
                        i = int(words.text[p])
                        hits[i].append({"start": p - int(words.bounds[i]), "length": n, "print": x, "words": words.joined(p, n)})
                columns = [batch.column("row"), batch.column("doc_id"), pa.array(np.diff(words.bounds), pa.int64()), pa.array(hits, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "hits"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(lean(look), f"row bigint, doc_id bigint, n_words bigint, hits {HITS}"), "document-windows")


def _salted(table: DataFrame) -> DataFrame:
    """A table once for every salt."""
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _united(matched: DataFrame) -> DataFrame:
    """Per row, the union of its matches: n_hit (words) and spans (start, stop), by one sort of the row's matches."""
    ordered = Window.partitionBy("row").orderBy("start", "stop")
    upto = F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begun = matched.select("row", "start", "stop", F.coalesce((F.col("start") > upto).cast("int"), F.lit(1)).alias("new"))
    numbered = begun.select("row", "start", "stop", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("span"))
    spans = numbered.groupBy("row", "span").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return spans.groupBy("row").agg(F.sum(F.col("stop") - F.col("start")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and any more columns): doc_id, n_words, n_hit (words inside any occurrence of a window of
    an item), items (ids of the items with occurring windows as sorted texts), spans (start, stop in words: the matches' union).

    A window is ``span`` consecutive words of an item, or all words of a shorter one. A null or empty text has no words. Rows that repeat a doc_id
    are judged each; of items that repeat an id the windows are united; an item without id marks words and isn't named. Empty
    tables give no rows or no hits. Columns beside doc_id and text, item_id and text are ignored. Rows are numbered as they are
    read, so ``docs`` should be a table or depend on no order.
    """
    windows = item_windows(items, span, gram)
    found = document_windows(docs, windows, span, gram)
    sets = windows.groupBy("print", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    sets = materialize(sets.withColumn("set_id", F.sha2(F.to_json("items"), 256)), "item-sets")
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
    hits = found.where(F.size("hits") > 0).select("row", salt.alias("salt"), F.inline("hits"))
    matched = hits.join(_salted(sets.select("print", "words", "set_id")), ["salt", "print", "words"])
    matched = materialize(matched.select("row", "salt", "start", (F.col("start") + F.col("length")).alias("stop"), "set_id"), "matched")
    named = matched.select("row", "salt", "set_id").distinct().join(_salted(sets.select("set_id", "items").distinct()), ["salt", "set_id"])
    named = named.select("row", F.explode("items").alias("item")).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hit = _united(matched).join(named, "row", "left")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return found.select("row", "doc_id", "n_words").join(hit, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", none).alias("spans"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, most: float = 0.0) -> DataFrame:
    """The rows of ``docs`` of whose words at most a share of ``most`` is hit, by doc_id and text, with all their columns."""
    key = F.xxhash64(F.col("row.doc_id").cast("bigint"), F.col("row.text").cast("string"))
    rows = whole_rows(docs).withColumn("key", key)
    found = contamination(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), items)
    bad = found.where(F.col("n_hit") > most * F.col("n_words")).select(F.col("doc_id").alias("key")).distinct()
    return rows.join(bad, "key", "left_anti").select("row.*")
