"""Vocabulary, document indices and document vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwater.functions.text import STOP_WORDS, VOCABULARY_SIZE, lowered, ngrams, tokens
from tarnwater.operators.order import row_positions
from tarnwater.session import row_bound

def tokenize(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS, name: str = "tokens") -> DataFrame:
    """Replace the text column by its token array."""
    return docs.withColumn(name, tokens(F.col(text), stop_words)).drop(text)


def with_ngrams(tokenized: DataFrame, low: int, high: int, source: str = "tokens", name: str = "grams") -> DataFrame:
    """Add the n-grams of the token array."""
    return tokenized.withColumn(name, ngrams(F.col(source), low, high))


def gram_frequencies(tokenized: DataFrame, column: str = "tokens") -> DataFrame:
    """Corpus frequency of every gram (word, n)."""
    long = tokenized.select(F.explode_outer(column).alias("word")).where(F.col("word").isNotNull())
    return long.groupBy("word").agg(F.count("*").alias("n"))


def gram_counts(tokenized: DataFrame, column: str = "tokens") -> DataFrame:
    """Corpus frequency and document frequency of every gram (word, n, df).

    Each document emits its grams for the frequency and behind them its distinct grams for the document frequency; both
    are plain counts that combine before the shuffle, so frequent words do not make a hot task.
    """
    first = F.posexplode_outer(F.concat(column, F.array_distinct(column))).alias("_pos", "word")
    long = tokenized.select(F.size(column).alias("_n"), first).where(F.col("word").isNotNull())
    return long.groupBy("word").agg(F.count_if(F.col("_pos") < F.col("_n")).alias("n"), F.count_if(F.col("_pos") >= F.col("_n")).alias("df"))


# Bytes of the texts that a task cuts at once, if there are more than one: so little fits into memory many times, and into caches.
TEXT_PIECE = 1 << 22


def _cutter():
    """A function that cuts the texts of a batch at every single blank, a piece of the batch after the other: (rows, their lists of words); runs of
    blanks leave empty words, which are none. It is a local one, as tasks need not have this package."""
    blanks, most = bytes.maketrans(b"\t\n\r\f", b"    "), TEXT_PIECE  # no byte of a longer sign is one of the blanks

    def pieces(texts: pa.StringArray) -> Iterator[tuple[slice, pa.ListArray]]:
        bounds, data = (np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, np.int32)), texts.buffers()[2]
        start = 0
        while start < len(texts):
            end = max(start + 1, int(np.searchsorted(bounds, int(bounds[start]) + most, "right")) - 1)
            even = (data.slice(int(bounds[start]), int(bounds[end] - bounds[start])).to_pybytes() if bounds[end] > bounds[start] else b"").translate(blanks)
            piece = pa.Array.from_buffers(pa.string(), end - start, [None, pa.py_buffer((bounds[start : end + 1] - bounds[start]).tobytes()), pa.py_buffer(even)], 0)
            yield slice(start, end), pc.split_pattern(piece, " ")
            start = end

    return pieces


def text_word_counts(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """What :func:`gram_counts` finds on the tokens of a text column (word, n, df), from the texts: tasks cut a piece of them and count its words
    with numpy, so that no token becomes a row or a list, and only different words of a piece leave it."""

    pieces = _cutter()

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lists in pieces(batch.column(0)):
                coded = lists.flatten().dictionary_encode()
                codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
                cells = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()) * len(words) + codes
                cells.sort()
                first = cells[np.append(np.ones(min(len(cells), 1), bool), cells[1:] != cells[:-1])]
                n, df = (np.bincount(c, minlength=len(words)).astype(np.int64) for c in (codes, first % max(len(words), 1)))
                yield pa.RecordBatch.from_arrays([words, pa.array(n), pa.array(df)], ["word", "n", "df"])

    found = docs.select(lowered(F.col(text)).alias("text")).mapInArrow(counts, "word string, n bigint, df bigint")
    summed = found.where(~F.col("word").isin(["", *dict.fromkeys(stop_words)])).groupBy("word")
    return summed.agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def text_word_ids(docs: DataFrame, key: str, numbered: DataFrame, text: str = "text") -> DataFrame:
    """What :func:`word_ids` finds on the tokens of a text column (key, ids), from the texts. A vocabulary without stop words needs no other filter."""
    listed = {r["word"]: r["word_id"] for r in _bounded(numbered).where(F.col("word").isNotNull()).groupBy("word").agg(F.min("word_id").alias("word_id")).collect()}
    listed.pop("", None)
    pieces = _cutter()

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = pa.array(list(listed), pa.string()), np.array(list(listed.values()), np.int32)
        for batch in batches:
            for rows, lists in pieces(batch.column(1)):
                place = pc.index_in(lists.flatten(), value_set=words).fill_null(-1).to_numpy()
                known = place >= 0
                bounds = np.append(0, np.cumsum(known))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
                found = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(number[place[known]], pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[rows], found], [key, "ids"])

    rows = docs.select(key, lowered(F.col(text)).alias("text"))
    return rows.mapInArrow(ids, rows.select(key, F.lit(None).cast("array<int>").alias("ids")).schema)


def top_ngrams(tokenized: DataFrame, high: int, top_n: int, column: str = "tokens", most: int = VOCABULARY_SIZE) -> DataFrame:
    """The ``top_n`` most frequent n-grams with n <= ``high`` (word, n), equal counts in order of the gram; the elements of the array hold no blank.

    An n-gram isn't more frequent than any of its words. So longer ones are only counted where all their words are as frequent as the word at
    place ``top_n``, ties included: rare n-grams, nearly all there are, are never made. With more than ``most`` such words all n-grams are counted.
    """
    ranked = vocabulary(gram_frequencies(tokenized, column), most + 1).collect()
    limit = ranked[top_n - 1]["n"] if len(ranked) >= top_n else 0
    frequent = [row for row in ranked if row["n"] >= limit]
    if len(frequent) > most:
        return vocabulary(gram_frequencies(with_ngrams(tokenized, 1, high, column, "_grams"), "_grams"), top_n)
    listed = [row["word"] for row in frequent]
    marked = F.transform(column, lambda w: F.when(w.isin(listed), w))
    counts = tokenized.sparkSession.createDataFrame([tuple(row) for row in frequent], "word string, n bigint")
    rows = tokenized.select(marked.alias("_level1"))
    for n in range(2, high + 1):
        size = F.greatest(F.size("_level1") - (n - 1), F.lit(0))
        joined = F.zip_with(F.slice(f"_level{n - 1}", F.lit(1), size), F.slice("_level1", F.lit(n), size), lambda a, b: F.concat(a, F.lit(" "), b))
        rows = rows.withColumn(f"_level{n}", joined)
        counts = counts.unionByName(gram_frequencies(rows, f"_level{n}"))
    return vocabulary(counts, top_n)


def vocabulary(counts: DataFrame, top_n: int = VOCABULARY_SIZE, min_df: int = 0, legacy_min_df: bool = False) -> DataFrame:
    """The most frequent grams (word, n, df); equal counts in order of the word. ``top_n=0`` keeps all.

    ``min_df`` drops rare grams before the cut. With ``legacy_min_df`` it does not touch the vocabulary.
    """
    kept = counts if legacy_min_df or min_df <= 0 else counts.where(F.col("df") >= min_df)
    return kept.orderBy(F.desc("n"), F.asc("word")).limit(top_n) if top_n > 0 else kept


def _bounded(words: DataFrame) -> DataFrame:
    """The table itself, if its plan proves a bound of its rows, as after a top-N cut."""
    if row_bound(words) is None:
        raise ValueError("cut the vocabulary to its top words, or use the variant for vocabularies without a bound")
    return words


def number_words(vocab: DataFrame) -> DataFrame:
    """Alphabetical, 0-based ids (word, word_id) of a vocabulary cut to its top words."""
    words = _bounded(vocab).select("word")
    return words.select("word", (F.row_number().over(Window.orderBy("word")) - 1).alias("word_id"))


def number_all_words(vocab: DataFrame) -> DataFrame:
    """The same for a vocabulary without a bound, by ranges of words; ids are bigint."""
    return row_positions(vocab.select("word"), ["word"], "word_id").select("word", "word_id")


def keep_known(tokenized: DataFrame, key: str, words: DataFrame, column: str) -> DataFrame:
    """Keep only the array elements that occur in ``words`` (column ``word``, bounded), order and repeats preserved."""
    listed = [row["word"] for row in _bounded(words).where(F.col("word").isNotNull()).select("word").collect()]
    return tokenized.select(key, F.filter(_words(column), lambda w: w.isin(listed)).alias(column))


def word_ids(tokenized: DataFrame, key: str, numbered: DataFrame, column: str = "tokens") -> DataFrame:
    """Document to its list of ids of a bounded vocabulary, unknown words dropped; (key, ids)."""
    listed = _hash_table(_bounded(numbered), "word", "word_id")
    found = lambda table: F.array_compact(F.transform(_words(column), lambda w: F.try_element_at(_bucket(table, w), w)))
    return _with_scalar(tokenized.select(key, column), listed, lambda table: found(table).alias("ids"), [key])


# Places of the look-up table; a vocabulary of the usual size has at most a few words at each.
_PLACES = 8192


def _place(word):
    return F.pmod(F.hash(word), F.lit(_PLACES))


def _bucket(table, word):
    return F.get(table, _place(word))


def _words(column):
    return F.coalesce(column, F.array().cast("array<string>"))


def _hash_table(words: DataFrame, word: str, value: str) -> DataFrame:
    """A bounded vocabulary as a single value: an array of places, each with a map of the few words that hash to it."""
    known = words.where(F.col(word).isNotNull()).groupBy(word).agg(F.min(value).alias(value))
    entries = known.groupBy(_place(F.col(word)).alias("place")).agg(F.map_from_entries(F.collect_list(F.struct(word, value))).alias("entries"))
    places = words.sparkSession.range(_PLACES).select(F.col("id").cast("int").alias("place")).join(entries, "place", "left")
    empty = F.create_map().cast(entries.schema["entries"].dataType)
    rows = places.agg(F.collect_list(F.struct("place", F.map_entries(F.coalesce("entries", empty)).alias("entries"))).alias("all"))
    return rows.select(F.transform(F.array_sort("all"), lambda p: F.map_from_entries(p["entries"])).alias("table"))


def _with_scalar(df, one_value, build, keep):
    # The one value meets the rows as a scalar subquery: no join, and no row carries it across a shuffle.
    return df.withColumn("_table", one_value.scalar()).select(*keep, build(F.col("_table")))


def word_ids_by_shuffle(tokenized: DataFrame, key: str, numbered: DataFrame, column: str = "tokens") -> DataFrame:
    """The same for a vocabulary without a bound: words are joined by shuffle, and unknown ones are gone before documents are put together."""
    long = tokenized.select(key, F.posexplode(column).alias("pos", "word"))
    hits = long.join(numbered, "word").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "word_id"))).alias("_hits"))
    found = hits.select(key, F.transform("_hits", lambda h: h["word_id"]).alias("ids"))
    nothing = F.array().cast(found.schema["ids"].dataType)
    return tokenized.select(key).join(found, key, "left").withColumn("ids", F.coalesce("ids", nothing))


def known_counts(tokenized: DataFrame, key: str, numbered: DataFrame, column: str = "tokens") -> DataFrame:
    """Known words per document as counts (key, ids, times, n_ids), ids ascending: all that sizes and mean vectors need.

    The bounded vocabulary becomes a count vectorizer, which looks words up inside the row: no explode, no shuffle.
    """
    words = [row["word"] for row in _bounded(numbered).orderBy("word_id").select("word").collect()]
    if not words:
        none = F.array().cast("array<int>")
        return tokenized.select(key, none.alias("ids"), none.alias("times"), F.lit(0).alias("n_ids"))
    model = CountVectorizerModel.from_vocabulary(words, inputCol=column, outputCol="_counts")
    sparse = model.transform(tokenized.select(key, _words(column).alias(column))).select(key, F.unwrap_udt("_counts").alias("_c"))
    found = sparse.select(key, F.col("_c.indices").alias("ids"), F.col("_c.values").cast("array<int>").alias("times"))
    return found.withColumn("n_ids", F.aggregate("times", F.lit(0), lambda a, n: a + n))


def distinct_ids(indexed: DataFrame, key: str) -> DataFrame:
    """The different ids of a document and how many it has with repeats (key, ids, n_ids), ids ascending, from what :func:`word_ids` found: no word
    is looked up again."""
    return indexed.select(key, F.sort_array(F.array_distinct("ids")).alias("ids"), F.size("ids").alias("n_ids"))


def known_counts_by_shuffle(tokenized: DataFrame, key: str, numbered: DataFrame, column: str = "tokens") -> DataFrame:
    """The same for a vocabulary without a bound: words are joined by shuffle."""
    hits = tokenized.select(key, F.explode_outer(column).alias("word")).join(numbered, "word")
    pairs = hits.groupBy(key, F.col("word_id").alias("id")).agg(F.count("*").cast("int").alias("times"))
    grouped = pairs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("id", "times"))).alias("_c"))
    found = tokenized.select(key).join(grouped, key, "left")
    parts = (("id", "ids", numbered.schema["word_id"].dataType.simpleString()), ("times", "times", "int"))
    found = found.select(key, *[F.coalesce(F.col(f"_c.{c}"), F.array().cast(f"array<{kind}>")).alias(n) for c, n, kind in parts])
    return found.withColumn("n_ids", F.aggregate("times", F.lit(0), lambda a, n: a + n))


def longest(counted: DataFrame) -> DataFrame:
    """Known words of the longest document."""
    return counted.agg(F.max("n_ids").alias("max_length"))


def words_per_label(counted: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Known words per label."""
    sized = counted.select(key, F.col("n_ids").cast("bigint").alias("_n"))
    return sized.join(labels.select(key, label), key).groupBy(label).agg(F.sum("_n").alias("n_words"))


def document_vectors(counted: DataFrame, key: str, vectors: DataFrame, dedupe: bool = True, numbered: DataFrame | None = None) -> DataFrame:
    """Mean of the word vectors of a document (key, n_ids, vector); NULL for a document without known words.

    ``counted`` comes from :func:`known_counts` (or, with ``dedupe`` and ``numbered``, :func:`distinct_ids`), ``vectors`` holds (word_id, vector). With
    ``dedupe`` each distinct word is summed once but the sum is divided by the number of words with repeats; without it the result is the plain mean.
    With ``numbered``, the bounded vocabulary, its vectors become one array, which tasks look ids up in and sum with numpy: nothing is exploded
    or shuffled. Without, vectors are joined by shuffle: one row per document and distinct word, combined before the shuffle.
    """
    if numbered is not None:
        return _vectors_in_row(counted, key, vectors, dedupe, _bounded(numbered).select("word_id"))
    long = counted.select(key, "n_ids", F.inline_outer(F.arrays_zip("ids", "times")).alias("word_id", "times"))
    dense = vectors.select("word_id", array_to_vector(F.col("vector").cast("array<double>")).alias("_vector"))
    matched = long.join(dense, "word_id")
    # the mean weighted by w times the total weight is the sum of w * vector
    weight = F.lit(1.0) if dedupe else F.col("times").cast("double")
    summary = Summarizer.metrics("mean").summary(F.col("_vector"), weight)
    known = matched.groupBy(key, "n_ids").agg(summary.alias("_s"), F.sum(weight).alias("_w"))
    scale = F.array_repeat(F.col("_w") / F.col("n_ids"), F.size("_mean"))
    means = known.select(key, "n_ids", "_w", vector_to_array("_s.mean").alias("_mean"))
    found = means.select(key, F.zip_with("_mean", scale, lambda m, k: m * k).alias("vector"))
    return counted.select(key, "n_ids").join(found, key, "left")


def _vectors_in_row(counted, key, vectors, dedupe, ids):
    known = vectors.select("word_id", F.col("vector").cast("array<double>").alias("vector"))
    placed = ids.join(known, "word_id", "left").agg(F.array_sort(F.collect_list(F.struct("word_id", "vector"))).alias("all"))
    listed = [entry["vector"] for entry in placed.first()["all"]]  # bounded like the vocabulary
    sizes = np.array([-1 if v is None else len(v) for v in listed], np.int64)
    width = max(sizes.max(initial=0), 0)
    table, missing = np.zeros((len(listed), width)), np.ones((len(listed), width), bool)
    for row, v in enumerate(listed):
        if v:
            table[row, : len(v)], missing[row, : len(v)] = np.array(v, float), [x is None for x in v]
    uneven = bool(missing.any())

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            first, flat = lists.offsets[0].as_py(), lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            found = (flat >= 0) & (flat < len(sizes))
            found[found] = sizes[flat[found]] >= 0
            bounds = np.append(0, np.cumsum(found))[lists.offsets.to_numpy() - first]
            flat, weights = flat[found], None if dedupe else batch.column("times").flatten().to_numpy(zero_copy_only=False)[found].astype(float)
            sums, nulls, lengths = [], [], np.zeros(len(batch), np.int64)
            for i in np.flatnonzero(np.diff(bounds)):
                a, b = bounds[i], bounds[i + 1]
                rows = table[flat[a:b]]
                total = (rows if dedupe else rows * weights[a:b, None]).sum(axis=0) / batch.column("n_ids")[i].as_py()
                lengths[i] = sizes[flat[a:b]].max()
                sums.append(total[: lengths[i]])
                if uneven:  # as with zip_with, a component that one of the vectors lacks is null
                    nulls.append(missing[flat[a:b]].any(axis=0)[: lengths[i]])
            values = pa.array(np.concatenate(sums) if sums else np.zeros(0), mask=np.concatenate(nulls) if nulls else None)
            ends = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32), mask=np.append(np.diff(bounds) == 0, False))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("n_ids"), pa.ListArray.from_arrays(ends, values)], [key, "n_ids", "vector"])

    rows = counted.select(key, "ids", "n_ids", *([] if dedupe else ["times"]))
    return rows.mapInArrow(means, rows.select(key, "n_ids", F.lit(None).cast("array<double>").alias("vector")).schema)
