"""Language of words and whole texts by a linear-chain conditional random field.

Training sequences switch language: the words of the sampled texts are cut into short runs and the runs are shuffled, so the learned
transitions tell how long one language lasts. A text's language is the one with the largest sum of word marginals.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnwater.llm.crf import Fit, Model, _letters, fit, sums_by_text, tag_batches, word_hash, word_table
from tarnwater.llm.encode import lean
from tarnwater.session import materialize

#: Bounds of the fit: whole texts per language, their signs together, words of each lexicon.
TEXTS_PER_LANGUAGE, SIGNS, LEXICON = 1200, 4_000_000, 2000
#: Texts that alone take more than this part of the signs come last.
LONG = 20
MOST_LANGUAGES = 500
RUN = 12


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """crc32 of the id as text modulo ``parts`` is ``part``; null ids aren't held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def language_sample(docs: DataFrame, shards: int, per_language: int = TEXTS_PER_LANGUAGE, signs: int = SIGNS) -> DataFrame:
    """Whole labelled texts of each language, drawn by a hash of the text: (shard, lang, text), written once.

    Of a language's different texts the first by hash are taken, up to ``per_language`` of them and about ``signs`` signs together; texts of
    more than a twentieth of that come after the others. A language has at least one text in the sample. Copies count as often as they occur
    while both bounds allow it, dealt over the shards.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text", F.lit(17)).alias("drawn"))
    different = labelled.groupBy("lang", "drawn").agg(F.count("*").alias("copies"))
    counts = {r["lang"]: r["n"] for r in different.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = F.lit(1.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 2 * per_language / n))).otherwise(share)
    # About twice the bound of texts is left per language, so the windows are bounded.
    some = labelled.where(F.pmod("drawn", F.lit(1 << 30)) / float(1 << 30) < share).groupBy("lang", "drawn", "text").agg(F.count("*").alias("copies"))
    order = Window.partitionBy("lang").orderBy(F.col("length") > signs // LONG, "drawn", "text")
    some = some.withColumn("length", F.length("text").cast("bigint"))
    some = some.withColumns({"place": F.row_number().over(order), "upto": F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    kept = some.where((F.col("place") == 1) | ((F.col("place") <= per_language) & (F.col("upto") <= signs)))
    whole = Window.partitionBy("lang")
    room = F.least(F.lit(per_language) / F.count("*").over(whole), F.lit(signs) / F.greatest(F.sum("length").over(whole), F.lit(1)))
    kept = kept.withColumn("times", F.greatest(F.least("copies", F.floor(room)), F.lit(1)).cast("int"))
    rows = kept.select("lang", "text", "drawn", F.explode(F.sequence(F.lit(1), "times")).alias("copy"))
    return materialize(rows.select(F.pmod(F.xxhash64("drawn", "copy"), F.lit(shards)).cast("int").alias("shard"), "lang", "text"), "language-sample")


def lexicons(sample: DataFrame, languages: list[str], most: int = LEXICON) -> list[np.ndarray]:
    """Hashes of each language's frequent words that hardly occur in the others."""

    def count(table: pa.Table) -> pa.Table:
        words, codes, _ = word_table(table.column("text").combine_chunks())
        n = Counter(dict(enumerate(np.bincount(codes, minlength=len(words)).tolist())))
        merged: Counter = Counter()
        for i, c in n.items():
            merged[words[i]] += c
        return pa.table({"lang": [table.column("lang")[0].as_py()] * len(merged), "word": pa.array(list(merged), pa.string()), "n": pa.array(list(merged.values()), pa.int64())})

    counts = sample.groupBy("shard", "lang").applyInArrow(count, "lang string, word string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    both = counts.groupBy("word").agg(F.max(F.struct("n", "lang")).alias("top"), F.sum("n").alias("total")).where("total >= 5 AND top.n >= 0.9 * total")
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    rows = both.select("word", "top.lang", "top.n").withColumn("place", F.row_number().over(frequent)).where(F.col("place") <= most).collect()
    out = []
    for lang in languages:
        words = [r["word"] for r in rows if r["lang"] == lang]
        out.append(np.sort(np.unique(word_hash(_letters(words)[0]))) if words else np.zeros(0, np.uint64))
    return out


def fit_language(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, how: Fit = Fit()) -> Model:
    """Field whose tags are the languages of the labelled rows of ``docs`` (text, lang)."""
    sample = language_sample(docs, how.shards, per_language)
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not languages:
        return Model.empty([])

    def tagged(table: pa.Table, round_: int):
        words, codes, bounds = word_table(table.column("text").combine_chunks())
        number = {lang: i for i, lang in enumerate(languages)}
        tags = np.repeat([number[x] for x in table.column("lang").to_pylist()], np.diff(bounds))
        runs = np.array_split(np.arange(len(codes)), max(1, len(codes) // RUN))
        order = np.concatenate([runs[i] for i in np.random.default_rng(round_).permutation(len(runs))])
        first = np.zeros(len(codes), bool)
        first[:: 16 * RUN] = True
        return words, codes[order], tags[order], first

    return fit(sample, Model.empty(languages, lexicons(sample, languages)), tagged, how)


def tag_languages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and any more columns): doc_id, lang_pred, score, n_words, shares (words of each
    language, by marginal).

    A null text, or one without a letter, is ``und`` with score 0, as is every text if nothing was learned. Very long texts are tagged whole. Ties
    go to the language that comes first by name; repeated rows are tagged each; other columns are ignored; an empty table gives no rows.
    """

    def tag(batches):
        names = ["doc_id", "lang_pred", "score", "n_words", "shares"]
        for batch, p, bounds in tag_batches(batches, model):
            n = np.diff(bounds)
            letters = pc.fill_null(pc.match_substring_regex(batch.column("text"), r"\pL"), False).to_numpy(zero_copy_only=False)
            sums = sums_by_text(p, bounds)
            known = letters & (n > 0) & bool(model.tags)
            best = sums.argmax(1) if model.tags else np.zeros(len(n), int)
            share = np.clip(sums.max(1, initial=0) / np.maximum(n, 1), 0, 1)
            found = [model.tags[b] if k else "und" for b, k in zip(best, known, strict=True)]
            columns = [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(np.where(known, share, 0.0)), pa.array(n), pa.array(list(sums), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(tag), "doc_id bigint, lang_pred string, score double, n_words bigint, shares array<double>")


def word_languages(text: str, model: Model) -> list[tuple[str, str]]:
    """Words of one text with their languages."""
    words, codes, _ = word_table(pa.array([text]))
    p, _ = model.marginals(pa.array([text]))
    return [(words[c], model.tags[i]) for c, i in zip(codes, p.argmax(1), strict=True)] if len(codes) else []
