"""Toxic spans and document scores by a linear-chain conditional random field.

Token labels come from document labels: a word, or a beginning of words, that marks toxic documents beyond chance labels the tokens
that have it in toxic documents; all other tokens are clean. The field learns to tag them from letters and neighbours, so it also
finds forms that were never labelled. Its marginals at every word of a whole text give the offending spans and, over a logistic
curve fitted on documents that the field has not seen, the document's score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.llm.crf import Fit, Model, fit, sums_by_text, tag_batches, word_table
from tarnwater.llm.encode import lean
from tarnwater.session import materialize

#: Bounds of the fit: labelled documents of each class, drawn by a hash of the id; whole texts are used.
TOXIC_TEXTS, CLEAN_TEXTS = 3000, 5000
#: One of so many sampled documents is kept for the curve from marginals to scores.
CURVE_PART = 4
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)
#: A mark of toxic documents: how far the odds of being toxic rise, at least, where it occurs.
MARK_ODDS = 3.0

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


@dataclass
class Scorer:
    """Field with the tags clean and toxic, and the curve's weights (None: the highest marginal is the score)."""

    model: Model | None
    curve: np.ndarray | None

    def scores(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Score of each text from its words' toxic marginals."""
        facts = text_facts(p, bounds)
        if self.curve is None:
            return 1 / (1 + np.exp(-facts[:, 1]))
        return 1 / (1 + np.exp(-np.clip(facts @ self.curve, -30, 30)))


def text_facts(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: 1, the log-odds of its highest marginal, the log of its expected toxic words, the log of its words."""
    n = np.diff(bounds)
    top = np.zeros(len(n))
    if len(p):
        top[n > 0] = np.maximum.reduceat(p, bounds[:-1][n > 0])
    top = np.clip(top, 3e-4, 1 - 3e-4)
    return np.stack([np.ones(len(n)), np.log(top / (1 - top)), np.log1p(sums_by_text(np.where(p > 0.01, p, 0), bounds)), np.log1p(n)], 1)


def toxic_sample(docs: DataFrame, labels: DataFrame, shards: int) -> DataFrame:
    """Labelled documents within the bounds of the fit: (shard, part, toxic, text), written once. Of repeated labels the toxic
    one counts; null labels don't."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("labelled"))
    known = known.agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = known.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    drawn = F.pmod(F.xxhash64("labelled", F.lit(31)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, TOXIC_TEXTS / max(counts["toxic"], 1))).otherwise(min(1.0, CLEAN_TEXTS / max(counts["clean"], 1)))
    # About TOXIC_TEXTS + CLEAN_TEXTS rows of two numbers, whatever the input.
    chosen = F.broadcast(known.where(F.col("toxic").isin(0, 1)).where(drawn < share))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("labelled"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(chosen, "labelled")
    number = lambda salt, n: F.pmod(F.xxhash64("labelled", F.lit(salt)), F.lit(n)).cast("int")
    return materialize(rows.select(number(37, shards).alias("shard"), number(41, CURVE_PART).alias("part"), "toxic", "text"), "toxic-sample")


def toxic_marks(sample: DataFrame) -> list[str]:
    """Words (``=word``) and beginnings of words that mark toxic documents: the odds of being toxic are at least MARK_ODDS times the sample's (with one
    document of either class added), and the log-likelihood ratio exceeds the log of the number of candidates, so that chance gives
    about one. Where none does, as in a small sample, those with the highest ratio count. None only without both classes, or without
    a word that two toxic documents share and that is commoner in them."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0)))
    longer = lambda k: F.transform(F.filter("words", lambda w: F.length(w) >= k), lambda w: F.substring(w, 1, k))
    marks = F.array_distinct(F.concat(F.transform("words", lambda w: F.concat(F.lit("="), w)), *[longer(k) for k in PREFIXES]))
    rows = sample.select("toxic", words.alias("words")).select("toxic", F.explode(marks).alias("mark"))
    counts = rows.groupBy("mark").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    facts = sample.agg(F.avg("toxic").alias("base"), F.count("*").alias("n")).first()
    if not facts["n"] or not 0 < facts["base"] < 1:
        return []
    counts = materialize(counts.where("t >= 2"), "marks")
    base, share = F.lit(facts["base"]), F.col("t") / F.col("n")
    ratio = F.col("t") * F.log(share / base) + F.when(share < 1, (F.col("n") - F.col("t")) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    odds = (F.col("t") + base) / (F.col("n") - F.col("t") + 1 - base) / (base / (1 - base))
    raised = counts.select("mark", ratio.alias("ratio"), odds.alias("odds")).where(share > base)
    limit = float(np.log(max(counts.count(), 1)))
    found = [r["mark"] for r in raised.where((F.col("odds") >= MARK_ODDS) & (F.col("ratio") >= limit)).select("mark").collect()]
    best = raised.agg(F.max("ratio").alias("ratio"))
    return found or [r["mark"] for r in raised.join(F.broadcast(best), "ratio").select("mark").collect()]


def fit_toxicity(docs: DataFrame, labels: DataFrame, how: Fit = Fit(rounds=2, rate=0.3)) -> Scorer:
    """Fit on labelled documents; ``labels`` (doc_id, toxic) should hold only rows that may be learned from. Without labels of both
    classes every score is 0."""
    sample = toxic_sample(docs, labels, how.shards)
    learned = sample.where("part > 0").drop("part")
    marks = frozenset(toxic_marks(learned))
    if not marks:
        return Scorer(None, None)

    def tagged(table: pa.Table, round_: int):
        words, codes, bounds = word_table(table.column("text").combine_chunks())
        marked = np.array([f"={w}" in marks or any(w[:k] in marks for k in PREFIXES if len(w) >= k) for w in words], bool)
        toxic = np.repeat(table.column("toxic").to_numpy() == 1, np.diff(bounds))
        first = np.zeros(len(codes), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        return words, codes, (marked[codes] & toxic).astype(np.int64), first

    model = fit(learned, Model.empty(["clean", "toxic"]), tagged, how)

    def facts(batches):
        for batch, p, bounds in tag_batches(batches, model):
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(list(text_facts(p[:, 1], bounds)), pa.list_(pa.float64()))], ["toxic", "facts"])

    rows = sample.where("part = 0").select("toxic", "text").mapInArrow(lean(facts), "toxic int, facts array<double>").collect()
    return Scorer(model, _curve(np.array([r["facts"] for r in rows]), np.array([r["toxic"] for r in rows])))


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray | None:
    """Logistic weights by Newton steps; None without both classes."""
    if len(np.unique(y)) < 2:
        return None
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.diag([1e-3] + [ridge] * (len(w) - 1))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
    return w


def _spans(text: str, toxic: np.ndarray) -> list[dict]:
    """Runs of toxic words as places in the text."""
    spans = []
    for i, word in enumerate(_WORD.finditer(text)):
        if toxic[i] < 0.5:
            continue
        if spans and spans[-1]["last"] == i - 1:
            spans[-1] |= {"last": i, "length": word.end() - spans[-1]["start"], "marginal": max(spans[-1]["marginal"], toxic[i])}
        else:
            spans.append({"start": word.start(), "length": len(word[0]), "marginal": toxic[i], "last": i})
    return [{k: v for k, v in s.items() if k != "last"} for s in spans]


def score_toxicity(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and any more columns): doc_id, score, predicted (1 from ``threshold``), spans (start, length,
    marginal: runs of words tagged toxic, in signs of the text).

    A null text counts as empty; a text without words gets the score of a text without toxic words. Texts are tagged whole. Repeated rows are scored
    each; other columns are ignored; an empty table gives no rows.
    """
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("marginal", pa.float64())]))

    def tag(batches):
        for batch, p, bounds in _tagged(batches, scorer):
            scores = scorer.scores(p, bounds) if scorer.model else np.zeros(batch.num_rows)
            spans: list[list] = [[] for _ in scores]
            for i in np.flatnonzero(sums_by_text((p >= 0.5).astype(np.int64), bounds)) if len(p) else ():
                spans[i] = _spans(batch.column("text")[i].as_py(), p[bounds[i] : bounds[i + 1]])
            columns = [batch.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(spans, spans_type)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(tag), "doc_id bigint, score double, predicted int, spans array<struct<start:int,length:int,marginal:double>>")


def _tagged(batches, scorer: Scorer):
    if scorer.model is None:
        for batch in batches:
            yield batch, np.zeros(0), np.zeros(batch.num_rows + 1, np.int64)
        return
    for batch, p, bounds in tag_batches(batches, scorer.model):
        yield batch, p[:, 1], bounds


def without_toxic(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns; nothing is shuffled."""

    def keep(batches):
        for batch, p, bounds in _tagged(batches, scorer):
            scores = scorer.scores(p, bounds) if scorer.model else np.zeros(batch.num_rows)
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(lean(keep), docs.schema)
