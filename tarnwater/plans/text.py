"""Text queries: tokens, n-grams, vocabulary, indices, document vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions.text import STOP_WORDS, VOCABULARY_SIZE
from tarnwater.operators import corpus, splits, table
from tarnwater.plans.registry import long_vector, query, uniform_sql
from tarnwater.session import Tables, materialize, spread

WORDS = VOCABULARY_SIZE

_STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)
TOKENS_SQL = f"""
    tok AS (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(replace(text, '.', '')), '[ \\t\\n\\r\\f]+'),
            lambda w: w <> '' AND w NOT IN ({_STOP_LIST})) AS tokens
        FROM documents
    )"""
GRAMS_SQL = (
    TOKENS_SQL
    + """,
    gram AS (
        SELECT doc_id, list_concat(tokens, list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) AS grams FROM tok
    )"""
)
VOCABULARY_SQL = (
    TOKENS_SQL
    + f""",
    uses AS (SELECT doc_id, word, count(*) AS k FROM (SELECT doc_id, unnest(tokens) AS word FROM tok) GROUP BY ALL),
    counts AS (SELECT word, CAST(sum(k) AS BIGINT) AS n, count(*) AS df FROM uses GROUP BY word),
    vocab AS (SELECT * FROM counts WHERE df >= 2 ORDER BY n DESC, word LIMIT {WORDS}),
    ids AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS word_id FROM vocab)"""
)
INDEX_SQL = (
    VOCABULARY_SQL
    + """,
    places AS (SELECT doc_id, unnest(tokens) AS word, unnest(range(1, len(tokens) + 1)) AS pos FROM tok),
    hits AS (SELECT doc_id, pos, word_id FROM places JOIN ids USING (word)),
    indexed AS (
        SELECT doc_id, coalesce(n_ids, 0) AS n_ids, coalesce(ids, '') AS ids FROM documents LEFT JOIN (
            SELECT doc_id, count(*) AS n_ids, string_agg(CAST(word_id AS VARCHAR), ',' ORDER BY pos) AS ids FROM hits GROUP BY doc_id) USING (doc_id)
    )"""
)


def tokenized(t: Tables) -> DataFrame:
    """Documents as token arrays (doc_id, tokens)."""
    return corpus.tokenize(spread(t.documents.select("doc_id", "text"), "doc_id"))


def numbered_vocabulary(docs: DataFrame) -> DataFrame:
    """The most frequent words that occur in at least two documents, numbered alphabetically."""
    return corpus.number_words(corpus.vocabulary(corpus.gram_counts(docs), WORDS, min_df=2))


def kept_vocabulary(docs: DataFrame) -> DataFrame:
    """The same, written once, for plans that read it more than once; the limit states the bound again."""
    return materialize(numbered_vocabulary(docs), "vocabulary").limit(WORDS)


def kept_text_vocabulary(docs: DataFrame) -> DataFrame:
    """The same from the texts (doc_id, text), whose tokens are written nowhere."""
    counts = corpus.text_word_counts(docs)
    return materialize(corpus.number_words(corpus.vocabulary(counts, WORDS, min_df=2)), "vocabulary").limit(WORDS)


def indexed(t: Tables) -> DataFrame:
    """Documents as vocabulary ids (doc_id, ids)."""
    docs = tokenized(t)
    return corpus.word_ids(docs, "doc_id", numbered_vocabulary(docs))


def counted(t: Tables) -> DataFrame:
    """Documents as counts of vocabulary ids (doc_id, ids, times, n_ids)."""
    docs = tokenized(t)
    return corpus.known_counts(docs, "doc_id", numbered_vocabulary(docs))


@query(f"WITH {TOKENS_SQL} SELECT doc_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM tok")
def text_tokens(t: Tables) -> DataFrame:
    return tokenized(t).select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query(f"WITH {GRAMS_SQL} SELECT doc_id, len(grams) AS n_grams, array_to_string(grams, '|') AS grams FROM gram")
def text_ngrams(t: Tables) -> DataFrame:
    grams = corpus.with_ngrams(tokenized(t), 1, 2)
    return grams.select("doc_id", F.size("grams").cast("bigint").alias("n_grams"), F.array_join("grams", "|").alias("grams"))


@query(f"""
    WITH {GRAMS_SQL}, counts AS (SELECT gram, count(*) AS n FROM (SELECT unnest(grams) AS gram FROM gram) GROUP BY gram),
    known AS (SELECT gram FROM counts ORDER BY n DESC, gram LIMIT 200),
    places AS (SELECT doc_id, unnest(grams) AS gram, unnest(range(1, len(grams) + 1)) AS pos FROM gram),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(gram, '|' ORDER BY pos) AS grams FROM places SEMI JOIN known USING (gram) GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_grams, coalesce(grams, '') AS grams FROM documents LEFT JOIN kept USING (doc_id)""")
def text_ngrams_vocab(t: Tables) -> DataFrame:
    docs = tokenized(t)
    known = corpus.top_ngrams(docs, 2, 200)
    kept = corpus.keep_known(corpus.with_ngrams(docs, 1, 2), "doc_id", known, "grams")
    return kept.select("doc_id", F.size("grams").cast("bigint").alias("n_grams"), F.array_join("grams", "|").alias("grams"))


@query(f"WITH {VOCABULARY_SQL} SELECT word, n, df FROM counts")
def ngram_counts(t: Tables) -> DataFrame:
    return corpus.gram_counts(tokenized(t))


@query(f"WITH {VOCABULARY_SQL} SELECT word, n, df FROM vocab")
def text_vocabulary(t: Tables) -> DataFrame:
    return corpus.vocabulary(corpus.gram_counts(tokenized(t)), WORDS, min_df=2)


@query(f"WITH {VOCABULARY_SQL} SELECT word, word_id FROM ids")
def vocab_ids(t: Tables) -> DataFrame:
    return numbered_vocabulary(tokenized(t)).withColumn("word_id", F.col("word_id").cast("bigint"))


@query(f"WITH {INDEX_SQL} SELECT doc_id, n_ids, ids FROM indexed")
def text_to_index(t: Tables) -> DataFrame:
    return indexed(t).select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(f"WITH {INDEX_SQL} SELECT max(n_ids) AS max_length FROM indexed")
def text_max_length(t: Tables) -> DataFrame:
    return corpus.longest(counted(t)).withColumn("max_length", F.col("max_length").cast("bigint"))


@query(f"WITH {INDEX_SQL} SELECT quality, CAST(sum(n_ids) AS BIGINT) AS n_words FROM indexed JOIN labels USING (doc_id) GROUP BY quality")
def words_per_label(t: Tables) -> DataFrame:
    return corpus.words_per_label(counted(t), t.labels, "doc_id", "quality")


def _vector_sql(source: str) -> str:
    return f"""
    WITH {INDEX_SQL}, used AS (SELECT {source} FROM hits),
    sums AS (
        SELECT doc_id, i - 1 AS pos, sum(CAST(embedding[i] AS DOUBLE)) AS s
        FROM (SELECT doc_id, embedding, unnest(range(1, 65)) AS i FROM used JOIN embeddings ON vec_id = word_id) GROUP BY doc_id, i
    )
    SELECT doc_id, pos, round(s / n_ids, 6) + 0.0 AS value FROM sums JOIN indexed USING (doc_id)"""


def _document_vectors(t: Tables, dedupe: bool) -> DataFrame:
    vectors = t.embeddings.select(F.col("vec_id").alias("word_id"), F.col("embedding").alias("vector"))
    tokens = tokenized(t)
    numbered = kept_vocabulary(tokens)
    docs = corpus.document_vectors(corpus.known_counts(tokens, "doc_id", numbered), "doc_id", vectors, dedupe=dedupe, numbered=numbered)
    return long_vector(docs, ["doc_id"], "vector").withColumn("pos", F.col("pos").cast("bigint"))


@query(_vector_sql("DISTINCT doc_id, word_id"))
def doc_mean_embedding(t: Tables) -> DataFrame:
    return _document_vectors(t, dedupe=True)


@query(_vector_sql("doc_id, word_id"))
def doc_plain_mean_embedding(t: Tables) -> DataFrame:
    return _document_vectors(t, dedupe=False)


@query("SELECT doc_id, CASE quality WHEN 0 THEN '1,0' ELSE '0,1' END AS code FROM labels")
def label_one_hot(t: Tables) -> DataFrame:
    code = table.one_hot_array(F.col("quality"), [0, 1]).cast("array<string>")
    return t.labels.select("doc_id", F.array_join(code, ",").alias("code"))


@query(f"""
    WITH parted AS (SELECT quality, {uniform_sql(6, "doc_id")} AS u FROM labels)
    SELECT CASE WHEN u < 0.7 THEN 0 WHEN u < 0.85 THEN 1 ELSE 2 END AS part, quality, count(*) AS n FROM parted GROUP BY ALL""")
def label_distribution(t: Tables) -> DataFrame:
    parts = splits.random_parts(t.labels, ["doc_id"], [0.7, 0.15, 0.15], 6)
    return parts.groupBy("part", "quality").agg(F.count("*").alias("n"))
