"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so: after SHORTEST signs at the first place where four signs of a fixed set and a blank, or
a mark that ends sentences without blanks, have just been read; after LONGEST at the latest. Equal texts give equal chunks, and long documents that share passages share
most of theirs. A document's recipe is its ordered list of chunk identifiers. An identifier is the 64-bit hash of the chunk, once it
is verified: every distinct (hash, chunk) is brought together once, already reduced in the tasks, to find hashes that stand for two
chunks. Texts with such a hash carry their content in the recipe. After that only recipes are compared and joined, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.llm.encode import whole_rows
from tarnwater.session import materialize

SHORTEST, LONGEST = 512, 8192

_CHUNK = rf"(?s).{{{SHORTEST},{LONGEST}}}?(?:[a-h0-4]{{4}}[.,]?[ \n]|[。、！？])|.{{1,{LONGEST}}}"


def normalised(text: Column) -> Column:
    """Null as empty, A-Z lower-cased, nothing else changed."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chunks(text: Column) -> Column:
    """Content-defined chunks of a text, in order; none of an empty text."""
    return F.regexp_extract_all(text, F.lit(_CHUNK), F.lit(0))


def ambiguous_hashes(docs: DataFrame) -> DataFrame:
    """Chunk hashes that stand for more than one chunk, (hash): normally none."""
    pieces = docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
    distinct = pieces.select(F.xxhash64("chunk").alias("hash"), "chunk").distinct()
    return distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and any more columns): doc_id, keep_id (largest doc_id of those with an equal
    text), group_size, kept (it is the row that stays), text_sha256 (of the normalised text).

    Null texts equal the empty text. A null doc_id is smaller than any other, so such a row stays only if the group has no other id (keep_id
    is then null). Of rows that repeat both text and doc_id, one stays. Columns beside doc_id and text are ignored. An empty table
    gives no rows. Text length doesn't matter: whole texts are compared, chunk by chunk.
    """
    text = normalised(F.col("text"))
    recipes = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"),
        F.transform(chunks(text), lambda c: F.xxhash64(c)).alias("recipe"), F.monotonically_increasing_id().alias("row"),
    )
    recipes = materialize(recipes.withColumn("content", F.lit("")), "recipes")
    doubtful = materialize(ambiguous_hashes(docs), "ambiguous")
    if not doubtful.isEmpty():
        hit = recipes.select("text_sha256", F.explode("recipe").alias("hash")).join(doubtful, "hash", "left_semi").select("text_sha256").distinct()
        contents = docs.select(F.sha2(text, 256).alias("text_sha256"), text.alias("full")).join(hit, "text_sha256", "left_semi").distinct()
        recipes = recipes.join(contents, "text_sha256", "left").withColumn("content", F.coalesce("full", F.lit(""))).drop("full")
    # The verified recipe decides; the digest is an output.
    key = ["recipe", "content"]
    best = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row"))
    groups = recipes.groupBy(*key).agg(best.alias("best"), F.count("*").alias("group_size"))
    joined = recipes.join(groups, key)
    return joined.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows that repeat text and doc_id, one stays."""
    kept = duplicate_groups(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    rows = whole_rows(docs).withColumns({"doc_id": F.col("row.doc_id").cast("bigint"), "text_sha256": F.sha2(normalised(F.col("row.text")), 256)})
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_sha256") == F.col("sha"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_sha256"]).select("row.*")
