"""Chat formatting of reply trees, in DataFrame functions only.

Messages point to the message they answer. Self-joins that double the step each time give every message its root, depth and total
score in as many rounds as the longest thread has binary digits; the best leaves of each root are kept, the same tables walk them
back to the root, and each path becomes one conversation.

A turn is written ``<|im_start|>role NEWLINE text <|im_end|> NEWLINE`` (without the blanks). Inside roles and texts a backslash is doubled and ``<|`` is written ``<\\|``,
so no mark can stand there; a newline in a role gets a backslash before it. Removing each escaping backslash gives the text back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwater.session import materialize

START, END = "<|im_start|>", "<|im_end|>\n"
_ROLE = r"(?s)^([^\\\n]*(?:\\.[^\\\n]*)*)\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turns_as_tree(turns: DataFrame) -> DataFrame:
    """Flat conversations (conv_id, turn, role, text) as threads in which each row answers the one before it; rows of one
    conversation stand by turn, null first, then role and text. Nothing is dropped: rows with equal turns follow each other."""
    key = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
    rows = turns.select(key.alias("tree"), F.col("conv_id").alias("name"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("bigint"))
    size = F.length(F.coalesce("text", F.lit(""))).cast("double")
    return rows.select("tree", "name", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", size.alias("score"))


def _steps(nodes: DataFrame) -> list[DataFrame]:
    """Tables of steps of 1, 2, 4, ... messages upwards: (tree, node, up, top, score, depth). ``up`` is null beyond the root; score and depth count the
    message and those stepped over. A message that has arrived at its root is in no later table, so late rounds hold long threads only."""
    ids = nodes.select("tree", F.col("node").alias("parent"))
    known = nodes.join(ids, ["tree", "parent"], "left_semi").select("tree", "node", F.col("parent").alias("up"))
    first = nodes.select("tree", "node", F.coalesce("score", F.lit(0.0)).alias("score")).join(known, ["tree", "node"], "left")
    first = first.select("tree", "node", "up", F.coalesce("up", "node").alias("top"), "score", F.lit(1).cast("bigint").alias("depth"))
    tables = [materialize(first, "steps")]
    n = tables[0].count()
    while 1 << (len(tables) - 1) < n and not tables[-1].where(F.col("up").isNotNull()).isEmpty():
        near = tables[-1].where(F.col("up").isNotNull())
        everyone = _arrived(tables).union(near)
        far = everyone.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("top").alias("top2"), F.col("score").alias("score2"), F.col("depth").alias("depth2"))
        stepped = near.join(far, ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), F.col("top2").alias("top"), (F.col("score") + F.col("score2")).alias("score"), (F.col("depth") + F.col("depth2")).alias("depth"))
        tables.append(materialize(stepped, "steps"))
    return tables


def _arrived(tables: list[DataFrame]) -> DataFrame:
    """Messages that have reached their root, from all rounds."""
    return reduce(DataFrame.union, [t.where(F.col("up").isNull()) for t in tables])


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """Messages on the chosen root-to-leaf paths: tree, leaf, rank, node, distance (messages between it and the leaf).

    A path's score is the sum of its messages' scores; of each root the ``branches`` best paths are kept, ties to the smaller leaf. Going from the
    longest step to the shortest, each message found so far adds the one that many above it.
    """
    tables = _steps(nodes)
    leaves = _arrived(tables).join(nodes.select("tree", F.col("parent").alias("node")), ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree", "top").orderBy(F.desc("score"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    paths = chosen.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("bigint").alias("distance"))
    for k in range(len(tables) - 1, -1, -1):
        up = tables[k].where(F.col("up").isNotNull()).select("tree", "node", "up")
        both = F.array(F.struct(F.col("node"), F.col("distance")), F.struct(F.col("up").alias("node"), (F.col("distance") + (1 << k)).alias("distance")))
        both = F.filter(both, lambda at: at["node"].isNotNull())
        paths = paths.join(up, ["tree", "node"], "left").select("tree", "leaf", "rank", F.explode(both).alias("at")).select("tree", "leaf", "rank", "at.node", "at.distance")
    return paths


def format_trees(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path of reply trees (tree, name, node, parent, role, text, score and any more columns): name, leaf, rank,
    n_turns, formatted, and loss: spans (start, length) in signs of the escaped texts of assistant turns.

    tree and node must not be null; of rows that repeat a node the first by parent, role, text stays. A parent that isn't there
    makes its message a root; messages on or below a cycle have no root and are left out. Null roles and texts count as empty, null scores
    as 0. Columns beside those named are ignored; an empty table gives no rows. A path is one value and so is put together in one task.
    """
    fields = ["parent", "role", "text", "score", "name"]
    single = nodes.groupBy("tree", "node").agg(F.min(F.struct(*fields)).alias("row")).select("tree", "node", *[F.col(f"row.{f}").alias(f) for f in fields])
    single = materialize(single, "messages")
    rows = best_paths(single, branches).join(single.select("tree", "node", "name", "role", "text"), ["tree", "node"])
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    rows = rows.select("tree", "leaf", "rank", "name", "distance", (role == "assistant").alias("learned"), head.alias("head"), body.alias("body"))
    path, order = ["tree", "leaf", "rank"], Window.partitionBy("tree", "leaf", "rank").orderBy(F.desc("distance"))
    size = F.length("head") + F.length("body") + len(END)
    begins = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint")
    rows = rows.withColumn("begins", begins)
    turn = F.struct("begins", (F.col("begins") + F.length("head")).alias("start"), F.length("body").cast("bigint").alias("length"), "learned", F.concat("head", "body", F.lit(END)).alias("turn"))
    whole = rows.groupBy(*path).agg(F.first("name").alias("name"), F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "name", "leaf", "rank", F.size("turns").cast("bigint").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """Turns of a formatted conversation, (role, text), unescaped."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda t: t != "")
    inner = F.transform(parts, lambda t: F.substring(t, len(START) + 1, 2147483647))
    heads = lambda t: F.regexp_extract(t, _ROLE, 1)
    return F.transform(inner, lambda t: F.struct(unescape(heads(t)).alias("role"), unescape(t.substr(F.length(heads(t)) + 2, F.length(t))).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """Texts under the loss mask, unescaped, in order."""
    return F.transform(loss, lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
