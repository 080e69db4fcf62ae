"""N-gram Jaccard join of documents by MinHash banding, with exact verification.

1. Every text's set of word n-grams gets a 128-bit name and the hashes of its signature's bands; rows and bands are chosen so that a pair at the threshold is
   met with the target recall. Documents with one set (copies) are one node from here on, with their number.
2. Nodes meet where a band's hashes agree. A bucket is cut into blocks of BLOCK nodes, and each pair of blocks is one unit of work, so no
   unit grows with the bucket. A pair counts only in the first band in which it agrees, so units without new pairs end here.
3. Only nodes with new pairs bring their full n-gram sets to their units, where every new pair is verified. A unit returns, per
   node, the documents linked to it and one edge that holds the unit's components together: never the pairs.
4. Components of those edges are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.llm.crf import word_table
from tarnwater.llm.encode import lean, text_slices, whole_rows
from tarnwater.session import materialize

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
MOST_HASHES, BLOCK = 128, 256
TEXT_BYTES = 4_000_000

_ROWS = "doc_id bigint, text_hash bigint, set_id binary, n bigint, bands array<bigint>"


def band_shape(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest needless candidates, that reach the recall at the threshold with at most ``most`` hashes."""
    for rows in range(most, 0, -1):
        miss = 1 - threshold**rows
        bands = int(np.ceil(np.log(1 - recall) / np.log(miss))) if miss else 1
        if bands * rows <= most:
            return bands, rows
    return most, 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted hashes of each text's distinct n-grams of lower-cased words. A text of fewer words has one n-gram of all its words; one without words none."""
    names, codes, bounds = word_table(texts)
    hashed = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))[codes]
    grams = np.zeros(max(len(hashed) - words + 1, 0), np.uint64)
    for j in range(words):
        grams = _mixed(grams + hashed[j : len(hashed) - words + 1 + j] + np.uint64(j + 1)) if len(grams) else grams
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        else:
            short = np.zeros(1, np.uint64)
            for j in range(b - a):
                short = _mixed(short + hashed[a + j] + np.uint64(j + 1))
            yield short[: int(b > a)]


class Signer:
    """MinHash of n-gram sets, as one hash per band."""

    def __init__(self, bands: int, rows: int):
        numbers = np.random.default_rng(20_240_607).integers(1, 1 << 63, 2 * bands * rows, dtype=np.uint64)
        self.bands, self.rows = bands, rows
        self.times, self.plus = numbers[: bands * rows] | np.uint64(1), numbers[bands * rows :]

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(len(self.times), np.iinfo(np.uint64).max, np.uint64)
        for a in range(0, len(grams), 4096):
            part = grams[a : a + 4096, None] * self.times + self.plus
            low = np.minimum(low, (part >> np.uint64(16)).min(0))
        low = low.reshape(self.bands, self.rows)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for j in range(self.rows):
            out = _mixed(out + low[:, j])
        return out.view(np.int64)


def _name(grams: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(grams.tobytes())


def signatures(docs: DataFrame, words: int, shape: tuple[int, int]) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, set_id, n (distinct n-grams), bands."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_hash().alias("text_hash"), F.col("text").cast("string").alias("text"))

    def sign(batches):
        signer = Signer(*shape)
        for whole in batches:
            for a, b in text_slices(whole.column("text"), TEXT_BYTES):
                batch = whole.slice(a, b - a)
                ids, sizes, bands = [], [], []
                for grams in gram_sets(batch.column("text"), words):
                    ids.append(_name(grams))
                    sizes.append(len(grams))
                    bands.append(signer(grams))
                columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "set_id", "n", "bands"])

    return materialize(rows.mapInArrow(lean(sign), _ROWS), "signatures")


def _text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of rows sorted by ``keys``, and where each group begins and the last ends."""
    rest: pa.Table | None = None

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for key in keys:
            values = table.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        if not table.num_rows:
            continue
        at = starts(table)
        rest = table.slice(at[-1])
        if len(at) > 1:
            yield table.slice(0, at[-1]), at
    if rest is not None and rest.num_rows:
        rest = rest.combine_chunks()
        yield rest, np.array([0, rest.num_rows])


_UNIT = ["band", "hash", "i", "j"]


def _list_matrix(column: pa.ChunkedArray) -> np.ndarray:
    array = column.combine_chunks()
    return np.asarray(array.flatten()).reshape(len(array), -1)


def _new_pairs(bands: np.ndarray, band: int, block: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a unit's nodes that agree in no earlier band."""
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    met = np.zeros((len(left), len(right)), bool)
    for b in range(band):
        met |= bands[left, b][:, None] == bands[right, b][None]
    if i == j:
        met |= np.tri(len(left), dtype=bool)
    a, b = np.nonzero(~met)
    return left[a], right[b]


def units_of_work(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Nodes that have to be compared, by unit: (band, hash, i, j, block, set_id)."""
    at = sets.select("set_id", F.posexplode("bands").alias("band", "hash"))
    shared = at.groupBy("band", "hash").agg(F.count("*").alias("m")).where("m > 1")
    met = at.join(shared, ["band", "hash"])
    parts = F.ceil(F.col("m") / block).cast("int")
    met = met.withColumn("block", F.pmod(F.xxhash64("set_id"), parts).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    units = met.select("band", "hash", "block", "set_id", F.explode(pairs).alias("unit")).select("band", "hash", "unit.i", "unit.j", "block", "set_id")
    units = units.join(sets.select("set_id", "bands"), "set_id").repartition(*_UNIT).sortWithinPartitions(*_UNIT)

    def needed(batches):
        names = [*_UNIT, "block", "set_id"]
        for table, at in _whole_groups(batches, _UNIT):
            bands, block_of = _list_matrix(table.column("bands")), table.column("block").to_numpy()
            band, first, second = (table.column(c).to_numpy() for c in ("band", "i", "j"))
            keep = np.zeros(table.num_rows, bool)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                x, y = _new_pairs(bands[a:b], band[a], block_of[a:b], first[a], second[a])
                keep[a + x] = keep[a + y] = True
            kept = table.filter(pa.array(keep)).select(names).combine_chunks()
            yield from kept.to_batches()

    return materialize(units.mapInArrow(lean(needed), "band int, hash bigint, i int, j int, block int, set_id binary"), "units")


def candidate_sets(docs: DataFrame, sets: DataFrame, units: DataFrame, words: int, shape: tuple[int, int]) -> DataFrame:
    """Full n-gram sets of the nodes that have to be compared, each from one of its documents: (set_id, copies, bands, grams)."""
    wanted = sets.join(units.select("set_id").distinct(), "set_id", "left_semi").select("copies", F.col("rep.doc_id").alias("_doc"), F.col("rep.text_hash").alias("_hash"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_hash().alias("text_hash"), F.col("text").cast("string").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    chosen = rows.join(wanted, same).select("copies", "text")

    def collect(batches):
        signer = Signer(*shape)
        for whole in batches:
            for a, b in text_slices(whole.column("text"), TEXT_BYTES):
                batch = whole.slice(a, b - a)
                sets_of = list(gram_sets(batch.column("text"), words))
                columns = [pa.array([_name(g) for g in sets_of], pa.binary()), batch.column("copies"), pa.array([signer(g) for g in sets_of], pa.list_(pa.int64())), pa.array([g.tobytes() for g in sets_of], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["set_id", "copies", "bands", "grams"])

    return materialize(chosen.mapInArrow(lean(collect), "set_id binary, copies bigint, bands array<bigint>, grams binary"), "gram-sets").dropDuplicates(["set_id"])


def _verified(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs reach the threshold."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    good = np.minimum(size[x], size[y]) >= threshold * np.maximum(size[x], size[y])
    out = np.zeros(len(x), bool)
    todo = np.flatnonzero(good)
    if not len(todo):
        return out
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    starts = ends - size
    marked = np.zeros(codes.max() + 1, bool)
    order = todo[np.argsort(x[todo], kind="stable")]
    for group in np.split(order, np.flatnonzero(np.diff(x[order])) + 1):
        one, others = x[group[0]], y[group]
        own = codes[starts[one] : ends[one]]
        marked[own] = True
        if 4 * len(others) > len(sets):
            both = np.add.reduceat(marked[codes], starts, dtype=np.int64)[others]
        else:
            both = np.array([np.count_nonzero(marked[codes[starts[o] : ends[o]]]) for o in others.tolist()])
        marked[own] = False
        out[group] = both >= threshold * (size[one] + size[others] - both) - 1e-9
    return out


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component under the edges."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def links(units: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Verified links by unit and node: (set_id, linked documents, root: a node of the same component)."""
    members = units.join(sets, "set_id").repartition(*_UNIT).sortWithinPartitions(*_UNIT)

    def verify(batches):
        for table, at in _whole_groups(batches, _UNIT):
            bands, block_of = _list_matrix(table.column("bands")), table.column("block").to_numpy()
            band, first, second = (table.column(c).to_numpy() for c in ("band", "i", "j"))
            copies, raw, ids = table.column("copies").to_numpy(), table.column("grams").to_pylist(), table.column("set_id").to_pylist()
            out: list[list] = [[], [], []]
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                x, y = _new_pairs(bands[a:b], band[a], block_of[a:b], first[a], second[a])
                good = _verified([np.frombuffer(g, np.uint64) for g in raw[a:b]], x, y, threshold)
                x, y = x[good], y[good]
                n = np.bincount(x, copies[a + y], b - a) + np.bincount(y, copies[a + x], b - a)
                root = _roots(b - a, x, y)
                for m in np.flatnonzero(n).tolist():
                    for column, value in zip(out, (ids[a + m], int(n[m]), ids[a + root[m]]), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["set_id", "linked", "root"])

    return materialize(members.mapInArrow(lean(verify), "set_id binary, linked bigint, root binary"), "links")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of each node's component, (node, label), for undirected edges (a, b): labels move along edges and jump to their own label's label until none changes."""
    both = edges.where("a <> b").select("a", "b").distinct()
    both = materialize(both.union(both.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        moved = materialize(moved, "labels")
        jump = moved.select(F.col("node").alias("via"), F.col("label").alias("far"))
        moved = materialize(moved.join(jump, F.col("label") == F.col("via")).select("node", F.least("label", "far").alias("label"), "old"), "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and any more columns): doc_id, text_hash, class_id (smallest doc_id of its class), links (other
    documents whose n-gram sets reach the threshold with its own), kept (it is the row of its class that stays).

    Words are runs of letters, marks and digits, lower-cased. Documents with equal sets are copies and linked. A null or empty text, or one without words, has no n-grams:
    it is a class of its own, without links. A text of fewer than ``words`` words is one n-gram. The row with the smallest doc_id stays, null
    ids last, ties to the smaller hash of the text; of rows that repeat both all are marked. Other columns are ignored; an empty table gives no rows.
    """
    shape = band_shape(threshold, recall)
    rows = signatures(docs, words, shape)
    rep = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    sets = materialize(rows.where("n > 0").groupBy("set_id").agg(F.min(rep).alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "sets")
    units = units_of_work(sets)
    found = links(units, candidate_sets(docs, sets, units, words, shape), threshold)
    labels = components(found.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("set_id").agg(F.sum("linked").alias("linked"))
    nodes = sets.select("set_id", "rep", "copies").join(linked, "set_id", "left").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    nodes = materialize(nodes.select("set_id", "rep", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), F.coalesce("label", "set_id").alias("label")), "nodes")
    best = nodes.groupBy("label").agg(F.min("rep").alias("best"))
    classes = nodes.join(best, "label").select("set_id", "links", "best")
    own = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    joined = rows.where("n > 0").select("doc_id", "text_hash", "set_id").join(classes, "set_id")
    joined = joined.select("doc_id", "text_hash", F.col("best.doc_id").alias("class_id"), "links", own.alias("kept"))
    alone = rows.where("n = 0").select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("links"), F.lit(True).alias("kept"))
    return joined.union(alone)


def one_per_class(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat doc_id and text, one stays."""
    kept = near_duplicates(docs, words, threshold, recall).where("kept").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    rows = whole_rows(docs).withColumns({"doc_id": F.col("row.doc_id").cast("bigint"), "text_hash": _text_hash("row.text")})
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("row.*")
