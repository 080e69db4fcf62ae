"""Exact top-k inner-product search over vectors with an M-tree of paged metric nodes.

Vectors get one more component that gives all of them the same length (M, the longest), queries get 0 there: the squared distance
is then |q|^2 + M^2 - 2 <q, x>, so the nearest vectors have the highest inner products and the triangle inequality holds.

* Roots: at most MOST_ROOTS pivots, picked farthest-first on a bounded sample; every row is routed to its nearest one.
* Levels: a node with more than UNCUT pages of rows is split again: from a bounded sample of its own rows up to FAN pivots are picked, half by
  hash and half farthest-first, and its rows, dealt out in chunks, go to the nearest. Children keep pivot, covering radius and distance to the parent's pivot.
  So it goes on until nodes are small, hold copies of one vector only, or lose less than a tenth of their rows by a split.
* Pages: a leaf is one page; one that can't be split is cut by a hash of the rows' numbers, so no group grows with the data, however many vectors are equal.
* Nodes of a page: its rows hang at the nearest of about sqrt(n) pivots. Each is one row of the index table: pivot, covering radius,
  distance to the leaf's pivot, its vectors and their distances to the pivot.

A query first follows the nearest pivots down to one page, which gives a lower limit for its k-th score. Then all queries go down level by level, to every child that
parent distance and covering radius can't exclude; a child's distance is only computed where the stored one doesn't exclude it. Inside a page, the
stored distances exclude nodes before their distance is computed, the others are visited best-first until no bound reaches the k-th score, and rows
whose stored distance excludes them are not scored. Bounds are compared with a margin for rounding; scores are exact
integers, so results are exact, ties included. Queries are taken in blocks, so that each page meets a bounded number at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnwater.session import materialize

PAGE, MOST_ROOTS, SAMPLE, QUERY_BLOCK = 1024, 256, 4096, 4096
#: A node of more than UNCUT pages of rows is split, into FAN children at most, picked from about NODE_SAMPLE rows. At most DEPTH levels below the roots, as
#: a node's number is its parent's times 2 FAN plus its own from 1, in 64 bits. A chunk is what one task routes at a time.
UNCUT, FAN, NODE_SAMPLE, DEPTH, CHUNK = 4, 16, 512, 10, 8192

ROW_SCHEMA = "row bigint, vec_id bigint, v array<bigint>, node bigint, distance double"
CHILD_SCHEMA = "parent bigint, parent_n bigint, node bigint, pivot array<double>, parent_distance double"
VISIT_SCHEMA = "row bigint, vec_id bigint, v array<bigint>, limit bigint, node bigint, distance double, pages bigint"
NODE_SCHEMA = "leaf bigint, cut bigint, pivot array<double>, radius double, parent_distance double, ids array<bigint>, numbers array<bigint>, rows binary, distances array<double>"
HIT_SCHEMA = "query bigint, query_id bigint, vec_id bigint, score bigint"
RESULT_SCHEMA = "query_id bigint, rank int, vec_id bigint, score bigint"


def integer_vectors(table: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """(row, vec_id, v): floor(scale * x) of every component as bigint, and a number that tells rows apart that repeat an id. Rows with
    a null id, a null vector or null or non-finite components take no part. Written once, which fixes the numbers."""
    x = F.col(vector).cast("array<double>")
    finite = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = table.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).where(finite)
    rows = rows.select(F.col(id_column).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(scale * c)).alias("v"))
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "vectors")


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as float64, filled up with zeros to ``dim``."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(np.asarray(array.offsets, np.int64)) if len(array) else np.zeros(0, np.int64)
    flat = np.asarray(array.flatten(), np.float64)
    out = np.zeros((len(array), dim))
    out[np.repeat(np.arange(len(array)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the component that gives all of them the length of the longest."""
    return np.hstack([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0))


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """Places of up to n rows, each the farthest from those before it; fewer if the rest are copies."""
    chosen, near = [0], _distances(x, x[:1])[:, 0]
    while len(chosen) < min(n, len(x)) and near.max() > 1e-6:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


class Index:
    """The tree: roots, bounded in number, in the driver and in tasks; children of each level and nodes of the pages as tables."""

    def __init__(self, vectors: DataFrame, page: int = PAGE, most_roots: int = MOST_ROOTS, sample: int = SAMPLE):
        length = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
        facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(length).alias("longest")).first()
        self.n, self.dim, self.longest, self.most = facts["n"], max(facts["dim"] or 0, 1), facts["longest"] or 0.0, UNCUT * page
        some = vectors.orderBy(F.xxhash64("row"), "row").limit(sample).select("v").collect()
        rows = np.zeros((len(some), self.dim))
        for i, r in enumerate(some):
            rows[i, : len(r["v"])] = r["v"]
        lifted = _lifted(rows, self.longest)
        wanted = min(most_roots, -(-self.n // page))
        self.pivots = lifted[farthest_first(lifted, wanted)] if len(lifted) else np.zeros((0, self.dim + 1))
        self.children: list[DataFrame] = []
        if not self.n:
            return
        level = materialize(self._routed(vectors), "routed")
        nodes = materialize(self._sized(level).withColumn("pages", self._pages(F.lit(True))), "roots")
        # One row per root: at most ``most_roots``.
        known = {r["node"]: r for r in nodes.collect()}
        self.size, self.radius, self.pages = (np.array([known[i + 1][c] if i + 1 in known else 0 for i in range(len(self.pivots))], float) for c in ("n", "radius", "pages"))
        self.used = self.size > 0
        placed, depth, inner = [], 0, int((self.used & (self.pages == 0)).sum())
        while inner:
            placed.append(self._placed(level, nodes))
            level, nodes = self._split(level, nodes, depth)
            self.children.append(nodes)
            depth, inner = depth + 1, nodes.where("pages = 0").count()
        rows = self._placed(level, nodes)
        for table in placed:
            rows = rows.unionByName(table)
        self.nodes = materialize(self._built(rows), "nodes")

    def _routed(self, vectors: DataFrame) -> DataFrame:
        pivots, dim, longest = self.pivots, self.dim, self.longest

        def route(batches):
            for batch in batches:
                d = _distances(_lifted(_matrix(batch.column("v"), dim), longest), pivots)
                columns = [*batch.columns, pa.array(d.argmin(1) + 1, pa.int64()), pa.array(d.min(1))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "vec_id", "v", "node", "distance"])

        return vectors.select("row", "vec_id", "v").mapInArrow(route, ROW_SCHEMA)

    def _sized(self, level: DataFrame) -> DataFrame:
        return level.groupBy("node").agg(F.count("*").alias("n"), F.max("distance").alias("radius"), F.min("row").alias("least"))

    def _pages(self, goes_on: Column) -> Column:
        """0 for a node that is split, else its number of pages. Different vectors of whole numbers are at least 1 apart."""
        inner = (F.col("n") > self.most) & (F.col("radius") >= 0.5) & goes_on
        return F.when(inner, 0).otherwise(F.ceil(F.col("n") / self.most)).cast("bigint")

    @staticmethod
    def _placed(level: DataFrame, nodes: DataFrame) -> DataFrame:
        """Rows of leaves with their page."""
        leaves = nodes.where("pages > 0").select("node", "pages")
        return level.join(leaves, "node").withColumn("cut", F.pmod(F.xxhash64("row"), F.col("pages"))).drop("pages")

    def _split(self, level: DataFrame, nodes: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
        """Rows of the inner nodes routed to children, and those children (parent, node, pivot, parent_distance, n, radius, least, pages)."""
        dim, longest, most = self.dim, self.longest, self.most
        rows = level.join(nodes.where("pages = 0").select("node", "n", "least"), "node")

        def pick(table: pa.Table) -> pa.Table:
            table = table.sort_by([("order", "ascending"), ("row", "ascending")])
            lifted, n, node = _lifted(_matrix(table.column("v"), dim), longest), table.column("n")[0].as_py(), table.column("node")[0].as_py()
            wanted = min(FAN, max(2, 2 * -(-n // most)))
            chosen = list(range(min(wanted // 2, len(lifted))))
            near = _distances(lifted, lifted[chosen]).min(1)
            while len(chosen) < wanted and near.max() > 1e-6 and int(near.argmax()) not in chosen:
                chosen.append(int(near.argmax()))
                near = np.minimum(near, _distances(lifted, lifted[chosen[-1:]])[:, 0])
            numbers = [node * 2 * FAN + 1 + i for i in range(len(chosen))]
            return pa.table({
                "parent": pa.array([node] * len(chosen), pa.int64()), "parent_n": pa.array([n] * len(chosen), pa.int64()), "node": pa.array(numbers, pa.int64()),
                "pivot": pa.array([list(x) for x in lifted[chosen]], pa.list_(pa.float64())), "parent_distance": pa.array(table.column("distance").to_numpy()[chosen]),
            })

        order = F.xxhash64("row", F.lit(depth))
        sample = rows.where((F.pmod(order, F.col("n")) < NODE_SAMPLE) | (F.col("row") == F.col("least"))).withColumn("order", order)
        picked = materialize(sample.groupBy("node").applyInArrow(pick, CHILD_SCHEMA), "picked")

        def route(key, table: pa.Table, pivots: pa.Table) -> pa.Table:
            if not table.num_rows:
                return _empty(ROW_SCHEMA)
            pivots = pivots.sort_by("node")
            d = _distances(_lifted(_matrix(table.column("v"), dim), longest), _matrix(pivots.column("pivot"), dim + 1))
            child = pivots.column("node").to_numpy()[d.argmin(1)]
            return pa.table([table.column("row"), table.column("vec_id"), table.column("v"), pa.array(child, pa.int64()), pa.array(d.min(1))], names=["row", "vec_id", "v", "node", "distance"])

        chunks = lambda n: F.ceil(F.col(n) / CHUNK).cast("bigint")
        dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(-1)), chunks("n"))).groupBy("node", "chunk")
        each = picked.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks("parent_n") - 1))).groupBy("parent", "chunk")
        routed = materialize(dealt.cogroup(each).applyInArrow(route, ROW_SCHEMA), "routed")
        smaller = F.lit(depth + 1 < DEPTH) & (F.col("n") * 10 <= F.col("parent_n") * 9)
        return routed, materialize(picked.join(self._sized(routed), "node").withColumn("pages", self._pages(smaller)), "children")

    def _built(self, rows: DataFrame) -> DataFrame:
        dim, longest = self.dim, self.longest

        def build(table: pa.Table) -> pa.Table:
            table = table.sort_by("row")
            x = _matrix(table.column("v"), dim)
            lifted, ids, numbers, to_leaf = _lifted(x, longest), *(table.column(c).to_numpy() for c in ("vec_id", "row", "distance"))
            chosen = farthest_first(lifted, int(np.ceil(np.sqrt(len(x)))))
            d = _distances(lifted, lifted[chosen])
            nearest = d.argmin(1)
            out = []
            for k in np.unique(nearest):
                own = np.flatnonzero(nearest == k)
                out.append({
                    "leaf": table.column("node")[0].as_py(), "cut": table.column("cut")[0].as_py(), "pivot": lifted[chosen[k]], "radius": d[own, k].max(),
                    "parent_distance": to_leaf[chosen[k]], "ids": ids[own], "numbers": numbers[own], "rows": x[own].tobytes(), "distances": d[own, k],
                })
            return pa.Table.from_pylist(out, _NODE_TYPE)

        return rows.groupBy("node", "cut").applyInArrow(build, NODE_SCHEMA)


_NODE_TYPE = pa.schema([
    ("leaf", pa.int64()), ("cut", pa.int64()), ("pivot", pa.list_(pa.float64())), ("radius", pa.float64()), ("parent_distance", pa.float64()),
    ("ids", pa.list_(pa.int64())), ("numbers", pa.list_(pa.int64())), ("rows", pa.binary()), ("distances", pa.list_(pa.float64())),
])


def _empty(schema: str) -> pa.Table:
    """No rows of a schema of bigint, double and array<bigint> columns."""
    types = {"bigint": pa.int64(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, types[kind]) for name, kind in (c.split() for c in schema.split(", "))]).empty_table()


class _Queries:
    """A block of queries with the bounds of their scores."""

    def __init__(self, table: pa.Table | pa.RecordBatch, dim: int, longest: float):
        self.v = _matrix(table.column("v"), dim)
        self.lifted = np.hstack([self.v, np.zeros((len(self.v), 1))])
        self.limit = np.array([-np.inf if x is None else x for x in table.column("limit").to_pylist()], np.float64)
        self.both = (self.v * self.v).sum(1) + longest
        self.margin = 1e-9 * (self.both + longest) + 0.25

    def reach(self, distance: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Highest score at that distance or farther."""
        low = np.maximum(distance, 0)
        return (self.both[rows, None] - low * low) / 2 + self.margin[rows, None]


def _search_page(nodes: pa.Table, queries: pa.Table, dim: int, longest: float, k: int) -> pa.Table:
    """Best-first search of one page by a block of queries: each one's k best rows that reach its limit, its own row left out."""
    block = _Queries(queries, dim, longest)
    q, limit, reach = block.v, block.limit, block.reach
    own, query_ids = queries.column("row").to_numpy(), queries.column("vec_id").to_numpy()
    pivots, radius = _matrix(nodes.column("pivot"), dim + 1), nodes.column("radius").to_numpy()
    everyone = np.arange(len(q))
    best = reach(np.abs(queries.column("distance").to_numpy()[:, None] - nodes.column("parent_distance").to_numpy()) - radius)
    near = np.flatnonzero((best >= limit[:, None]).any(0))
    to_node = np.full(best.shape, np.inf)
    to_node[:, near] = _distances(block.lifted, pivots[near])
    best = np.where(best >= limit[:, None], reach(to_node - radius), -np.inf)
    rows = [np.frombuffer(r, np.float64).reshape(-1, dim) for r in nodes.column("rows").to_pylist()]
    ids, numbers, spread = (nodes.column(c).to_pylist() for c in ("ids", "numbers", "distances"))
    top_score, top_id = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
    order = np.argsort(-best, axis=1, kind="stable")
    for turn in range(order.shape[1]):
        node = order[:, turn]
        live = (best[everyone, node] >= np.maximum(limit, top_score[:, -1])) & np.isfinite(best[everyone, node])
        if not live.any():
            break
        for j in np.unique(node[live]):
            who = everyone[live & (node == j)]
            floor = np.maximum(limit, top_score[:, -1])[who]
            possible = reach(np.abs(to_node[who, j][:, None] - np.array(spread[j])), who) >= floor[:, None]
            some = np.flatnonzero(possible.any(0))
            if not len(some):
                continue
            there = np.array(ids[j])[some]
            score = q[who] @ rows[j][some].T
            score[np.array(numbers[j])[some][None] == own[who][:, None]] = -np.inf
            score[score < floor[:, None]] = -np.inf
            better = np.flatnonzero(np.isfinite(score).any(1))
            if not len(better):
                continue
            who, score = who[better], score[better]
            all_score = np.hstack([top_score[who], score])
            all_id = np.hstack([top_id[who], np.broadcast_to(there, score.shape)])
            first = np.lexsort((all_id, -all_score), axis=1)[:, :k]
            top_score[who], top_id[who] = np.take_along_axis(all_score, first, 1), np.take_along_axis(all_id, first, 1)
    found = np.isfinite(top_score)
    return pa.table({
        "query": pa.array(np.repeat(own, found.sum(1)), pa.int64()), "query_id": pa.array(np.repeat(query_ids, found.sum(1)), pa.int64()), "vec_id": pa.array(top_id[found], pa.int64()), "score": pa.array(np.rint(top_score[found]).astype(np.int64)),
    })


def _chosen(table: pa.Table | pa.RecordBatch, query: np.ndarray, node: np.ndarray, distance: np.ndarray, pages: np.ndarray) -> list[pa.Array]:
    """Columns of the visits of those queries to those nodes."""
    rows = table.take(pa.array(query, pa.int64()))
    return [*(rows.column(c) for c in ("row", "vec_id", "v", "limit")), pa.array(node, pa.int64()), pa.array(distance, pa.float64()), pa.array(pages, pa.int64())]


_VISIT = ["row", "vec_id", "v", "limit", "node", "distance", "pages"]


def _nearest(distance: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """The nearest node of each query that holds more than k rows; the nearest one if none does."""
    return (np.where(size > k, distance, np.inf) if (size > k).any() else distance).argmin(1)


def _blocked(visits: DataFrame, blocks: int) -> DataFrame:
    return visits.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)))


def _descend(index: Index, queries: DataFrame, blocks: int, k: int, home: bool) -> DataFrame:
    """Visits of queries (row, vec_id, v, limit) to leaves: to the nearest one, or to all that may hold a row that reaches the limit."""
    dim, longest, pivots, radius, pages, size, used = index.dim, index.longest, index.pivots, index.radius, index.pages, index.size, index.used

    def at_roots(batches):
        for batch in batches:
            block = _Queries(batch, dim, longest)
            d = _distances(block.lifted, pivots)
            if home:
                row, root = np.arange(len(d)), _nearest(np.where(used, d, np.inf), size, k)
            else:
                row, root = np.nonzero((block.reach(d - radius) >= block.limit[:, None]) & used)
            yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in _chosen(batch, row, root + 1, d[row, root], pages[root])], names=_VISIT)

    def at_children(key, children: pa.Table, queries: pa.Table) -> pa.Table:
        if not children.num_rows or not queries.num_rows:
            return _empty(VISIT_SCHEMA)
        children = children.sort_by("node")
        block, near, cover = _Queries(queries, dim, longest), _matrix(children.column("pivot"), dim + 1), children.column("radius").to_numpy()
        numbers, number_pages = children.column("node").to_numpy(), children.column("pages").to_numpy()
        if home:
            d = _distances(block.lifted, near)
            row, child = np.arange(len(d)), _nearest(d, children.column("n").to_numpy(), k)
        else:
            possible = block.reach(np.abs(queries.column("distance").to_numpy()[:, None] - children.column("parent_distance").to_numpy()) - cover) >= block.limit[:, None]
            some = np.flatnonzero(possible.any(0))
            d = np.full(possible.shape, np.inf)
            d[:, some] = _distances(block.lifted, near[some])
            row, child = np.nonzero(possible & (block.reach(d - cover) >= block.limit[:, None]))
        return pa.table(_chosen(queries, row, numbers[child], d[row, child], number_pages[child]), names=_VISIT)

    visits = materialize(queries.select("row", "vec_id", "v", "limit").mapInArrow(at_roots, VISIT_SCHEMA), "visits")
    leaves = visits.where("pages > 0")
    for level in index.children:
        inner = _blocked(visits.where("pages = 0"), blocks)
        pairs = inner.select(F.col("node").alias("of"), F.col("block").alias("by")).distinct()
        met = level.join(pairs, F.col("parent") == F.col("of")).drop("of").groupBy("parent", "by")
        visits = materialize(met.cogroup(inner.groupBy("node", "block")).applyInArrow(at_children, VISIT_SCHEMA), "visits")
        leaves = leaves.unionByName(visits.where("pages > 0"))
    return leaves


def _visit(index: Index, visits: DataFrame, blocks: int, k: int) -> DataFrame:
    """Hits of visits (..., cut) in their pages."""
    dim, longest = index.dim, index.longest
    visits = _blocked(visits, blocks)
    pairs = visits.select(F.col("node").alias("of"), F.col("cut").alias("part"), F.col("block").alias("by")).distinct()
    met = index.nodes.join(pairs, (F.col("leaf") == F.col("of")) & (F.col("cut") == F.col("part"))).drop("of", "part").groupBy("leaf", "cut", "by")

    def search(nodes: pa.Table, queries: pa.Table) -> pa.Table:
        if not nodes.num_rows or not queries.num_rows:
            return _empty(HIT_SCHEMA)
        return _search_page(nodes, queries, dim, longest, k)

    return met.cogroup(visits.groupBy("node", "cut", "block")).applyInArrow(search, HIT_SCHEMA)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, page: int = PAGE, query_block: int = QUERY_BLOCK, roots: int = MOST_ROOTS) -> DataFrame:
    """The k highest inner products of every query with ``vectors`` other than its own row; ties to the smaller vec_id. Both tables
    come from :func:`integer_vectors` (row, vec_id, v); a query is left out of its own hits by its row number.

    One row per hit: query_id, rank (from 1), vec_id, score; all rows if there are fewer than k. Rows that repeat an id are candidates and
    queries each, with ranks of their own, and the other rows of a query's id are candidates too. Vectors of different
    lengths meet as if filled up with zeros. Scores have to stay below 2**53. Equal vectors tie. Empty tables give no rows.
    """
    queries = materialize(queries, "queries")
    index = Index(vectors, page, roots)
    if not index.n:
        return queries.sparkSession.createDataFrame([], RESULT_SCHEMA)
    blocks = max(1, -(-queries.count() // query_block))
    homes = _descend(index, queries.withColumn("limit", F.lit(None).cast("bigint")), blocks, k, True).withColumn("cut", F.lit(0).cast("bigint"))
    limits = _best(_visit(index, homes, blocks, k), k).where(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("limit"))
    leaves = _descend(index, queries.join(limits, "row", "left"), blocks, k, False)
    hits = _visit(index, leaves.withColumn("cut", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pages") - 1))), blocks, k)
    return _best(hits, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
