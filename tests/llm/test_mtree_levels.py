"""The M-tree with several levels below few roots against all scores."""

import numpy as np
import pytest

from tarnwater.llm import mtree


@pytest.fixture(scope="module")
def table(spark):
    """Clusters, a third of all rows one vector, a second vector in a twentieth, one far row, repeated ids."""
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(12, 6)) * 3
    x = centres[draw.integers(0, 12, 2400)] + draw.normal(size=(2400, 6)) * 0.3
    x[:800], x[800:920], x[920] = x[0], x[801], 40.0
    ids = [int(i) % 2350 for i in draw.permutation(2400)]
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "id long, e array<double>").repartition(5)


def test_deep_tree_equals_all_scores(table):
    vectors = mtree.integer_vectors(table, "id", "e", 16)
    rows = sorted((r["row"], r["vec_id"], r["v"]) for r in vectors.collect())
    v = np.array([r[2] for r in rows])
    expected = []
    for number, vec_id, q in rows:
        if vec_id % 20 == 0:
            hits = sorted((-int(s), other[1]) for other, s in zip(rows, v @ np.array(q), strict=True) if other[0] != number)[:7]
            expected += [(vec_id, rank + 1, other, -score) for rank, (score, other) in enumerate(hits)]
    found = mtree.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=7, page=8, query_block=40, roots=2)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_levels_keep_every_row_inside_its_radius(table):
    vectors = mtree.integer_vectors(table, "id", "e", 16)
    index = mtree.Index(vectors, page=8, most_roots=2)
    assert len(index.children) >= 2 and len(index.pivots) == 2
    nodes = index.nodes.toPandas()
    assert sorted(n for row in nodes["numbers"] for n in row) == sorted(r["row"] for r in vectors.select("row").collect())
    leaves = {}
    for level in index.children:
        for r in level.collect():
            assert r["n"] <= r["parent_n"] and r["node"] // (2 * mtree.FAN) == r["parent"]
            leaves[r["node"]] = r
    for r in nodes.itertuples():
        if r.leaf in leaves:
            to_leaf = np.sqrt(((np.array(r.pivot) - np.array(leaves[r.leaf]["pivot"])) ** 2).sum())
            assert abs(to_leaf - r.parent_distance) < 1e-4 and to_leaf <= leaves[r.leaf]["radius"] + 1e-4
            assert leaves[r.leaf]["pages"] > 0 and r.cut < leaves[r.leaf]["pages"] and max(r.distances) <= r.radius + 1e-9
    sizes = nodes.assign(n=nodes["ids"].map(len)).groupby(["leaf", "cut"])["n"].sum()
    assert sizes.max() < 3 * mtree.UNCUT * 8
