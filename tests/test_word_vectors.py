"""Co-occurrence counts by brute force, and the factorisation against the exact one."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tarnwater.models import word_vectors


def test_counts_information_and_vectors(spark):
    draw = random.Random(8)
    docs = [[draw.choice("abcdefghi"[: draw.randint(2, 9)]) for _ in range(draw.randint(0, 30))] for _ in range(60)] + [None, [], ["a"], ["z", None, "z"]]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id bigint, words array<string>").repartition(3)
    wanted = Counter()
    for d in docs:
        kept = [w for w in d or () if w is not None]
        for i, x in enumerate(kept):
            wanted.update((min(x, y), max(x, y)) for y in kept[i + 1 : i + 4])
    counts = word_vectors.cooccurrences(rows, "words", window=3)
    assert {(r.a, r.b): r.n for r in counts.collect()} == dict(wanted)

    cells = {(x, y): n for (a, b), n in wanted.items() for x, y in {(a, b), (b, a)}}
    sums = Counter()
    for (x, _), n in cells.items():
        sums[x] += n
    total = sum(sums.values())
    exact = {k: v for k, n in cells.items() if (v := math.log(n * total / (sums[k[0]] * sums[k[1]]))) > 0}
    found = {(r.word, r.other): r.value for r in word_vectors.information(counts).collect()}
    assert found.keys() == exact.keys() and all(abs(found[k] - exact[k]) < 1e-9 for k in exact)

    names = sorted({x for k in exact for x in k})
    matrix = np.array([[exact.get((x, y), 0.0) for y in names] for x in names])
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-np.abs(values))[:3]
    learned = {r.word: r.vector for r in word_vectors.learn(rows, "words", 3, window=3).collect()}
    assert set(learned) == set(names)
    got = np.array([learned[w] for w in names])
    best = vectors[:, order] * np.sqrt(np.abs(values[order]))
    assert np.allclose(np.abs(got), np.abs(best), atol=1e-6) and (got.sum(0) >= -1e-9).all()
    assert word_vectors.learn(rows.where("id < 0"), "words", 2).count() == 0


def test_pairs_read_the_words_once(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, "c"), (3, None), (4, "")], "id int, text string")
    words = docs.select(F.split("text", " ").alias("words"))
    counts = word_vectors.cooccurrences(words, "words", window=1)
    assert {(r.a, r.b): r.n for r in counts.collect()} == {("a", "b"): 2}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and "zip_with" not in plan


def test_tasks_count_pairs_piece_by_piece(spark, monkeypatch):
    draw = random.Random(3)
    docs = [[draw.randrange(4) if draw.random() < 0.9 else None for _ in range(draw.randrange(9))] for _ in range(40)] + [None, []]
    wanted = Counter()
    for d in docs:
        kept = [w for w in d or () if w is not None]
        for i, x in enumerate(kept):
            wanted.update((min(x, y), max(x, y)) for y in kept[i + 1 : i + 6])
    rows = spark.createDataFrame([(d,) for d in docs], "ids array<int>").coalesce(1)
    for piece in (3, 1000):
        monkeypatch.setattr(word_vectors, "PIECE", piece)
        counts = word_vectors.cooccurrences(rows, "ids")
        assert {(r.a, r.b): r.n for r in counts.collect()} == dict(wanted)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert counts.schema.simpleString() == "struct<a:int,b:int,n:bigint>"
