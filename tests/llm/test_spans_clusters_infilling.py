"""Decontamination, centroid clustering and fill-in-middle against brute force, on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnwater.llm import bisectors, infilling, winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, row string, salt string, start string, words string, hits string, n string, form string, place string"
LONG = " ".join(f"w{i % 991} x{i % 37}." for i in range(20_000))


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def judged(text, items, span=10):
    """Hit words and items by comparing every window with every place."""
    words, hit, names = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        n = min(span, len(own))
        for w in {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == w:
                    hit.update(range(i, i + n))
                    names.add(str(item))
    return len(words), len(hit), sorted(names - {"None"})


def table(spark, rows, schema=DOCS):
    width = len(schema.split(",")) - 2
    return spark.createDataFrame([(*r, *["x"] * width) for r in rows], schema).repartition(3)


SPOKEN = "one two three four five six seven eight nine ten eleven twelve"


def test_decontamination_edges(spark):
    items = [(1, SPOKEN), (1, "other item with the same id and more than ten words in it now"), (2, "Tiny item"), (3, None), (4, "!!!"), (None, "named by nobody here"), (5, SPOKEN.upper()), (6, "the"), (10, "É日本 ١٢")]
    docs = [
        (1, f"a b {SPOKEN} c {SPOKEN}"), (2, SPOKEN.replace(" ", ", ").upper()), (2, SPOKEN.replace(" ", ", ").upper()), (3, " ".join(SPOKEN.split()[:9])), (4, None), (5, ""), (None, "tiny ITEM tiny item"),
        (6, "one two three four five six seven eight nine ten one two three"), (7, "named by nobody here"), (8, "The the THE then"), (9, LONG + " " + SPOKEN), (10, "É日本-١٢ x"), (11, "?? ,,"), (12, "z" * 5000 + " tiny item"),
    ]
    found = winnowing.contamination(table(spark, docs), table(spark, items, DOCS.replace("doc_id", "item_id"))).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == Counter((i, *(x if k < 2 else tuple(x) for k, x in enumerate(judged(t, items)))) for i, t in docs)
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_hit for r in found)
    none = table(spark, [])
    assert winnowing.contamination(none, table(spark, items, DOCS.replace("doc_id", "item_id"))).count() == 0
    clean = winnowing.contamination(table(spark, docs), spark.createDataFrame([], "item_id bigint, text string"))
    assert clean.count() == len(docs) and clean.where("n_hit > 0 or size(items) > 0 or size(spans) > 0").count() == 0
    kept = winnowing.without_contaminated(table(spark, docs), table(spark, items, DOCS.replace("doc_id", "item_id")))
    assert kept.columns == DOCS.replace(",", "").split()[::2] and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 11]


def test_decontamination_by_brute_force(spark):
    draw = random.Random(5)
    body = lambda n: " ".join(draw.choice("abcd") for _ in range(n))
    items = [(i, body(draw.randint(1, 25))) for i in range(12)]
    docs = [(i, body(draw.randint(0, 60))) for i in range(40)]
    found = winnowing.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), span=6, gram=3).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found) == [(i, *judged(t, items, 6)) for i, t in docs]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9é日 .\x00-", max_size=150)), max_size=4))
def test_words_and_their_hashes(texts):
    words = winnowing.Words(pa.array(texts, pa.string()))
    flat = [w for t in texts for w in words_of(t)]
    assert np.diff(words.bounds).tolist() == [len(words_of(t)) for t in texts]
    assert words.joined(0, len(flat)).decode() == " ".join(flat)
    alone = [winnowing.Words(pa.array([w])).hashes()[0] for w in flat]
    assert words.hashes().tolist() == alone and len(set(alone)) == len(set(flat))


def clustered(rows, k, rounds, dim, scale=64):
    """Centroids, and (id, cluster, distance) by all distances in whole numbers."""
    kept = [(i, [int(np.floor(scale * np.float64(c))) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    key = lambda r: ("g" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((distance(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = [near(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), m in zip(kept, members, strict=True) if m == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return centroids, [(i, near(v)[1], near(v)[0]) for i, v in kept]


def test_clustering_by_brute_force(spark):
    draw = random.Random(3)
    rows = [(i % 70, [draw.randint(-9, 9) / 8 for _ in range(4)]) for i in range(90)]
    rows += [(None, [0.5, 0.5, 0.5, 0.5]), (1000, None), (1001, [1.0, 2.0, 3.0]), (1002, [1.0, None, 2.0, 3.0]), (1003, [float("nan"), 0.0, 0.0, 0.0]), (1004, [float("inf"), 0.0, 0.0, 0.0]), (1005, [1e7, -1e7, 3e6, 0.1])]
    rows += [(2000 + i, [0.25, 0.25, 0.25, 0.25]) for i in range(40)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, cluster string").repartition(4)
    for k, rounds in ((5, 3), (1, 2), (200, 1)):
        found, centroids = bisectors.cluster(df, k=k, dim=4, rounds=rounds)
        wanted, members = clustered(rows, k, rounds, 4)
        assert centroids == wanted
        assert Counter(map(tuple, found.collect())) == Counter(members)
    report = bisectors.cluster_report(*bisectors.cluster(df, k=5, dim=4)).collect()
    assert all(r.inertia == sum(x.distance for x in report) and r.cluster_inertia == sum(x.distance for x in report if x.cluster == r.cluster) for r in report)
    nothing, none = bisectors.cluster(df.where("vec_id = 1000"))
    assert nothing.count() == 0 and none == [] and bisectors.cluster_report(nothing, none).count() == 0


def test_a_vector_on_the_bisector_goes_to_the_smaller_number():
    judge = bisectors.Bisectors([[2, 0], [0, 0], [2, 0], [4, 0]])
    x = np.array([[1, 5], [3, 0], [2, 9], [0, 0], [4, 1]])
    assert judge.champions(x).tolist() == [0, 0, 0, 1, 3]
    assert judge.distances(x, judge.champions(x)).tolist() == [26, 1, 81, 0, 1]


def infilled(doc_id, text):
    """The row asked for, from the whole text."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, output = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, n, form, len(p), len(m), sha(output), sha(text)


@pytest.mark.parametrize("chunk", [5, 16_384])
def test_infilling_by_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(infilling, "CHUNK_BYTES", chunk)
    texts = [None, "", " ", "a", "  a b ", "x <P> y", "<M>", "日本 é b\tc\n\n", "one two three  four five six", "no-blank" * 900, "\x1c a \x0b b\x00c"]
    rows = [(20 * i + j, t) for i, t in enumerate(texts) for j in range(12)] + [(None, "a b c d e f"), (3, "twice the same"), (3, "twice the same"), (900, LONG), (901, LONG), (902, LONG)]
    df = table(spark, rows)
    found = infilling.digests(df).collect()
    assert Counter(map(tuple, found)) == Counter(infilled(*r) for r in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    whole = infilling.outputs(df).select("doc_id", "form", F.sha2("output", 256).alias("o"), F.sha2(infilling.restored(F.col("output"), F.col("form")), 256).alias("r")).collect()
    assert Counter(map(tuple, whole)) == Counter((r.doc_id, r.form, r.output_sha256, r.restored_sha256) for r in found)
    assert infilling.digests(table(spark, [])).count() == 0


def test_infilling_deals_the_text_out_once(spark, small_dir):
    chunks = infilling.digests(spark.read.parquet(f"{small_dir}/documents.parquet"))
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 2
