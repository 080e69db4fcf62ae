"""The registered queries of the subpackage: equal to their SQL twin, or to a brute-force version over the whole table."""

import importlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from oracle import difference
from tokenizers import Tokenizer

from tarnwater.llm import encode
from tarnwater.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet").orderBy("doc_id").collect()


@pytest.fixture(scope="module")
def token_ids(documents):
    tokenizer = Tokenizer.from_file(encode.vocabulary_path())
    found = tokenizer.encode_batch([d.text or "" for d in documents], add_special_tokens=False)
    return {d.doc_id: np.array(e.ids + [2], "<u4") for d, e in zip(documents, found, strict=True)}


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, small_dir, name):
    assert difference(QUERIES[name](spark, small_dir), small_dir, ORACLE[name]) is None


def test_packing(spark, small_dir, token_ids):
    rows = QUERIES["op1_packing"](spark, small_dir).collect()
    filled = defaultdict(list)
    covered = Counter()
    for r in rows:
        ids = token_ids[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length])
        filled[r.sequence_id].append((r.offset, r.length))
        covered.update((r.doc_id, i) for i in range(r.start, r.start + r.length))
    assert len(covered) == sum(map(len, token_ids.values())) and set(covered.values()) == {1}
    assert sorted(filled) == list(range(len(filled)))
    for sequence, parts in filled.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or sequence == max(filled) and at < 4096


def test_token_files(spark, small_dir, token_ids):
    rows = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, small_dir).collect()}
    start = 0
    for doc_id in sorted(token_ids):
        ids = token_ids[doc_id]
        assert rows[doc_id] == (doc_id, start, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert len(rows) == len(token_ids)


def jaccard_classes(texts: dict) -> tuple[Counter, dict]:
    """Links and smallest member of each document's class, by comparing all pairs that share an n-gram."""
    sets = {}
    for k, text in texts.items():
        words = [w.lower() for w in regex.findall(r"[\p{L}\p{M}\p{N}]+", text or "")]
        sets[k] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    holders = defaultdict(list)
    for k, grams in sets.items():
        for gram in grams:
            holders[gram].append(k)
    shared = Counter((a, b) for ks in holders.values() for a in ks for b in ks if a < b)
    links, low = Counter(), {k: k for k in sets}
    pairs = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return links, low


def test_near_duplicates(spark, small_dir, documents):
    links, low = jaccard_classes({d.doc_id: d.text for d in documents})
    rows = QUERIES["op4_near_duplicates"](spark, small_dir).collect()
    assert {r.doc_id: (r.class_id, r.links) for r in rows} == {k: (low[k], links[k]) for k in low}
    assert len(rows) == len(documents) and any(links.values())


def test_language(spark, small_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, small_dir).collect()}
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 for k, r in rows.items())
    held = [(d.lang, rows[d.doc_id].lang_pred) for d in documents if rows[d.doc_id].held_out and d.lang]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_toxicity(spark, small_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, small_dir).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for k, r in rows.items())
    assert set(labels) <= set(rows)


def test_mixing(spark, small_dir, documents):
    rows = QUERIES["op7_mixing"](spark, small_dir).collect()
    assert sorted(r.doc_id for r in rows) == [d.doc_id for d in documents]
    blocks = defaultdict(set)
    for r in rows:
        blocks[r.slot].add((r.source, r.block))
    assert sorted(blocks) == list(range(len(blocks))) and all(len(b) == 1 for b in blocks.values())
    assert len({r.position for r in rows}) == len(rows)
    by_source = defaultdict(list)
    for slot in sorted(blocks):
        ((source, block),) = blocks[slot]
        by_source[source].append(block)
    assert all(b == list(range(len(b))) for b in by_source.values())


def test_pipeline(spark, small_dir, documents, token_ids):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    from tarnwater.session import materialize

    counts = [len(documents)]
    for name, stage in pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, small_dir), name)
        assert docs.columns == list(pipeline.COLUMNS)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4]
    kept = {d.doc_id: d.text for d in docs.collect()}
    assert len({(t or "").lower() for t in kept.values()}) == len(kept) and not jaccard_classes(kept)[0]
    rows = pipeline.STAGES[-1][1](spark, docs, small_dir).collect()
    assert {r.doc_id for r in rows} == set(kept)
    assert sum(r.length for r in rows) == sum(len(token_ids[k]) for k in kept)
    assert all(r.ids == token_ids[r.doc_id][r.start : r.start + r.length].tobytes() for r in rows)


@pytest.mark.parametrize(("folder", "least", "most_false"), [("sf0.001", 0.5, 0.05), ("sf0.1", 0.9, 0.01)])
def test_toxicity_on_held_out_documents(spark, folder, least, most_false):
    path = f"/root/testdata/{folder}"
    found = QUERIES["op6_toxicity"](spark, path).where("held_out").join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    share = lambda toxic: np.mean([r.predicted for r in found if r.toxic == toxic])
    assert share(1) >= least and share(0) <= most_false
