"""Operators against brute force: hot keys, ties, empty tables, toy goldens."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwater.functions.bits import inverse_permutation
from tarnwater.operators import aggregate, candidates, combine, corpus, features, logs, order, splits, stats, table
from tarnwater.plans import text
from tarnwater.session import Tables, row_bound


def test_row_positions_with_a_hot_value(spark):
    rng = random.Random(1)
    rows = [(i, 5 if i % 3 else rng.randrange(10)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(6)
    got = {r["id"]: r["position"] for r in order.row_positions(df, ["v", "id"]).collect()}
    assert got == {i: p for p, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}


def test_row_positions_of_an_empty_table(spark):
    assert order.row_positions(spark.createDataFrame([], "id int"), ["id"]).collect() == []


def test_running_sums_with_a_hot_key(spark):
    rng = random.Random(2)
    rows = [(i, 0 if i % 3 else rng.randrange(20), rng.randrange(100), rng.randrange(50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, k int, t int, v int")
    got = {r["id"]: r["running"] for r in order.running_sum(df, "v", ["t", "id"], F.floor(F.col("t") / 10), ["k"]).collect()}
    want, totals = {}, Counter()
    for i, k, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
        totals[k] += v
        want[i] = totals[k]
    assert got == want
    whole = {r["id"]: r["v_running"] for r in order.global_running_sum(df, ["v"], ["t", "id"]).collect()}
    total, expected = 0, {}
    for i, _, _, v in sorted(rows, key=lambda r: (r[2], r[0])):
        total += v
        expected[i] = total
    assert whole == expected


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(1, None, 1, 2), (2, None, 2, 3), (3, 7, 1, 4), (4, 7, None, 5)], "id int, k int, t int, v int")
    got = {r["id"]: r["running"] for r in order.running_sum(df, "v", ["t", "id"], F.col("t"), ["k"]).collect()}
    assert got == {1: 2, 2: 5, 4: 5, 3: 9}
    shares = aggregate.value_share(aggregate.group_count(df, "k", "t"), ["k"]).collect()
    assert len(shares) == 4 and all(r["percent"] == 50.0 for r in shares)


def test_sums_by_dimension_with_a_hot_key(spark):
    facts = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(300)], "k int, v int")
    dimension = spark.createDataFrame([(i, "even" if i % 2 == 0 else "odd") for i in range(300)], "k int, g string")
    got = {r["g"]: (r["n"], r["total"]) for r in combine.sums_by_dimension(facts, dimension, "k", "g", "v").collect()}
    odd = [i for i in range(300) if i % 3 == 0 and i % 2]
    assert got == {"odd": (len(odd), sum(odd)), "even": (300 - len(odd), sum(range(300)) - sum(odd))}


def test_top_rows_per_group_break_ties_by_name(spark):
    counts = spark.createDataFrame([("x", "b", 2), ("x", "a", 2), ("x", "c", 5)], "g string, h string, n int")
    top = order.top_rows_per_group(counts, ["g"], [F.desc("n"), "h"], 2)
    assert {(r["h"], r["rank"]) for r in top.collect()} == {("c", 1), ("a", 2)}


@pytest.mark.parametrize("bits", [16, 8])
def test_exact_quantiles(spark, bits):
    rng = random.Random(3)
    a = [rng.gauss(0, 1) for _ in range(30_000)]
    b = [1.0 if i % 3 == 0 else rng.random() for i in range(30_000)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r["column_name"], r["probability"]): r["quantile"] for r in order.exact_quantiles(df, ["a", "b"], probabilities, bits).collect()}
    for name, values in (("a", a), ("b", b)):
        for p in probabilities:
            assert got[name, p] == pytest.approx(float(np.quantile(values, p)), abs=1e-12)


def test_exact_quantiles_of_nulls_and_single_values(spark):
    df = spark.createDataFrame([(None, 4.0), (None, None)], "a double, b double")
    got = [tuple(r) for r in order.exact_quantiles(df, ["a", "b"], [0.5]).collect()]
    assert got == [("b", 0.5, 4.0)]
    assert order.exact_quantiles(df, ["a"], [0.5]).collect() == []


def test_exact_quantiles_of_extreme_numbers(spark):
    values = [-0.0, 0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, -1.5, 2.0**53, 1e-300]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "`a.b` double, c int")
    probabilities = [i / 8 for i in range(9)]
    found = order.exact_quantiles(df, ["a.b", "c"], probabilities).collect()
    assert {r["probability"]: r["quantile"] for r in found if r["column_name"] == "a.b"} == dict(zip(probabilities, sorted(values)))
    assert {r["probability"]: r["quantile"] for r in found if r["column_name"] == "c"} == {p: i for i, p in enumerate(probabilities)}


def test_exact_quantiles_take_a_fixed_number_of_scans(spark, tmp_path):
    spark.range(1000).select((F.col("id") * 0.5).alias("a"), F.col("id").alias("b")).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    plan = order.exact_quantiles(table, ["a", "b"], [0.1, 0.5, 0.9])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 4


def test_running_sum_moves_raw_rows_once(spark, tmp_path):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("k"), (F.col("id") % 40).alias("t"), F.lit(1).alias("v"))
    rows.write.parquet(f"{tmp_path}/t")
    summed = order.running_sum(spark.read.parquet(f"{tmp_path}/t"), "v", ["t", "id"], F.col("t"), ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert summed.where("running < 1").count() == 0
        plan = summed._jdf.queryExecution().executedPlan().toString()
        # raw rows once, the partial totals twice (per cell, then per key), the totals once more to the join
        assert plan.count("Exchange hashpartitioning") <= 4
        raw = [line for line in plan.splitlines() if "Exchange hashpartitioning(_cell" in line]
        assert len(raw) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_describe_and_arg_max(spark):
    df = spark.createDataFrame([(2, 5.0), (1, 5.0), (3, 1.0), (4, None)], "k int, v double")
    row = aggregate.describe_table(df, ["v"]).first()
    assert (row["n"], row["minimum"], row["q50"], row["maximum"]) == (3, 1.0, 5.0, 5.0)
    assert tuple(aggregate.arg_max(df, "k", "v").first()) == (1, 5.0)


def test_null_handling(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert table.null_counts(df).first().asDict() == {"a": 0, "b": 1, "any_null": True}
    assert table.null_counts(spark.createDataFrame([], "a int")).first().asDict() == {"a": 0, "any_null": False}
    masked = table.mask_cells(df, 1).collect()
    assert [r["a"] for r in masked] == [None, 2]


def test_side_by_side_keeps_the_longer_list(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "rank int, v string")
    b = spark.createDataFrame([(1, "z")], "rank int, v string")
    rows = {tuple(r) for r in combine.side_by_side({"a": a, "b": b}, "rank").collect()}
    assert rows == {(1, "x", "z"), (2, "y", None)}


def test_semi_and_anti_join_and_scalar(spark):
    df, keys = spark.range(5), spark.createDataFrame([(1,), (1,), (3,)], "id long")
    assert sorted(r["id"] for r in combine.keep_matching(df, keys, "id").collect()) == [1, 3]
    assert sorted(r["id"] for r in combine.drop_matching(df, keys, "id").collect()) == [0, 2, 4]
    assert [r["id"] for r in combine.equal_to_scalar(df, "id", df.agg(F.max("id"))).collect()] == [4]


def log_of(spark, counts):
    hosts = [(h, "01/Jul/1995:00:00:01 -0400", "GET / HTTP/1.0", 200, 1) for h, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(hosts, "host string, timestamp string, request string, reply_code int, bytes int")


def test_rest_bucket_with_a_tie_at_the_cut_and_a_hot_host(spark):
    counts = {f"h{i:02d}.de": 3 for i in range(12)} | {"big.de": 500, "one.ca": 2, "x.com": 9}
    got = {(r["suffix"], r["host"]): r["n"] for r in logs.rest_bucket(log_of(spark, counts)).collect()}
    want = {(".de", "big.de"): 500, (".ca", "one.ca"): 2, (".ca", "Rest"): 0, (".de", "Rest"): 12}
    assert got == want | {(".de", f"h{i:02d}.de"): 3 for i in range(8)}
    shares = logs.share_percent(logs.rest_bucket(log_of(spark, counts))).groupBy("suffix").agg(F.sum("percent").alias("p")).collect()
    assert all(r["p"] == pytest.approx(100) for r in shares)


def test_log_of_no_lines(spark):
    empty = logs.parse_log(spark.createDataFrame([], "value string"))
    assert logs.rest_bucket(empty).collect() == [] and logs.suffix_counts(empty).collect() == []


def test_visit_matrix_leaves_missing_cells_null(spark):
    visits = logs.top_host_visits(log_of(spark, {"a.de": 3, "b.de": 1}))
    row = logs.visit_matrix(visits, ["01", "02"]).first()
    assert (row["hour"], row["d01"], row["d02"]) == ("00", 3, None)


def documents(spark):
    rows = [(1, "cat cat dog"), (2, ""), (3, "zzz"), (4, "dog emu"), (5, None)]
    return corpus.tokenize(spark.createDataFrame(rows, "doc_id int, text string"))


def test_vocabulary_ties_and_document_frequency(spark):
    counts = corpus.gram_counts(documents(spark))
    assert {tuple(r) for r in counts.collect()} == {("cat", 2, 1), ("dog", 2, 2), ("zzz", 1, 1), ("emu", 1, 1)}
    top = lambda **kw: [r["word"] for r in corpus.vocabulary(counts, **kw).collect()]
    assert top(top_n=3) == ["cat", "dog", "emu"]
    assert top(top_n=3, min_df=2) == ["dog"] and top(top_n=2, min_df=2, legacy_min_df=True) == ["cat", "dog"]


@pytest.mark.parametrize("top_n", [10, 0])
def test_ids_counts_and_mean_vectors(spark, top_n):
    docs = documents(spark)
    known = spark.createDataFrame([("dog",), ("cat",), ("emu",)], "word string")
    numbered = corpus.number_words(known.limit(top_n)) if top_n else corpus.number_all_words(known)
    assert {r["word"]: r["word_id"] for r in numbered.collect()} == {"cat": 0, "dog": 1, "emu": 2}
    ids = {r["doc_id"]: r["ids"] for r in (corpus.word_ids if top_n else corpus.word_ids_by_shuffle)(docs, "doc_id", numbered).collect()}
    assert ids == {1: [0, 0, 1], 2: [], 3: [], 4: [1, 2], 5: []}
    counted = (corpus.known_counts if top_n else corpus.known_counts_by_shuffle)(docs, "doc_id", numbered)
    assert {r["doc_id"]: (list(r["ids"]), list(r["times"]), r["n_ids"]) for r in counted.collect()} == {
        1: ([0, 1], [2, 1], 3), 2: ([], [], 0), 3: ([], [], 0), 4: ([1, 2], [1, 1], 2), 5: ([], [], 0),
    }
    vectors = spark.createDataFrame([(0, [3.0, 0.0]), (1, [0.0, 6.0]), (2, [2.0, 2.0])], "word_id int, vector array<double>")
    mean = lambda **kw: {r["doc_id"]: r["vector"] for r in corpus.document_vectors(counted, "doc_id", vectors, numbered=numbered if top_n else None, **kw).collect()}
    once, plain = mean(dedupe=True), mean(dedupe=False)
    assert once[1] == pytest.approx([1.0, 2.0]) and plain[1] == pytest.approx([2.0, 2.0]) and once[2] is None and once[3] is None
    assert corpus.longest(counted).first()["max_length"] == 3


def test_look_ups_inside_the_row(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)] + ["", "ß", "a b"]
    rows = [(i, [rng.choice(words + ["unknown", None]) for _ in range(rng.randrange(40))]) for i in range(200)] + [(200, None), (7, ["w1"])]
    docs = spark.createDataFrame(rows, "id int, tokens array<string>")
    vocab = spark.createDataFrame([(w,) for w in words], "word string").limit(5000)
    numbered = corpus.number_words(vocab)
    number = {w: i for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}
    want = sorted((i, [number[w] for w in t or [] if w in number]) for i, t in rows)
    found = corpus.word_ids(docs, "id", numbered)
    assert sorted((r["id"], r["ids"]) for r in found.collect()) == want
    assert sorted((r["id"], r["tokens"]) for r in corpus.keep_known(docs, "id", vocab, "tokens").collect()) == sorted((i, [w for w in t or [] if w in number]) for i, t in rows)
    counted = corpus.known_counts(docs, "id", numbered)
    vectors = spark.range(2500).select(F.col("id").cast("int").alias("word_id"), F.array(F.col("id") * 1.0, F.col("id") * -0.5).alias("vector"))
    for how in (True, False):
        got = sorted((r["id"], r["vector"]) for r in corpus.document_vectors(counted, "id", vectors, how, numbered).collect() if r["vector"])
        sums = [(i, len(ids), [x for x in (set(ids) if how else ids) if x < 2500]) for i, ids in want]
        expected = sorted((i, [sum(x) / n, -0.5 * sum(x) / n]) for i, n, x in sums if x)
        assert [g[0] for g in got] == [e[0] for e in expected] and np.allclose([g[1] for g in got], [e[1] for e in expected])
    main = found._jdf.queryExecution().optimizedPlan().toString().split("Subquery")[0]
    assert "Generate" not in main.split("scalar-subquery")[0] and corpus.word_ids(docs, "id", numbered.where("false")).where("size(ids) > 0").count() == 0


def test_known_grams_keep_order_and_repeats(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "x", "b"]), (2, ["x"])], "id int, grams array<string>")
    known = spark.createDataFrame([("a",), ("b",)], "word string")
    assert {r["id"]: r["grams"] for r in corpus.keep_known(docs, "id", known.limit(5), "grams").collect()} == {1: ["b", "a", "b"], 2: []}
    with pytest.raises(ValueError, match="top words"):
        corpus.keep_known(docs, "id", known, "grams")
    assert {tuple(r) for r in corpus.gram_frequencies(docs, "grams").collect()} == {("b", 2), ("a", 1), ("x", 2)}


def toy(spark):
    return spark.createDataFrame([(0.0, 0.0, 0.0), (1.0, 3.0, 1.0), (2.2, 3.0, 2.0)], "a double, b double, y double")


def test_toy_objectives_and_gradients(spark):
    df, w = toy(spark), [1.0, 2.0]
    assert [r["p"] for r in df.select(stats.linear_prediction(["a", "b"], w).alias("p")).collect()] == pytest.approx([0, 7, 8.2])
    assert stats.squared_error(df, ["a", "b"], "y", w).first()["sse"] == pytest.approx(74.44)
    X, y = np.array([[0, 0], [1, 3], [2.2, 3]]), np.array([0, 1, 2])
    gradient = {r["feature"]: r["gradient"] for r in stats.squared_error_gradient(df, ["a", "b"], "y", w).collect()}
    assert [gradient["a"], gradient["b"]] == pytest.approx(list(2 * X.T @ (X @ w - y)))
    objective = lambda v: float(((y - X @ v) ** 2).sum() / 6 + 0.1 * np.abs(v).sum())
    assert stats.lasso_objective(df, ["a", "b"], "y", w, 0.1).first()["objective"] == pytest.approx(objective(np.array(w)))
    lasso = {r["feature"]: r["gradient"] for r in stats.lasso_gradient(df, ["a", "b"], "y", w, 0.1).collect()}
    numeric = [(objective(np.array(w) + e) - objective(np.array(w) - e)) / 2e-6 for e in np.eye(2) * 1e-6]
    assert [lasso["a"], lasso["b"]] == pytest.approx(numeric, abs=1e-5)


def test_t_test_and_p_value(spark):
    a, b = [5.1, 4.9, 6.2, 5.7, 5.5], [4.1, 4.8, 5.0, 4.4, 4.6]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "s string, v double")
    row = stats.t_test(df, "s", "v", "a", "b").first()
    pooled = (4 * np.var(a, ddof=1) + 4 * np.var(b, ddof=1)) / 8
    assert row["t"] == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(pooled * 0.4)) and row["df"] == 8
    assert stats.student_p_value(2.306, 8) == pytest.approx(0.05, abs=1e-4)
    assert stats.student_p_value(1.96, 1_000_000) == pytest.approx(0.05, abs=1e-4)


def test_eigenvalues_and_singular_values(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(200, 3)) @ np.array([[2, 0, 1], [0, 1, 0], [0, 0, 0.3]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    values = [r["eigenvalue"] for r in stats.explained_variance(df, ["a", "b", "c"]).orderBy("component").collect()]
    assert values == pytest.approx(sorted(np.linalg.eigvalsh(np.cov(X.T)), reverse=True))
    singular = [r["singular_value"] for r in stats.singular_values(df, ["a", "b", "c"]).orderBy("component").collect()]
    assert singular == pytest.approx(list(np.linalg.svd(X, compute_uv=False)))


def test_splits_are_disjoint_complete_and_stable(spark):
    df = spark.range(0, 6000)
    parts = splits.random_parts(df, ["id"], [0.7, 0.3], 6)
    assert dict((r["part"], r["count"]) for r in parts.groupBy("part").count().collect())[0] == pytest.approx(4200, abs=150)
    again = splits.random_parts(df.repartition(5), ["id"], [0.7, 0.3], 6)
    assert parts.exceptAll(again).count() == 0
    ordered = splits.ordered_split(df, ["id"], 0.15).where("is_train")
    assert ordered.agg(F.count("*"), F.max("id")).first()[:] == (5100, 5099)


@pytest.mark.parametrize("n", [1, 17, 999, 1000, 5000])
def test_exact_sample_size(spark, n):
    sample = splits.exact_sample(spark.range(0, 1000), ["id"], n, 6)
    assert sample.count() == sample.distinct().count() == min(n, 1000)


def test_time_range_split_and_complements(spark):
    df = spark.createDataFrame([(t, t) for t in (0, 1, 2, 3, 10)], "id int, t int")
    train = splits.time_range_split(df, F.col("t"), 0.3).where("is_train").drop("is_train")
    assert sorted(r["t"] for r in train.collect()) == [0, 1, 2]
    assert sorted(r["t"] for r in splits.complement(df, train, ["id"]).collect()) == [3, 10]
    doubled = df.union(df)
    assert splits.complement(doubled, train, ["id"]).count() == 4
    assert splits.complement(doubled, train, ["id"], semantics="distinct").count() == 2


@pytest.mark.parametrize("masks", [candidates.FIRST_MASKS, candidates.SECOND_MASKS])
def test_candidate_bias_against_brute_force(spark, masks):
    rng = random.Random(5)
    pairs = [(rng.randrange(256), rng.randrange(256)) for _ in range(300)] + [(7, 9)] * 150
    got = {r["candidate"]: r["bias"] for r in candidates.candidate_bias(spark.createDataFrame(pairs, "x long, y long"), masks).collect()}
    inverse = inverse_permutation(candidates.SUBSTITUTION)
    for k in range(256):
        decode = lambda z: inverse[z >> 4] << 4 | inverse[z & 15]
        even = sum((bin(decode(y ^ k) & masks[0]).count("1") + bin(x & masks[1]).count("1")) % 2 == 0 for x, y in pairs)
        assert got[k] == pytest.approx(abs(even / len(pairs) - 0.5))


def test_parity_table_against_brute_force(spark):
    pairs = [(x, candidates.SUBSTITUTION[x]) for x in range(16)]
    rows = {r["i"]: r for r in candidates.parity_table(spark.createDataFrame(pairs, "x long, y long")).collect()}
    for i in range(16):
        for j in range(16):
            agree = sum((bin(x & i).count("1") + bin(y & j).count("1")) % 2 == 0 for x, y in pairs)
            assert rows[i][f"m{j:x}"] == agree - 8


def test_feature_scaling(spark):
    df = spark.createDataFrame([(1.0, 10.0), (3.0, 10.5), (5.0, 12.0)], "a double, b double")
    (train, test) = features.standardise_columns(df, ["a"], spark.createDataFrame([(7.0, 0.0)], "a double, b double"))
    assert [r["a"] for r in train.collect()] == pytest.approx([-1.0, 0.0, 1.0]) and test.first()["a"] == pytest.approx(2.0)
    arrays = spark.createDataFrame([([1.0, 2.0],), ([3.0, 2.0],)], "v array<double>")
    got = [r["v"] for r in features.batch_normalise(arrays, "v", 0.001).collect()]
    assert got[0][0] == pytest.approx(-1 / math.sqrt(1.001)) and got[1][1] == pytest.approx(0.0)


def test_count_value_histogram(spark):
    df = spark.createDataFrame([(2, 1), (2, 0), (3, 2)], "p int, q int")
    long = features.count_value_histogram(df, ["p", "q"])
    assert {tuple(r) for r in long.collect()} == {("p", 2, 4), ("p", 3, 3), ("q", 0, 0), ("q", 1, 1), ("q", 2, 2)}
    assert {r["column_name"]: tuple(r)[1:] for r in features.wide_histogram(long).collect()} == {"p": (0, 0, 4, 3), "q": (0, 1, 2, 0)}
    with pytest.raises(ValueError, match="more than 2"):
        features.wide_histogram(long, most=2)


def test_pivot_finds_every_value(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "new", 3.0), (2, None, 4.0)], "k int, c string, v double")
    wide = aggregate.pivot(df, ["k"], "c", F.sum("v"), fill=0)
    assert sorted(wide.columns) == ["a", "k", "new", "null"]
    assert {r["k"]: (r["a"], r["new"], r["null"]) for r in wide.collect()} == {1: (2.0, 3.0, 0.0), 2: (0.0, 0.0, 4.0)}
    with pytest.raises(ValueError, match="more than 2"):
        aggregate.pivot(df, ["k"], "c", F.sum("v"), most=2)
    swapped = aggregate.transpose(df.where("c IS NOT NULL"), "c", ["v"]).first()
    assert (swapped["a"], swapped["new"]) == (2.0, 3.0)


def test_except_all_in_chunks(spark):
    left = spark.createDataFrame([("a",)] * 25 + [("b",)] * 3 + [(None,)] * 4, "x string")
    right = spark.createDataFrame([("a",)] * 4 + [("b",)] * 5 + [(None,)] + [("c",)], "x string")
    rows = combine.except_all(left, right, chunk=10).collect()
    assert sorted((r["x"] or "") for r in rows) == [""] * 3 + ["a"] * 21


@pytest.mark.parametrize("most", [5000, 3])
def test_top_ngrams_count_no_rare_ones(spark, most):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, rng.choices(words, [1 / (k + 1) for k in range(40)], k=rng.randrange(30))) for i in range(80)] + [(80, ["w0"] * 9), (81, []), (82, None)]
    docs = spark.createDataFrame(rows, "id int, tokens array<string>")
    for high, top_n in ((2, 12), (3, 60), (2, 5000)):
        want = Counter(" ".join(t[i : i + n]) for _, t in rows if t for n in range(1, high + 1) for i in range(len(t) - n + 1))
        found = [tuple(r) for r in corpus.top_ngrams(docs, high, top_n, most=most).collect()]
        assert found == sorted(want.items(), key=lambda x: (-x[1], x[0]))[:top_n]


def test_kept_grams_are_looked_up_in_a_list(spark):
    docs = spark.createDataFrame([(1, ["b", "a", None, "b"]), (2, None)], "id int, grams array<string>")
    known = spark.createDataFrame([("a",), (None,)], "word string")
    kept = corpus.keep_known(docs, "id", known.limit(5), "grams")
    assert {r["id"]: r["grams"] for r in kept.collect()} == {1: ["a"], 2: []}
    assert "subquery" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert corpus.keep_known(docs, "id", known.limit(5).where("false"), "grams").where("size(grams) > 0").count() == 0


@pytest.mark.parametrize("dedupe", [True, False])
def test_document_vectors_count_the_vocabulary_once(spark, tmp_path, dedupe):
    spark.createDataFrame([(1, "cat cat dog"), (2, "dog emu"), (3, None), (4, "cat")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, [3.0, 0.0]), (1, [0.0, 6.0])], "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = text._document_vectors(Tables(spark, str(tmp_path)), dedupe)
    assert {(r["doc_id"], r["pos"]): r["value"] for r in found.collect()} == {
        (1, 0): 1.0 if dedupe else 2.0, (1, 1): 2.0, (2, 0): 0.0, (2, 1): 6.0, (4, 0): 3.0, (4, 1): 0.0,
    }
    kept = text.kept_vocabulary(text.tokenized(Tables(spark, str(tmp_path))))
    assert row_bound(kept) is not None and "Aggregate" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_ids_are_looked_up_in_maps(spark):
    docs = spark.createDataFrame([(1, ["b", None, "a", "b", "x"]), (2, None)], "id int, tokens array<string>")
    numbered = spark.createDataFrame([("a", 0), ("b", 1), (None, 2)], "word string, word_id int").limit(5)
    found = corpus.word_ids(docs, "id", numbered)
    assert {r["id"]: r["ids"] for r in found.collect()} == {1: [1, 0, 1], 2: []}
    assert "try_element_at" in found._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("dedupe", [True, False])
def test_vectors_in_tasks_equal_joined_ones(spark, dedupe):
    rows = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["d"]), (4, []), (None, ["e", "a"]), (1, ["f", "a"]), (6, None), (7, ["g"])]
    docs = spark.createDataFrame(rows, "id bigint, tokens array<string>").repartition(3)
    numbered = corpus.number_words(spark.createDataFrame([(w,) for w in "abcdefg"], "word string").limit(10))
    counted = corpus.known_counts(docs, "id", numbered)
    given = [(0, [3.0, 0.5]), (1, [0.0, None]), (2, [0.25, 6.0]), (4, None), (5, [1.0]), (6, []), (99, [7.0, 7.0])]
    found = corpus.document_vectors(counted, "id", spark.createDataFrame(given, "word_id int, vector array<float>"), dedupe, numbered)
    order = lambda rows: sorted(rows, key=repr)
    twice = 1 if dedupe else 2
    assert order(tuple(r) for r in found.collect()) == order([
        (1, 3, [twice * 1.0, None]), (2, 2, [0.125, None]), (3, 1, None), (4, 0, None), (None, 2, [1.5, 0.25]), (1, 2, [2.0, None]), (6, 0, None), (7, 1, []),
    ])
    assert found.schema["vector"].dataType.simpleString() == "array<double>"
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "zip_with" not in plan
    none = corpus.document_vectors(counted, "id", spark.createDataFrame([], "word_id int, vector array<float>"), dedupe, numbered)
    assert none.where("vector is not null").count() == 0 and none.count() == len(rows)


def test_distinct_ids_equal_known_counts(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "x", "b"]), (2, None), (1, ["c"]), (None, ["x"])], "id int, tokens array<string>")
    numbered = corpus.number_words(spark.createDataFrame([("a",), ("b",), ("c",)], "word string").limit(5))
    found = corpus.distinct_ids(corpus.word_ids(docs, "id", numbered), "id")
    rows = lambda df: sorted(map(repr, df.select("id", "ids", "n_ids").collect()))
    assert rows(found) == rows(corpus.known_counts(docs, "id", numbered))
    assert rows(found) == sorted(["Row(id=1, ids=[0, 1], n_ids=3)", "Row(id=2, ids=[], n_ids=0)", "Row(id=1, ids=[2], n_ids=1)", "Row(id=None, ids=[], n_ids=0)"])


@pytest.mark.parametrize("piece", [1, 40, 1 << 22])
def test_words_are_counted_and_looked_up_in_the_texts(spark, monkeypatch, piece):
    monkeypatch.setattr(corpus, "TEXT_PIECE", piece)
    draw = random.Random(4)
    words = ["the", "A", "a.b", "É", "ΣΑΣ", "x", "y", "y.", ".", " ", "\x0b", "😀"]
    odd = ["", None, " ", "\t\n", ". . ", "x\ty\n\r\fX  the", "X"]
    texts = odd + ["".join(draw.choice(words) + draw.choice([" ", "  ", "\t", "\n", "\f\r", ""]) for _ in range(draw.randrange(30))) for _ in range(80)]
    docs = spark.createDataFrame([(i % 70 or None, t) for i, t in enumerate(texts)], "id bigint, text string").repartition(3)
    tokenized = corpus.tokenize(docs)
    order = lambda df: sorted(map(repr, df.collect()))
    found = corpus.text_word_counts(docs)
    assert order(found) == order(corpus.gram_counts(tokenized)) and found.count() > 10
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "split(" not in plan and "Generate" not in plan
    for numbered in (corpus.number_words(corpus.vocabulary(found, 8)), corpus.number_words(corpus.vocabulary(found, 8).where("false"))):
        ids = corpus.text_word_ids(docs, "id", numbered)
        assert order(ids) == order(corpus.word_ids(tokenized, "id", numbered)) and ids.schema["ids"].dataType.simpleString() == "array<int>"
    assert corpus.text_word_counts(docs.where("false")).count() == 0
