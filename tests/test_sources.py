"""Scans and sinks on hand-written files."""

import gzip

import pytest
from pyspark.sql import functions as F

from tarnwater import session
from tarnwater.sources import delimited, generate, text


def test_gzip_lines_and_partitions(spark, tmp_path):
    with gzip.open(tmp_path / "log.gz", "wt") as f:
        f.write("\n".join(f"line {i}" for i in range(50)))
    lines = text.read_lines(spark, str(tmp_path / "log.gz"), partitions=4)
    assert lines.count() == 50 and lines.rdd.getNumPartitions() == 4


def test_int_pairs_tolerate_bad_text(spark, tmp_path):
    (tmp_path / "pairs.txt").write_text("1 2\n 3\t4 \nx 5\n6\n")
    rows = {tuple(r) for r in text.read_int_pairs(spark, str(tmp_path / "pairs.txt")).collect()}
    assert rows == {(1, 2), (3, 4), (None, 5), (6, None)}


def test_word_vectors_fill_missing_words_with_zeros(spark, tmp_path):
    (tmp_path / "vectors.txt").write_text("cat 1 2.5\ndog -1 0\n")
    vocabulary = spark.createDataFrame([("cat",), ("emu",)], "word string")
    loaded = text.vectors_for_vocabulary(vocabulary, text.read_word_vectors(spark, str(tmp_path / "vectors.txt")), 2)
    assert {r["word"]: list(r["vector"]) for r in loaded.collect()} == {"cat": [1.0, 2.5], "emu": [0.0, 0.0]}


def test_csv_forms(spark, tmp_path):
    (tmp_path / "a.csv").write_text("No,v,w\n7,1.5,x\n8,,y\n")
    assert delimited.read_csv(spark, str(tmp_path / "a.csv")).dtypes == [("No", "string"), ("v", "string"), ("w", "string")]
    inferred = delimited.read_csv_indexed(spark, str(tmp_path / "a.csv"), "No")
    assert inferred.columns == ["No", "v", "w"] and inferred.dtypes[1] == ("v", "double")
    (tmp_path / "b.csv").write_text("1.0,2\n0.0,3\n")
    rows = delimited.read_csv_positional(spark, str(tmp_path / "b.csv"), ["label", "lepton pt"]).collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.0), (0.0, 3.0)]


def test_date_range_is_inclusive(spark):
    bounds = spark.createDataFrame([("2024-02-27", "2024-03-01")], "a string, b string")
    days = generate.date_range(bounds, F.col("a"), F.col("b")).orderBy("day").collect()
    assert [str(r["day"]) for r in days] == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]
    assert generate.number_range(spark, 0, 10, 3).count() == 4


def test_materialize_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, v array<double>")
    written = session.materialize(df)
    assert written.dtypes == df.dtypes and sorted(written.collect()) == sorted(df.collect())


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        value = None

        def get(self, key, default=None):
            return self.value or default

    class Fake:
        conf = Conf()

        class sparkContext:
            master, applicationId = "yarn", "app-1"

    with pytest.raises(RuntimeError):
        session.shared_dir(Fake())
    Fake.conf.value = "hdfs://shared/cp/"
    assert session.shared_dir(Fake()) == "hdfs://shared/cp"


def test_spread_only_touches_scans_with_few_splits(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == cores
    many = spark.range(0, 100, 1, 4 * cores)
    assert session.spread(many, "id") is many
