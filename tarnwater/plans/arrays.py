"""Array and map function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions import arrays, random
from tarnwater.operators.corpus import tokenize
from tarnwater.plans.registry import CELLS_SQL, digest_sql, long_vector, query, rounded
from tarnwater.plans.text import TOKENS_SQL
from tarnwater.session import Tables


def vectors(t: Tables) -> DataFrame:
    """Embeddings in double precision: (vec_id, label, v)."""
    return t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


def as_long(df: DataFrame, array: str = "v", digits: int = 6) -> DataFrame:
    """Rows (vec_id, pos, value)."""
    return long_vector(df, ["vec_id"], array, digits).withColumn("pos", F.col("pos").cast("bigint"))


def user_counts(t: Tables) -> DataFrame:
    """One map per user from every event type to its number of events: as many entries as the user has types."""
    counts = t.events.where(F.col("event_type").isNotNull()).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))


USER_SQL = "user_types AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)"


@query(f"""
    WITH {CELLS_SQL}, ends AS (SELECT *, max(pos) OVER (PARTITION BY vec_id) AS top FROM cells)
    SELECT vec_id, round(sum(x) FILTER (pos < 4), 6) AS head, round(sum(x) FILTER (pos > top - 3), 6) AS tail,
        round(sum(x) FILTER (pos = top), 6) AS last, round(sum(x) FILTER (pos >= 2 AND pos < 7), 6) AS middle FROM ends GROUP BY vec_id""")
def array_slice(t: Tables) -> DataFrame:
    total = lambda a: rounded(arrays.array_sum(a))
    v = F.col("v")
    return vectors(t).select(
        "vec_id", total(F.slice(v, 1, 4)).alias("head"), total(arrays.last_n(v, 3)).alias("tail"),
        rounded(F.element_at(v, -1)).alias("last"), total(F.slice(v, 3, 5)).alias("middle"),
    )


@query(f"""
    WITH {TOKENS_SQL}, {USER_SQL}, seen AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') > 0 AS hit FROM user_types GROUP BY user_id)
    SELECT 'document' AS kind, doc_id AS id, list_contains(tokens, 'le') AS hit FROM tok UNION ALL SELECT 'user', user_id, hit FROM seen""")
def array_member(t: Tables) -> DataFrame:
    docs = tokenize(t.documents.select("doc_id", "text")).select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.array_contains("tokens", "le").alias("hit"))
    users = user_counts(t).select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.map_contains_key("m", "purchase").alias("hit"))
    return docs.unionByName(users)


@query(f"""
    WITH {CELLS_SQL}, sizes AS (SELECT vec_id, count(*) AS n FROM cells GROUP BY vec_id)
    SELECT vec_id, pos, round(x, 6) AS value FROM cells
    UNION ALL SELECT vec_id, 2 * n - 1 - pos, round(x, 6) FROM cells JOIN sizes USING (vec_id)
    UNION ALL SELECT vec_id, 2 * n, 1.0 FROM sizes""")
def array_concat(t: Tables) -> DataFrame:
    joined = F.array_append(F.flatten(F.array("v", F.reverse("v"))), F.lit(1.0))
    return as_long(vectors(t).select("vec_id", joined.alias("v")))


@query(f"""
    WITH {CELLS_SQL}
    SELECT a.vec_id, a.pos, round(a.x + b.x, 6) AS added, round(a.x * b.x, 6) AS multiplied, a.x > b.x AS greater
    FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND b.pos = 63 - a.pos""")
def array_elementwise(t: Tables) -> DataFrame:
    both = lambda f: arrays.elementwise(F.col("v"), F.reverse("v"), f)
    rows = vectors(t).select("vec_id", F.posexplode(both(lambda a, b: F.struct((a + b).alias("s"), (a * b).alias("p"), (a > b).alias("g")))).alias("pos", "c"))
    return rows.select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), rounded("c.s").alias("added"), rounded("c.p").alias("multiplied"), F.col("c.g").alias("greater")
    )


@query(f"""
    WITH {CELLS_SQL}
    SELECT vec_id, round(min(x), 6) AS smallest, round(avg(x), 6) AS mean, arg_max(pos, x) AS position,
        round(max(x) FILTER (rank = 3), 6) AS third
    FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x) AS rank FROM cells) GROUP BY vec_id""")
def array_stats(t: Tables) -> DataFrame:
    v = F.col("v")
    return vectors(t).select(
        "vec_id", rounded(F.array_min(v)).alias("smallest"), rounded(arrays.array_mean(v)).alias("mean"),
        arrays.array_argmax(v).cast("bigint").alias("position"), rounded(F.element_at(F.array_sort(v), 3)).alias("third"),
    )


@query(f"""
    WITH {TOKENS_SQL}
    SELECT doc_id, len(list_distinct(tokens)) AS n_distinct, len(list_intersect(tokens, ['le', 'la', 'un', 'une', 'und', 'der'])) AS n_common,
        len(list_distinct(list_concat(tokens, ['le', 'la', 'un', 'une', 'und', 'der']))) AS n_union FROM tok""")
def array_sets(t: Tables) -> DataFrame:
    common = F.array(*[F.lit(w) for w in ("le", "la", "un", "une", "und", "der")])
    size = lambda a, name: F.size(a).cast("bigint").alias(name)
    docs = tokenize(t.documents.select("doc_id", "text"))
    return docs.select(
        "doc_id", size(F.array_distinct("tokens"), "n_distinct"), size(F.array_intersect("tokens", common), "n_common"), size(F.array_union("tokens", common), "n_union")
    )


@query("""
    SELECT l_orderkey, l_linenumber, array_to_string(list_filter(list_transform(range(1, l_linenumber + 1), lambda x: x * x), lambda y: y % 2 = 1), ',') AS odd_squares
    FROM lineitem""")
def array_transform(t: Tables) -> DataFrame:
    squares = F.transform(F.sequence(F.lit(1), "l_linenumber"), lambda x: x * x)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.array_join(F.filter(squares, lambda y: y % 2 == 1), ",").alias("odd_squares"))


@query("""
    WITH lists AS (SELECT p_partkey, string_split(p_name, ' ') AS a, [p_brand, p_type, CAST(p_size AS VARCHAR)] AS b FROM part)
    SELECT p_partkey, array_to_string(list_transform(list_zip(a, b, true), lambda z: z[1] || '=' || z[2]), ';') AS pairs,
        array_to_string(list_transform(list_zip(a, b, true), lambda z: z[2]), ';') AS seconds FROM lists""")
def array_zip(t: Tables) -> DataFrame:
    zipped = arrays.zip_shortest(F.split("p_name", " "), F.array("p_brand", "p_type", F.col("p_size").cast("string")))
    rows = t.part.select("p_partkey", zipped.alias("z"))
    pairs = F.transform("z", lambda z: F.concat_ws("=", z["first"], z["second"]))
    return rows.select("p_partkey", F.array_join(pairs, ";").alias("pairs"), F.array_join("z.second", ";").alias("seconds"))


@query(f"""
    WITH {CELLS_SQL}
    SELECT vec_id, coalesce(string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) FILTER (x > 0.1), '') AS positions,
        coalesce(round(sum(x) FILTER (x > 0.1), 6), 0.0) AS total FROM cells GROUP BY vec_id""")
def array_where(t: Tables) -> DataFrame:
    found = vectors(t).select("vec_id", "v", arrays.positions_where(F.col("v"), lambda x: x > 0.1).alias("at"))
    total = rounded(arrays.array_sum(arrays.take_positions(F.col("v"), F.col("at")))).alias("total")
    return found.select("vec_id", F.array_join(F.col("at").cast("array<string>"), ",").alias("positions"), total)


@query(f"WITH {CELLS_SQL} SELECT vec_id, pos // 8 AS pos, round(sum(x), 6) AS value FROM cells GROUP BY vec_id, pos // 8")
def array_reshape(t: Tables) -> DataFrame:
    grid = vectors(t).select("vec_id", arrays.reshape(F.col("v"), 8, 8).alias("grid"))
    return as_long(grid.select("vec_id", F.transform("grid", arrays.array_sum).alias("v")))


@query("SELECT vec_id, len(embedding) AS n_dims, 'array<float>' AS dtype FROM embeddings")
def array_shape(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.size("embedding").cast("bigint").alias("n_dims"), F.typeof("embedding").alias("dtype"))


@query(f"WITH {CELLS_SQL} SELECT label, pos, round(avg(x), 6) AS value FROM cells GROUP BY label, pos")
def vector_axis_means(t: Tables) -> DataFrame:
    cells = vectors(t).select("label", F.posexplode("v").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(rounded(F.avg("x")).alias("value"))
    return means.withColumn("pos", F.col("pos").cast("bigint"))


@query(f"""
    WITH {USER_SQL}
    SELECT user_id, count(*) AS n_types, string_agg(event_type, ',' ORDER BY event_type) AS keys, CAST(sum(n) AS BIGINT) AS total,
        count(*) FILTER (event_type <> 'error') AS n_without_error, coalesce(max(n) FILTER (event_type = 'view'), 0) AS n_views
    FROM user_types GROUP BY user_id""")
def map_functions(t: Tables) -> DataFrame:
    m = F.col("m")
    return user_counts(t).select(
        "user_id", F.size(m).cast("bigint").alias("n_types"), F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"),
        F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        F.size(F.map_entries(F.map_filter(m, lambda k, n: k != "error"))).cast("bigint").alias("n_without_error"),
        F.coalesce(F.try_element_at(m, F.lit("view")), F.lit(0)).alias("n_views"),
    )


_DIGEST = digest_sql(6, "vec_id", "pos")
_WORD = "CAST('0x' || substr({}, {}, 8) AS BIGINT)"


@query(f"""
    WITH {CELLS_SQL}, noisy AS (
        SELECT vec_id, pos, x + 0.2 * sqrt(-2.0 * ln(({_WORD.format(_DIGEST, 1)} + 1) / 4294967296.0))
            * cos(2.0 * pi() * {_WORD.format(_DIGEST, 9)} / 4294967296.0) AS x FROM cells)
    SELECT vec_id, pos, round(least(greatest(x, 0.0), 1.0), 6) AS value FROM noisy""")
def noise_clip(t: Tables) -> DataFrame:
    noisy = F.transform("v", lambda x, i: x + 0.2 * random.keyed_normal(6, F.col("vec_id"), i))
    return as_long(vectors(t).select("vec_id", noisy.alias("v")).select("vec_id", arrays.clip_array(F.col("v"), 0.0, 1.0).alias("v")))
