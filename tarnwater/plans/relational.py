"""Projection, join, aggregation, ordering and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions import numeric
from tarnwater.functions.numeric import bucket_label, flag_above, map_values
from tarnwater.operators import aggregate, combine, order, splits, table
from tarnwater.plans.registry import day_text, query, rounded, uniform_sql
from tarnwater.session import Tables

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def labelled(t: Tables) -> DataFrame:
    """Documents with their labels, NULL where there are none."""
    return t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")


LABELLED_SQL = "labelled AS (SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


# ---- projection, filter, NULLs -------------------------------------------------------------------------------------


@query("SELECT l_partkey, l_orderkey, l_quantity FROM lineitem")
def project_columns(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_orderkey", "l_quantity")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_columns(t: Tables) -> DataFrame:
    return t.orders.drop("o_orderstatus", "o_orderdate", "o_orderpriority")


@query("SELECT c_custkey AS id, c_name AS customer, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer")
def rename_columns(t: Tables) -> DataFrame:
    return table.rename(t.customer, {"c_custkey": "id", "c_name": "customer", "c_acctbal": "balance"})


@query("SELECT p_partkey, round(p_retailprice * 1.2, 4) AS gross, 'EUR' AS currency, p_size + 1 AS p_size FROM part")
def add_columns(t: Tables) -> DataFrame:
    added = t.part.withColumns({"gross": rounded(F.col("p_retailprice") * 1.2, 4), "currency": F.lit("EUR"), "p_size": F.col("p_size") + 1})
    return added.select("p_partkey", "gross", "currency", "p_size")


@query("""
    SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, CAST(trunc(value) AS BIGINT) AS value,
        try_cast(event_type AS INTEGER) IS NULL AS no_number
    FROM events""")
def cast_columns(t: Tables) -> DataFrame:
    raw = t.events.select("event_id", F.regexp_extract("props", "[0-9]+", 0).alias("k"), "value", "event_type")
    cast = table.cast_columns(raw, {"k": "int", "value": "bigint", "event_type": "int"})
    return cast.select("event_id", "k", "value", F.isnull("event_type").alias("no_number"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 100 THEN 'low' WHEN c_acctbal >= 100 THEN 'high' END AS class FROM customer")
def bucket_when(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", bucket_label(F.col("c_acctbal"), 100, "low", "high").alias("class"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS is_large FROM orders")
def flag_threshold(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", flag_above(F.col("o_totalprice"), 150000).alias("is_large"))


@query("SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_quantity > 40 AND l_discount >= 0.05 AND l_discount < 0.08")
def filter_threshold(t: Tables) -> DataFrame:
    rows = t.lineitem.where((F.col("l_quantity") > 40) & (F.col("l_discount") >= 0.05) & (F.col("l_discount") < 0.08))
    return rows.select("l_orderkey", "l_quantity", "l_discount")


@query(f"WITH {LABELLED_SQL} SELECT doc_id, lang, quality FROM labelled WHERE quality IS NOT NULL")
def filter_not_null(t: Tables) -> DataFrame:
    return labelled(t).where(F.col("quality").isNotNull()).select("doc_id", "lang", "quality")


@query(f"WITH {LABELLED_SQL} SELECT doc_id, lang, toxic FROM labelled WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def dropna_subset(t: Tables) -> DataFrame:
    return labelled(t).dropna(how="any", subset=["quality", "toxic"]).select("doc_id", "lang", "toxic")


@query(f"WITH {LABELLED_SQL} SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM labelled")
def fillna_zero(t: Tables) -> DataFrame:
    return labelled(t).na.fill(0, subset=["quality", "toxic"]).select("doc_id", "quality", "toxic")


@query(f"""
    WITH {LABELLED_SQL}, counts AS (
        SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(lang) AS lang, count(*) - count(n_chars) AS n_chars,
            count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic
        FROM labelled)
    SELECT *, doc_id > 0 OR lang > 0 OR n_chars > 0 OR quality > 0 OR toxic > 0 AS any_null FROM counts""")
def null_counts(t: Tables) -> DataFrame:
    return table.null_counts(labelled(t))


@query("""
    SELECT c_name, CASE WHEN c_nationkey > 10 THEN CAST(c_nationkey AS DOUBLE) END AS c_nationkey,
        CASE WHEN c_acctbal > 10 THEN c_acctbal END AS c_acctbal
    FROM customer
    UNION ALL
    SELECT s_name, CASE WHEN s_nationkey > 10 THEN CAST(s_nationkey AS DOUBLE) END, CASE WHEN s_acctbal > 10 THEN s_acctbal END
    FROM supplier""")
def mask_cells(t: Tables) -> DataFrame:
    customers = t.customer.select("c_name", "c_nationkey", "c_acctbal")
    both = customers.unionByName(table.rename_all(t.supplier.select("s_name", "s_nationkey", "s_acctbal"), customers.columns))
    return table.mask_cells(both, 10).withColumn("c_nationkey", F.col("c_nationkey").cast("double"))


@query("SELECT c_custkey, CASE WHEN c_custkey = 7 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal FROM customer")
def set_cell(t: Tables) -> DataFrame:
    return table.set_cell(t.customer, "c_custkey", 7, "c_acctbal", 0.0).select("c_custkey", "c_acctbal")


@query("""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'""")
def label_slice(t: Tables) -> DataFrame:
    rows = table.label_slice(t.orders, "o_orderdate", "1996-01-01", "1996-03-31", ["o_orderdate", "o_orderkey", "o_totalprice"])
    return rows.withColumn("o_orderdate", day_text("o_orderdate"))


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 6 OFFSET 3")
def position_slice(t: Tables) -> DataFrame:
    return order.position_slice(t.customer.select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), "c_custkey"], 3, 9)


@query("SELECT p_type, p_size, p_retailprice, p_partkey, p_name, p_brand FROM part")
def sort_column_names(t: Tables) -> DataFrame:
    return table.sort_column_names(t.part, descending=True)


@query("SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def shape_of(t: Tables) -> DataFrame:
    return table.shape_of(t.lineitem)


@query("""
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1,0,0' WHEN '2-HIGH' THEN '0,1,0' WHEN '3-MEDIUM' THEN '0,0,1' ELSE '0,0,0' END AS code
    FROM orders""")
def map_values_dict(t: Tables) -> DataFrame:
    codes = {"1-URGENT": "1,0,0", "2-HIGH": "0,1,0", "3-MEDIUM": "0,0,1"}
    return t.orders.select("o_orderkey", map_values(F.col("o_orderpriority"), codes, F.lit("0,0,0")).alias("code"))


# ---- joins ---------------------------------------------------------------------------------------------------------


@query("""
    SELECT p_brand, count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def join_dimension(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return combine.sums_by_dimension(t.lineitem, part, "l_partkey", "p_brand", "l_quantity", "n_lines", "quantity")


@query("""
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
        SELECT c_custkey FROM customer WHERE c_mktsegment = (
            SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY count(*) DESC, c_mktsegment LIMIT 1))""")
def semi_join_top_group(t: Tables) -> DataFrame:
    customer = t.customer
    largest = aggregate.group_count(customer, "c_mktsegment").orderBy(F.desc("n"), "c_mktsegment").limit(1).select("c_mktsegment")
    members = combine.equal_to_scalar(customer, "c_mktsegment", largest).select(F.col("c_custkey").alias("o_custkey"))
    return combine.keep_matching(t.orders.select("o_orderkey", "o_custkey"), members, "o_custkey")


@query("SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id)")
def index_join(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id")


@query("""
    WITH sold AS (SELECT year(l_shipdate) AS y, l_partkey AS part, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY quantity DESC, part) AS rank FROM sold)
    SELECT a.rank, a.part AS y1996_part, a.quantity AS y1996_quantity, b.part AS y1997_part, b.quantity AS y1997_quantity,
        c.part AS y1998_part, c.quantity AS y1998_quantity
    FROM ranked a JOIN ranked b ON a.rank = b.rank AND b.y = 1997 JOIN ranked c ON a.rank = c.rank AND c.y = 1998
    WHERE a.y = 1996 AND a.rank <= 10""")
def ranked_lists_side_by_side(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.year("l_shipdate").alias("y"), F.col("l_partkey").alias("part"), "l_quantity").where("y between 1996 and 1998")
    sold = rows.groupBy("y", "part").agg(F.sum("l_quantity").alias("quantity"))
    top = order.top_rows_per_group(sold, ["y"], [F.desc("quantity"), "part"], 10).withColumn("rank", F.col("rank").cast("bigint"))
    return combine.side_by_side({f"y{y}": top.where(F.col("y") == y).drop("y") for y in (1996, 1997, 1998)}, "rank")


# ---- aggregation ---------------------------------------------------------------------------------------------------


@query("SELECT p_type, count(*) AS n FROM part GROUP BY p_type")
def group_count(t: Tables) -> DataFrame:
    return aggregate.group_count(t.part, "p_type")


@query("SELECT DISTINCT l_partkey FROM (SELECT l_partkey, avg(l_quantity) AS m FROM lineitem GROUP BY 1) WHERE m >= 26")
def group_avg_filter(t: Tables) -> DataFrame:
    means = t.lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("m"))
    return means.where(F.col("m") >= 26).select("l_partkey").distinct()


@query("""
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_l_quantity, round(sum(l_extendedprice), 2) AS sum_l_extendedprice,
        round(sum(l_discount), 2) AS sum_l_discount, round(sum(l_tax), 2) AS sum_l_tax
    FROM lineitem GROUP BY ALL
    UNION ALL
    SELECT l_returnflag, 'all', round(sum(l_quantity), 2), round(sum(l_extendedprice), 2), round(sum(l_discount), 2), round(sum(l_tax), 2)
    FROM lineitem GROUP BY l_returnflag""")
def group_sum(t: Tables) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    fine = aggregate.group_sum(t.lineitem, ["l_returnflag", "l_linestatus"], columns)
    sums = [f"sum_{c}" for c in columns]
    coarse = fine.groupBy("l_returnflag").agg(*[F.sum(s).alias(s) for s in sums]).withColumn("l_linestatus", F.lit("all"))
    return fine.unionByName(coarse).select("l_returnflag", "l_linestatus", *[rounded(s, 2).alias(s) for s in sums])


MOMENT_COLUMNS = ("l_quantity", "l_discount", "l_tax")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std_sample, round(stddev_pop({c}), 6) AS std_population FROM lineitem"
        for c in MOMENT_COLUMNS
    )
)
def column_moments(t: Tables) -> DataFrame:
    moments = aggregate.column_moments(t.lineitem, MOMENT_COLUMNS)
    return moments.select("column_name", *[rounded(c).alias(c) for c in ("mean", "std_sample", "std_population")])


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM customer"""
        for c in ("c_acctbal", "c_nationkey")
    )
)
def describe_table(t: Tables) -> DataFrame:
    described = aggregate.describe_table(t.customer, ["c_acctbal", "c_nationkey"])
    exact = [rounded(c).alias(c) for c in ("mean", "std", "minimum", "maximum", "q25", "q50", "q75")]
    return described.select("column_name", "n", *exact)


@query("SELECT l_orderkey, l_linenumber, round((l_quantity + l_discount + l_tax) / 3, 6) AS row_mean FROM lineitem")
def row_mean(t: Tables) -> DataFrame:
    mean = numeric.row_mean(F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", rounded(mean).alias("row_mean"))


@query("""
    SELECT l_suppkey, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0.0) AS "A",
        coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0.0) AS "N", coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0.0) AS "R"
    FROM lineitem GROUP BY l_suppkey""")
def pivot_sum(t: Tables) -> DataFrame:
    return aggregate.pivot(t.lineitem, ["l_suppkey"], "l_returnflag", F.sum("l_quantity"), fill=0)


@query(
    "SELECT c_nationkey, "
    + ", ".join(f"round(avg(c_acctbal) FILTER (c_mktsegment = '{s}'), 6) AS \"{s}\"" for s in SEGMENTS)
    + " FROM customer GROUP BY c_nationkey"
)
def pivot_mean(t: Tables) -> DataFrame:
    wide = aggregate.pivot(t.customer, ["c_nationkey"], "c_mktsegment", F.avg("c_acctbal"))
    return wide.select("c_nationkey", *[rounded(f"`{s}`").alias(s) for s in wide.columns[1:]])


@query("""
    SELECT p_partkey, 'p_size' AS name, CAST(p_size AS DOUBLE) AS value FROM part
    UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""")
def unpivot_columns(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return aggregate.unpivot(part, ["p_partkey"], ["p_size", "p_retailprice"], "name", "value")


@query(
    "WITH r AS (SELECT r_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance FROM customer"
    " JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name) "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS measure, " + ", ".join(f"max(CASE WHEN r_name = '{r}' THEN CAST({m} AS DOUBLE) END) AS \"{r}\"" for r in REGIONS) + " FROM r"
        for m in ("n_customers", "balance")
    )
)
def transpose_frame(t: Tables) -> DataFrame:
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("s"))
    per_region = per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name")
    measures = per_region.agg(F.sum("n").alias("n_customers"), rounded(F.sum("s"), 2).alias("balance"))
    return aggregate.transpose(measures, "r_name", ["n_customers", "balance"])


@query("SELECT event_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM events GROUP BY event_type")
def value_counts(t: Tables) -> DataFrame:
    return aggregate.value_share(aggregate.group_count(t.events, "event_type"), []).select("event_type", "n", rounded("percent").alias("percent"))


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1")
def argmax_row(t: Tables) -> DataFrame:
    return aggregate.arg_max(t.supplier, "s_suppkey", "s_acctbal")


# ---- order ---------------------------------------------------------------------------------------------------------


@query("""
    SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS running
    FROM events""")
def cumulative_sum(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "value")
    summed = order.running_sum(rows, "value", ["ts", "event_id"], F.to_date("ts"), ["user_id"])
    return summed.select("event_id", "user_id", rounded("running", 2).alias("running"))


@query("""
    SELECT o_orderkey, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running FROM orders""")
def cumulative_sum_table(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    summed = order.global_running_sum(rows, ["o_totalprice"], ["o_orderdate", "o_orderkey"])
    return summed.select("o_orderkey", rounded("o_totalprice_running", 2).alias("running"))


@query("SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position, o_orderkey FROM orders")
def enumerate_rows(t: Tables) -> DataFrame:
    placed = order.row_positions(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"])
    return placed.select("position", "o_orderkey")


@query("SELECT label, vec_id, rank FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rank FROM embeddings) WHERE rank <= 5")
def top_n_per_class(t: Tables) -> DataFrame:
    top = order.top_rows_per_group(t.embeddings.select("label", "vec_id"), ["label"], ["vec_id"], 5)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query("SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer")
def sort_rows(t: Tables) -> DataFrame:
    placed = order.row_positions(t.customer.select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), "c_custkey"])
    return placed.select("c_custkey", "c_acctbal", (F.col("position") + 1).alias("rank"))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def top_k_groups(t: Tables) -> DataFrame:
    return order.top_rows(aggregate.group_count(t.part, "p_brand"), [F.desc("n"), "p_brand"], 10)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def first_row(t: Tables) -> DataFrame:
    return order.top_rows(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 1)


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 5")
def n_largest(t: Tables) -> DataFrame:
    return order.top_rows(t.supplier.select("s_suppkey", "s_acctbal"), [F.desc("s_acctbal"), "s_suppkey"], 5)


# ---- sets ----------------------------------------------------------------------------------------------------------


@query("""
    SELECT CAST(f AS VARCHAR) AS period, status, count(*) AS n
    FROM (SELECT epoch(CAST(o_orderdate AS TIMESTAMP)) AS s, o_orderstatus AS status, min(epoch(CAST(o_orderdate AS TIMESTAMP))) OVER () AS lo, max(epoch(CAST(o_orderdate AS TIMESTAMP))) OVER () AS hi FROM orders),
        (SELECT unnest([0.4, 0.6, 0.8]) AS f)
    WHERE s < lo + (hi - lo) * CAST(f AS DOUBLE) GROUP BY ALL""")
def union_tagged(t: Tables) -> DataFrame:
    rows = t.orders.select(F.unix_timestamp("o_orderdate").cast("double").alias("s"), F.col("o_orderstatus").alias("status"))
    train = {str(f): splits.time_range_split(rows, F.col("s"), f).where("is_train").groupBy("status").agg(F.count("*").alias("n")) for f in (0.4, 0.6, 0.8)}
    return combine.union_tagged(train, "period")


@query("""
    SELECT l_returnflag, l_linestatus FROM lineitem
    EXCEPT ALL SELECT l_returnflag, l_linestatus FROM lineitem WHERE l_quantity < 25""")
def except_all(t: Tables) -> DataFrame:
    lineitem = t.lineitem
    return combine.except_all(lineitem.select("l_returnflag", "l_linestatus"), lineitem.where("l_quantity < 25").select("l_returnflag", "l_linestatus"))


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def except_distinct(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey").subtract(t.orders.where("o_orderstatus = 'F'").select("o_custkey"))


@query("SELECT DISTINCT l_returnflag, l_tax FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_tax").distinct()


@query("SELECT c_custkey AS custkey FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def set_intersect(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("custkey")).intersect(t.orders.where("o_orderstatus = 'O'").select("o_custkey"))


@query("SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal < 0 UNION SELECT s_nationkey FROM supplier")
def set_union(t: Tables) -> DataFrame:
    return t.customer.where("c_acctbal < 0").select(F.col("c_nationkey").alias("nationkey")).union(t.supplier.select("s_nationkey")).distinct()


@query(f"""
    WITH parted AS (SELECT doc_id, n_chars, {uniform_sql(6, "doc_id")} AS u FROM documents)
    SELECT doc_id, n_chars FROM parted WHERE u < 0.6 UNION ALL SELECT doc_id, n_chars FROM parted WHERE u >= 0.6 AND u < 0.8""")
def concat_splits(t: Tables) -> DataFrame:
    parts = splits.random_parts(t.documents.select("doc_id", "n_chars"), ["doc_id"], [0.6, 0.2, 0.2], 6)
    return parts.where("part = 0").drop("part").unionByName(parts.where("part = 1").drop("part"))
