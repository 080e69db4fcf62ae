"""Row positions, running sums, exact top-k and quantiles without a single-task global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwater.session import materialize

Key = Column | str


def _column(key: Key) -> Column:
    return F.col(key) if isinstance(key, str) else key


def row_positions(df: DataFrame, order_by: Sequence[Key], name: str = "position") -> DataFrame:
    """Add the 0-based rank of each row in the given order.

    Rows are range partitioned and sorted per partition, then written once, which fixes the partition number and the
    place inside it. The offset of a partition is the row count of those before it: one number per partition, the
    only thing that is broadcast or summed in one task. ``order_by`` has to end in a unique key: it makes the result
    deterministic and lets the range partitioner cut through runs of equal values.
    """
    ranked = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    ranked = materialize(ranked.withColumn("_row", F.monotonically_increasing_id()), "positions")
    part, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = ranked.withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    located = ranked.join(F.broadcast(offsets), "_part")
    return located.withColumn(name, F.col("_offset") + place).drop("_row", "_part", "_offset")


def running_sum(
    df: DataFrame, value: str, order_by: Sequence[Key], bucket: Column, partition_by: Sequence[str] = (), name: str = "running"
) -> DataFrame:
    """Cumulative sum in the given order, per ``partition_by`` key or over the whole table.

    ``bucket`` is a coarse, never decreasing function of the order (a day for a timestamp): the sum runs inside each
    (key, bucket), and the totals of the earlier buckets are added. A key that holds a large part of all rows is thus
    spread over as many tasks as it has buckets. Key and bucket are one struct, which is never NULL and equals one with NULLs in the same
    places, so the window's shuffle serves the join too and raw rows move once.
    """
    rows = df.withColumn("_cell", F.struct(F.struct(F.lit(0).alias("all"), *partition_by).alias("key"), bucket.alias("bucket")))
    inside = Window.partitionBy("_cell").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("_cell.key").orderBy("_cell.bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_cell").agg(F.sum(value).alias("_total"))
    starts = totals.select("_cell", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    joined = rows.withColumn("_inside", F.sum(value).over(inside)).join(starts, "_cell")
    return joined.withColumn(name, F.col("_inside") + F.col("_start")).drop("_inside", "_start", "_cell")


def top_rows(df: DataFrame, order_by: Sequence[Key], n: int) -> DataFrame:
    """First n rows; one bounded heap per task, merged once."""
    return df.orderBy(*order_by).limit(n)


def top_rows_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Key], n: int, name: str = "rank") -> DataFrame:
    """First n rows of every group with their rank. The rank filter is applied per task before the shuffle, so a hot
    group sends at most n rows per task."""
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order_by)))
    return ranked.where(F.col(name) <= n)


def position_slice(df: DataFrame, order_by: Sequence[Key], start: int, stop: int) -> DataFrame:
    """Rows start..stop-1 (0-based) in the given order. Meant for the front of a table: the cost grows with ``stop``;
    use :func:`row_positions` for slices far inside."""
    return df.orderBy(*order_by).limit(stop).offset(start)


def head_and_tail(df: DataFrame, key: str, n: int) -> DataFrame:
    """First and last n rows by key, tagged in column ``side``."""
    head = df.orderBy(F.asc(key)).limit(n).withColumn("side", F.lit("head"))
    tail = df.orderBy(F.desc(key)).limit(n).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)


def _ordered_bits(value: Column) -> Column:
    """The 64 bits of a double as a bigint in the order of the doubles, NaN last; 0.0 and -0.0 are one."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("bigint")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1)))


def _from_ordered_bits(key: Column) -> Column:
    bits = key.bitwiseXOR(F.shiftright(key, 63).bitwiseAND(F.lit((1 << 63) - 1)))
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], bits: int = 16) -> DataFrame:
    """Exact, linearly interpolated quantiles as rows (column_name, probability, quantile). NULLs are ignored; a column of NULLs has no rows.

    Radix selection: values become 64 bits in the order of the numbers. The first pass counts rows by the highest ``bits`` of them and finds the
    digit in which each wanted rank lies; each further pass counts only rows that begin like a wanted one by one more digit. That makes
    64 / bits scans for all columns and probabilities together, whatever the data, and runs no job until the result is used.
    Counts are combined before the shuffle, to at most 2^bits rows a column and wanted beginning; the wanted beginnings, at most two for
    each column and probability, are broadcast.
    """
    if bits not in (4, 8, 16):
        raise ValueError("bits: 4, 8 or 16")
    long = F.explode(F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value"))) for c in columns])))
    keys = df.select(long.alias("cell")).select("cell.column_name", _ordered_bits(F.col("cell.value")).alias("key"))
    whole = Window.partitionBy("column_name")
    counts = keys.groupBy("column_name", F.shiftright("key", 64 - bits).alias("digits")).agg(F.count("*").alias("n"))
    place = lambda p: F.lit(float(p)) * (F.col("total") - 1)
    side = lambda p, rank, high: F.struct(F.lit(float(p)).alias("probability"), F.lit(high).alias("high"), (place(p) - F.floor(place(p))).alias("weight"), rank.cast("bigint").alias("rank"))
    ranks = [side(p, r, high) for p in probabilities for r, high in ((F.floor(place(p)), False), (F.least(F.floor(place(p)) + 1, F.col("total") - 1), True))]
    counts = counts.withColumn("total", F.sum("n").over(whole)).withColumn("wants", F.array(*ranks)).withColumn("start", F.lit(0).cast("bigint"))
    for shift in range(64 - bits, -1, -bits):
        upto = Window.partitionBy("column_name", "start").orderBy("digits").rowsBetween(Window.unboundedPreceding, 0)
        counted = counts.withColumn("below", F.sum("n").over(upto) - F.col("n"))
        inside = F.filter("wants", lambda w: (w["rank"] >= F.col("below")) & (w["rank"] < F.col("below") + F.col("n")))
        less = F.transform(inside, lambda w: w.withField("rank", w["rank"] - F.col("below")))
        found = counted.select("column_name", F.col("digits").alias("start"), less.alias("wants")).where(F.size("wants") > 0)
        if shift:
            at = keys.withColumn("start", F.shiftright("key", shift)).withColumn("digits", F.shiftright("key", shift - bits))
            counts = at.join(F.broadcast(found), ["column_name", "start"]).groupBy("column_name", "start", "wants", "digits").agg(F.count("*").alias("n"))
    values = found.select("column_name", _from_ordered_bits(F.col("start")).alias("value"), F.explode("wants").alias("w"))
    end = lambda high: F.max(F.when(F.col("w.high") == high, F.col("value")))
    ends = values.groupBy("column_name", F.col("w.probability").alias("probability")).agg(end(False).alias("low"), end(True).alias("high"), F.max("w.weight").alias("weight"))
    return ends.select("column_name", "probability", (F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")).alias("quantile"))


def global_running_sum(df: DataFrame, values: Sequence[str], order_by: Sequence[Key], suffix: str = "_running") -> DataFrame:
    """Cumulative sums over the whole table in a unique order with no natural bucket.

    Rows are range partitioned and written once; each range is summed on its own and the totals of the earlier ranges
    (one row per range) are added from a broadcast.
    """
    ranked = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    ranked = materialize(ranked.withColumn("_row", F.monotonically_increasing_id()), "ranges")
    ranked = ranked.withColumn("_part", F.shiftright("_row", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranked.groupBy("_part").agg(*[F.sum(v).alias(v) for v in values])
    starts = totals.select("_part", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_start_{v}") for v in values])
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    partial = ranked.withColumns({f"_inside_{v}": F.sum(v).over(inside) for v in values})
    joined = partial.join(F.broadcast(starts), "_part")
    running = {f"{v}{suffix}": F.col(f"_inside_{v}") + F.col(f"_start_{v}") for v in values}
    return joined.withColumns(running).select(*df.columns, *running)
