"""Access-log analytics on parsed lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions.weblog import day_of, hour_of, log_fields
from tarnwater.operators.order import top_rows_per_group

# The compared host suffixes, the hosts named in a share table, the label of all others.
SUFFIXES = (".de", ".ca", ".sg")
TOP_HOSTS = 9
REST_LABEL = "Rest"


def parse_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Log lines to (host, timestamp, request, reply_code, bytes)."""
    return lines.select(*[c.alias(name) for name, c in log_fields(F.col(value)).items()])


def with_suffix(log: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Keep hosts with one of the suffixes and name it, so that all suffixes share one scan. The suffix reads the host
    once, which matters because the filter is evaluated on the host expression itself."""
    pattern = "(" + "|".join(re.escape(s) for s in suffixes) + ")$"
    return log.withColumn("suffix", F.regexp_extract("host", pattern, 1)).where(F.col("suffix") != "")


def suffix_counts(log: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Requests per suffix."""
    return with_suffix(log, suffixes).groupBy("suffix").agg(F.count("*").alias("n_requests"))


def unique_hosts(log: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Distinct hosts per suffix."""
    return with_suffix(log, suffixes).groupBy("suffix").agg(F.count_distinct("host").alias("n_hosts"))


def host_counts(log: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Requests per (suffix, host)."""
    return with_suffix(log, suffixes).groupBy("suffix", "host").agg(F.count("*").alias("n"))


def top_hosts(log: DataFrame, n: int = TOP_HOSTS, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Most frequent hosts per suffix with their rank; equal counts in order of the name."""
    return top_rows_per_group(host_counts(log, suffixes), ["suffix"], [F.desc("n"), F.asc("host")], n)


def rest_bucket(log: DataFrame, n: int = TOP_HOSTS, suffixes: Sequence[str] = SUFFIXES, rest: str = REST_LABEL) -> DataFrame:
    """The top hosts per suffix and one row for all others.

    The rest is the suffix total minus the top hosts, so no window has to rank the long tail of hosts. Both branches
    read the same shuffled host counts.
    """
    counts = host_counts(log, suffixes)
    top = top_rows_per_group(counts, ["suffix"], [F.desc("n"), F.asc("host")], n).select("suffix", "host", "n")
    totals = counts.groupBy("suffix").agg(F.sum("n").alias("n"))
    parts = totals.unionByName(top.select("suffix", (-F.col("n")).alias("n")))
    others = parts.groupBy("suffix").agg(F.sum("n").alias("n")).select("suffix", F.lit(rest).alias("host"), "n")
    return top.unionByName(others)


def share_percent(buckets: DataFrame) -> DataFrame:
    """Percent of the suffix total for each bucket row. The join side has one row per suffix."""
    totals = buckets.groupBy("suffix").agg(F.sum("n").alias("_total"))
    return buckets.join(totals, "suffix").withColumn("percent", 100.0 * F.col("n") / F.col("_total")).drop("_total")


def top_host_visits(log: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Visits of the most frequent host of each suffix by day and hour. The broadcast side has one row per suffix."""
    best = top_hosts(log, 1, suffixes).select("suffix", "host")
    visits = with_suffix(log, suffixes).join(F.broadcast(best), ["suffix", "host"])
    visits = visits.select("suffix", "host", day_of(F.col("timestamp")).alias("day"), hour_of(F.col("timestamp")).alias("hour"))
    return visits.groupBy("suffix", "host", "day", "hour").agg(F.count("*").alias("n"))


def visit_matrix(visits: DataFrame, days: Sequence[str]) -> DataFrame:
    """Hour x day matrix of visits per suffix; a missing cell is NULL."""
    wide = visits.groupBy("suffix", "hour").pivot("day", list(days)).agg(F.sum("n"))
    return wide.select("suffix", "hour", *[F.col(d).alias(f"d{d}") for d in days])


def containing(lines: DataFrame, text: str, value: str = "value") -> DataFrame:
    """Number of lines with the text anywhere in them."""
    return lines.where(F.col(value).contains(text)).agg(F.count("*").alias("n_lines"))
